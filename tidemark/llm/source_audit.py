"""How far the sources of a language diverge in their words: Arrow counts terms, columnar shards compare sources."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, spread_join

#: What separates terms: all of ASCII but letters.
SPLIT = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of text that are split at once, rows that a task holds before it hands counts on, rows of a shard,
#: cells of a block of a shard's matrix, and sources that one task compares with all others.
GROUP, HELD, SHARD, CELLS, BLOCK = 4_000_000, 400_000, 100_000, 2_000_000, 256
SCALE = 1_000_000_000
COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def pieces(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """batch in slices of about GROUP bytes of text, one row at least."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        beyond = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + GROUP)))
        yield batch.slice(at, beyond - at)
        at = beyond


def merged(tables: list[pa.Table]) -> pa.Table:
    """One row for each (lang, source, term), n and docs added up."""
    out = pa.concat_tables(tables).group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return out.rename_columns({"n_sum": "n", "docs_sum": "docs"}).select(COUNTS.names).cast(COUNTS)


def count_terms(lang: pa.Array, source: pa.Array, text: pa.Array) -> pa.Table:
    """Occurrences and documents of each term of each (lang, source), and one row with the empty term for each of those."""
    lists = pc.split_pattern_regex(pc.ascii_lower(text), SPLIT)
    found, row = pc.list_flatten(lists), pc.list_parent_indices(lists)
    word = pc.greater(pc.binary_length(found), 0)  # a text that begins or ends with a separator has an empty piece there
    terms = found.filter(word).dictionary_encode()
    each = pa.table({"row": row.filter(word), "code": terms.indices}).group_by(["row", "code"], use_threads=False).aggregate([([], "count_all")])
    langs, sources = lang.dictionary_encode(), source.dictionary_encode()
    own = pa.table({"lang": langs.indices.take(each["row"]), "source": sources.indices.take(each["row"]), "code": each["code"], "n": each["count_all"]})
    sums = own.group_by(["lang", "source", "code"], use_threads=False).aggregate([("n", "sum"), ("n", "count")])
    there = pa.table({"lang": langs.indices, "source": sources.indices}).group_by(["lang", "source"], use_threads=False).aggregate([([], "count_all")])
    name = lambda table, term, n, docs: pa.table([langs.dictionary.take(table["lang"]), sources.dictionary.take(table["source"]), term, n, docs], names=COUNTS.names).cast(COUNTS)
    zeros = pa.array(np.zeros(there.num_rows, dtype=np.int64))
    return pa.concat_tables([name(sums, terms.dictionary.take(sums["code"]), sums["n_sum"], sums["n_count"]), name(there, pa.array([""] * there.num_rows), zeros, there["count_all"])])


def partial_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) from docs (lang, source, text) without nulls: what each task has counted, added up as far as it holds."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            for piece in pieces(batch, 2):
                held.append(count_terms(*piece.columns))
                if sum(t.num_rows for t in held) > HELD:
                    held = [merged(held)]
                    if held[0].num_rows > HELD // 2:
                        yield from held.pop().combine_chunks().to_batches(max_chunksize=1 << 16)
        if held:
            yield from merged(held).combine_chunks().to_batches(max_chunksize=1 << 16)

    return docs.select("lang", "source", "text").mapInArrow(counted, "lang string, source string, term string, n bigint, docs bigint")


def share(count: np.ndarray, total: np.ndarray | int, terms: int) -> np.ndarray:
    """1 + floor(10^9 (count + 2) / (total + 2 terms)), by three steps of long division, so that nothing overflows."""
    whole = np.asarray(total, dtype=np.int64) + 2 * terms
    rest, out = np.asarray(count, dtype=np.int64) + 2, np.int64(0)
    for _ in range(3):
        out, rest = out * 1000 + rest * 1000 // whole, rest * 1000 % whole
    return out + 1


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def compare(shard: pa.Table, groups: pa.Table, first: int, top: int, block: int, cells: int) -> tuple[list[np.ndarray], tuple[np.ndarray, pa.Array, np.ndarray]]:
    """What a shard of terms adds to the pairs of block sources from first on, and the best terms of these sources.

    shard: (place, term, n), n > 0; groups: (place, total, lang_total, terms), every source of the language.
    A pair's terms are counted by the source that has them, and by the first one where both do; terms that
    neither has are no part of this. Pairs are arrays (a, b, value, terms seen), a row for each source.
    """
    groups = groups.sort_by("place")
    totals, terms = groups["total"].to_numpy(), int(groups["terms"][0].as_py())
    codes = shard["term"].combine_chunks().dictionary_encode()
    term, place, n = codes.indices.to_numpy().astype(np.int64), shard["place"].to_numpy().astype(np.int64), shard["n"].to_numpy()
    order = np.argsort(term, kind="stable")
    term, place, n = term[order], place[order], n[order]
    p = share(n, totals[place], terms)
    absent, size = share(np.zeros(len(totals)), totals, terms), len(totals)
    last = min(size, first + block)
    value, seen = np.zeros((last - first, size), dtype=np.int64), np.zeros((last - first, size), dtype=np.int64)
    width = max(1, cells // size)
    for at in range(0, len(codes.dictionary), width):
        rows = slice(*np.searchsorted(term, (at, at + width)))
        column, own = term[rows] - at, place[rows]
        dense = np.repeat(absent[:, None], int(column.max()) + 1, axis=1)
        has = np.zeros(dense.shape, dtype=bool)
        dense[own, column], has[own, column] = p[rows], True
        for i in np.unique(own[(own >= first) & (own < last)]).tolist():
            columns = np.flatnonzero(has[i])
            counts = ~has[:, columns]
            counts[i + 1 :] = True
            value[i - first] += (gap(dense[:, columns], dense[i, columns]) * counts).sum(axis=1)
            seen[i - first] += counts.sum(axis=1)
    others = np.arange(size)
    pairs = [np.stack([np.minimum(i, others), np.maximum(i, others), value[i - first], seen[i - first]])[:, others != i] for i in range(first, last)]
    whole = np.zeros(len(codes.dictionary), dtype=np.int64)
    np.add.at(whole, term, n)
    q = share(whole, int(groups["lang_total"][0].as_py()), terms)[term]
    mine = np.flatnonzero((p > q) & (place >= first) & (place < last))
    listed = pa.table({"place": place[mine], "value": gap(p[mine], q[mine]), "term": codes.dictionary.take(pa.array(term[mine]))})
    listed = listed.sort_by([("place", "ascending"), ("value", "descending"), ("term", "ascending")])
    place = listed["place"].to_numpy()
    best = np.flatnonzero(np.arange(len(place)) - np.searchsorted(place, place) < top)
    listed = listed.take(pa.array(best))
    return pairs, (listed["place"].to_numpy(), listed["term"].combine_chunks(), listed["value"].to_numpy())


def source_divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", least_docs: int = 10, top: int = 10) -> DataFrame:
    """Per (lang, source): its distance from each other source of the language (part pair) and its own terms (part term).

    Terms are runs of ASCII letters and of characters beyond ASCII, A-Z in lower case; a language keeps those
    in at least least_docs of its documents, V of them. A source's share of a kept term is 1 + floor(10^9
    (count + 2) / (N + 2V)), N being its occurrences of kept terms, and a language's likewise. Two shares
    differ by floor((p - q)^2 / (p + q)). Part pair adds this up over all kept terms, for each other source,
    and ranks them; part term has the top terms that a source uses more than its language does. Ranks go by
    falling value, then by item. All numbers are exact integers.

    Null text, lang and source count as empty; a row is a document, repeats included. A source without a
    term is compared as any other; where a language keeps no term, pairs have the value 0. A language with
    one source has no pairs. An empty table gives no rows; other columns are not read.

    Tasks count terms with Arrow and hand on sums, which move once, by language and term. The kept terms are
    dealt to shards by a hash, in each of which a task compares up to BLOCK sources with all others; only
    terms that a source has cost work, and terms that neither of a pair has are one product in the end. The
    result itself has a row for each pair of sources of a language; a task holds a few numbers for each
    source of one.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    scratch = Scratch(docs.sparkSession)
    partial = partial_counts(docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text")))
    # Equal terms of a language meet in one partition, which serves the sums by source and the documents of all of them.
    sums = partial.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    sums = sums.withColumns({"_docs": F.sum("docs").over(of_term), "leads": F.col("source") == F.min("source").over(of_term)})
    counts = scratch.write("counts", sums.filter((F.col("_docs") >= least_docs) | (F.col("term") == "")).select("lang", "source", "term", "n", "leads"))
    word = F.col("term") != ""
    own = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count_if(word).alias("entries"), F.count_if(word & F.col("leads")).alias("leads"))
    of_lang = Window.partitionBy("lang")
    shards = F.ceil(F.sum("entries").over(of_lang) / SHARD).cast("int")
    groups = own.select(
        "lang", "source", "total", (F.row_number().over(of_lang.orderBy("source")) - 1).cast("long").alias("place"), F.sum("total").over(of_lang).alias("lang_total"),
        F.sum("leads").over(of_lang).alias("terms"), F.greatest(shards, F.lit(1)).alias("shards"), F.floor((F.count("*").over(of_lang) - 1) / BLOCK).cast("int").alias("last_block"),
    )
    groups = scratch.write("groups", groups)
    blocks = F.explode(F.sequence(F.lit(0), F.col("last_block"))).alias("block")
    placed = spread_join(counts.filter(word), groups.select("lang", "source", "place", "shards", "last_block"), ["lang", "source"])
    entries = placed.select("lang", F.pmod(F.xxhash64("term"), F.col("shards")).cast("int").alias("shard"), blocks, "place", "term", "n")
    sides = groups.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).select("lang", "shard", blocks, "place", "total", "lang_total", "terms")
    sides = sides.toDF(*[f"own_{c}" for c in sides.columns]).toDF(*sides.columns)  # columns of their own beside those that entries have from groups
    key, size, cells = ["lang", "shard", "block"], BLOCK, CELLS

    def compared(at: tuple, shard: pa.Table, own: pa.Table) -> pa.Table:
        pairs, (place, term, value) = compare(shard, own, size * at[2].as_py(), top, size, cells) if shard.num_rows else ([], (np.zeros(0, np.int64), pa.array([], pa.string()), np.zeros(0, np.int64)))
        a, b, far, seen = np.concatenate([np.zeros((4, 0), dtype=np.int64), *pairs], axis=1)
        numbers = lambda x, y: pa.array(np.concatenate([x, y]).astype(np.int64))
        none = np.zeros(len(place), dtype=np.int64)
        terms = pa.concat_arrays([pa.nulls(len(a), pa.string()), term.cast(pa.string())])
        lang = pa.array([at[0].as_py()] * len(terms), pa.string())
        return pa.table({"lang": lang, "a": numbers(a, place), "b": numbers(b, none), "term": terms, "value": numbers(far, value), "seen": numbers(seen, none)})

    found = entries.groupBy(*key).cogroup(sides.groupBy(*key)).applyInArrow(compared, "lang string, a bigint, b bigint, term string, value bigint, seen bigint")
    found = scratch.write("found", found)
    of_source = Window.partitionBy("lang", "source")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(of_source.orderBy(F.desc("value"), "item")))
    names = groups.select("lang", F.col("place").alias("a"), "source")
    terms = spread_join(found.filter("term is not null"), names, ["lang", "a"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    far = found.filter("term is null").groupBy("lang", "a", "b").agg(F.sum("value").alias("far"), F.sum("seen").alias("seen"))
    absent = F.when(F.col("terms") > 0, F.expr(f"1 + {2 * SCALE} div greatest(1, total + 2 * terms)")).otherwise(F.lit(1).cast("long"))
    sides = groups.select("lang", "source", "place", "terms", absent.alias("p"))
    pairs = sides.join(sides.select("lang", F.col("source").alias("item"), F.col("place").alias("other"), F.col("p").alias("q")), "lang").filter("place <> other")
    pairs = pairs.withColumns({"a": F.least("place", "other"), "b": F.greatest("place", "other")}).join(far, ["lang", "a", "b"], "left")
    value = F.expr("coalesce(far, 0) + (terms - coalesce(seen, 0)) * (((p - q) * (p - q)) div (p + q))")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))
    return ranked(pairs).unionByName(ranked(terms).filter(F.col("rank") <= top)).select("lang", "source", "part", "item", "value", "rank")


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS nr, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
found AS (SELECT nr, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM found GROUP BY lang, term HAVING count(DISTINCT nr) >= 10),
sizes AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS c FROM found SEMI JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT lang, source, coalesce(total, 0) AS total FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT lang, source, sum(c) AS total FROM counts GROUP BY ALL) USING (lang, source)),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c, 1 + 1000000000::HUGEINT * (coalesce(c, 0) + 2) // (g.total + 2 * v) AS p,
         1 + 1000000000::HUGEINT * (k.n + 2) // (s.total + 2 * v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN sizes s USING (lang) LEFT JOIN counts x ON x.lang = g.lang AND x.source = g.source AND x.term = k.term),
far AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
both_parts AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source LEFT JOIN far f ON f.lang = g.lang AND f.source = g.source AND f.item = h.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM shares WHERE c > 0 AND p > q)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM both_parts QUALIFY part = 'pair' OR rank <= 10
"""
