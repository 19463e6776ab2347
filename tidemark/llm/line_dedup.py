"""Line deduplication by a deletion-neighbourhood join; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, document_key, spread_join
from .exact_dedup import bits_for, maybe_among

#: Stripped from both ends of a line before it is compared.
BLANK = " \t\r\x0b\x0c"
#: Least characters of a segment in long lines, which are cut in as many as a segment has characters; shorter ones have two.
SEGMENT = 256


def half_keys(near_chars: int) -> Column:
    """Up to four hashes of halves of a line of n characters: of both halves under its own length and under one less.

    Two lines at one edit are equal in one half, under the shorter one's length. Empty where a line is too short.
    """

    def halves(m: str, skip: int) -> list[Column]:
        return [
            F.expr(f"if({m} >= {near_chars}, xxhash64({m}, 0, left(line, {m} div 2)), null)"),
            F.expr(f"if({m} >= {near_chars}, xxhash64({m}, 1, substring(line, {m} div 2 + {skip})), null)"),
        ]

    return F.array_compact(F.array(*halves("n", 1), *halves("(n - 1)", 2)))


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, key, nr, line, h, g) for each line that is not blank; h and g together are 128 bits of its hash."""
    lines = docs.select("doc_id", "key", F.posexplode(F.split("text", "\n")).alias("nr", "line"))
    lines = lines.withColumn("line", F.btrim("line", F.lit(BLANK))).filter("line <> ''")
    return lines.withColumn("h", F.xxhash64("line")).withColumn("g", F.xxhash64(F.lit(1), "line"))


def position() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key", "nr")


def first_lines(scratch: Scratch, lines: DataFrame) -> DataFrame:
    """(h, g, pos, n, halves): the first occurrence of each line, and how many there are."""
    firsts = lines.groupBy("h", "g").agg(F.min(position()).alias("pos"), F.count("*").alias("n"), F.first("halves").alias("halves"))
    return scratch.write("firsts", firsts)


def alike_lines(scratch: Scratch, docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """(h, g, pos, line): the first occurrence of each line that shares half of its characters with another line.

    Halves are counted before anything else moves with them. A Bloom filter picks the lines in a second scan
    of the texts, and an exact join has the last word.
    """
    halves = firsts.select("h", "g", "pos", F.explode("halves").alias("half"))
    shared = scratch.write("shared", halves.groupBy("half").agg(F.count("*").alias("n")).filter("n > 1").select("half"))
    asked = scratch.write("asked", spread_join(halves, shared, "half").select("h", "g", "pos").distinct())
    some = maybe_among(lines_of(docs), asked, "h", bits_for(asked.count()))
    rows = spread_join(some.select("h", "g", position().alias("at"), "line"), asked, ["h", "g"]).filter("at = pos")
    return scratch.write("alike", rows.dropDuplicates(["h", "g"]).select("h", "g", "pos", "line"))


def _segments(m: str) -> str:
    """Width of the segments under a base length m."""
    return f"if({m} > {2 * SEGMENT}, greatest({SEGMENT}, cast(ceil(sqrt({m})) as int)), ({m} + 1) div 2)"


def contexts(scratch: Scratch, alike: DataFrame, near_chars: int) -> DataFrame:
    """(ord, longer, m, j, context, segment): each line of alike without each of its segments; ord is its place among them.

    A line is cut under its own length as base length m, and under one character less (longer): there the
    segment has one character more. Two lines at one edit agree, under the shorter one's length, in all but
    one segment. The rest of a line is known by the exclusive or of its segments' hashes, before and behind,
    so the work is in proportion to a line's length.
    """
    # Written, so that no hash is computed again for each segment.
    cut_up = lambda line, m: F.expr(f"regexp_extract_all({line}, concat('(?s).{{1,', {_segments(m)}, '}}'), 0)")
    rows = alike.select("ord", "line", F.length("line").alias("n")).withColumn("m", F.explode(F.expr(f"if(n > {near_chars}, array(n, n - 1), array(n))")))
    rows = rows.withColumn("longer", F.col("m") < F.col("n"))
    rows = rows.select("ord", "m", "longer", cut_up("line", "m").alias("here"), F.when(F.col("longer"), cut_up("substring(line, 2)", "m")).alias("behind"))
    hashes = lambda c: f"transform({c}, (s, i) -> xxhash64(s, i))"
    rows = scratch.write("segments", rows.withColumn("h_here", F.expr(hashes("here"))).withColumn("h_behind", F.expr(hashes("coalesce(behind, here)"))))
    running = lambda c: f"aggregate({c}, array(0L), (a, x) -> concat(a, array(a[size(a) - 1] ^ x)))"
    rows = scratch.write("running", rows.select("ord", "m", "longer", "here", "behind", F.expr(running("h_here")).alias("r_here"), F.expr(running("h_behind")).alias("r_behind")))
    each = """transform(coalesce(behind, here), (s, j) -> named_struct(
        'j', j, 'context', xxhash64(m, j, r_here[j] ^ r_behind[size(r_behind) - 1] ^ r_behind[j + 1]),
        'segment', if(longer, concat(left(here[j], 1), s), s)))"""
    return rows.select("ord", "longer", "m", F.explode(F.expr(each)).alias("x")).select("ord", "longer", "m", "x.*")


def one_edit() -> Column:
    """Whether line and other are equal outside segment j of base length m, and at one edit in it."""
    begin, width = f"(j * {_segments('m')})", _segments("m")
    rest = lambda c: f"substring({c}, {begin} + {width} + 1 + length({c}) - m)"
    segment = lambda c: f"substring({c}, {begin} + 1, {width} + length({c}) - m)"
    same = f"left(line, {begin}) = left(other, {begin}) AND {rest('line')} = {rest('other')}"
    return F.expr(f"{same} AND levenshtein({segment('line')}, {segment('other')}, 1) BETWEEN 0 AND 1")


def near_lines(scratch: Scratch, alike: DataFrame, near_chars: int) -> DataFrame:
    """(pos) of the lines of alike (pos, line) that lie within one edit of an earlier one.

    A line stays in question while another one has the same context, which is all of it but one segment.
    Then the deletion neighbourhood of that segment is emitted as hashed keys. Lines that are equal without
    their character i, or of which one is the other without a character, meet in one key, and the earliest
    of a key answers for all others, so that no pairs are made. Keys are counted before they are joined, and
    lines move only to verify the edit distance of the pairs that are found.
    """
    alike = scratch.write("ordered", alike.select("pos", "line").sort("pos").withColumn("ord", F.monotonically_increasing_id()))
    asked = scratch.write("contexts", contexts(scratch, alike, near_chars))
    shared = asked.groupBy("context").agg(F.count("*").alias("n")).filter("n > 1").select("context")
    lines = scratch.write("open", spread_join(asked, shared, "context").filter("segment <> ''"))
    # Equal lengths: the same deletion at the same place. One longer: a deletion that gives the shorter line.
    without = "concat(substring(segment, 1, i - 1), substring(segment, i + 1))"
    own = "array(named_struct('key', xxhash64('drop', context, segment), 'side', 2))"
    swaps = f"transform(sequence(1, length(segment)), i -> named_struct('key', xxhash64('swap', context, i, {without}), 'side', 0))"
    drops = f"transform(sequence(1, length(segment)), i -> named_struct('key', xxhash64('drop', context, {without}), 'side', 1))"
    keys = lines.select("ord", "m", "j", F.explode(F.expr(f"if(longer, {drops}, concat({swaps}, {own}))")).alias("x")).select("ord", "m", "j", "x.*")
    keys = scratch.write("keys", keys)
    first = lambda side: F.min(F.when(F.col("side") == side, F.col("ord")))
    mates = keys.groupBy("key").agg(F.count("*").alias("n"), first(0).alias("swap"), first(1).alias("longer"), first(2).alias("whole")).filter("n > 1")
    mate = F.when(F.col("side") == 0, F.col("swap")).when(F.col("side") == 1, F.col("whole")).otherwise(F.col("longer"))
    pairs = spread_join(keys, mates, "key").select("ord", "m", "j", mate.alias("mate")).filter("mate < ord").distinct()
    pairs = spread_join(spread_join(pairs, alike, "ord"), alike.select(F.col("ord").alias("mate"), F.col("line").alias("other")), "mate")
    return scratch.write("near", pairs.filter(one_edit()).select("pos").distinct())


def line_drops(scratch: Scratch, docs: DataFrame, near_chars: int) -> DataFrame:
    """(key, gone, n_exact, n_near): per document its lines that go, as a byte 1 at their numbers. docs: (doc_id, text, key).

    One scan of the texts writes each line's hashes; all grouping is on those.
    """
    hashed = lines_of(docs).withColumn("n", F.length("line")).withColumn("halves", half_keys(near_chars))
    lines = scratch.write("lines", hashed.select("doc_id", "key", "nr", "h", "g", "halves"))
    firsts = first_lines(scratch, lines)
    repeated = firsts.filter("n > 1").select("h", "g", F.col("pos").alias("first"))
    exact = spread_join(lines.select("h", "g", position().alias("pos")), repeated, ["h", "g"]).filter("pos > first").select("pos.key", "pos.nr", F.lit("exact").alias("kind"))
    exact = scratch.write("exact", exact)
    scratch.drop("lines")
    near = near_lines(scratch, alike_lines(scratch, docs, firsts), near_chars).select("pos.key", "pos.nr", F.lit("near").alias("kind"))
    pick = lambda kind: F.collect_set(F.when(F.col("kind") == kind, F.col("nr")))
    sets = exact.union(near).groupBy("key").agg(pick("exact").alias("exact"), pick("near").alias("near"))
    sets = scratch.write("sets", sets.select("key", F.array_sort(F.array_union("exact", "near")).alias("at"), F.size("exact").alias("n_exact"), F.size(F.array_except("near", "exact")).alias("n_near")))
    gone = F.expr("cast(array_join(transform(at, (x, i) -> concat(repeat('0', x - if(i = 0, 0, at[i - 1] + 1)), '1')), '') as binary)")
    drops = scratch.write("drops", sets.select("key", gone.alias("gone"), "n_exact", "n_near"))
    scratch.drop("firsts", "shared", "asked", "alike", "ordered", "segments", "running", "contexts", "open", "keys", "exact", "near", "sets")
    return drops


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", near_chars: int = 20, prefix: str = "_lines") -> DataFrame:
    """docs with the text of text_col less its repeated lines, and a struct column named prefix.

    A line (between line feeds, its ends stripped of blanks) goes if an earlier line, by id and then line
    number, is equal to it or, where both have near_chars characters or more, within one edit (a character
    inserted, deleted or replaced). The earlier line counts whether or not it went itself. Blank lines stay.
    prefix holds n_lines, n_exact and n_near (lines that went for an equal and only for a similar one).

    A null text stays null and has one (empty) line; so has an empty one. Null ids come last, ordered by a
    hash of the text, as are rows with one id and different texts. Rows that repeat id and text are one
    document: they are judged alike and lose nothing to each other. All columns of docs are kept; no other
    name is touched but prefix, which docs must not have. Empty tables give no rows. Texts and lines may be
    long: the work grows in proportion to them.

    Equal lines are found by 128 bits of hashes; candidates for similar ones by hashes of halves, and of all
    but one segment, and then by the deletion neighbourhood of that segment.
    """
    if prefix.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"docs has a column {prefix}; name another prefix")
    text = F.col(text_col)
    key = document_key(F.col(id_col), text)
    drops = line_drops(Scratch(docs.sparkSession), docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), key.alias("key")), near_chars)
    joined = spread_join(docs.select(F.struct("*").alias("doc"), key.alias("key")), drops, "key", "left")
    inner = F.col("doc").getField(text_col)
    lines = F.split(inner, "\n")
    stays = lambda _, i: F.substring("gone", i + 1, F.lit(1)) != F.lit(b"1")
    kept = F.when(F.col("gone").isNull(), inner).otherwise(F.array_join(F.filter(lines, stays), "\n"))
    none = lambda c: F.coalesce(c, F.lit(0))
    counts = F.struct(F.coalesce(F.size(lines), F.lit(1)).alias("n_lines"), none("n_exact").alias("n_exact"), none("n_near").alias("n_near"))
    columns = [kept.alias(c) if c == text_col else F.col("doc").getField(c).alias(c) for c in docs.columns]
    return joined.select(*columns, counts.alias(prefix))


SQL = r"""
WITH d AS (SELECT doc_id, text, md5(coalesce(doc_id::VARCHAR, '~') || ' ' || md5(coalesce(text, ''))) AS key FROM documents),
raw AS (SELECT doc_id, key, unnest(string_split(coalesce(text, ''), chr(10))) AS whole, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS nr FROM d),
lines AS (SELECT *, trim(whole, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS line, row_number() OVER (ORDER BY doc_id NULLS LAST, key, nr) AS pos FROM raw),
firsts AS (SELECT line, min(pos) AS pos, length(line) AS n FROM lines WHERE line <> '' GROUP BY line),
halves AS (
  SELECT line, pos, n, n AS m, 'p' || left(line, n // 2) AS half FROM firsts WHERE n >= 20
  UNION ALL SELECT line, pos, n, n, 's' || right(line, n - n // 2) FROM firsts WHERE n >= 20
  UNION ALL SELECT line, pos, n, n - 1, 'p' || left(line, (n - 1) // 2) FROM firsts WHERE n > 20
  UNION ALL SELECT line, pos, n, n - 1, 's' || right(line, n - 1 - (n - 1) // 2) FROM firsts WHERE n > 20),
pairs AS (
  SELECT DISTINCT a.line AS x, a.n AS nx, b.line AS y, b.n AS ny FROM halves a JOIN halves b ON a.m = b.m AND a.half = b.half AND b.pos < a.pos),
ends AS (
  SELECT x, nx, ny,
    coalesce(list_position(list_transform(range(1, least(nx, ny) + 1), lambda i: substr(x, i, 1) <> substr(y, i, 1)), true) - 1, least(nx, ny)) AS lcp,
    coalesce(list_position(list_transform(range(1, least(nx, ny) + 1), lambda i: substr(x, nx - i + 1, 1) <> substr(y, ny - i + 1, 1)), true) - 1, least(nx, ny)) AS lcs
  FROM pairs),
near AS (SELECT DISTINCT x AS line FROM ends WHERE lcp + lcs >= greatest(nx, ny) - 1),
judged AS (
  SELECT l.doc_id, l.key, l.nr, l.whole, l.line <> '' AND l.pos > f.pos AS exact, l.pos = f.pos AND n.line IS NOT NULL AS near
  FROM lines l LEFT JOIN firsts f ON l.line = f.line LEFT JOIN near n ON l.line = n.line)
SELECT doc_id, count(*)::INT AS n_lines, count(*) FILTER (exact)::INT AS n_exact, count(*) FILTER (near)::INT AS n_near,
       sha256(coalesce(string_agg(whole, chr(10) ORDER BY nr) FILTER (NOT (coalesce(exact, false) OR coalesce(near, false))), '')) AS kept_sha256
FROM judged GROUP BY doc_id, key
"""
