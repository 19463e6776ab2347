"""Exact deduplication by two passes over a Bloom filter; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, cut, spread_join, write_out


#: Filter bits for each row, 64-bit words of a page, and bits of a filter that is broadcast: 2^32 are 512 MB.
BITS_PER_ROW, PAGE, MOST_BITS = 16, 64, 1 << 32


def bits_for(n_rows: int) -> int:
    """A power of two that leaves room for each row."""
    return 1 << max(16, (BITS_PER_ROW * n_rows).bit_length())


def slot_of(key: str, probe: int, filter_bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(probe)), F.lit(filter_bits))


def repeated_bits(hashed: DataFrame, key: str, filter_bits: int, probes: int) -> DataFrame:
    """First pass: the filter's bits that two or more rows set, as pages of 64-bit words (page, words).

    There are at most filter_bits / 4096 pages of 512 bytes.
    """
    slots = hashed.select(F.explode(F.array(*[slot_of(key, i, filter_bits) for i in range(probes)])).alias("slot"))
    twice = slots.groupBy("slot").agg(F.count("*").alias("n")).filter("n > 1")
    words = twice.groupBy(F.expr("slot div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("bits"))
    pages = words.groupBy(F.expr(f"word div {PAGE}").alias("page")).agg(F.map_from_entries(F.collect_list(F.struct(F.expr(f"cast(word % {PAGE} as int)"), "bits"))).alias("own"))
    return pages.select("page", F.transform(F.sequence(F.lit(0), F.lit(PAGE - 1)), lambda i: F.coalesce(F.try_element_at("own", i), F.lit(0).cast("long"))).alias("words"))


def with_bit(rows: DataFrame, pages: DataFrame, slot: Column, name: str) -> DataFrame:
    """rows with a boolean column: whether the filter has the row's bit. Pages are broadcast, and no row moves."""
    side = F.broadcast(pages.toDF(f"_page{name}", f"_words{name}"))
    found = rows.withColumn(f"_slot{name}", slot).withColumn(f"_page{name}", F.expr(f"_slot{name} div {64 * PAGE}")).join(side, f"_page{name}", "left")
    bit = F.expr(f"coalesce(getbit(get(_words{name}, cast(_slot{name} div 64 % {PAGE} as int)), cast(_slot{name} % 64 as int)), 0) = 1")
    return found.withColumn(name, bit).drop(f"_slot{name}", f"_page{name}", f"_words{name}")


def maybe_among(rows: DataFrame, keys: DataFrame, key: str, filter_bits: int = 1 << 26) -> DataFrame:
    """The rows whose key is in keys (which may repeat), and some others: a filter of at most MOST_BITS is broadcast."""
    wanted, filter_bits = keys.select(key).distinct(), min(filter_bits, MOST_BITS)
    pages = repeated_bits(wanted.union(wanted), key, filter_bits, 1)
    return with_bit(rows, pages, slot_of(key, 0, filter_bits), "_among").filter("_among").select(*rows.columns)


def maybe_repeated(hashed: DataFrame, key: str, filter_bits: int = 1 << 26, probes: int = 2) -> DataFrame:
    """hashed with a boolean column maybe_repeated: false only where key surely occurs once."""
    pages = repeated_bits(hashed, key, filter_bits, probes)
    out = hashed
    for i in range(probes):
        out = with_bit(out, pages, slot_of(key, i, filter_bits), f"_bit{i}")
    flag = F.col("_bit0")
    for i in range(1, probes):
        flag = flag & F.col(f"_bit{i}")
    return out.select(*hashed.columns, flag.alias("maybe_repeated"))


def flagged_rows(hashed: DataFrame, n_rows: int, filter_bits: int | None, probes: int, pass_bits: int = MOST_BITS) -> DataFrame:
    """maybe_repeated of all rows. A filter of more than pass_bits is split: a pass for each range of another hash."""
    bits = filter_bits or bits_for(n_rows)
    passes = -(-bits // pass_bits)
    part = F.pmod(F.xxhash64(F.lit("pass"), "sha"), F.lit(passes))
    parts = [maybe_repeated(hashed.filter(part == p) if passes > 1 else hashed, "sha", min(bits, pass_bits), probes) for p in range(passes)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", filter_bits: int | None = None, probes: int = 2, pass_bits: int = MOST_BITS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after each run of ASCII white space becomes one space; a null
    text counts as empty. Texts are compared by SHA-256. Of equal texts the row with the smallest id stays;
    null ids come after all others. Rows that repeat an id and a text count in group_size each, and one of
    them is kept at most. An empty table gives no rows. Other columns of docs are not read.

    The text is read once; the rows (id, SHA-256) are written, a first pass over them sets the filter's
    bits, and a second one splits them: rows whose bits no other row has set are unique and pass straight
    through, the rest are grouped by SHA-256. The filter is sized by the number of rows (filter_bits, if
    given); one too small sends more rows to the exact grouping and never changes the result. Pages of a
    filter are broadcast, at most pass_bits at once (512 MB for 268 million rows); more rows take a pass over
    the hashes for each part of a larger filter, so that unique rows never move, whatever their number.
    """
    norm = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), SPACE, " ")
    hashed = cut(docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(norm, 256)).alias("sha")))
    flagged = write_out(flagged_rows(hashed, hashed.count(), filter_bits, probes, pass_bits))
    unique = flagged.filter(~F.col("maybe_repeated")).select("doc_id", "sha", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    rows = flagged.filter("maybe_repeated").groupBy("sha", "doc_id").agg(F.count("*").alias("n"))
    groups = rows.groupBy("sha").agg(F.min("doc_id").alias("keep_id"), F.sum("n").alias("group_size"))
    copies = spread_join(rows, groups, "sha").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    both = unique.unionByName(copies.select("doc_id", "sha", "keep_id", "group_size", kept.alias("kept")))
    return both.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


SQL = r"""
WITH hashed AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM hashed WINDOW g AS (PARTITION BY text_sha256)
"""
