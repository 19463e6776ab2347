"""Mixing sources to target weights by a low-discrepancy schedule; DataFrame functions only."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, cut, running_totals

#: 2^64 over the golden ratio, as an odd whole number: its multiples modulo 2^64 are the points of the schedule.
GOLDEN = 0x9E3779B97F4A7C15
#: Buckets of a source's documents, most runs of slots, and least cells of the unit interval.
BUCKETS, RUNS, CELLS = 4096, 4096, 1024
#: A source has so many blocks at least, if it has the words.
LEAST_BLOCKS = 512
#: Targets are broadcast up to so many sources.
FEW_SOURCES = 100_000


def source_targets(scratch: Scratch, sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3) -> DataFrame:
    """(src, source_size, target) from (src, source_size); src sorts by code point with null last.

    All sizes together are shared by weight, the weights repeating in the order of src; a target stops at
    max_epochs times its source's size and the excess is shared again until none is above. In the order of
    the level at which sources stop, one is open if it cannot be filled by its part of what is left.
    """
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    named = running_totals(scratch, "sources", sizes, ["src"], {"at": F.lit(1).cast("long")})
    named = named.withColumn("weight", F.element_at(cycle, (F.col("at") % len(weights) + 1).cast("int"))).withColumn("cap", F.col("source_size") * max_epochs)
    named = named.withColumn("stops", F.col("cap") / F.col("weight"))
    size, weight = named.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    filled = running_totals(scratch, "levels", named, ["stops", "src"], {"filled": F.col("cap"), "passed": F.col("weight")})
    leveled = (
        filled.withColumn("left_weight", F.lit(weight) - F.col("passed"))
        .withColumn("level", (F.lit(size) - F.col("filled")).cast("double") / F.col("left_weight"))
        .withColumn("open", F.col("cap") > F.col("level") * F.col("weight"))
    )
    first = leveled.filter("open").agg(F.max(F.struct("left_weight", "level"))["level"]).first()[0]
    leveled = leveled.withColumn("water", F.lit(first).cast("double"))
    target = F.when(F.col("open"), F.col("water") * F.col("weight")).otherwise(F.col("cap").cast("double"))
    return leveled.select("src", "source_size", target.alias("target"))


def block_length(block: int) -> Column:
    """Words in a block of a source: block, or fewer so that a small source has LEAST_BLOCKS of them."""
    return F.expr(f"greatest(1, least({block}, source_size div {LEAST_BLOCKS}))")


def point() -> Column:
    """slot times GOLDEN modulo 2^64, as a part of 2^64: as exact for late slots as for early ones."""
    product = F.col("slot").cast("decimal(18,0)") * F.lit(Decimal(GOLDEN)).cast("decimal(20,0)")
    return (product % F.lit(Decimal(1 << 64)).cast("decimal(20,0)")).cast("double") / F.lit(2.0**64)


def schedule_slots(scratch: Scratch, targets: DataFrame, total: int, block: int, max_epochs: int = 3) -> DataFrame:
    """(slot, src, rank, block, length): slot i maps the i-th point through the cumulative slots of the targets.

    A source whose blocks are shorter than block takes as many more slots for its target.
    """
    targets = targets.withColumn("length", block_length(block)).withColumn("share", F.col("target") * (F.lit(float(block)) / F.col("length")))
    # The shares' sum is the total, exactly where all blocks are equally long, and what short blocks add.
    more, n_sources = targets.agg(F.coalesce(F.sum(F.col("share") - F.col("target")), F.lit(0.0)), F.count("*")).first()
    whole, cells = max(total, 1) + more, max(CELLS, n_sources)
    n_slots = int((total + more) // block) + 1
    ranges = running_totals(scratch, "ranges", targets, ["src"], {"low": F.col("share")})
    ranges = ranges.withColumn("high", F.col("low") + F.col("share")).filter("target > 0")
    cell = lambda end, by: F.floor(F.col(end) * cells / F.lit(float(whole)) + by).cast("long")
    ranges = ranges.withColumn("cell", F.explode(F.sequence(cell("low", -0.001), cell("high", 0.001))))
    slots = targets.sparkSession.range(n_slots).withColumnRenamed("id", "slot").withColumn("point", point())
    slots = slots.withColumn("cell", F.floor(F.col("point") * cells)).withColumn("at", F.col("point") * F.lit(float(whole)))
    slots = slots.join(ranges, "cell").filter("at >= low AND at < high")
    slots = slots.select("slot", "src", "source_size", "length", F.expr(f"slot div {max(256, n_slots // RUNS)}").alias("run"))
    counts = slots.groupBy("src", "run").agg(F.count("*").alias("n"))
    starts = counts.select("src", "run", (F.sum("n").over(Window.partitionBy("src").orderBy("run")) - F.col("n")).alias("start"))
    ranked = slots.withColumn("in_run", F.row_number().over(Window.partitionBy("src", "run").orderBy("slot")) - 1)
    ranked = ranked.join(starts, ["src", "run"]).withColumn("rank", F.col("start") + F.col("in_run"))
    blocks = F.expr("(source_size + length - 1) div length")
    ranked = ranked.withColumn("blocks", blocks).filter(F.expr("rank div blocks") < max_epochs)
    return ranked.select("slot", "src", "rank", F.expr("rank % blocks").alias("block"), "length")


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (5, 2, 1),
    max_epochs: int = 3,
    max_block: int = 1024,
    least_slots: int = 1 << 17,
) -> tuple[DataFrame, DataFrame]:
    """(taken, schedule): per document how many of its words the mix takes, and the mix's blocks in order.

    taken: doc_id, source, size, source_size, target, taken. schedule: slot, source, rank, block, length.

    Each source's documents are put in hash order, as one stream of words that is cut into blocks of equal
    length (max_block words, or fewer so that the mix has least_slots of them); a source of under LEAST_BLOCKS
    such blocks has shorter ones, down to a word, and more slots. Slot i of the mix maps the point i over the
    golden ratio, less its whole part, through the sources' cumulative numbers of slots; the r-th slot of a source takes
    its block r modulo its number of blocks, so a source is used up evenly and every prefix of the mix has
    about the target weights in words. No block is scheduled more than max_epochs times, nor any document's word.

    A null text has size 0 and takes nothing; a null source is a source of its own, after all others. Rows
    that repeat an id are documents of their own. An empty table gives no rows. Other columns are not read.
    Reruns agree: the order comes from hashes of ids, and rows equal in id, source and size are alike.
    """
    src = F.when(F.col(source_col).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source_col).cast("string")))
    size = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    shuffled = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    sized = cut(
        docs.select(F.col(id_col).alias("doc_id"), src.alias("src"), size.alias("size"), shuffled.alias("place"))
        .withColumn("bucket", F.conv(F.substring("place", 1, 3), 16, 10).cast("int") % BUCKETS)
        .withColumn("row", F.monotonically_increasing_id())
    )
    totals = sized.groupBy("src", "bucket").agg(F.sum("size").alias("bucket_size"))
    scratch = Scratch(docs.sparkSession)
    targets = cut(source_targets(scratch, totals.groupBy("src").agg(F.sum("bucket_size").alias("source_size")), weights, max_epochs))
    total, n_sources = targets.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.count("*")).first()
    block = max(1, min(max_block, total // least_slots))
    known = lambda rows, sources: rows.join(F.broadcast(sources) if n_sources <= FEW_SOURCES else sources, "src")
    schedule = schedule_slots(scratch, targets, total, block, max_epochs)

    ahead = totals.select("src", "bucket", (F.sum("bucket_size").over(Window.partitionBy("src").orderBy("bucket")) - F.col("bucket_size")).alias("ahead"))
    inside = Window.partitionBy("src", "bucket").orderBy("place", "doc_id", "size", "row").rowsBetween(Window.unboundedPreceding, 0)
    # One row for each bucket carries the length of its source's blocks.
    ahead = known(ahead, targets.select("src", block_length(block).alias("length")))
    placed = sized.withColumn("upto", F.sum("size").over(inside)).join(ahead, ["src", "bucket"]).withColumn("begin", F.col("ahead") + F.col("upto") - F.col("size"))
    covered = F.when(F.col("size") > 0, F.expr("sequence(begin div length, (begin + size - 1) div length)"))
    parts = placed.select("row", "doc_id", "src", "size", "begin", "length", F.explode_outer(covered).alias("block"))
    overlap = F.least(F.col("begin") + F.col("size"), (F.col("block") + 1) * F.col("length")) - F.greatest(F.col("begin"), F.col("block") * F.col("length"))
    uses = schedule.groupBy("src", "block").agg(F.count("*").alias("uses"))
    taken = parts.join(uses, ["src", "block"], "left").groupBy("row", "doc_id", "src", "size").agg(F.coalesce(F.sum(overlap * F.col("uses")), F.lit(0)).alias("taken"))
    taken = known(taken, targets)
    source = F.when(F.col("src") != "1", F.expr("substring(src, 2)")).alias("source")
    return taken.select("doc_id", source, "size", "source_size", "target", "taken"), schedule.select("slot", source, "rank", "block", "length")


SQL = r"""
WITH sized AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS src,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS place
  FROM documents),
sizes AS (SELECT src, sum(size)::BIGINT AS source_size FROM sized GROUP BY src),
weighed AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY src) - 1) % 3 + 1)::INT]::BIGINT AS weight, 3 * source_size AS cap FROM sizes),
lefts AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER f, 0) AS left_size,
         sum(weight) OVER () - coalesce(sum(weight) OVER f, 0) AS left_weight
  FROM weighed WINDOW f AS (ORDER BY cap / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
leveled AS (SELECT *, left_size::DOUBLE / left_weight::DOUBLE AS level FROM lefts),
opened AS (SELECT *, cap > level * weight AS is_open FROM leveled),
targets AS (
  SELECT src, source_size, CASE WHEN is_open THEN (SELECT max_by(level, left_weight) FROM opened WHERE is_open) * weight ELSE cap::DOUBLE END AS target
  FROM opened),
params AS (SELECT t AS total, greatest(1, least(1024, t // 131072)) AS block FROM (SELECT sum(source_size)::BIGINT AS t FROM sizes)),
shares AS (
  SELECT *, target * (block::DOUBLE / length::DOUBLE) AS share
  FROM (SELECT *, greatest(1, least(block, source_size // 512))::BIGINT AS length FROM targets, params)),
ranges AS (
  SELECT *, coalesce(sum(share) OVER (ORDER BY src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS low FROM shares),
wholes AS (SELECT any_value(block) AS block, any_value(total) AS total, sum(share - target) AS more FROM shares),
slots AS (
  SELECT i AS slot, ((i::HUGEINT * 11400714819323198485::HUGEINT) % 18446744073709551616::HUGEINT)::DOUBLE / 18446744073709551616::DOUBLE * (greatest(total, 1)::DOUBLE + more) AS place
  FROM (SELECT unnest(range(floor((total + more) / block)::BIGINT + 1)) AS i, total, more FROM wholes)),
ranked AS (
  SELECT r.src, row_number() OVER (PARTITION BY r.src ORDER BY slot) - 1 AS rank, (r.source_size + length - 1) // length AS blocks
  FROM slots JOIN ranges r ON place < r.low + r.share AND place >= r.low),
uses AS (SELECT src, rank % blocks AS block_no, count(*) AS uses FROM ranked WHERE rank // blocks < 3 GROUP BY ALL),
placed AS (
  SELECT *, sum(size) OVER (PARTITION BY src ORDER BY place, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT - size AS begin FROM sized),
parts AS (
  SELECT doc_id, src, begin, size, unnest(range(begin // length, (begin + size - 1) // length + 1)) AS block_no, length
  FROM placed JOIN shares USING (src) WHERE size > 0),
used AS (
  SELECT doc_id, begin, sum((least(begin + size, (p.block_no + 1) * length) - greatest(begin, p.block_no * length)) * uses)::BIGINT AS taken
  FROM parts p JOIN uses u ON p.src = u.src AND p.block_no = u.block_no GROUP BY doc_id, begin)
SELECT s.doc_id, s.size, t.source_size, t.target, coalesce(CASE WHEN s.size > 0 THEN u.taken END, 0) AS taken
FROM placed s JOIN targets t ON s.src = t.src LEFT JOIN used u ON s.doc_id IS NOT DISTINCT FROM u.doc_id AND s.begin = u.begin
"""
