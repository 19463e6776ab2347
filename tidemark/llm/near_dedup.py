"""Dropping near-duplicates: candidates by covering hashing of SimHash prints and by banded minima, each verified by shingles."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, document_key, spread_join
from .components import connected_components
from .exact_dedup import bits_for, maybe_among
from .simhash import links, print_of, shingle_hashes

#: Bands of minima and minima of a band: texts at a similarity of 0.8 agree in one band or more with a probability of 0.95.
BANDS, WIDTH = 16, 8
#: Texts whose hashes are held at once, shingles whose minima are taken at once, and rounds in which buckets are compared with their first text alone.
ROWS, CHUNK, ROUNDS = 256, 1 << 10, 2


@cache
def multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """n hash functions h -> a h + b modulo 2^64, of which the upper half counts; a is odd."""
    seeds = np.array([xxhash.xxh64_intdigest(i.to_bytes(4, "little"), 7) for i in range(2 * n)], dtype=np.uint64)
    return seeds[:n] | np.uint64(1), seeds[n:]


def bands_of(hashes: np.ndarray) -> list[int]:
    """One key for each band of minima of the different hashes; none without hashes."""
    if not len(hashes):
        return []
    a, b = multipliers(BANDS * WIDTH)
    least = np.full(len(a), np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), CHUNK):
        least = np.minimum(least, (hashes[at : at + CHUNK, None] * a + b).min(axis=0))
    rows = (least >> np.uint64(32)).astype("<u4").reshape(BANDS, WIDTH)
    return [xxhash.xxh64_intdigest(r.tobytes(), i) - (1 << 63) for i, r in enumerate(rows)]


def similarity(x: np.ndarray, y: np.ndarray) -> float:
    """Jaccard similarity of two sets, each in an array without repeats."""
    both = np.sort(np.concatenate([x, y]))
    common = np.count_nonzero(both[1:] == both[:-1])
    return common / (len(both) - common) if len(both) else 1.0


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """batches in parts of ROWS rows, so that few texts' hashes are held at once; what Arrow holds back is given up in the end."""
    try:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                yield batch.slice(at, ROWS)
    finally:
        pa.default_memory_pool().release_unused()


def described(rows: DataFrame, shingle: int, seed: int) -> DataFrame:
    """rows (key, node, text) as (key, node, fp, shape, bands); shape is equal for equal sets of shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            prints, shapes, bands = [], [], []
            for x in batch.column(2):
                hashes = shingle_hashes(x.as_buffer().to_pybytes() if x.is_valid else b"", shingle, seed)
                own = np.unique(hashes)
                prints.append(print_of(hashes))
                shapes.append(xxhash.xxh128_digest(own.tobytes()))
                bands.append(bands_of(own))
            columns = [pa.array(np.array(prints, dtype=np.uint64).view(np.int64)), pa.array(shapes, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["key", "node", "fp", "shape", "bands"])

    node = rows.schema["node"].dataType.simpleString()
    return rows.select("key", "node", "text").mapInArrow(run, f"key binary, node {node}, fp bigint, shape binary, bands array<bigint>")


def shingle_sets(rows: DataFrame, shingle: int, seed: int) -> DataFrame:
    """rows (key, node, text) as (node, shingles): the different hashes of a text's shingles, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [np.unique(shingle_hashes(x.as_buffer().to_pybytes() if x.is_valid else b"", shingle, seed)).astype("<u8").tobytes() for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["node", "shingles"])

    return rows.select("node", "text").mapInArrow(run, f"node {rows.schema['node'].dataType.simpleString()}, shingles binary")


def read_set(value: pa.BinaryScalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), dtype="<u8")


def judged(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """pairs (a, b) with similar: whether their texts' similarity is at least least. One node may stand in most pairs."""
    side = lambda name, shingles: nodes.select(F.col("node").alias(name), F.col("shingles").alias(shingles))
    both = spread_join(spread_join(pairs, side("b", "y"), "b"), side("a", "x"), "a").select("a", "b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            similar = [similarity(read_set(x), read_set(y)) >= least for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(similar, pa.bool_())], names=["a", "b", "similar"])

    kind = nodes.schema["node"].dataType.simpleString()
    return both.mapInArrow(run, f"a {kind}, b {kind}, similar boolean")


def leaders(rows: DataFrame, least: float) -> DataFrame:
    """Edges (a, b) within buckets of rows (bucket, node, shingles): each row with the first leader that it is like; others lead.

    A bucket's rows pass by in order, and only its leaders, which are unlike each other, are held.
    """
    kind = rows.schema["node"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, heads = None, []
        for batch in batches:
            a, b = [], []
            for i, (at, shingles) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2), strict=True)):
                if at != bucket:
                    bucket, heads = at, []
                own = read_set(shingles)
                head = next((node for node, other in heads if similarity(own, other) >= least), None)
                if head is None:
                    heads.append((batch.column(1)[i], own.copy()))
                else:
                    a.append(head.as_py())
                    b.append(i)
            node = batch.schema.field(1).type
            yield pa.RecordBatch.from_arrays([pa.array(a, node), batch.column(1).take(pa.array(b, pa.int64()))], names=["a", "b"])

    ordered = rows.select("bucket", "node", "shingles").repartition("bucket").sortWithinPartitions("bucket", "node")
    return ordered.mapInArrow(run, f"a {kind}, b {kind}")


def similar_links(scratch: Scratch, nodes: DataFrame, texts: DataFrame, shingle: int, seed: int, least: float) -> DataFrame:
    """Edges (a, b) between nodes (node, fp, bands), each verified by the shingles of texts (key, node, text).

    Fingerprints at two bits or fewer are candidates, and so is each member of a bucket with its first one,
    which may be like most of them. What is not stays in the bucket without it and is compared with the first
    of what is left; what is left then is few, and each is compared with those before it that are unlike each
    other. So pairs of one bucket are never made.
    """
    prints = scratch.write("prints", nodes.groupBy("fp").agg(F.min("node").alias("node")))
    alike = spread_join(nodes.select("fp", F.col("node").alias("b")), prints.withColumnRenamed("node", "a"), "fp").filter("a != b").select("a", "b")
    near = links(prints).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    first = scratch.write("pairs0", alike.union(near).distinct())
    buckets = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket")
    left = scratch.write("bucket0", spread_join(buckets, shared, "bucket"))
    asked = left.select("node").union(first.select(F.col("a").alias("node"))).union(first.select(F.col("b").alias("node"))).distinct()
    # Few texts are candidates: a filter keeps the others from moving. Rows that repeat id and text have one node.
    asked = scratch.write("asked", asked.select("node", "node.key"))
    some = maybe_among(texts, asked, "key", bits_for(asked.count()))
    sets = scratch.write("sets", spread_join(shingle_sets(some, shingle, seed), asked.select("node"), "node").dropDuplicates(["node"]))
    known = scratch.write("known0", judged(first, sets, least))
    for turn in range(1, ROUNDS + 1):
        firsts = left.groupBy("bucket").agg(F.min("node").alias("a"))
        pairs = scratch.write(f"asked{turn}", spread_join(left, firsts, "bucket").filter("node != a").select("bucket", "a", F.col("node").alias("b")))
        new = spread_join(pairs.select("a", "b").distinct(), known.select("a", "b", F.lit(True).alias("_known")), ["a", "b"], "left").filter("_known is null").select("a", "b")
        known = known.union(scratch.write(f"known{turn}", judged(new, sets, least)))
        unlike = known.filter("not similar").select("a", "b")
        left = scratch.write(f"bucket{turn}", spread_join(pairs, unlike, ["a", "b"]).select(F.col("b").alias("node"), "bucket"))
    several = left.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket")
    rest = leaders(spread_join(spread_join(left, several, "bucket"), sets, "node"), least)
    return known.filter("similar").select("a", "b").union(rest).distinct()


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, least: float = 0.8, seed: int = 42) -> DataFrame:
    """docs less its near-duplicates: one row of each group stays, with all its columns.

    Texts are similar when they share at least the part least of their different shingles, of shingle words
    each with A-Z in lower case (a shorter text is one shingle); a group is what verified links connect. Null
    texts and those without words are equal to each other. Candidates are texts whose SimHash prints differ in
    two bits or fewer (covering hashing, as simhash_components finds them) or which agree in one of BANDS
    bands of minima; the latter are found with a probability of 0.95 at a similarity of 0.8, and of 0.999 at
    0.87. A pair is verified by all of its shingles.

    The row with the smallest id stays, null ids coming last; of rows with one id and different texts the one
    with the smallest hash of both; of rows that repeat id and text any one. Rows are told apart by id and
    text, so that a text stays whatever becomes of another one under its id. An empty table gives no rows.
    Texts with equal sets of shingles are gathered to their first row before anything is compared.
    """
    scratch = Scratch(docs.sparkSession)
    key = document_key(F.col(id_col), F.col(text_col))
    order = F.struct(F.col("id").isNull().alias("last"), "id", "key")
    texts = docs.select(F.col(id_col).alias("id"), key.alias("key"), F.col(text_col).cast("string").alias("text")).select("key", order.alias("node"), "text")
    rows = scratch.write("rows", described(texts, shingle, seed))
    firsts = scratch.write("firsts", rows.groupBy("shape").agg(F.min("node").alias("first")))
    own = spread_join(rows, firsts, "shape").filter("node = first").dropDuplicates(["shape"])
    nodes = scratch.write("nodes", own.select("node", "fp", "bands"))
    groups = connected_components(similar_links(scratch, nodes, texts, shingle, seed, least))
    # A first row stays unless its group has an earlier one; of other rows none does.
    gone = groups.filter("node != component").select("node")
    stays = spread_join(firsts.select(F.col("first").alias("node")), gone.withColumn("_gone", F.lit(True)), "node", "left").filter("_gone is null").select("node.key")
    times = rows.groupBy("key").agg(F.count("*").alias("times"))
    kept = spread_join(times, stays, "key")
    keyed = docs.select(F.struct("*").alias("doc"), key.alias("key"))
    kept = spread_join(keyed, kept, "key")
    once, again = kept.filter("times = 1"), kept.filter("times > 1").dropDuplicates(["key"])
    return once.unionByName(again).select("doc.*")
