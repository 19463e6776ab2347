"""SimHash near-duplicates by covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import cut, spread_join
from .components import connected_components

BITS = 64


def shingle_hashes(text: bytes, shingle: int, seed: int) -> np.ndarray:
    """XXH64 of the word shingles of a UTF-8 text, A-Z in lower case, repeats included; a shorter text is one shingle."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxh64_intdigest(joined, seed)], dtype=np.uint64)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    begins = (ends - lengths)[: len(words) - shingle + 1].tolist()
    return np.array([xxh64_intdigest(joined[a:b], seed) for a, b in zip(begins, ends[shingle - 1 :].tolist(), strict=True)], dtype=np.uint64)


def print_of(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes; zero without hashes."""
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8)
        ones += np.unpackbits(part, bitorder="little").reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of the word shingles of a UTF-8 text; zero without words."""
    return print_of(shingle_hashes(text, shingle, seed))


def fingerprints(rows: DataFrame, shingle: int, seed: int) -> DataFrame:
    """rows with the column text replaced by fp, its fingerprint; whole texts, hashed batch by batch."""
    others = [c for c in rows.columns if c != "text"]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (x.as_buffer().to_pybytes() if x.is_valid else b"" for x in batch.column(len(others)))
            prints = np.fromiter((fingerprint(x, shingle, seed) for x in texts), dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(prints.view(np.int64))], names=[*others, "fp"])

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in others)
    return rows.select(*others, "text").mapInArrow(hashed, f"{kinds}, fp bigint")


def covering_masks(radius: int) -> list[int]:
    """2^(radius+1)-1 masks: any two values that differ in radius bits or fewer agree under one of them.

    Bit i gets a non-zero vector of radius+1 bits; mask v holds the bits whose vector has an odd product
    with v. Up to radius vectors always have a non-zero v that is orthogonal to all of them.
    """
    n = (1 << (radius + 1)) - 1
    return [sum(1 << i for i in range(BITS) if ((i % n + 1) & v).bit_count() % 2) for v in range(1, n + 1)]


def signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def links(nodes: DataFrame) -> DataFrame:
    """Edges (a, b) between nodes (node, fp) with distinct fp that connect all pairs at 2 or fewer bits.

    In each covering table, fingerprints alone in their bucket drop out. The others are verified without
    pairing a bucket's members: each emits itself and its neighbours at one bit that the mask leaves free,
    and equal values link. Two that share a value are at most two bits apart, and two that are so far apart
    share one in the table where they collide. At most 65 fingerprints share a value, so groups are bounded.
    """
    masks = covering_masks(2)
    keyed = nodes.select("node", "fp", F.posexplode(F.array(*[F.xxhash64(F.lit(v), F.col("fp").bitwiseAND(F.lit(signed(m)))) for v, m in enumerate(masks)])).alias("v", "bucket"))
    shared = keyed.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket")
    survivors = spread_join(keyed, shared, "bucket")
    free = F.array(*[F.array(*[F.lit(signed(b)) for b in [0] + [1 << i for i in range(BITS) if not m >> i & 1]]) for m in masks])
    near = survivors.select(F.struct("node", "fp").alias("at"), F.explode(F.element_at(free, F.col("v") + 1)).alias("flip"))
    near = near.select("at", F.col("at.fp").bitwiseXOR(F.col("flip")).alias("value"))
    groups = near.groupBy("value").agg(F.array_sort(F.collect_set("at")).alias("members")).filter("size(members) > 1")
    return groups.select(F.expr("members[0].node").alias("a"), F.explode(F.expr("slice(members, 2, size(members) - 1)")).alias("b")).select("a", "b.node").toDF("a", "b").distinct()


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    Fingerprints link when they differ in 2 bits or fewer; component_id is the smallest doc_id reachable over
    links, the row's own included. Texts without words (null or empty too) have fingerprint zero and link as
    any other. A text of fewer words than a shingle is one shingle. Rows that repeat an id count as one
    document per text. A row with a null id links nothing: it gets the component of its fingerprint, or
    null where no row with an id has it. An empty table gives no rows; other columns are not read.

    Equal fingerprints are first gathered to their smallest id, so copies cost one row; the links and the
    components are between those representatives.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    prints = cut(fingerprints(rows, shingle, seed))
    classes = fingerprint_classes(prints.filter("doc_id is not null"))
    out = spread_join(prints, classes, "fp", "left")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def fingerprint_classes(prints: DataFrame) -> DataFrame:
    """(fp, component_id): the smallest doc_id reachable from each fingerprint of prints (doc_id, fp)."""
    nodes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("node")))
    components = connected_components(links(nodes))
    return nodes.join(components, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
