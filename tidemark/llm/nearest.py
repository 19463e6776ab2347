"""Nearest neighbours by a block matrix join: int8 product tiles bound all products, survivors are computed in full."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

#: Queries of a block on average, candidates of a part at least, cells of a tile, and pairs whose products are computed at once.
QUERY_BLOCK, PART, CELLS, PAIRS = 32_768, 8192, 2_000_000, 1 << 14


class Quantised:
    """Vectors of one length and their int8 codes: a vector is scale * code + rest, and only the length of the rest is known."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        self.ids, self.values = ids, values
        x = values.astype(np.float64)
        with np.errstate(over="ignore", invalid="ignore"):
            self.scale = np.abs(x).max(axis=1) / 127
            self.codes = np.rint(x / np.maximum(self.scale, np.finfo(float).tiny)[:, None]).astype(np.int8)
            near = self.codes * self.scale[:, None]
            self.norm, self.near, self.rest = (np.linalg.norm(v, axis=1) for v in (x, near, x - near))

    def part(self, at: slice | np.ndarray) -> Quantised:
        out = object.__new__(Quantised)
        out.__dict__ = {k: v[at] for k, v in self.__dict__.items()}
        return out

    def whole_numbers(self) -> np.ndarray:
        """The codes in a type in which their products are exact: sums of whole numbers below 2^24 are so in float32."""
        return self.codes.astype(np.float32 if self.codes.shape[1] << 14 < 1 << 24 else np.float64)


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of rows, in double precision, added from the first component to the last."""
    with np.errstate(over="ignore", invalid="ignore"):
        return np.add.accumulate(x.astype(np.float64) * y.astype(np.float64), axis=1)[:, -1]


class Heaps:
    """The best k rows for each query of a block among the candidates shown so far: largest product, then smallest id."""

    def __init__(self, queries: Quantised, k: int):
        self.queries, self.k, self.codes = queries, k, queries.whole_numbers()
        self.floor = np.full(len(queries.ids), -np.inf)
        self.best = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))  # query, score, id
        self.found: list[tuple[np.ndarray, ...]] = []

    def show(self, rows: Quantised) -> None:
        step = max(1, CELLS // len(self.queries.ids))
        for at in range(0, len(rows.ids), step):
            self.tile(rows.part(slice(at, at + step)))

    def tile(self, rows: Quantised) -> None:
        """Products of codes bound the products of vectors, as two vectors' rests add at most their lengths times the others'."""
        q = self.queries
        with np.errstate(over="ignore", invalid="ignore"):
            bound = (self.codes @ rows.whole_numbers().T).astype(np.float64)
            bound *= rows.scale
            bound *= q.scale[:, None]
            # The slack is far above what rounding does to the bound.
            error = np.stack([q.rest, q.near, 1e-9 * q.norm], axis=1) @ np.stack([rows.norm, rows.rest, rows.norm])
            new = np.flatnonzero(self.floor == -np.inf)
            if len(new) and len(rows.ids) > self.k:
                # k rows have a product of at least their lower bounds, so that the first tile is no different from later ones.
                least = np.where(rows.ids == q.ids[new, None], -np.inf, bound[new] - error[new])
                least = np.partition(least, -self.k, axis=1)[:, -self.k]
                self.floor[new] = np.where(np.isnan(least), -np.inf, least)
            bound += error
            pairs = np.argwhere(~(bound < self.floor[:, None]))  # what is no number rules nothing out
        for i in range(0, len(pairs), PAIRS):
            a, b = pairs[i : i + PAIRS].T
            a, b = (x[rows.ids[b] != q.ids[a]] for x in (a, b))
            score = products(q.values[a], rows.values[b])
            score[np.isnan(score)] = -np.inf
            enough = score >= self.floor[a]
            self.found.append((a[enough], score[enough], rows.ids[b[enough]]))
        if sum(len(f[0]) for f in self.found) > max(PAIRS, 2 * len(q.ids)):
            self.merge()

    def merge(self) -> None:
        of, score, ids = (np.concatenate(x) for x in zip(self.best, *self.found, strict=True))
        self.found = []
        order = np.lexsort((ids, -score, of))
        of, score, ids = of[order], score[order], ids[order]
        place = np.arange(len(of)) - np.searchsorted(of, of)
        last = place == self.k - 1
        self.floor[of[last]] = np.maximum(self.floor[of[last]], score[last])
        self.best = tuple(x[place < self.k] for x in (of, score, ids))


def vectors_of(batch: pa.RecordBatch, rows: slice) -> tuple[np.ndarray, np.ndarray]:
    """(ids, values) of rows whose vectors have one length."""
    part = batch.slice(rows.start, rows.stop - rows.start)
    values = part.column("vector").flatten().to_numpy(zero_copy_only=False)
    return part.column("vec_id").to_numpy(), values.reshape(part.num_rows, -1)


def without_copies(ids: np.ndarray, values: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that can be among the best k of a query: of equal vectors those with the smallest ids.

    A query passes over rows with its own id, so as many more stay as one id has at most.
    """
    _, same = np.unique(np.ascontiguousarray(values).view(np.dtype((np.void, values.dtype.itemsize * values.shape[1]))).ravel(), return_inverse=True)
    order = np.lexsort((ids, same))
    most = np.unique(np.stack([same, ids]), axis=1, return_counts=True)[1].max()
    place = np.arange(len(order)) - np.searchsorted(same[order], same[order])
    stay = order[place < k + most]
    return ids[stay], values[stay]


def search_tiles(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The best rows of each tile: its queries come first, then its candidates pass by, a batch at a time."""
    at, queries, heaps = None, [], None

    def done() -> Iterator[pa.RecordBatch]:
        if heaps is not None:
            heaps.merge()
            of, score, ids = heaps.best
            yield pa.RecordBatch.from_arrays([pa.array(heaps.queries.ids[of]), pa.array(ids), pa.array(score)], names=["query_id", "vec_id", "score"])

    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("dim", "block", "part", "candidate")], axis=1)
        cuts = np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1
        for first, beyond in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            if first == beyond:
                continue
            *tile, candidate = keys[first].tolist()
            if tile != at:
                yield from done()
                at, queries, heaps = tile, [], None
            ids, values = vectors_of(batch, slice(first, beyond))
            if not candidate:
                queries.append((ids, values))
            elif queries or heaps:
                if heaps is None:
                    heaps = Heaps(Quantised(np.concatenate([i for i, _ in queries]), np.concatenate([v for _, v in queries])), k)
                    queries = []
                heaps.show(Quantised(*without_copies(ids, values, k)))
    yield from done()


def nearest_neighbours(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 20, k: int = 20) -> DataFrame:
    """Per query (rows whose id is divisible by every) the k nearest rows: query_id, rank, vec_id, score.

    Nearest is the largest inner product in double precision, added in the order of components; ties go to
    the smaller id. Candidates are all rows but those with the query's own id; a query with fewer gets all of
    them, and one with none has no rows. Rows take no part whose id or vector is null, or whose vector is
    empty, zero, or has null or non-finite components; only vectors of equal length are compared. A repeated
    id is one query (its first vector in order) and as many candidates. A product that overflows counts as
    infinite, and one that is no number as minus infinity. Empty tables give no rows; other columns are not
    read.

    The search is exact: its recall is 1. Queries are dealt to blocks and candidates to parts; every block meets
    every part in one tile, which holds its queries and sees its candidates pass by. int8 codes give each
    product within a bound, and only pairs that may be among the best so far are computed in full. Candidates move
    once for each block of queries and queries once for each part, of which there are two a task, or fewer
    where parts would have under PART rows; a tile returns k rows a query. With queries in proportion to rows, the pairs bounded and the copies moved grow with the square of the table.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    real = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    kind = "float" if vectors.schema[vector_col].dataType.elementType.simpleString() == "float" else "double"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(f"array<{kind}>").alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.forall("vector", real) & F.exists("vector", lambda x: x != 0)).withColumn("dim", F.size("vector"))
    queries = scratch.write("queries", rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vector").alias("vector")))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    parts = max(1, min(-(-2 * tasks // blocks), -(-rows.count() // PART)))
    dealt = lambda n, *of: F.pmod(F.xxhash64(*of), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # Sides of a query block: it goes to every part, and a candidate to every block.
    left = queries.select(F.size("vector").alias("dim"), dealt(blocks, "vec_id").alias("block"), each(parts).alias("part"), F.lit(False).alias("candidate"), "vec_id", "vector")
    right = rows.select("dim", each(blocks).alias("block"), dealt(parts, "vec_id", "vector").alias("part"), F.lit(True).alias("candidate"), "vec_id", "vector")
    tile = ["dim", "block", "part"]
    tiles = left.unionByName(right).repartition(tasks, *tile).sortWithinPartitions(*tile, "candidate")
    found = tiles.mapInArrow(lambda batches: search_tiles(batches, k), "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_reduce(list_transform(list_zip(q.e, c.e), lambda x: x[1] * x[2]), lambda a, b: a + b) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""
