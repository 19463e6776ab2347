"""Exact top-k inner products with multi-resolution segment statistics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

#: Rows of a query block on average, and bytes of the blocks that are broadcast and searched in one pass.
QUERY_BLOCK, PASS_BYTES = 16_384, 64_000_000
#: Pairs whose products are taken at once, and rows of a block that give its queries a first score to beat.
PAIRS, SEEDS = 1 << 15, 1024
#: Segments at each resolution, coarse to fine.
RESOLUTIONS = (4, 16)
LONGS = -(1 << 63), (1 << 63) - 1


class Rows:
    """Rows of one length: ids, their integers as doubles, and which are too large for products in 64 bits.

    The integers of large rows are taken from the values themselves, as Python's.
    """

    def __init__(self, ids: np.ndarray, values: np.ndarray, scale: float):
        self.ids, self.values, self.scale = ids, values, scale
        with np.errstate(over="ignore"):
            self.x = np.floor(values * scale)
        limit = np.sqrt(2.0**62 / max(1, values.shape[1]))
        self.large = (np.abs(self.x) > limit).any(axis=1)

    def exact(self, at: int) -> list[int]:
        return [int(np.floor(v * self.scale)) if abs(v) < 1e300 else int(v) * int(self.scale) for v in self.values[at].tolist()]

    def part(self, at: slice) -> Rows:
        return Rows(self.ids[at], self.values[at], self.scale)


def integer_rows(ids: pd.Series, vectors: pd.Series, scale: float) -> dict[int, Rows]:
    """length -> the rows that take part."""
    found: dict[int, tuple[list, list]] = {}
    for i, v in zip(ids, vectors, strict=True):
        if v is None or i is None or i != i:
            continue
        x = np.array([np.nan if c is None else c for c in v] if getattr(v, "dtype", object) == object else v, dtype=np.float64)
        if np.isfinite(x).all():
            rows = found.setdefault(len(x), ([], []))
            rows[0].append(int(i))
            rows[1].append(x)
    return {n: Rows(np.array(a, dtype=np.int64), np.array(b).reshape(len(a), n), scale) for n, (a, b) in found.items()}


def segment_statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of a vector's segments, each times the root of the segment's length.

    The distance of two vectors is at least that of these statistics, segment by segment, and as both have
    the vectors' norms, their inner product is at most that of the statistics.
    """
    if not x.shape[1]:
        return np.zeros((len(x), 1))
    parts = np.array_split(x, min(segments, x.shape[1]), axis=1)
    root = [np.sqrt(p.shape[1]) for p in parts]
    return np.stack([r * p.mean(axis=1) for r, p in zip(root, parts, strict=True)] + [r * p.std(axis=1) for r, p in zip(root, parts, strict=True)], axis=1)


class Searcher:
    """The best k rows for each query of a block, among the candidates shown so far."""

    def __init__(self, rows: Rows, k: int, floor: np.ndarray | None = None):
        self.rows, self.k = rows, k
        with np.errstate(over="ignore", invalid="ignore"):
            self.coarse = [segment_statistics(rows.x, s) for s in RESOLUTIONS]
            self.norm = np.linalg.norm(rows.x, axis=1)
        self.floor = np.full(len(rows.ids), -np.inf) if floor is None else floor
        self.best = np.zeros((0, 3), dtype=object)  # query, score, id

    def show(self, rows: Rows) -> None:
        with np.errstate(over="ignore", invalid="ignore"):
            norm = np.linalg.norm(rows.x, axis=1)
            coarse = [segment_statistics(rows.x, s) for s in RESOLUTIONS]
            step = max(1, 2_000_000 // max(1, len(self.rows.ids)))
            for at in range(0, len(rows.ids), step):
                part = slice(at, at + step)
                # Bounds are rounded: the slack is far above their error. What is no number rules nothing out.
                slack = 1e-9 * self.norm[:, None] * norm[None, part] + 0.5
                pairs = np.argwhere(~(self.coarse[0] @ coarse[0][part].T + slack < self.floor[:, None]))
                found = [self.exact(pairs[i : i + PAIRS], rows.part(part), coarse[1][part], slack) for i in range(0, len(pairs), PAIRS)]
                self.keep(found)

    def exact(self, pairs: np.ndarray, rows: Rows, fine: np.ndarray, slack: np.ndarray) -> np.ndarray:
        """(query, score, id) of the pairs that the finer bound leaves; scores are integers without a limit."""
        q, x = pairs.T
        fits = ~(np.einsum("ij,ij->i", self.coarse[1][q], fine[x]) + slack[q, x] < self.floor[q]) & (rows.ids[x] != self.rows.ids[q])
        q, x = q[fits], x[fits]
        large = self.rows.large[q] | rows.large[x]
        score = np.zeros(len(q), dtype=np.int64 if not large.any() else object)
        small = np.flatnonzero(~large)
        score[small] = np.einsum("ij,ij->i", self.rows.x[q[small]].astype(np.int64), rows.x[x[small]].astype(np.int64))
        for i in np.flatnonzero(large).tolist():
            score[i] = sum(a * b for a, b in zip(self.rows.exact(q[i]), rows.exact(x[i]), strict=True))
        if not large.any():
            enough = score >= self.floor[q]
            q, x, score = q[enough], x[enough], score[enough]
        return np.stack([q, score, rows.ids[x]], axis=1)

    def keep(self, found: list[np.ndarray]) -> None:
        if not any(len(f) for f in found):
            return
        rows = np.concatenate([self.best, *found])
        try:
            rows = rows.astype(np.int64)
            rows = rows[np.lexsort((rows[:, 2], -rows[:, 1], rows[:, 0]))]
        except OverflowError:
            rows = np.array(sorted(rows.tolist(), key=lambda r: (r[0], -r[1], r[2])), dtype=object)
        of = rows[:, 0].astype(np.int64)
        first = np.searchsorted(of, np.arange(len(self.rows.ids)))
        self.best = rows[np.arange(len(rows)) - first[of] < self.k]
        full = first + self.k - 1
        has = full < len(rows)
        has[has] = of[full[has]] == np.flatnonzero(has)
        self.floor = self.floor.copy()
        self.floor[has] = np.maximum(self.floor[has], [as_double(v) for v in rows[full[has], 1].tolist()])


def as_double(n: int) -> float:
    """A double at or below an integer, by less than the bounds' slack."""
    try:
        return float(n)
    except OverflowError:
        return -np.inf


def order_key(n: int) -> str:
    """A text that sorts as the integer does, among those that a long cannot hold; empty for all others."""
    if LONGS[0] < n < LONGS[1]:
        return ""
    digits = str(abs(n))
    return f"2{len(digits):06d}{digits}" if n > 0 else f"1{999_999 - len(digits):06d}" + digits.translate(str.maketrans("0123456789", "9876543210"))


def exact_top_k(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 50, k: int = 5, scale: float = 256.0) -> DataFrame:
    """Per query (rows whose id is divisible by every) the k rows of highest score: query_id, rank, vec_id, score.

    Components become floor(scale * x); the score is the inner product of the integers, ties go to the
    smaller id. Candidates are all rows but those with the query's own id; a query with fewer candidates
    gets all of them. Rows take no part whose id or vector is null, or whose vector has null or non-finite
    components; only vectors of equal length are compared, and empty ones score 0. Ranks follow the exact
    integers, of any size; the column score, a long, holds its largest or smallest value beyond its range. A
    repeated id is one query (its first vector in order) and as many candidates. Empty tables give no rows.

    Queries are written once, in blocks of about QUERY_BLOCK. Every pass over the candidates takes as many
    blocks as PASS_BYTES hold, which are broadcast: all of them, unless they are many. Bounds from the means
    and deviations of 4 and then 16 segments rule pairs out; only survivors get exact products. Some of a
    block's own rows give each query a first score to beat, so that a task returns only rows that may be
    among the best, whatever the number of tasks.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector")).filter("vec_id is not null and vector is not null")
    queries = scratch.write("queries", rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vector").alias("vector")))
    n_queries, most = queries.agg(F.count("*"), F.coalesce(F.sum(F.size("vector").cast("long")), F.lit(0))).first()
    passes = max(1, -(-8 * most // PASS_BYTES))
    blocks = max(passes, -(-n_queries // QUERY_BLOCK))
    blocked = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).repartition("block").write
    blocked.partitionBy("block").parquet(f"{scratch.folder}/blocks")
    for p in range(passes):
        own = list(range(p * blocks // passes, (p + 1) * blocks // passes))
        pdf = spark.read.schema("vec_id long, vector array<double>, block int").parquet(f"{scratch.folder}/blocks").filter(F.col("block").isin(own)).orderBy("vec_id").toPandas() if n_queries else None
        searches = []
        for _, block in pdf.groupby("block") if n_queries else ():
            for n, found in integer_rows(block["vec_id"], block["vector"], scale).items():
                start = Searcher(found, k)
                start.show(found.part(slice(0, SEEDS)))
                searches.append((n, found.ids, found.values, start.floor))
        shared = spark.sparkContext.broadcast(searches)

        def search(frames: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            found = [(n, Searcher(Rows(ids, values, scale), k, floor)) for n, ids, values, floor in shared.value]
            for pdf in frames:
                shown = integer_rows(pdf["vec_id"], pdf["vector"], scale)
                for n, s in found:
                    if n in shown:
                        s.show(shown[n])
            for _, s in found:
                score = s.best[:, 1].tolist()
                yield pd.DataFrame(
                    {
                        "query_id": s.rows.ids[s.best[:, 0].astype(np.int64)],
                        "vec_id": s.best[:, 2].astype(np.int64),
                        "score": np.array([min(max(v, LONGS[0]), LONGS[1]) for v in score], dtype=np.int64),
                        "beyond": pd.Series([order_key(v) for v in score], dtype=object),
                    }
                )

        rows.mapInPandas(search, "query_id bigint, vec_id bigint, score bigint, beyond string").write.mode("append").parquet(f"{scratch.folder}/found")
        shared.destroy()
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("beyond"), "vec_id")
    found = spark.read.schema("query_id bigint, vec_id bigint, score bigint, beyond string").parquet(f"{scratch.folder}/found")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""
