"""How quality filters interact: what each of them removes, alone, after others and in every order."""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, Scratch, spread_join

FILTERS = "ABCDE"
NEVER = 1 << 20


def text_failures(text: Column) -> list[Column]:
    """Failures of A (under 200 words), B (under half of the words differ), C (over 2 % capitals) and D (one of #$%&*|)."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return [F.size(words) < 200, 100 * F.size(F.array_distinct(words)) < 50 * F.size(words), 100 * capitals > 2 * F.length(text), text.rlike(r"[#$%&*|]")]


def failure_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(part, mask, n, good, toxic): documents of each source by the set of filters that they fail, at most 32 rows a source.

    Bit i of mask is filter i of FILTERS. Texts are compared by SHA-256.
    """
    scratch = Scratch(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    bits = [fails.cast("int") * (1 << i) for i, fails in enumerate(text_failures(F.col("text")))]
    rows = scratch.write("rows", rows.select("doc_id", "part", sum(bits[1:], bits[0]).alias("mask"), F.unhex(F.sha2("text", 256)).alias("sha")))
    copies = rows.groupBy("sha").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("sha", "first")
    # A row without an id comes after all that have one.
    later = F.coalesce(F.col("doc_id") > F.col("first"), F.col("first").isNotNull())
    judged = spread_join(rows, copies, "sha", "left").select("doc_id", "part", (F.col("mask") + later.cast("int") * 16).alias("mask"))
    marks = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    marked = spread_join(judged, marks.filter("good = 1 or toxic = 1"), "doc_id", "left")
    return marked.groupBy("part", "mask").agg(F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))


def removal_steps(k: int) -> tuple[np.ndarray, np.ndarray]:
    """(orders, steps): all orders of k filters, and the step at which each order removes each mask, NEVER or later for none.

    The min-plus product of the masks (0 where a filter fails, NEVER where it does not) and of the inverse
    orders (the step of each filter): the least sum over filters is the first step that a mask fails.
    """
    orders = np.array(list(permutations(range(k))), dtype=np.int64)
    place = np.empty_like(orders)
    np.put_along_axis(place, orders, np.arange(1, k + 1)[None, :], axis=1)
    masks = np.where(np.arange(1 << k)[:, None] >> np.arange(k) & 1, 0, NEVER)
    return orders, (masks[:, None, :] + place[None, :, :]).min(axis=2)


def interactions(counts: np.ndarray, k: int) -> dict[str, np.ndarray]:
    """Per order and step (rows of orders x k): the audit's columns. counts: (masks, 3), all documents, good and toxic ones."""
    orders, steps = removal_steps(k)
    gone = np.zeros((3, len(orders), k + 2), dtype=np.int64)
    at = np.broadcast_to(np.arange(len(orders)), steps.shape)
    for w in range(3):
        np.add.at(gone[w], (at, np.minimum(steps, k + 1)), counts[:, w, None])  # a step beyond the last: never removed
    removed, good, toxic = gone[:, :, 1 : k + 1]
    fails = np.arange(1 << k)[:, None] >> np.arange(k) & 1
    failing = (fails * counts[:, :1]).sum(axis=0)
    alone = counts[1 << np.arange(k), 0]
    shapley = np.zeros(k, dtype=np.int64)
    np.add.at(shapley, orders, removed)
    kept = counts[:, 0].sum() - removed.cumsum(axis=1)
    columns = {"kept": kept, "removed": removed, "redundant": failing[orders] - removed, "unique_fails": alone[orders], "good_lost": good, "toxic_lost": toxic, "shapley": shapley[orders]}
    return {name: x.ravel() for name, x in columns.items()}


def filter_audit(failures: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of all filters and step: part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley. failures: (part, mask, n, good, toxic), as failure_counts gives them.

    A step removes what fails its filter and is still there (removed); what failed it and went earlier is
    redundant. unique_fails fail this filter alone, in any order. shapley is what the filter removes, added
    up over all orders. good_lost and toxic_lost are of the removed. Every part has all rows, zeros too.
    """
    k = len(filters)
    names = ["".join(filters[i] for i in order) for order in removal_steps(k)[0].tolist()]

    def audited(pdf: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros((1 << k, 3), dtype=np.int64)
        np.add.at(counts, pdf["mask"].to_numpy(), pdf[["n", "good", "toxic"]].to_numpy(dtype=np.int64))
        head = {"part": pdf["part"].iloc[0], "filter_order": np.repeat(names, k), "step": np.tile(np.arange(1, k + 1, dtype=np.int32), len(names))}
        return pd.DataFrame(head | interactions(counts, k))

    columns = "kept bigint, removed bigint, redundant bigint, unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"
    return failures.groupBy("part").applyInPandas(audited, f"part string, filter_order string, step int, {columns}")


def audit_filters(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """filter_audit of the five filters over docs, by source.

    Words are runs of anything but ASCII white space, as they are written. A: under 200 words; B: fewer than
    half of them differ; C: more than 2 % of the characters are A-Z; D: one of #$%&*| occurs; E: a smaller id
    has the same text, in any source and whether or not that row is removed. A null text counts as empty, a
    null source as the empty part. A null id is larger than all others; rows with one id and text are no
    copies of each other. Labels of one id count if any of its rows has them; ids without a label are neither
    good nor toxic, and labels of other ids are not read. Repeated rows count each. An empty table gives no
    rows. Other columns are not read.
    """
    return filter_audit(failure_counts(docs, labels, id_col, text_col, source_col))


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
firsts AS (SELECT t, min(doc_id) AS first FROM d GROUP BY t),
marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
judged AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words), 100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t),
     regexp_matches(t, '[#$%&*|]'), coalesce(d.doc_id > first, first IS NOT NULL)] AS fails
  FROM d JOIN firsts USING (t) LEFT JOIN marks ON marks.doc_id = d.doc_id),
counts AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM judged GROUP BY part, fails),
places AS (SELECT unnest(range(1, 6)) AS i),
orders AS (
  SELECT [a.i, b.i, c.i, e.i, f.i] AS o FROM places a, places b, places c, places e, places f
  WHERE len(list_distinct([a.i, b.i, c.i, e.i, f.i])) = 5),
steps AS (SELECT counts.*, o, list_position(list_transform(o, lambda i: fails[i]), true) AS gone, len(list_filter(fails, lambda x: x)) AS n_fails FROM counts, orders),
sums AS (
  SELECT part, o, s.i AS step, o[s.i] AS filter, coalesce(sum(n) FILTER (gone IS NULL OR gone > s.i), 0) AS kept, coalesce(sum(n) FILTER (gone = s.i), 0) AS removed,
    coalesce(sum(n) FILTER (fails[o[s.i]] AND gone < s.i), 0) AS redundant, coalesce(sum(n) FILTER (fails[o[s.i]] AND n_fails = 1), 0) AS unique_fails,
    coalesce(sum(good) FILTER (gone = s.i), 0) AS good_lost, coalesce(sum(toxic) FILTER (gone = s.i), 0) AS toxic_lost
  FROM steps, places s GROUP BY part, o, s.i)
SELECT part, list_reduce(list_transform(o, lambda i: substr('ABCDE', i, 1)), lambda x, y: x || y) AS filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
  redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  sum(removed) OVER (PARTITION BY part, filter)::BIGINT AS shapley FROM sums
"""
