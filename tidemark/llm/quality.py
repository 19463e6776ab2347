"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import id_bucket

SHAPE = bytes.maketrans(bytes(range(256)), b"".join(b"a" if 97 <= i <= 122 or i >= 128 else b"A" if 65 <= i <= 90 else b"0" if 48 <= i <= 57 else bytes([i]) for i in range(256)))
RUNS = re.compile(rb"(.)\1+", re.S)
REMEMBERED = 200_000


class Features:
    """Indices of a text's n-grams: words, word pairs, shapes, and shape pairs with whether the words repeat."""

    def __init__(self, bits: int):
        self.size, self.known = 1 << bits, {}

    def of_word(self, word: bytes) -> int:
        shape = RUNS.sub(rb"\1\1", word.translate(SHAPE))
        return zlib.crc32(word) | (zlib.crc32(shape) & 0x7FFFFFFF) << 32

    def __call__(self, text: bytes) -> np.ndarray:
        words, known = text.split(), self.known
        if not words:
            return np.array([zlib.crc32(b"\0empty") % self.size])
        if missing := [w for w in set(words) if w not in known]:
            if len(known) > REMEMBERED:
                known.clear()
                missing = set(words)
            known.update((w, self.of_word(w)) for w in missing)
        both = np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words)).view(np.uint64)
        word, shape = both & np.uint64(0xFFFFFFFF), both >> np.uint64(32)
        same = (word[1:] == word[:-1]).astype(np.uint64)
        mixed = [
            word * np.uint64(0x9E3779B97F4A7C15),
            (word[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + word[1:]) * np.uint64(0x9E3779B97F4A7C15),
            (shape + np.uint64(1 << 40)) * np.uint64(0x165667B19E3779F9),
            ((shape[:-1] * np.uint64(0x27D4EB2F165667C5) + shape[1:]) * np.uint64(4) + same + np.uint64(2)) * np.uint64(0x165667B19E3779F9),
        ]
        return (np.concatenate(mixed) >> np.uint64(64 - self.size.bit_length() + 1)).astype(np.int64)


#: A text's n-grams weigh this much together, whatever its length.
MASS = 8.0


def sigmoid(z: float) -> float:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def train_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], size: int, epochs: int, alpha: float, beta: float, l1: float, l2: float) -> np.ndarray:
    """Weights, the bias last, after epochs of follow-the-regularised-leader (proximal) over rows (indices, values, label)."""
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(at: np.ndarray) -> np.ndarray:
        pull = z[at]
        return np.where(np.abs(pull) <= l1, 0.0, -(pull - np.sign(pull) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))

    sparse = [(np.append(at, size), np.append(value, 1.0), label) for at, value, label in rows]
    for _ in range(epochs):
        for at, value, label in sparse:
            w = weights(at)
            g = (sigmoid(w @ value) - label) * value
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
    return weights(np.arange(size + 1))


def train(rows: DataFrame, labels: DataFrame, label_col: str, max_rows: int, max_bytes: int, shards: int, bits: int, epochs: int, alpha: float, beta: float, l1: float, l2: float) -> np.ndarray:
    """Mean of the weights of shards of a bounded sample: the labelled texts with the smallest hashes, max_rows and about max_bytes of them."""
    usable = labels.select(F.col("doc_id"), F.col(label_col).cast("int").alias("label")).filter(f"doc_id is not null and label in (0, 1) and {_HELD_OUT} <> 1")
    sample = usable.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    labelled = rows.select("doc_id", "text").join(F.broadcast(sample), "doc_id").withColumn("key", F.xxhash64("text"))
    # An id may have many rows: the bound is one of different texts, of which a few numbers each are sorted.
    sizes = labelled.groupBy("doc_id", "key").agg(F.max(F.coalesce(F.octet_length("text"), F.lit(0))).alias("bytes"))
    first = (F.xxhash64("doc_id"), F.col("doc_id"), F.col("key"))
    bounded = sizes.orderBy(*first).limit(max_rows)
    before = F.coalesce(F.sum("bytes").over(Window.orderBy(*first).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chosen = bounded.withColumn("before", before).filter(F.col("before") < max_bytes).select("doc_id", "key")
    texts = labelled.join(F.broadcast(chosen), ["doc_id", "key"])
    shard = F.pmod(F.xxhash64("doc_id", "key", F.lit(3)), F.lit(shards))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each text as the indices of its features and how often they occur, so that no text is shuffled."""
        features = Features(bits)
        for batch in batches:
            found = [np.unique(features(x.as_buffer().to_pybytes() if x.is_valid else b""), return_counts=True) for x in batch.column(4)]
            packed = [pa.array([f[k].astype("<u4").tobytes() for f in found], pa.binary()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *packed], names=["doc_id", "key", "label", "shard", "at", "count"])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(order=[zlib.crc32(str(i).encode()) for i in pdf.doc_id]).sort_values(["order", "doc_id", "key"])
        examples = []
        for at, count, y in zip(pdf["at"], pdf["count"], pdf["label"], strict=True):
            n = np.frombuffer(count, dtype="<u4")
            examples.append((np.frombuffer(at, dtype="<u4").astype(np.int64), n * (MASS / n.sum()), int(y)))
        w = train_ftrl(examples, 1 << bits, epochs, alpha, beta, l1, l2)
        at = np.flatnonzero(w)
        return pd.DataFrame({"shard": pdf["shard"].iloc[0], "feature": at, "weight": w[at]})

    kind = rows.schema["doc_id"].dataType.simpleString()
    found = texts.select("doc_id", "key", "label", shard.alias("shard"), "text")
    found = found.mapInArrow(hashed, f"doc_id {kind}, key bigint, label int, shard bigint, at binary, count binary").dropDuplicates(["doc_id", "key"])
    parts = found.groupBy("shard").applyInPandas(fit, "shard bigint, feature bigint, weight double")
    # In the order of the shards, so that a rerun adds the same numbers in the same order.
    weights = F.transform(F.array_sort(F.collect_list(F.struct("shard", "weight"))), lambda x: x["weight"])
    out = np.zeros((1 << bits) + 1, dtype=np.float64)
    for r in parts.groupBy("feature").agg((F.aggregate(weights, F.lit(0.0), lambda a, b: a + b) / F.lit(shards)).alias("weight")).toLocalIterator():
        out[r.feature] = r.weight
    return out


_HELD_OUT = "crc32(cast(cast(doc_id as string) as binary)) % 3"


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_rows: int = 20_000,
    max_bytes: int = 1 << 28,
    shards: int = 4,
    bits: int = 18,
    epochs: int = 6,
    alpha: float = 0.5,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.1,
) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    Learns from a bounded sample of labelled documents outside the fold (crc32 of the id modulo 3 is not 1):
    the max_rows different texts of an id with the smallest hashes, those within max_bytes of text (and the one
    that reaches it), in shards that train side by side and whose weights are averaged. Rows that repeat id and
    text are learned once.
    A whole text's n-grams (words and their shapes, alone and in pairs) are hashed to 2^bits weights; the
    score is the logistic of their mean weight and the bias, a sparse dot product.

    A null or empty text has one feature of its own and gets a score too. Labels other than 0 and 1, and
    label rows without an id, are not learned; of repeated label rows the larger label counts. Without any
    label all scores are 0.5. A null id is hashed as empty text. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    labels = labels.select(F.col(id_col).alias("doc_id"), label_col)
    weights = train(rows, labels, label_col, max_rows, max_bytes, shards, bits, epochs, alpha, beta, l1, l2)
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, w = Features(bits), shared.value
        for batch in batches:
            score = np.zeros(batch.num_rows)
            for i, x in enumerate(batch.column(2)):
                score[i] = sigmoid(w[features(x.as_buffer().to_pybytes() if x.is_valid else b"")].mean() * MASS + w[-1])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = rows.select("doc_id", (id_bucket(F.col("doc_id"), 3) == 1).alias("held_out"), "text")
    return out.mapInArrow(predict, f"doc_id {kind}, held_out boolean, score double, predicted int")
