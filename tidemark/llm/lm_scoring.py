"""Language-model scoring with a hidden Markov model trained by Baum-Welch."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, id_bucket, spread_join

#: The end of a text, as a token that no word equals.
END = " "
ADD = 0.1
#: Tokens of a window in training, and bytes of text that are taken at once.
WINDOW, GROUP = 256, 8_000_000
#: Tokens beyond which a text is cut in segments whose steps are taken side by side.
LONG, SEGMENT = 1 << 16, 1 << 14


class Tokens:
    """The tokens of some texts, found by Arrow: codes of the different ones, one text behind the other."""

    def __init__(self, texts: pa.Array):
        lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
        ends = lists.offsets.to_numpy()
        words = lists.values.slice(ends[0], ends[-1] - ends[0]).dictionary_encode()
        codes = words.indices.to_numpy()
        # White space at an end of a text gives an empty word there.
        empty = words.dictionary.index("").as_py()
        real = codes != empty
        upto = np.concatenate([[0], np.cumsum(real)])[ends - ends[0]]
        n = np.diff(upto)
        self.different = pa.concat_arrays([words.dictionary, pa.array([END])])
        self.sizes = n + 1
        self.text = np.repeat(np.arange(len(n)), self.sizes)
        self.codes = np.full(len(self.text), len(words.dictionary), dtype=np.int64)
        self.codes[np.arange(upto[-1]) + np.repeat(np.arange(len(n)), n)] = codes[real]

    def bytes(self) -> list[bytes]:
        return self.different.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()


def groups(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, Tokens]]:
    """(number of the first row, tokens) of some rows at once."""
    sizes = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + GROUP)))
        yield at, Tokens(batch.column(column).slice(at, end - at))
        at = end


def tail_class(word: bytes, tail_classes: int) -> int:
    return zlib.crc32(word[-3:]) % tail_classes


def token_counts(docs: DataFrame, tail_classes: int) -> DataFrame:
    """(token, c, cls) over all texts; each group of texts is counted before its tokens shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, t in groups(batch, 0):
                n = np.bincount(t.codes, minlength=len(t.different))
                cls = np.fromiter((tail_class(w, tail_classes) for w in t.bytes()), dtype=np.int32, count=len(n))
                some = pa.array(np.flatnonzero(n))
                yield pa.RecordBatch.from_arrays([x.take(some) for x in (t.different, pa.array(n), pa.array(cls))], names=["token", "n", "cls"])

    parts = docs.select("text").mapInArrow(count, "token string, n bigint, cls int")
    return parts.groupBy("token").agg(F.sum("n").alias("c"), F.first("cls").alias("cls"))


@dataclass
class Vocabulary:
    """Emission classes: one for each of the most frequent tokens, and tail classes by a token's last bytes.

    Within a tail class a token's probability is its smoothed share of the class, with room for one unseen.
    """

    head: pa.Array  # the most frequent tokens, in order
    counts: np.ndarray  # theirs
    own: int  # so many of them have a class of their own
    tail_classes: int
    unigram: np.ndarray  # of classes
    log_share: np.ndarray  # log10 of a tail class's denominator

    @property
    def size(self) -> int:
        return self.own + self.tail_classes

    def of(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """(class, rank in the head or -1) of each different token."""
        rank = pc.index_in(tokens.different, value_set=self.head).fill_null(-1).to_numpy()
        cls = rank.astype(np.int64)
        words = tokens.bytes()
        for i in np.flatnonzero((rank < 0) | (rank >= self.own)).tolist():
            cls[i] = self.own + tail_class(words[i], self.tail_classes)
        return cls, rank


def vocabulary(counts: DataFrame, head_tokens: int, own: int, tail_classes: int) -> tuple[Vocabulary, int, int]:
    """The vocabulary, and the number of training tokens and of distinct ones.

    The head are all tokens with a count that leaves at most head_tokens at or above it, so the driver gets no more.
    """
    total = np.zeros((tail_classes, 2))
    for r in counts.groupBy("cls").agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect():
        total[r.cls] = r.c, r.v
    n_tokens, n_distinct = int(total[:, 0].sum()), int(total[:, 1].sum())
    least = 1
    if n_distinct > head_tokens:  # distinct counts are few: their sum is the number of tokens
        have = 0
        for r in counts.groupBy("c").agg(F.count("*").alias("n")).orderBy(F.desc("c")).limit(head_tokens).toLocalIterator():
            have += r.n
            if have > head_tokens:
                least = r.c + 1
                break
    frequent = counts.filter(F.col("c") >= least).select("token", "c").toArrow()
    # The end always has a class of its own, and ranks first.
    found = sorted(zip(frequent.column("c").to_pylist(), frequent.column("token").to_pylist(), strict=True), key=lambda x: (x[1] != END, -x[0], x[1]))
    own = min(own, len(found))
    for c, token in found[:own]:
        total[tail_class(token.encode(), tail_classes)] -= c, 1
    denominator = total[:, 0] + ADD * (total[:, 1] + 1)
    head_counts = np.array([c for c, _ in found], dtype=np.int64)
    mass = np.concatenate([head_counts[:own], denominator])
    return Vocabulary(pa.array([t for _, t in found], pa.string()), head_counts, own, tail_classes, mass / mass.sum(), np.log10(denominator)), n_tokens, n_distinct


@dataclass
class HMM:
    start: np.ndarray  # states
    move: np.ndarray  # states x states
    emit: np.ndarray  # states x classes

    def forward(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """log10 likelihood of each sequence; sequences are in order of falling length and step together."""
        n_long = int(np.searchsorted(-lengths, -LONG, side="left"))
        out = np.zeros(len(starts))
        for i in range(n_long):
            out[i] = self.long_forward(codes[starts[i] : starts[i] + lengths[i]])
        starts, lengths, rest = starts[n_long:], lengths[n_long:], out[n_long:]
        alpha = None
        for t, n in enumerate(in_play(lengths)):
            e = self.emit.take(codes[starts[:n] + t], axis=1)
            alpha = (self.start[:, None] if t == 0 else self.move.T @ alpha[:, :n]) * e
            scale = alpha.sum(axis=0)
            alpha /= scale
            rest[:n] += np.log10(scale)
        return out

    def long_forward(self, codes: np.ndarray) -> float:
        """As forward, for one text: its segments step side by side, from each state, and are then put together."""
        k = len(self.start)
        alpha = self.start * self.emit[:, codes[0]]
        total = np.log10(alpha.sum())
        alpha = alpha / alpha.sum()
        codes = codes[1:]
        starts = np.arange(0, len(codes), SEGMENT)
        lengths = np.minimum(SEGMENT, len(codes) - starts)
        block, logs = np.tile(np.eye(k), len(starts)), np.zeros(k * len(starts))  # column s * k + i: segment s from state i
        for t, n in enumerate(in_play(lengths)):
            e = self.emit.take(codes[starts[:n] + t], axis=1)
            step = (self.move.T @ block[:, : n * k]) * np.repeat(e, k, axis=1)
            scale = step.sum(axis=0)
            block[:, : n * k] = step / scale
            logs[: n * k] += np.log10(scale)
        for s in range(len(starts)):
            own = logs[s * k : (s + 1) * k]
            alpha = block[:, s * k : (s + 1) * k] @ (alpha * 10 ** (own - own.max()))
            total += own.max() + np.log10(alpha.sum())
            alpha /= alpha.sum()
        return float(total)

    def expected(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, first: np.ndarray, out: np.ndarray) -> None:
        """Adds expected counts to out: classes x states, then states x states of moves, then the start.

        first tells which sequences begin a text: those start as texts do, and are counted for it. All others
        start from the states' shares in the long run.
        """
        k, classes = self.emit.shape
        share = np.linalg.matrix_power(self.move, 1 << 10)[0]
        begin = np.where(first, self.start[:, None], share[:, None])
        alive = in_play(lengths)
        ends = np.cumsum(alive).tolist()
        if not ends:
            return
        at = np.concatenate([codes[starts[:n] + t] for t, n in enumerate(alive)])
        emits = self.emit.take(at, axis=1)
        alphas, scales = np.empty_like(emits), np.empty(len(at))
        here = [slice(end - n, end) for n, end in zip(alive, ends, strict=True)]
        for t, n in enumerate(alive):
            alpha = (begin if t == 0 else self.move.T @ alphas[:, here[t - 1]][:, :n]) * emits[:, here[t]]
            scale = alpha.sum(axis=0)
            scales[here[t]] = scale
            np.divide(alpha, scale, out=alphas[:, here[t]])
        beta = np.ones((k, alive[-1]))
        for t in range(len(alive) - 1, 0, -1):
            back = emits[:, here[t]] * beta
            back /= scales[here[t]]
            before = alphas[:, here[t - 1]]
            out[classes : classes + k] += self.move * (before[:, : alive[t]] @ back.T)
            alphas[:, here[t]] *= beta  # from here on the states' probabilities
            beta = np.ones((k, alive[t - 1]))
            np.matmul(self.move, back, out=beta[:, : alive[t]])
        alphas[:, here[0]] *= beta
        out[classes + k] += alphas[:, here[0]] @ first
        for s in range(k):
            out[:classes, s] += np.bincount(at, weights=alphas[s], minlength=classes)


def in_play(lengths: np.ndarray) -> list[int]:
    """At each step, how many sequences are not over; lengths fall."""
    return np.searchsorted(-lengths, -np.arange(lengths[0] if len(lengths) else 0), side="left").tolist()


def in_order(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order of falling length, starts, lengths) of sequences that lie one behind the other."""
    order = np.argsort(-lengths, kind="stable")
    return order, (np.cumsum(lengths) - lengths)[order], lengths[order]


def encoded(docs: DataFrame, vocab) -> DataFrame:
    """(codes): each text's classes as little-endian unsigned 16-bit numbers."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, t in groups(batch, 0):
                cls, _ = vocab.value.of(t)
                packed, ends = cls.astype("<u2")[t.codes].tobytes(), (2 * np.cumsum(t.sizes)).tolist()
                yield pa.RecordBatch.from_arrays([pa.array([packed[a:z] for a, z in zip([0, *ends], ends, strict=False)], pa.binary())], names=["codes"])

    return docs.select("text").mapInArrow(encode, "codes binary")


def baum_welch(rows: DataFrame, vocab: Vocabulary, states: int, rounds: int, prior: float = 200.0) -> HMM:
    """States trained on all windows of rows (codes); counts are summed by Spark, class by class."""
    seeds = [np.bincount(np.frombuffer(r.codes, dtype="<u2"), minlength=vocab.size) for r in rows.orderBy(F.xxhash64("codes")).limit(128).collect()]
    rng = np.random.default_rng(11)
    shares = np.array([s / s.sum() for s in seeds]).reshape(-1, vocab.size)
    picked: list[int] = []
    for _ in range(min(states, len(shares))):  # texts that are far from each other
        unit = shares / np.linalg.norm(shares, axis=1, keepdims=True)
        near = (unit @ unit[picked].T).max(axis=1) if picked else np.zeros(len(unit))
        near[picked] = 2
        picked.append(int(np.argmin(near)))
    emit = np.tile(vocab.unigram, (states, 1)) * np.exp(0.1 * rng.standard_normal((states, vocab.size)))
    for s, at in enumerate(picked):
        emit[s] = 0.7 * emit[s] + 0.3 * shares[at]
    model = HMM(np.full(states, 1 / states), np.full((states, states), 0.1 / states) + 0.9 * np.eye(states), emit / emit.sum(axis=1, keepdims=True))
    columns = [f"s{k}" for k in range(states)]
    for _ in range(rounds):
        shared = rows.sparkSession.sparkContext.broadcast(model)

        def expect(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            hmm: HMM = shared.value
            out = np.zeros((hmm.emit.shape[1] + len(hmm.start) + 1, len(hmm.start)))
            for batch in batches:
                texts = [np.frombuffer(x.as_buffer(), dtype="<u2") for x in batch.column(0)]
                codes, sizes = np.concatenate(texts).astype(np.int64), np.array([len(t) for t in texts])
                n = -(-sizes // WINDOW)
                nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                starts = np.repeat(np.cumsum(sizes) - sizes, n) + nth * WINDOW
                lengths = np.minimum(WINDOW, np.repeat(sizes, n) - nth * WINDOW)
                for at in range(0, len(starts), 1024):
                    order = np.argsort(-lengths[at : at + 1024], kind="stable") + at
                    hmm.expected(codes, starts[order], lengths[order], nth[order] == 0, out)
            some = np.flatnonzero(out.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(some), *[pa.array(out[some, k]) for k in range(out.shape[1])]], names=["at", *columns])

        sums = rows.mapInArrow(expect, "at bigint, " + ", ".join(f"{c} double" for c in columns)).groupBy("at").agg(*[F.sum(c).alias(c) for c in columns])
        total = np.zeros((vocab.size + states + 1, states))
        for r in sums.collect():
            total[r[0]] = r[1:]
        emit = total[: vocab.size] + prior * vocab.unigram[:, None]
        move = total[vocab.size : -1] + 0.1
        start = total[-1] + 0.1
        model = HMM(start / start.sum(), move / move.sum(axis=1, keepdims=True), np.ascontiguousarray((emit / emit.sum(axis=0)).T))
        shared.destroy()
    return model


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", states: int = 8, rounds: int = 6, head_tokens: int = 1 << 19, own_classes: int = 8192, tail_classes: int = 1024) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words in lower case (A-Z) and one end. Learning sees the texts outside the fold (crc32 of
    the id modulo 10 is not 0). base_score is the additively smoothed unigram's log10 probability. score is
    the hidden Markov model's, by the scaled forward recursion over the whole text, without pruning: states
    emit classes, a class of its own for each of the own_classes most frequent tokens, else one of
    tail_classes by the token's last three bytes, within which a token has its smoothed share.

    Baum-Welch runs over windows of WINDOW tokens of all training texts, of which the first of a text alone
    tells how texts start; each round's expected counts are
    summed across partitions. The counts of the most frequent tokens, head_tokens of them at most, are
    broadcast; all rarer tokens are joined with the full count table, text by text.

    A null or empty text is the end alone. With no training text every probability comes from smoothing. A
    null id is hashed as empty text. Repeated rows are scored each; other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("held_out", id_bucket(F.col("doc_id"), 10) == 0)
    training = rows.filter("not held_out")
    counts = cut(token_counts(training, tail_classes))
    vocab, n_tokens, n_distinct = vocabulary(counts, head_tokens, own_classes, tail_classes)
    shared = spark.sparkContext.broadcast(vocab)
    model = spark.sparkContext.broadcast(baum_welch(cut(encoded(training, shared)), vocab, states, rounds))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, hmm, uid = shared.value, model.value, TaskContext.get().partitionId() << 40
        logs = np.log10(v.counts + ADD)
        for batch in batches:
            for at, t in groups(batch, 2):
                cls, rank = v.of(t)
                known, tail = rank >= 0, cls >= v.own
                base = np.where(known, logs[np.maximum(rank, 0)] if len(logs) else 0.0, 0.0)
                # What the model adds to a token's class: its share of a tail class, as far as its count is known here.
                more = np.where(tail, base - v.log_share[np.maximum(cls - v.own, 0)], 0.0)
                n = len(t.sizes)
                summed = lambda x, t=t, n=n: np.bincount(t.text, weights=x[t.codes], minlength=n)
                order, starts, lengths = in_order(t.sizes)
                likelihood = np.zeros(n)
                likelihood[order] = hmm.forward(cls[t.codes], starts, lengths)
                # One row for each text, then one for each rare token of a text; their logs are still to come.
                rare = np.flatnonzero(~known[t.codes])
                pair, times = np.unique(t.text[rare] * len(cls) + t.codes[rare], return_counts=True)
                of = np.concatenate([np.arange(n), pair // len(cls)])
                tokens = pa.concat_arrays([pa.array([f" {u}" for u in range(uid, uid + n)], pa.string()), t.different.take(pa.array(pair % len(cls)))])
                pad = lambda x, rest=len(pair): pa.array(np.concatenate([x, np.zeros(rest, dtype=x.dtype)]))
                ids, held = (batch.column(c).slice(at, n).take(pa.array(of)) for c in (0, 1))
                n_head = summed(known.astype(float)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [tokens, pa.array(np.concatenate([np.zeros(n, dtype=np.int64), times])), pa.array(of + uid), ids, held, pad(t.sizes), pad(n_head), pad(summed(base)), pad(likelihood + summed(more))],
                    names=["token", "times", "uid", "doc_id", "held_out", "n_tokens", "n_known", "base", "model"],
                )
                uid += n

    kind = docs.schema[id_col].dataType.simpleString()
    parts = rows.select("doc_id", "held_out", "text").mapInArrow(score, f"token string, times bigint, uid bigint, doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base double, model double")
    c = F.coalesce("c", F.lit(0))
    joined = spread_join(parts, counts.select("token", "c"), "token", "left").withColumn("log", F.when(F.col("times") > 0, F.log10(c + F.lit(ADD)) * F.col("times")).otherwise(0.0))
    sums = joined.groupBy("uid", "doc_id", "held_out").agg(
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("n_known") + F.when(c > 0, F.col("times")).otherwise(0)).alias("n_known"),
        F.sum(F.col("base") + F.col("log")).alias("base"),
        F.sum(F.col("model") + F.col("log")).alias("score"),
    )
    floor = float(np.log10(n_tokens + ADD * (n_distinct + 1)))
    return sums.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n_tokens).cast("long").alias("train_tokens"), (F.col("base") - F.col("n_tokens") * F.lit(floor)).alias("base_score"), "score")
