"""Language identification by cross-parsing entropy over suffix automata of labelled text."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import id_bucket

UNKNOWN = "und"
#: Entries that the automata of all languages may have in tables by state and code, four bytes each.
DENSE = 1 << 26


def letters_only(text: str) -> np.ndarray:
    """Code points of a text in lower case."""
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")


class Alphabet:
    """Codes of characters: 0 for all that are no letters, then the learned letters, then every other letter."""

    def __init__(self, texts: list[str]):
        points = sorted({c for t in texts for c in t.lower() if c.isalpha()})
        self.size = len(points) + 2
        letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
        self.codes = np.where(letter, self.size - 1, 0).astype(np.uint8 if self.size < 256 else np.int32)
        self.codes[[ord(c) for c in points]] = np.arange(1, len(points) + 1)

    def __call__(self, points: np.ndarray) -> np.ndarray:
        return self.codes[points]


class Transitions:
    """The next states of an automaton, as an array by state and code if it has at most dense entries.

    Otherwise the rows of all states lie over one another where their codes leave room, and each entry tells
    whose it is: the size follows the number of transitions, whatever the alphabet.
    """

    def __init__(self, step: list[dict[int, int]], size: int, dense: int):
        self.size, self.owner = size, None
        if len(step) * size <= dense:
            self.to = np.zeros(len(step) * size, dtype=np.int32)
            for state, out in enumerate(step):
                if out:
                    self.to[[state * size + c for c in out]] = list(out.values())
            return
        self.base = np.zeros(len(step), dtype=np.int64)
        taken, low, room = bytearray(4 * size), 0, 2 * size
        for state in sorted(range(len(step)), key=lambda s: -len(step[s])):
            out, at, tries = step[state], low, 0
            while out and any(taken[at + c] for c in out):
                at, tries = at + 1, tries + 1
                if at + 2 * size > len(taken):
                    taken.extend(bytes(len(taken)))
            low = at if tries > 64 else low
            for c in out:
                taken[at + c] = 1
            self.base[state], room = at, max(room, at + size)
        self.to, self.owner = np.zeros(room, dtype=np.int32), np.zeros(room, dtype=np.int32)
        for state, out in enumerate(step):
            for c, to in out.items():
                self.to[self.base[state] + c], self.owner[self.base[state] + c] = to, state

    def __call__(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        if self.owner is None:
            return self.to.take(state * np.int32(self.size) + code)
        at = self.base[state] + code
        return np.where(self.owner[at] == state, self.to[at], 0)


def suffix_automaton(codes: np.ndarray, size: int, dense: int = 1 << 23) -> Transitions:
    """The automaton of all substrings; state 1 is the root, 0 is none."""
    step: list[dict[int, int]] = [{}, {}]
    link, length, last = [0, 0], [0, 0], 1
    for c in codes.tolist():
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(1)
        at = last
        while at and c not in step[at]:
            step[at][c] = new
            at = link[at]
        if at:
            to = step[at][c]
            if length[to] == length[at] + 1:
                link[new] = to
            else:
                copy = len(step)
                step.append(dict(step[to]))
                length.append(length[at] + 1)
                link.append(link[to])
                while at and step[at].get(c) == to:
                    step[at][c] = copy
                    at = link[at]
                link[to] = link[new] = copy
        last = new
    return Transitions(step, size, dense)


class CrossParser:
    """Phrases that a text needs when each is the longest one that a language's training text holds."""

    def __init__(self, texts: dict[str, str], block: int, dense: int = DENSE):
        self.langs, self.block = sorted(texts), block
        self.alphabet = Alphabet(list(texts.values()))
        # The automata share the room; one that needs more than its part takes the form that follows its transitions.
        dense = min(1 << 23, dense // max(1, len(self.langs)))
        self.tables = [suffix_automaton(self.alphabet(letters_only(texts[k])), self.alphabet.size, dense) for k in self.langs]
        # A phrase costs the bits that point into the training text, as in the cross-entropy of parsing.
        self.bits = [math.log2(len(texts[k]) + 2) for k in self.langs]

    def phrases(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, table: Transitions) -> np.ndarray:
        """Phrases of each block; blocks are in order of falling length, and step together, character by character."""
        root = table(np.ones(self.alphabet.size, dtype=np.int32), np.arange(self.alphabet.size))
        state = np.zeros(len(starts), dtype=np.int32)  # from which every character fails, and begins a phrase
        count = np.zeros(len(starts), dtype=np.int32)
        alive = np.searchsorted(-lengths, -np.arange(lengths[0] if len(lengths) else 0), side="left")
        for t, n in enumerate(alive.tolist()):
            c = codes[starts[:n] + t]
            to = table(state[:n], c)
            failed = np.flatnonzero(to == 0)
            count[failed] += 1
            to[failed] = root[c[failed]]
            state[:n] = to
        return count

    def __call__(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The language of each text, and how much cheaper it is than the next one: 0.5 is a tie, 1 is sure."""
        points = [letters_only(t or "") for t in texts]
        sizes = np.array([len(p) for p in points], dtype=np.int64)
        codes = self.alphabet(np.concatenate(points)) if len(points) else np.zeros(0, dtype=np.uint8)
        first = np.cumsum(sizes) - sizes
        n_blocks = -(-sizes // self.block)
        doc = np.repeat(np.arange(len(sizes)), n_blocks)
        at = np.arange(len(doc)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
        lengths = np.minimum(self.block, sizes[doc] - at * self.block)
        order = np.argsort(-lengths, kind="stable")
        starts = (first[doc] + at * self.block)[order]
        cost = np.zeros((len(self.langs), len(sizes)))
        for k, table in enumerate(self.tables):
            cost[k] = self.bits[k] * np.bincount(doc[order], self.phrases(codes, starts, lengths[order], table), minlength=len(sizes))
        total = np.concatenate([[0], np.cumsum(codes != 0)])
        lettered = total[first + sizes] > total[first]
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        rank = np.argsort(cost, axis=0, kind="stable")
        best = np.take_along_axis(cost, rank[:1], axis=0)[0]
        second = np.take_along_axis(cost, rank[1:2], axis=0)[0] if len(self.langs) > 1 else np.full(len(texts), np.inf)
        with np.errstate(invalid="ignore", divide="ignore"):
            score = np.where(np.isinf(second), 1.0, second / np.maximum(best + second, 1e-9))
        names = [self.langs[k] if ok else UNKNOWN for k, ok in zip(rank[0], lettered, strict=True)]
        return names, np.where(lettered, score, 0.0)


def training_texts(rows: DataFrame, max_docs: int, max_chars: int, max_chars_per_doc: int, max_langs: int = 200) -> dict[str, str]:
    """lang -> text of a bounded sample: by hash order, the beginnings of at most max_docs documents, max_chars characters in all.

    Of more than max_langs values of lang those with the most labelled rows are learned.
    """
    labelled = rows.filter("lang is not null and not held_out")
    langs = [r.lang for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(max_langs).collect()]
    usable = labelled.filter(F.col("lang").isin(langs) & (F.length("text") > 0)).withColumn("at", F.xxhash64("text")).withColumn("text", F.substring("text", 1, max_chars_per_doc))
    first = usable.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "at"))).filter(F.col("n") <= max_docs)
    found: dict[str, str] = {}
    for r in first.select("lang", "n", "text").collect():
        found.setdefault(r.lang, []).append((r.n, r.text))
    return {k: "\n".join(t for _, t in sorted(v))[:max_chars] for k, v in found.items()}


_parsers: dict[tuple, CrossParser] = {}


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_docs: int = 40, max_chars: int = 30_000, block: int = 512, max_chars_per_doc: int = 5_000, max_langs: int = 200) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score.

    Learns from labelled rows outside the fold (crc32 of the id modulo 4 is not 2): per language a sample of
    max_docs documents of any length, each cut at max_chars_per_doc characters and together at max_chars,
    of at most max_langs languages, those with the most labelled rows (ties: the smaller name), becomes a suffix
    automaton (letters in lower case, everything else one separator). max_chars_per_doc bounds a document's
    share of the training sample only. The automata's tables have DENSE entries in all or are sparse, so that
    many labels cost time but not memory. A whole text is then parsed into longest matches
    by each automaton, and the language that needs the fewest bits of phrases wins; ties go to the smaller
    name. No phrase crosses a multiple of block characters, so that all blocks are parsed side by side.

    A null or empty text, or one without a letter, is und with score 0, as is every text if nothing is
    labelled. Otherwise score is second cost / (best + second): 0.5 is a tie; it is 1 with one language.
    A null id is hashed as empty text. Repeated rows are predicted each; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.withColumn("held_out", id_bucket(F.col("doc_id"), 4) == 2)
    out = predicted(rows.select("doc_id", "held_out", "text"), training_texts(rows, max_docs, max_chars, max_chars_per_doc, max_langs), block, ["doc_id", "held_out"])
    return out.select("doc_id", "held_out", "found.lang_pred", "found.score")


def add_languages(docs: DataFrame, prefix: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_docs: int = 40, max_chars: int = 30_000, block: int = 512, max_chars_per_doc: int = 5_000, max_langs: int = 200) -> DataFrame:
    """docs, all columns and rows as they are, with a struct column prefix (lang_pred, score) as identify_languages finds it."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    sample = training_texts(rows.withColumn("held_out", id_bucket(F.col("doc_id"), 4) == 2), max_docs, max_chars, max_chars_per_doc, max_langs)
    packed = docs.select(F.struct("*").alias("doc"), F.col(text_col).cast("string").alias("text"))
    return predicted(packed, sample, block, ["doc"]).select("doc.*", F.col("found").alias(prefix))


def predicted(rows: DataFrame, sample: dict[str, str], block: int, others: list[str]) -> DataFrame:
    """The columns others of rows, and found: a struct of the language of the last column, text, and its score."""
    texts = rows.sparkSession.sparkContext.broadcast(sample)
    key = (hashlib.sha256(repr(sorted(sample.items())).encode("utf-8", "surrogatepass")).digest(), block)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _parsers:
            _parsers.clear()
            _parsers[key] = CrossParser(texts.value, block)
        parse = _parsers[key]
        for batch in batches:
            column, names, scores, at = batch.column(len(others)), [], [], 0
            sizes = np.cumsum([len(x.as_buffer()) if x.is_valid else 0 for x in column])
            while at < batch.num_rows:  # a few million bytes at once bound the memory
                end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + 8_000_000)))
                got = parse(column.slice(at, end - at).to_pylist())
                names += got[0]
                scores.append(got[1])
                at = end
            found = pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(np.concatenate([np.zeros(0), *scores]))], names=["lang_pred", "score"])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], found], names=[*others, "found"])

    kinds = T.StructType([rows.schema[c] for c in others]).add("found", T.StructType().add("lang_pred", "string").add("score", "double"))
    return rows.mapInArrow(predict, kinds)
