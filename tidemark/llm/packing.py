"""Packing documents into training sequences: shortest pack first over the length histogram."""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Documents of one length are ranked within so many buckets.
BUCKETS = 1024
#: Words whose ids a worker remembers; the memory is emptied when it is full.
REMEMBERED = 1_500_000
#: The tokenizer splits words where letters or digits end and a run of other signs begins.
TAIL = re.compile(r"(.*[^\W_])([!-/:-@\[-`{-~]+)", re.S)
LETTERS = re.compile(r"[a-z]+")
#: Bytes of text whose words are found together; a longer text is taken alone.
GROUP = 8_000_000


class WordIds:
    """Ids of texts by a tokenizer whose words never reach across white space; words are remembered.

    A group of texts is split and its different words are found by Arrow; Python sees each of those once.
    New words are encoded together, with a bar between them, which is a token of its own there. Words that
    hold a bar are encoded one by one, as is any run for which the bars do not come out even.
    """

    BAR = "|"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.known = Tokenizer.from_file(path), {"": b""}
        self.bar, self.model = self.ids(self.BAR), self.tokenizer.model

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def meet(self, words: list[str]) -> None:
        """Makes all words known. A word that ends in ASCII punctuation after a letter has the ids of both parts."""
        known = self.known
        parts = {w: m.groups() for w in words if not w[-1].isalpha() and "<|" not in w and (m := TAIL.fullmatch(w))}
        new = list({x for w in words for x in parts.get(w, (w,)) if x not in known})
        for at in range(0, len(new), 2_000):
            self.learn(new[at : at + 2_000])
        known.update((w, known[a] + known[b]) for w, (a, b) in parts.items())

    def learn(self, words: list[str]) -> None:
        for w in words:
            if LETTERS.fullmatch(w):  # neither normalised nor split: the model alone has a say
                self.known[w] = array("I", [t.id for t in self.model.tokenize(w)]).tobytes()
        words = [w for w in words if w not in self.known]
        plain = [w for w in words if self.BAR not in w]
        ids = self.ids(" | ".join(plain)) if plain else np.zeros(0, dtype="<u4")
        ends = [*np.flatnonzero(ids == self.bar[0]).tolist(), len(ids)] if len(self.bar) == 1 else []
        packed, begin = ids.tobytes(), 0
        if len(ends) != len(plain):
            plain, ends = [], []
        for word, end in zip(plain, ends, strict=True):
            self.known[word] = packed[4 * begin : 4 * end]
            begin = end + 1
        for word in words:
            if word not in self.known:
                self.known[word] = self.ids(word).tobytes()

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, one behind the other; where each text's ids end). texts: strings without null."""
        special = pc.match_substring(texts, "<|")
        lists = pc.ascii_split_whitespace(pc.if_else(special, texts, pc.ascii_lower(texts)))
        words = lists.values.slice(lists.offsets[0].as_py(), lists.offsets[-1].as_py() - lists.offsets[0].as_py()).dictionary_encode()
        different, known = words.dictionary.to_numpy(zero_copy_only=False).tolist(), self.known
        if len(known) > REMEMBERED:
            known.clear()
            known[""] = b""
        found = list(map(known.get, different))
        if missing := [i for i, ids in enumerate(found) if ids is None]:
            self.meet([different[i] for i in missing])
            for i in missing:
                found[i] = known[different[i]]
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        begins = np.cumsum(sizes) - sizes
        codes = words.indices.to_numpy()
        n = sizes[codes]
        upto = np.concatenate([[0], np.cumsum(n)])
        at = np.arange(upto[-1]) + np.repeat(begins[codes] - upto[:-1], n)
        ends = lists.offsets.to_numpy()
        return np.frombuffer(b"".join(found), dtype="<u4")[at], upto[ends[1:] - ends[0]]


_loaded: dict[str, WordIds] = {}


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_pieces(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, max_tokens: int, end_id: int) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): each document's ids and the end id, cut at max_tokens."""

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _loaded:
            _loaded[tokenizer] = WordIds(tokenizer_path(tokenizer))
        ids_of, end = _loaded[tokenizer], np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            texts = batch.column(1).fill_null("")
            sizes = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64))
            rows, at = [], 0
            while at < batch.num_rows:
                beyond = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + GROUP)))
                ids, ends = ids_of(texts.slice(at, beyond - at))
                packed = ids.tobytes()
                for i, (a, z) in enumerate(zip([0, *ends.tolist()], ends.tolist(), strict=False), at):
                    own, n = packed[4 * a : 4 * z] + end, z - a + 1
                    rows += [(i, s, min(max_tokens, n - s), zlib.crc32(own[4 * s : 4 * (s + max_tokens)]), n) for s in range(0, n, max_tokens)]
                at = beyond
            table = np.array(rows, dtype=np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(table[:, 0])), *[pa.array(table[:, k]) for k in range(1, 5)]], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(cut_up, f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint")


def pack_histogram(counts: dict[int, int], room: int) -> list[tuple[int, tuple[int, ...]]]:
    """Packing patterns (number of sequences, lengths from longest to shortest) that place every length.

    Lengths are placed longest first, each into the shortest pack that exists, as many at once as there are
    packs of that pattern. The work depends on room and on the number of patterns, not on the counts' size.
    """
    open_packs: dict[int, list[list]] = {}
    done: list[tuple[int, tuple[int, ...]]] = []
    for length in sorted((k for k, c in counts.items() if c), reverse=True):
        left = counts[length]
        while left:
            space = max(open_packs, default=0)
            if space < length:
                placed, pattern, space = left, (), room
            else:
                packs = open_packs[space]
                pattern, n = packs.pop()
                placed = min(left, n)
                if placed < n:
                    packs.append([pattern, n - placed])
                if not packs:
                    del open_packs[space]
            left -= placed
            if space == length:
                done.append((placed, (*pattern, length)))
            else:
                open_packs.setdefault(space - length, []).append([(*pattern, length), placed])
    return done + [(n, pattern) for packs in open_packs.values() for pattern, n in packs]


def places(patterns: list[tuple[int, tuple[int, ...]]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset): where the pieces of a length go, by rank."""
    ranks: dict[int, int] = {}
    out, sequence = [], 0
    for n, pattern in patterns:
        offset = 0
        for length in pattern:
            first = ranks.get(length, 0)
            out.append((length, first, first + n, sequence, offset))
            ranks[length], offset = first + n, offset + length
        sequence += n
    return out


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "word_bpe_49k.json", max_tokens: int = 2048, end_id: int = 1) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids and the end id; a null or empty text has the end id alone. Documents longer than
    max_tokens are cut there, and all pieces are packed into sequences of at most max_tokens, shortest pack
    first over the histogram of lengths (at most max_tokens counts, which the driver packs). The pattern
    table is bounded by max_tokens too and joins back by the piece's rank among those of its length. Rows
    that repeat an id are packed each. An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    pieces = token_pieces(docs, id_col, text_col, tokenizer, max_tokens, end_id)
    pieces = cut(pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(BUCKETS))))
    counts = pieces.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    where = spark.createDataFrame(places(pack_histogram(histogram, max_tokens)), "length bigint, first bigint, beyond bigint, sequence bigint, offset bigint")
    starts = counts.select("length", "bucket", (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("ahead"))
    ranked = pieces.withColumn("at", F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32")) - 1)
    ranked = ranked.join(starts, ["length", "bucket"]).withColumn("rank", F.col("ahead") + F.col("at"))
    placed = ranked.alias("p").join(F.broadcast(where.alias("w")), F.expr("p.length = w.length AND p.rank >= w.first AND p.rank < w.beyond"))
    return placed.select("doc_id", "start", F.col("p.length").alias("length"), "ids_crc32", "doc_tokens", F.expr("w.sequence + p.rank - w.first").alias("sequence_id"), "offset")
