"""Removal of repeated passages by distributed prefix doubling over positions that may repeat."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from .common import Scratch, running_totals, spread_join
from .exact_dedup import bits_for, maybe_among

#: Odd multiplier of the rolling hash modulo 2^64, and its inverse.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Filter bits for each key, and at most: 32 MB go to every task, whatever the input.
BITS_PER_KEY, MOST_BITS = 16, 1 << 28
#: Bytes of text that are hashed side by side; a longer text is hashed in overlapping pieces.
CHUNK = 1_000_000
#: Bits of a position in a chunk, which is of less than two CHUNKs. They take the place of a hash's lowest bits.
PLACE = np.uint64(22)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


class Rolling:
    """Hashes of any substrings of one byte string."""

    powers = inverses = np.ones(1, dtype=np.uint64)

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        if len(Rolling.powers) < n:
            size = 1 << n.bit_length()
            steps = [np.full(size, x, dtype=np.uint64) for x in (BASE, INVERSE)]
            for x in steps:
                x[0] = 1
            Rolling.powers, Rolling.inverses = map(np.cumprod, steps)
        self.sums = np.zeros(n, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * Rolling.powers[: n - 1], out=self.sums[1:])

    def all(self, length: int) -> np.ndarray:
        """Of the substrings of this length at every position."""
        n = len(self.sums) - length
        return mixed((self.sums[length:] - self.sums[:n]) * Rolling.inverses[:n]) if n > 0 else np.zeros(0, dtype=np.uint64)

    def at(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[begin]) * Rolling.inverses[begin] + (end - begin).astype(np.uint64))


class Lengths:
    """Lengths that follow from the threshold.

    Each string of threshold bytes is led by the first smallest hash of seed bytes among its first width
    positions, which its own bytes decide. Strings side by side with one leader p make a tile; they begin at
    p - width + 1 or later and at p or earlier, so all of them hold the bytes [p, p + core).
    """

    def __init__(self, threshold: int):
        self.threshold = threshold
        self.width = max(1, threshold // 2 - 2)
        self.seed = max(1, min(12, threshold - self.width))
        self.core = threshold - self.width + 1
        self.part = max(1, self.width // 8)
        # Ranks of a quarter, a half and then all of the threshold: a half is two overlapping quarters, and so on.
        self.quarter, half = -(-threshold // 4), -(-threshold // 2)
        steps = half - self.quarter, threshold - half
        self.offsets = [0, steps[0], steps[1], sum(steps)]


class Chunk:
    """Some texts, or a piece of one, one behind the other, and the tiles of their strings."""

    def __init__(self, lengths: Lengths, parts: list[tuple[int, int, bytes]]):
        self.lengths, self.bytes = lengths, b"".join(t for *_, t in parts)
        sizes = np.array([len(t) for *_, t in parts], dtype=np.int64)
        begin = np.cumsum(sizes) - sizes
        self.batch_row, shift = np.array([r for r, *_ in parts]), begin - np.array([b for _, b, _ in parts])
        data = np.frombuffer(self.bytes, dtype=np.uint8)
        of = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        self.rolling = Rolling(data)
        low = self.rolling.all(lengths.seed) >> PLACE << PLACE
        low |= np.arange(len(low), dtype=np.uint64)
        span, n = 1, len(data) - lengths.threshold + 1
        while span * 2 <= lengths.width:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        low = np.minimum(low[:n], low[lengths.width - span : lengths.width - span + n])
        x = np.flatnonzero(of[:n] == of[lengths.threshold - 1 :])
        leader = (low[x] & np.uint64((1 << int(PLACE)) - 1)).astype(np.int64)
        new = np.flatnonzero(np.concatenate([[True], (leader[1:] != leader[:-1]) | (x[1:] != x[:-1] + 1)])) if len(x) else x
        self.leader, self.first, self.last = leader[new], x[new], x[np.append(new[1:], len(x)) - 1] if len(x) else x
        self.row, self.shift = self.batch_row[of[self.first]], shift[of[self.first]]

    def cores(self) -> np.ndarray:
        return self.rolling.at(self.leader, self.leader + self.lengths.core)

    def ranges(self, at: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
        """(hash of all bytes that the strings from first to last cover and of the leader's place in them, the bytes)."""
        end = (last + self.lengths.threshold).tolist()
        slices = [self.bytes[a:z] for a, z in zip(first.tolist(), end, strict=True)]
        hashes = b"".join([xxh3_128_digest(s, o) for s, o in zip(slices, (self.leader[at] - first).tolist(), strict=True)])
        return np.frombuffer(hashes, dtype="<i8").reshape(-1, 2), slices


def chunks(lengths: Lengths, column: pa.Array) -> Iterator[Chunk]:
    parts, size, more = [], 0, lengths.threshold - 1
    for i, x in enumerate(column):
        text = x.as_buffer()
        for base in range(0, max(1, text.size - more), CHUNK):
            piece = text.slice(base, min(CHUNK + more, text.size - base)).to_pybytes()
            if parts and size + len(piece) > CHUNK:
                yield Chunk(lengths, parts)
                parts, size = [], 0
            parts.append((i, base, piece))
            size += len(piece)
    if parts:
        yield Chunk(lengths, parts)


class Filter:
    """A Bloom filter of well-mixed 64-bit hashes, with two probes."""

    def __init__(self, words: np.ndarray):
        self.words, self.mask = words, np.uint64(64 * len(words) - 1)

    def __call__(self, h: np.ndarray) -> np.ndarray:
        one = lambda s: (self.words[(s >> np.uint64(6)).astype(np.int64)] >> (s & np.uint64(63))) & np.uint64(1) > 0
        return one(h & self.mask) & one(h >> np.uint64(32) & self.mask)


def bloom(hashes: DataFrame) -> np.ndarray:
    """The filter of a written column h, sized by its rows; Spark sets the bits, the driver gets the words that have any."""
    n_bits = min(MOST_BITS, 1 << max(10, (BITS_PER_KEY * hashes.count()).bit_length()))
    slots = F.array(F.expr(f"h & {n_bits - 1}L"), F.expr(f"shiftrightunsigned(h, 32) & {n_bits - 1}L"))
    words = hashes.select(F.explode(slots).alias("slot")).groupBy(F.expr("slot div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("bits"))
    out = np.zeros(n_bits // 64, dtype=np.uint64)
    table = words.toArrow()
    out[table.column("word").to_numpy()] = table.column("bits").to_numpy().view(np.uint64)
    return out


def later(rows: DataFrame, classes: DataFrame, key: list[str]) -> DataFrame:
    """The rows that are not the first of their class; classes has the first of each."""
    return spread_join(rows, classes.filter("n > 1").select(*key, "first"), key).filter("at > first")


def in_question(classes: DataFrame) -> DataFrame:
    """First ones whose core is that of another class's first one too; all others share no string."""
    shared = classes.groupBy("core").agg(F.count("*").alias("m")).filter("m > 1").select("core")
    return spread_join(classes, shared, "core")


#: The hash of all bytes of a tile or a part.
WHOLE = ["whole", "whole2"]


def classes_of(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*WHOLE).agg(F.min("at").alias("first"), F.first("core").alias("core"), F.count("*").alias("n"))


def merged(runs: DataFrame) -> DataFrame:
    """Runs (base, at, end) of which none touches another; they cover the same bytes."""
    own = W.partitionBy("base").orderBy("at", "end")
    before = F.max("end").over(own.rowsBetween(W.unboundedPreceding, -1))
    starts = runs.withColumn("new", F.when(F.col("at") <= before, 0).otherwise(1)).withColumn("island", F.sum("new").over(own.rowsBetween(W.unboundedPreceding, 0)))
    return starts.groupBy("base", "island").agg(F.min("at").alias("at"), F.max("end").alias("end")).drop("island")


def corpus_places(scratch: Scratch, rows: DataFrame) -> DataFrame:
    """(t1, t2, first, base): the first row of each text, and where the text begins if all lie one behind the other, a byte apart.

    rows: (doc_id, t1, t2, size). The order is that of the first rows' ids, null last, and then of text hashes.
    """
    id_order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id")
    firsts = scratch.write("texts", rows.groupBy("t1", "t2").agg(F.min(id_order).alias("first"), F.first("size").alias("size")))
    placed = running_totals(scratch, "texts-ordered", firsts, ["first", "t1", "t2"], {"base": F.col("size") + 1})
    placed = scratch.write("places", placed.select("t1", "t2", F.col("first.doc_id").alias("first_id"), "base"))
    scratch.drop("texts", "texts-ordered")
    return placed


def doubled(scratch: Scratch, slices: DataFrame, lengths: Lengths) -> DataFrame:
    """(base, at) of the strings that repeat an earlier one; slices: (base, at, n, bytes), n strings from at on.

    Prefix doubling: positions are sorted by their first quarter of the threshold and ranked; then by the
    pairs of ranks here and a quarter on, and by the pairs of those ranks here and a half on. Positions
    whose pair is unique drop out of each round, and with them the strings that they belong to. A row's
    place is its string's position times the parts of it that are left, and the number of its part.
    """
    begins = slices.select("base", "at", "bytes", F.explode(F.sequence(F.lit(0), F.col("n").cast("int") - 1)).alias("j"))
    begins = begins.select("base", (F.col("at") + F.col("j")).alias("at"), "bytes", "j")
    pieces = F.posexplode(F.array(*[F.expr(f"substring(bytes, j + {o + 1}, {lengths.quarter})") for o in lengths.offsets])).alias("k", "piece")
    rows, key = scratch.write("places-4", begins.select("at", pieces).select((F.col("at") * 4 + F.col("k")).alias("place"), "piece")), ["piece"]
    for left in (4, 2):
        repeated = scratch.write(f"repeated-{left}", rows.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1").select(*key))
        scratch.drop()
        ranks = scratch.write(f"ranks-{left}", repeated.sort(*key).withColumn("rank", F.monotonically_increasing_id()))
        ranked = scratch.write(f"ranked-{left}", spread_join(rows, ranks, key).select("place", "rank"))
        scratch.drop(f"repeated-{left}", f"ranks-{left}", f"places-{left}")
        half = lambda k: F.max(F.when(F.col("place") % 2 == k, F.col("rank")))
        pairs = ranked.groupBy(F.expr("place div 2").alias("pair")).agg(half(0).alias("here"), half(1).alias("further"))
        pairs = pairs.filter("here is not null and further is not null").withColumnRenamed("pair", "place")
        rows, key = scratch.write(f"places-{left // 2}", pairs), ["here", "further"]
        scratch.drop(f"ranked-{left}")
    rows = rows.withColumnRenamed("place", "at")
    classes = rows.groupBy(*key).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    found = scratch.write("found", later(rows, classes, key).select("at"))
    scratch.drop("places-1")
    return spread_join(begins.select("base", "at"), found, "at").select("base", "at")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = 100) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept, spans.

    A byte of the UTF-8 text goes if it lies in a string of threshold bytes that also starts earlier: in a
    row with a smaller id, or before it in the same row (overlaps count). Strings are judged on the input.
    kept is the rest as binary, spans the removed runs (begin, end). A null text is empty. Null ids come
    last; rows with one id and different texts are ordered by a hash of the text, and rows that repeat id
    and text are one document: they are judged alike and lose nothing to each other. Rows without an id that
    have the same text are one document too. Texts shorter than the threshold stay whole. An empty table
    gives no rows. Other columns are not read.

    Different texts lie one behind the other in a corpus, and a position there is a number. Later copies of a
    whole text go entirely. Most positions are settled before any is sorted, by classes of longer strings:

    1. Strings side by side make tiles (see Lengths); tiles whose core is unique hold no repeat.
    2. Tiles equal on all bytes that their strings cover are one class. All but its first are repeats, and a
       first tile whose core no other first one has holds none.
    3. The first tiles that are left are cut in parts, and those are settled as in step 2.
    4. What is left, at the edges of repeated runs, is settled string by string by prefix doubling (doubled).

    Cores are compared by 64-bit hashes, which only choose candidates; texts, tiles and parts are equal in
    128-bit hashes, and prefix doubling compares bytes. Two Bloom filters, sized by their keys up to a
    bound, choose what a pass over the texts emits: a full filter emits more and changes no result.
    """
    if threshold < 4:
        raise ValueError("threshold must be 4 or more")
    spark, lengths = docs.sparkSession, Lengths(threshold)
    scratch, share = Scratch(spark), spark.sparkContext.broadcast
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"), F.octet_length("text").cast("long").alias("size"), "text")
    sizes = scratch.write("rows", rows.drop("text"))
    places = corpus_places(scratch, sizes)
    # Rows meet their text's place by id and text: copies are spread, and those that go stay behind.
    keyed = lambda df, c: df.withColumn("id_key", F.coalesce(F.col(c).cast("string"), F.lit("~")))
    own = spread_join(keyed(rows, "doc_id"), keyed(places, "first_id").select("id_key", "t1", "t2", "base"), ["id_key", "t1", "t2"], "left")
    own = own.filter(F.col("base").isNotNull() | (F.col("size") < threshold))
    # A short copy has no place, and needs none but to meet no runs.
    texts = scratch.write("texts", own.select("doc_id", F.coalesce("base", -1 - F.pmod("t1", F.lit(1 << 40))).alias("base"), "text"))
    long = texts.filter(F.octet_length("text") >= threshold).select("base", "text")
    scratch.drop()

    def cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in chunks(lengths, batch.column(1)):
                h, n = np.unique(c.cores(), return_counts=True)
                yield pa.RecordBatch.from_arrays([signed(h), pa.array(np.minimum(n, 2))], names=["h", "n"])

    repeated = long.mapInArrow(cores, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n")).filter("n > 1").select("h")
    seen = share(bloom(scratch.write("cores", repeated)))
    scratch.drop("cores")

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Filter(seen.value)
        for batch in batches:
            bases = batch.column(0).to_numpy()
            for c in chunks(lengths, batch.column(1)):
                core = c.cores()
                at = np.flatnonzero(known(core))
                whole, _ = c.ranges(at, c.first[at], c.last[at])
                base = bases[c.row[at]]
                columns = [base, base + c.first[at] - c.shift[at], (c.last - c.first)[at] + 1, core[at].view(np.int64), whole[:, 0], whole[:, 1]]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=names)

    names = ["base", "at", "n", "core", *WHOLE]
    schema = ", ".join(f"{n} bigint" for n in names)
    tiled = scratch.write("tiles", long.mapInArrow(tiles, schema))
    firsts = scratch.write("firsts", classes_of(tiled))
    scratch.drop()
    run = lambda df: df.select("base", "at", (F.col("at") + F.col("n") - 1 + threshold).alias("end"))
    scratch.write("runs-1", merged(run(later(tiled.drop("core"), firsts, WHOLE))))
    scratch.drop("tiles")

    def mixed_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([signed(mixed(batch.column(0).to_numpy().view(np.uint64)))], names=["h"])

    asked = share(bloom(scratch.write("asked", in_question(firsts).select("first").mapInArrow(mixed_places, "h bigint"))))
    scratch.drop("asked", "firsts")

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, wanted = Filter(seen.value), Filter(asked.value)
        for batch in batches:
            bases = batch.column(0).to_numpy()
            for c in chunks(lengths, batch.column(1)):
                tile = np.flatnonzero(known(c.cores()))
                tile = tile[wanted(mixed((bases[c.row[tile]] + c.first[tile] - c.shift[tile]).view(np.uint64)))]
                for k in range(0, lengths.width, lengths.part):  # strings that begin k or more, and less than k + part, before the leader
                    leader, last = c.leader[tile] - k, k + lengths.part - 1
                    first, end = np.maximum(c.first[tile], c.leader[tile] - last), np.minimum(c.last[tile], leader)
                    some = np.flatnonzero(first <= end)
                    at, first, end, leader = tile[some], first[some], end[some], leader[some]
                    core = mixed(c.rolling.at(leader, leader + threshold + 1 - lengths.part) + np.uint64(k))
                    whole, slices = c.ranges(at, first, end)
                    base = bases[c.row[at]]
                    columns = [base, base + first - c.shift[at], end - first + 1, core.view(np.int64), whole[:, 0], whole[:, 1]]
                    yield pa.RecordBatch.from_arrays([*[pa.array(x) for x in columns], pa.array(slices, pa.binary())], names=[*names, "bytes"])

    cut_up = scratch.write("parts", long.mapInArrow(parts, schema + ", bytes binary"))
    seen.destroy()
    asked.destroy()
    firsts = scratch.write("part-firsts", classes_of(cut_up.drop("bytes")))
    scratch.write("runs-2", merged(run(later(cut_up.drop("core", "bytes"), firsts, WHOLE))))
    scratch.drop()
    left = scratch.write("left", in_question(firsts).select(*WHOLE, F.col("first").alias("at")))
    scratch.drop("part-firsts")
    # Few of the parts are left: a filter keeps the bytes of the others from moving.
    slices = spread_join(maybe_among(cut_up.drop("core"), left, "at", bits_for(left.count())), left, [*WHOLE, "at"])
    slices = scratch.write("slices", slices.select("base", "at", "n", "bytes"))
    scratch.drop("parts", "left")
    last = doubled(scratch, slices, lengths).withColumn("end", F.col("at") + threshold)
    runs = [spark.read.parquet(f"{scratch.folder}/runs-{i}") for i in (1, 2)]
    place = lambda c: (F.col(c) - F.col("base")).alias("begin" if c == "at" else c)
    spans = merged(runs[0].union(runs[1]).union(last)).groupBy("base").agg(F.array_sort(F.collect_list(F.struct(place("at"), place("end")))).alias("spans"))
    spans = scratch.write("spans", spans)
    scratch.drop("slices", "runs-1", "runs-2", "found")

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            begins, ends = (batch.column(2).flatten().field(k).to_numpy() for k in (0, 1))
            counts = batch.column(2).value_lengths().fill_null(0).to_numpy()
            upto = np.cumsum(counts)
            for x, a, z in zip(batch.column(1), (upto - counts).tolist(), upto.tolist(), strict=True):
                data, at, kept = x.as_buffer().to_pybytes(), 0, []
                for b, e in zip(begins[a:z].tolist(), ends[a:z].tolist(), strict=True):
                    kept.append(data[at:b])
                    at = e
                rest = b"".join([*kept, data[at:]])
                for values, v in zip(out, (len(data), len(data) - len(rest), z - a, hashlib.sha256(rest).hexdigest(), rest), strict=True):
                    values.append(v)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            spans = pa.compute.coalesce(batch.column(2), pa.array([[]], batch.column(2).type)[0])
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, out, kinds), spans], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"])

    result = f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary, spans array<struct<begin:bigint,end:bigint>>"
    judged = spread_join(texts, spans, "base", "left").select("doc_id", "text", "spans").mapInArrow(removed, result)
    copies = spread_join(keyed(sizes.filter(F.col("size") >= threshold), "doc_id"), keyed(places, "first_id").select("id_key", "t1", "t2", "base"), ["id_key", "t1", "t2"], "left_anti")
    gone = copies.select(
        "doc_id",
        F.col("size").alias("n_bytes"),
        F.col("size").alias("n_removed"),
        F.lit(1).cast("long").alias("n_spans"),
        F.sha2(F.lit(""), 256).alias("kept_sha256"),
        F.lit(b"").alias("kept"),
        F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.col("size").alias("end"))).alias("spans"),
    )
    return judged.unionByName(gone)
