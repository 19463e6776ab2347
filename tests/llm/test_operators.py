"""Operators against brute force on the small table, and on rows that are awkward."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tidemark.llm import common, exact_dedup, language_id, line_dedup, lm_scoring, mixing, packing, quality, queries, simhash, suffix_dedup, topk

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
LONG = "\n".join(f"line {i} of a rather long text that goes on" for i in range(3000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a"),
    (3, "The  quick\tbrown fox jumps over the lazy dog near the river bank today", None, None),
    (4, None, "en", "b"),
    (5, "", "de", "b"),
    (6, "   \n\t ", "de", None),
    (7, "12345 !!! ???", "fr", "c"),
    (8, LONG, "en", "a"),
    (9, "Der schnelle braune Fuchs springt über den faulen Hund am Ufer", "de", "b"),
    (None, "Ein Text ohne Nummer", "de", "b"),
    (None, None, None, None),
    (10, "x", "en", "c"),
]
CLASHES = ["kept", "h", "slot", "fp", "node", "row", "place", "n", "key", "size", "length", "bucket", "uid", "held_out", "score", "rank", "doc", "pos"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


@pytest.fixture(scope="module")
def awkward(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    for c in CLASHES:
        df = df.selectExpr("*", f"'clash' as `{c}`")
    return df


def words(text):
    return WORDS.findall((text or "").encode().lower())


def crc(i, m):
    return zlib.crc32(("" if i is None else str(i)).encode()) % m


def by_id(rows):
    out = defaultdict(list)
    for r in rows:
        out[r.doc_id].append(r)
    return out


class TestLanguage:
    def test_held_out_accuracy(self, spark, docs):
        lang = {r.doc_id: r.lang for r in docs.collect()}
        rows = [r for r in language_id.identify_languages(docs).collect() if r.held_out]
        assert rows and sum(r.lang_pred == lang[r.doc_id] for r in rows) / len(rows) > 0.95

    def test_awkward(self, awkward):
        rows = language_id.identify_languages(awkward).collect()
        assert len(rows) == len(ROWS)
        got = by_id(rows)
        assert all(got[i][0].lang_pred == "und" and got[i][0].score == 0 for i in (4, 5, 6, 7))
        assert all(0 <= r.score <= 1 for r in rows) and all(r.held_out == (crc(r.doc_id, 4) == 2) for r in rows)

    def test_empty(self, awkward):
        assert language_id.identify_languages(awkward.limit(0)).count() == 0

    def test_languages_of_long_texts_only(self, spark):
        said = {"de": "der schnelle braune fuchs springt über den faulen hund am ufer ", "fr": "le renard brun saute par dessus le chien paresseux près de la rivière "}
        rows = [(i, text * 200, lang) for lang, text in said.items() for i in range(len(lang), 40)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2)
        asked = spark.createDataFrame([(1000, said["de"], None), (1001, said["fr"], None)], docs.schema)
        got = language_id.identify_languages(docs.union(asked)).collect()
        assert {r.doc_id: r.lang_pred for r in got if r.doc_id >= 1000} == {1000: "de", 1001: "fr"}
        assert Counter(r.lang_pred for r in got if r.doc_id < 1000) == Counter(lang for _, _, lang in rows)
        sample = language_id.training_texts(docs.selectExpr("*", "false as held_out"), 40, 30_000, 700)
        assert {k: len(v) for k, v in sample.items()} == dict.fromkeys(said, 38 * 701 - 1)

    def test_most_languages(self, spark):
        said = {"de": "der schnelle braune fuchs ", "fr": "le renard brun saute ", "en": "the quick brown fox jumps "}
        rows = [(i, text, lang) for k, (lang, text) in enumerate(said.items()) for i in range(100 * k, 100 * k + 20 + 5 * k)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        # Those with the most labelled rows are learned.
        got = {r.lang_pred for r in language_id.identify_languages(docs, max_langs=2).collect()}
        assert got == {"fr", "en"}
        added = language_id.add_languages(docs, "found", max_langs=1)
        assert {r.lang_pred for r in added.select("found.lang_pred").collect()} == {"en"}

    def test_memory_of_many_labels(self):
        rng = np.random.default_rng(5)
        texts = {f"l{i:03d}": "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyzäöüßéèñ "), 600)) for i in range(200)}
        asked = [texts["l007"][100:400], texts["l150"][:200], None, "12"]
        small, large = language_id.CrossParser(texts, 512, dense=1 << 20), language_id.CrossParser(texts, 512)
        assert small(asked)[0] == large(asked)[0] == ["l007", "l150", "und", "und"]
        assert small(asked)[1].tolist() == large(asked)[1].tolist()
        size = lambda p: sum(t.to.nbytes + (0 if t.owner is None else t.owner.nbytes + t.base.nbytes) for t in p.tables)
        assert all(t.owner is not None for t in small.tables) and all(t.owner is None for t in large.tables)
        assert size(small) < size(large) / 2 and size(large) <= 4 * language_id.DENSE

    @pytest.mark.parametrize("dense", [1 << 23, 0])
    def test_automaton_holds_exactly_the_substrings(self, dense):
        text = "abracadabra"
        alphabet = language_id.Alphabet([text])
        table = language_id.suffix_automaton(alphabet(language_id.letters_only(text)), alphabet.size, dense)

        def held(s):
            state = np.array([1])
            for c in alphabet(language_id.letters_only(s)).tolist():
                state = table(state, np.array([c]))
                if not state[0]:
                    return False
            return True

        pool = {text[i:j] for i in range(len(text)) for j in range(i + 1, len(text) + 1)}
        assert all(map(held, pool)) and not any(held(s) for s in ("aa", "rab", "dac", "abraa"))

    def test_large_alphabets_take_little_room(self):
        rng = np.random.default_rng(6)
        text = "".join(map(chr, rng.integers(0x4E00, 0x4E00 + 4000, 30_000)))
        parser = language_id.CrossParser({"a": text, "b": text[::-1]}, 512)
        assert all(len(t.to) < 1_000_000 for t in parser.tables)
        assert parser([text[5000:6000], text[::-1][5000:6000]])[0] == ["a", "b"]

    def phrases(self, text, training):
        n, at = 0, 0
        while at < len(text):
            size = 1
            while at + size < len(text) and text[at : at + size + 1] in training:
                size += 1
            at, n = at + size, n + 1
        return n

    def test_phrases_are_longest_matches(self):
        parser = language_id.CrossParser({"a": "abcabd", "b": "xyzxyw"}, 512)
        text = "abcabdabxyz"
        codes = parser.alphabet(language_id.letters_only(text))
        got = [int(parser.phrases(codes, np.array([0]), np.array([len(text)]), t)[0]) for t in parser.tables]
        assert got == [self.phrases(text, "abcabd"), self.phrases(text, "xyzxyw")]

    def test_predictions_against_a_slow_parser(self, spark, docs, texts):
        rows = docs.selectExpr("doc_id", "text", "lang", "crc32(cast(cast(doc_id as string) as binary)) % 4 = 2 as held_out")
        sample = language_id.training_texts(rows, 10, 6_000, 5_000)
        plain = lambda t: "".join(c if c.isalpha() else " " for c in t.lower())
        learned = {k: plain(t) for k, t in sample.items()}
        few = docs.filter("length(text) between 20 and 2000").limit(40)
        got = {r.doc_id: r.lang_pred for r in language_id.identify_languages(few.union(docs.filter("length(text) > 2000")), max_docs=10, max_chars=6_000).collect()}
        parser = language_id.CrossParser(sample, 512)
        whole = language_id.CrossParser(sample, 1 << 30)
        ids = [r.doc_id for r in few.collect()]
        for i, fast in zip(ids, parser([texts[i] for i in ids])[0], strict=True):
            text = plain(texts[i])
            cost = {k: math.log2(len(sample[k]) + 2) * sum(self.phrases(text[a : a + 512], learned[k]) for a in range(0, len(text), 512)) for k in sample}
            assert fast == min(sorted(cost), key=cost.get)
        # Where phrases end at multiples of 512 changes no prediction.
        assert parser(list(texts.values()))[0] == whole(list(texts.values()))[0]
        assert set(got) >= set(ids)


class TestQuality:
    def test_held_out(self, spark, docs):
        labels = spark.read.parquet(f"{SMALL}/labels.parquet")
        y = {r.doc_id: r.quality for r in labels.collect()}
        rows = [r for r in quality.score_quality(docs, labels).collect() if r.doc_id in y]
        good = [r.score for r in rows if y[r.doc_id] == 1]
        bad = [r.score for r in rows if y[r.doc_id] == 0]
        assert np.mean([a > b for a in good for b in bad]) > 0.9

    def test_awkward(self, spark, awkward):
        labels = spark.createDataFrame([(1, 1, "x"), (1, 1, "x"), (9, 0, "x"), (None, 1, "x"), (8, None, "x"), (5, 7, "x")], "doc_id long, quality int, text string")
        rows = quality.score_quality(awkward, labels).collect()
        assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
        assert quality.score_quality(awkward.limit(0), labels).count() == 0
        assert {r.score for r in quality.score_quality(awkward, labels.limit(0)).collect()} == {0.5}

    def test_rows_are_bounded(self, spark):
        """One id with many texts: the bound is one of rows, and a text that repeats is learned once."""
        texts = [f"word{i} good text {i % 7}" for i in range(60)]
        docs = spark.createDataFrame([(1, t) for t in texts + texts[:20] * 3], "doc_id long, text string").repartition(5)
        labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
        order = [r.text for r in docs.distinct().orderBy(F.xxhash64("text")).collect()]
        for bound, most in ((1, 1 << 28), (7, 1 << 28), (60, 1), (60, 1 << 28)):
            taken = order[: 1 if most == 1 else bound]
            alone = spark.createDataFrame([(1, t) for t in taken] + [(None, t) for t in order], docs.schema)
            weights = [quality.train(d.select("doc_id", "text"), labels, "quality", n, b, 2, 10, 2, 0.5, 1.0, 0.02, 0.1) for d, n, b in ((docs, bound, most), (alone, 1000, 1 << 28))]
            assert weights[0].any() and weights[0].tolist() == weights[1].tolist()
        assert {r.score for r in quality.score_quality(docs, labels, max_bytes=0).collect()} == {0.5}

    def test_ftrl_against_plain_python(self):
        rng = np.random.default_rng(11)
        rows = [(np.sort(rng.choice(12, 4, replace=False)), rng.random(4) * 3, int(rng.integers(2))) for _ in range(25)]
        alpha, beta, l1, l2 = 0.5, 1.0, 0.02, 0.1
        z, n = [0.0] * 13, [0.0] * 13

        def weight(i):
            if abs(z[i]) <= l1:
                return 0.0
            return -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

        for _ in range(3):
            for at, value, label in rows:
                x = {**dict(zip(at.tolist(), value.tolist(), strict=True)), 12: 1.0}
                w = {i: weight(i) for i in x}
                p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x.items())))
                for i, v in x.items():
                    g = (p - label) * v
                    z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha * w[i]
                    n[i] += g * g
        got = quality.train_ftrl(rows, 12, 3, alpha, beta, l1, l2)
        assert got == pytest.approx([weight(i) for i in range(13)])

    def test_scores_against_plain_python(self, spark, docs, texts):
        """Counts, weights and scores of the whole way again, with one shard and dictionaries."""
        labels = spark.read.parquet(f"{SMALL}/labels.parquet")
        bits, epochs = 10, 2
        y = {}
        for r in labels.collect():
            if r.quality in (0, 1) and crc(r.doc_id, 3) != 1:
                y[r.doc_id] = max(y.get(r.doc_id, 0), r.quality)
        index = quality.Features(bits)
        vectors = {i: Counter(index((t or "").encode()).tolist()) for i, t in texts.items()}
        z, n = Counter(), Counter()

        def weight(i):
            return 0.0 if abs(z[i]) <= 0.02 else -(z[i] - math.copysign(0.02, z[i])) / ((1 + math.sqrt(n[i])) / 0.5 + 0.1)

        def logit(v):
            return sum(weight(i) * c for i, c in v.items()) * 8.0 / v.total() + weight("bias")

        for _ in range(epochs):
            for i in sorted((i for i in y if i in texts), key=lambda i: (zlib.crc32(str(i).encode()), i)):
                v, p = vectors[i], 1 / (1 + math.exp(-logit(vectors[i])))
                w = {k: weight(k) for k in [*v, "bias"]}
                for k in w:
                    g = (p - y[i]) * (1.0 if k == "bias" else v[k] * 8.0 / v.total())
                    z[k] += g - (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / 0.5 * w[k]
                    n[k] += g * g
        for r in quality.score_quality(docs, labels, shards=1, bits=bits, epochs=epochs).collect():
            assert r.score == pytest.approx(1 / (1 + math.exp(-logit(vectors[r.doc_id]))), abs=1e-6)


class TestExact:
    def brute(self, rows):
        norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
        groups = defaultdict(list)
        for i, t in norm:
            groups[t].append(i)
        out = []
        for t, ids in groups.items():
            keep = min((i for i in ids if i is not None), default=None)
            taken = False
            for i in ids:
                kept = i == keep and not taken
                taken |= kept
                out.append((i, keep, len(ids), kept, hashlib.sha256(t.encode()).hexdigest()))
        return Counter(out)

    @pytest.mark.parametrize("bits, passes", [(None, None), (64, None), (1 << 20, None), (1 << 34, 1 << 36), (1 << 12, 1 << 10), (1 << 34, 1 << 33)])
    def test_awkward(self, awkward, bits, passes):
        got = Counter(map(tuple, exact_dedup.exact_dedup(awkward, filter_bits=bits, pass_bits=passes or exact_dedup.MOST_BITS).collect()))
        assert got == self.brute([(i, t) for i, t, _, _ in ROWS])

    @pytest.mark.parametrize("bits", [1 << 16, 1 << 27, 1 << 30, 1 << 34])
    def test_unique_rows_do_not_move(self, spark, bits):
        """Whatever the filter's size, rows meet it by broadcast, and no exchange has their hashes."""
        hashed = spark.range(50).selectExpr("id as doc_id", "unhex(sha2(cast(id div 2 as string), 256)) as sha").checkpoint()
        flagged = exact_dedup.flagged_rows(hashed, 50, bits, 2)
        assert flagged.filter("maybe_repeated").count() == 50
        plan = flagged._jdf.queryExecution().executedPlan().toString()
        moved = re.findall(r"Exchange (?:hash|range|SinglePartition)[^\n]*", plan)
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and moved and not any("sha" in m for m in moved)

    def test_pages(self, spark):
        keys = spark.range(3000).selectExpr("id", "cast(id as string) as k")
        some = {r.id for r in exact_dedup.maybe_among(keys, keys.filter("id % 7 = 0").union(keys.filter("id = 0")), "k", 1 << 18).collect()}
        assert set(range(0, 3000, 7)) <= some and len(some) < 450

    def test_table(self, docs, texts):
        assert Counter(map(tuple, exact_dedup.exact_dedup(docs).collect())) == self.brute(list(texts.items()))

    def test_empty(self, awkward):
        assert exact_dedup.exact_dedup(awkward.limit(0)).count() == 0
        assert exact_dedup.exact_dedup(awkward.limit(0), filter_bits=1 << 12, pass_bits=1 << 10).count() == 0


class TestModel:
    def test_base_and_likelihood(self, docs, texts):
        rows = lm_scoring.score_texts(docs, rounds=3).collect()
        tokens = {i: [*words(t), None] for i, t in texts.items()}
        count = Counter(w for i, t in tokens.items() if crc(i, 10) for w in t)
        n, v = sum(count.values()), len(count)
        for r in rows:
            t = tokens[r.doc_id]
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(w in count for w in t), n)
            assert r.base_score == pytest.approx(sum(np.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t))
        held = [r for r in rows if r.held_out]
        assert sum(r.score for r in held) > sum(r.base_score for r in held)

    def test_forward_is_the_sum_over_paths(self):
        rng = np.random.default_rng(0)
        hmm = lm_scoring.HMM(rng.dirichlet([1] * 3), rng.dirichlet([1] * 3, 3), rng.dirichlet([1] * 5, 3))
        codes = rng.integers(0, 5, 6)
        total = 0.0
        for path in np.ndindex(*[3] * 6):
            p = hmm.start[path[0]] * hmm.emit[path[0], codes[0]]
            for t in range(1, 6):
                p *= hmm.move[path[t - 1], path[t]] * hmm.emit[path[t], codes[t]]
            total += p
        got = hmm.forward(codes, np.array([0]), np.array([6]))
        assert got[0] == pytest.approx(np.log10(total))

    def test_segments_of_long_texts(self, monkeypatch):
        rng = np.random.default_rng(7)
        hmm = lm_scoring.HMM(rng.dirichlet([1] * 3), rng.dirichlet([1] * 3, 3), rng.dirichlet([1] * 5, 3))
        codes, lengths = rng.integers(0, 5, 1500), np.array([1000, 400, 100])
        starts = np.array([0, 1000, 1400])
        whole = hmm.forward(codes, starts, lengths)
        monkeypatch.setattr(lm_scoring, "LONG", 300)
        monkeypatch.setattr(lm_scoring, "SEGMENT", 64)
        assert hmm.forward(codes, starts, lengths) == pytest.approx(whole)

    def test_the_head_does_not_change_results(self, docs):
        few = docs.filter("doc_id < 60")
        rows = [{r.doc_id: r for r in lm_scoring.score_texts(few, rounds=1, states=2, head_tokens=n, own_classes=20).collect()} for n in (50, 1 << 19)]
        for i, r in rows[0].items():
            other = rows[1][i]
            assert (r.n_known, r.base_score, r.score) == (other.n_known, pytest.approx(other.base_score), pytest.approx(other.score))

    def test_expected_counts(self):
        rng = np.random.default_rng(1)
        hmm = lm_scoring.HMM(rng.dirichlet([1] * 2), rng.dirichlet([1] * 2, 2), rng.dirichlet([1] * 3, 2))
        codes = np.array([0, 2, 1, 1, 0])
        want, total = np.zeros((3 + 2 + 1, 2)), 0.0
        for path in np.ndindex(*[2] * 5):
            p = hmm.start[path[0]] * hmm.emit[path[0], codes[0]]
            for t in range(1, 5):
                p *= hmm.move[path[t - 1], path[t]] * hmm.emit[path[t], codes[t]]
            total += p
            for t in range(5):
                want[codes[t], path[t]] += p
                if t:
                    want[3 + path[t - 1], path[t]] += p
            want[5, path[0]] += p
        out = np.zeros_like(want)
        hmm.expected(codes, np.array([0]), np.array([5]), np.array([True]), out)
        assert np.allclose(out, want / total)

    def test_awkward(self, awkward):
        rows = lm_scoring.score_texts(awkward, rounds=2, states=2).collect()
        assert len(rows) == len(ROWS) and all(np.isfinite(r.score) and r.score <= 0 for r in rows)
        assert by_id(rows)[4][0].n_tokens == 1
        assert lm_scoring.score_texts(awkward.limit(0), rounds=1).count() == 0
        alone = lm_scoring.score_texts(awkward.filter("crc32(cast(cast(doc_id as string) as binary)) % 10 = 0"), rounds=1).collect()
        assert all(r.train_tokens == 0 and np.isfinite(r.score) for r in alone)


def simhash_of(text):
    w = words(text)
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints):
    """id -> smallest id reachable over pairs at two bits or fewer."""
    ids = sorted(prints)
    label = {i: i for i in ids}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for k, i in enumerate(ids):
        for j in ids[:k]:
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


class TestSimHash:
    def test_masks_cover(self):
        masks = simhash.covering_masks(2)
        for i in range(64):
            for j in range(i, 64):
                assert any(not (m & (1 << i | 1 << j)) for m in masks)

    def test_table(self, docs, texts):
        prints = {i: simhash_of(t) for i, t in texts.items()}
        want = components(prints)
        rows = simhash.simhash_components(docs).collect()
        assert len(rows) == len(texts)
        assert all((r.fingerprint, r.component_id) == (f"{prints[r.doc_id]:016x}", want[r.doc_id]) for r in rows)

    def test_long_texts(self, spark):
        text = " ".join(f"word{i % 977} and{i % 31}" for i in range(150_000))
        rows = [(1, text), (2, text + " more"), (3, text.upper())]
        got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert {i: v[0] for i, v in got.items()} == {i: f"{simhash_of(t):016x}" for i, t in rows}
        assert {v[1] for v in got.values()} == {1}

    def test_chains_of_links(self, spark):
        rng = np.random.default_rng(5)
        fps, at = [], int(rng.integers(1 << 62))
        for _ in range(60):  # a long chain, then far ones
            fps.append(at)
            at ^= sum(1 << int(b) for b in rng.choice(64, 2, replace=False))
        fps += [int(x) for x in rng.integers(0, 1 << 62, 40)]
        fps = list(dict.fromkeys(fps))
        prints = {i + 1: f for i, f in enumerate(fps)}
        nodes = spark.createDataFrame([(i, simhash.signed(f)) for i, f in prints.items()], "node long, fp long")
        found = {r.node: r.component for r in simhash.connected_components(simhash.links(nodes)).collect()}
        assert {i: found.get(i, i) for i in prints} == components(prints)

    def test_awkward(self, awkward):
        rows = simhash.simhash_components(awkward).collect()
        got = by_id(rows)
        assert len(rows) == len(ROWS)
        assert {r.component_id for i in (1, 2, 3) for r in got[i]} == {1}
        assert {r.component_id for i in (4, 5, 6) for r in got[i]} == {4} and {r.fingerprint for r in got[4]} == {"0" * 16}
        assert {r.component_id for r in got[None]} == {None, 4}
        assert simhash.simhash_components(awkward.limit(0)).count() == 0


class TestTopK:
    @pytest.mark.parametrize("pass_bytes", [64_000_000, 1000])
    def test_brute_force(self, spark, monkeypatch, pass_bytes):
        monkeypatch.setattr(topk, "PASS_BYTES", pass_bytes)
        rng = np.random.default_rng(3)
        base = rng.standard_normal((30, 24))
        rows = [(i, (base[i % 30] + 0.1 * rng.standard_normal(24)).tolist()) for i in range(400)]
        rows += [(400, None), (401, [None] + [1.0] * 23), (402, [float("nan")] * 24), (403, [float("inf")] * 24), (404, []), (450, rows[0][1]), (None, rows[1][1]), (500, [1.0, 2.0]), (501, [3.0, -1.0]), (550, []), (502, [1e30] * 24)]
        rows += [(503, [-1e30] * 24), (600, [1e30] * 23 + [1.0]), (504, [1e308] + [0.5] * 23), (505, [2.0**40] * 24), (650, [2.0**41 + 0.5] * 24), (506, [1e6, 1e6]), (507, [1.0, 1.0])]
        rows += [(7, rows[7][1])]
        df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string")
        whole = lambda v: [int(Fraction(x) * 256 // 1) for x in v]
        usable = [(i, whole(v)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
        want = []
        for q, x in usable:
            if q % 50 == 0:
                scores = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in usable if i != q and len(y) == len(x))[:5]
                want += [(q, k + 1, i, min(max(-s, -(2**63)), 2**63 - 1)) for k, (s, i) in enumerate(scores)]
        assert sorted(map(tuple, topk.exact_top_k(df).collect())) == sorted(want)
        assert topk.exact_top_k(df.limit(0)).count() == 0

    def test_bounds(self):
        rng = np.random.default_rng(4)
        x, y = rng.standard_normal((50, 64)), rng.standard_normal((50, 64))
        for s in topk.RESOLUTIONS:
            assert ((topk.segment_statistics(x, s) * topk.segment_statistics(y, s)).sum(axis=1) >= (x * y).sum(axis=1) - 1e-9).all()


def distance_at_most_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    return a[k + 1 :] == b[k + 1 :] or a[k:] == b[k + 1 :] or a[k + 1 :] == b[k:]


class TestLines:
    def brute(self, texts):
        """(n_exact, n_near, kept text) per text, in order."""
        first, out = {}, []
        for text in texts:
            kept, exact, near = [], 0, 0
            for line in (text or "").split("\n"):
                s = line.strip(" \t\r\x0b\x0c")
                if s and s in first:
                    exact += 1
                    continue
                alike = s and len(s) >= 20 and any(len(o) >= 20 and distance_at_most_one(s, o) for o in first)
                if s:
                    first[s] = True
                if alike:
                    near += 1
                else:
                    kept.append(line)
            out.append((exact, near, "\n".join(kept)))
        return out

    def test_table(self, docs, texts):
        ids = sorted(texts)
        want = dict(zip(ids, self.brute([texts[i] for i in ids]), strict=True))
        for r in line_dedup.line_dedup(docs).collect():
            assert (r["_lines"].n_exact, r["_lines"].n_near, r.text) == want[r.doc_id]

    def test_edits(self, spark):
        rng = np.random.default_rng(8)
        base = ["".join(rng.choice(list("abcé ñ"), n)).strip() + "." for n in (19, 20, 21, 25, 40, 300, 600)]
        lines = []
        for b in base:
            lines.append(b)
            for _ in range(12):
                k = int(rng.integers(len(b)))
                edit = int(rng.integers(4))
                lines.append([b[:k] + "X" + b[k:], b[:k] + b[k + 1 :], b[:k] + "Y" + b[k + 1 :], b[:k] + "XY" + b[k:]][edit])
        lines = [lines[i] for i in rng.permutation(len(lines))]
        rows = [(i, "\n".join(lines[4 * i : 4 * i + 4])) for i in range(-(-len(lines) // 4))]
        got = sorted(line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect())
        want = self.brute([t for _, t in rows])
        assert [(r["_lines"].n_exact, r["_lines"].n_near, r.text) for r in got] == want
        assert sum(w[1] for w in want) > 20

    def test_long_texts_and_lines(self, spark):
        rng = np.random.default_rng(9)
        many = "\n".join(["the same line again and again"] * 100_000)
        line = "".join(rng.choice(list("abcdefgh "), 1_000_000)).strip() * 5
        edits = [line[:3_000_000] + "X" + line[3_000_001:], line[:700] + line[701:], line + "Y", "Z" + line, line[:10] + "XX" + line[10:]]
        texts = [many, line, *edits, many]
        rows = line_dedup.line_dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
        assert [(r["_lines"].n_exact, r["_lines"].n_near) for r in rows] == [(99_999, 0), (0, 0), (0, 1), (0, 1), (0, 1), (0, 1), (0, 0), (100_000, 0)]
        assert [r.text for r in rows] == ["the same line again and again", line, "", "", "", "", edits[-1], ""]

    @pytest.mark.parametrize("name", ["_lines", "_LINES"])
    def test_query_on_a_table_with_its_prefix(self, awkward, tmp_path, name):
        awkward.withColumn(name, awkward.kept).write.parquet(f"{tmp_path}/documents.parquet")
        rows = queries.op7_line_dedup(awkward.sparkSession, str(tmp_path)).collect()
        assert len(rows) == len(ROWS) and rows[0].asDict().keys() == {"doc_id", "n_lines", "n_exact", "n_near", "kept_sha256"}

    def test_clash_of_the_prefix(self, awkward):
        with pytest.raises(ValueError, match="n"):
            line_dedup.line_dedup(awkward, prefix="n")

    def test_awkward(self, awkward):
        rows = line_dedup.line_dedup(awkward).collect()
        assert len(rows) == len(ROWS) and rows[0].kept == "clash" and rows[0].n == "clash"
        got = by_id(rows)
        assert got[4][0].text is None and got[5][0].text == "" and got[1][0]["_lines"].n_exact == 0
        # rows that repeat id and text are judged alike
        assert [r["_lines"].n_exact for r in got[2]] == [1, 1]
        assert line_dedup.line_dedup(awkward.limit(0)).count() == 0


class TestMixing:
    def test_targets(self, spark):
        sizes = spark.createDataFrame([("0a", 10), ("0b", 1000), ("0c", 100), ("1", 0)], "src string, source_size long")
        got = {r.src: r.target for r in mixing.source_targets(common.Scratch(spark), sizes).collect()}
        left, open_, target = 1110.0, {"0a": (5, 30), "0b": (2, 3000), "0c": (1, 300), "1": (5, 0)}, {}
        while True:
            level = left / sum(w for w, _ in open_.values())
            full = {k for k, (w, cap) in open_.items() if w * level >= cap}
            if not full:
                break
            for k in full:
                target[k] = float(open_.pop(k)[1])
                left -= target[k]
        target |= {k: w * level for k, (w, _) in open_.items()}
        assert got == pytest.approx(target) and sum(got.values()) == pytest.approx(1110)

    def test_taken(self, docs, texts):
        taken, schedule = mixing.mix_sources(docs)
        rows = taken.collect()
        per = defaultdict(list)
        for r in rows:
            assert r.size == len(words(texts[r.doc_id])) and 0 <= r.taken <= 3 * r.size
            per[r.source].append(r)
        for own in per.values():
            assert own[0].source_size == sum(r.size for r in own)
            assert abs(sum(r.taken for r in own) - own[0].target) <= max(10, 0.01 * own[0].target)
        assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mix_sources(docs)[0].collect()))
        # every prefix of the schedule has about the target weights
        order = [r.source for r in schedule.orderBy("slot").limit(4000).collect()]
        total = sum(own[0].target for own in per.values())
        for s, own in per.items():
            assert abs(order.count(s) / len(order) - own[0].target / total) < 0.01

    def test_awkward(self, awkward):
        rows = mixing.mix_sources(awkward)[0].collect()
        assert Counter((r.doc_id, r.size) for r in rows) == Counter((i, len(words(t))) for i, t, _, _ in ROWS)
        assert all(r.taken <= 3 * r.size for r in rows)
        assert mixing.mix_sources(awkward.limit(0))[0].count() == 0

    def test_small_sources_beside_a_large_one(self, spark):
        sizes = {"a": [1000] * 2000, "b": [100] * 3, "c": [70] * 100, "d": [1]}
        rows = [(s, i, n) for s, own in sizes.items() for i, n in enumerate(own)]
        docs = spark.createDataFrame(rows, "source string, i int, n int").selectExpr("concat(source, i) as doc_id", "repeat('w ', n) as text", "source")
        taken, schedule = mixing.mix_sources(docs, least_slots=1 << 11)
        per = defaultdict(list)
        for r in taken.collect():
            assert 0 <= r.taken <= 3 * r.size
            per[r.source].append(r)
        for own in per.values():
            assert own[0].source == "a" or all(r.taken > 0 for r in own)
            assert abs(sum(r.taken for r in own) - own[0].target) <= max(3, 0.01 * own[0].target)
        words, total = Counter(), sum(own[0].target for own in per.values())
        order = schedule.orderBy("slot").collect()
        for r in order[: len(order) // 2]:
            words[r.source] += r.length
        assert all(abs(words[s] / words.total() - own[0].target / total) < 0.005 for s, own in per.items())


class TestPacking:
    def ids(self, text):
        import public_tokenizers
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
        return np.array(t.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")

    def check(self, rows, texts, room=2048):
        """texts: id -> text, one row each."""
        for i, own in by_id(rows).items():
            ids, at = self.ids(texts[i]), 0
            for r in sorted(own, key=lambda r: r.start):
                assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
                at += r.length
            assert at == len(ids)
        sequences = defaultdict(list)
        for r in rows:
            sequences[r.sequence_id].append((r.offset, r.length))
        for parts in sequences.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= room
        return sum(r.length for r in rows) / (len(sequences) * room)

    def test_table(self, docs, texts):
        assert self.check(packing.pack_documents(docs).collect(), texts) > 0.97

    def test_awkward(self, spark, awkward):
        rows = packing.pack_documents(awkward, max_tokens=64).collect()
        assert Counter(r.doc_id for r in rows if r.start == 0) == Counter(i for i, *_ in ROWS)
        assert packing.pack_documents(awkward.limit(0)).count() == 0
        odd = {1: "don't <|endoftext|> É ́ x", 2: "A　B c", 3: "İstanbul ΣΑΣ", 4: "<|startoftext|>!", 5: "é ́", 6: LONG}
        self.check(packing.pack_documents(spark.createDataFrame(list(odd.items()), "doc_id long, text string")).collect(), odd)

    def test_histogram(self):
        rng = np.random.default_rng(2)
        counts = {int(k): int(c) for k, c in zip(rng.choice(np.arange(1, 101), 60, replace=False), rng.integers(0, 500, 60), strict=True)}
        patterns = packing.pack_histogram(counts, 100)
        placed = Counter()
        for n, pattern in patterns:
            assert sum(pattern) <= 100 and list(pattern) == sorted(pattern, reverse=True)
            placed.update({k: n * c for k, c in Counter(pattern).items()})
        assert placed == Counter({k: c for k, c in counts.items() if c})


class TestSuffix:
    def brute(self, rows, threshold):
        """rows in order; (n_bytes, n_removed, n_spans, digest) each."""
        seen, out = set(), []
        for text in rows:
            b = (text or "").encode()
            gone = np.zeros(len(b), bool)
            for x in range(len(b) - threshold + 1):
                w = b[x : x + threshold]
                if w in seen:
                    gone[x : x + threshold] = True
                seen.add(w)
            kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
            out.append((len(b), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
        return out

    def check(self, df, ids, texts, threshold=100):
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(df, threshold=threshold).collect()}
        want = dict(zip(ids, self.brute(texts, threshold), strict=True))
        assert got == want
        return want

    def test_table(self, docs, texts):
        ids = sorted(texts)
        assert sum(w[1] for w in self.check(docs, ids, [texts[i] for i in ids]).values())

    @pytest.mark.parametrize("threshold", [20, 100])
    def test_made_up_repeats(self, spark, threshold):
        rng = np.random.default_rng(threshold)
        pool = ["".join(rng.choice(list("abcdefgh ß"), int(n))) for n in rng.integers(threshold // 2, threshold * 3, 12)]
        texts = []
        for _ in range(40):
            parts = [pool[int(rng.integers(12))] if rng.random() < 0.5 else "".join(rng.choice(list("abcdefgh"), int(rng.integers(1, 80)))) for _ in range(6)]
            texts.append("".join(parts))
        texts += ["ab" * 300, "x" * 500, "xyz" * 150, None, "", "x" * threshold, texts[0]]
        rows = [(i, t) for i, t in enumerate(texts)]
        self.check(spark.createDataFrame(rows, "doc_id long, text string"), range(len(texts)), texts, threshold)

    def test_awkward(self, awkward):
        rows = suffix_dedup.remove_repeats(awkward, threshold=30).collect()
        assert len(rows) == len(ROWS)
        got = by_id(rows)
        assert got[4][0].n_bytes == 0 and got[1][0].n_removed == 0
        assert all(r.n_removed == r.n_bytes for r in got[2])  # copies of row 1, and not of each other
        assert suffix_dedup.remove_repeats(awkward.limit(0)).count() == 0
