"""The audits of sources and filters and the neighbour search against their SQL, brute force and awkward rows."""

import os
import re
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import numpy as np
import pytest

from tests.conftest import SMALL
from tests.llm.test_operators import CLASHES, ROWS
from tests.test_queries import plain
from tidemark.llm import filter_audit, nearest, queries, source_audit

NAMES = ["op11_source_audit", "op12_filter_audit", "op13_nearest"]


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_as_sql(spark, name):
    duck = duckdb.connect()
    for t in os.listdir(SMALL):
        duck.sql(f"CREATE VIEW {t.split('.')[0]} AS SELECT * FROM '{SMALL}/{t}'")
    df = queries.QUERIES[name](spark, SMALL)
    want = duck.sql(queries.ORACLES[name])
    columns = sorted(df.columns)
    assert sorted(want.columns) == columns
    rows = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    at = [want.columns.index(c) for c in columns]
    assert rows and rows == Counter(tuple(plain(r[i]) for i in at) for r in want.fetchall())


@pytest.fixture(scope="module")
def awkward(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    for c in CLASHES + ["Part", "term", "TOTAL", "mask", "first"]:
        df = df.selectExpr("*", f"'clash' as `{c}`") if c.lower() not in [x.lower() for x in df.columns] else df
    return df


class TestSources:
    def brute(self, rows, least, top):
        """By the definition, with Python's integers."""
        found, seen, groups = defaultdict(Counter), defaultdict(set), set()
        for nr, (_, text, lang, source) in enumerate(rows):
            lang, source = lang or "", source or ""
            groups.add((lang, source))
            lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
            for term in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower):
                found[lang, source][term] += 1
                seen[lang, term].add(nr)
        kept = defaultdict(set)
        for (lang, term), docs in seen.items():
            if len(docs) >= least:
                kept[lang].add(term)
        whole = defaultdict(Counter)
        for (lang, source), c in found.items():
            whole[lang].update(c)

        def shares(counts, lang):
            n, v = sum(counts[t] for t in kept[lang]), len(kept[lang])
            return {t: 1 + 10**9 * (counts[t] + 2) // (n + 2 * v) for t in kept[lang]}

        gap = lambda p, q: (p - q) * (p - q) // (p + q)
        out = []
        for lang, source in groups:
            p, q = shares(found[lang, source], lang), shares(whole[lang], lang)
            pairs = [(s, sum(gap(p[t], x[t]) for t in p)) for l, s in groups if l == lang and s != source for x in [shares(found[lang, s], lang)]]
            terms = [(t, gap(p[t], q[t])) for t in p if found[lang, source][t] and p[t] > q[t]]
            for part, items in (("pair", pairs), ("term", sorted(terms, key=lambda x: (-x[1], x[0].encode()))[:top])):
                out += [(lang, source, part, item, value, i) for i, (item, value) in enumerate(sorted(items, key=lambda x: (-x[1], x[0].encode())), 1)]
        return Counter(out)

    @pytest.mark.parametrize("least", [1, 2, 50])
    def test_awkward(self, awkward, least):
        rows = source_audit.source_divergence(awkward, least_docs=least).collect()
        assert Counter((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in rows) == self.brute(ROWS, least, 10)

    def test_many_shards_blocks_and_merges(self, spark, monkeypatch):
        rng = np.random.default_rng(5)
        rows = [(i, " ".join(f"W{rng.integers(0, 60):x}é_{rng.integers(0, 9)}" for _ in range(30)), "en" if i % 3 else "", f"s{rng.integers(0, 7)}") for i in range(120)]
        for name, v in (("SHARD", 20), ("BLOCK", 2), ("CELLS", 30), ("GROUP", 500), ("HELD", 50)):
            monkeypatch.setattr(source_audit, name, v)
        got = source_audit.source_divergence(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), least_docs=3).collect()
        assert Counter((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in got if r["rank"] <= 10 or r.part == "pair") == self.brute(rows, 3, 10)
        tables = list(map(source_audit.count_terms, *[[x] for x in map(source_audit.pa.array, ([r[2] for r in rows], [r[3] for r in rows], [r[1] for r in rows]))]))
        assert source_audit.merged(tables * 2)["n"].to_pylist() == [2 * x for x in source_audit.merged(tables)["n"].to_pylist()]

    def test_division_does_not_overflow(self):
        count, total, terms = np.array([0, 7, 10**15]), 10**15 + 7, 10**6
        assert source_audit.share(count, total, terms).tolist() == [1 + 10**9 * (int(c) + 2) // (total + 2 * terms) for c in count]

    def test_empty(self, spark):
        assert source_audit.source_divergence(spark.createDataFrame([], "doc_id long, text string, lang string, source string")).count() == 0


class TestFilters:
    def brute(self, rows, labels):
        good = {i for i, q, _ in labels if q == 1}
        toxic = {i for i, _, t in labels if t == 1}
        ids = defaultdict(list)
        for i, text, *_ in rows:
            if i is not None:
                ids[text or ""].append(i)
        fails, out = defaultdict(list), {}
        for i, text, _, source in rows:
            t = text or ""
            words = re.findall(r"[^\x20\x09-\x0D]+", t)
            copy = any(i is None or j < i for j in ids[t])
            own = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t), bool(re.search(r"[#$%&*|]", t)), copy]
            fails[source or ""].append((i, {f for f, x in zip("ABCDE", own, strict=True) if x}))
        for part, docs in fails.items():
            shapley = Counter()
            for order in permutations("ABCDE"):
                left, gone = docs, []
                for step, f in enumerate(order, 1):
                    here, left = [d for d in left if f in d[1]], [d for d in left if f not in d[1]]
                    shapley[f] += len(here)
                    out[part, "".join(order), step] = [len(left), len(here), sum(f in d[1] for d in gone), sum(d[1] == {f} for d in docs), sum(d[0] in good for d in here), sum(d[0] in toxic for d in here)]
                    gone = gone + here
            for (p, order, step), row in out.items():
                if p == part:
                    row.append(shapley[order[step - 1]])
        return out

    def test_awkward(self, spark, awkward):
        labels = [(1, 1, 0), (2, 0, 1), (2, 1, None), (8, None, 1), (99, 1, 1), (None, 1, 1), (10, None, None)]
        table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        rows = filter_audit.audit_filters(awkward, table).collect()
        got = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in rows}
        assert len(rows) == len(got) == 600 * 4 and got == self.brute(ROWS, [x for x in labels if x[0] is not None])

    def test_min_plus_ranks(self):
        orders, steps = filter_audit.removal_steps(4)
        for o, order in enumerate(orders.tolist()):
            for mask in range(16):
                at = [s for s, f in enumerate(order, 1) if mask >> f & 1]
                assert min(int(steps[mask, o]), 5) == (at[0] if at else 5)

    def test_empty(self, spark):
        none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
        assert filter_audit.audit_filters(spark.createDataFrame([], "doc_id long, text string, source string"), none).count() == 0


def neighbours(rows, every, k):
    usable = [(i, v) for i, v in rows if i is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    firsts = {}
    for i, v in usable:
        if i % every == 0:
            firsts[i] = min(firsts.get(i, v), v)
    out = []
    for q, x in firsts.items():
        scored = sorted((-sum_of(x, v), i) for i, v in usable if i != q and len(v) == len(x))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return Counter(out)


def sum_of(x, y):
    total = 0.0
    for a, b in zip(x, y, strict=True):
        total += a * b
    return total


class TestNearest:
    def run(self, spark, rows, kind="double", **options):
        df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").selectExpr("*", "'x' as dim", "1 as block", "2 as part", "3 as candidate", "4 as vector")
        return Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in nearest.nearest_neighbours(df, **options).collect())

    def test_awkward(self, spark):
        rows = [(0, [1.0, 2.0, -3.0]), (20, [0.5, 0.25, 1.0]), (20, [0.5, -0.25, 1.0]), (1, [1.0, 2.0, -3.0]), (2, [0.0, 0.0, 0.0]), (3, None), (4, []), (5, [1.0, None, 2.0])]
        rows += [(6, [1.0, float("nan"), 2.0]), (7, [float("inf"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (8, [1.0, 2.0]), (40, [3.0, 4.0]), (60, [1.0, 1.0, 1.0, 1.0]), (9, [1e-300, 0.0, 0.0]), (-20, [1.0, 0.0, 0.0])]
        assert self.run(spark, rows) == neighbours(rows, 20, 20)
        assert self.run(spark, []) == Counter()

    def test_copies_ties_and_near_copies(self, spark):
        rng = np.random.default_rng(3)
        base = rng.normal(size=(300, 8)).round(2)
        rows = [(i, base[i % 300].tolist()) for i in range(400)] + [(1000 + i, base[7].tolist()) for i in range(400)]
        rows += [(2000 + i, (base[11] + 1e-6 * rng.integers(-3, 4, 8)).tolist()) for i in range(300)] + [(2000, base[11].tolist())] * 30
        assert self.run(spark, rows, every=20, k=5) == neighbours(rows, 20, 5)

    def test_many_blocks_and_tiles(self, spark, monkeypatch):
        rng = np.random.default_rng(4)
        rows = [(i, rng.normal(size=5).astype(np.float32).tolist()) for i in range(700)]
        for name, v in (("QUERY_BLOCK", 5), ("PART", 60)):
            monkeypatch.setattr(nearest, name, v)
        assert self.run(spark, rows, "float") == neighbours([(i, [float(np.float32(c)) for c in v]) for i, v in rows], 20, 20)

    def test_tiles_of_a_few_cells(self, monkeypatch):
        monkeypatch.setattr(nearest, "CELLS", 40)
        monkeypatch.setattr(nearest, "PAIRS", 8)
        rng = np.random.default_rng(6)
        values = rng.normal(size=(200, 4))
        heaps = nearest.Heaps(nearest.Quantised(np.arange(7), values[:7]), 3)
        for at in range(0, 200, 50):
            heaps.show(nearest.Quantised(np.arange(at, at + 50), values[at : at + 50]))
        heaps.merge()
        want = neighbours([(i, v) for i, v in enumerate(values.tolist())], 1, 3)
        assert Counter((q, i, s) for q, s, i in zip(*(x.tolist() for x in heaps.best), strict=True)) == Counter((q, i, s) for q, _, i, s in want if q < 7)


def test_mix_of_small_sources_as_in_sql(spark, tmp_path):
    """Sources of under 512 blocks have shorter ones, in SQL too."""
    import duckdb
    from pyspark.sql import functions as F

    from tidemark.llm.queries import ORACLES, QUERIES

    i = F.col("id")
    source = F.when(i % 1500 == 1, "few").when(i % 600 == 2, "less").when(i % 7 == 0, None).otherwise("most")
    docs = spark.range(3000).select(i.alias("doc_id"), F.expr("repeat('word ', int(id * 37 % 900))").alias("text"), source.alias("source"))
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op8_mix_sources"](spark, str(tmp_path)).collect()
    c = duckdb.connect()
    c.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = {r[0]: r[1:] for r in c.sql(f"SELECT doc_id, size, source_size, taken FROM ({ORACLES['op8_mix_sources']})").fetchall()}
    assert {r.doc_id: (r.size, r.source_size, r.taken) for r in got} == want
    total = sum(r.size for r in got)
    block = total // 131072
    assert block > 1 and min(r.source_size for r in got) < 512 * block
