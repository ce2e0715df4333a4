"""MinHash near duplicates, hard negatives and collocations against brute force, on the tables and on
odd rows."""

import itertools
import math
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from tierstore.llm import collocations, components, hard_negatives, minhash
from tierstore.llm.ngram_join import Rule, shingle_sets

SF = "/root/testdata/sf0.01"


# -- MinHash -------------------------------------------------------------------------------------

def _sets(text, k=3):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    k = min(k, len(w))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else frozenset()


def _components(rows, k=3, numerator=85):
    sets = [(i, _sets(t, k)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    named = [(i, s) for i, s in sets if i is not None and s]
    for (i, a), (j, b) in itertools.combinations(named, 2):
        if min(len(a), len(b)) * 100 >= numerator * max(len(a), len(b)) and 100 * len(a & b) >= numerator * len(a | b) or i == j:
            x, y = root(i), root(j)
            parent[max(x, y)] = min(x, y)
    out = [(i, len(s), None if i is None else root(i) if s else i) for i, s in sets]
    return sorted([(*r, None if r[0] is None else r[0] == r[2]) for r in out], key=repr)


def _found(spark, rows, **kwargs):
    docs = spark.createDataFrame([(i, t, 0, "k") for i, t in rows], "doc_id long, text string, n int, key string")
    return sorted((tuple(r) for r in minhash.near_duplicates(docs, **kwargs).collect()), key=repr)


def test_minhash_on_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in minhash.query(spark, SF).collect()), key=repr)
    assert got == _components(rows)


def _edited(words, changes, seed):
    out = list(words)
    for k in np.random.default_rng(seed).choice(len(out), changes, replace=False):
        out[k] = f"e{seed}x{k}"
    return " ".join(out)


@pytest.mark.parametrize("block", [4096, 8])
def test_minhash_of_families_and_odd_rows(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK_SETS", block)                # small blocks cut the families
    rows = [(1, None), (2, ""), (3, "A b"), (4, "a  B\n"), (5, "a"), (6, "a b c"), (7, "A B C"), (8, " \t"), (None, "a b c"), (None, None)]
    for base, size in ((100, 40), (200, 300), (300, 560), (400, 700), (500, 8)):          # both kinds of minima and sizes between
        words = [f"w{base}_{i}" for i in range(size)]
        rows += [(base + k, _edited(words, max(1, size * (k % 7) // 90), base + k)) for k in range(40)]
        rows += [(base + 50 + k, " ".join(words[:size - size * k // 60])) for k in range(12)]
        rows += [(base + 70 + k, " ".join(words)) for k in range(12)]
    rows += [(900, rows[30][1]), (900, "something else entirely with seven words"), (901, "something else entirely with seven words"), (900, rows[30][1])]
    assert _found(spark, rows) == _components(rows)


def test_minhash_with_another_rule_and_empty_table(spark):
    words = [f"w{i}" for i in range(150)]
    rows = [(k, _edited(words, k % 9, k)) for k in range(60)]
    assert _found(spark, rows, rule=Rule(5, 80, 100)) == _components(rows, 5, 80)
    assert _found(spark, []) == []


def test_minhash_broadcasts_no_stored_table(spark, monkeypatch):
    plans, stored = [], minhash.stored
    joins = lambda df: [x[re.search("[A-Z]", x).start():] for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in x]

    def planned(df, name):
        plans.append((name, joins(df)))
        return stored(df, name)

    monkeypatch.setattr(minhash, "stored", planned)
    monkeypatch.setattr(components, "stored", planned)
    monkeypatch.setattr(minhash, "BROADCAST_IDS", 10)
    words = [f"w{i}" for i in range(150)]
    docs = spark.createDataFrame([(k, _edited(words, k % 9, k)) for k in range(60)], "doc_id long, text string")
    out = minhash.near_duplicates(docs)
    assert len(out.collect()) == 60
    links = [found for name, found in plans if name == "links"]
    ids = [x for found in links for x in found if "LeftSemi" in x]                   # more than may be broadcast
    star = joins(components._star(stored(docs.selectExpr("doc_id u", "doc_id - 1 v"), "pairs")))
    for found in (links[0], dict(plans)["minhash-members"], ids, star, joins(out)):
        assert found and all(x.startswith("SortMergeJoin") for x in found), found


def test_estimate_is_corrected_for_chance():
    rng = np.random.default_rng(3)
    for jaccard in (0.2, 0.5, 0.85):
        near = []
        for _ in range(60):
            u = rng.integers(0, 1 << 64, 3000, dtype=np.uint64)
            shared, rest = u[:int(3000 * jaccard)], u[int(3000 * jaccard):]
            a, b = (np.unique(np.concatenate([shared, rest[k::2]])) for k in (0, 1))
            for minima in (minhash.permuted_minima([a, b]), np.stack([minhash.ranged_minima(s) for s in (a, b)])):
                packed = np.frombuffer(minhash.packed_codes(minima).tobytes(), np.uint64).reshape(2, -1)
                near.append(minhash.similarity(minhash.equal_codes(packed[:1], packed[1])[0]))
        assert abs(np.mean(near) - jaccard) < 0.02
    assert 0.6 < minhash.similarity(minhash.least_equal()) < 0.75


def test_no_band_is_shared_by_unrelated_sets():
    texts = [" ".join(f"{k}_{i}" for i in range(n)) for k, n in enumerate(range(3, 1500, 40))]
    keys = [set(k.tolist()) for k in minhash.sketch(shingle_sets(texts, 3))[0]]
    assert all(not a & b for a, b in itertools.combinations(keys, 2))
    assert [len(k) for k in keys[:2]] == [0, minhash.BANDS]


# -- hard negatives ------------------------------------------------------------------------------

def _hard(rows):
    """By all pairs, in Python integers."""
    kept = []
    for v, e, label in rows:
        if label is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        q = [math.floor(256 * float(np.float32(x))) for x in e]
        if sum(x * x for x in q) < 1 << 56:
            kept.append((v, (label + 1) % 10 if v is not None and v % 7 == 0 else label, q))
    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for i, (v, label, q) in enumerate(kept):
        if v is None or v % 100:
            continue
        others = [(sum(map(int.__mul__, q, o[2])), o[0], o[1]) for j, o in enumerate(kept) if j != i and len(o[2]) == len(q)]
        positives = sorted((x for x in others if x[2] == label), key=order)[:5]
        for p in positives:
            negatives = sorted((x for x in others if x[2] != label and 30 * p[0] <= 100 * x[0] <= 90 * p[0]), key=order)[:10]
            out += [(v, p[1], k + 1, n[1], p[0], n[0]) for k, n in enumerate(negatives)]
    return sorted(out, key=repr)


def _negatives(spark, rows):
    table = spark.createDataFrame([(v, e, label, "x", 3) for v, e, label in rows], "vec_id long, embedding array<float>, label int, mark string, block int")
    return sorted((tuple(r) for r in hard_negatives.hard_negatives(table).collect()), key=repr)


def test_hard_negatives_match_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    found = hard_negatives.query(spark, SF)
    want = con.sql(hard_negatives.SQL)
    assert found.columns == want.columns and sorted(map(tuple, found.collect())) == sorted(want.fetchall())


@pytest.mark.parametrize("block", [1 << 15, 16])
def test_hard_negatives_of_odd_rows(spark, monkeypatch, block):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(0.2, 0.6, 6)], int(rng.integers(0, 4))) for i in range(0, 700, 3)]
    rows += [(1000 + i, [0.5] * 6, i % 3) for i in range(60)]                           # ties
    rows += [(300, [0.4] * 6, 1)] * 7 + [(1500, [0.9] * 6, 2)] * 2 + [(None, [0.3] * 6, 1)] * 3 + [(None, [0.31] * 6, 2)]
    rows += [(100, None, 1), (200, [1.0, None], 1), (400, [float("nan")] * 6, 1), (500, [float("inf")] * 6, 2), (600, [0.1] * 6, None), (2000, [], 1), (2001, [], 1), (2002, [], 2)]
    rows += [(2100, [0.0] * 6, 1), (2200, [1e30] * 6, 1), (2300, [1e5, 2e5, 1e5, 1.5, -3.0, 1e4], 1), (2301, [1e5, 2e5, 1e4, 1.5, -3.0, 1e4], 1), (2302, [0.9e5, 1e5, 1e4, 1.5, -3.0, 1e4], 2)]
    rows += [(2400, [0.1, 0.2], 1), (2401, [0.1, 0.25], 1), (2402, [0.05, 0.15], 3)]
    assert _negatives(spark, rows) == _hard(rows)


def test_hard_negatives_of_empty_tables(spark):
    assert _negatives(spark, []) == [] and _negatives(spark, [(100, [1.0], 1)]) == [] and _negatives(spark, [(1, None, None)]) == []


def test_bounds_hold_and_exclude():
    rng = np.random.default_rng(8)
    centres = rng.normal(0, 1, (6, 32))
    x = np.floor(256 * (centres[rng.integers(0, 6, 400)] + rng.normal(0, 0.05, (400, 32))))
    norms, found = hard_negatives.angles(x, hard_negatives.directions(x, 32))
    low, high = hard_negatives.score_bounds(found, norms, found, norms)
    assert (low <= x @ x.T).all() and (high >= x @ x.T).all()
    assert (high < 0.9 * (x * x).sum(1)[:, None]).mean() > 0.4                        # clustered vectors are told apart unscored


# -- collocations --------------------------------------------------------------------------------

def _mined(rows, least, top=2000):
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, 6):
                for i in range(len(w) - size + 1):
                    counts[lang][tuple(w[i:i + size])] += 1
    out = []
    for lang, found in counts.items():
        candidates = {p: a for p, a in found.items() if a >= least and len(p) > 1}
        within = Counter()
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    within[p[i:i + size]] = max(within[p[i:i + size]], a)
        scored = []
        for p, a in candidates.items():
            if 100 * within[p] >= 100 * a:
                continue
            score, k = min((1000 * a * n[lang] // (found[p[:k]] * found[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        out += [(lang, r + 1, p.decode(), -a, x, y, n[lang], -s) for r, (s, a, p, x, y) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def _phrases(spark, rows, **kwargs):
    docs = spark.createDataFrame([(*r, "w", 1) for r in rows], "lang string, text string, phrase string, f int")
    return sorted(tuple(r) for r in collocations.collocations(docs, **kwargs).collect())


def test_collocations_match_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    found = collocations.query(spark, SF)
    want = con.sql(collocations.SQL)
    assert found.columns == want.columns and sorted(map(tuple, found.collect())) == sorted(want.fetchall())


@pytest.mark.parametrize("hot", [4_000_000, 30])
def test_collocations_of_documents_and_odd_rows(spark, monkeypatch, hot):
    monkeypatch.setattr(collocations, "HOT", hot)                    # routed by three words
    rows = [(r.lang, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(None, "One two three. One TWO three; é è\té è,one two")] * 9 + [("und", "one two"), ("", "a b a b a b a b a b a b a b"), (None, None), ("en", ""), (None, "x\x00y z q x\x00y z q " * 8)]
    rows += [("zz", "same same same same same same same same"), ("en", "p q r s t u v w " * 40)]
    assert _phrases(spark, rows, least=8) == _mined(rows, 8)
    assert _phrases(spark, rows, least=8, top=5) == _mined(rows, 8, 5)


def test_collocations_of_long_products_and_empty_tables(spark):
    assert _phrases(spark, []) == [] and _phrases(spark, [("en", "a b")]) == []
    big = "m n. " * 60_000 + "o p " * 100
    assert _phrases(spark, [("en", big)] * 3) == _mined([("en", big)] * 3, 100)


def test_suffixes_end_where_triples_are_rare(spark, monkeypatch):
    shipped, count = [], collocations.phrases
    monkeypatch.setattr(collocations, "phrases", lambda routed, least: shipped.append(routed.collect()) or count(routed, least))
    words = np.random.default_rng(5).integers(0, 12, 12_000)             # 144 pairs are frequent, no triple is by chance
    rows = [("en", " ".join(f"w{k}" for k in part)) for part in words.reshape(60, 200)] + [("en", "one two three four five six")] * 40
    assert _phrases(spark, rows, least=30) == _mined(rows, 30)
    assert len(shipped[0]) == 144 + 5                                    # not a row for nearly every place
    assert sum(r.f for r in shipped[0]) == 60 * 199 + 40 * 5


def test_suffixes_that_end_after_a_pair_are_not_shipped(spark, monkeypatch):
    kept, store = {}, collocations.stored
    monkeypatch.setattr(collocations, "stored", lambda df, name: kept.setdefault(name, store(df, name)))
    words = np.random.default_rng(7).integers(0, 9, 9_000)               # 81 pairs are frequent, in the rows of every task
    rows = [("en", " ".join(f"w{k}" for k in part)) for part in words.reshape(60, 150)] + [("en", "a b. " * 30 + "a b c. " * 40)] * 2 + [("de", "a b. b a b")] * 35
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(6)
    assert sorted(tuple(r) for r in collocations.collocations(docs, least=33).collect()) == _mined(rows, 33)
    assert [r.f for r in kept["collocation-suffixes"].collect() if not r.w3] == []
    assert sorted(r.f for r in kept["collocation-suffixes"].collect()) == [35, 80]        # b a b, a b c
    assert kept["collocation-pairs"].count() == 81 + 2 + 2


@pytest.mark.parametrize("least", [1, 255, 300])
def test_counts_of_triples_stop_above_the_least(spark, least):
    rows = [("en", "a b c d. " * 100 + "b c d")] * 3
    assert _phrases(spark, rows, least=least) == _mined(rows, least)


def test_multikey_quicksort_counts_every_prefix():
    rng = np.random.default_rng(2)
    rows = rng.integers(1, 4, (3000, 5)).astype(np.uint64)
    rows[np.arange(5) >= rng.integers(2, 6, 3000)[:, None]] = 0
    weight = rng.integers(1, 9, 3000)
    want = Counter()
    for r, f in zip(rows.tolist(), weight.tolist(), strict=True):
        for k in range(2, 6):
            if 0 not in r[:k]:
                want[tuple(r[:k])] += f
    got = collocations.multikey_quicksort(rows, weight, 60)
    assert len(got) == len(dict(got)) and dict(got) == {p: f for p, f in want.items() if f >= 60}
