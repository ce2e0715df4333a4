"""Joins over the corpus against DuckDB SQL or brute force, on the tables and on odd rows."""

import itertools
import os

import duckdb
import pandas as pd
import pytest

from tierstore.llm import components, decontaminate, licenses, line_dedup, ngram_join
from tierstore.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.01"
MIT = next(t.text for t in licenses.NOTICES if t.label == "mit")
ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"

DOCUMENTS = [
    (0, None), (1, ""), (2, "Released under the MIT license, CC BY-NC; cc by nc cc by nc"), (2, "another text under the same id"),
    (3, "x " * 62 + "under the MIT-license " + "y " * 70 + "apache license (Version 2.0) under the mit license"),
    (4, "word " * 500 + MIT.upper() + " tail" * 90), (5, MIT.replace("granted", "given").replace("charge", "cost")), (5, MIT.replace("granted", "given").replace("charge", "cost")),
    (6, ITEM), (7, "before " + ITEM.upper() + " " + ITEM + " after"), (8, ITEM.replace("zeta", "other")), (8, "tiny test"), (9, "a tiny, test: tiny test!"),
    (10, "l1\nl2\nl3\nl4\nl5"), (11, "l0\nl2\nl3\nl4\nend"), (12, "a\na\na\na\na"), (13, "\n\n\n\n\n"), (14, "\n\n\n\n"), (15, "l1\nl2\nl3\nl4\nl5"), (15, "l1\nl2\nl3\nl4\nl5"),
    (16, "l1\nl2"), (17, "under the mit"), (18, "license"), (None, "l9\nl8\nl7"), (19, "l9\nl8\nl7\nl6"), (20, "un\x00der the mit license " + ITEM + " é日"),
]
BENCHMARK = [(1, ITEM), (2, ITEM.upper() + " more words"), (3, "tiny test"), (4, None), (5, " .,"), (6, "tiny test"), (7, "absent words")]


@pytest.fixture(scope="module")
def odd(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd"))
    pd.DataFrame(DOCUMENTS, columns=["doc_id", "text"]).astype({"doc_id": "Int64"}).assign(key=1, n=2, words="w", id=3).to_parquet(f"{folder}/documents.parquet")
    pd.DataFrame(BENCHMARK, columns=["item_id", "text"]).assign(n=1, window=2).to_parquet(f"{folder}/benchmark.parquet")
    return folder


def both(spark, folder, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        if os.path.exists(f"{folder}/{table}.parquet"):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    want = con.sql(SQL[name])
    got = QUERIES[name](spark, folder)
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = lambda found: sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in found), key=repr)
    return rows(map(tuple, got.select(columns).collect())), rows(want.select(*columns).fetchall()), columns


@pytest.mark.parametrize("name", sorted(SQL))
def test_tables_match_sql(spark, name):
    got, want, _ = both(spark, SF, name)
    assert got == want


@pytest.mark.parametrize("name", ["op1_license_scan", "op2_line_dedup", "op4_decontaminate"])
def test_odd_rows_match_sql(spark, odd, name):
    got, want, _ = both(spark, odd, name)
    assert got == want


def test_license_labels_of_odd_rows(spark, odd):
    rows = [(r.doc_id, r.n_base, r.first_word, r.labels, r.base_labels) for r in licenses.query(spark, odd).collect()]
    assert (2, 4, 1, "cc-by-nc,mit", "cc-by-nc,mit") in rows and (4, 0, None, "mit", "") in rows
    assert rows.count((5, 0, None, "mit", "")) == 2 and (17, 0, None, "", "") in rows
    assert next(r for r in rows if r[0] == 3)[1:4] == (3, 62, "apache-2,mit")


def test_line_dedup_of_odd_rows(spark, odd):
    rows = {(r.doc_id, r.n_lines, r.n_removed, r.text) for r in line_dedup.query(spark, odd).collect()}
    assert {(0, 0, 0, None), (1, 1, 0, ""), (10, 5, 0, "l1\nl2\nl3\nl4\nl5"), (11, 5, 3, "l0\nend"), (12, 5, 4, "a"),
            (13, 6, 0, "\n\n\n\n\n"), (15, 5, 5, ""), (16, 2, 0, "l1\nl2"), (None, 3, 0, "l9\nl8\nl7"), (19, 4, 3, "l6")} <= rows
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    assert sorted(line_dedup.deduplicate(docs).columns) == sorted([*docs.columns, "n_lines", "n_removed"])
    assert line_dedup.deduplicate(docs.limit(0)).count() == 0


def test_line_dedup_of_repeated_rows_matches_sql(spark, tmp_path):
    """Of rows alike in doc_id and text the first counts as any document, the others are later copies."""
    rows = [(1, "a\nb\nc\nd")] * 2 + [(None, "p\nq\nr\n\n\n\n")] * 3 + [(2, "a\nb\nc\nx")] * 3 + [(3, "s\nt")] * 2 + [(4, None)] * 2 + [(5, "\n\n\n")] * 2 + [(6, "one\ntwo\n three")]
    pd.DataFrame(rows, columns=["doc_id", "text"]).astype({"doc_id": "Int64"}).to_parquet(f"{tmp_path}/documents.parquet")
    got, want, columns = both(spark, str(tmp_path), "op2_line_dedup")
    assert got == want
    removed = sorted((r[columns.index("doc_id")] or 0, r[columns.index("n_removed")]) for r in got)
    assert removed == [(0, 0), (0, 5), (0, 5), (1, 0), (1, 4), (2, 3), (2, 4), (2, 4), (3, 0), (3, 0), (4, 0), (4, 0), (5, 0), (5, 0), (6, 0)]


def test_line_dedup_with_a_hot_window(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT_SHARE", 4)           # windows of a quarter of all count as hot
    docs = spark.createDataFrame([(i, "h1\nh2\nh3\n" + "\n".join(f"{i // 2} {j}" for j in range(2 + i % 3))) for i in range(40)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.deduplicate(docs).collect()}
    seen, want = set(), {}
    for d in sorted(docs.collect()):
        lines, gone = d.text.split("\n"), set()
        for i in range(len(lines) - 2):
            w = tuple(lines[i:i + 3])
            gone |= set(range(i, i + 3)) if w in seen else set()
            seen.add(w)
        want[d.doc_id] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    assert got == want


def test_remove_contaminated_documents_or_spans(spark, odd):
    docs, bench = (spark.read.parquet(f"{odd}/{t}.parquet") for t in ("documents", "benchmark"))
    left = decontaminate.remove(docs, bench)
    assert left.columns == docs.columns
    hit = [r.doc_id for r in decontaminate.contamination(docs, bench).collect() if r.contaminated]
    assert sorted(hit) == [6, 7, 8, 9, 20]
    assert left.count() == len(DOCUMENTS) - len(hit) and left.filter("doc_id = 8").first().text == ITEM.replace("zeta", "other")
    spans = {r.text for r in decontaminate.remove(docs, bench, spans=True).filter("doc_id IN (6, 7, 9, 20)").collect()}
    assert spans == {"", "before  after", "a !", "un\x00der the mit license  é日"}
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0
    assert not decontaminate.contamination(docs, bench.limit(0)).filter("contaminated").count()


def test_shuffled_windows_give_the_same(spark, odd, monkeypatch):
    want, _, _ = both(spark, odd, "op4_decontaminate")
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    assert both(spark, odd, "op4_decontaminate")[0] == want
    docs, bench = (spark.read.parquet(f"{odd}/{t}.parquet") for t in ("documents", "benchmark"))
    assert decontaminate.remove(docs, bench).count() == len(DOCUMENTS) - 5


# -- n-gram join -------------------------------------------------------------------------------

def _sets(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return frozenset(tuple(w[i:i + 3]) for i in range(len(w) - 2)) if len(w) > 2 else frozenset([tuple(w)] if w else [])


def _brute(rows):
    """Components by comparing all pairs."""
    sets = [(i, _sets(t)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, a), (j, b) in itertools.combinations(sets, 2):
        if i is None or j is None or not a or not b or min(len(a), len(b)) * 100 < 90 * max(len(a), len(b)):
            continue
        if i == j or 100 * len(a & b) >= 90 * len(a | b):
            x, y = root(i), root(j)
            parent[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else i if not s else root(i)) for i, s in sets), key=repr)


def _near(rows, spark, **kwargs):
    docs = spark.createDataFrame([(i, t, 0, "k") for i, t in rows], "doc_id long, text string, n int, key string")
    return sorted((tuple(r) for r in ngram_join.near_components(docs).collect()), key=repr)


def _family(base, ids, step, words):
    """Texts that each change one more word: neighbours link, ends may not."""
    out, current = [], list(words)
    for k, i in enumerate(ids):
        out.append((i, " ".join(current)))
        current[(k * step + 3) % len(current)] = f"new{base}{k}"
    return out


def test_near_components_on_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in ngram_join.query(spark, SF).collect()), key=repr)
    assert got == _brute(rows)


@pytest.mark.parametrize("part", [4096, 8])
def test_near_components_of_families_and_odd_rows(spark, monkeypatch, part):
    monkeypatch.setattr(ngram_join, "PART", part)             # small parts are cut into blocks
    words = [f"w{i}" for i in range(60)]
    rows = _family("a", range(100, 160), 7, words) + _family("b", range(40, 60), 11, [f"v{i}" for i in range(200)])
    rows += [(1, None), (2, ""), (3, "A b"), (4, "a  B\n"), (5, "a"), (6, "a b c"), (7, "A B C"), (8, " \t"), (None, "a b c"), (None, None), (9, "É b c"), (10, "é b c")]
    rows += [(11, " ".join(words[:11])), (12, " ".join(words[:12])), (13, " ".join(words[:10]))]
    rows += [(14, "same id " + " ".join(words[:20])), (14, "other text of it entirely"), (15, "other text of it entirely"), (16, "same id " + " ".join(words[:20]))]
    rows += [(200 + i, " ".join(words)) for i in range(30)]
    assert _near(rows, spark) == _brute(rows)


@pytest.mark.parametrize("hot", [False, True])
def test_large_families_meet_in_blocks(spark, monkeypatch, hot):
    """Families of many blocks with few pivots, copies of a base that do not link with each other, and
    sets around the size where coordinates change."""
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 4)
    monkeypatch.setattr(ngram_join, "PIVOTS", 2)
    if hot:
        for name, value in (("HOT_SAMPLE", 1), ("HOT_COUNT", 6), ("SALTS", 3)):
            monkeypatch.setattr(ngram_join, name, value)
    rows = []
    for base, size in ((0, 90), (1000, 380), (2000, 900)):
        words = [f"w{base}x{k}" for k in range(size)]
        rows.append((base, " ".join(words)))
        for k in range(30):
            own = list(words)
            for c in range(max(1, size // 95)):              # about nine tenths of the base's set are left
                own[(k * 37 + c * 61) % (size - 6) + 3] = f"e{base}x{k}x{c}"
            rows.append((base + 1 + k, " ".join(own)))
        rows += [(base + 100 + k, " ".join(words[:size - k * size // 60])) for k in range(1, 12)]
    assert _near(rows, spark) == _brute(rows)


def test_groups_of_points_equal_plain_comparison():
    """Points connected by pairs that pass the bound, by comparing all pairs."""
    import numpy as np
    rule, draw = ngram_join.RULE, np.random.default_rng(3)
    for size in (1, 5, 33, 300):
        n = draw.integers(20, 60, size)
        points = np.stack([np.bincount(draw.integers(0, 4, k), minlength=8) for k in n]).astype(np.uint8)
        points[::7] = points[0]
        part = np.sort(draw.integers(0, 3, size))
        want = list(range(size))
        for i, j in itertools.combinations(range(size), 2):
            fits = min(n[i], n[j]) * 100 >= 90 * max(n[i], n[j]) and np.minimum(points[i], points[j]).sum() >= ngram_join.least_overlap(n[i], n[j], rule)
            if part[i] == part[j] and fits and want[i] != want[j]:
                low, high = sorted((want[i], want[j]))
                want = [low if w == high else w for w in want]
        got = ngram_join.part_groups(part, n, points, rule)
        assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_representatives_keep_one_of_each_group(spark):
    rows = [(3, "a b c d"), (1, "a b c d"), (2, None), (None, "a b c d"), (5, "")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, component_id string")
    out = ngram_join.representatives(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id for r in out.collect()), key=repr) == [1, 2, 5, None]
    assert ngram_join.representatives(docs.limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, j) for j in range(101, 130)] + [(130, 129), (7, 7), (300, 301), (301, 300)]
    got = dict(map(tuple, components.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 131)}, 300: 300, 301: 300}


def test_sample_for_common_ngrams_is_bounded_without_ids(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "SAMPLE_DOCS", 200)
    monkeypatch.setattr(ngram_join, "COMMON_DOCS", 1)
    docs = spark.createDataFrame([(None if i % 3 == 0 else i, f"one two three{i}") for i in range(6000)], "doc_id long, text string")
    assert 120 < len(ngram_join.common_ngrams(docs)) < 300           # one n-gram a text


# -- pipeline ----------------------------------------------------------------------------------

def test_pipeline_stages_take_effect(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    before, names = docs, [n for n, _ in corpus_pipeline.STAGES]
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.stored(stage(spark, before, SF), name)
        if name == "language":
            assert sorted(r.doc_id for r in after.collect()) == sorted(r.doc_id for r in before.collect() if any(c.isalpha() for c in r.text or ""))
        elif name == "near-duplicates":
            assert sorted(r.doc_id for r in after.collect()) == _stage_kept([(r.doc_id, r.text) for r in before.collect()])
        elif name == "benchmark":
            hit = {r.doc_id for r in decontaminate.contamination(before, bench).filter("contaminated").collect()}
            assert hit and {r.doc_id for r in before.collect()} - hit == {r.doc_id for r in after.collect()}
        elif name == "lines":
            got = {r.doc_id: r for r in after.collect()}
            for r in line_dedup.deduplicate(before).collect():
                assert r.doc_id not in got and not r.text.strip() or got[r.doc_id].text == r.text and got[r.doc_id].n_chars == len(r.text)
        if name != names[-1]:
            assert after.columns == docs.columns
        before = after
    assert all(r.round_trip and r.ids for r in before.collect())
    assert corpus_pipeline.run(spark, SF).count() == before.count()


def _stage_sets(text):
    """Sets of the pipeline's near-duplicates stage: five words."""
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    k = min(5, len(w))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else frozenset()


def _stage_kept(rows):
    """Smallest ids of the components at 5 words / 0.8, by all pairs; doc_ids are distinct."""
    sets = {i: _stage_sets(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(sorted(sets), 2):
        a, b = sets[i], sets[j]
        if a and b and 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and 5 * len(a & b) >= 4 * len(a | b):
            x, y = root(i), root(j)
            parent[max(x, y)] = min(x, y)
    return sorted(i for i in sets if root(i) == i)


def test_near_duplicate_stage_at_five_words(spark):
    import corpus_pipeline
    words = [f"w{i}" for i in range(120)]
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    top = max(i for i, _ in rows)
    rows += _family("a", range(top + 1, top + 40), 17, words) + _family("b", range(top + 50, top + 60), 31, [f"v{i}" for i in range(60)])
    rows += [(top + 70 + n, " ".join(f"u{i}" for i in range(n))) for n in range(1, 16)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, None).collect())
    assert got == _stage_kept(rows)
    assert len(got) < ngram_join.representatives(docs).count()          # op5's rule leaves more


@pytest.mark.parametrize("labelled", [None, "held out"])
def test_language_stage_with_nothing_to_learn_from(spark, labelled):
    import corpus_pipeline
    from tierstore.llm import language_id
    from pyspark.sql import functions as F
    rows = [(i, t) for i, t in enumerate(["the cat", None, "", "12 !", "日本", "le chat 3", "the dog"] * 3)]
    docs = spark.createDataFrame([(*row, 7) for row in rows], "doc_id long, text string, has_letters int")
    lang = F.lit(None) if labelled is None else F.when(language_id.held_out(F.col("doc_id")), F.lit("en"))
    docs = docs.withColumn("lang", lang.cast("string"))
    out = corpus_pipeline.identify_language(spark, docs, None)
    want = [r for r in docs.collect() if any(c.isalpha() for c in r.text or "")]
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [r.doc_id for r in want]
    assert {r.doc_id: r.lang for r in out.collect()} == {r.doc_id: r.lang for r in want}


def test_near_duplicate_stage_with_repeated_rows_and_null_ids(spark):
    import corpus_pipeline
    one, two, three = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    near = two.replace("b39", "end")
    rows = [(2, one), (2, one), (1, three), (2, one), (None, two), (None, near), (None, two), (None, three), (None, "lone words"), (None, "lone  words"), (None, "!"), (None, None), (None, " "), (5, ""), (5, "")]
    docs = spark.createDataFrame([(i, t, k, {"k": k}) for k, (i, t) in enumerate(rows)], "doc_id int, text string, place int, key map<string,int>")
    out = corpus_pipeline.drop_near_duplicates(spark, docs, None)
    assert out.schema["doc_id"].dataType == docs.schema["doc_id"].dataType and out.columns == docs.columns
    got = sorted(((r.doc_id, r.text and r.text.split()) for r in out.collect()), key=repr)
    some = [x for x in got if x[1] in (two.split(), near.split())]
    assert len(some) == 1 and some[0][0] is None
    got.remove(some[0])
    assert got == sorted([(2, one.split()), (1, three.split()), (None, ["lone", "words"]), (None, ["!"]), (None, None), (None, []), (5, "")], key=repr)
