"""Language, fingerprint, quality and HTML operators: brute force, held-out accuracy, edge rows."""

import base64
import hashlib
import math
import zlib

import numpy as np
import pytest

from tierstore.llm import fingerprints as fp
from tierstore.llm import html_text, language_id, quality

SF = "/root/testdata/sf0.01"


# -- language ---------------------------------------------------------------------------------

def test_language_held_out_accuracy(spark):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = language_id.query(spark, SF).collect()
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def _brute_bits(counts, texts, data):
    """Code length of one language, byte by byte, from its counts."""
    alphabet = sorted({b for table in counts.values() for b in table})

    def p(context, byte):
        table = counts.get(context, {})
        shorter = (lambda b: 1 / (len(alphabet) + 1)) if not context else (lambda b: p(context[1:], b))
        if sum(table.values()) < language_id.MIN_COUNT:
            return shorter(byte)
        rest = 1 - sum(shorter(b) for b in table)
        room = len(table) if rest > 1e-12 else 0
        total = sum(table.values()) + room
        return table[byte] / total if byte in table else room * shorter(byte) / rest / total

    padded = b" " * language_id.DEPTH + data
    return -sum(math.log2(max(p(padded[max(0, i - language_id.DEPTH):i], padded[i]), 1e-300)) for i in range(language_id.DEPTH, len(padded)))


def test_code_lengths_equal_brute_force(spark):
    train = [("banana bandana cabana", "x"), ("Bab, 12 ab ac", "x")] * 3
    model = language_id.Model.fit(spark.createDataFrame(train, "text string, lang string"))
    fold = lambda t: bytes(language_id._fold[np.frombuffer(t.encode(), np.uint8)])
    squeeze = lambda t: b" ".join(w for w in fold(t).split(b" ") if w) + (b" " if fold(t).endswith(b" ") and fold(t).strip() else b"")
    counts = {}
    for text, _ in train:
        padded = b" " * language_id.DEPTH + squeeze(text)
        for i in range(language_id.DEPTH, len(padded)):
            for k in range(language_id.DEPTH + 1):
                counts.setdefault(padded[i - k:i], {}).setdefault(padded[i], 0)
                counts[padded[i - k:i]][padded[i]] += 1
    import pyarrow as pa

    from tierstore.llm.common import text_buffer
    probe = ["banana", "cab ab", "zzz 9é", "a", ""]
    bits = model.code_lengths(*text_buffer(pa.array(probe)))[:, 0]
    assert bits == pytest.approx([_brute_bits(counts, None, squeeze(t)) for t in probe], rel=1e-5)


def test_language_edges(spark):
    docs = spark.createDataFrame([(0, "the cat and the dog", "en", 1), (1, "el perro y la casa", "es", 2), (2, None, "en", 3), (3, "", None, 4),
                                  (4, "123 !!", None, 5), (None, "the dog", "en", 6), (5, "日本", None, 7)], "doc_id long, text string, lang string, score int")
    out = {r.doc_id: r for r in language_id.identify(docs).collect()}
    assert [out[k].lang_pred for k in (2, 3, 4)] == ["und"] * 3 and out[2].score == 0.0
    assert out[0].lang_pred == "en" and out[5].lang_pred in ("en", "es")
    assert language_id.identify(docs.limit(0)).count() == 0
    nothing = language_id.identify(docs.withColumn("lang", docs.text.substr(0, 0).cast("string")).filter("doc_id = 2")).collect()
    assert [r.lang_pred for r in nothing] == ["und"]


# -- fingerprints ------------------------------------------------------------------------------

def _brute_ends(data: bytes):
    gear, ends, start, n = fp.GEAR.astype(object), [], 0, len(data)

    def h(i):
        return sum(int(gear[data[i - k]]) << k for k in range(min(fp.WINDOW, i + 1))) & 0xFFFFFFFF

    while start < n:
        end = min(start + fp.MAX, n)
        for i in range(start + fp.MIN - 1, end):
            if h(i) & int(fp.STRICT if i < min(start + fp.NORMAL, n) else fp.LOOSE) == 0:
                end = i + 1
                break
        ends.append(end)
        start = end
    return ends


def test_chunk_ends_equal_brute_force():
    rng = np.random.default_rng(5)
    for n in (0, 1, 15, 16, 17, 47, 49, 160, 161, 3000):
        data = rng.integers(97, 110, n).astype(np.uint8)
        starts, ends = fp.chunk_ends(data, np.array([0, n]))
        assert ends.tolist() == _brute_ends(data.tobytes())
        assert starts.tolist() == [0, *ends.tolist()[:-1]][:len(ends)]
    two = fp.fingerprints([b"abc" * 99, b"", b"xy" * 77, b"abc" * 99])
    assert two[0] == two[3] == fp.fingerprints([b"abc" * 99])[0] and two[1] == {}


def test_an_inserted_passage_moves_few_chunks():
    rng = np.random.default_rng(6)
    text = rng.integers(97, 123, 20_000).astype(np.uint8).tobytes()
    a, b = fp.fingerprints([text, text[:9000] + b"inserted words" + text[9000:]])
    assert fp.containment(a, b) > 0.97


def test_likeness_to_next_equals_brute_force(spark):
    rows = [(5, "tall " * 90), (1, None), (9, "é日🙂" * 40), (3, "one two three " * 30), (4, "one two three " * 30), (9, "é日🙂" * 40), (None, "first"), (12, "")]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, place int").repartition(3)
    got = sorted(((r.doc_id is not None, r.doc_id or 0), tuple(r)) for r in fp.likeness_to_next(docs).collect())
    ordered = sorted(((i is not None, i or 0), t or "") for i, t in rows)
    want = []
    for k, (key, text) in enumerate(ordered):
        after = ordered[(k + 1) % len(ordered)][1]
        new = text[:len(text) - len(text) // 2] + after[:len(text) // 2]
        own, other, nxt = fp.fingerprints([x.encode() for x in (text, new, after)])
        want.append((key, (key[1] if key[0] else None, len(text), hashlib.sha256(new.encode()).hexdigest(), fp.to_string(own), fp.to_string(other), fp.containment(own, other), fp.containment(own, nxt))))
    assert got == sorted(want)
    assert fp.likeness_to_next(docs.limit(0)).count() == 0
    assert fp.from_string(got[-2][1][3]) == fp.fingerprints([("é日🙂" * 40).encode()])[0]
    base64.b64decode(got[0][1][3])


def test_fingerprint_query_covers_all_documents(spark):
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = {r.doc_id: r for r in fp.query(spark, SF).collect()}
    assert len(got) == len(docs)
    for k, (doc_id, text) in enumerate(docs):
        after = docs[(k + 1) % len(docs)][1]
        assert got[doc_id].edited_sha256 == hashlib.sha256(fp.edited(text, after).encode()).hexdigest()
    long = [r for r in got.values() if r.n_chars > 2000]
    assert abs(sum(r.near_edited for r in long) / len(long) - 0.5) < 0.06


# -- quality -----------------------------------------------------------------------------------

def test_quality_held_out(spark):
    from pyspark.sql import functions as F
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    ratings = quality.graded(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"))
    model = quality.train(docs, ratings.filter(F.col("doc_id") % 3 != 0))
    rows = quality.score(docs, model).join(ratings, "doc_id").filter(F.col("doc_id") % 3 == 0).collect()
    toxic = [r for r in rows if r.grade == 0]
    good = [r for r in rows if r.grade == 2]
    assert len(toxic) > 50 and sum(not r.keep for r in toxic) >= 0.97 * len(toxic)
    assert sum(r.keep for r in good) >= 0.97 * len(good)
    assert all(0 <= r.tail_probability <= r.expected_grade <= 2 for r in rows)
    assert model.thresholds[0] < model.thresholds[1]


def _plain_objective(x, rows, grades, ridge):
    """Penalised mean log likelihood of the cumulative-link model, row after row."""
    n = len(x) - quality.GRADES + 1
    theta = [x[n]]
    for gap in x[n + 1:]:
        theta.append(theta[-1] + math.exp(gap))
    total = 0.0
    for row, grade in zip(rows, grades):
        score = sum(x[k] for k in row)
        above = lambda k: 1.0 if k < 0 else 0.0 if k >= len(theta) else 1 / (1 + math.exp(theta[k] - score))
        total += math.log(above(grade - 1) - above(grade))
    return total / len(rows) - ridge / 200 * sum(w * w for w in x[:n])


def test_quality_likelihood_and_gradient_equal_brute_force():
    rnd = np.random.default_rng(5)
    n, rows = 7, [sorted(rnd.choice(7, rnd.integers(0, 6), replace=False).tolist()) for _ in range(40)]
    grades = rnd.integers(0, quality.GRADES, 40)
    flat, at = np.array([k for r in rows for k in r]), np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    for x in (np.zeros(n + quality.GRADES - 1), rnd.normal(size=n + quality.GRADES - 1)):
        value, grad = quality.Model.objective(x, n, flat, at, grades, 0.5)
        assert value == pytest.approx(_plain_objective(x, rows, grades, 0.5))
        for k in range(len(x)):
            step = np.eye(len(x))[k] * 1e-5
            slope = (_plain_objective(x + step, rows, grades, 0.5) - _plain_objective(x - step, rows, grades, 0.5)) / 2e-5
            assert grad[k] == pytest.approx(slope, rel=1e-4, abs=1e-7)


def test_quality_scores_equal_brute_force():
    """Expected grade, tails and the fitted optimum by a plain loop over each text's slots."""
    texts = ["good fine text", "bad spam", "spam spam", "fine words", "", None, "toxic bad", "plain fine good"] * 6
    slots, at = quality.features(texts)
    rows = [np.sort(slots[at[i]:at[i + 1]]).astype(np.int64) for i in range(len(texts))]
    grades = np.array([2, 1, 1, 2, 1, 1, 0, 2] * 6)
    model = quality.Model.fit(rows, grades)
    assert all(np.diff(model.thresholds) > 0)
    tails = model.tails(texts)
    for row, text, tail in zip(rows, texts, tails):
        score = sum(float(model.weights[k]) for k in row)
        want = [1 / (1 + math.exp(t - score)) if text else 0.0 for t in model.thresholds]
        assert tail.tolist() == pytest.approx(want, rel=1e-5, abs=1e-9)
    assert tails[0, 1] > 0.5 > tails[1, 1] and tails[6, 0] < 0.5


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, "fine words", 5), (2, None, 6), (3, "", 7), (4, "fine words", 8)], "doc_id long, text string, keep int")
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (2, None, 0), (None, 1, 1), (3, 0, 0)], "doc_id long, quality int, toxic int")
    assert {tuple(r) for r in quality.graded(labels).collect()} == {(1, 0), (3, 1)}
    out = {r.doc_id: r for r in quality.score(docs, quality.train(docs, quality.graded(labels))).collect()}
    assert not out[2].keep and out[3].expected_grade == 0.0 and out[1].expected_grade == out[4].expected_grade
    empty = quality.train(docs, quality.graded(labels.limit(0)))
    assert quality.score(docs.limit(0), empty).count() == 0 and quality.score(docs, empty).count() == 4


# -- HTML --------------------------------------------------------------------------------------

PAGE = """<html><head><title>t</title><style>p{}</style></head><body><div id="header"><h1>Site</h1></div>
<div class="cookie-notice">We use cookies</div><nav><ul><li><a href="/a">a</a></li></ul></nav>
<article class="post"><header><h1>T &amp; x</h1></header><script>var t="</p>";</script><p>One<br>two <span class="ad">BUY</span>
 three<p class="notice">no<p>four <a href="#">link</a><ul><li>a<li class="ad">b<li>c</ul><form>f</form>
<section class="comments"><p>hey</p><ul><li>c1<ul><li>c2</li></ul></li></ul></section><p>l&#97;st &nbsp; &lt;</article><aside>x</aside><p>tail"""


def test_main_text_of_an_article():
    assert html_text.main_text(PAGE) == "T & x\nOne two three\nfour link\na\nc\nlast <"


def test_main_text_without_an_article_uses_stop_words_and_neighbours():
    page = """<body><div><a href=x>Home</a> <a href=y>About</a></div><h2>Title</h2>
    <p>The cat is on the mat and it was happy to be there with all of the other cats in the house.</p><p>Short.</p>
    <p><a href=z>more links here</a></p></body>"""
    assert html_text.main_text(page) == "Title\nThe cat is on the mat and it was happy to be there with all of the other cats in the house.\nShort."


def test_main_text_of_short_and_named_blocks():
    assert html_text.main_text("<body><p>Only this.</p><footer>f</footer></body>") == "Only this."
    page = "<div class='page-header'>h</div><div id=main>%s<p>Ti.</p><p>To.</p></div><div id='sideBar' class='sidebar'>s</div><div class=footer>f</div>"
    long = "Thndea anin of the stibleer and was erhe in thtion for a ndhe that they are with the other on it."
    assert html_text.main_text(page % f"<h1>Head</h1><p>{long}</p>") == f"Head\n{long}\nTi.\nTo."
    named = "<p>" + long + "</p><div class='article-body'><p>Short.</p></div><div class='commentList'>c</div>"
    assert html_text.main_text(named) == "Short."


@pytest.mark.parametrize("wrapper", [
    "class='content-with-sidebar'", "class='widget Blog'", "id='layout-sidebar-left'", "class=menu-open", "class='share related'", "id=search-page", "class='register'"])
def test_main_text_of_wrapped_articles(wrapper):
    long = "The cat is on the mat and it was happy to be there with all of the other cats in the house."
    page = f"<body><p>Site name</p><div {wrapper}><div class=sidebar><p>{long[:40]}</p></div>%s</div><footer>f</footer></body>"
    for tag in ("article", "main"):
        article = f"<{tag}><h1>Head</h1><p>{long}<span class=ad>BUY</span><div class='related-posts'><p>no</p></div><p>Ti.</{tag}>"
        assert html_text.main_text(page % article) == f"Head\n{long}\nTi."
    named = f"<main><h1>Head</h1><div {wrapper}><article><p>{long}</article></div></main>"
    assert html_text.main_text(named) == f"Head\n{long}"


def test_main_text_of_teasers_and_named_wrappers_without_an_article():
    long = "The cat is on the mat and it was happy to be there with all of the other cats in the house."
    teaser = "<div class='related-posts'><article><p>Other news of the day</article></div><div class=sidebar><article><p>More</article></div>"
    for body in ("<div class=post><p>%s</p></div>", "<article><p>%s</article>", "<div id='page-sidebar-left'><p>%s</p></div>"):
        rest = "" if "page" in body else teaser
        assert html_text.main_text(body % long + rest) == long
    comments = "<p>Short.</p><div id=comments><article><p>" + long + "</article></div>"
    assert html_text.main_text(comments) == "Short."
    assert html_text.main_text(f"<nav><main><p>{long}</main></nav><div class=sidebar><p>{long}</div>") == ""


def test_main_text_edges(spark):
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<p></p><!-- x") == html_text.main_text("<scr") == ""
    long = "<article><p>" + "word " * 200_000 + "</p></article>"
    assert len(html_text.main_text(long)) == 5 * 200_000 - 1
    assert html_text.main_text("<article>" + "<div><p>x" * 3000) == "\n".join(["x"] * 3000)
    pages = spark.createDataFrame([(1, "u", None, 3), (2, "u", PAGE, 4), (2, "u", PAGE, 4)], "page_id long, url string, html string, n_chars int")
    assert sorted(r.n_chars for r in html_text.extract(pages).collect()) == [0, 40, 40]
    assert html_text.extract(pages.limit(0)).count() == 0


def test_pages_give_their_articles(spark):
    import html
    import re
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = html_text.query(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id], re.S)[1].replace("<br>", " ")
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(x for x in parts if x) and r.n_chars == len(r.text)
