"""Piece ids and plane files: equality with the tokenizer libraries, exact round trips."""

import random
import re
import tempfile
import zlib

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tierstore.llm import sentencepiece_codec as sp
from tierstore.llm import token_planes as tp

ODD = ["", " ", "  a  b ", "a\tb\x1cc", "it's  CAN'T", "éx", "<|endoftext|>a<|startoftext|> b", "123abc!!", "ΑΣ Σ",
       "\x00a", "ﬁ① x\ty\n é", "\n\n  x", "日本語 テスト", "<s> hi</s><0x41>", "a" * 3000, " " * 50 + "x", "🙂 ok", "İ I ı"]


def texts(n=600, seed=3):
    rnd = random.Random(seed)
    return ODD + ["".join(rnd.choice("abéÉ \n'st1!́日\x85<|>") for _ in range(rnd.randrange(60))) for _ in range(n)]


def test_pieces_equal_the_library_and_decode_back():
    library = sentencepiece.SentencePieceProcessor(model_file=sp.default_model())
    all_texts = texts()
    matcher = sp.PieceMatcher(sp.default_model())
    for part in (all_texts[:5], all_texts):                    # known segments are used again
        ids, at = matcher.encode(part)
        got = [ids[at[i]:at[i + 1]].tolist() for i in range(len(part))]
        assert got == library.encode(part)
        assert [matcher.decode(g) for g in got] == part


def test_long_segments_equal_the_library():
    """Segments on both sides of the length from which a heap is used; repeated, mixed and unknown characters."""
    library = sentencepiece.SentencePieceProcessor(model_file=sp.default_model())
    rnd = random.Random(7)
    some = ["".join(rnd.choice(alphabet) for _ in range(n)) for alphabet in ("ab", "etaoinshr", "日本語のテスト", "é日x🙂0")
            for n in (sp.LONG_SEGMENT - 2, sp.LONG_SEGMENT - 1, sp.LONG_SEGMENT, 700)]
    some += ["a" * 5000, " " * 1000, "international" * 200 + " and " + "nationality" * 90, "x y " * 40 + "thethe" * 100]
    matcher = sp.PieceMatcher(sp.default_model())
    ids, at = matcher.encode(some)
    assert [ids[at[i]:at[i + 1]].tolist() for i in range(len(some))] == library.encode(some)


def test_a_word_of_a_million_characters():
    library = sentencepiece.SentencePieceProcessor(model_file=sp.default_model())
    rnd = random.Random(8)
    word = "".join(rnd.choice(["the", "ing", "zq", "é", "a", "tion"]) for _ in range(500_000))[:1_000_000]
    assert len(word) == 1_000_000
    matcher = sp.PieceMatcher(sp.default_model())
    ids, at = matcher.encode([word])
    assert at.tolist() == [0, len(ids)] and ids.tolist() == library.encode(word)


def test_pieces_of_null_empty_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (3, "a b", "z"), (3, "a b", "z")], "doc_id long, text string, ids string")
    out = {tuple(r) for r in sp.encode(df).select("doc_id", "text", "ids").rdd.map(lambda r: (r[0], r[1], None if r[2] is None else tuple(r[2]))).collect()}
    assert {(r[0], r[1]) for r in out} == {(1, None), (2, ""), (3, "a b")}
    assert {r[2] for r in out if r[0] < 3} == {None, ()}
    back = sp.decode(sp.encode(df), text="back").select("text", "back").collect()
    assert all(r.text == r.back for r in back)
    assert sp.encode(df.limit(0)).count() == 0


def test_word_ids_equal_the_library():
    tokenizer = Tokenizer.from_file(tp.default_tokenizer())
    encoder = tp.WordEncoder(tp.default_tokenizer())
    all_texts = texts(seed=4)
    for part in (all_texts[:9], all_texts):
        ids, at = encoder.encode(part)
        want = [e.ids + [1] for e in tokenizer.encode_batch(part, add_special_tokens=False)]
        assert [ids[at[i]:at[i + 1]].tolist() for i in range(len(part))] == want


def test_simple_texts_are_cut_without_regex_and_encoded_without_normalizing():
    from itertools import product

    encoder = tp.WordEncoder(tp.default_tokenizer())
    assert isinstance(encoder.cut.__self__, re.Pattern)                    # not the slower module's
    assert not isinstance(tp.simple_cut(r"\p{Lu}+|[\p{L}]+").__self__, re.Pattern)
    chars = [c for c in map(chr, range(0x250)) if encoder.simple(c)]
    texts = ["".join(chars), " ".join(chars), *("".join(p) for p in product("a1²ªÉȺ'_.\u00d7 \n", repeat=4)), "It's we'LL 'd'Re ½x ȺȾ", "a " * 3000]
    ids, at = encoder.encode(texts)
    for k, text in enumerate(texts):
        assert ids[at[k]:at[k + 1]].tolist() == [*encoder.tokenizer.encode(text, add_special_tokens=False).ids, tp.END_ID], text


@pytest.mark.parametrize("kind", ["bit", "byte"])
def test_planes_round_trip(kind):
    rng = np.random.default_rng(1)
    for n, top in ((1, 1), (7, 50_000), (65_536, 49_407), (1000, 2**32 - 1), (9, 0)):
        ids = rng.integers(0, top + 1, n).astype(np.uint32)
        assert (tp.from_planes(tp.to_planes(ids, kind), n, kind) == ids).all()


@pytest.mark.parametrize("kind", ["bit", "byte"])
def test_plane_files_on_rows(spark, root, kind):
    tokenizer = Tokenizer.from_file(tp.default_tokenizer())
    rows = [(7, "B b"), (3, None), (3, ""), (9, "tall cats " * 50), (None, "x"), (7, "A a"), (7, "A a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("text", "text")
    out = tp.read_ids(tp.write_ids(docs, f"file://{root}", planes=kind, block=16)).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, start = [], 0
    for doc_id, text in order:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    assert sorted(map(tuple, out), key=lambda r: r[1]) == want
    empty = tp.read_ids(tp.write_ids(docs.limit(0), f"file://{tempfile.mkdtemp(prefix='run-', dir='/tmp')}"))
    assert empty.count() == 0


def test_queries_on_the_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    tokenizer = Tokenizer.from_file(tp.default_tokenizer())
    start = 0
    for r in sorted(tp.query(spark, sf).collect()):
        ids = tokenizer.encode(docs[r.doc_id] or "", add_special_tokens=False).ids + [1]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    library = sentencepiece.SentencePieceProcessor(model_file=sp.default_model())
    rows = sp.query(spark, sf).collect()
    assert len(rows) == len(docs) and all(r.round_trip and r.ids == library.encode(docs[r.doc_id] or "") for r in rows)


def test_round_trip_is_false_where_the_text_changes(spark):
    texts = ["a b", "a▁b", "▁", " ▁x", None, "", "é  日\n", "tab\t \x00"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r.round_trip for r in sp.round_trip(docs).collect()}
    assert [out[i] for i in range(len(texts))] == ["▁" not in (t or "") for t in texts]
