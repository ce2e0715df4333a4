"""Token ids as bit-plane files.

Encoding: the tokenizers library encodes the text. Ids of a document depend only on its
space-separated words, so each distinct word of a task is encoded once and documents are put
together from the words' ids. Pre-tokens go to a tokenizer with the same model that only splits at
blanks: they are normalised and cut already.

File format (one file per range of doc_id, in ascending doc_id order):

    chunks   fixed-size blocks of ids; every block is transposed into bit planes (one bit of all
             its ids per plane; byte planes on request), each plane compressed with zstandard
    index    zstandard-compressed int64 table, a row per chunk: offset, ids, planes, plane sizes...
    docs     zstandard-compressed int64 table: doc_id, null flag, ids of the document
    tail     JSON (places of both tables, plane kind) + its length (4 bytes) + magic (4 bytes)

Files are written below the shared folder under a name of the task attempt; only the files listed
in the manifest that Spark commits are read, so repeated or lost tasks leave no double rows. Tasks
hold one block and the document table of their range, never the ids of the whole range.

Defined cases: null and empty texts hold the end id only; equal doc_ids keep all their rows,
ordered by text; a null doc_id comes first and stays null; an empty table gives no files and no
rows; other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Numbers, read, shared_path, slices, spread, stored

MAGIC = b"TPL1"
BLOCK = 1 << 16
END_ID = 1
KNOWN_WORDS = 400_000
PARTS_A_TEXT, PARTS_A_CALL = 50, 20_000


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


#: Characters of simple texts: no combining marks, no white space, and lower case that does not depend on the context.
SIMPLE = "!-~\u00a1-\u00ac\u00ae-\u012f\u0131-\u024f"


def simple_cut(pattern: str):
    """``findall`` of a pre-token pattern for simple texts in lower case. Their letters and numbers are
    listed, so that Python's own expressions do, faster; a pattern that then differs stays as it is."""
    chars = [chr(c) for c in range(0x250) if re.fullmatch(f"[{SIMPLE}]", chr(c))]
    chars = sorted({*chars, *(c.lower() for c in chars)})
    listed = pattern
    for kind in "LN":
        listed = listed.replace(rf"\p{{{kind}}}", "".join(re.escape(c) for c in chars if unicodedata.category(c)[0] == kind))
    whole = regex.compile(pattern).findall
    try:
        cut = re.compile(listed).findall
    except re.error:
        return whole
    probe = " ".join(chars) + "\n" + "".join(chars) + "".join(a + b for a, b in zip(chars, reversed(chars), strict=True))
    return cut if cut(probe) == whole(probe) else whole


class WordEncoder:
    """Ids by word, filled from the tokenizers library as new words come.

    A text of Latin letters, digits, ASCII signs and blanks is cut into the tokenizer's own pre-tokens
    (its pattern is read from the file); each distinct pre-token is encoded once, many in one call.
    Any other text is cut into words, which share the pre-tokens; a word with other characters is
    encoded whole."""

    simple = re.compile(f"[{SIMPLE}]+").fullmatch
    simple_text = re.compile(f"[ \n{SIMPLE}]*").fullmatch

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as source:
            stored_form = json.load(source)
        steps = stored_form["pre_tokenizer"]["pretokenizers"]
        kinds = [n["type"] for n in stored_form["normalizer"]["normalizers"]]
        suffix = stored_form["model"]["end_of_word_suffix"]
        if kinds != ["NFC", "Replace", "Lowercase"] or [s["type"] for s in steps] != ["Split", "ByteLevel"] or not suffix:
            raise ValueError("a tokenizer with word ends and lower case is expected")
        self.cut = simple_cut(steps[0]["pattern"]["Regex"])
        self.blanks_part = self.cut("a b\nc  ") == ["a", "b", "c"]     # no pre-token holds a blank
        self.of_parts = Tokenizer.from_file(path)
        self.of_parts.normalizer = normalizers.Sequence([])
        self.of_parts.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.has_special = re.compile("|".join(map(re.escape, self.special))).search
        self.forget()

    def forget(self) -> None:
        self.parts = Numbers()                                # pre-tokens, and words that stay whole
        self.part_ids, self.part_at = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        self.known: dict[str, int] = {}                        # words
        self.ids, self.at = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _encode_parts(self, plain: list[str], whole: list[str]) -> None:
        """Ids of new pre-tokens and of new whole words, in this order."""
        ids, sizes = [], []
        for k in range(0, len(plain), PARTS_A_CALL):
            some = [" ".join(plain[n:n + PARTS_A_TEXT]) for n in range(k, min(k + PARTS_A_CALL, len(plain)), PARTS_A_TEXT)]
            encoded = self.of_parts.encode_batch_fast(some, add_special_tokens=False)
            got = np.fromiter(chain.from_iterable(e.ids for e in encoded), np.uint32)
            ids.append(got)
            sizes.append(np.diff(np.concatenate([[-1], np.flatnonzero(self.ends[got])])))
        for word in whole:
            ids.append(np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, np.uint32))
            sizes.append(np.array([len(ids[-1])]))
        if ids:
            self.part_ids = np.concatenate([self.part_ids, *ids])
            self.part_at = np.concatenate([self.part_at, self.part_at[-1] + np.cumsum(np.concatenate(sizes))])
        if len(self.part_at) != len(self.parts) + 1:
            raise ValueError("pre-tokens and word ends do not agree")

    def _learn(self, words: list[str]) -> None:
        number, cut, simple = self.parts.__getitem__, self.cut, self.simple
        odd = set()
        if not simple("".join(words)) or self.has_special("\n".join(words)):
            odd = {w for w in words if w and (not simple(w) or self.has_special(w))}
        found = [[] if w in odd else list(map(number, cut(w.lower()))) for w in words]
        plain, self.parts.new = self.parts.new, []
        for k, w in enumerate(words):
            if w in odd:
                found[k] = [number("\0" + w)]                  # never a pre-token's name
        whole, self.parts.new = [w[1:] for w in self.parts.new], []
        self._encode_parts(plain, whole)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        p = np.fromiter(chain.from_iterable(found), np.int64, int(lengths.sum()))
        counts = self.part_at[p + 1] - self.part_at[p]
        self.ids = np.concatenate([self.ids, self.part_ids[spread(self.part_at[p], counts)]])
        total = np.concatenate([[0], np.cumsum(counts)])[np.cumsum(lengths)]
        self.at = np.concatenate([self.at, self.at[-1] + total])
        n = len(self.known)
        self.known.update(zip(words, range(n, n + len(words)), strict=True))

    def _by_parts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of simple texts and their number per text."""
        number, cut = self.parts.__getitem__, self.cut
        found = [list(map(number, cut(t.lower()))) for t in texts]
        plain, self.parts.new = self.parts.new, []
        self._encode_parts(plain, [])
        return self._gathered(found, self.part_ids, self.part_at)

    def _by_words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        cut = [t.replace("\n", " ").split(" ") for t in texts]
        if new := list(set(chain.from_iterable(cut)).difference(self.known)):
            self._learn(new)
        return self._gathered([list(map(self.known.__getitem__, words)) for words in cut], self.ids, self.at)

    @staticmethod
    def _gathered(found: list[list[int]], ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        k = np.fromiter(chain.from_iterable(found), np.int64, int(lengths.sum()))
        counts = at[k + 1] - at[k]
        ends = np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], np.cumsum(lengths)])]
        return ids[spread(at[k], counts)], np.diff(ends)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, END_ID after each, and the offsets of the texts."""
        if max(len(self.known), len(self.parts)) > KNOWN_WORDS:
            self.forget()
        texts = [t or "" for t in texts]
        plain = np.array([self.blanks_part and self.simple_text(t) is not None and not self.has_special(t) for t in texts], bool)
        sizes, parts = np.zeros(len(texts), np.int64), []
        for rows, encoded in ((np.flatnonzero(plain), self._by_parts), (np.flatnonzero(~plain), self._by_words)):
            if len(rows):
                ids, sizes[rows] = encoded([texts[i] for i in rows])
                parts.append((rows, ids))
        at = np.concatenate([[0], np.cumsum(sizes + 1)])
        out = np.full(at[-1], END_ID, np.uint32)
        for rows, ids in parts:
            out[spread(at[rows], sizes[rows])] = ids
        return out, at


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


# -- planes ----------------------------------------------------------------------------------

def to_planes(ids: np.ndarray, kind: str = "bit") -> list[bytes]:
    """Planes of one block, lowest first; as many as its largest id needs."""
    width = max(1, int(ids.max(initial=0)).bit_length())
    if kind == "byte":
        raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
        return [raw[:, b].tobytes() for b in range((width + 7) // 8)]
    return [np.packbits((ids >> np.uint32(b) & np.uint32(1)).astype(np.uint8)).tobytes() for b in range(width)]


def from_planes(planes: list[bytes], n: int, kind: str = "bit") -> np.ndarray:
    out = np.zeros(n, np.uint32)
    for b, plane in enumerate(planes):
        raw = np.frombuffer(plane, np.uint8)
        if kind == "byte":
            out |= raw.astype(np.uint32) << np.uint32(8 * b)
        else:
            out |= np.unpackbits(raw, count=n).astype(np.uint32) << np.uint32(b)
    return out


class PlaneWriter:
    """Writes one file; ids go out a block at a time."""

    def __init__(self, sink, kind: str = "bit", block: int = BLOCK, level: int = 3):
        self.sink, self.kind, self.block, self.pack = sink, kind, block, zstandard.ZstdCompressor(level).compress
        self.rest, self.n_rest, self.chunks, self.docs, self.offset, self.n_ids = [], 0, [], [], 0, 0

    def _put(self, data: bytes) -> int:
        self.sink.write(data)
        self.offset += len(data)
        return len(data)

    def _chunk(self, ids: np.ndarray) -> None:
        start, planes = self.offset, to_planes(ids, self.kind)
        sizes = [self._put(self.pack(p)) for p in planes]
        self.chunks.append(np.array([start, len(ids), len(sizes), *sizes, *[0] * (32 - len(sizes))], np.int64))

    def add(self, doc_ids: np.ndarray, null: np.ndarray, ids: np.ndarray, at: np.ndarray) -> None:
        self.docs.append(np.stack([doc_ids, null, np.diff(at)], 1).astype(np.int64))
        self.n_ids += len(ids)
        self.rest.append(ids)
        self.n_rest += len(ids)
        if self.n_rest >= self.block:
            joined = np.concatenate(self.rest)
            whole = len(joined) // self.block * self.block
            for k in range(0, whole, self.block):
                self._chunk(joined[k:k + self.block])
            self.rest, self.n_rest = [joined[whole:]], len(joined) - whole

    def close(self) -> None:
        if self.n_rest:
            self._chunk(np.concatenate(self.rest))
        tables = {}
        for name, rows, width in (("index", self.chunks, 35), ("docs", self.docs, 3)):
            data = np.concatenate(rows or [np.zeros(0, np.int64)]).reshape(-1, width)
            tables[name] = [self.offset, self._put(self.pack(data.astype("<i8").tobytes())), width]
        tail = json.dumps({"planes": self.kind, **tables}).encode()
        self._put(tail + len(tail).to_bytes(4, "little") + MAGIC)


class PlaneReader:
    """Reads single chunks of a file by its index."""

    def __init__(self, source, size: int):
        self.source = source
        tail = self._get(size - 8, 8)
        if tail[4:] != MAGIC:
            raise ValueError("not a plane file")
        n = int.from_bytes(tail[:4], "little")
        meta = json.loads(self._get(size - 8 - n, n))
        self.kind = meta["planes"]
        self.index, self.docs = (self._table(*meta[k]) for k in ("index", "docs"))

    def _get(self, offset: int, size: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(size)

    def _table(self, offset: int, size: int, width: int) -> np.ndarray:
        return np.frombuffer(zstandard.ZstdDecompressor().decompress(self._get(offset, size)), "<i8").reshape(-1, width)

    def chunk(self, k: int) -> np.ndarray:
        offset, n, planes, *sizes = self.index[k].tolist()
        data, unpack = self._get(offset, sum(sizes)), zstandard.ZstdDecompressor().decompress
        ends = np.cumsum(sizes[:planes]).tolist()
        return from_planes([unpack(data[e - s:e]) for s, e in zip(sizes, ends, strict=False)], n, self.kind)

    def documents(self):
        """(row of the document table, ids) of every document, in file order."""
        k, have = 0, np.zeros(0, np.uint32)
        for row in self.docs:
            parts, n = [have], len(have)
            while n < row[2]:
                parts.append(self.chunk(k))
                n += len(parts[-1])
                k += 1
            have = np.concatenate(parts) if len(parts) > 1 else have
            yield row, have[:row[2]]
            have = have[row[2]:]


# -- Spark jobs --------------------------------------------------------------------------------

def write_ids(docs: DataFrame, folder: str, tokenizer: str | None = None, planes: str = "bit", block: int = BLOCK) -> DataFrame:
    """Encode ``text`` and write plane files in ascending doc_id order. Returns the committed
    manifest (part, path, size, n_docs, n_ids), a row per file, parts in doc_id order."""
    tokenizer = tokenizer or default_tokenizer()

    def run(batches):
        _single_thread()
        context, writer = TaskContext.get(), None
        part = context.partitionId()
        fs, path = pyarrow.fs.FileSystem.from_uri(f"{folder}/part-{part:06d}-{context.taskAttemptId()}.planes")
        n_docs, sink = 0, None
        for whole in batches:
            for batch in slices(whole, "text"):
                if writer is None:
                    fs.create_dir(path.rpartition("/")[0], recursive=True)
                    sink = fs.open_output_stream(path)
                    writer = PlaneWriter(sink, planes, block)
                ids, at = encoder(tokenizer).encode(batch.column("text").to_pylist())
                key = batch.column("doc_id")
                writer.add(key.fill_null(0).to_numpy(zero_copy_only=False), key.is_null().to_numpy(zero_copy_only=False), ids, at)
                n_docs += batch.num_rows
        if writer is not None:
            writer.close()
            sink.close()
            yield pa.RecordBatch.from_pydict({"part": [part], "path": [f"{folder}/{path.rpartition('/')[2]}"], "size": [writer.offset], "n_docs": [n_docs], "n_ids": [writer.n_ids]})

    ranged = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(shuffle_partitions(docs), "doc_id", F.substring("text", 1, 64)).sortWithinPartitions("doc_id", "text")
    return stored(ranged.mapInArrow(run, "part long, path string, size long, n_docs long, n_ids long"), "plane-manifest")


def _single_thread() -> None:
    """One thread per task: Spark already runs a task per core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def read_ids(manifest: DataFrame) -> DataFrame:
    """Read plane files back: a row per document with its place and checksum, and its ids.

    The starts of the files come from the manifest on the driver (a row per file, as many as
    there are range partitions)."""
    spark = manifest.sparkSession
    files = sorted(manifest.select("part", "path", "size", "n_ids").collect())
    starts = np.concatenate([[0], np.cumsum([f.n_ids for f in files])])[:-1].tolist() if files else []
    todo = spark.createDataFrame([(f.part, f.path, f.size, s) for f, s in zip(files, starts, strict=True)], "part long, path string, size long, start long")
    if files:
        todo = todo.repartitionByRange(len(files), "part")

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = pyarrow.fs.FileSystem.from_uri(row["path"])
                with fs.open_input_file(path) as source:
                    start, out, size = row["start"], [], 0
                    for (doc_id, null, n), ids in PlaneReader(source, row["size"]).documents():
                        data = ids.astype("<u4")
                        out.append((None if null else int(doc_id), start, int(n), zlib.crc32(data), data))
                        start += int(n)
                        size += int(n)
                        if size > 1 << 20:
                            yield _rows(out)
                            out, size = [], 0
                    if out:
                        yield _rows(out)

    return todo.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, ids array<long>")


def _rows(out: list[tuple]) -> pa.RecordBatch:
    at = np.concatenate([[0], np.cumsum([r[2] for r in out])]).astype(np.int32)
    ids = pa.ListArray.from_arrays(at, pa.array(np.concatenate([r[4] for r in out]).astype(np.int64)))
    columns = [pa.array([r[k] for r in out], pa.int64()) for k in range(4)]
    return pa.RecordBatch.from_arrays([*columns, ids], ["doc_id", "start", "n_tokens", "ids_crc32", "ids"])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, number and checksum of each document's ids, as read back from the plane files."""
    docs = read(spark, sf_dir, "documents")
    return read_ids(write_ids(docs, shared_path(spark, "planes"))).drop("ids")
