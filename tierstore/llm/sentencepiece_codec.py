"""SentencePiece encoding and decoding by suffix-array matching (BPE models with byte fallback).

The distinct segments of a batch are concatenated and indexed by a suffix array. Every piece of
the vocabulary finds its occurrences as one range of that array by binary search. The resulting
edges (start, length, priority) are laid out by position and relaxed: in each round every segment
merges the adjacent pair of symbols whose edge has the best score, the leftmost on a tie, until no
edge joins two symbols; a long segment (text without spaces) keeps its edges in a heap instead, so its
time grows like n log n. Characters that no piece covers become byte pieces. The ids equal those
of the sentencepiece library; only the vocabulary and its scores are read from the model file.

A segment is a run of spaces with the characters up to the next space (no piece reaches from a
character over a following space). Segments are independent, so each distinct one is solved once
per task; the memory for solved segments is bounded.

Defined cases: null text gives null ids, empty text gives an empty array, empty tables stay empty;
a column that has the output's name is replaced, all others are kept. The character U+2581 stands
for a space inside the model, so decoding gives a space for it and ``round_trip`` is false; every
other text comes back as it was.
"""

from __future__ import annotations

import re
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Numbers, read, slices, spread

SPACE = "▁"
LONGEST = 16          # characters of a piece that the packed suffix keys can hold
NONE = np.int32(2**31 - 1)
KNOWN_SEGMENTS = 200_000   # solved segments that a task remembers
SOLVE_CHARS = 250_000      # characters of new segments that are indexed at once
LONG_SEGMENT = 128         # characters from which a segment's edges are relaxed through a heap


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class PieceMatcher:
    """Vocabulary of one model, its packed search keys and the segments solved so far."""

    def __init__(self, model_file: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        self.byte_id = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if model.is_byte(i)}
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        if any(len(self.pieces[i]) > LONGEST or re.search(f"[^{SPACE}]{SPACE}", self.pieces[i]) for i in plain):
            raise ValueError("pieces over 16 characters or across words are not supported")
        scores = np.array([model.get_score(i) for i in plain])
        _, order = np.unique(-scores, return_inverse=True)      # equal scores share a priority
        self.plain, self.order = np.array(plain, np.int32), order.astype(np.int32)
        self.length = np.array([len(self.pieces[i]) for i in plain])
        self.chars = np.unique(np.concatenate([_points(self.pieces[i]) for i in plain]))
        self.bits = int(len(self.chars) + 1).bit_length()
        self.low, self.high = self._piece_keys(0), self._piece_keys((1 << self.bits) - 1)
        lines = any("\n" in self.pieces[i] for i in plain)
        self.split = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if lines else f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+").findall
        self.forget()

    def forget(self) -> None:
        self.known = Numbers()
        self.ids, self.at = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _codes(self, points: np.ndarray) -> np.ndarray:
        """Dense character numbers from 1; 0 for what no piece contains (separators too)."""
        k = np.searchsorted(self.chars, points)
        k[k == len(self.chars)] = 0
        return np.where(self.chars[k] == points, k + 1, 0).astype(np.int64)

    def _piece_keys(self, fill: int) -> np.ndarray:
        out = np.full((len(self.plain), LONGEST), fill, np.int64)
        for row, i in enumerate(self.plain):
            codes = self._codes(_points(self.pieces[i]))
            out[row, :len(codes)] = codes
        out = out.reshape(len(self.plain), 4, 4)
        return ((out[:, :, 0] << self.bits | out[:, :, 1]) << self.bits | out[:, :, 2]) << self.bits | out[:, :, 3]

    def _suffix_array(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes ordered by their first 16 characters, by doubling; also the 4-character keys."""
        n, b = len(codes), self.bits
        c = np.concatenate([codes, np.zeros(LONGEST + 4, np.int64)])
        key = ((c[:-3] << b | c[1:-2]) << b | c[2:-1]) << b | c[3:]
        rank, width = key[:n], 4
        while True:
            order = np.argsort(rank)
            if width == LONGEST:
                return order, key
            same = np.empty(n, np.int64)
            same[order] = np.concatenate([[0], np.cumsum(np.diff(rank[order]) != 0)])
            after = np.concatenate([same[width:] + 1, np.zeros(width, np.int64)])[:n]
            rank, width = same << 32 | after, width * 2

    @staticmethod
    def _search(order, key, wanted, right: bool) -> np.ndarray:
        """For every piece the number of suffixes below it (or not above it)."""
        lo, hi = np.zeros(len(wanted), np.int64), np.full(len(wanted), len(order), np.int64)
        w = wanted.T
        while (open_ := lo < hi).any():
            mid = (lo + hi) >> 1
            pos = order[np.minimum(mid, len(order) - 1)]
            before, tied = np.zeros(len(lo), bool), np.ones(len(lo), bool)
            for j in range(4):
                k = key[pos + 4 * j]
                before |= tied & (k < w[j])
                tied &= k == w[j]
            before |= tied if right else False
            lo, hi = np.where(open_ & before, mid + 1, lo), np.where(open_ & ~before, mid, hi)
        return lo

    def _solve(self, segments: list[str]) -> None:
        """Append the ids of new segments."""
        lengths = np.fromiter(map(len, segments), np.int64, len(segments))
        points = _points("\0".join(segments))
        codes = self._codes(points)
        first = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
        codes[first[1:] - 1] = 0                                  # separators
        order, key = self._suffix_array(codes)
        lo, hi = self._search(order, key, self.low, False), self._search(order, key, self.high, True)
        hits = hi - lo
        where = order[spread(lo, hits)]
        # edges laid out by position: row = start, column = length
        edge = np.full((len(codes), LONGEST + 1), NONE, np.int32)
        edge[where, np.repeat(self.length, hits)] = np.repeat(np.arange(len(self.plain), dtype=np.int32), hits)
        starts, ends, owner = self._relax(edge, first, lengths)
        row = edge[starts, ends - starts]
        ids = np.where(row == NONE, -1, self.plain[np.minimum(row, len(self.plain) - 1)])
        if (bare := np.flatnonzero(ids < 0)).size:               # byte fallback
            parts = [[self.byte_id[x] for x in chr(points[starts[i]]).encode()] for i in bare]
            counts = np.ones(len(ids), np.int64)
            counts[bare] = [len(p) for p in parts]
            ids, owner = np.repeat(ids, counts), np.repeat(owner, counts)
            ids[ids < 0] = np.concatenate(parts)
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(np.bincount(owner, minlength=len(segments)))])

    def _relax_long(self, edge, begin: int, n: int):
        """(starts, ends) of one segment's symbols after all merges: edges leave a heap by priority
        and place; an edge whose symbols have changed since is passed over."""
        order, nothing = self.order, int(NONE)
        size, after, before = [1] * n, list(range(1, n + 1)), list(range(-1, n - 1))
        pair = edge[begin:begin + n - 1, 2]
        at = np.flatnonzero(pair != NONE)
        heap = (order[pair[at]].astype(np.int64) << 40 | at << 5 | 2).tolist()     # priority, place, length
        heapify(heap)

        def push(a, b):
            length = size[a] + size[b]
            if length <= LONGEST and (row := int(edge[begin + a, length])) != nothing:
                heappush(heap, int(order[row]) << 40 | a << 5 | length)

        while heap:
            top = heappop(heap)
            length, a = top & 31, top >> 5 & 0x7FFFFFFFF
            b = after[a]
            if not size[a] or b >= n or size[a] + size[b] != length:
                continue
            size[a], size[b], after[a] = length, 0, after[b]
            if after[a] < n:
                before[after[a]] = a
                push(a, after[a])
            if before[a] >= 0:
                push(before[a], a)
        sizes = np.array(size, np.int64)
        starts = np.flatnonzero(sizes)
        return begin + starts, begin + starts + sizes[starts]

    def _relax(self, edge, first, lengths):
        """Merge the best edge of every segment, again and again."""
        done = []
        for k in np.flatnonzero(lengths >= LONG_SEGMENT).tolist():
            starts, ends = self._relax_long(edge, int(first[k]), int(lengths[k]))
            done.append((starts, ends, np.full(len(starts), k)))
        short = np.flatnonzero(lengths < LONG_SEGMENT)
        owner = np.repeat(short, lengths[short])
        starts = spread(first[short], lengths[short])
        limit = first + lengths
        order = np.append(self.order, NONE)
        while len(starts):
            ends = np.append(starts[1:], 0)
            last = np.append(owner[1:] != owner[:-1], True)
            ends[last] = limit[owner[last]]
            far = np.append(ends[1:], 0)                          # where the next symbol ends
            size = np.where(last, 0, far - starts)
            fits = ~last & (size <= LONGEST)
            row = np.where(fits, edge[starts, np.where(fits, size, 0)], NONE)
            best = order[np.minimum(row, len(self.order))].astype(np.int64) << 32 | np.arange(len(starts))
            heads = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            top = np.minimum.reduceat(best, heads)
            live = top >> 32 != NONE
            alive = np.repeat(live, np.diff(np.append(heads, len(starts))))
            if not live.all():
                done.append((starts[~alive], ends[~alive], owner[~alive]))
            alive[(top[live] & 0xFFFFFFFF) + 1] = False           # joined to the symbol before
            starts, owner = starts[alive], owner[alive]
        starts, ends, owner = (np.concatenate(x) for x in zip(*done, strict=True))
        by = np.argsort(starts)
        return starts[by], ends[by], owner[by]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and the offsets of each text in them."""
        if len(self.known) > KNOWN_SEGMENTS:
            self.forget()
        cut = [self.split(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        number = self.known.__getitem__                          # new segments get the next number
        k = np.fromiter(map(number, chain.from_iterable(cut)), np.int64, sum(map(len, cut)))
        size, part = 0, []
        for s in self.known.new:
            part.append(s)
            size += len(s) + 1
            if size > SOLVE_CHARS:
                self._solve(part)
                size, part = 0, []
        if part:
            self._solve(part)
        self.known.new = []
        counts = self.at[k + 1] - self.at[k]
        ids = self.ids[spread(self.at[k], counts)]
        per_text = np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], np.cumsum([len(row) for row in cut])]).astype(np.int64)]
        return ids, per_text

    def decode(self, ids: list[int]) -> str:
        """Text of one id sequence; byte pieces are joined to characters."""
        if not hasattr(self, "as_bytes"):
            self.as_bytes = [p.replace(SPACE, " ").encode() for p in self.pieces]
            for value, i in self.byte_id.items():
                self.as_bytes[i] = bytes([value])
            self.as_bytes[:1] = [" ⁇ ".encode()]
            for i in range(1, min(self.byte_id.values(), default=3)):
                self.as_bytes[i] = b""
        data = b"".join(map(self.as_bytes.__getitem__, ids))
        return data[data.startswith(b" "):].decode("utf-8", "replace")


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


_loaded: dict[str, PieceMatcher] = {}


def matcher(model_file: str) -> PieceMatcher:
    """One matcher per worker process and model file."""
    if model_file not in _loaded:
        _loaded[model_file] = PieceMatcher(model_file)
    return _loaded[model_file]


def _with_column(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name != name] + [T.StructField(name, kind)])


def encode(df: DataFrame, text: str = "text", ids: str = "ids", model_file: str | None = None) -> DataFrame:
    """Append the piece ids of ``text`` as an array column."""
    model_file = model_file or default_model()
    keep = [f.name for f in df.schema.fields if f.name != ids]

    def run(batches):
        for whole in batches:
            for batch in slices(whole, text, 1 << 20):
                column = batch.column(text)
                flat, at = matcher(model_file).encode(column.to_pylist())
                offsets = pa.array(at.astype(np.int32), mask=np.append(column.is_null().to_numpy(False), False))
                out = pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), out], [*keep, ids])

    return df.mapInArrow(run, _with_column(df.schema, ids, T.ArrayType(T.IntegerType())))


def decode(df: DataFrame, ids: str = "ids", text: str = "text", model_file: str | None = None) -> DataFrame:
    """Append the text of the piece ids in ``ids``."""
    model_file = model_file or default_model()
    keep = [f.name for f in df.schema.fields if f.name != text]

    def run(batches):
        for batch in batches:
            back = matcher(model_file).decode
            column = batch.column(ids)
            at, flat = column.offsets.to_numpy(), column.values.to_numpy(False)
            null = column.is_null().to_numpy(False)
            out = [None if null[i] else back(flat[at[i]:at[i + 1]].tolist()) for i in range(len(column))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(out, pa.string())], [*keep, text])

    return df.mapInArrow(run, _with_column(df.schema, text, T.StringType()))


def round_trip(docs: DataFrame, model_file: str | None = None) -> DataFrame:
    """Append the piece ids of ``text`` (``ids``) and whether decoding them gives the text back
    (``round_trip``), both in one pass over the rows; a null text counts as the empty text."""
    model_file = model_file or default_model()
    keep = [f.name for f in docs.schema.fields if f.name not in ("ids", "round_trip")]
    schema = _with_column(_with_column(docs.schema, "ids", T.ArrayType(T.IntegerType())), "round_trip", T.BooleanType())

    def run(batches):
        codec = matcher(model_file)
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                texts = [t or "" for t in batch.column("text").to_pylist()]
                flat, at = codec.encode(texts)
                same = [codec.decode(flat[s:e].tolist()) == t for t, s, e in zip(texts, at[:-1].tolist(), at[1:].tolist(), strict=True)]
                ids = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), ids, pa.array(same, pa.bool_())], [*keep, "ids", "round_trip"])

    return docs.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether decoding them gives the text back."""
    out = round_trip(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "round_trip")
