"""Byte-level BPE: encoding whole columns of text to token ids, and back.

A text is split by a pattern; every piece is merged by itself. The pieces of a batch that are
new to the task are laid out as padded matrices, one for each band of lengths, a piece a row.
In each round every row merges its leftmost pair of lowest rank: the ranks of neighbouring
pairs come from a hash table kept in two arrays, rows that have nothing left to merge are
taken out, and the matrix gets one column narrower. Very long pieces are rows of their own;
they merge all occurrences of their lowest pair in a round, as far as that equals merging them
one by one from the left.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NONE = np.int32(2**31 - 1)
#: A key (see below) of a pair that does not merge is not under this one.
NONE_KEY = np.int64(2**31 - 1) << 16
LONG_PIECE = 256
CELLS = 1 << 20
CACHED_CHARS = 3_000_000
CHARS_AT_ONCE = 4_000_000
#: Fixed value: the public byte-level pattern, in which a space always begins a piece if what
#: stands around it is not white space.
SPACED_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_MIX = np.uint64(0x9E3779B97F4A7C15)


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file (base64 token, rank a line), at the place of their rank."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens = [b""] * (1 + max(int(r) for _, r in pairs))
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class PairTable:
    """(left id, right id) -> rank of the merged token; open addressing in numpy arrays."""

    def __init__(self, tokens: list[bytes]):
        rank = {t: i for i, t in enumerate(tokens) if t}
        keys, vals = [], []
        for t, r in rank.items():
            for cut in range(1, len(t)):
                a, b = rank.get(t[:cut]), rank.get(t[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    vals.append(r)
        self.bits = max(4, int(len(keys) * 4).bit_length())
        self.mask = np.int64((1 << self.bits) - 1)
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.vals = np.full(1 << self.bits, NONE, np.int32)
        left, v = np.array(keys, np.int64), np.array(vals, np.int32)
        slot = self._slot(left)
        while len(left):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = left[free]
            mine = self.keys[slot] == left          # of several for one slot, the last got it
            self.vals[slot[mine]] = v[mine]
            left, v, slot = left[~mine], v[~mine], (slot[~mine] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs, NONE where they don't merge; ids below 0 are padding."""
        keys = (a.astype(np.int64) << 32) | b.astype(np.int64)
        slot = self._slot(keys)
        seen = self.keys[slot]
        out = self.vals[slot]
        wrong = np.flatnonzero(seen != keys)
        out[wrong] = NONE
        todo = wrong[(seen[wrong] >= 0) & (a[wrong] >= 0) & (b[wrong] >= 0)]
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self.mask
            seen = self.keys[slot[todo]]
            hit = seen == keys[todo]
            out[todo[hit]] = self.vals[slot[todo[hit]]]
            todo = todo[~hit & (seen >= 0)]
        return out


class Tokenizer:
    """Encodes and decodes. Built once on the driver, sent to the tasks as a broadcast of the
    vocabulary's size."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens, self.pattern = tokens, pattern
        self.whole = {t: np.int32(i).tobytes() for i, t in enumerate(tokens) if t}
        self.byte_ids = np.array([np.frombuffer(self.whole[bytes([i])], np.int32)[0] for i in range(256)], np.int32)
        self.pairs = PairTable(tokens)
        self.cache: dict[str, bytes | None] = {}
        self.cached = 0
        #: Known of the usual pattern alone; by another one each text is split as a whole.
        self.independent = pattern == SPACED_PATTERN

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("cache", "split", "edge")}

    def __setstate__(self, state):
        self.__dict__ |= state
        self.cache, self.cached = {}, 0

    def _merge_rows(self, ids: np.ndarray, n: np.ndarray) -> list[bytes]:
        """ids: a piece a column, padded by -1 below; n: their lengths. Ids of each, as bytes.
        A piece's ids lie across memory rows, so that each step is one pass over whole rows."""
        width, count = ids.shape
        out: list[bytes] = [b""] * count
        at = np.arange(count)
        # A rank and its place in one number: the least is the leftmost pair of lowest rank.
        places = np.arange(width - 1, dtype=np.int64)[:, None]
        keys = (self.pairs.rank(ids[:-1].ravel(), ids[1:].ravel()).reshape(width - 1, count).astype(np.int64) << 16) | places
        while True:
            best = keys.min(axis=0)
            more = best < NONE_KEY
            if not more.all():
                done = np.flatnonzero(~more)
                ended = np.ascontiguousarray(ids[:, done].T)
                for i, row, k in zip(at[done], ended, n[done], strict=True):
                    out[i] = row[:k].tobytes()
                ids, keys, n, at, best = ids[:, more], keys[:, more], n[more], at[more], best[more]
            if not len(at):
                return out
            width, j, low = len(ids), best & 0xFFFF, (best >> 16).astype(np.int32)
            each = np.arange(len(at))
            ids[j, each] = low
            ids = np.where(places[:width - 1] <= j, ids[:-1], ids[1:])
            n = n - 1
            if width == 2:
                keys = np.full((1, len(at)), NONE_KEY, np.int64)
                continue
            keys = np.where(places[:width - 2] < j, keys[:-1], keys[1:] - 1)
            left = each[j > 0]
            k = j[left] - 1
            keys[k, left] = (self.pairs.rank(ids[k, left], ids[k + 1, left]).astype(np.int64) << 16) | k
            right = each[j < width - 2]
            k = j[right]
            keys[k, right] = (self.pairs.rank(ids[k, right], ids[k + 1, right]).astype(np.int64) << 16) | k

    def _merge_long(self, ids: np.ndarray) -> bytes:
        rank = self.pairs.rank
        ranks = rank(ids[:-1], ids[1:])
        while len(ranks):
            low = ranks.min()
            if low == NONE:
                break
            at = np.flatnonzero(ranks == low)
            # Of neighbouring occurrences, which share a token, every second one from the left.
            run = np.concatenate(([0], np.cumsum(np.diff(at) != 1)))
            first = np.flatnonzero(np.concatenate(([True], np.diff(run) != 0)))
            at = at[(np.arange(len(at)) - first[run]) % 2 == 0]
            # If a merge makes a pair of lower rank, that pair is next: stop after this merge.
            left = np.where(at > 0, ids[at - 1], -1)
            left[1:][np.diff(at) == 2] = low
            right = np.where(at + 2 < len(ids), ids[np.minimum(at + 2, len(ids) - 1)], -1)
            new = np.full(len(at), low, np.int32)
            lower = np.flatnonzero(np.minimum(rank(left.astype(np.int32), new), rank(new, right.astype(np.int32))) < low)
            if len(lower):
                at = at[:lower[0] + 1]
            ids[at] = low
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids = ids[keep]
            keep = np.ones(len(ranks), bool)
            keep[at] = False
            ranks = ranks[keep]
            at = at - np.arange(len(at))
            for j in (at[at > 0] - 1, at[at < len(ranks)]):
                ranks[j] = rank(ids[j], ids[j + 1])
        return ids.tobytes()

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece as little-endian 32-bit integers."""
        out = [self.whole.get(p) for p in pieces]
        todo = [i for i, ids in enumerate(out) if ids is None and pieces[i]]
        size = np.array([len(pieces[i]) for i in todo], np.int64)
        order = np.argsort(size, kind="stable")
        start = 0
        while start < len(order):
            width = int(size[order[start]])
            if width > LONG_PIECE:
                for k in order[start:]:
                    out[todo[k]] = self._merge_long(self.byte_ids[np.frombuffer(pieces[todo[k]], np.uint8)])
                break
            width = min(LONG_PIECE, width + width // 4)
            end = min(int(np.searchsorted(size[order], width, "right")), start + max(1, CELLS // width))
            mine = [todo[k] for k in order[start:end]]
            n = size[order[start:end]]
            width = max(2, int(n.max()))
            flat = np.frombuffer(b"".join([pieces[i] for i in mine]), np.uint8)
            ids = np.full((len(mine), width), -1, np.int32)
            ids[np.arange(width) < n[:, None]] = self.byte_ids[flat]
            for i, found in zip(mine, self._merge_rows(np.ascontiguousarray(ids.T), n), strict=True):
                out[i] = found
            start = end
        return [x or b"" for x in out]

    def _learn(self, parts: set[str]) -> None:
        """Puts into ``cache`` what ids each part has when a space stands before it. No piece of
        the pattern runs on over a space between two characters that are not white space, so
        such parts are independent; parts that are empty or touch other white space get None."""
        good, pieces = [], []
        for p in parts:
            if not p or self.edge(p):
                self.cache[p] = None
            else:
                good.append(p)
                pieces.append(self.split(" " + p))
        ids = self._ids_of(pieces)
        self.cache.update(zip(good, ids, strict=True))

    def _ids_of(self, pieces: list[list[str]]) -> list[bytes]:
        new = list(set(chain.from_iterable(pieces)))
        ids = dict(zip(new, self.encode_pieces([p.encode("utf-8", "replace") for p in new]), strict=True))
        return [b"".join([ids[x] for x in p]) for p in pieces]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        if not hasattr(self, "split"):
            self.split = regex.compile(self.pattern).findall
            self.edge = regex.compile(r"\A\s|\s\Z").search
        parts = [t.split(" ") for t in texts]
        if self.cached > CACHED_CHARS:
            self.cache.clear()
            self.cached = 0
        new = set(chain.from_iterable(p[1:] for p in parts)).difference(self.cache)
        self._learn(new)
        self.cached += sum(map(len, new)) + 20 * len(new)
        get, out, apart = self.cache.__getitem__, [], []
        for t, p in zip(texts, parts, strict=True):
            ids = list(map(get, p[1:])) if p[0] and not self.edge(p[0]) else [None]
            if None in ids or not self.independent:
                apart.append((len(out), t))
            else:
                apart.append((len(out), p[0]))
            out.append(ids)
        for (i, _), head in zip(apart, self._ids_of([self.split(t) for _, t in apart]), strict=True):
            out[i] = head if None in out[i] or not self.independent else head + b"".join(out[i])
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


def few_at_a_time(texts: list[str]) -> Iterator[list[str]]:
    """The texts in runs of a bounded number of characters; a longer text is a run by itself."""
    run: list[str] = []
    chars = 0
    for t in texts:
        if run and chars + len(t) > CHARS_AT_ONCE:
            yield run
            run, chars = [], 0
        run.append(t)
        chars += len(t)
    if run:
        yield run


@lru_cache(maxsize=4)
def load(path: str, pattern: str) -> Tokenizer:
    return Tokenizer(read_ranks(path), pattern)


def shared(spark: SparkSession, path: str, pattern: str):
    return spark.sparkContext.broadcast(load(path, pattern))


def _id_lists(ids: list[bytes]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(x) // 4 for x in ids]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), "<i4")))


def _texts(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def encode(df: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``df`` with the token ids of ``text_col`` in ``ids_col`` (array<int>), in place of a
    column of that name. Whole texts, no special tokens. A null or empty text has no ids; an
    empty table stays empty. Narrow: no shuffle."""
    tok = shared(df.sparkSession, path, pattern)
    kept = df.drop(ids_col) if ids_col != text_col else df
    names = [c for c in kept.columns if c != ids_col]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _texts(batch.column(batch.num_columns - 1))
            ids = list(chain.from_iterable(map(tok.value.encode, few_at_a_time(texts))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], _id_lists(ids)], names=[*names, ids_col])

    schema = F.lit(None).cast("array<int>")
    given = kept.select(*(F.col(f"`{c}`") for c in names), F.col(f"`{text_col}`").cast("string").alias("text of tokens"))
    return given.mapInArrow(run, kept.select(*(F.col(f"`{c}`") for c in names)).withColumn(ids_col, schema).schema)


def decode(df: DataFrame, path: str, pattern: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """``df`` with the bytes that the ids stand for in ``bytes_col``, in place of a column of
    that name. Null ids give no bytes; an id the vocabulary lacks fails the task."""
    tok = shared(df.sparkSession, path, pattern)
    kept = df.drop(bytes_col)
    at = kept.columns.index(ids_col)
    names = kept.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(at)
            ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            out = [tok.value.decode(flat[a:b]) if b > a else b"" for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*names, bytes_col])

    return kept.mapInArrow(run, kept.withColumn(bytes_col, F.lit(b"").cast("binary")).schema)
