"""Cross-tokenizer alignment: which tokens of one vocabulary cover which of another.

Texts are shuffled by their full text, so each distinct one is tokenised and aligned once; its
pair counts weigh as many documents as hold it. Two tokenizations cut the same bytes, so the
merged ends of both give every overlapping pair, and the ends they share give the groups.

Pair counts are summed within chunks of texts before they are shuffled. What a chunk needs to
know of the corpus (the counts of its own pairs) comes back to it by a join, so that no table
of all pairs goes to any one task.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import settle, string_column

#: Pairs of texts that a chunk gathers before it ends; a text is never split.
CHUNK = 1_000_000
#: Tokens of texts that are aligned at once.
AT_ONCE = 400_000
#: Rows of one text meet their measures under so many keys, so that a text of very many copies is spread.
SALTS = 64


# ---- tokenizers -----------------------------------------------------------------------------

def byte_level_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: printable Latin-1
    characters for themselves, the other bytes from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


#: A space after one character and before another, neither of which anyone takes for white space or a
#: mark of format. No token of either kind spans such a place, and what stands on one side of it
#: doesn't change the tokens of the other.
_PLAIN = r"[^\s\x00-\x20\x7f-\xa0\u1680\u180e\u2000-\u206f\u3000\ufeff]"
BREAK = re.compile(f"(?<={_PLAIN})(?= {_PLAIN})")
#: Stretches between breaks that are remembered, and their greatest length; characters of new ones
#: that are encoded together.
REMEMBERED, LONGEST, TOGETHER = 200_000, 40, 20_000


class Encoder:
    """Texts to ids (as bytes of int32), stretch by stretch, each distinct stretch once as long as it is
    remembered. ``encode`` gives the ids of several strings that each begin with a space; ``spelled`` are
    the bytes of each id, ``sizes`` their lengths."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], spelled: list[bytes], parted: bool = True):
        self.encode, self.parted = encode, parted
        self.known, self.older = {}, {}
        self.sizes = np.array([len(x) for x in spelled], np.int64)
        self.flat = np.frombuffer(b"".join(spelled), np.uint8)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def spelling(self, ids: np.ndarray) -> np.ndarray:
        """The joined bytes of ids."""
        sizes = self.sizes[ids]
        shift = self.starts[ids] - (np.cumsum(sizes) - sizes)
        return self.flat[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))]

    def _together(self, stretches: list[str]) -> list[bytes]:
        """Several stretches encoded as one string and cut where they end; one by one where that
        doesn't come out even, as the bytes are not the text's."""
        (ids,) = self.encode(["".join(stretches)])
        ids = np.array(ids, np.int32)
        ends, wanted = np.cumsum(self.sizes[ids]), np.cumsum([len(s.encode()) for s in stretches])
        at = np.searchsorted(ends, wanted)
        if len(ends) and at[-1] == len(ends) - 1 and (ends[np.minimum(at, len(ends) - 1)] == wanted).all():
            cuts = [0, *(at + 1).tolist()]
            return [ids[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
        return [np.array(x, np.int32).tobytes() for x in self.encode(stretches)]

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of a space and each text."""
        if not self.parted:
            return [np.array(x, np.int32).tobytes() for x in self.encode([" " + t for t in texts])]
        cut = [BREAK.split(" " + t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        known, older, new = self.known, self.older, []
        for s in set(chain.from_iterable(cut)).difference(known):
            if s in older:
                known[s] = older[s]
            else:
                new.append(s)
        long = {}
        for i, j in _places([len(s) for s in new], TOGETHER):
            for s, ids in zip(new[i:j], self._together(new[i:j]), strict=True):
                (known if len(s) <= LONGEST else long)[s] = ids
        get = known.__getitem__ if not long else lambda s: known[s] if s in known else long[s]
        return [b"".join(map(get, parts)) for parts in cut]


def byte_level(path: str) -> Encoder:
    """The encoder of a byte-level vocabulary file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    alphabet, vocabulary = byte_level_alphabet(), tokenizer.get_vocab()
    spelled = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        spelled[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
    return Encoder(lambda parts: [x.ids for x in tokenizer.encode_batch_fast(parts, add_special_tokens=False)], spelled)


def pieces(path: str) -> Encoder:
    """The encoder of a sentence-piece model, which adds the space itself."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    spelled = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
    # It is as fast on whole texts, and what it normalises need not end where a word does.
    return Encoder(lambda parts: model.encode([s[1:] for s in parts], num_threads=1), spelled, parted=False)


# ---- alignment ------------------------------------------------------------------------------

class Aligned:
    """Tokenizations of several texts, aligned: laid end to end, where each text's end is one that
    both share. Texts that either side does not give back byte by byte have no tokens."""

    def __init__(self, texts: list[str], first: Encoder, second: Encoder):
        n = len(texts)
        kept = [[], []]
        for t, *both in zip(texts, first(texts), second(texts), strict=True):
            whole = np.frombuffer(b" " + t.encode(), np.uint8)
            ids = [np.frombuffer(x, np.int32) for x in both]
            same = all(np.array_equal(e.spelling(x), whole) for e, x in zip((first, second), ids, strict=True))
            for side, x in zip(kept, ids, strict=True):
                side.append(x if same else x[:0])
        self.n_a, self.n_b = (np.array([len(x) for x in side], np.int64) for side in kept)
        self.a, self.b = (np.concatenate(side).astype(np.int64) for side in kept)
        end_a, end_b = np.cumsum(first.sizes[self.a]), np.cumsum(second.sizes[self.b])
        # Ends as marks on the bytes; a running count of marks gives the token at a byte.
        length = int(end_a[-1]) + 1 if len(end_a) else 1
        at_a, at_b = np.zeros(length, bool), np.zeros(length, bool)
        at_a[end_a], at_b[end_b] = True, True
        before_a, before_b, both = (np.cumsum(x, dtype=np.int64) - x for x in (at_a, at_b, at_a & at_b))
        # Each stretch between neighbouring ends lies in one token of either side: a link.
        ends = np.flatnonzero(at_a | at_b)
        self.of_a, self.of_b = before_a[ends], before_b[ends]
        text = np.repeat(np.arange(n), self.n_a)
        self.text_of_link = text[self.of_a]
        self.group_a, self.group_b = both[end_a], both[end_b]
        self.n_links = np.bincount(self.text_of_link, minlength=n)
        self.n_groups = np.bincount(text[before_a[np.flatnonzero(at_a & at_b)]], minlength=n)

    def pairs(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, pair (a * width + b) and number of links of each pair of ids that a text holds."""
        code = self.a[self.of_a] * width + self.b[self.of_b]
        order = np.lexsort((code, self.text_of_link))
        text, code = self.text_of_link[order], code[order]
        first = np.flatnonzero(np.concatenate(([True], (text[1:] != text[:-1]) | (code[1:] != code[:-1])))) if len(code) else np.zeros(0, np.int64)
        return text[first], code[first], np.diff(np.append(first, len(code)))

    def digests(self, spelled_a: np.ndarray, spelled_b: np.ndarray) -> list[str]:
        """sha256 of each text's groups, as ``a1,a2|b1;a3|b2,b3``; an empty string without tokens.
        spelled_a, spelled_b: each id with what may follow it: a comma, a bar or semicolon, nothing."""
        groups = int(self.n_groups.sum())
        per_a, per_b = np.bincount(self.group_a, minlength=groups), np.bincount(self.group_b, minlength=groups)
        before_a, before_b = np.cumsum(per_a) - per_a, np.cumsum(per_b) - per_b
        place_a = np.arange(len(self.a)) + before_b[self.group_a]
        place_b = np.arange(len(self.b)) + (before_a + per_a)[self.group_b]
        out = np.empty(len(self.a) + len(self.b), object)
        last = np.concatenate((self.group_a[1:] != self.group_a[:-1], [True]))[:len(self.a)]
        out[place_a] = spelled_a[self.a, last.astype(np.int64)]
        last = np.concatenate((self.group_b[1:] != self.group_b[:-1], [True]))[:len(self.b)].astype(np.int64)
        text_end = np.cumsum(self.n_b)[self.n_b > 0] - 1
        last[text_end] = 2
        out[place_b] = spelled_b[self.b, last]
        flat = out.tolist()
        ends = np.cumsum(self.n_a + self.n_b)
        return [hashlib.sha256(b"".join(flat[e - m:e])).hexdigest() if m else "" for e, m in zip(ends.tolist(), (self.n_a + self.n_b).tolist(), strict=True)]


def spelled(n: int, close: bytes) -> np.ndarray:
    out = np.empty((n, 3), object)
    for i in range(n):
        s = b"%d" % i
        out[i] = s + b",", s + close, s
    return out


def _places(weights: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Slices of rows of about ``most`` in weight."""
    begin, size = 0, 0
    for i, w in enumerate(weights):
        if i > begin and size + w > most:
            yield begin, i
            begin, size = i, 0
        size += w
    if begin < len(weights):
        yield begin, len(weights)


MEASURES = "key binary, copies long, salts long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, times array<int>"


def _aligner(first: Callable[[], Encoder], second: Callable[[], Encoder], names: pa.Schema) -> Callable:
    """Rows of distinct texts -> rows with their pairs, and after those of a chunk one with the
    chunk's own (null key): each pair and the documents that hold it."""
    pair = names.field("codes").type.value_type

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side_a, side_b = first(), second()
        width = len(side_b.sizes)
        spelled_a, spelled_b = spelled(len(side_a.sizes), b"|"), spelled(width, b";")
        held, size, chunk = [], 0, None

        def summary() -> pa.RecordBatch:
            codes, weights = (np.concatenate(x) for x in zip(*held, strict=True))
            codes, at = np.unique(codes, return_inverse=True)
            sums = np.zeros(len(codes), np.int64)
            np.add.at(sums, at, weights)
            blank = [pa.array([None], names.field(i).type) for i in range(1, 10)]
            return pa.RecordBatch.from_arrays([pa.array([chunk]), *blank, pa.array([codes.astype(pair.to_pandas_dtype())]), pa.array([sums])], schema=names)

        for batch in batches:
            texts = string_column(batch, "text")
            keys, copies = batch.column("key"), batch.column("copies").to_numpy()
            for i, j in _places([len(t) for t in texts], 4 * AT_ONCE):
                part = texts[i:j]
                done = Aligned(part, side_a, side_b)
                text, code, times = done.pairs(width)
                ends = pa.array(np.searchsorted(text, np.arange(len(part) + 1)).astype(np.int32))
                if chunk is None:   # the first text's digest names the chunk
                    chunk = int.from_bytes(keys[i].as_py()[:8], "little", signed=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), chunk)), keys.slice(i, j - i), pa.array(copies[i:j]), batch.column("salts").slice(i, j - i),
                     *(pa.array(x) for x in (done.n_a, done.n_b, done.n_groups, done.n_links)), pa.array(done.digests(spelled_a, spelled_b)),
                     pa.ListArray.from_arrays(ends, pa.array(times, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(code, pair)), pa.nulls(len(part), pa.list_(pa.int64()))],
                    schema=names)
                held.append((code, copies[i:j][text]))
                size += len(code)
                if size >= CHUNK:
                    yield summary()
                    held, size, chunk = [], 0, None
        if held:
            yield summary()

    return run


def _measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of chunk, those that tell counts first -> measures of each text. Holds the
    counts of one chunk at a time."""
    chunk, told, table = None, [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        chunks, is_text = batch.column("chunk").to_numpy(), batch.column("key").is_valid().to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero((chunks[1:] != chunks[:-1]) | (is_text[1:] != is_text[:-1])) + 1).tolist(), len(chunks)]
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            if chunks[i] != chunk:
                chunk, told, table = chunks[i], [], None
            part = batch.slice(i, j - i)
            if not is_text[i]:
                told.append([part.column(c).to_numpy() for c in ("code", "count", "best")])
                continue
            if table is None:
                table = [np.concatenate(x) for x in zip(*told, strict=True)] if told else [np.zeros(0, np.int64)] * 3
                order = np.argsort(table[0])
                table, told = [x[order] for x in table], []
            codes, times = (part.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("codes", "times"))
            at = np.searchsorted(table[0], codes)
            sizes = part.column("codes").value_lengths().to_numpy(zero_copy_only=False)
            ends = np.concatenate(([0], np.cumsum(sizes)))
            best, total = (np.concatenate(([0], np.cumsum(times * table[k][at]))) for k in (2, 1))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("key", "salts", "n_a", "n_b", "n_groups", "n_links")),
                                              pa.array(np.diff(best[ends])), pa.array(np.diff(total[ends])), part.column("groups_sha256")],
                                             names=["key", "salts", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def align(docs: DataFrame, first: Callable[[], Encoder], second: Callable[[], Encoder], sizes: tuple[int, int],
          id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Measures of every document, and the pair counts of the corpus.

    ``first`` and ``second`` make the encoders in a task (``byte_level``, ``pieces``); ``sizes`` are their
    numbers of ids.

    Measures: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``, one row for
    each row of ``docs``, also where the id is null or repeated. A text that is null, empty, or not
    given back byte by byte by both has no tokens: zeros and an empty digest.
    Counts: ``a, b, count, best``: in how many documents (rows) the pair is linked, and whether that
    is the highest of its ``a``, ties included. An empty table gives two empty ones; other columns
    aren't read.
    """
    width = sizes[1]
    code = "int" if sizes[0] * width < 1 << 31 else "long"
    kept = f"chunk long, {MEASURES}, codes array<{code}>"
    names = to_arrow_schema(StructType.fromDDL(f"{kept}, weights array<long>"), prefers_large_types=False)
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    salt = F.pmod(F.xxhash64(F.lit("copy"), F.coalesce("doc_id", F.lit(0))), F.lit(SALTS)).cast("int")
    key = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    distinct = (given.where(F.length("text") > 0).groupBy("text")
                .agg(F.count("*").alias("copies"), F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), salt)).alias("salts"))
                .select(key.alias("key"), "copies", "salts", "text"))
    aligned = settle(distinct.mapInArrow(_aligner(first, second, names), f"{kept}, weights array<long>"), "aligned")

    own = aligned.where(F.col("key").isNull()).select("chunk", F.explode(F.arrays_zip("codes", "weights")).alias("p")).select("chunk", F.col("p.codes").alias("code"), F.col("p.weights").alias("n"))
    counts = settle(own.groupBy("code").agg(F.sum("n").alias("count")).withColumn("a", F.expr(f"code div {width}")), "pair-counts")
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))
    counts = settle(counts.join(highest, "a").select("code", "a", (F.col("code") % width).cast("long").alias("b"), "count",
                                                     (F.col("count") == F.col("highest")).cast("long").alias("best")), "pairs")

    told = own.select("chunk", "code").join(counts.select("code", "count", "best"), "code")
    text = aligned.where(F.col("key").isNotNull()).drop("weights")
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in text.schema.fields[1:]]
    left = told.select("chunk", *blank, "code", "count", "best")
    right = text.select("*", *(F.lit(None).cast(t).alias(c) for c, t in (("code", code), ("count", "long"), ("best", "long"))))
    measures = (left.unionByName(right).repartition("chunk").sortWithinPartitions("chunk", F.col("key").isNotNull())
                .mapInArrow(_measure, "key binary, salts long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"))
    copies = F.filter(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda i: F.call_function("getbit", F.col("salts"), i) == 1)
    spread = measures.withColumn("salt", F.explode(copies)).drop("salts")
    rows = given.select("doc_id", F.when(F.length("text") > 0, key).alias("key"), salt.alias("salt")).join(spread, ["key", "salt"], "left")
    whole = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    return (rows.select("doc_id", *whole, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")),
            counts.select("a", "b", "count", (F.col("best") == 1).alias("best")))
