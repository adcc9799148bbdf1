"""Language model scoring: a hashed maximum-entropy model with a class-factored softmax.

A token's probability is that of its class given the context, times that of the token in its
class. The most frequent tokens (the head) form classes of a fixed size by frequency; all
others (the tail) form classes by their last two bytes. Class weights, and within head classes
word weights, are sums over features of the context, hashed to rows: the token before, the one
two before (a skip), and the two together. Within a tail class a token has its smoothed share
of the corpus counts, so that every token of any text has a probability.

The weights are trained by rounds of distributed gradient updates: in each round every task
runs AdaGrad on mini-batches of its own texts, and Spark sums the tasks' changes, weighted by
tokens, in blocks. Counts, training and scoring read all texts given.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle, words

END = b""           # no word is empty
SMOOTH = 0.1


@dataclass(frozen=True)
class Shape:
    """Sizes; all fixed, so the model is as large at any size of the corpus."""

    head: int = 1024            # head tokens, the end among them
    class_size: int = 64
    tail_classes: int = 16
    class_rows: int = 4096      # hashed rows of each feature's class weights
    word_rows: int = 512        # and of its word weights
    rounds: int = 2
    rate: float = 0.3
    batch: int = 8192
    #: Counts known in every task: of at most so many tokens, the most frequent ones.
    known: int = 131_072
    block: int = 65_536

    @property
    def head_classes(self) -> int:
        return -(-self.head // self.class_size)

    @property
    def classes(self) -> int:
        return self.head_classes + self.tail_classes


FEATURES = 3


def tokens(text: str) -> list[bytes]:
    return [*words(text), END]


def token_lists(texts: pa.Array) -> pa.ListArray:
    """``tokens`` of each text, made by Arrow: a blank after its last word leaves an empty token there,
    the end."""
    bare = pc.ascii_trim_whitespace(pc.ascii_lower(texts))
    none, blank = pa.scalar("", bare.type), pa.scalar(" ", bare.type)
    ended = pc.if_else(pc.equal(bare, none), none, pc.binary_join_element_wise(bare, blank, none))
    return pc.ascii_split_whitespace(ended).cast(pa.list_(pa.binary()))


def tail_class(token: bytes, shape: Shape) -> int:
    return shape.head_classes + zlib.crc32(token[-2:]) % shape.tail_classes


@lru_cache(maxsize=4)
def _by_last_bytes(classes: int) -> tuple[np.ndarray, np.ndarray]:
    """The class of each two last bytes, and of each single byte."""
    two = [zlib.crc32(bytes((x, y))) % classes for x in range(256) for y in range(256)]
    return np.array(two, np.int64), np.array([zlib.crc32(bytes((x,))) % classes for x in range(256)], np.int64)


def tail_classes(found: list[bytes], shape: Shape) -> np.ndarray:
    """tail_class of many tokens."""
    two, one = _by_last_bytes(shape.tail_classes)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    flat = np.frombuffer(b"\0\0" + b"".join(found), np.uint8).astype(np.int64)
    ends = np.cumsum(sizes) + 2
    out = np.where(sizes >= 2, two[flat[ends - 2] * 256 + flat[ends - 1]], one[flat[ends - 1]])
    out[sizes == 0] = zlib.crc32(b"") % shape.tail_classes
    return out + shape.head_classes


# ---- counts ---------------------------------------------------------------------------------

def count_tokens(docs: DataFrame) -> DataFrame:
    """``token`` (binary), ``c`` over all texts; each task sends a token once for each million
    distinct ones it holds."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter = Counter()

        def out():
            yield pa.RecordBatch.from_arrays([pa.array(sums.keys(), pa.binary()), pa.array(sums.values(), pa.int64())], names=["token", "c"])
            sums.clear()

        for batch in batches:
            found = token_lists(batch.column("text")).flatten().value_counts()
            sums.update(dict(zip(_values(found.field(0)), found.field(1).to_pylist(), strict=True)))
            if len(sums) > 1_000_000:
                yield from out()
        if sums:
            yield from out()

    return docs.select("text").mapInArrow(run, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c"))


@dataclass
class Corpus:
    """What the corpus counts give: totals, and the counts of the most frequent tokens."""

    n: int
    v: int
    known: dict[bytes, int] = field(repr=False)
    tail_n: np.ndarray          # tokens of each tail class
    tail_v: np.ndarray          # distinct ones

    @property
    def log_base(self) -> float:
        return math.log10(self.n + SMOOTH * (self.v + 1))


def _class_of(token: F.Column, shape: Shape):
    last = F.substring(token, -2, 2)
    return (F.crc32(F.when(F.length(token) > 2, last).otherwise(token)) % shape.tail_classes).cast("int")


def corpus(counts: DataFrame, shape: Shape) -> Corpus:
    """Totals by class, and the known tokens: those with a count at or above a step of a
    logarithmic scale, chosen by a histogram so that at most ``shape.known`` reach the driver."""
    step = F.floor(F.log2("c") * 16).cast("int")
    steps = counts.groupBy(step.alias("s")).agg(F.count("*").alias("k")).orderBy(F.desc("s")).collect()
    least, total = None, 0
    for r in steps:
        if total + r["k"] > shape.known:
            break
        total, least = total + r["k"], r["s"]
    rows = counts.where(step >= least).toArrow() if least is not None else pa.table({"token": [], "c": []})
    known = dict(zip(rows["token"].to_pylist(), rows["c"].to_pylist(), strict=True))
    by_class = counts.groupBy(_class_of(F.col("token"), shape).alias("t")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()
    n, v = np.zeros(shape.tail_classes, np.int64), np.zeros(shape.tail_classes, np.int64)
    for r in by_class:
        n[r["t"]], v[r["t"]] = r["n"], r["v"]
    return Corpus(int(n.sum()), int(v.sum()), known, n, v)


def _values(found: pa.BinaryArray) -> list[bytes]:
    """``to_pylist`` of values without nulls, cut from one text."""
    if not len(found):
        return []
    _, offsets, data = found.buffers()
    ends = np.frombuffer(offsets, np.int32)[found.offset:found.offset + len(found) + 1].tolist()
    whole = data.to_pybytes() if data else b""
    return [whole[a:b] for a, b in zip(ends, ends[1:], strict=False)]


def _sizes(texts: pa.ListArray) -> np.ndarray:
    return texts.value_lengths().to_numpy().astype(np.int64)


# ---- the model ------------------------------------------------------------------------------

@dataclass
class Model:
    shape: Shape
    head: dict[bytes, int]
    log_base: float
    tail_log: np.ndarray                        # log10 of the smoothed size of each tail class
    class_bias: np.ndarray = field(repr=False)  # classes
    word_bias: np.ndarray = field(repr=False)   # head classes x class size, -inf where no token is
    class_w: np.ndarray = field(repr=False)     # (features * rows) x classes
    word_w: np.ndarray = field(repr=False)      # (features * rows) x (head classes * class size)
    known: dict[bytes, int] = field(repr=False, default_factory=dict)

    def weights(self) -> np.ndarray:
        return np.concatenate([self.class_w.ravel(), self.word_w.ravel()])

    def add(self, change: np.ndarray) -> None:
        cut = self.class_w.size
        self.class_w += change[:cut].reshape(self.class_w.shape)
        self.word_w += change[cut:].reshape(self.word_w.shape)

    def index(self, texts: pa.ListArray | list[list[bytes]]) -> Indexed:
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.list_(pa.binary()))
        # Arrow numbers the tokens faster than look-ups of each do.
        numbered = texts.flatten().dictionary_encode()
        found, at = _values(numbered.dictionary), numbered.indices.to_numpy().astype(np.int64)
        s = self.shape
        get = self.head.get
        head = np.fromiter([get(t, -1) for t in found], np.int64, len(found))
        mixed = np.fromiter(map(zlib.crc32, found), np.uint64, len(found)) + np.uint64(1)
        cls = np.where(head >= 0, head // s.class_size, tail_classes(found, s))
        return Indexed(found, at, _sizes(texts), head, cls, mixed)

    def contexts(self, mixed: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """A hash for each token and feature: token before, two before, both. Before the first
        token of a text stands 0."""
        place = np.arange(len(mixed)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        one = np.where(place >= 1, np.roll(mixed, 1), 0).astype(np.uint64)
        two = np.where(place >= 2, np.roll(mixed, 2), 0).astype(np.uint64)
        both = one * np.uint64(0x9E3779B97F4A7C15) + two
        out = np.stack([one, two + np.uint64(1 << 40), both ^ np.uint64(3 << 60)])
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (out >> np.uint64(32)).astype(np.int64)

    def _rows(self, hashes: np.ndarray, n: int) -> np.ndarray:
        return hashes % n + np.arange(FEATURES)[:, None] * n

    def class_scores(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of all classes for each token, and the weight rows used."""
        rows = self._rows(hashes, self.shape.class_rows)
        z = self.class_w.take(rows[0], axis=0)
        for r in rows[1:]:
            z += self.class_w.take(r, axis=0)
        z += self.class_bias
        return z, rows

    def word_scores(self, hashes: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same of the words in the given head class of each token; rows and classes as one
        number."""
        s = self.shape
        blocks = self.word_w.reshape(-1, s.class_size)
        rows = self._rows(hashes, s.word_rows) * s.head_classes + cls
        z = blocks.take(rows[0], axis=0)
        for r in rows[1:]:
            z += blocks.take(r, axis=0)
        z += self.word_bias[cls]
        return z, rows

    def score_tokens(self, x: Indexed) -> np.ndarray:
        """log10 of the probability of each token's class and, in a head class, of the word."""
        s, head, cls = self.shape, x.head[x.at], x.cls[x.at]
        hashes = self.contexts(x.mixed[x.at], x.sizes)
        out = np.empty(len(head))
        for a in range(0, len(head), s.batch):
            here = slice(a, a + s.batch)
            c, h = cls[here], head[here]
            out[here] = _log_probability(self.class_scores(hashes[:, here])[0], c)
            mine = np.flatnonzero(h >= 0)
            if len(mine):
                out[a + mine] += _log_probability(self.word_scores(hashes[:, a + mine], c[mine])[0], h[mine] % s.class_size)
        return out / math.log(10)


@dataclass
class Indexed:
    """Tokens of some texts: the distinct ones with their head number (or -1), class and hash, the
    number of each token in turn, and the sizes of the texts."""

    found: list[bytes]
    at: np.ndarray
    sizes: np.ndarray
    head: np.ndarray
    cls: np.ndarray
    mixed: np.ndarray


#: Scores are held within these bounds, far beyond any that training makes, so that their
#: exponentials can be added up as they are.
BOUND = 60.0


def _exponentials(z: np.ndarray) -> np.ndarray:
    """exp(z) in place, and the sums of the rows."""
    np.clip(z, -BOUND, BOUND, out=z)
    np.exp(z, out=z)
    return z @ np.ones(z.shape[1], z.dtype)


def _log_probability(z: np.ndarray, target: np.ndarray) -> np.ndarray:
    own = np.clip(z[np.arange(len(z)), target], -BOUND, BOUND)
    return own - np.log(_exponentials(z))


def _gradient(z: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of the negative log-probability by the scores, in place."""
    z /= _exponentials(z)[:, None]
    z[np.arange(len(z)), target] -= 1
    return z


#: Rows met at most so often in a batch are summed together, a vector of each at a time.
SELDOM = 8


def row_sums(rows: np.ndarray, grad: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The sum of ``grad`` over each distinct value of ``rows`` (below ``n_rows``), in their order there, and
    the values, those met most often first. It is the sum that ``reduceat`` gives, which is slow for
    many short stretches."""
    order = np.argsort(rows.astype(np.uint16) if n_rows <= 1 << 16 else rows, kind="stable")
    ordered = rows[order]
    first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    met = np.diff(np.append(first, len(rows)))
    by = np.argsort(-met, kind="stable")
    first, met = first[by], met[by]
    total = grad[order[first]]
    often, twice = np.searchsorted(-met, [-SELDOM, -1]).tolist()
    if often:
        begins = np.cumsum(met[:often]) - met[:often]
        places = np.arange(met[:often].sum()) + np.repeat(first[:often] - begins, met[:often])
        total[:often] = np.add.reduceat(grad[order[places]], begins, axis=0)
    if often < twice:
        rest = grad[order[first[often:twice] + 1]]
        for k in range(2, SELDOM):
            end = int(np.searchsorted(-met, -k)) - often
            if end <= 0:
                break
            rest[:end] += grad[order[first[often:often + end] + k]]
        total[often:twice] += rest
    return total, ordered[first]


def start(found: Corpus, shape: Shape) -> Model:
    """The model of the corpus counts alone: no context weighs yet."""
    ranked = sorted(found.known.items(), key=lambda x: (-x[1], x[0]))
    chosen = [t for t, _ in ranked[:shape.head]]
    if END not in chosen and chosen:
        chosen[-1] = END
    head = {t: i for i, t in enumerate(chosen)}
    tail_n, tail_v = found.tail_n.astype(float), found.tail_v.astype(float)
    mass = np.zeros(shape.head_classes * shape.class_size)
    for t, i in head.items():
        c = found.known.get(t, 0)
        mass[i] = c
        k = tail_class(t, shape) - shape.head_classes
        tail_n[k] -= c
        tail_v[k] -= c > 0
    mass = mass.reshape(shape.head_classes, shape.class_size)
    valid = np.arange(mass.size).reshape(mass.shape) < len(head)
    share = (mass + 1e-3) / ((mass + 1e-3) * valid).sum(axis=1, keepdims=True).clip(1e-3)
    bias = np.where(valid, np.log(share), -1e30).astype(np.float32)
    class_mass = np.concatenate([np.where(valid.any(axis=1), mass.sum(axis=1) + 1e-3, 0), np.maximum(tail_n, 0) + 1])
    with np.errstate(divide="ignore"):
        class_bias = np.maximum(np.log(class_mass / class_mass.sum()), -1e30).astype(np.float32)
    return Model(shape, head, found.log_base, np.log10(np.maximum(tail_n, 0) + SMOOTH * (np.maximum(tail_v, 0) + 1)), class_bias, bias,
                 np.zeros((FEATURES * shape.class_rows, shape.classes), np.float32),
                 np.zeros((FEATURES * shape.word_rows, shape.head_classes * shape.class_size), np.float32), found.known)


class Learner:
    """AdaGrad on one task's texts, from the round's weights."""

    def __init__(self, model: Model):
        self.m = Model(model.shape, model.head, model.log_base, model.tail_log, model.class_bias, model.word_bias,
                       model.class_w.copy(), model.word_w.copy())
        self.began = model
        self.class_g = np.full(self.m.class_w.shape[0], 1e-2, np.float32)
        self.word_g = np.full((self.m.word_w.shape[0], model.shape.head_classes), 1e-2, np.float32)
        self.n = 0

    def _step(self, w: np.ndarray, g2: np.ndarray, rows: np.ndarray, grad: np.ndarray) -> None:
        """Rows that a batch holds more than once get the sum of their gradients."""
        total, at = row_sums(rows, grad, len(w))
        g2[at] += (total * total).mean(axis=1)
        w[at] -= (self.m.shape.rate / np.sqrt(g2[at]))[:, None] * total / math.sqrt(total.shape[1])

    def learn(self, texts: pa.ListArray) -> None:
        m, s = self.m, self.m.shape
        i = m.index(texts)
        head, cls = i.head[i.at], i.cls[i.at]
        hashes = m.contexts(i.mixed[i.at], i.sizes)
        self.n += len(head)
        blocks, block_g = m.word_w.reshape(-1, s.class_size), self.word_g.reshape(-1)
        for a in range(0, len(head), s.batch):
            c, h, x = cls[a:a + s.batch], head[a:a + s.batch], hashes[:, a:a + s.batch]
            z, rows = m.class_scores(x)
            grad = _gradient(z, c)
            for r in rows:
                self._step(m.class_w, self.class_g, r, grad)
            mine = np.flatnonzero(h >= 0)
            if len(mine):
                z, rows = m.word_scores(x[:, mine], c[mine])
                grad = _gradient(z, h[mine] % s.class_size)
                for r in rows:
                    self._step(blocks, block_g, r, grad)

    def change(self) -> np.ndarray:
        return np.concatenate([(self.m.class_w - self.began.class_w).ravel(), (self.m.word_w - self.began.word_w).ravel()])


def _sum_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums the rows of each block; holds one vector for each block that its partition has."""
    sums: dict[int, np.ndarray] = {}
    n: Counter = Counter()
    for batch in batches:
        for block, k, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            v = np.frombuffer(raw, np.float32)
            sums[block] = sums[block] + v if block in sums else v.astype(np.float64)
            n[block] += k
    for block, v in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([n[block]], pa.int64()), pa.array([v.astype(np.float32).tobytes()], pa.binary())],
                                         names=["block", "n", "v"])


VECTORS = "block int, n long, v binary"


def train(docs: DataFrame, model: Model, doc_id: str = "doc_id") -> Model:
    """Rounds of updates over all of ``docs``: each round reads its share of the documents, by a
    hash of the id, so that all are read once. A task's changes weigh as its tokens do. They are
    summed in blocks, first in salted groups, then over all; the driver gets one vector of the
    model's size for each round."""
    spark, s = docs.sparkSession, model.shape
    blocks = -(-(model.class_w.size + model.word_w.size) // s.block)
    for k in range(s.rounds):
        sent = spark.sparkContext.broadcast(model)

        def run(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            learner, held, size = Learner(sent.value), [], 0
            for batch in batches:
                texts, at = token_lists(batch.column("text")), 0
                for i, n in enumerate(_sizes(texts).tolist(), 1):
                    size += n
                    if size >= 32 * s.batch:
                        learner.learn(pa.concat_arrays([*held, texts.slice(at, i - at)]))
                        held, size, at = [], 0, i
                held.append(texts.slice(at))
            if size:
                learner.learn(pa.concat_arrays(held))
            if learner.n:
                v = learner.change() * np.float32(learner.n)
                for b in range(blocks):
                    part = v[b * s.block:(b + 1) * s.block]
                    if part.any() or b == 0:
                        yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([learner.n], pa.int64()), pa.array([part.tobytes()], pa.binary())], names=["block", "n", "v"])

        mine = docs.where(F.pmod(F.xxhash64(F.lit("round"), F.col(doc_id)), F.lit(s.rounds)) == k).select("text")
        changes = mine.mapInArrow(run, VECTORS).withColumn("salt", (F.rand(k) * 16).cast("int"))
        some = changes.repartition("block", "salt").select("block", "n", "v").mapInArrow(_sum_blocks, VECTORS)
        rows = some.repartition("block").mapInArrow(_sum_blocks, VECTORS).collect()
        total = {r["block"]: r for r in rows}
        if total:
            n, change = total[0]["n"], np.zeros(model.class_w.size + model.word_w.size, np.float32)
            for b, r in total.items():
                v = np.frombuffer(r["v"], np.float32)
                change[b * s.block:b * s.block + len(v)] = v / n
            model.add(change)
    return model


def fit(docs: DataFrame, shape: Shape = Shape()) -> tuple[Model, Corpus, DataFrame]:
    """Model, corpus totals and the stored counts of all texts in ``docs`` (doc_id, text)."""
    counts = settle(count_tokens(docs), "counts")
    found = corpus(counts, shape)
    return train(docs, start(found, shape)), found, counts


PARTIAL = ("doc_id long, row_key long, n_tokens long, n_known long, base_score double, score double, "
           "rest array<struct<token:binary,tf:long,class:int>>")


def score(docs: DataFrame, model: Model, found: Corpus, counts: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ``doc_id, n_tokens, n_known, base_score, score``.

    Counts of the most frequent tokens are in every task; the others a text holds are joined
    with ``counts`` by token. An empty text is the end token alone. Repeated rows give repeated
    results, by a number each row gets; an empty table gives none.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            texts = token_lists(batch.column("text"))
            sizes, at = _sizes(texts).tolist(), 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + sizes[end] <= 32 * m.shape.batch):
                    size += sizes[end]
                    end += 1
                yield of_some(m, batch.slice(at, end - at), texts.slice(at, end - at))
                at = end

    def of_some(m: Model, batch: pa.RecordBatch, texts: pa.ListArray) -> pa.RecordBatch:
        x = m.index(texts)
        begins = np.cumsum(x.sizes) - x.sizes
        c = np.fromiter((m.known.get(t, -1) for t in x.found), np.int64, len(x.found))
        known, tail = c >= 0, x.head < 0
        log = np.where(known, np.log10(np.maximum(c, 0) + SMOOTH), 0)
        share = np.where(known & tail, log - m.tail_log[np.maximum(x.cls - m.shape.head_classes, 0)], 0)
        total = lambda v: np.add.reduceat(v[x.at], begins)
        # Tokens whose count isn't known here, once for each text.
        late = np.flatnonzero(~known[x.at])
        text = np.repeat(np.arange(len(texts)), x.sizes)[late]
        code, tf = np.unique(text * len(x.found) + x.at[late], return_counts=True)
        which = code % len(x.found)
        struct = pa.StructArray.from_arrays(
            [pa.array([x.found[i] for i in which.tolist()], pa.binary()), pa.array(tf),
             pa.array((x.cls[which] - m.shape.head_classes).astype(np.int32))], names=["token", "tf", "class"])
        ends = np.searchsorted(code // len(x.found), np.arange(len(texts) + 1)).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(x.sizes), pa.array(total(known.astype(np.int64))),
             pa.array(total(log) - x.sizes * m.log_base), pa.array(np.add.reduceat(m.score_tokens(x), begins) + total(share)),
             pa.ListArray.from_arrays(pa.array(ends), struct)], names=["doc_id", "row_key", "n_tokens", "n_known", "base_score", "score", "rest"])

    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row_key"), "text")
    part = settle(rows.mapInArrow(run, PARTIAL), "scored")
    tail_log = F.array(*(F.lit(float(x)) for x in model.tail_log))
    rest = part.select("row_key", F.explode("rest").alias("r")).select("row_key", "r.*")
    c = F.coalesce(F.col("c"), F.lit(0))
    late = (rest.join(counts.where(~F.col("token").isin(END)), "token", "left")
            .select("row_key", F.when(c > 0, F.col("tf")).otherwise(0).alias("k"), (F.col("tf") * F.log10(c + SMOOTH)).alias("b"),
                    (F.col("tf") * (F.log10(c + SMOOTH) - F.get(tail_log, F.col("class")))).alias("s"))
            .groupBy("row_key").agg(F.sum("k").alias("k"), F.sum("b").alias("b"), F.sum("s").alias("s")))
    zero = lambda name: F.coalesce(F.col(name), F.lit(0))
    return part.drop("rest").join(late, "row_key", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + zero("k")).alias("n_known"), (F.col("base_score") + zero("b")).alias("base_score"),
        (F.col("score") + zero("s")).alias("score"))
