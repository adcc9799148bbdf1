"""Language identification by error-correcting output codes.

Every language has a codeword of bits. For each bit one binary classifier over character
n-grams tells languages with the bit from those without: a smoothed log-odds weight for each
hashed n-gram. A text's margins, one for each bit, are compared with every codeword under the
exponential loss, each bit weighted by how reliable it was; the codeword of least loss wins.
A text whose two best codewords are close is flagged, and one that fits no codeword as well as
the worst of the training rows fits its best, nor better than a text that tells nothing, is
rejected.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import session
from .common import settle, string_column, texts

UNDETERMINED = "und"
LETTER = regex.compile(r"\p{L}")
BUCKET_BITS = 16
#: n-grams of these numbers of bytes.
SIZES = (1, 2, 3, 4)
#: A little less than the loss of a text without any n-gram that was learned.
NOTHING = 0.99
#: Languages whose counts a task holds at once.
HELD = 64
_MULT = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F], np.uint32)


def features(text: str) -> np.ndarray:
    """Buckets of the text's letter n-grams, one for each occurrence. Case is folded; digits,
    punctuation and runs of white space count as one space."""
    raw = (" " + " ".join(LETTERS.findall(text.lower())) + " ").encode("utf-8", "replace")
    b = np.frombuffer(raw, np.uint8).astype(np.uint32) + np.uint32(1)
    found = []
    gram = np.zeros(len(b), np.uint32)
    for n in range(1, max(SIZES) + 1):
        gram = gram[:len(b) - n + 1] * np.uint32(257) + b[n - 1:]
        if n in SIZES and len(gram) > 0:
            mixed = (gram + np.uint32(n)) * _MULT[0]
            mixed ^= mixed >> np.uint32(15)
            found.append((mixed * _MULT[1]) >> np.uint32(32 - BUCKET_BITS))
    return np.concatenate(found)


LETTERS = regex.compile(r"[\p{L}\p{M}]+")


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """n codewords of +1 and -1. Up to seven languages: every way to part them in two (the
    exhaustive code). More: random columns that differ, about 15 bits for each doubling."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 7:
        columns = [[1 if (k >> i) & 1 or i == n - 1 else -1 for i in range(n)] for k in range(2 ** (n - 1) - 1)]
        return np.array(columns, float).T
    rng, seen, columns = np.random.default_rng(seed), set(), []
    while len(columns) < math.ceil(15 * math.log2(n)):
        c = rng.choice([-1, 1], n)
        c = c * c[-1]
        if abs(c.sum()) <= n // 2 and (k := tuple(c)) not in seen:
            seen.add(k)
            columns.append(c)
    return np.array(columns, float).T


@dataclass
class Model:
    langs: list[str]
    codes: np.ndarray
    weights: np.ndarray = field(repr=False)     # bucket x bit
    bit_weight: np.ndarray = field(repr=False)
    scale: float = 1.0
    #: A text is ambiguous if the best codeword's probability exceeds the next by less.
    margin: float = 0.1
    #: The greatest loss of a best codeword among the rows learned from, or nearly that of a text
    #: that tells nothing (1), if that is more; a text beyond it is rejected.
    bound: float = math.inf

    def margins(self, text: str) -> np.ndarray:
        """A margin for each bit: mean log-odds of the n-grams, growing with their number up to
        a bound, so that a long text is not endlessly sure."""
        f = features(text)
        times = np.bincount(f, minlength=1 << BUCKET_BITS) if len(f) > 20_000 else None
        total = times @ self.weights if times is not None else self.weights[f].sum(axis=0, dtype=np.float64)
        return self.scale * total / math.sqrt(len(f) * max(len(f), 200))

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """The loss-weighted distance to each codeword."""
        return (self.bit_weight * np.exp(-np.clip(self.codes * margins, -4, 4))).sum(axis=1) / self.bit_weight.sum()

    def decode(self, margins: np.ndarray) -> np.ndarray:
        """A probability for each language."""
        loss = self.losses(margins)
        p = np.exp(-4 * (loss - loss.min()))
        return p / p.sum()

    def predict(self, text: str | None) -> tuple[str, float, bool, str | None, bool]:
        """Language, its probability, whether it is ambiguous, the runner-up, whether it is rejected.
        Of languages that fit alike the first by name wins."""
        if not text or not LETTER.search(text) or not self.langs:
            return UNDETERMINED, 0.0, True, None, False
        if len(self.langs) == 1:
            return self.langs[0], 1.0, False, None, False
        m = self.margins(text)
        p = self.decode(m)
        best, second = np.argsort(-p, kind="stable")[:2]
        return (self.langs[best], float(p[best]), bool(p[best] - p[second] < self.margin), self.langs[second],
                bool(self.losses(m).min() > self.bound))


def _of_frequent(labelled: DataFrame, languages: int) -> DataFrame:
    """All rows of the ``languages`` most frequent languages; the driver gets their names."""
    counts = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages)
    return labelled.where(F.col("lang").isin([r["lang"] for r in counts.collect()]))


def fit(labelled: DataFrame, smoothing: float = 0.5, languages: int | None = None) -> Model:
    """Learns from ``doc_id``, ``text`` and ``lang`` of the rows given, every language; rows with a null
    one are left out. ``languages`` keeps to that many of the most frequent ones, for a column of very
    many values that is no column of languages.

    The classifier, its bits' weights and the bound are fitted on all these rows, whole texts; those
    without a letter, which no prediction weighs, have no part. Spark adds up n-gram counts by language
    and bucket and weighs each bucket's; the driver gets a number and a codeword for each language and
    2^16 weights for each bit. With no labelled rows every prediction is ``und``.
    """
    rows = labelled.where(F.col("lang").isNotNull()).select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    if languages is not None:
        rows = _of_frequent(rows, languages)

    def cells(sums: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(total[at])],
                                             names=["lang", "bucket", "n"])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(string_column(batch, "text"), string_column(batch, "lang"), strict=True):
                if LETTER.search(text):
                    if lang not in sums and len(sums) >= HELD:
                        yield from cells(sums)
                        sums.clear()
                    f = features(text)
                    # A long text counts as much as one of about 300 n-grams, no more.
                    mine = sums.setdefault(lang, np.zeros(1 << BUCKET_BITS))
                    mine += np.bincount(f, minlength=1 << BUCKET_BITS) * min(1.0, 300 / len(f))
        yield from cells(sums)

    counts = settle(rows.mapInArrow(count, "lang string, bucket long, n double")
                    .groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "grams")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(totals)
    if not langs:
        session.discard(counts)
        return Model([], codewords(0), np.zeros((1, 1)), np.ones(1))
    codes = codewords(len(langs))
    model = Model(langs, codes, _weights(counts, np.array([totals[x] for x in langs]), langs, codes, smoothing), np.ones(codes.shape[1]))
    session.discard(counts)
    _weigh_bits(model, rows)
    return model


def _weights(counts: DataFrame, totals: np.ndarray, langs: list[str], codes: np.ndarray, smoothing: float) -> np.ndarray:
    """Log-odds of each bucket for each bit, from its share of each language's n-grams. Each language
    weighs the same in a bit, whatever its number of texts."""
    floor = smoothing / totals.mean()
    sides = [(codes > 0).astype(float), (codes < 0).astype(float)]
    sides = [side / np.maximum(1, side.sum(axis=0)) for side in sides]
    parted = (codes > 0).any(axis=0) & (codes < 0).any(axis=0)

    def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(langs)
        for batch in batches:
            found = batch.column(1).flatten()
            at = pc.index_in(found.field("lang"), value_set=known).to_numpy()
            share = found.field("n").to_numpy() / totals[at]
            ends = np.cumsum(pc.list_value_length(batch.column(1)).to_numpy())
            weights = [np.where(parted, np.log(share[a:b] @ sides[0][at[a:b]] + floor) - np.log(share[a:b] @ sides[1][at[a:b]] + floor), 0.0)
                       for a, b in zip([0, *ends[:-1]], ends, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(weights, pa.list_(pa.float64()))], names=["bucket", "weights"])

    rows = (counts.groupBy("bucket").agg(F.collect_list(F.struct("lang", "n")).alias("cells"))
            .mapInArrow(weigh, "bucket long, weights array<double>").toArrow())
    weights = np.zeros((1 << BUCKET_BITS, codes.shape[1]), np.float32)
    weights[rows["bucket"].to_numpy()] = rows["weights"].combine_chunks().flatten().to_numpy().reshape(-1, codes.shape[1])
    return weights


def _weigh_bits(model: Model, labelled: DataFrame) -> None:
    """The margins' scale, each bit's weight (log-odds of its being right on the rows), and the
    bound on the loss. The rows' margins are stored meanwhile."""
    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = {x: i for i, x in enumerate(model.langs)}
        for batch in batches:
            rows = [(index[lang], model.margins(text)) for text, lang in zip(string_column(batch, "text"), string_column(batch, "lang"), strict=True) if LETTER.search(text)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.list_(pa.float64()))], names=["lang", "margins"])

    def rows_of(batch: pa.RecordBatch) -> np.ndarray:
        return batch.column(1).flatten().to_numpy().reshape(batch.num_rows, model.codes.shape[1])

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right, size, n = np.zeros(model.codes.shape[1]), np.zeros(model.codes.shape[1]), 0
        for batch in batches:
            m = rows_of(batch) * model.codes[batch.column(0).to_numpy()]
            right, size, n = right + (m > 0).sum(axis=0), size + np.abs(m).sum(axis=0), n + len(m)
        k = np.arange(len(right))
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(right), pa.array(size), pa.array(np.full(len(k), n))],
                                         names=["bit", "good", "size", "n"])

    def worst(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [float(model.losses(model.scale * m).min()) for m in rows_of(batch)]
            yield pa.RecordBatch.from_arrays([pa.array([max(found, default=0.0)])], names=["loss"])

    stored = settle(labelled.mapInArrow(measure, "lang int, margins array<double>"), "margins")
    rows = (stored.mapInArrow(check, "bit long, good double, size double, n long").groupBy("bit")
            .agg(F.sum("good").alias("good"), F.sum("size").alias("size"), F.sum("n").alias("n")).orderBy("bit").toPandas())
    n = rows["n"].to_numpy(float)
    share = (rows["good"].to_numpy() + 1) / (n + 2)
    model.bit_weight = np.maximum(0.05, np.log(share / (1 - share)))
    model.scale = float(2 * n.sum() / max(1e-9, rows["size"].sum()))
    model.bound = max(NOTHING, stored.mapInArrow(worst, "loss double").agg(F.max("loss")).first()[0] + 1e-9)
    session.discard(stored)


SCHEMA = "doc_id long, lang_pred string, score double, ambiguous boolean, second string, rejected boolean"


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``lang_pred`` (a learned language, or ``und`` if the text is null or
    has no letter), ``score`` from 0 to 1, ``ambiguous``, ``second``, and ``rejected`` if it fits no
    language as well as the worst training row did, and none better than a text that tells nothing. Whole texts, text alone.
    Repeated rows give repeated results, an empty table none. Narrow: no shuffle; the model, of
    a size fixed by its buckets and bits, goes to the tasks as a broadcast."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = [sent.value.predict(t) for t in string_column(batch, "text")]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.float64(), pa.bool_(), pa.string(), pa.bool_()), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns],
                                                 names=["doc_id", "lang_pred", "score", "ambiguous", "second", "rejected"])

    return texts(docs, id_col, text_col).mapInArrow(run, SCHEMA)
