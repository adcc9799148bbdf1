"""Quality classifier: regularised quadratic discriminant on document statistics.

Each text becomes a vector of transformed statistics (logs, logits of shares). Spark adds up
counts, sums and products by class over all labelled rows; the driver, which gets a few
matrices of the vector's width, shrinks each class covariance towards the pooled one and
towards a multiple of the identity, and keeps its Cholesky factor. A score is the difference
of the classes' Mahalanobis log-densities, put through the logistic function.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import string_column, texts

NAMES = ("log_words", "log_mean_word", "word_spread", "symbols", "pipes", "other_marks", "stops", "exclaims", "digits",
         "upper", "non_ascii", "spaces", "distinct_words", "top_word", "adjacent_same", "short_lines", "repeated_lines",
         "distinct_bytes", "log_ratio", "word_entropy")
_SYMBOLS = np.frombuffer(b"#*$%&<>@^~=_+\\{}[]", np.uint8)
_KINDS = {"symbols": _SYMBOLS, "pipes": b"|", "other_marks": b"-/()'\"`", "stops": b".,;:?", "exclaims": b"!",
          "digits": b"0123456789", "upper": bytes(range(65, 91)), "spaces": b" \t\n\v\f\r"}
_TABLE = np.zeros((256, len(_KINDS)))
for _k, _chars in enumerate(_KINDS.values()):
    _TABLE[np.frombuffer(bytes(_chars), np.uint8), _k] = 1


def _logit(share: float, n: float) -> float:
    """Of a share among n, drawn in by half a case so that 0 and 1 stay finite."""
    k = share * n
    return math.log((k + 0.5) / (n - k + 0.5))


def statistics(text: str, compressor: zstandard.ZstdCompressor) -> list[float]:
    """The vector of one whole text, in the order of NAMES; finite for any text, also an empty one."""
    raw = text.encode("utf-8", "replace")
    n = max(1, len(raw))
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    kinds = dict(zip(_KINDS, counts @ _TABLE, strict=True))
    found = raw.split()
    m = max(1, len(found))
    sizes = np.fromiter(map(len, found), float, len(found)) if found else np.zeros(1)
    times = Counter(w.lower() for w in found)
    share = np.fromiter(times.values(), float) / m if times else np.ones(1)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    k = max(1, len(lines))
    same = sum(map(bytes.__eq__, found, found[1:]))
    # Per 1,000 bytes or words at most, else long texts lie far out for their length alone.
    nb, nw = min(n, 1000), min(m, 1000)
    return [math.log1p(len(found)), math.log1p(sizes.mean()), math.log1p(sizes.std()),
            _logit(kinds["symbols"] / n, nb), _logit(kinds["pipes"] / n, nb), _logit(kinds["other_marks"] / n, nb),
            _logit(kinds["stops"] / n, nb), _logit(kinds["exclaims"] / n, nb), _logit(kinds["digits"] / n, nb),
            _logit(kinds["upper"] / n, nb), _logit(counts[128:].sum() / n, nb), _logit(kinds["spaces"] / n, nb),
            math.log(len(times) + 1) - math.log1p(m), math.log(share.max()), _logit(same / m, nw),
            _logit(sum(len(x) < 30 for x in lines) / k, min(k, 100)), _logit((len(lines) - len(set(lines))) / k, min(k, 100)),
            math.log1p((counts > 0).sum()), math.log((len(raw) + 20) / (len(compressor.compress(raw)) + 20)),
            float(-(share * np.log(share)).sum())]


VECTOR = "doc_id long, x array<double>"


def vectors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the vector of its text. Narrow; nothing but the text is read for the vector."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = zstandard.ZstdCompressor(level=1, write_content_size=False)
        for batch in batches:
            if batch.num_rows:
                x = np.array([statistics(t, c) for t in string_column(batch, "text")])
                ends = pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, pa.array(x.ravel()))], names=["doc_id", "x"])

    return texts(docs, id_col, text_col).mapInArrow(run, VECTOR)


@dataclass
class Model:
    """Per class: log prior, mean, inverse of the Cholesky factor, log of the determinant."""

    priors: np.ndarray
    means: np.ndarray
    factors: np.ndarray
    log_dets: np.ndarray
    #: The difference of log-densities is divided by this, for the statistics aren't independent
    #: normal variables and the plain difference is far too sure.
    temper: float = 8.0

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row."""
        if len(self.priors) < 2:
            return np.full(len(x), float(self.priors[0]))
        z = [((x - m) @ f.T) for m, f in zip(self.means, self.factors, strict=True)]
        density = [-0.5 * (v * v).sum(axis=1) - 0.5 * d for v, d in zip(z, self.log_dets, strict=True)]
        gap = (density[1] - density[0]) / self.temper + self.priors[1] - self.priors[0]
        return 1 / (1 + np.exp(-np.clip(gap, -30, 30)))


def fit(labelled: DataFrame, to_pooled: float = 0.3, to_identity: float = 0.05, temper: float = 8.0) -> Model:
    """From ``x`` and ``label`` (0 or 1; other labels and nulls are left out) of all rows given.

    Each class covariance becomes (1 - to_pooled) of its own plus to_pooled of the pooled one,
    and that (1 - to_identity) plus to_identity of its mean variance on the diagonal; a class
    with few rows leans on the pooled one in full. An id that has two labels counts with both. If one class alone has rows, every score is
    0.99 or 0.01; without rows it is 0.5.
    """
    width = len(NAMES)

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").values.to_numpy().reshape(-1, width)
                y = batch.column("label").to_numpy()
                for c in (0, 1):
                    own = np.hstack([np.ones(((y == c).sum(), 1)), x[y == c]])
                    sums[c] = sums.get(c, 0) + own.T @ own
        for c, s in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([c] * s.size, pa.int32()), pa.array(np.arange(s.size)), pa.array(s.ravel())], names=["label", "cell", "v"])

    rows = (labelled.where(F.col("label").isin(0, 1)).select(F.col("label").cast("int").alias("label"), "x")
            .mapInArrow(add, "label int, cell long, v double").groupBy("label", "cell").agg(F.sum("v").alias("v")).toPandas())
    sums = np.zeros((2, (width + 1) ** 2))
    sums[rows["label"], rows["cell"]] = rows["v"]
    sums = sums.reshape(2, width + 1, width + 1)
    n = sums[:, 0, 0]
    if n.min() < 1:
        return Model(np.array([0.5 if n.max() < 1 else (0.99 if n[1] else 0.01)]), *[np.zeros(0)] * 3)
    means = sums[:, 0, 1:] / n[:, None]
    own = np.stack([s[1:, 1:] / k - np.outer(m, m) for s, k, m in zip(sums, n, means, strict=True)])
    pooled = (own * n[:, None, None]).sum(axis=0) / n.sum()
    inverse, log_dets = [], []
    for c, k in zip(own, n, strict=True):
        lean = max(to_pooled, min(1.0, 5 * width / k))
        c = (1 - lean) * c + lean * pooled
        c = (1 - to_identity) * c + to_identity * (np.trace(c) / width + 1e-6) * np.eye(width)
        factor = np.linalg.cholesky(c)
        inverse.append(np.linalg.inv(factor))
        log_dets.append(2 * np.log(np.diag(factor)).sum())
    return Model(np.log(n / n.sum()), means, np.stack(inverse), np.array(log_dets), temper)


def score(vecs: DataFrame, model: Model) -> DataFrame:
    """doc_id and ``score`` of each row of ``vectors``. The model is a few small matrices. Repeated rows give
    repeated results, a null id stays, an empty table gives none."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").values.to_numpy().reshape(-1, len(NAMES))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x))], names=["doc_id", "score"])

    return vecs.select("doc_id", "x").mapInArrow(run, "doc_id long, score double")
