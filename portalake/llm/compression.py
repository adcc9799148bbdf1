"""Quality rules: bands of compression ratios, with the base counts of words and lines.

A text that zstandard makes much smaller than texts of its length usually get repeats itself;
one that it hardly makes smaller is noise (encoded data, random characters). Short texts
compress less, so the limits depend on the length. The whole text is judged, and each chunk of
a fixed number of bytes, so that a repetitive or random stretch inside a long text counts too,
however small a share of the text it is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby, pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .common import string_column, texts

SYMBOLS = b"#*$%&|<>"

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, n_bytes long, ratio double, n_chunks long, n_repetitive_chunks long, "
          "n_random_chunks long, verdict string")


@dataclass(frozen=True)
class Bands:
    """Limits of the ratio (bytes before / after) by length: of the last band that begins at or
    below the length. Prose of the usual alphabets lies between 1.4 and 2.6 here; a limit is
    half as much again, or less than what base64 text has."""

    #: (least bytes, lowest ratio, highest ratio); under the first length the ratio says nothing.
    whole: tuple[tuple[int, float, float], ...] = (
        (64, 0.0, 2.0), (128, 0.9, 2.5), (256, 1.1, 2.8), (512, 1.2, 3.0), (1024, 1.35, 3.3),
        (4096, 1.45, 3.7), (16384, 1.5, 4.2))
    chunk_bytes: int = 4096
    #: The same of a chunk; the last one of a text has from half its size to half as much again.
    chunk: tuple[tuple[int, float, float], ...] = ((1024, 1.3, 4.0), (4096, 1.4, 4.5))
    #: The text is rejected if more than this share of its chunks lies outside, or so many in turn.
    bad_chunks: float = 0.25
    bad_in_turn: int = 2
    level: int = 3

    def limits(self, n: int, chunk: bool = False) -> tuple[float, float]:
        low, high = 0.0, float("inf")
        for least, a, b in self.chunk if chunk else self.whole:
            if n >= least:
                low, high = a, b
        return low, high

    def rejects(self, bad: list[bool]) -> bool:
        """Whether a text is rejected whose chunks are outside where ``bad`` is true."""
        in_turn = max((len(list(g)) for k, g in groupby(bad) if k), default=0)
        return sum(bad) > self.bad_chunks * len(bad) or in_turn >= self.bad_in_turn


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    raw = text.encode("utf-8", "replace")
    found = raw.split()
    chars = len(b"".join(found).decode("utf-8", "replace"))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if not x.isspace() and x]
    return len(found), chars, symbols, len(lines) - len(set(lines)), _repeat_words(found)


def _repeat_words(found: list[bytes]) -> int:
    n = len(found)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    w = np.fromiter((number.setdefault(x, len(number)) for x in found), np.int64, n)
    # Windows as numbers: a pair of words first, so that three of them fit 64 bits at any length.
    _, pair = np.unique(w[:-1] * len(number) + w[1:], return_inverse=True)
    _, window, times = np.unique(pair[:-1] * len(number) + w[2:], return_inverse=True, return_counts=True)
    again = times[window] > 1
    inside = np.zeros(n, bool)
    for k in range(3):
        inside[k:n - 2 + k] |= again
    return int(inside.sum())


class Judge:
    def __init__(self, bands: Bands):
        self.bands, self.compress = bands, zstandard.ZstdCompressor(level=bands.level, write_content_size=False).compress

    def ratio(self, raw: bytes) -> float:
        return len(raw) / len(self.compress(raw)) if raw else 0.0

    def __call__(self, raw: bytes) -> tuple[int, float, int, int, int, str]:
        """Bytes, ratio, chunks, chunks over and under their limits, and ``ok``, ``repetitive`` or
        ``random``. A last chunk of less than half the size belongs to the one before."""
        b, n = self.bands, len(raw)
        ratio = self.ratio(raw)
        cuts = [*range(0, max(1, n - b.chunk_bytes // 2), b.chunk_bytes), n]
        each = [(self.ratio(raw[x:y]), *b.limits(y - x, chunk=True)) for x, y in pairwise(cuts)] if n > b.chunk_bytes else []
        over, under = [r > high for r, _, high in each], [r < low for r, low, _ in each]
        low, high = b.limits(n)
        if ratio > high or b.rejects(over):
            verdict = "repetitive"
        elif ratio < low or b.rejects(under):
            verdict = "random"
        else:
            verdict = "ok"
        return n, ratio, len(each), sum(over), sum(under), verdict


def judge(docs: DataFrame, bands: Bands = Bands(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: base counts, ``base_failed`` (under 50 words, or over half of them
    in repeated three-word windows), the ratios, ``verdict`` and ``kept``.

    A null text is an empty one: no words, ratio 0, ``base_failed``. Repeated rows give repeated
    results; an empty table gives none; further columns are not read. Narrow: no shuffle.
    """
    def run(batches) -> Iterator[pa.RecordBatch]:
        compression = Judge(bands)
        for batch in batches:
            rows = []
            for text in string_column(batch, "text"):
                n, chars, symbols, dup, repeat = base_counts(text)
                failed = n < 50 or 100 * repeat > 50 * n
                got = compression(text.encode("utf-8", "replace"))
                rows.append((n, chars, symbols, dup, repeat, failed, not failed and got[-1] == "ok", *got))
            columns = [batch.column(0), *map(pa.array, zip(*rows, strict=True))] if rows else None
            if columns:
                yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in SCHEMA.split(", ")])

    return texts(docs, id_col, text_col).mapInArrow(run, SCHEMA)
