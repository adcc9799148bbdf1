"""Pairs of sets that may be similar, by their rarest common tokens. Exact, for what hashing of
whole sets or signatures leaves open: sets of which many hold the same tokens.

Only pairs across components are asked for. A token that one component alone holds tells
nothing; a set of which fewer tokens are left than it would have to share is done. The others
are paired by a prefix of their left tokens, rarest first, as many as a similar pair can't do
without. A pair that shares several tokens of its prefixes comes out of the join near the first
of them only: where both sets also share one of the tokens just before, it has come out there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import settle, string_column

#: Longs of a sketch: parities of a set's tokens in 64 cells each.
WIDE = 8
#: Tokens just before a token that a row of the join carries.
BEFORE = 8
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _sketch(tokens: np.ndarray) -> np.ndarray:
    x = (tokens + _M1) * _M2
    x ^= x >> np.uint64(29)
    cells = ((x * _M1) >> np.uint64(64 - 9)).astype(np.int64)
    return np.packbits((np.bincount(cells, minlength=64 * WIDE) & 1).astype(np.uint8))


def _tokens(sets: DataFrame, shingler: Callable[[], Callable[[str], np.ndarray]]) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = shingler()
        for batch in batches:
            found = [shingles(t) for t in string_column(batch, "text")]
            at = pa.array(np.repeat(np.arange(len(found)), [len(s) for s in found]))
            flat = np.concatenate(found) if found else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(flat.view(np.int64)), *(batch.column(i).take(at) for i in (0, 1, 3))], names=["token", "id", "n", "component"])

    return sets.mapInArrow(run, "token long, id long, n long, component long")


def _sketches(sets: DataFrame, shingler: Callable[[], Callable[[str], np.ndarray]]) -> DataFrame:
    names = [f"s{i}" for i in range(WIDE)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = shingler()
        for batch in batches:
            v = np.array([_sketch(shingles(t)) for t in string_column(batch, "text")], np.uint8).reshape(-1, 8 * WIDE).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(np.ascontiguousarray(v[:, i])) for i in range(WIDE))], names=["id", "n", *names])

    return sets.select("doc_id", "n", "text").mapInArrow(run, "id long, n long, " + ", ".join(f"{x} long" for x in names))


def _shared_by(n: Column, percent: int) -> Column:
    """Tokens that a set of n shares with any it links with, at least."""
    return F.ceil(n * percent / 100)


def open_sets(sets: DataFrame, shingler, percent: int) -> tuple[DataFrame, DataFrame]:
    """Of ``sets`` (doc_id, n, text, component) the tokens that several components hold
    (``token, id, n, component, times``), stored, and the ``id, n, k`` of sets that have enough of
    them. Of an id with several texts each size is a set of its own."""
    tokens = settle(_tokens(sets.select("doc_id", "n", "text", "component"), shingler), "tokens")
    held = tokens.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("times")).where("x <> y").select("token", "times")
    still = settle(tokens.join(held, "token"), "open-tokens")
    enough = still.groupBy("id", "n").agg(F.count("*").alias("k")).where(F.col("k") >= _shared_by(F.col("n"), percent))
    return still, settle(enough, "open-sets")


def pairs(sets: DataFrame, still: DataFrame, enough: DataFrame, shingler, percent: int) -> DataFrame:
    """``a < b`` of the open sets of different components that sizes and sketches allow to have a
    Jaccard similarity of ``percent`` in the hundred. None such is left out."""
    order = W.partitionBy("id", "n").orderBy("times", "token")
    names = [f"s{i}" for i in range(WIDE)]
    first = (still.join(enough, ["id", "n"])
             .withColumn("place", F.row_number().over(order))
             .withColumn("before", F.collect_list("token").over(order.rowsBetween(-BEFORE, -1)))
             .where(F.col("place") <= F.col("k") - _shared_by(F.col("n"), percent) + 1)
             .drop("place", "times", "k"))
    wide = _sketches(sets.join(enough.select(F.col("id").alias("doc_id"), "n"), ["doc_id", "n"], "left_semi"), shingler)
    first = settle(first.join(settle(wide, "sketches"), ["id", "n"]), "prefixes")
    other = first.select(*(F.col(c).alias(c if c == "token" else f"{c}_b") for c in first.columns))
    apart = F.bit_count(F.col("s0").bitwiseXOR(F.col("s0_b")))
    for x in names[1:]:
        apart = apart + F.bit_count(F.col(x).bitwiseXOR(F.col(f"{x}_b")))
    # |A xor B| <= (1 - t) / (1 + t) * (|A| + |B|) at a similarity of t or more.
    return (first.join(other, "token")
            .where((F.col("id") < F.col("id_b")) & (F.col("component") != F.col("component_b"))
                   & (100 * F.least("n", "n_b") >= percent * F.greatest("n", "n_b"))
                   & ((100 + percent) * apart <= (100 - percent) * (F.col("n") + F.col("n_b")))
                   & ~F.arrays_overlap("before", "before_b"))
            .select(F.col("id").alias("a"), F.col("id_b").alias("b")).distinct())
