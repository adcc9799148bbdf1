"""Hard-negative mining: exact integer scores by a residue-number-system matrix product.

Vectors are scaled to integers. A block of anchors is multiplied with a tile of rows modulo
several small primes, each product a float32 one whose sums stay below 2^24 and so are exact.
Chinese remaindering gives the signed scores; how many primes it takes follows from the lengths
of the vectors at hand. From the scores each anchor's positives are chosen (its best rows of the
same label), then, in a second pass, for each positive the best rows of other labels whose
scores lie in the window below it.

Anchors are blocked one way and rows the other, and each cell of that grid is multiplied in one
task, so neither side is sent whole anywhere. A tile passes on its own best rows only.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from .common import settle

PRIMES = (509, 503, 499, 491, 487, 479, 467, 463)
#: Products of residues that float32 adds up exactly: each is at most 254 * 254.
EXACT = (1 << 24) // (PRIMES[0] // 2) ** 2
SCALE = 256.0
#: A row of this squared length or more has scores that 64 bits may not hold.
LONGEST = float(1 << 62)
ANCHORS_AT_ONCE, ROWS_AT_ONCE = 8192, 8192
#: A tile of scores: anchors by rows.
TILE = (1024, 4096)


# ---- arithmetic -----------------------------------------------------------------------------

def primes_for(bound: float) -> tuple[int, ...]:
    """The first primes whose product tells apart all integers from -bound to bound."""
    product = 1
    for k, p in enumerate(PRIMES, 1):
        product *= p
        if product > 2 * (int(bound * (1 + 1e-9)) + 1) + 1:
            return PRIMES[:k]
    raise ValueError(f"scores up to {bound} need more primes")


def centred(x: np.ndarray, p: int) -> np.ndarray:
    """Residues of integers from -(p // 2) to p // 2, as float32."""
    r = np.mod(x, p)
    return np.where(r > p // 2, r - p, r).astype(np.float32)


def product_mod(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """a @ b.T modulo p, of two matrices of centred residues; a residue near zero, as float32."""
    out = None
    for k in range(0, max(1, a.shape[1]), EXACT):
        c = a[:, k:k + EXACT] @ b[:, k:k + EXACT].T
        out = c if out is None else out + (c - p * np.rint(c / p))
        out -= p * np.rint(out / p)
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of two int64 matrices whose rows' squared lengths are below LONGEST, exactly."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    bound = math.sqrt(float((a.astype(float) ** 2).sum(axis=1).max())) * math.sqrt(float((b.astype(float) ** 2).sum(axis=1).max()))
    value, product = None, 1
    for p in primes_for(bound):
        c = product_mod(centred(a, p), centred(b, p), p).astype(np.int64)
        if value is None:
            value = np.where(c > p // 2, c - p, np.where(c < -(p // 2), c + p, c))
        else:
            # The next mixed-radix digit. Only the last sum can pass 64 bits on its way, and wraps back.
            digit = np.mod((c - np.mod(value, p)) * pow(product, -1, p), p)
            digit = np.where(digit > p // 2, digit - p, digit)
            with np.errstate(over="ignore"):
                value = value + digit * np.int64(product)
        product *= p
    return value


def first_of_each(row: np.ndarray, col: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k of each row, by score from the highest, then by column."""
    order = np.lexsort((col, -score, row))
    r = row[order]
    begin = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1]))) if len(r) else np.zeros(0, np.int64)
    rank = np.arange(len(r)) - np.repeat(begin, np.diff(np.append(begin, len(r))))
    return order[rank < k]


def best(s: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k best allowed scores of each row, ties by column."""
    if s.shape[1] > k:
        low = np.iinfo(np.int64).min
        held = np.where(allowed, s, low)
        kth = np.partition(held, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
        allowed = allowed & (s >= kth[:, None])
    row, col = np.nonzero(allowed)
    at = first_of_each(row, col, s[row, col], k)
    return row[at], col[at]


# ---- cells ----------------------------------------------------------------------------------

def matrix(lists: list[pa.Array]) -> np.ndarray:
    """Vectors of any lengths as one matrix of scaled integers; a shorter one ends in zeros."""
    sizes = np.concatenate([x.value_lengths().to_numpy(zero_copy_only=False) for x in lists]) if lists else np.zeros(0, np.int64)
    flat = np.concatenate([x.flatten().to_numpy(zero_copy_only=False) for x in lists]).astype(np.float64) if lists else np.zeros(0)
    width = int(sizes.max()) if len(sizes) else 0
    values = np.floor(SCALE * flat).astype(np.int64)
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = max(a.shape[1], b.shape[1])
    return tuple(x if x.shape[1] == n else np.pad(x, ((0, 0), (0, n - x.shape[1]))) for x in (a, b))


class Rows:
    """Rows of one cell and kind, in order of id; of rows that repeat an id the first."""

    def __init__(self, batch: pa.RecordBatch):
        ids = batch.column("id").to_numpy()
        keep = np.concatenate(([True], ids[1:] != ids[:-1])) if len(ids) else np.zeros(0, bool)
        if not keep.all():
            batch = batch.filter(pa.array(keep))
        self.batch, self.ids = batch, batch.column("id").to_numpy()
        self.labels = pd.Index(batch.column("label").to_pandas())
        self.vectors = matrix([batch.column("v")])


def tiles(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[Rows, Rows]]:
    """Anchors of a cell with one tile of its rows after another, from rows in order of cell,
    kind (anchors first) and id. Holds the anchors of one cell and one tile at a time."""
    cell, anchors, held, size = None, None, [], 0

    def merged(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

    def run_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        mark = batch.column("cell").to_numpy() * 2 + batch.column("kind").to_numpy()
        cuts = [0, *(np.flatnonzero(mark[1:] != mark[:-1]) + 1).tolist(), len(mark)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a:
                yield batch.slice(a, b - a)

    kind = None
    for batch in batches:
        for part in run_of(batch):
            key = part.column("cell")[0].as_py(), part.column("kind")[0].as_py()
            if key != (cell, kind):
                if kind == 0:
                    anchors = Rows(merged(held)) if key[0] == cell else None
                elif held and anchors is not None:
                    yield anchors, Rows(merged(held))
                if key[0] != cell and kind == 1:
                    anchors = None
                (cell, kind), held, size = key, [], 0
            held.append(part)
            size += part.num_rows
            if kind == 1 and size >= TILE[1]:
                # Rows of one id stand together; the last id's wait for the next tile.
                all_ = merged(held)
                ids = all_.column("id").to_numpy()
                cut = int(np.searchsorted(ids, ids[-1]))
                if cut:
                    if anchors is not None:
                        yield anchors, Rows(all_.slice(0, cut))
                    held, size = [all_.slice(cut)], all_.num_rows - cut
    if kind == 1 and held and anchors is not None:
        yield anchors, Rows(merged(held))


def _cells(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, extra: dict[str, str]) -> DataFrame:
    """Every row and every anchor in each cell of the grid it belongs to, cells whole in a task
    and in order. ``extra``: further columns of anchors, with their types."""
    blocks = max(1, -(-n_anchors // ANCHORS_AT_ONCE))
    groups = max(1, -(-n_rows // ROWS_AT_ONCE), min(64, n_rows // 256))
    place = F.xxhash64(F.lit("place"), "id")
    left = (anchors.withColumn("block", F.pmod(place, F.lit(blocks))).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
            .select((F.col("block") * groups + F.col("group")).alias("cell"), F.lit(0).alias("kind"), "id", "label", "v", *extra))
    right = (rows.withColumn("group", F.pmod(place, F.lit(groups))).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
             .select((F.col("block") * groups + F.col("group")).alias("cell"), F.lit(1).alias("kind"), "id", "label", "v",
                     *(F.lit(None).cast(t).alias(c) for c, t in extra.items())))
    return left.unionByName(right).repartition("cell").sortWithinPartitions("cell", "kind", "id", "label", "v")


def _positives(k: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for anchors, rows in tiles(batches):
            known = anchors.labels.unique()
            mine, theirs = known.get_indexer(anchors.labels), known.get_indexer(rows.labels)
            a, b = same_width(anchors.vectors, rows.vectors)
            by_anchor, by_row = (np.argsort(x, kind="stable") for x in (mine, theirs))
            starts = [np.searchsorted(x[y], np.arange(len(known) + 1)) for x, y in ((mine, by_anchor), (theirs, by_row))]
            for label in range(len(known)):
                who, cols = (y[s[label]:s[label + 1]] for y, s in ((by_anchor, starts[0]), (by_row, starts[1])))
                for i in range(0, len(who) if len(cols) else 0, TILE[0]):
                    at = who[i:i + TILE[0]]
                    s = scores(a[at], b[cols])
                    r, c = best(s, anchors.ids[at][:, None] != rows.ids[cols][None, :], k)
                    yield pa.RecordBatch.from_arrays([pa.array(anchors.ids[at][r]), pa.array(rows.ids[cols][c]), pa.array(s[r, c])],
                                                     names=["anchor_id", "positive_id", "positive_score"])
    return run


def _negatives(k: int, part: tuple[int, int]) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for anchors, rows in tiles(batches):
            known = anchors.labels.unique()
            mine, theirs = known.get_indexer(anchors.labels), known.get_indexer(rows.labels)
            a, b = same_width(anchors.vectors, rows.vectors)
            found = anchors.batch.column("found")
            sizes = found.value_lengths().to_numpy(zero_copy_only=False)
            flat = found.flatten()
            who = np.repeat(np.arange(len(sizes)), sizes)
            high = flat.field("positive_score").to_numpy(zero_copy_only=False)
            # The least integer of at least part[0] / part[1] of a score, without passing 64 bits.
            whole, rest = high // part[1], high % part[1]
            low = whole * part[0] - (-rest * part[0]) // part[1]
            begin = np.cumsum(sizes) - sizes
            for i in range(0, len(mine), TILE[0]):
                at = np.arange(i, min(i + TILE[0], len(mine)))
                s = scores(a[at], b)
                first, last = begin[at[0]], begin[at[-1]] + sizes[at[-1]]
                lowest, highest = np.full(len(at), np.iinfo(np.int64).max), np.full(len(at), np.iinfo(np.int64).min)
                np.minimum.at(lowest, who[first:last] - i, low[first:last])
                np.maximum.at(highest, who[first:last] - i, high[first:last])
                r, c = np.nonzero((s >= lowest[:, None]) & (s <= highest[:, None]) & (mine[at][:, None] != theirs[None, :]))
                v = s[r, c]
                for slot in range(int(sizes.max()) if len(sizes) else 0):
                    has = np.flatnonzero(sizes[at] > slot)
                    bounds = np.full((2, len(at)), 1)
                    bounds[1] = 0
                    bounds[:, has] = low[begin[at[has]] + slot], high[begin[at[has]] + slot]
                    inside = np.flatnonzero((v >= bounds[0][r]) & (v <= bounds[1][r]))
                    inside = inside[first_of_each(r[inside], c[inside], v[inside], k)]
                    if len(inside):
                        source = begin[at[r[inside]]] + slot
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(anchors.ids[at[r[inside]]]), flat.field("positive_id").take(pa.array(source)), pa.array(high[source]),
                             pa.array(rows.ids[c[inside]]), pa.array(v[inside])],
                            names=["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])
    return run


def mine(rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         positives: int = 5, negatives: int = 5, part: tuple[int, int] = (4, 5)) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    A component x counts as floor(256 x); a score is the integer inner product. An anchor's
    positives are its ``positives`` best other rows of the same label; to each belong the
    ``negatives`` best rows of other labels whose score is at most the positive's, and at least
    ``part`` of it. Ties go to the smaller id.

    ``is_anchor`` is a condition on ``id``. Rows with a null id, label or vector, or with a null or
    non-finite component, take no part, nor do rows so long that 64 bits may not hold their
    scores (a squared length of 2^62 or more, after scaling). Of rows that repeat an id the first
    by label, then vector, counts. Vectors may differ in length; a shorter one ends in zeros. An
    anchor without positives, or a positive without negatives, gives no rows, as does an empty
    table. Other columns aren't read.
    """
    kind = rows.schema[vector_col].dataType.elementType
    label = rows.schema[label_col].dataType
    given = rows.select(F.col(id_col).cast("long").alias("id"),
                        F.col(label_col).cast("long" if isinstance(label, T.IntegralType) else "string").alias("label"),
                        F.col(vector_col).cast("array<float>" if isinstance(kind, T.FloatType) else "array<double>").alias("v"))
    infinity = F.lit(float("inf"))
    given = (given.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull())
             .where(F.forall("v", lambda x: x.isNotNull() & (x > -infinity) & (x < infinity)))
             .where(F.aggregate("v", F.lit(0.0), lambda s, x: s + F.pow(F.floor(SCALE * x.cast("double")).cast("double"), F.lit(2.0))) < LONGEST))
    n = given.agg(F.count("*"), F.count_if(is_anchor)).first()
    anchors = given.where(is_anchor)

    order = W.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    found = (_cells(given, anchors, n[0], n[1], {}).mapInArrow(_positives(positives), "anchor_id long, positive_id long, positive_score long")
             .withColumn("slot", F.row_number().over(order)).where(F.col("slot") <= positives))
    found = settle(found.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("slot", "positive_id", "positive_score"))).alias("found")), "positives")
    asked = anchors.join(found.withColumnRenamed("anchor_id", "id"), "id")

    order = W.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (_cells(given, asked, n[0], n[1], {"found": found.schema["found"].dataType.simpleString()})
            .mapInArrow(_negatives(negatives, part), "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
