"""Near-duplicate documents: min-hash bands, sequential Bayesian verification, exact confirmation.

A document is the set of its distinct word shingles. Bands of its min-hash signature are bucket
keys. Candidates of a bucket are verified batch by batch: after each batch of signature values
the posterior of their similarity is bounded, and a pair goes as soon as the chance that it is
similar enough falls below the chosen miss probability. What is left is confirmed on the full
sets.

Copies of a text are one set. In a bucket every set is first compared with the least one, so a
group of near copies of any size costs as many comparisons as it has sets. Then sets of
different components are paired, in buckets of a few; the sets of fuller buckets that several
components share go to an exact join of their rarest shingles (``rare``). No candidate is
dropped.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import rare
from .common import settle, string_column, texts, tidied, words
from .components import components

SHINGLE, PERCENT = 4, 80
#: A pair of 80 % similarity shares no band with a chance of (1 - 0.8^4)^32 = 5e-8.
BANDS, BAND = 32, 4
#: Signature values that are compared at once.
BATCH = 16
#: Chance, at each look, to lose a pair that is similar enough.
MISS = 1e-9
#: Sets of a bucket that are paired there.
FEW = 12
SALTS = 64
#: Shingles whose hashes are worked on at once, and that sets under verification may hold together.
AT_ONCE, HELD = 1 << 16, 2_000_000
_MULTIPLY, _SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(31)


# ---- sets and signatures --------------------------------------------------------------------

class Shingler:
    """Texts to sorted arrays of distinct 64-bit shingle hashes; remembers words it has met."""

    def __init__(self, size: int = SHINGLE):
        self.size, self.seen = size, {}

    def __call__(self, text: str) -> np.ndarray:
        found = words(text)
        if not found:
            return np.zeros(0, np.uint64)
        if len(self.seen) > 300_000:
            self.seen.clear()
        for w in set(found).difference(self.seen):
            self.seen[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(self.seen.__getitem__, found), np.uint64, len(found))
        k = min(self.size, len(h))
        out = np.full(len(h) - k + 1, k, np.uint64)
        for i in range(k):
            out = (out + h[i:len(h) - k + 1 + i]) * _MULTIPLY
            out ^= out >> _SHIFT
        return np.unique(out)


def shingles(text: str, size: int = SHINGLE) -> set:
    """The shingles themselves."""
    found = words(text)
    if len(found) < size:
        return {tuple(found)} if found else set()
    return set(zip(*(found[i:] for i in range(size)), strict=False))


def similar(a: set, b: set, percent: int = PERCENT) -> bool:
    both = len(a & b)
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def hashes(k: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_13)
    draw = rng.integers(0, 1 << 63, (2, k), dtype=np.uint64)
    return draw[0] * np.uint64(2) + np.uint64(1), draw[1]


def signatures(sets: list[np.ndarray], k: int = BANDS * BAND) -> np.ndarray:
    """A row of k 32-bit min-hashes for each set; all ones for an empty one."""
    multiply, mask = hashes(k)
    out = np.full((len(sets), k), 0xFFFFFFFF, np.uint32)
    sizes = np.array([len(s) for s in sets], np.int64)
    ends = np.cumsum(sizes)
    begin = 0
    while begin < len(sets):
        last = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + AT_ONCE, "right")))
        some = np.flatnonzero(sizes[begin:last]) + begin
        if len(some):
            flat = np.concatenate([sets[i] for i in some])
            starts = np.concatenate(([0], np.cumsum(sizes[some])[:-1]))
            for j in range(k):
                x = flat ^ mask[j]
                x *= multiply[j]
                out[some, j] = np.minimum.reduceat(x, starts) >> np.uint64(32)
        begin = last
    return out


def least_matches(n: int, percent: int, miss: float) -> int:
    """Matches among n signature values below which a similarity of ``percent`` is less likely than
    ``miss``: with a uniform prior the posterior is Beta(m + 1, n - m + 1), whose mass from t on is
    the chance of at most m hits in n + 1 draws of probability t."""
    t, total = percent / 100, 0.0
    for m in range(n + 1):
        total += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        if total >= miss:
            return m
    return n


def survivors(a: np.ndarray, b: np.ndarray, percent: int = PERCENT, miss: float = MISS) -> np.ndarray:
    """Places of the pairs of signature rows that no batch rules out."""
    alive, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
    for at in range(0, a.shape[1], BATCH):
        matches = matches + (a[alive, at:at + BATCH] == b[alive, at:at + BATCH]).sum(axis=1)
        ok = matches >= least_matches(min(at + BATCH, a.shape[1]), percent, miss)
        alive, matches = alive[ok], matches[ok]
    return alive


# ---- steps ----------------------------------------------------------------------------------

def _sets(docs: DataFrame) -> DataFrame:
    """Of each document the size of its set, a 128-bit digest of it and its signature."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = Shingler()
        for batch in batches:
            sets = [hashed(t) for t in string_column(batch, "text")]
            digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()),
                                              pa.array([row.tobytes() for row in signatures(sets)], pa.binary())], names=["doc_id", "n", "digest", "signature"])

    return docs.mapInArrow(run, "doc_id long, n long, digest binary, signature binary")


def _least(keys: DataFrame) -> DataFrame:
    """``a, b``: each set with the least of every bucket (``key, id``) it is in. Minima are taken
    before the shuffle; the join back can be split at a hot key."""
    least = keys.groupBy("key").agg(F.min("id").alias("b"), F.max("id").alias("other")).where("b <> other").select("key", "b")
    return keys.join(least, "key").where("id <> b").select(F.col("id").alias("a"), "b").distinct()


def _possible(pairs: DataFrame, brief: DataFrame, percent: int, miss: float) -> DataFrame:
    """The pairs that neither sizes nor signatures in ``brief`` (doc_id, n, signature) rule out, stored."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint32).reshape(batch.num_rows, -1) for i in (2, 3))
            at = pa.array(survivors(a, b, percent, miss))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], names=["a", "b"])

    rows = (pairs.join(brief.toDF("a", "na", "sa"), "a").join(brief.toDF("b", "nb", "sb"), "b")
            .where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).select("a", "b", "sa", "sb"))
    return settle(rows.mapInArrow(run, "a long, b long"), "possible")


def _confirmed(pairs: DataFrame, own: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose full sets are similar, stored."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[int, list[tuple[str, set]]] = {}
        held = 0

        def of(i: int, text: str) -> set:
            nonlocal held
            for t, s in met.get(i, ()):
                if t == text:
                    return s
            if held > HELD:
                met.clear()
                held = 0
            s = shingles(text, size)
            met.setdefault(i, []).append((text, s))
            held += len(s)
            return s

        for batch in batches:
            keep = [similar(of(i, x), of(j, y), percent) for i, j, x, y in
                    zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    held = settle(own.join(ids, "doc_id", "left_semi"), "held")
    both = (pairs.join(held.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
            .join(held.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b"))
    return settle(both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long").distinct(), "confirmed")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", miss: float = MISS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``: the size of its set,
    the least id reachable by links of a similarity of 80 % or more, and whether that is itself.

    Words are lower-cased (A-Z) and parted by ASCII white space; a text of fewer than four words
    is one shingle, one without words is empty and linked with nothing. A null text is an empty
    one. A row without an id links with nothing, has no component and is kept. Rows that repeat
    an id are one document, linked by any of its texts; all are kept or none. An empty table
    gives none; other columns aren't read.

    A pair of exactly 80 % is missed with a chance of 5e-8 by the bands, and of about ``miss`` at each
    of eight looks at its signatures; more similar ones by far less. No pair is linked that isn't
    similar.
    """
    return tidied(lambda: _groups(docs, id_col, text_col, miss), docs.sparkSession)


def _groups(docs: DataFrame, id_col: str, text_col: str, miss: float) -> DataFrame:
    given = texts(docs, id_col, text_col)
    sets = settle(_sets(given), "sets")
    named = sets.where("doc_id is not null and n > 0")

    # Copies: the least id of each digest, met under as many keys as its copies have salts.
    salt = F.pmod(F.xxhash64(F.lit("copy"), "doc_id"), F.lit(SALTS)).cast("int")
    first = (named.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), salt)).alias("salts"))
             .where("first <> last")
             .select("digest", "first", F.explode(F.filter(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda i: F.call_function("getbit", F.col("salts"), i) == 1)).alias("salt")))
    copies = settle(named.select("doc_id", "digest", salt.alias("salt")).join(first, ["digest", "salt"]).where("doc_id <> first").select("doc_id", "digest", "first").distinct(), "copies")
    # A set stands under the first id that holds it; an id with several texts may stand for some of them.
    own_sets = named.join(copies.select("doc_id", "digest"), ["doc_id", "digest"], "left_anti")
    brief = settle(own_sets.select("doc_id", "n", "signature").distinct(), "brief")
    own = given.join(brief.select("doc_id").distinct(), "doc_id", "left_semi")

    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, F.substring("signature", i * 4 * BAND + 1, F.lit(4 * BAND))))
    keys = settle(brief.select(F.col("doc_id").alias("id"), F.explode(bands).alias("key")).distinct(), "bands")
    group = settle(components(_confirmed(_possible(_least(keys), brief, PERCENT, miss), own, SHINGLE, PERCENT)), "group")

    # What is open: buckets with sets of several components.
    member = keys.join(group, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    counted = member.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("m")).where("x <> y").select("key", "m")
    member = settle(member.join(counted, "key"), "members")
    few = member.where(F.col("m") <= FEW).groupBy("key").agg(F.collect_set(F.struct(F.col("component").alias("c"), "id")).alias("s"))
    each = F.expr("""filter(flatten(transform(s, (x, i) -> transform(slice(s, i + 2, size(s)),
        y -> struct(least(x.id, y.id) as a, greatest(x.id, y.id) as b, x.c <> y.c as apart)))), p -> p.apart)""")
    some = few.select(F.explode(each).alias("p")).select("p.a", "p.b").distinct()
    crowd = member.where(F.col("m") > FEW).groupBy(F.col("id").alias("doc_id")).agg(F.first("component").alias("component"))
    crowd = settle(own.join(crowd, "doc_id").join(brief.select("doc_id", "n").distinct(), "doc_id").select("doc_id", "n", "text", "component"), "crowd")
    still, enough = rare.open_sets(crowd, Shingler, PERCENT)
    rest = rare.pairs(crowd, still, enough, Shingler, PERCENT)
    across = _confirmed(_possible(some.unionByName(rest).distinct(), brief, PERCENT, miss), own, SHINGLE, PERCENT)

    # What the first links gave are stars already.
    links = (group.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(across)
             .unionByName(copies.select(F.col("doc_id").alias("a"), F.col("first").alias("b"))))
    found = components(links).select(F.col("id").alias("doc_id"), "component")
    return (sets.select("doc_id", F.col("n").alias("n_shingles")).join(found, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
