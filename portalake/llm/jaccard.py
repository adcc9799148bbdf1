"""N-gram Jaccard join: universe-partition pigeonhole.

A text is the set of its distinct word shingles; two texts link at a Jaccard similarity of at
least 3/4. Sets of sizes l <= s that link differ in at most H = (l + s) / 7 tokens. All tokens
are hashed into m segments, m by the band of sizes; a set's part in a segment is a segment
subset. Of a linked pair at most H segments differ, so any H + 1 subsets of one set that the
other would share (its credits) are enough to find the pair. Sets of up to six tokens are one
segment, with its one-deletion neighbourhood; sets of up to fifteen have a segment for each
token; larger ones have segments of two to three tokens.

Only components are asked for, so sets are first compared with the least one of those they
share a min-hash with: groups of near copies, of any size, are then known in time that grows
with their sizes, and the index pairs only sets of different components.

The allocation is by cost: empty subsets tell nothing and are not indexed, and a subset that
more than a few sets hold is not paired as long as the set has credits left without it. Sets
that run short (made of passages that many texts share) go on to the finest partition, a
segment for each token, in which up to three quarters of a set may be passed over. What is
short even there is contracted by more min-hashes, and then paired by its rarest tokens that
several components share. No candidate is dropped: each level passes on exactly what it can't
decide.

Every pair is verified on the shingles themselves. Copies are one set, under the least id.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import rare
from .common import settle, string_column, texts, tidied, words
from .components import components

SHINGLE, PERCENT = 5, 75
WHOLE, SINGLE = 6, 15       # largest sizes of the first two kinds of bands
#: Segments of a band from L to 2L: this times L.
SEGMENTS = 0.7
#: A subset that more sets hold is crowded.
CROWD = 12
KEYS_AT_ONCE = 1_000_000
SENT_ROWS = 1_000_000
#: Shingles that sets under verification hold together, a pair's own aside.
HELD = 500_000
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Texts to sorted arrays of distinct 64-bit shingle hashes; remembers words it has met."""

    def __init__(self):
        self.seen: dict[bytes, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        found = words(text)
        if not found:
            return np.zeros(0, np.uint64)
        seen, digest = self.seen, xxhash.xxh3_64_intdigest
        if len(seen) > 300_000:
            seen.clear()
        for w in set(found).difference(seen):
            seen[w] = digest(w)
        h = np.fromiter(map(seen.__getitem__, found), np.uint64, len(found))
        k = min(SHINGLE, len(h))
        out = np.full(len(h) - k + 1, k, np.uint64)
        for i in range(k):
            out = (out ^ h[i:len(h) - k + 1 + i]) * _M1
            out ^= out >> np.uint64(29)
        return np.unique(mix(out))


def exact(text: str) -> set:
    """The shingles themselves."""
    found = words(text)
    if len(found) < SHINGLE:
        return {tuple(found)} if found else set()
    return set(zip(*(found[i:] for i in range(SHINGLE)), strict=False))


def linked(a: set, b: set) -> bool:
    both = len(a & b)
    return 100 * both >= 75 * (len(a) + len(b) - both) and both > 0


# ---- segments -------------------------------------------------------------------------------

def band(n: np.ndarray) -> np.ndarray:
    """0 for sizes up to 6, 1 up to 15, then one for each doubling."""
    return np.where(n <= WHOLE, 0, np.where(n <= SINGLE, 1, np.floor(np.log2(np.maximum(n, 16))).astype(np.int64) - 2))


def begins(b: np.ndarray) -> np.ndarray:
    """The least size of a band."""
    return np.where(b <= 0, 1, np.where(b == 1, WHOLE + 1, 1 << (np.maximum(b, 2) + 2)))


def overlap(n: np.ndarray) -> np.ndarray:
    """Tokens that a set shares with any set it links with, at least."""
    return -(-3 * n // 4)


def needed(n: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Credits a set of size n needs in band b, its own or the next: all in the first band, else
    one more than it can differ from a set of that band."""
    largest = np.minimum(4 * n // 3, begins(b + 1) - 1)
    return np.where(b == 0, n + 1, np.where(b == 1, n - overlap(n) + 1, (n + largest) // 7 + 1))


def subset_keys(tokens: np.ndarray, sizes: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the non-empty segment subsets of sets, laid end to end, each in its band; and the
    set of each key. The band is in a key's last six bits."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    bands = b[owner]
    content = mix(tokens + _M3)
    keys, owners = [], []

    def add(code: np.ndarray, who: np.ndarray) -> None:
        keys.append((mix(code) & ~np.uint64(63)) | b[who].astype(np.uint64))
        owners.append(who)

    few = bands == 0
    if few.any():
        total = np.zeros(len(sizes), np.uint64)
        np.add.at(total, owner[few], content[few])
        whole = np.flatnonzero((b == 0) & (sizes > 0))
        add(total[whole], whole)
        deleted = few & (sizes[owner] > 1)
        add(total[owner[deleted]] - content[deleted], owner[deleted])
    single = bands == 1
    if single.any():
        add(content[single] ^ _M1, owner[single])
    many = bands > 1
    if many.any():
        who, c = owner[many], content[many]
        m = np.maximum(1, SEGMENTS * begins(bands[many])).astype(np.uint64)
        segment = (mix(tokens[many] ^ _M2) % m).astype(np.int64)
        code = who * (int(m.max()) + 1) + segment
        order = np.argsort(code, kind="stable")
        code, c, who, segment = code[order], c[order], who[order], segment[order]
        first = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
        add(np.add.reduceat(c, first) + (segment[first].astype(np.uint64) + np.uint64(1)) * _M1, who[first])
    return (np.concatenate(keys), np.concatenate(owners)) if keys else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def upward(n: np.ndarray) -> np.ndarray:
    """Whether a set may link with one of the next band."""
    return begins(band(n) + 1) <= 4 * n // 3


def set_keys(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the sets in their own band, and in the next where they may link with one there."""
    n = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    own = subset_keys(flat, n, band(n))
    up = upward(n) & (n > 0)
    if not up.any():
        return own
    at = np.flatnonzero(up)
    keys, who = subset_keys(np.concatenate([sets[i] for i in at]), n[at], band(n[at]) + 1)
    return np.concatenate([own[0], keys]), np.concatenate([own[1], at[who]])


def token_keys(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The finest partition: a key for each token."""
    n = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), np.repeat(np.arange(len(sets)), n)


def _index(docs: DataFrame, keys_of) -> DataFrame:
    """``key, id`` of the texts in ``docs`` (doc_id, text).

    Keys that many sets of a task hold get a number of the task mixed in, so that a crowd of any
    size is spread over as many groups as tasks; in their own group stand a few rows of null
    ids in place of it, enough to make it a crowd.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, keys, ids, size = Shingler(), [], [], 0

        def out() -> pa.RecordBatch:
            k, i = np.concatenate(keys), np.concatenate(ids)
            order = np.argsort(k, kind="stable")
            k, i = k[order], i[order]
            first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
            times = np.diff(np.append(first, len(k)))
            crowds = k[first[times > CROWD]]
            inside = np.repeat(times, times) > CROWD
            salt = mix(np.array([i[0]], np.int64).view(np.uint64) + _M2)[0]
            k[inside] = (mix(k[inside] ^ salt) & ~np.uint64(63)) | (k[inside] & np.uint64(63))
            k = np.concatenate([k, np.repeat(crowds, CROWD + 1)])
            i = np.concatenate([i, np.zeros(len(crowds) * (CROWD + 1), np.int64)])
            nobody = np.arange(len(i)) >= len(inside)
            return pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(i, mask=nobody)], names=["key", "id"])

        for batch in batches:
            doc = batch.column(0).to_numpy()
            found, who = keys_of([shingles(t) for t in string_column(batch, "text")])
            keys.append(found)
            ids.append(doc[who])
            size += len(found)
            if size >= KEYS_AT_ONCE:
                yield out()
                keys, ids, size = [], [], 0
        if size:
            yield out()

    return docs.select("doc_id", "text").mapInArrow(run, "key long, id long")


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= SENT_ROWS else df


def _shared(index: DataFrame, what: str) -> DataFrame:
    """``key, id, crowded`` of the keys that several sets hold, stored."""
    counted = index.withColumn("n", F.count("*").over(W.partitionBy("key")))
    return settle(counted.where("n > 1 and id is not null").select("key", "id", (F.col("n") > CROWD).alias("crowded")), what)


def _pairs(shared: DataFrame, group: DataFrame) -> DataFrame:
    """``a < b`` of the sets that share a key which is not crowded, at most CROWD to a key, and are
    not in one component of ``group``."""
    rows = (shared.where(~F.col("crowded")).select("key", "id").join(_small(group, group.count()), "id", "left")
            .groupBy("key").agg(F.collect_set(F.struct(F.coalesce("component", "id").alias("g"), "id")).alias("m"))
            .where(F.size("m") > 1))
    each = F.expr("""filter(flatten(transform(m, (x, i) -> transform(slice(m, i + 2, size(m)),
        y -> struct(least(x.id, y.id) as a, greatest(x.id, y.id) as b, x.g <> y.g as apart)))), p -> p.apart)""")
    return rows.select(F.explode_outer(each).alias("p")).where("p is not null").select("p.a", "p.b").distinct()


# ---- steps ----------------------------------------------------------------------------------

SETS = ("doc_id long, n long, d1 long, d2 long, own long, own_needed long, up long, up_needed long, sketch binary, "
        "mins array<bigint>")
#: Min-hashes of a set.
MINS = 6


def min_hashes(tokens: np.ndarray, k: int, seed: int) -> list[int]:
    """Least values of a set's tokens under k hashes; none of an empty set."""
    if not len(tokens):
        return []
    salts = mix(np.arange(seed * 1000 + 1, seed * 1000 + k + 1, dtype=np.uint64))
    return [int((mix1(tokens ^ x)).min().view(np.int64)) for x in salts]


def mix1(x: np.ndarray) -> np.ndarray:
    x = x * _M2
    return (x ^ (x >> np.uint64(31))) * _M3


def _sets(docs: DataFrame) -> DataFrame:
    """Of each document the size of its set, a 128-bit digest of it, credits and need by band, a
    sketch and min-hashes."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler()
        for batch in batches:
            sets = [shingles(t) for t in string_column(batch, "text")]
            n = np.array([len(s) for s in sets], np.int64)
            digests = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
            keys, who = set_keys(sets)
            at_home = (keys & np.uint64(63)).astype(np.int64) == band(n)[who]
            up = upward(n) & (n > 0)
            columns = [n, [(d >> 64) - (1 << 63) for d in digests], [(d & (2**64 - 1)) - (1 << 63) for d in digests],
                       np.bincount(who[at_home], minlength=len(n)), needed(n, band(n)),
                       np.bincount(who[~at_home], minlength=len(n)), np.where(up, needed(n, band(n) + 1), 0)]
            lows = pa.array([min_hashes(s, MINS, 0) for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns), pa.array([sketch(s) for s in sets], pa.binary()), lows],
                                             names=[x.split()[0] for x in SETS.split(", ")])

    return docs.mapInArrow(run, SETS)


def sketch(tokens: np.ndarray, cells: int | None = None) -> bytes:
    """Parities of a set's tokens in as many cells as it has tokens, rounded up to a power of 2."""
    cells = cells or (max(64, 1 << (len(tokens) - 1).bit_length()) if len(tokens) else 64)
    at = (mix(tokens + _M1) & np.uint64(cells - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=cells) & 1).astype(np.uint8)).tobytes()


def differ(a: bytes, b: bytes) -> int:
    """Tokens in which two sets differ, at least: each changes one cell's parity."""
    if len(a) < len(b):
        a, b = b, a
    while len(a) > len(b):
        half = len(a) // 2
        a = (int.from_bytes(a[:half]) ^ int.from_bytes(a[half:])).to_bytes(half)
    return (int.from_bytes(a) ^ int.from_bytes(b)).bit_count()


def _close(pairs: DataFrame, brief: DataFrame) -> DataFrame:
    """The pairs that sizes and sketches in ``brief`` (doc_id, n, sketch) can't rule out, stored."""
    def near(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [7 * differ(x, y) <= m + n for m, n, x, y in zip(*(batch.column(i).to_pylist() for i in range(2, 6)), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    rows = (pairs.join(brief.toDF("a", "na", "sa"), "a").join(brief.toDF("b", "nb", "sb"), "b")
            .where(4 * F.least("na", "nb") >= 3 * F.greatest("na", "nb")).select("a", "b", "na", "nb", "sa", "sb"))
    return settle(rows.mapInArrow(near, "a long, b long"), "close")


def _verified(close: DataFrame, held: DataFrame) -> DataFrame:
    """The pairs of which the texts in ``held`` (doc_id, text) link, stored."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            met: dict[str, set] = {}
            keep, held = [], 0
            for x, y in zip(string_column(batch, "text_a"), string_column(batch, "text_b"), strict=True):
                if held > HELD:
                    met.clear()
                    held = 0
                for t in (x, y):
                    if t not in met:
                        met[t] = exact(t)
                        held += len(met[t])
                keep.append(linked(met[x], met[y]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = (close.join(held.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
            .join(held.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b"))
    return settle(both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long").distinct(), "links")


def _ends(*pairs: DataFrame) -> DataFrame:
    out = None
    for p in pairs:
        for c in ("a", "b"):
            one = p.select(F.col(c).alias("doc_id"))
            out = one if out is None else out.union(one)
    return out


def _texts_of(own: DataFrame, ids: DataFrame) -> DataFrame:
    """``doc_id, text`` of the ids, stored."""
    ids = settle(ids.distinct(), "wanted")
    return settle(own.join(_small(ids, ids.count()), "doc_id").select("doc_id", "text"), "held")


def _to_least(signs: DataFrame) -> DataFrame:
    """``a, b``: each set (``id``) with the least of those it shares a min-hash (``slot, low``) with.
    Minima are taken before the shuffle; the join back can be split at a hot one."""
    least = signs.groupBy("slot", "low").agg(F.min("id").alias("b"))
    return signs.join(least, ["slot", "low"]).where("id <> b").select(F.col("id").alias("a"), "b").distinct()


def _short(sets: DataFrame, shared: DataFrame) -> DataFrame:
    """Sets whose credits, without the crowded ones, are fewer than needed in a band."""
    crowded = (shared.where("crowded").groupBy("id", (F.col("key").bitwiseAND(63)).alias("b")).agg(F.count("*").alias("k"))
               .groupBy("id").agg(F.min(F.struct("b", "k")).alias("low"), F.max(F.struct("b", "k")).alias("high"), F.count("*").alias("bands")))
    home = F.when(F.col("n") <= WHOLE, 0).when(F.col("n") <= SINGLE, 1).otherwise(F.length(F.bin("n")) - 3)
    lost = lambda b: F.coalesce(F.when(F.col("low.b") == b, F.col("low.k")), F.when(F.col("high.b") == b, F.col("high.k")), F.lit(0))
    rows = sets.where("n > 0").join(crowded, sets["doc_id"] == crowded["id"], "left")
    return rows.where((F.col("own") - lost(home) < F.when(F.col("n") == 1, 1).otherwise(F.col("own_needed")))
                      | (F.col("up") - lost(home + 1) < F.col("up_needed"))).select("doc_id")


def _signatures(docs: DataFrame, k: int, seed: int) -> DataFrame:
    """``slot, low, id``: k min-hashes of each text, under other hashes than MINS."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler()
        for batch in batches:
            low = np.array([min_hashes(shingles(t), k, seed + 1) for t in string_column(batch, "text")], np.int64).reshape(-1)
            yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(k), batch.num_rows), pa.int32()), pa.array(low),
                                              pa.array(np.repeat(batch.column(0).to_numpy(), k))], names=["slot", "low", "id"])

    return docs.select("doc_id", "text").mapInArrow(run, "slot int, low long, id long")


def _contracted(crowd: DataFrame, links: DataFrame, rounds: int = 3, k: int = 6) -> DataFrame:
    """Links among the sets in ``crowd`` (doc_id, n, sketch, text), enough for their components.

    A round compares each set with the least of those of its min-hashes, and drops the sets that
    can't link beyond their component any more: those of whose tokens fewer than they would have
    to share are held by two components. What remains after the rounds is paired by its rarest
    such tokens (``rare``), as many as a linked pair can't do without; a pair comes out of that
    join only if sizes and sketches allow it, and about once.
    """
    for r in range(rounds + 1):
        if crowd.isEmpty():
            return links
        brief = crowd.select("doc_id", "n", "sketch")
        if r < rounds:
            near = _to_least(settle(_signatures(crowd, k, r), "signatures"))
            links = settle(links.unionByName(_verified(_close(near, brief), crowd)), "links")
        group = components(links)
        marked = (crowd.join(group.withColumnRenamed("id", "doc_id"), "doc_id", "left")
                  .select("doc_id", "n", "text", F.coalesce("component", "doc_id").alias("component")))
        still, enough = rare.open_sets(marked, Shingler, PERCENT)
        if r == rounds:
            pairs = rare.pairs(marked, still, enough, Shingler, PERCENT)
            return links.unionByName(_verified(_close(pairs, brief), crowd))
        crowd = settle(crowd.join(enough.select(F.col("id").alias("doc_id")), "doc_id", "left_semi"), "crowd")
    return links


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id``, the least id reachable by
    links.

    Words are lower-cased (A-Z) and parted by ASCII white space; a text of fewer than five words
    is one shingle, one without words is empty and linked with nothing. A null text is an empty
    one. A row without an id links with nothing and has no component. Rows that repeat an id are
    one document, linked by any of its texts. An empty table gives none; other columns aren't
    read.
    """
    return tidied(lambda: _join(docs, id_col, text_col), docs.sparkSession)


def _join(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    given = texts(docs, id_col, text_col)
    sets = settle(_sets(given), "sets")
    named = sets.where("doc_id is not null and n > 0")
    first = named.groupBy("d1", "d2").agg(F.min("doc_id").alias("first"))
    marked = settle(named.join(first, ["d1", "d2"]).groupBy("doc_id")
                    .agg(F.collect_set(F.when(F.col("doc_id") != F.col("first"), F.col("first"))).alias("firsts"), F.bool_or(F.col("doc_id") == F.col("first")).alias("own"))
                    .where(F.size("firsts") > 0), "copies")
    copies = marked.select("doc_id", F.explode("firsts").alias("first"))
    # Only the first of each group of copies is indexed. An id with several texts is left out if
    # all of them are copies.
    ids = marked.where(~F.col("own")).select("doc_id")
    own = given.where("doc_id is not null").join(_small(ids, ids.count()), "doc_id", "left_anti")
    brief = settle(named.join(_small(ids, ids.count()), "doc_id", "left_anti").select("doc_id", "n", "sketch", "mins"), "brief")
    signs = brief.select(F.col("doc_id").alias("id"), F.posexplode("mins").alias("slot", "low"))
    brief = brief.select("doc_id", "n", "sketch")
    close = _close(_to_least(signs), brief)
    links = _verified(close, _texts_of(own, _ends(close)))
    group = settle(components(links), "group")

    shared = _shared(_index(own, set_keys), "subsets")
    close = _close(_pairs(shared, group), brief)
    short = settle(_short(sets.join(ids, "doc_id", "left_anti"), shared), "short")
    held = _texts_of(own, _ends(close).union(short))
    links = links.unionByName(_verified(close, held))

    left = held.join(short, "doc_id", "left_semi")
    shared = _shared(_index(left, token_keys), "tokens")
    links = links.unionByName(_verified(_close(_pairs(shared, group), brief), held))
    lost = shared.where("crowded").groupBy("id").agg(F.count("*").alias("k")).withColumnRenamed("id", "doc_id")
    crowd = settle(left.join(lost, "doc_id").join(brief, "doc_id").where(F.col("k") >= F.ceil(F.col("n") * 0.75))
                   .select("doc_id", "n", "sketch", "text"), "crowd")
    links = _contracted(crowd, settle(links, "links"))

    links = links.unionByName(copies.select(F.col("doc_id").alias("a"), F.col("first").alias("b")))
    found = components(links)
    return (sets.select("doc_id", F.col("n").alias("n_shingles")).join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))
