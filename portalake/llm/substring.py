"""Substring de-duplication by hashing units of text.

A text is cut into units (clauses, lines or paragraphs) and each is normalised. What is hashed
is a unit, or, if it has too few words, the unit with as many of the next ones as it takes: a
short clause that two texts share by chance is no repeat. By ``passage``, the default, whole lines
are hashed, each on its own whatever its words; very short ones are repeats only if many
documents hold them. And runs of
twelve words are hashed at the beginning and the end of every sentence, and wherever the words
themselves say so (winnowing), so that a passage is found wherever it stands, whatever marks or
line ends stand in it or don't. For every digest the earliest occurrence, by document id and then
by place, is kept; all later ones are taken out. What was taken out is reported with its offsets
in the original text.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle, string_column

#: What stands between two units. Patterns begin with white space, as a search tries no other character then.
BETWEEN = {"clause": re.compile(r"(?<=[.!?,;:])[ \t]+|\s*\n\s*"), "line": re.compile(r"\s(?:(?<=\n)|\s*\n)\s*"),
           "paragraph": re.compile(r"\s*\n[ \t]*\n\s*")}
BETWEEN["passage"] = BETWEEN["line"]
#: What stands between two sentences, or lines.
SENTENCE = re.compile(r"\s(?:(?<=[.!?][ \t])[ \t]*|(?:(?<=\n)|\s*\n)\s*)")
SPACE = re.compile(r"\s*")
LAST = 2**63 - 1
#: A line of fewer characters is a repeat only if so many documents hold it.
SHORT, COMMON = 12, 10
#: Words of a run, and starts of runs of which one is hashed: runs overlap where many follow each
#: other, and texts that share RUN + CHOICE - 1 words share a hashed run at most CHOICE - 1 words
#: from either end.
RUN = CHOICE = 12
#: Words of texts hashed at once, about.
WORDS_HELD = 50_000


def _kinds() -> np.ndarray:
    """0 for what stands in words, 1 for white space, 2 for scripts without spaces, in which each
    character is a word."""
    out = np.zeros(0x110000, np.uint8)
    out[[i for i in range(0x3001) if chr(i).isspace()]] = 1
    for a, b in ((0xE00, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3001, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)):
        out[a:b + 1] = 2
    return out


KINDS = _kinds()


def spans(text: str, unit: str) -> list[tuple[int, int]]:
    """Start and end of each unit; white space between units belongs to none."""
    out, start = [], 0
    for m in BETWEEN[unit].finditer(text):
        if m.start() > start:
            out.append((start, m.start()))
        start = m.end()
    if start < len(text):
        out.append((start, len(text)))
    return out


def normal(unit: str) -> str:
    """As units are compared: lower case, white space as single spaces."""
    return " ".join(unit.lower().split())


def windows(units: list[str], least_words: int) -> list[tuple[int, int]]:
    """First and last unit of each window: from every unit on, as few as hold enough words. None
    begins where the text has not enough left. ``units`` are normal."""
    sizes, out, last, held = [u.count(" ") + 1 if u else 0 for u in units], [], -1, 0
    for i in range(len(units)):
        while held < least_words and last + 1 < len(units):
            last += 1
            held += sizes[last]
        if held < least_words:
            break
        out.append((i, last))
        held -= sizes[i]
    return out


def normal_units(text: str, unit: str) -> tuple[list[tuple[int, int]], list[str]]:
    found = spans(text, unit)
    return found, [normal(text[a:b]) for a, b in found]


def cut(text: str, repeats: Iterable[int], unit: str, least_words: int) -> tuple[str, list[tuple[int, int]], int, int]:
    """The text without the windows that begin at the units ``repeats``, the offsets of what was
    cut, the units and the units removed. A run that is cut takes the white space after it
    along, at the end of the text that before it."""
    found, units = normal_units(text, unit)
    ends = dict(windows(units, least_words))
    gone = np.zeros(len(found), bool)
    for i in repeats:
        gone[i:ends[i] + 1] = True
    edges = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False]))))
    parts, offsets, at = [], [], 0
    for a, b in zip(edges[::2].tolist(), (edges[1::2] - 1).tolist(), strict=True):
        offsets.append((found[a][0], found[b][1]))
        last = b + 1 == len(found)
        parts.append(text[at:found[a][0]].rstrip() if last else text[at:found[a][0]])
        at = len(text) if last else found[b + 1][0]
    return "".join([*parts, text[at:]]), offsets, len(found), int(gone.sum())


def pieces(text: str, unit: str, least_words: int) -> dict[tuple[int, int], str]:
    """What is hashed of a text: start and end of each piece, and the piece as compared."""
    found, units = normal_units(text, unit)
    if unit == "passage":
        return {at: line for at, line in zip(found, units, strict=True) if line}
    return {(found[i][0], found[j][1]): " ".join(units[i:j + 1]) for i, j in windows(units, least_words)}


def word_spans(text: str) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Starts and ends of the words, and the words as compared."""
    kind = KINDS[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    word, alone = kind != 1, kind == 2
    breaks = np.ones(len(kind) + 1, bool)
    breaks[1:-1] = (word[1:] != word[:-1]) | alone[1:] | alone[:-1]
    starts = np.flatnonzero(breaks[:-1] & word)
    ends = np.flatnonzero(breaks[1:] & word) + 1
    if not alone.any():
        lowered = text.lower().split()
        if len(lowered) == len(starts):
            return starts, ends, lowered
    return starts, ends, [text[a:b].lower() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def _over(v: np.ndarray, n: int, least: bool) -> np.ndarray:
    """The least or greatest of each ``n`` neighbours."""
    pick, held, left = np.minimum if least else np.maximum, 1, n
    while held * 2 <= left:
        v = pick(v[:-held], v[held:])
        held *= 2
    return pick(v[:len(v) - (n - held)], v[n - held:]) if n > held else v


def _mix(v: np.ndarray) -> np.ndarray:
    v = (v ^ (v >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return v ^ (v >> np.uint64(32))


def _rolled(v: np.ndarray, base: int) -> np.ndarray:
    """The polynomial hash of each RUN neighbours, put together from those of half as many."""
    power = lambda k: np.uint64(pow(base, k, 1 << 64))
    of, size = {1: v}, 1
    while size * 2 <= RUN:
        h = of[size]
        of[size * 2] = h[:-size] * power(size) + h[size:]
        size *= 2
    h, held = of[size], size
    while held < RUN:
        size = max(k for k in of if held + k <= RUN)
        n = len(v) - held - size + 1
        h = h[:n] * power(size) + of[size][held:held + n]
        held += size
    return h


def runs(texts: list[str]) -> tuple[np.ndarray, ...]:
    """Text number, start, end, and two hashes of the chosen runs of words, in order. Of CHOICE runs
    in turn the one with the least hash is chosen, so the choice depends on their words alone;
    and those that begin or end with a sentence, so that a passage of whole sentences is found up
    to its ends."""
    spans_of, hashes, edges = [], [], []
    held = 0
    for t in texts:
        a, b, found = word_spans(t)
        spans_of.append((a, b))
        hashes.append(np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found)))
        if len(found) >= RUN:
            cuts = np.array([m.span() for m in SENTENCE.finditer(t)], np.int64).reshape(-1, 2)
            begins = np.concatenate(([0], np.searchsorted(a, cuts[:, 1])))
            ends = np.append(np.searchsorted(b, cuts[:, 0], "right"), len(found)) - RUN
            inside = np.concatenate([begins, ends])
            edges.append(held + inside[(inside >= 0) & (inside + RUN <= len(found))])
        held += len(found)
    sizes = np.array([len(h) for h in hashes], np.int64)
    none = np.zeros(0, np.int64)
    if sizes.sum() < RUN:
        return none, none, none, none, none
    word, owner = np.concatenate(hashes), np.repeat(np.arange(len(texts)), sizes)
    n = len(word) - RUN + 1
    one, two = _mix(_rolled(word, 0x9E3779B97F4A7C15)), _mix(_rolled(word >> np.uint64(7), 0xC2B2AE3D27D4EB4F))
    # The least of each CHOICE runs of one text, or 0; chosen is what is the least of some.
    chosen = np.zeros(n, bool)
    if n >= CHOICE:
        least = _over(one, CHOICE, True)
        least[owner[:len(least)] != owner[RUN + CHOICE - 2:]] = 0
        edge = np.zeros(CHOICE - 1, np.uint64)
        chosen = _over(np.concatenate([edge, least, edge]), CHOICE, False) == one
    if edges:
        chosen[np.concatenate(edges)] = True
    at = np.flatnonzero(chosen & (owner[:n] == owner[RUN - 1:]))
    starts, ends = (np.concatenate([x[k] for x in spans_of]) for k in (0, 1))
    return owner[at], starts[at], ends[at + RUN - 1], one[at].view(np.int64), two[at].view(np.int64)


def cut_spans(text: str, repeats: Iterable[tuple[int, int]], unit: str) -> tuple[str, list[tuple[int, int]], int, int]:
    """As ``cut``, of the pieces that start and end at ``repeats``; units count as removed if any
    of their text is."""
    repeats = sorted(repeats)
    if not repeats:
        by_line = unit in ("line", "passage") and not text.isspace()
        return text, [], sum(1 for line in text.split("\n") if line and not line.isspace()) if by_line else len(spans(text, unit)), 0
    merged: list[tuple[int, int]] = []
    for a, b in repeats:
        if merged and (a <= merged[-1][1] or text[merged[-1][1]:a].isspace()):
            merged[-1] = merged[-1][0], max(b, merged[-1][1])
        else:
            merged.append((a, b))
    found, parts, at = spans(text, unit), [], 0
    for a, b in merged:
        rest = SPACE.match(text, b).end() - b
        last = b + rest == len(text)
        parts.append(text[at:a].rstrip() if last else text[at:a])
        at = b + rest
    begins, ends = (np.array([x[k] for x in merged], np.int64) for k in (0, 1))
    touched = sum(bool(k < len(merged) and begins[k] < b) for (_, b), k in
                  zip(found, np.searchsorted(ends, [a for a, _ in found], "right").tolist(), strict=True))
    return "".join([*parts, text[at:]]), merged, len(found), touched


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """rank, text_key, text. Rows are known by the pair, as ids may be null (they rank last) or
    repeat: rows alike in both are one document seen again."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST)).alias("rank"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def repeats(docs: DataFrame, unit: str = "passage", least_words: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``rank, text_key, places``: start and end of the pieces of each document that occurred
    before.

    The first aggregation keeps one number for each digest and is summed up before the shuffle,
    so a line that a third of all documents hold sends one row from each task. Only digests met
    more than once come to the join, which Spark can split at a hot digest. ``places`` is as
    long as one document has pieces.
    """
    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank, key = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            row, begin, end, high, low, first, short = [], [], [], [], [], [], []
            for i, text in enumerate(string_column(batch, "text")):
                seen = set()
                for (a, b), piece in sorted(pieces(text, unit, least_words).items()):
                    h = xxhash.xxh3_128_intdigest(piece)
                    row.append(i)
                    begin.append(a)
                    end.append(b)
                    high.append((h >> 64) - (1 << 63))
                    low.append((h & 0xFFFFFFFF) - (1 << 31))
                    first.append(h not in seen)
                    short.append(unit == "passage" and len(piece) < SHORT)
                    seen.add(h)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rank[row] if row else rank[:0]), pa.array(key[row] if row else key[:0]), pa.array(begin, pa.int32()), pa.array(end, pa.int32()),
                 pa.array(high, pa.int64()), pa.array(low, pa.int32()), pa.array(first, pa.bool_()), pa.array(short, pa.bool_())],
                names=["rank", "text_key", "begin", "end", "high", "low", "first", "short"])

            if unit == "passage":
                yield from digest_runs(rank, key, string_column(batch, "text"))

    def digest_runs(rank, key, texts: list[str]) -> Iterator[pa.RecordBatch]:
        at = 0
        while at < len(texts):
            upto, size = at, 0
            while upto < len(texts) and (upto == at or size + len(texts[upto]) <= 6 * WORDS_HELD):
                size += len(texts[upto])
                upto += 1
            owner, begin, end, high, low = runs(texts[at:upto])
            owner = owner + at
            first = np.zeros(len(owner), bool)
            order = np.lexsort((begin, high, owner))
            o, h = owner[order], high[order]
            first[order] = np.concatenate(([True], (o[1:] != o[:-1]) | (h[1:] != h[:-1])))[:len(order)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rank[owner]), pa.array(key[owner]), pa.array(begin.astype(np.int32)), pa.array(end.astype(np.int32)), pa.array(high),
                 pa.array(low.astype(np.int32)), pa.array(first), pa.array(np.zeros(len(owner), bool))],
                names=["rank", "text_key", "begin", "end", "high", "low", "first", "short"])
            at = upto

    units = _keyed(docs, id_col, text_col).mapInArrow(digest, "rank long, text_key long, begin int, end int, high long, low int, first boolean, short boolean")
    met = settle(units.groupBy("high", "low", "short").agg(F.min("rank").alias("earliest"), F.count("*").alias("n"), F.count_if("first").alias("held"))
                 .where(F.when(F.col("short"), F.col("held") >= COMMON).otherwise(F.col("n") > 1)).select("high", "low", "earliest"), "met")
    again = units.join(met, ["high", "low"]).where(~((F.col("rank") == F.col("earliest")) & F.col("first")))
    return settle(again.groupBy("rank", "text_key").agg(F.collect_set(F.struct("begin", "end")).alias("places")), "repeats")


def dedup(docs: DataFrame, unit: str = "passage", least_words: int = 8, id_col: str = "doc_id", text_col: str = "text",
          details: str = "dedup") -> DataFrame:
    """``docs`` with repeats cut out of ``text_col``, and a struct ``details`` of ``n_units,
    n_removed, removed`` (array of start and end in the original text), in place of a column of
    that name. Units by ``passage`` are clauses, and count as removed if any of their text is.
    Every row stays, also if nothing of its text does.

    The earliest occurrence is that of the smallest id, and in a document the first; within one
    document later copies go too. A null text stays null and has no units; an empty one neither.
    Rows that repeat an id and text get equal results; two texts under one id both count as
    first. An empty table stays empty.
    """
    kept = docs.drop(details)
    names = kept.columns
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = kept.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST)).alias("rank"),
                       F.xxhash64(text).alias("text_key"), text.alias("text"))
    joined = rows.join(repeats(docs, unit, least_words, id_col, text_col), ["rank", "text_key"], "left").select("row", "text", "places")
    result = "text string, n_units int, n_removed int, removed array<struct<start:int,end:int>>"

    def run(texts, places):
        flat = places.flatten()
        found = list(zip(flat.field("begin").to_pylist(), flat.field("end").to_pylist(), strict=True))
        upto = np.cumsum(places.value_lengths().fill_null(0).to_numpy()).tolist()
        out = [cut_spans(t, found[a:b], unit) for t, a, b in zip(texts.to_pylist(), [0, *upto[:-1]], upto, strict=True)]
        ends = np.concatenate(([0], np.cumsum([len(o[1]) for o in out]))).astype(np.int32)
        pairs = [s for o in out for s in o[1]]
        pair = pa.StructArray.from_arrays([pa.array([s[0] for s in pairs], pa.int32()), pa.array([s[1] for s in pairs], pa.int32())], names=["start", "end"])
        return pa.StructArray.from_arrays(
            [pa.array([o[0] for o in out], pa.string()), pa.array([o[2] for o in out], pa.int32()), pa.array([o[3] for o in out], pa.int32()),
             pa.ListArray.from_arrays(pa.array(ends), pair)], names=["text", "n_units", "n_removed", "removed"])

    done = joined.select("row", F.arrow_udf(run, result)("text", "places").alias("cut"))
    columns = [F.when(F.col("row")[c].isNotNull(), F.col("cut.text")).alias(c) if c == text_col else F.col("row")[c].alias(c) for c in names]
    return done.select(*columns, F.struct("cut.n_units", "cut.n_removed", "cut.removed").alias(details))
