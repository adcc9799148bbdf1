"""Token counts by field or section: offset-mapped attribution.

A document is encoded once, as a whole, and every token gets its span of characters. Sections
are spans too; tokens are matched with them by an interval join on sorted boundaries. A token
over a boundary is allocated by a rule that is stated, not by encoding the parts apart.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Tokenizer, few_at_a_time, shared
from .common import string_column, texts

RULES = ("start", "largest", "split")
Sections = Callable[[str], list[tuple[str, int, int]]]


def lines(text: str) -> list[tuple[str, int, int]]:
    """Each line with its line end, by number from 1; they tile the text."""
    out, at = [], 0
    for i, line in enumerate(text.split("\n")):
        end = min(len(text), at + len(line) + 1)
        if end > at:
            out.append((str(i + 1), at, end))
        at = end
    return out


def token_spans(tok: Tokenizer, ids: np.ndarray, text: str) -> tuple[np.ndarray, np.ndarray]:
    """First character of each token, and the one after its last. A token that begins or ends
    inside a character covers that character."""
    sizes = np.fromiter((len(tok.tokens[i]) for i in ids.tolist()), np.int64, len(ids))
    ends = np.cumsum(sizes)
    starts = ends - sizes
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    if len(raw) == len(text):
        return starts, ends
    begins = (raw & 0xC0) != 0x80
    before = np.concatenate(([0], np.cumsum(begins)))
    return before[starts] - ~begins[starts], before[ends]


def attribute(starts: np.ndarray, ends: np.ndarray, sections: list[tuple[str, int, int]], rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section by the rule, and tokens that also lie in another section or none.

    start: a token belongs to the section its first character lies in. largest: to the one that
    holds most of its characters, the earlier one of equals. split: in proportion to its
    characters. Sections are sorted and don't overlap; gaps are allowed, what lies there is not
    counted.
    """
    n = len(sections)
    total, crossing = np.zeros(n), np.zeros(n, np.int64)
    if not n or not len(starts):
        return total, crossing
    a, b = np.array([s[1] for s in sections]), np.array([s[2] for s in sections])
    first = np.searchsorted(b, starts, "right")             # first section that ends after the token begins
    after = np.maximum(first, np.searchsorted(a, ends, "left"))   # first one that begins where it has ended
    inside = (after - first == 1) & (first < n)
    whole = inside.copy()
    whole[inside] = (a[first[inside]] <= starts[inside]) & (ends[inside] <= b[first[inside]])
    total += np.bincount(first[whole], minlength=n)
    for t in np.flatnonzero(~whole & (first < after)):        # the few on a boundary
        of = np.arange(first[t], min(n, after[t]))
        over = np.minimum(b[of], ends[t]) - np.maximum(a[of], starts[t])
        of, over = of[over > 0], over[over > 0]
        if not len(of):
            continue
        crossing[of] += 1
        if rule == "start":
            if a[of[0]] <= starts[t]:
                total[of[0]] += 1
        elif rule == "largest":
            total[of[over.argmax()]] += 1
        else:
            total[of] += over / (ends[t] - starts[t])
    return total, crossing


def checked(sections: Sections) -> Sections:
    """The same sections, refused where they overlap, are unsorted or lie outside the text."""
    def run(text: str) -> list[tuple[str, int, int]]:
        found, at = sections(text), 0
        for name, a, b in found:
            if not at <= a <= b <= len(text):
                raise ValueError(f"section {name!r} from {a} to {b} of a text of {len(text)} characters, after one that ends at {at}")
            at = b
        return found

    return run


SCHEMA = "doc_id long, section string, section_start long, section_end long, n_tokens double, n_crossing long, doc_tokens long"


def count(docs: DataFrame, path: str, pattern: str, sections: Sections = lines, rule: str = "start",
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and section: its span, ``n_tokens`` by the rule, ``n_crossing`` tokens
    on its boundaries, and ``doc_tokens`` of the whole document.

    With sections that tile the text, a document's ``n_tokens`` sum up to ``doc_tokens``. Sections that
    overlap, or aren't in order, fail the job. A null or empty text has no sections and no rows;
    repeated rows give repeated results; other columns aren't read. Narrow: no shuffle.
    """
    chosen = sections if sections is lines else checked(sections)
    return _count(texts(docs, id_col, text_col), lambda batch: [chosen] * batch.num_rows, path, pattern, rule)


def count_fields(docs: DataFrame, columns: list[str], path: str, pattern: str, separator: str = "\n\n", rule: str = "start",
                 id_col: str = "doc_id") -> DataFrame:
    """The same of several columns that are encoded as one text, in the order given and parted by
    ``separator``; a section is a column. The separator belongs to the column before it, so that the
    columns tile the text and their ``n_tokens`` sum up to ``doc_tokens``. A null or empty column has
    no section and no separator; a row without any has no rows.
    """
    held = [F.col(f"`{c}`").cast("string") for c in columns]
    some = F.filter(F.array(*(F.struct(F.lit(c).alias("name"), v.alias("text")) for c, v in zip(columns, held, strict=True))), lambda x: F.length(x["text"]) > 0)
    whole = (docs.select(F.col(id_col).cast("long").alias("doc_id"), some.alias("some"))
             .select("doc_id", F.array_join(F.transform("some", lambda x: x["text"]), separator).alias("text"),
                     F.transform("some", lambda x: x["name"]).alias("names"), F.transform("some", lambda x: F.length(x["text"])).alias("sizes")))

    def tiled(names: list[str], sizes: list[int]) -> Sections:
        def run(text: str) -> list[tuple[str, int, int]]:
            out, at = [], 0
            for name, n in zip(names, sizes, strict=True):
                end = min(len(text), at + n + len(separator))
                out.append((name, at, end))
                at = end
            return out

        return run

    return _count(whole, lambda batch: [tiled(a, b) for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)], path, pattern, rule)


def _count(rows: DataFrame, sections_of: Callable[[pa.RecordBatch], list[Sections]], path: str, pattern: str, rule: str) -> DataFrame:
    """Counts of rows of ``doc_id``, ``text`` and what ``sections_of`` needs to give each row's sections."""
    if rule not in RULES:
        raise ValueError(f"rule {rule!r} is none of {RULES}")
    sent = shared(rows.sparkSession, path, pattern)

    def of_run(run: list[str], rows: list[int], sections: list[Sections], tok: Tokenizer) -> Iterator[tuple]:
        for i, text, raw in zip(rows, run, tok.encode(run), strict=True):
            ids = np.frombuffer(raw, "<i4")
            found = sections[i](text)
            total, crossing = attribute(*token_spans(tok, ids, text), found, rule)
            for (name, a, b), n, c in zip(found, total.tolist(), crossing.tolist(), strict=True):
                yield i, name, a, b, n, c, len(ids)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, sections = 0, sections_of(batch)
            for some in few_at_a_time(string_column(batch, "text")):
                rows = list(of_run(some, range(at, at + len(some)), sections, sent.value))
                at += len(some)
                if rows:
                    row, *columns = zip(*rows, strict=True)
                    kinds = (pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), *map(pa.array, columns, kinds)],
                                                     names=[x.split()[0] for x in SCHEMA.split(", ")])

    return rows.mapInArrow(run, SCHEMA)
