import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from portalake.llm import attribution, bpe
from portalake.llm.query_bpe import PATTERN, RANKS, digests

ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
ENC = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
random.seed(5)
ODD = ["", " ", "x", "I'll don't", " \n\n  \t ", "two  spaces", " leading", "trailing ", "a b  c", "no​break", "<|endoftext|>",
       "é̀🎉" * 50, "日本語中文" * 300, "a" * 3000, "ab" * 1500, "=" * 900, "\n" * 400, "tab\t\tx \r\n y", "".join(random.choice("abcdefgh") for _ in range(2000))]


@pytest.fixture(scope="module")
def tok():
    return bpe.load(RANKS, PATTERN)


def test_equals_the_reference_library(tok):
    words = ["".join(random.choice("aeinorstlédß'-  .,!1") for _ in range(random.randint(1, 700))) for _ in range(300)]
    for text in [*ODD, *words]:
        assert np.frombuffer(tok.encode([text])[0], "<i4").tolist() == ENC.encode_ordinary(text), text[:40]
    assert [np.frombuffer(x, "<i4").tolist() for x in tok.encode([*ODD, *words])] == [ENC.encode_ordinary(t) for t in [*ODD, *words]]


def test_another_pattern(tok):
    other = bpe.Tokenizer(tok.tokens, r"\S+|\s+")
    enc = tiktoken.Encoding("own", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    for text in ODD:
        assert np.frombuffer(other.encode([text])[0], "<i4").tolist() == enc.encode_ordinary(text)


def test_pair_table_finds_all_pairs_and_no_other(tok):
    pairs = [(a, b) for a, b in ((t[:1], t[1:]) for t in tok.tokens if len(t) > 1) if a in ranks and b in ranks]
    left, right = (np.array([ranks[p[k]] for p in pairs], np.int32) for k in (0, 1))
    assert tok.pairs.rank(left, right).tolist() == [ranks[a + b] for a, b in pairs]
    assert (tok.pairs.rank(np.array([-1, 5], np.int32), np.array([5, -1], np.int32)) == bpe.NONE).all()


def test_columns_and_round_trip(docs):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(99, None), (None, "no id"), (1, " ")]
    df = docs(*rows)
    out = bpe.decode(bpe.encode(df, RANKS, PATTERN), RANKS, PATTERN)
    assert out.columns == [c for c in df.columns if c != "ids"] + ["ids", "decoded"]
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.text or "", r.ids, bytes(r.decoded)) for r in out.collect())
    want = sorted((i if i is not None else -1, t or "", ENC.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows)
    assert got == want
    d = {r.doc_id: r for r in digests(out.where("doc_id = 13").select("doc_id", "ids", "decoded")).collect()}[13]
    ids = ENC.encode_ordinary(ODD[13])
    assert (d.n_tokens, d.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
    assert d.decoded_sha256 == hashlib.sha256(ODD[13].encode()).hexdigest()


def test_empty_table(docs):
    out = bpe.decode(bpe.encode(docs(), RANKS, PATTERN), RANKS, PATTERN)
    assert out.count() == 0 and digests(out).count() == 0
    assert attribution.count(docs(), RANKS, PATTERN).count() == 0


# --- attribution ---------------------------------------------------------------------------

def test_spans_cover_the_text(tok):
    for text in ["plain ascii text", "Füße für 日本 🎉🎉 ok", ""]:
        ids = np.frombuffer(tok.encode([text])[0], "<i4")
        a, b = attribution.token_spans(tok, ids, text)
        for i, x, y in zip(ids.tolist(), a.tolist(), b.tolist(), strict=True):
            assert tok.tokens[i] in text[x:y].encode() and 0 <= x < y <= len(text)


def brute(starts, ends, sections, rule):
    total = [0.0] * len(sections)
    for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
        over = [max(0, min(b, e) - max(a, s)) for _, a, b in sections]
        if rule == "start":
            for k, (_, a, b) in enumerate(sections):
                if a <= s < b:
                    total[k] += 1
        elif rule == "largest" and max(over, default=0) > 0:
            total[over.index(max(over))] += 1
        elif rule == "split":
            for k, o in enumerate(over):
                total[k] += o / (e - s)
    return total


@pytest.mark.parametrize("rule", attribution.RULES)
def test_rules_by_brute_force(rule):
    random.seed(3)
    for _ in range(300):
        cuts = sorted(random.sample(range(60), random.randint(2, 12)))
        starts = np.array([a for a, b in zip(cuts, cuts[1:])])
        ends = np.array(cuts[1:])
        edges = sorted(random.sample(range(60), 2 * random.randint(1, 5)))
        sections = [("s", a, b) for a, b in zip(edges[::2], edges[1::2])]
        got, _ = attribution.attribute(starts, ends, sections, rule)
        assert np.allclose(got, brute(starts, ends, sections, rule)), (cuts, edges)


def test_lines_sum_to_the_document(docs):
    rows = [(1, "one line\n\nand two\n"), (2, ""), (3, None), (4, "é🎉\nß" * 500), (4, "é🎉\nß" * 500), (None, "x")]
    got = attribution.count(docs(*rows), RANKS, PATTERN).collect()
    for i in (1, 4, None):
        mine = [r for r in got if r.doc_id == i]
        assert sum(r.n_tokens for r in mine) == mine[0].doc_tokens * (2 if i == 4 else 1)
    assert not [r for r in got if r.doc_id in (2, 3)]
    assert "".join(("one line\n\nand two\n")[r.section_start:r.section_end] for r in sorted((r for r in got if r.doc_id == 1), key=lambda r: r.section_start)) == "one line\n\nand two\n"
    with pytest.raises(ValueError):
        attribution.count(docs(), RANKS, PATTERN, rule="middle")


def test_fields_of_one_document(docs, llm):
    """Columns encoded together: their tokens are those of the joined text, by where each begins."""
    rows = [(1, "A title", "The body text, na\u00efve \U0001f600\nof two lines.", None), (2, None, "", None), (3, "", "only", "foot notes"), (None, "x", "y", "z"), (1, "A title", "again", "")]
    df = llm.createDataFrame(rows, "doc_id long, title string, body string, notes string").withColumn("text", F.lit("other")).withColumn("names", F.lit(1))
    got = attribution.count_fields(df, ["title", "body", "notes"], RANKS, PATTERN, separator="\n--\n").collect()
    want = []
    for i, *fields in rows:
        held = [(n, f) for n, f in zip(("title", "body", "notes"), fields, strict=True) if f]
        whole = "\n--\n".join(f for _, f in held)
        ids, at = ENC.encode_ordinary(whole), 0
        begins, edges = [], []
        for n, f in held:
            edges.append((n, at, min(len(whole), at + len(f) + 4)))
            at = edges[-1][2]
        done = 0
        for t in ids:
            begins.append(len(whole.encode()[:done].decode("utf-8", "ignore")))
            done += len(ENC.decode_single_token_bytes(t))
        for n, a, b in edges:
            want.append((i, n, a, b, float(sum(a <= x < b for x in begins)), len(ids)))
    assert sorted(((r.doc_id, r.section, r.section_start, r.section_end, r.n_tokens, r.doc_tokens) for r in got), key=str) == sorted(want, key=str)
    assert attribution.count_fields(df.limit(0), ["title"], RANKS, PATTERN).count() == 0


def test_sections_that_overlap_are_refused(docs):
    for bad in ([("a", 0, 3), ("b", 2, 4)], [("b", 3, 4), ("a", 0, 1)], [("a", 0, 99)]):
        with pytest.raises(Exception, match="section"):
            attribution.count(docs((1, "some text")), RANKS, PATTERN, sections=lambda text, bad=bad: bad).collect()
