"""Two tokenizations aligned, against a slow account of the same."""

import hashlib
import os
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from portalake.llm import alignment
from portalake.llm.query_alignment import FIRST, SECOND, SIZES

SF = "/root/testdata/sf0.001"


def spans(ids, spelled):
    at, out = 0, []
    for i in ids:
        out.append((i, at, at + len(spelled(i))))
        at += len(spelled(i))
    return out


def brute(rows):
    first = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    bs = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in bs]
    back = {chr(b): b for b in bs} | {chr(256 + n): b for n, b in enumerate(other)}
    word = lambda i: bytes(back[c] for c in first.id_to_token(i))

    def piece(i):
        p = second.id_to_piece(i)
        return bytes.fromhex(p[3:5]) if second.is_byte(i) else p.replace("\u2581", " ").encode()

    links, parts, held = [], [], defaultdict(set)
    for k, (_, t) in enumerate(rows):
        t = t or ""
        a, b = spans(first.encode(" " + t, add_special_tokens=False).ids, word), spans(second.encode(t), piece)
        if not t or any(b"".join(f(i) for i, _, _ in x) != (" " + t).encode() for x, f in ((a, word), (b, piece))):
            a, b = [], []
        mine = [(i, j) for i, s, e in a for j, u, v in b if max(s, u) < min(e, v)]
        links.append(mine)
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        text, at = [], 0
        for end in ends:
            text.append("|".join(",".join(str(i) for i, s, e in side if at < e <= end) for side in (a, b)))
            at = end
        parts.append((len(a), len(b), len(ends), hashlib.sha256(";".join(text).encode()).hexdigest() if a else ""))
        for p in mine:
            held[p].add(k)
    count = {p: len(x) for p, x in held.items()}
    high = Counter()
    for (i, _), n in count.items():
        high[i] = max(high[i], n)
    return sorted((d if d is not None else -1, na, nb, g, len(x), sum(count[p] == high[p[0]] for p in x), sum(count[p] for p in x), h)
                  for (d, _), (na, nb, g, h), x in zip(rows, parts, links, strict=True)), {(i, j, n, n == high[i]) for (i, j), n in count.items()}


def check(docs, rows):
    got, counts = alignment.align(docs(*rows), lambda: alignment.byte_level(FIRST), lambda: alignment.pieces(SECOND), SIZES)
    want, pairs = brute(rows)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((r.doc_id if r.doc_id is not None else -1, *r[1:]) for r in got.collect()) == want
    assert {tuple(r) for r in counts.collect()} == pairs


def test_odd_rows(docs):
    rows = [(1, None), (2, ""), (3, " "), (4, "Hello <|endoftext|> <s> world</s>"), (5, "na\u00efve caf\u00e9 \u4e2d\u6587 \U0001f600"), (6, "a\u2581b"),
            (7, "tab\there\n\nand lines  two "), (8, "same text"), (9, "same text"), (9, "same text"), (9, "another text"), (None, "same text"),
            (None, None), (10, "\u1112\u1161\u11ab <0x41>"), (11, "\ufb01ne \u00bd \u3000 wide"), (12, "x" * 3000), (13, "\x00 nul")]
    check(docs, rows)
    check(docs, [])


def test_stretches_give_the_tokens_of_whole_texts(llm):
    """Encoding stretch by stretch is the same as at once, whatever stands between words."""
    rng = random.Random(5)
    words = ["a", "the", "don't", "\u00e9t\u00e9", "\u4e2d\u6587", "12", "...", "x_y", "\u0301a", "\u200b", "\u00a0", "\u2581", "<s>", "\U0001f600", "\u0130", "\u1112\u1161", "\x1c", "\ufb01", "'s"]
    gaps = [" ", " ", " ", "  ", "\n", "\t", " \n ", "\u3000", "\u00a0", "", "\u2009", "\r\n", "\x85", "\u180e"]
    texts = ["".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randrange(1, 40))) for _ in range(1500)]
    if os.path.isdir(SF):
        texts += [r.text for r in llm.read.parquet(SF + "/documents.parquet").select("text").collect() if r.text]
    for encoder in (alignment.byte_level(FIRST), alignment.pieces(SECOND)):
        want = encoder.encode([" " + t for t in texts])
        for _ in range(2):      # the second time from memory
            assert [np.frombuffer(x, np.int32).tolist() for x in encoder(texts)] == want


def test_chunks_and_copies(docs, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK", 300)
    monkeypatch.setattr(alignment, "AT_ONCE", 100)
    rng = random.Random(1)
    words = ["internationalisation", "the", "of", "Caf\u00e9", "2024", "\u00fcber", "running", "don't", "\u043c\u0438\u0440", "e.g.", "x_y"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 60))) for _ in range(60)]
    check(docs, [(i, texts[0] if i % 3 == 0 else rng.choice(texts)) for i in range(300)])


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not here")
def test_documents(llm, docs):
    rows = [(r.doc_id, r.text) for r in llm.read.parquet(SF + "/documents.parquet").collect() if len(r.text or "") < 3000]
    check(docs, rows[:60])
