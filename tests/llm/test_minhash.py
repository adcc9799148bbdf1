"""Near-duplicate groups against brute force, and the Bayesian bounds against their definition."""

import os
import random
import re

import numpy as np
import pytest

from portalake.llm import minhash as M

WORDS = ["".join(random.Random(i).choice("abcdefghijklmnop") for _ in range(5)) for i in range(3000)]
SF = "/root/testdata/sf0.001"


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def changed(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = rng.choice(WORDS)
    return " ".join(w)


def set_of(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if x]
    return {" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))} if w else set()


def brute(rows):
    sets = [(i, set_of(t)) for i, t in rows if i is not None]
    low = {i: i for i, _ in sets}

    def root(x):
        while low[x] != x:
            x = low[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = root(i), root(j)
                low[max(x, y)] = min(x, y)
    return sorted((-1 if i is None else i, len(set_of(t)), -1 if i is None else root(i), i is None or root(i) == i) for i, t in rows)


def check(docs, rows):
    got = M.groups(docs(*rows))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted((-1 if r[0] is None else r[0], r[1], -1 if r[2] is None else r[2], r[3]) for r in got.collect()) == brute(rows)


def test_bounds_and_signatures():
    rng = np.random.default_rng(1)
    for n, percent, miss in ((16, 80, 1e-3), (128, 80, 1e-9), (64, 50, 0.01)):
        m = M.least_matches(n, percent, miss)
        mass = lambda k: (rng.beta(k + 1, n - k + 1, 400_000) >= percent / 100).mean()
        assert miss < 1e-4 or (mass(m) > 0.8 * miss and mass(m - 1) < 1.25 * miss)
    assert M.least_matches(128, 80, 1e-9) < M.least_matches(128, 80, 1e-3) < 128 * 0.8
    base = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    other = np.concatenate([base[:900], rng.integers(0, 1 << 63, 100, dtype=np.uint64)])      # 900 / 1100
    sigs = M.signatures([np.unique(x) for x in (base, other, base[:0], base)], 4096)
    assert abs((sigs[0] == sigs[1]).mean() - 900 / 1100) < 0.03 and (sigs[0] == sigs[3]).all()
    sigs = M.signatures([np.unique(rng.integers(0, 1 << 63, 50, dtype=np.uint64)) for _ in range(60)] + [base, other])
    a, b = np.repeat(np.arange(62), 62), np.tile(np.arange(62), 62)
    left = M.survivors(sigs[a], sigs[b])
    assert {(int(a[i]), int(b[i])) for i in left} == {(i, i) for i in range(62)} | {(60, 61), (61, 60)}


def test_sets_of_all_sizes(docs):
    rng = random.Random(1)
    texts = [None, "", "  \n", "one", "ONE", "one two", "one two three", "a b c d", "a b c d e", "Ä b c d", "ä b c d"]
    for n in (6, 8, 10, 13, 20, 36, 70, 140, 600):
        for _ in range(3):
            t = prose(rng, n)
            texts += [t, t.upper(), changed(rng, t, 1), changed(rng, t, max(1, n // 50)), t + " " + prose(rng, max(1, n // 9)), t[: len(t) * 5 // 6]]
    check(docs, list(enumerate(texts)))


def test_crowds(docs):
    """More near copies than a bucket pairs, some no longer similar to each other, and many texts that share a passage."""
    rng = random.Random(2)
    base, passage = prose(rng, 90), prose(rng, 40)
    texts = [changed(rng, base, rng.choice([0, 1, 2, 3, 4])) for _ in range(80)] + [base] * 20
    texts += [passage + " " + prose(rng, rng.choice([5, 6, 8, 10, 12])) for _ in range(70)]
    texts += [prose(rng, 30) + " " + passage + " " + prose(rng, 30) for _ in range(30)]
    short = prose(rng, 9)
    texts += [short + " " + rng.choice(WORDS) for _ in range(40)] + [short]
    rng.shuffle(texts)
    check(docs, list(enumerate(texts)))


def test_odd_rows(docs):
    rng = random.Random(3)
    t, u = prose(rng, 60), prose(rng, 60)
    check(docs, [(5, t), (3, t), (3, t), (None, t), (9, None), (11, "x " * 50_000), (7, u), (5, changed(rng, u, 1)), (2, changed(rng, u, 1)), (None, None)])
    check(docs, [])


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not here")
def test_documents(llm, docs):
    check(docs, [(r.doc_id, r.text) for r in llm.read.parquet(SF + "/documents.parquet").collect()])
