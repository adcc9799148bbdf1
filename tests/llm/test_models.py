"""Quality, compression, language and language-model scores."""

import math
import os
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from portalake.llm import compression, langid, maxent, quality_model
from portalake.llm.common import remainder, texts
from portalake.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
data = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not here")
PROSE = ("The river ran slowly past the old mill, and nobody in the village could say who had built the bridge. "
         "Some thought of monks; others of a merchant whose daughter drowned there one spring. ")
LONG = "".join(f"Number {i} differs from {i * 7919 % 10007} in {i * 31 % 97} ways, they say. " for i in range(3000))


# --- compression ---------------------------------------------------------------------------

def brute(text):
    w = text.encode().split()
    lines, seen, dup = text.split("\n"), set(), 0
    for x in lines:
        if x.encode().split():
            dup += x in seen
            seen.add(x)
    times = Counter(zip(w, w[1:], w[2:]))
    inside = {i + k for i in range(len(w) - 2) if times[tuple(w[i:i + 3])] > 1 for k in range(3)}
    return len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text), dup, len(inside)


@pytest.mark.parametrize("text", ["", " ", "a", "a b c", "a b c a b c", "x y x y x y", "é|é#\né|é#\n\n\nz", "\x0b\x0c\r a b  c", PROSE, "so it goes " * 30])
def test_base_counts(text):
    assert compression.base_counts(text) == brute(text)


def test_verdicts(docs):
    rng = np.random.default_rng(1)
    noise = "".join(map(chr, rng.integers(33, 127, 5000)))
    spaced = " ".join(noise[i:i + 5] for i in range(0, 5000, 5))
    rows = [(1, PROSE * 1), (2, " ".join(f"loop{i % 2}" for i in range(400))), (3, spaced), (4, None), (5, ""), (6, LONG), (6, LONG), (None, "x"), (7, LONG[:4000] + "ab " * 20000)]
    got = [(r.doc_id, r.kept, r.base_failed, r.verdict) for r in compression.judge(docs(*rows)).collect()]
    assert (1, False, True, "ok") in got and (2, False, True, "repetitive") in got and (3, False, False, "random") in got
    assert (4, False, True, "ok") in got and (5, False, True, "ok") in got and (None, False, True, "ok") in got
    assert [x[3] for x in got if x[0] == 7] == ["repetitive"] and sum(x[0] == 6 for x in got) == 2
    assert compression.judge(docs()).count() == 0


def test_a_bad_stretch_in_a_long_text_counts():
    rng = np.random.default_rng(5)
    judge = compression.Judge(compression.Bands())
    noise = "".join(map(chr, rng.integers(33, 127, 16_000)))
    words = ["".join(map(chr, rng.integers(97, 123, rng.integers(2, 9)))) for _ in range(700)]
    clean = " ".join(words[i] for i in rng.integers(0, 700, 60_000))
    assert judge(clean.encode())[-1] == "ok"
    for stretch, verdict in ((noise, "random"), ("so it goes " * 1600, "repetitive")):
        text = clean[:100_000] + stretch + clean[100_000:]
        assert len(stretch) < 0.06 * len(text) and judge(text.encode())[-1] == verdict


def test_chunk_limits_follow_the_chunks_length():
    bands = compression.Bands()
    assert bands.limits(2048, chunk=True) == (1.3, 4.0) and bands.limits(4096, chunk=True) == (1.4, 4.5)


@data
def test_clean_documents_are_kept(llm):
    got = QUERIES["op5_compression_bands"](llm, SF).join(llm.read.parquet(SF + "/labels.parquet"), "doc_id")
    rows = got.where("n_words >= 50").groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in rows}
    assert n.get((1, False), 0) == 0 and n[0, False] > 0


# --- quality -------------------------------------------------------------------------------

def test_statistics_are_finite():
    import zstandard
    c = zstandard.ZstdCompressor(level=1)
    for t in ("", " ", "a", "\n\n", "é" * 9, PROSE, LONG, "|" * 5000, "\x00"):
        x = quality_model.statistics(t, c)
        assert len(x) == len(quality_model.NAMES) and np.isfinite(x).all()


def test_density_by_brute_force(llm):
    rng = np.random.default_rng(2)
    k = len(quality_model.NAMES)
    x = {0: rng.normal(0, 1, (400, k)), 1: rng.normal(0.5, 2, (700, k))}
    rows = [(c, v.tolist()) for c in x for v in x[c]] + [(None, [0.0] * k), (2, [9.0] * k)]
    m = quality_model.fit(llm.createDataFrame(rows, "label int, x array<double>"), temper=1.0)
    own = {c: np.cov(v.T, bias=True) for c, v in x.items()}
    pooled = (400 * own[0] + 700 * own[1]) / 1100
    logs = []
    probe = rng.normal(0, 1, (5, k))
    for c in (0, 1):
        lean = max(0.3, min(1, 5 * k / len(x[c])))
        s = (1 - lean) * own[c] + lean * pooled
        s = 0.95 * s + 0.05 * (np.trace(s) / k + 1e-6) * np.eye(k)
        d = probe - x[c].mean(axis=0)
        logs.append(-0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(s), d) - 0.5 * np.linalg.slogdet(s)[1] + math.log(len(x[c]) / 1100))
    assert np.allclose(m.score(probe), 1 / (1 + np.exp(logs[0] - logs[1])))


def test_one_class_or_none(llm, docs):
    v = quality_model.vectors(docs((1, "x"), (2, None), (2, None), (None, "")))
    for label, want in ((1, 0.99), (0, 0.01), (None, 0.5)):
        m = quality_model.fit(v.select("x", F.lit(label).cast("int").alias("label")))
        assert [r.score for r in quality_model.score(v, m).collect()] == [want] * 4
    assert quality_model.score(quality_model.vectors(docs()), m).count() == 0


@data
def test_quality_held_out(llm):
    rows = QUERIES["op4_quality_discriminant"](llm, SF).join(llm.read.parquet(SF + "/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.97 * len(rows) and all(0 <= r.score <= 1 for r in rows)


# --- languages -----------------------------------------------------------------------------

def test_codewords():
    for n in (2, 4, 7, 12, 40):
        c = langid.codewords(n)
        apart = min((c[i] != c[j]).sum() for i in range(n) for j in range(i))
        assert c.shape[0] == n and apart >= (1 if n == 2 else c.shape[1] // 4)


def test_languages(docs):
    en, de = "the cat sat on the mat and the dog ate that thing ", "der Hund und die Katze sind nicht auf dem Tisch gewesen "
    rows = [(i, en * (1 + i % 3), "en") for i in range(20)] + [(50 + i, de * (1 + i % 3), "de") for i in range(20)] + [(99, "xyz", None)]
    df = docs(*rows)
    model = langid.fit(df)
    probe = docs((1, "the dog sat and that cat"), (2, "nicht die Katze und der Hund"), (3, None), (4, ""), (5, "123 !? 4"), (6, de * 5000), (1, "the dog sat and that cat"), (None, "the"))
    got = [(r.doc_id, r.lang_pred) for r in langid.predict(probe, model).collect()]
    assert sorted(got, key=str) == sorted([(1, "en"), (1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (6, "de"), (None, "en")], key=str)
    none = langid.fit(df.where("lang is null"))
    assert {r.lang_pred for r in langid.predict(probe, none).collect()} == {"und"}
    one = langid.fit(df.where("lang = 'de'"))
    assert {r.lang_pred for r in langid.predict(probe, one).collect()} == {"und", "de"}
    assert langid.predict(docs(), model).count() == 0


def test_what_fits_no_language_is_rejected(docs):
    """Letter noise goes; training rows, and others like them, never."""
    en, de = "the cat sat on the mat and the dog ate that thing ", "der Hund und die Katze sind nicht auf dem Tisch gewesen "
    rows = [(i, en * (1 + i % 3), "en") for i in range(20)] + [(50 + i, de * (1 + i % 3), "de") for i in range(20)]
    model = langid.fit(docs(*rows))
    got = {r.doc_id: r.rejected for r in langid.predict(docs(*rows, (200, "the dog sat on that mat and the cat ate"), (201, None), (202, "1 2"),
                                                               (203, "\u4e2d\u6587\u5b57\u7b26 \u6587\u5b57")), model).collect()}
    assert [i for i, gone in got.items() if gone] == [203] and model.bound < 1
    assert langid.fit(docs(*rows, *((300 + i, "a b", f"x{i}") for i in range(30))), languages=2).langs == ["de", "en"]


@data
def test_languages_held_out(llm):
    rows = QUERIES["op8_language_codes"](llm, SF).join(llm.read.parquet(SF + "/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.98 * len(rows)


# --- language model ------------------------------------------------------------------------

SMALL = maxent.Shape(head=16, class_size=4, tail_classes=3, class_rows=64, word_rows=32, known=20, batch=256, block=500)


def trained(docs):
    rows = [(i, " ".join(["the cat", "a dog", "one bird"][(i + k) % 3] + f" w{(i * k) % 37}" for k in range(12))) for i in range(60)]
    df = texts(docs(*rows, (61, None)))
    return df, *maxent.fit(df, SMALL)


def test_probabilities_sum_to_one(docs):
    df, model, found, counts = trained(docs)
    vocabulary = [bytes(r.token) for r in counts.collect()]
    assert found.v == len(vocabulary) and found.n == sum(r.c for r in counts.collect())
    count = {bytes(r.token): r.c for r in counts.collect()}
    for context in ([], [b"the"], [b"the", b"cat"], [b"never", b"met"]):
        total = 0.0
        for t in vocabulary:
            x = model.index([[*context, t]])
            last = x.at[-1]
            logp = model.score_tokens(x)[-1]
            total += 10 ** (logp if x.head[last] >= 0 else logp + math.log10(count[t] + 0.1) - model.tail_log[x.cls[last] - model.shape.head_classes])
        # Each tail class keeps one share for tokens never met.
        x = model.index([[*context, b""]])
        z = model.class_scores(model.contexts(x.mixed[x.at], x.sizes)[:, -1:])[0][0].astype(float)
        p = np.exp(z) / np.exp(z).sum()
        unmet = sum(p[model.shape.head_classes + k] * 0.1 / 10 ** model.tail_log[k] for k in range(3))
        assert math.isclose(total + unmet, 1, abs_tol=1e-4)


def test_scores(docs):
    df, model, found, counts = trained(docs)
    probe = texts(docs((1, "the cat w1 a dog w2"), (2, None), (3, "zzz yyy"), (1, "the cat w1 a dog w2"), (None, "the"), (4, "the cat " * 30_000)))
    rows = maxent.score(probe, model, found, counts).collect()
    count = {bytes(r.token): r.c for r in counts.collect()}
    for (i, t), n in Counter((r.doc_id, r.text) for r in probe.collect()).items():
        mine = [r for r in rows if r.doc_id == i]
        toks = maxent.tokens(t)
        base = sum(math.log10((count.get(x, 0) + 0.1) / (found.n + 0.1 * (found.v + 1))) for x in toks)
        assert len(mine) == n
        for r in mine:
            assert (r.n_tokens, r.n_known) == (len(toks), sum(x in count for x in toks))
            assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0
    assert next(r for r in rows if r.doc_id == 1).score > next(r for r in rows if r.doc_id == 1).base_score


def test_gradients_are_summed_without_short_stretches():
    """Only rows met often are left to reduceat, which is slow for many short stretches; sums are its own
    to the bit, whatever a row's number is held in."""
    rng = np.random.default_rng(5)
    rows = np.concatenate([np.arange(300), rng.integers(0, 90, 400), np.repeat([7, 299, 11], 50)])
    rng.shuffle(rows)
    grad = rng.normal(size=(len(rows), 6)).astype(np.float32)
    order = np.argsort(rows, kind="stable")
    at, first = np.unique(rows[order], return_index=True)
    want = dict(zip(at.tolist(), np.add.reduceat(grad[order], first, axis=0), strict=True))
    for n_rows in (300, 1 << 17):
        got, of = maxent.row_sums(rows, grad, n_rows)
        assert sorted(of.tolist()) == at.tolist()
        assert all(np.array_equal(want[r], v) for r, v in zip(of.tolist(), got, strict=True))
    got, of = maxent.row_sums(np.array([3]), grad[:1], 300)
    assert of.tolist() == [3] and np.array_equal(got, grad[:1])


def test_tokens_by_arrow_are_the_same():
    """Texts are split and numbered by Arrow, not token by token: blanks of other scripts and control
    characters stay in words, and only A-Z is lower-cased."""
    marks = [" ", "\t", "\n", "\x0b", "\f", "\r", "A", "z", "É", "\x85", "\xa0", "\u3000", "\u2028", "\x1c", "\x1f", "\0", "한"]
    rng = np.random.default_rng(3)
    odd = ["", " ", "\n\t", " a", "a ", "A", *("".join(marks[k] for k in rng.integers(0, len(marks), n)) for n in rng.integers(0, 12, 2000))]
    want = [maxent.tokens(t) for t in odd]
    for kind in (pa.string(), pa.large_string()):
        assert maxent.token_lists(pa.array(odd, kind)).to_pylist() == want
    model = maxent.start(maxent.Corpus(4, 3, {b"a": 2, b"": 1, b"z": 1}, np.array([4, 0, 0]), np.array([3, 0, 0])), SMALL)
    for part in (slice(0, None), slice(700, 900), slice(0, 0)):
        x, y = model.index(maxent.token_lists(pa.array(odd)[part])), model.index(want[part])
        flat = [t for ts in want[part] for t in ts]
        assert [x.found[i] for i in x.at] == [y.found[i] for i in y.at] == flat and len(set(x.found)) == len(x.found)
        assert x.sizes.tolist() == y.sizes.tolist() == [len(ts) for ts in want[part]]


def test_no_training_texts(docs):
    model, found, counts = maxent.fit(texts(docs()), SMALL)
    (r,) = maxent.score(texts(docs((1, "a b"))), model, found, counts).collect()
    assert (r.n_tokens, r.n_known) == (3, 0) and r.base_score == 0 and math.isfinite(r.score)
    assert maxent.score(texts(docs()), model, found, counts).count() == 0


@data
def test_model_beats_base_on_held_out(llm):
    rows = QUERIES["op10_maxent_scores"](llm, SF).where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_remainder(llm):
    rows = llm.range(50).select("id", remainder("id", 4).alias("r")).collect()
    assert all(r.r == zlib.crc32(str(r.id).encode()) % 4 for r in rows)


def test_languages_are_learned_from_all_rows(spark):
    """However many rows a language has, none of them is left out: a bit that is right on all n rows
    weighs log(n + 1)."""
    rows = spark.range(30_000).selectExpr("id as doc_id", "'the cat sat' as text", "'en' as lang")
    rows = rows.unionByName(spark.range(30).selectExpr("100000 + id as doc_id", "'der Hund' as text", "'de' as lang"))
    assert langid.fit(rows).bit_weight.tolist() == pytest.approx([math.log(30_031)])
