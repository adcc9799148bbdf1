"""Hard negatives against brute force."""

import numpy as np
from pyspark.sql import functions as F

from portalake.llm import negatives as N

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, positives=5, negatives=5):
    seen, used = set(), []
    key = lambda r: (r[0], r[2], r[1])
    for i, v, label in sorted((r for r in rows if r[0] is not None and r[1] is not None and r[2] is not None), key=lambda r: (r[0], r[2], [(-1e40 if x is None else x) for x in r[1]])):
        if any(x is None or not np.isfinite(x) for x in v):
            continue
        q = [int(np.floor(256.0 * float(np.float32(x)))) for x in v]
        if sum(x * x for x in q) < 1 << 62 and i not in seen:
            seen.add(i)
            used.append((i, q, label))
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = set()
    for i, v, label in used:
        if i % 100 == 0:
            all_ = [(-score(v, w), j, m) for j, w, m in used if j != i]
            for p, j, _ in sorted(x for x in all_ if x[2] == label)[:positives]:
                near = sorted(x for x in all_ if x[2] != label and 80 * -p <= 100 * -x[0] <= 100 * -p)[:negatives]
                out |= {(i, j, k, x[1], -p, -x[0]) for k, x in enumerate(near, 1)}
    return out


def check(llm, rows):
    df = llm.createDataFrame(rows, SCHEMA)
    for name in ("id", "cell", "kind", "v", "found", "slot", "rank", "block", "group"):
        df = df.withColumn(name, F.lit("x"))
    got = [tuple(r) for r in N.mine(df, F.col("id") % 100 == 0).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)
    return got


def test_scores_are_exact():
    rng = np.random.default_rng(1)
    for scale, d in ((1, 1), (80, 64), (2**15, 64), (2**20, 700), (2**27, 64), (2**30, 2)):
        a, b = (rng.integers(-scale, scale + 1, (n, d)) for n in (30, 40))
        assert (N.scores(a, b).astype(object) == a.astype(object) @ b.astype(object).T).all()
    assert N.scores(np.zeros((0, 3), np.int64), np.zeros((2, 3), np.int64)).shape == (0, 2)


def test_many_rows_and_ties(llm):
    """Several cells; one vector shared by a third of the rows."""
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=6)], int(rng.integers(0, 4))) for i in range(1200)]
    hot = [float(x) for x in rng.normal(size=6)]
    rows = [(i, hot if i % 3 == 0 else v, m) for i, v, m in rows]
    assert check(llm, rows)


def test_small_blocks(llm, monkeypatch):
    """Anchors in several blocks, rows in several tiles; an id's repeats across a tile's end."""
    for name, value in (("ANCHORS_AT_ONCE", 3), ("ROWS_AT_ONCE", 200), ("TILE", (2, 50))):
        monkeypatch.setattr(N, name, value)
    rng = np.random.default_rng(3)
    rows = [(i * 4, [float(x) for x in rng.normal(size=3)], int(rng.integers(0, 3))) for i in range(300)]
    assert check(llm, rows + rows[::7] + [(i, v, 2 - m) for i, v, m in rows[:40]])


def test_odd_rows(llm):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, [1.0, 1.5], 2), (3, [0.9, 2.0], 2), (4, None, 1), (5, [1.0, 2.0], None),
            (6, [1.0, None], 1), (7, [nan, 1.0], 1), (8, [inf, 1.0], 2), (None, [1.0, 2.0], 1), (9, [1.0], 1), (10, [], 2),
            (11, [1.0, 1.9, 5.0], 2), (100, [-1.0, 0.0], 3), (200, [3e38, 0.0], 1), (300, [-1.0, -2.0], 4), (12, [1.0, 2.0], 4)]
    assert check(llm, rows)
    assert check(llm, []) == [] and check(llm, [(100, [1.0], 1)]) == [] and check(llm, [(1, [1.0], 1)]) == []
