"""Near copies, components, repeated passages and benchmark items, against brute force."""

import random
import re
import time

import pytest

from portalake.llm import contamination, jaccard, substring
from portalake.llm.components import components

WORDS = ["".join(random.Random(i).choice("abcdefghijklmnop") for _ in range(5)) for i in range(3000)]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def changed(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = rng.choice(WORDS)
    return " ".join(w)


def brute_components(rows):
    sets = {i: jaccard.exact(t or "") for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            if jaccard.linked(sets[i], sets[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in ids}


def check(docs, rows):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(docs(*rows)).collect()}
    assert got == brute_components(rows)


def test_small_and_large_sets(docs):
    rng = random.Random(1)
    texts = [None, "", "  \n", "one", "ONE", "one two", "one two three four", "a b c d e", "a b c d e f"]
    for n in (8, 9, 10, 12, 15, 19, 20, 24, 36, 40, 70, 140, 600):
        for _ in range(3):
            t = prose(rng, n)
            texts += [t, t.upper(), changed(rng, t, 1), changed(rng, t, max(1, n // 60)), t + " " + prose(rng, max(1, n // 8)), t[: len(t) * 5 // 6]]
    check(docs, list(enumerate(texts)))


def test_crowds(docs):
    """Near copies of very many, texts made of shared passages, and both with links beyond."""
    rng = random.Random(2)
    base, passage = prose(rng, 80), prose(rng, 40)
    texts = [changed(rng, base, rng.choice([0, 1, 1, 2])) for _ in range(60)]
    texts += [base] * 20
    texts += [passage + " " + prose(rng, rng.choice([6, 8, 10, 14])) for _ in range(40)]
    texts += [prose(rng, 30) + " " + passage + " " + prose(rng, 30) for _ in range(30)]
    short = prose(rng, 7)
    texts += [short + " " + rng.choice(WORDS) for _ in range(30)] + [short]
    rng.shuffle(texts)
    check(docs, list(enumerate(texts)))


def test_odd_rows(docs):
    rng = random.Random(3)
    t = prose(rng, 60)
    df = docs((5, t), (3, t), (3, t), (None, t), (9, None), (11, "x " * 50_000))
    got = sorted(((r.doc_id if r.doc_id is not None else -1), r.n_shingles, r.component_id) for r in jaccard.join(df).collect())
    n = len(jaccard.exact(t))
    assert got == [(-1, n, None), (3, n, 3), (3, n, 3), (5, n, 3), (9, 0, 9), (11, 1, 11)]
    assert jaccard.join(docs()).count() == 0


def test_an_id_with_a_copied_text_keeps_the_links_of_its_other_text(docs):
    rng = random.Random(13)
    a, b = prose(rng, 80), prose(rng, 80)
    near = b.rsplit(" ", 1)[0]
    assert jaccard.linked(jaccard.exact(b), jaccard.exact(near)) and not jaccard.linked(jaccard.exact(a), jaccard.exact(b))
    got = sorted((r.doc_id, r.component_id) for r in jaccard.join(docs((1, a), (5, a), (5, b), (9, near))).collect())
    assert got == [(1, 1), (5, 1), (5, 1), (9, 1)]


def test_sketches_never_rule_out_a_pair():
    rng, shingles = random.Random(4), jaccard.Shingler()
    for _ in range(200):
        t = prose(rng, rng.randint(1, 300))
        u = changed(rng, t, rng.randint(0, 6))
        a, b = shingles(t), shingles(u)
        assert jaccard.differ(jaccard.sketch(a), jaccard.sketch(b)) <= len(set(a.tolist()) ^ set(b.tolist()))


def test_random_components(llm):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1100)] + [(2000, i) for i in range(2001, 2050)]
    parent = {i: i for p in links for i in p}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    want = {i: root(i) for a, b in links if a != b for i in (a, b)}
    df = llm.createDataFrame([*links, (None, 4), (7, None)], "a long, b long")
    assert {r.id: r.component for r in components(df).collect()} == want
    assert components(df.limit(0)).count() == 0


# --- substring -----------------------------------------------------------------------------

def test_ends_of_lines_and_sentences_are_sought_at_white_space():
    """A search that may only begin at white space skips all else; it finds what the plain patterns do."""
    plain = {substring.SENTENCE: r"(?<=[.!?])[ \t]+|\s*\n\s*", substring.BETWEEN["line"]: r"\s*\n\s*"}
    pick = random.Random(3)
    texts = ["".join(pick.choice("a.!? \t\n\r\x0b\x1c　\x85,") for _ in range(pick.randint(0, 40))) for _ in range(3000)]
    for pattern, form in plain.items():
        assert pattern.pattern.startswith(r"\s(")
        for t in texts:
            assert [m.span() for m in pattern.finditer(t)] == [m.span() for m in re.finditer(form, t)], t


def brute_dedup(rows, unit="clause", least=8):
    first = {}
    order = sorted(rows, key=lambda r: r[0])
    wins = {}
    for i, t in order:
        units = substring.normal_units(t or "", unit)[1]
        wins[i, t] = [" ".join(units[a:b + 1]) for a, b in substring.windows(units, least)]
        for k, w in enumerate(wins[i, t]):
            first.setdefault(w, (i, k))
    return {(i, t): substring.cut(t or "", [k for k, w in enumerate(wins[i, t]) if first[w] != (i, k)], unit, least) for i, t in rows}


@pytest.mark.parametrize("unit", ["clause", "line", "paragraph"])
def test_dedup_by_brute_force(docs, unit):
    rng = random.Random(6)
    sentence = lambda: prose(rng, rng.randint(1, 14)).capitalize() + rng.choice([". ", "! ", ", ", ".\n", "\n\n"])
    shared = ["".join(sentence() for _ in range(8)) for _ in range(4)]
    rows = [(i, "".join(rng.choice([sentence, sentence, lambda: rng.choice(shared)])() for _ in range(rng.randint(1, 12)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "Is it. " * 40), (103, "\n \n"), (104, shared[0].upper())]
    want = brute_dedup(rows, unit)
    got = substring.dedup(docs(*rows), unit=unit)
    assert got.columns == [*docs().columns, "dedup"]
    for r in got.collect():
        text, removed, n, gone = want[r.doc_id, dict(rows)[r.doc_id]]
        assert (r.text or "", [tuple(x) for x in r.dedup.removed], r.dedup.n_units, r.dedup.n_removed) == (text, removed, n, gone)
        assert (r.text is None) == (r.doc_id == 100)


def test_a_passage_inside_a_line_goes_and_the_rest_stays(docs):
    rng = random.Random(7)
    passage = ". ".join(prose(rng, 9) for _ in range(7))
    rows = [(i, f"{prose(rng, 30)} {passage}. {prose(rng, 30)}.") for i in range(5)]
    got = {r.doc_id: r for r in substring.dedup(docs(*rows)).collect()}
    assert got[0].text == rows[0][1] and got[0].dedup.n_removed == 0
    for i in range(1, 5):
        (span,) = got[i].dedup.removed
        kept = rows[i][1][:span.start] + rows[i][1][span.end + 1:]
        assert got[i].text == kept and len(passage) - (span.end - span.start) < 80
    again = substring.dedup(docs((None, rows[0][1]), (1, rows[0][1]), (1, rows[0][1]))).collect()
    assert sorted((r.doc_id is None, r.dedup.n_removed > 0) for r in again) == [(False, False), (False, False), (True, True)]
    assert substring.dedup(docs()).count() == 0


def test_whole_lines_go_whatever_their_words(docs):
    rng = random.Random(17)
    lines = ["And therhean is the is esndha.", "All rights reserved."]
    rows = [(i, f"{prose(rng, 20)}.\n{lines[i % 2]}\n{prose(rng, 20)}.\n{'And ornd.' if i < 14 else 'Me and.'}") for i in range(18)]
    rows.append((20, f"{prose(rng, 20)}\n  all   RIGHTS reserved."))
    for r in substring.dedup(docs(*rows)).collect():
        before = dict(rows)[r.doc_id].split("\n")
        if r.doc_id == 20:
            want = before[:1]
        elif r.doc_id < 14:      # held by 14 documents; the other short line only by 4
            want = [before[0], *([before[1]] if r.doc_id < 2 else []), before[2], *([before[3]] if r.doc_id == 0 else [])]
        else:
            want = [before[0], before[2], before[3]]
        assert r.text == "\n".join(want), r.doc_id
        assert (r.dedup.n_removed > 0) == (r.text != dict(rows)[r.doc_id])


def run_of(rng, n, script):
    """A run of n words without a mark."""
    if script == "spaced":
        return prose(rng, n)
    if script == "ideographs":
        return "".join(chr(rng.randint(0x4E00, 0x8FFF)) for _ in range(n))
    return " ".join("".join(chr(rng.randint(0x915, 0x939)) for _ in range(4)) for _ in range(n))


@pytest.mark.parametrize("script", ["spaced", "ideographs", "devanagari"])
@pytest.mark.parametrize("mark", ["", ". "])
def test_a_run_of_50_words_without_marks_goes(docs, script, mark):
    rng = random.Random(27)
    gap = "" if script == "ideographs" else " "
    run = run_of(rng, 25, script) + (mark or gap) + run_of(rng, 25, script)
    rows = [(i, f"{run_of(rng, 40, script)}{gap}{run}{gap}{run_of(rng, 40, script)}") for i in range(12)]
    got = {r.doc_id: r for r in substring.dedup(docs(*rows)).collect()}
    assert got[0].text == rows[0][1] and got[0].dedup.removed == []
    for i, text in rows[1:]:
        a = text.index(run)
        taken = [p for s, e in got[i].dedup.removed for p in range(s, e)]
        assert all(a <= p < a + len(run) for p in taken), "only shared words go"
        left = run[:min(taken) - a], run[max(taken) + 1 - a:]
        assert all(len(substring.word_spans(x)[2]) < substring.CHOICE for x in left)
        assert max(taken) + 1 - min(taken) == len(taken)


def test_short_clauses_at_the_end_of_a_passage_go(docs):
    rng = random.Random(37)
    passage = f"{prose(rng, 10)}. {prose(rng, 9)}. {prose(rng, 3)}."
    rows = [(i, f"{prose(rng, 9)}. {passage} {prose(rng, 9)}.") for i in range(3)]
    for r in substring.dedup(docs(*rows)).collect():
        text = dict(rows)[r.doc_id]
        assert r.text == (text if r.doc_id == 0 else text.replace(passage + " ", ""))


def test_passages_by_brute_force(docs):
    """What goes lies in runs of twelve words, or lines, that stand earlier; and of every shared run
    long enough at most eleven words at either end stay. Written without the module's own functions."""
    rng = random.Random(47)
    shared = [prose(rng, n) for n in (20, 30, 55, 70, 13)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(1, 5)):
            parts.append(rng.choice([lambda: prose(rng, rng.randint(1, 40)), lambda: rng.choice(shared), lambda: rng.choice(shared).upper().replace(" ", "  ")])())
            parts.append(rng.choice([" ", ". ", "\n", ", "]))
        rows.append((i, "".join(parts)))
    rows += [(70, "of " * 90), (71, None), (72, "")]
    earlier, lines, seen_in = set(), set(), {}
    for r in sorted(substring.dedup(docs(*rows)).collect(), key=lambda r: r.doc_id):
        text = dict(rows)[r.doc_id] or ""
        words = [(m.start(), m.end(), m.group().lower()) for m in re.finditer(r"\S+", text)]
        may, must, own = [False] * len(text), [], set()
        for k in range(len(words) - 11):
            run = tuple(w for _, _, w in words[k:k + 12])
            if run in earlier or run in own:
                may[words[k][0]:words[k + 11][1]] = [True] * (words[k + 11][1] - words[k][0])
                must.append(k)
            own.add(run)
        at = 0
        for line in text.split("\n"):
            key = " ".join(line.lower().split())
            if len(key) >= 12 and key in lines:
                may[at:at + len(line)] = [True] * len(line)
            lines.add(key)
            at += len(line) + 1
        earlier |= own
        taken = [False] * len(text)
        for a, b in r.dedup.removed:
            taken[a:b] = [True] * (b - a)
        assert all(may[p] or text[p].isspace() for p in range(len(text)) if taken[p]), "only repeats go"
        for k in must:      # eleven repeated runs before and after: the words in the middle go
            if all(x in must for x in range(k - 11, k + 12)):
                assert all(taken[words[k][0]:words[k][1]])
        kept = "".join(c for p, c in enumerate(text) if not taken[p])
        assert (r.text or "").split() == kept.split()


def test_long_texts_are_cut_in_one_go():
    text = " ".join(str(i % 7) for i in range(400_000))
    spans = [(i, i + 3) for i in range(0, len(text) - 8, 8)]
    start = time.process_time()
    cut, merged, n, gone = substring.cut_spans(text, spans, "passage")
    assert len(merged) == len(spans) and (n, gone) == (1, 1) and time.process_time() - start < 5


# --- contamination -------------------------------------------------------------------------

def test_search_by_brute_force(llm, docs):
    rng = random.Random(8)
    items = [(i, prose(rng, n)) for i, n in enumerate([4, 5, 6, 8, 12, 20, 30, 60])] + [(50, None), (51, " "), (None, "a b c d e f")]
    rows = []
    for i in range(120):
        t = prose(rng, rng.choice([3, 10, 50, 400, 3000]))
        if i % 2:
            item = changed(rng, rng.choice(items[:8])[1], rng.choice([0, 0, 1, 2]))
            t = f"{t} {item.upper()} {prose(rng, 40)}" if i % 4 == 1 else item
        rows.append((i, t))
    rows += [(200, None), (201, ""), (None, items[5][1]), (7, rows[7][1])]
    want = set()
    for j, item in items:
        t = jaccard.exact(item or "")
        for i, text in rows:
            if t and j is not None and i is not None and len(t & jaccard.exact(text or "")) >= 0.75 * len(t):
                want.add((i, j))
    table = llm.createDataFrame(items, "item_id long, text string")
    got = contamination.search(docs(*rows), table).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want) and len(want) > 30
    assert contamination.search(docs(), table).count() == 0
    assert contamination.search(docs(*rows), table.limit(0)).count() == 0


def test_search_runs_no_python(llm, docs):
    table = llm.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    plan = contamination.search(docs((1, "x a b c d e f g y")), table)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
