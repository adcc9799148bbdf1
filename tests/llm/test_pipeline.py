import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from portalake import session
from portalake.llm import jaccard, langid

SF = "/root/testdata/sf0.001"


def test_stages():
    assert [n for n, _ in C.STAGES] == ["language", "near_copies", "passages", "benchmark", "encoding"] and C.ORACLE_SQL is None


def test_odd_rows_through_all_stages(llm, docs, tmp_path):
    prose = "A first sentence that nobody has written before today. A second one follows it closely, as it should. And then a third."
    item = "seven words of a test item here and then some more to make it long"
    rows = [(1, prose), (2, prose), (3, "Other words entirely stand here before the rest, so that these two texts differ by a lot of words: " + prose.upper()), (4, None), (5, ""), (6, "123 !!"), (None, prose), (7, "x " + item + " y"),
            (8, "Something short."), (9, "word " * 20_000)]
    llm.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, make in (("rows", docs(*rows)), ("none", docs())):
        df = make
        for stage, f in C.STAGES:
            out = f(llm, df, str(tmp_path))
            if stage != "encoding":
                assert out.columns == df.columns
            path = f"{tmp_path}/{name}-{stage}"
            out.write.parquet(path)
            df = llm.read.parquet(path)
        assert sorted(r.doc_id for r in df.collect()) == ([1, 3, 8, 9] if name == "rows" else [])


def test_rows_without_labels_or_counts_and_repeated_ids(llm, docs, tmp_path):
    """No label learned: all that have a letter stay. A column n_chars is not needed. Rows alike in id
    and text are one."""
    prose = ["A first sentence that nobody has written before today.", "Quite another one, on other things, of about that length."]
    rows = [(1, prose[0]), (1, prose[0]), (1, prose[1]), (2, prose[0]), (3, None), (4, "12 34"), (None, prose[0])]
    df = docs(*rows).drop("n_chars").withColumn("lang", F.lit(None).cast("string"))
    llm.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    told = C.language(llm, df, str(tmp_path))
    assert sorted(r.doc_id for r in told.collect()) == [1, 1, 1, 2]
    apart = C.near_copies(llm, told, str(tmp_path))
    assert sorted((r.doc_id, r.text) for r in apart.collect()) == sorted([(1, prose[0]), (1, prose[1])])
    cut = C.passages(llm, apart, str(tmp_path))
    assert "n_chars" not in cut.columns and C.benchmark(llm, cut, str(tmp_path)).count() == 2
    assert [r.round_trip for r in C.encoding(llm, cut, str(tmp_path)).collect()] == [True, True]


def test_documents_in_any_number_of_languages_stay(llm, docs, tmp_path):
    """Rare languages are learned beside two hundred others, so that their documents are not taken for noise."""
    many = [(2 * i + k, f"{chr(97 + i % 20)}{chr(98 + i // 20)}{chr(97 + i % 7)} " * 5, f"m{i:03}") for i in range(200) for k in range(2)]
    rare = [(1000 + i, f"{chr(0x4e00 + 301 * i)}{chr(0x5e00 + 307 * i)} " * 5, f"r{i}") for i in range(10)]
    df = docs(*many, *rare)
    assert len(langid.fit(df.select("doc_id", "text", "lang")).langs) == 210
    assert sorted(r.doc_id for r in C.language(llm, df, str(tmp_path)).collect()) == sorted(r[0] for r in many + rare)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not here")
def test_run(llm, tmp_path):
    docs = llm.read.parquet(SF + "/documents.parquet")
    told = C.language(llm, docs, SF)
    apart = C.near_copies(llm, told, SF)
    rows = {r.doc_id: r.text for r in told.collect()}
    sets = {i: jaccard.exact(t) for i, t in rows.items()}
    kept = {r.doc_id for r in apart.collect()}
    for i in rows:       # none of those that stay link, and each that went links with one before it
        near = [j for j in rows if j < i and jaccard.linked(sets[i], sets[j])]
        assert (i in kept and not [j for j in near if j in kept]) or (i not in kept and near)
    def stored():
        folder = session.shared_folder(llm).split(":", 1)[-1]
        return set(os.listdir(folder)) if os.path.isdir(folder) else set()

    held = stored()
    out = C.run(llm, SF)
    assert stored() - held == session.read_folders(out), "only what the result reads is left"
    assert out.columns == ["doc_id", "ids", "n_tokens", "round_trip"]
    got = out.collect()
    assert got and all(r.round_trip and r.n_tokens == len(r.ids) for r in got) and {r.doc_id for r in got} <= kept
