"""op7: benchmark items inside documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import contamination
from .registry import query, table

_WORDS = r"""[x for x in string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') if x <> '']"""
_SHINGLES = """case when len(w) >= 5 then [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)] when len(w) > 0 then [array_to_string(w, ' ')] else [] end"""
SQL = f"""
with d as (select distinct doc_id, unnest(s) as s from (select doc_id, {_SHINGLES} as s from (select doc_id, {_WORDS} as w from documents where text is not null))),
t as (select distinct item_id, unnest(s) as s from (select item_id, {_SHINGLES} as s from (select item_id, {_WORDS} as w from benchmark where text is not null))),
n as (select item_id, count(*) as n from t group by 1)
select d.doc_id, t.item_id, any_value(n.n)::int as n_item_shingles, count(*)::int as n_shared, count(*) / any_value(n.n)::double as containment
from d join t on d.s = t.s join n on n.item_id = t.item_id group by 1, 2 having count(*) / any_value(n.n)::double >= 0.75
"""


@query("op7_decontamination", SQL)
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
