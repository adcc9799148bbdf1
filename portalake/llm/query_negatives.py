"""op11: hard negatives for every hundredth vector, against all."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import negatives
from .registry import query, table

SQL = """
with r as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                  [floor(256 * x::double) for x in embedding] as v
           from embeddings
           where vec_id is not null and label is not null and embedding is not null
             and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
s as (select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same, list_dot_product(a.v, b.v)::bigint as score
      from r a join r b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
p as (select anchor_id, other_id as positive_id, score as positive_score from s where same
      qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5)
select p.anchor_id, p.positive_id,
       (row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.other_id))::int as rank,
       s.other_id as negative_id, p.positive_score, s.score as negative_score
from p join s on s.anchor_id = p.anchor_id and not s.same
where 80 * p.positive_score <= 100 * s.score and s.score <= p.positive_score
qualify rank <= 5
"""


@query("op11_hard_negatives", SQL)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("int")
    return negatives.mine(given.select("vec_id", "embedding", label.alias("label")), F.col("id") % 100 == 0)
