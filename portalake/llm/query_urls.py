"""op9: every page against the list entries active on its day.

The tables hold neither fetch dates nor lists, so both are derived: a page's day from its id,
the list from the hosts of the pages, their domains and first path segments, dated by digest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import urls
from .registry import query, table


def derived_list(pages: DataFrame) -> DataFrame:
    """Entries from the data: about a third of hosts blocked for 60 days and released, a seventh
    of parent domains blocked, a fifth of hosts with an allowed path."""
    start = F.to_date(F.lit("2024-01-01"))
    seen = (pages.select(urls.host(F.col("url")).alias("h"), F.get(urls.path_parts(F.col("url")), F.lit(0)).alias("p"))
            .where(F.col("h").isNotNull()).distinct())
    n = F.conv(F.substring(F.md5(F.col("h").cast("binary")), 1, 4), 16, 10).cast("int")
    row = lambda when, pattern, action, day: F.when(when, F.struct(pattern.alias("pattern"), F.lit(action).alias("action"), F.date_add(start, day).alias("since")))
    parent = F.regexp_replace(F.col("h"), r"^[^.]*\.", "")
    made = F.array(row(n % 3 == 0, F.col("h"), "block", n % 200), row(n % 3 == 0, F.col("h"), "allow", n % 200 + 60),
                   row(n % 6 == 0, F.col("h"), "block", n % 200 + 150), row(n % 7 == 0, parent, "block", n % 300),
                   row((n % 5 == 0) & F.col("p").isNotNull(), F.concat(F.col("h"), F.lit("/"), F.col("p")), "allow", n % 100))
    return seen.select(F.explode(F.filter(made, lambda x: x.isNotNull())).alias("e")).select("e.*").distinct()


SQL = r"""
with captures as (
  select page_id, url, date '2024-01-01' + cast(page_id * 37 % 366 as integer) as day,
         nullif(lower(regexp_replace(regexp_replace(regexp_replace(
           regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#\\]*)', 1), '^.*@', ''), ':[0-9]*$', ''), '\.+$', '')), '') as h,
         [x for x in string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#\\]*([^?#]*)', 1), '/') if x <> ''] as parts
  from pages),
seen as (select distinct h, parts[1] as p, ('0x' || substr(md5(h), 1, 4))::int as n from captures where h is not null),
entries as (
  select h as pattern, 'block' as action, date '2024-01-01' + n % 200 as since from seen where n % 3 = 0
  union select h, 'allow', date '2024-01-01' + (n % 200 + 60) from seen where n % 3 = 0
  union select h, 'block', date '2024-01-01' + (n % 200 + 150) from seen where n % 6 = 0
  union select regexp_replace(h, '^[^.]*\.', ''), 'block', date '2024-01-01' + n % 300 from seen where n % 7 = 0
  union select h || '/' || p, 'allow', date '2024-01-01' + n % 100 from seen where n % 5 = 0 and p is not null),
dated as (select pattern, since, max(action) as action from entries group by 1, 2),
spans as (select *, lead(since) over (partition by pattern order by since) as until from dated),
tried as (
  select page_id, day, unnest(list_concat(
    [array_to_string(string_split(h, '.')[i:], '.') for i in range(1, len(string_split(h, '.')) + 1)],
    case when len(parts) > 0 then [h || '/' || parts[1]] else [] end)) as pattern
  from captures where h is not null),
best as (
  select page_id, arg_max(struct_pack(pattern := t.pattern, action := action, since := since),
                          (case when contains(t.pattern, '/') then 1 else 0 end) * 1000000 + length(t.pattern)) as m
  from tried t join spans s on t.pattern = s.pattern and day >= since and (until is null or day < until) group by 1)
select c.page_id, h as url_host, strftime(day, '%Y-%m-%d') as fetched, coalesce(m.action = 'block', false) as blocked, m.pattern as pattern, m.action as action,
       strftime(m.since, '%Y-%m-%d') as since
from captures c left join best b on c.page_id = b.page_id
"""


@query("op9_url_list", SQL)
def op9_url_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    day = F.date_add(F.to_date(F.lit("2024-01-01")), (F.col("page_id") * 37 % 366).cast("int"))
    found = urls.judge(pages.withColumn("fetched", day), derived_list(pages))
    return found.select(F.col("id").alias("page_id"), "url_host", F.col("fetched").cast("string").alias("fetched"),
                        "blocked", "pattern", "action", F.col("since").cast("string").alias("since"))
