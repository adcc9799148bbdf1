"""Whole tables as landed responses, page by page, some of them broken on purpose."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portalake.schema import Table

PAGE_ROWS, FETCH_ROWS = 20, 200     # ten full pages per fetch


def _sent(raw: Column) -> Column:
    return F.filter(F.map_entries(raw), lambda e: e["value"].isNotNull())


def json_item(raw: Column) -> Column:
    """A vendor row as a JSON object; values that look like numbers go in bare."""
    def render(k: Column, v: Column) -> Column:
        bare = v.rlike(r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$")
        # Escapes by way of a one-element array.
        quoted = F.regexp_replace(F.to_json(F.array(v)), r"^\[|\]$", "")
        return F.concat(F.lit('"'), k, F.lit('": '), F.when(bare, v).otherwise(quoted))

    pairs = F.transform(_sent(raw), lambda e: render(e["key"], e["value"]))
    return F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))


def xml_item(raw: Column) -> Column:
    """A vendor row as an XML item. XML cannot carry control characters."""
    def element(e: Column) -> Column:
        value = F.replace(F.replace(e["value"], F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
        value = F.regexp_replace(value, r"[\x00-\x08\x0b-\x1f]", "")
        return F.concat(F.lit("<"), e["key"], F.lit(">"), value, F.lit("</"), e["key"], F.lit(">"))

    parts = F.transform(_sent(raw), element)
    return F.concat(F.lit("<item>"), F.array_join(parts, ""), F.lit("</item>"))


def json_body(items: Column, total: Column, code: str | Column = "00") -> Column:
    head = F.concat(F.lit('{"response":{"header":{"resultCode":"'), F.lit(code),
                    F.lit('","resultMsg":"NORMAL"},"body":{"items":{"item":['))
    count = F.when(total.isNull(), "").otherwise(F.concat(F.lit(',"totalCount":'), total))
    return F.concat(head, F.array_join(items, ","), F.lit("]}"), count, F.lit("}}}"))


def xml_body(items: Column, total: Column, code: str | Column = "00") -> Column:
    head = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<response><header><resultCode>'),
                    F.lit(code), F.lit("</resultCode><resultMsg>NORMAL</resultMsg></header><body><items>"))
    count = F.when(total.isNull(), "").otherwise(
        F.concat(F.lit("<totalCount>"), total, F.lit("</totalCount>")))
    return F.concat(head, F.array_join(items, ""), F.lit("</items>"), count, F.lit("</body></response>"))


def fault_body(code: Column | str, err: Column | str, auth: Column | str) -> Column:
    return F.concat(F.lit("<OpenAPI_ServiceResponse><cmmMsgHeader><errMsg>"), F.lit(err),
                    F.lit("</errMsg><returnAuthMsg>"), F.lit(auth),
                    F.lit("</returnAuthMsg><returnReasonCode>"), F.lit(code),
                    F.lit("</returnReasonCode></cmmMsgHeader></OpenAPI_ServiceResponse>"))


def paged(rows: DataFrame, fmt: str) -> DataFrame:
    """Rows with a dense key ``k`` and ``raw`` as pages: fetch number ``f``, ``page``, items in
    order, and the rows the whole fetch has. A page holds at most PAGE_ROWS rows."""
    item = (json_item if fmt == "json" else xml_item)(F.col("raw"))
    placed = rows.select(F.expr(f"k div {FETCH_ROWS}").alias("f"),
                         F.expr(f"(k % {FETCH_ROWS}) div {PAGE_ROWS} + 1").cast("int").alias("page"),
                         F.col("k"), item.alias("item"))
    pages = placed.groupBy("f", "page").agg(F.sort_array(F.collect_list(F.struct("k", "item"))).alias("_i"))
    totals = placed.groupBy("f").agg(F.count(F.lit(1)).alias("total"))
    return pages.join(totals, "f").select(
        "f", "page", "total", F.transform("_i", lambda i: i["item"]).alias("items"))


def capture_columns(table: Table, body: Column, **override: Column) -> list[Column]:
    columns = {
        "capture_id": F.concat(F.lit("fetch-"), F.col("f")),
        "service": F.lit(table.service), "operation": F.lit(table.operation),
        "fmt": F.lit(table.fmt), "page": F.col("page"), "num_of_rows": F.lit(PAGE_ROWS),
        "params": F.create_map(F.lit("pageNo"), F.col("page").cast("string")),
        "captured_at": F.timestamp_seconds(F.lit(1_700_000_000) + F.col("f")),
        "http_status": F.lit(200), "retry_after": F.lit(None).cast("string"),
        "body": F.encode(body, "UTF-8"),
    }
    columns.update(override)
    return [c.alias(name) for name, c in columns.items()]


def intact(rows: DataFrame, table: Table, **override: Column) -> DataFrame:
    """Vendor rows with a dense key as whole captures of ``table``."""
    pages = paged(rows, table.fmt)
    body = (json_body if table.fmt == "json" else xml_body)(F.col("items"), F.col("total").cast("string"))
    return pages.select(*capture_columns(table, body, **override))


def broken(rows: DataFrame, table: Table) -> DataFrame:
    """As :func:`intact`, with one defect per fetch number:

    1 no totals and a page size above the rows of a page; 2 a page number skipped; 3 a traffic
    fault on page 2; 4 a total one too low; 5 an empty page 3; 6 page 1 says no data; 7 HTTP
    503 on page 2; 8 page 2 cut off; 9 page 1 landed twice, in every second such fetch with
    other bytes; 0 none.
    """
    pages = paged(rows, table.fmt)
    kind, page = F.col("f") % 10, F.col("page")
    number = F.when((kind == 2) & (page >= 3), page + 1).otherwise(page)
    copies = F.when((kind == 9) & (page == 1), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    total = (F.when(kind == 1, None).when(kind == 4, F.col("total") - 1).otherwise(F.col("total")))
    items = F.when((kind == 5) & (page == 3), F.array().cast("array<string>")).otherwise(F.col("items"))
    code = F.when((kind == 6) & (page == 1), "03").otherwise("00")
    make = json_body if table.fmt == "json" else xml_body
    whole = make(items, total.cast("string"), code)
    on_second = page == 2
    body = (F.when((kind == 3) & on_second, fault_body("22", "SERVICE ERROR", "TRAFFIC EXCEEDED"))
            .when((kind == 8) & on_second, F.substring(whole, 1, 60)).otherwise(whole))
    status = F.when((kind == 7) & on_second, 503).otherwise(200)
    size = F.when(kind == 1, PAGE_ROWS + 1).otherwise(PAGE_ROWS)
    other = F.when((F.col("f") % 20 == 19) & (F.col("copy") == 2), F.concat(body, F.lit("\n"))).otherwise(body)
    return (pages.withColumn("copy", F.explode(copies))
            .select(*capture_columns(table, other, page=number, num_of_rows=size, http_status=status)))


# The audit of broken captures from the tidy keys: facts per page, then the paging rules.
BROKEN_PAGES_SQL = f"""
  facts as (
    select f, f % 10 as kind, p, count(*) as n, any_value(total) as total
    from (select o_orderkey // {FETCH_ROWS} as f, (o_orderkey % {FETCH_ROWS}) // {PAGE_ROWS} + 1 as p,
                 count(*) over (partition by o_orderkey // {FETCH_ROWS}) as total
          from orders) as k
    group by f, p),
  landed as (
    select f, kind,
      case when kind = 2 and p >= 3 then p + 1 else p end as page,
      case when f % 20 = 19 and p = 1 then 2 else 1 end as copies,
      case when (kind = 5 and p = 3) or (kind = 6 and p = 1)
             or (kind in (3, 7, 8) and p = 2) then 0 else n end as n,
      case when kind in (3, 7, 8) and p = 2 then null when kind = 6 and p = 1 then 0
           when kind = 1 then null when kind = 4 then total - 1 else total end as total,
      case when kind = 3 and p = 2 then 'rate_limited' when kind = 7 and p = 2 then 'network'
           when kind = 8 and p = 2 then 'malformed' end as failure,
      case when kind = 1 then {PAGE_ROWS + 1} else {PAGE_ROWS} end as size
    from facts),
  summed as (
    select *, sum(n) over w as seen, row_number() over w as nth
    from landed window w as (partition by f order by page)),
  judged as (
    select *, case
      when nth <> page then 'incomplete'
      when copies > 1 then 'repeated'
      when failure is not null then failure
      when seen > total then 'duplicated'
      when seen = total then 'complete'
      when total is not null and n = 0 then 'truncated'
      when total is null and n < size then 'complete' end as outcome
    from summed),
  ended as (
    select f, min(case when outcome is not null then page end) as last_page from judged group by f),
  audit as (
    select 'fetch-' || j.f as capture_id, j.f as f,
      coalesce(any_value(case when j.page = e.last_page then j.outcome end), 'incomplete') as status,
      cast(coalesce(any_value(case when j.page = e.last_page then j.seen end), sum(j.n)) as bigint) as "rows",
      cast(any_value(case when j.page = e.last_page then j.total end) as bigint) as total,
      cast(coalesce(any_value(e.last_page), max(j.page)) as int) as last_page
    from judged j join ended e on j.f = e.f group by j.f)
"""
