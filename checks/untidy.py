"""Tidy columns -> untidy vendor text, and the SQL of what must come out again.

A source names SQL expressions that mean the same in Spark and in the checking engine. Field
number j of a row with key k gets one of ten spellings, picked by ``pick(k, j)``; which
spellings are usable is written down once per kind and used by the SQL only.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field as dc_field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portalake.schema import Field, Table


@dataclass(frozen=True)
class Source:
    table: str
    key: str
    date: str
    ints: tuple[str, ...]
    decimals: tuple[str, ...]
    texts: tuple[str, ...]
    # Values that pass 64 bits where keys are large, as Spark computes them whatever the size.
    wide: Mapping[str, str] = dc_field(default_factory=dict)

    def value(self, kind: str, j: int) -> str:
        """SQL of the tidy value of field number ``j``."""
        pool = {"int": self.ints, "ratio": self.decimals, "decimal": self.decimals,
                "text": self.texts, "date_ymd": (self.date,), "date_ym": (self.date,)}[kind]
        return pool[j % len(pool)]

    def sent(self, kind: str, j: int) -> Column:
        """The same value for Spark to spell; a whole number past 64 bits is spelled in full."""
        value = self.value(kind, j)
        return F.expr(self.wide.get(value, value))


ORDERS = Source(
    "orders", "o_orderkey", "o_orderdate",
    ints=("o_custkey", "cast(round(o_totalprice * 100) as bigint)", "o_orderkey * 1000000007 * 1009",
          "o_orderkey - o_custkey"),
    decimals=("o_totalprice", "round(o_totalprice)"),
    texts=("o_orderpriority", "o_orderstatus", "concat('Customer ', cast(o_custkey as string))",
           "concat('접수 ', o_orderpriority)"),
    wide={"o_orderkey * 1000000007 * 1009": "cast(o_orderkey as decimal(20)) * 1000000007 * 1009"},
)
LINEITEM = Source(
    "lineitem", "(l_orderkey * 7 + l_linenumber)", "l_shipdate",
    ints=("l_partkey", "l_suppkey", "cast(round(l_extendedprice * 100) as bigint)",
          "cast(l_quantity as bigint)", "l_orderkey * 1000000007 * 1009", "l_suppkey - l_partkey"),
    decimals=("l_discount", "l_extendedprice", "l_tax", "l_quantity"),
    texts=("l_returnflag", "l_linestatus", "concat('Part#', cast(l_partkey as string))",
           "concat('품목 ', cast(l_suppkey as string))"),
    wide={"l_orderkey * 1000000007 * 1009": "cast(l_orderkey as decimal(20)) * 1000000007 * 1009"},
)

# The spellings 0..9 of a kind that carry a value.
USABLE = {"int": (0, 1, 2, 3, 7), "ratio": (0, 1, 2, 6, 7), "decimal": (0, 1, 2, 6, 7),
          "text": (0, 1, 2, 3, 8, 9), "date_ymd": (0, 1, 2, 3, 4, 5, 6),
          "date_ym": (0, 1, 2, 3, 4, 5, 6)}


def pick(key: str, j: int) -> str:
    """SQL of the spelling number; fields of one row vary independently."""
    return f"((cast(floor({key} / {3 ** (j % 6)}) as bigint) + {j}) % 10)"


def spell(value: Column, kind: str, n: Column) -> Column:
    """The untidy text of a value; NULL stands for a token that is not sent."""
    if kind.startswith("date"):
        def in_form(form: str) -> Column:
            return F.date_format(value, form)
        if kind == "date_ymd":
            return (F.when(n <= 5, in_form("yyyyMMdd"))
                    .when(n == 6, F.concat(F.lit("\t"), in_form("yyyyMMdd"), F.lit("　 ")))
                    .when(n == 7, F.concat(in_form("yyyy"), F.lit("0230")))
                    .when(n == 8, in_form("yyyy-MM-dd")).otherwise(""))
        return (F.when(n <= 3, in_form("yyyyMM")).when(n <= 5, in_form("yyyy.MM"))
                .when(n == 6, F.concat(F.lit(" "), in_form("yyyy-MM")))
                .when(n == 7, in_form("yyyy")).when(n == 8, F.concat(in_form("yyyy"), F.lit("13")))
                .otherwise("-"))
    plain = value.cast("string")
    if kind == "text":
        return (F.when(n <= 2, plain).when(n == 3, F.concat(F.lit("　\t"), plain, F.lit(" \x1c")))
                .when(n == 4, "").when(n == 5, "nan").when(n == 6, "None").when(n == 7, None)
                .when(n == 8, "-").otherwise("1,234"))
    if kind == "int":
        return (F.when(n == 0, plain).when(n == 1, F.format_number(value, 0))
                .when(n == 2, F.concat(plain, F.lit(".0"))).when(n == 3, F.concat(F.lit("　"), plain, F.lit("\n")))
                .when(n == 4, "-").when(n == 5, "").when(n == 6, None)
                .when(n == 7, F.concat(plain, F.lit(".")))
                .when(n == 8, F.concat(plain, F.lit(".8"))).otherwise("1E999999999"))
    return (F.when(n == 0, plain).when(n == 1, F.concat(F.lit(" "), plain, F.lit("　")))
            .when(n == 2, F.concat(F.lit("+"), plain)).when(n == 3, "-").when(n == 4, "")
            .when(n == 5, None).when(n == 6, F.format_number(value, 2)).when(n == 7, plain)
            .when(n == 8, "1e400").otherwise("abc"))


def expected(value: str, kind: str, n: str) -> str:
    """SQL of the tidy result of that spelling."""
    usable = f"{n} in {USABLE[kind]}"
    if kind == "date_ymd":
        return f"case when {usable} then strftime({value}, '%Y-%m-%d') end"
    if kind == "date_ym":
        return f"case when {usable} then strftime({value}, '%Y-%m') end"
    if kind == "text":
        return f"case when {n} = 8 then '-' when {n} = 9 then '1,234' when {usable} then {value} end"
    if kind == "int":
        # A fraction is no whole number, unless the value is so large that the nearest double is.
        near = f"cast(cast({value} as varchar) || '.8' as double)"
        return (f"case when {usable} then cast({value} as bigint) "
                f"when {n} = 8 and {near} = floor({near}) then cast({near} as bigint) end")
    return f"case when {usable} then cast({value} as double) end"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokens(table: Table, source: Source) -> list[Column]:
    out: list[Column] = [F.lit("unknownToken"), F.lit("x")]
    for j, f in enumerate(table.fields):
        value = source.sent(f.kind, j)
        n = F.expr(pick(source.key, j))
        if f.token == "dealDate":
            # Sent in three parts; the unusable spellings lose or spoil one of them.
            out += [F.lit("dealYear"), F.when(n <= 7, F.date_format(value, "yyyy")).otherwise("24"),
                    F.lit("dealMonth"), F.when(n != 7, F.concat(F.lit(" "), F.date_format(value, "M"))),
                    F.lit("dealDay"), F.date_format(value, "d")]
        else:
            out += [F.lit(f.token), spell(value, f.kind, n)]
    return out


def vendor_rows(spark: SparkSession, sf_dir: str, table: Table, source: Source) -> DataFrame:
    """The whole source table as vendor rows (``raw`` MAP) of ``table``."""
    # A NULL value reads like a token that was not sent.
    raw = F.create_map(*_tokens(table, source))
    # Vendor rows come out of a page's array; so do these.
    rows = read(spark, sf_dir, source.table).select(F.expr(source.key).alias("k"), raw.alias("raw"))
    return rows.select("k", F.explode(F.array("raw")).alias("raw"))


def _sql_columns(table: Table, source: Source) -> str:
    cols = []
    for j, f in enumerate(table.fields):
        value, n = source.value(f.kind, j), pick(source.key, j)
        cols.append(f"{expected(value, f.kind, n)} as {_q(f.column)}")
    return ", ".join(cols)


def _q(name: str) -> str:
    return f'"{name}"'


def project_sql(table: Table, source: Source) -> str:
    """SQL of every row of :func:`vendor_rows`, typed."""
    return f"select {_sql_columns(table, source)} from {source.table}"


def clean_sql(table: Table, source: Source, where: str = "true") -> str:
    """SQL of the clean rows of :func:`vendor_rows`."""
    needed = " and ".join([f"{_q(c)} is not null" for c in table.required_columns] + [where])
    return (f"select * from (select {_sql_columns(table, source)} from {source.table}) as t "
            f"where {needed}")


def rejects_sql(table: Table, source: Source) -> str:
    """SQL of the rows left out, with the first column they lack."""
    first = " ".join(f"when {_q(c)} is null then '{c}'" for c in table.required_columns)
    return (f"select *, 'missing' as reason from (select *, case {first} end as missing from "
            f"(select {_sql_columns(table, source)} from {source.table}) as t) as u "
            f"where missing is not null")


def field_query(field: Field, source: Source, j: int):
    """One kind's parser over a whole column: Spark query and its SQL."""
    from portalake.functions.parsers import BY_KIND

    value, n = source.value(field.kind, j), pick(source.key, j)

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        text = spell(source.sent(field.kind, j), field.kind, F.expr(n))
        rows = read(spark, sf_dir, source.table).select(F.expr(source.key).alias("k"), text.alias("t"))
        return rows.select("k", BY_KIND[field.kind](F.col("t")).alias("v"))

    return query, f"select {source.key} as k, {expected(value, field.kind, n)} as v from {source.table}"
