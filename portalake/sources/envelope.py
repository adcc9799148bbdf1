"""Response bodies -> pages: status, declared total and the vendor rows of each page.

Every body is decoded and parsed once, by Spark's own JSON and XML readers. A page keeps its
rows in one array column, so counting pages and rows later touches no text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portalake.functions import status as st
from portalake.functions.parsers import retry_after, whole_number
from portalake.functions.text import redact, strip
from portalake.schema import Table
from portalake.session import settle

RAW_ROW = T.MapType(T.StringType(), T.StringType())

# Columns of a capture that describe its page and stay with its rows.
LINEAGE = ["capture_id", "page", "captured_at", "params"]

_JSON_OPTIONS = {"allowSingleQuotes": "false", "mode": "PERMISSIVE"}
_XML_OPTIONS = {"ignoreSurroundingSpaces": "false", "excludeAttribute": "true",
                "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}

_HEADER = "header STRUCT<resultCode: STRING, resultMsg: STRING>"
_FAULT = "cmmMsgHeader STRUCT<errMsg: STRING, returnAuthMsg: STRING, returnReasonCode: STRING>"

# Text up to the next bare token, whole strings skipped over.
_OUTSIDE_STRINGS = r'\G((?:[^"STOP]++|"(?:[^"\\]++|\\.)*+")*+)'
_BARE_NUMBER = (_OUTSIDE_STRINGS.replace("STOP", r"0-9\-")
                + r"(-?[0-9]+(?:\.[0-9]+)?(?:[eE][+\-]?[0-9]+)?)")
# JSON literals and the text each stands for.
_LITERALS = {"true": "True", "false": "False", "NaN": "nan", "Infinity": "inf"}

_ROOT_TAG = (r"^\s*(?:<\?[^>]*\?>\s*|<!--[\s\S]*?-->\s*|<!DOCTYPE[^>\[]*>\s*)*"
             r"<([\w.:-]+)")


def quote_bare_values(body: Column) -> Column:
    """Put JSON numbers and literals in quotes. Spark's JSON reader re-renders bare numbers
    (``1.10`` -> ``1.1``); as strings they keep the vendor's digits."""
    worded = body
    for literal, text in _LITERALS.items():
        pattern = _OUTSIDE_STRINGS.replace("STOP", literal[0]) + f"({literal})"
        worded = F.regexp_replace(worded, pattern, f'$1"{text}"')
    # Literals are rare in vendor bodies: look before rewriting.
    body = F.when(body.rlike("|".join(_LITERALS)), worded).otherwise(body)
    return F.regexp_replace(body, _BARE_NUMBER, '$1"$2"')


def _in_array(text: Column) -> Column:
    # The reader accepts trailing junk after an object, not inside an array.
    return F.concat(F.lit("["), text, F.lit("]"))


def _json_schema(items: str) -> str:
    return (f"ARRAY<STRUCT<response: STRUCT<{_HEADER.replace(' ', ': ', 1)}, "
            f"body: STRUCT<items: {items}, totalCount: STRING>>, "
            f"OpenAPI_ServiceResponse: STRUCT<{_FAULT.replace(' ', ': ', 1)}>>>")


def _leaf(tag: str, content: str = "[^<]*") -> str:
    """Pattern of an element that holds no other element."""
    return rf"<{tag}(\s[^>]*)?(/>|>{content}</{tag}\s*>)"


_BARE_ROOT = "|".join(_leaf(root) + r"\s*$" for root in ("response", "OpenAPI_ServiceResponse"))


def parse_pages(captures: DataFrame, table: Table | None = None,
                secret: str | None = None) -> DataFrame:
    """One row per landed body.

    Without ``table`` a vendor row is a MAP of every token it carries, so unknown tokens
    survive and an absent token differs from an empty one. With ``table`` it is a STRUCT of
    the declared tokens only, which is cheaper to build and to read.

    Output: the lineage columns, ``service``, ``operation``, ``num_of_rows``, ``fingerprint``
    (a hash of the body, by which copies are told), ``status``
    (ok, no_data, auth, rate_limited, response_error, network, malformed), ``code``,
    ``message``, ``retry_after``, ``total``, ``n`` and ``items``.

    The steps are projections of their own, each naming the one before it by column: Spark
    then parses a body once, however many columns are taken from it.
    """
    row_type = (table.item_type if table else RAW_ROW).simpleString()
    df = _decode(captures)
    df = _read_json(df, row_type)
    df = _read_xml(df, row_type)
    df = _envelope(df, row_type, table)
    return _pages(df, secret)


def _decode(df: DataFrame) -> DataFrame:
    text = F.col("body").cast("string")
    http = st.http_status_class(F.col("http_status"))
    return (df.withColumn("_http", http)
            .withColumn("_text", F.when(F.col("_http").isNull() & F.is_valid_utf8(text),
                                        F.regexp_replace(text, "^\ufeff", ""))))


def _read_json(df: DataFrame, row_type: str) -> DataFrame:
    """``_json``: the envelope of a JSON body, NULL if it is none. ``_item``: the text of an
    items element that the typed reading could not take as a list of objects."""
    df = df.withColumn("_quoted", F.when(F.col("fmt") == "json", quote_bare_values(F.col("_text"))))
    df = df.withColumn("_parsed", F.from_json(
        _in_array(F.col("_quoted")), _json_schema(f"STRUCT<item: ARRAY<{row_type}>>"), _JSON_OPTIONS))
    df = df.withColumn("_json", F.when(F.size("_parsed") == 1, F.col("_parsed")[0]))
    response = F.col("_json")["response"]
    irregular = ((st.result_code(response["header"]["resultCode"]) == st.OK)
                 & response["body"]["items"]["item"].isNull())
    df = df.withColumn("_items", F.when(irregular, F.from_json(
        _in_array(F.col("_quoted")), _json_schema("STRING"), _JSON_OPTIONS)[0]["response"]["body"]["items"]))
    return df.withColumn("_item", F.when(
        F.col("_items").startswith("{"), F.from_json("_items", "item STRING", _JSON_OPTIONS)["item"]
    ).otherwise(F.col("_items")))


def _read_xml(df: DataFrame, row_type: str) -> DataFrame:
    """``_xml``: the envelope of an XML body, or of a JSON-mode body that is not JSON, since
    gateway faults arrive as XML."""
    return df.withColumn("_xml", F.from_xml(
        F.when(F.col("_json").isNull(), F.col("_text")),
        f"{_HEADER}, body STRUCT<items: STRUCT<item: ARRAY<{row_type}>>, totalCount: STRING>, "
        f"{_FAULT}, _bad STRING", _XML_OPTIONS))


def _json_rows(row_type: str) -> Column:
    """Rows of a JSON body; NULL where one of them is no object."""
    item, rows_type = F.col("_item"), f"ARRAY<{row_type}>"
    # A lone {} is no row, but a list may hold {}.
    irregular = (F.when(item.isNull() | (strip(item) == "") | (item == "{}"), F.array().cast(rows_type))
                 .when(item.startswith("{"), F.from_json(_in_array(item), rows_type, _JSON_OPTIONS))
                 .when(item.startswith("["), F.from_json(item, rows_type, _JSON_OPTIONS)))
    return F.coalesce(F.col("_json")["response"]["body"]["items"]["item"], irregular)


def _xml_rows(row_type: str, table: Table | None) -> Column:
    """Rows of an XML body; NULL where one of them is no object. The reader shows an element
    that holds only text as empty, so where one came out empty the text is looked at."""
    item, text = F.col("_xml")["body"]["items"]["item"], F.col("_text")

    def empty(row: Column) -> Column:
        return F.coalesce(*[row[t] for t in table.source_tokens]).isNull() if table else row.isNull()

    text_items = item.isNull() & text.rlike(r"<items(\s[^>]*)?>[^<]*[^<\s][^<]*</items\s*>")
    leaf_item = F.exists(item, empty) & text.rlike(_leaf("item"))
    blank_item = (F.size(item) == 1) & text.rlike(_leaf("item", r"\s*"))
    none = F.array().cast(f"ARRAY<{row_type}>")
    return (F.when(text_items, None).when(item.isNull(), none)
            .when(leaf_item, F.when(blank_item, none)).otherwise(item))


def _envelope(df: DataFrame, row_type: str, table: Table | None) -> DataFrame:
    """The same few columns from either format."""
    j, x, text = F.col("_json"), F.col("_xml"), F.col("_text")
    is_json = j.isNotNull()
    # The XML reader stops at the end of the root element; only comments may follow.
    whole_xml = x["_bad"].isNull() & F.substring_index(strip(text), "<", -1).rlike(
        r"^/?[\w.:-]+[^>]*>$|^[!?][^>]*>$")
    bare_root = (x["header"].isNull() & x["body"].isNull() & x["cmmMsgHeader"].isNull()
                 & text.rlike(_BARE_ROOT))
    root = F.regexp_extract(text, _ROOT_TAG, 1)
    xml_kind = (F.when(bare_root, None).when(root == "OpenAPI_ServiceResponse", "fault")
                .when(root == "response", "response"))
    json_kind = (F.when(j["OpenAPI_ServiceResponse"].isNotNull(), "fault")
                 .when(j["response"].isNotNull(), "response"))
    fault = F.coalesce(j["OpenAPI_ServiceResponse"]["cmmMsgHeader"], x["cmmMsgHeader"])
    header = F.coalesce(j["response"]["header"], x["header"])
    df = df.select(
        *LINEAGE, "service", "operation", "num_of_rows", "http_status", "retry_after",
        F.xxhash64("body").alias("fingerprint"), F.col("_http"), text.isNotNull().alias("_readable"),
        (is_json | F.coalesce(whole_xml, F.lit(False))).alias("_whole"),
        F.when(is_json, json_kind).when(whole_xml, xml_kind).alias("_kind"),
        fault.alias("_fault"), header.alias("_header"),
        F.when(is_json, j["response"]["body"]["totalCount"]).otherwise(x["body"]["totalCount"]).alias("_total"),
        F.when(is_json, _json_rows(row_type)).when(x.isNotNull(), _xml_rows(row_type, table)).alias("_rows"),
    )
    kind = F.col("_kind")
    return df.withColumn("_code", F.when(kind == "fault", F.col("_fault")["returnReasonCode"])
                         .when(kind == "response", F.col("_header")["resultCode"]))


def _pages(df: DataFrame, secret: str | None) -> DataFrame:
    kind, http, rows, code = F.col("_kind"), F.col("_http"), F.col("_rows"), F.col("_significant")
    bad_rows = rows.isNull() | F.exists(rows, lambda r: r.isNull())
    status = (F.when(http.isNotNull(), http)
              .when(kind == "fault", st.fault_class(code))
              .when((kind == "response") & (code == st.OK) & bad_rows, "malformed")
              .when(kind == "response", st.result_status(code))
              .otherwise("malformed"))
    df = df.withColumn("_significant", st.result_code(F.col("_code"))).withColumn("_status", status)

    status, fault = F.col("_status"), F.col("_fault")
    said = F.coalesce(F.nullif(fault["returnAuthMsg"], F.lit("")),
                      F.nullif(fault["errMsg"], F.lit("")), F.lit(""))
    fault_message = F.coalesce(F.nullif(redact(strip(said), secret), F.lit("")),
                               F.concat(F.lit("portal fault for "), F.col("operation")))
    reason = (F.when(~F.col("_readable"), "undecodable body")
              .when(~F.col("_whole"), "neither JSON nor XML")
              .when(kind == "response", "a row is not an object")
              .otherwise("unexpected response shape"))
    message = (F.when(http.isNotNull(), F.concat(F.lit("HTTP "), F.col("http_status")))
               .when(kind == "fault", fault_message)
               .when(status == "malformed", reason)
               .when(~status.isin("ok", "no_data"),
                     redact(strip(F.coalesce(F.col("_header")["resultMsg"], F.lit(""))), secret)))
    code = (F.when(http.isNotNull(), F.col("http_status").cast("string"))
            .when(kind.isNotNull(), F.coalesce(strip(F.col("_code")), F.lit("?"))))
    ok = status == "ok"
    page = F.struct(
        status.alias("status"), code.alias("code"), message.alias("message"),
        F.when(F.col("http_status") == 429, retry_after(F.col("retry_after"))).alias("retry_after"),
        F.when(ok, whole_number(F.col("_total"))).when(status == "no_data", 0).alias("total"),
        F.when(ok, F.size(rows)).otherwise(0).alias("n"),
        F.when(ok, rows).alias("items"))
    # Taken out of a one-element array: Spark does not move later filters on these columns
    # below a generator, where each would repeat the parsing above.
    df = df.withColumn("_page", page)
    return df.select(*LINEAGE, "service", "operation", "num_of_rows", "fingerprint", F.inline_outer(F.array("_page")))


def stage_pages(pages: DataFrame, path: str) -> DataFrame:
    """Write parsed pages and read them back. Auditing and reading rows each scan pages;
    staging makes them share one parse, and the audit then reads only narrow columns. Every
    call writes a folder of its own below ``path``, so several tables may share it."""
    return settle(pages, "pages", path)


def sift_rows(pages: DataFrame, test: Callable[[Column], Column]) -> DataFrame:
    """Pages that keep only the vendor rows that pass a test, with their places, as ``found`` in place
    of ``items``; ``n`` still counts all, for the audit."""
    placed = F.transform("items", lambda row, i: F.struct(i.alias("pos"), row.alias("raw")))
    return pages.withColumn("found", F.filter(placed, lambda x: test(x["raw"]))).drop("items")


def raw_rows(pages: DataFrame) -> DataFrame:
    """One row per vendor row, in page order by ``(capture_id, page, pos)``; a JSON null in a
    map row becomes empty text. Of pages that are ``audit.in_order`` each row also has its place in
    the whole fetch, from 0 (``ordinal``)."""
    more = ["rows_before"] if "rows_before" in pages.columns else []
    if "found" in pages.columns:
        rows = pages.select(*LINEAGE, "service", "operation", *more, F.inline("found"))
    else:
        rows = pages.select(*LINEAGE, "service", "operation", *more, F.posexplode("items").alias("pos", "raw"))
    if more:
        rows = rows.withColumn("ordinal", F.col("rows_before") + F.col("pos")).drop("rows_before")
    if isinstance(rows.schema["raw"].dataType, T.MapType):
        rows = rows.withColumn("raw", F.transform_values(
            "raw", lambda k, v: F.coalesce(v, F.lit(""))))
    return rows
