import pytest
from pyspark.sql import functions as F

from portalake.functions import parsers
from portalake.functions.status import http_status_class, result_code, result_status
from portalake.functions.text import redact, strip

CASES = [
    ("date_ymd", "20230228", "2023-02-28"), ("date_ymd", "　 20240229\t", "2024-02-29"),
    ("date_ymd", "20230229", None), ("date_ymd", "2023-02-28", None), ("date_ymd", "00000101", None),
    ("date_ymd", "２０230228", None), ("date_ymd", "", None), ("date_ymd", None, None),
    ("date_ym", "202512", "2025-12"), ("date_ym", "2025.07", "2025-07"), ("date_ym", "2025년07월", "2025-07"),
    ("date_ym", "202513", None), ("date_ym", "000001", None), ("date_ym", "20257", None), ("date_ym", None, None),
    ("text", " 서울　", "서울"), ("text", "\x1fab\x1c", "ab"), ("text", "-", "-"), ("text", "7,000", "7,000"),
    ("text", "nan", None), ("text", " None ", None), ("text", " ", None), ("text", None, None),
    ("int", "42", 42), ("int", "-1,234,567", -1234567), ("int", "+9", 9), ("int", "9007199254740993", 9007199254740993),
    ("int", "9007199254740993.00", 9007199254740993), ("int", "77.", 77), ("int", ".0", 0), ("int", "2.5", None),
    ("int", "12E3", 12000), ("int", "1.5e1", 15), ("int", "1E999999999", None), ("int", "15e-1", None),
    ("int", "9223372036854775807", 2 ** 63 - 1), ("int", "9223372036854775808", None),
    ("int", "9223372036854775808e0", None), ("int", "-", None), ("int", "nan", None), ("int", "None", None),
    ("int", "NaN", None), ("int", "inf", None), ("int", "１２", None), ("int", "abc", None),
    ("int", "0x10", None), ("int", "1 2", None), ("int", "", None), ("int", None, None),
    ("ratio", "3.25", 3.25), ("ratio", "2,500.5", 2500.5), ("ratio", " .5 ", 0.5), ("ratio", "-1e-3", -0.001),
    ("ratio", "1.5d", None), ("ratio", "1.5f", None), ("ratio", "0x1p3", None), ("ratio", "Infinity", None),
    ("ratio", "1e400", None), ("ratio", "nan", None), ("ratio", "-", None), ("ratio", "x", None), ("ratio", None, None),
    ("decimal", "59.97", 59.97), ("decimal", "", None),
]


def test_kinds(spark):
    df = spark.createDataFrame([(i, k, raw) for i, (k, raw, _) in enumerate(CASES)], "i int, k string, raw string")
    for kind, parse in parsers.BY_KIND.items():
        got = {r.i: r.v for r in df.where(F.col("k") == kind).select("i", parse(F.col("raw")).alias("v")).collect()}
        for i, (k, raw, want) in enumerate(CASES):
            if k == kind:
                assert got[i] == want, (kind, raw)


def _one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(fn(F.col("c"))).first()[0]


@pytest.mark.parametrize("raw,want", [("120", 120), (" 0 ", 0), ("-1", None), ("Tue, 01 Jan", None), (None, None)])
def test_retry_after(spark, raw, want):
    assert _one(spark, raw, parsers.retry_after) == want


@pytest.mark.parametrize("parts,want", [
    (("2024", "3", "7"), "2024-03-07"), (("2024", " 11", "30 "), "2024-11-30"), (("2024", "003", "07"), "2024-03-07"),
    (("24", "3", "7"), None), (("0999", "3", "7"), None), (("2024", "13", "7"), None), (("2024", "2", "30"), None),
    (("2024", "", "7"), None), (("2024", None, "7"), None), (("2024", "x", "7"), None), (("2024", "123", "7"), None),
    (("2024", "-3", "7"), None)])
def test_deal_date(spark, parts, want):
    raw = F.create_map(*[c for t, v in zip(("dealYear", "dealMonth", "dealDay"), parts)
                         for c in (F.lit(t), F.lit(v).cast("string"))])
    assert spark.range(1).select(parsers.date_ymd(parsers.deal_date(raw))).first()[0] == want


@pytest.mark.parametrize("raw,code,status", [
    ("00", "0", "ok"), ("000", "0", "ok"), (" 0 ", "0", "ok"), ("003", "3", "no_data"), ("03", "3", "no_data"),
    ("30", "30", "auth"), ("020", "20", "auth"), ("31", "31", "auth"), ("22", "22", "rate_limited"),
    ("023", "23", "rate_limited"), ("99", "99", "response_error"), (None, "?", "response_error")])
def test_result_codes(spark, raw, code, status):
    assert _one(spark, raw, result_code) == code
    assert _one(spark, raw, lambda c: result_status(result_code(c))) == status


@pytest.mark.parametrize("http,want", [(200, None), (204, None), (None, None), (429, "rate_limited"), (401, "auth"),
                                       (403, "auth"), (301, "network"), (500, "network")])
def test_http_status(spark, http, want):
    assert _one(spark, http, http_status_class, "int") == want


def test_redact_all_spellings(spark):
    text = "a k+/= b k%2B%2F%3D c k%2B/%3D d"
    assert _one(spark, text, lambda c: redact(c, "k+/=")) == "a [REDACTED] b [REDACTED] c [REDACTED] d"
    assert _one(spark, text, lambda c: redact(c, None)) == text


def test_strip_matches_python(spark):
    for ch in map(chr, list(range(0x00, 0x21)) + [0x85, 0xa0, 0x1680, 0x2003, 0x2028, 0x202f, 0x205f, 0x3000, 0x200b]):
        assert _one(spark, ch + "x" + ch, strip) == (ch + "x" + ch).strip(), hex(ord(ch))


@pytest.mark.parametrize("raw", ["서울", "　서울　", "서울\u2003", "a\x85", "\xa0é", "é ", "\x00a", "a\x7f", "、x。", "\u2027x", " ", "", "😀 ", "~!"])
def test_strip_of_any_script(spark, raw):
    assert _one(spark, raw, strip) == raw.strip()


@pytest.mark.parametrize("parts,want", [
    (("+2024", "+03", "007"), "2024-03-07"), (("02024", "3", "7"), "2024-03-07"), (("2024\t", "\u30003", "7\n"), "2024-03-07"),
    ((" 2024", "12 ", " 31"), "2024-12-31"), (("2024", "2\x1c", "\x1d29"), "2024-02-29"), (("2024", "+3", "7"), None),
    (("2024|3", None, "7"), "2024-03-07"), (("2024", "1", "2\x00"), None), (("２０２４", "3", "7"), None),
    (("2024", "0", "7"), None), ((None, None, None), None)])
def test_deal_date_in_any_spelling(spark, parts, want):
    rows = spark.createDataFrame([({t: v for t, v in zip(("dealYear", "dealMonth", "dealDay"), parts) if v is not None},)], "raw map<string,string>")
    assert rows.select(parsers.date_ymd(parsers.deal_date(F.col("raw")))).first()[0] == want
