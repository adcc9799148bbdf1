from pyspark.sql import functions as F

from portalake import CAPTURE_SCHEMA, parse_pages, raw_rows, table
from portalake.plans.datasets import generic_rows


def _json(items, total=',"totalCount":9', code='"00"'):
    return '{"response":{"header":{"resultCode":%s,"resultMsg":"M"},"body":{%s%s}}}' % (code, items, total)


def _xml(items, total="<totalCount>9</totalCount>", code="00"):
    return (f"<response><header><resultCode>{code}</resultCode><resultMsg>M</resultMsg></header>"
            f"<body>{items}{total}</body></response>")


FAULT = ("<OpenAPI_ServiceResponse><cmmMsgHeader><errMsg>E</errMsg><returnAuthMsg>{}</returnAuthMsg>"
         "<returnReasonCode>30</returnReasonCode></cmmMsgHeader></OpenAPI_ServiceResponse>")

# name: (format, body, status, rows)
BODIES = {
    "json list": ("json", _json('"items":{"item":[{"a":1},{"a":2}]}'), "ok", 2),
    "json single": ("json", _json('"items":{"item":{"a":1}}'), "ok", 1),
    "json bare list": ("json", _json('"items":[{"a":1}]'), "ok", 1),
    "json blank": ("json", _json('"items":" \\n"'), "ok", 0),
    "json empty object": ("json", _json('"items":{}'), "ok", 0),
    "json lone empty item": ("json", _json('"items":{"item":{}}'), "ok", 0),
    "json listed empty item": ("json", _json('"items":{"item":[{}]}'), "ok", 1),
    "json absent": ("json", _json('"q":1'), "ok", 0),
    "json null": ("json", _json('"items":null'), "ok", 0),
    "json non-object row": ("json", _json('"items":{"item":[{"a":1},"x"]}'), "malformed", 0),
    "json text item": ("json", _json('"items":{"item":"x"}'), "malformed", 0),
    "json no data": ("json", _json('"items":""', code='"003"'), "no_data", 0),
    "json numeric code": ("json", _json('"items":""', code="0"), "ok", 0),
    "json error": ("json", _json('"items":""', code='"12"'), "response_error", 0),
    "json no header": ("json", '{"response":{}}', "response_error", 0),
    "json no response": ("json", '{"a":{}}', "malformed", 0),
    "json array": ("json", "[]", "malformed", 0),
    "json trailing junk": ("json", _json('"items":""') + "x", "malformed", 0),
    "json two objects": ("json", _json('"items":""') + "," + _json('"items":""'), "malformed", 0),
    "json cut off": ("json", _json('"items":""')[:40], "malformed", 0),
    "json bom": ("json", "﻿" + _json('"items":{"item":[{"a":1}]}'), "ok", 1),
    "json xml fault": ("json", FAULT.format("A"), "auth", 0),
    "json html": ("json", "<html><p>busy", "malformed", 0),
    "xml list": ("xml", _xml("<items><item><a>1</a></item><item><a>2</a></item></items>"), "ok", 2),
    "xml single": ("xml", _xml("<items><item><a>1</a></item></items>"), "ok", 1),
    "xml prolog": ("xml", '<?xml version="1.0"?><!-- c -->' + _xml("<items><item><a>1</a></item></items>"), "ok", 1),
    "xml blank": ("xml", _xml("<items>\n </items>"), "ok", 0),
    "xml empty": ("xml", _xml("<items/>"), "ok", 0),
    "xml absent": ("xml", _xml(""), "ok", 0),
    "xml empty item": ("xml", _xml("<items><item/></items>"), "ok", 0),
    "xml text item": ("xml", _xml("<items><item>x</item></items>"), "malformed", 0),
    "xml text items": ("xml", _xml("<items>x</items>"), "malformed", 0),
    "xml one empty of two": ("xml", _xml("<items><item><a>1</a></item><item/></items>"), "malformed", 0),
    "xml other root": ("xml", "<html><body>1</body></html>", "malformed", 0),
    "xml text root": ("xml", "<response>1</response>", "malformed", 0),
    "xml cut off": ("xml", _xml("<items/>")[:50], "malformed", 0),
    "xml trailing junk": ("xml", _xml("<items/>") + "x", "malformed", 0),
    "xml fault": ("xml", FAULT.format("A"), "auth", 0),
    "xml no data": ("xml", _xml("", code="03"), "no_data", 0),
}


def _captures(spark, bodies, **more):
    rows = []
    for name, spec in bodies.items():
        fmt, body = spec[0], spec[1]
        data = body if isinstance(body, bytes) else body.encode()
        row = {"capture_id": name, "service": "s", "operation": "op", "fmt": fmt, "page": 1, "num_of_rows": 10,
               "params": {}, "captured_at": None, "http_status": 200, "retry_after": None, "body": data, **more}
        rows.append(tuple(row[f.name] for f in CAPTURE_SCHEMA))
    return spark.createDataFrame(rows, CAPTURE_SCHEMA).coalesce(2)


def test_shapes(spark):
    got = {r.capture_id: (r.status, r.n) for r in parse_pages(_captures(spark, BODIES)).collect()}
    assert got == {name: (status, n) for name, (_, _, status, n) in BODIES.items()}


def test_shapes_with_declared_tokens_only(spark):
    t = table("holidays.holidays")
    bodies = {k: (f, b.replace('"a"', '"seq"').replace("<a>", "<seq>").replace("</a>", "</seq>"), s, n)
              for k, (f, b, s, n) in BODIES.items()}
    got = {r.capture_id: (r.status, r.n) for r in parse_pages(_captures(spark, bodies), t).collect()}
    assert got == {name: (status, n) for name, (_, _, status, n) in bodies.items()}


def test_undecodable(spark):
    pages = parse_pages(_captures(spark, {"a": ("json", b"\xff\xfe"), "b": ("xml", b"\xff\xfe")})).collect()
    assert {(r.status, r.message) for r in pages} == {("malformed", "undecodable body")}


def test_numbers_keep_their_digits(spark):
    body = _json('"items":{"item":[{"a":1.10,"b":-0,"c":1E400,"d":9007199254740993.0,"e":"5 \\"6 7","f":true,"g":null}]}')
    row = raw_rows(parse_pages(_captures(spark, {"x": ("json", body)}))).first()
    assert row.raw == {"a": "1.10", "b": "-0", "c": "1E400", "d": "9007199254740993.0", "e": '5 "6 7',
                       "f": "True", "g": ""}


def test_long_text_only_body(spark):
    items = ",".join('{"a":"text %d \\\\ \\" more","b":"-"}' % i for i in range(20000))
    page = parse_pages(_captures(spark, {"x": ("json", _json('"items":{"item":[%s]}' % items))})).first()
    assert page.n == 20000


def test_totals(spark):
    bodies = {t or "none": ("xml", _xml("", total=f"<totalCount>{t}</totalCount>" if t is not None else ""))
              for t in ("12", " 7 ", "x", "1.0", None)}
    got = {r.capture_id: r.total for r in parse_pages(_captures(spark, bodies)).collect()}
    assert got == {"12": 12, " 7 ": 7, "x": None, "1.0": None, "none": None}


def test_messages_are_redacted(spark):
    pages = parse_pages(_captures(spark, {"f": ("xml", FAULT.format("bad key s3cr/et"))}), secret="s3cr/et")
    assert pages.first().message == "bad key [REDACTED]"
    blank = parse_pages(_captures(spark, {"f": ("xml", FAULT.format("  "))})).first()
    assert blank.message == "portal fault for op"


def test_http_failure_wins_over_body(spark):
    page = parse_pages(_captures(spark, {"x": BODIES["json list"]}, http_status=429, retry_after=" 60 ")).first()
    assert (page.status, page.code, page.retry_after, page.n, page["items"]) == ("rate_limited", "429", 60, 0, None)


def test_generic_service(spark):
    body = _json('"items":{"item":[{"z":"1"},{"y":"2"}]}', total="")
    rows = generic_rows(_captures(spark, {"x": ("json", body)}), "s", "op").orderBy("pos").collect()
    assert [r.raw for r in rows] == [{"z": "1"}, {"y": "2"}]


def test_filters_do_not_repeat_the_parse(spark):
    pages = parse_pages(_captures(spark, {"x": BODIES["json list"]})).where(F.col("status") == "ok")
    plan = raw_rows(pages)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml") + plan.count("xmltostructs") <= 1, plan
