from __future__ import annotations

import json
from email.utils import parsedate_to_datetime
from urllib.parse import urlsplit

import pytest
from pyspark.sql import functions as F

from lakegate.functions import declared, redact, rules, urls
from lakegate.operators import capability, catalog, reports, sync
from lakegate.operators.violations import violations


def values(spark, texts, build):
    """Apply a column function to texts, in order."""
    df = spark.createDataFrame(list(enumerate(texts)), "i int, v string")
    return [r[0] for r in df.orderBy("i").select(build(F.col("v"))).collect()]


def test_urls_for_display(spark):
    cases = {
        "no/scheme?token=x": "no/scheme?token=x",
        "https://Joe:pw@Host.Example.COM:8443/a?X-API-Key=1&b=2#f": "https://host.example.com:8443/a?X-API-Key=***&b=2#f",
        "https://[2001:DB8::1]/x?password=": "https://[2001:db8::1]/x?password=***",
        "https://h/a?q=a%20b&q=%7E*": "https://h/a?q=a+b&q=~*",
        "https://h:99999/a": "https://h/a",
        "file:///tmp/x": "file:///tmp/x",
        "https://[broken/x?token=1": "https://[broken/x?token=1",
    }
    assert values(spark, cases, urls.sanitize_uri) == list(cases.values())


def test_url_parts_agree_with_the_standard_library(spark):
    texts = [
        "https://u:p@Host:443/a/b;c?x=1&y#f?g",
        "s3://Bucket/key with blank",
        "mailto:someone@example.org",
        "//host/path",
        "/only/path?q",
        "HTTP://H",
        "a:b:c",
        "?q#f",
    ]
    got = values(spark, texts, lambda v: F.to_json(urls.url_struct(v)))
    for text, found in zip(texts, map(json.loads, got), strict=True):
        want = urlsplit(text)
        assert (found["scheme"], found["netloc"], found["path"], found["query"], found["fragment"]) == tuple(want)
        assert (found["host"] or None) == want.hostname and found.get("port") == want.port


def test_origins(spark):
    cases = {
        "https://H:443/x": "https://h",
        "data.example.org": "https://data.example.org",
        "https://h:8443": "https://h:8443",
        "http://h": None,
        "https://me@h": None,
        "https://h:x": None,
    }
    assert values(spark, cases, urls.url_origin) == list(cases.values())


def test_text_redaction(spark):
    cases = {
        "go to ftp://joe:secret@host now": "go to ftp://joe:***@host now",
        "x?my_api_key_2=abc&y=1": "x?my_api_key_2=***&y=1",
        "Bearer abcdefgh and basic short": "Bearer *** and basic short",
        "éapi_key=1": "éapi_key=***",
        "a" * 300: "a" * 256,
    }
    assert values(spark, cases, lambda c: redact.redact_text(c, redact.MAX_TEXT)) == list(cases.values())
    assert values(spark, ["a" * 300], redact.redact_text) == ["a" * 300]
    assert values(spark, ["a" * 300], redact.scrub_text) == ["a" * 300]


def test_map_redaction_is_bounded(spark):
    many = {f"k{i:02}": "v" for i in range(33)}
    df = spark.createDataFrame([(many,), ({"Private-Key": "x", "note": "t=1"},), (None,)], "m map<string,string>")
    first, second, third = [r[0] for r in df.select(redact.redact_map("m", redact.MAX_ENTRIES, redact.MAX_TEXT)).collect()]
    assert len(first) == 32 and first[redact.TRUNCATED] == redact.TRUNCATED
    assert second == {"Private-Key": "***", "note": "t=1"} and third is None
    strict = df.select(redact.redact_map_strict("m").alias("m"), redact.strict_map_error("m").alias("e")).collect()
    assert strict[0].m is None and strict[0].e == "too many entries"
    assert strict[1].m == {"Private-Key": "***", "note": "t=1"}


def test_json_redaction(spark):
    deep = {"a": 1}
    for _ in range(9):
        deep = {"n": deep}
    texts = [
        json.dumps({"list": list(range(40)), "Cookie": {"a": 1}, "u": "http://a:b@c"}),
        json.dumps(deep),
        "not json",
    ]
    bounds = (redact.MAX_DEPTH, redact.MAX_ENTRIES, redact.MAX_TEXT)
    whole = [json.loads(t) for t in values(spark, texts[:2], redact.redact_json)]
    assert len(whole[0]["list"]) == 40 and whole[1] == deep
    wide, nested, broken = values(spark, texts, lambda c: redact.redact_json(c, *bounds))
    wide = json.loads(wide)
    assert wide["Cookie"] == "***" and wide["u"] == "http://a:***@c"
    assert len(wide["list"]) == 32 and wide["list"][-1] == redact.TRUNCATED
    assert redact.TRUNCATED in nested and broken is None


def test_json_redaction_keeps_what_it_does_not_mask(spark):
    deep = "[" * 30_000 + '"basic abcdefgh"' + "]" * 30_000
    texts = [
        '{"a":1.0000000000000000000001,"a":2,"":{"k":"u=1&token=abc"}}',
        deep,
        deep[:-1],
        '{"to\\u006ben": [1, {"x": "]"}], "n": 1E400}',
        "NaN",
        '{"a":01}',
        None,
    ]
    whole = values(spark, texts, redact.redact_json)
    assert whole[0] == '{"a":1.0000000000000000000001,"a":2,"":{"k":"u=1&token=***"}}'
    assert whole[1] == deep.replace("abcdefgh", "***") and whole[3] == '{"to\\u006ben":"***","n":1E400}'
    assert [whole[i] for i in (2, 4, 5, 6)] == [None] * 4
    bounded = values(spark, texts, lambda c: redact.redact_json(c, 2, 3, 5))
    assert bounded[0] == '{"a":1.0000000000000000000001,"a":2}' and bounded[1] == '[["[TRUNCATED]"]]'
    assert [bounded[i] for i in (2, 4, 5, 6)] == [None] * 4
    for text in ('["a",1,2]', "[1,2,3,4]", '{"a":1,"b":2,"c":3,"d":4}', "[[],{},[1,2,3,4,5],1]", " [ 1 , 2 , [ ] , 3 ] ", "7"):
        got, node = redact.bounded_document(text, 9, 3, 9), json.loads(text)
        want = node if not isinstance(node, (dict, list)) or len(node) <= 3 else None
        assert want is None or json.loads(got) == want
        if want is None:
            shown = json.loads(got)
            assert list(shown)[:2] == [x if x != [1, 2, 3, 4, 5] else [1, 2, redact.TRUNCATED] for x in list(node)[:2]] and len(shown) == 3
            assert list(shown)[2] == redact.TRUNCATED


def test_audit_entries(spark):
    df = spark.createDataFrame(
        [("note", "token=abc"), ("note", "token=***"), ("x-Cookie", "1"), ("note", "plain")], "k string, v string"
    )
    assert [r[0] for r in df.select(redact.audit_violation("k", "v")).collect()] == [
        "credential value", None, "sensitive key", None,
    ]


def test_http_dates_agree_with_the_standard_library(spark):
    texts = ["Wed, 21 Oct 2015 07:28:00 GMT", "21 Oct 2015 07:28:00 +0230", "1 Jan 2024 00:00 GMT"]
    got = values(spark, texts, lambda v: F.unix_micros(rules.http_date(v)))
    assert got == [int(parsedate_to_datetime(t).timestamp() * 1e6) for t in texts]
    assert values(spark, ["Wed, 99 Oct 2015 07:28:00 GMT", "", "21 Oct 2015"], rules.is_http_date) == [False] * 3


def test_watermarks(spark):
    cases = {
        "A" * 64: True,
        "a" * 63: False,
        'W/"x-1"': True,
        '"a b"': False,
        '"user@host"': False,
        '"' + "x" * 300 + '"': False,
        '"x"\n': False,
        "": False,
    }
    assert values(spark, cases, rules.valid_watermark) == list(cases.values())


def test_names(spark):
    assert values(spark, ["", "1a b", "x" * 70], rules.sanitize_table_name) == ["_", "_1a_b", "x" * 64]
    assert values(spark, ["a1", "1a", "a b", "a\n"], rules.valid_identifier) == [True, False, False, False]
    assert values(spark, ["Ünï/c:ode_1.txt"], rules.safe_filename) == ["Ünïcode_1.txt"]


def test_declared_platforms(spark):
    operations = declared.operations(spark)
    counts = {r.platform: r["count"] for r in operations.groupBy("platform").count().collect()}
    assert counts == {"ckan": 13, "udata": 11, "socrata": 9}
    assert reports.case_matrix(declared.cases(spark)).count() == 2 * 43
    assert declared.cases(spark).join(operations, "operation_id", "left_anti").count() == 0
    evidence = spark.createDataFrame([("socrata/soda-v3-query", "forbidden")], "operation_id string, response_class string")
    states = {r.operation_id: r.state for r in capability.effective_profile(operations, evidence).collect()}
    assert states.pop("socrata/soda-v3-query") == "forbidden" and set(states.values()) == {"unavailable"}
    baseline = capability.effective_profile(operations, evidence, baseline="declared")
    assert baseline.where("platform = 'ckan' AND state <> capability_class").count() == 0


def test_fixture_rules(spark, tmp_path):
    import hashlib

    body = '{"schema_version":"1.0","platform":"ckan","profile_version":"1","cases":[{"operation":"ckan/a.b","outcome":"core"},{"operation":"ckan/x.y","outcome":"odd"}]}'
    (tmp_path / "cases.json").write_text(body)
    operations = spark.createDataFrame(
        [("ckan", "1", hashlib.sha256(body.encode()).hexdigest(), "ckan/a.b")],
        "platform string, profile_version string, fixture_fingerprint string, operation_id string",
    )
    found = {(r.rule, r.detail) for r in capability.fixture_violations(spark, str(tmp_path), operations).collect()}
    assert found == {("undeclared operation", "ckan/x.y"), ("undeclared outcome", "odd")}
    changed = operations.withColumn("fixture_fingerprint", F.lit("0"))
    assert "fingerprint" in {r.rule for r in capability.fixture_violations(spark, str(tmp_path), changed).collect()}


def test_rules_treat_null_as_broken(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "k int, v int")
    got = violations(df, {"positive": F.col("v") > 0, "small": F.col("v") < 3}, ["k"]).collect()
    assert {(r.k, r.rule) for r in got} == {(1, "positive"), (1, "small"), (2, "small")}


def test_strict_envelopes(spark):
    good = {"schema_version": 1, "kind": "result_envelope", "items": [{"a": 1}], "page": None, "warnings": [], "platform": None}
    docs = [
        json.dumps(good),
        json.dumps({**good, "schema_version": 1.0}),
        json.dumps({**good, "schema_version": True}),
        json.dumps({**good, "schema_version": "1"}),
        json.dumps({**good, "extra": 1}),
        json.dumps({**good, "items": {}}),
        "broken",
    ]
    df = spark.createDataFrame(list(enumerate(docs)), "page int, doc string")
    items, rejects = catalog.decode_envelopes(df, "doc")
    assert [(r.page, r.item) for r in items.collect()] == [(0, '{"a":1}')]
    assert {r.page: r.reject_reason for r in rejects.collect()} == {
        1: "schema version or kind",
        2: "schema version or kind",
        3: "schema version or kind",
        4: "keys",
        5: "items",
        6: "keys",
    }


def test_old_state_rows(spark):
    sha = "a" * 64
    position = {"kind": "parquet_row_group", "row_group_index": 2}
    v1 = {"version": 1, "status": "in_progress", "next_batch_index": 2, "position": position}
    cases = {
        "v1": ({"cp": v1}, None),
        "v1 position differs": ({"cp": {**v1, "next_batch_index": 3}}, "checkpoint"),
        "v2": ({"cp": {**v1, "version": 2, "source_version": None}}, None),
        "v3 without destination": ({"cp": {**v1, "version": 3, "source_version": sha, "destination_identity": None}}, "checkpoint"),
        "float index": ({"cp": {**v1, "next_batch_index": 2.0}}, "checkpoint"),
        "by uri": ({"art": {"destination_uri": "s3://b/x", "destination_size": 1, "destination_checksum": sha}}, None),
        "unsafe uri": ({"art": {"destination_uri": "s3://u@b/x", "destination_size": 1, "destination_checksum": sha}}, "artifact"),
        "bad watermark": ({}, "watermark"),
    }
    rows = [
        (k, json.dumps({"cursor": {"schema": "1", "watermark": "zz" if k == "bad watermark" else sha}, "extra": e, "last_synced_at": None}))
        for k, (e, _) in cases.items()
    ]
    old = spark.createDataFrame(rows, "key string, document string")
    good, bad = sync.upgrade_state(old, "cp", "art", "dest")
    assert {r.key for r in good.collect()} == {k for k, (_, why) in cases.items() if why is None}
    assert {r.key: r.reject_reason for r in bad.collect()} == {k: why for k, (_, why) in cases.items() if why}


def test_contested_key_commits_once(spark):
    state = spark.createDataFrame([("a", "v1", 1)], "key string, version string, x int")
    proposals = spark.createDataFrame(
        [("a", "v2", 2, "v1", 2, False), ("a", "v3", 3, "v1", 1, False), ("b", "n", 4, None, 1, False), ("b", "n", 5, "q", 0, False)],
        "key string, version string, x int, expected string, `order` int, deleted boolean",
    )
    merged, outcomes = sync.conditional_merge(state, proposals)
    assert {(r.key, r.version, r.x) for r in merged.collect()} == {("a", "v3", 3), ("b", "n", 4)}
    assert {(r.key, r.order): r.outcome for r in outcomes.collect()} == {
        ("a", 2): "conflict", ("a", 1): "committed", ("b", 1): "committed", ("b", 0): "conflict",
    }


@pytest.mark.parametrize("limit", [0, 70_000])
def test_byte_bound_is_checked(limit):
    with pytest.raises(ValueError):
        rules.bound_bytes(F.lit("x") if False else "x", limit)


def test_contradicting_evidence_and_equal_orders(spark):
    operations = spark.createDataFrame([("a", "read"), ("b", "read"), ("c", "read")], "operation_id string, capability_class string")
    evidence = spark.createDataFrame(
        [("a", "success"), ("a", "forbidden"), ("b", "success"), ("b", "success")], "operation_id string, response_class string"
    )
    states = {r.operation_id: (r.state, r.response_class) for r in capability.effective_profile(operations, evidence).collect()}
    assert states == {"a": ("conflict", None), "b": ("read", "success"), "c": ("unavailable", None)}
    state = spark.createDataFrame([("k", "w", "v")], "key string, watermark string, version string")
    twice = spark.createDataFrame(
        [("k", "x", "1", "v", 1, False), ("k", "y", "2", "v", 1, False)],
        "key string, watermark string, version string, expected string, `order` int, deleted boolean",
    )
    with pytest.raises(Exception, match="order of their own"):
        sync.conditional_merge(state, twice)[0].collect()


def test_times_of_old_state_need_a_zone(spark):
    texts = ["2024-01-01T00:00:00Z", "2024-01-01T00:00:00+02:00", "2024-01-01T00:00:00", "not a time", "2024-02-30T00:00:00Z"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(sync.zoned_time(F.col("t"))).collect()] == [True, True, False, False, False]


def test_digest_of_instants_does_not_follow_the_session_zone(spark):
    from lakegate.operators.digest import fingerprint_of

    df = spark.sql("SELECT TIMESTAMP'2024-01-01 00:00:00Z' AS t")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        there = fingerprint_of(df)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert fingerprint_of(df) == there
