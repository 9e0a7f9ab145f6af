from __future__ import annotations

import json

import pytest

from resolvscope.operators import clean

GOOD = {
    "Domain": "www.qq.com",
    "Timestamp": 1704894441123,
    "ServerIP": "218.108.248.200",
    "QR": True,
    "Type": "A",
    "ResponseCode": 0,
    "ClientIP": "100.64.0.1",
    "Answers": [{"Type": "A", "Value": "1.2.3.4"}],
}


@pytest.fixture
def cleaned(spark):
    def run(*lines):
        text = [(line if isinstance(line, str) else json.dumps(line),) for line in lines]
        return clean.clean_log(clean.parse_lines(spark.createDataFrame(text, "value string"))).collect()

    return run


def change(**fields):
    return {**GOOD, **fields}


def test_good_line(cleaned):
    (row,) = cleaned(GOOD)
    assert (row.aip, row.responseType, row.error, row.resolver, row.domain) == ("1.2.3.4", "A", 0, 1, "www.qq.com")
    assert row.logTimestamp == 1704894441123


@pytest.mark.parametrize(
    "line",
    [
        "no json",
        "{broken",
        change(Domain=""),
        change(Domain=None),
        change(Domain="xDHCP"),
        change(ServerIP="218.108.248.191"),
        change(ServerIP=None),
        change(QR=False),
        change(QR=None),
        change(Timestamp=None),
        change(ResponseCode=None),
        change(ResponseCode="x"),
        change(Answers=None),
        change(ResponseCode=3, Answers=None),
        change(Answers=[{"Type": None, "Value": "1.2.3.4"}]),
        change(Answers=[{"Type": "A", "Value": None}]),
        change(Answers=[{"Type": "A", "Value": "not an address"}]),
        change(ClientIP=None),
        change(ClientIP="a.b.c.d"),
    ],
)
def test_dropped(cleaned, line):
    assert cleaned(line) == []


def test_client_without_four_parts_is_kept(cleaned):
    assert len(cleaned(change(ClientIP="10.1"))) == 1


def test_quoted_numbers_and_flags(cleaned):
    (row,) = cleaned(change(Timestamp="1704894441123", ResponseCode="0", QR="true"))
    assert (row.logTimestamp, row.responseCode) == (1704894441123, 0)


def test_empty_answers_text_is_an_empty_list(cleaned):
    (row,) = cleaned(change(Answers=""))
    assert (row.aip, row.responseType, row.error) == ("0.0.0.0", "other", 1)


def test_failed_other_type_needs_no_answers(cleaned):
    (row,) = cleaned(change(Type="AAAA", ResponseCode=3, Answers=None))
    assert (row.error, row.aip, row.responseType) == (1, "0.0.0.0", "other")


def test_other_types_are_errors(cleaned):
    (row,) = cleaned(change(Type="AAAA", Answers=[{"Type": "AAAA", "Value": "::1"}]))
    assert (row.error, row.aip, row.responseType) == (1, "0.0.0.0", "other")


def test_query_type_ignores_case_but_answer_type_does_not(cleaned):
    (row,) = cleaned(change(Type="a", Answers=[{"Type": "a", "Value": "1.2.3.4"}]))
    assert (row.aip, row.responseType, row.error) == ("0.0.0.0", "a", 1)


def test_answer_choice_is_stable_and_last_type_is_shown(cleaned):
    answers = [{"Type": "CNAME", "Value": "x"}, {"Type": "A", "Value": "1.1.1.1"}, {"Type": "A", "Value": "2.2.2.2"}, {"Type": "CNAME", "Value": "y"}]
    even, odd = cleaned(change(Timestamp=1704894441122, Answers=answers), change(Timestamp=1704894441123, Answers=answers))
    assert (even.aip, odd.aip) == ("1.1.1.1", "2.2.2.2")
    assert even.responseType == "CNAME"


def test_window_is_half_open(spark):
    rows = spark.createDataFrame([(999,), (1000,), (300_999,), (301_000,)], "Timestamp bigint")
    assert [r[0] for r in clean.in_window(rows, 1000).collect()] == [1000, 300_999]


def test_user_domain_filter(spark):
    names = ["qq.com", "local", "localnews.com", "x.null.com", "1.in-addr.arpa", "arpa.com", "HOSTx"]
    rows = spark.createDataFrame([(n, k) for n in names for k in (1, 2)], "domain string, resolver bigint")
    kept = clean.keep_user_domains(rows).collect()
    assert sorted(r.domain for r in kept) == ["arpa.com", "localnews.com", "qq.com"]
    assert {r.resolver for r in kept} == {2}


def test_none_to_empty(spark):
    rows = spark.createDataFrame([("None", "None"), (None, None), ("x", "3")], "a string, n string")
    assert [tuple(r) for r in clean.none_to_empty(rows, ["a"], ["n"]).collect()] == [("", ""), ("null", "0"), ("x", "3")]
    assert tuple(clean.none_to_empty(rows, ["a"], ["n"], keep_null_mark=False).collect()[1]) == ("", "")


def test_costly_fields_are_parsed_once(spark):
    lines = spark.createDataFrame([("{}",)], "value string")
    plan = clean.clean_log(clean.parse_lines(lines))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 2


def test_stored_columns_are_pruned_and_filtered(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.createDataFrame([("a.com", 1)], "Domain string, other int").write.parquet(path)
    plan = clean.drop_noise(spark.read.parquet(path)).select("Domain")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<Domain:string>" in plan
    assert "PushedFilters: [IsNotNull(Domain)" in plan
