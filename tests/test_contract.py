import datetime as dt
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import coerce
from millrace.functions.barrier import out_of_line
from millrace.operators import contract

GOOD = {
    "meta": {"id": "e-1", "dt": "2025-03-04T05:06:07Z", "domain": "a.example", "stream": "s"},
    "id": 77,
    "type": "edit",
    "namespace": 0,
    "title": "Some page",
    "comment": "c",
    "timestamp": 1741064767,
    "user": "Somebody",
    "bot": False,
    "wiki": "xwiki",
    "server_name": "a.example",
    "length": {"old": 10, "new": 12},
    "revision": {"old": 5, "new": 6},
}


def line(**changes):
    return json.dumps({**GOOD, **changes})


def without(*names):
    return json.dumps({k: v for k, v in GOOD.items() if k not in names})


def meta(**changes):
    return line(meta={**GOOD["meta"], **changes})


def judge(spark, lines):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "n int, raw_line string")
    judged = contract.validate(frame.coalesce(1))
    return [row.asDict() for row in judged.collect()]


def test_valid_event_is_flattened_to_the_table_columns(spark):
    [row] = judge(spark, [line()])
    assert list(row) == [*schemas.RAW_NRT.names, "error", "dt"]
    assert row["error"] == ""
    assert row["event_id"] == "e-1" and row["wiki"] == "xwiki" and row["bot"] is False
    assert (row["length_old"], row["length_new"]) == (10, 12)
    assert (row["revision_old"], row["revision_new"]) == (5, 6)
    assert row["dt"] == "2025-03-04"
    assert row["raw_json"] == line()


ACCEPTED = {
    "unknown field": line(some_new_field={"x": [1]}),
    "unknown field, deep": line(extra={"a": {"b": {"c": [{}, [[]]]}}}),
    "optional fields absent": json.dumps(
        {"meta": {"id": "x", "dt": "2025-01-01T00:00:00Z"}, "type": "t", "wiki": "w"}
    ),
    "optional fields null": line(
        namespace=None, title=None, comment=None, timestamp=None, user=None, id=None,
        server_name=None, length=None, revision=None,
    ),
    "nested integers null": line(length={"old": None, "new": None}),
    "nested object empty": line(length={}, revision={}),
    "blank wiki": line(wiki=""),
    "surrounding white space": "  " + line() + " \n",
    "integer as text": line(namespace="3", timestamp=" 4 "),
    "integral decimal": line(id=5.0),
    "flag for integer": line(id=True),
    "flag as word": line(bot="YES"),
    "flag as number": line(bot=1),
    "epoch seconds": meta(dt=1741064767),
    "epoch text": meta(dt="1741064767"),
    "date only": meta(dt="2025-03-04"),
    "no offset": meta(dt="2025-03-04 05:06"),
    "our own end mark in a title": line(title="8675309271828"),
    "our own envelope in a title": line(title="endofdocimage"),
    "escaped letters": line(title="x").replace('"x"', '"\\u006fk"'),
    "surrogate pair": line(title="\U0001f600"),
    "escaped backslash before u": line(title="\\ud800"),
    "duplicate key, last one good": line()[:-1] + ',"type":"edit"}',
    "bracket in text": line(title='"]},{"[', comment="}"),
}
REJECTED = {
    "no meta": without("meta"),
    "no type": without("type"),
    "no wiki": without("wiki"),
    "meta without id": line(meta={"dt": "2025-01-01T00:00:00Z"}),
    "meta without dt": line(meta={"id": "x"}),
    "meta null": line(meta=None),
    "meta not an object": line(meta="m"),
    "type null": line(type=None),
    "type a number": line(type=5),
    "wiki an array": line(wiki=["w"]),
    "title a number": line(title=5),
    "comment a flag": line(comment=True),
    "domain a number": meta(domain=5),
    "stream an object": meta(stream={}),
    "bot null": line(bot=None),
    "bot 2": line(bot=2),
    "bot another word": line(bot="maybe"),
    "id with a fraction": line(id=1.5),
    "timestamp a word": line(timestamp="soon"),
    "namespace too wide": line(namespace=2**63),
    "namespace an object": line(namespace={}),
    "length a number": line(length=5),
    "length an array": line(length=[]),
    "nested integer a word": line(revision={"old": "x"}),
    "dt a word": meta(dt="yesterday"),
    "dt a flag": meta(dt=True),
    "dt impossible": meta(dt="2025-02-30T00:00:00Z"),
    "duplicate key, last one bad": line()[:-1] + ',"type":5}',
    "flat shape": json.dumps({"id": "x", "dt": "2025-01-01T00:00:00Z", "type": "t", "wiki": "w"}),
    "malformed": "{not json",
    "empty": "",
    "cut short": line()[:-3],
    "trailing word": line() + " x",
    "trailing document": line() + line(),
    "second element": line() + "," + line(),
    "closed array": line() + "] x",
    "closed array and object": line() + "]} x",
    "forged end mark": line() + ",8675309271828] x",
    "forged envelope end": line() + ',{"endofdocimage":true}]} x',
    "forged envelope": line() + '],"endofdocimage":[' + line(),
    "other key": line() + '],"x":[' + line(),
    "array": "[" + line() + "]",
    "string": '"text"',
    "null": "null",
    "number": "1",
    "single quotes": "{'a': 1}",
    "trailing comma": line()[:-1] + ",}",
    "comment in text": line()[:-1] + "/* c */}",
    "raw control character": line(title="a\u0001b").replace("\\u0001", "\u0001"),
    "lone surrogate": line(title="X").replace('"X"', '"\\ud83d"'),
    "byte order mark": "﻿" + line(),
}


def test_accepted_forms(spark):
    verdicts = judge(spark, ACCEPTED.values())
    assert {k: v["error"] for k, v in zip(ACCEPTED, verdicts) if v["error"]} == {}
    assert all(v["event_id"] is not None and v["event_dt"] is not None for v in verdicts)
    assert [v["raw_json"] for v in verdicts] == list(ACCEPTED.values())


def test_rejected_forms(spark):
    verdicts = judge(spark, REJECTED.values())
    assert [k for k, v in zip(REJECTED, verdicts) if not v["error"]] == []


def test_error_names_every_broken_field(spark):
    [row] = judge(spark, [line(type=5, bot=None, length=1, title=2)])
    assert row["error"] == (
        "type: not a string; title: not a string; bot: not true or false; length: not an object"
    )


def test_unusual_forms_give_the_same_values(spark):
    usual, *others = judge(
        spark,
        [
            line(bot=True),
            line(bot="on", namespace="0", length={"old": "10", "new": 12.0}),
            meta(dt="2025-03-04T07:06:07+02:00").replace('"bot": false', '"bot": 1'),
            meta(dt=1741064767000).replace('"bot": false', '"bot": "y"'),
        ],
    )
    for other in others:
        assert {k: v for k, v in other.items() if k != "raw_json"} == {
            k: v for k, v in usual.items() if k != "raw_json"
        }


INTEGERS = {
    "3": 3, '"3"': 3, '" 3 "': 3, '"+3"': 3, '"-3"': -3, '"1_000"': 1000, '"007"': 7, '"3.0"': 3,
    '"1_0.00"': 10, '"\\u00a03"': 3, "1e3": 1000, "1.0": 1, "-0.0": 0, "true": 1, "false": 0,
    "9223372036854775807": 2**63 - 1, "-9223372036854775808": -(2**63),
    "9223372036854775808": None, '"9223372036854775808"': None, "1e19": None, "1e999": None,
    "12345678901234567890123.0": None, "1.5": None, '"3."': None, '"3.10"': None, '""': None,
    '" "': None, '"_1"': None, '"1_"': None, '"1__0"': None, '"+-3"': None, '"0x1"': None,
    '"1e3"': None, '"３"': None, "[]": None, "{}": None, "null": None,
}
FLAGS = {
    "true": True, "false": False, "1": True, "0": False, "1.0": True, "0.0": False, "1e0": True,
    '"true"': True, '"FALSE"': False, '"on"': True, '"Off"': False, '"t"': True, '"f"': False,
    '"y"': True, '"N"': False, '"yes"': True, '"no"': False, '"1"': True, '"0"': False,
    "2": None, "-1": None, "0.5": None, '"1.0"': None, '" true "': None, '""': None,
    '"enabled"': None, "null": None, "[]": None,
}
INSTANTS = {
    '"2026-08-09T12:00:00Z"': "2026-08-09T12:00:00",
    '"2026-08-09t12:00:00z"': "2026-08-09T12:00:00",
    '"2026-08-09 12:00"': "2026-08-09T12:00:00",
    '"2026-08-09_12:00:00"': "2026-08-09T12:00:00",
    '"2026-08-09"': "2026-08-09T00:00:00",
    '"2026"': "1970-01-01T00:33:46",
    '"20260809"': "1970-08-23T12:00:09",
    "1754740800": "2025-08-09T12:00:00",
    "1754740800000": "2025-08-09T12:00:00",
    "1754740800.5": "2025-08-09T12:00:00.500000",
    '"1754740800.5"': "2025-08-09T12:00:00.500000",
    '"-5"': "1969-12-31T23:59:55",
    '"+5"': "1970-01-01T00:00:05",
    '"5."': "1970-01-01T00:00:05",
    '".5"': "1970-01-01T00:00:00.500000",
    "20000000000": "2603-10-11T11:33:20",
    "20000000001": "1970-08-20T11:33:20.001000",
    "-20000000001": "1969-05-14T12:26:39.999000",
    "1e12": "2001-09-09T01:46:40",
    '"2026-08-09T12:00:00.123456789Z"': "2026-08-09T12:00:00.123456",
    '"2026-08-09T12:00:00,5Z"': "2026-08-09T12:00:00.500000",
    '"2026-08-09T12:00:00+02:00"': "2026-08-09T10:00:00",
    '"2026-08-09T12:00:00-0230"': "2026-08-09T14:30:00",
    '"2026-08-09T12:00:00−02:00"': "2026-08-09T14:00:00",
    '"2026-08-09T12:00:00+23:59"': "2026-08-08T12:01:00",
    "253402300799999": "9999-12-31T23:59:59.999000",
    "253402300800000": None, "-62135596800001": None, "1e30": None, '"1e9"': None,
    '"2026-08-09T12"': None, '"2026-08-09T12:00:00+02"': None, '"2026-08-09T24:00:00Z"': None,
    '"2026-08-09T23:59:60Z"': None, '"2026-02-30"': None, '" 2026-08-09"': None,
    '"2026-8-9"': None, '"0000-01-01"': None, '"12:00"': None, '"."': None, '""': None,
    '"2026-08-09T12:00:00 Z"': None, '"2026-08-09T12:00:00+24:00"': None,
    '"99999999999999999999"': None, "9223372036854775808": None, "-9223372036854775808": None,
    "true": None, "null": None, "[]": None,
}


@pytest.mark.parametrize(
    ("rule", "cases"),
    [(coerce.whole_number, INTEGERS), (coerce.flag, FLAGS), (coerce.instant, INSTANTS)],
    ids=["integer", "flag", "instant"],
)
def test_coercion_table(spark, rule, cases):
    frame = spark.createDataFrame([(text,) for text in cases], "text string").coalesce(1)
    value = out_of_line(coerce.observed(F.try_parse_json("text")), rule)
    if rule is coerce.instant:
        value = F.unix_micros(value)
    rows = {r["text"]: r["value"] for r in frame.select("text", value.alias("value")).collect()}
    expected = dict(cases)
    if rule is coerce.instant:
        epoch = dt.datetime(1970, 1, 1)
        expected = {
            k: v and (dt.datetime.fromisoformat(v) - epoch) // dt.timedelta(microseconds=1)
            for k, v in cases.items()
        }
    assert rows == expected


def test_undecodable_and_missing_values_are_quarantined(spark):
    values = [(bytearray(line().encode()),), (bytearray(b"\xff{}"),), (None,)]
    frame = spark.createDataFrame(values, "value binary").coalesce(1)
    judged = contract.validate(contract.decode_payload(frame))
    assert [r["error"] for r in judged.collect()] == ["", "invalid utf-8", "no value"]
    assert contract.accepted(judged).count() == 1
    assert contract.tallies(judged).first().asDict() == {"accepted": 1, "rejected": 2}


JSON_VALUES = st.recursive(
    st.none() | st.booleans() | st.integers(-(2**70), 2**70) | st.floats(allow_nan=False)
    | st.text(max_size=8),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text(max_size=4), inner, max_size=3),
    max_leaves=6,
)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.dictionaries(st.sampled_from(["title", "comment", "extra", "user"]), JSON_VALUES),
            st.sampled_from(["", "]", "}", "]}", ",1]", " {}", "\t", '],"x":[1', ",{}"]),
            st.integers(0, 3),
        ),
        min_size=20,
        max_size=40,
    )
)
def test_arbitrary_documents_match_a_json_parser(spark, cases):
    """Accepted exactly if the standard parser takes the text and the texts are texts."""
    lines, expected = [], []
    for changes, tail, cut in cases:
        whole = line(**changes) + tail
        text = whole[: len(whole) - cut]
        lines.append(text)
        try:
            document = json.loads(text)
        except ValueError:
            document = None
        expected.append(
            isinstance(document, dict)
            and all(
                isinstance(document.get(k), (str, type(None))) for k in ("title", "comment", "user")
            )
        )
    assert [v["error"] == "" for v in judge(spark, lines)] == expected


@pytest.mark.parametrize("field", ["comment", "unknown"])
def test_the_length_of_a_string_never_decides(spark, field):
    long = "x" * 21_000_000
    rows = judge(spark, [line(**{field: long}), line(**{field: long}, namespace="3"), line(namespace="3")])
    assert [row["error"] for row in rows] == [""] * 3
    assert rows[1]["namespace"] == rows[2]["namespace"] == 3


def test_instants_stay_within_the_years_that_have_names(spark):
    edges = [
        ("0001-01-01T00:00:00+01:00", False), ("9999-12-31T23:59:59-01:00", False),
        ("0001-01-01T01:00:00+01:00", True), ("9999-12-31T22:59:59-01:00", True),
    ]
    frame = spark.createDataFrame([(i, meta(dt=when)) for i, (when, _) in enumerate(edges)], "n int, raw_line string")
    # Python's own datetimes don't reach the first day.
    rows = contract.validate(frame.coalesce(1)).select("error", "dt").collect()
    assert [row["error"] == "" for row in rows] == [fine for _, fine in edges]
    assert all(len(row["dt"]) == 10 for row in rows if row["error"] == "")


@pytest.mark.parametrize("number", ["7" * 1500, "-" + "7" * 1500, "0." + "7" * 1500, "7" * 1500 + "e-3"])
def test_long_numbers_in_unknown_fields_decide_nothing(spark, number):
    usual, unusual = (line(extra=1, **changes).replace('"extra": 1', f'"extra": {number}') for changes in ({}, {"namespace": "3"}))
    assert [row["error"] for row in judge(spark, [usual, unusual])] == ["", ""]
