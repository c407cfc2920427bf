from __future__ import annotations

import json
import math
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from flightlens.functions import coerce
from flightlens.operators import quality
from flightlens.sources.payloads import (
    MALFORMED,
    accepted_rows,
    explode_states,
    parse_payloads,
    raw_from_payloads,
    read_payload_files,
    rejected_rows,
)

LOADED = datetime(2024, 1, 1, 12, tzinfo=UTC)
GOOD = ["abc123", "AB1", "Here", 1, 2, 3.5, 4.5, 5.5, True, 6.5, 7.5, 8.5, 9.5, "1200", False, 0]


def record(**changes):
    names = (
        "icao24 callsign origin_country time_position last_contact longitude latitude baro_altitude "
        "on_ground velocity heading vertical_rate geo_altitude squawk spi position_source"
    ).split()
    values = dict(zip(names, GOOD, strict=True)) | changes
    return list(values.values())


def load(spark, *records, cap=None):
    text = json.dumps({"states": list(records)})
    return raw_from_payloads(spark.createDataFrame([(text,)], "value string"), LOADED, cap)


# element, as bigint, as double, as special-position flag
COERCIONS = [
    ("12.7", 12, 12.7, True),
    ('"12.7"', None, 12.7, False),
    ('" 12 "', 12, 12.0, False),
    ("true", 1, 1.0, True),
    ("false", 0, 0.0, False),
    ('"x"', None, None, False),
    ("null", None, None, None),
    ("-3.9", -3, -3.9, True),
    ('"Yes"', None, None, True),
    ('"TRUE"', None, None, True),
    ('"1"', 1, 1.0, True),
    ("[1,2]", None, None, False),
    ('{"a":1}', None, None, False),
    ('"nan"', None, math.nan, False),
    ('"-Infinity"', None, -math.inf, False),
    ("0", 0, 0.0, False),
    ("1e3", 1000, 1000.0, True),
    ('"1e3"', None, 1000.0, False),
    ('"1_000"', 1000, 1000.0, False),
    ('"12.5d"', None, None, False),
    ('"0x1p3"', None, None, False),
    ('"+7"', 7, 7.0, False),
    ('".5"', None, 0.5, False),
    ('""', None, None, False),
    ("0.99999999999", 0, 0.99999999999, True),
    ("-0.5", 0, -0.5, True),
    ("9007199254740993", 9007199254740993, 9007199254740993.0, True),
    ("12345678901234567.9", 12345678901234567, 12345678901234567.9, True),
    ("1e30", None, 1e30, True),
]


def test_coercion_table(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(COERCIONS)], "i int, text string")
    element = coerce.parts(F.parse_json("text"))
    rows = df.select(
        "i",
        coerce.to_long(element).alias("whole"),
        coerce.to_double(element).alias("real"),
        coerce.to_spi(element).alias("flag"),
    ).collect()
    for r in rows:
        text, whole, real, flag = COERCIONS[r.i]
        assert r.whole == whole, text
        assert r.flag == flag, text
        if real is not None and math.isnan(real):
            assert math.isnan(r.real), text
        else:
            assert r.real == real, text


def test_text_and_flag(spark):
    df = spark.createDataFrame(
        [("true",), ("12",), ('" off "',), ('"maybe"',), ("null",), ("0",), ("2",)], "text string"
    )
    element = coerce.parts(F.parse_json("text"))
    rows = df.select(coerce.to_text(element), coerce.to_flag(element))
    assert [tuple(r) for r in rows.collect()] == [
        ("True", True),
        ("12", None),
        (" off ", False),
        ("maybe", None),
        (None, None),
        ("0", False),
        ("2", None),
    ]


def test_a_good_record(spark):
    row = accepted_rows(load(spark, GOOD)).first()
    assert [row[n] for n in row.__fields__[1:]] == GOOD
    assert row.fetch_time.astimezone(UTC) == LOADED


def test_short_and_empty_records_are_padded(spark):
    rows = accepted_rows(load(spark, GOOD[:3], [])).collect()
    assert [(r.icao24, r.origin_country, r.velocity, r.spi) for r in rows] == [
        ("abc123", "Here", None, None),
        (None, None, None, None),
    ]


def test_bad_records_do_not_cost_the_batch(spark):
    records = [
        GOOD,
        5,
        None,
        {"icao24": "x"},
        record(callsign="X" * 21),
        record(icao24="X" * 11, squawk="X" * 11),
        record(origin_country="X" * 51),
        record(on_ground="maybe"),
        record(position_source=2**31),
        record(time_position=10**20),
        record(callsign="X" * 20),
    ]
    typed = load(spark, *records)
    assert accepted_rows(typed).count() == 2
    found = {r.position: r.reject_reasons for r in rejected_rows(typed).collect()}
    assert found == {
        1: ["not_a_list"],
        2: ["not_a_list"],
        3: ["not_a_list"],
        4: ["callsign_too_long"],
        5: ["icao24_too_long", "squawk_too_long"],
        6: ["origin_country_too_long"],
        7: ["on_ground_unreadable"],
        8: ["position_source_out_of_range"],
        9: ["time_position_out_of_range"],
    }
    kept = rejected_rows(typed).filter("position = 3").first().record
    assert json.loads(kept) == {"icao24": "x"}


@pytest.mark.parametrize("cap, expected", [(1000, 1000), (10, 10), (None, 1001)])
def test_cap_keeps_the_first_records(spark, cap, expected):
    rows = accepted_rows(load(spark, *[record(last_contact=i) for i in range(1001)], cap=cap))
    bounds = rows.agg(F.count(F.lit(1)), F.min("last_contact"), F.max("last_contact")).first()
    assert tuple(bounds) == (expected, 0, expected - 1)


def test_payloads_with_nothing_to_load(spark):
    texts = {
        "": "empty_body",
        " \n": "empty_body",
        "{bad": "malformed_json",
        "{}": "no_states",
        '{"states": null}': "no_states",
        '{"states": []}': "no_states",
        '{"states": {"a": 1}}': "no_states",
        "[1]": "no_states",
        '{"states": [[]]}': "ok",
    }
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    parsed = parse_payloads(df)
    assert {r.value: r.payload_status for r in parsed.collect()} == texts
    rows = explode_states(parsed).collect()
    assert [r.payload_reason for r in rows if r.record is None] == [None]
    assert [r.record for r in rows if r.payload_reason] == ["{bad"]


def test_positions_are_a_parameter(spark):
    df = spark.createDataFrame([('{"states": [["x", "y"]]}',)], "value string")
    typed = raw_from_payloads(df, LOADED, positions={"callsign": 0, "icao24": 1})
    row = typed.first()
    assert (row.icao24, row.callsign) == ("y", "x")


def test_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"states": [GOOD, GOOD]}, indent=1))
    (tmp_path / "b.json").write_text("")
    (tmp_path / "c.json").write_text("{bad")
    payloads = read_payload_files(spark, str(tmp_path))
    typed = raw_from_payloads(payloads, F.col("file_modification_time"))
    assert accepted_rows(typed).count() == 2
    assert [r.record for r in rejected_rows(typed).collect()] == ["{bad"]
    assert typed.first().fetch_time is not None


def test_nothing_vanishes(spark):
    """Loaded and rejected records add up to the records, and unreadable payloads keep their text."""
    many = json.dumps({"states": [record(last_contact=i) for i in range(1500)]})
    cut, bare = many[:-40], '{"states": [["a", "NaN, Infinity", "x", 1, 2, NaN, -Infinity]]}'
    twice = '{"states": [], "states": [[1]]}'
    rows = [(1, many), (2, cut), (3, bare), (4, twice), (5, ""), (6, '{"states": []}')]
    payloads = spark.createDataFrame(rows, "payload_id int, value string")
    for cap, loaded in ((None, 1501), (1000, 1001)):
        typed = raw_from_payloads(payloads, datetime(2024, 1, 1), cap=cap)
        rejects = rejected_rows(typed).collect()
        assert accepted_rows(typed).count() == loaded
        assert sorted(r.record for r in rejects if r.reject_reasons == ["malformed_json"]) == sorted([cut, twice])
        assert sum(r.reject_reasons == ["over_cap"] for r in rejects) == 1501 - loaded
        assert len(rejects) == 2 + 1501 - loaded
    got = accepted_rows(raw_from_payloads(payloads.filter("payload_id = 3"), datetime(2024, 1, 1))).first()
    assert got.callsign == "NaN, Infinity" and got.longitude != got.longitude and got.latitude == float("-inf")


def test_an_element_is_read_once(spark):
    """Its kind and its text; the others are reads of the list, and of the payload before it is exploded."""
    plan = load(spark, GOOD)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("schemaOfVariant") == 1 and plan.count("try_variant_get(lambda") == 1
    assert plan.count("try_variant_get") <= 5


def _reads(rows):
    """How often the plan parses a payload and reads an element."""
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("parseJson"), plan.count("schemaOfVariant")


def test_unread_payloads_are_found_with_one_read(spark):
    typed = load(spark, GOOD)
    assert _reads(typed.filter(F.array_contains(quality.REASONS, MALFORMED))) == (1, 1)


def test_good_records_are_found_with_one_read(spark):
    assert _reads(accepted_rows(load(spark, GOOD))) == (1, 1)


def test_rejects_are_found_with_one_read(spark):
    typed = load(spark, GOOD)
    assert _reads(rejected_rows(typed)) == (1, 1)
    assert _reads(typed.filter(F.col("payload_reason").isNull())) == (1, 1)


def test_marks_of_bare_words_are_refused(spark):
    text = '{"states": [["abc\x01", "\x02", NaN]]}'
    rows = raw_from_payloads(spark.createDataFrame([(text,)], "value string"), LOADED)
    assert rejected_rows(rows).first()["record"] == text
