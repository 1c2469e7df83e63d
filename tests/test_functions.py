import datetime as dt

import pytest
from pyspark.sql import functions as F

from paddock.functions import text, timefmt
from paddock.sources.ingest import bronze_table_name, sanitize_columns, sanitize_name


def _one(spark, col_expr, values, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(col_expr).collect()]


@pytest.mark.parametrize(
    "txt, ms",
    [
        ("1:26.5", 86500),
        ("23.456", 23456),
        ("83", 83000),
        ("2:05", 125000),
        ("1:02:03.456", 3723456),
        ("1:27.452", 87452),
        ("0.5", 500),
        ("\\N", None),
        (None, None),
        ("", None),
        ("abc", None),
        ("1:2:3:4", None),
        ("-5.0", None),
        ("1.2345", 1234),  # digits beyond milliseconds are cut
        ("1:26.4521", 86452),
    ],
)
def test_time_to_ms(spark, txt, ms):
    assert _one(spark, timefmt.time_to_ms("x"), [txt]) == [ms]


def test_time_to_ms_inverse(spark):
    # property: formatting milliseconds as m:ss.fff and parsing gives them back
    values = [0, 1, 999, 60000, 61001, 86500, 599999, 3599999]
    texts = [f"{v // 60000}:{(v // 1000) % 60:02d}.{v % 1000:03d}" for v in values]
    assert _one(spark, timefmt.time_to_ms("x"), texts) == values


def test_wall_clock(spark):
    got = _one(spark, timefmt.clean_wall_clock("x"), ["14:00:00Z", "9:30:00.000", "11:30:00+01", "n/a", None, "15:00:00"])
    assert got == ["14:00:00", "9:30:00", "11:30:00", "n/a", None, "15:00:00"]


def test_multi_format_date_with_pivot(spark):
    got = _one(
        spark,
        timefmt.parse_multi_format_date("x"),
        ["2009-03-29", "10/24/71", "6/7/52", "6/07/52", "01/02/20", "2009-03-29xyz", "unknown", None, "13/40/99"],
    )
    assert got == [
        dt.date(2009, 3, 29), dt.date(1971, 10, 24), dt.date(1952, 6, 7), dt.date(1952, 6, 7),
        dt.date(2020, 1, 2), None, None, None, None,
    ]
    got = _one(spark, timefmt.parse_multi_format_date("x", century_pivot="2049-12-31"), ["6/7/45"])
    assert got == [dt.date(2045, 6, 7)]


def test_session_timestamp(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 2), "9:30:00"), (dt.date(2024, 3, 2), None), (None, "10:00:00")], "d date, t string")
    got = [r[0] for r in df.select(timefmt.session_timestamp("d", "t")).collect()]
    assert got == [dt.datetime(2024, 3, 2, 9, 30), None, None]


def test_value_map_whole_value_and_null(spark):
    got = _one(spark, text.map_values("x", text.RACE_DATA_VALUE_MAP), ["R", "UK", "\\N", "-", "Korea", "RR", "r", None, "USA"])
    assert got == ["Retired", "United Kingdom", None, None, "South Korea", "RR", "r", None, "United States"]


def test_value_map_then_set_check(spark):
    # property: after mapping, no raw code letter of the map is left
    codes = [k for k, v in text.RACE_DATA_VALUE_MAP.items() if v is not None and len(k) == 1]
    got = _one(spark, text.map_values("x", text.RACE_DATA_VALUE_MAP), codes)
    assert not set(got) & set(codes)


def test_cause_normalise_order(spark):
    got = _one(spark, text.normalise_cause("x"), ["Accident/Debris", "Multiple ACCIDENTS", "Stranded car/Rain", "debris", "Rain", None])
    assert got == ["Accident(s)", "Accident(s)", "Stranded Car(s)", "Debris", "Rain", None]


def test_not_classified_flag(spark):
    got = _one(spark, text.not_classified_flag("x"), ["1", "12", "R", "Retired", "", None])
    assert got == [False, False, True, True, True, False]


def test_sanitize_names(spark):
    assert sanitize_name("Race Id") == "race_id"
    assert sanitize_name("a(b)=c;d,e{f}") == "a_b__c_d_e_f_"
    df = spark.createDataFrame([(1, 2)], "`A B` int, `c` int")
    assert sanitize_columns(df).columns == ["a_b", "c"]
    clash = spark.createDataFrame([(1, 2)], "`a b` int, `a_b` int")
    with pytest.raises(ValueError):
        sanitize_columns(clash)


def test_bronze_table_name():
    assert bronze_table_name("lap-times 2024.csv", "race_data") == "race_data_lap_times_2024"
    assert bronze_table_name("safety_cars.csv", "race_events") == "race_events_safety_cars"
