import datetime as dt

import pytest
from pyspark.sql import functions as F

from hexwatch.functions import metrics_json, naming, numbers, text, times
from hexwatch.settings import DATASETS


def apply(spark, fn, values, schema="v string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r.x for r in df.select("i", fn(F.col("v")).alias("x")).orderBy("i").collect()]


def test_crime_types(spark):
    got = apply(spark, text.clean_category, [
        "assault", " B&E ", "break & enter", "BREAK AND ENTER", "TheftOver", "theft over", "Theft Under $5000x",
        "o'neil", "hit and run", "éTÉ x-y", None, "nan", " ",
    ])
    assert got == [
        "Assault", "Break and Enter", "Break and Enter", "Break and Enter", "Theft Over", "Theft Over",
        "Theft Under $5000X", "O'Neil", "Hit and Run", "Été X-Y", None, None, None,
    ]


def test_title_case_follows_python(spark):
    samples = ["enter-x", "5000x y2k", "a'b c.d", "UPPER lower", "x1y2-z", "  two  spaces", "(a)b", "tab\tword"]
    assert apply(spark, text.title_case, samples) == [s.title() for s in samples]


def test_neighbourhoods_and_premises(spark):
    got = apply(spark, text.clean_neighbourhood, ["12 Downtown", "Downtown (12)", "7 A (B) (7)", " ", "nan", None, "3"])
    assert got == ["Downtown", "Downtown", "A (B)", None, None, None, None]
    assert apply(spark, text.clean_premise, [" House ", "", "nan", None]) == ["House", None, None, None]


def test_numbers(spark):
    got = apply(spark, numbers.to_number, ["43.5", " 5 ", "1e3", ".5", "-2.", "x", "5d", "nan", "inf", "", None, "1,0"])
    assert got == [43.5, 5.0, 1000.0, 0.5, -2.0, None, None, None, None, None, None, None]


def test_dates(spark):
    got = apply(spark, times.parse_date, [
        "2014-01-31", "2014/1/31", "1/31/2014", "2014-01-31 05:06:07", "2014-01-31T05:06", "1/31/2014 17:30",
        "1/31/2014 5:00:00 PM", "2014/01/31 05:00:00+00", "2014-01-31 05:00:00+02:00", "31 January", "05:00", "", None,
        "13/13/2014", "20140131", "31-Jan-2014", "January 31, 2014", "jan 31, 2014", "20141341",
    ])
    day = dt.datetime(2014, 1, 31)
    five = day.replace(hour=5)
    assert got == [
        day, day, day, day.replace(hour=5, minute=6, second=7), day.replace(hour=5, minute=6),
        day.replace(hour=17, minute=30), day.replace(hour=17), five, day.replace(hour=3), None, None, None, None, None,
        day, day, day, day, None,
    ]


def test_hours_are_added_and_clipped(spark):
    assert apply(spark, times.clip_hour, ["5", None, "abc", "-3", "27", "4.9", "-0.5"]) == [5, 0, 0, 0, 23, 4, 0]
    df = spark.createDataFrame([("2014-01-01 05:30", "4")], "d string, h string")
    got = df.select(times.parse_occurred_at(F.col("d"), F.col("h"))).first()[0]
    assert got == dt.datetime(2014, 1, 1, 9, 30)


@pytest.mark.parametrize("name, expected", [
    ("major-crime-indicators_20251220_123456.csv", "major-crime-indicators"),
    ("shootings-firearm-discharges_20251220_123456.csv", "shootings-firearm-discharges"),
    ("toronto_crime_20251220_123456.csv", "major-crime-indicators"),
    ("other.csv", None),
    ("theft-from-motor-vehicle.csv", None),
    ("a_b_c.csv", "a_b"),
    ("a_b.csv", "a_b"),
    ("a_bc.csv", None),
])
def test_dataset_types(spark, name, expected):
    keys = [*DATASETS, "a_b", "a_b_c"]
    assert apply(spark, lambda c: naming.dataset_type_of(c, keys), [name]) == [expected]


def test_calendar_parts(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 22),), (dt.datetime(2024, 3, 2, 6),)], "t timestamp")
    c = F.col("t")
    got = df.select(
        times.hour_of_day(c), times.day_of_week(c), times.is_weekend(c), times.is_night(c), times.month(c), times.season(c)
    ).collect()
    assert [tuple(r) for r in got] == [(22, 0, False, True, 1, 4), (6, 5, True, False, 3, 1)]


def test_metrics_round_trip(spark):
    df = spark.range(1).select(metrics_json.metrics_map(roc_auc=F.lit(0.85), recall=F.lit(0.75)).alias("m"))
    back = df.select(metrics_json.read_metrics(metrics_json.write_metrics(F.col("m")))).first()[0]
    assert back == {"roc_auc": 0.85, "recall": 0.75}
