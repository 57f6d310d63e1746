import datetime as dt
import random

import pytest

from hexwatch.operators import features
from tests.helpers import rows

START = dt.datetime(2024, 1, 1)


def events(spark, hours):
    return spark.createDataFrame([(c, START + dt.timedelta(hours=h, minutes=7)) for c, h in hours], "h3_index string, occurred_at timestamp")


LOADS = [
    (["a", "b", "c"], [5, 900, 2000, 2001, 4000]),  # the first load
    (["a"], [4100]), (["a"], [1, 2900]), (["b", "d"], [5, 3, 1500]), (["c"], [9000, 30]), (["e"], [0]),
]


@pytest.mark.parametrize("span", ["cell", None])
def test_several_loads_equal_a_rebuild(spark, span):
    held, stored = [], None
    rng = random.Random(1)
    for k, (cells, hours) in enumerate(LOADS + [("removed", None)]):
        before = list(held)
        if cells == "removed":  # rows of a replaced file go: the first and the last hour of a cell among them
            held = [x for x in held if x not in {("a", 1), ("a", 4100), ("e", 0)} and rng.random() > 0.1]
        else:
            held += [(c, h) for c in cells for h in hours]
        now = features.hourly_counts(events(spark, held))
        full = features.build_features(events(spark, held), span=span)
        if stored is not None:
            changed = features.changed_hours(features.hourly_counts(events(spark, before)), now)
            stored = spark.createDataFrame(features.refreshed_features(stored, changed, now, span=span).collect(), full.schema)
            assert sorted(rows(stored)) == sorted(rows(full)), k
        else:
            stored = spark.createDataFrame(full.collect(), full.schema)


def test_only_what_can_change_is_computed(spark):
    counts = features.hourly_counts(events(spark, [("a", h) for h in (0, 1000, 2000, 3000, 9000)] + [("b", 1)]))
    changed = spark.createDataFrame([("a", features_hour(2000))], "h3_index string, hour_no bigint")
    got = features.touched_ranges(changed, counts).first()
    assert (got["h3_index"], *(got[c] - features_hour(0) for c in ("low", "high", "until"))) == ("a", 1000, 3000, 3000)
    assert features.touched_ranges(changed, counts).count() == 1
    with pytest.raises(ValueError):
        features.refreshed_features(counts, changed, counts, span="table")


def features_hour(h):
    return int((START + dt.timedelta(hours=h) - dt.datetime(1970, 1, 1)).total_seconds()) // 3600
