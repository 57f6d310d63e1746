import random

import pytest

from hexwatch.operators import ledger
from hexwatch.session import shared_dir
from tests.helpers import rows


def events(spark, seed, n, first=1):
    rng = random.Random(seed)
    kinds = ["start", "complete", "fail", "gold_complete", "forget"]
    made = [(f"f{rng.randrange(12)}", rng.choice(kinds), first + k, None, rng.choice([None, k]), None, rng.choice([None, "e" * 600]), rng.choice([None, "a", "b"])) for k in range(n)]
    return spark.createDataFrame(made, ledger.EVENT_SCHEMA)


@pytest.mark.parametrize("seed", [1, 2])
def test_snapshot_and_tail_equal_the_fold(spark, seed):
    path = shared_dir(spark, "ledger")
    everything = None
    for k in range(4):
        new = events(spark, 10 * seed + k, 40, 1 + 40 * k).coalesce(1)
        everything = new if everything is None else everything.unionByName(new)
        ledger.append_events(new, path)
        expected = sorted(rows(ledger.fold(everything)), key=repr)
        assert sorted(rows(ledger.read_state(spark, path)), key=repr) == expected
        if k in (0, 2):
            assert ledger.compact(spark, path) == 40 * (k + 1) == ledger.snapshots(spark, path)[-1]
            assert ledger.compact(spark, path) == 40 * (k + 1)
        if k == 2:
            assert ledger.drop_folded(spark, path) == 3 and ledger.read_events(spark, path).count() == 0
            assert ledger.next_seq(spark, path) == 121 and ledger.snapshots(spark, path) == [120]
        assert sorted(rows(ledger.read_state(spark, path)), key=repr) == expected
    # A snapshot that was cut off does not count.
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{path}_snapshots/upto=999")
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(hadoop)
    assert ledger.snapshots(spark, path) == [120] and sorted(rows(ledger.read_state(spark, path)), key=repr) == expected


def test_empty_ledger(spark):
    path = shared_dir(spark, "ledger")
    assert ledger.read_state(spark, path).count() == 0 and ledger.drop_folded(spark, path) == 0 and ledger.next_seq(spark, path) == 1
