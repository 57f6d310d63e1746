import datetime as dt

import pytest

from tests.helpers import rows
from tests.test_sources import A, B, C, HEADER, landing  # noqa: F401

from hexwatch.operators import aggregates, ledger
from hexwatch.session import shared_dir
from hexwatch.sources.gold import scan_gold
from hexwatch.streaming.arrivals import load_arrivals, load_files
from hexwatch.streaming.live_counts import live_counts, live_first_counts


def test_only_new_files_are_loaded(spark, landing):  # noqa: F811
    base = shared_dir(spark, "arrivals")

    def run(checkpoint="c1"):
        load_arrivals(spark, str(landing), f"{base}/gold", f"{base}/ledger", f"{base}/{checkpoint}").awaitTermination()
        return {r.source_file: r.record_count for r in aggregates.file_load_stats(scan_gold(spark, f"{base}/gold")).collect()}

    assert run() == {A: 2, B: 1, C: 1}
    late = "shootings-firearm-discharges_20240105_000000.csv"
    (landing / late).write_text(f"{HEADER}\nE9,2024-01-05,5,43.70,-79.40,Assault,x,y\n")
    assert run() == {A: 2, B: 1, C: 1, late: 1}
    # A lost stream checkpoint brings all files again: the ledger holds them back.
    assert run("c2") == {A: 2, B: 1, C: 1, late: 1}
    state = {r.file_name: (r.status, r.record_count) for r in ledger.fold(ledger.read_events(spark, f"{base}/ledger")).collect()}
    assert state == {A: ("completed", 3), B: ("completed", 1), C: ("completed", 1), late: ("completed", 1)}  # raw rows
    assert ledger.read_events(spark, f"{base}/ledger").count() == 12
    # A corrected file is loaded again once its record is forgotten.
    (landing / late).write_text(f"{HEADER}\nE9,2024-01-05,5,43.70,-79.40,Assault,x,y\nE10,2024-01-05,6,43.70,-79.40,Assault,x,y\n")
    ledger.forget(spark, [late], f"{base}/ledger")
    assert run("c3") == {A: 2, B: 1, C: 1, late: 2}


def test_every_file_is_recorded(spark, landing):  # noqa: F811
    base = shared_dir(spark, "recorded")
    (landing / "foreign.csv").write_text("a,b\n1,2\n")
    dropped = "theft-from-motor-vehicle_20240103_000000.csv"
    (landing / dropped).write_text(f"{HEADER}\nE1,2024-01-01,5,0,0,Assault,x,y\nE2,bad,5,43.7,-79.4,Assault,x,y\n")
    load_arrivals(spark, str(landing), f"{base}/gold", f"{base}/ledger", f"{base}/c").awaitTermination()
    state = {r.file_name: r for r in ledger.fold(ledger.read_events(spark, f"{base}/ledger")).collect()}
    assert (state["foreign.csv"].status, state["foreign.csv"].error_message) == ("failed", "no coordinate columns in ['a', 'b']")
    assert (state[dropped].status, state[dropped].record_count, state[dropped].last_timestamp) == ("completed", 2, None)
    assert state[A].dataset_type == "major-crime-indicators" and state[A].record_count == 3
    # Failed files are left alone, unless asked for.
    (landing / "foreign.csv").write_text(f"{HEADER}\nE1,2024-01-01,5,43.7,-79.4,Assault,x,y\n")
    for k, retry in enumerate((False, True)):
        load_arrivals(spark, str(landing), f"{base}/gold", f"{base}/ledger", f"{base}/again{k}", retry_failed=retry).awaitTermination()
        now = {r.file_name: r.status for r in ledger.fold(ledger.read_events(spark, f"{base}/ledger")).collect()}
        assert now["foreign.csv"] == ("completed" if retry else "failed")


def test_live_counts_emit_closed_hours(spark):
    base = shared_dir(spark, "live")
    t = dt.datetime(2024, 1, 1)
    schema = "h3_index string, crime_type string, occurred_at timestamp"
    first = [("a", "x", t), ("a", "y", t + dt.timedelta(minutes=5)), ("b", "x", t + dt.timedelta(hours=1)),
             ("b", "x", t + dt.timedelta(hours=4))]
    late = [("a", "x", t + dt.timedelta(minutes=1)), ("b", "x", t + dt.timedelta(hours=9))]
    for batch in (first, late):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = live_counts(spark.readStream.schema(schema).parquet(f"{base}/in"))
        stream.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/c").trigger(
            availableNow=True).start().awaitTermination()
    got = sorted(rows(spark.read.parquet(f"{base}/out").select("h3_index", "time_window", "crime_count", "distinct_crime_types")))
    assert got == [("a", t, 2, 2), ("b", t + dt.timedelta(hours=1), 1, 1), ("b", t + dt.timedelta(hours=4), 1, 1)]


def _run(out, base):
    out.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/c").trigger(availableNow=True).start().awaitTermination()


def test_live_counts_without_copies(spark):
    """Copies in one batch and across batches, in any order, of rows that count and rows that do not; then the same as A1."""
    base, t, hour = shared_dir(spark, "first"), dt.datetime(2024, 1, 1), dt.timedelta(hours=1)
    schema = "source_file string, id string, pos long, h3_index string, crime_type string, occurred_at timestamp"
    batches = [
        [("f", "k1", 5, "a", "x", t), ("f", "k2", 6, "a", "y", t), ("f", "k3", 1, None, "z", None), ("f", "k3", 7, "a", "z", t),
         ("f", "k9", 9, "b", "x", t + 3 * hour), ("f", "k9", 8, "b", "y", t + 3 * hour), ("g", "k1", 5, "a", "x", t), ("f", None, 3, "a", "n", t), ("f", None, 4, "a", "n", t)],
        [("f", "k1", 2, "a", "x", t + 2 * hour), ("f", "k2", 8, "b", "y", t + 2 * hour), ("g", "k1", 4, None, "x", None), ("f", "k8", 10, "b", "q", t + 9 * hour)],
        [("f", "k8", 1, "c", "q", t + 9 * hour), ("f", "k9", 2, "c", "x", t + 30 * hour), ("f", "k7", 12, "b", "q", t + 31 * hour)],
        [("f", "k7", 13, "b", "q", t + 32 * hour), ("f", "end", 14, "b", "q", t + 60 * hour)],
    ]
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
        _run(live_first_counts(spark.readStream.schema(schema).parquet(f"{base}/in"), ["source_file", "id"], "pos", "4 hours"), base)
    got = sorted(rows(spark.read.parquet(f"{base}/out").select("h3_index", "time_window", "crime_count", "distinct_crime_types")))
    everything = spark.read.parquet(f"{base}/in")
    # The hour of k9 was closed when its earlier copy came in the third batch: it keeps its count.
    kept = everything.where("not (id = 'k9' and pos = 2)")
    from hexwatch.operators.clean import keep_first

    first = keep_first(kept, ["source_file", "id"], ["pos"]).where("h3_index is not null and id is distinct from 'end'")
    assert got == sorted(rows(aggregates.counts_by_cell_hour(first)))
    assert ("c", t + 9 * hour, 1, 1) in got and ("a", t + 2 * hour, 1, 1) in got


def test_forgotten_keys(spark):
    base, t, hour = shared_dir(spark, "forget"), dt.datetime(2024, 1, 1), dt.timedelta(hours=1)
    schema = "id string, pos long, h3_index string, crime_type string, occurred_at timestamp"
    for batch in ([("k", 1, "a", "x", t)], [("z", 2, "b", "x", t + 40 * hour)], [("k", 3, "a", "x", t + 41 * hour)], [("z2", 4, "b", "x", t + 90 * hour)]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
        _run(live_first_counts(spark.readStream.schema(schema).parquet(f"{base}/in"), ["id"], "pos", "1 hour", keep_hours=10, distinct=False), base)
    got = sorted(rows(spark.read.parquet(f"{base}/out").select("h3_index", "time_window", "crime_count")))
    assert got == [("a", t, 1), ("a", t + 41 * hour, 1), ("b", t + 40 * hour, 1)]


def test_keys_share_state(spark, monkeypatch):
    """The state has a row per group of keys, not per key; keys of one group stay apart, also nulls and texts that look like them."""
    from hexwatch.streaming import live_counts as module

    monkeypatch.setattr(module, "GROUPS", 4, raising=False)
    base, t, hour = shared_dir(spark, "groups"), dt.datetime(2024, 1, 1), dt.timedelta(hours=1)
    schema = "file string, id string, pos long, h3_index string, crime_type string, occurred_at timestamp"
    ids = [*(f"k{i}" for i in range(300)), None, "null", "", '"', "x,y"]
    states = []
    for batch in ([("f", k, 5, "a", "x", t) for k in ids] * 2, [("f", k, 4, "b", "y", t + hour) for k in ids[::2]], [("g", "end", 1, "b", "q", t + 9 * hour)],
                  [("g", "end", 2, "b", "q", t + 60 * hour)]):
        spark.createDataFrame(batch, schema).repartition(3).write.mode("append").parquet(f"{base}/in")
        out = live_first_counts(spark.readStream.schema(schema).parquet(f"{base}/in"), ["file", "id"], "pos", "4 hours", keep_hours=20)
        run = out.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/c").trigger(availableNow=True).start()
        run.awaitTermination()
        states += [o.numRowsTotal for p in run.recentProgress for o in p.stateOperators if o.operatorName.startswith("transformWithState")]
    got = sorted(rows(spark.read.parquet(f"{base}/out").select("h3_index", "time_window", "crime_count", "distinct_crime_types")))
    assert got == [("a", t, len(ids) // 2, 1), ("b", t + hour, len(ids) - len(ids) // 2, 1), ("b", t + 9 * hour, 1, 1)]
    # What is forgotten leaves the state: only the last key's group is left.
    assert max(states) == 4 and states[-1] == 1


@pytest.mark.parametrize("cut", ["before entries", "before ledger"])
def test_a_batch_that_is_cut_off(spark, landing, monkeypatch, cut):  # noqa: F811
    """The driver dies half-way through a batch: between rows and entries, or between entries and ledger. The rerun gives the
    same table and the same state as an undisturbed run, and the rows left behind are vacuumed."""
    from hexwatch.sources import gold as gold_io

    def run(base):
        load_arrivals(spark, str(landing), f"{base}/gold", f"{base}/ledger", f"{base}/c").awaitTermination()

    def outcome(base):
        state = ledger.fold(ledger.read_events(spark, f"{base}/ledger")).drop("ingested_at")
        return sorted(rows(scan_gold(spark, f"{base}/gold").drop("geom")), key=repr), sorted(rows(state), key=repr)

    whole, base = shared_dir(spark, "whole"), shared_dir(spark, "cut")
    run(whole)

    real_publish, real_append, calls = gold_io.publish, ledger.append_events, []

    def publish(entries, path):
        if cut == "before entries":
            raise RuntimeError("died")
        real_publish(entries, path)

    def append(events, path):
        calls.append(1)
        if len(calls) == 2:  # the completion, after the start
            raise RuntimeError("died")
        real_append(events, path)

    with monkeypatch.context() as m:
        m.setattr(gold_io, "publish", publish)
        m.setattr(ledger, "append_events", append)
        with pytest.raises(RuntimeError):
            load_files(spark, sorted(str(p) for p in landing.glob("*.csv")), f"{base}/gold", f"{base}/ledger")
    assert outcome(base) != outcome(whole)
    run(base)
    assert outcome(base) == outcome(whole)
    assert len(gold_io.vacuum(spark, f"{base}/gold", keep_hours=0)) == 1
    assert outcome(base) == outcome(whole) and gold_io.vacuum(spark, f"{base}/gold", keep_hours=0) == []
    assert gold_io.vacuum(spark, f"{base}/nothing") == []
