import datetime as dt
import os
import pathlib

import pytest
from tests.helpers import rows
from pyspark.sql import functions as F

from hexwatch.operators import aggregates
from hexwatch.plans import incident
from hexwatch.session import shared_dir
from hexwatch.sources import bronze, registry
from hexwatch.sources import gold as gold_io
from hexwatch.sources import silver as silver_io

HEADER = "EVENT_UNIQUE_ID,OCC_DATE,OCC_HOUR,LAT_WGS84,LONG_WGS84,MCI_CATEGORY,NEIGHBOURHOOD_158,PREMISES_TYPE"
A = "major-crime-indicators_20240101_000000.csv"
B = "theft-from-motor-vehicle_20240102_000000.csv"
C = "toronto_crime_20230101_000000.csv"


@pytest.fixture
def landing(tmp_path):
    (tmp_path / A).write_text(
        f"{HEADER}\nE1,2024-01-01,5,43.70,-79.40,Assault,1 Café (1),House\n"
        'E1,2024-01-01,6,43.70,-79.40,Robbery,"Say ""hi"", ok",NA\nE2,2024-01-01,7,43.71,-79.41,b&e,null,N/A\n',
        encoding="utf-8")
    (tmp_path / B).write_bytes(f"{HEADER}\nE1,2024-01-02,1,43.72,-79.42,Auto Theft,Montréal,\n".encode("latin-1"))
    (tmp_path / C).write_text("Lat,Long,MAJOR_CRIME_INDICATOR,OCCURRENCE_DATE\n43.7,-79.4,robbery,1/3/2024\n" * 1)
    return tmp_path


def test_scan_groups_by_layout_and_encoding(spark, landing):
    frames = bronze.scan_bronze(spark, str(landing))
    assert len(frames) == 3
    table = bronze.union_layouts(frames)
    got = {(r.source_file, r.EVENT_UNIQUE_ID, r.NEIGHBOURHOOD_158, r.PREMISES_TYPE) for r in table.collect()}
    assert got == {
        (A, "E1", "1 Café (1)", "House"), (A, "E1", 'Say "hi", ok', None), (A, "E2", None, None),
        (B, "E1", "Montréal", None), (C, None, None, None),
    }
    assert table.where(f"source_file = '{C}'").select("Lat").first()[0] == "43.7"


def test_listing_opens_no_file_and_the_manifest_is_a_hash_aggregate(spark, landing):
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    assert "content" not in plan(bronze.list_files(spark, str(landing))).split("ReadSchema")[1]
    manifest = plan(bronze.file_manifest(spark, str(landing)))
    assert manifest.count("HashAggregate") == 2 and "SortAggregate" not in manifest and "ObjectHash" not in manifest


def test_whole_pipeline(spark, landing):
    gold = incident.pipeline(spark, str(landing))
    got = sorted((r.source_file, r.crime_type, r.occurred_at, r.dataset_type, r.neighbourhood) for r in gold.collect())
    assert got == sorted([
        (A, "Assault", dt.datetime(2024, 1, 1, 5), "major-crime-indicators", "Café"),
        (A, "Break and Enter", dt.datetime(2024, 1, 1, 7), "major-crime-indicators", None),
        (B, "Auto Theft", dt.datetime(2024, 1, 2, 1), "theft-from-motor-vehicle", "Montréal"),
        (C, "Robbery", dt.datetime(2024, 1, 3), "major-crime-indicators", None),
    ])


def test_quoted_line_breaks_are_noticed(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b\n1,"two\nlines"\n2,one\n')
    (tmp_path / "y.csv").write_text('a,b\n3,"a ""quoted"" word"\n')
    frames = bronze.scan_bronze(spark, str(tmp_path))
    assert sorted(r.b for f in frames for r in f.collect()) == ['a "quoted" word', "one", "two\nlines"]


@pytest.mark.parametrize("name", ["major crime.csv", "a%20b.csv", "a[1].csv", "x+y.csv", "b{1,2}.csv", "q?.csv", "ü.csv"])
def test_any_file_name(spark, tmp_path, name):
    (tmp_path / name).write_text(f"{HEADER}\nE1,2024-01-01,5,43.70,-79.40,Assault,x,y\n")
    (row,) = incident.pipeline(spark, str(tmp_path)).collect()
    assert row.source_file == name


def test_mixed_landing(spark, landing):
    (landing / "readme.txt").write_text("not,a,table")
    (landing / "foreign.csv").write_text("a,b\n1,2\n")
    (landing / "empty.csv").write_text("")
    assert incident.pipeline(spark, str(landing)).count() == 4
    aside = {r.file_name: r.reason for r in bronze.scan_landing(spark, str(landing)).set_aside(spark).collect()}
    assert aside == {"foreign.csv": "no coordinate columns in ['a', 'b']"}  # a file without a byte is not listed


def test_empty_folder_and_options(spark, tmp_path, landing):
    (tmp_path / "none").mkdir()
    got = incident.pipeline(spark, str(tmp_path / "none"))
    assert got.count() == 0 and got.columns == incident.pipeline(spark, str(landing)).columns
    os.utime(landing / C, (1_900_000_000, 1_900_000_000))
    newest = incident.pipeline(spark, str(landing), latest_only=True, multi_line=False, encoding="ISO-8859-1", source_tz="America/Toronto")
    assert {(r.source_file, r.occurred_at.hour) for r in newest.collect()} == {(B, 6), (C, 5)}


def test_headers_that_differ_in_case(spark, tmp_path):
    (tmp_path / "x.csv").write_text("LAT,Lat,LONG,OCC_DATE,MCI_CATEGORY,mci_category\n1,43.7,-79.4,2024-01-01,Assault,Robbery\n")
    (row,) = incident.pipeline(spark, str(tmp_path)).collect()
    assert float(row.latitude) == 43.7 and row.crime_type == "Assault"


def test_equal_names_are_an_error(spark, tmp_path):
    for folder in ("a", "b"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "x.csv").write_text("a\n1\n")
    with pytest.raises(ValueError, match="files of equal name"):
        bronze.scan_bronze(spark, str(tmp_path))


def test_keyless_layouts_are_distinct_together(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Lat,Long,MAJOR_CRIME_INDICATOR,OCCURRENCE_DATE\n43.7,-79.4,robbery,1/3/2024\n" + "43.7,-79.4,robbery,1/3/2024\n")
    (tmp_path / "b.csv").write_text("Long,Lat,MAJOR_CRIME_INDICATOR,OCCURRENCE_DATE\n-79.4,43.7,robbery,2024-01-03\n")
    assert incident.pipeline(spark, str(tmp_path)).count() == 2
    (row,) = incident.pipeline(spark, str(tmp_path), across_files=True).collect()
    assert row.source_file == "a.csv"


def test_far_offsets_keep_their_order(spark):
    far = [(1 << 44, 1), (1 << 43, 5), (3, 9), (1 << 62, 0)]
    order = [r.p for r in spark.createDataFrame([((a, b),) for a, b in far], "p struct<start: bigint, row: bigint>").orderBy("p").collect()]
    assert [tuple(p) for p in order] == sorted(far)
    assert "start" in str(bronze.row_position())


def test_latitude_that_does_not_fit_is_refused(spark, landing):
    silver = incident.silver(bronze.scan_bronze(spark, str(landing))).withColumn("latitude", F.when(F.col("source_file") == B, F.lit(500.0)).otherwise(F.col("latitude")))
    from hexwatch.functions.hexgrid import with_h3
    from hexwatch.operators import load

    assert load.to_gold_schema(with_h3(silver)).count() == 3
    tagged = gold_io.with_reject_reason(load.to_gold_schema(with_h3(silver), complete=False))
    assert [r.reject_reason for r in tagged.where("reject_reason is not null").collect()] == ["missing latitude"]


def test_row_positions_follow_the_file_over_many_splits(spark, tmp_path):
    n = 40_000
    lines = "".join(f"{i},{'pad' * (i % 9)}\n" for i in range(n))
    (tmp_path / "big.csv").write_text("id,pad\n" + lines)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in before:
            spark.conf.set(k, str(1 << 15))
        (frame,) = bronze.scan_bronze(spark, str(tmp_path))
        assert frame.rdd.getNumPartitions() > 4
        ordered = [int(r.id) for r in frame.orderBy("_row_pos").select("id").collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert ordered == list(range(n))


def test_latest_file(spark, landing):
    os.utime(landing / A, (1_700_000_000, 1_700_000_000))
    os.utime(landing / B, (1_700_000_100, 1_700_000_100))
    os.utime(landing / C, (1_700_000_200, 1_700_000_200))
    files = bronze.list_files(spark, str(landing))
    assert [r.file_name for r in bronze.latest_file(files, per_dataset=False).collect()] == [C]
    per_type = {r.dataset_type: r.file_name for r in bronze.latest_file(files).collect()}
    assert per_type == {"major-crime-indicators": C, "theft-from-motor-vehicle": B}


def test_silver_scan_checks_columns(spark, landing):
    path = shared_dir(spark, "bad-silver")
    spark.createDataFrame([(1.0,)], "latitude double").write.parquet(path)
    with pytest.raises(ValueError, match="longitude"):
        silver_io.scan_silver(spark, path)
    for fmt in ("parquet", "csv"):
        path = shared_dir(spark, "silver")
        silver = incident.silver(bronze.scan_bronze(spark, str(landing)))
        silver_io.write_silver(silver, path, fmt=fmt)
        back = silver_io.scan_silver(spark, path, fmt=fmt)
        assert sorted(map(str, rows(back.select(*silver.columns)))) == sorted(map(str, rows(silver)))


def test_gold_sink_replaces_only_its_files(spark, landing):
    path = shared_dir(spark, "gold")
    gold = incident.pipeline(spark, str(landing))
    gold_io.write_gold(gold, path)
    gold_io.write_gold(gold.where(F.col("source_file") == A), path)
    assert {r.source_file: r.record_count for r in aggregates.file_load_stats(gold_io.scan_gold(spark, path)).collect()} == {
        A: 2, B: 1, C: 1}
    gold_io.write_gold(gold.where(F.col("source_file") == B), path, mode="append")
    assert gold_io.scan_gold(spark, path).where(F.col("source_file") == B).count() == 2
    with pytest.raises(ValueError):
        gold_io.write_gold(gold, path, mode="ask")
    gold_io.write_gold(gold.limit(0), path, files=[C])
    assert gold_io.scan_gold(spark, path).where(F.col("source_file") == C).count() == 0
    retyped = gold.where(F.col("source_file") == A).withColumn("dataset_type", F.lit(None).cast("string"))
    gold_io.write_gold(retyped, path)
    assert [r.dataset_type for r in gold_io.scan_gold(spark, path).where(F.col("source_file") == A).collect()] == [None, None]
    folders = {p.name for p in (pathlib.Path(path.removeprefix("file:")) / "rows").glob("*/*/*")}
    assert not any("source_file" in f for f in folders)


def test_quarantine(spark, landing):
    gold = incident.pipeline(spark, str(landing)).withColumn(
        "crime_type", F.when(F.col("source_file") == B, F.repeat(F.lit("x"), 101)).otherwise(F.col("crime_type")))
    good, bad = gold_io.split_loadable(gold.withColumn("h3_index", F.when(F.col("source_file") != C, F.col("h3_index"))))
    assert good.count() == 2
    assert {r.reject_reason for r in bad.collect()} == {"crime_type too long", "missing h3_index"}


def test_catalog_choice(spark):
    cases = [
        ('{"success":true,"result":{"resources":[{"id":"p","format":"PDF","url":"u"},{"id":"c","format":"csv"}]}}', "c"),
        ('{"success":true,"result":{"resources":[{"format":"PDF"},{"id":"x","download_url":"http://d"}]}}', "x"),
        ('{"success":true,"result":{"resources":[{"format":"CSV","url":"http://u"}]}}', "http://u"),
        ('{"success":true,"result":{"resources":[]}}', None),
        ('{"success":false,"error":"no"}', None),
        ('{"success":true}', None),
    ]
    df = spark.createDataFrame(cases, "j string, want string")
    picked = df.select("want", registry.pick_resource(registry.parse_catalog(F.col("j"))).alias("got"))
    assert all(r.want == r.got for r in picked.collect())


def test_download_source(spark):
    df = spark.createDataFrame([
        ("id", "http://direct", None), ("id", None, None), (None, "", "http://found"), (None, None, "found"), (None, None, None),
    ], "resource_id string, direct string, found string")
    url = registry.download_source(F.lit("k"), F.lit("f.csv"), F.col("resource_id"), F.col("direct"), F.col("found"))
    base = "https://ckan0.cf.opendata.inter.prod-toronto.ca/dataset/k/resource/"
    assert [r[0] for r in df.select(url).collect()] == [
        "http://direct", base + "id/download/f.csv", "http://found", base + "found/download/f.csv", None]


def test_damaged_files_are_set_aside(spark, tmp_path):
    good = "E1,2024-01-01,5,43.70,-79.40,Assault,x,y"
    texts = {
        "major-crime-indicators_1.csv": f"{HEADER}\n{good}\n",
        "open_quote_2.csv": f'{HEADER}\n{good}\nE2,2024-01-01,5,43.7,-79.4,"Assault,x,y\nE3,2024-01-01,5,43.7,-79.4,Assault,x,y\n',
        "too_long_3.csv": f"{HEADER}\n{good}\n{good},more\n",
        "quoted_comma_4.csv": f'{HEADER}\n{good}\nE2,2024-01-01,5,43.7,-79.4,"Assault, and ""more""",x,y\nE3,2024-01-01\n',
        "break_5.csv": f'{HEADER}\nE2,2024-01-01,5,43.7,-79.4,Assault,"x\nx",y\n{good}\n',
        "break_too_long_6.csv": f'{HEADER}\nE2,2024-01-01,5,43.7,-79.4,Assault,"x\nx",y\n{good},more\n',
        "empty_7.csv": "",
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    landing = bronze.scan_landing(spark, str(tmp_path))
    reasons = {f["file_name"]: f["reason"] for f in landing.unusable}
    assert reasons.pop("empty_7.csv", "empty file") == "empty file"
    assert reasons == {"open_quote_2.csv": "unterminated quote", "too_long_3.csv": bronze.TOO_MANY_CELLS, "break_too_long_6.csv": bronze.TOO_MANY_CELLS}
    counts = {r[0]: r[1] for f in landing.frames for r in f.groupBy("source_file").count().collect()}
    assert counts == {"major-crime-indicators_1.csv": 1, "quoted_comma_4.csv": 3, "break_5.csv": 2}
    assert {f["file_name"]: f["record_count"] for f in landing.files} == {"major-crime-indicators_1.csv": 1, "quoted_comma_4.csv": 3, "break_5.csv": None}


def test_stored_manifest(spark, landing, monkeypatch):
    """The same scan with and without; text is read once per file and time, also of damaged and empty files."""
    facts, read = shared_dir(spark, "manifest"), []
    real = bronze.file_manifest
    monkeypatch.setattr(bronze, "file_manifest", lambda spark, paths, pattern="*.csv": read.append(paths) or real(spark, paths, pattern))

    def scan(**options):
        got = bronze.scan_landing(spark, str(landing), **options)
        return got.files, got.unusable, sorted(map(repr, rows(bronze.union_layouts(got.frames))))

    def names():
        return sorted(p.rsplit("/", 1)[-1] for p in read.pop())

    (landing / "cut.csv").write_text(f'{HEADER}\nE1,2024-01-01,5,43.7,-79.4,Assault,"x,y\n')
    (landing / "one line.csv").write_text("\n")
    assert scan(manifest=facts) == scan() and len(read) == 2
    read.pop()
    assert names() == sorted([A, B, C, "cut.csv", "one line.csv"])
    assert scan(manifest=facts)[1] and read == []
    late = "assault_20240105_000000.csv"
    (landing / late).write_text(f"{HEADER}\nE9,2024-01-05,5,43.70,-79.40,Assault,x,y\n")
    (landing / "cut.csv").write_text(f"{HEADER}\nE1,2024-01-01,5,43.7,-79.4,Assault,x,y\n")
    with_facts = scan(manifest=facts)
    assert names() == [late, "cut.csv"] and read == []
    assert with_facts == scan() and [u["file_name"] for u in with_facts[1]] == ["one line.csv"]
