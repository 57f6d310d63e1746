"""One query per operator, over the whole driver tables. Keys start with the operator's id in the survey."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hexwatch.functions import hexcover, hexgrid, metrics_json, naming, numbers, text, times
from hexwatch.operators import aggregates, boosting, clean, columns, features, joins, keyindex, ledger, load, model, quality, sketches
from hexwatch.plans import incident, testview
from hexwatch.plans.testview import raw_incidents, table
from hexwatch.session import shared_dir
from hexwatch.settings import RAW_KEY, SILVER_COLUMNS, SILVER_CRITICAL, Box
from hexwatch.sources import bronze, registry
from hexwatch.sources import gold as gold_io
from hexwatch.sources import silver as silver_io
from hexwatch.sources.bronze import ROW_POS
from hexwatch.streaming.arrivals import load_arrivals
from hexwatch.streaming.live_counts import live_counts, live_first_counts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MCI = "major-crime-indicators"
SHOOTINGS = "shootings-firearm-discharges"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# Shared inputs


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return raw_incidents(spark, sf)


def with_pos(df: DataFrame, *cols) -> DataFrame:
    return df.select(F.col(ROW_POS).alias("pos"), *cols)


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return incident.cleaned(raw(spark, sf))


def silver(spark: SparkSession, sf: str) -> DataFrame:
    return incident.silver(raw(spark, sf))


def gold(spark: SparkSession, sf: str) -> DataFrame:
    return incident.gold(silver(spark, sf))


def counts(spark: SparkSession, sf: str) -> DataFrame:
    return features.hourly_counts(gold(spark, sf))


def plain(df: DataFrame) -> DataFrame:
    """Comparable output: wall-clock times, doubles for decimals, point fields as columns."""
    cols = []
    for name, kind in df.dtypes:
        if kind == "timestamp":
            cols.append(F.col(name).cast("timestamp_ntz").alias(name))
        elif kind.startswith("decimal"):
            cols.append(F.col(name).cast("double").alias(name))
        elif name == "geom":
            cols += [F.col("geom.x").alias("x"), F.col("geom.y").alias("y"), F.col("geom.srid").alias("srid")]
        else:
            cols.append(F.col(name))
    return df.select(*cols)


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in cols})


def gold_rows(df: DataFrame) -> DataFrame:
    return plain(df.drop("geom"))


def ledger_events(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    kind = (
        F.when(F.col("event_type") == "signup", "start").when(F.col("event_type") == "view", "fail")
        .when(F.col("event_type") == "click", "gold_complete").otherwise("complete")
    )
    at = F.col("ts").cast("timestamp")
    return e.select(
        F.concat(F.lit("file_"), F.col("user_id").cast("string"), F.lit(".csv")).alias("file_name"),
        kind.alias("kind"), F.col("event_id").alias("seq"), at.alias("at"),
        F.floor("value").cast("bigint").alias("record_count"),
        F.when(F.col("event_id") % 3 != 0, at).alias("last_timestamp"),
        F.repeat("props", 120).alias("error_message"),
        F.when(F.col("event_id") % 4 == 0, MCI).when(F.col("event_id") % 4 == 1, SHOOTINGS).alias("dataset_type"),
    )


def ledger_now(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.fold(ledger_events(spark, sf))


def arrived_files(spark: SparkSession, sf: str) -> DataFrame:
    """A file table in the shape of `bronze.list_files`, one file per (user, source file)."""
    e = table(spark, sf, "events").join(
        raw(spark, sf).select(F.col(ROW_POS).alias("event_id"), "source_file"), "event_id"
    )
    return e.groupBy("user_id", F.col("source_file").alias("file_name")).agg(
        F.max("ts").alias("modified_at"), F.count(F.lit(1)).alias("bytes")
    ).select(
        F.concat(F.lit("dir/"), "file_name", F.lit("/"), F.col("user_id").cast("string")).alias("path"),
        "file_name", "modified_at", "bytes", naming.dataset_type_of(F.col("file_name")).alias("dataset_type"),
    )


def model_writes(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return e.select(
        F.concat(F.lit("model_"), F.col("user_id").cast("string")).alias("model_id"),
        F.col("event_id").cast("string").alias("version"),
        F.lit("logistic_regression").alias("model_type"),
        F.col("ts").cast("timestamp").alias("trained_at"),
        F.concat(F.lit("models/"), F.col("event_id").cast("string")).alias("artifact_path"),
        (F.col("event_type") == "click").alias("is_active"),
        metrics_json.metrics_map(roc_auc=F.round("value", 2)).alias("metrics"),
        F.col("event_id").alias("write_seq"),
    )


def scored_events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        (F.col("value") / (F.col("value") + 50)).alias("risk"),
        F.col("event_type").isin("click", "view").cast("int").alias("target_binary"),
    )


def holidays(spark: SparkSession, sf: str) -> DataFrame:
    days = table(spark, sf, "events").select(F.to_date("ts").alias("holiday_date"))
    return days.where(F.dayofmonth("holiday_date") % 10 == 1).distinct()


def catalog_packages(spark: SparkSession, sf: str) -> DataFrame:
    """Catalog responses as JSON text, one per line item, each with three resources."""
    items = table(spark, sf, "lineitem")

    def named(prefix: str, col: str):
        return F.concat(F.lit(prefix), F.col(col).cast("string"))

    def resource(id_, format_, url, download_url):
        return F.struct(id_.alias("id"), format_.alias("format"), url.alias("url"), download_url.alias("download_url"))

    none = F.lit(None).cast("string")
    resources = F.array(
        resource(named("doc-", "l_partkey"), F.lit("PDF"), none, F.lit("")),
        resource(
            F.when(F.col("l_linenumber") % 2 == 1, named("res-", "l_orderkey")).otherwise(""),
            F.when(F.col("l_returnflag") == "A", "csv").otherwise("XLSX"),
            F.when(F.col("l_quantity") > 25, named("http://data/", "l_partkey")), none,
        ),
        resource(
            none, F.when(F.col("l_linestatus") == "O", "CSV").otherwise("json"), none,
            F.when(F.col("l_quantity") <= 10, named("http://dl/", "l_suppkey")).otherwise(""),
        ),
    )
    body = F.struct((F.col("l_linenumber") % 5 != 0).alias("success"), F.struct(resources.alias("resources")).alias("result"))
    return items.select(F.col("l_orderkey").alias("package"), F.to_json(body).alias("response"))


# 2.1 sources and sinks


def _write_csv(rows: DataFrame, path: str, encoding: str = "UTF-8") -> None:
    (
        rows.write.option("header", "true").option("encoding", encoding).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)
    )


@query
def s1_scan_bronze(spark, sf):
    """Two encodings, folders whose names the readers would decode or expand, cells with line breaks and quotes."""
    out = shared_dir(spark, "bronze")
    name = F.replace("NEIGHBOURHOOD_158", F.lit("O"), F.lit("Ö"))
    name = F.when(F.col(ROW_POS) % 11 == 0, F.replace(name, F.lit(" "), F.lit("\n"))).when(F.col(ROW_POS) % 13 == 0, F.replace(name, F.lit("("), F.lit('"'))).otherwise(name)
    rows = raw(spark, sf).withColumn("NEIGHBOURHOOD_158", name).withColumnRenamed(ROW_POS, "pos").drop("source_file")
    _write_csv(rows.where("pos % 2 = 0"), f"{out}/new files%20[1]")
    _write_csv(rows.where("pos % 2 = 1"), f"{out}/old+{{a}}", "ISO-8859-1")
    frames = bronze.scan_bronze(spark, out)
    both = bronze.union_layouts(frames).withColumn("pos", F.col("pos").cast("bigint"))
    return both.select("pos", RAW_KEY, "OCC_DATE", "OCC_HOUR", "LAT_WGS84", "LONG_WGS84", "MCI_CATEGORY",
                       "NEIGHBOURHOOD_158", "PREMISES_TYPE")


@query
def s1_mixed_landing(spark, sf):
    """Incident files beside files of another kind: the incidents are loaded, the others named. Every row has a key of its
    own here, so that the number of files does not matter."""
    out = shared_dir(spark, "mixed")
    _write_csv(raw(spark, sf).withColumn(RAW_KEY, F.col(ROW_POS).cast("string")).drop("source_file", ROW_POS), f"{out}/incidents")
    table(spark, sf, "orders").select("o_orderkey", "o_totalprice").write.option("header", "true").csv(f"{out}/orders")
    table(spark, sf, "nation").select("n_name").write.text(f"{out}/notes")
    cells = incident.pipeline(spark, out).groupBy(F.col("h3_index").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    aside = bronze.scan_landing(spark, out).set_aside(spark).select(F.col("reason").alias("name"), F.lit(1).cast("bigint").alias("n"))
    return cells.union(aside.distinct())


@query
def s1_stored_manifest(spark, sf):
    """Two deliveries, each scanned when it has come: the second scan reads only its own text for encodings and layouts, and no file's facts
    are stored twice."""
    out, facts = shared_dir(spark, "delivered"), shared_dir(spark, "manifest")
    rows = _stored(raw(spark, sf).withColumn(RAW_KEY, F.col(ROW_POS).cast("string")), "raw-rows")
    for part in range(2):
        _write_csv(rows.where(F.col(ROW_POS) % 2 == part).drop("source_file", ROW_POS), f"{out}/part{part}")
        cells = incident.pipeline(spark, out, manifest=facts).groupBy("h3_index").agg(F.count(F.lit(1)).alias("n"))
    known = spark.read.schema(bronze.MANIFEST_SCHEMA).parquet(facts)
    twice = known.groupBy("path").agg(F.count(F.lit(1)).alias("times")).agg(F.count_if(F.col("times") > 1).alias("n"))
    lines = known.agg(F.sum(F.greatest(F.col("lines") - 1, F.lit(0))).alias("n"))
    extra = twice.select(F.lit("read twice").alias("h3_index"), "n").union(lines.select(F.lit("raw rows").alias("h3_index"), "n"))
    return cells.union(extra)


@query
def s2_split_scan(spark, sf):
    """A file read in many splits keeps its row order: the position numbers the rows in the order written."""
    out = shared_dir(spark, "splits")
    _write_csv(raw(spark, sf).select(F.col(ROW_POS).cast("string").alias("pos"), "OCC_DATE").repartitionByRange(4, F.col("pos").cast("bigint")).sortWithinPartitions(F.col("pos").cast("bigint")), out)
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, str(1 << 17))
        (frame,) = bronze.scan_bronze(spark, out)
        previous = F.lag(F.col("pos").cast("bigint")).over(Window.partitionBy("source_file").orderBy(ROW_POS))
        return frame.select(F.col("pos").cast("bigint").alias("pos"), (F.coalesce(previous, F.lit(-1)) < F.col("pos").cast("bigint")).alias("in_order")).transform(lambda df: _stored(df, "split-rows"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@query
def s3_latest_file(spark, sf):
    return bronze.latest_file(arrived_files(spark, sf))


@query
def s4_s5_silver_parquet(spark, sf):
    path = shared_dir(spark, "silver")
    silver_io.write_silver(silver(spark, sf), path)
    return silver_io.scan_silver(spark, path).select(*SILVER_COLUMNS)


@query
def s4_s5_silver_csv(spark, sf):
    path = shared_dir(spark, "silver-csv")
    silver_io.write_silver(silver(spark, sf), path, fmt="csv")
    return silver_io.scan_silver(spark, path, fmt="csv").select(*SILVER_COLUMNS)


@query
def s6_write_gold(spark, sf):
    path = shared_dir(spark, "gold")
    rows = gold(spark, sf)
    for _ in range(2):  # loading again replaces, it does not duplicate
        gold_io.write_gold(rows, path)
    return plain(gold_io.scan_gold(spark, path))


@query
def s6_replace_changed_type(spark, sf):
    """Files are loaded without a dataset type, then typed, then some become empty; refused rows are kept apart."""
    path = shared_dir(spark, "gold-replaced")
    rows = _stored(incident.gold_or_refused(clean.drop_missing_critical(clean.filter_region(cleaned(spark, sf))).withColumn(
        "crime_type", F.when(F.col("crime_type") == "Robbery", F.repeat(F.lit(" "), 3)).otherwise(F.col("crime_type")))), "tagged")
    refused = F.when(F.col("crime_type") == "   ", F.lit("blank type"))
    rows = rows.withColumn("reject_reason", F.coalesce("reject_reason", refused))
    gold_io.write_gold(rows.withColumn("dataset_type", F.lit(None).cast("string")), path)
    gold_io.write_gold(rows, path)
    emptied = [r[0] for r in rows.where(F.col("source_file").startswith("theft")).select("source_file").distinct().collect()]
    gold_io.write_gold(rows.limit(0), path, files=emptied)
    kept = gold_io.scan_gold(spark, path).groupBy("source_file", "dataset_type").agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit("kept"))
    aside = gold_io.scan_quarantine(spark, path).groupBy("source_file", "dataset_type").agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit("refused"))
    return kept.unionByName(aside)


@query
def s6_quarantine(spark, sf):
    rows = hexgrid.with_h3(cleaned(spark, sf)).withColumn(
        "h3_index", F.when(clean.in_box(F.col("latitude"), F.col("longitude")), F.col("h3_index"))
    )
    tagged = gold_io.with_reject_reason(rows)
    return tagged.groupBy(F.coalesce("reject_reason", F.lit("loadable")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


@query
def s7_dataset_registry(spark, sf):
    per_type = cleaned(spark, sf).groupBy("dataset_type").agg(F.count(F.lit(1)).alias("n"))
    entries = registry.dataset_registry(spark)
    joined = entries.join(per_type, entries.dataset_key == per_type.dataset_type, "left")
    return joined.select(*entries.columns, F.coalesce("n", F.lit(0)).alias("row_count"))


@query
def s8_resource_url(spark, sf):
    per_file = cleaned(spark, sf).groupBy("source_file", "dataset_type").agg(F.count(F.lit(1)).alias("row_count"))
    known = joins.join_registry(per_file, registry.dataset_registry(spark))
    resource = F.coalesce("resource_id", F.concat(F.lit("res-"), "source_file"))
    url = registry.resource_url(F.col("dataset_type"), resource, F.col("filename"))
    return known.select("source_file", "row_count", F.when(F.col("is_known"), url).alias("url"))


@query
def s9_pick_resource(spark, sf):
    parsed = catalog_packages(spark, sf).select("package", registry.parse_catalog(F.col("response")).alias("p"))
    return parsed.select("package", registry.pick_resource(F.col("p")).alias("resource"))


@query
def s10_download_source(spark, sf):
    picked = s9_pick_resource(spark, sf)
    key = F.col("package").cast("string")
    direct = F.when(F.col("package") % 7 == 0, F.concat(F.lit("http://direct/"), key))
    known = F.when(F.col("package") % 5 == 0, "known")
    url = registry.download_source(F.concat(F.lit("k"), key), F.lit("f.csv"), known, direct, F.col("resource"))
    return picked.select("package", url.alias("url"))


# 2.2 column resolution, projections, filters


@query
def p1_resolve_headers(spark, sf):
    rows = raw(spark, sf).withColumnsRenamed({
        "OCC_DATE": " Occurrence_Date", "LAT_WGS84": "Lat", "LONG_WGS84": "Long", "NEIGHBOURHOOD_158": "Neighbourhood",
        "OCC_HOUR": "Occurrence_Time",
    }).withColumn("latitude", F.lit(None).cast("string"))
    found = columns.resolve_headers([c for c in rows.columns if c not in ("source_file", ROW_POS)])
    return rows.groupBy("source_file").agg(*[F.count(F.col(f"`{c}`")).alias(k) for k, c in found.items()])


@query
def p2_coordinates(spark, sf):
    """Several coordinate columns: the last one of each kind counts."""
    rows = raw(spark, sf).withColumn("lat_copy", F.lit("1"))
    rows = rows.select(F.lit("1").alias("Latitude"), F.lit("2").alias("lon"), *rows.columns)
    return with_pos(clean.canonical(rows), "raw_lat", "raw_lon")


@query
def p3_date_hour(spark, sf):
    rows = raw(spark, sf)
    rows = rows.select(F.lit("x").alias("OCC_DATE_OLD"), F.lit("y").alias("occ_hour_old"), *rows.columns)
    return with_pos(clean.canonical(rows), "raw_date", "raw_hour")


@query
def p4_category(spark, sf):
    rows = raw(spark, sf)
    rows = rows.select(F.lit("x").alias("CRIME_TYPE"), *rows.columns)
    return with_pos(clean.canonical(rows), "raw_category")


@query
def p5_neighbourhood_premise(spark, sf):
    rows = raw(spark, sf).drop("PREMISES_TYPE").withColumn("NEIGHBORHOOD_OLD", F.lit("x"))
    return with_pos(clean.canonical(rows), "raw_neighbourhood", "raw_premise")


@query
def p6_filter_coordinates(spark, sf):
    return with_pos(clean.filter_region(cleaned(spark, sf)), "latitude", "longitude")


@query
def p7_recheck_region(spark, sf):
    """Gold alone, on rows whose cleaning skipped the region check."""
    return gold_rows(incident.gold(incident.silver(raw(spark, sf), skip_validation=True)))


@query
def p8_skip_validation(spark, sf):
    return incident.silver(raw(spark, sf), skip_validation=True).select(*SILVER_COLUMNS)


@query
def p9_drop_missing_critical(spark, sf):
    return with_pos(clean.drop_missing_critical(cleaned(spark, sf)), *SILVER_COLUMNS)


@query
def p10_drop_null_cell(spark, sf):
    return with_pos(hexgrid.with_h3(cleaned(spark, sf)).where("h3_index is not null"))


@query
def p11_silver_schema(spark, sf):
    return cleaned(spark, sf).select(*SILVER_COLUMNS)


@query
def p12_gold_schema(spark, sf):
    return plain(gold(spark, sf))


@query
def p13_truncate(spark, sf):
    docs = table(spark, sf, "documents")
    names = ["crime_type", "neighbourhood", "premise_type", "h3_index", "source_file", "dataset_type"]
    return clean.truncate_text(docs.select("doc_id", *[F.col("text").alias(c) for c in names]))


@query
def p14_domain_flag(spark, sf):
    flagged = clean.with_domain_flag(silver(spark, sf))
    return flagged.groupBy("crime_type", "in_domain").agg(F.count(F.lit(1)).alias("row_count"))


@query
def p15_equality_filters(spark, sf):
    legacy = testview.FILES[9]
    return gold_rows(gold(spark, sf).where((F.col("dataset_type") == MCI) & (F.col("source_file") == legacy)))


@query
def p16_bounding_box(spark, sf):
    return gold_rows(clean.filter_region(gold(spark, sf), box=Box(43.6, 43.7, -79.5, -79.3)))


def _stored_gold(spark, sf):
    path = shared_dir(spark, "gold")
    gold_io.write_gold(gold(spark, sf), path)
    return gold_io.scan_gold(spark, path)


@query
def p16_box_by_cell(spark, sf):
    """The box of a stored table, by ranges of cells and then by coordinates."""
    return gold_rows(_stored_gold(spark, sf).where(hexcover.in_box_by_cell(Box(43.6, 43.7, -79.5, -79.3))))


@query
def h1_parent_cells(spark, sf):
    cells = gold(spark, sf).groupBy("h3_index").agg(F.count(F.lit(1)).alias("n"))
    return cells.select("h3_index", "n", *(hexcover.parent_cell(F.col("h3_index"), r).alias(f"parent_{r}") for r in (8, 7, 4)))


# 2.3 joins


@query
def j1_registry_join(spark, sf):
    per_file = cleaned(spark, sf).groupBy("source_file", "dataset_type").agg(F.count(F.lit(1)).alias("row_count"))
    return joins.join_registry(per_file, registry.dataset_registry(spark)).select(
        "source_file", "dataset_type", "name", "is_known", "row_count"
    )


def _renamed(files: DataFrame) -> DataFrame:
    """About half of the names are in the ledger."""
    user = F.element_at(F.split("path", "/"), -1).cast("bigint")
    return files.withColumn("file_name", F.concat(F.lit("file_"), (user * 2).cast("string"), F.lit(".csv")))


@query
def j2_unseen_files(spark, sf):
    files = _renamed(arrived_files(spark, sf))
    return joins.unseen_files(files, ledger_now(spark, sf)).select("path")


@query
def j2_unseen_or_failed(spark, sf):
    files = _renamed(arrived_files(spark, sf))
    return joins.unseen_files(files, ledger_now(spark, sf), retry_failed=True).select("path")


@query
def j3_drop_loaded(spark, sf):
    rows = gold(spark, sf)
    return gold_rows(joins.drop_loaded(rows, rows.where(F.col("source_file").startswith("police"))))


@query
def j4_backfill_dataset_type(spark, sf):
    files = gold(spark, sf).select(F.col("source_file").alias("file_name")).distinct()
    entries = files.withColumn("dataset_type", F.when(F.col("file_name").startswith("other"), "filled").otherwise("unused"))
    filled = joins.backfill_dataset_type(gold(spark, sf), entries)
    return filled.groupBy("source_file", "dataset_type").agg(F.count(F.lit(1)).alias("row_count"))


@query
def j5_densify_cell(spark, sf):
    return features.densify(counts(spark, sf))


@query
def j5_densify_table(spark, sf):
    return features.densify(counts(spark, sf), span="table")


def _risk_table(spark, sf):
    feats = features.build_features(gold(spark, sf), span=None)
    last_day = F.col("crimes_last_24h")
    return feats.withColumn("risk", last_day / (F.lit(1.0) + last_day))


@query
def j6_score_requests(spark, sf):
    """Requests one hour after each kept incident, at its place."""
    kept = clean.keep_first(cleaned(spark, sf), ["source_file", RAW_KEY], [ROW_POS])
    requests = clean.drop_missing_critical(clean.filter_region(kept)).select(
        F.col(ROW_POS).alias("pos"), "latitude", "longitude",
        F.timestamp_add("HOUR", F.lit(1), F.col("occurred_at")).alias("requested_at"),
    )
    answered = joins.score_requests(requests, _risk_table(spark, sf))
    return rounded(plain(answered.select("pos", "h3_index", "time_window", "risk")), "risk")


# 2.4 aggregates


@query
def a1_counts_by_cell_hour(spark, sf):
    return plain(aggregates.counts_by_cell_hour(gold(spark, sf)))


@query
def a2_total(spark, sf):
    return aggregates.summary(gold(spark, sf)).select("total")


@query
def a3_non_null_counts(spark, sf):
    return aggregates.summary(gold(spark, sf)).select("total", "with_cell", "with_point")


@query
def a4_distinct_cells(spark, sf):
    return aggregates.summary(gold(spark, sf)).select("distinct_cells")


@query
def a4_distinct_over_loads(spark, sf):
    """Three loads by month, sketched one after the other; rows are exact, distinct counts within four standard errors of the rows'."""
    base = shared_dir(spark, "sketched-loads")
    rows = _stored(gold(spark, sf), "gold-rows")
    for part in range(3):
        gold_io.write_gold(rows.where(F.month("occurred_at") % 3 == part), f"{base}/gold", mode="append")
        sketches.update(spark, f"{base}/gold", f"{base}/sketches")
    merged = sketches.distinct_counts(sketches.current(spark, f"{base}/gold", f"{base}/sketches"), "dataset_type")
    exact = rows.groupBy("dataset_type").agg(
        F.countDistinct("h3_index").alias("exact_cells"), F.countDistinct("h3_index", times.hour_start(F.col("occurred_at"))).alias("exact_hours"))

    def near(estimate: str, count: str):
        return (F.abs(F.col(estimate) - F.col(count)) <= 4 * sketches.ERROR * F.col(count)).alias(f"{estimate}_near")

    both = merged.join(exact.withColumnRenamed("dataset_type", "type"), F.col("dataset_type").eqNullSafe(F.col("type")))
    return both.select(
        "dataset_type", "crime_count", "exact_cells", "exact_hours", near("distinct_cells", "exact_cells"), near("distinct_cell_hours", "exact_hours"))


@query
def a4_shared_cells(spark, sf):
    """Cells that two datasets share, by intersected sketches."""
    base = shared_dir(spark, "shared-cells")
    rows = _stored(gold(spark, sf), "gold-rows")
    gold_io.write_gold(rows, f"{base}/gold")
    sketches.update(spark, f"{base}/gold", f"{base}/sketches")
    merged = sketches.shared_cells(sketches.current(spark, f"{base}/gold", f"{base}/sketches"), MCI, SHOOTINGS)
    sides = rows.where(F.col("dataset_type").isin(MCI, SHOOTINGS)).groupBy("h3_index").agg(F.countDistinct("dataset_type").alias("sides"))
    exact = sides.agg(F.count_if(F.col("sides") == 2).alias("exact_shared"), F.count("*").alias("exact_all"))
    allowed = 4 * sketches.ERROR * F.col("exact_all")
    both = exact.unionByName(merged, allowMissingColumns=True)
    return both.agg(*(F.max(c).alias(c) for c in both.columns)).select(
        "exact_shared", "exact_all", (F.abs(F.col("shared_cells") - F.col("exact_shared")) <= allowed).alias("shared_near"),
        (F.abs(F.col("all_cells") - F.col("exact_all")) <= allowed).alias("all_near"))


@query
def a5_date_range(spark, sf):
    return plain(aggregates.summary(gold(spark, sf)).select("first_at", "last_at"))


@query
def a6_type_distribution(spark, sf):
    return aggregates.distribution(gold(spark, sf), "crime_type")


@query
def a7_rows_per_file(spark, sf):
    return aggregates.distribution(gold(spark, sf), "source_file")


@query
def a8_rows_per_dataset(spark, sf):
    return aggregates.distribution(gold(spark, sf), "dataset_type")


@query
def a9_daily_counts(spark, sf):
    return plain(aggregates.daily_counts(gold(spark, sf), SHOOTINGS))


@query
def a10_null_counts(spark, sf):
    return aggregates.null_counts(cleaned(spark, sf).select(*SILVER_COLUMNS))


@query
def a11_missing_percentages(spark, sf):
    cols = ["OCC_DATE", "LAT_WGS84", "LONG_WGS84", "MCI_CATEGORY"]
    return rounded(aggregates.missing_percentages(raw(spark, sf), cols, ["source_file"]), "missing_pct")


@query
def a12_coordinate_ranges(spark, sf):
    return aggregates.coordinate_ranges(silver(spark, sf))


@query
def a13_sorted_values(spark, sf):
    return aggregates.sorted_values(silver(spark, sf), "crime_type")


@query
def a14_file_load_stats(spark, sf):
    return plain(aggregates.file_load_stats(gold(spark, sf)))


@query
def a15_stage_funnel(spark, sf):
    return rounded(aggregates.stage_funnel(cleaned(spark, sf)), "removed_pct")


@query
def a16_file_profile(spark, sf):
    return quality.file_profile(raw(spark, sf), extended=True)


@query
def a17_max_lengths(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("text").alias("crime_type"), F.col("text").alias("source_file"))
    return aggregates.max_lengths(docs)


# 2.5 windows


@query
def w1_dedup_first(spark, sf):
    return with_pos(
        clean.dedup_first(cleaned(spark, sf)), F.col(RAW_KEY).alias("id"), "source_file", "crime_type", "occurred_at"
    )


@query
def w1_dedup_across_files(spark, sf):
    return with_pos(clean.dedup_first(cleaned(spark, sf), across_files=True), F.col(RAW_KEY).alias("id"), "source_file")


@query
def w1_dedup_across_loads(spark, sf):
    """The files come in three loads; a copy in a later one is dropped, and loading the second again changes nothing."""
    base = shared_dir(spark, "across-loads")
    rows = _stored(cleaned(spark, sf), "cleaned")
    per_file = rows.groupBy("source_file").agg((F.length("source_file") % 3).alias("load")).collect()
    for load in (0, 1, 2, 1):
        files = [r["source_file"] for r in per_file if r["load"] == load]
        first = clean.dedup_first(rows.where(F.length("source_file") % 3 == load), across_files=True)
        kept = keyindex.drop_known(first, f"{base}/keys", files)
        kept.write.mode("overwrite").parquet(f"{base}/rows/load={load}")
        keyindex.add_keys(spark.read.schema(rows.schema).parquet(f"{base}/rows/load={load}"), f"{base}/keys", files)
    return with_pos(spark.read.parquet(f"{base}/rows"), F.col(RAW_KEY).alias("id"), "source_file", F.col("load").cast("bigint").alias("load"))


def _lookback(name: str, col: str) -> None:
    def run(spark, sf):
        return plain(features.with_lookbacks(counts(spark, sf)).select("h3_index", "hour_no", col))

    run.__name__ = name
    query(run)


_lookback("w2_last_1h", "crimes_last_1h")
_lookback("w3_last_24h", "crimes_last_24h")
_lookback("w4_last_7d", "crimes_last_7d")
_lookback("w5_same_hour_last_week", "same_hour_last_week")
_lookback("w6_rolling_avg_30d", "rolling_avg_30d")


@query
def w7_single_active_model(spark, sf):
    models = model.single_active(model.current_models(model_writes(spark, sf)))
    return plain(models.select("model_id", "version", "trained_at", "is_active"))


@query
def w8_ledger_latest_state(spark, sf):
    return plain(ledger_now(spark, sf).select("file_name", "status", "ingested_at"))


# 2.6 top-k


@query
def t1_latest_model(spark, sf):
    models = model.single_active(model.current_models(model_writes(spark, sf)))
    return plain(model.latest_model(models).select(
        "model_id", "version", "trained_at", F.col("metrics")["roc_auc"].alias("roc_auc")))


@query
def t2_last_ledger_rows(spark, sf):
    return plain(ledger.last_ingested(ledger_now(spark, sf)))


@query
def t3_first_rows(spark, sf):
    """The sampling report: the first 5,000 rows in file order."""
    return with_pos(aggregates.first_rows(cleaned(spark, sf), 5000, [ROW_POS]), *SILVER_COLUMNS)


@query
def t4_ordered_distribution(spark, sf):
    return aggregates.distribution(gold(spark, sf), "neighbourhood")


# 2.7 set operations


@query
def u1_distinct_rows(spark, sf):
    rows = raw(spark, sf).select(
        F.col("OCC_DATE").alias("d"), F.col("LAT_WGS84").alias("lat"), F.col("MCI_CATEGORY").alias("cat"), "source_file", ROW_POS
    )
    return clean.dedup_first(rows)  # no key column: whole rows


@query
def u2_union_layouts(spark, sf):
    rows = raw(spark, sf).withColumnRenamed(ROW_POS, "pos")
    newer = rows.where("pos % 2 = 0").select("pos", "LAT_WGS84", "MCI_CATEGORY")
    older = rows.where("pos % 2 = 1").select("MCI_CATEGORY", F.col("LAT_WGS84").alias("LATITUDE"), "pos")
    return bronze.union_layouts([newer, older])


@query
def u3_upsert_model(spark, sf):
    return plain(model.current_models(model_writes(spark, sf)).select("model_id", "version", "trained_at", "write_seq"))


# 2.8 scalar functions


@query
def f1_crime_type(spark, sf):
    return with_pos(raw(spark, sf), text.clean_category(F.col("MCI_CATEGORY")).alias("crime_type"))


@query
def f2_neighbourhood(spark, sf):
    return with_pos(raw(spark, sf), text.clean_neighbourhood(F.col("NEIGHBOURHOOD_158")).alias("neighbourhood"))


@query
def f3_premise_type(spark, sf):
    return with_pos(raw(spark, sf), text.clean_premise(F.col("PREMISES_TYPE")).alias("premise_type"))


@query
def f4_dataset_type(spark, sf):
    named = raw(spark, sf).withColumn("dataset_type", naming.dataset_type_of(F.col("source_file")))
    return named.groupBy("source_file", "dataset_type").agg(F.count(F.lit(1)).alias("row_count"))


@query
def f5_to_number(spark, sf):
    cols = {"latitude": "LAT_WGS84", "longitude": "LONG_WGS84", "hour_number": "OCC_HOUR"}
    return with_pos(raw(spark, sf), *[numbers.to_number(F.col(c)).alias(k) for k, c in cols.items()])


@query
def f6_occurred_at(spark, sf):
    return with_pos(raw(spark, sf), times.parse_occurred_at(F.col("OCC_DATE"), F.col("OCC_HOUR")).alias("occurred_at"))


@query
def f7_to_utc(spark, sf):
    return plain(table(spark, sf, "events").select(
        "event_id", times.to_utc(F.col("ts")).alias("as_labelled"),
        times.to_utc(F.col("ts"), "America/Toronto").alias("from_eastern")))


@query
def f8_nan_to_null(spark, sf):
    return with_pos(
        raw(spark, sf), text.nan_to_null(F.col("NEIGHBOURHOOD_158")).alias("neighbourhood"),
        text.nan_to_null(F.col("PREMISES_TYPE")).alias("premise_type"))


@query
def f9_decimals(spark, sf):
    rows = cleaned(spark, sf)
    return plain(with_pos(
        rows, numbers.lat_decimal(F.col("latitude") / 3).alias("lat"), numbers.lon_decimal(F.col("longitude") / 3).alias("lon")))


def _calendar(name: str, col: str, expr) -> None:
    def run(spark, sf):
        return table(spark, sf, "events").select("event_id", expr(F.col("ts")).alias(col))

    run.__name__ = name
    query(run)


@query
def f10_truncation(spark, sf):
    return plain(table(spark, sf, "events").select(
        "event_id", times.hour_start(F.col("ts")).alias("hour_start"), times.day_start(F.col("ts")).alias("day_start")))


_calendar("f11_hour_of_day", "hour_of_day", times.hour_of_day)
_calendar("f12_day_of_week", "day_of_week", times.day_of_week)
_calendar("f13_is_weekend", "is_weekend", times.is_weekend)
_calendar("f14_is_night", "is_night", times.is_night)
_calendar("f16_month", "month", times.month)


@query
def f15_is_holiday(spark, sf):
    return times.with_holiday_flag(table(spark, sf, "events"), holidays(spark, sf), "ts").select("event_id", "is_holiday")


@query
def f17_season(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", times.season(F.col("o_orderdate")).alias("season"))


@query
def f18_metrics_json(spark, sf):
    k = metrics_json.read_metrics(F.col("props"))["k"]
    written = metrics_json.write_metrics(metrics_json.metrics_map(recall=F.lit(1.0), roc_auc=k))
    return table(spark, sf, "events").select("event_id", k.alias("k"), written.alias("written"))


@query
def h1_hexagon_cell(spark, sf):
    return with_pos(hexgrid.with_h3(cleaned(spark, sf)), "h3_index")


def _sweep(spark, sf, res):
    points = table(spark, sf, "events").select(
        F.round(F.lit(43.5) + (F.col("event_id") % 401) / F.lit(1000.0), 6).alias("lat"),
        F.round(F.lit(-79.8) + (F.col("event_id") % 797) / F.lit(1000.0), 6).alias("lon"),
    ).distinct()
    return hexgrid.with_h3(points, "lat", "lon", res=res)


@query
def h1_region_sweep(spark, sf):
    return _sweep(spark, sf, 9)


@query
def h1_region_sweep_res8(spark, sf):
    return _sweep(spark, sf, 8)


@query
def h2_make_point(spark, sf):
    rows = with_pos(cleaned(spark, sf), hexgrid.make_point("longitude", "latitude").alias("geom"))
    return plain(rows.where("geom is not null"))


# 2.9 ledger


@query
def l1_start(spark, sf):
    """Starts alone: a repeated start keeps a known dataset type."""
    rows = ledger.fold(ledger_events(spark, sf).where("kind = 'start'"))
    return plain(rows.select("file_name", "ingested_at", "record_count", "status", "dataset_type"))


@query
def l2_l3_l4_fold(spark, sf):
    return plain(ledger_now(spark, sf))


@query
def l2_fold_snapshots(spark, sf):
    """The same state from a snapshot of the first part of the events and the part after it."""
    path, events = shared_dir(spark, "ledger"), ledger_events(spark, sf)
    middle = events.agg(F.floor(F.max("seq") * 0.6)).first()[0]
    ledger.append_events(events.where(F.col("seq") <= middle), path)
    ledger.compact(spark, path)
    ledger.append_events(events.where(F.col("seq") > middle), path)
    ledger.drop_folded(spark, path)
    return plain(ledger.read_state(spark, path))


@query
def l4_gold_completion(spark, sf):
    stats = aggregates.file_load_stats(gold(spark, sf))
    files = stats.select(F.col("source_file").alias("file_name"))
    events = ledger.event(files, "start", F.lit(0)).unionByName(ledger.gold_events(stats, F.lit(1)))
    return plain(ledger.fold(events).select("file_name", "record_count", "status", "last_timestamp"))


@query
def l5_bronze_step(spark, sf):
    files = cleaned(spark, sf).groupBy(F.col("source_file").alias("file_name"), "dataset_type").agg(
        F.count(F.lit(1)).alias("record_count"))
    folded = ledger.fold(ledger.bronze_events(files, F.lit(0)))
    return folded.select("file_name", "record_count", "status", "dataset_type")


# 2.10 validation


@query
def v1_structure(spark, sf):
    """Header names of current files are unknown to the check, so it reports them missing."""
    return quality.validate_raw(raw(spark, sf))


@query
def v2_v3_validate_raw(spark, sf):
    return rounded(quality.validate_raw(raw(spark, sf), extended=True), "value")


@query
def v4_verify_silver(spark, sf):
    """On deduplicated but unfiltered rows, so that some checks fail."""
    return quality.verify_silver(clean.dedup_first(cleaned(spark, sf)))


@query
def v5_verify_gold(spark, sf):
    return quality.verify_gold(gold(spark, sf))


@query
def v6_verify_load(spark, sf):
    expected = clean.dedup_first(cleaned(spark, sf)).groupBy("source_file").agg(F.count(F.lit(1)).alias("expected_count"))
    return quality.verify_load(gold(spark, sf), expected)


@query
def v7_load_summary(spark, sf):
    rows = hexgrid.with_h3(cleaned(spark, sf)).withColumn(
        "h3_index", F.when(clean.in_box(F.col("latitude"), F.col("longitude")), F.col("h3_index")))
    return rounded(quality.load_summary(gold_io.with_reject_reason(rows), ["source_file"]), "success_pct")


@query
def v8_verify_tables(spark, sf):
    names = {"crimes": "events", "ingestion_metadata": "orders", "features": None, "model_metadata": "part"}
    own = {k: f"v8_{uuid.uuid4().hex}_{k}" for k in names}  # stand-ins under names of their own, gone afterwards
    for name, source in names.items():
        if source:
            table(spark, sf, source).createOrReplaceTempView(own[name])
    out = quality.verify_tables(spark, list(own.values()))
    for name in own.values():
        spark.catalog.dropTempView(name)
    return out.withColumn("table_name", F.regexp_replace("table_name", "^v8_[0-9a-f]+_", ""))


# 2.11 features and model


@query
def m1_features_dense(spark, sf):
    return plain(features.build_features(gold(spark, sf), holidays(spark, sf)))


@query
def m1_features_sparse(spark, sf):
    return plain(features.build_features(gold(spark, sf), holidays(spark, sf), span=None))


@query
def m1_features_refreshed(spark, sf):
    """Features of all but one file, then that file arrives and another one is replaced by all of its rows."""
    rows = _stored(gold(spark, sf).select("h3_index", "occurred_at", "source_file"), "gold-rows")
    late, partial = testview.FILES[0], testview.FILES[1]
    some = (F.col("source_file") != late) & ((F.col("source_file") != partial) | (F.hour("occurred_at") < 12))
    before, now = _stored(features.hourly_counts(rows.where(some)), "counts"), _stored(features.hourly_counts(rows), "counts")
    previous = _stored(features.build_features(rows.where(some), holidays(spark, sf)), "features")
    return plain(features.refreshed_features(previous, features.changed_hours(before, now), now, holidays(spark, sf)))


@query
def m2_targets(spark, sf):
    rows = features.with_targets(features.densify(counts(spark, sf)))
    return rows.select("h3_index", "hour_no", "target_crime_count", "target_binary")


CUTOFF = "2024-01-22"


def _split(spark, sf):
    """Stored features with targets, before and from the cutoff."""
    rows = _stored(features.build_features(gold(spark, sf), holidays(spark, sf)), "features")
    return model.split_by_time(rows, F.lit(CUTOFF).cast("timestamp"))


@query
def m3_train_logistic(spark, sf):
    """At the optimum the errors sum to nothing along every input."""
    before, after = _split(spark, sf)
    fitted = model.train(before, "logistic_regression", maxIter=200, tol=1e-10)
    known = model.score(fitted, before).where(F.col("risk").isNotNull())
    error = F.col("risk") - F.col("target_binary")
    x = {c: F.col(c).cast("double") for c in model.INPUTS}
    tight = [F.abs(F.sum(error * v)) <= 1e-3 * F.sum(F.abs(v)) + 1e-6 for v in x.values()]
    ok = tight[0]
    for t in tight[1:]:
        ok = ok & t
    sums = known.agg(F.count(F.lit(1)).alias("train_rows"), ok.alias("at_optimum"))
    return sums.withColumn("test_rows", F.lit(after.count()))


@query
def m3_train_boosted(spark, sf):
    before, after = _split(spark, sf)
    fitted = model.train(before, "gbt", maxIter=3, maxDepth=3, seed=7)
    risk = F.col("risk")
    sums = model.score(fitted, before).agg(
        F.count("risk").alias("train_rows"), (F.count_if(~risk.between(0, 1)) == 0).alias("in_range"),
        (F.abs(F.avg(risk) - F.avg(F.when(risk.isNotNull(), F.col("target_binary")))) < 0.15).alias("near_base_rate"))
    trees = F.lit(fitted.stages[-1].getNumTrees)
    return sums.withColumns({"trees": trees, "test_rows": F.lit(after.count())})


#: Bin edges of the inputs in the order of `model.INPUTS`, the same in the oracle.
EDGES = [[6, 12, 18], [2, 4], [1], [1], [1], [2, 3], [2, 3], [1, 2], [1, 3], [2, 8], [1], [0.01, 0.05]]


def _level(spark, sf):
    """The second level of a tree whose root parts the day at noon; an input is missing at one hour of the day."""
    rows = _stored(features.build_features(gold(spark, sf), holidays(spark, sf)), "features")
    rows = rows.withColumn("crimes_last_7d", F.when(F.hour("time_window") != 5, F.col("crimes_last_7d")))
    held = boosting.binned(rows, model.INPUTS, EDGES, "target_binary")
    return boosting.histogram(held, F.expr("case when b0 <= 2 then 1 else 2 end"), F.lit(0.0), len(EDGES))


@query
def m3_level_histogram(spark, sf):
    return _level(spark, sf)


@query
def m3_best_splits(spark, sf):
    return rounded(boosting.best_splits(_level(spark, sf), boosting.Params()), "gain")


def _boosted(spark, sf, kind, **params):
    before, after = _split(spark, sf)
    fitted = model.train(before, kind, **params)
    y, risk = F.col("target_binary"), F.col("risk")
    loss = F.avg(-y * F.log(risk) - (1 - y) * F.log(1 - risk))
    share = F.avg(y)
    sums = model.score(fitted, before).agg(
        F.count("risk").alias("train_rows"), (F.count_if(~risk.between(0, 1)) == 0).alias("in_range"),
        (loss < -share * F.log(share) - (1 - share) * F.log(1 - share)).alias("better_than_the_mean"),
        (F.abs(F.avg(risk) - share) < 0.15).alias("near_base_rate"))
    leaves = max(len(t.values) for t in fitted.trees)
    return sums.withColumns({"trees": F.lit(len(fitted.trees)), "leaves_bounded": F.lit(leaves <= 5), "test_rows": F.lit(after.count())})


@query
def m3_train_xgboost(spark, sf):
    return _boosted(spark, sf, "xgboost", trees=2, max_depth=2)


@query
def m3_train_lightgbm(spark, sf):
    return _boosted(spark, sf, "lightgbm", trees=2, leaves=5, max_depth=4)


@query
def m4_curve_areas(spark, sf):
    rows = model.score_counts(scored_events(spark, sf))
    return rounded(model.curve_areas(rows, model.score_splits(rows, per_range=50)), "roc_auc", "pr_auc")


@query
def m4_threshold_metrics(spark, sf):
    out = model.threshold_metrics(model.score_counts(scored_events(spark, sf)))
    return rounded(out, *out.columns)


@query
def m5_register_model(spark, sf):
    writes = model_writes(spark, sf)
    models = model.register_model(writes.where("write_seq % 2 = 0"), writes.where("write_seq % 2 = 1"))
    return models.select("model_id", "version", "is_active", "write_seq", F.col("metrics")["roc_auc"].alias("roc_auc"))


@query
def m5_fitted_entry(spark, sf):
    """A registry row made from a fitted model, and the model read back from the row's path."""
    before, after = _split(spark, sf)
    fitted = model.train(before, "logistic_regression", maxIter=20)
    path = shared_dir(spark, "model")
    measured = model.evaluate(model.score(fitted, after), shared_dir(spark, "scores"))
    entry = model.registry_entry(fitted, before, measured, path, "m-1", "v1", "logistic_regression", F.lit("2024-02-01").cast("timestamp"), 1.5, 7)
    again = model.score(model.load_model(path), after).select("h3_index", "time_window", F.col("risk").alias("again"))
    same = model.score(fitted, after).join(again, ["h3_index", "time_window"]).agg((F.count_if(~F.col("risk").eqNullSafe(F.col("again"))) == 0).alias("same_after_load"))
    row = entry.select("model_id", "version", "is_active", "training_samples", "feature_count", F.size("metrics").alias("n_metrics"), F.get_json_object("hyperparameters", "$.maxIter").alias("max_iter"))
    return row.withColumn("_one", F.lit(1)).join(same.withColumn("_one", F.lit(1)), "_one").drop("_one")


@query
def m6_score(spark, sf):
    """One row per input row; the risk is the sigmoid of the fitted coefficients, and absent where an input is."""
    before, after = _split(spark, sf)
    after = after.withColumn("crimes_last_7d", F.when(F.hour("time_window") != 5, F.col("crimes_last_7d")))
    fitted = model.train(before, "logistic_regression", maxIter=10)
    weights = fitted.stages[-1].coefficients
    z = F.lit(float(fitted.stages[-1].intercept))
    for c, w in zip(model.INPUTS, weights):
        z = z + F.col(c).cast("double") * F.lit(float(w))
    expected = 1 / (1 + F.exp(-z))
    agrees = F.coalesce(F.abs(F.col("risk") - expected) < 1e-9, F.col("risk").isNull() & expected.isNull())
    return plain(model.score(fitted, after).select("h3_index", "time_window", "target_binary", F.col("risk").isNull().alias("unknown"), agrees.alias("agrees")))


def _day(text_: str):
    return F.lit(text_).cast("timestamp")


MAP_BOX = Box(43.6, 43.75, -79.5, -79.3)


@query
def m7_heatmap_counts(spark, sf):
    return model.heatmap_counts(gold(spark, sf), MAP_BOX, _day("2024-01-05"), _day("2024-01-20"))


@query
def m7_heatmap_rollup(spark, sf):
    return model.heatmap_counts(_stored_gold(spark, sf), MAP_BOX, _day("2024-01-05"), _day("2024-01-20"), by_cell=True, res=7)


@query
def m7_heatmap_smoothed(spark, sf):
    counts = model.heatmap_counts(gold(spark, sf), MAP_BOX, _day("2024-01-05"), _day("2024-01-20"))
    return model.heatmap_smoothed(counts)


@query
def h1_ring_pairs(spark, sf):
    """Pairs of adjacent cells that both hold incidents."""
    cells = _stored(gold(spark, sf).groupBy("h3_index").agg(F.count(F.lit(1)).alias("n")), "cells")
    pairs = hexgrid.with_ring(cells)
    return pairs.join(cells.select(F.col("h3_index").alias("ring_cell"), F.col("n").alias("ring_n")), "ring_cell")


@query
def m7_heatmap_risk(spark, sf):
    scored = _risk_table(spark, sf)
    return rounded(
        model.heatmap_risk(scored, gold(spark, sf), MAP_BOX, _day("2024-01-05"), _day("2024-01-20")), "mean_risk")


# 2.12 streaming


@query
def r1_arrivals(spark, sf):
    """The events file arrives; a second run finds nothing new."""
    base = shared_dir(spark, "arrivals")

    def scan(session, paths):
        frame = testview.raw_from(session.read.parquet(*paths), table(session, sf, "nation"))
        return bronze.Landing([frame], [{"path": p, "file_name": p.rsplit("/", 1)[-1], "dataset_type": None, "record_count": 0} for p in paths], [])

    for _ in range(2):
        load_arrivals(
            spark, sf, f"{base}/gold", f"{base}/ledger", f"{base}/checkpoint", pattern="events.parquet", scan=scan
        ).awaitTermination()
    return plain(gold_io.scan_gold(spark, f"{base}/gold"))


def _named_files(spark, folder: str, names: dict[str, DataFrame]) -> None:
    """Each table as CSV files whose names begin with its key, as datasets are delivered."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    for name, rows in names.items():
        _write_csv(rows, f"{folder}/{name}")
        path = hadoop.Path(f"{folder}/{name}")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        parts = [s.getPath() for s in fs.globStatus(hadoop.Path(path, "part-*.csv"))]
        for k, part in enumerate(parts):
            fs.rename(part, hadoop.Path(path, f"{name}_20240101_{k:06d}.csv"))


@query
def r1_ledger(spark, sf):
    """Arriving files: a sound dataset, one whose rows are all dropped, and a foreign one; a second run finds nothing new."""
    base = shared_dir(spark, "r1-ledger")
    rows = raw(spark, sf).withColumn(RAW_KEY, F.col(ROW_POS).cast("string")).drop("source_file", ROW_POS)
    _named_files(spark, f"{base}/in", {
        MCI: rows, "theft-from-motor-vehicle": rows.withColumn("LAT_WGS84", F.lit("0")),
        SHOOTINGS: table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("price")),
    })
    for _ in range(2):
        load_arrivals(spark, f"{base}/in", f"{base}/gold", f"{base}/ledger", f"{base}/checkpoint").awaitTermination()
    loaded = gold_io.scan_gold(spark, f"{base}/gold").groupBy("dataset_type").agg(F.count(F.lit(1)).alias("gold_rows"))
    state = ledger.fold(ledger.read_events(spark, f"{base}/ledger")).groupBy("dataset_type", "status", "error_message").agg(F.sum("record_count").alias("raw_rows"))
    raw_rows = F.when(F.col("status") == "completed", F.col("raw_rows"))
    return state.join(loaded, "dataset_type", "left").select("dataset_type", "status", "error_message", raw_rows.alias("raw_rows"), F.coalesce("gold_rows", F.lit(0)).alias("gold_rows"))


def _live_cleaned(spark, sf):
    """The cleaned rows as a stream. Rows are dealt out before cleaning, which else runs in as many tasks as the file has splits."""
    events = spark.readStream.schema(table(spark, sf, "events").schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    events = events.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return incident.cleaned(testview.raw_from(events, table(spark, sf, "nation")))


@query
def r2_live_counts(spark, sf):
    base = shared_dir(spark, "live")
    rows = _live_cleaned(spark, sf)
    rows = load.to_gold_schema(load.assign_cells(clean.drop_missing_critical(clean.filter_region(rows))))
    out = live_counts(rows)
    (
        out.writeStream.format("parquet").outputMode("append").option("path", f"{base}/out")
        .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    )
    return plain(spark.read.schema(out.schema).parquet(f"{base}/out"))


@query
def r2_live_first_counts(spark, sf):
    """Without copies: the closed hours of A1."""
    base = shared_dir(spark, "live-first")
    rows = hexgrid.with_h3(_live_cleaned(spark, sf))
    held = clean.in_box(F.col("latitude"), F.col("longitude"))
    for c in SILVER_CRITICAL:
        held = held & F.col(c).isNotNull()
    rows = rows.withColumns({"h3_index": F.when(held, F.col("h3_index")), "occurred_at": times.to_utc(F.col("occurred_at"), None)})
    out = live_first_counts(rows, [RAW_KEY, bronze.SOURCE_FILE], ROW_POS)
    (
        out.writeStream.format("parquet").outputMode("append").option("path", f"{base}/out")
        .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    )
    return plain(spark.read.schema(out.schema).parquet(f"{base}/out"))
