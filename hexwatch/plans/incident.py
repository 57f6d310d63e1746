"""Bronze -> silver -> gold as one lazy lineage. The only shuffle is the deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexwatch.operators import clean, keyindex, load
from hexwatch.session import require_utc, shared_dir
from hexwatch.settings import GOLD_SCHEMA, RAW_KEY, SILVER_COLUMNS
from hexwatch.sources.bronze import ROW_POS, SOURCE_FILE, exact, latest_file, list_files, scan_landing
from hexwatch.sources.gold import with_reject_reason


def silver(
    raw: DataFrame | list[DataFrame], skip_validation: bool = False, across_files: bool = False,
    formats: list[str] | None = None, key_index: str | None = None, files: list[str] | None = None,
) -> DataFrame:
    """Deduplicate, filter to the region (unless switched off, P8), project, drop incomplete rows.

    Deduplication decides before the filters do: an event whose first copy has bad coordinates is gone. The columns
    are cleaned ahead of it all the same. Cleaning is row by row, so the result does not change, while the shuffle
    carries parsed values instead of text and the filters after it read finished columns instead of parsing again.
    Layouts that have the key share one shuffle; layouts without it are made distinct on their own columns, and with
    `across_files` several such layouts also on the cleaned columns. `formats` adds date formats.

    With `key_index` (`operators.keyindex`) and the names of the `files` of this load, rows whose key an earlier load of another
    file holds are dropped as well, and the keys of this load are added; the deduplicated rows are stored once for that. Rows of layouts
    without the key are told apart within the load only.
    """
    frames = raw if isinstance(raw, list) else [raw]
    keyed = [cleaned(f, formats) for f in frames if RAW_KEY in f.columns]
    plain = [cleaned(clean.distinct_rows(f, across_files), formats) for f in frames if RAW_KEY not in f.columns]
    kept = plain
    if across_files and len(plain) > 1:
        content = [c for c in SILVER_COLUMNS if c not in (SOURCE_FILE, "dataset_type")]
        first = F.min(F.struct(SOURCE_FILE, "dataset_type")).alias("first")
        kept = [_union(plain).groupBy(*content).agg(first).select(*content, "first.*").select(*SILVER_COLUMNS)]
    if keyed:
        first = clean.dedup_first(_union(keyed), across_files=across_files or key_index is not None)
        if key_index is not None:
            first = _first_of_all_loads(first, key_index, files or [])
        kept = [*kept, first.drop(RAW_KEY, ROW_POS)]
    rows = _union(kept)
    if not skip_validation:
        rows = clean.filter_region(rows)
    return clean.drop_missing_critical(rows)


def _first_of_all_loads(rows: DataFrame, key_index: str, files: list[str]) -> DataFrame:
    spark, path = rows.sparkSession, shared_dir(rows.sparkSession, "first-rows")
    keyindex.drop_known(rows, key_index, files).write.parquet(path)
    kept = spark.read.schema(rows.schema).parquet(path)
    keyindex.add_keys(kept, key_index, files)
    return kept


def cleaned(frame: DataFrame, formats: list[str] | None = None) -> DataFrame:
    """One raw layout to the eight cleaned columns, plus key and row position where it has them."""
    return clean.to_silver_schema(clean.with_coordinates(clean.canonical(frame)), formats=formats)


def gold(silver_df: DataFrame, source_tz: str | None = None) -> DataFrame:
    """Cells and the stored schema; narrow transformations only."""
    require_utc(silver_df.sparkSession)
    return load.to_gold_schema(load.assign_cells(silver_df), source_tz)


def gold_or_refused(silver_df: DataFrame, source_tz: str | None = None) -> DataFrame:
    """As `gold`, but rows that the stored table would refuse stay, with their `reject_reason`."""
    require_utc(silver_df.sparkSession)
    return with_reject_reason(load.to_gold_schema(load.with_cells(silver_df), source_tz, complete=False))


def pipeline(
    spark: SparkSession, paths, multi_line: bool | None = None, encoding: str | None = None, source_tz: str | None = None,
    latest_only: bool = False, manifest: str | None = None, **options,
) -> DataFrame:
    """All raw files under `paths`, or with `latest_only` the newest of each dataset, to the gold schema.

    Files whose header lacks needed columns are left out; `sources.bronze.scan_landing` names them. No usable file gives an
    empty table. `manifest` is the folder of known file facts, see there. Further options are those of `silver`.
    """
    if latest_only:
        paths = [exact(r["path"]) for r in latest_file(list_files(spark, paths)).select("path").collect()]
    frames = scan_landing(spark, paths, encoding, multi_line, manifest=manifest).frames if paths else []
    if not frames:
        return spark.createDataFrame([], GOLD_SCHEMA).select(*load.GOLD_COLUMNS, "geom")
    return gold(silver(frames, **options), source_tz)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
