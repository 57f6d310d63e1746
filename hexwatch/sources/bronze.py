"""Raw CSV scans (S1-S3): file listing, per-file encoding and header layout, strings-only reads.

Files differ in encoding, in columns, and in whether quoted cells hold line breaks. One pass over the text finds, per file,
whether all bytes are UTF-8, a hash of the header line, and whether any line has an unpaired quote; files that share all
three are then read together, so a scan has as many branches as there are distinct layouts, however many files there
are. Files whose header lacks what the cleaning needs are set aside with the reason, and the others are read. What reaches
the driver is the listing and one header line per layout.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexwatch.functions.naming import dataset_type_of
from hexwatch.functions.text import missing_to_null
from hexwatch.operators import columns as names
from hexwatch.settings import DATASETS, LAT_NAMES, LON_NAMES

ROW_POS = "_row_pos"
SOURCE_FILE = "source_file"
PATTERN = "*.csv"
MANIFEST_SCHEMA = (
    "path string, modified_at timestamp, bytes bigint, lines bigint, is_utf8 boolean, unpaired_quotes boolean, "
    "unterminated_quote boolean, layout bigint, header_cells int, most_cells int"
)
UNUSABLE_SCHEMA = "path string, file_name string, reason string"


@dataclass(frozen=True)
class Landing:
    """A scan of a landing folder: one frame per layout, per-file facts, and the files that were set aside."""

    frames: list[DataFrame]
    files: list[dict]
    unusable: list[dict]

    def set_aside(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(f["path"], f["file_name"], f["reason"]) for f in self.unusable], UNUSABLE_SCHEMA)


def _paths(paths: str | Iterable[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def exact(path: str) -> str:
    """A path as the readers take it literally: what they would expand is escaped."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def file_path() -> Column:
    """The path of a row's file as the listing shows it; the reader's own column is percent-encoded."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def row_position() -> Column:
    """File order of a row: where its split starts, then the row's number in the task.

    Rows of one split come out in file order, so the pair grows along the file; it is the same when a lost task runs
    again.
    """
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return F.struct(F.col("_metadata.file_block_start").alias("start"), row.alias("row"))


def list_files(spark: SparkSession, paths: str | Iterable[str], pattern: str = PATTERN) -> DataFrame:
    """Files with name, time, size and dataset type. The content column is pruned, so no file is opened."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(_paths(paths))
    )
    return files.select(
        "path", file_name(F.col("path")).alias("file_name"), F.col("modificationTime").alias("modified_at"),
        F.col("length").alias("bytes"),
    ).withColumn("dataset_type", dataset_type_of(F.col("file_name"), DATASETS))


def latest_file(files: DataFrame, per_dataset: bool = True) -> DataFrame:
    """S3: newest file by modification time, per dataset type or overall."""
    newest = F.max_by(F.struct("path", "file_name", "bytes"), F.struct("modified_at", "path")).alias("newest")
    keys = ["dataset_type"] if per_dataset else []
    return files.groupBy(*keys).agg(newest, F.max("modified_at").alias("modified_at")).select(
        *keys, "newest.path", "newest.file_name", "newest.bytes", "modified_at"
    )


def file_manifest(spark: SparkSession, paths: str | Iterable[str], pattern: str = PATTERN) -> DataFrame:
    """Per file: lines that are not blank, whether all are valid UTF-8, whether quotes are unpaired in any of them or in the
    whole file, the hash of the first line, its number of cells, and the most cells of a line with paired quotes.

    All aggregation buffers are fixed-width, so this is a hash aggregate combined on the map side.
    """
    lines = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .text(_paths(paths))
        .select("value", file_path().alias("path"), row_position().alias("pos"))
    )
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"')))
    unquoted = F.when(quotes > 0, F.regexp_replace("value", '"[^"]*"', "")).otherwise(F.col("value"))
    cells = F.when(quotes % 2 == 0, 1 + F.octet_length(unquoted) - F.octet_length(F.replace(unquoted, F.lit(","))))
    first = F.when(F.col("pos.start") == 0, F.col("pos.row"))
    return lines.groupBy("path").agg(
        F.count_if(F.btrim("value") != "").alias("lines"),
        F.bool_and(F.is_valid_utf8(F.col("value"))).alias("is_utf8"),
        F.bool_or(quotes % 2 == 1).alias("unpaired_quotes"),
        (F.sum(quotes.cast("bigint")) % 2 == 1).alias("unterminated_quote"),
        F.min_by(F.xxhash64("value"), first).alias("layout"),
        F.min_by(cells, first).alias("header_cells"),
        F.max(cells).alias("most_cells"),
    )


def stored_manifest(spark: SparkSession, paths: str | Iterable[str], manifest: str, pattern: str = PATTERN) -> DataFrame:
    """As `file_manifest`, with the facts kept in the folder `manifest` by path, time and size: only text that it does not know is read.

    A file that was written anew has another time or size and is read again. Two scans at once may both store a file's facts, which
    are equal then.
    """
    listed = list_files(spark, paths, pattern).select("path", "modified_at", "bytes")
    keys = listed.columns
    unseen = listed.join(_known_facts(spark, manifest), keys, "left_anti").collect()  # files whose text is about to be read
    if unseen:
        facts = file_manifest(spark, [exact(r["path"]) for r in unseen], "*")
        # Files without a line have no facts of their own and are remembered too.
        found = spark.createDataFrame(unseen, listed.schema).join(facts, "path", "left")
        found.write.mode("append").parquet(manifest)
    return listed.join(_known_facts(spark, manifest).dropDuplicates(keys), keys)


def _known_facts(spark: SparkSession, manifest: str) -> DataFrame:
    try:
        return spark.read.schema(MANIFEST_SCHEMA).parquet(manifest)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST_SCHEMA)


def header_of(spark: SparkSession, path: str, encoding: str) -> list[str]:
    """The names in a file's first line, as written; none if a name holds a line break."""
    first = spark.read.text(exact(path)).select(F.col("value").cast("binary").alias("line")).first()
    text = bytes(first["line"]).decode(encoding, errors="replace").removeprefix("\ufeff") if first else ""
    return next(csv.reader([text]), []) if text.count('"') % 2 == 0 else []


def distinct_names(header: list[str]) -> list[str]:
    """Unique column names: of names that differ only in case, one stays as it is and the others are numbered.

    The last coordinate column wins (P2), of any other name the first. Columns without a name get one from their place.
    """
    out = [name or f"_c{i}" for i, name in enumerate(header)]
    groups: dict[str, list[int]] = {}
    for i, name in enumerate(out):
        groups.setdefault(name.lower(), []).append(i)
    for found in groups.values():
        last = out[found[0]].upper() in (*LAT_NAMES, *LON_NAMES)
        for i in found[:-1] if last else found[1:]:
            out[i] = f"{out[i]}#{i}"
    return out


def read_layout(spark: SparkSession, paths: list[str], encoding: str, multi_line: bool = False, header: list[str] | None = None) -> DataFrame:
    """Read files that share header and encoding. All columns are strings; missing-value texts become NULL.

    With the names of the first line in `header` no file is opened to find them.
    """
    reader = (
        spark.read.option("header", "true")
        .option("inferSchema", "false")
        .option("encoding", encoding)
        .option("escape", '"')
        .option("multiLine", str(multi_line).lower())
        .option("recursiveFileLookup", "true")
    )
    if header:
        reader = reader.schema(T.StructType([T.StructField(n, T.StringType()) for n in distinct_names(header)]))
    raw = reader.csv(paths)
    cells = [missing_to_null(F.col("`" + c.replace("`", "``") + "`")).alias(c) for c in raw.columns]
    return raw.select(*cells, file_name(file_path()).alias(SOURCE_FILE), row_position().alias(ROW_POS))


TOO_MANY_CELLS = "rows with more cells than the header"
OVERFLOW = "_overflow"


def why_damaged(facts) -> str | None:
    """Why rows of a file would be lost in reading, from its row of the manifest, or None. Such files are set aside whole."""
    if facts is None or facts["layout"] is None or not facts["lines"]:
        return "empty file"
    if facts["unterminated_quote"]:
        return "unterminated quote"
    # With line breaks in cells, lines are not rows; `overlong_files` looks at these.
    if not facts["unpaired_quotes"] and facts["most_cells"] > facts["header_cells"]:
        return TOO_MANY_CELLS
    return None


def overlong_files(spark: SparkSession, paths: list[str], encoding: str, header: list[str]) -> set[str]:
    """Of files with line breaks in cells and the same header, those with a row that has more cells than the header."""
    if not header:
        return set()
    frame = read_layout(spark, [exact(p) for p in sorted(paths)], encoding, True, [*header, OVERFLOW])
    names = {r[0] for r in frame.where(F.col(frame.columns[len(header)]).isNotNull()).select(SOURCE_FILE).distinct().collect()}
    return {p for p in paths if p.rsplit("/", 1)[-1] in names}


def why_unusable(columns: list[str]) -> str | None:
    """Why the cleaning could not work on a layout, or None."""
    try:
        names.resolve_coordinates(columns)
        names.resolve_date_hour(columns)
        names.resolve_category(columns)
    except ValueError as e:
        return str(e)
    return None


def scan_landing(
    spark: SparkSession, paths: str | Iterable[str], encoding: str | None = None, multi_line: bool | None = None,
    pattern: str = PATTERN, check: bool = True, manifest: str | None = None,
) -> Landing:
    """All files that match, one frame per (header layout, encoding, line breaks in cells), and those set aside.

    Files of which rows would be lost without a word (a quote without its end, rows with more cells than the header) are set aside
    with the reason. Encodings are decided per file, UTF-8 when all of it is valid, else Latin-1 (which accepts any bytes); whether
    cells hold line breaks is decided by unpaired quotes, and only such files are read whole by one task. Give `encoding`
    or `multi_line` when they are known. Rows are told apart by file name, so equal names in two folders are an error. With `manifest`, a
    folder, what is found about a file is kept there, and later scans read only the text of new and changed files for it.
    """
    listed = {r["path"]: r for r in list_files(spark, paths, pattern).select("path", "file_name", "bytes", "dataset_type").collect()}
    by_name: dict[str, str] = {}
    for path, row in sorted(listed.items()):
        if by_name.setdefault(row["file_name"], path) != path:
            raise ValueError(f"files of equal name: {by_name[row['file_name']]} and {path}")
    facts_of = file_manifest(spark, paths, pattern) if manifest is None else stored_manifest(spark, paths, manifest, pattern)
    known = {} if not listed else {r["path"]: r for r in facts_of.collect()}
    groups: dict[tuple, list[str]] = {}
    files, unusable = [], []
    for path, row in sorted(listed.items()):
        facts = {"path": path, "file_name": row["file_name"], "dataset_type": row["dataset_type"]}
        m = known.get(path)
        if reason := why_damaged(m):
            unusable.append(facts | {"reason": reason, "record_count": m["lines"] - 1 if m and m["lines"] else 0})
            continue
        chosen = encoding or ("UTF-8" if m["is_utf8"] else "ISO-8859-1")
        broken = m["unpaired_quotes"] if multi_line is None else multi_line
        files.append(facts | {"record_count": None if broken else m["lines"] - 1})
        groups.setdefault((chosen, broken, m["layout"]), []).append(path)
    frames = []
    for (enc, broken, _), found in sorted(groups.items(), key=lambda g: min(g[1])):
        header = header_of(spark, min(found), enc)
        if broken:
            long = overlong_files(spark, found, enc, header)
            unusable += [f | {"reason": TOO_MANY_CELLS} for f in files if f["path"] in long]
            files = [f for f in files if f["path"] not in long]
            found = [p for p in found if p not in long]
            if not found:
                continue
        frame = read_layout(spark, [exact(p) for p in sorted(found)], enc, broken, header)
        reason = why_unusable([c for c in frame.columns if c not in (SOURCE_FILE, ROW_POS)]) if check else None
        if reason is None:
            frames.append(frame)
        else:
            unusable += [f | {"reason": reason} for f in files if f["path"] in set(found)]
            files = [f for f in files if f["path"] not in set(found)]
    return Landing(frames, files, unusable)


def scan_bronze(
    spark: SparkSession, paths: str | Iterable[str], encoding: str | None = None, multi_line: bool | None = None,
) -> list[DataFrame]:
    """The frames of `scan_landing`, whatever their columns."""
    return scan_landing(spark, paths, encoding, multi_line, check=False).frames


def union_layouts(frames: list[DataFrame]) -> DataFrame:
    """All files as one table; a column that a file lacks is NULL there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
