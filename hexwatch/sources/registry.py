"""Dataset registry (S7), download addresses (S8, S10) and catalog responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexwatch.settings import CATALOG_BASE, DATASETS

REGISTRY_SCHEMA = "dataset_key string, name string, resource_id string, filename string, description string"
CATALOG_SCHEMA = (
    "success boolean, error string, "
    "result struct<resources: array<struct<id: string, format: string, url: string, download_url: string>>>"
)


def dataset_registry(spark: SparkSession, datasets: dict[str, tuple] = DATASETS) -> DataFrame:
    """One row per dataset. A handful of configured rows, never data."""
    rows = [(key, *entry) for key, entry in datasets.items()]
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)


def _given(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def resource_url(key: Column, resource_id: Column, filename: Column) -> Column:
    """S8."""
    return F.concat(
        F.lit(CATALOG_BASE + "/dataset/"), key, F.lit("/resource/"), resource_id, F.lit("/download/"), filename
    )


def parse_catalog(json_text: Column) -> Column:
    return F.from_json(json_text, CATALOG_SCHEMA)


def pick_resource(package: Column) -> Column:
    """Id (else address) of the first CSV resource, or of the first that has an address when none is CSV."""
    resources = F.filter(package["result"]["resources"], lambda r: r.isNotNull())
    first_csv = F.get(F.filter(resources, lambda r: F.upper(r["format"]) == "CSV"), F.lit(0))
    first_linked = F.get(
        F.filter(resources, lambda r: F.coalesce(_given(r["url"]), _given(r["download_url"])).isNotNull()), F.lit(0)
    )
    chosen = F.coalesce(first_csv, first_linked)
    value = F.coalesce(_given(chosen["id"]), _given(chosen["url"]), _given(chosen["download_url"]))
    return F.when(package["success"], value)


def download_source(
    key: Column, filename: Column, resource_id: Column, direct_url: Column, discovered: Column
) -> Column:
    """A direct address, else the address of the resource id, else what discovery returned (address or id)."""
    direct, known, found = _given(direct_url), _given(resource_id), _given(discovered)
    return (
        F.when(direct.isNotNull(), direct)
        .when(known.isNotNull(), resource_url(key, known, filename))
        .when(found.startswith("http"), found)
        .when(found.isNotNull(), resource_url(key, found, filename))
    )
