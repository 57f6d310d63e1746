"""File name -> dataset type."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from hexwatch.settings import DATASETS, LEGACY_DATASET, LEGACY_FILE_PREFIX


def dataset_type_of(file_name: Column, keys: Iterable[str] = tuple(DATASETS)) -> Column:
    """Shortest `_`-separated prefix of the name that is a registry key; the older file prefix is the fallback.

    A prefix made of n parts can equal only one key, so trying the keys by their number of parts finds the shortest.
    """
    name = F.replace(file_name, F.lit(".csv"), F.lit(""))
    out = None
    for key in sorted(keys, key=lambda k: (k.count("_"), k)):
        hit = name.startswith(key + "_")
        if "_" in key:
            hit = hit | (name == key)
        out = F.when(hit, key) if out is None else out.when(hit, key)
    legacy = name.startswith(LEGACY_FILE_PREFIX)
    return F.when(legacy, LEGACY_DATASET) if out is None else out.when(legacy, LEGACY_DATASET)
