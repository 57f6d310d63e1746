"""Column resolution (P1-P5). Works on header names only, which are metadata; no rows are touched."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from hexwatch.settings import (
    CATEGORY_FALLBACK_NAMES,
    CATEGORY_NAME,
    EXTENDED_HEADERS,
    LAT_NAMES,
    LON_NAMES,
    NEIGHBOURHOOD_PARTS,
    OPTIONAL_HEADERS,
    PREMISE_PARTS,
    REQUIRED_HEADERS,
)


def _first(columns: Iterable[str], accept) -> str | None:
    return next((c for c in columns if accept(c)), None)


def _last(columns: Sequence[str], accept) -> str | None:
    return _first(reversed(columns), accept)


def resolve_headers(columns: Sequence[str], extended: bool = False) -> dict[str, str]:
    """Logical name -> physical column of the raw-file check; the first match in file order wins."""
    out = {}
    for logical, names in {**REQUIRED_HEADERS, **OPTIONAL_HEADERS}.items():
        accepted = set(names) | set(EXTENDED_HEADERS.get(logical, []) if extended else [])
        found = _first(columns, lambda c: c.lower().strip() in accepted)
        if found is not None:
            out[logical] = found
    return out


def resolve_coordinates(columns: Sequence[str]) -> tuple[str, str]:
    """The last matching column wins."""
    lat = _last(columns, lambda c: c.upper() in LAT_NAMES)
    lon = _last(columns, lambda c: c.upper() in LON_NAMES)
    if lat is None or lon is None:
        raise ValueError(f"no coordinate columns in {list(columns)}")
    return lat, lon


def resolve_date_hour(columns: Sequence[str]) -> tuple[str, str | None]:
    """Names that contain OCC and DATE, or OCC and HOUR; the last match wins, the hour may be absent."""
    date = _last(columns, lambda c: "OCC" in c.upper() and "DATE" in c.upper())
    hour = _last(columns, lambda c: "OCC" in c.upper() and "HOUR" in c.upper())
    if date is None:
        raise ValueError(f"no occurrence date column in {list(columns)}")
    return date, hour


def resolve_category(columns: Sequence[str]) -> str:
    """P4."""
    found = _first(columns, lambda c: c.upper() == CATEGORY_NAME) or _first(
        columns, lambda c: c.upper() in CATEGORY_FALLBACK_NAMES
    )
    if found is None:
        raise ValueError(f"no category column in {list(columns)}")
    return found


def resolve_neighbourhood(columns: Sequence[str]) -> str | None:
    """P5: first column containing the word, else None."""
    return _first(columns, lambda c: any(p in c.upper() for p in NEIGHBOURHOOD_PARTS))


def resolve_premise(columns: Sequence[str]) -> str | None:
    """P5."""
    return _first(columns, lambda c: any(p in c.upper() for p in PREMISE_PARTS))
