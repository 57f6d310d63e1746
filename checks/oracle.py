"""DuckDB SQL for every query of `checks.queries` that SQL can express, written apart from the Spark code.

The hexagon id in particular takes another road: spherical azimuth and distance instead of dot products, the nearest
of four candidate cells instead of cube rounding, a recursive climb with digit offsets instead of remainders.
"""

from __future__ import annotations

from hexwatch.plans.testview import FILES
from hexwatch.settings import CATALOG_BASE, DATASETS

KEYS = ", ".join(f"'{k}'" for k in DATASETS)
TOKENS = (
    "'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', "
    "'<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'"
)
FILE_CASE = "case (event_id // 8) % {} {} end".format(
    len(FILES), " ".join(f"when {i} then '{name}'" for i, name in enumerate(FILES))
)
CTE: dict[str, str] = {}

CTE["raw"] = f"""
select event_id as pos, e.ts, e.user_id, e.event_type, e.value,
  case when event_id % 101 = 0 then null
       else 'E-' || (event_id - (case when event_id % 8 = 7 then 1 else 0 end)) end as id,
  case when event_id % 97 = 0 then 'not a date' when event_id % 103 = 0 then null
       when event_id % 5 = 1 then strftime(ts, '%Y/%m/%d') when event_id % 5 = 2 then strftime(ts, '%m/%d/%Y')
       else strftime(ts, '%Y-%m-%d') end as d,
  case when event_id % 89 = 0 then 'abc' when event_id % 83 = 0 then '27' when event_id % 79 = 0 then '-3'
       when event_id % 73 = 0 then null when event_id % 71 = 0 then '4.9'
       else cast(hour(ts) as varchar) end as h,
  case when event_id % 61 = 0 then '0.0' when event_id % 127 = 0 then 'x' when event_id % 131 = 0 then '5d'
       when event_id % 137 = 0 then null
       else '43.' || lpad(cast(580000 + (user_id % 8) * 34000 + (event_id % 7) * 310 as varchar), 6, '0') end as lat,
  case when event_id % 61 = 0 then '0.0' when event_id % 139 = 0 then 'nan'
       else '-79.' || lpad(cast(230000 + ((user_id % 40) // 8) * 90000 + (event_id % 11) * 290 as varchar), 6, '0')
       end as lon,
  case when event_id % 149 = 0 then null when event_id % 151 = 0 then 'theft under $5000x'
       when event_id % 157 = 0 then 'hit AND run o''neil'
       when event_type = 'signup' then case when event_id % 3 = 0 then ' assault ' else 'ASSAULT' end
       when event_type = 'purchase' then case event_id % 3 when 0 then 'b&e' when 1 then 'Break & Enter'
                                              else 'Break and Enter' end
       when event_type = 'view' then case when event_id % 2 = 0 then 'TheftOver' else 'theft over' end
       when event_type = 'click' then 'Auto Theft' else 'Robbery' end as cat,
  case when event_id % 53 = 0 then '  ' when event_id % 47 = 0 then 'nan' when event_id % 43 = 0 then null
       else n_nationkey || ' ' || n_name || ' (' || n_nationkey || ')' end as hood,
  case when event_id % 41 = 0 then 'nan' when event_id % 37 = 0 then '' when event_id % 4 = 0 then ' House '
       when event_id % 4 = 1 then 'Apartment' when event_id % 4 = 2 then 'Commercial' else 'Outside' end as premise,
  {FILE_CASE} as source_file
from events e left join nation on user_id % 25 = n_nationkey
"""

NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def number(c: str) -> str:
    return f"case when regexp_matches({c}, '{NUMBER}') then cast(trim({c}) as double) end"


TITLED = (
    "array_to_string(list_transform(regexp_extract_all(trim(cat), '[A-Za-z]+|[^A-Za-z]+'), "
    "lambda w: upper(w[1]) || lower(w[2:])), '')"
)
CATEGORY = f"""
case when cat is null or trim(cat) in ('', 'nan') then null
     when lower(trim(cat)) in ('break and enter', 'break & enter', 'b&e') then 'Break and Enter'
     when lower(trim(cat)) in ('theft over', 'theftover') then 'Theft Over'
     when lower(trim(cat)) = 'auto theft' then 'Auto Theft'
     when lower(trim(cat)) = 'assault' then 'Assault'
     when lower(trim(cat)) = 'robbery' then 'Robbery'
     else replace({TITLED}, ' And ', ' and ') end"""
HOOD = r"nullif(nullif(regexp_replace(regexp_replace(trim(hood), '^\d+\s*', ''), '\s*\(\d+\)$', ''), ''), 'nan')"
PREMISE = "nullif(nullif(trim(premise), ''), 'nan')"
DAY = r"""
case when regexp_full_match(d, '\d{4}-\d{2}-\d{2}') then cast(d as timestamp)
     when regexp_full_match(d, '\d{4}/\d{2}/\d{2}') then strptime(d, '%Y/%m/%d')
     when regexp_full_match(d, '\d{2}/\d{2}/\d{4}') then strptime(d, '%m/%d/%Y') end"""
HOUR = f"cast(trunc(least(23, greatest(0, coalesce({number('h')}, 0)))) as integer)"
DATASET = f"""
case when regexp_extract(replace(source_file, '.csv', ''), '^([^_]+)_', 1) in ({KEYS})
     then regexp_extract(replace(source_file, '.csv', ''), '^([^_]+)_', 1)
     when starts_with(source_file, 'toronto_crime_') then 'major-crime-indicators' end"""

CTE["cleaned"] = f"""
select pos, id, source_file, ({DAY}) + to_hours({HOUR}) as occurred_at, {number('lat')} as latitude,
  {number('lon')} as longitude, {CATEGORY} as crime_type, {HOOD} as neighbourhood, {PREMISE} as premise_type,
  {DATASET} as dataset_type
from raw
"""
CTE["deduped"] = """
select * from cleaned qualify row_number() over (partition by source_file, id order by pos) = 1
"""
IN_BOX = "latitude between 43.5 and 43.9 and longitude between -79.8 and -79.0"
COMPLETE = "occurred_at is not null and latitude is not null and longitude is not null and crime_type is not null"
CTE["silver"] = f"select * from deduped where {IN_BOX} and {COMPLETE}"


def hex_ctes(points: str, res: int = 9) -> dict[str, str]:
    """CTEs ending in `hexes(lat, lon, cell)` for the distinct points of a query yielding (lat, lon)."""
    rot = 0.333473172251832115 if res % 2 else 0.0
    fill = sum(7 << (3 * (15 - n)) for n in range(res + 1, 16))
    base = (1 << 59) | (res << 52) | (21 << 45) | fill
    return {
        "pts": f"select distinct lat, lon from ({points}) where lat is not null and lon is not null",
        "polar": """
            select lat, lon,
              acos(sin(1.054751253523952054) * sin(radians(lat)) + cos(1.054751253523952054) * cos(radians(lat))
                   * cos(radians(lon) + 1.347517358900396623)) as r,
              atan2(cos(radians(lat)) * sin(radians(lon) + 1.347517358900396623),
                    cos(1.054751253523952054) * sin(radians(lat)) - sin(1.054751253523952054) * cos(radians(lat))
                    * cos(radians(lon) + 1.347517358900396623)) as az
            from pts""",
        "plane": f"""
            select lat, lon, tan(r) / 0.38196601125010500003 * pow(sqrt(7.0), {res})
                     * cos(0.780213654393430055 - {rot} - az) as x,
                   tan(r) / 0.38196601125010500003 * pow(sqrt(7.0), {res})
                     * sin(0.780213654393430055 - {rot} - az) as y
            from polar where r < 1.5""",
        "candidates": """
            select lat, lon, x, y, floor(x + y / sqrt(3.0)) + da as a, floor(2 * y / sqrt(3.0)) + db as b
            from plane, (values (0, 0), (0, 1), (1, 0), (1, 1)) as o(da, db)""",
        "climb(lat, lon, q, a, b, h)": f"""
            select lat, lon, {res}, cast(arg_min(a, pow(a - b / 2 - x, 2) + pow(b * sqrt(3.0) / 2 - y, 2)) as bigint),
                   cast(arg_min(b, pow(a - b / 2 - x, 2) + pow(b * sqrt(3.0) / 2 - y, 2)) as bigint), cast(0 as bigint)
            from candidates group by lat, lon
            union all
            select lat, lon, q - 1, pa, pb, h + (case
                when (da, db) = (0, 0) then 0 when (da, db) = (-1, -1) then 1 when (da, db) = (0, 1) then 2
                when (da, db) = (-1, 0) then 3 when (da, db) = (1, 0) then 4 when (da, db) = (0, -1) then 5
                when (da, db) = (1, 1) then 6 end) * cast(pow(8, 15 - q) as bigint)
            from (select *, case when q % 2 = 1 then a - (2 * pa + pb) else a - (3 * pa - pb) end as da,
                            case when q % 2 = 1 then b - (3 * pb - pa) else b - (pa + 2 * pb) end as db
                  from (select *,
                          cast(round((case when q % 2 = 1 then 3 * a - b else 2 * a + b end) / 7.0) as bigint) as pa,
                          cast(round((case when q % 2 = 1 then a + 2 * b else 3 * b - a end) / 7.0) as bigint) as pb
                        from climb where q > 0))""",
        "hexes": f"select lat, lon, lower(to_hex({base} + h)) as cell from climb where q = 0 and a = -1 and b = -1",
    }


GOLD_CTES = {
    **{k: CTE[k] for k in ("raw", "cleaned", "deduped", "silver")},
    **hex_ctes("select latitude as lat, longitude as lon from silver"),
    "gold": """
        select s.*, cell as h3_index from silver s join hexes on latitude = lat and longitude = lon""",
}
COUNT_CTES = {
    **GOLD_CTES,
    "counts": """
        select h3_index, cast(floor(epoch(occurred_at) / 3600) as bigint) as hour_no, count(*) as crime_count
        from gold group by all""",
}


def sql(ctes: dict[str, str], select: str) -> str:
    """A select behind the `with` clause of the given CTEs."""
    body = ",\n".join(f"{k} as ({v})" for k, v in ctes.items())
    return f"with recursive {body}\n{select}"


def on_raw(select: str) -> str:
    return sql({"raw": CTE["raw"]}, select)


def on_cleaned(select: str) -> str:
    return sql({k: CTE[k] for k in ("raw", "cleaned")}, select)


def on_silver(select: str) -> str:
    return sql({k: CTE[k] for k in ("raw", "cleaned", "deduped", "silver")}, select)


def on_gold(select: str) -> str:
    return sql(GOLD_CTES, select)


def on_counts(select: str, **more: str) -> str:
    return sql({**COUNT_CTES, **more}, select)


SILVER_COLS = "occurred_at, latitude, longitude, crime_type, neighbourhood, premise_type, source_file, dataset_type"
GOLD_COLS = f"{SILVER_COLS}, h3_index, longitude as x, latitude as y, cast(4326 as integer) as srid"
GOLD_FLAT = "crime_type, occurred_at, latitude, longitude, neighbourhood, premise_type, h3_index, source_file, dataset_type"
SHOOTINGS = "shootings-firearm-discharges"
MCI = "major-crime-indicators"

LOOK = """
  cast(coalesce(sum(crime_count) over (w range between 1 preceding and 1 preceding), 0) as integer) as crimes_last_1h,
  cast(coalesce(sum(crime_count) over (w range between 24 preceding and 1 preceding), 0) as integer) as crimes_last_24h,
  cast(coalesce(sum(crime_count) over (w range between 168 preceding and 1 preceding), 0) as integer) as crimes_last_7d,
  cast(coalesce(sum(crime_count) over (w range between 168 preceding and 168 preceding), 0) as integer)
    as same_hour_last_week,
  round(coalesce(sum(crime_count) over (w range between 720 preceding and 1 preceding), 0) / 720.0, 4)
    as rolling_avg_30d"""
CALENDAR = """
  cast(hour(time_window) as integer) as hour_of_day, cast(isodow(time_window) - 1 as integer) as day_of_week,
  isodow(time_window) >= 6 as is_weekend, hour(time_window) >= 22 or hour(time_window) < 6 as is_night,
  cast(month(time_window) as integer) as month,
  cast(case when month(time_window) in (3, 4, 5) then 1 when month(time_window) in (6, 7, 8) then 2
            when month(time_window) in (9, 10, 11) then 3 else 4 end as integer) as season"""
HOLIDAY = "cast(time_window as date) in (select cast(ts as date) from events where day(ts) % 10 = 1)"
DENSE_CELL = """
  select h3_index, hour_no, coalesce(crime_count, 0) as crime_count
  from (select h3_index, unnest(range(min(hour_no), max(hour_no) + 1)) as hour_no from counts group by h3_index)
  left join counts using (h3_index, hour_no)"""
DENSE_TABLE = """
  select h3_index, hour_no, coalesce(crime_count, 0) as crime_count
  from (select h3_index, unnest(range((select min(hour_no) from counts), (select max(hour_no) from counts) + 1)) as hour_no
        from (select distinct h3_index from counts))
  left join counts using (h3_index, hour_no)"""


def features(table: str) -> str:
    return f"""
select h3_index, time_window, {CALENDAR}, {HOLIDAY} as is_holiday, crimes_last_1h, crimes_last_24h, crimes_last_7d,
  same_hour_last_week, rolling_avg_30d, cast(crime_count as integer) as target_crime_count,
  cast(crime_count > 0 as integer) as target_binary
from (select *, make_timestamp(hour_no * 3600000000) as time_window, {LOOK} from {table}
      window w as (partition by h3_index order by hour_no))"""


def parent(res: int) -> str:
    """The digits up to a resolution stay, the finer ones become 7, and the resolution is put in: all in binary text."""
    bits = "lpad(bin(cast('0x' || h3_index as bigint)), 64, '0')"
    kept = 64 - 3 * (15 - res)
    text = f"substr({bits}, 1, 8) || '{res:04b}' || substr({bits}, 13, {kept - 12}) || '{'1' * (64 - kept)}'"
    return f"lower(ltrim(hex(list_reduce(list_transform(string_split(substr({text}, 2), ''), lambda d: cast(d as bigint)), lambda a, b: 2 * a + b)), '0'))"


INPUT_EDGES = {
    "hour_of_day": (6, 12, 18), "day_of_week": (2, 4), "is_weekend": (1,), "is_night": (1,), "is_holiday": (1,), "month": (2, 3), "season": (2, 3),
    "crimes_last_1h": (1, 2), "crimes_last_24h": (1, 3), "case when hour(time_window) <> 5 then crimes_last_7d end": (2, 8),
    "same_hour_last_week": (1,), "rolling_avg_30d": (0.01, 0.05),
}


def level_histogram(feature_rows: str) -> str:
    cells = []
    for i, (x, edges) in enumerate(INPUT_EDGES.items()):
        above = " + ".join(f"cast(cast({x} as double) >= {e} as integer)" for e in edges)
        cells.append(f"{{'feature': {i}, 'bin': coalesce(1 + {above}, 0)}}")
    return f"""
select node, cell.feature as feature, cell.bin as bin, cast(sum(524288 - 1048576 * y) as bigint) as g, cast(sum(262144) as bigint) as h, count(*) as n
from (select cast(case when hour_of_day < 12 then 1 else 2 end as bigint) as node, target_binary as y, unnest([{", ".join(cells)}]) as cell
      from ({feature_rows})) group by all"""


def best_splits(cells: str) -> str:
    """Every split of every node with missing values on either side, and the best of them."""
    def quality(g: str, h: str) -> str:
        return f"(({g}) / 1048576.0) * (({g}) / 1048576.0) / (({h}) / 1048576.0 + 1.0)"

    return f"""
select node, feature, bin, missing_left, round(gain, 6) as gain, left_g, left_h, right_g, right_h from (
  select *, ({quality("left_g", "left_h")} + {quality("right_g", "right_h")} - {quality("left_g + right_g", "left_h + right_h")}) / 2 as gain
  from (
    select c.node, c.feature, c.bin, missing_left,
      cast(sum(o.g) filter (goes_left) as bigint) as left_g, cast(sum(o.h) filter (goes_left) as bigint) as left_h,
      cast(sum(o.g) filter (not goes_left) as bigint) as right_g, cast(sum(o.h) filter (not goes_left) as bigint) as right_h
    from (select distinct node, feature, bin, missing_left from ({cells}), (select unnest([true, false]) as missing_left) where bin > 0) c
    join (select * from ({cells})) o on o.node = c.node and o.feature = c.feature,
    lateral (select case when o.bin = 0 then missing_left else o.bin <= c.bin end as goes_left)
    group by all
  ) where left_h >= 1048576 and right_h >= 1048576
) where gain > 1e-9
qualify row_number() over (partition by node order by gain desc, feature, bin, missing_left desc) = 1"""


# Ledger events, model writes and files, derived from the events table.
LEDGER_EVENTS = f"""
select 'file_' || user_id || '.csv' as file_name, event_id as seq, ts as event_at,
  case event_type when 'signup' then 'start' when 'view' then 'fail' when 'click' then 'gold_complete'
       else 'complete' end as kind,
  cast(floor(value) as bigint) as record_count, case when event_id % 3 <> 0 then ts end as last_timestamp,
  repeat(props, 120) as error_message,
  case event_id % 4 when 0 then '{MCI}' when 1 then '{SHOOTINGS}' end as dataset_type
from events"""
LEDGER = """
select file_name, ingested_at, record_count, last_timestamp, status, error_message,
       dataset_type
from (
  select file_name,
    arg_max(event_at, seq) filter (kind = 'start') as ingested_at,
    arg_max(record_count, seq) filter (kind <> 'fail') as record_count,
    arg_max({'v': last_timestamp}, seq) filter (kind like '%complete')['v'] as last_timestamp,
    arg_max(case when kind = 'start' then 'in_progress' when kind = 'fail' then 'failed' else 'completed' end, seq)
      as status,
    arg_max({'v': case when kind = 'fail' then left(error_message, 1000) end}, seq) filter (kind <> 'start')['v']
      as error_message,
    arg_max(dataset_type, seq) filter (kind in ('start', 'complete') and dataset_type is not null) as dataset_type
  from (select *, min(seq) filter (kind = 'start') over (partition by file_name) as first_seq from ledger_events)
  where seq >= first_seq group by file_name)"""
LEDGER_CTES = {"ledger_events": LEDGER_EVENTS, "ledger": LEDGER}
FILES_CTE = f"""
select user_id, 'dir/' || source_file || '/' || user_id as path, source_file as file_name, cast(count(*) as bigint) as bytes,
       max(ts) as modified_at, {DATASET} as dataset_type
from (select *, {FILE_CASE} as source_file from events) group by user_id, source_file"""
MODEL_WRITES = """
select 'model_' || user_id as model_id, cast(event_id as varchar) as version, 'logistic_regression' as model_type,
  ts as trained_at, event_type = 'click' as is_active, event_id as write_seq, round(value, 2) as roc_auc
from events"""
MODELS = "select * from model_writes qualify row_number() over (partition by model_id order by write_seq desc) = 1"
ACTIVE = """
select * replace (is_active and write_seq = (select max(write_seq) from models where is_active) as is_active)
from models"""
MODEL_CTES = {"model_writes": MODEL_WRITES, "models": MODELS, "active": ACTIVE}
SCORED = """
select event_id, value / (value + 50) as risk, cast(event_type in ('click', 'view') as integer) as target_binary
from events"""
CURVE = """
select risk, sum(target_binary) as pos, sum(1 - target_binary) as neg from scored group by risk"""
RUNNING = """
select *, sum(pos) over (order by risk desc) as tp, sum(neg) over (order by risk desc) as fp from curve"""
METRICS = """
select round(sum(neg * (tp - pos / 2.0)) / (sum(pos) * 1.0 * sum(neg)), 6) as roc_auc,
  round(sum(pos * (case when tp - pos + fp - neg > 0 then (tp - pos) / (tp - pos + fp - neg + 0.0)
                        else tp / (tp + fp + 0.0) end + tp / (tp + fp + 0.0)) / 2) / sum(pos), 6) as pr_auc
from running"""
FUNNEL = f"""
select * from (
  select cast(step as integer) as step, stage, cast(n as bigint) as row_count,
    cast(coalesce(lag(n) over (order by step) - n, 0) as bigint) as removed,
    round(coalesce((lag(n) over (order by step) - n) * 100.0 / lag(n) over (order by step), 0), 6) as removed_pct
  from (select 0 as step, 'initial' as stage, count(*) as n from cleaned
        union all select 1, 'deduplicated', count(*) from deduped
        union all select 2, 'in_region', count(*) from deduped where {IN_BOX}
        union all select 3, 'complete', count(*) from silver))"""
FOUND = [
    ("has occurrence_date", "error", True), ("has lat", "error", True), ("has long", "error", True),
    ("has major_crime_indicator", "error", True), ("has neighbourhood", "warning", True),
    ("has premise_type", "warning", True), ("has occurrence_time", "warning", True),
]


def values_of(rows) -> str:
    return ", ".join(
        "(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v).lower() for v in row) + ")" for row in rows
    )


def structure(found: list[tuple]) -> str:
    return f"""select source_file, "check", level, passed, cast(passed as double) as value
from (select distinct source_file from raw), (values {values_of(found)}) as c("check", level, passed)"""


NOT_EXTENDED = [
    (name, level, name in ("has major_crime_indicator", "has premise_type")) for name, level, _ in FOUND
]
NULLED = {c: f"case when {c} not in ({TOKENS}) then {c} end" for c in ("d", "h", "lat", "lon", "cat", "hood", "premise")}
RAW_CHECKS = f"""
{structure(FOUND)}
union all select source_file, 'lat in range', 'error', bad = 0, cast(bad as double) from (
  select source_file, count(*) filter (({number('lat')}) is null or ({number('lat')}) not between 43.0 and 44.0) as bad
  from raw group by source_file)
union all select source_file, 'long in range', 'error', bad = 0, cast(bad as double) from (
  select source_file, count(*) filter (({number('lon')}) is null or ({number('lon')}) not between -80.0 and -79.0) as bad
  from raw group by source_file)
union all select source_file, name || ' mostly present', 'warning', pct <= 10, round(pct, 6) from (
  select source_file, unnest(['occurrence_date', 'lat', 'long', 'major_crime_indicator']) as name,
    unnest([count(*) filter (d is null) * 100.0 / count(*), count(*) filter (lat is null) * 100.0 / count(*),
            count(*) filter (lon is null) * 100.0 / count(*), count(*) filter (cat is null) * 100.0 / count(*)]) as pct
  from raw group by source_file)"""


def check_rows(source: str, checks: list[tuple[str, str, str]]) -> str:
    """(name, passed, value) expressions over one aggregate row."""
    return " union all ".join(
        f"select '{name}' as \"check\", 'error' as level, coalesce({ok}, false) as passed, cast({value} as double) as value "
        f"from ({source})" for name, ok, value in checks
    )


BAD = {
    "no nulls in occurred_at": "occurred_at is null",
    "no nulls in latitude": "latitude is null",
    "no nulls in longitude": "longitude is null",
    "no nulls in crime_type": "crime_type is null",
    "latitude in region": "not coalesce(latitude between 43.5 and 43.9, false)",
    "longitude in region": "not coalesce(longitude between -79.8 and -79.0, false)",
    "crime types in domain":
        "not coalesce(crime_type in ('Assault', 'Robbery', 'Break and Enter', 'Auto Theft', 'Theft Over'), false)",
}
SILVER_CHECKS = " union all ".join(
    f"select '{n}' as \"check\", 'error' as level, count(*) filter ({b}) = 0 as passed, "
    f"cast(count(*) filter ({b}) as double) as value from deduped" for n, b in BAD.items()
)
PACKAGES = """
select l_orderkey as package, l_linenumber % 5 <> 0 as success, [
  {'id': 'doc-' || l_partkey, 'format': 'PDF', 'url': cast(null as varchar), 'download_url': ''},
  {'id': case when l_linenumber % 2 = 1 then 'res-' || l_orderkey else '' end,
   'format': case when l_returnflag = 'A' then 'csv' else 'XLSX' end,
   'url': case when l_quantity > 25 then 'http://data/' || l_partkey end, 'download_url': null},
  {'id': null, 'format': case when l_linestatus = 'O' then 'CSV' else 'json' end, 'url': null,
   'download_url': case when l_quantity <= 10 then 'http://dl/' || l_suppkey else '' end}] as rs
from lineitem"""
PICKED = """
select package, case when success then
    coalesce(nullif(c['id'], ''), nullif(c['url'], ''), nullif(c['download_url'], '')) end as resource
from (select package, success,
        coalesce(list_filter(rs, lambda r: upper(r['format']) = 'CSV')[1],
                 list_filter(rs, lambda r: coalesce(nullif(r['url'], ''), nullif(r['download_url'], '')) is not null)[1])
          as c from packages)"""


def oracles() -> dict[str, str]:
    o: dict[str, str] = {}
    # sources
    o["s1_scan_bronze"] = on_raw(
        f"""select pos, id as EVENT_UNIQUE_ID, {NULLED['d']} as OCC_DATE, {NULLED['h']} as OCC_HOUR,
        {NULLED['lat']} as LAT_WGS84, {NULLED['lon']} as LONG_WGS84, {NULLED['cat']} as MCI_CATEGORY,
        case when pos % 11 = 0 then replace(replace({NULLED['hood']}, 'O', 'Ö'), ' ', chr(10))
             when pos % 13 = 0 then replace(replace({NULLED['hood']}, 'O', 'Ö'), '(', '"')
             else replace({NULLED['hood']}, 'O', 'Ö') end as NEIGHBOURHOOD_158, {NULLED['premise']} as PREMISES_TYPE from raw""")
    o["s3_latest_file"] = sql({"files": FILES_CTE}, """
        select dataset_type, path, file_name, bytes, modified_at from files
        qualify row_number() over (partition by dataset_type order by modified_at desc, path desc) = 1""")
    o["s4_s5_silver_parquet"] = on_silver(f"select {SILVER_COLS} from silver")
    o["s4_s5_silver_csv"] = on_silver(f"select {SILVER_COLS} from silver")
    o["s6_write_gold"] = on_gold(f"select {GOLD_COLS} from gold")
    o["s6_quarantine"] = on_cleaned("""
        select coalesce(case when crime_type is null then 'missing crime_type'
                    when occurred_at is null then 'missing occurred_at'
                    when latitude is null then 'missing latitude' when longitude is null then 'missing longitude'
                    when not (""" + IN_BOX + """) then 'missing h3_index' end, 'loadable') as outcome,
          count(*) as row_count from cleaned group by all""")
    registry = "(values " + ", ".join(
        f"('{k}', '{v[0]}', {repr(v[1]) if v[1] else 'null'}, '{v[2]}', '{v[3]}')" for k, v in DATASETS.items()
    ) + ") as r(dataset_key, name, resource_id, filename, description)"
    o["s7_dataset_registry"] = on_cleaned(f"""
        select dataset_key, name, resource_id, filename, description, count(pos) as row_count
        from {registry} left join cleaned on dataset_type = dataset_key group by all""")
    o["s8_resource_url"] = on_cleaned(f"""
        select source_file, count(*) as row_count, '{CATALOG_BASE}/dataset/' || dataset_key || '/resource/' ||
          coalesce(resource_id, 'res-' || source_file) || '/download/' || filename as url
        from cleaned left join {registry} on dataset_type = dataset_key group by all""")
    o["s9_pick_resource"] = sql({"packages": PACKAGES, "picked": PICKED}, "select package, resource from picked")
    o["s10_download_source"] = sql({"packages": PACKAGES, "picked": PICKED}, f"""
        select package, case when package % 7 = 0 then 'http://direct/' || package
          when package % 5 = 0 then '{CATALOG_BASE}/dataset/k' || package || '/resource/known/download/f.csv'
          when resource like 'http%' then resource
          else '{CATALOG_BASE}/dataset/k' || package || '/resource/' || resource || '/download/f.csv' end as url
        from picked""")
    # column resolution and projections
    o["p1_resolve_headers"] = on_raw("""
        select source_file, count(d) as occurrence_date, count(lat) as lat, count(lon) as long,
          count(cat) as major_crime_indicator, count(hood) as neighbourhood, count(premise) as premise_type,
          count(h) as occurrence_time from raw group by source_file""")
    o["p2_coordinates"] = on_raw("select pos, lat as raw_lat, lon as raw_lon from raw")
    o["p3_date_hour"] = on_raw("select pos, d as raw_date, h as raw_hour from raw")
    o["p4_category"] = on_raw("select pos, cat as raw_category from raw")
    o["p5_neighbourhood_premise"] = on_raw(
        "select pos, hood as raw_neighbourhood, cast(null as varchar) as raw_premise from raw")
    o["p6_filter_coordinates"] = on_cleaned(f"select pos, latitude, longitude from cleaned where {IN_BOX}")
    o["p7_recheck_region"] = on_gold(f"select {GOLD_FLAT} from gold")
    o["p8_skip_validation"] = on_silver(f"select {SILVER_COLS} from deduped where {COMPLETE}")
    o["p9_drop_missing_critical"] = on_cleaned(f"select pos, {SILVER_COLS} from cleaned where {COMPLETE}")
    o["p10_drop_null_cell"] = on_cleaned("select pos from cleaned where latitude > 1 and longitude < -1")
    o["p11_silver_schema"] = on_cleaned(f"select {SILVER_COLS} from cleaned")
    o["p12_gold_schema"] = on_gold(f"select {GOLD_COLS} from gold")
    o["p13_truncate"] = """select doc_id, left(text, 100) as crime_type, left(text, 100) as neighbourhood,
        left(text, 100) as premise_type, left(text, 20) as h3_index, left(text, 255) as source_file,
        left(text, 100) as dataset_type from documents"""
    o["p14_domain_flag"] = on_silver("""
        select crime_type, crime_type in ('Assault', 'Robbery', 'Break and Enter', 'Auto Theft', 'Theft Over')
          as in_domain, count(*) as row_count from silver group by all""")
    o["p15_equality_filters"] = on_gold(f"""
        select {GOLD_FLAT} from gold where dataset_type = '{MCI}' and source_file = '{FILES[9]}'""")
    o["p16_bounding_box"] = on_gold(f"""
        select {GOLD_FLAT} from gold where latitude between 43.6 and 43.7 and longitude between -79.5 and -79.3""")
    # joins
    o["j1_registry_join"] = on_cleaned(f"""
        select source_file, dataset_type, name, name is not null as is_known, count(*) as row_count
        from cleaned left join {registry} on dataset_type = dataset_key group by all""")
    o["j2_unseen_files"] = sql({"files": FILES_CTE, **LEDGER_CTES}, """
        select path from (select *, 'file_' || (user_id * 2) || '.csv' as fname from files)
        where fname not in (select file_name from ledger)""")
    o["j2_unseen_or_failed"] = sql({"files": FILES_CTE, **LEDGER_CTES}, """
        select path from (select *, 'file_' || (user_id * 2) || '.csv' as fname from files)
        where fname not in (select file_name from ledger where status = 'completed')""")
    o["j3_drop_loaded"] = on_gold("select " + GOLD_FLAT + " from gold where source_file not like 'police%'")
    o["j4_backfill_dataset_type"] = on_gold("""
        select source_file, coalesce(dataset_type, case when source_file like 'other%' then 'filled' end)
          as dataset_type, count(*) as row_count from gold group by all""")
    o["j5_densify_cell"] = on_counts("select h3_index, hour_no, crime_count from (" + DENSE_CELL + ")")
    o["j5_densify_table"] = on_counts("select h3_index, hour_no, crime_count from (" + DENSE_TABLE + ")")
    o["j6_score_requests"] = on_counts(f"""
        select pos, c.h3_index, c.time_window, round(s.crimes_last_24h / (1.0 + s.crimes_last_24h), 6) as risk
        from (select pos, h3_index, date_trunc('hour', occurred_at + interval 1 hour) as time_window from gold) c
        left join (select h3_index, make_timestamp(hour_no * 3600000000) as time_window, {LOOK} from counts
                   window w as (partition by h3_index order by hour_no)) s using (h3_index, time_window)""")
    # aggregates
    o["a1_counts_by_cell_hour"] = on_gold("""
        select h3_index, date_trunc('hour', occurred_at) as time_window, count(*) as crime_count,
          count(distinct crime_type) as distinct_crime_types from gold group by all""")
    o["a2_total"] = on_gold("select count(*) as total from gold")
    o["a3_non_null_counts"] = on_gold(
        "select count(*) as total, count(h3_index) as with_cell, count(latitude) as with_point from gold")
    o["a4_distinct_cells"] = on_gold("select count(distinct h3_index) as distinct_cells from gold")
    o["a4_distinct_over_loads"] = on_gold("""
        select dataset_type, count(*) as crime_count, count(distinct h3_index) as exact_cells,
          count(distinct (h3_index, date_trunc('hour', occurred_at))) as exact_hours,
          true as distinct_cells_near, true as distinct_cell_hours_near from gold group by all""")
    o["a4_shared_cells"] = on_gold(f"""
        select count(*) filter (sides = 2) as exact_shared, count(*) as exact_all, true as shared_near, true as all_near
        from (select h3_index, count(distinct dataset_type) as sides from gold
          where dataset_type in ('{MCI}', '{SHOOTINGS}') group by all)""")
    o["a5_date_range"] = on_gold("select min(occurred_at) as first_at, max(occurred_at) as last_at from gold")
    o["a6_type_distribution"] = on_gold("select crime_type, count(*) as crime_count from gold group by all")
    o["a7_rows_per_file"] = on_gold("select source_file, count(*) as crime_count from gold group by all")
    o["a8_rows_per_dataset"] = on_gold("select dataset_type, count(*) as crime_count from gold group by all")
    o["a9_daily_counts"] = on_gold(f"""
        select dataset_type, cast(date_trunc('day', occurred_at) as timestamp) as day, count(*) as crime_count from gold
        where dataset_type = '{SHOOTINGS}' group by all""")
    cols = SILVER_COLS.split(", ")
    o["a10_null_counts"] = on_cleaned(" union all ".join(
        f"select '{c}' as column_name, count(*) - count({c}) as null_count from cleaned" for c in cols))
    o["a11_missing_percentages"] = on_raw(" union all ".join(
        f"select source_file, '{n}' as column_name, round((count(*) - count({c})) * 100.0 / count(*), 6) as missing_pct "
        f"from raw group by source_file"
        for n, c in (("OCC_DATE", "d"), ("LAT_WGS84", "lat"), ("LONG_WGS84", "lon"), ("MCI_CATEGORY", "cat"))))
    o["a12_coordinate_ranges"] = on_silver("""
        select min(latitude) as lat_min, max(latitude) as lat_max, min(longitude) as lon_min, max(longitude) as lon_max
        from silver""")
    o["a13_sorted_values"] = on_silver("select distinct crime_type from silver where crime_type is not null")
    o["a14_file_load_stats"] = on_gold("""
        select source_file, count(*) as record_count, max(occurred_at) as last_timestamp from gold group by all""")
    o["a15_stage_funnel"] = on_silver(FUNNEL)
    mapping = ("lat=LAT_WGS84, long=LONG_WGS84, major_crime_indicator=MCI_CATEGORY, neighbourhood=NEIGHBOURHOOD_158, "
               "occurrence_date=OCC_DATE, occurrence_time=OCC_HOUR, premise_type=PREMISES_TYPE")
    o["a16_file_profile"] = on_raw(f"""
        select source_file, n as row_count, cast(8 as integer) as column_count, '{mapping}' as column_mapping,
          cast(errors as bigint) as errors, cast(warnings as bigint) as warnings, errors = 0 as is_valid
        from (select source_file, count(*) filter (not passed and level = 'error') as errors,
                count(*) filter (not passed and level = 'warning') as warnings from ({RAW_CHECKS}) group by source_file)
        join (select source_file, count(*) as n from raw group by source_file) using (source_file)""")
    o["a17_max_lengths"] = """
        select column_name, cast(len as integer) as max_length, len > width as is_truncated
        from (select max(length(text)) as len from documents),
          (values ('crime_type', 100), ('source_file', 255)) as w(column_name, width)"""
    # windows
    o["w1_dedup_first"] = on_silver("select pos, id, source_file, crime_type, occurred_at from deduped")
    o["w1_dedup_across_files"] = on_cleaned("""
        select pos, id, source_file from cleaned
        qualify row_number() over (partition by id order by source_file, pos) = 1""")
    o["w1_dedup_across_loads"] = on_cleaned("""
        select pos, id, source_file, length(source_file) % 3 as load from cleaned
        qualify row_number() over (partition by id order by length(source_file) % 3, source_file, pos) = 1""")
    for name, col in (
        ("w2_last_1h", "crimes_last_1h"), ("w3_last_24h", "crimes_last_24h"), ("w4_last_7d", "crimes_last_7d"),
        ("w5_same_hour_last_week", "same_hour_last_week"), ("w6_rolling_avg_30d", "rolling_avg_30d"),
    ):
        o[name] = on_counts(f"""select h3_index, hour_no, {col} from (select h3_index, hour_no, {LOOK} from counts
            window w as (partition by h3_index order by hour_no))""")
    o["w7_single_active_model"] = sql(MODEL_CTES, "select model_id, version, trained_at, is_active from active")
    o["w8_ledger_latest_state"] = sql(LEDGER_CTES, "select file_name, status, ingested_at from ledger")
    # top-k
    o["t1_latest_model"] = sql(MODEL_CTES, """
        select model_id, version, trained_at, roc_auc from active where is_active order by trained_at desc, model_id desc limit 1""")
    o["t2_last_ledger_rows"] = sql(LEDGER_CTES, "select * from ledger order by ingested_at desc, file_name limit 5")
    o["t3_first_rows"] = on_cleaned(f"select pos, {SILVER_COLS} from cleaned order by pos limit 5000")
    o["t4_ordered_distribution"] = on_gold("select neighbourhood, count(*) as crime_count from gold group by all")
    # set operations
    o["u1_distinct_rows"] = on_raw("select distinct d, lat, cat, source_file from raw")
    o["u2_union_layouts"] = on_raw("""
        select pos, case when pos % 2 = 0 then lat end as LAT_WGS84, case when pos % 2 = 1 then lat end as LATITUDE,
          cat as MCI_CATEGORY from raw""")
    o["u3_upsert_model"] = sql(MODEL_CTES, "select model_id, version, trained_at, write_seq from models")
    # scalar functions
    o["f1_crime_type"] = on_cleaned("select pos, crime_type from cleaned")
    o["f2_neighbourhood"] = on_cleaned("select pos, neighbourhood from cleaned")
    o["f3_premise_type"] = on_cleaned("select pos, premise_type from cleaned")
    o["f4_dataset_type"] = on_cleaned("select source_file, dataset_type, count(*) as row_count from cleaned group by all")
    o["f5_to_number"] = on_cleaned(f"""
        select c.pos, latitude, longitude, {number('h')} as hour_number from cleaned c join raw using (pos)""")
    o["f6_occurred_at"] = on_cleaned("select pos, occurred_at from cleaned")
    o["f7_to_utc"] = "select event_id, ts as as_labelled, ts + interval 5 hour as from_eastern from events"
    o["f8_nan_to_null"] = on_raw("select pos, nullif(hood, 'nan') as neighbourhood, nullif(premise, 'nan') as premise_type from raw")
    o["f9_decimals"] = on_cleaned("""
        select pos, round(latitude / 3, 8) as lat, round(longitude / 3, 8) as lon from cleaned""")
    o["f10_truncation"] = """
        select event_id, date_trunc('hour', ts) as hour_start, cast(date_trunc('day', ts) as timestamp) as day_start from events"""
    cal = "(select event_id, ts as time_window from events)"
    for name, col in (
        ("f11_hour_of_day", "hour_of_day"), ("f12_day_of_week", "day_of_week"), ("f13_is_weekend", "is_weekend"),
        ("f14_is_night", "is_night"), ("f16_month", "month"),
    ):
        o[name] = f"select event_id, {col} from (select event_id, {CALENDAR} from {cal})"
    o["f15_is_holiday"] = f"select event_id, {HOLIDAY} as is_holiday from {cal}"
    o["f17_season"] = """
        select o_orderkey, cast(case when month(o_orderdate) in (3, 4, 5) then 1 when month(o_orderdate) in (6, 7, 8)
          then 2 when month(o_orderdate) in (9, 10, 11) then 3 else 4 end as integer) as season from orders"""
    o["f18_metrics_json"] = """
        select event_id, cast(json_extract(props, '$.k') as double) as k,
          '{"roc_auc":' || printf('%.1f', cast(json_extract(props, '$.k') as double)) || ',"recall":1.0}' as written
        from events"""
    hexes = {**{k: CTE[k] for k in ("raw", "cleaned")}, **hex_ctes("select latitude as lat, longitude as lon from cleaned")}
    o["h1_hexagon_cell"] = sql(hexes, """
        select pos, cell as h3_index from cleaned left join hexes on latitude = lat and longitude = lon""")
    grid = "select round(43.5 + (event_id % 401) / 1000.0, 6) as lat, round(-79.8 + (event_id % 797) / 1000.0, 6) as lon from events"
    o["h1_region_sweep"] = sql(hex_ctes(grid), "select lat, lon, cell as h3_index from pts left join hexes using (lat, lon)")
    o["h1_region_sweep_res8"] = sql(hex_ctes(grid, 8), "select lat, lon, cell as h3_index from pts left join hexes using (lat, lon)")
    o["h2_make_point"] = on_cleaned("""
        select pos, longitude as x, latitude as y, cast(4326 as integer) as srid from cleaned
        where latitude is not null and longitude is not null""")
    # ledger
    o["l1_start"] = sql(LEDGER_CTES, """
        select file_name, max(event_at) as ingested_at, arg_max(record_count, seq) as record_count,
          'in_progress' as status, arg_max(dataset_type, seq) filter (dataset_type is not null) as dataset_type
        from ledger_events where kind = 'start' group by file_name""")
    o["l2_l3_l4_fold"] = sql(LEDGER_CTES, "select * from ledger")
    o["l2_fold_snapshots"] = o["l2_l3_l4_fold"]
    o["l4_gold_completion"] = on_gold("""
        select source_file as file_name, count(*) as record_count, 'completed' as status,
          max(occurred_at) as last_timestamp from gold group by source_file""")
    o["l5_bronze_step"] = on_cleaned("""
        select source_file as file_name, count(*) as record_count, 'completed' as status, dataset_type
        from cleaned group by all""")
    # quality
    o["v1_structure"] = on_raw(structure(NOT_EXTENDED))
    o["v2_v3_validate_raw"] = on_raw(RAW_CHECKS)
    o["v4_verify_silver"] = on_silver(SILVER_CHECKS)
    o["v5_verify_gold"] = on_gold(check_rows(
        "select count(*) as n, count(h3_index) as c, count(latitude) as p, count(distinct h3_index) as dc from gold",
        [("records exist", "n > 0", "n"), ("all records have a cell", "n > 0 and c = n", "c"),
         ("all records have a point", "n > 0 and p = n", "p"), ("several cells", "n > 0 and dc > 1", "dc")]))
    o["v6_verify_load"] = on_gold("""
        select source_file, s.n as expected_count, coalesce(g.n, 0) as actual_count, coalesce(g.n, 0) as cell_count,
          coalesce(g.n, 0) as point_count, s.n = coalesce(g.n, 0) as passed
        from (select source_file, count(*) as n from deduped group by all) s
        left join (select source_file, count(*) as n from gold group by all) g using (source_file)""")
    o["v7_load_summary"] = on_cleaned(f"""
        select source_file, count(*) filter ({COMPLETE} and {IN_BOX}) as successful,
          count(*) filter (not coalesce({COMPLETE} and {IN_BOX}, false)) as failed,
          round(count(*) filter ({COMPLETE} and {IN_BOX}) * 100.0 / count(*), 6) as success_pct
        from cleaned group by source_file""")
    o["v8_verify_tables"] = """
        select 'crimes' as table_name, true as present, count(*) as row_count from events
        union all select 'ingestion_metadata', true, count(*) from orders
        union all select 'features', false, null union all select 'model_metadata', true, count(*) from part"""
    # features and model
    o["m1_features_dense"] = on_counts(features("dense"), dense=DENSE_CELL)
    o["m1_features_refreshed"] = o["m1_features_dense"]
    o["m1_features_sparse"] = on_counts(features("counts"))
    o["m2_targets"] = on_counts("""
        select h3_index, hour_no, cast(crime_count as integer) as target_crime_count,
          cast(crime_count > 0 as integer) as target_binary from (""" + DENSE_CELL + ")")
    metric = {"scored": SCORED, "curve": CURVE, "running": RUNNING}
    o["m4_curve_areas"] = sql(metric, METRICS)
    o["m4_threshold_metrics"] = sql({"scored": SCORED}, """
        select round(avg(pow(risk - target_binary, 2)), 6) as brier_score, round(tp / (tp + fp + 0.0), 6) as precision,
          round(tp / (tp + fn + 0.0), 6) as recall, round(2.0 * tp / (2 * tp + fp + fn), 6) as f1_score
        from scored, (select count(*) filter (risk >= 0.5 and target_binary = 1) as tp,
                        count(*) filter (risk >= 0.5 and target_binary = 0) as fp,
                        count(*) filter (risk < 0.5 and target_binary = 1) as fn from scored)
        group by tp, fp, fn""")
    o["m5_register_model"] = sql(MODEL_CTES, "select model_id, version, is_active, write_seq, roc_auc from active")
    o["p16_box_by_cell"] = o["p16_bounding_box"]
    o["h1_parent_cells"] = on_gold(f"select h3_index, count(*) as n, {', '.join(f'{parent(r)} as parent_{r}' for r in (8, 7, 4))} from gold group by all")
    o["m7_heatmap_rollup"] = on_gold(f"""
        select {parent(7)} as h3_index, count(*) as crime_count from gold where latitude between 43.6 and 43.75
          and longitude between -79.5 and -79.3 and occurred_at >= timestamp '2024-01-05'
          and occurred_at < timestamp '2024-01-20' group by all""")
    axial = """axial as (
          select h3_index, any_value(a) as a, any_value(b) as b, count(*) as n from gold join (select lat, lon, a, b from climb where q = 9)
            on latitude = lat and longitude = lon where {} group by h3_index),
        near as (select x.h3_index, y.h3_index as ring_cell, x.n, y.n as ring_n from axial x
          cross join (values (0, 0), (1, 0), (0, 1), (1, 1), (-1, 0), (0, -1), (-1, -1)) as o(da, db)
          join axial y on y.a = x.a + da and y.b = x.b + db)"""
    o["h1_ring_pairs"] = on_gold(f"select * from (with {axial.format('true')} select * from near where h3_index <> ring_cell)")
    map_box = """latitude between 43.6 and 43.75 and longitude between -79.5 and -79.3
          and occurred_at >= timestamp '2024-01-05' and occurred_at < timestamp '2024-01-20'"""
    o["m7_heatmap_smoothed"] = on_gold(f"""select * from (with {axial.format(map_box)}
        select h3_index, any_value(n) as crime_count, sum(ring_n) as with_ring from near group by h3_index)""")
    o["m7_heatmap_counts"] = on_gold("""
        select h3_index, count(*) as crime_count from gold where latitude between 43.6 and 43.75
          and longitude between -79.5 and -79.3 and occurred_at >= timestamp '2024-01-05'
          and occurred_at < timestamp '2024-01-20' group by all""")
    o["m7_heatmap_risk"] = on_counts(f"""
        select h3_index, round(avg(crimes_last_24h / (1.0 + crimes_last_24h)), 6) as mean_risk
        from (select h3_index, make_timestamp(hour_no * 3600000000) as time_window, {LOOK} from counts
              window w as (partition by h3_index order by hour_no))
        where time_window >= timestamp '2024-01-05' and time_window < timestamp '2024-01-20'
          and h3_index in (select h3_index from gold where latitude between 43.6 and 43.75
                             and longitude between -79.5 and -79.3) group by all""")
    dense = features("dense")
    split = f"count(*) filter (time_window < timestamp '2024-01-22') as train_rows, count(*) filter (time_window >= timestamp '2024-01-22') as test_rows"
    o["m3_train_logistic"] = on_counts(f"select {split}, true as at_optimum from ({dense})", dense=DENSE_CELL)
    o["m3_train_boosted"] = on_counts(f"select {split}, true as in_range, true as near_base_rate, cast(3 as integer) as trees from ({dense})", dense=DENSE_CELL)
    boosted = "true as in_range, true as better_than_the_mean, true as near_base_rate, cast(2 as integer) as trees, true as leaves_bounded"
    for kind in ("xgboost", "lightgbm"):
        o[f"m3_train_{kind}"] = on_counts(f"select {split}, {boosted} from ({dense})", dense=DENSE_CELL)
    o["m3_level_histogram"] = on_counts(f"select * from ({level_histogram(dense)})", dense=DENSE_CELL)
    o["m3_best_splits"] = on_counts(best_splits(level_histogram(dense)), dense=DENSE_CELL)
    o["m5_fitted_entry"] = on_counts(f"""
        select 'm-1' as model_id, 'v1' as version, true as is_active, train_rows as training_samples, cast(12 as integer) as feature_count,
          cast(6 as integer) as n_metrics, '20' as max_iter, true as same_after_load from (select {split} from ({dense}))""", dense=DENSE_CELL)
    o["m6_score"] = on_counts(f"""
        select h3_index, time_window, target_binary, hour(time_window) = 5 as unknown, true as agrees from ({dense})
        where time_window >= timestamp '2024-01-22'""", dense=DENSE_CELL)
    o["s1_mixed_landing"] = sql({**{k: CTE[k] for k in ("raw", "cleaned")}, "kept": f"select * from cleaned where {IN_BOX} and {COMPLETE}",
            **hex_ctes("select latitude as lat, longitude as lon from kept")}, """
        select cell as name, count(*) as n from kept join hexes on latitude = lat and longitude = lon group by all
        union all select 'no coordinate columns in [''o_orderkey'', ''o_totalprice'']', 1""")
    o["s1_stored_manifest"] = sql({**{k: CTE[k] for k in ("raw", "cleaned")}, "kept": f"select * from cleaned where {IN_BOX} and {COMPLETE}",
            **hex_ctes("select latitude as lat, longitude as lon from kept")}, """
        select cell as h3_index, count(*) as n from kept join hexes on latitude = lat and longitude = lon group by all
        union all select 'read twice', 0 union all select 'raw rows', count(*) from raw""")
    o["s2_split_scan"] = on_raw("select pos, true as in_order from raw")
    o["s6_replace_changed_type"] = on_cleaned(f"""
        select source_file, dataset_type, count(*) as n, case when crime_type = 'Robbery' then 'refused' else 'kept' end as part
        from cleaned where {IN_BOX} and {COMPLETE} and source_file not like 'theft%' group by all""")
    o["r1_ledger"] = on_cleaned(f"""
        select '{MCI}' as dataset_type, 'completed' as status, null as error_message, count(*) as raw_rows,
          count(*) filter ({IN_BOX} and {COMPLETE}) as gold_rows from cleaned
        union all select 'theft-from-motor-vehicle', 'completed', null, count(*), 0 from cleaned
        union all select '{SHOOTINGS}', 'failed', 'no coordinate columns in [''o_orderkey'', ''price'']', null, 0""")
    # streaming
    o["r1_arrivals"] = on_gold(f"select {GOLD_COLS} from gold")
    live = {**{k: CTE[k] for k in ("raw", "cleaned")},
            "kept": f"select * from cleaned where {IN_BOX} and {COMPLETE}",
            **hex_ctes("select latitude as lat, longitude as lon from kept")}
    o["r2_live_counts"] = sql(live, """
        select cell as h3_index, date_trunc('hour', occurred_at) as time_window, count(*) as crime_count,
          count(distinct crime_type) as distinct_crime_types
        from kept join hexes on latitude = lat and longitude = lon group by all
        having date_trunc('hour', occurred_at) + interval 1 hour
          <= (select max(occurred_at) from kept) - interval 2 hour""")
    o["r2_live_first_counts"] = on_gold("""
        select h3_index, date_trunc('hour', occurred_at) as time_window, count(*) as crime_count,
          count(distinct crime_type) as distinct_crime_types from gold group by all
        having date_trunc('hour', occurred_at) + interval 1 hour
          <= (select max(occurred_at) from cleaned) - interval 2 hour""")
    return o
