"""Raw incident rows derived from the `events` and `nation` tables by fixed formulas, dirty on purpose.

Texts are built from integers, so every engine that repeats the formulas gets the same characters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hexwatch.settings import DATASETS
from hexwatch.sources.bronze import ROW_POS

STAMP = "20240101_000000"
FILES = [f"{key}_{STAMP}.csv" for key in DATASETS] + [f"toronto_crime_{STAMP}.csv", f"other_{STAMP}.csv"]


def _file_case(expr: str) -> str:
    whens = " ".join(f"when {i} then '{name}'" for i, name in enumerate(FILES))
    return f"case {expr} {whens} end"


RAW_SQL = f"""
select
  case when event_id % 101 = 0 then null
       else concat('E-', cast(event_id - (case when event_id % 8 = 7 then 1 else 0 end) as string)) end
    as EVENT_UNIQUE_ID,
  case when event_id % 97 = 0 then 'not a date'
       when event_id % 103 = 0 then null
       when event_id % 5 = 1 then date_format(ts, 'yyyy/MM/dd')
       when event_id % 5 = 2 then date_format(ts, 'MM/dd/yyyy')
       else date_format(ts, 'yyyy-MM-dd') end as OCC_DATE,
  case when event_id % 89 = 0 then 'abc'
       when event_id % 83 = 0 then '27'
       when event_id % 79 = 0 then '-3'
       when event_id % 73 = 0 then null
       when event_id % 71 = 0 then '4.9'
       else cast(hour(ts) as string) end as OCC_HOUR,
  case when event_id % 61 = 0 then '0.0'
       when event_id % 127 = 0 then 'x'
       when event_id % 131 = 0 then '5d'
       when event_id % 137 = 0 then null
       else concat('43.', lpad(cast(580000 + (user_id % 8) * 34000 + (event_id % 7) * 310 as string), 6, '0')) end
    as LAT_WGS84,
  case when event_id % 61 = 0 then '0.0'
       when event_id % 139 = 0 then 'nan'
       else concat('-79.', lpad(cast(230000 + ((user_id % 40) div 8) * 90000 + (event_id % 11) * 290 as string), 6, '0'))
       end as LONG_WGS84,
  case when event_id % 149 = 0 then null
       when event_id % 151 = 0 then 'theft under $5000x'
       when event_id % 157 = 0 then 'hit AND run o''neil'
       else case event_type
         when 'signup' then case when event_id % 3 = 0 then ' assault ' else 'ASSAULT' end
         when 'purchase' then case when event_id % 3 = 0 then 'b&e' when event_id % 3 = 1 then 'Break & Enter'
                                   else 'Break and Enter' end
         when 'view' then case when event_id % 2 = 0 then 'TheftOver' else 'theft over' end
         when 'click' then 'Auto Theft'
         else 'Robbery' end end as MCI_CATEGORY,
  case when event_id % 53 = 0 then '  '
       when event_id % 47 = 0 then 'nan'
       when event_id % 43 = 0 then null
       else concat(cast(n.n_nationkey as string), ' ', n.n_name, ' (', cast(n.n_nationkey as string), ')') end
    as NEIGHBOURHOOD_158,
  case when event_id % 41 = 0 then 'nan'
       when event_id % 37 = 0 then ''
       when event_id % 4 = 0 then ' House '
       when event_id % 4 = 1 then 'Apartment'
       when event_id % 4 = 2 then 'Commercial'
       else 'Outside' end as PREMISES_TYPE,
  {_file_case(f"cast((event_id div 8) % {len(FILES)} as int)")} as source_file,
  event_id as {ROW_POS}
from {{events}} e left join {{nation}} n on e.user_id % 25 = n.n_nationkey
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_from(events: DataFrame, nation: DataFrame) -> DataFrame:
    return events.sparkSession.sql(RAW_SQL, events=events, nation=nation)


def raw_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_from(table(spark, sf_dir, "events"), table(spark, sf_dir, "nation"))
