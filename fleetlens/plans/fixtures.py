"""The fleet's input tables, derived by SQL views from the star-schema and event test tables.

The texts run unchanged on Spark and on DuckDB; ``{name}`` stands for a table or another view.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

STATES_ASOF = dt.date(2024, 12, 31)
TOOLS_ASOF = dt.date(2026, 1, 1)

VIEWS = {
    # Raw state rows; _ord is the order of arrival.
    "fx_states": """
SELECT event_id AS _ord,
  CASE WHEN event_id % 17 = 0 THEN 'F9' ELSE 'F' || cast(user_id % 3 AS string) END AS FAB,
  'F' || cast(user_id % 3 AS string) || '_T' || cast(user_id AS string)
      || CASE WHEN user_id % 4 = 0 THEN '_PC' ELSE '_PM' END AS ENTITY,
  CASE event_type WHEN 'purchase' THEN ' Running1' WHEN 'view' THEN 'Running2' WHEN 'click' THEN 'UpToProduction'
      WHEN 'signup' THEN 'Bagged' ELSE 'Maintenance' END AS ENTITY_STATE,
  CASE WHEN event_id % 10 = 0 THEN 'unknown-Day'
       WHEN event_id % 10 <= 3 THEN cast(month(ts) AS string) || '/' || cast(day(ts) AS string) || '-Night'
       WHEN event_id % 10 <= 6 THEN lpad(cast(month(ts) AS string), 2, '0') || '/' || lpad(cast(day(ts) AS string), 2, '0') || '/24-Day'
       ELSE lpad(cast(month(ts) AS string), 2, '0') || '/' || lpad(cast(day(ts) AS string), 2, '0') || '/2024-Day' END AS DAY_SHIFT,
  cast(value AS decimal(10,2)) AS HOURS_IN_STATE,
  cast(ts AS date) AS load_date
FROM {events}""",
    # One row per tool and day: cumulative counters that reset.
    "fx_counters": """
SELECT 'F' || cast(user_id % 3 AS string) AS FAB,
  'F' || cast(user_id % 3 AS string) || '_T' || cast(user_id AS string) || '_PM' AS ENTITY,
  counter_date,
  cast(CASE WHEN f IS NOT NULL THEN sum(f) OVER w % 3000 END AS decimal(18,2)) AS FocusRingCounter,
  cast(CASE WHEN a IS NOT NULL THEN sum(a) OVER w % 5000 END AS decimal(18,2)) AS APCCounter,
  cast(CASE WHEN e IS NOT NULL THEN sum(e) OVER w END AS decimal(18,2)) AS ESCCounter,
  cast(CASE WHEN p IS NOT NULL THEN sum(p) OVER w END AS decimal(18,2)) AS PMACounter
FROM (
  SELECT user_id, cast(ts AS date) AS counter_date,
    sum(CASE WHEN event_type = 'purchase' THEN cast(value * 10 AS decimal(18,2)) END) AS f,
    sum(CASE WHEN event_type = 'view'     THEN cast(value * 10 AS decimal(18,2)) END) AS a,
    sum(CASE WHEN event_type = 'click'    THEN cast(value * 10 AS decimal(18,2)) END) AS e,
    sum(CASE WHEN event_type = 'signup'   THEN cast(value * 10 AS decimal(18,2)) END) AS p
  FROM {events} GROUP BY user_id, cast(ts AS date)) d
WINDOW w AS (PARTITION BY user_id ORDER BY counter_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    # Installed tools, their dates in several forms; every tenth tool is listed under two configurations.
    "fx_tools": """
SELECT k, ENTITY, Location, CASE WHEN k % 29 = 0 THEN NULL ELSE Three_CEID END AS Three_CEID,
  CASE WHEN k % 23 = 0 THEN 'n/a' ELSE cast(n % 5 AS string) END AS Process_Node,
  CASE WHEN k % 7 = 0 THEN 'Bagged' WHEN k % 7 = 1 THEN 'Not Installed' WHEN k % 7 = 2 THEN NULL ELSE 'Installed' END AS install_sts,
  CASE WHEN k % 11 = 0 THEN 'bad'
       WHEN k % 6 = 1 THEN cast(month(d) AS string) || '/' || cast(day(d) AS string) || '/' || cast(year(d) AS string)
       WHEN k % 6 = 2 THEN cast(day(d) AS string) || '-' || substr('JanFebMarAprMayJunJulAugSepOctNovDec', 3 * month(d) - 2, 3) || '-' || cast(year(d) AS string)
       WHEN k % 6 = 3 THEN replace(cast(d AS string), '-', '')
       ELSE cast(d AS string) END AS Warranty_Start
FROM (
  SELECT c_custkey AS k, c_name AS ENTITY, 'N' || cast(c_nationkey AS string) AS Location, c_mktsegment AS Three_CEID, c_nationkey AS n,
    cast(DATE '2026-01-01' - cast((c_custkey * 37) % 3000 AS int) AS date) AS d FROM {customer}
  UNION ALL
  SELECT c_custkey, c_name, 'N' || cast(c_nationkey AS string), 'BUILDING', c_nationkey,
    cast(DATE '2026-01-01' - cast((c_custkey * 37) % 3000 AS int) AS date) FROM {customer}
  WHERE c_custkey % 10 = 0 AND c_mktsegment <> 'BUILDING') c""",
    # The same tools, but those listed twice have a later second warranty: they span two ages.
    "fx_tools_moved": """
SELECT k, ENTITY, Location, Three_CEID, Process_Node, install_sts,
  CASE WHEN k % 10 = 0 AND k % 11 <> 0 AND Three_CEID = 'BUILDING'
       THEN cast(cast(DATE '2026-01-01' - cast((k * 37 + 800) % 3000 AS int) AS date) AS string)
       ELSE Warranty_Start END AS Warranty_Start
FROM {fx_tools} t""",
    # Which part fits which configuration.
    "fx_gbom": """
SELECT cast(k AS string) AS Part_Number,
  CASE s % 6 WHEN 0 THEN 'BUILDING' WHEN 1 THEN 'AUTOMOBILE' WHEN 2 THEN 'MACHINERY' WHEN 3 THEN 'HOUSEHOLD' WHEN 4 THEN 'FURNITURE' END AS Three_CEID,
  CASE WHEN s = 13 THEN 'n/a' ELSE cast(s % 5 AS string) END AS Process_Node, Tool_Type, s % 4 + 1 AS Qty_Per_Tool
FROM (
  SELECT p_partkey AS k, p_size AS s, p_type AS Tool_Type FROM {part}
  UNION ALL SELECT p_partkey, p_size + 1, p_type FROM {part} WHERE p_partkey % 3 = 0) g""",
    # The same parts, which also fit the BUILDING tools of their node: tools listed twice match twice.
    "fx_gbom_shared": """
SELECT Part_Number, Three_CEID, Process_Node, Tool_Type, Qty_Per_Tool FROM {fx_gbom} a
UNION ALL
SELECT Part_Number, 'BUILDING' AS Three_CEID, Process_Node, Tool_Type, Qty_Per_Tool FROM {fx_gbom} b""",
    # Stock lines; some tell a part by a name that the applicability list doesn't have.
    "fx_inventory": """
SELECT CASE WHEN l_partkey % 10 = 9 AND l_linenumber > 2 THEN 'X' ELSE '' END || cast(l_partkey AS string) AS Part_Number,
  CASE WHEN l_partkey % 13 = 0 THEN cast(0 AS decimal(18,2)) ELSE cast(l_quantity AS decimal(18,2)) END AS Qty,
  cast(l_extendedprice AS decimal(18,2)) AS Total_Amount_USD,
  l_suppkey AS Supplier_Code, l_orderkey, l_linenumber
FROM {lineitem}""",
    # Events as a log of counter files: one folder per fiscal week, modification times, any names.
    "fx_files": """
SELECT cast(ts AS date) AS day, event_type || '_' || cast(event_id AS string) || '.csv' AS path, ts AS modified
FROM {events}""",
}

# Order in which rows of a part came into the stock list.
STOCK_ORDER = ("l_orderkey", "l_linenumber", "Supplier_Code")


def view_sql(name: str) -> str:
    """The view as one nested query over the base tables, for an SQL engine that has them by name."""

    class Names(dict):
        def __missing__(self, key: str) -> str:
            return f"({view_sql(key)})" if key in VIEWS else key

    return VIEWS[name].strip().format_map(Names())


class Fixtures:
    """The views over one directory of test tables, as DataFrames."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark, self.directory = spark, directory

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.directory}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        text = VIEWS[name]
        inputs = [part.split("}")[0] for part in text.split("{")[1:]]
        frames = {key: self.view(key) if key in VIEWS else self.table(key) for key in set(inputs)}
        return self.spark.sql(text, **frames)

    @cached_property
    def states(self) -> DataFrame:
        return self.view("fx_states")

    @cached_property
    def counters(self) -> DataFrame:
        return self.view("fx_counters")

    @cached_property
    def tools(self) -> DataFrame:
        return self.view("fx_tools")

    @cached_property
    def gbom(self) -> DataFrame:
        return self.view("fx_gbom")

    @cached_property
    def inventory(self) -> DataFrame:
        return self.view("fx_inventory")

    @cached_property
    def files(self) -> DataFrame:
        return self.view("fx_files")
