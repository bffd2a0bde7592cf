"""The catalogue's queries as SQL over the base tables, written independently of the operators."""

from __future__ import annotations

from fleetlens.plans.fixtures import view_sql

# Texts with slashes, month names or eight digits aren't left to the cast, which would take some of them for other days.
WARRANTY = """CASE WHEN Warranty_Start LIKE '%-%-%' AND length(Warranty_Start) = 10 AND TRY_CAST(left(Warranty_Start, 4) AS INTEGER) > 0
    THEN TRY_CAST(Warranty_Start AS DATE)
  ELSE CAST(try_strptime(Warranty_Start, ['%m/%d/%Y', '%d-%b-%Y', '%Y%m%d']) AS DATE) END"""

# Named building blocks; {name} stands for another block or a fixture view.
_BLOCKS = {
    "raw": """
SELECT *, FAB || '_' || ENTITY AS FAB_ENTITY
FROM (SELECT * REPLACE (replace(ENTITY, '_PC', '_PM') AS ENTITY) FROM {fx_states})""",
    "bronze": """
SELECT * FROM {raw}
QUALIFY row_number() OVER (PARTITION BY FAB_ENTITY, DAY_SHIFT, ENTITY_STATE ORDER BY _ord DESC) = 1""",
    "parsed": """
SELECT *, split_part(DAY_SHIFT, '-', 1) AS d FROM {bronze}""",
    "dated": """
SELECT *,
  TRY_CAST(CASE split_part(d, '/', 3) WHEN '' THEN '2024' WHEN '24' THEN '2024' ELSE split_part(d, '/', 3) END
    || '-' || lpad(split_part(d, '/', 1), 2, '0') || '-' || lpad(split_part(d, '/', 2), 2, '0') AS DATE) AS state_date,
  CASE trim(ENTITY_STATE) WHEN 'Bagged' THEN 'Bagged' WHEN 'Running1' THEN 'Running' WHEN 'Running2' THEN 'Running'
    WHEN 'UpToProduction' THEN 'Idle' ELSE 'Down' END AS category
FROM {parsed}""",
    "by_site": """
SELECT ENTITY, FAB, FAB_ENTITY, state_date,
  coalesce(sum(HOURS_IN_STATE) FILTER (category = 'Running'), 0) AS running_hours,
  coalesce(sum(HOURS_IN_STATE) FILTER (category = 'Idle'), 0) AS idle_hours,
  coalesce(sum(HOURS_IN_STATE) FILTER (category = 'Down'), 0) AS down_hours,
  coalesce(sum(HOURS_IN_STATE) FILTER (category = 'Bagged'), 0) AS bagged_hours,
  coalesce(sum(HOURS_IN_STATE), 0) AS total_hours
FROM {dated} WHERE state_date IS NOT NULL GROUP BY 1, 2, 3, 4""",
    "hours": """
SELECT *, bagged_hours > 0 AS is_bagged FROM {by_site}
QUALIFY row_number() OVER (PARTITION BY ENTITY, state_date ORDER BY FAB DESC, FAB_ENTITY DESC) = 1""",
    "lagged": """
SELECT ENTITY, counter_date, FocusRingCounter AS f, APCCounter AS a, ESCCounter AS e, PMACounter AS p,
  lag(FocusRingCounter) OVER w AS pf, lag(APCCounter) OVER w AS pa, lag(ESCCounter) OVER w AS pe,
  lag(PMACounter) OVER w AS pp, row_number() OVER w = 1 AS is_first
FROM {fx_counters} WINDOW w AS (PARTITION BY ENTITY ORDER BY counter_date)""",
    "choice": """
SELECT *, CASE WHEN f > 0 THEN 'FocusRingCounter' WHEN a > 0 THEN 'APCCounter' WHEN e > 0 THEN 'ESCCounter'
    WHEN p > 0 THEN 'PMACounter' END AS c1,
  CASE WHEN a > 0 THEN 'APCCounter' WHEN e > 0 THEN 'ESCCounter' WHEN p > 0 THEN 'PMACounter' END AS c2
FROM {lagged}""",
    "valued": """
SELECT *,
  CASE c1 WHEN 'FocusRingCounter' THEN f WHEN 'APCCounter' THEN a WHEN 'ESCCounter' THEN e WHEN 'PMACounter' THEN p END AS v1,
  CASE c1 WHEN 'FocusRingCounter' THEN pf WHEN 'APCCounter' THEN pa WHEN 'ESCCounter' THEN pe WHEN 'PMACounter' THEN pp END AS p1,
  CASE c2 WHEN 'APCCounter' THEN a WHEN 'ESCCounter' THEN e WHEN 'PMACounter' THEN p END AS v2,
  CASE c2 WHEN 'APCCounter' THEN pa WHEN 'ESCCounter' THEN pe WHEN 'PMACounter' THEN pp END AS p2,
  CASE c1 WHEN 'FocusRingCounter' THEN 'Focus' ELSE c1 END AS k1
FROM {choice}""",
    "judged": """
SELECT *, coalesce(v1 - p1 < -1000, false) AS replaced,
  coalesce(v1 - p1 < -1000 AND c1 = 'FocusRingCounter' AND v2 - p2 >= 0, false) AS adopted
FROM {valued}""",
    "changed": """
SELECT j.*, CASE WHEN adopted THEN v2 - p2 WHEN replaced THEN 0 ELSE v1 - p1 END AS change,
  coalesce(h.running_hours, 0) AS running_hours
FROM {judged} j LEFT JOIN {hours} h ON h.ENTITY = j.ENTITY AND h.state_date = j.counter_date""",
    "made": """
SELECT *, CASE WHEN change >= 0 THEN change END AS wafers,
  CASE WHEN change >= 0 AND running_hours > 0 THEN CAST(change AS DOUBLE) / CAST(running_hours AS DOUBLE) END AS rate,
  CASE WHEN adopted THEN c2 ELSE c1 END AS counter, CASE WHEN adopted THEN c2 ELSE k1 END AS keyword,
  CASE WHEN adopted THEN v2 ELSE v1 END AS cur, CASE WHEN adopted THEN p2 ELSE p1 END AS prev,
  nullif(concat_ws('; ',
    CASE WHEN c1 IS NULL THEN 'No counter found with any keyword' END,
    CASE WHEN c1 IS NOT NULL AND is_first THEN 'First day - no previous value' END,
    CASE WHEN c1 IS NOT NULL AND NOT is_first AND p1 IS NULL THEN 'Previous value is null' END,
    CASE WHEN replaced THEN 'Part replacement: ' || c1 || ' reset from '
      || regexp_replace(CAST(p1 AS VARCHAR), '(\\.\\d)0$', '\\1') || ' to '
      || regexp_replace(CAST(v1 AS VARCHAR), '(\\.\\d)0$', '\\1') END,
    CASE WHEN adopted THEN 'Used fallback counter: ' || c2 END,
    CASE WHEN replaced AND NOT adopted THEN 'Counter change set to 0 (part replacement)' END,
    CASE WHEN change >= 0 AND running_hours = 0 THEN 'No running hours - cannot calculate wafers/hour' END), '') AS notes
FROM {changed}""",
    "production": """
SELECT ENTITY, CAST(counter_date AS VARCHAR) AS counter_date, counter AS counter_column_used, keyword AS counter_keyword_used,
  CAST(cur AS DOUBLE) AS counter_current_value, CAST(prev AS DOUBLE) AS counter_previous_value,
  CAST(change AS DOUBLE) AS counter_change, CAST(replaced AS VARCHAR) AS part_replacement_detected,
  CAST(wafers AS DOUBLE) AS wafers_produced, CAST(running_hours AS DOUBLE) AS running_hours,
  rate AS wafers_per_hour, notes AS calculation_notes
FROM {made}""",
    "daily": """
SELECT m.ENTITY, h.FAB, h.FAB_ENTITY, m.counter_date AS production_date, m.wafers, m.rate, h.running_hours, h.idle_hours,
  h.down_hours, h.bagged_hours, h.total_hours, h.is_bagged, m.replaced, m.counter, m.keyword
FROM {made} m LEFT JOIN {hours} h ON h.ENTITY = m.ENTITY AND h.state_date = m.counter_date""",
    "tools": """
SELECT * REPLACE (TRY_CAST(Process_Node AS BIGINT) AS Process_Node), ENTITY || '|' || Location AS Tool_ID,
  DATE '2026-01-01' - start AS age_days,
  coalesce(install_sts NOT IN ('Bagged', 'Not Installed'), true) AS active FROM {started}""",
    "started": f"SELECT *, {WARRANTY} AS start FROM {{fx_tools}}",
    "started_moved": f"SELECT *, {WARRANTY} AS start FROM {{fx_tools_moved}}",
    "moved": """
SELECT * REPLACE (TRY_CAST(Process_Node AS BIGINT) AS Process_Node), ENTITY || '|' || Location AS Tool_ID,
  DATE '2026-01-01' - start AS age_days,
  coalesce(install_sts NOT IN ('Bagged', 'Not Installed'), true) AS active FROM {started_moved}""",
    "aged": """
SELECT *, CASE WHEN age_days IS NULL THEN 'UnknownAge' WHEN age_days / 365.25 < 1 THEN '0_1Y' WHEN age_days / 365.25 < 3 THEN '1_3Y'
  WHEN age_days / 365.25 < 5 THEN '3_5Y' ELSE '5P_Y' END AS Age_Bucket FROM {tools}""",
    "aged_moved": """
SELECT *, CASE WHEN age_days IS NULL THEN 'UnknownAge' WHEN age_days / 365.25 < 1 THEN '0_1Y' WHEN age_days / 365.25 < 3 THEN '1_3Y'
  WHEN age_days / 365.25 < 5 THEN '3_5Y' ELSE '5P_Y' END AS Age_Bucket FROM {moved}""",
    "gbom": """
SELECT * REPLACE (TRY_CAST(Process_Node AS BIGINT) AS Process_Node) FROM {fx_gbom}""",
    "gbom_shared": """
SELECT * REPLACE (TRY_CAST(Process_Node AS BIGINT) AS Process_Node) FROM {fx_gbom_shared}""",
    "mart": """
SELECT Three_CEID, Process_Node, count(DISTINCT Tool_ID) AS Active_Tool_Count_Config,
  count(DISTINCT Tool_ID) FILTER (Age_Bucket = '0_1Y') AS Count_Of_Tools_Age_0_to_1_Yr,
  count(DISTINCT Tool_ID) FILTER (Age_Bucket = '1_3Y') AS Count_Of_Tools_Age_1_to_3_Yr,
  count(DISTINCT Tool_ID) FILTER (Age_Bucket = '3_5Y') AS Count_Of_Tools_Age_3_to_5_Yr,
  count(DISTINCT Tool_ID) FILTER (Age_Bucket = '5P_Y') AS Count_Of_Tools_Age_5_Plus_Yr,
  count(DISTINCT Tool_ID) FILTER (Age_Bucket = 'UnknownAge') AS Count_Of_Tools_Age_Unknown
FROM {aged} WHERE active AND Three_CEID IS NOT NULL AND Process_Node IS NOT NULL GROUP BY 1, 2""",
    "used": """
SELECT DISTINCT g.Part_Number, t.Tool_ID, t.Age_Bucket
FROM {gbom} g JOIN {aged} t ON g.Three_CEID IS NOT DISTINCT FROM t.Three_CEID AND g.Process_Node IS NOT DISTINCT FROM t.Process_Node
WHERE t.active""",
    "used_shared": """
SELECT DISTINCT g.Part_Number, t.Tool_ID, t.Age_Bucket
FROM {gbom_shared} g JOIN {aged_moved} t ON g.Three_CEID IS NOT DISTINCT FROM t.Three_CEID AND g.Process_Node IS NOT DISTINCT FROM t.Process_Node
WHERE t.active""",
    "counts": """
SELECT Part_Number, count(DISTINCT Tool_ID) AS Number_of_active_tools,
  count(DISTINCT Tool_ID) FILTER (Age_Bucket = '0_1Y') AS Count_Of_Tools_Age_0_to_1_Yr,
  count(DISTINCT Tool_ID) FILTER (Age_Bucket = '1_3Y') AS Count_Of_Tools_Age_1_to_3_Yr,
  count(DISTINCT Tool_ID) FILTER (Age_Bucket = '3_5Y') AS Count_Of_Tools_Age_3_to_5_Yr,
  count(DISTINCT Tool_ID) FILTER (Age_Bucket = '5P_Y') AS Count_Of_Tools_Age_5_Plus_Yr,
  count(DISTINCT Tool_ID) FILTER (Age_Bucket = 'UnknownAge') AS Count_Of_Tools_Age_Unknown
FROM {used} GROUP BY 1""",
    "offences": """
SELECT Part_Number, Tool_ID, count(DISTINCT Age_Bucket) AS Distinct_Buckets FROM {used_shared} GROUP BY 1, 2 HAVING count(DISTINCT Age_Bucket) > 1""",
    "stock": """
SELECT Part_Number, sum(Qty) AS qty, sum(Total_Amount_USD) AS amount,
  CAST(sum(Total_Amount_USD) AS DOUBLE) / nullif(CAST(sum(Qty) AS DOUBLE), 0) AS cost,
  arg_min(Supplier_Code, (l_orderkey, l_linenumber, Supplier_Code)) AS supplier
FROM {fx_inventory} GROUP BY 1""",
    "lists": """
SELECT Part_Number, max(Qty_Per_Tool) AS most, array_to_string(list_sort(list(DISTINCT Three_CEID) FILTER (Three_CEID IS NOT NULL)), ', ') AS ceids,
  array_to_string(list_sort(list(DISTINCT Tool_Type) FILTER (Tool_Type IS NOT NULL)), ', ') AS types
FROM {fx_gbom} GROUP BY 1""",
    "board": """
SELECT s.*, l.most, CASE WHEN l.Part_Number IS NOT NULL THEN coalesce(l.ceids, '') END AS ceids,
  CASE WHEN l.Part_Number IS NOT NULL THEN coalesce(l.types, '') END AS types,
  coalesce(c.Number_of_active_tools, 0) AS n, c.* EXCLUDE (Part_Number, Number_of_active_tools),
  CASE WHEN l.Part_Number IS NULL THEN 'Divest/Scrap' WHEN c.Number_of_active_tools > 0 THEN 'Sell' ELSE 'Investigate' END AS category,
  CASE WHEN l.Part_Number IS NULL THEN 'Low' WHEN c.Number_of_active_tools > 0 THEN 'High' ELSE 'Medium' END AS confidence,
  CASE WHEN c.Number_of_active_tools > 0 THEN 'Y' ELSE 'N' END AS flag
FROM {stock} s LEFT JOIN {lists} l USING (Part_Number) LEFT JOIN {counts} c USING (Part_Number)""",
    "days": """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, make_date(isoyear(o_orderdate) - 1, 12, 28) AS dec28 FROM orders""",
    "log": """
SELECT *, make_date(isoyear(day) - 1, 12, 28) AS dec28 FROM {fx_files}""",
    "log_weeks": """
SELECT *, isoyear(day) || 'WW' || lpad(CAST((day - (dec28 - CAST(dayofweek(dec28) AS INTEGER))) // 7 + 1 AS VARCHAR), 2, '0') AS ww FROM {log}""",
    "loads": """
SELECT _ord, load_date, make_date(isoyear(load_date) - 1, 12, 28) AS dec28 FROM {fx_states}""",
    "load_weeks": """
SELECT _ord, load_date, isoyear(load_date) || 'WW'
  || lpad(CAST((load_date - (dec28 - CAST(dayofweek(dec28) AS INTEGER))) // 7 + 1 AS VARCHAR), 2, '0') AS load_ww FROM {loads}""",
}

_QUERIES = {
    "state_hours": """
SELECT ENTITY, FAB, FAB_ENTITY, CAST(state_date AS VARCHAR) AS state_date, CAST(running_hours AS DOUBLE) AS running_hours,
  CAST(idle_hours AS DOUBLE) AS idle_hours, CAST(down_hours AS DOUBLE) AS down_hours, CAST(bagged_hours AS DOUBLE) AS bagged_hours,
  CAST(total_hours AS DOUBLE) AS total_hours, CAST(is_bagged AS VARCHAR) AS is_bagged FROM {hours}""",
    "hours_by_category": """
SELECT ENTITY, FAB, FAB_ENTITY, CAST(state_date AS VARCHAR) AS state_date, category AS state_category,
  CAST(coalesce(sum(HOURS_IN_STATE), 0) AS DOUBLE) AS hours FROM {dated} WHERE state_date IS NOT NULL GROUP BY ALL""",
    "tool_day_hours": """
SELECT ENTITY, FAB, FAB_ENTITY, CAST(state_date AS VARCHAR) AS state_date, CAST(running_hours AS DOUBLE) AS running_hours,
  CAST(idle_hours AS DOUBLE) AS idle_hours, CAST(down_hours AS DOUBLE) AS down_hours, CAST(bagged_hours AS DOUBLE) AS bagged_hours,
  CAST(total_hours AS DOUBLE) AS total_hours, CAST(bagged_hours > 0 AS VARCHAR) AS is_bagged FROM {by_site}""",
    "classify_state": """
SELECT _ord, ENTITY_STATE, CASE trim(ENTITY_STATE) WHEN 'Bagged' THEN 'Bagged' WHEN 'Running1' THEN 'Running'
  WHEN 'Running2' THEN 'Running' WHEN 'UpToProduction' THEN 'Idle' ELSE 'Down' END AS state_category FROM {fx_states}""",
    "parse_day_shift": """
SELECT _ord, DAY_SHIFT, CAST(TRY_CAST(CASE split_part(d, '/', 3) WHEN '' THEN '2024' WHEN '24' THEN '2024' ELSE split_part(d, '/', 3) END
  || '-' || lpad(split_part(d, '/', 1), 2, '0') || '-' || lpad(split_part(d, '/', 2), 2, '0') AS DATE) AS VARCHAR) AS state_date
FROM (SELECT *, split_part(DAY_SHIFT, '-', 1) AS d FROM {fx_states})""",
    "daily_state_fact": """
SELECT ENTITY, FAB, FAB_ENTITY, CAST(state_date AS VARCHAR) AS state_date, CAST(running_hours AS DOUBLE) AS running_hours,
  CAST(idle_hours AS DOUBLE) AS idle_hours, CAST(down_hours AS DOUBLE) AS down_hours, CAST(bagged_hours AS DOUBLE) AS bagged_hours,
  CAST(total_hours AS DOUBLE) AS total_hours, CAST(is_bagged AS VARCHAR) AS is_bagged,
  CASE WHEN total_hours > 0 THEN CAST(running_hours AS DOUBLE) / CAST(total_hours AS DOUBLE) * 100 ELSE 0 END AS running_pct,
  CASE WHEN total_hours > 0 THEN CAST(idle_hours AS DOUBLE) / CAST(total_hours AS DOUBLE) * 100 ELSE 0 END AS idle_pct,
  CASE WHEN total_hours > 0 THEN CAST(down_hours AS DOUBLE) / CAST(total_hours AS DOUBLE) * 100 ELSE 0 END AS down_pct
FROM {hours}""",
    "weekly_state_fact": """
SELECT ENTITY, FAB, FAB_ENTITY, YEARWW, CAST(r AS DOUBLE) AS total_running_hours, CAST(i AS DOUBLE) AS total_idle_hours,
  CAST(d AS DOUBLE) AS total_down_hours, CAST(b AS DOUBLE) AS total_bagged_hours, CAST(t AS DOUBLE) AS total_hours,
  CAST(bagged AS VARCHAR) AS was_bagged_any_day, CAST(lo AS VARCHAR) AS week_start_date, CAST(hi AS VARCHAR) AS week_end_date, n AS days_with_data,
  CASE WHEN t > 0 THEN CAST(r AS DOUBLE) / CAST(t AS DOUBLE) * 100 ELSE 0 END AS running_pct,
  CASE WHEN t > 0 THEN CAST(i AS DOUBLE) / CAST(t AS DOUBLE) * 100 ELSE 0 END AS idle_pct,
  CASE WHEN t > 0 THEN CAST(d AS DOUBLE) / CAST(t AS DOUBLE) * 100 ELSE 0 END AS down_pct
FROM (SELECT ENTITY, FAB, FAB_ENTITY, year(state_date) || 'WW' || lpad(CAST(week(state_date) AS VARCHAR), 2, '0') AS YEARWW,
    sum(running_hours) AS r, sum(idle_hours) AS i, sum(down_hours) AS d, sum(bagged_hours) AS b, sum(total_hours) AS t,
    bool_or(is_bagged) AS bagged, min(state_date) AS lo, max(state_date) AS hi, count(*) AS n
  FROM {hours} GROUP BY 1, 2, 3, 4)
QUALIFY row_number() OVER (PARTITION BY ENTITY, YEARWW ORDER BY FAB DESC, FAB_ENTITY DESC) = 1""",
    "state_audit": """
SELECT CASE category WHEN 'Bagged' THEN 'bagged_tool' ELSE 'unknown_state' END AS event, ENTITY, CAST(state_date AS VARCHAR) AS state_date,
  trim(ENTITY_STATE) AS state, count(*) AS n_rows
FROM {dated} WHERE state_date IS NOT NULL AND category IN ('Bagged', 'Down') GROUP BY ALL""",
    "state_classification": """
SELECT ENTITY, FAB, FAB_ENTITY, CAST(state_date AS VARCHAR) AS state_date, CAST(running_hours AS DOUBLE) AS running_hours,
  CAST(idle_hours AS DOUBLE) AS idle_hours, CAST(down_hours AS DOUBLE) AS down_hours FROM {by_site}""",
    "normalize_entity": "SELECT _ord, ENTITY, replace(ENTITY, '_PC', '_PM') AS normalized FROM {fx_states}",
    "normalization_report": """
SELECT count(*) AS n_rows, count(*) FILTER (ENTITY LIKE '%\\_PC%' ESCAPE '\\') AS n_changed FROM {fx_states}""",
    "fab_entity_key": "SELECT _ord, FAB || '_' || ENTITY AS FAB_ENTITY FROM {fx_states}",
    "derive_fab": """
SELECT ENTITY, CAST(counter_date AS VARCHAR) AS counter_date, split_part(ENTITY, '_', 1) AS derived_fab FROM {fx_counters}""",
    "fiscal_work_week": """
SELECT o_orderkey, isoyear(d) || 'WW' || lpad(CAST((d - (dec28 - CAST(dayofweek(dec28) AS INTEGER))) // 7 + 1 AS VARCHAR), 2, '0') AS label
FROM {days}""",
    "fiscal_work_week_nearest": """
SELECT o_orderkey, isoyear(d) || 'WW' || lpad(CAST((d - (dec28 - CAST(dayofweek(dec28) AS INTEGER)
  + CASE WHEN dayofweek(dec28) > 3 THEN 7 ELSE 0 END)) // 7 + 1 AS VARCHAR), 2, '0') AS label
FROM {days}""",
    "iso_yearww": "SELECT o_orderkey, year(d) || 'WW' || lpad(CAST(week(d) AS VARCHAR), 2, '0') AS label FROM {days}",
    "iso_yearww_iso": "SELECT o_orderkey, isoyear(d) || 'WW' || lpad(CAST(week(d) AS VARCHAR), 2, '0') AS label FROM {days}",
    "counter_date": "SELECT path, CAST(CAST(modified AS DATE) - 1 AS VARCHAR) AS counter_date FROM {fx_files}",
    "recent_work_weeks": """
SELECT ww, CAST(1 + (DATE '2024-01-31' - CAST(min(week_day) AS DATE)) // 7 AS BIGINT) AS rank, count(*) AS n_files
FROM (SELECT l.ww, w.day AS week_day FROM {log_weeks} l JOIN
  (SELECT DISTINCT DATE '2024-01-31' - 7 * CAST(i AS INTEGER) AS day FROM range(4) r(i)) w
  ON w.day - CAST(dayofweek(w.day) AS INTEGER) = l.day - CAST(dayofweek(l.day) AS INTEGER)) GROUP BY ww""",
    "latest_file_per_week": """
SELECT ww, path, strftime(modified, '%Y-%m-%d %H:%M:%S') AS modified FROM {log_weeks}
QUALIFY row_number() OVER (PARTITION BY ww ORDER BY modified DESC, path DESC) = 1""",
    "dedup_keep_last": """
SELECT FAB_ENTITY, DAY_SHIFT, ENTITY_STATE, _ord, CAST(HOURS_IN_STATE AS DOUBLE) AS HOURS_IN_STATE FROM {bronze}""",
    "dedup_report": """
SELECT (SELECT count(*) FROM {raw}) AS rows_before, (SELECT count(*) FROM {bronze}) AS rows_after,
  (SELECT count(*) FROM {raw}) - (SELECT count(*) FROM {bronze}) AS rows_removed""",
    "filter_report": """
SELECT count(*) AS rows_before, count(*) FILTER (DAY_SHIFT LIKE '%/%') AS rows_after, count(*) FILTER (DAY_SHIFT NOT LIKE '%/%') AS rows_removed
FROM {fx_states}""",
    "upsert": """
SELECT FAB_ENTITY, ENTITY_STATE, DAY_SHIFT, _ord, CAST(HOURS_IN_STATE AS DOUBLE) AS HOURS_IN_STATE FROM {raw}
QUALIFY row_number() OVER (PARTITION BY FAB_ENTITY, ENTITY_STATE ORDER BY load_date >= DATE '2024-01-16' DESC, _ord DESC) = 1""",
    "union_dynamic_columns": """
SELECT ENTITY, CAST(counter_date AS VARCHAR) AS counter_date,
  CASE WHEN even THEN CAST(APCCounter AS DOUBLE) END AS APCCounter, CAST(FocusRingCounter AS DOUBLE) AS FocusRingCounter,
  CASE WHEN NOT even THEN CAST(PMACounter AS DOUBLE) END AS PMACounter
FROM (SELECT *, CAST(regexp_extract(ENTITY, 'T(\\d+)_', 1) AS INTEGER) % 2 = 0 AS even FROM {fx_counters})""",
    "union_all": "SELECT _ord, ENTITY, CAST(load_date AS VARCHAR) AS load_date FROM {fx_states}",
    "mode_filter": """
SELECT _ord, CAST(load_date AS VARCHAR) AS load_date, load_ww FROM {load_weeks}
WHERE load_date BETWEEN DATE '2024-01-14' AND DATE '2024-02-03'""",
    "mode_filter_incremental": """
SELECT _ord, CAST(load_date AS VARCHAR) AS load_date, load_ww FROM {load_weeks}
WHERE load_date BETWEEN DATE '2024-01-28' AND DATE '2024-02-03'""",
    "lookback": "SELECT _ord, CAST(load_date AS VARCHAR) AS load_date FROM {fx_states} WHERE load_date >= DATE '2024-01-23'",
    "retention": "SELECT _ord, CAST(load_date AS VARCHAR) AS load_date FROM {fx_states} WHERE load_date >= DATE '2024-01-11'",
    "unique_violations": """
SELECT FAB_ENTITY, DAY_SHIFT, ENTITY_STATE, count(*) AS n_rows FROM {raw} GROUP BY 1, 2, 3 HAVING count(*) > 1""",
    "null_violations": """
SELECT 'ENTITY' AS column_name, count(*) FILTER (ENTITY IS NULL) AS n_nulls FROM {fx_tools}
UNION ALL SELECT 'Three_CEID', count(*) FILTER (Three_CEID IS NULL) FROM {fx_tools}
UNION ALL SELECT 'Process_Node', count(*) FILTER (Process_Node IS NULL) FROM {fx_tools}
UNION ALL SELECT 'install_sts', count(*) FILTER (install_sts IS NULL) FROM {fx_tools}""",
    "pick_counter": """
SELECT ENTITY, CAST(counter_date AS VARCHAR) AS counter_date, c1 AS name, k1 AS keyword, CAST(v1 AS DOUBLE) AS value FROM {valued}""",
    "previous_row": """
SELECT ENTITY, CAST(counter_date AS VARCHAR) AS counter_date, CAST(pf AS DOUBLE) AS previous_FocusRingCounter,
  CAST(pa AS DOUBLE) AS previous_APCCounter, CAST(pe AS DOUBLE) AS previous_ESCCounter, CAST(pp AS DOUBLE) AS previous_PMACounter,
  CAST(is_first AS VARCHAR) AS is_first FROM {lagged}""",
    "counter_change": """
SELECT ENTITY, CAST(counter_date AS VARCHAR) AS counter_date, c1 AS picked_counter, CAST(v1 - p1 AS DOUBLE) AS picked_change,
  CAST(v1 - p1 < -1000 AS VARCHAR) AS is_replacement FROM {valued}""",
    "wafer_production": "SELECT * FROM {production}",
    "incremental_production": "SELECT * FROM {production} WHERE counter_date >= '2024-01-16'",
    "part_replacements": """
SELECT ENTITY, CAST(counter_date AS VARCHAR) AS replacement_date, counter AS part_counter_name, CAST(prev AS DOUBLE) AS last_value_before_replacement,
  CAST(cur AS DOUBLE) AS first_value_after_replacement, CAST(prev - cur AS DOUBLE) AS value_drop, CAST(prev AS DOUBLE) AS part_wafers_at_replacement, notes
FROM {made} WHERE replaced""",
    "part_replacements_replaced": """
SELECT ENTITY, CAST(counter_date AS VARCHAR) AS replacement_date, c1 AS part_counter_name, CAST(p1 AS DOUBLE) AS last_value_before_replacement,
  CAST(v1 AS DOUBLE) AS first_value_after_replacement, CAST(p1 - v1 AS DOUBLE) AS value_drop, CAST(p1 AS DOUBLE) AS part_wafers_at_replacement, notes
FROM {made} WHERE replaced""",
    "daily_production": """
SELECT ENTITY, FAB, FAB_ENTITY, CAST(production_date AS VARCHAR) AS production_date, CAST(wafers AS DOUBLE) AS wafers_produced, rate AS wafers_per_hour,
  CAST(running_hours AS DOUBLE) AS running_hours, CAST(idle_hours AS DOUBLE) AS idle_hours, CAST(down_hours AS DOUBLE) AS down_hours,
  CAST(bagged_hours AS DOUBLE) AS bagged_hours, CAST(total_hours AS DOUBLE) AS total_hours, CAST(is_bagged AS VARCHAR) AS is_bagged,
  CAST(replaced AS VARCHAR) AS part_replacement_detected, counter AS counter_column_used, keyword AS counter_keyword_used FROM {daily}""",
    "weekly_production": """
SELECT ENTITY, FAB, FAB_ENTITY, YEARWW, CAST(w AS DOUBLE) AS total_wafers_produced, CAST(r AS DOUBLE) AS total_running_hours,
  CAST(i AS DOUBLE) AS total_idle_hours, CAST(d AS DOUBLE) AS total_down_hours, CAST(b AS DOUBLE) AS total_bagged_hours, CAST(t AS DOUBLE) AS total_hours,
  replacements AS part_replacements_count, CAST(lo AS VARCHAR) AS week_start_date, CAST(hi AS VARCHAR) AS week_end_date, n AS days_with_data,
  CASE WHEN r > 0 THEN CAST(w AS DOUBLE) / CAST(r AS DOUBLE) END AS avg_wafers_per_hour
FROM (SELECT ENTITY, FAB, FAB_ENTITY, year(production_date) || 'WW' || lpad(CAST(week(production_date) AS VARCHAR), 2, '0') AS YEARWW,
    coalesce(sum(wafers), 0) AS w, sum(running_hours) AS r, sum(idle_hours) AS i, sum(down_hours) AS d, sum(bagged_hours) AS b, sum(total_hours) AS t,
    count(*) FILTER (replaced) AS replacements, min(production_date) AS lo, max(production_date) AS hi, count(*) AS n
  FROM {daily} WHERE FAB IS NOT NULL GROUP BY 1, 2, 3, 4)
QUALIFY row_number() OVER (PARTITION BY ENTITY, YEARWW ORDER BY FAB DESC, FAB_ENTITY DESC) = 1""",
    "weekly_production_iso": """
SELECT ENTITY, FAB, FAB_ENTITY, YEARWW, CAST(w AS DOUBLE) AS total_wafers_produced, CAST(r AS DOUBLE) AS total_running_hours,
  CAST(i AS DOUBLE) AS total_idle_hours, CAST(d AS DOUBLE) AS total_down_hours, CAST(b AS DOUBLE) AS total_bagged_hours, CAST(t AS DOUBLE) AS total_hours,
  replacements AS part_replacements_count, CAST(lo AS VARCHAR) AS week_start_date, CAST(hi AS VARCHAR) AS week_end_date, n AS days_with_data,
  CASE WHEN r > 0 THEN CAST(w AS DOUBLE) / CAST(r AS DOUBLE) END AS avg_wafers_per_hour
FROM (SELECT ENTITY, FAB, FAB_ENTITY, isoyear(production_date) || 'WW' || lpad(CAST(week(production_date) AS VARCHAR), 2, '0') AS YEARWW,
    coalesce(sum(wafers), 0) AS w, sum(running_hours) AS r, sum(idle_hours) AS i, sum(down_hours) AS d, sum(bagged_hours) AS b, sum(total_hours) AS t,
    count(*) FILTER (replaced) AS replacements, min(production_date) AS lo, max(production_date) AS hi, count(*) AS n
  FROM {daily} WHERE FAB IS NOT NULL GROUP BY 1, 2, 3, 4)
QUALIFY row_number() OVER (PARTITION BY ENTITY, YEARWW ORDER BY FAB DESC, FAB_ENTITY DESC) = 1""",
    "production_audit": """
SELECT ENTITY, CAST(counter_date AS VARCHAR) AS counter_date, event, CASE event WHEN 'wafers_calculated' THEN counter ELSE c1 END AS counter,
  CASE event WHEN 'wafers_calculated' THEN keyword WHEN 'fallback_used' THEN c2 ELSE k1 END AS keyword,
  CAST(p1 AS DOUBLE) AS previous_value, CAST(v1 AS DOUBLE) AS current_value
FROM {made}, (VALUES ('no_counter_found'), ('counter_found'), ('negative_change'), ('part_replacement'), ('fallback_used'), ('wafers_calculated')) x(event)
WHERE CASE event WHEN 'no_counter_found' THEN c1 IS NULL WHEN 'counter_found' THEN c1 IS NOT NULL WHEN 'negative_change' THEN v1 - p1 < 0
  WHEN 'part_replacement' THEN replaced WHEN 'fallback_used' THEN replaced AND c1 = 'FocusRingCounter' AND c2 IS NOT NULL
  ELSE rate IS NOT NULL END""",
    "age_bucket": "SELECT k, Three_CEID, CAST(age_days AS DOUBLE) AS Tool_Age_Days, Age_Bucket FROM {aged}",
    "is_active": "SELECT k, Three_CEID, install_sts, CAST(active AS VARCHAR) AS is_active FROM {tools}",
    "tool_id": "SELECT k, Three_CEID, Tool_ID FROM {tools}",
    "to_int": "SELECT k, Three_CEID, Process_Node, CAST(TRY_CAST(Process_Node AS BIGINT) AS DOUBLE) AS node FROM {fx_tools}",
    "config_mart": "SELECT * FROM {mart}",
    "drilldown": """
SELECT g.Part_Number, g.Three_CEID, CAST(g.Process_Node AS DOUBLE) AS Process_Node, g.Tool_Type, CAST(g.Qty_Per_Tool AS BIGINT) AS Qty_Per_Tool,
  coalesce(m.Active_Tool_Count_Config, 0) AS Active_Tool_Count_Config, CAST(m.Count_Of_Tools_Age_0_to_1_Yr AS DOUBLE) AS Count_Of_Tools_Age_0_to_1_Yr,
  CAST(m.Count_Of_Tools_Age_1_to_3_Yr AS DOUBLE) AS Count_Of_Tools_Age_1_to_3_Yr, CAST(m.Count_Of_Tools_Age_3_to_5_Yr AS DOUBLE) AS Count_Of_Tools_Age_3_to_5_Yr,
  CAST(m.Count_Of_Tools_Age_5_Plus_Yr AS DOUBLE) AS Count_Of_Tools_Age_5_Plus_Yr, CAST(m.Count_Of_Tools_Age_Unknown AS DOUBLE) AS Count_Of_Tools_Age_Unknown,
  CAST(s.qty AS DOUBLE) AS Qty_Total, CAST(s.amount AS DOUBLE) AS Total_Amount_USD, s.cost AS Cost_per_part,
  coalesce(m.Active_Tool_Count_Config, 0) * g.Qty_Per_Tool AS Estimated_Parts_Needed_Config
FROM {gbom} g LEFT JOIN {mart} m ON g.Three_CEID = m.Three_CEID AND g.Process_Node = m.Process_Node
LEFT JOIN {stock} s ON s.Part_Number = g.Part_Number""",
    "leadership": """
SELECT Part_Number, CAST(qty AS DOUBLE) AS Amount_of_stock, CAST(amount AS DOUBLE) AS Total_Amount_USD, supplier AS Supplier_Code, cost AS Cost_per_part,
  CAST(most AS DOUBLE) AS Amount_needed_per_tool, ceids AS Applicable_CEIDs, types AS Applicable_Tool_Types, n AS Number_of_active_tools,
  coalesce(Count_Of_Tools_Age_0_to_1_Yr, 0) AS Count_Of_Tools_Age_0_to_1_Yr, coalesce(Count_Of_Tools_Age_1_to_3_Yr, 0) AS Count_Of_Tools_Age_1_to_3_Yr,
  coalesce(Count_Of_Tools_Age_3_to_5_Yr, 0) AS Count_Of_Tools_Age_3_to_5_Yr, coalesce(Count_Of_Tools_Age_5_Plus_Yr, 0) AS Count_Of_Tools_Age_5_Plus_Yr,
  coalesce(Count_Of_Tools_Age_Unknown, 0) AS Count_Of_Tools_Age_Unknown, flag AS Active_Installed_Flag, category AS Disposition_Category,
  confidence AS Confidence_Level FROM {board}""",
    "inventory_by_part": """
SELECT Part_Number, CAST(qty AS DOUBLE) AS Qty_Total, CAST(amount AS DOUBLE) AS Total_Amount_USD, supplier AS Supplier_Code, cost AS Cost_per_part FROM {stock}""",
    "gbom_max_qty": "SELECT Part_Number, CAST(most AS BIGINT) AS Amount_needed_per_tool FROM {lists}",
    "gbom_lists": "SELECT Part_Number, coalesce(ceids, '') AS Applicable_CEIDs, coalesce(types, '') AS Applicable_Tool_Types FROM {lists}",
    "part_tool_counts": "SELECT Part_Number, Number_of_active_tools FROM {counts}",
    "part_age_counts": "SELECT * EXCLUDE (Number_of_active_tools) FROM {counts}",
    "part_tool_counts_shared": """
SELECT Part_Number, count(DISTINCT Tool_ID) AS Number_of_active_tools,
  count(DISTINCT Tool_ID) FILTER (Age_Bucket = '0_1Y') AS Count_Of_Tools_Age_0_to_1_Yr,
  count(DISTINCT Tool_ID) FILTER (Age_Bucket = '1_3Y') AS Count_Of_Tools_Age_1_to_3_Yr,
  count(DISTINCT Tool_ID) FILTER (Age_Bucket = '3_5Y') AS Count_Of_Tools_Age_3_to_5_Yr,
  count(DISTINCT Tool_ID) FILTER (Age_Bucket = '5P_Y') AS Count_Of_Tools_Age_5_Plus_Yr,
  count(DISTINCT Tool_ID) FILTER (Age_Bucket = 'UnknownAge') AS Count_Of_Tools_Age_Unknown
FROM {used_shared} GROUP BY 1""",
    "disposition": """
SELECT Part_Number, flag AS Active_Installed_Flag, category AS Disposition_Category, confidence AS Confidence_Level FROM {board}""",
    "key_overlap": """
SELECT column_name, n_left, n_right, n_common, CAST(n_common = 0 AS VARCHAR) AS no_overlap FROM (
  SELECT 'Three_CEID' AS column_name, (SELECT count(DISTINCT Three_CEID) FROM {gbom}) AS n_left, (SELECT count(DISTINCT Three_CEID) FROM {tools}) AS n_right,
    (SELECT count(DISTINCT Three_CEID) FROM {gbom} WHERE Three_CEID IN (SELECT Three_CEID FROM {tools})) AS n_common
  UNION ALL SELECT 'Process_Node', (SELECT count(DISTINCT Process_Node) FROM {gbom}), (SELECT count(DISTINCT Process_Node) FROM {tools}),
    (SELECT count(DISTINCT Process_Node) FROM {gbom} WHERE Process_Node IN (SELECT Process_Node FROM {tools})))""",
    "bucket_consistency": "SELECT * FROM {offences}",
    "offending_tools": """
SELECT DISTINCT Tool_ID, Three_CEID, CAST(Process_Node AS DOUBLE) AS Process_Node, Warranty_Start, Age_Bucket FROM {aged_moved} t
WHERE active AND Tool_ID IN (SELECT Tool_ID FROM {offences} GROUP BY Tool_ID ORDER BY min(Part_Number), Tool_ID LIMIT 5)
  AND EXISTS (SELECT 1 FROM {gbom_shared} g WHERE g.Three_CEID IS NOT DISTINCT FROM t.Three_CEID AND g.Process_Node IS NOT DISTINCT FROM t.Process_Node)""",
    "acceptance_checks": """
SELECT check_name, value, bound, CAST(value <= bound AS VARCHAR) AS passed FROM (
  SELECT 'A' AS check_name, count(*) FILTER (contains(ENTITY, '_')) AS value, CAST(0 AS BIGINT) AS bound FROM {tools}
  UNION ALL SELECT 'B', (SELECT max(Active_Tool_Count_Config) FROM {mart}), (SELECT count(DISTINCT Tool_ID) FROM {tools})
  UNION ALL SELECT 'C', (SELECT max(n) FROM {board} WHERE Part_Number IN (SELECT Part_Number FROM {gbom} GROUP BY 1 HAVING count(*) > 1)),
    (SELECT count(DISTINCT Tool_ID) FROM {tools}))""",
    "acceptance_checks_entity": """
SELECT check_name, value, bound, CAST(value <= bound AS VARCHAR) AS passed FROM (
  SELECT 'A' AS check_name, count(*) FILTER (contains(ENTITY, '_')) AS value, CAST(0 AS BIGINT) AS bound FROM {tools}
  UNION ALL SELECT 'B', (SELECT max(Active_Tool_Count_Config) FROM {mart}), (SELECT count(DISTINCT ENTITY) FROM {tools})
  UNION ALL SELECT 'C', (SELECT max(n) FROM {board} WHERE Part_Number IN (SELECT Part_Number FROM {gbom} GROUP BY 1 HAVING count(*) > 1)),
    (SELECT count(DISTINCT ENTITY) FROM {tools}))""",
    "tool_profile": """
SELECT count(*) AS n_rows, count(*) FILTER (age_days IS NULL) AS n_null_warranty, CAST(min(start) AS VARCHAR) AS min_warranty,
  CAST(max(start) AS VARCHAR) AS max_warranty, min(age_days) / CAST(365.25 AS DOUBLE) AS min_age_years,
  max(age_days) / CAST(365.25 AS DOUBLE) AS max_age_years, count(*) FILTER (active) AS n_active, count(*) FILTER (NOT active) AS n_inactive FROM {tools}""",
    "age_distribution": "SELECT Age_Bucket, count(*) AS n_all, count(*) FILTER (active) AS n_active FROM {aged} GROUP BY 1",
    "value_counts": """
SELECT install_sts, count(*) AS n_rows FROM {fx_tools} WHERE install_sts IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
    "distinct_sample": "SELECT DISTINCT Three_CEID FROM {fx_gbom} WHERE Three_CEID IS NOT NULL ORDER BY 1 LIMIT 10",
    "distinct_count": "SELECT count(DISTINCT ENTITY) AS n_tools FROM {fx_tools}",
}


def _with_blocks(text: str) -> str:
    """Put the blocks and views a query uses in front of it, each once, in order of dependence."""
    ready: dict[str, str] = {}

    def names(part: str) -> list[str]:
        return [piece.split("}")[0] for piece in part.split("{")[1:]]

    def add(name: str) -> None:
        if name in ready:
            return
        body = view_sql(name) if name.startswith("fx_") else _BLOCKS[name]
        if not name.startswith("fx_"):
            for other in names(body):
                add(other)
        ready[name] = body if name.startswith("fx_") else _plain(body)

    for name in names(text):
        add(name)
    if not ready:
        return text.strip()
    parts = ",\n".join(f"{name} AS MATERIALIZED ({body.strip()})" for name, body in ready.items())
    return f"WITH {parts}\n{_plain(text).strip()}"


def _plain(text: str) -> str:
    return text.replace("{", "").replace("}", "")


def oracle_sql() -> dict[str, str]:
    return {name: _with_blocks(text) for name, text in _QUERIES.items()}
