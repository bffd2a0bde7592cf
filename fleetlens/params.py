"""Business parameters.  Every operator takes them as keyword arguments with these defaults."""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------------------------

# Counter columns are picked by keyword, in this order; all of them must end with COUNTER_SUFFIX.
PRIMARY_KEYWORDS = ("Focus",)
FALLBACK_KEYWORDS = ("APCCounter", "ESCCounter", "PMACounter")
COUNTER_SUFFIX = "Counter"
# A counter that falls by more than this was reset because the part was replaced.
REPLACEMENT_THRESHOLD = -1000

RUNNING_STATES = (
    "Running1", "Running2", "Running3", "Running4",
    "Running5", "Running6", "Running7", "Running8",
)
IDLE_STATES = ("UpToProduction",)
BAGGED_STATE = "Bagged"

ENTITY_PATTERN = "_PC"
ENTITY_REPLACEMENT = "_PM"

STATE_FILE_NAME = "EntityStates.csv"
COUNTER_FILE_PREFIX = "Counters_"
STATE_COLUMNS = (
    "FAB", "WW", "DAY_SHIFT", "ENTITY_STATE", "ENTITY", "HOURS_IN_STATE", "Total_Hours", "% in State",
)
STATE_REQUIRED = ("FAB", "ENTITY", "ENTITY_STATE", "HOURS_IN_STATE")
COUNTER_REQUIRED = ("ENTITY",)
COUNTER_DATE_SHIFT_DAYS = -1

WEEKS_TO_LOAD = 4
LOOKBACK_DAYS = 7
RETENTION_DAYS = {
    "entity_states_raw": 90,
    "counters_raw": 90,
    "state_hours": 180,
    "wafer_production": 180,
    "part_replacements": 365,
    "fact_daily_production": 365,
    "fact_weekly_production": 365,
    "fact_state_hours_daily": 365,
    "fact_state_hours_weekly": 365,
}

INACTIVE_STATUSES = ("Bagged", "Not Installed")
# Age buckets of installed tools: label -> output column.
AGE_COLUMNS = {
    "0_1Y": "Count_Of_Tools_Age_0_to_1_Yr",
    "1_3Y": "Count_Of_Tools_Age_1_to_3_Yr",
    "3_5Y": "Count_Of_Tools_Age_3_to_5_Yr",
    "5P_Y": "Count_Of_Tools_Age_5_Plus_Yr",
    "UnknownAge": "Count_Of_Tools_Age_Unknown",
}
DAYS_PER_YEAR = 365.25

# Cell texts the CSV reader treats as missing.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Natural keys: at most one row per key in each table.
NATURAL_KEYS = {
    "entity_states_raw": ("FAB_ENTITY", "DAY_SHIFT", "ENTITY_STATE"),
    "counters_raw": ("FAB_ENTITY", "counter_date"),
    "state_hours": ("ENTITY", "state_date"),
    "wafer_production": ("ENTITY", "counter_date"),
    "part_replacements": ("ENTITY", "replacement_date", "part_counter_name"),
    "fact_daily_production": ("ENTITY", "production_date"),
    "fact_weekly_production": ("ENTITY", "YEARWW"),
    "fact_state_hours_daily": ("ENTITY", "state_date"),
    "fact_state_hours_weekly": ("ENTITY", "YEARWW"),
}

# Columns that must not be null.
REQUIRED_COLUMNS = {
    "entity_states_raw": ("FAB", "DAY_SHIFT", "ENTITY_STATE", "ENTITY", "FAB_ENTITY"),
    "counters_raw": ("ENTITY", "FAB", "FAB_ENTITY", "counter_date"),
    "state_hours": ("ENTITY", "FAB", "FAB_ENTITY", "state_date"),
    "wafer_production": ("ENTITY", "counter_date"),
    "part_replacements": ("ENTITY", "replacement_date", "part_counter_name"),
    "fact_daily_production": ("ENTITY", "FAB", "FAB_ENTITY", "production_date"),
    "fact_weekly_production": ("ENTITY", "FAB", "FAB_ENTITY", "YEARWW"),
    "fact_state_hours_daily": ("ENTITY", "FAB", "FAB_ENTITY", "state_date"),
    "fact_state_hours_weekly": ("ENTITY", "FAB", "FAB_ENTITY", "YEARWW"),
}
# --- end of fixed values ------------------------------------------------------------------------

HOURS = "decimal(10,2)"
PERCENT = "decimal(10,4)"
COUNTER = "decimal(18,2)"
