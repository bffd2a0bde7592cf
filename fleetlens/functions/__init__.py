"""Scalar functions: Column in, Column out, all built from Spark SQL expressions."""

from fleetlens.functions.counters import (
    Candidates,
    calculation_notes,
    counter_change,
    is_replacement,
    number_text,
    pick_counter,
    reading_at,
)
from fleetlens.functions.dates import (
    age_bucket,
    counter_date,
    fiscal_work_week,
    iso_yearww,
    parse_day_shift,
    tool_age_days,
    utc_literal,
    utc_time,
    warranty_start,
)
from fleetlens.functions.rules import (
    classify_state,
    cost_per_part,
    disposition,
    estimated_parts,
    installed_flag,
    is_active,
    safe_rate,
    state_name,
)
from fleetlens.functions.text import derive_fab, fab_entity_key, normalize_entity, to_int, tool_id

__all__ = [
    "Candidates", "age_bucket", "calculation_notes", "classify_state", "cost_per_part",
    "counter_change", "counter_date", "derive_fab", "disposition", "estimated_parts",
    "fab_entity_key", "fiscal_work_week", "installed_flag", "is_active", "is_replacement",
    "iso_yearww", "normalize_entity", "number_text", "parse_day_shift", "pick_counter",
    "reading_at", "safe_rate", "state_name", "to_int", "tool_age_days", "tool_id", "utc_literal", "utc_time",
    "warranty_start",
]
