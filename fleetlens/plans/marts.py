"""The installed-base job: curated tables in, three marts out."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from fleetlens.operators.installed_base import config_mart, drilldown, leadership
from fleetlens.operators.quality import acceptance_checks
from fleetlens.sources.tables import publish, read_curated, read_table, recover, write_table

INPUTS = ("cur_inventory", "cur_auto_tool_list_mom", "cur_gbom_applicability")
MARTS = (
    "mart_installed_base_by_config", "mart_inventory_installed_base_drilldown", "mart_inventory_installed_base_leadership",
)


def run_installed_base(
    spark: SparkSession,
    inputs: Mapping[str, str | DataFrame],
    store: str,
    asof: dt.date,
    supplier_order: Sequence[str] | None = None,
    bound_by: str = "tool_id",
) -> dict[str, DataFrame]:
    """Build the marts, check them, and replace the stored ones; fails without replacing any if a check does.

    Each mart is computed once, into a staging folder; the checks read what is staged.  Then the folders change places, all
    of them or, after a crash, all of them by the next run.
    """
    recover(spark, store)
    tables = read_curated(spark, {name: inputs[name] for name in INPUTS})
    inventory, tools, gbom = (tables[name] for name in INPUTS)

    def staged(name: str, df: DataFrame) -> DataFrame:
        write_table(df, f"{store}/_staged/{name}", "replace")
        return read_table(spark, f"{store}/_staged/{name}")

    by_config = staged("mart_installed_base_by_config", config_mart(tools, asof))
    by_part = staged("mart_inventory_installed_base_leadership", leadership(gbom, tools, inventory, asof, supplier_order))
    checks = acceptance_checks(tools, by_config, by_part, gbom, bound_by)
    failed = [row.check_name for row in checks.collect() if not row.passed]
    if failed:
        raise ValueError(f"acceptance checks failed: {', '.join(sorted(failed))}")
    staged("mart_inventory_installed_base_drilldown", drilldown(gbom, by_config, inventory))
    publish(spark, store, MARTS)
    return {name: read_table(spark, f"{store}/{name}") for name in MARTS}
