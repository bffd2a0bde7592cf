"""Business rules as expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from fleetlens import params


def state_name(state: Column) -> Column:
    """The state without white space around it."""
    return F.btrim(state, F.lit(" \t\n\r\x0b\x0c"))


def classify_state(
    state: Column,
    running: Sequence[str] = params.RUNNING_STATES,
    idle: Sequence[str] = params.IDLE_STATES,
    bagged: str = params.BAGGED_STATE,
) -> Column:
    """``Bagged``, ``Running``, ``Idle`` or, for everything else and for null, ``Down``."""
    name = state_name(state)
    return (
        F.when(name == bagged, "Bagged")
        .when(name.isin(*running), "Running")
        .when(name.isin(*idle), "Idle")
        .otherwise("Down")
    )


def safe_rate(numerator: Column, denominator: Column, otherwise: float | None = None) -> Column:
    """``numerator / denominator`` as a double where the denominator is positive."""
    rate = F.when(denominator > 0, numerator.cast("double") / denominator.cast("double"))
    return rate if otherwise is None else rate.otherwise(F.lit(float(otherwise)))


def cost_per_part(amount: Column, quantity: Column) -> Column:
    """``amount / quantity`` as a double, null when there is no quantity."""
    return amount.cast("double") / F.nullif(quantity.cast("double"), F.lit(0.0))


def is_active(status: Column, inactive: Sequence[str] = params.INACTIVE_STATUSES) -> Column:
    """True unless the status is one of ``inactive``; an unknown status counts as active."""
    return F.coalesce(~status.isin(*inactive), F.lit(True))


def estimated_parts(tools: Column, per_tool: Column) -> Column:
    """Parts needed to equip ``tools`` tools."""
    return tools * per_tool


def installed_flag(active_tools: Column) -> Column:
    """``Y`` if any active tool uses the part."""
    return F.when(active_tools > 0, "Y").otherwise("N")


def disposition(in_gbom: Column, active_tools: Column) -> Column:
    """Struct of the advised ``Disposition_Category`` and its ``Confidence_Level``."""

    def advice(category: str, confidence: str) -> Column:
        return F.struct(F.lit(category).alias("Disposition_Category"), F.lit(confidence).alias("Confidence_Level"))

    return (
        F.when(~in_gbom, advice("Divest/Scrap", "Low"))
        .when(active_tools > 0, advice("Sell", "High"))
        .otherwise(advice("Investigate", "Medium"))
    )
