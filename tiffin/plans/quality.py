"""The six quality checks: which rules, and what happens when one is broken (Q1-Q6)."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tiffin import settings
from tiffin.operators.rules import RuleSet, not_null, sql_list
from tiffin.sinks.tables import TableStore

log = logging.getLogger(__name__)

# Names of the rules, their columns and bounds.
ORDERS = RuleSet(
    {
        **not_null("customer_id", "order_id"),
        "invalid_delivery_delay": "delivery_delay < 0 OR delivery_delay > 300",
        "invalid_status": f"status NOT IN {sql_list([settings.ON_TIME, settings.LATE])}",
    },
    unique_key="order_id",
)
COMPLAINTS = RuleSet(
    {
        **not_null("complaint_id", "order_id", "complaint_type"),
        "invalid_complaint_type": f"complaint_type NOT IN {sql_list(settings.COMPLAINT_TYPES)}",
    },
    unique_key="complaint_id",
)
WEATHER = RuleSet(
    {
        **not_null(
            "order_id",
            "order_time",
            "region",
            "temperature",
            "precipitation",
            "wind_speed",
            "weather_condition",
        ),
        "invalid_temperature": "temperature < -50 OR temperature > 60",
        "invalid_precipitation": "precipitation < 0",
        "invalid_wind_speed": "wind_speed < 0 OR wind_speed > 300",
    }
)
DELIVERIES = RuleSet(
    not_null(
        "order_id", "customer_id", "store_id", "order_time", "delay_category", "ingestion_time"
    )
)
ORDER_STATUS = RuleSet(
    not_null("order_id", "status", "effective_time", "ingestion_time", "is_current")
)
DIM_TIME = RuleSet(
    not_null("date", "day_of_week", "is_weekend", "is_holiday", "is_short_friday")
)


def weather_kinds() -> dict[str, Column]:
    """One value for all measures of which the rules of WEATHER make the same, for `silver.observation_counts`."""

    def kind(name: str, low: float | None = None, high: float | None = None) -> Column:
        value = F.col(name)
        inside = F.when(value.isNotNull(), F.lit(0.0))
        above = inside if high is None else F.when(value > high, high + 1).otherwise(inside)
        return above if low is None else F.when(value < low, low - 1).otherwise(above)

    return {
        "temperature": kind("temperature", -50.0, 60.0),
        "precipitation": kind("precipitation", 0.0),
        "wind_speed": kind("wind_speed", 0.0, 300.0),
        "weather_condition": F.when(F.col("weather_condition").isNotNull(), F.lit("")),
    }


class QualityError(RuntimeError):
    """A check that must hold does not; `report` has the violations per rule."""

    def __init__(self, table: str, report: dict[str, int]):
        super().__init__(f"quality check of {table} failed: {report}")
        self.table = table
        self.report = report


@dataclass(frozen=True)
class Check:
    """`save` is `issues` or `valid`: the rows written when a rule is broken."""

    table: str
    rules: RuleSet
    fails: bool
    save: str | None = None
    needs_valid_rows: bool = False

    @property
    def target(self) -> str:
        return f"{self.table}_quality_issues" if self.save == "issues" else f"{self.table}_valid"


# In the order they run: deliveries last, as they build on the others.
CHECKS = {
    "orders": Check("silver_orders_clean", ORDERS, fails=True, save="issues"),
    "complaints": Check(
        "silver_complaints_clean", COMPLAINTS, fails=False, save="valid", needs_valid_rows=True
    ),
    "weather": Check("silver_weather_enriched", WEATHER, fails=False, save="valid"),
    "dim_time": Check("silver_dim_time", DIM_TIME, fails=True),
    "order_status": Check("silver_order_status_scd2", ORDER_STATUS, fails=False, save="valid"),
    "deliveries": Check("silver_deliveries_enriched", DELIVERIES, fails=True),
}


def run_check(
    store: TableStore, check: Check, mode: str = "append", preview: int = 0
) -> dict[str, int]:
    """Run one check on a stored table; returns the violations per rule (one row each).

    Raises QualityError after writing the offending rows where the check is one that fails.
    """
    df = store.read(check.table)
    if preview:
        log.info("%s: %s", check.table, df.schema.simpleString())
        df.show(preview)
    report = {row["rule"]: row["violations"] for row in check.rules.report(df).collect()}
    log.info("%s: %s", check.table, report)
    if not any(report.values()):
        return report
    if check.save == "issues":
        rows = check.rules.issues(df)
    else:
        rows = check.rules.valid(df)
    if check.needs_valid_rows and rows.isEmpty():
        raise QualityError(check.table, report)
    if check.save is not None:
        if mode == "append":
            store.create_or_append(rows, check.target, strict=True)
        else:
            store.write(rows, check.target, mode)
    if check.fails:
        raise QualityError(check.table, report)
    return report


def run_checks(
    store: TableStore, mode: str = "append", preview: int = 0
) -> dict[str, dict[str, int]]:
    """All checks in order; the first one that fails stops the run."""
    return {name: run_check(store, check, mode, preview) for name, check in CHECKS.items()}
