"""Data-quality checks: each returns the failing rows, and a check passes when there are none."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millpulse.functions.rules import RISK_LEVELS


def dq_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def dq_unique(df: DataFrame, *columns: str) -> DataFrame:
    """Keys that occur more than once, and how often. NULL keys are left to the not-null check."""
    known = df.na.drop(subset=list(columns))
    return known.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")


def dq_accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list, and how often each occurs."""
    return (
        df.filter(~F.col(column).isin(*values)).groupBy(F.col(column).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def dq_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.filter((F.col(column) < low) | (F.col(column) > high))


def dq_not_all_unknown(health: DataFrame) -> DataFrame:
    """One row when there are rows but no status is known."""
    return health.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("current_status") != "UNKNOWN").alias("known_rows"),
    ).filter("total_rows > 0 and known_rows = 0")


@dataclass(frozen=True)
class Rule:
    """A check on one column: not_null, unique, accepted_values, range or not_all."""

    check: str
    table: str
    column: str
    values: tuple = ()

    def failures(self) -> Column:
        """Failing rows of every kind of check but `unique`, as one aggregate."""
        column = F.col(self.column)
        if self.check == "not_null":
            return F.count_if(column.isNull())
        if self.check == "accepted_values":
            return F.count_if(~column.isin(*self.values))
        if self.check == "range":
            low, high = self.values
            return F.count_if((column < low) | (column > high))
        if self.check == "not_all":
            rows, others = F.count(F.lit(1)), F.count_if(column != self.values[0])
            return F.when((rows > 0) & (others == 0), F.lit(1)).otherwise(F.lit(0)).cast("long")
        raise ValueError(f"unknown check {self.check}")


MODEL_RULES = (
    Rule("not_null", "stg_sensor_data", "event_ts"),
    Rule("not_null", "stg_sensor_data", "machine_id"),
    Rule("not_null", "stg_machine_status", "machine_id"),
    Rule("not_null", "stg_machine_status", "status"),
    Rule("not_null", "stg_work_orders", "order_id"),
    Rule("unique", "stg_work_orders", "order_id"),
    Rule("not_null", "stg_work_orders", "machine_id"),
    Rule("not_null", "machine_health_hourly", "hour_ts"),
    Rule("not_null", "machine_health_hourly", "machine_id"),
    Rule("not_all", "machine_health_hourly", "current_status", ("UNKNOWN",)),
    Rule("not_null", "work_orders_status", "order_day"),
    Rule("not_null", "work_orders_status", "machine_id"),
    Rule("not_null", "machine_risk_hourly", "hour_ts"),
    Rule("not_null", "machine_risk_hourly", "machine_id"),
    Rule("not_null", "machine_risk_hourly", "machine_risk_score"),
    Rule("range", "machine_risk_hourly", "machine_risk_score", (0, 100)),
    Rule("not_null", "machine_risk_hourly", "machine_risk_level"),
    Rule("accepted_values", "machine_risk_hourly", "machine_risk_level", RISK_LEVELS),
)


def run_checks(tables: Mapping[str, DataFrame], rules: Sequence[Rule] = MODEL_RULES) -> DataFrame:
    """(check_name, table_name, column_name, failures) per rule.

    All simple rules of a table share one pass over it; only `unique` groups by its column.
    """
    parts = []
    for table in dict.fromkeys(rule.table for rule in rules):
        df = tables[table]
        simple = [rule for rule in rules if rule.table == table and rule.check != "unique"]
        if simple:
            wide = df.agg(*[rule.failures().alias(f"f{i}") for i, rule in enumerate(simple)])
            entries = [_entry(rule, F.col(f"f{i}")) for i, rule in enumerate(simple)]
            parts.append(wide.select(F.inline(F.array(*entries))))
        for rule in rules:
            if rule.table == table and rule.check == "unique":
                failing = dq_unique(df, rule.column).agg(F.count(F.lit(1)).alias("n"))
                parts.append(failing.select(F.inline(F.array(_entry(rule, F.col("n"))))))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _entry(rule: Rule, failures: Column) -> Column:
    return F.struct(
        F.lit(rule.check).alias("check_name"),
        F.lit(rule.table).alias("table_name"),
        F.lit(rule.column).alias("column_name"),
        failures.alias("failures"),
    )
