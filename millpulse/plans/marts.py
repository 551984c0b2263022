"""The model graph: raw tables to staging views to marts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from millpulse.operators.health import HEALTH_COLUMNS, hourly_readings, machine_health_hourly, machine_risk_hourly
from millpulse.operators.orders import work_orders_status
from millpulse.operators.staging import stg_machine_status, stg_sensor_data, stg_work_orders
from millpulse.operators.status import attach_current_status, latest_status
from millpulse.sources.tables import save_table


def build_models(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All models as lazy frames over `sensor_data_raw`, `machine_status_raw` and `work_orders_raw`."""
    sensor = stg_sensor_data(raw["sensor_data_raw"])
    status = stg_machine_status(raw["machine_status_raw"])
    orders = stg_work_orders(raw["work_orders_raw"])
    health = machine_health_hourly(sensor, status)
    return {
        "stg_sensor_data": sensor,
        "stg_machine_status": status,
        "stg_work_orders": orders,
        "machine_health_hourly": health,
        "machine_risk_hourly": machine_risk_hourly(health),
        "work_orders_status": work_orders_status(orders),
    }


def write_marts(raw: Mapping[str, DataFrame], out: str) -> dict[str, DataFrame]:
    """Store the marts, reading the raw sensor rows once.

    Health and risk both start from the stored hourly readings instead of the raw rows.
    """
    return _write_marts(
        stg_sensor_data(raw["sensor_data_raw"]), stg_machine_status(raw["machine_status_raw"]),
        stg_work_orders(raw["work_orders_raw"]), out,
    )


def store_models(raw: Mapping[str, DataFrame], out: str) -> dict[str, DataFrame]:
    """All models, for steps that read them several times.

    The cleaned statuses, the orders left by the de-duplication and the marts are stored; the cleaned readings stay a
    view over the raw rows, which are so read once for the marts and once more by whoever asks for them.
    """
    sensor = stg_sensor_data(raw["sensor_data_raw"])
    status = save_table(stg_machine_status(raw["machine_status_raw"]), f"{out}/stg_machine_status")
    orders = save_table(stg_work_orders(raw["work_orders_raw"]), f"{out}/stg_work_orders")
    staged = {"stg_sensor_data": sensor, "stg_machine_status": status, "stg_work_orders": orders}
    return staged | _write_marts(sensor, status, orders, out)


def _write_marts(sensor: DataFrame, status: DataFrame, orders: DataFrame, out: str) -> dict[str, DataFrame]:
    hourly = save_table(hourly_readings(sensor), f"{out}/hourly_readings")
    health = save_table(
        attach_current_status(hourly, latest_status(status)).select(HEALTH_COLUMNS), f"{out}/machine_health_hourly", "hour_ts"
    ).drop("day")
    risk = save_table(machine_risk_hourly(health), f"{out}/machine_risk_hourly", "hour_ts").drop("day")
    daily = save_table(work_orders_status(orders), f"{out}/work_orders_status")
    return {"machine_health_hourly": health, "machine_risk_hourly": risk, "work_orders_status": daily}
