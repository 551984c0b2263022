"""One load cycle: extract the plant tables, then load them, then load the sensor files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from millpulse import schemas
from millpulse.sources.incremental import incremental_load, read_loaded
from millpulse.sources.raw import LANDED_SENSOR_FILES
from millpulse.sources.tables import extract_table_to_csv


@dataclass(frozen=True)
class IngestPaths:
    landed_sensor: str
    exports: str
    raw: str
    checkpoints: str


def run_ingest(spark: SparkSession, sources: dict[str, DataFrame], paths: IngestPaths, run: str) -> dict[str, DataFrame]:
    """`sources` holds the plant tables `work_orders` and `machine_status`; `run` names this cycle."""
    for name in ("work_orders", "machine_status"):
        raw_name = f"{name}_raw"
        columns = schemas.SOURCE_TABLES[name].fieldNames()
        extract_table_to_csv(sources[name], name, columns, paths.exports, run)
        _load(spark, f"{paths.exports}/{name}_*.csv", raw_name, paths, "csv")
    _load(spark, f"{paths.landed_sensor}/{LANDED_SENSOR_FILES}", "sensor_data_raw", paths, "json")
    return {name: read_loaded(spark, f"{paths.raw}/{name}", schema) for name, schema in schemas.RAW_TABLES.items()}


def _load(spark: SparkSession, files: str, table: str, paths: IngestPaths, fmt: str) -> None:
    schema = schemas.RAW_TABLES[table]
    incremental_load(spark, files, schema, f"{paths.raw}/{table}", f"{paths.checkpoints}/{table}", fmt)
