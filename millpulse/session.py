"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "millpulse", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC timestamps and adaptive execution; anything else is the cluster's choice."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Streams run the same plans batch after batch; the default of 100 compiled classes is less than one batch needs.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """All hours and days are UTC; raw timestamps are stored without a zone."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def require_utc(spark: SparkSession) -> SparkSession:
    """Loads turn offsets into times through the session's zone, so any other zone would store other hours."""
    if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "Z", "+00:00"):
        raise ValueError("set spark.sql.session.timeZone to UTC before loading")
    return spark


def accept_repeated_keys(spark: SparkSession) -> SparkSession:
    """Let JSON objects repeat a key; the last value counts. Otherwise such a text would be no JSON at all."""
    if spark.conf.get("spark.sql.variant.allowDuplicateKeys") != "true":
        spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run below the cluster's checkpoint folder.

    A machine-local folder is made only for a local session that names none.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="millpulse-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
