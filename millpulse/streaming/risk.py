"""Machine risk kept current from a stream, without going back over the history.

Kept per machine, in buckets (see `buckets`): the rolling features of each hour, the sums of the last three hours, the statuses
it matches, and the upper tail of the hourly averages for the 95th percentile. A batch that only brings new hours opens the
machine rows of its buckets and nothing else: three hours are all that three-row features look back on, and the percentile
lies in the tail.

Three things do open the stored hours, of the buckets concerned and no others: a reading for an hour before a machine's
last one, a machine whose matching statuses have changed, and a percentile that has sunk below the tail. The tail starts as all
averages; what lies far below the percentile is later cut off and only counted. Cutting keeps TAIL of a machine's averages, so the
percentile can sink below it only after most of the later averages were low.

The score needs the percentile of now for every hour of a machine, so it is worked out when the risk is read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from millpulse.functions import rules
from millpulse.operators.health import rolling_features, score_risk
from millpulse.operators.status import expand_copies, latest_status, status_matches
from millpulse.sources.storage import remove
from millpulse.streaming.buckets import BUCKETS, MERGE_EVERY, BucketStore, Kept, newest, union

SUMS = ("temperature_sum", "temperature_n", "vibration_sum", "vibration_n", "anomaly_events", "total_events")
MEASURES = ("temperature", "vibration")
P95 = {"temperature": "machine_temp_p95", "vibration": "machine_vibration_p95"}
CARRIED = 3  # hours: an update of the last one looks back on two more
TAIL = 0.15  # share of the averages kept when the tail is cut
CUT_ABOVE, CUT_FROM = 0.3, 100  # cut a tail that holds more than this share of at least so many averages

_SUM_SCHEMA = "temperature_sum double, temperature_n long, vibration_sum double, vibration_n long, anomaly_events long, total_events long"
_TAIL_SCHEMA = "array<struct<value: double, n: bigint>>"
_MATCHES = "array<struct<status: string, copies: bigint>>"
TABLES = {
    "features": Kept(
        "machine_id string, hour_ts timestamp_ntz, current_status string, avg_temperature double, avg_vibration double, "
        f"{_SUM_SCHEMA}, rolling_mean_temp_3h double, rolling_std_temp_3h double, rolling_mean_vibration_3h double, "
        "rolling_std_vibration_3h double, temp_rate_of_change double, vibration_rate_of_change double, anomaly_rate_3h double",
        "machine_id", newest("machine_id", "hour_ts"),
    ),
    "machines": Kept(
        "machine_id string, last_hours array<struct<hour_ts: timestamp_ntz, temperature_sum: double, temperature_n: bigint, "
        f"vibration_sum: double, vibration_n: bigint, anomaly_events: bigint, total_events: bigint>>, matches {_MATCHES}, "
        + ", ".join(f"{m}_cut double, {m}_tail {_TAIL_SCHEMA}, {P95[m]} double" for m in MEASURES),
        "machine_id", newest("machine_id"),
    ),
}


def hourly_partials(readings: DataFrame) -> DataFrame:
    """Sums and counts per machine and hour that can be added up across batches."""
    return readings.groupBy(rules.hour_of(F.col("event_ts")).alias("hour_ts"), "machine_id").agg(
        F.sum("temperature").alias("temperature_sum"), F.count("temperature").alias("temperature_n"),
        F.sum("vibration").alias("vibration_sum"), F.count("vibration").alias("vibration_n"),
        F.sum(rules.anomaly_expr(F.col("temperature"), F.col("vibration"))).cast("long").alias("anomaly_events"),
        F.count(F.lit(1)).alias("total_events"),
    )


def mart_refresher(
    path: str, status: DataFrame | Callable[[], DataFrame], every: int = MERGE_EVERY, buckets: int = BUCKETS
) -> Callable[[DataFrame, int], None]:
    """A batch function that keeps the risk of the machines in the batch, and of those whose status has changed.

    `status` is the cleaned status history, or a function that reads it anew for each batch. A batch may be repeated.
    """

    def refresh(batch: DataFrame, batch_id: int) -> None:
        store = BucketStore(batch.sparkSession, path, TABLES, buckets, every, batch_id)
        with _Held() as held:
            partials = held(hourly_partials(batch).repartition("machine_id"))
            statuses, changed, facts = _statuses(store, latest_status(status() if callable(status) else status))
            changed = held(changed) if changed is not None else None
            concerned = partials.select("machine_id")
            if changed is not None:
                concerned = concerned.unionByName(changed.select("machine_id"))
            touched = store.touched(concerned, "machine_id")
            before = held(store.read("machines", touched).join(concerned.distinct(), "machine_id", "left_semi"))
            machines, late = _concerned(store, partials, before, statuses, changed)
            machines = held(machines)
            hours = held(_hours(store, partials, before, machines, late))
            store.put("features", _features(hours, machines), touched)
            lost = Observation()
            rows = _machine_rows(hours, before, machines)
            store.put("machines", rows.observe(lost, F.count_if("_below_tail").alias("n")), touched)
            if lost.get["n"]:
                rows = held(rows)
                gone = store.touched(rows.where("_below_tail"), "machine_id")
                store.put("machines", _with_whole_tails(rows, store.read("features", gone)), touched)
            store.commit(**facts)

    return refresh


class _Held:
    """Frames kept for one batch, because several steps read them."""

    def __enter__(self) -> _Held:
        self.frames: list[DataFrame] = []
        return self

    def __call__(self, rows: DataFrame) -> DataFrame:
        self.frames.append(rows.persist())
        return rows

    def __exit__(self, *_: object) -> None:
        for rows in self.frames:
            rows.unpersist()


def read_risk(spark: SparkSession, path: str, buckets: list[int] | None = None) -> DataFrame:
    """The risk rows as of the last batch, of all buckets or the named ones."""
    store = BucketStore(spark, path, TABLES)
    machines = store.read("machines", buckets).select("machine_id", *P95.values())
    return score_risk(store.read("features", buckets).join(machines, "machine_id"))


def _statuses(store: BucketStore, latest: DataFrame) -> tuple[DataFrame, DataFrame | None, dict]:
    """The stored statuses, the known machines that now match others with their matches (None: none do), and facts to remember.

    The statuses are stored only when they differ from those stored before, which two sums over their hashes tell.
    """
    spark, row_hash = store.spark, F.xxhash64("machine_key", "machine_num", "status")
    sums = latest.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(row_hash).alias("x"), F.sum(row_hash.cast("decimal(38,0)")).alias("s")).first()
    now, before = [str(value) for value in sums], store.facts.get("status_print")

    def folder(batch_id: int) -> str:
        return f"{store.path}/status/batch={batch_id}"

    if now == before:
        return spark.read.parquet(folder(store.facts["status_batch"])), None, {}
    latest.write.mode("overwrite").parquet(folder(store.batch_id))
    statuses = spark.read.parquet(folder(store.batch_id))
    facts = {"status_print": now, "status_batch": store.batch_id, "status_batch_before": store.facts.get("status_batch")}
    if store.facts.get("status_batch_before") is not None:
        remove(spark, folder(store.facts["status_batch_before"]))
    if before is None:
        return statuses, None, facts
    known = store.read("machines").select("machine_id", F.col("matches").alias("_old"))
    changed = _matches(known, statuses).where(~F.col("_old").eqNullSafe(F.col("matches"))).drop("_old")
    return statuses, changed, facts


def _matches(machines: DataFrame, statuses: DataFrame) -> DataFrame:
    """Add the statuses that each machine matches and how often, in order; an empty list for none."""
    found = status_matches(machines, statuses).groupBy("machine_id").agg(F.sort_array(F.collect_list(F.struct("status", "copies"))).alias("matches"))
    return machines.join(found, "machine_id", "left").withColumn("matches", F.coalesce("matches", F.array().cast(_MATCHES)))


def _concerned(
    store: BucketStore, partials: DataFrame, before: DataFrame, statuses: DataFrame, changed: DataFrame | None
) -> tuple[DataFrame, list[int]]:
    """A row per machine of the batch or with other statuses, and the buckets whose stored hours must be opened.

    `_opened` machines need their stored hours, for a late reading or, with `_all`, to work out every hour anew.
    """
    last = F.array_max(F.transform("last_hours", lambda h: h["hour_ts"]))
    known = before.select("machine_id", "matches", *[f"{m}_cut" for m in MEASURES], last.alias("_last"))
    arrived = partials.groupBy("machine_id").agg(F.min("hour_ts").alias("_first"))
    machines = known.join(arrived, "machine_id", "full").withColumn("_all", F.lit(False))
    if changed is not None:
        other = changed.select("machine_id", F.col("matches").alias("_now"))
        machines = machines.join(other, "machine_id", "left").withColumn("_all", F.col("_now").isNotNull())
        machines = machines.withColumn("matches", F.coalesce("_now", "matches")).drop("_now")
    machines = machines.withColumn("_opened", F.col("_all") | F.coalesce(F.col("_first") < F.col("_last"), F.lit(False)))
    kinds = machines.select(F.when(F.col("_opened"), store.bucket("machine_id")).alias("open"), F.col("matches").isNull().alias("new")).distinct().collect()
    if any(kind.new for kind in kinds):
        new = _matches(machines.where("matches is null").drop("matches"), statuses)
        machines = machines.where("matches is not null").unionByName(new)
    return machines, sorted({kind.open for kind in kinds if kind.open is not None})


def _hours(store: BucketStore, partials: DataFrame, before: DataFrame, machines: DataFrame, opened: list[int]) -> DataFrame:
    """The hours to work out, with those that their features look back on.

    `_affected` hours are new, or look back on one that is. `_known` sums are those from before the batch.
    """
    known = before.select("machine_id", F.inline("last_hours")).withColumn("_all", F.lit(False))
    if opened:
        late = machines.where("_opened").select("machine_id", "_all")
        stored = store.read("features", opened).join(late, "machine_id").select(*known.columns)
        # An hour that matches several statuses has a row for each.
        stored = stored.dropDuplicates(["machine_id", "hour_ts"])
        known = known.join(late, "machine_id", "left_anti").unionByName(stored)
    rows = known.withColumn("_new", F.lit(False)).unionByName(partials.withColumns({"_all": F.lit(False), "_new": F.lit(True)}))
    hours = rows.repartition("machine_id").groupBy("machine_id", "hour_ts").agg(
        *[F.sum(c).alias(c) for c in SUMS], *[F.sum(F.when(~F.col("_new"), F.col(c))).alias(f"_known_{c}") for c in SUMS[:4]],
        F.max("_new").alias("_new"), F.max("_all").alias("_all"),
    )
    lookback = Window.partitionBy("machine_id").orderBy("hour_ts").rowsBetween(-2, 0)
    return hours.withColumn("_affected", F.col("_all") | F.max("_new").over(lookback))


def _average(measure: str, prefix: str = "") -> Column:
    return F.try_divide(F.col(f"{prefix}{measure}_sum"), F.col(f"{prefix}{measure}_n"))


def _features(hours: DataFrame, machines: DataFrame) -> DataFrame:
    """Feature rows of the affected hours, one for each status row that the machine matches."""
    averaged = hours.withColumns({f"avg_{m}": _average(m) for m in MEASURES}).join(machines.select("machine_id", "matches"), "machine_id")
    unknown = F.array(F.struct(F.lit("UNKNOWN").alias("status"), F.lit(1).cast("long").alias("copies")))
    matched = averaged.select(*averaged.columns, F.inline(F.when(F.size("matches") > 0, F.col("matches")).otherwise(unknown)))
    health = expand_copies(matched.withColumnRenamed("status", "current_status"))
    return rolling_features(health, keep=("_affected", *SUMS[:4])).where("_affected")


BELOW = float("-inf")  # stands for the averages below the cut, which are only counted


def _machine_rows(hours: DataFrame, before: DataFrame, machines: DataFrame) -> DataFrame:
    """The machine rows after the batch; `_below_tail` says that a percentile cannot be read off the tail."""
    newest_first = Window.partitionBy("machine_id").orderBy(F.col("hour_ts").desc())
    carried = (
        hours.select("machine_id", "hour_ts", *SUMS).withColumn("_rank", F.row_number().over(newest_first)).where(F.col("_rank") <= CARRIED)
        .groupBy("machine_id").agg(F.sort_array(F.collect_list(F.struct("hour_ts", *SUMS))).alias("last_hours"))
    )

    def stacked(rows: DataFrame, entries: Callable[[str], Column]) -> DataFrame:
        both = F.array(*[F.struct(F.lit(m).alias("measure"), entries(m).alias("entries")) for m in MEASURES])
        return rows.select("machine_id", F.inline(both)).select("machine_id", "measure", F.inline("entries"))

    def change(measure: str, prefix: str, n: int) -> Column:
        value, cut = _average(measure, prefix), F.col(f"{measure}_cut")
        return F.struct(F.when(value < cut, BELOW).otherwise(value).alias("value"), F.lit(n).cast("long").alias("n"))

    cuts = machines.select("machine_id", *[f"{m}_cut" for m in MEASURES])
    changes = stacked(hours.where("_new").join(cuts, "machine_id"), lambda m: F.array(change(m, "_known_", -1), change(m, "", 1)))
    kept = stacked(before, lambda m: F.col(f"{m}_tail")).unionByName(changes.where("value is not null"))
    tails = kept.repartition("machine_id").groupBy("machine_id", "measure", "value").agg(F.sum("n").alias("n")).where("n > 0")
    return _with_percentiles(machines.select("machine_id", "matches", *[f"{m}_cut" for m in MEASURES]).join(carried, "machine_id"), tails)


def _with_percentiles(machines: DataFrame, tails: DataFrame) -> DataFrame:
    """Machine rows (machine_id, matches, last_hours, cuts) with percentiles and tails, cut where they have grown long."""
    # An hour makes a health row for each status row that the machine matches.
    copies = F.greatest(F.lit(1), F.aggregate("matches", F.lit(0).cast("long"), lambda total, e: total + e["copies"]))
    weighted = tails.join(machines.select("machine_id", copies.alias("_copies"), *[f"{m}_cut" for m in MEASURES]), "machine_id")
    cut = F.when(F.col("measure") == MEASURES[0], F.col(f"{MEASURES[0]}_cut")).otherwise(F.col(f"{MEASURES[1]}_cut"))
    summary = weighted.groupBy("machine_id", "measure").agg(
        F.percentile("value", F.lit(rules.BASELINE_QUANTILE), F.col("n") * F.col("_copies")).alias("p95"),
        F.percentile("value", F.lit(1 - TAIL), F.col("n")).alias("_low"),
        F.sort_array(F.collect_list(F.struct("value", "n"))).alias("tail"),
        F.sum("n").alias("_n"), F.sum(F.when(F.col("value") > BELOW, F.col("n"))).alias("_above"), F.max(cut).alias("cut"),
    )
    low = F.col("_low")
    cuttable = (F.col("_n") >= CUT_FROM) & (F.col("_above") > CUT_ABOVE * F.col("_n")) & (F.abs(low) < float("inf"))
    summary = summary.withColumn("cut", F.when(cuttable, low).otherwise(F.col("cut")))
    is_below = lambda e: e["value"] < F.col("cut")
    counted = F.aggregate(F.filter("tail", is_below), F.lit(0).cast("long"), lambda total, e: total + e["n"])
    tail = F.when(F.col("_below") > 0, F.concat(
        F.array(F.struct(F.lit(BELOW).alias("value"), F.col("_below").alias("n"))), F.filter("tail", lambda e: ~is_below(e))
    )).otherwise(F.col("tail"))
    # The percentile lies between two averages; with one of them below the cut it comes out infinite or as no number.
    lost = F.isnan("p95") | (F.abs("p95") == float("inf"))
    per_machine = summary.withColumn("_below", counted).withColumn("tail", tail).groupBy("machine_id").agg(
        *[F.max(F.when(F.col("measure") == m, F.col(c))).alias(name) for m in MEASURES for c, name in (("cut", f"{m}_cut"), ("p95", P95[m]))],
        *[F.first(F.when(F.col("measure") == m, F.col("tail")), ignorenulls=True).alias(f"{m}_tail") for m in MEASURES],
        F.max(lost).alias("_below_tail"),
    )
    rows = machines.select("machine_id", "matches", "last_hours").join(per_machine, "machine_id", "left")
    return rows.withColumn("_below_tail", F.coalesce("_below_tail", F.lit(False)))


def _with_whole_tails(rows: DataFrame, features: DataFrame) -> DataFrame:
    """Machine rows of which those with too short a tail are rebuilt from the averages of all their hours."""
    lost = rows.where("_below_tail").select("machine_id", "matches", "last_hours", *[F.lit(None).cast("double").alias(f"{m}_cut") for m in MEASURES])
    hours = features.join(lost, "machine_id", "left_semi").dropDuplicates(["machine_id", "hour_ts"])
    values = hours.select(
        "machine_id", F.inline(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(f"avg_{m}").alias("value")) for m in MEASURES]))
    ).where("value is not null")
    tails = values.groupBy("machine_id", "measure", "value").agg(F.count(F.lit(1)).alias("n"))
    return rows.where("not _below_tail").unionByName(_with_percentiles(lost, tails))
