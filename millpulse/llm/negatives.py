"""Hard negatives by slots: the upper limits of an anchor's positives cut the scores into disjoint slots.

A positive with score p asks for the best negatives between low and high hundredths of p. The windows of one anchor overlap,
but each of them is a run of whole slots, cut off below: slot i holds the scores above the upper limit of positive i + 1 and
not above that of positive i. So a task keeps the best k per anchor and slot, Spark merges what the tasks kept, and one
merge from the lowest slot upwards gives every window its k best. Rows above all windows or below all of them are not kept.

Anchors are a stated query set and meet all rows in blocks. A block holds about ANCHORS anchors of one vector length; it is
broadcast, and each task compares the rows it reads with it and hands on at most k rows per anchor and slot. No rows are
shuffled but these.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from heapq import merge
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millpulse.llm.ship import ship, unpack
from millpulse.session import work_dir

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # hundredths of the positive's score
SCALE = 256
ANCHORS = 8_192  # anchors of a block, about
LARGEST = 2**31 - 1
NOTHING, EVERYTHING = np.iinfo(np.int64).min, np.iinfo(np.int64).max  # scores below and above all others
ROWS_AT_ONCE, ANCHORS_AT_ONCE = 2_048, 1_024
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
KEPT = "anchor int, slot int, score long, vec_id long, row long"


@dataclass
class Block:
    """Anchors by position: their row numbers, ids, labels and points, and later their positives, best first."""

    rows: np.ndarray
    ids: list[int]
    labels: np.ndarray
    points: np.ndarray
    positives: list[list[tuple[int, int]]] | None = None  # (score, vec_id)

    def windows(self, low: int, high: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Upper limits by positive and the lowest score in any window. Missing positives have no scores below them."""
        upper = np.full((len(self.rows), width), NOTHING)
        lowest = np.full(len(self.rows), EVERYTHING)
        for anchor, found in enumerate(self.positives):
            for at, (score, _) in enumerate(found):
                upper[anchor, at] = high * score // 100
                if (least := -(-low * score // 100)) <= upper[anchor, at]:
                    lowest[anchor] = min(lowest[anchor], least)
        return upper, lowest


def mine(
    vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
    scale: int = SCALE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for each anchor and positive.

    Takes `vec_id`, `label` and `embedding`; other columns are ignored, but `is_anchor` may mention them. Rows with a NULL id
    or label, a NULL vector, or a NULL, NaN or infinite component take no part. Components become floor(scale * x), scores are
    whole inner products, and higher scores come first, ties by smaller id. Only vectors of one length are compared. Rows that
    repeat an id are rows of their own: they rank one after the other, and each may be an anchor; an anchor leaves out only
    itself. A window without rows gives none; so does an empty table. Scores that a long could not hold fail the job.
    """
    spark = vectors.sparkSession
    folder = work_dir(spark, "negatives")
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    usable = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & sound)
    usable = usable.select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long"), F.col("label").cast("long"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"), F.col("embedding").cast("array<double>"),
    )
    # Written once, so that a row keeps its number whatever is computed again later.
    usable.mapInArrow(_whole_numbers(scale), "row long, vec_id long, label long, is_anchor boolean, dims int, point binary").write.parquet(
        f"{folder}/points"
    )
    points = spark.read.parquet(f"{folder}/points")
    blocks = {
        r.dims: math.ceil(r["count"] / ANCHORS) for r in points.where("is_anchor").groupBy("dims").count().collect()
    }
    if not blocks:
        return spark.createDataFrame([], RESULT)
    n_blocks = F.create_map(*[F.lit(x) for pair in blocks.items() for x in pair])[F.col("dims")]
    anchors = points.where("is_anchor").withColumn("block", F.pmod(F.xxhash64("row"), n_blocks).cast("int"))
    anchors.write.partitionBy("dims", "block").parquet(f"{folder}/anchors")
    anchors = spark.read.parquet(f"{folder}/anchors")
    for dims, n in blocks.items():
        for number in range(n):
            held = anchors.where((F.col("dims") == dims) & (F.col("block") == number)).orderBy("row").collect()
            if held:
                rows = _block_result(points.where(F.col("dims") == dims), held, dims, positives, negatives, low, high)
                rows.write.mode("overwrite").parquet(f"{folder}/mined/part={dims}-{number}")
    return spark.read.schema(RESULT).parquet(f"{folder}/mined").select(*[c.split()[0] for c in RESULT.split(", ")])


def _block_result(points: DataFrame, held: list, dims: int, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    spark = points.sparkSession
    matrix = np.frombuffer(b"".join(r.point for r in held), "<i4").reshape(len(held), dims).astype(np.int64)
    block = Block(np.array([r.row for r in held]), [r.vec_id for r in held], np.array([r.label for r in held]), matrix)
    best = _best(points.mapInArrow(_same_label(ship(spark, block), positives), KEPT), positives)
    block.positives = [[] for _ in held]
    for r in best.orderBy("anchor", F.desc("score"), "vec_id", "row").collect():  # `positives` rows per anchor at most
        block.positives[r.anchor].append((r.score, r.vec_id))
    shipped = ship(spark, block)
    kept = _best(points.mapInArrow(_in_slots(shipped, positives, negatives, low, high), KEPT), negatives)
    entry = F.struct("slot", (-F.col("score")).alias("below"), "vec_id", "row")
    per_anchor = kept.groupBy("anchor").agg(F.sort_array(F.collect_list(entry)).alias("kept"))  # positives x negatives at most
    return per_anchor.mapInArrow(_windows(shipped, negatives, low, high), RESULT)


def _best(kept: DataFrame, k: int) -> DataFrame:
    """The best k rows per anchor and slot of what all tasks kept."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id", "row")
    return kept.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k).drop("_rank")


Batches = Iterator[pa.RecordBatch]


def _whole_numbers(scale: int) -> Callable[[Batches], Batches]:
    def convert(batches: Batches) -> Batches:
        for batch in batches:
            vectors = batch.column("embedding")
            scaled = np.floor(scale * np.asarray(vectors.flatten(), dtype=float))
            if np.abs(scaled).max(initial=0) > LARGEST:
                raise ValueError(f"a component is beyond {LARGEST} after scaling")
            whole, sizes = scaled.astype("<i4"), np.asarray(vectors.value_lengths())
            points = [p.tobytes() for p in np.split(whole, np.cumsum(sizes)[:-1])] if len(sizes) else []
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("row", "vec_id", "label", "is_anchor")), pa.array(sizes, pa.int32()), pa.array(points, pa.binary())],
                ["row", "vec_id", "label", "is_anchor", "dims", "point"],
            )

    return convert


class Best:
    """The k best (score, vec_id, row) of each group; `bar` is the score a row must reach to be looked at."""

    def __init__(self, groups: int, k: int):
        self.k, self.bar = k, np.full(groups, NOTHING)
        self.group = self.score = self.vec_id = self.row = np.empty(0, dtype=np.int64)

    def add(self, group, score, vec_id, row) -> None:
        group, score, vec_id, row = (
            np.concatenate([a, b.astype(np.int64)]) for a, b in ((self.group, group), (self.score, score), (self.vec_id, vec_id), (self.row, row))
        )
        order = np.lexsort((row, vec_id, -score, group))
        ordered = group[order]
        place = np.arange(len(order)) - np.searchsorted(ordered, ordered)
        order, place = order[place < self.k], place[place < self.k]
        self.group, self.score, self.vec_id, self.row = group[order], score[order], vec_id[order], row[order]
        full = place == self.k - 1
        self.bar[self.group[full]] = self.score[full]

    def batch(self, width: int) -> pa.RecordBatch:
        anchor, slot = np.divmod(self.group, width)
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip((anchor, slot, self.score, self.vec_id, self.row), kinds)], [c.split()[0] for c in KEPT.split(", ")]
        )


def _scored(batches: Batches, block: Block):
    """(from, to, scores, labels, vec_ids, rows) for each run of anchors against each run of rows; scores are whole numbers."""
    n, dims = block.points.shape
    largest = int(np.abs(block.points).max(initial=0))
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(at, ROWS_AT_ONCE)
            points = np.frombuffer(b"".join(part.column("point").to_pylist()), "<i4").reshape(part.num_rows, dims).astype(np.int64)
            bound = dims * largest * int(np.abs(points).max(initial=0))
            if bound >= 2**63:
                raise ValueError("inner products would not fit a long")
            kind = float if bound < 2**53 else np.int64
            labels, ids, rows = (np.asarray(part.column(c)) for c in ("label", "vec_id", "row"))
            for lo in range(0, n, ANCHORS_AT_ONCE):
                hi = min(n, lo + ANCHORS_AT_ONCE)
                yield lo, hi, block.points[lo:hi].astype(kind) @ points.T.astype(kind), labels, ids, rows


def _same_label(shipped, k: int) -> Callable[[Batches], Batches]:
    def look(batches: Batches) -> Batches:
        block = unpack(shipped)
        best = Best(len(block.rows), k)
        for lo, hi, scores, labels, ids, rows in _scored(batches, block):
            fit = (scores >= best.bar[lo:hi, None]) & (block.labels[lo:hi, None] == labels) & (block.rows[lo:hi, None] != rows)
            anchor, row = np.nonzero(fit)
            if len(anchor):
                best.add(anchor + lo, scores[anchor, row], ids[row], rows[row])
        yield best.batch(1)

    return look


def _in_slots(shipped, width: int, k: int, low: int, high: int) -> Callable[[Batches], Batches]:
    def look(batches: Batches) -> Batches:
        block = unpack(shipped)
        upper, lowest = block.windows(low, high, width)
        best = Best(len(block.rows) * width, k)
        for lo, hi, scores, labels, ids, rows in _scored(batches, block):
            fit = (scores <= upper[lo:hi, :1]) & (scores >= lowest[lo:hi, None]) & (block.labels[lo:hi, None] != labels)
            anchor, row = np.nonzero(fit)
            score = scores[anchor, row]
            anchor += lo
            slot = anchor * width + (score[:, None] <= upper[anchor]).sum(1) - 1
            above = score >= best.bar[slot]
            if above.any():
                best.add(slot[above], score[above], ids[row[above]], rows[row[above]])
        yield best.batch(width)

    return look


def _windows(shipped, k: int, low: int, high: int) -> Callable[[Batches], Batches]:
    """From the lowest slot upwards, the k best up to each positive's limit; what lies below its window is cut off."""
    def answer(batches: Batches) -> Batches:
        block = unpack(shipped)
        for batch in batches:
            out = []
            for anchor, kept in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                slots: dict[int, list] = {}
                for e in kept:
                    slots.setdefault(e["slot"], []).append((e["below"], e["vec_id"], e["row"]))
                suffix: list = []
                found = block.positives[anchor]
                for at in range(len(found) - 1, -1, -1):
                    suffix = list(islice(merge(slots.get(at, []), suffix), k))
                    score, positive = found[at]
                    inside = [(-below, vec) for below, vec, _ in suffix if low * score <= -100 * below <= high * score]
                    out += [(block.ids[anchor], positive, rank, vec, score, s) for rank, (s, vec) in enumerate(inside, 1)]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            columns = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [c.split()[0] for c in RESULT.split(", ")])

    return answer
