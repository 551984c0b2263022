"""Approximate nearest neighbours by inner product with balanced posting lists.

Centroids come from balanced splits of a bounded sample; a small graph over them answers which are near. A vector goes
to the posting list of its nearest centroid and, when it lies at a boundary, to a few more. Neighbouring lists make a
cell. A query probes the cells with a centroid not much farther than its nearest one, and compares with every vector
there in double precision. How much farther is calibrated: a bounded sample of the queries is answered exactly over the
whole table, and the limit is the one that reaches RECALL of their neighbours. The number of cells probed has no cap;
where vectors hardly cluster it grows with the table.

Inner products are turned into distances by one added coordinate that gives all vectors the same length, so vectors need
not be normalised. Equal vectors are indexed once and expanded again at the end; a vector that a third of all rows share
costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millpulse.llm.ship import ship, unpack

SAMPLE = 40_000  # vectors the centroids are fitted on, in the order of a hash of their id
LIST_SIZE = 256  # distinct vectors a posting list should hold
MAX_LISTS = 16_384
REPLICAS = 4
BOUNDARY = 1.2  # a vector joins further lists up to this multiple of its nearest squared distance
RECALL = 0.96  # share of the sampled queries' true neighbours that the probed cells must hold
CALIBRATION = 256  # queries answered exactly, in the order of a hash of their id
PROBED_ROWS = 50_000  # rows of (cell, query) in one batch
ASKED = 200_000  # queries that meet a cell in one group, at most about
CELLS = 16  # at least, if there are as many lists
DEGREE = 16
CHUNK = 32_768  # postings of a cell compared in one group
MIN_FOUND = 8  # postings to look at for each neighbour asked for, at least
BATCH = 1_024
COMPARED = 256  # queries compared with a group at once


@dataclass
class CentroidGraph:
    """Each centroid is linked to its nearest ones, and to a few far ones so that no part is cut off."""

    centroids: np.ndarray
    links: np.ndarray
    entries: np.ndarray

    def nearest(self, points: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The `width` nearest centroids found for each point and their squared distances, nearest first; -1 pads.

        All points walk the graph together: each opens its best unopened centroid until none of its `width` best is
        left unopened.
        """
        n, n_points = len(self.centroids), len(points)
        width = min(width, n)
        norms = (self.centroids**2).sum(1)
        lengths = (points**2).sum(1)[:, None]

        def distances(ids: np.ndarray) -> np.ndarray:
            return norms[ids] + lengths - 2 * np.einsum("bd,bkd->bk", points, self.centroids[ids])

        ids = np.tile(self.entries, (n_points, 1))
        beam = max(width, len(self.entries))
        dist = distances(ids)
        opened = np.zeros(ids.shape, bool)
        seen = np.zeros((n_points, n), bool)
        seen[np.arange(n_points)[:, None], ids] = True
        rows = np.arange(n_points)[:, None]
        while True:
            waiting = np.where(opened, np.inf, dist)
            best = waiting.argmin(1)
            live = np.isfinite(waiting[rows[:, 0], best])
            if not live.any():
                break
            opened[rows[:, 0], best] = True
            around = self.links[ids[rows[:, 0], best]]
            fresh = ~seen[rows, around] & live[:, None]
            seen[rows, around] = True
            more = np.where(fresh, distances(around), np.inf)
            ids, dist = np.concatenate([ids, around], 1), np.concatenate([dist, more], 1)
            opened = np.concatenate([opened, ~np.isfinite(more)], 1)
            keep = np.argsort(dist, axis=1, kind="stable")[:, :beam]
            ids, dist, opened = ids[rows, keep], dist[rows, keep], opened[rows, keep]
        found = np.where(np.isfinite(dist), ids, -1)
        return found[:, :width], np.maximum(dist[:, :width], 0.0)


def balanced_centroids(points: np.ndarray, n_lists: int, seed: int = 7) -> np.ndarray:
    """At most `n_lists` centroids, each of about as many points: the largest part is split in two, again and again.

    A part is split at the median along the line between two centres found by 2-means, which keeps halves equal.
    """
    rng = np.random.default_rng(seed)
    parts = [np.arange(len(points))]
    target = max(1, -(-len(points) // max(1, n_lists)))
    done: list[np.ndarray] = []
    while parts:
        part = parts.pop()
        if len(part) <= target or len(part) < 2:
            done.append(part)
            continue
        block = points[part]
        centres = block[rng.choice(len(part), 2, replace=False)]
        for _ in range(6):
            side = block @ (centres[1] - centres[0])
            upper = side > ((centres**2).sum(1) @ np.array([-0.5, 0.5]))
            if upper.all() or not upper.any():
                break
            centres = np.stack([block[~upper].mean(0), block[upper].mean(0)])
        order = np.argsort(block @ (centres[1] - centres[0]), kind="stable")
        # Cut at a multiple of the target, so that the parts end up with like sizes.
        cut = max(1, round(len(part) / target / 2)) * target
        cut = cut if cut < len(part) else len(part) // 2
        parts += [part[order[:cut]], part[order[cut:]]]
    return np.stack([points[part].mean(0) for part in done]) if len(points) else np.zeros((0, points.shape[1]))


def build_graph(centroids: np.ndarray, degree: int = DEGREE, seed: int = 7) -> CentroidGraph:
    n = len(centroids)
    rng = np.random.default_rng(seed)
    norms = (centroids**2).sum(1)
    near = []
    for at in range(0, n, BATCH):
        block = centroids[at:at + BATCH]
        dist = norms - 2 * block @ centroids.T
        near.append(np.argsort(dist, axis=1, kind="stable")[:, :degree + 1])
    near = np.concatenate(near)
    far = rng.integers(0, n, (n, max(2, degree // 4)))
    # A ring over all centroids makes every one reachable.
    ring = np.stack([(np.arange(n) + 1) % n, (np.arange(n) - 1) % n], 1)
    entries = np.unique(np.linspace(0, n - 1, min(n, 8)).astype(int))
    links = np.sort(np.concatenate([near, far, ring], 1), axis=1)
    # A link that is there twice becomes one to the centroid itself, which is known when its links are read.
    again = np.concatenate([np.zeros((n, 1), bool), links[:, 1:] == links[:, :-1]], 1)
    return CentroidGraph(centroids, np.where(again, np.arange(n)[:, None], links), entries)


def usable(vectors: DataFrame) -> DataFrame:
    """One row (vec_id, vector) per id with a vector that takes part.

    NULL ids, and vectors that are NULL, empty, zero or hold NULL, NaN or an infinity, take no part. Of several vectors
    of one id the smallest stands. Vectors of another length than the most frequent one take no part either.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    broken = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = rows.where(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0)
        & ~F.exists("vector", broken) & F.exists("vector", lambda x: x != 0)
    )
    rows = rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    return rows


def _matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


@dataclass
class Index:
    """What the tasks need: the graph over the centroids and the length all vectors are brought to."""

    graph: CentroidGraph
    dims: int
    longest: float
    spacing: float = 0.0  # median squared distance of a centroid from its nearest other one
    starts: np.ndarray | None = None  # first list of each cell; lists are numbered so that those close together follow
    held: np.ndarray | None = None  # postings of each cell
    ratio: float = 1.0  # a query probes cells up to this multiple of its nearest squared distance
    floor: float = 0.0  # the least value that a nearest squared distance counts as

    def lifted(self, block: np.ndarray, query: bool) -> np.ndarray:
        """With the added coordinate: what is missing to the common length; none for a query, which is scaled to it."""
        length = (block**2).sum(1)
        if query:
            return np.column_stack([block * (self.longest / np.sqrt(length))[:, None], np.zeros(len(block))])
        return np.column_stack([block, np.sqrt(np.maximum(self.longest**2 - length, 0.0))])

    def lists(self, block: np.ndarray) -> Iterator[tuple[int, list[int]]]:
        """The posting lists of each vector: the nearest, and others about as near that lie in another direction."""
        cents = self.graph.centroids
        for at in range(0, len(block), BATCH):
            points = self.lifted(block[at:at + BATCH], False)
            ids, dist = self.graph.nearest(points, 4 * REPLICAS)
            for i in range(len(points)):
                chosen: list[int] = []
                for c, d in zip(ids[i], dist[i]):
                    if c < 0 or len(chosen) == REPLICAS or (chosen and d > BOUNDARY * dist[i][0]):
                        break
                    # Where vectors hardly cluster, centroids lie closer together than any vector to them.
                    if all(((cents[c] - cents[o]) ** 2).sum() > min(d, self.spacing) * 0.5 for o in chosen):
                        chosen.append(int(c))
                yield at + i, chosen

    def form_cells(self, sizes: dict[int, int]) -> None:
        """Cells of consecutive lists with about as many postings each."""
        counts = np.array([sizes.get(c, 0) for c in range(len(self.graph.centroids))])
        total = max(1, int(counts.sum()))
        n_cells = min(len(counts), max(CELLS, -(-total // CHUNK)))
        self.starts = np.unique((np.cumsum(counts) - counts) * n_cells // total, return_index=True)[1]
        self.held = np.add.reduceat(counts, self.starts)

    def cells(self, lists: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, lists, "right") - 1

    def distances(self, block: np.ndarray) -> np.ndarray:
        """Squared distances of queries from the nearest centroid of each cell."""
        points, cents = self.lifted(block, True), self.graph.centroids
        dist = np.maximum((points**2).sum(1)[:, None] + (cents**2).sum(1) - 2 * points @ cents.T, 0.0)
        return np.minimum.reduceat(dist, self.starts, axis=1)

    def probes(self, block: np.ndarray, wanted: int) -> Iterator[tuple[int, list[int]]]:
        """The cells each query looks at: all those within the ratio, and more until they hold enough postings."""
        size = max(1, min(BATCH, (1 << 21) // len(self.graph.centroids)))
        for at in range(0, len(block), size):
            dist = self.distances(block[at:at + size])
            order = np.argsort(dist, axis=1, kind="stable")
            for i, ids in enumerate(order):
                limit = self.ratio * max(dist[i, ids[0]], self.floor)
                chosen, held = [], 0
                for c in ids.tolist():
                    if dist[i, c] > limit and held >= wanted:
                        break
                    chosen.append(c)
                    held += self.held[c]
                yield at + i, chosen


def spacing(centroids: np.ndarray) -> float:
    norms = (centroids**2).sum(1)
    least = []
    for at in range(0, len(centroids), BATCH):
        dist = norms[at:at + BATCH, None] + norms - 2 * centroids[at:at + BATCH] @ centroids.T
        rows = np.arange(len(dist))
        dist[rows, at + rows] = np.inf
        least.append(dist.min(1))
    return float(max(np.median(np.concatenate(least)), 0.0)) if len(centroids) > 1 else 0.0


def exact_neighbours(groups: DataFrame, names: np.ndarray, asked: np.ndarray, k: int) -> DataFrame:
    """(query, rep): the `k` nearest other groups (rep, vector) of a few queries, by comparison with every one of them."""
    shipped = ship(groups.sparkSession, (names, asked))
    dims = asked.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_names, held = unpack(shipped)
        reps, scores = np.zeros((len(held), 0), np.int64), np.zeros((len(held), 0))
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            near = held @ _matrix(batch.column(1), dims).T
            near[held_names[:, None] == ids] = -np.inf
            reps = np.concatenate([reps, np.broadcast_to(ids, near.shape)], 1)
            scores = np.concatenate([scores, near], 1)
            if scores.shape[1] > k:
                best = np.argpartition(-scores, k - 1, axis=1)[:, :k]
                reps, scores = np.take_along_axis(reps, best, 1), np.take_along_axis(scores, best, 1)
        at, place = np.nonzero(np.isfinite(scores))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(reps[at, place]), pa.array(scores[at, place])], names=["query", "rep", "score"]
        )

    found = groups.select("rep", "vector").mapInArrow(run, "query int, rep long, score double")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    return found.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k).select("query", "rep")


def calibrate(index: Index, groups: DataFrame, asked_groups: DataFrame, postings: DataFrame, k: int) -> None:
    """Sets the ratio at which the probed cells hold RECALL of the true neighbours of a sample of the queries."""
    sample = asked_groups.orderBy(F.xxhash64("query_rep"), "query_rep").limit(CALIBRATION).toArrow()
    if not sample.num_rows:
        return
    block = _matrix(sample["vector"], index.dims)
    near = exact_neighbours(groups, sample["query_rep"].to_numpy(), block, k)
    lists = F.collect_list("list").alias("lists")
    near = postings.join(F.broadcast(near), "rep").groupBy("query", "rep").agg(lists).collect()  # k rows per sampled query
    dist = index.distances(block)
    least = dist.min(1)
    index.floor = float(np.median(least))
    least = np.maximum(least, max(index.floor, 1e-300))
    needed = [dist[row["query"], index.cells(np.array(row["lists"]))].min() / least[row["query"]] for row in near]
    if needed:
        index.ratio = max(1.0, float(np.quantile(needed, RECALL, method="higher"))) * (1 + 1e-9)


def search(vectors: DataFrame, k: int = 20, query_modulus: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the `k` nearest found of every vector whose id is divisible by `query_modulus`.

    Nearness is the largest inner product; ties go to the smaller id. A query never finds its own id. Fewer rows come
    back only if the lists hold fewer candidates than asked for; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = usable(vectors)
    dims_row = rows.groupBy(F.size("vector").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    dims = dims_row["dims"] if dims_row else 1
    rows = rows.where(F.size("vector") == dims)
    # Equal vectors stand for each other: `rep` is their smallest id, and k + 1 ids are all a query can need of them.
    groups = rows.groupBy("vector").agg(F.min("vec_id").alias("rep"))
    of_vector = Window.partitionBy("vector").orderBy("vec_id")
    members = rows.withColumn("_n", F.row_number().over(of_vector)).where(F.col("_n") <= k + 1)
    members = members.groupBy("vector").agg(F.min("vec_id").alias("rep"), F.collect_list("vec_id").alias("ids"))
    length = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    facts = groups.agg(F.count("*").alias("n"), F.max(F.sqrt(length)).alias("longest")).first()
    sample = groups.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("vector").toArrow()
    points = _matrix(sample["vector"], dims) if sample.num_rows else np.ones((1, dims))
    index = Index(CentroidGraph(np.zeros((0, 0)), np.zeros((0, 0), int), np.zeros(0, int)), dims, float(facts["longest"] or 1.0))
    n_lists = int(min(MAX_LISTS, max(1, facts["n"] // LIST_SIZE)))
    index.graph = build_graph(balanced_centroids(index.lifted(points, False), n_lists))
    index.spacing = spacing(index.graph.centroids)
    shipped = ship(spark, index)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = unpack(shipped)
        for batch in batches:
            if not batch.num_rows:
                continue
            at, lists = [], []
            for i, chosen in held.lists(_matrix(batch.column(1), held.dims)):
                at += [i] * len(chosen)
                lists += chosen
            taken = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(lists, pa.int32()), *taken.columns], names=["list", "rep", "vector"])

    postings = groups.select("rep", "vector").mapInArrow(post, "list int, rep long, vector array<double>")
    postings = postings.persist()
    sizes = {r["list"]: r["count"] for r in postings.groupBy("list").count().collect()}  # one row per list
    index.form_cells(sizes)
    chunks = [-(-n // CHUNK) for n in index.held.tolist()]

    asked = rows.where(F.pmod("vec_id", F.lit(query_modulus)) == 0).select("vec_id", "vector")
    asked_groups = asked.groupBy("vector").agg(F.min("vec_id").alias("query_rep"))
    # A sampled query goes by the id of its group, so that it is not its own neighbour.
    calibrate(index, groups, asked_groups.join(groups, "vector").select("vector", F.col("rep").alias("query_rep")), postings, k)
    calibrated = ship(spark, index)
    turns = max(1, -(-asked_groups.count() // ASKED))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = unpack(calibrated)
        for batch in batches:
            if not batch.num_rows:
                continue
            at, cells, parts = [], [], []

            def flush() -> pa.RecordBatch:
                taken = batch.take(pa.array(at, pa.int64()))
                out = pa.RecordBatch.from_arrays(
                    [pa.array(cells, pa.int32()), pa.array(parts, pa.int32()), *taken.columns], names=["cell", "part", "query_rep", "vector"]
                )
                at.clear()
                cells.clear()
                parts.clear()
                return out

            for i, chosen in held.probes(_matrix(batch.column(1), held.dims), MIN_FOUND * (k + 1)):
                for c in chosen:
                    for part in range(chunks[c]):
                        at.append(i)
                        cells.append(c)
                        parts.append(part)
                if len(at) >= PROBED_ROWS:
                    yield flush()
            yield flush()

    def compare(queries: pa.Table, held: pa.Table) -> pa.Table:
        found: tuple[list, list, list] = ([], [], [])
        if queries.num_rows and held.num_rows:
            # A vector may be in several lists of a cell.
            reps, order = np.unique(held["rep"].to_numpy(), return_index=True)
            block = _matrix(held["vector"], dims)[order]
            names, asked_block = queries["query_rep"].to_numpy(), _matrix(queries["vector"], dims)
            for at in range(0, len(names), COMPARED):
                near = asked_block[at:at + COMPARED] @ block.T
                for i, row in enumerate(near):
                    # Ties at the last place are kept here, and decided when all lists have answered.
                    limit = np.partition(row, -(k + 1))[-(k + 1)] if len(row) > k + 1 else -np.inf
                    best = np.nonzero(row >= limit - 1e-12 * abs(limit) if np.isfinite(limit) else np.ones(len(row), bool))[0]
                    exact = (block[best] * asked_block[at + i]).sum(1)
                    best = best[np.lexsort((reps[best], -exact))[:k + 1]]
                    found[0].append(np.full(len(best), names[at + i]))
                    found[1].append(reps[best])
                    found[2].append((block[best] * asked_block[at + i]).sum(1))
        flat = [np.concatenate(x) if x else np.zeros(0) for x in found]
        return pa.table({
            "query_rep": pa.array(flat[0].astype(np.int64)), "rep": pa.array(flat[1].astype(np.int64)), "score": pa.array(flat[2].astype(float)),
        })

    queries = asked_groups.select("query_rep", "vector").mapInArrow(probe, "cell int, part int, query_rep long, vector array<double>")
    cell_of = index.cells(np.array(list(sizes), int)).tolist()
    table = spark.createDataFrame([(c, cell, chunks[cell]) for c, cell in zip(sizes, cell_of)], "list int, cell int, parts int")  # one row per list
    placed = postings.join(F.broadcast(table), "list").withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")).drop("parts")
    queries = queries.withColumn("turn", F.pmod(F.xxhash64("query_rep"), F.lit(turns)).cast("int"))
    placed = placed.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))))
    near = queries.groupBy("cell", "part", "turn").cogroup(placed.groupBy("cell", "part", "turn")).applyInArrow(
        compare, "query_rep long, rep long, score double"
    )
    near = near.groupBy("query_rep", "rep").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_rep").orderBy(F.desc("score"), "rep")
    near = near.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k + 1).drop("_n")

    by_id = asked.join(asked_groups, "vector").select(F.col("vec_id").alias("query_id"), "query_rep")
    expanded = near.join(members.select("rep", "ids"), "rep").join(by_id, "query_rep")
    expanded = expanded.select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return expanded.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
