"""Near-duplicate documents: an exact self-join on word shingles by T-occurrence search.

A document is its set of five-word shingles, as 64-bit hashes. Two documents link when the Jaccard similarity of their
sets is 0.75 or more; documents of equal sets are one node from the start.

Let T(n) = ceil(0.75 n): linked documents share at least T shingles. In any one order of all shingles, the first k shared
shingles of such a pair all lie among the first n - T(n) + k(n) of either set, so only these prefixes are indexed, and a pair
must share at least k of the smaller document there. The order is that of the hashes, but with frequent shingles last, so that
documents that have little but frequent shingles in common hardly share any of their prefixes. Which ones count as frequent is
read off a sample; it changes what is compared, never what is found. The search goes in two steps.

* Each inverted list proposes a few of its members as leaders, and in a second turn a few of its largest component. A
  document that shares enough lists with a leader is compared with it. Groups of near copies so become components with
  a few comparisons per member, never all pairs.
* What is left are pairs of different components. Lists whose members are all of one component are dropped. Every
  document fetches its remaining lists, heap-merges the short ones, probes the long ones by binary search (DivideSkip),
  and keeps the documents that reach the required count; exact sets then decide. A list longer than LONG is fetched only
  by documents with so many long lists that all k shared shingles of a pair may lie in them, and holds only those; if
  either document of a pair is another one, at least one shared list is short, and what the short lists leave open is
  looked up among the long lists of both.

Candidates are thinned before whole sets are compared. Each document has a bitmap of its set, one bit for each class of its
shingles; a bit that only one of two documents has stands for at least one shingle that the other lacks. A pair with
more such bits than a linked pair has shingles apart cannot link, which is exact, and only the bitmaps move for it.

No pair is dropped and no list is cut: both steps together find every link between different components.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce
from itertools import compress, groupby
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millpulse.llm.components import connected
from millpulse.llm.ship import ship, unpack
from millpulse.session import work_dir

WIDTH = 5
PERCENT = 75
LEADERS = 4  # members of each list that the others are compared with first
LATE_LEADERS = 6  # of the largest component, for those not joined by then
LONG = 64  # members from which an inverted list counts as long
CHUNK = 2_000  # members of a long list in one row
SAMPLE = 64  # one document in so many tells which shingles are frequent
FREQUENT_FROM = 4  # sampled documents
MAX_FREQUENT = 100_000  # shingles that are broadcast, the most frequent ones: 0.8 MB
BITS = 512  # of a document's bitmap
MAX_BROADCAST_BITMAPS = 150_000  # at most 20 MB; beyond it candidates are joined by a shuffle
MAX_BROADCAST_IDS = 500_000  # at most 20 MB of ids and prints; beyond it documents are joined by a shuffle

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_ROUND = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)
_GAP = np.zeros(256, bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_LOWER += 1


class Powers:
    """Powers of the hash base and of its inverse modulo 2**64, grown to the longest text met."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        size = max(1 << 16, 1 << n.bit_length())
        with np.errstate(over="ignore"):
            self.up, self.down = (
                np.cumprod(np.concatenate(([np.uint64(1)], np.full(size, base, np.uint64)))) for base in (_BASE, _INVERSE)
            )

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            self.grow(n)
        return self.up, self.down


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _ROUND[0]
    x = (x ^ (x >> np.uint64(27))) * _ROUND[1]
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, powers: Powers) -> np.ndarray:
    """The distinct shingles of a whole text as sorted 64-bit integers: none without words, one below five words."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    inside = ~_GAP[raw]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    starts, stops = edges[::2], edges[1::2]
    n = len(starts)
    if not n:
        return np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        up, down = powers.upto(len(raw) + 1)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_LOWER[raw] * up[:len(raw)], dtype=np.uint64)))
        word = _mixed((total[stops] - total[starts]) * down[starts] + (stops - starts).astype(np.uint64))
        width = min(n, WIDTH)
        found = np.full(n - width + 1, width, np.uint64)
        for i in range(width):
            found = _mixed(found * _ROUND[4] + word[i:i + len(found)] * _ROUND[i])
    return np.unique(found.view(np.int64))


def required(n: int) -> int:
    """The least overlap of a set of n with any set it links to."""
    return -(-PERCENT * n // 100)


def shared_in_prefix(n: int) -> int:
    """How many shared shingles the prefix of a set of n is long enough to hold."""
    return min(required(n), 2 + n // 16)


def prefix_length(n: int) -> int:
    return n - required(n) + shared_in_prefix(n)


def needed(n: int, m: int) -> int:
    """How many shingles two sets of n and m that link must share inside their prefixes.

    The shared shingles that are missing in the prefixes lie behind the end of the prefix that ends first, so they are at
    most as many as that set has left there.
    """
    overlap = -(-PERCENT * (n + m) // (100 + PERCENT))
    return max(shared_in_prefix(min(n, m)), overlap - max(n - prefix_length(n), m - prefix_length(m)))


def _needed(n: Column, m: Column) -> Column:
    overlap = F.ceil((n + m) * PERCENT / (100 + PERCENT)).cast("int")
    left = lambda x: _required(x) - _shared_in_prefix(x)
    return F.greatest(_shared_in_prefix(F.least(n, m)), overlap - F.greatest(left(n), left(m)))


def _required(n: Column) -> Column:
    return F.ceil(n * PERCENT / 100).cast("int")


def _shared_in_prefix(n: Column) -> Column:
    return F.least(_required(n), F.floor(n / 16).cast("int") + 2)


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """Which of the BITS classes of shingles the set has, as 64-bit integers."""
    held = np.zeros(BITS, np.uint8)
    held[shingles & (BITS - 1)] = 1
    return np.packbits(held).view(np.int64)


def frequent_shingles(docs: DataFrame) -> np.ndarray:
    """Shingles of several sampled documents, the most frequent MAX_FREQUENT of them at most, sorted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for text in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(text.as_py(), powers))], names=["shingle"])

    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0).select("text").mapInArrow(run, "shingle long")
    counts = sample.groupBy("shingle").agg(F.count("*").alias("c")).where(F.col("c") >= FREQUENT_FROM)
    found = counts.orderBy(F.desc("c"), "shingle").limit(MAX_FREQUENT).select("shingle").collect()
    return np.sort(np.array([row.shingle for row in found], np.int64))


def prefix(shingles: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The first shingles of a sorted set in the common order: by value, frequent ones last."""
    size = prefix_length(len(shingles))
    if not len(frequent):
        return shingles[:size]
    place = np.minimum(np.searchsorted(frequent, shingles), len(frequent) - 1)
    late = frequent[place] == shingles
    first = shingles[~late]
    return first[:size] if len(first) >= size else np.concatenate((first, shingles[late]))[:size]


def sets(docs: DataFrame) -> DataFrame:
    """doc_id, n, print (a 128-bit hash of the set), bitmap and prefix of each row's shingle set."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shipped = ship(docs.sparkSession, frequent_shingles(rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, frequent = Powers(), unpack(shipped)
        for batch in batches:
            n, prints, bitmaps, prefixes = [], [], [np.zeros(0, np.int64)], []
            for text in batch.column(1):
                found = shingle_set(text.as_py(), powers)
                n.append(len(found))
                prints.append(xxhash.xxh3_128_digest(found.tobytes()))
                bitmaps.append(bitmap(found))
                prefixes.append(prefix(found, frequent))
            lengths = np.concatenate(([0], np.cumsum([len(p) for p in prefixes], dtype=np.int64)))
            values = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
            words = np.arange(len(n) + 1, dtype=np.int32) * (BITS // 64)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(n, pa.int32()), pa.array(prints, pa.binary()),
                pa.ListArray.from_arrays(pa.array(words), pa.array(np.concatenate(bitmaps))),
                pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(values)),
            ], names=["doc_id", "n", "print", "bits", "prefix"])

    return rows.mapInArrow(run, "doc_id long, n int, print binary, bits array<long>, prefix array<long>")


def full_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(node, shingles) of the documents whose id is in `ids` (node), one row per distinct node and set."""
    ids = ids.distinct()
    if ids.count() <= MAX_BROADCAST_IDS:
        ids = F.broadcast(ids)
    rows = docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(ids, "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            found = [shingle_set(text.as_py(), powers) for text in batch.column(1)]
            offsets = np.concatenate(([0], np.cumsum([len(f) for f in found], dtype=np.int64)))
            values = np.concatenate(found) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))], names=["node", "shingles"]
            )

    return rows.select("node", "text").mapInArrow(run, "node long, shingles array<long>")


def verified(docs: DataFrame, pairs: DataFrame, folder: str) -> DataFrame:
    """The pairs (a, b) that link by their exact sets. Only documents in some pair are read again and shuffled."""
    spark = docs.sparkSession
    pairs.write.parquet(f"{folder}-pairs")
    pairs = spark.read.parquet(f"{folder}-pairs")
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
    full_sets(docs, nodes).write.parquet(f"{folder}-sets")
    held = spark.read.parquet(f"{folder}-sets")
    joined = pairs.join(held.select(F.col("node").alias("a"), F.col("shingles").alias("of_a")), "a").join(
        held.select(F.col("node").alias("b"), F.col("shingles").alias("of_b")), "b"
    )
    both = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - both
    joined.where(100 * both >= PERCENT * union).select("a", "b").write.parquet(f"{folder}-links")
    return spark.read.parquet(f"{folder}-links")


def may_link(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """The pairs (a, b, ...) whose bitmaps leave open that they link; `marks` is (node, n, bits) of every document.

    An id with several texts has several bitmaps, and a pair stays if any two of them leave it open.
    """
    marks = marks.select("node", F.struct("n", "bits").alias("mark"))
    if marks.count() <= MAX_BROADCAST_BITMAPS:
        marks = F.broadcast(marks)
    both = pairs.join(marks.select(F.col("node").alias("a"), F.col("mark").alias("_of_a")), "a")
    both = both.join(marks.select(F.col("node").alias("b"), F.col("mark").alias("_of_b")), "b")

    def only_in(one: str, other: str) -> Column:
        apart = [F.bit_count(F.col(one)["bits"][i].bitwiseAND(F.bitwise_not(F.col(other)["bits"][i]))) for i in range(BITS // 64)]
        return reduce(add, apart)

    n, m = F.col("_of_a.n"), F.col("_of_b.n")
    overlap = F.ceil((n + m) * PERCENT / (100 + PERCENT))
    return both.where((only_in("_of_a", "_of_b") <= n - overlap) & (only_in("_of_b", "_of_a") <= m - overlap)).select(*pairs.columns)


def _close_sizes(n: Column, m: Column) -> Column:
    return (100 * F.least(n, m) >= PERCENT * F.greatest(n, m))


def t_occurrence(lists: list[list[int]], needed: int) -> dict[int, int]:
    """Members of sorted lists with their counts, for those in at least `needed` (1 or more) of the lists.

    The longest lists, fewer than `needed`, are set aside. The short ones are merged by a heap; a member that can still
    reach `needed` is looked up in each long list by binary search.
    """
    lists = sorted(lists, key=len)
    n_long = min(needed - 1, len(lists) - 1) if len(lists) > 1 else 0
    # Long lists are worth probing only if they are clearly longer than those merged.
    while n_long and len(lists[len(lists) - n_long]) < 2 * len(lists[0]):
        n_long -= 1
    short, long = lists[:len(lists) - n_long], lists[len(lists) - n_long:]
    found = {}
    for member, copies in groupby(heapq.merge(*short)):
        count = sum(1 for _ in copies)
        if count + n_long < needed:
            continue
        for i, members in enumerate(long):
            at = bisect_left(members, member)
            count += at < len(members) and members[at] == member
            if count + len(long) - i - 1 < needed:
                break
        if count >= needed:
            found[member] = count
    return found


def _proposed(rows: DataFrame) -> DataFrame:
    """(a, b, c): each node of `rows` (node, n, leaders per list) with the leaders it shares enough lists with, c of them."""
    leaders = rows.select("node", "n", F.explode("leaders").alias("leader")).where(F.col("leader.node") != F.col("node"))
    counted = leaders.groupBy(F.col("node").alias("a"), F.col("leader.node").alias("b")).agg(
        F.count("*").alias("c"), F.first("n").alias("n"), F.first("leader.n").alias("m")
    )
    return counted.where(_close_sizes(F.col("n"), F.col("m")) & (F.col("c") >= _needed(F.col("n"), F.col("m")))).select("a", "b", "c")


def _leaders(rows: DataFrame, salts: range, eligible: Column | None = None) -> DataFrame:
    """(hash, leaders): of each list the members with the smallest hash of their id, one for each salt."""
    def least(salt: int) -> Column:
        member = F.struct(F.xxhash64("node", F.lit(salt)).alias("h"), "node", "n")
        return F.min(member if eligible is None else F.when(eligible, member)).alias(f"l{salt}")

    chosen = F.array_distinct(F.array(*[F.struct(F.col(f"l{s}.node"), F.col(f"l{s}.n")) for s in salts]))
    return rows.groupBy("hash").agg(*[least(s) for s in salts]).select("hash", chosen.alias("leaders"))


def _open_rows(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of lists whose members are of several components, with the component (`group`) of each member and the
    largest one of the list (`most`). Components are in order of size, then name."""
    labels = labels.join(labels.groupBy("component").agg(F.count("*").alias("size")), "component")
    rows = shared.join(labels, "node", "left")
    rows = rows.withColumn("group", F.struct(F.coalesce("size", F.lit(1)).alias("size"), F.coalesce("component", "node").alias("component")))
    rows = rows.drop("component", "size")
    lists = rows.groupBy("hash").agg(F.min("group").alias("least"), F.max("group").alias("most")).where("least <> most")
    return rows.join(lists.select("hash", "most"), "hash")


def _proposed_again(shared: DataFrame, labels: DataFrame, folder: str) -> DataFrame:
    """Pairs of documents that no leader has joined with other leaders, from the largest component of each list."""
    _open_rows(shared, labels).write.parquet(f"{folder}-rows")
    rows = shared.sparkSession.read.parquet(f"{folder}-rows")
    leaders = _leaders(rows, range(LEADERS, LEADERS + LATE_LEADERS), F.col("group") == F.col("most"))
    return _proposed(rows.where("group <> most").join(leaders, "hash")).select("a", "b")


Lists = list[tuple[list[int], list[int], list[bool], bool]]


def left_out(least: int) -> int:
    """How many of its longest lists a heavy document need not fetch: two of the shared ones are still among the others."""
    return max(0, least - 2)


def counted(n: int, n_long: int, heavy: bool, lists: Lists) -> Iterator[tuple[int, int, int, int]]:
    """(other, wanted, count, open lists) of the members of the lists (nodes, sizes, heavy, long) of one document.

    Long lists are complete only between two heavy documents, but for the longest that a heavy one leaves out, which are
    counted as shared. For any other pair the short lists are counted, and the long lists of the asker stay open.
    """
    least = shared_in_prefix(required(n))
    sizes, heavies = {}, set()
    for nodes, their_sizes, are_heavy, _ in lists:
        sizes.update(zip(nodes, their_sizes))
        if heavy:
            heavies.update(compress(nodes, are_heavy))
    if heavy:
        both = [sorted(compress(nodes, are_heavy)) for nodes, _, are_heavy, _ in lists]
        for other, count in t_occurrence([x for x in both if x], max(1, least - left_out(least))).items():
            yield other, needed(n, sizes[other]), count + left_out(least), 0
    short = [sorted(y for y in nodes if y not in heavies) for nodes, _, _, is_long in lists if not is_long]
    for other, count in t_occurrence([x for x in short if x], max(1, least - n_long)).items():
        yield other, needed(n, sizes[other]), count, n_long


def _askers(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, bool, Lists]]:
    """(node, n, n_long, heavy, lists) of each row; members are taken out of the flat arrays of the batch."""
    node, n, n_long, heavy = (batch.column(c).to_pylist() for c in ("node", "n", "n_long", "heavy"))
    of_row = batch.column("lists")
    found = of_row.flatten()
    nodes, sizes, are_heavy, is_long = (found.field(i) for i in range(4))
    bounds = [0, *np.cumsum(nodes.value_lengths().to_numpy(zero_copy_only=False)).tolist()]
    nodes, sizes, are_heavy = (x.flatten().to_numpy(zero_copy_only=False) for x in (nodes, sizes, are_heavy))
    is_long, at = is_long.to_pylist(), 0
    for i, k in enumerate(of_row.value_lengths().to_pylist()):
        spans = [slice(bounds[j], bounds[j + 1]) for j in range(at, at + k)]
        lists = [(nodes[x].tolist(), sizes[x].tolist(), are_heavy[x].tolist(), is_long[j]) for j, x in enumerate(spans, at)]
        yield node[i], n[i], n_long[i], heavy[i], lists
        at += k


def _remaining(shared: DataFrame, labels: DataFrame, marks: DataFrame, folder: str) -> DataFrame:
    """Pairs (a, b) of different components that reach the required count in their prefixes, by T-occurrence search."""
    spark = shared.sparkSession
    rows = _open_rows(shared, labels)
    # Documents whose long lists alone might hold all shared shingles of a pair.
    is_long = F.col("members") > LONG
    by_node = rows.groupBy("node").agg(
        F.sum(is_long.cast("int")).alias("n_long"), F.first("n").alias("_n"),
        F.sort_array(F.collect_list(F.when(is_long, F.struct("members", "hash"))), asc=False).alias("_long"),
    )
    least = _shared_in_prefix(_required(F.col("_n")))
    by_node = by_node.withColumn("heavy", F.col("n_long") >= least).select(
        "node", "n_long", "heavy", F.sort_array("_long.hash").alias("long_lists"),
        F.when(F.col("heavy"), F.slice("_long.hash", 1, F.greatest(least - 2, F.lit(0)))).alias("left_out"),
    )
    by_node.write.parquet(f"{folder}-nodes")
    by_node = spark.read.parquet(f"{folder}-nodes")
    rows = rows.join(by_node.select("node", "n_long", "heavy"), "node").where(~is_long | F.col("heavy"))
    rows.write.parquet(f"{folder}-rows")
    rows = spark.read.parquet(f"{folder}-rows")
    member = F.struct("node", "n", "group", "heavy")
    part = F.pmod(F.xxhash64("node"), F.ceil(F.col("members") / CHUNK))
    lists = rows.groupBy("hash", part.alias("part")).agg(F.collect_list(member).alias("list"))
    # Smaller components ask larger ones; the largest of a list asks nobody.
    asking = rows.where("group <> most").select("hash", "members", "node", "n", "n_long", "heavy", "group")
    asking = asking.join(by_node.where("heavy").select("node", F.explode("left_out").alias("hash")), ["node", "hash"], "left_anti")
    fetched = asking.join(lists, "hash").withColumn(
        "list", F.filter("list", lambda x: (x.group > F.col("group")) & _close_sizes(x.n, F.col("n")))
    ).where(F.size("list") > 0)
    # Nodes and sizes side by side, so that a task reads plain arrays.
    columns = F.struct(
        F.col("list.node").alias("nodes"), F.col("list.n").alias("sizes"), F.col("list.heavy").alias("heavy"),
        (F.col("members") > LONG).alias("long"),
    )
    fetched = fetched.groupBy("node", "n", "n_long", "heavy").agg(F.collect_list(columns).alias("lists"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            for node, n, n_long, heavy, lists in _askers(batch):
                for other, wanted, count, open_lists in counted(n, n_long, heavy, lists):
                    if count + open_lists >= wanted:
                        out[0].append(node)
                        out[1].append(other)
                        out[2].append(wanted - count if open_lists else 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32())], names=["a", "b", "missing"]
            )

    may_link(fetched.mapInArrow(run, "a long, b long, missing int"), marks).write.parquet(f"{folder}-near")
    near = spark.read.parquet(f"{folder}-near")
    # What the short lists left open, the long lists of both documents must hold.
    of_a = by_node.select(F.col("node").alias("a"), F.col("long_lists").alias("long_a"))
    of_b = by_node.select(F.col("node").alias("b"), F.col("long_lists").alias("long_b"))
    looked_up = near.where("missing > 0").join(of_a, "a").join(of_b, "b")
    found = looked_up.where(F.size(F.array_intersect("long_a", "long_b")) >= F.col("missing"))
    return near.where("missing <= 0").select("a", "b").unionByName(found.select("a", "b")).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of each row of `docs` (doc_id, text; other columns are ignored).

    A NULL text has no shingles. Rows without shingles link with nothing and are their own component; rows with a NULL
    doc_id link with nothing either and have no component. Repeated rows share a component. If one id has several
    texts, they are one document, which has the links of each of them.
    """
    spark = docs.sparkSession
    folder = work_dir(spark, "jaccard")
    sets(docs).write.parquet(f"{folder}/sets")
    found = spark.read.parquet(f"{folder}/sets")
    indexed = found.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    nodes = indexed.groupBy("print").agg(F.min("doc_id").alias("node"))
    nodes.write.parquet(f"{folder}/nodes")
    nodes = spark.read.parquet(f"{folder}/nodes")
    first_copies = F.broadcast(nodes) if nodes.count() <= MAX_BROADCAST_IDS else nodes
    firsts = indexed.withColumnRenamed("doc_id", "node").join(first_copies, ["node", "print"], "left_semi")
    # Lists of one member are most of the index; counts alone decide which lists are worth more columns.
    postings = firsts.select("node", "n", F.explode("prefix").alias("hash"))
    counts = postings.groupBy("hash").agg(F.count("*").alias("members")).where("members > 1")
    postings.join(counts, "hash").write.parquet(f"{folder}/shared")
    shared = spark.read.parquet(f"{folder}/shared")
    proposed = _proposed(shared.join(_leaders(shared, range(LEADERS)), "hash"))
    proposed.write.parquet(f"{folder}/proposed")
    ranked = Window.partitionBy("a").orderBy(F.desc("c"), "b")
    proposed = spark.read.parquet(f"{folder}/proposed").withColumn("turn", F.row_number().over(ranked))
    first = verified(docs, proposed.where("turn = 1").select("a", "b"), f"{folder}/first")
    linked = first.select("a").unionByName(first.select(F.col("b").alias("a"))).distinct()
    rest = proposed.where("turn > 1").join(linked, "a", "left_anti").select("a", "b")
    links = first.unionByName(verified(docs, rest, f"{folder}/second"))
    labels = connected(links)
    marks = firsts.select("node", "n", "bits")
    again = may_link(_proposed_again(shared, labels, f"{folder}/again"), marks)
    links = links.unionByName(verified(docs, again, f"{folder}/later"))
    labels = connected(links)
    found_late = verified(docs, _remaining(shared, labels, marks, f"{folder}/open"), f"{folder}/third")
    labels = connected(links.unionByName(found_late)).withColumnRenamed("component", "component_id")

    named = nodes.select("print", "node").join(labels, "node", "left").select(
        "print", F.coalesce("component_id", "node").alias("component_id")
    )
    out = found.select("doc_id", "n", "print").join(named, "print", "left")
    own = F.when(F.col("doc_id").isNull(), F.lit(None)).when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), own.cast("long").alias("component_id"))
