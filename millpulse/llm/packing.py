"""Best-fit packing into sequences of several permitted lengths.

Documents are cut into pieces of at most the largest length. Full pieces fill a sequence of their own; the rest are
packed best-fit, largest first, inside blocks of bounded size. A piece that fits no open bin opens one, of the permitted length
that costs least per token once the pieces still waiting have filled it and it has been downsized. At the end each bin is
downsized to the smallest length that holds its contents. Runs with one least length for all bins bound the cost: the
cheapest outcome stands.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millpulse.llm.text import words

CAPACITIES = (512, 1024, 2048, 4096, 8192)
BIN_OVERHEAD = 64  # what a sequence costs besides its length
BLOCK_ITEMS = 20_000
COPIES = 1_000  # copies of one row numbered at a time
SCHEMA = "doc_id long, piece int, start long, n_tokens int, bin_id string, capacity int, offset int"


def bin_cost(capacity: int) -> int:
    return capacity + BIN_OVERHEAD


def opening_size(size: int, capacities: tuple[int, ...], counts: list[int], waiting: int) -> int:
    """The length to open for an item: that of the least cost per token when the largest waiting items that fit fill it.

    `counts` holds the waiting items by size, and a set bit of `waiting` marks a size that has some. Equal costs go to the
    smaller length.
    """
    best = None
    for capacity in capacities:
        if capacity < size:
            continue
        used, limit = size, capacity - size
        while fitting := waiting & ((2 << limit) - 1):
            other = fitting.bit_length() - 1
            used += other * min(counts[other], (capacity - used) // other)
            limit = min(other - 1, capacity - used)
        cost = bin_cost(next(c for c in capacities if c >= used))
        if best is None or cost * best[1] < best[0] * used:
            best = cost, used, capacity
    return best[2]


def _fit(sizes: list[int], capacities: tuple[int, ...], least: int | None) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each item, and the used length of each bin; items come largest first.

    Open bins are kept by their free space; a set bit of `spaces` marks a space that some bin has, so the tightest
    bin is the lowest set bit from the item's size on. Without a `least` length each bin is opened at its own least cost.
    """
    free: list[list[int]] = [[] for _ in range(capacities[-1] + 1)]
    spaces, bins, offsets, used, opened = 0, [], [], [], []
    counts, waiting = [0] * (capacities[-1] + 1), 0
    for size in sizes if least is None else ():
        counts[size] += 1
        waiting |= 1 << size
    for size in sizes:
        if least is None:
            counts[size] -= 1
            if not counts[size]:
                waiting ^= 1 << size
        fitting = spaces >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            b = free[space].pop()
            if not free[space]:
                spaces ^= 1 << space
        else:
            if least is None:
                space = opening_size(size, capacities, counts, waiting)
            else:
                space = next(c for c in capacities if c >= size and c >= least)
            b = len(used)
            used.append(0)
            opened.append(space)
        bins.append(b)
        offsets.append(used[b])
        used[b] += size
        left = opened[b] - used[b]
        if left:
            free[left].append(b)
            spaces |= 1 << left
    return bins, offsets, used


def pack_block(sizes: list[int], capacities: tuple[int, ...] = CAPACITIES) -> tuple[list[int], list[int], list[int]]:
    """Bin, offset and final capacity of each item of one block, in the order given.

    Items hold one token or more. Equal costs go to the bins opened at their own least cost, then to the smaller opening size;
    equal sizes to the earlier item.
    """
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    largest_first = [sizes[i] for i in order]
    best = None
    for least in (None, *capacities):
        bins, offsets, used = _fit(largest_first, capacities, least)
        final = [next(c for c in capacities if c >= u) for u in used]
        cost = sum(map(bin_cost, final))
        if best is None or cost < best[0]:
            best = cost, bins, offsets, final
    bin_of, offset_of, capacity_of = [0] * len(sizes), [0] * len(sizes), [0] * len(sizes)
    if best:
        for i, b, o in zip(order, best[1], best[2]):
            bin_of[i], offset_of[i], capacity_of[i] = b, o, best[3][b]
    return bin_of, offset_of, capacity_of


def token_count(text: str = "text") -> Column:
    """Words and one end mark; 1 for an empty or NULL text."""
    return F.size(words(F.col(text))) + 1


def pieces(docs: DataFrame, n_tokens: Column, largest: int) -> DataFrame:
    """One row per piece of each document; every row of `docs` has at least one piece.

    `_row` tells rows of one id apart, by their length and a number among rows of that length. Such rows are alike to the
    packing, so they are counted and numbered; nothing depends on the order in which rows are read.
    """
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.greatest(n_tokens, F.lit(1)).cast("long").alias("_n"))
    sized = sized.groupBy("doc_id", "_n").agg(F.count("*").alias("_copies"))
    sized = sized.withColumn("_turn", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_copies") - 1) / COPIES))))
    first = F.col("_turn") * COPIES
    sized = sized.withColumn("_copy", F.explode(F.sequence(first, F.least(first + COPIES, F.col("_copies")) - 1)))
    sized = sized.withColumn("_row", F.concat_ws("-", "_n", "_copy"))
    cut = F.transform(
        F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / largest)),
        lambda k: F.struct(
            k.cast("int").alias("piece"), (k * largest).alias("start"),
            F.least(F.lit(largest), F.col("_n") - k * largest).cast("int").alias("n_tokens"),
        ),
    )
    return sized.select("doc_id", "_row", F.explode(cut).alias("p")).select("doc_id", "_row", "p.*")


def pack(
    docs: DataFrame, n_tokens: Column | None = None, capacities: tuple[int, ...] = CAPACITIES, block_items: int = BLOCK_ITEMS
) -> DataFrame:
    """Where each piece of each document goes; columns as in SCHEMA.

    `docs` needs a doc_id; by default the tokens of its text are counted. Documents with NULL ids or repeated rows are
    placed like any other. Only lengths are shuffled. A block holds about `block_items` pieces, chosen by a hash of the
    id, the length, the number among copies and the piece, so copies and long documents spread over the blocks and a task
    that runs again makes the same blocks.
    """
    capacities = tuple(sorted(set(capacities)))
    largest = capacities[-1]
    rows = pieces(docs, token_count() if n_tokens is None else n_tokens, largest)
    full = rows.where(F.col("n_tokens") == largest).select(
        "doc_id", "piece", "start", "n_tokens",
        F.concat_ws("-", F.lit("full"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "_row", "piece").alias("bin_id"),
        F.lit(largest).alias("capacity"), F.lit(0).alias("offset"),
    )
    open_pieces = rows.where(F.col("n_tokens") < largest)
    n_blocks = max(1, -(-docs.count() // block_items))
    blocked = open_pieces.withColumn("block", F.pmod(F.xxhash64("doc_id", "_row", "piece"), F.lit(n_blocks)))

    def pack_group(block: pa.Table) -> pa.Table:
        block = block.sort_by([("n_tokens", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("_row", "ascending")])
        bins, offsets, final = pack_block(block["n_tokens"].to_pylist(), capacities)
        prefix = f"{block['block'][0].as_py()}-" if block.num_rows else ""
        return pa.table({
            **{name: block[name] for name in ("doc_id", "piece", "start", "n_tokens")},
            "bin_id": [f"{prefix}{b}" for b in bins],
            "capacity": pa.array(final, pa.int32()), "offset": pa.array(offsets, pa.int32()),
        })

    return full.unionByName(blocked.groupBy("block").applyInArrow(pack_group, SCHEMA))
