"""Language-model scores from a hashed maximum-entropy model.

The softmax is factored by classes: words are put into classes by the words beside them, classes into classes, and so
on, at most FAN to each. The probability of a word is the product of the probabilities of the choices on its path. Each
choice is a softmax over features of the tokens before it, hashed with the class into one table per feature: the last
word, the last two, and the word before the last (a skip).

Frequent words have a place of their own. The others share places by their last bytes, and divide a place by their counts,
with a share for words never seen in training.

Every text is turned into word ids once, and these are stored. Counts and contexts cover every training token. Training is one pass of gradient steps over all of them: each task improves
a copy of the weights on its own rows, and the copies are averaged in Spark, row by row, weighted by how often a row was used.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millpulse.llm.ship import batches_of, ship, unpack
from millpulse.llm.text import crc_remainder
from millpulse.session import work_dir

FOLDS, HELD_OUT = 10, 0
# Sizes of the model. They grow with the corpus up to these bounds, so what is broadcast is bounded.
HEAD_WORDS = 200_000  # words whose count every task knows, and that are told apart as contexts
LEAVES = 1 << 16  # words with a place of their own
TAILS = 64  # places that all other words share
TAIL_BYTES = 2
FAN = 16
FEATURES = 3
MAX_ROW_BITS = 17
SIDES = 32  # kinds of neighbours told apart on each side of a word when classes are formed
STEP = 0.5
BATCH_TOKENS = 1 << 15
FIRST_STEP_TOKENS, STEP_GROWTH = 512, 1.2  # steps are taken over few tokens at first, later over a batch
FLUSH_WORDS = 200_000
BATCH_ROWS = 512  # texts that Spark and a Python worker hold at a time
END = b""  # the end token; no word is empty
BLOCK_ROWS = 1_024  # rows of a weight table averaged together
COPY_GROUPS = 8  # copies of a block are added in so many groups first
MIN_COPY_TOKENS, COPY_TOKENS = 1 << 20, 1 << 22  # a copy of the weights learns from at least so many tokens: with idle cores, else
SHORT_RUN = 8  # rows of a run that are added one after the other

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def tokens(text: bytes | None) -> list[bytes]:
    """Words in lower case (A-Z only), then the end. `bytes.split` cuts at exactly the blanks 0x20 and 0x09-0x0D."""
    found = (text or b"").lower().split()
    found.append(END)
    return found


def shared_leaf(word: bytes) -> int:
    return zlib.crc32(word[-TAIL_BYTES:]) % TAILS


class Ids(dict):
    """Ids of the head words as contexts; words outside the head share an id per shared leaf."""

    def __missing__(self, word: bytes) -> int:
        return len(self) + shared_leaf(word)


@dataclass
class Model:
    counts: dict[bytes, int]
    n_tokens: int
    n_words: int
    n_own: int  # the first words of `counts` have leaves of their own, before the shared ones
    ids: Ids = field(default_factory=Ids)
    n_head: int = 0
    leaf_of: np.ndarray | None = None  # by id
    rest_tokens: np.ndarray | None = None  # training tokens of each shared leaf
    unseen: np.ndarray | None = None  # share of it that words never seen have
    # The path of leaf i is choices[first[i]:first[i] + depth[i]]; a choice is class * FAN + place.
    choices: np.ndarray | None = None
    first: np.ndarray | None = None
    depth: np.ndarray | None = None
    bias: np.ndarray | None = None  # by class and place, log probabilities without context
    row_bits: int = 0
    weights: np.ndarray | None = None  # None: all zero

    def tail(self, word: bytes) -> int:
        return shared_leaf(word)

    def leaf(self, word: bytes) -> int:
        at = self.ids.get(word, self.n_own)
        return at if at < self.n_own else self.n_own + self.tail(word)

    def without_words(self) -> Model:
        """What is needed once texts are ids: no word of the head, which would be most of the memory of a worker."""
        return replace(self, counts={}, ids=Ids())

    def encode(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.ids.__getitem__, words), np.int32, len(words))

    def lay_out(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows id and leaf of the tokens of some texts, each text after three tokens that stand for its start; the positions
        of the real tokens; the lengths of the texts."""
        lengths = np.array([len(t) for t in texts])
        ids = np.full(lengths.sum() + 3 * len(texts), self.n_head + TAILS)
        real = np.ones(len(ids), bool)
        real[((np.cumsum(lengths + 3) - lengths - 3)[:, None] + np.arange(3)).ravel()] = False
        keep = np.flatnonzero(real)
        ids[keep] = np.concatenate(texts)
        return np.stack([ids, self.leaf_of[ids]]), keep, lengths


@dataclass
class Steps:
    """All choices on the paths of some tokens."""

    token: np.ndarray  # which token
    starts: np.ndarray  # where the choices of each token begin
    cls: np.ndarray
    place: np.ndarray
    rows: list[np.ndarray]  # the row of each feature's table, all tables in one


def contexts(ids: np.ndarray, keep: np.ndarray) -> list[np.ndarray]:
    """One hash per feature of the tokens before each kept one."""
    w1, w2 = ((ids[keep - back].astype(np.uint64) + np.uint64(1)) * _MIX[back - 1] for back in (1, 2))
    return [w1, (w1 ^ w2) * _MIX[3], w2 * _MIX[3]]


def steps(model: Model, coded: np.ndarray, keep: np.ndarray) -> Steps:
    leaf = coded[1][keep]
    depth = model.depth[leaf]
    starts = np.cumsum(depth) - depth
    token = np.repeat(np.arange(len(keep)), depth)
    choice = model.choices[np.arange(len(token)) + (model.first[leaf] - starts)[token]]
    cls = choice // FAN
    salt = (cls.astype(np.uint64) + np.uint64(1)) * _MIX[2]
    rows = []
    for number, context in enumerate(contexts(coded[0], keep)):
        x = context[token] ^ salt
        x ^= x >> np.uint64(31)
        x *= _MIX[0]
        rows.append((x >> np.uint64(64 - model.row_bits)).astype(np.int64) + (number << model.row_bits))
    return Steps(token, starts, cls, choice % FAN, rows)


def _powers(model: Model, weights: np.ndarray, some: Steps) -> tuple[np.ndarray, np.ndarray]:
    """Unnormalised probabilities of all places at each choice, and their sums. Logits are near log-probabilities, so a
    cap far above them is all that exp needs."""
    out = model.bias.take(some.cls, axis=0)
    for rows in some.rows:
        out += weights.take(rows, axis=0)
    np.minimum(out, 40.0, out=out)
    np.exp(out, out=out)
    return out, out @ np.ones(FAN, out.dtype)


def log_probabilities(model: Model, coded: np.ndarray, keep: np.ndarray) -> np.ndarray:
    """log10 of the probability of the leaf of each kept token."""
    out = np.empty(len(keep))
    for at in range(0, len(keep), BATCH_TOKENS):
        some = steps(model, coded, keep[at:at + BATCH_TOKENS])
        powers, total = _powers(model, model.weights, some)
        chosen = powers[np.arange(len(total)), some.place] / total
        out[at:at + BATCH_TOKENS] = np.add.reduceat(np.log10(np.maximum(chosen, 1e-12).astype(float)), some.starts)
    return out


class Trainer:
    """Gradient steps on one copy of the weights, with a step per row that shrinks with the gradients it has seen."""

    def __init__(self, model: Model):
        self.model = model
        n = FEATURES << model.row_bits
        self.weights = np.zeros((n, FAN), np.float32)
        self.power = np.full(n, 1e-3, np.float32)
        self.used = np.zeros(n, np.int32)

    def step(self, coded: np.ndarray, keep: np.ndarray) -> None:
        some = steps(self.model, coded, keep)
        gradient, total = _powers(self.model, self.weights, some)
        gradient *= (1.0 / total)[:, None]
        gradient[np.arange(len(total)), some.place] -= 1
        number = np.arange(len(total))
        bits = max(1, int(len(total)).bit_length())
        for rows in some.rows:
            ordered = np.sort(rows << bits | number)  # sorting whole numbers is faster than sorting positions
            order, ordered = ordered & (1 << bits) - 1, ordered >> bits
            starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
            touched = ordered[starts]
            lengths = np.diff(np.append(starts, len(ordered)))
            pull = _run_sums(gradient, order, starts, lengths)
            self.used[touched] += lengths.astype(np.int32)
            grown = self.power[touched] + np.einsum("ij,ij->i", pull, pull)
            self.power[touched] = grown
            pull *= (STEP / np.sqrt(grown))[:, None]
            self.weights[touched] -= pull


def _run_sums(rows: np.ndarray, order: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The sum of each run of rows[order]. Most runs are short, and `reduceat` is slow for those; the order of additions is its own."""
    out = rows.take(order[starts], axis=0)
    short = np.flatnonzero((lengths > 1) & (lengths <= SHORT_RUN))
    others = rows.take(order[starts[short] + 1], axis=0)
    for k in range(2, SHORT_RUN):
        more = np.flatnonzero(lengths[short] > k)
        others[more] += rows.take(order[starts[short[more]] + k], axis=0)
    out[short] += others
    long = np.flatnonzero(lengths > SHORT_RUN)
    if len(long):
        ends = np.cumsum(lengths[long])
        inside = np.repeat(starts[long] - (ends - lengths[long]), lengths[long]) + np.arange(ends[-1])
        out[long] = np.add.reduceat(rows.take(order[inside], axis=0), ends - lengths[long], axis=0)
    return out


def _token_batches(model: Model, texts: Iterator[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Coded tokens, the positions of real tokens among them, and the lengths of their texts, about BATCH_TOKENS at a time."""
    waiting, size = [], 0
    for ids in texts:
        waiting.append(ids)
        size += len(ids)
        if size >= BATCH_TOKENS:
            yield model.lay_out(waiting)
            waiting, size = [], 0
    if waiting:
        yield model.lay_out(waiting)


def _coded(model: Model, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    return model.lay_out([model.encode(words) for words in texts])[:2]


def _ids(column: pa.Array) -> Iterator[np.ndarray]:
    return (np.frombuffer(x.as_py(), np.int32) for x in column)


def count_words(train: DataFrame) -> DataFrame:
    """(word, c) of all tokens of the training rows; the end token is the empty word. Tasks send partial counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "c"]
            )
            counts.clear()
            return out

        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                counts.update(tokens(text.as_py()))
                if len(counts) >= FLUSH_WORDS:
                    yield flush()
        yield flush()

    parts = train.select("text").mapInArrow(run, "word string, c long")
    return parts.groupBy("word").agg(F.sum("c").alias("c"))


def _head(counts: DataFrame, kinds: np.ndarray, words: np.ndarray) -> pa.Table:
    """The most frequent words, ties by word. `words` have each of the `kinds` of counts, which say where the head ends; so only
    words at its end are put in order by Spark, and no task meets more than the head."""
    order = np.argsort(-kinds)
    upto = np.cumsum(words[order])
    whole = int(np.searchsorted(upto, HEAD_WORDS, side="right"))  # kinds all of whose words belong to the head
    some = counts
    if whole < len(kinds):
        last, left = int(kinds[order[whole]]), HEAD_WORDS - int(upto[whole - 1] if whole else 0)
        some = counts.where(F.col("c") > last)
        if left:
            some = some.unionByName(counts.where(F.col("c") == last).orderBy("word").limit(left))
    return some.toArrow().sort_by([("c", "descending"), ("word", "ascending")])


def prepare(counts: DataFrame) -> Model:
    """Words, places and shares from the counts. Only tables of bounded size reach the driver; there are fewer different counts
    than the root of twice the tokens."""
    kinds = counts.groupBy("c").agg(F.count("*").alias("words")).toArrow()
    kinds, words = (kinds[name].to_numpy() for name in ("c", "words"))
    head = _head(counts, kinds, words)
    names, times = head["word"].cast(pa.binary()).to_pylist(), head["c"].to_pylist()
    # The head is in order of counts, so its first words take the leaves; words seen once share theirs with unseen ones.
    n_own = sum(c > 1 for c in times[:LEAVES])
    model = Model(dict(zip(names, times)), int(kinds @ words), int(words.sum()), n_own, Ids(zip(names, range(len(names)))), len(names))
    shared = [n_own + model.tail(word) for word in names[n_own:]]
    model.leaf_of = np.array([*range(n_own), *shared, *range(n_own, n_own + TAILS), 0])
    others = counts
    if n_own:
        last, name = times[n_own - 1], F.lit(names[n_own - 1].decode("utf-8", "replace"))
        others = counts.where((F.col("c") < last) | ((F.col("c") == last) & (F.col("word") > name)))
    raw = F.col("word").cast("binary")
    ending = F.when(F.octet_length(raw) <= TAIL_BYTES, raw).otherwise(F.substring(raw, -TAIL_BYTES, TAIL_BYTES))
    shared = others.groupBy(F.pmod(F.crc32(ending), F.lit(TAILS)).cast("int").alias("tail")).agg(
        F.sum("c").alias("n"), F.sum((F.col("c") == 1).cast("long")).alias("once")
    ).collect()  # one row per shared leaf
    model.rest_tokens, once = np.zeros(TAILS), np.zeros(TAILS)
    for row in shared:
        model.rest_tokens[row["tail"]], once[row["tail"]] = row["n"], row["once"]
    model.unseen = np.where(model.rest_tokens > 0, np.minimum(0.9, (once + 0.5) / (model.rest_tokens + 1)), 1.0)
    model.row_bits = min(MAX_ROW_BITS, max(10, model.n_tokens.bit_length() - 2))
    return model


def encoded(rows: DataFrame, model: Model) -> DataFrame:
    """`rows` with `ids` (32-bit integers, one for each token) and `tail` (word, shared leaf, times: the words outside the head)
    in place of `text`."""
    shipped = ship(rows.sparkSession, model.ids)
    kept = rows.drop("text").schema.fields
    names = [*(f.name for f in kept), "ids", "tail"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = unpack(shipped)
        n_head, id_of = len(held), held.__getitem__
        for batch in batches:
            ids, tail_words, tail_times, tail_ends = [], [], [], [0]
            for text in batch.column(batch.num_columns - 1).cast(pa.binary()):
                words = tokens(text.as_py())
                found = np.fromiter(map(id_of, words), np.int32, len(words))
                ids.append(found.tobytes())
                outside = np.flatnonzero(found >= n_head)
                if len(outside):
                    times = Counter([words[i] for i in outside.tolist()])
                    tail_words += times
                    tail_times += times.values()
                tail_ends.append(len(tail_words))
            tail = pa.StructArray.from_arrays([
                pa.array(tail_words, pa.binary()).cast(pa.string()), pa.array(map(shared_leaf, tail_words), pa.int32()),
                pa.array(tail_times, pa.int32()),
            ], names=["word", "cls", "times"])
            tails = pa.ListArray.from_arrays(pa.array(tail_ends, pa.int32()), tail)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(ids, pa.binary()), tails], names=names)

    tail = T.StructType([T.StructField("word", T.StringType()), T.StructField("cls", T.IntegerType()), T.StructField("times", T.IntegerType())])
    schema = T.StructType([*kept, T.StructField("ids", T.BinaryType()), T.StructField("tail", T.ArrayType(tail))])
    return rows.select(*names[:-2], "text").mapInArrow(run, schema)


def _by_copy(rows: DataFrame, model: Model) -> DataFrame:
    """`ids` in as many partitions as copies of a table are worth, so that the copies do not outgrow what they are learned from."""
    idle = min(rows.sparkSession.sparkContext.defaultParallelism, model.n_tokens // MIN_COPY_TOKENS)
    return rows.select("ids").coalesce(max(1, idle, model.n_tokens // COPY_TOKENS))


def _side(ids: np.ndarray) -> np.ndarray:
    """The kind of a neighbour: frequent words are their own, the others are spread by hash."""
    half = SIDES // 2
    return np.where(ids < half, ids, half + (ids * 2654435761 % (1 << 32) >> 20) % half)


def neighbours(rows: DataFrame, model: Model) -> np.ndarray:
    """By leaf: how often each kind of neighbour stands before and after its words, over all `rows` (ids)."""
    shipped = ship(rows.sparkSession, model.without_words())
    n_leaves, width = model.n_own + TAILS, 2 * SIDES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = unpack(shipped)
        counts = np.zeros(n_leaves * width, np.int32)
        texts = (ids for batch in batches for ids in _ids(batch.column(0)))
        for coded, keep, _ in _token_batches(held, texts):
            ids, leaves = coded
            kinds = _side(ids)
            before = leaves[keep] * width + kinds[keep - 1]
            inner = keep[1:][np.diff(keep) == 1]
            after = leaves[inner - 1] * width + SIDES + kinds[inner]
            np.add.at(counts, before, 1)
            np.add.at(counts, after, 1)
        for block, at in enumerate(range(0, len(counts), BLOCK_ROWS * width)):
            part = counts[at:at + BLOCK_ROWS * width]
            some = np.flatnonzero(part)
            if len(some):
                yield pa.RecordBatch.from_arrays([
                    pa.array([block], pa.int32()), pa.array([some.astype(np.int32).tobytes()]), pa.array([part[some].tobytes()]),
                    pa.array([zlib.crc32(some.tobytes()) % COPY_GROUPS], pa.int32()),
                ], names=["block", "at", "n", "fan"])

    def add(copies: pa.Table) -> pa.Table:
        total = np.zeros(BLOCK_ROWS * width, np.int64)
        for at, n in zip(copies["at"], copies["n"]):
            total[np.frombuffer(at.as_py(), np.int32)] += np.frombuffer(n.as_py(), np.int32)
        total = np.minimum(total, (1 << 31) - 1).astype(np.int32)
        some = np.flatnonzero(total)
        return pa.table({"block": copies["block"].slice(0, 1), "at": [some.astype(np.int32).tobytes()], "n": [total[some].tobytes()]})

    parts = _by_copy(rows, model).mapInArrow(run, "block int, at binary, n binary, fan int")
    some = parts.groupBy("block", "fan").applyInArrow(add, "block int, at binary, n binary")
    out = np.zeros(n_leaves * width, np.float32)
    for row in some.groupBy("block").applyInArrow(add, "block int, at binary, n binary").collect():  # bounded by LEAVES
        out[row["block"] * BLOCK_ROWS * width + np.frombuffer(row["at"], np.int32)] = np.frombuffer(row["n"], np.int32)
    return out.reshape(n_leaves, width)


def _halves(some: np.ndarray, points: np.ndarray, mass: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two parts of about equal mass, cut across the direction in which the points differ most."""
    own, weight = points[some], mass[some]
    own = own - np.average(own, axis=0, weights=weight)
    scaled = own * np.sqrt(weight)[:, None]
    spread = scaled.T @ scaled
    direction = 1 + 0.01 * np.arange(len(spread))
    for _ in range(12):
        direction = spread @ direction
        length = np.linalg.norm(direction)
        if not length:
            break
        direction /= length
    ordered = some[np.lexsort((some, own @ direction))]
    filled = np.cumsum(mass[ordered])
    cut = int(np.abs(filled - filled[-1] / 2)[:-1].argmin()) + 1
    return ordered[:cut], ordered[cut:]


def form_classes(model: Model, sides: np.ndarray) -> None:
    """Classes of leaves with like neighbours, their paths, and the probabilities of the choices without context."""
    counts = np.array(list(model.counts.values())[:model.n_own], float)
    mass = np.concatenate([counts, model.rest_tokens + 0.5])
    usual = 8 * sides.sum(0) / max(1.0, float(sides.sum()))
    points = np.sqrt((sides + usual) / (sides.sum(1, keepdims=True) + max(1.0, float(usual.sum()))))
    paths: list[list[int]] = [[] for _ in mass]
    bias = []
    waiting = [np.arange(len(mass))]
    while waiting:
        some = waiting.pop()
        parts = [some]
        if len(some) <= FAN:
            parts = [some[i:i + 1] for i in range(len(some))]
        while len(parts) < min(FAN, len(some)):
            at = max((i for i, p in enumerate(parts) if len(p) > 1), key=lambda i: mass[parts[i]].sum())
            parts[at:at + 1] = _halves(parts[at], points, mass)
        row = np.full(FAN, -30.0)
        for place, part in enumerate(parts):
            row[place] = math.log(mass[part].sum() / mass[some].sum())
            for leaf in part.tolist():
                paths[leaf].append(len(bias) * FAN + place)
            if len(part) > 1:
                waiting.append(part)
        bias.append(row)
    model.bias = np.array(bias, np.float32)
    model.depth = np.array([len(p) for p in paths])
    model.first = np.cumsum(model.depth) - model.depth
    model.choices = np.array([c for p in paths for c in p])


def train(rows: DataFrame, model: Model) -> Model:
    """Classes, one pass of gradient steps over all `rows` (text, or the ids it became), and the mean of the tasks' weights."""
    if "ids" not in rows.columns:
        rows = encoded(rows.select("text"), model)
    form_classes(model, neighbours(rows, model))
    shipped = ship(rows.sparkSession, model.without_words())
    n = FEATURES << model.row_bits
    block_rows = min(BLOCK_ROWS, n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = unpack(shipped)
        trainer, size = None, FIRST_STEP_TOKENS
        texts = (ids for batch in batches for ids in _ids(batch.column(0)))
        for coded, keep, _ in _token_batches(held, texts):
            trainer = trainer or Trainer(held)
            at = 0
            while at < len(keep):
                trainer.step(coded, keep[at:at + int(size)])
                at, size = at + int(size), min(BATCH_TOKENS, size * STEP_GROWTH)
        for block in range(n // block_rows if trainer else 0):
            at = slice(block * block_rows, (block + 1) * block_rows)
            some = np.flatnonzero(trainer.used[at])
            used = trainer.used[at][some]
            yield pa.RecordBatch.from_arrays([
                pa.array([block], pa.int32()), pa.array([some.astype(np.int32).tobytes()]),
                pa.array([trainer.weights[at][some].astype(np.float16).tobytes()]), pa.array([used.tobytes()]),
                pa.array([zlib.crc32(used.tobytes()) % COPY_GROUPS], pa.int32()),
            ], names=["block", "at", "weights", "used", "fan"])

    def mean(copies: pa.Table) -> pa.Table:
        total, used = np.zeros((block_rows, FAN)), np.zeros(block_rows, np.int64)
        for at, w, u in zip(copies["at"], copies["weights"], copies["used"]):
            at, u = np.frombuffer(at.as_py(), np.int32), np.frombuffer(u.as_py(), np.int32)
            total[at] += np.frombuffer(w.as_py(), np.float16).reshape(-1, FAN) * u[:, None].astype(float)
            used[at] += u
        some = np.flatnonzero(used)
        return pa.table({
            "block": copies["block"].slice(0, 1), "at": [some.astype(np.int32).tobytes()],
            "weights": [(total[some] / used[some, None]).astype(np.float16).tobytes()], "used": [np.minimum(used[some], (1 << 31) - 1).astype(np.int32).tobytes()],
        })

    # Copies of a block are averaged in two steps, so that no task has to hold those of all tasks.
    parts = _by_copy(rows, model).mapInArrow(run, "block int, at binary, weights binary, used binary, fan int")
    some = parts.groupBy("block", "fan").applyInArrow(mean, "block int, at binary, weights binary, used binary")
    total = some.groupBy("block").applyInArrow(mean, "block int, at binary, weights binary, used binary")
    model.weights = np.zeros((n, FAN), np.float32)
    for row in total.select("block", "at", "weights").collect():  # at most FEATURES << MAX_ROW_BITS rows of FAN numbers
        at = row["block"] * block_rows + np.frombuffer(row["at"], np.int32)
        model.weights[at] = np.frombuffer(row["weights"], np.float16).reshape(-1, FAN)
    return model


def _scored(docs: DataFrame, model: Model) -> DataFrame:
    """What a task can know of each encoded row: n_tokens, and base and model score up to the words outside the head."""
    base_total = model.n_tokens + 0.1 * (model.n_words + 1)
    # By id of a head word: log count for the base, and its share of its leaf.
    counts = np.array(list(model.counts.values()), float)
    share = np.zeros(len(counts))
    for at in range(model.n_own, model.n_head):
        tail = model.leaf_of[at] - model.n_own
        share[at] = math.log10((1 - model.unseen[tail]) * counts[at] / model.rest_tokens[tail])
    shipped = ship(docs.sparkSession, (model.without_words(), np.log10(counts + 0.1), share))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, log_base, log_rest = unpack(shipped)
        n_head = held.n_head
        for batch in batches:
            n_tokens, base, score, n_head_tokens = [], [], [], []
            for coded, keep, lengths in _token_batches(held, _ids(batch.column(3))):
                log_p = log_probabilities(held, coded, keep)
                ids = coded[0][keep]
                inside = ids < n_head
                known = np.where(inside, ids, 0)
                of_base = np.where(inside, log_base[known], 0.0) if n_head else np.zeros(len(ids))
                if n_head:
                    log_p += np.where(inside, log_rest[known], 0.0)
                starts = np.cumsum(lengths) - lengths
                base += np.add.reduceat(of_base, starts).tolist()
                score += np.add.reduceat(log_p, starts).tolist()
                n_head_tokens += np.add.reduceat(inside.astype(int), starts).tolist()
                n_tokens += lengths.tolist()
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:3], pa.array(n_tokens, pa.int64()), pa.array(n_head_tokens, pa.int64()), pa.array(base, pa.float64()),
                pa.array(score, pa.float64()),
            ], names=["_row", "doc_id", "held_out", "n_tokens", "n_head", "base_part", "score_part"])

    rows = docs.select("_row", "doc_id", "held_out", "ids")
    schema = T.StructType([
        *rows.schema.fields[:3], T.StructField("n_tokens", T.LongType()), T.StructField("n_head", T.LongType()),
        T.StructField("base_part", T.DoubleType()), T.StructField("score_part", T.DoubleType()),
    ])
    out = rows.mapInArrow(run, schema)
    return out.withColumn("base_part", F.col("base_part") - F.col("n_tokens") * math.log10(base_total))


def score(docs: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row of `docs` (doc_id, text).

    Rows whose crc32(doc_id) modulo `folds` is `held_out` are not learned from; a NULL doc_id counts as an empty text.
    A NULL text is empty: its only token is the end. With nothing to learn from, all tokens are unknown words.
    """
    spark = docs.sparkSession
    folder = work_dir(spark, "lm")
    rows = docs.select("doc_id", "text")
    remainder = crc_remainder(F.col("doc_id"), folds)
    learned = rows.where(remainder != held_out)
    numbered = rows.withColumn("_row", F.monotonically_increasing_id()).withColumn("held_out", remainder == held_out)
    with batches_of(spark, BATCH_ROWS):
        count_words(learned).write.parquet(f"{folder}/counts")
        counts = spark.read.parquet(f"{folder}/counts")
        model = prepare(counts)
        encoded(numbered, model).write.parquet(f"{folder}/encoded")
        coded = spark.read.parquet(f"{folder}/encoded")
        model = train(coded.where(~F.col("held_out")), model)
        _scored(coded, model).write.parquet(f"{folder}/scored")
    scored = spark.read.parquet(f"{folder}/scored")
    # From Arrow, since a list of rows would start further Python workers beside those of the tasks.
    table = spark.createDataFrame(pa.table({"cls": pa.array(range(TAILS), pa.int32()), "unseen": model.unseen, "rest": model.rest_tokens}))
    tail = coded.select("_row", F.explode("tail").alias("t")).select("_row", "t.word", "t.cls", "t.times")
    tail = tail.join(counts, "word", "left").join(F.broadcast(table), "cls")
    c = F.coalesce("c", F.lit(0))
    rest = F.when(c > 0, F.log10((1 - F.col("unseen")) * c / F.col("rest"))).otherwise(F.log10("unseen"))
    sums = tail.groupBy("_row").agg(
        F.sum(F.col("times") * F.log10(c + 0.1)).alias("tail_base"), F.sum(F.col("times") * rest).alias("tail_score"),
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("tail_known"),
    )
    zero = F.lit(0)
    out = scored.join(sums, "_row", "left")
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_head") + F.coalesce("tail_known", zero)).cast("long").alias("n_known"),
        F.lit(model.n_tokens).cast("long").alias("train_tokens"),
        (F.col("base_part") + F.coalesce("tail_base", zero)).alias("base_score"),
        (F.col("score_part") + F.coalesce("tail_score", zero)).alias("score"),
    )
