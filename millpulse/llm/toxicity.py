"""Toxicity from two class-conditional Kneser-Ney models.

Toxic and ordinary texts each have an interpolated Kneser-Ney model of a word given the word before it. A pair's count is
discounted, and the mass that its history gives up, by its distinct continuations, goes to the word; a word counts by the
distinct words it follows and backs off to ever shorter beginnings of itself in the same way. How the mass of a beginning is
shared out below it is counted over both classes, so a rare expression is judged by what its beginning has been seen in. A
text's score compares its length-normalised log-likelihoods under the two models, over the whole text and over its most
telling stretch, through a logistic curve fitted on rows that counts of the other rows have not seen. Of an expression the log ratio counts as
far as its split over the classes is evidence, and for the rest the ratio of what it backs off to counts: nothing is cut.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millpulse.llm.ship import ship, unpack
from millpulse.llm.text import crc_remainder, lower_ascii, words

HELD_OUT_MODULUS, HELD_OUT_REMAINDER = 3, 1
# Bounds of what is learned from and of what is sent to the tasks; they do not depend on the corpus.
MAX_LABELLED = 5_000  # labelled rows of each class, taken in the order of a hash of their id
MAX_WORDS = 2_500_000  # words of these rows; no further row of the class is taken once they are reached
DISCOUNT = 0.75
EVIDENCE = 25.0  # likelihood-ratio statistic at which an expression and what it backs off to count alike
SHARPNESS = 4  # how fast that changes
LEVELS = (3, 4, 5, 6, 8, None)  # lengths of beginnings, then whole words
STRETCH = 50
THRESHOLD = 0.7
CLASSES = ("ordinary", "toxic")
EDGE_CHARS = string.punctuation
PIECE_BYTES = 2_000_000  # of text that a task scores at a time
PIECE_PAIRS = 500_000  # pairs that come to the driver at a time


@dataclass
class Model:
    """Log-likelihood ratios of expressions and word pairs, and the logistic weights.

    Expressions are words and their beginnings, found by the hash of their level and text; pairs by the places of both words.
    """

    keys: np.ndarray
    ratios: np.ndarray
    whole: np.ndarray
    pair_keys: np.ndarray
    pair_ratios: np.ndarray
    weights: np.ndarray | None = None

    def codes(self, tokens: pa.Array) -> np.ndarray:
        """The place of the longest known expression of each word; that after the last if none is known, -1 if it is all punctuation."""
        bare = pc.utf8_trim(tokens, EDGE_CHARS)
        found = np.where(pc.equal(bare, "").to_numpy(zero_copy_only=False), -1, len(self.keys))
        rest = np.flatnonzero(found >= 0)
        for level in reversed(range(len(LEVELS))):
            names = bare.take(pa.array(rest))
            kinds = (pc.utf8_slice_codeunits(names, 0, LEVELS[level]) if LEVELS[level] else names).dictionary_encode()
            keys = np.array([_key(level, name) for name in kinds.dictionary.to_pylist()], np.int64)
            at = _find(self.keys, keys)[kinds.indices.to_numpy()]
            found[rest[at >= 0]] = at[at >= 0]
            rest = rest[at < 0]
        return found

    def ratios_of(self, texts: pa.Array) -> list[np.ndarray]:
        """By text: the log ratio of each word that is more than punctuation, given the word before it."""
        tokens, text = _tokens(texts)
        kinds = tokens.dictionary_encode()
        codes = self.codes(kinds.dictionary)[kinds.indices.to_numpy()]
        codes, text = codes[codes >= 0], text[codes >= 0]
        ratios = self.ratios[codes]
        # The place after the last also stands for the start of a text; unknown words are in no pair.
        before = np.concatenate(([len(self.keys)], codes))[:-1]
        starts = np.diff(text, prepend=-1) > 0
        before[starts] = len(self.keys)
        pairs = np.flatnonzero(self.whole[codes] & (starts | self.whole[before]))
        at = _find(self.pair_keys, _pair_key(before[pairs], codes[pairs]))
        ratios[pairs[at >= 0]] = self.pair_ratios[at[at >= 0]]
        return np.split(ratios, np.searchsorted(text, np.arange(1, len(texts))))

    def word_ratios(self, text: str | None) -> np.ndarray:
        return self.ratios_of(pa.array([text], pa.string()))[0]

    def features(self, texts: pa.Array) -> np.ndarray:
        """A row for each text, from a few megabytes of texts at a time."""
        return np.array([_features(r) for piece in _pieces(texts) for r in self.ratios_of(piece)]).reshape(-1, 3)

    def score(self, features: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(features))
        x = np.clip(np.column_stack([np.ones(len(features)), features]) @ self.weights, -50, 50)
        return 1 / (1 + np.exp(-x))


@dataclass
class Words:
    """By word, in the order of `hashes`: its place in the model, its probability by class and its log ratio; `totals` by class.

    By first word of pairs, in the order of `firsts`: counts and distinct continuations by class.
    """

    hashes: np.ndarray
    places: np.ndarray  # and, after the last, that of the start of a text
    p: np.ndarray
    ratios: np.ndarray
    totals: np.ndarray
    firsts: np.ndarray | None = None
    history: np.ndarray | None = None
    continued: np.ndarray | None = None

    def pair_ratios(self, first: np.ndarray, second: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The keys and log ratios of pairs of word hashes, from their counts by class."""
        b = np.searchsorted(self.hashes, second)
        a = np.minimum(np.searchsorted(self.hashes, first), len(self.hashes) - 1)
        a[self.hashes[a] != first] = len(self.hashes)
        h = np.searchsorted(self.firsts, first)
        given = _given(counts, self.history[h], self.continued[h], self.p[b])
        weight = _weight(counts, self.totals)
        ratios = weight * np.log(given[:, 1] / given[:, 0]) + (1 - weight) * self.ratios[b]
        return _pair_key(self.places[a], self.places[b]), ratios.astype(np.float32)


def _key(level: int, bare: str) -> int:
    return xxhash.xxh64_intdigest(f"{level} {bare[:LEVELS[level]]}".encode()) - (1 << 63)


def _pair_key(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return (first << 32) | second


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The place of each wanted key among sorted keys, -1 if it is none of them. Wanted keys go in order, since that is faster."""
    if not len(keys):
        return np.full(len(wanted), -1)
    order = np.argsort(wanted)
    at = np.empty(len(wanted), np.int64)
    at[order] = np.minimum(np.searchsorted(keys, wanted[order]), len(keys) - 1)
    at[keys[at] != wanted] = -1
    return at


def _features(ratios: np.ndarray) -> tuple[float, float, float]:
    """Mean ratio per word, the highest mean over a stretch of words, and a term for the shortness of the text."""
    n = len(ratios)
    if not n:
        return 0.0, 0.0, 1.0
    total = np.concatenate(([0.0], np.cumsum(ratios)))
    width = min(STRETCH, n)
    return float(total[-1] / n), float((total[width:] - total[:-width]).max() / width), 1.0 / math.sqrt(n)


def _pieces(texts: pa.Array) -> Iterator[pa.Array]:
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(), dtype=np.int64)
    low = 0
    while low < len(texts):
        high = np.searchsorted(ends, (ends[low - 1] if low else 0) + PIECE_BYTES, "right")
        high = max(low + 1, int(high))
        yield texts.slice(low, high - low)
        low = high


def _tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts and the text that each is in."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    found, text = parts.flatten(), pc.list_parent_indices(parts)
    filled = pc.not_equal(found, "")
    return found.filter(filled), text.filter(filled).to_numpy()


def _split(text: str | None) -> list[str]:
    return _tokens(pa.array([text], pa.string()))[0].to_pylist()


def _bare_words(text: str) -> Column:
    bare = F.transform(words(lower_ascii(F.col(text))), lambda w: F.btrim(w, F.lit(EDGE_CHARS)))
    return F.array_remove(bare, "")


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED, max_words: int = MAX_WORDS) -> DataFrame:
    """(doc_id, text, toxic, fold) of at most `limit` labelled documents and `max_words` words per class, none held out.

    A document labelled more than once is toxic if any label says so; NULL ids and labels are left out. Fold 0 fits the
    curve, the other folds are counted. Copies of a text count once. Only the ids of the sample are broadcast, and its lengths
    are summed in the order of a hash of the id.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(
        (F.max("toxic") > 0).cast("int").alias("toxic")
    )
    known = known.where(crc_remainder(F.col("doc_id"), HELD_OUT_MODULUS) != HELD_OUT_REMAINDER)
    order = F.xxhash64("doc_id")
    part = lambda rows, toxic: rows.where(F.col("toxic") == toxic).orderBy(order, *rows.columns).limit(limit)
    ids = part(known, 1).unionByName(part(known, 0))
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").withColumn("_text", F.xxhash64("text"))
    lengths = rows.groupBy("_text", "toxic").agg(F.min("doc_id").alias("doc_id"), F.max(F.size(words(F.col("text")))).alias("n"))
    lengths = part(lengths, 1).unionByName(part(lengths, 0))
    so_far = Window.partitionBy("toxic").orderBy(order, "doc_id", "_text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chosen = lengths.withColumn("_sum", F.sum("n").over(so_far)).where(F.col("_sum") - F.col("n") < max_words).drop("n", "_sum")
    rows = rows.join(F.broadcast(chosen), ["doc_id", "toxic", "_text"]).dropDuplicates(["_text", "toxic"])
    return rows.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(4))).drop("_text")


def _counts(rows: DataFrame, name: str, items: Column) -> DataFrame:
    """(name, ordinary, toxic): the documents of each class that an item occurs in."""
    return rows.select("toxic", F.explode(F.array_distinct(items)).alias(name)).groupBy(name).agg(
        F.sum(1 - F.col("toxic")).alias("ordinary"), F.sum("toxic").alias("toxic")
    )


def train(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED, max_words: int = MAX_WORDS) -> Model:
    """Counts in Spark over the labelled sample, whose distinct words and pair ratios reach the driver.

    The curve is fitted on fold 0 with the counts of the others; the counts that score are those of the whole sample.
    """
    spark = docs.sparkSession
    sample = labelled_sample(docs, labels, limit, max_words).withColumn("_words", _bare_words("text")).persist()
    model = counted_model(sample.where("fold <> 0"))
    if model is None:
        sample.unpersist()
        empty = np.zeros(0, np.int64)
        return Model(empty, np.zeros(1), np.zeros(1, bool), empty, np.zeros(0))
    shipped = ship(spark, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = unpack(shipped)
        for batch in batches:
            found = held.features(batch.column(0))
            yield pa.RecordBatch.from_arrays([*map(pa.array, found.T), batch.column(1)], names=["a", "b", "c", "toxic"])

    fitted = sample.where("fold = 0").select("text", "toxic").mapInArrow(run, "a double, b double, c double, toxic int").toArrow()
    fitted = fitted.sort_by([(name, "ascending") for name in fitted.column_names])
    held = np.column_stack([fitted[name].to_numpy().astype(float) for name in fitted.column_names])
    shipped.destroy(blocking=True)
    del model, run, shipped  # the driver holds one model at a time, and so do the executors
    model = counted_model(sample)
    model.weights = _logistic(held[:, :3], held[:, 3])
    sample.unpersist()
    return model


def counted_model(counted: DataFrame) -> Model | None:
    """The model, without a curve, from all rows of (toxic, _words)."""
    pair = F.transform("_words", lambda w, i: F.concat(F.coalesce(F.get("_words", i - 1), F.lit("")), F.lit(" "), w))
    pairs = _counts(counted, "pair", pair).select(
        F.substring_index("pair", " ", 1).alias("first"), F.substring_index("pair", " ", -1).alias("word"), *CLASSES
    ).persist()
    follows = pairs.groupBy("word").agg(*[F.count_if(F.col(c) > 0).alias(f"after_{c}") for c in CLASSES])
    by_word = _counts(counted, "word", F.col("_words")).join(follows, "word")
    built = build(by_word.withColumn("hash", F.xxhash64("word")).toArrow())
    if built is not None:
        model, known = built
        add_pairs(model, known, pairs.select(F.xxhash64("first").alias("first"), F.xxhash64("word").alias("second"), *CLASSES))
    pairs.unpersist()
    return None if built is None else model


def add_pairs(model: Model, known: Words, pairs: DataFrame) -> None:
    """Work out the ratios of (first, second, ordinary, toxic) in tasks, where they are; the driver gets a key and a ratio for each pair,
    a range of keys after the other, so that it holds the pairs once."""
    sums = [F.sum(c).cast("double").alias(c) for c in CLASSES]
    continued = [F.count_if(F.col(c) > 0).cast("double").alias(f"continued_{c}") for c in CLASSES]
    histories = pairs.groupBy("first").agg(*sums, *continued).toArrow().sort_by("first")
    known.firsts = histories["first"].to_numpy()
    known.history, known.continued = (np.column_stack([histories[p + c].to_numpy() for c in CLASSES]) for p in ("", "continued_"))
    del histories
    spark = pairs.sparkSession
    shipped = ship(spark, known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = unpack(shipped)
        for batch in batches:
            counts = np.column_stack([batch.column(c).to_numpy().astype(float) for c in CLASSES])
            found = held.pair_ratios(batch.column("first").to_numpy(), batch.column("second").to_numpy(), counts)
            yield pa.RecordBatch.from_arrays([*map(pa.array, found)], names=["key", "ratio"])

    found = pairs.mapInArrow(run, "key long, ratio float").persist()
    n = found.count()
    model.pair_keys, model.pair_ratios = np.empty(n, np.int64), np.empty(n, np.float32)
    pieces, at = max(1, -(-n // PIECE_PAIRS)), 0
    edges = [i * (len(model.keys) + 1) // pieces << 32 for i in range(pieces + 1)]
    for low, high in zip(edges, edges[1:]):
        piece = found.where((F.col("key") >= low) & (F.col("key") < high)).toArrow().sort_by("key")
        span = slice(at, at := at + len(piece))
        model.pair_keys[span], model.pair_ratios[span] = piece["key"], piece["ratio"]
    del piece
    found.unpersist()
    pa.default_memory_pool().release_unused()
    shipped.destroy(blocking=True)  # executors keep a copy on disk until then


def probabilities(names: list[str], after: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By level: the place of each word's expression, that of each expression in the level above, and its probability by class.

    `after` holds the number of distinct words that each word follows, by class. The probabilities of a level add up to one.
    """
    total = after.sum(0)
    above, above_kinds, above_p = np.zeros(len(names), np.int64), np.array([len(names)]), np.ones((1, len(total)))
    out = []
    for length in LEVELS:
        place = pd.factorize(np.array([name[:length] for name in names], object))[0]
        kinds = np.bincount(place)
        counts = _sums(place, after)
        up = np.empty(len(kinds), np.int64)
        up[place] = above
        mass = DISCOUNT * (counts > 0).sum(0) / total
        p = np.maximum(counts - DISCOUNT, 0) / total + mass * (kinds / above_kinds[up])[:, None] * above_p[up]
        out.append((place, up, p))
        above, above_kinds, above_p = place, kinds, p
    return out


def pair_probabilities(first: np.ndarray, counts: np.ndarray, p_second: np.ndarray) -> np.ndarray:
    """Of each pair: the second word given the first, by class. A history unseen in a class leaves the word's own probability."""
    return _given(counts, _sums(first, counts)[first], _sums(first, counts > 0)[first], p_second)


def _given(counts: np.ndarray, history: np.ndarray, continued: np.ndarray, p_second: np.ndarray) -> np.ndarray:
    seen = np.maximum(counts - DISCOUNT, 0) + DISCOUNT * continued * p_second
    return np.where(history > 0, seen / np.maximum(history, 1), p_second)


def _sums(place: np.ndarray, values: np.ndarray) -> np.ndarray:
    return np.column_stack([np.bincount(place, v) for v in values.T])


def build(by_word: pa.Table) -> tuple[Model, Words] | None:
    """The model without pairs and the words for the ratios of pairs; None unless both classes have words."""
    by_word = by_word.sort_by("hash")
    names, hashes = by_word["word"].to_pylist(), by_word["hash"].to_numpy()
    in_docs, after = (np.column_stack([by_word[p + c].to_numpy().astype(float) for c in CLASSES]) for p in ("", "after_"))
    if not len(names) or not in_docs.sum(0).all():
        return None
    keys, ratios, whole = [], [], []
    above = np.zeros(1)
    for level, (place, up, p) in enumerate(probabilities(names, after)):
        weight = _weight(_sums(place, in_docs), in_docs.sum(0))
        above = weight * np.log(p[:, 1] / p[:, 0]) + (1 - weight) * above[up]
        at = np.zeros(len(up), np.int64)
        at[place] = np.arange(len(names))
        keys.append(np.array([_key(level, names[i]) for i in at], np.int64))
        ratios.append(above)
        whole.append(np.full(len(up), level == len(LEVELS) - 1))
    order = np.argsort(np.concatenate(keys), kind="stable")
    # Whole words are the last level, where each word has a place of its own.
    place_of = np.empty(len(order), np.int64)
    place_of[order] = np.arange(len(order))
    word_at = place_of[len(order) - len(names):][place]
    empty = np.zeros(0, np.int64)
    model = Model(
        np.concatenate(keys)[order], np.append(np.concatenate(ratios)[order], 0.0), np.append(np.concatenate(whole)[order], False),
        empty, np.zeros(0, np.float32),
    )
    return model, Words(hashes, np.append(word_at, len(order)), p[place], above[place], in_docs.sum(0))


def _weight(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """How far an expression is judged by itself: from 0 to 1 with the evidence of its split over the classes."""
    evidence = _evidence(counts[:, 1], counts[:, 0], totals[1], totals[0])
    power = (np.maximum(evidence, 0) / EVIDENCE) ** SHARPNESS
    return power / (1 + power)


def _evidence(t: np.ndarray, o: np.ndarray, n_t: int, n_o: int) -> np.ndarray:
    """How far the split of each expression over the classes is from the split of all words: G squared."""
    n = t + o
    share = n_t / (n_t + n_o)
    with np.errstate(divide="ignore", invalid="ignore"):
        part = lambda x, expected: np.where(x > 0, x * np.log(x / expected), 0.0)
        return 2 * (part(t, n * share) + part(o, n * (1 - share)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> np.ndarray | None:
    """Newton's method with a small ridge; None without rows of both classes."""
    if not len(y) or y.min() == y.max():
        return None
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def score(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> DataFrame:
    """The rows of `docs` with `held_out`, `score` and `predicted`; such columns of the input are replaced.

    NULL and empty texts are scored as texts without words. Without labels of both classes every score is 0. Only the
    text enters a score.
    """
    docs = docs.drop("held_out", "score", "predicted")
    model = ship(docs.sparkSession, train(docs, labels, limit))
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = unpack(model)
        for batch in batches:
            found = held.score(held.features(batch.column(batch.schema.get_field_index("text"))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], names=[*batch.schema.names, "score"])

    scored = docs.mapInArrow(run, schema)
    return scored.withColumn("held_out", crc_remainder(F.col("doc_id"), HELD_OUT_MODULUS) == HELD_OUT_REMAINDER).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )
