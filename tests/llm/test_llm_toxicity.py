"""The probabilities and ratios of the toxicity models against plain counts."""

import math
import pickle
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql.classic.dataframe import DataFrame

import corpus_pipeline
from millpulse.llm import toxicity
from millpulse.llm.ship import ship, unpack

D = toxicity.DISCOUNT


def plain_models(texts):
    """By class: the probability of a word given the word before it, written down from the definition."""
    vocabulary = sorted({w for t in texts for d in t for w in d})

    def model(docs):
        pairs = Counter(p for d in docs for p in set(zip([""] + d, d)))
        after = defaultdict(set)
        for v, w in pairs:
            after[w].add(v)
        total = len(pairs)

        def level(word, i):
            if i < 0:
                return 1.0
            k = toxicity.LEVELS[i]
            inside = [w for w in vocabulary if w[:k] == word[:k]]
            outside = [w for w in vocabulary if i == 0 or w[:toxicity.LEVELS[i - 1]] == word[:toxicity.LEVELS[i - 1]]]
            count = sum(len(after[w]) for w in inside)
            kinds = len({w[:k] for w in vocabulary if after[w]})
            return max(count - D, 0) / total + D * kinds / total * len(inside) / len(outside) * level(word, i - 1)

        def given(v, w):
            history = {x: n for (u, x), n in pairs.items() if u == v}
            own = level(w, len(toxicity.LEVELS) - 1)
            if not history:
                return own
            n = sum(history.values())
            return max(history.get(w, 0) - D, 0) / n + D * len(history) / n * own

        return given

    return vocabulary, [model(docs) for docs in texts]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    words = ["ab", "abc", "abcd", "abcde", "abcdefghij", "abcdefghik", "xyz", "xyzzy", "q", "nasty", "nastyword"]
    return [[[rng.choice(words[: 9 + 2 * c]) for _ in range(rng.randrange(1, 9))] for _ in range(12)] for c in (0, 1)]


def counted(corpus):
    vocabulary, _ = plain_models(corpus)
    pairs = [Counter(p for d in docs for p in set(zip([""] + d, d))) for docs in corpus]
    after = np.array([[sum(w == x for _, x in n) for n in pairs] for w in vocabulary], float)
    every = sorted(set(pairs[0]) | set(pairs[1]))
    place = {w: i for i, w in enumerate([*vocabulary, ""])}
    counts = np.array([[n[p] for n in pairs] for p in every], float)
    return vocabulary, after, every, place, counts


def test_probabilities_equal_the_definition_and_add_up_to_one(corpus):
    vocabulary, after, every, place, counts = counted(corpus)
    levels = toxicity.probabilities(vocabulary, after)
    for _, _, p in levels:
        assert np.allclose(p.sum(0), 1)
    words, _, p = levels[-1]
    own = p[words]
    # Pairs that no class has seen complete each history.
    histories = sorted({v for v, _ in every})
    whole = [(v, w) for v in histories for w in vocabulary]
    seen = dict(zip(every, counts))
    all_counts = np.array([seen.get(pair, (0.0, 0.0)) for pair in whole])
    got = toxicity.pair_probabilities(np.array([place[v] for v, _ in whole]), all_counts, own[[place[w] for _, w in whole]])
    _, models = plain_models(corpus)
    assert np.allclose(got, [[given(v, w) for given in models] for v, w in whole])
    assert np.allclose(got.reshape(len(histories), len(vocabulary), 2).sum(1), 1)


def test_the_trained_model_holds_the_ratios_of_every_expression(spark, corpus, monkeypatch):
    monkeypatch.setattr(toxicity, "EVIDENCE", 1e-9)  # every expression is judged by itself alone
    rows = [(i, " ".join(d).upper() + " !", c) for c in (0, 1) for i, d in enumerate(corpus[c], 100 * c)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, c) for i, _, c in rows], "doc_id long, toxic int")
    taken = toxicity.labelled_sample(docs, labels).collect()
    used = [[toxicity._split(r.text)[:-1] for r in taken if r.toxic == c] for c in (0, 1)]
    model = toxicity.train(docs, labels)
    vocabulary, (ordinary, toxic) = plain_models(used)
    evidence = lambda n: abs(toxicity._evidence(*np.array([[n[1]], [n[0]]], float), *[total[1], total[0]])[0]) > 1e-6
    total = [sum(len(set(d)) for d in docs) for docs in used]
    checked = 0
    for docs_of in used:
        for d in docs_of:
            got = model.word_ratios(" ".join(d))
            for v, w, r in zip([""] + d, d, got):
                n = [sum((v, w) in set(zip([""] + x, x)) for x in docs) for docs in used]
                if evidence(n):
                    assert r == pytest.approx(math.log(toxic(v, w) / ordinary(v, w)), abs=1e-5)
                    checked += 1
    assert checked > 30


def test_a_rare_expression_counts_for_something(spark):
    rare = set(range(4, 90, 17))
    rows = [(i, f"plain words of text {i}" + (" vileness" if i in rare else ""), int(i in rare or i % 5 == 0)) for i in range(90)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    counted = {r.doc_id for r in toxicity.labelled_sample(docs, labels).collect()}
    assert counted and len(rare & counted) < 6
    model = toxicity.train(docs, labels)
    assert model.word_ratios("vileness")[0] > 0 and model.word_ratios("never")[0] == 0
    assert len(model.word_ratios("!! , plain ...")) == 1 and len(model.word_ratios(None)) == 0


def test_the_sample_is_bounded_in_rows_and_words(spark):
    docs = spark.createDataFrame([(i, "w " * 10 + str(i)) for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    count = lambda **bound: toxicity.labelled_sample(docs, labels, **bound).groupBy("toxic").count().collect()
    assert {r["count"] for r in count(limit=7)} == {7}
    assert {r["count"] for r in count(max_words=100)} == {10}
    assert {r["count"] for r in count(max_words=1)} == {1}


def test_counts_of_pairs_do_not_reach_the_driver(spark, corpus, monkeypatch):
    """Tables that reach the driver hold words, or a key and a ratio for each pair."""
    got, real = [], DataFrame.toArrow
    monkeypatch.setattr(DataFrame, "toArrow", lambda df: got.append(real(df)) or got[-1])
    rows = [(i, " ".join(d), c) for c in (0, 1) for i, d in enumerate(corpus[c], 100 * c)]
    counted = spark.createDataFrame([(t, c) for _, t, c in rows], "text string, toxic int").withColumn("_words", toxicity._bare_words("text"))
    model = toxicity.counted_model(counted)
    pairs = {p for d in corpus[0] + corpus[1] for p in zip([""] + d, d)}
    assert len(model.pair_keys) == len(pairs) and (np.diff(model.pair_keys) > 0).all()
    large = [t for t in got if t.num_rows == len(pairs)]
    assert len(large) == 1 and large[0].nbytes <= 13 * len(pairs)


def test_pairs_come_to_the_driver_a_range_of_keys_at_a_time(spark, corpus, monkeypatch):
    rows = [(i, " ".join(d), c) for c in (0, 1) for i, d in enumerate(corpus[c], 100 * c)]
    counted = spark.createDataFrame([(t, c) for _, t, c in rows], "text string, toxic int").withColumn("_words", toxicity._bare_words("text"))
    whole = toxicity.counted_model(counted)
    got, real = [], DataFrame.toArrow
    monkeypatch.setattr(DataFrame, "toArrow", lambda df: got.append(real(df)) or got[-1])
    monkeypatch.setattr(toxicity, "PIECE_PAIRS", 10)
    model = toxicity.counted_model(counted)
    assert (model.pair_keys == whole.pair_keys).all() and (model.pair_ratios == whole.pair_ratios).all()
    pieces = [t.num_rows for t in got if t.column_names == ["key", "ratio"]]
    assert sum(pieces) == len(whole.pair_keys) and max(pieces) < len(whole.pair_keys)


def test_a_shipped_model_keeps_no_second_copy_of_its_arrays(spark):
    shipped = ship(spark, {"table": np.arange(1_000_000)})

    def run(batches):
        for batch in batches:
            size = len(pickle.dumps(shipped.value))
            assert unpack(shipped)["table"][-1] == 999_999 and list(shipped.value) == ["model"]
            yield pa.RecordBatch.from_arrays([pa.array([size])], names=["size"])

    assert spark.range(1).mapInArrow(run, "size long").first()["size"] < 8_100_000


def test_ratios_of_pairs_stay_in_the_executors_and_are_not_written(spark, corpus, monkeypatch):
    """Every file that Spark writes starts a process of the executor, which counts as its memory once more."""
    written = []
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **b: written.append(path))
    rows = [(i, " ".join(d), c) for c in (0, 1) for i, d in enumerate(corpus[c], 100 * c)]
    counted = spark.createDataFrame([(t, c) for _, t, c in rows], "text string, toxic int").withColumn("_words", toxicity._bare_words("text"))
    before = spark._jsc.getPersistentRDDs().size()
    model = toxicity.counted_model(counted)
    pairs = {p for d in corpus[0] + corpus[1] for p in zip([""] + d, d)}
    assert not written and len(model.pair_keys) == len(pairs) and spark._jsc.getPersistentRDDs().size() == before


ODD_TEXTS = [
    None, "", " \t", "!! , ...", "ABC abc, (abcd) xyzzy", "nasty\x0bNASTYWORD\x0c nastyw\r\nnasty!", " q q\u0085q ÄB 日本語", "ab abcdefghijk ab",
    "zz never seen " * 40, "q", None,
]


def plain_ratios(model, text):
    """One word after the other, by single look-ups."""
    places, whole = {k: i for i, k in enumerate(model.keys)}, []
    for word in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")):
        if bare := word.strip(toxicity.EDGE_CHARS):
            known = [places[k] for level in range(len(toxicity.LEVELS)) if (k := toxicity._key(level, bare)) in places]
            whole.append(known[-1] if known else len(model.keys))
    pairs, out = dict(zip(model.pair_keys, model.pair_ratios)), []
    for before, at in zip([None, *whole], whole):
        usable = model.whole[at] and (before is None or model.whole[before])
        out.append(pairs.get((len(model.keys) if before is None else before) << 32 | at, model.ratios[at]) if usable else model.ratios[at])
    return out


@pytest.mark.parametrize("size", [1, 30, 2_000_000])
def test_texts_scored_together_get_the_ratios_of_single_words(spark, corpus, monkeypatch, size):
    rows = [(" ".join(d), c) for c in (0, 1) for d in corpus[c]]
    counted = spark.createDataFrame(rows, "text string, toxic int").withColumn("_words", toxicity._bare_words("text"))
    model = toxicity.counted_model(counted)
    texts = pa.array(ODD_TEXTS + [t for t, _ in rows], pa.string())
    plain = [plain_ratios(model, t) for t in texts.to_pylist()]
    monkeypatch.setattr(toxicity, "PIECE_BYTES", size)
    got = [r for piece in toxicity._pieces(texts) for r in model.ratios_of(piece)]
    assert [list(r) for r in got] == plain
    features = model.features(texts)
    assert features.shape == (len(texts), 3) and model.features(texts[:0]).shape == (0, 3)
    assert (features == [toxicity._features(np.array(r, float)) for r in plain]).all()


def test_a_word_is_looked_up_once_for_all_texts_of_a_piece(spark, corpus, monkeypatch):
    rows = [(" ".join(d), c) for c in (0, 1) for d in corpus[c]]
    counted = spark.createDataFrame(rows, "text string, toxic int").withColumn("_words", toxicity._bare_words("text"))
    model, looked_up, real = toxicity.counted_model(counted), [], toxicity._key
    monkeypatch.setattr(toxicity, "_key", lambda *a: looked_up.append(a) or real(*a))
    model.features(pa.array([f"unknown words {i % 5} abc" for i in range(500)]))
    assert len(looked_up) <= 8 * len(toxicity.LEVELS)


def test_the_toxicity_stage_of_the_pipeline_writes_no_files_of_its_own(spark, corpus, tmp_path, monkeypatch):
    rows = [(i, " ".join(d), c) for c in (0, 1) for i, d in enumerate(corpus[c], 100 * c)]
    spark.createDataFrame([(i, c) for i, _, c in rows], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    written = []
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **b: written.append(path))
    assert corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).count() <= len(rows) and not written
