"""Quality rules, sharding, preference pairs and packing."""

from collections import Counter

import random
import pytest
from pyspark.sql import functions as F

import brute
from millpulse.llm import packing, preference, quality, sharding


def measured(text):
    ws, lines = brute.words(text), [x for x in (text or "").split("\n") if brute.words(x)]
    grams = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
    often = Counter(grams)
    covered = {i + j for i, g in enumerate(grams) if often[g] > 1 for j in range(3)}
    solid = "".join(brute.words(text))
    return len(ws), len(solid), sum(c in quality.SYMBOLS for c in solid), len(lines) - len(set(lines)), len(covered)


def test_measurements_match_a_plain_count(spark):
    texts = brute.ODD_TEXTS + ["a b c a b c a b c d", "### $$$ x", "a a a a", "x y\n x y\nx y", "b c d b c d e\nb c d b c d e"]
    docs = brute.documents(spark, texts).unionByName(brute.documents(spark, ["q"], [None]))
    rows = quality.apply_policy(quality.ledger(docs)).collect()
    for r in rows:
        text = "q" if r.doc_id is None else texts[r.doc_id]
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == measured(text), text
        base = got[0] < 50 or 100 * got[4] > 50 * got[0]
        assert r.base_failed == base and not (base and r.kept)
    assert len(rows) == len(texts) + 1 and "predicted" in rows[0].asDict()
    assert quality.apply_policy(quality.ledger(docs.limit(0))).count() == 0


def test_rules_and_their_names_agree():
    assert tuple(r.name for r in quality.rules()) == quality.RULE_NAMES


def test_policies_read_the_ledger_and_ablations_add_up(spark):
    rows = spark.createDataFrame([(0, 0), (1, 4), (2, 6), (3, 4), (4, 2)], "doc_id long, failed_bits long")
    kept = {v: {r.doc_id for r in quality.apply_policy(rows, v).where("kept").collect()} for v in quality.POLICIES}
    assert kept == {1: {0, 1, 3}, 2: {0}, 3: {0}}
    cost = {r.rule: (r.failing, r.failing_alone, r.kept_without) for r in quality.ablations(rows, 2).collect()}
    assert cost["symbols"] == (3, 2, 3) and cost["repeated_words"] == (2, 1, 2) and cost["capitals"] == (0, 0, 1)
    assert {r.failing for r in quality.ablations(rows.limit(0), 2).collect()} <= {0}


def test_no_python_on_the_native_paths(spark):
    docs = brute.documents(spark)
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    tidy = preference.tidy_turns(turns)
    for df in (
        quality.apply_policy(quality.ledger(docs)), sharding.place(docs, ["doc_id"], ["a", "b"], 101),
        preference.format_preferences(tidy, preference.with_replaced_answers(tidy)),
    ):
        plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "NestedLoop", "Cartesian"))


def claimed_in_turns(names, size):
    """The table filled literally: whole preference lists, one slot a turn."""
    lists = []
    for name in names:
        first, step = sharding._preference(name, size)
        lists.append([(first + j * step) % size for j in range(size)])
    owner = {}
    while len(owner) < size:
        for shard, wishes in enumerate(lists):
            if len(owner) < size:
                slot = next(s for s in wishes if s not in owner)
                owner[slot] = shard
    return [owner[s] for s in range(size)]


def test_slots_are_claimed_in_turns_and_move_little():
    names = [f"s{i}" for i in range(7)]
    table = sharding.slot_owners(names, 1_009)
    assert table == claimed_in_turns(names, 1_009)
    assert max(Counter(table).values()) - min(Counter(table).values()) <= 1
    fewer = sharding.slot_owners(names[:-1], 1_009)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 6)
    assert moved < 0.2 * 1_009
    for bad in (([], 101), (["a", "a"], 101), (["a"], 100), (["a", "b", "c"], 2)):
        with pytest.raises(ValueError):
            sharding.slot_owners(*bad)


def test_rows_find_their_shard(spark):
    docs = brute.documents(spark).unionByName(brute.documents(spark, ["a", "b", "b"], [None, None, None])).withColumn("slot", F.lit("mine"))
    names = ["a", "b", "c"]
    table = sharding.slot_owners(names, 101)
    rows = sharding.place(docs, ["doc_id"], names, 101).collect()
    assert len(rows) == docs.count() and all(r.shard == table[r.slot] for r in rows)
    assert len({r.slot for r in rows if r.doc_id is None}) == 2  # rows without a key go by their content
    assert sharding.place(docs.limit(0), ["doc_id"], names, 101).count() == 0


def test_written_shards_hold_all_rows(spark, work):
    placed = sharding.place(brute.documents(spark), ["doc_id"], ["a", "b"], 101)
    sharding.write_shards(placed.select("doc_id", "shard"), f"{work}/out")
    back = spark.read.parquet(f"{work}/out")
    assert sorted((r.doc_id, r.shard) for r in back.collect()) == sorted((r.doc_id, r.shard) for r in placed.collect())


def turns(spark, conversations):
    rows = [(c, i, role, text, "x") for c, said in conversations for i, (role, text) in enumerate(said)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part string")


def test_common_prefix_is_rendered_once(spark):
    u, a = "user", "assistant"
    chosen = preference.tidy_turns(turns(spark, [
        (1, [(u, "q"), (a, "r"), (u, "s"), (a, "good")]), (2, [(u, "same"), (a, "same")]), (3, [(u, "only chosen")]), (4, [(u, None), (None, "t")]),
    ]))
    rejected = preference.tidy_turns(turns(spark, [
        (1, [(u, "q"), (a, "r"), (u, "s"), (a, "bad"), (u, "late")]), (2, [(u, "same"), (a, "same")]), (4, [(u, ""), (None, "v")]), (5, [(a, "x")]),
    ]))
    got = sorted(preference.format_preferences(chosen, rejected).collect())
    assert [(r.pair_id, r.part, r.turn) for r in got] == [
        (1, "chosen", 3), (1, "prompt", 0), (1, "prompt", 1), (1, "prompt", 2), (1, "rejected", 3), (1, "rejected", 4),
        (2, "prompt", 0), (2, "prompt", 1), (3, "chosen", 0), (4, "chosen", 1), (4, "prompt", 0), (4, "rejected", 1), (5, "rejected", 0),
    ]
    for r in got:
        covered = r.rendered[r.loss_start:r.loss_end]
        trained = r.part != "prompt" and r.role == "assistant"
        assert covered == (r.rendered.split("|>\n", 1)[1] if trained else "")
    assert got[0].rendered == "<|assistant|>\ngood<|end|>\n"


def test_odd_turns_and_replaced_answers(spark):
    rows = [
        (1, 0, "user", "q"), (1, 1, "assistant", "one"), (1, 1, "assistant", "one"), (1, 1, "assistant", "two"), (1, 2, "user", "bye"),
        (2, 0, "assistant", "zwei"), (None, 0, "user", "x"), (2, None, "user", "y"), (9, 0, "user", "no answer"),
    ]
    tidy = preference.tidy_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert sorted(map(tuple, tidy.collect())) == [
        (1, 0, "user", "q"), (1, 1, "assistant", "one"), (1, 2, "user", "bye"), (2, 0, "assistant", "zwei"), (9, 0, "user", "no answer"),
    ]
    assert sorted(map(tuple, preference.with_replaced_answers(tidy).collect())) == [
        (1, 0, "user", "q"), (1, 1, "assistant", "zwei"), (2, 0, "assistant", ""), (9, 0, "user", "no answer"),
    ]
    empty = tidy.limit(0)
    assert preference.format_preferences(empty, preference.with_replaced_answers(empty)).count() == 0


def test_best_fit_beats_or_equals_each_single_size():
    sizes = [(i * 7919) % 997 + 1 for i in range(600)]
    capacities = (256, 512, 1024)
    bins, offsets, final = packing.pack_block(sizes, capacities)
    contents = {}
    for size, b, o, c in zip(sizes, bins, offsets, final):
        contents.setdefault((b, c), []).append((o, size))
    cost = 0
    for (_, capacity), items in contents.items():
        end = 0
        for offset, size in sorted(items):
            assert offset == end
            end += size
        assert end <= capacity and capacity == next(c for c in capacities if c >= end)
        cost += packing.bin_cost(capacity)
    assert len({b for b, _ in contents}) == len(contents)
    for least in capacities:
        _, _, used = packing._fit(sorted(sizes, reverse=True), capacities, least)
        assert cost <= sum(packing.bin_cost(next(c for c in capacities if c >= u)) for u in used)
    assert packing.pack_block([], capacities) == ([], [], [])


def test_best_fit_takes_the_tightest_bin():
    bins, offsets, used = packing._fit([60, 50, 40, 35, 5], (100,), 100)
    assert (bins, offsets, used) == ([0, 1, 0, 1, 1], [0, 0, 60, 50, 85], [100, 90])


def test_each_bin_opens_at_its_own_least_cost(monkeypatch):
    monkeypatch.setattr(packing, "BIN_OVERHEAD", 10)
    capacities = (100, 250)

    def plain(size, waiting):
        best = []
        for capacity in capacities:
            left, used = sorted(waiting, reverse=True), size
            for other in left:
                used += other if used + other <= capacity else 0
            if size <= capacity:
                best.append((packing.bin_cost(min(c for c in capacities if c >= used)) / used, capacity))
        return min(best)[1]

    rng = random.Random(5)
    for _ in range(200):
        waiting = [rng.randrange(1, 120) for _ in range(rng.randrange(8))]
        size = rng.randrange(1, 250)
        counts = [waiting.count(s) for s in range(251)]
        assert packing.opening_size(size, capacities, counts, sum(1 << s for s in set(waiting))) == plain(size, waiting)
    # The first bin is long and full, the last item opens a short one.
    bins, _, used = packing._fit([90, 80, 80, 60], capacities, None)
    assert bins == [0, 0, 0, 1] and used == [250, 60]


def test_packing_does_not_depend_on_the_reading_order(spark):
    rows = [(i % 40 if i % 9 else None, "w " * (i * 37 % 300)) for i in range(400)]
    orders = [spark.createDataFrame(r, "doc_id long, text string").repartition(n) for r, n in ((rows, 1), (rows[::-1], 7))]
    first, second = (sorted(map(str, packing.pack(docs, capacities=(64, 256), block_items=50).collect())) for docs in orders)
    assert first == second and len({x for x in first}) == len(first)


def test_every_token_is_packed_once(spark):
    docs = brute.documents(spark).unionByName(brute.documents(spark, ["n", "r r", "r r"], [None, 77, 77]))
    rows = packing.pack(docs, capacities=(64, 256), block_items=5).collect()
    lengths = Counter()
    for r in rows:
        lengths[r.doc_id] += r.n_tokens
        assert r.offset + r.n_tokens <= r.capacity
    want = Counter({i: len(brute.words(t)) + 1 for i, t in enumerate(brute.ODD_TEXTS)}) + Counter({None: 2, 77: 6})
    assert lengths == want
    by_bin = {}
    for r in rows:
        by_bin.setdefault(r.bin_id, []).append((r.offset, r.n_tokens, r.capacity))
    for items in by_bin.values():
        end = 0
        for offset, n, capacity in sorted(items):
            assert offset == end and capacity == items[0][2]
            end += n
    assert packing.pack(docs.limit(0)).count() == 0
