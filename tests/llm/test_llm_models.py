"""Nearest neighbours, near duplicates, page text, toxicity, language-model scores and the pipeline."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from millpulse.llm import ann, components, html_extract, jaccard, lm, toxicity
from millpulse.llm.ship import batches_of


def vocabulary(seed, n, stem="w"):
    rng = random.Random(seed)
    return lambda k: [f"{stem}{rng.randrange(n)}" for _ in range(k)]


# ---- nearest neighbours -----------------------------------------------------------------------

def test_graph_finds_the_nearest_centroids():
    points = np.random.default_rng(3).normal(size=(2_000, 8))
    cents = ann.balanced_centroids(points, 60)
    assert 40 <= len(cents) <= 90
    graph = ann.build_graph(cents)
    ids, dist = graph.nearest(points[:200], 10)
    true = ((points[:200, None] - cents[None]) ** 2).sum(2)
    best = np.sort(true, axis=1)[:, :10]
    assert (np.isclose(dist, best).mean()) > 0.98
    assert np.allclose(np.take_along_axis(true, ids, 1), dist)


def nearest(rows, k=20, modulus=20):
    held = {}
    for i, v in rows:
        if i is not None and v and not any(x is None or not math.isfinite(x) for x in v) and any(v):
            held[i] = min(held.get(i, v), v)
    out = {}
    for q, v in held.items():
        if q % modulus == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in held.items() if i != q)
            out[q] = [i for _, i in scored[:k]]
    return out


def test_search_reaches_recall_and_handles_odd_vectors(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 16))
    rows = [(i, [float(x) for x in centres[i % 40] + 0.3 * rng.normal(size=16)]) for i in range(3_000)]
    same = [float(x) for x in centres[0]]
    rows += [(3_000 + i, same) for i in range(400)]  # one vector that many rows share
    odd = [(None, same), (9_000, None), (9_001, []), (9_020, [0.0] * 16), (9_040, [math.nan] * 16), (9_060, [None] * 16), (9_080, [math.inf] * 16),
           (20, rows[20][1])]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.search(frame).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = nearest(rows)
    assert got.keys() == want.keys()
    vectors = dict(rows)
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [n for n, _, _ in found] == list(range(1, 21))
        for (_, a, s), (_, b, t) in zip(found, found[1:]):
            assert s > t or (s == t and a < b)
        assert all(math.isclose(s, float(np.dot(vectors[q], vectors[i])), rel_tol=1e-12) for _, i, s in found)
        hits += len({i for _, i, _ in found} & set(want[q]))
    assert hits / (20 * len(want)) >= 0.95
    assert [i for _, i, _ in got[3_020]] == want[3_020]


def test_search_reaches_recall_over_many_lists_of_weakly_clustered_vectors(spark):
    rng = np.random.default_rng(11)
    n, dims = 100_000, 64
    block = 0.5 * rng.normal(size=(10, dims))[rng.integers(0, 10, n)] + rng.normal(size=(n, dims))
    block /= np.linalg.norm(block, axis=1, keepdims=True)
    table = pa.table({
        "vec_id": np.arange(n), "embedding": pa.ListArray.from_arrays(np.arange(0, n * dims + 1, dims, dtype=np.int32), pa.array(block.ravel())),
    })
    got = {}
    for r in ann.search(spark.createDataFrame(table), query_modulus=200).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    asked = np.arange(0, n, 200)
    scores = block[asked] @ block.T
    scores[np.arange(len(asked)), asked] = -np.inf
    want = np.argpartition(-scores, 20, axis=1)[:, :20]
    assert sum(len(got[q] & set(w)) for q, w in zip(asked.tolist(), want.tolist())) / want.size >= 0.9


def test_boundary_vectors_join_several_lists_also_where_they_hardly_cluster():
    points = np.random.default_rng(6).normal(size=(4_000, 32))
    index = ann.Index(None, 32, float(np.linalg.norm(points, axis=1).max()))
    index.graph = ann.build_graph(ann.balanced_centroids(index.lifted(points, False), 40))
    index.spacing = ann.spacing(index.graph.centroids)
    assert np.mean([len(chosen) for _, chosen in index.lists(points[:500])]) > 1.5


def test_search_of_few_and_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in ann.search(few).orderBy("rank").collect()] == [(0, 1, 1, 0.5), (0, 2, 2, -1.0)]
    assert ann.search(few.limit(0)).count() == 0


# ---- near duplicates --------------------------------------------------------------------------

def test_t_occurrence_counts_like_a_plain_count():
    rng = random.Random(1)
    for needed in range(1, 7):
        lists = [sorted(rng.sample(range(60), rng.choice([2, 3, 5, 40, 55]))) for _ in range(8)]
        plain = Counter(x for members in lists for x in members)
        assert jaccard.t_occurrence(lists, needed) == {x: n for x, n in plain.items() if n >= needed}


def plain_sets(texts):
    out = []
    for text in texts:
        ws = brute.lower_words(text)
        out.append(frozenset(tuple(ws[i:i + 5]) for i in range(max(1, len(ws) - 4))) if ws else frozenset())
    return out


def check_duplicates(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    found = plain_sets(texts)
    links = []
    for i in range(len(texts)):
        for j in range(i):
            both = len(found[i] & found[j])
            if found[i] and 100 * both >= 75 * len(found[i] | found[j]):
                links.append((ids[i], ids[j]))
    want = brute.components(ids, links)
    got = jaccard.near_duplicates(brute.documents(spark, texts, ids)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted((i, len(s), want[i]) for i, s in zip(ids, found))


def test_near_duplicates_match_all_pairs(spark):
    draw, rng = vocabulary(1, 4_000), random.Random(2)
    passage, texts = draw(60), list(brute.ODD_TEXTS)
    for group in range(12):
        base = draw(rng.choice([8, 30, 120, 300]))
        for _ in range(rng.choice([2, 3, 9])):
            copy = list(base)
            for _ in range(rng.randrange(1 + len(base) // 25)):
                copy[rng.randrange(len(copy))] = draw(1)[0]
            texts.append(" ".join(copy).upper() if group % 3 else " ".join(copy))
    # A passage that more documents share than a list may have before it is long, in short and in long documents.
    texts += [" ".join(passage + draw(rng.choice([4, 10, 18, 25, 200]))) for _ in range(150)]
    chain = draw(100)
    for _ in range(8):  # neighbours of a chain link, its ends do not
        chain = chain[9:] + draw(9)
        texts.append(" ".join(chain))
    check_duplicates(spark, texts)


def test_pairs_of_few_and_many_long_lists_are_counted_whole(spark, work):
    # a holds two long lists and is fetched with them, b holds one and is not.
    one, other = {"L1", "L2", "s1", "s2"}, {"L1", "s1", "s2", "x"}
    assert jaccard.prefix_length(8) == 4 and jaccard.needed(8, 8) == 3
    rng = random.Random(8)
    prefixes = [one, other, {"x", "y"}] + [{"L1", f"f{i}"} for i in range(70)] + [{"L2", f"g{i}"} for i in range(70)]
    names = ["L1", "L2", *(f"m{i}" for i in range(12))]
    prefixes += [set(rng.sample(names, 4)) for _ in range(60)]
    members = Counter(x for p in prefixes for x in p)
    assert members["L1"] > jaccard.LONG and members["L2"] > jaccard.LONG
    rows = [(i, 8, zlib.crc32(x.encode()), members[x]) for i, p in enumerate(prefixes) for x in p if members[x] > 1]
    shared = spark.createDataFrame(rows, "node long, n int, hash long, members long")
    labels = spark.createDataFrame([], "node long, component long")
    # Bitmaps that rule nothing out, so that the counts alone decide.
    marks = spark.createDataFrame([(i, 8, [0] * (jaccard.BITS // 64)) for i in range(len(prefixes))], "node long, n int, bits array<long>")
    got = {(r.a, r.b) for r in jaccard._remaining(shared, labels, marks, f"{work}/open").collect()}
    assert got == {(i, j) for j in range(len(prefixes)) for i in range(j) if len(prefixes[i] & prefixes[j]) >= 3}


def test_frequent_shingles_come_last_in_prefixes():
    frequent = np.array([3, 4, 90], np.int64)
    shingles = np.array(sorted({3, 90, *range(10, 30)}), np.int64)
    assert jaccard.prefix(shingles, frequent).tolist() == list(range(10, 10 + jaccard.prefix_length(22)))
    few = np.array([3, 4, 7, 90], np.int64)
    assert jaccard.prefix(few, frequent).tolist() == [7, 3, 4, 90][:jaccard.prefix_length(4)]
    assert jaccard.prefix(shingles, frequent[:0]).tolist() == shingles[:jaccard.prefix_length(22)].tolist()


@pytest.mark.parametrize("sample", [1, 3, 64])
def test_long_lists_that_are_left_out_lose_no_pair(spark, monkeypatch, sample):
    monkeypatch.setattr(jaccard, "SAMPLE", sample)
    draw, rng = vocabulary(21, 50_000), random.Random(22)
    base, texts = draw(260), []
    for _ in range(200):  # all alike, few of them enough to link; every list of the base is long
        copy = list(base)
        for at in rng.sample(range(0, 260, 5), rng.choice([5, 6, 7, 9])):
            copy[at] = draw(1)[0]
        texts.append(" ".join(copy))
    assert jaccard.left_out(jaccard.shared_in_prefix(jaccard.required(256))) > 8
    check_duplicates(spark, texts, rng.sample(range(10_000), len(texts)))


def test_short_documents_around_a_common_passage(spark):
    draw, rng = vocabulary(12, 40), random.Random(13)
    passage = draw(14)
    texts = []
    for _ in range(260):
        at = rng.randrange(6)
        texts.append(" ".join(draw(rng.randrange(3)) + passage[at:at + rng.choice([6, 8])] + draw(rng.randrange(1, 4))))
    check_duplicates(spark, texts)


def test_a_group_of_near_copies_without_a_centre(spark):
    draw, rng = vocabulary(3, 50_000), random.Random(4)
    base, texts = draw(130), []
    for _ in range(120):
        copy = list(base)
        for _ in range(rng.choice([0, 1, 2, 3])):
            copy[rng.randrange(len(copy))] = draw(1)[0]
        texts.append(" ".join(copy))
    check_duplicates(spark, texts, rng.sample(range(10_000), len(texts)))


def test_rows_without_id_and_repeated_rows(spark):
    texts = ["a b c d e f", "a b c d e f", None, "a b c d e f", "g"]
    got = jaccard.near_duplicates(brute.documents(spark, texts, [4, 4, 7, None, None])).collect()
    rows = sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=str)
    assert rows == sorted([(4, 2, 4), (4, 2, 4), (7, 0, 7), (None, 2, None), (None, 1, None)], key=str)
    assert jaccard.near_duplicates(brute.documents(spark).limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 99), (99, 98)] + [(200, 200 + i) for i in range(1, 30)]
    got = {r.node: r.component for r in components.connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == brute.components({x for link in links for x in link}, links)


# ---- page text --------------------------------------------------------------------------------

PAGE = """<html><head><title>t</title><style>p{}</style></head><body><nav><ul><li>menu<li>more</ul></nav>
<div class="wrap%d"><div class="story-9"><h1>Head &amp; line</h1><p>First <b>bold<p>second&nbsp; one<br>still %s</div>
<div class="sidebar">side text that is quite long, with many words that nobody wants to read at all</div>
<div id="comments"><p>a reader says a lot here, more than the story itself, again and again and again</p></div></div>
<script>var x = "<p>no</p>";</script><footer>foot</footer></body></html>"""


def test_main_text_of_odd_pages(spark):
    rows = [(i, f"http://User@Host.example/{i}?q", PAGE % (i, "block " * 10)) for i in range(6)]
    rows += [(10, None, None), (11, "no url", ""), (12, "http://host.example/x", "plain words"), (13, "http://host.example/y", "<div class='x'>open &lt; <p>tag"),
             (None, "http://host.example/z", PAGE % (1, "end"))]
    got = {r.page_id: (r.text, r.n_chars) for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(6):
        text = "Head & line\nFirst bold\nsecond one still " + "block " * 9 + "block"
        assert got[i] == (text, len(text))
    assert got[10] == got[11] == ("", 0) and got[12][0] == "plain words" and got[13][0] == "open <\ntag"
    assert got[None][0] == "Head & line\nFirst bold\nsecond one still end"
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_pages_follow_their_host(spark):
    """One page whose sidebar outweighs its article is read as its host's other pages are."""
    page = "<body><div class=a><p>%s</p></div><div class=b><p>%s</p></div></body>"
    rows = [(i, "http://h.example/", page % ("main " * 40, "other " * 5)) for i in range(5)] + [(9, "http://h.example/", page % ("short", "other " * 50))]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[9] == "short"


def page_texts(spark, pages):
    rows = [(i, f"http://{i}.example/" if host is None else host, page) for i, (host, page) in enumerate(pages)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r.text.split("\n") for r in sorted(got, key=lambda r: r.page_id)]


def test_divided_articles_are_read_whole(spark):
    a, b, c = ("first " * 10).strip(), ("second " * 60).strip(), ("third " * 40).strip()
    plain = f"<body><nav>menu</nav><article><h1>Head</h1><p>{a}</p><section><p>{b}</p></section><section><p>{c}</p></section></article></body>"
    named = f"<body><section id=intro><p>{b}</p></section><section id=notes><p>{c}</p></section></body>"
    outer = f"<body><div><h1>Head</h1><div class=x><p>{b}</p></div></div><div class=links><a href=x>{c}</a></div></body>"
    full = "<body><div class=story><p>some words</p></div></body>"
    hollow = f"<body><div class=story></div><div class=late><p>{a}</p></div></body>"
    host = "http://one.example/"
    got = page_texts(spark, [(None, plain), (None, named), (None, outer), (host, full), (host, full), (host, hollow)])
    assert got == [["Head", a, b, c], [b, c], ["Head", b], ["some words"], ["some words"], [a]]


def test_labels_skip_boilerplate_but_no_wrapper_and_no_heading(spark):
    a, b = ("first " * 30).strip(), ("second " * 20).strip()
    page = "<body><div class='%s'><p>" + a + "</p></div><div class='comments'><p>says</p></div></body>"
    parts = (
        f"<body><article><h2 class='section-header'>Head</h2><h3 class=header>Sub</h3><p>{a}</p><figure><figcaption>Shown</figcaption></figure>"
        "<p class='foot-note'>Note</p><p class=legal>Law</p><div class=related><a href=x>another story</a></div><div class=share>Tell</div>"
        "<div class='comments-list'><p>says</p></div></article><div class='site-footer'>end</div></body>"
    )
    comments = f"<body><div class=post><p>{b}</p></div><div id=comments><p>{a} {a}</p></div></body>"
    wrapped = f"<body><div class=widget><h1>Head</h1><p>{a}</p></div></body>"
    got = page_texts(spark, [(None, page % "content has-sidebar"), (None, page % "page no-header"), (None, parts), (None, comments), (None, wrapped)])
    assert got == [[a], [a], ["Head", "Sub", a, "Shown", "Note", "Law"], [b], ["Head", a]]


def test_containers_without_classes_are_told_apart_by_their_place(spark):
    a = ("article " * 60).strip()
    page = "<html><body><div><a href=x>menu</a> here</div><div><h1>Head</h1><p>%s</p></div><div><p>You may also like</p></div></body></html>"
    host = "http://plain.example/"
    assert page_texts(spark, [(host, page % f"{a} {i}") for i in range(4)]) == [["Head", f"{a} {i}"] for i in range(4)]


def test_a_host_of_two_templates_loses_no_article(spark):
    a, b = ("usual " * 50).strip(), ("other " * 80).strip()
    host = "http://two.example/"
    usual = f"<body><div class=main><p>{a}</p></div></body>"
    teaser = f"<body><div class=main><p>Read this too</p></div><div class=long><p>{b}</p></div></body>"
    assert page_texts(spark, [(host, usual)] * 5 + [(host, teaser)]) == [[a]] * 5 + [[b]]


def test_reader_comments_go_whatever_their_label(spark):
    a = ("article " * 40).strip()
    says = "<p>a reader says so</p>"
    inner = "".join(f"<div class='{name}'>{says}</div>" for name in ("user-comments", "cmt", "respond-here", "replies", "article_comments_list"))
    page = f"<body class=has-comments><article><h1>Head</h1><p>{a}</p>{inner}<h3 class=comments-title>3 comments</h3></article></body>"
    state = f"<body><div class='post comments-open'><p>{a}</p></div></body>"
    assert page_texts(spark, [(None, page), (None, state)]) == [["Head", a], [a]]


def test_a_titled_section_of_an_article_stays(spark):
    a, b = ("article " * 40).strip(), ("finding " * 20).strip()
    page = (
        f"<body><article><h1>Head</h1><p>{a}</p><section class=search><h2>Search</h2><p>{b}</p></section>"
        "<div class=share><a href=x>Tell a friend</a></div><div class=ad><h4>Buy</h4><p>now</p></div></article></body>"
    )
    assert page_texts(spark, [(None, page)]) == [["Head", a, "Search", b]]


def test_an_advert_longer_than_its_article_goes(spark):
    page = "<body><div class=ad>" + "buy this now " * 20 + "</div><article><h1>Head</h1><p>short</p></article></body>"
    assert page_texts(spark, [(None, page)]) == [["Head", "short"]]


def test_text_outside_all_containers_is_read(spark):
    pages = ["just words", "<p>one</p>two", "<h1>Head</h1><p>text</p>", "<nav>menu</nav>"]
    assert page_texts(spark, [(None, page) for page in pages]) == [["just words"], ["one", "two"], ["Head", "text"], [""]]


def test_very_deep_pages_are_read(spark):
    deep = "<div>" * 5_000 + "<p>bottom</p>"
    rows = spark.createDataFrame([(1, "http://d.example", deep)], "page_id long, url string, html string")
    assert html_extract.extract(rows).first().text == "bottom"


# ---- toxicity ---------------------------------------------------------------------------------

def toxic_corpus(spark, n=600):
    draw, rng = vocabulary(7, 3_000, "words"), random.Random(8)
    rows, labels = [], []
    for i in range(n):
        ws, toxic = draw(rng.choice([20, 60, 300])), i % 5 == 0
        if toxic:
            for _ in range(1 + len(ws) // 40):
                ws[rng.randrange(len(ws))] = rng.choice(["nastyword", "vileness", f"grim{rng.randrange(900)}"])
        rows.append((i, " ".join(ws), "block"))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_toxicity(spark):
    docs, labels = toxic_corpus(spark)
    got = toxicity.score(docs, labels).join(labels, "doc_id").collect()
    assert len(got) == 600 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out]
    caught = [r.predicted for r in held if r.toxic]
    wrong = [r.predicted for r in held if not r.toxic]
    assert sum(caught) >= 0.9 * len(caught) and sum(wrong) <= 0.02 * len(wrong)


def test_scores_do_not_learn_from_held_out_labels(spark):
    docs, labels = toxic_corpus(spark, 200)
    turned = labels.withColumn("toxic", F.when(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({r.doc_id: r.score for r in toxicity.score(docs, given).collect()} for given in (labels, turned))
    assert a == b


def test_odd_rows_and_missing_labels(spark):
    docs = brute.documents(spark).unionByName(brute.documents(spark, ["x"], [None]))
    none = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    got = toxicity.score(docs, none).collect()
    assert len(got) == len(brute.ODD_TEXTS) + 1 and {r.score for r in got} == {0.0} and {r.predicted for r in got} == {0}
    _, labels = toxic_corpus(spark, 60)
    assert toxicity.score(docs, labels).count() == len(got) and toxicity.score(docs.limit(0), labels).count() == 0


# ---- language-model scores --------------------------------------------------------------------

def lm_base(rows):
    tokens = {i: [w.encode() for w in brute.lower_words(t)] + [b""] for i, t in rows}
    counts = Counter(w for i, ws in tokens.items() if zlib.crc32(str(i).encode()) % 10 for w in ws)
    total, kinds = sum(counts.values()), len(counts)
    base = {i: sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in ws) for i, ws in tokens.items()}
    known = {i: sum(counts[w] > 0 for w in ws) for i, ws in tokens.items()}
    return tokens, base, known, total


def check_lm(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", 2) for i, t in rows], "doc_id long, text string, score string, c int")
    tokens, base, known, total = lm_base(rows)
    got = {r.doc_id: r for r in lm.score(docs).collect()}
    assert got.keys() == tokens.keys()
    for i, r in got.items():
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens[i]), known[i], total)
        assert r.held_out == (zlib.crc32(str(i).encode()) % 10 == 0)
        assert math.isclose(r.base_score, base[i], rel_tol=1e-9, abs_tol=1e-9)
        assert math.isfinite(r.score) and r.score <= 1e-6
    return got, tokens


def test_scores_follow_the_base_and_learn_order(spark, monkeypatch):
    monkeypatch.setattr(lm, "HEAD_WORDS", 40)  # so that most words are looked up by the join
    rng = random.Random(9)
    rows = []
    for i in range(400):
        ws = []
        for _ in range(60):  # every even word decides the next one
            k = rng.randrange(8)
            ws += [f"even{k}", f"odd{k}"]
        rows.append((i, " ".join(ws + [f"rare{rng.randrange(2000)}"])))
    got, _ = check_lm(spark, rows)
    held = [r for r in got.values() if r.held_out]
    assert held and sum(r.score for r in held) > 0.8 * sum(r.base_score for r in held)


def plain_probability(model, before, word):
    """The path of a word by dictionaries and math alone, one softmax after the other."""
    mask = (1 << 64) - 1
    mix = [int(x) for x in lm._MIX]
    start = len(model.ids) + lm.TAILS
    shared = lambda w: zlib.crc32(w[-2:]) % lm.TAILS
    ids = [start] * 3 + [model.ids.get(w, len(model.ids) + shared(w)) for w in before]
    w1, w2 = ((ids[-k] + 1) * mix[k - 1] & mask for k in (1, 2))
    features = [w1, (w1 ^ w2) * mix[3] & mask, w2 * mix[3] & mask]
    at = model.ids.get(word, model.n_own)
    leaf = at if at < model.n_own else model.n_own + shared(word)
    p = 1.0
    for choice in model.choices[model.first[leaf]:model.first[leaf] + model.depth[leaf]].tolist():
        cls, place = divmod(choice, lm.FAN)
        logits = model.bias[cls].astype(float)
        for n, feature in enumerate(features):
            x = feature ^ ((cls + 1) * mix[2] & mask)
            x = (x ^ x >> 31) * mix[0] & mask
            logits = logits + model.weights[(n << model.row_bits) + (x >> 64 - model.row_bits)]
        p *= math.exp(logits[place]) / sum(map(math.exp, logits))
    return p


def learned(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return lm.train(docs, lm.prepare(lm.count_words(docs)))


def probability(model, before, word):
    coded, keep = lm._coded(model, [[*before, word]])
    return 10 ** lm.log_probabilities(model, coded, keep[-1:])[0]


def test_choices_depend_on_more_than_the_last_word(spark):
    # The last word is the same; only the word before it tells which of two words follows.
    rng = random.Random(21)
    model = learned(spark, [" ".join(f"{x} mid {x}yyyy" for x in rng.choices(["aa", "bb"], k=30)) for _ in range(300)])
    for first in (b"aa", b"bb"):
        assert probability(model, [first, b"mid"], first + b"yyyy") > 0.8


def test_every_common_word_is_reached_by_its_context(spark):
    rng = random.Random(22)
    pairs = [(f"x{k}", f"y{k}") for k in range(100)]
    model = learned(spark, [" ".join(w for _ in range(40) for w in rng.choice(pairs)) for _ in range(600)])
    # Without its context a word has a share of 0.005.
    assert all(probability(model, [b"y0", x.encode()], y.encode()) > 0.05 for x, y in pairs)


def test_probabilities_equal_a_plain_softmax(spark):
    rng = random.Random(23)
    model = learned(spark, [" ".join(f"w{min(rng.randrange(80), rng.randrange(80))}" for _ in range(50)) + f" once{i}" for i in range(80)])
    for _ in range(60):
        before = [f"w{rng.randrange(90)}".encode() for _ in range(rng.randrange(5))]
        word = rng.choice([b"", b"unseen", b"once7", f"w{rng.randrange(80)}".encode()])
        assert math.isclose(probability(model, before, word), plain_probability(model, before, word), rel_tol=1e-3)


def test_scores_beat_a_plain_bigram(spark):
    # Words follow a hidden order of two words back, so a bigram sees half of it.
    rng = random.Random(24)
    rows = []
    for i in range(500):
        ws = ["s0", "s1"]
        while len(ws) < 80:
            ws.append(f"s{(int(ws[-1][1:]) * 7 + int(ws[-2][1:]) * 3 + rng.randrange(2)) % 40}")
        rows.append((i, " ".join(ws)))
    got, tokens = check_lm(spark, rows)
    ones, twos = Counter(), Counter()
    for i, ws in tokens.items():
        if not got[i].held_out:
            ones.update(["^", *ws[:-1]])
            twos.update(zip(["^", *ws], ws))
    kinds = len({b for _, b in twos})
    bigram = sum(
        math.log10((twos[pair] + 0.1) / (ones[pair[0]] + 0.1 * kinds))
        for i, ws in tokens.items() if got[i].held_out for pair in zip(["^", *ws], ws)
    )
    assert sum(r.score for r in got.values() if r.held_out) > bigram


def test_lm_of_odd_rows_and_of_nothing(spark):
    check_lm(spark, list(enumerate(brute.ODD_TEXTS)))
    check_lm(spark, [(0, "never learned from"), (10, None)] if zlib.crc32(b"0") % 10 == 0 else [(0, "few words")])
    assert lm.score(brute.documents(spark).limit(0)).count() == 0


def test_probabilities_of_a_context_sum_to_one(spark):
    texts = [f"a{i % 5} b{i % 7} c{i} d" for i in range(60)]
    model = learned(spark, texts)
    table = Counter(w.encode() for t in texts for w in t.split()) + Counter({b"": len(texts)})
    for context in ([], [b"a1"], [b"a1", b"b2"], [b"zzz"]):
        total, shared = 0.0, {}
        for word, c in table.items():
            p, leaf = probability(model, context, word), model.leaf(word)
            if leaf < model.n_own:
                total += p
            else:
                tail = leaf - model.n_own
                total += p * (1 - model.unseen[tail]) * c / model.rest_tokens[tail]
                shared[tail] = p * model.unseen[tail]
        # What is left belongs to shared places without any known word.
        assert 0.5 < total + sum(shared.values()) <= 1 + 1e-5
        whole = sum(probability(model, context, w) for w in table if model.leaf(w) < model.n_own)
        endings = {}
        for k in range(4_000):
            endings.setdefault(model.tail(f"{k:03x}"[-2:].encode()), f"?{k:03x}".encode())
        assert len(endings) == lm.TAILS
        whole += sum(probability(model, context, w) for w in endings.values())
        assert math.isclose(whole, 1, rel_tol=1e-4)


def test_copies_of_the_weights_follow_the_tokens_not_the_partitions(spark):
    texts = [f"a{i % 5} b{i % 7} c{i}" for i in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(40)
    model = lm.prepare(lm.count_words(docs))
    rows = lm.encoded(docs, model)
    assert rows.rdd.getNumPartitions() == 40 and lm._by_copy(rows, model).rdd.getNumPartitions() == 1
    model.n_tokens = 9 * lm.COPY_TOKENS
    copies = lm._by_copy(rows, model)
    assert copies.rdd.getNumPartitions() == 9 and copies.count() == len(texts)
    model.n_tokens = 1_000 * lm.COPY_TOKENS
    assert lm._by_copy(rows, model).rdd.getNumPartitions() == 40


def test_texts_become_ids_and_words_outside_the_head(spark, monkeypatch):
    monkeypatch.setattr(lm, "HEAD_WORDS", 3)
    docs = spark.createDataFrame([(1, "A a b rare rare"), (2, None), (3, "a\tb\n other")], "doc_id long, text string")
    model = lm.prepare(lm.count_words(docs))
    got = {r.doc_id: r for r in lm.encoded(docs, model).collect()}
    place = lambda w: model.ids.get(w, 3 + model.tail(w))
    ids = {i: np.frombuffer(r.ids, np.int32).tolist() for i, r in got.items()}
    assert ids == {1: [place(w) for w in (b"a", b"a", b"b", b"rare", b"rare", b"")], 2: [place(b"")], 3: [place(w) for w in (b"a", b"b", b"other", b"")]}
    outside = {i: {(t.word, t.cls): t.times for t in r.tail} for i, r in got.items()}
    expected = {1: {"b": 1, "rare": 2}, 2: {}, 3: {"b": 1, "other": 1}}
    assert outside == {i: {(w, model.tail(w.encode())): n for w, n in x.items() if w.encode() not in model.ids} for i, x in expected.items()}


def test_the_head_is_the_most_frequent_words_ties_by_word(spark, monkeypatch):
    words = [f"w{i:02d}" for i in range(24)]
    docs = spark.createDataFrame([(i, " ".join([w] * (1 + i % 5))) for i, w in enumerate(words)], "doc_id long, text string")
    counts = lm.count_words(docs).cache()
    table = Counter({w.encode(): 1 + i % 5 for i, w in enumerate(words)}) + Counter({b"": len(words)})
    ordered = sorted(table.items(), key=lambda x: (-x[1], x[0]))
    for size in (1, 2, 5, 6, 13, len(table), 100):
        monkeypatch.setattr(lm, "HEAD_WORDS", size)
        model = lm.prepare(counts)
        assert list(model.counts.items()) == ordered[:size] and (model.n_tokens, model.n_words) == (sum(table.values()), len(table))
        assert list(model.ids.items()) == [(w, i) for i, (w, _) in enumerate(ordered[:size])]
    counts.unpersist()


def test_workers_hold_few_texts_and_the_words_only_where_texts_become_ids(spark, monkeypatch):
    key, sent, sizes = "spark.sql.execution.arrow.maxRecordsPerBatch", [], set()
    before = spark.conf.get(key)
    ship_model = lm.ship

    def ship(session, held):
        sent.append(b"markedword" in cloudpickle.dumps(held))
        sizes.add(int(spark.conf.get(key)))
        return ship_model(session, held)

    monkeypatch.setattr(lm, "ship", ship)
    docs = spark.createDataFrame([(i, f"markedword a{i % 3} b{i}") for i in range(40)], "doc_id long, text string")
    scores = lm.score(docs)
    assert scores.count() == 40
    assert sent == [True, False, False, False]  # texts become ids; classes, steps and scores need none
    assert sizes == {lm.BATCH_ROWS} and spark.conf.get(key) == before
    plan = scores._jdf.queryExecution().toString()
    assert "ExistingRDD" not in plan  # rows of Python objects, which would take Python workers of their own

    def size(batches):
        return (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"]) for b in batches)

    with batches_of(spark, lm.BATCH_ROWS):
        got = [r.n for r in spark.range(0, 2_000, 1, 1).mapInArrow(size, "n long").collect()]
    assert sum(got) == 2_000 and max(got) <= lm.BATCH_ROWS


def test_sums_of_runs_equal_plain_sums():
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(3_000, lm.FAN)).astype(np.float32)
    for kinds in (1, 7, 400, 100_000):
        key = rng.integers(0, kinds, len(rows))
        order = np.argsort(key, kind="stable")
        starts = np.flatnonzero(np.concatenate(([True], np.diff(key[order]) > 0)))
        got = lm._run_sums(rows, order, starts, np.diff(np.append(starts, len(rows))))
        assert (got == np.add.reduceat(rows[order], starts, axis=0)).all()


# ---- pipeline ---------------------------------------------------------------------------------

def test_each_stage_keeps_what_it_should(spark, tmp_path):
    docs, labels = toxic_corpus(spark, 300)
    docs = docs.withColumnRenamed("score", "source")
    extra = [(1_000 + i, "copy " + " ".join(f"quote{j}" for j in range(100)), "s") for i in range(3)] + [(2_000, "too short", "s"), (None, None, "s")]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, kept[-1], str(tmp_path))
        out.write.parquet(f"{tmp_path}/{len(kept)}")
        kept.append(spark.read.parquet(f"{tmp_path}/{len(kept)}"))
    ids = [Counter(r.doc_id for r in k.collect()) for k in kept]
    assert [k.columns for k in kept[:4]] == [docs.columns] * 4
    toxic = {r.doc_id for r in toxicity.score(docs, labels).where("predicted = 1").collect()}
    assert ids[1] == Counter({i: n for i, n in ids[0].items() if i not in toxic})
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert ids[2] == Counter({i: n for i, n in ids[1].items() if len(brute.words(texts[i])) >= 50})
    assert set(ids[2]) - set(ids[3]) == {1_001, 1_002} and 1_000 in ids[3]
    assert set(ids[4]) == set(ids[3]) and corpus_pipeline.run(spark, str(tmp_path)).count() == kept[4].count()


def test_the_pipeline_writes_each_stage_but_the_last(spark, tmp_path, monkeypatch):
    read = []

    def stage(spark, docs, sf_dir):
        read.append(len(docs.inputFiles()))
        return docs.where(F.rand(1) >= 0).orderBy("doc_id").limit(5)

    brute.documents(spark).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(corpus_pipeline, "STAGES", [(str(i), stage) for i in range(3)])
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() == 5 and len(read) == 3
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("GlobalLimit") == 1


def test_the_pipeline_bears_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", ["op1_", "op2_", "op3_", "op4_", "op5_", "op6_", "op7_", "op8_", "op9_", "op10_", "pipeline"])
def test_every_operator_is_registered(name):
    import __spark_entry__

    assert len([q for q in __spark_entry__.queries() if q.startswith(name)]) == 1


def test_bitmaps_drop_no_pair_that_links(spark):
    rng = random.Random(12)
    sets, pairs = [], []
    for n in (1, 3, 8, 40, 200, 1_500):
        for share in (0.0, 0.5, 0.75, 0.84, 0.86, 0.9, 1.0):
            for _ in range(6):
                one = {rng.randrange(-2**63, 2**63) for _ in range(n)}
                kept = set(rng.sample(sorted(one), round(share * n)))
                other = kept | {rng.randrange(-2**63, 2**63) for _ in range(round((1 - share) * n * rng.uniform(0.2, 1)))}
                if other:
                    pairs.append((len(sets), len(sets) + 1))
                    sets += [one, other]
    rows = [(i, len(s), jaccard.bitmap(np.array(sorted(s), np.int64)).tolist()) for i, s in enumerate(sets)]
    marks = spark.createDataFrame(rows, "node long, n int, bits array<long>")
    left = {tuple(r) for r in jaccard.may_link(spark.createDataFrame(pairs, "a long, b long"), marks).collect()}
    link = {(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert link <= left and 0 < len(link) and len(left) < 0.8 * len(pairs)
