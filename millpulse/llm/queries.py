"""The operators of this package as queries over the whole supplied tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millpulse.llm import (
    ann, bisector, bpe, html_extract, jaccard, lm, negatives, packing, preference, quality, sharding, toxicity, warc,
)
from millpulse.llm.text import table
from millpulse.session import work_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

SHARDS = [f"shard-{i:03d}" for i in range(64)]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.apply_policy(quality.ledger(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "failed_bits", "base_failed", "kept"
    )


@query
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return sharding.place(docs, ["doc_id"], SHARDS)


@query
def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = preference.tidy_turns(table(spark, sf_dir, "conversations"))
    return preference.format_preferences(turns, preference.with_replaced_answers(turns))


@query
def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query
def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return scored.select("doc_id", "held_out", "score", "predicted")


@query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bisector.cluster(table(spark, sf_dir, "embeddings"))


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh row is relabelled first; every hundredth is an anchor."""
    rows = table(spark, sf_dir, "embeddings")
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", relabelled), F.col("vec_id") % 100 == 0)


@query
def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "archives")
    run = warc.write_archives(warc.as_records(table(spark, sf_dir, "pages")), folder)
    records = warc.resolve_revisits(warc.read_archives(spark, folder, run))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op4_quality_rules"] = r"""
with body as (
    select row_number() over () as r, doc_id, coalesce(text, '') as t from documents
), split as (
    select r, doc_id, t, translate(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '') as solid,
           list_filter(regexp_split_to_array(t, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') as ws,
           list_filter(string_split(t, chr(10)),
                       lambda x: translate(x, ' ' || chr(9) || chr(11) || chr(12) || chr(13), '') <> '') as ls
    from body
), placed as (
    select r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as gram
    from (select r, ws, unnest(range(1, len(ws) - 1)) as i from split)
), repeated as (
    select r, i from placed qualify count(*) over (partition by r, gram) > 1
), covered as (
    select r, sum(least(3, coalesce(nxt - i, 3)))::bigint as n
    from (select r, i, lead(i) over (partition by r order by i) as nxt from repeated) group by r
), measured as (
    select s.doc_id, len(ws)::bigint as n_words, length(solid)::bigint as word_chars,
           (length(solid) - length(translate(solid, '#*$%&|<>', '')))::bigint as n_symbols,
           (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, coalesce(c.n, 0)::bigint as n_repeat_words,
           len(ls) as n_lines, length(regexp_replace(solid, '\P{L}', '', 'g')) as n_letters,
           length(regexp_replace(solid, '\P{Lu}', '', 'g')) as n_upper,
           len(list_filter(ws, lambda x: regexp_matches(x, '[#*$%&|<>!]{2,}$'))) as n_marked
    from split s left join covered c using (r)
), bits as (
    select *, (case when n_words < 50 then 1 else 0 end
             + case when 100 * n_repeat_words > 50 * n_words then 2 else 0 end
             + case when 4 * n_symbols > n_words then 4 else 0 end
             + case when 2 * n_upper > n_letters then 8 else 0 end
             + case when 4 * n_marked > n_words then 16 else 0 end
             + case when 2 * n_dup_lines > n_lines then 32 else 0 end
             + case when 2 * n_letters < word_chars then 64 else 0 end
             + case when word_chars > 30 * n_words then 128 else 0 end)::bigint as failed_bits
    from measured
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed_bits,
       failed_bits & 3 <> 0 as base_failed, failed_bits = 0 as kept
from bits
"""

ORACLE["op6_chat_formatting"] = r"""
with said as (
    select conv_id as pair_id, turn, min({'role': coalesce(role, 'unknown'), 'text': coalesce(text, '')}) as s
    from conversations where conv_id is not null and turn is not null group by conv_id, turn
), turns as (
    select pair_id, turn, s.role as role, s.text as text from said
), answers as (
    select pair_id, max({'turn': turn, 'text': text}) filter (role = 'assistant') as a from turns group by pair_id
), rejected as (
    select t.pair_id, t.turn, t.role, case when t.turn = a.a.turn then coalesce(o.a.text, '') else t.text end as text
    from turns t join answers a using (pair_id) left join answers o on o.pair_id = t.pair_id + 1
    where a.a is null or t.turn <= a.a.turn
), aligned as (
    select pair_id, turn, c.role as crole, c.text as ctext, r.role as rrole, r.text as rtext
    from turns c full join rejected r using (pair_id, turn)
), first_split as (
    select pair_id, min(turn) filter (crole is distinct from rrole or ctext is distinct from rtext) as split_at
    from aligned group by pair_id
), parts as (
    select pair_id, 'prompt' as part, turn, crole as role, ctext as text
    from aligned join first_split using (pair_id) where split_at is null or turn < split_at
    union all
    select pair_id, 'chosen', turn, crole, ctext
    from aligned join first_split using (pair_id) where turn >= split_at and crole is not null
    union all
    select pair_id, 'rejected', turn, rrole, rtext
    from aligned join first_split using (pair_id) where turn >= split_at and rrole is not null
), rendered as (
    select *, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) as rendered from parts
)
select pair_id, part, turn, role, rendered,
       (case when part <> 'prompt' and role = 'assistant' then length(role) + 5 else length(rendered) end)::int as loss_start,
       length(rendered)::int as loss_end
from rendered
"""


def _clustering_sql(clusters: int = 40, dims: int = 64, rounds: int = 5) -> str:
    """Each round assigns by the distance itself: all centroids are compared, in doubles that hold these numbers exactly."""
    steps = [f"""
points as materialized (
    select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as p
    from embeddings
    where len(embedding) = {dims} and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {dims}
), c0 as materialized (
    select (row_number() over (order by sha256('2:' || coalesce(vec_id::varchar, '')), p) - 1)::int as c, p as m
    from points order by c limit {clusters}
)"""]
    for n in range(rounds + 1):
        steps.append(f"""
a{n} as materialized (
    select r, any_value(vec_id) as vec_id, min({{'d': list_dot_product(p, p) - 2 * list_dot_product(p, m) + list_dot_product(m, m), 'c': c}}) as best
    from points cross join c{n} group by r
)""")
        if n < rounds:
            steps.append(f"""
s{n} as (
    select c, i, floor(sum(x) / count(*)) as v
    from (select best.c as c, generate_subscripts(p, 1) as i, unnest(p) as x from a{n} join points using (r)) group by c, i
), c{n + 1} as materialized (
    select c, coalesce(moved, m) as m
    from c{n} left join (select c, list(v order by i) as moved from s{n} group by c) using (c)
)""")
    return "with " + ",".join(steps) + f"""
select a.vec_id, a.best.c as cluster, a.best.d::bigint as distance,
       sum(a.best.d) over (partition by a.best.c)::bigint as cluster_inertia, sum(a.best.d) over ()::bigint as inertia,
       sha256(array_to_string(list_transform(k.m, lambda x: x::bigint), ',')) as centroid_sha256
from a{rounds} a join c{rounds} k on k.c = a.best.c
"""


ORACLE["op11_centroid_clustering"] = _clustering_sql()

ORACLE["op12_hard_negatives"] = """
with rows as materialized (
    select row_number() over () as r, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           list_transform(embedding, lambda x: floor(256 * x::double)) as p
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
), scored as materialized (
    select a.r as a, a.vec_id as anchor_id, b.r, b.vec_id, a.label = b.label as same, list_dot_product(a.p, b.p)::bigint as score
    from rows a join rows b on a.vec_id % 100 = 0 and a.r <> b.r and len(a.p) = len(b.p)
), positives as (
    select a, anchor_id, r, vec_id as positive_id, score as positive_score from scored where same
    qualify row_number() over (partition by a order by score desc, vec_id, r) <= 5
), inside as (
    select p.a, p.r, p.anchor_id, p.positive_id, p.positive_score, n.vec_id as negative_id, n.score as negative_score,
           row_number() over (partition by p.a, p.r order by n.score desc, n.vec_id, n.r) as rank
    from positives p join scored n on n.a = p.a and not n.same
     and 30 * p.positive_score <= 100 * n.score and 100 * n.score <= 90 * p.positive_score
)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from inside where rank <= 10
"""

ORACLE["op13_warc"] = """
with records as (
    select row_number() over () as r, page_id, encode(coalesce(html, '')) as payload from pages
), first_of as (
    select *, row_number() over (partition by payload order by page_id nulls last, r) as n,
           first_value(page_id) over (partition by payload order by page_id nulls last, r) as original, sha1(payload) as h
    from records
)
select page_id, octet_length(payload)::bigint as payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + (((('0x' || substr(h, (1 + (i // 4) * 5)::bigint, 5))::bigint) >> (15 - 5 * (i % 4))::int) & 31)::bigint, 1)), '') as payload_digest,
       case when n = 1 then 'response' else 'revisit' end as record_type, case when n > 1 then original end as refers_to
from first_of
"""
