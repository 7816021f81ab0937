"""The opN queries, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import load
from . import htmltext, langid, lmscore, neardup, packing, pii, quality, spiece, tokencount, topk
from .common import remainder


def op1_pii(spark, sf_dir):
    return pii.find_pii(load(spark, sf_dir, "documents"))


def op2_lm_scores(spark, sf_dir):
    return lmscore.score(load(spark, sf_dir, "documents"), remainder(F.col("doc_id"), 10) == 0)


def op3_sentencepiece(spark, sf_dir):
    return spiece.encode(load(spark, sf_dir, "documents"))


def op4_near_duplicates(spark, sf_dir):
    return neardup.near_duplicates(load(spark, sf_dir, "documents")).drop("id")


def op5_language(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 4) == 2
    return langid.identify(docs, langid.fit(docs, ~held_out), held_out)


def op6_top_k(spark, sf_dir):
    return topk.top_k(load(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(50)) == 0)


def op7_packing(spark, sf_dir):
    return packing.pack(load(spark, sf_dir, "documents"))


def op8_token_counts(spark, sf_dir):
    return tokencount.count_tokens(load(spark, sf_dir, "documents"))


def op9_quality(spark, sf_dir):
    return quality.quality(load(spark, sf_dir, "documents"))


def op10_html_text(spark, sf_dir):
    return htmltext.extract(load(spark, sf_dir, "pages"))


QUERIES = {
    f.__name__: f
    for f in (op1_pii, op2_lm_scores, op3_sentencepiece, op4_near_duplicates, op5_language, op6_top_k, op7_packing, op8_token_counts, op9_quality, op10_html_text)
}

ORACLE_SQL: dict[str, str] = {
    "op6_top_k": """
        with v as (
            select vec_id, [floor(256 * x::double) for x in embedding] as q
            from embeddings
            where vec_id is not null and embedding is not null and len(embedding) > 0
              and len([x for x in embedding if x is null or not isfinite(x)]) = 0
        ), s as (
            select a.vec_id as query_id, b.vec_id as vec_id, list_dot_product(a.q, b.q)::bigint as score
            from v a join v b on a.vec_id <> b.vec_id
            where a.vec_id % 50 = 0
        ), r as (
            select query_id, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank, vec_id, score
            from s
        )
        select query_id, rank, vec_id, score from r where rank <= 5
    """,
}
