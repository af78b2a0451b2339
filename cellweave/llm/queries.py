"""The registered queries of this package: each operator over the whole of its table."""

from __future__ import annotations

import public_tokenizers as vocabularies
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm import (
    bestposition,
    bpe,
    fertility,
    hostrank,
    langfilter,
    lines,
    mtree,
    packing,
    ring,
    simhash,
    token_files,
    variants,
    warc,
)
from cellweave.llm.common import tune

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
END_OF_DOCUMENT = 2
# Words of a shingle and differing bits of fingerprints that are linked, for the query and the pipeline's stage.
SHINGLE = 4
MAX_BITS = 4
FERTILITY = fertility.Vocabularies(
    ranks=vocabularies.path("byte_bpe_multi_50k.tiktoken"),
    pattern=vocabularies.PATTERN,
    pieces=vocabularies.path("piece_bpe_32k.model"),
)
# Prose of these languages takes 2.3 to 5 characters a token; symbols between the words bring it below 2.
BANDS = {
    "en": fertility.Band(least_chars=2.2, most_chars=6.5, most_bytes=0.1, least_entropy=4.0),
    "de": fertility.Band(least_chars=2.15, most_chars=6.5, most_bytes=0.1, least_entropy=4.0),
    "es": fertility.Band(least_chars=2.05, most_chars=6.5, most_bytes=0.1, least_entropy=4.0),
    "fr": fertility.Band(least_chars=2.05, most_chars=6.5, most_bytes=0.1, least_entropy=4.0),
    "latin": fertility.Band(least_chars=1.9, most_chars=6.5, most_bytes=0.2, least_entropy=4.0),
    "other": fertility.Band(least_chars=0.3, most_chars=6.5, most_bytes=0.8, least_entropy=3.5),
}
RULES = (
    hostrank.Rule("com", "/", "allow"),
    hostrank.Rule("example.com", "/en/", "block"),
    hostrank.Rule("www.example.com", "/en/", "allow"),
    hostrank.Rule("net", "/es/", "block"),
    hostrank.Rule("net", "/fr/", "block"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    return vocabularies.path(name)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), SHINGLE, MAX_BITS)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_files.token_files(docs, vocabulary(BYTE_BPE), END_OF_DOCUMENT)


def op3_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archives(table(spark, sf_dir, "pages"), min_bytes=0)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, vocabulary(WORD_BPE), END_OF_DOCUMENT)


def op5_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ring.shard_documents(table(spark, sf_dir, "documents"), shards=8)


def op6_pair_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_and_decode(table(spark, sf_dir, "documents"), vocabulary(WORD_BPE))


def op7_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.judge(table(spark, sf_dir, "documents"), FERTILITY, BANDS)


def op8_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.describe(table(spark, sf_dir, "documents"))


def op9_host_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hostrank.judge_urls(table(spark, sf_dir, "pages"), RULES)


def op10_metric_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op11_best_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestposition.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_part_enum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(table(spark, sf_dir, "documents"), least_chars=6, least=5, ratio=5, one_in=199)


def op13_language_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langfilter.identify(table(spark, sf_dir, "documents"), folds=4, held_out=2)


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_token_files": op2_token_files,
    "op3_archives": op3_archives,
    "op4_packing": op4_packing,
    "op5_ring": op5_ring,
    "op6_pair_encoding": op6_pair_encoding,
    "op7_fertility": op7_fertility,
    "op8_line_runs": op8_line_runs,
    "op9_host_rank": op9_host_rank,
    "op10_metric_tree": op10_metric_tree,
    "op11_best_position": op11_best_position,
    "op12_part_enum": op12_part_enum,
    "op13_language_filters": op13_language_filters,
}
# The operators whose results SQL can express; the others are tested against plain versions of them.
SQL: dict[str, str] = {
    "op3_archives": """
        with p as (
            select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as hexed from pages
        ), b as (
            select page_id, hexed, strlen(html) as payload_bytes, from_hex(hexed)::BIT::VARCHAR as bits,
                   max(page_id) over (partition by hexed) as response
            from p
        )
        select page_id, payload_bytes,
               array_to_string(list_transform(range(0, 32), lambda i: substr(
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + list_sum(list_transform(range(0, 5), lambda j:
                       (16 >> j) * substr(bits, 5 * i + j + 1, 1)::INTEGER))::INTEGER, 1)), '') as payload_digest,
               case when page_id = response then 'response' else 'revisit' end as record_type,
               case when page_id <> response then response end as refers_to
        from b
    """,
    "op8_line_runs": r"""
        with l as (
            select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
                   unnest(range(0, len(string_split(coalesce(text, ''), chr(10))))) as place
            from documents
        ), k as (
            select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
            from l
        ), r as (
            select key, max(doc_id) as keeper from k where length(key) >= 20
            group by key having count(distinct doc_id) >= 3
        ), d as (
            select k.doc_id, k.place, k.line, r.keeper is not null and r.keeper <> k.doc_id as dropped
            from k left join r on k.key = r.key
        )
        select doc_id, count(*) as n_lines, count(*) filter (where dropped) as n_dropped,
               sha256(coalesce(string_agg(line, chr(10) order by place) filter (where not dropped), '')) as kept_sha256
        from d group by doc_id
    """,
    "op10_metric_tree": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) as v from embeddings
            where len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), s as (
            select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT as score
            from v q join v c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % 50 = 0
        ), r as (
            select *, row_number() over (partition by query_id order by score desc, vec_id)::INTEGER as rank from s
        )
        select query_id, rank, vec_id, score from r where rank <= 5
    """,
    "op11_best_position": r"""
        with d as (
            select row_number() over () as number, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
            from documents
        ), s as (
            select number, doc_id, len(terms)::BIGINT as n from d where len(terms) > 0
        ), a as (
            select count(*) as docs, sum(n)::BIGINT as total from s
        ), p as (
            select number, term, count(*) as tf from (select number, unnest(terms) as term from d) group by all
        ), w as (
            select term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT as w
            from (select term, count(*) as df from p group by term), a
        ), i as (
            select item_id, term, count(*) as q from (
                select item_id, unnest(regexp_extract_all(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
                from benchmark
            ) group by all
        ), f as (
            select i.item_id, s.number, s.doc_id,
                   sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total))))::BIGINT as score
            from i join p on i.term = p.term join w on w.term = p.term join s on s.number = p.number, a
            group by all
        ), r as (
            select *, row_number() over (partition by item_id order by score desc, doc_id nulls last)::INTEGER as rank
            from f where score > 0
        )
        select item_id, rank, doc_id, score from r where rank <= 10
    """,
}
