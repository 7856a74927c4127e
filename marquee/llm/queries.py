"""One query per operator, over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.alignment import align, pair_counts, rate
from marquee.llm.common import table
from marquee.llm.divergence import audit
from marquee.llm.exact_dedup import exact_groups
from marquee.llm.language import identify, records
from marquee.llm.language import train as train_language
from marquee.llm.minhash import similar_groups
from marquee.llm.mixing import mix
from marquee.llm.packing import pack_documents
from marquee.llm.perplexity import judge_quality
from marquee.llm.simhash import near_groups
from marquee.llm.token_counts import count_tokens
from marquee.llm.token_files import checksums, new_folder, read_tokens, write_tokens
from marquee.llm.toxicity import toxicity
from marquee.llm.urls import judge_urls

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: The rules that are asked for.
URL_RULES = [
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
    ("allow", "com/fr/"), ("block", "com/de/"),
]


@query
def op1_toxicity(spark, sf):
    rows = toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))
    worst = F.array_max(F.transform("offending", lambda s: F.struct(s["score"], -s["start"], s["end"])))
    return rows.select(
        "doc_id", "held_out", "score", "predicted", "n_sentences", F.size("offending").alias("n_offending"),
        (-worst["col2"]).alias("worst_start"), worst["end"].alias("worst_end"),
    )


@query
def op2_url_filters(spark, sf):
    rows = judge_urls(table(spark, sf, "pages"), URL_RULES)
    return rows.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict", "block_score")


@query
def op3_exact_dedup(spark, sf):
    rows = exact_groups(table(spark, sf, "documents"))
    return rows.select(
        F.col("id").alias("doc_id"), "keep_id", F.col("n").alias("group_size"), "kept", F.col("sha").alias("text_sha256")
    )


@query
def op4_quality_rules(spark, sf):
    return judge_quality(table(spark, sf, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "log_perplexity", F.col("lower").alias("lower_band"), F.col("upper").alias("upper_band"),
        "word_log_perplexity", F.col("word_lower").alias("word_lower_band"), F.col("word_upper").alias("word_upper_band"),
    )


@query
def op5_mixing(spark, sf):
    return mix(table(spark, sf, "documents")).select(
        F.col("id").alias("doc_id"), "source", "block", "slot", "position"
    )


@query
def op6_token_counts(spark, sf, tokenizer=None):
    rows = count_tokens(table(spark, sf, "documents"), tokenizer or vocabulary("byte_bpe_50k.json"))
    return rows.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


@query
def op7_packing(spark, sf):
    return pack_documents(table(spark, sf, "documents"), vocabulary("word_bpe_49k.json"))


@query
def op8_simhash(spark, sf):
    rows = near_groups(table(spark, sf, "documents"))
    return rows.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query
def op10_language(spark, sf):
    documents = table(spark, sf, "documents")
    langs, model = train_language(documents)
    rows = identify(records(documents, table(spark, sf, "pages")), langs, model)
    return rows.select(
        "kind", "doc_id", "page_id", "host", "suffix", "declared", "text_lang", "language", "confidence", "kept"
    )


@query
def op9_token_files(spark, sf):
    docs = table(spark, sf, "documents")
    path = new_folder(docs)
    write_tokens(docs, vocabulary("word_bpe_49k.json"), path)
    return checksums(read_tokens(spark, path))


@query
def op11_divergence(spark, sf):
    return audit(table(spark, sf, "documents"))


@query
def op12_minhash(spark, sf):
    rows = similar_groups(table(spark, sf, "documents"))
    return rows.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


@query
def op13_alignment(spark, sf):
    aligned = align(table(spark, sf, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
    return rate(aligned, pair_counts(aligned)).select(
        F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


ORACLES: dict[str, str] = {
    "op3_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents
        )
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, text_sha256
        FROM t WINDOW w AS (PARTITION BY text_sha256)
    """,
    "op11_divergence": r"""
        WITH d AS (
            SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents
        ), groups AS (SELECT DISTINCT lang, source FROM d),
        words AS (SELECT row, lang, source, unnest(terms) AS term FROM d),
        kept AS (
            SELECT lang, term, count(*) AS n FROM words GROUP BY ALL HAVING count(DISTINCT row) >= 30
        ), own AS (
            SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL
        ), v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
        total AS (SELECT lang, source, sum(n) AS n FROM own GROUP BY ALL),
        shares AS (
            SELECT lang, source, term, coalesce(own.n, 0) AS n,
                   1 + (1000000000::HUGEINT * (coalesce(own.n, 0) + 5)) // (coalesce(total.n, 0) + 5 * v.v)::HUGEINT AS p,
                   1 + (1000000000::HUGEINT * (kept.n + 5)) // (v.n + 5 * v.v)::HUGEINT AS q
            FROM groups JOIN kept USING (lang) JOIN v USING (lang)
            LEFT JOIN total USING (lang, source) LEFT JOIN own USING (lang, source, term)
        ), sums AS (
            SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
            FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
        ), parts AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sums.value, 0)::BIGINT AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares WHERE n > 0 AND p > q
        )
        SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
        FROM parts QUALIFY part = 'pair' OR rank <= 50
    """,
}
