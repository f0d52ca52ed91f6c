"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import (
    cascade,
    chat,
    decontamination,
    fingerprints,
    jaccard,
    packing,
    quality,
    repair,
    sharding,
    substrings,
    toxicity,
    urls,
    whitening,
)

Build = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Build] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name."""

    def add(build: Build) -> Build:
        QUERIES[build.__name__] = build
        if sql:
            SQL[build.__name__] = sql
        return build

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


URL_RULES = (
    urls.prefix_rule("allow", "com", "/"),
    urls.prefix_rule("block", "example.com", "/en/"),
    urls.prefix_rule("allow", "www.example.com", "/en/"),
    urls.prefix_rule("block", "net", "/es/"),
    urls.prefix_rule("block", "net", "/fr/"),
)


@query(
    r"""
    WITH rules(r_host, r_path, r_verdict) AS (VALUES
        ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
        ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
    parted AS (
        SELECT page_id,
               coalesce(lower(regexp_extract(url, '://([^/?#]*)', 1)), '') AS host,
               coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
        FROM pages),
    places AS (SELECT DISTINCT host, path FROM parted),
    fitting AS (
        SELECT host, path, r_host || r_path AS rule, r_verdict,
               row_number() OVER (PARTITION BY host, path
                                  ORDER BY length(r_host || r_path) DESC, r_host || r_path) AS place
        FROM places JOIN rules
          ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path))
    SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.r_verdict, 'allow') AS verdict
    FROM parted p LEFT JOIN fitting f ON p.host = f.host AND p.path = f.path AND f.place = 1
    """
)
def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of the stated rules on every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query()
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards whose row counts are at most one apart."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.bounded_ring(docs, shards=8).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query(
    r"""
    WITH said AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
        UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
    placed AS (
        SELECT *, row_number() OVER w AS place, lag(role) OVER w AS before,
               length(role) + length(regexp_replace(role, '[^\\<>]', '', 'g')) AS role_chars,
               length(text) + length(regexp_replace(text, '[^\\<>]', '', 'g')) AS text_chars
        FROM said WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), ''))
               AS loss_sha256,
           (7 + sum(text_chars + CASE WHEN before IS NULL THEN 7 + role_chars
                                      WHEN before = role THEN 6
                                      ELSE 14 + role_chars END))::BIGINT AS formatted_chars
    FROM placed GROUP BY conv_id
    """
)
def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings, formatted and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    planted = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)],
        "conv_id long, turn long, role string, text string",
    )
    read = chat.read_chats(chat.format_chats(turns.unionByName(planted)))
    lines = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def vocabulary() -> str:
    """The tokenizer file of the contract; installed with the public vocabulary files."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query()
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, vocabulary())


@query()
def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fingerprints.compare_with_next(docs)


@query()
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents; rows of fold 1 of 3 are held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.classify(docs, table(spark, sf_dir, "labels"))


@query()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents; rows of fold 2 of 4 are held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.classify(docs, table(spark, sf_dir, "labels"))


@query()
def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents inside ten consecutive words of a benchmark item."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.drop("hits", "items")


@query()
def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents that strings of 100 bytes seen before cover, and what is left."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.remove_repeats(docs)


@query()
def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents whose three-word shingles are alike by nine tenths."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.jaccard_join(docs)


@query(
    r"""
    WITH cut AS (
        SELECT row_number() OVER () AS place, doc_id, coalesce(text, '') AS text,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
               list_filter(string_split(coalesce(text, ''), chr(10)),
                           lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l
        FROM documents),
    windows AS (
        SELECT place, i, array_to_string(list_slice(w, i, i + 4), ' ') AS five
        FROM (SELECT place, w, unnest(range(1, len(w) - 3)) AS i FROM cut)),
    again AS (
        SELECT place, i FROM (
            SELECT place, i, count(*) OVER (PARTITION BY place, five) AS n FROM windows)
        WHERE n > 1),
    covered AS (
        SELECT place, count(DISTINCT i + k) AS n FROM again, range(5) AS r(k) GROUP BY place),
    counted AS (
        SELECT c.place, doc_id, text, w, l, len(w) AS n_words,
               length(array_to_string(w, '')) AS word_chars,
               length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
               len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(v.n, 0) AS n_repeat_words
        FROM cut c LEFT JOIN covered v ON c.place = v.place),
    failed AS (
        SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
               length(regexp_replace(text, '[^A-Z]', '', 'g')) AS upper_case,
               length(regexp_replace(text, '[^a-z]', '', 'g')) AS lower_case
        FROM counted)
    SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
           n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
           n_repeat_words::BIGINT AS n_repeat_words, base_failed,
           NOT (base_failed
                OR 100 * n_symbols > 25 * n_words
                OR 100 * n_dup_lines > 50 * len(l)
                OR word_chars > 30 * n_words
                OR 100 * upper_case > 50 * (upper_case + lower_case)
                OR 100 * length(regexp_replace(text, '[^!]', '', 'g')) > 30 * n_words
                OR 100 * len(list_filter(range(2, n_words + 1), lambda i: w[i] = w[i - 1]))
                    > 30 * n_words
                OR 100 * len(list_filter(w, lambda x: NOT regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]')))
                    > 40 * n_words
                OR (len(l) >= 10 AND
                    100 * len(list_filter(l, lambda x: substr(x, 1, 1) IN ('*', '-'))) > 90 * len(l))
                OR (n_words >= 30 AND NOT list_has_any(
                    list_transform(w, lambda x: translate(
                        x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')),
                    [ """
    + ", ".join(f"'{w}'" for w in cascade.FUNCTION_WORDS)
    + """]))) AS kept
    FROM failed
    """
)
def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of all documents and the verdict of the rules."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return cascade.quality_rules(docs).drop("n_lines", "rejected_by")


@query()
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 16 whitened components of all embeddings."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query()
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of all conversations after stated damage, and the edits that mend them."""
    turns = table(spark, sf_dir, "conversations")
    return repair.audits(repair.damaged(turns), copies="copies")
