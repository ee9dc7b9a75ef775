"""The registered queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, lexical, licenses, linededup, pieces, pii, repair, secrets, simhash, substrings, topk, toxicity
from .common import table


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return secrets.secret_scan(table(spark, sf_dir, "documents"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes and decodes every document."""
    return pieces.encode_digests(table(spark, sf_dir, "documents"), piece_model())


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every line that is not blank."""
    return linededup.line_classes(table(spark, sf_dir, "documents"), short=True)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence texts and notices of every document."""
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from the labels that are not held out."""
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_pii_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return pii.pii_scan(table(spark, sf_dir, "documents"))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one whose texts are control strings, formatted and read back."""
    hard = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.chat_digests(rows.unionByName(extra))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash groups of all documents."""
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best of every vector for each query vector."""
    return topk.top_k(topk.floored(table(spark, sf_dir, "embeddings")))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best documents for every benchmark item."""
    return lexical.lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages that were said before, of every document."""
    return substrings.digests(substrings.repeated_passages(table(spark, sf_dir, "documents")))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged and repaired."""
    return repair.damage_and_repair(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_sentencepiece, op3_decontamination, op4_line_dedup, op5_license_scan, op6_toxicity, op7_pii_scan,
    op8_chat_formatting, op9_simhash, op10_exact_top_k, op11_lexical_search,
    op12_substring_dedup, op13_conversation_repair)}

_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_ESCAPED = r"replace(replace(replace(replace(replace({}, '\', '\\'), '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]')"

SQL: dict[str, str] = {
    "op3_decontamination": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
        win AS (SELECT DISTINCT item_id, array_to_string(w[k + 1:k + 13], ' ') AS said, least(len(w), 13) AS size
                FROM i, LATERAL (SELECT unnest(range(0, greatest(len(w) - 13, 0) + 1)) AS k) WHERE len(w) > 0),
        spot AS (SELECT doc_id, w, size, unnest(range(0, greatest(len(w) - size + 1, 0))) AS k
               FROM d, (SELECT DISTINCT size FROM win)),
        found AS (SELECT spot.doc_id, spot.k, spot.size, win.item_id FROM spot
                  JOIN win ON spot.size = win.size AND win.said = array_to_string(spot.w[spot.k + 1:spot.k + spot.size], ' ')),
        hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + size)) AS p FROM found) GROUP BY doc_id),
        named AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items FROM found GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op8_chat_formatting": f"""
        WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(CASE WHEN role = 'assistant' THEN length({_ESCAPED.format('text')}) + 4
                             ELSE length(replace({_ESCAPED.format('role')}, chr(10), '\\n')) + length({_ESCAPED.format('text')}) + 16 END) AS BIGINT) AS formatted_chars
        FROM t GROUP BY conv_id""".replace("'\\\\n'", "'\\n'"),
    "op10_exact_top_k": """
        WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
              FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5""",
    "op11_lexical_search": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        s AS (SELECT CAST(count(*) FILTER (len(w) > 0) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d),
        p AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d) GROUP BY ALL),
        f AS (SELECT term, count(*) AS df FROM p GROUP BY term),
        i AS (SELECT item_id, term, count(*) AS qtf FROM (SELECT item_id, unnest({_WORDS}) AS term FROM benchmark) GROUP BY ALL),
        g AS (SELECT item_id, term, qtf * CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS gain FROM i JOIN f USING (term), s),
        m AS (SELECT doc_id, 75 + (25 * CAST(len(w) AS BIGINT) * n_docs) // n_terms AS m FROM d, s),
        r AS (SELECT item_id, doc_id, CAST(sum(gain * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
              FROM g JOIN p USING (term) JOIN m USING (doc_id) GROUP BY ALL),
        k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM r WHERE score > 0)
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 20""",
}
