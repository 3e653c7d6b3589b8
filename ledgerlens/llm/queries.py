"""Registered queries of the operators, with the DuckDB SQL that gives the same rows where SQL can."""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, chat, exact_dedup, html_extract, jaccard_join, language_id, lm_scoring, mixing, pieces,
               source_divergence, substring_dedup, token_files, topk)
from .common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE_SQL[name] = sql
        return fn
    return add


@query("op9_exact_dedup", """
    WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x
               FROM documents)
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(x) AS text_sha256
    FROM t WINDOW same AS (PARTITION BY x)""")
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of all documents by block naming."""
    return exact_dedup.exact_duplicates(read(spark, sf_dir, "documents"))


@query("op8_token_files")
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token files, read back."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_files.token_files(read(spark, sf_dir, "documents"), path).select(
        "doc_id", "start", "n_tokens", "ids_crc32")


@query("op5_chat_format", r"""
    WITH rows AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
        UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
    sized AS (
        SELECT *, lag(role) OVER w IS NOT DISTINCT FROM role AS follows,
               length(text) + len(regexp_extract_all(text, '[\\<#:]')) AS n_text,
               length(role) + len(regexp_extract_all(role, '[\\<#:]')) AS n_role
        FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(n_text + CASE WHEN follows THEN 6 ELSE 4 + n_role + 2 + 8 END) AS BIGINT) AS formatted_chars
    FROM sized GROUP BY conv_id""")
def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one made of control strings, formatted and read back."""
    hard = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)],
                                  "conv_id bigint, turn bigint, role string, text string")
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    back = chat.read_back(chat.format_conversations(turns))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(spoken, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("bigint").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"))


@query("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the labelled ones that are not held out."""
    return language_id.identify(read(spark, sf_dir, "documents"))


@query("op10_html_extract")
def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract_text(read(spark, sf_dir, "pages"))


@query("op4_topk", """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
               WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
          FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""")
def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five rows of highest integer inner product for every fiftieth vector."""
    return topk.top_k(read(spark, sf_dir, "embeddings"))


@query("op2_sentencepiece")
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N-best segmentation of every document, and the digest of the text decoded from the best."""
    return pieces.round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


#: Shares of the tokens wanted of each domain.
TARGETS = {"high": 0.95, "low": 0.05, "toxic": 0.0}


@query("op1_mixing")
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain posteriors, rates and copies of all documents for the target weights."""
    labelled = mixing.quality_domains(read(spark, sf_dir, "labels"))
    return mixing.mix(read(spark, sf_dir, "documents"), labelled, TARGETS)


@query("op7_jaccard_join", r"""
    WITH RECURSIVE w AS (
        SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
    s AS (SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3),
               lambda i: array_to_string(w[i:i + 4], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
    x AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id
          GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
    r(doc_id, reached) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.doc_id, p.b FROM r JOIN p ON p.a = r.reached)
    SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.reached) AS component_id
    FROM s JOIN r ON r.doc_id = s.doc_id GROUP BY s.doc_id, s.s""")
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near duplicates of all documents."""
    return jaccard_join.near_duplicates(read(spark, sf_dir, "documents"))


@query("op6_substring_dedup", r"""
    WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
               FROM documents),
    g AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM w)),
    d AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY g) AS n FROM g) WHERE n > 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM d),
    x AS (SELECT w.doc_id, w, coalesce(r, []) AS r FROM w LEFT JOIN (SELECT doc_id, list(i) AS r FROM gone GROUP BY doc_id) q USING (doc_id))
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(r) AS BIGINT) AS n_removed, sha256(array_to_string(list_transform(
           list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(r, i)), lambda i: w[i]), ' ')) AS kept_sha256 FROM x""")
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents without those in repeated passages."""
    return substring_dedup.remove_repeats(read(spark, sf_dir, "documents"))


@query("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two public tokenizers aligned over all documents."""
    return alignment.align_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                     public_tokenizers.path("piece_bpe_32k.model"))


@query("op12_source_divergence", r"""
    WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
    t AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
    kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 10),
    lang AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
    c AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY lang, source, term),
    g AS (SELECT lang, source, term, coalesce(c.n, 0) AS n FROM (SELECT DISTINCT lang, source FROM d) JOIN kept USING (lang)
          LEFT JOIN c USING (lang, source, term)),
    p AS (SELECT lang, source, term, g.n AS n,
                 1 + (1000000000::HUGEINT * (g.n + 2)) // (sum(g.n) OVER (PARTITION BY lang, source) + 2 * v) AS p,
                 1 + (1000000000::HUGEINT * (kept.n + 2)) // (lang.n + 2 * v) AS q
          FROM g JOIN kept USING (lang, term) JOIN lang USING (lang)),
    pairs AS (SELECT a.lang, a.source, b.source AS item, a.term, (a.p - b.p) * (a.p - b.p) // (a.p + b.p) AS f
              FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source),
    none AS (SELECT a.lang, a.source, b.source AS item, '' AS term, 0 AS f
             FROM (SELECT DISTINCT lang, source FROM d) a JOIN (SELECT DISTINCT lang, source FROM d) b
             ON a.lang = b.lang AND a.source <> b.source),
    parts AS (SELECT lang, source, 'pair' AS part, item, sum(f) AS value FROM (FROM pairs UNION ALL FROM none) GROUP BY ALL
              UNION ALL
              SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q),
    r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS k FROM parts)
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(k AS INTEGER) AS rank FROM r
    WHERE part = 'pair' OR k <= 10""")
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every source from the others of its language, and its most telling terms."""
    return source_divergence.audit(read(spark, sf_dir, "documents"))


@query("op13_lm_scoring")
def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by an interpolated trigram model of those not held out."""
    return lm_scoring.score_documents(read(spark, sf_dir, "documents"))
