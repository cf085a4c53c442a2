"""The registered queries of this subpackage, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airpanel.llm.common import LOWER, UPPER, read
from airpanel.llm.debruijn_dedup import remove_repeated_passages
from airpanel.llm.exact_dedup import exact_duplicates
from airpanel.llm.hard_negatives import hard_negatives
from airpanel.llm.lexical_search import rank_documents
from airpanel.llm.packing import pack_documents
from airpanel.llm.piece_codec import round_trip
from airpanel.llm.quality_rules import judge_quality
from airpanel.llm.secrets import scan_secrets
from airpanel.llm.simhash import near_duplicates
from airpanel.llm.suffix_dedup import remove_repeats
from airpanel.llm.token_counts import count_tokens
from airpanel.llm.toxicity import score_toxicity
from airpanel.llm.url_filter import judge_urls

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

URL_RULES = [
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def lower_sql(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{LOWER}')"


@query("op1_suffix_dedup")
def op1_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return remove_repeats(read(spark, sf, "documents"))


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return score_toxicity(read(spark, sf, "documents"), read(spark, sf, "labels"))


@query("op3_secret_scan")
def op3_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    found = scan_secrets(read(spark, sf, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_live")


@query("op4_packing")
def op4_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack_documents(read(spark, sf, "documents"), tokenizer_path("word_bpe_49k.json"))


@query("op5_url_filter", f"""
    WITH rules(verdict, host, path) AS (VALUES
           ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
           ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
         asked AS (SELECT page_id, {lower_sql("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1)")} AS host,
                          regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages)
    SELECT page_id, host, path,
           (SELECT arg_max(r.host || r.path, length(r.host || r.path)) FROM rules r
            WHERE (a.host = r.host OR ends_with(a.host, '.' || r.host)) AND starts_with(a.path, r.path)) AS rule,
           coalesce((SELECT arg_max(r.verdict, length(r.host || r.path)) FROM rules r
            WHERE (a.host = r.host OR ends_with(a.host, '.' || r.host)) AND starts_with(a.path, r.path)), 'allow') AS verdict
    FROM asked a""")
def op5_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return judge_urls(read(spark, sf, "pages"), URL_RULES, keep=["page_id"])


@query("op6_piece_codec")
def op6_piece_codec(spark: SparkSession, sf: str) -> DataFrame:
    return round_trip(read(spark, sf, "documents"), tokenizer_path("piece_bpe_32k.model"))


@query("op7_exact_dedup", f"""
    WITH n AS (SELECT doc_id, {lower_sql("coalesce(text, '')")} AS norm FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
    FROM n WINDOW w AS (PARTITION BY norm)""")
def op7_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_duplicates(read(spark, sf, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op8_token_counts")
def op8_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return count_tokens(read(spark, sf, "documents"), tokenizer_path("byte_bpe_50k.json"))


@query("op9_simhash")
def op9_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(read(spark, sf, "documents")).select("doc_id", "fingerprint", "component_id")


# The rules' values once more, so that the SQL shares none with the operator.
SQL_END_MARKS = r""".!?:;…\"'”’»)\]。！？"""
SQL_SEPARATORS = "|›»•·"
SQL_BOILERPLATE = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "use cookies",
    "sign up for", "subscribe to", "click here", "read more", "enable javascript", "powered by", "back to top",
)
_WORD = r"[^\x20\x09-\x0D]"
_SPACE = r"[\x20\x09-\x0D]"
_NO_SPACE = f"regexp_replace({{}}, '{_SPACE}', '', 'g')"


def _line_passes_sql(line: str) -> str:
    ends = "[" + SQL_END_MARKS.replace("'", "''") + "]"
    phrases = " OR ".join(f"contains(lower({line}), {lit(p)})" for p in SQL_BOILERPLATE)
    return (
        f"regexp_matches({line}, '{ends}{_SPACE}*\\z')"
        f" AND 3 * length(regexp_replace({line}, '[^{SQL_SEPARATORS}]', '', 'g')) < len(regexp_extract_all({line}, '{_WORD}+'))"
        f" AND length(regexp_replace({line}, '[^#*$%&|<>]', '', 'g')) <= 0.1 * length({line}) AND NOT ({phrases})"
    )


@query("op10_quality_rules", f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
         w AS (SELECT *, regexp_extract_all(t, '{_WORD}+') AS words,
                      list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines FROM d),
         win AS (SELECT r, unnest(range(1, len(words) - 1)) AS p, words FROM w WHERE len(words) >= 3),
         tri AS (SELECT r, p, words[p] || ' ' || words[p + 1] || ' ' || words[p + 2] AS t FROM win),
         rep AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, t) AS n FROM tri) WHERE n > 1),
         cov AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest([p, p + 1, p + 2]) AS q FROM rep) GROUP BY r),
         b AS (SELECT w.*, coalesce(cov.n, 0) AS n_rep, list_filter(lines, lambda x: NOT ({_line_passes_sql("x")})) AS bad
               FROM w LEFT JOIN cov USING (r)),
         c AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length({_NO_SPACE.format("t")}) AS BIGINT) AS word_chars,
                      CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                      CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(n_rep AS BIGINT) AS n_repeat_words,
                      CAST(len(bad) AS BIGINT) AS bad_lines,
                      CAST(length({_NO_SPACE.format("array_to_string(bad, '')")}) AS BIGINT) AS lost_chars FROM b)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, bad_lines, lost_chars,
           NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost_chars <= 0.5 * word_chars AS kept
    FROM c""")
def op10_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return judge_quality(read(spark, sf, "documents"))


@query("op11_substring_dedup")
def op11_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return remove_repeated_passages(read(spark, sf, "documents"))


@query("op12_hard_negatives", """
    WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                      list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vec FROM embeddings
               WHERE label IS NOT NULL AND embedding IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
         s AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
                      CAST(list_inner_product(a.vec, r.vec) AS BIGINT) AS score
               FROM v a JOIN v r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
         p AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
               FROM s WHERE same QUALIFY place <= 5),
         n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
                      row_number() OVER (PARTITION BY p.anchor_id, p.place ORDER BY s.score DESC, s.vec_id) AS rank
               FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
                            AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
    SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
    FROM n WHERE rank <= 5""")
def op12_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(read(spark, sf, "embeddings"), F.col("id") % 100 == 0, label_col=label)


_SQL_TERMS = f"unnest(regexp_extract_all({lower_sql("coalesce(text, '')")}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')) AS term"


@query("op13_lexical_search", f"""
    WITH t AS (SELECT r, doc_id, {_SQL_TERMS} FROM (SELECT *, row_number() OVER () AS r FROM documents)),
         d AS (SELECT r, any_value(doc_id) AS doc_id, count(*) AS n FROM t GROUP BY r),
         s AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS l FROM d),
         f AS (SELECT r, term, count(*) AS tf FROM t GROUP BY r, term),
         w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(nd) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
               FROM f, s GROUP BY term),
         q AS (SELECT i, item_id, term, count(*) AS times FROM
               (SELECT i, item_id, {_SQL_TERMS} FROM (SELECT *, row_number() OVER () AS i FROM benchmark)) GROUP BY i, item_id, term),
         x AS (SELECT i, item_id, r, doc_id,
                      CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nd) // l)))) AS BIGINT) AS score
               FROM q JOIN w USING (term) JOIN f USING (term) JOIN d USING (r), s GROUP BY i, item_id, r, doc_id)
    SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM x WHERE score > 0 QUALIFY rank <= 20""")
def op13_lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    return rank_documents(read(spark, sf, "documents"), read(spark, sf, "benchmark"))
