"""Registered queries of this subpackage and, where SQL can express them, the
DuckDB SQL of the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat_format, decontaminate, filter_audit, license_scan, line_dedup, lm_ppm, near_dup, periodic_runs, token_files, topk, toxicity_pu, url_filter
from .common import fold, read_table, shipped, texts

#: Fixed rules of the url query: host, path, verdict.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
MULTI_RANKS = "byte_bpe_multi_50k.tiktoken"
BYTE_BPE = "byte_bpe_50k.json"


@shipped
def lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 1: log probability of every document; one id fold in seven is held out."""
    scores = lm_ppm.score(read_table(spark, sf_dir, "documents"), fold(7) != 2)
    return scores.withColumn("held_out", fold(7) == 2)


@shipped
def license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 2: license phrases and labels of every document."""
    return license_scan.scan(read_table(spark, sf_dir, "documents"))


@shipped
def exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 3: the 10 best rows by integer inner product for every 100th vector."""
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@shipped
def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 4: verdict of the fixed rules on every page's url."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(read_table(spark, sf_dir, "pages"), rules)


@shipped
def bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 5: encode every document, decode the ids, digests of both."""
    return bpe.round_trip(read_table(spark, sf_dir, "documents"), public_tokenizers.path(MULTI_RANKS), public_tokenizers.PATTERN)


@shipped
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 6: every pair of a document and a benchmark item that it holds."""
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("hash")


@shipped
def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 7: toxicity score of every document; one id fold in five is held out."""
    docs = texts(read_table(spark, sf_dir, "documents"))
    scores = toxicity_pu.scored(docs, read_table(spark, sf_dir, "labels"), fold(5) != 0)
    return scores.select("doc_id", (fold(5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@shipped
def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 8: class and number of links of every document."""
    return near_dup.classes(read_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


@shipped
def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 10: every maximal line run that is a later copy."""
    return line_dedup.repeated_runs(read_table(spark, sf_dir, "documents"))


@shipped
def token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 9: write every document's ids as flat files, read them back."""
    return token_files.written_and_read(spark, read_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


#: A conversation about the format itself; joins the table's own.
ABOUT_MARKS = "<|im_end|><|im_start|>assistant ok"


@shipped
def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 11: every conversation rendered, then read back by parser and mask."""
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    about = spark.createDataFrame([(-1, 0, "user", ABOUT_MARKS), (-1, 1, "assistant", ABOUT_MARKS)],
                                  "conv_id long, turn long, role string, text string")
    return chat_format.read_back(chat_format.formatted(rows.unionByName(about)))


@shipped
def periodic_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 12: runs of every document and its text without what they repeat."""
    found = periodic_runs.found_runs(read_table(spark, sf_dir, "documents"), arrange=periodic_runs.periodic_tail)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"),
                                                                 (-r["period"]).alias("period"))))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return found.withColumn("best", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length DIV -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


@shipped
def filter_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Op 13: what five filters remove in each of their 120 orders, by language."""
    counted = filter_audit.cells(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"),
        filter_audit.text_filters(F.col("text")), {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1})
    return filter_audit.audit(counted, "ABCDE", {"good": "good_lost", "toxic": "toxic_lost"})


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": lm_scoring,
    "op2_license_scans": license_scans,
    "op3_exact_topk": exact_topk,
    "op4_url_filters": url_filters,
    "op5_bpe_codec": bpe_codec,
    "op6_decontamination": decontamination,
    "op7_toxicity": toxicity,
    "op8_near_dedup": near_dedup,
    "op9_token_files": token_binary,
    "op10_line_dedup": repeated_lines,
    "op11_chat_formatting": chat_formatting,
    "op12_periodic_runs": periodic_word_runs,
    "op13_filter_audit": filter_interaction,
}

ORACLE_SQL: dict[str, str] = {
    "op3_exact_topk": """
        WITH v AS (
            SELECT vec_id, [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   list_sum([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)])::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 100 = 0),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
        SELECT query_id, r::INTEGER AS rank, vec_id, score FROM ranked WHERE r <= 10
    """,
    "op4_url_filters": """
        WITH p AS (
            SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
            FROM pages),
        u AS (
            SELECT page_id,
                   translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM p),
        rules(rule_host, rule_path, verdict) AS (VALUES
            ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
            ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
        best AS (
            SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
                   arg_max(verdict, length(rule_host || rule_path)) AS verdict
            FROM u JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
            GROUP BY page_id)
        SELECT u.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
        FROM u LEFT JOIN best USING (page_id)
    """,
    "op11_chat_formatting": """
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
            UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
        marked AS (
            SELECT *,
                   CASE WHEN contains(text, '<|') OR regexp_matches(text, '<\\\\+\\|')
                        THEN len(regexp_extract_all(text, '<\\\\*\\|')) ELSE 0 END AS more_text,
                   len(regexp_extract_all(role, '[<\\\\\\n]')) AS more_role
            FROM turns),
        whole AS (
            SELECT conv_id, count(*)::BIGINT AS n_turns,
                   string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
                   coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
                   sum(length('<|im_start|>') + length(role) + more_role + 1 + length(text) + more_text
                       + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
            FROM marked GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
               sha256(loss) AS loss_sha256, formatted_chars
        FROM whole
    """,
    "op12_periodic_runs": """
        WITH split AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS own,
                   xor(list_reduce(
                       [4294967295] || [ascii(c)::BIGINT FOR c IN string_split(coalesce(doc_id::VARCHAR, ''), '')],
                       lambda crc, byte: list_reduce([xor(crc, byte)] || range(8),
                           lambda x, _: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) AS h
            FROM (SELECT * FROM documents)),
        planned AS (
            SELECT *, row_number() OVER () AS d, len(own) AS n, h // 10 AS g FROM split),
        placed AS (
            SELECT *, g % greatest(n, 1) AS a, 1 + (n - g % greatest(n, 1)) // (3 + g % 8) AS p FROM planned),
        docs AS (
            SELECT d, doc_id, n,
                   CASE WHEN h % 10 = 0 AND n > 0
                        THEN [own[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END] FOR i IN range(n)]
                        ELSE own END AS w
            FROM placed),
        words AS (SELECT d, unnest(range(n)) AS i, unnest(w) AS w FROM docs),
        grams AS (
            SELECT d, i, concat_ws(' ', w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o,
                                   lead(w, 5) OVER o) AS gram, lead(w, 5) OVER o IS NOT NULL AS whole
            FROM words WINDOW o AS (PARTITION BY d ORDER BY i)),
        pairs AS (
            SELECT x.d, x.i, y.i - x.i AS q FROM grams x JOIN grams y ON x.d = y.d AND x.gram = y.gram AND x.i < y.i
            WHERE x.whole AND y.whole),
        stretches AS (
            SELECT d, q, min(i) AS s, max(i) + 6 + q AS e
            FROM (SELECT *, i - row_number() OVER (PARTITION BY d, q ORDER BY i) AS island FROM pairs)
            GROUP BY d, q, island),
        runs AS (
            SELECT d, s, e - s AS length, min(q) AS q FROM stretches WHERE e - s >= greatest(12, 2 * q) GROUP BY d, s, e),
        per_doc AS (
            SELECT d, count(*) AS n_runs, string_agg(concat(s, ',', length, ',', q, chr(10)), '' ORDER BY s, q) AS listed,
                   arg_max({'s': s, 'length': length, 'q': q}, (length, -s, -q)) AS best
            FROM runs GROUP BY d),
        dropped AS (SELECT DISTINCT d, unnest(range(s + q, s + length)) AS i FROM runs),
        kept AS (SELECT d, string_agg(w, ' ' ORDER BY i) AS text FROM words ANTI JOIN dropped USING (d, i) GROUP BY d)
        SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.s::BIGINT AS start, best.length::BIGINT AS length,
               best.q::BIGINT AS period, (1000 * best.length // best.q)::BIGINT AS exponent_milli,
               sha256(coalesce(listed, '')) AS runs_sha256,
               sha256(coalesce(kept.text, '')) AS collapsed_sha256
        FROM docs LEFT JOIN per_doc USING (d) LEFT JOIN kept USING (d)
    """,
    "op13_filter_audit": """
        WITH docs AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        marked AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
        failing AS (
            SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                   {'A': len(w) < 200, 'B': 100 * len(list_distinct(w)) < 50 * len(w),
                    'C': 100 * len(regexp_extract_all(text, '[A-Z]')) > 3 * length(text),
                    'D': regexp_matches(text, '[#$%&*|]'),
                    'E': coalesce(docs.doc_id > min(docs.doc_id) OVER (PARTITION BY text), false)} AS fails
            FROM docs LEFT JOIN marked ON docs.doc_id = marked.doc_id),
        cells AS (
            SELECT part, CASE WHEN fails.A THEN 'A' ELSE '' END || CASE WHEN fails.B THEN 'B' ELSE '' END
                         || CASE WHEN fails.C THEN 'C' ELSE '' END || CASE WHEN fails.D THEN 'D' ELSE '' END
                         || CASE WHEN fails.E THEN 'E' ELSE '' END AS failed,
                   count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
            FROM failing GROUP BY ALL),
        f(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
        orders AS (
            SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
            WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
        steps AS (
            SELECT filter_order, step::INT AS step, filter_order[step:step] AS own, left(filter_order, step - 1) AS earlier
            FROM orders, range(1, 6) r(step)),
        counted AS (
            SELECT part, filter_order, step, own,
                   coalesce(sum(n) FILTER (translate(failed, earlier || own, '') = failed), 0)::BIGINT AS kept,
                   coalesce(sum(n) FILTER (contains(failed, own) AND translate(failed, earlier, '') = failed), 0)::BIGINT AS removed,
                   coalesce(sum(n) FILTER (contains(failed, own) AND translate(failed, earlier, '') <> failed), 0)::BIGINT AS redundant,
                   coalesce(sum(n) FILTER (failed = own), 0)::BIGINT AS unique_fails,
                   coalesce(sum(good) FILTER (contains(failed, own) AND translate(failed, earlier, '') = failed), 0)::BIGINT AS good_lost,
                   coalesce(sum(toxic) FILTER (contains(failed, own) AND translate(failed, earlier, '') = failed), 0)::BIGINT AS toxic_lost
            FROM cells, steps GROUP BY part, filter_order, step, own)
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley
        FROM counted
    """,
}
