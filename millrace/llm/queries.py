"""One query per operator, with the SQL it is checked against where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.align import alignment_report
from millrace.llm.decontaminate import contamination
from millrace.llm.exact_dup import exact_dup_groups
from millrace.llm.host_rules import rule_report
from millrace.llm.html_text import extract_text
from millrace.llm.line_dedup import line_dedup_report
from millrace.llm.lm_score import score_corpus
from millrace.llm.merkle import manifest, verify
from millrace.llm.mixing import mix
from millrace.llm.near_dup import near_dup_groups
from millrace.llm.quality import classify
from millrace.llm.token_count import token_counts
from millrace.llm.warc import archive_round_trip


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers  # only the queries that encode need it

    return public_tokenizers.path(name)


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    return archive_round_trip(spark, _table(spark, folder, "pages"))


def op2_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return score_corpus(spark, _table(spark, folder, "documents"))


def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dup_groups(_table(spark, folder, "documents"))


def op5_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract_text(_table(spark, folder, "pages"))


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(_table(spark, folder, "documents"), _tokenizer("word_bpe_49k.json"))


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    return classify(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op8_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mix(_table(spark, folder, "documents"))


def op9_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup_groups(_table(spark, folder, "documents"))


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup_report(_table(spark, folder, "documents"))


def op11_host_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rule_report(_table(spark, folder, "documents"))


def op12_align(spark: SparkSession, folder: str) -> DataFrame:
    return alignment_report(_table(spark, folder, "documents"), _tokenizer("byte_bpe_50k.json"), _tokenizer("piece_bpe_32k.model"))


def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    one_more = F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    return verify(manifest(_table(spark, folder, "documents"), claims={"n_chars": one_more}))


QUERIES = {f.__name__: f for f in (op1_warc, op2_lm_scores, op3_decontaminate, op4_exact_dedup, op5_html_text, op6_token_counts, op7_quality, op8_mix_sources, op9_simhash_near_dedup, op10_line_dedup, op11_host_rules, op12_align, op13_merkle)}

_BLANK_OUT = r"[^\x20\x09-\x0D]"


def _field(name: str) -> str:
    return f"coalesce(CAST(strlen(CAST({name} AS VARCHAR)) AS VARCHAR) || ':' || CAST({name} AS VARCHAR), '-')"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', n_chars, 'text')))})"


_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

ORACLE_SQL: dict[str, str] = {
    "op1_warc": """
        WITH p AS (SELECT page_id, url, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
        g AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS first FROM p)
        SELECT page_id, url, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes,
               array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + CAST((CAST('0x' || substr(x, CAST(5 * (i // 4) + 1 AS INT), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INT), 1)
                   FOR i IN range(32)], '') AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM g""",
    "op4_exact_dedup": f"""
        WITH d AS (SELECT doc_id, {_FOLDED} AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
        FROM d WINDOW g AS (PARTITION BY t)""",
    "op3_decontaminate": rf"""
        WITH d AS (SELECT doc_id, regexp_extract_all({_FOLDED}, '{_WORDS}') AS w FROM documents),
        i AS (SELECT item_id, regexp_extract_all({_FOLDED}, '{_WORDS}') AS w FROM benchmark),
        g AS (SELECT item_id, w, least(len(w), 13) AS n FROM i WHERE len(w) > 0),
        t AS (SELECT DISTINCT item_id, n, array_to_string(w[s + 1:s + n], ' ') AS win
              FROM (SELECT *, unnest(range(len(w) - n + 1)) AS s FROM g)),
        x AS (SELECT doc_id, s, n, array_to_string(w[s + 1:s + n], ' ') AS win
              FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS s FROM d, (SELECT DISTINCT n FROM g) WHERE len(w) >= n)),
        h AS (SELECT doc_id, s, n, item_id FROM x JOIN t USING (n, win)),
        a AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM h) GROUP BY doc_id),
        b AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
              FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM h) GROUP BY doc_id)
        SELECT doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
        FROM d LEFT JOIN a USING (doc_id) LEFT JOIN b USING (doc_id)""",
    "op10_line_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS pos FROM d),
        k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
        r AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
        f AS (SELECT k.*, r.key IS NOT NULL AND k.doc_id <> r.last AS gone FROM k LEFT JOIN r USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM f GROUP BY doc_id""",
    "op11_host_rules": rf"""
        WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
        w AS (SELECT rid, doc_id, source, regexp_extract_all(t, '{_BLANK_OUT}+') AS w, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
                     list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_BLANK_OUT}')) AS l FROM d),
        g AS (SELECT rid, s, array_to_string(w[s + 1:s + 5], ' ') AS win FROM (SELECT rid, w, unnest(range(len(w) - 4)) AS s FROM w WHERE len(w) >= 5)),
        r AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(s, s + 5)) AS p FROM
                     (SELECT rid, s, count(*) OVER (PARTITION BY rid, win) AS times FROM g) WHERE times > 1) GROUP BY rid),
        m AS (SELECT w.rid, doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
                     CAST(n_symbols AS BIGINT) AS n_symbols, CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
                     coalesce(r.n, 0) AS n_repeat_words FROM w LEFT JOIN r USING (rid)),
        f AS (SELECT *, n_words < 10 AS few_words, 100 * n_repeat_words > 20 * n_words AS repeats,
                     10 * n_symbols > n_words AS symbols, 10 * n_dup_lines > 3 * n_lines AS dup_lines FROM m),
        h AS (UNPIVOT (SELECT source, count(*) AS n, count(*) FILTER (few_words) AS few_words, count(*) FILTER (repeats) AS repeats,
                     count(*) FILTER (symbols) AS symbols, count(*) FILTER (dup_lines) AS dup_lines FROM f WHERE source IS NOT NULL GROUP BY source)
              ON few_words, repeats, symbols, dup_lines INTO NAME rule VALUE failed),
        q AS (SELECT *, CAST(round(failed / n, 9) AS DECIMAL(18, 9)) AS rate FROM h),
        p AS (SELECT rule, count(*) AS hosts, CAST(sum(rate) AS DOUBLE) / count(*) AS mean, CAST(sum(rate * rate) AS DOUBLE) AS squares,
                     CAST(sum(CAST(round(1 / n, 9) AS DECIMAL(18, 9))) AS DOUBLE) AS parts FROM q GROUP BY rule),
        v AS (SELECT *, CASE WHEN hosts > 1 THEN (squares - hosts * mean * mean) / (hosts - 1) - mean * (1 - mean) * parts / hosts ELSE 0 END AS spread FROM p),
        k AS (SELECT rule, mean, least(greatest(CASE WHEN spread > 0 THEN mean * (1 - mean) / spread - 1 ELSE 1000 END, 2), 1000) AS weight FROM v),
        bad AS (SELECT DISTINCT source FROM q JOIN k USING (rule) WHERE (failed + mean * weight) / (n + weight) > 0.5)
        SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, few_words OR repeats AS base_failed,
               NOT (few_words OR repeats) AND bad.source IS NULL AS kept FROM f LEFT JOIN bad ON f.source = bad.source""",
    "op13_merkle": f"""
        WITH RECURSIVE c AS (SELECT *, list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT)) AS codes
                   FROM documents),
        t AS (SELECT *, xor(list_reduce(list_prepend(4294967295, codes), lambda x, b: list_reduce(list_concat([xor(x, b)], [0, 0, 0, 0, 0, 0, 0, 0]),
                   lambda y, z: xor(y >> 1, (y & 1) * 3988292384))), 4294967295) AS crc FROM c),
        l AS (SELECT doc_id, lang, {_leaf('n_chars')} AS leaf, {_leaf('(CASE WHEN crc % 7 = 0 THEN n_chars + 1 ELSE n_chars END)')} AS claim FROM t),
        p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, claim) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM l),
        inner_ AS (SELECT lang, 0 AS lvl, pos, n, leaf AS h FROM p UNION ALL
                   SELECT lang, lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM inner_ WHERE n > 1 GROUP BY lang, lvl, pos // 2, n),
        s AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM inner_ WHERE n = 1),
        outer_ AS (SELECT 0 AS lvl, pos, n, h FROM s UNION ALL
                   SELECT lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM outer_ WHERE n > 1 GROUP BY lvl, pos // 2, n),
        fold1 AS (SELECT doc_id, lang, leaf, 0 AS lvl, pos, n, claim AS cur, '' AS proof FROM p UNION ALL
                  SELECT f.doc_id, f.lang, f.leaf, f.lvl + 1, f.pos // 2, (f.n + 1) // 2,
                         sha256(CASE WHEN f.pos % 2 = 1 THEN i.h || f.cur ELSE f.cur || coalesce(i.h, '') END), f.proof || coalesce(i.h, '')
                  FROM fold1 f LEFT JOIN inner_ i ON i.lang IS NOT DISTINCT FROM f.lang AND i.lvl = f.lvl AND i.pos = xor(f.pos, 1) WHERE f.n > 1),
        fold2 AS (SELECT f.doc_id, f.leaf, s.h AS subroot, 0 AS lvl, s.pos, s.n, f.cur, f.proof FROM fold1 f JOIN s ON s.lang IS NOT DISTINCT FROM f.lang WHERE f.n = 1 UNION ALL
                  SELECT f.doc_id, f.leaf, f.subroot, f.lvl + 1, f.pos // 2, (f.n + 1) // 2,
                         sha256(CASE WHEN f.pos % 2 = 1 THEN o.h || f.cur ELSE f.cur || coalesce(o.h, '') END), f.proof || coalesce(o.h, '')
                  FROM fold2 f LEFT JOIN outer_ o ON o.lvl = f.lvl AND o.pos = xor(f.pos, 1) WHERE f.n > 1)
        SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = h AS verified
        FROM fold2 f, (SELECT h FROM outer_ WHERE n = 1) WHERE f.n = 1""",
}
