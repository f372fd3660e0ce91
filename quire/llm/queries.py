"""Registered queries of the numbered operators, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.checkpoint import shared_path
from . import (bpe, compressed, curvepack, exactdedup, neardedup, packing, pfor, piececount, qualityrules, secretscan,
               spelling, urlfilter, vectorcodes)
from .common import documents

END_ID = 2
CAPACITY = 1024
CURVE_END_ID = 1
CURVE_CAPACITY = 2048
TOKEN_LIMIT = 4096
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE: ids of every document and the bytes they decode to."""
    coded = bpe.encode(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best-fit packing of every document into sequences of 1024 tokens."""
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), END_ID, CAPACITY)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written as packed files and read back."""
    path = shared_path(spark, "tokens")
    pfor.write_tokens(documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    return pfor.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by compressed sizes."""
    return compressed.quality_scores(documents(spark, sf_dir), _labels(spark, sf_dir))


def op5_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every document and the verdict of the boosted trees."""
    docs = documents(spark, sf_dir)
    found = qualityrules.judged(docs, qualityrules.fit(docs, _labels(spark, sf_dir)))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        "base_failed", "kept")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document by the sentencepiece model."""
    return piececount.token_counts(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), TOKEN_LIMIT)


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the url of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return urlfilter.judge_urls(pages, spark.createDataFrame(URL_RULES, "rule string, verdict string"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies of every document up to white space."""
    return exactdedup.exact_dedup(documents(spark, sf_dir))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents with shingle similarity of 0.85 or more."""
    return neardedup.near_duplicates(documents(spark, sf_dir), neardedup.MinHash(percent=85, slack=0.09))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, found by the blob ledger."""
    found = secretscan.secret_spans(documents(spark, sf_dir))
    spelt = secretscan.spelt(F.col("spans"))
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = {k})) as long) as n_{r.kind}")
              for k, r in enumerate(secretscan.RULES)]
    return found.select("doc_id", *counts, F.sha2(spelt, 256).alias("base_sha256"), spelt.alias("spans"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document with the frequent spelling that each is a variant of."""
    return spelling.variants(documents(spark, sf_dir)).select("word", "form", "root", "n", "n_near", "form_n")


def op12_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packing of every document along a Hilbert curve into sequences of up to 2048 tokens."""
    pieces = curvepack.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), CURVE_END_ID,
                            CURVE_CAPACITY)
    return curvepack.with_crc32(pieces)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of every vector by codebooks of 64 entries for each of 16 parts."""
    coded, books = vectorcodes.vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return coded.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
                        F.lit(books.sha256() if books else None).cast("string").alias("codebooks_sha256"))


QUERIES = {f.__name__: f for f in (op1_bpe, op2_packing, op3_token_files, op4_quality, op5_rules,
                                  op6_token_counts, op7_urls, op8_exact_dedup, op9_near_dedup, op10_secrets,
                                  op11_spelling, op12_curve_packing, op13_vector_codes)}
_WORD_CASE = "(password|passwd|secret|token|api_?key)"
_EITHER = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in _WORD_CASE)

OP8_SQL = r"""
WITH t AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""

# gaps between matches and the matches themselves alternate; starts are running sums
OP10_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
r(kind, nth, pattern, grp, least) AS (VALUES
    ('assign', 0, '{_EITHER}["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 8),
    ('access', 1, '(AKIA[A-Z0-9]+)', 1, 16),
    ('hex', 2, '([0-9a-f]+)', 1, 32)),
m AS (
    SELECT doc_id, kind, nth, least,
        CASE nth WHEN 0 THEN string_split_regex(text, '{_EITHER}["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)')
                 WHEN 1 THEN string_split_regex(text, 'AKIA[A-Z0-9]+')
                 ELSE string_split_regex(text, '[0-9a-f]+') END AS gaps,
        CASE nth WHEN 0 THEN regexp_extract_all(text, '{_EITHER}["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 0)
                 WHEN 1 THEN regexp_extract_all(text, 'AKIA[A-Z0-9]+', 0)
                 ELSE regexp_extract_all(text, '[0-9a-f]+', 0) END AS found,
        CASE nth WHEN 0 THEN regexp_extract_all(text, '{_EITHER}["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2)
                 WHEN 1 THEN regexp_extract_all(text, 'AKIA[A-Z0-9]+', 0)
                 ELSE regexp_extract_all(text, '[0-9a-f]+', 0) END AS part
    FROM d, r),
e AS (
    SELECT doc_id, kind, nth, least, unnest(range(1, len(found) + 1)) AS i,
           unnest(found) AS hit, unnest(part) AS val, unnest(gaps[1:len(found)]) AS gap
    FROM m WHERE len(found) > 0),
s AS (
    SELECT doc_id, kind, nth, least, length(val) AS size,
           sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, nth ORDER BY i) - length(hit) AS start,
           sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, nth ORDER BY i) AS stop
    FROM e),
k AS (
    SELECT doc_id, count(*) FILTER (nth = 0) AS n_assign, count(*) FILTER (nth = 1) AS n_access,
           count(*) FILTER (nth = 2) AS n_hex,
           string_agg(concat(kind, ':', start, ':', stop), ',' ORDER BY start, nth) AS spans
    FROM s WHERE size >= least GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN k USING (doc_id)
"""

OP7_SQL = """
WITH u AS (
    SELECT page_id, coalesce(url, '') AS url, strpos(coalesce(url, ''), '://') AS mark FROM pages),
p AS (
    SELECT page_id, CASE WHEN mark = 0 THEN '' ELSE substr(url, mark + 3) END AS rest FROM u),
h AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                              'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r(host, path, rule, verdict) AS (VALUES ('net', '/', 'net/', 'block'), ('example.net', '/en/', 'example.net/en/', 'allow'),
    ('example.com', '/de/', 'example.com/de/', 'block'), ('org', '/fr/', 'org/fr/', 'allow')),
f AS (
    SELECT page_id, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
    FROM h JOIN r ON (h.host = r.host OR suffix(h.host, '.' || r.host)) AND starts_with(h.path, r.path)
    GROUP BY page_id)
SELECT h.page_id, h.host, h.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM h LEFT JOIN f USING (page_id)
"""


def _op13_sql(rounds: int = 2) -> str:
    """Each round: distances of all parts to all entries of their codebook, then means of the parts of an entry."""
    def assigned(r: int) -> str:
        return f"""
a{r} AS (
    SELECT vec_id, part, x, least.e AS e, least.d AS d FROM (
        SELECT vec_id, part, any_value(x) AS x, min({{'d': list_sum(list_transform(list_zip(x, c),
            lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'e': e}}) AS least
        FROM p JOIN c{r} USING (part) GROUP BY vec_id, part))"""

    steps = []
    for r in range(rounds):
        steps += [assigned(r), f"""
m{r} AS (
    SELECT part, e, i, floor(sum(x[i + 1])::DOUBLE / count(*))::BIGINT AS f
    FROM a{r}, range(len(x)) t(i) GROUP BY part, e, i),
c{r + 1} AS (
    SELECT part, e, list(f ORDER BY i) AS c FROM m{r} GROUP BY part, e
    UNION ALL SELECT part, e, c FROM c{r} ANTI JOIN (SELECT DISTINCT part, e FROM m{r}) USING (part, e))"""]
    return """
WITH v AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS q FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
    SELECT vec_id, part, q[part * (len(q) // 16) + 1:(part + 1) * (len(q) // 16)] AS x FROM v, range(16) t(part)),
c0 AS (
    SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS e, x AS c FROM p
    WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT 64)),""" + ",".join([*steps, assigned(rounds)]) + f""",
s AS (
    SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, e)) AS codebooks_sha256 FROM c{rounds}),
w AS (
    SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
    FROM a{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM w JOIN v USING (vec_id), s
"""


ORACLE = {"op7_urls": OP7_SQL, "op8_exact_dedup": OP8_SQL, "op10_secrets": OP10_SQL, "op13_vector_codes": _op13_sql()}
