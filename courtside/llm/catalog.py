"""The corpus operators as queries over the test tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, functions as F

from courtside.catalog.base import Tables
from courtside.llm import (
    bpe,
    covertree,
    language,
    minhash,
    negatives,
    packing,
    periodic,
    quality,
    secrets,
    suffixes,
    tokencounts,
    topk,
    urls,
)

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register a corpus query under ``name``."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


def fold(column: str, parts: int) -> Column:
    """Remainder of the checksum of an id as text; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % parts


#: Texts with a score under this are predicted to be bad.
QUALITY_THRESHOLD = 0.3


def quality_model(docs: DataFrame, labels: DataFrame) -> quality.Model:
    """Learned from labelled documents outside the held-out fold."""
    marks = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    return quality.fit(docs, marks.where(fold("doc_id", 5) != 0))


@query("op3_quality_classifier")
def quality_query(t: Tables) -> DataFrame:
    scored = quality.score(t.documents, quality_model(t.documents, t.labels), ["doc_id"])
    return scored.select(
        "doc_id",
        (fold("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"),
    )


@query("op4_byte_bpe")
def bpe_query(t: Tables) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(t.documents, path, public_tokenizers.PATTERN, ["doc_id"])


@query("op5_secret_scan")
def secrets_query(t: Tables) -> DataFrame:
    return secrets.scan(t.documents, ["doc_id"])


@query("op6_language_id")
def language_query(t: Tables) -> DataFrame:
    model = language.fit(t.documents.where(fold("doc_id", 4) != 2).select("text", "lang"))
    found = language.predict(t.documents, model, ["doc_id"])
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "accepted")


def _url_rules_sql() -> str:
    fits = "(host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '{1}')"
    return "\n".join(
        f"SELECT page_id, n, '{verdict}' AS verdict, '{name}{start}' AS rule FROM parsed WHERE {fits.format(name, start)} UNION ALL"
        for verdict, name, start in urls.RULES
    ).removesuffix("UNION ALL")


#: Every token combination of every labelled URL is counted in place of pattern growth.
URLS_SQL = rf"""WITH parsed AS (
  SELECT page_id, row_number() OVER () AS n, coalesce(url, '') AS url,
         coalesce(translate(regexp_extract(url, '(?s)\A.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)\A.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
marks AS (SELECT doc_id AS page_id, max(quality = 0 OR toxic = 1) AS bad FROM labels GROUP BY 1),
tokens AS (
  SELECT n, page_id, list_sort(list_filter([
    'scheme=' || nullif(translate(regexp_extract(url, '\A([A-Za-z][A-Za-z0-9+.-]*)://', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''),
    'host=' || nullif(host, ''), 'tld=' || nullif(split_part(host, '.', -1), ''),
    'site=' || nullif(array_to_string(string_split(host, '.')[-2:], '.'), ''),
    'top=' || nullif(split_part(path, '/', 2), ''), 'ext=' || nullif(regexp_extract(path, '\.([A-Za-z0-9]{{1,8}})\z', 1), ''),
    'query=' || nullif(regexp_extract(url, '\?([^#=&]*)', 1), ''), 'fragment=' || CASE WHEN contains(url, '#') THEN 'yes' END,
    'depth=' || least(len(string_split(path, '/')), 9)], lambda x: x IS NOT NULL)) AS tokens
  FROM parsed),
labelled AS (SELECT tokens, bad FROM tokens JOIN marks USING (page_id) WHERE bad IS NOT NULL),
least_count AS (SELECT greatest({urls.MIN_COUNT}, ceil({urls.MIN_SUPPORT} * count(*))) AS m FROM labelled),
combinations AS (
  SELECT list_filter(tokens, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS needs, bad
  FROM labelled, unnest(range(1, 1 << len(tokens))) AS masks(mask)),
mined AS (
  SELECT needs FROM combinations GROUP BY needs
  HAVING count(*) FILTER (bad) >= (SELECT m FROM least_count) AND count(*) FILTER (bad) >= {urls.MIN_CONFIDENCE} * count(*)),
bad AS (SELECT DISTINCT n FROM tokens JOIN mined ON list_has_all(tokens, needs)),
given AS ({_url_rules_sql()}),
chosen AS (SELECT n, arg_max(verdict, length(rule)) AS verdict, max_by(rule, length(rule)) AS rule FROM given GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN bad.n IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM parsed LEFT JOIN chosen USING (n) LEFT JOIN bad USING (n)"""


@query("op9_url_filter", URLS_SQL)
def urls_query(t: Tables) -> DataFrame:
    marks = t.labels.groupBy(F.col("doc_id").alias("page_id")).agg(
        F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad")
    )
    return urls.judge(t.pages, marks)


@query("op2_best_fit_packing")
def packing_query(t: Tables) -> DataFrame:
    return packing.pack(t.documents, public_tokenizers.path("word_bpe_49k.json"))


@query("op8_minhash_dedup")
def minhash_query(t: Tables) -> DataFrame:
    return minhash.near_duplicates(t.documents, width=3, percent=85)


@query(
    "op10_topk_search",
    """WITH ints AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([a[1] * a[2] FOR a IN list_zip(q.v, c.v)]) AS BIGINT) AS score
  FROM ints q JOIN ints c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
)
def topk_query(t: Tables) -> DataFrame:
    fine = t.embeddings.where(topk.usable("embedding"))
    whole = F.transform("embedding", lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("bigint"))
    return topk.top_k(fine.select("vec_id", whole.alias("v")), 5, "vec_id", "v", F.col("vec_id") % 50 == 0)


@query("op1_suffix_dedup")
def suffix_query(t: Tables) -> DataFrame:
    cut = suffixes.remove_repeats(t.documents, ["doc_id"])
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        (F.size("spans") / 2).cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op7_embedding_dedup")
def embedding_query(t: Tables) -> DataFrame:
    return covertree.near_vectors(t.embeddings)


#: Documents with more tokens are over the limit.
TOKEN_LIMIT = 2048


@query("op11_token_counts")
def token_counts_query(t: Tables) -> DataFrame:
    counted = tokencounts.count_tokens(t.documents, public_tokenizers.path("word_bpe_49k.json"), ["doc_id"])
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Documents of which one in ten by the checksum of its id repeats a part of its words up to its end."""
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(checksum / 10)

    def repeated(words: Column) -> Column:
        start = F.pmod(g, F.size(words))
        period = 1 + F.floor((F.size(words) - start) / (3 + F.pmod(g, F.lit(8))))
        source = lambda i: F.when(i < start, i).otherwise(start + F.pmod(i - start, period))
        return F.array_join(F.transform(words, lambda _, i: F.get(words, source(i.cast("bigint")).cast("int"))), " ")

    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # One element, so that the words are split once and not anew for each of them.
    altered = F.get(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w))), F.lit(0))
    return docs.withColumn("text", F.when(F.pmod(checksum, F.lit(10)) == 0, altered).otherwise(F.col("text")))


@query("op12_periodic_runs")
def periodic_query(t: Tables) -> DataFrame:
    """The runs of the documents with planted repeats, and what is left of them."""
    found = periodic.find_runs(with_planted_runs(t.documents.select("doc_id", "text")), ["doc_id"])
    n = F.expr("size(runs) div 3")
    value = lambda i, k: F.get("runs", (3 * i + k).cast("int"))
    rows = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(
        value(i, 1).alias("length"), (-value(i, 0)).alias("start"), (-value(i, 2)).alias("period")
    )))
    lines = F.transform("rows", lambda r: F.concat_ws(",", (-r.start).cast("string"), r.length.cast("string"), (-r.period).cast("string")))
    best = found.select("doc_id", "collapsed", n.alias("n_runs"), rows.alias("rows")).withColumn("best", F.array_max("rows"))
    length, period = F.col("best.length"), -F.col("best.period")
    return best.select(
        "doc_id",
        "n_runs",
        (-F.col("best.start")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.call_function("div", 1000 * length, period).alias("exponent_milli"),
        F.sha2(F.coalesce(F.concat(F.array_join(lines, "\n"), F.lit("\n")), F.lit("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query(
    "op13_hard_negatives",
    """WITH fine AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.id AS anchor_id, c.id, a.label = c.label AS same, CAST(list_sum([z[1] * z[2] FOR z IN list_zip(a.v, c.v)]) AS BIGINT) AS score
  FROM fine a JOIN fine c ON a.id % 100 = 0 AND a.id <> c.id),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5""",
)
def negatives_query(t: Tables) -> DataFrame:
    fine = t.embeddings.where(topk.usable("embedding"))
    whole = F.transform("embedding", lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("bigint"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(
        fine.select("vec_id", moved.alias("label"), whole.alias("v")), F.col("vec_id") % 100 == 0
    )
