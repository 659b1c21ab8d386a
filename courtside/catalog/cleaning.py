"""Scans, stacking, defaults, parsing, fills and ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from courtside.catalog.base import Tables, day_text, query, r6
from courtside.functions import (
    clock_seconds,
    minutes_lenient,
    minutes_of,
    normalize_name,
    ratio_floor_one,
    ratio_zero_one,
    to_date_safe,
    to_num,
)
from courtside.functions.names import WHITESPACE
from courtside.operators.tables import (
    attach_dim,
    distinct_sorted,
    fill_along,
    fill_numeric,
    new_only,
    union_all,
    with_defaults,
)
from courtside.sources.files import id_list, scalar_map

# A time text in every shape the parsers meet; the same SQL text runs in both engines.
TIME_TEXT = """CASE o_orderkey % 8
  WHEN 0 THEN NULL WHEN 1 THEN 'DNP' WHEN 2 THEN concat(o_custkey % 60, '')
  WHEN 3 THEN concat(o_custkey % 48, ':', o_orderkey % 60, ':', o_orderkey % 100)
  WHEN 4 THEN concat(o_custkey % 48, ':x') WHEN 5 THEN concat(o_custkey % 48, '.5')
  ELSE concat(o_custkey % 48, ':', o_orderkey % 60) END"""
DATE_TEXT = """CASE o_orderkey % 5 WHEN 0 THEN 'unknown' WHEN 1 THEN NULL
  ELSE concat(2000 + o_custkey % 25, '-', 10 + o_orderkey % 4, '-', 10 + o_orderkey % 22) END"""
ID_TEXT = "concat('../data', chr(10), chr(10), user_id, ', ', event_type, ',', event_id, ',,', chr(10), ' ,7', user_id, ' x')"


@query(
    "scan_filter",
    """SELECT l_orderkey, round(l_extendedprice * (1 - l_discount), 6) AS revenue FROM lineitem
       WHERE l_shipdate < TIMESTAMP '1996-07-01' AND l_quantity > 40""",
)
def scan_filter(t: Tables) -> DataFrame:
    kept = t.lineitem.where("l_shipdate < TIMESTAMP_NTZ '1996-07-01' AND l_quantity > 40")
    return kept.select("l_orderkey", r6(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"))


@query(
    "union_missing_cols",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL AS nation FROM customer
       UNION ALL SELECT s_suppkey, s_name, NULL, s_nationkey FROM supplier""",
)
def union_missing_cols(t: Tables) -> DataFrame:
    buyers = t.customer.selectExpr("c_custkey AS id", "c_name AS name", "c_mktsegment AS segment")
    sellers = t.supplier.selectExpr("s_suppkey AS id", "s_name AS name", "s_nationkey AS nation")
    return union_all(buyers, sellers)


@query(
    "default_cols",
    "SELECT o_orderkey, round(o_totalprice, 6) AS o_totalprice, CAST(1.0 AS DOUBLE) AS season_weight, 0 AS starter FROM orders",
)
def default_cols(t: Tables) -> DataFrame:
    slim = t.orders.select("o_orderkey", r6("o_totalprice").alias("o_totalprice"))
    return with_defaults(slim, {"o_totalprice": 0.0, "season_weight": 1.0, "starter": 0})


@query(
    "ingest_anti_join",
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
)
def ingest_anti_join(t: Tables) -> DataFrame:
    done = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return new_only(t.orders.select("o_orderkey", "o_custkey"), done, "o_orderkey")


@query(
    "id_list",
    f"""SELECT event_id, CAST(trim(piece) AS BIGINT) AS match_id FROM (
          SELECT event_id, unnest(string_split(array_to_string(
            list_transform(string_split(txt, chr(10))[3:], lambda x: trim(x)), ''), ',')) AS piece
          FROM (SELECT event_id, {ID_TEXT} AS txt FROM events))
        WHERE regexp_full_match(trim(piece), '[0-9]+')""",
)
def id_lists(t: Tables) -> DataFrame:
    ids = F.explode(id_list(F.expr(ID_TEXT)))
    return t.events.select("event_id", ids.alias("match_id")).withColumn("match_id", F.col("match_id").cast("bigint"))


@query("distinct_ids", "SELECT DISTINCT l_partkey FROM lineitem ORDER BY l_partkey")
def distinct_ids(t: Tables) -> DataFrame:
    return distinct_sorted(t.lineitem, "l_partkey")


@query(
    "json_map_dim",
    """SELECT event_id, 'k' AS name, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS DOUBLE) AS amount FROM events""",
)
def json_map_dim(t: Tables) -> DataFrame:
    return scalar_map(t.events.select("event_id", "props"), "props", "name", "amount")


@query(
    "attach_dim",
    "SELECT documents.doc_id, source, quality, toxic FROM documents LEFT JOIN labels ON documents.doc_id = labels.doc_id",
)
def attach(t: Tables) -> DataFrame:
    return attach_dim(t.documents.select("doc_id", "source"), t.labels, "doc_id")


@query(
    "normalize_names",
    f"SELECT doc_id, lower(trim(strip_accents(text), '{WHITESPACE}')) AS name FROM documents",
)
def normalize_names(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", normalize_name("text").alias("name"))


_TIMES = f"WITH times AS (SELECT o_orderkey, {TIME_TEXT} AS txt FROM orders)"


@query(
    "parse_minutes",
    _TIMES
    + """ SELECT o_orderkey, round(CASE WHEN regexp_matches(txt, '^[0-9]+:[0-9]+(:|$)')
          THEN CAST(split_part(txt, ':', 1) AS BIGINT) + CAST(split_part(txt, ':', 2) AS BIGINT) / 60
          ELSE 0.0 END, 6) AS minutes FROM times""",
)
def parse_minutes(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", r6(minutes_of(F.expr(TIME_TEXT))).alias("minutes"))


@query(
    "parse_minutes_lenient",
    _TIMES
    + """ SELECT o_orderkey, round(CASE WHEN txt IS NULL THEN 0.0
          WHEN regexp_full_match(txt, '[0-9]+:[0-9]+')
          THEN CAST(split_part(txt, ':', 1) AS BIGINT) + CAST(split_part(txt, ':', 2) AS BIGINT) / 60
          WHEN contains(txt, ':') THEN 0.0 ELSE TRY_CAST(txt AS DOUBLE) END, 6) AS minutes FROM times""",
)
def parse_minutes_lenient(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", r6(minutes_lenient(F.expr(TIME_TEXT))).alias("minutes"))


@query(
    "parse_clock",
    _TIMES
    + """ SELECT o_orderkey, round(coalesce(CASE WHEN contains(txt, ':')
          THEN CAST(split_part(txt, ':', 1) AS BIGINT) * 60 + TRY_CAST(split_part(txt, ':', 2) AS DOUBLE)
          ELSE TRY_CAST(txt AS DOUBLE) END, 0.0), 6) AS sec FROM times""",
)
def parse_clock(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", r6(clock_seconds(F.expr(TIME_TEXT))).alias("sec"))


@query(
    "parse_dates",
    f"SELECT o_orderkey, strftime(TRY_CAST({DATE_TEXT} AS DATE), '%Y-%m-%d') AS date FROM orders",
)
def parse_dates(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", day_text(to_date_safe(F.expr(DATE_TEXT))).alias("date"))


_GAPS = "CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate END"


def _filled_sql(partition: str) -> str:
    return f"""SELECT * FROM (SELECT o_orderkey, o_custkey, strftime(coalesce(
        last_value({_GAPS} IGNORE NULLS) OVER ({partition} ORDER BY o_orderkey
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        first_value({_GAPS} IGNORE NULLS) OVER ({partition} ORDER BY o_orderkey
          ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)), '%Y-%m-%d') AS date
      FROM orders) WHERE date IS NOT NULL"""


def _gappy(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_custkey", F.expr(_GAPS).alias("date"))


@query("ffill_bfill", _filled_sql("PARTITION BY o_custkey"))
def ffill_bfill(t: Tables) -> DataFrame:
    return fill_along(_gappy(t), "date", "o_orderkey", "o_custkey").withColumn("date", day_text("date"))


@query("ffill_global", _filled_sql(""))
def ffill_global(t: Tables) -> DataFrame:
    return fill_along(_gappy(t), "date", "o_orderkey").withColumn("date", day_text("date"))


@query(
    "fill_zero",
    """SELECT l_orderkey, l_linenumber, round(coalesce(nullif(l_tax, 0.05), 0), 6) AS l_tax,
         coalesce(nullif(l_suppkey, 3), 0) AS l_suppkey, nullif(l_returnflag, 'A') AS l_returnflag FROM lineitem""",
)
def fill_zero(t: Tables) -> DataFrame:
    gaps = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        r6(F.expr("nullif(l_tax, 0.05D)")).alias("l_tax"),
        F.expr("nullif(l_suppkey, 3)").alias("l_suppkey"),
        F.expr("nullif(l_returnflag, 'A')").alias("l_returnflag"),
    )
    return fill_numeric(gaps)


@query("coerce_num", _TIMES + " SELECT o_orderkey, coalesce(TRY_CAST(txt AS DOUBLE), 0.0) AS amount FROM times")
def coerce_num(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", to_num(F.expr(TIME_TEXT)).alias("amount"))


@query(
    "safe_ratio",
    """SELECT l_orderkey, l_linenumber, l_partkey,
         round(l_quantity / CASE WHEN l_tax = 0 THEN 1 ELSE l_tax END, 6) AS zero_is_one,
         round(l_quantity / greatest(l_tax * 20, 1), 6) AS floored FROM lineitem""",
)
def safe_ratio(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        r6(ratio_zero_one("l_quantity", "l_tax")).alias("zero_is_one"),
        r6(ratio_floor_one("l_quantity", F.col("l_tax") * 20)).alias("floored"),
    )
