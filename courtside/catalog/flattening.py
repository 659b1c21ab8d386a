"""Documents, pages and links flattened into rows.

The raw match documents are made from orders, one per row: three teams (one with an id that is no
number), three players a side, a feed with repeated action numbers, and shots.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from courtside.catalog.base import Tables, query
from courtside.functions import efficiency, html_text, labelled_date, link_id
from courtside.functions.names import WHITESPACE
from courtside.sources import documents

def _player(t: int, p: int) -> str:
    return f"""named_struct('pno', IF({p} = 2, NULL, {p}), 'name', IF({p} = 2, '', 'Žán'),
  'sName', IF({p} = 2, '', concat('N', o_custkey % 7, '-{t}')), 'scoreboardName', concat(' SB ', o_orderkey % 5),
  'shirtNumber', '{p}', 'starter', {p % 2}, 'sMinutes', concat(o_orderkey % 40, ':30'),
  'sPoints', (o_orderkey * {p} + {t}) % 30, 'sReboundsTotal', (o_custkey + {p}) % 12,
  'sAssists', IF({p} = 3, NULL, (o_orderkey + {t}) % 9), 'sSteals', {p}, 'sBlocks', {t}, 'sTurnovers', o_custkey % 5,
  'sFoulsPersonal', IF({p} = 1, NULL, 2), 'sPlusMinusPoints', o_orderkey % 21 - 10,
  'sFieldGoalsAttempted', {9 + t}, 'sFieldGoalsMade', o_orderkey % 9,
  'sFreeThrowsAttempted', 4, 'sFreeThrowsMade', o_custkey % 4)"""


def _shot(t: int, s: int) -> str:
    return f"""named_struct('pno', IF({s} = 3, NULL, {s}), 'person', 'Gúest {t}', 'actionType', IF({s} = 2, '3PT', '2pt'),
  'subType', 'JumpShot', 'x', (o_orderkey * {s}) % 101, 'y', (o_custkey * {s} + {t}) % 101, 'r', (o_orderkey + {s}) % 2,
  'per', {s}, 'actionNumber', {s + t})"""


def _team(t: int) -> str:
    players = ", ".join(f"'{p}', {_player(t, p)}" for p in (1, 2, 3))
    shots = ", ".join(_shot(t, s) for s in (1, 2, 3))
    return f"named_struct('name', concat(o_orderpriority, ' É{t}'), 'pl', map({players}), 'shot', array({shots}))"


def _event(e: int) -> str:
    return f"""named_struct('tno', IF({e} = 4, NULL, {e % 2 + 1}), 'pno', {e % 4 + 1}, 'actionNumber', ({e} + o_orderkey % 3) % 4,
  'clock', concat('0{e}:', o_orderkey % 60), 'period', {e % 4 + 1}, 'gt', '{e}', 'actionType', 'Substitution',
  'subType', IF({e} % 2 = 0, 'in', 'OUT'), 'success', {e % 2}, 's1', {e * 2}, 's2', {e})"""


# Written out in full, as fields of lambdas are not compiled.
_DOCUMENT = f"""to_json(named_struct('tm', map('1', {_team(1)}, '2', {_team(2)}, 'x', {_team(3)}),
  'pbp', array({", ".join(map(_event, range(7)))})))"""


def raw_documents(t: Tables) -> DataFrame:
    # One small file of orders becomes many large documents, so the rows are spread out first.
    orders = t.orders.repartition(t.spark.sparkContext.defaultParallelism, "o_orderkey")
    return orders.select(F.col("o_orderkey").alias("match_id"), F.expr(_DOCUMENT).alias("json"))


def _parsed(t: Tables, part: str) -> DataFrame:
    return documents.parse_documents(raw_documents(t), part=part, typed_first=True)


# A player's name by team t and number p, as the flattened rows should show it.
_NAME = "CASE WHEN p = 2 THEN concat('sb ', o_orderkey % 5) ELSE concat('zan n', o_custkey % 7, '-', t) END"
_TEAM_NAME = "concat(lower(o_orderpriority), ' e', t)"


@query(
    "json_explode",
    f"""SELECT o_orderkey AS match_id, CAST(t AS INTEGER) AS tid, CAST(p AS INTEGER) AS pno, {_NAME} AS player
        FROM orders, range(1, 3) AS a(t), range(1, 4) AS b(p)""",
)
def json_explode(t: Tables) -> DataFrame:
    return documents.player_dim(_parsed(t, documents.PLAYERS_PART))


@query(
    "explode_lookup",
    f"""SELECT o_orderkey AS match_id, e AS seq, concat('0', e, ':', o_orderkey % 60) AS clock,
          CASE WHEN e <> 4 THEN {_TEAM_NAME} END AS team,
          CASE WHEN e <> 4 AND p < 4 THEN {_NAME} END AS player,
          CASE WHEN e % 2 = 0 THEN 'in' ELSE 'out' END AS sub_type
        FROM (SELECT *, e % 2 + 1 AS t, e % 4 + 1 AS p FROM orders, range(0, 7) AS a(e))""",
)
def explode_lookup(t: Tables) -> DataFrame:
    return documents.pbp_rows(_parsed(t, documents.EVENTS_PART)).select("match_id", "seq", "clock", "team", "player", "sub_type")


_SHOTS_SQL = """FROM (SELECT *, s AS p FROM orders, range(1, 3) AS a(t), range(1, 4) AS b(s)) sh"""


@query(
    "last_value_map",
    f"""SELECT o_orderkey AS match_id, CAST(s AS INTEGER) AS period,
          (SELECT concat('0', max(e), ':', o_orderkey % 60) FROM range(0, 7) AS c(e)
           WHERE (e + o_orderkey % 3) % 4 = s + t HAVING max(e) IS NOT NULL) AS time {_SHOTS_SQL}""",
)
def last_value_map(t: Tables) -> DataFrame:
    return documents.shot_rows(_parsed(t, documents.SHOTS_PART)).select("match_id", "period", "time")


@query(
    "shot_rows",
    f"""SELECT o_orderkey AS match_id, {_TEAM_NAME} AS team,
          CASE WHEN s = 3 THEN concat('guest ', t) ELSE {_NAME} END AS player,
          CASE WHEN s = 2 THEN '3pt' ELSE '2pt' END AS action, 'jumpshot' AS sub_type,
          CAST((o_orderkey * s) % 101 AS DOUBLE) AS x, CAST((o_custkey * s + t) % 101 AS DOUBLE) AS y,
          CASE WHEN (o_orderkey + s) % 2 = 1 THEN 'made' ELSE 'missed' END AS result {_SHOTS_SQL}""",
)
def shot_rows(t: Tables) -> DataFrame:
    columns = ["match_id", "team", "player", "action", "sub_type", "x", "y", "result"]
    return documents.shot_rows(_parsed(t, documents.SHOTS_PART)).select(*columns)


@query(
    "box_rows",
    f"""SELECT o_orderkey AS match_id, {_TEAM_NAME} AS team, {_NAME} AS player, concat(p, '') AS jersey,
          CAST(p % 2 AS INTEGER) AS starter, concat(o_orderkey % 40, ':30') AS minutes,
          CAST((o_orderkey * p + t) % 30 AS INTEGER) AS points, CAST((o_custkey + p) % 12 AS INTEGER) AS rebounds,
          CAST(CASE WHEN p = 3 THEN 0 ELSE (o_orderkey + t) % 9 END AS INTEGER) AS assists,
          CAST(CASE WHEN p <> 1 THEN 2 END AS INTEGER) AS fouls, CAST(o_orderkey % 21 - 10 AS INTEGER) AS plus_minus,
          CAST((o_orderkey * p + t) % 30 + (o_custkey + p) % 12 + CASE WHEN p = 3 THEN 0 ELSE (o_orderkey + t) % 9 END
            + p + t - (9 + t - o_orderkey % 9) - (4 - o_custkey % 4) - o_custkey % 5 AS INTEGER) AS efficiency
        FROM orders, range(1, 3) AS a(t), range(1, 4) AS b(p)""",
)
def box_rows(t: Tables) -> DataFrame:
    columns = [
        "match_id", "team", "player", "jersey", "starter", "minutes", "points", "rebounds", "assists", "fouls",
        "plus_minus", "efficiency",
    ]
    return documents.box_rows(_parsed(t, documents.BOX_PART)).select(*columns)


@query(
    "efficiency",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_linenumber + l_suppkey % 7 + l_partkey % 5 + l_suppkey % 3 + 1
         - (20 - l_partkey % 11) - (5 - l_suppkey % 4) - l_orderkey % 6 AS efficiency FROM lineitem""",
)
def efficiencies(t: Tables) -> DataFrame:
    e = F.expr
    eff = efficiency(
        "l_linenumber", e("l_suppkey % 7"), e("l_partkey % 5"), e("l_suppkey % 3"), F.lit(1),
        F.lit(20), e("l_partkey % 11"), F.lit(5), e("l_suppkey % 4"), e("l_orderkey % 6"),
    )
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", eff.alias("efficiency"))


_SPACE_CLASS = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in WHITESPACE) + "]+"


def _text_sql(html: str) -> str:
    return f"""trim(regexp_replace(regexp_replace(replace(replace(replace({html}, '<br>', ' '), '<p>', ' '), '</p>', ' '),
      '<[^>]+>', ' ', 'g'), '{_SPACE_CLASS}', ' ', 'g'))"""


@query("html_to_text", f"SELECT page_id, coalesce({_text_sql('html')}, '') AS text FROM pages")
def html_to_text(t: Tables) -> DataFrame:
    return t.pages.select("page_id", html_text("html").alias("text"))


# Every page gets a match header, with the label in some spelling and the date in some length.
_HEADER = """concat(html, CASE page_id % 4 WHEN 0 THEN '<h2>Start</h2>' WHEN 1 THEN '<h2>TIP <b>OFF</b></h2>'
  ELSE '<h2>Tip off</h2>' END, '<p>', page_id % 28 + 1, '/', page_id % 12 + 1, '/', CASE WHEN page_id % 3 = 0
  THEN 2001 ELSE 23 END, '<br>1/2/2003</p>')"""


@query(
    "extract_date",
    f"""SELECT page_id, CASE WHEN d <> '' THEN concat(CASE WHEN length(split_part(d, '/', 3)) = 2 THEN '20' ELSE '' END,
          split_part(d, '/', 3), '-', lpad(split_part(d, '/', 2), 2, '0'), '-', lpad(split_part(d, '/', 1), 2, '0')) END AS date
        FROM (SELECT page_id, regexp_extract({_text_sql(_HEADER)}, '(?i)tip off.*?([0-9]+/[0-9]+/[0-9]+)', 1) AS d FROM pages)""",
)
def extract_date(t: Tables) -> DataFrame:
    return t.pages.select("page_id", labelled_date(html_text(F.expr(_HEADER))).alias("date"))


_VISIBLE_SQL = r"regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', ' ', 'g')"
_HREFS_SQL = rf"""regexp_extract_all({_VISIBLE_SQL}, '(?i)<a\s(?:[^>]*?\s)?href\s*=\s*["'']([^"'']*)["'']', 1)"""


@query(
    "page_links",
    f"""SELECT DISTINCT concat('https://site.example', regexp_extract(h, '/[A-Za-z]+', 0)) AS link
        FROM (SELECT unnest({_HREFS_SQL}) AS h FROM pages) WHERE regexp_matches(h, '/[A-Za-z]+')""",
)
def page_links(t: Tables) -> DataFrame:
    return documents.links(t.pages, "html", "/[A-Za-z]+", "https://site.example")


@query(
    "page_ids",
    f"""SELECT page_id, list_filter(list_transform({_HREFS_SQL}, lambda h: nullif(regexp_extract(h, '/([a-z]{{3,}})$', 1), '')),
          lambda i: i IS NOT NULL)[1] AS link_id FROM pages""",
)
def page_ids(t: Tables) -> DataFrame:
    return documents.page_ids(t.pages, "html", ["/([a-z]{3,})$"]).select("page_id", "link_id")


@query(
    "url_id",
    r"""SELECT page_id, CASE WHEN contains(url, '.com') OR contains(url, '.org') THEN coalesce(
          nullif(regexp_extract(url, '/fr/(\d+)', 1), ''), nullif(regexp_extract(url, '/en/(\d+)', 1), '')) END AS id FROM pages""",
)
def url_id(t: Tables) -> DataFrame:
    return t.pages.select("page_id", link_id("url", [r"/fr/(\d+)", r"/en/(\d+)"], [".com", ".org"]).alias("id"))
