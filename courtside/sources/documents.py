"""Raw match documents (nested JSON) flattened into play-by-play, shot and box rows.

Everything a row of the output needs is inside its own document, so names and clocks are looked
up within the document row and flattening needs no shuffle at all.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from courtside.functions.markup import hrefs, html_text, labelled_date, link_id
from courtside.functions.names import normalize_name
from courtside.functions.ratios import efficiency

#: The fields of a raw match document.
PLAYER_TYPE = (
    "struct<pno:int,name:string,sName:string,scoreboardName:string,shirtNumber:string,starter:int,"
    "sMinutes:string,sPoints:int,sReboundsTotal:int,sAssists:int,sSteals:int,sBlocks:int,sTurnovers:int,"
    "sFoulsPersonal:int,sPlusMinusPoints:int,sFieldGoalsAttempted:int,sFieldGoalsMade:int,"
    "sFreeThrowsAttempted:int,sFreeThrowsMade:int>"
)
SHOT_TYPE = (
    "struct<pno:int,person:string,actionType:string,subType:string,x:double,y:double,r:int,per:int,"
    "actionNumber:int>"
)
EVENT_TYPE = (
    "struct<tno:int,pno:int,actionNumber:int,clock:string,period:int,gt:string,actionType:string,"
    "subType:string,success:int,s1:int,s2:int>"
)
DOCUMENT_TYPE = (
    f"struct<tm:map<string,struct<name:string,pl:map<string,{PLAYER_TYPE}>,shot:array<{SHOT_TYPE}>>>,"
    f"pbp:array<{EVENT_TYPE}>>"
)


#: The parts of a document that each table is made from; what is not listed is passed over while parsing.
_NAMED = "struct<pno:int,name:string,sName:string,scoreboardName:string>"
PLAYERS_PART = f"struct<tm:map<string,struct<pl:map<string,{_NAMED}>>>>"
BOX_PART = f"struct<tm:map<string,struct<name:string,pl:map<string,{PLAYER_TYPE}>>>>"
EVENTS_PART = f"struct<tm:map<string,struct<name:string,pl:map<string,{_NAMED}>>>,pbp:array<{EVENT_TYPE}>>"
SHOTS_PART = (
    f"struct<tm:map<string,struct<name:string,pl:map<string,{_NAMED}>,shot:array<{SHOT_TYPE}>>>,"
    "pbp:array<struct<actionNumber:int,clock:string>>>"
)


def document(json: Column | str, part: str = DOCUMENT_TYPE) -> Column:
    """JSON text to a typed document, numbers given as numbers or as text."""
    # Read with every number as text: a feed may write numbers either way.
    as_text, as_doubles = re.sub(r":(int|double)\b", ":string", part), re.sub(r":int\b", ":double", part)
    return F.from_json(json, as_text).try_cast(as_doubles).try_cast(part)


#: What Spark sets where a document does not have the types it is read with.
_UNFIT = "_unfit"


def parse_documents(
    df: DataFrame, json: str = "json", match: str = "match_id", part: str = DOCUMENT_TYPE, typed_first: bool = False
) -> DataFrame:
    """Landed JSON text to a typed document; an unreadable one has neither teams nor events.

    For a single table give the part that it is made from (``BOX_PART`` and so on). Reading numbers as
    text is slow; with ``typed_first`` they are read as numbers, and only documents that hold others, or
    are broken, are read again as text. That is for feeds that mostly write numbers as numbers.
    """
    if not typed_first:
        return df.select(match, document(json, part).alias("doc"))
    # The option also keeps the optimizer from reading less than the whole part to find misfits.
    fits = F.from_json(json, f"{part[:-1]},{_UNFIT}:string>", {"columnNameOfCorruptRecord": _UNFIT})
    read = df.select(match, F.col(json).alias("_json"), fits.alias("_doc"))
    doc = F.when(F.col(f"_doc.{_UNFIT}").isNull(), F.col("_doc").dropFields(_UNFIT)).otherwise(document("_json", part))
    return read.select(match, doc.alias("doc"))


def _whole(key: Column) -> Column:
    """A map key as a whole number; keys without a digit are not tried, as each failure costs an exception."""
    return F.when(key.rlike("[0-9]"), key.try_cast("int"))


def _teams(raw: DataFrame, match: str) -> DataFrame:
    """One row per team with a whole-number id.

    The outer explode keeps Spark from adding a size filter that would parse each document twice.
    """
    entries = raw.select(match, F.explode_outer("doc.tm").alias("tid", "team"))
    return entries.withColumn("tid", _whole(F.col("tid"))).where("tid is not null")


def _display_name(player: Column) -> Column:
    blank, absent = F.lit(""), F.lit("unknown")
    full = F.concat(F.coalesce(player["name"], blank), F.lit(" "), F.coalesce(player["sName"], blank))
    return F.when(F.trim(full) != "", full).otherwise(F.coalesce(player["scoreboardName"], absent))


def _normalized(df: DataFrame, *names: str) -> DataFrame:
    """Names folded in a step of their own, since folding looks at its input several times."""
    return df.select(*[normalize_name(c).alias(c) if c in names else c for c in df.columns])


def player_dim(raw: DataFrame, match: str = "match_id") -> DataFrame:
    """One row per listed player: team id, number (or else the map key), name."""
    listed = _teams(raw, match).select(match, "tid", F.explode("team.pl").alias("pid", "p"))
    number = F.coalesce("p.pno", _whole(F.col("pid")))
    named = listed.select(match, "tid", number.alias("pno"), _display_name(F.col("p")).alias("player"))
    return _normalized(named.where("pno is not null"), "player")


def _with_lookups(raw: DataFrame, match: str, clocks: bool = False) -> DataFrame:
    """Per document: parallel arrays from team to name, (team, number) to name and, if asked for, action to clock.

    Later entries win, so the arrays are reversed and searched from the front.
    """
    teams = F.filter(
        F.transform(
            F.map_entries("doc.tm"),
            lambda e: F.struct(_whole(e["key"]).alias("tid"), e["value"]["name"].alias("name"), e["value"]["pl"].alias("pl")),
        ),
        lambda t: t["tid"].isNotNull(),
    )
    players = F.flatten(
        F.transform(
            F.col("_teams"),
            lambda t: F.coalesce(
                F.transform(
                    F.map_entries(t["pl"]),
                    lambda p: F.struct(
                        F.concat_ws(":", t["tid"], F.coalesce(p["value"]["pno"], _whole(p["key"]))).alias("id"),
                        _display_name(p["value"]).alias("name"),
                    ),
                ),
                F.array().cast("array<struct<id:string,name:string>>"),
            ),
        )
    )
    latest = lambda field, kind: F.reverse(F.coalesce(F.col(f"doc.pbp.{field}"), F.array().cast(f"array<{kind}>")))
    times = [latest("actionNumber", "int").alias("_actions"), latest("clock", "string").alias("_clocks")] if clocks else []
    return (
        raw.withColumn("_teams", teams)
        .withColumn("_players", F.reverse(players))
        .select(
            match,
            "doc",
            *[c for c in raw.columns if c == "date"],
            F.col("_teams.tid").alias("_tids"),
            F.col("_teams.name").alias("_tnames"),
            F.col("_players.id").alias("_pids"),
            F.col("_players.name").alias("_pnames"),
            *times,
        )
    )


def _find(values: str, keys: str, key: Column) -> Column:
    """Value at the first place where ``keys`` holds ``key``; null without a hit."""
    # Without a hit the place is 0, and what is before the first element is null.
    return F.get(F.col(values), (F.array_position(F.col(keys), key) - 1).cast("int"))


def _player_name(tid: Column, pno: Column) -> Column:
    known = tid.isNotNull() & pno.isNotNull()
    return F.when(known, _find("_pnames", "_pids", F.concat_ws(":", tid, pno)))


def pbp_rows(raw: DataFrame, match: str = "match_id") -> DataFrame:
    """One row per event; ``seq`` keeps the place in the feed."""
    events = _with_lookups(raw, match).select(
        match, "_tids", "_tnames", "_pids", "_pnames", F.posexplode_outer("doc.pbp").alias("seq", "e")
    )
    events = events.where("seq is not null")
    e = lambda field: F.col(f"e.{field}")
    rows = events.select(
        match,
        F.col("seq").cast("bigint").alias("seq"),
        e("period").alias("period"),
        e("clock").alias("clock"),
        e("gt").alias("gt"),
        _find("_tnames", "_tids", e("tno")).alias("team"),
        _player_name(e("tno"), e("pno")).alias("player"),
        e("actionType").alias("action_type"),
        e("subType").alias("sub_type"),
        e("success").alias("success"),
        e("s1").alias("score_home"),
        e("s2").alias("score_away"),
    )
    return _normalized(rows, "team", "player", "action_type", "sub_type")


def shot_rows(raw: DataFrame, match: str = "match_id") -> DataFrame:
    """One row per shot; its clock is that of the last event with the same action number."""
    per_team = _with_lookups(raw, match, clocks=True).select(
        match, "_pids", "_pnames", "_actions", "_clocks", F.explode_outer("doc.tm").alias("tid", "t")
    )
    shots = per_team.withColumn("tid", _whole(F.col("tid"))).where("tid is not null")
    shots = shots.select(
        match, "tid", "_pids", "_pnames", "_actions", "_clocks", F.col("t.name").alias("team"), F.explode("t.shot").alias("s")
    )
    s = lambda field: F.col(f"s.{field}")
    by_number = _player_name(F.col("tid"), s("pno"))
    rows = shots.select(
        match,
        "team",
        F.when(s("pno").isNotNull(), by_number).otherwise(s("person")).alias("player"),
        s("actionType").alias("action"),
        s("subType").alias("sub_type"),
        s("x").alias("x"),
        s("y").alias("y"),
        F.when(s("r") == 1, "made").otherwise("missed").alias("result"),
        s("per").alias("period"),
        _find("_clocks", "_actions", s("actionNumber")).alias("time"),
    )
    return _normalized(rows, "team", "player", "action", "sub_type")


def box_rows(raw: DataFrame, dates: DataFrame | None = None, match: str = "match_id") -> DataFrame:
    """One row per listed player; counts that enter the efficiency default to 0.

    The date is a column ``date`` of ``raw`` beside the document, or comes from ``dates``, one per
    match; without either it is null. Names are looked up by team and number as in the other tables.
    """
    looked_up = _with_lookups(raw, match)
    beside = ["date"] if "date" in raw.columns else []
    per_team = looked_up.select(match, *beside, "_pids", "_pnames", F.explode_outer("doc.tm").alias("tid", "team"))
    listed = per_team.withColumn("tid", _whole(F.col("tid"))).where("tid is not null")
    listed = listed.select(match, *beside, "tid", "_pids", "_pnames", "team.name", F.explode("team.pl").alias("pid", "p"))
    number = F.coalesce("p.pno", _whole(F.col("pid")))
    listed = listed.withColumn("pno", number).where("pno is not null")
    p = lambda field: F.col(f"p.{field}")
    n = lambda field: F.coalesce(p(field), F.lit(0))
    eff = efficiency(
        n("sPoints"), n("sReboundsTotal"), n("sAssists"), n("sSteals"), n("sBlocks"),
        n("sFieldGoalsAttempted"), n("sFieldGoalsMade"), n("sFreeThrowsAttempted"), n("sFreeThrowsMade"),
        n("sTurnovers"),
    )
    box = listed.select(
        match,
        *beside,
        F.col("name").alias("team"),
        _player_name(F.col("tid"), F.col("pno")).alias("player"),
        p("shirtNumber").alias("jersey"),
        p("starter").alias("starter"),
        p("sMinutes").alias("minutes"),
        n("sPoints").alias("points"),
        n("sReboundsTotal").alias("rebounds"),
        n("sAssists").alias("assists"),
        p("sFoulsPersonal").alias("fouls"),
        n("sTurnovers").alias("turnovers"),
        n("sSteals").alias("steals"),
        n("sBlocks").alias("blocks"),
        p("sPlusMinusPoints").alias("plus_minus"),
        eff.alias("efficiency"),
    )
    box = _normalized(box, "team", "player")
    if beside:
        dated = box
    elif dates is None:
        dated = box.withColumn("date", F.lit(None).cast("string"))
    else:
        dated = box.join(dates.select(match, "date"), match, "left")
    first = [match, "date"]
    return dated.select(*first, *[c for c in dated.columns if c not in first])


def match_dates(pages: DataFrame, html: str = "html", match: str = "match_id", label: str = "Tip off") -> DataFrame:
    """The labelled date on every match page as ``yyyy-mm-dd`` text, null where absent."""
    return pages.select(match, labelled_date(html_text(html), label).alias("date"))


def links(pages: DataFrame, html: str, pattern: str, prefix: str = "", out: str = "link") -> DataFrame:
    """Distinct link targets matching ``pattern``, cut to the match and prefixed."""
    hits = F.transform(hrefs(html), lambda h: F.regexp_extract(h, pattern, 0))
    found = pages.select(F.explode(hits).alias("_hit")).where("_hit <> ''")
    return found.select(F.concat(F.lit(prefix), "_hit").alias(out)).distinct()


def page_ids(
    pages: DataFrame, html: str, patterns: Sequence[str], hosts: Sequence[str] = (), out: str = "link_id"
) -> DataFrame:
    """Add the id in the first link of a page that has one; found within the page row."""
    ids = F.filter(F.transform(hrefs(html), lambda h: link_id(h, patterns, hosts)), lambda i: i.isNotNull())
    return pages.withColumn(out, F.get(ids, F.lit(0)))
