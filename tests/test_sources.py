"""Documents, files and incremental ingest."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from courtside.sources import documents, files
from courtside.streaming.ingest import ingest_stream

DOCUMENT = {
    "tm": {
        "1": {
            "name": "BK Díly",
            "pl": {
                "4": {"name": "J.", "sName": "Říčný", "sPoints": 10, "sFieldGoalsAttempted": 5, "sFieldGoalsMade": 4,
                      "sMinutes": "10:30", "starter": 1, "shirtNumber": "00"},
                "5": {"pno": 9, "name": "", "scoreboardName": "Nový ", "sTurnovers": 2, "sFoulsPersonal": 3},
                "x": {"name": "no number"},
            },
            "shot": [
                {"pno": 4, "actionType": "2PT", "subType": "Layup", "x": 1.5, "y": 2.0, "r": 1, "per": 1, "actionNumber": 3},
                {"person": "Někdo", "actionType": "3pt", "r": 0, "per": 2, "actionNumber": 99},
            ],
        },
        "2": {"name": "TJ Dub", "pl": {"1": {"scoreboardName": "Solo"}}},
        "away": {"name": "ignored", "pl": {"1": {"name": "x"}}},
    },
    "pbp": [
        {"tno": 1, "pno": 4, "actionNumber": 3, "clock": "09:00", "period": 1, "actionType": "2pt", "success": 1, "s1": 2, "s2": 0},
        {"tno": 2, "pno": 1, "actionNumber": 4, "clock": "08:50", "period": 1, "actionType": "Substitution", "subType": "IN"},
        {"actionNumber": 3, "clock": "08:40", "period": 1, "actionType": "game"},
        {"tno": 2, "pno": 77, "clock": "08:30", "period": 1, "actionType": "foul"},
    ],
}


@pytest.fixture(scope="module")
def raw(spark):
    rows = [(7, json.dumps(DOCUMENT)), (8, "{broken"), (9, None)]
    return documents.parse_documents(spark.createDataFrame(rows, "match_id long, json string"))


def test_players(raw):
    got = {(r.tid, r.pno, r.player) for r in documents.player_dim(raw).collect()}
    assert got == {(1, 4, "j. ricny"), (1, 9, "novy"), (2, 1, "solo")}


def test_events(raw):
    got = documents.pbp_rows(raw).orderBy("seq").collect()
    assert [(r.seq, r.team, r.player, r.action_type, r.sub_type, r.score_home) for r in got] == [
        (0, "bk dily", "j. ricny", "2pt", None, 2),
        (1, "tj dub", "solo", "substitution", "in", None),
        (2, None, None, "game", None, None),
        (3, "tj dub", None, "foul", None, None),
    ]


def test_shots_take_the_last_clock(raw):
    got = documents.shot_rows(raw).orderBy("period").collect()
    assert [(r.team, r.player, r.action, r.result, r.time, r.x) for r in got] == [
        ("bk dily", "j. ricny", "2pt", "made", "08:40", 1.5),
        ("bk dily", "nekdo", "3pt", "missed", None, None),
    ]


def test_box(raw, spark):
    pages = spark.createDataFrame([(7, "<p>Tip<br>off</p> Tip off <b>23/9/23</b>")], "match_id long, html string")
    got = documents.box_rows(raw, documents.match_dates(pages)).orderBy("player").collect()
    assert [(r.player, r.date, r.points, r.fouls, r.efficiency, r.starter, r.jersey) for r in got] == [
        ("j. ricny", "2023-09-23", 10, None, 9, 1, "00"),
        ("novy", "2023-09-23", 0, 3, -2, None, None),
        ("solo", "2023-09-23", 0, None, 0, None, None),
    ]


def test_numbers_as_text(spark):
    doc = {
        "tm": {"1": {"name": "A", "pl": {"x": {"pno": "4", "name": "N", "sPoints": "10", "sReboundsTotal": "2.0", "starter": "1"}},
                     "shot": [{"pno": "4", "x": "1.5", "r": "1", "per": "2", "actionNumber": "7"}]}},
        "pbp": [{"tno": "1", "pno": "4", "actionNumber": 7, "s1": "2", "s2": 0.0, "success": "1", "period": "2", "clock": "09:00"}],
    }
    raw = documents.parse_documents(spark.createDataFrame([(1, json.dumps(doc))], "match_id long, json string"))
    event, shot, line = documents.pbp_rows(raw).first(), documents.shot_rows(raw).first(), documents.box_rows(raw).first()
    assert (event.player, event.score_home, event.score_away, event.success, event.period) == ("n", 2, 0, 1, 2)
    assert (shot.player, shot.x, shot.result, shot.time) == ("n", 1.5, "made", "09:00")
    assert (line.player, line.points, line.rebounds, line.starter) == ("n", 10, 2, 1)


def test_names_agree_between_tables(spark):
    doc = {"tm": {"1": {"name": "A", "pl": {"4": {"name": "first"}, "5": {"pno": 4, "name": "second"}}}}, "pbp": [{"tno": 1, "pno": 4}]}
    raw = documents.parse_documents(spark.createDataFrame([(1, json.dumps(doc))], "match_id long, json string"))
    name = documents.pbp_rows(raw).first().player
    assert {r.player for r in documents.box_rows(raw).collect()} == {name}


def test_links_and_page_ids(spark):
    html = "<a href='/game/5#x'>a</a><a href='/game/5'>b</a><a href='https://live.example/?id=12'>c</a>"
    pages = spark.createDataFrame([(1, html), (2, "<p>none</p>")], "page_id int, html string")
    assert [r.link for r in documents.links(pages, "html", r"/game/\d+", "https://s.example").collect()] == [
        "https://s.example/game/5"
    ]
    ids = documents.page_ids(pages, "html", [r"id=(\d+)"], ["live.example"]).orderBy("page_id").collect()
    assert [r.link_id for r in ids] == ["12", None]


def test_delimited_files(spark, tmp_path):
    header = "match_id;date;team;player;jersey;starter;minutes;points;rebounds;assists;fouls;turnovers;steals;blocks;plus_minus;efficiency\n"
    for season, line in (("a", "1;2023-09-23;BK ;J. X;00;1;10:30;5;1;0;2;1;0;0;-3;4\n"), ("b/c", "2;unknown;DUB;K. Y;7;0;;0;0;0;0;0;0;0;0;0\n")):
        folder = tmp_path / season
        folder.mkdir(parents=True)
        (folder / "box_score.csv").write_text("﻿" + header + line, encoding="utf-8")
    (tmp_path / "other.csv").write_text("x;y\n1;2\n")
    box = files.box_table(files.read_delimited(spark, str(tmp_path), "*box_score*.csv", files.BOX_SCHEMA))
    got = box.orderBy("match_id").collect()
    assert [(r.match_id, str(r.date), r.team, r.player, r.MIN_FL) for r in got] == [
        (1, "2023-09-23", "bk", "j. x", 10.5),
        (2, "None", "dub", "k. y", 0.0),
    ]


def test_files_differ_in_columns_and_number_style(spark, tmp_path):
    schema = "match_id BIGINT, player STRING, success INT, score BIGINT, x DOUBLE"
    files_ = {
        "a/pbp.csv": "match_id;player;success;score;x\n1;A;1;2;0.5\n2;B;;3;\n",
        "b c/pbp.csv": "player;extra;match_id;success\r\nC;zz;9007199254740993;1.0\r\nD;;4;x\r\n",
        "d/pbp.csv": "x;score;success;player;match_id\n1e2;7.0;0.0;\"E;e\";5\n1.5;2.5;1;F;6.0\n",
        "e/pbp.csv": "match_id;player;success;score;x\n",
    }
    for name, text in files_.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text, encoding="utf-8", newline="")
    got = files.read_delimited(spark, str(tmp_path), "*.csv", schema, file_order=True)
    assert got.columns == ["match_id", "player", "success", "score", "x", "seq"]
    assert sorted(tuple(r)[:5] for r in got.fillna({"success": -1, "score": -1, "x": -1}).collect()) == [
        (1, "A", 1, 2, 0.5),
        (2, "B", -1, 3, -1.0),
        (4, "D", -1, -1, -1.0),
        (5, "E;e", 0, 7, 100.0),
        (6, "F", 1, -1, 1.5),
        (9007199254740993, "C", 1, -1, -1.0),
    ]
    assert files.read_delimited(spark, str(tmp_path / "e"), "*.csv", schema).count() == 0


def test_table_sink(spark, tmp_path):
    df = spark.createDataFrame([(1, 2023), (2, 2024)], "id int, season int")
    files.write_table(df, str(tmp_path / "t"), partition_by=["season"])
    files.write_table(df, str(tmp_path / "t"), mode="append", partition_by=["season"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == 4
    files.write_table(df, str(tmp_path / "c"), fmt="csv")
    back = files.read_delimited(spark, str(tmp_path / "c"), "*.csv", "id int, season int")
    assert sorted(back.collect()) == [(1, 2023), (2, 2024)]


def test_id_list(spark):
    df = spark.createDataFrame([("../out\r\n\r\n251, 230x,,\n 77 , 9, 12345678901234567890",)], "value string")
    assert [r.match_id for r in files.parse_id_list(df).collect()] == [251, 77, 9]


def test_scalar_map(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"a. b": 1.5, "c": NaN, "d": 0}')
    got = files.load_scalar_map(spark, str(tmp_path / "m.json")).collect()
    assert {r.player: r.value for r in got} == {"a. b": 1.5, "c": None, "d": 0.0}


def land(folder, name, ids):
    folder.mkdir(exist_ok=True)
    page = "<p>Tip off 1/2/24</p>"
    lines = [json.dumps({"match_id": i, "json": json.dumps(DOCUMENT), "html": page}) for i in ids]
    (folder / name).write_text("\n".join(lines))


def test_ingest_is_incremental(spark, tmp_path):
    landing, out, progress = tmp_path / "landing", str(tmp_path / "out"), str(tmp_path / "progress")

    def run():
        query = ingest_stream(spark, str(landing), out, progress)
        query.awaitTermination()
        counted = {t: spark.read.parquet(f"{out}/{t}").groupBy("match_id").count().collect() for t in ("box", "pbp", "shots")}
        return {t: {r.match_id: r["count"] for r in rows} for t, rows in counted.items()}

    land(landing, "one.json", [1, 2, 2])
    want = {"box": 3, "pbp": 4, "shots": 2}
    assert run() == {t: {1: n, 2: n} for t, n in want.items()}
    land(landing, "two.json", [2, 3])
    assert run() == {t: {1: n, 2: n, 3: n} for t, n in want.items()}
    assert run() == {t: {1: n, 2: n, 3: n} for t, n in want.items()}
    assert {r.date for r in spark.read.parquet(f"{out}/box").select("date").collect()} == {"2024-02-01"}


def test_ingest_replay_overwrites(spark, tmp_path):
    from courtside.streaming.ingest import ingest_batch

    rows = [(1, json.dumps(DOCUMENT), "", "f1"), (1, "{}", "", "f2")]
    batch = spark.createDataFrame(rows, "match_id long, json string, html string, _file string")
    out = str(tmp_path / "out")
    for _ in range(2):
        ingest_batch(batch, 0, out)
    assert spark.read.parquet(f"{out}/box").count() == 3
    ingest_batch(batch, 1, out)
    assert spark.read.parquet(f"{out}/box").where(F.col("batch_id") == 1).count() == 0


def test_ingest_waits_for_a_readable_copy(spark, tmp_path):
    from courtside.streaming.ingest import ingest_batch

    schema = "match_id long, json string, html string, _file string, _landed timestamp"
    at = lambda minute: dt.datetime(2024, 1, 1, 0, minute)
    good, other = json.dumps(DOCUMENT), json.dumps({"tm": {"1": {"name": "late", "pl": {"1": {"name": "x"}}}}})
    page = "<p>Tip off 1/2/24</p>"
    out = str(tmp_path / "out")
    ingest_batch(spark.createDataFrame([(1, "{broken", page, "a", at(1)), (None, good, page, "a", at(1))], schema), 0, out)
    assert spark.read.parquet(f"{out}/done").count() == 0
    assert spark.read.parquet(f"{out}/rejects").count() == 2
    late = [(1, other, None, "a", at(9)), (1, good, page, "z", at(2)), (1, "[]", page, "b", at(1)), (1, None, page, "b", at(1))]
    ingest_batch(spark.createDataFrame(late, schema), 1, out)
    box = spark.read.parquet(f"{out}/box").where("match_id = 1")
    assert box.count() == 3 and {r.date for r in box.select("date").collect()} == {"2024-02-01"}
    ingest_batch(spark.createDataFrame(late[:1], schema), 2, out)
    assert spark.read.parquet(f"{out}/box").count() == 3


def test_parts_of_documents(spark):
    """Parsing only the part of a table, numbers first, gives the rows that whole documents parsed as text give."""
    player = lambda n, **more: {"pno": n, "name": "Žán", "sName": f"N{n}", "sPoints": 7, "sMinutes": "10:30", "starter": 1} | more
    team = lambda **more: {"name": "Ünö", "pl": {"1": player(1), "2": player("2", sPoints="12.0"), "x": player(None)}} | more
    shot = {"pno": 1, "x": 4, "y": "2.5", "r": 1, "per": 2, "actionNumber": 3, "subType": "Dünk"}
    event = {"tno": 1, "pno": 1, "actionNumber": 3, "clock": "09:00", "s1": "4", "period": 1}
    plain = {"tm": {"1": team(pl={"1": player(1)}, shot=[shot | {"y": 2.5}]), "x": team()}, "pbp": [event | {"s1": 4}]}
    mixed = {"tm": {"1": team(shot=[shot, {}]), " 2 ": team(pl=None), "2.0": team()}, "pbp": [event, {}, None]}
    odd = [plain, mixed, {}, {"tm": None}, {"tm": {"1": None}}, {"tm": [1], "pbp": [event]}, {"tm": {"1": {"pl": [3]}}, "pbp": 5}]
    texts = [*map(json.dumps, odd), "", "{", None, json.dumps(plain)[:-3], json.dumps(plain).replace("Ž", "É")]
    raw = spark.createDataFrame(list(enumerate(texts)), "match_id long, json string")
    whole = documents.parse_documents(raw)
    tables = {
        documents.player_dim: documents.PLAYERS_PART,
        documents.pbp_rows: documents.EVENTS_PART,
        documents.shot_rows: documents.SHOTS_PART,
        documents.box_rows: documents.BOX_PART,
    }
    for make, part in tables.items():
        want = sorted(map(str, make(whole).collect()))
        assert want
        for typed_first in (False, True):
            got = make(documents.parse_documents(raw, part=part, typed_first=typed_first)).collect()
            assert sorted(map(str, got)) == want, (make.__name__, typed_first)


def test_raw_documents_are_compiled(spark, sf_dir):
    from courtside.catalog import flattening
    from courtside.catalog.base import Tables

    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan(flattening.raw_documents(Tables(spark, sf_dir)))
    raw = spark.createDataFrame([(1, "{}")], "match_id long, json string")
    assert "sFieldGoalsMade" not in plan(documents.parse_documents(raw, part=documents.PLAYERS_PART, typed_first=True))


def test_usual_letters_fold_like_all(spark):
    import unicodedata

    from courtside.functions.names import LATIN_END, normalize_name

    names = [f"a{chr(c)}B {chr(c)}" for c in range(0x21, 0x400)] + ["Ž\u0301x", "ŉ½", "\U0001d400é"]
    got = spark.createDataFrame([(n,) for n in names], "n string").select("n", normalize_name("n").alias("f")).collect()
    for r in got:
        plain = "".join(c for c in unicodedata.normalize("NFKD", r.n) if not unicodedata.combining(c))
        assert r.f == plain.lower().strip(), r.n
    assert LATIN_END == 0x250
