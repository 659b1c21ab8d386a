"""Column expressions against plain Python."""

import datetime as dt
import math
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from courtside import functions as fn
from courtside.functions.labels import position_rules

TIMES = [None, "", "12:30", "5:38", "00:38:70", "12", "12.5", "DNP", "1:x", ":", " 7 : 30 ", "10:09.5", "7:", "nan"]


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r.o for r in df.select("i", expr.alias("o")).orderBy("i").collect()]


def guarded(read):
    def run(text):
        try:
            return 0.0 if text is None else read(text)
        except (ValueError, IndexError):
            return 0.0

    return run


@guarded
def minutes(text):
    fields = text.split(":")
    return int(fields[0]) + int(fields[1]) / 60


@guarded
def clock(text):
    fields = text.split(":")
    return int(fields[0]) * 60 + float(fields[1]) if len(fields) >= 2 else float(text)


def close(got, want):
    return all(
        (a is None and b is None) or a == b or (math.isnan(a) and math.isnan(b)) or abs(a - b) < 1e-12
        for a, b in zip(got, want, strict=True)
    )


def test_minutes(spark):
    assert close(column(spark, TIMES, fn.minutes_of("v")), map(minutes, TIMES))


def test_clock(spark):
    assert close(column(spark, TIMES, fn.clock_seconds("v")), map(clock, TIMES))


def test_minutes_lenient(spark):
    texts = [None, "12:30", "1:2:3", "1:x", "12.5", "7", "DNP"]
    assert column(spark, texts, fn.minutes_lenient("v")) == [0.0, 12.5, 0.0, 0.0, 12.5, 7.0, None]


def test_dates_and_numbers(spark):
    days = [None, "2023-09-23", "unknown", "2023-13-01"]
    assert column(spark, days, fn.to_date_safe("v")) == [None, dt.date(2023, 9, 23), None, None]
    assert column(spark, [None, "3", "x", "-1.5", "nan"], fn.to_num("v")) == [0.0, 3.0, 0.0, -1.5, 0.0]


def test_ratios(spark):
    dens = [0.0, 0.5, 2.0, None]
    assert column(spark, dens, fn.ratio_zero_one(F.lit(3.0), "v"), "double") == [3.0, 6.0, 1.5, None]
    assert column(spark, dens, fn.ratio_floor_one(F.lit(3.0), "v"), "double") == [3.0, 3.0, 1.5, None]
    assert column(spark, dens, fn.ratio_or_zero(F.lit(3.0), "v"), "double") == [0.0, 6.0, 1.5, None]


def plain_name(text):
    kept = [c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)]
    return "".join(kept).lower().strip()


def test_names(spark):
    rng = random.Random(1)
    # Letters of scripts whose lower case both languages have known for long.
    pool = [chr(c) for c in [*range(1, 0x500), *range(0x1E00, 0x2200), *range(0xFB00, 0xFB50), *range(0xAC00, 0xAD00)]]
    names = ["J. Říčný ", "  ŠKODA\xa0", "ﬁne ½", "한국", "Łódź", "İzmir", "ΟΔΟΣ", "　x ", ""]
    names += ["".join(rng.choices(pool, k=12)) for _ in range(300)]
    assert column(spark, names, fn.normalize_name("v")) == [plain_name(n) for n in names]
    assert column(spark, [None], fn.normalize_name("v")) == [None]


def test_every_accented_letter(spark):
    letters = [chr(c) for c in range(0xC0, 0x250)]
    assert column(spark, letters, fn.normalize_name("v")) == [plain_name(c) for c in letters]


def test_html_text(spark):
    pages = [None, "", "<p>a</p>b<br>c", "x<b\n class='q'>y</b>\xa0 z", " <i></i> "]
    assert column(spark, pages, fn.html_text("v")) == ["", "", "a b c", "x y z", ""]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Tip off 23/9/23 18:00", "2023-09-23"),
        ("... TIP OFF: Sat 1/12/2024, tip off 2/2/02", "2024-12-01"),
        ("1/2/2003 then nothing", None),
        ("Tip off soon", None),
    ],
)
def test_labelled_date(spark, text, want):
    assert column(spark, [text], fn.labelled_date("v")) == [want]


def test_hrefs_and_ids(spark):
    page = (
        "<!-- <a href='/match/1'>x</a> --><a class=c href=\"/match/22/x\">y</a><a data-href='/no'>z</a>"
        "<A HREF='https://live.example/webcast/ABC/555/'>l</A><a href=https://live.example/?a=1&amp;id=77>m</a>"
        "<script>var s=\"<a href='/match/9'>\";</script>"
    )
    targets = ["/match/22/x", "https://live.example/webcast/ABC/555/", "https://live.example/?a=1&id=77"]
    assert column(spark, [page], fn.hrefs("v")) == [targets]
    patterns, hosts = [r"webcast/[^/]+/(\d+)", r"id=(\d+)"], ["live.example"]
    urls = [*targets, "https://other.example/?id=3"]
    assert column(spark, urls, fn.link_id("v", patterns, hosts)) == [None, "555", "77", None]


def test_normal_cdf(spark):
    zs = [i / 20 for i in range(-120, 121)]
    got = column(spark, zs, fn.normal_cdf("v"), "double")
    assert max(abs(g - (1 + math.erf(z / 2**0.5)) / 2) for g, z in zip(got, zs)) < 1e-7


def test_over_under_without_spread(spark):
    assert column(spark, [4.0, 5.0, 6.0], fn.over_under("v", F.lit(0.0), F.lit(5.0)), "double") == [0.0, 0.5, 1.0]


def test_edge_rule(spark):
    mus = [20.0, 10.0, 15.5, 30.0]
    bets = column(spark, mus, fn.edge_rule("v", F.lit(15.0), fn.over_under("v", F.lit(4.0), F.lit(15.0)), 3.61), "double")
    assert bets == ["over", "under", None, "over"]


def test_season_weight(spark):
    days = [dt.date(2024, 8, 6), dt.date(2024, 8, 5), dt.date(2023, 8, 6), dt.date(2023, 8, 5), None]
    assert column(spark, days, fn.season_weight("v", "2024-10-01"), "date") == [1.0, 0.7, 0.7, 0.4, 0.4]
    assert column(spark, days, fn.season_weight("v", None), "date") == [1.0] * 5
    assert column(spark, days, fn.season_weight("v", "soon"), "date") == [1.0] * 5


def test_positions(spark):
    rows = [(7, 1, 5, 20), (7, 0, 4, 20), (5, 0, 1, 20), (1, 0, 1, 13), (1, 0, 3, 13), (1, 0, 1, 5)]
    rows = [tuple(map(float, row)) for row in rows]
    df = spark.createDataFrame(rows, "rebounds double, blocks double, assists double, points double")
    assert [r[0] for r in df.select(fn.classify(position_rules())).collect()] == ["C", "PG", "PF", "SG", "SF", "SF"]


def test_codes_and_flags(spark):
    assert column(spark, ["PG", "SG", "SF", "PF", "C", "F", "?", None], fn.code_map("v")) == [1, 2, 3, 4, 5, 3, 3, 3]
    assert column(spark, [-16.0, 15.0, 15.5, None], fn.abs_over("v"), "double") == [1, 0, 1, 0]
    assert column(spark, ["a", "b", None], fn.equals_flag("v", F.lit("a"))) == [1, 0, 0]


def test_shots(spark):
    rows = [(5.0, 50.0), (95.0, 58.0), (30.0, 10.0), (50.0, 50.0), (7.02, 43.56)]
    df = spark.createDataFrame(rows, "x double, y double")
    got = df.select(fn.quality_flag(fn.min_distance("x", "y"), "y").alias("q")).collect()
    assert [r.q for r in got] == [1, 0, 1, 0, 1]


def test_combine(spark):
    df = spark.createDataFrame([(10.0, 0.5), (-1.0, 0.5), (10.0, -0.5)], "m double, r double")
    assert [r[0] for r in df.select(fn.combine("m", "r")).collect()] == [5.0, 0.0, 0.0]
