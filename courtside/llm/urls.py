"""URL filter: given host and path rules, and mined association rules where none of them fits.

Everything is DataFrame work. A URL becomes a small set of tokens of fixed kinds. Frequent
pattern growth mines, over the labelled URLs, token combinations that imply a bad label;
combinations under the support or confidence bound are dropped. A rule is posted in an inverted
index under its rarest token, so a URL meets only the rules of its own tokens and is then checked for
the rest of the combination.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from courtside.session import store

#: Given rules: verdict, host, path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: A mined combination holds in at least this share and this number of labelled URLs, and at least
#: this share of the URLs that it holds in is bad.
MIN_SUPPORT, MIN_COUNT, MIN_CONFIDENCE = 0.005, 20, 0.6
BAD = "label=bad"
#: Kinds of tokens; a URL has at most one of each.
KINDS = ("scheme", "host", "tld", "site", "top", "ext", "query", "fragment", "depth")


def _lower(value: Column) -> Column:
    return F.translate(value, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host(url: Column) -> Column:
    """From behind the first ``://`` to ``/``, ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(_lower(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def given(rules: Sequence[tuple[str, str, str]], host_name: Column, path_name: Column) -> Column:
    """The longest rule that fits as a struct of verdict and text, or null."""
    chosen = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, name, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host_name == name) | host_name.endswith(f".{name}")) & path_name.startswith(start)
        made = F.struct(F.lit(verdict).alias("verdict"), F.lit(name + start).alias("rule"))
        chosen = F.when(fits, made).otherwise(chosen)
    return chosen


def tokens(url: Column, host_name: Column, path_name: Column) -> Column:
    """Distinct tokens of a URL, at most one of each kind."""
    text = F.coalesce(url, F.lit(""))
    labels, parts = F.split(host_name, r"\."), F.split(path_name, "/")
    bare = F.regexp_extract(text, r"\?([^#=&]*)", 1)
    values = {
        "scheme": _lower(F.regexp_extract(text, r"\A([A-Za-z][A-Za-z0-9+.-]*)://", 1)),
        "host": host_name,
        "tld": F.element_at(labels, -1),
        "site": F.substring_index(host_name, ".", -2),
        "top": F.coalesce(F.get(parts, F.lit(1)), F.lit("")),
        "ext": F.regexp_extract(path_name, r"\.([A-Za-z0-9]{1,8})\z", 1),
        "query": bare,
        "fragment": F.when(text.contains("#"), F.lit("yes")).otherwise(F.lit("")),
        "depth": F.least(F.size(parts), F.lit(9)).cast("string"),
    }
    made = F.array(*[F.when(values[k] != "", F.concat(F.lit(f"{k}="), values[k])) for k in KINDS])
    return F.array_compact(made)


def mine(
    labelled: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_count: int = MIN_COUNT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """Rules (``rule``, ``needs``: tokens, ``confidence``) from rows with ``tokens`` and boolean ``bad``.

    Without labelled rows, or with fewer than ``min_count``, there are no rules. A URL has at
    most one token per kind, so there are at most 2^9 / ``min_support`` combinations whatever the
    size of the input; the rules are written once.
    """
    spark = labelled.sparkSession
    empty = "rule long, needs array<string>, confidence double"
    rows = store(labelled.where("bad IS NOT NULL").select(
        F.when(F.col("bad"), F.array_append("tokens", F.lit(BAD))).otherwise(F.col("tokens")).alias("items")
    ))
    total = rows.count()
    least = max(min_count, math.ceil(min_support * total))
    if total < max(1, least):
        return spark.createDataFrame([], empty)
    # Half a row below the whole number, so that rounding cannot move the bound.
    growth = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / total, minConfidence=min_confidence)
    model = growth.fit(rows)
    implied = model.associationRules.where(F.col("consequent") == F.array(F.lit(BAD)))
    return store(
        implied.select(F.xxhash64(F.array_sort("antecedent")).alias("rule"), F.col("antecedent").alias("needs"), "confidence")
    )


def matched(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """``row`` of the pages (``row``, ``tokens``) that hold every token of some rule.

    The index lists each rule under its rarest token, where rare is counted over the rules.
    """
    needed = rules.select("rule", "needs", F.explode("needs").alias("token"))
    spread = needed.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    index = (
        needed.join(spread, "token")
        .groupBy("rule")
        .agg(F.min_by("token", F.struct("n", "token")).alias("token"), F.first("needs").alias("needs"))
    )
    met = pages.select("row", "tokens", F.explode("tokens").alias("token")).join(index.select("token", "needs"), "token")
    return met.where(F.size(F.array_except("needs", "tokens")) == 0).select("row").distinct()


def judge(
    pages: DataFrame,
    labels: DataFrame,
    columns: Sequence[str] = ("page_id",),
    url: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    **bounds: float,
) -> DataFrame:
    """``host``, ``path``, ``rule`` and ``verdict`` of every page.

    ``labels`` has one row per labelled key: the first of ``columns`` under its own name, and boolean
    ``bad``. A null URL or one without ``://`` has an empty host and path. Repeated pages are
    each judged; keys without a label only receive verdicts. Columns not named are not carried.
    """
    keep = [f"k{i}" for i in range(len(columns))]
    renamed = [F.col(c).alias(k) for c, k in zip(columns, keep)]
    parsed = pages.select(*renamed, F.col(url).alias("url")).withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    rows = store(
        parsed.withColumns(
            {"tokens": tokens(F.col("url"), F.col("host"), F.col("path")), "row": F.monotonically_increasing_id()}
        ).drop("url")
    )
    known = labels.select(F.col(columns[0]).alias("k0"), "bad")
    combinations = mine(rows.join(known, "k0").select("tokens", "bad"), **bounds)
    bad = matched(rows, combinations).withColumn("bad", F.lit(True))
    fits = given(rules, F.col("host"), F.col("path"))
    return (
        rows.withColumn("given", fits)
        .join(bad, "row", "left")
        .select(
            *[F.col(k).alias(c) for c, k in zip(columns, keep)],
            "host",
            "path",
            F.col("given.rule").alias("rule"),
            F.coalesce(F.col("given.verdict"), F.when(F.col("bad"), "block").otherwise("allow")).alias("verdict"),
        )
    )
