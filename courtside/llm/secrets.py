"""Secret scan with multipart credential linking.

Strong patterns are reported wherever they match. Weak candidates (an account name, a random-looking
value, an endpoint) are common in clean text, so each is reported only if parts of another
role lie near it: the candidates of a text are cut into scopes, and inside a scope an interval join
looks for a part of each other role that is apart from it by at most ``REACH`` characters. Parts that
overlap do not complete one another. An account or endpoint that overlaps a strong match is not reported
on its own, yet other parts may be linked to it. A credential is complete with a secret and an identifier or
endpoint; a value before the ``@`` of a link is complete with that link.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections import Counter
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from courtside.llm.batches import per_text
from courtside.session import store

#: Fixed patterns of the strong kinds, in the order in which they are listed, with what must hold.
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
MIN_VALUE, MIN_ACCESS = 8, 16
KINDS = ("assign", "access", "hex", "account", "value", "endpoint")

#: Weak kinds and the role that each plays in a credential; the strong ones play one as well.
ACCOUNT = re.compile(r"(?ai)\b(?:user(?:name)?|login|account|client_?id|access_?key(?:_?id)?)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9_.@+-]{3,}")
VALUE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")
ENDPOINT = re.compile(r"(?ai)\b(?:https?|jdbc:[a-z0-9]+|postgres(?:ql)?|mysql|mongodb|redis|amqps?|s3|ftp)://[^\s\"'<>]{3,}")
#: Host and path of a link, or of one in its query; what stands before an ``@`` is no part of them.
LOCATION = re.compile(r"://(?:([^/?#]*)@)?[^?#&]*")
ROLES = {"assign": "secret", "hex": "secret", "value": "secret", "access": "id", "account": "id", "endpoint": "place"}
#: A scope is this many characters; two parts belong together if at most this many lie between them.
SCOPE = 2_000
REACH = 300
MIN_ENTROPY = 3.5
#: Added to the kind of a weak part that is reported whatever lies near it, and of one that overlaps
#: a strong match: it is not reported itself, but other parts may be linked to it.
SURE, SILENT = len(KINDS), 2 * len(KINDS)
#: What a redacted span is replaced by.
MASK = "<redacted>"


def _random_looking(value: str) -> bool:
    """A value with letters and digits whose signs are spread like those of a key."""
    if not any(c.isdigit() for c in value) or not any(c.isalpha() for c in value):
        return False
    n = len(value)
    return -sum(k / n * math.log2(k / n) for k in Counter(value).values()) >= MIN_ENTROPY


def strong(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the strong matches, leftmost and non-overlapping per kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    return sorted(found + [(m.start(), 2, m.end()) for m in HEX.finditer(text)])


def candidates(text: str) -> tuple[list[tuple[int, int, int]], set[tuple[int, int, int]]]:
    """Weak candidates, and those of them that are complete without another: a value before the ``@`` of a link, and the link.

    What lies in the scheme, host or path of a link is no value.
    """
    found = [(m.start(), 3, m.end()) for m in ACCOUNT.finditer(text)]
    values = [(m.start(), 4, m.end()) for m in VALUE.finditer(text) if _random_looking(m[0])]
    links = [(m.start(), 5, m.end()) for m in ENDPOINT.finditer(text)] if "://" in text else []
    sure = set()
    if values and links:
        places, logins = [], []
        for link in links:
            at = link[0]
            for m in LOCATION.finditer(text, link[0], link[2]):
                at = at if at == link[0] else m.start()
                if m[1] is None:
                    places.append((at, m.end()))
                else:
                    places += [(at, m.start(1)), (m.end(1), m.end())]
                    logins.append((m.start(1), m.end(1), link))
                at = m.end()
        values = [v for v in values if _holder(places, v) is None]
        for v in values:
            if login := _holder(logins, v):
                sure |= {v, login[2]}
    return sorted(found + values + links), sure


def _holder(intervals: list[tuple], part: tuple[int, int, int]) -> tuple | None:
    """The one of some intervals, in order and apart, that contains the part."""
    i = bisect.bisect_right(intervals, part[0], key=lambda x: x[0]) - 1
    return intervals[i] if i >= 0 and part[2] <= intervals[i][1] else None


def _overlaps(part: tuple[int, int, int], taken: list[tuple[int, int, int]]) -> bool:
    return any(s < part[2] and part[0] < e for s, _, e in taken)


def weak(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Weak candidates that overlap no strong match."""
    return [w for w in candidates(text)[0] if not _overlaps(w, taken)]


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _scan() -> Callable[[list[str]], tuple]:
    def one(text: str) -> tuple:
        found = strong(text)
        own, sure = candidates(text)
        parts = []
        for s, k, e in own:
            if not _overlaps((s, k, e), found):
                parts.append((s, k + SURE * ((s, k, e) in sure), e))
            elif KINDS[k] != "value":
                parts.append((s, k + SILENT, e))
        counts = Counter(k for _, k, _ in found)
        base = joined(found)
        digest = hashlib.sha256(base.encode()).hexdigest()
        return counts[0], counts[1], counts[2], digest, [v for s in sorted(found + parts) for v in s], bool(parts)

    return lambda batch: tuple(zip(*map(one, batch)))


def _linked(rows: DataFrame) -> DataFrame:
    """Spans of each row with the weak ones that have a complementary part, as (row, spans)."""
    at = F.explode(F.sequence(F.lit(0), F.size("flat") - 1, F.lit(3)))
    value: Callable[[int], Column] = lambda i: F.get("flat", F.col("at") + i)
    kind, state = F.col("code") % len(KINDS), F.floor(F.col("code") / len(KINDS)) * len(KINDS)
    parts = (
        rows.where("has_weak")
        .select("row", "flat", at.alias("at"))
        .select("row", value(0).alias("start"), value(1).alias("code"), value(2).alias("stop"))
        .withColumns({"kind": kind, "state": state})
        .withColumn("secret", F.col("kind").isin([KINDS.index(k) for k in KINDS if ROLES[k] == "secret"]))
    )
    # A part stands in every scope that its widened interval touches, so no pair is lost at a border.
    first, last = F.greatest(F.lit(0), F.floor((F.col("start") - REACH) / SCOPE)), F.floor((F.col("stop") + REACH) / SCOPE)
    placed = parts.withColumn("scope", F.explode(F.sequence(first.cast("int"), last.cast("int"))))
    # Both ends of a part stand in one order: a start looks back for ends, an end looks ahead for starts.
    ends = placed.withColumn("ends", F.explode(F.array(F.lit(False), F.lit(True))))
    ends = ends.withColumn("place", F.when(F.col("ends"), F.col("stop")).otherwise(F.col("start")))
    in_order = Window.partitionBy("row", "scope").orderBy("place")
    before, after = in_order.rangeBetween(-REACH, 0), in_order.rangeBetween(0, REACH)
    near: Callable[[Column], Column] = lambda there: F.when(
        F.col("ends"), F.max(there & ~F.col("ends")).over(after)
    ).otherwise(F.max(there & F.col("ends")).over(before))
    seen = ends.withColumns({"near_secret": near(F.col("secret")), "near_other": near(~F.col("secret"))})
    complete = F.when(F.col("secret"), F.col("near_other")).otherwise(F.col("near_secret"))
    reported = (F.col("kind") < 3) | (F.col("state") == SURE) | (complete & (F.col("state") != SILENT))
    kept = seen.where(reported).select("row", "start", "kind", "stop").distinct()
    name = F.get(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    span = F.struct("start", "kind", "stop", F.concat_ws(":", name, "start", "stop").alias("shown"))
    return kept.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("linked"))


def scan(docs: DataFrame, columns: list[str], text: str = "text") -> DataFrame:
    """Counts of strong matches, their digest, and all spans reported, for each whole text.

    One row per input row: the named columns, ``n_assign``, ``n_access``, ``n_hex``,
    ``base_sha256``, ``spans``. A null or empty text has no match. Repeated rows are scanned each
    on its own; columns not named are not carried. The matches are written once; only rows with
    a weak candidate take part in the linking.
    """
    keep = [f"k{i}" for i in range(len(columns))]
    renamed = docs.select(*[F.col(c).alias(k) for c, k in zip(columns, keep)], F.col(text).alias("t"))
    schema = "n_assign long, n_access long, n_hex long, base_sha256 string, flat array<int>, has_weak boolean"
    rows = store(per_text(renamed, [*keep, "t"], _scan, schema).withColumn("row", F.monotonically_increasing_id()))
    names = F.array(*[F.lit(k) for k in KINDS])
    shown = F.transform(
        F.when(F.size("flat") > 0, F.sequence(F.lit(0), F.size("flat") - 1, F.lit(3))).otherwise(F.array().cast("array<int>")),
        lambda i: F.concat_ws(":", F.get(names, F.get("flat", i + 1)), F.get("flat", i), F.get("flat", i + 2)),
    )
    plain = rows.where(~F.col("has_weak")).withColumn("shown", shown)
    joined_rows = rows.where("has_weak").join(_linked(rows), "row", "left")
    linked = joined_rows.withColumn("shown", F.coalesce("linked.shown", F.array().cast("array<string>"))).drop("linked")
    out = plain.unionByName(linked).withColumn("spans", F.array_join("shown", ","))
    return out.select(
        *[F.col(k).alias(c) for c, k in zip(columns, keep)], "n_assign", "n_access", "n_hex", "base_sha256", "spans"
    )


def masked(text: str, spans: str, mask: str = MASK) -> str:
    """The text with every span, or run of overlapping spans, replaced by ``mask``."""
    out, at = [], 0
    for start, stop in sorted(tuple(map(int, s.split(":")[1:])) for s in spans.split(",")):
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, stop)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with all reported spans of ``text`` masked; the other columns are left as they are.

    A null text stays null. Texts without a span are not touched.
    """
    columns = docs.columns

    @F.pandas_udf("string")
    def mask(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([masked(t, s) for t, s in zip(texts, spans)], dtype=object)

    found = scan(docs, columns, text)
    hit = found.where("spans <> ''")
    clean = found.where("spans = ''").select(*columns)
    return clean.unionByName(hit.withColumn(text, mask(text, "spans")).select(*columns))
