"""Text, dates, links and ids out of raw page markup, by regular expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from courtside.functions.cleaning import ColumnLike, as_column
from courtside.functions.names import WHITESPACE

_SPACES = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in WHITESPACE) + "]+"
_HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
_HREF = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""


def html_text(html: ColumnLike) -> Column:
    """Drop every tag, collapse white space; a missing page is the empty string."""
    spaced = as_column(html)
    for tag in ("<br>", "<p>", "</p>"):
        spaced = F.replace(spaced, F.lit(tag), F.lit(" "))
    bare = F.regexp_replace(spaced, "<[^>]+>", " ")
    return F.coalesce(F.trim(F.regexp_replace(bare, _SPACES, " ")), F.lit(""))


def labelled_date(text: ColumnLike, label: str = "Tip off") -> Column:
    """First ``d/m/y`` after ``label`` as ``yyyy-mm-dd`` text; null where there is none."""
    found = F.regexp_extract(as_column(text), rf"(?i){label}.*?(\d{{1,2}}/\d{{1,2}}/\d{{2,4}})", 1)
    fields = F.split(F.nullif(found, F.lit("")), "/")
    day, month, year = (F.get(fields, F.lit(i)) for i in range(3))
    full_year = F.when(F.length(year) == 2, F.concat(F.lit("20"), year)).otherwise(year)
    return F.concat(full_year, F.lit("-"), F.lpad(month, 2, "0"), F.lit("-"), F.lpad(day, 2, "0"))


def hrefs(html: ColumnLike) -> Column:
    """Targets of all anchors in page order, outside comments, scripts and styles."""
    visible = F.regexp_replace(as_column(html), _HIDDEN, " ")
    raw = F.regexp_extract_all(visible, F.lit(_HREF), F.lit(1))
    return F.transform(raw, lambda h: F.replace(F.btrim(h, F.lit("\"'")), F.lit("&amp;"), F.lit("&")))


def link_id(url: ColumnLike, patterns: Sequence[str], hosts: Sequence[str] = ()) -> Column:
    """Id in ``url`` by the first pattern that hits; null for other hosts or without a hit."""
    url = as_column(url)
    hit = F.coalesce(*[F.nullif(F.regexp_extract(url, p, 1), F.lit("")) for p in patterns])
    if not hosts:
        return hit
    known = F.lit(False)
    for host in hosts:
        known = known | url.contains(host)
    return F.when(known, hit)
