"""Name normalisation: compatibility decomposition, accents dropped, lower case, trimmed.

Decomposing and then dropping combining marks maps every code point on its own, so the whole
transformation is a character table. The tables are derived from ``unicodedata`` on first use
and run as ``translate`` on the JVM: no Python worker takes part.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column, functions as F

from courtside.functions.cleaning import ColumnLike, as_column

#: Characters that count as white space at the ends of a name and between words of a page.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(map(chr, range(0x2000, 0x200B)))
    + "\u2028\u2029\u202f\u205f\u3000"
)


#: Names of usual European letters are folded by the part of the tables below this code point: the whole
#: tables hold thousands of characters and are compared and looked up at a cost per name.
LATIN_END = 0x250


@lru_cache(maxsize=2)
def _tables(end: int = 0x110000) -> tuple[str, str, dict[int, tuple[str, list[str]]]]:
    """(from, to) for one-to-one folds, and by length the characters that fold to several.

    The latter map a length to its characters and, per position, what each of them has there.
    """
    single_from, single_to, dropped, expanding = [], [], [], {}
    for code in range(0x80, end):
        if 0xD800 <= code <= 0xDFFF:
            continue
        char = chr(code)
        plain = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
        if plain == char:
            continue
        if not plain:
            dropped.append(char)
        elif len(plain) == 1:
            single_from.append(char)
            single_to.append(plain)
        else:
            expanding.setdefault(len(plain), {})[char] = plain
    by_length = {
        n: ("".join(folds), ["".join(plain[at] for plain in folds.values()) for at in range(n)])
        for n, folds in sorted(expanding.items())
    }
    # Characters listed past the end of the replacement string are deleted by translate.
    return "".join(single_from + dropped), "".join(single_to), by_length


def normalize_name(text: ColumnLike) -> Column:
    """Fold a name to plain lower case without accents; a missing name stays missing."""
    text = as_column(text)
    folded = (
        F.when(text.rlike(f"[^\\x00-\\u{LATIN_END - 1:04x}]"), _folded(text, _tables()))
        .when(text.rlike("[^\\x00-\\x7f]"), _folded(text, _tables(LATIN_END)))
        .otherwise(text)
    )
    return F.btrim(F.lower(folded), F.lit(WHITESPACE))


def _folded(text: Column, tables: tuple[str, str, dict[int, tuple[str, list[str]]]]) -> Column:
    single_from, single_to, by_length = tables
    expanding = "".join(chars for chars, _ in by_length.values())

    def expand(char: Column) -> Column:
        widened = F.when(F.lit(False), char)
        for chars, positions in by_length.values():
            parts = [F.translate(char, chars, there) for there in positions]
            widened = widened.when(F.translate(char, chars, "") == "", F.concat(*parts))
        return widened.otherwise(char)

    widened = F.when(
        F.length(F.translate(text, expanding, "")) < F.length(text),
        F.array_join(F.transform(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), expand), ""),
    ).otherwise(text)
    return F.translate(widened, single_from, single_to)
