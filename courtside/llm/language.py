"""Language identification by compression.

For each language a raw zstandard dictionary holds words of its labelled texts. A text is
reduced to its distinct words in lower case, compressed behind every dictionary, and given the
language with the smallest size. The margin to the second smallest, relative to it, is the score.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, Window, functions as F

from courtside.llm.batches import per_text
from courtside.llm.compression import Sizes

#: Bounds of the model: rows per language, characters taken from each, dictionary size, languages.
DICTIONARY_ROWS = 250
PIECE_CHARS = 400
DICTIONARY_BYTES = 32_000
MAX_LANGUAGES = 500
#: A smaller relative margin than this is too narrow to accept.
MIN_MARGIN = 0.002
UNKNOWN = "und"

_OTHER = re.compile(r"[\W\d_]+")


def words(text: str) -> str:
    """Distinct words in the order of first appearance, lower-cased, without digits and marks."""
    rough = " ".join(dict.fromkeys(text.lower().split()))
    return " ".join(dict.fromkeys(_OTHER.sub(" ", rough).split()))


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """One dictionary per language, from pieces of at most ``DICTIONARY_ROWS`` different labelled texts each.

    The texts are chosen by their hash; copies of one count once. Null texts, null languages and texts without a
    letter teach nothing.
    """
    at = F.pmod(F.hash(text), F.greatest(F.lit(1), F.length(text) - PIECE_CHARS + 1)) + 1
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(
        F.col(lang).cast("string").alias("lang"),
        F.xxhash64(text).alias("order"),
        F.col(text).substr(at, F.lit(PIECE_CHARS)).alias("piece"),
    )
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("order"))
    first = rows.select("lang", "order").distinct().withColumn("rank", rank).where(F.col("rank") <= DICTIONARY_ROWS)
    first = first.select("lang", "order").limit(MAX_LANGUAGES * DICTIONARY_ROWS + 1)
    chosen = rows.join(F.broadcast(first), ["lang", "order"], "left_semi").groupBy("lang", "order").agg(F.min("piece").alias("piece"))
    pieces: dict[str, list[str]] = {}
    for row in sorted(chosen.select("lang", "order", "piece").collect()):
        pieces.setdefault(row.lang, []).append(row.piece)
    if len(pieces) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return {
        k: words(" ".join(v)).encode("utf-8", "surrogatepass")[:DICTIONARY_BYTES] for k, v in sorted(pieces.items())
    }


def predict(
    docs: DataFrame, model: dict[str, bytes], columns: list[str], text: str = "text", min_margin: float = MIN_MARGIN
) -> DataFrame:
    """Add ``lang_pred``, ``score`` (0 to 1) and ``accepted`` from each whole text.

    One row per input row. A null text, a text without a letter and every text where no language
    was learned get ``und``, score 0, not accepted. Equal sizes go to the smaller name with score
    0; a margin under ``min_margin`` is reported as not accepted. With a single learned language
    the score is 1.
    """

    def make() -> Callable[[list[str]], tuple]:
        sizes = {k: Sizes(d) for k, d in model.items()}

        def one(text: str) -> tuple[str, float, bool]:
            data = words(text).encode("utf-8", "surrogatepass")
            if not sizes or not data or not any(map(str.isalpha, text)):
                return UNKNOWN, 0.0, False
            ranked = sorted((size(data), k) for k, size in sizes.items())
            margin = (ranked[1][0] - ranked[0][0]) / ranked[1][0] if len(ranked) > 1 else 1.0
            return ranked[0][1], margin, margin >= min_margin

        return lambda batch: tuple(zip(*map(one, batch)))

    return per_text(docs, [*columns, text], make, "lang_pred string, score double, accepted boolean")
