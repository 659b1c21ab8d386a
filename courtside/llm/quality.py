"""Quality classifier by compression.

A text that compresses better behind good examples than behind bad ones is likely good. Two raw
zstandard dictionaries hold pieces of good and of bad labelled texts, two more hold the same pieces
reduced to their shape (letters, digits and marks with runs of one kind as one sign). The size
differences, normalised by the larger size, go with the size under no dictionary and the length of
the text into a logistic curve, fitted on labelled rows that are in no dictionary.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from courtside.llm.batches import per_text
from courtside.llm.compression import Sizes
from courtside.session import store

#: Bounds of the model: dictionary rows and calibration rows per class, and sizes of what is kept.
DICTIONARY_ROWS = 200
PIECE_CHARS = 300
DICTIONARY_BYTES = 32_000
CALIBRATION_ROWS = 4_000

#: Bytes by kind: lower-case or other letters, capitals, digits; all else stays.
KINDS = bytes(
    97 if 97 <= b < 123 or b >= 128 else 65 if 65 <= b < 91 else 48 if 48 <= b < 58 else b for b in range(256)
)


def shape(data: bytes) -> bytes:
    """The text with each run of letters, capitals or digits as one sign."""
    signs = np.frombuffer(data.translate(KINDS), np.uint8)
    if len(signs) < 2:
        return signs.tobytes()
    run = (signs[1:] == signs[:-1]) & ((signs[1:] == 97) | (signs[1:] == 65) | (signs[1:] == 48))
    return signs[np.concatenate(([True], ~run))].tobytes()


@dataclass(frozen=True)
class Model:
    """Dictionaries (good, bad; as they are, as shapes) and the logistic curve over the features."""

    dictionaries: tuple[bytes, bytes, bytes, bytes]
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]

    def features(self) -> Callable[[str], list[float]]:
        good, bad, good_shape, bad_shape = (Sizes(d) for d in self.dictionaries)
        alone = Sizes()

        def of(text: str) -> list[float]:
            data = text.encode("utf-8", "surrogatepass")
            a, b = good(data), bad(data)
            form = shape(data)
            c, d = good_shape(form), bad_shape(form)
            plain = alone(data) / max(1, len(data))
            return [(b - a) / max(a, b), (d - c) / max(c, d), plain, plain * plain, 1 / np.log2(len(data) + 2)]

        return of

    def scores(self, rows: list[list[float]]) -> np.ndarray:
        scaled = (np.array(rows) - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + scaled @ np.array(self.weights[1:]), -30, 30)))


def _logistic(features: np.ndarray, labels: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    x = np.c_[np.ones(len(features)), features]
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + ridge * np.eye(len(w)), x.T @ (p - labels) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, marks: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Fit on the texts whose id has a label of 0 or 1 in ``marks`` (one row per id).

    At most ``DICTIONARY_ROWS`` rows of each class give a piece to the dictionaries, and at most
    ``CALIBRATION_ROWS`` others of each class are compressed whole for the curve. They are drawn from
    ``marks`` by a hash, so their texts are met by a broadcast of that bounded list and none is
    shuffled. Null texts and other labels teach nothing; with one class missing every text
    scores the share of the other.
    """
    known = marks.where(F.col(id_col).isNotNull() & F.col(label).isin(0, 1)).select(
        F.col(id_col).alias("id"), F.col(label).cast("int").alias("label"), F.xxhash64(id_col).alias("order")
    )
    known = known.withColumn("for_words", (F.col("order") % 2) == 0)
    rank = F.row_number().over(Window.partitionBy("label", "for_words").orderBy("order", "id"))
    ranked = known.withColumn("rank", rank).where(F.col("rank") <= CALIBRATION_ROWS)
    drawn = F.broadcast(store(ranked.where(~F.col("for_words") | (F.col("rank") <= DICTIONARY_ROWS)).drop("rank")))
    rows = docs.where(F.col(text).isNotNull()).select(F.col(id_col).alias("id"), F.col(text).alias("text")).join(drawn, "id")
    at = F.pmod(F.hash("text"), F.greatest(F.lit(1), F.length("text") - PIECE_CHARS + 1)) + 1
    piece: Column = F.col("text").substr(at, F.lit(PIECE_CHARS))
    pieces = {0: [], 1: []}
    for row in sorted(rows.where("for_words").select("label", "order", piece.alias("piece")).collect()):
        pieces[row.label].append(row.piece.encode("utf-8", "surrogatepass"))
    words = {k: b"\n".join(v)[:DICTIONARY_BYTES] for k, v in pieces.items()}
    shapes = {k: b"\n".join(map(shape, v))[:DICTIONARY_BYTES] for k, v in pieces.items()}
    blank = Model((words[1], words[0], shapes[1], shapes[0]), (0.0,) * 5, (1.0,) * 5, (0.0,) * 6)

    def make() -> Callable[[list[str]], tuple]:
        of = blank.features()
        return lambda batch: ([of(t) for t in batch],)

    points = per_text(rows.where(~F.col("for_words")), ["label", "text"], make, "features array<double>").collect()
    labels = np.array([p.label for p in points], dtype=float)
    if not pieces[0] or not pieces[1] or labels.size == 0 or labels.min() == labels.max():
        seen = np.concatenate([labels, [float(k) for k, v in pieces.items() for _ in v]])
        share = (seen.sum() + 1) / (seen.size + 2)
        return Model(blank.dictionaries, blank.mean, blank.scale, (float(np.log(share / (1 - share))), *blank.weights[1:]))
    features = np.array([p.features for p in points])
    mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-9
    weights = _logistic((features - mean) / scale, labels)
    return Model(blank.dictionaries, tuple(map(float, mean)), tuple(map(float, scale)), tuple(map(float, weights)))


def score(docs: DataFrame, model: Model, columns: list[str], text: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1, higher: good likelier) from each whole text to the named columns.

    One row per input row; a null or empty text is scored as the empty text. Columns
    not named are not carried, so names of the input cannot clash with ``score``.
    """

    def make() -> Callable[[list[str]], tuple]:
        of = model.features()
        return lambda batch: (model.scores([of(t) for t in batch]),)

    return per_text(docs, [*columns, text], make, "score double")
