"""Corpus pipeline: documents in, packed training sequences out.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before it kept. Between
stages the table is written and read again, so a lost executor costs the work of one stage at most.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from courtside.llm import catalog, minhash, packing, quality, secrets, suffixes
from courtside.session import store, tune


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = catalog.quality_model(docs, tune(spark).read.parquet(f"{sf_dir}/labels.parquet"))
    names = [f"d{i}" for i in range(len(docs.columns))]
    held = docs.select(*[F.col(c).alias(n) for c, n in zip(docs.columns, names)])
    scored = quality.score(held, model, names, names[docs.columns.index("text")])
    good = scored.where(F.col("score") >= catalog.QUALITY_THRESHOLD)
    return good.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names)])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: five-word shingles, four fifths of them shared.

    A row is judged by its own text, also where rows share an id: those get a key of their own from what
    they hold, beyond all ids (which are expected below 2^62), and rows that are equal throughout are
    one. Rows without an id or without words stay.
    """
    tune(spark)
    once = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    again = store(once.where("rows > 1").select("doc_id", F.lit(True).alias("_again")))
    content = F.pmod(F.xxhash64(*docs.columns), F.lit(1 << 61)) + F.lit(1 << 62)
    keyed = docs.join(again, "doc_id", "left").withColumn("_key", F.when(F.col("_again"), content).otherwise(F.col("doc_id")))
    found = minhash.near_duplicates(keyed.select("_key", "text"), width=5, percent=80, id_col="_key")
    # What is dropped is the smaller list, and small enough to be sent to the texts instead of moving them.
    dropped = store(found.groupBy("_key").agg(F.bool_or("kept").alias("_any")).where("NOT _any").select("_key"))
    kept = keyed.where("_key IS NOT NULL").join(dropped, "_key", "left_anti")
    versions = kept.where("_again").select(*docs.columns).dropDuplicates()
    return kept.where("_again IS NULL").select(*docs.columns).unionByName(versions).unionByName(docs.where("doc_id IS NULL"))


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that occur in more than one place; ``n_chars`` follows."""
    tune(spark)
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    cut = suffixes.remove_repeats(docs, others, characters=True)
    text = F.col("kept").cast("string")
    return cut.withColumns({"text": text, "n_chars": F.length(text).cast("bigint")}).select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every secret that the scan reports masked; ``n_chars`` follows."""
    tune(spark)
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their place in a sequence of at most 4096 tokens."""
    tune(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", keep_good),
    ("minhash near-dedup", drop_near_copies),
    ("suffix-array dedup", drop_repeats),
    ("secret scans", mask_secrets),
    ("best-fit packing", pack_sequences),
]

#: The classifier, the signatures and the packing cannot be said in SQL; tests/llm checks each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents of a folder."""
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
