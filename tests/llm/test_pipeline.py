"""The pipeline's stages against brute force on their own input, and the catalog's queries against SQL."""

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from courtside.llm import catalog
from courtside.session import store

from .test_dedup import cut_by_force, reachable, shingles
from .test_search import linked
from .test_tokens import check_packing, words  # noqa: F401


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Input of each stage, and the output of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(store(stage(spark, tables[-1], sf_dir)))
    return tables


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_all_but_the_last_stage_return_documents(stages):
    for table in stages[1:-1]:
        assert table.columns == stages[0].columns
        assert table.schema.simpleString() == stages[0].schema.simpleString()


def test_quality_stage_keeps_good_documents_as_they_are(spark, sf_dir, stages):
    before, after = by_id(stages[0]), by_id(stages[1])
    assert all(after[i] == before[i] for i in after)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in after for i in good) >= 0.95 * len(good)
    assert len(after) < len(before)


def test_near_copy_stage_keeps_one_of_each_group(stages):
    before, after = by_id(stages[1]), by_id(stages[2])
    sets = {i: shingles(r.text, 5) for i, r in before.items()}
    ids = [i for i, s in sets.items() if s]
    links = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    group = reachable(before, links)
    assert set(after) == set(group.values())
    assert all(after[i] == before[i] for i in after)


def test_repeat_stage_cuts_what_occurs_again(stages):
    before, after = by_id(stages[2]), by_id(stages[3])
    ids = sorted(before)
    spans = cut_by_force([before[i].text.encode() for i in ids], 200)
    assert set(after) == set(before)
    for i, edges in zip(ids, spans):
        data = before[i].text.encode()
        kept = b"".join(data[a:b] for a, b in zip([0, *edges[1::2]], [*edges[::2], len(data)]))
        assert after[i].n_chars == len(after[i].text)
        if after[i].text.encode() != kept:
            # A cut inside a character leaves all of it.
            assert 0 < len(after[i].text.encode()) - len(kept) <= 3 * len(edges)


def test_secret_stage_masks_what_the_scan_reports(stages):
    before, after = by_id(stages[3]), by_id(stages[4])
    assert set(after) == set(before)
    for i, r in before.items():
        if linked(r.text):
            assert not linked(after[i].text) and after[i].n_chars == len(after[i].text)
        else:
            assert after[i] == r


def test_packing_stage(stages, words):  # noqa: F811
    check_packing([(r.doc_id, r.text) for r in stages[4].collect()], stages[5].collect(), words, 4096)


def test_run_is_all_stages(spark, sf_dir, stages):
    columns = ["doc_id", "piece", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, sf_dir).select(*columns).collect()
    assert sorted(got) == sorted(stages[-1].select(*columns).collect())


def test_stages_take_awkward_rows(spark, sf_dir, odd_rows):
    rows = [(i, t, "en", None, None if t is None else len(t)) for i, t in odd_rows] + [(2, "other text", None, "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    near = store(corpus_pipeline.drop_near_copies(spark, docs, sf_dir))
    kept = near.where("doc_id IS NOT NULL").select("doc_id", "text").collect()
    ids = [r.doc_id for r in kept]
    # Both texts of one id stay, as neither is a near copy of the other.
    assert len(kept) == len(set(kept)) and {7, 8}.isdisjoint(ids) and {1, 6, 9} <= set(ids)
    assert sorted(r.text for r in kept if r.doc_id == 2) == ["", "other text"]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() > 0
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
    cut = corpus_pipeline.drop_repeats(spark, docs, sf_dir)
    assert cut.count() == len(rows) and cut.where("n_chars <> length(text)").isEmpty()


def test_rows_that_share_an_id_are_judged_by_their_texts(spark, sf_dir):
    one, other = " ".join(f"word{i}" for i in range(60)), " ".join(f"term{i}" for i in range(60))
    rows = [(7, one), (7, None), (8, other), (9, other + " more"), (9, one), (9, one), (5, None), (5, None), (None, one)]
    docs = spark.createDataFrame([(i, t, None, None, 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, docs, sf_dir).collect()]
    texts = [t for i, t in kept if i is not None]
    assert (7, None) in kept and texts.count(one) == 1 and (8, other) in kept and (9, other + " more") not in kept
    assert kept.count((5, None)) == 1 and (None, one) in kept and len(kept) == 5


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    db = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    df = catalog.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    want = db.execute(catalog.ORACLE[name])
    heads = [d[0] for d in want.description]
    assert sorted(heads) == columns
    order = lambda row: [(v is None, 0 if v is None else v) for v in row]
    expected = [tuple(r[heads.index(c)] for c in columns) for r in want.fetchall()]
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=order) == sorted(expected, key=order)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE)))
def test_query_returns_every_row(spark, sf_dir, name):
    table = "embeddings" if name.startswith("op7") else "documents"
    key = "vec_id" if name.startswith("op7") else "doc_id"
    ids = spark.read.parquet(f"{sf_dir}/{table}.parquet").select(key)
    got = catalog.QUERIES[name](spark, sf_dir)
    assert got.select(key).distinct().count() == ids.count()
    assert got.where(F.col(key).isNull()).isEmpty()
