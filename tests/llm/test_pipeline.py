"""The pipeline's stages and the registered queries on the smallest tables."""

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from feedloom.llm import exact_dedup, mixing, near_dedup, queries, toxicity
from feedloom.llm.oracles import ORACLES


@pytest.fixture(scope="module")
def documents(spark, sf):
    return queries.table(spark, sf, "documents")


def test_stages_do_what_they_say(spark, sf, documents):
    kept = documents
    before = kept.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, sf)
        assert out.columns == documents.columns
        out = out.cache()
        assert out.exceptAll(kept).isEmpty()
        if name == "toxicity":
            model = toxicity.fit(kept, queries.table(spark, sf, "labels"))
            rejected = {r["doc_id"] for r in toxicity.toxicity(kept, model).filter("toxic").collect()}
            assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in kept.collect()} - rejected
        if name == "exact_dedup":
            assert out.count() == exact_dedup.exact_dedup(kept).filter("kept").count()
            assert out.select(exact_dedup.normalised(F.col("text"))).distinct().count() == out.count()
        if name == "near_dedup":
            assert out.count() == near_dedup.near_dedup(kept).filter("kept").count()
        kept = out
    assert 0 < kept.count() < before
    last = corpus_pipeline.STAGES[-1][1](spark, kept, sf)
    assert last.count() == kept.count() and last.filter("not round_trip").count() == 0


def test_pipeline_of_an_empty_table(spark, sf, documents):
    kept = documents.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, sf)
    assert kept.count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, sf, name):
    frame = queries.QUERIES[name](spark, sf)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    result = connection.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(frame.columns)
    assert sorted(map(repr, result.fetchall())) == sorted(repr(tuple(r)) for r in frame.select(names).collect())


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_every_query_returns_all_documents(spark, sf, documents, name):
    out = queries.QUERIES[name](spark, sf)
    if name == "op3_token_counts":
        assert out.agg(F.sum("n_docs")).first()[0] == documents.count()
    elif name == "op11_packing":
        assert out.select("doc_id").distinct().count() == documents.count()
    elif name == "op13_spelling":
        # One row per word; its counts are held against brute force elsewhere.
        assert out.count() == out.select("word").distinct().count() > 0
    else:
        assert out.count() == documents.count()


def test_near_dedup_stage_equals_brute_force_on_five_words(spark, sf):
    from test_llm_operators import SCHEMA, brute_components

    base = [f"t{k}" for k in range(112)]
    changed = [f"n{k}" if k in (20, 55, 90) else w for k, w in enumerate(base)]  # J4 = 97/121, J5 = 93/123
    rows = [(1, " ".join(base), "en", "s1", 0), (2, " ".join(changed), "en", "s1", 0)]
    rows += [(3, " ".join(base[:-1]), "en", "s1", 0), (4, "other words only", "en", "s1", 0), (None, " ".join(base), "en", "s1", 0)]
    out = corpus_pipeline.remove_near_copies(spark, spark.createDataFrame(rows, SCHEMA), sf)
    component = brute_components(rows, width=5)
    assert component != brute_components(rows)
    assert {r["doc_id"] for r in out.collect()} == {i for i, root in component.items() if i == root} | {None} == {1, 2, 4, None}


def test_mixing_stage_decides_per_leaf_for_null_and_repeated_ids(spark, sf):
    from test_llm_operators import SCHEMA

    leaves = [(lang, source) for lang in ("en", "de", None) for source in ("src0", "src1", "src2", None)]
    rows = [(i if i % 3 else None, "one two three four", lang, source, 18) for i in range(30) for lang, source in leaves]
    docs = spark.createDataFrame(rows, SCHEMA)
    plan = mixing.mix(docs, percent=corpus_pipeline.MIX_PERCENT, weights=queries.WEIGHTS, max_epochs=1).collect()
    key = ("doc_id", "lang", "source")
    taken = Counter(tuple(r[c] for c in key) for r in plan if r["copies"])
    ids = {c: {r["doc_id"] for r in plan if bool(r["copies"]) == c} for c in (True, False)}
    assert None in ids[True] & ids[False] and len(ids[True] & ids[False]) > 1
    assert Counter(tuple(r[c] for c in key) for r in corpus_pipeline.mix_sources(spark, docs, sf).collect()) == taken


def test_exact_dedup_stage_keeps_one_row_of_each_text(spark):
    from feedloom.llm import exact_dedup

    rows = [(1, "a  b", "x", "p"), (1, "a b", "y", "q"), (1, "a b", "y", "q"), (0, "c", "x", "p"), (None, "c", "x", "p"), (None, None, "n", "p"), (None, "", "n", "p"), (5, "a\tb", "x", "p"), (6, "d", "x", "p"), (6, "e", "x", "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __keep string, __digest string").repartition(3)
    out = exact_dedup.deduped(docs)
    assert out.columns == docs.columns
    kept = [(r[0], " ".join((r[1] or "").split())) for r in out.collect()]
    assert sorted(kept, key=repr) == sorted([(1, "a b"), (0, "c"), (None, ""), (6, "d"), (6, "e")], key=repr)
    assert exact_dedup.deduped(docs.limit(0)).count() == 0


def test_mixing_sql_counts_words_between_all_white_space():
    import duckdb

    from feedloom.llm.oracles import ORACLES

    con = duckdb.connect()
    con.execute("CREATE TABLE documents AS SELECT 1 AS doc_id, 'a' || chr(13) || 'b' || chr(11) || 'c' || chr(12) || 'd e' AS text, 'en' AS lang, 'src1' AS source")
    assert con.execute(f"SELECT tokens FROM ({ORACLES['op6_mixing']})").fetchall() == [(5,)]
