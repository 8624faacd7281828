"""Feeds, rescue, expectations, streams, sinks, answer keys."""

import json
import os

import pytest
from helpers import frame, rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.operators.expectations import expect_rows, expectation_metrics
from feedloom.schemas import conform, struct
from feedloom.sources import feeds, keys, sinks
from feedloom.sources.headers import feed_files, file_headers, header_drift
from feedloom.streaming.ingest import ingest_feed, ingest_feeds, ingested_counts, read_dropped, read_ingested

SCHEMA = struct("id bigint, month int, premium double, name string")
RULES = {
    "warn": {"valid_month": "month BETWEEN 1 AND 12"},
    "drop": {"has_premium": "premium IS NOT NULL AND premium >= 0"},
}


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as handle:
        handle.write(text)


HEAD = "id,month,premium,name\n"


def test_parse_sources():
    assert feeds.parse_sources(" ES, it,es ") == ["es", "it"]
    for wrong in ("", "es,,it", "e5"):
        with pytest.raises(ValueError):
            feeds.parse_sources(wrong)


def test_rescue_keeps_typed_values_and_raw_text(spark, tmp_path):
    put(tmp_path / "f", "a.csv", HEAD + "1,2,3.5,x\n2,two,n/a,y\n,,,\n4,5,6.0\n")
    found = feeds.read_feed(spark, str(tmp_path / "f"), SCHEMA)
    by_id = {r["id"]: r for r in found.collect()}
    assert by_id[1]["_rescued_data"] is None and by_id[1]["premium"] == 3.5
    assert by_id[1]["_source_file"].endswith("a.csv") and by_id[1]["_ingested_at"] is not None
    assert (by_id[2]["month"], by_id[2]["premium"], by_id[2]["name"]) == (None, None, "y")
    assert json.loads(by_id[2]["_rescued_data"]) == {"month": "two", "premium": "n/a"}
    assert by_id[None]["_rescued_data"] is None
    assert "4,5,6.0" in by_id[4]["_rescued_data"]
    assert feeds.business_columns(found).columns == SCHEMA.names


def test_fields_go_by_header_name(spark, tmp_path):
    put(tmp_path / "f", "a.csv", HEAD + "1,2,3.5,x\n")
    put(tmp_path / "f", "b.csv", "\ufeffname,id,premium,month\ny,2,4.5,3\nz,9,n/a,4\n")
    put(tmp_path / "f", "c.csv", "id,name,extra,,id\n3,w,new,blank,33\n")
    put(tmp_path / "f", "d [x].csv", '"premium","id"\n7.5,4\n')
    put(tmp_path / "f", "e.csv", "")
    put(tmp_path / "f", "g.csv", HEAD)
    found = feeds.read_feed(spark, str(tmp_path / "f"), SCHEMA)
    assert found.columns == [*SCHEMA.names, "_source_file", "_ingested_at", "_rescued_data"]
    assert rows(found, *SCHEMA.names) == [(1, 2, 3.5, "x"), (2, 3, 4.5, "y"), (3, None, None, "w"), (4, None, 7.5, None), (9, 4, None, "z")]
    rescued = {r["id"]: json.loads(r["_rescued_data"] or "null") for r in found.collect()}
    assert rescued == {1: None, 2: None, 3: {"extra": "new", "_c_3": "blank", "id_4": "33"}, 4: None, 9: {"premium": "n/a"}}


def test_strict_header_stops_on_other_headers(spark, tmp_path):
    put(tmp_path / "f", "a.csv", "id,month,premium,name,extra\n1,2,3.5,x,new\n")
    with pytest.raises(ValueError, match="CSV header"):
        feeds.read_feed(spark, str(tmp_path / "f"), SCHEMA, strict_header=True)
    row = feeds.read_feed(spark, str(tmp_path / "f"), SCHEMA).first()
    assert row["id"] == 1 and json.loads(row["_rescued_data"]) == {"extra": "new"}


def test_folder_without_rows_keeps_the_schema(spark, tmp_path):
    put(tmp_path / "f", "a.csv", "")
    found = feeds.read_feed(spark, str(tmp_path / "f"), SCHEMA)
    assert found.count() == 0 and found.columns[:4] == SCHEMA.names


def test_header_drift_and_compressed_files(spark, tmp_path):
    import gzip

    put(tmp_path / "f", "a.csv", HEAD + "1,2,3.5,x\n")
    with gzip.open(tmp_path / "f" / "b.csv.gz", "wt") as out:
        out.write("name,id,extra\nq,5,e\n")
    drift = {r["file"].rsplit("/")[-1]: r for r in header_drift(spark, str(tmp_path / "f"), SCHEMA).collect()}
    assert not drift["a.csv"]["drifted"]
    b = drift["b.csv.gz"]
    assert (b["missing_columns"], b["new_columns"], b["reordered"]) == (["month", "premium"], ["extra"], True)
    assert rows(feeds.read_feed(spark, str(tmp_path / "f"), SCHEMA), "id", "name") == [(1, "x"), (5, "q")]


def test_stream_takes_new_headers_and_a_batch_again_leaves_no_row_twice(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    put(source, "a.csv", HEAD + "1,2,3.5,x\n")
    ingest_feed(spark, source, SCHEMA, target, checkpoint, **RULES).awaitTermination()
    put(source, "b.csv", "extra,premium,id\nq,1.5,2\n")
    ingest_feed(spark, source, SCHEMA, target, checkpoint, **RULES).awaitTermination()
    assert rows(read_ingested(spark, target), "id", "premium") == [(1, 3.5), (2, 1.5)]
    # As if the last batch had not been recorded as done.
    newest = max((tmp_path / "check" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    newest.unlink()
    (newest.parent / f".{newest.name}.crc").unlink(missing_ok=True)
    ingest_feed(spark, source, SCHEMA, target, checkpoint, **RULES).awaitTermination()
    assert rows(read_ingested(spark, target), "id", "premium") == [(1, 3.5), (2, 1.5)]


def test_inferred_schema(spark, tmp_path):
    put(tmp_path / "f", "a.csv", HEAD + "1,2,3.5,x\n")
    inferred = feeds.infer_feed_schema(spark, str(tmp_path / "f"))
    assert [f.dataType for f in inferred] == [T.IntegerType(), T.IntegerType(), T.DoubleType(), T.StringType()]


def test_read_feeds_and_union(spark, tmp_path):
    put(tmp_path / "es", "a.csv", HEAD + "1,2,3.5,x\n")
    put(tmp_path / "it", "a.csv", "id,premium\n7,1.0\n")
    both = feeds.read_feeds(spark, str(tmp_path), "es,it", {"es": SCHEMA, "it": struct("id bigint, premium double")})
    assert rows(feeds.union_feeds(both), "feed", "id", "name") == [("es", 1, "x"), ("it", 7, None)]
    with pytest.raises(ValueError, match="no schema"):
        feeds.read_feeds(spark, str(tmp_path), "xx", {})


def test_expectations_treat_null_as_failed(spark):
    df = frame(spark, "id bigint, month int, premium double", (1, 1, 1.0), (2, None, 1.0), (3, 13, None), (4, 5, -1.0))
    assert rows(expect_rows(df, **RULES), "id") == [(1,), (2,)]
    counts = rows(expectation_metrics(df, **RULES), "expectation", "kind", "passed_records", "failed_records", "output_rows")
    assert counts == [("has_premium", "drop", 2, 2, 2), ("valid_month", "warn", 2, 2, 2)]
    with pytest.raises(ValueError, match="unique"):
        expect_rows(df, {"a": "true"}, {"a": "true"})


def test_stream_equals_batch_and_second_run_adds_nothing(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    put(source, "a.csv", HEAD + "1,2,3.5,x\n2,13,1.0,y\n3,1,,z\n")

    def run():
        query = ingest_feed(spark, source, SCHEMA, target, checkpoint, **RULES)
        query.awaitTermination()
        return query

    def counts():
        found = ingested_counts(spark, target, **RULES)
        return rows(found, "expectation", "kind", "passed_records", "failed_records", "output_rows")

    run()
    assert counts() == [("has_premium", "drop", 2, 1, 2), ("valid_month", "warn", 2, 1, 2)]
    assert rows(read_dropped(spark, target), "id", "_failed_expectations") == [(3, ["has_premium"])]
    batch = expect_rows(feeds.read_feed(spark, source, SCHEMA), **RULES)
    assert rows(read_ingested(spark, target), *SCHEMA.names) == rows(batch, *SCHEMA.names)
    run()
    assert read_ingested(spark, target).count() == 2
    put(source, "b.csv", HEAD + "9,9,9.0,late\n")
    run()
    assert rows(read_ingested(spark, target), "id") == [(1,), (2,), (9,)]
    assert counts() == [("has_premium", "drop", 3, 1, 3), ("valid_month", "warn", 3, 1, 3)]


def test_ingest_feeds_starts_one_query_per_source(spark, tmp_path):
    put(tmp_path / "in" / "es", "a.csv", HEAD + "1,2,3.5,x\n")
    put(tmp_path / "in" / "it", "a.csv", HEAD + "5,2,-3.5,x\n")
    started = ingest_feeds(
        spark, str(tmp_path / "in"), {"es": SCHEMA, "it": SCHEMA}, str(tmp_path / "out"), str(tmp_path / "check"),
        {"it": RULES},
    )
    for query in started.values():
        query.awaitTermination()
    assert read_ingested(spark, str(tmp_path / "out" / "es")).count() == 1
    assert read_ingested(spark, str(tmp_path / "out" / "it")).count() == 0


TABLE = "source_country string, v int"


def test_overwrite_slice_keeps_other_slices(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.overwrite_slices(frame(spark, TABLE, ("ES", 1), ("IT", 2)), path, ["source_country"])
    sinks.overwrite_slice(frame(spark, TABLE, ("ES", 7), ("ES", 8)), path, "source_country", "ES")
    assert rows(spark.read.parquet(path), "source_country", "v") == [("ES", 7), ("ES", 8), ("IT", 2)]
    sinks.overwrite_slice(frame(spark, TABLE), path, "source_country", "ES")
    assert rows(spark.read.parquet(path), "source_country", "v") == [("IT", 2)]
    with pytest.raises(PySparkException):
        sinks.overwrite_slice(frame(spark, TABLE, ("ES", 1)), path, "source_country", "IT")
    assert rows(spark.read.parquet(path), "source_country", "v") == [("IT", 2)]
    with pytest.raises(ValueError):
        sinks.overwrite_slice(frame(spark, TABLE), path, "source_country", "a/b")


def test_overwrite_slice_may_read_its_own_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.overwrite_slices(frame(spark, TABLE, ("ES", 1), ("IT", 2)), path, ["source_country"])
    own = spark.read.parquet(path).filter("source_country = 'ES'").withColumn("v", F.col("v") + 10)
    sinks.overwrite_slice(own, path, "source_country", "ES")
    assert rows(spark.read.parquet(path), "source_country", "v") == [("ES", 11), ("IT", 2)]


def test_write_monthly_skips_present_months(spark, tmp_path):
    path = str(tmp_path / "m")
    schema = "y int, m int, v string"
    sinks.write_monthly(frame(spark, schema, (2025, 1, "a")), path, "y", "m")
    sinks.write_monthly(frame(spark, schema, (2025, 1, "changed"), (2025, 12, "b")), path, "y", "m")
    assert sinks.written_months(spark, path) == ["202501", "202512"]
    assert rows(spark.read.option("header", True).csv(path), "v") == [("a",), ("b",)]
    assert sinks.written_months(spark, str(tmp_path / "absent")) == []


def test_append_rows_holds_the_schema(spark, tmp_path):
    schema = struct("a string, n bigint")
    sinks.append_rows(frame(spark, "a string", ("x",)), str(tmp_path / "t"), schema)
    sinks.append_rows(frame(spark, "n int, a string", (1, "y")), str(tmp_path / "t"), schema)
    found = spark.read.parquet(str(tmp_path / "t"))
    assert rows(found, "a", "n") == [("x", None), ("y", 1)]
    with pytest.raises(ValueError, match="outside the schema"):
        conform(frame(spark, "b string", ("x",)), schema)


def test_replace_by_key(spark):
    old = frame(spark, TABLE, ("ES", 1), (None, 2))
    assert rows(sinks.replace_by_key(old, frame(spark, TABLE, ("ES", 3)), "source_country", "ES")) == [("ES", 3), (None, 2)]


def test_read_answer_key(spark, tmp_path):
    put(tmp_path, "k.json", json.dumps({"source_system": "S", "mappings": {"a": "x", "b": None}}, indent=2))
    assert rows(keys.read_answer_key(spark, str(tmp_path / "k.json"))) == [("S", "a", "x"), ("S", "b", None)]


def test_compressed_months_read_back_by_their_headers(spark, tmp_path):
    schema = "y int, m int, v string"
    path = str(tmp_path / "landing")
    sinks.write_monthly(frame(spark, schema, (2025, 1, "a"), (2025, 2, None)), path, "y", "m", compression="gzip")
    files = feed_files(spark, path)
    assert len(files) == 2 and all(f.endswith(".csv.gz") for f in files)
    assert set(map(tuple, file_headers(spark, files).values())) == {("y", "m", "v")}
    assert rows(feeds.read_feed(spark, path, struct(schema)), "y", "m", "v") == [(2025, 1, "a"), (2025, 2, None)]
