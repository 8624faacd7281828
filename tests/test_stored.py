"""Tables that are kept between runs: parts, buckets, sketches; ordered lists; case folding."""

import glob
import math
import os
import random
import sys
import unicodedata

import pytest
from helpers import frame, rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from feedloom.functions.conditions import DOTLESS_I, KEPT_I, folded
from feedloom.operators import listing, merge, sketches, values
from feedloom.operators.buckets import BucketedTable
from feedloom.operators.metrics import MetricView, total
from feedloom.operators.partials import PartialView, last_stored_periods, stored_count, stored_total


def measures(total_of, count_of):
    return {"money": total_of("m"), "n": count_of("n")}


VIEW = PartialView({"g": "g", "reporting_period": "p"}, ["m"], {"n": "c"}, measures, ["g", "reporting_period"])
DIRECT = MetricView({"g": "g", "reporting_period": "p"}, measures(total, lambda name: "sum(c)"))


def dated(spark, rows_):
    return frame(spark, "g string, d int, m double, c int", *rows_).select(
        "g", F.date_add(F.lit("2024-01-01").cast("date"), F.col("d")).alias("p"), "m", "c"
    )


def same(left, right):
    def plain(v):
        return "nan" if isinstance(v, float) and math.isnan(v) else v

    return [tuple(map(plain, r)) for r in left] == [tuple(map(plain, r)) for r in right]


def test_parts_add_up_to_the_totals_of_the_rows(spark, tmp_path):
    draw = random.Random(7)
    groups = {
        "plain": [draw.uniform(-1e6, 1e6) for _ in range(200)],
        "wide": [draw.choice([1e18, -1e18, 1e-6, 0.1]) for _ in range(200)],
        "nan": [1.0, float("nan"), 2.0],
        "infinite": [1.0, float("inf"), 2.0],
        "huge": [1e200, 1e200],
        "overflown": [2.0**99] * 200,
        "null": [None, None],
        "part null": [None, 2.5],
    }
    data = [(g, i % 5, v, None if i % 7 == 0 else i) for g, vs in groups.items() for i, v in enumerate(vs)]
    df = dated(spark, data)
    path = str(tmp_path / "parts")
    VIEW.refresh(df, path)
    parts = VIEW.read(spark, path, VIEW.parts(df).schema)
    for dims in (["g"], ["g", "reporting_period"], []):
        found = rows(VIEW.view().query(parts, dims, ["money", "n"]))
        wanted = rows(DIRECT.query(df, dims, ["money", "n"]))
        assert same(found, wanted), dims
    exact = {r["g"]: r["money"] for r in VIEW.view().query(parts, ["g"], ["money"]).collect()}
    assert exact["wide"] == pytest.approx(math.fsum(groups["wide"]), rel=1e-15)
    assert exact["null"] is None


def test_a_slice_is_replaced_and_the_others_stay(spark, tmp_path):
    path = str(tmp_path / "parts")
    VIEW.refresh(dated(spark, [("a", 0, 1.0, 1), ("a", 1, 2.0, 1), ("b", 0, 4.0, 1)]), path)
    kept = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/g=b/*/*.parquet")}
    VIEW.refresh(dated(spark, [("a", 1, 8.0, 1), ("a", 1, 16.0, 1)]), path)
    assert kept == {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/g=b/*/*.parquet")}
    parts = VIEW.read(spark, path)
    assert rows(VIEW.view().query(parts, ["g"], ["money", "n"])) == [("a", 25.0, 3), ("b", 4.0, 1)]
    assert rows(VIEW.view().query(last_stored_periods(parts, 1), [], ["n"])) == [(2,)]
    plan = parts.filter("g = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(g" in plan


SCHEMA = "source_system string, local_column_name string, review_status string, final_global_column_name string, " \
    "final_match_type string, reviewed_by string, reviewed_at string, review_comment string, " \
    "app_decision_source string, updated_at string"


def queue(spark, keys, status):
    return frame(spark, SCHEMA, *[(s, c, status, "t", "m", "r", "1", None, "a", "u") for s, c in keys])


def test_a_merge_reads_and_writes_only_the_buckets_of_its_source(spark, tmp_path):
    keys = [(f"S{i % 40}", f"c{i}") for i in range(400)] + [(None, "n"), ("S1", None)]
    old, new = queue(spark, keys, "PENDING"), queue(spark, [("S3", "c3"), ("S3", "c43"), ("S7", "gone")], "APPROVED")
    table = BucketedTable(str(tmp_path / "t"), old.schema, ["source_system"], 32)
    table.write(old)
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{table.path}/*/*.parquet")}
    hit = table.merge(new, merge.sync_decisions)
    assert 1 <= len(hit) <= 2
    after = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{table.path}/*/*.parquet")}
    changed = {f.split("_bucket=")[1].split("/")[0] for f in set(before.items()) ^ set(after.items()) for f in f[:1]}
    assert changed == {str(b) for b in hit}
    assert rows(table.read(spark)) == rows(merge.sync_decisions(old, new))
    plan = table.read(spark, hit)._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [" in plan.toString() and "_bucket" in plan.toString().split("PartitionFilters: [")[1][:40]
    assert table.merge(new.limit(0), merge.sync_decisions) == []


def test_keys_are_hashed_in_the_type_of_the_table(spark, tmp_path):
    old = frame(spark, "k bigint, v string", *[(i, "old") for i in range(50)])
    table = BucketedTable(str(tmp_path / "t"), old.schema, ["k"], 8)
    table.write(old)
    new = frame(spark, "k int, v string", (3, "new"), (60, "new"))
    rule = lambda t, s: merge.merge_rows(t, s, ["k"], [(None, merge.take("v"))])
    table.merge(new, rule)
    assert rows(table.read(spark)) == sorted([(i, "new" if i in (3, 60) else "old") for i in [*range(50), 60]], key=repr)


def test_a_row_that_leaves_its_bucket_fails_and_loses_nothing(spark, tmp_path):
    old = frame(spark, "k bigint, v string", *[(i, "old") for i in range(50)])
    table = BucketedTable(str(tmp_path / "t"), old.schema, ["k"], 8)
    table.write(old)
    moved = lambda t, s: t.withColumn("k", F.col("k") + 1)
    with pytest.raises(PySparkException, match="left its bucket"):
        table.merge(frame(spark, "k bigint, v string", (3, "new")), moved)
    assert rows(table.read(spark)) == rows(old)


def test_positions_of_an_ordered_listing(spark):
    draw = random.Random(3)
    data = [("hot" if i % 3 else draw.choice(["a", None]), f"n{draw.randrange(300):03}") for i in range(3000)]
    data += [("hot", "same")] * 1000 + [("a", None)]
    found = listing.ordered_listing(frame(spark, "g string, name string", *data).repartition(16), ["g"], "name")
    wanted = []
    for g in {g for g, _ in data}:
        names = sorted(n for h, n in data if h == g and n is not None)
        wanted += [(g, names.index(n) + 1, n, names.count(n)) for n in sorted(set(names))]
    assert rows(found, "g", "position", "name", "repeats") == sorted(wanted, key=repr)
    page = {r["g"]: r["names"] for r in listing.listed_slice(found, ["g"], "name", 5, 12).collect()}
    assert page == {g: sorted(n for h, n in data if h == g and n is not None)[4:12] for g in ("hot", "a", None)}
    assert listing.ordered_listing(frame(spark, "g string, name string"), ["g"], "name").count() == 0


def test_rows_are_numbered_in_their_order(spark):
    data = [(i * 7919 % 5000, "x" if i % 3 else None) for i in range(5000)]
    df = frame(spark, "k int, v string", *data).repartition(16)
    found = listing.numbered_rows(df, [F.desc("v"), F.asc("k")])
    wanted = sorted(data, key=lambda r: (r[1] is None, r[0]))
    assert [tuple(r) for r in found.orderBy("position").collect()] == [(*r, i) for i, r in enumerate(wanted, 1)]
    assert listing.numbered_rows(df.limit(0), [F.asc("k")]).count() == 0


def test_prompts_hold_each_value_once(spark):
    local = frame(spark, "source_field string, raw_value string", *[("f", f"v{i:03}") for i in range(25)], ("f", "v001"))
    allowed = frame(spark, "source_field string, allowed_value string", ("f", "x"))
    found = {r["part"]: r["prompt"] for r in values.value_prompts(local, allowed, 10).collect()}
    assert sorted(found) == [1, 2, 3]
    assert [p for p in range(1, 4) if "v001" in found[p]] == [1]
    assert "Local: v020, v021, v022, v023, v024." in found[3]


def test_sketches_of_slices_merge_within_their_bound(spark, tmp_path):
    df = spark.range(60000).select(
        (F.col("id") % 6).cast("string").alias("s"), F.col("id").alias("all"), (F.col("id") % 997).cast("smallint").alias("few"),
        (F.col("id") % 20011 / 4).alias("real"), F.lit(None).cast("string").alias("none"),
    )
    path, columns = str(tmp_path / "k"), ["all", "few", "real", "none"]
    sketches.refresh_sketches(df.withColumn("all", -F.col("all")), path, columns, ["s"])
    sketches.refresh_sketches(df, path, columns, ["s"])
    row = sketches.merged_counts(spark.read.parquet(path), columns).first()
    assert row["row_count"] == 60000 and row["distinct_none"] == 0
    for column, exact in (("all", 60000), ("few", 997), ("real", 20011)):
        assert abs(row[f"distinct_{column}"] - exact) <= exact * sketches.error_bound()


def test_sketches_take_hashes_of_texts_and_real_numbers(spark):
    df = spark.range(3000).select(
        F.lit("a").alias("s"), (F.col("id") % 700 / 8).alias("real"), (F.col("id") % 5).cast("string").alias("text"),
        F.when(F.col("id") % 2 == 0, F.lit("")).alias("blank"), F.when(F.col("id") % 3 == 0, F.lit(0.0)).otherwise(F.lit(-0.0)).alias("zero"),
        F.lit(float("nan")).alias("nan"), F.create_map(F.lit("k"), F.col("id") % 3).alias("map"), F.lit(None).cast("date").alias("none"),
    )
    columns = ["real", "text", "blank", "zero", "nan", "map", "none"]
    found = sketches.column_sketches(df, columns, ["s"])
    row = sketches.merged_counts(found, columns).first()
    assert abs(row["distinct_real"] - 700) <= 700 * sketches.error_bound()
    # Both zeros are one value, as in exact counts, and an empty text is one.
    assert [row[f"distinct_{c}"] for c in columns[1:]] == [5, 1, 1, 1, 3, 0]
    # The hashes are worked out before the aggregate, and no real number is written as text.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64(real" in plan and "cast(real" not in plan


def test_folding_equals_full_case_folding_of_all_characters(spark):
    # Letters that have got another case after the tables of this Python, and the stand-in of the dotless i.
    newer = {"ƛ", "ɤ", DOTLESS_I, KEPT_I}
    known = [
        c for c in map(chr, range(1, sys.maxunicode + 1))
        if unicodedata.category(c) not in ("Cn", "Cs") and c not in newer
    ]
    texts = frame(spark, "c string, f string", *[(c, c.casefold()) for c in known])
    assert texts.filter(folded("c") != folded("f")).count() == 0
    # Nothing else falls together: as many classes as the full folding has.
    assert texts.select(folded("c")).distinct().count() == len({c.casefold() for c in known})
    pair = frame(spark, "a string, b string", ("Straße", "STRASSE"), ("kısa", "kisa"), ("İx", "i̇X"), ("é", "e"))
    assert [r[0] for r in pair.select(folded("a") == folded("b")).collect()] == [True, False, True, False]
