"""What the plans look like where it matters at scale."""

from helpers import frame
from pyspark.sql import functions as F

from feedloom.operators import match, metrics, profile, quality, review, security, values
from feedloom.plans import flows, queries
from feedloom.plans import property_model as M
from feedloom.plans.fixtures import frame as derived
from feedloom.plans.queries import shared
from feedloom.schemas import empty_table
from feedloom.sources import sinks


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_feed_to_shared_row_needs_no_shuffle_and_no_lookup_join(spark, tmp_path):
    feed = derived(spark, "/root/testdata/sf0.001", "feed_es")
    feed.write.parquet(str(tmp_path / "es"))
    from feedloom.operators.harmonize import harmonize

    rows = harmonize(
        spark.read.parquet(str(tmp_path / "es")), M.dictionary(spark), M.MODEL, source_country="ES",
        source_system=M.SYSTEMS["ES"], mapping_version="v1",
    )
    text = plan(rows)
    assert "Exchange" not in text and "Join" not in text
    text = plan(values.translate_values(rows, M.value_dictionary(spark), M.CATEGORICAL))
    assert "SortMergeJoin" not in text


def test_kpi_scan_reads_only_its_columns(spark, sf):
    text = plan(metrics.PROPERTY_KPIS.query(shared(spark, sf), ["country"], ["gross_written_premium"]))
    read = [line for line in text.splitlines() if "lineitem" in line]
    assert read and all("l_discount" not in line and "l_returnflag" not in line for line in read)


def test_country_filter_drops_the_other_feed(spark, sf):
    text = plan(metrics.PROPERTY_KPIS.query(shared(spark, sf), ["country"], ["claims_paid"], where="country = 'ES'"))
    assert text.count("lineitem") == 1


def test_pending_columns_is_an_anti_join(spark, sf):
    assert "LeftAnti" in plan(match.pending_columns(derived(spark, sf, "inventory_keys"), derived(spark, sf, "mapping_dictionary")))


def test_slice_filter_reaches_the_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.overwrite_slices(frame(spark, "source_country string, v int", ("ES", 1), ("IT", 2)), path, ["source_country"])
    members = frame(spark, "user string, scope string", ("u", "es"))
    found = security.row_filter(spark.read.parquet(path), members, "u")
    assert found.count() == 1
    filters = plan(found).split("PartitionFilters: [")[1]
    assert filters.startswith("(array_contains(Subquery")


def test_review_queue_filters(spark, sf):
    queue = derived(spark, sf, "queue")
    both = review.review_queue(queue, "SYS_1", "PENDING")
    assert both.filter((F.col("source_system") != "SYS_1") | (F.col("review_status") != "PENDING")).count() == 0
    assert review.preview(queue).count() == 5


def test_samples_read_once_and_move_k_values_per_task(spark, sf, monkeypatch):
    seen = []
    within = profile._task_samples
    monkeypatch.setattr(profile, "_task_samples", lambda df, k: seen.append(within(df, k)) or seen[-1])
    feed = derived(spark, sf, "lineitem")
    profile.sample_values(feed, 5)
    assert len(seen) == 1 and plan(seen[0]).count("FileScan") == 1
    kept = seen[0].collect()
    assert len(kept) <= feed.rdd.getNumPartitions() and all(len(values) <= 5 for row in kept for values in row)
    many = within(spark.range(0, 100_000, 1, 64).select("id"), 5).collect()
    assert len(many) == 64 and all(len(row[0]) == 5 for row in many)


def test_checks_read_each_feed_once(spark, sf):
    rows = shared(spark, sf)
    checks = quality.quality_checks(rows, required=M.REQUIRED, allowed=M.ALLOWED, rules=M.RULES, by=["source_system"])
    assert plan(checks).count("lineitem") == 2


def test_published_rows_are_not_moved_by_their_category_values(spark):
    feed = spark.range(200000).select(F.col("id").cast("string").alias("nr"), F.concat(F.lit("Zona "), F.col("id") % 3).alias("zona"))
    known = frame(spark, "source_system string, local_column_name string, global_column_name string, active_flag boolean",
                  ("S", "nr", "id", True), ("S", "zona", "risk_zone", True))
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "256k")
    try:
        found = flows.publish(
            {"ES": feed}, {"ES": "S"}, model={"id": "STRING", "risk_zone": "STRING"}, dictionary=known,
            mandatory=frame(spark, "source_system string, local_column_name string", ("S", "nr")),
            allowed=frame(spark, "source_field string, allowed_value string", ("risk_zone", "Zone 0")),
            allow_lists={"risk_zone": ["Zone 0"]},
            value_glossary=frame(spark, "source_field string, raw_value string, code string", ("risk_zone", "zona 0", "Zone 0")),
            value_dictionary=empty_table(spark, "value_mapping_dictionary"), required=["id"], rules=[],
            mapping_version="v1", run_id="r",
        ).rows
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        counts = {tuple(r) for r in found.groupBy("risk_zone").count().collect()}
        assert counts == {("Zone 0", 66667), ("Zona 1", 66667), ("Zona 2", 66666)}
    finally:
        spark.conf.set(limit, before)


def test_only_the_rows_of_the_source_are_merged(spark):
    table = frame(spark, "source_system string, n int", ("A", 1), ("B", 2), (None, 3))
    seen = []

    def merge(own):
        seen.append(sorted(tuple(r) for r in own.collect()))
        return own.withColumn("n", F.col("n") + 10)

    found = queries._with_slice(table, "A", merge, "slice")
    assert seen == [[("A", 1)]]
    assert sorted((tuple(r) for r in found.collect()), key=lambda r: r[1]) == [("B", 2), (None, 3), ("A", 11)]
