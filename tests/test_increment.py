import pytest
from conftest import SF_DIR, plan, rows

from flowlantern.operators import flows
from flowlantern.plans import increment, queries
from flowlantern.sources import writers
from flowlantern.streaming import jobs


@pytest.fixture(scope="module")
def bronze(spark):
    return queries._bronze(spark, SF_DIR).where("time_received % 5 = 0").cache()


def add(table, path):
    writers.write_table(table, path, ["vlan"], mode="append", rebalance=True)


def test_runs_equal_a_rebuild_and_read_only_new_files(spark, bronze, tmp_path):
    source, root = f"{tmp_path}/bronze", f"{tmp_path}/refined"
    wanted = rows(flows.gold_features(flows.clean_flows(bronze)))
    delivered = [bronze.where(f"src_port % 3 = {part}") for part in (0, 1, 2)] + [bronze.where("src_port % 3 = 0")]
    for n, part in enumerate(delivered):
        add(part, source)
        run = jobs.finish(increment.run_refine(spark, source, root, fold=2, unit="year"))
        assert [p["numInputRows"] for p in run.recentProgress if p["numInputRows"]] == [part.count()]
        if n == 0:
            assert rows(increment.gold_table(spark, root, fold=2)) == rows(flows.gold_features(flows.clean_flows(part)))
        if n >= 2:  # the fourth only repeats the first
            assert rows(increment.gold_table(spark, root, fold=2)) == wanted
    silver = increment.silver_table(spark, root, bronze.schema).select(bronze.columns)
    assert rows(silver) == rows(flows.clean_flows(bronze))
    assert silver.where("vlan is null").count() > 0
    again = jobs.finish(increment.run_refine(spark, source, root, fold=2, unit="year"))
    assert not any(p["numInputRows"] for p in again.recentProgress)
    # A fold holds all before it, so older folders are not read.
    files = increment._state(spark, root, "sums", increment.SUMS, 3, 2)
    assert "batch_id" in plan(files) and rows(files, "src_ip", "vlan", "packets") == rows(
        flows.gold_features(flows.clean_flows(bronze)), "src_ip", "vlan", "total_packets"
    )


@pytest.mark.parametrize("fold", [1, 3])
def test_a_repeated_batch_adds_nothing(spark, bronze, tmp_path, fold):
    root = str(tmp_path)
    parts = [bronze.where(f"src_port % 4 = {part}") for part in range(4)]
    for n, part in enumerate(parts):
        for _ in range(2 if n in (1, 2) else 1):
            increment.take_batch(part, n, root, fold, "year")
    assert rows(increment.gold_table(spark, root, fold)) == rows(flows.gold_features(flows.clean_flows(bronze)))


def test_batches_without_rows(spark, bronze, tmp_path):
    root = str(tmp_path)
    increment.take_batch(bronze.limit(0), 0, root, 2, "year")
    assert increment.gold_table(spark, root, 2).count() == 0
    increment.take_batch(bronze, 1, root, 2, "year")
    increment.take_batch(bronze.limit(0), 2, root, 2, "year")
    assert rows(increment.gold_table(spark, root, 2)) == rows(flows.gold_features(flows.clean_flows(bronze)))


def test_rows_that_differ_in_one_column_stay_apart(spark, bronze, tmp_path):
    one = bronze.where("dst_ip like '172%' and packets > 0 and bytes > 0 and vlan is not null").limit(1)
    two = one.selectExpr(*[f"CAST(NULL AS {kind}) AS vlan" if name == "vlan" else name for name, kind in one.dtypes])
    late = one.selectExpr(
        *["ingestion_time + INTERVAL '0.000001' SECOND AS ingestion_time" if n == "ingestion_time" else n for n in one.columns]
    )
    for n, part in enumerate((one, two, late, one)):
        increment.take_batch(part, n, str(tmp_path), 16, "year")
    assert increment.silver_table(spark, str(tmp_path), one.schema).count() == 3


def test_known_rows_share_one_shuffle_with_new_ones(spark, bronze, tmp_path):
    increment.take_batch(bronze.where("src_port % 2 = 0"), 0, str(tmp_path), 16, "year")
    fresh = increment._new_silver(bronze, str(tmp_path), 1, "year")
    assert rows(fresh, *bronze.columns) == rows(flows.clean_flows(bronze).where("src_port % 2 = 1"))
    assert plan(fresh).count("Exchange hashpartitioning(flow_type") == 1 and "sha2" not in plan(fresh)
    assert "row_id" not in spark.read.parquet(f"{tmp_path}/silver").columns
    with pytest.raises(ValueError):
        flows.clean_flows(bronze, "key", known=bronze)


def test_sketches_merge_over_days(spark):
    table = "time_received bigint, src_ip string, vlan int, dst_ip string, dst_port int, packets bigint, bytes bigint"
    made = [(day * 86400 + i, "a", None, f"t{i % 90}", (day * 60 + i) % 150, 1, 10) for day in range(3) for i in range(100)]
    made += [(5, "b", 7, None, None, 2, 3)]
    found = flows.merged_sketches(flows.daily_sketches(spark.createDataFrame(made, table)))
    assert rows(found) == [("a", None, 300, 3000, 90, 150, 10.0), ("b", 7, 2, 3, 0, 0, 1.5)]


def test_history_outlives_a_stream(spark, tmp_path):
    for part in range(3):
        spark.range(10 * part, 10 * part + 10 + part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    history = jobs.StreamHistory(spark, f"{tmp_path}/history", every=2)
    spark.streams.addListener(history)
    try:
        stream = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        run = jobs.finish(jobs.write_stream(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint"))
        assert history.wait(run)
    finally:
        spark.streams.removeListener(history)
    table = jobs.read_history(spark, f"{tmp_path}/history")
    assert rows(table.where("input_rows > 0"), "id", "batch_id", "input_rows") == [(run.id, n, 10 + n) for n in range(3)]
    stored = spark.read.parquet(f"{tmp_path}/history")
    stored.write.mode("append").parquet(f"{tmp_path}/twice")
    stored.write.mode("append").parquet(f"{tmp_path}/twice")
    [health] = jobs.stream_health(jobs.read_history(spark, f"{tmp_path}/twice")).collect()
    assert (health["id"], health["runs"], health["last_batch"], health["input_rows"]) == (run.id, 1, 2, 33)
