"""Cases of this round: registered queries outside a local session, ranges of many borders, dumps dealt over tasks."""

import datetime

import pytest

from exposura import catalog, session


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """The tables the keyed queries read, of invented rows."""
    folder, day = tmp_path_factory.mktemp("small"), datetime.datetime(2024, 1, 2)
    tables = {
        "documents": ("doc_id long, text string, source string", [
            (k, f"write to a{k}@example.com or\n+1 555 010 99{k}0\n# note\n\nlast ünd {k}", "web") for k in range(8)]),
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_mktsegment string", [(k, f"Name {k}", k % 3, "SHOPS") for k in range(7)]),
        "orders": ("o_orderkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string", [
            (k, "F", 1.5 * k, day, ("5-LOW", "4-NOT SPECIFIED", "1-URGENT")[k % 3]) for k in range(6)]),
        "events": ("event_id long, ts timestamp, user_id long, event_type string, value double, props string", [
            (k, day, k % 2, ("error", "view")[k % 2], 1.0, f'{{"k": {k}}}') for k in range(6)]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


KEYED = [
    "norm_email",
    "norm_phone",
    "normalize_identity",
    "read_encoded_lines",
    "read_text_lines",
    "remap_columns",
    "stream_normalize_dict",
    "stream_normalize_identity",
    "stream_normalize_transaction",
]


@pytest.mark.parametrize("name", KEYED)
def test_keyed_queries_run_on_a_cluster(spark, small, name, monkeypatch, tmp_path):
    run = catalog.queries()[name]
    local = run(spark, small)
    expected, columns = sorted(map(repr, local.collect())), local.columns
    monkeypatch.setattr(session, "_one_process", lambda spark: False)
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path))
    assert sorted(map(repr, run(spark, small).collect())) == expected != []
    with pytest.raises(RuntimeError, match="pepper"):
        session.pepper(spark)
    spark.conf.set("spark.exposura.pepper", "another")
    try:
        got = run(spark, small)
        assert (sorted(map(repr, got.collect())) == expected) is not any("hash" in c for c in columns)
    finally:
        spark.conf.unset("spark.exposura.pepper")
def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_borders_are_sorted_once_for_the_plan(spark):
    from pyspark.sql import functions as F

    from exposura.operators import windows

    at = datetime.datetime(2024, 1, 2)
    rows = [(k % 3 or None, at + datetime.timedelta(microseconds=701 * (k % 101)) if k % 5 else None, k) for k in range(600)]
    df = spark.createDataFrame(rows, "k int, ts timestamp, id int")
    borders = windows.range_borders(df, ["k", "ts", "id"], 200)
    placed = df.withColumn("r", windows.range_number(df, ["k", "ts", "id"], borders))
    assert len(borders) > 100 and "sort" not in optimized(placed) and "from_json" not in optimized(placed)
    got = [r["r"] for r in placed.orderBy("k", "ts", "id").collect()]
    assert got == sorted(got) and len(set(got)) > 50
    numbered = windows.block_numbers(df, "k", ["ts", "id"], F.col("id") % 4 == 0)
    seen, want = {}, {}
    for k, ts, i in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or at, r[2])):
        want[i] = seen[k] = seen.get(k, 0) + (i % 4 == 0)
    assert {r["id"]: r["block_id"] for r in numbered.collect()} == want


def test_records_over_splits_start_no_job_before_they_are_read(spark, tmp_path):
    import json

    from pyspark.sql import types as T

    from exposura.sources import readers

    rows = [{"id": k, "name": f'n{k}}},{{"[' * (k % 7), "more": [{"x": "}"}] * (k % 3)} for k in range(400)]
    (tmp_path / "a.json").write_text(",\n".join(["[" + json.dumps(rows[0]), *map(json.dumps, rows[1:])]) + "]")
    (tmp_path / "b.json").write_text(json.dumps(rows[:50]))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    context = spark.sparkContext
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    context.setJobGroup("reads nothing", "")
    try:
        found = readers.read_json_array(spark, str(tmp_path), schema)
        begun = list(context.statusTracker().getJobIdsForGroup("reads nothing"))
        got = sorted((r["id"], r["name"]) for r in found.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        context.setLocalProperty("spark.jobGroup.id", None)
    assert not begun and got == sorted((r["id"], r["name"]) for r in rows + rows[:50])


def test_dumps_of_one_file_are_dealt_over_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    parts = [(k, f"part {k}", k % 9) for k in range(64)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_size int").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    found = catalog.queries()["schema_catalog_dump"](spark, str(tmp_path))
    assert found.groupBy(F.spark_partition_id()).count().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(r["tables"].split("|")[0] for r in found.collect()) == sorted(f"part_{k}:id,price,kind" for k in range(64))
