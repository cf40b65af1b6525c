"""A stream run to its end equals the batch, and a replayed batch adds nothing."""

import pytest
from pyspark.sql import functions as F

from conftest import FOLDER
from exposura.streaming import jobs as s


@pytest.fixture
def queue(spark, tmp_path):
    path = str(tmp_path / "queue")
    spark.range(100).select("id", (F.col("id") % 7).alias("k")).repartition(5).write.json(path)
    return path


SCHEMA = "id long, k long"


def test_one_file_per_batch(spark, queue, tmp_path):
    stream = s.queue_source(spark, queue, SCHEMA, files_per_trigger=1)
    stats = s.stream_stats(stream, F.col("k") == 0, str(tmp_path / "o"), str(tmp_path / "c"))
    assert stats.count() == 5
    assert tuple(stats.agg(F.sum("processed"), F.sum("failed"), F.sum("uploaded")).first()) == (100, 15, 85)


def test_upsert_over_batches_equals_batch(spark, queue, tmp_path):
    out = str(tmp_path / "o")
    stream = s.queue_source(spark, queue, SCHEMA, files_per_trigger=1)
    s.stream_upsert(stream, out, str(tmp_path / "c"), ["k"], ["id"])
    want = {i % 7: i for i in range(100)}
    assert {r.k: r.id for r in s.read_latest(spark, out, ["k"], ["id"]).collect()} == want
    s.compact(spark, out, str(tmp_path / "merged"), ["k"], ["id"])
    assert spark.read.parquet(str(tmp_path / "merged")).count() == 7


def test_restart_takes_only_new_files(spark, queue, tmp_path):
    out, checkpoint = str(tmp_path / "o"), str(tmp_path / "c")
    for extra in (0, 100):
        if extra:
            spark.range(100, 130).select("id", (F.col("id") % 7).alias("k")).write.mode("append").json(queue)
        s.append_to(s.queue_source(spark, queue, SCHEMA), out, checkpoint)
    assert spark.read.parquet(out).count() == 130


def test_failed_batch_is_replayed_once(spark, queue, tmp_path):
    out, checkpoint = str(tmp_path / "o"), str(tmp_path / "c")
    write = s.write_batch(out)

    def failing(batch, batch_id):
        write(batch, batch_id)
        raise RuntimeError("invented failure")

    with pytest.raises(Exception):
        s.run_available(s.queue_source(spark, queue, SCHEMA).writeStream.foreachBatch(failing), checkpoint)
    s.run_available(s.queue_source(spark, queue, SCHEMA).writeStream.foreachBatch(write), checkpoint)
    assert spark.read.parquet(out).count() == 100


def test_live_counts(spark, queue, tmp_path):
    out = str(tmp_path / "o")
    s.live_count(s.queue_source(spark, queue, SCHEMA, files_per_trigger=2), "k", out, str(tmp_path / "c"))
    got = {r.k: r.n for r in s.read_latest(spark, out, ["k"], ["n"]).collect()}
    assert got == {k: len([i for i in range(100) if i % 7 == k]) for k in range(7)}


def test_table_stream_reads_a_table_folder(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "t.parquet"))
    s.append_to(s.table_stream(spark, str(tmp_path), "t"), str(tmp_path / "o"), str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "o")).count() == 10


def test_table_stream_reads_a_single_file(spark, tmp_path):
    s.append_to(s.table_stream(spark, FOLDER, "region"), str(tmp_path / "o"), str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "o")).count() == 5


def test_high_water(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 5), (3, 1)], "ch long, id long")
    marks = spark.createDataFrame([(1, 1), (2, 5)], "ch long, last_id long")
    got = sorted(tuple(r) for r in s.incremental_by_id(df, marks, "ch", "id").collect())
    assert got == [(1, 2), (3, 1)]


def test_timed_micro_batches(spark, queue, tmp_path):
    out = str(tmp_path / "o")
    stream = s.queue_source(spark, queue, SCHEMA, files_per_trigger=2)
    writer = stream.writeStream.foreachBatch(s.write_batch(out)).option("checkpointLocation", str(tmp_path / "c"))
    query = s.micro_batch(writer, seconds=1).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    stored = spark.read.parquet(out)
    assert stored.count() == 100
    assert stored.select("batch_id").distinct().count() == 3


def test_late_rows_beyond_the_watermark_are_dropped(spark, tmp_path):
    path = tmp_path / "q"
    path.mkdir()
    batches = ['{"ts": "2024-01-01T00:10:00Z", "k": "a"}', '{"ts": "2024-01-01T05:00:00Z", "k": "a"}',
               '{"ts": "2024-01-01T00:20:00Z", "k": "a"}', '{"ts": "2024-01-01T05:05:00Z", "k": "a"}']
    out, checkpoint = str(tmp_path / "o"), str(tmp_path / "c")
    for i, line in enumerate(batches):
        (path / f"{i}.json").write_text(line)
        stream = s.queue_source(spark, str(path), "ts timestamp, k string")
        s.window_counts(stream, "ts", "k", out, checkpoint)
    got = s.read_latest(spark, out, ["window_start", "k"], ["n"])
    assert sorted((r.window_start.hour, r.n) for r in got.collect()) == [(0, 1), (5, 2)]


def test_headers_tell_the_mode_and_identities_leave_hashed(spark, tmp_path):
    header = 'E_Mail,Name,"Mobile"'
    rows = [(1, header), (2, "a@example.com,-,"), (3, ' ,"Ann",+1 555'), (4, "null,none,n/a"), (5, None), (6, "b@example.com")]
    df = spark.createDataFrame(rows, "id int, line string")
    assert s.header_mode(s.header_columns(header)) == "identity"
    batch = s.normalize_lines(df, "line", header, "p")
    assert batch.columns == ["id", "email_hash", "username_hash", "phone_hash"]
    got = {r["id"]: r for r in batch.collect()}
    assert set(got) == {2, 3, 6} and got[2]["username_hash"] is None and got[2]["email_hash"] != got[6]["email_hash"]
    assert not any("@" in str(v) or "Ann" in str(v) for r in got.values() for v in r)

    path = str(tmp_path / "lines")
    df.repartition(3).write.parquet(path)
    stream = s.normalize_lines(spark.readStream.schema(df.schema).parquet(path), "line", header, "p")
    s.append_to(stream, str(tmp_path / "o"), str(tmp_path / "c"))
    assert sorted(spark.read.parquet(str(tmp_path / "o")).collect()) == sorted(batch.collect())


def test_transaction_lines(spark):
    header = "purchase_reference_id,charge_amount,purchase_amount,other"
    df = spark.createDataFrame([("r1,5,,z",), ("r2,5,7,z",), ("-,null,,z",), ("",)], "line string")
    got = s.normalize_lines(df, "line", header, "p").collect()
    assert [(r["purchase_ref"], r["charge_amount"]) for r in got] == [("r1", "5"), ("r2", "7")]


def test_payloads_of_either_mode_and_of_none(spark):
    df = spark.createDataFrame(
        [(1, '{"amount": "5", "email": "a@example.com"}'), (2, '{"inner": "{\\"vendor\\": \\"v\\"}"}'),
         (3, '{"email": " A@example.com "}'), (4, '{"x": 1}'), (5, "broken"), (6, None)], "id int, payload string")
    found = s.stream_normalize_dict(df, "payload", {"amount": "charge_amount"}, "p", {"inner": {"vendor": "payment_vendor"}})
    got = {r["id"]: r for r in found.collect()}
    assert {k: r["mode"] for k, r in got.items()} == {1: "transaction", 2: "transaction", 3: "identity"}
    assert got[2]["payment_vendor"] == "v" and got[1]["email_hash"] is None and len(got[3]["email_hash"]) == 64


def test_mapped_identities_never_leave_in_clear(spark):
    df = spark.createDataFrame([("a@example.com,hunter22,Ann,x",)], "line string")
    out = s.stream_normalize(df, "line", {0: "email", 1: "password", 2: "first_name", 3: "city"}, pepper="p")
    assert set(out.columns) == {"email_hash", "secret_kind", "city"}
    with pytest.raises(ValueError):
        s.stream_normalize(df, "line", {0: "email"})


def test_manifest_in_groups_reads_every_file_once(spark, queue, tmp_path):
    files = spark.read.json(queue, schema=SCHEMA).select(F.col("_metadata.file_path").alias("file_path")).distinct()
    manifest = str(tmp_path / "manifest")
    files.coalesce(1).write.json(manifest)
    out = str(tmp_path / "o")
    s.ingest_manifest(
        s.queue_source(spark, manifest, "file_path string"), "file_path", out, str(tmp_path / "d"), str(tmp_path / "c"),
        lambda paths: spark.read.schema(SCHEMA).json(paths), group=2)
    assert spark.read.parquet(out).select("id").distinct().count() == spark.read.parquet(out).count() == 100
