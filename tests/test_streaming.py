import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from reelgrove.operators.dedupe import dedupe_by_key
from reelgrove.operators.quality import ITEM_RULES, USER_RULES, expectation_report
from reelgrove.session import shared_dir
from reelgrove.sources import sample_views as v
from reelgrove.sources.tables import KeyedTable, write_parquet
from reelgrove.streaming import ingest, quality_log, sinks
from reelgrove.streaming.schemas import grown, load_schema


def land(df, path, files):
    df.repartition(files).write.mode("append").parquet(path)


@pytest.mark.parametrize("files", [1, 3])
def test_streamed_silver_equals_batch(spark, small, files):
    base = shared_dir(spark, "stream")
    items = v.items(spark, small)
    land(items.unionByName(items), f"{base}/landing", files)
    ingest.ingest_files(spark, f"{base}/landing", f"{base}/bronze", f"{base}/cp1", files_per_batch=1)
    counts = ingest.stream_silver(
        spark, f"{base}/bronze", f"{base}/silver", f"{base}/cp2", ITEM_RULES, "content_id"
    )
    got, wanted = spark.read.parquet(f"{base}/silver"), v.silver_items(spark, small)
    assert got.exceptAll(wanted).count() == 0 and wanted.exceptAll(got).count() == 0
    assert counts["rows"] == items.count()
    assert counts["duration_positive"] == items.where("duration_min <= 0").count()


def test_a_second_run_takes_only_new_files(spark):
    base = shared_dir(spark, "again")
    for part in range(3):
        land(spark.range(part * 10, part * 10 + 10), f"{base}/landing", 1)
        ingest.ingest_files(spark, f"{base}/landing", f"{base}/bronze", f"{base}/cp")
        ingest.ingest_files(spark, f"{base}/landing", f"{base}/bronze", f"{base}/cp")
    ids = sorted(r.id for r in spark.read.parquet(f"{base}/bronze").collect())
    assert ids == list(range(30))


def test_duplicates_across_runs_are_remembered(spark):
    base = shared_dir(spark, "dedupe")
    schema = "user_id bigint, age int"
    for rows in ([(1, 20), (None, 30)], [(1, 99), (2, 40), (None, 31)]):
        land(spark.createDataFrame(rows, schema), f"{base}/bronze", 1)
        ingest.stream_silver(
            spark, f"{base}/bronze", f"{base}/silver", f"{base}/cp", USER_RULES, "user_id"
        )
    got = spark.read.parquet(f"{base}/silver").collect()
    assert sorted(map(tuple, got)) == [(1, 20), (2, 40)]


def test_dedupe_within_a_watermark(spark):
    base = shared_dir(spark, "watermark")
    t = datetime(2024, 1, 1)
    rows = [("a", t), ("a", t + timedelta(minutes=1)), ("b", t)]
    land(spark.createDataFrame(rows, "k string, ts timestamp"), f"{base}/bronze", 1)
    ingest.stream_silver(
        spark, f"{base}/bronze", f"{base}/silver", f"{base}/cp", [], "k", ("ts", "1 hour")
    )
    assert spark.read.parquet(f"{base}/silver").count() == 2


def test_new_columns_are_added_and_old_rows_hold_null(spark):
    base = shared_dir(spark, "evolve")
    land(spark.createDataFrame([(1, "a")], "id bigint, x string"), f"{base}/landing", 1)
    ingest.ingest_files(spark, f"{base}/landing", f"{base}/bronze", f"{base}/cp")
    land(spark.createDataFrame([(2, "b", 5)], "id bigint, x string, y int"), f"{base}/landing", 1)
    ingest.ingest_files(spark, f"{base}/landing", f"{base}/bronze", f"{base}/cp")
    got = sorted(map(tuple, ingest.read_evolved(spark, f"{base}/bronze").collect()))
    assert got == [(1, "a", None), (2, "b", 5)]
    assert load_schema(spark, f"{base}/cp.schema.json").fieldNames() == ["id", "x", "y"]


def test_without_evolution_new_columns_are_ignored(spark):
    base = shared_dir(spark, "fixed")
    land(spark.createDataFrame([(1,)], "id bigint"), f"{base}/landing", 1)
    ingest.ingest_files(spark, f"{base}/landing", f"{base}/bronze", f"{base}/cp", evolve=False)
    land(spark.createDataFrame([(2, 5)], "id bigint, y int"), f"{base}/landing", 1)
    ingest.ingest_files(spark, f"{base}/landing", f"{base}/bronze", f"{base}/cp", evolve=False)
    assert ingest.read_evolved(spark, f"{base}/bronze").columns == ["id"]


def test_known_columns_keep_their_type(spark):
    known = spark.createDataFrame([], "a int").schema
    found = spark.createDataFrame([], "b string, a bigint").schema
    assert [f.simpleString() for f in grown(known, found)] == ["a:int", "b:string"]


def test_late_rows_do_not_reopen_a_day(spark):
    base = shared_dir(spark, "late")
    first = [(datetime(2024, 1, 1, 5), 1.0), (datetime(2024, 1, 2, 5), 2.0)]
    second = [(datetime(2024, 1, 1, 6), 9.0), (datetime(2024, 1, 4, 5), 3.0)]
    for rows in (first, second):
        land(spark.createDataFrame(rows, "ts timestamp, value double"), f"{base}/in", 1)
        stream = spark.readStream.schema("ts timestamp, value double").parquet(f"{base}/in")
        profile = ingest.daily_profile_stream(stream, "ts", "value")
        ingest.drain(profile, f"{base}/out", f"{base}/cp")
    got = spark.read.parquet(f"{base}/out").orderBy("day").collect()
    assert [(str(r.day), r.rows, r.sum_value) for r in got] == [
        ("2024-01-01", 1, 1.0), ("2024-01-02", 1, 2.0),
    ]


def events(spark, base, rows):
    land(spark.createDataFrame(rows, "k bigint, ts timestamp, v string, e bigint"), f"{base}/in", 1)
    return spark.readStream.schema("k bigint, ts timestamp, v string, e bigint").parquet(f"{base}/in")


def test_streamed_history_over_two_runs(spark):
    base = shared_dir(spark, "scd")
    t = datetime(2024, 1, 1)
    table = KeyedTable(spark, f"{base}/t", ["k", "valid_from"])
    for rows in ([(1, t, "a", 1)], [(1, t + timedelta(days=2), "c", 3), (1, t + timedelta(days=1), "b", 2)]):
        sinks.stream_scd2(events(spark, base, rows), table, ["k"], "ts", "e", f"{base}/cp")
    got = table.read().orderBy("valid_from").collect()
    assert [(r.v, r.valid_to, r.is_current) for r in got] == [
        ("a", t + timedelta(days=1), False),
        ("b", t + timedelta(days=2), False),
        ("c", None, True),
    ]


def test_streamed_upsert_keeps_the_latest(spark):
    base = shared_dir(spark, "latest")
    t = datetime(2024, 1, 1)
    table = KeyedTable(spark, f"{base}/t", "k")
    batches = ([(1, t, "a", 1), (1, t + timedelta(1), "b", 2), (2, t, "x", 3)], [(2, t + timedelta(3), "y", 4)])
    for rows in batches:
        sinks.stream_upsert(
            events(spark, base, rows), table, sinks.latest_first("ts", "e"), f"{base}/cp"
        )
    assert sorted((r.k, r.v) for r in table.read().collect()) == [(1, "b"), (2, "y")]


def test_request_log_is_laid_out_by_day(spark, small):
    base = shared_dir(spark, "log")
    scored = write_parquet(v.scored_requests(spark, small), f"{base}/in")
    stream = spark.readStream.schema(scored.schema).parquet(f"{base}/in")
    sinks.stream_request_log(stream, f"{base}/log", f"{base}/cp")
    log = spark.read.parquet(f"{base}/log")
    assert log.count() == scored.count()
    assert log.where(F.to_date("request_time") != F.col("day")).count() == 0
    first = json.loads(log.orderBy("event_id").first().response)
    assert set(first[0]) == {"content_id", "score", "genre"}


def test_only_new_files_are_opened_for_their_columns(spark, tmp_path, monkeypatch):
    landing, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    opened = []
    real = ingest.landed_schema
    monkeypatch.setattr(ingest, "landed_schema", lambda s, *paths: opened.append(paths) or real(s, *paths))
    land(spark.range(3), landing, 1)
    ingest.ingest_files(spark, landing, target, checkpoint)
    ingest.ingest_files(spark, landing, target, checkpoint)
    land(spark.range(3).selectExpr("id", "id AS more"), landing, 1)
    ingest.ingest_files(spark, landing, target, checkpoint)
    assert [len(p) for p in opened] == [1, 1] and opened[0] != opened[1]


def test_a_file_that_keeps_an_old_time_brings_its_columns(spark, tmp_path):
    landing, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    land(spark.range(3), landing, 1)
    ingest.ingest_files(spark, landing, target, checkpoint)
    land(spark.range(3, 6).selectExpr("id", "id AS more"), landing, 1)
    for name in os.listdir(landing):
        earlier = os.stat(f"{landing}/{name}").st_mtime - 7_200
        os.utime(f"{landing}/{name}", (earlier, earlier))
    ingest.ingest_files(spark, landing, target, checkpoint)
    assert sorted(r.more for r in ingest.read_evolved(spark, target).where("more IS NOT NULL").collect()) == [3, 4, 5]


@pytest.mark.parametrize("order", [[0, 1, 2], [2, 1, 0], [1, 2, 0]])
def test_the_least_row_of_a_key_stays_however_files_come(spark, tmp_path, order):
    schema = "k bigint, a string, b double"
    parts = [
        [(1, "b", 1.0), (2, None, 2.0), (None, "z", 1.0)],
        [(1, "a", 9.0), (2, "x", None), (3, "n", float("nan"))],
        [(1, "a", 2.0), (None, "y", None), (3, "n", 5.0), (4, None, None)],
    ]
    table = KeyedTable(spark, str(tmp_path / "t"), "k", buckets=3)
    for i in order:
        land(spark.createDataFrame(parts[i], schema), str(tmp_path / "in"), 2)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        sinks.stream_least(stream, table, str(tmp_path / "cp"))
    wanted = dedupe_by_key(spark.createDataFrame([r for p in parts for r in p], schema), "k")
    got = table.read()
    assert got.exceptAll(wanted).count() == 0 and wanted.exceptAll(got).count() == 0


def test_sketches_are_near_the_exact_values(spark, tmp_path):
    rows = spark.range(200_000).selectExpr(
        "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, id % 3) AS ts", "double(pmod(hash(id), 7919)) AS value"
    )
    land(rows, str(tmp_path / "in"), 3)
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    ingest.drain(ingest.daily_sketch_stream(stream, "ts", "value"), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(got) >= 1
    for r in got:
        assert abs(r.distinct_values - 7919) <= ingest.DISTINCT_ERROR * 7919
        for q, p in ((r.p25, 0.25), (r.p50, 0.5), (r.p75, 0.75)):
            assert abs(q / 7919 - p) < 2 * ingest.RANK_ERROR


def test_quality_is_logged_per_micro_batch(spark):
    base = shared_dir(spark, "logged")
    schema, log = "user_id bigint, age int", f"{base}/log"
    landings = ([[(1, 20), (2, 200)], [(None, 30), (3, 300)]], [[(4, None), (5, 5)]])
    for files in landings:
        for rows in files:
            land(spark.createDataFrame(rows, schema), f"{base}/bronze", 1)
        counts = ingest.stream_silver(
            spark, f"{base}/bronze", f"{base}/silver", f"{base}/cp", USER_RULES, "user_id",
            name="users", files_per_batch=1, log=log,
        )
    assert counts == {"rows": 2, "user_id_not_null": 0, "valid_age": 1}  # of the last run
    stored = quality_log.read_quality_log(spark, log)
    assert stored.select("query_id").distinct().count() == 1  # a restart goes on with its stream
    ages = stored.where("rule = 'valid_age'").orderBy("batch_id").collect()
    assert [r.batch_id for r in ages] == [0, 1, 2] and [r.failed for r in ages] == [1, 1, 1]
    bronze = spark.read.parquet(f"{base}/bronze")
    wanted = expectation_report(dedupe_by_key(bronze, "user_id"), "users", USER_RULES)
    report = quality_log.logged_report(stored)
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, wanted.collect()))


def test_a_repeated_batch_replaces_its_metrics(spark):
    from types import SimpleNamespace

    from pyspark.sql import Row

    base = shared_dir(spark, "repeated")
    log = quality_log.QualityLog(spark, base, "q", "users", USER_RULES)

    def event(batch, failed):
        seen = {"q": Row(rows=10, user_id_not_null=0, valid_age=failed)}
        return SimpleNamespace(progress=SimpleNamespace(id="a", batchId=batch, observedMetrics=seen))

    for batch, failed in ((0, 1), (1, 2), (1, 3)):
        log.onQueryProgress(event(batch, failed))
    log.onQueryProgress(SimpleNamespace(progress=SimpleNamespace(id="a", batchId=2, observedMetrics={})))
    report = quality_log.logged_report(quality_log.read_quality_log(spark, base)).where("rule = 'valid_age'")
    assert [(r.rows, r.failed, r.pass_rate) for r in report.collect()] == [(20, 4, 0.8)]


def test_metrics_that_cannot_be_stored_end_the_job(spark, tmp_path):
    (tmp_path / "taken").write_text("a file")
    base = shared_dir(spark, "unwritable")
    land(spark.createDataFrame([(1, 20)], "user_id bigint, age int"), f"{base}/bronze", 1)
    with pytest.raises(Exception):
        ingest.stream_silver(
            spark, f"{base}/bronze", f"{base}/silver", f"{base}/cp", USER_RULES, log=str(tmp_path / "taken")
        )
