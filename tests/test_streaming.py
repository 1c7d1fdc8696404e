"""Incremental ingest (availableNow + foreachBatch merge), watermark dedup
and tumbling daily counts."""

import os
import uuid

from pyspark.sql import functions as F

from panelforge.operators import clean
from panelforge.streaming import ingest

HDR = "unique_key,created_date,complaint_type,incident_zip,community_board,borough\n"


def land(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(HDR + "".join(",".join(r) + "\n" for r in rows))


def row(k, day, board="B1"):
    return (str(k), f"2024-01-{day:02d}T10:00:00.000", "Noise", "10001", board, "X")


def test_available_now_merge_keeps_earlier_rows(spark, tmp):
    src, target, ckpt = f"{tmp}/landing", f"{tmp}/clean", f"{tmp}/ckpt"
    land(src, "day_01.csv", [row(1, 1), row(2, 2), row(3, 2), row(9, 2, board="")])
    ingest.ingest_available_now(spark, src, target, ckpt)
    first = sorted(r.unique_key for r in spark.read.parquet(target).collect())
    assert first == ["1", "2", "3"]                       # empty board dropped
    # overlapping yearly file: keys 2 and 3 again, plus new keys on day 2 and 3
    land(src, "year_2024.csv", [row(2, 2), row(3, 2), row(4, 2), row(5, 3)])
    ingest.ingest_available_now(spark, src, target, ckpt)
    got = spark.read.parquet(target)
    assert sorted(r.unique_key for r in got.collect()) == list("12345")
    per_day = {str(r.day): r.n for r in got.groupBy("day").agg(F.count("*").alias("n")).collect()}
    assert per_day == {"2024-01-01": 1, "2024-01-02": 3, "2024-01-03": 1}
    # a late file that touches day 1 with one new key must keep key 1
    land(src, "late.csv", [row(6, 1)])
    ingest.ingest_available_now(spark, src, target, ckpt)
    assert sorted(r.unique_key for r in spark.read.parquet(target).collect()) == list("123456")
    # nothing new: a rerun changes nothing
    ingest.ingest_available_now(spark, src, target, ckpt)
    assert spark.read.parquet(target).count() == 6
    # equals the batch distinct count over all landed files
    from panelforge.sources import files
    batch = clean.complaints_clean(files.read_csv_by_header(spark, src, multiline=True))
    assert batch.select("unique_key").distinct().count() == 6


def test_dedup_and_daily_counts_streams(spark, tmp):
    src = f"{tmp}/landing"
    land(src, "a.csv", [row(1, 1), row(2, 1), row(1, 1), row(3, 2)])
    land(src, "b.csv", [row(3, 2), row(4, 5)])
    cleaned = clean.complaints_clean(ingest.complaint_file_stream(spark, src))
    name = "dedup_" + uuid.uuid4().hex[:8]
    q = (ingest.dedup_stream(cleaned, delay="3 days").writeStream.format("memory")
         .queryName(name).option("checkpointLocation", f"{tmp}/c1").start())
    q.processAllAvailable()
    q.stop()
    assert sorted(r.unique_key for r in spark.table(name).collect()) == list("1234")
    name2 = "daily_" + uuid.uuid4().hex[:8]
    q2 = (ingest.daily_counts_stream(cleaned, delay="1 day").writeStream.format("memory")
          .outputMode("append").queryName(name2)
          .option("checkpointLocation", f"{tmp}/c2").trigger(availableNow=True).start())
    q2.awaitTermination()
    got = {str(r.load_date): r.daily_count for r in spark.table(name2).collect()}
    # raw (undeduplicated) counts; day 5 is still open under the watermark
    assert got.get("2024-01-01") == 3
    assert got.get("2024-01-02") == 2
    assert "2024-01-05" not in got


def test_redelivered_key_replaces_stored_row(spark, tmp):
    src, target, ckpt = f"{tmp}/landing", f"{tmp}/clean", f"{tmp}/ckpt"
    land(src, "a.csv", [row(1, 1), row(2, 1)])
    ingest.ingest_available_now(spark, src, target, ckpt)
    fixed = ("1", "2024-01-01T10:00:00.000", "Heat", "10001", "B1", "X")
    land(src, "b.csv", [fixed])
    ingest.ingest_available_now(spark, src, target, ckpt)
    got = {r.unique_key: r.complaint_type for r in spark.read.parquet(target).collect()}
    assert got == {"1": "Heat", "2": "Noise"}


def test_latest_per_key_collapses_copies(spark):
    df = spark.createDataFrame([(1, "a", 0), (1, "b", 2), (1, "c", 1), (2, "z", 0)] * 50,
                               "k int, v string, o int")
    out = ingest.latest_per_key(df, "k", "o")
    assert sorted(tuple(r) for r in out.collect()) == [(1, "b"), (2, "z")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan


def stored(spark, target):
    return sorted((str(r.unique_key), str(r.day), r.complaint_type) for r in
                  spark.read.schema("unique_key string, created_date timestamp_ntz, "
                                    "complaint_type string, incident_zip string, "
                                    "community_board string, borough string, day date")
                  .parquet(target).collect())


def test_junk_dates_missing_keys_and_moved_days(spark, tmp):
    src, target, ckpt = f"{tmp}/landing", f"{tmp}/clean", f"{tmp}/ckpt"
    junk = ("A1", "not a date", "Noise", "10001", "B1", "X")
    nokey = ("", "2024-01-03T10:00:00.000", "Noise", "10001", "B1", "X")
    land(src, "a.csv", [junk, row("A2", 2), nokey, nokey])
    ingest.ingest_available_now(spark, src, target, ckpt)
    # another junk date, a corrected one and a key that moves off its only day
    land(src, "b.csv", [("A3", "?", "Noise", "1", "B1", "X"), row("A1", 1), row("A2", 5), nokey])
    ingest.ingest_available_now(spark, src, target, ckpt)
    assert stored(spark, target) == [
        ("A1", "2024-01-01", "Noise"), ("A2", "2024-01-05", "Noise"), ("A3", "None", "Noise"),
        *[("None", "2024-01-03", "Noise")] * 3]
    assert not os.path.exists(f"{target}/day=2024-01-02")


def test_files_with_other_columns_are_read_by_header(spark, tmp):
    src, target, ckpt = f"{tmp}/landing", f"{tmp}/clean", f"{tmp}/ckpt"
    land(src, "a.csv", [row(1, 1)])
    os.makedirs(f"{src}/2024", exist_ok=True)
    with open(f"{src}/2024/b.csv", "w") as f:
        f.write("agency,borough,created_date,unique_key,complaint_type,community_board\n"
                "NYPD,Queens,2024-01-09T00:00:00.000,K2,Heat,B7\n")
    ingest.ingest_available_now(spark, src, target, ckpt)
    assert stored(spark, target) == [("1", "2024-01-01", "Noise"), ("K2", "2024-01-09", "Heat")]


def test_replay_after_half_a_swap(spark, tmp):
    target, staging = f"{tmp}/clean", f"{tmp}/staging/epoch=1"
    schema = "unique_key string, v string, day date"
    make = lambda rows: spark.createDataFrame(rows, "unique_key string, v string, day string") \
        .selectExpr("unique_key", "v", "cast(day as date) as day")
    ingest.merge_into_days(make([("1", "old", "2024-01-01"), ("2", "old", "2024-01-02")]),
                           target, f"{tmp}/staging/epoch=0")
    batch = make([("3", "new", "2024-01-01"), ("2", "new", "2024-01-03")])
    ingest.merge_into_days(batch, target, staging, epoch=1)
    done = sorted(tuple(r) for r in spark.read.schema(schema).parquet(target).collect())
    # the job died in the swap: a day is gone from the target; the epoch runs again
    import shutil
    shutil.rmtree(f"{target}/day=2024-01-01")
    ingest.merge_into_days(batch, target, staging, epoch=1)
    assert sorted(tuple(r) for r in spark.read.schema(schema).parquet(target).collect()) == done
    assert [r[:2] for r in done] == [("1", "old"), ("2", "new"), ("3", "new")]


def test_two_versions_in_one_batch(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "b"), (None, 1, "n"),
                                (None, 1, "n")], "k string, o int, v string")
    got = ingest.latest_per_key(df, "k", ["o"]).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(
        map(str, [("a", "y"), (None, "n"), (None, "n")]))


def test_a_file_of_another_header_fails_the_plain_stream(spark, tmp):
    src = f"{tmp}/landing"
    os.makedirs(src)
    with open(f"{src}/a.csv", "w") as f:
        f.write("borough,unique_key,created_date,complaint_type,incident_zip,community_board\n"
                "X,1,2024-01-01T00:00:00.000,Heat,1,B\n")
    q = (ingest.complaint_file_stream(spark, src).writeStream.format("noop")
         .option("checkpointLocation", f"{tmp}/c").trigger(availableNow=True).start())
    import pytest
    with pytest.raises(Exception):
        q.awaitTermination()


def test_rows_without_a_date_are_counted(spark, tmp):
    src = f"{tmp}/landing"
    land(src, "a.csv", [row(1, 1), ("2", "junk", "Noise", "1", "B", "X")])
    ingest.daily_counts_available_now(spark, src, f"{tmp}/out", f"{tmp}/c")
    assert {str(r.load_date): r.daily_count for r in spark.read.parquet(f"{tmp}/out").collect()} \
        == {"2024-01-01": 1, "None": 1}


def test_a_reset_stream_does_not_use_another_streams_stage(spark, tmp):
    src, target, ckpt = f"{tmp}/landing", f"{tmp}/clean", f"{tmp}/ckpt"
    for k in (1, 2, 3):
        land(src, f"{k}.csv", [row(k, k)])
        ingest.ingest_available_now(spark, src, target, ckpt)
    os.rename(f"{ckpt}/state", f"{ckpt}/lost")
    land(src, "4.csv", [row(4, 3)])
    ingest.ingest_available_now(spark, src, target, ckpt)
    assert sorted(r.unique_key for r in spark.read.parquet(target).collect()) == list("1234")


def test_stages_go_and_a_foreign_stage_is_cleared(spark, tmp):
    src, target, ckpt = f"{tmp}/landing", f"{tmp}/clean", f"{tmp}/ckpt"
    os.makedirs(f"{ckpt}/staging/epoch=0/rows")
    for k in range(1, 6):
        land(src, f"{k}.csv", [row(k, k % 2 + 1)])
        ingest.ingest_available_now(spark, src, target, ckpt)
        left = os.listdir(f"{ckpt}/staging") if os.path.exists(f"{ckpt}/staging") else []
        assert left == []
    assert spark.read.parquet(target).count() == 5
    assert os.path.isdir(ingest.key_index(target, ingest.KEY_BUCKETS))


def test_batch_reads_the_index_buckets_of_its_keys_only(spark, tmp):
    make = lambda rows: spark.createDataFrame(
        rows, "unique_key string, complaint_type string, day string")
    target = f"{tmp}/t"
    ingest.merge_into_days(make([(f"k{i}", "a", f"2024-01-{i % 9 + 1:02d}") for i in range(300)]),
                           target, f"{tmp}/s0", buckets=16)
    index = ingest.key_index(target, 16)
    one = ingest.read_key_index(spark, index, "unique_key string, day string", [3])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1][:60]
    assert len(one.inputFiles()) and 0 < one.count() < 60
    # every bucket but those of the moved key is left as it was
    at = {b: os.listdir(f"{index}/{b}") for b in os.listdir(index) if b.startswith("bucket")}
    ingest.merge_into_days(make([("k7", "b", "2024-02-01")]), target, f"{tmp}/s1", buckets=16)
    now = {b: os.listdir(f"{index}/{b}") for b in os.listdir(index) if b.startswith("bucket")}
    assert sum(at[b] != now[b] for b in at) == 1
    rows = spark.read.parquet(target).filter("unique_key = 'k7'").collect()
    assert [(r.complaint_type, str(r.day)) for r in rows] == [("b", "2024-02-01")]
    got = spark.read.parquet(index).select("unique_key", F.col("day").cast("string"))
    want = spark.read.parquet(target).select("unique_key", F.col("day").cast("string"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_a_table_without_an_index_gets_one(spark, tmp):
    make = lambda rows: spark.createDataFrame(
        rows, "unique_key string, complaint_type string, day string")
    target = f"{tmp}/t"
    make([("1", "a", "2024-01-01"), ("2", "a", "2024-01-02"), (None, "a", "2024-01-02")]) \
        .write.partitionBy("day").parquet(target)
    ingest.merge_into_days(make([("2", "b", "2024-01-03")]), target, f"{tmp}/s")
    got = sorted((r.unique_key or "", r.complaint_type, str(r.day))
                 for r in spark.read.parquet(target).collect())
    assert got == [("", "a", "2024-01-02"), ("1", "a", "2024-01-01"), ("2", "b", "2024-01-03")]


def test_odd_file_names_are_ingested(spark, tmp):
    src, target, ckpt = f"{tmp}/landing", f"{tmp}/clean", f"{tmp}/ckpt"
    for i, name in enumerate(["a b.csv", "c[1].csv", "d%20e.csv", "e{x}.csv", "f?.csv"]):
        land(src, name, [row(i, 1)])
    ingest.ingest_available_now(spark, src, target, ckpt)
    assert spark.read.parquet(target).count() == 5


def test_windows_in_append_mode_count_late_rows_on_the_side(spark, tmp):
    from panelforge.streaming import stateful
    src = f"{tmp}/landing"
    nodate = ("x", "?", "Noise", "10001", "B1", "X")

    def run():
        rows = stateful.window_counts_available_now(spark, src, f"{tmp}/out", f"{tmp}/ckpt",
                                                    delay="2 days").collect()
        return {str(r.window_start)[:10]: (r.n_rows, r.n_late, r.closed) for r in rows}

    land(src, "a.csv", [row(1, 1), row(2, 1), row(3, 3), row(4, 10), nodate])
    assert run() == {"2024-01-01": (2, 0, True), "2024-01-03": (1, 0, True),
                     "2024-01-10": (None, 0, False), "None": (None, 0, False)}
    # days 1 and 2 are closed: late; day 9 is open yet
    land(src, "b.csv", [row(5, 1), row(6, 2), row(7, 9), row(8, 20)])
    assert run() == {"2024-01-01": (2, 1, True), "2024-01-02": (0, 1, True),
                     "2024-01-03": (1, 0, True), "2024-01-09": (1, 0, True),
                     "2024-01-10": (1, 0, True), "2024-01-20": (None, 0, False),
                     "None": (None, 0, False)}
    assert run()["2024-01-20"] == (None, 0, False)  # nothing new: nothing changes


def test_backfill_is_kept_and_repeats_are_dropped(spark, tmp):
    from panelforge.streaming import stateful
    src, target, ckpt = f"{tmp}/landing", f"{tmp}/clean", f"{tmp}/ckpt"
    schema = ("unique_key string, created_date timestamp_ntz, complaint_type string, "
              "incident_zip string, community_board string, borough string, day date")

    def run():
        stateful.dedup_available_now(spark, src, target, ckpt, buckets=8)
        return sorted((r.unique_key or "", str(r.day), r.complaint_type)
                      for r in stateful.deduplicated(spark, target, schema).collect())

    nokey = ("", "2024-01-03T10:00:00.000", "Noise", "10001", "B1", "X")
    other = ("9", "2024-01-20T10:00:00.000", "Second", "10001", "B1", "X")
    land(src, "a.csv", [row(9, 20), row(9, 20), row(8, 21), nokey])
    assert run() == [("", "2024-01-03", "Noise"), ("8", "2024-01-21", "Noise"), ("9", "2024-01-20", "Noise")]
    land(src, "b.csv", [row(1, 1), other, row(2, 2), nokey])  # a backfill of older days
    want = [("", "2024-01-03", "Noise")] * 2 + [
        ("1", "2024-01-01", "Noise"), ("2", "2024-01-02", "Noise"),
        ("8", "2024-01-21", "Noise"), ("9", "2024-01-20", "Noise")]
    assert run() == want
    assert run() == want


def test_dedup_batch_that_dies_after_staging_is_taken_up(spark, tmp, monkeypatch):
    import pytest
    from panelforge.streaming import stateful
    src, target, ckpt = f"{tmp}/landing", f"{tmp}/clean", f"{tmp}/ckpt"
    land(src, "a.csv", [row(1, 1), row(2, 2)])
    real = stateful.overwrite_slices

    def dies(*_):
        raise RuntimeError("lost in the swap")

    monkeypatch.setattr(stateful, "overwrite_slices", dies)
    with pytest.raises(Exception):
        stateful.dedup_available_now(spark, src, target, ckpt, buckets=4)
    monkeypatch.setattr(stateful, "overwrite_slices", real)
    stateful.dedup_available_now(spark, src, target, ckpt, buckets=4)
    land(src, "b.csv", [row(2, 2), row(3, 3)])
    stateful.dedup_available_now(spark, src, target, ckpt, buckets=4)
    rows = stateful.deduplicated(spark, target, "unique_key string, day date").collect()
    assert sorted(r.unique_key for r in rows) == ["1", "2", "3"]
