"""Loads that go on past bad files, period ledgers, versioned replacement,
rolling slices and bucketed facts."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge import functions as fn
from panelforge.operators import model, publish
from panelforge.sources import files, loads, periods, sinks

KV = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])


def parquet_file(df, folder, name, tmp):
    """One Parquet file of its own name."""
    df.coalesce(1).write.mode("overwrite").parquet(f"{tmp}/one/{name}")
    part, = [p for p in os.listdir(f"{tmp}/one/{name}") if p.endswith(".parquet")]
    os.makedirs(folder, exist_ok=True)
    with open(f"{tmp}/one/{name}/{part}", "rb") as src, open(f"{folder}/{name}", "wb") as out:
        out.write(src.read())
    return f"{folder}/{name}"


def test_tolerant_load_reports_every_file(spark, tmp):
    base = f"{tmp}/in"
    kv = spark.createDataFrame([(i, f"value {i} " * 20) for i in range(3000)], KV)
    parquet_file(kv, base, "good 1[x].parquet", tmp)
    parquet_file(kv.filter("k < 5"), f"{base}/sub", "good%20.parquet", tmp)
    parquet_file(kv.filter("k < 0"), base, "none.parquet", tmp)
    cut = parquet_file(kv, base, "cut.parquet", tmp)
    data = open(cut, "rb").read()
    open(cut, "wb").write(data[:len(data) // 2])
    hole = parquet_file(kv.repartition(1).sortWithinPartitions("k"), base, "hole.parquet", tmp)
    data = open(hole, "rb").read()
    open(hole, "wb").write(data[:200] + b"\xff" * (len(data) // 2) + data[200 + len(data) // 2:])
    open(f"{base}/empty.parquet", "wb").close()
    parquet_file(kv.select(F.array("v").alias("k"), "v"), base, "other.parquet", tmp)
    open(f"{base}/text.parquet", "w").write("no parquet at all")
    rows, report = loads.tolerant_load(spark, base, f"{tmp}/out", KV,
                                       ["cut.parquet", "gone/away.parquet"])
    got = {r.file: (r.status, r.expected_rows, r.read_rows) for r in report.collect()}
    status = {f: s for f, (s, _, _) in got.items()}
    assert status == {
        "good 1[x].parquet": "loaded", "sub/good%20.parquet": "loaded", "none.parquet": "no rows",
        "cut.parquet": "unreadable", "hole.parquet": "damaged", "empty.parquet": "empty file",
        "other.parquet": "damaged", "text.parquet": "unreadable", "gone/away.parquet": "missing"}
    assert got["good 1[x].parquet"][1:] == (3000, 3000) and got["hole.parquet"][1] == 3000
    assert rows.schema.fieldNames() == ["k", "v"] and rows.count() == 3005
    assert rows.groupBy("k").count().filter("count > 2").count() == 0


def test_load_mixed_types(spark, tmp):
    base = f"{tmp}/in"
    one = spark.createDataFrame([(1, "a", 1.5)], "id int, name string, x double")
    for i in range(5):
        parquet_file(one, base, f"a{i}.parquet", tmp)
    parquet_file(spark.createDataFrame([("7", 2)], "ID string, X int"), base, "b 1.parquet", tmp)
    parquet_file(spark.createDataFrame([("junk", 5)], "ID string, Name int"), base, "c.parquet", tmp)
    parquet_file(one, base, "d.parquet", tmp)
    target = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.DoubleType()),
                           T.StructField("name", T.StringType())])
    out = loads.load_mixed_types(spark, base, target)
    assert out.dtypes == [("id", "bigint"), ("x", "double"), ("name", "string")]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [(1, 1.5, "a")] * 6 + [(7, 2.0, None), (None, None, "5")], key=str)
    uris = [r.uri for r in loads.listing(spark, base).collect()]
    groups = loads.schema_groups(spark, sorted(uris))
    assert sorted(len(f) for _, f in groups) == [1, 1, 6]  # kinds come together again
    with pytest.raises(Exception):
        loads.load_mixed_types(spark, f"{tmp}/nothing", target)


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_period_ledger_of_matrix_files(spark, tmp):
    write(f"{tmp}/in/socio_2020.json", '[["a","b"],\n["1","2"],["3",null]]')
    write(f"{tmp}/in/socio_2021.json", '[["a","b"],["1",')
    write(f"{tmp}/in/socio_2022.json", '[["a","b"]]')
    write(f"{tmp}/in/socio_2023.json", '[["a"],["1"]]')
    write(f"{tmp}/in/socio_2024.json", "")
    write(f"{tmp}/in/socio_2030.json", '[["b","a","c"],["2","1","9"]]')
    args = (f"{tmp}/in/socio_*.json", r"socio_(\d{4})")
    rows, ledger = periods.load_periods(spark, *args, range(2019, 2025), {"a": "a", "b": "b"})
    got = {r.period: r.asDict() for r in ledger.collect()}
    assert {p: r["status"] for p, r in got.items()} == {
        2019: "absent", 2020: "loaded", 2021: "corrupt", 2022: "no rows", 2023: "corrupt",
        2024: "no rows", 2030: "loaded"}
    assert got[2020]["n_rows"] == 2 and got[2020]["n_files"] == 1 and got[2024]["n_files"] == 1
    assert got[2021]["n_bad_docs"] == 1 and rows.count() >= 3
    for year in (2020, 2030):
        os.remove(f"{tmp}/in/socio_{year}.json")
    os.remove(f"{tmp}/in/socio_2023.json")  # has rows, though a column is missing
    with pytest.raises(ValueError, match="2 absent|4 absent|absent"):
        periods.load_periods(spark, *args, range(2019, 2025), {"a": "a", "b": "b"})


def test_period_ledger_of_payload_lines(spark, tmp):
    doc = '{"year": %d, "header": ["a"], "data": [%s]}\n'
    write(f"{tmp}/in/y=2020/x.json", doc % (2020, '["1"],["2"]') + "junk\n" + doc % (2020, '["3"]'))
    write(f"{tmp}/in/y=2021/x.json", doc % (2021, ""))
    write(f"{tmp}/in/y=2022/x.json", "{\n")
    ledger = periods.period_status(spark, f"{tmp}/in/y=*", r"y=(\d{4})",
                                   spark.range(2020, 2024), ["a"], "payload", per_line=True)
    assert {r.period: (r.status, r.n_docs, r.n_bad_docs, r.n_rows) for r in ledger.collect()} == {
        2020: ("loaded", 3, 1, 3), 2021: ("no rows", 1, 0, 0), 2022: ("corrupt", 1, 1, 0),
        2023: ("absent", 0, 0, 0)}


def test_versioned_replacement(spark, tmp, monkeypatch):
    base, view = f"{tmp}/t", "pf_versioned_view"
    first = sinks.replace_versioned(spark.range(3), base, view)
    reader = spark.table(view)
    assert reader.count() == 3

    def dies(*_):
        raise RuntimeError("lost before the switch")

    with monkeypatch.context() as m:  # written whole, not switched
        m.setattr(sinks, "_switch", dies)
        with pytest.raises(RuntimeError):
            sinks.replace_versioned(spark.range(7), base, view)
    assert spark.table(view).count() == 3
    with pytest.raises(Exception):  # fails while it is written
        sinks.replace_versioned(spark.range(4).select(F.raise_error(F.lit("x"))), base, view)
    assert spark.table(view).count() == 3
    sinks.replace_versioned(spark.range(5), base, view)
    assert spark.table(view).count() == 5
    for n in (6, 7, 8):
        last = sinks.replace_versioned(spark.range(n), base, view)
        assert len(os.listdir(base)) == 2 and spark.table(view).count() == n
    assert last > first and not os.path.exists(first)


def test_rolling_slices_prune_partitions(spark, tmp):
    days = spark.range(30).select((F.lit("2024-01-01").cast("date") + F.col("id").cast("int")).alias("day"), "id")
    days.write.partitionBy("day").parquet(f"{tmp}/t")
    t = spark.read.parquet(f"{tmp}/t")

    def scanned(df):
        assert sorted(str(r.day) for r in df.collect()) == ["2024-01-26", "2024-01-27", "2024-01-28"]
        plan = df._jdf.queryExecution().executedPlan()
        text = plan.toString()
        assert "PartitionFilters: [" in text and "day" in text.split("PartitionFilters")[1][:200]
        leaves = plan.collectLeaves()
        scan = leaves.apply(0)
        return scan.metrics().get("numFiles").get().value() if scan.metrics().contains("numFiles") else None

    literal = t.filter(fn.rolling_days("day", dt.date(2024, 1, 30), back=2, days=3))
    assert scanned(literal) in (3, None)
    assert len(literal.inputFiles()) == 30 or len(literal.inputFiles()) == 3
    run_date = t.agg(F.max("day")).scalar()
    assert scanned(t.filter(fn.rolling_days("day", run_date, back=2, days=3))) in (3, None)
    today = spark.range(1).select(F.current_date().alias("d")).filter(fn.rolling_days("d", None, back=0))
    assert today.count() == 1
    years = spark.createDataFrame([(2022,), (2023,)], "y int")
    assert [r.y for r in years.filter(fn.rolling_year("y", "2024-03-01", 1)).collect()] == [2023]


def test_panel_of_bucketed_facts_moves_no_rows_up_to_the_lag(spark, tmp):
    prices = spark.createDataFrame([(f"z{i % 40}", 2000 + i % 7, float(i)) for i in range(600)],
                                   "zip_code string, year int, price double")
    socio = prices.select("zip_code", F.col("year").alias("data_year"), F.lit("n").alias("NAME"),
                          *[F.col("price").cast("int").alias(m) for m in model.SOCIO_MEASURES])
    complaints = prices.select(F.col("zip_code").alias("incident_zip"),
                               F.make_timestamp_ntz("year", F.lit(3), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
                               .alias("created_date"), F.col("price").cast("string").alias("unique_key"),
                               F.lit("t").alias("complaint_type"))
    facts = (model.fct_price(prices), model.fct_socio(socio), model.fct_complaints_total(complaints))
    names = [f"pf_bucketed_{x}" for x in "psc"]
    for df, name in zip(facts, names):
        publish.write_bucketed(df, name, f"{tmp}/{name}", "zip_code", "year", buckets=4)
        assert len([f for f in os.listdir(f"{tmp}/{name}") if f.endswith(".parquet")]) <= 4
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lagged = publish.panel_of_tables(spark, *names, upto="lag")
        plan = lagged._jdf.queryExecution().executedPlan().toString()
        assert "Window" in plan and "SortMergeJoin" in plan and "Exchange" not in plan
        from panelforge.operators import panel
        want = panel.signals_panel(*facts, upto="lag")
        assert "Exchange" in want._jdf.queryExecution().executedPlan().toString()
        assert lagged.exceptAll(want).count() == 0 and lagged.count() == want.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in names:
            spark.sql(f"DROP TABLE {name}")
