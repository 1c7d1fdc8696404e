import datetime as dt

from pyspark.sql import functions as F

from panelforge.operators import analytics, model, quality
from panelforge.sources import sinks


def test_overwrite_slices_is_idempotent_and_local(spark, tmp):
    a = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "k int, day string")
    sinks.overwrite_slices(a, f"{tmp}/t", "day")
    b = spark.createDataFrame([(3, "2024-01-02")], "k int, day string")
    sinks.overwrite_slices(b, f"{tmp}/t", "day")
    sinks.overwrite_slices(b, f"{tmp}/t", "day")
    got = sorted((r.k, str(r.day)) for r in spark.read.parquet(f"{tmp}/t").collect())
    assert got == [(1, "2024-01-01"), (3, "2024-01-02")]


def test_tables_views_insert(spark, tmp):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    sinks.write_parquet(df, f"{tmp}/one", files=1)
    assert spark.read.parquet(f"{tmp}/one").count() == 1
    spark.sql(f"CREATE TABLE IF NOT EXISTS pf_t (k int, v string) USING parquet LOCATION '{tmp}/tbl'")
    sinks.insert_overwrite(df.select("v", "k"), "pf_t")
    sinks.insert_overwrite(df.select("v", "k"), "pf_t")
    assert [tuple(r) for r in spark.table("pf_t").collect()] == [(1, "a")]
    sinks.create_view(df, "pf_view")
    assert spark.sql("SELECT * FROM pf_view").count() == 1
    spark.sql("DROP TABLE pf_t")


def test_facts_distinct_count_trim_and_nulls(spark):
    ts = dt.datetime(2021, 5, 1)
    c = spark.createDataFrame([
        (1, ts, "Noise", " 10001 "), (1, ts, "Noise", "10001"), (2, ts, "Heat", "10001"),
        (3, None, "Noise", "10001"), (4, ts, None, "10001"), (5, ts, "Noise", None)],
        "unique_key bigint, created_date timestamp_ntz, complaint_type string, incident_zip string")
    total = {(r.zip_code, r.year): r.complaint_count for r in model.fct_complaints_total(c).collect()}
    assert total == {("10001", 2021): 3}      # keys 1,2,4; 3 has no date, 5 no zip
    by_type = {(r.complaint_type): r.complaint_count for r in model.fct_complaints_by_type(c).collect()}
    assert by_type == {"Noise": 1, "Heat": 1}
    # sum over types >= distinct total
    assert sum(by_type.values()) <= 3


def test_dim_entity_not_unique_and_dim_period(spark):
    p = spark.createDataFrame([("10001", "A", 2020), ("10001", "B", 2021), (None, "C", 2019)],
                              "zip_code string, city string, year int")
    p = p.withColumns({c: F.lit("x") for c in ["countyname", "metro", "state", "statename", "regiontype"]})
    assert model.dim_entity(p).count() == 2
    s = spark.createDataFrame([(2022,), (None,)], "data_year int")
    years = sorted(r.year for r in model.dim_period((p, "year"), (s, "data_year")).collect())
    assert years == [2019, 2020, 2021, 2022]


def test_socio_fact_rate_guard(spark):
    s = spark.createDataFrame([("1", 2020, "n", 5, 0, 1, 1, 1, 1), ("1", 2020, "m", 7, 0, 1, 1, 1, 1),
                               ("2", 2020, "n", 5, 1000, 1, 2, 3, 4)],
                              "zip_code string, data_year int, NAME string, median_income int, "
                              "total_pop_over_25 int, bachelors_degree int, masters_degree int, "
                              "professional_degree int, doctorate_degree int")
    got = {r.zip_code: r for r in model.fct_socio(s).collect()}
    assert got["1"].median_income == 7 and got["1"].area_name == "n"
    assert got["1"].higher_edu_count_per_1k_population is None
    assert got["2"].higher_edu_count_per_1k_population == 10.0


def test_quality_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 2)], "k string, y int")
    assert [tuple(r) for r in quality.grain_check(df, ["k", "y"]).collect()] == [("a", 1, 2)]
    assert [tuple(r) for r in quality.null_key_counts({"t": (df, "k")}).collect()] == [("t", 1)]
    m = quality.missingness(df, {"with_k": "k"}).collect()[0]
    assert (m.total_rows, m.with_k) == (4, 3)
    cnt = quality.table_counts({"x": df, "y": df.limit(1)}).collect()
    assert sorted(tuple(r) for r in cnt) == [("x", 4), ("y", 1)]
    per = quality.distinct_periods({"t": (df, "y")}).collect()
    assert [tuple(r) for r in per] == [("t", 1), ("t", 2)]
    cand = spark.createDataFrame([("a", 1), ("c", 3)], "k string, y int")
    assert [tuple(r) for r in quality.missing_periods(cand, df, ["k", "y"]).collect()] == [("c", 3)]


def test_load_counts_and_cap(spark):
    rows = [(i, dt.datetime(2024, 1, 1 + (i % 2), 12)) for i in range(5)]
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz")
    daily = [tuple(r) for r in quality.load_counts(df, "ts", "day").collect()]
    assert daily == [(dt.date(2024, 1, 1), 3), (dt.date(2024, 1, 2), 2)]
    yearly = [tuple(r) for r in quality.load_counts(df, "ts", "year").collect()]
    assert yearly == [(2024, 5)]
    cap = {r.day: r.at_cap for r in quality.cap_check(df, "ts", 3).collect()}
    assert cap == {dt.date(2024, 1, 1): True, dt.date(2024, 1, 2): False}
    twice = df.unionByName(df.filter(F.col("k") < 2))
    r = quality.overlap_dedup_counts(twice, "k", "ts").collect()[0]
    assert (r.raw_rows, r.distinct_keys) == (7, 5)


def test_analytics(spark):
    df = spark.createDataFrame([("a", 1, 5.0, 1), ("b", 1, 5.0, 2), ("c", 2, None, 3), ("d", 2, 9.0, None)],
                               "k string, y int, r double, inc int")
    top = [r.k for r in analytics.top_k(df, "r", 2, ["k", "y", "r"], ["k", "y"]).collect()]
    assert top == ["d", "a"]
    assert analytics.complete_cases(df, ["k"], ["r", "inc"]).count() == 2
    assert [r.k for r in analytics.preview(df, 2, ["k"]).collect()] == ["a", "b"]
    dist = analytics.distribution(df.fillna({"inc": 0}), "y", "k", "inc").collect()
    assert [(r.y, r.k, r.total_complaints) for r in dist][:2] == [(1, "b", 2), (1, "a", 1)]


def test_publish_model_writes_every_table_and_view(spark, tmp):
    from panelforge.operators.publish import publish_model
    from panelforge.plans import bindings as B
    sf = "/root/testdata/sf0.001"
    pub = publish_model(B.prices_long(spark, sf), B.socio(spark, sf), B.complaints(spark, sf),
                        f"{tmp}/model", view="pf_published")
    assert set(pub.tables) == {"dim_entity", "dim_category", "dim_period", "fct_price",
                               "fct_socio", "fct_complaints_total",
                               "fct_complaints_by_type", "signals_panel"}
    n = spark.table("pf_published").count()
    assert n == pub.read(spark, "signals_panel").count() > 0
    # re-publishing replaces, never appends
    publish_model(B.prices_long(spark, sf), B.socio(spark, sf), B.complaints(spark, sf),
                  f"{tmp}/model", view="pf_published")
    assert spark.read.parquet(pub.tables["signals_panel"]).count() == n


def test_require_rows(spark):
    import pytest
    df = spark.createDataFrame([(1,)], "a int")
    assert quality.require_rows(df, "x") is df
    with pytest.raises(ValueError):
        quality.require_rows(df.filter("a > 1"), "empty input")


def test_tolerant_parquet_load_refresh_and_replace_table(spark, tmp):
    from panelforge.sources import files
    spark.createDataFrame([(1,), (2,)], "a int").write.parquet(f"{tmp}/p")
    with open(f"{tmp}/p/part-99999-corrupt.parquet", "wb") as f:
        f.write(b"not a parquet file")
    schema = spark.createDataFrame([(1,)], "a int").schema
    assert files.read_parquet_tolerant(spark, f"{tmp}/p", schema).count() == 2
    files.refresh(spark, f"{tmp}/p")
    df = spark.createDataFrame([(1, "x")], "k int, v string")
    sinks.replace_table(df, "pf_replaced")
    sinks.replace_table(df.union(df), "pf_replaced")
    assert spark.table("pf_replaced").count() == 2
    spark.sql("DROP TABLE pf_replaced")
