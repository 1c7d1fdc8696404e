"""The signals panel on the hand-made fixture (FIXTURES.md §3)."""

import pytest
from pyspark.sql import functions as F

from panelforge.operators import panel

PRICE = [("A", 2020, 100.0), ("A", 2021, 110.0), ("A", 2023, 121.0),
         ("B", 2020, 200.0), ("B", 2021, 180.0),
         ("C", 2020, 300.0), ("C", 2021, 330.0), ("D", 2021, 50.0)]
POP = {("A", 2020): 1000, ("A", 2021): 1000, ("A", 2023): 1000,
       ("B", 2020): 2000, ("B", 2021): 2000, ("C", 2020): 0,
       ("C", 2021): 500, ("D", 2021): 100}
COMPLAINTS = [("A", 2020, 10), ("A", 2021, 20), ("A", 2023, 10),
              ("B", 2020, 10), ("B", 2021, 20), ("C", 2020, 5),
              ("C", 2021, 5)]


def facts(spark):
    price = spark.createDataFrame(PRICE, "zip_code string, year int, avg_home_price double")
    socio = spark.createDataFrame(
        [(z, y, 50000 + y, p, 1, 2, 3, 4, (10.0 / p * 1000) if p else None)
         for (z, y), p in POP.items()],
        "zip_code string, year int, median_income int, total_pop_over_25 int, "
        "bachelors_degree int, masters_degree int, professional_degree int, "
        "doctorate_degree int, higher_edu_count_per_1k_population double")
    comp = spark.createDataFrame(COMPLAINTS, "zip_code string, year int, complaint_count bigint")
    return price, socio, comp


def rows(df):
    return {(r["zip_code"], r["year"]): r.asDict() for r in df.collect()}


@pytest.mark.parametrize("method", ["aggregate", "window"])
def test_fixture_values(spark, method):
    p, s, c = facts(spark)
    out = rows(panel.signals_panel(p, s, c, mean_method=method))
    assert set(out) == {("A", 2020), ("A", 2021), ("A", 2023), ("B", 2020),
                        ("B", 2021), ("C", 2020), ("C", 2021)}  # D dropped (inner)
    a21, a23 = out[("A", 2021)], out[("A", 2023)]
    assert a21["complaints_per_1k_population"] == pytest.approx(20.0)
    assert a21["delta_p"] == pytest.approx(0.10)
    assert a21["delta_c"] == pytest.approx(1.0)
    assert a21["correlation_signal"] == pytest.approx(0.10)
    # row lag skips the missing 2022
    assert a23["delta_p"] == pytest.approx(0.10)
    assert a23["delta_c"] == pytest.approx(-0.5)
    assert a23["correlation_signal"] == pytest.approx(-0.05)
    assert out[("B", 2021)]["correlation_signal"] == pytest.approx(-0.10)
    assert out[("C", 2020)]["complaints_per_1k_population"] is None
    c21 = out[("C", 2021)]
    assert c21["delta_p"] == pytest.approx(0.10)
    assert c21["delta_c"] is None and c21["correlation_signal"] is None
    for k in [("A", 2020), ("B", 2020), ("C", 2020)]:
        assert out[k]["delta_p"] is None and out[k]["correlation_signal"] is None
    assert a21["city_avg_delta_p"] == pytest.approx(0.1 / 3)
    assert a21["city_avg_delta_c"] == pytest.approx(1.0)
    assert a21["adjusted_delta_p"] == pytest.approx(0.2 / 3)
    assert a21["adjusted_delta_c"] == pytest.approx(0.0)
    assert a21["adjusted_correlation_signal"] == pytest.approx(0.0)
    # a period where every delta is NULL has a NULL mean
    assert out[("A", 2020)]["city_avg_delta_p"] is None
    assert list(panel.signals_panel(p, s, c).columns) == panel.PANEL_COLUMNS
    assert len(panel.PANEL_COLUMNS) == 30


def test_calendar_lag_is_null_across_gap(spark):
    p, s, c = facts(spark)
    out = rows(panel.signals_panel(p, s, c, lag_mode="calendar"))
    assert out[("A", 2023)]["prev_avg_home_price"] is None
    assert out[("A", 2023)]["delta_p"] is None
    assert out[("A", 2021)]["delta_p"] == pytest.approx(0.10)


def test_left_join_makes_coalesce_live(spark):
    p, s, c = facts(spark)
    out = rows(panel.signals_panel(p, s, c, how="left"))
    d = out[("D", 2021)]
    assert d["total_complaint_count"] == 0
    assert d["complaints_per_1k_population"] == pytest.approx(0.0)


def test_window_and_aggregate_means_agree(spark):
    p, s, c = facts(spark)
    w = rows(panel.signals_panel(p, s, c, mean_method="window"))
    a = rows(panel.signals_panel(p, s, c, mean_method="aggregate"))
    assert w.keys() == a.keys()
    for k in w:
        for col in panel.PANEL_COLUMNS:
            x, y = w[k][col], a[k][col]
            assert (x is None and y is None) or x == pytest.approx(y), (k, col)


def test_adjusted_mean_is_zero_per_period(spark):
    p, s, c = facts(spark)
    df = panel.signals_panel(p, s, c)
    for r in df.groupBy("year").agg(F.avg("adjusted_delta_p").alias("m")).collect():
        assert r["m"] is None or abs(r["m"]) < 1e-12


def test_row_lag_equals_calendar_lag_without_gaps(spark):
    p, s, c = facts(spark)
    p = p.filter(~((F.col("zip_code") == "A") & (F.col("year") == 2023)))
    r = rows(panel.signals_panel(p, s, c, lag_mode="row"))
    k = rows(panel.signals_panel(p, s, c, lag_mode="calendar"))
    for key in r:
        assert r[key]["prev_avg_home_price"] == k[key]["prev_avg_home_price"]


def test_zero_and_negative_prev(spark):
    df = spark.createDataFrame([("A", 2020, 0.0), ("A", 2021, 5.0), ("B", 2020, -10.0), ("B", 2021, -5.0)],
                               "zip_code string, year int, x double")
    out = panel.lag_metrics(df, {"x": "prev_x"})
    out = panel.add_relative_changes(out, {"d": "x"}, {"x": "prev_x"})
    got = {(r.zip_code, r.year): r.d for r in out.collect()}
    assert got[("A", 2021)] is None          # prev 0 -> guarded
    assert got[("B", 2021)] == pytest.approx(-0.5)  # negative prev passes the guard


def test_plan_has_no_python_udf(spark):
    p, s, c = facts(spark)
    plan = panel.signals_panel(p, s, c)._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_checkpointed_panel_equals_lazy_panel(spark):
    p, s, c = facts(spark)
    lazy = rows(panel.signals_panel(p, s, c))
    cut = panel.signals_panel(p, s, c, checkpoint=True)
    assert "Scan ExistingRDD" in cut._jdf.queryExecution().executedPlan().toString() or \
        "LogicalRDD" in cut._jdf.queryExecution().optimizedPlan().toString()
    got = rows(cut)
    assert got.keys() == lazy.keys()
    for k in got:
        for col in panel.PANEL_COLUMNS:
            x, y = got[k][col], lazy[k][col]
            assert (x is None and y is None) or x == pytest.approx(y), (k, col)


def test_calendar_lag_for_month_and_day_periods(spark):
    import datetime as dt
    rows = [("A", dt.date(2020, 1, 1), 1.0), ("A", dt.date(2020, 2, 1), 2.0),
            ("A", dt.date(2020, 4, 1), 4.0), ("B", dt.date(2019, 12, 1), 5.0),
            ("B", dt.date(2020, 1, 1), 6.0)]
    df = spark.createDataFrame(rows, "zip_code string, year date, x double")
    got = {(r.zip_code, r.year): r.prev_x for r in
           panel.lag_metrics(df, {"x": "prev_x"}, mode="calendar").collect()}
    assert got[("A", dt.date(2020, 2, 1))] == 1.0
    assert got[("A", dt.date(2020, 4, 1))] is None      # March missing
    assert got[("B", dt.date(2020, 1, 1))] == 5.0       # across the year end
    days = spark.createDataFrame([("A", dt.date(2020, 2, 28), 1.0), ("A", dt.date(2020, 2, 29), 2.0),
                                  ("A", dt.date(2020, 3, 2), 3.0)], "zip_code string, year date, x double")
    got = {r.year: r.prev_x for r in
           panel.lag_metrics(days, {"x": "prev_x"}, mode="calendar", unit="day").collect()}
    assert got[dt.date(2020, 2, 29)] == 1.0 and got[dt.date(2020, 3, 2)] is None
