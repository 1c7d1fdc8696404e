"""Property tests (random inputs) for the invariants of the panel model."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelforge.operators import model, panel, reshape

SETTINGS = dict(max_examples=12, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])

cells = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]),
                           st.sampled_from(["2020-01-31", "2020-02-29", "2020-03-31"]),
                           st.one_of(st.none(), st.integers(-50, 50).map(float))),
                 min_size=1, max_size=20, unique_by=lambda t: (t[0], t[1]))


@settings(**SETTINGS)
@given(cells)
def test_unpivot_after_pivot_is_identity_on_known_cells(spark, rows):
    long = spark.createDataFrame(rows, "k string, p string, v double")
    wide = reshape.pivot_periods(long, ["k"], "p", "v",
                                 ["2020-01-31", "2020-02-29", "2020-03-31"], "first")
    back = reshape.unpivot_periods(wide, ["k"], value_col="v").filter(F.col("v").isNotNull())
    got = sorted((r.k, r.date_str, float(r.v)) for r in back.collect())
    assert got == sorted((k, p, v) for k, p, v in rows if v is not None)


complaints = st.lists(st.tuples(st.integers(0, 30), st.sampled_from(["z1", "z2", " z1 "]),
                                st.sampled_from(["A", "B", "C"]), st.integers(2019, 2021)),
                      min_size=1, max_size=40)


@settings(**SETTINGS)
@given(complaints)
def test_by_type_counts_cover_total(spark, rows):
    df = spark.createDataFrame(
        [(k, dt.datetime(y, 6, 1), t, z) for k, z, t, y in rows],
        "unique_key bigint, created_date timestamp_ntz, complaint_type string, incident_zip string")
    total = {(r.zip_code, r.year): r.complaint_count
             for r in model.fct_complaints_total(df).collect()}
    by_type = {}
    for r in model.fct_complaints_by_type(df).collect():
        by_type[(r.zip_code, r.year)] = by_type.get((r.zip_code, r.year), 0) + r.complaint_count
    assert total.keys() == by_type.keys()
    for key, n in total.items():
        assert by_type[key] >= n
        expect = len({k for k, z, t, y in rows if (z.strip(), y) == key})
        assert n == expect


panels = st.lists(st.tuples(st.sampled_from(["e1", "e2", "e3", "e4"]), st.integers(2015, 2020),
                            st.floats(1, 1000), st.integers(0, 3000), st.integers(0, 50)),
                  min_size=2, max_size=24, unique_by=lambda t: (t[0], t[1]))


def _facts(spark, rows):
    price = spark.createDataFrame([(e, y, p) for e, y, p, _, _ in rows],
                                  "zip_code string, year int, avg_home_price double")
    socio = spark.createDataFrame(
        [(e, y, 1000 + y, pop, 1, 1, 1, 1, (4.0 / pop * 1000) if pop else None)
         for e, y, _, pop, _ in rows],
        "zip_code string, year int, median_income int, total_pop_over_25 int, "
        "bachelors_degree int, masters_degree int, professional_degree int, "
        "doctorate_degree int, higher_edu_count_per_1k_population double")
    comp = spark.createDataFrame([(e, y, n) for e, y, _, _, n in rows],
                                 "zip_code string, year int, complaint_count bigint")
    return price, socio, comp


@settings(**SETTINGS)
@given(panels)
def test_mean_forms_agree_and_adjusted_means_vanish(spark, rows):
    p, s, c = _facts(spark, rows)
    agg = {(r.zip_code, r.year): r for r in panel.signals_panel(p, s, c).collect()}
    win = {(r.zip_code, r.year): r for r in
           panel.signals_panel(p, s, c, mean_method="window").collect()}
    assert agg.keys() == win.keys() == {(e, y) for e, y, *_ in rows}
    for k in agg:
        for col in ("city_avg_delta_p", "adjusted_delta_c", "adjusted_correlation_signal"):
            a, b = agg[k][col], win[k][col]
            assert (a is None and b is None) or abs(a - b) <= 1e-9 * max(1.0, abs(a))
    by_year = {}
    for r in agg.values():
        if r.adjusted_delta_p is not None:
            by_year.setdefault(r.year, []).append(r.adjusted_delta_p)
    for vals in by_year.values():
        assert abs(sum(vals) / len(vals)) < 1e-6


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.sampled_from(["e1", "e2"]), st.floats(1, 100)), min_size=1, max_size=6))
def test_row_lag_equals_calendar_lag_without_gaps(spark, vals):
    rows, seen = [], {}
    for e, v in vals:                       # consecutive years per entity
        y = 2000 + seen.get(e, 0)
        seen[e] = seen.get(e, 0) + 1
        rows.append((e, y, v))
    df = spark.createDataFrame(rows, "zip_code string, year int, x double")
    r = {(a.zip_code, a.year): a.prev_x for a in panel.lag_metrics(df, {"x": "prev_x"}).collect()}
    k = {(a.zip_code, a.year): a.prev_x
         for a in panel.lag_metrics(df, {"x": "prev_x"}, mode="calendar").collect()}
    assert r == k
