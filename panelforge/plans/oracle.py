"""Independent SQL oracle (DuckDB dialect) for every registered query.

The bindings are re-stated as CTEs over the raw test tables and every model
step is written directly in SQL, so a query is checked against a separate
formulation rather than against itself.  Integer-typed outputs are cast to the
Spark types (DuckDB's YEAR is BIGINT, SUM of BIGINT is HUGEINT); computed
doubles are rounded to 6 decimals like the Spark side.
"""

from __future__ import annotations

PRICES = """prices AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS RegionID,
         CAST(n.n_regionkey AS VARCHAR) AS SizeRank,
         CAST(c.c_nationkey AS VARCHAR) AS zip_code,
         'nation' AS regiontype, r.r_name AS statename,
         CAST(n.n_regionkey AS VARCHAR) AS state, n.n_name AS city,
         r.r_name AS metro, c.c_mktsegment AS countyname,
         o.o_totalprice AS price, CAST(o.o_orderdate AS DATE) AS date,
         CAST(YEAR(o.o_orderdate) AS INTEGER) AS year,
         CAST(MONTH(o.o_orderdate) AS INTEGER) AS month,
         n.n_nationkey, n.n_regionkey, n.n_name, r.r_name, o.o_custkey,
         o.o_orderdate
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""

LINES = """lines AS (
  SELECT l.*, s.s_name, s.s_nationkey
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey)"""

def _socio_rows(*keys: str) -> str:
    """Socio rows of the lines with the given key columns."""
    return """SELECT s_name AS NAME,
         CAST(FLOOR(l_extendedprice) AS INTEGER) AS median_income,
         CAST(l_partkey AS INTEGER) AS total_pop_over_25,
         CAST(l_linenumber AS INTEGER) AS bachelors_degree,
         CAST(FLOOR(l_quantity) AS INTEGER) AS masters_degree,
         CAST(l_suppkey AS INTEGER) AS professional_degree,
         CAST(1 AS INTEGER) AS doctorate_degree,
         """ + ", ".join(keys) + " FROM lines"


def _socio_fact(source: str, key: str, period: str, out: str, out_period: str) -> str:
    """The socio fact of ``source``: largest measures per key and period."""
    measures = ["median_income", "total_pop_over_25", "bachelors_degree",
                "masters_degree", "professional_degree", "doctorate_degree"]
    return f"""SELECT TRIM({key}) AS {out}, {period} AS {out_period},
         MAX(NAME) AS area_name, {", ".join(f"MAX({m}) AS {m}" for m in measures)},
         IF(MAX(total_pop_over_25) > 0,
            (MAX(bachelors_degree) + MAX(masters_degree)
             + MAX(professional_degree) + MAX(doctorate_degree))
            / MAX(total_pop_over_25) * 1000, NULL)
           AS higher_edu_count_per_1k_population
  FROM {source}
  WHERE {key} IS NOT NULL AND {period} IS NOT NULL
  GROUP BY TRIM({key}), {period}"""


_SOCIO_KEYS = ("CAST(s_nationkey AS VARCHAR) AS zip_code",
               "CAST(YEAR(l_shipdate) AS INTEGER) AS data_year")
SOCIO = LINES + ",\nsocio AS (" + _socio_rows(*_SOCIO_KEYS) + ")"

COMPLAINTS = """cmp AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) AS unique_key,
         l.l_shipdate AS created_date,
         l.l_returnflag || l.l_linestatus AS complaint_type,
         CASE WHEN l.l_linenumber = 7 THEN NULL
              ELSE CAST(s.s_nationkey AS VARCHAR) END AS incident_zip,
         l.l_returnflag AS community_board, s.s_name AS borough
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  WHERE l.l_returnflag IS NOT NULL AND l.l_returnflag <> 'N')"""

FACTS = """fp AS (
  SELECT TRIM(zip_code) AS zip_code, year, AVG(price) AS avg_home_price
  FROM prices
  WHERE zip_code IS NOT NULL AND year IS NOT NULL AND price IS NOT NULL
  GROUP BY ALL),
fs AS (""" + _socio_fact("socio", "zip_code", "data_year", "zip_code", "year") + """),
ft AS (
  SELECT TRIM(incident_zip) AS zip_code,
         CAST(YEAR(created_date) AS INTEGER) AS year,
         COUNT(DISTINCT unique_key) AS complaint_count
  FROM cmp
  WHERE incident_zip IS NOT NULL AND created_date IS NOT NULL
  GROUP BY ALL),
fbt AS (
  SELECT TRIM(incident_zip) AS zip_code,
         CAST(YEAR(created_date) AS INTEGER) AS year, complaint_type,
         COUNT(DISTINCT unique_key) AS complaint_count
  FROM cmp
  WHERE incident_zip IS NOT NULL AND created_date IS NOT NULL
    AND complaint_type IS NOT NULL
  GROUP BY ALL)"""

WITH_FACTS = f"WITH {PRICES},\n{SOCIO},\n{COMPLAINTS},\n{FACTS}"

# Panel stages.  j: joined facts; r: + rate; g: + lags; d: + changes;
# s: + signal; m: + period means; a: + demeaned; x: + adjusted signal.
_STAGES = """,
j AS (
  SELECT p.zip_code, p.year, p.avg_home_price, s.median_income,
         s.total_pop_over_25, s.bachelors_degree, s.masters_degree,
         s.professional_degree, s.doctorate_degree,
         s.higher_edu_count_per_1k_population,
         COALESCE(t.complaint_count, 0) AS total_complaint_count
  FROM fp p
  JOIN fs s USING (zip_code, year)
  JOIN ft t USING (zip_code, year)),
r AS (
  SELECT *, IF(total_pop_over_25 > 0,
               total_complaint_count / total_pop_over_25 * 1000, NULL)
              AS complaints_per_1k_population
  FROM j),
g AS (
  SELECT *,
    LAG(avg_home_price) OVER w AS prev_avg_home_price,
    LAG(complaints_per_1k_population) OVER w
      AS prev_complaints_per_1k_population,
    LAG(median_income) OVER w AS prev_median_income,
    LAG(higher_edu_count_per_1k_population) OVER w
      AS prev_higher_edu_count_per_1k_population
  FROM r
  WINDOW w AS (PARTITION BY zip_code ORDER BY year)),
d AS (
  SELECT *,
    (avg_home_price - prev_avg_home_price)
      / NULLIF(prev_avg_home_price, 0) AS delta_p,
    (complaints_per_1k_population - prev_complaints_per_1k_population)
      / NULLIF(prev_complaints_per_1k_population, 0) AS delta_c,
    (median_income - prev_median_income)
      / NULLIF(prev_median_income, 0) AS delta_income,
    (higher_edu_count_per_1k_population
       - prev_higher_edu_count_per_1k_population)
      / NULLIF(prev_higher_edu_count_per_1k_population, 0) AS delta_edu
  FROM g),
s AS (SELECT *, delta_p * delta_c AS correlation_signal FROM d),
m AS (
  SELECT *,
    AVG(delta_p) OVER y AS city_avg_delta_p,
    AVG(delta_c) OVER y AS city_avg_delta_c,
    AVG(delta_income) OVER y AS city_avg_delta_income,
    AVG(delta_edu) OVER y AS city_avg_delta_edu
  FROM s
  WINDOW y AS (PARTITION BY year)),
a AS (
  SELECT *,
    delta_p - city_avg_delta_p AS adjusted_delta_p,
    delta_c - city_avg_delta_c AS adjusted_delta_c,
    delta_income - city_avg_delta_income AS adjusted_delta_income,
    delta_edu - city_avg_delta_edu AS adjusted_delta_edu
  FROM m),
x AS (SELECT *, adjusted_delta_p * adjusted_delta_c
               AS adjusted_correlation_signal FROM a)
"""


def panel_stages(entity: str = "zip_code", period: str = "year") -> str:
    """The panel CTEs j..x over facts fp/fs/ft keyed by (entity, period)."""
    return _STAGES.replace("zip_code", entity).replace("year", period)


PANEL = WITH_FACTS + panel_stages()

_R = "ROUND({0}, 6) AS {0}"

PANEL_DOUBLES = [
    "avg_home_price", "higher_edu_count_per_1k_population",
    "complaints_per_1k_population", "prev_avg_home_price",
    "prev_complaints_per_1k_population",
    "prev_higher_edu_count_per_1k_population", "delta_p", "delta_c",
    "delta_income", "delta_edu", "correlation_signal", "city_avg_delta_p",
    "city_avg_delta_c", "city_avg_delta_income", "city_avg_delta_edu",
    "adjusted_delta_p", "adjusted_delta_c", "adjusted_delta_income",
    "adjusted_delta_edu", "adjusted_correlation_signal",
]


# Number of PANEL_DOUBLES present after each stage (the list is in the order
# the stages add them; prev_median_income is an integer).
_DOUBLES_AT = {"j": 2, "r": 3, "g": 6, "d": 10, "s": 11, "m": 15, "a": 19,
               "x": 20}


def _rounded(stage: str) -> str:
    """SELECT * from a panel stage with every double rounded."""
    cols = PANEL_DOUBLES[:_DOUBLES_AT[stage]]
    return (f"SELECT * REPLACE ({', '.join(_R.format(c) for c in cols)}) "
            f"FROM {stage}")


def _panel(stage: str) -> str:
    return PANEL + _rounded(stage)


FULL_PANEL = PANEL + ", final AS (" + _rounded("x") + ")\n"

SQL: dict[str, str] = {}

# ---------------------------------------------------------------- sources --

SQL["json_matrix"] = """
SELECT c_custkey, c_name, c_nationkey,
       ROUND(CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END, 6)
         AS c_acctbal,
       c_mktsegment
FROM customer"""

_POP = """
SELECT CAST(c_nationkey AS VARCHAR) AS zip_code, n_name AS NAME,
       CAST(COUNT(DISTINCT o_custkey) AS INTEGER) AS total_population,
       CAST(YEAR(o_orderdate) AS INTEGER) AS data_year
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY c_nationkey, n_name, YEAR(o_orderdate)"""
SQL["json_payload"] = _POP
SQL["population_clean"] = _POP

SQL["load_by_name"] = f"WITH {SOCIO}\nSELECT * FROM socio"

_K = "json_extract_string(props, '$.k')"
SQL["reject_split"] = f"""
WITH raw AS (
  SELECT event_type,
         CASE WHEN event_type = 'error' THEN {_K} || 'x' ELSE {_K} END AS k
  FROM events),
typed AS (
  SELECT event_type,
         CASE WHEN regexp_full_match(trim(k), '[+-]?[0-9]+')
              THEN TRY_CAST(trim(k) AS INTEGER) END AS k_int, k
  FROM raw)
SELECT CASE WHEN k IS NOT NULL AND k_int IS NULL THEN 'rejected'
            ELSE 'accepted' END AS status,
       event_type, COUNT(*) AS n_rows,
       CAST(SUM(k_int) AS BIGINT) AS sum_k
FROM typed GROUP BY ALL"""

SQL["paged_union"] = """
WITH paged AS (
  SELECT event_id, event_type,
         UNNEST(list_distinct([event_id // 1000,
                               greatest(event_id - 50, 0) // 1000])) AS page
  FROM events)
SELECT event_type, COUNT(*) AS paged_rows,
       COUNT(DISTINCT event_id) AS unique_rows
FROM paged GROUP BY event_type"""

SQL["day_slice"] = """
SELECT event_type AS complaint_type, COUNT(*) AS n_rows FROM events
WHERE CAST(ts AS DATE) = DATE '2024-01-15'
GROUP BY 1"""

SQL["year_slice"] = f"""WITH {COMPLAINTS}
SELECT complaint_type, COUNT(*) AS n_rows FROM cmp
WHERE YEAR(created_date) = 1997
GROUP BY 1"""

SQL["cap_check"] = """
SELECT CAST(ts AS DATE) AS day, COUNT(*) AS n_rows, COUNT(*) >= 350 AS at_cap
FROM events GROUP BY 1"""

_ASIA = """
SELECT c_custkey, c_name, c_nationkey FROM customer
WHERE c_nationkey IN (SELECT n_nationkey FROM nation JOIN region
                      ON n_regionkey = r_regionkey WHERE r_name = 'ASIA')"""
SQL["allowlist_semi"] = _ASIA
SQL["allowlist_isin"] = _ASIA

SQL["missing_periods"] = f"""WITH {PRICES},
{COMPLAINTS}
SELECT DISTINCT TRIM(incident_zip) AS zip_code,
       CAST(YEAR(created_date) AS INTEGER) AS year,
       CAST(MONTH(created_date) AS INTEGER) AS month
FROM cmp
WHERE incident_zip IS NOT NULL AND created_date IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM prices p
                  WHERE p.zip_code = TRIM(cmp.incident_zip)
                    AND p.year = YEAR(cmp.created_date)
                    AND p.month = MONTH(cmp.created_date))"""

_INT_OK = "CASE WHEN regexp_full_match(trim({0}), '[+-]?[0-9]+') " \
          "THEN TRY_CAST(trim({0}) AS INTEGER) END"
SQL["safe_cast"] = f"""
WITH raw AS (
  SELECT event_id, event_type,
         CASE event_type WHEN 'error' THEN {_K} || '.5'
                         WHEN 'view' THEN ' ' || {_K} || ' '
                         WHEN 'signup' THEN '+' || {_K}
                         WHEN 'click' THEN 'n/a'
                         ELSE {_K} END AS raw_int,
         CASE WHEN event_type = 'click' THEN '' ELSE {_K} || '.25' END AS raw_dbl
  FROM events)
SELECT event_id, {_INT_OK.format('raw_int')} AS k_int,
       ROUND(TRY_CAST(raw_dbl AS DOUBLE), 6) AS k_double,
       {_INT_OK.format('event_type')} AS type_int
FROM raw"""

# ----------------------------------------------------------- reshape/clean --

_MONTHLY = f"""WITH {PRICES},
monthly AS (
  SELECT n_nationkey, n_regionkey, n_name, r_name,
         last_day(CAST(o_orderdate AS DATE)) AS month_end,
         COUNT(*) AS n, AVG(price) AS avg_price
  FROM prices GROUP BY ALL)"""

SQL["unpivot_months"] = _MONTHLY + """
SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS zip_code,
       month_end AS date, ROUND(avg_price, 6) AS price
FROM monthly
WHERE n > 1"""

SQL["prices_clean"] = _MONTHLY + """
SELECT CAST(n_nationkey AS VARCHAR) AS RegionID,
       CAST(n_regionkey AS VARCHAR) AS SizeRank,
       lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS zip_code,
       'nation' AS regiontype, r_name AS statename,
       CAST(n_regionkey AS VARCHAR) AS state, n_name AS city,
       r_name AS metro, r_name AS countyname,
       ROUND(avg_price, 6) AS price, month_end AS date,
       CAST(YEAR(month_end) AS INTEGER) AS year,
       CAST(MONTH(month_end) AS INTEGER) AS month
FROM monthly
WHERE n > 1 AND n_nationkey BETWEEN 0 AND 19"""

SQL["union_by_name"] = f"WITH {LINES}\n" + _socio_rows(
    *_SOCIO_KEYS, "CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_linestatus END "
                  "AS linestatus")

SQL["complaints_clean"] = f"WITH {COMPLAINTS}\nSELECT * FROM cmp"

SQL["socio_clean"] = f"WITH {SOCIO}\nSELECT * FROM socio"

# ---------------------------------------------------------- dims and facts --

SQL["dim_entity"] = f"""WITH {PRICES}
SELECT DISTINCT TRIM(zip_code) AS zip_code, city, countyname, metro, state,
       statename, regiontype
FROM prices WHERE zip_code IS NOT NULL"""

SQL["dim_category"] = f"""WITH {COMPLAINTS}
SELECT DISTINCT complaint_type FROM cmp WHERE complaint_type IS NOT NULL"""

SQL["dim_period"] = f"""WITH {PRICES},
{SOCIO},
{COMPLAINTS}
SELECT year FROM (
  SELECT year FROM prices
  UNION SELECT data_year FROM socio
  UNION SELECT CAST(YEAR(created_date) AS INTEGER) FROM cmp) u
WHERE year IS NOT NULL"""

SQL["fct_price"] = WITH_FACTS + "\nSELECT zip_code, year, " \
    "ROUND(avg_home_price, 6) AS avg_home_price FROM fp"
SQL["fct_socio"] = WITH_FACTS + "\nSELECT * REPLACE (" \
    "ROUND(higher_edu_count_per_1k_population, 6) AS " \
    "higher_edu_count_per_1k_population) FROM fs"
SQL["fct_complaints_total"] = WITH_FACTS + "\nSELECT * FROM ft"
SQL["fct_complaints_by_type"] = WITH_FACTS + "\nSELECT * FROM fbt"

# ------------------------------------------------------------------ panel --

SQL["panel_join"] = _panel("j")
SQL["rate_per_k"] = _panel("r")
SQL["lag_metrics"] = _panel("g")
SQL["relative_change"] = _panel("d")
SQL["signal_product"] = _panel("s")
SQL["period_mean"] = _panel("m")
SQL["demean"] = _panel("a")
SQL["adjusted_signal"] = _panel("x")
SQL["signals_panel"] = _panel("x")
SQL["signals_view"] = _panel("x")
SQL["published_panel"] = _panel("x")
SQL["preview"] = FULL_PANEL + "SELECT * FROM final ORDER BY zip_code, year LIMIT 50"

_MONTH = "CAST(date_trunc('month', {0}) AS DATE)"
SQL["signals_panel_monthly"] = f"""WITH {LINES},
sp AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS entity, {_MONTH.format('l_shipdate')} AS period,
         CAST(FLOOR(l_extendedprice) AS DOUBLE) AS price
  FROM lines),
fp AS (
  SELECT TRIM(entity) AS entity, period, AVG(price) AS avg_home_price
  FROM sp WHERE entity IS NOT NULL AND period IS NOT NULL AND price IS NOT NULL
  GROUP BY ALL),
ss AS ({_socio_rows("CAST(l_suppkey AS VARCHAR) AS entity",
                     _MONTH.format("l_shipdate") + " AS period")}),
fs AS ({_socio_fact("ss", "entity", "period", "entity", "period")}),
cm AS (
  SELECT l_orderkey AS unique_key, l_shipdate AS created_date,
         CASE WHEN l_linenumber = 7 THEN NULL
              ELSE CAST(l_suppkey AS VARCHAR) END AS incident_zip
  FROM lines WHERE l_returnflag IS NOT NULL AND l_returnflag <> 'N'),
ft AS (
  SELECT TRIM(incident_zip) AS entity,
         {_MONTH.format('created_date')} AS period,
         COUNT(DISTINCT unique_key) AS complaint_count
  FROM cm WHERE incident_zip IS NOT NULL AND created_date IS NOT NULL
  GROUP BY ALL){panel_stages("entity", "period")}""" + _rounded("x")

SQL["stream_daily_counts"] = """
SELECT CAST(ts AS DATE) AS load_date, COUNT(*) AS daily_count
FROM (SELECT ts FROM events
      UNION ALL
      SELECT ts FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15') u
GROUP BY 1"""

SQL["stream_ingest"] = """
SELECT DISTINCT CAST(event_id AS VARCHAR) AS unique_key, ts AS created_date,
       event_type AS complaint_type, CAST(user_id AS VARCHAR) AS incident_zip,
       event_type AS community_board, 'events' AS borough,
       CAST(ts AS DATE) AS day
FROM events"""

# ------------------------------------------------------ quality/analytics --

SQL["grain_check"] = FULL_PANEL + """
SELECT zip_code, year, COUNT(*) AS row_count FROM final
GROUP BY ALL HAVING COUNT(*) > 1 ORDER BY row_count DESC"""

SQL["table_counts"] = FULL_PANEL + """
SELECT 'fct_price' AS table_name, COUNT(*) AS row_count FROM fp
UNION ALL SELECT 'fct_socio', COUNT(*) FROM fs
UNION ALL SELECT 'fct_complaints_total', COUNT(*) FROM ft
UNION ALL SELECT 'fct_complaints_by_type', COUNT(*) FROM fbt
UNION ALL SELECT 'signals_panel', COUNT(*) FROM final"""

SQL["missingness"] = FULL_PANEL + """
SELECT COUNT(*) AS total_rows, COUNT(avg_home_price) AS rows_with_price,
       COUNT(median_income) AS rows_with_income,
       COUNT(total_pop_over_25) AS rows_with_population,
       COUNT(complaints_per_1k_population) AS rows_with_complaint_rate
FROM final"""

SQL["top_rate"] = FULL_PANEL + """
SELECT zip_code, year, total_complaint_count, total_pop_over_25,
       complaints_per_1k_population
FROM final WHERE complaints_per_1k_population IS NOT NULL
ORDER BY complaints_per_1k_population DESC, zip_code, year LIMIT 20"""

SQL["corr_extract"] = FULL_PANEL + """
SELECT zip_code, year, avg_home_price, median_income,
       higher_edu_count_per_1k_population, total_complaint_count,
       complaints_per_1k_population
FROM final
WHERE avg_home_price IS NOT NULL AND complaints_per_1k_population IS NOT NULL
  AND median_income IS NOT NULL"""

SQL["type_distribution"] = WITH_FACTS + """
SELECT year, complaint_type, CAST(SUM(complaint_count) AS BIGINT)
       AS total_complaints
FROM fbt GROUP BY ALL ORDER BY year, total_complaints DESC"""

SQL["staging_counts"] = f"""WITH {PRICES},
{SOCIO},
{COMPLAINTS}
SELECT 'complaints' AS table_name, COUNT(*) AS row_count FROM cmp
UNION ALL SELECT 'socio', COUNT(*) FROM socio
UNION ALL SELECT 'prices', COUNT(*) FROM prices"""

SQL["null_key_counts"] = f"""WITH {PRICES},
{SOCIO},
{COMPLAINTS}
SELECT 'complaints' AS table_name,
       COUNT(*) FILTER (WHERE incident_zip IS NULL) AS null_keys FROM cmp
UNION ALL SELECT 'socio', COUNT(*) FILTER (WHERE zip_code IS NULL) FROM socio
UNION ALL SELECT 'prices', COUNT(*) FILTER (WHERE zip_code IS NULL) FROM prices"""

SQL["distinct_periods"] = f"""WITH {PRICES},
{SOCIO},
{COMPLAINTS}
SELECT DISTINCT 'complaints' AS source,
       CAST(YEAR(created_date) AS INTEGER) AS year FROM cmp
UNION ALL SELECT DISTINCT 'socio', data_year FROM socio
UNION ALL SELECT DISTINCT 'prices', year FROM prices
ORDER BY source, year NULLS LAST"""

SQL["daily_load_counts"] = """
SELECT CAST(ts AS DATE) AS load_date, COUNT(*) AS daily_count
FROM events GROUP BY 1 ORDER BY 1"""

SQL["yearly_load_counts"] = f"""WITH {COMPLAINTS}
SELECT CAST(YEAR(created_date) AS INTEGER) AS load_year,
       COUNT(*) AS yearly_count
FROM cmp GROUP BY 1 ORDER BY 1"""

SQL["full_load_dedup"] = f"""WITH {COMPLAINTS},
loaded AS (
  SELECT * FROM cmp
  UNION ALL
  SELECT * FROM cmp
  WHERE YEAR(created_date) = 1997 AND MONTH(created_date) = 6)
SELECT CAST(YEAR(created_date) AS INTEGER) AS year, COUNT(*) AS raw_rows,
       COUNT(DISTINCT unique_key) AS distinct_keys
FROM loaded WHERE created_date IS NOT NULL GROUP BY 1"""


# ------------------------------------------------ files, streams, switches --

SQL["csv_complaints"] = SQL["complaints_clean"]
SQL["csv_prices"] = SQL["prices_clean"]

SQL["json_rejects"] = """
SELECT c_nationkey AS nation, CASE WHEN c_nationkey % 5 = 0 THEN 'corrupt'
       ELSE 'no rows' END AS problem, COUNT(DISTINCT c_custkey // 1000) AS n_docs
FROM customer WHERE c_nationkey % 5 IN (0, 1) GROUP BY ALL"""

SQL["page_merge"] = "SELECT DISTINCT event_id, event_type, user_id FROM events"

SQL["slice_glob"] = """
SELECT CASE WHEN DAY(ts) = 15 THEN 'again' ELSE event_type END AS event_type,
       COUNT(*) AS n_rows
FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-19'
GROUP BY 1"""

SQL["replaced_loads"] = f"""WITH {COMPLAINTS},
n AS (SELECT complaint_type, COUNT(DISTINCT unique_key) AS n_keys FROM cmp GROUP BY 1)
SELECT 'file' AS kind, complaint_type, -n_keys AS n_keys FROM n
UNION ALL SELECT 'table', complaint_type, -n_keys FROM n
UNION ALL SELECT 'insert', complaint_type, n_keys FROM n"""

SQL["stream_dedup"] = """
SELECT DISTINCT CAST(event_id AS VARCHAR) AS unique_key, ts AS created_date,
       event_type AS complaint_type, CAST(user_id AS VARCHAR) AS incident_zip,
       event_type AS community_board, 'events' AS borough
FROM events"""

SQL["stream_ingest_edge"] = """
WITH e AS (
  SELECT *, CASE WHEN event_id % 101 = 0 THEN NULL ELSE 'E' || event_id END AS k
  FROM events),
v AS (
  SELECT k AS unique_key,
         CASE WHEN k IS NOT NULL AND event_id % 89 = 0 THEN ts + INTERVAL 2 DAY
              WHEN k IS NOT NULL AND event_id % 77 = 0 THEN ts
              WHEN k IS NOT NULL AND event_id % 50 = 0 THEN ts + INTERVAL 1 DAY
              WHEN event_id % 97 = 0 THEN NULL ELSE ts END AS created_date,
         CASE WHEN k IS NOT NULL AND event_id % 89 = 0 THEN 'after reset'
              WHEN k IS NOT NULL AND event_id % 77 = 0 THEN 'copy'
              WHEN k IS NOT NULL AND event_id % 50 = 0 THEN 'moved'
              ELSE event_type END AS complaint_type,
         CAST(user_id AS VARCHAR) AS incident_zip, event_type AS community_board,
         'events' AS borough
  FROM e),
-- the stream that starts over reads every file again: rows without a key cannot
-- be told apart and are kept once more
twice AS (SELECT * FROM v UNION ALL SELECT * FROM v WHERE unique_key IS NULL)
SELECT *, CAST(created_date AS DATE) AS day FROM twice"""

SQL["panel_left_join"] = (WITH_FACTS + panel_stages()).replace(
    "  JOIN ft t USING (zip_code, year)),", "  LEFT JOIN ft0 t USING (zip_code, year)),") \
    .replace(",\nj AS (", """,
ft0 AS (SELECT zip_code, CAST(year + 1 AS INTEGER) AS year, complaint_count FROM ft),
j AS (""") + _rounded("r")

# A calendar lag is the row of exactly the year before, found by a join.
SQL["panel_calendar_lag"] = WITH_FACTS + panel_stages() + """,
rg AS (SELECT * REPLACE (CAST(CASE WHEN year >= 1997 THEN year + 1 ELSE year END AS INTEGER)
                         AS year) FROM r),
cal AS (
  SELECT c.*, q.avg_home_price AS prev_avg_home_price,
         q.complaints_per_1k_population AS prev_complaints_per_1k_population,
         q.median_income AS prev_median_income,
         q.higher_edu_count_per_1k_population
           AS prev_higher_edu_count_per_1k_population
  FROM rg c LEFT JOIN rg q ON q.zip_code = c.zip_code AND q.year = c.year - 1)
""" + _rounded("g").replace("FROM g", "FROM cal")

SQL["grain_check_lines"] = """
SELECT l_orderkey, l_quantity, COUNT(*) AS row_count FROM lineitem
GROUP BY ALL HAVING COUNT(*) > 1"""

SQL["preview_complaints"] = f"""WITH {COMPLAINTS}
SELECT * FROM cmp ORDER BY unique_key, created_date, complaint_type,
  incident_zip, borough LIMIT 10"""
SQL["preview_socio"] = f"""WITH {SOCIO}
SELECT * FROM socio ORDER BY ALL LIMIT 10"""
SQL["preview_prices"] = f"""WITH {PRICES}
SELECT RegionID, SizeRank, zip_code, regiontype, statename, state, city, metro,
       countyname, price, date, year, month
FROM prices ORDER BY zip_code, date, price, RegionID, countyname LIMIT 1000"""


SQL["versioned_replace"] = f"""WITH {COMPLAINTS}
SELECT complaint_type, -COUNT(DISTINCT unique_key) AS n_keys FROM cmp GROUP BY 1"""

SQL["tolerant_load"] = """
SELECT 'rows' AS what, event_type AS name, COUNT(*) AS n_rows,
       CAST(SUM(event_id) AS BIGINT) AS sum_id FROM events GROUP BY ALL
UNION ALL SELECT 'unreadable', 'kind=spoilt', 0, 0
UNION ALL SELECT 'missing', 'kind=absent', 0, 0"""

SQL["load_mixed_types"] = """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN NULL ELSE l_quantity END
         AS l_quantity, l_returnflag,
       CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_linestatus END AS l_linestatus
FROM lineitem WHERE l_returnflag IN ('A', 'N', 'R')"""

SQL["rolling_day_slice"] = """
SELECT CAST(ts AS DATE) AS day, event_type, COUNT(*) AS n_rows FROM events
WHERE CAST(ts AS DATE) BETWEEN (SELECT MAX(CAST(ts AS DATE)) FROM events) - 2
                           AND (SELECT MAX(CAST(ts AS DATE)) FROM events) - 1
GROUP BY ALL"""

SQL["stream_windows"] = """
WITH e AS (
  SELECT CAST(ts AS DATE) AS load_date, ts,
         ts >= TIMESTAMP '2024-01-20' OR event_type = 'signup' AS late FROM events),
w AS (SELECT MAX(ts) FILTER (WHERE NOT late) - INTERVAL 3 DAY AS w1,
             MAX(ts) - INTERVAL 3 DAY AS w2 FROM e),
d AS (
  SELECT load_date, COUNT(*) FILTER (WHERE late AND load_date + INTERVAL 1 DAY <= w1) AS n_late,
         COUNT(*) AS n, load_date + INTERVAL 1 DAY <= ANY_VALUE(w2) AS closed
  FROM e, w GROUP BY load_date)
SELECT load_date, CASE WHEN closed THEN n - n_late END AS n_rows, n_late, closed FROM d"""

SQL["stream_dedup_backfill"] = SQL["stream_ingest"]

SQL["period_status"] = """
WITH want AS (SELECT CAST(unnest(range(1991, 2013)) AS INTEGER) AS period),
docs AS (
  SELECT CAST(YEAR(l_shipdate) AS INTEGER) AS period,
         COUNT(DISTINCT l_orderkey // 1000) AS n_docs, COUNT(*) AS n_rows
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1),
made AS (SELECT 2010 AS period, 1 AS n_docs, 1 AS n_bad_docs, 0 AS n_rows
         UNION ALL SELECT 2011, 1, 0, 0 UNION ALL SELECT 2012, 0, 0, 0
         UNION ALL SELECT period, n_docs, 0, n_rows FROM docs)
SELECT period, COALESCE(n_docs, 0) AS n_docs, COALESCE(n_bad_docs, 0) AS n_bad_docs,
       COALESCE(n_rows, 0) AS n_rows,
       CASE WHEN n_docs IS NULL THEN 'absent' WHEN n_rows > 0 THEN 'loaded'
            WHEN n_bad_docs > 0 THEN 'corrupt' ELSE 'no rows' END AS status
FROM want FULL JOIN made USING (period)"""


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
