"""Sources and cleaning jobs on small hand-made files (FIXTURES.md §1)."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.operators import clean
from panelforge.sources import files

COMPLAINTS_A = (
    "unique_key,created_date,complaint_type,incident_zip,community_board,borough\n"
    "1,2024-01-15T10:20:30.000,Noise,07030,01 NORTH,NORTH\n"
    "2,2024-01-15T23:59:59.500,\"Heat\nHot Water\", 10001 ,   ,EAST\n"
    "3,not a date,Noise,N/A,02 EAST,EAST\n"
    "4,2024-01-16T08:00:00.000,Noise,,,WEST\n"
)
# same key 1 again, columns in another order
COMPLAINTS_B = (
    "borough,unique_key,incident_zip,complaint_type,community_board,created_date\n"
    "NORTH,1,07030,Noise,01 NORTH,2024-01-15T10:20:30.000\n"
    "SOUTH,5,11201,Rodent,03 SOUTH,2024-01-17T09:00:00.000\n"
)


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_csv_by_header_and_complaints_clean(spark, tmp):
    write(f"{tmp}/in/part_2024-01-15.csv", COMPLAINTS_A)
    write(f"{tmp}/in/part_2024.csv", COMPLAINTS_B)
    raw = files.read_csv_by_header(spark, f"{tmp}/in", multiline=True)
    assert set(raw.dtypes) == {(c, "string") for c in raw.columns}
    out = {r.unique_key: r for r in clean.complaints_clean(raw).collect()}
    rows = clean.complaints_clean(raw).count()
    assert rows == 5                      # key 4 (empty board) dropped, key 1 twice
    assert "4" not in out
    assert out["2"].community_board == "   "  # whitespace-only board is kept
    assert out["2"].complaint_type == "Heat\nHot Water"
    assert out["2"].created_date == dt.datetime(2024, 1, 15, 23, 59, 59, 500000)
    assert out["3"].created_date is None   # unparsable date -> NULL
    assert out["1"].incident_zip == "07030"  # leading zero kept
    assert out["5"].borough == "SOUTH" and out["5"].incident_zip == "11201"


def test_csv_positional_trap_is_avoided(spark, tmp):
    write(f"{tmp}/in/a.csv", "x,y\n1,2\n")
    write(f"{tmp}/in/b.csv", "y,x\n20,10\n")
    got = sorted((r.x, r.y) for r in files.read_csv_by_header(spark, f"{tmp}/in").collect())
    assert got == [("1", "2"), ("10", "20")]


ODD_NAMES = ["a b.csv", "c[1].csv", "d%20e.csv", "e{x}.csv", "f?.csv", "g*.csv", "h+,=.csv",
             "i\\j.csv", "k#é.csv"]


def test_csv_files_with_odd_names(spark, tmp):
    for i, name in enumerate(ODD_NAMES):
        write(f"{tmp}/in/sub {i % 2}[x]/{name}", "x,y\n1,2\n" if i % 2 else "y,x\n2,1\n")
        write(f"{tmp}/in/sub {i % 2}[x]/empty {i}.csv", "")
    df = files.read_csv_by_header(spark, f"{tmp}/in", with_file=True)
    assert [(r.x, r.y) for r in df.collect()] == [("1", "2")] * len(ODD_NAMES)
    assert {files.path_of(r["__file"]).rsplit("/", 1)[1] for r in df.collect()} == set(ODD_NAMES)


def test_headers_with_quotes_gaps_and_repeats(spark, tmp):
    write(f"{tmp}/in/a.csv", '\ufeff"a,1",,b,B\n1,2,3,4\n')
    write(f"{tmp}/in/b.csv", '"two\nlines",b\n5,6\n')
    df = files.read_csv_by_header(spark, f"{tmp}/in", multiline=True)
    rows = [{k: v for k, v in r.asDict().items() if v} for r in df.collect()]
    assert {"a,1": "1", "_c1": "2", "b2": "3", "B3": "4"} in rows
    assert {"two\nlines": "5", "b": "6"} in rows


def bytes_read(spark):
    return sum(s.getBytesRead() for s in
               spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())


def test_headers_of_large_files_cost_a_buffer_each(spark, tmp):
    line = "x" * 90 + ",1\n"
    for i in range(3):
        write(f"{tmp}/in/{i} [x].csv", "a,b\n" + line * 200_000)  # 18 MB each
    write(f"{tmp}/in/small.csv", "c\n1\n")
    before = bytes_read(spark)
    got = files.file_headers(spark, f"{tmp}/in").collect()
    assert sorted(r.header for r in got) == ["a,b"] * 3 + ["c"]
    assert all(r.landed for r in got)
    assert bytes_read(spark) - before < 3 * 200_000
    assert files.read_csv_by_header(spark, f"{tmp}/in").count() == 600_001


WIDE = (
    "RegionID,SizeRank,RegionName,RegionType,StateName,State,City,Metro,CountyName,"
    "1999-12-31,2020-01-31,2020-02-29,20xx-note\n"
    "1,5,07030,zip,S1,S1,Alpha,M1,C1,90,100,,a\n"
    "2,6,10001,zip,S2,S2,Beta,M1,C2,95,200.5,abc,b\n"
    "3,7,99999,zip,S2,S2,Gamma,M2,C3,1,2,3,c\n"
    "4,8,10001,zip,S2,S2,Delta,M1,C2,1,300,400,d\n"
)


def test_prices_clean_wide_to_long(spark, tmp):
    write(f"{tmp}/wide.csv", WIDE)
    wide = files.read_csv_strings(spark, f"{tmp}/wide.csv")
    out = clean.prices_clean(wide, ["07030", "10001"])
    got = sorted((r.zip_code, str(r.date), r.price, r.year, r.month, r.city) for r in out.collect())
    assert got == [
        ("07030", "1999-12-31", 90.0, 1999, 12, "Alpha"),
        ("07030", "2020-01-31", 100.0, 2020, 1, "Alpha"),
        ("10001", "1999-12-31", 1.0, 1999, 12, "Delta"),
        ("10001", "1999-12-31", 95.0, 1999, 12, "Beta"),
        ("10001", "2020-01-31", 200.5, 2020, 1, "Beta"),
        ("10001", "2020-01-31", 300.0, 2020, 1, "Delta"),
        ("10001", "2020-02-29", 400.0, 2020, 2, "Delta"),
    ]
    assert out.columns == ["RegionID", "SizeRank", "zip_code", "regiontype", "statename",
                           "state", "city", "metro", "countyname", "price", "date",
                           "year", "month"]
    # allow-list as a DataFrame gives the same rows (semi join)
    allow = spark.createDataFrame([("07030",), ("10001",)], "entity string")
    assert clean.prices_clean(wide, allow).count() == len(got)


def test_unpivot_pivot_roundtrip(spark):
    from panelforge.operators import reshape
    long = spark.createDataFrame([("a", "2020-01-31", 1.0), ("a", "2020-02-29", 2.0),
                                  ("b", "2020-01-31", 3.0)], "k string, p string, v double")
    wide = reshape.pivot_periods(long, ["k"], "p", "v", ["2020-01-31", "2020-02-29"], "first")
    back = reshape.unpivot_periods(wide, ["k"], value_col="v").filter(F.col("v").isNotNull())
    got = sorted((r.k, r.date_str, float(r.v)) for r in back.collect())
    assert got == sorted((r.k, r.p, r.v) for r in long.collect())


def _matrix(header, rows, pretty=False):
    return json.dumps([header] + rows, indent=2 if pretty else None)


H = ["NAME", "B19013_001E", "B15003_001E", "B15003_022E", "B15003_023E",
     "B15003_024E", "B15003_025E", "zip code tabulation area"]


def test_json_matrix_files_per_year(spark, tmp):
    write(f"{tmp}/socio/socio_2020.json", _matrix(H, [
        ["ZCTA5 10001", "101409", "20000", "7000", "4000", "900", "500", "10001"],
        ["ZCTA5 10002", None, "50000", "9000", "3000", "400", "300", "10002"]], pretty=True))
    # other column order and an extra column
    h2 = list(reversed(H)) + ["EXTRA"]
    write(f"{tmp}/socio/socio_2021.json", _matrix(h2, [
        ["10001", "1", "2", "3", "4", "30000", "-5", "ZCTA5 10001", "x"]]))
    write(f"{tmp}/socio/socio_2022.json", _matrix(H, []))       # header only
    write(f"{tmp}/socio/socio_2023.json", "")                    # empty file
    # 2024 missing entirely
    raw = files.read_json_matrix(spark, f"{tmp}/socio/socio_*.json", {h: h for h in H},
                                 period_pattern=r"socio_(\d{4})\.json")
    out = clean.socio_clean(raw)
    got = {(r.zip_code, r.data_year): r for r in out.collect()}
    assert set(got) == {("10001", 2020), ("10002", 2020), ("10001", 2021)}
    assert got[("10002", 2020)].median_income is None
    assert got[("10001", 2021)].median_income == -5          # no range check
    assert got[("10001", 2021)].total_pop_over_25 == 30000   # resolved by name
    assert got[("10001", 2020)].doctorate_degree == 500
    assert dict(out.dtypes)["median_income"] == "int"


def test_json_payload_files(spark, tmp):
    for y, rows in [(2020, [["ZCTA5 10001", "25000", "10001"]]),
                    (2021, [["ZCTA5 10001", "n/a", "10001"], ["ZCTA5 10002", "7", "10002"]])]:
        write(f"{tmp}/pop/pop_{y}.json", json.dumps(
            {"year": y, "header": ["NAME", "DP05_0001E", "zip code tabulation area"], "data": rows}))
    rows = files.read_json_payload(spark, f"{tmp}/pop", {
        "NAME": "NAME", "DP05_0001E": "DP05_0001E",
        "zip code tabulation area": "zip code tabulation area"})
    out = clean.population_clean(rows)
    got = sorted((r.zip_code, r.data_year, r.total_population) for r in out.collect())
    assert got == [("10001", 2020, 25000), ("10001", 2021, None), ("10002", 2021, 7)]
    assert out.columns == ["zip_code", "NAME", "total_population", "data_year"]


def test_load_by_name_ignores_case_and_order(spark, tmp):
    spark.createDataFrame([(2020, "10001", 5)], "DATA_YEAR int, Zip_Code string, median_INCOME int") \
        .write.parquet(f"{tmp}/p")
    target = T.StructType([T.StructField("zip_code", T.StringType()),
                           T.StructField("data_year", T.IntegerType()),
                           T.StructField("median_income", T.IntegerType()),
                           T.StructField("absent", T.StringType())])
    r = files.load_by_name(spark, f"{tmp}/p", target).collect()[0]
    assert (r.zip_code, r.data_year, r.median_income, r.absent) == ("10001", 2020, 5, None)


def test_reject_split(spark):
    df = spark.createDataFrame([("1", "2.5"), ("x", "3"), (None, "y"), ("4", None)], "a string, b string")
    ok, bad = files.split_rejects(df, {"a": "int", "b": "double"})
    assert sorted((r.a, r.b) for r in ok.collect()) == [(1, 2.5), (4, None)]
    assert sorted(r.reject_reason for r in bad.collect()) == ["bad a", "bad b"]


def test_slices_glob(spark, tmp):
    for d in ["2024-01-15", "2024-01-16"]:
        spark.createDataFrame([(d,)], "d string").write.parquet(f"{tmp}/t/part_{d}.parquet")
    assert files.read_slices(spark, f"{tmp}/t", "part_2024-01-15*").count() == 1


def test_prices_clean_20xx_only_pattern(spark, tmp):
    from panelforge.operators.reshape import DATE_COLUMN_20XX
    write(f"{tmp}/wide.csv", WIDE)
    wide = files.read_csv_strings(spark, f"{tmp}/wide.csv")
    out = clean.prices_clean(wide, ["07030", "10001"], pattern=DATE_COLUMN_20XX)
    assert sorted({str(r.date) for r in out.collect()}) == ["2020-01-31", "2020-02-29"]


def test_csv_by_header_many_files_three_orders(spark, tmp):
    orders = [("a", "b", "c"), ("c", "a", "b"), ("b", "c", "a")]
    for i in range(60):
        cols = orders[i % 3]
        vals = {"a": str(i), "b": f"b{i}", "c": f"c{i}"}
        write(f"{tmp}/many/f{i:03d}.csv",
              ",".join(cols) + "\n" + ",".join(vals[c] for c in cols) + "\n")
    got = sorted((int(r.a), r.b, r.c) for r in files.read_csv_by_header(spark, f"{tmp}/many").collect())
    assert got == [(i, f"b{i}", f"c{i}") for i in range(60)]


def test_nested_folders_and_compressed_files(spark, tmp):
    import gzip
    os.makedirs(f"{tmp}/in/2024/jan")
    with open(f"{tmp}/in/a.csv", "w") as f:
        f.write("a,b\n1,2\n")
    for i in range(3):
        with gzip.open(f"{tmp}/in/2024/jan/b{i}.csv.gz", "wt") as f:
            f.write("b,a\n4,3\n")
    df = files.read_csv_by_header(spark, f"{tmp}/in", with_file=True)
    assert sorted((r.a, r.b) for r in df.collect()) == [("1", "2")] + [("3", "4")] * 3
    # one relation per header, not per file
    assert df._jdf.queryExecution().analyzed().toString().count("Relation") == 2


def test_corrupt_documents_are_reported(spark):
    docs = spark.createDataFrame(
        [(2020, '[["a","b"],["1","2"]]'), (2021, '[["a","b"],["1",'), (2022, '[["a","b"]]'),
         (2023, '[["a"],["1"]]'), (2024, None), (2025, "[]")], "year int, value string")
    bad = files.document_problems(docs, "value", ["a", "b"], ["year"])
    assert {r.year: r.problem for r in bad.collect()} == {
        2021: "corrupt", 2022: "no rows", 2023: "missing columns", 2024: "corrupt", 2025: "no rows"}


def test_a_pivot_refuses_unlisted_periods(spark):
    import pytest
    from panelforge.operators import reshape
    df = spark.createDataFrame([("x", "2020", 1.0), ("x", "2021", 2.0)], "id string, p string, v double")
    assert reshape.pivot_periods(df, ["id"], "p", "v", ["2020", "2021"]).first()["2021"] == 2.0
    with pytest.raises(Exception, match="outside"):
        reshape.pivot_periods(df, ["id"], "p", "v", ["2020"]).collect()


def test_keys_with_letters_survive(spark):
    raw = spark.createDataFrame([(k, "2024-01-01", "t", "1", "b", "x") for k in ("A1", "A2", "007")],
                                "unique_key string, created_date string, complaint_type string, "
                                "incident_zip string, community_board string, borough string")
    assert sorted(r.unique_key for r in clean.complaints_clean(raw).collect()) == ["007", "A1", "A2"]


def test_scratch_is_dropped(spark):
    from panelforge.session import drop_scratch, scratch_path
    drop_scratch(spark)
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert drop_scratch(spark) == 1
    assert not os.path.exists(path.removeprefix("file:"))


def test_intermediates_are_dropped_and_the_result_stays(spark):
    from panelforge.session import drop_scratch_since, scratch_mark, scratch_path
    first = scratch_path(spark, "before")
    mark = scratch_mark(spark)
    made = [scratch_path(spark, n) for n in ("a", "result", "b")]
    for p in (first, *made):
        spark.range(3).write.parquet(p)
    assert drop_scratch_since(spark, mark, made[1]) == 2
    assert [os.path.exists(p.removeprefix("file:")) for p in (first, *made)] == [True, False, True, False]


def test_other_columns_of_matrix_documents_are_kept_on_request(spark, tmp):
    write(f"{tmp}/in/socio_2020.json", '[["a","extra 1","b"],["1","x","2"]]')
    write(f"{tmp}/in/socio_2021.json", '[["b","a","state","A"],["4","3","NY","dup"]]')
    out = files.read_json_matrix(spark, f"{tmp}/in/socio_*.json", {"one": "a", "b": "b"},
                                 period_pattern=r"socio_(\d{4})", keep_others=True)
    assert out.columns == ["one", "b", "extra 1", "state", "data_year"]
    assert sorted(tuple(r) for r in out.collect()) == [
        ("1", "2", "x", None, 2020), ("3", "4", None, "NY", 2021)]
