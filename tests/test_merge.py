import pytest
from pyspark.sql import functions as F

from tidegauge.operators import merge as M
from tidegauge.schemas import MergeConfig
from tidegauge.sources.readers import read_report
from tidegauge.sources.reports import merge_report_files

COLUMNS = "State string, Producer string, Scans string, Date string"
DAYS = ["19-04-1999", "25-05-2018", "01-06-2019", "31-12-2019", "01-01-2020", "31-10-2020", "01-11-2020", "02-11-2020",
        "05-11-2020", "07-11-2020"]


@pytest.fixture(scope="module")
def report(spark):
    return spark.createDataFrame([(f"s{i}", "p", str(i), day) for i, day in enumerate(DAYS)], COLUMNS)


@pytest.fixture(scope="module")
def delta(spark):
    return spark.createDataFrame([("08-11-2020", "s", "p", "9")], "Date string, State string, Producer string, Scans string")


@pytest.mark.parametrize("age,count,want", [
    ("ACADEMIC_YEAR", 2, 9), ("GEN_YEAR", 1, 7), ("MONTH", 1, 5), ("WEEK", 1, 4), ("DAY", 4, 3), ("NONE", 1, 11),
])
def test_window(report, delta, age, count, want):
    config = MergeConfig(1, ("Date",), age, count, "Date||%d-%m-%Y")
    out = M.merge_report(report, delta, config)
    assert out.columns == report.columns and out.count() == want
    days = [r.d for r in out.select(M.parsed_date("Date", "dd-MM-yyyy").alias("d")).collect()]
    assert days == sorted(days)


def test_month_window_crosses_years(spark, delta):
    report = spark.createDataFrame([("s", "p", "1", "15-12-2019"), ("s", "p", "1", "30-11-2019"), ("s", "p", "1", "10-01-2020")], COLUMNS)
    config = MergeConfig(1, ("Date",), "MONTH", 2, "Date||%d-%m-%Y")
    rows = M.merge_report(report, report.where("Date like '10-01%'"), config).collect()
    assert sorted(r.Date for r in rows) == ["10-01-2020", "15-12-2019"]


def test_replace_upsert_and_null_keys(spark, report, delta):
    assert M.merge_report(report, delta, MergeConfig(0)).collect() == delta.collect()
    with_null = report.unionByName(spark.createDataFrame([("n", "p", "1", None)], COLUMNS))
    twice = with_null.unionByName(with_null)
    fresh = spark.createDataFrame([("new", "p", "5", "07-11-2020")], COLUMNS)
    out = M.upsert(twice, fresh, ["Date"]).collect()
    assert len(out) == 11 and [r.State for r in out if r.Date == "07-11-2020"] == ["new"]
    assert [r.State for r in out if r.Date is None] == ["n"]


def test_spec_columns_and_numbers(spark, report):
    assert M.rollup_spec(MergeConfig(1, rollup_col="Day||%Y-%m-%d")) == ("Day", "yyyy-MM-dd")
    assert M.rollup_spec(MergeConfig(1, rollup_col="Day||%Y", rollup_format="MM")) == ("Day", "MM")
    assert M.rollup_spec(MergeConfig(1)) == ("Date", "yyyy-MM-dd")
    assert M.output_columns(report, MergeConfig(1, column_order=("Scans", "Gone", "State"))) == ["Date", "Scans", "State"]
    assert M.output_columns(report, MergeConfig(1, column_order=("Scans",), date_required=False)) == ["Scans"]
    cases = {"1.23E2": "123", "1007.0": "1007.0", None: "0", "1.23E5": "123000", "-1.5e-3": "-0.0015", "12": "12", "1.2345E2": "123.45",
             "1.5E-20": "0.000000000000000000015", "1.23456789012345678901234567890E25": "12345678901234567890123456.7890", "E5": "E5",
             "0E3": "0", "-.5e1": "-5", "12E9999": "12E9999", "0012E0": "12"}
    df = spark.createDataFrame([(k, v) for k, v in cases.items()], "raw string, want string")
    assert all(r.p == r.want for r in df.select("want", M.plain_number(F.col("raw")).alias("p")).collect())


def test_documents_hold_every_row_once(spark, report):
    docs = M.report_documents(report.repartition(3), ["Date", "Scans"], ["Scans"], rows_per_document=2).collect()
    assert all(d["keys"] == ["Date", "Scans"] and len(d.tableData) == len(d.data) == 2 for d in docs)
    assert sorted(r["Date"] for d in docs for r in d.data) == sorted(DAYS)
    (single,) = M.report_documents(report.coalesce(1)).collect()
    assert len(single.data) == 10


def test_merge_files(spark, tmp_path):
    folder = tmp_path / "reports"
    folder.mkdir()
    (folder / "scans.csv").write_text("Date,State,Scans\n05-11-2020,a,1\n06-11-2020,b,2\n06-11-2020,b,2\n")
    (folder / "delta.csv").write_text("State,Scans,Date\nc,1.5E1,2020-11-06\nc,1.5E1,2020-11-06\n")
    config = MergeConfig(1, ("Date",), "DAY", 30, "Date||%d-%m-%Y", column_order=("State", "Scans"), metric_labels=("Scans",))
    args = (spark, config, str(folder / "scans.csv"), str(folder / "delta.csv"), "2020-11-07")
    merge_report_files(*args, one_file=True)
    lines = (folder / "scans.csv").read_text().split()
    assert lines == ["Date,State,Scans", "05-11-2020,a,1", "06-11-2020,c,1.5E1"]
    (doc,) = spark.read.json(str(folder / "scans.json")).collect()
    assert doc.tableData == [["05-11-2020", "a", "1"], ["06-11-2020", "c", "15"]]
    backup = read_report(spark, str(folder / "report-backups" / "scans-2020-11-07.csv"))
    assert backup.count() == 3
    (folder / "scans.csv").unlink()
    merge_report_files(*args, one_file=True)
    assert (folder / "scans.csv").read_text().split() == ["Date,State,Scans", "06-11-2020,c,1.5E1"]


def test_rows_without_a_date_stay(spark):
    report = spark.createDataFrame([("a", "01-01-2020"), ("b", None), ("c", "soon"), ("d", "01-02-2020")], "State string, Date string")
    for age, left in (("NONE", "abcd"), ("DAY", "bcd")):
        assert "".join(sorted(r.State for r in M.trim(report, "Date", "dd-MM-yyyy", age, 3).collect())) == left
