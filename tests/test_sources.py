import gzip
import json
import sqlite3

import pytest
from pyspark.sql import functions as F

from tidegauge.schemas import Dispatcher, Fetcher, JobConfig, LEGACY_EVENT, Query, StorageConfig
from tidegauge.sources import dated_lines
from tidegauge.sources import paths as P
from tidegauge.sources import readers as R
from tidegauge.sources import writers as K
from tidegauge.sources.reports import write_report


@pytest.fixture
def lines(tmp_path):
    good = [json.dumps({"eid": "START" if i % 2 else "END", "ver": "1", "unknown": 1, "ets": i}) for i in range(6)]
    (tmp_path / "2020-03-04-1-a.json").write_text("\n".join(good[:3]) + "\nbroken\n")
    with gzip.open(tmp_path / "2020-03-05-2-b.json.gz", "wt") as f:
        f.write("\n".join(good[3:]) + "\n")
    return tmp_path


def test_local_scan(spark, lines):
    plain, zipped = str(lines / "2020-03-04-1-a.json"), str(lines / "2020-03-05-2-b.json.gz")
    search = Fetcher("local", queries=(Query(file=f"{plain},{zipped}"), Query(file=plain)))
    assert R.fetch_lines(spark, search).count() == 7
    events = R.fetch_events(spark, search, LEGACY_EVENT)
    assert events.count() == 6 and events.where("eid = 'START'").count() == 3
    only = Fetcher("local", Query(file=f"{plain},{zipped}", partitions=(2,)))
    assert R.fetch_lines(spark, only).count() == 3
    assert R.fetch_lines(spark, Fetcher("local", Query(file=f"{plain},{zipped}", exclude="03-05"))).count() == 4
    assert R.read_lines(spark, [None, plain, plain]).count() == 4


def test_empty_and_wrong_sources(spark):
    assert R.fetch_lines(spark, Fetcher("none")).count() == 0
    assert R.fetch_lines(spark, Fetcher("local", Query())).count() == 0
    for bad in (Fetcher("none", queries=(Query(),)), Fetcher("local"), Fetcher("ftp", Query(file="x"))):
        with pytest.raises(R.FetchError):
            R.fetch_lines(spark, bad)


def test_counted_scan(spark, lines):
    counted, rows = R.count_rows(R.read_lines(spark, [str(lines / "*.json")]), "seen")
    assert R.parse_lines(counted, LEGACY_EVENT).count() == 3
    assert rows.get["rows"] == 4


def test_object_paths():
    q = Query(bucket="b", prefix="raw/", start_date="2020-02-28", end_date="2020-03-01")
    assert P.object_paths(q) == ["s3a://b/raw/2020-02-28*", "s3a://b/raw/2020-02-29*", "s3a://b/raw/2020-03-01*"]
    assert P.object_paths(Query(bucket="b", end_date="2020-03-01", delta=1)) == ["s3a://b/raw/2020-02-29*", "s3a://b/raw/2020-03-01*"]
    with pytest.raises(ValueError, match="bucket"):
        P.object_paths(Query(end_date="2020-03-01"))
    with pytest.raises(ValueError, match="account"):
        P.storage_uri("azure", "c", "p/x")
    assert P.object_paths(Query(bucket="b", folder="true", end_date="2020-03-01", date_pattern="yyyy/MM/dd")) == ["s3a://b/raw/2020/03/01/*"]
    assert P.object_paths(Query(bucket="b", start_date="2020-03-02", end_date="2020-03-01")) == []
    assert P.storage_uri("azure", "c", "p/x", "acc") == "wasb://c@acc.blob.core.windows.net/p/x"
    assert (P.storage_uri("gcloud", "c", "p"), P.storage_uri("oci", "c", "p"), P.storage_uri("local", None, "p")) == ("gs://c/p", "s3a://c/p", "p")
    with pytest.raises(ValueError):
        P.storage_uri("tape", "c", "p")


def test_dispatch(spark, tmp_path):
    df = spark.range(5).withColumn("x", F.when(F.col("id") > 2, "y"))
    file = Dispatcher("file", {"file": str(tmp_path / "out")})
    assert K.dispatch(df, file) == 5
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect())[0] == '{"id":0}'
    assert K.dispatch_all(df, [Dispatcher("console", {"printEvent": False}), file]) == 5
    assert K.dispatch(spark.range(500), Dispatcher("console", {"rows": 1})) == 500
    assert K.dispatch_storage(df, StorageConfig("local", None, str(tmp_path / "stored"))) == 5
    assert K.to_lines(spark.createDataFrame([("raw",)], "t string")).collect()[0].value == "raw"
    sizes = R.file_sizes(spark, str(tmp_path / "out"))
    assert sizes.columns == ["path", "length"] and sizes.agg(F.sum("length")).first()[0] > 40


def test_dispatch_errors(spark):
    df = spark.range(1)
    for sinks in ([], None, [Dispatcher("azure")], [Dispatcher("file")], [Dispatcher("kafka", {"topic": "t"})], [Dispatcher("s3", {"key": "k"})]):
        with pytest.raises(K.DispatchError):
            K.dispatch_all(df, sinks)
    with pytest.raises(K.DispatchError):
        K.dispatch_storage(df, StorageConfig("azure", "c", "x"))
    options = K.kafka_options({"brokerList": "h:1", "topic": "t"})
    assert options["kafka.compression.type"] == "snappy" and options["kafka.batch.size"] == "100"


def test_write_back(spark, tmp_path):
    db = str(tmp_path / "jobs.db")
    with sqlite3.connect(db) as c:
        c.execute("CREATE TABLE job_request (request_id TEXT, status TEXT, download_urls TEXT, dt_job_completed TEXT)")
        c.executemany("INSERT INTO job_request VALUES (?, 'SUBMITTED', NULL, NULL)", [("a",), ("b'",), ("c",)])
    done = spark.createDataFrame([("a", ["x", "y"]), ("b'", [])], "request_id string, download_urls array<string>")
    done = done.withColumn("dt_job_completed", F.lit("2020-01-02 03:04:05").cast("timestamp"))
    K.complete_requests(done.coalesce(1), "job_request", lambda: sqlite3.connect(db), batch=1)
    with sqlite3.connect(db) as c:
        assert c.execute("SELECT * FROM job_request ORDER BY 1").fetchall() == [
            ("a", "COMPLETED", "x,y", "2020-01-02 03:04:05"), ("b'", "COMPLETED", "", "2020-01-02 03:04:05"), ("c", "SUBMITTED", None, None)]
    with pytest.raises(ValueError):
        K.completion_statement("t; DROP TABLE t")


REPORT = [("env1", 22.1, 3), ("env2", 20.1, 3), ("env1", 32.1, 4), (None, 1.0, 1)]


def test_report_by_dimension(spark, tmp_path):
    df = spark.createDataFrame([*REPORT, ("null", 2.0, 9)], "env string, time_spent double, n bigint")
    storage = StorageConfig("local", None, str(tmp_path))
    args = (df, storage, "csv")
    paths = write_report(*args, "by", {"header": "true"}, dims=["env"], column_order=["n", "time_spent"], order=[F.col("n")], one_file=True)
    assert sorted(p.rsplit("/", 1)[-1] for p in paths) == ["%6Eull.csv", "env1.csv", "env2.csv", "null.csv"]
    assert (tmp_path / "by" / "env1.csv").read_text().split() == ["n,time_spent", "3,22.1", "4,32.1"]
    assert (tmp_path / "by" / "null.csv").read_text().split() == ["n,time_spent", "1,1.0"]
    # Without the flag every value is a folder of parts, whatever its size.
    many = write_report(*args, "split", {"header": "true"}, dims=["env"])
    assert (tmp_path / "split" / "env1.csv").is_dir() and spark.read.option("header", True).csv(many).count() == 5
    assert sorted(p.name for p in tmp_path.iterdir()) == ["by", "split"]


def test_whole_report(spark, tmp_path):
    df = spark.createDataFrame(REPORT, "env string, time_spent double, n bigint").repartition(3)
    storage = StorageConfig("local", None, str(tmp_path))
    order = [F.col("n"), F.col("env")]
    write_report(df, storage, "csv", "all", {"header": "true"}, column_order=["n", "env"], order=order, one_file=True)
    assert (tmp_path / "all.csv").read_text().split() == ["n,env", "1,", "3,env1", "3,env2", "4,env1"]
    write_report(df.limit(1), storage, "csv", "all", {"header": "true"}, one_file=True)
    assert len((tmp_path / "all.csv").read_text().split()) == 2
    (zipped,) = write_report(df, storage, "json", "all", compress=True, one_file=True)
    assert zipped.endswith("all.json.gz") and len(gzip.open(zipped).read().split()) == 4
    (folder,) = write_report(df, storage, "csv", "all", {"header": "true"})
    assert (tmp_path / "all.csv").is_dir() and spark.read.option("header", True).csv(folder).count() == 4


def test_scan_over_days_without_files(spark, tmp_path, monkeypatch):
    for day in ("2020-01-01", "2020-01-03"):
        (tmp_path / "raw").mkdir(exist_ok=True)
        (tmp_path / "raw" / f"{day}-0.txt").write_text(f"{day}\n")
    monkeypatch.setattr(P, "storage_uri", lambda store, bucket, path, account=None: f"{bucket}/{path}")
    query = Query(bucket=str(tmp_path), start_date="2019-12-31", end_date="2020-01-04")
    assert [r.value for r in R.fetch_lines(spark, Fetcher("aws", query)).collect()] == ["2020-01-01", "2020-01-03"]
    assert R.fetch_lines(spark, Fetcher("s3", Query(bucket=str(tmp_path), end_date="2021-01-01", delta=0))).count() == 0


def test_report_scan(spark, tmp_path):
    (tmp_path / "r.csv").write_text("a,b\n1,x\n")
    assert R.read_report(spark, str(tmp_path / "r.csv")).dtypes == [("a", "string"), ("b", "string")]
    assert R.read_report(spark, str(tmp_path / "gone.csv")) is None
    loaded = R.load(spark, str(tmp_path / "r.csv"), "csv", "a int, b string", {"header": "true"})
    assert loaded.first().a == 1


def test_config_from_json():
    config = JobConfig.from_dict({
        "search": {"type": "s3", "queries": [None, {"bucket": "b", "prefix": "p", "endDate": "2020-03-04", "delta": 0, "partitions": [1]}]},
        "filters": [{"name": "eid", "operator": "NIN", "value": ["A"]}], "sort": {"name": "ets", "order": "desc"},
        "model": "m", "modelParams": {"idleTime": 5}, "output": [{"to": "console"}],
    })
    assert config.search.queries == (Query(bucket="b", prefix="p", end_date="2020-03-04", delta=0, partitions=(1,)),)
    assert config.sort.order == "desc" and config.output[0].to == "console" and config.model_params == {"idleTime": 5}


def test_cluster_needs_a_shared_checkpoint_folder():
    from types import SimpleNamespace

    from tidegauge.session import ensure_checkpoint_dir

    conf = SimpleNamespace(get=lambda *a: None)
    context = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="yarn")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=context, conf=conf))


def test_dated_lines_reads_wanted_files_only(spark, tmp_path):
    """Files that an option rules out are broken archives, so opening one would fail."""
    for day in range(1, 10):
        for number in (1, 2):
            name = tmp_path / f"2020-03-{day:02d}-{number}-x.json.gz"
            if day in (4, 6) and number == 2:
                with gzip.open(name, "wt") as out:
                    out.write(f"line {day}a\r\nline {day}b")
            else:
                name.write_bytes(b"broken")
    (tmp_path / "2020-03-05-2-skip.json.gz").write_bytes(b"broken")
    (tmp_path / "2020-03-05-2-x.json.gz").unlink()
    (tmp_path / "notes.txt").write_text("no date\n\nlast\n")
    load = lambda *days, **o: dated_lines.read_days(spark, str(tmp_path), *days, exclude="skip", **o)
    lines = load("2020-03-04", "2020-03-06", parts=[2, 7])
    assert sorted((str(r.day), r.part, r.value) for r in lines.collect()) == [
        ("2020-03-04", 2, "line 4a"), ("2020-03-04", 2, "line 4b"), ("2020-03-06", 2, "line 6a"), ("2020-03-06", 2, "line 6b"),
    ]
    # Filters stay with Spark, so a frame may be used with several of them.
    day = lambda d: F.col("day") == F.lit(f"2020-03-{d:02d}").cast("date")
    both = lines.where(day(4)).unionByName(lines.where(day(6)))
    assert sorted(r.value for r in both.collect()) == ["line 4a", "line 4b", "line 6a", "line 6b"]
    assert load("2021-01-01", "2021-01-31").count() == 0 and load("2020-03-06", "2020-03-01").count() == 0
    other = tmp_path / "other"
    other.mkdir()
    (other / "notes.txt").write_text("no date\n\nlast\n")
    kept = dated_lines.read_days(spark, str(other)).collect()
    assert [(r.day, r.part, r.value) for r in kept] == [(None, None, "no date"), (None, None, ""), (None, None, "last")]
    with pytest.raises(Exception, match="cannot be read"):
        load(date_pattern="yyyy-MM").count()
    assert dated_lines.read_days(spark, str(tmp_path / "missing")).count() == 0


def test_dated_lines_splits_and_folders(spark, tmp_path):
    for day in range(1, 8):
        folder = tmp_path / "2020" / "03" / f"{day:02d}"
        folder.mkdir(parents=True)
        for i in range(3):
            (folder / f"{i}.json").write_text("x" * 99 + "\n")
    load = lambda **o: dated_lines.read_days(spark, f"file:{tmp_path}", date_pattern="yyyy/MM/dd", **o)
    one = load(split_bytes=1)
    assert one.count() == 21 and one.rdd.getNumPartitions() == 21 and load(split_bytes=250).rdd.getNumPartitions() == 11
    week = load(split_bytes=1, end="2020-03-02")
    assert week.rdd.getNumPartitions() == 6 and week.select("day").distinct().count() == 2
    reader = dated_lines.DatedLinesReader({"path": str(tmp_path), "date_pattern": "yyyy/MM/dd", "start": "2020-03-02", "end": "2020-03-02"})
    assert [str(f[1]) for p in reader.partitions() for f in p.files] == ["2020-03-02"] * 3
