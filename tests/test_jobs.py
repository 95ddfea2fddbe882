import itertools
import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidegauge.plans import jobs as J
from tidegauge.plans.models import DeviceEventsModel, EventTextModel, FunctionModel, WorkflowSummaryModel
from tidegauge.schemas import JobConfig
from tidegauge.streaming import streams as S
from test_workflow import LONG, SHORT


@pytest.fixture
def config(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "2020-01-01.json").write_text("\n".join(SHORT + ["broken"]) + "\n")
    (tmp_path / "in" / "2020-01-02.json").write_text("\n".join(LONG) + "\n")
    return {
        "search": {"type": "local", "queries": [{"file": str(tmp_path / "in" / "*.json")}]},
        "output": [{"to": "file", "params": {"file": str(tmp_path / "out")}}],
        "modelParams": {"now": "2020-01-01"},
    }


def test_workflow_job(spark, config, tmp_path):
    row = J.run_job(spark, "batch", json.dumps(config), [WorkflowSummaryModel()]).first()
    assert (row.status, row.input_events, row.output_events) == ("SUCCESS", 26, 10)
    out = spark.read.json(str(tmp_path / "out"))
    assert out.count() == 10 and out.select("id").distinct().count() == 10
    first = sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect())
    J.get_job("wfs")(spark, JobConfig.from_dict(config))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()).__len__() == len(first)


def test_replay_and_backfill(spark, config, tmp_path):
    assert J.replay(spark, JobConfig.from_dict(config)) == 26
    config["search"]["queries"][0]["file"] = str(tmp_path / "in" / "__endDate__.json")
    config["output"][0]["params"]["file"] = str(tmp_path / "days" / "__endDate__")
    outcome = J.backfill(spark, "telemetry-replay", "2020-01-01", "2020-01-03", json.dumps(config))
    assert [s.split(":")[0] for _, s in outcome] == ["SUCCESS", "SUCCESS", "FAILED"]
    assert spark.read.text(str(tmp_path / "days" / "2020-01-02")).count() == 16
    with pytest.raises(J.UnknownJob):
        J.backfill(spark, "nothing", "2020-01-01", "2020-01-01", json.dumps(config))
    with pytest.raises(ValueError):
        J.run_job(spark, "weekly", json.dumps(config), [])


def test_models_share_input_and_fail_alone(spark, config):
    def fail(data, params):
        raise RuntimeError("broken model")

    models = [FunctionModel("bad", fail), FunctionModel("all", lambda d, p: d)]
    rows = J.run_models(spark, JobConfig.from_dict(config), models, report_date="2020-01-02").collect()
    assert [(r.model, r.status, r.output_events) for r in rows] == [("bad", "FAILED", 0), ("all", "SUCCESS", 26)]
    assert rows[0].message == "broken model" and rows[1].input_events == 26


def test_models(spark):
    df = spark.createDataFrame([("START", "d1", 1), ("END", "d1", 2), ("START", "d1", 3)], "eid string, did string, ets int")
    lists = DeviceEventsModel().execute(df, {"perList": 1}).collect()
    assert sorted(e.ets for r in lists for e in r.events) == [1, 3] and all(r.events_count == 1 for r in lists)
    assert EventTextModel().execute(df, {"eids": ["END"]}).first().value == '{"eid":"END","did":"d1","ets":2}'


def test_stream_runs_models(spark, config, tmp_path):
    lines = S.file_stream(spark, str(tmp_path / "in"), maxFilesPerTrigger="1")
    stream = S.run_models_on_stream(lines, JobConfig.from_dict(config), [WorkflowSummaryModel()], str(tmp_path / "state"))
    stream.awaitTermination()
    assert spark.read.json(str(tmp_path / "out")).count() == 10
    done = J.run_job(spark, "streaming", config, [], lambda s, c, m: "started")
    assert done == "started"


def test_stream_sessions_match_batch(spark, tmp_path):
    """Keys that open an app session after every pause: stream and batch agree."""
    from test_workflow import line
    from tidegauge.operators import workflow as W

    lines = []
    for key in range(4):
        for day in range(3):
            base = 1_600_000_000_000 + day * 86_400_000 + key * 1000
            lines += [line("START", base, "app", did=f"d{key}"), line("START", base + 5_000, "player", "play", did=f"d{key}"),
                      line("IMPRESSION", base + 9_000, "view", did=f"d{key}", page="p"), line("INTERACT", base + 20_000, "TOUCH", did=f"d{key}"),
                      line("END", base + 30_000, "player", "play", did=f"d{key}"), line("END", base + 40_000, "app", did=f"d{key}")]
    late = [line("START", 1_600_000_000_000 + 9 * 86_400_000, "app", did="last")]
    events = W.session_events(W.read_events(spark.createDataFrame([(x,) for x in lines + late], "value string")))
    events.write.parquet(str(tmp_path / "events"))
    stream = S.stream_summaries(spark.readStream.schema(events.schema).parquet(str(tmp_path / "events")))
    (stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state"))
     .trigger(availableNow=True).start().awaitTermination())
    got = W.finish_summaries(spark.read.schema(stream.schema).parquet(str(tmp_path / "out")))
    keyed = W.session_keys(W.read_events(spark.createDataFrame([(x,) for x in lines], "value string")))
    want = W.finish_summaries(W.raw_summaries(keyed, 600_000, 1_800_000))
    text = lambda df: sorted(str(r) for r in df.select(F.struct("*").alias("s")).collect())
    assert len(text(want)) == 24 and text(got) == text(want)


def test_a_restarted_stream_goes_on(spark, tmp_path):
    """Random sessions in three files, a query per file: the summaries are the batch's, but for sessions still open."""
    from test_workflow import line, random_lines
    from tidegauge.operators import workflow as W

    lines = random_lines(11, ["d1", "d2", "d3"], 240)
    ets = lambda text: json.loads(text)["ets"]
    lines.sort(key=ets)
    # Every device ends with an event after a break, so all before it is over; one more event takes the watermark past these.
    end = ets(lines[-1]) + 10_000_000
    closing = [line("OTHER", end, "x", did=d) for d in ("d1", "d2", "d3")]
    parts = [lines[:80], lines[80:160], lines[160:] + closing + [line("START", end + 10**9, "app", did="last")]]
    for i, part in enumerate(parts):
        frame = spark.createDataFrame([(x,) for x in part], "value string").coalesce(1)
        W.session_events(W.read_events(frame)).write.mode("append").parquet(str(tmp_path / "events"))
        stream = S.stream_summaries(spark.readStream.schema(spark.read.parquet(str(tmp_path / "events")).schema).parquet(str(tmp_path / "events")))
        (stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state"))
         .trigger(availableNow=True).start().awaitTermination())
        assert i or spark.read.parquet(str(tmp_path / "out")).count() > 0
    got = spark.read.schema(stream.schema).parquet(str(tmp_path / "out"))
    everything = spark.createDataFrame([(x,) for x in lines + closing], "value string")
    want = W.raw_summaries(W.session_keys(W.read_events(everything)), 600_000, 1_800_000)
    text = lambda df: {str(r) for r in df.select(*W._SUMMARY_COLUMNS).collect()}
    assert len(text(want)) > 50 and text(got) == text(want)


def test_sessions_by_slot_equal_sessions_at_once(spark):
    """Slots shorter and longer than sessions, gaps of exactly the limit, and a key whose one session fills every slot."""
    import random

    r, rows = random.Random(3), []
    for key in range(6):
        at = 1_600_000_000_000
        for _ in range(80):
            at += r.choice([0, 1, 59_999, 60_000, 60_001, 400_000]) if key else 30_000
            rows.append((key, at))
    df = spark.createDataFrame(rows, "key int, ms bigint").withColumn("t", F.timestamp_millis("ms"))
    want = S.gap_sessions(df, "t", "60 seconds", ["key"], [F.count(F.lit(1)).alias("n"), F.max("ms").alias("top")])
    want = sorted(map(tuple, want.select("key", "session_start", "session_end", "n", "top").collect()))
    assert len({w[0] for w in want}) == 6 and len(want) > 50
    for slot_ms in (7_000, 60_000, 500_000, 10**9):
        got = S.gap_sessions_by_slot(df, "t", 60_000, ["key"], {"n": (F.count(F.lit(1)), F.sum), "top": (F.max("ms"), F.max)}, slot_ms)
        assert sorted(map(tuple, got.select("key", "session_start", "session_end", "n", "top").collect())) == want


def test_device_filter_on_stream_windows(spark):
    df = spark.createDataFrame([(1, "2020-01-01 00:01:00"), (2, "2020-01-01 00:09:00")], "id int, t string").withColumn("t", F.col("t").cast("timestamp"))
    out = S.windowed(df, "t", "5 minutes", [], [F.count(F.lit(1)).alias("n")])
    assert sorted(r.n for r in out.collect()) == [1, 1]
    for gap, want in (("7 minutes", [1, 1]), ("8 minutes", [2])):
        gaps = S.gap_sessions(df, "t", gap, [], [F.count(F.lit(1)).alias("n")])
        assert sorted(r.n for r in gaps.collect()) == want


def test_requests_meet_their_rows(spark):
    from tidegauge.operators.requests import match_requests

    rows = [(1, "a", 5.0), (2, "a", None), (3, "b", 50.0), (4, None, 7.0), (5, "b", -1.0)]
    data = spark.createDataFrame(rows, "id int, kind string, value double")
    condition = lambda name, operator, value: {"name": name, "operator": operator, "value": value}
    wanted = {
        "key": ([condition("kind", "EQ", "a")], {1, 2}),
        "key and more": ([condition("value", "GE", "5"), condition("kind", "EQ", "b")], {3}),
        "no key": ([condition("value", "LT", "10")], {1, 4, 5}),
        "none": ([], {1, 2, 3, 4, 5}),
        "not": ([condition("kind", "NE", "a")], {3, 4, 5}),
        "one of": ([condition("kind", "IN", "a|c"), condition("value", "GT", "0")], {1}),
        "number key": ([condition("id", "EQ", "4")], {4}),
        "no such field": ([condition("nothing", "EQ", "a")], set()),
        "unknown operator": ([condition("kind", "LIKE", "a"), condition("kind", "EQ", "a")], set()),
        "no number": ([condition("value", "GT", "x")], set()),
    }
    requests = spark.createDataFrame([(k, json.dumps({"filters": f})) for k, (f, _) in wanted.items()], "request_id string, request_data string")
    found = {(r.request_id, r.id) for r in match_requests(data, requests).collect()}
    assert found == {(k, i) for k, (_, ids) in wanted.items() for i in ids}
    assert match_requests(data, requests.limit(0)).count() == 0 and match_requests(data.limit(0), requests).count() == 0
    broken = spark.createDataFrame([("x", "no json"), ("y", None)], "request_id string, request_data string")
    assert match_requests(data, broken).count() == 10


def test_requests_of_few_values_are_dealt_to_blocks(spark):
    """One value makes 300 x 40 pairs: they lie in blocks of their own, and each pair that holds is found once."""
    from tidegauge.operators.requests import match_requests

    data = spark.range(360).select("id", F.when(F.col("id") < 300, "hot").otherwise("cold").alias("kind"), (F.col("id") % 50).cast("double").alias("value"))
    filters = lambda i: [
        {"name": "kind", "operator": "EQ", "value": "cold" if i % 10 == 9 else "hot"}, {"name": "value", "operator": "ge", "value": str(i)},
        {"name": "value", "operator": "LT", "value": "45"}, {"name": "value", "operator": "LT", "value": str(i + 30)},
    ] + [{"name": "id", "operator": "NE", "value": "7"}] * (i % 2)
    requests = spark.createDataFrame([(f"r{i}", json.dumps({"filters": filters(i)})) for i in range(44)], "request_id string, request_data string")
    found = match_requests(data, requests, pairs=500)
    want = sorted(
        (f"r{i}", n) for i in range(44) for n in range(360)
        if (n >= 300) == (i % 10 == 9) and i <= n % 50 < min(45, i + 30) and not (i % 2 and n == 7)
    )
    assert sorted((r.request_id, r.id) for r in found.collect()) == want
    spread = found.groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) > 3 and max(r["count"] for r in spread) < len(want) / 2


def test_what_a_request_finds_comes_in_one_piece(spark):
    """A key's requests are cut before its rows are, and a task goes through its requests one by one."""
    from tidegauge.operators.requests import match_requests

    data = spark.range(900).select("id", F.lit("hot").alias("kind")).repartition(3)
    filters = lambda i: [{"name": "kind", "operator": "EQ", "value": "hot"}, {"name": "id", "operator": "GE", "value": str(i)}]
    requests = spark.createDataFrame([(f"r{i}", json.dumps({"filters": filters(i)})) for i in range(40)], "request_id string, request_data string")
    want = sorted((f"r{i}", n) for i in range(40) for n in range(i, 900))
    # 100 times the root of the pairs is the most that a block has of a key's rows: all of them, then a third.
    for pairs, shares in ((500, 1), (9, 3)):
        found = match_requests(data, requests, pairs=pairs, carried=[(F.col("id") + 1).alias("next")])
        assert found.columns == ["next", "request_id"]
        tasks = found.rdd.glom().collect()
        assert sorted((r.request_id, r.next - 1) for rows in tasks for r in rows) == want
        pieces = [name for rows in tasks for name, _ in itertools.groupby(r.request_id for r in rows)]
        assert len(set(pieces)) == 40 and len(pieces) <= 40 * shares
        assert sum(len(rows) > 0 for rows in tasks) > 3


def test_reports_of_requests_are_written_where_they_are_matched(spark, tmp_path, monkeypatch):
    """No shuffle and no sort of the matched rows, each request a compressed file of its own, in the order of the data."""
    from tidegauge.sources import manifest as M

    data = spark.range(600).select("id", F.when(F.col("id") % 2 == 0, "even").otherwise('o"d,d').alias("kind"))
    wanted = lambda i: [{"name": "kind", "operator": "EQ", "value": ["even", 'o"d,d', "none"][i % 3]}, {"name": "id", "operator": "GE", "value": str(i)}]
    requests = spark.createDataFrame(
        [("job", f"r/{i}", json.dumps({"filters": wanted(i)}), [], "SUBMITTED") for i in range(30)],
        "job_id string, request_id string, request_data string, download_urls array<string>, status string",
    )
    seen, write = [], J.write_report_lines
    monkeypatch.setattr(J, "write_report_lines", lambda df, *args: (seen.append(df), write(df, *args)))
    done = J.reports_by_request(requests, data, "job", str(tmp_path), F.lit("2024-06-01").cast("timestamp"))
    above = seen[0]._jdf.queryExecution().executedPlan().toString().split("SortMergeJoin")[0]
    assert "Exchange" not in above and "Sort" not in above
    found = {r.request_id: r for r in done.collect()}
    assert len(found) == 30 and all(r.status == "COMPLETED" for r in found.values())
    urls = [url for r in found.values() for url in r.download_urls]
    assert len(set(urls)) == len(urls) == 20 and all(url.endswith(".csv.zst") for url in urls)
    expected = lambda i: [n for n in range(i, 600) if i % 3 != 2 and n % 2 == i % 3]
    for i in (0, 1, 2, 13):
        url = found[f"r/{i}"].download_urls
        lines = pa.input_stream(url[0], compression="zstd").read().decode().splitlines() if url else ["id,kind"]
        assert lines[0] == "id,kind" and [int(line.split(",")[0]) for line in lines[1:]] == expected(i)
    back = sorted((r.request_id, int(r.id), r.kind) for r in M.read_report_files(spark, str(tmp_path)).collect())
    assert back == sorted((f"r/{i}", n, "even" if n % 2 == 0 else 'o"d,d') for i in range(30) for n in expected(i))


def test_metric_records_of_a_failed_model(spark, config, tmp_path):
    def fails(data, params):
        raise ValueError("no")

    sink = {"to": "file", "params": {"file": str(tmp_path / "metrics")}}
    from tidegauge.schemas import Dispatcher

    status = J.run_models(
        spark, JobConfig.from_dict(config), [FunctionModel("Failing", fails)], metric_sinks=[Dispatcher(sink["to"], sink["params"])], now=123
    ).first()
    assert (status.status, status.input_events, status.message) == ("FAILED", len(SHORT) + 1 + len(LONG), "no")
    record = spark.read.json(str(tmp_path / "metrics")).first()
    assert (record.metricts, record.subsystem, record.metrics[0].value) == (123, "Failing", 26.0)


def test_streaming_job_from_json(spark, config, tmp_path):
    config["search"]["queries"][0]["file"] = str(tmp_path / "in")
    config["modelParams"]["checkpoint"] = str(tmp_path / "place")
    J.run_job(spark, "streaming", json.dumps(config), [WorkflowSummaryModel()]).awaitTermination()
    assert spark.read.option("recursiveFileLookup", True).json(str(tmp_path / "out")).count() == 10
    config["modelParams"].pop("checkpoint")
    with pytest.raises(ValueError, match="checkpoint"):
        J.run_job(spark, "streaming", config, [])
