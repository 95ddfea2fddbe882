"""Sinks for rows: console, text files, object stores, Kafka, and write-back to a database."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.schemas import Dispatcher, StorageConfig
from tidegauge.sources.paths import storage_uri
from tidegauge.sources.readers import count_rows


class DispatchError(ValueError):
    """A sink is missing or lacks a setting."""


def to_lines(df: DataFrame) -> DataFrame:
    """Rows as JSON text in ``value``; a frame of one text column passes through."""
    if len(df.columns) == 1 and isinstance(df.schema[0].dataType, T.StringType):
        return df.toDF("value")
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value"))


def _needs(params: Mapping[str, Any], *names: str) -> None:
    missing = [n for n in names if not params.get(n)]
    if missing:
        raise DispatchError(f"sink settings missing: {', '.join(missing)}")


def _console(lines: DataFrame, params: Mapping[str, Any]) -> None:
    # The full pass comes first: rows are counted in the first action. Printing brings one partition at a time.
    lines.write.format("noop").mode("overwrite").save()
    if params.get("printEvent", True):
        shown = lines.limit(int(params["rows"])) if params.get("rows") else lines
        for row in shown.toLocalIterator():
            print(row.value)


def _text(lines: DataFrame, path: str, params: Mapping[str, Any]) -> None:
    writer = lines.write.mode("overwrite")
    if params.get("compression"):
        writer = writer.option("compression", params["compression"])
    writer.text(path)


def _file(lines: DataFrame, params: Mapping[str, Any]) -> None:
    _needs(params, "file")
    _text(lines, params["file"], params)


def _object_store(lines: DataFrame, params: Mapping[str, Any]) -> None:
    _needs(params, "bucket", "key")
    _text(lines, storage_uri("s3", params["bucket"], params["key"]), params)


def kafka_options(params: Mapping[str, Any]) -> dict[str, str]:
    _needs(params, "brokerList", "topic")
    return {
        "kafka.bootstrap.servers": params["brokerList"],
        "topic": params["topic"],
        "kafka.compression.type": "snappy",
        "kafka.batch.size": str(params.get("batchSize", 100)),
        "kafka.linger.ms": str(params.get("lingerMs", 10)),
    }


def _kafka(lines: DataFrame, params: Mapping[str, Any]) -> None:
    lines.write.format("kafka").options(**kafka_options(params)).save()


SINKS: dict[str, Callable[[DataFrame, Mapping[str, Any]], None]] = {
    "console": _console,
    "file": _file,
    "s3": _object_store,
    "oci": _object_store,
    "kafka": _kafka,
}


def dispatch(df: DataFrame, sink: Dispatcher) -> int:
    """Write to one sink and return the number of rows, counted while writing."""
    if sink.to not in SINKS:
        raise DispatchError(f"unknown sink {sink.to}")
    lines, rows = count_rows(to_lines(df), f"dispatch-{sink.to}")
    SINKS[sink.to](lines, sink.params)
    return rows.get["rows"]


#: The setting of a sink that names where its files go.
_PLACES = {"file": "file", "s3": "key", "oci": "key"}


def placed(sinks: Iterable[Dispatcher] | None, *folders: str) -> list[Dispatcher]:
    """The sinks with their files in folders of their own, so that several results don't replace each other."""
    out = []
    for sink in sinks or ():
        name = _PLACES.get(sink.to)
        if name and sink.params.get(name) and folders:
            sink = Dispatcher(sink.to, {**sink.params, name: "/".join([sink.params[name].rstrip("/"), *folders])})
        out.append(sink)
    return out


def dispatch_all(df: DataFrame, sinks: Iterable[Dispatcher] | None) -> int:
    """Write to every sink. With several sinks the rows are computed once and kept for the others."""
    sinks = list(sinks or ())
    if not sinks:
        raise DispatchError("no sink configured")
    unknown = [s.to for s in sinks if s.to not in SINKS]
    if unknown:
        raise DispatchError(f"unknown sink {unknown[0]}")
    if len(sinks) == 1:
        return dispatch(df, sinks[0])
    kept = to_lines(df).persist()
    try:
        return [dispatch(kept, sink) for sink in sinks][-1]
    finally:
        kept.unpersist()


def dispatch_storage(df: DataFrame, config: StorageConfig) -> int:
    """Write lines under a storage configuration and return the number of rows."""
    if config.store.lower() not in ("s3", "oci", "local"):
        raise DispatchError(f"unknown store {config.store}")
    lines, rows = count_rows(to_lines(df), "dispatch-storage")
    _text(lines, storage_uri(config.store, config.container, config.file_name), {})
    return rows.get["rows"]


def completion_statement(table: str) -> str:
    """Write-back statement; every value is bound, none is written into the text."""
    if not table.replace("_", "").replace(".", "").isalnum():
        raise ValueError(f"not a table name: {table}")
    return f"UPDATE {table} SET status = 'COMPLETED', download_urls = ?, dt_job_completed = ? WHERE request_id = ?"


def complete_requests(
    requests: DataFrame, table: str, connect: Callable[[], Any], batch: int = 500, placeholder: str = "?"
) -> None:
    """Mark requests as completed, in batches per partition over a DB-API connection opened in the task.

    ``dt_job_completed`` is the time of the job; without such a column, the current time.
    """
    if "dt_job_completed" not in requests.columns:
        requests = requests.withColumn("dt_job_completed", F.current_timestamp())
    requests = requests.withColumn("dt_job_completed", F.col("dt_job_completed").cast("string"))
    statement = completion_statement(table).replace("?", placeholder)

    def update(rows):
        connection, pending = connect(), []
        try:
            cursor = connection.cursor()
            for row in rows:
                pending.append((",".join(row.download_urls or []), row.dt_job_completed, row.request_id))
                if len(pending) >= batch:
                    cursor.executemany(statement, pending)
                    connection.commit()
                    pending = []
            if pending:
                cursor.executemany(statement, pending)
                connection.commit()
        finally:
            connection.close()

    requests.select("request_id", "download_urls", "dt_job_completed").foreachPartition(update)
