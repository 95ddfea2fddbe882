"""Report files: one per report, or one per value of the dimension columns.

The layout does not depend on the size: a report (or dimension value) is a folder ``<name>.<format>`` of the parts that
Spark wrote in parallel, which every Spark reader takes like a file. With ``one_file`` it is a single file instead, and
then the rows of a report or of a dimension value pass through one task; the caller vouches that they are few.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidegauge.operators.merge import (
    merge_report, normalise_delta, output_columns, parsed_date, report_documents, rollup_spec,
)
from tidegauge.schemas import MergeConfig, StorageConfig
from tidegauge.session import ensure_checkpoint_dir
from tidegauge.sources.paths import storage_uri
from tidegauge.sources.readers import read_report

_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
#: Folders moved at a time; a move is a request to the store, or a copy there.
MOVERS = 16


def _file_value(folder: str) -> str:
    """A dimension value in a file name. Missing values are ``null``, so the text of that name is written escaped."""
    value = folder.split("=", 1)[1]
    if value == _NULL_FOLDER:
        return "null"
    return "%6Eull" if value == "null" else value


class _Folder:
    """File operations on the file system that holds a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.fs = self.path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, text: str):
        return self.jvm.org.apache.hadoop.fs.Path(text)

    def delete(self, text: str) -> None:
        self.fs.delete(self.path(text), True)

    def move(self, source: str, target: str) -> None:
        self.delete(target)
        self.fs.mkdirs(self.path(target).getParent())
        if not self.fs.rename(self.path(source), self.path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def parts(self, text: str) -> list[str]:
        names = [str(s.getPath().toString()) for s in self.fs.listStatus(self.path(text))]
        return sorted(n for n in names if n.rsplit("/", 1)[-1].startswith("part-"))

    def leaves(self, text: str, depth: int) -> list[str]:
        """Folders ``depth`` levels below the path."""
        pattern = text + "/*=*" * depth
        return sorted(str(s.getPath().toString()) for s in self.fs.globStatus(self.path(pattern)) or [])

    def settle(self, folder: str, target: str, one_file: bool) -> None:
        """Give a written folder its final name, or the name to its single part."""
        parts = self.parts(folder) if one_file else []
        if len(parts) > 1:
            raise ValueError(f"{folder} has {len(parts)} parts")
        self.move(parts[0] if parts else folder, target)


def write_report(
    df: DataFrame,
    storage: StorageConfig,
    format: str,
    report_id: str,
    options: Mapping[str, str] | None = None,
    dims: Sequence[str] = (),
    column_order: Sequence[str] = (),
    file_ext: str | None = None,
    compress: bool = False,
    one_file: bool = False,
    order: Sequence = (),
) -> list[str]:
    """Write a report and return its paths; an existing report of the name is replaced.

    ``dims`` gives one path per distinct value combination at ``<report>/<v1>/<v2>.<format>``; dimension columns
    are left out of the file. ``order`` sorts rows inside the files. Each call has a temporary folder of its own.
    """
    spark = df.sparkSession
    base = storage_uri(storage.store, storage.container, storage.file_name, storage.account).rstrip("/")
    final, temp = f"{base}/{report_id}", f"{base}/_tmp-{report_id}-{uuid.uuid4().hex}"
    ext = file_ext or format
    if compress:
        options, ext = {**(options or {}), "compression": "gzip"}, f"{ext}.gz"
    dims = list(dims)
    if column_order:
        df = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*column_order, *dims])])
    folder = _Folder(spark, base)
    try:
        if not dims:
            rows = df.coalesce(1) if one_file else df
            rows = rows.sortWithinPartitions(*order) if order else rows
            rows.write.format(format).options(**(options or {})).save(temp)
            folder.settle(temp, f"{final}.{ext}", one_file)
            return [f"{final}.{ext}"]
        # Rebalancing brings a value's rows together and lets Spark split a value that is too large for one task.
        rows = df.repartition(*dims) if one_file else df.hint("rebalance", *[F.col(d) for d in dims])
        rows.sortWithinPartitions(*dims, *order).write.format(format).options(**(options or {})).partitionBy(*dims).save(temp)
        targets = {
            leaf: "/".join([final, *map(_file_value, leaf.rsplit("/", len(dims))[1:])]) + f".{ext}"
            for leaf in folder.leaves(temp, len(dims))
        }
        with ThreadPoolExecutor(MOVERS) as movers:
            list(movers.map(lambda leaf: folder.settle(leaf, targets[leaf], one_file), targets))
        return list(targets.values())
    finally:
        folder.delete(temp)


def merge_report_files(
    spark: SparkSession, config: MergeConfig, report_path: str, delta_path: str, today: str, store: str = "local",
    container: str | None = None, one_file: bool = False, account: str | None = None, delta_at: StorageConfig | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Merge a delta file into a report file: back the old report up, then write CSV and JSON.

    The delta may lie elsewhere (``delta_at``): in another container, or in one of another account. Which account a path names
    settles which key Spark uses, so private and public files are told apart by their accounts. A missing report means the
    delta becomes the report on a plain file system; in a store an empty one with ``schema`` (the delta's, by default).
    The merged rows are written to the checkpoint folder before the report they were read from is replaced. A failure to
    write is raised.
    """
    ensure_checkpoint_dir(spark)
    name, pattern = rollup_spec(config)
    source = delta_at or StorageConfig(store, container, "", account)
    delta = read_report(spark, storage_uri(source.store, source.container, delta_path, source.account))
    if delta is None:
        raise FileNotFoundError(delta_path)
    delta = normalise_delta(delta, name, pattern)
    old = read_report(spark, storage_uri(store, container, report_path, account))
    if old is None:
        old = delta if store == "local" else spark.createDataFrame([], schema or delta.schema)
    columns = output_columns(old, config)
    merged = merge_report(old, delta, config).checkpoint()
    old = old.checkpoint()
    folder, _, file = report_path.rpartition("/")
    stem = file.rsplit(".", 1)[0]
    header = {"header": "true"}

    def save(rows: DataFrame, where: str, report_id: str, order: Sequence[str]) -> None:
        target = StorageConfig(store, container, where, account)
        by_date = [parsed_date(name, pattern)] if name in rows.columns else []
        documents = report_documents(rows, columns, config.metric_labels, order=by_date)
        write_report(documents, target, "json", report_id, one_file=one_file)
        write_report(rows, target, "csv", report_id, header, column_order=order, order=by_date, one_file=one_file)

    save(old, f"{folder}/report-backups", f"{stem}-{today}", ())
    save(merged, folder or ".", stem, columns)
    return merged


def merge_all_report_files(
    spark: SparkSession, config: MergeConfig, files: Sequence[tuple[str, str]], today: str, report_at: StorageConfig,
    delta_at: StorageConfig | None = None, one_file: bool = False,
) -> list[DataFrame]:
    """Every (report, delta) pair of a configuration, in order. A report that is not there yet takes the columns of the pair
    before it, if that had one."""
    schema, merged = None, []
    for report_path, delta_path in files:
        there = read_report(spark, storage_uri(report_at.store, report_at.container, report_path, report_at.account))
        schema = there.schema if there is not None else schema
        merged.append(merge_report_files(
            spark, config, report_path, delta_path, today, report_at.store, report_at.container, one_file, report_at.account,
            delta_at, schema,
        ))
    return merged
