"""Models: dataset in, dataset out, and the jobs built from them."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.operators import workflow
from tidegauge.operators.aggregates import collect_events
from tidegauge.operators.filters import filter_events
from tidegauge.schemas import Filter

Params = Mapping[str, Any]


class Model:
    """Three DataFrame steps chained in order; a step that is not overridden passes its input on."""

    name = "Model"
    # Whether the model reads its input more than once or first in part (a sampled range partition does), so that
    # a count taken while the input is read would be wrong.
    rereads = False

    def prepare(self, data: DataFrame, params: Params) -> DataFrame:
        return data

    def compute(self, data: DataFrame, params: Params) -> DataFrame:
        return data

    def finish(self, data: DataFrame, params: Params) -> DataFrame:
        return data

    def execute(self, data: DataFrame, params: Params | None = None) -> DataFrame:
        params = params or {}
        return (
            data.transform(self.prepare, params)
            .transform(self.compute, params)
            .transform(self.finish, params)
        )


class FunctionModel(Model):
    """A model that is one function of a frame and its parameters."""

    def __init__(self, name: str, fn: Callable[[DataFrame, Params], DataFrame]):
        self.name, self.fn = name, fn

    def compute(self, data: DataFrame, params: Params) -> DataFrame:
        return self.fn(data, params)


class WorkflowSummaryModel(Model):
    """Raw lines to enveloped session summaries."""

    name = "WorkflowSummaryModel"
    rereads = True

    def prepare(self, data: DataFrame, params: Params) -> DataFrame:
        return workflow.read_events(data, params.get("explodeEnvelope", False))

    def compute(self, data: DataFrame, params: Params) -> DataFrame:
        flat = workflow.workflow_summary(
            data, params.get("idleTime", 600), params.get("sessionBreakTime", 30), params.get("blocks")
        )
        created = params.get("now")
        return workflow.summary_events(
            flat,
            F.current_timestamp() if created is None else F.lit(created).cast("timestamp"),
            params.get("producerId", "AnalyticsDataPipeline"),
            params.get("modelVersion", "1.0"),
            params.get("modelId", "WorkflowSummarizer"),
        )

    def finish(self, data: DataFrame, params: Params) -> DataFrame:
        return workflow.envelope(data, params.get("dataset", "wfs-telemetry"))


class DeviceEventsModel(Model):
    """Events of one kind, collected per device."""

    name = "DeviceEventsModel"

    def prepare(self, data: DataFrame, params: Params) -> DataFrame:
        return filter_events(data, Filter("eid", "EQ", params.get("eid", "START")))

    def compute(self, data: DataFrame, params: Params) -> DataFrame:
        return collect_events(data, [params.get("key", "did")], params.get("perList", 1000))


class EventTextModel(Model):
    """Events of the given kinds (all, when none are given) as JSON text."""

    name = "EventTextModel"

    def compute(self, data: DataFrame, params: Params) -> DataFrame:
        if params.get("eids"):
            data = filter_events(data, Filter("eid", "IN", list(params["eids"])))
        return data.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in data.columns])).alias("value"))
