"""Event, summary and configuration shapes.

Every numeric field that senders may write as ``1.5E12`` is read as double and cast afterwards: parsing it
straight into bigint yields null.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

_PDATA = "struct<id:string,ver:string,pid:string,model:string>"
_ROLLUP = "struct<l1:string,l2:string,l3:string,l4:string>"
_CDATA = "array<struct<id:string,type:string>>"
_CONTEXT = (
    f"struct<channel:string,pdata:{_PDATA},env:string,sid:string,did:string,cdata:{_CDATA},rollup:{_ROLLUP}>"
)
_OBJECT = (
    f"struct<id:string,type:string,ver:string,rollup:{_ROLLUP},subtype:string,"
    "parent:struct<id:string,type:string,ver:string>>"
)
_ITEM = (
    "struct<id:string,maxscore:double,exlength:double,params:array<map<string,string>>,uri:string,desc:string,"
    "title:string,mmc:array<string>,mc:array<string>,type:string>"
)

# V3 telemetry event, the input of the workflow summary.
V3_EVENT = (
    "eid string, ets double, `@timestamp` string, ver string, mid string, actor struct<id:string,type:string>, "
    f"context {_CONTEXT}, object {_OBJECT}, "
    f"edata struct<type:string,mode:string,duration:double,pageid:string,item:{_ITEM},"
    "resvalues:array<map<string,string>>,pass:string,score:double>, tags array<string>"
)

# Legacy (v1/v2) event with its payload under edata.eks.
LEGACY_EVENT = (
    "eid string, ts string, ets double, `@timestamp` string, ver string, mid string, channel string, "
    "gdata struct<id:string,ver:string>, sid string, uid string, did string, pdata struct<id:string,ver:string,pid:string>, "
    "edata struct<eks:struct<qid:string,score:double,pass:string,length:string,type:string,id:string,"
    "subtype:string,mode:string,res:array<string>,resvalues:array<map<string,string>>,mc:array<string>>,"
    "ext:map<string,string>>, tags array<map<string,array<string>>>, "
    "cdata array<struct<id:string,type:string>>, metadata struct<sync_timestamp:string,public:string>"
)

# Summary event as written by the workflow summary.
SUMMARY_EVENT = (
    "eid string, ets bigint, syncts bigint, ver string, mid string, uid string, "
    "context struct<pdata:struct<id:string,ver:string,model:string>,granularity:string,"
    f"date_range:struct<from:bigint,to:bigint>,rollup:{_ROLLUP},cdata:{_CDATA}>, "
    "dimensions struct<did:string,pdata:struct<id:string,ver:string,pid:string>,sid:string,channel:string,"
    "type:string,mode:string>, "
    "edata struct<eks:struct<start_time:bigint,end_time:bigint,time_diff:double,time_spent:double,"
    "telemetry_version:string,item_responses:array<struct<itemId:string,timeSpent:double,res:array<string>,"
    "resValues:array<map<string,string>>,mc:array<string>,mmc:array<string>,score:int,time_stamp:bigint,"
    "maxScore:double,pass:string,qtitle:string,qdesc:string>>,interact_events_count:bigint,"
    "interact_events_per_min:double,env_summary:array<struct<env:string,time_spent:double,count:bigint>>,"
    "events_summary:array<struct<id:string,count:bigint>>,"
    "page_summary:array<struct<id:string,type:string,env:string,time_spent:double,visit_count:bigint>>>>, "
    f"tags array<string>, object {_OBJECT}"
)

# Derived event of the v3 family and the profile event of the v1 family (used by the filter language).
V3_DERIVED_EVENT = (
    "eid string, ets bigint, `@timestamp` string, ver string, mid string, actor struct<id:string,type:string>, "
    f"context {_CONTEXT}, object {_OBJECT}, edata string"
)
PROFILE_EVENT = (
    "eid string, ts string, `@timestamp` string, ver string, gdata struct<id:string,ver:string>, sid string, "
    "uid string, did string, pdata struct<id:string,ver:string>, channel string, edata string"
)

JOB_LOG_EVENT = (
    "eid string, ets bigint, context struct<pdata:struct<id:string,pid:string>>, "
    "edata struct<status:string,data:struct<model:string,date:string,inputEvents:bigint,outputEvents:bigint,"
    "timeTaken:double,statusMsg:string>>"
)


@dataclass(frozen=True)
class Filter:
    name: str
    operator: str
    value: Any = None


@dataclass(frozen=True)
class Sort:
    name: str
    order: str = "asc"


@dataclass(frozen=True)
class Query:
    """One object-store or local scan request."""

    bucket: str | None = None
    prefix: str | None = None
    start_date: str | None = None
    end_date: str | None = None
    delta: int | None = None
    folder: str | None = None
    file: str | None = None
    exclude: str | None = None
    date_pattern: str | None = None
    partitions: tuple[int, ...] | None = None


@dataclass(frozen=True)
class Fetcher:
    type: str
    query: Query | None = None
    queries: tuple[Query, ...] | None = None


@dataclass(frozen=True)
class Dispatcher:
    to: str
    params: dict[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class StorageConfig:
    store: str
    container: str | None = None
    file_name: str = ""
    account: str | None = None


@dataclass(frozen=True)
class JobConfig:
    search: Fetcher
    model: str
    filters: tuple[Filter, ...] = ()
    sort: Sort | None = None
    model_params: dict[str, Any] = field(default_factory=dict)
    output: tuple[Dispatcher, ...] = ()
    app_name: str = "tidegauge"

    @staticmethod
    def from_dict(raw: dict[str, Any]) -> JobConfig:
        """Read the JSON job configuration (camelCase keys)."""
        search = raw["search"]

        def query(q: dict[str, Any]) -> Query:
            return Query(
                bucket=q.get("bucket"),
                prefix=q.get("prefix"),
                start_date=q.get("startDate"),
                end_date=q.get("endDate"),
                delta=q.get("delta"),
                folder=q.get("folder"),
                file=q.get("file"),
                exclude=q.get("excludePrefix", q.get("exclude")),
                date_pattern=q.get("datePattern"),
                partitions=tuple(q["partitions"]) if q.get("partitions") else None,
            )

        queries = search.get("queries")
        single = search.get("query")
        fetcher = Fetcher(
            type=search["type"],
            query=query(single) if single else None,
            queries=tuple(query(q) for q in queries if q) if queries is not None else None,
        )
        sort = raw.get("sort")
        return JobConfig(
            search=fetcher,
            model=raw.get("model", ""),
            filters=tuple(Filter(f["name"], f["operator"], f.get("value")) for f in raw.get("filters") or ()),
            sort=Sort(sort["name"], sort.get("order") or "asc") if sort else None,
            model_params=dict(raw.get("modelParams") or {}),
            output=tuple(Dispatcher(o["to"], dict(o.get("params") or {})) for o in raw.get("output") or ()),
            app_name=raw.get("appName") or "tidegauge",
        )


@dataclass(frozen=True)
class MergeConfig:
    rollup: int
    dims: tuple[str, ...] = ()
    rollup_age: str | None = None
    rollup_range: int = 1
    rollup_col: str | None = None
    rollup_format: str | None = None
    date_required: bool = True
    column_order: tuple[str, ...] = ()
    metric_labels: tuple[str, ...] = ()
