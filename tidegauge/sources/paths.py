"""Where the data lies: storage URIs and date-expanded scan paths."""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import date, datetime, timedelta

from tidegauge.schemas import Query

# Scan defaults of the job configuration (fixed values).
DEFAULT_PREFIX = "raw/"
DEFAULT_DATE_PATTERN = "yyyy-MM-dd"
_STRFTIME = {"yyyy": "%Y", "MM": "%m", "dd": "%d", "HH": "%H"}


def storage_uri(store: str, container: str | None, path: str, account: str | None = None) -> str:
    """Full URI of a path in an object store, or the path itself on a plain file system."""
    store = store.lower()
    if store in ("s3", "oci", "aws"):
        return f"s3a://{container}/{path}"
    if store == "azure":
        if not account:
            raise ValueError("an azure path needs its storage account")
        return f"wasb://{container}@{account}.blob.core.windows.net/{path}"
    if store == "gcloud":
        return f"gs://{container}/{path}"
    if store in ("local", "file"):
        return path
    raise ValueError(f"unknown store {store}")


def _day(text: str | None) -> date:
    return datetime.strptime(text, "%Y-%m-%d").date() if text else date.today()


def date_text(day: date, pattern: str) -> str:
    for letters, code in _STRFTIME.items():
        pattern = pattern.replace(letters, code)
    return day.strftime(pattern)


def date_expression(pattern: str) -> str:
    """Regular expression for a date in the pattern, with groups y, m and d."""
    groups = {"yyyy": r"(?P<y>\d{4})", "MM": r"(?P<m>\d{2})", "dd": r"(?P<d>\d{2})", "HH": r"\d{2}"}
    text = re.escape(pattern)
    for letters, group in groups.items():
        text = text.replace(letters, group)
    if not all(letters in pattern for letters in ("yyyy", "MM", "dd")):
        raise ValueError(f"a day cannot be read from {pattern}")
    return text


def query_days(query: Query) -> list[date]:
    """Days of a query: from its start date, or ``delta`` days back from its end; empty when start is after end."""
    end = _day(query.end_date)
    start = _day(query.start_date) if query.start_date else end - timedelta(days=query.delta or 0)
    return [start + timedelta(days=i) for i in range((end - start).days + 1)]


def object_paths(query: Query, store: str = "s3", account: str | None = None) -> list[str]:
    """Scan paths of an object-store query.

    Dates are written into the paths, so the store lists only what the query asks for. A folder query reads the
    end date's whole folder.
    """
    if not query.bucket:
        raise ValueError("an object store query needs its bucket")
    bucket, prefix = query.bucket, query.prefix or DEFAULT_PREFIX
    pattern = query.date_pattern or DEFAULT_DATE_PATTERN
    if query.folder:
        day = date_text(_day(query.end_date), pattern)
        return [storage_uri(store, bucket, f"{prefix}{day}/*", account)]
    return [storage_uri(store, bucket, f"{prefix}{date_text(day, pattern)}*", account) for day in query_days(query)]


def partition_pattern(query: Query) -> str | None:
    """Pattern of file names of the wanted numbered partitions, e.g. ``2020-03-04-3-``."""
    if not query.partitions:
        return None
    numbers = "|".join(str(n) for n in query.partitions)
    return rf"\d{{4}}-\d{{2}}-\d{{2}}-({numbers})-"


def keep_paths(paths: Iterable[str | None], query: Query) -> list[str]:
    """Known paths without nulls, repeats and excluded ones, and only of the wanted partitions."""
    wanted = partition_pattern(query)
    kept = [p for p in dict.fromkeys(paths) if p and not (query.exclude and query.exclude in p)]
    return [p for p in kept if re.search(wanted, p)] if wanted else kept
