"""A Spark data source for questionnaire responses behind a paged web interface.

``spark.read.format("paged_responses")`` and ``spark.readStream`` over an interface that answers
``GET url?page_size=&before=&since=&until=`` with ``{"items": [{"token", "submitted_at", ...}, ...]}``,
newest first, ``before`` being the token that a page continues from. A batch splits the time between
``since`` and ``until`` into partitions that walk their own pages at the same time. A stream's offset is
a time: a batch of it holds what was submitted from one offset up to the next, so a restart reads the
same rows again. Requests that fail are repeated with growing pauses.

Options: url; since, until (ISO times; until is now by default); partitions (of a batch); pagesize (100
to 1000); retries; delay (seconds that a stream stays behind the clock, for what arrives late).
"""

from __future__ import annotations

import datetime
import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

SCHEMA = "token string, submitted_at timestamp, hidden string, answers string"


def _time(text: str) -> datetime.datetime:
    told = datetime.datetime.fromisoformat(text)
    return told if told.tzinfo else told.replace(tzinfo=datetime.timezone.utc)


@dataclass
class Span(InputPartition):
    """Responses submitted from ``since`` on and before ``until``."""

    since: str
    until: str


class _Pages:
    """Walks the pages of a span."""

    def __init__(self, options: dict[str, str]) -> None:
        self.url = options["url"]
        self.size = min(max(int(options.get("pagesize", 1000)), 100), 1000)
        self.retries = int(options.get("retries", 4))

    def ask(self, **query: str | int) -> dict:
        address = f"{self.url}?{urllib.parse.urlencode(query)}"
        for attempt in range(self.retries + 1):
            try:
                with urllib.request.urlopen(address, timeout=60) as answer:
                    return json.load(answer)
            except urllib.error.HTTPError as e:
                if e.code < 500 and e.code != 429 or attempt == self.retries:
                    raise
            except (urllib.error.URLError, TimeoutError, ConnectionError, json.JSONDecodeError):
                if attempt == self.retries:
                    raise
            time.sleep(min(0.2 * 2**attempt, 30))
        raise AssertionError("unreachable")

    def rows(self, span: Span) -> Iterator[tuple]:
        since, until, before = _time(span.since), _time(span.until), None
        while True:
            items = self.ask(page_size=self.size, since=span.since, until=span.until, **({"before": before} if before else {})).get("items") or []
            for item in items:
                at = _time(item["submitted_at"])
                if since <= at < until:  # interfaces differ in whether ends belong to a span
                    yield item["token"], at, json.dumps(item.get("hidden"), sort_keys=True), None if item.get("answers") is None else json.dumps(item["answers"], sort_keys=True)
            last, before = before, items[-1]["token"] if items else None
            if len(items) < self.size or before == last:
                return


class _Batch(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.pages, self.options = _Pages(options), options

    def partitions(self) -> list[Span]:
        since = _time(self.options.get("since", "1970-01-01"))
        until = _time(self.options["until"]) if "until" in self.options else datetime.datetime.now(datetime.timezone.utc)
        n = max(1, int(self.options.get("partitions", 1)))
        cuts = [since + (until - since) * k / n for k in range(n)] + [until]
        return [Span(a.isoformat(), b.isoformat()) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if a < b]

    def read(self, partition: Span) -> Iterator[tuple]:
        return self.pages.rows(partition)


class _Stream(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.pages, self.options = _Pages(options), options

    def initialOffset(self) -> dict:  # noqa: N802 (Spark's name)
        return {"until": _time(self.options.get("since", "1970-01-01")).isoformat()}

    def latestOffset(self) -> dict:  # noqa: N802
        now = datetime.datetime.now(datetime.timezone.utc) - datetime.timedelta(seconds=float(self.options.get("delay", 0)))
        last = _time(self.options["until"]) if "until" in self.options else now
        return {"until": min(last, now).isoformat()}

    def partitions(self, start: dict, end: dict) -> list[Span]:
        return [Span(start["until"], end["until"])] if _time(start["until"]) < _time(end["until"]) else []

    def read(self, partition: Span) -> Iterator[tuple]:
        return self.pages.rows(partition)


class PagedResponses(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_responses"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Batch(dict(self.options))

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:  # noqa: N802
        return _Stream(dict(self.options))


def register(spark: SparkSession) -> None:
    """Let the session read the format ``paged_responses``."""
    spark.dataSource.register(PagedResponses)
