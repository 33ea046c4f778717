"""Adverse-event reports over REST: queries, fetching with a cache, and local counting."""

from __future__ import annotations

import json
import math
import time
import urllib.error
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from email.utils import parsedate_to_datetime
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE_URL = "https://api.fda.gov/drug/event.json"
MOST, DEFAULT_LIMIT, TTL_SECONDS, TIMEOUT_SECONDS, RETRY_SECONDS = 1000, 100, 900, 30, 60
_DRUG = "struct<drugcharacterization: string, medicinalproduct: string, openfda: struct<brand_name: array<string>, generic_name: array<string>, manufacturer_name: array<string>, product_ndc: array<string>, substance_name: array<string>>>"
_FLAGS = ("seriousnessdeath", "seriousnesslifethreatening", "seriousnesshospitalization", "seriousnessdisabling", "seriousnesscongenitalanomali", "seriousnessother")
REPORT_SCHEMA = (
    "safetyreportid string, receiptdate string, reporttype string, serious string, " + ", ".join(f"{f} string" for f in _FLAGS) + ", primarysource struct<reportercountry: string, qualification: string>, "
    f"patient struct<patientonsetage: string, patientonsetageunit: string, patientsex: string, patientweight: string, drug: array<{_DRUG}>, reaction: array<struct<reactionmeddrapt: string, reactionoutcome: string>>>"
)


class OpenFdaError(Exception):
    """Any failure of the service."""


class HttpError(OpenFdaError):
    pass


class ParseError(OpenFdaError):
    pass


class InvalidResponse(OpenFdaError):
    pass


class Unavailable(OpenFdaError):
    pass


class RateLimited(OpenFdaError):
    def __init__(self, retry_after: int = RETRY_SECONDS):
        super().__init__(f"retry after {retry_after} s")
        self.retry_after = retry_after


@dataclass(frozen=True)
class EventQuery:
    drug: str | None = None
    event: str | None = None
    limit: int = DEFAULT_LIMIT
    skip: int = 0
    serious_only: bool = False
    date_from: str | None = None
    date_to: str | None = None

    def with_limit(self, limit: int) -> EventQuery:
        return replace(self, limit=min(limit, MOST))

    def search(self) -> str:
        parts = []
        if self.drug:
            name = quote(f'"{self.drug}"')
            parts.append(f"(patient.drug.openfda.brand_name:{name}+OR+patient.drug.openfda.generic_name:{name})")
        if self.event:
            parts.append("patient.reaction.reactionmeddrapt:" + quote(f'"{self.event}"'))
        if self.serious_only:
            parts.append("serious:1")
        if self.date_from and self.date_to:
            parts.append(f"receiptdate:[{quote(self.date_from)}+TO+{quote(self.date_to)}]")
        return "+AND+".join(parts)

    def url(self, api_key: str | None = None) -> str:
        search = self.search()
        out = f"{BASE_URL}?" + (f"search={search}&" if search else "") + f"limit={min(self.limit, MOST)}"
        return out + (f"&skip={self.skip}" if self.skip else "") + (f"&api_key={quote(api_key)}" if api_key else "")


def _seconds(retry_after: str | None) -> int:
    """Seconds of a Retry-After header, which may be a date."""
    try:
        return int(retry_after)
    except (TypeError, ValueError):
        pass
    try:
        return max(0, math.ceil(parsedate_to_datetime(retry_after).timestamp() - time.time()))
    except (TypeError, ValueError):
        return RETRY_SECONDS


def fetch(url: str) -> str:
    try:
        with urllib.request.urlopen(url, timeout=TIMEOUT_SECONDS) as r:
            return r.read().decode()
    except urllib.error.HTTPError as e:
        if e.code == 429:
            raise RateLimited(_seconds(e.headers.get("Retry-After"))) from e
        raise InvalidResponse(f"status {e.code}") from e
    except OSError as e:
        raise HttpError(str(e)) from e


@dataclass
class OpenFdaClient:
    """Pages of reports as DataFrames. A response is kept for TTL_SECONDS, and used longer while the service fails."""

    spark: SparkSession
    api_key: str | None = None
    fetcher: Callable[[str], str] = fetch
    clock: Callable[[], float] = time.time
    cache: dict[str, tuple[float, list]] = field(default_factory=dict)

    def results(self, query: EventQuery) -> list:
        url = query.url(self.api_key)
        at, kept = self.cache.get(url, (float("-inf"), None))
        if kept is not None and self.clock() - at < TTL_SECONDS:
            return kept
        try:
            text = self.fetcher(url)
            try:
                found = json.loads(text).get("results", [])
            except (ValueError, AttributeError) as e:
                raise ParseError(str(e)) from e
        except OpenFdaError:
            if kept is None:
                raise
            return kept
        self.cache[url] = (self.clock(), found)
        return found

    def drug_events(self, query: EventQuery) -> DataFrame:
        # A page has MOST reports at most.
        rows = [(json.dumps(r),) for r in self.results(query)]
        text = self.spark.createDataFrame(rows, "value string")
        return text.select(F.from_json("value", REPORT_SCHEMA).alias("r")).select("r.*")

    def clear_cache(self) -> None:
        self.cache.clear()


def filter_reports(reports: DataFrame, query: EventQuery) -> DataFrame:
    """The query's conditions on reports that are here already."""
    out = reports
    if query.drug:
        name = query.drug.upper()

        def named(values):
            return F.exists(F.coalesce(values, F.array().cast("array<string>")), lambda v: F.upper(v) == name)

        out = out.filter(F.exists("patient.drug", lambda d: named(d["openfda"]["brand_name"]) | named(d["openfda"]["generic_name"])))
    if query.event:
        out = out.filter(F.exists("patient.reaction", lambda r: F.upper(r["reactionmeddrapt"]) == query.event.upper()))
    if query.serious_only:
        out = out.filter("serious = '1'")
    if query.date_from and query.date_to:
        out = out.filter(F.col("receiptdate").between(query.date_from, query.date_to))
    return out


def pair_counts(reports: DataFrame) -> DataFrame:
    """drug, event, n: every suspect drug (code exactly 1) of a report with every reaction of it."""
    rows = reports.select("patient.reaction", F.explode("patient.drug").alias("d")).filter("d.drugcharacterization = '1'")
    rows = rows.select(F.upper(F.coalesce("d.medicinalproduct", F.lit(""))).alias("drug"), F.explode("reaction").alias("r"))
    return rows.groupBy("drug", F.upper(F.coalesce("r.reactionmeddrapt", F.lit(""))).alias("event")).agg(F.count("*").alias("n"))
