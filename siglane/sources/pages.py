"""Pages of adverse-event reports as a data source: a partition for each page asked for and for each file of pages,
filters put into the question.

``spark.read.format("report_pages")`` has safetyreportid, receiptdate, serious and report, the report as JSON; reports()
gives them in the service's nested columns. Options: ``files``, a JSON list of files of one page or of several, one
after the other, or ``reports``, how many
reports the service is to be asked for, with ``limit`` of them a page, ``base_url``, ``api_key``, and what
EventQuery takes (drug, event, serious_only, date_from, date_to).
"""

from __future__ import annotations

import io
import json
import time
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThanOrEqual, InputPartition, LessThanOrEqual

from siglane.session import file_system, prepare
from siglane.sources import openfda

SCHEMA = "safetyreportid string, receiptdate string, serious string, report string"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
#: How often a page is asked for while the service says to wait.
TRIES = 5
#: Reports of an Arrow batch.
BATCH = 1000


@dataclass
class Page(InputPartition):
    file: str | None = None
    skip: int = 0


def _texts(page: Page, query: openfda.EventQuery, base_url: str, api_key: str | None) -> Iterator[str]:
    """The pages of a partition, one at a time; a file whose first line is no whole page is one page."""
    if page.file:
        from pyarrow import fs  # its threads are not for the process that starts Python workers

        files, path = fs.FileSystem.from_uri(page.file)
        # A name that ends in .gz is unpacked as it is read.
        with files.open_input_stream(path) as stream, io.TextIOWrapper(stream, encoding="utf-8") as lines:
            first = next((line for line in lines if line.strip()), None)
            if first is None:  # a task without rows leaves an empty file
                return
            try:
                json.loads(first)
            except ValueError:
                yield first + lines.read()
                return
            yield first
            yield from (line for line in lines if line.strip())
        return
    for left in reversed(range(TRIES)):
        try:
            yield openfda.fetch(replace(query, skip=page.skip).url(api_key).replace(openfda.BASE_URL, base_url, 1))
            return
        except openfda.RateLimited as e:
            if not left:
                raise
            time.sleep(e.retry_after)
    raise openfda.Unavailable("no page")


class PageReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options
        self.wanted: list[Filter] = []
        given = {k: options[k] for k in ("drug", "event", "date_from", "date_to") if k in options}
        self.query = openfda.EventQuery(**given, serious_only=options.get("serious_only", "").lower() == "true", limit=min(int(options.get("limit", openfda.MOST)), openfda.MOST))

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes comparisons of serious and receiptdate: the service is asked for these reports only, and reports of page
        files that don't fit are never handed to Spark. All others are left to Spark."""
        dates: dict[type, str] = {}
        for f in filters:
            name = getattr(f, "attribute", None)
            if isinstance(f, EqualTo) and name in (("serious",), ("receiptdate",)) or isinstance(f, (GreaterThanOrEqual, LessThanOrEqual)) and name == ("receiptdate",):
                self.wanted.append(f)
                if isinstance(f, EqualTo) and name == ("serious",) and f.value == "1":
                    self.query = replace(self.query, serious_only=True)
                if name == ("receiptdate",):
                    dates[type(f)] = f.value
            else:
                yield f
        same = dates.get(EqualTo)
        low, high = dates.get(GreaterThanOrEqual, same), dates.get(LessThanOrEqual, same)
        if low and high and not self.query.date_from:
            self.query = replace(self.query, date_from=low, date_to=high)

    def partitions(self) -> list[Page]:
        if "files" in self.options:
            return [Page(file=f) for f in json.loads(self.options["files"])]
        return [Page(skip=k) for k in range(0, int(self.options["reports"]), self.query.limit)]

    def _fits(self, report: dict) -> bool:
        for f in self.wanted:
            value = report.get(f.attribute[0])
            if value is None or isinstance(f, EqualTo) and value != f.value or isinstance(f, GreaterThanOrEqual) and value < f.value or isinstance(f, LessThanOrEqual) and value > f.value:
                return False
        return True

    def read(self, page: Page) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        for text in _texts(page, self.query, self.options.get("base_url", openfda.BASE_URL), self.options.get("api_key")):
            try:
                found = json.loads(text).get("results", [])
            except (ValueError, AttributeError) as e:
                raise openfda.ParseError(str(e)) from e
            rows = [r for r in found if self._fits(r)]
            for k in range(0, len(rows), BATCH):
                some = rows[k : k + BATCH]
                columns = [[r.get(n) for r in some] for n in names[:3]] + [[json.dumps(r) for r in some]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=names)


class ReportPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "report_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PageReader:
        return PageReader(dict(self.options))


def page_files(spark: SparkSession, folder: str) -> list[str]:
    """All JSON and text files below a folder, those packed by gzip too, in order of their paths."""
    files, where = file_system(spark, folder)
    found, listed = files.listFiles(where, True), []
    while found.hasNext():
        path = found.next().getPath()
        if path.getName().removesuffix(".gz").endswith((".json", ".txt")) and not path.getName().startswith(("_", ".")):
            listed.append(str(path.toUri()))
    return sorted(listed)


def read_pages(spark: SparkSession, folder: str | None = None, **options) -> DataFrame:
    """The source's rows, of the page files of a folder or of the service."""
    prepare(spark).dataSource.register(ReportPages)
    # Spark asks for the filters that a Python source takes only where this is set; nothing else is changed by it.
    spark.conf.set(PUSHDOWN, "true")
    if folder:
        options["files"] = json.dumps(page_files(spark, folder))
    return spark.read.format("report_pages").options(**options).load()


def reports(rows: DataFrame) -> DataFrame:
    """Nested reports, as the client's drug_events() gives them."""
    # A generator is run once for a row; a plain column would be parsed anew for each filter and field that reads it.
    return rows.select(F.inline(F.array(F.from_json("report", openfda.REPORT_SCHEMA))))
