"""Cached pages, task shards, JSON documents and HTML tables as tables; small tables as Markdown."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions.entity import state_code
from tallyforge.sources.files import read_csv

#: What is read of a cached page.
PAGE = "status string, url string, data struct<markdown:string>, metadata struct<query_time:string>"
PAGES = "array<struct<url:string,title:string,text:string,observed_at:string,hash:string>>"
#: Where a cached account lies, as its reference ends.
REFERENCE = r"/(task-[^/]+)/raw/(account_[^/]+)$"
SUMMARY = "structured_summary.json"


def json_documents(spark: SparkSession, path: str) -> DataFrame:
    """path and document: whole files as text, without a byte order mark; what isn't an object reads {}."""
    text = F.regexp_replace(F.decode("content", "UTF-8"), "^\ufeff", "")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", F.when(F.startswith(F.ltrim(text), F.lit("{")), text).otherwise("{}").alias("document"))


def page_cache(spark: SparkSession, root: str, accounts: DataFrame) -> DataFrame:
    """accounts (account, scored, reference) with pages, summary (JSON), evidence_hash and missing_reason.

    An account's files lie in `root/tasks/<task>/raw/<account folder>`.  They are read where they lie, all accounts at once;
    an account's pages are few, and meet in its row.  Reasons, the first that holds: not scored, a reference that names no
    folder, a folder that isn't there, a summary of another account, no page that can be used.
    """
    ref = F.regexp_replace(F.replace(F.coalesce("reference", F.lit("")), F.lit("\\"), F.lit("/")), "/+$", "")
    asked = accounts.withColumn("_task", F.regexp_extract(ref, REFERENCE, 1)).withColumn("_folder", F.regexp_extract(ref, REFERENCE, 2))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "{page_*,structured_summary}.json").load(f"{root.rstrip('/')}/tasks")
    part = lambda k: F.element_at(F.split("path", "/"), k)
    raw = F.col("content").cast("string")
    text = F.when(F.is_valid_utf8(raw), F.regexp_replace(raw, "^\ufeff", ""))
    files = files.select(part(-4).alias("_t"), part(-2).alias("_f"), part(-1).alias("name"), "content", text.alias("text"), (part(-1) == SUMMARY).alias("last"))
    page = F.from_json("text", PAGE)
    body = F.coalesce(page["data"]["markdown"], F.lit(""))
    usable = ~F.col("last") & F.try_parse_json("text").isNotNull() & (F.lower(page["status"]) == "success") & (F.trim(F.regexp_replace(body, r"\s+", " ")) != "")
    title = F.replace(F.regexp_extract("name", r"^page_(.*)\.json$", 1), F.lit("_"), F.lit(" "))
    one = F.when(usable, F.struct(F.coalesce(page["url"], F.lit("")).alias("url"), title.alias("title"), body.alias("text"), F.coalesce(page["metadata"]["query_time"], F.lit("")).alias("observed_at"), F.sha2("content", 256).alias("hash")))
    marked = F.struct("last", "name", F.concat(F.col("name").cast("binary"), F.col("content")).alias("bytes"), one.alias("page"))
    found = files.groupBy("_t", "_f").agg(F.sort_array(F.collect_list(marked)).alias("_all"), F.max(F.when(F.col("last"), F.col("text"))).alias("_summary"))
    both = asked.join(found, (F.col("_task") == F.col("_t")) & (F.col("_folder") == F.col("_f")), "left")
    summary = F.coalesce("_summary", F.lit("{}"))
    other = F.coalesce(F.get_json_object(summary, "$.id"), F.lit(""))
    pages = F.coalesce(F.array_compact(F.transform("_all", lambda x: x["page"])), F.array()).cast(PAGES)
    digest = F.sha2(F.aggregate("_all", F.lit(b""), lambda a, x: F.concat(a, x["bytes"])), 256)
    why = F.when(~F.coalesce("scored", F.lit(False)), "preflight_held_no_cached_extraction").when(F.col("_task") == "", "cached_raw_reference_unparseable").when(F.col("_all").isNull(), "cached_raw_directory_not_materialized")
    why = why.when((other != "") & (other != F.col("account")), F.concat(F.lit("cached_summary_id_mismatch:"), other)).when(F.size(pages) == 0, "cached_pages_absent_or_unusable").otherwise("")
    out = both.withColumn("missing_reason", why)
    kept = F.col("missing_reason").isin("", "cached_pages_absent_or_unusable")
    read = kept | F.startswith("missing_reason", F.lit("cached_summary"))
    return out.select(*accounts.columns, F.when(kept, pages).otherwise(F.array().cast(PAGES)).alias("pages"), F.when(read, summary).otherwise("{}").alias("summary"), F.when(kept, digest).otherwise("").alias("evidence_hash"), "missing_reason")


def task_shards(spark: SparkSession, glob: str) -> DataFrame:
    """The rows of all shards with the number in each file's name."""
    rows = read_csv(spark, glob)
    return rows.withColumn("task", F.regexp_extract(F.input_file_name(), r"task-(\d+)_", 1).cast("int"))


def header_variants(spark: SparkSession, glob: str) -> DataFrame:
    """header and files: the first lines of all shards (small files, read whole), without a byte order mark."""
    first = F.regexp_replace(F.substring_index(F.regexp_replace("value", "^\ufeff", ""), "\n", 1), "\r$", "")
    return spark.read.text(glob, wholetext=True).groupBy(first.alias("header")).agg(F.count("*").alias("files"))


def misplaced(rows: DataFrame, accounts: DataFrame, shards: int, key: str = "Id") -> DataFrame:
    """Rows of task_shards whose task isn't their account's place in the input (account, place from 0) modulo shards: key, expected_task and task."""
    own = accounts.select(F.col("account").alias(key), F.pmod("place", F.lit(shards)).cast("int").alias("expected_task"))
    return rows.join(own, key).where("task <> expected_task").select(key, "expected_task", "task")


class _Table(HTMLParser):
    """Rows of a page's first table: the texts of each row's data cells, rows and cells of tables in it too, in the order in which they begin."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.rows, self.state = [], [], "before"

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.state = "within" if self.state == "before" else self.state
        elif self.state != "within" or tag not in ("tr", "td"):
            return
        if tag == "tr":
            self.rows.append([])
            self.open.append((tag, self.rows[-1]))
        elif tag == "td":
            cell: list[str] = []
            for kind, row in self.open:
                if kind == "tr":
                    row.append(cell)
            self.open.append((tag, cell))
        else:
            self.open.append((tag, []))

    def handle_endtag(self, tag):
        if tag in ("table", "tr", "td") and any(k == tag for k, _ in self.open):
            while self.open.pop()[0] != tag:
                pass
            if not any(k == "table" for k, _ in self.open):
                self.state = "behind"

    def handle_data(self, data):
        if self.state == "within" and (text := data.strip()):
            for kind, cell in self.open:
                if kind == "td":
                    cell.append(text)


def _cells(html: str | None) -> list[list[str]]:
    parser = _Table()
    parser.feed(html or "")
    parser.close()
    return [[" ".join(c) for c in row] for row in parser.rows]


def table_rows(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, row (its place among the first table's rows) and cells of each row that has data cells."""

    @F.pandas_udf("array<array<string>>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in parts:
            yield x.map(_cells)

    rows = pages.select(key, F.posexplode(run(F.col(html))).alias("row", "cells"))
    return rows.where(F.size("cells") > 0)


def directory_rows(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, row, kind (member, elite, their headers, or ignored), number, name, city and state of each row of a directory's table."""
    c = lambda k: F.coalesce(F.get("cells", F.lit(k)), F.lit(""))
    three = F.size("cells") == 3
    kind = F.when((c(0) == "Company Name") & (c(1) == "Location"), "elite_header").when((c(0) == "ALTA ID") & (c(1) == "Company") & (c(2) == "Location"), "member_header")
    kind = kind.when(three & (c(0) == "Elite Profile"), "elite").when(three & F.rlike(c(0), F.lit("^[0-9]+$")), "member").otherwise("ignored")
    place = F.trim(F.regexp_replace(c(2), r"\s+", " "))
    has = F.col("kind").isin("member", "elite")
    city = F.when(F.contains(place, F.lit(",")), F.trim(F.regexp_extract(place, "^(.*),", 1))).otherwise(place)
    state = F.when(F.contains(place, F.lit(",")), F.upper(state_code(F.regexp_extract(place, ",([^,]*)$", 1)))).otherwise("")
    shown = lambda v: F.when(has, v).otherwise("")
    return table_rows(pages, key, html).withColumn("kind", kind).select(key, "row", "kind", F.when(F.col("kind") == "member", c(0)).otherwise("").alias("number"), shown(c(1)).alias("name"), shown(city).alias("city"), shown(state).alias("state"))


def markdown(report: DataFrame, title: str) -> str:
    """A report's rows (a handful) as a Markdown table."""
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    lines = [f"# {title}", "", "| " + " | ".join(report.columns) + " |", "|" + "---|" * len(report.columns)]
    lines += ["| " + " | ".join(map(cell, r)) + " |" for r in report.toLocalIterator()]
    return "\n".join(lines) + "\n"
