"""Daily top-article reports: what to request, and rows out of the answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.barrier import evaluated_once
from millrace.functions.json_doc import (
    document_fields,
    is_single_document,
    member_fields,
    untyped_fields,
)

# Fixed value: the path of the report under the service's base address.
REPORT_PATH = "/metrics/pageviews/top/"

_ARTICLES = "array<struct<article:string,views:bigint,rank:bigint>>"


def report_url(base_url: str, project: Column, access: Column, day: Column) -> Column:
    """``<base>/metrics/pageviews/top/<project>/<access>/YYYY/MM/DD``."""
    return F.concat(
        F.lit(base_url + REPORT_PATH),
        project,
        F.lit("/"),
        access,
        F.lit("/"),
        F.date_format(day, "yyyy/MM/dd"),
    )


def request_plan(targets: DataFrame, base_url: str) -> DataFrame:
    """One request per day of each target's ``first_day`` to ``last_day``."""
    days = targets.select(
        "project", "access", F.explode(F.sequence("first_day", "last_day")).alias("date")
    )
    return days.withColumn(
        "url", report_url(base_url, F.col("project"), F.col("access"), F.col("date"))
    )


def read_reports(answers: DataFrame) -> DataFrame:
    """Each answer with its list of ``articles`` and an ``error``, empty when usable.

    ``answers`` has ``payload`` and, from the request, ``date``, ``project``, ``access``.
    No items means no rows; a payload without ``items`` is an error.
    """
    payload = F.col("payload")
    parsed = evaluated_once(answers, answers.columns, document=untyped_fields(payload, ["items"]))
    document = F.col("document")
    opened = parsed.select(
        *answers.columns,
        is_single_document(document, payload).alias("is_document"),
        document_fields(document)["items"].alias("items"),
        F.try_variant_get(document_fields(document)["items"], "$[0]", "variant").alias("item"),
    )
    # A list with a first item is not empty; only other values need comparing.
    empty = F.to_json("items").isin("null", "[]", "{}", '""', "0", "0.0", "false")
    inside = opened.select("*", member_fields(F.col("item"), ["articles"]).alias("inside"))
    typed = inside.select(
        "*",
        F.when(F.col("item").isNotNull(), F.lit(False)).otherwise(empty).alias("nothing"),
        F.try_variant_get(F.col("inside.articles"), "$", _ARTICLES).alias("articles"),
    )
    malformed = F.coalesce(F.exists("articles", lambda a: a.isNull()), F.lit(False))
    error = (
        F.when(~F.col("is_document"), "not a JSON document")
        .when(F.col("items").isNull(), "missing items")
        .when(F.col("nothing"), "")
        .when(F.col("inside").isNull(), "first item is not an object")
        .when(F.col("inside.articles").isNotNull() & F.col("articles").isNull(), "articles is not a list")
        .when(malformed, "article entry is not an object")
        .otherwise("")
    )
    return evaluated_once(typed, answers.columns, articles=F.col("articles"), error=error)


def explode_top(reports: DataFrame) -> DataFrame:
    """One row per article of every usable report."""
    rows = reports.where(F.col("error") == "").select(
        "date", "project", "access", F.explode("articles").alias("entry")
    )
    return rows.select("date", "project", "access", "entry.article", "entry.views", "entry.rank")


def report_errors(reports: DataFrame) -> DataFrame:
    """The reports nothing can be taken from, and why."""
    return reports.where(F.col("error") != "").select("date", "project", "access", "error")
