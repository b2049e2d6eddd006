"""Writers of findings and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.sources.wiki import bucket


def write_findings(findings: DataFrame, path: str) -> None:
    """Findings by code, so that a report reads its own codes only."""
    findings.write.mode("overwrite").partitionBy("code").parquet(path)


def frequency_line(count: Column, word: Column, articles: Column) -> Column:
    """One bullet of a word report: count, linked word, linked articles."""
    linked = F.transform(articles, lambda a: F.concat(F.lit("[["), a.cast("string"), F.lit("]]")))
    return F.concat(F.lit("* "), count.cast("string"), F.lit(" - [[wikt:"), word, F.lit("]] - "), F.array_join(linked, ", "))


def write_letters(report: DataFrame, path: str, title: str = "title") -> None:
    """A report by the first letter of its titles."""
    report.withColumn("letter", bucket(F.col(title))).write.mode("overwrite").partitionBy("letter").parquet(path)


def rule_export(articles: DataFrame, rules: DataFrame) -> DataFrame:
    """(value): one JSON object with the ordered articles and replacements; rules that begin with a tag come last."""
    order = F.struct(F.col("pattern").startswith("<").alias("tag"), F.col("rank"), F.struct(F.col("pattern").alias("replaceText"), F.col("replacement").alias("replaceWith")).alias("rule"))
    r = rules.agg(F.transform(F.array_sort(F.collect_list(order)), lambda x: x["rule"]).alias("replaces"))
    a = articles.agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "title"))), lambda x: x["title"]).alias("articleList"))
    return a.crossJoin(r).select(F.to_json(F.struct("articleList", "replaces")).alias("value"))


def write_pages_xml(articles: DataFrame, path: str) -> None:
    """Articles as page elements again."""
    page = articles.select("title", F.lit(0).alias("ns"), F.struct("text").alias("revision"))
    page.write.mode("overwrite").format("xml").options(rowTag="page", rootTag="mediawiki").save(path)


def heading(title: Column, level: int = 2) -> Column:
    marks = "=" * level
    return F.concat(F.lit(f"{marks} "), title.cast("string"), F.lit(f" {marks}"))


def table_row(*cells: Column) -> Column:
    """A row of a wikitext table; a null cell is empty."""
    return F.concat(F.lit("|-\n| "), F.concat_ws(" || ", *[F.coalesce(c.cast("string"), F.lit("")) for c in cells]))


def table_start(*names: str) -> str:
    return '{| class="wikitable sortable"\n! ' + " !! ".join(names)


def page(sections: DataFrame) -> DataFrame:
    """(title, value) of (title, section, line): a page with a heading for each section, which come in order, and their lines in order.

    Lines are gathered by section, and sections by page; a page is one text, so it should be a report's page and not all of a report.
    """
    s = sections.groupBy("title", "section").agg(F.array_join(F.array_sort(F.collect_list("line")), "\n").alias("body"))
    parts = F.array_sort(F.collect_list(F.struct("section", F.concat(heading(F.col("section"), 4), F.lit("\n"), F.col("body")).alias("text"))))
    return s.groupBy("title").agg(F.array_join(F.transform(parts, lambda x: x["text"]), "\n").alias("value"))
