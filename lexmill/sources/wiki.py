"""Readers: page dumps, titles, redirects, typo rules and link tables as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DUMP = "title string, ns int, redirect struct<_title:string>, revision struct<text:string>"


def read_dump(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(articles(title, text), redirects(from_title, to_title)) of the main namespace; .bz2 and .gz are read as they are."""
    pages = spark.read.format("xml").options(rowTag="page").schema(DUMP).load(path).where("ns = 0")
    articles = pages.where("redirect is null").select("title", F.col("revision.text").alias("text"))
    return articles, pages.where("redirect is not null").select(F.col("title").alias("from_title"), F.col("redirect._title").alias("to_title"))


def bucket(title: Column) -> Column:
    """Partition of a title: its first letter A-Z, or what comes before or after them."""
    c = F.upper(F.substring(title, 1, 1))
    return F.when(c < "A", "BEFORE_A").when(c > "Z", "AFTER_Z").otherwise(c)


def write_articles(articles: DataFrame, path: str) -> None:
    """Store articles by bucket, so that a scan of some buckets reads those alone."""
    articles.withColumn("bucket", bucket(F.col("title"))).write.mode("overwrite").partitionBy("bucket").parquet(path)


def read_articles(spark: SparkSession, path: str, which: str = "ALL") -> DataFrame:
    a = spark.read.parquet(path)
    return a if which == "ALL" else a.where(F.col("bucket") == which)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Articles from text records that end in CR: title, tab, text."""
    cut = F.split("value", "\t", 2)
    return spark.read.text(path, lineSep="\r").where("value != ''").select(F.ltrim(cut[0]).alias("title"), cut[1].alias("text"))


def read_pairs(spark: SparkSession, path: str, names: tuple[str, str] = ("from_title", "to_title")) -> DataFrame:
    """Two tab-separated columns: redirects, transliterations."""
    return spark.read.csv(path, sep="\t", schema=", ".join(f"{n} string" for n in names), quote="")


def title_words(titles: DataFrame) -> DataFrame:
    """(word): lower-case words of titles, split at spaces and, in addition, at punctuation."""
    t = F.lower(F.translate("title", "_", " "))
    both = F.concat(F.split(t, " "), F.split(t, "[^\\p{L}\\p{N}']+"))
    return titles.select(F.explode(both).alias("word")).where("word != ''").distinct()


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """(name, pattern, replacement) of the enabled typo rules of a saved page, one a line."""
    line = F.col("value")
    for entity, c in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        line = F.replace(line, F.lit(entity), F.lit(c))
    line = F.regexp_replace(line, "</?span[^>]*>", "")
    part = lambda key: F.regexp_extract(line, f'\\b{key}="(.*?)"', 1)
    return spark.read.text(path).where("value like '%Typo%' and value like '%find=%' and value not like '%disabled%'").select(part("word").alias("name"), part("find").alias("pattern"), part("replace").alias("replacement"))


def published_titles(html: DataFrame) -> DataFrame:
    """(title): pages that saved project pages link to, without those of a namespace or a section."""
    link = F.explode(F.regexp_extract_all("value", F.lit('/wiki/([^"?]+)"'), 1))
    t = html.select(link.alias("link")).select(F.translate(F.url_decode("link"), "_", " ").alias("title"))
    return t.where("title not like '%:%' and title not like '%#%'").distinct()


def named_links(page: DataFrame, links: DataFrame) -> DataFrame:
    """(pl_from, pl_to, from_redirect): links inside the main namespace, by title."""
    p = page.where("page_namespace = 0").select("page_id", "page_title", "page_is_redirect")
    e = links.where("pl_namespace = 0 and pl_from_namespace = 0")
    return e.join(p, e["pl_from"] == p["page_id"]).select(F.col("page_title").alias("pl_from"), F.col("pl_title").alias("pl_to"), F.col("page_is_redirect").alias("from_redirect"))


def page_categories(page: DataFrame, category: DataFrame, target: DataFrame) -> DataFrame:
    """(title, category_name), each pair once."""
    j = page.join(category, page["page_id"] == category["cl_from"]).join(target, category["cl_target_id"] == target["lt_id"])
    return j.select(F.translate("page_title", "_", " ").alias("title"), F.translate("lt_title", "_", " ").alias("category_name")).distinct()
