"""Readability, paragraph statistics, passages in another language, entities, formulas, grep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.functions.classify import is_formula

ENTITY = "&#?[a-zA-Z0-9]+;"


def _n(text: str, pattern: str) -> Column:
    return F.regexp_count(F.col(text), F.lit(pattern)).cast("bigint")


def readability(docs: DataFrame, min_chars: int = 1000, key: str = "doc_id") -> DataFrame:
    """(key, sentences, words, syllables, letters, flesch, coleman_liau) of texts with ``min_chars`` of prose."""
    s = docs.where(F.length("text") >= min_chars).select(key, F.greatest(_n("text", "[.!?]+"), F.lit(1)).alias("sentences"), F.greatest(_n("text", "\\p{L}+"), F.lit(1)).alias("words"), _n("text", "[aeiouyáéíóúàèìòùâêîôûäëïöüAEIOUYÁÉÍÓÚÀÈÌÒÙÂÊÎÔÛÄËÏÖÜ]+").alias("syllables"), _n("text", "\\p{L}").alias("letters"))
    flesch = F.expr("206.835D - 1.015D * (words / sentences) - 84.6D * (syllables / words)")
    return s.withColumn("flesch", flesch).withColumn("coleman_liau", F.expr("5.89D * (letters / words) - 29.5D * (sentences / words) - 15.8D"))


def paragraph_stats(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, paragraph, words, sentences, longest): of each paragraph of prose (100 characters and a closing mark); longest: most words in a sentence."""
    p = docs.select(key, F.posexplode(F.split("text", "\n")).alias("paragraph", "p")).where(F.length("p") >= 100).where(F.col("p").rlike("[.!?'\"]$"))
    parts = F.filter(F.split("p", "[.!?]+"), lambda x: F.trim(x) != "")
    sizes = F.transform(parts, lambda x: F.regexp_count(x, F.lit("[^ ]+")))
    return p.select(key, "paragraph", _n("p", "[^ ]+").alias("words"), F.size(parts).cast("bigint").alias("sentences"), F.coalesce(F.array_max(sizes), F.lit(0)).cast("bigint").alias("longest"))


def foreign_passages(docs: DataFrame, known: DataFrame, key: str = "doc_id", least: int = 20, hot: DataFrame | None = None) -> DataFrame:
    """(key, paragraph, words, home, foreign): paragraphs of ``least`` words in which most words over three letters are not of the document's language.

    A paragraph with over a third known words is passed over, and so is one with fewer unknown than half the known. ``known``: (lang, word).
    ``hot``: the most frequent of these, to go along by broadcast; paragraphs that they rule out by themselves aren't joined with the others.
    """
    p = docs.select(key, "lang", F.posexplode(F.split("text", "\n")).alias("paragraph", "p"))
    if hot is not None:
        each = p.select(key, "lang", "paragraph", F.explode(F.regexp_extract_all(F.lower("p"), F.lit("\\p{L}+"), 0)).alias("word"))
        bound = each.join(F.broadcast(hot.withColumn("sure", F.lit(1))), ["lang", "word"], "left").groupBy(key, "paragraph").agg(F.count("*").alias("words"), F.count("sure").alias("sure"))
        maybe = bound.where((F.col("words") >= least) & (F.col("sure") * 3 <= F.col("words"))).select(key, "paragraph")
        p = p.join(maybe, [key, "paragraph"], "left_semi")
    w = p.select(key, "lang", "paragraph", F.explode(F.regexp_extract_all("p", F.lit("\\p{L}+"), 0)).alias("raw"))
    w = w.select(key, "lang", "paragraph", F.lower("raw").alias("word"), (F.length("raw") > 3).alias("long"), F.col("raw").rlike("^\\p{Lu}").alias("name"))
    flagged = w.join(known.withColumn("home", F.lit(1)), ["lang", "word"], "left")
    counts = flagged.groupBy(key, "paragraph").agg(F.count("*").alias("words"), F.sum(F.coalesce("home", F.lit(0))).cast("bigint").alias("home"), F.sum(F.expr("int(home is null and long and not name)")).cast("bigint").alias("foreign"))
    return counts.where((F.col("words") >= least) & (F.col("home") * 3 <= F.col("words")) & (F.col("foreign") * 2 >= F.col("home")))


def entity_tally(pages: DataFrame, text: str = "html", key: str = "page_id", examples: int = 5000) -> DataFrame:
    """(entity, kind, instances, uniques, pages): each character entity with the first pages that hold it, by id; pages are ranked before they are listed."""
    e = pages.select(key, F.explode(F.regexp_extract_all(text, F.lit(ENTITY), 0)).alias("entity")).groupBy("entity", key).agg(F.count("*").alias("n"))
    kind = F.when(F.col("entity").startswith("&#"), "NUMERIC").when(F.col("entity").isin("&lt;", "&gt;", "&amp;", "&quot;", "&nbsp;"), "KEEP").otherwise("NAMED")
    totals = e.groupBy("entity").agg(F.sum("n").alias("instances"), F.count("*").alias("uniques"))
    return totals.join(_first(e, "entity", key, examples, "pages"), "entity").withColumn("kind", kind)


def _first(pairs: DataFrame, by: str, key: str, most: int, name: str) -> DataFrame:
    """(by, name): the first ``most`` keys of each value, in order."""
    rank = F.row_number().over(Window.partitionBy(by).orderBy(key))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= most).groupBy(by).agg(F.array_sort(F.collect_list(key)).alias(name))


def formulas(docs: DataFrame, key: str = "doc_id", examples: int = 100, listed: DataFrame | None = None) -> DataFrame:
    """(formula, articles, examples): chemical formulas, in how many documents they are, and the first of these; ``listed``: (formula) to look for, in place of any that has the form of one."""
    t = docs.select(key, F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit("[A-Za-z0-9()]+"), 0))).alias("formula"))
    t = t.where(is_formula(F.col("formula"))) if listed is None else t.join(listed.select("formula").distinct(), "formula", "left_semi")
    return t.groupBy("formula").agg(F.count("*").alias("articles")).join(_first(t, "formula", key, examples, "examples"), "formula")


def grep(docs: DataFrame, pattern: str, literal: bool = False, key: str = "doc_id") -> DataFrame:
    hit = F.col("text").contains(pattern) if literal else F.col("text").rlike(pattern)
    return docs.where(hit).select(key)


def grep_lines(docs: DataFrame, pattern: str, key: str = "doc_id") -> DataFrame:
    return docs.select(key, F.posexplode(F.split("text", "\n")).alias("line_no", "line")).where(F.col("line").rlike(pattern))
