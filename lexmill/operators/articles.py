"""Which articles a check reads: skips by title, template, redirect and requested species; their prose; and readability reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Templates that ask for clean-up of a kind that makes findings moot.
CLEANUP = r"\{\{\s*(?:(?:[Cc]opy|[Mm]ove|[Cc]opy section) to \w+|[Nn]ot English|[Cc]leanup HTML|[Cc]leanup|[Ww]hich lang(?:uage)?|[Tt]ypo help inline|[Yy]ou|[Tt]one|[Cc]opy ?edit|[Gg]rammar|[Mm]anual|[Tt]ravel guide|[Ll]ike resume|MOS|[Hh]ow-?to).*?\}\}"
MORE_CLEANUP = r"\{\{(?:[Ll]ike resume|[Aa]dvert|[Ll]ong plot|[Cc]reate list)"
LIST_TITLE = r"disambiguation[)]|^(?:Index|List|Outline|Table|Glossary|Timeline) of"
YEAR_TITLE = r"^(?:[0-9]+s?$|[0-9]+s? BC$|[0-9][0-9]+s? in )"
REDIRECT = "^#(?:REDIRECT|redirect)"


def without_cleanup(articles: DataFrame) -> DataFrame:
    """Articles without a template of CLEANUP."""
    return articles.where(~F.coalesce(F.col("text").rlike(CLEANUP), F.lit(False)))


def without_titles(articles: DataFrame, titles: DataFrame) -> DataFrame:
    """Articles whose title isn't in ``titles``: skip lists, requested species, published reports."""
    return articles.join(titles.select("title").distinct(), "title", "left_anti")


def requested_titles(pages: DataFrame) -> DataFrame:
    """(title): articles of this encyclopaedia that lists of requested species link to, from (value) lines of their pages."""
    return pages.select(F.explode(F.regexp_extract_all("value", F.lit('title="(?:en|w):([^"]*)"'), 1)).alias("title")).distinct()


def skipped(articles: DataFrame, titles: DataFrame) -> DataFrame:
    """(title, reason) of the articles that the spell check leaves out: skip list, clean-up template; pages of data are noted and read all the same."""
    listed = titles.select("title").distinct().withColumn("listed", F.lit(True))
    reason = F.when(F.col("listed"), "title").when(F.col("text").rlike(CLEANUP), "template").when(F.col("title").endswith("(data page)"), "data page")
    return articles.join(listed, "title", "left").select("title", reason.alias("reason")).where("reason is not null")


def readable(articles: DataFrame) -> DataFrame:
    """Articles of which readability says something: no lists, years, redirects or pages with clean-up templates."""
    t, x = F.col("title"), F.col("text")
    return articles.where(~t.rlike(LIST_TITLE) & ~t.rlike(YEAR_TITLE) & ~x.rlike(REDIRECT) & ~x.rlike(CLEANUP) & ~x.rlike(MORE_CLEANUP))


def species_words(titles: DataFrame) -> DataFrame:
    """(word): words of the titles of species and of requests for them."""
    return titles.select(F.explode(F.regexp_extract_all(F.translate("title", "_", " "), F.lit("[\\p{L}\\p{N}_']+"), 0)).alias("word")).distinct()


def dictionary_words(*sources: DataFrame) -> DataFrame:
    """(word): of several tables (title) every title in lower case, cut at spaces and, apart from that, at punctuation."""
    parts = []
    for s in sources:
        t = F.lower(F.trim(F.translate("title", "_", " ")))
        parts.append(s.select(F.explode(F.concat(F.split(t, " "), F.split(t, "[ !\"#$%&'()*+,./:;<=>?@\\[\\]^_`{|}~\\\\-]"))).alias("word")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where("word != ''").distinct()


def queued_titles(pages: DataFrame) -> DataFrame:
    """(title): words that a saved page queues for the dictionary, by their links to it."""
    return pages.select(F.explode(F.regexp_extract_all("value", F.lit('"https://en[.]wiktionary[.]org/wiki/(.*?)"'), 1)).alias("title")).distinct()


def triage(articles: DataFrame) -> DataFrame:
    """(title, kind, found): superscripts and subscripts by what they hold: ordinals, units, powers, isotopes, plain numbers, letters, and all else."""
    f = articles.select("title", F.explode(F.regexp_extract_all("text", F.lit("([A-Za-z0-9)}]{0,8}<su[bp]>[^<]{1,40}</su[bp]>)"), 1)).alias("found"))
    s = F.col("found")
    kind = (
        F.when(s.rlike("<sup>(?:st|nd|rd|th|e|er|o|a)</sup>"), "ORDINAL").when(s.rlike("^(?:k|c|m|d)?(?:m|ft|mi|in|s|yd)<sup>[-−]?[1-4]</sup>"), "UNIT").when(s.rlike("[0-9]<sup>[-−]?[0-9]+</sup>"), "POWER").when(s.rlike("^<sup>[0-9]{1,3}m?</sup>"), "ISOTOPE")
        .when(s.rlike("^(?:[A-Z][a-z]?)?<sub>[0-9]+</sub>|[A-Z][a-z]?<sub>"), "CHEMICAL").when(s.rlike("<su[bp]>[0-9,. ]+</su[bp]>"), "NUMBER").when(s.rlike("<su[bp]>[A-Za-z]+</su[bp]>"), "LETTERS").otherwise("OTHER")
    )
    return f.select("title", kind.alias("kind"), "found")


def no_prose_marks(text: Column) -> Column:
    return F.translate(text, "✂", "")
