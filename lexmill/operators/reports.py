"""Reports: ratings, roll-ups, histograms, line counts, sections, priorities."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def by_rating(findings: DataFrame, codes: Sequence[str] = ()) -> DataFrame:
    """(code, uniques, instances) of (code, word), with a TOTAL; it and the codes asked for are there with 0 if there is none of them. Languages (TF+..) count together."""
    findings = findings.withColumn("code", F.when(F.col("code").startswith("TF"), "TF").otherwise(F.col("code")))
    c = findings.groupBy("code", "word").agg(F.count("*").alias("n")).rollup("code").agg(F.count("*").alias("uniques"), F.sum("n").alias("instances"))
    c = c.withColumn("code", F.coalesce("code", F.lit("TOTAL")))
    dim = findings.sparkSession.createDataFrame([(x,) for x in {"TOTAL", *codes}], "code string")
    return c.join(dim, "code", "full").na.fill(0, ["uniques", "instances"])


def magnitude(n: Column) -> Column:
    """Bucket of a count: itself under 10, beyond that its leading digit at its order of magnitude ('200-299')."""
    zeros = F.repeat(F.lit("0"), F.length(n.cast("string")) - 1)
    first = F.substring(n.cast("string"), 1, 1)
    return F.when(n < 10, n.cast("string")).otherwise(F.concat(first, zeros, F.lit("-"), first, F.translate(zeros, "0", "9")))


def histogram(values: DataFrame, column: str) -> DataFrame:
    """(bucket, n): rows by magnitude of a count."""
    return values.groupBy(magnitude(F.col(column)).alias("bucket")).agg(F.count("*").alias("n"))


def line_counts(docs: DataFrame) -> DataFrame:
    return docs.select(F.explode(F.split("text", "\n")).alias("line")).groupBy("line").agg(F.count("*").alias("n"))


def uncertain_rollup(words: DataFrame, key: str = "doc_id", without: Sequence[str] = ()) -> DataFrame:
    """(word, class, total, articles): S ends in an apostrophe and s, P begins with a capital, * is the rest. Articles of ``without`` (lists of names) aren't counted."""
    words = words.where(~F.col(key).isin(*without)) if without else words
    each = words.groupBy("word", key).agg(F.count("*").alias("n")).groupBy("word").agg(F.sum("n").alias("total"), F.count("*").alias("articles"))
    return each.withColumn("class", F.when(F.col("word").rlike("['’]s$"), "S").when(F.col("word").rlike("^\\p{Lu}"), "P").otherwise("*"))


def best_type(findings: DataFrame, order: Sequence[str], key: str = "doc_id") -> DataFrame:
    """(key, best): of each article's codes the first in ``order``; codes outside it come after all others, by name."""
    rank = F.expr(f"coalesce(nullif(array_position(array({', '.join(repr(c) for c in order)}), code), 0), {len(order) + 1})")
    return findings.groupBy(key).agg(F.min(F.struct(rank.alias("rank"), "code")).alias("m")).select(key, F.col("m.code").alias("best"))


def sections(words: DataFrame, most: int = 50, depth: int = 5) -> DataFrame:
    """(word, section): the shortest prefix, up to ``depth`` letters, that at most ``most`` words have."""
    w = words.select("word").distinct()
    for k in range(1, depth + 1):
        w = w.withColumn(f"p{k}", F.substring("word", 1, k)).withColumn(f"n{k}", F.count("*").over(Window.partitionBy(f"p{k}")))
    pick = F.coalesce(*[F.when(F.col(f"n{k}") <= most, F.col(f"p{k}")) for k in range(1, depth)], F.col(f"p{depth}"))
    return w.select("word", pick.alias("section"))


def title_checks(titles: DataFrame, redirects: DataFrame, ascii_title: Column) -> DataFrame:
    """(title, plain): titles with marks beyond ASCII that no redirect leads to from their plain form."""
    t = titles.select("title", ascii_title.alias("plain")).where("title != plain")
    r = redirects.select(F.col("from_title").alias("plain"), F.col("to_title").alias("title"))
    return t.join(r, ["plain", "title"], "left_anti")


def merged_names(groups: Sequence[tuple[str, int]], least: int = 15, most: int = 50) -> list[tuple[str, str]]:
    """(section, merged) for (section, size) in order: neighbours join while one of them is under ``least`` and both together stay under ``most``.

    Sections that are cut by first letters don't join whole letters, nor other letters' sections; the joined name is that of the first and of the last.
    """
    out: list[tuple[str, int, list[str]]] = []
    for key, n in sorted(groups):
        if out:
            name, size, members = out[-1]
            right = name.partition("-")[2] if "-" in name else name
            apart = (len(right) == 1) != (len(key) == 1) or (len(right) > 1 and len(key) > 1 and right[0] != key[0])
            if not apart and (n < least or size < least) and size + n < most:
                left = "-" if name.startswith("-") else name.split("-")[0]
                out[-1] = (f"{left}-{key}", size + n, [*members, key])
                continue
        out.append((key, n, [key]))
    return [(k, name) for name, _, members in out for k in members]


def merge_sections(sized: DataFrame, least: int = 15, most: int = 50) -> DataFrame:
    """(section, merged) of (section, n) by merged_names. The fold runs over all sections in order; they are prefixes of up to five letters, so as many as
    a report has headings."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(merged_names(list(pdf[["section", "n"]].itertuples(index=False, name=None)), least, most), columns=["section", "merged"])

    return sized.withColumn("whole", F.lit(True)).groupBy("whole").applyInPandas(run, "section string, merged string")


def line_word(line: Column) -> Column:
    """The word that a report line is about: the first link, without the dictionary's prefix; lines without a link stand for themselves."""
    link = F.regexp_extract(line, r"\[\[(.*?)\]\]", 1)
    return F.when(link == "", line).when(link.startswith("wikt:"), F.substring(link, 6, 1 << 20)).otherwise(link)


def summary_line(count: Column, word: Column, articles: Column, find_all: bool = False) -> Column:
    """A report line with up to five articles; tags and entities are shown as text, and ``find_all`` adds a link to a search for the word."""
    some = F.array_join(F.transform(F.slice(articles, 1, 5), lambda a: F.concat(F.lit("[["), a.cast("string"), F.lit("]]"))), ", ")
    name = F.when(word.startswith("<"), F.concat(F.lit("<nowiki>"), word, F.lit("</nowiki>"))).when(word.startswith("&"), F.concat(F.lit("&amp;"), F.substring(word, 2, 1 << 20), F.lit(" ("), word, F.lit(")"))).otherwise(F.concat(F.lit("[[wikt:"), word, F.lit("]]")))
    line = F.concat(F.lit("* "), count.cast("string"), F.lit(" - "), name, F.lit(" - "), some)
    if not find_all:
        return line
    special = word.rlike("^[<&]") | (word == "₤")
    plain = F.translate(word, " ", "+")
    raw = F.url_encode(F.replace(F.replace(F.replace(plain, F.lit(">"), F.lit("")), F.lit("/"), F.lit("\\/")), F.lit("<"), F.lit("\\<\\/?")))
    link = F.when(special, F.concat(F.lit("insource%3A%2F"), raw, F.lit("%2Fi"))).otherwise(F.concat(F.lit("%22"), plain, F.lit("%22")))
    return F.concat(line, F.lit(" ... [https://en.wikipedia.org/w/index.php?search="), link, F.lit("&ns0=1 find all]"))


def active_half(words: DataFrame, first: str = "a", last: str = "m", others: bool = True, dots: bool = True) -> DataFrame:
    """Rows (word, ...) of one half of the alphabet by their first letter; ``others``: those that begin with no letter a-z too; ``dots``: those with dots too."""
    c = F.substring("word", 1, 1)
    keep = c.between(first, last) | (F.lit(others) & ~c.rlike("^[a-z]$"))
    return words.where(keep & (F.lit(dots) | ~F.col("word").contains(".")))


def frequent(words: DataFrame, more_than: int = 4, articles: int = 2) -> DataFrame:
    """Rows (word, freq, docs, ...) of more than so many occurrences, in at least so many articles."""
    return words.where((F.col("freq") > more_than) & (F.col("docs") >= articles))


PROBABLY_WRONG = ("T1", "TS+DOT", "TS+COMMA", "TS+EXTRA", "HB", "HL", "T/", "TE", "ME", "TF+el", "TF+de")
UNSORTED = ("BW", "Z", "BC", "TS+BRACKET", "TF", "N", "P", "H", "U", "TS", "A")


def main_listing(tokens: DataFrame, published: DataFrame | None = None, order: Sequence[str] = PROBABLY_WRONG) -> DataFrame:
    """(title, best, types, words) of (title, pos, word, type): articles with a token that is probably wrong, by the first of ``order`` that they have.

    If an article has tokens that can't be sorted yet, only those that are probably wrong stay. Titles of ``published`` are left out.
    """
    rank = F.coalesce(*[F.when(F.col("type") == t, F.lit(i)) for i, t in enumerate(order)])
    pairs = F.array_sort(F.collect_list(F.struct("pos", "type", "word")))
    a = tokens.withColumn("rank", rank).groupBy("title").agg(F.min("rank").alias("rank"), F.max(F.col("type").isin(*UNSORTED)).alias("mixed"), pairs.alias("p")).where("rank is not null")
    if published is not None:
        a = a.join(published.select("title").distinct(), "title", "left_anti")
    kept = F.filter("p", lambda x: ~F.col("mixed") | x["type"].isin(*order))
    best = F.get(F.array(*[F.lit(t) for t in order]), F.col("rank"))
    return a.select("title", best.alias("best"), F.transform(kept, lambda x: x["type"]).alias("types"), F.transform(kept, lambda x: x["word"]).alias("words"))


def article_categories(tokens: DataFrame, categories: DataFrame) -> DataFrame:
    """(title, categories) of (title, pos, word): the categories of an article's tokens in their order, joined by commas; each distinct word is categorised once."""
    j = tokens.join(categories.select("word", "category"), "word", "left")
    return j.groupBy("title").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("category", F.lit("")).alias("c")))), lambda x: x["c"]), ",").alias("categories"))


def by_length(words: DataFrame, column: str = "word") -> DataFrame:
    """Rows with the length of their word, short ones first."""
    return words.withColumn("length", F.length(column)).orderBy("length", column)


def chain_stats(chains: DataFrame) -> DataFrame:
    """(chains, heads, longest, mean_length) of distinct (chain)."""
    d = chains.distinct()
    return d.agg(F.count("*").alias("chains"), F.count_distinct(F.get("chain", F.lit(0))).alias("heads"), F.coalesce(F.max(F.size("chain")), F.lit(0)).alias("longest"), F.round(F.coalesce(F.avg(F.size("chain")), F.lit(0.0)), 3).alias("mean_length"))


def merge_sections_sql(sized: str, least: int = 15, most: int = 50) -> str:
    """The same rows for DuckDB from a query of (section, n), section by section."""
    joins = f"NOT ((length(r.last) = 1) <> (length(s.section) = 1) OR (length(r.last) > 1 AND length(s.section) > 1 AND left(r.last, 1) <> left(s.section, 1))) AND (s.n < {least} OR r.size < {least}) AND r.size + s.n < {most}"
    return f"""WITH RECURSIVE z AS ({sized}), s AS (SELECT section, n, row_number() OVER (ORDER BY section) AS i FROM z),
r AS (SELECT i, section AS last, n AS size, i AS g FROM s WHERE i = 1 UNION ALL
  SELECT s.i, s.section, CASE WHEN {joins} THEN r.size + s.n ELSE s.n END, CASE WHEN {joins} THEN r.g ELSE s.i END FROM r JOIN s ON s.i = r.i + 1),
e AS (SELECT g, arg_min(last, i) AS first, arg_max(last, i) AS last, count(*) AS members FROM r GROUP BY g)
SELECT r.last AS section, CASE WHEN members = 1 THEN e.first ELSE e.first || '-' || e.last END AS merged FROM r JOIN e USING (g)"""
