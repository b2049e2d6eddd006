"""Spelling: dictionaries, out-of-dictionary words, compounds, near words, tallies.

Words are counted first and joined with the dictionary as distinct words, so the texts are exploded once and what is
joined grows with the vocabulary, not with the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.classify import shape

WORD = "\\p{L}+"


def tokens(docs: DataFrame, key: str = "doc_id", by: tuple[str, ...] = ("lang",)) -> DataFrame:
    """(key, *by, word): every word of every text, lower-case."""
    return docs.select(key, *by, F.explode(F.regexp_extract_all(F.lower("text"), F.lit(WORD), 0)).alias("word"))


def tally(words: DataFrame, key: str = "doc_id", by: tuple[str, ...] = ("lang",)) -> DataFrame:
    """(*by, word, freq, docs): occurrences and documents of each word. Counted by document first, which keeps the distinct count cheap."""
    each = words.groupBy(*by, "word", key).agg(F.count("*").alias("n"))
    return each.groupBy(*by, "word").agg(F.sum("n").alias("freq"), F.count("*").alias("docs"))


def word_counts(docs: DataFrame, key: str = "doc_id", by: tuple[str, ...] = ("lang",)) -> DataFrame:
    """(*by, word, freq, docs): ``tally`` of ``tokens``, without a row per word and document on the way.

    Rows are told apart by their key, so of a text its distinct words count once more, as its document; partial counts then are as large as
    the vocabulary of a task. Texts whose key occurs again are counted by key, since they are one document.
    """
    again = docs.groupBy(key).agg(F.count("*").alias("rows")).where("rows > 1").select(F.col(key).alias("__again"))
    if again.isEmpty():
        return _row_counts(docs, by)
    same = F.col(key).eqNullSafe(F.col("__again"))
    parts = _row_counts(docs.join(again, same, "left_anti"), by).unionByName(tally(tokens(docs.join(again, same, "left_semi"), key, by), key, by))
    return parts.groupBy(*by, "word").agg(F.sum("freq").alias("freq"), F.sum("docs").alias("docs"))


def _row_counts(docs: DataFrame, by: tuple[str, ...]) -> DataFrame:
    w = docs.select(*by, F.regexp_extract_all(F.lower("text"), F.lit(WORD), 0).alias("words")).withColumn("kinds", F.array_distinct("words"))
    each = w.select(*by, F.size("kinds").alias("size"), F.posexplode(F.concat("kinds", "words")).alias("at", "word"))
    docs_ = F.sum((F.col("at") < F.col("size")).cast("bigint"))
    return each.groupBy(*by, "word").agg((F.count("*") - docs_).alias("freq"), docs_.alias("docs"))


def dictionary(counts: DataFrame, min_docs: int = 3) -> DataFrame:
    """(lang, word): words that occur in ``min_docs`` documents of a language."""
    return counts.where(F.col("docs") >= min_docs).select("lang", "word")


def unknown_words(counts: DataFrame, known: DataFrame) -> DataFrame:
    return counts.join(known, ["lang", "word"], "left_anti")


def compounds(unknown: DataFrame, known: DataFrame) -> DataFrame:
    """(lang, word, splits): unknown words that are two dictionary words in a row, and in how many ways."""
    at = F.explode(F.sequence(F.lit(1), F.length("word") - 1))
    halves = unknown.where("length(word) > 1").select("lang", "word", at.alias("i"))
    halves = halves.select("lang", "word", F.expr("left(word, i)").alias("a"), F.expr("substring(word, i + 1)").alias("b"))
    one = known.select("lang", F.col("word").alias("a"))
    return halves.join(one, ["lang", "a"], "left_semi").join(one.withColumnRenamed("a", "b"), ["lang", "b"], "left_semi").groupBy("lang", "word").agg(F.count("*").alias("splits"))


def _deletions(word: Column) -> Column:
    """The word, and the word without each of its letters."""
    cut = F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word))))
    return F.array_distinct(F.concat(F.array(word), cut))


def one_edit(a: Column, b: Column) -> Column:
    """Whether one insertion, deletion, replacement or swap of neighbours makes ``b`` of ``a``; not for equal words."""
    n = F.length(a)
    swap = F.exists(F.sequence(F.lit(1), n - 1), lambda i: F.concat(F.substring(a, F.lit(1), i - 1), F.substring(a, i + 1, F.lit(1)), F.substring(a, i, F.lit(1)), F.substring(a, i + 2, n)) == b)
    return (F.levenshtein(a, b) == 1) | ((F.levenshtein(a, b) == 2) & (n == F.length(b)) & (n > 1) & swap)


def near_words(unknown: DataFrame, known: DataFrame) -> DataFrame:
    """(lang, word, suggestion): dictionary words one edit from an unknown word; candidates share the word less one letter."""
    keys = lambda d, name: d.select("lang", F.explode(_deletions(F.col("word"))).alias("key"), "word").withColumnRenamed("word", name)
    pairs = keys(unknown, "word").join(keys(known, "suggestion"), ["lang", "key"]).select("lang", "word", "suggestion").distinct()
    return pairs.where(one_edit(F.col("word"), F.col("suggestion")))


def verdict(token: Column, known: Column, bad: Column) -> Column:
    """0 correct, 1 uncertain, 2 wrong, of a token whose lower form is in the dictionary or not; the first rule that fits counts."""
    return (
        F.when(token == "", 0).when(bad, 2).when(known, 0).when(token.rlike("^(?:[$€£¥±+~−#-])?[0-9]"), 0).when(token.rlike("^</?[a-z]+>?$"), 2)
        .when(token.rlike("^&[A-Za-z]+;"), 0).when(F.upper(F.substring(token, 1, 1)) == F.substring(token, 1, 1), 1).when(~token.rlike("^\\p{L}+$"), 1).otherwise(2)
    )


def judge(docs: DataFrame, known: DataFrame, bad_words: tuple[str, ...] = ("alot", "teh", "recieve")) -> DataFrame:
    """(token, verdict, freq): every distinct token; parts of one with hyphens, dashes or slashes are judged apart and the worst counts."""
    t = docs.select(F.explode(F.regexp_extract_all("text", F.lit("[\\p{L}\\p{N}’'$€£&;<>./-]+"), 0)).alias("raw")).select(F.expr("trim(BOTH '.,;' FROM raw)").alias("token"))
    t = t.where("token != ''").groupBy("token").agg(F.count("*").alias("freq"))
    parts = t.select("token", "freq", F.explode(F.split("token", "[-–—/]")).alias("part")).withColumn("word", F.lower("part"))
    k = known.select("word").distinct().withColumn("known", F.lit(True))
    v = verdict(F.col("part"), F.coalesce("known", F.lit(False)), F.col("word").isin(*bad_words))
    return parts.join(k, "word", "left").groupBy("token").agg(F.max(v).alias("verdict"), F.first("freq").alias("freq"))


def categories(docs: DataFrame) -> DataFrame:
    """(category, tokens, kinds): occurrences and distinct tokens of each class of form, split at white space."""
    t = docs.select(F.explode(F.regexp_extract_all("text", F.lit("[^ \\t\\n\\r]+"), 0)).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    return t.groupBy(shape(F.col("token")).alias("category")).agg(F.sum("n").alias("tokens"), F.count("*").alias("kinds"))
