"""Languages of words and passages: a classifier of letters, paragraphs in another language, and the reports on them.

Words are classified by how their letter pairs are spread over the languages of a labelled vocabulary, with add-one smoothing: counts that
are made by aggregation over the whole vocabulary, and a table of at most a few thousand pairs per language that is joined by pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.operators.steps import kept, looked_up

#: Names of ISO 639 codes.
NAMES = {
    "ar": "Arabic", "bg": "Bulgarian", "ca": "Catalan", "cs": "Czech", "cy": "Welsh", "da": "Danish", "de": "German", "el": "Greek", "en": "English", "eo": "Esperanto", "es": "Spanish", "et": "Estonian", "eu": "Basque", "fa": "Persian", "fi": "Finnish", "fr": "French", "ga": "Irish", "gl": "Galician", "he": "Hebrew", "hi": "Hindi", "hr": "Croatian", "hu": "Hungarian",
    "hy": "Armenian", "id": "Indonesian", "is": "Icelandic", "it": "Italian", "ja": "Japanese", "ka": "Georgian", "ko": "Korean", "la": "Latin", "lt": "Lithuanian", "lv": "Latvian", "mk": "Macedonian", "ms": "Malay", "nl": "Dutch", "no": "Norwegian", "pl": "Polish", "pt": "Portuguese", "ro": "Romanian", "ru": "Russian", "sk": "Slovak", "sl": "Slovenian", "sq": "Albanian",
    "sr": "Serbian", "sv": "Swedish", "sw": "Swahili", "th": "Thai", "tl": "Tagalog", "tr": "Turkish", "uk": "Ukrainian", "ur": "Urdu", "vi": "Vietnamese", "yi": "Yiddish", "zh": "Chinese", "fil": "Filipino", "ceb": "Cebuano", "haw": "Hawaiian", "hmn": "Hmong",
}


def language_name(code: Column) -> Column:
    """Name of a language code; iw is an old code of Hebrew, -Latn says Latin script. Unknown codes stay as they are."""
    base = F.regexp_replace(code, "-Latn$", "")
    base = F.when(base == "iw", "he").otherwise(base)
    name = F.coalesce(*[F.when(base == k, F.lit(v)) for k, v in NAMES.items()], base)
    return F.concat(name, F.when(code.endswith("-Latn"), " (Latin script)").otherwise(""))


def _pairs(word: Column) -> Column:
    padded = F.concat(F.lit("^"), F.lower(word), F.lit("$"))
    return F.transform(F.sequence(F.lit(1), F.length(padded) - 1), lambda i: F.substring(padded, i, F.lit(2)))


def pair_costs(vocabulary: DataFrame) -> DataFrame:
    """(lang, pair, cost): minus the log of each letter pair's share in a language, in thousandths, and that of an unseen pair under the pair ''. ``vocabulary``: (lang, word)."""
    c = vocabulary.where("lang is not null").select("lang", F.explode(_pairs(F.col("word"))).alias("pair")).groupBy("lang", "pair").agg(F.count("*").alias("n"))
    total = c.groupBy("lang").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
    cost = lambda n: F.round(-1000 * F.log(n / (F.col("total") + F.col("kinds") + 1))).cast("bigint")
    unseen = total.select("lang", F.lit("").alias("pair"), cost(F.lit(1)).alias("cost"))
    return c.join(total, "lang").select("lang", "pair", cost(F.col("n") + 1).alias("cost")).unionByName(unseen)


def word_languages(words: DataFrame, costs: DataFrame, broadcast_limit: int = 200_000) -> DataFrame:
    """(word, lang, margin): the language in which a distinct word's letter pairs cost least (the first by code of equal ones), and by how much less per pair than in the next.

    The costs, a row per language and pair, go along by broadcast up to ``broadcast_limit`` of them, so words are shuffled once.
    """
    costs = kept(costs)
    unseen = costs.where("pair = ''").select("lang", F.col("cost").alias("unseen"))
    # what a known pair saves against an unseen one, and under the pair '' what an unseen one costs
    change = costs.join(F.broadcast(unseen), "lang").select("pair", "lang", F.when(F.col("pair") == "", F.col("cost")).otherwise(F.col("cost") - F.col("unseen")).alias("change"))
    if costs.count() <= broadcast_limit:
        change = F.broadcast(change)
    p = words.select("word").distinct().withColumn("all", _pairs(F.col("word")))
    p = p.select("word", F.size("all").cast("bigint").alias("pairs"), F.explode(F.concat(F.array(F.lit("")), "all")).alias("pair"))
    each = p.join(change, "pair").groupBy("word", "pairs", "lang").agg(F.sum(F.when(F.col("pair") == "", F.col("pairs") * F.col("change")).otherwise(F.col("change"))).alias("cost"))
    ranked = each.groupBy("word", "pairs").agg(F.array_sort(F.collect_list(F.struct("cost", "lang"))).alias("r"))
    best, second = F.get("r", F.lit(0)), F.get("r", F.lit(1))
    return ranked.select("word", best["lang"].alias("lang"), F.coalesce((second["cost"] - best["cost"]) / F.col("pairs"), F.lit(0.0)).cast("bigint").alias("margin"))


ROMAN = "^[IVXLCM]+$"


def foreign_words(docs: DataFrame, home: DataFrame, languages: DataFrame, right: DataFrame | None = None, key: str = "doc_id", least: int = 20, long_only: bool = True, hottest: int = 100_000) -> DataFrame:
    """(key, lang, n, samples, english): words of each language in passages that aren't in the home language, the first ten as samples.

    ``home``: (word) of the home language, in lower case; ``languages``: (word, lang) of all others; ``right``: (word) known to some
    dictionary, others have a ? behind their code. Passages are lines; with ``long_only`` those of under ``least`` words are passed over, and those of
    which more than a third is of the home language, or less than half as many words are of others. Names, numbers, numerals and words of up to three letters aren't counted.
    Distinct strings are classified, not occurrences; the classes of the ``hottest`` go to the occurrences by broadcast, only the others' occurrences are shuffled.
    """
    lines = docs.select(key, F.posexplode(F.split("text", "\n")).alias("line", "p"))
    table = kept(_classes(_words(lines, key), home, languages, right))
    hot = kept(table.orderBy(F.desc("freq"), "found").limit(hottest).select("found"))
    if long_only:
        # bounds by the most frequent words alone rule out most lines of the home language; the others are judged by all of their words
        sure = table.join(F.broadcast(hot), "found", "left_semi").select("found", "counts", F.col("home").alias("sure"))
        w = _words(lines, key).join(F.broadcast(sure), "found", "left")
        some = lambda c: F.sum(F.coalesce(c, F.lit(0)))
        bound = w.groupBy(key, "line").agg(some((F.coalesce("counts", F.lit(True))).cast("int")).alias("most"), some(F.col("sure").cast("int")).alias("homes"))
        maybe = bound.where((F.col("most") >= least) & (F.col("homes") * 3 <= F.col("most"))).select(key, "line")
        lines = kept(lines.join(maybe, [key, "line"], "left_semi"))
    w = looked_up(_words(lines, key), table.where("counts").drop("counts", "freq"), "found", hot)
    line = w.groupBy(key, "line").agg(F.count("*").alias("words"), F.sum(F.col("home").cast("int")).alias("homes"), F.sum(F.col("other").cast("int")).alias("others")).where("others > 0")
    if long_only:
        line = line.where((F.col("words") >= least) & (F.col("homes") * 3 <= F.col("words")) & (F.col("others") * 2 >= F.col("homes")))
    line = kept(line)
    found = w.where("other").groupBy(key, "line", "code").agg(F.count("*").alias("n"), F.slice(F.array_sort(F.collect_list(F.struct("pos", "raw"))), 1, 10).alias("s"), F.min("pos").alias("pos"))
    found = found.join(line.select(key, "line"), [key, "line"], "left_semi").withColumn("s", F.struct("line", "s"))
    counted = found.groupBy(key, "code").agg(F.sum("n").alias("n"), F.array_sort(F.collect_list("s")).alias("s"), F.min(F.struct("line", "pos")).alias("first"))
    samples = F.transform(F.slice(F.flatten(F.transform("s", lambda x: x["s"])), 1, 10), lambda x: x["raw"])
    english = line.groupBy(key).agg(F.sum("homes").alias("english"))
    return counted.join(english, key, "left").select(key, F.col("code").alias("lang"), "n", samples.alias("samples"), F.coalesce("english", F.lit(0)).alias("english"), "first")


def _words(lines: DataFrame, key: str) -> DataFrame:
    return lines.select(key, "line", F.posexplode(F.regexp_extract_all("p", F.lit("[\\p{L}\\p{N}_']+"), 0)).alias("pos", "found"))


def _classes(words: DataFrame, home: DataFrame, languages: DataFrame, right: DataFrame | None) -> DataFrame:
    """(found, freq, raw, counts, home, other, code) of each distinct string ``found``: whether it counts as a word, is of the home language or of another, and of which."""
    t = words.groupBy("found").agg(F.count("*").alias("freq")).withColumn("raw", F.regexp_replace("found", "^['0-9]+|['0-9]+$", ""))
    t = t.withColumn("counts", (F.col("raw") != "") & ~F.col("raw").rlike(ROMAN))
    t = t.withColumn("word", F.lower("raw")).withColumn("bare", F.regexp_replace("word", "'s$", "")).withColumn("long", F.length("raw") > 3)
    h = kept(home.select("word").distinct())
    t = t.join(h.withColumn("whole", F.lit(True)), "word", "left").join(h.select(F.col("word").alias("bare"), F.lit(True).alias("stem")), "bare", "left")
    t = t.withColumn("home", F.col("counts") & F.col("long") & F.coalesce("whole", "stem", F.lit(False)))
    initial = F.substring("raw", 1, 1)
    t = t.withColumn("other", F.col("counts") & F.col("long") & ~F.col("home") & (F.upper(initial) != initial) & ~F.col("raw").rlike("[0-9]"))
    t = t.join(languages.select("word", "lang"), "word", "left")
    code = F.coalesce("lang", F.lit("und"))
    if right is not None:
        t = t.join(right.select("word", F.lit(True).alias("right")).distinct(), "word", "left")
        code = F.concat(code, F.when(F.col("right").isNull(), "?").otherwise(""))
    return t.select("found", "freq", "raw", "counts", "home", "other", F.when(F.col("other"), code).alias("code"))


def foreign_report(words: DataFrame, docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, foreign, permille, lang, samples): foreign words of an article, per thousand of its words at spaces, and its main other language (of equal ones the first to appear)."""
    total = docs.select(key, F.size(F.split("text", " ")).alias("size"))
    best = F.max_by(F.struct("lang", "samples"), F.struct("n", -F.col("first.line"), -F.col("first.pos")))
    r = words.groupBy(key).agg(F.sum("n").alias("foreign"), best.alias("top")).join(total, key)
    return r.select(key, "foreign", F.expr("foreign * 1000 div size").alias("permille"), "top.lang", "top.samples")


def worst(report: DataFrame, key: str = "doc_id", most: int = 250) -> DataFrame:
    """Rows of the ``most`` articles with the most foreign words and of those with the greatest share, each once (a top-k report)."""
    report = kept(report)
    a, b = report.orderBy(F.desc("foreign"), key).limit(most), report.orderBy(F.desc("permille"), key).limit(most)
    return a.unionByName(b).dropDuplicates([key])


def language_table(words: DataFrame, languages: DataFrame) -> DataFrame:
    """(lang, name, size, place, word, margin): words by language, large languages first (place 1), in each the surest words first."""
    j = kept(words.select("word").distinct().join(languages, "word"))
    sizes = j.groupBy("lang").agg(F.count("*").alias("size"))
    # as many rows as languages
    placed = sizes.withColumn("place", F.row_number().over(Window.orderBy(F.desc("size"), "lang")))
    return j.join(placed, "lang").select("lang", language_name(F.col("lang")).alias("name"), "size", "place", "word", "margin")
