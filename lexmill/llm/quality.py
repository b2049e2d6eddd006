"""Quality rules with adaptive thresholds, from mergeable quantile sketches per language and source.

The sketch of a metric is a log-linear histogram: integers under 64 exactly, 32 cells an octave beyond, so a
quantile is at most 1/32 too low. Cells are counts, so sketches merge by adding: partial
aggregation merges those of tasks, and one more aggregate merges those of a language's sources, which count as
so many documents more of each group: thresholds of a small group lie near its language's, and those of a large one are its own. All metrics are integers: shares in per mille, of a whole that counts 100 letters (2 lines, 10 words) more than there are, so
that a single capital or number says little in a short text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.llm._common import checkpoint

UPPER, DIGITS, SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "#$%&*|!@^~<>=+_{}[]"
#: metric -> least spread (in its own units) that a fence allows beyond the quartiles
METRICS = {"symbol_permille": 20, "upper_permille": 50, "digit_permille": 150, "repeat_permille": 300, "stutter_permille": 50, "word_length_x10": 25}
FENCE = 4


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def metrics(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, n_words and METRICS) of each whole text; a null text counts as empty."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    d = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["lang"].alias("lang"), docs["source"].alias("source"), text.alias("text"))
    lines, tokens = F.split("text", "\n"), F.split("text", "[ \\t\\n\\r\\x0B\\f]+")
    d = d.select("doc_id", "lang", "source", "text", tokens.alias("w"), lines.alias("l"))
    d = d.select(
        "doc_id", "lang", "source", F.length("text").cast("bigint").alias("n"), F.expr("bigint(size(filter(w, x -> x != '')))").alias("n_words"), F.expr("bigint(size(filter(w, (x, i) -> x = get(w, i + 1))))").alias("stutters"),
        _count(F.col("text"), SYMBOLS).cast("bigint").alias("sym"), _count(F.col("text"), UPPER).cast("bigint").alias("up"), _count(F.col("text"), DIGITS).cast("bigint").alias("dig"),
        _count(F.col("text"), " \n\t\r").cast("bigint").alias("space"), F.size("l").cast("bigint").alias("lines"), F.size(F.array_distinct("l")).cast("bigint").alias("kinds"),
    )
    share = lambda part, whole: F.expr(f"{part} * 1000 div ({whole})")
    return d.select(
        "doc_id", "lang", "source", "n_words", share("sym", "n - space + 100").alias("symbol_permille"), share("up", "n - space + 100").alias("upper_permille"), share("dig", "n - space + 100").alias("digit_permille"),
        share("(lines - kinds)", "lines + 2").alias("repeat_permille"), share("stutters", "n_words + 10").alias("stutter_permille"), F.expr("coalesce((n - space) * 10 div nullif(n_words, 0), 0)").alias("word_length_x10"),
    )


def cell(x: str) -> Column:
    """Lowest value of the sketch's cell of the integer column ``x`` >= 0."""
    step = f"shiftleft(bigint(1), length(bin({x})) - 6)"
    return F.expr(f"case when {x} < 64 then {x} else {x} div {step} * {step} end")


def sketches(m: DataFrame) -> DataFrame:
    """(lang, source, metric, cell, n): the sketches of every group."""
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), F.col(k).alias("x")) for k in METRICS]))
    return m.select("lang", "source", pairs.alias("p")).select("lang", "source", "p.metric", F.col("p.x").alias("x")).groupBy("lang", "source", "metric", cell("x").alias("cell")).agg(F.count("*").alias("n"))


def quartiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """by, metric, total, q1, q3: the cells in which the cumulative count reaches a quarter and three quarters."""
    w = Window.partitionBy(*by, "metric")
    merged = sketch.groupBy(*by, "metric", "cell").agg(F.sum("n").alias("n"))
    c = merged.withColumn("upto", F.sum("n").over(w.orderBy("cell"))).withColumn("total", F.sum("n").over(w))
    at = lambda k: F.min(F.when(F.col("upto") * 4 >= F.col("total") * k, F.col("cell")))
    return c.groupBy(*by, "metric").agg(F.max("total").alias("total"), at(1).alias("q1"), at(3).alias("q3"))


def thresholds(sketch: DataFrame, prior: int = 30) -> DataFrame:
    """(lang, source, metric, low, high): fences FENCE interquartile ranges (or the metric's least spread) beyond the quartiles.

    A group's quartiles are averaged with those of its language, which weigh as much as ``prior`` documents, whatever the group's size.
    """
    own, lang = quartiles(sketch, ["lang", "source"]), quartiles(sketch, ["lang"]).select(F.col("lang").alias("l"), F.col("metric").alias("m"), F.col("q1").alias("l1"), F.col("q3").alias("l3"))
    j = own.join(lang, own["lang"].eqNullSafe(lang["l"]) & (own["metric"] == lang["m"]))
    q1, q3 = (F.expr(f"({a} * total + {b} * {prior}) div (total + {prior})") for a, b in (("q1", "l1"), ("q3", "l3")))
    j = j.select("lang", "source", "metric", q1.alias("q1"), q3.alias("q3"))
    least = F.coalesce(*[F.when(F.col("metric") == k, F.lit(v)) for k, v in METRICS.items()])
    spread = F.greatest((F.col("q3") - F.col("q1")) * FENCE, least.cast("bigint"))
    return j.select("lang", "source", "metric", (F.col("q1") - spread).alias("low"), (F.col("q3") + spread).alias("high"))


def quality_filter(docs: DataFrame, prior: int = 30) -> DataFrame:
    """(doc_id, lang, source, n_words and METRICS) of the documents inside all fences of their language and source.

    Texts with no words (null, empty, white space) go. Null lang or source values form groups of their own.
    Groups of equal values have the least spread as fence, so ties never empty a group. Repeated rows are judged
    alike, each kept or not on its own. Texts of any length count in whole. Extra columns are ignored whatever their names. An empty table gives an
    empty result. Metrics are computed once, over whole texts, and kept by checkpoint (without the texts).
    """
    m = checkpoint(metrics(docs))
    t = thresholds(sketches(m), prior)
    wide = t.groupBy("lang", "source").agg(*[F.max(F.when(F.col("metric") == k, F.col(s))).alias(f"{k}_{s}") for k in METRICS for s in ("low", "high")])
    wide = wide.withColumnsRenamed({"lang": "of_lang", "source": "of_source"})
    j = m.join(wide, m["lang"].eqNullSafe(wide["of_lang"]) & m["source"].eqNullSafe(wide["of_source"]))
    inside = F.col("n_words") > 0
    for k in METRICS:
        inside &= F.col(k).between(F.col(f"{k}_low"), F.col(f"{k}_high"))
    return j.where(inside).select(m.columns)


def quality_sql(prior: int = 30) -> str:
    count = lambda chars: f"(length(text) - length(translate(text, '{chars}', '')))"
    q = lambda by: (
        f"SELECT {by}, metric, max(total) AS total, min(cell) FILTER (WHERE upto * 4 >= total) AS q1, min(cell) FILTER (WHERE upto * 4 >= total * 3) AS q3 FROM "
        f"(SELECT *, sum(n) OVER (PARTITION BY {by}, metric ORDER BY cell) AS upto, sum(n) OVER (PARTITION BY {by}, metric) AS total FROM (SELECT {by}, metric, cell, sum(n) AS n FROM sk GROUP BY ALL)) GROUP BY {by}, metric"
    )
    least = " ".join(f"WHEN '{k}' THEN {v}" for k, v in METRICS.items())
    union = " UNION ALL ".join(f"SELECT lang, source, '{k}' AS metric, {k} AS x FROM m" for k in METRICS)
    fences = " AND ".join(f"EXISTS (SELECT 1 FROM th WHERE th.lang IS NOT DISTINCT FROM m.lang AND th.source IS NOT DISTINCT FROM m.source AND metric = '{k}' AND {k} BETWEEN low AND high)" for k in METRICS)
    return f"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
c AS (SELECT doc_id, lang, source, length(text) AS n, regexp_extract_all(text, '[^ \\t\\n\\r\\x0B\\f]+') AS w, {count(SYMBOLS)} AS sym, {count(UPPER)} AS up, {count(DIGITS)} AS dig,
  length(text) - length(replace(replace(replace(replace(text, ' ', ''), chr(10), ''), chr(9), ''), chr(13), '')) AS space,
  len(string_split(text, chr(10))) AS lines, len(list_distinct(string_split(text, chr(10)))) AS kinds FROM d),
m AS (SELECT doc_id, lang, source, len(w)::BIGINT AS n_words, (sym * 1000 // (n - space + 100))::BIGINT AS symbol_permille, (up * 1000 // (n - space + 100))::BIGINT AS upper_permille,
  (dig * 1000 // (n - space + 100))::BIGINT AS digit_permille, ((lines - kinds) * 1000 // (lines + 2))::BIGINT AS repeat_permille,
  (len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1])) * 1000 // (len(w) + 10))::BIGINT AS stutter_permille,
  coalesce((n - space) * 10 // nullif(len(w), 0), 0)::BIGINT AS word_length_x10 FROM c),
x AS ({union}),
sk AS (SELECT lang, source, metric, CASE WHEN x < 64 THEN x ELSE (x // (1::BIGINT << (length(bin(x)) - 6))) * (1::BIGINT << (length(bin(x)) - 6)) END AS cell, count(*) AS n FROM x GROUP BY ALL),
own AS ({q("lang, source")}), lg AS ({q("lang")}),
f AS (SELECT own.lang, own.source, own.metric, (own.q1 * own.total + lg.q1 * {prior}) // (own.total + {prior}) AS q1, (own.q3 * own.total + lg.q3 * {prior}) // (own.total + {prior}) AS q3
  FROM own JOIN lg ON own.lang IS NOT DISTINCT FROM lg.lang AND own.metric = lg.metric),
th AS (SELECT lang, source, metric, q1 - greatest((q3 - q1) * {FENCE}, CASE metric {least} END) AS low, q3 + greatest((q3 - q1) * {FENCE}, CASE metric {least} END) AS high FROM f)
SELECT * FROM m WHERE n_words > 0 AND {fences}
"""
