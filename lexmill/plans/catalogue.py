"""Registered queries over the driver's tables, with their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import classify, wikitext
from lexmill.operators import graph, prose, reports, spelling
from lexmill.operators.steps import kept
from lexmill.plans import wiki_queries

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _read(spark: SparkSession, d: str, table: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{table}.parquet").select(*columns)


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return wiki_queries.spread(_read(spark, d, "documents", "doc_id", "text", "lang"))


def _counts(spark: SparkSession, d: str) -> DataFrame:
    return spelling.word_counts(_docs(spark, d))


def _known_unknown(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    counts = kept(_counts(spark, d))
    known = spelling.dictionary(counts)
    # what the dictionary doesn't have is the rest of the same counts; an anti join would count the words again
    return known, counts.where("docs < 3 and lang is not null")


_TALLY = r"""
t AS (SELECT doc_id, lang, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS word FROM documents),
c AS (SELECT lang, word, count(*) AS freq, count(DISTINCT doc_id) AS docs FROM t GROUP BY lang, word),
known AS (SELECT lang, word FROM c WHERE docs >= 3), unk AS (SELECT * FROM c WHERE docs < 3 AND lang IS NOT NULL)"""
_LINES = r"l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, (generate_subscripts(string_split(text, chr(10)), 1) - 1)::INT AS line_no FROM documents)"
_EDGES = r"""e AS (SELECT DISTINCT src, dst FROM (SELECT lower(regexp_extract(line, '^[^\p{L}]*(\p{L}+)', 1)) AS src, lower(regexp_extract(line, '(\p{L}+)[^\p{L}]*$', 1)) AS dst FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)) WHERE src <> dst AND src <> '' AND dst <> '')"""
_SEED = "the"


@_query(f"WITH {_TALLY} SELECT word, lang, freq, docs FROM unk ORDER BY freq DESC, word, lang LIMIT 50")
def oov_top_words(spark: SparkSession, d: str) -> DataFrame:
    """The 50 most frequent words outside the dictionary (a top-k report)."""
    return _known_unknown(spark, d)[1].select("word", "lang", "freq", "docs").orderBy(F.desc("freq"), "word", "lang").limit(50)


@_query(f"WITH {_TALLY} SELECT * FROM c")
def token_frequencies(spark: SparkSession, d: str) -> DataFrame:
    return _counts(spark, d)


@_query(f"WITH {_TALLY} SELECT * FROM known")
def dictionary_words(spark: SparkSession, d: str) -> DataFrame:
    return spelling.dictionary(_counts(spark, d))


@_query(f"WITH {_TALLY}, s AS (SELECT lang, word, unnest(range(1, length(word))) AS i FROM unk WHERE length(word) > 1) SELECT s.lang, s.word, count(*) AS splits FROM s JOIN known a ON a.lang = s.lang AND a.word = s.word[:i] JOIN known b ON b.lang = s.lang AND b.word = s.word[i + 1:] GROUP BY ALL")
def compound_words(spark: SparkSession, d: str) -> DataFrame:
    known, unknown = _known_unknown(spark, d)
    return spelling.compounds(unknown, known)


_DELETED = "SELECT DISTINCT lang, word, unnest(list_concat([word], list_transform(range(1, length(word) + 1), lambda i: word[:i - 1] || word[i + 1:]))) AS key"


_WITHOUT = lambda w: f"list_transform(range(1, length({w}) + 1), lambda i: {w}[:i - 1] || {w}[i + 1:])"
_ONE_EDIT = f"""SELECT * FROM p WHERE list_contains({_WITHOUT("suggestion")}, word) OR list_contains({_WITHOUT("word")}, suggestion)
 OR (length(word) = length(suggestion) AND (len(list_filter(range(1, length(word) + 1), lambda i: word[:i - 1] || word[i + 1:] = suggestion[:i - 1] || suggestion[i + 1:])) > 0
 OR list_contains(list_transform(range(1, length(word)), lambda i: word[:i - 1] || word[i + 1] || word[i] || word[i + 2:]), suggestion)))"""


@_query(f"WITH {_TALLY}, a AS ({_DELETED} FROM unk), b AS ({_DELETED} FROM known), p AS (SELECT DISTINCT a.lang, a.word, b.word AS suggestion FROM a JOIN b ON a.lang = b.lang AND a.key = b.key) {_ONE_EDIT}")
def near_words(spark: SparkSession, d: str) -> DataFrame:
    known, unknown = _known_unknown(spark, d)
    return spelling.near_words(unknown, known)


@_query(f"WITH {_TALLY}, w AS (SELECT DISTINCT word FROM c) SELECT word, array_to_string(list_sort(list_distinct(string_split(word, ''))), '') AS key FROM w")
def lowfi_keys(spark: SparkSession, d: str) -> DataFrame:
    return _counts(spark, d).select("word").distinct().select("word", classify.lowfi_key(F.col("word")).alias("key"))


_VOWELS = "[aeiouyáéíóúàèìòùâêîôûäëïöüAEIOUYÁÉÍÓÚÀÈÌÒÙÂÊÎÔÛÄËÏÖÜ]+"


@_query(rf"""WITH s AS (SELECT doc_id, greatest(len(regexp_extract_all(text, '[.!?]+')), 1)::BIGINT AS sentences, greatest(len(regexp_extract_all(text, '\p{{L}}+')), 1)::BIGINT AS words,
 len(regexp_extract_all(text, '{_VOWELS}'))::BIGINT AS syllables, len(regexp_extract_all(text, '\p{{L}}'))::BIGINT AS letters FROM documents WHERE length(text) >= 1000)
SELECT *, 206.835::DOUBLE - 1.015::DOUBLE * (words / sentences) - 84.6::DOUBLE * (syllables / words) AS flesch, 5.89::DOUBLE * (letters / words) - 29.5::DOUBLE * (sentences / words) - 15.8::DOUBLE AS coleman_liau FROM s""")
def readability(spark: SparkSession, d: str) -> DataFrame:
    return prose.readability(_docs(spark, d))


@_query(f"""WITH {_LINES}, p AS (SELECT doc_id, line_no AS paragraph, line AS p FROM l WHERE length(line) >= 100 AND regexp_matches(line, '[.!?''"]$')),
q AS (SELECT *, list_filter(regexp_split_to_array(p, '[.!?]+'), lambda x: trim(x) <> '') AS parts FROM p)
SELECT doc_id, paragraph, len(regexp_extract_all(p, '[^ ]+'))::BIGINT AS words, len(parts)::BIGINT AS sentences, coalesce(list_max(list_transform(parts, lambda x: len(regexp_extract_all(x, '[^ ]+')))), 0)::BIGINT AS longest FROM q""")
def paragraph_stats(spark: SparkSession, d: str) -> DataFrame:
    return prose.paragraph_stats(_docs(spark, d))


@_query(rf"""WITH {_TALLY}, {_LINES}, w AS (SELECT l.doc_id, lang, line_no AS paragraph, unnest(regexp_extract_all(line, '\p{{L}}+')) AS raw FROM l JOIN documents d ON d.doc_id = l.doc_id),
f AS (SELECT w.doc_id, paragraph, raw, known.word AS home FROM w LEFT JOIN known ON known.lang = w.lang AND known.word = lower(raw)),
s AS (SELECT doc_id, paragraph, count(*) AS words, count(home) AS home, count(*) FILTER (WHERE home IS NULL AND length(raw) > 3 AND NOT regexp_matches(raw, '^\p{{Lu}}')) AS foreign_ FROM f GROUP BY ALL)
SELECT doc_id, paragraph, words, home, foreign_ AS "foreign" FROM s WHERE words >= 20 AND home * 3 <= words AND foreign_ * 2 >= home""")
def foreign_passages(spark: SparkSession, d: str) -> DataFrame:
    known = kept(_counts(spark, d).where("docs >= 3"))
    hot = known.where("lang is not null").orderBy(F.desc("freq"), "word", "lang").limit(100_000)
    return prose.foreign_passages(_docs(spark, d), known.select("lang", "word"), hot=hot.select("lang", "word"))


@_query("""WITH x AS (SELECT page_id, unnest(regexp_extract_all(html, '&#?[a-zA-Z0-9]+;')) AS entity FROM pages)
SELECT entity, CASE WHEN entity LIKE '&#%' THEN 'NUMERIC' WHEN entity IN ('&lt;', '&gt;', '&amp;', '&quot;', '&nbsp;') THEN 'KEEP' ELSE 'NAMED' END AS kind, count(*) AS instances, count(DISTINCT page_id) AS uniques, list_sort(list(DISTINCT page_id))[:5000] AS pages FROM x GROUP BY entity""")
def entity_tally(spark: SparkSession, d: str) -> DataFrame:
    return prose.entity_tally(_read(spark, d, "pages", "page_id", "html"))


@_query("SELECT page_id, replace(replace(html, '&middot;', '·'), '&copy;', '©') AS text FROM pages")
def decoded_entities(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, "pages", "page_id", "html").select("page_id", wikitext.decoded_column(F.col("html")).alias("text"))


@_query("SELECT doc_id FROM documents WHERE contains(text, 'License')")
def grep_literal(spark: SparkSession, d: str) -> DataFrame:
    return prose.grep(_docs(spark, d), "License", literal=True)


@_query("SELECT doc_id FROM documents WHERE regexp_matches(text, '[0-9]{3}-[0-9]{4}')")
def grep_regex(spark: SparkSession, d: str) -> DataFrame:
    return prose.grep(_docs(spark, d), "[0-9]{3}-[0-9]{4}")


_MAGNITUDE = "CASE WHEN freq < 10 THEN freq::VARCHAR ELSE freq::VARCHAR[1] || repeat('0', length(freq::VARCHAR) - 1) || '-' || freq::VARCHAR[1] || repeat('9', length(freq::VARCHAR) - 1) END".replace("freq::VARCHAR[1]", "left(freq::VARCHAR, 1)")


@_query(f"WITH {_TALLY} SELECT {_MAGNITUDE} AS bucket, count(*) AS n FROM c GROUP BY 1")
def frequency_histogram(spark: SparkSession, d: str) -> DataFrame:
    return reports.histogram(_counts(spark, d), "freq")


@_query(f"WITH {_LINES} SELECT line, count(*) AS n FROM l GROUP BY line")
def line_counts(spark: SparkSession, d: str) -> DataFrame:
    return reports.line_counts(_docs(spark, d))


@_query(r"WITH t AS (SELECT doc_id, unnest(regexp_extract_all(text, '[\p{L}''’]+')) AS word FROM documents) SELECT word, CASE WHEN regexp_matches(word, '[''’]s$') THEN 'S' WHEN regexp_matches(word, '^\p{Lu}') THEN 'P' ELSE '*' END AS class, count(*) AS total, count(DISTINCT doc_id) AS articles FROM t GROUP BY word")
def uncertain_rollup(spark: SparkSession, d: str) -> DataFrame:
    words = _docs(spark, d).select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("[\\p{L}'’]+"), 0)).alias("word"))
    return reports.uncertain_rollup(words)


_PREFIXES = ", ".join(f"left(word, {k}) AS p{k}, count(*) OVER (PARTITION BY left(word, {k})) AS n{k}" for k in range(1, 6))


@_query(f"WITH {_TALLY}, w AS (SELECT DISTINCT word FROM unk), p AS (SELECT word, {_PREFIXES} FROM w) SELECT word, CASE WHEN n1 <= 50 THEN p1 WHEN n2 <= 50 THEN p2 WHEN n3 <= 50 THEN p3 WHEN n4 <= 50 THEN p4 ELSE p5 END AS section FROM p")
def word_sections(spark: SparkSession, d: str) -> DataFrame:
    return reports.sections(_known_unknown(spark, d)[1])


@_query(r"""WITH e AS (SELECT regexp_extract(url, '^(?:[a-z]+://[^/]+)?/([^?#]*)', 1) AS src, unnest(regexp_extract_all(html, '<a href="([^"]+)"', 1)) AS t FROM pages)
SELECT DISTINCT src, regexp_extract(t, '^(?:[a-z]+://[^/]+)?/([^?#]*)', 1) AS dst FROM e WHERE src <> regexp_extract(t, '^(?:[a-z]+://[^/]+)?/([^?#]*)', 1)""")
def page_links(spark: SparkSession, d: str) -> DataFrame:
    return graph.page_links(_read(spark, d, "pages", "url", "html"))


def _edges(spark: SparkSession, d: str) -> DataFrame:
    return graph.line_links(_docs(spark, d))


def _seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(_SEED,)], "node string")


@_query(f"WITH {_EDGES} SELECT src, count(*) AS out FROM e GROUP BY src HAVING count(*) >= 2")
def out_degrees(spark: SparkSession, d: str) -> DataFrame:
    return graph.degrees(_edges(spark, d), 2)


_REACH = "(SELECT '{s}' AS node UNION SELECT e.{b} FROM {r} r JOIN e ON e.{a} = r.node)"


@_query(f"WITH RECURSIVE {_EDGES}, fwd AS {_REACH.format(s=_SEED, a='src', b='dst', r='fwd')} SELECT node FROM fwd")
def reachable_pages(spark: SparkSession, d: str) -> DataFrame:
    return graph.reachable(_edges(spark, d), _seed(spark)).select("node")


@_query(f"WITH RECURSIVE {_EDGES}, fwd AS {_REACH.format(s=_SEED, a='src', b='dst', r='fwd')}, bwd AS {_REACH.format(s=_SEED, a='dst', b='src', r='bwd')} SELECT node FROM fwd INTERSECT SELECT node FROM bwd")
def main_loop(spark: SparkSession, d: str) -> DataFrame:
    return graph.loop_of(_edges(spark, d), _seed(spark))


@_query(f"WITH {_EDGES} SELECT DISTINCT dst AS node FROM e WHERE dst NOT IN (SELECT src FROM e)")
def dead_ends(spark: SparkSession, d: str) -> DataFrame:
    return graph.dead_ends(_edges(spark, d))


QUERIES |= wiki_queries.QUERIES
ORACLE_SQL |= wiki_queries.ORACLE_SQL
