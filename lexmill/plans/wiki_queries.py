"""Queries over articles: the documents with a line of markup each, by their id, so that every rule meets what it looks for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import classify, wikitext
from lexmill.operators import articles as skips
from lexmill.operators import decision, entity_check, grammar, language, prose, reports, spelling, style, typos
from lexmill.operators.steps import kept, small_batches

SNIPPETS = [
    "It flows through the state of Washington and Washington State today.", "The yard was 20 x 30 feet, or 20x30 in all {{cleanup}}.", "a gap of 5&nbsp or more and 1-1/2 cups", '"so it is," they said of {{frac|1|2}} 3{{frac|1|2}}', "A bottle of 5 l and 20 ml/day, and (l) alone",
    "Add 2 cups of flour and ½ teaspoon salt.", "It lies 30 AU away, or 5 astronomical units from here.", "As shown (Smith 1999) and (January 2001).", "A value of 3·5 and one of 2,5 kg at 10 000 000 km", "about 5 Mio. people and 5 × 10<sup>6</sup> km", "v of 7 km s<sup>-1</sup> and 44 x 10<sup>7</sup> m",
    "They ran at 30 mph. It does 50 kph, or 20 mi/h.", "a man-made lake worth $5-million", "The rhyme scheme of the poem is ABAB, a.b.a.b or AA,B in each verse", "* birth_place = Paris, France\n| birth_date = 1950 | nationality = French |", "| birth_place = Lima, Peru\n| birth_date = 1850 |\n| nationality = Peruvian",
    "| birthplace = Texas\n| citizenship = Germany", "Ohm &Omega; and &alpha; &dashv; &frasl; &#8217; &hellip; R&B; &foo; ㎞ ﬁne", "{{lang|fr|&alpha; ‘ici’}} &alpha; ½ cup ‘quoted’ … and ㍘ ㍘", "{{copy edit}} This needs help.", "Water is H2O and salt NaCl; also Ca(OH) and MgCl2·6H2O, Mn(II).", "It is wrong,but the word(s) are xyz(abc) and a ,b you know; don't.",
    "See [[File:x.jpg|thumb]] and [[Target page|display text]] of {{em dash}} {{ISBN|978-3-16}}.", "{| class=x\n|-\n| cell\n|}\nafter the table <ref name=a>cited</ref> text", "Bold '''text''' and ''italic words'' here.<br>Next", "== References ==\n* a source\n* b source", "word — spaced and word—close, {{unclosed", "A batting average of .350 and 4x4 of http://a.org/b?c=1 x y",
    'title="a b "| and cosθ and №5 with <b>', "teh recieve wich is not alot of dots .And more.There", "m<sup>2</sup> and 1<sup>st</sup> and H<sub>2</sub>O and 10<sup>9</sup>", 'She said "this is not closed and “curly” stays', "The dog saw a cat. The old man walks to London. Dogs not.", "#REDIRECT [[Somewhere else]]",
]
_LIST = "[" + ", ".join("'" + s.replace("'", "''").replace("\n", "' || chr(10) || '") + "'" for s in SNIPPETS) + "]"
_ARTICLES = f"articles AS (SELECT doc_id, doc_id::VARCHAR AS title, lang, text || chr(10) || ({_LIST})[1 + (doc_id % {len(SNIPPETS)})::INT] AS text FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL)"
QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def articles(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, title, lang, text): every document with one of SNIPPETS as its last line."""
    snippet = F.get(F.array(*[F.lit(s) for s in SNIPPETS]), (F.col("doc_id") % len(SNIPPETS)).cast("int"))
    a = spark.read.parquet(f"{d}/documents.parquet").where("doc_id is not null and text is not null").select("doc_id", F.col("doc_id").cast("string").alias("title"), "lang", F.concat_ws("\n", "text", snippet).alias("text"))
    small_batches(spark)
    return spread(a)


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores, where a file of one row group would be a single task; larger inputs have as many parts as they need and stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _known(spark: SparkSession, d: str) -> DataFrame:
    docs = spread(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text", "lang"))
    return spelling.dictionary(spelling.word_counts(docs)).select("word").distinct()


_KNOWN = r"known AS (SELECT DISTINCT word FROM (SELECT lang, word FROM (SELECT DISTINCT doc_id, lang, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS word FROM documents) GROUP BY lang, word HAVING count(*) >= 3))"
q = lambda p: p.replace("'", "''")


@_query(style.check_lines_sql(source=f"(WITH {_ARTICLES} SELECT * FROM articles)"))
def style_findings(spark: SparkSession, d: str) -> DataFrame:
    return style.check_lines(articles(spark, d)).drop("evidence")


@_query(f"WITH f AS ({style.check_lines_sql(source=f'(WITH {_ARTICLES} SELECT * FROM articles)')}), s AS (SELECT code, doc_id, count(*) AS n FROM f GROUP BY ALL) SELECT coalesce(code, 'TOTAL') AS code, count(*) AS uniques, coalesce(sum(n), 0) AS instances FROM s GROUP BY ROLLUP (code)")
def style_by_rating(spark: SparkSession, d: str) -> DataFrame:
    return reports.by_rating(style_findings(spark, d).select("code", F.col("doc_id").alias("word")))


_ORDER = ("QL", "XS", "MAN_MADE", "W")


@_query(f"WITH f AS ({style.check_lines_sql(source=f'(WITH {_ARTICLES} SELECT * FROM articles)')}) SELECT doc_id, arg_min(code, lpad(coalesce(nullif(list_position({list(_ORDER)}, code), 0), 5)::VARCHAR, 2, '0') || code) AS best FROM f GROUP BY doc_id")
def best_finding(spark: SparkSession, d: str) -> DataFrame:
    return reports.best_type(style_findings(spark, d), _ORDER)


@_query()
def nationality_findings(spark: SparkSession, d: str) -> DataFrame:
    return style.nationality(articles(spark, d)).withColumn("bucket", style.nationality_bucket(F.col("code")))


def _leftover_case() -> str:
    parts = ["WHEN len(regexp_extract_all(text, '\\{\\{')) <> len(regexp_extract_all(text, '\\}\\}')) THEN {'code': '!', 'item': '{{ }}', 'around': ''}"]
    around = lambda s: f"array_to_string(regexp_extract_all(text, '.{{0,20}}{q(decision._quote(s))}.{{0,20}}'), ' ... ')"
    for s in decision.LEFTOVERS:
        if s == '"':
            parts.append(f"WHEN contains(text, '{s}') AND regexp_matches(text, '[“”]') THEN {{'code': '!Q', 'item': '{s}', 'around': {around(s)}}}")
        parts.append(f"WHEN contains(text, '{s}') THEN {{'code': '!', 'item': '{s}', 'around': {around(s)}}}")
    return "CASE " + " ".join(parts) + " END"


@_query(f"WITH {_ARTICLES}, f AS (SELECT title, {_leftover_case()} AS f FROM articles) SELECT title, f.code AS code, f.item AS item, f.around AS around FROM f WHERE f IS NOT NULL")
def parse_failures(spark: SparkSession, d: str) -> DataFrame:
    return decision.parse_failures(articles(spark, d))


@_query(f"WITH {_ARTICLES}, f AS (SELECT title, regexp_extract_all(replace(text, chr(10), ' '), '{decision.SPACED_DASH}') AS f FROM articles) SELECT title, len(f)::INT AS n, array_to_string(f, ' ... ') AS around FROM f WHERE len(f) > 0")
def spaced_dashes(spark: SparkSession, d: str) -> DataFrame:
    return decision.spaced_dashes(articles(spark, d))


@_query(
    f"WITH {_ARTICLES}, f AS (" + " UNION ALL ".join(f"SELECT title, unnest(regexp_extract_all(text, '{q(p)}')) AS token, '{k}' AS kind FROM articles" for k, p in decision.SPACING.items())
    + f" UNION ALL SELECT title, unnest(regexp_extract_all(' ' || text || ' ', '(?i){q(decision._APOSTROPHES)}', 1)), 'CONTRACTION' FROM articles) SELECT title, kind, token, count(*) AS n FROM f WHERE NOT regexp_matches(token, '^4[0-9],X[XY]') GROUP BY ALL"
)
def spacing_candidates(spark: SparkSession, d: str) -> DataFrame:
    return decision.spacing_candidates(articles(spark, d)).groupBy("title", "kind", "token").agg(F.count("*").alias("n"))


def _decide_sql() -> str:
    """The decision over tok (token) and known (word), by the same rules in DuckDB."""
    lst = lambda v: "(" + ", ".join("'" + q(x) + "'" for x in v) + ")"
    core = lambda t: f"regexp_replace(regexp_replace(CASE WHEN regexp_matches({t}, '[.]\\w[.]$') THEN {t} ELSE regexp_replace({t}, '[.]+$', '') END, '^†+', ''), '[(]s[)]$', 's')"
    first = lambda t, known, trimmed: (
        f"CASE WHEN {t} = '' THEN 0 WHEN {t} IN {lst(decision.BAD_WORDS)} THEN 2 WHEN regexp_matches({t}, '{q(decision.bad_class())}') THEN 2 WHEN {known} THEN 0 WHEN {t} IN {lst(decision.ALLOWED)} THEN 0 WHEN regexp_matches({t}, '{decision.ENTITY}') THEN 0 "
        f"WHEN regexp_matches({t}, '{decision.TAG}') THEN 2 WHEN regexp_matches({t}, '{decision.NUMBER}') THEN 0 WHEN regexp_matches({t}, '{decision.SCIENCE}') THEN 0 WHEN {trimmed} THEN 0"
    )
    return f"""k AS (SELECT DISTINCT word FROM known),
d1 AS (SELECT token, {core("token")} AS core FROM tok),
d2 AS (SELECT token, core, {first("token", "a.word IS NOT NULL", "b.word IS NOT NULL")} END AS v FROM d1 LEFT JOIN k a ON a.word = lower(token) LEFT JOIN k b ON b.word = lower(core)),
p1 AS (SELECT token, unnest(regexp_split_to_array(core, '[—–/-]')) AS part FROM d2 WHERE v IS NULL),
p2 AS (SELECT token, part, {core("part")} AS core FROM p1),
p3 AS (SELECT token, {first("part", "a.word IS NOT NULL", "b.word IS NOT NULL")} WHEN core = '' THEN 0 WHEN upper(left(core, 1)) = left(core, 1) THEN 1 WHEN regexp_matches(core, '^\\p{{L}}+$') THEN 2 WHEN regexp_matches(core, '{decision.SPLICE}') THEN CASE WHEN c.word IS NOT NULL THEN 0 ELSE 2 END ELSE 1 END AS v
  FROM p2 LEFT JOIN k a ON a.word = lower(part) LEFT JOIN k b ON b.word = lower(core) LEFT JOIN k c ON c.word = lower(core) || '.'),
verdict AS (SELECT token, v AS verdict FROM d2 WHERE v IS NOT NULL UNION ALL SELECT token, max(v) FROM p3 GROUP BY token)"""


_TRIM = "regexp_replace(regexp_replace(regexp_replace(raw, '^[=–/''-]+', ''), '[=–/'',-]+$', ''), '^:+', '')"
_SEMI = f"CASE WHEN left({_TRIM}, 1) = '&' THEN {_TRIM} ELSE regexp_replace(regexp_replace({_TRIM}, '^;+', ''), ';+$', '') END"
_PAIR = "CASE WHEN length(replace(t, ')', '')) < length(replace(t, '(', '')) THEN regexp_replace(t, '[)]+$', '') WHEN length(replace(t, '(', '')) < length(replace(t, ')', '')) AND right(t, 1) = '(' THEN regexp_replace(t, '[(]+$', '') ELSE t END"
_TOKENS = f"r AS (SELECT title, unnest(regexp_extract_all(translate(replace(text, '—', ' - '), '✂', ' '), '{q(decision.TOKEN)}')) AS raw FROM articles), occ AS (SELECT title, {_PAIR} AS token FROM (SELECT title, {_SEMI} AS t FROM r)), tok AS (SELECT DISTINCT token FROM occ WHERE token <> '')"


@_query(f"WITH {_ARTICLES}, {_KNOWN}, {_TOKENS}, {_decide_sql()} SELECT token, verdict, freq FROM verdict JOIN (SELECT token, count(*) AS freq FROM occ GROUP BY token) USING (token)")
def spelling_verdicts(spark: SparkSession, d: str) -> DataFrame:
    t = kept(decision.token_counts(articles(spark, d)))
    return t.join(decision.decide(t, _known(spark, d)), "token").select("token", "verdict", "freq")


@_query()
def article_findings(spark: SparkSession, d: str) -> DataFrame:
    a = articles(spark, d).select("title", "text")
    return decision.article_findings(a, a.select("title", wikitext.body_column(F.col("text")).alias("text")), _known(spark, d))


@_query()
def misspelling_tally(spark: SparkSession, d: str) -> DataFrame:
    return decision.tally(article_findings(spark, d))


def _unknown(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    docs = spread(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text", "lang"))
    counts = spelling.word_counts(docs)
    return counts, spelling.dictionary(counts), counts.where("docs < 3 and lang is not null")


@_query()
def word_categories(spark: SparkSession, d: str) -> DataFrame:
    """(word, category, freq): every token of the articles that isn't right, by the cascade of categories."""
    known = kept(_unknown(spark, d)[1])
    tokens = kept(decision.token_counts(articles(spark, d)))
    wrong = kept(tokens.join(decision.decide(tokens, known).where("verdict = 2"), "token").select(F.col("token").alias("word"), F.lower("token").alias("low"), "freq"))
    low = wrong.select(F.lit("x").alias("lang"), F.col("low").alias("word")).distinct()
    words = known.select(F.lit("x").alias("lang"), "word").distinct()
    compound = spelling.compounds(low, words).select(F.col("word").alias("low"), F.lit(True).alias("compound"))
    near = spelling.near_words(low, words).select(F.col("word").alias("low")).distinct().withColumn("near", F.lit(1))
    lang = language.word_languages(low, language.pair_costs(known)).select(F.col("word").alias("low"), "lang")
    j = wrong.join(compound, "low", "left").join(near, "low", "left").join(lang, "low", "left")
    no = F.lit(False)
    c = classify.category(F.col("word"), F.lower("word").isin(*decision.BAD_WORDS) | F.col("word").isin(*decision.BAD_WORDS), F.col("word").rlike(decision.bad_class()), F.coalesce("compound", no) & ~F.col("word").contains("."), no, no, F.col("near"), F.coalesce("lang", F.lit("und")))
    # a column of its own, since the kind of white space reads it several times
    return j.select("word", "freq", c.alias("category")).select("word", classify.whitespace_kind(F.col("word"), F.col("category")).alias("category"), "freq")


@_query(
    f"WITH {_ARTICLES}, w AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[^ \\t\\n\\r]+')) AS word FROM articles) SELECT word, regexp_matches(word, '{classify.CHEMICAL_FORMULA}') AND NOT regexp_matches(word, '{classify.NO_FORMULA}') AS formula, regexp_matches(word, '{classify.CHESS_PIECE}') AS chess,"
    f" regexp_matches(word, '{classify.FORMULA_OF_LETTERS}') OR (regexp_matches(word, '[Α-Ωα-ω]') AND regexp_matches(word, '[-/]')) AS mathematics, regexp_matches(word, '{classify.URL}') AS address FROM w"
)
def word_flags(spark: SparkSession, d: str) -> DataFrame:
    w = articles(spark, d).select(F.explode(F.regexp_extract_all("text", F.lit("[^ \\t\\n\\r]+"), 0)).alias("word")).distinct()
    return w.select("word", classify.is_chemical_formula(F.col("word")).alias("formula"), F.col("word").rlike(classify.CHESS_PIECE).alias("chess"), classify.is_mathematics(F.col("word")).alias("mathematics"), classify.is_address(F.col("word")).alias("address"))


@_query()
def entity_findings(spark: SparkSession, d: str) -> DataFrame:
    return entity_check.entity_findings(articles(spark, d))


@_query()
def entity_report(spark: SparkSession, d: str) -> DataFrame:
    return entity_check.entity_report(entity_findings(spark, d))


@_query()
def entity_fix_list(spark: SparkSession, d: str) -> DataFrame:
    """The first 2,500 articles to fix (a top-k report)."""
    return entity_check.fix_list(entity_findings(spark, d))


@_query()
def fixed_text(spark: SparkSession, d: str) -> DataFrame:
    return articles(spark, d).select("doc_id", entity_check.fixed(F.col("text")).alias("text"))


@_query()
def plain_text(spark: SparkSession, d: str) -> DataFrame:
    return articles(spark, d).select("doc_id", wikitext.body_column(F.col("text")).alias("text"))


_ELSE = f"regexp_matches(text, '{q(skips.CLEANUP)}')"


@_query(f"WITH {_ARTICLES} SELECT title, CASE WHEN doc_id % 50 = 7 THEN 'title' ELSE 'template' END AS reason FROM articles WHERE doc_id % 50 = 7 OR {_ELSE}")
def skipped_articles(spark: SparkSession, d: str) -> DataFrame:
    a = articles(spark, d)
    return skips.skipped(a, a.where("doc_id % 50 = 7").select("title"))


@_query(f"WITH {_ARTICLES}, f AS (SELECT title, unnest(regexp_extract_all(text, '([A-Za-z0-9)}}]{{0,8}}<su[bp]>[^<]{{1,40}}</su[bp]>)', 1)) AS found FROM articles) SELECT title, found FROM f")
def superscripts(spark: SparkSession, d: str) -> DataFrame:
    return skips.triage(articles(spark, d)).select("title", "found")


@_query(f"WITH {_ARTICLES}, t AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '[A-Za-z0-9()]+')) AS formula FROM articles), n AS (SELECT formula, count(*) AS articles, list_sort(list(doc_id))[:100] AS examples FROM t WHERE regexp_matches(formula, '{classify.FORMULA}') AND regexp_matches(formula, '[0-9(]') GROUP BY formula) SELECT * FROM n")
def chemical_formulas(spark: SparkSession, d: str) -> DataFrame:
    return prose.formulas(articles(spark, d))


@_query(f"WITH {_ARTICLES}, l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, (generate_subscripts(string_split(text, chr(10)), 1) - 1)::INT AS line_no FROM articles) SELECT doc_id, line_no, line FROM l WHERE regexp_matches(line, '[0-9] ?mph|@[a-z]+\\.')")
def grep_lines(spark: SparkSession, d: str) -> DataFrame:
    return prose.grep_lines(articles(spark, d), "[0-9] ?mph|@[a-z]+\\.")


_B, _Z = "(^|[^\\p{L}])", "($|[^\\p{L}])"
TYPOS = [("Doubled the", r"\b[Tt]he the\b", "the"), ("An before consonant", r"\ban ([bcdfgjklmnpqrstvwxyz]\w+)", "a $1"), ("Doubled is", r"\bis is\b", "is"), ("Doubled la", r"\bla la\b", "la"), ("Comma gap", " ,", ","), ("Receive", r"\b([Rr])eciev(e|ed|ing)\b", "$1eceiv$2"), ("Which", r"\b([Ww])ich\b", "$1hich"), ("Alot", r"\balot\b", "a lot")]
TYPOS += [(f"Doubled {w}", rf"\b{w} {w}\b", w) for w in "of and in to that was with for on as at by from or it be are this which have had but not his her they we an one all".split()]


_TYPOS_SQL = typos.scan_sql(TYPOS, f"WITH {_ARTICLES} SELECT doc_id, text FROM articles")


@_query(_TYPOS_SQL)
def typo_rules(spark: SparkSession, d: str) -> DataFrame:
    return typos.scan(articles(spark, d), TYPOS, "doc_id", aggressive=False, ascii_words=True)


@_query(f"WITH f AS ({_TYPOS_SQL}) SELECT rule, count(*) AS n FROM f GROUP BY rule")
def rule_frequencies(spark: SparkSession, d: str) -> DataFrame:
    return typos.rule_frequencies(typo_rules(spark, d))


@_query()
def typos_in_prose(spark: SparkSession, d: str) -> DataFrame:
    return typos.scan(articles(spark, d), TYPOS, "doc_id")


@_query(typos.compliance_sql(f"WITH {_ARTICLES} SELECT title, text FROM articles"))
def compliance_changes(spark: SparkSession, d: str) -> DataFrame:
    return typos.compliance_changes(articles(spark, d))


_LANG_COUNTS = r"v AS (SELECT lang, word FROM (SELECT DISTINCT doc_id, lang, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS word FROM documents) WHERE lang IS NOT NULL GROUP BY lang, word HAVING count(*) >= 3)"
_LANG_SQL = f"""{_LANG_COUNTS},
pr AS (SELECT lang, word, '^' || word || '$' AS p FROM v), lp AS (SELECT lang, unnest(list_transform(range(1, length(p)), lambda i: p[i:i + 1])) AS pair FROM pr),
lc AS (SELECT lang, pair, count(*) AS n FROM lp GROUP BY ALL), lt AS (SELECT lang, sum(n) AS total, count(*) AS kinds FROM lc GROUP BY lang),
cost AS (SELECT lang, pair, round(-1000 * ln((n + 1)::DOUBLE / (total + kinds + 1)))::BIGINT AS cost FROM lc JOIN lt USING (lang)), un AS (SELECT lang, round(-1000 * ln(1::DOUBLE / (total + kinds + 1)))::BIGINT AS unseen FROM lt),
wp AS (SELECT word, unnest(list_transform(range(1, length(word) + 2), lambda i: ('^' || word || '$')[i:i + 1])) AS pair FROM (SELECT DISTINCT word FROM v)), sz AS (SELECT word, count(*) AS pairs FROM wp GROUP BY word),
sv AS (SELECT word, lang, sum(unseen - cost) AS saved FROM wp JOIN cost USING (pair) JOIN un USING (lang) GROUP BY ALL),
ec AS (SELECT sz.word, un.lang, pairs, pairs * unseen - coalesce(saved, 0) AS cost FROM sz CROSS JOIN un LEFT JOIN sv ON sv.word = sz.word AND sv.lang = un.lang),
rk AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY cost, lang) AS k, lead(cost) OVER (PARTITION BY word ORDER BY cost, lang) AS next FROM ec)
SELECT word, lang, trunc((next - cost)::DOUBLE / pairs)::BIGINT AS margin FROM rk WHERE k = 1"""


@_query(f"WITH {_LANG_SQL}")
def word_languages(spark: SparkSession, d: str) -> DataFrame:
    known = kept(_unknown(spark, d)[1].where("lang is not null"))
    return language.word_languages(known, language.pair_costs(known))


@_query(f"WITH x AS (WITH {_LANG_SQL}), s AS (SELECT lang, count(*) AS size FROM x GROUP BY lang), n AS (SELECT *, row_number() OVER (ORDER BY size DESC, lang) AS place FROM s) SELECT x.lang, CASE x.lang WHEN 'en' THEN 'English' WHEN 'de' THEN 'German' WHEN 'fr' THEN 'French' WHEN 'es' THEN 'Spanish' ELSE x.lang END AS name, size, place::INT AS place, word, margin FROM x JOIN n USING (lang)")
def language_table(spark: SparkSession, d: str) -> DataFrame:
    known = kept(_unknown(spark, d)[1].where("lang is not null"))
    return language.language_table(known, language.word_languages(known, language.pair_costs(known)))


_FOREIGN_SQL = rf"""{_LANG_SQL.split("wp AS")[0]}
vw AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\p{{L}}+')) AS word FROM documents),
wp AS (SELECT word, unnest(list_transform(range(1, length(word) + 2), lambda i: ('^' || word || '$')[i:i + 1])) AS pair FROM vw), {_LANG_SQL.split("FROM (SELECT DISTINCT word FROM v)), ")[1].split("SELECT word, lang, trunc")[0].rstrip()},
lg AS (SELECT word, lang FROM rk WHERE k = 1), en AS (SELECT word FROM v WHERE lang = 'en'), kn AS (SELECT DISTINCT word FROM v),
dl AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS p, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM documents WHERE doc_id IS NOT NULL),
dr AS (SELECT doc_id, line, unnest(x) AS raw0, generate_subscripts(x, 1) - 1 AS pos FROM (SELECT doc_id, line, regexp_extract_all(p, '[\p{{L}}\p{{N}}_'']+') AS x FROM dl)),
dw AS (SELECT doc_id, line, pos, regexp_replace(raw0, '^[''0-9]+|[''0-9]+$', '', 'g') AS raw FROM dr),
dx AS (SELECT *, lower(raw) AS word, regexp_replace(lower(raw), '['']s$', '') AS bare FROM dw WHERE raw <> '' AND NOT regexp_matches(raw, '{language.ROMAN}')),
dy AS (SELECT dx.*, length(raw) > 3 AND (a.word IS NOT NULL OR b.word IS NOT NULL) AS home FROM dx LEFT JOIN en a ON a.word = dx.word LEFT JOIN en b ON b.word = dx.bare),
dz AS (SELECT *, length(raw) > 3 AND NOT home AND upper(left(raw, 1)) <> left(raw, 1) AND NOT regexp_matches(raw, '[0-9]') AS other FROM dy),
ok AS (SELECT doc_id, line FROM dz GROUP BY ALL HAVING count(*) >= 20 AND count(*) FILTER (WHERE other) > 0 AND count(*) FILTER (WHERE home) * 3 <= count(*) AND count(*) FILTER (WHERE other) * 2 >= count(*) FILTER (WHERE home)),
fo AS (SELECT dz.*, coalesce(lg.lang, 'und') || CASE WHEN kn.word IS NULL THEN '?' ELSE '' END AS lang FROM dz JOIN ok USING (doc_id, line) LEFT JOIN lg ON lg.word = dz.word LEFT JOIN kn ON kn.word = dz.word WHERE other),
fc AS (SELECT doc_id, lang, count(*) AS n, list(raw ORDER BY line, pos)[:10] AS samples, min(line * 1000000 + pos) AS first_at FROM fo GROUP BY ALL),
ft AS (SELECT *, sum(n) OVER (PARTITION BY doc_id) AS "foreign", row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first_at) AS r FROM fc),
fr AS (SELECT ft.doc_id, "foreign", "foreign" * 1000 // len(string_split(text, ' ')) AS permille, ft.lang, samples FROM ft JOIN documents USING (doc_id) WHERE r = 1),
top AS (SELECT *, row_number() OVER (ORDER BY "foreign" DESC, doc_id) AS a, row_number() OVER (ORDER BY permille DESC, doc_id) AS b FROM fr)
SELECT doc_id, "foreign", permille, lang, samples FROM top WHERE a <= 250 OR b <= 250"""


@_query(f"WITH {_FOREIGN_SQL}")
def foreign_report(spark: SparkSession, d: str) -> DataFrame:
    """The 250 articles with the most words of other languages than English and those with the greatest share (a top-k report)."""
    counts = kept(_unknown(spark, d)[0])
    known = kept(spelling.dictionary(counts).where("lang is not null"))
    docs = spread(spark.read.parquet(f"{d}/documents.parquet").where("doc_id is not null").select("doc_id", "text"))
    langs = language.word_languages(counts, language.pair_costs(known))
    found = language.foreign_words(docs, known.where("lang = 'en'"), langs, known)
    return language.worst(language.foreign_report(found, docs))


@_query()
def grammar_findings(spark: SparkSession, d: str) -> DataFrame:
    lexicon = spark.createDataFrame([(w, p) for p, ws in {"N": "dog dogs cat man flour salt lake yard feet bottle value km people rhyme poem verse help water text words table source", "V": "saw walks ran does flows lies needs shown closed", "ADJ": "old open small close", "ADV": "today away here there alone"}.items() for w in ws.split()], "word string, pos string")
    return grammar.grammar_findings(articles(spark, d).where(F.length("text") < 2000), lexicon)


_PREFIXES = ", ".join(f"left(word, {k}) AS p{k}, count(*) OVER (PARTITION BY left(word, {k})) AS n{k}" for k in range(1, 6))
_UNKNOWN = r"unk AS (SELECT DISTINCT word FROM (SELECT lang, word, count(DISTINCT doc_id) AS docs FROM (SELECT doc_id, lang, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS word FROM documents) GROUP BY ALL) WHERE docs < 3 AND lang IS NOT NULL)"


@_query(reports.merge_sections_sql(f"WITH {_UNKNOWN}, p AS (SELECT word, {_PREFIXES} FROM unk) SELECT CASE WHEN n1 <= 50 THEN p1 WHEN n2 <= 50 THEN p2 WHEN n3 <= 50 THEN p3 WHEN n4 <= 50 THEN p4 ELSE p5 END AS section, count(*) AS n FROM p GROUP BY 1"))
def merged_sections(spark: SparkSession, d: str) -> DataFrame:
    s = reports.sections(_unknown(spark, d)[2]).groupBy("section").agg(F.count("*").alias("n"))
    return reports.merge_sections(s)


@_query(f"WITH {_KNOWN.replace('known AS', 'kn AS')}, t AS (SELECT lang, word, count(*) AS freq, count(DISTINCT doc_id) AS docs FROM (SELECT doc_id, lang, unnest(regexp_extract_all(lower(text), '\\p{{L}}+')) AS word FROM documents) GROUP BY ALL) SELECT lang, word, freq, docs FROM t WHERE docs < 3 AND lang IS NOT NULL AND freq > 4 AND docs >= 2 AND (left(word, 1) BETWEEN 'a' AND 'm' OR NOT regexp_matches(left(word, 1), '^[a-z]$'))")
def active_frequent(spark: SparkSession, d: str) -> DataFrame:
    return reports.frequent(reports.active_half(_unknown(spark, d)[2])).select("lang", "word", "freq", "docs")
