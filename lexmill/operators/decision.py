"""The spelling decision: tokens of an article, whether each is right, uncertain or wrong, and which wrong ones its context excuses.

Distinct tokens are judged, not occurrences: the rules are built-in expressions over them, and the dictionary is joined once for the
token, its trimmed form and its parts.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import classify, wikitext
from lexmill.functions.wikitext import CONTRACTIONS
from lexmill.operators.steps import kept, looked_up

OK, UNCERTAIN, WRONG = 0, 1, 2
BAD_WORDS = sorted({"you", "your", "gaol", "and/or", "{{formatnum:}}", "G-d", *CONTRACTIONS})
#: Characters that no word of prose should hold: ligatures, fractions, superscripts, enclosed and squared forms, odd dashes and quotes, sums for letters.
BAD_CHARACTERS = sorted(
    {c for a, z in ((0xFB00, 0xFB06), (0x2150, 0x215F), (0x2070, 0x207F), (0x2080, 0x208E), (0x2100, 0x2138), (0x2460, 0x24FF), (0x3190, 0x319F), (0x3200, 0x33FF), (0x1F100, 0x1F1AC), (0xFF01, 0xFF5E), (0xA732, 0xA73D)) for c in map(chr, range(a, z + 1)) if unicodedata.category(c) != "Cn"}
    | set("ǶƕỺỻꝎꝏꜨꜩᵫꭣꝠꝡ🙰⅓⅔¼½¾¹²³ǄǅǆǇǈǉǊǋǌ∑∏―‐‑‒‗‘‚‛“”„‟…´ⵯ№℔")
    - set("℃℉Åªº")
)
ALLOWED = [*",?!-()[]'\":.*#", *(t for n in "poem abbr caption samp bdi dfn".split() for t in (f"<{n}>", f"</{n}>")), "<mapframe/>", "<templatestyles/>", "</templatestyles>"]
_BASE = r"(?:[0-9]{1,4}|[0-9]{1,3},[0-9]{3}|[0-9]{1,3},[0-9]{3},[0-9]{3})(?:[.][0-9]+)?"
NUMBER = rf"^(?:(?:±|−|[+]|~|[$]|US[$]|€|£|₤|¥|₹|₴|₱)?{_BASE})"
TAG = r"^<[?]?/?[ ]*[a-zA-Z]+[ ]*/?[ ]*>"
ENTITY = r"^&#?[a-zA-Z0-9]+;"
SCIENCE = "^(?:m³|km³|ft³|µg|g|mg|L|µmol|people|inhabitants|kwh|cells)/(?:m|m2|m3|km2|cm|cm3|mi2|ft2|µL|mL|dL|g|kg|s|second|min|h|day|year)$"
SPLICE = "^[a-zA-Z]*[a-z][.][A-Z][a-zA-Z]*$"
#: One token: entity, tag, word with inner apostrophes, hyphens, dots, slashes or brackets, number, or any other character.
TOKEN = r"&#?[a-zA-Z0-9]+;|</?[a-zA-Z]+ ?/?>|[\p{L}\p{N}†$€£¥±−~+][\p{L}\p{M}\p{N}'’.,&/()–-]*|[^\s\p{L}\p{N}]"


def _in(word: Column, values: list[str]) -> Column:
    return word.isin(*values)


def bad_class() -> str:
    """Character class of BAD_CHARACTERS, in ranges."""
    out: list[list[int]] = []
    for c in map(ord, BAD_CHARACTERS):
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "[" + "".join(chr(a) if a == z else f"{chr(a)}-{chr(z)}" for a, z in out) + "]"


def trimmed(tokens: DataFrame, column: str = "raw") -> DataFrame:
    """Rows with ``token``: a raw token without markup at its ends: equals signs, hyphens, dashes, slashes and apostrophes at both, colons before it,
    semicolons unless it is an entity, commas, and brackets that don't pair. What is left of nothing goes.

    Each step is a column of its own, since the next one reads it several times. A generator drops what is left of nothing: a filter would go below
    the count of raw tokens, with all steps in it, and be judged for each occurrence.
    """
    t = F.regexp_replace(F.regexp_replace(F.regexp_replace(column, "^[=–/'-]+", ""), "[=–/',-]+$", ""), "^:+", "")
    d = tokens.withColumn("token", t)
    d = d.withColumn("token", F.when(F.col("token").rlike("^;|;$") & ~F.col("token").startswith("&"), F.regexp_replace("token", "^;+|;+$", "")).otherwise(F.col("token")))
    opened = F.length(F.translate("token", ")", "")) - F.length(F.translate("token", "(", ""))
    d = d.withColumn("opened", opened)
    token = F.when(F.col("opened") < 0, F.regexp_replace("token", "[)]+$", "")).when((F.col("opened") > 0) & F.col("token").endswith("("), F.regexp_replace("token", "[(]+$", "")).otherwise(F.col("token"))
    return d.withColumn("token", token).select(*[c for c in tokens.columns if c not in (column, "token")], F.explode(F.array_remove(F.array("token"), "")).alias("token"))


def raw_occurrences(articles: DataFrame, title: str = "title", text: str = "text", more: Column | None = None) -> DataFrame:
    """(title, raw) of every occurrence in prose; ``more``: an array of texts that are checked as well. Dots that end a sentence stay, for the decision."""
    whole = F.translate(F.regexp_replace(text, "—", " - "), "✂", " ")
    found = F.regexp_extract_all(whole, F.lit(TOKEN), 0)
    if more is not None:
        found = F.concat(found, F.flatten(F.transform(F.coalesce(more, F.array().cast("array<string>")), lambda x: F.regexp_extract_all(x, F.lit(TOKEN), 0))))
    return articles.select(F.col(title).alias("title"), F.explode(found).alias("raw"))


def occurrences(articles: DataFrame, title: str = "title", text: str = "text", more: Column | None = None) -> DataFrame:
    """(title, token, n): how often each token occurs in an article; raw tokens are counted before they are trimmed."""
    each = trimmed(raw_occurrences(articles, title, text, more).groupBy("title", "raw").agg(F.count("*").alias("n")))
    return each.groupBy("title", "token").agg(F.sum("n").alias("n"))


def token_counts(articles: DataFrame, title: str = "title", text: str = "text") -> DataFrame:
    """(token, freq) over all articles."""
    each = trimmed(raw_occurrences(articles, title, text).groupBy("raw").agg(F.count("*").alias("n")))
    return each.groupBy("token").agg(F.sum("n").alias("freq"))


def _core(token: Column) -> Column:
    """The token without dots at its end (unless it abbreviates), a dagger, and a plural in brackets."""
    t = F.when(token.rlike("[.]\\w[.]$"), token).otherwise(F.regexp_replace(token, "[.]+$", ""))
    t = F.regexp_replace(t, "^†+", "")
    return F.when(t.endswith("(s)"), F.concat(F.regexp_replace(t, "[(]s[)]$", ""), F.lit("s"))).otherwise(t)


def _first_rules(word: Column, known: Column) -> Column:
    """Decision of a whole token, null if its parts have to decide."""
    return (
        F.when(word == "", OK).when(_in(word, BAD_WORDS), WRONG).when(word.rlike(bad_class()), WRONG).when(known, OK).when(_in(word, ALLOWED), OK)
        .when(word.rlike(ENTITY), OK).when(word.rlike(TAG), WRONG).when(word.rlike(NUMBER), OK).when(word.rlike(SCIENCE), OK)
    )


def _last_rules(core: Column, dotted: Column) -> Column:
    """Decision of a token or part without separators that no dictionary has."""
    initial = F.substring(core, 1, 1)
    return F.when(core == "", OK).when(F.upper(initial) == initial, UNCERTAIN).when(core.rlike("^\\p{L}+$"), WRONG).when(core.rlike(SPLICE), F.when(dotted, OK).otherwise(WRONG)).otherwise(UNCERTAIN)


def decide(tokens: DataFrame, known: DataFrame) -> DataFrame:
    """(token, verdict) of distinct (token): the first rule that fits decides; of a token with dashes, hyphens or slashes that no rule fits the worst part counts.

    ``known``: (word) in lower case.
    """
    k = kept(known.select("word").distinct())
    t = tokens.select("token").distinct().withColumn("core", _core(F.col("token")))

    def flag(d: DataFrame, key: Column, name: str) -> DataFrame:
        return d.withColumn("look", key).join(k.select(F.col("word").alias("look"), F.lit(True).alias(name)), "look", "left").drop("look").withColumn(name, F.coalesce(name, F.lit(False)))

    t = flag(flag(t, F.lower("token"), "whole"), F.lower("core"), "trimmed")
    first = F.coalesce(_first_rules(F.col("token"), F.col("whole")), F.when(F.col("trimmed"), OK))
    t = kept(t.select("token", "core", first.alias("first")))
    parts = t.where("first is null").select("token", F.explode(F.split("core", "[—–/-]")).alias("part")).withColumn("core", _core(F.col("part")))
    parts = flag(flag(flag(parts, F.lower("part"), "whole"), F.lower("core"), "trimmed"), F.concat(F.lower("core"), F.lit(".")), "dotted")
    each = F.coalesce(_first_rules(F.col("part"), F.col("whole")), F.when(F.col("trimmed"), OK), _last_rules(F.col("core"), F.col("dotted")))
    worst = parts.groupBy("token").agg(F.max(each).alias("verdict"))
    return t.where("first is not null").select("token", F.col("first").alias("verdict")).unionByName(worst)


#: Spacing faults, found in the text and not in tokens, with any of which a token is a candidate even if uncertain.
SPACING = {
    "COMMA": r"[\p{L}\p{N}_]+[a-z],[\p{L}\p{N}_]{2,}|[\p{L}\p{N}_]{2,},[a-zA-Z][\p{L}\p{N}_]+",
    "BRACKET": r"[a-zA-Z]+[(][a-zA-Z]+[)]?|[a-zA-Z]+[)][a-zA-Z]+|[a-zA-Z]+\[[a-zA-Z]+\]?|[a-zA-Z]+\][a-zA-Z]+",
    "EXTRA": r"[\p{L}\p{N}_]+ ,[\p{L}\p{N}_]+|[\p{L}\p{N}_]+ [.][\p{L}\p{N}_]+|[\p{L}\p{N}_]+ [)]|[(] [\p{L}\p{N}_]+|\[ [\p{L}\p{N}_]+|[\p{L}\p{N}_]+ \]",
}
#: The same patterns for an engine that looks around: a word is run through once, from its beginning, and only if what has to follow it does.
_W = r"[\p{L}\p{N}_]"
_AHEAD = {
    "COMMA": rf"(?<!{_W})(?={_W}++,)(?:{SPACING['COMMA']})",
    "BRACKET": rf"(?<![a-zA-Z])(?=[a-zA-Z]++[()\[\]])(?:{SPACING['BRACKET']})",
    "EXTRA": rf"(?:(?<!{_W})(?={_W}++ [,.)\]])|(?=[(\[] ))(?:{SPACING['EXTRA']})",
}
_APOSTROPHES = "[^a-zA-Z](" + "|".join(sorted((w for w in BAD_WORDS if "'" in w), key=lambda w: (-len(w), w))) + ")(?:[^a-zA-Z])"


def spacing_candidates(articles: DataFrame, title: str = "title", text: str = "text") -> DataFrame:
    """(title, token, kind): words with missing or extra space around punctuation, and contractions; no genetics notation."""

    def found(kind: str, of: Column, pattern: str, group: int) -> Column:
        return F.transform(F.regexp_extract_all(of, F.lit(pattern), group), lambda x: F.struct(x.alias("token"), F.lit(kind).alias("kind")))

    kinds = [found(k, F.col(text), p, 0) for k, p in _AHEAD.items()]
    kinds.append(found("CONTRACTION", F.concat(F.lit(" "), F.col(text), F.lit(" ")), "(?i)" + _APOSTROPHES.replace("(", "(?=[a-zA-Z]*+')(", 1), 1))
    f = articles.select(F.col(title).alias("title"), F.explode(F.concat(*kinds)).alias("f")).select("title", "f.*")
    return f.where(~F.col("token").rlike("^4[0-9],X[XY]"))


def excused(token: Column, article: Column, chemical: Column | None = None) -> Column:
    """Whether the article's own text excuses a token: numbered lists, gaol fever, calibres, averages, moves of chess, and formulas that were written with subscripts."""
    has = lambda *x: F.greatest(*[F.coalesce(article.contains(s), F.lit(False)) for s in x]) if len(x) > 1 else F.coalesce(article.contains(x[0]), F.lit(False))
    lists = has("<ol start=", "<ol start =", "<ol type=")
    formula = classify.is_chemical_formula(token) if chemical is None else chemical
    return (
        F.when(token == "<li>", lists | has("<li value=", "<li value =")).when(token == "<ol>", lists)
        .when(token == "gaol", has("jail fever") & ~F.regexp_replace(article, "gaol fever", "").contains("gaol"))
        .when(token.rlike("[^ ]?[.][0-9]{2}s?$") & has("caliber", "calibre"), True)
        .when(token.rlike("[^ ]?[.][0-9]{3}$") & has("batting average", "fielding percentage", "slugging percentage"), True)
        .when(token.rlike(classify.CHESS_PIECE), True)
        .when(formula, ~has_token(article, token)).otherwise(False)
    )


def in_context(token: Column) -> Column:
    """Whether a token is one of those, besides formulas, of which ``excused`` asks the article."""
    return token.isin("<li>", "<ol>", "gaol") | token.rlike("[.][0-9]{2}s?$|[.][0-9]{3}$")


def has_token(article: Column, token: Column) -> Column:
    return F.coalesce(F.position(token, article) > 0, F.lit(False))


#: Beyond these a text can't be parsed: leftovers of markup, in the order in which they are looked for.
LEFTOVERS = ["<ref", "</ref>", "<blockquote", "</blockquote>", "}}", "{{", '"', "colspan", "rowspan", "cellspacing"]


def _quote(s: str) -> str:
    return "".join("\\" + c if c in "{}[]()|*+?.^$\\" else c for c in s)


def parse_failures(plain: DataFrame, title: str = "title", text: str = "text") -> DataFrame:
    """(title, code, item, around): what keeps an article from being checked, the first of: unequal template brackets, then LEFTOVERS, with up to 20 characters on either side.

    The code is ! or, where straight quotes don't pair beside curly ones, !Q.
    """
    return plain.select(F.col(title).alias("title"), _failure(text).alias("f")).where("f is not null").select("title", "f.*")


def _failure(text: str) -> Column:
    """(code, item, around) of what keeps an article from being checked, or null."""
    t = F.col(text)
    n = lambda p: F.regexp_count(t, F.lit(p))
    around = lambda s: F.array_join(F.regexp_extract_all(t, F.lit(f".{{0,20}}{_quote(s)}.{{0,20}}"), 0), " ... ")
    row = lambda code, item, text_: F.struct(F.lit(code).alias("code"), F.lit(item).alias("item"), text_.alias("around"))
    case = F.when(n("\\{\\{") != n("\\}\\}"), row("!", "{{ }}", F.lit("")))
    for s in LEFTOVERS:
        if s == '"':
            case = case.when(t.contains(s) & t.rlike("[“”]"), row("!Q", s, around(s)))
        case = case.when(t.contains(s), row("!", s, around(s)))
    return case


SPACED_DASH = ".{0,10}—\\s.{0,10}|.{0,10}\\s—.{0,10}"


def spaced_dashes(plain: DataFrame, title: str = "title", text: str = "text") -> DataFrame:
    """(title, n, around): em dashes with space beside them, with up to ten characters on either side."""
    found = F.regexp_extract_all(F.translate(text, "\n", " "), F.lit(SPACED_DASH), 0)
    return plain.select(F.col(title).alias("title"), found.alias("f")).where(F.size("f") > 0).select("title", F.size("f").alias("n"), F.array_join("f", " ... ").alias("around"))


def article_findings(articles: DataFrame, plain: DataFrame, known: DataFrame, hottest: int = 100_000) -> DataFrame:
    """(title, code, token, n): what the spell check says of each article (title, text) and its prose ``plain`` (title, text).

    @: a misspelled token; G: one that is uncertain and no formula. Articles that can't be parsed are left out, and so are tokens that their context excuses.
    Distinct tokens are judged first. Occurrences of the ``hottest`` go by a broadcast of those that aren't right, only the others' are shuffled, and only tokens
    that an article can excuse are joined with its text.
    """
    read = kept(plain.select("title", "text", _failure("text").isNotNull().alias("failed")))
    ok, failed = read.where("not failed").select("title", "text"), read.where("failed").select("title").distinct()
    raws = kept(raw_occurrences(ok).groupBy("raw").agg(F.count("*").alias("freq")))
    forms = kept(trimmed(raws.withColumn("from", F.col("raw"))))
    spaces = kept(spacing_candidates(ok).groupBy("title", "token", "kind").agg(F.count("*").alias("n")))
    verdicts = decide(forms.select("token").unionByName(spaces.select("token")), known).where("verdict > 0")
    verdicts = kept(verdicts.withColumn("formula", classify.is_chemical_formula(F.col("token"))))
    wrong = kept(forms.join(verdicts, "token").select(F.col("from").alias("raw"), "token", "verdict", "formula"))
    hot = kept(raws.orderBy(F.desc("freq"), "raw").limit(hottest).select("raw"))
    words = looked_up(raw_occurrences(ok), wrong, "raw", hot).groupBy("title", "token", "verdict", "formula").agg(F.count("*").alias("n")).withColumn("strict", F.lit(False))
    spaces = spaces.where(~(F.col("kind").isin("COMMA", "BRACKET") & classify.is_chemical_name(F.col("token")))).join(verdicts, "token").withColumn("strict", F.lit(True)).drop("kind")
    every = kept(words.unionByName(spaces).join(failed, "title", "left_anti"))
    open_ = in_context(F.col("token")) | F.col("formula")
    told = every.where(open_).join(articles.select("title", F.col("text").alias("article")), "title")
    told = told.withColumn("let_go", excused(F.col("token"), F.col("article"), F.col("formula"))).drop("article")
    each = told.unionByName(every.where(~open_).withColumn("let_go", F.col("token").rlike(classify.CHESS_PIECE)))
    ignored = (F.col("verdict") == UNCERTAIN) & ~F.col("strict") & ~F.col("let_go") & ~F.col("formula")
    code = F.when(ignored, "G").when(~F.col("let_go"), "@")
    return each.select("title", code.alias("code"), "token", "n").where("code is not null").groupBy("title", "code", "token").agg(F.sum("n").alias("n"))


def tally(findings: DataFrame) -> DataFrame:
    """(word, freq, articles, titles): misspellings, formulas as they are and all else in lower case, with how many articles have them and these articles, sorted."""
    word = F.when(classify.is_chemical_formula(F.col("token")), F.col("token")).otherwise(F.lower("token"))
    each = findings.where("code = '@'").groupBy(word.alias("word"), "title").agg(F.sum("n").alias("n"))
    return each.groupBy("word").agg(F.sum("n").alias("freq"), F.count("*").alias("articles"), F.array_sort(F.collect_list("title")).alias("titles"))


def dictionary_entries(articles: DataFrame, quotations: bool = False) -> DataFrame:
    """(title, text, plain, more) of dictionary pages (title, text): each language section as an article of its own, title#language, its prose, and linked words to check."""
    s = articles.select("title", F.explode(wikitext.sections_column(F.col("text"))).alias("language", "text"))
    s = s.select(F.concat_ws("#", "title", "language").alias("title"), "text")
    return s.select("title", "text", wikitext.body_column(F.col("text"), quotations).alias("plain"), wikitext.linked_words_column(F.col("text")).alias("more"))


def spell_report(articles: DataFrame, plain: DataFrame, known: DataFrame, skips: DataFrame) -> DataFrame:
    """(title, code, detail, n): all that the spell check says of articles: S skipped (why), ! and !Q not to be parsed (where), D spaced dashes (where), @ misspelled, G uncertain."""
    read = articles.join(skips.where("reason != 'data page'").select("title"), "title", "left_anti")
    body_ = plain.join(read.select("title"), "title", "left_semi")
    one = F.lit(1).cast("bigint").alias("n")
    return (
        skips.select("title", F.lit("S").alias("code"), F.col("reason").alias("detail"), one)
        .unionByName(parse_failures(body_).select("title", "code", F.concat_ws(" ", "item", "around").alias("detail"), one))
        .unionByName(spaced_dashes(body_).select("title", F.lit("D").alias("code"), F.col("around").alias("detail"), F.col("n").cast("bigint").alias("n")))
        .unionByName(article_findings(read, body_, known).select("title", "code", F.col("token").alias("detail"), "n"))
    )
