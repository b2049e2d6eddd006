"""Typo rules over articles: cleaning, rules by length, the first match of each with its surroundings, and how often rules hit.

Thousands of rules aren't columns of one plan. They go to the workers as one value, whose size is that of the rule list; of an article
only rules are tried of which some literal that every match needs (an anchor) occurs in it, found by one automaton pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.wikitext import GUARDS, MARK, body, substituted
from lexmill.operators.steps import small_batches

Rule = tuple[str, str, str]
_ATTRIBUTES = re.compile("<(ref|span) .*?>")
_ALWAYS = [re.compile(p, re.S) for p in (r"https?://[^ \n|&]+", r"[0-9a-zA-Z.-]+\.(?:com|edu|org|gov)", "<!--.*?-->", r"\{\{(?:not a typo|char|proper name).*?\}\}", r"\| *image[0-9]* *=.*?\n")]
GUARDS[_ALWAYS[1]] = (".com", ".edu", ".org", ".gov")
_AGGRESSIVE = [
    re.compile(p, re.S)
    for p in (
        r"<ref(?: .*?>|>).*?</ref>|<ref .*?/>", *(rf"<{n}[^>]*>.*?</{n}>" for n in ("gallery", "code", "syntaxhighlight", "math", "score")), r"\{\|.*?\|\}", r"\{\{[Ii]nfobox(?:[^}]+\{\{.*?\}\})+.*?\}\}", r"\{\{[Ii]nfobox.*?\}\}",
        r"\[\[(?:File|Image):.*\]\]", r"\{\{(?:[Ll]ang|IPA).*?\}\}", r"\{\{\w+-tv-\w-stub\}\}",
    )
]


def clean(text: str | None, aggressive: bool = False) -> str | None:
    """The text without addresses, comments and marked spans; if ``aggressive``, its prose alone, without what may hold names of any kind."""
    if text is None:
        return None
    text = _ATTRIBUTES.sub(r"<\1>", text)
    for p in _ALWAYS:
        text = substituted(p, MARK, text)
    if aggressive:
        text = body(text) or ""
        for p in _AGGRESSIVE:
            text = p.sub(MARK, text)
    return text


def anchor(pattern: str) -> str:
    """The longest run of plain characters, of at least three, that every match of the pattern contains; empty if none is sure."""
    if "|" in pattern or re.search(r"\(\?[^:=!<P]", pattern):
        # alternatives outside groups, or flags: nothing is sure
        if re.search(r"\(\?[^:=!<P]", pattern):
            return ""
    best, run, depth, i = "", "", 0, 0
    while i < len(pattern):
        c = pattern[i]
        quantified = i + 1 < len(pattern) and pattern[i + 1] in "?*{"
        if depth == 0 and c == "|":
            return ""
        if c == "\\":
            run, i = "", i + 2
            continue
        if c == "[":
            close = pattern.find("]", i + (3 if pattern[i + 1 : i + 2] == "^" else 2))
            run, i = "", (close if close > 0 else len(pattern)) + 1
            continue
        if c in "()":
            depth += 1 if c == "(" else -1
            run = ""
        elif depth == 0 and (c.isalpha() or c in " ,;:'-") and not quantified:
            run += c
            best = max(best, run, key=len)
        else:
            run = ""
        i += 1
    return best if len(best) >= 3 else ""


def ordered(rules: Sequence[Rule], frequency: dict[str, int] | None = None, which: str = "all") -> list[Rule]:
    """Rules by length and text, or those that hit often, seldom or never so far, the most frequent first."""
    rules = sorted(rules, key=lambda r: (len(r[1]), r[1]))
    n = frequency or {}
    if which == "extinct":
        return [r for r in rules if r[0] not in n]
    if which in ("high", "low"):
        return sorted((r for r in rules if r[0] in n and (n[r[0]] >= 100) == (which == "high")), key=lambda r: -n[r[0]])
    return rules


def to_python(replacement: str) -> str:
    """A replacement with $1 as the rules are written, for Python's expressions."""
    return re.sub(r"\$(\d)", r"\\\1", replacement.replace("\\", "\\\\"))


def scan(articles: DataFrame, rules: Sequence[Rule], key: str = "title", aggressive: bool = True, around: int = 10, frequency: dict[str, int] | None = None, skip: Sequence[str] = (), ascii_words: bool = False) -> DataFrame:
    """(key, rule, before, after, frequency): of each rule its first match in an article, with ``around`` characters on both sides and what the rule makes
    of them; matches that it leaves as they are give no row. Articles with one of the strings ``skip`` are passed over. A null text gives no row. With
    ``ascii_words``, letters beyond ASCII aren't parts of words for \\b and \\w, as in other engines."""
    small_batches(articles.sparkSession)
    given, past = [(n, p, to_python(t)) for n, p, t in rules], dict(frequency or {})

    @F.pandas_udf("array<struct<rule:string,before:string,after:string>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import ahocorasick

        tried = [(n, re.compile(p, re.ASCII if ascii_words else 0), t, anchor(p)) for n, p, t in given]
        always = [i for i, r in enumerate(tried) if not r[3]]
        by: dict[str, list[int]] = {}
        for i, r in enumerate(tried):
            if r[3]:
                by.setdefault(r[3], []).append(i)
        auto = ahocorasick.Automaton()
        for word, which in by.items():
            auto.add_word(word, which)
        if by:
            auto.make_automaton()

        def one(text: str | None) -> list[dict]:
            if text is None or any(s in text for s in skip):
                return []
            text = clean(text, aggressive) or ""
            wanted = set(always)
            for _, which in auto.iter(text) if by else ():
                wanted.update(which)
            out = []
            for i in sorted(wanted):
                name, p, to, _ = tried[i]
                m = p.search(text)
                if m:
                    before = text[max(0, m.start() - around) : m.end() + around]
                    after = p.sub(to, before)
                    if after != before:
                        out.append({"rule": name, "before": before.replace("\n", "\\n").replace("\t", "\\t"), "after": after.replace("\n", "\\n").replace("\t", "\\t")})
            return out

        for texts in batches:
            yield pd.Series([one(t) for t in texts])

    found = articles.select(key, F.explode(run(F.col("text"))).alias("f")).select(key, "f.*")
    seen = F.coalesce(*[F.when(F.col("rule") == n, F.lit(c)) for n, c in past.items()], F.lit(0)) if 0 < len(past) <= 50 else None
    if seen is None:
        table = articles.sparkSession.createDataFrame(list(past.items()), "rule string, frequency int")
        return found.join(table, "rule", "left").select(key, "rule", "before", "after", F.coalesce("frequency", F.lit(0)).alias("frequency"))
    return found.withColumn("frequency", seen)


def scan_sql(rules: Sequence[Rule], source: str, around: int = 10) -> str:
    """Rows of ``scan`` for DuckDB, of articles (doc_id, text) without aggressive cleaning and with ascii_words."""
    q = lambda x: x.replace("'", "''")
    text = f"regexp_replace(text, '{_ATTRIBUTES.pattern}', '<\\1>', 'g')"
    for p in _ALWAYS:
        text = f"regexp_replace({text}, '(?s){q(p.pattern)}', '{MARK}', 'g')"
    values = ", ".join(f"('{q(n)}', '{q(p)}', '(?s)^(.*?)(?:{q(p)})', '{q(to_python(t))}')" for n, p, t in rules)
    line = lambda c: f"replace(replace({c}, chr(10), '\\n'), chr(9), '\\t')"
    return f"""WITH a AS ({source}), c AS (SELECT doc_id, {text} AS text FROM a), r(rule, p, ahead, t) AS (VALUES {values}),
m AS (SELECT doc_id, rule, p, t, text, regexp_extract(text, p) AS hit, length(regexp_extract(text, ahead, 1)) AS ahead_n FROM c, r WHERE regexp_matches(text, p)),
s AS (SELECT doc_id, rule, p, t, substr(text, greatest(ahead_n - {around}, 0) + 1, least(ahead_n, {around}) + length(hit) + {around}) AS before FROM m),
f AS (SELECT doc_id, rule, before, regexp_replace(before, p, t, 'g') AS after FROM s)
SELECT doc_id, rule, {line("before")} AS before, {line("after")} AS after, 0 AS frequency FROM f WHERE before <> after"""


def rule_frequencies(found: DataFrame) -> DataFrame:
    """(rule, n): in how many articles each rule hit; the frequencies of the next scan."""
    return found.groupBy("rule").agg(F.count("*").alias("n"))


# -- Rewrites for compliance --

#: pattern, replacement, text of articles to leave alone.
COMPLIANCE = [
    *((rf"title={q}([^{q}]+)\s*{q}\s*\|", "title=\\1 |", "") for q in "\"'"), (r"N°\s+(\d)", r"Number \1", "Image:Cal12 N°8.jpg"), (r"n°\s+(\d)", r"number \1", ""), (r"№\s+(\d)", r"Number \1", "Numero sign"), ("№", "Number", "Numero sign"),
    *((f"{a}([a-zA-Z]+){z}", "{{angbr|\\1}}", "") for a, z in ("<>", ("&lt;", "&gt;"))), *((f"{f}θ", f"{f} θ", "") for f in ("cos", "sin", "tan")),
]


def compliance_changes(articles: DataFrame, key: str = "title", text: str = "text") -> DataFrame:
    """(key, before, after): distinct strings of an article that a rule of COMPLIANCE changes; of several rules the first one's result."""

    def changed(k: int, pattern: str, to: str, unless: str) -> Column:
        java = to.replace("\\1", "$1").replace("{{", "\\{\\{").replace("}}", "\\}\\}")
        hits = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), 0))
        hits = F.when(~F.col(text).contains(unless), hits).otherwise(F.array().cast("array<string>")) if unless else hits
        return F.transform(hits, lambda x: F.struct(x.alias("before"), F.lit(k).alias("k"), F.regexp_replace(x, pattern, java).alias("after")))

    each = [changed(k, *rule) for k, rule in enumerate(COMPLIANCE)]
    f = articles.select(key, F.explode(F.concat(*each)).alias("f")).where("f.before != f.after")
    return f.groupBy(key, F.col("f.before").alias("before")).agg(F.min_by("f.after", "f.k").alias("after"))


def compliance_sql(source: str) -> str:
    """Rows of ``compliance_changes`` for DuckDB, of articles (title, text)."""
    q = lambda x: x.replace("'", "''")
    each = [
        f"SELECT title, x AS before, {k} AS k, regexp_replace(x, '{q(p)}', '{q(to)}', 'g') AS after FROM (SELECT title, unnest(list_distinct(regexp_extract_all(text, '{q(p)}'))) AS x FROM a" + (f" WHERE NOT contains(text, '{unless}')" if unless else "") + ")"
        for k, (p, to, unless) in enumerate(COMPLIANCE)
    ]
    return f"WITH a AS ({source}), f AS ({' UNION ALL '.join(each)}) SELECT title, before, arg_min(after, k) AS after FROM f WHERE before <> after GROUP BY title, before"


def escaped(text: Column) -> Column:
    """Text for HTML."""
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def json_escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))


def one_line(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\n"), F.lit("\\n")), F.lit("\t"), F.lit("\\t"))
