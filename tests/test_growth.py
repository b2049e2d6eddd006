"""Steps whose cost must not grow faster than their input, against the plain way to the same rows."""

import random

import pandas as pd
from pyspark.sql import functions as F

from lexmill.functions import classify, entities, wikitext
from lexmill.operators import decision, entity_check, grammar, graph, language, prose, spelling, style, typos
from lexmill.plans.wiki_queries import SNIPPETS
from tests.compare import oracle, rows


def _texts(n=60, seed=3):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdéß") for _ in range(r.randint(1, 6))) for _ in range(40)]
    return [(i, "en" if i % 3 else "de", "\n".join(" ".join(r.choice(words) for _ in range(r.randint(1, 30))) for _ in range(3))) for i in range(n)]


def test_word_counts(spark):
    rows_ = [*_texts(), (1, "en", "abc abc repeated"), (1, "de", "abc"), (None, "en", "abc"), (None, "en", "abc"), (99, None, "abc É é"), (98, "en", None), (97, "en", "")]
    docs = spark.createDataFrame(rows_, "doc_id long, lang string, text string")
    assert rows(spelling.word_counts(docs)) == rows(spelling.tally(spelling.tokens(docs)))
    # no row per word and document: nothing is shuffled by document where ids are distinct
    once = docs.where("doc_id > 1")
    assert rows(spelling.word_counts(once)) == rows(spelling.tally(spelling.tokens(once)))
    assert "doc_id" not in "".join(x for x in spelling.word_counts(once)._jdf.queryExecution().executedPlan().toString().splitlines(True) if "Exchange" in x)


def test_foreign_passages_with_frequent_words(spark):
    docs = spark.createDataFrame(_texts(), "doc_id long, lang string, text string")
    known = spark.createDataFrame([("en", w) for w in {x for _, _, t in _texts()[:3] for x in t.split()[:9]}], "lang string, word string")
    plain = rows(prose.foreign_passages(docs, known, least=5))
    assert plain[1] and rows(prose.foreign_passages(docs, known, least=5, hot=known.limit(3))) == plain


def test_foreign_words_by_hot_and_other_words(spark):
    docs = spark.createDataFrame(_texts(), "doc_id long, lang string, text string").select("doc_id", "text")
    words = sorted({x for _, _, t in _texts() for x in t.split()})
    home, langs = spark.createDataFrame([(w,) for w in words[::9]], "word string"), spark.createDataFrame([(w, "fr" if len(w) % 2 else "de") for w in words[::2]], "word string, lang string")
    for long_only in (True, False):
        got = [rows(language.foreign_words(docs, home, langs, home, least=5, long_only=long_only, hottest=n)) for n in (1, 7, 1000)]
        assert got[0][1] and got[0] == got[1] == got[2]
        # samples: the first ten in order
        f = language.foreign_words(docs, home, langs, None, least=5, long_only=long_only, hottest=7).where("lang = 'und'").orderBy(F.desc("n"), "doc_id").first()
        text, first = docs.where(F.col("doc_id") == f.doc_id).first().text, f.first["line"]
        said = [w for line in text.split("\n")[first:] for w in line.split()]
        at = iter(said)
        assert all(s in at for s in f.samples) and len(f.samples) == min(10, f.n)


def test_word_languages_shuffles_words_once(spark):
    v = spark.createDataFrame([("en", "the"), ("en", "thing"), ("de", "schicht"), ("fr", "eau")], "lang string, word string")
    words = spark.createDataFrame([("schicht",), ("thither",), ("q",)], "word string")
    near = language.word_languages(words, language.pair_costs(v))
    assert rows(near) == rows(language.word_languages(words, language.pair_costs(v), broadcast_limit=0))
    assert near._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("SortMergeJoin") == 0


def test_line_links_of_odd_lines(spark):
    texts = ["alpha beta", "1 alpha, gamma 2!\nbeta", "", "42", "x", "ü-Ö y\rz", "a b\n\nDE f."]
    got = {(r.src, r.dst) for r in graph.line_links(spark.createDataFrame([(t,) for t in texts], "text string")).collect()}
    assert got == {("alpha", "beta"), ("alpha", "gamma"), ("ü", "z"), ("a", "b"), ("de", "f")}
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "src string, dst string")
    seed = spark.createDataFrame([("a",)], "node string")
    assert rows(graph.loop_of(e, seed))[1] == [("a",), ("b",), ("c",)] and rows(graph.dead_ends(e))[1] == [("d",)]
    # the filter reads words that were extracted once, in a generator
    plan = graph.line_links(spark.createDataFrame([(t,) for t in texts], "text string"))._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.splitlines() if "Filter" in x and "regexp_extract" in x]


def test_tokens_are_trimmed_once(spark):
    a = spark.createDataFrame([("1", "a; 'b' (c == ,"), ("2", "a (c) &amp; '' — b")], "title string, text string")
    plan = decision.token_counts(a)._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" not in plan  # one with all steps would be below the count of raw tokens
    assert {r.token: r.freq for r in decision.token_counts(a).collect()}["b"] == 2


def test_spacing_looks_around(spark):
    r = random.Random(5)
    texts = [("".join(r.choice("aB1é_ ,.()[]  x,(") for _ in range(200)),) for _ in range(150)] + [("Don't say 'tis, y'all's o'clock'd I'm'",)]
    d = spark.createDataFrame(texts, "text string")
    for k, p in decision.SPACING.items():
        both = d.select(F.regexp_extract_all("text", F.lit(p), 0).alias("a"), F.regexp_extract_all("text", F.lit(decision._AHEAD[k]), 0).alias("b")).collect()
        assert any(x.a for x in both) and all(x.a == x.b for x in both)


def test_chemical_names_to_the_end(spark):
    words = ["h" * 40 + "ex" * 40, "hexane", "table", "h" * 3 + "ex" * 3]
    got = spark.createDataFrame([(w,) for w in words], "w string").select(classify.is_chemical_name(F.col("w")).alias("c")).collect()
    assert [x.c for x in got] == [True, True, False, True]


def test_rhyme_scores(spark):
    r = random.Random(2)
    words = ["".join(r.choice("aabbcm") for _ in range(r.randint(1, 12))) for _ in range(300)]

    def scheme(w):
        every = [w[i : i + k] for k in (2, 3) for i in range(len(w) - k + 1)]
        kinds = set(every)
        repeated, doubled, seen = sum(every.count(x) > 1 for x in kinds), sum(x[0] == x[1] for x in kinds), 0
        for c in w:
            seen = seen if seen < 0 or ord(c) - 96 <= seen else seen + 1 if ord(c) - 97 == seen else -1
        score = 50 * all(c in "abcdefg" for c in w) - 30 * any(c >= "m" for c in w) + 10 * (doubled + repeated) + 50 * (repeated * 2 > len(kinds))
        return w in ("cdcd", "efef") or seen > 0 or score > 100

    got = spark.createDataFrame([(w,) for w in words], "w string").select("w", classify.is_rhyme_scheme(F.col("w")).alias("r")).collect()
    assert {x.r for x in got} == {True, False} and all(x.r == scheme(x.w) for x in got)


def test_findings_by_hot_and_other_tokens(spark):
    texts = [("1", "teh cat saw .350 and teh H2O Xq. zzz,yyy"), ("2", "A batting average of .350 or .38 caliber teh zzz"), ("3", "broken {{ teh"), ("4", "qwrt Nf3 H<sub>2</sub>O")]
    a = spark.createDataFrame(texts, "title string, text string")
    plain = a.withColumn("text", F.regexp_replace("text", "</?sub>", ""))
    known = spark.createDataFrame([(w,) for w in "cat saw and or of a batting average caliber".split()], "word string")
    got = [rows(decision.article_findings(a, plain, known, hottest=n)) for n in (1, 5, 1000)]
    assert got[0] == got[1] == got[2]
    f = {(r.title, r.token): r.code for r in decision.article_findings(a, plain, known).collect()}
    assert f["1", "teh"] == "@" and ("3", "teh") not in f and ("4", "Nf3") not in f and not any(t == ".350" and i == "2" for i, t in f)
    # the whole tally: with each word the sorted articles that have it
    t = {r.word: (r.freq, r.articles, r.titles) for r in decision.tally(decision.article_findings(a, plain, known)).collect()}
    assert t["teh"] == (3, 2, ["1", "2"]) and t["qwrt"][2] == ["4"]
    # no row per token and whole article: texts are joined for the tokens that an article can excuse alone
    plan = decision.article_findings(a, plain, known)._jdf.queryExecution().optimizedPlan().toString()
    assert [x for x in plan.splitlines() if "Filter" in x and "[.][0-9]{2}s?$" in x]


def test_style_rules_as_in_their_sql(spark):
    r = random.Random(11)
    bits = [*SNIPPETS, "5 AUß 3 aué 4 auf", "7 mphé 9 kphß", "<ref a\rb/> 20x30", "12 AU\r", "{{lang|fr  30 AU}} 2 AU", "| image = 5 AU\r x", "{{not a typo|5 l}}", "<math>5 l</math>", "[[File:a 20x30.jpg|b]] 3,5 l", "https://x.y/20x30 z", "{{cvt|5|mi}} 30 mph", "poem rhyme ABAB, aabb c", "Category:Some sport", "9l/day (l) 3 dal"]
    texts = [(i, " ".join(r.choice(bits)[r.randint(0, 9) * (i % 2) :] for _ in range(3)) + "\n" + r.choice(bits)) for i in range(400)]
    d = spark.createDataFrame([(i, t) for i, t in texts], "doc_id long, text string")
    got = rows(style.check_lines(d).drop("evidence"))
    assert got == oracle(style.check_lines_sql(), documents=pd.DataFrame(texts, columns=["doc_id", "text"]))
    # literals are sought before any pattern: a rule with its literals left out finds no more
    held, style.NEEDS, style.DIGITAL = (style.NEEDS, style.DIGITAL), {"R": style.NEEDS["R"]}, set()
    try:
        assert rows(style.check_lines(d).drop("evidence")) == got
    finally:
        style.NEEDS, style.DIGITAL = held


def test_nationality_passes_over_other_articles(spark):
    texts = [(1, "| birth_place = Lima, Peru\n| birth_date = 1850 |\n| nationality = Peruvian"), (2, "birth_place of nobody = 5"), (3, "| birthplace = Texas\n| citizenship = Germany")]
    found = style.nationality(spark.createDataFrame(texts, "doc_id long, text string"))
    assert {(r.doc_id, r.code) for r in found.collect()} == {(1, "INFONAT_REDUNDANT_pe_JUS_SOLI_1800s"), (3, "INFONAT_EXPLAIN_us_state")}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Contains(text" in plan and not [x for x in plan.splitlines() if "Filter" in x and "Afghan" in x]


def test_guarded_patterns_change_nothing(spark):
    r = random.Random(4)
    bits = [*SNIPPETS, "HTTP://x.y/z a", "ftp:q $ b", "''''' don't Aa'''''", "''Italic x''", " 'Quoted' ", "it's", "a.com b.edu/c x.org", "| image = a.gif|", "\nImage:x.jpg\n", "ipa symbol2 = a\n", "poj = b\n", "| colspan=2 x\n", "C° °K ` ﬁ ㎞", "&frasl;", "the the and and of of"]
    texts = ["".join(r.choice(bits)[r.randint(0, 6) * (i % 2) :] for _ in range(4)) for i in range(400)] + ["", "plain"]

    def every():
        return [(wikitext.to_prose(t), wikitext.body(t), typos.clean(t, True), entities.redact(t), entities.findings("x", t)) for t in texts]

    got, held, none = every(), dict(wikitext.GUARDS), entities._no_literal
    assert held and any(entities._no_literal(t) for t in texts) and not all(entities._no_literal(t) for t in texts)
    assert all((next(entities._automaton().iter(t), None) is None) == entities._no_literal(t) for t in texts)
    try:
        wikitext.GUARDS.clear()
        entities._no_literal = lambda _: False
        assert every() == got
    finally:
        wikitext.GUARDS.update(held)
        entities._no_literal = none


def test_anchors_hold_spaces(spark):
    assert [typos.anchor(p) for p in (r"\b[Tt]he the\b", r"\bis is\b", r"\bto to?\b", " ,")] == ["he the", "is is", "to t", ""]


def test_python_is_run_once(spark):
    a = spark.createDataFrame([("1", "&alpha; ½ cup … x"), ("2", "The dog saw a cat. &hellip;")], "title string, text string")
    f = entity_check.entity_findings(a)
    lexicon = spark.createDataFrame([("dog", "N"), ("cat", "N"), ("saw", "V")], "word string, pos string")
    for df in (entity_check.entity_report(f), entity_check.fix_list(f), grammar.grammar_findings(a, lexicon)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "run(" not in plan and "cut(" not in plan  # kept, not made again for each use
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("mb")) <= 4 << 20  # a worker's batches don't grow with the input
