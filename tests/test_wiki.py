"""Wiki operators by example: rewriting, spelling decision, categories, entities, style, titles, typos, languages, grammar, reports."""

import re

import pytest
from pyspark.sql import functions as F

from lexmill.functions import classify, entities, wikitext
from lexmill.operators import articles, decision, entity_check, grammar, language, reports, style, typos


@pytest.mark.parametrize("text, want", [
    ("aa\nbb", "aa bb"), ("p Q\n\n==Part==\n\nr S", "p Q\n==Part==\nr S"), ("==Part==\n[[File:pic]]\ntext", "==Part==\ntext"), ("[[Sea]]s", "Seas"), ("[[Sea level|height]]", "height"), ("[[Category:Seas]]", ""), ("x {{a {{b}} c}} y", "x ✂✂✂ y"),
    ("1914{{ndash}}1918 and a{{spaced en dash}}b{{em dash}}c", "1914-1918 and a - b-c"), ("x{{·}}y", "x · y"), ("{{ISBN|978-1}}", "978-1"), ("{{em|so}} {{Schwa}}", "so ə"), ("a<ref name=x>cited</ref> b<br />c", "a b c"), ("H<sub>2</sub>O &alpha; &rho;", "H2O &alpha; ρ"),
    ("<div class=a>in</div> [http://a.b c] out", "in out"), ("one {| class=a\n|-\n| b\n|} two", "one ✂"),
])
def test_prose(text, want):
    got = wikitext.to_prose(text)
    assert got == want if "{|" not in text else got.startswith("one ")


def test_nested_removal():
    cut = lambda s: wikitext.remove_nested(s, "{{", "}}")
    assert [cut(x) for x in ("p {{q", "p {{q {{r}} s", "p {{q {{r s", "q {{r}} s}} t", "{{u v}} w")] == ["p q", "p ✂✂ s", "p ", "q ✂ s}} t", "✂ w"]


def test_body():
    assert wikitext.body('He said "go now" and \'\'left\'\' home\n== References ==\nx') == "He said ✂ and ✂ home\n"
    assert wikitext.body("top\n: indented\n# item\nlast (aside) words", nonprose=False) == "top\nlast  words"
    assert wikitext.language_sections("x\n==English==\na\n==French==\nb\n==English==\nc") == {"": "x\n", "English": "==English==\nc\n", "French": "==French==\nb\n"}
    assert wikitext.linked_words("{{trans-see|big dog|hound}}") == ["big dog", "hound"]
    assert wikitext.ascii_candidates("Øst–Åø")[0] == "Ost-Ao" and "Oest-Aaoe" in wikitext.ascii_candidates("Øst–Åø") and wikitext.to_latin("Жук é", {0x416: "Zh", 0x443: "u", 0x43A: "k"}) == "Zhuk é"


def test_numeric_entities():
    stay = ["&#xE000;", "&#xFDD0;", "&#0;", "&#x110000;", "&#x301;", "&#xFE0F;", "&#x2126;", "&#xFA1E;", "&#xFFFF;"]
    assert all(map(wikitext.must_stay, stay)) and not any(map(wikitext.must_stay, ["&#65;", "&#x3B1;", "&amp;"]))


def test_entity_findings():
    found = entities.findings("A page", "&Omega; &alpha; &dashv; &frasl; &#8217; &hellip; R&B; &foo; &nbsp; &#91; ㍘㍘ ㎞ ‘x’ `")
    assert sorted(found) == sorted([("GREEK", "&Omega;"), ("GREEK", "&alpha;"), ("CONTROVERSIAL", "&dashv;"), ("ALERT", "&frasl;"), ("NUMERIC", "&#8217;"), ("UNCONTROVERSIAL", "&hellip;"), ("UNKNOWN", "&foo;"), ("LOW_PRIORITY", "&#91;"), ("ALERT", "㍘"), ("ALERT", "㍘"), ("UNCONTROVERSIAL", "㎞"), ("LOW_PRIORITY", "‘"), ("LOW_PRIORITY", "’"), ("LOW_PRIORITY", "`")])
    assert entities.findings("A page", "<math>x</math> &alpha; &dashv; {{lang|el|&beta;}} https://a.b/&gamma;") == []
    assert entities.findings("Unicode equivalence", "&alpha;") == [] and entities.findings("x", "{{MOS}} &alpha;") == [] and entities.findings("x", None) == []
    assert entities.findings("x", "½ cup") == [] and entities.findings("x", "½ {{frac|1|3}}") == [("LOW_PRIORITY", "½")] and entities.findings("Ranma ½", "½ {{frac|1|3}}") == []
    assert entities.findings("x", "₤5 of lira") == [] and entities.findings("x", "ϑ and θ") == [("UNCONTROVERSIAL", "ϑ")] and entities.findings("x", "ϑ") == []
    assert entities.fix_text("&hellip; &alpha; &#945; &#xE000; &nbsp; ㎞ ‘a’ &lt;") == "... &alpha; α &#xE000; &nbsp; km 'a' &lt;" and entities.fix_text("&alpha;&Chi;", greek=True) == "αΧ"


def test_entity_report(spark):
    a = spark.createDataFrame([("b", "&hellip; &hellip; &alpha;"), ("a", "&hellip;"), ("c", None), ("d", "&foo;")], "title string, text string")
    f = entity_check.entity_findings(a)
    got = {(r.type, r.string): (r.instances, r.uniques, r.articles) for r in entity_check.entity_report(f, 1).collect()}
    assert got == {("UNCONTROVERSIAL", "&hellip;"): (3, 2, ["a"]), ("GREEK", "&alpha;"): (1, 1, ["b"]), ("UNKNOWN", "&foo;"): (1, 1, ["d"])}
    assert [tuple(r) for r in entity_check.fix_list(f).orderBy("place").collect()] == [(1, "b"), (2, "a")]
    assert entity_check.fix_rules(spark).count() == len(entity_check.FIRST_RULES) + len(entity_check.LAST_RULES)


def test_decision(spark):
    known = spark.createDataFrame([(w,) for w in "wet entirely jelly otherwise based arabic the ph.b. mr. camera cameras km".split()], "word string")
    cases = {
        "": 0, "the": 0, "The": 0, "you": 2, "don't": 2, "ﬁne": 2, "½": 2, ",": 0, "&amp;": 0, "<nowiki/>": 2, "<poem>": 0, "$5": 0, "1,234.5": 0, "12abc": 0, "g/cm3": 0, "the.": 0, "†wet": 0, "camera(s)": 0, "entirely-wet": 0, "jelly—otherwise": 0, "Arabic-based": 0,
        "Anbār-e": 2, "Ḩasan": 1, "Zork": 1, "zork": 2, "wet-zork": 2, "Zork-the": 1, "again.The": 2, "mr.X": 2, "x_y": 1, "ab1": 1, "ph.B": 0,
    }
    got = {r.token: r.verdict for r in decision.decide(spark.createDataFrame([(k,) for k in cases], "token string"), known).collect()}
    assert got == cases
    d = spark.createDataFrame([("t", "''So,'' it's (word) re-use; x;y: =a= “q” Pā’īn AT&T &amp; <br> end. U.S. state.")], "title string, text string")
    tokens = {r.token for r in decision.occurrences(d).collect()}
    assert {"So", "it's", "word", "re-use", "a", "Pā’īn", "&amp;", "<br>", "end.", "U.S.", "state."} <= tokens


def test_spell_check(spark):
    known = spark.createDataFrame([(w,) for w in "a the word is here salt and water of gun".split()], "word string")
    rows = [
        ("one", "The word,here is zork and Zork of H2O NaCl, teh."), ("two", "the gun of .350 caliber is Nf3"), ("three", "broken {{ here"), ("four", "gaol fever jail fever"),
    ]
    a = spark.createDataFrame(rows, "title string, text string")
    got = {(r.title, r.code, r.token) for r in decision.article_findings(a, a, known).collect()}
    assert {("one", "@", "word,here"), ("one", "@", "zork"), ("one", "G", "Zork")} <= got and not any(t in ("two", "three") and c == "@" and x in (".350", "Nf3") for t, c, x in got) and not any(t == "three" for t, *_ in got) and ("four", "@", "gaol") not in got
    t = {r.word: (r.freq, r.articles) for r in decision.tally(decision.article_findings(a, a, known)).collect()}
    assert t["zork"] == (1, 1)
    f = {r.title: (r.code, r.item) for r in decision.parse_failures(a).collect()}
    assert f == {"three": ("!", "{{ }}")}
    d = decision.spaced_dashes(spark.createDataFrame([("x", "long before — after all"), ("y", "a—b")], "title string, text string")).collect()
    assert [(r.title, r.n) for r in d] == [("x", 1)] and "before — after" in d[0].around


def test_categories(spark):
    w, no = F.col("w"), F.lit(False)
    c = classify.whitespace_kind(w, classify.category(w, w.isin("you"), w.rlike(decision.bad_class()), w == "dogcat", w == "motif", w == "foreignish", F.when(w == "wrod", 1), F.when(w.isin("motif", "héros"), "fr").otherwise("en")))
    want = {
        "you": "BW", "ﬁx": "BC", ".5": "Z", "Nf3": "CH", "methylbenzene": "CN", "NaCl": "CF", "H2O": "CF", "dogcat": "ME", "f(x)": "A", "motif": "TF", "example.org": "U", "a,b": "TS+COMMA", "x(abc)y": "TS+BRACKET", "end.Start": "TS+DOT", "foreignish": "L", "abcabc": "P", "wrod": "T1", "gattacagatt": "D",
        "plainword": "TE", "héros": "TF", "<font>": "HB", "<zork>": "N", "<table>": "H", "<http>": "HL", "either/or": "T/", "x_y": "N",
    }
    got = {r.w: r.c for r in spark.createDataFrame([(k,) for k in want], "w string").select("w", c.alias("c")).collect()}
    assert {k: (got[k], v) for k, v in want.items() if got[k] != v} == {}
    assert no is not None
    flags = spark.createDataFrame([(x,) for x in ("BCN", "Ca(OH)", "MgCl2·6H2O", "Mn(II)", "ABC12", "aabb", "cdcd", "efef", "hello", "abab")], "w string").select("w", classify.is_chemical_formula(w).alias("f"), classify.is_rhyme_scheme(w).alias("r")).collect()
    assert {r.w for r in flags if r.f} == {"Ca(OH)", "MgCl2·6H2O", "Mn(II)"} and {r.w for r in flags if r.r} >= {"aabb", "cdcd", "efef", "abab"}


def test_nationality(spark):
    text = lambda born, line, year="1950": f"{{{{Infobox\n| birth_place = {born}\n| birth_date = {year}\n{line}\n"
    cases = [
        (text("Paris, France", "| nationality = French"), "INFONAT_REDUNDANT_fr_1900s"), (text("Lima, Peru", "| nationality = Peruvian", "1850"), "INFONAT_REDUNDANT_pe_JUS_SOLI_1800s"), (text("Lima, Peru", "| nationality ="), "INFONAT_BIRTHPLACE_ONLY"), (text("Lima, Peru", "| citizenship = {{flag|Chile}}"), "INFONAT_FLAG"),
        (text("Port Moresby, Papua New Guinea", "| nationality = Guinean"), "INFONAT_EXPLAIN_pg"), (text("Nowhere", "| nationality = Zorkian"), "INFONAT_CITNAT_NO_COUNTRY"), (text("Nowhere", "| nationality = German"), "INFONAT_BIRTHPLACE_NO_COUNTRY_de"), (text("Texas", "| nationality2 = x"), "INFONAT_REDUNDANT"), (text("Lima, Peru", "| nationality = Chile, Peru"), None),
        (text("France and Germany", "| nationality = Italy"), "INFONAT_BIRTHPLACE_MULTI_COUNTRY"),
    ]
    d = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id bigint, text string")
    got = {r.doc_id: r.code for r in style.nationality(d).collect()}
    assert got == {i: c for i, (_, c) in enumerate(cases) if c}


def test_titles(spark):
    a = spark.createDataFrame([("Plain", "x"), ("Café", "x"), ("Déjà vu", "x"), ("Tokyo 東", "x"), ("Nº 5", "x"), ("45° angle", "x"), ("30° line", "x"), ("ST", "see [[ΣΤ]]"), ("UF", "none"), ("Été", "{{disambig}}"), ("(−)-Menthol", "x"), ("Öre", "#REDIRECT [[x]]")], "title string, text string")
    r = spark.createDataFrame([("Cafe", "Café"), ("30 degree line", "30° line")], "from_title string, to_title string")
    got = {(x.title, x.code, x.detail) for x in style.title_codes(a, r, wikitext.candidates_column).collect()}
    assert got == {("Déjà vu", "MR", "Deja vu"), ("Tokyo 東", "TC", '"東" in article title'), ("Nº 5", "TC", "Incorrect use of ordinal indicator º"), ("45° angle", "MR", "45 degrees angle"), ("UF", "MD", "μF")}


def test_typo_scan(spark):
    assert [typos.anchor(p) for p in (r"\b([Rr])eciev(e|ed)\b", "foo|bar", "(?i)word", "ab?cde", "[abc]def", "x{2}yes")] == ["eciev", "", "", "cde", "def", "yes"]
    rules = [(f"r{i}", rf"\bzz{i:04d}q\b".replace("0", "o").replace("1", "l").replace("2", "t").replace("3", "e").replace("4", "f").replace("5", "s").replace("6", "g").replace("7", "v").replace("8", "b").replace("9", "n"), "ok") for i in range(1200)]
    rules += [("Receive", r"\b([Rr])eciev(e|ed|ing)\b", "$1eceiv$2"), ("Same", "same", "same")]
    text = "They recieved it at https://recieve.org {{not a typo|recieve}} and the same day"
    d = spark.createDataFrame([("t", text), ("u", None), ("v", "zzoooqq zzooolq")], "title string, text string")
    got = {(r.title, r.rule, r.before, r.after, r.frequency) for r in typos.scan(d, rules, frequency={"Receive": 7}).collect()}
    assert ("t", "Receive", "They recieved it at ✂ ✂", "They received it at ✂ ✂", 7) in got and all(r[1] != "Same" for r in got) and any(r[0] == "v" for r in got)
    assert [r[0] for r in typos.ordered([("a", "xx", ""), ("b", "x", "")], {"a": 200}, "high")] == ["a"] and [r[0] for r in typos.ordered([("a", "xx", ""), ("b", "x", "")])] == ["b", "a"]
    c = typos.compliance_changes(spark.createDataFrame([("p", "№5 cosθ <b>"), ("q", "Numero sign №5")], "title string, text string")).collect()
    assert {(r.title, r.before, r.after) for r in c} == {("p", "№", "Number"), ("p", "cosθ", "cos θ"), ("p", "<b>", "{{angbr|b}}")}


def test_languages(spark):
    v = spark.createDataFrame([("en", w) for w in "the that this with from have which would their there thing other".split()] + [("de", w) for w in "nicht sich auch durch zwischen schon noch buch sprache deutsch".split()], "lang string, word string")
    got = {r.word: r.lang for r in language.word_languages(spark.createDataFrame([("schicht",), ("thither",)], "word string"), language.pair_costs(v)).collect()}
    assert got == {"schicht": "de", "thither": "en"}
    names = spark.createDataFrame([("iw",), ("ru-Latn",), ("fil",), ("xx",)], "c string").select(language.language_name(F.col("c"))).collect()
    assert [r[0] for r in names] == ["Hebrew", "Russian (Latin script)", "Filipino", "xx"]
    home = spark.createDataFrame([(w,) for w in "this that with from".split()], "word string")
    foreign = " ".join(["schicht sprache"] * 12)
    docs = spark.createDataFrame([(1, "this that with from " * 6 + "\n" + foreign + " XIV Name 123"), (2, "this that")], "doc_id bigint, text string")
    langs = spark.createDataFrame([("schicht", "de"), ("sprache", "de")], "word string, lang string")
    f = language.foreign_words(docs, home, langs, langs.select("word"))
    assert [(r.doc_id, r.lang, r.n, len(r.samples)) for r in f.collect()] == [(1, "de", 24, 10)]
    assert [(r.doc_id, r.foreign, r.lang) for r in language.worst(language.foreign_report(f, docs)).collect()] == [(1, 24, "de")]
    assert language.language_table(langs, langs.withColumn("margin", F.lit(5))).count() == 2


def test_grammar(spark):
    lex = {"dog": {"N"}, "dogs": {"N"}, "saw": {"V"}, "cat": {"N"}, "old": {"ADJ"}, "walks": {"V"}, "blue": {"ADJ"}}
    judge = lambda s: grammar.derives(grammar.parts_of_speech(grammar.tokens(s), lex))
    assert judge("The dog saw a cat.") and judge("The old dog walks to London.") and judge("Dogs saw 15 blue cat dogs.") and judge("In London, the dog saw it.")
    assert not judge("Dog the saw.") and not judge("The of a.") and grammar.parts_of_speech(["zork", "saw"], lex) == "zork"
    assert grammar.tokens("R. E. Lee paid $5M, i.e. all.") == ["R.", "E.", "Lee", "paid", "$5M", ",", "i.e.", "all", "."] and grammar.sentences("Mr. X came. He left! Yes") == ["Mr. X came.", "He left!", "Yes"]
    a = spark.createDataFrame([("x", "The dog saw a cat.\nDog the saw.\nThe zork saw it. He said \"no\" here."), ("m", "<math>x</math>"), ("n", None)], "title string, text string")
    lexicon = spark.createDataFrame([(w, p) for w, ps in lex.items() for p in ps], "word string, pos string")
    got = sorted((r.title, r.code, r.word) for r in grammar.grammar_findings(a, lexicon).collect() if r.code != "U")
    assert ("x", "Y", None) in got and ("x", "G", None) in got and ("x", "S", "zork") in got
    cats = spark.createDataFrame([("dog", "English nouns"), ("dog", "English verbs"), ("chien", "French nouns")], "title string, category_name string")
    assert {tuple(r) for r in grammar.lexicon_of(cats).collect()} == {("dog", "N"), ("dog", "V")} and grammar.english_titles(cats).count() == 1


def test_skips(spark):
    a = spark.createDataFrame([("List of x", "y"), ("1999", "y"), ("Fine", "y"), ("Fixme", "{{cleanup}}"), ("Ad", "{{advert}}"), ("Gold (data page)", "y")], "title string, text string")
    assert {r.title for r in articles.readable(a).collect()} == {"Fine", "Gold (data page)"} and {r.title for r in articles.without_cleanup(a).collect()} == {"List of x", "1999", "Fine", "Ad", "Gold (data page)"}
    skip = spark.createDataFrame([("Fine",)], "title string")
    assert {tuple(r) for r in articles.skipped(a, skip).collect()} == {("Fine", "title"), ("Fixme", "template"), ("Gold (data page)", "data page")} and articles.without_titles(a, skip).count() == 5
    pages = spark.createDataFrame([('<a title="en:Zork"> <a title="w:Mork">', ), ('"https://en.wiktionary.org/wiki/grue"',)], "value string")
    assert {r.title for r in articles.requested_titles(pages).collect()} == {"Zork", "Mork"} and [r.title for r in articles.queued_titles(pages).collect()] == ["grue"]
    assert {r.word for r in articles.dictionary_words(spark.createDataFrame([("Ice_Age's",), ("a:b",)], "title string")).collect()} == {"ice", "age's", "age", "s", "a:b", "a", "b"}


def test_reports(spark):
    names = dict(reports.merged_names([("a", 3), ("b", 4), ("ca", 40), ("cb", 5), ("d", 60), ("ea", 2), ("fa", 3)]))
    assert names == {"a": "a-b", "b": "a-b", "ca": "ca-cb", "cb": "ca-cb", "d": "d", "ea": "ea", "fa": "fa"}
    lines = spark.createDataFrame([(3, "<b>", ["x", "y"]), (2, "&zork;", ["x"]), (7, "a b", list("abcdefg"))], "n int, w string, a array<string>").select(reports.summary_line(F.col("n"), F.col("w"), F.col("a"), True).alias("l")).collect()
    assert lines[0].l.startswith("* 3 - <nowiki><b></nowiki> - [[x]], [[y]] ... [") and lines[1].l.startswith("* 2 - &amp;zork; (&zork;) - [[x]]") and "search=%22a+b%22" in lines[2].l and "[[f]]" not in lines[2].l
    w = [r[0] for r in spark.createDataFrame([("* 3 - [[wikt:dog]] - [[x]]",), ("no link",)], "l string").select(reports.line_word(F.col("l"))).collect()]
    assert w == ["dog", "no link"]
    t = spark.createDataFrame([("A", 0, "wrod", "T1"), ("A", 1, "ok", "U"), ("B", 0, "x", "L"), ("C", 0, "zz", "ME")], "title string, pos int, word string, type string")
    assert {(r.title, r.best, tuple(r.words)) for r in reports.main_listing(t, spark.createDataFrame([("C",)], "title string")).collect()} == {("A", "T1", ("wrod",))}
    c = reports.article_categories(t, spark.createDataFrame([("wrod", "T1"), ("ok", "U")], "word string, category string"))
    assert {tuple(r) for r in c.collect()} == {("A", "T1,U"), ("B", ""), ("C", "")}
    words = spark.createDataFrame([("apple", 9, 2), ("zoo", 9, 2), ("éa", 9, 1), ("a.b", 3, 3)], "word string, freq int, docs int")
    assert {r.word for r in reports.frequent(reports.active_half(words, dots=False)).collect()} == {"apple"} and [r.word for r in reports.by_length(words).collect()][0] == "éa"
    s = reports.chain_stats(spark.createDataFrame([(["a", "b"],), (["a", "b"],), (["c", "d", "e"],)], "chain array<string>")).first()
    assert (s.chains, s.heads, s.longest) == (2, 2, 3) and re.match("2.5", str(s.mean_length))


def test_edit_keys(spark):
    w = spark.createDataFrame([("xyz",)], "w string")
    one, two = w.select(classify.lowfi_edits(F.col("w")), classify.lowfi_edits(F.col("w"), 2)).first()
    assert set(one) == {"*xyz", "*xy", "*yz", "*xz", "xy", "yz", "xz"} and {"x", "y", "z", "*x", "*y", "*z"} <= set(two) and not set(one) & set(two)
    got = set(w.select(classify.edits(F.col("w"))).first()[0])
    assert {"yz", "yxz", "xzy", "ayz", "xyza", "axyz"} <= got and len(got) == 3 + 2 + 3 * 25 + 1 + 4 * 26 - 3


def test_dictionary_pages(spark):
    known = spark.createDataFrame([(x,) for x in "a the word of".split()], "word string")
    a = spark.createDataFrame([("p", "==English==\na zork of the word {{trans-see|blip}}\n==French==\nthe word"), ("q", "{{cleanup}} zork"), ("r", "a — word {{ of")], "title string, text string")
    e = decision.dictionary_entries(a)
    assert {r.title for r in e.collect()} == {"p#English", "p#French", "q#", "r#"}
    tokens = {(r.title, r.token) for r in decision.occurrences(e, text="plain", more=F.col("more")).collect()}
    assert ("p#English", "blip") in tokens and ("p#English", "zork") in tokens and not any("French" in t and x == "zork" for t, x in tokens)
    report = decision.spell_report(a, a, known, articles.skipped(a, a.where("title = 'none'").select("title")))
    assert {(r.title, r.code) for r in report.collect()} >= {("q", "S"), ("r", "!"), ("r", "D"), ("p", "!")} - {("p", "!")}
