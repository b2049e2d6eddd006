from datetime import datetime

from pyspark.sql import functions as F

from lexmill.sources import sinks, wiki
from lexmill.streaming import findings

DUMP = """<mediawiki><page><title>A &amp; b</title><ns>0</ns><revision><text bytes="3">x y</text></revision></page>
<page><title>R</title><ns>0</ns><redirect title="A &amp; b"/><revision><text>#R</text></revision></page>
<page><title>Talk:A</title><ns>1</ns><revision><text>t</text></revision></page></mediawiki>"""


def test_dump(spark, tmp_path):
    (tmp_path / "d.xml").write_text(DUMP)
    articles, redirects = wiki.read_dump(spark, str(tmp_path / "d.xml"))
    assert [tuple(r) for r in articles.collect()] == [("A & b", "x y")]
    assert [tuple(r) for r in redirects.collect()] == [("R", "A & b")]
    wiki.write_articles(articles, str(tmp_path / "a"))
    assert wiki.read_articles(spark, str(tmp_path / "a"), "A").count() == 1
    assert wiki.read_articles(spark, str(tmp_path / "a"), "B").count() == 0
    sinks.write_pages_xml(articles, str(tmp_path / "x"))
    assert wiki.read_dump(spark, str(tmp_path / "x"))[0].collect() == articles.collect()


def test_files(spark, tmp_path):
    (tmp_path / "r").write_text("one\tline 1\nline 2\rtwo\tx\r", newline="")
    assert [tuple(r) for r in wiki.read_records(spark, str(tmp_path / "r")).collect()] == [("one", "line 1\nline 2"), ("two", "x")]
    (tmp_path / "p").write_text("a\tb\n")
    assert wiki.read_pairs(spark, str(tmp_path / "p")).first()["to_title"] == "b"
    (tmp_path / "rules").write_text('&lt;Typo word="X" find="\\bteh\\b" replace="the" /&gt;\n<Typo disabled word="Y" find="z" replace="q" />\n')
    assert [tuple(r) for r in wiki.read_rules(spark, str(tmp_path / "rules")).collect()] == [("X", "\\bteh\\b", "the")]
    html = spark.createDataFrame([('<a href="/wiki/New_York%C3%A9"> <a href="/wiki/Talk:x"> <a href="/wiki/A#b">',)], "value string")
    assert [r.title for r in wiki.published_titles(html).collect()] == ["New Yorké"]
    words = wiki.title_words(spark.createDataFrame([("Mother-in-law_X",)], "title string"))
    assert {r.word for r in words.collect()} == {"mother-in-law", "x", "mother", "in", "law"}


def test_tables(spark):
    page = spark.createDataFrame([(1, 0, "A_b", False), (2, 1, "T", False)], "page_id long, page_namespace int, page_title string, page_is_redirect boolean")
    links = spark.createDataFrame([(1, 0, "C", 0), (2, 0, "A", 1)], "pl_from long, pl_namespace int, pl_title string, pl_from_namespace int")
    assert [tuple(r) for r in wiki.named_links(page, links).collect()] == [("A_b", "C", False)]
    cat = spark.createDataFrame([(1, 7), (1, 7)], "cl_from long, cl_target_id long")
    target = spark.createDataFrame([(7, "Big_things")], "lt_id long, lt_title string")
    assert [tuple(r) for r in wiki.page_categories(page, cat, target).collect()] == [("A b", "Big things")]


def test_sinks(spark, tmp_path):
    f = spark.createDataFrame([("D", "a"), ("T", "b")], "code string, word string")
    sinks.write_findings(f, str(tmp_path / "f"))
    assert spark.read.parquet(str(tmp_path / "f")).where("code = 'D'").count() == 1
    line = spark.range(1).select(sinks.frequency_line(F.lit(2), F.lit("teh"), F.array(F.lit("A"), F.lit("B"))).alias("x")).first().x
    assert line == "* 2 - [[wikt:teh]] - [[A]], [[B]]"
    rules = spark.createDataFrame([(1, "<b", "x"), (2, "a", "b")], "rank int, pattern string, replacement string")
    out = sinks.rule_export(spark.createDataFrame([(2, "Z"), (1, "Y")], "rank int, title string"), rules).first().value
    assert out == '{"articleList":["Y","Z"],"replaces":[{"replaceText":"a","replaceWith":"b"},{"replaceText":"<b","replaceWith":"x"}]}'


def test_stream(spark, tmp_path):
    t = datetime(2024, 1, 1, 10)
    spark.createDataFrame([(1, "5 x 3\na man-made", t), (2, "so man-made", t)], "doc_id bigint, text string, ts timestamp").write.parquet(str(tmp_path / "in"))
    q = findings.change_findings(findings.read_changes(spark, str(tmp_path / "in"))).writeStream.outputMode("complete").format("memory").queryName("found").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert {(r.code, r.n) for r in spark.table("found").collect()} == {("XS", 1), ("MAN_MADE", 2)}


def test_compressed_dump(spark, tmp_path):
    import bz2

    page = "<page><title>{}</title><ns>0</ns><revision><text>{}</text></revision></page>"
    (tmp_path / "d.xml.bz2").write_bytes(bz2.compress(("<mediawiki>" + page.format("A", "one") + page.format("B", "two") + "</mediawiki>").encode()))
    got, _ = wiki.read_dump(spark, str(tmp_path / "d.xml.bz2"))
    assert {tuple(r) for r in got.collect()} == {("A", "one"), ("B", "two")}
    sinks.write_letters(got, str(tmp_path / "letters"))
    assert {r.letter for r in spark.read.parquet(str(tmp_path / "letters")).collect()} == {"A", "B"}


def test_report_page(spark):
    d = spark.createDataFrame([("P", "b", "* 2"), ("P", "a", "* 3"), ("P", "a", "* 1")], "title string, section string, line string")
    assert sinks.page(d).first().value == "==== a ====\n* 1\n* 3\n==== b ====\n* 2"
    row = spark.createDataFrame([(1, None)], "a int, b string").select(sinks.table_row(F.col("a"), F.col("b"))).first()[0]
    assert row == "|-\n| 1 || " and sinks.table_start("x", "y").endswith("! x !! y")
