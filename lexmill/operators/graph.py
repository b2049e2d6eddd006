"""Page-link graph: edges, degrees, reachability, the loop around a page, dead ends, chains.

Every round is a join of the frontier with the edges, written to the checkpoint folder to cut the plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.operators.steps import kept


def page_links(pages: DataFrame) -> DataFrame:
    """(src, dst): distinct links of a page's title (its url's path) to others; loops to itself are left out."""
    path = lambda c: F.regexp_extract(c, "^(?:[a-z]+://[^/]+)?/([^?#]*)", 1)
    e = pages.select(path(F.col("url")).alias("src"), F.explode(F.regexp_extract_all("html", F.lit('<a href="([^"]+)"'), 1)).alias("to"))
    return e.select("src", path(F.col("to")).alias("dst")).where("src != dst").distinct()


def line_links(docs: DataFrame) -> DataFrame:
    """(src, dst): the first and the last word of each line, in lower case, as a link between words; for texts whose pages don't link to each other."""
    line = docs.select(F.explode(F.split("text", "\n")).alias("line"))
    word = lambda p: F.lower(F.regexp_extract("line", p, 1))
    # the last word is sought from the end; a generator, so that the filter reads what was extracted
    e = line.select(F.inline(F.array(F.struct(word("^[^\\p{L}]*(\\p{L}+)").alias("src"), word("(?s)^(?:.*\\P{L})?(\\p{L}+)\\P{L}*$").alias("dst")))))
    return e.where("src != dst and src != '' and dst != ''").distinct()


def degrees(edges: DataFrame, least: int = 1) -> DataFrame:
    return edges.groupBy("src").agg(F.count("*").alias("out")).where(F.col("out") >= least)


def reachable(edges: DataFrame, seeds: DataFrame, backward: bool = False, every: int = 8) -> DataFrame:
    """(node, distance): all that can be reached from (or can reach) the seeds (node); a seed has distance 0.

    Each round writes its frontier alone; what was seen is the union of the frontiers, which are merged into one table after ``every`` rounds.
    """
    return _reachable(_by_source(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")) if backward else edges), seeds, every)


def _by_source(edges: DataFrame) -> DataFrame:
    """Edges that are kept by their source, so that no round shuffles them."""
    return kept(edges.select("src", "dst").repartition(int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions")), "src"))


def _reachable(e: DataFrame, seeds: DataFrame, every: int = 8, broadcast_limit: int = 200_000) -> DataFrame:
    seen = front = kept(seeds.select("node").distinct().withColumn("distance", F.lit(0)))
    rounds = 0
    while n := front.count():
        near = F.broadcast(front) if n <= broadcast_limit else front
        ahead = e.join(near, near["node"] == e["src"]).select(F.col("dst").alias("node"), (F.col("distance") + 1).alias("distance")).distinct()
        front = kept(ahead.join(seen.select("node"), "node", "left_anti"))
        seen = seen.unionByName(front)
        rounds += 1
        if rounds % every == 0:
            seen = kept(seen)
    return seen


def loop_of(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """(node): nodes that the seeds reach and that reach them."""
    e = _by_source(edges)
    back = _by_source(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return _reachable(e, seeds).select("node").intersect(_reachable(back, seeds).select("node"))


def dead_ends(edges: DataFrame) -> DataFrame:
    """(node): targets without links of their own."""
    ends = F.array(F.struct(F.col("dst").alias("node"), F.lit(False).alias("source")), F.struct(F.col("src").alias("node"), F.lit(True).alias("source")))
    each = edges.select(F.inline(ends))
    return each.groupBy("node").agg(F.max(F.col("source") & F.col("node").isNotNull()).alias("source")).where("not source").select("node")


def redirects_into(links: DataFrame, loop: DataFrame) -> DataFrame:
    """(node): redirects (pl_from with from_redirect) that lead to a node of the loop."""
    return links.where("from_redirect").join(loop.select(F.col("node").alias("pl_to")), "pl_to", "left_semi").select(F.col("pl_from").alias("node")).distinct()


def chains(edges: DataFrame, loop: DataFrame, rounds: int = 100) -> DataFrame:
    """(chain): paths that lead into the loop from outside, lengthened at their heads till none has a link from further outside.

    ``loop``: (node, label). Nodes of a loop are one node, by label; no chain passes a node twice.
    """
    label = lambda e, c: e.join(loop.select(F.col("node").alias(c), F.col("label").alias("__l")), c, "left").withColumn(c, F.coalesce("__l", c)).drop("__l")
    e = kept(label(label(edges, "src"), "dst").where("src != dst").distinct())
    grow = kept(e.join(loop.select(F.col("label").alias("dst")).distinct(), "dst", "left_semi").select(F.array("src", "dst").alias("chain")))
    done = grow.limit(0)
    for _ in range(rounds):
        if grow.isEmpty():
            break
        longer = grow.join(e, F.get("chain", F.lit(0)) == e["dst"], "left")
        ahead = F.col("src").isNotNull() & ~F.array_contains("chain", F.col("src"))
        longer = kept(longer.withColumn("ahead", F.coalesce(ahead, F.lit(False))))
        ends = longer.groupBy("chain").agg(F.max("ahead").alias("any")).where("not any").select("chain")
        done = kept(done.unionByName(ends))
        grow = kept(longer.where("ahead").select(F.concat(F.array("src"), "chain").alias("chain")))
    return done.unionByName(grow).distinct()
