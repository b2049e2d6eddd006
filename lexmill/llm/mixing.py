"""Mixing sources to target weights: a token budget goes down a domain-language-source tree.

Each node's allotment is shared among its children by their weights, none above what its subtree can supply
(its tokens times ``max_epochs``; children of weight 0 supply nothing). What a child can't supply goes to its siblings first; only a subtree that
is exhausted as a whole leaves its shortage to its parent's siblings. A leaf then takes the token-prefix of its
documents in a seeded order, of as many epochs as its allotment needs, each epoch in an order of its own.

Shares are found level by level with windows over the children of a node, so sources can be as many as hosts of a crawl. The order is that
of md5(seed, epoch, doc_id). A leaf's cut is found in two steps, so that no task sorts a
whole leaf: token sums of 4096 ranges of the hash per leaf, then the rows of the one range where the cut lies.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.llm._common import checkpoint

LEVELS = ("domain", "lang", "source")
#: Target weights of the registered query and the pipeline, by path; every other node weighs 1 among its siblings.
TARGETS: dict[tuple, int] = {("web",): 2, ("books",): 3, ("web", "en"): 3, ("web", "de"): 2, ("books", "en"): 2, ("books", "fr"): 2, ("web", "en", "src0"): 4, ("books", "en", "src1"): 2, ("books", "de", "src3"): 3}


def default_domain() -> Column:
    """Domain of a source where no column names one: 'web' for even source numbers, 'books' for odd ones, 'other' without a number."""
    number = F.regexp_extract(F.coalesce("source", F.lit("")), "([0-9])$", 1)
    return F.when(number == "", "other").when(number.cast("int") % 2 == 0, "web").otherwise("books")


def water_fill(budget: int, weights: list[int], caps: list[int]) -> list[int]:
    """Shares of ``budget`` by weight, none above its cap, what the capped can't take going to the rest by weight (rounded down).

    Children that get no more than their cap are found from the least cap per weight on; all in integers.
    """
    out = [0] * len(caps)
    left, weight = min(budget, sum(c for c, w in zip(caps, weights) if w > 0)), sum(weights)
    order = sorted((i for i in range(len(caps)) if weights[i] > 0), key=lambda i: (caps[i] / weights[i], i))
    for k, i in enumerate(order):
        if caps[i] * weight <= left * weights[i]:
            out[i] = caps[i]
            left -= caps[i]
            weight -= weights[i]
        else:
            for r in order[k:]:
                out[r] = left * weights[r] // weight
            break
    return out


def allot(leaves: Mapping[tuple, int], budget: int, weights: Mapping[tuple, int], max_epochs: int) -> dict[tuple, int]:
    """Tokens for each leaf path, by the definition. ``weights``: path prefix -> integer weight; 1 where it isn't given."""
    caps: dict[tuple, int] = defaultdict(int)
    children: dict[tuple, set] = defaultdict(set)
    for path, tokens in leaves.items():
        for k in range(len(path) + 1):
            # a node's own weight counts among its siblings, not for what it could supply
            caps[path[:k]] += tokens * max_epochs if all(weights.get(path[:m], 1) > 0 for m in range(k + 1, len(path) + 1)) else 0
            if k:
                children[path[: k - 1]].add(path[:k])
    got = {(): min(budget, caps[()])} if leaves else {}
    todo = list(got)
    while todo:
        node = todo.pop()
        kids = sorted(children[node], key=lambda p: tuple((x is not None, x or "") for x in p))
        for kid, share in zip(kids, water_fill(got[node], [weights.get(k, 1) for k in kids], [caps[k] for k in kids])):
            got[kid] = share
            todo.append(kid)
    return {p: got[p] for p in leaves}


def _weight(weights: Mapping[tuple, int], level: int) -> Column:
    """Weight of a node of ``level`` by its path; a case of the given table, whose size is that of the parameter."""
    out = F.lit(1)
    for path, w in weights.items():
        if len(path) == level + 1:
            hit = F.lit(True)
            for c, x in zip(LEVELS, path):
                hit &= F.col(c).eqNullSafe(F.lit(x))
            out = F.when(hit, F.lit(w)).otherwise(out)
    return out.cast("bigint")


def allotments(leaves: DataFrame, share: tuple[int, int], weights: Mapping[tuple, int], max_epochs: int) -> DataFrame:
    """(domain, lang, source, n, a) of (domain, lang, source, n): the tokens of ``allot`` for each leaf, with a budget of ``share`` of all tokens."""
    nodes = [leaves.withColumn("cap", (F.col("n") * max_epochs).cast("bigint")).withColumn("w", _weight(weights, 2))]
    for k in (1, 0):
        up = nodes[0].groupBy(*LEVELS[: k + 1]).agg(F.sum(F.when(F.col("w") > 0, F.col("cap")).otherwise(0)).alias("cap"))
        nodes.insert(0, up.withColumn("w", _weight(weights, k)))
    # one row: what all can supply, and all tokens
    cap = nodes[0].agg(F.sum(F.when(F.col("w") > 0, F.col("cap")).otherwise(0))).first()[0] or 0
    root = min((leaves.agg(F.sum("n")).first()[0] or 0) * share[0] // share[1], cap)
    above = None
    for k, level in enumerate(nodes):
        if k:
            keys = above.select(*[F.col(c).alias(f"up_{c}") for c in LEVELS[:k]], "up")
            on = F.lit(True)
            for c in LEVELS[:k]:
                on &= F.col(c).eqNullSafe(F.col(f"up_{c}"))
            d = level.join(keys, on).drop(*[f"up_{c}" for c in LEVELS[:k]])
        else:
            d = level.withColumn("up", F.lit(root).cast("bigint"))
        by = Window.partitionBy(*LEVELS[:k], F.col("w") > 0)
        before = by.orderBy(F.col("cap") / F.nullif(F.col("w"), F.lit(0)), F.col(LEVELS[k]).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
        ahead = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))  # noqa: B023, E731
        # weights of 0 are windows of their own
        d = d.withColumn("open", F.sum("w").over(by) - ahead("w")).withColumn("left", F.col("up") - ahead("cap"))
        d = d.withColumn("full", F.col("cap").cast("decimal(19,0)") * F.col("open") <= F.col("left").cast("decimal(19,0)") * F.col("w"))
        d = d.withColumn("high", F.max(F.when(~F.col("full"), F.col("left"))).over(by)).withColumn("rest", F.max(F.when(~F.col("full"), F.col("open"))).over(by))
        a = F.when(F.col("w") <= 0, F.lit(0)).when(F.col("full"), F.col("cap")).otherwise(F.expr("(cast(high as decimal(19,0)) * w) div rest"))
        above = d.withColumn("up", a.cast("bigint")).select(*LEVELS[: k + 1], "up", *(["n"] if k == 2 else []))
    return above.withColumnRenamed("up", "a")


def n_tokens(text: Column) -> Column:
    """Whitespace-separated words of a text; 0 of a null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t\\n\\r\\x0B\\f]+")), F.lit(0)).cast("bigint")


def mix(docs: DataFrame, share: tuple[int, int] = (1, 2), weights: Mapping[tuple, int] | None = None, max_epochs: int = 2, seed: int = 7, domain: Column | None = None, broadcast_limit: int = 200_000) -> DataFrame:
    """Columns of ``docs`` and domain, n_tokens, epoch: the rows that the leaves take.

    The budget is ``share`` (numerator, denominator) of all tokens. A leaf takes documents in seeded order while
    those before them have fewer tokens than its allotment, so it goes past it by less than one document; documents
    without tokens (null, empty, white space) are taken with the ones before them. Texts of any length count in whole. Null domains, languages and sources are nodes of their own; null ids order
    by their texts. Rows with equal ids (repeated rows, ties) follow each other by text, then arbitrarily, and the cut can fall between them. A
    weight of 0 takes nothing, and what it would have had goes to its siblings. Columns named domain, n_tokens or epoch are replaced, other extra columns pass
    through, whatever their names. An empty table gives an empty result. The leaves go along by broadcast up to ``broadcast_limit`` of them, beyond it by a shuffled join.
    """
    keep = [c for c in docs.columns if c not in ("domain", "n_tokens", "epoch")]
    text = docs["text"].cast("string")
    # the row is one column, so that no name of it can clash
    d = docs.withColumn("domain", default_domain() if domain is None else domain)
    d = d.select(F.struct(*keep).alias("row"), F.col("domain").cast("string").alias("domain"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), n_tokens(F.col("text")).alias("n_tokens"), F.coalesce(F.col("doc_id").cast("string"), F.md5(text), F.lit("0")).alias("id"))
    place = lambda e: F.md5(F.concat(F.lit(f"{seed}:"), e.cast("string"), F.lit(":"), F.col("id")))
    range_of = lambda p: F.conv(F.substring(p, 1, 3), 16, 10).cast("int")
    light = checkpoint(d.select(*LEVELS, "n_tokens", *[range_of(place(F.lit(e))).alias(f"r{e}") for e in range(max_epochs)]))
    leaves = allotments(light.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("n")), share, weights or {}, max_epochs)
    # the epoch in which each leaf's cut lies, and what of that epoch it takes
    plan = leaves.select(*[F.col(c).alias(f"leaf_{c}") for c in LEVELS], F.expr("case when n > 0 then int(a div n) else 0 end").alias("full"), F.expr("case when n > 0 then a % n else 0 end").alias("rest"))
    plan = checkpoint(plan)
    small = plan.count() <= broadcast_limit

    def with_leaf(rows: DataFrame, leaf: DataFrame) -> DataFrame:
        on = F.lit(True)
        for c in LEVELS:
            on &= F.col(c).eqNullSafe(F.col(f"leaf_{c}"))
        return rows.join(F.broadcast(leaf) if small else leaf, on)

    r = F.get(F.array(*[F.col(f"r{e}") for e in range(max_epochs)]), F.col("full"))
    sums = with_leaf(light, plan).where("rest > 0").groupBy(*[f"leaf_{c}" for c in LEVELS], r.alias("range")).agg(F.sum("n_tokens").alias("n"), F.first("rest").alias("rest"))
    upto = F.sum("n").over(Window.partitionBy(*[f"leaf_{c}" for c in LEVELS]).orderBy("range"))
    cut = sums.withColumn("upto", upto).where("upto >= rest and upto - n < rest").select(*[F.col(f"leaf_{c}").alias(c) for c in LEVELS], F.col("range").alias("cut"), (F.col("rest") - F.col("upto") + F.col("n")).alias("within"))
    on = F.lit(True)
    for c in LEVELS:
        on &= F.col(c).eqNullSafe(F.col(f"leaf_{c}"))
    plan = plan.join(cut, on, "left").select(*[f"leaf_{c}" for c in LEVELS], "full", F.coalesce("cut", F.lit(-1)).alias("cut"), F.coalesce("within", F.lit(0)).alias("within"))
    plan = checkpoint(plan)
    j = with_leaf(d, plan).withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1)))).where("epoch <= full")
    j = j.withColumn("place", place(F.col("epoch")))
    at = range_of(F.col("place"))
    out = [F.col("row")[c].alias(c) for c in keep] + [F.col(c) for c in ("domain", "n_tokens", "epoch")]
    whole = j.where((F.col("epoch") < F.col("full")) | (at < F.col("cut"))).select(out)
    w = Window.partitionBy(*LEVELS).orderBy("place", F.col("row")["text"]).rowsBetween(Window.unboundedPreceding, -1)
    edge = j.where((F.col("epoch") == F.col("full")) & (at == F.col("cut"))).withColumn("before", F.coalesce(F.sum("n_tokens").over(w), F.lit(0))).where("before < within").select(out)
    return whole.unionByName(edge)


def mix_sql(share: tuple[int, int] = (1, 2), max_epochs: int = 2, seed: int = 7, source: str = "documents", weights: Mapping[tuple, int] | None = None) -> str:
    """(doc_id, domain, lang, source, n_tokens, epoch): the same water-filling level by level."""

    def weight(k: int) -> str:
        cases = [" AND ".join(f"{c} IS NOT DISTINCT FROM {'NULL' if x is None else repr(x)}" for c, x in zip(LEVELS, p)) + f" THEN {w}" for p, w in (weights or {}).items() if len(p) == k + 1]
        return "(CASE " + " ".join(f"WHEN {c}" for c in cases) + " ELSE 1 END)" if cases else "1"

    def level(parent: str, k: int) -> str:
        path, up = ", ".join(LEVELS[: k + 1]), ", ".join(LEVELS[:k])
        by = f"PARTITION BY {up}" if k else ""
        order = f"ORDER BY cap::DOUBLE / w::DOUBLE, {LEVELS[k]} NULLS FIRST"
        join = " AND ".join(f"p.{c} IS NOT DISTINCT FROM c.{c}" for c in LEVELS[:k]) or "true"
        return f"""
o{k} AS (SELECT c.*, p.a AS up_a FROM k{k} c JOIN {parent} p ON {join} WHERE w > 0),
w{k} AS (SELECT *, sum(w) OVER ({by}) - coalesce(sum(w) OVER ({by} {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS m, coalesce(sum(cap) OVER ({by} {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used FROM o{k}),
s{k} AS (SELECT *, cap * m <= (up_a - used) * w AS sat FROM w{k}),
f{k} AS (SELECT *, max(CASE WHEN NOT sat THEN m END) OVER ({by}) AS open, max(CASE WHEN NOT sat THEN up_a - used END) OVER ({by}) AS high FROM s{k}),
a{k} AS (SELECT {path}, CASE WHEN sat THEN cap ELSE high * w // open END::HUGEINT AS a FROM f{k}),"""

    return f"""
WITH d AS (SELECT *, regexp_extract(coalesce(source, ''), '([0-9])$', 1) AS num, coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\r\\x0B\\f]+')), 0)::BIGINT AS n_tokens FROM {source}),
t AS (SELECT doc_id, lang, source, text, n_tokens, CASE WHEN num = '' THEN 'other' WHEN num::INT % 2 = 0 THEN 'web' ELSE 'books' END AS domain FROM d),
leaf AS (SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS n, sum(n_tokens)::HUGEINT * {max_epochs} AS cap, {weight(2)}::HUGEINT AS w FROM t GROUP BY ALL),
k2 AS (SELECT domain, lang, source, cap, w FROM leaf),
k1 AS (SELECT domain, lang, coalesce(sum(cap) FILTER (WHERE w > 0), 0)::HUGEINT AS cap, {weight(1)}::HUGEINT AS w FROM k2 GROUP BY domain, lang),
k0 AS (SELECT domain, coalesce(sum(cap) FILTER (WHERE w > 0), 0)::HUGEINT AS cap, {weight(0)}::HUGEINT AS w FROM k1 GROUP BY domain),
root AS (SELECT least((SELECT sum(n) FROM leaf) * {share[0]} // {share[1]}, sum(cap) FILTER (WHERE w > 0))::HUGEINT AS a FROM k0),
{level("root", 0)}{level("a0", 1)}{level("a1", 2)}
l AS (SELECT leaf.*, a // nullif(n, 0) AS full_, a % nullif(n, 0) AS rest FROM leaf JOIN a2 ON {" AND ".join(f"leaf.{c} IS NOT DISTINCT FROM a2.{c}" for c in LEVELS)}),
e AS (SELECT t.*, l.full_, l.rest, x.epoch, md5('{seed}:' || x.epoch || ':' || coalesce(doc_id::VARCHAR, md5(text), '0')) AS place FROM t JOIN l ON {" AND ".join(f"t.{c} IS NOT DISTINCT FROM l.{c}" for c in LEVELS)}, (SELECT unnest(range({max_epochs})) AS epoch) x),
b AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source, epoch ORDER BY place, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM e)
SELECT doc_id, domain, lang, source, n_tokens, epoch::INT AS epoch FROM b WHERE epoch < full_ OR (epoch = full_ AND before < rest)
"""
