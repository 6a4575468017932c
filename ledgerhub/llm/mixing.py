"""Mixing sources to target weights, by hierarchical budgets and seeded epochs.

A token budget goes down the tree domain - language - source. Children share their parent's budget
by weight; a child that holds less than its share gives the rest to its siblings, and only what no
sibling can take counts as the parent's shortage one level up. A source may be used several
times: whole epochs first, then the prefix of one more epoch in an order that seed and epoch fix.

The prefix of a source is found without ordering it: token sums of ranges of the order's key
tell in which range the budget ends, and only that range is ordered. The result is one key per
source, up to which documents are taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ledgerhub.llm.common import WORD, with_new, written_once

LEVELS = ["domain", "lang", "source"]
RANGE_DIGITS = 4

#: Weight by path from the root; '*' stands for any name, more names go before fewer.
Weights = dict[tuple[str, ...], int]


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def weight_sql(weights: Weights, depth: int) -> str:
    """SQL for the weight of a node of that depth; nodes without an entry have weight 1."""
    entries = sorted((p for p in weights if len(p) == depth), key=lambda p: (p.count("*"), p))
    cases = [
        "WHEN " + (" AND ".join(f"{c} = {quoted(n)}" for c, n in zip(LEVELS, p) if n != "*") or "true")
        + f" THEN {int(weights[p])}" for p in entries]
    return f"CASE {' '.join(cases)} ELSE 1 END" if cases else "1"


def filled_up(children: DataFrame, budgets: DataFrame | None, total: int, path: list[str]) -> DataFrame:
    """``children`` (path, w, cap) with ``budget``: shares by weight, never above ``cap``.

    In the order of cap / w a child is full if its share of what is left holds its cap; those after
    the first that is not full share the rest by weight. Parts of a token are dropped.
    """
    parent = path[:-1]
    rows = children.where("w > 0 and cap > 0")
    rows = rows.join(budgets, parent) if parent else rows.withColumn("given", F.lit(total).cast("decimal(38,0)"))
    order = [F.col("cap").cast("double") / F.col("w").cast("double"), F.col(path[-1])]
    w = W.partitionBy(*parent).orderBy(*order)
    rows = rows.select(
        "*",
        F.coalesce(F.sum("cap").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("w").over(w.rowsBetween(0, W.unboundedFollowing)).alias("left_w"),
    )
    full = F.expr("cap * left_w <= w * (given - before)")
    rows = rows.select("*", F.min(full).over(w.rowsBetween(W.unboundedPreceding, 0)).alias("full"))
    every = W.partitionBy(*parent)
    rows = rows.select(
        "*",
        F.coalesce(F.sum(F.expr("if(full, cap, 0)")).over(every), F.lit(0)).alias("used"),
        F.sum(F.expr("if(full, 0, w)")).over(every).alias("open_w"),
    )
    share = F.expr("if(full, cap, (w * (given - used)) div open_w)")
    return rows.select(*path, share.cast("decimal(38,0)").alias("budget"))


def usable_sql(weights: Weights) -> str:
    """SQL condition: no node on a leaf's path has weight 0."""
    return " AND ".join(f"({weight_sql(weights, depth)}) > 0" for depth in range(1, len(LEVELS) + 1))


def budgets(leaves: DataFrame, weights: Weights, total: int, max_epochs: int) -> DataFrame:
    """Leaves (path, have) that get tokens, with ``budget``.

    What lies below a node of weight 0 can't be used, so it is no part of what its ancestors hold:
    their shortage goes to their siblings.
    """
    whole = "decimal(38,0)"
    leaves = leaves.where(usable_sql(weights))
    found: DataFrame | None = None
    for depth in range(1, len(LEVELS) + 1):
        path = LEVELS[:depth]
        children = leaves.groupBy(*path).agg((F.sum("have") * max_epochs).cast(whole).alias("cap")).withColumn(
            "w", F.expr(weight_sql(weights, depth)).cast("decimal(10,0)"))
        parents = found.withColumnRenamed("budget", "given") if found is not None else None
        found = filled_up(children, parents, total, path)
    return leaves.join(found, LEVELS).where("budget > 0")


def order_key(seed: int, epoch: Column, key: Column) -> Column:
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.md5(F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), text).cast("binary"))


def plan(sized: DataFrame, weights: Weights, budget_percent: int, max_epochs: int, seed: int, key: str) -> DataFrame:
    """Per leaf that gets tokens: have, budget, whole epochs, and the key up to which one more is taken.

    ``sized`` (key, path, n_tokens) is read three times and should be stored.
    """
    leaves = sized.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("have"))
    leaves = written_once(leaves, "mix-leaves")
    total = int(leaves.agg(F.sum("have")).first()[0] or 0) * budget_percent // 100
    shares = budgets(leaves, weights, total, max_epochs).select(
        *LEVELS, "have", F.col("budget").cast("long").alias("budget"),
        F.expr("cast(budget as bigint) div have").alias("epochs"),
        F.expr("cast(budget as bigint) % have").alias("rest"))
    shares = written_once(shares, "mix-shares")
    part = sized.join(shares.where("rest > 0"), LEVELS).select(
        *LEVELS, "n_tokens", "rest", order_key(seed, F.col("epochs"), F.col(key)).alias("k"))
    part = part.withColumn("range", F.left("k", F.lit(RANGE_DIGITS)))
    sums = part.groupBy(*LEVELS, "rest", "range").agg(F.sum("n_tokens").alias("n"))
    run = sums.select("*", F.sum("n").over(W.partitionBy(*LEVELS).orderBy("range").rowsBetween(
        W.unboundedPreceding, 0)).alias("until"))
    last = run.where("until > rest").groupBy(*LEVELS).agg(
        F.min_by(F.struct("range", (F.col("until") - F.col("n")).alias("before")), "range").alias("x"))
    last = written_once(last.select(*LEVELS, "x.range", "x.before"), "mix-ranges")
    inside = part.join(last, [*LEVELS, "range"]).groupBy(*LEVELS, "rest", "before", "k").agg(
        F.sum("n_tokens").alias("n"))
    reached = inside.select("*", (F.col("before") + F.sum("n").over(
        W.partitionBy(*LEVELS).orderBy("k").rowsBetween(W.unboundedPreceding, 0))).alias("until"))
    cuts = reached.where("until <= rest").groupBy(*LEVELS).agg(F.max("k").alias("cut"))
    ends = last.join(cuts, LEVELS, "left").select(*LEVELS, F.coalesce("cut", "range").alias("cut"))
    return written_once(shares.join(ends, LEVELS, "left"), "mix-plan")


def with_path(df: DataFrame, domain: Column) -> DataFrame:
    """``df`` with the names of its leaf; null names are ''."""
    named = with_new(df, domain_=domain)
    return named.select("*", *[
        F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
        for c, n in (("domain_", "domain__"), ("lang", "lang__"), ("source", "source__"))]).drop("domain_")


def mix(
    df: DataFrame, domain: Column, weights: Weights, budget_percent: int = 75, max_epochs: int = 2,
    seed: int = 17, key: str = "doc_id", tokens: Column | None = None,
) -> DataFrame:
    """``df`` with a row for each use of a document, and ``epoch`` from 0.

    The budget is ``budget_percent`` of all tokens (words, unless ``tokens`` counts others). A last
    epoch takes documents in key order while their running total stays within the budget; rows with
    equal keys go together, so repeated rows do. Null languages, sources and domains are '' in the
    tree. Leaves without tokens and nodes of weight 0 give nothing. A column epoch is replaced.
    """
    count = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)) if tokens is None else tokens
    named = with_path(df.drop("epoch"), domain)
    own = {f"{c}__": c for c in LEVELS}
    sized = named.select(
        F.col(key), *[F.col(a).alias(b) for a, b in own.items()], count.cast("long").alias("n_tokens"))
    found = plan(written_once(sized, "mix-sized"), weights, budget_percent, max_epochs, seed, key)
    found = found.select(*[F.col(b).alias(a) for a, b in own.items()], "epochs", "cut")
    wide = named.join(found.withColumnsRenamed({"epochs": "epochs__", "cut": "cut__"}), list(own))
    again = order_key(seed, F.col("epochs__"), F.col(key)) <= F.col("cut__")
    times = F.col("epochs__") + F.when(again, 1).otherwise(0)
    used = wide.withColumn("times__", times).where("times__ > 0")
    uses = used.select("*", F.explode(F.sequence(F.lit(0), (F.col("times__") - 1).cast("int"))).alias("epoch"))
    return uses.select(*[c for c in df.columns if c != "epoch"], "epoch")


def shares_sql(weights: Weights, budget_percent: int, max_epochs: int) -> str:
    """DuckDB SQL: budgets of the leaves of a view ``leaves`` (path, have), as CTEs ending in ``b3``."""
    parts = [f"total AS (SELECT sum(have)::HUGEINT * {budget_percent} // 100 AS given FROM leaves)"]
    for depth in range(1, len(LEVELS) + 1):
        path, parent = LEVELS[:depth], LEVELS[:depth - 1]
        names, over = ", ".join(path), f"PARTITION BY {', '.join(parent)}" if parent else ""
        source = f"JOIN b{depth - 1} USING ({', '.join(parent)})" if parent else "CROSS JOIN total"
        given = "budget" if parent else "given"
        parts.append(f"""
            c{depth} AS (SELECT {names}, {given} AS given, cap, w FROM (
                SELECT {names}, sum(have)::HUGEINT * {max_epochs} AS cap,
                       ({weight_sql(weights, depth)})::HUGEINT AS w
                FROM leaves WHERE {usable_sql(weights)} GROUP BY {names}) {source} WHERE w > 0 AND cap > 0),
            r{depth} AS (SELECT *, row_number() OVER o AS r,
                coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS before,
                (sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::HUGEINT AS left_w
                FROM c{depth} WINDOW o AS ({over} ORDER BY cap::DOUBLE / w::DOUBLE, {path[-1]})),
            f{depth} AS (SELECT *, coalesce(min(CASE WHEN cap * left_w > w * (given - before) THEN r END)
                OVER ({over}), r + 1) > r AS is_full FROM r{depth}),
            b{depth} AS (SELECT {names}, CASE WHEN is_full THEN cap ELSE
                (w * (given - coalesce(sum(cap) FILTER (WHERE is_full) OVER ({over}), 0)::HUGEINT))
                // (sum(w) FILTER (WHERE NOT is_full) OVER ({over}))::HUGEINT END AS budget FROM f{depth})""")
    return ",\n".join(parts)
