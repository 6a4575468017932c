"""Budgets and prefixes against a plain version, and the query against SQL."""

import hashlib
import random
from collections import defaultdict
from fractions import Fraction

import duckdb
from pyspark.sql import functions as F

from check_queries import compare
from ledgerhub.llm import mixing
from ledgerhub.llm.queries import ORACLES, QUERIES

WEIGHTS = {("a",): 3, ("b",): 1, ("*", "en"): 2, ("a", "en"): 5, ("*", "*", "s1"): 4, ("*", "*", "none"): 0}


def weight(path):
    found = [p for p in WEIGHTS if len(p) == len(path) and all(x in ("*", y) for x, y in zip(p, path))]
    return WEIGHTS[min(found, key=lambda p: (p.count("*"), p))] if found else 1


def fill(children, given):
    """{path: (cap, w)} -> {path: budget}"""
    todo = sorted((p for p, (cap, w) in children.items() if cap > 0 and w > 0),
                  key=lambda p: (Fraction(children[p][0]) / children[p][1], p))
    out = {}
    while todo and children[todo[0]][0] * sum(children[p][1] for p in todo) <= children[todo[0]][1] * given:
        out[todo[0]] = children[todo[0]][0]
        given -= out[todo[0]]
        todo = todo[1:]
    total = sum(children[p][1] for p in todo)
    return out | {p: children[p][1] * given // total for p in todo}


def brute(rows, percent, epochs, seed):
    leaf = {i: (d or "", l or "", s or "") for i, (_, d, l, s, _) in enumerate(rows)}
    have = defaultdict(int)
    for i, r in enumerate(rows):
        have[leaf[i]] += r[4]
    found = {(): sum(have.values()) * percent // 100}
    for depth in (1, 2, 3):
        caps = defaultdict(int)
        for p, n in have.items():
            if all(weight(p[:k]) > 0 for k in (1, 2, 3)):
                caps[p[:depth]] += n * epochs
        new = {}
        for parent, given in found.items():
            new |= fill({p: (c, weight(p)) for p, c in caps.items() if p[:-1] == parent}, given)
        found = new
    uses = []
    for p, budget in found.items():
        if not budget:
            continue
        full, rest = divmod(budget, have[p])
        own = [i for i in leaf if leaf[i] == p]
        uses += [(i, e) for i in own for e in range(full)]
        key = {i: hashlib.md5(f"{seed}|{full}|{'' if rows[i][0] is None else rows[i][0]}".encode()).hexdigest() for i in own}
        for i in own:
            if rest and sum(rows[j][4] for j in own if key[j] <= key[i]) <= rest:
                uses.append((i, full))
    return sorted(uses)


def test_against_plain_version(spark):
    rng = random.Random(5)
    for case in range(4):
        rows = []
        for i in range(150):
            d, l, s = rng.choice("aab") if case else "a", rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "none", None])
            rows.append((rng.choice([i, i, None, 7]), d, l, s, rng.choice([0, 1, 5, 30, 400])))
        percent, epochs = ((50, 1), (75, 2), (180, 3), (1000, 2))[case]
        df = spark.createDataFrame([(*r, i, "x") for i, r in enumerate(rows)],
                                   "doc_id long, domain string, lang string, source string, n long, row int, epoch string")
        got = mixing.mix(df, F.col("domain"), WEIGHTS, percent, epochs, 3, tokens=F.col("n"))
        assert got.columns == ["doc_id", "domain", "lang", "source", "n", "row", "epoch"]
        assert sorted((r["row"], r["epoch"]) for r in got.collect()) == brute(rows, percent, epochs, 3)


def test_shortage_goes_to_siblings_first(spark):
    rows = [("a", "en", "s1", 10), ("a", "en", "s2", 1000), ("b", "en", "s2", 2000)]
    leaves = spark.createDataFrame(rows, "domain string, lang string, source string, have long")
    even = {r["source"] + r["domain"]: int(r["budget"]) for r in mixing.budgets(leaves, {}, 1000, 1).collect()}
    assert even == {"s1a": 10, "s2a": 490, "s2b": 500}
    short = {r["source"] + r["domain"]: int(r["budget"]) for r in mixing.budgets(leaves, {}, 2600, 1).collect()}
    assert short == {"s1a": 10, "s2a": 1000, "s2b": 1590}


def test_shortage_below_weight_0_goes_to_the_sibling(spark):
    """The budget is 15,500: web can use 1,000 of its tokens, so books gets the other 14,500."""
    rows = [("web", "en", "usable", 1000), ("web", "en", "zero", 10000), ("web", "xx", "usable", 10000), ("books", "en", "s", 20000)]
    leaves = spark.createDataFrame(rows, "domain string, lang string, source string, have long")
    weights = {("*", "*", "zero"): 0, ("*", "xx"): 0}
    got = {r["domain"]: int(r["budget"]) for r in mixing.budgets(leaves, weights, 15500, 1).collect()}
    assert got == {"web": 1000, "books": 14500}
    con = duckdb.connect()
    con.execute("CREATE TABLE leaves (domain VARCHAR, lang VARCHAR, source VARCHAR, have BIGINT)")
    con.executemany("INSERT INTO leaves VALUES (?, ?, ?, ?)", rows)
    twin = con.execute(f"WITH {mixing.shares_sql(weights, 50, 1)} SELECT domain, CAST(budget AS BIGINT) FROM b3 WHERE budget > 0")
    assert dict(twin.fetchall()) == {"web": 1000, "books": 19500}  # 50 % of 41,000 tokens


def test_odd_frames(spark):
    df = spark.createDataFrame([(1, None, None, None)] * 3 + [(2, "", "en", "s"), (3, "w " * 20000, "en", "s")],
                               "doc_id long, text string, lang string, source string")
    got = mixing.mix(df, F.lit("d"), {}, 100, 1, 1).collect()
    assert sorted(r["doc_id"] for r in got) == [2, 3]  # leaves without words give nothing
    assert mixing.mix(df.limit(0), F.lit("d"), {}, 100, 1, 1).count() == 0
    assert mixing.mix(df, F.lit("d"), {("d",): 0}, 100, 1, 1).count() == 0


def test_query(spark, con, small):
    good, note = compare(QUERIES["op1_mixing"](spark, small), con, ORACLES["op1_mixing"])
    assert good, note
