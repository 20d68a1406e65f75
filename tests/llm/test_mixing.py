from collections import defaultdict

from pyspark.sql import functions as F

from growthlab.llm import mixing

LEVELS = {"domain": F.col, "lang": F.col, "source": F.col}


def fill(children, budget):
    """children: name -> (room, weight); whole budgets by repeated sharing"""
    given, open_ = {n: 0 for n in children}, {n for n, (r, w) in children.items() if w > 0}
    left = budget
    while open_:
        rate = left / sum(children[n][1] for n in open_)
        full = {n for n in open_ if children[n][0] <= rate * children[n][1]}
        if not full:
            for n in open_:
                given[n] = int(children[n][1] * rate)
            break
        for n in full:
            given[n] = children[n][0]
            left -= children[n][0]
        open_ -= full
    return given


def plain_budgets(supply, weights, share, epochs):
    total = sum(supply.values())
    level = {(): min(total * share // 100, total * epochs)}
    for depth in (1, 2, 3):
        below = {}
        for parent, budget in level.items():
            rooms = defaultdict(int)
            for leaf, s in supply.items():
                if leaf[: depth - 1] == parent:
                    rooms[leaf[:depth]] += s * epochs
            below |= fill({n: (r, weights.get("/".join(n), 1)) for n, r in rooms.items()}, budget)
        level = below
    return level


def rows():
    out, k = [], 0
    for domain, lang, source, n in [
        ("web", "en", "a", 40), ("web", "en", "b", 3), ("web", "fr", "a", 10), ("web", None, "c", 4),
        ("books", "en", "d", 6), ("books", "de", "e", 2), (None, "en", "f", 5), ("none", "en", "g", 5),
    ]:
        for j in range(n):
            out.append((k, "w " * (1 + (j * 7) % 9), domain, lang, source, 1))
            k += 1
    out += [(None, "n n n", "web", "en", "a", 1), (5, "same id", "web", "en", "a", 1), (900, None, "web", "en", "a", 1), (901, " ", "x", "y", "z", 1)]
    return out


def test_budgets_and_prefixes(spark):
    weights = {"web": 1, "books": 5, "unknown": 2, "none": 0, "books/de": 3}
    docs = spark.createDataFrame(rows(), "doc_id long, text string, domain string, lang string, source string, epoch int")
    levels = {n: F.col(n) for n in LEVELS}
    supply = defaultdict(int)
    for _, t, d, l, s, _ in rows():
        n = len((t or "").split())
        if n:
            supply[tuple(x or "unknown" for x in (d, l, s))] += n
    for share, epochs in ((80, 2), (50, 1), (300, 3)):
        out = mixing.mix_sources(docs, levels, weights, share, epochs, seed="3").collect()
        budgets = plain_budgets(supply, weights, share, epochs)
        taken, passes = defaultdict(int), defaultdict(lambda: defaultdict(int))
        for r in out:
            leaf = (r.domain, r.lang, r.source)
            assert r.budget == budgets[leaf]
            taken[leaf] += r.n_tokens
            passes[leaf][r.epoch] += r.n_tokens
        for leaf, budget in budgets.items():
            whole, rest = divmod(budget, supply[leaf])
            assert whole <= epochs and all(passes[leaf][e] == supply[leaf] for e in range(whole))
            assert budget - 9 < taken[leaf] <= budget  # a prefix ends before the document that exceeds it
            assert passes[leaf].get(whole, 0) <= rest
        assert budgets["none", "en", "g"] == 0


def test_seed_orders_and_empty_table(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string, domain string, lang string, source string, epoch int")
    levels = {"source": F.col("source")}
    one, again, other = (
        sorted((r.doc_id or -1, r.epoch) for r in mixing.mix_sources(docs, levels, {}, 50, 2, seed=s).collect())
        for s in ("1", "1", "2")
    )
    assert one == again and one != other
    assert mixing.mix_sources(docs.limit(0), levels, {}).count() == 0
