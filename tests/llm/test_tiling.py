import random

from growthlab.llm import tiling
from tests.llm import plain

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"


def test_tiles_against_the_definition():
    rnd = random.Random(4)
    for _ in range(1500):
        kinds = rnd.choice([2, 3, 6])
        item = [rnd.randrange(kinds) for _ in range(rnd.randrange(14))]
        text = [rnd.randrange(-1, kinds) for _ in range(rnd.randrange(25))]
        least = rnd.choice([1, 2, 3])
        assert sorted(tiling.tiles(item, text, least)) == sorted(plain.tiles(item, text, least))


def test_reordered_and_partial_passages(spark):
    w = ITEM.split()
    docs = [
        (1, " ".join(w[8:] + ["x"] * 30 + w[:8]), 9),  # reordered
        (2, "x y", 9), (3, None, 9), (4, "", 9), (None, ITEM + " " + ITEM, 9),
        (5, "Alpha, BETA gamma! delta epsilon zeta eta theta", 9),  # half, other punctuation
        (6, " ".join(w[:7] + ["q"] + w[12:]), 9),  # one run of 7, one of 4
        (7, " ".join(w[::-1]), 9),
    ]
    docs = spark.createDataFrame(docs, "doc_id long, text string, coverage int")
    items = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "x y"), (4, "q r")], "item_id long, text string")
    for block in (1_000_000, 10):
        out = tiling.find_leaks(docs, items, block=block).collect()
        got = sorted((r.doc_id or 0, r.item_id, r.covered, r.item_tokens, r.tiles, r.longest) for r in out)
        assert got == [(0, 1, 16, 16, 1, 16), (1, 1, 16, 16, 2, 8), (2, 4, 2, 2, 1, 2), (5, 1, 8, 16, 1, 8)]
    kept = tiling.drop_leaks(docs, items)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 6, 7] and kept.columns == docs.columns
    assert tiling.find_leaks(docs.limit(0), items).count() == 0
    assert tiling.find_leaks(docs, items.limit(0)).count() == 0 and tiling.drop_leaks(docs, items.limit(0)).count() == 8


def test_planted_passages_are_found_and_others_left(spark):
    folder = "/root/testdata/sf0.01"
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    found = {(r.doc_id, r.item_id) for r in tiling.find_leaks(docs, items).collect()}
    texts, bench = docs.collect(), items.collect()
    inside = {(d.doc_id, b.item_id) for d in texts for b in bench if b.text in (d.text or "")}
    assert inside and inside <= found and len(found) <= len(inside) + 2
