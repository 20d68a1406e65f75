import random

import numpy as np
import pytest

from growthlab.llm import fmindex, substrings
from tests.llm import plain


def test_matching_statistics_against_slices():
    rng = np.random.default_rng(0)
    for _ in range(40):
        n = int(rng.integers(2, 200))
        text = rng.integers(1, 4, n)
        text[rng.integers(0, n, max(1, n // 20))] = 0
        text[-1] = 0
        if not text.max():
            continue
        index = fmindex.FMIndex(text, 5)
        query = rng.integers(1, text.max() + 1, 60)
        rows = index.matches(query, np.array([0, 30]), np.array([30, 60]))
        slices = {tuple(text[i : i + 5]) for i in range(n - 4)}
        for i in range(60):
            fits = i + 5 <= (30 if i < 30 else 60)
            assert (rows[i] >= 0) == (fits and tuple(query[i : i + 5]) in slices)
            if rows[i] >= 0:
                at = index.order[rows[i]]
                assert tuple(text[at : at + 5]) == tuple(query[i : i + 5])


@pytest.mark.parametrize("hot,shard", [(10_000, 10_000), (3, 50)])
def test_repeated_windows_go(spark, hot, shard):
    rnd = random.Random(3)
    base = [" ".join(rnd.choice(["a", "b", "é", "ü x", "z\n", "q\t"]) for _ in range(60)) for _ in range(4)]
    docs = []
    for k in range(50):
        one = rnd.choice(base)
        docs.append((k * 3, f"{one[rnd.randrange(60):]} {rnd.choice(base)} w{k} {one}"))
    docs += [(1000, None), (1001, ""), (1002, " \n "), (1003, docs[7][1]), (1004, docs[7][1]), (None, base[0])]
    rnd.shuffle(docs)
    frame = spark.createDataFrame([(i, t, 5) for i, t in docs], "doc_id long, text string, n_words int").repartition(5)
    out = substrings.remove_repeats(frame, length=7, hot=hot, shard=shard).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.text) for r in out), key=lambda r: plain.last_null(r[0]))
    assert got == plain.repeats(docs, 7)


def test_repeated_ids_and_empty_table(spark):
    text = "a b c d e f g h"
    frame = spark.createDataFrame([("x", text), ("x", text), ("y", text), ("x", "q " + text)], "doc_id string, text string")
    out = sorted((r.doc_id, r.n_words, r.n_removed) for r in substrings.remove_repeats(frame, length=4).collect())
    # equal id and text are one document; of the other text under that id the hash order decides
    assert out[-1] == ("y", 8, 8) and sum(r[2] for r in out[:3]) in (8, 16)
    assert substrings.remove_repeats(frame.limit(0)).count() == 0
