import random

import numpy as np
import pytest

from growthlab.llm import graph, neardup
from tests.llm import plain

ODD = [(1000, "one"), (1001, "One"), (1002, ""), (1003, None), (1004, " \n "), (None, "one"), (1005, "two words"), (1006, "two  WORDS")]


def clusters(seed, size):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    bases = [[rnd.choice(vocabulary) for _ in range(100)] for _ in range(3)]
    out = []
    for k in range(size):
        text, rate = list(rnd.choice(bases)), rnd.random() * 0.15
        out.append((k, " ".join(rnd.choice(vocabulary) if rnd.random() < rate else w for w in text)))
    return out


@pytest.mark.parametrize("together,shingle", [(20_000, 2), (30, 2), (20_000, 5)])
def test_components_are_exact(spark, monkeypatch, together, shingle):
    monkeypatch.setattr(neardup, "TOGETHER", together)  # small: groups are split by a second chunk
    docs = clusters(5, 200) + ODD
    frame = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, kept string")
    out = neardup.near_duplicates(frame, shingle=shingle).collect()
    want = plain.near(docs, shingle)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in out) and len(out) == len(docs)


def test_repeated_rows_and_empty_table(spark):
    frame = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, None), (None, "z")], "doc_id long, text string")
    out = neardup.near_duplicates(frame, shingle=2).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in out) == [
        (0, 0, 0, True), (0, 1, 0, True), (1, 2, 1, True), (1, 2, 1, True)
    ]
    assert neardup.near_duplicates(frame.limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    found = {r.node: r.label for r in graph.components(edges).collect()}
    assert found == {**{k: 0 for k in range(61)}, 100: 100, 101: 100}


def test_pairs_in_one_key_of_a_large_group(spark, monkeypatch):
    """A pair that shares one chunk only is met in a group that is dealt into blocks."""
    monkeypatch.setattr(neardup, "TOGETHER", 10)
    rng = np.random.default_rng(5)
    signs = rng.integers(0, 1 << 16, (60, neardup.CHUNKS * neardup.WIDTH), dtype=np.uint16)
    signs[:, : neardup.WIDTH] = signs[0, : neardup.WIDTH]  # one group: the first chunk
    for k in range(0, 60, 2):  # two symbols wrong in each other chunk: 18 of 50
        signs[k + 1, neardup.WIDTH :] = signs[k, neardup.WIDTH :]
        for c in range(1, neardup.CHUNKS):
            signs[k + 1, c * neardup.WIDTH : c * neardup.WIDTH + 2] ^= 1
    rows = [(77, 0, k, 0 if k < 30 and k % 2 else k, 100, signs[k].tobytes(), -1) for k in range(60)]
    apart = spark.createDataFrame(rows, "key long, number int, node long, label long, _n long, _sign binary, side int")
    dealt = neardup._deal(apart)
    assert max(r["count"] for r in dealt.groupBy("key").count().collect()) <= 30  # of 60, and of 105 in two sides
    met = {}
    for r in neardup._across(dealt, 80).collect():
        met.setdefault(r.key, set()).add(r.node)
    for k in range(0, 60, 2):
        if rows[k][3] != rows[k + 1][3]:
            assert any({k, k + 1} <= m for m in met.values())
