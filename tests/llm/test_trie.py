import hashlib
import random

import pytest
from pyspark.sql import functions as F

from growthlab.llm import queries, trie

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(convs):
    """convs: list of (conv_id, [(turn, words)]); every node from the sets of its members."""
    nodes = {}
    for i, turns in convs:
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append((i, d == len(turns)))
    kids = {}
    for k in nodes:
        if k:
            kids.setdefault(k[:-1], []).append(k)
    leaves, saved = {}, {}
    for k in sorted(nodes, key=len, reverse=True):
        below = kids.get(k, [])
        leaves[k] = sum(leaves[b] for b in below) if below else 1
        own = (len(nodes[k]) - 1) * k[-1][1] if k else 0
        saved[k] = own + sum(saved[b] for b in below)
    out = []
    for k, members in nodes.items():
        ends = ",".join(str(i) for i in sorted(i for i, e in members if e))
        parent = min(i for i, _ in nodes[k[:-1]]) if k else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(i for i, _ in members), len(k), parent, len(members), len(kids.get(k, [])), leaves[k], saved[k], sha))
    return sorted(out, key=str)


def made(spark, convs):
    def digest(t):
        return hashlib.md5(str(t[0]).encode()).digest()

    rows = [(i, [(digest(t), t[1]) for t in turns], "x") for i, turns in convs]
    return spark.createDataFrame(rows, "conv_id long, turns array<struct<digest: binary, words: int>>, depth string")


def drawn(seed, n, longest, letters):
    draw = random.Random(seed)
    convs = []
    for i in draw.sample(range(-n, 9 * n), n):
        if convs and draw.random() < 0.4:
            turns = list(draw.choice(convs)[1])
            turns = turns[: draw.randrange(len(turns) + 1)] if draw.random() < 0.6 else turns
        else:
            turns = []
        if draw.random() < 0.6:
            turns = turns + [(c, c % 5) for c in draw.choices(range(letters), k=draw.randrange(longest))]
        convs.append((i, turns))
    return convs


@pytest.mark.parametrize("seed, n, longest, letters, room", [(1, 300, 6, 2, 600), (2, 200, 9, 4, 3000), (3, 120, 30, 3, 400), (4, 60, 3, 1, 250), (5, 80, 5, 9, 1 << 20)])
def test_random_tries_over_many_slices(spark, seed, n, longest, letters, room):
    convs = drawn(seed, n, longest, letters)
    got = trie.prefix_trie(made(spark, convs), forest_bytes=room).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(convs)


def test_forest_matches_whole_trie_at_every_cut():
    convs = drawn(8, 40, 6, 2)
    paths = sorted({b"".join(bytes([t[0] + 1]) * 16 for t in turns) for _, turns in convs})
    words = [[p[k] for k in range(0, len(p), 16)] for p in paths]
    ends = [str(k) for k in range(len(paths))]
    whole = list(trie.Forest(paths, words, -1, -1).nodes([1] * len(paths), list(range(len(paths))), ends))
    for cut in range(1, len(paths)):
        shared = trie.common_turns(paths[cut - 1], paths[cut])
        rows = []
        for lo, hi, left, right in ((0, cut, -1, shared), (cut, len(paths), shared, -1)):
            forest = trie.Forest(paths[lo:hi], words[lo:hi], left, right)
            rows += forest.nodes([1] * (hi - lo), list(range(lo, hi)), ends[lo:hi])
        merged = {}
        for r in rows:
            if r[0] is not None:
                merged.setdefault(r[0], []).append(r)
        assert sorted(r[3] for r in rows if r[0] is None) + [d for x in merged.values() for d in {r[3] for r in x}] and len(merged) == shared + 1
        done = [r[2:4] + r[5:9] for r in rows if r[0] is None]
        for x in merged.values():
            done.append((min(r[2] for r in x), x[0][3], *(sum(r[k] for r in x) for k in (5, 6, 7, 8))))
        assert sorted(done) == sorted(r[2:4] + r[5:9] for r in whole)


def test_turnless_repeated_and_null_conversations(spark):
    convs = [(5, []), (7, []), (5, []), (2, [(1, 4)]), (2, [(1, 4)])]
    frame = made(spark, convs).unionByName(made(spark, [(None, [(1, 4), (2, 2)])]))
    got = sorted((tuple(r) for r in trie.prefix_trie(frame).collect()), key=str)
    assert got == plain(convs) and len(got) == 2
    assert trie.prefix_trie(made(spark, [])).collect() == []


def test_long_conversation_and_long_text(spark):
    turns = [(k, 1) for k in range(3000)]
    convs = [(1, turns), (2, turns[:2500]), (3, [*turns[:2500], (-1, 9)])]
    got = trie.prefix_trie(made(spark, convs), forest_bytes=1000).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(convs)
    rows = spark.createDataFrame([(1, 0, "user", "a b " * 500_000)], SCHEMA)
    assert trie.paths_of(rows, "conv_id", "turn", "role", "text").first().turns[0].words == 1_000_000


def test_paths_order_turns_and_fill_nulls(spark):
    rows = [(1, 2, "user", "b"), (1, None, None, "a a"), (1, 0, "user", None), (None, 0, "user", "x"), (1, 2, "user", "b"), (4, 0, "u", "ser")]
    frame = spark.createDataFrame([(*r, 3) for r in rows], SCHEMA + ", words int")
    got = {r.conv_id: r.turns for r in trie.paths_of(frame, "conv_id", "turn", "role", "text").collect()}
    assert set(got) == {1, 4} and [t.words for t in got[1]] == [2, 0, 1, 1]
    assert got[1][2].digest == hashlib.md5(b"4:userb").digest() and got[1][1].digest == hashlib.md5(b"4:user").digest()


def test_query_with_shared_heads_over_slices(spark):
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").unionByName(
        spark.createDataFrame([(40, 0, "user", "alone"), (45, 9, "user", "tail"), (65, 1, "user", "gone"), (66, 1, "user", "gone")], SCHEMA)
    )
    paths = queries.with_shared_heads(trie.paths_of(turns, "conv_id", "turn", "role", "text"))
    convs = [(r.conv_id, [(bytes(t.digest), t.words) for t in r.turns]) for r in paths.collect()]
    got = trie.prefix_trie(paths.withColumn("depth", F.lit(1)), forest_bytes=700).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(convs)
