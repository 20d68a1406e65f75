"""The prefix trie of many conversations, by union-find over sorted neighbours.

A conversation is the sequence of its turns' 128-bit digests. Equal sequences are contracted to one row with a
count; the rows are sorted by sequence over all tasks, and neighbours are joined by an edge whose depth is the length
of their common prefix. Inside a task, edges are taken in descending depth: each joins the components on its two
sides, and the joint component is the branching node at that depth; the stretches of a component's path between two
joins are its nodes with one child. A prefix that reaches over a task's first or last row gives only a part of
its node there. These parts, at most two paths per task, are keyed by the prefix's own digest and added up in one
aggregate, so no task and not the driver sees more than its own forest.

What a node sums over its subtree is kept as sums over edges: an edge of depth l saves the words of its path
between the node and l, so saved words are W(l) - W(depth - 1) summed over the edges inside the node's component,
copies being edges of full depth."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from growthlab.llm.storage import forget, ready, stored
from growthlab.session import durable

#: bytes of a turn's digest
DIGEST = 16
NOBODY = hashlib.sha256(b"").hexdigest()
#: bytes of paths that a task's forest should hold
FOREST_BYTES = 32 << 20
#: rows of a batch on its way to Spark
ROWS = 20_000


def turn_digest(role: str, text: str):
    """Sixteen bytes for a role and a text; the length keeps the two apart."""
    role, text = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    return F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)))


def turn_words(text: str):
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))


def paths_of(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv_id and its turns in order as an array of (digest, words). Only digests are shuffled."""
    at = F.struct(F.col(turn_col).isNotNull().alias("known"), F.col(turn_col).alias("turn"))
    rows = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.struct(at.alias("at"), turn_digest(role_col, text_col).alias("digest"), turn_words(text_col).alias("words")).alias("t"),
    )
    own = F.transform(F.array_sort(F.collect_list("t")), lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words")))
    return rows.groupBy("conv_id").agg(own.alias("turns"))


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's conversation numbers, comma-joined, in the order they come."""
    now, sha = None, None
    for batch in batches:
        done = []
        for key, conv in zip(batch["key"].to_pylist(), batch["conv_id"].to_pylist()):
            if key != now:
                if now is not None:
                    done.append((now, sha.hexdigest()))
                now, sha = key, hashlib.sha256(str(conv).encode())
            else:
                sha.update(f",{conv}".encode())
        yield _batch(done, _ENDS)
    if now is not None:
        yield _batch([(now, sha.hexdigest())], _ENDS)


_ENDS = pa.schema([("key", pa.binary()), ("ends", pa.string())])
_NODES = pa.schema(
    [
        ("node", pa.binary()), ("parent", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()),
        ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("edges", pa.int64()), ("above", pa.int64()),
        ("ends", pa.string()),
    ]
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.string(): "string", pa.int64(): "long", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def common_turns(a: bytes, b: bytes) -> int:
    """Turns that two sequences of digests share at their beginning."""
    n = min(len(a), len(b)) // DIGEST * DIGEST
    if a[:n] == b[:n]:
        return n // DIGEST
    x, y = (np.frombuffer(s[:n], dtype=np.uint64) for s in (a, b))
    return int(np.argmax(x != y)) * 8 // DIGEST


class Forest:
    """Union-find over the rows of one task: distinct paths in ascending order.

    `left` and `right` are the turns that the first and the last row share with the rows before and after them
    in other tasks (-1: there are none). A node at such a depth or above is only part of a node."""

    def __init__(self, paths: list[bytes], words: list[list[int]], left: int, right: int) -> None:
        self.first, self.last = paths[0], paths[-1]
        self.left, self.right = left, right
        self.lcp = [-1] + [common_turns(a, b) for a, b in zip(paths, paths[1:])]
        self.length = [len(p) // DIGEST for p in paths]
        # words of the first d turns at place d
        self.above = [np.concatenate([[0], np.cumsum(w, dtype=np.int64)]) for w in words]
        after = [*self.lcp[1:], right]
        self.leaves = [int(x < n) for x, n in zip(after, self.length)]
        self.root = list(range(len(paths)))

    def find(self, k: int) -> int:
        while self.root[k] != k:
            self.root[k] = self.root[self.root[k]]
            k = self.root[k]
        return k

    def _names(self, path: bytes, depth: int) -> list[bytes]:
        """Digests of a path's prefixes of 0 to `depth` turns."""
        sha, out = hashlib.blake2b(digest_size=DIGEST), []
        for d in range(depth + 1):
            out.append(sha.digest())
            sha.update(path[d * DIGEST : (d + 1) * DIGEST])
        return out

    def nodes(self, copies: list[int], convs: list[int], ends: list[str]) -> Iterator[tuple]:
        """A tuple of _NODES for each node; `node` names those that are parts, `parent` such a parent."""
        m = len(self.length)
        names = self._names(self.first, self.left), self._names(self.last, self.right)
        n, least, leaves, last = list(copies), list(convs), list(self.leaves), list(range(m))
        top, children = list(self.length), [0] * m
        ended: list[str | None] = list(ends)
        edges = [(copies[k] - 1) * int(self.above[k][-1]) for k in range(m)]
        # rows that wait for their parent, the node at the top of their component
        waiting: list[list[list]] = [[] for _ in range(m)]

        def name(k: int, depth: int) -> bytes | None:
            if k == 0 and depth <= self.left:
                return names[0][depth]
            return names[1][depth] if last[k] == m - 1 and depth <= self.right else None

        def close(k: int, down_to: int) -> Iterator[tuple]:
            """Nodes of component k from its top to just below `down_to`; the last one stays in waiting."""
            above = self.above[k]
            for d in range(top[k], down_to, -1):
                part, kids = name(k, d), children[k] if d == top[k] else 1
                if k == 0 and d < self.left:
                    kids -= 1  # the first child is a part of the previous task's
                carried = int(above[self.left]) if k == 0 and 0 <= d <= self.left else 0
                row = [
                    part, None, least[k], d, None, n[k], kids, leaves[k], edges[k] + carried,
                    int(above[d - 1]) if d else 0, ended[k] if d == top[k] else None,
                ]
                for child in waiting[k]:
                    child[1], child[4] = part, None if part else least[k]
                    yield tuple(child)
                waiting[k] = [row]

        for k in sorted(range(1, m), key=self.lcp.__getitem__, reverse=True):
            depth, a = self.lcp[k], self.find(k - 1)
            if top[a] > depth:
                yield from close(a, depth)
                top[a], children[a], ended[a] = depth, 1, None
            yield from close(k, depth)
            self.root[k] = a
            waiting[a] += waiting[k]
            waiting[k] = []
            children[a] += 1
            n[a] += n[k]
            leaves[a] += leaves[k]
            edges[a] += edges[k] + int(self.above[k][depth])
            least[a], last[a] = min(least[a], least[k]), last[k]
        yield from close(0, -1)
        yield from map(tuple, waiting[0])


def _grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of the forests of the slices that a task gets, each slice's rows together and in order."""

    def forests() -> Iterator[tuple]:
        held: list[tuple] = []
        for batch in batches:
            names = ("slice", "path", "words", "copies", "conv_id", "ends", "left", "right")
            for row in zip(*[batch[c].to_pylist() for c in names]):
                if held and held[0][0] != row[0]:
                    yield from grown(held)
                    held = []
                held.append(row)
        if held:
            yield from grown(held)

    def grown(rows: list[tuple]) -> Iterator[tuple]:
        _, paths, words, copies, convs, ends, left, right = map(list, zip(*rows))
        yield from Forest(paths, words, left[0], right[0]).nodes(copies, convs, ends)

    out = []
    for node in forests():
        out.append(node)
        if len(out) == ROWS:
            yield _batch(out, _NODES)
            out = []
    yield _batch(out, _NODES)


def _borders(slices: DataFrame) -> DataFrame:
    """Turns that each slice shares with the slices before and after it; one row per slice."""

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("slice", "before", "first", "last", "after")]
            rows = [
                (s, -1 if x is None else common_turns(x, f), -1 if y is None else common_turns(z, y))
                for s, x, f, z, y in zip(*columns)
            ]
            yield _batch(rows, pa.schema([("slice", pa.int64()), ("left", pa.int64()), ("right", pa.int64())]))

    ends = slices.groupBy("slice").agg(F.min("path").alias("first"), F.max("path").alias("last"))
    order = W.orderBy("slice")
    beside = ends.withColumns({"before": F.lag("last").over(order), "after": F.lead("first").over(order)})
    return beside.mapInArrow(shared, "slice long, left long, right long")


def prefix_trie(paths: DataFrame, forest_bytes: int = FOREST_BYTES) -> DataFrame:
    """Nodes of the trie of `paths` (conv_id long, turns array<struct<digest binary, words int>>), one row each: conv_id
    (smallest member), depth, parent_conv_id (NULL at the root), n_convs, n_children, n_leaves, saved_tokens and
    ends_sha256 (lower-case hex of the members' numbers that end here, ascending, comma-joined).

    A conversation without turns is a member of the root; no conversations give no node. Rows of one conv_id count
    as one conversation each; NULL conv_ids do not count. Other columns are ignored. Digests are held to tell
    turns apart (16 bytes). A conversation is one row of 16 bytes and a word count a turn, so its length is bounded by
    Spark's row size (tens of millions of turns); conversations that share turns, or all of them, in any number are
    dealt over tasks, but for the ascending hash of equal ones, which is defined in sequence and is streamed."""
    spark = ready(paths.sparkSession)
    path = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), ""))
    rows = paths.where("conv_id IS NOT NULL").select("conv_id", path.alias("path"), F.transform("turns", lambda t: t["words"]).alias("words"))
    rows = stored(rows.withColumn("key", F.unhex(F.md5("path"))), "paths")
    # equal paths become one row; their numbers stream through a task in order
    whole = rows.groupBy("key").agg(
        F.any_value("path").alias("path"), F.any_value("words").alias("words"), F.count("*").alias("copies"), F.min("conv_id").alias("conv_id")
    )
    dealt = rows.select("key", "conv_id").repartition("key").sortWithinPartitions("key", "conv_id")
    ends = dealt.mapInArrow(_ends, _ddl(_ENDS))
    distinct = stored(whole.join(ends, "key"), "distinct_paths")
    size = distinct.agg(F.sum(F.octet_length("path") + 8 * F.size("words") + 200)).first()[0] or 0
    # slices of the sorted paths, fixed by a reliable checkpoint, as their bounds are drawn from a sample
    n = max(1, -(-size // forest_bytes), min(spark.sparkContext.defaultParallelism, size // (1 << 20)))
    slices = durable(distinct.repartitionByRange(int(n), "path").withColumn("slice", F.spark_partition_id().cast("long")))
    borders = stored(_borders(slices), "borders")
    # three numbers for every forest_bytes of paths; the join leaves each slice in its partition
    grown = slices.join(F.broadcast(borders), "slice").sortWithinPartitions("path")
    nodes = stored(grown.mapInArrow(_grow, _ddl(_NODES)), "nodes")
    forget(rows, distinct, borders)

    parts = nodes.where("node IS NOT NULL").groupBy("node", "depth").agg(
        F.max("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("edges").alias("edges"),
        F.max("above").alias("above"), F.max("ends").alias("ends"), F.max("parent_conv_id").alias("parent_conv_id"),
    )
    parts = stored(parts, "merged_nodes")
    all_nodes = nodes.where("node IS NULL").unionByName(parts)
    # a node below a merged one learns its parent's number from it; rows under one parent may be many
    above = parts.select(F.col("node").alias("parent"), F.col("conv_id").alias("merged_conv"))
    out = all_nodes.join(above, "parent", "left")
    saved = F.col("edges") - (F.col("n_convs") - 1) * F.col("above")
    return out.select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "merged_conv").alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", saved.alias("saved_tokens"), F.coalesce("ends", F.lit(NOBODY)).alias("ends_sha256"),
    )
