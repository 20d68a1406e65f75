"""Near duplicates by a multi-index Hamming join over b-bit MinHash signatures.

A document's signature is `CHUNKS * WIDTH` symbols of 16 bits, each the low bits of a MinHash over its
shingles. Two documents of similarity s differ in a symbol with probability about 1 - s. The signature is
split into CHUNKS chunks; every chunk is looked up with one wrong symbol allowed, by leaving out each of
its symbols in turn. By the pigeonhole principle every pair that differs in at most
2 * CHUNKS - 1 symbols shares a key; a pair at similarity 0.8 lies in no shared key with
probability 0.263 ** 10, about 2 in a million, whatever its distance. Candidates are confirmed on their
full shingle sets.

No group of a shared key is expanded into pairs. For a few rounds its members are paired with one member
(another one each round) and confirmed links merge them into components, so a large group of copies soon
is one component. Then members outside a group's largest component are compared with the rest, signature
against signature and then set against set inside the task; only confirmed links leave it. Each pair is
compared in one of the keys it shares. Very large groups are dealt into blocks: a task compares a block of
members outside the largest component with a block of all members, under the group's own key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthlab.llm import words as tx
from growthlab.llm.graph import components
from growthlab.llm.storage import forget, ready, stored, without

CHUNKS, WIDTH = 10, 5
#: candidates may differ in this share of symbols; a pair at 0.8 exceeds it once in some ten million
FAR = 0.54
#: rounds of links to one member of each group
ROUNDS = 3
#: members of a group that one task compares; larger groups are dealt into pairs of blocks
TOGETHER = 20_000
_U = np.uint64


def _slots() -> tuple[np.ndarray, np.ndarray]:
    seeds = tx.mix(np.arange(1, 2 * CHUNKS * WIDTH + 1, dtype=np.uint64))
    return seeds[: CHUNKS * WIDTH, None], seeds[CHUNKS * WIDTH :, None] | _U(1)


def signature(shingles: np.ndarray, slots: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """16 bits of the MinHash of every slot."""
    flip, times = slots
    least = np.full(len(flip), np.iinfo(np.uint64).max, dtype=np.uint64)
    for low in range(0, len(shingles), 1 << 14):  # keeps the table of products in cache
        least = np.minimum(least, ((shingles[None, low : low + (1 << 14)] ^ flip) * times).min(axis=1))
    return ((least >> _U(20)) & _U(0xFFFF)).astype(np.uint16)


def _fingerprint(shingles: np.ndarray) -> bytes:
    return (
        np.add.reduce(tx.mix(shingles)).tobytes()
        + np.add.reduce(tx.mix(shingles ^ _U(0x5851F42D4C957F2D))).tobytes()
    )


def _read(docs: DataFrame, text_col: str, n: int, keep_text: bool) -> DataFrame:
    """Set size, set fingerprint, and the signature or the text, of every row."""
    fields = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes if keep_text or c != text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, slots = tx.cache(), _slots()
        for batch in batches:
            for low, high in tx.slices(batch[text_col]):
                part = batch.slice(low, high - low)
                found = tx.split(part[text_col])
                sets = tx.shingle_sets(found, found.hashes(cache, lower=True), n)
                out = part if keep_text else part.drop_columns([text_col])
                out = out.append_column("_n", pa.array([len(s) for s in sets], type=pa.int64()))
                prints = [_fingerprint(s) if len(s) else None for s in sets]
                out = out.append_column("_print", pa.array(prints, type=pa.binary()))
                if not keep_text:
                    signs = [signature(s, slots).tobytes() if len(s) else None for s in sets]
                    out = out.append_column("_sign", pa.array(signs, type=pa.binary()))
                yield out

    return docs.mapInArrow(run, f"{fields}, _n long, _print binary" + ("" if keep_text else ", _sign binary"))


def _masks() -> list[list[int]]:
    """Symbols that make up each key: a chunk without one of its symbols."""
    return [
        [c * WIDTH + k for k in range(WIDTH) if k != out] for c in range(CHUNKS) for out in range(WIDTH)
    ]


def _first_key(same: np.ndarray) -> np.ndarray:
    """The number of the first key that two signatures share, from where their symbols agree."""
    wrong = ~same.reshape(len(same), CHUNKS, WIDTH)
    chunk = np.argmax(wrong.sum(axis=2) <= 1, axis=1)
    return chunk * WIDTH + np.argmax(wrong[np.arange(len(same)), chunk], axis=1)


def _keys(signs: pa.Array, above: np.ndarray | None = None) -> np.ndarray:
    """64-bit keys (rows x masks) of signatures; `above` prefixes the key of the group they are in."""
    table = np.frombuffer(b"".join(signs.to_pylist()), dtype=np.uint16).reshape(len(signs), CHUNKS * WIDTH)
    table = table.astype(np.uint64)
    out = []
    for k, kept in enumerate(_masks()):
        packed = np.zeros(len(table), dtype=np.uint64)
        for at in kept:
            packed = (packed << _U(16)) | table[:, at]
        key = tx.mix(packed + _U(0x9E3779B97F4A7C15 * (k + 1) % (1 << 64)))
        out.append(key if above is None else tx.mix(key ^ above))
    return np.stack(out, axis=1)


def _index(reps: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = _keys(batch["_sign"])
            node = np.repeat(np.asarray(batch["node"]), keys.shape[1])
            number = np.tile(np.arange(keys.shape[1], dtype=np.int32), len(keys))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.reshape(-1).view(np.int64)), pa.array(number), pa.array(node)],
                names=["key", "number", "node"],
            )

    return reps.select("node", "_sign").mapInArrow(run, "key long, number int, node long")


def _deal(rows: DataFrame) -> DataFrame:
    """Large groups as pairs of blocks: members outside the largest component (side 0) and all members (side 1).

    Every pair of different components meets in some pair of blocks, and each has TOGETHER members or so. Rows keep the
    number of their key."""
    half = F.lit(max(1, TOGETHER // 2))
    parts = rows.groupBy("key", "label").agg(F.count(F.lit(1)).alias("part"))
    groups = parts.groupBy("key").agg(F.sum("part").alias("all"), F.max(F.struct("part", "label")).alias("most"))
    blocks = lambda n: F.ceil(n / half).cast("long")
    groups = groups.select(
        "key", F.col("most.label").alias("_most"), blocks(F.col("all") - F.col("most.part")).alias("_few"), blocks(F.col("all")).alias("_all")
    )
    dealt = rows.drop("side").join(groups, "key").where("_few > 0")
    block = lambda n, seed: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(n))
    other = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    few = dealt.where(F.col("label") != F.col("_most")).withColumn("_i", block("_few", 0)).withColumn("_j", other("_all"))
    every = dealt.withColumn("_j", block("_all", 1)).withColumn("_i", other("_few"))
    both = few.withColumn("side", F.lit(0)).unionByName(every.withColumn("side", F.lit(1)))
    return both.withColumn("key", F.xxhash64("key", "_i", "_j")).select(rows.columns)


def _compatible(signs_a: np.ndarray, signs_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int):
    far = (signs_a != signs_b).sum(axis=-1) > FAR * CHUNKS * WIDTH
    return ~far & (100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b))


def _near(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs whose signatures and set sizes allow the similarity."""
    side = reps.select("node", F.col("_n"), F.col("_sign"))
    both = pairs
    for c in ("a", "b"):
        both = both.join(side.select(F.col("node").alias(c), F.col("_n").alias(f"n_{c}"), F.col("_sign").alias(f"s_{c}")), c)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            signs = [
                np.frombuffer(b"".join(batch[c].to_pylist()), dtype=np.uint16).reshape(batch.num_rows, -1)
                for c in ("s_a", "s_b")
            ]
            sizes = [np.asarray(batch[c]) for c in ("n_a", "n_b")]
            yield batch.select(["a", "b"]).filter(pa.array(_compatible(*signs, *sizes, percent)))

    return both.select("a", "b", "n_a", "n_b", "s_a", "s_b").mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, texts: DataFrame, text_col: str, n: int, percent: int) -> DataFrame:
    """Pairs whose full shingle sets reach the similarity."""
    both = pairs
    for c in ("a", "b"):
        both = both.join(texts.select(F.col("node").alias(c), F.col(text_col).alias(f"t_{c}")), c)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = tx.cache()
        for batch in batches:
            for low, high in tx.slices(batch["t_a"]):
                part = batch.slice(low, high - low)
                sets = []
                for c in ("t_a", "t_b"):
                    found = tx.split(part[c])
                    sets.append(tx.shingle_sets(found, found.hashes(cache, lower=True), n))
                good = []
                for x, y in zip(*sets):
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    good.append(100 * common >= percent * (len(x) + len(y) - common))
                yield part.select(["a", "b"]).filter(pa.array(good, type=pa.bool_()))

    return both.select("a", "b", "t_a", "t_b").mapInArrow(run, "a long, b long")


def _group_hits(
    label: np.ndarray, size: np.ndarray, signs: np.ndarray, number: int, side: np.ndarray, percent: int
) -> np.ndarray:
    """Which members of one group are in a compatible pair of different components whose first shared key is `number`.

    side: -1 in a whole group; in a pair of blocks, members of side 0 are compared with those of side 1."""
    hit = np.zeros(len(label), dtype=bool)
    names, inverse, count = np.unique(label, return_inverse=True, return_counts=True)
    if len(names) < 2:
        return hit
    if side[0] < 0:
        few, others = np.flatnonzero(inverse != np.argmax(count)), np.arange(len(label))
    else:
        few, others = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    for x in range(0, len(few), 64):
        for y in range(0, len(others), 4096):
            i, j = few[x : x + 64], others[y : y + 4096]
            ok = label[i, None] != label[None, j]
            ok &= 100 * np.minimum(size[i, None], size[None, j]) >= percent * np.maximum(size[i, None], size[None, j])
            p, q = np.nonzero(ok)
            p, q = i[p], j[q]
            same = signs[p] == signs[q]
            near = (~same).sum(axis=1) <= FAR * CHUNKS * WIDTH
            near[near] = _first_key(same[near]) == number
            hit[p[near]] = hit[q[near]] = True
    return hit


def _across(rows: DataFrame, percent: int) -> DataFrame:
    """Members (key, node, label) of groups that are in a compatible pair of different components there."""
    buckets = max(1, -(-rows.count() // 20_000))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("key", kind="stable")
        columns = ("key", "node", "label", "_n", "number", "side")
        key, node, label, size, number, side = (rows[c].to_numpy() for c in columns)
        signs = np.frombuffer(b"".join(rows["_sign"]), dtype=np.uint16).reshape(len(rows), -1)
        edges = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
        found = [np.zeros(0, dtype=np.int64)]
        for low, high in zip(edges[:-1], edges[1:]):
            g = slice(low, high)
            found.append(low + np.flatnonzero(_group_hits(label[g], size[g], signs[g], int(number[low]), side[g], percent)))
        at = np.concatenate(found)
        return pd.DataFrame({"key": key[at], "node": node[at], "label": label[at]}).drop_duplicates()

    bucket = F.pmod(F.xxhash64("key"), F.lit(buckets))
    rows = rows.withColumn("_bucket", bucket)
    return rows.groupBy("_bucket").applyInPandas(run, "key long, node long, label long")


def _links_across(members: DataFrame, texts: DataFrame, text_col: str, n: int, percent: int) -> DataFrame:
    """Confirmed links between members of a group that lie in different components.

    Each member outside the group's largest component is compared with all others at once, on full sets of
    shingles, inside the task; only links leave it."""
    buckets = max(1, -(-members.count() // 4_000))

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        node, label, key = (table[c].to_numpy() for c in ("node", "label", "key"))
        _, once, which = np.unique(node, return_index=True, return_inverse=True)
        cache, sets = tx.cache(), []
        texts = table[text_col].take(pa.array(once)).combine_chunks()
        for low, high in tx.slices(texts):
            found = tx.split(texts[low:high])
            sets += tx.shingle_sets(found, found.hashes(cache, lower=True), n)
        sizes = np.array([len(s) for s in sets])
        names, numbers = np.unique(np.concatenate(sets), return_inverse=True)
        numbers = np.split(numbers, np.cumsum(sizes)[:-1])
        mark = np.zeros(len(names), dtype=np.int32)
        order = np.argsort(key, kind="stable")
        edges = np.flatnonzero(np.r_[True, np.diff(key[order]) != 0, True])
        links = []
        for low, high in zip(edges[:-1], edges[1:]):
            group = order[low:high]
            kinds, inverse, count = np.unique(label[group], return_inverse=True, return_counts=True)
            own = which[group]
            flat, size = np.concatenate([numbers[w] for w in own]), sizes[own]
            start = np.cumsum(size) - size
            for x in np.flatnonzero(inverse != np.argmax(count)):
                mark[numbers[own[x]]] = 1
                common = np.add.reduceat(mark[flat], start)
                mark[numbers[own[x]]] = 0
                linked = 100 * common >= percent * (size + size[x] - common)
                for y in np.flatnonzero(linked & (inverse != inverse[x])):
                    links.append(sorted((int(node[group[x]]), int(node[group[y]]))))
        links = sorted({tuple(x) for x in links})
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    rows = members.join(texts, "node").withColumn("_bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    return rows.groupBy("_bucket").applyInArrow(run, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    percent: int = 80,
) -> DataFrame:
    """The documents' columns but the text, and n_shingles, component_id, kept.

    Words are lower-cased (A-Z) runs without white space; a document's set holds its distinct `shingle`-word
    shingles, or the whole sequence if it has fewer words. Documents are linked where
    100 * intersection >= percent * union. component_id is the smallest id that links lead to, kept tells
    whether it is the row's own id. NULL, empty and blank texts have an empty set: n_shingles 0, linked
    with nothing, their own component, kept. Equal texts are one class, compared once. A NULL id is never the
    smallest beside others; a class of NULL ids alone has a NULL component_id and is kept. Rows that repeat
    an id all stay, each classed by its own text. Input columns named like a result are replaced."""
    spark = ready(docs.sparkSession)
    rows = without(docs, "n_shingles", "component_id", "kept", "_n", "_print", "_sign", "_id", "node", "label")
    rows = rows.withColumn("_id", F.col(id_col))
    keep = [c for c in rows.columns if c not in (text_col, "_id")]
    read = stored(_read(rows, text_col, shingle, keep_text=False), "signatures")

    # one node for each distinct set; a set's rows are combined before the shuffle
    sets = read.where("_n > 0").groupBy("_print").agg(F.min("_id").alias("first"), F.max("_n").alias("_n"))
    signs = read.where("_n > 0").select("_print", "_sign").dropDuplicates(["_print"])
    reps = stored(
        sets.join(signs, "_print").withColumn("node", F.monotonically_increasing_id()), "distinct_sets"
    )

    index = _index(reps)
    groups = index.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = stored(index.join(groups.select("key"), "key"), "shared_keys")

    linked = shared.select("node").distinct()
    needed = linked.join(reps, "node").select("node", "_print", F.col("first"))
    source = _read(rows.select("_id", text_col), text_col, shingle, keep_text=True)
    same = (source["_print"] == needed["_print"]) & source["_id"].eqNullSafe(needed["first"])
    texts = stored(source.join(needed, same).select("node", text_col), "candidate_texts")

    links = labels = None
    here = shared.withColumn("label", F.col("node"))
    for turn in range(ROUNDS):
        order = F.struct(F.xxhash64("node", F.lit(turn)), F.col("node"), F.col("label"))
        hubs = _mixed(here).groupBy("key").agg(F.min(order).alias("hub"))
        star = here.join(hubs, "key").where(F.col("hub.label") != F.col("label"))
        star = star.select(F.least("hub.node", "node").alias("a"), F.greatest("hub.node", "node").alias("b")).distinct()
        more = stored(_confirmed(_near(star, reps, percent), texts, text_col, shingle, percent), "links")
        links = more if links is None else links.unionByName(more)
        labels = components(links)
        here = shared.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))

    apart = _mixed(here).join(reps.select("node", "_n", "_sign"), "node")
    apart = apart.withColumn("side", F.lit(-1)).select("key", "number", "node", "label", "_n", "_sign", "members", "side")
    apart = stored(apart, "apart")
    large = _deal(apart.where(F.col("members") > TOGETHER).drop("members"))
    rest = apart.where(F.col("members") <= TOGETHER).drop("members").unionByName(large)
    rest = stored(rest, "apart_again")
    members = stored(_across(rest, percent), "members_across")
    more = stored(_links_across(members, texts, text_col, shingle, percent), "links")
    labels = components(links.unionByName(more))

    classes = reps.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = classes.groupBy("label").agg(F.min("first").alias("component_id"))
    classes = stored(classes.join(least, "label").select("_print", "component_id"), "classes")
    forget(reps, shared, texts, apart, rest, members, links, more, labels)
    full = read.where("_n > 0").join(classes, "_print")
    empty = read.where("_n = 0").withColumn("component_id", F.col("_id"))
    out = full.select(*keep, "_id", F.col("_n").alias("n_shingles"), "component_id").unionByName(
        empty.select(*keep, "_id", F.col("_n").alias("n_shingles"), "component_id")
    )
    kept = F.col("_id").eqNullSafe(F.col("component_id"))
    return out.withColumn("kept", kept).drop("_id")


def _mixed(rows: DataFrame) -> DataFrame:
    """Rows of keys whose members lie in more than one component, with the number of members."""
    groups = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("members"), F.min("label").alias("low"), F.max("label").alias("high")
    )
    return rows.join(groups.where("low <> high").select("key", "members"), "key")
