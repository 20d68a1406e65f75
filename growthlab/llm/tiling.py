"""Benchmark decontamination by greedy string tiling.

Every run of `seed` tokens of a benchmark item is a seed. A document's tokens are looked up against the
seeds; for each (document, item) that shares one, running Karp-Rabin greedy string tiling marks the longest
common runs first, never a token twice, down to runs of `seed` tokens, in any order. An item counts as
leaked if the tiles cover enough of it, however its sentences were rearranged.

Seeds are sent to the executors in blocks of bounded size, one pass over the documents each; a benchmark of
any size takes more passes, not more memory."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthlab.llm import words as tx
from growthlab.llm.storage import ready

SEED = 5
COVERAGE = 0.5
#: benchmark tokens in one block
BLOCK = 1_000_000
_U = np.uint64
_PRIME = (1 << 61) - 1
_RADIX = 0x1F3D5B79
_NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def tiles(item: list[int], text: list[int], least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in the item, place in the text, length), longest first.

    Negative tokens match nothing. Windows of the current length are compared by rolling hashes and then
    token by token; all matches of the longest length are marked in the order of their places, and the free
    tokens are scanned again, with half the length once nothing of the current length is left."""
    item_free = [t >= 0 for t in item]
    text_free = [t >= 0 for t in text]
    out: list[tuple[int, int, int]] = []
    size = max(least, min(len(item), len(text)) // 2)
    while True:
        found = _scan(item, text, item_free, text_free, size)
        if not found:
            if size == least:
                return out
            size = max(least, size // 2)
            continue
        longest = max(n for _, _, n in found)
        for i, j, n in sorted(found):
            if n == longest and all(item_free[i : i + n]) and all(text_free[j : j + n]):
                item_free[i : i + n] = text_free[j : j + n] = [False] * n
                out.append((i, j, n))


def _windows(tokens: list[int], free: list[bool], size: int) -> Iterator[tuple[int, int]]:
    """(place, rolling hash) of the windows of free tokens."""
    top = pow(_RADIX, size - 1, _PRIME)
    value = run = 0
    for k, (t, ok) in enumerate(zip(tokens, free)):
        if not ok:
            value = run = 0
            continue
        if run >= size:
            value = (value - tokens[k - size] * top) % _PRIME
        value = (value * _RADIX + t) % _PRIME
        run += 1
        if run >= size:
            yield k - size + 1, value


def _scan(item: list[int], text: list[int], item_free: list, text_free: list, size: int) -> list[tuple]:
    """Maximal free matches of at least `size` tokens."""
    places = defaultdict(list)
    for i, h in _windows(item, item_free, size):
        places[h].append(i)
    found = []
    for j, h in _windows(text, text_free, size):
        for i in places.get(h, ()):
            if i and j and item_free[i - 1] and text_free[j - 1] and item[i - 1] == text[j - 1]:
                continue  # inside a match that began earlier
            n = 0
            while (
                i + n < len(item) and j + n < len(text)
                and item_free[i + n] and text_free[j + n] and item[i + n] == text[j + n]
            ):
                n += 1
            if n >= size:
                found.append((i, j, n))
    return found


class Block:
    """Some benchmark items, ready to be looked up."""

    def __init__(self, ids: list, texts: list, seed: int) -> None:
        found = tx.split(pa.array(texts, type=pa.string()), _NOT_ALNUM)
        hashes = found.hashes(tx.cache(), lower=True)
        self.seed, self.ids = seed, ids
        self.tokens = [hashes[a:b] for a, b in zip(found.first[:-1], found.first[1:])]
        self.seeds: dict[int, tuple[np.ndarray, list[np.ndarray]]] = {}
        for size in sorted({min(seed, len(t)) for t in self.tokens} - {0}):
            own = [k for k, t in enumerate(self.tokens) if min(seed, len(t)) == size]
            rolled = [grams(self.tokens[k], size) for k in own]
            owner = np.repeat(own, [len(r) for r in rolled])
            values, inverse = np.unique(np.concatenate(rolled), return_inverse=True)
            order = np.argsort(inverse, kind="stable")
            parts = np.split(owner[order], np.cumsum(np.bincount(inverse))[:-1])
            self.seeds[size] = (values, [np.unique(p) for p in parts])

    def leaks(self, texts: pa.Array, cache: tx._Powers, coverage: float) -> Iterator[tuple]:
        """(row, item number, covered tokens, tiles, longest tile) of items that texts cover enough."""
        found = tx.split(texts, _NOT_ALNUM)
        hashes = found.hashes(cache, lower=True)
        shared = defaultdict(list)  # (row, item) -> places of seeds in the text
        for size, (values, owners) in self.seeds.items():
            rolled = grams(hashes, size)
            if not len(rolled):
                continue
            at = np.minimum(np.searchsorted(values, rolled), len(values) - 1)
            hit = np.flatnonzero(values[at] == rolled)
            doc = np.searchsorted(found.first, hit, side="right") - 1
            inside = hit + size <= found.first[doc + 1]
            for place, row, value in zip(hit[inside].tolist(), doc[inside].tolist(), at[hit[inside]].tolist()):
                for k in owners[value].tolist():
                    shared[row, k].append(place)
        for (row, k), places in sorted(shared.items()):
            item = self.tokens[k]
            size = min(self.seed, len(item))
            most = len(np.unique(np.add.outer(places, np.arange(size))))
            if most < coverage * len(item):
                continue  # even all shared tokens together would not do
            got = tiles(*_numbered(item, hashes, places, size), size)
            covered = sum(n for _, _, n in got)
            if covered >= coverage * len(item):
                yield row, k, covered, len(got), max(n for _, _, n in got)


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    if len(hashes) < size:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(len(hashes) - size + 1, dtype=np.uint64)
    for k in range(size):
        out = tx.mix(out * _U(0x9E3779B97F4A7C15) + hashes[k : k + len(out)] + _U(k + 1))
    return out


def _numbered(item: np.ndarray, hashes: np.ndarray, places: list[int], size: int) -> tuple[list, list]:
    """Both sides as small numbers; of the text only the stretches that seeds cover, apart from each other."""
    text, gap, end = [], [], None
    for place in places:
        if end is None or place > end:
            text.append(hashes[:1])
            gap += [True]
            end = place
        text.append(hashes[end : place + size])
        gap += [False] * (place + size - end)
        end = place + size
    stretch = np.concatenate(text)
    names = np.unique(item)
    at = np.minimum(np.searchsorted(names, stretch), len(names) - 1)
    numbers = np.where(np.array(gap) | (names[at] != stretch), -1, at)
    return np.searchsorted(names, item).tolist(), numbers.tolist()


def _blocks(items: DataFrame, id_col: str, text_col: str, block: int) -> Iterator[tuple[list, list]]:
    """The benchmark in blocks of at most about `block` tokens, checked before each is collected."""
    items = items.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    items = items.withColumn("size", F.size(F.split("text", "[^\\p{Alnum}]+")).cast("long"))
    many = 1
    while True:
        part = F.pmod(F.xxhash64("id", "text"), F.lit(many))
        sizes = items.groupBy(part.alias("part")).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
        if many >= 1 << 20 or sizes.where((F.col("size") > block) & (F.col("n") > 1)).isEmpty():
            break
        many *= 2
    for k in range(many):
        rows = items.where(part == k).select("id", "text").collect()
        if rows:
            yield [r["id"] for r in rows], [r["text"] for r in rows]


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    seed: int = SEED,
    coverage: float = COVERAGE,
    block: int = BLOCK,
) -> DataFrame:
    """One row per document and benchmark item that it covers to at least `coverage`: the document's id, the
    item's id, covered and item_tokens (tokens), coverage, tiles, longest.

    Tokens are runs of letters and digits in lower case (A-Z). Items shorter than `seed` tokens must occur
    whole. NULL, empty and token-free texts or items match nothing. NULL ids are reported as they are;
    repeated documents and items are each matched for themselves. Other columns are ignored."""
    spark = ready(docs.sparkSession)
    id_type, item_type = docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    schema = (
        f"`{id_col}` {id_type}, `{item_col}` {item_type}, covered long, item_tokens long, "
        "coverage double, tiles long, longest long"
    )
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    out = spark.createDataFrame([], schema)
    for rows in _blocks(items, item_col, item_text, block):
        sent = spark.sparkContext.broadcast(rows)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            own, cache = Block(*sent.value, seed), tx.cache()
            names = [f.name for f in made]
            for batch in batches:
                for low, high in tx.slices(batch["_text"]):
                    part = batch.slice(low, high - low)
                    got = list(own.leaks(part["_text"], cache, coverage))
                    total = [len(own.tokens[r[1]]) for r in got]
                    columns = [
                        part["_id"].take(pa.array([r[0] for r in got], type=pa.int64())),
                        pa.array([own.ids[r[1]] for r in got], type=made.field(1).type),
                        pa.array([r[2] for r in got], pa.int64()),
                        pa.array(total, pa.int64()),
                        pa.array([r[2] / t for r, t in zip(got, total)], pa.float64()),
                        pa.array([r[3] for r in got], pa.int64()),
                        pa.array([r[4] for r in got], pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

        made = _arrow(out)
        out = out.unionByName(source.mapInArrow(run, schema))
    return out


def _arrow(df: DataFrame) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.schema)


def drop_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents, all columns as they are, without those that cover an item; see find_leaks."""
    ready(docs.sparkSession)
    seed, block = options.pop("seed", SEED), options.pop("block", BLOCK)
    coverage = options.pop("coverage", COVERAGE)
    item_col, item_text = options.pop("item_col", "item_id"), options.pop("item_text", "text")
    for rows in _blocks(items, item_col, item_text, block):
        sent = docs.sparkSession.sparkContext.broadcast(rows)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            own, cache = Block(*sent.value, seed), tx.cache()
            for batch in batches:
                for low, high in tx.slices(batch[text_col]):
                    part = batch.slice(low, high - low)
                    keep = np.ones(part.num_rows, dtype=bool)
                    keep[[r[0] for r in own.leaks(part[text_col], cache, coverage)]] = False
                    yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
