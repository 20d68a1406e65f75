"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions; each decision has a node for every context length up to `depth` bytes,
with a Krichevsky-Trofimov estimate from the training counts. A node's weighted probability is half its
estimate and half the product of its longer contexts' weighted probabilities; a decision's prediction mixes
all depths with the resulting weights. Counts come from the training texts alone and are frozen before
texts are scored.

Texts are dealt to blocks. A block sends its distinct (context, byte) grams and words, once each, to
shards; a shard sums all blocks' counts, builds the subtrees below the two latest context bytes and answers
each block with its grams' log-probabilities and its words' counts. Only the two topmost levels, at most
256 * 255 nodes, pass through the driver. Blocks and shards grow in number with the corpus, not in size."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthlab.llm import words as tx
from growthlab.llm.storage import ready, stored, without

DEPTH = 5
BLOCK_BYTES = 24 << 20
END = 0xFF  # never occurs in UTF-8: the padding before a text and the mark after it
GRAMS, WORDS = 0, 1
_U = np.uint64
_END_WORD = np.array([0x1F83D9ABFB41BD6B], dtype=np.uint64)
_PAYLOAD = "_block long, kind int, shard long, keys binary, counts binary"


# --- a block's grams and words -------------------------------------------------------------------


@dataclass
class Slice:
    """Of some texts: every predicted byte's gram and every token's hash, and how many each text has."""

    grams: np.ndarray
    n_grams: np.ndarray
    tokens: np.ndarray
    n_tokens: np.ndarray


def _slice(texts: pa.Array, cache: tx._Powers, depth: int) -> Slice:
    """Texts are taken as their words in lower case (A-Z), one space between, and the end mark."""
    found = tx.split(texts)
    n = len(texts)
    doc = found.doc()
    # keep words and the one byte behind each but the last of a text, as a space
    last = np.zeros(len(doc), dtype=bool)
    last[found.first[1:][np.diff(found.first) > 0] - 1] = True
    edge = np.zeros(len(found.data) + 1, dtype=np.int8)
    edge[found.start] += 1
    edge[found.end + ~last] -= 1
    keep = np.cumsum(edge[:-1], dtype=np.int8) > 0
    data = tx._LOWER[found.data]
    data[tx._GAP[found.data]] = 0x20
    size = (found.end - found.start) + ~last
    length = np.bincount(doc, weights=size, minlength=n).astype(np.int64)
    head = np.cumsum(length + depth + 1) - (length + 1)  # where each text's first byte goes
    stream = np.full(int((length + depth + 1).sum()), END, dtype=np.uint8)
    begin = np.cumsum(length) - length
    place = np.arange(int(length.sum())) + np.repeat(head - begin, length)
    stream[place] = data[keep]
    grams = np.zeros(len(stream) - depth, dtype=np.uint64)
    for k in range(depth + 1):
        grams = (grams << _U(8)) | stream[k : k + len(grams)]
    wanted = np.ones(len(stream), dtype=bool)
    wanted[(head[:, None] - depth + np.arange(depth)[None, :]).reshape(-1)] = False
    tokens = np.empty(len(doc) + n, dtype=np.uint64)
    ends = found.first[1:] + np.arange(n)
    is_word = np.ones(len(tokens), dtype=bool)
    is_word[ends] = False
    tokens[is_word] = found.hashes(cache, lower=True)
    tokens[ends] = _END_WORD
    return Slice(grams[wanted[depth:]], length + 1, tokens, np.diff(found.first) + 1)


def _shard_of(kind: int, keys: np.ndarray, shards: int) -> np.ndarray:
    """Words by their hash; grams by their two latest context bytes, so that a subtree stays together."""
    if kind == GRAMS:
        keys = tx.mix((keys >> _U(8)) & _U(0xFFFF))
    return (keys % _U(shards)).astype(np.int64)


def _pieces(batch: pa.Table, text_col: str, depth: int) -> Iterator[tuple[int, int, Slice]]:
    cache = tx.cache()
    texts = batch[text_col].combine_chunks() if isinstance(batch[text_col], pa.ChunkedArray) else batch[text_col]
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks)
    for low, high in tx.slices(texts):
        yield low, high, _slice(texts[low:high], cache, depth)


class Counter:
    """Sums per key over slices."""

    def __init__(self) -> None:
        self.keys, self.sums = [], []

    def add(self, keys: np.ndarray, weights: np.ndarray) -> None:
        codes, names = pd.factorize(keys)
        self.keys.append(names)
        self.sums.append(np.bincount(codes, weights=weights, minlength=len(names)))

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        codes, names = pd.factorize(np.concatenate(self.keys))
        sums = np.bincount(codes, weights=np.concatenate(self.sums), minlength=len(names))
        order = np.argsort(names)
        return names[order], sums[order].astype(np.int64)


def _block_counts(table: pa.Table, text_col: str, depth: int, shards: int) -> pa.Table:
    held = table["_held"].to_numpy()
    counters = (Counter(), Counter())
    for low, high, s in _pieces(table, text_col, depth):
        train = ~held[low:high]
        counters[GRAMS].add(s.grams, np.repeat(train, s.n_grams).astype(np.float64))
        counters[WORDS].add(s.tokens, np.repeat(train, s.n_tokens).astype(np.float64))
    out = {"kind": [], "shard": [], "keys": [], "counts": []}
    for kind, counter in enumerate(counters):
        keys, counts = counter.total()
        shard = _shard_of(kind, keys, shards)
        for s in np.unique(shard):
            own = shard == s
            out["kind"].append(kind)
            out["shard"].append(int(s))
            out["keys"].append(keys[own].tobytes())
            out["counts"].append(counts[own].astype(np.uint32).tobytes())  # a block is far below 2**32 bytes
    block = table["_block"][0].as_py()
    return pa.table(
        {
            "_block": pa.array([block] * len(out["kind"]), pa.int64()),
            "kind": pa.array(out["kind"], pa.int32()),
            "shard": pa.array(out["shard"], pa.int64()),
            "keys": pa.array(out["keys"], pa.binary()),
            "counts": pa.array(out["counts"], pa.binary()),
        }
    )


# --- a shard's part of the tree ------------------------------------------------------------------


def _merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    counter = Counter()
    for keys, counts in zip(table["keys"].to_pylist(), table["counts"].to_pylist()):
        counter.keys.append(np.frombuffer(keys, dtype=np.uint64))
        counter.sums.append(np.frombuffer(counts, dtype=np.uint32))
    return counter.total()


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return _lgamma(zeros + 0.5) + _lgamma(ones + 0.5) - _lgamma(zeros + ones + 1.0) - math.log(math.pi)


def _lgamma(x: np.ndarray) -> np.ndarray:
    """Log-gamma for x > 0: Stirling's series above a shift by ten."""
    x = np.asarray(x, dtype=np.float64)
    shift = np.zeros_like(x)
    small = x < 10
    y = x.copy()
    for _ in range(10):
        shift[small] += np.log(y[small])
        y[small] += 1.0
        small = small & (y < 10)
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - shift


def _nodes(grams: np.ndarray, depth: int, bit: int) -> np.ndarray:
    """Node (context of `depth` bytes, bits so far with a leading 1) of the grams' decision number `bit`."""
    context = (grams >> _U(8)) & _U((1 << (8 * depth)) - 1)
    byte = grams & _U(0xFF)
    return (context << _U(8)) | _U(1 << bit) | (byte >> _U(8 - bit))


class Subtree:
    """Nodes at depths `top`..`depth` over all training grams of a shard."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, depth: int, top: int) -> None:
        self.depth, self.top = depth, top
        seen = counts > 0
        grams, counts = grams[seen], counts[seen]
        self.level: dict[int, tuple[np.ndarray, ...]] = {}
        below = None
        for d in range(depth, top - 1, -1):
            keys = np.concatenate([_nodes(grams, d, k) for k in range(8)])
            ones = np.concatenate([(grams >> _U(7 - k)) & _U(1) for k in range(8)]).astype(np.float64)
            weight = np.tile(counts.astype(np.float64), 8)
            names, inverse = np.unique(keys, return_inverse=True)
            b = np.bincount(inverse, weights=weight * ones, minlength=len(names))
            a = np.bincount(inverse, weights=weight, minlength=len(names)) - b
            estimate = log_kt(a, b)
            if below is None:
                children, weighted = np.zeros(len(names)), estimate
            else:
                parent = _drop_oldest(below[0], d)
                children = np.bincount(np.searchsorted(names, parent), weights=below[1], minlength=len(names))
                weighted = np.logaddexp(estimate, children) - math.log(2)
            self.level[d] = (names, a, b, estimate - children)
            below = (names, weighted)
        self.roots = (*self.level[top][:3], below[1]) if below else ()

    def log10(self, grams: np.ndarray, above: list[tuple[np.ndarray, ...]]) -> np.ndarray:
        """Log10 probability of each gram's byte after its context; `above`: levels 0.. of the whole tree."""
        total = np.zeros(len(grams))
        for bit in range(8):
            one = ((grams >> _U(7 - bit)) & _U(1)).astype(bool)
            p = None
            for d in range(self.depth, -1, -1):
                names, a, b, lead = self.level[d] if d >= self.top else above[d]
                a, b, lead = _found(names, _nodes(grams, d, bit), a, b, lead)
                own = (np.where(one, b, a) + 0.5) / (a + b + 1.0)
                if p is None:
                    p = own
                else:
                    share = 1.0 / (1.0 + np.exp(-np.clip(lead, -700, 700)))  # of the node's own estimate
                    p = share * own + (1.0 - share) * p
            total += np.log10(p)
        return total


def _drop_oldest(nodes: np.ndarray, depth: int) -> np.ndarray:
    return nodes & _U((1 << (8 * (depth + 1))) - 1)


def _found(names: np.ndarray, wanted: np.ndarray, *columns: np.ndarray) -> list[np.ndarray]:
    """Columns of the wanted nodes, 0 where a node has no training count."""
    if not len(names):
        return [np.zeros(len(wanted)) for _ in columns]
    at = np.minimum(np.searchsorted(names, wanted), len(names) - 1)
    known = names[at] == wanted
    return [np.where(known, c[at], 0.0) for c in columns]


def _summary(table: pa.Table, depth: int, top: int) -> pa.Table:
    """Of a shard: the nodes at depth `top`, or the numbers of training tokens and distinct words."""
    keys, counts = _merged(table)
    kind = table["kind"][0].as_py()
    if kind == WORDS:
        rows = ([-1], [float(counts.sum())], [float((counts > 0).sum())], [0.0])
    else:
        names, a, b, weighted = Subtree(keys, counts, depth, top).roots
        # summed by the next shorter context, the level that the driver continues from
        parent = _drop_oldest(names, top - 1) if top else names
        group, inverse = np.unique(parent, return_inverse=True)
        rows = (group.astype(np.int64), *[np.bincount(inverse, weights=x, minlength=len(group)) for x in (a, b, weighted)])
    return pa.table({n: pa.array(x, t) for n, x, t in zip(("node", "a", "b", "w"), rows, (pa.int64(), *[pa.float64()] * 3))})


def _top_levels(rows: list, top: int) -> list[tuple[np.ndarray, ...]]:
    """Levels top - 1 .. 0 from the sums below level top - 1: (names, a, b, log odds of own estimate)."""
    names = np.array([r["node"] for r in rows], dtype=np.uint64)
    a, b, children = (np.array([r[c] for r in rows], dtype=np.float64) for c in ("a", "b", "w"))
    order = np.argsort(names)
    names, a, b, children = names[order], a[order], b[order], children[order]
    levels = []
    for d in range(top - 1, -1, -1):
        estimate = log_kt(a, b)
        levels.insert(0, (names, a, b, estimate - children))
        weighted = np.logaddexp(estimate, children) - math.log(2)
        if d:
            parent, inverse = np.unique(_drop_oldest(names, d - 1), return_inverse=True)
            a, b, children = (np.bincount(inverse, weights=x, minlength=len(parent)) for x in (a, b, weighted))
            names = parent
    return levels


def _answers(table: pa.Table, depth: int, top: int, above: list) -> pa.Table:
    """For each block's keys in a shard: log10 probabilities of grams, training counts of words."""
    keys, counts = _merged(table)
    kind = table["kind"][0].as_py()
    values = counts.astype(np.float64) if kind == WORDS else Subtree(keys, counts, depth, top).log10(keys, above)
    out = [values[np.searchsorted(keys, np.frombuffer(k, dtype=np.uint64))].tobytes() for k in table["keys"].to_pylist()]
    return table.select(["_block", "kind", "shard"]).append_column("values", pa.array(out, pa.binary()))


# --- scores --------------------------------------------------------------------------------------


def _aligned(kind: int, names: list[np.ndarray], answers: pa.Table, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """A block's distinct keys, sorted, with the shards' values, which come in the order they were sent."""
    keys = np.unique(np.concatenate([np.zeros(0, np.uint64), *names]))
    values, shard = np.zeros(len(keys)), _shard_of(kind, keys, shards)
    own = answers.filter(pc.equal(answers["kind"], kind))
    for s, got in zip(own["shard"].to_pylist(), own["values"].to_pylist()):
        values[shard == s] = np.frombuffer(got, dtype=np.float64)
    return keys, values


def _block_scores(
    table: pa.Table, answers: pa.Table, text_col: str, depth: int, shards: int, n: float, v: float
) -> pa.Table:
    pieces = []
    for _, _, s in _pieces(table, text_col, depth):
        coded = [pd.factorize(x) for x in (s.grams, s.tokens)]
        pieces.append((s.n_grams, s.n_tokens, *[(codes.astype(np.int32), names) for codes, names in coded]))
    known = [_aligned(kind, [p[2 + kind][1] for p in pieces], answers, shards) for kind in (GRAMS, WORDS)]
    look = lambda kind, names: known[kind][1][np.searchsorted(known[kind][0], names)]
    columns: dict[str, list] = {c: [] for c in ("n_tokens", "n_known", "base_score", "score", "n_bytes")}
    for n_grams, n_tokens, grams, tokens in pieces:
        per_byte = look(GRAMS, grams[1])[grams[0]]
        count = look(WORDS, tokens[1])[tokens[0]]
        base = np.log10(count + 1.0) - math.log10(n + v + 1.0)
        for name, values, sizes in (
            ("n_tokens", np.ones(len(count)), n_tokens),
            ("n_known", (count > 0).astype(np.float64), n_tokens),
            ("base_score", base, n_tokens),
            ("score", per_byte, n_grams),
        ):
            columns[name].append(np.add.reduceat(values, np.cumsum(sizes) - sizes))
        columns["n_bytes"].append(np.asarray(n_grams))
    out = table.drop_columns([text_col, "_block"])
    for name, parts in columns.items():
        kind = pa.int64() if name.startswith("n_") else pa.float64()
        values = np.concatenate(parts)
        out = out.append_column(name, pa.array(values.astype(np.int64) if name.startswith("n_") else values, kind))
    return out


def score_texts(
    docs: DataFrame,
    held_out: Column,
    text_col: str = "text",
    depth: int = DEPTH,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The documents' columns but the text, and held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes,
    bits_per_byte: the bytes that are coded (words, a space between them, the end mark) and their code length.

    A text is its words in lower case (A-Z) and an end. score: log10 probability of these words, one space
    between, byte by byte, and of the end mark. base_score: the same words and end under word counts with
    one added. Both learn from the rows where held_out is not true (NULL counts as false). NULL and empty
    texts are an end alone. Without training rows every bit has probability 1/2. Repeated rows count each time.
    Input columns named like a result are replaced. `depth` is at most 7 bytes, at least 2."""
    if not 2 <= depth <= 7:
        raise ValueError("depth must be between 2 and 7 bytes")
    ready(docs.sparkSession)
    top = 2
    rows = docs.withColumn("_held", F.coalesce(held_out, F.lit(False)))
    rows = without(rows, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte", "_block")
    size = rows.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    shards = max(1, blocks // 2)
    spread = F.xxhash64(*[c for c, t in rows.dtypes if not t.startswith("map")])
    rows = rows.withColumn("_block", F.pmod(spread, F.lit(blocks)))

    counts = rows.select("_block", "_held", text_col).groupBy("_block")
    counts = counts.applyInArrow(lambda t: _block_counts(t, text_col, depth, shards), _PAYLOAD)
    counts = stored(counts, "block_counts")
    summary = counts.groupBy("kind", "shard").applyInArrow(
        lambda t: _summary(t, depth, top), "node long, a double, b double, w double"
    )
    # at most 256 * 255 nodes and one row of totals
    summary = summary.groupBy("node").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("w").alias("w")).collect()
    n, v = next(((r["a"], r["b"]) for r in summary if r["node"] == -1), (0.0, 0.0))
    above = _top_levels([r for r in summary if r["node"] >= 0], top)
    answers = counts.groupBy("kind", "shard").applyInArrow(
        lambda t: _answers(t, depth, top, above), "_block long, kind int, shard long, values binary"
    )
    fields = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes if c not in (text_col, "_block"))
    scored = rows.groupBy("_block").cogroup(answers.groupBy("_block")).applyInArrow(
        lambda t, a: _block_scores(t, a, text_col, depth, shards, n, v),
        f"{fields}, n_tokens long, n_known long, base_score double, score double, n_bytes long",
    )
    made = ("n_tokens", "n_known", "base_score", "score", "n_bytes")
    names = [c for c in scored.columns if c != "_held" and c not in made]
    bits = -F.col("score") * math.log2(10) / F.col("n_bytes")
    return scored.select(
        *names, F.col("_held").alias("held_out"), "n_tokens", "n_known",
        F.lit(int(n)).cast("long").alias("train_tokens"), "base_score", "score", "n_bytes", bits.alias("bits_per_byte"),
    )
