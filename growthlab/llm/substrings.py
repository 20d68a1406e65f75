"""Removal of repeated word windows, found by FM-indexes over shards.

Windows of `length` words are dealt to shards by an anchor inside them, the smallest hashed gram, so all
occurrences of a window meet in one shard whatever text surrounds them, and no text is compared with
other shards. Neighbouring windows with the same anchor travel together as one segment. Only segments
whose anchor occurs twice or more are sent. A shard indexes its segments' words, streams them through the
index by backward search and keeps the windows whose earliest occurrence they are; every other window of
a sent segment is repeated. Equal texts (by a 126-bit hash) are indexed once, for their smallest id; the
others repeat it from end to end. Equal segments are combined before the shuffle; anchors with more than
`HOT` occurrences are dealt out window by window instead, so no shard gathers one anchor's contexts."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthlab.llm import words as tx
from growthlab.llm.fmindex import FMIndex
from growthlab.llm.storage import forget, ready, stored, without

GRAM = 6
HOT = 10_000
#: segments in a shard, about 25 words each
SHARD = 10_000
_U = np.uint64


#: a text's identity: two hashes of 63 bits as one number
PRINT = "decimal(38,0)"


def _fingerprint(text: Column) -> Column:
    half = lambda *x: F.shiftrightunsigned(F.xxhash64(*x), 1).cast(PRINT)
    return (half(text) * F.lit(1 << 62).cast("decimal(19,0)") * 2 + half(F.lit(1), text)).cast(PRINT)


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest value in each run of `width` values, the leftmost of equals."""
    at = np.arange(len(values))
    size = 1
    while size < width:
        step = min(size, width - size)
        a, b = at[: len(at) - step], at[step:]
        at = np.where(values[a] <= values[b], a, b)
        size += step
    return at


def anchors(words: tx.Words, hashes: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Segments of a slice of texts: document, first window, number of windows, anchor."""
    gram = min(GRAM, length)
    none = np.zeros(0, dtype=np.int64)
    if len(hashes) < length:
        return none, none, none, none
    rolled = np.zeros(len(hashes) - gram + 1, dtype=np.uint64)
    for k in range(gram):
        rolled = tx.mix(rolled * _U(0x9E3779B97F4A7C15) + hashes[k : k + len(rolled)] + _U(k + 1))
    at = _smallest(rolled, length - gram + 1)
    doc = words.doc()
    inside = doc[: len(at)] == doc[length - 1 :]
    window = np.flatnonzero(inside)
    at, doc = at[window], doc[window]
    if not len(window):
        return none, none, none, none
    new = np.r_[True, (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])]
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(window)))
    return doc[head], window[head] - words.first[doc[head]], count, rolled[at[head]].view(np.int64)


def _segments(rows: DataFrame, text_col: str, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, seen = tx.cache(), set()
        for batch in batches:
            prints = batch["_print"].to_pylist()
            fresh = [p not in seen and not seen.add(p) for p in prints]  # a task sends a text's segments once
            batch = batch.filter(pa.array(fresh, type=pa.bool_()))
            for low, high in tx.slices(batch[text_col]):
                part = batch.slice(low, high - low)
                found = tx.split(part[text_col])
                doc, start, count, anchor = anchors(found, found.hashes(cache), length)
                print_ = part["_print"].take(pa.array(doc, type=pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [print_, pa.array(anchor), pa.array(start, pa.int32()), pa.array(count, pa.int32())],
                    names=["_print", "anchor", "start", "windows"],
                )

    return rows.select("_print", text_col).mapInArrow(run, f"_print {PRINT}, anchor long, start int, windows int")


def _cut_out(joined: DataFrame, text_col: str, length: int, shards: int) -> DataFrame:
    """The segments' words, each distinct one of a batch once with its earliest place in the batch."""
    id_type = joined.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [("_id", "ascending"), ("_print", "ascending")]
            batch = batch.take(pc.sort_indices(batch.select(["_id", "_print"]), keys, null_placement="at_end"))
            marks = batch["marks"]
            owner = np.repeat(np.arange(batch.num_rows), pc.list_value_length(marks).to_numpy(zero_copy_only=False))
            flat = marks.flatten()
            start, many, anchor, hot = (np.asarray(flat.field(c)) for c in ("start", "windows", "anchor", "hot"))
            first: dict[bytes, tuple[int, int, int]] = {}
            row, words = -1, []
            texts = batch[text_col].cast(pa.binary())
            order = np.lexsort((start, owner))
            for o, at, n, a, h in zip(*(x[order].tolist() for x in (owner, start, many, anchor, hot))):
                if o != row:
                    row, words = o, texts[o].as_py().split()  # bytes split at the same six spaces
                if not h:
                    first.setdefault(b" ".join(words[at : at + n + length - 1]), (o, at, a % shards))
                else:  # a hot anchor's windows go one by one, each to a shard of its own choice
                    for k in range(at, at + n):
                        piece = b" ".join(words[k : k + length])
                        first.setdefault(piece, (o, k, zlib.crc32(piece) % shards))
            place = np.array(list(first.values()), dtype=np.int64).reshape(-1, 3)
            ids = batch.select(["_id", "_print"]).take(pa.array(place[:, 0]))
            yield pa.RecordBatch.from_arrays(
                [
                    *ids.columns,
                    pa.array(place[:, 2]),
                    pa.array(place[:, 1].astype(np.int32)),
                    pa.array(list(first), type=pa.binary()).cast(pa.string()),
                ],
                names=["_id", "_print", "shard", "start", "segment"],
            )

    return joined.mapInArrow(run, f"_id {id_type}, _print {PRINT}, shard long, start int, segment string")


def _symbols(segments: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers from 1, a 0 after each segment; where segments start and end."""
    lists = pc.split_pattern(segments, " ")
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    numbers = lists.flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
    size = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    end = np.cumsum(size + 1) - 1
    symbols = np.zeros(int(end[-1]) + 1, dtype=np.int64)
    inside = np.ones(len(symbols), dtype=bool)
    inside[end] = False
    symbols[inside] = numbers
    return symbols, end - size, end


def first_windows(table: pa.Table, length: int) -> pa.Table:
    """Of one shard's segments: the windows that are the earliest of their kind (_id, _print, at)."""
    ids = table.select(["_id", "_print"]).to_pandas(types_mapper=pd.ArrowDtype)
    order = ids.drop_duplicates().sort_values(["_id", "_print"], na_position="last", ignore_index=True)
    order["rank"] = np.arange(len(order))
    rank = ids.merge(order, on=["_id", "_print"], how="left")["rank"].to_numpy(dtype=np.int64)
    symbols, begin, end = _symbols(table["segment"])
    index = FMIndex(symbols, length)
    row = index.matches(symbols, begin, end)
    owner = np.repeat(np.arange(len(begin)), end - begin + 1)
    place = np.asarray(table["start"]).astype(np.int64)[owner] + np.arange(len(symbols)) - begin[owner]
    when = (rank[owner] << 32) + place
    starts = np.flatnonzero(np.r_[True, index.group[1:] != index.group[:-1]])
    earliest = np.minimum.reduceat(when[index.order], starts)
    at = np.flatnonzero(row >= 0)
    at = at[earliest[index.group[row[at]]] == when[at]]
    # the same place may come from several segments
    _, once = np.unique(when[at], return_index=True)
    at = at[once]
    out = table.select(["_id", "_print"]).take(pa.array(owner[at]))
    return out.append_column("at", pa.array(place[at].astype(np.int32)))


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 20,
    hot: int = HOT,
    shard: int = SHARD,
) -> DataFrame:
    """The documents with the kept words, one space between them, as text, and n_words, n_removed.

    A word goes if a window of `length` words that covers it also starts earlier: in a smaller id, or
    earlier in the same document. Windows are judged on the input. NULL and empty texts become empty; texts
    shorter than a window keep all words. NULL ids come last, and count as one id. Rows with equal id and text
    count as one document and all come back; rows with equal id and other texts are ordered by a hash of the text.
    Input columns named like a result are replaced."""
    spark = ready(docs.sparkSession)
    rows = without(docs, "n_words", "n_removed", "_id", "_print", "marks", "firsts", "copy")
    names = rows.columns
    id_type = rows.schema[id_col].dataType.simpleString()
    rows = rows.withColumn("_id", F.col(id_col)).withColumn("_print", _fingerprint(F.coalesce(text_col, F.lit(""))))

    # equal texts have equal segments: distinct (text, place) pairs tell whether an anchor comes again
    segments = _segments(rows, text_col, length)
    several = "min_p <> max_p OR min_s <> max_s"
    often = segments.groupBy("anchor").agg(
        F.min("_print").alias("min_p"), F.max("_print").alias("max_p"),
        F.min("start").alias("min_s"), F.max("start").alias("max_s"), F.count(F.lit(1)).alias("times"),
    ).where(several).select("anchor", (F.col("times") > hot).alias("hot"))
    marks = segments.join(often, "anchor").select("_print", F.struct("start", "windows", "anchor", "hot").alias("mark"))
    marks = marks.groupBy("_print").agg(F.collect_set("mark").alias("marks"))
    texts = rows.select("_id", "_print").distinct()
    owner = texts.groupBy("_print").agg(F.min(F.struct(F.col("_id").isNull().alias("n"), "_id"))["_id"].alias("_own"))
    marks = stored(marks.join(owner, "_print").select(F.col("_own").alias("_id"), "_print", "marks"), "marked_texts")
    many = marks.agg(F.coalesce(F.sum(F.size("marks")), F.lit(0))).first()[0]
    shards = max(1, -(-many // shard))

    def same(left: str, right: str) -> Column:
        return F.col(f"{left}._id").eqNullSafe(F.col(f"{right}._id")) & (F.col(f"{left}._print") == F.col(f"{right}._print"))

    source = rows.select("_id", "_print", text_col).alias("l").join(marks.alias("r"), same("l", "r"))
    pieces = _cut_out(source.select("l._id", "l._print", text_col, "marks"), text_col, length, shards)
    first = pieces.groupBy("shard").applyInArrow(
        lambda table: first_windows(table, length), f"_id {id_type}, _print {PRINT}, at int"
    )
    first = first.groupBy("_id", "_print").agg(F.collect_list("at").alias("firsts"))
    spans = F.transform("marks", lambda m: F.struct(m["start"].alias("start"), m["windows"].alias("windows")))
    found = marks.select("_id", "_print", spans.alias("marks")).alias("m").join(first.alias("f"), same("m", "f"), "left")
    found = stored(found.select("m._id", "m._print", "marks", "firsts"), "first_windows")
    forget(marks)
    copies = texts.join(owner, "_print").where(~F.col("_id").eqNullSafe(F.col("_own")))
    empty = {c: F.lit(None).cast(t) for c, t in found.dtypes if c in ("marks", "firsts")}
    verdict = found.withColumn("copy", F.lit(False)).unionByName(
        copies.select("_id", "_print").withColumns(empty).withColumn("copy", F.lit(True))
    )
    joined = rows.alias("d").join(verdict.alias("v"), same("d", "v"), "left")
    joined = joined.select("d.*", "marks", "firsts", "copy").drop("_id", "_print")
    return _kept(joined, names, text_col, length)


def _kept(joined: DataFrame, names: list[str], text_col: str, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in tx.slices(batch[text_col]):
                part = batch.slice(low, high - low)
                found = tx.split(part[text_col])
                repeated = np.zeros(len(found.start) + 1, dtype=np.int32)
                for d, (marks, firsts) in enumerate(zip(part["marks"].to_pylist(), part["firsts"].to_pylist())):
                    if marks:
                        base = found.first[d]
                        for m in marks:
                            repeated[base + m["start"] : base + m["start"] + m["windows"]] = 1
                        repeated[base + np.array(firsts or [], dtype=np.int64)] = 0
                # a window covers the words from its start on; windows never leave their document
                ahead = np.concatenate([[0], np.cumsum(repeated[:-1], dtype=np.int64)])
                back = np.maximum(np.arange(len(found.start)) - length + 1, 0)
                gone = (ahead[1:] - ahead[back]) > 0
                words_in = np.diff(found.first)
                copy = pc.fill_null(part["copy"], False).to_numpy(zero_copy_only=False) & (words_in >= length)
                gone |= np.repeat(copy, words_in)
                data = np.where(tx._GAP[found.data], np.uint8(0x20), found.data)
                # a kept word takes the one byte behind it along, unless its document ends there
                stop = np.minimum(found.end + 1, found.offsets[1:][found.doc()])[~gone]
                edge = np.zeros(len(data) + 1, dtype=np.int8)
                edge[found.start[~gone]] += 1
                edge[stop] -= 1
                keep = np.cumsum(edge[:-1], dtype=np.int8) > 0
                texts = []
                for a, b in zip(found.offsets[:-1], found.offsets[1:]):
                    texts.append(data[a:b][keep[a:b]].tobytes().strip(b" ").decode())
                total = np.concatenate([[0], np.cumsum(gone)])
                removed = total[found.first[1:]] - total[found.first[:-1]]
                out = {c: part[c] for c in names}
                out[text_col] = pa.array(texts, type=pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*out.values(), pa.array(words_in, pa.int64()), pa.array(removed, pa.int64())],
                    names=[*out, "n_words", "n_removed"],
                )

    fields = ", ".join(f"`{c}` {t}" for c, t in joined.dtypes if c in names)
    return joined.mapInArrow(run, f"{fields}, n_words long, n_removed long")
