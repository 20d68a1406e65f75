"""Token counts of whole texts, huge ones by overlapping chunks.

A text longer than a chunk is cut into overlapping chunks, which are encoded apart (and on different
executors) with offsets. Two neighbours are spliced at a boundary that both encodings have inside their
overlap and that is proven stable: a token ends after a non-space character and the next character is
a space. No alternative of the byte-level pre-tokenising pattern runs from a non-space character into
white space, the pattern never looks behind, and special strings hold no space, so the full encoding has
that boundary too and both sides are encoded as in the whole text. Where an overlap has no such boundary
(text without spaces), the text is cut again with chunks and overlaps four times as wide, at last in one.
Shorter texts are cut at all their stable boundaries, so that a task encodes each distinct piece once.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from growthlab.llm.storage import ready, stored, without

CHUNK = 1 << 15
OVERLAP = 256
WIDEN = 4

#: units remembered within a task
UNITS = 500_000
#: white space, then other characters: units end where a non-space character meets ASCII white space
_UNIT = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
#: characters that some libraries take for white space and others do not, or that are space but not ASCII
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]")

_SPACE = re.compile(f"[ \\t-\\r]|{_ODD_SPACE.pattern}")

_EDGES = "array<struct<at: long, rank: long>>"


def _encoder(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task owns one core
    from tokenizers import Tokenizer, pre_tokenizers, processors

    made = Tokenizer.from_file(path)
    made.no_padding()
    made.no_truncation()
    if isinstance(made.pre_tokenizer, pre_tokenizers.ByteLevel):
        made.post_processor = processors.ByteLevel(trim_offsets=False)  # offsets only; ids stay
    return made


def _by_unit(texts: list[str], made, known: dict[str, int]) -> list[int]:
    """Token counts of texts cut at every stable boundary; each distinct unit is encoded once."""
    if len(known) > UNITS:
        known.clear()
    units = [[t] if _ODD_SPACE.search(t) else _UNIT.findall(t) for t in texts]
    new = list(set().union(*units).difference(known))
    known.update(zip(new, map(len, made.encode_batch_fast(new, add_special_tokens=False))))
    return [sum(map(known.__getitem__, u)) for u in units]


def _cut(size: int, chunk: int, overlap: int) -> list[tuple[int, int]]:
    """Character ranges: neighbours share 2 * overlap characters around each multiple of the chunk."""
    n = max(1, -(-size // chunk))
    return [(max(0, k * chunk - overlap), min(size, (k + 1) * chunk + overlap)) for k in range(n)]


def _edges(text: str, base: int, ends: np.ndarray, low: int, high: int) -> list[dict]:
    """Stable boundaries of an encoded chunk in [low, high): position in the whole text, tokens before."""
    out = []
    for at in range(max(low, base + 1), min(high, base + len(text))):
        if text[at - base] == " " and not _SPACE.match(text[at - base - 1]):
            rank = int(np.searchsorted(ends, at - base, side="right"))
            if rank and ends[rank - 1] == at - base:
                out.append({"at": at, "rank": rank})
    return out


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 1024,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """The documents' columns but the text, and n_bytes, n_tokens, over_limit.

    NULL and empty texts have 0 bytes and 0 tokens. Rows are counted one by one, so repeated ids and
    ties keep all their rows; a NULL id is an id like any other. Input columns named like a result
    are replaced. Special strings count as the tokenizer's file says; none is added."""
    spark = ready(docs.sparkSession)
    rows = without(docs, "n_bytes", "n_tokens", "over_limit", "_row", "_size")
    keep = [c for c in rows.columns if c != text_col]
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = rows.withColumn(text_col, text).withColumn("n_bytes", F.octet_length(F.col(text_col)).cast("long"))

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, known = _encoder(tokenizer_path), {}
        for batch in batches:
            counts = pa.array(_by_unit(batch[text_col].to_pylist(), made, known), type=pa.int64())
            yield batch.drop_columns([text_col]).append_column("n_tokens", counts)

    is_huge = F.char_length(F.col(text_col)) > chunk
    kept = rows.select(*keep, "n_bytes", text_col)
    fields = ", ".join(f"`{c}` {t}" for c, t in kept.dtypes if c != text_col)
    short = kept.where(~is_huge).mapInArrow(plain, f"{fields}, n_tokens long")
    # a row number of its own, fixed by writing it, tells repeated ids apart
    huge = stored(kept.where(is_huge).withColumn("_row", F.monotonically_increasing_id()), "huge_texts")
    done = None
    todo = huge.select("_row", text_col)
    while True:
        counted, left = _spliced(todo, tokenizer_path, text_col, chunk, overlap)
        done = counted if done is None else done.unionByName(counted)
        if left.isEmpty():
            break
        chunk, overlap = chunk * WIDEN, overlap * WIDEN
        todo = huge.select("_row", text_col).join(left, "_row", "left_semi")
    long = huge.select(*keep, "n_bytes", "_row").join(done, "_row").drop("_row")
    out = short.unionByName(long)
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def _spliced(
    todo: DataFrame, path: str, text_col: str, chunk: int, overlap: int
) -> tuple[DataFrame, DataFrame]:
    """Token counts of the texts whose chunks all splice, and the rows of the others."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row, text in zip(batch["_row"], batch[text_col]):
                parts = _cut(len(text), chunk, overlap)
                yield pd.DataFrame(
                    [(row, k, len(parts), low, text[low:high]) for k, (low, high) in enumerate(parts)],
                    columns=["_row", "k", "n", "base", "part"],
                )

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = _encoder(path)
        for batch in batches:
            out = []
            for x in batch.itertuples(index=False):
                got = made.encode(x.part, add_special_tokens=False)
                ends = np.array([e for _, e in got.offsets], dtype=np.int64)
                first, last = x.k * chunk, (x.k + 1) * chunk
                left = _edges(x.part, x.base, ends, first - overlap, first + overlap) if x.k else []
                right = _edges(x.part, x.base, ends, last - overlap, last + overlap) if x.k < x.n - 1 else []
                out.append((x[0], x.k, x.n, len(ends), left, right))
            yield pd.DataFrame(out, columns=["_row", "k", "n", "tokens", "left", "right"])

    parts = todo.mapInPandas(cut, "_row long, k long, n long, base long, part string")
    parts = parts.repartition("_row", "k")  # a huge text's chunks spread over the cluster
    coded = parts.mapInPandas(
        encode, f"_row long, k long, n long, tokens long, left {_EDGES}, right {_EDGES}"
    )
    ahead = W.partitionBy("_row").orderBy("k")
    joint = coded.withColumn("next", F.lead("left").over(ahead))
    # the first boundary that both neighbours have; ranks tell the tokens before it in each encoding
    shared = F.filter(
        F.col("right"), lambda r: F.exists(F.col("next"), lambda s: s["at"] == r["at"])
    )
    joint = joint.withColumn("cut", F.try_element_at(shared, F.lit(1)))
    joint = joint.withColumn(
        "skip",
        F.try_element_at(
            F.filter(F.col("next"), lambda s: s["at"] == F.col("cut")["at"]), F.lit(1)
        )["rank"],
    )
    last = F.col("k") == F.col("n") - 1
    joint = joint.withColumn("bad", ~last & F.col("cut").isNull())
    joint = joint.withColumn("own", F.when(last, F.col("tokens")).otherwise(F.col("cut")["rank"]))
    joint = joint.withColumn("own", F.col("own") - F.coalesce(F.lag("skip").over(ahead), F.lit(0)))
    summed = stored(
        joint.groupBy("_row").agg(F.sum("own").alias("n_tokens"), F.max("bad").alias("bad")), "spliced"
    )
    return summed.where(~F.col("bad")).select("_row", "n_tokens"), summed.where("bad").select("_row")
