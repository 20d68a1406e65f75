"""Quality rules: a log-likelihood ratio of hashed n-grams, and counts of repeated and odd text.

The trusted target and the raw corpus are two multinomials over hashed words and word pairs. A document's
score is the mean log-ratio of its n-grams' buckets, as counted in all other rows: its own counts are taken
out of both, so that labelled and unlabelled rows are scored alike. With few n-grams it is drawn towards 0 by
a fixed number of neutral ones. Only DataFrame functions: texts are split, hashed, summed per bucket map-side,
and scored by joining the bucket table, whose size is the fixed number of buckets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthlab.llm.storage import ready, stored
from growthlab.operators.ordered import exact_quantiles

GAPS = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
BUCKETS = 1 << 16
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
NEUTRAL = 20
LEAST_SCORE = -0.12
#: share of the trusted rows that may score below the cut; it is lowered until no more do
LOST = 0.01


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAPS), "")


def _bound(value: Column, use) -> Column:
    """use(value) with value computed once per row."""
    return F.element_at(F.transform(F.array(value), use), 1)


#: distinct repeated windows up to which each window is looked up among them; beyond it all are sorted with their places
FEW = 32


def repeated_words(h: Column, two: Column, n: int = 5) -> Column:
    """Words inside n-word windows that the text holds at least twice; n is 5.

    Windows are compared by a 64-bit hash, made of the words' hashes (`h`) in steps of 2 (`two`), 4 and 5 words. Windows of five
    are only made in texts with repeated ones of four, places only looked for in texts that have repeats; the cost of any
    text grows as n log n."""

    def windows(four: Column) -> Column:
        five = F.transform(four, lambda x, i: F.xxhash64(x, F.get(h, i + 4)))
        return F.slice(five, F.lit(1), F.size(h) - n + 1)

    def sorted_places(hashes: Column) -> Column:
        marked = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        same = lambda s, x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"])
        starts = _bound(
            F.sort_array(marked),
            lambda s: F.transform(F.filter(s, lambda x, k: F.coalesce(same(s, x, k), F.lit(False))), lambda x: x["i"]),
        )
        return F.sort_array(starts)

    def looked_up(hashes: Column, more: Column) -> Column:
        at = F.transform(hashes, lambda h, i: F.when(F.array_contains(more, h), i))
        return F.filter(at, lambda i: i.isNotNull())

    def covered(hashes: Column) -> Column:
        again = _bound(
            F.sort_array(hashes),
            lambda s: F.array_distinct(F.filter(s, lambda x, k: F.coalesce(F.get(s, k - 1) == x, F.lit(False)))),
        )
        starts = _bound(again, lambda d: F.when(F.size(d) <= FEW, looked_up(hashes, d)).otherwise(sorted_places(hashes)))
        return _bound(
            starts,
            lambda a: F.aggregate(
                F.transform(a, lambda x, k: F.least(F.coalesce(F.get(a, k + 1) - x, F.lit(n)), F.lit(n))),
                F.lit(0).cast("long"),
                lambda total, x: total + x,
            ),
        )

    none = F.lit(0).cast("long")
    repeats = lambda x: F.size(F.array_distinct(x)) < F.size(x)
    in_windows = lambda four: _bound(windows(four), lambda x: F.when(repeats(x), covered(x)).otherwise(none))
    four = F.transform(two, lambda x, i: F.xxhash64(x, F.get(two, i + 2)))
    return F.when(
        F.size(h) > n, _bound(four, lambda x: F.when(repeats(x), in_windows(x)).otherwise(none))
    ).otherwise(none)


def _measures(text: Column, tokens: Column, h: Column, two: Column) -> dict[str, Column]:
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda s: F.regexp_like(s, F.lit(r"[^\x20\x09-\x0D]")))
    without = reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), SYMBOLS, text)
    return {
        "n_words": F.size(tokens).cast("long"),
        "word_chars": F.char_length(F.array_join(tokens, "")).cast("long"),
        "n_symbols": (F.octet_length(text) - F.octet_length(without)).cast("long"),
        "n_dup_lines": _bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeated_words(h, two),
    }


def _hashes(tokens: Column) -> Column:
    return F.transform(tokens, lambda x: F.xxhash64(x))


def _pairs(h: Column) -> Column:
    """Hashes of each word and the next; the last one's is not of a pair."""
    return F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + 1)))


def _grams(h: Column, two: Column) -> Column:
    """Hashes of a text's words and word pairs."""
    return F.concat(h, F.slice(two, F.lit(1), F.greatest(F.size(h) - 1, F.lit(0))))


def _buckets(tokens: Column) -> Column:
    """Buckets of a text's words and word pairs."""
    return _bound(_hashes(tokens), lambda h: _bound(_pairs(h), lambda two: F.transform(_grams(h, two), _bucket)))


def _hashed(docs: DataFrame, text_col: str) -> DataFrame:
    """With _words, their hashes _h and those of pairs, _two; columns of their own, which Spark computes once."""
    rows = docs.withColumn("_words", words(F.col(text_col)))
    rows = rows.withColumn("_h", _hashes(F.col("_words")))
    return rows.withColumn("_two", _pairs(F.col("_h")))


def _bucket(gram: Column) -> Column:
    return gram.bitwiseAND(F.lit(BUCKETS - 1).cast("long")).cast("int")


def bucket_counts(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """bucket, raw and good (its n-grams in all rows and in those of `trusted` ids), raws and goods (their sums).

    Ids meet in a shuffled hash join, as the trusted ones grow with the corpus; rows of NULL ids are dealt by their length."""
    spread = F.when(F.col(id_col).isNull(), F.coalesce(F.octet_length(text_col), F.lit(0))).otherwise(0)
    few = trusted.withColumn("_spread", F.lit(0)).hint("shuffle_hash")
    marked = docs.select(id_col, text_col, spread.alias("_spread")).join(few, [id_col, "_spread"], "left")
    grams = _hashed(marked, text_col).select("_good", F.explode(_grams(F.col("_h"), F.col("_two"))).alias("_gram"))
    seen = grams.groupBy(_bucket(F.col("_gram")).alias("bucket")).agg(F.count(F.lit(1)).alias("raw"), F.count("_good").alias("good"))
    every = docs.sparkSession.range(BUCKETS, numPartitions=1).select(F.col("id").cast("int").alias("bucket"))
    table = every.join(F.broadcast(seen), "bucket", "left").fillna(0, ["raw", "good"])
    total = table.agg(F.sum("raw").alias("raws"), F.sum("good").alias("goods"))
    return stored(table.join(F.broadcast(total)), "bucket_counts")


def _scored(docs: DataFrame, counts: DataFrame, columns: list[str], text_col: str) -> DataFrame:
    """The columns and measures of every row, and its score as a row that is not trusted (_plain) and as one that is (_own):
    texts need not meet the trusted ids a second time."""
    rows = _hashed(docs.withColumn("_row", F.monotonically_increasing_id()), text_col)
    measures = _measures(F.col(text_col), F.col("_words"), F.col("_h"), F.col("_two"))
    in_order = F.sort_array(F.transform(_grams(F.col("_h"), F.col("_two")), _bucket))
    rows = rows.select("_row", *columns, *[v.alias(k) for k, v in measures.items()], in_order.alias("_b"))
    # the last place of each distinct bucket; those before it since the last place of the one before are its own
    places = F.slice(F.sequence(F.lit(0), F.size("_b")), F.lit(1), F.size("_b"))
    last = F.filter(places, lambda i: ~F.get("_b", i).eqNullSafe(F.get("_b", i + 1)))
    rows = rows.withColumn("_last", last)
    rows = rows.select("_row", *columns, *measures, "_b", "_last", F.posexplode_outer("_last").alias("_k", "_at"))
    own = F.col("_at") - F.coalesce(F.get("_last", F.col("_k") - 1), F.lit(-1))
    grams = rows.select(
        "_row", *columns, *measures, F.size("_b").alias("_n"), F.get("_b", "_at").alias("bucket"), own.alias("own")
    ).join(F.broadcast(counts), "bucket", "left")
    others = F.nullif(F.col("raws") - F.col("_n"), F.lit(0))

    def score(good: Column, goods: Column) -> Column:
        expected = (F.col("raw") - F.col("own")) * F.coalesce(goods / others, F.lit(0.0))
        summed = F.coalesce(F.sum(F.col("own") * F.log((good + 1) / (expected + 1))), F.lit(0.0))
        return summed / (F.max("_n") + NEUTRAL)

    return grams.groupBy("_row", *columns).agg(
        *[F.max(c).alias(c) for c in measures],
        score(F.col("good"), F.col("goods")).alias("_plain"),
        score(F.col("good") - F.col("own"), F.col("goods") - F.col("_n")).alias("_own"),
    ).drop("_row")


def quality_rules(
    docs: DataFrame,
    trusted: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_score: float = LEAST_SCORE,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: its id, the columns to `carry`, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, score, kept.

    `trusted` names the ids of the trusted target; all of them are used, counts of the raw corpus cover every row, and a
    row is scored with the counts of all other rows. Without trusted rows every score is 0.
    base_failed: under 10 words, or over 20 % of words in repeated 5-word windows. kept: not base_failed and score >=
    least_score, or >= the score that all but LOST of the trusted rows which pass the base rules reach, if that is
    lower: in a small or diverse corpus the scores of clean rows spread. NULL, empty and blank texts have zero
    counts, score 0 and fail; NULL ids and repeated rows are rows like others; other columns are ignored."""
    ready(docs.sparkSession)
    few = trusted.select(id_col).where(F.col(id_col).isNotNull()).distinct()
    few = stored(few.withColumn("_good", F.lit(1)), "trusted")
    counts = bucket_counts(docs, few, id_col, text_col)
    both = _scored(docs.select(id_col, *carry, text_col), counts, [id_col, *carry], text_col).join(few, id_col, "left")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    score = F.when(F.col("_good") == 1, F.col("_own")).otherwise(F.col("_plain"))
    both = both.withColumns({"base_failed": failed, "score": score}).drop("_own", "_plain")
    # written, a few numbers a row: the cut is read off the same scores that it is applied to
    scored = stored(both, "quality_scores")
    judges = scored.where(F.col("_good").isNotNull() & ~F.col("base_failed")).select(F.lit(0).alias("_all"), "score")
    reached = exact_quantiles(judges, ["_all"], "score", [LOST])
    cut = stored(reached.agg(F.max(F.get("quantiles", F.lit(0))).alias("_reached")), "cut")
    enough = F.col("score") >= F.least(F.lit(least_score), F.col("_reached"))
    judged = scored.join(F.broadcast(cut)).withColumn("kept", ~F.col("base_failed") & enough)
    return judged.select(id_col, *carry, *MEASURES, "base_failed", "score", "kept")
