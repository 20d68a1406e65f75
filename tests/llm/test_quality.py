import math
import re
from collections import Counter

from pyspark.sql import functions as F

from growthlab.llm import quality
from tests.llm import plain


def measures(text):
    text = text or ""
    w = plain.words(text)
    windows = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
    seen, covered = Counter(windows), set()
    for k, x in enumerate(windows):
        if seen[x] > 1:
            covered.update(range(k, k + 5))
    lines = [s for s in text.split("\n") if plain.WORD.search(s)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_measures_and_verdicts(spark):
    good = "the quick brown fox jumps over the lazy dog and then some more words come"
    rows = [(k, f"{good} {k}", 1) for k in range(40)]
    rows += [(100 + k, "### $$$ buy now " * 5 + "%% && zzz qqq xxx " + str(k), 1) for k in range(10)]
    rows += [(200, None, 1), (201, "", 1), (202, "\n \t", 1), (203, "a b c d e a b c d e a b c d e", 1)]
    rows += [(204, "x y\nx y\n\nx y", 1), (205, "é ü ñ " * 8, 1), (None, f"{good} q", 1), (3, f"{good} 3", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept int")
    trusted = spark.createDataFrame([(k,) for k in range(30)] + [(None,), (3,)], "doc_id long")
    out = quality.quality_rules(docs, trusted).collect()
    texts = {i: t for i, t, _ in rows}
    assert len(out) == len(rows)
    for r in out:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == measures(texts[r.doc_id])
        assert r.base_failed == (got[0] < 10 or 100 * got[4] > 20 * got[0])
        assert r.kept == (not r.base_failed and r.score >= quality.LEAST_SCORE)
    verdicts = {r.doc_id: r for r in out}
    assert all(verdicts[k].kept for k in range(40)) and not any(verdicts[100 + k].kept for k in range(10))
    assert all(verdicts[100 + k].score < verdicts[0].score for k in range(10))


def test_real_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    out = quality.quality_rules(docs, labels.where("quality = 1 AND toxic = 0")).join(labels, "doc_id").collect()
    fine = [r for r in out if r.quality == 1 and r.toxic == 0 and not r.base_failed]
    assert sum(r.kept for r in fine) > 0.98 * len(fine)
    poor = [r for r in out if r.quality == 0]
    assert sum(r.kept for r in poor) < 0.1 * len(poor)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long")
    assert quality.quality_rules(docs.limit(0), none).count() == 0
    assert quality.quality_rules(docs, none).first().base_failed


def test_a_row_is_scored_by_the_other_rows(spark):
    texts = ["a b a b c a", "a b c d e", "f g f g f", "a", "", None, "a b a b c a"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    good = {0, 1, 3}
    out = quality.quality_rules(docs, spark.createDataFrame([(k,) for k in good], "doc_id long"))
    grams = {r.doc_id: Counter(r.b) for r in docs.select("doc_id", quality._buckets(quality.words(F.col("text"))).alias("b")).collect()}
    for r in out.collect():
        raw, fine = Counter(), Counter()
        for k in set(grams) - {r.doc_id}:
            raw.update(grams[k])
            fine.update(grams[k] if k in good else {})
        share = fine.total() / raw.total()
        own = grams[r.doc_id]
        want = sum(n * math.log((fine[b] + 1) / (raw[b] * share + 1)) for b, n in own.items()) / (own.total() + quality.NEUTRAL)
        assert math.isclose(r.score, want, abs_tol=1e-12)


def test_clean_rows_without_label_are_kept(spark):
    for size, most in (("sf0.001", 0.3), ("sf0.01", 0.1)):
        docs, labels = (spark.read.parquet(f"/root/testdata/{size}/{t}.parquet") for t in ("documents", "labels"))
        clean = labels.where("quality = 1 AND toxic = 0").withColumn("held", F.crc32(F.col("doc_id").cast("string")) % 5 == 0)
        out = quality.quality_rules(docs, clean.where("NOT held")).where("NOT base_failed").join(labels, "doc_id", "left")
        out = out.join(clean.where("held").select("doc_id", "held"), "doc_id", "left").collect()
        held = [r.kept for r in out if r.held]
        assert len(held) >= 10 and sum(held) >= 0.9 * len(held)
        poor = labels.where("quality = 0").count()
        assert sum(r.kept for r in out if r.quality == 0) <= most * poor


def test_every_trusted_row_counts(spark):
    """More trusted rows than any fixed number of them; good counts and the cut follow them all."""
    docs = spark.range(24_000).selectExpr("id AS doc_id", "concat('word', id % 100, ' other', id % 7, ' plain text of ten words and some more ', id) AS text")
    trusted = docs.select("doc_id").where("doc_id % 12 > 0")
    few = trusted.distinct().withColumn("_good", F.lit(1))
    counts = quality.bucket_counts(docs, few, "doc_id", "text")
    grams = docs.select("doc_id", F.explode(quality._buckets(quality.words(F.col("text")))).alias("bucket"))
    want = {r.bucket: (r.raw, r.good) for r in grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.count_if(F.col("doc_id") % 12 > 0).alias("good")).collect()}
    got = {r.bucket: (r.raw, r.good) for r in counts.where("raw > 0").collect()}
    assert got == want
    assert counts.select("goods").first().goods == grams.where("doc_id % 12 > 0").count()
    assert quality.quality_rules(docs, trusted).count() == 24_000


def test_null_ids_and_long_repeats(spark):
    rows = [(None, "a b c d e f g h i j k " * (k % 3 + 1)) for k in range(20)] + [(k, "p q r s p q r s t u v w x y z " + "p q r s " * k) for k in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = quality.quality_rules(docs, spark.createDataFrame([(1,), (2,), (None,)], "doc_id long")).collect()
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out)
    assert got == Counter((i, *measures(t)) for i, t in rows)
