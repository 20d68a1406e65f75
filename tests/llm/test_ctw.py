import numpy as np
from pyspark.sql import functions as F

from growthlab.llm import ctw
from tests.llm import plain


def held():
    return F.crc32(F.col("doc_id").cast("string")) % 7 == 2


def test_scores_against_the_recursion(spark):
    docs = [(k, f"The cat {k} sat on the mat. ÉtÉ été {k * k}\tthe end" + " of it" * (k % 3)) for k in range(12)]
    docs += [(50, None), (51, ""), (52, " \n")]
    rows = [(i, t, 1.5) for i, t in docs] + [(3, docs[3][1], 1.5)]  # a repeated row counts twice
    frame = spark.createDataFrame(rows, "doc_id long, text string, score double")
    want = plain.context_tree([(i, t) for i, t, _ in rows], 3)
    for size in (1 << 24, 300):  # one block, many blocks
        out = ctw.score_texts(frame, held(), depth=3, block_bytes=size).collect()
        assert len(out) == len(rows)
        for r in out:
            got = (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
            assert np.allclose(np.array(got, dtype=float), np.array(want[r.doc_id], dtype=float), atol=1e-8)
            coded = " ".join(plain.words(dict(docs)[r.doc_id], lower=True)).encode()
            assert r.n_bytes == len(coded) + 1 and np.isclose(r.bits_per_byte, -r.score / np.log10(2) / r.n_bytes)


def test_probabilities_of_next_bytes_add_up():
    grams = np.unique(np.random.default_rng(1).integers(0, 1 << 20, 400).astype(np.uint64) % (5 << 16))
    tree = ctw.Subtree(grams, np.arange(1, len(grams) + 1), 2, 0)
    after = (grams[7] >> np.uint64(8)) << np.uint64(8)
    every = after + np.arange(256, dtype=np.uint64)
    assert np.isclose((10 ** tree.log10(every, [])).sum(), 1.0)


def test_learns_held_out_text_better_than_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    out = ctw.score_texts(docs, held()).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert out[0] > 1.02 * out[1]  # both negative: at least nearly as good on little text ...
    assert out[0] < 0


def test_empty_table_and_no_training(spark):
    frame = spark.createDataFrame([(2, "ab")], "doc_id long, text string")
    assert ctw.score_texts(frame.limit(0), held()).count() == 0
    r = ctw.score_texts(frame, F.lit(True)).first()
    assert r.train_tokens == 0 and r.n_known == 0 and np.isclose(r.score, 3 * 8 * np.log10(0.5)) and r.base_score == 0
