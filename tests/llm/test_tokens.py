import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from growthlab.llm import tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("chunk,overlap", [(200, 20), (1 << 15, 256)])
def test_counts_are_those_of_the_library(spark, chunk, overlap):
    rnd = random.Random(1)
    odd = ["don't", "é à", "12 3", " ", "日本語", "<|endoftext|>", "\t\t", "it's", "'''s", " x", "\x1cq", "\n \n"]
    texts = [None, "", "a", "<|endoftext|> b " * 50, "x" * 5000, "  \n\n  " * 300, "ab " * 2000, "a\nb\n" * 1000]
    texts += [" ".join(rnd.choice(odd) for _ in range(900)) for _ in range(3)]
    rows = [(None if k == 0 else k % 4, t, 7) for k, t in enumerate(texts)]  # repeated and NULL ids
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    out = tokens.count_tokens(docs, PATH, limit=1000, chunk=chunk, overlap=overlap).collect()
    library = Tokenizer.from_file(PATH)
    want = sorted((len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False))) for t in texts)
    assert sorted((r.n_bytes, r.n_tokens) for r in out) == want
    assert all(r.over_limit == (r.n_tokens > 1000) for r in out)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert tokens.count_tokens(docs, PATH).count() == 0
