from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from patronage.llm import bpe, queries
from patronage.llm import token_counts as tc
from tests.llm.rows import documents, no_documents

PATH = public_tokenizers.path("byte_bpe_50k.json")


def brute(lengths):
    n, total = len(lengths), sum(lengths)
    out = {}
    for limit, docs in Counter(lengths).items():
        longer = [x for x in lengths if x > limit]
        out[limit] = (docs, len(longer), sum(longer), n, total, sum(min(x, limit) for x in lengths), (n - len(longer)) / n)
    return out


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    library = Tokenizer.from_file(PATH)
    texts = [r.text or "" for r in queries.table(spark, sf_dir, "documents").select("text").collect()]
    want = brute([len(library.encode(t, add_special_tokens=False).ids) for t in texts])
    rows = queries.op4_token_counts(spark, sf_dir).collect()
    assert {r.context_limit: tuple(r)[1:] for r in rows} == want and len(rows) == len(want)


LENGTHS = [0, 0, 1, 5, 5, 5, 1023, 1024, 1025, 5000, 4096, 4095, 1_000_000]


def answers(spark, lengths):
    return tc.suffix_sums(tc.length_histogram(spark.createDataFrame([(x,) for x in lengths], "n_tokens long")))


def test_blocks_and_ties(spark):
    assert {r.context_limit: tuple(r)[1:] for r in answers(spark, LENGTHS).collect()} == brute(LENGTHS)


def test_any_limit_and_quantiles(spark):
    limits = [0, 2, 5, 1024, 3000, 999_999, 1_000_000, 5_000_000]
    for r in tc.at_limits(answers(spark, LENGTHS), limits).collect():
        longer = [x for x in LENGTHS if x > r.context_limit]
        assert (r.docs_longer, r.tokens_longer, r.truncated_total) == (len(longer), sum(longer), sum(min(x, r.context_limit) for x in LENGTHS))
    shares = [0.0, 0.1, 0.5, 0.9, 1.0]
    for r in tc.quantile_length(answers(spark, LENGTHS), shares).collect():
        assert r.n_tokens == min(x for x in LENGTHS if sum(y <= x for y in LENGTHS) / len(LENGTHS) >= r.share)


def test_groups_null_and_empty(spark):
    rows = [("a", 3), ("a", 2000), (None, 3), (None, 3)]
    by = tc.suffix_sums(tc.length_histogram(spark.createDataFrame(rows, "source string, n_tokens long"), ("source",)), ("source",))
    assert {(r.source, r.context_limit): r.truncated_total for r in by.filter("source is not null").collect()} == {("a", 3): 6, ("a", 2000): 2003}
    assert answers(spark, []).count() == 0
    assert [(r.docs_longer, r.truncated_total) for r in tc.at_limits(answers(spark, []), [7]).collect()] == [(0, 0)]
    counted = bpe.count_tokens(documents(spark, [None, "", "a b"]), PATH).collect()
    assert sorted(r.n_tokens for r in counted) == [0, 0, 2]
    assert bpe.count_tokens(no_documents(spark), PATH).count() == 0


def test_groups_of_any_name_but_the_answers(spark):
    rows = [("a", None, 3), ("a", None, 5), ("b", 1, 2000), ("b", 1, 3), (None, 2, 7)]
    lengths = spark.createDataFrame(rows, "block string, tokens int, n_tokens long")
    by = ("block", "tokens")
    answers = tc.suffix_sums(tc.length_histogram(lengths, by), by).collect()
    got = {(r.block, r.tokens, r.context_limit): (r.docs_longer, r.tokens_longer, r.docs_total, r.tokens_total) for r in answers}
    assert got == {
        ("a", None, 3): (1, 5, 2, 8),
        ("a", None, 5): (0, 0, 2, 8),
        ("b", 1, 3): (1, 2000, 2, 2003),
        ("b", 1, 2000): (0, 0, 2, 2003),
        (None, 2, 7): (0, 0, 1, 7),
    }
    for name in ("docs_total", "N_DOCS", "_block"):
        with pytest.raises(ValueError, match="cannot be named"):
            tc.suffix_sums(lengths.withColumnRenamed("block", name), (name,))


def test_every_row_is_counted_null_long_and_repeated(spark):
    docs = documents(spark, [None, "", "word", "word", "long " * 200_000])
    counts = sorted(r.n_tokens for r in bpe.count_tokens(docs, queries.vocabulary_file(queries.BYTE_BPE)).collect())
    assert counts[:4] == [0, 0, 1, 1] and counts[4] >= 200_000 and len(counts) == 5
    assert bpe.count_tokens(no_documents(spark), queries.vocabulary_file(queries.BYTE_BPE)).count() == 0
