import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronage.llm import decontaminate as dc
from patronage.llm import queries
from tests.llm.rows import documents, no_documents

SF_DIR = "/root/testdata/sf0.01"
HOW = dc.Settings()


def plain_alignment(a, b):
    best, rows = 0, [[0] * (len(b) + 1)]
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(max(0, rows[-1][j] + (2 if x == y else -1), rows[-1][j + 1] - 1, row[-1] - 1))
        best = max(best, *row)
        rows.append(row)
    return best


@pytest.mark.parametrize("seed", range(40))
def test_alignment_equals_the_plain_table(seed):
    rng = np.random.default_rng(seed)
    a, b = (rng.integers(0, 4, rng.integers(1, 25)) for _ in range(2))
    points, end = dc.align(a, b)
    assert points == plain_alignment(a.tolist(), b.tolist())
    assert points == plain_alignment(a.tolist(), b[:end].tolist())


def test_query_equals_alignment_of_all_pairs(spark):
    """Every document that holds a copy by aligning it with every item whole is found, with that score; nothing else is marked."""
    docs = [tuple(r) for r in queries.table(spark, SF_DIR, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in queries.table(spark, SF_DIR, "benchmark").select("item_id", "text").collect()]
    block = dc.block_of(items, HOW)
    want = {}
    for doc_id, text in docs:
        numbers = block.numbers(text)
        for item_id, piece in zip(block.items, block.pieces, strict=True):
            if np.isin(piece, numbers).mean() >= HOW.least_score:  # else no alignment reaches the points
                score = dc.align(piece, numbers)[0] / (2 * len(piece))
                if score >= HOW.least_score:
                    want[doc_id, item_id] = score
    rows = queries.op8_decontamination(spark, SF_DIR).filter("contaminated").collect()
    assert {(r.doc_id, r.item_id): r.score for r in rows} == want and len(want) > 10


def phrase(rng, n):
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


def run(spark, docs, items, how=None):
    bench = spark.createDataFrame(items, "item_id long, text string, score double") if items else spark.createDataFrame([], "item_id long, text string, score double")
    return [(r.doc_id, r.item_id, r.score, r.first_word, r.last_word, r.contaminated) for r in dc.contaminations(docs, bench, how).collect()]


def test_edited_copies_spans_and_blocks(spark):
    rng = random.Random(2)
    items = [phrase(rng, 40) for _ in range(6)]
    edited = list(items[1])
    for i in (7, 15, 23, 31):
        edited[i] = "other"
    del edited[35]
    edited.insert(20, "more")
    docs = documents(spark, [
        " ".join(phrase(rng, 30) + items[0] + phrase(rng, 30)), " ".join(phrase(rng, 500) + edited).upper(), " ".join(items[2][:8] + phrase(rng, 90)),
        " ".join(items[3] + phrase(rng, 5) + items[3]), None, "", " ".join(phrase(rng, 60_000) + items[4]),
    ]).withColumnRenamed("size", "item_id")
    bench = [(i, " ".join(words), 1.0) for i, words in enumerate(items)] + [(90, None, 1.0), (91, "", 1.0), (92, "two words", 1.0), (None, " ".join(items[0]), 1.0)]
    want = {(0, 0): (1.0, 30, 69, True), (0, None): (1.0, 30, 69, True), (3, 3): (1.0, 0, 39, True), (6, 4): (1.0, 60_000, 60_039, True)}
    for how in (HOW, dc.Settings(block_words=60)):
        got = {(d, i): row for d, i, *row in run(spark, docs, bench, how)}
        assert {k: tuple(v) for k, v in got.items() if k in want} == want
        score, first, last, marked = got[1, 1]
        assert 0.7 < score < 0.95 and marked and (first, last) == (500, 539)
        assert got[2, 2][0] < 0.3 and not got[2, 2][3] and set(got) == {*want, (1, 1), (2, 2)}


def test_long_items_are_aligned_in_pieces(spark):
    rng = random.Random(4)
    item = phrase(rng, 1000)
    docs = documents(spark, [" ".join(phrase(rng, 10) + item[400:600] + phrase(rng, 10))])
    assert max(score for _, _, score, *_ in run(spark, docs, [(1, " ".join(item), 0.0)])) == 1.0


def test_rarest_seed_of_every_window():
    rng = random.Random(6)
    text = " ".join(phrase(rng, 30))
    block = dc.block_of([(1, text)], HOW)
    frequency = np.array([rng.randrange(100) for _ in block.keys])
    seeds = dc.thinned(block, frequency, HOW)
    at = sorted(seeds.places[:, 1].tolist())
    assert all(b - a <= HOW.window for a, b in zip([-1, *at], [*at, 28], strict=True)) and 28 / 4 <= len(at) < 20
    least = int(block.keys[frequency.argmin()])
    assert least in seeds.keys


def test_common_passage_is_found_in_all_holders(spark):
    rng = random.Random(8)
    item = phrase(rng, 25)
    docs = documents(spark, [" ".join(item + phrase(rng, 20)) for _ in range(300)])
    assert sum(row[5] for row in run(spark, docs, [(1, " ".join(item), 0.0)])) == 300


def test_repeats_and_empty_tables(spark):
    item = " ".join(f"t{i}" for i in range(12))
    docs = documents(spark, [item]).unionAll(documents(spark, [item]))
    assert len(run(spark, docs, [(1, item, 0.0), (1, item, 0.0)])) == 4
    assert run(spark, docs, []) == [] and run(spark, no_documents(spark), [(1, item, 0.0)]) == []
    blocks = dc.seed_blocks(docs, spark.createDataFrame([(1, item)], "item_id long, text string"), HOW)
    assert [r.s for r in docs.select(dc.best_score(F.col("text"), blocks, HOW).alias("s")).collect()] == [1.0, 1.0]


@pytest.mark.parametrize("elsewhere", [0, 3])
def test_copy_edited_every_few_words_is_found(spark, elsewhere):
    """Every window of n-grams holds an edited word; the unedited passage stands in no other document, or in a few."""
    rng = random.Random(10)
    items = [phrase(rng, 40) for _ in range(8)]
    texts = []
    for item in items:
        edited, at = list(item), rng.randrange(2, 4)
        while at < len(edited):
            edited[at] = f"new{at}"
            at += rng.randrange(4, 7)
        texts.append(" ".join(phrase(rng, 20) + edited + phrase(rng, 20)))
    whole = [" ".join(item) for item in items for _ in range(elsewhere)]
    found = {(d, i) for d, i, *_, marked in run(spark, documents(spark, texts + whole), [(i, " ".join(item), 0.0) for i, item in enumerate(items)]) if marked}
    assert found == {(i, i) for i in range(8)} | {(8 + i, i // elsewhere) for i in range(len(whole))}


@pytest.mark.parametrize(("begin", "inside"), [(0, 120), (90, 110), (140, 120), (200, 120), (280, 120)])
def test_passage_over_a_border_of_pieces_is_found(spark, begin, inside):
    rng = random.Random(12)
    item = phrase(rng, 400)
    docs = documents(spark, [" ".join(phrase(rng, 30) + item[begin : begin + 120] + phrase(rng, 30))])
    rows = run(spark, docs, [(1, " ".join(item), 0.0)])
    best = max(rows, key=lambda row: row[2])
    assert best[2] == inside / 200 and best[4] - best[3] + 1 == inside and best[5]


def test_items_of_one_or_two_words_are_found_whole(spark):
    docs = spark.createDataFrame([(1, "so alpha beta it is"), (2, "alpha gamma beta"), (3, "Zulu!"), (4, None), (5, "beta alpha"), (6, "one two three four")], "doc_id long, text string")
    bench = spark.createDataFrame([(10, "Alpha beta."), (11, "zulu"), (12, "  "), (13, "one two three four")], "item_id long, text string")
    rows = {(r.doc_id, r.item_id): (r.score, r.first_word, r.last_word, r.contaminated) for r in dc.contaminations(docs, bench).collect()}
    assert rows == {(1, 10): (1.0, 1, 2, True), (3, 11): (1.0, 0, 0, True), (6, 13): (1.0, 0, 3, True)}


def test_of_equally_good_alignments_the_first_counts(spark):
    item = "red green blue white black"
    docs = spark.createDataFrame([(1, f"{item} " + "x " * 40 + item)], "doc_id long, text string")
    bench = spark.createDataFrame([(10, item)], "item_id long, text string")
    assert [(r.first_word, r.last_word) for r in dc.contaminations(docs, bench).collect()] == [(0, 4)]


def test_keys_of_any_number_of_words():
    numbers = np.array([5, 1 << 40, 7, -1, 3, 3, 3, 1 << 40, 7])
    keys, at = dc.keys_of(numbers, 2)
    assert at.tolist() == [0, 1, 4, 5, 6, 7] and keys[1] == keys[5] and keys[2] == keys[3] and len(set(keys.tolist())) == 4
    assert set(dc.keys_of(numbers, 1)[0].tolist()).isdisjoint(keys.tolist())
