import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronage.llm import near_dup as nd
from patronage.llm import queries
from patronage.llm.common import LOWER, WORD
from tests.llm.rows import documents, no_documents

HOW = nd.Settings()


def shingle_set(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def brute(texts, percent=85):
    """doc_id to (n_shingles, component) by comparing all sets that share a shingle."""
    sets = {i: shingle_set(t) for i, t in texts.items()}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    shared = defaultdict(int)
    for ids in holders.values():
        for n, a in enumerate(ids):
            for b in ids[:n]:
                shared[a, b] += 1
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            ra, rb = sorted((find(a), find(b)))
            root[rb] = ra
    return {i: (len(sets[i]), find(i)) for i in texts}


def check(spark, texts, how=None):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in nd.near_duplicates(docs, how).collect()}
    assert got == {i: (n, c, c == i) for i, (n, c) in brute(texts).items()}
    return got


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()}
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in queries.op1_minhash_near_dedup(spark, sf_dir).collect()}
    assert got == {i: (n, c, c == i) for i, (n, c) in brute(texts).items()}
    assert sum(not kept for _, _, kept in got.values()) > 50


def test_chains_and_large_groups_with_blocks(spark):
    """Copies drift away from each other, so most pairs of a bucket are links only through others; buckets exceed blocks."""
    rng, texts = random.Random(5), {}
    base = [f"w{rng.randrange(5000)}" for _ in range(150)]
    for i in range(120):
        texts[1000 - i] = " ".join(base)
        base[rng.randrange(150)] = f"x{i}"
    other = [f"v{i}" for i in range(200)]
    for i in range(150):
        copy = list(other)
        for _ in range(rng.randrange(6)):
            copy[rng.randrange(200)] = f"y{rng.randrange(10**6)}"
        texts[2000 + i] = " ".join(copy)
    got = check(spark, texts, nd.Settings(block=16))
    assert len({c for _, c, _ in got.values()}) < 60


def test_short_null_blank_case_and_repeats(spark):
    texts = {1: None, 2: "", 3: " \t\n\x0b\x0c\r ", 4: "One", 5: "oNE ", 6: "a b c", 7: "A\tb\nC", 8: "a b", 9: "É x", 10: "é x", 11: "a\x1cb c", 12: "\xa0",
             13: "z " * 3000, 14: "z " * 50, 15: " ".join(f"q{i}" for i in range(20_000))}
    got = check(spark, texts)
    assert got[5][1] == 4 and got[7][1] == 6 and got[14][1] == 13 and got[2] == (0, 2, True) and got[10][1] == 10 and got[8][1] == 8


def test_repeated_and_nameless_rows_and_clashing_columns(spark):
    docs = documents(spark, ["a b c d e f", "k l m n o p", "a b c d e f"]).withColumnsRenamed({"size": "digest", "slot": "id", "shard": "node", "part": "key"})
    docs = docs.unionAll(docs.limit(1)).unionAll(docs.filter("doc_id = 2").withColumn("doc_id", F.lit(None).cast("long")))
    docs = docs.unionAll(docs.filter("doc_id = 1").withColumns({"doc_id": F.lit(None).cast("long"), "text": F.lit("only here")}))
    rows = sorted((r.component_id is None, r.component_id or 0, r.doc_id is None, r.doc_id or 0, r.kept) for r in nd.near_duplicates(docs).collect())
    assert rows == [
        (False, 0, False, 0, True), (False, 0, False, 0, True), (False, 0, False, 2, False), (False, 0, True, 0, False),
        (False, 1, False, 1, True), (True, 0, True, 0, True),
    ]
    assert nd.near_duplicates(no_documents(spark)).count() == 0


def test_sketches_merge():
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 1 << 63, (2, 5000), np.uint64)
    union = nd.registers(np.unique(np.concatenate([a, b])), HOW)
    assert (union == np.maximum(nd.registers(a, HOW), nd.registers(b, HOW))).all()
    assert not nd.registers(a[:0], HOW).any() and union.max() <= HOW.top + 1


@pytest.mark.parametrize("similarity", [0.2, 0.5, 0.85, 0.95])
def test_joint_estimate(similarity):
    rng = np.random.default_rng(3)
    a, b, sizes = [], [], []
    for _ in range(60):
        n, m = 400, int(rng.integers(300, 400))
        shared = round(similarity * (n + m) / (1 + similarity))
        shared = min(shared, m)
        keys = rng.integers(0, 1 << 63, n + m - shared, np.uint64)
        a.append(nd.registers(keys[:n], HOW))
        b.append(nd.registers(keys[n - shared :], HOW))
        sizes.append((n, m, shared / (n + m - shared)))
    n, m, truth = np.array(sizes).T
    error = nd.likeliest(np.stack(a), np.stack(b), n, m, HOW) - truth
    assert abs(error.mean()) < 0.015 and error.std() < 0.045 and np.abs(error).max() < HOW.slack


def test_components_of_a_long_path(spark):
    pairs = [(i, i + 1) for i in range(1, 60)] + [(100, 7), (200, 201), (201, 201)]
    random.Random(0).shuffle(pairs)
    got = {r.node: r.root for r in nd.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(2, 61)} | {100: 1, 201: 200}
    assert nd.components(spark.createDataFrame([], "a long, b long")).count() == 0
