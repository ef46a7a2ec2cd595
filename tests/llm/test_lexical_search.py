import math
import re
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronage.llm import lexical_search as ls
from patronage.llm import queries
from tests.compare import assert_same, connect
from tests.llm.rows import documents, no_documents

HOW = ls.Settings()
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, best=10):
    """By the formulas, over (doc_id, text) and (item_id, text)."""
    counts = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    held = Counter(t for _, c in counts for t in c)
    n_docs, length = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    out = []
    for item_id, text in items:
        found = []
        for doc_id, c in counts:
            m = 25 + 75 * sum(c.values()) * n_docs // max(1, length)
            worth = lambda t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))  # noqa: B023, E731
            score = sum(worth(t) for t in terms(text) if t in c)
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, rank, None if no_id else doc_id, -score) for rank, (score, no_id, doc_id) in enumerate(sorted(found)[:best], 1)]
    return sorted(out, key=str)


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, doc_id string")


def result(docs, items, how=HOW):
    return sorted((tuple(r) for r in ls.search(docs, items, how).collect()), key=str)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    assert_same(queries.op12_lexical_search(spark, f"/root/testdata/{sf}"), connect(f"/root/testdata/{sf}"), queries.ORACLE["op12_lexical_search"])


@pytest.mark.parametrize("how", [ls.Settings(stages=1), ls.Settings(stages=3, bundle=7, block=50), ls.Settings(stages=6, pass_bytes=2000, best=3)])
def test_stages_bundles_blocks_and_passes_do_not_change_the_result(spark, how):
    docs, items = (queries.table(spark, "/root/testdata/sf0.001", name) for name in ("documents", "benchmark"))
    rows = [tuple(r) for r in items.collect()]
    assert result(docs.repartition(3), items, how) == brute([(r.doc_id, r.text) for r in docs.collect()], rows, how.best)


@pytest.mark.parametrize("how", [HOW, replace(HOW, block=2, bundle=1)])
def test_nulls_ties_repeats_long_and_empty(spark, how):
    texts = [None, "", " -- ", "Äpfel und BIRNEN", "äpfel und birnen", "same", "same", "same", "rare " * 60_000 + "same", "K kelvin sign", "same"] + ["same other"] * 12
    docs = documents(spark, texts).unionAll(documents(spark, ["same", "same"], first=5))
    docs = docs.unionAll(documents(spark, ["same"]).withColumn("doc_id", F.lit(None).cast("long")))
    items = [(0, "same"), (1, None), (2, ""), (3, "nowhere"), (4, "Äpfel äpfel"), (5, "same same rare"), (None, "k"), (7, "BIRNEN, K")]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(docs, items_of(spark, items), how) == brute(rows, items)
    # Of an item's repeated rows the greatest text counts.
    assert result(docs, items_of(spark, [(1, "rare"), (1, "same"), (1, "same"), (1, None)]), how) == brute(rows, [(1, "same")])
    assert result(docs, items_of(spark, []), how) == [] == result(no_documents(spark), items_of(spark, items), how)
    assert result(documents(spark, [None, ""]), items_of(spark, items), how) == []


def test_owners_share_the_postings_and_the_last_has_the_most_frequent():
    held = {term: term + 1 for term in range(100)}
    owner = ls.owners(held, 4)
    assert sorted(set(owner.values())) == [0, 1, 2, 3] and [owner[t] for t in range(100)] == sorted(owner.values())
    total = sum(held.values())
    assert 0.45 < sum(held[t] for t in held if owner[t] == 3) / total < 0.55
    assert set(ls.owners(held, 1).values()) == {0}


def test_impacts_are_exact_beyond_64_bits():
    got = ls.impacts(np.array([3, 1]), np.array([10**9, 5]), 10**12, 10**13)
    assert got.tolist() == [3 * 10**9 // (3000 + 8 * (25 + 75 * 10**9 // 10)), 10**9 // (1000 + 8 * (25 + 75 * 5 // 10))]
