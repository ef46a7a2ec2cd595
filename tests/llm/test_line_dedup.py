import hashlib
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronage.llm import line_dedup as ld
from patronage.llm import queries
from tests.compare import assert_same, connect
from tests.llm.rows import documents, no_documents

SF_DIR = "/root/testdata/sf0.01"
LINE = "The same line of more than forty code points, again"
HOW = ld.Settings()
#: No shard fits a budget of nothing, so probes travel.
WAYS = [HOW, replace(HOW, budget=-1, shard_lines=3, shard_probes=50, batch_bytes=500, batch_rows=3)]


def brute(rows, how=HOW):
    """(lines, dropped, kept text) by the wording of the rules, a row being a document."""
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    least = lambda doc_id: -(1 << 63) if doc_id is None else doc_id
    holders: dict[str, list[int]] = {}
    for doc_id, text in rows:
        for k in {key(line) for line in (text or "").split("\n")}:
            if len(k) >= how.least_chars:
                holders.setdefault(k, []).append(least(doc_id))
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if len(h := holders.get(key(x), [])) < how.least_documents or max(h) == least(doc_id)]
        out.append((doc_id, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out, key=str)


def result(docs, how=HOW):
    return sorted((tuple(r) for r in ld.dedup_lines(docs, how=how).collect()), key=str)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    assert_same(queries.op11_line_dedup(spark, f"/root/testdata/{sf}"), connect(f"/root/testdata/{sf}"), queries.ORACLE["op11_line_dedup"])


def test_both_ways_give_the_same_over_many_shards(spark):
    docs = queries.table(spark, SF_DIR, "documents")
    how = ld.Settings(least_chars=20, least_documents=2, shard_lines=20)
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(texts, how)
    assert sum(row[2] for row in want) > 100
    assert result(docs, how) == want
    assert result(docs.repartition(5), replace(how, budget=-1, batch_rows=37)) == want


@pytest.mark.parametrize("how", WAYS)
def test_nulls_repeats_long_and_empty(spark, how):
    texts = [None, "", "\n\n", LINE, f"  {LINE.upper()}\t\r\nend", f"{LINE}\n{LINE}\n", LINE + "!", f"a\n{LINE}\nb\x0b", "é" * 39 + "\n" + "é" * 40, LINE, "z\n" * 50_000 + LINE]
    texts += ["é" * 39 + "\n" + "é" * 40] * 4 + ["É" * 40]
    docs = documents(spark, texts).unionAll(documents(spark, [LINE, LINE], first=10)).withColumnRenamed("size", "n_dropped")
    docs = docs.unionAll(docs.where("doc_id = 3").withColumn("doc_id", F.lit(None).cast("long")))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = result(docs, how)
    assert got == brute(rows)
    assert sum(row[2] for row in got) > 10 and all(row[2] == 0 for row in got if row[0] == 14)
    assert result(no_documents(spark), how) == []
    assert result(documents(spark, ["short"]), how) == [(0, 1, 0, "short")]


def test_null_ids_alone_keep_their_lines(spark):
    docs = documents(spark, [LINE] * 6).withColumn("doc_id", F.lit(None).cast("long"))
    assert [r.n_dropped for r in ld.dedup_lines(docs).collect()] == [0] * 6


def test_hash_is_perfect_minimal_and_rejects_others():
    rng = np.random.default_rng(0)
    for size in (0, 1, 2, 1000, 20_000):
        found = rng.integers(0, 1 << 63, (size, 2), np.int64).astype("<u8")
        if size > 2:
            found[1, 0], found[2, 1] = found[0, 0], found[0, 1]  # one column alone does not tell them apart
        slots = ld.Slots.build(found)
        assert sorted(slots.slots(found).tolist()) == list(range(size))
        assert 64 * len(slots.words) <= 5 * size + 64 * len(slots.sizes)
        row = (0, 1, *ld._shard_row(found, np.arange(size), np.arange(size) * 7))
        documents, holders = ld.Index([row]).probe(found)
        assert documents.tolist() == list(range(size)) and holders.tolist() == [7 * i for i in range(size)]
        assert not ld.Index([row]).probe(rng.integers(0, 1 << 63, (1000, 2), np.int64).astype("<u8"))[0].any()


def test_kept_text_is_what_the_digest_is_of(spark):
    docs = queries.table(spark, "/root/testdata/sf0.001", "documents")
    texts = {r.doc_id: r.kept_text for r in ld.dedup_lines(docs).collect()}
    for r in queries.op11_line_dedup(spark, "/root/testdata/sf0.001").collect():
        assert r.kept_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
