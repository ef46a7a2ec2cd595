import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from patronage.llm import decontaminate, quality, queries, toxicity
from tests.llm.rows import documents
from tests.llm.test_near_dup import brute

SF_DIR = "/root/testdata/sf0.001"


def test_stages_equal_plain_loops(spark):
    """Each stage on what the one before kept, by the trained models and brute force."""
    docs = queries.table(spark, SF_DIR, "documents")
    labels = queries.table(spark, SF_DIR, "labels")
    texts = {r.doc_id: r.text for r in docs.collect()}
    frame = lambda: docs.filter(F.col("doc_id").isin(list(texts)))

    score = toxicity.train(docs, labels).scorer()
    texts = {i: t for i, t in texts.items() if score(t or "") < 0.5}
    field = quality.train(frame(), labels)
    measured = {i: quality.measure(t or "") for i, t in texts.items()}
    texts = {i: t for i, t in texts.items() if not measured[i].base_failed and field.content_share(measured[i]) >= 0.5}
    texts = {i: texts[i] for i, (_, component) in brute(texts, corpus_pipeline.NEAR.percent).items() if component == i}
    how = decontaminate.Settings()
    block = decontaminate.block_of([tuple(r) for r in queries.table(spark, SF_DIR, "benchmark").collect()], how)
    worst = lambda t: max(decontaminate.align(p, block.numbers(t))[0] / (2 * len(p)) for p in block.pieces)
    texts = {i: t for i, t in texts.items() if worst(t) < how.least_score}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))

    rows = {r.doc_id: r for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert set(rows) == set(texts) and 50 < len(texts) < docs.count()
    for i, text in texts.items():
        assert rows[i].n_tokens == len(library.encode(text, add_special_tokens=False).ids) and rows[i].round_trip


def test_stages_keep_the_columns_and_handle_odd_rows(spark):
    good = " ".join(f"word{i} and{i}" for i in range(40)) + "."
    odd = documents(spark, [good, None, "", good + " more", "idiot"]).unionAll(documents(spark, [good])).unionAll(documents(spark, [good]).withColumn("doc_id", F.lit(None).cast("long")))
    for rows in (odd, odd.limit(0)):
        out = rows
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, out, SF_DIR)
            assert out.columns == rows.columns
            out = spark.createDataFrame(out.collect(), out.schema)
        last = corpus_pipeline.STAGES[-1][1](spark, out, SF_DIR).collect()
        assert all(r.round_trip for r in last) and len(last) == out.count()
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, odd, SF_DIR).collect()]
    assert sorted(kept, key=str) == sorted([(0, good), (1, None), (2, ""), (4, "idiot")], key=str)


def test_near_duplicates_of_shared_and_missing_ids(spark):
    one, two, three = (" ".join(f"{stem}{i}" for i in range(60)) for stem in ("alpha", "beta", "gamma"))
    rows = [(5, one), (5, two), (5, two), (7, two + " end"), (None, three), (None, three + " end"), (None, one), (9, three), ((1 << 63) - 1, "last words of all")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF_DIR).collect()
    # Of each group the row of least id stays: no text of the shared id 5 is lost, and none is kept twice.
    assert sorted(r.text.split()[0] for r in kept) == ["alpha0", "beta0", "gamma0", "last"]
    assert {r.text: r.doc_id for r in kept}[three] == 9 and len(kept) == 4
    assert corpus_pipeline.drop_near_duplicates(spark, docs.limit(0), SF_DIR).count() == 0


def test_long_texts_pass_all_stages(spark):
    text = " ".join(f"word{i} and{i}" for i in range(60_000)) + "."
    out = documents(spark, [text], first=10**9)  # no label says anything of it
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, out, SF_DIR)
    assert [r.round_trip for r in out.collect()] == [True]
