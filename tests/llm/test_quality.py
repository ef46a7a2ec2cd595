import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronage.llm import quality as q
from patronage.llm import queries
from patronage.llm.common import WORD
from tests.llm.rows import documents, no_documents

SF_DIR = "/root/testdata/sf0.01"


def brute(text):
    """Counts by the wording of the rules."""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    dup = sum(line in lines[:i] for i, line in enumerate(lines))
    n = len(words)
    failed = n < 10 or 100 * len(covered) > 20 * n
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed


def test_query_counts_equal_brute_force(spark):
    texts = {r.doc_id: r.text or "" for r in queries.table(spark, SF_DIR, "documents").select("doc_id", "text").collect()}
    rows = queries.op10_quality_rules(spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_verdict_follows_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = queries.table(spark, sf_dir, "documents"), queries.table(spark, sf_dir, "labels")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    field = q.train(docs, labels.filter(~held))
    rows = {r.doc_id: r.kept for r in q.judge_documents(docs.filter(held), field).collect()}
    found = [(r.quality, rows[r.doc_id]) for r in labels.filter(held).collect()]
    assert np.mean([kept for label, kept in found if label == 1]) > 0.97
    assert np.mean([kept for label, kept in found if label == 0]) < 0.14
    # Labels change inside documents: bad ones often start with a line of content.
    shares = [r.content_share for r in q.judge_documents(docs.filter(held).join(labels.filter("quality = 0"), "doc_id"), field).collect() if not r.base_failed]
    assert np.mean([0 < share < 1 for share in shares]) > 0.25


def viterbi_by_table(field, features):
    """The recursion as it is usually written, over a table of both labels."""
    table, back = [(0.0, 0.0)] * len(features), []
    score = features @ field.emission
    for i, (a, b) in enumerate(score.tolist()):
        if i == 0:
            table[0] = (a, b)
            continue
        row, steps = [], []
        for label, own in enumerate((a, b)):
            ways = [table[i - 1][before] + field.transition[before, label] for before in (0, 1)]
            steps.append(0 if ways[0] >= ways[1] else 1)
            row.append(max(ways) + own)
        table[i] = tuple(row)
        back.append(steps)
    labels = [0 if table[-1][0] >= table[-1][1] else 1]
    for steps in reversed(back):
        labels.append(steps[labels[-1]])
    return labels[::-1]


def test_query_verdicts_follow_from_the_field(spark):
    docs, labels = queries.table(spark, SF_DIR, "documents"), queries.table(spark, SF_DIR, "labels")
    field = q.train(docs, labels)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    verdicts = set()
    for r in queries.op10_quality_rules(spark, SF_DIR).collect():
        m = q.measure(texts[r.doc_id])
        content = sum(len(WORD.findall(line)) for line, label in zip([x for x in texts[r.doc_id].split("\n") if WORD.search(x)], viterbi_by_table(field, m.features) if len(m.features) else [], strict=True) if label == 0)
        assert r.kept == (not brute(texts[r.doc_id])[-1] and 2 * content >= r.n_words)
        verdicts.add((r.base_failed, r.kept))
    assert verdicts == {(True, False), (False, True), (False, False)}


def mixed_page(rng, prose_lines=4, menu_lines=8):
    """Paragraphs of prose among menus, and which line is which."""
    prose = lambda: " ".join("".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(rng.integers(12, 30))).capitalize() + "."
    menu = lambda: " | ".join("".join(rng.choice(list("ABCDEFGH"), rng.integers(3, 9))) for _ in range(rng.integers(8, 14)))
    kinds = [0] * int(rng.integers(0, prose_lines)) + [1] * int(rng.integers(2, menu_lines)) + [0] * int(rng.integers(0, prose_lines)) + [1] * int(rng.integers(0, 4))
    return [menu() if kind else prose() for kind in kinds], kinds


def test_border_lines_are_found_from_labels_of_documents_alone():
    rng = np.random.default_rng(4)
    documents, bad = [], []
    for i in range(400):
        if i % 4:  # good pages: prose, seldom a menu
            lines = [line for line, kind in zip(*mixed_page(rng), strict=True) if not kind or rng.random() < 0.01] or ["A line of plain words and more of them."]
            bad.append(False)
        else:  # bad pages: a paragraph among many menus
            lines, _ = mixed_page(rng, 2, 14)
            bad.append(True)
        documents.append(q.measure("\n".join(lines)))
    field = q.learn([(m.features, m.line_words) for m in documents], np.array(bad))
    right, borders, found, mixed = [], 0, 0, []
    for _ in range(200):
        lines, kinds = mixed_page(rng)
        m = q.measure("\n".join(lines))
        labels = field.viterbi(m.features).tolist()
        right += [a == b for a, b in zip(labels, kinds, strict=True)]
        at = [i for i in range(1, len(kinds)) if kinds[i] != kinds[i - 1]]
        borders, found = borders + len(at), found + sum(labels[i] != labels[i - 1] for i in at)
        if 0 in kinds and 1 in kinds:
            mixed.append(0 < field.content_share(m) < 1)
    assert np.mean(right) > 0.97 and found > 0.9 * borders and np.mean(mixed) > 0.95


def test_forward_backward_equals_all_label_sequences():
    rng = np.random.default_rng(7)
    for sizes in ([3, 5, 1], [4], [2, 2]):
        documents = [(rng.normal(size=(n, len(q.FEATURES))), np.ones(n)) for n in sizes]
        lines = q._Lines(documents, 32)
        weights = rng.normal(size=len(q.FEATURES) * 2 + 4)
        single, joint = lines.sums(weights)
        emission, transition = weights[:-4].reshape(-1, 2), weights[-4:].reshape(2, 2)
        pairs = np.zeros((2, 2))
        for at, (d, _, n) in enumerate(lines.cut):
            score = documents[d][0] @ emission
            ways = list(product((0, 1), repeat=n))
            mass = np.exp([sum(score[i, a] for i, a in enumerate(y)) + sum(transition[a, b] for a, b in zip(y, y[1:], strict=False)) for y in ways])
            mass /= mass.sum()
            for y, m in zip(ways, mass, strict=True):
                for a, b in zip(y, y[1:], strict=False):
                    pairs[a, b] += m
            want = [sum(m for y, m in zip(ways, mass, strict=True) if y[i]) for i in range(n)]
            assert np.allclose(single[at, :n, 1], want) and not single[at, n:].any()
        assert np.allclose(joint, pairs)


def test_shares_are_moved_no_further_than_the_label_demands():
    rng = np.random.default_rng(8)
    documents = [(rng.normal(size=(n, len(q.FEATURES))), rng.integers(1, 20, n)) for n in (40, 5, 9, 1)]
    lines, how = q._Lines(documents, 16), q.Training()
    chance = rng.random(lines.shape)
    bad = np.array([True, False, True, False])
    moved = lines.within(chance, bad, how)
    for d, (_, words) in enumerate(documents):
        mine = lines.real & (lines.of == d)
        before, after = (float((lines.words * x)[mine].sum() / words.sum()) for x in (chance, moved))
        wanted = max(before, how.least_in_bad) if bad[d] else min(before, how.most_in_good)
        assert abs(after - wanted) < 1e-4


@pytest.mark.parametrize("text", ["", "a", "a a a a a a", "x y z w v " * 4, "\n\n a\tb\n a\tb\n  c d\x0be", "#|<> *** $%&\n#|<> *** $%&"])
def test_measures(text):
    m = q.measure(text)
    assert (m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words, m.base_failed) == brute(text)
    assert m.line_words.sum() == m.n_words and len(m.features) == len(m.line_words)


def test_viterbi_equals_all_label_sequences():
    rng = np.random.default_rng(0)
    for _ in range(30):
        field = q.Field(rng.normal(size=(len(q.FEATURES), 2)), rng.normal(size=(2, 2)))
        x = rng.normal(size=(rng.integers(1, 8), len(q.FEATURES)))
        score = x @ field.emission
        value = lambda y: sum(score[i, a] for i, a in enumerate(y)) + sum(field.transition[a, b] for a, b in zip(y, y[1:], strict=False))  # noqa: B023, E731
        best = max(product((0, 1), repeat=len(x)), key=value)
        assert tuple(field.viterbi(x)) == best


def test_fit_learns_lines_and_runs():
    rng = np.random.default_rng(1)
    sequences = []
    for _ in range(150):
        y, label = [], 0
        for _ in range(30):
            label = label ^ int(rng.random() < 0.1)
            y.append(label)
        y = np.array(y)
        x = rng.normal(size=(30, len(q.FEATURES)))
        x[:, 0], x[:, 3] = 1, y + rng.normal(0, 0.6, 30)
        sequences.append((x, y))
    field = q.fit(sequences[:100])
    right = np.mean([np.mean(field.viterbi(x) == y) for x, y in sequences[100:]])
    alone = np.mean([np.mean((x @ field.emission).argmax(1) == y) for x, y in sequences[100:]])
    assert right > 0.88 and right > alone + 0.03
    assert field.transition[0, 0] + field.transition[1, 1] > field.transition[0, 1] + field.transition[1, 0] + 1


def test_nulls_repeats_long_empty_and_no_labels(spark):
    field = q.fit([])
    good = " ".join(f"word{i}" for i in range(40))
    docs = documents(spark, [None, "", good, "a " * 200_000, good + "\n" * 100_000]).unionAll(documents(spark, [good]))
    kept = Counter((r.base_failed, r.kept) for r in q.judge_documents(docs.withColumnRenamed("size", "kept"), field).collect())
    assert kept == {(True, False): 3, (False, True): 3}
    assert q.judge_documents(no_documents(spark), field).count() == 0
    assert isinstance(q.train(docs, spark.createDataFrame([(0, 1), (1, 0), (1, 1), (2, None), (None, 1)], "doc_id long, quality int")), q.Field)
    assert zlib.crc32(b"") == 0
