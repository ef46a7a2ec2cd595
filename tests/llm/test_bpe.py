import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from patronage.llm import bpe, queries
from tests.llm.rows import documents, no_documents

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
NASTY = ["", " ", "  a  b \n\n c\t", "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "<|endoftext", "'s 'S it's we'll'd", "é́日本語🙂‍👩", "\x00\x1c\x1d\x1e\x1f\x85\xa0",
         "a" * 5000, " " * 3000, "-" * 700 + "=" * 900, "ab" * 3000, "0123456789" * 300, "Ⅷ²٣ǅʰ​᠎﻿ x", "\r\n\r\n  \r\n", "THERHAOU!! &&& ***"]


def ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoder():
    return bpe.encoder(PATH)


def mine(encoder, text):
    return np.frombuffer(encoder.encode(text), "<u4").tolist()


def test_nasty_texts(encoder):
    for text in NASTY:
        assert mine(encoder, text) == ids(text), text[:40]
        assert bpe.decode(encoder.vocabulary.text_of, encoder.encode(text), 4) == LIBRARY.decode(ids(text), skip_special_tokens=False)


def test_every_code_point_splits_alike(encoder):
    for plane in (range(1, 0x3400), range(0xA000, 0xD800), range(0xE000, 0x14500), range(0x16000, 0x20000, 7)):
        for start in range(plane.start, plane.stop, 256 * plane.step):
            text = "".join(f"a{chr(c)}1 {chr(c)}{chr(c)} " for c in range(start, min(start + 256 * plane.step, plane.stop), plane.step))
            assert mine(encoder, text) == ids(text), hex(start)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    encoder = bpe.encoder(PATH)
    assert mine(encoder, text) == ids(text)
    assert bpe.decode(encoder.vocabulary.text_of, encoder.encode(text)) == text


def merge_all(data, vocabulary):
    """Plain BPE: the earliest merge first, from the left."""
    parts = [vocabulary.ids[bytes([b])] for b in data]
    while True:
        ranked = [(vocabulary.rank.get(pair, bpe.NEVER), i) for i, pair in enumerate(zip(parts, parts[1:], strict=False))]
        rank, i = min(ranked, default=(bpe.NEVER, 0))
        if rank == bpe.NEVER:
            return parts
        made = next(t for t, (r, _, _) in vocabulary.made.items() if r == rank)
        parts[i : i + 2] = [made]


def random_vocabulary(rng, letters=3, merges=12):
    texts, pairs = [bytes([97 + i]) for i in range(letters)], []
    for _ in range(merges):
        a, b = rng.randrange(len(texts)), rng.randrange(len(texts))
        if texts[a] + texts[b] not in texts and len(texts[a] + texts[b]) < 7:
            texts.append(texts[a] + texts[b])
            pairs.append((a, b))
    return bpe.Vocabulary({t: i for i, t in enumerate(texts)}, pairs)


@pytest.mark.parametrize("seed", range(60))
def test_stream_with_least_memory_equals_plain_merging(seed):
    rng = random.Random(seed)
    vocabulary = random_vocabulary(rng, rng.randint(1, 3), rng.randint(0, 14))
    transducer = bpe.Transducer(vocabulary)
    transducer.block = 1
    letters = [t for t in vocabulary.ids if len(t) == 1]
    for _ in range(12):
        data = b"".join(rng.choice(letters) for _ in range(rng.randint(0, 90)))
        if rng.random() < 0.3:
            data = (data[: rng.randint(1, 4)] or letters[0]) * 30
        out, held = [], 0
        for i in range(len(data)):
            out += transducer.feed(data[i : i + 1])
            held = max(held, transducer.held)
        assert held <= vocabulary.lookahead + 1 + max(len(t) for t in vocabulary.ids)
        assert out + transducer.finish() == merge_all(data, vocabulary)


def test_memory_stays_constant(encoder):
    transducer = bpe.Transducer(encoder.vocabulary)
    out = []
    for _ in range(30):
        out += transducer.feed(b"ab" * 4096)
        assert transducer.held <= 2 * transducer.block + encoder.vocabulary.lookahead
    assert out + transducer.finish() == ids("ab" * 4096 * 30)


def test_decoder_holds_back_incomplete_characters(encoder):
    vocabulary = encoder.vocabulary
    assert bpe.token_texts(PATH) == vocabulary.text_of
    token = {data: i for i, data in enumerate(vocabulary.text_of)}
    packed = [np.array([token[bytes([b])]], "<u4").tobytes() for b in "é🙂".encode()]
    assert list(bpe.decode_stream(vocabulary.text_of, packed)) == ["", "é", "", "", "", "🙂", ""]
    broken = [token[bytes([b])] for b in b"\xf0\x9f\xff a\xc3"]
    assert bpe.decode(vocabulary.text_of, np.array(broken, "<u4").tobytes()) == LIBRARY.decode(broken, skip_special_tokens=False)


def test_bad_merge_lists_are_refused():
    with pytest.raises(ValueError):
        bpe.Vocabulary({b"a": 0, b"aa": 1, b"aaa": 2}, [(0, 1), (0, 0)])
    with pytest.raises(ValueError):
        bpe.Vocabulary({b"a": 0, b"aa": 1}, [(0, 0), (0, 0)])


def test_query_equals_the_library(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = {r.doc_id: r for r in queries.op7_bpe(spark, sf_dir).collect()}
    texts = queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    assert len(rows) == len(texts)
    for doc_id, text in texts:
        want = ids(text or "")
        decoded = LIBRARY.decode(want, skip_special_tokens=False)
        assert (rows[doc_id].n_tokens, rows[doc_id].ids_sha256) == (len(want), hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest())
        assert rows[doc_id].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_nulls_repeats_and_empty_table(spark):
    docs = documents(spark, [None, "", "é🙂 " * 50_000]).unionAll(documents(spark, ["same"])).withColumnRenamed("slot", "ids").withColumnRenamed("part", "n_tokens")
    out = bpe.decode_documents(bpe.encode_documents(docs, PATH), PATH).collect()
    assert sorted((r.n_tokens, r.decoded) for r in out)[:2] == [(0, ""), (0, "")]
    assert {r.decoded for r in out} == {"", "é🙂 " * 50_000, "same"}
    assert sorted(map(tuple, bpe.encode_documents(docs, PATH, decode_too=True).collect())) == sorted(map(tuple, out))
    assert bpe.decode_documents(bpe.encode_documents(no_documents(spark), PATH), PATH).count() == 0


def test_a_text_reaches_the_worker_once(spark):
    """A kept text is the one that is encoded; rows stay in Arrow, so that a worker holds the strings of ROWS rows only."""
    docs = documents(spark, ["x y", None, ""])
    encoded = bpe.encode_documents(docs, PATH, ("doc_id", "text"), decode_too=True)
    plan = encoded._jdf.queryExecution().executedPlan().toString()
    assert "coalesce" not in plan and "MapInPandas" not in plan
    assert [(r.doc_id, r.text, r.n_tokens, r.decoded) for r in encoded.orderBy("doc_id").collect()] == [(0, "x y", 2, "x y"), (1, None, 0, ""), (2, "", 0, "")]
