"""Cross-entropy difference: two matched n-gram models, of a target and of the whole corpus, score every document by their losses per token.

Both models share one vocabulary (all words of the corpus), one order, one smoothing and, by scaling, one mass of counts. Every word and every pair of
words is counted by itself over all documents, under a hash of 63 bits. Documents are taken in batches; a batch asks once for each of its distinct words
and pairs, already combined, so a hot pair costs one entry a batch. Cells of the range of hashes sum what all batches hold and answer each with
the totals, in the order asked. What is gathered grows with the corpus, and no worker holds more than a batch or a cell of it.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Words of the vocabulary at least: a small corpus leaves room for words that it does not hold.
WORDS = 1 << 16
#: Tokens of a batch from which on it is closed; what a text without tokens adds to it.
BATCH, EACH = 1 << 19, 16
#: Tokens of documents that are scored at a time.
SLICE = 1 << 16
#: Cells at least, and tokens of the corpus for each further one.
CELLS, CELL = 512, 1 << 22
LEFT, RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Numbers(dict):
    """Word to its number, in the order in which words come."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def tokens_of(text: str | None, numbers: Numbers) -> np.ndarray:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))


def pairs_of(tokens: np.ndarray) -> np.ndarray:
    """Each pair of neighbours as one number."""
    return tokens[:-1].astype(np.int64) << 32 | tokens[1:].astype(np.int64)


def packed(numbers: np.ndarray) -> bytes:
    """Numbers from 0 on by planes of bytes, as many as the largest needs."""
    width = max((int(numbers.max(initial=0)).bit_length() + 7) // 8, 1)
    return bytes([width]) + numbers.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def least_key(cell: int, cells: int) -> np.uint64:
    """Where a cell's range of keys begins."""
    return np.uint64(-(-(cell << 32) // cells) << 32)


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : data[0]] = planes.T
    return out.reshape(-1).view("<i8").astype(np.int64, copy=False)


@dataclass(frozen=True)
class Batch:
    """Texts as one run of tokens (numbers within the batch); `document` of each token, `second` the places that have a neighbour before them in
    their text, `pairs` the distinct pairs, and `order`, which sorts the keys of all distinct words (odd) and then pairs (even)."""

    tokens: np.ndarray
    lengths: np.ndarray
    document: np.ndarray
    second: np.ndarray
    pairs: np.ndarray
    keys: np.ndarray
    order: np.ndarray

    @classmethod
    def of(cls, tokens: bytes, lengths: bytes, hashes: bytes) -> Batch:
        run, sizes, words = unpacked(tokens), unpacked(lengths), np.frombuffer(hashes, "<u8")
        document = np.repeat(np.arange(len(sizes)), sizes)
        second = np.flatnonzero(document[1:] == document[:-1]) + 1
        pairs = np.unique(pairs_of(run)[second - 1])
        keys = np.concatenate([words | np.uint64(1), (words[pairs >> 32] * LEFT + words[pairs & 0xFFFFFFFF] * RIGHT) & ~np.uint64(1)])
        order = np.argsort(keys, kind="stable")
        return cls(run, sizes, document, second, pairs, keys[order], order)

    def places(self, cells: int) -> np.ndarray:
        """Where each cell begins in the sorted keys, and where the last ends."""
        return np.searchsorted((self.keys >> np.uint64(32)) * np.uint64(cells) >> np.uint64(32), np.arange(cells + 1))

    def of_pair(self) -> np.ndarray:
        """The distinct pair that ends at each place of `second`."""
        return np.searchsorted(self.pairs, pairs_of(self.tokens)[self.second - 1])

    def counts(self, of_pair: np.ndarray, inside: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Sorted like the keys: how often each word or pair occurs, in the documents `inside` or in all, and how often a word ends a text."""
        size = len(self.keys) - len(self.pairs)
        token = np.ones(len(self.tokens), bool) if inside is None else inside[self.document]
        last = np.ones(len(self.tokens), bool)
        last[self.second - 1] = False
        often = [np.bincount(self.tokens[token], minlength=size), np.bincount(of_pair[token[self.second]], minlength=len(self.pairs))]
        ends = np.bincount(self.tokens[token & last], minlength=len(self.keys))
        return np.concatenate(often)[self.order], ends[self.order]

    def own(self, keys: np.ndarray, document: np.ndarray) -> np.ndarray:
        """For each place how often its key occurs in its document."""
        _, inverse, times = np.unique(document * (int(keys.max(initial=0)) + 1) + keys, return_inverse=True, return_counts=True)
        return times[inverse]

    def losses(self, models: list[tuple], vocabulary: float, weight: float) -> list[np.ndarray]:
        """Sum of the losses in nats of each document's tokens under each model: counts sorted like the keys (`often`, `ends`) times `scale`, of the
        mass given, from which a document's own counts, `own` times, are taken out.

        A token's pair count is smoothed by `weight` times its single probability, that by one for each word of the vocabulary.
        """
        size, out = len(self.keys) - len(self.pairs), [np.zeros(len(self.lengths)) for _ in models]
        counts = []
        for often, ends, *_ in models:
            total, last = np.empty(len(self.keys), np.int64), np.empty(len(self.keys), np.int64)
            total[self.order], last[self.order] = often, ends
            counts.append((total[:size], total[:size] - last[:size], total[size:]))
        ends = np.cumsum(self.lengths)
        begin = 0
        while begin < len(self.tokens):  # whole documents, so that their own counts are complete
            end = int(ends[np.searchsorted(ends, min(begin + SLICE, len(self.tokens)))])
            tokens, document = self.tokens[begin:end], self.document[begin:end]
            second = self.second[slice(*np.searchsorted(self.second, [begin, end]))] - begin
            of_pair = np.searchsorted(self.pairs, pairs_of(tokens)[second - 1])
            before, of_second = tokens[second - 1], document[second]
            times, seen, both = self.own(tokens, document), self.own(before, of_second), self.own(of_pair, of_second)
            for loss, (single, first, pair), (_, _, mass, scale, own) in zip(out, counts, models, strict=True):
                mine, rest = own[document], scale * np.maximum(mass - own * self.lengths, 0)
                chance = (scale * np.maximum(single[tokens] - mine * times, 0) + 1) / (rest[document] + vocabulary)
                together = scale * np.maximum(pair[of_pair] - mine[second] * both, 0)
                starts = scale * np.maximum(first[before] - mine[second] * seen, 0)
                chance[second] = (np.minimum(together, starts) + weight * chance[second]) / (starts + weight)
                loss[document[0] : document[-1] + 1] += np.bincount(document - document[0], -np.log(chance))
            begin = end
        return out


def batches_of(docs: DataFrame) -> DataFrame:
    """Texts in batches: their ids, their tokens and lengths packed, and the hashes of the distinct words in the order of their numbers."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, runs, numbers, held = [], [], Numbers(), 0

        def closed() -> pa.RecordBatch:
            values = pa.concat_arrays(ids)
            hashes = b"".join(hashlib.blake2b(word, digest_size=8).digest() for word in numbers)
            row = [uuid.uuid4().hex], [sum(map(len, runs))], [packed(np.concatenate(runs))], [packed(np.array(list(map(len, runs)), np.int64))], [hashes]
            kinds = pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.binary()
            arrays = [pa.array(value, kind) for value, kind in zip(row, kinds, strict=True)]
            return pa.RecordBatch.from_arrays([*arrays, pa.ListArray.from_arrays([0, len(values)], values)], [*NAMES, "doc_ids"])

        for batch in batches:
            begin = 0
            for at, text in enumerate(batch.column("text")):  # one string at a time
                runs.append(tokens_of(text.as_py(), numbers))
                held += len(runs[-1]) + EACH
                if held >= BATCH:
                    ids.append(batch.column("doc_id").slice(begin, at + 1 - begin))
                    yield closed()
                    ids, runs, numbers, held, begin = [], [], Numbers(), 0, at + 1
            if begin < batch.num_rows:
                ids.append(batch.column("doc_id").slice(begin))
        if runs:
            yield closed()

    kind = dict(docs.dtypes)["doc_id"]
    return stored(docs.select("doc_id", "text").mapInArrow(gather, f"{FIELDS}, doc_ids array<{kind}>"), "batches")


FIELDS = "batch string, size long, tokens binary, lengths binary, hashes binary"
NAMES = [field.split()[0] for field in FIELDS.split(", ")]


def marks_of(batches: DataFrame, targets: DataFrame) -> DataFrame:
    """One bit for each text of a batch that holds one of the target; stored, so a small table is joined without moving batches."""
    wanted = targets.select("doc_id").filter("doc_id IS NOT NULL").distinct()
    places = batches.select("batch", F.posexplode("doc_ids").alias("place", "doc_id")).join(wanted, "doc_id")

    def mark(groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups:
            bits = []
            for places in group.column("places"):
                at = places.values.to_numpy(zero_copy_only=False)
                bits.append(np.packbits(np.bincount(at).astype(bool)).tobytes())
            yield pa.RecordBatch.from_arrays([group.column("batch"), pa.array(bits, pa.binary())], ["batch", "marks"])

    return stored(places.groupBy("batch").agg(F.collect_list("place").alias("places")).mapInArrow(mark, "batch string, marks binary"), "marks")


def marked(marks: bytes | None, n: int) -> np.ndarray:
    """Whether each of `n` texts is one of the target."""
    out = np.zeros(n, bool)
    bits = np.unpackbits(np.frombuffer(marks or b"", np.uint8))[:n].astype(bool)
    out[: len(bits)] = bits
    return out


def gathered(batches: DataFrame, cells: int) -> DataFrame:
    """For each batch and cell the totals of the keys asked: occurrences and ends in all texts, and both in those of the target. One row of each cell
    has the number of its words and their masses in all texts and in the target."""

    def ask(groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups:
            for row in range(group.num_rows):
                name, _, *blobs, marks = (group.column(c)[row].as_py() for c in (*NAMES, "marks"))
                batch = Batch.of(*blobs)
                of_pair, at = batch.of_pair(), batch.places(cells)
                counts = [*batch.counts(of_pair), *batch.counts(of_pair, marked(marks, len(batch.lengths)))]
                full = np.flatnonzero(np.diff(at)).tolist()
                keys = [packed(np.diff(batch.keys[at[c] : at[c + 1]], prepend=least_key(c, cells)).astype(np.int64)) for c in full]
                asked = [[packed(count[at[c] : at[c + 1]]) for count in counts] for c in full]
                columns = [pa.array([name] * len(full), pa.string()), pa.array(full, pa.int32()), pa.array(keys, pa.binary()), pa.array(asked, pa.list_(pa.binary()))]
                yield pa.RecordBatch.from_arrays(columns, ["batch", "cell", "keys", "counts"])

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        least = least_key(int(rows["cell"].iloc[0]), cells)
        keys = [least + np.cumsum(unpacked(k).astype(np.uint64)) for k in rows["keys"]]  # sorted keys are sent as gaps
        used, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        totals = []
        for part in zip(*rows["counts"], strict=True):
            totals.append(np.bincount(inverse, np.concatenate([unpacked(p) for p in part]), len(used)).astype(np.int64))
        ends = np.cumsum([len(k) for k in keys])
        answers = [[packed(total[inverse[end - len(k) : end]]) for total in totals] for k, end in zip(keys, ends.tolist(), strict=True)]
        word = (used & np.uint64(1)).astype(bool)
        out = pd.DataFrame({"batch": rows["batch"], "cell": rows["cell"], "counts": answers, "words": 0, "mass": 0, "target_mass": 0}).reset_index(drop=True)
        out.loc[0, ["words", "mass", "target_mass"]] = [int(word.sum()), int(totals[0][word].sum()), int(totals[2][word].sum())]
        return out

    asked = batches.select(*NAMES, "marks").mapInArrow(ask, "batch string, cell int, keys binary, counts array<binary>")
    schema = "batch string, cell int, counts array<binary>, words long, mass long, target_mass long"
    return stored(asked.groupBy("cell").applyInPandas(answer, schema), "answers")


def score_documents(docs: DataFrame, targets: DataFrame, weight: float = 2.0, least_words: int = WORDS) -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, difference) for every row of `docs`.

    `targets` lists the doc_ids of the target corpus (repeats and nulls do no harm); the background is all of `docs`. Losses are nats per token, and
    `difference` is target less background: the lower, the more a text is like the target. A document is scored without its own counts. A text
    without words has no losses (null). A word never seen has the share of one of all words, of which the models count `least_words` at least, so that
    small corpora do not make unknown words likely. Without any target the target model is uniform. Repeated rows count, and are scored, each.
    """
    batches = batches_of(docs)
    batches = batches.join(marks_of(batches, targets), "batch", "left")
    tokens = batches.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    cells = max(CELLS, -(-int(tokens) // CELL))
    answers = gathered(batches, cells)
    words, mass, target_mass = (float(x or 0) for x in answers.agg(F.sum("words"), F.sum("mass"), F.sum("target_mass")).first())
    vocabulary, scale = max(words, least_words), target_mass / mass if target_mass else 1.0

    def score(asked: pa.Table, answered: pa.Table) -> pa.Table:
        _, _, *blobs, marks = (asked.column(c)[0].as_py() for c in (*NAMES, "marks"))
        batch = Batch.of(*blobs)
        inside = marked(marks, len(batch.lengths)).astype(float)
        parts = answered.sort_by("cell").column("counts").to_pylist()
        totals = [np.concatenate([unpacked(p) for p in part]) for part in zip(*parts, strict=True)] or [np.zeros(0)] * 4
        models = [(*totals[2:], target_mass, 1.0, inside), (*totals[:2], mass, scale, np.ones(len(inside)))]
        size = batch.lengths
        own, general = (loss / np.maximum(size, 1) for loss in batch.losses(models, vocabulary, weight))
        ids = asked.column("doc_ids")[0].values
        losses = [pa.array(x, pa.float64(), mask=size == 0) for x in (own, general, own - general)]
        return pa.Table.from_arrays([ids, pa.array(size, pa.int64()), *losses], ["doc_id", "n_tokens", "target_loss", "background_loss", "difference"])

    kind = dict(docs.dtypes)["doc_id"]
    pairs = batches.groupBy("batch").cogroup(answers.select("batch", "cell", "counts").groupBy("batch"))
    return pairs.applyInArrow(score, f"doc_id {kind}, n_tokens long, target_loss double, background_loss double, difference double")
