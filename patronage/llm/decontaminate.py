"""Benchmark decontamination: rare word n-grams of test items find passages in documents, and local alignment scores them as copies.

Test items are taken in blocks of a bounded number of words, each block broadcast to one scan of the documents, so neither side has to be small
and documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PUNCTUATION = b".,;:!?\"()[]"
#: Points of an alignment for equal words, for different ones, and for a word left out on one side.
MATCH, MISMATCH, GAP = 2, -1, -1


#: An odd number of mixed bits, for keys.
SPREAD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    """Of each `window` n-grams in a row the rarest that any document holds is a seed, so any `ngram` + `window` - 1 unedited words of an item hold
    one, and so is each that at most `rare` documents hold, so a copy edited more often is found by whatever it shares with few. Items beyond
    `piece` words are aligned in pieces, of which each overlaps its neighbours by half. `least_score` is the share of a perfect alignment's points from which a document counts as contaminated;
    `block_words` bounds what is broadcast."""

    ngram: int = 3
    window: int = 4
    rare: int = 16
    piece: int = 200
    least_score: float = 0.4
    block_words: int = 500_000


def words_of(text: str | None) -> list[bytes]:
    """Words in lower case (A-Z) without punctuation."""
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(None, PUNCTUATION).split()


@dataclass(frozen=True)
class Block:
    """Pieces of items as word numbers, and their n-grams: `keys` sorted, with the places (piece, position) of key i at
    `places[starts[i]:starts[i + 1]]`, of the lengths in `sizes`. After `thinned` only seeds are left."""

    vocabulary: dict[bytes, int]
    items: list
    pieces: list[np.ndarray]
    sizes: tuple[int, ...]
    keys: np.ndarray
    starts: np.ndarray
    places: np.ndarray

    def numbers(self, text: str | None) -> np.ndarray:
        """Word numbers, -1 for words that no item holds."""
        words = words_of(text)
        get = self.vocabulary.get
        return np.fromiter((get(w, -1) for w in words), np.int64, len(words))


def keys_of(numbers: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys (63 bits and a sign) of the n-grams made of known words, and where they start. That two n-grams share one by chance only costs an alignment."""
    n = len(numbers) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, known = np.full(n, size, np.uint64), np.ones(n, bool)
    for i in range(size):
        part = numbers[i : i + n]
        known &= part >= 0
        keys = (keys + part.astype(np.uint64) + np.uint64(1)) * SPREAD
        keys ^= keys >> np.uint64(29)
    at = np.flatnonzero(known)
    return keys[at].view(np.int64), at


def table_of(found: list[tuple[np.ndarray, int, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, their starts, and the places (piece, position) in that order."""
    flat = np.concatenate([k for k, _, _ in found]) if found else np.zeros(0, np.int64)
    places = np.concatenate([np.stack([np.full(len(at), p), at], 1) for _, p, at in found]) if found else np.zeros((0, 2), np.int64)
    order = np.argsort(flat, kind="stable")
    keys, counts = np.unique(flat, return_counts=True)
    return keys, np.concatenate([[0], np.cumsum(counts)]), places[order]


def block_of(rows: list[tuple], how: Settings) -> Block:
    """Items (id, text) with all their n-grams. An item of fewer words than an n-gram is one by itself; without words it has none."""
    vocabulary: dict[bytes, int] = {}
    items, pieces = [], []
    for item_id, text in rows:
        numbers = np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words_of(text)], np.int64)
        parts = np.array_split(numbers, max(-(-len(numbers) // how.piece), 1))
        # Between two pieces lies one of half of each, so a passage of half a piece is whole in one of them.
        between = [np.concatenate([a[len(a) // 2 :], b[: -(-len(b) // 2)]]) for a, b in zip(parts, parts[1:], strict=False)]
        items.extend([item_id] * (len(parts) + len(between)))
        pieces.extend(parts + between)
    found = [(*keys_of(piece, min(how.ngram, len(piece)) or 1), p) for p, piece in enumerate(pieces)]
    sizes = tuple(sorted({min(how.ngram, len(piece)) for piece in pieces if len(piece)}))
    return Block(vocabulary, items, pieces, sizes, *table_of([(keys, p, at) for keys, at, p in found]))


def thinned(block: Block, frequency: np.ndarray, how: Settings) -> Block:
    """Only seeds: of every `window` n-grams in a row that which fewest documents hold, at equal counts that of the least key, and all that at most
    `rare` hold. What no document holds finds nothing and displaces nothing."""
    found = []
    for p, piece in enumerate(block.pieces):
        keys, at = keys_of(piece, min(how.ngram, len(piece)) or 1)
        if not len(keys):
            continue
        held = frequency[np.searchsorted(block.keys, keys)]
        rank = np.lexsort((keys, held, held == 0))
        order = np.empty(len(keys), np.int64)
        order[rank] = np.arange(len(keys))
        chosen = {int(i + order[i : i + how.window].argmin()) for i in range(max(len(keys) - how.window + 1, 1))}
        pick = np.array(sorted(i for i in chosen.union(np.flatnonzero(held <= how.rare).tolist()) if held[i]), np.int64)
        found.append((keys[pick], p, at[pick]))
    keys, starts, places = table_of(found)
    return replace(block, keys=keys, starts=starts, places=places)


def hits(block: Block, numbers: np.ndarray, how: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Indexes into `block.keys` of the n-grams found, and where they start in the text."""
    found = [keys_of(numbers, size) for size in block.sizes]
    keys, at = (np.concatenate([np.zeros(0, np.int64), *(pair[i] for pair in found)]) for i in (0, 1))
    index = np.minimum(np.searchsorted(block.keys, keys), max(len(block.keys) - 1, 0))
    good = block.keys[index] == keys if len(block.keys) else np.zeros(len(keys), bool)
    return index[good], at[good]


def align(piece: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Points of the best local alignment (Smith-Waterman), and where it ends in the passage (behind its last word)."""
    best, end = 0, 0
    row = np.zeros(len(passage) + 1, np.int64)
    slope = -GAP * np.arange(len(passage) + 1)
    for word in piece:
        step = np.where(passage == word, MATCH, MISMATCH)
        grown = np.maximum(row + GAP, 0)
        grown[1:] = np.maximum(grown[1:], row[:-1] + step)
        # A run of gaps along the passage costs the distance: a running maximum with the cost taken out.
        row = np.maximum.accumulate(grown + slope) - slope
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


def passages(block: Block, numbers: np.ndarray, how: Settings) -> Iterator[tuple[int, float, int, int]]:
    """(piece, score, start, end) of the best alignment of each piece that shares a seed with the text.

    Around every seed the stretch is aligned that the piece would cover, with half its length to spare on both sides; overlapping stretches are one.
    """
    index, at = hits(block, numbers, how)
    spans: dict[int, list[int]] = {}
    for i, position in zip(index.tolist(), at.tolist(), strict=True):
        for piece, offset in block.places[block.starts[i] : block.starts[i + 1]].tolist():
            spans.setdefault(piece, []).append(position - offset)
    for piece, starts in spans.items():
        own = block.pieces[piece]
        spare = len(own) // 2 + how.ngram
        merged: list[list[int]] = []
        for start in sorted(set(starts)):
            low, high = max(start - spare, 0), min(start + len(own) + spare, len(numbers))
            if merged and low <= merged[-1][1]:
                merged[-1][1] = high
            else:
                merged.append([low, high])
        best, where = 0, (0, 0)
        for low, high in merged:
            points, end = align(own, numbers[low:high])
            if points > best:
                best, where = points, (low, low + end)
        low, end = where
        _, back = align(own[::-1], numbers[low:end][::-1])
        yield piece, best / (MATCH * len(own)), end - back, end


def document_frequency(docs: DataFrame, block: Broadcast, how: Settings) -> np.ndarray:
    """Documents that hold each n-gram of the block, counted over all documents; only counts for the block's own n-grams come back."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = block.value
        total = np.zeros(len(found.keys), np.int64)
        for batch in batches:
            for text in batch["text"]:
                total[np.unique(hits(found, found.numbers(text), how)[0])] += 1
        at = np.flatnonzero(total)
        if len(at):
            yield pd.DataFrame({"i": at, "n": total[at]})

    counted = docs.select("text").mapInPandas(count, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).toPandas()
    frequency = np.zeros(len(block.value.keys), np.int64)
    frequency[counted["i"].to_numpy(np.int64)] = counted["n"]
    return frequency


def seed_blocks(docs: DataFrame, benchmark: DataFrame, how: Settings) -> list[Broadcast]:
    """The items in blocks, each with its seeds, broadcast."""
    items = benchmark.select("item_id", "text").filter("text IS NOT NULL")
    spark = docs.sparkSession
    letters = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    count = -(-int(letters) // (2 * how.block_words)) or 1
    blocks = []
    for number in range(count):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == number).sort("item_id", "text").collect()
        block = block_of([(r.item_id, r.text) for r in rows], how)
        whole = spark.sparkContext.broadcast(block)
        blocks.append(spark.sparkContext.broadcast(thinned(block, document_frequency(docs, whole, how), how)))
    return blocks


def best_score(text: Column, blocks: list[Broadcast], how: Settings) -> Column:
    """Largest score of a text over all items; 0 if it shares no seed. Nothing is shuffled."""

    def scorer(seeds: Broadcast) -> Column:
        @F.pandas_udf("double")
        def score(texts: pd.Series) -> pd.Series:
            found = seeds.value
            return pd.Series([max((s for _, s, _, _ in passages(found, found.numbers(text), how)), default=0.0) for text in texts], dtype=float)

        return score(text)

    scores = [scorer(seeds) for seeds in blocks]
    return F.greatest(*scores) if len(scores) > 1 else scores[0]


def contaminations(docs: DataFrame, benchmark: DataFrame, how: Settings | None = None) -> DataFrame:
    """(doc_id, item_id, score, first_word, last_word, contaminated): one row for each row of `docs` and piece of an item that share a seed.

    `score` is the best alignment's share of the points of a perfect copy; words count from 0, and of equally good alignments the one that ends first
    counts. An item of one or two words is found where it stands whole. Null or empty texts share no seed. Repeated rows of
    `docs` each have their rows; items of equal text each count, whatever their ids, null included. Without items, or without documents, there
    are no rows.
    """
    how = how or Settings()
    chosen = docs.select("doc_id", "text")
    kinds = {"doc_id": dict(chosen.dtypes)["doc_id"], "item_id": dict(benchmark.dtypes)["item_id"]}
    fields = f"doc_id {kinds['doc_id']}, item_id {kinds['item_id']}, score double, first_word long, last_word long"

    def search_for(seeds: Broadcast) -> DataFrame:
        def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            found = seeds.value
            for batch in batches:
                out = [
                    (doc_id, found.items[piece], score, first, end - 1)
                    for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True)
                    for piece, score, first, end in passages(found, found.numbers(text), how)
                ]
                yield pd.DataFrame(out, columns=["doc_id", "item_id", "score", "first_word", "last_word"])

        return chosen.mapInPandas(search, fields)

    parts = [search_for(seeds) for seeds in seed_blocks(chosen, benchmark, how)]
    return reduce(DataFrame.unionAll, parts).withColumn("contaminated", F.col("score") >= how.least_score)
