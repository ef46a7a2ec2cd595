"""Ranked lexical search by pipelined term partitioning.

The terms of the items are dealt to owners, which form a pipeline of stages. A bundle of items, together with sparse accumulators of the
scores of one block of documents, goes through the stages; in each it meets its owner's posting lists by cogroup, and the owner adds the
contributions of its terms, in 64-bit integers, so that their order does not matter. After the last stage the best of each block are chosen,
and of these the best of all. Terms are dealt in order of their postings, rare ones first and half of all postings to the last owner, so that what
travels stays sparse.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: A term in UTF-8 with A-Z lower-cased: letters and digits of ASCII, and all code points beyond ASCII, whose bytes are 0x80 or more.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")


@dataclass(frozen=True)
class Settings:
    """`best` results for each item, after `stages` stages."""

    best: int = 10
    stages: int = 4
    #: Items that travel together.
    bundle: int = 256
    #: Documents of a block, at most 65,536, as their places are stored in 16 bits.
    block: int = 1 << 16
    #: Bytes of item texts that are searched for at once; more take further scans of the documents.
    pass_bytes: int = 8 << 20


@dataclass(frozen=True)
class Items:
    """The items of one pass: ids, and for each the numbers of its terms with their repeats."""

    ids: list
    wanted: list[dict[int, int]]
    terms: dict[bytes, int]

    @staticmethod
    def of(rows: list[tuple]) -> Items:
        ids, wanted, terms = [], [], {}
        for item_id, text in rows:
            counts = Counter(TERM.findall((text or "").encode().lower()))
            ids.append(item_id)
            wanted.append({terms.setdefault(term, len(terms)): n for term, n in counts.items()})
        return Items(ids, wanted, terms)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("_text"))


BLOCK = "block long, n_docs long, n_terms long, ids binary, unnamed binary, sizes binary, terms binary, ends binary, places binary, counts binary"


class _Block:
    """Posting lists of the documents read so far, for the terms asked for."""

    def __init__(self) -> None:
        self.ids: list[int] = []
        self.unnamed: list[bool] = []
        self.sizes: list[int] = []
        self.places: dict[int, list[int]] = {}
        self.counts: dict[int, list[int]] = {}

    def add(self, doc_id: int | None, text: bytes, terms: dict[bytes, int]) -> None:
        found = TERM.findall(text.lower())
        place = len(self.ids)
        for term, n in Counter(found).items():
            number = terms.get(term)
            if number is not None:
                self.places.setdefault(number, []).append(place)
                self.counts.setdefault(number, []).append(n)
        self.ids.append(doc_id or 0)
        self.unnamed.append(doc_id is None)
        self.sizes.append(len(found))

    def row(self, number: int) -> pa.RecordBatch:
        terms = sorted(self.places)
        ends = np.cumsum([len(self.places[t]) for t in terms])
        packed = [
            np.array(self.ids, "<i8"),
            np.array(self.unnamed, "?"),
            np.array(self.sizes, "<i8"),
            np.array(terms, "<i4"),
            ends.astype("<i8"),
            np.array([p for t in terms for p in self.places[t]], "<u2"),
            np.array([n for t in terms for n in self.counts[t]], "<i8"),
        ]
        values = [number, sum(s > 0 for s in self.sizes), sum(self.sizes)]
        columns = [pa.array([v], pa.int64()) for v in values] + [pa.array([a.tobytes()], pa.binary()) for a in packed]
        return pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in BLOCK.split(", ")])


def posting_blocks(docs: DataFrame, terms: dict[bytes, int], how: Settings) -> DataFrame:
    """Stored blocks of documents: ids, sizes in terms, and the posting lists of `terms`. `n_docs` counts documents with a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, count, block = TaskContext.get().partitionId(), 0, _Block()
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["_text"], strict=True):
                block.add(doc_id, text.as_py(), terms)
                if len(block.ids) == how.block:
                    yield block.row(task << 32 | count)
                    count, block = count + 1, _Block()
        if block.ids:
            yield block.row(task << 32 | count)

    # Stored, since the numbers of blocks must not change if a task is run again.
    return stored(_texts(docs).mapInArrow(run, BLOCK), "postings")


def document_frequencies(blocks: DataFrame) -> dict[int, int]:
    """Documents that hold each term; as many rows as terms were asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for terms, ends in zip(batch["terms"], batch["ends"], strict=True):
                held = np.diff(np.frombuffer(ends.as_buffer(), "<i8"), prepend=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(terms.as_buffer(), "<i4")), pa.array(held)], ["term", "held"])

    rows = blocks.select("terms", "ends").mapInArrow(run, "term int, held long").groupBy("term").agg(F.sum("held"))
    return {term: held for term, held in rows.collect()}


def weight(documents: int, held: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * held + 1)))


def impacts(counts: np.ndarray, sizes: np.ndarray, documents: int, length: int) -> np.ndarray:
    """What an occurrence count is worth in documents of these sizes."""
    if len(sizes) and 75 * int(sizes.max()) * documents >= 1 << 63:
        sizes = sizes.astype(object)  # Python's own integers
    m = (100 - 75 + (75 * sizes * documents) // length).astype(np.int64)
    return (1_000_000_000 * counts) // (1000 * counts + 8 * m)


def owners(frequencies: dict[int, int], stages: int) -> dict[int, int]:
    """Term to the stage of its owner: in order of frequency, the last owner has the upper half of all postings, the one before the upper half of the rest."""
    total, held, out = sum(frequencies.values()), 0, {}
    for term in sorted(frequencies, key=lambda term: (frequencies[term], term)):
        held += frequencies[term]
        out[term] = max(0, stages - 1 + math.ceil(math.log2(held / total)))
    return out


def _lists(row: dict) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Term, places and values of each packed list."""
    terms, ends = np.frombuffer(row["terms"], "<i4"), np.frombuffer(row["ends"], "<i8").tolist()
    places, values = np.frombuffer(row["places"], "<u2"), np.frombuffer(row["values"], "<i8")
    start = 0
    for term, end in zip(terms.tolist(), ends, strict=True):
        yield term, places[start:end], values[start:end]
        start = end


def _packed(lists: list[tuple[int, np.ndarray, np.ndarray]]) -> list[bytes]:
    arrays = [
        np.array([k for k, _, _ in lists], "<i4"),
        np.cumsum([len(p) for _, p, _ in lists]).astype("<i8"),
        np.concatenate([p for _, p, _ in lists] or [np.zeros(0, "<u2")]).astype("<u2"),
        np.concatenate([v for _, _, v in lists] or [np.zeros(0, "<i8")]).astype("<i8"),
    ]
    return [a.tobytes() for a in arrays]


LISTS = ["terms", "ends", "places", "values"]
CARRIED = "bundle int, block long, terms binary, ends binary, places binary, values binary"


def postings_of(blocks: DataFrame, stage: int, owner: dict[int, int], wanted: list[set[int]], documents: int, length: int, last: bool) -> DataFrame:
    """The posting lists of one owner, impacts in place of counts, for each bundle those it asks for. The last owner's rows carry the ids."""
    own = {term for term, of in owner.items() if of == stage}
    asked = [own & terms for terms in wanted]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                sizes = np.frombuffer(row["sizes"], "<i8")
                lists = [x for x in _lists(row | {"values": row["counts"]}) if x[0] in own]
                valued = [(term, places, impacts(counts, sizes[places], documents, length)) for term, places, counts in lists]
                for bundle, terms in enumerate(asked):
                    packed = _packed([x for x in valued if x[0] in terms])
                    ids = [row["ids"], row["unnamed"]] if last else [None, None]
                    columns = [pa.array([bundle], pa.int32()), pa.array([row["block"]], pa.int64()), *(pa.array([b], pa.binary()) for b in [*packed, *ids])]
                    yield pa.RecordBatch.from_arrays(columns, ["bundle", "block", *LISTS, "ids", "unnamed"])

    return blocks.select("block", "ids", "unnamed", "sizes", "terms", "ends", "places", "counts").mapInArrow(run, CARRIED + ", ids binary, unnamed binary")


def _accumulated(bundles: pa.Table, postings: pa.Table, items: list[dict[int, int]], weights: dict[int, int]) -> tuple[dict, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """The owner's row, and for each item (by its place in the bundle) documents and scores after the owner's contributions."""
    row = postings.to_pylist()[0]
    lists = {term: (places, values) for term, places, values in _lists(row)}
    before = {k: (p, v) for r in bundles.to_pylist() for k, p, v in _lists(r)}
    size = 1 + max((int(p.max()) for p, _ in [*lists.values(), *before.values()] if len(p)), default=-1)
    scores, out = np.zeros(size, np.int64), {}
    for k, terms in enumerate(items):
        places, values = before.get(k, (None, None))
        if places is not None:
            scores[places] = values
        for term, repeats in terms.items():
            if term in lists:
                at, worth = lists[term]
                scores[at] += repeats * weights[term] * worth
        found = np.flatnonzero(scores)
        if len(found):
            out[k] = (found, scores[found])
            scores[found] = 0
    return row, out


def _owner_stage(bundles: DataFrame, postings: DataFrame, items: Items, weights: dict[int, int], how: Settings) -> DataFrame:
    """Bundles meet the owner's lists of their block; the accumulators travel on."""
    size, wanted = how.bundle, items.wanted

    def add(own: pa.Table, lists: pa.Table) -> pa.Table:
        bundle = own["bundle"][0].as_py()
        row, scores = _accumulated(own, lists, wanted[bundle * size : (bundle + 1) * size], weights)
        packed = _packed([(k, places, values) for k, (places, values) in scores.items()])
        columns = [pa.array([bundle], pa.int32()), pa.array([row["block"]], pa.int64()), *(pa.array([b], pa.binary()) for b in packed)]
        return pa.Table.from_arrays(columns, ["bundle", "block", *LISTS])

    return bundles.groupBy("bundle", "block").cogroup(postings.groupBy("bundle", "block")).applyInArrow(add, CARRIED)


def _last_stage(bundles: DataFrame, postings: DataFrame, items: Items, weights: dict[int, int], how: Settings) -> DataFrame:
    """The last owner's contributions, and the best of the block for each item: `item` (number), `doc_id`, `score`."""
    size, wanted = how.bundle, items.wanted

    def choose(own: pa.Table, lists: pa.Table) -> pa.Table:
        bundle = own["bundle"][0].as_py()
        row, scores = _accumulated(own, lists, wanted[bundle * size : (bundle + 1) * size], weights)
        ids, unnamed = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["unnamed"], "?")
        numbers, places, values = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k, (found, score) in scores.items():
            if len(found) > how.best:  # all that reach the score of the last one chosen
                least = np.partition(score, len(score) - how.best)[-how.best]
                found, score = found[score >= least], score[score >= least]
            order = np.lexsort((ids[found], unnamed[found], -score))[: how.best]
            numbers.append(np.full(len(order), bundle * size + k, np.int32))
            places.append(found[order])
            values.append(score[order])
        at = np.concatenate(places)
        columns = [pa.array(np.concatenate(numbers)), pa.array(ids[at], mask=unnamed[at]), pa.array(np.concatenate(values))]
        return pa.Table.from_arrays(columns, ["item", "doc_id", "score"])

    return bundles.groupBy("bundle", "block").cogroup(postings.groupBy("bundle", "block")).applyInArrow(choose, "item int, doc_id long, score long")


def _passes(items: DataFrame, how: Settings) -> list[Column]:
    """Conditions that deal the items to passes of bounded size, by a hash of their id."""
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = -(-total // how.pass_bytes) or 1
    return [F.pmod(F.xxhash64("item_id"), F.lit(passes)) == i for i in range(passes)]


def search(docs: DataFrame, items: DataFrame, how: Settings | None = None) -> DataFrame:
    """`item_id`, `rank` from 1, `doc_id` and `score`: for each item the documents of highest score above 0, of equal scores those of least doc_id.

    Terms are runs of ASCII letters and digits and of code points beyond ASCII, A-Z lower-cased; a null or empty text has none. Each row of `docs` is a
    document, repeated rows and rows without an id (which come after others of their score) too. Of items that share an id the greatest text
    is taken, null ids being alike; an item without a term that some document holds gives no row, and so do empty tables. No text is shuffled, only
    posting lists of the items' terms and accumulators, each of one block of documents, whatever term or source is frequent. The driver holds
    the items of one pass, at most about `how.pass_bytes` of text (or one item), and a document count for each of their terms.
    """
    how = how or Settings()
    if not 0 < how.block <= 1 << 16 or how.stages < 1:
        raise ValueError("a block holds 1 to 65,536 documents, and there is a stage at least")
    kind = dict(items.dtypes)["item_id"]
    empty = items.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    chosen = items.groupBy("item_id").agg(F.coalesce(F.max("text"), F.lit("")).alias("text"))
    found = [_search_once(docs, chosen.where(condition), kind, how) for condition in _passes(chosen, how)]
    found = [part for part in found if part is not None]
    result = found[0] if found else empty
    for part in found[1:]:
        result = result.unionByName(part)
    return result


def _search_once(docs: DataFrame, chosen: DataFrame, kind: str, how: Settings) -> DataFrame | None:
    items = Items.of(sorted(map(tuple, chosen.collect()), key=lambda row: (row[0] is not None, row)))
    if not items.terms:
        return None
    blocks = posting_blocks(docs, items.terms, how)
    documents, length = blocks.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    if not documents:
        return None
    frequencies = document_frequencies(blocks)
    weights = {term: weight(documents, held) for term, held in frequencies.items()}
    owner = owners(frequencies, how.stages)
    wanted = [set().union(*items.wanted[i : i + how.bundle]) for i in range(0, len(items.ids), how.bundle)]
    bundles = blocks.select(F.explode(F.sequence(F.lit(0), F.lit(len(wanted) - 1))).alias("bundle"), "block")
    for name in LISTS:
        bundles = bundles.withColumn(name, F.lit(b""))
    for stage in range(how.stages - 1):
        bundles = _owner_stage(bundles, postings_of(blocks, stage, owner, wanted, documents, length, False), items, weights, how)
    best = _last_stage(bundles, postings_of(blocks, how.stages - 1, owner, wanted, documents, length, True), items, weights, how)
    # Spark keeps the best of each task before it shuffles, as the rank is limited.
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= how.best)
    names = docs.sparkSession.createDataFrame(list(enumerate(items.ids)), f"item int, item_id {kind}")
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")
