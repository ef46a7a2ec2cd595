"""Line dedup: repeated lines are known from a sharded minimal perfect hash, whose slots index arrays of fingerprints, counts and holders.

Lines are known by 128 bits of hash. Those that enough documents hold are dealt to shards; each shard has a minimal perfect hash (levels of bit
arrays: a line whose bit no other line of its level wants gets it, the rest go on to the next level; a line's slot is the rank of its
bit) and three arrays by slot. Documents probe the arrays line by line: the fingerprint at the slot tells whether the line is known at all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import stored

#: What is stripped from both ends of a line, in UTF-8.
BLANKS = b" \t\n\x0b\x0c\r"
#: Stands for a null id, below every other.
NO_ID = -(1 << 63)
MANY = (1 << 32) - 1


@dataclass(frozen=True)
class Settings:
    """Lines of `least_chars` code points or more, in `least_documents` documents or more, are repeated."""

    least_chars: int = 40
    least_documents: int = 5
    #: Lines in a shard, and probes that a shard is asked at most on average.
    shard_lines: int = 1 << 18
    shard_probes: int = 1 << 21
    #: Bytes of arrays up to which every task holds all shards. Beyond, probes travel to the shards.
    budget: int = 64 << 20
    #: Bytes of text, and documents, that send their probes together.
    batch_bytes: int = 8 << 20
    batch_rows: int = 4096


def long_keys(text: bytes, least_chars: int) -> Iterator[tuple[int, bytes]]:
    """Number and key of each line whose key is long enough: stripped, A-Z lower-cased (bytes.lower changes no others)."""
    for number, line in enumerate(text.lower().split(b"\n")):
        key = line.strip(BLANKS)
        # A code point takes one to four bytes.
        if len(key) >= least_chars and (len(key) >= 4 * least_chars or len(key.decode()) >= least_chars):
            yield number, key


def hashes(keys: list[bytes]) -> np.ndarray:
    """Two columns of 64 bits for each key."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), "<u8").reshape(-1, 2)


def _grouped(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal rows together, and where each group starts."""
    order = np.lexsort((found[:, 1], found[:, 0]))
    ordered = found[order]
    return order, np.flatnonzero(np.r_[True, (ordered[1:] != ordered[:-1]).any(1)][: len(found)])


def _ids(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)


def _texts(docs: DataFrame, *keep: str) -> DataFrame:
    return docs.select(*keep, F.coalesce("text", F.lit("")).cast("binary").alias("_text"))


def line_counts(docs: DataFrame, how: Settings) -> DataFrame:
    """`first`, `second` (the hash), `documents` and `holder` (the greatest doc_id, NO_ID if all are null) of every distinct long line."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, owner = _ids(batch["doc_id"]), [], []
            for at, text in enumerate(batch["_text"]):
                own = {key for _, key in long_keys(text.as_py(), how.least_chars)}
                keys += own
                owner += [at] * len(own)
            if keys:
                found = hashes(keys)
                order, starts = _grouped(found)
                first = found[order][starts].view("<i8")
                held = np.diff(np.r_[starts, len(order)])
                columns = [first[:, 0], first[:, 1], held, np.maximum.reduceat(ids[np.array(owner)][order], starts)]
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], ["first", "second", "documents", "holder"])

    found = _texts(docs, "doc_id").mapInArrow(count, "first long, second long, documents long, holder long")
    return found.groupBy("first", "second").agg(F.sum("documents").alias("documents"), F.max("holder").alias("holder"))


def mixed(found: np.ndarray, salt: int) -> np.ndarray:
    """64 bits from both columns, others for each salt."""
    z = found[:, 0] ^ (found[:, 1] + np.uint64(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xD6E8FEB86659FD93)
    z = (z ^ (z >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return z ^ (z >> np.uint64(29))


@dataclass(frozen=True)
class Slots:
    """A minimal perfect hash: `sizes` of the levels in words of 64 bits, and their words."""

    sizes: np.ndarray
    words: np.ndarray

    @staticmethod
    def build(found: np.ndarray, spread: float = 2.0) -> Slots:
        """For distinct rows of hashes; `spread` is the number of bits of a level for each line that is left."""
        sizes, words = [], []
        left = found
        while len(left):
            size = max(1, int(np.ceil(spread * len(left) / 64)))
            place = mixed(left, len(sizes)) % np.uint64(64 * size)
            alone = np.bincount(place.astype(np.int64), minlength=64 * size) == 1
            sizes.append(size)
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[place.astype(np.int64)]]
        return Slots(np.array(sizes, "<u4"), np.concatenate(words) if words else np.zeros(0, "<u8"))

    def slots(self, found: np.ndarray) -> np.ndarray:
        """The slot of each row. Rows that the hash was not built from get any slot, or -1."""
        before = np.r_[0, np.cumsum(np.bitwise_count(self.words), dtype=np.int64)]
        out = np.full(len(found), -1, np.int64)
        open_rows, start = np.arange(len(found)), 0
        for level, size in enumerate(self.sizes.tolist()):
            place = mixed(found[open_rows], level) % np.uint64(64 * size)
            word, bit = (place >> np.uint64(6)).astype(np.int64) + start, place & np.uint64(63)
            held = self.words[word]
            hit = (held >> bit) & np.uint64(1) == 1
            lower = held & ((np.uint64(1) << bit) - np.uint64(1))
            out[open_rows[hit]] = (before[word] + np.bitwise_count(lower))[hit]
            open_rows, start = open_rows[~hit], start + size
        return out


#: A shard as a row. `fingerprints` are 64 bits, so that none of 10^12 unknown lines is likely to pass; counts stop at 2^32 - 1.
SHARD = "shard int, shards int, sizes binary, words binary, fingerprints binary, counts binary, holders binary"


def _shard_row(found: np.ndarray, documents: np.ndarray, holders: np.ndarray) -> list[bytes]:
    slots = Slots.build(found)
    order = np.argsort(slots.slots(found))
    arrays = [slots.sizes, slots.words, found[order, 1], np.minimum(documents[order], MANY).astype("<u4"), holders[order].astype("<i8")]
    return [a.tobytes() for a in arrays]


class Index:
    """Shards that a task holds, by number."""

    def __init__(self, rows: list[tuple]):
        self.shards = rows[0][1] if rows else 1
        self.held = {
            row[0]: (Slots(np.frombuffer(row[2], "<u4"), np.frombuffer(row[3], "<u8")), np.frombuffer(row[4], "<u8"), np.frombuffer(row[5], "<u4"), np.frombuffer(row[6], "<i8"))
            for row in rows
        }

    def probe(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents that hold each line, 0 for unknown lines, and the greatest doc_id among them."""
        documents, holders = np.zeros(len(found), np.int64), np.full(len(found), NO_ID, np.int64)
        of = shard_of(found, self.shards)
        for shard, (slots, fingerprints, counts, greatest) in self.held.items():
            rows = np.flatnonzero(of == shard)
            slot = slots.slots(found[rows])
            rows, slot = rows[slot >= 0], slot[slot >= 0]
            known = fingerprints[slot] == found[rows, 1]
            documents[rows[known]], holders[rows[known]] = counts[slot[known]], greatest[slot[known]]
        return documents, holders


def shard_of(found: np.ndarray, shards: int) -> np.ndarray:
    return ((found[:, 0] >> np.uint64(1)) % np.uint64(shards)).astype(np.int64)


def build_index(docs: DataFrame, how: Settings | None = None) -> DataFrame:
    """The stored shards over the lines that enough documents hold; other lines can never be dropped and have no slot.

    The number of shards follows the lines in them and the probes they will get, so that a shard stays small however large the corpus is.
    """
    how = how or Settings()
    seen = Observation()
    counted = line_counts(docs, how).observe(seen, F.coalesce(F.sum("documents"), F.lit(0)).alias("probes"), F.count_if(F.col("documents") >= how.least_documents).alias("lines"))
    repeated = stored(counted.where(F.col("documents") >= how.least_documents), "lines")
    shards = max(1, -(-seen.get["lines"] // how.shard_lines), -(-seen.get["probes"] // how.shard_probes))

    def build(lines: pa.Table) -> pa.Table:
        found = np.stack([lines[name].to_numpy().view("<u8") for name in ("first", "second")], 1)
        shard = int(lines["shard"][0].as_py())
        row = _shard_row(found, lines["documents"].to_numpy(), lines["holder"].to_numpy())
        columns = [pa.array([shard], pa.int32()), pa.array([shards], pa.int32()), *(pa.array([data], pa.binary()) for data in row)]
        return pa.Table.from_arrays(columns, ["shard", "shards", "sizes", "words", "fingerprints", "counts", "holders"])

    # The upper 63 bits of the first hash, as in `shard_of`.
    number = F.pmod(F.shiftrightunsigned("first", 1), F.lit(shards)).cast("int")
    return stored(repeated.withColumn("shard", number).groupBy("shard").applyInArrow(build, SHARD), "shards")


#: From hashes to the documents that hold each line and the greatest doc_id among them.
Probe = Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]
RESULT = ["n_lines", "n_dropped", "_kept"]


def _cut(text: bytes, dropped: set[int]) -> tuple[int, int, bytes]:
    lines = text.split(b"\n")
    return len(lines), len(dropped), b"\n".join(line for i, line in enumerate(lines) if i not in dropped) if dropped else text


def _outcome(batch: pa.RecordBatch | pa.Table, keep: tuple[str, ...], probe: Probe, how: Settings) -> list:
    """Columns `keep` and RESULT of the documents of a batch, the answers being those of `probe`."""
    ids, texts = _ids(batch["_id"]), [text.as_py() for text in batch["_text"]]
    keys, where = [], []
    for at, text in enumerate(texts):
        for number, key in long_keys(text, how.least_chars):
            keys.append(key)
            where.append((at, number))
    dropped: list[set[int]] = [set() for _ in texts]
    if keys:
        documents, holders = probe(hashes(keys))
        owner = ids[np.array([at for at, _ in where])]
        for i in np.flatnonzero((documents >= how.least_documents) & (holders != owner)).tolist():
            at, number = where[i]
            dropped[at].add(number)
    done = [_cut(text, own) for text, own in zip(texts, dropped, strict=True)]
    columns = [batch[name] for name in keep]
    columns += [pa.array([row[i] for row in done], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.binary()))]
    return columns


def drop_repeated_lines(docs: DataFrame, index: DataFrame, keep: tuple[str, ...] = ("doc_id",), how: Settings | None = None) -> DataFrame:
    """The columns `keep` of `docs`, `n_lines`, `n_dropped` and `kept_text`: the lines left, joined by newlines.

    A line is dropped if its key (stripped, A-Z lower-cased) has `how.least_chars` code points, `how.least_documents` documents hold it, and its
    document's doc_id is not the greatest of them. A null or empty text is one empty line. Each row is a document; rows that share the greatest
    id all keep the line, and a null id is below all others. Up to `how.budget` bytes of arrays, measured, go to every task and no text is
    shuffled; larger indexes are probed shard by shard.
    """
    how = how or Settings()
    size = sum((F.octet_length(name) for name in ("words", "fingerprints", "counts", "holders")), F.lit(0))
    held = index.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    texts = _texts(docs, *keep, F.col("doc_id").alias("_id"))
    kinds = dict(texts.dtypes)
    schema = ", ".join(f"`{name}` {kinds[name]}" for name in keep) + ", n_lines long, n_dropped long, _kept binary"
    if held <= how.budget:
        done = _probe_held(texts, index, keep, how, schema)
    else:
        done = _probe_by_shard(texts, index, keep, how, schema)
    return done.select(*keep, "n_lines", "n_dropped", F.col("_kept").cast("string").alias("kept_text"))


def _probe_held(texts: DataFrame, index: DataFrame, keep: tuple[str, ...], how: Settings, schema: str) -> DataFrame:
    rows = texts.sparkSession.sparkContext.broadcast([tuple(row) for row in index.collect()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = Index(rows.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(_outcome(batch, keep, shards.probe, how), [*keep, *RESULT])

    return texts.mapInArrow(run, schema)


def _probe_by_shard(texts: DataFrame, index: DataFrame, keep: tuple[str, ...], how: Settings, schema: str) -> DataFrame:
    """Batches of documents ask each shard once for every distinct line, and get back what it knows of them.

    A line that a third of all documents hold costs one probe a batch, and a shard of bounded size answers.
    """
    fields = ", ".join(f"`{name}` {kind}" for name, kind in texts.dtypes)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, rows, size, task = 0, 0, 0, TaskContext.get().partitionId()
        for batch in batches:
            numbers = []
            for text in batch["_text"]:
                if rows and (rows == how.batch_rows or size + len(text.as_buffer()) > how.batch_bytes):
                    count, rows, size = count + 1, 0, 0
                rows, size = rows + 1, size + len(text.as_buffer())
                numbers.append(task << 32 | count)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64())], [*batch.schema.names, "_batch"])

    # Stored, since the numbers must not change if a task is run again.
    batched = stored(texts.mapInArrow(number, f"{fields}, _batch long"), "batches")
    shards = max(1, index.agg(F.max("shards")).first()[0] or 1)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch["_batch"].to_numpy()
            for name in np.unique(names).tolist():
                own = [batch["_text"][at].as_py() for at in np.flatnonzero(names == name).tolist()]
                found = hashes(list({key for text in own for _, key in long_keys(text, how.least_chars)}))
                of = shard_of(found, shards)
                asked = np.unique(of)
                lines = [found[of == shard].tobytes() for shard in asked]
                columns = [pa.array(asked.astype(np.int32)), pa.array([name] * len(asked), pa.int64()), pa.array(lines, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["shard", "_batch", "lines"])

    def answer(asked: pa.Table, held: pa.Table) -> pa.Table:
        shard = Index([tuple(row.values()) for row in held.to_pylist()])
        names, lines, holders = [], [], []
        for name, packed in zip(asked["_batch"].to_pylist(), asked["lines"].to_pylist(), strict=True):
            found = np.frombuffer(packed, "<u8").reshape(-1, 2)
            documents, greatest = shard.probe(found)
            repeated = documents >= how.least_documents
            if repeated.any():
                names.append(name)
                lines.append(found[repeated].tobytes())
                holders.append(greatest[repeated].astype("<i8").tobytes())
        return pa.Table.from_arrays([pa.array(names, pa.int64()), pa.array(lines, pa.binary()), pa.array(holders, pa.binary())], ["_batch", "lines", "holders"])

    def cut(docs: pa.Table, answers: pa.Table) -> pa.Table:
        known: dict[bytes, int] = {}
        for lines, holders in zip(answers["lines"].to_pylist(), answers["holders"].to_pylist(), strict=True):
            known |= zip((lines[i : i + 16] for i in range(0, len(lines), 16)), np.frombuffer(holders, "<i8").tolist(), strict=True)

        def probe(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            packed = found.tobytes()
            own = [known.get(packed[i : i + 16]) for i in range(0, len(packed), 16)]
            return np.array([0 if x is None else how.least_documents for x in own]), np.array([NO_ID if x is None else x for x in own])

        return pa.Table.from_arrays(_outcome(docs, keep, probe, how), [*keep, *RESULT])

    requests = batched.select("_batch", "_text").mapInArrow(ask, "shard int, _batch long, lines binary")
    answers = requests.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(answer, "_batch long, lines binary, holders binary")
    return batched.groupBy("_batch").cogroup(answers.groupBy("_batch")).applyInArrow(cut, schema)


def dedup_lines(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), how: Settings | None = None) -> DataFrame:
    """`drop_repeated_lines` by the lines of `docs` themselves."""
    return drop_repeated_lines(docs, build_index(docs, how), keep, how)
