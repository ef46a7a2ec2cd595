"""Vector code compression: product quantization in exact integers, its distances from limb-split float64 matrix products.

A vector's components become integers, its parts are compared with a codebook each. |x - c|^2 = |x|^2 - 2 x.c + |c|^2, and x.c comes from BLAS: the
integers are broken into limbs so narrow that a float64 product of limbs, summed over a part, stays below 2^53 and is therefore exact; the
limbs' products are put together in int64. So equal distances are equal, and the first least one is the code.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import salted_join, stored

#: Vectors that are stored, and multiplied, as one matrix.
ROWS = 4096


@dataclass(frozen=True)
class Settings:
    """`scale` turns components into integers, rounded down; `entries` of each codebook, at most 256, so that a code is two digits."""

    scale: int = 4096
    parts: int = 8
    entries: int = 16
    rounds: int = 6


def limbs(numbers: np.ndarray, width: int) -> list[np.ndarray]:
    """float64 matrices with numbers = sum of limb[i] * 2^(i * width); only the last limb has a sign."""
    split, rest = [], numbers
    while rest.size and (rest.max() >= 1 << width or rest.min() < -(1 << width)):
        split.append((rest & ((1 << width) - 1)).astype(np.float64))
        rest = rest >> width
    return [*split, rest.astype(np.float64)]


def exact_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """`left @ right.T` of int64 matrices, exact where the result fits int64."""
    width = (53 - max(1, left.shape[1]).bit_length()) // 2
    total = np.zeros((len(left), len(right)), np.int64)
    others = limbs(right, width)
    for i, a in enumerate(limbs(left, width)):
        for j, b in enumerate(others):
            total += (a @ b.T).astype(np.int64) << (width * (i + j))
    return total


def nearest(rows: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry for each row, of equally near ones the first, and its squared distance."""
    distances = (rows * rows).sum(1)[:, None] - 2 * exact_products(rows, book) + (book * book).sum(1)
    best = distances.argmin(1)
    return best, distances[np.arange(len(rows)), best]


def greatest(dim: int) -> int:
    """Components up to this leave every squared distance of two vectors within int64."""
    return int(((1 << 61) // max(1, dim)) ** 0.5) - 1


def sums_by_entry(rows: np.ndarray, best: np.ndarray, entries: int) -> np.ndarray:
    """Componentwise sums of the rows of each entry, by the same limb products."""
    chosen = np.zeros((entries, len(rows)), np.int64)
    chosen[best, np.arange(len(rows))] = 1
    return exact_products(chosen, np.ascontiguousarray(rows.T))


def _integers(values: np.ndarray, how: Settings, ids: pa.Array) -> np.ndarray:
    whole = np.floor(values.astype(np.float64) * how.scale)
    over = np.abs(whole).max(1, initial=0) > greatest(values.shape[1])
    if over.any():
        raise ValueError(f"components of vector {ids[int(np.flatnonzero(over)[0])]} are too large for distances in 64 bits")
    return whole.astype(np.int64)


def _usable(dim: int | None = None):
    """Whether a vector counts: no null or non-finite component, and `dim` components."""
    # Infinities and NaN are the values whose difference to themselves is not zero.
    fine = F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & (x - x == 0))
    return fine if dim is None else fine & (F.size("embedding") == dim)


def first_vectors(vectors: DataFrame, how: Settings) -> np.ndarray | None:
    """The first codebook vectors as a matrix, or None without any vector. Bounded by `how.entries` rows."""
    order = (F.col("vec_id").asc_nulls_last(), F.col("embedding"))

    def least(dim: int | None) -> list:
        return vectors.where(_usable(dim)).select("vec_id", "embedding").orderBy(*order).limit(how.entries).collect()

    rows = least(None)
    if not rows:
        return None
    dim = len(rows[0].embedding)
    if dim % how.parts:
        raise ValueError(f"vectors of {dim} components cannot be cut into {how.parts} equal parts")
    if any(len(row.embedding) != dim for row in rows):
        rows = least(dim)
    values = np.array([row.embedding for row in rows], np.float64).reshape(len(rows), dim)
    return _integers(values, how, pa.array([row.vec_id for row in rows]))


def as_integers(vectors: DataFrame, dim: int, how: Settings) -> DataFrame:
    """Rows of up to ROWS vectors each: lists `vec_ids` and `labels`, and `numbers`, their packed matrix of integers."""
    chosen = vectors.select("vec_id", "label", "embedding")
    kinds = dict(chosen.dtypes)
    schema = f"vec_ids array<{kinds['vec_id']}>, labels array<{kinds['label']}>, numbers binary"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                part = batch.slice(begin, ROWS)
                part = part.filter(pc.equal(pc.list_value_length(part["embedding"]), dim).fill_null(False))
                values = part["embedding"].flatten()
                fine = pc.is_finite(values).fill_null(False).to_numpy(zero_copy_only=False).reshape(-1, dim).all(1) if dim else np.ones(part.num_rows, bool)
                matrix = values.to_numpy(zero_copy_only=False).reshape(part.num_rows, dim)[fine]
                part = part.filter(pa.array(fine))
                if part.num_rows:
                    numbers = _integers(matrix, how, part["vec_id"]).astype("<i8")
                    lists = [pa.array([part[name].to_pylist()], pa.list_(part[name].type)) for name in ("vec_id", "label")]
                    yield pa.RecordBatch.from_arrays([*lists, pa.array([numbers.tobytes()], pa.binary())], ["vec_ids", "labels", "numbers"])

    return chosen.mapInArrow(pack, schema)


def _matrices(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1)
            yield row, np.frombuffer(row["numbers"][0].as_buffer(), "<i8").reshape(-1, dim) if dim else np.zeros((len(row["vec_ids"][0]), 0), np.int64)


def refined(packed: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks (part, entry, component) after one round: each entry becomes the rounded-down mean of its parts.

    A task gives one sum per codebook number, whatever its rows; the sums are added exactly, as decimals. Only the codebooks pass the driver.
    """
    parts, entries, size = books.shape

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals = np.zeros((parts, entries), np.int64), np.zeros(books.shape, np.int64)
        for _, rows in _matrices(batches, parts * size):
            for p in range(parts):
                own = rows[:, p * size : (p + 1) * size]
                best, _ = nearest(own, books[p])
                counts[p] += np.bincount(best, minlength=entries)
                totals[p] += sums_by_entry(own, best, entries)
        place = np.flatnonzero(np.repeat(counts.ravel() > 0, size))
        arrays = [place.astype(np.int32), totals.ravel()[place], np.repeat(counts.ravel(), size)[place]]
        yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["place", "total", "held"])

    sums = packed.select("vec_ids", "numbers").mapInArrow(partial, "place int, total long, held long").groupBy("place")
    new = books.copy().ravel()
    for place, total, held in sums.agg(F.sum(F.col("total").cast("decimal(28,0)")), F.sum("held")).collect():
        new[place] = int(total) // held
    return new.reshape(books.shape)


def codebooks(vectors: DataFrame, how: Settings | None = None) -> tuple[DataFrame, np.ndarray] | None:
    """The vectors as stored integers, and the trained codebooks; None without any vector."""
    how = how or Settings()
    first = first_vectors(vectors, how)
    if first is None:
        return None
    packed = stored(as_integers(vectors, first.shape[1], how), "vectors")
    books = np.ascontiguousarray(first.reshape(len(first), how.parts, -1).transpose(1, 0, 2))
    for _ in range(how.rounds):
        books = refined(packed, books)
    return packed, books


def assigned(packed: DataFrame, books: np.ndarray) -> DataFrame:
    """`vec_id`, `label`, `code` and `error` of every stored vector under the codebooks."""
    parts, _, size = books.shape
    kinds = {f.name: f.dataType.elementType.simpleString() for f in packed.schema.fields if isinstance(f.dataType, T.ArrayType)}

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, rows in _matrices(batches, parts * size):
            found = [nearest(rows[:, p * size : (p + 1) * size], books[p]) for p in range(parts)]
            digits = np.stack([best for best, _ in found], 1).astype(np.uint8).tobytes().hex()
            codes = [digits[i : i + 2 * parts] for i in range(0, len(digits), 2 * parts)]
            error = sum(distance for _, distance in found)
            columns = [row["vec_ids"].flatten(), row["labels"].flatten(), pa.array(codes), pa.array(error)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error"])

    return packed.mapInArrow(code, f"vec_id {kinds['vec_ids']}, label {kinds['labels']}, code string, error long")


def digest(books: np.ndarray) -> str:
    """SHA-256 of all numbers by part, entry and position, as decimals with commas between them."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, how: Settings | None = None) -> DataFrame:
    """`vec_id`, `code`, `error`, `label_error` and `codebooks_sha256` of every vector of `vectors` (vec_id, embedding, label).

    Left out are null vectors, those with a null or non-finite component, and those with another number of components than the one of least
    vec_id. Codebooks start from the vectors of least vec_id, null ids last, rows of one id by their components; with fewer vectors than entries they
    are so much smaller. Repeated rows count each. A vector too large for distances in 64 bits fails the job with its id, and so do vectors that cannot
    be cut evenly. An empty table gives no rows. `label_error` sums `error` over equal labels, nulls together. Vectors are shuffled for that sum only,
    as codes; rows of a label are spread over tasks.
    """
    kinds = dict(vectors.dtypes)
    trained = codebooks(vectors, how)
    if trained is None:
        empty = f"vec_id {kinds['vec_id']}, code string, error long, label_error long, codebooks_sha256 string"
        return vectors.sparkSession.createDataFrame([], empty)
    packed, books = trained
    coded = stored(assigned(packed, books), "codes")
    no_label = F.lit(0).cast(kinds["label"])
    coded = coded.withColumn("_known", F.col("label").isNotNull()).withColumn("_label", F.coalesce("label", no_label))
    sums = coded.groupBy("_label", "_known").agg(F.sum("error").alias("label_error"))
    rows = salted_join(coded, sums, ["_label", "_known"], F.struct("vec_id", "code"))
    return rows.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
