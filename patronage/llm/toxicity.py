"""Toxicity by a factorization machine over hashed terms.

score = sigmoid(b + sum of w_i + sum over pairs of <v_i, v_j>) over the distinct known terms of a text (words and beginnings of words), whatever its length
or language. The pairs are learned, so two terms that are harmless alone can be toxic together, and the other way round.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

TERM = re.compile(r"[^\W\d_]+")
#: Lengths of the beginnings that are terms of their own, so that inflected and compound forms of a stem share some.
STEMS = range(3, 8)
#: Words that a worker remembers, in each of two generations.
REMEMBERED = 1 << 16


def hashes(word: str) -> list[int]:
    """63 bits for a word and for each of its beginnings; unrelated terms practically never share them."""
    parts = [word, *(f"{word[:size]}*" for size in STEMS if size < len(word))]
    return [xxhash.xxh3_64_intdigest(part.encode("utf-8", "surrogatepass")) >> 1 for part in parts]


class Buckets(dict):
    """Word to its terms: the hashes, or with `known` the numbers of those that are in it. Memory stays constant whatever is read."""

    def __init__(self, known: dict[int, int] | None = None):
        super().__init__()
        self.known, self.older = known, {}

    def __missing__(self, word: str) -> tuple[int, ...]:
        found = self.older.get(word)
        if found is None:
            own = hashes(word)
            found = tuple(own if self.known is None else [self.known[h] for h in own if h in self.known])
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[word] = found
        return found


def terms(text: str, buckets: Buckets) -> set[int]:
    """Terms of the distinct words of a text."""
    return set(chain.from_iterable(map(buckets.__getitem__, set(TERM.findall(text.lower())))))


@dataclass(frozen=True)
class Training:
    """Parameters of a fit. `max_rows` bounds the labelled rows that are used, those least in a hash of their id: of the rarer label up to half."""

    max_rows: int = 12_000
    #: A term is known from this likelihood ratio (twice the logarithm) between label and term on, as chance reaches it about once in 100,000 terms;
    #: of more than `max_terms` those of the highest.
    least_ratio: float = 20.0
    max_terms: int = 4096
    factors: int = 4
    #: Penalties on squares that the folds choose from.
    ridges: tuple[float, ...] = (3.0, 1.0, 0.3, 0.1)
    folds: int = 4
    rounds: int = 100


@dataclass(frozen=True)
class Machine:
    """A fitted machine: bias, and for each known term (by hash) its weight and factors, as small as what was learned."""

    bias: float
    weights: dict[int, tuple[float, np.ndarray]] = field(default_factory=dict)

    def scorer(self) -> Callable[[str], float]:
        """Function from text to score, which remembers words."""
        buckets = Buckets({h: i for i, h in enumerate(self.weights)})
        single = np.array([w for w, _ in self.weights.values()])
        factors = np.array([v for _, v in self.weights.values()])

        def score(text: str) -> float:
            found = sorted(terms(text, buckets))
            total = self.bias
            if found:
                rows = factors[found]
                total += float(single[found].sum()) + 0.5 * float((rows.sum(0) ** 2 - (rows**2).sum(0)).sum())
            return float(1 / (1 + np.exp(-np.clip(total, -40, 40))))

        return score


class _Rows:
    """Different lists of term numbers, as arrays, with how often each is held and how often with label 1; value and slope of the penalised
    log loss at given parameters."""

    def __init__(self, rows: list[np.ndarray], held: np.ndarray, bad: np.ndarray, size: int, factors: int):
        self.n, self.size, self.factors, self.held, self.bad = len(rows), size, factors, held, bad
        self.column = np.concatenate(rows) if rows else np.zeros(0, int)
        self.of = np.repeat(np.arange(self.n), [len(r) for r in rows])

    def totals(self, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        """Each row's sum before the sigmoid, and its sums of factors if `theta` has factors."""
        w = theta[1 : 1 + self.size]
        total = theta[0] + np.bincount(self.of, w[self.column], self.n)
        if len(theta) == 1 + self.size:
            return total, None
        v = theta[1 + self.size :].reshape(self.size, self.factors)
        sums = np.stack([np.bincount(self.of, v[self.column, k], self.n) for k in range(self.factors)], 1)
        return total + 0.5 * ((sums**2).sum(1) - np.bincount(self.of, (v**2).sum(1)[self.column], self.n)), sums

    def _loss(self, total: np.ndarray) -> float:
        return float((self.held * np.logaddexp(0, total) - self.bad * total).sum())

    def _excess(self, total: np.ndarray) -> np.ndarray:
        return self.held / (1 + np.exp(-np.clip(total, -40, 40))) - self.bad

    def loss(self, theta: np.ndarray) -> float:
        return self._loss(self.totals(theta)[0])

    def slope(self, theta: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
        total, sums = self.totals(theta)
        penalty = np.r_[0.0, theta[1:]]
        value, residual = self._loss(total) + 0.5 * ridge * float(penalty @ penalty), self._excess(total)
        own = residual[self.of]
        grad = [[residual.sum()], np.bincount(self.column, own, self.size)]
        if sums is not None:
            v = theta[1 + self.size :].reshape(self.size, self.factors)
            pull = [np.bincount(self.column, own * (sums[self.of, k] - v[self.column, k]), self.size) for k in range(self.factors)]
            grad.append(np.stack(pull, 1).ravel())
        return value, np.concatenate(grad) + ridge * penalty

    def left_over(self, theta: np.ndarray) -> np.ndarray:
        """First factors: the leading directions of what pairs of terms have in common beyond the single terms' score. No noise, so no seed."""
        residual = -self._excess(self.totals(theta)[0])
        scale = 1 / np.sqrt(np.maximum(np.bincount(self.column, minlength=self.size), 1))
        alone = np.bincount(self.column, residual[self.of], self.size) * scale**2

        def common(v: np.ndarray) -> np.ndarray:
            """Product with the table of what two terms have in common: the sum of what is left over in the rows that hold both."""
            entries = (scale[:, None] * v)[self.column]
            met = np.stack([np.bincount(self.of, entries[:, k], self.n) for k in range(v.shape[1])], 1) * residual[:, None]
            back = met[self.of]
            return scale[:, None] * np.stack([np.bincount(self.column, back[:, k], self.size) for k in range(v.shape[1])], 1) - alone[:, None] * v

        width = min(self.factors, self.size)
        v = np.linalg.qr(np.cos(np.outer(np.arange(1, self.size + 1), np.arange(1, width + 1))))[0]
        for turn in range(40):  # first the largest size of a direction, which then makes all that count positive
            if turn == 10:
                shift = float(np.abs(v.T @ common(v)).max())
            v = np.linalg.qr(common(v) + (shift * v if turn >= 10 else 0))[0]
        value = np.maximum(np.diag(v.T @ common(v)), 1e-3)
        first = np.zeros((self.size, self.factors))
        first[:, :width] = v * np.sqrt(value)
        return 0.3 * first


def minimise(slope: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, rounds: int, kept: int = 10) -> np.ndarray:
    """Limited-memory BFGS with steps halved until the value falls."""
    x, (value, grad) = start, slope(start)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        way, scales = -grad, []
        for s, y in reversed(steps):
            scales.append((s @ way) / (y @ s))
            way = way - scales[-1] * y
        if steps:
            s, y = steps[-1]
            way = way * ((s @ y) / (y @ y))
        else:
            way = way / max(1.0, float(np.abs(grad).max()))
        for (s, y), scale in zip(steps, reversed(scales), strict=True):
            way = way + (scale - (y @ way) / (y @ s)) * s
        fall, length = float(grad @ way), 1.0
        if fall > -1e-5 * max(1.0, abs(value)):
            break
        while True:
            new = x + length * way
            new_value, new_grad = slope(new)
            if new_value <= value + 1e-4 * length * fall or length < 1e-8:
                break
            length *= 0.5
        if new_value >= value:
            break
        if (new_grad - grad) @ (new - x) > 1e-12:
            steps = [*steps, (new - x, new_grad - grad)][-kept:]
        x, value, grad = new, new_value, new_grad
    return x


def _single(rows: _Rows, ridge: float, how: Training) -> np.ndarray:
    """Bias and weights of single terms, at convergence."""
    return minimise(lambda theta: rows.slope(theta, ridge), np.zeros(1 + rows.size), how.rounds)


def _paired(rows: _Rows, single: np.ndarray, ridge: float, how: Training) -> np.ndarray:
    """All parameters of the machine, from those of single terms on, under the same penalty."""
    return minimise(lambda theta: rows.slope(theta, ridge), np.r_[single, rows.left_over(single).ravel()], how.rounds)


def fit(known: np.ndarray, rows: list[np.ndarray], labels: np.ndarray, how: Training | None = None, shift: float = 0.0, pairs: bool | None = None) -> Machine:
    """Learns from lists of numbers of `known` terms (hashes).

    Single terms are fitted first, to convergence, under the penalty with the least loss over folds of the rows; equal lists fall into one fold. Then pairs are
    added and all is fitted on; they stay if that lowers the loss over the folds (`pairs` decides instead, if given). Nothing is random. `shift`
    is added to the bias: the logarithm of how much rarer label 1 is outside the sample. Without both labels the machine is the smoothed base rate,
    without any a score under a half.
    """
    how, n = how or Training(), len(rows)
    base = (float(labels.sum()) + 0.5) / (n + 2)
    if n == 0 or labels.min() == labels.max() or not len(known):
        return Machine(float(np.log(base / (1 - base))) + shift)
    counts: dict[bytes, list[float]] = {}
    for row, label in zip(rows, labels.tolist(), strict=True):
        of = counts.setdefault(np.asarray(row, "<i4").tobytes(), [0.0, 0.0])
        of[0], of[1] = of[0] + 1, of[1] + label
    lists, times = [np.frombuffer(packed, "<i4") for packed in counts], np.array(list(counts.values()))
    own = np.array([zlib.crc32(packed) % how.folds for packed in counts])
    make = lambda chosen: _Rows([lists[i] for i in np.flatnonzero(chosen)], *times[chosen].T, len(known), how.factors)
    splits = [(make(own != f), make(own == f)) for f in range(how.folds) if 0 < (own == f).sum() < len(own)]
    lost = {ridge: [(_single(train, ridge, how), train, test) for train, test in splits] for ridge in how.ridges}
    score = {ridge: sum(test.loss(theta) for theta, _, test in fits) for ridge, fits in lost.items()}
    ridge = min(how.ridges, key=lambda r: (score[r], -r))
    if pairs is None:
        paired = sum(test.loss(_paired(train, theta, ridge, how)) for theta, train, test in lost[ridge])
        pairs = paired < score[ridge]
    whole = make(np.ones(len(own), bool))
    theta = _single(whole, ridge, how)
    w, v = theta[1:], np.zeros((len(known), how.factors))
    if pairs:
        theta = _paired(whole, theta, ridge, how)
        w, v = theta[1 : 1 + len(known)], theta[1 + len(known) :].reshape(len(known), how.factors)
    return Machine(float(theta[0]) + shift, {int(h): (float(a), b) for h, a, b in zip(known.tolist(), w, v, strict=True)})


def fold(doc_id: Column) -> Column:
    """Remainder by 5 of the checksum of the id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def _sample(labels: DataFrame, how: Training) -> tuple[DataFrame, float]:
    """Labelled ids outside fold 0 with their label, and the logarithm of how much rarer label 1 is than in the sample."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(fold(F.col("doc_id")) != 0)
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    held = dict(known.groupBy("toxic").count().collect())
    rarer = min((0, 1), key=lambda label: held.get(label, 0))
    taken = {rarer: min(held.get(rarer, 0), how.max_rows // 2)}
    taken[1 - rarer] = min(held.get(1 - rarer, 0), how.max_rows - taken[rarer])
    parts = [known.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(size) for label, size in sorted(taken.items())]
    share = [taken[label] / held[label] if held.get(label) else 1.0 for label in (0, 1)]
    return parts[0].unionByName(parts[1]), float(np.log(share[0] / share[1]))


def _known_terms(text: DataFrame, how: Training) -> np.ndarray:
    """Hashes of the terms that go with the label, counted over the whole sample where it lies."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        buckets = Buckets()
        for batch in batches:
            found = [np.fromiter(terms(t, buckets), np.int64) for t in batch["text"]]
            flat, toxic = np.concatenate([np.zeros(0, np.int64), *found]), np.repeat(batch["toxic"].to_numpy(), [len(f) for f in found])
            term, at = np.unique(flat, return_inverse=True)
            yield pd.DataFrame({"term": term, "held": np.bincount(at, minlength=len(term)), "bad": np.bincount(at, toxic, len(term)).astype(np.int64)})

    counted = text.mapInPandas(count, "term long, held long, bad long").groupBy("term").agg(F.sum("held").alias("held"), F.sum("bad").alias("bad"))
    rows, bad = text.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    if not bad or bad == rows:
        return np.zeros(0, np.int64)
    entropy = lambda x: F.when(x > 0, x * F.log(x)).otherwise(0.0)
    n, t = F.col("held").cast("double"), F.col("bad").cast("double")
    cells = entropy(t) + entropy(n - t) + entropy(bad - t) + entropy(rows - n - (bad - t))
    margins = entropy(n) + entropy(rows - n) + float(bad * np.log(bad) + (rows - bad) * np.log(rows - bad) - rows * np.log(rows))
    ratio = (2 * (cells - margins)).alias("ratio")
    best = counted.select("term", ratio).filter(F.col("ratio") >= how.least_ratio).orderBy(F.desc("ratio"), "term").limit(how.max_terms)
    return np.array(sorted(row["term"] for row in best.collect()), np.int64)


def labelled_terms(docs: DataFrame, labels: DataFrame, how: Training | None = None) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, float]:
    """Known terms, the numbers of those in each sampled text, its label, and the shift of the bias."""
    how = how or Training()
    sample, shift = _sample(labels, how)  # `how.max_rows` is the bound of the broadcast
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
    text = stored(text.groupBy("doc_id").agg(F.max("text").alias("text"), F.max("toxic").alias("toxic")), "labelled")
    known = _known_terms(text, how)
    numbers = {h: i for i, h in enumerate(known.tolist())}

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        buckets = Buckets(numbers)
        for batch in batches:
            packed = [np.array(sorted(terms(t, buckets)), "<i4").tobytes() for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "toxic": batch["toxic"], "terms": packed})

    kind = dict(text.dtypes)["doc_id"]
    rows = text.mapInPandas(found, f"doc_id {kind}, toxic int, terms binary").toPandas().sort_values("doc_id")
    return known, [np.frombuffer(t, "<i4") for t in rows["terms"]], rows["toxic"].to_numpy(float), shift


def train(docs: DataFrame, labels: DataFrame, how: Training | None = None) -> Machine:
    """Fits on the labelled rows outside fold 0, `how.max_rows` at most. Null labels and null ids are left out; an id labelled twice counts as
    toxic if either says so; of texts that share an id the greatest is taken. Terms are counted in the tasks; only the known terms, and each sampled
    text's numbers of them, reach the driver.
    """
    known, rows, found, shift = labelled_terms(docs, labels, how)
    return fit(known, rows, found, how, shift)


def scorer(machine: Machine) -> Callable[[Column], Column]:
    """Column function from text to score."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = machine.scorer()
        for batch in batches:
            yield pd.Series([of(text) for text in batch], dtype=float)

    return lambda text: score(F.coalesce(text, F.lit("")))


def score_documents(docs: DataFrame, machine: Machine, keep: tuple[str, ...] = ("doc_id",), threshold: float = 0.5) -> DataFrame:
    """The columns `keep`, `score` (0 to 1) and `predicted` (1 from `threshold` on) of every whole text.

    A null or empty text has the score of the bias. Repeated rows score alike. Nothing is shuffled.
    """
    scored = docs.select(*keep, scorer(machine)(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
