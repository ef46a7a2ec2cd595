"""Near duplicates by SetSketch registers: exponentially spaced, truncated minima that merge by maximum and agree the more, the more two sets share.

1. Every text becomes its set of word shingles, a digest of the set and a sketch. Texts of equal sets are one class from here on.
2. Bands of registers put classes into buckets. Each class is first paired with one class only, the least that leads one of its buckets, so a
   bucket of any size gives no more pairs than members.
3. Pairs pass if the joint likelihood of their registers allows for the threshold; then the full sets are compared, and links become components.
4. Buckets that still hold several components are searched through, in blocks, for pairs between components. Pairs are compared in full where they
   are found, the likeliest first, and a link makes further pairs of the two components needless, so each block gives fewer links than it has members.
   Buckets whose members are already together, as those of copies are, cost nothing here.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import salted_join, stored

MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
STEP = np.uint64(0x9E3779B97F4A7C15)
#: Words whose hash a worker remembers, and shingles hashed at once.
REMEMBERED, CHUNK = 1 << 18, 2048


@dataclass(frozen=True)
class Settings:
    """100 * intersection >= `percent` * union links two sets. With 32 bands of 6 registers a pair at the threshold is in no common bucket
    with probability 3e-7, one of similarity 0.3 in one with probability 0.02. `slack` is five standard errors of the estimate."""

    words: int = 5
    percent: int = 85
    bands: int = 32
    rows: int = 6
    base: float = 1.001
    rate: float = 20.0
    top: int = (1 << 16) - 2
    slack: float = 0.13
    block: int = 256
    seed: int = 17

    @property
    def registers(self) -> int:
        return self.bands * self.rows


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64 bits over 64 bits, one to one."""
    for factor in MIX:
        x = (x ^ (x >> np.uint64(33))) * factor
    return x ^ (x >> np.uint64(33))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: str | None, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; fewer words than a shingle make one, no words none.

    Bytes are lower-cased and split, which in UTF-8 touches A-Z and the ASCII blanks alone.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(len(words) - size + 1, 1)
    keys = np.full(n, min(len(words), size), np.uint64)
    for i in range(min(size, len(words))):
        keys = keys * STEP + codes[i : i + n]
    return np.unique(mix(keys))


@lru_cache(maxsize=8)
def orders(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors (odd) and shifts that put hashes into each register's own order."""
    rng = np.random.default_rng(seed)
    factor = rng.integers(0, 1 << 31, count, np.uint32) * np.uint32(2) + np.uint32(1)
    return factor[:, None], rng.integers(0, 1 << 32, count, np.uint32)[:, None]


def minima(keys: np.ndarray, how: Settings) -> np.ndarray:
    """Least 32-bit hash of the set in each register's order, by chunks: the minimum of parts is that of the whole."""
    factor, shift = orders(how.registers, how.seed)
    short = (keys >> np.uint64(32)).astype(np.uint32)
    least = np.full(how.registers, np.iinfo(np.uint32).max, np.uint32)
    for begin in range(0, len(short), CHUNK):
        least = np.minimum(least, (factor * short[None, begin : begin + CHUNK] + shift).min(1))
    return least


def registers(keys: np.ndarray, how: Settings) -> np.ndarray:
    """Sketch of a set: register i is floor(1 - log_base of an exponential minimum), within 0 and `top` + 1. The sketch of a union is the
    larger of each two registers. An empty set has zeros."""
    if not len(keys):
        return np.zeros(how.registers, np.uint16)
    uniform = (minima(keys, how) + 0.5) * 2.0**-32
    exponential = np.maximum(-np.log1p(-uniform) / how.rate, 1e-300)
    return np.clip(np.floor(1 - np.log(exponential) / np.log(how.base)), 0, how.top + 1).astype(np.uint16)


def band_keys(sketch: np.ndarray, how: Settings) -> np.ndarray:
    keys = np.arange(1, how.bands + 1, dtype=np.uint64)
    for column in sketch.reshape(how.bands, how.rows).T.astype(np.uint64):
        keys = mix(keys * STEP + column)
    return keys.view(np.int64)


def likeliest(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, how: Settings, steps: int = 200) -> np.ndarray:
    """Similarity of largest joint likelihood for each pair of sketches (rows of a and b), the sizes of the sets being known.

    A register of a set is larger than the other's with probability p(u - vJ), where u and v are the sets' shares of the summed sizes.
    """
    above, below = (a > b).sum(1)[:, None], (a < b).sum(1)[:, None]
    equal = how.registers - above - below
    u = (size_a / (size_a + size_b))[:, None]
    v = 1 - u
    j = np.linspace(0, 1, steps)[None, :] * np.minimum(u / v, v / u)
    p = lambda x: -np.log1p(-x * (how.base - 1) / how.base) / np.log(how.base)
    more, less = p(np.maximum(u - v * j, 0)), p(np.maximum(v - u * j, 0))
    log = lambda x: np.log(np.maximum(x, 1e-12))
    score = above * log(more) + below * log(less) + equal * log(1 - more - less)
    return j[np.arange(len(j)), score.argmax(1)]


def allowed(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, how: Settings) -> np.ndarray:
    """Estimates of the pairs that may reach the threshold, 0 for the others. Pairs with so few equal registers that the estimate could not
    come near are left out before it."""
    least, out = how.percent / 100 - how.slack, np.zeros(len(a))
    near = np.flatnonzero((a == b).mean(1) >= least - how.slack)
    for begin in range(0, len(near), 2000):
        part = near[begin : begin + 2000]
        found = likeliest(a[part], b[part], size_a[part], size_b[part], how)
        out[part] = np.where(found >= least, found, 0)
    return out


def linked(a: np.ndarray, b: np.ndarray, how: Settings) -> bool:
    """The definition, on two full sets."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= how.percent * (len(a) + len(b) - shared)


def sketched(docs: DataFrame, how: Settings) -> DataFrame:
    """(doc_id, n_shingles, digest, sketch, keys) per row of `docs`; the last three are null without words."""
    chosen = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = dict(chosen.dtypes)["doc_id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            rows = []
            for text in batch.pop("text"):
                found = shingles(text, how.words, hashes)
                if len(found):
                    sketch = registers(found, how)
                    rows.append((len(found), xxhash.xxh3_128_digest(found.tobytes()), sketch.tobytes(), band_keys(sketch, how)))
                else:
                    rows.append((0, None, None, None))
            yield pd.concat([batch, pd.DataFrame(rows, columns=["n_shingles", "digest", "sketch", "keys"], index=batch.index)], axis=1)

    return chosen.mapInPandas(run, f"doc_id {kind}, n_shingles long, digest binary, sketch binary, keys array<long>")


def estimated(pairs: DataFrame, classes: DataFrame, how: Settings) -> DataFrame:
    """Pairs (a, b) whose registers allow for the threshold."""
    side = lambda name: classes.select(F.col("id").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("sketch").alias(f"s_{name}"))
    kind = dict(pairs.dtypes)["a"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for begin in range(0, len(batch), 2000):
                part = batch.iloc[begin : begin + 2000]
                a, b = (np.stack([np.frombuffer(s, np.uint16) for s in part[f"s_{x}"]]) for x in "ab")
                found = allowed(a, b, part["n_a"].to_numpy(float), part["n_b"].to_numpy(float), how)
                yield part.loc[found > 0, ["a", "b"]]

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInPandas(run, f"a {kind}, b {kind}")


def confirmed(pairs: DataFrame, texts: DataFrame, how: Settings) -> DataFrame:
    """Pairs (a, b) whose full shingle sets are similar enough."""
    kind = dict(pairs.dtypes)["a"]
    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    both = both.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, text, held = WordHashes(), None, np.zeros(0, np.uint64)
        for batch in batches:
            good = []
            for text_a, text_b in zip(batch["text_a"], batch["text_b"], strict=True):
                if text_b != text:  # the pairs of one b come one after another
                    text, held = text_b, shingles(text_b, how.words, hashes)
                good.append(linked(shingles(text_a, how.words, hashes), held, how))
            yield batch.loc[good, ["a", "b"]]

    return both.mapInPandas(run, f"a {kind}, b {kind}")


def components(links: DataFrame) -> DataFrame:
    """(node, root): the least node reachable, for every node of the links (a, b).

    Alternates two rewritings of the links: every node hands its larger neighbours, then its smaller ones, to the least it knows, until each
    node hangs on its root. Links are only grouped and joined; each round is written, and its digest tells whether anything changed.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "links")
    known = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = stored(small.select("e.*").filter("u <> v").distinct(), "links")
        digest = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if digest == known:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        known = digest


class Joined:
    """Which roots hang together so far."""

    def __init__(self) -> None:
        self.above: dict = {}

    def find(self, node):
        while (up := self.above.get(node, node)) != node:
            self.above[node] = node = self.above.get(up, up)
        return node

    def join(self, a, b) -> bool:
        """Whether the two were apart."""
        a, b = self.find(a), self.find(b)
        self.above[a] = b
        return a != b


def links_between(group: pd.DataFrame, how: Settings, hashes: WordHashes) -> pd.DataFrame:
    """Links (a, b) that join components, of the members of two blocks of a bucket.

    A pair is looked at in the first band its sketches share, and so in one bucket only, unless it is together by then.
    """
    sides = [group[group["block"] == group[name].iloc[0]].reset_index(drop=True) for name in ("lo", "hi")]
    ids, roots = ([side[name].to_numpy() for side in sides] for name in ("id", "root"))
    sizes = [side["n_shingles"].to_numpy(float) for side in sides]
    wanted = roots[0][:, None] != roots[1][None, :]
    if group["lo"].iloc[0] == group["hi"].iloc[0]:
        wanted &= ids[0][:, None] > ids[1][None, :]
    wanted &= 100 * np.minimum(sizes[0][:, None], sizes[1][None, :]) >= how.percent * np.maximum(sizes[0][:, None], sizes[1][None, :])
    first, second = np.nonzero(wanted)
    found = []
    if len(first):
        sketches = [np.stack([np.frombuffer(s, np.uint16) for s in side["sketch"]]) for side in sides]
        for begin in range(0, len(first), 2000):
            i, j = first[begin : begin + 2000], second[begin : begin + 2000]
            shared = (sketches[0][i] == sketches[1][j]).reshape(-1, how.bands, how.rows).all(2)
            here = shared.argmax(1) == group["band"].iloc[0]
            i, j = i[here], j[here]
            estimate = allowed(sketches[0][i], sketches[1][j], sizes[0][i], sizes[1][j], how)
            found += [(-e, p, q) for e, p, q in zip(estimate.tolist(), i.tolist(), j.tolist(), strict=True) if e > 0]
    together, sets, links = Joined(), ({}, {}), []
    for _, i, j in sorted(found):
        root_a, root_b = roots[0][i], roots[1][j]
        if together.find(root_a) == together.find(root_b):
            continue
        for side, k, text in ((0, i, sides[0]["text"]), (1, j, sides[1]["text"])):
            if k not in sets[side]:
                sets[side][k] = shingles(text[k], how.words, hashes)
        if linked(sets[0][i], sets[1][j], how):
            together.join(root_a, root_b)
            links.append((ids[0][i], ids[1][j]))
    return pd.DataFrame(links, columns=["a", "b"])


def between_components(members: DataFrame, classes: DataFrame, texts: DataFrame, roots: DataFrame, how: Settings) -> DataFrame:
    """Links (a, b) between components that share a bucket: enough of them to join all components that any link joins.

    Only buckets with several components are looked at. A bucket is cut into blocks of about `how.block` members, and each two blocks meet in
    a task of their own, so no task holds a bucket.
    """
    labelled = members.join(roots.withColumnRenamed("node", "id"), "id", "left")
    labelled = labelled.select("band", "key", "id", F.coalesce("root", "id").alias("root"))
    open_keys = labelled.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count("*").alias("n"))
    open_keys = open_keys.filter("r0 < r1").select("key", F.ceil(F.col("n") / how.block).cast("int").alias("blocks"))
    left = labelled.join(open_keys, "key").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    met = left.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("band", "key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "id", "root")
    kind = dict(members.dtypes)["id"]
    cell = ["key", "lo", "hi"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, hashes = None, WordHashes()
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            marks = rows[cell].to_numpy()
            cuts = np.flatnonzero((marks[1:] != marks[:-1]).any(1)) + 1
            for begin, end in zip([0, *cuts[:-1]], cuts, strict=True) if len(cuts) else ():
                yield links_between(rows.iloc[begin:end], how, hashes)
            held = rows.iloc[cuts[-1] if len(cuts) else 0 :].reset_index(drop=True)
        if held is not None and len(held):
            yield links_between(held, how, hashes)

    known = classes.select("id", "n_shingles", "sketch").join(texts, "id")
    spread = met.join(known, "id").repartition(*cell).sortWithinPartitions(*cell)
    columns = ["band", *cell, "block", "id", "root", "n_shingles", "sketch", "text"]
    return spread.select(*columns).mapInPandas(run, f"a {kind}, b {kind}").distinct()


def near_duplicates(docs: DataFrame, how: Settings | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of `docs`.

    A component holds all texts that chains of links connect, and is named by its least doc_id; that row is kept. Texts without words link
    with nothing. Rows that share a doc_id are one document, linked with all that any of their texts links with. A row without a doc_id belongs to its text's
    component and is kept only if that has no doc_id at all. Empty tables give no rows; further columns of `docs` are not read.
    """
    how = how or Settings()
    rows = stored(sketched(docs, how), "sketches")
    equal = rows.filter("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("id"), F.count("*").alias("n"))
    heads = rows.filter("doc_id IS NOT NULL").join(
        equal.filter("id IS NOT NULL").select(F.col("id").alias("doc_id"), "digest"), ["doc_id", "digest"], "left_semi"
    )
    classes = heads.select(F.col("doc_id").alias("id"), "n_shingles", "digest", "sketch", "keys").dropDuplicates(["id", "digest"])
    classes = stored(classes, "classes")

    # Buckets with more than one member.
    banded = classes.select("id", "n_shingles", F.posexplode("keys").alias("band", "key"))
    buckets = banded.groupBy("key").agg(F.min(F.struct("id", "n_shingles")).alias("head"), F.count("*").alias("n")).filter("n > 1")
    members = stored(banded.join(buckets.select("key", "head"), "key"), "members")
    involved = members.select("id").distinct()
    texts = docs.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text")).join(involved, "id", "left_semi")
    texts = stored(texts.dropDuplicates(["id", "text"]), "texts")

    size, head = F.col("n_shingles"), F.col("head.n_shingles")
    near = (F.col("id") != F.col("head.id")) & (100 * F.least(size, head) >= how.percent * F.greatest(size, head))
    first = members.filter(near).groupBy("id").agg(F.min("head.id").alias("b")).select(F.col("id").alias("a"), "b")
    links = confirmed(estimated(first, classes, how), texts, how)
    same = components(links)
    more = between_components(members.select("band", "key", "id").distinct(), classes, texts, same, how)
    more = stored(more, "more-links")
    if not more.isEmpty():
        same = components(same.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))

    copies = equal.filter("n > 1").select("digest", "id")
    placed = rows.select("doc_id", "n_shingles", "digest").withColumn("row", F.xxhash64("doc_id"))
    placed = salted_join(placed, copies, ["digest"], F.col("row"))
    placed = placed.withColumn("node", F.coalesce("id", "doc_id")).drop("id")
    placed = salted_join(placed, same, ["node"], F.col("row"))
    component = F.coalesce("root", "node")
    return placed.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )
