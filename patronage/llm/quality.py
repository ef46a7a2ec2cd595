"""Quality rules: a linear-chain conditional random field labels the lines of a text as content or boilerplate, and the content share decides."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD

SYMBOLS = "#*$%&|<>"
NO_SYMBOLS = dict.fromkeys(map(ord, SYMBOLS))
NO_MARKS = dict.fromkeys(map(ord, "!?…\"'()[]{}=+~^_/\\@"))
CAPITAL = re.compile(r"[A-ZÀ-ÖØ-Þ]")
DIGIT = re.compile(r"\d")
#: Window, in words, of the rule on repeated words; the rules' limits.
WINDOW, LEAST_WORDS, MOST_REPEATED_PERCENT = 5, 10, 20
FEATURES = (
    "bias", "log_words", "short", "symbols", "marks", "capitals", "digits", "word_length", "distinct", "seen_line", "seen_words", "sentence_end",
)


@dataclass(frozen=True)
class Measures:
    """Counts of a text, and the lines that hold a word: their words and their features."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    line_words: np.ndarray
    features: np.ndarray

    @property
    def base_failed(self) -> bool:
        return self.n_words < LEAST_WORDS or 100 * self.n_repeat_words > MOST_REPEATED_PERCENT * self.n_words


def repeated(words: list[str]) -> np.ndarray:
    """For each word whether it stands in a window of WINDOW words that occurs at least twice in the text."""
    marked = np.zeros(len(words), bool)
    n = len(words) - WINDOW + 1
    if n < 2:
        return marked
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    keys = np.zeros(n, np.uint64)
    for i in range(WINDOW):
        keys = keys * np.uint64(0x9E3779B97F4A7C15) + codes[i : i + n]
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    for i in range(WINDOW):
        marked[i : i + n] |= twice
    return marked


def measure(text: str) -> Measures:
    """Words are maximal runs without blank or ASCII control space, so a text's words are those of its lines in order."""
    lines = [(line, words) for line in text.split("\n") if (words := WORD.findall(line))]
    flat = [word for _, words in lines for word in words]
    again = repeated(flat)
    seen: set[str] = set()
    dup_lines, word_chars, at = 0, 0, 0
    rows = []
    for line, words in lines:
        n, chars = len(words), sum(map(len, words))
        known = line in seen
        seen.add(line)
        dup_lines += known
        word_chars += chars
        last = line.rstrip()[-1:]
        rows.append((
            1.0, min(np.log1p(n), 6.0), float(n < 4), (len(line) - len(line.translate(NO_SYMBOLS))) / chars, (len(line) - len(line.translate(NO_MARKS))) / chars,
            len(CAPITAL.findall(line)) / chars, len(DIGIT.findall(line)) / chars, min(chars / n, 30) / 10, len(set(words)) / n, float(known),
            float(again[at : at + n].mean()), float(last in ".!?:;…"),
        ))
        at += n
    symbols = len(text) - len(text.translate(NO_SYMBOLS))
    sizes = np.array([len(words) for _, words in lines], np.int64)
    return Measures(len(flat), word_chars, symbols, dup_lines, int(again.sum()), sizes, np.array(rows, float).reshape(len(rows), len(FEATURES)))


@dataclass(frozen=True)
class Field:
    """Weights of two labels, 0 content and 1 boilerplate: `emission` (feature by label) and `transition` (label before by label)."""

    emission: np.ndarray
    transition: np.ndarray

    def viterbi(self, features: np.ndarray) -> np.ndarray:
        """The likeliest labels of consecutive lines; of equally likely ones those with content later."""
        if not len(features):
            return np.zeros(0, int)
        (stay0, to1), (to0, stay1) = self.transition.tolist()
        scores = (features @ self.emission).tolist()
        best0, best1 = scores[0]
        back = []
        for s0, s1 in scores[1:]:
            from0, from1 = best0 + stay0 >= best1 + to0, best0 + to1 >= best1 + stay1
            back.append((0 if from0 else 1, 0 if from1 else 1))
            best0, best1 = (best0 + stay0 if from0 else best1 + to0) + s0, (best0 + to1 if from1 else best1 + stay1) + s1
        label = 0 if best0 >= best1 else 1
        labels = [label]
        for step in reversed(back):
            label = step[label]
            labels.append(label)
        return np.array(labels[::-1])

    def content_share(self, measures: Measures) -> float:
        """Share of the words that stand in lines of content; 0 without words."""
        if not measures.n_words:
            return 0.0
        labels = self.viterbi(measures.features)
        return float(measures.line_words[labels == 0].sum() / measures.n_words)


@dataclass(frozen=True)
class Training:
    """Parameters of a fit. `max_rows` bounds the labelled documents, those least in a hash of their id; all lines of these serve."""

    max_rows: int = 3000
    #: Lines of a training sequence; a longer text is several, whose share counts as one.
    piece: int = 32
    #: Share of words in boilerplate that a good document has at most, and a bad one at least.
    most_in_good: float = 0.05
    least_in_bad: float = 0.8
    #: Times that the hidden labels are estimated anew, and steps of a fit.
    passes: int = 3
    rounds: int = 60
    step: float = 0.1
    ridge: float = 1e-3
    #: Share of words in content from which a document is kept.
    least_content: float = 0.5


class _Lines:
    """Sequences of lines, longest first, padded: features, which places are real, and the document and the words of each."""

    def __init__(self, documents: list[tuple[np.ndarray, np.ndarray]], piece: int):
        cut = [(d, i, min(piece, len(features) - i)) for d, (features, _) in enumerate(documents) for i in range(0, len(features), piece)]
        cut.sort(key=lambda part: -part[2])
        longest = cut[0][2] if cut else 0
        self.shape = (len(cut), longest)
        #: Sequences that reach each place.
        self.reach = [sum(n > t for _, _, n in cut) for t in range(longest)]
        self.x, self.real, self.words = np.zeros((*self.shape, len(FEATURES))), np.zeros(self.shape, bool), np.zeros(self.shape)
        self.of = np.zeros(self.shape, int) + np.array([d for d, _, _ in cut], int)[:, None]
        self.cut = cut
        for at, (d, i, n) in enumerate(cut):
            features, words = documents[d]
            self.x[at, :n], self.real[at, :n], self.words[at, :n] = features[i : i + n], True, words[i : i + n]

    def sums(self, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward-backward: chance of each label of each line, and sums of the chances of neighbouring labels."""
        size = len(FEATURES)
        emission, transition = weights[: size * 2].reshape(size, 2), weights[size * 2 :].reshape(2, 2)
        score = self.x @ emission
        alpha, beta, total = np.zeros_like(score), np.zeros_like(score), np.zeros(self.shape[0])
        alpha[:, 0] = score[:, 0]
        for t, n in enumerate(self.reach):
            if t:
                before = alpha[:n, t - 1]
                alpha[:n, t] = np.logaddexp(before[:, :1] + transition[0], before[:, 1:] + transition[1]) + score[:n, t]
            total[:n] = np.logaddexp(alpha[:n, t, 0], alpha[:n, t, 1])
        for t in range(self.shape[1] - 2, -1, -1):
            n = self.reach[t + 1]
            ahead = score[:n, t + 1] + beta[:n, t + 1]
            beta[:n, t] = np.logaddexp(transition[:, 0] + ahead[:, :1], transition[:, 1] + ahead[:, 1:])
        single = np.exp(np.minimum(alpha + beta - total[:, None, None], 0)) * self.real[..., None]
        joint = alpha[:, :-1, :, None] + transition + (score + beta)[:, 1:, None, :] - total[:, None, None, None]
        return single, (np.exp(np.minimum(joint, 0)) * self.real[:, 1:, None, None]).sum((0, 1))

    def fit(self, boilerplate: np.ndarray, how: Training, chained: bool = True, start: np.ndarray | None = None) -> np.ndarray:
        """Weights under which the given chances of boilerplate, line by line, are likeliest, by Adam steps; without `chained` lines stand alone."""
        size, lines = len(FEATURES), max(1, self.real.sum())
        truth = np.stack([1 - boilerplate, boilerplate], 2) * self.real[..., None]
        pairs = np.einsum("sta,stb->ab", truth[:, :-1], truth[:, 1:])
        weights = np.zeros(size * 2 + 4) if start is None else start
        mean, square = np.zeros_like(weights), np.zeros_like(weights)
        for turn in range(1, how.rounds + 1):
            single, joint = self.sums(weights)
            slope = np.concatenate([np.einsum("stf,sta->fa", self.x, truth - single).ravel(), (pairs - joint).ravel() * chained]) / lines - how.ridge * weights
            mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope**2
            weights = weights + how.step * (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.999**turn)) + 1e-8)
        return weights

    def within(self, chance: np.ndarray, bad: np.ndarray, how: Training) -> np.ndarray:
        """Chances of boilerplate, those of each document moved by one step of log-odds, the least that brings its share of words where its label
        wants it: a good document at most `most_in_good`, a bad one at least `least_in_bad`."""
        odds = np.log(np.clip(chance, 1e-6, 1 - 1e-6)) - np.log(np.clip(1 - chance, 1e-6, 1 - 1e-6))
        documents = len(bad)
        total = np.maximum(np.bincount(self.of[self.real], self.words[self.real], documents), 1)
        share = lambda move: np.bincount(self.of[self.real], (self.words / (1 + np.exp(-(odds + move[self.of]))))[self.real], documents) / total
        wanted = np.where(bad, how.least_in_bad, how.most_in_good)
        low, high = np.where(bad, 0.0, -30.0), np.where(bad, 30.0, 0.0)
        for _ in range(30):
            middle = (low + high) / 2
            more = share(middle) < wanted
            low, high = np.where(more, middle, low), np.where(more, high, middle)
        fine = np.where(bad, share(np.zeros(documents)) >= wanted, share(np.zeros(documents)) <= wanted)
        return 1 / (1 + np.exp(-(odds + np.where(fine, 0.0, np.where(bad, high, low))[self.of])))


def fit(sequences: list[tuple[np.ndarray, np.ndarray]], how: Training | None = None) -> Field:
    """The field under which the given line labels (or chances of boilerplate) are likeliest. Without sequences, or with one label only, all lines are content."""
    how = how or Training()
    size = len(FEATURES)
    if len({float(label) for _, labels in sequences for label in np.unique(labels)}) < 2:
        return Field(np.stack([np.eye(size)[0], np.zeros(size)], 1), np.zeros((2, 2)))
    lines = _Lines([(x, np.ones(len(x))) for x, _ in sequences], max(len(x) for x, _ in sequences))
    given = np.zeros(lines.shape)
    for at, (d, _, n) in enumerate(lines.cut):
        given[at, :n] = sequences[d][1]
    weights = lines.fit(given, how)
    return Field(weights[: size * 2].reshape(size, 2), weights[size * 2 :].reshape(2, 2))


def learn(documents: list[tuple[np.ndarray, np.ndarray]], bad: np.ndarray, how: Training | None = None) -> Field:
    """Learns line labels that are hidden, from documents (features and words of their lines) labelled good or bad as a whole.

    At first each line stands alone, and is judged by what distinguishes lines of bad documents from those of good ones. From then on the chances of
    the labels come from the field's own forward-backward sums. Each time they are moved, document by document, no further than its label
    demands: a good document may have some boilerplate, a bad one much content, and labels change where lines do.
    """
    how = how or Training()
    size = len(FEATURES)
    kept = [i for i, (features, _) in enumerate(documents) if len(features)]
    documents, bad = [documents[i] for i in kept], np.asarray(bad, bool)[kept]
    if not len(bad) or bad.all() or not bad.any():
        return fit([])
    lines = _Lines(documents, how.piece)
    weights = lines.fit(bad[lines.of].astype(float), how, chained=False)
    for _ in range(how.passes):
        chance = lines.sums(weights)[0][..., 1]
        weights = lines.fit(lines.within(chance, bad, how), how, start=weights)
    return Field(weights[: size * 2].reshape(size, 2), weights[size * 2 :].reshape(2, 2))


def train(docs: DataFrame, labels: DataFrame, how: Training | None = None) -> Field:
    """Learns from labelled documents (quality 1 or 0) what lines of content and of boilerplate look like.

    Null labels and null ids are left out; an id labelled twice has the lower quality; of texts that share an id the greatest is taken. Only the
    features of the sample's lines reach the driver.
    """
    how = how or Training()
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(how.max_rows)  # the bound of the broadcast
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
    text = text.groupBy("doc_id").agg(F.max("text").alias("text"), F.max("quality").alias("quality"))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [measure(t) for t in batch["text"]]
            packed = {"features": [m.features.astype("<f8").tobytes() for m in found], "words": [m.line_words.astype("<i8").tobytes() for m in found]}
            yield pd.DataFrame({"doc_id": batch["doc_id"], "quality": batch["quality"], **packed})

    kind = dict(text.dtypes)["doc_id"]
    rows = text.mapInPandas(features, f"doc_id {kind}, quality int, features binary, words binary").toPandas().sort_values("doc_id")
    documents = [
        (np.frombuffer(f, "<f8").reshape(-1, len(FEATURES)), np.frombuffer(w, "<i8"))
        for f, w in rows[["features", "words"]].itertuples(index=False, name=None)
    ]
    return learn(documents, rows["quality"].to_numpy() == 0, how)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(field: Field, how: Training | None = None) -> Callable[[Column], Column]:
    """Column function from text to its counts, `base_failed`, `content_share` and `kept`."""
    least = (how or Training()).least_content
    longs = ", ".join(f"{name} long" for name in COUNTS)

    @F.pandas_udf(f"{longs}, base_failed boolean, content_share double, kept boolean")
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch:
                found = measure(text)
                share, failed = field.content_share(found), found.base_failed
                rows.append((*(getattr(found, name) for name in COUNTS), failed, share, not failed and share >= least))
            yield pd.DataFrame(rows, columns=[*COUNTS, "base_failed", "content_share", "kept"])

    return lambda text: judged(F.coalesce(text, F.lit("")))


def judge_documents(docs: DataFrame, field: Field, keep: tuple[str, ...] = ("doc_id",), how: Training | None = None) -> DataFrame:
    """The columns `keep`, the counts of every whole text, `base_failed`, `content_share` and `kept`.

    A text without words fails the base rules. Otherwise it is kept if at least `how.least_content` of its words stand in lines that Viterbi
    decoding marks as content. A null text is as an empty one. Repeated rows are judged alike. Nothing is shuffled.
    """
    return docs.select(*keep, judge(field, how)(F.col("text")).alias("_judged")).select(*keep, "_judged.*")
