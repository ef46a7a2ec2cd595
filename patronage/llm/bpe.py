"""Byte-level BPE as a streaming transducer with bounded lookahead, and decoding by an incremental byte-to-text machine.

A merge list fixes how far bytes still unread can change the tokens before them. `Vocabulary.lookahead` computes a sufficient bound once per merge
list; the transducer keeps no more than that and a block, and emits every token beyond it for good. Tokens of a prefix are found one byte at a
time: a sequence of tokens is the encoding of its bytes if and only if no merge crosses a border of two neighbours, so the last token of
each prefix is the one that fits the last token of the prefix before it.
"""

from __future__ import annotations

import codecs
import json
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the byte-level format: its pieces, and the bytes that stand for themselves in the vocabulary file.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLAIN_BYTES = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

#: Pieces whose ids a worker remembers, in each of two generations, and their longest length in characters.
REMEMBERED = 1 << 16
LONGEST_REMEMBERED = 40
NEVER = 1 << 62


def byte_alphabet() -> dict[str, int]:
    """Character in the vocabulary file to byte: plain bytes are themselves, the others follow from U+0100 in order."""
    others = [b for b in range(256) if b not in set(PLAIN_BYTES)]
    return {chr(b): b for b in PLAIN_BYTES} | {chr(0x100 + i): b for i, b in enumerate(others)}


def contents(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


def bytes_of(stated: dict) -> dict[str, bytes]:
    """Bytes of each ordinary token of a tokenizer file."""
    alphabet, special = byte_alphabet(), {t["content"] for t in stated["added_tokens"]}
    return {text: bytes(alphabet[c] for c in text) for text in stated["model"]["vocab"] if text not in special}


@lru_cache(maxsize=4)
def token_texts(path: str) -> list[bytes]:
    """Bytes of each token by its id: all that decoding needs."""
    stated = contents(path)
    ids = {data: stated["model"]["vocab"][text] for text, data in bytes_of(stated).items()}
    ids |= {t["content"].encode(): t["id"] for t in stated["added_tokens"]}
    texts = [b""] * (1 + max(ids.values(), default=-1))
    for data, token in ids.items():
        texts[token] = data
    return texts


class Vocabulary:
    """Tokens and merges of a tokenizer file. Every merge must make a token of its own from tokens made before it."""

    def __init__(self, tokens: dict[bytes, int], merges: list[tuple[int, int]], special: dict[str, int] | None = None):
        self.ids = dict(tokens)
        self.special = special or {}
        self.text_of = [b""] * (1 + max([*tokens.values(), *self.special.values()], default=-1))
        for data, token in tokens.items():
            self.text_of[token] = data
        for text, token in self.special.items():
            self.text_of[token] = text.encode()
        self.rank = {pair: rank for rank, pair in enumerate(merges)}
        self.made: dict[int, tuple[int, int, int]] = {}
        for rank, (left, right) in enumerate(merges):
            token = self.ids[self.text_of[left] + self.text_of[right]]
            early = [self.made[part][0] < rank for part in (left, right) if part in self.made]
            if token in self.made or not all(early) or any(part not in self.made and len(self.text_of[part]) > 1 for part in (left, right)):
                raise ValueError(f"merge {rank} does not make a token of its own from earlier ones")
            self.made[token] = (rank, left, right)
        self.fits: dict[int, bool] = {}
        if len(self.text_of) > 1 << 20:
            raise ValueError("more than 2**20 tokens")
        self._drop_unreachable()
        self.lookahead = self._lookahead(merges)

    @classmethod
    def from_file(cls, path: str) -> Vocabulary:
        stated = contents(path)
        model = stated["model"]
        split = stated.get("pre_tokenizer") or {}
        odd = [name for name in ("unk_token", "continuing_subword_prefix", "end_of_word_suffix", "dropout") if model.get(name)]
        if odd or stated.get("normalizer") or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
            raise ValueError("not a plain byte-level tokenizer")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in stated["added_tokens"]):
            raise ValueError("added tokens that take in their surroundings are not supported")
        special = {t["content"]: t["id"] for t in stated["added_tokens"]}
        in_bytes = bytes_of(stated)
        tokens = {data: model["vocab"][text] for text, data in in_bytes.items()}
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        return cls(tokens, [(tokens[in_bytes[a]], tokens[in_bytes[b]]) for a, b in pairs], special)

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Parts at one edge of a token, each with the rank of the merge that takes it in; `side` 1 is the left edge, 2 the right."""
        edge, until = [], NEVER
        while True:
            edge.append((token, until))
            if token not in self.made:
                return edge
            until, token = self.made[token][0], self.made[token][side]

    def _crossed(self, left: int, right: int, before: int = NEVER) -> bool:
        """Whether a merge of rank under `before` crosses the border of two tokens. Of equal merges the leftmost comes first."""
        starts = self._edge(right, 1)
        for a, a_until in self._edge(left, 2):
            for b, b_until in starts:
                rank = self.rank.get((a, b), NEVER)
                if rank < before and rank < a_until and rank <= b_until:
                    return True
        return False

    def _drop_unreachable(self) -> None:
        """Tokens that are not the encoding of their own bytes never occur."""
        lost = {token for data, token in self.ids.items() if len(data) > 1 and token not in self.made}
        for token, (rank, left, right) in self.made.items():  # in order of rank
            if left in lost or right in lost or self._crossed(left, right, rank):
                lost.add(token)
        self.ids = {data: token for data, token in self.ids.items() if token not in lost}

    def _lookahead(self, merges: list[tuple[int, int]]) -> int:
        """Bytes before the end of what was read that bytes still unread may change; all tokens that end before these are final.

        A token at the end may become part of unknown merges. Whether a merge happens can only change later ones: those that want its left part
        or its product from the left, and so reach the length of their own left part further, and those that join its left part to the
        right. Following the merges by rank gives the furthest reach of any such chain.
        """
        reach = {token: len(data) for token, data in enumerate(self.text_of)}
        for left, right in merges:
            made = self.ids.get(self.text_of[left] + self.text_of[right])
            further = max(len(self.text_of[left]) + reach[right], reach[left])
            reach[left] = further
            if made is not None:
                reach[made] = max(reach[made], further)
        return max(reach.values(), default=1)

    def fit(self, pair: int) -> bool:
        """Whether two tokens, given as left * 2**20 + right, stand next to each other unchanged; remembered."""
        if len(self.fits) > 1 << 20:
            self.fits.clear()
        known = self.fits[pair] = not self._crossed(pair >> 20, pair & 0xFFFFF)
        return known


class Suffixes:
    """Machine over bytes whose state says which tokens end at the byte just read. States and steps are made when first met; a state is the
    longest end of what was read that starts some token, so there are no more of them than starts of tokens."""

    def __init__(self, vocabulary: Vocabulary):
        self.ids = vocabulary.ids
        self.starts = {data[:size] for data in self.ids for size in range(len(data) + 1)}
        self.numbers: dict[bytes, int] = {b"": 0}
        self.reads: list[bytes] = [b""]
        #: For each state the tokens that end there, longest first, each with its length.
        self.ends: list[list[tuple[int, int]]] = [[]]
        self.steps: dict[int, int] = {}

    def step(self, key: int) -> int:
        """The state after `key` = state * 256 + byte; remembered."""
        read = self.reads[key >> 8] + bytes([key & 255])
        while read not in self.starts:
            read = read[1:]
        if read not in self.numbers:
            self.numbers[read] = len(self.reads)
            self.reads.append(read)
            found = [(self.ids[read[i:]], len(read) - i) for i in range(len(read)) if read[i:] in self.ids]
            self.ends.append(found)
        state = self.steps[key] = self.numbers[read]
        return state


class Transducer:
    """Bytes in, final tokens out. Holds at most the lookahead, a block and one longest token."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.suffixes = vocabulary, Suffixes(vocabulary)
        self.block = max(4096, vocabulary.lookahead)
        self._clear()

    def _clear(self) -> None:
        #: Bytes held, the last token of each of their prefixes, and the token emitted before them (-1 at the start).
        self.held, self.last, self.state = 0, [-1], 0

    def feed(self, data: bytes) -> list[int]:
        out = []
        for begin in range(0, len(data), self.block):
            self._extend(data[begin : begin + self.block])
            if self.held > self.vocabulary.lookahead + self.block:
                out += self._emit(self.held - self.vocabulary.lookahead)
        return out

    def finish(self) -> list[int]:
        out = self._emit(self.held)
        self._clear()
        return out

    def _extend(self, data: bytes) -> None:
        """Last token of every longer prefix: of the tokens that end there, the one that fits the last token before it."""
        last, fits, fit = self.last, self.vocabulary.fits, self.vocabulary.fit
        state, steps, step, ends = self.state, self.suffixes.steps, self.suffixes.step, self.suffixes.ends
        end = len(last)
        for byte in data:
            key = state << 8 | byte
            state = steps.get(key)
            if state is None:
                state = step(key)
            for token, size in ends[state]:
                start = end - size
                if start >= 0:
                    before = last[start]
                    if before < 0:
                        last.append(token)
                        break
                    pair = before << 20 | token
                    known = fits.get(pair)
                    if known or known is None and fit(pair):
                        last.append(token)
                        break
            else:
                raise ValueError(f"byte {byte} is in no token")
            end += 1
        self.held, self.state = end - 1, state

    def _emit(self, upto: int) -> list[int]:
        """Tokens that end at `upto` or before, on the way back from the end of the data."""
        text_of, last, end = self.vocabulary.text_of, self.last, self.held
        out: list[int] = []
        cut = 0
        while end > 0:
            token = last[end]
            if end <= upto:
                cut = cut or end
                out.append(token)
            end -= len(text_of[token])
        if out:
            self.last, self.held = last[cut:], self.held - cut
        out.reverse()
        return out


class Remembered(dict):
    """Piece to its ids, packed. Holds two generations of REMEMBERED pieces, so memory stays constant whatever is encoded."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.transducer, self.older = Transducer(vocabulary), {}

    def __missing__(self, piece: str) -> bytes:
        packed = self.older.get(piece)
        if packed is None:
            ids = self.transducer.feed(piece.encode()) + self.transducer.finish()
            packed = struct.pack(f"<{len(ids)}I", *ids)
            if len(piece) > LONGEST_REMEMBERED:
                return packed
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[piece] = packed
        return packed


class Encoder:
    """Text to ids (little-endian unsigned 32-bit, packed), special strings to their own ids, as the file's own library does."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.remembered = vocabulary, Remembered(vocabulary)
        self.pieces = regex.compile(PIECES)
        names = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, names))) if names else None

    def ordinary(self, text: str) -> bytes:
        return b"".join(map(self.remembered.__getitem__, self.pieces.findall(text)))

    def encode(self, text: str) -> bytes:
        out, at = [], 0
        for found in self.special.finditer(text) if self.special else ():
            out += [self.ordinary(text[at : found.start()]), struct.pack("<I", self.vocabulary.special[found[0]])]
            at = found.end()
        return b"".join(out) + self.ordinary(text[at:] if at else text)


def decode_stream(text_of: list[bytes], chunks: Iterable[bytes]) -> Iterator[str]:
    """Text of packed ids, of which `text_of` has the bytes of each, as it becomes complete: a character whose bytes are split over tokens or chunks waits for its last byte; bytes
    that are no UTF-8 become U+FFFD, one for each longest start of a character. An id outside the vocabulary is left out."""
    machine = codecs.getincrementaldecoder("utf-8")("replace")
    for chunk in chunks:
        ids = np.frombuffer(chunk, "<u4")
        if len(ids) and int(ids.max()) >= len(text_of):
            ids = ids[ids < len(text_of)]
        yield machine.decode(b"".join(map(text_of.__getitem__, ids.tolist())))
    yield machine.decode(b"", True)


def decode(text_of: list[bytes], packed: bytes, step: int = 1 << 16) -> str:
    return "".join(decode_stream(text_of, (packed[i : i + step] for i in range(0, len(packed), step))))


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One for each vocabulary file and Python worker."""
    return Encoder(Vocabulary.from_file(path))


#: Rows whose texts a worker holds as strings, and gives back, at once.
ROWS = 500


def encode_documents(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), decode_too: bool = False) -> DataFrame:
    """The columns `keep`, `ids` (packed little-endian unsigned 32-bit) and `n_tokens` of every whole text of `docs`.

    `decode_too` adds `decoded`, the text that the ids decode to, in the same worker. A null or empty text has no ids. Rows are taken as they
    come: repeated rows, null ids and further columns do no harm. `path` is the vocabulary file, present on every machine, as installed
    libraries are. Nothing is shuffled.
    """
    chosen = docs.select(*keep, *(["text"] if "text" not in keep else []))
    kinds = dict(chosen.dtypes)
    fields = ", ".join(f"`{name}` {kinds[name]}" for name in keep)
    names = [*keep, "ids", "n_tokens"] + ["decoded"] * decode_too

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, texts = encoder(path).encode, token_texts(path) if decode_too else []
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                part = batch.slice(begin, ROWS)
                packed = [encode(text or "") for text in part.column("text").to_pylist()]
                out = [*map(part.column, keep), pa.array(packed, pa.binary()), pa.array([len(p) // 4 for p in packed], pa.int64())]
                if decode_too:
                    out.append(pa.array([decode(texts, p) for p in packed], pa.string()))
                yield pa.RecordBatch.from_arrays(out, names)

    return chosen.mapInArrow(run, f"{fields}, ids binary, n_tokens long" + ", decoded string" * decode_too)


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """`n_tokens` of every whole text, nothing else: one row for each row, repeated ones too, 0 for null and empty texts, none without rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path).encode
        for batch in batches:
            yield pd.DataFrame({"n_tokens": [len(encode(text)) // 4 for text in batch["_text"]]})

    return docs.select(F.coalesce("text", F.lit("")).alias("_text")).mapInPandas(run, "n_tokens long")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """Adds `decoded`, the text of `ids`; null ids give an empty text."""
    names = encoded.columns
    fields = ", ".join(f"`{name}` {kind}" for name, kind in encoded.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts = token_texts(path)
        for batch in batches:
            yield batch.assign(decoded=[decode(texts, packed or b"") for packed in batch["ids"]])

    return encoded.select(*names).mapInPandas(run, f"{fields}, decoded string")
