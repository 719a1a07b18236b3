"""Byte-level BPE by a pair occurrence index.

The distinct pre-tokens of a portion of texts are laid out as one row of byte symbols. An index maps
each adjacent pair to all its positions; the active ranks are taken in ascending order, the pair of a
rank is merged at all its positions from left to right, and the neighbours' new pairs enter their
lists. Entries that an earlier merge has changed are skipped when met. Vocabulary, merges and the
special strings come from a tokenizer file; workers remember the ids of pieces.

Rows stay where they are: one narrow pass, memory bounded by the portion. Defined results: a null
text counts as empty, which has no ids; texts of any length are encoded whole; special strings in a
text become their id, as in the library. Repeated rows get equal results.
"""

from __future__ import annotations

import heapq
import json
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from crawlflow.llm.pieces import PieceEncoder, portions, require_pattern
from crawlflow.llm.shared import at_rest

# The pattern of pre-tokens of the vocabulary, with white space spelt out.
PRETOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


STRIDE = 1 << 31
END, GONE = STRIDE - 1, STRIDE - 2  # between words, and where a merge took the symbol away


def byte_signs() -> list[str]:
    """The sign that stands for each byte: itself where it prints in Latin-1, else the next from U+0100 on."""
    signs, spare = [], 0x100
    for byte in range(256):
        if 0x21 <= byte <= 0x7E or 0xA1 <= byte <= 0xAC or 0xAE <= byte <= 0xFF:
            signs.append(chr(byte))
        else:
            signs.append(chr(spare))
            spare += 1
    return signs


class PairIndexBpe:
    def __init__(self, path: str):
        require_pattern(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab: dict[str, int] = spec["model"]["vocab"]
        signs = byte_signs()
        byte_of = {sign: byte for byte, sign in enumerate(signs)}
        self.base = np.array([vocab[sign] for sign in signs])
        self.special = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self.pair = [(vocab[a], vocab[b]) for a, b in spec["model"]["merges"]]  # by rank
        self.merged = [vocab[a + b] for a, b in spec["model"]["merges"]]
        keys = np.array([a * STRIDE + b for a, b in self.pair])
        self.rank_of_key = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank_of_key]
        self.bytes_of: dict[int, bytes] = {i: bytes(map(byte_of.__getitem__, token)) for token, i in vocab.items()}
        self.bytes_of |= {i: text.encode() for text, i in self.special.items()}
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.pretoken = regex.compile(PRETOKEN)
        self.pieces = PieceEncoder(self.encode_plain, self.encode_strings)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or -1."""
        keys = left * STRIDE + right
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == keys, self.rank_of_key[at], -1)

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each pre-token, all merged together; between two words lies a symbol without pairs."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        symbol = np.full(int(ends[-1]) + 2 if len(words) else 1, END, dtype=np.int64)
        inside = np.ones(len(symbol) - 1, dtype=bool)
        inside[ends] = False
        symbol[:-1][inside] = self.base[np.frombuffer(b"".join(words), np.uint8)]
        after = np.arange(1, len(symbol) + 1)
        before = np.arange(-1, len(symbol) - 1)

        places: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(ranks: np.ndarray, at: np.ndarray) -> None:
            """Put positions into the lists of their pairs' ranks."""
            there = ranks >= 0
            ranks, at = ranks[there], at[there]
            if not len(ranks):
                return
            if len(ranks) > 1:
                order = np.argsort(ranks, kind="stable")
                ranks, at = ranks[order], at[order]
                edges = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
                parts = zip(ranks[np.concatenate(([0], edges))].tolist(), np.split(at, edges), strict=True)
            else:
                parts = [(int(ranks[0]), at)]
            for rank, part in parts:
                if rank in places:
                    places[rank].append(part)
                else:
                    places[rank] = [part]
                    heapq.heappush(active, rank)

        enter(self._ranks(symbol[:-1], symbol[1:]), np.arange(len(symbol) - 1))
        while active:
            rank = heapq.heappop(active)
            lists = places.pop(rank)
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            a, b = self.pair[rank]
            right = after[at]
            good = (symbol[at] == a) & (symbol[right] == b)
            at, right = at[good], right[good]
            if a == b and len(at) > 1:  # in a run, every other pair, from the left
                free, taken = -1, []
                for k, (x, y) in enumerate(zip(at.tolist(), right.tolist(), strict=True)):
                    if x != free:
                        taken.append(k)
                        free = y
                at, right = at[taken], right[taken]
            if not len(at):
                continue
            beyond = after[right]
            symbol[at], symbol[right] = self.merged[rank], GONE
            after[at], before[beyond] = beyond, at
            left = before[at]
            first, second = np.concatenate((left, at)), np.concatenate((at, beyond))
            enter(self._ranks(symbol[first], symbol[second]), first)
        kept = symbol[symbol != GONE]
        cuts = np.flatnonzero(kept == END)
        data = kept.astype("<u4").tobytes()
        starts = np.concatenate(([0], cuts[:-1] + 1))
        spans = zip((4 * starts).tolist(), (4 * cuts).tolist(), strict=True)
        return [data[s:e] for (s, e), _ in zip(spans, words, strict=False)]

    def _ids(self, words: set[str]) -> dict[str, bytes]:
        distinct = list(words)
        return dict(zip(distinct, self.encode_words([w.encode() for w in distinct]), strict=True))

    def encode_plain(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces without a space, each after one: their first pre-token alone begins with it."""
        row = "".join([" " + p for p in pieces])
        if any(s in row for s in self.special):
            return self.encode_strings([" " + p for p in pieces])
        words = self.pretoken.findall(row)
        ids = self._ids(set(words))
        out: list[list[bytes]] = []
        for word in words:
            if word[0] == " ":
                out.append([ids[word]])
            else:
                out[-1].append(ids[word])
        return [parts[0] if len(parts) == 1 else b"".join(parts) for parts in out]

    def encode_strings(self, strings: list[str]) -> list[bytes]:
        words_of = [self._pretokens(s) for s in strings]
        ids = self._ids({w for words in words_of for w in words if isinstance(w, str)})
        return [b"".join([ids[w] if isinstance(w, str) else w for w in words]) for words in words_of]

    def _pretokens(self, text: str) -> list[str | bytes]:
        if self.split_special is None or not any(s in text for s in self.special):
            return self.pretoken.findall(text)
        out: list[str | bytes] = []
        for part in self.split_special.split(text):
            if part in self.special:
                out.append(np.array([self.special[part]], dtype="<u4").tobytes())
            else:
                out += self.pretoken.findall(part)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return self.pieces(texts)

    def decode(self, ids: bytes) -> str:
        data = b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))
        return data.decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def bpe_of(path: str) -> PairIndexBpe:
    return PairIndexBpe(path)


def _column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def encode_column(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (array<int>) of every text."""

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in _column(batch, "text")]
            for i, j in portions(texts):
                ids = [np.frombuffer(b, dtype="<u4").astype(np.int32) for b in bpe_of(path).encode(texts[i:j])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"]
                )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(at_rest(run, lambda: bpe_of(path).pieces.forget()), f"doc_id {kind}, ids array<int>")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every text, encoded and decoded again."""

    def run(batches):
        bpe = bpe_of(path)
        for batch in batches:
            texts = [t or "" for t in _column(batch, "text")]
            for i, j in portions(texts):
                coded = bpe.encode(texts[i:j])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, j - i),
                        pa.array([len(b) // 4 for b in coded], pa.int64()),
                        pa.array([sha256(b).hexdigest() for b in coded]),
                        pa.array([sha256(bpe.decode(b).encode()).hexdigest() for b in coded]),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(at_rest(run, lambda: bpe_of(path).pieces.forget()), schema)
