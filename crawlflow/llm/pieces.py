"""Byte-level BPE texts in pieces that encode alike alone and in their text.

A text is cut before each single space between two signs that are not white space: no token of the
vocabulary's pattern spans such a place, so the ids of a text are those of its pieces in order. Pieces
recur, so each worker remembers their ids.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Callable, Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

CUT = regex.compile(r"(?<=\P{White_Space}) (?=\P{White_Space})")
# White space other than the space and the line feed.
RARE = regex.compile("[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
RARE_ASCII = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f"
#: What a text holds that more than single spaces cut.
ODD = "  | \n|\n |" + RARE.pattern
LETTERS = regex.compile(r"\p{L}+")
#: What the tokenizer file must say for the cut to be right.
PATTERN = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}


def require_pattern(path: str) -> None:
    """Refuse a tokenizer file whose pieces are others than those that the cut was made for."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    before = spec.get("pre_tokenizer") or {}
    unusual = {key: before.get(key) for key, value in PATTERN.items() if before.get(key) != value}
    if unusual or spec.get("normalizer") or spec.get("post_processor"):
        raise ValueError(f"{path}: no plain byte-level file ({unusual or 'it has a normalizer or post-processor'})")


def cut(text: str) -> list[str]:
    """Pieces of a text; all but the first stand for themselves after one space."""
    if text.isascii():
        rare = any(map(text.__contains__, RARE_ASCII))
    else:
        rare = RARE.search(text)
    if rare or "  " in text or " \n" in text or "\n " in text:
        return CUT.split(text)
    return text.split(" ")


class PieceEncoder:
    """Ids of texts as bytes.

    `encode_plain` gives the ids of pieces without a space in them, each after one space; `encode`
    those of any strings.
    """

    def __init__(
        self,
        encode_plain: Callable[[list[str]], Iterable[bytes]],
        encode: Callable[[list[str]], Iterable[bytes]],
        remembered: int = 800_000,
        longest: int = 64,
    ) -> None:
        self.encode_plain, self.encode = encode_plain, encode
        self.remembered, self.longest = remembered, longest
        self.known: dict[str, bytes] = {}

    def forget(self, kept: int = 100_000) -> None:
        """What a worker does after a task: many pieces are forgotten."""
        if len(self.known) > kept:
            self.known.clear()

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > self.remembered:
            self.known.clear()
        pieces_of = [cut(text) for text in texts]
        missing: set[str] = set()
        for pieces in pieces_of:
            missing.update(set(pieces[1:]).difference(self.known))
        plain = [p for p in missing if p and " " not in p and len(p) <= self.longest]
        other = list(missing.difference(plain))
        self.known.update(zip(plain, self.encode_plain(plain), strict=True))
        found = iter(self.encode([" " + p for p in other] + [pieces[0] for pieces in pieces_of]))
        rare = {p: next(found) for p in other}
        self.known.update(rare)
        coded = [next(found) + b"".join(map(self.known.__getitem__, pieces[1:])) for pieces in pieces_of]
        for p in rare:  # long ones are not remembered
            if len(p) > self.longest:
                del self.known[p]
        return coded


def cut_all(texts: pa.Array) -> pa.Array:
    """The pieces of each text, as `cut` gives them."""
    odd = pc.match_substring_regex(texts, ODD)
    if not pc.any(odd, min_count=0).as_py():
        return pc.split_pattern(texts, " ")
    apart = pa.array([CUT.split(text) for text in texts.filter(odd).to_pylist()], pa.list_(texts.type))
    pieces = pa.concat_arrays([pc.split_pattern(texts.filter(pc.invert(odd)), " "), apart])
    return pieces.take(pa.array(np.argsort(np.argsort(odd.to_numpy(zero_copy_only=False), kind="stable"))))


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Of each code point, whether it is a letter."""
    every = "".join(map(chr, itertools.chain(range(0xD800), range(0xE000, 0x110000))))
    found = np.zeros(0x110000, dtype=bool)
    found[np.frombuffer("".join(LETTERS.findall(every)).encode("utf-32-le"), dtype="<u4")] = True
    return found


def halves(pieces: pa.StringArray) -> pa.StringArray:
    """Head and tail of each piece in turn: the letters that it begins with and the rest, or the whole and nothing."""
    n = len(pieces)
    _, offsets, data = pieces.buffers()
    offsets = np.frombuffer(offsets, np.int32, n + 1, 4 * pieces.offset) if n else np.zeros(1, np.int32)
    first, last = int(offsets[0]), int(offsets[-1])
    points = np.frombuffer((data[first:last].to_pybytes() if last > first else b"").decode().encode("utf-32-le"), "<u4")
    sizes = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF).astype(np.int64)
    stops = np.append((first + np.cumsum(sizes) - sizes)[~letters()[points]], last)
    ends = np.minimum(stops[np.searchsorted(stops, offsets[:-1])], offsets[1:])
    bounds = np.empty(2 * n + 1, np.int32)
    bounds[::2], bounds[1::2] = offsets, np.where(ends == offsets[:-1], offsets[1:], ends)
    return pa.StringArray.from_buffers(2 * n, pa.py_buffer(bounds), data or pa.py_buffer(b""))


def runs_of(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Runs of `values`, one after the other."""
    ends = np.cumsum(lengths)
    return values[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]


class PieceTable:
    """Ids of texts as bytes, like `PieceEncoder`, by one look-up a distinct piece of a portion.

    A piece that begins with letters ends a token after them: its ids are those of this head and of its tail. Each head
    and tail known so far has a row, a run of the flat array of ids, so that one word is encoded once whatever follows it.
    Arrow cuts the texts and numbers their distinct pieces; ids are put together without an object a piece.

    `encode_plain` gives the ids of words without a space in them, each after one space; `encode` those of any strings.
    Strings that are long are not remembered. Where too many are, the half that most portions held stays.
    """

    def __init__(
        self,
        encode_plain: Callable[[list[str]], Iterable[bytes]],
        encode: Callable[[list[str]], Iterable[bytes]],
        remembered: int = 1_000_000,
        longest: int = 64,
    ) -> None:
        self.encode_plain, self.encode = encode_plain, encode
        self.remembered, self.longest = remembered, longest
        self._forget()

    def _forget(self) -> None:
        self.heads: dict[str, int] = {}
        self.tails: dict[str, int] = {}
        self.ids = np.zeros(0, dtype="<u4")
        self.ends = np.zeros(1, dtype=np.int64)
        self.held = np.zeros(0, dtype=np.int32)  # portions that held the row; rows that are not remembered: none

    def _shrink(self) -> None:
        if len(self.heads) + len(self.tails) <= self.remembered and len(self.ids) <= 8 * self.remembered:
            return
        half = self.remembered // 2
        least = np.sort(self.held)[-half - 1] if len(self.held) > half else 0
        stay = np.flatnonzero(self.held > max(least, 0))
        lengths = np.diff(self.ends)[stay]
        if lengths.sum() > 4 * self.remembered:
            self._forget()
            return
        row = np.full(len(self.held), -1)
        row[stay] = np.arange(len(stay))
        row = row.tolist()
        self.heads = {s: row[i] for s, i in self.heads.items() if row[i] >= 0}
        self.tails = {s: row[i] for s, i in self.tails.items() if row[i] >= 0}
        self.ids = runs_of(self.ids, self.ends[stay], lengths)
        self.ends = np.concatenate([[0], np.cumsum(lengths)])
        self.held = self.held[stay] // 2

    def _rows(self, known: dict[str, int], strings: list[str], encode: Callable[[list[str]], list[bytes]]) -> np.ndarray:
        """The row of each distinct string; those without one get it."""
        rows = np.fromiter(map(known.get, strings, itertools.repeat(-1)), np.int64, len(strings))
        self.held[rows[rows >= 0]] += 1
        missing = rows < 0
        new = list(itertools.compress(strings, missing.tolist()))
        coded = encode(new)
        numbers = range(len(self.held), len(self.held) + len(new))
        rows[missing] = numbers
        short = [len(s) <= self.longest for s in new]
        known.update(itertools.compress(zip(new, numbers, strict=True), short))
        self.held = np.concatenate([self.held, np.array(short, dtype=np.int32)])
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(coded), dtype="<u4")])
        lengths = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(lengths)])
        return rows

    def _encode_heads(self, heads: list[str]) -> list[bytes]:
        plain = [len(h) <= self.longest and h.isalpha() for h in heads]
        words = iter(self.encode_plain(list(itertools.compress(heads, plain))))
        others = iter(self.encode([" " + h for h, ok in zip(heads, plain, strict=True) if not ok]))
        return [next(words) if ok else next(others) for ok in plain]

    def _ids_of(self, pieces: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct pieces, each after one space, and the number of each one's."""
        coded = halves(pieces).dictionary_encode()
        strings, codes = coded.dictionary.to_numpy(zero_copy_only=False), coded.indices.to_numpy()
        rows = np.empty(len(codes), np.int64)
        tables = ((self.heads, self._encode_heads), (self.tails, lambda tails: list(self.encode(tails))))
        for side, (known, encode) in enumerate(tables):
            there = np.zeros(len(strings), dtype=bool)
            there[codes[side::2]] = True
            row = np.empty(len(strings), np.int64)
            row[there] = self._rows(known, strings[there].tolist(), encode)
            rows[side::2] = row[codes[side::2]]
        starts, lengths = self.ends[rows], self.ends[rows + 1] - self.ends[rows]
        return runs_of(self.ids, starts, lengths), lengths[::2] + lengths[1::2]

    def __call__(self, texts: list[str] | pa.Array) -> list[bytes]:
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        if not len(texts):
            return []
        self._shrink()
        pieces_of = cut_all(texts)
        counts = pc.list_value_length(pieces_of).to_numpy().astype(np.int64)
        pieces = pieces_of.flatten()
        first = np.zeros(len(pieces), dtype=bool)
        first[np.cumsum(counts) - counts] = True
        firsts = pieces.filter(pa.array(first)).to_pylist()
        distinct = list(set(firsts))
        of_first = dict(zip(distinct, self.encode(distinct), strict=True))
        coded = pieces.filter(pa.array(~first)).dictionary_encode()
        codes = coded.indices.to_numpy()
        values, lengths = self._ids_of(coded.dictionary.cast(pa.string()))
        starts = np.cumsum(lengths) - lengths
        ends = np.concatenate([[0], np.cumsum(lengths[codes])])
        ids = np.empty(ends[-1], dtype="<u4")
        for i in range(0, len(codes), 1 << 18):
            some = codes[i : i + (1 << 18)]
            ids[ends[i] : ends[i + len(some)]] = runs_of(values, starts[some], lengths[some])
        at = ends[np.concatenate([[0], np.cumsum(counts - 1)])].tolist()
        return [of_first[f] + ids[a:b].tobytes() for f, a, b in zip(firsts, at[:-1], at[1:], strict=True)]


def spans(sizes: list[int], most: int) -> Iterable[tuple[int, int]]:
    """Ranges of things of about `most` in all; a larger one is one of its own."""
    start = size = 0
    for i, n in enumerate(sizes):
        if size and size + n > most:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(sizes):
        yield start, len(sizes)


def portions(texts: list[str], most: int = 8_000_000) -> Iterable[tuple[int, int]]:
    """Ranges of texts of about `most` signs in all; a longer text is one of its own."""
    return spans([len(text) for text in texts], most)
