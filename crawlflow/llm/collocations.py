"""Phrase collocations by weighted acyclic automata.

Each shard reads its texts in blocks. A block's windows of up to five words, sorted, become a count transducer: a
deterministic acyclic automaton whose states are the windows' prefixes, built level by level from the sorted rows, a
state's weight being the number of windows that pass it. So one window a word carries the counts of all phrases that
start there. Automata are cut at the bounds of prefix ranges and sent, compressed, to the range's task, which unites them
and sums weights. Ranges are quantiles of sampled windows, so that a hot word or pair spreads over several; the few prefixes
of the bounds themselves are summed over their ranges afterwards. What is left is the automaton of the phrases found
often enough, and the parts of a phrase are found often enough as well.

Part counts come by composition: each candidate asks for its first parts, its rests and the total of its language; asks
and phrases meet by prefix range, the phrases as a count transducer, the asks as the acceptor it is composed with. A
range that is asked for often (by all phrases ending in one word) is dealt in parts.

Defined results: a null text counts as empty, a null lang as `und`. Words and pieces are as in the contract: A-Z in
lower case, pieces end at `.,;:!?` and line ends, words at spaces and tabs; any other character belongs to a word. doc_id
is not read: repeated rows count as often as they are there. Ties go by score, then count, then the phrase's bytes. Scores
are whole decimals of 38 digits; a score beyond a long is an error. An empty table gives an empty result. Further columns are
not read.

The driver holds 16 sampled windows of at most 64 bytes a word for each range of `range_bytes` of text.
"""

from __future__ import annotations

import re
import struct
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crawlflow.llm.shared import pinned, text_of

LONGEST = 5
DEPTH = LONGEST + 1  # the language, then the words
# What ends a piece, and A-Z in lower case.
_ENDS = re.compile(rb"[.,;:!?\n-\r]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_CUT = re.compile(rb"[ \t.,;:!?\n-\r]")
#: Stands between pieces; no byte of a text in UTF-8.
BREAK = b"\xff"
#: Sampled windows a range, and the bytes that are kept of their words.
SAMPLES, KEY_BYTES = 16, 64
_SLICE = 1 << 20
_BLOCK_WORDS = 1 << 20
Key = tuple[bytes, ...]


def language(lang: bytes) -> bytes:
    """A language as a symbol: never empty, and no word."""
    return b"\xfe" + lang


def tokens(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text with a BREAK between pieces, in slices of about a megabyte."""
    at = 0
    while at < len(text):
        cut = _CUT.search(text, at + _SLICE)
        end = cut.start() if cut and cut.start() > at else len(text)
        # What is left for split() to cut at are spaces and tabs: all other white space ends pieces.
        yield _ENDS.sub(b" \xff ", text[at:end].translate(_LOWER)).split()
        at = end


def _packed(arrays: Sequence[np.ndarray], symbols: Sequence[bytes]) -> bytes:
    """Whole numbers as byte planes of just the width they need, behind the symbols."""
    text = BREAK.join(symbols)
    parts = [struct.pack("<II", len(text), len(arrays)), text]
    for values in arrays:
        width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
        parts.append(struct.pack("<IB", len(values), width))
        parts.append(np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def _unpacked(data: bytes) -> tuple[list[np.ndarray], list[bytes]]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    size, n = struct.unpack_from("<II", raw)
    at = 8 + size
    arrays = []
    for _ in range(n):
        length, width = struct.unpack_from("<IB", raw, at)
        planes = np.frombuffer(raw, np.uint8, length * width, at + 5).reshape(width, length)
        values = np.zeros(length, np.int64)
        for k in range(width):
            values |= planes[k].astype(np.int64) << (8 * k)
        arrays.append(values)
        at += 5 + length * width
    return arrays, raw[8 : 8 + size].split(BREAK)


def sorted_rows(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of labels in order, with their summed counts."""
    if not len(rows):
        return rows, counts
    most = int(rows.max())
    if most < 1 << 21:
        keys = [(rows[:, k].astype(np.int64) << 42) | (rows[:, k + 1].astype(np.int64) << 21) | rows[:, k + 2] for k in (0, 3)]
        order = np.lexsort((keys[1], keys[0]))
        keys = [k[order] for k in keys]
        new = np.r_[True, (keys[0][1:] != keys[0][:-1]) | (keys[1][1:] != keys[1][:-1])]
    else:
        order = np.lexsort(rows.T[::-1])
        new = np.r_[True, (rows[order][1:] != rows[order][:-1]).any(1)]
    starts = np.flatnonzero(new)
    return rows[order[starts]], np.add.reduceat(counts[order], starts)


class CountAutomaton:
    """States by level: `labels` and `parents` of each, and `ends`, the windows that end in it.

    Level 0 is the language. Labels are positions in `symbols` (0: none). States of a level are ordered as
    the sorted rows they are built from, so a level's (parent, label) pairs are in order as well.
    """

    def __init__(self, symbols: list[bytes], labels: list[np.ndarray], parents: list[np.ndarray], ends: list[np.ndarray]) -> None:
        self.symbols, self.labels, self.parents, self.ends = symbols, labels, parents, ends

    @classmethod
    def of_sorted(cls, symbols: list[bytes], rows: np.ndarray, counts: np.ndarray) -> CountAutomaton:
        """From distinct rows of labels in order, 0 after a row's last label."""
        labels, parents, ends = [], [], []
        new = np.zeros(len(rows), dtype=bool)
        new[:1] = True
        above = np.zeros(len(rows), dtype=np.int64)
        for level in range(DEPTH):
            column = rows[:, level]
            new = new | np.r_[True, column[1:] != column[:-1]][: len(rows)]
            state = new & (column > 0)
            labels.append(column[state].astype(np.int64))
            parents.append(above[state])
            number = np.cumsum(state) - 1
            last = (column > 0) & (rows[:, level + 1] == 0 if level + 1 < DEPTH else True)
            ends.append(np.bincount(number[last], counts[last], int(state.sum())).astype(np.int64) if state.any() else np.zeros(0, np.int64))
            above = number
        return cls(symbols, labels, parents, ends)

    def weights(self) -> list[np.ndarray]:
        """Windows that pass each state: those that end in it and those that pass its children."""
        out = [e.copy() for e in self.ends]
        for level in range(DEPTH - 1, 0, -1):
            np.add.at(out[level - 1], self.parents[level], out[level])
        return out

    def paths(self, level: int, states: np.ndarray) -> np.ndarray:
        """The rows of labels that lead to states of a level."""
        rows = np.zeros((len(states), DEPTH), dtype=np.int64)
        for k in range(level, -1, -1):
            rows[:, k] = self.labels[k][states]
            states = self.parents[k][states]
        return rows

    def rows(self) -> tuple[np.ndarray, np.ndarray]:
        """All windows and their counts, in no order."""
        picked = [np.flatnonzero(e) for e in self.ends]
        return (
            np.concatenate([self.paths(level, states) for level, states in enumerate(picked)]),
            np.concatenate([e[states] for e, states in zip(self.ends, picked)]),
        )

    def packed(self) -> bytes:
        """Bytes with the symbols in use; parents as steps from state to state."""
        used = np.unique(np.concatenate([np.zeros(1, np.int64), *self.labels]))
        arrays = []
        for labels, parents, ends in zip(self.labels, self.parents, self.ends):
            arrays += [np.searchsorted(used, labels), np.diff(parents, prepend=0), ends]
        return _packed(arrays, [self.symbols[k] for k in used])

    @classmethod
    def unpacked(cls, data: bytes) -> CountAutomaton:
        arrays, symbols = _unpacked(data)
        return cls(symbols, arrays[0::3], [np.cumsum(p) for p in arrays[1::3]], arrays[2::3])

    def composed(self, asked: np.ndarray) -> np.ndarray:
        """Composition with an acceptor of rows of labels: the weight of each row's state, 0 where there is none.

        Level by level: a row's next state is where its (state, label) lies among the pairs of the level.
        """
        state, found = np.zeros((2, len(asked)), dtype=np.int64)
        alive = np.ones(len(asked), dtype=bool)
        base = len(self.symbols) + 1
        for level, weight in enumerate(self.weights()):
            # A row that has ended keeps what it found.
            hit = alive & (asked[:, level] > 0)
            found[hit] = 0
            pairs = self.parents[level] * base + self.labels[level]
            wanted = state * base + asked[:, level]
            at = np.searchsorted(pairs, wanted)
            hit &= at < len(pairs)
            hit[hit] = pairs[at[hit]] == wanted[hit]
            state[hit], found[hit] = at[hit], weight[at[hit]]
            alive = hit
        return found


def range_of(key: Key, bounds: Sequence[Key]) -> int:
    return bisect_right(bounds, key)


def _labels_of(bound: Key, langs: list[bytes], words: list[bytes]) -> list[int]:
    """The least row of labels that is not below a bound; symbols start at 1, in byte order."""
    row = []
    for level, symbol in enumerate(bound):
        among = words if level else langs
        at = bisect_left(among, symbol)
        row.append(at + 1)
        if at == len(among) or among[at] != symbol:
            break
    return row + [0] * (DEPTH - len(row))


class Block:
    """Words of a shard until they are a block, then its automata cut by range."""

    def __init__(self, bounds: Sequence[Key]) -> None:
        self.bounds = bounds
        self._clear()

    def _clear(self) -> None:
        self.vocabulary: defaultdict[bytes, int] = defaultdict()
        self.vocabulary.default_factory = self.vocabulary.__len__
        self.vocabulary[BREAK]
        self.ids: list[np.ndarray] = []
        self.langs: list[tuple[bytes, int]] = []
        self.words = 0

    def add(self, lang: bytes, words: list[bytes]) -> None:
        if words:
            self.ids.append(np.fromiter(map(self.vocabulary.__getitem__, words), np.int64, len(words)))
            self.langs.append((lang, len(words)))
            self.words += len(words)

    def cut(self, rest: int) -> tuple[list[tuple[int, bytes]], list[bytes]]:
        """(range, automaton) of all words but the last `rest`, which are given back."""
        ids = np.concatenate(self.ids) if self.ids else np.zeros(0, np.int64)
        names = list(self.vocabulary)
        left = [names[k] for k in ids[len(ids) - rest :]] if rest else []
        pieces = self._pieces(ids, names, max(0, len(ids) - rest))
        self._clear()
        return pieces, left

    def _pieces(self, ids: np.ndarray, names: list[bytes], starts: int) -> list[tuple[int, bytes]]:
        if not starts:
            return []
        words = sorted(names[1:])
        of = {word: k + 1 for k, word in enumerate(words)}
        rank = np.array([0, *(of[name] for name in names[1:])], dtype=np.int64)
        langs = sorted({lang for lang, _ in self.langs})
        number = {name: k + 1 for k, name in enumerate(langs)}
        lang = np.repeat([number[name] for name, _ in self.langs], [n for _, n in self.langs])[:starts]
        padded = np.concatenate([rank[ids], np.zeros(LONGEST, np.int64)])
        columns = [lang, padded[:starts]]
        for k in range(1, LONGEST):
            # A window ends where its piece does.
            columns.append(np.where(columns[-1] > 0, padded[k : k + starts], 0))
        rows = np.stack(columns, axis=1)
        rows = rows[rows[:, 1] > 0]
        rows, counts = sorted_rows(rows, np.ones(len(rows), np.int64))
        edges = [0, *self._edges(rows, langs, words), len(rows)]
        out = []
        for k, (first, end) in enumerate(zip(edges, edges[1:])):
            if first < end:
                part = rows[first:end].copy()
                # One list of symbols: languages after the words.
                part[:, 0] += len(words)
                out.append((k, CountAutomaton.of_sorted([b"", *words, *langs], part, counts[first:end]).packed()))
        return out

    def _edges(self, rows: np.ndarray, langs: list[bytes], words: list[bytes]) -> list[int]:
        def key(of: np.ndarray, k: int) -> np.ndarray:
            return (of[:, k] << 42) | (of[:, k + 1] << 21) | of[:, k + 2]

        if not self.bounds or not len(rows):
            return [0] * len(self.bounds)
        asked = np.array([_labels_of(b, langs, words) for b in self.bounds], dtype=np.int64)
        first, second = key(rows, 0), key(rows, 3)
        edges = []
        for a, b in zip(key(asked, 0), key(asked, 3)):
            low, high = np.searchsorted(first, a, "left"), np.searchsorted(first, a, "right")
            edges.append(int(low + np.searchsorted(second[low:high], b, "left")))
        return edges


def shard_automata(texts: DataFrame, bounds: list[Key]) -> DataFrame:
    """piece_range and the packed automaton of each block of `texts` (lang, text: binary) in each range."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(bounds)

        def sent(pieces: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(pieces), 64):
                part = pieces[at : at + 64]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _ in part], pa.int32()), pa.array([data for _, data in part], pa.binary())], names=["piece_range", "automaton"]
                )

        for batch in batches:
            for lang, text in zip(map(language, batch.column(0).to_pylist()), batch.column(1)):
                for words in tokens(text.as_py()):
                    block.add(lang, words)
                    if block.words >= _BLOCK_WORDS:
                        # Windows of the last words go on in the next slice.
                        pieces, left = block.cut(LONGEST - 1)
                        yield from sent(pieces)
                        block.add(lang, left)
                block.add(lang, [BREAK])
        yield from sent(block.cut(0)[0])

    return texts.mapInArrow(run, "piece_range int, automaton binary")


class Union:
    """Automata of a range united: windows over one list of symbols, their counts summed."""

    def __init__(self, limit: int = 1 << 21) -> None:
        self.symbols: defaultdict[bytes, int] = defaultdict()
        self.symbols.default_factory = self.symbols.__len__
        self.symbols[b""]
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting, self.limit = 0, limit

    def add(self, automaton: CountAutomaton) -> None:
        to = np.fromiter(map(self.symbols.__getitem__, automaton.symbols), np.int64, len(automaton.symbols))
        rows, counts = automaton.rows()
        self.parts.append((to[rows].astype(np.int32), counts))
        self.waiting += len(rows)
        if self.waiting >= self.limit:
            self._sum()

    def _sum(self) -> None:
        self.parts = [sorted_rows(np.concatenate([r for r, _ in self.parts]), np.concatenate([c for _, c in self.parts]))]
        # Sum again once as much has come as has stayed.
        self.waiting, self.limit = 0, max(self.limit, len(self.parts[0][0]))

    def automaton(self) -> CountAutomaton:
        self._sum()
        return CountAutomaton.of_sorted(list(self.symbols), *self.parts[0])


def _often(automaton: CountAutomaton, least: int, bounds: Sequence[Key], number: int) -> Iterator[tuple[str, str, int, int, bool]]:
    """(lang, phrase, n_words, f, partial) of the states found often enough, and of all that other ranges may share."""
    edges = [bounds[k] for k in (number - 1, number) if 0 <= k < len(bounds)]
    shared = {edge[: level + 1] for edge in edges for level in range(len(edge))}
    label = {symbol: k for k, symbol in enumerate(automaton.symbols)}
    on_edge = {tuple(label.get(symbol, -1) for symbol in path) for path in shared}
    for level, weight in enumerate(automaton.weights()):
        wanted = weight >= least if level else np.ones(len(weight), dtype=bool)
        last = {path[-1] for path in on_edge if len(path) == level + 1}
        near = np.flatnonzero(~wanted & np.isin(automaton.labels[level], list(last)))
        near = near[[tuple(row[: level + 1]) in on_edge for row in automaton.paths(level, near).tolist()]] if len(near) else near
        states = np.concatenate([np.flatnonzero(wanted), near]).astype(np.int64)
        for row, f in zip(automaton.paths(level, states).tolist(), weight[states].tolist()):
            path = tuple(row[: level + 1])
            words = [automaton.symbols[k] for k in path]
            yield words[0][1:].decode(), b" ".join(words[1:]).decode(), level, f, level == 0 or path in on_edge


def united(pieces: DataFrame, bounds: list[Key], least: int) -> DataFrame:
    """lang, phrase, n_words, f and `partial` of each range's phrases; the empty phrase is the language's total."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unions: dict[int, Union] = {}
        for batch in batches:
            for number, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                unions.setdefault(number, Union()).add(CountAutomaton.unpacked(data.as_py()))
        kinds = {"lang": pa.string(), "phrase": pa.string(), "n_words": pa.int32(), "f": pa.int64(), "partial": pa.bool_()}
        for number in list(unions):
            found = list(_often(unions.pop(number).automaton(), least, bounds, number))
            for at in range(0, len(found), 10_000):
                columns = list(zip(*found[at : at + 10_000]))
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds.values())], names=list(kinds))

    dealt = pieces.repartitionById(len(bounds) + 1, F.col("piece_range"))
    return dealt.mapInArrow(run, "lang string, phrase string, n_words int, f bigint, partial boolean")


def range_bounds(texts: DataFrame, range_bytes: int) -> list[Key]:
    """Quantiles of windows at sampled places of the texts, one range for each `range_bytes` of text."""
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = -(-total // range_bytes)
    if ranges < 2:
        return []
    share = F.octet_length("text") * SAMPLES / F.lit(range_bytes)
    times = F.floor(share + F.rand(11)).cast("int")
    places = texts.withColumn("times", times).where("times > 0").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("times"))))
    at = F.floor(F.rand(12) * F.octet_length("text")).cast("int") + 1
    sampled = places.select("lang", F.substring("text", at, F.lit(400)).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                # The first word may be cut.
                words = [word for part in tokens(text) for word in part][1:]
                while words and words[0] == BREAK:
                    words.pop(0)
                end = words.index(BREAK) if BREAK in words else len(words)
                if end:
                    keys.append([s[:KEY_BYTES] for s in (language(lang), *words[: min(end, LONGEST)])])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.list_(pa.binary()))], names=["key"])

    keys = sorted(tuple(map(bytes, r["key"])) for r in sampled.mapInArrow(run, "key array<binary>").collect())
    picked = {keys[len(keys) * k // ranges] for k in range(1, ranges)} if keys else set()
    return sorted(picked)


def phrase_counts(docs: DataFrame, least: int = 100, range_bytes: int = 8 << 20) -> tuple[DataFrame, list[Key]]:
    """lang, phrase, n_words and f of the phrases found at least `least` times, and the languages' totals; the ranges' bounds."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).cast("binary").alias("lang")
    texts = docs.select(lang, text_of(F.col("text")).cast("binary").alias("text"))
    bounds = range_bounds(texts, range_bytes)
    parts = pinned(united(shard_automata(texts, bounds), bounds, least))
    names = ["lang", "phrase", "n_words"]
    shared = parts.where("partial").groupBy(*names).agg(F.sum("f").alias("f"))
    return parts.where("not partial").select(*names, "f").union(shared.where((F.col("f") >= least) | (F.col("n_words") == 0))), bounds


_ASKS = "ask_range int, part string, lang string, phrase string, n_words int, a bigint, k int, side string"


def _asks(counts: DataFrame, bounds: list[Key]) -> DataFrame:
    """A row for each part of a candidate: `first` and `rest` of each cut, and the language's total as the cut 0."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for lang, phrase, n, a in zip(*(c.to_pylist() for c in batch.columns)):
                words = phrase.split(" ")
                parts = [(0, "first", [])] + [(k, "first", words[:k]) for k in range(1, n)] + [(k, "rest", words[k:]) for k in range(1, n)]
                for k, side, part in parts:
                    key = (language(lang.encode()), *(word.encode() for word in part))
                    rows.append((range_of(key, bounds), " ".join(part), lang, phrase, n, a, k, side))
            columns = list(zip(*rows)) or [[]] * 8
            kinds = [pa.int32(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.string()]
            names = [part.split()[0] for part in _ASKS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=names)

    return counts.where("n_words > 1").select("lang", "phrase", "n_words", "f").mapInArrow(run, _ASKS)


def _with_range(counts: DataFrame, bounds: list[Key]) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            of = [range_of(tuple(path), bounds) for path in _paths(*zip(*keys))] if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(of, pa.int32())], names=["lang", "phrase", "f", "own_range"])

    return counts.select("lang", "phrase", "f").mapInArrow(run, "lang string, phrase string, f bigint, own_range int")


def _rows_of(paths: list[list[bytes]], label: dict[bytes, int]) -> np.ndarray:
    rows = np.zeros((len(paths), DEPTH), dtype=np.int64)
    for i, path in enumerate(paths):
        for k, symbol in enumerate(path):
            rows[i, k] = label.get(symbol, len(label) + 1)
    return rows


def _paths(langs: Iterable[str], phrases: Iterable[str]) -> list[list[bytes]]:
    return [[language(lang.encode()), *(phrase.encode().split(b" ") if phrase else ())] for lang, phrase in zip(langs, phrases)]


def _composed(asks: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
    """The asks with `f`, the count of their part."""
    paths = _paths(counts["lang"], counts["phrase"])
    symbols = [b"", *sorted({symbol for path in paths for symbol in path})]
    label = {symbol: k for k, symbol in enumerate(symbols) if k}
    rows, f = sorted_rows(_rows_of(paths, label), counts["f"].to_numpy())
    transducer = PhraseTransducer.of_counts(symbols, rows, f)
    return asks.assign(f=transducer.composed(_rows_of(_paths(asks["lang"], asks["part"]), label)))


class PhraseTransducer(CountAutomaton):
    """Counts at the states of phrases themselves, not summed from longer ones."""

    @classmethod
    def of_counts(cls, symbols: list[bytes], rows: np.ndarray, counts: np.ndarray) -> PhraseTransducer:
        return cls.of_sorted(symbols, rows, counts)

    def weights(self) -> list[np.ndarray]:
        return self.ends


def parts_of(counts: DataFrame, bounds: list[Key], asks_per_task: int = 100_000) -> DataFrame:
    """Each candidate's asks with the counts of their parts."""
    asks = pinned(_asks(counts, bounds))

    def times(of: str, column: str) -> DataFrame:
        """How many tasks a range's asks are dealt to."""
        return asks.groupBy(F.col("ask_range").alias(of)).agg(F.ceil(F.count("*") / asks_per_task).cast("int").alias(column))

    dealt = asks.join(times("of_range", "deals"), F.col("ask_range") == F.col("of_range"))
    dealt = dealt.withColumn("deal", F.pmod(F.xxhash64("phrase", "k", "side"), F.col("deals")).cast("int"))
    own = _with_range(counts, bounds).join(times("asked_range", "copies"), F.col("own_range") == F.col("asked_range"))
    own = own.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    schema = _ASKS + ", f bigint"
    names = [part.split()[0] for part in _ASKS.split(", ")]

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _composed(left[names], right)

    return dealt.groupBy("ask_range", "deal").cogroup(own.groupBy("own_range", "copy")).applyInPandas(run, schema)


def _whole(value: Column) -> Column:
    return value.cast("decimal(19,0)")


def scored(parts: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, n and score of every candidate, by its lowest cut."""
    cut = F.col("k")
    counts = [F.max(F.when(cut == 0, F.col("f"))).alias("n")]
    for k in range(1, LONGEST):
        counts += [F.max(F.when((cut == k) & (F.col("side") == side), F.col("f"))).alias(f"{side}{k}") for side in ("first", "rest")]
    told = parts.groupBy("lang", "phrase", "a").agg(*counts)
    thousand = F.lit(1000).cast("decimal(4,0)")
    for k in range(1, LONGEST):
        told = told.withColumns({"_top": thousand * _whole(F.col("a")) * _whole(F.col("n")), "_low": _whole(F.col(f"first{k}")) * _whole(F.col(f"rest{k}"))})
        told = told.withColumn(f"score{k}", F.expr("_top div _low")).drop("_top", "_low")
    cuts = [F.when(F.col(f"first{k}").isNotNull(), F.struct(F.col(f"score{k}").alias("score"), F.lit(k).alias("k"), F.col(f"first{k}").alias("l"), F.col(f"rest{k}").alias("r"))) for k in range(1, LONGEST)]
    return told.withColumn("cut", F.least(*cuts)).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def contained(parts: DataFrame) -> DataFrame:
    """lang and phrase of those that a longer candidate found as often holds.

    Counts never grow with length, so such a phrase is also held by one that is longer by one word.
    """
    ends = ((F.col("side") == "first") & (F.col("k") == F.col("n_words") - 1)) | ((F.col("side") == "rest") & (F.col("k") == 1))
    return parts.where((F.col("n_words") > 2) & ends & (F.col("a") >= F.col("f"))).select("lang", F.col("part").alias("phrase"))


def first_of_each(candidates: DataFrame, top: int, deals: int = 64) -> DataFrame:
    """Each language's first `top`, with their rank; a language is dealt in parts before one task sees what they leave."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    dealt = candidates.withColumn("deal", F.pmod(F.xxhash64("phrase"), F.lit(deals)))
    dealt = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "deal").orderBy(*order))).where(F.col("rank") <= top)
    ranked = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, range_bytes: int = 8 << 20) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's first `top` phrases."""
    counts, bounds = phrase_counts(docs, least, range_bytes)
    parts = pinned(parts_of(counts, bounds))
    candidates = scored(parts).join(contained(parts), ["lang", "phrase"], "left_anti")
    return first_of_each(candidates, top)
