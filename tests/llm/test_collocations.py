"""Phrase collocations against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from crawlflow.llm import collocations as c

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least: int, top: int) -> list[tuple]:
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            n[lang] += len(words)
            f.update((lang, *words[i : i + m]) for m in range(1, 6) for i in range(len(words) - m + 1))
    often = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    out = []
    for p, a in often.items():
        longer = (q for q in often if len(q) > len(p) and q[0] == p[0] and any(q[i : i + len(p) - 1] == p[1:] for i in range(1, len(q))))
        if any(100 * often[q] >= 100 * a for q in longer):
            continue
        lang = p[0]
        score, _, left, right = min(
            (1000 * a * n[lang] // (f[p[: k + 1]] * f[(lang, *p[k + 1 :])]), k, f[p[: k + 1]], f[(lang, *p[k + 1 :])]) for k in range(1, len(p) - 1)
        )
        out.append((lang, " ".join(p[1:]), a, left, right, n[lang], score))
    rows = []
    for lang in {r[0] for r in out}:
        mine = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        rows += [(lang, k + 1, *r[1:]) for k, r in enumerate(mine[:top])]
    return sorted(rows)


def got(df, **options) -> list[tuple]:
    return sorted(tuple(r) for r in c.collocations(df, **options).collect())


@pytest.mark.parametrize("range_bytes", [1 << 30, 40_000])
def test_collocations(spark, edges, range_bytes):
    rng = random.Random(1)
    common = "the hot pair of words"
    rows = [(rng.choice(["en", "fr", None]), " ".join(rng.choice([common, "The hot pair", "a b c d e f", "x\ty", "é, w.", f"w{rng.randint(0, 30)}"]) for _ in range(40))) for _ in range(150)]
    rows += [("", "one two three " * 30), ("a", "one two three " * 30)]
    rows += [("de", "same same same same same same " * 30), ("de", None), ("de", ""), ("xx", "\x00     \x00     ." * 40)]
    rows += [(r.lang, r.text) for r in edges.collect()]
    docs = spark.createDataFrame([(t, lang, 1, 2, "c") for lang, t in rows], "text string, lang string, n int, phrase int, f string")
    assert got(docs, least=20, top=60, range_bytes=range_bytes) == plain(rows, 20, 60)


def test_blocks_and_slices_lose_no_window(spark, monkeypatch):
    """Texts longer than a block and a slice; the parts run in this process."""
    monkeypatch.setattr(c, "_SLICE", 50)
    rng = random.Random(4)
    text = " ".join(rng.choice(["a", "b", "cc", "d.", "e"]) for _ in range(3000)).encode()
    assert [w for part in c.tokens(text) for w in part] == c._ENDS.sub(b" \xff ", text).split()
    bounds = [(b"en", b"a", b"b"), (b"en", b"cc", b"x"), (b"en", b"e", b"e", b"e")]
    block, union, pieces = c.Block(bounds), {}, []
    for words in c.tokens(text):
        block.add(b"en", words)
        if block.words > 200:
            done, left = block.cut(c.LONGEST - 1)
            pieces += done
            block.add(b"en", left)
    block.add(b"en", [c.BREAK])
    pieces += block.cut(0)[0]
    for number, data in pieces:
        union.setdefault(number, c.Union(limit=50)).add(c.CountAutomaton.unpacked(data))
    f = Counter()
    for number, u in union.items():
        automaton = u.automaton()
        for level, weight in enumerate(automaton.weights()):
            for row, n in zip(automaton.paths(level, np.arange(len(weight))), weight):
                key = tuple(automaton.symbols[k] for k in row[: level + 1])
                f[key] += int(n)
        for row in automaton.rows()[0]:
            assert c.range_of(tuple(automaton.symbols[k] for k in row if k), bounds) == number
    expected = Counter()
    for piece in text.decode().split("."):
        words = [w.encode() for w in piece.split()]
        expected[(b"en",)] += len(words)
        expected.update((b"en", *words[i : i + m]) for m in range(1, 6) for i in range(len(words) - m + 1))
    assert f == expected


def test_composition():
    rows = np.array([[1, 2, 0, 0, 0, 0], [1, 2, 3, 0, 0, 0], [1, 3, 0, 0, 0, 0], [4, 2, 2, 2, 2, 2]])
    automaton = c.CountAutomaton.of_sorted([b"", b"a", b"b", b"c", b"d"], rows, np.array([5, 2, 3, 7]))
    asked = np.array([[1, 0, 0, 0, 0, 0], [1, 2, 0, 0, 0, 0], [1, 2, 3, 0, 0, 0], [1, 2, 4, 0, 0, 0], [4, 2, 2, 2, 2, 2], [2, 2, 0, 0, 0, 0], [5, 0, 0, 0, 0, 0]])
    assert automaton.composed(asked).tolist() == [10, 7, 2, 0, 7, 0, 0]


def test_scores_pass_64_bits(spark):
    parts = [("en", "x y", 9_000_000_000, 0, "first", 10**13), ("en", "x y", 9_000_000_000, 1, "first", 10**10), ("en", "x y", 9_000_000_000, 1, "rest", 3 * 10**12)]
    table = spark.createDataFrame(parts, "lang string, phrase string, a long, k int, side string, f long")
    assert [r.score for r in c.scored(table).collect()] == [1000 * 9_000_000_000 * 10**13 // (10**10 * 3 * 10**12)]


def test_nothing(spark, empty):
    assert c.collocations(empty).count() == 0
    assert c.collocations(spark.createDataFrame([(None, None)], "text string, lang string")).count() == 0
