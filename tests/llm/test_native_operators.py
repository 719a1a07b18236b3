"""Exact dedup, quality rules, sharding, line dedup and licences against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from crawlflow.llm import exact_dedup, license_scan, line_dedup, quality_rules, sharding

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(params=["edges", "documents"])
def docs(request):
    return request.getfixturevalue(request.param)


def nulls_first(value):
    return (value is not None, value)


def test_exact_dedup(docs):
    groups = defaultdict(list)
    for row in docs.collect():
        groups[hashlib.sha256((row.text or "").translate(LOWER).encode()).hexdigest()].append(row.doc_id)
    expected = Counter()
    for digest, ids in groups.items():
        keep = max(ids, key=nulls_first)
        expected.update((i, keep, len(ids), i == keep, digest) for i in ids)
    for size in (4096, 64 << 20):  # a full filter only sends more rows through the shuffle
        assert Counter(map(tuple, exact_dedup.memberships(docs, size).collect())) == expected
    stays = exact_dedup.exact_dedup(docs)
    assert stays.columns == docs.columns
    assert Counter(r.doc_id for r in stays.collect()) == Counter(max(ids, key=nulls_first) for ids in groups.values())


def test_bloom_filter_lets_single_rows_pass(documents):
    hashes = documents.select("doc_id", exact_dedup.text_hash(documents.text).alias("digest"))
    flagged = exact_dedup.possibly_repeated(hashes, *exact_dedup.repeat_filter(hashes)).collect()
    count = Counter(r.digest for r in flagged)
    assert all(r.maybe for r in flagged if count[r.digest] > 1)
    assert sum(r.maybe for r in flagged if count[r.digest] == 1) < 0.1 * len(flagged)


def measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality(docs):
    got = quality_rules.quality(docs).collect()
    assert len(got) == docs.count()
    expected = Counter((r.doc_id, *measures(r.text)) for r in docs.collect())
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert Counter(tuple(r[n] for n in names) for r in got) == expected
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_host_with_failing_documents_goes(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, good if i % 10 else "short", "fair") for i in range(40)]
    rows += [(100 + i, "short" if i % 10 else good, "bad") for i in range(40)] + [(200, good, None), (201, good, "new")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id for r in quality_rules.quality(docs).filter("kept").collect()}
    assert kept == {i for i in range(40) if i % 10} | {200, 201}
    assert {r.doc_id for r in quality_rules.keep_quality(docs).collect()} == kept
    # Shrinkage: one failure of a host of one document is not enough.
    signs = " ".join(f"k{i}#|$" for i in range(60))
    more = docs.union(spark.createDataFrame([(300, signs, "one")], docs.schema))
    assert 300 in {r.doc_id for r in quality_rules.quality(more).filter("kept").collect()}
    measures = quality_rules.measured(more, docs.doc_id, docs.source.alias("host"))
    rates = {r.host: r.rate_symbols for r in quality_rules.host_verdicts(measures).collect()}
    assert rates["fair"] < rates["one"] < 1


def test_shrunk_rates_by_brute_force(spark):
    """The moments of the host rates, and the verdict of hosts that fail, computed anew."""
    rules = list(quality_rules.RULES)
    rng = random.Random(8)
    counts = []
    for h in range(60):
        n = rng.choice((1, 3, 20, 400))
        bad = h % 9 == 0
        counts.append((f"h{h}", n, *[rng.randint(n * 9 // 10, n) if bad else min(n, rng.randint(0, 1 + n // 20)) for _ in rules]))
    table = spark.createDataFrame(counts, "host string, n_docs long, " + ", ".join(f"f_{r} long" for r in rules))
    got = {r.host: r for r in quality_rules.verdicts_of_counts(table).collect()}
    h = sum(1 / c[1] for c in counts) / len(counts)
    failing = set()
    for k, rule in enumerate(rules):
        raw = [c[2 + k] / c[1] for c in counts]
        mean = sum(raw) / len(raw)
        spread = sum((r - mean) ** 2 for r in raw) / len(raw)
        between = (spread - mean * (1 - mean) * h) / (1 - h)
        strength = min(max(mean * (1 - mean) / between - 1, 10), 40) if between > 0 else 40
        for c in counts:
            rate = (c[2 + k] + mean * strength) / (c[1] + strength)
            assert abs(got[c[0]][f"rate_{rule}"] - rate) < 1e-9
            failing |= {c[0]} if rate > 0.5 else set()
    assert failing and failing == {name for name, r in got.items() if not r.host_ok}


@pytest.mark.parametrize("others", [20, 2_000, 20_000])
def test_verdict_of_a_failing_host_whatever_the_corpus(spark, others):
    """Hosts of 500 documents failing at 3%, up to ten million documents, and wholly failing hosts of 50 and more."""
    fair = "cast(8 + pmod(xxhash64(id), 15) as long)"
    hosts = spark.range(others).selectExpr("concat('h', id) as host", "500L as n_docs", *[f"{fair} as f_{r}" for r in quality_rules.RULES])
    bad = spark.createDataFrame([(f"bad{n}", n, 0, 0, n, 0) for n in (50, 300, 500)] + [("one", 1, 0, 0, 1, 0)], hosts.schema)
    verdicts = quality_rules.verdicts_of_counts(hosts.union(bad))
    assert {r.host for r in verdicts.filter("not host_ok").collect()} == {"bad50", "bad300", "bad500"}


def test_sharding(docs):
    rows = sharding.sharded(docs, 8).collect()
    texts = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == texts
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert (r.law, r.grown_shard) == ("rows", None)
    sizes = [len(slots[s]) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_sharding_carries_any_column(spark):
    docs = spark.createDataFrame([(i, "t", i, i, i, i) for i in range(50)], "doc_id long, text string, cell long, point long, rank long, span long")
    got = sharding.sharded(docs, 8, *[docs[c] for c in ("cell", "point", "rank", "span")]).collect()
    assert len(got) == 50 and all(r.cell == r.point == r["rank"] == r.span == r.doc_id for r in got)


def test_ring_walk():
    orders = [[0, 1, 2], [1, 2, 0], [2, 0, 1]]
    spans = sharding.walk({0: 5, 1: 1, 2: 0}, orders, [2, 2, 2])
    taken = Counter()
    for s in spans:
        taken[s["shard"]] += s["end"] - s["first"]
    assert taken == {0: 2, 1: 2, 2: 2}
    # Cell 0 fills shard 0 and goes on clockwise: what shard 1 has left, then shard 2.
    assert [(s["shard"], s["first"], s["end"]) for s in spans if s["cell"] == 0] == [(0, 0, 2), (1, 2, 3), (2, 3, 5)]


def test_more_shards_move_few_rows(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "cast(id as string) as text")
    old = {r.doc_id: r.shard for r in sharding.sharded(docs, 8, slack=0.25).collect()}
    new = {r.doc_id: r.shard for r in sharding.sharded(docs, 9, slack=0.25).collect()}
    assert sum(old[i] != new[i] for i in old) < 0.4 * len(old)
    assert max(Counter(new.values()).values()) <= 1.25 * 4000 / 9 + 1


def brute_line_dedup(rows):
    order = sorted({(r.doc_id, r.text or "") for r in rows}, key=lambda x: (x[0] is not None, x[0] or 0))
    first, left = {}, {}
    spans = []
    for doc_id, text in order:
        lines = text.split("\n")
        filled = [(i, line.strip(" \t\n\x0b\f\r")) for i, line in enumerate(lines)]
        filled = [x for x in filled if x[1]]
        for k in range(len(filled) - 2):
            three = filled[k : k + 3]
            key = tuple(x[1] for x in three)
            first[key] = min(first.get(key, (False, 0, 0)) if key in first else (doc_id is not None, doc_id or 0, k), (doc_id is not None, doc_id or 0, k))
            spans.append((key, (doc_id is not None, doc_id or 0, k), (doc_id, text), [x[0] for x in three]))
    covered = defaultdict(set)
    for key, place, doc, at in spans:
        if place != first[key]:
            covered[doc].update(at)
    for doc in order:
        lines = doc[1].split("\n")
        left[doc] = "\n".join(line for i, line in enumerate(lines) if i not in covered[doc]), len(covered[doc])
    return left


def test_line_dedup(docs):
    left = brute_line_dedup(docs.collect())
    got = line_dedup.dedup_lines(docs.select("doc_id", "text", docs.text.alias("was"))).collect()
    assert len(got) == docs.count()
    for r in got:
        assert ((r.text or ""), r.n_removed) == left[(r.doc_id, r.was or "")]


def files(spark):
    rows = [
        (1, "a/LICENSE", "Licensed under the Apache License, Version 2.0."),
        (2, "a/b/x.py", "code\nmore"),
        (3, "a/c/COPYING", "This work is licensed under the GNU General Public License, version 3."),
        (4, "a/c/d/y.py", None),
        (5, "a/c/z.py", "x\n  Released under the MIT License.\ny"),
        (6, "q/w.py", "nothing"),
        (7, None, "nothing"),
        (8, "LICENSE", "permission to be licensed by nobody in particular, ever, at all"),
        (9, "q/w.py", "the driver's licence was lost on the way to the copyright office"),
        (6, "q/w.py", "nothing"),
    ]
    return spark.createDataFrame(rows, "id long, path string, text string")


def test_licences(spark):
    got = {(r.id, r.license, r.origin, r.from_path) for r in license_scan.scan(files(spark)).collect()}
    assert got == {
        (1, "Apache-2.0", "own", "a/LICENSE"),
        (2, "Apache-2.0", "inherited", "a/LICENSE"),
        (3, "GPL-3.0", "own", "a/c/COPYING"),
        (4, "GPL-3.0", "inherited", "a/c/COPYING"),
        (5, "MIT", "own", "a/c/z.py"),
        (6, None, "none", None),
        (7, None, "none", None),
        (8, None, "none", None),
        (9, None, "none", None),
    }
    assert license_scan.scan(files(spark)).count() == 10


def brute_scores(passages):
    """(passage -> license, score) by dictionaries."""
    term = lambda t: Counter(re.findall(r"[^\W_]+", t.lower()))
    templates = [(name, term(t)) for name, ts in license_scan.TEMPLATES.items() for t in ts]
    df, total = Counter(), sum(passages.values()) + len(templates)
    for p, n in passages.items():
        for t in term(p):
            df[t] += n
    for _, t in templates:
        df.update(t.keys())
    idf = {t: math.log((1 + total) / (1 + n)) + 1 for t, n in df.items()}
    unit = lambda c: {t: n * idf[t] / math.sqrt(sum((m * idf[u]) ** 2 for u, m in c.items())) for t, n in c.items()}
    vectors = [(name, unit(t)) for name, t in templates]
    out = {}
    for p in passages:
        v = unit(term(p))
        best = min((-round(sum(w * v.get(t, 0) for t, w in u.items()), 6), name) for name, u in vectors)
        if -best[0] >= 0.7:
            out[p] = (best[1], -best[0])
    return out


def test_licence_scores(spark, documents):
    found = documents.selectExpr("doc_id as id", "concat(source, '/', doc_id) as path", "text")
    passages = Counter(
        line for r in found.collect() for line in {x.strip(" ") for x in r.text.split("\n") if re.search(license_scan.CUE, x)}
    )
    scores = brute_scores(passages)
    assert scores
    texts = {r.id: r.text for r in found.collect()}
    for r in license_scan.scan(found).collect():
        best = min(((-scores[x.strip(" ")][1], scores[x.strip(" ")][0]) for x in texts[r.id].split("\n") if x.strip(" ") in scores), default=None)
        assert (r.license, r.score) == ((best[1], pytest.approx(-best[0])) if best else (None, None))


def test_empty_tables(empty):
    assert exact_dedup.memberships(empty).count() == exact_dedup.exact_dedup(empty).count() == 0
    assert quality_rules.quality(empty).count() == quality_rules.keep_quality(empty).count() == 0
    assert sharding.sharded(empty).count() == 0
    assert line_dedup.dedup_lines(empty).count() == 0
    assert license_scan.scan(empty.selectExpr("doc_id as id", "source as path", "text")).count() == 0


def test_scan_of_a_long_licence_file_keeps_its_text_out_of_the_terms(spark):
    long = "Licensed under the Apache License, Version 2.0\n" + " ".join(f"term{i}" for i in range(30_000))
    found = spark.createDataFrame([(1, "a/LICENSE", long), (2, "a/b.txt", "plain")], "id long, path string, text string")
    got = {(r.id, r.license, r.origin) for r in license_scan.scan(found).collect()}
    assert got == {(1, "Apache-2.0", "own"), (2, "Apache-2.0", "inherited")}


GPL = """This {what} is free software: you can redistribute it and/or modify
it under the terms of the GNU {name} as published by
the Free Software Foundation, either version {version} of the License, or
(at your option) any later version.

This {what} is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU {name} for more details.

You should have received a copy of the GNU {name}
along with this {what}.  If not, see <http://www.gnu.org/licenses/>."""
STANDARD = {
    "GPL-3.0": GPL.format(what="program", name="General Public License", version=3),
    "LGPL-3.0": GPL.format(what="library", name="Lesser General Public License", version=3),
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

     http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR
ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON
ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
}


def test_standard_headers_and_licence_files(spark):
    """Wrapped headers in comments under a copyright line, the same as licence files, and whole licence texts."""
    rows, expected = [], {}
    for k, (name, text) in enumerate(STANDARD.items()):
        lines = [" * Copyright (C) 2019 Jane Q. Public <jane@example.org>", " *", *(f" * {line}".rstrip() for line in text.split("\n"))]
        rows.append((k, f"c{k}/x.c", "\n".join(["/*", " * Frobs the widgets of a tree.", " *", *lines, " */", "", "int main() {}"])))
        rows.append((100 + k, f"f{k}/LICENSE", "Copyright (c) 2019, Jane Q. Public\n\n" + text))
        expected |= {k: name, 100 + k: name}
    for k, name in enumerate(("GPL-3.0", "GPL-2.0", "LGPL-2.1", "AGPL-3.0", "MPL-2.0", "Apache-2.0")):
        text = next(t for t in license_scan.TEMPLATES[name] if len(t) > 8000)
        rows += [(200 + k, f"w{k}/COPYING", "My project\n\n" + " ".join(text.split())), (300 + k, f"w{k}/src/y.c", "int y;")]
        expected |= {200 + k: name, 300 + k: name}
    got = {r.id: r.license for r in license_scan.scan(spark.createDataFrame(rows, "id long, path string, text string")).collect()}
    assert got == expected


def test_line_dedup_names_its_counts(spark):
    docs = spark.createDataFrame([(1, "a\nb\nc\nd", 5, "x"), (2, "a\nb\nc", 6, "y")], "doc_id long, text string, n_lines int, of_id string")
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    assert [(got[i].n_lines, got[i].n_removed, got[i].of_id, got[i].text) for i in (1, 2)] == [(4, 0, "x", "a\nb\nc\nd"), (3, 3, "y", "")]


@pytest.mark.parametrize("size", [4096, 64 << 20])
def test_exact_dedup_by_hash_ranges(spark, edges, size):
    """A filter too large for its bound is cut into ranges; the results are those of one."""
    more = spark.range(6000).selectExpr("id + 1000 as doc_id", "concat('text ', id % 5000) as text")
    docs = edges.select("doc_id", "text").union(more).union(more.limit(10))
    assert exact_dedup.hash_ranges(docs.count(), size) == (4 if size == 4096 else 1)
    whole = Counter(map(tuple, exact_dedup.memberships(docs).collect()))
    assert Counter(map(tuple, exact_dedup.memberships(docs, size).collect())) == whole
    kept = Counter(r.doc_id for r in exact_dedup.exact_dedup(docs, size).collect())
    assert kept == Counter({m[0]: 1 for m in whole if m[3]}) and len(kept) == len({m[4] for m in whole})


def test_share_of_lone_rows_that_shuffle_does_not_grow(spark):
    """At a bound far below what the rows need, as many lone rows in a thousand pass for copies at every size."""
    shares = []
    for n in (10_000, 80_000):
        hashes = spark.range(n).select(exact_dedup.text_hash(F.col("id")).alias("digest"))
        ranges = exact_dedup.hash_ranges(n, 16_384)
        sent = 0
        for k in (0, ranges - 1):
            mine = exact_dedup.in_range(hashes, k, ranges)
            sent += exact_dedup.possibly_repeated(mine, *exact_dedup.repeat_filter(mine, 16_384)).filter("maybe").count() * ranges / 2
        shares.append(sent / n)
    assert max(shares) < 0.03
