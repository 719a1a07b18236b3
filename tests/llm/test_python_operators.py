"""BPE, token files, HTML and near dedup against the library, round trips and brute force."""

import hashlib
import json
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from crawlflow.llm import bpe, html_text, near_dedup, token_files
from crawlflow.llm.pieces import PieceTable

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(params=["edges", "documents"])
def docs(request):
    return request.getfixturevalue(request.param)


def u32(ids):
    return np.array(ids, dtype="<u4").tobytes()


def test_bpe_on_odd_texts(library):
    rng = random.Random(3)
    parts = list("ab  \n\t'sdtrevml019.,!?<|>éß 　\x1c\x85​漢字🙂\r\x0b#aaaa") + ["<|endoftext|>", "'re", " the", "\n\n"]
    own = bpe.bpe_of(PATH)
    coder = token_files.library_encoder(PATH)
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    for text, mine, pieces in zip(texts, own.encode(texts), coder(texts), strict=True):
        ids = library.encode(text, add_special_tokens=False).ids
        assert mine == pieces == u32(ids), text
        assert own.decode(mine) == library.decode(ids, skip_special_tokens=False)
    broken = u32([own.base[0xC3], own.base[0x28], own.base[0xE2], own.base[0x82]])
    assert own.decode(broken) == library.decode(np.frombuffer(broken, "<u4").tolist(), skip_special_tokens=False)


def test_round_trip(docs, library):
    expected = Counter()
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected[(r.doc_id, len(ids), hashlib.sha256(u32(ids)).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())] += 1
    assert Counter(map(tuple, bpe.round_trip(docs, PATH).collect())) == expected


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes(kind):
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 65_536, 1000):
        ids = rng.integers(0, 1 << 32, n, dtype=np.uint32)
        planes = token_files.to_planes(ids, kind)
        assert len(planes) == {"byte": 4, "bit": 32}[kind]
        assert token_files.from_planes(planes, kind, n).tolist() == ids.tolist()


@pytest.mark.parametrize("block,kind", [(65_536, "byte"), (50, "bit")])
def test_token_files(docs, library, block, kind):
    got = sorted(token_files.token_file_digest(docs, PATH, block=block, kind=kind).collect(), key=lambda r: r.start)
    start, expected = 0, Counter()
    order = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert order == sorted(order)
    for r in got:
        assert r.start == start
        start += r.n_tokens
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [0]
        expected[(r.doc_id, len(ids), zlib.crc32(u32(ids)))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == expected


PAGES = {
    None: "",
    "": "",
    "just words  here": "just words here",
    "<html><body><nav><ul><li><a href=x>Menu</a></li></ul></nav><div class='main'><h1>T &amp; t</h1><p>One <b>bold\n word</b> and "
    "more.<p>Two &eacute;<br>end</div><div id='comments'><p>Nice post!</p></div><footer>F</footer></body></html>": "T & t\nOne bold word and more.\nTwo é end",
    "<body><header>Site</header><article><header><h1>Head</h1></header><p>Short.</p><script>var a='</p>';</script><form>F</form>"
    "<aside>Side</aside><p>Long text that goes on for quite a while, <a href=x>with a link</a>.</p></article><div class='ad'>Buy</div>": "Head\nShort.\nLong text that goes on for quite a while, with a link.",
    "<div>" * 3000 + "deep": "deep",
    "<p>a<p>b": "a\nb",
}


def test_html(spark):
    rows = [(i, "u", html) for i, html in enumerate(PAGES)] + [(None, None, "<p>x</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in html_text.extract_pages(pages).collect()}
    for i, expected in enumerate(PAGES.values()):
        assert (got[i].text, got[i].n_chars) == (expected, len(expected))
    assert got[None].text == "x"
    assert html_text.extract_pages(pages.limit(0)).count() == 0


LINE = "A sentence of the article that is about a hundred characters long, so that its density counts for it."
WHOLE_PAGES = {
    # No article or main element: siblings, and a title beside the text.
    f"<body><div><h1>Head</h1><p>{LINE}</p><p>{LINE}</p></div><div>{f'<p>{LINE}</p>' * 5}</div></body>": "Head" + f"\n{LINE}" * 7,
    f"<body><nav><a href=x>Menu</a></nav><h1>Head</h1><div>{f'<p>{LINE}</p>' * 3}</div></body>": "Head" + f"\n{LINE}" * 3,
    # Omitted end tags of what is left out.
    f"<article><p class=notice>Note<p>{LINE}<p>{LINE}</article>": f"{LINE}\n{LINE}",
    f"<article><p>{LINE}</p><ul><li class=nav>Top<li>One<li>Two</ul><p>{LINE}</p></article>": f"{LINE}\nOne\nTwo\n{LINE}",
    f"<article><div><aside>Box</div><p>{LINE}</p></article>": LINE,
    f"<head><title>T</title><meta charset=utf-8><body><p>{LINE}</p>": LINE,
    f"<head><title>T</title><p>{LINE}</p>": LINE,
    # Parts of hyphenated names say nothing, and an article is one by whatever class.
    f"<div class='page has-sidebar'><article class='post comments-open header'><div class=content-header><h1>Head</h1></div><p>{LINE}</p>"
    "</article></div>": f"Head\n{LINE}",
    # Names that would take most of the text.
    f"<body><form id=aspnet><nav><a href=x>Menu</a></nav><p>{LINE}</p></form></body>": LINE,
    f"<body><div class=search><p>{LINE}</p><div class=comments>Nice!</div></div></body>": LINE,
    f"<article><div class=social><p>{LINE}</p></div></article>": LINE,
    f"<body><article><p>{LINE}</p></article><div class=comments>{f'<p>{LINE}</p>' * 9}</div></body>": LINE,
    "<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be even.</p></article>": "Let x=2 be even.",
}


def test_unnamed_boxes_of_pages_without_article_stay_below_the_threshold():
    text = f"<div><h2>Head</h2>{f'<p>{LINE}</p>' * 4}</div>"
    menu = "<div><a href=a>Home</a> <a href=b>News</a> <a href=c>About us</a></div>"
    lines = "\n".join(["Head", *[LINE] * 4])
    around = f"<body><div>Site name tag line</div>{menu}{text}<div>Copyright 2024 All rights reserved</div></body>"
    assert html_text.extract(around) == lines
    # A second container of text, a title in a box of its own, and loose words of the body.
    more = f"<body><div>Tag line</div><div><h1>Title</h1></div>{text}Loose words.<div><p>{LINE}</p><p>{LINE}</p></div><p>Imprint</p></body>"
    assert html_text.extract(more) == f"Title\n{lines}\nLoose words.\n{LINE}\n{LINE}"


def test_what_lies_beside_the_article_in_main_goes():
    teaser = "<div><h3>Teaser</h3><p>Read this other story of ours about something else.</p></div>"
    page = f"<body><main>{teaser}<article><h1>Head</h1>{f'<p>{LINE}</p>' * 3}</article>{teaser}</main></body>"
    assert html_text.extract(page) == "\n".join(["Head", *[LINE] * 3])


def test_html_drops_nothing_else():
    for page, expected in WHOLE_PAGES.items():
        assert html_text.extract(page) == expected, page


def jaccard(a, b):
    def grams(t):
        w = (t or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    x, y = grams(a), grams(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def brute_classes(rows):
    texts = defaultdict(list)
    for r in rows:
        if r.doc_id is not None:
            texts[r.doc_id].append(r.text)
    label = {i: i for i in texts}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(texts)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            if jaccard(texts[i][0], texts[j][0]) >= 0.8:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return {i: root(i) for i in ids}


def test_near_classes(docs):
    rows = docs.collect()
    expected = brute_classes(rows)
    got = near_dedup.near_classes(docs).collect()
    assert len(got) == len(rows)
    sizes = Counter(expected[r.doc_id] for r in rows if r.doc_id is not None)
    for r in got:
        if r.doc_id is None:
            assert (r.class_id, r.class_size, r.kept) == (None, 1, True)
        else:
            assert (r.class_id, r.class_size) == (expected[r.doc_id], sizes[expected[r.doc_id]])
            assert r.kept == (r.doc_id == r.class_id)
    left = near_dedup.near_dedup(docs)
    assert left.columns == docs.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter(r.doc_id for r in got if r.kept)


def test_links_of_members_whose_leaders_differ(spark):
    """A chain of texts, each like the next only, all in common buckets."""
    rng = random.Random(2)
    words = [f"w{rng.randint(0, 10**6)}" for _ in range(200)]
    rows = []
    for i in range(40):
        rows.append((i, " ".join(words)))
        for _ in range(3):
            words[rng.randrange(200)] = f"w{rng.randint(0, 10**6)}"
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute_classes(docs.collect())
    for options in ({}, {"passes": 2, "hot": 2}, {"hot": 0}):
        assert {r.doc_id: r.class_id for r in near_dedup.near_classes(docs, **options).collect()} == expected


def test_texts_that_differ_in_repeats(spark):
    """Whole texts repeated, and pages in which a long passage recurs: alike as sets, not by counts."""
    rng = random.Random(6)
    prose = lambda n: " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(n))
    rows = []
    for i in range(0, 120, 3):
        text, passage, rest = prose(200), prose(150), prose(50)
        rows += [(i, text), (i + 1, " ".join([text] * (2 + i % 7)))]
        rows += [(1000 + i, f"{passage} {rest}"), (1001 + i, " ".join([passage] * (2 + i % 7) + [rest]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in near_dedup.near_classes(docs).collect()} == brute_classes(docs.collect())


def test_dart_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(4)
    elements = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    a, b = rng.uniform(0.2, 6, 300), rng.uniform(0.2, 6, 300)
    b[:200] = a[:200]
    x, y = dict(zip(elements[:300].tolist(), a, strict=True)), dict(zip(elements[100:].tolist(), b, strict=True))
    keys = set(x) | set(y)
    true = sum(min(x.get(k, 0), y.get(k, 0)) for k in keys) / sum(max(x.get(k, 0), y.get(k, 0)) for k in keys)
    all_e = np.concatenate((elements[:300], elements[100:], elements[:1]))
    all_w = np.concatenate((a, b, [0.5]))
    owner = np.repeat([0, 1, 3], [300, 300, 1])
    s = near_dedup.dart_signatures(all_e, all_w, owner, 4, 2048)
    assert abs((s[0] == s[1]).mean() - true) < 0.05
    assert (s[2] == 0).all() and (s[[0, 1, 3]] != 0).all()


def test_empty_tables(empty):
    assert bpe.round_trip(empty, PATH).count() == 0
    assert token_files.token_file_digest(empty, PATH).count() == 0
    assert near_dedup.near_classes(empty).count() == near_dedup.near_dedup(empty).count() == 0


def test_malformed_pages_do_not_fail(spark, sf):
    assert html_text.extract("<article><p>One</p><![foo[b]]><p>Two</p></article>") == "One\nTwo"
    assert html_text.extract("<article><p>One</p><![foo[b") == "One"
    rng = random.Random(3)
    pages = [r.html for r in spark.read.parquet(f"{sf}/pages.parquet").select("html").limit(20).collect()]
    odd = ["<![x[y]]>", "<!doctype [", "<!", "</", "<![CDATA[z]]>", "<?p", "&#xfffffff;", "<a b='", "<!-- ", "\x00", "<![", "]]>", "<!ELEMENT br>"]
    for page in pages:
        for _ in range(10):
            at = rng.randrange(len(page))
            assert isinstance(html_text.extract(page[:at] + rng.choice(odd) + page[at + rng.randrange(3) :]), str)
            assert isinstance(html_text.extract(page[:at]), str)


def test_piece_table_gives_the_librarys_ids(library, documents):
    """Over several portions, with pieces learnt, forgotten and too long to keep."""
    encoder = token_files.library_encoder(public_tokenizers.path("byte_bpe_50k.json"))
    table = PieceTable(encoder.encode_plain, encoder.encode, remembered=500, longest=12)
    texts = [r.text or "" for r in documents.limit(120).collect()]
    texts += ["", " ", "one", " x" * 50, "y" * 40 + " " + "z" * 40, "a  b \n c\n d", "tab\there é è x", "l'été <|endoftext|> x<|endoftext|>y", "\x1c a \x85 b"]
    for _ in range(2):
        for first in range(0, len(texts), 25):
            part = texts[first : first + 25]
            assert [np.frombuffer(d, "<u4").tolist() for d in table(part)] == [library.encode(t, add_special_tokens=False).ids for t in part]
    assert table([]) == []


def test_piece_table_on_arrow_portions(library):
    """Letters of one to four bytes, pieces without any, odd white space beside plain texts, slices, and 64-bit offsets."""
    rng = random.Random(8)
    words = ["a", "don't", "é1", "漢字、漢", "𝒜𝒷c", "ǅ", "ª²", "٣x", "—", "x\ny", "<|endoftext|>", "v<|endoftext|>w", "q" * 70, "#" * 70, "🙂ok", "e\u0301t"]
    gaps = [" "] * 30 + ["  ", " \n", "\n ", "\t", "\u3000"]
    texts = ["".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, 12))) for _ in range(600)]
    texts += [" ".join(rng.choice(words) for _ in range(40)) for _ in range(200)]
    rng.shuffle(texts)
    expected = [u32(library.encode(t, add_special_tokens=False).ids) for t in texts]
    encoder = token_files.library_encoder(PATH)
    table = PieceTable(encoder.encode_plain, encoder.encode, remembered=20)
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(texts, kind)
        assert [d for i in range(0, len(texts), 7) for d in table(column.slice(i, 7))] == expected
    assert table([""]) == [b""] and table(column.slice(0, 0)) == []


def test_piece_table_encodes_a_word_once():
    """Whatever follows it, and whatever else is forgotten if many portions hold it."""
    encoder = token_files.library_encoder(PATH)
    given = Counter()

    def encode_plain(pieces):
        given.update(p.rstrip(",.!") for p in pieces)
        return encoder.encode_plain(pieces)

    table = PieceTable(encode_plain, encoder.encode, remembered=100)
    often = ["alpha", "beta", "gamma", "delta"]
    letters = "abcdefghij"
    for i in range(12):
        rare = ["z" + letters[i // 10] + letters[i % 10] + letters[k // 10] + letters[k % 10] for k in range(30)]
        table(["x " + " ".join(w + mark for w in often for mark in ("", ",", ".", "!")), "x " + " ".join(rare)])
        assert len(table.ends) <= 160
    assert {w: given[w] for w in often} == dict.fromkeys(often, 1)


def test_files_of_another_pattern_are_refused(tmp_path):
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        spec = json.load(file)
    for change in ({"pre_tokenizer": None}, {"pre_tokenizer": {"type": "Whitespace"}}, {"normalizer": {"type": "NFC"}}):
        path = tmp_path / "other.json"
        path.write_text(json.dumps(spec | change))
        with pytest.raises(ValueError, match="byte-level"):
            token_files.library_encoder.__wrapped__(str(path))
        with pytest.raises(ValueError, match="byte-level"):
            bpe.PairIndexBpe(str(path))


def test_near_classes_of_ids_with_several_texts(spark):
    """As many rows as come in; an id's texts bring their classes together."""
    rng = random.Random(9)
    texts = [" ".join(rng.choice("abcdefghij") + str(rng.randint(0, 99)) for _ in range(80)) for _ in range(6)]
    near = [t + " tail" for t in texts]
    rows = [(1, texts[0]), (2, near[0]), (5, texts[0]), (5, texts[1]), (3, near[1]), (4, texts[1]), (5, texts[0])]
    rows += [(7, texts[2]), (8, near[2]), (9, texts[3]), (9, texts[4]), (None, texts[2]), (None, texts[0]), (10, None), (10, ""), (11, texts[5])]
    docs = spark.createDataFrame([(i, t, 0, "c") for i, t in rows], "doc_id long, text string, node long, class string")
    got = near_dedup.near_classes(docs).collect()
    of = {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 7: 7, 8: 7, 9: 9, 10: 10, 11: 11}
    sizes = Counter(of[i] for i, _ in rows if i is not None)
    expected = Counter((i, of.get(i), sizes.get(of.get(i), 1), i is None or of[i] == i) for i, _ in rows)
    assert Counter(map(tuple, got)) == expected
    kept = Counter(r.doc_id for r in near_dedup.near_dedup(docs).collect())
    assert kept == Counter({1: 1, 7: 1, 9: 2, None: 2, 10: 2, 11: 1})


def test_workers_remember_little_between_tasks(spark):
    texts = [" ".join(f"w{i}x{k}" for k in range(1000)) for i in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)

    def left(batches):
        for _ in batches:
            told = len(near_dedup.WORD_IDS), len(bpe.bpe_of(PATH).pieces.known)
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()) for n in told], names=["words", "pieces"])

    assert near_dedup.signed(docs).filter("size(keys) = 24").count() == 120
    assert bpe.round_trip(docs, PATH).filter("n_tokens > 1000").count() == 120
    found = spark.range(64).repartition(16).mapInArrow(left, "words long, pieces long").collect()
    assert found and all(row["words"] <= 100_000 and row["pieces"] <= 100_000 for row in found)
