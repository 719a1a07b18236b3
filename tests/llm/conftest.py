import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, digest string, class_id long"


def edge_rows() -> list[tuple]:
    """Nulls, empty and very long texts, ties, repeated rows, and columns named like inner ones."""
    rng = random.Random(5)
    words = ["alpha", "beta", "Gamma", "delta,", "rock's", "été", "漢字", "tail.", "x|y", "###"]
    prose = lambda n: " ".join(rng.choice(words) + str(rng.randint(0, 40)) for _ in range(n))
    base = prose(300)
    near = base.split(" ")
    near[150] = "changed"
    texts = [None, "", " \t\n ", "word", "one two three four", base, base.upper(), " ".join(near), prose(120)]
    texts += ["same words again " * 30, "a\nb\nc\nd\na\nb\nc\n", "x\n\n a \nb\nc\nd", prose(60_000), "z" * 20_000]
    texts += ["tail  two   spaces　<|endoftext|> end \n\n", "Released under the MIT License.", base + " more"]
    rows = [(i, t, "en", f"s{i % 3}", len(t or ""), "r", "d", 7) for i, t in enumerate(texts)]
    rows += [rows[5], rows[8], (None, base, None, None, None, None, None, None), (None, "", None, None, None, None, None, None)]
    return rows + [(90, prose(80), None, None, None, None, None, None)]


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
