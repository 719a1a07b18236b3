"""The classifier on held-out labels, the rates against their targets, and the pipeline stage by stage."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from crawlflow.llm import bpe, exact_dedup, mixing, near_dedup, quality_rules
from crawlflow.llm import queries as registered

LARGER = "/root/testdata/sf0.1"


def brute_rates(tokens, p, weights, iterations=25, tolerance=0.002):
    n = p * tokens[:, None]
    there = n.sum(axis=0)
    budget = there[0] / weights[0]
    targets = budget * np.array(weights)
    rate = np.ones(len(tokens))
    for _ in range(iterations):
        gap = targets - rate @ n
        if abs(gap).max() <= tolerance * budget:
            break
        last, rate = rate @ n, np.clip(rate + p @ (gap / there), 0, 1)
        if abs(rate @ n - last).max() <= tolerance * budget / 20:
            break
    return rate


def test_rates_meet_targets(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = mixing.mixing_rates(docs, labels).orderBy("doc_id").collect()
    tokens = np.array([r.n_tokens for r in rows], float)
    p = np.array([[r.p_good, r.p_poor, r.p_toxic] for r in rows])
    rate = np.array([r.rate for r in rows])
    assert np.allclose(p.sum(axis=1), 1) and (rate >= 0).all() and (rate <= 1).all()
    assert np.allclose(rate, brute_rates(tokens, p, [0.98, 0.02, 0.0]), atol=1e-6)
    narrow = spark.createDataFrame(
        [(int(n), [float(x) for x in q]) for n, q in zip(tokens, p, strict=True)], "n_tokens long, p array<double>"
    )
    steps, targets, reached = mixing.fit_rates(narrow, {"good": 0.5, "poor": 0.4, "toxic": 0.1}, budget=3 * tokens.sum(), max_rate=None, iterations=200)
    assert np.allclose(targets, reached, rtol=0.05)  # repeats allowed: any mix can be met


def test_classifier_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{LARGER}/{t}.parquet") for t in ("documents", "labels"))
    train, test = labels.filter("doc_id % 5 <> 0"), labels.filter("doc_id % 5 = 0")
    model = mixing.fit_classifier(docs, train)
    told = mixing.posteriors(docs.join(test, "doc_id"), model, mixing.domain_of_label(F.col("quality"), F.col("toxic")).alias("domain"))
    rows = told.collect()
    right = Counter(mixing.DOMAINS[max(range(3), key=lambda k: r.p[k])] == r.domain for r in rows)
    assert right[True] / len(rows) > 0.9
    narrow = mixing.posteriors(docs, model).cache()
    _, targets, reached = mixing.fit_rates(narrow)
    assert np.allclose(np.array(reached) / sum(reached), [0.98, 0.02, 0.0], atol=0.01)  # half the smallest share
    told = mixing.mixing_rates(docs, labels).agg(*[F.min(f"{n}_{d}") for n in ("target", "reached") for d in mixing.DOMAINS]).first()
    assert told[0] > 0 and told[2] == 0 and np.allclose(np.array(told[3:]) / sum(told[3:]), [0.98, 0.02, 0.0], atol=0.01)
    assert reached[0] > 0.95 * targets[0]  # the main domain stays


def test_mixing_edges(spark, edges, empty):
    labels = spark.createDataFrame(
        [(5, 1, 0), (5, 1, 0), (8, 0, 0), (16, 1, None), (None, 1, 1), (999, 0, 1), (12, None, None)], "doc_id long, quality int, toxic int"
    )
    rates = mixing.mixing_rates(edges, labels).collect()
    assert len(rates) == edges.count()
    assert all(r.rate >= 0 and abs(r.p_good + r.p_poor + r.p_toxic - 1) < 1e-9 for r in rates)
    assert mixing.mix(edges, labels).columns == edges.columns
    assert mixing.mixing_rates(edges, labels.limit(0)).count() == len(rates)
    assert mixing.mixing_rates(empty, labels).count() == mixing.mix(empty, labels).count() == 0


def test_copies_follow_the_rates(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "'some words here' as text")
    labels = spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int")
    assert mixing.mix(docs, labels, {"good": 1.0, "poor": 0.0, "toxic": 0.0}, budget=1e9, max_rate=1.0).count() == 3000
    rate = mixing.mixing_rates(docs, labels, {"good": 1.0, "poor": 0.0, "toxic": 0.0}, budget=20_000.0, max_rate=None).first().rate
    copies = Counter(r.doc_id for r in mixing.mix(docs, labels, {"good": 1.0, "poor": 0.0, "toxic": 0.0}, budget=20_000.0, max_rate=None).collect())
    assert abs(sum(copies.values()) / 3000 - rate) < 0.1
    assert set(copies.values()) <= {int(rate), int(rate) + 1}


def test_pipeline(spark, sf):
    """Each stage against the operator that decides it, on what its predecessor kept."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    decided = {
        "quality_rules": lambda d: ids(quality_rules.quality(d).filter("kept")),
        "exact_dedup": lambda d: ids(exact_dedup.memberships(d).filter("kept")),
        "near_dedup": lambda d: ids(near_dedup.near_classes(d).filter("kept")),
        "mixing": lambda d: ids(mixing.mix(d, labels)),
        "bpe": ids,
    }
    assert [name for name, _ in corpus_pipeline.STAGES] == list(decided)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        assert ids(out) == decided[name](docs)
        assert out.count() == len(ids(out))
        if name != "bpe":
            assert out.columns == docs.columns
            out = spark.createDataFrame(out.collect(), docs.schema)
        docs = out
    assert Counter(map(tuple, corpus_pipeline.run(spark, sf).collect())) == Counter(map(tuple, docs.collect()))


def test_pipeline_on_edges(spark, sf, edges, empty):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for table in (edges.select(columns), empty.select(columns)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, table, sf).columns == columns, name
        name, stage = corpus_pipeline.STAGES[-1]
        assert stage(spark, table, sf).count() == table.count(), name


@pytest.mark.parametrize("which", ["edges", "empty"])
def test_run_on_edges(request, spark, sf, tmp_path, which):
    """The whole pipeline over a folder whose documents are the odd rows."""
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = request.getfixturevalue(which).select(columns)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{sf}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    kept = {r.doc_id for r in quality_rules.keep_quality(docs).collect()}
    assert {r.doc_id for r in got} <= kept and len(got) == len({(r.doc_id, r.ids_sha256) for r in got})
    assert bool(got) == (which == "edges")


def test_registered():
    names = entry.queries()
    assert [n for n in names if n.startswith("op")] == [f"op{k}_{n.partition('_')[2]}" for k, n in enumerate(registered.queries(), 1)]
    assert "pipeline" in names


@pytest.mark.parametrize("name", ["op4_line_dedup", "op10_exact_dedup", "op11_collocations", "op12_centroid_clusters"])
def test_against_sql(spark, sf, name):
    import duckdb

    db = duckdb.connect()
    for table in ("documents", "embeddings"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    result = db.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    got = entry.queries()[name](spark, sf).select(columns)
    assert Counter(map(tuple, got.collect())) == Counter(result.fetchall())
