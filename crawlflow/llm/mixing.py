"""Mixing to target weights: soft domains of documents and rates that meet token targets.

A naive Bayes classifier learns word weights of the domains from the labelled rows and gives every
document a posterior for each domain. Rates r >= 0 are then fitted by projected gradient descent on
the least-squares gap between the expected tokens of the domains, sum(r * p * tokens), and the
targets. All documents take part in each step; a step is one aggregation of as many sums as there
are domains, from the narrow table of posteriors. As a document's rate follows from its posterior
and the gaps of the steps so far, only those gaps (a vector a step) are on the driver.

Words fall into `buckets` hash buckets, so the model has a fixed size and is a literal; a bucket has
weights if some domain's count in it is `least_z` deviations from its share. The
classifier learns from at most about `fit_rows` labelled rows (those with the smallest hash of
doc_id); counts, posteriors and rates cover all documents and whole texts.

Defined results: a null or empty text has no words, the prior as its posterior, and no weight in the
totals; rates are bounded by 1 unless `max_rate` is None, as no document is to be repeated: a departure from rates that
are merely nonnegative, under which a target may be missed by the tokens that its documents have too few of; labels without a domain (nulls) and labels of unknown documents teach nothing; a doc_id
labelled twice counts twice. Without any label all domains are alike. Repeated rows get equal rates.
Further columns pass unchanged. An empty table gives an empty table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlflow.llm.shared import bind, pinned, text_of, words_of

Model = tuple[list[float], dict[int, list[float]], int]

DOMAINS = ("good", "poor", "toxic")
WEIGHTS = {"good": 0.98, "poor": 0.02, "toxic": 0.0}


def domain_of_label(quality: Column, toxic: Column) -> Column:
    return F.when(toxic == 1, "toxic").when(quality == 1, "good").when(quality == 0, "poor")


def _buckets(words: Column, buckets: int) -> Column:
    return F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int"))


def fit_classifier(
    docs: DataFrame,
    labels: DataFrame,
    buckets: int = 1 << 18,
    fit_rows: int = 20_000,
    prior_rows: float = 10.0,
    least_z: float = 3.0,
    domains: tuple = DOMAINS,
) -> Model:
    """Log priors, and log weights of the domains by bucket, of buckets that tell domains apart."""
    known = labels.select(F.col("doc_id").alias("of"), domain_of_label(F.col("quality"), F.col("toxic")).alias("domain"))
    known = known.filter("of is not null and domain is not null")
    share = min(1.0, fit_rows / max(1, known.count()))
    drawn = known.filter(F.pmod(F.xxhash64(F.lit("fit"), "of"), F.lit(1 << 20)) < int(share * (1 << 20)))
    taught = drawn.join(docs.select("doc_id", "text"), F.col("of") == F.col("doc_id")).select(
        "domain", words_of(F.lower(text_of(F.col("text")))).alias("words")
    )
    taught = pinned(taught)
    n_docs = {r["domain"]: r["count"] for r in taught.groupBy("domain").count().collect()}
    total = sum(n_docs.values())
    priors = [math.log((n_docs.get(d, 0) + 1) / (total + len(domains))) for d in domains]
    weights: dict[int, list[float]] = {}
    if not total:
        return priors, weights, buckets
    # Each word of a document counts once, so that long texts do not drown short ones.
    counted = (
        taught.select("domain", F.explode(F.array_distinct(_buckets(F.col("words"), buckets))).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count("*").alias("rows"), *[F.count_if(F.col("domain") == d).alias(f"n_{d}") for d in domains])
    )
    deviations = []
    for d in domains:
        usual = F.col("rows") * (n_docs.get(d, 0) / total)
        deviations.append(F.abs(F.col(f"n_{d}") - usual) / F.sqrt(usual + 0.5))
    # Of at most `buckets` rows, those that tell the domains apart.
    for row in counted.filter(F.greatest(*deviations) >= least_z).collect():
        here, b = [row[f"n_{d}"] for d in domains], row["bucket"]
        overall = sum(here) / total
        # Shrunk to the share over all domains, so that rare words tell little.
        shares = [(h + prior_rows * overall) / (n_docs.get(d, 0) + prior_rows) for h, d in zip(here, domains, strict=True)]
        weights[b] = [round(math.log(share / overall), 4) for share in shares]
    return priors, weights, buckets


def posteriors(
    docs: DataFrame, model: Model, *carry: Column, domains: tuple = DOMAINS
) -> DataFrame:
    """The columns `carry`, n_tokens (words) and the array `p` in the order of the domains."""
    priors, weights, buckets = model
    told = sorted(weights)
    slots = ["0"] * buckets  # the place of a bucket's weights, or 0
    for slot, b in enumerate(told, 1):
        slots[b] = str(slot)
    # The tables are one stored row, read by a scalar subquery: plans stay small.
    row = docs.sparkSession.range(1).select(
        F.struct(
            F.split(F.lit(",".join(slots)), ",").cast("array<int>").alias("slots"),
            *[
                F.split(F.lit(",".join(["0", *(str(weights[b][k]) for b in told)])), ",").cast("array<double>").alias(f"w{k}")
                for k in range(len(domains))
            ],
        ).alias("tables")
    )
    tables = pinned(row).scalar()

    def scored(of: Column) -> Column:
        words, slots_of = of["words"], of["tables"]["slots"]
        places = F.transform(words, lambda w: F.get(slots_of, F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int")))
        hits = F.array_distinct(F.filter(places, lambda slot: slot > 0))

        def added(slots: Column) -> Column:
            adds = [(lambda name: lambda acc, b: acc + F.get(of["tables"][name], b))(f"w{k}") for k in range(len(domains))]
            return F.array(*[F.aggregate(slots, F.lit(prior), add) for prior, add in zip(priors, adds, strict=True)])

        return F.struct(F.size(words).cast("long").alias("n_tokens"), bind(hits, added).alias("s"))

    def softmax(s: Column) -> Column:
        parts = F.transform(s, lambda x: F.exp(x - F.array_max(s)))
        return bind(parts, lambda e: F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, v: a + v)))

    words = words_of(F.lower(text_of(F.col("text"))))
    known = docs.select(*carry, words.alias("model_words"), tables.alias("model_tables"))
    of = F.struct(F.col("model_words").alias("words"), F.col("model_tables").alias("tables"))
    packed = known.select(*[c for c in known.columns if not c.startswith("model_")], bind(of, scored).alias("m"))
    others = [c for c in packed.columns if c != "m"]
    held = packed.select(*others, F.explode(F.array("m")).alias("m"))
    return held.select(*others, "m.n_tokens", bind(F.col("m.s"), softmax).alias("p"))


def _rate(p: Column, steps: list[list[float]], max_rate: float | None) -> Column:
    """The rate after the steps: each adds p . step and projects onto [0, max_rate]."""
    if not steps:
        return F.lit(1.0)
    literal = F.array(*[F.array(*[F.lit(float(v)) for v in step]) for step in steps])

    def moved(rate: Column, step: Column) -> Column:
        to = F.greatest(F.lit(0.0), rate + F.aggregate(F.zip_with(p, step, lambda a, b: a * b), F.lit(0.0), lambda a, v: a + v))
        return to if max_rate is None else F.least(F.lit(float(max_rate)), to)

    return F.aggregate(literal, F.lit(1.0), moved)


def fit_rates(
    narrow: DataFrame,
    weights: dict[str, float] = WEIGHTS,
    budget: float | None = None,
    max_rate: float | None = 1.0,
    iterations: int = 25,
    tolerance: float = 0.002,
    domains: tuple = DOMAINS,
) -> tuple[list[list[float]], list[float], list[float]]:
    """Steps, targets and reached tokens of the domains.

    `budget`: tokens in all; None: as many as keep the domain of the largest weight whole.
    """
    n = len(domains)
    p = [F.col("p")[k] for k in range(n)]
    first = narrow.agg(*[F.sum(p[k] * F.col("n_tokens")).alias(f"t{k}") for k in range(n)]).first()
    there = [first[f"t{k}"] or 0.0 for k in range(n)]
    if not sum(there):
        return [], [0.0] * n, [0.0] * n
    if budget is None:
        main = max(range(n), key=lambda k: weights[domains[k]])
        budget = there[main] / weights[domains[main]]
    targets = [budget * weights[d] for d in domains]
    # Gaps count relative to the tokens there are, documents by their tokens. The matrix of this
    # least-squares problem is row-stochastic, as posteriors sum to 1: a step of 1 never overshoots.
    steps: list[list[float]] = []
    reached = there
    for _ in range(iterations):
        last = reached
        gap = [t - r for t, r in zip(targets, reached, strict=True)]
        if max(map(abs, gap)) <= tolerance * budget:
            break
        steps.append([g / t if t else 0.0 for g, t in zip(gap, there, strict=True)])
        rate = _rate(F.col("p"), steps, max_rate)
        held = narrow.select("n_tokens", "p", F.explode(F.array(rate)).alias("rate"))
        row = held.agg(*[F.sum(F.col("rate") * p[k] * F.col("n_tokens")).alias(f"t{k}") for k in range(n)]).first()
        reached = [row[f"t{k}"] or 0.0 for k in range(n)]
        if max(abs(r - x) for r, x in zip(reached, last, strict=True)) <= tolerance * budget / 20:
            break  # as near as rates within their bounds come
    return steps, targets, reached


def mixing_rates(docs: DataFrame, labels: DataFrame, weights: dict[str, float] = WEIGHTS, **options) -> DataFrame:
    """doc_id, n_tokens, p_<domain> and rate of every document; beside them, alike in all rows, the target and the
    reached expected tokens of each domain."""
    narrow = pinned(posteriors(docs, fit_classifier(docs, labels), F.col("doc_id")))
    steps, targets, reached = fit_rates(narrow, weights, **options)
    return narrow.select(
        "doc_id",
        "n_tokens",
        *[F.col("p")[k].alias(f"p_{d}") for k, d in enumerate(DOMAINS)],
        _rate(F.col("p"), steps, options.get("max_rate", 1.0)).alias("rate"),
        *[F.lit(float(v)).alias(f"{name}_{d}") for name, of in (("target", targets), ("reached", reached)) for d, v in zip(DOMAINS, of, strict=True)],
    )


def mix(docs: DataFrame, labels: DataFrame, weights: dict[str, float] = WEIGHTS, seed: int = 7, **options) -> DataFrame:
    """`docs`, each row as often as its rate says: the whole part of the rate, and once more by a hash of doc_id."""
    model = fit_classifier(docs, labels)
    narrow = pinned(posteriors(docs, model))
    steps, _, _ = fit_rates(narrow, weights, **options)
    packed = posteriors(docs, model, F.struct(*docs.columns).alias("row"), F.col("doc_id"))
    # In (0, 1]: a rate of 1 keeps every row once, a rate of 0 none.
    draw = (F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) + 1) / float(1 << 30)
    times = F.floor(_rate(F.col("p"), steps, options.get("max_rate", 1.0)) + 1 - draw).cast("int")
    taken = packed.select("row", F.explode(F.array_repeat(F.lit(1), times)).alias("copy"))
    return taken.select("row.*")
