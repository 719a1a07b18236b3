"""Host-level quality rules: a host whose shrunk failure rate is too high loses all its documents.

Each document is measured in place with built-in expressions. Rule failures are summed by host
(`source`) on the map side, so a host of any size leaves a map task as one row. A beta prior is
fitted to the hosts' rates by moments for each rule, each host counting alike and less its sampling
noise; every host's rate is shrunk to it, and hosts with a shrunk rate above `limit` fail. The prior
weighs a bounded number of documents: one bad host among ever more good ones would else be shrunk to
them, and a host's verdict follow from the size of the corpus. Verdicts go back to the documents by a join; the host
table is broadcast while its counted rows are below `max_broadcast_hosts`, else joined by
shuffle with skewed hosts split by the engine.

Defined results: a null or empty text has no words and fails; a null source is a host of its own;
repeated rows count each time; windows of three words are compared by a 64-bit hash. Texts of any
length are read whole. Further columns pass unchanged. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlflow.llm.shared import SPACE, bind, pinned, text_of, words_of

#: Rule name and failure condition over the measures.
RULES = {
    "short": "n_words < 50",
    "repetitive": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > word_chars",
    "lines": "10 * n_dup_lines > 3 * n_lines",
}
BASE = ("short", "repetitive")


def _covered(windows: Column) -> Column:
    """Words covered by windows whose hash occurs again, from the hashes in text order."""

    def marked(pairs: Column) -> Column:
        def repeated(pair: Column, k: Column) -> Column:
            same = lambda at: F.coalesce(F.get(pairs, at)["hash"] == pair["hash"], F.lit(False))
            return F.when((k > 0) & same(k - 1) | same(k + 1), pair["at"])

        return F.sort_array(F.filter(F.transform(pairs, repeated), lambda at: at.isNotNull()))

    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("total"))
    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("hash"), i.alias("at"))))
    return F.aggregate(
        bind(pairs, marked),
        start,
        lambda a, at: F.struct(at.alias("last"), (a["total"] + F.least(F.lit(3), at - a["last"])).alias("total")),
        lambda a: a["total"],
    )


def _repeat_words(words: Column) -> Column:
    windows = F.transform(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))),
        lambda word, i: F.xxhash64(word, F.get(words, i + 1), F.get(words, i + 2)),
    )
    return bind(
        windows,
        lambda hashes: F.when(
            F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")
        ).otherwise(_covered(hashes)),
    )


def _measure(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.trim(line, F.lit(SPACE)) != "")
    of_words = bind(
        words_of(text),
        lambda words: F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            _repeat_words(words).alias("n_repeat_words"),
        ),
    )
    of_lines = bind(
        lines,
        lambda rows: F.struct(
            F.size(rows).cast("long").alias("n_lines"),
            (F.size(rows) - F.size(F.array_distinct(rows))).cast("long").alias("n_dup_lines"),
        ),
    )
    symbols = F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long")
    return F.struct(of_words.alias("w"), of_lines.alias("l"), symbols.alias("n_symbols"))


def measured(docs: DataFrame, *carry: Column) -> DataFrame:
    """The columns `carry`, then the measures of each text."""
    packed = docs.select(*carry, _measure(text_of(F.col("text"))).alias("m"))
    # A generator keeps later expressions from repeating the measuring.
    held = packed.select(*[c for c in packed.columns if c != "m"], F.explode(F.array("m")).alias("m"))
    return held.select(*[c for c in held.columns if c != "m"], "m.w.*", "m.l.*", "m.n_symbols")


def host_verdicts(measures: DataFrame, limit: float = 0.5) -> DataFrame:
    """host, n_docs, one shrunk rate a rule, and host_ok."""
    failures = [F.count_if(F.expr(rule)).alias(f"f_{name}") for name, rule in RULES.items()]
    return verdicts_of_counts(pinned(measures.groupBy("host").agg(F.count("*").alias("n_docs"), *failures)), limit)


def verdicts_of_counts(
    hosts: DataFrame, limit: float = 0.5, least_strength: float = 10.0, most_strength: float = 40.0
) -> DataFrame:
    """`hosts` (host, n_docs, f_<rule>) with shrunk rates and host_ok.

    The prior weighs `least_strength` to `most_strength` documents: of more than the latter, a host
    fails if all do, however many other hosts there are.
    """
    raw = {name: F.col(f"f_{name}") / F.col("n_docs") for name in RULES}
    told = hosts.agg(F.count("*").alias("hosts"), F.avg(1 / F.col("n_docs")).alias("h"), *[F.avg(r).alias(n) for n, r in raw.items()]).first()
    if not told["hosts"]:
        return hosts.withColumn("host_ok", F.lit(True))
    spread = hosts.agg(*[F.avg(F.pow(r - told[n], 2)).alias(n) for n, r in raw.items()]).first()
    ok = F.lit(True)
    for name in RULES:
        mean = told[name]
        noise = mean * (1 - mean)
        # A host's rate varies by between + (noise - between) / n_docs; `h` is the mean of 1 / n_docs.
        between = (spread[name] - noise * told["h"]) / (1 - told["h"]) if told["h"] < 1 else 0.0
        strength = min(max(noise / between - 1, least_strength), most_strength) if between > 0 else most_strength
        rate = (F.col(f"f_{name}") + mean * strength) / (F.col("n_docs") + strength)
        hosts = hosts.withColumn(f"rate_{name}", rate)
        ok = ok & (F.col(f"rate_{name}") <= limit)
    return hosts.withColumn("host_ok", ok)


def judged(measures: DataFrame, limit: float = 0.5, max_broadcast_hosts: int = 100_000) -> DataFrame:
    """`measures` (with `host`) and base_failed, kept."""
    verdicts = host_verdicts(measures, limit).select(F.col("host").alias("of_host"), "host_ok")
    verdicts = pinned(verdicts.filter("not host_ok"))
    if verdicts.count() <= max_broadcast_hosts:
        verdicts = F.broadcast(verdicts)
    joined = measures.join(verdicts, F.col("host").eqNullSafe(F.col("of_host")) & ~F.col("host_ok"), "left")
    failed = F.expr(" or ".join(f"({RULES[name]})" for name in BASE))
    return joined.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & F.coalesce("host_ok", F.lit(True))
    ).drop("of_host", "host_ok")


def quality(docs: DataFrame, limit: float = 0.5) -> DataFrame:
    """doc_id, the measures, base_failed and kept of every document."""
    narrow = pinned(measured(docs, F.col("doc_id"), F.col("source").alias("host")))
    return judged(narrow, limit)


def keep_quality(docs: DataFrame, limit: float = 0.5) -> DataFrame:
    """`docs` without those that fail, measured twice rather than shuffled with their texts."""
    narrow = pinned(measured(docs, F.col("source").alias("host")))
    failing = pinned(host_verdicts(narrow, limit).filter("not host_ok").select(F.col("host").alias("of_host")))
    packed = measured(docs, F.struct(*docs.columns).alias("row"), F.col("source").alias("host"))
    if failing.count() <= 100_000:
        failing = F.broadcast(failing)
    kept = packed.filter(~F.expr(" or ".join(f"({RULES[name]})" for name in BASE))).join(
        failing, F.col("host").eqNullSafe(F.col("of_host")), "left_anti"
    )
    return kept.select("row.*")
