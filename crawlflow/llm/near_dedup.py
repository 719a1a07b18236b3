"""Near-duplicate classes by DartMinHash.

A text is the set of its distinct five-word shingles (words between white space, lower case). Each has
weight 1 whatever its count, as pairs are accepted by the similarity of the sets. Each element throws darts into its region [0, weight) x [0, rank bound): the
weight axis is cut into doubling bands, and in each band the darts of an element are a Poisson process
whose gaps, heights and coordinates come from hashes, the same in every text. The rank bound is chosen
so that about k ln k + 3k darts fall in a text, whatever its length; of the darts on a coordinate the
earliest stays. A text with an empty coordinate throws again with twice the bound. Two texts agree on a
coordinate with the probability of their Jaccard similarity (weighted, where weights differ). `bands` groups of `rows`
coordinates are the buckets: at 24 x 5 a pair with similarity 0.8 meets in none with probability 7e-5.

Texts of equal words are one node (their copies link to the smallest doc_id and are never compared).
In each bucket the member with the most bucket mates leads, and all others are compared with it: exact
Jaccard similarity of the shingle sets, at least `least`. Links make classes. Buckets whose members are
in several classes go on: a new leader from another class in each further round up to `passes`, then
the pairs of members of different classes: by a join in buckets of up to `hot` members; in larger ones
in blocks, where a task holds up to about 256 documents outside the bucket's largest class and meets
every member once, so that no row a pair is made. Pairs within a class are not compared again, and a
large group of copies costs a comparison each.

Classes come from rounds of smallest labels with pointer jumping, as joins. Nothing but counts reaches
the driver. Comparisons are dealt out by leader in chunks, so a leader of very many is split.

Defined results: a null text counts as empty; texts without words are one class; texts of one to four
words are one shingle. doc_id names a document: rows that repeat it are in one class and stay or go
together, with different texts as well; then each text is compared, and the classes of the texts of a doc_id are one.
A null doc_id is in no class and stays. A class is named by its smallest doc_id, which stays. The result has
a row for each row of the input.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlflow.llm.pieces import portions
from crawlflow.llm.shared import at_rest, pinned

SHINGLE = 5
WORD_IDS: dict[str, int] = {}  # hashes of words, remembered by a worker
REMEMBERED, KEPT = 200_000, 50_000  # words within a task, and from one task to the next


def mixed(x: np.ndarray) -> np.ndarray:
    """Well mixed 64 bits of each number."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def word_hashes(words: list[str]) -> np.ndarray:
    new = set(words).difference(WORD_IDS)
    if len(WORD_IDS) > REMEMBERED:
        WORD_IDS.clear()
        new = set(words)
    for word in new:
        WORD_IDS[word] = int.from_bytes(blake2b(word.encode(), digest_size=8).digest(), "little")
    return np.fromiter(map(WORD_IDS.__getitem__, words), np.uint64, len(words))


def forget_words() -> None:
    """What a worker does after a task: many words are forgotten."""
    if len(WORD_IDS) > KEPT:
        WORD_IDS.clear()


def shingles(text: str) -> np.ndarray:
    """Hashes of the five-word shingles, with repeats."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    ids = word_hashes(words)
    n = max(1, len(words) - SHINGLE + 1)
    h = np.full(n, len(words) if len(words) < SHINGLE else SHINGLE, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(min(SHINGLE, len(words))):
            h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + ids[k : k + n])
    return h


def _uniform(x: np.ndarray) -> np.ndarray:
    """In (0, 1)."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def dart_signatures(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, n: int, k: int) -> np.ndarray:
    """n x k signatures of the weighted sets whose elements, weights and set numbers are given; 0 for empty sets."""
    signatures = np.zeros((n, k), np.uint64)
    totals = np.bincount(owner, weights=weights, minlength=n)
    todo = totals > 0
    bound = np.zeros(n)
    bound[todo] = (k * math.log(k) + 3 * k) / totals[todo]
    while todo.any():
        mine = todo[owner]
        e, w, o = elements[mine], weights[mine], owner[mine]
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        low, width, band = 0.0, 1.0, 0
        while len(e):
            with np.errstate(over="ignore"):
                stream = mixed(e + np.uint64(0xD1B54A32D192ED03) * np.uint64(band + 1))
            here, rank, step = np.arange(len(e)), np.zeros(len(e)), 0
            while len(here):
                step += 1
                with np.errstate(over="ignore"):
                    dart = mixed(stream[here] + np.uint64(0x9E3779B97F4A7C15) * np.uint64(step))
                rank = rank - np.log(_uniform(mixed(dart ^ np.uint64(1)))) / width
                near = rank < bound[o[here]]
                here, rank, dart = here[near], rank[near], dart[near]
                height = low + width * _uniform(mixed(dart ^ np.uint64(2)))
                inside = height < w[here]
                d = dart[inside]
                found.append((o[here][inside] * k + (mixed(d ^ np.uint64(3)) % np.uint64(k)).astype(np.int64), rank[inside], d))
            low, width, band = low + width, width if band == 0 else 2 * width, band + 1
            more = w > low
            e, w, o = e[more], w[more], o[more]
        slot, rank, dart = (np.concatenate([f[i] for f in found]) for i in range(3))
        order = np.argsort(-rank, kind="stable")  # the earliest is written last
        flat = signatures.ravel()
        flat[slot[order]] = dart[order] | np.uint64(1)  # never 0
        todo &= (signatures == 0).any(axis=1)
        signatures[todo] = 0
        bound *= 2
    return signatures


def _signed(bands: int, rows: int):
    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for i, j in portions(texts, 2_000_000):
                sets = [np.unique(shingles(t)) for t in texts[i:j]]
                owner = np.repeat(np.arange(j - i), list(map(len, sets)))
                elements = np.concatenate(sets)
                signatures = dart_signatures(elements, np.ones(len(elements)), owner, j - i, bands * rows)
                keys = np.broadcast_to(np.arange(bands, dtype=np.uint64), (j - i, bands)).copy()
                with np.errstate(over="ignore"):
                    for r in range(rows):
                        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + signatures[:, r::rows])
                content = [blake2b(" ".join(t.lower().split()).encode(), digest_size=16).digest() for t in texts[i:j]]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, j - i),
                        pa.array(content, pa.binary()),
                        pa.array(list(keys.view(np.int64)), pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "content", "keys"],
                )

    return at_rest(run, forget_words)


def signed(docs: DataFrame, bands: int = 24, rows: int = 5) -> DataFrame:
    """doc_id, content (a hash of the words) and keys (one bucket a band)."""
    numbered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return numbered.mapInArrow(_signed(bands, rows), "doc_id bigint, content binary, keys array<bigint>")


def _compared(least: float):
    """Rows (lead, chunk, member, text) in order, the leader's own before its members of each chunk."""

    def run(batches: Iterator[pa.RecordBatch]):
        lead, own = None, None
        for batch in batches:
            links = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                first, _, member, text = row
                if member is None:
                    lead, own = first, np.unique(shingles(text or ""))
                    continue
                if first != lead:
                    continue  # a leader that is no document
                other = np.unique(shingles(text or ""))
                common = len(np.intersect1d(own, other, assume_unique=True))
                union = len(own) + len(other) - common
                if union and common >= least * union:
                    links.append((lead, member, common / union))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in links], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.float64()))],
                names=["lead", "member", "similarity"],
            )

    return at_rest(run, forget_words)


def verified(pairs: DataFrame, texts: DataFrame, least: float, chunk: int = 256) -> DataFrame:
    """lead, member, similarity of the pairs (lead, member; distinct) that are similar enough."""
    counts = pairs.groupBy("lead").agg(F.ceil(F.count("*") / chunk).alias("chunks"))
    large = counts.filter("chunks > 1")
    cut = pairs.join(large, "lead", "left").select(
        "lead", "member", F.coalesce(F.pmod(F.xxhash64("member"), "chunks"), F.lit(0)).alias("chunk")
    )
    leads = counts.select("lead", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"))
    of = texts.select(F.col("doc_id").alias("of"), "text")
    rows = (
        cut.join(of, F.col("member") == F.col("of"))
        .select("lead", "chunk", "member", "text")
        .unionByName(
            leads.join(of, F.col("lead") == F.col("of")).select(
                "lead", "chunk", F.lit(None).cast("long").alias("member"), "text"
            )
        )
    )
    dealt = rows.repartition("lead", "chunk").sortWithinPartitions("lead", "chunk", "member")
    return pinned(dealt.mapInArrow(_compared(least), "lead bigint, member bigint, similarity double"))


def classes_of(links: DataFrame) -> DataFrame:
    """doc_id and label, the smallest doc_id that links reach, of all documents with links (lead, member)."""
    lead, member = F.col("lead"), F.col("member")
    ends = F.explode(
        F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in ((lead, member), (member, lead), (lead, lead), (member, member))])
    )
    both = links.select(ends.alias("e")).select("e.*")  # with each document beside itself

    def step(labels: DataFrame) -> DataFrame:
        """Each document takes the smallest label around it, then that label's own."""
        of = labels.select(F.col("doc_id").alias("of"), "label")
        heard = both.join(of, F.col("y") == F.col("of")).groupBy(F.col("x").alias("doc_id")).agg(F.min("label").alias("label"))
        jump = labels.select(F.col("doc_id").alias("at"), F.col("label").alias("beyond"))
        return heard.join(jump, F.col("label") == F.col("at")).select("doc_id", F.least("label", "beyond").alias("label"))

    labels = pinned(both.groupBy(F.col("x").alias("doc_id")).agg(F.min("y").alias("label")))
    while True:
        lower = pinned(step(step(labels)))
        before = labels.select(F.col("doc_id").alias("of"), F.col("label").alias("was"))
        changed = lower.join(before, F.col("doc_id") == F.col("of")).filter("label <> was")
        labels = lower
        if changed.isEmpty():
            return labels


def _open_members(members: DataFrame, labels: DataFrame) -> DataFrame:
    """`members` (key, doc_id, degree) of buckets with several classes, with their class."""
    named = labels.select(F.col("doc_id").alias("of"), "label")
    classed = members.join(named, F.col("doc_id") == F.col("of"), "left").select(
        "key", "doc_id", "degree", F.coalesce("label", "doc_id").alias("class")
    )
    several = (
        classed.groupBy("key")
        .agg(F.min("class").alias("low"), F.max("class").alias("high"), F.count("*").alias("n"))
        .filter("low < high")
        .select(F.col("key").alias("open"), "n")
    )
    return pinned(classed.join(several, F.col("key") == F.col("open")).drop("open"))


def near_classes(docs: DataFrame, **options) -> DataFrame:
    """doc_id, class_id, class_size and kept of every row; the options are those of `classes_of_nodes`."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    text = F.xxhash64(F.coalesce("text", F.lit("")))
    several = rows.filter("doc_id is not null").groupBy("doc_id").agg(F.min(text).alias("low"), F.max(text).alias("high"))
    several = pinned(several.filter("low < high").select(F.col("doc_id").alias("of")))
    if several.isEmpty():
        return classes_of_nodes(rows, **options)
    # Each text of a doc_id with several is a node of its own, under a negative number.
    number = -1 - F.xxhash64("doc_id", text).bitwiseAND(F.lit((1 << 62) - 1))
    placed = pinned(
        rows.join(several, F.col("doc_id") == F.col("of"), "left").select(
            F.when(F.col("of").isNull(), F.col("doc_id")).otherwise(number).alias("node"), "doc_id", "text"
        )
    )
    classed = classes_of_nodes(placed.select(F.col("node").alias("doc_id"), "text"), **options)
    of_node = classed.filter("doc_id is not null").groupBy(F.col("doc_id").alias("named")).agg(F.min("class_id").alias("class"))
    told = pinned(placed.drop("text").join(of_node, F.col("node") == F.col("named"), "left").select("doc_id", "class"))
    met = told.join(several, F.col("doc_id") == F.col("of"), "left_semi").groupBy("doc_id").agg(F.min("class").alias("low"))
    links = told.join(met.withColumnRenamed("doc_id", "of"), F.col("doc_id") == F.col("of")).filter("class <> low")
    labels = classes_of(pinned(links.select(F.col("low").alias("lead"), F.col("class").alias("member")).distinct()))
    joined = told.join(labels.withColumnRenamed("doc_id", "of"), F.col("class") == F.col("of"), "left")
    joined = pinned(joined.select("doc_id", F.coalesce("label", "class").alias("label")))
    names = joined.filter("label is not null").groupBy(F.col("label").alias("of"))
    names = names.agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return joined.join(names, F.col("label") == F.col("of"), "left").select(
        "doc_id",
        "class_id",
        F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"),
        F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)).alias("kept"),
    )


def classes_of_nodes(
    docs: DataFrame, least: float = 0.8, bands: int = 24, rows: int = 5, passes: int = 1, hot: int = 16
) -> DataFrame:
    """doc_id, class_id, class_size and kept of every row of a table where rows that repeat a doc_id have one text."""
    sigs = pinned(signed(docs, bands, rows))
    known = sigs.filter("doc_id is not null")
    groups = pinned(
        known.groupBy("content").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last")).filter("rep < last").drop("last")
    )
    copies = pinned(
        known.join(groups.withColumnRenamed("content", "of"), F.col("content") == F.col("of"))
        .filter("doc_id <> rep")
        .select("doc_id", "rep")
        .distinct()
    )
    nodes = known.join(copies.select("doc_id"), "doc_id", "left_anti").select("doc_id", "keys")
    keyed = nodes.select("doc_id", F.explode("keys").alias("key"))
    shared = (
        keyed.groupBy("key")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("mates"))
        .filter("low < high")
        .select("key", "mates")
    )
    members = pinned(keyed.join(shared, "key").distinct())
    degrees = members.groupBy(F.col("doc_id").alias("of")).agg(F.sum("mates").alias("degree"))
    members = pinned(members.join(degrees, F.col("doc_id") == F.col("of")).select("key", "doc_id", "degree"))
    wanted = members.select(F.col("doc_id").alias("of")).distinct()
    numbered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = pinned(
        numbered.join(wanted, F.col("doc_id") == F.col("of"), "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    )

    links = tested = labels = None
    current = members.withColumn("class", F.col("doc_id"))
    for turn in range(passes + 1):
        if turn:
            current = _open_members(members, labels)
            if current.isEmpty():
                break
        if turn < passes:
            pairs = _pairs_with_leader(current, turn == 0)
        else:
            large = _links_in_blocks(current.filter(F.col("n") > hot), texts, least)
            links = links.unionByName(large)
            pairs = _remaining_pairs(current.filter(F.col("n") <= hot))
        if tested is not None:
            pairs = pairs.join(tested, ["lead", "member"], "left_anti")
        pairs = pinned(pairs.distinct())
        found = verified(pairs, texts, least)
        links = found if links is None else links.unionByName(found)
        tested = pairs if tested is None else tested.unionByName(pairs)
        labels = classes_of(links)

    named = labels.select(F.col("doc_id").alias("of"), "label")
    nodes_of = (
        sigs.select("doc_id")
        .join(copies.withColumnRenamed("doc_id", "copy"), F.col("doc_id") == F.col("copy"), "left")
        .withColumn("node", F.coalesce("rep", "doc_id"))
        .join(named, F.col("node") == F.col("of"), "left")
        .withColumn("class_id", F.coalesce("label", "node"))
        .select("doc_id", "class_id")
    )
    classed = pinned(nodes_of)
    sizes = pinned(
        classed.filter("class_id is not null")
        .groupBy(F.col("class_id").alias("of"))
        .agg(F.count("*").alias("class_size"))
        .filter("class_size > 1")
    )
    return classed.join(sizes, F.col("class_id") == F.col("of"), "left").select(
        "doc_id",
        "class_id",
        F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"),
        F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)).alias("kept"),
    )


def _strength(degree: str = "degree", doc_id: str = "doc_id") -> Column:
    """Order of documents: of a pair, the stronger leads."""
    return F.struct(F.col(degree).alias("degree"), (-F.col(doc_id)).alias("minus"))


def _pairs_with_leader(members: DataFrame, first: bool) -> DataFrame:
    """Pairs of each bucket's strongest member with its weaker members of other classes.

    Later turns lead from another class than the strongest member's, which has led before.
    """
    ranked = members.withColumn("s", F.struct(_strength().alias("by"), "class"))
    top = ranked.groupBy("key").agg(F.max("s").alias("top")).withColumnRenamed("key", "of_key")
    if not first:
        rest = ranked.join(pinned(top), (F.col("key") == F.col("of_key")) & (F.col("class") != F.col("top.class")))
        top = rest.groupBy("key").agg(F.max("s").alias("top")).withColumnRenamed("key", "of_key")
    met = ranked.join(
        pinned(top),
        (F.col("key") == F.col("of_key")) & (F.col("class") != F.col("top.class")) & (F.col("s.by") < F.col("top.by")),
    )
    return met.select((-F.col("top.by.minus")).alias("lead"), F.col("doc_id").alias("member"))


def _remaining_pairs(members: DataFrame) -> DataFrame:
    """All pairs of different classes in buckets, the stronger first."""
    every = members.withColumn("by", _strength())
    other = every.select(
        F.col("key").alias("of"), F.col("doc_id").alias("mate"), F.col("class").alias("mate_class"), F.col("by").alias("mate_by")
    )
    met = every.join(other, (F.col("key") == F.col("of")) & (F.col("by") > F.col("mate_by")) & (F.col("class") != F.col("mate_class")))
    return met.select(F.col("doc_id").alias("lead"), F.col("mate").alias("member"))


def _against_block(least: float):
    """Rows (key, block, side, doc_id, class, text) in order: a block's documents (side 0), then those it meets."""

    def run(batches: Iterator[pa.RecordBatch]):
        at, held, ready = None, [], None

        def links_of(doc_id, class_, text):
            nonlocal ready
            if ready is None:
                sets = [np.unique(shingles(t or "")) for _, _, t in held]
                sizes = np.array([len(x) for x in sets])
                grams = np.concatenate(sets)
                order = np.argsort(grams, kind="stable")
                owners = np.repeat(np.arange(len(sets)), sizes)[order]
                ready = grams[order], owners, sizes, np.array([c for _, c, _ in held])
            grams, owners, sizes, classes = ready
            mine = np.unique(shingles(text or ""))
            low, high = np.searchsorted(grams, mine), np.searchsorted(grams, mine, "right")
            n = high - low
            places = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
            common = np.bincount(owners[places], minlength=len(sizes))
            union = sizes + len(mine) - common
            for k in np.flatnonzero((common >= least * union) & (union > 0) & (classes != class_)):
                yield held[k][0], doc_id, common[k] / union[k]

        for batch in batches:
            links = []
            for key, block, side, doc_id, class_, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (key, block) != at:
                    at, held, ready = (key, block), [], None
                if side == 0:
                    held.append((doc_id, class_, text))
                else:
                    links += links_of(doc_id, class_, text)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in links], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.float64()))],
                names=["lead", "member", "similarity"],
            )

    return at_rest(run, forget_words)


def _links_in_blocks(members: DataFrame, texts: DataFrame, least: float, block: int = 256) -> DataFrame:
    """Links between classes in large buckets, found without a row a pair.

    The members outside a bucket's largest class are cut into blocks; each block's task holds its sets and
    meets every member once.
    """
    counts = members.groupBy("key", "class").agg(F.count("*").alias("c"))
    largest = pinned(
        counts.groupBy(F.col("key").alias("of"))
        .agg(F.max(F.struct("c", "class")).alias("m"), F.sum("c").alias("all"))
        .select("of", F.col("m.class").alias("big"), F.ceil((F.col("all") - F.col("m.c")) / block).alias("blocks"))
    )
    placed = members.select("key", "doc_id", "class").join(largest, F.col("key") == F.col("of"))
    holding = placed.filter(F.col("class") != F.col("big")).select(
        "key", F.pmod(F.xxhash64("doc_id"), "blocks").alias("block"), F.lit(0).alias("side"), "doc_id", "class"
    )
    meeting = placed.select(
        "key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("side"), "doc_id", "class"
    )
    rows = holding.unionByName(meeting).join(texts.withColumnRenamed("doc_id", "named"), F.col("doc_id") == F.col("named")).drop("named")
    dealt = rows.repartition("key", "block").sortWithinPartitions("key", "block", "side", "doc_id")
    found = dealt.mapInArrow(_against_block(least), "lead bigint, member bigint, similarity double")
    return pinned(found.dropDuplicates(["lead", "member"]))


def near_dedup(docs: DataFrame, **options) -> DataFrame:
    """`docs` with one document of each class."""
    gone = near_classes(docs, **options).filter("not kept").select(F.col("doc_id").alias("of")).distinct()
    packed = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("id"))
    return packed.join(pinned(gone), F.col("id") == F.col("of"), "left_anti").select("row.*")
