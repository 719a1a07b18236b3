"""The registered query of each operator: the operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlflow.llm import (
    bpe,
    centroid_clusters,
    collocations,
    exact_dedup,
    html_text,
    license_scan,
    line_dedup,
    mixing,
    multi_index,
    near_dedup,
    quality_rules,
    sharding,
    token_files,
)
from crawlflow.llm.shared import table, text_of

VOCABULARY = "byte_bpe_50k.json"


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    rates = mixing.mixing_rates(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return rates.select("doc_id", "n_tokens", *[F.round(c, 6).alias(c) for c in rates.columns[2:]])


def op2_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_classes(table(spark, folder, "documents"))


def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.token_file_digest(table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY))


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    lines = line_dedup.dedup_lines(table(spark, folder, "documents"))
    text = text_of(F.col("text"))
    return lines.select(
        "doc_id", "n_lines", "n_removed", F.length(text).cast("long").alias("chars_left"), F.sha2(text, 256).alias("text_sha256")
    )


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    columns = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept".split()
    return quality_rules.quality(table(spark, folder, "documents")).select(*columns)


def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY))


def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.sharded(table(spark, folder, "documents"), 8)


def op8_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract_pages(table(spark, folder, "pages"))


def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files: a folder a source, a subfolder a thousand, a folder a hundred; every hundredth is its LICENSE."""
    number = F.col("doc_id")
    name = F.when(number % 100 == 0, F.lit("LICENSE")).otherwise(F.concat(F.lit("doc"), number.cast("string"), F.lit(".txt")))
    parts = [F.col("source"), F.floor(number / 1000).cast("string"), F.floor(number / 100).cast("string"), name]
    files = table(spark, folder, "documents").select(number.alias("id"), F.concat_ws("/", *parts).alias("path"), "text")
    return license_scan.scan(files).withColumnRenamed("id", "doc_id")


def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.memberships(table(spark, folder, "documents"))


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"), least=100, top=2000)


def op12_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return centroid_clusters.cluster_vectors(table(spark, folder, "embeddings"), k=40, rounds=5).drop("looked")


def op13_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    found = multi_index.nearest_neighbours(table(spark, folder, "embeddings"), every=100, top=10)
    return found.select("query_id", "rank", "vec_id", "score")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        q.__name__: q
        for q in (
            op1_mixing,
            op2_near_dedup,
            op3_token_files,
            op4_line_dedup,
            op5_quality_rules,
            op6_bpe,
            op7_sharding,
            op8_html_text,
            op9_license_scan,
            op10_exact_dedup,
            op11_collocations,
            op12_centroid_clusters,
            op13_multi_index,
        )
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_line_dedup": OP4, "op10_exact_dedup": OP10, "op11_collocations": OP11, "op12_centroid_clusters": op12_sql()}


OP4 = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS raw,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents
), filled AS (
  SELECT doc_id, i, trim(raw, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS line,
         row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k
  FROM lines WHERE trim(raw, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> ''
), windows AS (
  SELECT a.doc_id, a.k, a.line || chr(10) || b.line || chr(10) || c.line AS three, a.i AS i1, b.i AS i2, c.i AS i3
  FROM filled a JOIN filled b ON a.doc_id = b.doc_id AND b.k = a.k + 1
  JOIN filled c ON a.doc_id = c.doc_id AND c.k = a.k + 2
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY three ORDER BY doc_id, k) AS occurrence FROM windows
), covered AS (
  SELECT DISTINCT doc_id, unnest([i1, i2, i3]) AS i FROM ranked WHERE occurrence > 1
), told AS (
  SELECT l.doc_id, count(*) AS n_lines, count(c.i) AS n_removed,
         coalesce(string_agg(CASE WHEN c.i IS NULL THEN l.raw END, chr(10) ORDER BY l.i), '') AS rest
  FROM lines l LEFT JOIN covered c ON l.doc_id = c.doc_id AND l.i = c.i GROUP BY l.doc_id
)
SELECT doc_id, n_lines, n_removed, length(rest) AS chars_left, sha256(rest) AS text_sha256 FROM told
"""

OP10 = """
WITH hashed AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))
    AS text_sha256 FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM hashed
"""

OP11 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS MATERIALIZED (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces
), totals AS (
  SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang
), starts AS (
  SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM words CROSS JOIN range(1, 6) t(m) WHERE len(w) >= m
), counts AS MATERIALIZED (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f FROM starts GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
  SELECT lang, m, phrase, f AS a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS head,
         array_to_string(string_split(phrase, ' ')[k + 1:m], ' ') AS tail
  FROM counts CROSS JOIN range(1, 5) t(k) WHERE k < m
), scores AS (
  SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, n, k, (1000::HUGEINT * c.a * n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.head JOIN counts y ON y.lang = c.lang AND y.phrase = c.tail
  JOIN totals t ON t.lang = c.lang
), lowest AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), parts AS (
  SELECT lang, f, array_to_string(string_split(phrase, ' ')[i:i + s - 1], ' ') AS part
  FROM counts CROSS JOIN range(2, 5) t(s) CROSS JOIN range(1, 5) u(i) WHERE s < m AND i + s - 1 <= m
), held AS (
  SELECT DISTINCT c.lang, c.phrase FROM counts c JOIN parts p ON p.lang = c.lang AND p.part = c.phrase WHERE 100 * p.f >= 100 * c.f
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM lowest ANTI JOIN held USING (lang, phrase)
QUALIFY rank <= 2000
"""


def op12_sql(k: int = 40, rounds: int = 5) -> str:
    """The rounds of the clustering one after the other, each comparing every vector with every centroid."""
    steps = [
        """v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q,
         sha256('2:' || coalesce(vec_id::VARCHAR, '')) AS h
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
)""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, q) - 1 AS c, q FROM (SELECT h, q FROM v ORDER BY h, q LIMIT {k})
)""",
    ]
    for turn in range(rounds + 1):
        steps.append(f"""a{turn} AS MATERIALIZED (
  SELECT r, min(struct_pack(d := list_inner_product(v.q, v.q) + list_inner_product(c.q, c.q) - 2 * list_inner_product(v.q, c.q), c := c)) AS m
  FROM v CROSS JOIN c{turn} c GROUP BY r
)""")
        if turn < rounds:
            steps.append(f"""s{turn} AS (
  SELECT m.c AS c, i, sum(q[i])::BIGINT AS s, count(*) AS n FROM a{turn} JOIN v USING (r) CROSS JOIN range(1, 65) t(i) GROUP BY 1, 2
), c{turn + 1} AS MATERIALIZED (
  SELECT c, coalesce(any_value(f.q), any_value(o.q)) AS q FROM c{turn} o LEFT JOIN (
    SELECT c, list(((s - ((s % n) + n) % n) / n)::DOUBLE ORDER BY i) AS q FROM s{turn} GROUP BY c
  ) f USING (c) GROUP BY c
)""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, m.c::INTEGER AS cluster, m.d::BIGINT AS distance, (sum(m.d) OVER (PARTITION BY m.c))::BIGINT AS cluster_inertia,
       (sum(m.d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(list_transform(c.q, lambda x: x::BIGINT), ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (r) JOIN c{rounds} c ON m.c = c.c
"""
