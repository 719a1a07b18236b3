"""Token-id files: ids in fixed-size blocks, each turned into byte (or bit) planes compressed by zstandard.

Documents are dealt out by ranges of doc_id and sorted, so the parts in order, and the ids within them,
are in ascending doc_id order. A part is a run of blocks of `block` ids; the last may be shorter. A row
of the file set is one block: its part and number, the number of its first id within the part, its
planes, and the index of the documents that start in it; `head` ids at its begin belong to a document of
an earlier block. A second table, the part index, holds the ids in each part and before it. Both are
written by Spark's Parquet writer (task commit and remote stores included) and read back by block.

Memory is bounded by a block and a portion of texts. A document over several blocks is put together from
its pieces in block order, one piece at a time.

Defined results: a null text counts as empty and has the end id only; special strings in a text become
their id, as in the library. Null doc_ids come first; rows that repeat a doc_id follow in the order of
their texts' hashes, each with its own ids. Texts of any length are whole. An empty table gives no ids.
"""

from __future__ import annotations

import itertools
import os
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crawlflow.llm.pieces import PieceTable, require_pattern, spans
from crawlflow.llm.shared import at_rest, pinned, scratch_root, text_of

BLOCK_SCHEMA = (
    "part int, block int, first bigint, n_ids int, head int, kind string, planes array<binary>, "
    "doc_ids array<bigint>, doc_starts array<bigint>, doc_sizes array<bigint>"
)


@lru_cache(maxsize=2)
def library_encoder(path: str) -> PieceTable:
    """Ids by the tokenizers library, 32 bits each.

    Words go to the library in rows, whose ids are cut where a space begins one. A file of another
    pattern than the cut's is refused.
    """
    require_pattern(path)
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    spaced = tokenizer.encode(" a", add_special_tokens=False).tokens[0][0]  # the sign of a space
    begins = np.array([(tokenizer.id_to_token(i) or "")[:1] == spaced for i in range(tokenizer.get_vocab_size())])

    def ids_of(strings: list[str]) -> Iterator[np.ndarray]:
        for i in range(0, len(strings), 64):  # the library's results are large
            for coded in tokenizer.encode_batch_fast(strings[i : i + 64], add_special_tokens=False):
                yield np.array(coded.ids, dtype="<u4")

    def encode(strings: list[str]) -> list[bytes]:
        return [ids.tobytes() for ids in ids_of(strings)]

    def encode_words(words: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for ids in ids_of(["".join([" " + word for word in words[i : i + 64]]) for i in range(0, len(words), 64)]):
            data = ids.tobytes()
            cuts = [*(4 * np.flatnonzero(begins[ids])).tolist(), len(data)]
            out += [data[a:b] for a, b in itertools.pairwise(cuts)]
        return out

    return PieceTable(encode_words, encode)


def to_planes(ids: np.ndarray, kind: str, level: int = 3) -> list[bytes]:
    """The planes of unsigned 32-bit ids, lowest first; each is compressed alone."""
    octets = ids.astype("<u4").view(np.uint8).reshape(-1, 4).T
    if kind == "bit":
        bits = (ids.astype("<u4")[None, :] >> np.arange(32, dtype="<u4")[:, None]) & 1
        planes = np.packbits(bits.astype(np.uint8), axis=1)
    else:
        planes = octets
    press = zstandard.ZstdCompressor(level=level)
    return [press.compress(np.ascontiguousarray(plane).tobytes()) for plane in planes]


def from_planes(planes: list[bytes], kind: str, n: int) -> np.ndarray:
    press = zstandard.ZstdDecompressor()
    raw = [np.frombuffer(press.decompress(plane), np.uint8) for plane in planes]
    if kind == "bit":
        bits = np.unpackbits(np.stack(raw), axis=1, count=n).astype("<u4") if n else np.zeros((32, 0), "<u4")
        return (bits << np.arange(32, dtype="<u4")[:, None]).sum(axis=0, dtype="<u4")
    return np.ascontiguousarray(np.stack(raw, axis=1)).view("<u4").ravel()


def _blocks(path: str, end_id: int, block: int, kind: str):
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        part = TaskContext.get().partitionId()
        waiting: list[bytes] = []  # ids of the block in work
        size = number = head = 0
        index: list[tuple[int, int, int]] = []
        done = 0  # ids of the part before the block in work

        def row(data: bytes) -> pa.RecordBatch:
            ids = np.frombuffer(data, dtype="<u4")
            values = [
                [part], [number], [done], [len(ids)], [head], [kind], [to_planes(ids, kind)],
                [[x[0] for x in index]], [[x[1] for x in index]], [[x[2] for x in index]],
            ]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.binary())]
            types += [pa.list_(pa.int64())] * 3
            names = [field.split(" ")[0] for field in BLOCK_SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], names=names)

        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for i, j in spans(pc.binary_length(texts).to_pylist(), 8_000_000):
                for doc_id, coded in zip(doc_ids[i:j], library_encoder(path)(texts.slice(i, j - i)), strict=True):
                    data = coded + end
                    index.append((doc_id, done + size, len(data) // 4))
                    at, n = 0, len(data) // 4
                    while size + n - at >= block:
                        take = block - size
                        waiting.append(data[4 * at : 4 * (at + take)])
                        yield row(b"".join(waiting))
                        at += take
                        done += block
                        number, size, waiting, index = number + 1, 0, [], []
                        head = min(n - at, block)
                    if at < n:
                        waiting.append(data[4 * at :])
                        size += n - at
        if size:
            yield row(b"".join(waiting))

    return run


def write_token_files(
    docs: DataFrame, folder: str, path: str, end_id: int = 0, block: int = 65_536, kind: str = "byte"
) -> None:
    """Encode `docs` (doc_id, text) and write the file set to `folder`."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text"))
    ordered = keyed.withColumn("h", F.xxhash64("text")).repartitionByRange(parts, "doc_id", "h")
    ordered = ordered.sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text")
    blocks = at_rest(_blocks(path, end_id, block, kind), lambda: None)  # the table of pieces stays
    ordered.mapInArrow(blocks, BLOCK_SCHEMA).write.parquet(f"{folder}/blocks")
    totals = spark.read.parquet(f"{folder}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a part
    totals.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).write.parquet(f"{folder}/parts")


def _pieces(batches):
    """Per document and block: (part, at, block, doc_id, n, crc, data); data only of those cut by a block's end."""
    for batch in batches:
        out: dict[str, list] = {k: [] for k in ("part", "at", "block", "doc_id", "n", "crc", "data")}

        def put(part, at, block, doc_id, n, crc, data, out=out):
            for k, v in zip(out, (part, at, block, doc_id, n, crc, data), strict=True):
                out[k].append(v)

        for row in batch.to_pylist():
            data = from_planes(row["planes"], row["kind"], row["n_ids"]).tobytes()
            if row["head"]:
                put(row["part"], None, row["block"], None, row["head"], None, data[: 4 * row["head"]])
            for doc_id, at, size in zip(row["doc_ids"], row["doc_starts"], row["doc_sizes"], strict=True):
                here = data[4 * (at - row["first"]) : 4 * (at - row["first"] + size)]
                whole = len(here) == 4 * size
                put(row["part"], at, row["block"], doc_id, size, zlib.crc32(here) if whole else None, None if whole else here)
        kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], names=list(out))


def _joined(batches):
    """Documents from their pieces, which come in order: part, block, the block's head first."""
    held = None
    for batch in batches:
        done = []
        for row in batch.to_pylist():
            if row["at"] is not None:
                if held:
                    done.append(held)
                held = {k: row[k] for k in ("part", "at", "doc_id", "n")} | {"crc": zlib.crc32(row["data"])}
            else:
                held["crc"] = zlib.crc32(row["data"], held["crc"])
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        names = ["part", "at", "doc_id", "n", "crc"]
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in zip(names, kinds, strict=True)], names=names)
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([held[k]], t) for k, t in zip(names, kinds, strict=True)], names=names)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""
    blocks = spark.read.parquet(f"{folder}/blocks")
    pieces = pinned(blocks.mapInArrow(_pieces, "part int, at bigint, block int, doc_id bigint, n bigint, crc bigint, data binary"))
    names = ["part", "at", "doc_id", "n", "crc"]
    whole = pieces.filter("data is null").select(*names)
    # A document cut by a block's end runs on in the next: a key for each document and its pieces.
    starts = pieces.filter("data is not null")
    by_part = starts.repartition("part").sortWithinPartitions("part", "block", F.col("at").isNotNull())
    cut = by_part.mapInArrow(_joined, "part int, at bigint, doc_id bigint, n bigint, crc bigint")
    parts = spark.read.parquet(f"{folder}/parts").select(F.col("part").alias("of"), F.col("start").alias("before"))
    return (
        whole.unionByName(cut)
        .join(F.broadcast(parts), F.col("part") == F.col("of"))  # a row a part
        .select("doc_id", (F.col("before") + F.col("at")).alias("start"), F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))
    )


def token_file_digest(docs: DataFrame, path: str, **options) -> DataFrame:
    """Write the files to the shared folder, read them back, and remove them."""
    spark = docs.sparkSession
    folder = f"{scratch_root(spark)}/token-files-{uuid.uuid4().hex}"
    write_token_files(docs, folder, path, **options)
    result = pinned(read_token_files(spark, folder))
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    return result
