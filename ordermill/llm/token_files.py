"""Token ids of a corpus in compressed files, in ascending order of document id.

Layout of a written corpus under one path:
- ``table``: the shared frequency of every token id, one row each;
- ``blocks``: one row per block: ``shard``, ``block``, ``tokens``, the documents in it
  (``doc_ids``, ``lengths``) and ``data``, the coded ids (see ``rans``). Blocks follow each other
  in the order of (shard, block), documents in ascending id.

Both are Parquet, so that any storage Spark writes to can hold them and a lost task leaves no half
file. Blocks are independent: each is decoded on its own, and from any of its checkpoints.

Null and empty texts consist of the end id alone. Repeated ids keep one entry per row, equal ids
in the order of their lengths; a null id comes first. An empty table gives files without blocks.
"""

from __future__ import annotations

import zlib
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermill.llm import rans, tokens
from ordermill.llm.store import held

TOKENS_A_BLOCK = 1 << 19
DOCS_A_SHARD = 20_000
IDS_A_COUNT = 1 << 18
#: Most documents that go between the JVM and Python at once; both sides hold a batch several times over.
BATCH_ROWS = 2_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BROADCAST_BLOCKS = 500_000


def tokenize(documents: DataFrame, end_id: int = 1, tokenizer: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the ids (two bytes each where the vocabulary allows it, else four)."""
    path = tokenizer or tokens.default_file()

    def run(batches):
        kind = _kind(max(tokens.encoder(path).size, end_id + 1))
        for doc_ids, ids, first in tokens.encoded_slices(batches, path, end_id):
            data = ids.astype(kind).tobytes()
            width = np.dtype(kind).itemsize
            blobs = pa.Array.from_buffers(
                pa.large_binary(), len(doc_ids),
                [None, pa.py_buffer((first * width).astype(np.int64).tobytes()), pa.py_buffer(data)],
            )
            yield pa.RecordBatch.from_arrays(
                [doc_ids, pa.array(np.diff(first)), blobs.cast(pa.binary())],
                names=["doc_id", "n_tokens", "ids"],
            )

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def _kind(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


@contextmanager
def _batches(spark: SparkSession):
    """Batches of ``BATCH_ROWS`` rows at most in what runs meanwhile."""
    before = int(spark.conf.get(_BATCH))
    spark.conf.set(_BATCH, str(BATCH_ROWS if before <= 0 else min(before, BATCH_ROWS)))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, str(before))


def counted(batches, size: int) -> np.ndarray:
    """How often each id occurs in the batches."""
    kind, total = _kind(size), np.zeros(size, np.int64)
    for batch in batches:
        column = batch.column("ids").cast(pa.large_binary())
        _, at, data = column.buffers()
        if not len(column) or data is None:
            continue
        at = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
        ids = np.frombuffer(data, np.uint8)[at[0] : at[-1]].view(kind)
        for k in range(0, len(ids), IDS_A_COUNT):
            total += np.bincount(ids[k : k + IDS_A_COUNT], minlength=size)
    return total


def token_counts(tokenized: DataFrame, size: int) -> np.ndarray:
    """How often each id occurs. Only ``size`` numbers, the vocabulary, leave the tasks."""

    def count(batches):
        total = counted(batches, size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["id", "n"])

    rows = tokenized.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    out = np.zeros(size, np.int64)
    for r in rows.toLocalIterator():
        out[r[0]] = r[1]
    return out


def write(
    documents: DataFrame, path: str, end_id: int = 1, tokenizer: str | None = None,
    tokens_a_block: int = TOKENS_A_BLOCK, docs_a_shard: int = DOCS_A_SHARD,
) -> None:
    """Writes the corpus under ``path``. Texts are tokenized once; ids then move to the shard of
    their document id. Shards are ranges of ids with about as many documents each."""
    spark = documents.sparkSession
    file = tokenizer or tokens.default_file()
    size = max(tokens.Encoder(file).size, end_id + 1)
    with _batches(spark):
        stored = held(tokenize(documents, end_id, file), "tokens")
        freq = rans.table(token_counts(stored, size))
    spark.createDataFrame(
        pa.table({"id": np.arange(size), "freq": freq.astype(np.int64)})
    ).coalesce(1).write.parquet(f"{path}/table")
    rows = stored.count()
    shards = max(1, -(-rows // docs_a_shard))
    kind = _kind(size)
    shared = spark.sparkContext.broadcast(freq)

    def encode(batches):
        import pyspark

        tokens.forget()
        shard = pyspark.TaskContext.get().partitionId()
        coder = rans.Coder(shared.value)
        block, ids, blobs, total = 0, [], [], 0

        def flush():
            lengths = [len(b) // np.dtype(kind).itemsize for b in blobs]
            data = coder.encode(np.frombuffer(b"".join(blobs), kind))
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([total], pa.int64()),
                 pa.array([ids], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64())),
                 pa.array([data], pa.binary())],
                names=["shard", "block", "tokens", "doc_ids", "lengths", "data"],
            )

        for batch in batches:
            for doc_id, blob in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                n = len(blob.as_buffer()) // np.dtype(kind).itemsize
                if blobs and total + n > tokens_a_block:
                    yield flush()
                    block, ids, blobs, total = block + 1, [], [], 0
                ids.append(doc_id)
                blobs.append(blob.as_py())
                total += n
        if blobs:
            yield flush()

    blocks = (
        stored.repartitionByRange(shards, "doc_id")
        .sortWithinPartitions("doc_id", "n_tokens", "ids")
        .select("doc_id", "ids")
        .mapInArrow(encode, "shard int, block int, tokens long, doc_ids array<long>, lengths array<long>, data binary")
    )
    with _batches(spark):
        blocks.write.parquet(f"{path}/blocks")


def frequencies(spark: SparkSession, path: str) -> np.ndarray:
    rows = spark.read.parquet(f"{path}/table").collect()  # one number per token id
    out = np.zeros(len(rows), np.uint32)
    for r in rows:
        out[r["id"]] = r["freq"]
    return out


def read(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and (``with_ids``) ids of every document, from the files alone.
    The ids are decoded and checked either way."""
    stored = spark.read.parquet(f"{path}/blocks")
    shared = spark.sparkContext.broadcast(frequencies(spark, path))
    # Tokens before a block: running sums within shards, and of shards; one row per block here.
    heads = stored.select("shard", "block", "tokens")
    inside = Window.partitionBy("shard").orderBy("block")
    shards = heads.groupBy("shard").agg(F.sum("tokens").alias("all"))
    above = shards.select(
        "shard", (F.sum("all").over(Window.orderBy("shard")) - F.col("all")).alias("above")
    )
    starts = heads.join(above, "shard").select(
        "shard", "block", (F.col("above") + F.sum("tokens").over(inside) - F.col("tokens")).alias("start")
    )

    names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: 5 if with_ids else 4]

    def decode(batches):
        coder = rans.Coder(shared.value)
        for batch in batches:
            for k in range(batch.num_rows):
                ids = coder.decode(batch.column("data")[k].as_buffer().to_pybytes())
                lengths = np.asarray(batch.column("lengths")[k].values, np.int64)
                first = np.concatenate([[0], np.cumsum(lengths)])
                raw = ids.astype("<u4").tobytes()
                raw = memoryview(raw) if not with_ids else raw
                blobs = [raw[4 * a : 4 * b] for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
                columns = [
                    batch.column("doc_ids")[k].values, pa.array(first[:-1] + batch.column("start")[k].as_py()),
                    pa.array(lengths), pa.array([zlib.crc32(b) for b in blobs], pa.int64()),
                ]
                columns += [pa.array(blobs, pa.binary())] if with_ids else []
                yield pa.RecordBatch.from_arrays(columns, names=names)

    # One row of four numbers per block: sent to every task while it is small, else joined.
    if heads.count() <= BROADCAST_BLOCKS:
        starts = F.broadcast(starts)
    return stored.join(starts, ["shard", "block"]).select("doc_ids", "lengths", "data", "start").mapInArrow(
        decode, "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    )
