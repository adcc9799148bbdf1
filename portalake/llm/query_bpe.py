"""op1: whole documents to token ids and back, as digests."""

from __future__ import annotations

import hashlib

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from .registry import query, table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def digests(df: DataFrame) -> DataFrame:
    """doc_id, ids, decoded -> the columns of the query. Ids are hashed where Arrow has them."""
    def run(batches):
        for batch in batches:
            ids = batch.column("ids")
            ends, flat = ids.offsets.to_pylist(), memoryview(ids.values.to_numpy().astype("<u4", copy=False)).cast("B")
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"),
                 pa.array([b - a for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.int64()),
                 pa.array([hashlib.sha256(flat[4 * a:4 * b]).hexdigest() for a, b in zip(ends[:-1], ends[1:], strict=True)]),
                 pa.array([hashlib.sha256(d.as_buffer()).hexdigest() for d in batch.column("decoded")])],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return df.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


@query("op1_bpe")
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    ids = bpe.encode(docs, RANKS, PATTERN).select("doc_id", "ids")
    return digests(bpe.decode(ids, RANKS, PATTERN).select("doc_id", "ids", "decoded"))
