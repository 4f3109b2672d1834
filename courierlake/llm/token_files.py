"""Operator 4: token ids as Parquet list columns, written for selective reads, and read back.

`write_tokens` deals documents by range of doc_id, encodes them and lets Spark's Parquet writer commit the files:
ids are a list column under a dictionary (the vocabulary fits one dictionary page), doc_id and n_tokens are
delta-encoded, row groups and pages have set sizes, and every file carries page indexes. A reader that asks for a
range of doc_id or for metadata only skips row groups, pages and the id column.

Defined results: null or empty text gives the end id alone; a null doc_id sorts first; repeated rows are kept, in any
order among themselves; an empty table gives no rows; columns not asked for in `meta` are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import running_totals, width, workspace
from .tokens import encoder, slices

ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2_000


def encode_rows(vocabulary: str, end_id: int):
    """Batches of (doc_id, ..., text) to batches of (doc_id, ..., n_tokens, ids)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for first, rows in slices(batch.column(at)):
                part = batch.slice(first, rows)
                flat, starts = enc.ids(part.column(at))
                lengths = np.diff(starts)
                ids = np.empty(len(flat) + rows, np.int32)
                ends = np.cumsum(lengths + 1)
                ids[ends - 1] = end_id
                inner = np.ones(len(ids), bool)
                inner[ends - 1] = False
                ids[inner] = flat
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids))
                rest = [c for i, c in enumerate(part.columns) if i != at]
                names = [n for i, n in enumerate(part.schema.names) if i != at]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(lengths + 1, pa.int64()), lists],
                                                 names=[*names, "n_tokens", "ids"])
        # The worker waits for its next task beside others: what Arrow keeps of freed memory goes back.
        pa.default_memory_pool().release_unused()

    return encode


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int = 2, meta: tuple[str, ...] = (),
                 row_group_bytes: int = ROW_GROUP_BYTES, page_bytes: int = PAGE_BYTES) -> None:
    """Files of (doc_id, *meta, n_tokens, ids) in ascending doc_id order, across files and within them."""
    dealt = (docs.select("doc_id", *meta, "text").repartitionByRange(width(docs.sparkSession), "doc_id")
             .sortWithinPartitions("doc_id"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema if f.name != "text")
    rows = dealt.mapInArrow(encode_rows(vocabulary, end_id), f"{kinds}, n_tokens long, ids array<int>")
    (rows.write.mode("overwrite").option("compression", "zstd").option("parquet.writer.version", "v2")
     .option("parquet.enable.dictionary", "true").option("parquet.enable.dictionary#doc_id", "false")
     .option("parquet.enable.dictionary#n_tokens", "false").option("parquet.block.size", row_group_bytes)
     .option("parquet.page.size", page_bytes).option("parquet.page.row.count.limit", PAGE_ROWS).parquet(path))


def read_tokens(spark: SparkSession, path: str, columns: tuple[str, ...] = ("doc_id", "n_tokens", "ids"),
                first: int | None = None, last: int | None = None) -> DataFrame:
    """Chosen columns of the documents first..last; bounds reach the scan, which skips row groups and pages by them."""
    rows = spark.read.parquet(path)
    if first is not None:
        rows = rows.filter(F.col("doc_id") >= first)
    if last is not None:
        rows = rows.filter(F.col("doc_id") <= last)
    return rows.select(*columns)


def list_crc32(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, ids) to (doc_id, n_tokens, ids_crc32)."""
    for batch in batches:
        lists = batch.column(1)
        data = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
        cuts = lists.offsets.to_numpy()
        crc = [zlib.crc32(data[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(cuts), pa.int64()),
                                          pa.array(crc, pa.int64())], names=["doc_id", "n_tokens", "ids_crc32"])


def token_digests(docs: DataFrame, vocabulary: str, end_id: int = 2) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files that were written."""
    spark = docs.sparkSession
    folder = workspace(spark)
    write_tokens(docs, f"{folder}/tokens", vocabulary, end_id)
    read = read_tokens(spark, f"{folder}/tokens", ("doc_id", "ids"))
    digests = read.mapInArrow(list_crc32, "doc_id long, n_tokens long, ids_crc32 long")
    digests.write.parquet(f"{folder}/digests")
    return running_totals(spark.read.parquet(f"{folder}/digests"), [], ["doc_id"], "n_tokens", "start", folder,
                          "starts").select("doc_id", "start", "n_tokens", "ids_crc32")


