"""Which 64-bit keys occur with two owners or more, over a whole table of documents.

Rows are dealt to chunks by a hash of id and text, so that many rows with a null id, or with one id,
spread (one exchange of the texts, used again by later steps of the same query).  A chunk sends each distinct key once, packed with the others of
the same bucket (a range of keys), so a key that a third of all documents hold reaches its
bucket once for each chunk, not once for each document.  The bucket answers each chunk with
one bit for each key it sent.  Nothing is collected, and every task holds one chunk or one bucket.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 2 << 20       # text of a chunk
BUCKET_BYTES = 1 << 20      # keys of a bucket, about
REPLY = "chunk long, kind int, bucket long, bits binary"
SENT = "bucket long, chunk long, keys binary, several binary"


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def chunk_of(size: int, chunk_bytes: int, seed: int, id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The chunk of a row: any rows but those equal in both id and text may part."""
    chunks = max(1, -(-size // chunk_bytes))
    return F.pmod(F.xxhash64(F.lit(seed), F.col(id_col).cast("long"), F.col(text_col)), F.lit(chunks))


def dealt(docs: DataFrame, size: int, id_col: str = "doc_id") -> DataFrame:
    """``chunk, doc_id, text``, dealt by chunk."""
    return docs.select(chunk_of(size, CHUNK_BYTES, 11, id_col).alias("chunk"), F.col(id_col).cast("long").alias("doc_id"),
                       "text").repartition("chunk")


def bucket_bits(expected_bytes: float) -> int:
    """Buckets are the 2^bits ranges of the key space."""
    return max(0, int(np.ceil(np.log2(max(1.0, expected_bytes / BUCKET_BYTES)))))


def bucket_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def bounds_of(sorted_keys: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """(bucket, first, end) of the runs of one bucket in sorted keys."""
    buckets = bucket_of(sorted_keys, bits)
    starts = np.flatnonzero(np.append(True, buckets[1:] != buckets[:-1])) if len(buckets) else np.zeros(0, int)
    return [(int(buckets[a]), int(a), int(b)) for a, b in zip(starts, np.append(starts[1:], len(buckets)))]


def distinct(keys: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and whether each has several owners here."""
    order = np.argsort(keys, kind="stable")
    keys, owners = keys[order], owners[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, int)
    if not len(keys):
        return keys, np.zeros(0, bool)
    return keys[first], np.minimum.reduceat(owners, first) != np.maximum.reduceat(owners, first)


def sent(chunk: int, keys: np.ndarray, several: np.ndarray, bits: int) -> pa.Table:
    runs = bounds_of(keys, bits)
    return pa.table({
        "bucket": pa.array([r[0] for r in runs], pa.int64()), "chunk": pa.array([chunk] * len(runs), pa.int64()),
        "keys": pa.array([keys[a:b].tobytes() for _, a, b in runs], pa.binary()),
        "several": pa.array([np.packbits(several[a:b]).tobytes() for _, a, b in runs], pa.binary())})


def _answer(key: tuple, rows: pa.Table) -> pa.Table:
    packed = rows["keys"].to_pylist()
    counts = np.array([len(p) // 8 for p in packed])
    keys = np.frombuffer(b"".join(packed), np.uint64)
    several = np.concatenate([np.unpackbits(np.frombuffer(s, np.uint8), count=n).astype(bool)
                              for s, n in zip(rows["several"].to_pylist(), counts)])
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    begins = np.append(True, ordered[1:] != ordered[:-1])
    group = np.cumsum(begins) - 1
    shared = (np.bincount(group) > 1) | (np.bincount(group, weights=several[order]) > 0)
    mask = np.empty(len(keys), bool)
    mask[order] = shared[group]
    ends = np.cumsum(counts)
    return pa.table({
        "chunk": rows["chunk"], "kind": pa.array(np.zeros(len(packed), np.int32)),
        "bucket": pa.array([key[0].as_py()] * len(packed), pa.int64()),
        "bits": pa.array([np.packbits(mask[e - n:e]).tobytes() for e, n in zip(ends, counts)], pa.binary())})


def answers(messages: DataFrame) -> DataFrame:
    """``REPLY`` rows for the messages of all chunks."""
    return messages.groupBy("bucket").applyInArrow(_answer, REPLY)


def read_answer(replies: pa.Table, keys: np.ndarray, bits: int, kind: int = 0) -> np.ndarray:
    """For a chunk's distinct keys in order: whether each has several owners."""
    by_bucket = {b: m for b, k, m in zip(replies["bucket"].to_pylist(), replies["kind"].to_pylist(),
                                         replies["bits"].to_pylist()) if k == kind}
    out = np.zeros(len(keys), bool)
    for bucket, a, b in bounds_of(keys, bits):
        out[a:b] = np.unpackbits(np.frombuffer(by_bucket[bucket], np.uint8), count=b - a).astype(bool)
    return out
