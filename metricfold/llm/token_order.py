"""Training-order materialisation: token sequences at permuted slots of fixed-stride shards.

Documents are tokenised once and dealt to chunks by a hash of id and text.  In a chunk, documents
lie in id order, each followed by the end token, and are cut into sequences of ``length`` tokens
(the chunk's last one is filled up with end tokens and says how many are real).  Prefix sums
over the chunks number the sequences 0..N-1, and a keyed Feistel permutation with
cycle-walking sends each number to its slot in training order.  Slot ``s`` belongs to shard
``s // slots_per_shard``; a shard is the byte string of its slots, ``2 * length`` bytes each, so any reader can
seek to slot ``s`` and go on from there.

The permutation is computed per sequence (no sort of all sequences, no table of the order).
Memory per task: one chunk, or one shard.  Null texts count as empty; an empty text gives its
end token alone; documents with equal ids order by chunk and tokens.  No rows: no shards.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metricfold.llm.shared_keys import chunk_of

LENGTH = 1_024
SLOTS_PER_SHARD = 512
CHUNK_BYTES = 2 << 20
ROUNDS = 6
PREFIX_BLOCK = 4_096
SEED = 7
SHARDS = "shard long, first_slot long, n_slots long, n_tokens long, sha256 string, payload binary"


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> str:
    """The path of a public vocabulary file installed with the tokenizers' package."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def encoding(ranks: bytes):
    import public_tokenizers
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def permute(index: np.ndarray, n: int, key: int, rounds: int = ROUNDS) -> np.ndarray:
    """The slots of ``index``: a bijection of 0..n-1 chosen by ``key``.

    A balanced Feistel network permutes the smallest even-width power of two of at least n;
    values that land beyond n walk their cycle until they return below it."""
    half = np.uint64(max(1, -(-max(1, (n - 1).bit_length()) // 2)))
    low = (np.uint64(1) << half) - np.uint64(1)
    keys = _mix(np.array([(key + (r + 1) * 0x9E3779B97F4A7C15) % 2**64 for r in range(rounds)], np.uint64))
    out = index.astype(np.uint64).copy()
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & low
        for k in keys:
            left, right = right, left ^ (_mix(right ^ k) & low)
        out[todo] = (left << half) | right
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def _tokenise(ranks: bytes):
    def run(batches):
        enc, squeeze = encoding(ranks), zstandard.ZstdCompressor(level=3)
        end = np.array([enc.max_token_value + 1], np.uint16)
        for batch in batches:
            ids = [np.append(np.array(enc.encode_ordinary(t.as_py() or ""), np.uint16), end) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(i) for i in ids], pa.int64()),
                 pa.array([squeeze.compress(i.tobytes()) for i in ids], pa.binary())],
                ["chunk", "doc_id", "n", "ids"])
    return run


def _count(length: int):
    def run(key: tuple, docs: pa.Table) -> pa.Table:
        return pa.table({"chunk": pa.array([key[0].as_py()], pa.int64()),
                         "n": pa.array([-(-int(docs["n"].to_numpy().sum()) // length)], pa.int64())})
    return run


def _sequences(length: int, key: int, end: int):
    def run(docs: pa.Table, numbers: pa.Table) -> pa.Table:
        names = ["slot", "n_tokens", "ids"]
        kinds = [pa.int64(), pa.int64(), pa.binary()]
        if docs.num_rows == 0 or numbers.num_rows == 0:
            return pa.table([pa.array([], k) for k in kinds], names)
        first, total = numbers["first"][0].as_py(), numbers["total"][0].as_py()
        expand = zstandard.ZstdDecompressor()
        rows = sorted(((i is not None, i or 0, expand.decompress(b))
                       for i, b in zip(docs["doc_id"].to_pylist(), docs["ids"].to_pylist())))
        tokens = np.frombuffer(b"".join(r[2] for r in rows), np.uint16)
        n = -(-len(tokens) // length)
        grid = np.full(n * length, end, np.uint16)
        grid[:len(tokens)] = tokens
        slots = permute(np.arange(first, first + n), total, key)
        real = np.minimum(length, len(tokens) - np.arange(n) * length)
        squeeze = zstandard.ZstdCompressor(level=3)
        packed = [squeeze.compress(row.tobytes()) for row in grid.reshape(n, length)]
        return pa.table([pa.array(slots), pa.array(real), pa.array(packed, pa.binary())], names)
    return run


def _shard(length: int, slots: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        import hashlib

        order = np.argsort(rows["slot"].to_numpy())
        expand, packed = zstandard.ZstdDecompressor(), rows["ids"].to_pylist()
        payload = b"".join(expand.decompress(packed[i]) for i in order)
        if len(payload) != 2 * length * len(order):
            raise ValueError("a sequence has not the shard's stride")
        shard = key[0].as_py()
        return pa.table({
            "shard": [shard], "first_slot": [shard * slots], "n_slots": [len(order)],
            "n_tokens": [int(rows["n_tokens"].to_numpy().sum())],
            "sha256": [hashlib.sha256(payload).hexdigest()], "payload": pa.array([payload], pa.binary())})
    return run


def numbering(counts: DataFrame) -> DataFrame:
    """``chunk, n`` -> ``chunk, first, total``: exclusive prefix sums, in two levels so that no window
    holds more than ``PREFIX_BLOCK`` chunks or one row per such block."""
    block = F.floor(F.col("chunk") / PREFIX_BLOCK)
    counts = counts.withColumn("block", block)
    upto = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    blocks = counts.groupBy("block").agg(F.sum("n").alias("block_n")).select(
        "block", F.coalesce(F.sum("block_n").over(upto(Window.orderBy("block"))), F.lit(0)).alias("block_first"),
        F.sum("block_n").over(Window.partitionBy()).alias("total"))
    inside = F.coalesce(F.sum("n").over(upto(Window.partitionBy("block").orderBy("chunk"))), F.lit(0))
    return counts.withColumn("inside", inside).join(blocks, "block").select(
        "chunk", (F.col("block_first") + F.col("inside")).alias("first"), "total")


def shards(docs: DataFrame, ranks: bytes, length: int = LENGTH, slots: int = SLOTS_PER_SHARD, key: int = SEED,
           chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """All shards, one row each (see ``SHARDS``).  ``ranks``: the content of a tiktoken vocabulary file."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    end = encoding(ranks).max_token_value + 1
    chunk = chunk_of(size, chunk_bytes, key)
    tokens = docs.select(chunk.alias("chunk"), F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _tokenise(ranks), "chunk long, doc_id long, n long, ids binary")
    # One exchange of the tokens by chunk serves both the counts and the sequences.
    dealt = tokens.repartition("chunk")
    counts = dealt.groupBy("chunk").applyInArrow(_count(length), "chunk long, n long")
    placed = dealt.groupBy("chunk").cogroup(numbering(counts).groupBy("chunk")).applyInArrow(
        _sequences(length, key, end), "slot long, n_tokens long, ids binary")
    return (placed.withColumn("shard", F.floor(F.col("slot") / slots)).groupBy("shard")
            .applyInArrow(_shard(length, slots), SHARDS))


def write(shard_rows: DataFrame, folder: str) -> DataFrame:
    """Write each shard to ``folder/shard-<number>.bin`` from the tasks and return the manifest.

    A file appears under its name only when it is whole, with the same bytes at every attempt,
    so a lost task may run again."""
    def run(batches):
        from uuid import uuid4

        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        for batch in batches:
            paths = []
            for row in batch.select(["shard", "payload"]).to_pylist():
                path, own = f"{root}/shard-{row['shard']:08d}.bin", f"{root}/.writing-{uuid4().hex}"
                with store.open_output_stream(own) as out:
                    out.write(row["payload"])
                store.move(own, path)
                paths.append(path.removeprefix(f"{root}/"))
            kept = batch.drop_columns(["payload"])
            yield kept.append_column("path", pa.array(paths, pa.string()))
    return shard_rows.mapInArrow(run, SHARDS.replace("payload binary", "path string"))


def read_slots(folder: str, first: int, count: int, length: int = LENGTH, slots: int = SLOTS_PER_SHARD):
    """The sequences of slots ``first`` .. ``first + count - 1``, read at their places in the shards."""
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder)
    stride = 2 * length
    while count > 0:
        shard, at = divmod(first, slots)
        n = min(count, slots - at)
        with store.open_input_file(f"{root}/shard-{shard:08d}.bin") as file:
            data = file.read_at(n * stride, at * stride)
        yield from np.frombuffer(data, np.uint16).reshape(-1, length)
        first, count = first + n, count - n
