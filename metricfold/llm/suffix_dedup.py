"""Removal of repeated byte strings by longest-previous-factor arrays.

A byte goes if a 50-byte string that covers it also starts in a document with a smaller id.
That is: the longest previous factor (LPF) of some suffix covering it, counted against earlier
documents only, is at least 50.

Suffixes are only compared where they can match.  Each 50-byte window has a minimizer (the
smallest hash of its 20-byte grams); equal windows have equal minimizers, and consecutive windows
with the same one form a run (about 65 bytes of text).  Minimizers that only one document has
rule their windows out (``shared_keys``).  The runs of the others meet in buckets of minimizers,
each distinct run text once, with its smallest id.  There the suffix array of the run texts
(suffixes ordered by their first 50 bytes, ties by id) and its LCP array give the previous and the next smaller id of
every window in suffix order; the larger LCP with the two is the window's longest previous factor
(``longest_previous_factors``; 50 at most, all that the result needs).  The chunk gets one bit per window
back: LPF of 50.  All matches compare bytes, not hashes.

Matches are judged on the input, never cross documents, and may overlap.  A null or empty text
has no bytes.  Rows with equal ids never remove each other's bytes.  A null id counts as larger
than all others.  Tasks hold one chunk or one bucket of runs; a text longer than a chunk is a
chunk of its own.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricfold.llm import shared_keys as sk
from metricfold.llm.text_bytes import MIX_A, mix, text_and_offsets

SPAN = 50
GRAM = 20
BLOCK = 1 << 15
LAST = np.iinfo(np.int64).max
RUNS = "bucket long, chunk long, keys binary, owners binary, lengths binary, text binary"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

_RANDOM = np.random.default_rng(20)
_BYTE = _RANDOM.integers(0, 2**64, 256, dtype=np.uint64)
_STEP = _RANDOM.integers(0, 2**63, 5, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _gram_hashes(buf: np.ndarray) -> np.ndarray:
    h1 = _BYTE[buf]
    h2 = h1[:-1] * _STEP[0] + h1[1:]
    h4 = h2[:-2] * _STEP[1] + h2[2:]
    h8 = h4[:-4] * _STEP[2] + h4[4:]
    h16 = h8[:-8] * _STEP[3] + h8[8:]
    return mix(h16[:-4] * _STEP[4] + h4[16:])


def window_minimizers(buf: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """The smallest gram hash of every window of ``SPAN`` bytes (row boundaries not regarded)."""
    n = len(buf) - SPAN + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    for a in range(0, n, block):        # blocks that fit the processor's cache
        b = min(n, a + block)
        m = _gram_hashes(buf[a:b + SPAN - 1])
        for step in (1, 2, 4, 8):
            m = np.minimum(m[:-step], m[step:])
        out[a:b] = np.minimum(m[:-15], m[15:])          # 31 grams in a window
    return out


class Chunk:
    """The documents of a chunk in order of their ids, and the runs of their windows."""

    def __init__(self, docs: pa.Table):
        ids = docs["doc_id"].to_numpy().astype(object) if docs["doc_id"].null_count else docs["doc_id"].to_numpy()
        known = np.array([LAST if i is None or i != i else int(i) for i in ids], np.int64)
        order = np.argsort(known, kind="stable")
        texts = docs["text"].combine_chunks() if isinstance(docs["text"], pa.ChunkedArray) else docs["text"]
        order = np.array(sorted(order, key=lambda i: (known[i], texts[int(i)].as_py() or "")) if len(set(known)) < len(known) else order, int)
        self.order, self.owners = order, known[order]
        self.buf, self.off = text_and_offsets(docs["text"].take(pa.array(order)))
        lens = np.diff(self.off)
        counts = np.maximum(lens - SPAN + 1, 0)
        first = np.cumsum(counts) - counts
        at = np.arange(int(counts.sum())) + np.repeat(self.off[:-1] - first, counts)
        row = np.repeat(np.arange(len(lens)), counts)
        keys = window_minimizers(self.buf)[at] if len(at) else np.zeros(0, np.uint64)
        new = np.append(True, (keys[1:] != keys[:-1]) | (row[1:] != row[:-1])) if len(keys) else np.zeros(0, bool)
        begins = np.flatnonzero(new)
        # Minima are small numbers: mixed once more, they spread evenly over the buckets.
        self.start, self.key, self.row = at[begins], mix(keys[begins] + MIX_A), row[begins]
        self.windows = np.diff(np.append(begins, len(keys)))
        self.keys, self.several = sk.distinct(self.key, self.owners[self.row])

    def classes(self, shared: np.ndarray):
        """The runs with shared keys, and their classes of equal key and text in order: for each run
        its class, for each class its first run (smallest id)."""
        runs = np.flatnonzero(shared[np.searchsorted(self.keys, self.key)])
        runs = runs[np.argsort(self.key[runs], kind="stable")]          # key order, then id order
        text = self.buf.tobytes()
        seen: dict[tuple[int, bytes], int] = {}
        ends = (self.start + self.windows + SPAN - 1)[runs]
        of_run = [seen.setdefault((k, text[a:b]), len(seen))
                  for k, a, b in zip(self.key[runs].tolist(), self.start[runs].tolist(), ends.tolist())]
        of_run = np.array(of_run, np.int64)
        return runs, of_run, runs[np.unique(of_run, return_index=True)[1]], [t for _, t in seen]


def _send_keys(bits: int):
    def run(key: tuple, docs: pa.Table) -> pa.Table:
        chunk = Chunk(docs)
        return sk.sent(key[0].as_py(), chunk.keys, chunk.several, bits)
    return run


def _send_runs(bits: int):
    def run(key: tuple, docs: pa.Table, replies: pa.Table) -> pa.Table:
        chunk = Chunk(docs)
        shared = sk.read_answer(replies, chunk.keys, bits)
        _, _, first, texts = chunk.classes(shared)
        owners, lengths = chunk.owners[chunk.row[first]], np.array([len(t) for t in texts], np.int32)
        runs = sk.bounds_of(chunk.key[first], bits)
        return pa.table({
            "bucket": pa.array([r[0] for r in runs], pa.int64()), "chunk": pa.array([key[0].as_py()] * len(runs), pa.int64()),
            "keys": pa.array([chunk.key[first[a:b]].tobytes() for _, a, b in runs], pa.binary()),
            "owners": pa.array([owners[a:b].tobytes() for _, a, b in runs], pa.binary()),
            "lengths": pa.array([lengths[a:b].tobytes() for _, a, b in runs], pa.binary()),
            "text": pa.array([b"".join(texts[a:b]) for _, a, b in runs], pa.binary())})
    return run


def suffix_array(text: np.ndarray, starts: np.ndarray, owners: np.ndarray, depth: int = SPAN):
    """The order of the suffixes at ``starts`` by their first ``depth`` bytes, ties by owner, and the LCP array of
    that order: the bytes that each place shares with the one before, ``depth`` at most (the first: 0)."""
    words = np.lib.stride_tricks.sliding_window_view(text, 8)
    word_at = lambda rows, at: np.ascontiguousarray(words[starts[rows] + at]).view(">u8").ravel().astype(np.uint64)
    order = np.argsort(word_at(np.arange(len(starts)), 0), kind="stable")
    lcp = np.full(len(starts), depth, np.int64)
    begins, places, block, at = np.zeros(len(starts), bool), np.arange(len(starts)), np.zeros(len(starts), np.int64), 0
    while True:
        w = word_at(order[places], at)
        if at:              # only suffixes that still tie with a neighbour are ordered further
            inner = np.lexsort((w, block))
            order[places], w = order[places[inner]], w[inner]
        new = np.append(True, (w[1:] != w[:-1]) | (block[1:] != block[:-1])) & ~begins[places]
        found = np.flatnonzero(new)
        lcp[places[found]] = at + _equal_bytes(w[found] ^ w[found - 1])
        begins[places[found]] = True
        if not at:
            begins[0], lcp[0] = True, 0
        if at + 8 >= depth or begins.all():
            break
        at = min(at + 8, depth - 8)
        tied = ~begins
        tied[:-1] |= ~begins[1:]
        places = np.flatnonzero(tied)
        block = np.cumsum(begins)[places]
    return order[np.lexsort((owners[order], np.cumsum(begins)))], lcp


def _equal_bytes(difference: np.ndarray) -> np.ndarray:
    """Leading zero bytes of 64-bit numbers."""
    return sum((difference < np.uint64(1 << bits)).astype(np.int64) for bits in range(8, 64, 8))


def reach_back(owners: np.ndarray, lcp: np.ndarray, least: int = 1) -> np.ndarray:
    """For each place of a suffix order, the LCP with the previous place of a smaller owner (0: there is none).

    Every place holds a link over places of no smaller owner, with the least LCP on the way.  As long as a link ends
    at an owner that is not smaller, it takes over that place's link, all places at once.  Lengths below ``least`` are
    not followed further, and given as 0."""
    links, reach = np.arange(-1, len(owners) - 1), lcp.copy()
    going = np.flatnonzero(reach >= least)
    while len(going):
        to = links[going]
        on = owners[to] >= owners[going]
        going, to = going[on], to[on]
        reach[going], links[going] = np.minimum(reach[going], reach[to]), links[to]
        going = going[reach[going] >= least]
    return np.where(reach >= least, reach, 0)


def longest_previous_factors(text: np.ndarray, starts: np.ndarray, owners: np.ndarray, depth: int = SPAN,
                             least: int = 1) -> np.ndarray:
    """For each suffix, the longest prefix (``depth`` at most; below ``least``: 0) that a suffix of a smaller owner has
    too: the larger LCP with the previous and the next smaller owner in suffix order."""
    if not len(starts):
        return np.zeros(0, np.int64)
    order, lcp = suffix_array(text, starts, owners, depth)
    ranked = owners[order]
    back = reach_back(ranked, lcp, least)
    ahead = reach_back(ranked[::-1], np.append(0, lcp[:0:-1]), least)[::-1]
    out = np.empty(len(starts), np.int64)
    out[order] = np.maximum(back, ahead)
    return out


def _judge(key: tuple, rows: pa.Table) -> pa.Table:
    number = lambda name, kind: [np.frombuffer(b, kind) for b in rows[name].to_pylist()]
    keys, owners, lengths = number("keys", np.uint64), number("owners", np.int64), number("lengths", np.int32)
    sizes = [len(k) for k in keys]
    keys, owners, lengths = np.concatenate(keys), np.concatenate(owners), np.concatenate(lengths)
    packed, texts = rows["text"].to_pylist(), []
    for text, n, end in zip(packed, sizes, np.cumsum(sizes)):
        ends = np.cumsum(lengths[end - n:end]).tolist()
        texts += [text[b - m:b] for b, m in zip(ends, lengths[end - n:end].tolist())]
    # Distinct runs of the bucket, each with its smallest owner.
    seen: dict[tuple[int, bytes], int] = {}
    of = np.array([seen.setdefault((k, t), len(seen)) for k, t in zip(keys.tolist(), texts)], np.int64)
    least = np.full(len(seen), LAST)
    np.minimum.at(least, of, owners)
    own_keys = np.array([k for k, _ in seen], np.uint64)
    n_windows = np.array([len(t) for _, t in seen], np.int64) - SPAN + 1
    # A window can only occur in distinct runs of the same key; the others need no comparison.
    _, group, count = np.unique(own_keys, return_inverse=True, return_counts=True)
    several = np.flatnonzero(count[group] > 1)
    smaller = [None] * len(seen)
    if len(several):
        all_texts = [t for _, t in seen]
        text = np.frombuffer(b"".join(all_texts[i] for i in several), np.uint8)
        n = n_windows[several]
        begin = np.cumsum(n + SPAN - 1) - (n + SPAN - 1)
        first = np.cumsum(n) - n
        starts = np.arange(int(n.sum())) + np.repeat(begin - first, n)
        hit = longest_previous_factors(text, starts, np.repeat(least[several], n), least=SPAN) >= SPAN
        for i, a, m in zip(several.tolist(), first.tolist(), n.tolist()):
            smaller[i] = hit[a:a + m]
    bits = []
    for n, end in zip(sizes, np.cumsum(sizes)):
        parts = []
        for i in range(end - n, end):
            k = of[i]
            if owners[i] > least[k]:
                parts.append(np.ones(n_windows[k], bool))
            else:
                parts.append(np.zeros(n_windows[k], bool) if smaller[k] is None else smaller[k])
        bits.append(np.packbits(np.concatenate(parts)).tobytes())
    return pa.table({"chunk": rows["chunk"], "kind": pa.array(np.ones(len(sizes), np.int32)),
                     "bucket": pa.array([key[0].as_py()] * len(sizes), pa.int64()), "bits": pa.array(bits, pa.binary())})


def removed_bytes(chunk: Chunk, replies: pa.Table, bits: int) -> np.ndarray:
    """Which bytes of the chunk go."""
    shared = sk.read_answer(replies, chunk.keys, bits)
    runs, of_run, first, _ = chunk.classes(shared)
    by_bucket = {b: m for b, k, m in zip(replies["bucket"].to_pylist(), replies["kind"].to_pylist(),
                                         replies["bits"].to_pylist()) if k == 1}
    n = chunk.windows[first]
    flags = [np.unpackbits(np.frombuffer(by_bucket[b], np.uint8), count=int(n[x:y].sum())).astype(bool)
             for b, x, y in sk.bounds_of(chunk.key[first], bits)]
    flags = np.concatenate(flags) if flags else np.zeros(0, bool)
    begin = np.cumsum(n) - n
    # A run whose class has a smaller id in this chunk goes whole; others by the reply's bits.
    least = chunk.owners[chunk.row[first]]
    whole = chunk.owners[chunk.row[runs]] > least[of_run]
    change = np.zeros(len(chunk.buf) + 1, np.int64)
    full = runs[whole]
    np.add.at(change, chunk.start[full], 1)
    np.add.at(change, chunk.start[full] + chunk.windows[full] + SPAN - 1, -1)
    part, of_part = runs[~whole], of_run[~whole]
    m = chunk.windows[part]
    inner = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
    hit = flags[np.repeat(begin[of_part], m) + inner]
    starts = (np.repeat(chunk.start[part], m) + inner)[hit]
    np.add.at(change, starts, 1)
    np.add.at(change, starts + SPAN, -1)
    return np.cumsum(change[:-1]) > 0


def _digest(bits: int):
    def run(key: tuple, docs: pa.Table, replies: pa.Table) -> pa.Table:
        chunk = Chunk(docs)
        gone = removed_bytes(chunk, replies, bits)
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        inside = chunk.off[:-1][np.diff(chunk.off) > 0]
        begins[inside] = gone[inside]           # runs do not cross documents
        kept, left = chunk.buf[~gone].tobytes(), np.append(0, np.cumsum(~gone))[chunk.off]
        total, spans = np.append(0, np.cumsum(gone))[chunk.off], np.append(0, np.cumsum(begins))[chunk.off]
        return pa.table({
            "doc_id": docs["doc_id"].take(pa.array(chunk.order)), "n_bytes": pa.array(np.diff(chunk.off), pa.int64()),
            "n_removed": pa.array(np.diff(total), pa.int64()), "n_spans": pa.array(np.diff(spans), pa.int64()),
            "kept_sha256": [hashlib.sha256(kept[a:b]).hexdigest() for a, b in zip(left[:-1], left[1:])]})
    return run


def _clean(bits: int, fields: list[str]):
    def run(key: tuple, docs: pa.Table, replies: pa.Table) -> pa.Table:
        chunk = Chunk(docs)
        gone = removed_bytes(chunk, replies, bits)
        kept, left = chunk.buf[~gone].tobytes(), np.append(0, np.cumsum(~gone))[chunk.off]
        rows = docs.take(pa.array(chunk.order))
        touched = np.diff(np.append(0, np.cumsum(gone))[chunk.off]) > 0
        # A cut inside a character leaves bytes that are no text; they go too.
        texts = [kept[a:b].decode("utf-8", "ignore") if t else old
                 for t, old, a, b in zip(touched.tolist(), rows["text"].to_pylist(), left[:-1], left[1:])]
        rows = rows.set_column(rows.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))
        keep = pa.array([not t or bool(x and x.strip()) for t, x in zip(touched.tolist(), texts)], pa.bool_())
        return rows.filter(keep).select(fields)
    return run


def _replies(docs: DataFrame, size: int) -> tuple[DataFrame, DataFrame, int]:
    bits = sk.bucket_bits(size * 8 * 2 / (SPAN - GRAM + 2))
    # All steps take all columns of the dealt documents, so that they share one exchange.
    keys = docs.groupBy("chunk").applyInArrow(_send_keys(bits), sk.SENT)
    first = sk.answers(keys)
    runs = docs.groupBy("chunk").cogroup(first.groupBy("chunk")).applyInArrow(_send_runs(bits), RUNS)
    second = runs.groupBy("bucket").applyInArrow(_judge, sk.REPLY)
    return first, second, bits


def spans_removed(docs: DataFrame) -> DataFrame:
    """Per document: bytes, removed bytes and spans, and the digest of what is left."""
    size = sk.text_bytes(docs)
    own = sk.dealt(docs, size)
    first, second, bits = _replies(own, size)
    return own.groupBy("chunk").cogroup(first.unionByName(second).groupBy("chunk")).applyInArrow(_digest(bits), RESULT)


def cleaned(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated bytes cut from ``text``, and without the rows of which nothing is
    left.  Other columns (any names) stay as they are."""
    size = sk.text_bytes(docs)
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    renamed = docs.select(sk.chunk_of(size, sk.CHUNK_BYTES, 11).alias("chunk"),
                          F.col("doc_id").cast("long").alias("doc_id"), "text",
                          *[F.col(f"`{c}`").alias(f"other_{i}") for i, c in enumerate(others)]).repartition("chunk")
    first, second, bits = _replies(renamed, size)
    fields = [c for c in renamed.columns if c != "chunk"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in renamed.select(*fields).schema)
    out = renamed.groupBy("chunk").cogroup(first.unionByName(second).groupBy("chunk")).applyInArrow(_clean(bits, fields), schema)
    names = {"doc_id": "doc_id", "text": "text"} | {f"other_{i}": c for i, c in enumerate(others)}
    back = {c: f for f, c in names.items()}
    return out.select(*[F.col(back[c]).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])
