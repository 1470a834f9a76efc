"""SentencePiece encoding and decoding on the tokenizers library.

``build`` parses a SentencePiece model file (protobuf) and rebuilds it: the normaliser
(precompiled character map, white-space rules), the metaspace marker, the pieces with their
scores (unigram) or merges (BPE) and the byte fallback.  ``encode`` runs it over a table,
batch by batch with the library's threads, decodes the ids again (``round_trip``) and checks each
text's ids against the SentencePiece library itself (``parity``).

Most models' pieces never reach over the start of a word.  The code checks that for the given
model; then each distinct word of a batch is encoded, decoded and checked against SentencePiece
once, and the ids of a text are put together from its words'.  SentencePiece normalises every
whole text too: equal normalised texts whose words all have equal ids have equal ids, since no
merge crosses the start of a word.  Other models get whole texts.

A unigram model's byte pieces keep their names, which the fallback looks up: a text that spells one out (``<0x41>``) can
get other ids than SentencePiece gives, and its ``parity`` is false.

A null text gives null ids and null checks; an empty text gives no ids.  ``round_trip`` compares
the decoded text with the text the model's normaliser leaves.
"""

from __future__ import annotations

import ctypes
import gc
import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricfold.llm.text_bytes import slices

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
CACHED_WORDS = 500_000      # words whose ids a task keeps
KEPT_WORDS = 250_000        # most of them that wait in a worker for its next task
GROUP = 256                 # new words per call
PIECE_BYTES = 1 << 20       # text that is encoded at once, about
_WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
SCHEMA = ("doc_id long, ids array<int>, n_ids long, n_bytes long, round_trip boolean, parity boolean")


def model_path(name: str = "piece_bpe_32k.model") -> str:
    """The path of a public model file installed with the tokenizers' package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def parse(data: bytes):
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    model.ParseFromString(data)
    return model


def _merges(pieces: list[tuple[str, float]]) -> list[tuple[str, str]]:
    """BPE merges from piece scores: a pair merges if its join is a piece, best score first."""
    score = dict(pieces)
    found = []
    for rank, (piece, s) in enumerate(pieces):
        for i in range(1, len(piece)):
            left, right = piece[:i], piece[i:]
            if left in score and right in score:
                found.append((-s, rank, -score[left], i, left, right))
    return [(left, right) for *_, left, right in sorted(found)]


def build(data: bytes):
    """A ``tokenizers.Tokenizer`` equal to the SentencePiece model in ``data``."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    proto = parse(data)
    trainer, norm = proto.trainer_spec, proto.normalizer_spec
    pieces = [(p.piece, p.score, p.type) for p in proto.pieces]
    unk = next(i for i, p in enumerate(pieces) if p[2] == UNKNOWN)
    fallback = bool(trainer.byte_fallback)
    if trainer.model_type == 1:
        # Text never holds control and unused pieces.  A space or a noncharacter before them keeps the library from
        # finding them there: normalised text has no spaces where they are escaped.
        hidden = " " if norm.escape_whitespaces else "\U0010ffff"
        model = models.Unigram([(hidden + p if kind in (CONTROL, UNUSED) else p, s) for p, s, kind in pieces],
                               unk_id=unk, byte_fallback=fallback)
    elif trainer.model_type == 2:
        normal = [(p, s) for p, s, kind in pieces if kind in (NORMAL, USER)]
        model = models.BPE(vocab={p: i for i, (p, _, _) in enumerate(pieces)}, merges=_merges(normal),
                           unk_token=pieces[unk][0], fuse_unk=True, byte_fallback=fallback)
    else:
        raise ValueError(f"model type {trainer.model_type} is neither unigram nor BPE")
    tok = Tokenizer(model)
    steps = []
    if norm.precompiled_charsmap:
        steps.append(normalizers.Precompiled(norm.precompiled_charsmap))
    if norm.remove_extra_whitespaces:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip(left=True, right=True)]
    if norm.add_dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    if norm.escape_whitespaces:
        steps.append(normalizers.Replace(" ", MARK))
    tok.normalizer = normalizers.Sequence(steps)
    steps = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    if norm.add_dummy_prefix:
        steps.append(decoders.Strip(" ", 1, 0))
    tok.decoder = decoders.Sequence(steps)
    return tok


class Codec:
    """The rebuilt tokenizer and, for the parity check, the SentencePiece library's own."""

    def __init__(self, data: bytes):
        import sentencepiece
        from tokenizers import Tokenizer, decoders

        self.tok = build(data)
        self.own = sentencepiece.SentencePieceProcessor(model_proto=data)
        proto = parse(data)
        # If no piece has a mark after another character, no merge crosses the place before a
        # mark.  Normalised text may then be cut there, and each distinct word encoded once.
        self.cuts = proto.trainer_spec.model_type == 2 and proto.normalizer_spec.escape_whitespaces and not any(
            MARK in p.piece.lstrip(MARK) for p in proto.pieces if p.type in (NORMAL, USER))
        self.prefix = proto.normalizer_spec.add_dummy_prefix
        self.words = Tokenizer(self.tok.model)
        self.words.decoder = decoders.Sequence(
            [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()])
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)           # the known words' ids, one after another
        self.starts = np.zeros(1, np.int64)
        self.whole = np.zeros(0, bool)              # whether a word's ids decode to it
        self.same = np.zeros(0, bool)               # whether SentencePiece gives it the same ids

    def normalise(self, text: str) -> str:
        return self.tok.normalizer.normalize_str(text)

    def _learn(self, words: list[str]) -> None:
        groups = [words[i:i + GROUP] for i in range(0, len(words), GROUP)]
        coded = self.words.encode_batch(groups, is_pretokenized=True, add_special_tokens=False)
        ids = [np.array(e.ids, np.int32) for e in coded]
        sizes = np.concatenate([np.bincount(np.array(e.word_ids, np.int64), minlength=len(g)) for e, g in zip(coded, groups)])
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words))))
        self.flat = np.append(self.flat, np.concatenate(ids))
        self.starts = np.append(self.starts, self.starts[-1] + np.cumsum(sizes))
        back = self.words.decode_batch([i.tolist() for i in ids], skip_special_tokens=False)
        whole = np.ones(len(words), bool)
        for k, (group, text) in enumerate(zip(groups, back)):
            if text != "".join(group).replace(MARK, " "):          # then word by word
                for i, word in enumerate(group, k * GROUP):
                    at = self.known[word]
                    one = self.flat[self.starts[at]:self.starts[at + 1]].tolist()
                    whole[i] = self.words.decode(one, skip_special_tokens=False) == word.replace(MARK, " ")
        self.whole = np.append(self.whole, whole)
        texts = [w.replace(MARK, " ")[self.prefix:] for w in words]
        checks = self.own.encode(texts, num_threads=1)
        flat, ends = np.concatenate(ids), np.cumsum(sizes)
        mark = [self.own.piece_to_id(MARK)]          # a mark alone is no text of its own
        same = [(c if t else mark) == flat[e - n:e].tolist() for c, t, e, n in zip(checks, texts, ends, sizes)]
        self.same = np.append(self.same, same)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all texts in one array, their number per text, whether each text's ids
        decode to it again, and whether SentencePiece gives the same ids (the same normalised
        text, and the same ids to all its words)."""
        normalised = [self.normalise(t) for t in texts]
        if not self.cuts:
            ids = [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
            back = [d == self.plain(n) for d, n in zip(self.decode(ids), normalised)]
            same = [a == b for a, b in zip(ids, self.own.encode(texts, num_threads=1))]
            return (np.fromiter(chain.from_iterable(ids), np.int32), np.array([len(i) for i in ids], np.int64),
                    np.array(back, bool), np.array(same, bool))
        cut = [_WORD.findall(t) for t in normalised]
        distinct = set().union(*cut)
        if len(self.known) > CACHED_WORDS:
            self.forget()
        if new := list(distinct.difference(self.known)):
            self._learn(new)
        counts = np.array([len(words) for words in cut], np.int64)
        at = np.fromiter(map(self.known.__getitem__, chain.from_iterable(cut)), np.int64, int(counts.sum()))
        first, sizes = self.starts[at], self.starts[at + 1] - self.starts[at]
        begins = np.cumsum(sizes) - sizes
        ids = self.flat[np.arange(int(sizes.sum())) + np.repeat(first - begins, sizes)]
        row = np.repeat(np.arange(len(texts)), counts)
        count = lambda weights: np.bincount(row, weights=weights, minlength=len(texts))
        same = (count(~self.same[at]) == 0) & [self.own.normalize(t) == n for t, n in zip(texts, normalised)]
        return ids, count(sizes).astype(np.int64), count(~self.whole[at]) == 0, same

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.tok.decode_batch(ids, skip_special_tokens=False)

    def plain(self, normalised: str) -> str:
        """The text behind its normalised form."""
        text = normalised.replace(MARK, " ")
        return text[1:] if self.prefix and text[:1] == " " else text


@lru_cache(maxsize=2)
def codec(data: bytes) -> Codec:
    return Codec(data)


def _give_back() -> None:
    """Free memory goes back to the system.  Workers outlive their tasks, and the allocators would keep what the words
    of a task took."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):      # where the C library has it
        trim(0)


def _coded(own: Codec, rows: pa.RecordBatch) -> pa.RecordBatch:
    texts = rows.column(1).to_pylist()
    real = [t or "" for t in texts]
    null = pa.array([t is None for t in texts])
    flat, sizes, back, parity = own.encode(real)
    ends = np.cumsum(sizes)
    offsets = pa.array(np.concatenate(([0], ends)), pa.int32(), mask=np.append([t is None for t in texts], False))
    out = [
        pa.ListArray.from_arrays(offsets, pa.array(flat)),
        pc.if_else(null, None, pa.array(sizes)),
        pc.if_else(null, None, pa.array([len(t.encode()) for t in real], pa.int64())),
        pc.if_else(null, None, pa.array(back)),
        pc.if_else(null, None, pa.array(parity)),
    ]
    return pa.RecordBatch.from_arrays([rows.column(0), *out], [f.split()[0] for f in SCHEMA.split(", ")])


def _encoder(data: bytes, threads: int):
    def run(batches):
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true" if threads > 1 else "false")
        own = codec(data)
        gc.disable()        # nothing here makes reference cycles; scans of millions of lists cost much
        try:
            for batch in batches:
                for rows in slices(batch, "text", PIECE_BYTES):
                    yield _coded(own, rows)
                _give_back()
        finally:        # the worker goes on to other tasks
            gc.enable()
            if len(own.known) > KEPT_WORDS:
                own.forget()
            _give_back()
    return run


def encode(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text",
           threads: int = 2) -> DataFrame:
    """``doc_id``, ``ids``, their number, the text's bytes, and the two checks; no shuffle."""
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return read.mapInArrow(_encoder(model, threads), SCHEMA)


def decode_texts(ids: list[list[int]], model: bytes) -> list[str]:
    return codec(model).decode(ids)
