"""License scans with a generalised suffix automaton.

The automaton holds every substring (in words) of the licence templates below.  Each text is
streamed through it once: after every word the state gives the longest template substring
that ends there (the matching statistics).  Matches of ``MIN_MATCH`` or more words that
cannot be extended are chained per template while both text and template advance, and a
chain's covered share of the template decides the template's label.  Words such as "licensed under the" or "permission
is hereby granted" open several licences, so a chain counts only with an identifying match: one whose state ends in
templates of a single label.  In a notice of up to ``SHORT`` words that match must reach the notice's last
word (its version, or "license"); in a longer text it must have ``IDENTIFYING`` words.  The score is the largest share of
a chain that earns its label, else 0.

Lower-casing touches A-Z only; words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.  A null or empty text
has no words, no labels (empty strings) and score 0.  The automaton's size depends on the
templates alone; tasks hold one text at a time.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_MATCH = 3          # words of a match that may enter a chain
MAX_GAP = 8            # words that may be skipped between chained matches
MIN_COVERED = 0.6      # share of a template's words that earns its label
SHORT = 20             # words of a notice that must be matched through its end
IDENTIFYING = 6        # words of a match that identify a longer text

# Labels and base phrases.
BASE = (("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved"))
# Public licence notices and texts, with SPDX-like labels.
TEXTS = (
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software "
            "and associated documentation files the software to deal in the software without restriction including "
            "without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the "
            "software and to permit persons to whom the software is furnished to do so"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software "
            "and associated documentation files"),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in "
                   "compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
            "provided that the following conditions are met"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the "
            "following disclaimer redistributions in binary form must reproduce the above copyright notice this list of "
            "conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                     "promote products derived from this software without specific prior written permission"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without "
            "fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
# Label, licence name and versions of the notices that differ in these alone.
GNU = (("gpl-2.0", "general", "2"), ("gpl-3.0", "general", "3"), ("lgpl", "library general", "2"),
       ("lgpl", "lesser general", "2 1"), ("lgpl", "lesser general", "3"), ("agpl", "affero general", "3"))
COMMONS = (("by", "attribution"), ("by-sa", "attribution sharealike"), ("by-nc", "attribution noncommercial"),
           ("by-nd", "attribution noderivatives"), ("by-nc-sa", "attribution noncommercial sharealike"),
           ("by-nc-nd", "attribution noncommercial noderivatives"))
SPDX = (("mit", "mit"), ("apache-2.0", "apache 2 0"), ("bsd", "bsd 2 clause"), ("bsd-3-clause", "bsd 3 clause"),
        ("gpl-2.0", "gpl 2 0"), ("gpl-3.0", "gpl 3 0"), ("lgpl", "lgpl 2 1"), ("lgpl", "lgpl 3 0"), ("agpl", "agpl 3 0"),
        ("mpl-2.0", "mpl 2 0"), ("isc", "isc"), ("unlicense", "unlicense"))


def notices() -> tuple[tuple[str, str], ...]:
    """All templates: the texts, and the notices of licence families by name and version."""
    out = list(TEXTS)
    for form in ("version 2 0", "v 2 0", "2 0"):
        out.append(("apache-2.0", f"licensed under the apache license {form}"))
    for label, name, version in GNU:
        licence = f"gnu {name} public license"
        out.append((label, f"redistribute it and or modify it under the terms of the {licence} as published by the free "
                           f"software foundation either version {version} of the license or at your option any later version"))
        for form in (f"version {version}", f"v{version}", f"v {version}"):
            out.append((label, f"this work is licensed under the {licence} {form}"))
    for short, name in COMMONS:
        out.append((f"cc-{short}-4.0", f"licensed under cc {short.replace('-', ' ')} 4 0"))
        out.append((f"cc-{short}-4.0", f"creative commons {name} 4 0 international"))
    return (*out, *((label, f"spdx license identifier {name}") for label, name in SPDX))


TEMPLATES = notices()
SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, "
          "base_labels string, labels string, score double, spans string")
_WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


class Automaton:
    """Suffix automaton of several word sequences.

    ``ends[state]`` lists (sequence, end) of the state's longest substring; a state also
    stands for those of the states that link to it.
    """

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        self.ends: list[set[tuple[int, int]]] = [set()]
        for k, sequence in enumerate(sequences):
            last = 0
            for i, word in enumerate(sequence):
                last = self._extend(last, word)
                self.ends[last].add((k, i + 1))
        for state in sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.ends[self.link[state]] |= self.ends[state]

    def _state(self, size: int, nxt: dict, link: int) -> int:
        self.next.append(nxt)
        self.size.append(size)
        self.link.append(link)
        self.ends.append(set())
        return len(self.size) - 1

    def _split(self, p: int, q: int, word: int) -> int:
        clone = self._state(self.size[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word: int) -> int:
        q = self.next[last].get(word)
        if q is not None:                     # an earlier sequence already has this substring
            return q if self.size[q] == self.size[last] + 1 else self._split(last, q, word)
        new, p = self._state(self.size[last] + 1, {}, 0), last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[new] = q if self.size[q] == self.size[p] + 1 else self._split(p, q, word)
        return new

    def statistics(self, ids: list[int | None]):
        """(position after the word, state, match length) for every word that matches."""
        state = length = 0
        nxt, link, size = self.next, self.link, self.size
        for i, word in enumerate(ids, 1):
            if word is None:
                state = length = 0
                continue
            while state and word not in nxt[state]:
                state = link[state]
                length = size[state]
            to = nxt[state].get(word)
            if to is None:
                state = length = 0
                continue
            state, length = to, length + 1
            yield i, state, length


class Scanner:
    """The automaton of ``templates`` and ``base`` phrases, ready to scan texts."""

    def __init__(self, templates=TEMPLATES, base=BASE):
        words = [phrase.encode().split() for _, phrase in (*base, *templates)]
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for ws in words for w in ws}))}
        self.automaton = Automaton([[self.vocabulary[w] for w in ws] for ws in words])
        self.labels = [label for label, _ in (*base, *templates)]
        self.sizes = [len(ws) for ws in words]
        self.n_base = len(base)
        # The label of the states that only one label's templates (and no other's) end in.
        self.only: list[str | None] = []
        for ends in self.automaton.ends:
            found = {self.labels[k] for k, _ in ends if k >= self.n_base}
            self.only.append(found.pop() if len(found) == 1 else None)
        # The phrase sequences that end in a state: their own last state is the state or one
        # that its links lead to.
        self.phrases: list[list[int]] = []
        own = {}
        for k in range(self.n_base):
            state = 0
            for w in words[k]:
                state = self.automaton.next[state][self.vocabulary[w]]
            own.setdefault(state, []).append(k)
        for state in range(len(self.automaton.size)):
            found, s = [], state
            while s > 0:
                found += own.get(s, [])
                s = self.automaton.link[s]
            self.phrases.append(found)

    def scan(self, text: bytes):
        words = _WORDS.findall(text.lower())
        ids = list(map(self.vocabulary.get, words))
        places, base_labels, matches, held = [], set(), [], None
        for end, state, length in self.automaton.statistics(ids):
            for k in self.phrases[state]:
                if length >= self.sizes[k]:
                    places.append(end - self.sizes[k])
                    base_labels.add(self.labels[k])
            if length >= MIN_MATCH:
                if held and (held[0] + 1, held[2] + 1) != (end, length):
                    matches.append(held)          # the match could not be extended
                held = (end, state, length)
        if held:
            matches.append(held)
        spans = [s for s in self.chain(matches) if s[3] >= MIN_COVERED]
        labels = base_labels | {self.labels[k] for k, *_ in spans}
        score = max([share for *_, share in spans], default=0.0)
        return (len(words), len(places), min(places, default=None), max(places, default=None),
                ",".join(sorted(base_labels)), ",".join(sorted(labels)), score,
                ";".join(f"{self.labels[k]}:{a}-{b}:{share:.3f}" for k, a, b, share in spans))

    def identifies(self, k: int, state: int, length: int, at: int) -> bool:
        """Whether a match that ends at word ``at`` of template ``k`` belongs to its label alone and is telling enough."""
        if self.only[state] != self.labels[k]:
            return False
        return at == self.sizes[k] if self.sizes[k] <= SHORT else length >= IDENTIFYING

    def chain(self, matches) -> list[tuple[int, int, int, float]]:
        """(template, first word, end word, covered share) of every chain of matches that has an identifying one."""
        open_chains: dict[int, tuple[int, int, int, int, bool]] = {}
        done = []

        def close(k):
            first, end, _, covered, identified = open_chains.pop(k)
            if identified:
                done.append((k, first, end, covered / self.sizes[k]))

        for end, state, length in matches:
            best: dict[int, int] = {}
            for k, at in sorted(self.automaton.ends[state]):
                if k >= self.n_base and at >= length:
                    held = open_chains.get(k)
                    if k not in best or (held and best[k] <= held[2] < at):
                        best[k] = at
            for k, at in best.items():
                held, telling = open_chains.get(k), self.identifies(k, state, length, at)
                if held and end - length <= held[1] + MAX_GAP and at > held[2]:
                    gained = min(length, at - held[2], end - held[1])
                    open_chains[k] = (held[0], end, at, held[3] + max(0, gained), held[4] or telling)
                else:
                    if held:
                        close(k)
                    open_chains[k] = (end - length, end, at, length, telling)
        for k in list(open_chains):
            close(k)
        return done


def _scan_batches(batches):
    scanner = Scanner()
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.string()]
    for batch in batches:
        rows = [scanner.scan(t.as_py() or b"") for t in batch.column(1)]
        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with its base places, labels, score and labelled spans."""
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.encode(text_col, "UTF-8").alias("text"))
    return read.mapInArrow(_scan_batches, SCHEMA)
