"""Licence scan with a generalised suffix automaton of licence tokens.

The automaton is built once per task over the words of all templates.  A text's
words are streamed through it, giving matching statistics: for every position the
longest run of words that ends there and occurs in some template.  From these come

* the base phrases: a place is where the current match has a whole phrase as suffix;
* template labels: maximal matches of at least ``min_match`` words are chained in
  the order of a template, with gaps of at most ``max_gap`` words; a label is
  given when the chained spans cover at least ``min_cover`` of the template.

Words outside the licence vocabulary end every match, so only runs of vocabulary
words are streamed.

Defined cases: a null text counts as empty (no words, no labels, score 0);
repeated rows each get a row; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Base phrases (words) and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Notices that common licences ask to be kept, and their labels.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
            "and associated documentation files, to deal in the Software without restriction"),
    ("apache-2", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance "
                 "with the License. You may obtain a copy of the License at"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the "
            "GNU General Public License as published by the Free Software Foundation"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
]

MIN_MATCH, MAX_GAP, MIN_COVER = 4, 20, 0.6

#: Words over UTF-8 bytes: digits, a-z after lower-casing A-Z, and every non-ASCII character.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode("utf-8").lower())


class LicenceAutomaton:
    """Generalised suffix automaton over the words of ``phrases`` and ``templates``."""

    def __init__(self, phrases: dict[str, str] | None = None, templates=None):
        phrases = BASE_PHRASES if phrases is None else phrases
        templates = TEMPLATES if templates is None else templates
        self.texts = [(label, words_of(t), True) for t, label in phrases.items()]
        self.texts += [(label, words_of(t), False) for label, t in templates]
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.ends = [-1], [0], [[]]     # ends: (template, last word) of the state's strings
        finals = []
        for k, (_, words, _) in enumerate(self.texts):
            last = 0
            for at, w in enumerate(words):
                last = self._extend(last, self.vocab.setdefault(w, len(self.vocab)))
                self.ends[last].append((k, at))
            finals.append(last)
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            self.ends[self.link[s]] += [e for e in self.ends[s] if e not in self.ends[self.link[s]]]
        # the base phrases that are a suffix of a state's longest string
        self.base = [[] for _ in self.next]
        at_final = {}
        for k, (_, words, is_base) in enumerate(self.texts):
            if is_base and words:
                at_final.setdefault(finals[k], []).append((k, len(words)))
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.base[s] = at_final.get(s, []) + self.base[self.link[s]]

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._split(last, word, known)
        new = self._state(self.length[last] + 1)
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at < 0:
            self.link[new] = 0
        else:
            target = self.next[at][word]
            if self.length[target] != self.length[at] + 1:
                target = self._split(at, word, target)
            self.link[new] = target
        return new

    def _split(self, at: int, word: int, target: int) -> int:
        copy = self._state(self.length[at] + 1)
        self.next[copy] = dict(self.next[target])
        self.link[copy] = self.link[target]
        self.link[target] = copy
        while at >= 0 and self.next[at].get(word) == target:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        self.ends.append([])
        return len(self.next) - 1

    def stream(self, ids: list[int]):
        """(place, state, match length) after each word of a run of vocabulary words."""
        state = matched = 0
        for place, word in enumerate(ids):
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                matched += 1
            yield place, state, matched

    def scan(self, words: list[bytes], min_match: int = MIN_MATCH, max_gap: int = MAX_GAP,
             min_cover: float = MIN_COVER) -> dict:
        places, base_labels, matches = [], set(), []
        get = self.vocab.get
        run: list[int] = []
        shortest = min([len(w) for _, w, is_base in self.texts if is_base and w] + [min_match])
        for at, w in enumerate(words + [b""]):
            word = get(w)
            if word is not None:
                run.append(word)
                continue
            if len(run) >= shortest:
                first, best = at - len(run), (-1, 0, 0)
                for place, state, matched in self.stream(run):
                    for k, n in self.base[state]:
                        if n <= matched:
                            places.append(first + place - n + 1)
                            base_labels.add(self.texts[k][0])
                    if matched <= best[2] and best[2] >= min_match:
                        matches.append((first + best[0], best[1], best[2]))
                    best = (place, state, matched)
                if best[2] >= min_match:
                    matches.append((first + best[0], best[1], best[2]))
            if run:
                run = []
        score, labels = (1.0 if places else 0.0), set(base_labels)
        for k, cover in self._chains(matches, max_gap).items():
            score = max(score, cover)
            if cover >= min_cover:
                labels.add(self.texts[k][0])
        return {"n_words": len(words), "n_base": len(places),
                "first_word": min(places, default=None), "last_word": max(places, default=None),
                "base_labels": ",".join(sorted(base_labels)), "labels": ",".join(sorted(labels)),
                "score": float(score)}

    def _chains(self, matches, max_gap: int) -> dict[int, float]:
        """Best cover of each template by a chain of matches in its order.

        For every match (they come by their end in the text) the best chain that ends with
        it: the most words of an earlier match that ends before it in text and template,
        at most ``max_gap`` words away, and its own."""
        recent: dict[int, list] = {}                       # (text end, template end, words covered)
        cover: dict[int, float] = {}
        for end, state, n in matches:
            for k, last in self.ends[state]:
                if self.texts[k][2]:
                    continue
                start, begin = last - n + 1, end - n
                ends = recent[k] = [c for c in recent.get(k, ()) if c[0] >= begin - max_gap]
                best = n + max((c[2] for c in ends if c[0] <= begin and c[1] < start), default=0)
                ends.append((end, last, best))
                cover[k] = max(cover.get(k, 0.0), best / len(self.texts[k][1]))
        return cover


FIELDS = [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
          ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())]


def license_scan(docs: DataFrame, phrases: dict[str, str] | None = None, templates=None,
                 min_match: int = MIN_MATCH, max_gap: int = MAX_GAP, min_cover: float = MIN_COVER) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    def run(batches):
        automaton = LicenceAutomaton(phrases, templates)
        for b in batches:
            found = [automaton.scan(words_of(t.as_py()), min_match, max_gap, min_cover) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0)] + [pa.array([f[n] for f in found], kind) for n, kind in FIELDS],
                names=["doc_id"] + [n for n, _ in FIELDS])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, n_base long, "
             "first_word long, last_word long, base_labels string, labels string, score double")
