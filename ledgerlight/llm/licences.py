"""Licence scans (operator 5): matching statistics against a generalised suffix automaton of licence tokens.

Templates are the whole texts of public licences (folder licence_texts) and the notices by which files refer to them. All
their words are fed into one suffix automaton. A text's words are streamed through it; after each word the state
and the match length say how long a suffix of the text read so far stands in some template. Long matches are chained,
in text and template order, into spans that cover a template; a span that covers enough of it gives the template's label.
Base phrases are templates too: a phrase ends wherever its state lies on the suffix path of the current state and the
match is at least as long, so every place is found whatever the longer match around it is.

Words outside the templates' vocabulary end every match, so only runs of known words of at least the shortest phrase are
streamed; the rest of a text is passed over by array operations.
"""

from __future__ import annotations

import pkgutil
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, in_chunks, table

#: Phrases with the label that each place of one gives.
BASE = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]

#: Notices of public licences, and the labels that their spans give.
NOTICES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-sa", "creative commons attribution sharealike 4 0 international license"),
    ("cc-by", "licensed under cc by 4 0"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license"),
    ("gpl-2", "licensed under the gnu general public license version 2"),
    ("gpl-2", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("agpl-3", "licensed under the gnu affero general public license version 3"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
]

#: Licences whose whole texts are templates; a file's name is its label.
TEXTS = "apache-2 bsd-2 bsd-3 cc0 gpl-2 gpl-3 isc lgpl-2.1 mit mpl-2 unlicense zlib".split()

#: Least match to take part in a chain, greatest gap (words) within a chain, share of a template that gives its label.
LEAST_MATCH, MOST_GAP, LEAST_COVER = 3, 3, 0.75

#: ASCII that is no word character becomes a space, A-Z lower case; bytes of other characters stay.
_TABLE = bytes(b if b >= 128 or chr(b).isalnum() and not 65 <= b <= 90 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def split_words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


@lru_cache(1)
def production_templates() -> tuple[tuple[str, str], ...]:
    """(label, words) of all notices and whole texts; read on the driver and sent along."""
    read = lambda name: b" ".join(split_words(pkgutil.get_data(__package__, f"licence_texts/{name}.txt").decode())).decode()
    return (*NOTICES, *((name, read(name)) for name in TEXTS))


class Automaton:
    """Suffix automaton of several token sequences, with the phrases that end in each state."""

    def __init__(self, sequences: list[list[int]], least: int = 1):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for seq in sequences:
            last = 0
            for token in seq:
                last = self._extend(last, token)
        # places: for each state that can hold a match, the ends of its strings in each sequence, ascending
        self.places: list[dict[int, list[int]]] = [{} for _ in self.next]
        for s, seq in enumerate(sequences):
            at = 0
            for i, token in enumerate(seq):
                at = self.next[at][token]
                v = at
                while v > 0 and self.length[v] >= least:
                    self.places[v].setdefault(s, []).append(i + 1)
                    v = self.link[v]

    def _extend(self, last: int, token: int) -> int:
        if token in self.next[last]:
            q = self.next[last][token]
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, q, token)
        cur = self._state(self.length[last] + 1)
        p = last
        while p >= 0 and token not in self.next[p]:
            self.next[p][token] = cur
            p = self.link[p]
        if p < 0:
            self.link[cur] = 0
        else:
            q = self.next[p][token]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, token)
        return cur

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _clone(self, p: int, q: int, token: int) -> int:
        new = self._state(self.length[p] + 1)
        self.next[new] = dict(self.next[q])
        self.link[new] = self.link[q]
        self.link[q] = new
        while p >= 0 and self.next[p].get(token) == q:
            self.next[p][token] = new
            p = self.link[p]
        return new

    def statistics(self, tokens: list[int]) -> Iterator[tuple[int, int]]:
        """(state, match length) after each token."""
        state = n = 0
        step, link, length = self.next, self.link, self.length
        for t in tokens:
            while state and t not in step[state]:
                state = link[state]
                n = length[state]
            if t in step[state]:
                state = step[state][t]
                n += 1
            yield state, n


class Scanner:
    """Automaton over base phrases and templates; base phrases come first."""

    def __init__(self, base=BASE, templates=None):
        templates = production_templates() if templates is None else templates
        self.base, self.templates = base, templates
        sequences = [x.encode().split() for x, _ in base] + [x.encode().split() for _, x in templates]
        self.vocabulary = {w: i + 1 for i, w in enumerate(dict.fromkeys(w for s in sequences for w in s))}
        self.sizes = [len(s) for s in sequences]
        coded = [[self.vocabulary[w] for w in s] for s in sequences]
        self.auto = Automaton(coded, LEAST_MATCH)
        self.shortest = min(min(self.sizes[: len(base)], default=LEAST_MATCH), LEAST_MATCH)
        # phrases that are suffixes of a state's strings: those whose own state is on its suffix path
        own: dict[int, list[int]] = {}
        for p in range(len(base)):
            at = 0
            for t in coded[p]:
                at = self.auto.next[at][t]
            own.setdefault(at, []).append(p)
        self.ending: list[list[int]] = [[] for _ in self.auto.next]
        for v in sorted(range(1, len(self.auto.next)), key=self.auto.length.__getitem__):
            self.ending[v] = own.get(v, []) + self.ending[self.auto.link[v]]

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], list[tuple[int, int, int, float]]]:
        """Base places (start, phrase), and chained spans (template, first word, end word, share covered)."""
        known = self.vocabulary.get
        codes = np.fromiter((known(w, 0) for w in words), np.int32, len(words))
        hit = np.flatnonzero(codes)
        if len(hit) < self.shortest:
            return [], []
        runs = np.flatnonzero(np.diff(hit) != 1) + 1
        starts, ends = hit[np.r_[0, runs]], hit[np.r_[runs - 1, len(hit) - 1]] + 1
        long = ends - starts >= self.shortest
        places, matches = [], []
        for a, b in zip(starts[long].tolist(), ends[long].tolist()):
            before: tuple[int, int, int] | None = None
            for i, (state, n) in enumerate(self.auto.statistics(codes[a:b].tolist()), a + 1):
                for p in self.ending[state]:
                    if n >= self.sizes[p]:
                        places.append((i - self.sizes[p], p))
                if before and n <= before[1] and before[1] >= LEAST_MATCH:  # the match before could not be extended
                    matches.append(before)
                before = (i, n, state)
            if before and before[1] >= LEAST_MATCH:
                matches.append(before)
        return places, self._chain(matches)

    def _chain(self, matches: list[tuple[int, int, int]]) -> list[tuple[int, int, int, float]]:
        """Chains of matches, (template, first word, end word, share), that don't overlap.

        In each template on its own: a match that starts at most MOST_GAP words behind the open chain's end continues it if
        the first of its places that ends behind the chain's place starts at most MOST_GAP words behind it in the template
        as well. A match in reach that doesn't fit and is no longer than what the chain covers is passed over; any other
        closes the chain and opens a new one at its first place. A template's words count once. Of chains that overlap in the text, the one that covers
        most words of its template stays, of equals the greater share, the earlier, the first template. Time: matches by
        templates that hold them, and a sort of the chains.
        """
        open_: dict[int, list[int]] = {}  # template -> [first word, end word, template end, words covered]
        spans = []
        skip = len(self.base)

        def close(t: int) -> None:
            first, end, _, got = open_.pop(t)
            spans.append((got, t - skip, first, end))

        for end, n, state in matches:
            for t, places in self.auto.places[state].items():
                if t < skip:
                    continue
                if t in open_:
                    first, last, upto, got = open_[t]
                    if end - n <= last + MOST_GAP:
                        k = bisect_right(places, upto)
                        if k < len(places) and places[k] - n <= upto + MOST_GAP:
                            open_[t] = [first, end, places[k], got + min(n, places[k] - upto)]
                            continue
                        if n <= got:
                            continue
                    close(t)
                open_[t] = [end - n, end, places[0], n]
        for t in list(open_):
            close(t)
        spans.sort(key=lambda x: (-x[0], -x[0] / self.sizes[x[1] + skip], x[2], x[1]))
        starts: list[int] = []  # of the chains that stay, in text order, and the chains
        kept: list[tuple[int, int, int, float]] = []
        for got, t, first, end in spans:
            k = bisect_left(starts, first)
            if (k == 0 or kept[k - 1][2] <= first) and (k == len(kept) or end <= starts[k]):
                starts.insert(k, first)
                kept.insert(k, (t, first, end, got / self.sizes[t + skip]))
        return kept


@lru_cache(2)
def _scanner(templates: tuple[tuple[str, str], ...]) -> Scanner:
    return Scanner(templates=templates)


def scan_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans for every row.

    score: greatest share of a template that a chained span covers, 1 where a base phrase stands; 0 to 1. spans: template
    spans that give a label (label, first word, end word, share). Null text is empty; texts without a place have null
    first_word and last_word and empty labels; repeated rows are scanned row by row; extra columns are ignored; an empty
    table gives no rows. Very long and repetitive texts take time in proportion to their words. Memory: one slice of texts,
    and the words and chains of one.
    """
    templates = production_templates()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(templates)
        names = [label for _, label in scanner.base]
        for batch in in_chunks(batches, "text"):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = split_words(text) if text else []
                places, spans = scanner.scan(words)
                good = [(scanner.templates[t][0], a, b, share) for t, a, b, share in spans if share >= LEAST_COVER]
                base = {names[p] for _, p in places}
                rows.append(
                    {
                        "doc_id": doc_id,
                        "n_words": len(words),
                        "n_base": len(places),
                        "first_word": min((s for s, _ in places), default=None),
                        "last_word": max((s for s, _ in places), default=None),
                        "base_labels": ",".join(sorted(base)),
                        "labels": ",".join(sorted(base | {x[0] for x in good})),
                        "score": 1.0 if base else min(1.0, max((x[3] for x in spans), default=0.0)),
                        "spans": [{"label": x[0], "first": x[1], "end": x[2], "share": x[3]} for x in good],
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, _SCHEMA)


_SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label:string,first:long,end:long,share:double>>"
_ARROW = pa.schema(
    [("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("n_words", "n_base", "first_word", "last_word")], ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
     ("spans", pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64()), ("share", pa.float64())])))]
)


def op5_licences(spark, sf_dir: str) -> DataFrame:
    return scan_documents(table(spark, sf_dir, "documents")).drop("spans")


QUERIES = {"op5_licences": op5_licences}
ORACLE_SQL: dict[str, str] = {}
