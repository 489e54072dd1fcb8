"""Licence scan: fuzzy search for short notices.

A notice of ``n`` characters may differ by ``k = n // EDIT_SHARE`` edits. Split into ``k + 1``
pieces, one piece must occur unchanged (pigeonhole), so an Aho-Corasick automaton over all
pieces finds every place that can match. Only there the ``regex`` library's bounded-error
matching verifies the notice and reports its span and edits.

Texts are normalised to words of lower-case letters, digits and non-ASCII characters joined by
one space; edits are counted in its UTF-8 bytes. Exact base phrases are counted by words.

Edge cases: null and empty texts give no words, no places, empty labels and score 0; repeated
rows give repeated results; notices and labels that tie are sorted by name.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tessera.llm.common import texts_of, with_columns

#: One edit is allowed for each so many characters of a notice.
EDIT_SHARE = 9

#: Characters of the grams that a stretch must share with a notice before it is searched.
GRAM = 3

#: Base phrases and labels (fixed values).
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Short notices as they stand in files, and the labels they give.
NOTICES = [
    ("Licensed under the Apache License, Version 2.0", "apache-2.0"),
    ("Released under the MIT License", "mit"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy", "mit"),
    ("This work is licensed under the GNU General Public License", "gpl"),
    ("GNU Lesser General Public License", "lgpl"),
    ("GNU Affero General Public License", "agpl"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted", "bsd"),
    ("subject to the terms of the Mozilla Public License", "mpl"),
    ("made available under the terms of the Eclipse Public License", "epl"),
    ("Permission to use, copy, modify, and distribute this software for any purpose", "isc"),
    ("This is free and unencumbered software released into the public domain", "unlicense"),
    ("waived all copyright and related or neighboring rights", "cc0"),
    ("Licensed under CC BY-NC 4.0", "cc-by-nc"),
    ("Creative Commons Attribution", "cc-by"),
    ("All rights reserved", "reserved"),
]

# Lower-case A-Z, keep digits and bytes from 0x80 on; all else separates words.
_KEEP = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_KEEP).split()


def normal(text: bytes) -> str:
    """Words joined by one space, one character for each byte."""
    return b" ".join(words_of(text)).decode("latin-1")


def pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """``edits + 1`` pieces that cover the notice, with their places."""
    cuts = [len(notice) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


class NoticeSearch:
    def __init__(self, notices=None, phrases=None, edit_share: int = EDIT_SHARE):
        self.phrases = PHRASES if phrases is None else phrases
        self.notices, self.patterns, seeds = [], {}, {}
        for text, label in NOTICES if notices is None else notices:
            t = normal(text.encode())
            k = len(t) // edit_share
            self.notices.append((t, label, k, [t[i:i + GRAM] for i in range(len(t) - GRAM + 1)]))
            for at, piece in pieces(t, k):
                seeds.setdefault(piece, []).append((len(self.notices) - 1, at))
        self.automaton = ahocorasick.Automaton()
        for piece, where in seeds.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def regions(self, text: str) -> dict[int, list[list[int]]]:
        """For each notice, the merged stretches of the text that can hold it."""
        found: dict[int, list[list[int]]] = {}
        for last, (size, where) in self.automaton.iter(text):
            for notice, at in where:
                t, _, k, _ = self.notices[notice]
                a = max(0, last + 1 - size - at - k)
                b = min(len(text), a + len(t) + 2 * k + (k if a == 0 else 0))
                found.setdefault(notice, []).append([a, b])
        for spans in found.values():
            spans.sort()
            merged = [spans[0]]
            for a, b in spans[1:]:
                if a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            spans[:] = merged
        return found

    def pattern(self, notice: int, edits: int) -> regex.Pattern:
        if (notice, edits) not in self.patterns:
            t = regex.escape(self.notices[notice][0], literal_spaces=True)
            self.patterns[notice, edits] = regex.compile(f"(?e)(?:{t}){{e<={edits}}}" if edits else t)
        return self.patterns[notice, edits]

    def fuzzy(self, text: str) -> list[tuple[int, int, str, int, float]]:
        """(start, end, label, edits, closeness) of every verified notice in a normalised text.

        Fewer edits are tried first; what they match is cut out of the stretch. An edit spoils
        at most ``GRAM`` of a notice's grams, so a stretch with fewer of them isn't searched."""
        out = []
        for notice, spans in self.regions(text).items():
            t, label, k, grams = self.notices[notice]
            for edits in range(k + 1):
                left = []
                for a, b in spans:
                    stretch = text[a:b]
                    there = sum(g in stretch for g in grams)
                    if there < len(grams) - k * GRAM:
                        continue
                    if there >= len(grams) - edits * GRAM:
                        for m in self.pattern(notice, edits).finditer(text, a, b):
                            e = sum(m.fuzzy_counts)
                            out.append((m.start(), m.end(), label, e, 1 - e / len(t)))
                            left.append((a, m.start()))
                            a = m.end()
                    left.append((a, b))
                spans = [s for s in left if s[1] - s[0] >= len(t) - k]
        return sorted(out)

    def base(self, text: str) -> list[tuple[int, str]]:
        """(first word's number, label) of every exact phrase."""
        out, padded = [], f" {text} "
        for phrase, label in self.phrases.items():
            at = padded.find(f" {phrase} ")
            word, seen = 0, 0
            while at >= 0:
                word += padded.count(" ", seen, at + 1)
                seen = at + 1
                out.append((word - 1, label))
                at = padded.find(f" {phrase} ", at + 1)
        return out

    def scan(self, text: bytes) -> tuple:
        words = words_of(text)
        t = b" ".join(words).decode("latin-1")
        base, fuzzy = self.base(t), self.fuzzy(t)
        starts = [w for w, _ in base]
        base_labels = {x for _, x in base}
        labels = base_labels | {x[2] for x in fuzzy}
        at, n, places = 0, 0, []
        for a, b, label, e, _ in fuzzy:  # character places to word numbers, in one walk
            n, at = n + t.count(" ", at, a), a
            places.append(f"{label}:{n}:{n + t.count(' ', a, b) + 1}:{e}")
        return (len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(base_labels)),
                ",".join(sorted(labels)), max([1.0] * bool(base) + [x[4] for x in fuzzy], default=0.0), ",".join(places))


_FIELDS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, notices string"


def scan_documents(docs: DataFrame, text: str = "text", notices=None, edit_share: int = EDIT_SHARE) -> DataFrame:
    """``docs`` with the counts, labels and score of each text, and ``notices``: the verified
    ones as label:first word:end word:edits."""
    def make():
        search = NoticeSearch(notices, edit_share=edit_share)

        def run(batch: pa.RecordBatch) -> dict:
            rows = [search.scan(t) for t in texts_of(batch, text)]
            return dict(zip([f.split()[0] for f in _FIELDS.split(", ")], map(list, zip(*rows))))
        return run

    return with_columns(docs, _FIELDS, make)
