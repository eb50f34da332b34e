"""Licence notices in text: exact phrases of words, and short notices with a few typing errors.

The fuzzy search splits each notice of at most ``e`` errors into ``e + 3`` pieces: a place with no more errors
holds three pieces unchanged (pigeonhole), shifted against each other by no more than the errors. One
automaton finds all pieces in a text; where three of a notice agree, the bounded-error matching of the ``regex``
library verifies the notice within a window of its length and gives its span and its number of edits.

Each text is handled whole and alone, in Arrow batches, so nothing is shuffled.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.common import ship, with_fields

# Phrases whose words must stand consecutively, with their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

# Short notices for the fuzzy search: text in lower case, label, most errors, and the words that tell the
# licence from its neighbours, which must stand unchanged.
NOTICES = (
    ("released under the mit license", "mit", 3, "mit"),
    ("licensed under the mit license", "mit", 3, "mit"),
    ("permission is hereby granted, free of charge, to any person obtaining a copy", "mit", 6, ""),
    ("spdx-license-identifier: mit", "mit", 2, "mit"),
    ("licensed under the apache license, version 2.0", "apache-2", 4, "apache"),
    ("http://www.apache.org/licenses/license-2.0", "apache-2", 3, "apache"),
    ("spdx-license-identifier: apache-2.0", "apache-2", 2, "apache-2.0"),
    ("licensed under cc by 4.0", "cc-by", 1, "by"),
    ("licensed under cc by-sa 4.0", "cc-by-sa", 2, "by-sa"),
    ("licensed under cc by-nc 4.0", "cc-by-nc", 2, "by-nc"),
    ("licensed under cc by-nd 4.0", "cc-by-nd", 2, "by-nd"),
    ("licensed under cc by-nc-sa 4.0", "cc-by-nc-sa", 2, "by-nc-sa"),
    ("licensed under cc by-nc-nd 4.0", "cc-by-nc-nd", 2, "by-nc-nd"),
    ("creative commons attribution 4.0 international", "cc-by", 4, "attribution"),
    ("creative commons attribution-sharealike", "cc-by-sa", 4, "sharealike"),
    ("creative commons attribution-noncommercial", "cc-by-nc", 4, "noncommercial"),
    ("creative commons attribution-noderivatives", "cc-by-nd", 4, "noderivatives"),
    ("creative commons attribution-noncommercial-sharealike", "cc-by-nc-sa", 4, "noncommercial-sharealike"),
    ("creative commons attribution-noncommercial-noderivatives", "cc-by-nc-nd", 4, "noncommercial-noderivatives"),
    ("creative commons zero v1.0 universal", "cc0", 3, "zero"),
    ("cc0 1.0 universal", "cc0", 1, "cc0"),
    ("licensed under the gnu general public license, version 2", "gpl-2", 2, "2"),
    ("licensed under the gnu general public license, version 3", "gpl-3", 2, "3"),
    ("spdx-license-identifier: gpl-2.0", "gpl-2", 2, "gpl-2.0"),
    ("spdx-license-identifier: gpl-3.0", "gpl-3", 2, "gpl-3.0"),
    ("gnu lesser general public license", "lgpl", 3, "lesser"),
    ("spdx-license-identifier: lgpl-", "lgpl", 2, ""),
    ("gnu affero general public license", "agpl", 3, "affero"),
    ("spdx-license-identifier: agpl-", "agpl", 2, ""),
    ("mozilla public license, version 2.0", "mpl-2", 3, "mozilla"),
    ("spdx-license-identifier: mpl-2.0", "mpl-2", 2, "mpl-2.0"),
    ("eclipse public license, version 1.0", "epl-1", 3, "1.0"),
    ("eclipse public license, version 2.0", "epl-2", 3, "2.0"),
    ("eclipse public license v2.0", "epl-2", 2, "v2.0"),
    ("this is free and unencumbered software released into the public domain", "unlicense", 6, ""),
    ("redistribution and use in source and binary forms, with or without modification", "bsd", 6, ""),
    ("neither the name of the copyright holder nor the names of its contributors", "bsd-3-clause", 6, "neither"),
    ("licensed under the bsd 2-clause license", "bsd-2-clause", 3, "2-clause"),
    ("licensed under the bsd 3-clause license", "bsd-3-clause", 3, "3-clause"),
    ("spdx-license-identifier: bsd-2-clause", "bsd-2-clause", 2, "bsd-2-clause"),
    ("spdx-license-identifier: bsd-3-clause", "bsd-3-clause", 2, "bsd-3-clause"),
    ("permission to use, copy, modify, and/or distribute this software for any purpose", "isc", 6, ""),
    ("licensed under the isc license", "isc", 2, "isc"),
    ("boost software license - version 1.0", "bsl-1", 3, "boost"),
    ("licensed under the artistic license 2.0", "artistic-2", 3, "artistic"),
    ("open font license, version 1.1", "ofl-1.1", 2, "font"),
    ("all rights reserved", "all-rights-reserved", 1, "rights"),
)

AGREE = 3  # pieces of a notice that an occurrence holds unchanged
CORE = r"(?<!\w){}(?!\w|-(?:nc|nd|sa|non|no|share))"  # a whole word, and no part of a longer licence

IN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
WORD = re.compile(IN_WORD + "+")

FIELDS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
SPANS = "array<struct<label:string,start:int,end:int,edits:int>>"


@dataclass(frozen=True)
class Notice:
    label: str
    length: int
    errors: int
    text: str
    pattern: object
    core: object  # what must stand in a match


def pieces(text: str, parts: int) -> list[tuple[int, str]]:
    """Cut ``text`` into ``parts`` runs of nearly equal length, with their places."""
    cuts = [round(i * len(text) / parts) for i in range(parts + 1)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


@cache
def searcher(notices: tuple[tuple[str, str, int, str], ...]):
    """The notices, and one automaton over their pieces: piece -> (notice, place in it)."""
    known, found = [], {}
    for number, (text, label, errors, core) in enumerate(notices):
        if len(text) <= 4 * errors:
            raise ValueError(f"too many errors for {text!r}")
        body = regex.escape(text, special_only=True)
        pattern = regex.compile(f"(?:{body}){{e<={errors}}}", regex.BESTMATCH)
        known.append(Notice(label, len(text), errors, text, pattern, re.compile(CORE.format(re.escape(core)) if core else "")))
        for place, piece in pieces(text, errors + AGREE):
            found.setdefault(piece, []).append((number, place))
    automaton = ahocorasick.Automaton()
    for piece, places in found.items():
        automaton.add_word(piece, (len(piece), tuple(places)))
    automaton.make_automaton()
    return known, automaton


def windows(text: str, notices) -> dict[int, list[tuple[int, int]]]:
    """For each notice, the stretches of the text in which it may stand, each little longer than the notice."""
    known, automaton = searcher(notices)
    recent: dict[int, list[tuple[int, int]]] = {}  # of each notice: where it would begin, by which piece
    out: dict[int, list[list[int]]] = {}  # the least and the largest of such beginnings
    for last, (length, places) in automaton.iter(text):
        at = last + 1 - length
        for number, place in places:
            notice, begin = known[number], at - place
            near = [n for n in recent.get(number, ()) if n[0] + notice.length + notice.errors > at]
            near.append((begin, place))
            recent[number] = near
            if len(near) < AGREE:
                continue
            agreeing = [n for n in near if abs(n[0] - begin) <= notice.errors]
            if len({n[1] for n in agreeing}) < AGREE:
                continue
            spans = out.setdefault(number, [])
            if spans and max(spans[-1][1], begin) - min(spans[-1][0], begin) <= 2 * notice.errors:
                spans[-1] = [min(spans[-1][0], begin), max(spans[-1][1], begin)]
            else:
                spans.append([begin, begin])
    return {
        number: [(max(0, a - known[number].errors), b + known[number].length + known[number].errors) for a, b in spans]
        for number, spans in out.items()
    }


def best_matches(notice: Notice, text: str, start: int, end: int) -> Iterator[tuple[int, int, int]]:
    """Start, end and edits of the closest place of a notice in a window, then of those in what is left beside it."""
    todo, least = [(start, end)], max(1, notice.length - notice.errors)
    while todo:
        a, b = todo.pop()
        if b - a < least:
            continue
        exact = text.find(notice.text, a, b)
        if exact >= 0:  # nothing is closer
            found = exact, exact + notice.length, 0
        elif match := notice.pattern.search(text, a, b):
            found = match.start(), match.end(), sum(match.fuzzy_counts)
        else:
            continue
        if notice.core.search(text[found[0] : found[1]]):
            yield found
        todo += [(found[1], b), (a, found[0])]


def fuzzy_spans(text: str, notices=NOTICES) -> list[tuple[str, int, int, int]]:
    """(label, start, end, edits) of each notice found in a lower-case text, by start.

    Where notices overlap, those with the fewest edits are meant, and of those the longest: a notice for
    version 3 is not also one for version 2 with an error. The time grows with the text, however many
    notices it holds: searches are bounded, and only neighbours are compared.
    """
    known, _ = searcher(notices)
    found = set()
    for number, spans in windows(text, notices).items():
        notice = known[number]
        for start, end in spans:
            for a, b, edits in best_matches(notice, text, start, min(end, len(text))):
                found.add((a, b, notice.label, edits))
    return meant(sorted(found))


def meant(spans: list[tuple[int, int, str, int]]) -> list[tuple[str, int, int, int]]:
    """The spans (start, end, label, edits), in order, that no better one overlaps."""
    longest = max((end - start for start, end, _, _ in spans), default=0)
    starts = [s[0] for s in spans]
    out = []
    for start, end, label, edits in spans:
        near = spans[bisect_left(starts, start - longest) : bisect_left(starts, end)]
        rank = (edits, start - end)
        if not any((o[3], o[0] - o[1]) < rank and o[0] < end and start < o[1] for o in near):
            out.append((label, start, end, edits))
    return out


@cache
def phrase_patterns(phrases: tuple[tuple[str, str], ...]):
    """A pattern for each phrase: its words with anything but word characters between them."""
    return [
        (
            label,
            phrase.split()[-1],
            re.compile(rf"(?<!{IN_WORD})(?={f'{BETWEEN}+'.join(map(re.escape, phrase.split()))}(?!{IN_WORD}))"),
        )
        for phrase, label in phrases
    ]


def phrase_places(text: str, phrases=PHRASES) -> list[tuple[int, str]]:
    """(character, label) of each place of a phrase in a lower-case text."""
    return [
        (match.start(), label)
        for label, needed, pattern in phrase_patterns(phrases)
        if needed in text
        for match in pattern.finditer(text)
    ]


def scan_text(text: str | None, phrases=PHRASES, notices=NOTICES):
    """The fields of one text, and its fuzzy spans."""
    text = (text or "").encode().lower().decode()  # bytes: A-Z only
    n_words = sum(1 for _ in WORD.finditer(text))
    places = sorted(phrase_places(text, phrases))
    spans = fuzzy_spans(text, notices)
    first = last = None
    if places:
        first = sum(1 for _ in WORD.finditer(text, 0, places[0][0]))
        last = first + sum(1 for _ in WORD.finditer(text, places[0][0], places[-1][0]))
    base = {label for _, label in places}
    close = max((1 - edits / max(end - start, 1) for _, start, end, edits in spans), default=0.0)
    fields = (
        n_words,
        len(places),
        first,
        last,
        ",".join(sorted(base)),
        ",".join(sorted(base | {s[0] for s in spans})),
        1.0 if places else max(0.0, close),
    )
    return fields, spans


def scan(df: DataFrame, text: str = "text", phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """Append what a text says about its licence.

    ``n_words``; ``n_base``, ``first_word``, ``last_word`` and ``base_labels`` of the exact
    phrases; ``labels`` of phrases and fuzzy notices, distinct, sorted and comma-joined;
    ``score``: 1 for an exact phrase, else 1 less the share of edited characters of the closest
    notice, else 0; ``license_spans``: label, start, end and edits of the fuzzy notices.

    A null text counts as empty: no words, null places, empty labels, score 0. Rows are never
    dropped or joined, so repeated rows stay. Columns with a name of the output are replaced.
    """
    ship(df.sparkSession)
    phrases, notices = tuple(phrases), tuple(notices)
    names = [f.split()[0] for f in FIELDS.split(", ")]

    def scan_batches(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for value in texts:
                fields, spans = scan_text(value, phrases, notices)
                rows.append((*fields, [dict(zip(("label", "start", "end", "edits"), s, strict=True)) for s in spans]))
            out = pd.DataFrame(rows, columns=[*names, "license_spans"])
            for name in ("first_word", "last_word"):
                out[name] = out[name].astype("Int64")
            yield out

    scanned = F.pandas_udf(scan_batches, f"{FIELDS}, license_spans {SPANS}")
    return with_fields(df, scanned(F.col(text)), [*names, "license_spans"])
