"""License scan: exact base phrases, and a fuzzy search for short notices.

A notice with at most ``k`` errors, cut into ``k + 1`` pieces, has at least one
piece without an error (pigeonhole).  So exact seeds find every place where a
notice can stand; the ``regex`` library's bounded-error matching then verifies
a window around each place and reports the span.  Errors are allowed only beside
the words that tell licences apart: ``BSD`` is no misspelt ``MIT``.
"""

from __future__ import annotations

from dataclasses import dataclass

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakework.llm.common import arrow_column

#: Phrases of the base count and their labels.
BASE_PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))


@dataclass(frozen=True)
class Notice:
    """A short notice in normal form (lower case, words split by one space).

    Words between asterisks tell it from other notices and must stand as they are, but
    for ``missing`` letters in all, where no other notice's words lack letters of them.
    Each part beside them may have an error for every ``per`` characters.
    """

    label: str
    text: str
    per: int = 8
    missing: int = 0

    @property
    def parts(self) -> list[tuple[str, int | None]]:
        """(words, allowed errors), in order; null for words that must be exact."""
        found = [(x.strip(), None if i % 2 else 0) for i, x in enumerate(self.text.split("*"))]
        return [(x, k if k is None else round(len(x) / self.per)) for x, k in found if x]

    @property
    def plain(self) -> str:
        return " ".join(x for x, _ in self.parts)

    @property
    def errors(self) -> int:
        return sum(self.missing if k is None else k for _, k in self.parts)


#: Short forms of well-known notices.
NOTICES = (
    Notice("apache-2.0", "under the *apache* license *version 2 0*"),
    Notice("apache-2.0", "under the *apache* license *2 0*"),
    Notice("apache-2.0", "*apache* license *version 2 0*"),
    Notice("apache-2.0", "*apache* license *2 0*"),
    Notice("mit", "under the *mit* license"),
    Notice("mit", "*mit* license"),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", 12),
    Notice("isc", "under the *isc* license"),
    Notice("isc", "permission to use copy modify and or distribute this *software for any purpose*", 12),
    Notice("isc", "*isc* license"),
    Notice("bsd", "under the *bsd* license"),
    Notice("bsd", "*bsd* license"),
    Notice("bsd", "*bsd 2* clause license"),
    Notice("bsd", "*bsd 3* clause license"),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification", 12),
    Notice("gpl", "under the *gpl* license"),
    Notice("gpl", "*gnu general public* license"),
    Notice("lgpl", "under the *lgpl* license"),
    Notice("lgpl", "*gnu lesser* general public license"),
    Notice("agpl", "under the *agpl* license"),
    Notice("agpl", "*gnu affero* general public license"),
    Notice("mpl-2.0", "*mozilla* public license"),
    Notice("cc-by", "creative commons *attribution*"),
    *(
        Notice(f"cc-by-{'-'.join(short)}", f"{before} *{' '.join(words)}*")
        for short, full in ((("sa",), ("sharealike",)), (("nc",), ("noncommercial",)), (("nd",), ("noderivatives",)), (("nc", "sa"), ("noncommercial", "sharealike")), (("nc", "nd"), ("noncommercial", "noderivatives")))
        for before, words in (("*cc by*", short), ("creative commons *attribution*", full))
    ),
    Notice("cc0", "*cc0*"),
    Notice("public-domain", "dedicated to the *public domain*"),
    Notice("reserved", "all *rights reserved*", 3, missing=1),
    *(
        Notice(label, f"spdx license identifier *{words}*")
        for label, words in (("mit", "mit"), ("isc", "isc"), ("apache-2.0", "apache 2 0"), ("bsd", "bsd 2 clause"), ("bsd", "bsd 3 clause"), ("gpl", "gpl"), ("lgpl", "lgpl"), ("agpl", "agpl"), ("mpl-2.0", "mpl 2 0"), ("cc0", "cc0"))
    ),
)

SCAN = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_words", "n_base", "first_word", "last_word")]
    + [T.StructField(n, T.StringType()) for n in ("base_labels", "labels")]
    + [
        T.StructField("score", T.DoubleType()),
        T.StructField(
            "spans",
            T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("first_word", T.LongType()), T.StructField("end_word", T.LongType()), T.StructField("errors", T.LongType())])),
        ),
    ]
)

#: Upper case to lower, digits, lower case and bytes over 127 as they are, all else to a space.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def normal_form(text: str | None) -> tuple[bytes, int]:
    """Words (runs of letters and digits, and of all that isn't ASCII) with one space around each, and their number."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()
    return b" " + b" ".join(words) + b" " if words else b" ", len(words)


def seeds(notice: Notice) -> list[tuple[int, bytes]]:
    """``errors + 1`` pieces that make up the notice, with their offsets."""
    data, k = notice.plain.encode(), notice.errors + 1
    cuts = [len(data) * i // k for i in range(k + 1)]
    return [(a, data[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def fuzzy_pattern(notice: Notice):
    """The notice with a space before it and one ahead; each part with its own bound on errors."""
    escaped = lambda x: regex.escape(x, special_only=True)
    exact = lambda x: f"(?:{escaped(x)}){{d<={notice.missing}}}" if notice.missing else escaped(x)
    parts = [exact(x) if k is None else escaped(x) if not k else f"(?:{escaped(x)}){{e<={k}}}" for x, k in notice.parts]
    return regex.compile(f" {' '.join(parts)}(?= )".encode(), regex.ENHANCEMATCH)


class Scanner:
    """Finds notices in normal forms.  ``exhaustive`` skips the seeds: slow, for tests."""

    def __init__(self, notices: tuple[Notice, ...] = NOTICES, exhaustive: bool = False):
        self.exhaustive = exhaustive
        self.notices = [(n, n.plain, n.errors, seeds(n), [f" {x} ".encode() for x, k in n.parts if k is None and not n.missing], fuzzy_pattern(n)) for n in notices]

    @staticmethod
    def _places(data: bytes, pieces: list[tuple[int, bytes]], size: int, errors: int) -> list[list[int]]:
        """Windows, merged where they meet, that hold every possible match."""
        found = []
        for offset, piece in pieces:
            at = data.find(piece)
            while at >= 0:
                start = at - offset
                found.append((max(0, start - 2 * errors - 2), start + size + 2 * errors + 2))
                at = data.find(piece, at + 1)
        found.sort()
        windows: list[list[int]] = []
        for a, b in found:
            if windows and a <= windows[-1][1]:
                windows[-1][1] = max(windows[-1][1], b)
            else:
                windows.append([a, b])
        return windows

    def spans(self, data: bytes) -> list[tuple[str, int, int, int]]:
        """(label, start byte, end byte, errors), leftmost per notice, not overlapping per notice.

        A match inside a longer match is part of that notice's words, so it isn't reported.
        """
        out = set()
        for notice, plain, errors, pieces, exact, pattern in self.notices:
            if not self.exhaustive and any(x not in data for x in exact):
                continue
            for a, b in [[0, len(data)]] if self.exhaustive else self._places(data, pieces, len(plain), errors):
                for m in pattern.finditer(data, a, min(b, len(data))):
                    out.add((notice.label, m.start() + 1, m.end(), sum(m.fuzzy_counts)))
        inner = lambda x: any(y[1] <= x[1] and x[2] <= y[2] and y[2] - y[1] > x[2] - x[1] for y in out)
        return sorted((x for x in out if not inner(x)), key=lambda x: (x[1], x[2], x[0]))


def scan_text(text: str | None, scanner: Scanner) -> dict:
    data, n_words = normal_form(text)
    starts, base = [], set()
    for phrase, label in BASE_PHRASES:
        needle = b" " + phrase.encode() + b" "
        at = data.find(needle)
        while at >= 0:
            starts.append(at)
            base.add(label)
            at = data.find(needle, at + 1)
    spans = scanner.spans(data)
    word = lambda at: data.count(b" ", 0, at)
    score = max([1.0 if base else 0.0, *(round(max(0.0, 1 - e / max(1, b - a)), 6) for _, a, b, e in spans)])
    return {
        "n_words": n_words,
        "n_base": len(starts),
        "first_word": word(min(starts)) if starts else None,
        "last_word": word(max(starts)) if starts else None,
        "base_labels": ",".join(sorted(base)),
        "labels": ",".join(sorted(base | {s[0] for s in spans})),
        "score": score,
        "spans": [{"label": k, "first_word": word(a) - 1, "end_word": word(b), "errors": e} for k, a, b, e in spans],
    }


def scan(docs: DataFrame, notices: tuple[Notice, ...] = NOTICES, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: ``keep``'s columns and the scan's.

    A null or empty text has no words, no labels and a score of 0.  Repeated rows
    give repeated results.  ``spans`` counts words from 0, its end is exclusive.
    A label of several notices is reported once; spans of different notices may overlap.
    Long texts are scanned whole; windows are cut around seeds only.  No shuffle: each row is scanned where it is read.
    """
    made: list[Scanner] = []

    def run(texts):
        if not made:
            made.append(Scanner(notices))
        return [scan_text(t, made[0]) for t in texts]

    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("id"), arrow_column(run, SCAN, F.col("text").cast("string")).alias("s"))
    return packed.select(*(F.col("id")[c].alias(c) for c in keep), "s.*")
