import random
import re

import pytest

from lakework.llm import licenses
from tests.llm.conftest import WORDS, as_rows, with_clashes


def brute_base(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)
    starts, labels = [], set()
    for phrase, label in licenses.BASE_PHRASES:
        p = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def noisy(rng, text, edits):
    s = list(text)
    for _ in range(edits):
        i = rng.randrange(len(s))
        kind = rng.randrange(3)
        if kind == 0:
            s[i] = rng.choice("abcxyz")
        elif kind == 1:
            del s[i]
        else:
            s.insert(i, rng.choice("abcxyz"))
    return "".join(s)


def notices(seed=2, n=150):
    rng, out = random.Random(seed), []
    fixed = ["CC BY", "cc-by cc by\ncc by", "All  Rights—Reserved", "all rights reserved", "General Public LICENSE general public license", "xcc by", "cc byx", "ccé by", "cc by é", "é cc\x85by", None, "", "cc", "by cc"]
    for _ in range(n):
        words = [rng.choice(WORDS) for _ in range(rng.randint(0, 30))]
        notice = rng.choice(licenses.NOTICES)
        words.insert(rng.randint(0, len(words)), noisy(rng, notice.plain, rng.randint(0, notice.errors + 2)).replace(" ", rng.choice((" ", ", ", "\n"))))
        out.append(" ".join(words))
    return fixed + out


def test_base_equals_brute_force(spark, docs, texts):
    for sample in (texts, notices()):
        df = spark.createDataFrame(list(enumerate(sample)), "doc_id bigint, text string")
        got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.scan(df).collect()}
        assert got == {i: brute_base(t) for i, t in enumerate(sample)}


def test_seeds_find_what_an_exhaustive_search_finds():
    fast, slow = licenses.Scanner(), licenses.Scanner(exhaustive=True)
    hits = 0
    for text in notices(5, 300):
        a, b = licenses.scan_text(text, fast), licenses.scan_text(text, slow)
        assert (a["labels"], a["spans"], a["score"]) == (b["labels"], b["spans"], b["score"])
        hits += a["labels"] != ""
    assert hits > 100


def test_seeds_make_up_the_notice():
    for n in licenses.NOTICES:
        pieces = licenses.seeds(n)
        assert len(pieces) == n.errors + 1 and b"".join(p for _, p in pieces).decode() == n.plain and all(p for _, p in pieces)


NEAR = {
    "Licensed under CC BY 4.0": "cc-by",
    "Licensed under CC BY-SA 4.0": "cc-by,cc-by-sa",
    "Licensed under CC-BY-NC 4.0": "cc-by,cc-by-nc",
    "Licensed under CC BY-ND 3.0": "cc-by,cc-by-nd",
    "Licensed under CC BY-NC-SA": "cc-by,cc-by-nc-sa",
    "Licensed under CC BY-NC-ND": "cc-by,cc-by-nc-nd",
    "under CC BY, not commercial": "cc-by",
    "a Creative Commons Attribution license": "cc-by",
    "a Creative Comons Attribution-ShareAlike license": "cc-by-sa",
    "a Creative Commons Attribution-NonCommercial-NoDerivatives license": "cc-by-nc-nd",
    "Creative Commons Zero": "",
    "Released under the BSD license": "bsd",
    "Released under the MIT license": "mit",
    "Released undr the MIT licence": "mit",
    "Released under the GPL license": "gpl",
    "Released under the LGPL license": "lgpl",
    "Released under the AGPL licence": "agpl",
    "Released under the ISC license": "isc",
    "Released under the new license": "",
    "Released under the MET license": "",
    "Released under the mit": "",
    "GNU General Public License version 3": "gpl",
    "GNU Lesser General Public License": "gpl,lgpl",
    "GNU Affero General Public License": "agpl,gpl",
    "GNU Lessor General Public Licence": "",
    "Mozila Public License": "",
    "under the Mozilla Publik License": "mpl-2.0",
    "under the Apache Lisense, Version 2.0": "apache-2.0",
    "under the Apache License, Version 1.1": "",
    "all rights deserved": "",
    "al rights reserved": "reserved",
    "all rights reserved": "reserved",
    "dedicated to the public domain": "public-domain",
    "dedicated to the public service": "",
    "CC0 1.0 Universal": "cc0",
    "Redistribution and use in sourse and binary form, with or without modification": "bsd",
    "Permission is hereby granted, free of charge, to any persons obtaining a copy": "mit",
    "MIT License": "mit",
    "BSD 3-Clause License": "bsd",
    "BSD 2-Clause Licence": "bsd",
    "BSD 4-Clause License": "",
    "Apache License 2.0": "apache-2.0",
    "Apache License 1.0": "",
    "SPDX-License-Identifier: MIT": "mit",
    "SPDX-Licence-Identifier: BSD-3-Clause": "bsd",
    "SPDX-License-Identifier: NONE": "",
    "under the terms of the MIT license": "mit",
    "under the terms of the Apache License, Version 2.0": "apache-2.0",
    "all right reserved": "reserved",
    "all rights reservd": "reserved",
    "all rights preserved": "",
    "Permission to use, copy, modify, and/or distribute this software for any purpose": "isc",
}


@pytest.mark.parametrize("text", NEAR)
def test_near_misses(text):
    for before, after in (("", ""), ("This was ", " by them, and more words follow here")):
        assert licenses.scan_text(before + text + after, licenses.Scanner())["labels"] == NEAR[text]


def test_long_texts(spark):
    filler = "word " * 200_000
    text = f"{filler}all rights reserved {filler}under the MTI license, under the BSD licence {filler}cc by nc"
    row = licenses.scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert (row.labels, row.n_words, row.first_word, row.last_word) == ("bsd,cc-by,cc-by-nc,reserved", 600_014, 200_000, 600_011)


@pytest.mark.parametrize(("text", "label", "span"), [("foo bar Released under the MIT Licence! ok", "mit", (3, 7)), ("Licensed under the Apache Lisense, Version 2.0.", "apache-2.0", (1, 8)), ("Licensed under CC BY-NC 4.0", "cc-by-nc", (2, 5))])
def test_spans(text, label, span):
    found = licenses.scan_text(text, licenses.Scanner())
    assert label in found["labels"].split(",") and 0 < found["score"] <= 1
    s = next(s for s in found["spans"] if s["label"] == label)
    assert (s["first_word"], s["end_word"]) == span


def test_edges(spark, docs):
    assert licenses.scan(docs.where("doc_id < 0")).count() == 0
    assert as_rows(licenses.scan(with_clashes(docs)).drop("spans")) == as_rows(licenses.scan(docs).drop("spans"))
    row = licenses.scan(spark.createDataFrame([(None, None)], "doc_id bigint, text string")).first()
    assert (row.n_words, row.n_base, row.first_word, row.labels, row.score, row.spans) == (0, 0, None, "", 0.0, [])
    assert licenses.scan(docs.union(docs)).count() == 2 * docs.count()
