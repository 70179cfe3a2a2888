import random
import re

from kestrel.llm import license_scan as ls
from kestrel.llm.decontaminate import words_of

PIECES = ["GNU General Public License", "Apache License, Version 2.0", "CC-BY", "CC BY-SA 4.0", "MIT License", "mit", "license", "gnu general",
          "SPDX-License-Identifier: BSD-3-Clause", "filler", "É ñ", "public license", "released under the MIT license", "\n", "2 0"]


def places(words):
    out = []
    for phrase, label in ls.BASE_PHRASES.items():
        p = phrase.encode().split()
        out += [(i, label) for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
    return sorted(out)


def test_base_places_equal_brute_force(spark):
    r = random.Random(1)
    texts = [" ".join(r.choices(PIECES, k=r.randrange(0, 12))) for _ in range(300)] + [None, "", "x " * 30000 + "mit license"]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, labels string")
    for row in ls.digest(ls.scan(df)).collect():
        words = words_of((texts[row.doc_id] or "").encode())
        want = places(words)
        labels = sorted({x for _, x in want})
        assert (row.n_words, row.n_base, row.base_labels) == (len(words), len(want), ",".join(labels))
        assert (row.first_word, row.last_word) == ((want[0][0], want[-1][0]) if want else (None, None))
        assert set(labels) <= set(filter(None, row.labels.split(","))) and 0 <= row.score <= 1
        assert row.score > 0 or not row.labels
        assert sorted(set(row.labels.split(","))) == row.labels.split(",")
    assert ls.digest(ls.scan(df.limit(0))).count() == 0


def found(text):
    return [(d.label, d.start, d.end) for d in ls.detections(words_of(text.encode()))]


def test_rules():
    rules, gate = ls.rules()
    assert len(rules) >= 300 and [r.priority for r in rules] == sorted((r.priority for r in rules), reverse=True)
    assert found("Licensed under the Apache License, Version 2.0 (the") == [("apache", 0, 8)]
    assert found("SPDX-License-Identifier: GPL-3.0-or-later") == [("gpl", 0, 8)]
    assert found("words about rubies and gems") == []


def test_contained_detections_are_suppressed():
    assert found("the CC BY-SA 4.0 deed") == [("cc-by-sa", 1, 4)]                       # not cc-by inside it
    assert found("GNU Lesser General Public License") == [("lgpl", 0, 5)]
    assert found("MIT license and Apache license") in ([("mit", 0, 2), ("apache", 3, 5)], [("mit", 0, 2), ("apache", 2, 5)])


def test_crossing_detections_keep_the_higher_priority():
    a, b = ls.Detection(0, 9, "a", 2, 0.5), ls.Detection(5, 12, "b", 8, 0.5)
    assert ls.resolve([a, b]) == [b]
    assert ls.contained_out([ls.Detection(0, 9, "a", 2, 0.5), ls.Detection(0, 9, "b", 3, 0.5), ls.Detection(2, 9, "c", 9, 0.5)]) == [ls.Detection(0, 9, "b", 3, 0.5)]


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction. The above copyright notice and this permission notice shall be
included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. 3. Neither the name of the Example Company, Inc. nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission."""
GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
published by the Free Software Foundation, either version 3 of the License. You should have received a copy of the GNU General Public
License along with this program."""
TEXTS = {"mit": MIT, "bsd bsd-3-clause": BSD, "gpl": GPL, "lgpl": GPL.replace("General", "Lesser General"), "agpl": GPL.replace("General", "Affero General"),
         "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
                "the above copyright notice and this permission notice appear in all copies.",
         "0bsd": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
         "apache": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
         "mpl": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
         "zlib": "The origin of this software must not be misrepresented; you must not claim that you wrote the original software.",
         "unlicense": "This is free and unencumbered software released into the public domain.",
         "boost": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license",
         "cc-by-nc-sa": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."}


def test_texts_and_headers_of_licenses():
    for labels, text in TEXTS.items():
        assert " ".join(sorted({x for x, _, _ in found("Copyright 2020 someone. " + text + " And more words.")})) == labels, labels
        assert all(d.weight == ls.PASSAGE_WEIGHT for d in ls.detections(words_of(text.encode())))


def test_every_passage_is_found_by_itself_through_its_keyword():
    for label, keyword, pattern in ls.PASSAGES:
        plain = pattern.replace("~", "some company inc ")
        for text in sorted(spellings(plain))[:40]:
            assert keyword in text.split(), (label, text)
            assert ls.detections(text.encode().split()) == ls.detections(text.encode().split(), gated=False) != []


def test_gated_scan_equals_ungated_scan():
    r = random.Random(7)
    pieces = [*PIECES, *TEXTS.values(), "provided", "under the", "license", "version 3"]
    for _ in range(60):
        words = words_of(" ".join(r.choices(pieces, k=r.randrange(1, 15))).encode())
        assert ls.detections(words) == ls.detections(words, gated=False)


def test_very_many_detections_in_one_text():
    words = b"mit license or".split() * 100_000
    found_all = ls.detections(words)
    assert len(found_all) == 100_000 and found_all[-1][:3] == (299_997, 299_999, "mit")


def slow_resolve(found):
    kept = []
    for d in sorted(found, key=lambda d: (-d.priority, d.start - d.end, d.start, d.label)):
        if all(d.end <= k.start or k.end <= d.start for k in kept):
            kept.append(d)
    return sorted(kept)


def test_resolving_equals_comparing_all():
    r = random.Random(3)
    for _ in range(300):
        made = [ls.Detection(a, a + r.randint(1, 9), r.choice("abc"), r.randint(1, 4), 0.5) for a in r.choices(range(40), k=r.randint(0, 25))]
        assert ls.resolve(made) == slow_resolve(made)


def spellings(pattern):
    """Every string that a signature matches (its repeats are bounded)."""
    def of(items):
        out = [""]
        for op, arg in items:
            name = str(op)
            if name == "LITERAL":
                one = [chr(arg)]
            elif name == "IN":
                one = [chr(c) for o, a in arg for c in (range(a[0], a[1] + 1) if str(o) == "RANGE" else [a])]
            elif name == "MAX_REPEAT":
                one = [x * n for n in range(arg[0], int(arg[1]) + 1) for x in of(arg[2])]
            elif name == "SUBPATTERN":
                one = of(arg[-1])
            else:
                assert name == "BRANCH", name
                one = [x for branch in arg[1] for x in of(branch)]
            out = [a + b for a in out for b in one]
        return out
    return set(of(re._parser.parse(pattern)))


def test_every_spelling_of_every_family_passes_its_gate():
    for label, spdx, name, keywords in ls.FAMILIES:
        for text in spellings(spdx) | spellings(name):
            assert set(text.split()) & set(keywords.split()), (label, text)
    assert found("the llama3 license") == [("llama", 1, 3)]
    assert found("SPDX-License-Identifier: llama3") == [("llama", 0, 4)]
