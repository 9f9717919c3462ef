import re

import pytest

from landspark.llm import license_scan
from tests.llm.helpers import awkward, documents

WORD = re.compile(license_scan.WORD)
KNOWN, DENIALS = license_scan.templates(0.8), license_scan.denials()


def brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    places = {label: [i for i in range(len(words)) if words[i : i + len(p.split())] == p.split()] for p, label in license_scan.PHRASES.items()}
    every = [i for own in places.values() for i in own]
    base = sorted(label for label, own in places.items() if own)
    best, found = 0.0, set(base)
    for c in license_scan.CLASSES:
        size, step = license_scan.block_size(c)
        for at in range(0, max(1, len(words)), step):
            own, hits = set(words[at : at + size]), {}
            pairs = {f"{words[k - 1]} {words[k]}" for k in range(max(at, 1), min(at + size, len(words)))}
            wide = {f"{words[k - 1]} {words[k]}" for k in range(max(at - step, 1), min(at + size, len(words)))}
            for k, label, its, template, need, musts, over, told in KNOWN:
                if its == c and len(own & set(template)) >= need and own.issuperset(musts) and len(pairs & set(told)) >= 0.5 * len(told) and wide.isdisjoint(DENIALS):
                    hits[k] = label, len(own & set(template)) / len(template), over
            for label, share, over in hits.values():
                if not {x[0] for x in hits.values()} & set(over):
                    found.add(label)
                    best = max(best, share)
    return (len(words), len(every), min(every, default=None), max(every, default=None), ",".join(base), ",".join(sorted(found)), 1.0 if every else best)


TEXTS = [
    "Released under the MIT License. CC BY-NC, cc by nc and Under the MIT license", "Apache License, Version 2.0", "This work is licensed under the GNU General Public License, version 3.",
    "licence of the work under GNU general public license version, 3 is licensed this", "this work is licensed.\nUnder the gnu general public license version 3",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and files", "under the mit license under the mit license", "the the the of of",
    "Distributed under a Creative Commons Attribution-ShareAlike 4.0 International License, this work is", "éunder the mit license", None, "",
]


#: Notices as license files wrap them.
WRAPPED = {
    "mit": "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction.",
    "gpl": "    This program is free software: you can redistribute it and/or modify\n    it under the terms of the GNU General Public License as published by\n    the Free Software Foundation, either version 2 of the License, or\n    (at your option) any later version.",
    "lgpl": "# This library is free software; you can redistribute it and/or\n# modify it under the terms of the GNU Lesser General Public\n# License as published by the Free Software Foundation; either\n# version 2.1 of the License.",
    "bsd": " * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that the following conditions are met:\n *\n * 1. Redistributions of source code must retain the above copyright notice, this\n *    list of conditions and the following disclaimer.",
    "apache-2": "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at",
    "cc-by-nc": "This work is licensed under a\nCreative Commons Attribution-NonCommercial\n4.0 International License.",
    "mpl-2": "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one.",
    "boost": "Permission is hereby granted, free of charge, to any person or organization\nobtaining a copy of the software and accompanying documentation covered by\nthis license.",
    "": "released under the terms of the BSD license, and nothing else is said of it in this text\nthe software, the license, the terms of it, under which any person may use it",
}


@pytest.mark.parametrize("before", [0, 7, 29, 30, 31, 44, 59, 60, 600])
def test_wrapped_notices(spark, before):
    filler = " ".join(f"w{k}" for k in range(before))
    texts = [f"{filler}\n{t}\n{filler}" for t in WRAPPED.values()]
    got = dict(result(documents(spark, texts)))
    assert [got[k][5] for k in range(len(texts))] == list(WRAPPED)
    assert got == {k: brute(t) for k, t in enumerate(texts)}


def test_templates_fit_into_a_block():
    for _, text, musts in license_scan.TEMPLATES:
        assert len(text.split(" ")) <= license_scan.CLASSES[-1] and set(musts.split(" ")) <= set(text.split(" "))


#: Sentences with the words of notices that are none.
NO_NOTICES = [
    "This software was released by students of MIT under the terms of a commercial license.",
    "It is not released under the terms of the MIT license",
    "International commons under this a 4 attribution is creative license 0 work licensed",
    "The Apache helicopter, licensed 2 years ago: under the license 0 version.",
    "The work isn't licensed under a Creative Commons Attribution 4.0 International License",
]


def test_words_of_a_notice_are_no_notice(spark):
    texts = NO_NOTICES + [f"{'word ' * k}{t}" for k in range(1, 6) for t in NO_NOTICES]
    got = dict(result(documents(spark, texts)))
    assert {x[5] for x in got.values()} == {""} and {x[6] for x in got.values()} == {0.0}
    assert got == {k: brute(t) for k, t in enumerate(texts)}


def result(df):
    return [(r["doc_id"], tuple(r)[1:]) for r in license_scan.label(df).collect()]


def test_brute_force(spark):
    assert dict(result(documents(spark, TEXTS))) == {k: brute(t) for k, t in enumerate(TEXTS)}


def test_awkward_rows(spark):
    df = awkward(spark)
    assert sorted(map(str, result(df))) == sorted(str((r["doc_id"], brute(r["text"]))) for r in df.collect())


def test_empty_table(spark):
    assert license_scan.label(documents(spark, [])).count() == 0
