"""Windows and shingles against plain loops; planted notices; the four notices of the tables."""

import re

import numpy as np

from starmill.llm import licenses, queries

NOTICES = {
    "gpl": r"licensed under the GNU General Public License",
    "mit": r"Released under the MIT License",
    "apache": r"Licensed under the Apache License",
    "cc-by-nc": r"Licensed under CC BY-NC",
}


def test_windows_are_pairs_of_blocks_of_one_line():
    words = licenses.tokens("\n".join(["a " * 95, "", "b c", "d " * 41]) + "\n")
    codes = licenses.Classifier(np.zeros((1, 1)), np.zeros(1)).encoded(words)
    block, first, last = licenses.windows(codes)
    assert list(zip(first, last)) == [(0, 1), (1, 2), (2, 3), (4, 4), (5, 6)]
    sizes = np.bincount(block[codes != 0])
    assert sizes.tolist() == [24, 24, 24, 23, 2, 24, 17]


def test_n_grams_stay_in_their_line():
    codes = licenses.Classifier(np.zeros((1, 1)), np.zeros(1)).encoded(["a", "b", "\n", "c", "d", "e", "\n"])
    at, found = licenses.buckets(codes)
    assert sorted(at.tolist()) == [0, 0, 1, 3, 3, 3, 4, 4, 5] and len(set(found.tolist())) == 9


def test_notices_of_the_tables_are_found_and_nothing_else(spark, sf_dir, documents):
    got = {r.doc_id: r for r in queries.op9_licenses(spark, sf_dir).collect()}
    assert len(got) == documents.count()
    for r in documents.collect():
        want = sorted(f for f, pattern in NOTICES.items() if re.search(pattern, r.text))
        assert [f for f in got[r.doc_id].families.split(",") if f] == want, r.doc_id
        lines = [str(n) for n, line in enumerate(r.text.split("\n")) if any(re.search(p, line) for p in NOTICES.values())]
        assert sorted(x for x in got[r.doc_id].paragraphs.split(",") if x) == sorted(lines)


def test_planted_notices_and_look_alikes(spark, documents):
    classifier = licenses.learn(documents)
    filler = "words of no consequence that go on and on " * 12
    texts = {
        "apache": "Licensed under the Apache License, Version 2.0",
        "mit": filler + "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software) " + filler,
        "bsd": "// Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "lgpl": "licensed under the gnu lesser general public license, version 3",
        "": "She lost her license and the general public was not told; the version of the apache pilot was free.",
    }
    got = classifier.matches(list(texts.values()))
    assert [sorted({m["family"] for m in ms if m["confirmed"]}) for ms in got] == [[f] if f else [] for f in texts]


def test_windows_that_name_several_licences(spark, documents):
    classifier = licenses.learn(documents)
    texts = {
        "Licensed under the MIT License or the Apache License, Version 2.0": ["apache", "mit"],
        "Licensed under either the Apache License, Version 2.0 or the MIT License": ["apache", "mit"],
        "Licensed under the MIT or BSD 3-Clause License": ["bsd", "mit"],
        "Released under the MIT License. Licensed under the BSD 3-Clause License": ["bsd", "mit"],
        "Licensed under the GNU General Public License. Licensed under CC BY 4.0": ["cc-by", "gpl"],
        "Licensed under the Mozilla Public License 2.0; this library is free software; you can redistribute it and/or modify it "
        "under the terms of the GNU Lesser General Public License": ["lgpl", "mpl"],
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": ["cc-by-sa"],
        "Licensed under CC BY-NC 4.0": ["cc-by-nc"],
    }
    got = classifier.matches(list(texts))
    assert [sorted(m["family"] for m in ms if m["confirmed"]) for ms in got] == list(texts.values())
    only = {t: f for f, ts in licenses.TEMPLATES.items() for t in ts}
    assert {t: [f for f, _ in licenses.confirmed(licenses.tokens(t), [f, *(set(licenses.TEMPLATES) - {f})])] for t, f in only.items()} == {t: [f] for t, f in only.items()}


def test_odd_rows_and_no_rows(odd_documents, no_documents):
    classifier = licenses.learn(odd_documents)
    rows = licenses.scan(odd_documents, classifier).collect()
    assert len(rows) == odd_documents.count() and not any(m.confirmed for r in rows for m in r.matches)
    assert licenses.scan(no_documents, licenses.learn(no_documents)).count() == 0
