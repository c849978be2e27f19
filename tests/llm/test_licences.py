import re

from trackstats.llm import licences

TEXTS = [
    None, "", "...", "CC BY-NC 4.0", "cc  by cc-by\nCC/BY", "All rights reserved. all RIGHTS reserved!", "all rights",
    "This work is licensed under the GNU General Public License, version 3.", "general public license",
    "Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy",
    "x " * 4000 + "Licensed under the Apache License, Version 2.0.", "allrights reserved", "réservé cc by é",
    "by cc", "license version 2 0", "all rights all rights reserved rights reserved", "é" * 3000,
]


def brute(text):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
    found = [(i, label) for p, label in licences.BASE.items() for i in range(len(w))
             if w[i:i + len(p.split())] == p.split()]
    starts = [i for i, _ in found]
    return (len(w), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found})))


def test_base_equals_brute_force(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "cc by", "y"), (3, "CC BY-NC 4.0", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels string")
    got = licences.licence_scan(docs.repartition(3)).collect()
    assert len(got) == len(rows)
    for r in got:
        want = brute("cc by" if r.doc_id is None else TEXTS[r.doc_id])
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == want
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert (r.score > 0) == bool(r.labels)


def test_notices(spark):
    rows = [(1, "Licensed to you under the Apache License, Version 2.0"), (2, "an apache licence of any version"),
            (3, "# Redistribution and use in\n# source and binary forms, with or without modification, are permitted"),
            (4, "released under a license of the mit"), (5, "Mozilla Public License")]
    got = {r.doc_id: r.labels for r in licences.licence_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == "apache-2.0" and got[2] == "" and got[3] == "bsd" and got[4] == ""


def test_empty_table(spark):
    assert licences.licence_scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_key_phrase_is_mandatory(spark):
    text = "licensed under the apache licence version 2 0"  # most of the notice, but not its key phrase
    got = licences.licence_scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert got.labels == "" and got.score == 0


MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"


def labels(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.labels for r in licences.licence_scan(docs).orderBy("doc_id").collect()]


def test_headers_identifiers_inserted_and_missing_words(spark):
    got = labels(spark, [
        "GNU General Public License as published by the Free Software Foundation; either version 3",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or later",
        MIT.replace("granted,", "granted, without any fee,").replace("free of charge", "free of charge"),
        MIT.replace("any person", "any natural or legal person").replace("obtaining a", "obtaining"),
        "// SPDX-License-Identifier: Apache-2.0", "SPDX-License-Identifier: GPL-3.0-or-later", "SPDX-License-Identifier: (Apache-2.0 OR MIT)",
        "GNU Lesser General Public License as published by the Free Software Foundation; either version 3, terms of the", "SPDX identifier of a license",
        MIT.replace("free of charge", "for a small charge")])
    assert got == ["gpl,gpl-3.0", "gpl,gpl-2.0", "mit", "mit", "apache-2.0", "gpl-3.0", "apache-2.0,mit", "gpl,lgpl", "", ""]


def brute_notices(text, idf):
    """Every template at every start, from words and places alone."""
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
    found = {}
    for label, phrase, keys in licences.notices():
        words = phrase.split()
        weight = [idf[int(licences._hashes(x)[0])] for x in words]
        slack = licences.EXPRESSION if phrase.startswith(licences.SPDX) else max(2, len(words) // licences.LOOSE)
        places = [[i for i, x in enumerate(w) if x == v] for v in words]
        for start in {i - p for p, at in enumerate(places) for i in at}:
            near = lambda i, p: abs(i - p - start) <= slack
            share = sum(weight[p] for p, at in enumerate(places) if any(near(i, p) for i in at)) / sum(weight)
            whole = all(any(w[i:i + len(k)] == k and near(i, next(j for j in range(len(words)) if words[j:j + len(k)] == k)) for i in range(len(w)))
                        for k in map(str.split, keys))
            if whole and share >= licences.SHARE - 1e-9:
                found[label] = max(share, found.get(label, 0))
    return found


def test_equals_brute_force_over_all_templates(spark):
    import random
    rng = random.Random(4)
    texts = []
    for _ in range(120):
        words = []
        for _ in range(rng.randrange(1, 4)):
            words += [rng.choice(["the", "of", "license", "x", "version", "2", "0", "public"]) for _ in range(rng.randrange(12))]
            for v in rng.choice(licences.notices())[1].split():
                roll = rng.random()
                if roll < 0.12:
                    continue
                words += [v] if roll < 0.8 else [v, rng.choice(["and", "the", "y", "license"])]
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    idf = licences.rarity(docs.selectExpr("cast(text as binary) text"))
    for r in licences.licence_scan(docs.repartition(2)).collect():
        want = brute_notices(texts[r.doc_id], idf)
        base = set(filter(None, r.base_labels.split(",")))
        assert set(filter(None, r.labels.split(","))) == set(want) | base
        assert abs(r.score - max([*want.values(), 1.0 if base else 0.0], default=0)) < 1e-9


def test_very_long_text_and_repeated_rows(spark):
    long_ = "license of the version " * 60_000 + MIT
    docs = spark.createDataFrame([(1, long_), (1, long_), (None, MIT)], "doc_id long, text string")
    got = licences.licence_scan(docs).collect()
    assert [r.labels for r in got] == ["mit"] * 3 and max(r.n_words for r in got) == 240_016
    assert {p.start for r in got if r.doc_id for p in r.places} <= set(range(239_996, 240_004))
