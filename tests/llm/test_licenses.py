import math
import random
import re
from collections import Counter

import pytest

from tessera.llm import licenses, queries


def brute_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_base(text):
    ws = brute_words(text)
    out = [(i, label) for phrase, label in licenses.BASE_PHRASES.items() for i in range(len(ws))
           if ws[i:i + len(phrase.split())] == phrase.split()]
    return len(ws), sorted(out)


CASES = [
    (1, "Licensed under the Apache License, Version 2.0."), (2, "All rights reserved. all RIGHTS reserved CC BY-NC 4.0 cc by"),
    (3, None), (4, ""), (5, "Kelvin Kind CC-BY İx general   public\nlicense"),
    (6, "the license of the version is under 2 0"), (7, "mit license mit. released under the MIT License! " * 400),
    (8, "é general public licenseé general public license"), (8, "é general public licenseé general public license"),
    (9, "This work is licensed under the GNU General Public License, version 3."),
    (10, "some text about the apache people and version 2 of a license, permitted"),
    (11, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
]


def test_planted_cases(spark):
    df = spark.createDataFrame([(*c, "w", 1) for c in CASES], "doc_id long, text string, ws string, aligned int")
    rows = licenses.find_licenses(df).collect()
    assert len(rows) == len(CASES)
    got = sorted((r.doc_id, r.n_words, [(p["at"], p["label"]) for p in r.base]) for r in rows)
    assert got == sorted((i, *brute_base(t)) for i, t in CASES)
    found = {r.doc_id: {(a["at"], a["label"]) for a in r.aligned} for r in rows}
    assert found[1] == {(0, "apache-2.0")} and found[9] == {(3, "gpl-3.0")}
    assert found[3] == found[4] == found[6] == found[10] == set()
    assert len(found[7]) == 400 and {label for _, label in found[7]} == {"mit"}
    assert (0, "mit") in found[11]


def test_base_columns_of_a_whole_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = queries.op5_licenses(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, base = brute_base(docs[r.doc_id])
        assert (r.n_words, r.n_base) == (n, len(base))
        assert (r.first_word, r.last_word) == ((base[0][0], base[-1][0]) if base else (None, None))
        assert r.base_labels == ",".join(sorted({label for _, label in base}))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) or not r.base_labels
        assert 0 <= r.score <= 1


def test_empty_table(spark):
    assert licenses.find_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_key_phrases_are_found_whatever_the_corpus(spark):
    texts = {1: ("CC0 1.0", "cc0"), 2: ("Mozilla Public License 2.0", "mpl-2.0"), 3: ("CC BY-NC", "cc-by-nc")}
    common = ["public license v terms 1 0 2", "cc by 4 0 license public", "licensed under the mit license 1 0"] * 40
    for others in ([], common, common + ["universal public domain dedication"] * 5):
        rows = [(i, t) for i, (t, _) in texts.items()] + [(100 + i, t) for i, t in enumerate(others)]
        found = {r.doc_id: {a.label for a in r.aligned} for r in licenses.find_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert all(label in found[i] for i, (_, label) in texts.items())


def brute_aligned(texts, notices):
    """text -> [(at, label, score)] of the verified alignments, by plain loops over all templates and places."""
    known = [(label, brute_words(text), [" ".join(brute_words(k)) for k in keys]) for label, text, keys in notices]
    bags = [set(brute_words(t)) for t in texts]
    vocabulary = {w for _, ws, _ in known for w in ws}
    df = Counter(w for b in bags for w in b & vocabulary)
    weight = {w: math.log((len(texts) + 1) / (df[w] + 1)) + 1 for w in vocabulary}
    out = []
    for text in texts:
        ws, found = brute_words(text), []
        joined = f" {' '.join(ws)} "
        if not any(all(f" {k} " in joined for k in keys) for _, _, keys in known):
            out.append([])
            continue
        for number, (label, tw, keys) in enumerate(known):
            posted = set(sorted(set(tw), key=lambda w: (-weight[w], w))[:4]) | {w for k in keys for w in k.split()}
            for at in range(-len(tw), len(ws)):
                same = [j for j, w in enumerate(tw) if 0 <= at + j < len(ws) and ws[at + j] == w]
                if sum(tw[j] in posted for j in same) < 2:
                    continue
                window = f" {' '.join(ws[max(0, at - 4):max(0, at + len(tw) + 4)])} "
                if all(f" {k} " in window for k in keys):
                    found.append((number, at, label, sum(weight[tw[j]] for j in same) / sum(weight[w] for w in tw), len(tw) + 4))
        out.append(sorted((at, label, score) for n, at, label, score, reach in found if not any(
            o[0] == n and abs(o[1] - at) < reach and o[3] > score + 1e-12 for o in found)))
    return out


def garbled(rng, notices, n):
    """Texts of notices, whole, cut, with words changed, repeated and among other words."""
    other = [w for _, t, _ in notices for w in brute_words(t)] + ["zebra", "the", "of", "é"] * 8
    rows = []
    for _ in range(n):
        words = rng.choices(other, k=rng.randrange(12))
        for _ in range(rng.randrange(4)):
            notice = rng.choice(notices)[1].split()
            if rng.random() < 0.3:
                notice = notice[rng.randrange(len(notice)):] or notice
            if rng.random() < 0.4:
                notice[rng.randrange(len(notice))] = rng.choice(other)
            words += notice + rng.choices(other, k=rng.randrange(5))
        rows.append(" ".join(w.upper() if rng.random() < 0.2 else w for w in words))
    return rows


OWN = [("house", "The contents of this House-Licence may be copied, if every copy names the house and its keeper. No warranty is given by the keeper.",
        ["house licence", "no warranty"]),
       ("short", "use it freely", ["freely"]), ("house", "house licence 2", ["house licence 2"])]


@pytest.mark.parametrize("notices", [licenses.TEMPLATES, OWN])
def test_alignments_equal_plain_loops(spark, notices):
    texts = garbled(random.Random(len(notices)), notices, 150) + ["", "licence", " ".join(t for _, t, _ in notices)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = brute_aligned(texts, notices)
    assert sum(map(len, want)) > 100
    for r in licenses.find_licenses(df, known=licenses.templates(notices)).collect():
        got = sorted((a["at"], a["label"], a["score"]) for a in r.aligned)
        assert [g[:2] for g in got] == [w[:2] for w in want[r.doc_id]], texts[r.doc_id]
        assert all(math.isclose(g[2], w[2], rel_tol=1e-9) for g, w in zip(got, want[r.doc_id]))


def test_labels_and_scores_of_a_whole_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    want = dict(zip([r.doc_id for r in rows], brute_aligned([r.text for r in rows], licenses.TEMPLATES)))
    for r in queries.op5_licenses(spark, "/root/testdata/sf0.001").collect():
        base = [label for label in r.base_labels.split(",") if label]
        assert r.labels == ",".join(sorted({*base, *(label for _, label, _ in want[r.doc_id])}))
        assert math.isclose(r.score, max([0.5 if base else 0.0, *(s for _, _, s in want[r.doc_id])]), rel_tol=1e-9, abs_tol=1e-12)


@pytest.mark.parametrize("bad", [("x", "", ["a"]), ("x", "a b", []), ("x", "a b", ["c"]), ("x", "a b", [""])])
def test_templates_need_their_key_phrases(bad):
    with pytest.raises(ValueError):
        licenses.templates([bad])
