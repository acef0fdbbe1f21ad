"""Licence notices in texts, found through a positional index of rare words.

Each licence template is a short word sequence with key phrases that must
occur.  Over the whole corpus the document frequency of every template word
gives its IDF; the index posts, for each template, the words of its key phrases
and its words of highest IDF with their positions.  A file looks up the indexed words it has; postings of
one template whose relative position agrees align the file with the template,
and an alignment that two words agree on is verified: every key phrase must
stand within the aligned window.  Its score is the IDF-weighted share of
template words that stand where the template has them.

Templates are a parameter, sentences or whole notices; ``TEMPLATES`` is a short
list of common ones.  Only column expressions are used; what reaches the driver
is one document count per template word, and the plan holds the templates, so
it grows with their list and not with the corpus.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ascii_lower

# fixed values of the task: phrases and their labels
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# fixed values: widely used notices, each with the phrases it cannot do without
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license", "version 2 0"]),
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ["permission is hereby granted", "free of charge"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ["redistribution and use", "source and binary forms"]),
    ("gpl-3.0", "licensed under the gnu general public license version 3", ["gnu general public license", "version 3"]),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ["gnu general public license", "version 2"]),
    ("gpl", "redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ["gnu general public license", "free software foundation"]),
    ("lgpl", "under the terms of the gnu lesser general public license", ["gnu lesser general public license"]),
    ("agpl", "under the terms of the gnu affero general public license", ["gnu affero general public license"]),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ["mozilla public license", "2 0"]),
    ("epl-2.0", "under the terms of the eclipse public license v 2 0", ["eclipse public license"]),
    ("bsl-1.0", "distributed under the boost software license version 1 0", ["boost software license"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["permission to use copy modify", "is hereby granted"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["unencumbered software", "public domain"]),
    ("cc0", "cc0 1 0 universal public domain dedication", ["cc0 1 0"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by-nd", "licensed under cc by nd 4 0", ["cc by nd"]),
    ("reserved", "copyright holders all rights reserved", ["all rights reserved"]),
]

INDEX_WORDS = 4     # indexed words of a template besides those of its key phrases: those of highest IDF
SLACK = 4           # words by which a key phrase may stand outside the alignment
BASE_SCORE = 0.5    # least score of a text with a base phrase

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    words: list[str]
    keys: list[str]


def templates(notices: list[tuple[str, str, list[str]]] = TEMPLATES) -> list[Template]:
    """Templates from ``(label, text, key phrases)``, text and phrases as words of :func:`words`.

    A template needs words, and key phrases that occur in it.
    """
    out = []
    for label, text, keys in notices:
        known = Template(label, _plain_words(text), [" ".join(_plain_words(k)) for k in keys])
        body = f" {' '.join(known.words)} "
        if not known.words or not known.keys or not all(k and f" {k} " in body for k in known.keys):
            raise ValueError(f"a template needs words and key phrases of its own: {label}")
        out.append(known)
    return out


def _plain_words(text: str) -> list[str]:
    return [w for w in re.split(NOT_WORD, text.translate({c: c + 32 for c in range(65, 91)})) if w]


def words(text: Column) -> Column:
    """Words of the whole text, in lower case (A-Z); null texts have none."""
    text = F.coalesce(text, F.lit(""))
    # lower() is much faster; only the Kelvin sign and the dotted I turn into ASCII letters
    odd = F.contains(text, F.lit("\u212a")) | F.contains(text, F.lit("\u0130"))
    low = F.when(odd, ascii_lower(text)).otherwise(F.lower(text))
    return F.filter(F.split(low, NOT_WORD, -1), lambda w: w != "")


def document_frequencies(docs: DataFrame, text_col: str = "text", known: list[Template] | None = None) -> tuple[int, dict[str, int]]:
    """Number of rows, and in how many of them each template word occurs."""
    vocabulary = sorted({w for t in known or templates() for w in t.words})
    found = F.array_intersect(words(F.col(text_col)), F.array(*map(F.lit, vocabulary)))
    rows = (docs.select(F.explode(F.concat(found, F.array(F.lit("")))).alias("w"))      # "" counts the rows
            .groupBy("w").agg(F.count("*").alias("n")).collect())
    counts = {r["w"]: r["n"] for r in rows}
    return counts.pop("", 0), counts


def idf(n_rows: int, counts: dict[str, int], known: list[Template] | None = None) -> dict[str, float]:
    return {w: math.log((n_rows + 1) / (counts.get(w, 0) + 1)) + 1 for t in known or templates() for w in t.words}


def _index(weights: dict[str, float], known: list[Template]) -> dict[str, list[tuple[int, int]]]:
    """Indexed word -> its (template, position) postings."""
    out: dict[str, list[tuple[int, int]]] = {}
    for t, template in enumerate(known):
        mandatory = {w for key in template.keys for w in key.split()}
        rare = sorted(set(template.words), key=lambda w: (-weights[w], w))[:INDEX_WORDS]
        for p, w in enumerate(template.words):
            if w in rare or w in mandatory:
                out.setdefault(w, []).append((t, p))
    return out


def _strings(values: list[str]) -> Column:
    return F.array(*map(F.lit, values))


SHIFT = 1 << 40     # an alignment is one long: template * SHIFT + offset + BIAS
BIAS = 1 << 20


def alignments(ws: Column, weights: dict[str, float], known: list[Template] | None = None) -> Column:
    """``array<struct(at, label, score)>``: verified template alignments of a word array."""
    known = known or templates()
    index = _index(weights, known)
    anchors = sorted(index)
    postings = F.create_map(*[x for w in anchors for x in (
        F.lit(w), F.array(*[F.lit(t * SHIFT + BIAS - p).cast("bigint") for t, p in index[w]]))])
    all_words = F.array(*[_strings(t.words) for t in known])
    all_weights = F.array(*[F.array(*[F.lit(weights[w]) for w in t.words]) for t in known])
    all_keys = F.array(*[_strings(t.keys) for t in known])
    all_labels = _strings([t.label for t in known])

    def verified(cand: Column) -> Column:
        def one(c: Column) -> Column:
            t = F.shiftright(c, 40).cast("int") + 1
            at = c.bitwiseAND(F.lit(SHIFT - 1)) - BIAS          # file position of the template's first word
            tw, weight, keys = F.element_at(all_words, t), F.element_at(all_weights, t), F.element_at(all_keys, t)
            begin = F.greatest(at - SLACK, F.lit(0)).cast("int")
            until = (at + F.size(tw) + SLACK).cast("int")
            window = F.concat(F.lit(" "), F.array_join(F.slice(ws, begin + 1, until - begin), " "), F.lit(" "))
            ok = F.forall(keys, lambda k: F.instr(window, F.concat(F.lit(" "), k, F.lit(" "))) > 0)
            # a word before the file's start counts as missing
            hit = F.transform(tw, lambda w, j: F.when((at + j >= 0) & F.get(ws, (at + j).cast("int")).eqNullSafe(w), F.element_at(weight, j + 1)).otherwise(0.0))
            total = F.aggregate(weight, F.lit(0.0), lambda s, x: s + x)
            share = F.aggregate(hit, F.lit(0.0), lambda s, x: s + x) / total
            return F.struct(ok.alias("ok"), at.alias("at"), F.element_at(all_labels, t).alias("label"), share.alias("score"),
                            t.alias("template"), (F.size(tw) + SLACK).alias("reach"))
        return F.filter(F.transform(cand, one), lambda x: x["ok"])

    def strongest(found: Column) -> Column:
        # key phrases may stand in the slack, so a weaker alignment beside a stronger one of its template is the same notice;
        # candidates are in order of template and place, so those in reach are near in the array
        near = max(len(t.words) for t in known) + SLACK

        def weaker(x: Column, i: Column) -> Column:
            around = F.slice(found, F.greatest(i + 1 - near, F.lit(1)), F.lit(2 * near + 1))
            return F.exists(around, lambda o: (o["template"] == x["template"]) & (F.abs(o["at"] - x["at"]) < x["reach"]) & (o["score"] > x["score"]))

        kept = F.filter(found, lambda x, i: ~weaker(x, i))
        return F.transform(kept, lambda x: F.struct(x["ok"].alias("ok"), x["at"].alias("at"), x["label"].alias("label"), x["score"].alias("score")))

    def votes(hits: Column) -> Column:
        each = F.flatten(F.transform(hits, lambda i: F.transform(F.element_at(postings, F.get(ws, i)), lambda c: c + i)))
        return F.array_sort(each)

    def twice(s: Column) -> Column:
        same = F.filter(F.sequence(F.lit(1), F.greatest(F.size(s) - 1, F.lit(1))), lambda k: F.get(s, k - 1) == F.get(s, k))
        return F.array_distinct(F.transform(same, lambda k: F.get(s, k)))

    hits = F.filter(F.sequence(F.lit(0), F.greatest(F.size(ws) - 1, F.lit(0))), lambda i: F.get(ws, i).isin(anchors))
    named = F.transform(F.transform(F.array(votes(hits)), lambda s: verified(twice(s))), strongest)
    kind = "array<struct<ok:boolean,at:bigint,label:string,score:double>>"
    # no template is verified in a text without all of its key phrases
    text = F.concat(F.lit(" "), F.array_join(ws, " "), F.lit(" "))
    any_keys = F.exists(F.array(text), lambda x: reduce(or_, [
        reduce(and_, [F.contains(x, F.lit(f" {k} ")) for k in t.keys]) for t in known]))
    return F.when(any_keys, F.element_at(named, 1)).otherwise(F.array().cast(kind))


def base_places(ws: Column) -> Column:
    """``array<struct(at, label)>``: word positions of the base phrases, in order."""
    def label(i: Column) -> Column:
        out = F.lit(None).cast("string")
        for phrase, name in BASE_PHRASES.items():
            match = F.lit(True)
            for j, w in enumerate(phrase.split()):
                match = match & (F.get(ws, i + j) == w)
            out = F.when(match, F.lit(name)).otherwise(out)
        return out

    rarest = ["cc", "general", "reserved"]      # each phrase has one of them
    places = F.filter(F.transform(F.sequence(F.lit(0), F.greatest(F.size(ws) - 1, F.lit(0))),
                                  lambda i: F.struct(i.cast("bigint").alias("at"), label(i).alias("label"))),
                      lambda p: p["label"].isNotNull())
    return F.when(F.arrays_overlap(ws, _strings(rarest)), places).otherwise(F.array().cast("array<struct<at:bigint,label:string>>"))


def find_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: list[Template] | None = None) -> DataFrame:
    """``(id_col, n_words, base, aligned)`` for every row of ``docs``.

    ``base`` has the places of the base phrases, ``aligned`` the verified
    templates with their word position, label and score.  Null and empty texts
    have none.  Repeated rows stay; other columns are ignored.  Document
    frequencies come from all rows of ``docs``.  ``known`` are the templates to
    look for, made by :func:`templates`; by default those of ``TEMPLATES``.
    """
    known = known or templates()
    weights = idf(*document_frequencies(docs, text_col, known), known)
    tokens = docs.select(F.col(id_col).alias("id"), words(F.col(text_col)).alias("ws"))
    ws = F.col("ws")
    return tokens.select(F.col("id").alias(id_col), F.size(ws).cast("long").alias("n_words"),
                         base_places(ws).alias("base"), alignments(ws, weights, known).alias("aligned"))
