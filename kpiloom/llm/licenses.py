"""License scans by a positional index of rare words.

Templates of licences are indexed by word and position, and licence words are
ranked by how few documents hold them. For each template whose mandatory phrase
stands in a text, the words of the text that the template has are looked up in
the index, and each hit votes for the place where the template would begin. The
template becomes a label if, to within ``SLACK`` words, one place has the votes
of enough of the ``LOOKED_UP`` rarest of these words, or of enough of all the
template's words. Ranks are by template and leave no word out, so neither a
licence that many documents hold, nor a small table, nor another licence or
ordinary words in the same text take a template's votes away.

The base phrases are found wherever their words stand one after the other.

Everything is DataFrame functions. The templates are fixed values, so their
index and the counts of their words are of fixed size. Every text is split into
words, in its row; places leave the row only for texts that hold a base or a
mandatory phrase, without which there is no label.

A null text is empty; a null id is passed on; a repeated row is scanned again;
an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import let, stored

#: The base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Telling passages of public licences, in lower-case words, and
#: the phrase without which a text is not under the licence.
TEMPLATES = {
    "agpl": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation",
        "affero general public license",
    ),
    "apache-2.0": (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 "
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis",
        "apache license",
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
        "redistribution and use in source and binary forms",
    ),
    "cc-by-nc": ("this work is licensed under a creative commons attribution noncommercial license licensed under cc by nc 4 0", "cc by nc"),
    "cc-by-sa": ("this work is licensed under a creative commons attribution sharealike license licensed under cc by sa 4 0", "cc by sa"),
    "gpl-3.0": (
        "this work is licensed under the gnu general public license version 3 you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license",
        "general public license version 3",
    ),
    "mit": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",
        "permission is hereby granted free of charge",
    ),
    "mpl-2.0": ("this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at", "mozilla public license"),
}

#: Rarest words of a template, of those in a document, that can decide alone.
LOOKED_UP = 8
#: Words by which hits of one place may differ.
SLACK = 2
#: Least part of a template's rarest or of all its words that must agree, and their least number.
AGREE, LEAST = 0.5, 2

WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_BETWEEN = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SOUGHT = [*PHRASES, *sorted({p for _, p in TEMPLATES.values()} - set(PHRASES))]
VOCABULARY = sorted({w for t, _ in TEMPLATES.values() for w in t.split()} | {w for p in SOUGHT for w in p.split()})
#: Whether a text may hold a phrase; only A-Z and a-z are alike.
_WORTH = "(?i)" + "|".join(p.replace(" ", _BETWEEN) for p in SOUGHT)


def _places(words: Column, phrase: str) -> Column:
    """Where the phrase's words stand one after the other, given licence words
    with their places."""
    first, *rest = phrase.split(" ")

    def follows(i: Column) -> Column:
        ok = F.get(words, i)["w"] == first
        for k, word in enumerate(rest, 1):
            then = F.get(words, i + k)
            ok = ok & F.coalesce((then["w"] == word) & (then["at"] == F.get(words, i)["at"] + k), F.lit(False))
        return ok

    all_at = F.transform(words, lambda x, i: F.when(follows(i), x["at"]))
    return F.filter(all_at, lambda at: at.isNotNull())


def scanned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, doc (the row's hash), n_words, the distinct licence words, and, of
    texts that hold a phrase, licence words with places and the phrases' places."""
    whole = F.coalesce(F.col(text), F.lit(""))
    words = F.regexp_extract_all(F.translate(whole, _UPPER, _LOWER), F.lit(WORD), F.lit(0))
    worth = F.regexp_like(whole, F.lit(_WORTH))

    def licence_words(split: Column) -> Column:
        placed = F.transform(split, lambda w, i: F.when(w.isin(*VOCABULARY), F.struct(w.alias("w"), i.cast("long").alias("at"))))
        return F.filter(placed, lambda x: x.isNotNull())

    def found(split: Column) -> Column:
        places = let(licence_words(split), lambda x: F.struct(x.alias("words"), F.array(*[_places(x, p) for p in SOUGHT]).alias("places")))
        return F.struct(
            F.size(split).cast("long").alias("n_words"),
            F.array_intersect(split, F.array(*[F.lit(w) for w in VOCABULARY])).alias("seen"),
            F.when(F.col("worth"), places).alias("licence"),
        )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(doc_id, text).alias("doc"), worth.alias("worth"), words.alias("split"))
    rows = rows.select("doc_id", "doc", let(F.col("split"), found).alias("f"))
    return rows.select("doc_id", "doc", "f.n_words", "f.seen", "f.licence.words", "f.licence.places")


def rarest_first(rows: DataFrame) -> list[str]:
    """The licence words by how few documents hold them, which is their order by
    idf; a row per word of ``VOCABULARY`` at most is collected."""
    held = dict(rows.select(F.explode("seen").alias("w")).groupBy("w").agg(F.count("*").alias("docs")).collect())
    return sorted(VOCABULARY, key=lambda w: (held.get(w, 0), w))


def proposals(rows: DataFrame) -> DataFrame:
    """(doc, template, share): templates whose words agree on a place."""
    spark = rows.sparkSession
    order = rarest_first(rows)
    split = {t: text.split() for t, (text, _) in sorted(TEMPLATES.items())}
    index = [(t, w, i) for t, words in split.items() for i, w in enumerate(words)]
    index = F.broadcast(spark.createDataFrame(index, "template string, w string, place long"))
    sought = []
    for t, words in split.items():
        # array_intersect keeps the order of its first array.
        rare = F.slice(F.array_intersect(F.array(*[F.lit(w) for w in order if w in words]), F.col("seen")), 1, LOOKED_UP)
        asked = F.struct(F.lit(t).alias("template"), F.lit(len(set(words))).alias("n_words"), rare.alias("rare"))
        sought.append(F.when(F.size(F.get("places", SOUGHT.index(TEMPLATES[t][1]))) > 0, asked))
    asked = rows.where("words is not null").select("doc", "words", F.explode(F.array_compact(F.array(*sought))).alias("t")).select("doc", "t.*", "words")
    placed = asked.select("doc", "template", "n_words", "rare", F.explode("words").alias("x")).select("doc", "template", "n_words", F.size("rare").alias("n_rare"), F.array_contains("rare", F.col("x.w")).alias("is_rare"), "x.w", "x.at")
    hits = placed.join(index, ["template", "w"])
    # Two places that differ by SLACK or less share one of these.
    step = F.floor((F.col("at") - F.col("place")) / (SLACK + 1))
    votes = hits.withColumn("near", F.explode(F.array(step, step + 1))).select("doc", "template", "n_words", "n_rare", "near", "w", "is_rare").distinct()
    agreed = votes.groupBy("doc", "template", "n_words", "n_rare", "near").agg(F.count("*").alias("every"), F.count_if("is_rare").alias("rare"))
    shares = [F.when(F.col(n) >= LEAST, F.col(n) / F.col(of)) for n, of in (("every", "n_words"), ("rare", "n_rare"))]
    best = agreed.groupBy("doc", "template").agg(F.max(F.greatest(*shares)).alias("share"))
    return best.where(F.col("share") >= AGREE)


def licences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, base (label, place) in order of place, and the method's
    (label, share) with their score."""
    rows = stored(scanned(docs, doc_id, text), "licence-words")
    proposed = proposals(rows).groupBy("doc").agg(F.collect_set(F.struct("template", "share")).alias("proposed"))
    joined = rows.join(proposed, "doc", "left")
    at = {p: F.get("places", i) for i, p in enumerate(SOUGHT)}
    labelled = [F.transform(F.coalesce(at[p], F.array().cast("array<bigint>")), _labelled(label)) for p, label in PHRASES.items()]
    stands = [F.when(F.size(at[p]) > 0, F.lit(t)) for t, (_, p) in sorted(TEMPLATES.items())]
    confirmed = F.filter(F.coalesce("proposed", F.array().cast("array<struct<template: string, share: double>>")), lambda x: F.array_contains(F.array_compact(F.array(*stands)), x["template"]))
    return joined.select("doc_id", "n_words", F.sort_array(F.concat(*labelled)).alias("base"), F.sort_array(confirmed).alias("licences"))


def _labelled(label: str):
    def pair(place: Column) -> Column:
        return F.struct(place.alias("place"), F.lit(label).alias("label"))

    return pair


def digest(rows: DataFrame) -> DataFrame:
    labels = F.array_distinct(F.transform("base", lambda x: x["label"]))
    templates = F.transform("licences", lambda x: x["template"])
    places = F.transform("base", lambda x: x["place"])
    return rows.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        F.array_join(F.sort_array(labels), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union(labels, templates)), ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("licences", lambda x: x["share"])), F.lit(0.0)).alias("score"),
    )
