"""Licence scan: a positional index of rare licence words over notice templates."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.llm.shared import ascii_lower, stored, text_of

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Fixed values of the base scan: phrase and label.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Notices: label, text, and the key phrases that must stand at their place in it.
TEMPLATES = (
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", ("hereby granted free of charge", "without restriction")),
    ("apache", "licensed under the apache license version 2 0", ("licensed under the apache license",)),
    ("apache", "licensed under the apache license version 2 0 you may not use this file except in compliance with the license", ("licensed under the apache license",)),
    ("gpl", "this work is licensed under the gnu general public license version 3", ("gnu general public license",)),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ("gnu general public license", "redistribute it and or modify it")),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", ("lesser general public license",)),
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation", ("affero general public license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("source and binary forms", "following conditions are met")),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee is hereby granted",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software released into the public domain",)),
)
#: Words of fewer letters are in the index only as part of a key phrase, and these never.
LEAST_LETTERS = 5
COMMON = frozenset("a and any are be by fee for free in into is it met of or that the this to with".split())


def _phrase_words() -> list[str]:
    return sorted(({w for p, _ in BASE for w in p.split()} | {w for _, _, ps in TEMPLATES for p in ps for w in p.split()}) - COMMON)


def offset(text: str, phrase: str) -> int:
    """Place in the text of the phrase's first word that is in the index."""
    at = f" {text} ".index(f" {phrase} ")
    return len(text[:at].split()) + next(j for j, w in enumerate(phrase.split()) if w not in COMMON)


def vocabulary() -> list[str]:
    return sorted({w for _, t, _ in TEMPLATES for w in t.split() if len(w) >= LEAST_LETTERS} | set(_phrase_words()))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), 0)


def scanned(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, th (hash of the whole text), n_words, and ``hits``,
    the licence words at their positions."""
    rows = docs.select("doc_id", F.xxhash64(text_of()).alias("th"), words_of(text_of()).alias("w"))
    hits = F.filter(F.transform("w", lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: x["w"].isin(vocabulary()))
    return rows.select("doc_id", "th", F.size("w").cast("long").alias("n_words"), hits.alias("hits"))


def phrase_at(hits: Column, phrase: str) -> Column:
    """Places of a phrase's first indexed word where all its indexed words stand at their
    distances. They are neighbours among the hits, as no word between them is indexed."""
    ws = [(j, w) for j, w in enumerate(phrase.split()) if w not in COMMON]

    def starts(x: Column, k: Column) -> Column:
        out = x["w"] == ws[0][1]
        for n, (j, w) in enumerate(ws[1:], 1):
            y = F.get(hits, k + n)
            out = out & F.coalesce((y["w"] == w) & (y["i"] == x["i"] + (j - ws[0][0])), F.lit(False))
        return out

    return F.transform(F.filter(hits, starts), lambda x: x["i"])


def word_weights(rows: DataFrame) -> dict[str, float]:
    """IDF over all documents of each licence word; at most one row a vocabulary word."""
    each = rows.select(F.explode(F.array_distinct(F.transform("hits", lambda x: x["w"]))).alias("w"))
    df = {r["w"]: r["n"] for r in each.groupBy("w").agg(F.count("*").alias("n")).collect()}
    n = rows.count()
    return {w: round(math.log(1 + n / (1 + df.get(w, 0))), 6) for w in vocabulary()}


def license_labels(rows: DataFrame, top: int = 8, least_share: float = 0.5) -> DataFrame:
    """Per document with an aligned notice: doc_id, th, ``found`` (labels) and ``score``.

    All licence words of a document are looked up in the index, whose size the templates bound,
    so it is broadcast: a notice is judged by its own words, whatever else the document holds.
    Postings that agree on the shift between document and template are one alignment; its score
    is its weight as a share (1 at most) of the template's ``top`` words by IDF, and it counts
    from ``least_share``, if all key phrases stand at their places."""
    idf = word_weights(rows)
    postings, totals = [], {}
    for t, (_, text, _) in enumerate(TEMPLATES):
        own = [(w, p) for p, w in enumerate(text.split()) if w in idf]
        totals[t] = sum(sorted((idf[w] for w, _ in own), reverse=True)[:top])
        postings += [(w, t, p, idf[w]) for w, p in own]
    index = F.broadcast(_literal(rows.sparkSession, postings))
    lookups = rows.where(F.size("hits") > 1).select("doc_id", "th", F.explode("hits").alias("x"))
    votes = lookups.select("doc_id", "th", F.col("x.w").alias("w"), F.col("x.i").alias("i")).join(index, "w")
    shifts = votes.groupBy("doc_id", "th", "t", (F.col("i") - F.col("p")).alias("shift")).agg(F.sum("weight").alias("got"), F.count("*").alias("n"))
    share = F.least(F.lit(1.0), F.col("got") / F.element_at(F.create_map(*[F.lit(x) for p in totals.items() for x in p]), F.col("t")))
    shifts = shifts.where("n > 1").withColumn("share", F.round(share, 6)).where(F.col("share") >= least_share)
    aligned = shifts.groupBy("doc_id", "th").agg(F.collect_set(F.struct("t", "shift", "share")).alias("a"))
    checked = aligned.join(rows.select("doc_id", "th", "hits").distinct().where(F.size("hits") > 1).select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), "hits"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")))

    def stands(a: Column) -> Column:
        out = F.lit(False)
        for t, (_, text, phrases) in enumerate(TEMPLATES):
            ok = a["t"] == t
            for p in phrases:
                ok = ok & F.array_contains(phrase_at(F.col("hits"), p), a["shift"] + offset(text, p))
            out = out | ok
        return out

    names = F.create_map(*[F.lit(x) for t, (label, _, _) in enumerate(TEMPLATES) for x in (t, label)])
    good = F.filter("a", stands)
    best = F.array_max(F.transform("good", lambda a: a["share"]))
    found = F.array_distinct(F.transform("good", lambda a: F.element_at(names, a["t"])))
    return checked.withColumn("good", good).where(F.size("good") > 0).select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), found.alias("found"), best.alias("score"))


def _literal(spark: SparkSession, postings: list[tuple]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(w).alias("w"), F.lit(t).alias("t"), F.lit(p).alias("p"), F.lit(x).alias("weight")) for w, t, p, x in postings])
    return spark.range(1).select(F.inline(rows))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score.

    A null text is empty: no words, no labels, score 0. Repeated rows give repeated results;
    other columns are not read; an empty table gives no rows. Words are counted, and word
    weights taken, over all whole texts."""
    rows = stored(scanned(docs), "license-words")
    labels = license_labels(rows)
    out = rows.join(labels, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left")
    for k, (phrase, _) in enumerate(BASE):
        out = out.withColumn(f"p{k}", phrase_at(F.col("hits"), phrase))
    places = F.concat(*[F.col(f"p{k}") for k in range(len(BASE))])
    base = F.array_compact(F.array(*[F.when(F.size(f"p{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(BASE)]))
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    none = F.array().cast("array<string>")
    return out.withColumns({"at": places, "base": base}).select(
        "doc_id",
        "n_words",
        F.size("at").cast("long").alias("n_base"),
        F.array_min("at").cast("long").alias("first_word"),
        F.array_max("at").cast("long").alias("last_word"),
        joined(F.col("base")).alias("base_labels"),
        joined(F.concat("base", F.coalesce("found", none))).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
