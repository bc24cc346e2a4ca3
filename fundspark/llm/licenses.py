"""License notices by diagonal voting, in DataFrame functions only.

All rolling word k-grams of a text are joined by hash to the positions of the same k-grams in known
notices. A hit lies on the diagonal text position minus notice position; a copied passage puts its
hits on one diagonal, or on a few neighbouring ones if words were added or left out. Hits are
counted per diagonal, neighbouring diagonals are merged, and a span counts when the grams it shares
with the notice, compared as words, cover enough of it. Notices that differ in a word or two all
cover the same passage; of spans that overlap only those count that cover most of their notice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fundspark.operators.lineage import materialise
from fundspark.operators.skew import all_of

GRAM = 3
NEIGHBOUR = 3
COVER = 0.75
# Words of text that overlapping spans are looked for in at a time.
STRETCH = 64

# Phrases whose every place is reported, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Published notices, and the label of each.
NOTICES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files"),
    ("mit", "Released under the MIT License"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain "
                   "a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free "
             "Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are "
            "permitted provided that the following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International "
                  "License"),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
                     "International License"),
)

KELVIN, OTHER_LETTER = "\u212a", "\u212b"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def license_words(text: Column) -> Column:
    """Words of a text with A-Z in lower case, in order; empty for NULL.

    Letters beyond A-Z change too, which affects neither the number of words nor a match with words
    of plain ASCII: the one letter that would become such, the Kelvin sign, is replaced by another.
    """
    plain = F.replace(F.coalesce(text.cast("string"), F.lit("")), F.lit(KELVIN), F.lit(OTHER_LETTER))
    lowered = F.lower(plain)
    return F.array_remove(F.split(lowered, _BETWEEN), "")


def notice_words(text: str) -> list[str]:
    plain = "".join(c if c.isalnum() else " " for c in text.lower())
    return plain.split()


def template_grams(spark: SparkSession, notices=NOTICES) -> DataFrame:
    """``hash, places``: the notice positions of every k-gram; as many rows as words in notices."""
    rows = []
    for template, (label, text) in enumerate(notices):
        words = notice_words(text)
        grams = len(words) - GRAM + 1
        for at in range(grams):
            rows.append((template, label, at, grams, *words[at : at + GRAM]))
    grams = [f"t{i}" for i in range(GRAM)]
    schema = "template int, label string, at int, grams int, " + ", ".join(f"{g} string" for g in grams)
    table = spark.createDataFrame(rows, schema)
    place = F.struct("template", "label", "at", "grams")
    return table.groupBy(F.xxhash64(*grams).alias("hash"), *grams).agg(
        F.collect_list(place).alias("places")
    )


def _phrase_places(words: Column) -> Column:
    """``(start, label)`` of every place where a phrase stands; looks closer only at candidates."""
    size = F.size(words)

    def at(start: Column) -> Column:
        found = None
        for phrase, label in PHRASES.items():
            parts = phrase.split()
            here = None
            for i, part in enumerate(parts):
                same = F.get(words, start + i) == part
                here = same if here is None else here & same
            found = F.when(here, F.lit(label)) if found is None else found.when(here, F.lit(label))
        return F.struct(start.cast("long").alias("start"), found.alias("label"))

    places = F.filter(
        F.transform(F.sequence(F.lit(0), size - 1), at), lambda p: p["label"].isNotNull()
    )
    firsts = sorted({phrase.split()[0] for phrase in PHRASES})
    lasts = sorted({phrase.split()[-1] for phrase in PHRASES})
    maybe = F.arrays_overlap(words, F.array(*map(F.lit, lasts))) & F.arrays_overlap(
        words, F.array(*map(F.lit, firsts))
    )
    none = F.array().cast("array<struct<start:bigint,label:string>>")
    return F.when((size > 1) & maybe, places).otherwise(none)


def notice_spans(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", notices=NOTICES
) -> DataFrame:
    """Spans of known notices: ``doc_id, text_hash, label, first, last, cover``.

    Only rows that share a gram with a notice are shuffled.
    """
    grams = [f"w{i}" for i in range(GRAM)]
    words = license_words(F.col(text_col))
    base = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"),
        words.alias("w0"),
    )
    for i in range(1, GRAM):
        base = base.withColumn(f"w{i}", F.slice("w0", i + 1, F.greatest(F.size("w0"), F.lit(1))))
    rolling = base.select("doc_id", "text_hash", F.posexplode(F.arrays_zip(*grams)).alias("pos", "g"))
    rolling = rolling.select("doc_id", "text_hash", "pos", *[F.col(f"g.{g}").alias(g) for g in grams])
    rolling = rolling.where(F.col(grams[-1]).isNotNull()).withColumn("hash", F.xxhash64(*grams))
    known = F.broadcast(template_grams(docs.sparkSession, notices))
    hits = rolling.join(known, "hash")
    for i in range(GRAM):
        hits = hits.where(F.col(f"w{i}") == F.col(f"t{i}"))
    hits = hits.select("doc_id", "text_hash", "pos", F.explode("places").alias("place"))
    hits = hits.select("doc_id", "text_hash", "pos", "place.*").distinct()
    who = ["doc_id", "text_hash", "template", "label", "grams"]
    diagonals = hits.withColumn("diagonal", F.col("pos") - F.col("at")).groupBy(*who, "diagonal").agg(
        F.count(F.lit(1)).alias("votes"),
        F.min("pos").alias("first"),
        F.max("pos").alias("last"),
        F.collect_set("at").alias("met"),
    )
    ordered = Window.partitionBy("doc_id", "text_hash", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(ordered) > NEIGHBOUR
    opened = diagonals.withColumn("opens", F.coalesce(gap, F.lit(True)).cast("int"))
    spans = opened.withColumn("span", F.sum("opens").over(ordered)).groupBy(*who, "span").agg(
        F.min("first").alias("first"),
        (F.max("last") + GRAM - 1).alias("last"),
        F.sum("votes").alias("votes"),
        F.size(F.array_distinct(F.flatten(F.collect_list("met")))).alias("met"),
    )
    cover = F.col("met").cast("double") / F.col("grams")
    spans = spans.withColumn("cover", cover).where(F.col("cover") >= COVER)
    found = spans.select("doc_id", "text_hash", "template", "label", "first", "last", "met", "cover")
    return best_spans(materialise(found, "license-spans"))


def best_spans(spans: DataFrame) -> DataFrame:
    """Without spans that another notice's span overlaps with more cover, or as much and more grams.

    Spans meet in stretches of text, so a text with any number of notices costs no task more than
    the few that lie near each other. Spans of one label do not rule each other out.
    """
    stretch = F.explode(F.sequence(F.floor(F.col("first") / STRETCH), F.floor(F.col("last") / STRETCH)))
    placed = spans.withColumn("stretch", stretch)
    other = placed.select(
        F.col("doc_id").alias("__d"), F.col("text_hash").alias("__t"), F.col("stretch").alias("__s"),
        F.col("label").alias("__label"), F.col("first").alias("__first"), F.col("last").alias("__last"),
        F.struct("cover", "met").alias("__rank"),
    ).distinct()
    beaten = placed.join(
        other,
        placed["doc_id"].eqNullSafe(other["__d"])
        & placed["text_hash"].eqNullSafe(other["__t"])
        & (placed["stretch"] == other["__s"])
        & (placed["label"] != other["__label"])
        & (placed["first"] <= other["__last"])
        & (other["__first"] <= placed["last"])
        & (F.struct(placed["cover"], placed["met"]) < other["__rank"]),
        "left_semi",
    )
    key = ["doc_id", "text_hash", "template", "label", "first", "last", "met", "cover"]
    gone = beaten.select(*[F.col(c).alias(f"__g_{c}") for c in key]).distinct()
    same = [spans[c].eqNullSafe(gone[f"__g_{c}"]) for c in key]
    return spans.join(gone, all_of(same), "left_anti")


def scan_licenses(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", notices=NOTICES
) -> DataFrame:
    """Per row of docs: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``score`` is the largest share of a notice found, and 1 where a phrase stands. A NULL or empty
    text has no words, no places, empty label lists and score 0. Rows that repeat an id keep their
    own results. Other columns are not read.
    """
    words = license_words(F.col(text_col))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"), words.alias("words")
    )
    rows = rows.select(
        "doc_id", "text_hash", F.size("words").cast("long").alias("n_words"),
        _phrase_places(F.col("words")).alias("places"),
    )
    rows = rows.select(
        "doc_id", "text_hash", "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.start").alias("first_word"),
        F.array_max("places.start").alias("last_word"),
        F.array_sort(F.array_distinct("places.label")).alias("base"),
    )
    spans = notice_spans(docs, id_col=id_col, text_col=text_col, notices=notices)
    found = spans.groupBy(F.col("doc_id").alias("__d"), F.col("text_hash").alias("__t")).agg(
        F.collect_set("label").alias("found"), F.max("cover").alias("cover")
    )
    joined = rows.join(
        found, rows["doc_id"].eqNullSafe(found["__d"]) & (rows["text_hash"] == found["__t"]), "left"
    )
    nothing = F.array().cast("array<string>")
    labels = F.array_sort(F.array_union("base", F.coalesce("found", nothing)))
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("cover", F.lit(0.0))).alias("score"),
    )
