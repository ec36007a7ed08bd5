"""License scans: an exact set-similarity join of text blocks with templates.

A block is a run of words of one line, ``SPAN`` times as many as the template has, or a run of words
across line ends, as many as the template has: a template may be wrapped, but words of unlike lines
that are further apart are no block. A template fits a block that holds at least ``CONTAINMENT`` of the template's distinct words, among them all of its
deciding words, those that tell its license from others. All words of all templates are ordered by
their frequency in the whole corpus, the rarest first. To share enough words with a template, a
block has to hold one of the template's few rarest words (prefix filter); the words around that one
have to have enough template words (length filter), none of them rarer (positional filter). What
passes is counted exactly. Words outside all templates cannot be shared and are left out first.

Besides, the places of fixed phrases are counted in whole texts, across lines.

Words are runs of digits, a-z and characters beyond ASCII, after A-Z is lower-cased. Null texts
count as empty and have no words, places or labels. Repeated rows give the same result each.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matrixq.llm.common import lower_ascii, written

CONTAINMENT = 0.8
#: A template's words stand within so many times its own number of words.
SPAN = 3
_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases that are searched in whole texts, by label (fixed values).
PHRASES = {
    "cc-by": "cc by",
    "gpl": "general public license",
    "reserved": "all rights reserved",
}
#: Usual license lines, by label.
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of "
            "this software and associated documentation files"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-4.0", "Licensed under a Creative Commons Attribution 4.0 International License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, "
            "are permitted"),
    ("all-rights-reserved", "All rights reserved"),
]
#: Words that must be there if a template of the label has them.
DECIDING = {
    "mit": ("mit", "permission", "granted"),
    "apache-2.0": ("apache", "2"),
    "gpl-3.0": ("gnu", "general", "public", "3"),
    "cc-by-nc-4.0": ("cc", "by", "nc", "4"),
    "cc-by-4.0": ("creative", "commons", "attribution", "4"),
    "bsd": ("redistribution", "permitted"),
    "all-rights-reserved": ("all", "rights", "reserved"),
}


def word_text(text: Column) -> Column:
    """The words with one space around each; a single space if there are none."""
    clean = F.regexp_replace(lower_ascii(F.coalesce(text, F.lit(""))), _NO_WORD, " ")
    return F.regexp_replace(F.concat(F.lit(" "), clean, F.lit(" ")), "  +", " ")


def words_of(text: str) -> list[str]:
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", text.lower())


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def phrase_places(spaced: Column, phrase: str) -> tuple[Column, Column, Column]:
    """How often the phrase occurs, and the first and the last place by words (or null)."""
    found = F.contains(spaced, F.lit(f" {phrase} "))
    pieces = F.split(spaced, f"(?<= ){phrase}(?= )")
    last = F.length(spaced) - F.length(F.element_at(pieces, -1)) - len(phrase)
    return (
        F.when(found, F.size(pieces) - 1).otherwise(0),
        F.when(found, _spaces(pieces[0]) - 1),
        F.when(found, _spaces(F.substring(spaced, F.lit(1), last)) - 1),
    )


def word_frequencies(texts: DataFrame, words: list[str]) -> dict[str, int]:
    """How often each of the given words, those of the templates, occurs in all texts."""
    each = texts.select(F.explode(F.split("__spaced", " ")).alias("word"))
    rows = each.where(F.col("word").isin(words)).groupBy("word").agg(F.count("*").alias("n"))
    return {r["word"]: r["n"] for r in rows.collect()}  # one row per template word at most


def _template_rows(templates: list[tuple[str, str]], rank: dict[str, int], containment: float,
                   deciding: dict[str, tuple[str, ...]], span: int) -> list[tuple]:
    """A row for each template and each word of its prefix: what a block can share first."""
    rows = []
    for label, text in templates:
        ordered = sorted(set(words_of(text)), key=rank.__getitem__)
        least = math.ceil(containment * len(ordered) - 1e-9)
        musts = [w for w in ordered if w in deciding.get(label, ())]
        wrap = len(words_of(text))
        rows += [
            (word, label, ordered, ordered[place:], musts, least, span * wrap, wrap, len(ordered))
            for place, word in enumerate(ordered[: len(ordered) - least + 1])
        ]
    return rows


def scan(df: DataFrame, text: str = "text", templates: list[tuple[str, str]] | None = None,
         phrases: dict[str, str] | None = None, containment: float = CONTAINMENT,
         deciding: dict[str, tuple[str, ...]] | None = None, span: int = SPAN) -> DataFrame:
    """Adds ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``,
    ``score`` and ``spans`` (label, line number from 0 and best share of the fitting blocks that
    begin in that line).

    Columns of these names are replaced. Templates are a list held by the caller, at most a few
    thousand words; they travel with the plan. ``text`` is not among the columns returned.
    """
    spark = df.sparkSession
    templates = TEMPLATES if templates is None else templates
    phrases = PHRASES if phrases is None else phrases
    deciding = DECIDING if deciding is None else deciding
    assert span >= 1, "a block has room for the template"
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
             "spans")
    kept = [c for c in df.columns if c not in (*names, text)]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    spaced = df.select(*[F.col(f"`{c}`") for c in kept], body.alias("__text"),
                       word_text(body).alias("__spaced"))

    vocabulary = sorted({w for _, t in templates for w in words_of(t)})
    often = word_frequencies(spaced, vocabulary)
    by_rarity = sorted(vocabulary, key=lambda w: (often.get(w, 0), w))
    rank = {w: k for k, w in enumerate(by_rarity)}
    rows = _template_rows(templates, rank, containment, deciding, span)
    prefixes = spark.createDataFrame(
        rows, "word string, label string, words array<string>, rest array<string>, "
        "musts array<string>, least int, reach int, wrap int, size int"
    )
    rare = sorted({row[0] for row in rows})
    most = max((row[6] for row in rows), default=0)

    def has_rare(words: Column) -> Column:
        return reduce(
            Column.__or__, [F.contains(words, F.lit(f" {w} ")) for w in rare], F.lit(False)
        )

    places = [phrase_places(F.col("__spaced"), p) for p in phrases.values()]
    hits = F.array_compact(F.array(
        *[F.when(n > 0, F.lit(label)) for label, (n, _, _) in zip(phrases, places)],
        F.lit(None).cast("string"),
    ))
    # The words of templates with their places, in texts that hold a rare one.
    lines = F.transform(
        F.split("__text", "\n"),
        lambda line, k: F.transform(
            F.filter(F.split(word_text(line), " "), lambda w: w != ""),
            lambda w: F.struct(k.alias("line"), w.alias("word")),
        ),
    )
    places_of_words = F.transform(
        F.flatten(lines), lambda w, k: F.struct(k.alias("at"), w["line"].alias("line"), w["word"].alias("word"))
    )
    held = F.filter(places_of_words, lambda w: w["word"].isin(vocabulary))
    read = written(
        spaced.select(
            *[F.col(f"`{c}`") for c in kept],
            F.xxhash64("__text").alias("__hash"),
            (_spaces(F.col("__spaced")) - 1).cast("long").alias("n_words"),
            reduce(Column.__add__, [n for n, _, _ in places], F.lit(0)).cast("long").alias("n_base"),
            F.array_min(F.array(*[f for _, f, _ in places], F.lit(None).cast("int")))
            .cast("long").alias("first_word"),
            F.array_max(F.array(*[x for _, _, x in places], F.lit(None).cast("int")))
            .cast("long").alias("last_word"),
            hits.alias("__base"),
            F.when(has_rare(F.col("__spaced")), held).alias("__held"),
        ), "license-scan",
    )

    # The join on rare words, each with the template words around it that a block can reach.
    texts = read.where(F.size("__held") > 0).select("__hash", "__held").dropDuplicates(["__hash"])
    around = F.transform("__held", lambda w, k: F.struct(
        w.alias("own"),
        F.when(w["word"].isin(rare), F.slice(
            "__held", F.greatest(k + 2 - most, F.lit(1)), F.least(k, F.lit(most - 1)) + most
        )).alias("near"),
    ))
    probes = texts.select(
        "__hash", F.explode(F.filter(around, lambda x: x["near"].isNotNull())).alias("probe")
    ).select("__hash", "probe.own", "probe.near", F.col("probe.own.word").alias("word"))
    near = F.filter("near", lambda w: (F.abs(w["at"] - F.col("own.at")) < F.col("reach"))
                    & F.array_contains("words", w["word"]))
    enough = F.size(F.array_intersect(F.col("near.word"), "rest")) >= F.col("least")
    blocks = (
        probes.join(F.broadcast(prefixes), "word")  # as many rows as the templates have words
        .withColumn("near", near).where(enough)
        .withColumn("begin", F.explode(F.filter("near", lambda w: w["at"] <= F.col("own.at"))))
        .withColumn("block", F.transform(
            F.filter("near", lambda w: (w["at"] >= F.col("begin.at")) & (
                w["at"] < F.col("begin.at")
                + F.when(w["line"] == F.col("begin.line"), F.col("reach")).otherwise(F.col("wrap"))
            )),
            lambda w: w["word"],
        ))
        .withColumn("shared", F.size(F.array_distinct("block")))
        .where((F.col("shared") >= F.col("least")) & (F.size(F.array_except("musts", "block")) == 0))
    )
    # A block does not begin with a word that comes again before the last new word of the block.
    again = F.array_position(F.slice("block", 2, F.lit(1 << 30)), F.col("begin.word")).cast("int")
    needed = (again == 0) | (
        F.size(F.array_distinct(F.slice("block", F.lit(1), F.greatest(again, F.lit(1))))) == F.col("shared")
    )
    fitting = blocks.where(needed).groupBy("__hash", "label", F.col("begin.line").alias("line")).agg(
        F.max(F.col("shared") / F.col("size")).alias("share")
    )
    found = fitting.groupBy("__hash").agg(
        F.collect_list(F.struct("label", "line", "share")).alias("spans")
    )
    # A text in any number of copies is looked up once, and each copy finds its own result.
    joined = read.join(found, "__hash", "left")
    own = F.coalesce(F.transform("spans", lambda s: s["label"]), F.array().cast("array<string>"))
    best = F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0))
    return joined.select(
        *[F.col(f"`{c}`") for c in kept], "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("__base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("__base", own)), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(best).alias("score"),
        F.array_sort("spans").alias("spans"),
    )
