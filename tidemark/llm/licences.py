"""Find licence notices with a positional index of rare licence words.

Of each template the words that are rarest in the corpus (highest inverse document frequency over
all documents) are indexed with their positions. A file is scanned for indexed words; all of them are
looked up, and each occurrence proposes that a template begins a fixed number of words before it.
A proposal holds if enough of the template's words stand at their relative positions and its mandatory
phrase stands there whole; if the rarest word of the phrase is not at its place, it is dropped at once.

Everything about a file happens in its own row: there is no join and no shuffle but that of the
document frequencies, which has a row per template word and task. Words are runs of ASCII letters
and digits and of any other characters beyond ASCII, with A-Z in lower case.

Defined results: a null or empty text has no words, no labels and the score 0; a phrase counts at every
place, overlapping ones too; equal rows give equal results; in a corpus without documents all
template words are equally rare; columns of the input are kept, those named like a result are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import ascii_lower, private

#: How many of a template's rarest words are indexed.
INDEXED = 6
#: The share of a template's words that must stand at their places.
SHARE = 0.8
#: The score of a file in which only a bare phrase was found.
PHRASE_SCORE = 0.5

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrase: str

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def phrase_at(self) -> int:
        words, phrase = self.words, self.phrase.split()
        return next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase)


# The wording of common licence notices, sentence by sentence.
TEMPLATES = (
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2"),
    Template("apache-2.0", "you may not use this file except in compliance with the license", "compliance with the license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    Template("cc-by-4.0", "licensed under cc by 4 0", "cc by 4"),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4"),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4"),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    Template("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license", "gnu general public license"),
    Template("mit", "released under the mit license", "mit license"),
    Template("mit", "licensed under the mit license", "mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
)

# Bare phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))


def words_of(text: Column) -> Column:
    """The words of a text as an array. Only A-Z are lowered: ``lower`` would make a Kelvin sign a k."""
    spaced = F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS, " "))
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " "))


def document_frequencies(docs: DataFrame, text: str = "text", templates: Sequence[Template] = TEMPLATES) -> tuple[int, dict[str, int]]:
    """The number of documents, and of those that hold each word of a template."""
    vocabulary = sorted({w for t in templates for w in t.words})
    found = (
        docs.select(F.explode(F.array_intersect(words_of(F.col(text)), F.lit(vocabulary))).alias("word"))
        .groupBy("word")
        .count()
    )
    return docs.count(), {r[0]: r[1] for r in found.collect()}  # a row per template word


def rarest(words: Sequence[str], total: int, frequency: dict[str, int], most: int) -> list[str]:
    """The words of highest inverse document frequency; ties by the word."""
    idf = {w: math.log((1 + total) / (1 + frequency.get(w, 0))) for w in set(words)}
    return sorted(idf, key=lambda w: (-idf[w], w))[:most]


def _at(words: Column, place: Column, wanted: Sequence[str]) -> Column:
    """How many of ``wanted`` stand at their places in ``words`` from ``place`` on."""
    found = F.lit(0)
    for i, word in enumerate(wanted):
        found = found + F.when(F.get(words, place + i) == word, 1).otherwise(0)
    return found


def _all_at(words: Column, place: Column, wanted: Sequence[str]) -> Column:
    whole = F.get(words, place) == wanted[0]
    for i, word in enumerate(wanted[1:], 1):
        whole = whole & (F.get(words, place + i) == word)
    return F.coalesce(whole, F.lit(False))


def _joined(labels: Column) -> Column:
    return F.concat_ws(",", F.array_sort(F.array_distinct(labels)))


def scan(
    docs: DataFrame,
    *,
    text: str = "text",
    templates: Sequence[Template] = TEMPLATES,
    phrases: Sequence[tuple[str, str]] = PHRASES,
    frequencies: tuple[int, dict[str, int]] | None = None,
) -> DataFrame:
    """``docs`` with the words of each text, the places of bare phrases, labels and a score."""
    total, frequency = frequencies or document_frequencies(docs, text, templates)
    index: dict[str, list[tuple[int, int, int, str]]] = {}
    for number, template in enumerate(templates):
        phrase = template.phrase.split()
        sure = rarest(phrase, total, frequency, 1)[0]
        sure_at = template.phrase_at + phrase.index(sure)
        for word in rarest(template.words, total, frequency, INDEXED):
            places = [(number, at, sure_at - at, sure) for at, w in enumerate(template.words) if w == word]
            index.setdefault(word, []).extend(places)
    heads = {p.split()[0] for p, _ in phrases}
    scanned = sorted(heads | set(index))

    results = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    out = docs.drop(*results)
    ws, hits, base, proposals, proven = (private(out, f"licence_{c}") for c in ("words", "hits", "base", "proposals", "proven"))
    out = out.withColumn(ws, words_of(F.col(text)))
    word_at = lambda i: F.get(F.col(ws), i)
    everywhere = F.when(F.size(ws) > 0, F.sequence(F.lit(0), F.size(ws) - 1)).otherwise(F.array().cast("array<int>"))
    out = out.withColumn(hits, F.filter(everywhere, lambda i: word_at(i).isin(scanned)))

    def phrase_places(phrase: str, label: str) -> Column:
        places = F.filter(F.col(hits), lambda i: _all_at(F.col(ws), i, phrase.split()))
        return F.transform(places, lambda i: F.struct(i.alias("at"), F.lit(label).alias("label")))

    out = out.withColumn(base, F.concat(*(phrase_places(*p) for p in phrases)))

    # What each occurrence of an indexed word proposes: no word of one template keeps out another's.
    def posting(number: int, at: int, ahead: int, sure: str) -> Column:
        return F.struct(F.lit(number).alias("t"), F.lit(at).alias("at"), F.lit(ahead).alias("ahead"), F.lit(sure).alias("sure"))

    postings = F.create_map(*(x for w, places in index.items() for x in (F.lit(w), F.array(*(posting(*p) for p in places)))))

    def proposed(i: Column) -> Column:
        mine = F.coalesce(F.try_element_at(postings, word_at(i)), F.array().cast("array<struct<t:int,at:int,ahead:int,sure:string>>"))
        likely = F.filter(mine, lambda p: word_at(i + p["ahead"]) == p["sure"])
        return F.transform(likely, lambda p: (p["t"].cast("long") * (1 << 32) + i - p["at"] + 1024))

    out = out.withColumn(proposals, F.when(F.size(hits) > 0, F.array_distinct(F.flatten(F.transform(F.col(hits), proposed)))))

    def proof(number: int, template: Template) -> Column:
        """The best share of the template's words at a proposed place that has its phrase; or null."""
        mine = F.filter(F.col(proposals), lambda p: F.shiftright(p, 32) == number)
        places = F.transform(mine, lambda p: (p % (1 << 32) - 1024).cast("int"))
        phrase = template.phrase.split()
        whole = F.filter(places, lambda i: _all_at(F.col(ws), i + template.phrase_at, phrase))
        share = F.array_max(F.transform(whole, lambda i: _at(F.col(ws), i, template.words) / len(template.words)))
        return F.struct(F.lit(template.label).alias("label"), share.alias("share"))

    every = F.array(*(proof(n, t) for n, t in enumerate(templates)))
    none = F.array().cast("array<struct<label:string,share:double>>")
    enough = F.when(F.size(proposals) > 0, F.filter(every, lambda p: p["share"] >= SHARE)).otherwise(none)
    out = out.withColumn(proven, enough)

    found = F.col(base)["label"]
    return out.select(
        *(F.col(f"`{c}`") for c in docs.drop(*results).columns),
        F.size(ws).cast("long").alias("n_words"),
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.col(base)["at"]).cast("long").alias("first_word"),
        F.array_max(F.col(base)["at"]).cast("long").alias("last_word"),
        _joined(found).alias("base_labels"),
        _joined(F.concat(found, F.col(proven)["label"])).alias("labels"),
        F.coalesce(
            F.array_max(F.col(proven)["share"]), F.when(F.size(base) > 0, PHRASE_SCORE).otherwise(0.0)
        ).alias("score"),
    )
