import random
import re

import brute
from tidemark.llm import licences

PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def plain(text):
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", brute.ascii_lower(text or ""))
    found = [(i, label) for p, label in PHRASES.items() for i in range(len(ws)) if ws[i : i + len(p.split())] == p.split()]
    at = [i for i, _ in found]
    return len(ws), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


TEXTS = [
    "Released under the MIT License. mit license MIT license",
    "general public license general public license apache  license",
    "Licensed under the Apache License, Version 2.0. and then some",
    brute.prose(1, 50) + " This work is licensed under the GNU General Public License, version 3. " + brute.prose(2, 50),
    "licensed under cc by nc 4.0", "licensed under the license of the house", "mit", "license mit", "MIT-license", "İ mit license K",
    "under the apache license version 3", brute.prose(3, 300), "", None, "...",
    " ".join(["licensed under the mit license"] * 500),
]


def test_phrases_against_brute_force(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    for r in licences.scan(df).collect():
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == plain(r["text"])
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) | {""}
        assert 0 <= r["score"] <= 1


def test_templates(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    found = {r["doc_id"]: (r["labels"], r["score"]) for r in licences.scan(df).collect()}
    assert found[0] == ("mit", 1.0)
    assert found[2] == ("apache,apache-2.0", 1.0)
    assert found[3] == ("gpl,gpl-3.0", 1.0)
    assert found[4] == ("cc-by-nc-4.0", 1.0)
    assert found[5] == found[11] == found[12] == found[13] == ("", 0.0)
    assert found[15] == ("mit", 1.0)


def test_words_may_be_missing_but_not_the_phrase(spark):
    near = "you may not use these files except in compliance with the license"
    gone = "you may not use this file except in observance of the license"
    df = spark.createDataFrame([(1, near), (2, gone)], "doc_id long, text string")
    found = {r["doc_id"]: r["labels"] for r in licences.scan(df).collect()}
    assert found == {1: "apache-2.0", 2: ""}


def test_no_template_keeps_out_another(spark):
    """All notices in one text, in either order, amid all indexed words; and each of two that come last."""
    every = [t.text for t in licences.TEMPLATES]
    words = " ".join(sorted({w for t in licences.TEMPLATES for w in t.words}))
    texts = [". ".join(every), ". ".join(reversed(every)), *(f"{words}. {brute.prose(4, 30)}. {t}" for t in every)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: set(r["labels"].split(",")) for r in licences.scan(df).collect()}
    labels = {t.label for t in licences.TEMPLATES}
    assert labels <= found[0] and labels <= found[1]
    assert all(t.label in found[2 + i] for i, t in enumerate(licences.TEMPLATES))


def _every_place(text):
    """Labels and best share by trying every template at every place of the text."""
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", brute.ascii_lower(text))
    labels, best = set(), 0.0
    for t in licences.TEMPLATES:
        phrase = t.phrase.split()
        for i in range(-t.phrase_at, len(ws)):
            if ws[i + t.phrase_at : i + t.phrase_at + len(phrase)] != phrase:
                continue
            share = sum(0 <= i + j < len(ws) and ws[i + j] == w for j, w in enumerate(t.words)) / len(t.words)
            if share >= licences.SHARE:
                labels.add(t.label)
                best = max(best, share)
    return labels, best


def test_labels_and_scores_against_every_place(spark):
    """Notices with words changed, dropped or doubled, cut at either end, and two in a text."""
    draw = random.Random(4)
    texts = []
    for n in range(400):
        ws = []
        for template in draw.sample(licences.TEMPLATES, 1 + n % 2):
            own = list(template.words)
            for _ in range(draw.randint(0, 4)):
                at = draw.randrange(len(own))
                own[at : at + 1] = draw.choice([["other"], [], [own[at]] * 2, ["the"], ["licence"]])
                own = own or ["the"]
            ws += brute.prose(n, draw.randint(0, 4)).split() + own[draw.choice([0, 0, 1, 2]) :]
        texts.append(" ".join(ws))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    some = 0
    for r in licences.scan(df).collect():
        labels, best = _every_place(r["text"])
        assert set(filter(None, r["labels"].split(","))) == labels | set(filter(None, r["base_labels"].split(","))), r["text"]
        if labels:
            assert abs(r["score"] - best) < 1e-12
            some += 1
    assert 100 < some < 400


def test_kelvin_sign_is_no_k(spark):
    own = [licences.Template("book", "take the book as you like it", "take the book")]
    df = spark.createDataFrame([(1, own[0].text.upper()), (2, own[0].text.replace("k", "\u212a"))], "doc_id long, text string")
    assert {r["doc_id"]: r["labels"] for r in licences.scan(df, templates=own).collect()} == {1: "book", 2: ""}


def test_awkward_rows(spark):
    df = brute.awkward(spark)
    found = licences.scan(df)
    assert found.count() == df.count() and found.where("n_words IS NULL OR labels IS NULL OR score IS NULL").isEmpty()
    assert licences.scan(brute.empty(spark)).isEmpty()
