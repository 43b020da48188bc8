"""Licence scan by a positional index of rare licence words, in built-in expressions only.

``postings`` splits every whole text into words and keeps, per document, the places of the
words that any licence template has, with a code each. From these postings the document
frequency of each licence word over the whole corpus gives its IDF.

The index has, for the word of highest IDF in each template's mandatory phrase, the postings
(template, position in it). A file's places of such words are looked up there; each posting
proposes where its template would begin, and the file's postings around the place are
intersected with the template's by relative position. A proposal counts when the mandatory
phrase stands word by word and, for a longer text, ``SHARE`` of its ``ANCHORS`` rarest words
stand at their places. The work is places of rare words times the length of the templates they
are rarest in; templates whose rare words a file lacks cost nothing.

Everything about one document happens in its row, so nothing but the few counts of licence
words is shuffled, and the postings are written once to the shared folder.

Edge cases: a null text counts as empty; without words or hits the labels are empty strings,
the places null and the score 0; repeated rows each get a row; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satlink.llm import common as C
from satlink.llm.licence_texts import TEXTS

ANCHORS = 6
SHARE = 0.8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """A licence text: its words, the phrase in it that must stand word by word, and the label."""

    label: str
    words: str
    mandatory: str
    base: bool = False


#: The base phrases with their labels, then phrases of licences and their notices.
TEMPLATES = (
    Template("mit", "under the mit license", "under the mit license", True),
    Template("apache-2", "apache license version 2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", "cc by nc", True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    Template("mit", "the software is provided as is without warranty of any kind express or implied", "the software is provided as is"),
    Template("apache-2", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template("apache-2", "you may not use this file except in compliance with the license", "you may not use this file except in compliance"),
    Template("gpl-3", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    Template("gpl-2", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    Template("gpl", "gnu general public license", "gnu general public license"),
    Template("lgpl", "gnu lesser general public license", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license", "gnu affero general public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    Template("bsd", "under the bsd license", "under the bsd license"),
    Template("mpl-2", "mozilla public license version 2 0", "mozilla public license version 2"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy modify and or distribute this software"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    Template("cc-by-nc-sa", "cc by nc sa", "cc by nc sa"),
    Template("cc-by-nc-nd", "cc by nc nd", "cc by nc nd"),
    Template("cc-by-sa", "cc by sa", "cc by sa"),
    Template("cc0", "cc0 1 0 universal", "cc0 1 0"),
    *(Template(label, " ".join(re.findall("[0-9a-z]+", text.lower())), mandatory) for label, mandatory, text in TEXTS),
)


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lowered, F.lit(f"({WORD})"), F.lit(1))


_CODES = (1 << 31) - 1


def code_of(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(_CODES)).cast("int")


def codes_of(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """The code of each licence word; they differ."""
    found = docs.sparkSession.range(1).select(F.transform(F.lit(vocabulary), code_of).alias("codes")).first()["codes"]
    if len(set(found)) < len(vocabulary):
        raise ValueError("two licence words have one code: change _CODES")
    return dict(zip(vocabulary, found))


def postings(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Rows (doc_id, n_words, places array<int>, codes array<int>): where which licence words stand."""
    rows = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    places = F.filter(F.transform("words", lambda w, i: F.when(w.isin(vocabulary), i)), lambda i: i.isNotNull())
    rows = rows.select("doc_id", "words", F.size("words").cast("long").alias("n_words"), places.alias("places"))
    codes = F.transform("places", lambda i: code_of(F.get(F.col("words"), i)))
    return rows.select("doc_id", "n_words", "places", codes.alias("codes"))


def idf(found: DataFrame, n_docs: int, code: dict[str, int]) -> dict[str, float]:
    """IDF of every licence word over all documents."""
    word = {c: w for w, c in code.items()}
    rows = found.select(F.explode(F.array_distinct("codes")).alias("code")).groupBy("code").agg(F.count("*").alias("df")).collect()
    df = {word[r["code"]]: r["df"] for r in rows}
    return {w: math.log((1 + n_docs) / (1 + df.get(w, 0))) for w in code}


class Index:
    """Templates as literal arrays, and the postings of their lookup words."""

    def __init__(self, templates: tuple[Template, ...], weight: dict[str, float], code: dict[str, int]):
        self.lookup: dict[int, list[tuple[int, int]]] = {}
        words, weights, total, anchors, need, begin, length = ([] for _ in range(7))
        for number, t in enumerate(templates):
            own, phrase = t.words.split(), t.mandatory.split()
            at = next(i for i in range(len(own)) if own[i : i + len(phrase)] == phrase)
            # Rarest words first; the lookup word is of the mandatory phrase, so that no place of it is missed.
            by_rarity = sorted(range(len(own)), key=lambda i: (-weight[own[i]], i))
            first = next(i for i in by_rarity if at <= i < at + len(phrase))
            self.lookup.setdefault(code[own[first]], []).append((number, first))
            chosen = [first, *[i for i in by_rarity if i != first][: ANCHORS - 1]]
            words.append([code[w] for w in own])
            weights.append([weight[w] + 1e-9 for w in own])
            total.append(sum(weights[-1]))
            anchors.append(chosen)
            need.append(math.ceil(SHARE * len(chosen)) if len(own) > len(phrase) else 0)
            begin.append(at)
            length.append(len(phrase))
        self.codes = sorted(self.lookup)
        nested = lambda rows: F.array(*[F.lit(r) for r in rows])
        self.words, self.weights, self.anchors = nested(words), nested(weights), nested(anchors)
        self.total, self.need, self.begin, self.length = F.lit(total), F.lit(need), F.lit(begin), F.lit(length)
        self.is_base, self.label = F.lit([t.base for t in templates]), F.lit([t.label for t in templates])
        self.postings = F.array(*[F.array(*[F.struct(F.lit(t).alias("t"), F.lit(p).alias("p")) for t, p in self.lookup[c]]) for c in self.codes])

    def proposals(self) -> Column:
        """Array of (j, t, p): the j-th posting of the file is word p of template t, its rarest."""
        rare = F.filter(F.transform("codes", lambda c, j: F.when(c.isin(self.codes), j)), lambda j: j.isNotNull())

        def looked_up(j: Column) -> Column:
            own = F.get(self.postings, F.array_position(F.lit(self.codes), F.get(F.col("codes"), j)).cast("int") - 1)
            return F.transform(own, lambda x: F.struct(j.alias("j"), x["t"].alias("t"), x["p"].alias("p")))

        return F.flatten(F.transform(rare, looked_up))

    def judged(self, proposal: Column) -> Column:
        """start of the mandatory phrase, label, base, whether it counts, and the IDF share of the template's words at their places."""
        j, t, p = proposal["j"], proposal["t"], proposal["p"]
        start = F.get(F.col("places"), j) - p
        own = F.get(self.words, t)
        # The posting of the word i places further is at most i postings further.
        near = lambda column: F.slice(F.col(column), F.greatest(j - p, F.lit(0)) + 1, F.size(own))
        at = F.zip_with(near("places"), near("codes"), lambda place, c: F.when(F.get(own, place - start) == c, place - start))
        there = F.filter(at, lambda i: i.isNotNull())
        begin, length = F.get(self.begin, t), F.get(self.length, t)
        exact = F.size(F.filter(there, lambda i: (i >= begin) & (i < begin + length))) == length
        votes = F.size(F.filter(there, lambda i: F.array_contains(F.get(self.anchors, t), i)))
        heard = F.aggregate(there, F.lit(0.0), lambda acc, i: acc + F.get(F.get(self.weights, t), i)) / F.get(self.total, t)
        return F.struct((start + begin).alias("start"), F.get(self.label, t).alias("label"), F.get(self.is_base, t).alias("base"),
                        (exact & (votes >= F.get(self.need, t))).alias("counts"), F.round(F.least(heard, F.lit(1.0)), 9).alias("share"))


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Rows (doc_id, n_words, base array<struct<start, label>>, found array<struct<start, label>>, score).

    ``base`` has all places of base phrases, ``found`` those of the other templates (start of the
    mandatory phrase). ``score`` is the IDF share of the best proposal: the weight of its template's
    words that stand at their places, of all its words; 1 for a template that stands whole.
    """
    vocabulary = sorted({w for t in templates for w in t.words.split()})
    code = codes_of(docs, vocabulary)
    rows = C.written(postings(docs, vocabulary), "licence-postings")
    index = Index(templates, idf(rows, rows.count(), code), code)
    # Only files with some lookup word can match; all others skip the rest.
    maybe = F.arrays_overlap("codes", F.lit(index.codes))
    kind = "array<struct<start:int,label:string,base:boolean,counts:boolean,share:double>>"
    judged = F.when(maybe, F.transform(index.proposals(), index.judged)).otherwise(F.array().cast(kind))
    rows = rows.select("doc_id", "n_words", judged.alias("judged"))
    place = lambda h: F.struct(h["start"].alias("start"), h["label"].alias("label"))
    hits = lambda base: F.transform(F.filter("judged", lambda h: h["counts"] & (h["base"] == base)), place)
    best = F.coalesce(F.array_max(F.transform("judged", lambda h: h["share"])), F.lit(0.0))
    return rows.select("doc_id", "n_words", hits(True).alias("base"), hits(False).alias("found"), best.alias("score"))


def labels(hits: Column) -> Column:
    """Distinct labels, sorted, joined by commas."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda h: h["label"]))), ",")
