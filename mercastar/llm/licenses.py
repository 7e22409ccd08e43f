"""Licence notices in texts, through a positional index of their rarest words."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercastar.llm.columns import packed, unpacked

BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = re.compile(r"[0-9a-z]+")

# Rarest words of a passage that are looked up in a file, and how many of the places
# found must agree on where the passage begins. A phrase is anchored at one word.
LOOKED_UP, AGREEING = 4, 2

RESULTS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@dataclass(frozen=True)
class Template:
    """A passage whose words stand consecutively, and the phrases in it that must be met."""

    label: str
    text: str
    key: tuple[str, ...]

    @property
    def words(self) -> list[str]:
        return WORD.findall(self.text)

    @property
    def key_places(self) -> list[int]:
        """Places of the words of all key phrases."""
        places = set()
        for phrase in self.key:
            own = WORD.findall(phrase)
            at = next(i for i in range(len(self.words)) if self.words[i : i + len(own)] == own)
            places |= set(range(at, at + len(own)))
        return sorted(places)

    @property
    def is_phrase(self) -> bool:
        return len(self.key_places) == len(self.words)

    @property
    def looked_up(self) -> int:
        return 1 if self.is_phrase else LOOKED_UP

    @property
    def agreeing(self) -> int:
        return 1 if self.is_phrase else AGREEING


def phrase(label: str, text: str) -> Template:
    return Template(label, text, (text,))


# Fixed by the contract of the query: phrase and label.
BASE = (
    phrase("cc-by", "cc by"),
    phrase("gpl", "general public license"),
    phrase("reserved", "all rights reserved"),
)

# Notices and passages of well-known licences, in lower case, and what must be met of them.
TEMPLATES = (
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2",)),
    Template(
        "apache-2.0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
        ("except in compliance with the license",),
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template(
        "gpl-3",
        "licensed under the gnu general public license version 3",
        ("gnu general public license version 3",),
    ),
    Template(
        "gpl-notice",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license as published by the free software foundation",
        ("gnu general public license", "free software foundation"),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee "
        "is hereby granted",
        ("for any purpose with or without fee",),
    ),
    Template("mit", "released under the mit license", ("mit license",)),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files",
        ("permission is hereby granted free of charge",),
    ),
    Template(
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("mozilla public license",),
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ("unencumbered software released into the public domain",),
    ),
)


def words_of(text: Column) -> Column:
    """Words of a text, lower-cased where they are ASCII.

    lower() also changes other letters, which no licence word holds; the one of them
    that it makes an ASCII letter, the Kelvin sign, is put aside before.
    """
    plain = F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u00e9"))
    return F.array_remove(F.split(F.lower(plain), BETWEEN_WORDS, -1), "")


def _strings(values: list[str]) -> Column:
    """An array of words, written as one literal to keep plans small."""
    return F.split(F.lit(" ".join(values)), " ")


def document_counts(words: DataFrame, templates: tuple[Template, ...]) -> dict[str, int]:
    """In how many texts of a column `_words` each word of the templates stands.

    One number for each word of the templates reaches the driver.
    """
    known = sorted({w for t in templates for w in t.words})
    met = words.select(F.explode(F.array_intersect(_strings(known), F.col("_words"))).alias("word"))
    return {r["word"]: r["count"] for r in met.groupBy("word").count().collect()}


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once, also where inner lambdas use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _places(words: Column, template: Template, rarity: dict[str, int]) -> Column:
    """Where a template is met in a text: an array of (start, matched words)."""
    own = template.words
    by_rarity = sorted(set(own), key=lambda w: (rarity.get(w, 0), w))
    looked_up = F.slice(F.array_intersect(_strings(by_rarity), words), 1, template.looked_up)
    places = {w: ", ".join(str(j) for j, v in enumerate(own) if v == w) for w in by_rarity}
    postings = F.expr("map(" + ", ".join(f"'{w}', array({js})" for w, js in places.items()) + ")")
    key = F.expr("array(" + ", ".join(f"struct({k} AS k, '{own[k]}' AS w)" for k in template.key_places) + ")")
    all_words = _strings(own)

    def starts(wanted: Column) -> Column:
        numbered = F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i")))
        standing = F.filter(numbered, lambda s: F.array_contains(wanted, s["w"]))
        shifted = F.transform(standing, lambda s: F.transform(F.element_at(postings, s["w"]), lambda j: s["i"] - j))
        return F.array_sort(F.flatten(shifted))

    def agreed(sorted_starts: Column) -> Column:
        """Starts that recur often enough, once each."""
        last = template.agreeing - 1
        often = F.filter(sorted_starts, lambda x, k: F.coalesce(F.get(sorted_starts, k + last) == x, F.lit(False)))
        return F.array_distinct(often)

    def met(start: Column) -> Column:
        return F.coalesce(F.forall(key, lambda x: F.get(words, start + x["k"]) == x["w"]), F.lit(False))

    def matched(start: Column) -> Column:
        same = F.filter(all_words, lambda w, k: F.coalesce(F.get(words, start + k) == w, F.lit(False)))
        return F.struct(start.alias("start"), F.size(same).alias("matched"))

    agreeing = _bound(looked_up, lambda wanted: _bound(starts(wanted), agreed))
    return F.transform(F.filter(agreeing, met), matched)


def scan_licenses(
    df: DataFrame,
    text: str = "text",
    base: tuple[Template, ...] = BASE,
    templates: tuple[Template, ...] = TEMPLATES,
) -> DataFrame:
    """Licence labels of every text.

    The index of a template holds the places of its words. Of a text that has all
    words of a template's key phrases, the template's rarest words (by the number of
    texts of the whole table with that word) are looked up; each place of such a word
    less its places in the template is a start. A start on which two of four words
    agree is kept if all words of the key phrases stand at their places from there;
    the share of the template's words that do is its score. Base phrases are templates
    that are all key: they are anchored at their rarest word, so every place of them is
    found.

    Adds to the columns of `df`, replacing those of the same name: `n_words`, `n_base`
    (places of base phrases), `first_word` and `last_word` (their least and greatest
    first word, from 0; NULL without any), `base_labels`, `labels` (distinct, sorted,
    joined by commas; "" if there are none), `score` (best share, 0 to 1) and
    `license_starts`, an array of (label, start).

    Words are runs of 0-9, a-z, A-Z and non-ASCII characters; case counts only beyond
    ASCII. NULL and empty texts have no words. A text of any length is one row: work
    and memory grow with its words. Repeated rows and NULL ids are rows like others, and
    an empty table gives no rows. Nothing is shuffled but the word counts.
    """
    rows = packed(df, _words=words_of(F.col(f"`{text}`")))
    every = (*base, *templates)
    rarity = document_counts(rows.select("_words"), every)
    needed = [sorted({t.words[k] for k in t.key_places}) for t in every]
    asked = sorted({w for words in needed for w in words})
    rows = rows.withColumn("_has", F.array_intersect(_strings(asked), F.col("_words")))
    nothing = F.array().cast("array<struct<start:int,matched:int>>")
    found = rows.select(
        "_mx_row",
        F.size("_words").cast("bigint").alias("_n"),
        *[
            F.when(
                F.size(F.array_intersect(_strings(words), F.col("_has"))) == len(words),
                _places(F.col("_words"), template, rarity),
            )
            .otherwise(nothing)
            .alias(f"_at{i}")
            for i, (template, words) in enumerate(zip(every, needed, strict=True))
        ],
    )

    def labels(upto: int) -> Column:
        told = [F.when(F.size(f"_at{i}") > 0, t.label) for i, t in enumerate(every[:upto])]
        return F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*told)))), ",")

    starts = F.concat(*[F.transform(f"_at{i}", lambda x: x["start"]) for i in range(len(base))])

    def named(i: int) -> Column:
        label = F.lit(every[i].label).alias("label")
        return F.transform(f"_at{i}", lambda x: F.struct(label, x["start"].alias("start")))

    shares = [
        F.coalesce(F.array_max(F.transform(f"_at{i}", lambda x: x["matched"])), F.lit(0)) / F.lit(float(len(t.words)))
        for i, t in enumerate(every)
    ]
    return unpacked(
        found,
        df.columns,
        n_words=F.col("_n"),
        n_base=F.size(starts).cast("bigint"),
        first_word=F.array_min(starts).cast("bigint"),
        last_word=F.array_max(starts).cast("bigint"),
        base_labels=labels(len(base)),
        labels=labels(len(every)),
        score=F.greatest(*shares),
        license_starts=F.array_sort(F.concat(*[named(i) for i in range(len(every))])),
    )
