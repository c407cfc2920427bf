"""Licence scan: passages compared to licence templates by word bigrams.

Built-in functions only.  A text is normalised (ASCII lower case, anything else
than letters and digits is a space) and cut into units: each line, each
paragraph of several lines, and the whole text.  A unit and a template are
compared by the Dice coefficient 2 |A and B| / (|A| + |B|) of their sets of word
bigrams.

Pruning: a coefficient of t needs sizes within t / (2 - t) of each other.  The
sizes a template can match are listed, so the candidates of a unit come from one
hash join on its size; units of other sizes never meet a template.  The
templates are a parameter; their number and length are checked, which bounds the
broadcast.

Nulls and edge cases: a null or empty text, and a unit of fewer than two words,
matches nothing.  A null ``doc_id`` is kept; repeated rows each give their
matches.  Equal units of one text count once.  Columns other than doc_id and
text are not read.  An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from fractions import Fraction
from functools import lru_cache
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = Fraction(4, 5)
MOST_TEMPLATES = 1_000
MOST_WORDS = 20_000
_LENGTH_CLASSES = (20, 60, 150, 400, 1_000)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Public notices by which works state their licence.
_NOTICES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "mit": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions:"
    ),
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
}


# Licences by the name they are referred to with.
_NAMES = {
    "agpl-3.0": "GNU Affero General Public License v3.0",
    "artistic-2.0": "Artistic License 2.0",
    "bsd-2-clause": "BSD 2-Clause License",
    "bsd-3-clause": "BSD 3-Clause License",
    "bsl-1.0": "Boost Software License, Version 1.0",
    "cc0-1.0": "Creative Commons CC0 1.0 Universal",
    "epl-2.0": "Eclipse Public License, Version 2.0",
    "gfdl-1.3": "GNU Free Documentation License, Version 1.3",
    "gpl-2.0": "GNU General Public License v2.0",
    "gpl-3.0-name": "GNU General Public License v3.0",
    "isc-name": "ISC License",
    "lgpl-2.1": "GNU Lesser General Public License v2.1",
    "lgpl-3.0": "GNU Lesser General Public License v3.0",
    "mit-name": "MIT License",
    "mpl-2.0": "Mozilla Public License, Version 2.0",
    "unlicense": "Unlicense",
    "zlib": "zlib License",
}
_CREATIVE_COMMONS = {
    "by": "Attribution",
    "by-sa": "Attribution-ShareAlike",
    "by-nd": "Attribution-NoDerivatives",
    "by-nc": "Attribution-NonCommercial",
    "by-nc-sa": "Attribution-NonCommercial-ShareAlike",
    "by-nc-nd": "Attribution-NonCommercial-NoDerivatives",
}
# (name, name of the licence, its version): the notice the FSF gives for programs.
_GNU_HEADERS = [
    ("gpl-2.0", "GNU General Public License", "2"),
    ("agpl-3.0", "GNU Affero General Public License", "3"),
    ("lgpl-2.1", "GNU Lesser General Public License", "2.1"),
    ("lgpl-3.0", "GNU Lesser General Public License", "3"),
]
_MPL_HEADER = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
    "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
)
_GNU_WARRANTY = (
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
    "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {} for more details."
)
_TEXTS = Path(__file__).with_name("license_texts")
_BY_PARAGRAPH = 400


def standard_templates() -> dict[str, str]:
    """Notices, headers and full texts of common licences; short texts also by paragraph.

    Of templates with the same bigrams the first is kept.
    """
    made = dict(_NOTICES)
    made |= {name: f"Licensed under the {title}." for name, title in _NAMES.items()}
    for code, title in _CREATIVE_COMMONS.items():
        for version, kind in (("4.0", "International"), ("3.0", "Unported")):
            made.setdefault(f"cc-{code}-{version}", f"Licensed under CC {code.upper()} {version}.")
            made[f"cc-{code}-{version}-name"] = (
                f"This work is licensed under a Creative Commons {title} {version} {kind} License."
            )
    for name, title, version in _GNU_HEADERS:
        header = _NOTICES["gpl-3.0-header"].replace("GNU General Public License", title)
        made[f"{name}-header"] = header.replace("version 3 of", f"version {version} of")
        made[f"{name}-header-warranty"] = _GNU_WARRANTY.format(title)
    made["mpl-2.0-header"] = _MPL_HEADER
    for path in sorted(_TEXTS.glob("*.txt")):
        text = path.read_text("utf-8")
        made[f"{path.stem}-text"] = text
        if len(text.split()) < _BY_PARAGRAPH:
            for n, part in enumerate(re.split(r"\n\s*\n", text), 1):
                if len(part.split()) >= 12:
                    made[f"{path.stem}-text-{n}"] = part
    kept, seen = {}, set()
    for name, text in made.items():
        grams = tuple(template_bigrams(text))
        if grams not in seen:
            seen.add(grams)
            kept[name] = text
    return kept


@lru_cache(maxsize=MOST_TEMPLATES)
def _template_bigrams(text: str) -> tuple[str, ...]:
    words = re.sub(r"[^a-z0-9]+", " ", text.translate(str.maketrans(_UPPER, _LOWER))).split()
    return tuple(sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)}))


def template_bigrams(text: str) -> list[str]:
    """Sorted distinct word bigrams of a template, normalised as texts are."""
    return list(_template_bigrams(text))


TEMPLATES = standard_templates()


def size_bounds(size: int, threshold: Fraction) -> range:
    """Sizes with which a set of ``size`` can reach the coefficient."""
    ratio = threshold / (2 - threshold)
    return range(-(-size * ratio.numerator // ratio.denominator), size * ratio.denominator // ratio.numerator + 1)


def needles(grams: list[str], threshold: Fraction) -> list[str]:
    """Strings of which every match of the template holds at least one.

    Long words that stand in several bigrams are preferred, as they make few needles.
    """
    size = len(grams)
    # 2 s >= t (|A| + size) and |A| >= s give s >= t size / (2 - t).
    shared = -(-size * threshold.numerator // (2 * threshold.denominator - threshold.numerator))
    short_of = size - shared + 1
    found, open_ = [], set(grams)
    while size - len(open_) < short_of:
        by_word: dict[str, set[str]] = {}
        for gram in open_:
            for word in gram.split():
                if len(word) >= 6:
                    by_word.setdefault(word, set()).add(gram)
        best = max(by_word, key=lambda w: (len(by_word[w]), len(w), w), default=None)
        if best is None:
            best = max(open_, key=lambda g: (len(g), g))
            by_word = {best: {best}}
        found.append(best)
        open_ -= by_word[best]
    return found


def least_length(grams: list[str], threshold: Fraction) -> int:
    """Characters a text has at least if it matches: a word stands in at most two bigrams."""
    shared = -(-len(grams) * threshold.numerator // (2 * threshold.denominator - threshold.numerator))
    letters = sum(sorted(len(g) - 1 for g in grams)[:shared])
    return shared + letters // 2


def _searches(made: Mapping[str, list[str]], threshold: Fraction) -> list[tuple[int, str]]:
    """(least length, pattern): every matching text reaches the length and holds the pattern of one of them.

    Needles of long templates are common words, so they are only looked for in texts long enough for them.
    """
    classes: dict[int, tuple[list[int], set[str]]] = {}
    for grams in made.values():
        if grams:
            least, held = classes.setdefault(sum(len(grams) >= n for n in _LENGTH_CLASSES), ([], set()))
            least.append(least_length(grams, threshold))
            held.update(needles(grams, threshold))
    found = []
    for least, held in classes.values():
        # One search from the starts of words, on the text as it is; alternatives share their first letter.
        by_letter: dict[str, list[str]] = {}
        for needle in sorted(held):
            by_letter.setdefault(needle[0], []).append(needle[1:].replace(" ", "[^a-z0-9]+"))
        words = "|".join(f"{a}(?:{'|'.join(rest)})" for a, rest in by_letter.items())
        found.append((min(least), f"(?i)(?<![a-z0-9])(?:{words})"))
    return found


def units(text: Column) -> Column:
    """Normalised lines, paragraphs of several lines and the whole text, each once."""
    spaced = F.regexp_replace(F.translate(text, _UPPER, _LOWER), "[^a-z0-9\n]+", " ")

    def cleaned(part: Column) -> Column:
        return F.trim(F.regexp_replace(part, "[ \n]+", " "))

    lines = F.split(spaced, "\n")
    paragraphs = F.filter(F.split(spaced, "\n *\n"), lambda p: F.contains(p, F.lit("\n")))
    return F.array_distinct(F.transform(F.concat(lines, paragraphs, F.array(spaced)), cleaned))


def bigrams(unit: Column) -> Column:
    """Distinct word bigrams of a normalised unit; empty below two words."""
    words = F.split(unit, " ")
    pairs = F.zip_with(words, F.slice(words, F.lit(2), F.size(words)), lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(F.slice(pairs, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))))


def scan(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    threshold: Fraction = THRESHOLD,
) -> DataFrame:
    """(doc_id, license, unit, shared, unit_size, template_size, dice) of every match."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold lies above 0 and at most at 1")
    if len(templates) > MOST_TEMPLATES or any(len(t.split()) > MOST_WORDS for t in templates.values()):
        raise ValueError(f"at most {MOST_TEMPLATES} templates of {MOST_WORDS} words")
    spark = docs.sparkSession
    made = {name: template_bigrams(text) for name, text in templates.items()}
    bounds = {n: size_bounds(len(g), threshold) for n, g in made.items() if g}
    # The bigrams of a template are held once, not once for each size it can match.
    spans = spark.createDataFrame(
        [(n, len(made[n]), b[0], b[-1]) for n, b in bounds.items()], "license string, template_size int, low int, high int"
    )
    spans = spans.select("license", "template_size", F.explode(F.sequence("low", "high")).alias("unit_size"))
    known = spark.createDataFrame([(n, made[n]) for n in bounds], "license string, _template array<string>")
    sizes = [n for b in bounds.values() for n in (b[0], b[-1])] or [0]
    searched = F.lit(False)
    for least, pattern in _searches(made, threshold):
        searched |= (F.length("text") >= least) & F.col("text").rlike(pattern)
    texts = docs.select("doc_id", "text").where(searched)
    cut = texts.select("doc_id", F.explode(units(F.col("text"))).alias("unit"))
    # Words bound bigrams from above, and repeated bigrams only lower their number.
    cut = cut.where(F.size(F.split("unit", " ")) > min(sizes))
    sized = cut.withColumn("_bigrams", bigrams(F.col("unit"))).withColumn("unit_size", F.size("_bigrams"))
    sized = sized.where(F.col("unit_size").between(min(sizes), max(sizes)))
    met = sized.join(F.broadcast(spans), "unit_size").join(F.broadcast(known), "license")
    met = met.withColumn("shared", F.size(F.array_intersect("_bigrams", "_template")))
    reached = (
        2 * F.col("shared") * F.lit(threshold.denominator)
        >= (F.col("unit_size") + F.col("template_size")) * F.lit(threshold.numerator)
    )
    dice = 2.0 * F.col("shared") / (F.col("unit_size") + F.col("template_size"))
    return met.where(reached).select(
        "doc_id", "license", "unit", "shared", "unit_size", "template_size", dice.alias("dice")
    )


def oracle(templates: Mapping[str, str] = TEMPLATES, threshold: Fraction = THRESHOLD) -> str:
    """The same matches in SQL, without the pruning."""
    values = ", ".join(
        f"('{name}', [{', '.join(repr(g) for g in template_bigrams(text))}])" for name, text in templates.items()
    )
    return rf"""
WITH template(license, grams) AS (VALUES {values}),
spaced AS (
  SELECT doc_id, regexp_replace(translate(text, '{_UPPER}', '{_LOWER}'), '[^a-z0-9\n]+', ' ', 'g') AS t
  FROM documents
),
parts AS (
  SELECT doc_id, list_distinct(list_transform(
    string_split(t, chr(10))
      || list_filter(string_split_regex(t, '\n *\n'), lambda p: contains(p, chr(10)))
      || [t],
    lambda p: trim(regexp_replace(p, '[ \n]+', ' ', 'g')))) AS units
  FROM spaced WHERE t IS NOT NULL
),
unit AS (SELECT doc_id, unnest(units) AS unit FROM parts),
word AS (SELECT doc_id, unit, string_split(unit, ' ') AS w FROM unit),
gram AS (
  SELECT doc_id, unit, list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) AS g
  FROM word WHERE len(w) > 1
),
met AS (
  SELECT doc_id, license, unit, len(list_intersect(g, grams)) AS shared, len(g) AS unit_size,
         len(grams) AS template_size
  FROM gram, template
)
SELECT doc_id, license, unit, CAST(shared AS BIGINT) AS shared, CAST(unit_size AS BIGINT) AS unit_size,
       CAST(template_size AS BIGINT) AS template_size, 2.0::DOUBLE * shared / (unit_size + template_size) AS dice
FROM met
WHERE 2 * shared * {threshold.denominator} >= (unit_size + template_size) * {threshold.numerator}
"""
