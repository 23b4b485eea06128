"""License scan (operator 6), DataFrame functions only.

Method: sentence-rule recognition. A text is cut into sentences at ``.``, ``!``
or ``?`` before a blank or line end (not after the ``v.`` of a version number)
and at lines without letters and digits; it is normalised to lower-case ASCII
letters and digits with single blanks between. A known sentence fills
a whole sentence, or whole lines of one, however it is wrapped into lines: from each
line that begins a known sentence, the lines that follow are added one by one
while they still begin one, and each of these is looked up in the map from
sentences to identifiers. The longest that is known is taken and the search goes
on behind it; all else is dropped. A licence is recognised
where the identifiers hold one of its rules, a sequence of
identifiers in order and next to each other. Rows are independent: one map.

Defined results: a NULL or empty text has no sentences and no licence; a NULL
id stays NULL; repeated rows give repeated rows; an empty table gives an empty
table; further columns are not read. Licences are listed in the order of the rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agroweather.llm.common import lower_ascii

# Identifier and normalised text of known licence sentences.
SENTENCES = {
    "mit-notice": "released under the mit license",
    "mit-notice-2": "licensed under the mit license",
    "mit-title": "mit license",
    "mit-title-2": "the mit license mit",
    "apache-notice": "licensed under the apache license version 2 0",
    "apache-notice-2": (
        "licensed under the apache license version 2 0 the license "
        "you may not use this file except in compliance with the license"
    ),
    "apache-title": "apache license",
    "apache-version": "version 2 0 january 2004",
    "gpl3-notice": "this work is licensed under the gnu general public license version 3",
    "gpl3-notice-2": "licensed under the gnu general public license version 3",
    "gpl-title": "gnu general public license",
    "gpl3-version": "version 3 29 june 2007",
    "cc-by-nc-4-notice": "licensed under cc by nc 4 0",
    "cc-by-4-notice": "licensed under cc by 4 0",
    "bsd3-title": "bsd 3 clause license",
    "mpl2-notice": (
        "this source code form is subject to the terms of the mozilla public license v 2 0"
    ),
    "public-domain": "this is free and unencumbered software released into the public domain",
    "mit-grant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software "
        "and associated documentation files the software to deal in the software without restriction "
        "including without limitation the rights to use copy modify merge publish distribute sublicense "
        "and or sell copies of the software and to permit persons to whom the software is furnished to "
        "do so subject to the following conditions"
    ),
    "mit-condition": (
        "the above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the software"
    ),
    "bsd-grant": (
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met"
    ),
    "bsd-source": (
        "redistributions of source code must retain the above copyright notice this list of conditions "
        "and the following disclaimer"
    ),
    "bsd-binary": (
        "redistributions in binary form must reproduce the above copyright notice this list of "
        "conditions and the following disclaimer in the documentation and or other materials provided "
        "with the distribution"
    ),
    "bsd-names": (
        "neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission"
    ),
    "bsd-disclaimer": (
        "this software is provided by the copyright holders and contributors as is and any express or "
        "implied warranties including but not limited to the implied warranties of merchantability and "
        "fitness for a particular purpose are disclaimed"
    ),
    "gpl3-header": (
        "this program is free software you can redistribute it and or modify it under the terms of the "
        "gnu general public license as published by the free software foundation either version 3 of "
        "the license or at your option any later version"
    ),
}
# Licence and the sentence sequences that show it, in order of report.
RULES = (
    ("MIT", (("mit-notice",), ("mit-notice-2",), ("mit-title",), ("mit-title-2",), ("mit-grant", "mit-condition"))),
    ("Apache-2.0", (("apache-notice",), ("apache-notice-2",), ("apache-title", "apache-version"))),
    ("GPL-3.0", (("gpl3-notice",), ("gpl3-notice-2",), ("gpl-title", "gpl3-version"), ("gpl3-header",))),
    ("CC-BY-NC-4.0", (("cc-by-nc-4-notice",),)),
    ("CC-BY-4.0", (("cc-by-4-notice",),)),
    ("BSD-3-Clause", (("bsd3-title",), ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names"))),
    ("MPL-2.0", (("mpl2-notice",),)),
    ("Unlicense", (("public-domain",),)),
    ("BSD-2-Clause", (("bsd-grant", "bsd-source", "bsd-binary", "bsd-disclaimer"),)),
)

GROUP = 256  # matches whose identifiers are listed together


def plain_lines(text: Column) -> Column:
    """Normalised lines; an empty line stands between sentences."""
    kept = F.regexp_replace(
        F.coalesce(text, F.lit("")), r"(?<![A-Za-z0-9])([vV])\.(?=[\x20\x09\x0D\n]+[0-9])", "$1 "
    )
    cut = F.regexp_replace(kept, r"[.!?](?=[\x20\x09\x0D\n])", "\n\n")
    plain = F.regexp_replace(lower_ascii(cut), r"[^a-z0-9\n]+", " ")
    return F.regexp_replace(plain, r"\x20?\n\x20?", "\n")


def beginnings(sentences: dict[str, str]) -> list[str]:
    """The known sentences cut after each of their words."""
    words = [text.split(" ") for text in sentences.values()]
    return sorted({" ".join(own[:end]) for own in words for end in range(1, len(own) + 1)})


def known_sentences(lines: Column, sentences: dict[str, str]) -> Column:
    """Array of ``at, end, id``: the longest known sentence from each normalised line that begins one.

    ``lines`` is a column of its own, so that it is made once and not for each start.
    """
    known = F.create_map(*[F.lit(value) for name, own in sentences.items() for value in (own, name)])
    begun = beginnings(sentences)
    longest = max((len(own.split(" ")) for own in sentences.values()), default=1)  # in lines, a word each
    starts = F.filter(
        F.transform(lines, lambda line, at: F.struct(at.alias("at"), line.alias("line"))),
        lambda start: start["line"].isin(begun),
    )
    nothing = F.lit(None).cast("string")
    fresh = F.struct(F.lit("").alias("read"), F.lit(True).alias("open"), F.lit(0).alias("n"), F.lit(0).alias("end"), nothing.alias("id"))

    def add_line(state: Column, line: Column) -> Column:
        read = F.when(state["read"] == "", line).otherwise(F.concat_ws(" ", state["read"], line))
        still = state["open"] & (line != "") & read.isin(begun)
        n = state["n"] + 1
        found = F.when(still, F.try_element_at(known, read))
        return F.struct(
            F.when(still, read).otherwise(state["read"]).alias("read"),
            still.alias("open"),
            n.alias("n"),
            F.when(found.isNotNull(), n).otherwise(state["end"]).alias("end"),
            F.coalesce(found, state["id"]).alias("id"),
        )

    def from_start(start: Column) -> Column:
        best = F.aggregate(F.slice(lines, start["at"] + 1, F.lit(longest)), fresh, add_line)
        return F.struct(start["at"].alias("at"), (start["at"] + best["end"]).alias("end"), best["id"].alias("id"))

    return F.filter(F.transform(starts, from_start), lambda match: match["id"].isNotNull())


def apart(matches: Column) -> Column:
    """Identifiers of the matches in order, without those that begin inside one taken before.

    ``matches`` is a column of its own. They are gone through in groups, so that
    lists are copied within and between groups only, however many there are.
    """
    groups = F.transform(
        F.sequence(F.lit(0), F.floor(F.size(matches) / GROUP).cast("int")),
        lambda group: F.slice(matches, group * GROUP + 1, GROUP),
    )
    empty = F.array().cast("array<string>")

    def take(state: Column, match: Column) -> Column:
        free = match["at"] >= state["end"]
        return F.struct(
            F.when(free, match["end"]).otherwise(state["end"]).alias("end"),
            F.when(free, F.concat(state["ids"], F.array(match["id"]))).otherwise(state["ids"]).alias("ids"),
        )

    def take_group(state: Column, group: Column) -> Column:
        taken = F.aggregate(group, F.struct(state["end"].alias("end"), empty.alias("ids")), take)
        return F.struct(
            taken["end"].alias("end"), F.concat(state["groups"], F.array(taken["ids"])).alias("groups")
        )

    start = F.struct(F.lit(0).alias("end"), F.array().cast("array<array<string>>").alias("groups"))
    return F.flatten(F.aggregate(groups, start, take_group)["groups"])


def scan_licenses(
    docs: DataFrame,
    *,
    sentences: dict[str, str] = SENTENCES,
    rules: tuple = RULES,
) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``) its licence sentences and licences.

    ``sentences`` and ``rules`` are part of the plan, so their size is bounded by what is written there.
    """
    lines = F.transform(F.split(plain_lines(F.col("text")), "\n", -1), lambda line: F.trim(line))
    ids = F.concat(F.lit(","), F.array_join("found", ","), F.lit(","))
    shown = []
    for license_name, sequences in rules:
        fits = F.lit(False)
        for sequence in sequences:
            fits = fits | F.contains(F.col("ids"), F.lit("," + ",".join(sequence) + ","))
        shown.append(F.when(fits, F.lit(license_name)))
    return (
        docs.select(F.col("doc_id").cast("long"), lines.alias("lines"))
        .select("doc_id", known_sentences(F.col("lines"), sentences).alias("matches"))
        .select("doc_id", apart(F.col("matches")).alias("found"))
        .select("doc_id", F.size("found").cast("long").alias("n_sentences"), ids.alias("ids"))
        .select(
            "doc_id",
            "n_sentences",
            F.btrim("ids", F.lit(",")).alias("sentence_ids"),
            F.concat_ws(",", *shown).alias("licenses"),
        )
    )
