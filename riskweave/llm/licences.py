"""Licence scan by sentence rules, as one projection of built-in functions.

A text is cut at stops, blank lines and line ends and normalised to lower-case words. A
sentence of the table that begins and ends at cuts becomes its identifier, and may run over
line ends between: licences are usually wrapped. Signs before a line (``#``, ``//``, ``*``)
and the comment words ``dnl`` and ``rem`` do not count; of sentences that begin at one place
the longest is taken. The identifiers of a document in
order form a sequence, which is matched against ordered rules: longer rules come first,
matched identifiers are used up, and a rule of one sentence is the fall-back.

Defined cases: a null or empty text has no sentence and no licence; a licence that
occurs twice is reported twice in ``matches`` and once in ``licences``; equal rows are
judged each by itself; other columns pass through, result columns win over their namesakes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import let, text_of

# Signs that mark where a sentence ends, or may end, in a normalised text.
CUT, WRAP = "\x01", "\x02"

# Sentences of public licences, as published.
SENTENCES = {
    "mit-notice": "Released under the MIT License.",
    "mit-title": "The MIT License (MIT)",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-condition": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-header": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache-use": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "gnu-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gnu-2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gnu-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "cc0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
}
_GNU = {"gpl": ("General", ("1", "2", "3")), "lgpl": ("Lesser General", ("2.1", "3")), "agpl": ("Affero General", ("3",))}
_CC = ("BY", "BY-SA", "BY-NC", "BY-NC-SA", "BY-ND", "BY-NC-ND")


def sentence_table() -> dict[str, list[str]]:
    """Identifier -> sentences; families with versions are made from their pattern."""
    table = {k: [v] for k, v in SENTENCES.items()}
    for short, (name, versions) in _GNU.items():
        for v in versions:
            table[f"{short}-{v}-notice"] = [
                f"{lead} the GNU {name} Public License, version {v}." for lead in
                ("This work is licensed under", "Licensed under", "Released under", "This software is licensed under")]
    for kind in _CC:
        for v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            table[f"cc-{kind.lower()}-{v}-notice"] = [
                f"{lead} CC {kind} {v}." for lead in ("Licensed under", "This work is licensed under", "Released under")]
    return table


#: Ordered rules: licence, identifiers in order. The first rule that fits at a place wins.
RULES = (
    ("MIT", ("mit-title", "mit-grant", "mit-condition", "as-is")),
    ("MIT", ("mit-grant", "mit-condition", "as-is")),
    ("ISC", ("isc-grant", "as-is")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("Apache-2.0", ("apache-header", "apache-use", "apache-copy")),
    ("Apache-2.0", ("apache-header", "apache-use")),
    ("GPL-3.0-or-later", ("gnu-free", "gnu-hope")),
    ("GPL-2.0-or-later", ("gnu-2-free", "gnu-hope")),
    ("GPL-3.0-or-later", ("gnu-free",)),
    ("GPL-2.0-or-later", ("gnu-2-free",)),
    ("MIT", ("mit-grant", "mit-condition")),
    ("MIT", ("mit-grant",)),
    ("MIT", ("mit-notice",)),
    ("MIT", ("mit-title",)),
    ("ISC", ("isc-grant",)),
    ("Apache-2.0", ("apache-notice",)),
    ("Apache-2.0", ("apache-header",)),
    ("Unlicense", ("unlicense",)),
    ("MPL-2.0", ("mpl-2.0",)),
    ("CC0-1.0", ("cc0",)),
    *[(f"{s.upper()}-{v}{'' if '.' in v else '.0'}-only", (f"{s}-{v}-notice",)) for s, (_, vs) in _GNU.items() for v in vs],
    *[(f"CC-{k}-{v}", (f"cc-{k.lower()}-{v}-notice",)) for k in _CC for v in ("1.0", "2.0", "2.5", "3.0", "4.0")],
)


def cut_table() -> dict[str, str]:
    """Normalised piece -> identifier, in Python as the projection does it; a sentence with inner stops is several pieces."""
    import regex
    out = {}
    for name, sentences in sentence_table().items():
        for sentence in sentences:
            pieces = regex.sub(r"([.;:!?])[\x20\x09-\x0D]+", "\\1\n", sentence).split("\n")
            words = [regex.sub(r"[^\p{L}\p{N}]+", " ", p.lower()).strip() for p in pieces]
            if len(words) == 1:
                out[words[0]] = name
            else:  # identifier of a piece: its number within the sentence
                for i, w in enumerate(words):
                    out.setdefault(w, f"{name}#{i}")
    return out


def rule_pattern() -> tuple[str, dict[str, str]]:
    """One alternation in rule order over ``<id>`` sequences, and matched text -> licence."""
    table = cut_table()
    pieces: dict[str, list[str]] = {}
    for ident in table.values():
        base, _, number = ident.partition("#")
        pieces.setdefault(base, [])
        if ident not in pieces[base]:
            pieces[base].append(ident)
    licences = {"".join(f"<{p}>" for i in ids for p in pieces[i]): name for name, ids in reversed(RULES)}
    ordered = list(dict.fromkeys("".join(f"<{p}>" for i in ids for p in pieces[i]) for _, ids in RULES))
    return "|".join(x.replace(".", "[.]") for x in ordered), licences


def sentence_pattern(table: dict[str, str]) -> str:
    """Sentences between two cuts, longest first; a blank may be a line end."""
    ordered = sorted(table, key=len, reverse=True)
    return f"(?<=[{CUT}{WRAP}])(?:{'|'.join(w.replace(' ', f'[ {WRAP}]') for w in ordered)})(?=[{CUT}{WRAP}])"


def _marked(text: Column) -> Column:
    """Lower-case words with ``CUT`` for stops and blank lines and ``WRAP`` for other line ends, no blanks beside them."""
    bare = F.regexp_replace(F.translate(F.lower(text), CUT + WRAP, "''"), r"(?dm)^(?:[^\p{L}\p{N}\n]+|(?:dnl|rem)(?=[\x20\t]))+", "")
    cut = F.translate(F.regexp_replace(bare, r"[.;:!?][\x20\x09-\x0D]+|\n\n+", CUT), "\n", WRAP)
    words = F.regexp_replace(F.concat(F.lit(CUT), cut, F.lit(CUT)), rf"[^\p{{L}}\p{{N}}{CUT}{WRAP}]+", " ")
    return F.regexp_replace(words, f" ?([{CUT}{WRAP}]) ?", "$1")


def _mapped(value: Column, table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[value]


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Documents with ``sentences`` (identifiers in order), ``matches`` and ``licences`` (distinct, sorted)."""
    table, (pattern, names) = cut_table(), rule_pattern()
    known = F.regexp_extract_all(_marked(text_of(text)), F.lit(f"({sentence_pattern(table)})"))
    identified = F.transform(known, lambda w: F.concat(F.lit("<"), _mapped(F.translate(w, WRAP, " "), table), F.lit(">")))

    def matched(ids: Column) -> Column:
        found = F.transform(F.regexp_extract_all(F.array_join(ids, ""), F.lit(f"({pattern})")), lambda m: _mapped(m, names))
        return F.struct(ids.alias("sentences"), found.alias("matches"))

    results = {"sentences", "matches", "licences", "_l"}
    columns = [F.col(f"`{c}`") for c in docs.columns if c not in results]
    return docs.select(*columns, let(identified, matched).alias("_l")).select(
        *columns, "_l.sentences", "_l.matches", F.array_sort(F.array_distinct("_l.matches")).alias("licences"))
