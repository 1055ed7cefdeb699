"""Licence scanning by sentence rules, in built-in expressions.

A text is cut into sentences, each normalised (lower case, comment marks and
punctuation to spaces, single spaces). Known licence sentences are found
anywhere in the document's sequence of words, leftmost and longest first,
across line ends and sentence ends alike, so neither the wrapping of a text
nor a colon inside a known sentence hides one; what is left around them
stays cut as it was. Known sentences map to identifiers; a document's
identifiers in order form a sequence, against which the licence rules are
matched in their stated order. A rule is a run of consecutive identifiers;
what it matches is taken from the sequence, so the longer rules, stated
first, win over the shorter ones they contain. Sentences that speak of
licensing but are not known count as unknown, and part a sequence; so does
a reference that is denied ("not licensed under ..."). A reserved right
beside a licence is a part of that licence's notice: it is a licence of its
own only where no other is found.

Words are laid out as " word  word \x01 word ", each with blanks of its own
and a mark where a sentence ends, so a pattern of whole words needs no
look-around and ``OP2_SQL`` states the same rules.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

# Known licence sentences, normalised, and their identifiers.
SENTENCES = {
    "released under the mit license": "MitRef",
    "licensed under the mit license": "MitRef",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation the "
    "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
    "persons to whom the software is furnished to do so subject to the following conditions": "MitGrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the software": "MitNotice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the "
    "warranties of merchantability fitness for a particular purpose and noninfringement": "MitAsIs",
    "licensed under the apache license version 2 0": "Apache2Ref",
    "licensed under the apache license version 2 0 the license": "Apache2Ref",
    "you may not use this file except in compliance with the license": "Apache2Comply",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "Apache2Copy",
    "this work is licensed under the gnu general public license version 3": "Gpl3Ref",
    "this work is licensed under the gnu general public license version 2": "Gpl2Ref",
    "licensed under cc by nc 4 0": "CcByNc4Ref",
    "licensed under cc by 4 0": "CcBy4Ref",
    "licensed under cc by sa 4 0": "CcBySa4Ref",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met": "BsdPre",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following "
    "disclaimer": "BsdSource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
    "following disclaimer in the documentation and or other materials provided with the distribution": "BsdBinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission": "BsdEndorse",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted provided that the above copyright notice and this permission notice appear in all copies": "IscGrant",
    "neither the name of copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission": "BsdEndorse",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "Mpl2Ref",
    "made available under the terms of the eclipse public license 2 0": "Epl2Ref",
    "made available under the terms of the eclipse public license v 2 0": "Epl2Ref",
    "made available under the terms of the eclipse public license v1 0": "Epl1Ref",
    "this is free and unencumbered software released into the public domain": "UnlicenseRef",
    "waived all copyright and related or neighboring rights to": "Cc0Waiver",
    "cc0 1 0 universal": "Cc0Ref",
    "licensed under cc0 1 0": "Cc0Ref",
    "all rights reserved": "AllRights",
}

# The foundation's licences and their versions, and the sentences of their notices.
FAMILIES = {"GPL": ("general", ("1.0", "2.0", "3.0")), "LGPL": ("lesser general", ("2.1", "3.0")),
            "LGPL-": ("library general", ("2.0",)), "AGPL": ("affero general", ("3.0",))}
NOTICE = "free software you can redistribute it and or modify it under the terms of the gnu {kind} public license"
LATER = (NOTICE + " as published by the free software foundation either version {v} of the license or at your option "
         "any later version",
         NOTICE + " as published by the free software foundation either version {v} or at your option any later version")
ONLY = (NOTICE + " as published by the free software foundation version {v} of the license",
        NOTICE + " version {v} as published by the free software foundation")
for _name, (_kind, _versions) in FAMILIES.items():
    for _v in _versions:
        _said = _v.removesuffix(".0").replace(".", " ")
        for _form, _end in ((LATER, "or-later"), (ONLY, "only")):
            SENTENCES |= {s.format(kind=_kind, v=_said): f"{_name.rstrip('-')}-{_v}-{_end}" for s in _form}

# Names that may follow an SPDX tag.
SPDX = ("MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "MPL-2.0", "EPL-1.0", "EPL-2.0", "CC0-1.0", "Unlicense",
        "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "GPL-2.0", "GPL-3.0", *(
            f"{n.rstrip('-')}-{v}-{e}" for n, (_, vs) in FAMILIES.items() for v in vs for e in ("only", "or-later")))
SENTENCES |= {f"spdx license identifier {n.lower().replace('-', ' ').replace('.', ' ')}": f"Spdx-{n}" for n in SPDX}

# Words that deny a reference.
DENIALS = ("not", "never", "no longer", "isn t", "aren t", "wasn t", "not be")
SENTENCES |= {f"{no} {s}": "Denied" for s in list(SENTENCES) if s.startswith(("licensed ", "released ", "made available "))
              for no in DENIALS}

# Licence rules, in the order they are matched.
RULES = [
    ("MIT", ["MitGrant", "MitNotice", "MitAsIs"]),
    ("BSD-3-Clause", ["BsdPre", "BsdSource", "BsdBinary", "BsdEndorse"]),
    ("BSD-2-Clause", ["BsdPre", "BsdSource", "BsdBinary"]),
    ("Apache-2.0", ["Apache2Ref", "Apache2Comply", "Apache2Copy"]),
    ("Apache-2.0", ["Apache2Ref"]),
    *[(n, [n]) for n in SPDX if n.endswith(("-or-later", "-only"))],
    ("GPL-3.0", ["Gpl3Ref"]),
    ("GPL-2.0", ["Gpl2Ref"]),
    ("MIT", ["MitRef"]),
    ("ISC", ["IscGrant"]),
    ("CC-BY-NC-4.0", ["CcByNc4Ref"]),
    ("CC-BY-SA-4.0", ["CcBySa4Ref"]),
    ("CC-BY-4.0", ["CcBy4Ref"]),
    ("MPL-2.0", ["Mpl2Ref"]),
    ("EPL-2.0", ["Epl2Ref"]),
    ("EPL-1.0", ["Epl1Ref"]),
    ("Unlicense", ["UnlicenseRef"]),
    ("CC0-1.0", ["Cc0Waiver"]),
    ("CC0-1.0", ["Cc0Ref"]),
    *[(n, [f"Spdx-{n}"]) for n in SPDX],
    ("Proprietary", ["AllRights"]),
]
UNKNOWN, RESERVED = "Unknown", "Proprietary"

# Patterns that Java and RE2 read alike. A sentence ends at . ! ? ; : before white space and at an empty line.
LINE = r"\r\n?"
MARKS = r"\n[ \t]*(//+|/\*+|\*+/?|#+|--+|;+|%+|>+)[ \t]*"
END = r"([.!?;:])(\s|$)"
GAP = r"\n[ \t]*\n"
SPEAKS = r"licen[cs]ed? |copyright|redistribut|all rights|warrant"
BREAK = "\u0001"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _pattern(sentences: list[list[str]]) -> str:
    """One pattern for word sequences: shared beginnings are written once, and the longest sequence is tried first."""
    nexts: dict[str, list[list[str]]] = {}
    for words in sentences:
        if words:
            nexts.setdefault(words[0], []).append(words[1:])
    ways = []
    for word, rest in sorted(nexts.items()):
        more = _pattern(rest)
        ways.append(f" {word} " + (f"(?:\\x01?{more})?" if more and [] in rest else f"\\x01?{more}" if more else ""))
    return f"(?:{'|'.join(ways)})" if ways else ""


#: A known sentence in the laid-out words; a sentence end may stand between each two words.
KNOWN = _pattern([s.split() for s in SENTENCES])

# Every known sentence holds one of these, so words without any are not searched by pattern.
MARKERS = ("licens", "software", "rights", "redistribut", "public", "cc0", "copyright")
assert all(any(m in s for m in MARKERS) for s in SENTENCES)


def cut_sentences(text: Column) -> Column:
    """array<string> of the normalised, non-empty sentences of a text, as its marks and empty lines cut it."""
    lower = F.translate(F.regexp_replace(F.regexp_replace(text, BREAK, " "), LINE, "\n"), UPPER, LOWER)
    marked = F.regexp_replace(F.regexp_replace(F.concat(F.lit("\n"), lower), MARKS, "\n"), GAP, BREAK)
    cut = F.regexp_replace(marked, END, "$1" + BREAK)
    plain = F.transform(F.split(cut, BREAK, -1), lambda s: F.trim(F.regexp_replace(s, r"[^a-z0-9]+", " ")))
    return F.filter(plain, lambda s: s != "")


def laid_out(found: Column) -> Column:
    """Sentences as one string: every word between blanks of its own, a mark between sentences."""
    return F.array_join(F.transform(found, lambda s: F.concat(
        F.lit(" "), F.replace(s, F.lit(" "), F.lit("  ")), F.lit(" "))), BREAK)


def _plain(words: Column) -> Column:
    return F.trim(F.replace(words, F.lit("  "), F.lit(" ")))


def sentences(words: Column) -> Column:
    """array<string> of sentences, known ones whole, from laid-out words.

    ``split`` and ``regexp_extract_all`` walk the same matches: each known
    sentence stands between two pieces, which keep their own cuts.
    """
    pieces = F.arrays_zip(F.split(words, KNOWN, -1).alias("rest"),
                          F.regexp_extract_all(words, F.lit(KNOWN), F.lit(0)).alias("known"))
    parted = F.flatten(F.transform(pieces, lambda p: F.concat(
        F.transform(F.split(p["rest"], BREAK, -1), _plain),
        F.array(F.coalesce(_plain(F.replace(p["known"], F.lit(BREAK), F.lit(""))), F.lit(""))))))
    whole = F.transform(F.split(words, BREAK, -1), _plain)
    marked = functools.reduce(Column.__or__, [F.contains(words, F.lit(m)) for m in MARKERS])
    return F.filter(F.when(marked & words.rlike(KNOWN), parted).otherwise(whole), lambda s: s != "")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, sequence, licenses, n_sentences, n_unknown) per row.

    ``sequence``: the identifiers in order, as <A><B>; ``licenses``: the
    licences whose rules matched, in rule order, comma-joined ('' if none).
    Null and empty texts have no sentences. Repeated rows give a row each,
    an empty table none. Texts of any length are read whole.
    """
    known = F.create_map(*[F.lit(x) for pair in SENTENCES.items() for x in pair])
    rows = common.ids_and_texts(docs, id_col, text_col)
    words = rows.select("doc_id", laid_out(cut_sentences(F.col("text"))).alias("words"))
    found = words.select("doc_id", sentences(F.col("words")).alias("sentences"))
    ids = F.transform("sentences", lambda s: F.coalesce(
        F.try_element_at(known, s), F.when(F.concat(s, F.lit(" ")).rlike(SPEAKS), F.lit(UNKNOWN))))
    marks = F.transform(F.filter(ids, lambda i: i.isNotNull()), lambda i: F.concat(F.lit("<"), i, F.lit(">")))
    found = found.select("doc_id", F.size("sentences").cast("long").alias("n_sentences"),
                         F.array_join(marks, "").alias("sequence"))
    rest, hits = F.col("sequence"), []
    for name, rule in RULES:
        wanted = F.lit("".join(f"<{i}>" for i in rule))
        hits.append(F.when(F.contains(rest, wanted), F.lit(name)))
        rest = F.replace(rest, wanted, F.lit("|"))
    named = F.array_distinct(F.filter(F.array(*hits), lambda h: h.isNotNull()))
    names = F.array_join(F.when(F.size(named) > 1, F.array_remove(named, RESERVED)).otherwise(named), ",")
    unknown = (F.length("sequence") - F.length(F.replace("sequence", F.lit(f"<{UNKNOWN}>"), F.lit("")))) \
        / F.lit(len(UNKNOWN) + 2)
    return found.select("doc_id", "sequence", names.alias("licenses"), "n_sentences", unknown.cast("long").alias("n_unknown"))


def op2_sentence_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(common.table(spark, sf_dir, "documents"))


def _sql() -> str:
    def text(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    known = ", ".join(f"{text(s)}: {text(i)}" for s, i in SENTENCES.items())
    brk = "chr(1)"
    # Rule by rule, what a rule matches becomes a bar; the names that matched are gathered beside it.
    steps, at = [], "q"
    for k, (name, rule) in enumerate(RULES):
        wanted = text("".join(f"<{i}>" for i in rule))
        steps.append(f"r{k} AS (SELECT * REPLACE (replace(rest, {wanted}, '|') AS rest, CASE WHEN contains(rest, {wanted}) "
                     f"AND NOT list_contains(named, {text(name)}) THEN list_append(named, {text(name)}) ELSE named END "
                     f"AS named) FROM {at})")
        at = f"r{k}"
    rules = ",\n".join(steps)
    return f"""
WITH cut AS (
  SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(
      chr(10) || translate(regexp_replace(replace(coalesce(text, ''), {brk}, ' '), {text(LINE)}, chr(10), 'g'),
        '{UPPER}', '{LOWER}'),
      {text(MARKS)}, chr(10), 'g'), {text(GAP)}, {brk}, 'g'), {text(END)}, '\\1' || {brk}, 'g') AS body
  FROM documents),
w AS (
  SELECT doc_id, coalesce(array_to_string(list_transform(list_filter(list_transform(string_split(body, {brk}),
      lambda x: trim(regexp_replace(x, '[^a-z0-9]+', ' ', 'g'))), lambda x: x <> ''),
      lambda x: ' ' || replace(x, ' ', '  ') || ' '), {brk}), '') AS words FROM cut),
p AS (
  SELECT doc_id, string_split_regex(words, {text(KNOWN)}) AS rests,
      regexp_extract_all(words, {text(KNOWN)}) AS found FROM w),
s AS (
  SELECT doc_id, list_filter(list_transform(flatten(list_transform(range(1, len(rests) + 1),
      lambda k: list_concat(string_split(rests[k], {brk}), CASE WHEN k <= len(found) THEN [replace(found[k], {brk}, '')]
        ELSE [] END))), lambda x: trim(replace(x, '  ', ' '))), lambda x: x <> '') AS sentences FROM p),
i AS (
  SELECT doc_id, len(sentences) AS n_sentences, list_filter(list_transform(sentences,
      lambda x: coalesce(MAP {{{known}}}[x], CASE WHEN regexp_matches(x || ' ', {text(SPEAKS)}) THEN '{UNKNOWN}' END)),
      lambda x: x IS NOT NULL) AS ids FROM s),
q AS (
  SELECT *, sequence AS rest, CAST([] AS VARCHAR[]) AS named FROM (
    SELECT doc_id, n_sentences, coalesce(list_aggregate(list_transform(ids, lambda x: '<' || x || '>'),
      'string_agg', ''), '') AS sequence FROM i)),
{rules}
SELECT doc_id, sequence, array_to_string(CASE WHEN len(named) > 1 THEN list_filter(named, lambda x: x <> '{RESERVED}')
    ELSE named END, ',') AS licenses, CAST(n_sentences AS BIGINT) AS n_sentences,
  CAST((length(sequence) - length(replace(sequence, '<{UNKNOWN}>', ''))) / {len(UNKNOWN) + 2} AS BIGINT) AS n_unknown
FROM {at}"""


OP2_SQL = _sql()
