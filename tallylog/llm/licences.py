"""Licence scans by sentence rules, in DataFrame operations.

1. A text is cut into pieces, by line breaks, stops and commas, which are normalised: lower
   case, and one space for any run of marks or white space.
2. Pieces that are a known licence sentence, one or some in a row put together, get its
   identifier; others get none. A reference to a licence by name is known whatever it
   begins with ("this file is licensed under", "released under").
3. Ordered licence rules are matched against the sequence of identifiers: a rule is a
   sequence of identifiers; where it occurs in a row, its sentences are consumed and
   the document has the rule's licence. Earlier rules go first, so a longer text of
   sentences is taken before its parts. Identifiers that no rule takes are reported as
   unmatched.

The known sentences and the rules are small fixed lists; each document is matched
where it is, so nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylog.llm.common import table

#: What a reference to a licence may begin with. All of it stands for "licensed under".
SUBJECTS = "work|program|project|file|software|code|source code|library|package|repository|module|content|document|text|program and the accompanying materials"
VERBS = "licensed|released|distributed|available|made available|provided|published|redistributed"
LEAD = f"(?:(?:this|the|all|our)_(?:{SUBJECTS})_(?:is|are)_(?:hereby_)?)?(?:{VERBS})_under_(?:the_terms_of_)?"

#: The names of licences after "licensed under".
NAMES: dict[str, list[str]] = {
    **{f"{short}{version.replace(' ', '')}Work": [f"{the}{name} {v}" for the in ("the ", "") for name in names for n in numbers for v in (f"version {n}", f"v {n}", f"v{n}", n)]
       for short, names, versions in (
           ("Gpl", ["gnu general public license", "gnu gpl", "gpl"], {"2": ["2", "2 0"], "3": ["3", "3 0"]}),
           ("Lgpl", ["gnu lesser general public license", "gnu library general public license", "gnu lgpl", "lgpl"], {"2 1": ["2 1"], "3": ["3", "3 0"]}),
           ("Agpl", ["gnu affero general public license", "gnu agpl", "agpl"], {"3": ["3", "3 0"]}))
       for version, numbers in versions.items()},
    "Apache2Ref": ["the apache license version 2 0", "the apache license 2 0", "apache license version 2 0", "apache license 2 0", "the apache 2 0 license",
                   "apache 2 0", "the apache license version 2 0 the license", "the apache license v2 0"],
    "MitRef": ["the mit license", "the mit licence", "mit license", "mit", "an mit license", "the mit x11 license", "the terms of the mit license"],
    "Bsd2Ref": ["the bsd 2 clause license", "the 2 clause bsd license", "the simplified bsd license", "the freebsd license", "bsd 2 clause"],
    "Bsd3Ref": ["the bsd 3 clause license", "the 3 clause bsd license", "the new bsd license", "the modified bsd license", "bsd 3 clause"],
    "IscRef": ["the isc license", "isc license", "isc"],
    "Mpl2Ref": ["the mozilla public license version 2 0", "the mozilla public license v 2 0", "the mozilla public license 2 0", "the mpl 2 0", "mpl 2 0"],
    "Epl1Ref": ["the eclipse public license version 1 0", "the eclipse public license v1 0", "the eclipse public license 1 0", "the epl 1 0"],
    "Epl2Ref": ["the eclipse public license version 2 0", "the eclipse public license v2 0", "the eclipse public license 2 0", "the eclipse public license v 2 0",
                "the epl 2 0"],
    "UnlicenseRef": ["the unlicense", "unlicense"],
    "Cc0": ["cc0 1 0", "cc0", "the cc0 1 0 universal license", "the creative commons zero v1 0 universal license"],
    **{name: [f"cc by {short}4 0", *[f"{a} creative commons attribution {long}4 0 international license" for a in ("a", "the")], f"creative commons attribution {long}4 0"]
       for name, short, long in (("CcBy4", "", ""), ("CcBySa4", "sa ", "sharealike "), ("CcByNc4", "nc ", "noncommercial "), ("CcByNd4", "nd ", "noderivatives "),
                                 ("CcByNcSa4", "nc sa ", "noncommercial sharealike "), ("CcByNcNd4", "nc nd ", "noncommercial noderivatives "))},
}
#: What may follow the name of a licence of the GNU family.
LATER = ["or later", "or any later version", "or at your option any later version", "or newer", "only"]

#: Identifiers of SPDX.
SPDX = ("Apache-2.0 MIT BSD-2-Clause BSD-3-Clause ISC MPL-2.0 EPL-1.0 EPL-2.0 Unlicense CC0-1.0 CC-BY-4.0 CC-BY-SA-4.0 CC-BY-NC-4.0 CC-BY-ND-4.0 "
        "CC-BY-NC-SA-4.0 CC-BY-NC-ND-4.0 GPL-2.0 GPL-3.0 LGPL-2.1 LGPL-3.0 AGPL-3.0 Zlib BSL-1.0 0BSD").split()


def _spdx(licence: str) -> tuple[str, list[str]]:
    """The identifier and the normalised sentences of an SPDX tag."""
    tag = f"spdx license identifier {licence.lower().replace('-', ' ').replace('.', ' ')}"
    return "Spdx" + licence.replace("-", "").replace(".", ""), [tag, *([f"{tag} {x}" for x in ("only", "or later")] if "GPL" in licence else [])]


#: Identifiers and the normalised sentences that they stand for.
SENTENCES: dict[str, list[str]] = {
    **{name: [f"licensed under {t}{later}" for t in texts for later in ("", *(f" {x}" for x in LATER if name.endswith("Work")))] for name, texts in NAMES.items()},
    **dict(map(_spdx, SPDX)),
    "AllRights": ["all rights reserved", "all rights are reserved"],
    "PublicDomain": ["this work is dedicated to the public domain"],
    "UnlicenseText": ["this is free and unencumbered software released into the public domain"],
    "IscGrant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above "
                 "copyright notice and this permission notice appear in all copies",
                 "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above "
                 "copyright notice and this permission notice appear in all copies"],
    **{f"{name}Notice": [f"this {work} is free software you can redistribute it and or modify it under the terms of the gnu {kind} public license "
                         f"as published by the free software foundation either version {version} of the license or at your option any later version"
                         for work in ("program", "library", "file")]
       for name, kind, version in (("Gpl3", "general", "3"), ("Gpl2", "general", "2"), ("Lgpl3", "lesser general", "3"),
                                            ("Lgpl21", "lesser general", "2 1"), ("Agpl3", "affero general", "3"))},
    "GplWarranty": [f"this {work} is distributed in the hope that it will be useful but without any warranty without even the implied warranty of "
                    "merchantability or fitness for a particular purpose" for work in ("program", "library", "file")],
    "GplSee": [f"see the gnu {kind} public license for more details" for kind in ("general", "lesser general")],
    "GplCopy": [f"you should have received a copy of the gnu {kind} public license along with this {work}"
                for kind in ("general", "lesser general") for work in ("program", "library", "file")],
    "Apache2Comply": ["you may not use this file except in compliance with the license"],
    "Apache2Warranty": ["unless required by applicable law or agreed to in writing software distributed under the license is distributed on an "
                        "as is basis without warranties or conditions of any kind either express or implied"],
    "Apache2See": ["see the license for the specific language governing permissions and limitations under the license"],
    "Apache2Copy": ["you may obtain a copy of the license at http www apache org licenses license 2 0"],
    "Bsd2Cond": ["redistribution and use in source and binary forms with or without modification are permitted provided "
                 "that the following conditions are met"],
    "BsdSource": ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    "BsdBinary": ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the following "
                  "disclaimer in the documentation and or other materials provided with the distribution"],
    "BsdName": [f"neither the name of {who} may be used to endorse or promote products derived from this software without specific "
                "prior written permission" for who in ("the copyright holder nor the names of its contributors",
                                                       "the copyright holders nor the names of its contributors",
                                                       "the copyright holder nor the names of the contributors")],
    "BsdWarranty": ["this software is provided by the copyright holders and contributors as is and any express or implied warranties including "
                    "but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"],
    "MitGrant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
                 "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
                 "the software to deal in the software without restriction including without limitation the rights to use copy modify merge "
                 "publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to "
                 "do so subject to the following conditions"],
    "MitNotice": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "MitWarranty": ["the software is provided as is without warranty of any kind express or implied including but not limited to the warranties "
                    "of merchantability fitness for a particular purpose and noninfringement"],
    "Mpl2Form": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
}
#: Licences and the sequences of identifiers that stand for them, in order of precedence.
RULES: list[tuple[str, list[str]]] = [
    ("BSD-3-Clause", ["Bsd2Cond", "BsdSource", "BsdBinary", "BsdName", "BsdWarranty"]),
    ("BSD-3-Clause", ["Bsd2Cond", "BsdSource", "BsdBinary", "BsdName"]),
    ("BSD-2-Clause", ["Bsd2Cond", "BsdSource", "BsdBinary", "BsdWarranty"]),
    ("BSD-2-Clause", ["Bsd2Cond", "BsdSource", "BsdBinary"]),
    ("Apache-2.0", ["Apache2Ref", "Apache2Comply", "Apache2Copy", "Apache2Warranty", "Apache2See"]),
    ("Apache-2.0", ["Apache2Ref", "Apache2Comply", "Apache2Copy"]),
    ("Apache-2.0", ["Apache2Ref", "Apache2Comply"]),
    ("Apache-2.0", ["Apache2Ref", "Apache2Copy"]),
    ("Apache-2.0", ["Apache2Ref"]),
    *[(licence, [f"{name}Notice", *rest]) for rest in (["GplWarranty", "GplSee", "GplCopy"], ["GplWarranty", "GplSee"], [])
      for licence, name in (("GPL-3.0", "Gpl3"), ("GPL-2.0", "Gpl2"), ("LGPL-3.0", "Lgpl3"), ("LGPL-2.1", "Lgpl21"), ("AGPL-3.0", "Agpl3"))],
    ("GPL-3.0", ["Gpl3Work"]),
    ("GPL-2.0", ["Gpl2Work"]),
    ("LGPL-3.0", ["Lgpl3Work"]),
    ("LGPL-2.1", ["Lgpl21Work"]),
    ("AGPL-3.0", ["Agpl3Work"]),
    ("CC-BY-NC-4.0", ["CcByNc4"]),
    ("CC-BY-SA-4.0", ["CcBySa4"]),
    ("CC-BY-4.0", ["CcBy4"]),
    ("CC-BY-ND-4.0", ["CcByNd4"]),
    ("CC-BY-NC-SA-4.0", ["CcByNcSa4"]),
    ("CC-BY-NC-ND-4.0", ["CcByNcNd4"]),
    ("CC0-1.0", ["Cc0"]),
    ("CC0-1.0", ["PublicDomain"]),
    ("MIT", ["MitGrant", "MitNotice", "MitWarranty"]),
    ("MIT", ["MitGrant", "MitNotice"]),
    ("MIT", ["MitGrant"]),
    ("MIT", ["MitRef"]),
    ("MPL-2.0", ["Mpl2Form"]),
    ("MPL-2.0", ["Mpl2Ref"]),
    ("BSD-2-Clause", ["Bsd2Ref"]),
    ("BSD-3-Clause", ["Bsd3Ref"]),
    ("ISC", ["IscGrant"]),
    ("ISC", ["IscRef"]),
    ("EPL-1.0", ["Epl1Ref"]),
    ("EPL-2.0", ["Epl2Ref"]),
    ("Unlicense", ["UnlicenseText"]),
    ("Unlicense", ["UnlicenseRef"]),
    *[(licence, [_spdx(licence)[0]]) for licence in SPDX],
    ("Proprietary", ["AllRights"]),
]

#: Ends of pieces: a line break, or a full stop, mark, semicolon or comma before white space or the end.
CUT = r"[\n\r]+|[.!?;,]+(?:[ \t]+|$)"
#: Each known sentence holds one of these, as a part of one word; a text without any of them has no known sentence.
HINT = r"(?i)licens|cc0|reserved|domain|redistribut|permission|warrant|released|distributed|available|published|provided"


def _pattern(text: str, gap: str) -> str:
    """A text (or a pattern with _ for spaces) where a cut may stand in the place of any space."""
    return text.replace("_", " ").replace(" ", gap)


def _any_of(texts: list[list[str]], gap: str) -> str:
    """A pattern for any of some texts, given as words; of those that fit at one place it takes the longest."""
    after: dict[str, list[list[str]]] = {}
    for words in texts:
        after.setdefault(words[0], []).append(words[1:])
    out = []
    for word, rests in sorted(after.items()):
        more = [r for r in rests if r]
        tail = f"{gap}(?:{_any_of(more, gap)})" if more else ""
        out.append(word + (f"(?:{tail})?" if tail and len(more) < len(rests) else tail))
    return "|".join(out)


REFERENCE = "licensed under "


def _any_known(gap: str) -> str:
    texts = sorted({t for ts in SENTENCES.values() for t in ts})
    names = _any_of([t.removeprefix(REFERENCE).split(" ") for t in texts if t.startswith(REFERENCE)], gap)
    others = _any_of([t.split(" ") for t in texts if not t.startswith(REFERENCE)], gap)
    return f"{_pattern(LEAD, gap)}(?:{names})|{others}"


#: A whole known sentence, as group 1, in a normalised text with bars for cuts; the number of an item may stand before it.
KNOWN = rf"(?<=\|)(?:[0-9] )?({_any_known('[ |]')})(?=\|)"


#: What a rule leaves in the place of the identifiers that it took.
TAKEN = "|-|"


def _sequence(names: list[str]) -> str:
    return "".join(f"|{n}|" for n in names)


def _known() -> Column:
    return F.create_map(*[F.lit(x) for name, texts in SENTENCES.items() for t in texts for x in (t, name)])


def sentence_ids(text: Column) -> Column:
    """The identifiers of the known licence sentences of a text, in order; empty for a null text."""
    none = F.array().cast("array<string>")
    # the text as |piece|piece|...|, U+0001 being a cut
    cut = F.regexp_replace(F.lower(F.translate(text, "\x01", " ")), CUT, "\x01")
    normal = F.regexp_replace(F.regexp_replace(cut, "[^a-z0-9\x01]+", " "), " ?\x01[ \x01]*", "|")
    normal = F.concat(F.lit("|"), F.trim(normal), F.lit("|"))
    found = F.transform(F.regexp_extract_all(normal, F.lit(KNOWN), F.lit(1)),
                        lambda s: F.try_element_at(_known(), F.regexp_replace(F.translate(s, "|", " "), f"^{_pattern(LEAD, ' ')}", REFERENCE)))
    return F.coalesce(F.when(text.rlike(HINT), found), none)


def match_rules(ids: Column) -> Column:
    """struct(licences, unmatched): the distinct licences in order of the rules, and the identifiers that no rule took.

    The sequence is written as one string with a bar on either side of each name; a
    rule takes all its occurrences, from left to right, and leaves a mark in their
    place, so that no later rule reaches across.
    """
    left = F.array_join(F.transform(ids, lambda i: F.concat(F.lit("|"), i, F.lit("|"))), "")
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(_sequence(seq)).alias("seq")) for name, seq in RULES])

    def apply(s: Column, rule: Column) -> Column:
        return F.struct(F.replace(s["left"], rule["seq"], F.lit(TAKEN)).alias("left"), F.when(
            F.contains(s["left"], rule["seq"]), F.array_union(s["licences"], F.array(rule["name"]))).otherwise(s["licences"]).alias("licences"))

    def finish(s: Column) -> Column:
        rest = F.filter(F.split(s["left"], r"\|+"), lambda i: ~i.isin("", "-"))
        return F.struct(s["licences"].alias("licences"), rest.alias("unmatched"))

    start = F.struct(left.alias("left"), F.array().cast("array<string>").alias("licences"))
    return F.aggregate(rules, start, apply, finish)


def scan_licences(docs: DataFrame) -> DataFrame:
    """Add ``sentence_ids``, ``licences`` and ``unmatched`` (arrays of strings) to ``docs`` (text); columns of these names are replaced.

    A null or empty text has none of them. Repeated rows are scanned alike; a repeated
    sentence counts once for each time. An empty table gives no rows. Whole texts are
    scanned, however long. Other columns, of any name but __ids and __found, are kept.
    """
    added = ("sentence_ids", "licences", "unmatched")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in added]
    return (docs.withColumn("__ids", sentence_ids(F.col("text"))).withColumn("__found", match_rules(F.col("__ids")))
            .select(*kept, F.col("__ids").alias("sentence_ids"), "__found.*"))


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licences of all ``documents``; lists are joined by a comma."""
    out = scan_licences(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", *[F.array_join(c, ",").alias(c) for c in ("sentence_ids", "licences", "unmatched")])


def _oracle() -> str:
    known = " ".join(f"WHEN '{t}' THEN '{name}'" for name, texts in SENTENCES.items() for t in texts)
    steps, last = [], "s0"
    for i, (name, seq) in enumerate(RULES):
        q = _sequence(seq)
        steps.append(f"s{i + 1} AS (SELECT doc_id, ids, replace(lft, '{q}', '{TAKEN}') AS lft, CASE WHEN contains(lft, '{q}') "
                     f"AND NOT list_contains(lic, '{name}') THEN list_append(lic, '{name}') ELSE lic END AS lic FROM {last})")
        last = f"s{i + 1}"
    cut = CUT.replace("\\n", "\n").replace("\\r", "\r").replace("\\t", "\t")
    gap = "(?: |[|][|])"  # bars stand twice, so that one match leaves the next its own
    return f"""
WITH c AS (SELECT doc_id, regexp_replace(lower(translate(coalesce(text, ''), chr(1), ' ')), '{cut}', chr(1), 'g') AS t FROM documents),
n AS (SELECT doc_id, '|' || trim(regexp_replace(regexp_replace(t, '[^a-z0-9\x01]+', ' ', 'g'), ' ?\x01[ \x01]*', '|', 'g'), ' ') || '|' AS t FROM c),
k AS (SELECT doc_id, [regexp_replace(replace(x, '||', ' '), '^{_pattern(LEAD, ' ')}', '{REFERENCE}')
             FOR x IN regexp_extract_all(replace(t, '|', '||'), '[|](?:[0-9] )?({_any_known(gap)})[|]', 1)] AS found FROM n),
d AS (SELECT doc_id, [CASE x {known} END FOR x IN found] AS ids FROM k),
s0 AS (SELECT doc_id, ids, coalesce(array_to_string(['|' || x || '|' FOR x IN ids], ''), '') AS lft, CAST([] AS VARCHAR[]) AS lic FROM d),
{', '.join(steps)}
SELECT doc_id, coalesce(array_to_string(ids, ','), '') AS sentence_ids, coalesce(array_to_string(lic, ','), '') AS licences,
  coalesce(array_to_string([x FOR x IN string_split_regex(lft, '\\|+') IF x NOT IN ('', '-')], ','), '') AS unmatched FROM {last}"""


ORACLE_SQL = _oracle()
