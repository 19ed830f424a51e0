"""License scans by sentence rules (operator 1).

Texts are cut into sentences, sentences normalised and mapped to identifiers of
known licence sentences; the sequence of a text's identifiers is then matched
against ordered rules, each taking the identifiers it explains. What no rule
explains is reported as unmatched.

An SPDX tag gives an identifier for each licence id of its expression (OR, AND and
WITH, brackets, a plus sign), each a rule of its own: ids are compared whole, so MIT-0
is not MIT. A sentence that speaks of a licence but matches no pattern, and an SPDX
id that is not listed, have identifiers that no rule takes.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Licence sentences (identifier, pattern in the normalised
# sentence; the first that matches names it) and rules (licence, identifiers in
# order; a rule takes every place where it matches before the next is tried).
# ---------------------------------------------------------------------------
SENTENCES = [
    ("Apache2Under", r"licensed under the apache license,? version 2(\.0)?"),
    ("Apache2Compliance", r"you may not use this (file|work) except in compliance with the license"),
    ("Apache2Copy", r"you may obtain a copy of the license at"),
    ("Apache2Asis", r"unless required by applicable law or agreed to in writing"),
    ("MitUnder", r"(released|licensed|available|distributed) under the (terms of the )?mit license"),
    ("MitGrant", r"permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("MitNotice", r"the above copyright notice and this permission notice shall be included"),
    ("MitAsis", r"the software is provided .as is., without warranty of any kind"),
    ("BsdGrant", r"redistribution and use in source and binary forms, with or without modification"),
    ("BsdSource", r"redistributions of source code must retain the above copyright"),
    ("BsdBinary", r"redistributions in binary form must reproduce the above copyright"),
    ("BsdName", r"neither the name of .* may be used to endorse or promote"),
    ("BsdAsis", r"this software is provided by .* .as is. and any express or implied"),
    ("LgplLater", r"gnu (lesser|library) general public license.*any later version"),
    ("LgplUnder", r"licensed under the gnu (lesser|library) general public license"),
    ("AgplUnder", r"(licensed under|under the terms of) the gnu affero general public license"),
    ("Gpl3Later", r"gnu general public license.*version 3.*any later version"),
    ("Gpl2Later", r"gnu general public license.*version 2.*any later version"),
    ("Gpl3Under", r"(licensed under|under the terms of) the gnu general public license,? version 3"),
    ("Gpl2Under", r"(licensed under|under the terms of) the gnu general public license,? version 2"),
    ("GplWarranty", r"without even the implied warranty of merchantability or fitness"),
    ("GplReceived", r"you should have received a copy of the gnu"),
    ("Mpl2Under", r"subject to the terms of the mozilla public license, v\. ?2\.0"),
    ("CcByNcSa4", r"licensed under (a |the )?(cc by-nc-sa|creative commons attribution-noncommercial-sharealike) 4\.0"),
    ("CcByNcNd4", r"licensed under (a |the )?(cc by-nc-nd|creative commons attribution-noncommercial-noderivatives) 4\.0"),
    ("CcByNc4", r"licensed under (a |the )?(cc by-nc|creative commons attribution-noncommercial) 4\.0"),
    ("CcBySa4", r"licensed under (a |the )?(cc by-sa|creative commons attribution-sharealike) 4\.0"),
    ("CcBy4", r"licensed under (a |the )?(cc by|creative commons attribution) 4\.0"),
    ("Cc0", r"(cc0 1\.0|dedicated .* to the public domain)"),
    ("AllRights", r"all rights reserved"),
    ("OtherLicense", r"(licensed|released|distributed) under "),
]
RULES = [
    ("BSD-3-Clause", ["BsdGrant", "BsdSource", "BsdBinary", "BsdName", "BsdAsis"]),
    ("BSD-2-Clause", ["BsdGrant", "BsdSource", "BsdBinary", "BsdAsis"]),
    ("MIT", ["MitGrant", "MitNotice", "MitAsis"]),
    ("MIT", ["MitUnder"]),
    ("Apache-2.0", ["Apache2Under", "Apache2Compliance", "Apache2Copy", "Apache2Asis"]),
    ("Apache-2.0", ["Apache2Under"]),
    ("LGPL-or-later", ["LgplLater", "GplWarranty", "GplReceived"]),
    ("LGPL-or-later", ["LgplLater"]),
    ("LGPL", ["LgplUnder"]),
    ("AGPL", ["AgplUnder"]),
    ("GPL-3.0-or-later", ["Gpl3Later", "GplWarranty", "GplReceived"]),
    ("GPL-3.0-or-later", ["Gpl3Later"]),
    ("GPL-2.0-or-later", ["Gpl2Later", "GplWarranty", "GplReceived"]),
    ("GPL-2.0-or-later", ["Gpl2Later"]),
    ("GPL-3.0", ["Gpl3Under"]),
    ("GPL-2.0", ["Gpl2Under"]),
    ("MPL-2.0", ["Mpl2Under"]),
    ("CC-BY-NC-SA-4.0", ["CcByNcSa4"]),
    ("CC-BY-NC-ND-4.0", ["CcByNcNd4"]),
    ("CC-BY-NC-4.0", ["CcByNc4"]),
    ("CC-BY-SA-4.0", ["CcBySa4"]),
    ("CC-BY-4.0", ["CcBy4"]),
    ("CC0-1.0", ["Cc0"]),
]
# Licence ids of SPDX tags that are known.
SPDX = """
0BSD AFL-3.0 AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.1 Apache-2.0 Artistic-2.0 BSD-2-Clause BSD-3-Clause BSL-1.0
CC-BY-4.0 CC-BY-NC-4.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-4.0 CC-BY-SA-4.0 CC0-1.0 EPL-1.0 EPL-2.0 EUPL-1.2 GPL-2.0 GPL-2.0-only
GPL-2.0-or-later GPL-3.0 GPL-3.0-only GPL-3.0-or-later ISC LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only
LGPL-3.0-or-later MIT MIT-0 MPL-2.0 MS-PL OFL-1.1 PostgreSQL Unlicense WTFPL Zlib
""".split()
# A sentence without any of these matches no pattern.
HINT = r"licens|licenc|permission|redistribut|warranty|software is provided|spdx|gnu|creative commons|cc0|public domain|all rights reserved|applicable law|endorse|(released|distributed) under"
# A sentence with one of these speaks of a licence.
LICENSE_LIKE = r"\blicens(e|es|ed|ing)\b|spdx|creative commons|public domain"
# ---------------------------------------------------------------------------

_SPDX_ID = r"\(*[a-z0-9](?:[a-z0-9.+-]*[a-z0-9+])?\)*"
SPDX_TAG = rf"spdx-license-identifier: ?({_SPDX_ID}(?: (?:or|and|with) {_SPDX_ID})*)"
_EXCEPTION = r" with [^ ()]+"
SPDX_PREFIX, UNKNOWN_SPDX, UNKNOWN = "Spdx:", "UnknownSpdx", "UnknownLicense"
_SPDX_PART = f",{SPDX_PREFIX}([^,]+),"

# (pattern, replacement) steps that normalise a text before it is cut.
_NORMAL = [(r"licence", "license"), (r"[‘’“”\"`]", "'"), (r"(^|\n)[ \t]*(/\*+|\*+/|//+|\*+|#+|--+|;+)", " "), (r"[ \t\r\n\f\x0B ]+", " ")]
_END = (r"([.!?]) ", "\n")


def spdx_names() -> dict[str, str]:
    """Lower-cased ids of SPDX expressions, with and without a plus sign, and their identifiers."""
    names = {x.lower(): x for x in SPDX}
    later = {f"{k}+": names.get(f"{k}-or-later", x) for k, x in names.items() if not k.endswith(("-only", "-or-later"))}
    return {k: SPDX_PREFIX + x for k, x in (names | later).items()}


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known licence sentences of a text, in order."""
    normal = F.lower(F.coalesce(text, F.lit("")))
    for pattern, to in _NORMAL:
        normal = F.regexp_replace(normal, pattern, to)
    cut = F.split(F.regexp_replace(normal, _END[0], f"$1{_END[1]}"), "\n")
    known = F.from_json(F.lit(json.dumps(spdx_names())), "map<string,string>")

    def name(s: Column) -> Column:
        named = reduce(lambda found, rule: found.when(s.rlike(rule[1]), F.lit(rule[0])), SENTENCES[1:], F.when(s.rlike(SENTENCES[0][1]), F.lit(SENTENCES[0][0])))
        return named.when(s.rlike(LICENSE_LIKE), F.lit(UNKNOWN))

    def of_tag(s: Column) -> Column:
        tag = F.regexp_replace(F.regexp_extract(s, SPDX_TAG, 1), _EXCEPTION, "")
        tokens = F.filter(F.split(tag, "[() ]+"), lambda t: ~t.isin("", "or", "and"))
        return F.transform(tokens, lambda t: F.coalesce(F.element_at(known, t), F.lit(UNKNOWN_SPDX)))

    def names(s: Column) -> Column:
        rest = F.array_compact(F.array(name(F.regexp_replace(s, SPDX_TAG, " "))))
        return F.when(F.contains(s, F.lit("spdx-license-identifier")), F.concat(of_tag(s), rest)).otherwise(F.array_compact(F.array(name(s))))

    ids = F.flatten(F.transform(F.filter(cut, lambda s: s.rlike(HINT)), names))
    # Most texts have no such sentence: they are not cut at all.
    return F.when(F.lower(F.coalesce(text, F.lit(""))).rlike(HINT), ids).otherwise(F.array().cast("array<string>"))


def scan(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, `sentences` (identifiers in order), `licenses`
    (those whose rule matched, in the rules' order, each once) and `unmatched`
    (identifiers left over), as comma-joined strings, empty if there are none.

    Licences of SPDX tags come first, in the text's order. A null or empty text has
    none. Repeated rows and null ids give a row each; columns besides doc_id and text
    are not looked at. An empty table gives an empty result.
    """
    ids = docs.select("doc_id", F.explode(F.array(sentence_ids(F.col("text")))).alias("ids"))
    # Identifiers are set off by commas, and a taken one leaves a bar, which
    # no rule reaches over.
    left = F.concat(F.lit(","), F.array_join("ids", ",,"), F.lit(","))
    tagged = F.regexp_extract_all(left, F.lit(_SPDX_PART), F.lit(1))
    left = F.regexp_replace(left, _SPDX_PART, "|")
    found = []
    for name, sequence in RULES:
        part = "," + ",,".join(sequence) + ","
        found.append(F.when(F.contains(left, F.lit(part)), F.lit(name)))
        left = F.replace(left, F.lit(part), F.lit("|"))
    rest = F.array_join(F.filter(F.split(left, r"[,|]+"), lambda x: x != ""), ",")
    return ids.select(
        "doc_id", F.array_join("ids", ",").alias("sentences"),
        F.array_join(F.array_distinct(F.concat(tagged, F.array_compact(F.array(*found)))), ",").alias("licenses"), rest.alias("unmatched"),
    )


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def oracle_sql() -> str:
    """The same in DuckDB."""
    normal = "lower(coalesce(text, ''))"
    for pattern, to in _NORMAL:
        normal = f"regexp_replace({normal}, {_quoted(pattern)}, {_quoted(to)}, 'g')"
    spdx = " ".join(f"WHEN {_quoted(k)} THEN {_quoted(v)}" for k, v in spdx_names().items())
    tokens = f"list_filter(regexp_split_to_array(regexp_replace(regexp_extract(s, {_quoted(SPDX_TAG)}, 1), {_quoted(_EXCEPTION)}, '', 'g'), '[() ]+'), lambda t: t NOT IN ('', 'or', 'and'))"
    of_tag = f"list_transform({tokens}, lambda t: CASE t {spdx} ELSE {_quoted(UNKNOWN_SPDX)} END)"
    cases = " ".join(f"WHEN regexp_matches(s, {_quoted(p)}) THEN {_quoted(i)}" for i, p in SENTENCES)
    cases += f" WHEN regexp_matches(s, {_quoted(LICENSE_LIKE)}) THEN {_quoted(UNKNOWN)}"
    steps, left = [], "'' || ',' || array_to_string(ids, ',,') || ','"
    licenses = []
    for k, (name, sequence) in enumerate(RULES):
        part = _quoted("," + ",,".join(sequence) + ",")
        licenses.append(f"CASE WHEN contains(l{k}, {part}) THEN {_quoted(name)} END")
        steps.append(f"s{k + 1} AS (SELECT *, replace(l{k}, {part}, '|') AS l{k + 1} FROM s{k})")
    kept = " , ".join(
        f"CASE WHEN {c[5:-4].split(' THEN ')[0].removeprefix('WHEN ')} AND NOT ({' OR '.join(x[5:-4].split(' THEN ')[0].removeprefix('WHEN ') for j, x in enumerate(licenses[:k]) if RULES[j][0] == RULES[k][0]) or 'false'}) THEN {_quoted(RULES[k][0])} END"
        for k, c in enumerate(licenses)
    )
    return f"""
WITH cut AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split(regexp_replace({normal}, {_quoted(_END[0])}, {_quoted(chr(92) + '1' + _END[1])}, 'g'), chr(10)),
    lambda s: regexp_matches(s, {_quoted(HINT)})) AS ss FROM documents),
each AS (SELECT r, unnest(ss) AS s0, unnest(range(len(ss))) AS i FROM cut),
parts AS (SELECT r, i, CASE WHEN contains(s0, 'spdx-license-identifier') THEN regexp_replace(s0, {_quoted(SPDX_TAG)}, ' ', 'g') ELSE s0 END AS s, s0 FROM each),
one AS (SELECT r, i, CASE {cases} END AS named, CASE WHEN contains(s0, 'spdx-license-identifier') THEN {of_tag.replace('extract(s,', 'extract(s0,')} ELSE [] END AS tagged FROM parts),
named AS (SELECT r, flatten(list(list_concat(tagged, list_filter([named], lambda x: x IS NOT NULL)) ORDER BY i)) AS ids FROM one GROUP BY r),
tagged0 AS (SELECT c.doc_id, coalesce(n.ids, []) AS ids FROM cut c LEFT JOIN named n USING (r)),
sx AS (SELECT doc_id, ids, {left} AS lx FROM tagged0),
s0 AS (SELECT doc_id, ids, regexp_extract_all(lx, {_quoted(_SPDX_PART)}, 1) AS tagged, regexp_replace(lx, {_quoted(_SPDX_PART)}, '|', 'g') AS l0 FROM sx),
{', '.join(steps)}
SELECT doc_id, coalesce(array_to_string(ids, ','), '') AS sentences, coalesce(array_to_string(list_concat(list_filter(tagged, lambda x, i: list_position(tagged, x) = i), list_filter([{kept}], lambda x: x IS NOT NULL AND NOT list_contains(tagged, x))), ','), '') AS licenses,
  coalesce(array_to_string(list_filter(regexp_split_to_array(l{len(RULES)}, '[,|]+'), lambda x: x <> ''), ','), '') AS unmatched FROM s{len(RULES)}
"""
