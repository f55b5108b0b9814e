"""Licence scans by sentence rules, with built-in functions only.

A text is cut into sentences and into lines, each unit with the character at which it starts.
Units are normalised (lower case, letters and digits only) and looked up: known sentences and titles of
licence texts, with any holder filled in and any list number before them; notices of the form "licensed
under <name> or <name>", anywhere in a unit, with more words after them; and SPDX expressions, whose
operators, exceptions and "or later" leave the licences named. What is known
gives the text's sequence of identifiers, in order of place. A rule is a licence and the
identifiers that must occur in this order; of rules that match, one that is part of another one
that also matches is dropped (two clauses are part of three).

Null and empty texts have no licence. Rows are handled one by one: no shuffle, no group, nothing
that a hot source or repeated rows could upset. Only the id and text columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Licence -> the names under which notices cite it, normalised.
NAMES = {
    "MIT": ("mit license", "mit", "mit licence", "expat license", "mit expat license"),
    "Apache-2.0": ("apache license version 2 0", "apache license 2 0", "apache 2 0", "apache 2 0 license", "apache 2 license", "asl 2 0"),
    "GPL-2.0": ("gnu general public license version 2", "gnu gpl version 2", "gpl version 2", "gpl v2", "gplv2", "gpl 2 0", "gpl 2", "gnu gpl v2", "gpl 2 0 only"),
    "GPL-3.0": ("gnu general public license version 3", "gnu gpl version 3", "gpl version 3", "gpl v3", "gplv3", "gpl 3 0", "gpl 3", "gnu gpl v3", "gpl 3 0 only"),
    "LGPL-2.1": ("gnu lesser general public license version 2 1", "gnu lgpl version 2 1", "lgpl v2 1", "lgpl 2 1", "lgpl 2 1 only"),
    "LGPL-3.0": ("gnu lesser general public license version 3", "gnu lgpl version 3", "lgpl v3", "lgpl 3 0", "lgpl 3 0 only"),
    "AGPL-3.0": ("gnu affero general public license version 3", "gnu agpl version 3", "agpl v3", "agplv3", "agpl 3 0", "agpl 3 0 only"),
    "MPL-2.0": ("mozilla public license version 2 0", "mozilla public license v 2 0", "mozilla public license 2 0", "mpl 2 0"),
    "BSD-2-Clause": ("bsd 2 clause license", "2 clause bsd license", "bsd 2 clause", "simplified bsd license"),
    "BSD-3-Clause": ("bsd 3 clause license", "3 clause bsd license", "bsd 3 clause", "new bsd license", "modified bsd license"),
    "ISC": ("isc license", "isc"),
    "Unlicense": ("unlicense", "the unlicense"),
    "CC0-1.0": ("cc0 1 0", "cc0", "creative commons zero v1 0 universal"),
    "CC-BY-4.0": ("cc by 4 0", "creative commons attribution 4 0 international license"),
    "CC-BY-3.0": ("cc by 3 0",),
    "CC-BY-SA-4.0": ("cc by sa 4 0", "creative commons attribution sharealike 4 0 international license"),
    "CC-BY-SA-3.0": ("cc by sa 3 0",),
    "CC-BY-NC-4.0": ("cc by nc 4 0", "creative commons attribution noncommercial 4 0 international license"),
    "CC-BY-NC-3.0": ("cc by nc 3 0",),
    "CC-BY-ND-4.0": ("cc by nd 4 0",),
    "CC-BY-NC-SA-4.0": ("cc by nc sa 4 0",),
    "CC-BY-NC-ND-4.0": ("cc by nc nd 4 0",),
    "EPL-2.0": ("eclipse public license version 2 0", "eclipse public license 2 0", "epl 2 0"),
    "BSL-1.0": ("boost software license version 1 0", "boost software license 1 0", "bsl 1 0"),
    "Zlib": ("zlib license", "zlib"),
}

# GNU licence -> version, and the names that may stand before it.
GNU = {
    "GPL-2.0": ("2", ("gnu general public license", "gnu gpl", "gpl")), "GPL-3.0": ("3", ("gnu general public license", "gnu gpl", "gpl")),
    "LGPL-2.1": ("2 1", ("gnu lesser general public license", "gnu lgpl", "lgpl")),
    "LGPL-3.0": ("3", ("gnu lesser general public license", "gnu lgpl", "lgpl")),
    "AGPL-3.0": ("3", ("gnu affero general public license", "gnu agpl", "agpl")),
}
# Further names.
MORE_NAMES = {
    "MIT": ("mit x11 license", "x11 mit license"),
    "Apache-2.0": ("apache software license version 2 0", "apache license v2 0", "apache license version 2", "apache license 2", "apache v2 license", "apache 2"),
    "MPL-2.0": ("mozilla public license v2 0", "mozilla public license version 2"),
    "BSD-2-Clause": ("bsd 2 clause simplified license", "freebsd license"),
    "BSD-3-Clause": ("bsd 3 clause new or revised license", "revised bsd license"),
    "BSL-1.0": ("boost software license v1 0",),
    "EPL-2.0": ("eclipse public license v2 0", "eclipse public license v 2 0"),
}


def _names() -> dict[str, str]:
    """Normalised name -> licence."""
    known = {alias: name for table in (NAMES, MORE_NAMES) for name, aliases in table.items() for alias in aliases}
    for name, (version, titles) in GNU.items():
        full = version if " " in version else f"{version} 0"
        known |= {f"{title} {v}": name for title in titles for n in {version, full} for v in (f"version {n}", f"v{n}", f"v {n}", n)}
    return known


def _spdx() -> dict[str, str]:
    """Identifier in small letters -> licence; a licence of this version or any later one counts as this version."""
    return {name.lower() + end: name for name in NAMES for end in ("", "-only", "-or-later", "+")}


# Sentences of licence texts, normalised -> identifier.
SENTENCES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit-warranty",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-names",
    "you may not use this file except in compliance with the license": "apache-file",
    "you may obtain a copy of the license at": "apache-copy",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2-grant",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3-grant",
    # The cut ends a unit at "free software;", the GPL-2.0 notice also at "Foundation;", and MPL-2.0 at "v.".
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2-grant",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3-grant",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl-terms",
    "either version 2 of the license or at your option any later version": "version2-or-later",
    "either version 3 of the license or at your option any later version": "version3-or-later",
    "you should have received a copy of the gnu general public license along with this program": "gpl-copy",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-subject",
    # What follows "v." is a unit of its own; of all versions only 2.0 speaks of a Source Code Form.
    "this source code form is subject to the terms of the mozilla public license v": "mpl-subject",
    "this is free and unencumbered software released into the public domain": "unlicense-grant",
    "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work": "cc0-waiver",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "the origin of this software must not be misrepresented": "zlib-origin",
    "altered source versions must be plainly marked as such and must not be misrepresented as being the original software": "zlib-altered",
    "this notice may not be removed or altered from any source distribution": "zlib-notice",
}

# Titles of whole licence texts, normalised; more words may follow -> identifier.
TITLES = {
    "apache license version 2 0 january 2004": "apache-title",
    "gnu general public license version 2 june 1991": "gpl2-title",
    "gnu general public license version 3 29 june 2007": "gpl3-title",
    "gnu lesser general public license version 2 1 february 1999": "lgpl21-title",
    "gnu lesser general public license version 3 29 june 2007": "lgpl3-title",
    "gnu affero general public license version 3 19 november 2007": "agpl3-title",
    "mozilla public license version 2 0 1 definitions": "mpl-title",
    "eclipse public license v 2 0 the accompanying program": "epl-title",
    "boost software license version 1 0 august 17th 2003": "boost-title",
    "creative commons legal code cc0 1 0 universal": "cc0-title",
    "creative commons attribution 4 0 international public license": "ccby4-title",
    "creative commons attribution sharealike 4 0 international public license": "ccbysa4-title",
    "creative commons attribution noncommercial 4 0 international public license": "ccbync4-title",
}
# Titles that are a unit of their own, normalised -> identifier.
ALONE = {"mozilla public license version 2 0": "mpl-title", "eclipse public license v 2 0": "epl-title", "cc0 1 0 universal": "cc0-title"}

# Between two identifiers of a rule: no other known unit may lie between them. (LGPL notices name their version in the same words.)
NEXT = r"\| \|"
# Licence, identifiers in the order in which they must occur.
TEXT_RULES = [
    ("MIT", ("mit-grant", "mit-notice")),
    ("ISC", ("isc-grant",)),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("Apache-2.0", ("apache-file", "apache-copy")),
    ("GPL-2.0", ("gpl2-grant",)),
    ("GPL-2.0", (f"gpl-terms{NEXT}version2-or-later",)),
    ("GPL-3.0", ("gpl3-grant",)),
    ("GPL-3.0", (f"gpl-terms{NEXT}version3-or-later",)),
    ("MPL-2.0", ("mpl-subject",)),
    ("Unlicense", ("unlicense-grant",)),
    ("CC0-1.0", ("cc0-waiver",)),
]
# The same for whole texts, most of them by their title.
WHOLE_RULES = [
    ("Zlib", ("zlib-origin", "zlib-altered", "zlib-notice")),
    ("Apache-2.0", ("apache-title",)),
    ("GPL-2.0", ("gpl2-title",)),
    ("GPL-3.0", ("gpl3-title",)),
    ("LGPL-2.1", ("lgpl21-title",)),
    ("LGPL-3.0", ("lgpl3-title",)),
    ("AGPL-3.0", ("agpl3-title",)),
    ("MPL-2.0", ("mpl-title",)),
    ("EPL-2.0", ("epl-title",)),
    ("BSL-1.0", ("boost-title",)),
    ("CC0-1.0", ("cc0-title",)),
    ("CC-BY-4.0", ("ccby4-title",)),
    ("CC-BY-SA-4.0", ("ccbysa4-title",)),
    ("CC-BY-NC-4.0", ("ccbync4-title",)),
]

# Every known unit holds one of these, so a text without any of them needs no closer look.
ANCHORS = "licen[cs]ed|released|distributed|published|available|spdx|permission|redistribut|copyright|license|unencumbered|waived|noninfringement|under (?:the )?(?:gnu|l?gpl|agpl|mit|mpl|isc|cc|bsd|apache)|misrepresented|removed or altered|cc0 1|nor the names|eclipse public|mozilla public"
# Characters that end a sentence when white space follows; an empty line ends one as well.
SENTENCE_END = r"([.!?;:])(\s)"
CUT = "\x01"
_NAME = "|".join(sorted(_names(), key=lambda n: (-len(n), n)))
# Words that may follow a licence's name in a notice; a version or a qualifier would make it another licence.
AFTER = (
    "see|which|as|and|or|with|without|the|a|for|by|in|at|you|terms|copyright|c|copy|found|full|please|unless|except|that|this|to|can|available|on|if|"
    "refer|read|details|included|only|exclusively|instead|unlicensed|file|agreement|http|https|of|is|are|it|any|your|except"
)
# "licensed under the <name>, or <name>", in normalised form.
_NOTICE = (
    r"(?:licen[cs]ed|relicensed|released|distributed|redistributed|published|available|provided|offered|covered|shared|open sourced|"
    r"dual licen[cs]ed|is|are|project|software|code|work|package|library|file|program|or|contributed) "
    r"under (?:(?:the |both |either |of |any |terms |and |conditions ){0,6})"
    rf"((?:{_NAME})(?: only)?(?:(?: licen[cs]es?)?(?: and or| or| and)?(?: the)? (?:{_NAME})(?: only)?)*)(?: licen[cs]es?)?(?: or later)?(?:$| (?:{AFTER})\b)"
)
# Anywhere in a sentence; in a line only where it begins, as the sentence has the rest.
NOTICE = {
    "sentence": rf"\b{_NOTICE}",
    "line": rf"^(?:this (?:work|project|software|program|file|document|package|code|text|content|library) is |it is |all content is )?(?:dual )?{_NOTICE}",
}
NAMED = rf"\b({_NAME})\b"
# Licences joined by operators, each perhaps with an exception, in small letters.
_ID = r"\(*[a-z0-9.+-]+(?:[ \t]+with[ \t]+[a-z0-9.+-]+)?\)*"
SPDX = rf"spdx[ -]licen[cs]e[ -]identifier[ \t]*:?[ \t]*({_ID}(?:[ \t]+(?:or|and)[ \t]+{_ID})*)"
SPDX_CUT = r"\.*[^a-z0-9.+-]+|\.+$"
# What may stand before a sentence: the number of a list, or the word that opens a comment.
MARK = r"^(?:[0-9]{1,2}|[a-d]|i{1,3}|rem|dnl) "
TITLE = rf"^({'|'.join(TITLES)})(?: .*)?$"
# The holder stands between "of" and "nor"; a full stop in it ends a unit there.
BSD_NAMES = (
    r"^(?:neither the names? of .+ |the names? of .+ |.* )?(?:nor|and) the names? of (?:its |their |any |the |other |his )*contributors? "
    r"(?:may|may not) be used to endorse or promote products derived from this software without (?:specific )?prior written permission$"
    r"|^(?:the names? of .+|neither the names? of .+) (?:may|may not) be used to endorse or promote products derived from this software without (?:specific )?prior written permission$"
)

RULES = [(name, (f"notice:{name}",)) for name in NAMES] + TEXT_RULES + WHOLE_RULES


def normalised(unit: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(unit), r"[^a-z0-9]+", " "))


def _looked_up(table: dict[str, str], key: Column) -> Column:
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), key)


def identifiers(raw: Column, unit: Column, kind: str) -> Column:
    """What is known of a unit (a sentence or a line), as it stands and normalised: an array, mostly empty."""
    notice = {alias: f"notice:{name}" for alias, name in _names().items()}
    spdx = {alias: f"notice:{name}" for alias, name in _spdx().items()}
    bare = F.regexp_replace(unit, MARK, "")
    whole = F.coalesce(
        _looked_up(SENTENCES | ALONE, bare), _looked_up(TITLES, F.regexp_extract(unit, TITLE, 1)), F.when(bare.rlike(BSD_NAMES), F.lit("bsd-names"))
    )
    none = F.array().cast("array<string>")
    cited = F.regexp_extract_all(F.regexp_extract(unit, NOTICE[kind], 1), F.lit(NAMED), 1)
    named = F.when(F.contains(unit, F.lit("under ")), F.transform(cited, lambda x: _looked_up(notice, x))).otherwise(none)
    tokens = F.split(F.regexp_extract(F.lower(raw), SPDX, 1), SPDX_CUT)
    tagged = F.when(F.contains(unit, F.lit("spdx")), F.transform(tokens, lambda x: _looked_up(spdx, x))).otherwise(none)
    return F.filter(F.concat(F.array(whole), named, tagged), lambda x: x.isNotNull())


def _found(units: Column, kind: str) -> Column:
    """(place, id) of the known units of a text; units lie one after the other, each with the character that ended it."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<at:bigint,id:string>>").alias("found"))

    def step(done: Column, unit: Column) -> Column:
        known = F.transform(identifiers(unit, normalised(unit), kind), lambda x: F.struct(done["at"].alias("at"), x.alias("id")))
        found = F.when(F.length(unit) > 2, F.concat(done["found"], known)).otherwise(done["found"])
        return F.struct((done["at"] + F.length(unit) + 1).alias("at"), found.alias("found"))

    return F.aggregate(units, start, step, lambda done: done["found"])


def sequence(text: Column) -> Column:
    """Distinct (place, id) of a text's known units, in order of place, by sentences and by lines."""
    paragraphs = F.replace(text, F.lit("\n\n"), F.lit("\n" + CUT))
    sentences = F.split(F.regexp_replace(paragraphs, SENTENCE_END, "$1" + CUT), CUT)
    lines = F.split(text, "\n")
    return F.sort_array(F.array_distinct(F.concat(_found(sentences, "sentence"), _found(lines, "line"))))


def matched(ids: Column) -> Column:
    """Licences whose rules the sequence of identifiers (joined, each with a bar before and after) meets."""
    hit = {rule: ids.rlike(".*".join(f"\\|{i}\\|" for i in rule[1])) for rule in RULES}
    chosen = []
    for name, needs in RULES:
        wider = [hit[r] for r in RULES if len(r[1]) > len(needs) and set(needs) < set(r[1])]
        condition = hit[(name, needs)]
        for other in wider:
            condition = condition & ~other
        chosen.append(F.when(condition, F.lit(name)))
    return F.array_sort(F.array_distinct(F.filter(F.array(*chosen), lambda x: x.isNotNull())))


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, found: array of (at, id), licenses: sorted array) of each whole text."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    empty = F.array().cast("array<struct<at:bigint,id:string>>")
    looked = docs.select(
        F.col(id_column), F.when(text.rlike(f"(?i){ANCHORS}"), sequence(text)).otherwise(empty).alias("found")
    )
    # A bar on both sides of every identifier: neighbours do not share one.
    joined = F.array_join(F.transform("found", lambda x: F.concat(F.lit("|"), x["id"], F.lit("|"))), " ")
    licenses = F.when(F.size("found") > 0, matched(joined)).otherwise(F.array().cast("array<string>"))
    return looked.withColumn("licenses", licenses)


def license_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_found, licenses joined by blanks, for every document."""
    return scan(docs).select("doc_id", F.size("found").cast("long").alias("n_found"), F.array_join("licenses", " ").alias("licenses"))


def oracle_sql() -> str:
    """The same report in DuckDB SQL."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    values = lambda table, mark="": ", ".join(f"({quoted(k)}, {quoted(mark + v)})" for k, v in table.items())
    hits = []
    for name, needs in RULES:
        test = lambda r: "regexp_matches(joined, " + quoted(".*".join(f"\\|{i}\\|" for i in r)) + ")"
        wider = "".join(f" AND NOT {test(r[1])}" for r in RULES if len(r[1]) > len(needs) and set(needs) < set(r[1]))
        hits.append(f"CASE WHEN {test(needs)}{wider} THEN {quoted(name)} END")
    return f"""
WITH known_sentence(unit, id) AS (VALUES {values(SENTENCES | ALONE)}),
known_title(unit, id) AS (VALUES {values(TITLES)}),
known_name(alias, id) AS (VALUES {values(_names(), "notice:")}),
known_spdx(alias, id) AS (VALUES {values(_spdx(), "notice:")}),
doc AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
looked AS (SELECT row, text FROM doc WHERE regexp_matches(text, '(?i){ANCHORS}')),
cut AS (
  SELECT row, 0 AS kind, string_split(regexp_replace(replace(text, chr(10) || chr(10), chr(10) || chr(1)), '{SENTENCE_END}', '\\1' || chr(1), 'g'), chr(1)) AS units FROM looked
  UNION ALL SELECT row, 1, string_split(text, chr(10)) FROM looked),
unit AS (SELECT row, kind, unnest(units) AS unit, generate_subscripts(units, 1) AS i FROM cut),
placed AS (
  SELECT row, kind, lower(unit) AS raw, trim(regexp_replace(lower(unit), '[^a-z0-9]+', ' ', 'g')) AS unit, length(unit) AS n,
    sum(length(unit) + 1) OVER (PARTITION BY row, kind ORDER BY i) - length(unit) - 1 AS pos FROM unit),
cited AS (SELECT row, kind, pos, raw, unit, regexp_replace(unit, '{MARK}', '') AS bare FROM placed WHERE n > 2),
found AS (
  SELECT row, pos, id FROM cited JOIN known_sentence s ON bare = s.unit
  UNION SELECT row, pos, id FROM cited JOIN known_title t ON regexp_extract(cited.unit, '{TITLE}', 1) = t.unit
  UNION SELECT row, pos, 'bsd-names' FROM cited WHERE regexp_matches(bare, '{BSD_NAMES}')
  UNION SELECT row, pos, id FROM (
    SELECT row, pos, unnest(regexp_extract_all(regexp_extract(unit, '{NOTICE["sentence"]}', 1), '{NAMED}', 1)) AS alias
    FROM cited WHERE kind = 0 AND contains(unit, 'under ')
    UNION ALL SELECT row, pos, unnest(regexp_extract_all(regexp_extract(unit, '{NOTICE["line"]}', 1), '{NAMED}', 1))
    FROM cited WHERE kind = 1 AND contains(unit, 'under ')
  ) JOIN known_name USING (alias)
  UNION SELECT row, pos, id FROM (
    SELECT row, pos, unnest(string_split_regex(regexp_extract(raw, '{SPDX}', 1), '{SPDX_CUT}')) AS alias FROM cited WHERE contains(unit, 'spdx')
  ) JOIN known_spdx USING (alias)),
joined AS (SELECT row, count(*) AS n_found, string_agg('|' || id || '|', ' ' ORDER BY pos, id) AS joined FROM found GROUP BY row),
hit AS (SELECT row, n_found, unnest([{", ".join(hits)}]) AS name FROM joined)
SELECT d.doc_id, coalesce(any_value(h.n_found), 0) AS n_found, coalesce(string_agg(DISTINCT h.name, ' ' ORDER BY h.name), '') AS licenses
FROM doc d LEFT JOIN hit h USING (row) GROUP BY d.row, d.doc_id
"""
