"""Licence scan by sentence rules.

Texts are cut into normalised sentences; each sentence that belongs to a known licence text is
mapped to its identifier; a licence is recognised where a document's identifiers contain the
ordered identifiers of one of its rules.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

#: Sentences of public licence texts and notices, normalised as ``normalise`` does.
SENTENCES = {
    "apache2.notice": "licensed under the apache license version 2 0",
    "apache2.the": "licensed under the apache license version 2 0 the license",
    "apache2.comply": "you may not use this file except in compliance with the license",
    "apache2.copy": "you may obtain a copy of the license at",
    "apache2.asis": "unless required by applicable law or agreed to in writing software distributed "
                    "under the license is distributed on an as is basis without warranties or "
                    "conditions of any kind either express or implied",
    "apache2.see": "see the license for the specific language governing permissions and "
                   "limitations under the license",
    "mit.notice": "released under the mit license",
    "mit.licensed": "licensed under the mit license",
    "mit.title": "the mit license",
    "mit.grant": "permission is hereby granted free of charge to any person obtaining a copy of "
                 "this software and associated documentation files the software to deal in the "
                 "software without restriction including without limitation the rights to use "
                 "copy modify merge publish distribute sublicense and or sell copies of the "
                 "software and to permit persons to whom the software is furnished to do so "
                 "subject to the following conditions",
    "mit.keep": "the above copyright notice and this permission notice shall be included in all "
                "copies or substantial portions of the software",
    "gpl3.notice": "this work is licensed under the gnu general public license version 3",
    "gpl.free": "this program is free software you can redistribute it and or modify it under the "
                "terms of the gnu general public license as published by the free software "
                "foundation either version 3 of the license or at your option any later version",
    "gpl2.free": "this program is free software you can redistribute it and or modify it under the "
                 "terms of the gnu general public license as published by the free software "
                 "foundation either version 2 of the license or at your option any later version",
    "gpl.hope": "this program is distributed in the hope that it will be useful but without any "
                "warranty without even the implied warranty of merchantability or fitness for a "
                "particular purpose",
    # the official notices as the splitter cuts them: "free software; you can" (GPL-2) or
    # "free software: you can" (GPL-3), "WARRANTY; without"
    "gpl3.terms": "you can redistribute it and or modify it under the terms of the gnu general public "
                  "license as published by the free software foundation either version 3 of the "
                  "license or at your option any later version",
    "gpl2.terms": "you can redistribute it and or modify it under the terms of the gnu general public "
                  "license as published by the free software foundation either version 2 of the "
                  "license or at your option any later version",
    # GPL-2 has "Foundation; either" too
    "gpl.terms": "you can redistribute it and or modify it under the terms of the gnu general public "
                 "license as published by the free software foundation",
    "gpl2.either": "either version 2 of the license or at your option any later version",
    "gpl3.either": "either version 3 of the license or at your option any later version",
    "gpl.useful": "this program is distributed in the hope that it will be useful but without any warranty",
    "gpl.implied": "without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl.details": "see the gnu general public license for more details",
    "bsd.redistribute": "redistribution and use in source and binary forms with or without "
                        "modification are permitted provided that the following conditions are met",
    "bsd.source": "redistributions of source code must retain the above copyright notice this "
                  "list of conditions and the following disclaimer",
    "bsd.binary": "redistributions in binary form must reproduce the above copyright notice this "
                  "list of conditions and the following disclaimer in the documentation and or "
                  "other materials provided with the distribution",
    "bsd.advertising": "all advertising materials mentioning features or use of this software must "
                       "display the following acknowledgement",
    "isc.grant": "permission to use copy modify and or distribute this software for any purpose "
                 "with or without fee is hereby granted provided that the above copyright notice "
                 "and this permission notice appear in all copies",
    "mpl2.subject": "this source code form is subject to the terms of the mozilla public license v 2 0",
    # cut after "v."; only version 2.0 speaks of a "Source Code Form"
    "mpl2.form": "this source code form is subject to the terms of the mozilla public license v",
    "ccbync4.notice": "licensed under cc by nc 4 0",
    "ccby4.notice": "licensed under cc by 4 0",
    "ccbysa4.notice": "licensed under cc by sa 4 0",
    "cc0.notice": "licensed under cc0 1 0",
    "unlicense.free": "this is free and unencumbered software released into the public domain",
    "ccbync4.work": "this work is licensed under cc by nc 4 0",
    "ccby4.work": "this work is licensed under cc by 4 0",
    "ccbysa4.work": "this work is licensed under cc by sa 4 0",
    "reserved": "all rights reserved",
    "lgpl.terms": "you can redistribute it and or modify it under the terms of the gnu lesser general public "
                  "license as published by the free software foundation",
    "lgpl21.either": "either version 2 1 of the license or at your option any later version",
    "lgpl3.terms": "you can redistribute it and or modify it under the terms of the gnu lesser general public "
                   "license as published by the free software foundation either version 3 of the license "
                   "or at your option any later version",
    "lgpl.details": "see the gnu lesser general public license for more details",
    "agpl3.terms": "you can redistribute it and or modify it under the terms of the gnu affero general public "
                   "license as published by the free software foundation either version 3 of the license "
                   "or at your option any later version",
    "agpl.details": "see the gnu affero general public license for more details",
    "zlib.asis": "this software is provided as is without any express or implied warranty",
    "zlib.grant": "permission is granted to anyone to use this software for any purpose including commercial "
                  "applications and to alter it and redistribute it freely subject to the following restrictions",
    "bsl.notice": "distributed under the boost software license version 1 0",
    "epl2.terms": "this program and the accompanying materials are made available under the terms of the eclipse "
                  "public license 2 0 which is available at https www eclipse org legal epl 2 0",
    # cut after "v."
    "epl.v": "this program and the accompanying materials are made available under the terms of the eclipse public license v",
    "epl2.which": "2 0 which is available at https www eclipse org legal epl 2 0",
}

#: Licences known by their tag "SPDX-License-Identifier: <id>".
SPDX = ["0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC0-1.0", "CC-BY-4.0",
        "CC-BY-NC-4.0", "CC-BY-SA-4.0", "EPL-2.0", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only",
        "GPL-3.0-or-later", "ISC", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MPL-2.0",
        "Unlicense", "Zlib"]
SENTENCES |= {f"spdx.{x.lower()}": "spdx license identifier " + re.sub("[^a-z0-9]+", " ", x.lower()) for x in SPDX}

#: Sentences known by their end, as they name an organisation: end -> identifier.
ENDINGS = {"to endorse or promote products derived from this software without specific prior written permission": "bsd.endorse"}

#: Rule -> (licence, ordered sentence identifiers; others may stand between them).
RULES = {
    "apache2-notice": ("Apache-2.0", ["apache2.notice"]),
    "apache2-header": ("Apache-2.0", ["apache2.the", "apache2.comply", "apache2.copy", "apache2.asis", "apache2.see"]),
    "mit-notice": ("MIT", ["mit.notice"]),
    "mit-licensed": ("MIT", ["mit.licensed"]),
    "mit-text": ("MIT", ["mit.grant", "mit.keep"]),
    "gpl3-notice": ("GPL-3.0", ["gpl3.notice"]),
    "gpl3-header": ("GPL-3.0-or-later", ["gpl.free", "gpl.hope", "gpl.details"]),
    "gpl2-header": ("GPL-2.0-or-later", ["gpl2.free", "gpl.hope", "gpl.details"]),
    "gpl3-header-cut": ("GPL-3.0-or-later", ["gpl3.terms", "gpl.useful", "gpl.implied", "gpl.details"]),
    "gpl2-header-cut": ("GPL-2.0-or-later", ["gpl2.terms", "gpl.useful", "gpl.implied", "gpl.details"]),
    "gpl3-header-either": ("GPL-3.0-or-later", ["gpl.terms", "gpl3.either", "gpl.useful", "gpl.implied", "gpl.details"]),
    "gpl2-header-either": ("GPL-2.0-or-later", ["gpl.terms", "gpl2.either", "gpl.useful", "gpl.implied", "gpl.details"]),
    "bsd2-text": ("BSD-2-Clause", ["bsd.redistribute", "bsd.source", "bsd.binary"]),
    "bsd3-text": ("BSD-3-Clause", ["bsd.redistribute", "bsd.source", "bsd.binary", "bsd.endorse"]),
    "bsd4-text": ("BSD-4-Clause", ["bsd.redistribute", "bsd.source", "bsd.binary", "bsd.advertising", "bsd.endorse"]),
    "isc-text": ("ISC", ["isc.grant"]),
    "mpl2-notice": ("MPL-2.0", ["mpl2.subject"]),
    "mpl2-header": ("MPL-2.0", ["mpl2.form"]),
    "cc-by-nc-4-notice": ("CC-BY-NC-4.0", ["ccbync4.notice"]),
    "cc-by-nc-4-work": ("CC-BY-NC-4.0", ["ccbync4.work"]),
    "cc-by-4-notice": ("CC-BY-4.0", ["ccby4.notice"]),
    "cc-by-4-work": ("CC-BY-4.0", ["ccby4.work"]),
    "cc-by-sa-4-notice": ("CC-BY-SA-4.0", ["ccbysa4.notice"]),
    "cc-by-sa-4-work": ("CC-BY-SA-4.0", ["ccbysa4.work"]),
    "cc0-notice": ("CC0-1.0", ["cc0.notice"]),
    "unlicense-text": ("Unlicense", ["unlicense.free"]),
    "all-rights-reserved": ("LicenseRef-all-rights-reserved", ["reserved"]),
    "mit-title": ("MIT", ["mit.title"]),
    "lgpl21-header": ("LGPL-2.1-or-later", ["lgpl.terms", "lgpl21.either", "lgpl.details"]),
    "lgpl3-header": ("LGPL-3.0-or-later", ["lgpl3.terms", "lgpl.details"]),
    "lgpl3-header-either": ("LGPL-3.0-or-later", ["lgpl.terms", "gpl3.either", "lgpl.details"]),
    "agpl3-header": ("AGPL-3.0-or-later", ["agpl3.terms", "agpl.details"]),
    "zlib-text": ("Zlib", ["zlib.asis", "zlib.grant"]),
    "bsl-notice": ("BSL-1.0", ["bsl.notice"]),
    "epl2-notice": ("EPL-2.0", ["epl2.terms"]),
    "epl2-notice-v": ("EPL-2.0", ["epl.v", "epl2.which"]),
}
RULES |= {f"spdx-{x.lower()}": (x, [f"spdx.{x.lower()}"]) for x in SPDX}

#: A match that gives way where another rule matches from the same sentence on, as the other's text
#: holds its own: rule -> others (with the same first sentence).
GIVES_WAY = {"bsd2-text": ["bsd3-text", "bsd4-text"], "bsd3-text": ["bsd4-text"]}

#: A sentence ends at . ! ? ; or : before blank space or the end, or at a line without a letter or
#: digit (blank, or a comment sign alone).
SENTENCE_END = r"[.!?;:]+(?:\s+|$)|\n[^A-Za-z0-9\n]*\n"
NOT_WORD = r"[^a-z0-9]+"
#: A tag is a sentence of its own.
TAG, TAG_SENTENCE = r"(?i)spdx-license-identifier:[ \t]*([A-Za-z0-9.+-]+)", "\nspdx-license-identifier {}. \n"
#: A text without any of these words matches no rule (fixed values; every rule has a sentence with one).
SIGNAL = "(?i)licen[cs]|reserved|permission|redistribut|unencumbered"


def normalise(sentence: Column) -> Column:
    """Lower case A-Z; runs of anything but a-z and 0-9 become one blank; blanks trimmed."""
    low = F.translate(sentence, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.trim(F.regexp_replace(low, NOT_WORD, " "))


def licence_sentences(docs: DataFrame, text: str, hits: str, known: dict[str, str] = SENTENCES) -> DataFrame:
    """``docs`` with ``hits``: array of (pos, id) of the known sentences, in order.

    Comment signs need no rule of their own: normalising drops them wherever they stand, and a line
    that holds nothing else ends a sentence as a blank line does. A sentence may be wrapped over lines.
    Where a part of several lines is not known as a whole, it is looked at line by line: the longest run
    of lines from each line on that is a known sentence counts, so a notice is found under or above a
    line that ends without a stop. ``pos`` counts parts, and lines of such parts.
    """
    shortest, longest = min(map(len, known.values())), max(map(len, known.values()))
    lines_of = max(len(v.split()) for v in known.values())  # a run of more lines is longer than any sentence
    ids = F.create_map(*[F.lit(x) for k, v in known.items() for x in (v, k)])

    def identify(n):
        """The identifier of a normalised sentence."""
        ends = [F.when(F.endswith(n, F.lit(end)), k) for end, k in ENDINGS.items()]
        return F.when(F.length(n) >= shortest, F.coalesce(F.try_element_at(ids, n), *ends))

    # each step is a transform of its own: what a lambda is given is computed once per element
    def of_part(p):
        known_whole = identify(p["words"])
        several = F.contains(p["part"], F.lit("\n")) & known_whole.isNull()
        lines = F.filter(F.transform(F.split(p["part"], "\n"), normalise), lambda x: x != "")
        return F.struct(known_whole.alias("id"), F.when(several, lines).alias("lines"))

    def of_lines(p):
        def from_line(line, i):
            runs = F.transform(F.sequence(F.lit(1), F.least(F.size(p["lines"]) - i, F.lit(lines_of))),
                               lambda n: F.array_join(F.slice(p["lines"], i + 1, n), " "))
            named = F.filter(F.transform(runs, lambda r: F.when(F.length(r).between(shortest, longest), F.try_element_at(ids, r))), lambda x: x.isNotNull())
            # an ending is looked for on single lines only: a longer run would take in what stands before
            ends = [F.when(F.endswith(line, F.lit(end)), k) for end, k in ENDINGS.items()]
            return F.coalesce(F.try_element_at(named, F.lit(-1)), *ends)
        return F.when(p["lines"].isNull(), F.array(p["id"])).otherwise(F.transform(p["lines"], from_line))

    tagged = F.regexp_replace(F.col(text), TAG, TAG_SENTENCE.format("$1"))
    parts = F.transform(F.split(tagged, SENTENCE_END), lambda p: F.struct(p.alias("part"), normalise(p).alias("words")))
    own = fresh(docs, "parts")
    parted = (docs.withColumn(own, F.when(F.rlike(F.col(text), F.lit(SIGNAL)), F.transform(parts, of_part)))
              .where(F.col(own).isNotNull()))
    units = F.flatten(F.transform(own, of_lines))
    found = F.transform(units, lambda x, i: F.struct(i.cast("long").alias("pos"), x.alias("id")))
    return parted.withColumn(hits, F.filter(found, lambda h: h["id"].isNotNull())).drop(own)


def scan(docs: DataFrame, text: str = "text", known: dict[str, str] = SENTENCES,
         rules: dict[str, tuple[str, list[str]]] = RULES) -> DataFrame:
    """One row per document and matched rule: the columns of ``docs`` without ``text``, then
    ``licence``, ``rule``, ``first_sentence`` (0-based position of the sentence where the rule's first
    match begins) and ``sentence_ids`` (all identifiers in order).

    A rule matches from a place of its first identifier on if its others follow in this order before the
    first stands again, with any sentences between them, and no rule that it gives way to matches from
    that place. Null or empty text: no row. Repeated rows give repeated results. Columns of ``docs`` with
    the names of results are replaced. Nothing is shuffled.
    """
    out = ["licence", "rule", "first_sentence", "sentence_ids"]
    keep = [c for c in docs.columns if c != text and c not in out]
    docs = docs.select(*keep, text)
    hits, joined, match = fresh(docs, "hits"), fresh(docs, "joined"), fresh(docs, "match")
    rows = licence_sentences(docs, text, hits, known).where(F.size(hits) > 0).select(*keep, hits)
    rows = rows.withColumn(joined, F.concat(F.lit("|"), F.array_join(F.col(f"{hits}.id"), "||"), F.lit("|")))

    def like(piece, ids):
        return piece.like("%" + "%".join(f"|{i}|" for i in ids[1:]) + "%") if len(ids) > 1 else F.lit(True)

    def found(name, licence, ids):
        starts = F.filter(F.col(hits), lambda h: h["id"] == ids[0])
        pieces = F.split(F.col(joined), re.escape(f"|{ids[0]}|"))  # what follows each start, up to the next
        others = [rules[o][1] for o in GIVES_WAY.get(name, []) if o in rules]
        good = F.transform(F.slice(pieces, 2, F.size(pieces)), lambda p: reduce(lambda a, o: a & ~like(p, o), others, like(p, ids)))
        at = F.array_position(good, True).cast("int")
        row = F.struct(F.lit(licence).alias("licence"), F.lit(name).alias("rule"), F.get(starts, at - 1)["pos"].alias("first_sentence"))
        return F.when(F.contains(F.col(joined), F.lit(f"|{ids[0]}|")), F.when(at > 0, row))

    every = F.array_compact(F.array(*[found(name, licence, ids) for name, (licence, ids) in rules.items()]))
    rows = rows.withColumn(match, F.explode(every))
    return rows.select(*keep, F.col(f"{match}.licence").alias("licence"), F.col(f"{match}.rule").alias("rule"),
                       F.col(f"{match}.first_sentence").alias("first_sentence"),
                       F.array_join(F.col(f"{hits}.id"), " ").alias("sentence_ids"))


def oracle(table: str = "documents") -> str:
    """The same in DuckDB SQL."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({quote(v)}, {quote(k)})" for k, v in SENTENCES.items())
    endings = ", ".join(f"({quote(e)}, {quote(k)})" for e, k in ENDINGS.items())
    pattern = lambda ids: quote("%" + "%".join(f"|{i}|" for i in ids[1:]) + "%")
    rows = ", ".join(
        f"({quote(name)}, {quote(lic)}, {quote(ids[0])}, {pattern(ids)}, "
        f"CAST([{', '.join(pattern(RULES[o][1]) for o in GIVES_WAY.get(name, []))}] AS VARCHAR[]))" for name, (lic, ids) in RULES.items())
    words = r"trim(regexp_replace(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g'))"
    reach = max(len(v.split()) for v in SENTENCES.values())
    return rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, source, text FROM {table}),
k(s, id) AS (VALUES {known}),
e(s, id) AS (VALUES {endings}),
x AS (SELECT r, regexp_replace(text, 'spdx-license-identifier:[ \t]*([A-Za-z0-9.+-]+)', chr(10) || 'spdx-license-identifier \1. ' || chr(10), 'gi') AS t
      FROM d WHERE regexp_matches(text, 'licen[cs]|reserved|permission|redistribut|unencumbered', 'i')),
p AS (SELECT r, unnest(parts) AS part, generate_subscripts(parts, 1) AS i
      FROM (SELECT r, regexp_split_to_array(t, '[.!?;:]+(?:\s+|$)|
[^A-Za-z0-9
]*
') AS parts FROM x)),
w AS MATERIALIZED (SELECT r, i, part, {words.format('part')} AS s FROM p),
known_part AS MATERIALIZED (SELECT w.r, w.i, w.part, coalesce(k.id, e.id) AS id FROM w LEFT JOIN k ON w.s = k.s LEFT JOIN e ON ends_with(w.s, e.s)),
ln AS (SELECT r, i, list_filter(list_transform(string_split(part, chr(10)), lambda z: {words.format('z')}), lambda z: z <> '') AS lines
       FROM known_part WHERE id IS NULL AND contains(part, chr(10))),
li AS MATERIALIZED (SELECT r, i, lines, unnest(range(1, len(lines) + 1)) AS j FROM ln),
ru AS (SELECT r, i, j, n, array_to_string(lines[j:j + n - 1], ' ') AS s
       FROM (SELECT *, unnest(range(1, least(len(lines) - j + 1, {reach}) + 1)) AS n FROM li)),
hit AS (SELECT ru.r, ru.i, ru.j, max_by(k.id, ru.n) AS id FROM ru JOIN k ON ru.s = k.s GROUP BY ALL),
u AS (SELECT r, i, 1 AS j, id FROM known_part WHERE id IS NOT NULL OR NOT contains(part, chr(10))
      UNION ALL
      SELECT li.r, li.i, li.j, coalesce(hit.id, e.id) FROM li LEFT JOIN hit ON li.r = hit.r AND li.i = hit.i AND li.j = hit.j
      LEFT JOIN e ON ends_with(li.lines[li.j], e.s)),
h AS (SELECT * FROM (SELECT r, row_number() OVER (PARTITION BY r ORDER BY i, j) - 1 AS pos, id FROM u) WHERE id IS NOT NULL),
j AS (SELECT r, '|' || string_agg(id, '||' ORDER BY pos) || '|' AS joined, string_agg(id, ' ' ORDER BY pos) AS sentence_ids,
             list(id ORDER BY pos) AS ids, list(pos ORDER BY pos) AS places FROM h GROUP BY r),
rules(rule, licence, head, pattern, others) AS (VALUES {rows}),
m AS (SELECT j.*, rules.*, list_position(list_transform(string_split(joined, '|' || head || '|')[2:],
        lambda s: s LIKE pattern AND len(list_filter(others, lambda o: s LIKE o)) = 0), true) AS nth,
        list_filter(list_zip(ids, places), lambda z: z[1] = head) AS starts FROM j JOIN rules ON contains(joined, '|' || head || '|'))
SELECT d.doc_id, d.source, m.licence, m.rule, m.starts[m.nth][2] AS first_sentence, m.sentence_ids FROM m JOIN d ON m.r = d.r WHERE m.nth > 0
"""


def licences_of(matches: DataFrame, key: str) -> DataFrame:
    """(key, licences): the distinct licences of each document, sorted."""
    return matches.groupBy(key).agg(F.sort_array(F.collect_set("licence")).alias("licences"))

