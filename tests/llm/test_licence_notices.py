"""Every licence rule against the notice it is for, word for word with its line breaks."""

from ratewise.llm import licenses
from tests.llm.test_documents import docs

GPL = """    {0}Copyright (C) <year>  <name of author>

    This program is free software{1} you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation{2} either version {3} of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY{4} without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.
"""
CONDITIONS = """Copyright (c) <year> <owner>

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
ENDORSE = """
{0}. Neither the name of {1} nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
ADVERTISING = """
3. All advertising materials mentioning features or use of this software must
   display the following acknowledgement:
   This product includes software developed by the organization.
"""
DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED.
"""
NOTICES = [
    ("apache2-notice", "Licensed under the Apache License, Version 2.0."),
    ("apache2-header", """Copyright [yyyy] [name of copyright owner]

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""),
    ("mit-notice", "Released under the MIT License."),
    ("mit-licensed", "Licensed under the MIT License."),
    ("mit-text", """MIT License

Copyright (c) <year> <copyright holders>

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND.
"""),
    ("gpl3-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl3-header-cut", GPL.format("", ":", ",", 3, ";")),
    ("gpl3-header-either", GPL.format("", ";", ";", 3, ";")),
    ("gpl2-header-either", GPL.format("", ";", ";", 2, ";")),
    ("gpl2-header-cut", GPL.format("", ";", ",", 2, ";")),
    ("gpl3-header", GPL.format("", ",", ",", 3, ",")),
    ("gpl2-header", GPL.format("", ",", ",", 2, ",")),
    ("bsd2-text", CONDITIONS + DISCLAIMER),
    ("bsd3-text", CONDITIONS + ENDORSE.format(3, "the copyright holder") + DISCLAIMER),
    ("bsd3-text", CONDITIONS + ENDORSE.format(3, "Google Inc.") + DISCLAIMER),
    ("bsd4-text", CONDITIONS + ADVERTISING + ENDORSE.format(4, "the copyright holder") + DISCLAIMER),
    ("isc-text", """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""),
    ("mpl2-header", """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""),
    ("mpl2-notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v.2.0."),
    ("cc-by-nc-4-notice", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4-notice", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4-notice", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc-4-work", "This work is licensed under CC BY-NC 4.0. To view a copy of this license, visit https://creativecommons.org/licenses/by-nc/4.0/"),
    ("cc-by-4-work", "This work is licensed under CC BY 4.0. To view a copy of this license, visit https://creativecommons.org/licenses/by/4.0/"),
    ("cc-by-sa-4-work", "This work is licensed under CC BY-SA 4.0. To view a copy of this license, visit https://creativecommons.org/licenses/by-sa/4.0/"),
    ("cc0-notice", "Licensed under CC0 1.0."),
    ("unlicense-text", "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy."),
    ("all-rights-reserved", "Copyright 2020 The Owner. All rights reserved."),
]


NOTICES += [
    ("lgpl21-header", """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.

This library is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
Lesser General Public License for more details.
"""),
    ("lgpl3-header", """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Lesser General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

See the GNU Lesser General Public License for more details.
"""),
    ("agpl3-header", """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Affero General Public License as
published by the Free Software Foundation, either version 3 of the
License, or (at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU Affero General Public License for more details.
"""),
    ("zlib-text", """Copyright (c) <year> <holders>

This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented.
"""),
    ("bsl-notice", """         Copyright Joe Coder 2004 - 2006.
Distributed under the Boost Software License, Version 1.0.
   (See accompanying file LICENSE_1_0.txt or copy at
         https://www.boost.org/LICENSE_1_0.txt)
"""),
    ("epl2-notice", """This program and the accompanying materials are made
available under the terms of the Eclipse Public License 2.0
which is available at https://www.eclipse.org/legal/epl-2.0/

Contributors: someone
"""),
    ("lgpl3-header-either", """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU Lesser General Public License as published by
the Free Software Foundation; either version 3 of the License, or
(at your option) any later version.

See the GNU Lesser General Public License for more details.
"""),
    ("epl2-notice-v", """This program and the accompanying materials are made available under the
terms of the Eclipse Public License v. 2.0 which is available at
https://www.eclipse.org/legal/epl-2.0/
"""),
    ("mit-title", "The MIT License\n\nCopyright (c) <year>\n"),
]
NOTICES += [(f"spdx-{x.lower()}", f"x\nSPDX-License-Identifier: {x}\nint main() {{ return 0; }}\n") for x in licenses.SPDX]


def test_every_rule_matches_its_notice_and_no_other(spark):
    assert {rule for rule, _ in NOTICES} == set(licenses.RULES)
    got = {}
    for r in licenses.scan(docs(spark, [(i, text) for i, (_, text) in enumerate(NOTICES)])).collect():
        got.setdefault(r.doc_id, []).append((r.rule, r.licence))
    assert got == {i: [(rule, licenses.RULES[rule][0])] for i, (rule, _) in enumerate(NOTICES)}


def commented(text, style):
    lead = {"//": "// ", "#": "# ", "*": " * ", "--": "-- "}[style]
    body = "\n".join((lead + x).rstrip() for x in text.split("\n"))
    return f"/*\n{body}\n */\nint x;\n" if style == "*" else f"{body}\nint x = 1\n"


def found(spark, texts):
    out = {i: set() for i in range(len(texts))}
    for r in licenses.scan(docs(spark, list(enumerate(texts)))).collect():
        out[r.doc_id].add(r.rule)
    return out


def test_every_notice_is_found_plain_and_under_four_comment_styles(spark):
    cases = NOTICES
    texts, wants = [], []
    for rule, text in cases:
        for shown in [text, *[commented(text, s) for s in ("//", "#", "*", "--")], f"first line without a stop\n{text}"]:
            texts.append(shown)
            wants.append(rule)
    got = found(spark, texts)
    assert [(wants[i], texts[i][:60], got[i]) for i in got if wants[i] not in got[i]] == []
    for i, rule in enumerate(wants):  # a longer text's rule stands instead of the shorter's
        assert not got[i] & set(licenses.GIVES_WAY) - {rule}


def test_precedence_is_by_match(spark):
    bsd2 = dict(NOTICES)["bsd2-text"]
    bsd3 = dict(NOTICES)["bsd3-text"]
    got = found(spark, [bsd2 + "\n\nand below\n\n" + bsd3, bsd3 + "\n\nand below\n\n" + bsd2, bsd3, bsd2])
    assert got == {0: {"bsd2-text", "bsd3-text"}, 1: {"bsd2-text", "bsd3-text"}, 2: {"bsd3-text"}, 3: {"bsd2-text"}}
    places = {r.rule: r.first_sentence for r in licenses.scan(docs(spark, [(1, bsd2 + "\n\nand below\n\n" + bsd3)])).collect()}
    assert places["bsd2-text"] < places["bsd3-text"]


def test_the_sql_says_the_same(spark):
    import duckdb

    texts = [t for _, t in NOTICES] + [commented(t, s) for _, t in NOTICES for s in ("//", "#", "*", "--")]
    texts += [dict(NOTICES)["bsd2-text"] + dict(NOTICES)["bsd3-text"], None, "", "a\n" * 40 + "All rights reserved.\n" + "b\n" * 30, "x " * 70000 + "All rights reserved"]
    rows = list(enumerate(texts))
    got = sorted((r.doc_id, r.licence, r.rule, r.first_sentence, r.sentence_ids) for r in licenses.scan(docs(spark, rows)).collect())
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, source VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, 's', ?)", rows)
    want = sorted((r[0], *r[2:]) for r in con.execute(licenses.oracle()).fetchall())
    assert got == want and len(got) > len(rows) / 2


def test_every_rule_has_a_sentence_with_a_signal():
    import re
    for name, (_, ids) in licenses.RULES.items():
        known = licenses.SENTENCES | {v: k for k, v in licenses.ENDINGS.items()}
        assert any(re.search(licenses.SIGNAL, known[i]) for i in ids), name
    for rule, others in licenses.GIVES_WAY.items():
        assert {licenses.RULES[o][1][0] for o in others} == {licenses.RULES[rule][1][0]}


def test_columns_with_the_names_of_steps_do_not_clash(spark):
    from pyspark.sql import functions as F
    df = docs(spark, [(1, "All rights reserved.")]).withColumns({c: F.lit(7) for c in ("hits", "joined", "match", "parts", "rule")})
    got = licenses.scan(df).first()
    assert got.hits == 7 and got.parts == 7 and got.rule == "all-rights-reserved"
