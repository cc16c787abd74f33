import duckdb
from lotline.llm import licenses, queries

MIT = """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
"""
TEXTS = [
    (None, ""), ("", ""), ("no such words here", ""), (MIT, "MIT"), ("some line\nReleased under the MIT License.\nmore text", "MIT"),
    ("text without point\nAll rights reserved", "LicenseRef-all-rights-reserved"),
    ("Licensed under CC BY-NC 4.0. Licensed  under the Apache License, Version 2.0.", "Apache-2.0,CC-BY-NC-4.0"),
    ("# SPDX-License-Identifier: MIT", "MIT"), ("it is released under the MIT license of old", ""),
    ("Released under the MIT License. " * 3000, "MIT"),
    ("The software is provided as is. Permission is hereby granted", ""),
]


def test_rules(docs_of):
    rows = {r["doc_id"]: r for r in licenses.scan(docs_of([t for t, _ in TEXTS], extra=("ids", "hits"))).collect()}
    assert [rows[i]["licenses"] for i in range(len(TEXTS))] == [want for _, want in TEXTS]
    assert rows[3]["sentence_ids"].split(",") == ["mit-heading", "mit-grant", "mit-notice", "as-is-software"]
    assert rows[9]["n_sentences"] == 3000


def test_order_of_identifiers_counts(docs_of):
    sentence = licenses.SENTENCES
    good = ". ".join(sentence[i] for i in ("bsd-terms", "bsd-source", "bsd-binary", "bsd-names"))
    bad = ". ".join(sentence[i] for i in ("bsd-names", "bsd-terms", "bsd-source", "bsd-binary"))
    got = [r["licenses"] for r in licenses.scan(docs_of([good, bad])).orderBy("doc_id").collect()]
    assert got == ["BSD-3-Clause", ""]


def test_sql_agrees_on_edge_texts(docs_of):
    docs = docs_of([t for t, _ in TEXTS])
    frame = docs.toPandas()  # noqa: F841  (read by the SQL)
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM frame")
    want = sorted(con.execute(queries.SQL["op7_license_scan"]).fetchall())
    assert sorted(map(tuple, licenses.scan(docs).collect())) == want


def test_every_sentence_holds_a_stem_and_every_rule_is_known():
    import re

    stems = re.compile(licenses._STEMS)
    assert all(stems.search(s) for s in licenses.SENTENCES.values())
    assert {i for _, _, ids in licenses.RULES for i in ids} <= set(licenses.SENTENCES)


def test_empty_table(docs_of):
    assert licenses.scan(docs_of([(0, "a")]).where("doc_id > 5")).collect() == []


APACHE = """Copyright 2024 Somebody

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
GPL3 = """Copyright (C) 2024 Somebody

This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""
GPL2 = """Copyright (C) 2024 Somebody

This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.
"""
LGPL = """Copyright (C) 2024 Somebody

This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""
BSD2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

Redistributions of source code must retain the above copyright notice,
this list of conditions and the following disclaimer.

Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
"""
BSD3 = BSD2.replace("THIS SOFTWARE IS", """Neither the name of the copyright holder nor the names of its contributors
may be used to endorse or promote products derived from this software without
specific prior written permission.

THIS SOFTWARE IS""")
NOTICES = [
    (APACHE, "Apache-2.0"), (APACHE.replace("http:", "https:"), "Apache-2.0"), (GPL3, "GPL-3.0-or-later"), (GPL2, "GPL-2.0-or-later"),
    (LGPL, "LGPL-2.1-or-later"), (MPL, "MPL-2.0"), ("SPDX-License-Identifier: Apache-2.0\n", "Apache-2.0"),
    ("SPDX-License-Identifier: GPL-2.0-only\n", "GPL-2.0-only"), ("SPDX-License-Identifier: MIT-0\n", "MIT-0"),
    (MIT.replace("MIT License\n", "").replace(" and this permission notice shall", " shall"), "MIT-0"), (BSD3, "BSD-3-Clause"), (BSD2, "BSD-2-Clause"),
    ("SPDX-License-Identifier: GPL-3.0-or-later\n", "GPL-3.0-or-later"), ("SPDX-License-Identifier: BSD-3-Clause\n", "BSD-3-Clause"),
]


def commented(text):
    return "".join(f"# {line}".rstrip() + "\n" for line in text.splitlines()) + "import this\n"


def test_verbatim_notices_plain_and_as_comments(docs_of):
    texts = [t for t, _ in NOTICES] + [commented(t) for t, _ in NOTICES] + [commented(MIT), GPL3.replace("free software", "free\nsoftware")]
    docs = docs_of(texts)
    rows = sorted(map(tuple, licenses.scan(docs).collect()))
    assert [r[3] for r in rows] == [want for _, want in NOTICES] * 2 + ["MIT", "GPL-3.0-or-later"]
    assert "free-program" in rows[-1][2]
    frame = docs.toPandas()  # noqa: F841  (read by the SQL)
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM frame")
    assert rows == sorted(con.execute(queries.SQL["op7_license_scan"]).fetchall())


def test_every_sentence_comes_out_of_the_cut_as_it_is_stored(docs_of):
    rows = licenses.scan(docs_of(list(licenses.SENTENCES.values()))).orderBy("doc_id").collect()
    assert [r["sentence_ids"] for r in rows] == list(licenses.SENTENCES)
