"""License recognition by sentence rules, in DataFrame functions only.

A text is cut into sentences (and, where a sentence runs over several lines, also into its lines). Each
is normalised to lower-case words and looked up among the known licence sentences. The identifiers
found, in text order, are matched against rules: a rule holds where its identifiers occur in its order. A rule gives way to
a longer one of another licence that has all its identifiers in their order, where that one holds as well.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Normalised sentences of public licences and notices, by identifier, as the cut leaves them: no mark of
# `_END` lies inside one. Notices that are cut in the middle have an identifier for each part.
SENTENCES = {
    "mit-released": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-project": "this project is licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "as-is-software": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit-liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "apache-short": "licensed under the apache license version 2.0",
    "apache-header": "licensed under the apache license version 2.0 the license you may not use this file except in compliance with the license",
    "apache-start": "licensed under the apache license version 2.0 the license",
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at http www.apache.org licenses license 2.0",
    "apache-copy-https": "you may obtain a copy of the license at https www.apache.org licenses license 2.0",
    "apache-at": "you may obtain a copy of the license at",
    "apache-url": "http www.apache.org licenses license 2.0",
    "apache-url-https": "https www.apache.org licenses license 2.0",
    "apache-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-copy-as-is": "you may obtain a copy of the license at http www.apache.org licenses license 2.0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-copy-as-is-https": "you may obtain a copy of the license at https www.apache.org licenses license 2.0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "gpl3-work": "this work is licensed under the gnu general public license version 3",
    "gpl2-work": "this work is licensed under the gnu general public license version 2",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "free-program": "this program is free software",
    "free-library": "this library is free software",
    "gpl3-terms": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2-terms": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "lgpl-terms": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2.1 of the license or at your option any later version",
    "gpl-published": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "lgpl-published": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
    "version-3": "either version 3 of the license or at your option any later version",
    "version-2": "either version 2 of the license or at your option any later version",
    "version-2.1": "either version 2.1 of the license or at your option any later version",
    "useful-program": "this program is distributed in the hope that it will be useful but without any warranty",
    "useful-library": "this library is distributed in the hope that it will be useful but without any warranty",
    "no-implied": "without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-warranty": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "lgpl-free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2.1 of the license or at your option any later version",
    "bsd-terms": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-as-is": "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "cc-by": "licensed under cc by 4.0",
    "cc-by-work": "this work is licensed under a creative commons attribution 4.0 international license",
    "cc-by-sa": "licensed under cc by sa 4.0",
    "cc-by-sa-work": "this work is licensed under a creative commons attribution sharealike 4.0 international license",
    "cc-by-nc": "licensed under cc by nc 4.0",
    "cc-by-nc-work": "this work is licensed under a creative commons attribution noncommercial 4.0 international license",
    "cc0": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "mpl-terms": "this source code form is subject to the terms of the mozilla public license v",
    "mpl-version": "this source code form is subject to the terms of the mozilla public license version 2.0",
    "mpl-copy": "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla.org mpl 2.0",
    "mpl-copy-https": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla.org mpl 2.0",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "reserved": "all rights reserved",
    "mit-heading": "mit license",
    "mit-heading-the": "the mit license",
    "spdx-mit": "spdx license identifier mit",
    "spdx-mit-0": "spdx license identifier mit 0",
    "spdx-apache": "spdx license identifier apache 2.0",
    "spdx-gpl2-only": "spdx license identifier gpl 2.0 only",
    "spdx-gpl2": "spdx license identifier gpl 2.0 or later",
    "spdx-gpl3-only": "spdx license identifier gpl 3.0 only",
    "spdx-gpl3": "spdx license identifier gpl 3.0 or later",
    "spdx-lgpl21": "spdx license identifier lgpl 2.1 or later",
    "spdx-bsd2": "spdx license identifier bsd 2 clause",
    "spdx-bsd3": "spdx license identifier bsd 3 clause",
    "spdx-isc": "spdx license identifier isc",
    "spdx-mpl2": "spdx license identifier mpl 2.0",
    "spdx-cc0": "spdx license identifier cc0 1.0",
    "spdx-cc-by": "spdx license identifier cc by 4.0",
    "spdx-cc-by-sa": "spdx license identifier cc by sa 4.0",
    "spdx-cc-by-nc": "spdx license identifier cc by nc 4.0",
    "spdx-unlicense": "spdx license identifier unlicense",
    "spdx": "spdx license identifier",
    "name-apache": "apache 2.0",
    "name-gpl3": "gpl 3.0 or later",
    "name-bsd3": "bsd 3 clause",
}
# Licence (SPDX name where there is one), kind, identifiers in the order they must come.
RULES = [
    ("MIT", "permissive", ("mit-released",)),
    ("MIT", "permissive", ("mit-licensed",)),
    ("MIT", "permissive", ("mit-project",)),
    ("MIT", "permissive", ("mit-grant", "mit-notice", "as-is-software")),
    ("MIT", "permissive", ("mit-notice", "as-is-software")),
    ("MIT", "permissive", ("spdx-mit",)),
    ("MIT", "permissive", ("mit-heading",)),
    ("MIT", "permissive", ("mit-heading-the",)),
    ("MIT-0", "permissive", ("spdx-mit-0",)),
    ("MIT-0", "permissive", ("mit-grant", "as-is-software")),
    ("ISC", "permissive", ("isc-grant",)),
    ("Apache-2.0", "permissive", ("apache-short",)),
    ("Apache-2.0", "permissive", ("apache-header",)),
    ("Apache-2.0", "permissive", ("apache-copy", "apache-as-is")),
    ("Apache-2.0", "permissive", ("apache-copy-https", "apache-as-is")),
    ("Apache-2.0", "permissive", ("apache-start", "apache-use")),
    ("Apache-2.0", "permissive", ("apache-use", "apache-copy-as-is")),
    ("Apache-2.0", "permissive", ("apache-use", "apache-copy-as-is-https")),
    ("Apache-2.0", "permissive", ("apache-at", "apache-url", "apache-as-is")),
    ("Apache-2.0", "permissive", ("apache-at", "apache-url-https", "apache-as-is")),
    ("Apache-2.0", "permissive", ("spdx-apache",)),
    ("Apache-2.0", "permissive", ("spdx", "name-apache")),
    ("GPL-3.0-only", "copyleft", ("gpl3-work",)),
    ("GPL-2.0-only", "copyleft", ("gpl2-work",)),
    ("GPL-3.0-or-later", "copyleft", ("gpl-free",)),
    ("GPL-3.0-or-later", "copyleft", ("gpl3-terms",)),
    ("GPL-3.0-or-later", "copyleft", ("gpl-published", "version-3")),
    ("GPL-2.0-only", "copyleft", ("spdx-gpl2-only",)),
    ("GPL-2.0-or-later", "copyleft", ("spdx-gpl2",)),
    ("GPL-3.0-only", "copyleft", ("spdx-gpl3-only",)),
    ("GPL-3.0-or-later", "copyleft", ("spdx-gpl3",)),
    ("LGPL-2.1-or-later", "copyleft", ("spdx-lgpl21",)),
    ("ISC", "permissive", ("spdx-isc",)),
    ("MPL-2.0", "copyleft", ("spdx-mpl2",)),
    ("CC0-1.0", "permissive", ("spdx-cc0",)),
    ("CC-BY-4.0", "permissive", ("spdx-cc-by",)),
    ("CC-BY-SA-4.0", "copyleft", ("spdx-cc-by-sa",)),
    ("CC-BY-NC-4.0", "restricted", ("spdx-cc-by-nc",)),
    ("Unlicense", "permissive", ("spdx-unlicense",)),
    ("BSD-2-Clause", "permissive", ("spdx-bsd2",)),
    ("GPL-3.0-or-later", "copyleft", ("spdx", "name-gpl3")),
    ("GPL-2.0-or-later", "copyleft", ("gpl2-free",)),
    ("GPL-2.0-or-later", "copyleft", ("gpl2-terms",)),
    ("GPL-2.0-or-later", "copyleft", ("gpl-published", "version-2")),
    ("LGPL-2.1-or-later", "copyleft", ("lgpl-free",)),
    ("LGPL-2.1-or-later", "copyleft", ("lgpl-terms",)),
    ("LGPL-2.1-or-later", "copyleft", ("lgpl-published", "version-2.1")),
    ("BSD-2-Clause", "permissive", ("bsd-terms", "bsd-source", "bsd-binary", "bsd-as-is")),
    ("BSD-3-Clause", "permissive", ("bsd-terms", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-3-Clause", "permissive", ("bsd-terms", "bsd-source", "bsd-binary", "bsd-names", "bsd-as-is")),
    ("BSD-3-Clause", "permissive", ("spdx-bsd3",)),
    ("BSD-3-Clause", "permissive", ("spdx", "name-bsd3")),
    ("CC-BY-4.0", "permissive", ("cc-by",)),
    ("CC-BY-4.0", "permissive", ("cc-by-work",)),
    ("CC-BY-SA-4.0", "copyleft", ("cc-by-sa",)),
    ("CC-BY-SA-4.0", "copyleft", ("cc-by-sa-work",)),
    ("CC-BY-NC-4.0", "restricted", ("cc-by-nc",)),
    ("CC-BY-NC-4.0", "restricted", ("cc-by-nc-work",)),
    ("CC0-1.0", "permissive", ("cc0",)),
    ("MPL-2.0", "copyleft", ("mpl-terms",)),
    ("MPL-2.0", "copyleft", ("mpl-version",)),
    ("MPL-2.0", "copyleft", ("mpl-copy",)),
    ("MPL-2.0", "copyleft", ("mpl-copy-https",)),
    ("Unlicense", "permissive", ("unlicense",)),
    ("LicenseRef-all-rights-reserved", "restricted", ("reserved",)),
]
# a sentence ends at these marks before white space or the end of the text; an empty line ends one too
_END = r"[.!?:;]+(?=[ \t\r\n]|$)|\n[ \t\r]*\n"
# one of these stems is in every known sentence, so a text without any of them holds none; single words, as a line may end anywhere
_STEMS = r"(?i)licen|permi|distribut|rights|warrant|copyright|software|domain|apache|gpl|bsd"


# the mark after this word would part a notice from its licence
_TAG = "SPDX-License-Identifier"


def _within(short: tuple[str, ...], long: tuple[str, ...]) -> bool:
    rest = iter(long)
    return len(short) < len(long) and all(i in rest for i in short)


def _longer(rule: tuple) -> list[tuple[str, ...]]:
    """Identifiers of the rules that a rule gives way to."""
    name, _, ids = rule
    return [other for n, _, other in RULES if n != name and _within(ids, other)]


def _shape(ids: tuple[str, ...]) -> str:
    return "%" + "%".join(f"<{i}>" for i in ids) + "%"


def _array(items: list[str]) -> Column:
    return F.array(*[F.lit(i) for i in items])


def normalised(sentence: Column) -> Column:
    """Lower case, words apart by one space; a point stays only inside a number or name."""
    spaced = F.regexp_replace(F.lower(sentence), r"[^a-z0-9.]+", " ")
    return F.trim(F.regexp_replace(spaced, r"\.+( |$)", " "))


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in its order, repeats included."""
    known = F.map_from_arrays(_array(list(SENTENCES.values())), _array(list(SENTENCES)))
    parts = F.filter(F.split(text, _END), lambda p: p.rlike(_STEMS))
    own = F.transform(parts, lambda p: F.when(
        F.trim(p).contains("\n"), F.concat(F.array(normalised(p)), F.transform(F.split(p, "\n"), normalised))
    ).otherwise(F.array(normalised(p))))
    found = F.transform(F.flatten(own), lambda s: known[s])
    return F.when(text.rlike(_STEMS), F.filter(found, lambda i: i.isNotNull())).otherwise(F.array().cast("array<string>"))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_sentences, sentence_ids, licenses, kinds), one row per document.

    sentence_ids lists the known sentences in text order, licenses the names of the rules that hold and kinds
    their kinds, each sorted and once, joined by commas; all empty where nothing is found. Null and
    empty texts give empty lists; repeated rows give repeated results. Everything is a row-wise
    expression, so nothing is shuffled and no group can be hot.
    """
    line = F.concat(F.lit("<"), F.array_join("ids", "><"), F.lit(">"))
    hits = F.array(*[
        F.when(
            reduce(lambda a, b: a & ~line.like(_shape(b)), _longer(rule), line.like(_shape(rule[2]))),
            F.struct(F.lit(rule[0]).alias("name"), F.lit(rule[1]).alias("kind")),
        )
        for rule in RULES
    ])
    tagged = F.replace(F.coalesce(docs[text], F.lit("")), F.lit(f"{_TAG}:"), F.lit(_TAG))
    found = docs.select(docs[doc_id].alias("doc_id"), sentence_ids(tagged).alias("ids"))
    found = found.select("doc_id", "ids", F.filter(hits, lambda h: h.isNotNull()).alias("hits"))
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_sentences"),
        F.array_join("ids", ",").alias("sentence_ids"),
        F.array_join(F.array_sort(F.array_distinct(F.col("hits.name"))), ",").alias("licenses"),
        F.array_join(F.array_sort(F.array_distinct(F.col("hits.kind"))), ",").alias("kinds"),
    )


def scan_sql() -> str:
    """The same in DuckDB SQL."""
    rows = ", ".join(f"('{s}', '{i}')" for i, s in SENTENCES.items())
    rules = ", ".join(f"('{n}', '{k}', '{_shape(ids)}', [{', '.join(f"'{_shape(o)}'" for o in _longer((n, k, ids)))}]::VARCHAR[])" for n, k, ids in RULES)
    return f"""
WITH known(sentence, id) AS (VALUES {rows}), rules(name, kind, shape, longer) AS (VALUES {rules}),
cut AS (SELECT row_number() OVER () AS r, doc_id, string_split_regex(
            regexp_replace(replace(coalesce(text, ''), '{_TAG}:', '{_TAG}'), '[.!?:;]+([ \\t\\r\\n]|$)', chr(2) || '\\1', 'g'), chr(2) || '|\\n[ \\t\\r]*\\n') AS parts
        FROM documents),
part AS (SELECT r, unnest(parts) AS p, generate_subscripts(parts, 1) AS i FROM cut),
line AS (SELECT r, i, 0 AS j, p AS s FROM part
         UNION ALL
         SELECT r, i, generate_subscripts(string_split(p, chr(10)), 1), unnest(string_split(p, chr(10))) FROM part
         WHERE contains(trim(p, ' '), chr(10))),
plain AS (SELECT r, i, j, trim(regexp_replace(regexp_replace(lower(s), '[^a-z0-9.]+', ' ', 'g'), '\\.+( |$)', ' ', 'g')) AS s FROM line),
hit AS (SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY i, j) AS ids, '<' || string_agg(id, '><' ORDER BY i, j) || '>' AS line
        FROM plain JOIN known ON s = sentence GROUP BY r),
held AS (SELECT r, list_sort(list_distinct(list(name))) AS names, list_sort(list_distinct(list(kind))) AS kinds
         FROM hit JOIN rules ON line LIKE shape AND len(list_filter(longer, lambda o: line LIKE o)) = 0 GROUP BY r)
SELECT c.doc_id, coalesce(h.n, 0)::BIGINT AS n_sentences, coalesce(h.ids, '') AS sentence_ids,
       coalesce(array_to_string(names, ','), '') AS licenses, coalesce(array_to_string(kinds, ','), '') AS kinds
FROM cut c LEFT JOIN hit h USING (r) LEFT JOIN held USING (r)"""
