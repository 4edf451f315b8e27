"""License scan by sentences: known sentences to identifiers, identifier sequences to rules.

A text is cut into units at line ends and after ``. ! ? ; :``.  From every unit the sentence
that starts there is the unit alone or, if hard-wrapped, the units up to the next
one that ends a sentence, or else the longest run of units that is a known sentence, past inner ends
as in ``SPDX-License-Identifier: MIT``.  Every unit has a word at least, so no more units are joined than
the longest known sentence has words, and none is lost by it.  Sentences are normalised (lower case, runs of
other than letters, digits, dots and plus signs to one space, no dots at the end) and looked up in
``SENTENCES``; a unit that begins no known sentence is not joined.  The identifiers in text order form one string, on which the ordered ``RULES`` are matched; a
rule consumes what it matches, so a long notice wins over the short ones inside it.

Everything is one projection of built-in functions.  Every known sentence holds one of
``HINTS``, so texts without a hint skip the cutting with nothing lost.

Defined results: a null or empty text has no sentences and no licenses; repeated rows give
repeated rows; extra columns are not read; texts are scanned whole.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.quality_rules import let

#: Units of a wrapped sentence in the SQL; the operator joins as many as the longest known sentence has words.
WRAP = 12
#: Between two words of a hint may be what a line end and a comment mark leave.
HINTS = "licen[sc]e|copyright|redistribut|warrant|permission|public[^A-Za-z0-9.+]+domain|liab"

#: Sentences of public licenses and notices, by identifier.
SENTENCES = {
    "MIT_SHORT": ["Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the MIT License.", "Distributed under the MIT License.", "SPDX-License-Identifier: MIT", "The MIT License", "The MIT License (MIT)", "MIT License"],
    "MIT_GRANT": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"],
    "MIT_NOTICE": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "MIT_AS_IS": ["THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."],
    "MIT_LIABILITY": ["IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."],
    "APACHE_SHORT": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0", "Released under the Apache License 2.0.", "SPDX-License-Identifier: Apache-2.0"],
    "APACHE_GRANT": ["Licensed under the Apache License, Version 2.0 (the \"License\");"],
    "APACHE_COMPLIANCE": ["you may not use this file except in compliance with the License."],
    "APACHE_COPY": ["You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "http://www.apache.org/licenses/LICENSE-2.0"],
    "APACHE_AS_IS": ["Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."],
    "GPL3_SHORT": ["This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 3.", "Released under the GNU General Public License v3.0.", "SPDX-License-Identifier: GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-or-later"],
    "GPL2_SHORT": ["This work is licensed under the GNU General Public License, version 2.", "Licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-or-later"],
    "GPL2_GRANT": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation;"],
    "GPL2_VERSION": ["either version 2 of the License, or (at your option) any later version."],
    "GPL3_GRANT": ["you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "GPL_NO_WARRANTY": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;", "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."],
    "LGPL_SHORT": ["Licensed under the GNU Lesser General Public License, version 3.", "SPDX-License-Identifier: LGPL-3.0-only", "SPDX-License-Identifier: LGPL-2.1-only"],
    "BSD_GRANT": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "BSD_SOURCE": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."],
    "BSD_BINARY": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."],
    "BSD_NO_ENDORSE": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."],
    "BSD2_SHORT": ["Licensed under the BSD 2-Clause License.", "SPDX-License-Identifier: BSD-2-Clause"],
    "BSD3_SHORT": ["Licensed under the BSD 3-Clause License.", "Released under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause"],
    "ISC_GRANT": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "ISC_SHORT": ["Licensed under the ISC License.", "SPDX-License-Identifier: ISC"],
    "MPL_SHORT": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "SPDX-License-Identifier: MPL-2.0"],
    "UNLICENSE": ["This is free and unencumbered software released into the public domain.", "SPDX-License-Identifier: Unlicense"],
    "CC_BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC_BY_SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC_BY_NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC_BY_ND": ["Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "CC0": ["Licensed under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "SPDX-License-Identifier: CC0-1.0"],
}

#: License and the sequence of identifiers that states it; earlier rules win.
RULES = (
    ("MIT", ["MIT_SHORT", "MIT_GRANT", "MIT_NOTICE", "MIT_AS_IS", "MIT_LIABILITY"]),
    ("MIT", ["MIT_GRANT", "MIT_NOTICE", "MIT_AS_IS", "MIT_LIABILITY"]),
    ("MIT", ["MIT_GRANT", "MIT_NOTICE", "MIT_AS_IS"]),
    ("Apache-2.0", ["APACHE_GRANT", "APACHE_COMPLIANCE", "APACHE_COPY", "APACHE_AS_IS"]),
    ("Apache-2.0", ["APACHE_GRANT", "APACHE_COMPLIANCE"]),
    ("BSD-3-Clause", ["BSD_GRANT", "BSD_SOURCE", "BSD_BINARY", "BSD_NO_ENDORSE"]),
    ("BSD-2-Clause", ["BSD_GRANT", "BSD_SOURCE", "BSD_BINARY"]),
    ("GPL-2.0-or-later", ["GPL2_GRANT", "GPL2_VERSION"]),
    ("GPL-2.0-or-later", ["GPL2_GRANT"]),
    ("GPL-3.0-or-later", ["GPL3_GRANT"]),
    ("ISC", ["ISC_GRANT"]),
    ("MIT", ["MIT_SHORT"]), ("Apache-2.0", ["APACHE_SHORT"]), ("GPL-3.0", ["GPL3_SHORT"]), ("GPL-2.0", ["GPL2_SHORT"]),
    ("LGPL", ["LGPL_SHORT"]), ("BSD-2-Clause", ["BSD2_SHORT"]), ("BSD-3-Clause", ["BSD3_SHORT"]), ("ISC", ["ISC_SHORT"]),
    ("MPL-2.0", ["MPL_SHORT"]), ("Unlicense", ["UNLICENSE"]), ("CC-BY-4.0", ["CC_BY"]), ("CC-BY-SA-4.0", ["CC_BY_SA"]),
    ("CC-BY-NC-4.0", ["CC_BY_NC"]), ("CC-BY-ND-4.0", ["CC_BY_ND"]), ("CC0-1.0", ["CC0"]),
)


def normal(sentence: str) -> str:
    return re.sub(r"[ .]+$", "", re.sub(r"[^a-z0-9.+]+", " ", sentence.lower()).strip())


def known() -> dict[str, str]:
    """Normalised sentence -> identifier."""
    return {normal(s): name for name, sentences in SENTENCES.items() for s in sentences}


def _normal(c: Column) -> Column:
    return F.regexp_replace(F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9.+]+", " ")), "[ .]+$", "")


def beginnings() -> list[str]:
    """What the first of several units of a known sentence can be: its first words."""
    words = [s.split(" ") for s in known()]
    return sorted({normal(" ".join(w[:k])) for w in words for k in range(1, len(w))})


def whole() -> dict[str, str]:
    """The known sentences that are looked up past inner sentence ends: all but those with a known sentence among their own units."""
    parts = {x: [normal(u) for u in re.sub(r"([.!?;:])[ \t]+", "\\1\n", x).split("\n")] for sentences in SENTENCES.values() for x in sentences}
    return {normal(x): known()[normal(x)] for x, units in parts.items() if len(units) == 1 or not set(units) & set(known())}


def _lookup(sentences: dict[str, str]):
    table = F.create_map(*[F.lit(x) for pair in sorted(sentences.items()) for x in pair])
    return lambda c: F.try_element_at(table, c)


def identifiers(text: Column) -> Column:
    """Array of the identifiers of the text's known sentences, in text order."""
    units = F.filter(F.split(F.regexp_replace(text, r"([.!?;:])[ \t]+", "$1\n"), r"[\r\n]+", -1), lambda u: u.rlike(r"[A-Za-z0-9]"))

    def found(us: Column) -> Column:
        return let(F.transform(us, lambda u: u.rlike(r"[.!?;:][\s\"')]*$")), lambda ends: _ids(us, ends))

    return F.when(text.rlike(f"(?i){HINTS}"), let(units, found)).otherwise(F.array().cast("array<string>"))


def _ids(units: Column, ends: Column) -> Column:
    one, several, first = _lookup(known()), _lookup(whole()), beginnings()
    longest = max(len(s.split(" ")) for s in known())

    def joined(i: Column, n: Column) -> Column:
        return _normal(F.array_join(F.slice(units, i + 1, n), " "))

    def longer(i: Column) -> Column:
        n = F.array_position(F.slice(ends, i + 1, longest), True).cast("int")
        to = F.least(F.lit(longest), F.size(units) - i)
        past = F.when(to > 1, F.try_element_at(F.array_compact(F.transform(F.sequence(F.lit(2), to), lambda k: several(joined(i, k)))), F.lit(-1)))
        return F.coalesce(F.when(n > 1, one(joined(i, n))), past)

    def at(u: Column, i: Column) -> Column:
        return let(_normal(u), lambda s: F.coalesce(one(s), F.when(s.isin(first), longer(i))))

    return F.array_compact(F.transform(units, at))


def _apply_rules(ids: Column) -> Column:
    """Struct of the licenses found (sorted, distinct) and the identifiers that no rule took."""
    nothing = F.array().cast("array<string>")
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(" " + "  ".join(sequence) + " ").alias("pattern")) for name, sequence in RULES])
    start = F.struct(F.concat(F.lit(" "), F.array_join(ids, "  "), F.lit(" ")).alias("rest"), nothing.alias("found"))
    one = lambda s, r: F.struct(F.replace(s["rest"], r["pattern"], F.lit(" - ")).alias("rest"),
                                F.when(F.contains(s["rest"], r["pattern"]), F.array_append(s["found"], r["name"])).otherwise(s["found"]).alias("found"))
    end = lambda s: F.struct(F.array_sort(F.array_distinct(s["found"])).alias("licenses"),
                             F.filter(F.split(s["rest"], " +", -1), lambda x: ~x.isin("", "-")).alias("unmatched"))
    return F.when(F.size(ids) == 0, F.struct(nothing.alias("licenses"), nothing.alias("unmatched"))).otherwise(F.aggregate(rules, start, one, end))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, sentence_ids, licenses and unmatched (arrays) of every row."""
    ids = identifiers(F.coalesce(F.col(text_col), F.lit("")))
    both = let(ids, lambda x: F.struct(x.alias("ids"), _apply_rules(x).alias("r")))
    return docs.select(F.col(id_col).alias("doc_id"), both.alias("_l")).select(
        "doc_id", F.col("_l.ids").alias("sentence_ids"), F.col("_l.r.licenses").alias("licenses"), F.col("_l.r.unmatched").alias("unmatched"))


def oracle_sql() -> str:
    """The registered query's rows in DuckDB."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    table = ", ".join(f"({quote(s)}, {quote(i)})" for s, i in sorted(known().items()))
    norm = lambda c: f"regexp_replace(trim(regexp_replace(lower({c}), '[^a-z0-9.+]+', ' ', 'g')), '[ .]+$', '')"
    steps, last = [], "r0"
    for k, (name, sequence) in enumerate(RULES):
        pattern = quote(" " + "  ".join(sequence) + " ")
        steps.append(f"r{k + 1} AS (SELECT rid, replace(rest, {pattern}, ' - ') AS rest, CASE WHEN contains(rest, {pattern}) THEN list_append(found, {quote(name)}) ELSE found END AS found FROM r{k})")
        last = f"r{k + 1}"
    return f"""
WITH known(s, sid) AS (VALUES {table}),
d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
u AS (SELECT rid, [x for x in string_split_regex(regexp_replace(text, '([.!?;:])[ \\t]+', '\\1' || chr(10), 'g'), '[\\r\\n]+') if regexp_matches(x, '[A-Za-z0-9]')] AS us FROM d),
e AS (SELECT rid, us, [regexp_matches(x, '[.!?;:][\\s"'')]*$') for x in us] AS es FROM u),
i AS (SELECT rid, unnest(generate_series(1, len(us))) AS i, us, es FROM e WHERE len(us) > 0),
w AS (SELECT rid, i, us[i] AS one, CASE WHEN list_position(es[i:i + {WRAP - 1}], true) > 1 THEN array_to_string(us[i:i + list_position(es[i:i + {WRAP - 1}], true) - 1], ' ') END AS many FROM i),
m AS (SELECT rid, i, coalesce(a.sid, b.sid) AS sid FROM w LEFT JOIN known a ON a.s = {norm('one')} LEFT JOIN known b ON b.s = {norm('many')}),
g AS (SELECT rid, list(sid ORDER BY i) AS ids FROM m WHERE sid IS NOT NULL GROUP BY rid),
r0 AS (SELECT rid, ' ' || array_to_string(ids, '  ') || ' ' AS rest, CAST([] AS VARCHAR[]) AS found FROM g),
{', '.join(steps)}
SELECT d.doc_id, CAST(coalesce(len(g.ids), 0) AS BIGINT) AS n_sentences, coalesce(array_to_string(g.ids, ','), '') AS sentence_ids,
       coalesce(array_to_string(list_sort(list_distinct(f.found)), ','), '') AS licenses,
       coalesce(array_to_string([x for x in string_split_regex(f.rest, ' +') if x <> '' AND x <> '-'], ','), '') AS unmatched
FROM d LEFT JOIN g USING (rid) LEFT JOIN {last} f USING (rid)"""
