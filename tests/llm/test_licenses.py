import re

from ledgerfold.llm import licenses as L
from tests.llm.cases import TEXTS, documents

MIT = "\n".join(["MIT License", "", "Copyright (c) 2020 Someone", "",
                 "Permission is hereby granted, free of charge, to any person obtaining a copy", "of this software and associated documentation files (the \"Software\"), to deal",
                 "in the Software without restriction, including without limitation the rights", "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell",
                 "copies of the Software, and to permit persons to whom the Software is", "furnished to do so, subject to the following conditions:", "",
                 "The above copyright notice and this permission notice shall be included in all", "copies or substantial portions of the Software.", "",
                 "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR", "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,",
                 "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE", "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER",
                 "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,", "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE", "SOFTWARE."])


def scan(spark, *texts):
    rows = L.scan_licenses(documents(spark, list(enumerate(texts)))).collect()
    return [(r.licenses, r.unmatched) for r in sorted(rows, key=lambda r: r.doc_id)]


def test_every_known_sentence_holds_a_hint():
    assert all(re.search(L.HINTS, s) for s in L.known())
    assert {i for _, ids in L.RULES for i in ids} <= set(L.SENTENCES)


def test_hard_wrapped_notice_is_one_license(spark):
    got = scan(spark, MIT, "before\n" + MIT.replace("MIT License\n", "", 1) + "\nafter", MIT.split("\n\n", 2)[2].replace("\n", " "))
    assert [g[0] for g in got] == [["MIT"]] * 3
    assert got[0][1] == []


def test_lines_rules_and_leftovers(spark):
    got = scan(spark, "Some text without an end\nLicensed under the Apache License, Version 2.0.\nmore",
               "Released under the MIT License. Licensed under CC BY-NC 4.0.", "This program has a license.",
               "THE ABOVE copyright notice and this permission notice shall be included in all copies or substantial portions of the software")
    assert got == [(["Apache-2.0"], []), (["CC-BY-NC-4.0", "MIT"], []), ([], []), ([], ["MIT_NOTICE"])]


def test_awkward_rows(spark):
    rows = L.scan_licenses(documents(spark)).collect()
    assert len(rows) == len(TEXTS) and all(r.licenses == [] and r.sentence_ids == [] for r in rows)
    assert L.scan_licenses(documents(spark, [])).collect() == []


def test_every_sentence_is_found_in_its_own_text(spark):
    listed = [(name, s) for name, sentences in L.SENTENCES.items() for s in sentences]
    texts = [f"import os\n# {s}\n\nmore text" for _, s in listed]
    rows = L.scan_licenses(documents(spark, list(enumerate(texts)))).collect()
    got = {r.doc_id: r.sentence_ids for r in rows}
    assert [s for i, (name, s) in enumerate(listed) if name not in got[i]] == []
    assert got[[s for _, s in listed].index(L.SENTENCES["GPL2_GRANT"][0])] == ["GPL2_GRANT", "GPL2_VERSION"]


def test_tags_and_inner_ends(spark):
    got = scan(spark, "/* SPDX-License-Identifier: Apache-2.0 */\nint x;", "SPDX-License-Identifier: MIT-0", "SPDX-License-Identifier:",
               "This Source Code Form is subject to the terms of the\n * Mozilla Public License, v. 2.0. If a copy of the MPL was not\n * distributed")
    assert got == [(["Apache-2.0"], []), ([], []), ([], []), (["MPL-2.0"], [])]


def test_narrow_wraps_and_a_parted_hint(spark):
    import textwrap

    paragraphs = MIT.split("\n\n")[2:]
    narrow = ["\n\n".join("\n".join(f" * {line}" for line in textwrap.wrap(p.replace("\n", " "), width, break_long_words=False)) for p in paragraphs) for width in (38, 20, 1)]
    unlicense = "This is free and unencumbered software released into the public\n * domain."
    assert scan(spark, *narrow, unlicense) == [(["MIT"], [])] * 3 + [(["Unlicense"], [])]
