"""Whole licence notices in their standard wording, wrapped as they are in files."""

import re
import textwrap

import pytest

from stayline.llm import licences

MIT = """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
BSD2 = """Copyright (c) 2020, Someone
All  Rights   Reserved.

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2) Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
BSD3 = BSD2 + """

* Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
GPL3 = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""
GPL2 = GPL3.replace("software: you", "software; you").replace("Foundation, either version 3", "Foundation; either version 2")
MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
MIT_IDS = "mit_name,mit_grant,mit_notice,as_is,no_liability"
TEXTS = {
    MIT: ("MIT", MIT_IDS), BSD2: ("BSD-2-Clause", "rights,bsd_grant,bsd_source,bsd_binary"), BSD3: ("BSD-3-Clause", "rights,bsd_grant,bsd_source,bsd_binary,bsd_endorse"),
    APACHE: ("Apache-2.0", "apache2_name,apache_use,apache_copy,apache_as_is,apache_see"), GPL3: ("GPL-3.0-or-later", "gpl_free_3,gpl_hope,gpl_see"),
    GPL2: ("GPL-2.0-or-later", "gpl_free_2,gpl_hope,gpl_see"), MPL: ("MPL-2.0", "mpl_name"),
}


def wrapped(text, width, first, mark, last, end):
    lines = [line for part in text.split("\n") for line in (textwrap.wrap(part, width) or [""])]
    return end.join([*first, *[(mark + line).rstrip() for line in lines], *last])


@pytest.mark.parametrize("style", [
    (10_000, [], "", [], "\n"), (72, [], "", [], "\n"), (40, [], "    ", [], "\r\n"), (70, ["/*"], " * ", [" */"], "\n"),
    (75, [], "# ", [], "\n"), (60, ["int x; "], "// ", ["int y;"], "\r\n"), (66, ["<!--"], "", ["-->"], "\r"), (60, [], "dnl ", [], "\n"),
])
def test_wrapped_notices(docs, got, style):
    table = docs(*[(i, wrapped(text, *style)) for i, text in enumerate(TEXTS)])
    rows = {r.doc_id: (",".join(r.licences), ",".join(r.sentences)) for r in licences.scan(table).collect()}
    assert rows == dict(enumerate(TEXTS.values()))


def test_what_ends_a_sentence(docs):
    texts = [
        "released under the\n\nMIT License", "released under the\n *\nMIT License", "released under. The MIT license of old", "All  Rights Reserved", "as follows: MIT License; the rest",
        "| MIT License |\n", "x#MIT License", "All rights\nreserved", "MIT\nLicensed", "Subject to the following\nMIT License\nand more",
    ]
    rows = {r.doc_id: list(r.sentences) for r in licences.scan(docs(*enumerate(texts))).collect()}
    assert rows == {0: ["mit_name"], 1: ["mit_name"], 2: [], 3: ["rights"], 4: ["mit_name"], 5: ["mit_name"], 6: [], 7: ["rights"], 8: [], 9: ["mit_name"]}


def test_no_sentence_of_the_former_cut_is_lost(docs):
    rows = [(i, f"{before}{text}{after}") for i, (text, before, after) in enumerate((t, b, a) for ts in licences.SENTENCES.values() for t in ts for b in ("", "x\n", "x: ", "x v. ") for a in ("", "\nx", "; x", ". x"))]
    expected = [key for key, ts in licences.SENTENCES.items() for _ in ts for _ in range(16)]
    found = {r.doc_id: [key for key in r.sentences] for r in licences.scan(docs(*rows)).collect()}
    assert re.match("x", rows[5][1]) and [found[i] for i in range(len(rows))] == [[key] for key in expected]
