import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltmill.llm import licenses as op


def scan(make, rows):
    return {r.doc_id: r for r in op.scan_licenses(make(rows)).collect()}


def test_cases(make):
    got = scan(
        make,
        [
            (1, "Licensed under CC BY-NC 4.0.\nx"),
            (2, "This work is licensed under the GNU General Public License, version 3."),
            (3, "All rights reserved. all RIGHTS reserved"),
            (4, None),
            (5, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
            (6, "Permission is hereby granted, free of charge, to any person obtaining a copy of this program and associated documentation files, to deal in the Software without restriction"),
            (7, "Copyright (c) 2024 A. Person and others. All rights reserved."),
            (8, "Licensed under the Apache License 2.0"),
            (9, ""),
        ],
    )
    assert (got[1].labels, got[1].base_labels, got[1].n_base, got[1].first_word, got[1].score) == ("cc-by,cc-by-nc", "cc-by", 1, 2, 5 / 9)
    assert got[2].labels == "gpl,gpl-3.0"
    assert (got[3].n_base, got[3].first_word, got[3].last_word, got[3].score) == (2, 0, 3, 3 / 7)
    assert (got[4].n_words, got[4].n_base, got[4].first_word, got[4].labels, got[4].score) == (0, 0, None, "", 0.0)
    assert got[5].labels == "" and got[6].labels == ""
    assert got[7].labels == "reserved" and got[7].score == 0.5
    assert got[8].labels == "apache-2.0" and got[9].n_words == 0
    assert op.scan_licenses(make([])).count() == 0


def pattern(parts):
    out = ""
    for p in parts:
        out += re.escape(p.word) + " " if p.kind == "word" else f"(?:[^ ]+ ){{0,{p.most}}}" if p.kind == "any" else f"(?:{pattern(p.parts)})?"
    return out


BSD = """Copyright (c) 2020, Some Person
All rights reserved.

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution.
{third}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO,
THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS
BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
MIT = """MIT License
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
THE SOFTWARE."""


def test_whole_licenses(make):
    """Variants are told apart by their mandatory wording; a changed mandatory word is no match; replaceable words may be others."""
    got = scan(
        make,
        [
            (1, BSD.format(third="")),
            (2, BSD.format(third=THIRD)),
            (3, MIT),
            (4, MIT.replace("merge", "fuse")),
            (5, MIT.replace("AUTHORS OR COPYRIGHT HOLDERS", "PEOPLE OF ACME")),
            (6, BSD.format(third=THIRD).replace("Neither", "Not")),
        ],
    )
    assert {i: r.labels for i, r in got.items()} == {1: "bsd,bsd-2-clause,reserved", 2: "bsd,bsd-3-clause,reserved", 3: "mit-text", 4: "", 5: "mit-text", 6: "bsd,reserved"}
    assert got[2].score > got[1].score > 0.97


def test_every_template_like_its_pattern():
    """The automata against the hand-written patterns: each template's mandatory words alone, and with its optional words."""
    for (label, wording), (same, written) in zip(op.TEMPLATES, op.PATTERNS, strict=True):
        parts, (p, n) = op.trimmed(op.parse(wording)), op.written_out(written)
        bare = op.needed(parts)
        full = [w for x in parts for w in ([x.word] if x.kind == "word" else ["x"] if x.kind == "any" else [y.word if y.kind == "word" else "x" for y in x.parts if y.kind != "optional"])]
        assert label == same and n == len(bare)
        for words in (bare, full, bare[:-1], [*bare[:2], "other", *bare[2:]]):
            assert op.Automaton(parts).accepts(words) == bool(re.match(p, "".join(w + " " for w in words))), (label, words)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "c", "d"]), max_size=12))
def test_automaton_like_pattern(words):
    for wording in ("a [[b]] c", "a <<2>> b", "a [[b [[c]] <<1>>]] d", "b"):
        parts = op.trimmed(op.parse(wording))
        text = "".join(w + " " for w in words)
        assert op.Automaton(parts).accepts(words) == bool(re.match(pattern(parts), text))


def test_marks_must_balance():
    for wording in ("a [[b", "a ]] b"):
        with pytest.raises(ValueError):
            op.parse(wording)
