"""License scans by template-markup matching.

A template is license wording with marked regions: ``[[ ... ]]`` is optional,
``<<n>>`` is replaceable by up to n words. It is compiled into a token automaton
whose states are places in the wording; a text is accepted at a word if, from
there, the automaton comes to its end, so all mandatory wording matches exactly
and in order. Words are lower-cased and punctuation is no part of them.

Beside the templates stand the base phrases, found at every place where their
words stand consecutively.

Automata start only at words that can begin a template, a run ends as soon as
no state is left, and it is no longer than its template allows, so a text costs
its length times a bound of the templates.

Defined cases: a null text is empty; a text without findings has null places,
empty labels and score 0; repeated rows get their row again; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from siltmill.llm import words as W
from siltmill.llm.common import prepare, table

#: Base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

_AS_IS = (
    "this software is provided by [[the]] <<8>> as is and any express or implied warranties including but not limited to the implied warranties of "
    "merchantability and fitness for a particular purpose are disclaimed in no event shall [[the]] <<8>> be liable for any direct indirect incidental "
    "special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or "
    "business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise "
    "arising in any way out of the use of this software even if advised of the possibility of such damage"
)
_BSD_HEAD = "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"
_BSD_TWO = (
    "[[<<1>>]] redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
    "[[<<1>>]] redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the "
    "documentation and or other materials provided with the distribution"
)
_BSD_THREE = "[[<<1>>]] neither the name of [[the]] <<8>> nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"

#: (label, wording). [[...]] is optional, <<n>> stands for up to n words of any kind.
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license [[version]] 2 0 [[the license]]"),
    (
        "apache-2.0-notice",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy "
        "of the license at [[http]] [[https]] www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software "
        "distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the "
        "license for the specific language governing permissions and limitations under the license",
    ),
    ("bsd", _BSD_HEAD),
    ("bsd-2-clause", f"{_BSD_HEAD} {_BSD_TWO} {_AS_IS}"),
    ("bsd-3-clause", f"{_BSD_HEAD} {_BSD_TWO} {_BSD_THREE} {_AS_IS}"),
    ("cc-by", "[[this work is]] licensed under [[a]] [[the]] creative commons attribution [[<<3>> 4 0]] [[international]] license"),
    ("cc-by-4.0", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc [[4 0]]"),
    ("cc-by-nc-sa", "licensed under cc by nc sa [[4 0]]"),
    ("cc-by-sa", "licensed under [[a]] [[the]] cc by sa [[4 0]]"),
    ("cc-by-sa", "licensed under [[a]] [[the]] creative commons attribution share alike [[<<2>>]] [[international]] license"),
    ("cc0", "[[to the extent possible under law]] <<8>> has waived all copyright and related or neighboring rights to this work"),
    ("gpl-2.0", "licensed under the gnu general public license [[as published by the free software foundation]] [[either]] version 2"),
    ("gpl-3.0", "licensed under the gnu general public license [[as published by the free software foundation]] [[either]] version 3"),
    (
        "gpl-notice",
        "<<6>> is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free "
        "software foundation [[either]] version <<1>> of the license [[or at your option any later version]] <<6>> is distributed in the hope that it will "
        "be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general "
        "public license for more details",
    ),
    (
        "isc",
        "permission to use copy modify [[and]] [[or]] distribute this software for any purpose with or without fee is hereby granted provided that the above "
        "copyright notice and this permission notice appear in all copies",
    ),
    ("lgpl", "gnu lesser general public license [[version]] <<1>>"),
    (
        "lgpl-notice",
        "<<6>> is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free "
        "software foundation [[either]] version <<2>> of the license [[or at your option any later version]]",
    ),
    ("mit", "[[released]] [[licensed]] under the mit license"),
    (
        "mit-text",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal "
        "in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
        "copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright "
        "notice and this permission notice [[including the next paragraph]] shall be included in all copies or substantial portions of the software the "
        "software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness "
        "for a particular purpose and noninfringement in no event shall [[the]] <<6>> be liable for any claim damages or other liability whether in an "
        "action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    ),
    (
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0 [[if a copy of the mpl was not distributed with this file you can "
        "obtain one at [[http]] [[https]] mozilla org mpl 2 0]]",
    ),
    ("reserved", "copyright [[c]] <<6>> all rights reserved"),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this "
        "software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
    ),
    (
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the "
        "use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and "
        "redistribute it freely subject to the following restrictions",
    ),
]
#: A score is e / (e + HALF) for e words of evidence.
HALF = 4

_RESULT = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


@dataclass
class Node:
    """A part of a template: a word, a replaceable region of up to ``most`` words, or an optional group."""

    kind: str
    word: str = ""
    most: int = 0
    parts: list[Node] = field(default_factory=list)


def parse(wording: str) -> list[Node]:
    """The parts of a template; groups may nest. Raises ValueError on unbalanced marks."""
    stack: list[list[Node]] = [[]]
    for mark, most, close, word in re.findall(r"(\[\[)|<<(\d+)>>|(\]\])|([^\s\[\]<>]+)", wording.lower()):
        if mark:
            stack.append([])
        elif close:
            if len(stack) < 2:
                raise ValueError(f"unbalanced ]] in {wording!r}")
            parts = stack.pop()
            stack[-1].append(Node("optional", parts=parts))
        elif most:
            stack[-1].append(Node("any", most=int(most)))
        else:
            stack[-1].append(Node("word", word))
    if len(stack) != 1:
        raise ValueError(f"unbalanced [[ in {wording!r}")
    return stack[0]


class Automaton:
    """States 0..n with edges on a word, on any word, or on none; the last state accepts."""

    def __init__(self, parts: list[Node]):
        self.word: list[dict[str, list[int]]] = [{}]
        self.any: list[list[int]] = [[]]
        self.free: list[list[int]] = [[]]
        self.accept = self._add(parts, 0)
        self.closed = [self._closure(s) for s in range(len(self.word))]

    def _state(self) -> int:
        self.word.append({})
        self.any.append([])
        self.free.append([])
        return len(self.word) - 1

    def _add(self, parts: list[Node], at: int) -> int:
        for p in parts:
            if p.kind == "word":
                s = self._state()
                self.word[at].setdefault(p.word, []).append(s)
                at = s
            elif p.kind == "any":
                ends = [at]
                for _ in range(p.most):
                    s = self._state()
                    self.any[at].append(s)
                    at = s
                    ends.append(s)
                for s in ends[:-1]:
                    self.free[s].append(at)
            else:
                s = self._add(p.parts, at)
                self.free[at].append(s)
                at = s
        return at

    def _closure(self, s: int) -> frozenset[int]:
        seen, todo = {s}, [s]
        while todo:
            for t in self.free[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)

    def starts(self) -> set[str] | None:
        """Words that a match can begin with; None if any word can."""
        if any(self.any[s] for s in self.closed[0]):
            return None
        return {w for s in self.closed[0] for w in self.word[s]}

    def accepts(self, words: list[str], at: int = 0) -> bool:
        """Whether a match begins at words[at]."""
        states = self.closed[0]
        if self.accept in states:
            return True
        for w in words[at:]:
            states = frozenset(u for s in states for t in (*self.word[s].get(w, ()), *self.any[s]) for u in self.closed[t])
            if self.accept in states:
                return True
            if not states:
                return False
        return False


def needed(parts: list[Node]) -> list[str]:
    """The mandatory words."""
    return [p.word for p in parts if p.kind == "word"]


def trimmed(parts: list[Node]) -> list[Node]:
    """Without optional or replaceable parts at the ends: those never decide whether a text has a match somewhere."""
    a, b = 0, len(parts)
    while a < b and parts[a].kind != "word":
        a += 1
    while b > a and parts[b - 1].kind != "word":
        b -= 1
    return parts[a:b]


class Scanner:
    """All templates and phrases, with the word hashes that a text must hold for one of them."""

    def __init__(self, templates: list[tuple[str, str]] = TEMPLATES, phrases: dict[str, str] = PHRASES):
        self.phrases = [(W.split(*W.buffer_of(pa.array([p])), "alnum").hash, label) for p, label in phrases.items()]
        self.lengths = {label: len(h) for h, label in self.phrases}
        self.templates = []
        for label, wording in templates:
            parts = trimmed(parse(wording))
            must = W.split(*W.buffer_of(pa.array([" ".join(needed(parts))])), "alnum").hash
            self.templates.append((label, Automaton(parts), must, len(needed(parts))))

    def scan(self, x: W.Words) -> list[tuple]:
        h, n = x.hash, len(x.hash)
        text_of = x.text_of()
        places: list[np.ndarray] = []
        base: dict[int, set[str]] = {}
        own: dict[int, dict[str, int]] = {}
        for phrase, label in self.phrases:
            k = len(phrase)
            ok = np.ones(max(n - k + 1, 0), bool)
            for j in range(k):
                ok &= h[j : j + len(ok)] == phrase[j]
            p = np.flatnonzero(ok)
            p = p[text_of[p] == text_of[p + k - 1]]
            places.append(p)
            for t in np.unique(text_of[p]).tolist():
                base.setdefault(t, set()).add(label)
        for label, automaton, must, weight in self.templates:
            # a match begins with the first mandatory word
            p = np.flatnonzero(h == must[0])
            if len(must) > 1 and len(p):
                # of texts that hold the template's rarest mandatory word at all
                rare = min((np.flatnonzero(h == m) for m in np.unique(must)), key=len)
                p = p[np.isin(text_of[p], text_of[rare])]
            for a in p.tolist():
                t = int(text_of[a])
                if own.get(t, {}).get(label, 0) >= weight:
                    continue
                b = min(int(x.first[t + 1]), a + len(automaton.word))
                if automaton.accepts([x.string(i) for i in range(a, b)]):
                    own.setdefault(t, {})[label] = weight
        at = np.sort(np.concatenate(places))
        cut = np.searchsorted(at, x.first)
        rows = []
        for t in range(len(x.first) - 1):
            lo, hi, f = cut[t], cut[t + 1], int(x.first[t])
            b, o = base.get(t, set()), own.get(t, {})
            e = max([*o.values(), *(self.lengths[x] for x in b)], default=0)
            rows.append((int(x.counts[t]), int(hi - lo), int(at[lo]) - f if hi > lo else None, int(at[hi - 1]) - f if hi > lo else None, ",".join(sorted(b)), ",".join(sorted(b | o.keys())), e / (e + HALF)))
        return rows


def _scan(templates, phrases):
    def scan(batches):
        scanner = Scanner(templates, phrases)
        for batch in batches:
            rows = [r for _, _, x in W.runs(batch.column("text"), "alnum") for r in scanner.scan(x)]
            cols = list(zip(*rows, strict=True)) or [[]] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=names)

    return scan


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """One row per document row. score: e / (e + 4), e being the mandatory words of the longest wording found in the text, a template's or a phrase's; 0 without any."""
    prepare(docs)
    return docs.select("doc_id", "text").mapInArrow(_scan(templates, phrases), _RESULT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


#: The templates once more for SQL, written by hand as patterns over words that each end with a space: (label, pattern).
PATTERNS = [
    ("apache-2.0", "licensed under the apache license (version )?2 0 "),
    ("apache-2.0-notice", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at (http )?(https )?www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license "),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "),
    ("bsd-2-clause", "{bsd}{two}{as_is}"),
    ("bsd-3-clause", "{bsd}{two}([^ ]+ )?neither the name of (the )?([^ ]+ ){{0,8}}nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission {as_is}"),
    ("cc-by", "licensed under (a )?(the )?creative commons attribution (([^ ]+ ){0,3}4 0 )?(international )?license "),
    ("cc-by-4.0", "licensed under cc by 4 0 "),
    ("cc-by-nc", "licensed under cc by nc "),
    ("cc-by-nc-sa", "licensed under cc by nc sa "),
    ("cc-by-sa", "licensed under (a )?(the )?cc by sa "),
    ("cc-by-sa", "licensed under (a )?(the )?creative commons attribution share alike ([^ ]+ ){0,2}(international )?license "),
    ("cc0", "has waived all copyright and related or neighboring rights to this work "),
    ("gpl-2.0", "licensed under the gnu general public license (as published by the free software foundation )?(either )?version 2 "),
    ("gpl-3.0", "licensed under the gnu general public license (as published by the free software foundation )?(either )?version 3 "),
    ("gpl-notice", "is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation (either )?version ([^ ]+ )?of the license (or at your option any later version )?([^ ]+ ){0,6}is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details "),
    ("isc", "permission to use copy modify (and )?(or )?distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies "),
    ("lgpl", "gnu lesser general public license "),
    ("lgpl-notice", "is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation (either )?version ([^ ]+ ){0,2}of the license "),
    ("mit", "under the mit license "),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice (including the next paragraph )?shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall (the )?([^ ]+ ){0,6}be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software "),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0 "),
    ("reserved", "copyright (c )?([^ ]+ ){0,6}all rights reserved "),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means "),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions "),
]
_TWO = "([^ ]+ )?redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer ([^ ]+ )?redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution "
_DISCLAIMER = "this software is provided by (the )?([^ ]+ ){0,8}as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall (the )?([^ ]+ ){0,8}be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage "


def written_out(pattern: str) -> tuple[str, int]:
    """A pattern with its shared parts, and the number of its words outside of groups."""
    if "{bsd}" in pattern:
        pattern = pattern.format(bsd=PATTERNS[2][1], two=_TWO, as_is=_DISCLAIMER)
    bare = re.sub(r"\((?:[^()]|\([^()]*\))*\)(?:\?|\{[^}]*\})?", "", pattern)
    return pattern, len(bare.split())


def oracle() -> str:
    """SQL of the same result: phrases by word windows, templates by the hand-written patterns over the words."""
    found = ", ".join(f"CASE WHEN regexp_matches(s, ' {p}') THEN {{'label': '{label}', 'n': {n}}} END" for label, (p, n) in ((x[0], written_out(x[1])) for x in PATTERNS))
    windows = " UNION ALL ".join(f"SELECT r, i, '{label}' AS label, {len(p.split())} AS n FROM (SELECT r, w, unnest(generate_series(1, len(w) - {len(p.split()) - 1})) AS i FROM t) WHERE array_to_string(w[i : i + {len(p.split()) - 1}], ' ') = '{p}'" for p, label in PHRASES.items())
    return rf"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
p AS ({windows}),
b AS (SELECT r, count(*) AS n, min(i) - 1 AS a, max(i) - 1 AS z, list(DISTINCT label) AS ls, max(n) AS e FROM p GROUP BY r),
m AS (SELECT r, list_filter([{found}], lambda x: x IS NOT NULL) AS os FROM (SELECT r, ' ' || array_to_string(w, ' ') || ' ' AS s FROM t)),
f AS (SELECT r, list_transform(os, lambda x: x.label) AS names, coalesce(list_max(list_transform(os, lambda x: x.n)), 0) AS e FROM m)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(b.n, 0) AS BIGINT) AS n_base, a AS first_word, z AS last_word,
       array_to_string(list_sort(coalesce(ls, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(ls, []), names))), ',') AS labels,
       greatest(f.e, coalesce(b.e, 0))::DOUBLE / (greatest(f.e, coalesce(b.e, 0)) + 4) AS score
FROM t LEFT JOIN b USING (r) JOIN f USING (r)
"""


ORACLE = oracle()
