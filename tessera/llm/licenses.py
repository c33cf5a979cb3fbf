"""License scans by template-markup matching.

A template is a license's wording with marked regions: optional ones
(``<<beginOptional>> ... <<endOptional>>``) and replaceable ones
(``<<var;match=LOW..HIGH>>``, any LOW to HIGH words). Templates are compiled into
one token automaton over words, whose deterministic states are built as texts
need them; it accepts where all mandatory words match exactly and in order.
Plain phrases are templates without regions.

Defined cases: a null, empty or wordless text has no words and no labels.
Whole texts are read, of any length. Places of a phrase count each, also when
they overlap. Null or repeated ids are kept, each row is scanned by itself.
Extra columns are kept; one that is named like a result column (in any case)
gives way to it. An empty table gives an empty result. A template is the whole
wording, conditions and disclaimer included: an opening alone is not accepted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import renamed, slices

#: The base phrases and their labels.
PHRASES = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]

#: Public license wordings, in template markup.
TEMPLATES = [
    ("licensed under <<beginOptional>>the terms of<<endOptional>> <<beginOptional>>the<<endOptional>> Apache License <<beginOptional>>,<<endOptional>> Version 2.0", "apache-2.0-notice"),
    ("released under <<beginOptional>>the terms of<<endOptional>> the MIT <<beginOptional>>(X11)<<endOptional>> License", "mit-notice"),
    ("licensed under <<beginOptional>>the terms of<<endOptional>> the MIT <<beginOptional>>(X11)<<endOptional>> License", "mit-notice"),
    ("licensed under <<beginOptional>>the terms of<<endOptional>> <<beginOptional>>a<<endOptional>> <<beginOptional>>Creative Commons<<endOptional>> CC BY-NC <<var;match=1..1>>.0", "cc-by-nc-notice"),
    ("Creative Commons Attribution-NonCommercial <<var;match=1..1>>.0 <<beginOptional>>International<<endOptional>> License", "cc-by-nc-notice"),
    ("licensed under <<beginOptional>>the terms of<<endOptional>> the GNU <<beginOptional>>Lesser<<endOptional>> General Public License <<beginOptional>>(GPL)<<endOptional>> version <<var;match=1..1>>", "gpl-notice"),
    (
        "This program is free software <<beginOptional>>:<<endOptional>> you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version <<var;match=1..1>> of the License, or (at your option) any later version",
        "gpl-notice",
    ),
    (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of <<var;match=1..6>> (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, <<beginOptional>>sublicense,<<endOptional>> and/or sell copies of the Software, "
        "and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
        "<<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or substantial portions of the Software. "
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL <<var;match=1..8>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
        "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",
        "mit-text",
    ),
    (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice "
        "and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND <<var;match=1..8>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<var;match=1..8>> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
        "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF "
        "OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE",
        "isc-text",
    ),
    (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "<<beginOptional>>1.<<endOptional>> Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "<<beginOptional>>2.<<endOptional>> Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
        "in the documentation and/or other materials provided with the distribution. "
        "THIS SOFTWARE IS PROVIDED BY <<var;match=1..12>> \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <<var;match=1..12>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
        "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR "
        "BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
        "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE",
        "bsd-2-clause",
    ),
    (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "<<beginOptional>>1.<<endOptional>> Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "<<beginOptional>>2.<<endOptional>> Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
        "in the documentation and/or other materials provided with the distribution. "
        "<<beginOptional>>3.<<endOptional>> Neither the name of <<var;match=1..12>> nor the names of <<beginOptional>>its<<endOptional>> contributors may be used to endorse "
        "or promote products derived from this software without specific prior written permission. "
        "THIS SOFTWARE IS PROVIDED BY <<var;match=1..12>> \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <<var;match=1..12>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
        "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR "
        "BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
        "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE",
        "bsd-3-clause",
    ),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mpl-2.0-notice"),
    (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, "
        "either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, "
        "the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the "
        "public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and "
        "future rights to this software under copyright law. "
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL <<var;match=1..8>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
        "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",
        "unlicense",
    ),
    ("SPDX-License-Identifier: <<var;match=1..6>>", "spdx-tag"),
]

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_MARK = re.compile(r"<<(beginOptional|endOptional|var;match=(\d+)\.\.(\d+))>>")


def words(text: str | None) -> list[bytes]:
    """Runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` once A-Z are lower case, as UTF-8."""
    return _WORD.findall((text or "").encode().lower())


class Automaton:
    """Deterministic token automaton of several templates, built on demand.

    A state is a set of (template, position); ``None`` as a word stands for any
    word that no template names."""

    def __init__(self, templates: list[tuple[str, str]]):
        self.labels = [label for _, label in templates]
        self.moves: list[dict[int, list[tuple[bytes | None, int]]]] = []  # position -> (word or any, next)
        self.skips: list[dict[int, list[int]]] = []  # position -> positions reached without a word
        self.last: list[int] = []
        for markup, label in templates:
            self._compile(markup, label)
        self.named = {w for m in self.moves for edges in m.values() for w, _ in edges if w is not None}
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.next: list[dict[bytes | None, int]] = []
        self.accepts: list[tuple[int, ...]] = []
        self.dead = self._state(frozenset())
        self.start = self._state(self._closure({(t, 0) for t in range(len(templates))}))
        self.firsts = {w for t, p in self.sets[self.start] for w, _ in self.moves[t].get(p, ()) if w is not None}

    def _compile(self, markup: str, label: str) -> None:
        moves: dict[int, list] = {}
        skips: dict[int, list[int]] = {}
        at, begun, place = 0, [], 0
        for mark in [*_MARK.finditer(markup), None]:
            for w in words(markup[place : mark.start() if mark else len(markup)]):
                moves.setdefault(at, []).append((w, at + 1))
                at += 1
            if not mark:
                break
            place = mark.end()
            if mark[1] == "beginOptional":
                begun.append(at)
            elif mark[1] == "endOptional":
                if not begun:
                    raise ValueError(f"unbalanced regions in the template of {label}")
                skips.setdefault(begun.pop(), []).append(at)
            else:
                low, high = int(mark[2]), int(mark[3])
                for k in range(high):
                    moves.setdefault(at, []).append((None, at + 1))
                    if k >= low:
                        skips.setdefault(at, []).append(at + high - k)
                    at += 1
        if begun:
            raise ValueError(f"unbalanced regions in the template of {label}")
        self.moves.append(moves)
        self.skips.append(skips)
        self.last.append(at)
        first = {p for _, p in self._closure({(len(self.last) - 1, 0)})}
        if at in first or any(w is None for p in first for w, _ in moves.get(p, ())):
            raise ValueError(f"the template of {label} must begin with a word")

    def _closure(self, items: set) -> frozenset:
        todo, out = list(items), set(items)
        while todo:
            t, p = todo.pop()
            for q in self.skips[t].get(p, ()):
                if (t, q) not in out:
                    out.add((t, q))
                    todo.append((t, q))
        return frozenset(out)

    def _state(self, items: frozenset) -> int:
        if items not in self.states:
            self.states[items] = len(self.sets)
            self.sets.append(items)
            self.next.append({})
            self.accepts.append(tuple(sorted({t for t, p in items if p == self.last[t]})))
        return self.states[items]

    def step(self, state: int, word: bytes) -> int:
        key = word if word in self.named else None
        found = self.next[state].get(key)
        if found is None:
            moved = {(t, q) for t, p in self.sets[state] for w, q in self.moves[t].get(p, ()) if w is None or w == word}
            found = self.next[state][key] = self._state(self._closure(moved))
        return found

    def scan(self, text_words: list[bytes]) -> list[tuple[int, int, int]]:
        """(template, first word, words) of each acceptance, the longest of a
        template from each first word."""
        out = []
        firsts, n, dead = self.firsts, len(text_words), self.dead
        for k, w in enumerate(text_words):
            if w in firsts:
                state, j, best = self.start, k, {}
                while j < n:
                    state = self.step(state, text_words[j])
                    if state == dead:
                        break
                    j += 1
                    for t in self.accepts[state]:
                        best[t] = j - k
                out += [(t, k, size) for t, size in sorted(best.items())]
        return out


def scan(docs: DataFrame, phrases: list[tuple[str, str]] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with n_words and spans: (label, first, words, base)
    of every phrase and template found, in the order of the text."""
    at = docs.columns.index(text_col)
    plain = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))
    names = [*plain.columns, "n_words", "spans"]
    kind = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("words", pa.int64()), ("base", pa.bool_())]))
    n_base = len(phrases)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton([*phrases, *templates])
        for batch in slices(batches, f"c{at}"):
            counts, spans = [], []
            for text in batch.column(at).to_pylist():
                w = words(text)
                counts.append(len(w))
                spans.append([{"label": automaton.labels[t], "first": k, "words": size, "base": t < n_base} for t, k, size in automaton.scan(w)])
            yield pa.record_batch([*batch.columns, pa.array(counts, pa.int64()), pa.array(spans, kind)], names=names)

    added = T.StructType.fromDDL("n_words long, spans array<struct<label:string,first:long,words:long,base:boolean>>").fields
    return renamed(plain.mapInArrow(run, T.StructType([*plain.schema.fields, *added])), docs.columns, ["n_words", "spans"])


def summary(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and label lists of ``scan``'s spans. The score is 1 where a
    template's whole mandatory wording stands, 0.5 for a base phrase alone, else 0."""
    base = F.filter("spans", lambda s: s["base"])
    starts = F.transform(base, lambda s: s["first"])
    joined = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    return found.select(
        id_col,
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("spans")).alias("labels"),
        F.when(F.exists("spans", lambda s: ~s["base"]), 1.0).when(F.size("spans") > 0, 0.5).otherwise(0.0).alias("score"),
    )


def as_pattern(markup: str) -> str:
    """The regular expression, over space-ended words, that accepts what the template accepts."""
    out, place = [], 0
    for mark in [*_MARK.finditer(markup), None]:
        out += [w.decode() + " " for w in words(markup[place : mark.start() if mark else len(markup)])]
        if mark:
            place = mark.end()
            out.append("(?:" if mark[1] == "beginOptional" else ")?" if mark[1] == "endOptional" else f"(?:[^ ]+ ){{{mark[2]},{mark[3]}}}")
    return "".join(out)
