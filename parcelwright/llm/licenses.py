"""License scans: templates with optional and replaceable regions, matched by token automata."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from parcelwright.llm import textbatch as tb

#: Phrases and the labels they give.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: License wording as templates. (( )) holds an optional region, and may hold others; {{n}} stands for up
#: to n words of any kind; all else is mandatory.
TEMPLATES = {
    "gpl-2.0": "licensed under the gnu general public license (( gpl )) (( as published by the free software foundation )) (( either )) version 2",
    "gpl-3.0": "licensed under the gnu general public license (( gpl )) (( as published by the free software foundation )) (( either )) version 3",
    "gpl-notice": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license "
    "(( as published by the free software foundation )) (( either )) version {{1}} (( of the license )) (( or (( at your option )) any later version ))",
    "apache-2.0": "licensed under the apache license version 2 0",
    "apache-2.0-notice": "licensed under the apache license version 2 0 (( the license )) you may not use this file except in compliance with the license "
    "you may obtain a copy of the license at (( http )) (( https )) www apache org licenses license 2 0 "
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
    "without warranties or conditions of any kind either express or implied "
    "see the license for the specific language governing permissions and limitations under the license",
    "cc-by-4.0": "licensed under (( a )) (( the )) (( creative commons )) cc by 4 0",
    "cc-by-nc-4.0": "licensed under (( a )) (( the )) (( creative commons )) cc by nc 4 0",
    "cc-by-sa-4.0": "licensed under (( a )) (( the )) (( creative commons )) cc by sa 4 0",
    "mit-notice": "released under the (( terms of the )) mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software {{12}} to deal in the software without restriction",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files (( the software )) "
    "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense "
    "and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions "
    "the above copyright notice and this permission notice (( including the next paragraph )) shall be included in all copies or substantial portions of the software "
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability "
    "fitness for a particular purpose and noninfringement in no event shall {{12}} be liable for any claim damages or other liability "
    "whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-2-clause-text": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
    "(( 1 )) redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
    "(( 2 )) redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer "
    "in the documentation and or other materials provided with the distribution "
    "this software is provided by {{12}} as is and any express or implied warranties including but not limited to the implied warranties of merchantability "
    "and fitness for a particular purpose are disclaimed in no event shall {{12}} be liable for any direct indirect incidental special exemplary "
    "or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption "
    "however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise "
    "arising in any way out of the use of this software even if advised of the possibility of such damage",
    "bsd-3-clause-text": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
    "(( 1 )) redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
    "(( 2 )) redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer "
    "in the documentation and or other materials provided with the distribution "
    "(( 3 )) neither the name of {{12}} nor the names of its contributors may be used to endorse or promote products derived from this software "
    "without specific prior written permission "
    "this software is provided by {{12}} as is and any express or implied warranties including but not limited to the implied warranties of merchantability "
    "and fitness for a particular purpose are disclaimed in no event shall {{12}} be liable for any direct indirect incidental special exemplary "
    "or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption "
    "however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise "
    "arising in any way out of the use of this software even if advised of the possibility of such damage",
    "isc": "permission to use copy modify and (( or )) distribute this software for any purpose with or without fee is hereby granted",
    "isc-text": "permission to use copy modify and (( or )) distribute this software for any purpose with or without fee is hereby granted "
    "provided that the above copyright notice and this permission notice appear in all copies "
    "the software is provided as is and {{12}} disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness "
    "in no event shall {{12}} be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits "
    "whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software",
    "zlib-text": "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages "
    "arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications "
    "and to alter it and redistribute it freely subject to the following restrictions "
    "(( 1 )) the origin of this software must not be misrepresented you must not claim that you wrote the original software "
    "if you use this software in a product an acknowledgment in the product documentation would be appreciated but is not required "
    "(( 2 )) altered source versions must be plainly marked as such and must not be misrepresented as being the original software "
    "(( 3 )) this notice may not be removed or altered from any source distribution",
    "mpl-2.0": "subject to the terms of the mozilla public license (( v )) (( version )) 2 0",
    "copyright-notice": "copyright (( c )) {{6}} all rights reserved",
}

#: Sets of states that a scanner remembers before it begins anew.
MOST_SETS = 20_000


@dataclass(frozen=True)
class Automaton:
    """A template's states. steps[s]: (word, next) mandatory moves; wild[s]: next of an any-word move.

    need[s]: mandatory words passed on the way to s. Empty moves are closed over beforehand.
    """

    label: str
    start: frozenset[int]
    steps: tuple[dict[bytes, frozenset[int]], ...]
    wild: tuple[frozenset[int], ...]
    need: tuple[int, ...]
    final: int
    heads: frozenset[bytes]


def compile_template(label: str, markup: str) -> Automaton:
    """Build the automaton of one template, which must not begin with any words or consist of optional ones alone."""
    parts = markup.encode().split()
    moves: list[dict[bytes, set[int]]] = [{}]
    empty: list[set[int]] = [set()]
    wild: list[set[int]] = [set()]
    need = [0]

    def state(n: int) -> int:
        moves.append({})
        empty.append(set())
        wild.append(set())
        need.append(n)
        return len(moves) - 1

    at, opened, mandatory = 0, [], 0
    for part in parts:
        if part == b"((":
            opened.append(at)
        elif part == b"))":
            if not opened:
                raise ValueError(f"template {label} closes a region that it didn't open")
            empty[opened.pop()].add(at)
        elif found := re.fullmatch(rb"\{\{(\d+)\}\}", part):
            entry = at
            hops = [entry]
            for _ in range(int(found[1])):
                after = state(mandatory)
                wild[hops[-1]].add(after)
                hops.append(after)
            at = state(mandatory)
            for hop in hops:
                empty[hop].add(at)
        else:
            mandatory += not opened
            after = state(mandatory)
            moves[at].setdefault(part, set()).add(after)
            at = after

    def closed(states: set[int]) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for s in empty[todo.pop()] - seen:
                seen.add(s)
                todo.append(s)
        return frozenset(seen)

    if opened:
        raise ValueError(f"template {label} leaves a region open")
    start = closed({0})
    steps = tuple({w: closed(to) for w, to in m.items()} for m in moves)
    heads = frozenset(w for s in start for w in steps[s])
    if not parts or any(wild[s] for s in start) or at in start:
        raise ValueError(f"template {label} must begin with a word of its own, and have a mandatory one")
    return Automaton(label, start, steps, tuple(closed(w) if w else frozenset() for w in wild), tuple(need), at, heads)


def _places(text: bytes, phrase: bytes) -> list[int]:
    """All places of phrase in text, overlapping ones included."""
    found, at = [], text.find(phrase)
    while at >= 0:
        found.append(at)
        at = text.find(phrase, at + 1)
    return found


class Scanner:
    """All templates as one automaton over words, whose sets of states are made when they are first met.

    A move then is a look-up, whatever the number of templates; words of no template are one symbol.
    """

    def __init__(self, phrases: dict[str, str], templates: dict[str, str]):
        self.phrases = [(b" " + p.encode() + b" ", label) for p, label in phrases.items()]
        self.automata = [compile_template(k, v) for k, v in templates.items()]
        self.total = [max(a.need) for a in self.automata]
        self.words = frozenset(w for a in self.automata for m in a.steps for w in m)
        self._forget()
        # a run only starts where the first two words of a template can stand; both come from the automata themselves
        seeds: set[bytes] = set()
        for a in self.automata:
            for head in a.heads:
                nexts: set[bytes] | None = set()
                for s in a.start:
                    for t in a.steps[s].get(head, ()):
                        if a.wild[t] or t == a.final:
                            nexts = None
                            break
                        nexts |= set(a.steps[t])
                    if nexts is None:
                        break
                seeds |= {b" " + head + b" "} if nexts is None else {b" " + head + b" " + n + b" " for n in nexts}
        self.seeds = sorted(seeds)

    def _forget(self) -> None:
        self.numbers: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict] = []
        self.ends: list[tuple[int, ...]] = []
        self.share: list[float] = []
        self._number(frozenset((k, s) for k, a in enumerate(self.automata) for s in a.start))

    def _number(self, states: frozenset) -> int:
        if states not in self.numbers:
            self.numbers[states] = len(self.sets)
            self.sets.append(states)
            self.moves.append({})
            self.ends.append(tuple(sorted({k for k, s in states if s == self.automata[k].final})))
            self.share.append(max((self.automata[k].need[s] / self.total[k] for k, s in states), default=0.0))
        return self.numbers[states]

    def _move(self, at: int, word: bytes | None) -> int:
        """Number of the set behind word; the set without states is the end of a run."""
        after = set()
        for k, s in self.sets[at]:
            a = self.automata[k]
            after |= {(k, t) for t in (a.steps[s].get(word, frozenset()) if word is not None else frozenset()) | a.wild[s]}
        to = self.moves[at][word] = self._number(frozenset(after))
        return to

    def run(self, words: list[bytes], i: int) -> tuple[dict[int, int], float]:
        """Ends of the longest accepted stretch from word i by template, and the best share of mandatory words after two words."""
        at, ends, best, first = 0, {}, 0.0, i
        if len(self.sets) > MOST_SETS:
            self._forget()
        while i < len(words):
            word = words[i] if words[i] in self.words else None
            to = self.moves[at].get(word)
            at, i = self._move(at, word) if to is None else to, i + 1
            if not self.sets[at]:
                break
            for k in self.ends[at]:
                ends[k] = i
            if i > first + 1 and self.share[at] > best:
                best = self.share[at]
        return ends, best

    def scan(self, text: bytes) -> tuple:
        """n_words, places, first, last, base labels, labels, score, spans of one whole text."""
        words = text.translate(tb.FOLD_ALNUM).split()
        joined = b" " + b" ".join(words) + b" "
        places, base = [], set()
        for phrase, label in self.phrases:
            if got := _places(joined, phrase):
                places += got
                base.add(label)
        starts = sorted({at for seed in self.seeds for at in _places(joined, seed)})
        labels, best, spans, first, last = set(base), 1.0 if base else 0.0, [], None, None
        if places or starts:
            blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 0x20)
            if places:
                first, last = np.searchsorted(blanks, [min(places), max(places)]).tolist()
            for i in np.searchsorted(blanks, starts).tolist():
                ends, share = self.run(words, i)
                best = max(best, share)
                for k, end in ends.items():
                    labels.add(self.automata[k].label)
                    spans.append((self.automata[k].label, i, end))
        return len(words), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), best, sorted(spans)


SCHEMA = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label:string,start:long,end:long>>"
_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))


def license_scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """docs (doc_id, text) with the license wording of each whole text.

    A narrow scan without shuffle: each row stands alone. Words are runs of letters, digits and code points
    of 128 and above, with A-Z lower-cased. base columns count the phrases; labels also has those of the
    templates that accept a stretch of the text, and spans tells where, with the longest stretch of each template from a
    place. score is the largest share of any template's mandatory words found in order from where its first two words
    stand (1.0 for a phrase or an accepted template). Null and empty texts have no words, empty labels, score 0 and null
    positions. Repeated rows give repeated rows; templates that accept the same place all give their labels. Work is linear
    in the text: each place that can begin a template is followed for the length of the longest template at most. Other columns
    are not read; an empty table gives an empty one.
    """
    scanner = Scanner(phrases, templates)
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in tb.slices(whole):
                raw, at = tb.column_bytes(batch.column("text"))
                got = [scanner.scan(raw[lo:hi].tobytes()) for lo, hi in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array([g[i] if i < 7 else [{"label": a, "start": b, "end": c} for a, b, c in g[i]] for g in got], kind) for i, kind in enumerate(_TYPES))], names=["doc_id", *names])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(rows, f"doc_id {kind}, {SCHEMA}")
