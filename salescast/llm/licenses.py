"""License scans: base phrases, and templates whose markup is compiled to token
automata.

A template is wording with two kinds of markup:

* ``<<beginOptional>> ... <<endOptional>>`` may be left out (and may nest);
* ``<<var;name=...;words=LO-HI>>`` stands for LO to HI words of any wording.

All other words are mandatory: a text is accepted only where they follow each
other exactly.  Case (A-Z), punctuation and white space don't count.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast.llm import text as tx

#: Phrases and their labels: fixed values.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

def _body(label: str) -> str:
    """The marked-up body of a long licence, a file of this package."""
    return resources.files(__package__).joinpath("templates", f"{label}.txt").read_text()


_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: <<beginOptional>>1.<<endOptional>> Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. <<beginOptional>>2.<<endOptional>> Redistributions in binary form
        must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or
        other materials provided with the distribution."""
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY <<var;name=holder;words=1-20>> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
        BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
        SHALL <<var;name=holder;words=1-20>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
        DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
        INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
        NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

#: Label and marked-up wording of the templates: fixed values.  Labels that end
#: in ``-notice`` are lines that name a licence; the others hold the whole
#: mandatory wording of one.
TEMPLATES = {
    "apache-2.0": _body("apache-2.0"),
    "apache-2.0-notice": """<<beginOptional>>Copyright <<var;name=copyright;words=0-20>><<endOptional>> Licensed under the Apache License, Version 2.0
        <<beginOptional>>(the "License"); you may not use this file except in compliance with the License.
        You may obtain a copy of the License at <<var;name=url;words=1-8>>
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
        "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
        language governing permissions and limitations under the License.<<endOptional>>""",
    "gpl-2.0": _body("gpl-2.0"),
    "gpl-2.0-notice": """<<var;name=what;words=1-4>> licensed under the <<beginOptional>>terms of the<<endOptional>> GNU General Public License
        <<beginOptional>>(GPL)<<endOptional>> version 2 <<beginOptional>>only<<endOptional>>""",
    "gpl-3.0": _body("gpl-3.0"),
    "gpl-3.0-notice": """<<var;name=what;words=1-4>> licensed under the <<beginOptional>>terms of the<<endOptional>> GNU General Public License
        <<beginOptional>>(GPL)<<endOptional>> version 3 <<beginOptional>>or any later version<<endOptional>>""",
    "gpl-notice": """<<var;name=program;words=1-6>> is free software <<beginOptional>>you can<<endOptional>> redistribute it and/or modify it
        under the terms of the GNU General Public License as published by the Free Software Foundation""",
    "mit": """<<beginOptional>>Copyright <<var;name=copyright;words=0-20>><<endOptional>> Permission is hereby granted, free of charge, to any person
        obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without
        restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be
        included in all copies or substantial portions of the Software.
        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES
        OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL <<var;name=holder;words=1-20>> BE
        LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR
        IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "mit-notice": "<<var;name=verb;words=1-1>> under the <<beginOptional>>terms of the<<endOptional>> MIT License",
    "isc": """Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any purpose with or without fee
        is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
        THE SOFTWARE IS PROVIDED "AS IS" AND <<var;name=holder;words=1-20>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
        INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<var;name=holder;words=1-20>> BE LIABLE FOR
        ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
        WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
        PERFORMANCE OF THIS SOFTWARE.""",
    "bsd-2-clause": f"{_BSD} {_BSD_DISCLAIMER}",
    "bsd-3-clause": f"""{_BSD} <<beginOptional>>3.<<endOptional>> Neither the name of <<var;name=holder;words=1-30>> may be used to endorse or
        promote products derived from this software without specific prior written permission. {_BSD_DISCLAIMER}""",
    "cc-by-4.0-notice": "Licensed under <<beginOptional>>a Creative Commons<<endOptional>> CC BY 4.0",
    "cc-by-sa-4.0-notice": "Licensed under <<beginOptional>>a Creative Commons<<endOptional>> CC BY-SA 4.0",
    "cc-by-nc-4.0-notice": "Licensed under <<beginOptional>>a Creative Commons<<endOptional>> CC BY-NC 4.0",
    "cc-by-nd-4.0-notice": "Licensed under <<beginOptional>>a Creative Commons<<endOptional>> CC BY-ND 4.0",
}
NOTICE = "-notice"

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
MARK = re.compile(r"<<(.*?)>>")
#: Scores of a document without an accepted licence text: with an accepted
#: notice, and with a base phrase only.
NOTICE_SCORE, BASE_SCORE = 0.75, 0.5


def word_list(text: str) -> list[str]:
    lowered = text.encode().translate(bytes(tx.LOWER))
    return [w.decode() for w in WORD.findall(lowered)]


@dataclass
class Automaton:
    """``step[s]``: word -> next state; ``anyword[s]``: next state on any word;
    ``free[s]``: states reached without a word.  Accepts in ``accept``."""
    step: list = field(default_factory=list)
    anyword: list = field(default_factory=list)
    free: list = field(default_factory=list)
    accept: int = -1

    def state(self) -> int:
        self.step.append({}), self.anyword.append(None), self.free.append([])
        return len(self.step) - 1

    def closed(self, states) -> set[int]:
        todo, seen = list(states), set()
        while todo:
            s = todo.pop()
            if s not in seen:
                seen.add(s)
                todo += self.free[s]
        return seen

    def match(self, words: list[bytes], at: int) -> int:
        """End of the longest match that starts at word ``at``, or -1."""
        now, end, i = self.start, -1, at
        while now:
            if self.accept in now:
                end = i
            if i >= len(words):
                break
            w = words[i]
            now = self.closed({t for s in now for t in (self.step[s].get(w), self.anyword[s]) if t is not None})
            i += 1
        return end


def compiled(template: str) -> Automaton:
    auto = Automaton()
    here = auto.state()
    opened = []
    begin = here
    for k, part in enumerate(MARK.split(template)):
        if k % 2 == 0:
            for w in word_list(part):
                nxt = auto.state()
                auto.step[here][w.encode()] = nxt
                here = nxt
        elif part == "beginOptional":
            opened.append(here)
            nxt = auto.state()
            auto.free[here].append(nxt)
            here = nxt
        elif part == "endOptional":
            nxt = auto.state()
            auto.free[here].append(nxt)
            auto.free[opened.pop()].append(nxt)
            here = nxt
        else:
            least, most = map(int, dict(x.split("=") for x in part.split(";")[1:])["words"].split("-"))
            stop = auto.state()
            for i in range(most + 1):
                if i >= least:
                    auto.free[here].append(stop)
                if i < most:
                    nxt = auto.state()
                    auto.anyword[here] = nxt
                    here = nxt
            here = stop
    if opened:
        raise ValueError("beginOptional without endOptional")
    auto.accept = here
    auto.start = auto.closed({begin})
    return auto


def mandatory(template: str) -> list[str]:
    """The words outside optional and replaceable regions."""
    depth, out = 0, []
    for k, part in enumerate(MARK.split(template)):
        if k % 2:
            depth += (part == "beginOptional") - (part == "endOptional")
        elif not depth:
            out += word_list(part)
    return out


class Scanner:
    def __init__(self, phrases: dict[str, str], templates: dict[str, str]):
        gap, word = rb"[^0-9a-z\x80-\xff]+", rb"[0-9a-z\x80-\xff]"
        self.phrases = [(re.compile(b"(?<!" + word + b")" + gap.join(re.escape(w.encode()) for w in word_list(p)) + b"(?!" + word + b")"),
                         word_list(p)[0].encode(), label) for p, label in phrases.items()]
        self.templates = []
        for label, t in templates.items():
            needed = [w.encode() for w in dict.fromkeys(mandatory(t))]
            needed.sort(key=len, reverse=True)
            # a match begins at most `lead` words before its first mandatory word
            first = mandatory(t)[0].encode()
            lead = self._lead(t)
            self.templates.append((label, compiled(t), needed, first, lead))

    @staticmethod
    def _lead(template: str) -> int:
        lead = depth = 0
        for k, part in enumerate(MARK.split(template)):
            if k % 2 == 0:
                if word_list(part) and not depth:
                    return lead
                lead += len(word_list(part))
            elif part.startswith("var"):
                lead += int(part.rsplit("-", 1)[1])
            else:
                depth += (part == "beginOptional") - (part == "endOptional")
        raise ValueError("a template has a mandatory word")

    def scan(self, lowered: bytes):
        """(base label, byte offset) places, and (label, first word, end word)
        of accepted templates."""
        base = [(label, m.start()) for pattern, lead, label in self.phrases if lead in lowered for m in pattern.finditer(lowered)]
        spans, words, places = [], None, {}
        for label, auto, needed, first, lead in self.templates:
            if not all(w in lowered for w in needed):
                continue
            if words is None:
                words = WORD.findall(lowered)
                for i, w in enumerate(words):
                    places.setdefault(w, []).append(i)
            done = -1
            for i in places.get(first, ()):
                for at in range(max(done, i - lead, 0), i + 1):
                    end = auto.match(words, at)
                    if end > i:
                        spans.append((label, at, end))
                        done = end
                        break
        return base, spans


SPAN = ("label", "start", "end")
KIND = tx.struct_type(
    n_words=T.LongType(), n_base=T.LongType(), first_word=T.LongType(), last_word=T.LongType(), base_labels=T.ArrayType(T.StringType()),
    labels=T.ArrayType(T.StringType()), score=T.DoubleType(),
    spans=T.ArrayType(tx.struct_type(label=T.StringType(), start=T.LongType(), end=T.LongType())))


def find(docs: DataFrame, text: str = "text", phrases: dict[str, str] | None = None,
         templates: dict[str, str] | None = None) -> tuple[DataFrame, str]:
    """``docs`` with a struct column: n_words; the base places (number, least
    and largest first word, labels); all labels; the accepted templates' word
    spans; and a score, which is 1 if a licence's whole wording is accepted,
    NOTICE_SCORE if only a notice is, BASE_SCORE if there is only a base place,
    and 0 otherwise.

    A null or empty text has no words and no places.  Repeated rows are scanned
    one by one; columns pass through whatever their names; nothing is shuffled.
    """
    phrases, templates = PHRASES if phrases is None else phrases, TEMPLATES if templates is None else templates

    def make():
        scanner = Scanner(phrases, templates)

        def work(piece, at):
            seen = tx.Words(piece.column(at))
            raw = seen.bytes.tobytes()
            rows = []
            for d in range(piece.num_rows):
                a, z = int(seen.offsets[d]), int(seen.offsets[d + 1])
                base, spans = scanner.scan(raw[a:z])
                starts = np.searchsorted(seen.start, [a + p for _, p in base]) - seen.first[d] if base else []
                own = sorted({label for label, _ in base})
                every = sorted({*own, *(label for label, _, _ in spans)})
                rows.append((len(base), int(min(starts)) if base else None, int(max(starts)) if base else None, own, every,
                             1.0 if any(not label.endswith(NOTICE) for label, _, _ in spans) else NOTICE_SCORE if spans else BASE_SCORE if base else 0.0, [dict(zip(SPAN, s)) for s in sorted(spans, key=lambda s: s[1:])]))
            cols = list(zip(*rows)) or [()] * 7
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.float64(),
                     pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))]
            return [pa.array(seen.counts(), pa.int64()), *[pa.array(c, k) for c, k in zip(cols, kinds)]]
        return work

    return tx.annotate(docs, text, KIND, make, "_license")


def digest(found: DataFrame, name: str, doc_id: str = "doc_id") -> DataFrame:
    f = F.col(name)
    return found.select(F.col(doc_id), *[f[c].alias(c) for c in ("n_words", "n_base", "first_word", "last_word")],
                        F.array_join(f["base_labels"], ",").alias("base_labels"), F.array_join(f["labels"], ",").alias("labels"),
                        f["score"].alias("score"))
