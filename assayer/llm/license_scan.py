"""License scan: matching statistics against a generalised suffix automaton of templates.

The automaton accepts every run of words of every template.  A text is streamed through it:
after each word the state stands for the longest run of template words that ends there.
Phrases are templates whose states are marked, marks being inherited along suffix links, so
every place of a phrase shows in the state.  Matches that the next word does not extend are
anchors; anchors that follow one another in text and template alike are chained to spans,
and a template is found where a chain covers enough of its words.

The automaton is built once on the driver from the templates, whose size is bounded, and
travels with the task.  Texts are read whole, a piece at a time; nothing is shuffled.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.llm.license_texts import PHRASES, TEMPLATES

#: Words of lower-cased bytes: digits, small letters and all beyond ASCII.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Words of all templates together; the automaton holds at most two states a word.
MOST_WORDS = 200_000
#: Words of an anchor, words between two anchors of a chain, share of a template.
LEAST, GAP, SHARE = 3, 12, 0.8
PIECE = 1 << 20


def words_of(text: bytes) -> list[bytes]:
    return WORD.findall(text.lower())


def pieces(text: bytes, size: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text, in lists of bounded length; no word is cut."""
    begin = 0
    while begin < len(text):
        end = begin + size
        if end < len(text):
            while end < len(text) and WORD.match(text[end - 1:end].lower()):
                end += 1
        yield words_of(text[begin:end])
        begin = end


@dataclass
class Automaton:
    """States as flat lists: ``longest`` run, suffix ``link``, transitions ``step`` by word
    number, and ``marks``: the (phrase, its length) that may end in the state."""

    templates: list[list[bytes]]
    names: list[str]
    phrases: list[tuple[str, list[bytes]]]
    vocabulary: dict[bytes, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        texts = self.templates + [w for _, w in self.phrases]
        if sum(map(len, texts)) > MOST_WORDS:
            raise ValueError(f"the templates hold more than {MOST_WORDS} words")
        self.longest, self.link, self.step = [0], [-1], [{}]
        self.prefixes: list[tuple[int, int, int]] = []  # state, template, words read
        phrase_state = []
        for k, text in enumerate(texts):
            last = 0
            for n, w in enumerate(text, 1):
                last = self._extend(last, self.vocabulary.setdefault(w, len(self.vocabulary)))
                if k < len(self.templates):
                    self.prefixes.append((last, k, n))
            phrase_state.append(last)
        self._order()
        self.marks: list[tuple[tuple[int, int], ...]] = [()] * len(self.link)
        own = {}
        for p, (_, words) in enumerate(self.phrases):
            # A phrase that ends a longer template may be the shorter run of its state.
            own.setdefault(self._state_of(words), []).append((p, len(words)))
        for v in sorted(range(1, len(self.link)), key=self.longest.__getitem__):
            self.marks[v] = (*self.marks[self.link[v]], *own.get(v, ()))

    def _extend(self, last: int, word: int) -> int:
        """The state of the run read so far and ``word``, added where it is not there."""
        if word in self.step[last]:
            q = self.step[last][word]
            return q if self.longest[q] == self.longest[last] + 1 else self._split(last, q, word)
        new = self._state(self.longest[last] + 1, 0, {})
        p = last
        while p >= 0 and word not in self.step[p]:
            self.step[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.step[p][word]
            self.link[new] = q if self.longest[q] == self.longest[p] + 1 else self._split(p, q, word)
        return new

    def _split(self, p: int, q: int, word: int) -> int:
        """A state for the shorter runs of ``q``, which ``p`` reaches."""
        twin = self._state(self.longest[p] + 1, self.link[q], dict(self.step[q]))
        self.link[q] = twin
        while p >= 0 and self.step[p].get(word) == q:
            self.step[p][word] = twin
            p = self.link[p]
        return twin

    def _state(self, longest: int, link: int, step: dict[int, int]) -> int:
        self.longest.append(longest)
        self.link.append(link)
        self.step.append(step)
        return len(self.link) - 1

    def _state_of(self, words: list[bytes]) -> int:
        state = 0
        for w in words:
            state = self.step[state][self.vocabulary[w]]
        return state

    def _order(self) -> None:
        """Numbers the tree of suffix links, so that a state's places in the templates are
        one slice of the places of prefixes."""
        below: list[list[int]] = [[] for _ in self.link]
        for v in range(1, len(self.link)):
            below[self.link[v]].append(v)
        self.enter, self.leave, todo, n = [0] * len(self.link), [0] * len(self.link), [(0, False)], 0
        while todo:
            v, done = todo.pop()
            if done:
                self.leave[v] = n
                continue
            self.enter[v], n = n, n + 1
            todo.append((v, True))
            todo += [(u, False) for u in below[v]]
        self.prefixes.sort(key=lambda x: self.enter[x[0]])
        self._at = [self.enter[v] for v, _, _ in self.prefixes]

    def ends(self, state: int) -> list[tuple[int, int]]:
        """(template, words read) wherever a run of this state ends in a template."""
        a, b = bisect_left(self._at, self.enter[state]), bisect_left(self._at, self.leave[state])
        return [(t, n) for _, t, n in self.prefixes[a:b]]


@dataclass
class Found:
    """What a text holds: its words, places of phrases (phrase, word), anchors (word, length, state)."""

    n_words: int = 0
    places: list[tuple[int, int]] = field(default_factory=list)
    anchors: list[tuple[int, int, int]] = field(default_factory=list)


def stream(text: bytes, machine: Automaton, least: int = LEAST, size: int = PIECE) -> Found:
    """The matching statistics of a text, walked word by word."""
    out, state, length = Found(), 0, 0
    step, link, longest, marks = machine.step, machine.link, machine.longest, machine.marks
    for words in pieces(text, size):
        for i, w in enumerate(map(machine.vocabulary.get, words), out.n_words):
            if w is None:
                if length >= least:
                    out.anchors.append((i - length, length, state))
                state = length = 0
                continue
            there = step[state].get(w)
            if there is None:
                if length >= least:
                    out.anchors.append((i - length, length, state))
                while there is None:  # the root knows every word of the vocabulary
                    state = link[state]
                    there = step[state].get(w)
                length = longest[state]
            state, length = there, length + 1
            for phrase, n in marks[state]:
                if n <= length:
                    out.places.append((phrase, i - n + 1))
        out.n_words += len(words)
    if length >= least:
        out.anchors.append((out.n_words - length, length, state))
    return out


def spans(found: Found, machine: Automaton, gap: int = GAP) -> list[tuple[int, int, int, int]]:
    """Chains of anchors as (template, first word, words from first to last, words covered).

    A chain goes on where the next anchor lies behind in text and template, with at most
    ``gap`` words between on either side; it counts the template's words it covers once.  An
    anchor belongs to one chain of a template; the chains that cover most are taken first.
    """
    by_template: dict[int, list[tuple[int, int, int]]] = {}
    for at, length, state in found.anchors:
        for t, n in machine.ends(state):
            by_template.setdefault(t, []).append((at, n - length, length))
    out = []
    for t, anchors in by_template.items():
        anchors.sort()
        covered, before, first = [], [], 0
        for k, (at, place, length) in enumerate(anchors):
            best, behind = length, -1
            while anchors[first][0] + len(machine.templates[t]) + gap < at:
                first += 1
            for j in range(first, k):
                a, p, n = anchors[j]
                skip = max(a + n - at, p + n - place, 0)  # words told twice
                apart = max(at - a - n, place - p - n)
                if a < at and p < place and skip < length and apart <= gap and covered[j] + length - skip > best:
                    best, behind = covered[j] + length - skip, j
            covered.append(best)
            before.append(behind)
        used = [False] * len(anchors)
        for k in sorted(range(len(anchors)), key=lambda k: (-covered[k], anchors[k])):
            chain = []
            while k >= 0 and not used[k]:
                chain.append(k)
                k = before[k]
            if k >= 0 or not chain:
                continue  # a better chain holds its beginning
            for j in chain:
                used[j] = True
            last, begin = anchors[chain[0]], anchors[chain[-1]][0]
            out.append((t, begin, last[0] + last[2] - begin, covered[chain[0]]))
    return sorted(out, key=lambda s: (s[1], s[0]))


def automaton(templates: dict[str, list[str]], phrases: dict[str, str]) -> Automaton:
    """The automaton of templates by label, and of phrases with their labels."""
    named = [(label, words_of(t.encode())) for label, texts in templates.items() for t in texts]
    return Automaton([w for _, w in named], [n for n, _ in named], [(label, words_of(p.encode())) for p, label in phrases.items()])


PLACE = pa.struct([("label", pa.string()), ("start", pa.int64())])
SPAN = pa.struct([("label", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("share", pa.float64())])
ADDED = {
    "n_words": "0L", "places": "array(named_struct('label', '', 'start', 0L))",
    "spans": "array(named_struct('label', '', 'start', 0L, 'length', 0L, 'share', 0D))",
}


def scan(
    docs: DataFrame, text: str = "text", templates: dict[str, list[str]] | None = None,
    phrases: dict[str, str] | None = None, *, least: int = LEAST, gap: int = GAP,
) -> DataFrame:
    """``docs`` with ``n_words``, ``places`` of phrases (label, start) and ``spans`` of
    templates (label, start, length, share: covered part of the template), in words.

    Null and empty texts have no words.  A word is found in any case of A to Z.  Rows are
    judged one by one, so repeated rows give equal results, an empty table an empty one;
    long texts are streamed whole.  Of overlapping places each counts; spans of one template
    do not share anchors; ties go to the chain that begins first.  Other columns stay;
    columns of the three names are replaced.
    """
    machine = automaton(TEMPLATES if templates is None else templates, PHRASES if phrases is None else phrases)
    kept = [c for c in docs.columns if c.lower() not in ADDED]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *own, texts = batch.columns
            n_words, places, chains = [], [], []
            for t in texts.to_pylist():
                found = stream(t or b"", machine, least)
                n_words.append(found.n_words)
                places.append([{"label": machine.phrases[p][0], "start": at} for p, at in found.places])
                chains.append([
                    {"label": machine.names[k], "start": at, "length": n, "share": covered / len(machine.templates[k])}
                    for k, at, n, covered in spans(found, machine, gap)
                ])
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(n_words, pa.int64()), pa.array(places, pa.list_(PLACE)), pa.array(chains, pa.list_(SPAN))],
                names=[*kept, *ADDED],
            )

    own = docs.select(*[F.col(f"`{c}`") for c in kept])
    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(text).cast("string").cast("binary").alias("__text"))
    return source.mapInArrow(run, own.selectExpr("*", *[f"{e} as {c}" for c, e in ADDED.items()]).schema)


def report(docs: DataFrame, share: float = SHARE) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): words, places of phrases, first and last of them,
    their labels, the labels with those of templates covered to ``share`` at least, and a
    score: 1 where a phrase stands, else the greatest covered share of a template."""
    labels = "array_join(array_sort(array_distinct({})), ',')"
    base = "transform(places, p -> p.label)"
    own = f"transform(filter(spans, s -> s.share >= {share}D), s -> s.label)"
    return scan(docs.select("doc_id", "text")).selectExpr(
        "doc_id", "n_words", "cast(size(places) as bigint) as n_base",
        "array_min(transform(places, p -> p.start)) as first_word", "array_max(transform(places, p -> p.start)) as last_word",
        f"{labels.format(base)} as base_labels", f"{labels.format(f'concat({base}, {own})')} as labels",
        "if(size(places) > 0, 1D, coalesce(array_max(transform(spans, s -> s.share)), 0D)) as score",
    )
