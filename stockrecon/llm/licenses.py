"""Licence scans: a suffix automaton of licence texts finds what a text shares with them.

All templates, short phrases included, make one generalised suffix automaton over words. A text
streams through it word by word; at each word the automaton knows the longest run of words ending
there that occurs in any template (the matching statistics). Where a run can't be carried on it is
a match; matches of ``LONG`` words or more are chained per template: a chain goes forward in text
and template, with at most ``GAP`` other words between two matches. A chain that covers ``COVERED``
of the words of its template is a span of it. Among spans that overlap in the text the one that
covers most words counts, so of two similar licences the nearer one is named.

Phrases are read off the same walk: a phrase ends at a word if its state lies on the suffix path of
the current one.

No shuffle, and a task holds one text: parts of about 4 MB are read one after the other, with the
state carried on, and only matches are kept.

Defined results: null and empty texts have no words, places or spans, and score 0. The score is the
highest share of a template that a chain covers, 1 if a phrase occurs. Repeated rows are scanned
each. Equal spans go to the earlier start, then to the earlier template. Templates without words are
ignored. Extra columns do not matter.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockrecon.llm.bitmaps import slices
from stockrecon.llm.common import map_batches
from stockrecon.llm.licence_texts import PHRASES, TEMPLATES

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_BREAK = re.compile(rb"[^0-9a-z\x80-\xff]")
#: Words of a match that may be part of a chain, words between two of them, covered share of a template.
LONG, GAP, COVERED = 3, 12, 0.8

Templates = Mapping[str, Iterable[str]]


def words(text: str) -> list[bytes]:
    return _WORD.findall(text.encode().lower())


@dataclass(frozen=True)
class Span:
    """Words ``first`` to ``last`` of a text cover ``covered`` of the ``size`` words of a template."""

    label: str
    template: int
    first: int
    last: int
    covered: int
    size: int


class Automaton:
    """The generalised suffix automaton of some templates and phrases."""

    def __init__(self, templates: Templates, phrases: Templates):
        listed = [(label, words(text)) for label, texts in templates.items() for text in texts]
        self.templates = [(label, found) for label, found in listed if found]
        self.phrases = [(label, found) for label, texts in phrases.items() for found in map(words, texts) if found]
        self._numbers: dict[bytes, int] = {}
        self._next: list[dict[int, int]] = [{}]
        self._link, self._length = [-1], [0]
        for _, found in self.templates + self.phrases:
            last = 0
            for word in found:
                last = self._extend(last, self._numbers.setdefault(word, len(self._numbers)))
        self._ends = self._phrase_ends()
        self._places = self._template_places()

    def _state(self, length: int, follows: dict[int, int], link: int) -> int:
        self._next.append(follows)
        self._length.append(length)
        self._link.append(link)
        return len(self._next) - 1

    def _split(self, origin: int, word: int) -> int:
        """The state of the longest run of ``origin`` carried on by ``word``, set apart if need be."""
        target = self._next[origin][word]
        if self._length[target] == self._length[origin] + 1:
            return target
        clone = self._state(self._length[origin] + 1, dict(self._next[target]), self._link[target])
        self._link[target] = clone
        while origin >= 0 and self._next[origin].get(word) == target:
            self._next[origin][word] = clone
            origin = self._link[origin]
        return clone

    def _extend(self, last: int, word: int) -> int:
        if word in self._next[last]:
            return self._split(last, word)
        state, origin = self._state(self._length[last] + 1, {}, 0), last
        while origin >= 0 and word not in self._next[origin]:
            self._next[origin][word] = state
            origin = self._link[origin]
        if origin >= 0:
            self._link[state] = self._split(origin, word)
        return state

    def _walk(self, found: list[bytes]) -> Iterator[int]:
        state = 0
        for word in found:
            state = self._next[state][self._numbers[word]]
            yield state

    def _by_length(self) -> list[int]:
        return sorted(range(1, len(self._next)), key=self._length.__getitem__)

    def _phrase_ends(self) -> list[tuple[tuple[int, int], ...]]:
        """For each state the phrases on its suffix path, as number and words."""
        own: dict[int, list[tuple[int, int]]] = {}
        for number, (_, found) in enumerate(self.phrases):
            *_, state = self._walk(found)
            own.setdefault(state, []).append((number, len(found)))
        ends: list[tuple[tuple[int, int], ...]] = [()] * len(self._next)
        for state in self._by_length():
            ends[state] = ends[self._link[state]] + tuple(own.get(state, ()))
        return ends

    def _template_places(self) -> list[list[tuple[int, int]]]:
        """For each state that may hold a long match: templates and the words after its last word there."""
        places: list[list[tuple[int, int]]] = [[] for _ in self._next]
        for number, (_, found) in enumerate(self.templates):
            for end, state in enumerate(self._walk(found), 1):
                places[state].append((number, end))
        for state in reversed(self._by_length()):
            if self._length[self._link[state]] >= LONG:
                places[self._link[state]] += places[state]
        return [sorted(set(found)) for found in places]

    def scan(self, text: str) -> tuple[int, list[tuple[int, int]], list[Span], float]:
        """Number of words, places of phrases (phrase, first word), spans, and score of a text."""
        chains = Chains(self.templates)
        follows, link, lengths, ends = self._next, self._link, self._length, self._ends
        numbers, found = self._numbers, []
        state = length = total = 0
        for part in slices(text.encode().lower(), _BREAK):
            tokens = _WORD.findall(part)
            for place, word in enumerate(map(numbers.get, tokens), total):
                if word is None:
                    if length >= LONG:
                        chains.add(place, length, self._places[state])
                    state = length = 0
                    continue
                before, was = state, length
                while state and word not in follows[state]:
                    state = link[state]
                    length = lengths[state]
                if word in follows[state]:
                    state = follows[state][word]
                    length += 1
                if length <= was and was >= LONG:  # the run before this word could not be carried on
                    chains.add(place, was, self._places[before])
                for phrase, size in ends[state]:
                    if size <= length:
                        found.append((phrase, place - size + 1))
            total += len(tokens)
        if length >= LONG:
            chains.add(total, length, self._places[state])
        spans, best = chains.spans()
        return total, found, spans, 1.0 if found else best


class Chains:
    """Chains of matches for each template, built from matches in the order of their last words."""

    def __init__(self, templates: list[tuple[str, list[bytes]]]):
        self._templates = templates
        #: Per template, chains that may be carried on: first and last word, end in the template, words covered.
        self._open: dict[int, list[tuple[int, int, int, int]]] = {}
        self._spans: list[Span] = []
        self._best = 0.0

    def add(self, end: int, length: int, places: list[tuple[int, int]]) -> None:
        """A match of ``length`` words before word ``end`` of the text, and where it lies in the templates."""
        start = end - length
        for template, at in places:
            label, found = self._templates[template]
            chain = (start, end - 1, at, length)
            near = [c for c in self._open.get(template, ()) if start - c[1] - 1 <= GAP]
            for first, last, reached, covered in near:
                # Words that both matches claim, in the text or in the template, count once.
                fresh = length - max(0, last + 1 - start, reached - (at - length))
                if reached < at and last < end - 1 and fresh > 0 and covered + fresh > chain[3]:
                    chain = (first, end - 1, at, covered + fresh)
            self._open[template] = [*near, chain]
            share = chain[3] / len(found)
            self._best = max(self._best, share)
            if share >= COVERED:
                self._spans.append(Span(label, template, chain[0], chain[1], chain[3], len(found)))

    def spans(self) -> tuple[list[Span], float]:
        """Spans that do not overlap, in the order of the text, and the highest share of any chain."""
        starts: list[int] = []
        taken: list[Span] = []
        for span in sorted(self._spans, key=lambda s: (-s.covered, -s.covered / s.size, s.first, s.template)):
            at = bisect_left(starts, span.first)
            before = at and taken[at - 1].last >= span.first
            if not before and (at == len(taken) or taken[at].first > span.last):
                starts.insert(at, span.first)
                taken.insert(at, span)
        return taken, self._best


_PLACE = "struct<label:string,first_word:bigint>"
_SPAN = "struct<label:string,template:int,first_word:bigint,last_word:bigint,covered:bigint,size:bigint>"


def scan(docs: DataFrame, templates: Templates = TEMPLATES, phrases: Templates = PHRASES) -> DataFrame:
    """``doc_id``, ``n_words``, ``places`` of phrases, ``spans`` of templates and ``score``."""
    schema = f"doc_id long, n_words long, places array<{_PLACE}>, spans array<{_SPAN}>, score double"
    place = pa.struct([("label", pa.string()), ("first_word", pa.int64())])
    span = pa.struct(
        [("label", pa.string()), ("template", pa.int32())]
        + [(name, pa.int64()) for name in ("first_word", "last_word", "covered", "size")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(templates, phrases)
        for batch in batches:
            sizes, places, spans, scores = [], [], [], []
            for text in batch.column("text"):
                total, found, covered, score = automaton.scan(text.as_py() or "")
                sizes.append(total)
                places.append([{"label": automaton.phrases[p][0], "first_word": at} for p, at in found])
                spans.append(
                    [
                        {"label": s.label, "template": s.template, "first_word": s.first, "last_word": s.last}
                        | {"covered": s.covered, "size": s.size}
                        for s in covered
                    ]
                )
                scores.append(score)
            columns = [
                batch.column("doc_id"),
                pa.array(sizes, pa.int64()),
                pa.array(places, pa.list_(place)),
                pa.array(spans, pa.list_(span)),
                pa.array(scores, pa.float64()),
            ]
            yield pa.record_batch(columns, names=["doc_id", "n_words", "places", "spans", "score"])

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, schema)


def digests(scanned: DataFrame) -> DataFrame:
    """What ``scan`` found as one flat row per document."""
    starts = F.col("places.first_word")
    base, own = F.col("places.label"), F.col("spans.label")
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, own)), ",").alias("labels"),
        "score",
    )
