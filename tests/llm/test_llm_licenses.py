"""Licence scans against plain search of runs and phrases."""

import random

import pytest

from stockrecon.llm import licenses as L
from stockrecon.llm.licence_texts import PHRASES, TEMPLATES

DOCS = "doc_id long, text string, score string, spans string"


def longest_run(found, end, sources):
    """Words of the longest run that ends before ``end`` and occurs in a source."""
    size = 0
    while size < end and any(
        s[i : i + size + 1] == found[end - size - 1 : end] for s in sources for i in range(len(s) - size)
    ):
        size += 1
    return size


def plain_places(found, phrases):
    return sorted(
        (label, i)
        for label, texts in phrases.items()
        for text in texts
        for i in range(len(found) - len(L.words(text)) + 1)
        if found[i : i + len(L.words(text))] == L.words(text)
    )


class Recorded(L.Chains):
    def __init__(self, templates):
        super().__init__(templates)
        self.matches = []

    def add(self, end, length, places):
        self.matches.append((end, length, [self._templates[t][1][at - length : at] for t, at in places]))
        super().add(end, length, places)


@pytest.mark.parametrize("seed", range(20))
def test_matches_are_those_of_plain_search(seed, monkeypatch):
    rng = random.Random(seed)
    letters = "abc"[: 2 + seed % 2]
    text = lambda n: " ".join(rng.choice(letters) for _ in range(n))
    templates = {"x": [text(rng.randrange(1, 12)) for _ in range(3)], "y": [text(9)]}
    phrases = {"p": [text(2), text(3)], "q": [text(2)]}
    automaton = L.Automaton(templates, phrases)
    whole = f"{text(25)} z {text(20)}"
    found = L.words(whole)
    made = []
    monkeypatch.setattr(L, "Chains", lambda t: made.append(Recorded(t)) or made[-1])
    total, places, _, _ = automaton.scan(whole)
    assert total == len(found)
    assert sorted((automaton.phrases[p][0], at) for p, at in places) == plain_places(found, phrases)
    sources = [L.words(t) for group in (templates, phrases) for texts in group.values() for t in texts]
    runs = [longest_run(found, end, sources) for end in range(len(found) + 1)] + [0]
    expected = [(end, runs[end]) for end in range(1, len(found) + 1) if runs[end] >= L.LONG and runs[end + 1] <= runs[end]]
    assert [(end, length) for end, length, _ in made[0].matches] == expected
    for end, length, parts in made[0].matches:
        assert all(part == found[end - length : end] for part in parts)
        count = sum(s[i : i + length] == found[end - length : end] for t in templates.values() for s in map(L.words, t)
                    for i in range(len(s) - length + 1))
        assert len(parts) == count


def rows(spark, texts, **more):
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], DOCS)
    return [row.asDict() for row in L.digests(L.scan(docs, **more)).sort("doc_id").collect()]


def test_every_template_is_found_whole_and_alone(spark):
    texts = [(label, text) for label, found in TEMPLATES.items() for text in found]
    found = rows(spark, [f"Zeta eta. {text} Theta iota." for _, text in texts])
    for (label, text), row in zip(texts, found):
        assert set(row["labels"].split(",")) - set(PHRASES) == {label}, text
        assert row["score"] == 1.0


def test_covered_spans_bridge_changed_words():
    text = TEMPLATES["mit"][1]
    changed = L.words(text)
    changed[20] = b"qq"
    changed[40:42] = [b"qq", b"ww", b"ee"]
    automaton = L.Automaton(TEMPLATES, PHRASES)
    total, places, spans, score = automaton.scan("lead in " + " ".join(w.decode() for w in changed) + " tail")
    assert [(s.label, s.first, s.last) for s in spans] == [("mit", 2, total - 2)] and not places
    assert spans[0].covered == len(L.words(text)) - 3 and score == spans[0].covered / spans[0].size


def test_parts_of_templates_are_no_labels(spark):
    found = rows(spark, ["licensed under the moon", "released under the old law of the license", "you may not use this file"])
    assert [row["labels"] for row in found] == ["", "", ""] and all(row["score"] < L.COVERED for row in found)


def test_two_licences_in_one_text_and_twice_the_same(spark):
    text = f"{TEMPLATES['mit'][0]}. Or: {TEMPLATES['apache-2.0'][0]}! {TEMPLATES['mit'][0]}"
    scanned = L.scan(spark.createDataFrame([(1, text, "", "")], DOCS)).first()
    assert [s["label"] for s in scanned["spans"]] == ["mit", "apache-2.0", "mit"]


def test_base_columns(spark):
    texts = [
        "All rights\nreserved. CC-BY cc by the GNU General Public License",
        "general public licenses; all_rights_reserved; ccby; éall rights reserved",
        "General public LICENSE general public license",
        None, "", " -- ",
    ]
    found = rows(spark, texts)
    base = [(r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in found]
    assert base == [
        (12, 4, 0, 9, "cc-by,gpl,reserved"),
        (10, 1, 3, 3, "reserved"),
        (6, 2, 0, 3, "gpl"),
        (0, 0, None, None, ""), (0, 0, None, None, ""), (0, 0, None, None, ""),
    ]
    assert [r["score"] for r in found] == [1.0, 1.0, 1.0, 0.0, 0.0, 0.0]


def test_long_text_is_read_in_parts(spark):
    notice = TEMPLATES["gpl-3.0"][0]
    text = f"{notice}. " + "the general matter of law, " * 600_000 + notice
    row = rows(spark, [text])[0]
    size = len(L.words(notice))
    assert row["n_words"] == 2 * size + 3_000_000 and row["n_base"] == 2
    assert (row["first_word"], row["last_word"]) == (7, size + 3_000_000 + 7)
    assert row["labels"] == "gpl,gpl-3.0"


def test_parts_join_within_a_licence(monkeypatch):
    from stockrecon.llm import bitmaps

    automaton = L.Automaton(TEMPLATES, PHRASES)
    text = " ".join(t for found in TEMPLATES.values() for t in found) + " all rights reserved"
    whole = automaton.scan(text)
    monkeypatch.setattr(L, "slices", lambda data, separator: bitmaps.slices(data, separator, 7))
    assert automaton.scan(text) == whole


def test_own_templates_empty_table_and_repeated_rows(spark):
    more = {"templates": {"own": ["one two three four", "--"]}, "phrases": {}}
    found = rows(spark, ["one two three four", "one two three four", "one two"], **more)
    assert [(r["labels"], r["score"]) for r in found] == [("own", 1.0), ("own", 1.0), ("", 0.0)]
    assert rows(spark, []) == []
