"""License scan against brute force."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from assayer.llm import license_scan
from assayer.llm.license_texts import PHRASES, TEMPLATES
from assayer.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_places(words, phrases=PHRASES):
    return [(label, i) for phrase, label in phrases.items() for i in range(len(words))
            if words[i:i + len(phrase.split())] == phrase.split()]


def brute_statistics(words, templates):
    """Longest run of template words that ends at each word."""
    held = {tuple(t[a:b]) for t in templates for a in range(len(t)) for b in range(a + 1, len(t) + 1)}
    return [max((n for n in range(1, i + 2) if tuple(words[i + 1 - n:i + 1]) in held), default=0) for i in range(len(words))]


def machine_of(templates, phrases):
    as_text = lambda words: " ".join(words)
    return license_scan.automaton({f"t{k}": [as_text(t)] for k, t in enumerate(templates)},
                                  {as_text(p): f"p{k}" for k, p in enumerate(phrases)})


@pytest.mark.parametrize("letters", ["ab", "abcd"])
def test_matching_statistics_and_places(letters):
    rng = random.Random(len(letters))
    for _ in range(150):
        templates = [rng.choices(letters, k=rng.randint(1, 9)) for _ in range(rng.randint(1, 4))]
        phrases = [list(p) for p in {tuple(rng.choices(letters, k=rng.randint(1, 3))) for _ in range(3)}]
        words = rng.choices(letters + "z", k=40)
        machine = machine_of(templates, phrases)
        expected = brute_statistics(words, templates + phrases)
        for size in (3, 1 << 20):
            found = license_scan.stream(" ".join(words).encode(), machine, 1, size)
            assert found.n_words == len(words)
            ends = [i for i, n in enumerate(expected) if n and (i + 1 == len(words) or expected[i + 1] <= expected[i])]
            assert [(a, n) for a, n, _ in found.anchors] == [(i + 1 - expected[i], expected[i]) for i in ends]
            places = sorted((machine.phrases[p][0], at) for p, at in found.places)
            assert places == sorted(brute_places(words, {" ".join(p): f"p{k}" for k, p in enumerate(phrases)}))
        for at, n, state in found.anchors:
            run = words[at:at + n]
            assert sorted(machine.ends(state)) == [
                (t, e) for t, text in enumerate(templates) for e in range(n, len(text) + 1) if text[e - n:e] == run]
        assert len(machine.link) <= 2 * sum(map(len, templates + phrases)) + 1


def test_chains_cover_changed_notices():
    machine = license_scan.automaton(TEMPLATES, PHRASES)
    notice = TEMPLATES["mit"][0]
    words = notice.split()
    changed = " ".join(w for k, w in enumerate(words) if k % 17 != 5) + " tail of something else"
    found = license_scan.stream(("intro words " + changed).encode(), machine)
    label, at, _, covered = max(license_scan.spans(found, machine), key=lambda s: s[3])
    assert machine.names[label] == "mit" and at == 2 and covered > 0.8 * len(words)
    halves = " ".join(words[:10]) + " x" * 500 + " ".join(words[10:20])
    shares = [c / len(machine.templates[t]) for t, _, _, c in license_scan.spans(license_scan.stream(halves.encode(), machine), machine)
              if t == 0]
    assert len(shares) == 2 and max(shares) < 0.3
    swapped = " ".join(words[40:] + words[:40])
    assert max(c for t, _, _, c in license_scan.spans(license_scan.stream(swapped.encode(), machine), machine) if t == 0) < len(words)


def test_odd_rows(spark):
    long = "of the software " * 60_000 + TEMPLATES["bsd"][0]
    rows = [(1, None, 1), (2, "", 1), (3, "--- //", 1), (4, "MIT\nLicense, mit-LICENSE! GENERAL public license", 1),
            (4, "MIT\nLicense, mit-LICENSE! GENERAL public license", 1), (None, "Licensed under CC BY-NC 4.0.", None),
            (6, long, 1), (7, "mit licenses; the général public license", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int").withColumn("Spans", F.lit("x"))
    assert license_scan.scan(df.withColumn("kept", F.lit(2))).columns == ["doc_id", "text", "kept", "n_words", "places", "spans"]
    got = {r.doc_id: r for r in license_scan.report(df).collect()}
    assert [(got[i].n_words, got[i].n_base, got[i].first_word, got[i].labels, got[i].score) for i in (1, 2, 3)] == [(0, 0, None, "", 0.0)] * 3
    assert (got[4].n_base, got[4].first_word, got[4].last_word, got[4].base_labels) == (3, 0, 4, "gpl,mit")
    assert (got[None].base_labels, got[None].labels, got[None].score) == ("", "cc-by-nc", 1.0)
    assert got[6].labels == "bsd" and got[6].n_words == len(words_of(long)) and got[7].n_base == 0
    assert license_scan.report(df).count() == len(rows) and license_scan.report(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        license_scan.scan(df, templates={"x": ["a " * (license_scan.MOST_WORDS + 1)]})


def test_query_equals_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in QUERIES["op13_license_scan"](spark, data).collect()}
    assert len(got) == len(docs)
    for doc_id, text in docs:
        words, r = words_of(text), got[doc_id]
        places = brute_places(words)
        starts = [i for _, i in places]
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == ((min(starts), max(starts)) if places else (None, None))
        assert r.base_labels == ",".join(sorted({label for label, _ in places}))
        own = {"cc-by-nc"} if "licensed under cc by nc 4 0" in " ".join(words) else set()
        assert set(r.labels.split(",")) - {""} == own | {label for label, _ in places}
        assert (r.score >= 0.8) == bool(r.labels)
