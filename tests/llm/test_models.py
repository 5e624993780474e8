"""Chat formatting, line fields and the language network."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np

from assayer.llm import chat, crf, language_id, quality_classifier, quality_rules
from assayer.llm.queries import QUERIES


def test_chat_round_trip():
    random.seed(1)
    bits = ["</s>", "\\", "[INST]", "[/INST]", "x", "[", "<", "\n", "[ROLE ", "]", "{role}", "é"]
    for _ in range(800):
        turns = [
            (random.choice(["user", "assistant", "system", "tool", "a]b", ""]), "".join(random.choices(bits, k=random.randint(0, 6))))
            for _ in range(random.randint(0, 4))
        ]
        formatted = "".join(piece for t in turns for piece, _ in chat.segments(*t))
        assert chat.read_back(formatted) == turns


def test_chat_digests(spark):
    rows = [
        (1, 1, "assistant", "b", 5), (1, 0, "user", "a", 5), (2, 0, "assistant", None, 5), (2, 1, None, "q", 5),
        (3, 0, "user", "u", 5), (3, 0, "user", "u", 5), (None, 0, "user", "n", 5), (4, 0, "user", "</s>" * 9000, 5),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, valid int")
    got = {r.conv_id: r for r in chat.digests(df).collect()}
    expected = {1: [("user", "a"), ("assistant", "b")], 2: [("assistant", ""), ("", "q")], 3: [("user", "u")] * 2,
                None: [("user", "n")], 4: [("user", "</s>" * 9000)]}
    assert set(got) == set(expected)
    for conv, turns in expected.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[conv].n_turns == len(turns) and got[conv].loss_chars == len(loss)
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert [got[c].valid for c in (1, 2, 3)] == [True, False, False]
    parts = chat.format_turns(df).collect()
    assert sum(len(r.text) for r in parts if r.conv_id == 1) == got[1].formatted_chars
    assert chat.digests(df.limit(0)).count() == 0


def _model(seed=2):
    rng = np.random.default_rng(seed)
    x = crf.lines_of(["a b\n\nC!!\nlast line."]).x
    return crf.Model(np.zeros(x.shape[1]), np.ones(x.shape[1]), rng.normal(size=(x.shape[1], 2)), rng.normal(size=(2, 2)))


def test_field_against_all_paths():
    texts = ["one\nTWO!!\nthree | four\nfive", "", "x", "  \n", "a\na\nb\na"]
    lines, model = crf.lines_of(texts), _model()
    assert np.bincount(lines.text, minlength=5).tolist() == [4, 0, 1, 0, 4]
    e = model.emissions(lines.x)
    marginals, _ = model.forward_backward(lines.text, e, 5)
    path = model.viterbi(lines.text, e, 5)
    for k in (0, 2, 4):
        at = np.flatnonzero(lines.text == k)
        ways = list(itertools.product((0, 1), repeat=len(at)))
        score = np.array([
            sum(e[i, v] for i, v in zip(at, w)) + sum(model.move[a, b] for a, b in zip(w, w[1:])) for w in ways
        ])
        p = np.exp(score - score.max())
        p /= p.sum()
        assert np.allclose(marginals[at, 1], np.array(ways).T @ p)
        assert tuple(path[at]) == ways[int(score.argmax())]


def test_lines_are_counted_alike_in_any_company():
    texts = ["one\ntwo three.", "", "\n\n", "x", "ÉÉ |\n"]
    together = crf.lines_of(texts)
    alone = [crf.lines_of([t]).x for t in texts]
    assert np.allclose(together.x, np.concatenate(alone))


def _base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    inside = {j for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for j in range(k, k + 8)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(inside)


def test_base_counts():
    random.seed(4)
    texts = ["", " \n\n", "a\u00a0b\u2003c", "l\n l\nl\n\n", "é# |" * 30, "a b c d e f g h " * 2]
    texts += [" ".join(random.choices("abc", k=random.randint(0, 60))) for _ in range(200)]
    for text in texts:
        assert quality_rules.base_counts(text) == _base(text)


ODD = [(1, None), (1, None), (2, ""), (3, "12 34 ..."), (None, "Thing the other."), (4, "x" * 300_000), (5, "a\n" * 3000)]


def test_odd_rows(spark):
    df = spark.createDataFrame([(k, t, None, 7) for k, t in ODD], "doc_id long, text string, lang string, score int")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    rows = quality_rules.judge(df, labels).collect()
    assert len(rows) == len(ODD) and {r.doc_id: r.n_words for r in rows}[5] == 3000
    assert all(r.base_failed and not r.kept for r in rows if r.doc_id in (1, 2, 3))
    scored = quality_classifier.classify(df, labels).collect()
    assert {(r.doc_id, r.score) for r in scored} == {(1, 0.0), (2, 0.0), (3, 0.5), (None, 0.5), (4, 0.5), (5, 0.5)}
    named = language_id.identify(df)
    assert named.columns == ["doc_id", "held_out", "lang_pred", "score"]
    assert {r.lang_pred for r in named.collect()} == {"und"}
    for empty in (quality_rules.judge(df.limit(0), labels), quality_classifier.classify(df.limit(0), labels), language_id.identify(df.limit(0))):
        assert empty.count() == 0


def test_languages_held_out(spark, data):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "lang").collect()}
    got = QUERIES["op9_language_id"](spark, data).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(lang) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert np.mean([lang[r.doc_id] == r.lang_pred for r in held]) > 0.9


def test_quality_held_out(spark):
    data = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    got = [r for r in QUERIES["op10_quality_classifier"](spark, data).collect() if r.held_out and r.doc_id in labels]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in got)
    assert np.mean([labels[r.doc_id] == r.predicted for r in got]) > 0.9
    kept = [r for r in QUERIES["op8_quality_rules"](spark, data).collect() if not r.base_failed and r.doc_id in labels]
    assert np.mean([labels[r.doc_id] == r.kept for r in kept]) > 0.9
