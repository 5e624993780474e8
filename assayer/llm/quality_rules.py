"""Quality rules: plain counts of words, symbols and repetition, and a labelling of lines as
content or boilerplate by the likeliest path (Viterbi) through a conditional random field.
A document is kept when it passes the counts and enough of its words are content."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.llm import crf
from assayer.llm.labelled import sample_by_label

OUT = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
     ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()),
     ("content_share", pa.float64())]
)
OUT_DDL = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean, content_share double"
)


def repeated_words(words: list[bytes], window: int = 8) -> int:
    """Words within windows of ``window`` words that occur twice or more in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int32, len(words))
    if len(number) == len(words):
        return 0
    views = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(ids, window))
    mixed = np.zeros(n, np.uint64)
    for k in range(window):  # a hash first: windows of equal hash only are compared
        mixed = (mixed ^ views[:, k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    _, which, times = np.unique(mixed, return_inverse=True, return_counts=True)
    twice = np.flatnonzero(times[which] > 1)
    if not len(twice):
        return 0
    _, which, times = np.unique(views[twice], axis=0, return_inverse=True, return_counts=True)
    at = twice[times[which.ravel()] > 1]
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge) > 0).sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    seen: set[bytes] = set()
    dups = 0
    for line in raw.split(b"\n"):
        if line in seen:
            dups += 1
        elif line and not line.isspace():
            seen.add(line)
    spaces = sum(raw.count(c) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
    symbols = len(raw) - len(raw.translate(None, b"#*$%&|<>"))
    return len(words), len(text) - spaces, symbols, dups, repeated_words(words)


def content_shares(texts: list[str | None], model: crf.Model | None) -> np.ndarray:
    """Share of a text's words on lines labelled content; 0 without words."""
    out = np.zeros(len(texts))
    for begin, end in crf.in_parts(texts):
        lines = crf.lines_of([t or "" for t in texts[begin:end]])
        n = end - begin
        if not len(lines.x):
            continue
        good = np.ones(len(lines.x)) if model is None else model.viterbi(lines.text, model.emissions(lines.x), n)
        all_words = np.bincount(lines.text, lines.words, n)
        out[begin:end] = np.bincount(lines.text, lines.words * good, n) / np.maximum(all_words, 1)
    return out


def judge(
    docs: DataFrame,
    labels: DataFrame,
    *,
    min_words: int = 20,
    max_repeat: float = 0.3,
    min_content: float = 0.5,
    each: int = 1500,
    most_chars: int = 20_000,
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): counts, base_failed, kept, content_share.

    The field is fitted on at most ``each`` documents a label, of at most ``most_chars``
    characters: lines of documents of quality 1 are content, of quality 0 boilerplate.
    Without labels of both kinds every line is content.  Null and empty texts have no words
    and fail.  Repeated rows each get a row; other columns are ignored; an empty table gives
    an empty result.
    """
    texts, found = sample_by_label(docs, labels, "quality", each=each, most_chars=most_chars)
    model = crf.train(texts, found)
    percent = round(100 * max_repeat)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = batch.column(1).to_pylist()
            share = content_shares(given, model)
            counts = np.array([base_counts(t or "") for t in given], np.int64).reshape(-1, 5)
            failed = (counts[:, 0] < min_words) | (100 * counts[:, 4] > percent * counts[:, 0])
            columns = [batch.column(0), *(pa.array(counts[:, k]) for k in range(5)), pa.array(failed)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(~failed & (share >= min_content)), pa.array(share)], schema=OUT
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, OUT_DDL)
