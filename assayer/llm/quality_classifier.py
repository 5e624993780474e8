"""Quality of documents from their lines: a conditional random field gives every line a
probability of being good, by forward and backward sums over the whole text; the document's
score is their mean weighted by line length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.llm import crf
from assayer.llm.labelled import in_fold, sample_by_label

OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])


def scores(texts: list[str | None], model: crf.Model | None) -> np.ndarray:
    out = np.zeros(len(texts))
    for begin, end in crf.in_parts(texts):
        lines = crf.lines_of([t or "" for t in texts[begin:end]])
        n = end - begin
        if not len(lines.x):
            continue
        if model is None:
            good = np.full(len(lines.x), 0.5)
        else:
            good = model.forward_backward(lines.text, model.emissions(lines.x), n)[0][:, 1]
        weight = np.bincount(lines.text, lines.bytes, n)
        got = np.bincount(lines.text, lines.bytes * good, n)
        out[begin:end] = np.where(weight > 0, got / np.maximum(weight, 1), 0.0)
    return np.clip(out, 0.0, 1.0)


def classify(
    docs: DataFrame,
    labels: DataFrame,
    *,
    folds: int = 5,
    fold: int = 0,
    threshold: float = 0.3,
    each: int = 1500,
    most_chars: int = 20_000,
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    Fitted on at most ``each`` documents a label outside the held-out fold, of at most
    ``most_chars`` characters; every document is scored over its whole text.  Null texts and
    texts without a word score 0.  Without labels of both kinds every other text scores 0.5.
    Null doc_ids are not held out and not learnt from.  Repeated rows each get a row; other
    columns are ignored; an empty table gives an empty result.
    """
    known = labels.where(~in_fold(F.col("doc_id"), folds, fold))
    texts, found = sample_by_label(docs, known, "quality", each=each, most_chars=most_chars)
    model = crf.train(texts, found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = scores(batch.column(2).to_pylist(), model)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))], schema=OUT
            )

    given = docs.select(F.col("doc_id").cast("long"), in_fold(F.col("doc_id"), folds, fold).alias("held_out"), "text")
    return given.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
