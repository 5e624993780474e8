"""Bounded samples of labelled documents, to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_fold(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text, modulo ``folds``, is ``fold``; false for null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def sample_by_label(
    docs: DataFrame, labels: DataFrame, label: str, *, each: int, most_chars: int
) -> tuple[list[str], list[int]]:
    """Texts and 0/1 labels of at most ``each`` documents a label, those whose ids hash
    lowest, of texts up to ``most_chars`` characters.  This is a bound on the fit only."""
    texts: list[str] = []
    found: list[int] = []
    for value in (0, 1):
        ids = labels.where(F.col(label) == value).select("doc_id").where("doc_id is not null").distinct()
        ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(each)
        rows = docs.select("doc_id", "text").where(F.length("text").between(1, most_chars)).join(
            F.broadcast(ids), "doc_id"
        ).orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(each).collect()
        texts += [r.text for r in rows]
        found += [value] * len(rows)
    return texts, found
