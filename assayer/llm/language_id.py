"""Language of texts by a byte convolutional network in numpy.

Bytes are embedded, filters of several widths slide over fixed-length windows, each
filter's largest response over the window is kept, and a softmax layer reads them.  The
network is trained on windows of a bounded sample of labelled texts; a text's language is
read from all of its windows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.llm.labelled import in_fold

WIDTHS, FILTERS, SIZE, WINDOW = (2, 3, 4), 16, 8, 256
WIDEST = max(WIDTHS)
UNKNOWN = "und"


def windows_of(raw: bytes, length: int = WINDOW) -> np.ndarray:
    """The text cut into windows of ``length`` bytes, the last one filled up with zeros;
    each is followed by WIDEST - 1 zeros for the filters."""
    n = max(1, -(-len(raw) // length))
    out = np.zeros((n, length + WIDEST - 1), np.uint8)
    flat = np.zeros(n * length, np.uint8)
    flat[: len(raw)] = np.frombuffer(raw, np.uint8)
    out[:, :length] = flat.reshape(n, length)
    return out


@dataclass
class Network:
    names: list[str]
    embed: np.ndarray  # 256 x SIZE, row 0 stays zero
    kernel: np.ndarray  # (WIDEST * SIZE) x all filters; a narrow filter's later rows are zero
    bias: np.ndarray
    top: np.ndarray
    top_bias: np.ndarray

    def look(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Embedded slices (windows x places x WIDEST * SIZE) and filter responses."""
        at = self.embed[windows]
        places = windows.shape[1] - WIDEST + 1
        slices = np.concatenate([at[:, k : k + places] for k in range(WIDEST)], axis=2)
        return slices, slices @ self.kernel

    def pooled(self, windows: np.ndarray) -> np.ndarray:
        return np.maximum(self.look(windows)[1].max(1) + self.bias, 0)

    def probabilities(self, windows: np.ndarray, part: int = 256) -> np.ndarray:
        out = np.zeros((len(windows), len(self.names)), np.float32)
        for k in range(0, len(windows), part):
            z = self.pooled(windows[k : k + part]) @ self.top + self.top_bias
            z = np.exp(z - z.max(1, keepdims=True))
            out[k : k + part] = z / z.sum(1, keepdims=True)
        return out


def train(raws: Sequence[bytes], labels: Sequence[str], *, rounds: int = 5, steps: int = 200, batch: int = 64, seed: int = 3) -> Network | None:
    """Adam on the cross entropy, classes weighted alike, for ``rounds`` passes and ``steps``
    steps at least.  None without labels."""
    names = sorted(set(labels))
    if not names:
        return None
    rng = np.random.default_rng(seed)
    x = np.concatenate([windows_of(r)[:1] for r in raws])
    y = np.array([names.index(v) for v in labels])
    count = 3 * FILTERS
    mask = np.zeros((WIDEST * SIZE, count), np.float32)
    for i, w in enumerate(WIDTHS):
        mask[: w * SIZE, i * FILTERS : (i + 1) * FILTERS] = 1
    net = Network(
        names, rng.normal(0, 0.5, (256, SIZE)).astype(np.float32),
        (rng.normal(0, 0.3, mask.shape) * mask).astype(np.float32), np.zeros(count, np.float32),
        rng.normal(0, 0.1, (count, len(names))).astype(np.float32), np.zeros(len(names), np.float32),
    )
    net.embed[0] = 0
    weight = (len(y) / (len(names) * np.bincount(y, minlength=len(names)))).astype(np.float32)
    params = [net.embed, net.kernel, net.bias, net.top, net.top_bias]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step = 0
    for _ in range(max(rounds, -(-steps // -(-len(y) // batch)))):
        order = rng.permutation(len(y))
        for k in range(0, len(order), batch):
            pick = order[k : k + batch]
            slices, seen = net.look(x[pick])
            best = seen.argmax(1)
            rows = np.arange(len(pick))[:, None]
            high = np.take_along_axis(seen, best[:, None, :], 1)[:, 0] + net.bias
            pool = np.maximum(high, 0)
            z = pool @ net.top + net.top_bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(pick)), y[pick]] -= 1
            p *= weight[y[pick]][:, None] / len(pick)
            d_pool = (p @ net.top.T) * (high > 0)
            won = slices[rows, best]  # windows x filters x slice
            d_kernel = np.einsum("bfs,bf->sf", won, d_pool) * mask
            d_won = (d_pool[:, :, None] * net.kernel.T[None]).reshape(len(pick), count, WIDEST, SIZE)
            d_embed = np.zeros_like(net.embed)
            for j in range(WIDEST):
                np.add.at(d_embed, x[pick][rows, best + j], d_won[:, :, j])
            d_embed[0] = 0
            step += 1
            for q, g, (m, v) in zip(params, (d_embed, d_kernel, d_pool.sum(0), pool.T @ p, p.sum(0)), moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                q -= (0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return net


def languages(texts: Sequence[str | None], net: Network | None, part: int = 2048) -> tuple[list[str], np.ndarray]:
    """Language and score of each text: the class of the highest mean probability over its
    windows, each weighted by its bytes, and that mean."""
    names = [UNKNOWN] * len(texts)
    score = np.zeros(len(texts))
    if net is None:
        return names, score
    sums = np.zeros((len(texts), len(net.names)))
    waiting: list[np.ndarray] = []
    owners: list[np.ndarray] = []

    def flush() -> None:
        if waiting:
            windows, own = np.concatenate(waiting), np.concatenate(owners)
            got = net.probabilities(windows) * (windows > 0).sum(1)[:, None]
            np.add.at(sums, own, got)
            waiting.clear()
            owners.clear()

    have = 0
    known = []
    for i, text in enumerate(texts):
        if text is None or not any(map(str.isalpha, text)):
            continue
        known.append(i)
        windows = windows_of(text.encode("utf-8", "replace"))
        waiting.append(windows)
        owners.append(np.full(len(windows), i))
        have += len(windows)
        if have >= part:
            flush()
            have = 0
    flush()
    for i in known:
        best = int(sums[i].argmax())
        names[i], score[i] = net.names[best], min(1.0, sums[i, best] / max(sums[i].sum(), 1e-9))
    return names, score


def fit(docs: DataFrame, *, folds: int = 4, fold: int = 2, most: int = 4000) -> Network | None:
    """Fits on one window of each of at most ``most`` documents with a language and a
    letter, outside the held-out fold; those whose ids hash lowest, and the window that the
    hash names.  The bound is on the fit only."""
    places = F.greatest(F.length("text") - F.lit(WINDOW), F.lit(0)) + 1
    at = (F.pmod(F.xxhash64("doc_id", F.lit(1)), places) + 1).cast("int")
    known = docs.where(~in_fold(F.col("doc_id"), folds, fold) & F.col("doc_id").isNotNull() & F.col("lang").isNotNull())
    share = min(1.0, 4 * most / max(known.count(), 1))  # the rest is far from the lowest hashes
    low = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    rows = (
        known.where(low < int(share * (1 << 20)))
        .select(low.alias("h"), "doc_id", "lang", F.col("text").substr(at, F.lit(WINDOW)).alias("piece"))
        .where(F.col("piece").rlike(r"\p{L}"))
        .orderBy("h", "doc_id", "lang", "piece").limit(most).collect()
    )
    return train([r.piece.encode("utf-8", "replace")[:WINDOW] for r in rows], [r.lang for r in rows])


OUT = pa.schema([("lang_pred", pa.string()), ("score", pa.float64())])


def with_language(docs: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score; columns of those names are replaced, others stay.

    Null texts and texts without a letter are ``und`` with score 0, as is every text where
    nothing was there to learn from.  Repeated rows each get a row.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    given = docs.select(*kept, F.col(text).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, score = languages(batch.column(len(kept)).to_pylist(), net)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(score)], names=[*kept, "lang_pred", "score"]
            )

    schema = docs.select(kept).withColumns({"lang_pred": F.lit("a"), "score": F.lit(0.0)}).schema
    return given.mapInArrow(run, schema)


def identify(docs: DataFrame, *, folds: int = 4, fold: int = 2, most: int = 4000) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs`` (doc_id, text, lang);
    ``lang`` serves to fit only.  Null ids are not held out and not learnt from."""
    net = fit(docs, folds=folds, fold=fold, most=most)
    given = docs.select("doc_id", in_fold(F.col("doc_id"), folds, fold).alias("held_out"), "text")
    return with_language(given, net).drop("text")
