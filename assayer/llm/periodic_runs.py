"""Periodic runs of words by recursive frequency splitting and a lag scan.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) of
at least max(24, 3q) words that no neighbouring word extends.  Every word of a run occurs at
least three times in it.  So a word that occurs more rarely within a segment cannot belong to
a run inside that segment: it splits the segment, which makes other words rare in the parts,
and so on until nothing changes.  Ordinary text dissolves.  Surviving segments are scanned
lag by lag: words q apart that are equal over 2q places hold a whole block [kq, (k+1)q) of
the segment that equals the next block, so only blocks are compared, by rolling sums, which
makes n/q comparisons a lag and n log n a segment.  What the sums propose is then read word
by word; a run is never decided by a sum.

The word ids of a text lie in one array in the task that reads it; nothing is shuffled.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import WORD

LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Two moduli below 2^31, so that products of two remainders fit, and a base for each.
MODULI, BASES = (2147483647, 2147483629), (1000003, 69069)
#: Characters that are split into words at a time.
PIECE = 1 << 20


def pieces(text: str, word: re.Pattern[str], size: int = PIECE) -> Iterator[list[str]]:
    """The words of a text, in lists of bounded length; no word is cut."""
    begin = 0
    while begin < len(text):
        end = begin + size
        if end < len(text) and (m := word.match(text, end - 1)):
            end = m.end()
        yield word.findall(text, begin, end)
        begin = end


def surviving(ids: np.ndarray, least: int = LEAST_PERIODS, shortest: int = LEAST_WORDS) -> list[tuple[int, int]]:
    """Segments [lo, hi) in which every word occurs ``least`` times, ``shortest`` words at least.

    The largest part of a split keeps its parent's counts, less those of the other parts, and
    the others are counted anew: a word is counted again only when its segment halves.
    """
    out, todo = [], [(0, len(ids))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo < shortest:
            continue
        _, word, counts = np.unique(ids[lo:hi], return_inverse=True, return_counts=True)
        places = np.argsort(word, kind="stable")
        first = np.concatenate([[0], np.cumsum(counts)])
        begin, end, rare = 0, hi - lo, np.flatnonzero(counts < least)
        while len(rare) and end - begin >= shortest:
            cuts = np.concatenate([places[first[w]:first[w + 1]] for w in rare]) if len(rare) < 64 else places[np.isin(word[places], rare)]
            cuts = np.sort(cuts[(cuts >= begin) & (cuts < end)])
            edges = np.concatenate([[begin - 1], cuts, [end]])
            k = int(np.argmax(np.diff(edges)))
            left, right = int(edges[k]) + 1, int(edges[k + 1])
            for a, b in zip(edges[:-1] + 1, edges[1:], strict=True):
                if b - a >= shortest and a != left:
                    todo.append((lo + int(a), lo + int(b)))
            gone, times = np.unique(np.concatenate([word[begin:left], word[right:end]]), return_counts=True)
            counts[gone] -= times
            rare = gone[(counts[gone] > 0) & (counts[gone] < least)]
            begin, end = left, right
        if not len(rare) and end - begin >= shortest:
            out.append((lo + begin, lo + end))
    return sorted(out)


def _powers(base: int, modulus: int, n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < n:
        step = pow(base, len(out), modulus)
        out = np.concatenate([out, out * np.uint64(step) % np.uint64(modulus)])
    return out[:n]


class _Sums:
    """Rolling sums of a segment: blocks with equal words have equal sums."""

    def __init__(self, ids: np.ndarray) -> None:
        self.parts = []
        for modulus, base in zip(MODULI, BASES, strict=True):
            m = np.uint64(modulus)
            powers = _powers(base, modulus, len(ids) + 1)
            terms = (ids.astype(np.uint64) + np.uint64(1)) % m * powers[:-1] % m
            self.parts.append((np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)]), powers, m))

    def equal_blocks(self, q: int) -> np.ndarray:
        """Starts kq of blocks of q words that seem to equal the next block."""
        at = np.arange(0, len(self.parts[0][0]) - 2 * q, q)
        same = np.ones(len(at), bool)
        for sums, powers, m in self.parts:
            here, there = (sums[at + q] - sums[at]) % m, (sums[at + 2 * q] - sums[at + q]) % m
            same &= here * powers[q] % m == there
        return at[same]


def _equal_stretch(ids: np.ndarray, q: int, at: int) -> tuple[int, int]:
    """Places [a, b) around ``at`` whose words equal those q later."""
    a, b, step = at, at, 64
    while b + q < len(ids):
        end = min(b + step, len(ids) - q)
        differ = np.flatnonzero(ids[b:end] != ids[b + q:end + q])
        if len(differ):
            b += int(differ[0])
            break
        b, step = end, step * 2
    step = 64
    while a > 0:
        begin = max(a - step, 0)
        differ = np.flatnonzero(ids[begin:a] != ids[begin + q:a + q])
        if len(differ):
            a = begin + int(differ[-1]) + 1
            break
        a, step = begin, step * 2
    return a, b


def lag_scan(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """The runs (start, length, period) of one segment, by period.

    A block pair inside a run found before, whose period divides the lag, has that smaller
    period and is passed over; so texts of one repeated word cost no more than others.
    """
    found: list[tuple[int, int, int]] = []
    starts, ends, periods = (np.zeros(0, np.int64) for _ in range(3))
    sums = _Sums(ids)
    for q in range(1, len(ids) // LEAST_PERIODS + 1):
        at = sums.equal_blocks(q)
        if not len(at):
            continue
        for r in np.flatnonzero(q % periods == 0) if len(periods) else ():
            at = at[(at < starts[r]) | (at + 2 * q > ends[r])]
        behind = 0
        for k in at.tolist():
            if k < behind:
                continue
            a, b = _equal_stretch(ids, q, k)
            behind = max(b, k + 1)
            length = b - a + q
            if length >= max(LEAST_WORDS, LEAST_PERIODS * q) and not _shorter(ids, a, q):
                found.append((a, length, q))
                starts, ends, periods = (np.append(x, y) for x, y in ((starts, a), (ends, a + length), (periods, q)))
    return found


def _shorter(ids: np.ndarray, start: int, q: int) -> bool:
    """Whether the block of q words has a smaller period that divides q."""
    block, rest, prime = ids[start:start + q], q, 2
    while rest > 1:
        if rest % prime:
            prime += 1 if prime * prime <= rest else rest - prime
            continue
        while rest % prime == 0:
            rest //= prime
        p = q // prime
        if np.array_equal(block[p:], block[:-p]):
            return True
    return False


def runs_of(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a sequence of word ids, by start, then period."""
    return sorted(
        ((lo + a, n, q) for lo, hi in surviving(ids) for a, n, q in lag_scan(ids[lo:hi])), key=lambda r: (r[0], r[2])
    )


def collapsed_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Whether each of n words stays: not if a run holds it after that run's first period."""
    depth = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return np.cumsum(depth[:-1]) == 0


def analysed(text: str | None, word: re.Pattern[str]) -> tuple[int, list[tuple[int, int, int]], str]:
    """Number of words, runs, and the text without repetitions of its runs."""
    numbers: dict[str, int] = {}
    ids = array("i")
    for words in pieces(text or "", word):
        ids.extend([numbers.setdefault(w, len(numbers)) for w in words])
    found = np.frombuffer(ids, np.int32) if len(ids) else np.zeros(0, np.int32)
    runs = runs_of(found)
    names = list(numbers)
    keep = found[collapsed_words(len(found), runs)] if runs else found
    return len(found), runs, " ".join([names[i] for i in keep.tolist()])


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (array of start, length, period, by start, then
    period) and ``collapsed`` (the words that no run repeats, joined by one space).

    Null and empty texts have no words and no runs.  Rows are judged one by one, so repeated
    rows give equal results, an empty table an empty one.  Long texts are read whole; their
    words are numbered a piece at a time.  Runs of equal start differ in period; all are
    given.  Other columns stay; columns of the three names are replaced.
    """
    added = ["n_words", "runs", "collapsed"]
    kept = [c for c in docs.columns if c.lower() not in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word = re.compile(WORD)
        for batch in batches:
            *own, texts = batch.columns
            rows = [analysed(t, word) for t in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array([n for n, _, _ in rows], pa.int64()),
                 pa.array([[{"start": a, "length": n, "period": q} for a, n, q in r] for _, r, _ in rows], pa.list_(RUN)),
                 pa.array([c for _, _, c in rows], pa.string())],
                names=[*kept, *added],
            )

    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(text).cast("string").alias("__text"))
    example = docs.select(*[F.col(f"`{c}`") for c in kept]).selectExpr(
        "*", "0L as n_words", "array(named_struct('start', 0L, 'length', 0L, 'period', 0L)) as runs", "'' as collapsed"
    )
    return source.mapInArrow(run, example.schema)


def digests(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): number of runs, the run with the greatest exact
    length / period (ties: smallest start, then period; null without a run), and SHA-256 of
    the list of runs and of the collapsed text.  A null doc_id is kept; other columns go."""
    best = (
        "aggregate(runs, cast(null as struct<start:bigint,length:bigint,period:bigint>), (m, r) -> "
        "if(m is null or r.length * m.period > m.length * r.period, r, m))"
    )
    lines = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')"
    return (
        periodic_runs(docs.select("doc_id", "text"))
        .selectExpr("*", f"{best} as best")
        .selectExpr(
            "doc_id", "cast(size(runs) as bigint) as n_runs", "best.start as start", "best.length as length",
            "best.period as period", "1000 * best.length div best.period as exponent_milli",
            f"sha2({lines}, 256) as runs_sha256", "sha2(collapsed, 256) as collapsed_sha256",
        )
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) in which a tenth of the texts, by crc32 of doc_id, repeat: from
    word a on, word i is word a + (i - a) % p.  Texts without words and rows without doc_id
    stay as they are."""
    h = "crc32(cast(cast(doc_id as string) as binary))"
    g = f"({h} div 10)"
    tail = (
        "transform(array(struct(w as w, cast(g % size(w) as int) as a)), x -> "
        "transform(array(struct(x.w as w, x.a as a, cast(1 + (size(x.w) - x.a) div (3 + g % 8) as int) as p)), y -> "
        "array_join(transform(sequence(0, size(y.w) - 1), i -> if(i < y.a, y.w[i], y.w[y.a + (i - y.a) % y.p])), ' '))[0])[0]"
    )
    pattern = WORD.replace("\\", "\\\\")
    planted = f"transform(array(regexp_extract_all(text, '{pattern}', 0)), w -> if(size(w) > 0, {tail.replace('g %', f'{g} %')}, text))[0]"
    return docs.selectExpr("doc_id", f"if({h} % 10 = 0 and text is not null, {planted}, text) as text")
