"""Byte-level BPE encoding and decoding: ranked merges folded in Spark's higher-order functions.

Documents are taken in blocks of about a million bytes and split by the tokenizer's
pattern.  A word that is a token is its id; every other distinct word of a task gets a
number, which stands in the block's ids as a hole.  A block carries the words that its task
has not seen before; the fold turns them into ids, and the step after it keeps them in a
table, bounded like the numbers before it, and fills the holes.  Nothing is shuffled.

The tables start with the most frequent words of a bounded sample of documents, folded once
before: at most ``most`` words of at most COMMON_BYTES bytes, some megabytes whatever the
input.  They decide the cost only.

The fold holds a word as token ids, one a byte at first, each behind the rank of the pair it
begins: each step merges the leftmost pair of the lowest rank, found in a rank map, until no
pair has a rank.  A step copies the word, so words above LONG bytes are merged before, from a heap, in n log n.  Decoding
looks up each id's bytes and joins them.

The rank map is keyed by the pair of ids and lies in flat arrays with a slot for each pair,
as Spark searches a map from end to end.  It is a table of one row, broadcast to the blocks:
as a literal its millions of characters would stand in every text that Spark keeps of a plan.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, IntegerType, StructField, StructType

#: Buckets and slots of the rank map; SPREAD keeps pairs of one bucket apart.
BUCKETS, SLOTS, SPREAD = 1 << 15, 196613, 65599
#: Two ids, or a rank and an id, are held in one number; ids have 17 bits.
ID_BITS = 17
NONE = 2147483647
#: Bytes of a block's texts, bytes of a word that the fold takes.
BLOCK, LONG = 1_000_000, 256
#: Frequent words: how many, of how many bytes at most, of about how many documents.
COMMON, COMMON_BYTES, SAMPLE_DOCS = 320_000, 32, 32_000
#: Words that a task numbers besides them until it starts anew.
TABLE = 200_000


def ranks_of(path: str) -> dict[bytes, int]:
    """Token bytes to rank; a token's rank is its id."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def _slots(pairs: dict[tuple[int, int], int]) -> tuple[list[int], list[int], list[int]]:
    """A hash table without collisions: the pair and the rank in each of its slots, and by
    bucket the shift of its slots.  Buckets take the first shift that leaves all their slots
    free, the fullest ones first."""
    buckets: dict[int, list[tuple[int, int, int]]] = {}
    for (left, right), rank in pairs.items():
        place, key = (left * SPREAD + right) % SLOTS, (left << ID_BITS) + right
        buckets.setdefault((left * 31 + right) % BUCKETS, []).append((place, key, rank << ID_BITS))
    slots, ranks, shifts = [-1] * SLOTS, [0] * SLOTS, [0] * BUCKETS
    for bucket, members in sorted(buckets.items(), key=lambda item: -len(item[1])):
        if len({place for place, *_ in members}) < len(members):
            raise ValueError("two pairs of one bucket share a slot: choose another SPREAD")
        shift = next(n for n in range(SLOTS) if all(slots[(place + n) % SLOTS] < 0 for place, *_ in members))
        shifts[bucket] = shift
        for place, key, rank in members:
            slots[(place + shift) % SLOTS], ranks[(place + shift) % SLOTS] = key, rank
    return slots, ranks, shifts


@cache
def _rank_arrays(path: str) -> pa.Table:
    """One row: ``first``, by byte and next byte (256: none) the byte's id behind the rank of
    the pair; and the rank map of the pairs of ids that make a token, as flat arrays:
    ``slots``, ``ranks`` and ``shifts``."""
    ranks = ranks_of(path)
    pairs = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                pairs[left, right] = rank
    slots, given, shifts = _slots(pairs)
    first = [
        (ranks.get(bytes([a, b]), NONE) if b < 256 else NONE) << ID_BITS | ranks[bytes([a])]
        for a in range(256) for b in range(257)
    ]
    arrays = {"first": first, "slots": slots, "ranks": given, "shifts": shifts}
    return pa.table({name: pa.array([values], pa.list_(pa.int64())) for name, values in arrays.items()})


def fold(word: str) -> str:
    """SQL for the ids (array<int>) of a word, given as its bytes (array<int>), by merges;
    ``c`` holds the rank arrays.  Ids behind a -1 are a word's already."""

    def rank(left: str, right: str) -> str:
        place = f"(({left} * {SPREAD} + {right} + c.shifts[({left} * 31 + {right}) % {BUCKETS}]) % {SLOTS})"
        return f"if(c.slots[{place}] = (shiftleft({left}, {ID_BITS}) | {right}), c.ranks[{place}], {no_rank})"

    # s: the parts, each its id behind the rank of the pair it begins; v: the least of them,
    # whose rank is the id of the merged pair; m: place of its first part
    mask, no_rank = f"{(1 << ID_BITS) - 1}L", f"{NONE << ID_BITS}L"
    start = f"transform({word}, (b, i) -> c.first[b * 257 + coalesce(get({word}, i + 1), 256)])"
    token, before, after = f"shiftright(v, {ID_BITS})", f"(s[m - 2] & {mask})", f"(s[m + 1] & {mask})"
    pair = f"if(m + 1 < size(s), {rank(token, after)}, {no_rank}) | {token}"
    merged = (
        f"if(m > 1, concat(slice(s, 1, m - 2), array({rank(before, token)} | {before}, {pair}), slice(s, m + 2, size(s))), "
        f"concat(array({pair}), slice(s, 3, size(s))))"
    )
    step = (
        f"transform(array(array_min(s)), v -> if(v >= {no_rank}, s, "
        f"transform(array(cast(array_position(s, v) as int)), m -> {merged})[0]))[0]"
    )
    merges = f"aggregate({word}, {start}, (s, b) -> {step}, s -> transform(s, x -> cast(x & {mask} as int)))"
    return f"if({word}[0] < 0, slice({word}, 2, size({word})), {merges})"


def merged(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a word, by the merges that the fold takes, the next one from a heap."""
    parts: list[bytes | None] = [word[k : k + 1] for k in range(len(word))]
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    heap: list[tuple[int, int, bytes]] = []

    def offer(k: int) -> None:
        if k >= 0 and after[k] < len(parts):
            pair = parts[k] + parts[after[k]]
            if (rank := ranks.get(pair)) is not None:
                heapq.heappush(heap, (rank, k, pair))

    for k in range(len(parts)):
        offer(k)
    while heap:
        _, k, pair = heapq.heappop(heap)
        # an entry is stale when one of its parts has gone or grown since
        if parts[k] is None or (gone := after[k]) >= len(parts) or parts[k] + parts[gone] != pair:
            continue
        parts[k], parts[gone], after[k] = pair, None, after[gone]
        if after[k] < len(parts):
            before[after[k]] = k
        offer(before[k])
        offer(k)
    return [ranks[p] for p in parts if p is not None]


def folded(words: DataFrame, column: str, path: str) -> DataFrame:
    """``words`` with ``column`` (the bytes of words, array<array<int>>) replaced by their ids.
    Rows keep their order and partitions.  A row should hold many words, as each is given a
    copy of the rank arrays (4 MB)."""
    arrays = words.sparkSession.createDataFrame(_rank_arrays(path))
    given = words.crossJoin(F.broadcast(arrays.select(F.struct(*arrays.columns).alias("__pairs"))))
    # the arrays are taken from the row once, not at each step
    held = ", ".join(f"__pairs.{name} as {name}" for name in arrays.columns)
    ids = F.expr(f"transform(array(struct({held})), c -> transform({column}, v -> {fold('v')}))[0]")
    return given.withColumn(column, ids).drop("__pairs")


def _lists(values: pa.Array, lengths: np.ndarray) -> pa.ListArray:
    """Lists of the given lengths of values that lie one after the other."""
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def _bytes(words: list[str], ranks: dict[bytes, int]) -> pa.ListArray:
    """The bytes of each word; the ids behind a -1 of those above LONG bytes."""
    raw = [w.encode() for w in words]
    if all(len(b) <= LONG for b in raw):
        flat = np.frombuffer(b"".join(raw), np.uint8).astype(np.int32)
        return _lists(pa.array(flat, pa.int32()), np.array([len(b) for b in raw], np.int64))
    return pa.array([list(b) if len(b) <= LONG else [-1, *merged(b, ranks)] for b in raw], pa.list_(pa.int32()))


def _ranges(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about BLOCK together."""
    part = np.cumsum(sizes, dtype=np.int64) // BLOCK
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1), len(sizes)] if len(sizes) else []
    return zip(edges, edges[1:])


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[str | None]]]:
    """Parts of the last column of a batch: first row, row behind the last, texts."""
    column = batch.column(batch.num_columns - 1)
    for begin, end in _ranges(pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)):
        yield begin, end, column.slice(begin, end - begin).to_pylist()


def common_words(texts: DataFrame, path: str, pattern: str, *, most: int, sample: int) -> pa.Table:
    """word and ids (array<int>) of the ``most`` most frequent words of about ``sample`` of
    the ``texts``, without words that are tokens, over COMMON_BYTES bytes, or there once."""
    n = texts.count()
    part = texts if n <= sample else texts.sample(sample / n, seed=5)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, tokens = regex.compile(pattern).findall, ranks_of(path)
        for batch in batches:
            for _, _, texts in _texts(batch):
                seen: Counter[str] = Counter()
                for t in texts:
                    seen.update(find(t or ""))
                raw = {w: w.encode() for w in seen}
                kept = [w for w, b in raw.items() if len(b) <= COMMON_BYTES and b not in tokens]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kept, pa.string()), pa.array([seen[w] for w in kept], pa.int64())], names=["word", "n"]
                )

    words = part.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where("n > 1")
    top = words.orderBy(F.desc("n"), "word").limit(most).select("word").repartition(max(2, most // 5000))

    def as_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, every = batch.column(0), np.array([batch.num_rows])
            yield pa.RecordBatch.from_arrays([_lists(words, every), _lists(_bytes(words.to_pylist(), {}), every)], names=["word", "ids"])

    done = folded(top.mapInArrow(as_bytes, "word array<string>, ids array<array<int>>"), "ids", path).toArrow()
    return pa.table({name: done.column(name).combine_chunks().flatten() for name in ("word", "ids")})


def filled(ids: np.ndarray, lengths: np.ndarray, flat: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and list lengths with every hole ``-1 - k`` replaced by the ids of word k, which
    has ``size[k]`` of them in ``flat``, after those of the words before it."""
    holes = np.flatnonzero(ids < 0)
    if not len(holes):
        return ids, lengths
    first, word = np.cumsum(size) - size, -1 - ids[holes].astype(np.int64)
    long = size[word]
    wide = np.ones(len(ids), np.int64)
    wide[holes] = long
    out = np.repeat(ids, wide)
    turn = np.arange(long.sum()) - np.repeat(np.cumsum(long) - long, long)
    out[out < 0] = flat[np.repeat(first[word], long) + turn]
    ends = np.concatenate([[0], np.cumsum(wide)])
    at = np.concatenate([[0], np.cumsum(lengths)])
    return out, np.diff(ends[at])


class _Numbers(dict):
    """Word to id; a word that is missing gets the next of -1 - common, -2 - common, ..."""

    def __init__(self, known: dict[str, int], common: int):
        super().__init__(known)
        self.last, self.words = -common, []

    def __missing__(self, word: str) -> int:
        self.words.append(word)
        self.last -= 1
        self[word] = self.last
        return self.last


def _flat(ids: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All ids one after the other, and how many each word has."""
    size = ids.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return ids.flatten().to_numpy(zero_copy_only=False).astype(np.int32), size


class _Grown:
    """An array that is added to, copied only when it has doubled."""

    def __init__(self, start: np.ndarray):
        self.held, self.n = start, len(start)

    def add(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.held):
            held = np.empty(max(self.n + len(more), self.n * 3 // 2), self.held.dtype)
            held[: self.n] = self.held[: self.n]
            self.held = held
        self.held[self.n : self.n + len(more)] = more
        self.n += len(more)

    def all(self) -> np.ndarray:
        return self.held[: self.n]


def encoded(
    docs: DataFrame, path: str, pattern: str, *, text: str = "text", keep: Iterable[str] | None = None,
    also: tuple[str, ...] = (), most: int = COMMON, sample: int = SAMPLE_DOCS, table: int = TABLE,
) -> DataFrame:
    """``docs`` with ``ids`` (array<int>): every match of ``pattern`` in the text, encoded by
    the ranks in ``path`` without special tokens.

    Null and empty texts have no ids.  Words of any length are encoded whole.  Repeated rows
    each get theirs; an empty table gives an empty result.  The columns in ``keep`` (all of
    them by default) stay, whatever their names; an existing column ``ids`` is replaced.
    ``also`` names two more columns: the bytes decoded from the ids and the packed ids, as
    ``decoded`` gives them, made in the same pass.
    ``most``, ``sample`` and ``table`` change the time and memory, not the ids."""
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("ids", *also)]
    # names are positions inside, so that no two clash
    inner = docs.select(*[F.col(c).alias(f"c{k}") for k, c in enumerate(kept)], F.col(text).alias("t"))
    names, more_names = [f"c{k}" for k in range(len(kept))], [f"also{k}" for k in range(len(also))]
    common = common_words(inner.select("t"), path, pattern, most=most, sample=sample).combine_chunks()
    start = common.num_rows

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern).findall
        known, ranks = {w: -1 - k for k, w in enumerate(common.column("word").to_pylist())}, ranks_of(path)
        for token, i in ranks.items():
            try:
                known[token.decode()] = i
            except UnicodeDecodeError:  # part of a character: no word
                pass
        numbers, fresh = _Numbers(known, start), True
        for batch in batches:
            for begin, end, texts in _texts(batch):
                if -numbers.last - start > table:
                    numbers, fresh = _Numbers(known, start), True
                numbers.words, ids, lengths = [], array("i"), []
                for t in texts:
                    words = find(t or "")
                    ids.extend(map(numbers.__getitem__, words))
                    lengths.append(len(words))
                rows = pa.StructArray.from_arrays([c.slice(begin, end - begin) for c in batch.columns[:-1]], names)
                yield pa.RecordBatch.from_arrays(
                    [_lists(rows, np.array([end - begin])), pa.array([lengths], pa.list_(pa.int32())), pa.array([ids.tobytes()]),
                     pa.array([fresh]), _lists(_bytes(numbers.words, ranks), np.array([len(numbers.words)]))],
                    names=["rows", "lengths", "holed", "fresh", "words"],
                )
                fresh = False

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, pieces = _flat(common.column("ids").combine_chunks()), _pieces(path) if also else None
        flat, size = _Grown(known[0]), _Grown(known[1])
        for batch in batches:
            for k in range(batch.num_rows):
                rows, lengths, holed, fresh, words = (c[k] for c in batch.columns)
                if fresh.as_py():
                    flat, size = _Grown(known[0]), _Grown(known[1])
                more, sizes = _flat(words.values)
                flat.add(more)
                size.add(sizes)
                ids, long = filled(np.frombuffer(holed.as_py(), "<i4"), np.array(lengths.values, np.int64), flat.all(), size.all())
                flat_ids, bytes_of = pa.array(ids, pa.int32()), []
                if pieces is not None:
                    bytes_of = _joined(flat_ids, np.concatenate([[0], np.cumsum(long)]), pieces)
                yield pa.RecordBatch.from_arrays([*rows.values.flatten(), _lists(flat_ids, long), *bytes_of], names=[*names, "ids", *more_names])

    fields = inner.schema.fields[:-1]
    block = StructType([
        StructField("rows", ArrayType(StructType(fields))), StructField("lengths", ArrayType(IntegerType())),
        StructField("holed", BinaryType()), StructField("fresh", BooleanType()), StructField("words", ArrayType(ArrayType(IntegerType()))),
    ])
    done = StructType([*fields, StructField("ids", ArrayType(IntegerType())), *(StructField(c, BinaryType()) for c in more_names)])
    return folded(inner.mapInArrow(split, block), "words", path).mapInArrow(fill, done).toDF(*kept, "ids", *also)


@cache
def _pieces(path: str) -> pa.Array:
    """By id: its bytes."""
    ranks = ranks_of(path)
    out = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        out[i] = token
    return pa.array(out, pa.large_binary())


def _joined(ids: pa.Array, ends: np.ndarray, pieces: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Of ids (int32) cut at ``ends``: their bytes joined, and the ids packed (binary)."""
    texts = pieces.take(ids)
    starts = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(ids) + 1]
    cut = starts[ends] if len(ids) else np.zeros(len(ends), np.int64)
    raw = np.ascontiguousarray(ids.to_numpy(zero_copy_only=False), "<i4")

    def slices(at: np.ndarray, data: pa.Buffer | None) -> pa.Array:
        full = pa.py_buffer(b"") if data is None else data
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(at) - 1, [None, pa.py_buffer(np.ascontiguousarray(at, np.int64)), full]
        ).cast(pa.binary())

    return slices(cut, texts.buffers()[2]), slices(ends * 4, pa.py_buffer(raw))


def decoded(df: DataFrame, path: str, *, ids: str = "ids", to: str = "decoded", packed: str = "packed") -> DataFrame:
    """``df`` with ``to``, the bytes (binary) of the array of ids, joined from those of each
    id, and ``packed``, the ids as little-endian unsigned 32-bit integers (binary).

    No ids, and null, give empty bytes.  Other columns stay; columns of the new names are
    replaced."""
    kept = [c for c in df.columns if c not in (to, packed)]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(path)
        for batch in batches:
            sizes = batch.column(batch.num_columns - 1).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            for begin, end in _ranges(sizes):
                here = batch.slice(begin, end - begin)
                flat = here.column(here.num_columns - 1).flatten().cast(pa.int32())
                ends = np.concatenate([[0], np.cumsum(sizes[begin:end], dtype=np.int64)])
                yield pa.RecordBatch.from_arrays([*here.columns[:-1], *_joined(flat, ends, pieces)], names=names)

    names = [*(f"c{k}" for k in range(len(kept))), to, packed]
    inner = df.select(*[F.col(c).alias(f"c{k}") for k, c in enumerate(kept)], F.col(ids).alias("ids"))
    schema = StructType([*inner.schema.fields[:-1], StructField(to, BinaryType()), StructField(packed, BinaryType())])
    return inner.mapInArrow(join, schema).toDF(*kept, to, packed)


def digests(docs: DataFrame, path: str, pattern: str, **bounds: int) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_tokens, ids_sha256, decoded_sha256.

    Null and empty texts have no ids and the digests of no bytes.  Repeated rows and null
    ids each get a row; other columns are ignored; an empty table gives an empty result."""
    done = encoded(docs.select("doc_id", "text"), path, pattern, keep=["doc_id"], also=("decoded", "packed"), **bounds)
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2("packed", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
