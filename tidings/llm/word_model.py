"""Word n-grams of trusted text, counted and looked up in shards.

The words of a text are hashed to 64 bits. All that the model says of an n-gram but the share of its
last word alone hangs on its middle word: counts, both contexts and the ways in which the last two
words are continued to the left. So an n-gram goes to the shard of its middle word and meets the
trusted n-grams there. What the shard sends back are these counts; the words of each batch of documents are joined with the
words of the model once. Nothing of the model comes to the driver but three discounts for each order
and fold, some sums and the heavy middle words.

N-grams outnumber the bytes of a compressed text, so they travel packed, and in ``PASSES`` passes, each
over the shards of its own: the shuffle files of a pass go before the next one. Each pass reads all texts.

A middle word with more n-grams than a shard should have is dealt over pieces by the word before it. Its
pairs with the next word are added up over the pieces, and each piece gets them all.

A text belongs to one of two folds by its hash and is scored by the trusted texts of the other fold,
so no text, nor an exact copy of it, is scored by a model that has counted it. The last bit of a hashed
middle word is the fold that is scored.

Defined results: an empty text has no word perplexity, nor has any text whose fold has no model.
"""

from __future__ import annotations

import hashlib
import math
import re
import struct
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.llm.common import map_arrow
from tidings.session import materialize

ORDER = 3
_APART = "[฀-໿က-႟ក-៿぀-ヿ㐀-鿿\U00020000-\U0003ffff]"
_LETTER = re.compile(rf"(?!{_APART})[^\W\d_]")
#: Runs of letters and marks that belong to them; digits, signs and letters of scripts without blanks alone.
_WORDS = re.compile(rf"{_APART}|(?:{_LETTER.pattern})+|\d|[^\w\s]|_")
#: Passes over the texts to look up n-grams, and those of the trusted texts to count them.
PASSES = 10
COUNT_PASSES = 2
#: Bytes of text whose n-grams share a shard, over all passes.
SHARD_BYTES = 7_000_000
#: A middle word with so many times the n-grams of a mean shard, or more, is dealt over pieces.
HEAVY = 0.5
#: Share of the texts that are read to find such words.
HEAVY_SAMPLE = 0.0625
#: Bytes of text in a batch, of which one task sends each shard one row, and rows of texts read at once.
BATCH_BYTES = 32_000_000
_ROWS = 64
_MET_ROWS = 1 << 18
_START, _END = 0, 1
_WHITE, _ALONE, _LETTERS, _UNKNOWN = 0, 1, 2, 255
_KINDS = np.full(0x110000, _UNKNOWN, np.uint8)
#: Kinds of rows of a shard and of a batch, in the order in which they are read.
_PAIRS, _TRUSTED, _ASKED = 0, 1, 2
_KEYS, _SHARES, _SCORES = 0, 1, 2
_SHARD_ROW = "shard long, kind int, batch long, body binary"
_BATCH_ROW = "batch long, kind int, body binary"


def words(text: str) -> list[str]:
    return _WORDS.findall(text)


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15) ^ (b + np.uint64(0xD1B54A32D192ED03))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _kinds(points: np.ndarray) -> np.ndarray:
    """Whether each character is part of no word, a word of its own, or a letter of a word."""
    found = _KINDS[points]
    if (found == _UNKNOWN).any():
        for point in np.unique(points[found == _UNKNOWN]).tolist():
            char = chr(point)
            _KINDS[point] = _LETTERS if _LETTER.fullmatch(char) else _ALONE if _WORDS.fullmatch(char) else _WHITE
        found = _KINDS[points]
    return found


@cache
def _weights() -> np.ndarray:
    """A number for each character."""
    return _mixed(np.arange(len(_KINDS), dtype=np.uint64), np.full(1, 3, np.uint64))


def hashed_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words that :func:`words` finds in each text, one after another, and their numbers."""
    stops = np.cumsum([len(t) for t in texts])
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.int32)
    if not len(points):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    points = points.astype(np.intp)
    kinds = _kinds(points)
    letters = kinds == _LETTERS
    first = kinds != _WHITE
    inside = np.flatnonzero(first)
    follows = letters[1:] & letters[:-1]
    follows[stops[(stops > 0) & (stops < len(points))] - 1] = False
    first[1:] &= ~follows
    sizes = np.diff(np.searchsorted(np.flatnonzero(first), stops), prepend=0)
    at = np.flatnonzero(first[inside])
    if not len(at):
        return np.zeros(0, np.uint64), sizes
    lengths = np.diff(at, append=len(inside))
    place = np.arange(len(inside)) - np.repeat(at, lengths)
    # A sum over the characters, each times a factor of its place in the word.
    factors = _mixed(np.arange(lengths.max(), dtype=np.uint64), np.full(1, 5, np.uint64)) | np.uint64(1)
    sums = np.add.reduceat(_weights()[points[inside]] * factors[place], at)
    return _mixed(sums, np.zeros(1, np.uint64)), sizes


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Three words that follow each other, all of them, with the number of their text.

    Two marks stand before a text and one after it; empty texts have none.
    """
    hashes, sizes = hashed_words(texts)
    full = np.array([bool(t) for t in texts], np.int64)
    lengths = (sizes + ORDER) * full
    begins = np.cumsum(lengths) - lengths
    row = np.full(int(lengths.sum()), _START, np.uint64)
    inner = np.arange(len(hashes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    row[np.repeat(begins, sizes) + ORDER - 1 + inner] = hashes
    begins = begins[full > 0]
    row[begins + lengths[full > 0] - 1] = _END
    ends = np.ones(len(row), bool)
    for k in range(ORDER - 1):
        ends[begins + k] = False
    at = np.flatnonzero(ends)
    return row[at - 2], row[at - 1], row[at], np.repeat(np.arange(len(texts)), (sizes + 1) * full)


def text_key(text: Column) -> Column:
    """Equal texts have equal keys; the last bit is the fold."""
    return F.xxhash64(text)


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of numbers of the least width, compressed."""
    codec, parts = pa.Codec("zstd", compression_level=1), []
    for own in columns:
        own = own.astype(np.min_scalar_type(own.max() if len(own) else 0))
        raw = own.view(np.uint8)
        if own.itemsize < 8:
            # Bytes of one weight together are more alike.
            raw = raw.reshape(-1, own.itemsize).T
        body = codec.compress(raw.tobytes(), asbytes=True)
        parts.append(struct.pack("<2sqq", own.dtype.str[1:].encode(), own.nbytes, len(body)) + body)
    return b"".join(parts)


def _opened(body: bytes) -> list[np.ndarray]:
    codec, found, at = pa.Codec("zstd"), [], 0
    while at < len(body):
        kind, size, length = struct.unpack_from("<2sqq", body, at)
        at += struct.calcsize("<2sqq")
        raw = np.frombuffer(codec.decompress(body[at : at + length], size, asbytes=True), np.uint8)
        at += length
        kind = np.dtype("<" + kind.decode())
        if kind.itemsize < 8:
            raw = np.ascontiguousarray(raw.reshape(kind.itemsize, -1).T)
        found.append(raw.reshape(-1).view(kind))
    return found


def _row(schema: str, *values: object) -> pa.RecordBatch:
    types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    names, kinds = zip(*(c.split() for c in schema.split(", ")), strict=True)
    columns = [pa.array([v], types[k]) for v, k in zip(values, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, list(names))


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


class _Dealt:
    """The shard of an n-gram: by its middle word, for a heavy one also by the word before."""

    def __init__(self, shards: int, heavy: dict[int, int]) -> None:
        self.shards = shards
        self.words = np.array(sorted(heavy), np.int64).view(np.uint64)
        self.words.sort()
        self.pieces = np.array([heavy[int(w)] for w in self.words.view(np.int64)], np.uint64)

    def _of(self, x: np.ndarray) -> np.ndarray:
        return ((x >> np.uint64(32)) * np.uint64(self.shards) >> np.uint64(32)).astype(np.int64)

    def is_heavy(self, middle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.words):
            return np.zeros(len(middle), bool), np.zeros(len(middle), np.int64)
        at = np.minimum(np.searchsorted(self.words, middle), len(self.words) - 1)
        return self.words[at] == middle, at

    def shard(self, before: np.ndarray, middle: np.ndarray) -> np.ndarray:
        own = _mixed(middle, np.full(1, 7, np.uint64))
        heavy, at = self.is_heavy(middle)
        if heavy.any():
            piece = _mixed(before[heavy], np.full(1, 9, np.uint64)) % self.pieces[at[heavy]]
            own[heavy] = _mixed(own[heavy], piece)
        return self._of(own)

    def pieces_of(self, middle: int) -> np.ndarray:
        """All shards that have n-grams of a heavy word."""
        word = np.array([middle], np.int64).view(np.uint64)
        pieces = np.arange(int(self.pieces[self.is_heavy(word)[1][0]]), dtype=np.uint64)
        return np.unique(self._of(_mixed(_mixed(word, np.full(1, 7, np.uint64)), pieces)))


def _batches(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[tuple[pa.RecordBatch, bool]]:
    """Parts of few rows, and whether a batch of ``most`` bytes is full with them."""
    size = 0
    for batch in batches:
        start = 0
        for k, own in enumerate(batch.column("_size").to_pylist(), 1):
            size += own
            full = size >= most
            if full or k - start == _ROWS or k == batch.num_rows:
                yield batch.slice(start, k - start), full
                start, size = k, 0 if full else size


def _name(keys: list[np.ndarray]) -> int:
    """The name of a batch: its rows are the same in each pass, or its name is another."""
    joined = np.concatenate(keys).astype("<i8").tobytes()
    return int.from_bytes(hashlib.blake2b(joined, digest_size=8).digest(), "little", signed=True)


def _texts(part: pa.RecordBatch) -> list[str]:
    return [t or "" for t in part.column("_body").to_pylist()]


def _keys(part: pa.RecordBatch) -> np.ndarray:
    return part.column("_key").to_numpy(zero_copy_only=False)


def _sent(docs: DataFrame, dealt: _Dealt, lowest: int, highest: int, trusted: bool) -> DataFrame:
    """The n-grams of the shards from ``lowest`` to below ``highest``, a row for each batch and shard."""
    most = BATCH_BYTES

    def packed(found: list[tuple[np.ndarray, ...]], keys: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        shard, *columns = (np.concatenate(c) for c in zip(*found, strict=True))
        order = np.argsort(shard.astype(np.min_scalar_type(highest - lowest)), kind="stable")
        cuts = np.flatnonzero(np.diff(shard[order])) + 1
        name = _name(keys)
        for own in np.split(order, cuts) if len(order) else []:
            a, b, c, doc = (x[own] for x in columns)
            known, at = np.unique(np.concatenate((a, b, c)), return_inverse=True)
            a, b, c = at.reshape(3, -1)
            if len(known) < 1 << 21:
                order = np.argsort(b << 42 | a << 21 | c)
            else:
                order = np.lexsort((c, a, b))
            b = np.diff(b[order], prepend=0)
            texts = [] if trusted else [doc[order]]
            body = _packed(known, a[order], b, c[order], *texts)
            kind = _TRUSTED if trusted else _ASKED
            yield _row(_SHARD_ROW, lowest + int(shard[own[0]]), kind, name, body)

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[np.ndarray, ...]] = []
        keys: list[np.ndarray] = []
        rows = 0
        for part, full in _batches(batches, most):
            own = _keys(part)
            a, b, c, doc = _grams(_texts(part))
            # N-grams of trusted texts are those of the fold that they help to score.
            fold = (own & 1 ^ trusted).astype(np.uint64)
            b = b & ~np.uint64(1) | fold[doc]
            shard = dealt.shard(a, b)
            here = np.flatnonzero((shard >= lowest) & (shard < highest))
            found.append((shard[here] - lowest, a[here], b[here], c[here], (doc[here] + rows).astype(np.int64)))
            keys.append(own)
            rows += part.num_rows
            if full:
                yield from packed(found, keys)
                found, keys, rows = [], [], 0
        if found:
            yield from packed(found, keys)

    return map_arrow(docs, compute, _SHARD_ROW)


def _read(body: bytes) -> tuple[np.ndarray, ...]:
    known, a, b, c, *texts = _opened(body)
    known = known.astype(np.uint64)
    return (known[a], known[np.cumsum(b, dtype=np.int64)], known[c], *texts)


def _by_shard(rows: DataFrame) -> DataFrame:
    """Rows of a shard in one partition, trusted n-grams before those that are looked up."""
    return rows.repartition("shard").sortWithinPartitions("shard", "kind")


def _distinct(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, ...]:
    """Hash, words and count of each n-gram."""
    names, first, counts = np.unique(_mixed(_mixed(c, b), a), return_index=True, return_counts=True)
    return names, a[first], b[first], c[first], counts


def _rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def _counted(rows: DataFrame, dealt: _Dealt, each: bool = False) -> DataFrame:
    """``(what, fold, a, c, n)`` of the trusted n-grams of each shard.

    ``what`` is ``ORDER`` or 2: ``n`` n-grams of that order that are met ``a`` times, 5 for five and more.
    1: the word ``c`` follows ``n`` different words. 0: the heavy word ``a`` stands before ``c`` and
    after ``n`` different words. With ``each`` only ``c``, the hash, and ``n`` of each n-gram.
    """
    names = ["what", "fold", "a", "c", "n"]

    def made(what: int, fold: np.ndarray, a: np.ndarray, c: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        columns = [np.full(len(n), what, np.int32), fold.astype(np.int32), _signed(a), _signed(c), n.astype(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names)

    def times(what: int, fold: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        own, many = np.unique(np.minimum(n, 5) * 2 + fold.astype(np.int64), return_counts=True)
        return made(what, own & 1, own >> 1, np.zeros(len(own)), many)

    def counted(found: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        grams, a, b, c, n = _distinct(*(np.concatenate(x) for x in zip(*found, strict=True)))
        one = np.uint64(1)
        if each:
            yield made(ORDER, b & one, grams, grams, n)
            return
        yield times(ORDER, b & one, n)
        _, first, n = np.unique(_mixed(c, b), return_index=True, return_counts=True)
        b, c = b[first], c[first]
        heavy, _ = dealt.is_heavy(b)
        if heavy.any():
            yield made(0, b[heavy] & one, b[heavy], c[heavy], n[heavy])
        b, c, n = b[~heavy], c[~heavy], n[~heavy]
        yield times(2, b & one, n)
        for fold in (0, 1):
            own, n = np.unique(c[b & one == fold], return_counts=True)
            yield made(1, np.full(len(n), fold), np.zeros(len(n)), own, n)

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, shard = [], None
        for row in _rows_of(batches):
            if found and row["shard"] != shard:
                yield from counted(found)
                found = []
            shard = row["shard"]
            found.append(_read(row["body"]))
        if found:
            yield from counted(found)

    return map_arrow(_by_shard(rows), compute, "what int, fold int, a long, c long, n long")


def discounts_of(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """The discounts of counts of one, two, and three or more, from how many counts are 1, 2, 3 and 4."""
    if not n1 or not n2:
        return [0.5, 0.5, 0.5]
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [min(max(d, 0.05), k + 0.95) for k, d in enumerate(found)]


class _Table:
    """Whole numbers by the sorted hashes of a shard or a batch; 0 for others."""

    def __init__(self, names: np.ndarray, *columns: np.ndarray) -> None:
        order = np.argsort(names)
        self.names, self.columns = names[order], [c[order] for c in columns]

    def found(self, names: np.ndarray) -> list[np.ndarray]:
        if not len(self.names):
            return [np.zeros(len(names), np.int64) for _ in self.columns]
        at = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
        met = self.names[at] == names
        return [np.where(met, c[at], 0) for c in self.columns]


class _Shard:
    """What the trusted n-grams of a shard say of an n-gram."""

    def __init__(
        self, dealt: _Dealt, grams: list[tuple[np.ndarray, ...]], pairs: list[tuple[np.ndarray, ...]]
    ) -> None:
        none = [np.zeros(0, np.uint64)] * 3
        names, a, b, c, n = _distinct(*(np.concatenate(x) for x in zip(none, *grams, strict=True)))
        self.grams, self.contexts = self._tables(names, _mixed(b, a), n)
        _, first, n = np.unique(_mixed(c, b), return_index=True, return_counts=True)
        b, c = b[first], c[first]
        # Of a heavy word the shard has a piece only; the sums of all pieces have been sent.
        own = ~dealt.is_heavy(b)[0]
        sent = [np.concatenate(x) for x in zip([none[0], none[0], np.zeros(0, np.int64)], *pairs, strict=True)]
        b, c, n = (np.concatenate(x) for x in zip((b[own], c[own], n[own]), sent, strict=True))
        self.pairs, self.words = self._tables(_mixed(c, b), b, n)

    @staticmethod
    def _tables(names: np.ndarray, context: np.ndarray, n: np.ndarray) -> tuple[_Table, _Table]:
        """Counts of n-grams; for each context their sum and how many are 1, 2, and more."""
        n = n.astype(np.int64)
        known, at = np.unique(context, return_inverse=True)
        sums = [np.bincount(at, x, len(known)).astype(np.int64) for x in (n, n == 1, n == 2, n > 2)]
        return _Table(names, n), _Table(known, *sums)

    def asked(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> list[np.ndarray]:
        """Count and sums of the context, five numbers for the n-gram and five for its last two words."""
        pair = _mixed(c, b)
        long = self.grams.found(_mixed(pair, a)) + self.contexts.found(_mixed(b, a))
        return long + self.pairs.found(pair) + self.words.found(b)


def _share(fold: np.ndarray, off: np.ndarray, n: np.ndarray, total: np.ndarray, *kinds: np.ndarray) -> list[np.ndarray]:
    """``x`` and ``r`` of ``p = x + r * p_lower``; 0 and 1 where the context is not known."""
    most = np.maximum(total, 1)
    less = np.concatenate((np.zeros((2, 1)), off), axis=1)[fold, np.minimum(n, 3)]
    rest = sum(k * off[fold, j] for j, k in enumerate(kinds))
    return [(n - less) / most, np.where(total > 0, rest / most, 1.0)]


def _looked_up(rows: DataFrame, dealt: _Dealt) -> DataFrame:
    """A row for each batch and shard: the text, the last word and what is known of each n-gram."""

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, grams, pairs, model = None, [], [], None
        for row in _rows_of(batches):
            if row["shard"] != shard:
                shard, grams, pairs, model = row["shard"], [], [], None
            if row["kind"] == _PAIRS:
                b, c, n = _opened(row["body"])
                pairs.append((b.astype(np.uint64), c.astype(np.uint64), n))
            elif row["kind"] == _TRUSTED:
                grams.append(_read(row["body"]))
            else:
                if model is None:
                    model = _Shard(dealt, grams, pairs)
                    grams, pairs = [], []
                a, b, c, doc = _read(row["body"])
                met = model.asked(a, b, c)
                known, c = np.unique(c, return_inverse=True)
                yield _row(_BATCH_ROW, row["batch"], _SCORES, _packed(doc, known, c, *met))

    return map_arrow(_by_shard(rows), compute, _BATCH_ROW)


def _added_up(
    rows: DataFrame, ends: dict[int, tuple[list[float], float, float]], off: dict[tuple[int, int], list[float]]
) -> DataFrame:
    """``(key, bits, n)``: the sum of ``log2 p`` of the n-grams of each text in a pass."""
    long, short = (np.array([off[order, fold] for fold in (0, 1)]) for order in (ORDER, 2))

    def last(n: np.ndarray, fold: int) -> np.ndarray:
        if fold not in ends:
            return np.full(len(n), np.nan)
        off, total, base = ends[fold]
        less = np.array([0.0, *off])[np.minimum(n, 3)]
        return (n - less) / total + base

    def scores(keys: np.ndarray, table: _Table, body: bytes) -> tuple[np.ndarray, np.ndarray]:
        doc, known, c, *met = _opened(body)
        times = table.found(known.astype(np.uint64))
        p1 = [last(n.astype(np.int64), fold) for fold, n in enumerate(times)]
        fold = (keys & 1)[doc]
        x3, r3 = _share(fold, long, *met[:5])
        x2, r2 = _share(fold, short, *met[5:])
        found = np.log2(x3 + r3 * (x2 + r2 * np.where(fold, p1[1][c], p1[0][c])))
        return np.bincount(doc, found, len(keys)), np.bincount(doc, minlength=len(keys))

    def summed(keys: np.ndarray, bits: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array(x[count > 0]) for x in (keys, bits, count)]
        return pa.RecordBatch.from_arrays(columns, ["key", "bits", "n"])

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch, keys, shares, table = None, None, [], None
        bits = count = np.zeros(0)
        for row in _rows_of(batches):
            if row["batch"] != batch:
                if table:
                    yield summed(keys, bits, count)
                batch, keys, shares, table = row["batch"], None, [], None
            if row["kind"] == _KEYS:
                keys = np.frombuffer(row["body"], "<i8")
            elif row["kind"] == _SHARES:
                shares.append(tuple(_opened(row["body"])))
            elif keys is None:
                raise ValueError("the texts were read in another order than before")
            else:
                if table is None:
                    none = [np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)]
                    names, *times = (np.concatenate(x) for x in zip(none, *shares, strict=True))
                    table = _Table(names.astype(np.uint64), *times)
                    bits, count = np.zeros(len(keys)), np.zeros(len(keys), np.int64)
                more, n = scores(keys, table, row["body"])
                bits, count = bits + more, count + n
        if table:
            yield summed(keys, bits, count)

    rows = rows.repartition("batch").sortWithinPartitions("batch", "kind")
    sums = map_arrow(rows, compute, "key long, bits double, n long")
    return sums.groupBy("key").agg(F.sum("bits").alias("bits"), F.sum("n").alias("n"))


def _middles(docs: DataFrame, trusted: bool, least: float) -> DataFrame:
    """``(word, n)``: the middle words of at least that share of a few texts; their number for null."""
    most = BATCH_BYTES

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _ in _batches(batches, most):
            _, b, _, doc = _grams(_texts(part))
            b = b & ~np.uint64(1) | (_keys(part) & 1 ^ trusted).astype(np.uint64)[doc]
            known, n = np.unique(b, return_counts=True)
            # The mark before a text always has the same word before it.
            own = (n >= least * len(b)) & (known > 1)
            words = [*_signed(known[own]).tolist(), None]
            columns = [pa.array(words, pa.int64()), pa.array([*n[own].tolist(), len(b)], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["word", "n"])

    return map_arrow(docs, compute, "word long, n long")


def _sized(docs: DataFrame) -> DataFrame:
    return docs.select("_key", "_body", F.octet_length("_body").cast("long").alias("_size"))


def _merged(counts: DataFrame) -> DataFrame:
    return counts.groupBy("what", "fold", "a", "c").agg(F.sum("n").alias("n"))


class Model:
    """What is known of the trusted n-grams before a look-up: discounts, counts of words alone.

    ``good`` are ``(_key, _body)`` of the trusted texts; the number of shards follows them and ``docs``,
    the texts that will be looked up.
    """

    def __init__(self, good: DataFrame, docs: DataFrame | None = None) -> None:
        self.good = _sized(good)
        inputs = [(self.good, True), *([(_sized(docs), False)] if docs is not None else [])]
        sizes = [x.agg(F.sum("_size")).first()[0] or 0 for x, _ in inputs]
        shards = max(1, -(-sum(sizes) // SHARD_BYTES))
        self.dealt = _Dealt(shards, self._pieces(inputs, shards))
        self.passes = self._ranges(PASSES)
        counts = None
        for lowest, highest in self._ranges(COUNT_PASSES):
            sent = _sent(self.good, self.dealt, lowest, highest, True)
            part = materialize(_merged(_counted(sent, self.dealt)), "word-counts")
            counts = counts.unionByName(part) if counts else part
        counts = materialize(_merged(counts), "word-counts")
        self.heavy = counts.where("what = 0").select("fold", "a", "c", "n")
        alone = counts.where("what = 1").select("fold", "c", "n")
        alone = alone.unionByName(self.heavy.select("fold", "c", F.lit(1).cast("long").alias("n")))
        self.alone = materialize(alone.groupBy("fold", "c").agg(F.sum("n").alias("n")), "word-counts")
        self._discount(counts)
        #: The n-grams, each by its hash, for who wants to read them.
        every = _sent(self.good, self.dealt, 0, shards, True)
        self.tables = {ORDER: _counted(every, self.dealt, each=True).select(F.col("c").alias("g"), "n")}

    def _ranges(self, number: int) -> list[tuple[int, int]]:
        shards, number = self.dealt.shards, min(number, self.dealt.shards)
        cuts = [shards * k // number for k in range(number + 1)]
        return list(zip(cuts, cuts[1:], strict=False))

    @staticmethod
    def _pieces(inputs: list[tuple[DataFrame, bool]], shards: int) -> dict[int, int]:
        """Over how many pieces the n-grams of each heavy word are dealt.

        A few texts are enough for this, as no result depends on it.
        """
        if shards == 1:
            return {}
        found = [_middles(x.sample(HEAVY_SAMPLE, 1), good, HEAVY / shards / 2) for x, good in inputs]
        every = found[0]
        for more in found[1:]:
            every = every.unionByName(more)
        sums = materialize(every.groupBy("word").agg(F.sum("n").alias("n")), "word-middles")
        total = sums.where("word IS NULL").first()
        if not total:
            return {}
        heavy = sums.where((F.col("n") * shards >= HEAVY * total.n) & F.col("word").isNotNull())
        return {r.word: math.ceil(r.n * shards / total.n / HEAVY) for r in heavy.collect()}

    def _discount(self, counts: DataFrame) -> None:
        one, most = F.lit(1).cast("long").alias("n"), F.least("n", F.lit(5)).alias("a")
        times = counts.where(F.col("what").isin(2, ORDER)).select("what", "fold", "a", "n")
        times = times.unionByName(self.heavy.select(F.lit(2).alias("what"), "fold", most, one))
        times = times.unionByName(self.alone.select(F.lit(1).alias("what"), "fold", most, one))
        # At most five rows for each order and fold.
        found = times.groupBy("what", "fold", "a").agg(F.sum("n").alias("n")).collect()
        n = {(r.what, r.fold, r.a): r.n for r in found}
        self.off = {
            (order, fold): discounts_of(*[n.get((order, fold, k), 0) for k in (1, 2, 3, 4)])
            for order in range(1, ORDER + 1) for fold in (0, 1)
        }
        self.ends = {}
        for r in self.alone.groupBy("fold").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds")).collect():
            own = [n.get((1, r.fold, k), 0) for k in (1, 2)]
            d1, d2, d3 = off = self.off[1, r.fold]
            rest = (own[0] * d1 + own[1] * d2 + (r.kinds - sum(own)) * d3) / r.total
            self.ends[r.fold] = off, r.total, rest / (r.kinds + 1)

    def _pairs(self, lowest: int, highest: int) -> DataFrame:
        """The pairs of heavy words, for each shard that has n-grams of the word."""
        dealt = self.dealt

        def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                b, c, n = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("a", "c", "n"))
                for word in np.unique(b).tolist():
                    own = b == word
                    body = _packed(b[own].view(np.uint64), c[own].view(np.uint64), n[own])
                    for shard in dealt.pieces_of(word).tolist():
                        if lowest <= shard < highest:
                            yield _row(_SHARD_ROW, shard, _PAIRS, 0, body)

        return map_arrow(self.heavy.select("a", "c", "n"), compute, _SHARD_ROW)

    def _pages(self, docs: DataFrame) -> DataFrame:
        """For each batch the keys of its texts, and how many words stand before each of its words."""
        most = BATCH_BYTES

        def keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: list[np.ndarray] = []
            for part, full in _batches(batches, most):
                found.append(_keys(part))
                if full:
                    yield _row(_BATCH_ROW, _name(found), _KEYS, np.concatenate(found).astype("<i8").tobytes())
                    found = []
            if found:
                yield _row(_BATCH_ROW, _name(found), _KEYS, np.concatenate(found).astype("<i8").tobytes())

        def made(found: list[np.ndarray], known: np.ndarray) -> Iterator[pa.RecordBatch]:
            name = _name(found)
            for start in range(0, len(known), 65_536):
                own = _signed(known[start : start + 65_536])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), name)), pa.array(own)], ["batch", "c"])

        def met(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: list[np.ndarray] = []
            known, more, rows = np.array([_END], np.uint64), [], 0
            for part, full in _batches(batches, most):
                found.append(_keys(part))
                more.append(hashed_words(_texts(part))[0])
                rows += len(more[-1])
                if full or rows > max(_MET_ROWS, len(known)):
                    known, more, rows = np.unique(np.concatenate((known, *more))), [], 0
                if full:
                    yield from made(found, known)
                    found, known = [], np.array([_END], np.uint64)
            if found:
                yield from made(found, np.unique(np.concatenate((known, *more))))

        def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in _rows_of(batches):
                names = np.array(row["names"], np.int64).view(np.uint64)
                body = _packed(names, np.array(row["n0"]), np.array(row["n1"]))
                yield _row(_BATCH_ROW, row["batch"], _SHARES, body)

        times = [F.sum(F.when(F.col("fold") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in (0, 1)]
        alone = self.alone.groupBy("c").agg(*times)
        words = map_arrow(docs, met, "batch long, c long").join(alone, "c").groupBy("batch").agg(
            F.collect_list("c").alias("names"), F.collect_list("n0").alias("n0"), F.collect_list("n1").alias("n1")
        )
        pages = map_arrow(docs.select("_key", "_size"), keys, _BATCH_ROW)
        return materialize(pages.unionByName(map_arrow(words, packed, _BATCH_ROW)), "word-pages")

    def bits(self, docs: DataFrame) -> DataFrame:
        """``(key, bits)``: the mean of ``-log2 p`` over a text's words and its end."""
        docs = _sized(docs)
        pages, sums = self._pages(docs), None
        for lowest, highest in self.passes:
            sent = _sent(docs, self.dealt, lowest, highest, False)
            sent = sent.unionByName(_sent(self.good, self.dealt, lowest, highest, True))
            if self.dealt.words.size:
                sent = sent.unionByName(self._pairs(lowest, highest))
            rows = _looked_up(sent, self.dealt).unionByName(pages)
            part = materialize(_added_up(rows, self.ends, self.off), "word-sums")
            sums = sums.unionByName(part) if sums else part
        # Rows that repeat a text add to both sums alike.
        mean = -F.sum("bits") / F.sum("n")
        known = F.when(~F.isnan(F.sum("bits")), F.round(mean, 6))
        return sums.groupBy("key").agg(known.alias("bits"))
