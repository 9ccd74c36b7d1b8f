"""Suffix-array dedup: remove the bytes that a document repeats from documents with smaller ids.

A byte goes if a string of ``match`` bytes covers it that also starts in a document with a smaller id.

Not all suffixes are sorted. Each window of ``match`` bytes names one anchor in it, the place with the
smallest hash of ``ANCHOR`` bytes, so equal windows name equal anchors. The windows of a document that
name the same place form a unit, some 14 windows. Work goes in three passes over the texts:

1. The hashes of the anchors meet by value, without any text. Those found in one document only
   cannot repeat and go no further; the others know their *source*, the smallest of their documents.
2. The units of the other anchors meet by source, so what a document repeats from another comes back in
   one row, whatever the number of partitions; a source of more than ``PLACE_ROWS`` rows is split by anchor.
   Equal units of a text are one row with all their starts, documents that copy another's whole text are
   left out, and the groups are worked on one after the other from sorted rows. Equal units are merged
   to one with its smallest id. Where an anchor has several units, the suffixes at their windows are sorted deep-shallow:
   rounds of `np.lexsort`, with eight bytes as one key, to ``SHALLOW`` bytes; blind tries order what
   still agrees there, and show which suffixes have ``match`` bytes in common.
3. The spans found go back to their documents, which are cut.

An anchor that many documents share is not sorted in one task. One that is frequent within a task of
the first pass only leaves a witness there, and anchors beyond ``HOT`` documents are *hot*: their equal
units and then their equal windows are merged by aggregation, which combines before it shuffles, and
the results are joined back with large partitions split. Both ways find the same windows.

Defined results: a null text counts as empty; texts shorter than ``match`` keep all; a row without id
neither loses bytes nor takes any; rows that repeat an id are one document, so they take nothing from
each other, and each loses what its own text repeats from smaller ids; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm.common import free_name, map_arrow, reader_slots, whole_text
from tidings.operators.skew import join_spread
from tidings.session import materialize, temporary_path

MATCH = 50
ANCHOR = 24
SHALLOW = 24
#: Documents of an anchor in one task from which only a witness is sent on.
LOCAL = 256
#: Documents of an anchor from which it is hot.
HOT = 8192
#: Rows of shared anchors beyond which a source is split, and rows that a task works on together.
PLACE_ROWS = 50_000
_TOGETHER = 20_000
#: Hashes in a row on the way to their bucket.
_SENT = 1024
#: Bytes of text that a partition of the second and third step answers for.
PART_BYTES = 8 << 20
#: Bytes that a task hashes at once, rows that it takes from a batch, and hashes that it holds.
_PIECE = 1 << 18
_ROWS = 256
_HELD = 400_000
_PLACES = np.uint64((1 << 23) - 1)


def _byte_keys() -> np.ndarray:
    """A 64-bit key for each byte value, by a multiplicative rule."""
    x = (np.arange(1, 257, dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(31)
    return x * np.uint64(0xBF58476D1CE4E5B9)


_KEYS = _byte_keys()
_STEP = [np.uint64(pow(0x9E3779B97F4A7C15, 2**j, 1 << 64)) for j in range(6)]


def _gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes from each place on, by doubling."""
    power, length, out, done = _KEYS[data], 1, None, 0
    level = 0
    while True:
        if size & length:
            if out is None:
                out, done = power, length
            else:
                n = len(data) - size + 1 if done + length == size else len(power) - done
                shift = np.uint64(pow(int(_STEP[0]), length, 1 << 64))
                out = out[:n] * shift + power[done : done + n]
                done += length
        if done == size:
            break
        power = power[:-length] * _STEP[level] + power[length:]
        length, level = 2 * length, level + 1
    out = out[: len(data) - size + 1].copy()
    out ^= out >> np.uint64(29)
    out *= np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(32)
    return out


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    length = 1
    while 2 * length <= width:
        values = np.minimum(values[:-length], values[length:])
        length *= 2
    if length < width:
        rest = width - length
        values = np.minimum(values[:-rest], values[rest:])
    return values


def units(data: np.ndarray, ends: np.ndarray, match: int) -> tuple[np.ndarray, ...]:
    """First and last window start and anchor hash of each unit of texts laid end to end.

    No window crosses one of ``ends``, the ends of the texts.
    """
    none = np.zeros(0, np.int64)
    windows = len(data) - match + 1
    if windows <= 0:
        return none, none, np.zeros(0, np.uint64)
    size = min(ANCHOR, match)
    hashes = _gram_hashes(data, size)
    # The place in the low bits makes the leftmost of equal hashes the smallest.
    placed = (hashes & ~_PLACES) | np.arange(len(hashes), dtype=np.uint64)
    named = _sliding_min(placed, match - size + 1) & _PLACES
    valid = np.ones(windows + 1, bool)
    crossing = (ends[:, None] - np.arange(1, match)).ravel()
    valid[crossing[(crossing >= 0) & (crossing <= windows)]] = False
    valid[windows] = False
    changed = np.ones(windows + 1, bool)
    changed[1:windows] = named[1:] != named[:-1]
    before = np.concatenate(([False], valid[:-1]))
    first = np.flatnonzero(valid & (changed | ~before))
    last = np.flatnonzero(valid[:-1] & (changed[1:] | ~valid[1:]))
    return first, last, hashes[named[first].astype(np.int64)]


def _pieces(text: bytes, match: int) -> Iterator[tuple[int, bytes]]:
    """A long text in pieces so that each window lies in exactly one."""
    step = _PIECE - match + 1
    for start in range(0, max(1, len(text) - match + 1), step):
        yield start, text[start : start + _PIECE]


def _text_groups(texts: list[bytes], match: int) -> Iterator[tuple[np.ndarray, np.ndarray, list]]:
    """Texts laid end to end, some megabytes at a time, with their ends and ``(row, offset)``."""
    held: list[bytes] = []
    places: list[tuple[int, int]] = []
    size = 0
    for row, text in enumerate(texts):
        if len(text) < match:
            continue
        for start, piece in _pieces(text, match):
            if held and size + len(piece) > _PIECE:
                ends = np.cumsum([len(x) for x in held])
                yield np.frombuffer(b"".join(held), np.uint8), ends, places
                held, places, size = [], [], 0
            held.append(piece)
            places.append((row, start))
            size += len(piece)
    if held:
        ends = np.cumsum([len(x) for x in held])
        yield np.frombuffer(b"".join(held), np.uint8), ends, places


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            yield batch.slice(start, _ROWS)


def _bytes_of(column: pa.Array) -> list[bytes]:
    return [(t or "").encode() for t in column.to_pylist()]


def _planes(values: np.ndarray) -> bytes:
    """Eight-byte numbers with the bytes of one rank side by side, which compress well."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()


def _from_planes(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _binary(items: list[bytes]) -> pa.Array:
    return pa.array(items, pa.binary())


_MET = "bucket int, doc long, hashes binary, docs binary, heavy binary"


def _send_hashes(match: int, buckets: int, local: int):
    """Per task: the pairs of anchor hash and document, by bucket of the hash."""

    def flush(hashes: np.ndarray, docs: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((docs, hashes))
        hashes, docs = hashes[order], docs[order]
        fresh = np.ones(len(hashes), bool)
        fresh[1:] = (hashes[1:] != hashes[:-1]) | (docs[1:] != docs[:-1])
        hashes, docs = hashes[fresh], docs[fresh]
        starts = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
        counts = np.diff(np.append(starts, len(hashes)))
        is_heavy = counts >= local
        here = np.repeat(is_heavy, counts)
        heavy = hashes[starts[is_heavy]]
        rows: list[tuple] = []
        # Sorted by hash, the buckets are runs of it.
        cut = (np.arange(buckets + 1, dtype=object) * (1 << 64) // buckets).tolist()
        cut = np.array(cut[1:-1], np.uint64)
        plain, plain_docs = hashes[~here], docs[~here]
        at = [0, *np.searchsorted(plain, cut).tolist(), len(plain)]
        of = [0, *np.searchsorted(heavy, cut).tolist(), len(heavy)]
        for b in range(buckets):
            if at[b] < at[b + 1] or of[b] < of[b + 1]:
                own = heavy[of[b] : of[b + 1]].tobytes()
                for lo in range(at[b], max(at[b + 1], at[b] + 1), _SENT):
                    part = slice(lo, min(lo + _SENT, at[b + 1]))
                    rows.append((b, None, _planes(plain[part]), _planes(plain_docs[part]), own))
                    own = b""
        hot, hot_docs = hashes[here], docs[here]
        order = np.argsort(hot_docs, kind="stable")
        for doc, own in _by_doc(hot_docs[order], hot[order]):
            rows.append((doc % buckets, doc, None, None, own.tobytes()))
        for k in range(0, len(rows), 256):
            b, d, h, o, w = zip(*rows[k : k + 256])
            columns = [pa.array(b, pa.int32()), pa.array(d, pa.int64()), _binary(h), _binary(o), _binary(w)]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "doc", "hashes", "docs", "heavy"])

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        size = 0
        for batch in _slices(batches):
            ids = batch.column(0).to_numpy()
            for data, ends, places in _text_groups(_bytes_of(batch.column(1)), match):
                first, _, hashes = units(data, ends, match)
                rows = np.array([r for r, _ in places])[np.searchsorted(ends, first, "right")]
                held.append(hashes)
                owners.append(ids[rows])
                size += len(hashes)
                if size > _HELD:
                    yield from flush(np.concatenate(held), np.concatenate(owners))
                    held, owners, size = [], [], 0
        if size:
            yield from flush(np.concatenate(held), np.concatenate(owners))

    return compute


def _by_doc(docs: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The values of each document, from arrays sorted by document."""
    if len(docs):
        starts = np.flatnonzero(np.concatenate(([True], docs[1:] != docs[:-1])))
        for lo, hi in zip(starts, [*starts[1:], len(docs)]):
            yield int(docs[lo]), values[lo:hi]


def _meet(hot: int):
    """Per bucket: the shared anchors of each document and their sources, of few and of many documents.

    Rows come sorted by bucket, as a task has several; it holds the hashes of one at a time.
    """

    def send(docs: np.ndarray, hashes: np.ndarray, sources: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(docs), 65_536):
            part = slice(k, k + 65_536)
            of = pa.nulls(len(docs[part]), pa.int64()) if sources is None else pa.array(sources[part])
            columns = [pa.array(docs[part]), pa.array(hashes[part].view(np.int64)), of]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "anchor", "source"])

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, docs, heavy = [], [], []
        current = None
        for batch in batches:
            for b, doc, h, o, w in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if b != current:
                    yield from met(hashes, docs, heavy)
                    current = b
                if h is None:
                    own = np.frombuffer(w, np.uint64)
                    yield from send(np.full(len(own), doc), own, None)
                else:
                    hashes.append(_from_planes(h, np.uint64))
                    docs.append(_from_planes(o, np.int64))
                    heavy.append(np.frombuffer(w, np.uint64))
        yield from met(hashes, docs, heavy)

    def met(hashes: list, docs: list, heavy: list) -> Iterator[pa.RecordBatch]:
        """The rows of a bucket; empties the lists."""
        if not hashes:
            return
        known, docs_of, many_here = np.concatenate(hashes), np.concatenate(docs), np.concatenate(heavy)
        for held in (hashes, docs, heavy):
            held.clear()
        order = np.argsort(known, kind="stable")
        known, docs_of = known[order], docs_of[order]
        if not len(known):
            return
        starts = np.flatnonzero(np.concatenate(([True], known[1:] != known[:-1])))
        counts = np.diff(np.append(starts, len(known)))
        source = np.minimum.reduceat(docs_of, starts)
        is_shared = source != np.maximum.reduceat(docs_of, starts)
        is_hot = np.isin(known[starts], many_here) | (is_shared & (counts > hot))
        kind = np.repeat(np.where(is_hot, 2, is_shared.astype(np.int8)), counts)
        few, many = kind == 1, kind == 2
        yield from send(docs_of[few], known[few], np.repeat(source, counts)[few])
        yield from send(docs_of[many], known[many], None)

    return compute


_UNIT = "place long, anchor long, doc long, row long, starts array<long>, region binary"


def _own_lists(column: pa.ListArray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Offsets of the rows of a batch, and the numbers of its lists or of their two fields."""
    values = column.values
    fields = [values.field(k) for k in range(2)] if pa.types.is_struct(values.type) else [values]
    return column.offsets.to_numpy(), [f.to_numpy(zero_copy_only=False) for f in fields]


def _lists(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int64)))


def _send_units(match: int):
    """The units of each text whose anchors are shared; those of hot anchors have no place."""

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            ids, rows_of = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cold_at, (cold, cold_places) = _own_lists(batch.column(3))
            hot_at, (hot,) = _own_lists(batch.column(4))
            cold, hot = cold.view(np.uint64), hot.view(np.uint64)
            for data, ends, pieces in _text_groups(_bytes_of(batch.column(2)), match):
                first, last, hashes = units(data, ends, match)
                piece = np.searchsorted(ends, first, "right")
                bounds = np.searchsorted(piece, np.arange(len(pieces) + 1))
                begins = np.concatenate(([0], ends[:-1]))
                text = data.tobytes()
                # Equal units of a text have one anchor.
                found: dict[tuple[int, bytes], list] = {}
                for k, (row, offset) in enumerate(pieces):
                    own = hashes[bounds[k] : bounds[k + 1]]
                    order = np.argsort(cold[cold_at[row] : cold_at[row + 1]])
                    known = cold[cold_at[row] : cold_at[row + 1]][order]
                    if len(known):
                        at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                        is_cold = known[at] == own
                        place = cold_places[cold_at[row] : cold_at[row + 1]][order][at]
                    else:
                        is_cold, place = np.zeros(len(own), bool), np.zeros(len(own), np.int64)
                    is_hot = np.isin(own, hot[hot_at[row] : hot_at[row + 1]])
                    for u in np.flatnonzero(is_cold | is_hot).tolist():
                        a = int(first[bounds[k] + u])
                        region = text[a : int(last[bounds[k] + u]) + match]
                        kept = found.get((row, region))
                        if kept is None:
                            of = None if is_hot[u] else int(place[u])
                            found[row, region] = [of, int(own[u]), a - int(begins[k]) + offset]
                        else:
                            kept.append(a - int(begins[k]) + offset)
                keys, values = list(found), list(found.values())
                for lo in range(0, len(keys), 16_384):
                    some, of = keys[lo : lo + 16_384], values[lo : lo + 16_384]
                    rows = np.array([row for row, _ in some])
                    columns = [
                        pa.array([x[0] for x in of], pa.int64()),
                        pa.array(np.array([x[1] for x in of], np.uint64).view(np.int64)),
                        pa.array(ids[rows]),
                        pa.array(rows_of[rows]),
                        _lists(np.array([p for x in of for p in x[2:]]), np.array([len(x) - 2 for x in of])),
                        _binary([region for _, region in some]),
                    ]
                    names = ["place", "anchor", "doc", "row", "starts", "region"]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return compute


class _BlindTrie:
    """Strings of equal length that agree on a prefix, in order of their bytes.

    A node holds only the place of its first difference and the byte taken there. A string goes down
    blindly to some leaf; one comparison with it tells where the string branches off.
    """

    def __init__(self) -> None:
        self.root: list | None = None  # [place, {byte: child}] or [None, string, members]

    def add(self, text: bytes, member: int) -> None:
        if self.root is None:
            self.root = [None, text, [member]]
            return
        node = self.root
        while node[0] is not None:
            branches = node[1]
            node = branches.get(text[node[0]]) or next(iter(branches.values()))
        if node[1] == text:
            node[2].append(member)
            return
        place = next(k for k, (a, b) in enumerate(zip(text, node[1])) if a != b)
        other = node[1][place]
        parent, node = None, self.root
        while node[0] is not None and node[0] < place:
            parent, node = node, node[1][text[node[0]]]
        if node[0] == place:
            node[1][text[place]] = [None, text, [member]]
            return
        fork = [place, {other: node, text[place]: [None, text, [member]]}]
        if parent is None:
            self.root = fork
        else:
            parent[1][text[parent[0]]] = fork

    def classes(self) -> Iterator[list[int]]:
        """The members of each string, in the order of the strings."""
        open_nodes = [self.root] if self.root else []
        while open_nodes:
            node = open_nodes.pop()
            if node[0] is None:
                yield node[2]
            else:
                open_nodes += [child for _, child in sorted(node[1].items(), reverse=True)]


def equal_suffixes(data: bytes, places: np.ndarray, owners: np.ndarray, match: int) -> Iterator[list[int]]:
    """Classes of two or more ``places`` whose suffixes share ``match`` bytes, in suffix order.

    Deep-shallow sorting. Runs whose suffixes all belong to one of ``owners`` are not gone into.
    """
    bytes_of = np.frombuffer(data + bytes(SHALLOW), np.uint8).astype(np.uint64)
    word = np.zeros(len(bytes_of) - 7, np.uint64)
    for k in range(8):
        word |= bytes_of[k : k + len(word)] << np.uint64(56 - 8 * k)
    index = np.arange(len(places))
    group = np.zeros(len(places), np.int64)
    depth = 0
    while depth < min(SHALLOW, match) and len(index):
        key = word[places[index] + depth]
        if depth + 8 > match:  # bytes beyond the match do not count
            key = key >> np.uint64(8 * (depth + 8 - match))
        order = np.lexsort((key, group))
        index, group, key = index[order], group[order], key[order]
        fresh = np.concatenate(([True], (group[1:] != group[:-1]) | (key[1:] != key[:-1])))
        starts = np.flatnonzero(fresh)
        counts = np.diff(np.append(starts, len(index)))
        who = owners[index]
        several = np.minimum.reduceat(who, starts) != np.maximum.reduceat(who, starts)
        kept = np.repeat(several, counts)
        group = np.repeat(np.arange(len(starts)), counts)[kept]
        index = index[kept]
        depth += 8
    if not len(index):
        return
    starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    at = places[index].tolist()
    for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(index)]):
        trie = _BlindTrie()
        for k in range(lo, hi):
            trie.add(data[at[k] : at[k] + match], k)
        for members in trie.classes():
            if len(members) > 1:
                yield index[members].tolist()


_SPANS = "doc long, row long, spans array<long>"


def _runs(docs: np.ndarray, rows: np.ndarray, begins: np.ndarray, stops: np.ndarray) -> pa.RecordBatch:
    """The maximal runs of each text as begins and stops in turn."""
    order = np.lexsort((begins, rows, docs))
    docs, rows, begins, stops = docs[order], rows[order], begins[order], stops[order]
    fresh = np.concatenate(([True], (docs[1:] != docs[:-1]) | (rows[1:] != rows[:-1])))
    text = np.cumsum(fresh) - 1
    # Each text lies behind the one before, so that one running maximum serves all.
    wide = int(stops.max()) + 1
    reach = np.maximum.accumulate(text * wide + stops)
    cut = np.concatenate(([True], (text * wide + begins)[1:] > reach[:-1]))
    ends = np.append(np.flatnonzero(cut)[1:] - 1, len(text) - 1)
    runs = np.stack([begins[cut], reach[ends] - text[ends] * wide], axis=1)
    counts = np.bincount(text[cut], minlength=text[-1] + 1)
    columns = [pa.array(docs[fresh]), pa.array(rows[fresh]), _lists(runs.ravel(), 2 * counts)]
    return pa.RecordBatch.from_arrays(columns, ["doc", "row", "spans"])


def _sort_units(match: int):
    """From rows in order of their place: the spans of the texts that repeat from smaller ids."""

    def spans_of(whole: pa.Table) -> pa.RecordBatch | None:
        anchors, docs, rows = (whole.column(c).to_numpy() for c in ("anchor", "doc", "row"))
        regions = whole.column("region").to_pylist()
        lists = whole.column("starts").combine_chunks()
        counts = lists.value_lengths().to_numpy()
        starts = lists.flatten().to_numpy()
        number: dict[bytes, int] = {}
        unit = np.array([number.setdefault(r, len(number)) for r in regions])
        texts = list(number)
        least = np.full(len(texts), np.iinfo(np.int64).max)
        np.minimum.at(least, unit, docs)
        anchor = np.zeros(len(texts), np.int64)
        anchor[unit] = anchors
        # Only an anchor with several units has windows that differ from unit to unit.
        order = np.argsort(anchor, kind="stable")
        firsts = np.flatnonzero(np.concatenate(([True], np.diff(anchor[order]) != 0)))
        several = np.diff(np.append(firsts, len(order)))
        mixed = order[np.repeat(several > 1, several)]
        lengths = np.array([len(texts[u]) for u in mixed], np.int64)
        windows = lengths - match + 1
        owner = np.repeat(mixed, windows)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
        places = np.repeat(np.cumsum(lengths) - lengths, windows) + inside
        earlier: dict[int, list[int]] = {}
        for members in equal_suffixes(b"".join(texts[u] for u in mixed), places, owner, match):
            smallest = min(least[owner[m]] for m in members)
            for m in members:
                if smallest < least[owner[m]]:
                    earlier.setdefault(int(owner[m]), []).append(int(inside[m]))
        row = np.repeat(np.arange(len(docs)), counts)  # of each start
        later = (docs > least[unit])[row]
        size = np.array([len(t) for t in texts], np.int64)[unit[row]]
        owners, begins, stops = [row[later]], [starts[later]], [(starts + size)[later]]
        if earlier:
            for k in np.flatnonzero(~later & np.isin(unit[row], list(earlier))).tolist():
                at = starts[k] + np.array(earlier[int(unit[row[k]])], np.int64)
                owners.append(np.full(len(at), row[k]))
                begins.append(at)
                stops.append(at + match)
        of = np.concatenate(owners)
        if not len(of):
            return None
        return _runs(docs[of], rows[of], np.concatenate(begins), np.concatenate(stops))

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, last = 0, None

        def work() -> Iterator[pa.RecordBatch]:
            found = spans_of(pa.Table.from_batches(held)) if size else None
            if found is not None:
                yield from (found.slice(k, 16_384) for k in range(0, found.num_rows, 16_384))

        for batch in batches:
            if not batch.num_rows:
                continue
            places = batch.column("place").to_numpy()
            if size >= _TOGETHER:
                changed = np.flatnonzero(places != last)
                cut = int(changed[0]) if len(changed) else batch.num_rows
                if cut < batch.num_rows:
                    held.append(batch.slice(0, cut))
                    yield from work()
                    held, size, batch = [], 0, batch.slice(cut)
            held.append(batch)
            size += batch.num_rows
            last = places[-1]
        yield from work()

    return compute


def _hot_spans(hot: DataFrame, match: int) -> DataFrame:
    """Spans of the units of hot anchors, by merging equal units and windows."""
    merged = materialize(hot.groupBy("region").agg(F.min("doc").alias("least")), "hot-units")
    windows = merged.select(
        "region", "least", F.explode(F.sequence(F.lit(0), F.length("region") - match)).alias("at")
    ).withColumn("window", F.expr(f"substring(region, at + 1, {match})"))
    firsts = windows.groupBy("window").agg(F.min("least").alias("first"))
    # A window of a common passage is in the units of many documents.
    hits = join_spread(windows, firsts, ["window"], "region").where("first < least")
    earlier = hits.groupBy("region").agg(F.collect_list("at").alias("at"))  # one unit's windows
    known = materialize(merged.join(earlier, "region", "left"), "hot-windows")
    # Regions are larger than their compressed files, by which a broadcast would be chosen.
    placed = hot.join(known.hint("merge"), "region")
    later = placed.where("doc > least").select(
        "doc", "row",
        F.expr("flatten(transform(starts, s -> array(s, s + length(region))))").alias("spans"),
    )
    own = f"flatten(transform(starts, s -> flatten(transform(at, a -> array(s + a, s + a + {match})))))"
    first = placed.where("doc = least AND at IS NOT NULL").select("doc", "row", F.expr(own).alias("spans"))
    return later.unionByName(first)


def _copies(rows: DataFrame, match: int) -> DataFrame:
    """``(doc, row, size)`` of the texts that copy the whole text of a smaller id."""
    size = F.octet_length("text").cast("long")
    narrow = rows.select("doc", "row", F.sha2("text", 256).alias("same"), size.alias("size"))
    narrow = materialize(narrow.where(F.col("size") >= match), "texts")
    firsts = materialize(narrow.groupBy("same").agg(F.min("doc").alias("first")), "firsts")
    later = narrow.join(firsts, "same").where("first < doc").select("doc", "row", "size").distinct()
    return materialize(later, "copies")


def repeated_spans(
    docs: DataFrame, match: int = MATCH, local: int = LOCAL, hot_docs: int = HOT
) -> DataFrame:
    """``(doc, row, spans)``: spans of each text that repeat, as begins and stops in turn.

    ``row`` is the hash of the text, since rows may repeat an id. A text may have several rows, and
    spans may overlap.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), whole_text().alias("text"))
    rows = rows.where("doc IS NOT NULL").select("doc", F.xxhash64("text").alias("row"), "text")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(reader_slots(spark), total // PART_BYTES + 1)
    copies = _copies(rows, match)
    sent = map_arrow(rows.select("doc", "text"), _send_hashes(match, parts, local), _MET)
    dealt = sent.repartition(parts, "bucket").sortWithinPartitions("bucket")
    met = map_arrow(dealt, _meet(hot_docs), "doc long, anchor long, source long")
    shared = materialize(met, "shared")
    heavy = shared.where("source IS NOT NULL").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    pieces = F.ceil(F.col("n") / PLACE_ROWS)
    heavy = heavy.where(F.col("n") > PLACE_ROWS).select("source", pieces.alias("pieces"))
    # Stored, so that a hot source does not stay where it was counted.
    heavy = materialize(heavy, "heavy")
    piece = F.pmod("anchor", F.coalesce("pieces", F.lit(1).cast("long")))
    is_hot = F.col("source").isNull()
    cold = F.struct("anchor", F.xxhash64("source", piece).alias("place"))
    lists = shared.join(heavy, "source", "left").groupBy("doc").agg(
        F.collect_list(F.when(~is_hot, cold)).alias("cold"),
        F.collect_list(F.when(is_hot, F.col("anchor"))).alias("hot"),
    )
    # The units of a whole copy say nothing that those of the first document do not say.
    firsts = rows.join(copies.select("doc", "row"), ["doc", "row"], "left_anti")
    joined = firsts.join(lists, "doc").select("doc", "row", "text", "cold", "hot")
    units_path = temporary_path(spark, "units")
    made = map_arrow(joined, _send_units(match), _UNIT)
    made.write.option("compression", "zstd").parquet(units_path)
    found = spark.read.schema(_UNIT).parquet(units_path)
    cold_units = found.where("place IS NOT NULL").repartition(parts, "place").sortWithinPartitions("place")
    spans = map_arrow(cold_units, _sort_units(match), _SPANS)
    hot = _hot_spans(found.where("place IS NULL").select("doc", "row", "starts", "region"), match)
    whole = F.array(F.lit(0).cast("long"), F.col("size")).alias("spans")
    return spans.unionByName(hot).unionByName(copies.select("doc", "row", whole))


def _merged(spans: list[int], size: int) -> list[tuple[int, int]]:
    """Maximal runs covered by the spans, given as begins and stops in turn."""
    pairs = np.array(spans, np.int64).reshape(-1, 2)
    if not len(pairs):
        return []
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    reach = np.maximum.accumulate(pairs[:, 1])
    cut = np.flatnonzero(np.concatenate(([True], pairs[1:, 0] > reach[:-1])))
    stops = reach[np.append(cut[1:] - 1, len(pairs) - 1)]
    return [(a, min(b, size)) for a, b in zip(pairs[cut, 0].tolist(), stops.tolist())]


def cut_repeats(
    docs: DataFrame,
    match: int = MATCH,
    with_text: bool = True,
    local: int = LOCAL,
    hot_docs: int = HOT,
) -> DataFrame:
    """``docs`` with its repeats removed and ``(n_bytes, n_removed, n_spans, kept_sha256)``.

    With ``with_text`` the column ``kept`` holds the remaining text; characters that a cut splits go.
    """
    at, key, row, body = (free_name(docs, n) for n in ("_spans", "_doc", "_row", "_body"))
    found = repeated_spans(docs, match, local, hot_docs)
    found = found.groupBy(F.col("doc").alias(key), F.col("row").alias(row))
    spans = found.agg(F.flatten(F.collect_list("spans")).alias(at))
    kept = [c for c in docs.columns if c.lower() not in (*CUT_COLUMNS, "kept")]
    rows = docs.select(*kept).withColumn(body, whole_text())
    same = (F.col("doc_id").cast("long") == F.col(key)) & (F.xxhash64(body) == F.col(row))
    rows = rows.join(spans, same, "left")
    passed = [c for c in kept if c != "text"]
    names = [*CUT_COLUMNS, *(["kept"] if with_text else [])]

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            out: list[tuple] = []
            for text, own in zip(_bytes_of(batch.column(body)), batch.column(at).to_pylist()):
                runs = _merged(own or [], len(text))
                places = [0, *[x for run in runs for x in run], len(text)]
                left = b"".join(text[a:b] for a, b in zip(places[::2], places[1::2]))
                row = len(text), len(text) - len(left), len(runs), hashlib.sha256(left).hexdigest()
                out.append((*row, left.decode(errors="ignore")) if with_text else row)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            columns = [pa.array(x, kind) for x, kind in zip(zip(*out), kinds)]
            if batch.num_rows:
                own = [batch.column(c) for c in passed]
                yield pa.RecordBatch.from_arrays([*own, *columns], [*passed, *names])

    kinds = dict(docs.dtypes)
    schema = ", ".join(
        [f"`{c}` {kinds[c]}" for c in passed]
        + ["n_bytes long", "n_removed long", "n_spans long", "kept_sha256 string"]
        + ["kept string"] * with_text
    )
    return map_arrow(rows.select(*passed, body, at), compute, schema)


CUT_COLUMNS = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
