"""Best-fit packing of token sequences, hierarchical by residuals.

Every text becomes its token ids and an end token. Only a document longer than ``capacity`` is cut, into
pieces of ``capacity`` tokens of which the first may be shorter; so a document has at most one piece
that shares a sequence, and full pieces are sequences of their own.

1. The short pieces are dealt over partitions of some ``PART_PIECES``. Each partition packs its own, best
   fit in descending length. Bins with ``nearly`` or fewer free tokens are done.
2. Underfull bins go up a tree of ``FANIN`` children a node as items, and each node packs them best
   fit again. After best fit at most one bin of a node is at most half full, since a second one would
   have gone into it; two fuller ones never fit together. So a node can merge at most ``FANIN``
   small bins, and needs no more than that many receivers of each fill from a child. The others are
   done where they are: what goes up has a bound, and it is what the best fit over all of them would use.
3. The merges, at most one for each partition, are joined to the pieces: new sequence, new offset.

Defined results: a null text counts as empty, and an empty text is the end token alone; rows that repeat an
id, with or without the same text, are packed each for itself; a row without id is packed like any other
and keeps the null; ties go to the row read first; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidings.llm.bpe import _byte_letters
from tidings.llm.common import map_arrow, whole_text
from tidings.session import materialize

CAPACITY = 1024
END = 2
#: Short pieces that one task packs.
PART_PIECES = 50_000
FANIN = 8
#: Free tokens up to which a bin is nearly full.
NEARLY = 4
#: Texts whose pieces are sent on together.
_TEXTS = 64
#: How byte-level BPE splits a text; a fixed value.
SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
_LONG_WHITE = re.compile(r"\s{5000}")

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class _Encoder:
    """Ids as the tokenizers library gives them for a file of byte-level BPE.

    ``tiktoken`` finds the same ids in a fifth of the time where ids are in the order of the merges. It
    knows no special tokens, and very long white space overflows its stack; such texts, and files of
    another kind, go to the tokenizers library itself.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        self.special = [t["content"] for t in data["added_tokens"]]
        letters = {letter: byte for byte, letter in enumerate(_byte_letters())}
        vocab, merges = data["model"]["vocab"], data["model"]["merges"]
        pairs = [m if isinstance(m, str) else "".join(m) for m in merges]
        in_order = all(vocab[p.replace(" ", "")] == 256 + k for k, p in enumerate(pairs))
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        usual = data["normalizer"] is None and plain.items() <= (data["pre_tokenizer"] or {}).items()
        self.fast = None
        if in_order and usual:
            ranks = {bytes(letters[c] for c in token): rank for token, rank in vocab.items()}
            self.fast = tiktoken.Encoding(
                "own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}
            )

    def __call__(self, text: str) -> list[int]:
        if self.fast is None or any(t in text for t in self.special) or _LONG_WHITE.search(text):
            return self.whole.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


@lru_cache(maxsize=1)
def _encoder(name: str) -> _Encoder:
    """One encoder for each worker process."""
    return _Encoder(SparkFiles.get(name))


def cuts(length: int, capacity: int) -> list[tuple[int, int]]:
    """Begin and length of each piece of a document of ``length`` tokens, at least one."""
    first = (length - 1) % capacity + 1
    return [(0, first), *((at, capacity) for at in range(first, length, capacity))]


def pieces(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = False
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)`` of every piece, and its ``ids`` if wanted.

    The file at ``path`` is sent to the executors.
    """
    docs.sparkSession.sparkContext.addFile(path)
    name = os.path.basename(path)

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _encoder(name)
        for batch in batches:
            for at in range(0, batch.num_rows, _TEXTS):
                part = batch.slice(at, _TEXTS)
                rows, kept = [], []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = np.array([*own(text), end], "<u4")
                    for k, (start, length) in enumerate(cuts(len(ids), capacity)):
                        cut = ids[start : start + length]
                        rows.append((doc, k, start, length, zlib.crc32(cut.tobytes())))
                        if with_ids:
                            kept.append(cut.astype(np.int32))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                columns = [pa.array(x, kind) for x, kind in zip(zip(*rows), kinds)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(kept, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return map_arrow(rows, compute, _PIECE + ", ids array<int>" * with_ids)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of each item, in descending length; equal ones in the given order.

    Bins of equal room are a stack; a whole number has a bit for each room that has one, so
    the least room that an item fits in is found by a shift.
    """
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, count = 0, 0
    for item in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[item])
        able = rooms >> length
        if able:
            room = length + (able & -able).bit_length() - 1
            place = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            room, place, count = capacity, count, count + 1
        bins[item], offsets[item] = place, capacity - room
        open_bins[room - length].append(place)
        rooms |= 1 << (room - length)
    return bins, offsets


def _whole(batches: Iterable[pa.RecordBatch]) -> pa.Table | None:
    parts = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(parts) if parts else None


_PLACED = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"


def _pack_pieces(capacity: int):
    """Best fit of a partition's pieces; ``used`` is the fill of the whole bin."""

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _whole(batches)
        if table is None:
            return
        table = table.sort_by("row")
        lengths = table.column("length").to_numpy()
        bins, offsets = best_fit(lengths, capacity)
        used = np.bincount(bins, lengths).astype(np.int64)
        node = TaskContext.get().partitionId()
        for name, values in (("bin", (node << 33) + bins), ("offset", offsets), ("used", used[bins])):
            table = table.append_column(name, pa.array(values, pa.int64()))
        table = table.append_column("node", pa.array(np.full(len(bins), node, np.int64)))
        yield from table.to_batches(65_536)

    return compute


def _pack_bins(capacity: int):
    """Best fit of the bins of each node: bin, the bin it is part of now, its offset there, and that one's fill."""

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _whole(batches)
        if table is None:
            return
        table = table.sort_by("bin")
        nodes, names, used = (table.column(c).to_numpy() for c in ("node", "bin", "used"))
        for node in np.unique(nodes).tolist():
            own = np.flatnonzero(nodes == node)
            bins, offsets = best_fit(used[own], capacity)
            fill = np.bincount(bins, used[own]).astype(np.int64)
            base = np.zeros(len(fill), np.int64)
            base[bins[offsets == 0]] = names[own][offsets == 0]
            columns = [np.full(len(own), node), names[own], base[bins], offsets, fill[bins]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["node", "bin", "into", "shift", "used"]
            )

    return compute


def _going_up(bins: DataFrame, capacity: int, nearly: int) -> DataFrame:
    """The underfull bins that a parent may need: ``FANIN`` of each fill and node."""
    order = Window.partitionBy("node", "used").orderBy("bin")
    under = bins.where(F.col("used") < capacity - nearly)
    chosen = under.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= FANIN)
    return chosen.select(
        F.floor(F.col("node") / FANIN).cast("long").alias("node"), "bin", "used"
    )


def pack(
    found: DataFrame, capacity: int = CAPACITY, nearly: int = NEARLY, part_pieces: int = PART_PIECES
) -> DataFrame:
    """``found`` (as ``pieces`` makes it) with ``sequence_id`` and ``offset`` of each piece."""
    stored = materialize(found.withColumn("row", F.monotonically_increasing_id()), "pieces")
    narrow = [c.split()[0] for c in _PLACED.split(", ")]
    short = stored.where(F.col("length") < capacity).select(*narrow)
    parts = max(1, -(-short.count() // part_pieces))
    schema = _PLACED + ", bin long, offset long, used long, node long"
    dealt = short.repartition(parts, "row")
    placed = materialize(map_arrow(dealt, _pack_pieces(capacity), schema), "packed")
    bins = placed.where("offset = 0").select("node", "bin", "used")
    merges = []
    # A run may have more partitions than asked for.
    nodes = (placed.agg(F.max("node")).first()[0] or 0) + 1
    while nodes > 1:
        nodes = -(-nodes // FANIN)
        up = _going_up(bins, capacity, nearly).repartition(nodes, "node")
        packed = map_arrow(up, _pack_bins(capacity), "node long, bin long, into long, shift long, used long")
        packed = materialize(packed, "merged")
        merges.append(packed.where("bin != into").select("bin", "into", "shift"))
        bins = packed.where("bin = into").select("node", "bin", "used")
    kept = placed.select(*narrow, "bin", "offset")
    for moved in merges:
        kept = kept.join(moved, "bin", "left").select(
            *narrow,
            F.coalesce("into", "bin").alias("bin"),
            (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
        )
    # Full pieces have odd numbers, shared sequences even ones.
    full = stored.where(F.col("length") >= capacity).select(
        *narrow, (F.col("row") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    every = kept.select(*narrow, (F.col("bin") * 2).alias("sequence_id"), "offset").unionByName(full)
    rest = [c for c in stored.columns if c not in narrow]
    if rest:
        every = every.join(stored.select("row", *rest), "row")
    return every.drop("row")
