"""Prefix trie of conversations by truncation peeling.

A conversation is a sequence of turns; a node of the trie is a distinct sequence of first turns.

1. Turns are put in order by a sort over ranges, so that a conversation of any length is dealt over
   tasks, and numbered by their place in the range and the rows of the ranges before. Only
   the SHA-256 of a turn and its number of words go on; texts are not shuffled whole.
2. ``rebuilt`` gives conversations their first turns from another one. Running sums of 128 bits of hash of
   (depth, turn) name each prefix; long conversations add them up in stretches of ``STRETCH`` turns.
3. Equal conversations merge to one with a count. Beyond the deepest prefix that two different
   ones share, a conversation is a bare chain, whose figures are running sums: any depth takes one step.
4. From there the peeling descends: at each depth the conversations that end there join the surviving
   nodes, the last turn is stripped and what is left regroups by its prefix. Grouping finds the nodes
   and adds up members, leaves and saved words at once. Depths at which no conversation ends and no
   node has two children are stripped together, so a job is a depth at which something happens.

Defined results: a null role or text counts as empty; rows without ``conv_id`` take no part; turns of equal
number come in the order of role and text (their first ``HEAD`` characters, then the hash), null
numbers first; rows that repeat are turns of their own; a conversation without turns is at the root; an
empty table has no nodes; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidings.llm.common import map_arrow, reader_slots, whole_text, words_of
from tidings.session import materialize

#: First turns that the query takes from another conversation are at most this many.
HEADS = 3
GROUP = 20
HEAD = 100
STRETCH = 65_536
#: Ids that one row of a member list holds at most.
CHUNK_IDS = 65_536

_KEY = ("k1", "k2")
_ABOVE = ("p1", "p2")


def turn_sha256(role: str = "role", text: str = "text") -> Column:
    """SHA-256 of a turn; the length keeps role and text apart."""
    who = whole_text(role)
    return F.unhex(F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, whole_text(text)), 256))


def ordered_turns(rows: DataFrame) -> DataFrame:
    """``(conv_id, pos, turn_sha256, words)``: each conversation's turns, numbered from 1."""
    order = ["conv_id", F.col("turn").asc_nulls_first(), "_role", "_text", "turn_sha256"]
    turns = rows.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.substring(whole_text("role"), 1, HEAD).alias("_role"),
        F.substring(whole_text("text"), 1, HEAD).alias("_text"),
        turn_sha256().alias("turn_sha256"),
        F.size(words_of(whole_text("text"))).cast("long").alias("words"),
    )
    # The parts are written in order; the place of a row in its part is stored with it.
    dealt = turns.repartitionByRange(reader_slots(rows.sparkSession), *order)
    placed = dealt.sortWithinPartitions(*order).select(
        "conv_id", "turn_sha256", "words",
        F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_row"),
    )
    placed = materialize(placed, "turns")
    runs = placed.groupBy("conv_id", "_part").agg(
        F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_size")
    )
    earlier = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    begins = runs.select(
        "conv_id", "_part",
        (F.coalesce(F.sum("_size").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_begin"),
    )
    return placed.join(begins, ["conv_id", "_part"]).select(
        "conv_id", (F.col("_row") + F.col("_begin")).alias("pos"), "turn_sha256", "words"
    )


def rebuilt(turns: DataFrame, group: int = GROUP, heads: int = HEADS) -> DataFrame:
    """``(conv_id, depth, turn_sha256, words, len)`` of conversations with the first turns of another.

    Conversation c takes the first h = crc32(c) mod (heads + 1) turns of c - c % group, or all of
    them, and goes on with its own turns behind its first h. One without turns has a row of depth 0.
    """
    stored = materialize(turns, "numbered")
    sizes = stored.groupBy("conv_id").agg(F.count(F.lit(1)).alias("size"))
    asked = F.crc32(F.col("conv_id").cast("string")) % (heads + 1)
    convs = sizes.select(
        "conv_id", "size", asked.alias("h"),
        (F.col("conv_id") - F.col("conv_id") % group).alias("base"),
    )
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("size").alias("base_size"))
    taken = F.least("h", F.coalesce("base_size", F.lit(0)))
    convs = convs.join(bases, "base", "left").select(
        "conv_id", "base", "h", taken.alias("taken"),
        (taken + F.greatest(F.col("size") - F.col("h"), F.lit(0))).alias("len"),
    )
    # Stored, so that the joins below have plain shuffles on both sides and can split a long conversation.
    convs = materialize(convs, "conversations")
    own = stored.join(convs, "conv_id").where("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("depth"), "turn_sha256", "words", "len"
    )
    first = stored.where((F.col("pos") <= heads) & (F.col("conv_id") % group == 0))
    first = first.withColumnRenamed("conv_id", "base")
    given = convs.join(first, "base").where("pos <= h").select(
        "conv_id", F.col("pos").alias("depth"), "turn_sha256", "words", "len"
    )
    none = convs.where("len = 0").select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("turn_sha256"),
        F.lit(0).cast("long").alias("words"), "len",
    )
    return own.unionByName(given).unionByName(none)


def _named(sums: list[Column], depth: Column, names: tuple[str, str]) -> list[Column]:
    """The two halves of a prefix's name, from its sums of hashes."""
    return [F.xxhash64(depth, *sums).alias(names[0]), F.xxhash64(*reversed(sums), depth).alias(names[1])]


def prefixes(sequences: DataFrame) -> DataFrame:
    """``sequences`` with the names of each row's prefix and of the one above, and words so far."""
    halves = [F.xxhash64("depth", "turn_sha256"), F.xxhash64("turn_sha256", "depth", F.lit(1))]
    low = [half.bitwiseAND(F.lit(0xFFFFFFFF)) for half in halves]
    high = [F.shiftrightunsigned(half, 32) for half in halves]
    names = ["s0", "s1", "s2", "s3", "total"]
    real = F.col("depth") > 0
    values = [*(F.when(real, x).otherwise(0) for x in (*low, *high)), F.col("words")]
    rows = sequences.withColumn("_stretch", F.floor((F.col("depth") - 1) / STRETCH))
    rows = rows.select("*", *(v.alias(f"_{n}") for n, v in zip(names, values)))
    within = Window.partitionBy("conv_id", "_stretch").orderBy("depth")
    rows = rows.select("*", *(F.sum(f"_{n}").over(within).alias(n) for n in names))
    whole = rows.groupBy("conv_id", "_stretch").agg(*(F.sum(f"_{n}").alias(n) for n in names))
    earlier = Window.partitionBy("conv_id").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    before = whole.select("conv_id", "_stretch", *(F.sum(n).over(earlier).alias(f"_b{n}") for n in names))
    joined = rows.join(before.where("_stretch > 0"), ["conv_id", "_stretch"], "left")
    sums = [F.col(n) + F.coalesce(f"_b{n}", F.lit(0)) for n in names]
    above = [total - F.col(f"_{n}") for total, n in zip(sums[:4], names)]
    depth = F.col("depth")
    return joined.select(
        "conv_id", "depth", "len", "turn_sha256", "words", sums[4].alias("so_far"),
        *_named(sums[:4], depth, _KEY), *_named(above, depth - 1, _ABOVE),
    )


_PLACE = ("depth", *_KEY, *_ABOVE, "turn_sha256", "words", "so_far")
_NODE = (*_PLACE, "conv_id", "n_convs", "n_children", "n_leaves", "saved_words")


def _level(ended: DataFrame, surviving: DataFrame) -> DataFrame:
    """The nodes of a depth: conversations that end there and stripped ones from below, regrouped."""
    zero = F.lit(0).cast("long")
    shape = [*_PLACE, "conv_id", "n_convs"]
    fresh = ended.select(*shape, *(zero.alias(n) for n in ("leaves", "saved", "child")))
    groups = fresh.unionByName(surviving.select(*shape, "leaves", "saved", "child")).groupBy(*_KEY).agg(
        *(F.min(n).alias(n) for n in ("depth", *_ABOVE, "turn_sha256", "words", "so_far", "conv_id")),
        *(F.sum(n).alias(n) for n in ("n_convs", "leaves", "saved", "child")),
    )
    return groups.select(
        *_PLACE, "conv_id", "n_convs",
        F.col("child").alias("n_children"),
        F.when(F.col("child") == 0, 1).otherwise(F.col("leaves")).cast("long").alias("n_leaves"),
        (F.col("saved") + (F.col("n_convs") - 1) * F.col("words")).alias("saved_words"),
    )


def _events(rows: DataFrame) -> tuple[int, list[int]]:
    """The deepest depth that different conversations share, and the depths to stop at, deepest first.

    These are the root and depths at which one ends or a node has several children. They are few:
    conversations of n different lengths have n * n / 2 turns at least.
    """
    nodes = rows.groupBy(*_KEY).agg(
        *(F.min(n).alias(n) for n in ("depth", *_ABOVE)),
        F.count(F.lit(1)).alias("n"), F.max(F.col("depth") == F.col("len")).alias("ends"),
    )
    depth = F.col("depth")
    families = nodes.groupBy(*_ABOVE).agg(
        F.min("depth").alias("depth"), F.count(F.lit(1)).alias("children"),
        F.max("n").alias("n"), F.max("ends").alias("ends"),
    )
    found = families.agg(
        F.max(F.when(F.col("n") > 1, depth)).alias("deepest"),
        F.collect_set(F.when(F.col("children") > 1, depth - 1)).alias("branches"),
        F.collect_set(F.when(F.col("ends"), depth)).alias("ends"),
    ).first()
    deepest = found.deepest or 0
    stops = {0, *found.branches, *found.ends}
    return deepest, sorted((d for d in stops if 0 <= d <= deepest), reverse=True)


def trie(sequences: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and ends of the trie of ``(conv_id, depth, turn_sha256, words, len)``.

    Nodes: ``conv_id`` (smallest member), ``depth``, ``turn_sha256`` of the last turn, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_words`` and the name ``k1, k2``. Ends: name and
    ``conv_id`` of every conversation that ends in a node.
    """
    named = materialize(prefixes(sequences), "prefixes")
    ends = named.where("depth = len").select(*_KEY, "conv_id", "so_far")
    kinds = ends.groupBy(*_KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("so_far").alias("total")
    )
    kinds = materialize(kinds.select("conv_id", "n_convs", "total"), "kinds")
    # One conversation of each kind stands for all.
    rows = named.join(kinds, "conv_id").sortWithinPartitions("depth")
    rows = materialize(rows, "different")
    deepest, stops = _events(rows)
    one, copies = F.lit(1).cast("long"), F.col("n_convs") - 1
    # A chain: the copies share all of it, others nothing.
    bare = rows.where(F.col("depth") > deepest).select(
        *_PLACE, "conv_id", "n_convs",
        (F.col("depth") < F.col("len")).cast("long").alias("n_children"),
        one.alias("n_leaves"),
        (copies * (F.col("total") - F.col("so_far") + F.col("words"))).alias("saved_words"),
    )
    found = [bare]
    below, at = bare.where(F.col("depth") == deepest + 1), deepest + 1
    for depth in stops:
        carried = below.select(
            "conv_id", "n_convs", F.col("n_leaves").alias("leaves"), "saved_words",
            (F.col("so_far") - F.col("words")).alias("_before"),
        )
        # The depths between: one child each, and the words of the turns stripped so far.
        between = rows.where((F.col("depth") > depth) & (F.col("depth") < at)) if depth + 1 < at else None
        if between is not None:
            own = F.col("_before") - F.col("so_far") + F.col("words")
            filled = carried.join(between.select("conv_id", *_PLACE), "conv_id").select(
                *_PLACE, "conv_id", "n_convs", one.alias("n_children"), F.col("leaves").alias("n_leaves"),
                (F.col("saved_words") + copies * own).alias("saved_words"),
            )
            found.append(filled)
        here = rows.where(F.col("depth") == depth)
        if depth:
            places = here.select("conv_id", *_PLACE)
            surviving = carried.join(places, "conv_id")
        else:
            zero = F.lit(0).cast("long")
            surviving = carried.select(
                "*", zero.alias("depth"), *_named([zero] * 4, zero, _KEY), *_named([zero] * 4, zero - 1, _ABOVE),
                F.lit(None).cast("binary").alias("turn_sha256"), zero.alias("words"), zero.alias("so_far"),
            )
        saved = F.col("saved_words") + copies * (F.col("_before") - F.col("so_far"))
        surviving = surviving.select("*", saved.alias("saved"), one.alias("child"))
        below, at = materialize(_level(here.where("depth = len"), surviving), "depth"), depth
        found.append(below)
    nodes = found[0]
    for level in found[1:]:
        nodes = nodes.unionByName(level)
    nodes = materialize(nodes, "nodes")
    parents = nodes.select(
        F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id")
    )
    linked = nodes.join(parents, list(_ABOVE), "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_words",
        "turn_sha256", *_KEY,
    )
    return linked, ends.select(*_KEY, "conv_id")


def turn_texts(nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """``nodes`` with ``role`` and ``text`` of the last turn; the root has neither."""
    texts = rows.select(
        turn_sha256().alias("turn_sha256"), whole_text("role").alias("role"), whole_text().alias("text")
    ).dropDuplicates(["turn_sha256"])
    return nodes.join(texts, "turn_sha256", "left")


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows in order: the ids of a node as text, some thousands in a row."""
    at, first, held, out = None, 0, [], []

    def sent() -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        columns = [pa.array(x, kind) for x, kind in zip(zip(*out), kinds)]
        return pa.RecordBatch.from_arrays(columns, [*_KEY, "first", "ids"])

    for batch in batches:
        for a, b, conv in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if (a, b) != at or len(held) == CHUNK_IDS:
                if held:
                    out.append((*at, first, ",".join(held)))
                if len(out) >= 256:
                    yield sent()
                    out.clear()
                at, first, held = (a, b), conv, []
            held.append(str(conv))
    if held:
        out.append((*at, first, ",".join(held)))
    if out:
        yield sent()


def _hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From chunks in order: the SHA-256 of each node's ids with commas between."""
    at, digest, out = None, None, []

    def sent() -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string()]
        columns = [pa.array(x, kind) for x, kind in zip(zip(*out), kinds)]
        return pa.RecordBatch.from_arrays(columns, [*_KEY, "ends_sha256"])

    for batch in batches:
        for a, b, ids in zip(*(batch.column(c).to_pylist() for c in (0, 1, 3))):
            if (a, b) != at:
                if digest:
                    out.append((*at, digest.hexdigest()))
                if len(out) >= 4096:
                    yield sent()
                    out.clear()
                at, digest = (a, b), hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
    if digest:
        out.append((*at, digest.hexdigest()))
    if out:
        yield sent()


def ends_sha256(ends: DataFrame) -> DataFrame:
    """``(k1, k2, ends_sha256)`` of the nodes in which conversations end.

    The ids of a node are ordered over ranges and travel to its hash as text of some thousand each,
    so a node of very many members is read as a stream of few rows.
    """
    parts = reader_slots(ends.sparkSession)
    order = [*_KEY, "conv_id"]
    placed = ends.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    chunks = map_arrow(placed, _chunks, "k1 long, k2 long, first long, ids string")
    met = chunks.repartition(parts, *_KEY).sortWithinPartitions(*_KEY, "first")
    return map_arrow(met, _hashed, "k1 long, k2 long, ends_sha256 string")
