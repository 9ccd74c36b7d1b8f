"""Exact links between similar titles published within a day of each other.

The units compared are *nodes*: all articles with the same title tokens on the same UTC day.
Members of one node are always linked, so copies of a title never meet pairwise.

Two different token sets with a Jaccard index of 1/2 or more share a token among the rarest of
each (prefix filter: Bayardo et al., WWW 2007; Xiao et al., WWW 2008). A token carried by many
nodes of a day is *hot*; hot tokens come last in the order. So there are two cases:

* The first shared token is cold. Such nodes meet in groups of equal token and equal or next
  day, which are small.
* It is hot. Then all shared tokens are, and only hot tokens and set sizes matter. Nodes of a
  day with the same hot tokens and size are a *clique* if the hot tokens alone make them
  similar; near copies of a title collapse to one unit this way. Units with enough hot tokens
  meet in groups of their first shared token and of the two set sizes.

Every member of a group carries a bitmap of its tokens, from which a join of members tells most
pairs that cannot share enough tokens; so few pairs leave the group and fetch their titles.

The hot groups are the first level of a prefix tree. Small groups are compared as they are. The
members of a large one are linked through a few pivots; where they still belong to different
components, and only there, the group is split by the next shared token, and so on for
``levels`` levels. What is large on the last level, or cannot have another shared token, is
compared in pieces, members of different components only. So a title has one key for each prefix
token, and further keys only in groups that are counted as large and open. Nothing is dropped:
every pair of similar nodes is linked directly or was connected before.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidings.functions.text import title_tokens
from tidings.operators.components import connected_components
from tidings.operators.skew import join_spread
from tidings.session import materialize

DAY = 86_400_000_000  # microseconds
ANY_TIME = -1_000_000_000  # bucket in which nodes without a time meet all others
UNDATED_PAIRS = ANY_TIME + 1  # bucket in which a dated single meets undated pairs
VISITOR = 1 << 62  # bit that an id, which is below, has where the node visits the bucket


@dataclass(frozen=True)
class Limits:
    """Sizes that steer the work, not the result."""

    #: nodes of one day that make a token hot; a group holds two days and is large beyond both
    group: int = 64
    #: pivots per large group
    pivots: int = 4
    #: pieces of the comparison of a large group
    pieces: int = 16
    #: shared tokens by which the groups of hot tokens are split at most
    levels: int = 3
    #: members up to which all pairs of a group are looked at, if more than two days of a token
    compared: int = 0

    @property
    def small(self) -> int:
        """Members up to which all pairs of a group are looked at."""
        return max(2 * self.group, self.compared)


#: Comparing a group of some thousand members costs less than splitting it over further keys.
USUAL = Limits(compared=4096)
#: Bitmap of a token set: words of 64 bits.
BITMAP = ["bits_0", "bits_1", "bits_2", "bits_3"]


def title_rows(articles: DataFrame) -> DataFrame:
    """``articles(url_hash, title, published_at)`` with token set, its key, and day.

    An article without tokens gets its own key: it matches nothing, and such rows do not pile
    up on one value.
    """
    tokens = title_tokens(F.col("title"))
    at = F.unix_micros(F.col("published_at").cast("timestamp"))
    rows = articles.select("url_hash", tokens.alias("tokens"), at.alias("at"))
    key = F.when(F.size("tokens") > 0, F.md5(F.array_join("tokens", " ")))
    # Whole days in integers; the remainder is never negative, also before 1970.
    midnight = F.col("at") - F.pmod("at", F.lit(DAY))
    return rows.select(
        "url_hash",
        "tokens",
        "at",
        F.coalesce(key, F.col("url_hash")).alias("title_key"),
        F.coalesce(F.call_function("div", midnight, F.lit(DAY)), F.lit(ANY_TIME)).alias("day"),
    )


def title_nodes(rows: DataFrame) -> DataFrame:
    """One row per token set and day, with an id.

    ``first`` is the smallest ``(time, url_hash)`` of the node, unknown time before all others.
    """
    nodes = (
        rows.groupBy("title_key", "day")
        .agg(
            F.any_value("tokens").alias("tokens"),
            F.min("at").alias("first_at"),
            F.max("at").alias("last_at"),
            F.min(F.struct("at", "url_hash")).alias("first"),
        )
        # Tested here and not on the rows, where the tokens would be computed twice.
        .where(F.size("tokens") > 0)
    )
    # The ids hold because the written table is the only copy that is read.
    return materialize(
        nodes.select(
            F.monotonically_increasing_id().alias("id"), "title_key", "day", "tokens",
            F.size("tokens").alias("len"), "first_at", "last_at", "first",
        ),
        "nodes",
    )


def _within_a_day(a: str, b: str):
    """Whether some members of two nodes are at most a day apart; unknown time is near to all."""
    near = (F.col(f"{a}.first_at") - F.col(f"{b}.last_at") <= DAY) & (
        F.col(f"{b}.first_at") - F.col(f"{a}.last_at") <= DAY
    )
    return F.coalesce(near, F.lit(True))


def _same_title_links(nodes: DataFrame) -> DataFrame:
    """Links between the days of one token set: neighbours in time, and undated to dated."""
    slim = nodes.select("id", "title_key", "day", "first_at", "last_at")
    dated = slim.where(F.col("day") != ANY_TIME)
    # A window per title sees at most one row per day. A run of days starts after a gap of more
    # than a day; all its nodes are linked to the first.
    in_time = Window.partitionBy("title_key").orderBy("day")
    starts = F.coalesce(
        F.col("first_at") - F.lag("last_at").over(in_time) > DAY, F.lit(True)
    )
    runs = dated.withColumn("starts", starts).select(
        "id", F.last(F.when(F.col("starts"), F.col("id")), True).over(in_time).alias("other")
    ).where("id != other")
    undated = slim.where(F.col("day") == ANY_TIME).select(
        "title_key", F.col("id").alias("other")
    )
    stars = dated.join(undated, "title_key")
    return runs.unionByName(stars.select("id", "other"))


def _single_links(nodes: DataFrame) -> DataFrame:
    """Links of one-token titles: two-token titles with that token, and no others."""
    slim = nodes.where("len <= 2").select("id", "len", "tokens", "day", "first_at", "last_at")
    undated = F.col("day") == ANY_TIME
    here = F.array(F.lit(ANY_TIME), F.lit(UNDATED_PAIRS))
    single_buckets = F.when(undated, F.array(F.lit(ANY_TIME))).otherwise(
        F.array(F.col("day") - 1, F.col("day"), F.col("day") + 1, F.lit(UNDATED_PAIRS))
    )
    pair_buckets = F.when(undated, here).otherwise(F.array(F.col("day"), F.lit(ANY_TIME)))
    singles = slim.where("len = 1").select(
        "*", F.explode(single_buckets).alias("bucket"), F.col("tokens")[0].alias("token")
    )
    pairs = slim.where("len = 2").select("*", F.explode("tokens").alias("token"))
    pairs = pairs.select("*", F.explode(pair_buckets).alias("bucket"))
    s, p = singles.alias("s"), pairs.alias("p")
    joined = s.join(p, (F.col("s.token") == F.col("p.token"))
                    & (F.col("s.bucket") == F.col("p.bucket")))
    return joined.where(_within_a_day("s", "p")).select(
        F.col("s.id").alias("id"), F.col("p.id").alias("other")
    )


def _hot_tokens(nodes: DataFrame, limits: Limits) -> DataFrame:
    """Tokens carried by many nodes of some day."""
    per_day = (
        nodes.select("day", F.explode("tokens").alias("token"))
        .groupBy("token", "day")
        .agg(F.count(F.lit(1)).alias("nodes"))
    )
    heat = per_day.groupBy("token").agg(F.max("nodes").alias("heat"))
    return heat.where(F.col("heat") > limits.group)


def _bitmap(tokens, prefix: str = "") -> list:
    """One bit for each token of the rows, in the words of a bitmap; null tokens have none."""
    place = F.pmod(F.xxhash64(tokens), F.lit(64 * len(BITMAP))).cast("int")
    none = F.lit(0).cast("long")

    def word(low: int):
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), place - low)
        inside = tokens.isNotNull() & (place >= low) & (place < low + 64)
        return F.bit_or(F.when(inside, bit).otherwise(none))

    return [word(64 * k).alias(prefix + name) for k, name in enumerate(BITMAP)]


def _ordered_nodes(nodes: DataFrame, limits: Limits) -> DataFrame:
    """Nodes of two or more tokens with their cold and hot tokens, each in the common order.

    They have the bitmap of all tokens and, as ``hot_*``, that of the hot ones.
    """
    exploded = nodes.where("len >= 2").select(
        "id", "day", "len", "first_at", "last_at", F.explode("tokens").alias("token")
    )
    heated = join_spread(exploded, _hot_tokens(nodes, limits), ["token"], "id", "left")
    is_hot = F.col("heat").isNotNull()
    ordered = heated.groupBy("id", "day", "len", "first_at", "last_at").agg(
        F.sort_array(F.collect_list(F.when(~is_hot, F.col("token")))).alias("cold"),
        F.sort_array(F.collect_list(F.when(is_hot, F.struct("heat", "token")))).alias("hot"),
        *_bitmap(F.col("token")),
        *_bitmap(F.when(is_hot, F.col("token")), "hot_"),
    )
    return materialize(ordered.withColumn("hot", F.col("hot.token")), "ordered")


def _cliques(ordered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Units with two or more hot tokens, and the links of the members of cliques.

    Nodes of one day with the same hot tokens and size share at least these tokens. If that
    makes them similar they are one unit: its times are those of all members together, and
    all members are linked to the one that gives the id. Any other node is a unit by itself.
    """
    bits = [F.col(f"hot_{name}").alias(name) for name in BITMAP]
    rows = ordered.where(F.size("hot") >= 2).select(
        "id", "day", "len", "hot", "first_at", "last_at", *bits,
        F.md5(F.array_join("hot", " ")).alias("pattern"),
        (3 * F.size("hot") >= 2 * F.col("len")).alias("similar"),
    )
    alike = rows.where("similar")
    pattern = ["pattern", "len", "day"]
    cliques = alike.groupBy(*pattern).agg(
        F.min("id").alias("unit"),
        F.any_value("hot").alias("hot"),
        F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"),
        *[F.any_value(name).alias(name) for name in BITMAP],
    )
    cliques = materialize(cliques, "cliques")
    # Plain shuffles on both sides: the skew join can split the members of a large clique.
    links = alike.select("id", *pattern).join(cliques.select("unit", *pattern), pattern)
    columns = ["id", "day", "len", "hot", "first_at", "last_at", *BITMAP]
    units = cliques.withColumnRenamed("unit", "id").select(*columns).unionByName(
        rows.where("not similar").select(*columns)
    )
    return units, links.where("id != unit").select("id", F.col("unit").alias("other"))


def _cold_keys(ordered: DataFrame) -> DataFrame:
    """Cold tokens in the prefix of each node: ``(key, id, day, len, want, pos, overlap)``.

    Any partner of two or more tokens shares at least ``max(2, len / 2)`` tokens, so the first
    shared one leaves room for the others behind it. ``want`` is 0: partners of any size.
    """
    overlap = F.greatest(F.lit(2), F.ceil(F.col("len") / 2)).cast("int")
    entries = ordered.select(
        "id", "day", "len", F.posexplode("cold").alias("pos", "token"), *BITMAP
    )
    return entries.where(F.col("pos") <= F.col("len") - overlap).select(
        F.xxhash64(F.lit(0), F.lit(0), "token", F.lit("")).alias("key"),
        "id", "day", "len", F.lit(0).alias("want"), "pos", overlap.alias("overlap"),
        F.col("len").alias("tokens"), *BITMAP,
    )


def _band(size):
    """Number of binary digits of a size."""
    return F.length(F.bin(size))


def _hot_keys(units: DataFrame) -> DataFrame:
    """Hot tokens in the prefix of each unit, for each band of sizes of partners.

    A band holds the sizes between two powers of two; partners are in three bands at most. With
    partners of at least ``n`` tokens the overlap is at least ``(len + n) / 3``, so only units with
    that many hot tokens have a key for them.
    """
    length, hot = F.col("len"), F.size("hot")
    smallest = F.greatest(F.lit(2), F.ceil(length / 2)).cast("int")
    largest = F.least(2 * length, 3 * hot - length)
    bands = F.sequence(_band(smallest), _band(largest))
    least = F.greatest(F.col("smallest"), F.expr("shiftleft(1, want - 1)"))
    overlap = F.ceil((length + least) / 3).cast("int")
    # Positions within the hot tokens; those of the whole set start after the cold ones.
    first = F.explode(F.sequence(F.lit(0), hot - F.col("overlap"))).alias("i")
    return (
        units.where(smallest <= largest)
        .select(
            "id", "day", "len", "hot", smallest.alias("smallest"), F.explode(bands).alias("want"),
            *BITMAP,
        )
        .select("*", overlap.alias("overlap"))
        .where(hot >= F.col("overlap"))
        .select("*", first)
        .select(
            F.xxhash64(
                F.least(_band(length), "want"), F.greatest(_band(length), "want"),
                F.get("hot", F.col("i")),
            ).alias("key"),
            "id", "day", "len", "want", (length - hot + F.col("i")).alias("pos"), "overlap",
            hot.alias("tokens"), *BITMAP,
        )
    )


def _next_keys(members: DataFrame, units: DataFrame, level: int) -> DataFrame:
    """Members of groups of ``level`` shared tokens in groups of one more, in the same buckets.

    Of ``overlap`` shared tokens the next one leaves room for the others behind it.
    """
    hot = F.size("hot")
    here = F.col("pos") - (F.col("len") - hot)
    last = hot - F.greatest(F.col("overlap"), F.lit(level + 1)) + level
    return (
        members.join(units.select("id", "hot"), "id")
        .select("*", here.alias("here"), last.alias("last"))
        .where("here < last")
        .select("*", F.explode(F.sequence(F.col("here") + 1, F.col("last"))).alias("j"))
        .select(
            F.xxhash64("key", F.get("hot", F.col("j"))).alias("key"), "id", "len", "want",
            (F.col("len") - hot + F.col("j")).alias("pos"), "overlap", "tokens", *BITMAP, "bucket",
            "own",
        )
    )


def _members(keys: DataFrame) -> DataFrame:
    """Group keys with time buckets.

    A dated node owns the bucket of its day and visits the next one; two nodes meet where one
    of them is the owner. Undated nodes own the bucket of any time, which dated nodes visit if
    an undated node has the same key.
    """
    undated = F.col("day") == ANY_TIME

    def place(bucket, own):
        return F.struct(bucket.cast("long").alias("bucket"), F.lit(own).alias("own"))

    day = F.col("day")
    places = F.when(undated, F.array(place(day, True))).otherwise(
        F.array(place(day, True), place(day + 1, False))
    )
    # Written, so that its size is known: few keys are broadcast to all others.
    wanted = materialize(keys.where(undated).select("key").distinct(), "wanted")
    anytime = keys.where(~undated).join(wanted, "key", "left_semi")
    columns = ["key", "id", "len", "want", "pos", "overlap", "tokens", *BITMAP]
    return keys.select(*columns, F.inline(places)).unionByName(
        anytime.select(
            *columns, F.lit(ANY_TIME).cast("long").alias("bucket"), F.lit(False).alias("own")
        )
    )


def _groups(members: DataFrame, limits: Limits) -> DataFrame:
    """Groups in which a comparison is possible, with their size and pivots."""
    slice_no = F.pmod(F.xxhash64("id"), F.lit(limits.pivots))
    pivot = F.struct("id", "len", "tokens", *BITMAP)
    pivots = [
        F.min(F.when(F.col("own") & (slice_no == n), pivot)) for n in range(limits.pivots)
    ]
    groups = members.groupBy("key", "bucket").agg(
        F.count(F.lit(1)).alias("size"),
        F.count_if("own").alias("owners"),
        F.array_compact(F.array(*pivots)).alias("pivots"),
    )
    return groups.where("size >= 2 and owners >= 1")


def _may_match(a: str, b: str, level: int):
    """Cheap tests of a pair in a group; true for every similar pair in its first group.

    The group stands for ``level`` shared tokens, the last of them at ``pos``.
    """
    la, lb = F.col(f"{a}.len"), F.col(f"{b}.len")
    reach = F.least(la - F.col(f"{a}.pos"), lb - F.col(f"{b}.pos")) + (level - 1)
    return (2 * F.least(la, lb) >= F.greatest(la, lb)) & (3 * reach >= la + lb)


def _share_enough(a: str, b: str):
    """Whether the bitmaps allow as many shared tokens as similar titles have; never false for these.

    Each bit that only one side has set stands for at least one token that the other has not.
    """
    def shared_at_most(x, y):
        alone = [
            F.bit_count(F.col(f"{x}.{name}").bitwiseAND(F.bitwise_not(F.col(f"{y}.{name}"))))
            for name in BITMAP
        ]
        return F.col(f"{x}.tokens") - sum(alone)

    least = F.least(shared_at_most(a, b), shared_at_most(b, a))
    return 3 * least >= F.col(f"{a}.len") + F.col(f"{b}.len")


def _sizes_agree(a: str, b: str):
    """The size conditions of a hot group, as equalities the join can use."""

    def side(x):
        return F.when(F.col(f"{x}.want") == 0, 0).otherwise(_band(F.col(f"{x}.len")))

    return (side(a) == F.col(f"{b}.want")) & (side(b) == F.col(f"{a}.want"))


def _same_group(a: str, b: str):
    return (F.col(f"{a}.key") == F.col(f"{b}.key")) & (
        F.col(f"{a}.bucket") == F.col(f"{b}.bucket")
    )


def _subjects(nodes: DataFrame, units: DataFrame) -> DataFrame:
    """What is compared: whole nodes in groups of cold keys, hot tokens of units in the others."""
    return nodes.select(
        "id", F.lit(False).alias("is_hot"), "tokens", "len", "first_at", "last_at"
    ).unionByName(
        units.select(
            "id", F.lit(True).alias("is_hot"), F.col("hot").alias("tokens"), "len", "first_at",
            "last_at",
        )
    )


def _verify(pairs: DataFrame, subjects: DataFrame) -> DataFrame:
    """The pairs ``(id, other)`` whose titles are similar and close in time."""
    unique = pairs.select(
        "is_hot", F.least("id", "other").alias("id"), F.greatest("id", "other").alias("other")
    ).where("id != other").distinct()
    p, a, b = unique.alias("p"), subjects.alias("a"), subjects.alias("b")
    joined = p.join(
        a, (F.col("p.id") == F.col("a.id")) & (F.col("p.is_hot") == F.col("a.is_hot"))
    ).join(b, (F.col("p.other") == F.col("b.id")) & (F.col("p.is_hot") == F.col("b.is_hot")))
    shared = F.size(F.array_intersect("a.tokens", "b.tokens"))
    similar = 3 * shared >= F.col("a.len") + F.col("b.len")
    return joined.where(_within_a_day("a", "b") & similar).select("p.id", "p.other")


def _pair(a: str, b: str):
    return [
        (F.col(f"{a}.want") > 0).alias("is_hot"),
        F.col(f"{a}.id").alias("id"),
        F.col(f"{b}.id").alias("other"),
    ]


def _small_group_pairs(small: DataFrame, level: int) -> DataFrame:
    """Candidate pairs of groups of which all members are compared.

    An owner is compared with all visitors and with the owners of larger id. Both sides of the
    join are the same rows, dealt by group alone, so that they are shuffled once: every other
    condition is about both members, and ``place`` puts owners before visitors.
    """
    place = F.when(F.col("own"), F.col("id")).otherwise(F.col("id").bitwiseOR(F.lit(VISITOR)))
    rows = small.select(
        "key", "bucket", place.alias("place"), "len", "want", "pos", "tokens", *BITMAP
    )
    # Sorted by group even where one side is small: a broadcast would be searched by single tasks.
    a, b = rows.alias("a"), rows.hint("merge").alias("b")

    def off(x, y):
        band = F.when(F.col(f"{x}.want") == 0, 0).otherwise(_band(F.col(f"{x}.len")))
        return F.abs(band - F.col(f"{y}.want"))

    owned = F.least("a.place", "b.place") < F.lit(VISITOR)
    pairs = a.join(
        b,
        _same_group("a", "b") & (F.col("a.place") < F.col("b.place")) & owned
        & (off("a", "b") + off("b", "a") == 0) & _may_match("a", "b", level)
        & _share_enough("a", "b"),
    )

    def id_of(x):
        return F.col(f"{x}.place").bitwiseAND(F.lit(VISITOR - 1))

    is_hot = (F.col("a.want") + F.col("b.want") > 0).alias("is_hot")
    return pairs.select(is_hot, id_of("a").alias("id"), id_of("b").alias("other"))


def _large_groups(members: DataFrame, limits: Limits, level: int) -> DataFrame:
    """The groups of more than ``limits.small`` members.

    A cold token has at most ``limits.group`` nodes a day, and so its groups of two days are not counted.
    """
    if level == 1:
        members = members.where((F.col("want") > 0) | (F.col("bucket") == ANY_TIME))
    groups = _groups(members, limits).where(F.col("size") > limits.small)
    return materialize(groups, f"large-groups-{level}")


def _pivot_pairs(large: DataFrame) -> DataFrame:
    """Members of large groups with the pivots they may be similar to."""
    pairs = large.withColumn("p", F.explode("pivots"))
    p = pairs.select(
        F.struct("id", "want", "len", "tokens", *BITMAP).alias("a"), F.col("p").alias("b")
    )
    return p.where(_share_enough("a", "b")).select(
        (F.col("a.want") > 0).alias("is_hot"), F.col("a.id").alias("id"), F.col("b.id").alias("other")
    )


def _open_groups(large: DataFrame, labels: DataFrame, level: int) -> DataFrame:
    """Members of the large groups that have several components, with their own and the main one."""
    labelled = large.join(labels, "id", "left").withColumn(
        "component", F.coalesce("label", "id")
    )
    labelled = materialize(labelled.drop("label", "pivots", "owners"), f"large-{level}")
    counts = labelled.groupBy("key", "bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    main = counts.groupBy("key", "bucket").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"),
        F.count(F.lit(1)).alias("components"),
    )
    main = materialize(main.where("components > 1").drop("components"), f"main-{level}")
    return labelled.join(main, ["key", "bucket"])


def _open_group_pairs(open_groups: DataFrame, limits: Limits, level: int) -> DataFrame:
    """Candidate pairs of open groups between nodes of different components.

    Of two such nodes at least one is outside the group's main component, so only these
    *minor* members are compared with the others, in ``limits.pieces`` pieces per group. Of two
    nodes one must own the bucket: minor owners meet all others, minor visitors the owners.
    A group is cut in no more pieces than it has times ``limits.small`` members.
    """
    pieces = F.least(F.lit(limits.pieces), F.ceil(F.col("size") / limits.small).cast("int"))
    piece = F.pmod(F.xxhash64("id"), pieces).cast("int")
    others = open_groups.withColumn("piece", piece)
    minor = open_groups.where("component != main").withColumn(
        "piece", F.explode(F.sequence(F.lit(0), pieces - 1))
    )

    def pairs(left: DataFrame, right: DataFrame) -> DataFrame:
        a, b = left.alias("a"), right.alias("b")
        return a.join(
            b,
            _same_group("a", "b") & (F.col("a.piece") == F.col("b.piece"))
            & _sizes_agree("a", "b") & _may_match("a", "b", level) & _share_enough("a", "b")
            & (F.col("a.component") != F.col("b.component")),
        ).select(*_pair("a", "b"))

    return pairs(minor.where("own"), others).unionByName(
        pairs(minor.where("not own"), others.where("own"))
    )


def title_components(nodes: DataFrame, limits: Limits = USUAL) -> DataFrame:
    """``(id, label)`` of every node that is linked to another one."""
    ordered = _ordered_nodes(nodes, limits)
    units, clique_links = _cliques(ordered)
    units = materialize(units, "units")
    subjects = _subjects(nodes, units)
    members = _members(_cold_keys(ordered).unionByName(_hot_keys(units)))
    links = _same_title_links(nodes).unionByName(_single_links(nodes)).unionByName(clique_links)
    level = 1
    while True:
        groups = _large_groups(members, limits, level)
        if groups.isEmpty():
            found = _verify(_small_group_pairs(members, level), subjects)
            return connected_components(links.unionByName(found))
        small = members.join(groups.select("key", "bucket"), ["key", "bucket"], "left_anti")
        found = _verify(_small_group_pairs(small, level), subjects)
        links = materialize(links.unionByName(found), f"links-{level}")
        large = materialize(join_spread(members, groups, ["key", "bucket"], "id"), f"members-{level}")
        pivot_links = materialize(_verify(_pivot_pairs(large), subjects), f"pivot-links-{level}")
        labels = connected_components(links.unionByName(pivot_links))
        labels = materialize(labels, f"labels-{level}")
        stars = labels.select("id", F.col("label").alias("other"))
        open_groups = materialize(_open_groups(large, labels, level), f"open-{level}")
        # Not split: cold tokens, and members that another shared token need not exist for.
        goes_on = (F.col("want") > 0) & (F.col("overlap") > level) & F.lit(level < limits.levels)
        stays = open_groups.where((F.col("want") == 0) | (F.col("overlap") <= level))
        if level == limits.levels:
            stays = open_groups
        links = stars.unionByName(_verify(_open_group_pairs(stays, limits, level), subjects))
        if open_groups.where(goes_on).isEmpty():
            links = materialize(links, f"rest-links-{level}")
            return connected_components(links)
        # Members that stay are in the split groups too, for partners that must share more.
        split = open_groups.where("want > 0")
        members = materialize(_next_keys(split, units, level), f"split-{level}")
        level += 1
