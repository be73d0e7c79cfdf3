"""Links between sets with a Jaccard similarity of at least 4/5, over an inverted index.

The index is a table of entries (token, node, n, pos, shards): a set (node) with n
members has token at place pos of the order all sets share. Sets that share no entry
are not linked. Following "Leveraging set relations in exact set similarity join",
sets that are alike are used to skip work:

* *Answers from a similar set.* A list has a few leaders, chosen by several orders, and every set is first
  checked against the nearest by sketch of all its lists' leaders. What is linked then has a common label, so that a
  group of near copies is nearly one label. Only pairs with different labels are looked at further on:
  an answer inside a label follows from its leaders'. Of these pairs, the nearest of each two labels is checked first;
  where it is linked, the labels become one and their other pairs need no check.
* *Skipping by position.* What is left of a list is grouped in blocks of nearby sizes and
  positions. A pair of blocks whose sizes and positions leave too little room for the
  overlap is skipped as a whole, before its entries are read.
* *Skipping by sketch.* A set's sketch has a bit per bucket: is the number of its members there odd?
  Two sets differ in at least as many members as their sketches do in bits, so that
  pairs whose sketches are too far apart are never made. Sketches of many words are folded to NARROW words where they
  go with the entries, and are compared in full for the pairs left, before sets are fetched. With `bound_blocks`, a block keeps the bits that all its
  sets have and those that any has, which bounds the same difference for blocks: a pair of blocks, or of a set and a
  block, that is too far apart is skipped as a whole. That pays where a set is in few lists, as with bands.

A list with very many entries is dealt over shards by node for the first step; blocks
come from partial aggregates, and blocks meet entries in equi-joins that Spark may split.
"""

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnmill.checkpoints import store
from turnmill.llm.components import connected_components
from turnmill.llm.words import overlap, unpack_set

ENTRY = "token long, node long, n int, pos int, shards int"
SETS = "node long, n int, members binary"

# A position block spans this many places; sizes in a band differ by a quarter at most.
BLOCK = 16
BAND_RATIO = 1.25
# Leaders that a set is checked against first.
LEADERS = 2
# Leaders that a list has besides its least and greatest sets.
HASHED_LEADERS = 6
# Bits of the filter that tells a scan which sets may be asked for: 2 MB.
FILTER_BITS = 1 << 24

# Words of a sketch that go with each entry; those of pairs are compared in full.
NARROW = 4
# Sets sketched at a time.
SKETCHED = 1 << 10

Members = Callable[[DataFrame], DataFrame]


def sketch_columns(words: int) -> list[str]:
    """Names of the columns of a sketch of 64 * words bits."""
    return [f"sketch{i}" for i in range(words)]


def sketches(shingles: np.ndarray, bounds: np.ndarray, words: int) -> np.ndarray:
    """The sketches of sets that lie end to end: a row of signed 64-bit numbers each."""
    bits, count = 64 * words, len(bounds) - 1
    found = np.empty((count, words), np.int64)
    for start in range(0, count, SKETCHED):
        own = bounds[start : start + SKETCHED + 1]
        sets = len(own) - 1
        owner = np.repeat(np.arange(sets), np.diff(own))
        bucket = ((shingles[own[0] : own[-1]] >> np.uint64(33)) % np.uint64(bits)).astype(np.int64)
        odd = np.bincount(owner * bits + bucket, minlength=sets * bits).astype(np.uint8) & 1
        found[start : start + sets] = np.packbits(odd.reshape(sets, bits), axis=1).view(np.int64)
    return found


def _narrow(sketched: DataFrame) -> DataFrame:
    """Sketches folded to NARROW words: what the sketch with so many words only would be."""
    bits = [c for c in sketched.columns if c != "node"]
    folded = [F.expr(" ^ ".join(bits[i::NARROW])).alias(bits[i]) for i in range(min(NARROW, len(bits)))]
    return sketched.select("node", *folded)


def link_sets(entries: DataFrame, members: Members, sketched: DataFrame, bound_blocks: bool = False) -> DataFrame:
    """(node, label) of every set that is linked with another: label is the least node
    reachable by links. `members(nodes)` gives SETS rows for all nodes of a stored table
    (node), and maybe more; a node may come up repeatedly.
    `sketched` has each node with its sketch in all other columns, repeatedly maybe. The
    links are the same with and without `bound_blocks`.
    """
    shared = _shared_lists(entries)
    bits = [c for c in sketched.columns if c != "node"]
    sketched = store(sketched.groupBy("node").agg(*[F.first(c).alias(c) for c in bits]))
    pairs = store(_leader_pairs(shared, sketched))
    labels = store(connected_components(store(_linked_pairs(pairs, members))))
    others = _cross_label_pairs(shared, labels, _narrow(sketched), bound_blocks)
    others = store(others if len(bits) <= NARROW else _near_pairs(others, sketched))
    if others.isEmpty():
        return labels
    first = store(_nearest_of_labels(others))
    labels = store(_merged(labels, store(_linked_pairs(first, members))))
    rest = store(_still_apart(others, first, labels))
    if rest.isEmpty():
        return labels
    return _merged(labels, store(_linked_pairs(rest, members)))


def _near_pairs(pairs: DataFrame, sketched: DataFrame) -> DataFrame:
    """Those pairs that are near enough by the whole sketches, with `apart` by these."""
    bits = [c for c in sketched.columns if c != "node"]
    for name in "ab":
        pairs = pairs.join(sketched.select(F.col("node").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in bits]), name)
    return pairs.select("a", "b", "label_a", "label_b", "n", F.expr(_differ(bits)).alias("apart")).where("9 * apart <= n")


def _nearest_of_labels(pairs: DataFrame) -> DataFrame:
    """(a, b) of the nearest pair by sketch of each two labels: when it is linked, the others of these labels follow."""
    nearest = F.min(F.struct("apart", "a", "b")).alias("nearest")
    labels = [F.least("label_a", "label_b"), F.greatest("label_a", "label_b")]
    return pairs.groupBy(*labels).agg(nearest).select("nearest.a", "nearest.b")


def _still_apart(pairs: DataFrame, seen: DataFrame, labels: DataFrame) -> DataFrame:
    """(a, b) of the pairs that are not among those seen and have different labels."""
    pairs = pairs.select("a", "b").join(seen, ["a", "b"], "left_anti")
    for end in "ab":
        named = labels.select(F.col("node").alias(end), F.col("label").alias(f"label_{end}"))
        pairs = pairs.join(named, end, "left")
    return pairs.where("coalesce(label_a, a) <> coalesce(label_b, b)").select("a", "b")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after more links (a, b): components of the labels, not of the sets under them."""
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    alone = ends.join(labels, "node", "left_anti").select("node", F.col("node").alias("label"))
    known = store(labels.unionByName(alone))
    for end in "ab":
        named = known.select(F.col("node").alias(end), F.col("label").alias(f"label_{end}"))
        links = links.join(named, end)
    between = links.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")).distinct()
    top = connected_components(between).select(F.col("node").alias("label"), F.col("label").alias("top"))
    return known.join(top, "label", "left").select("node", F.coalesce("top", "label").alias("label"))


def _shared_lists(entries: DataFrame) -> DataFrame:
    """Entries whose token is in another set too, with the list's leaders: the least node of the
    list's shard, the least and the greatest one of about the same size, and the least of these by some hashes."""
    band = F.floor(F.log("n") / F.log(F.lit(BAND_RATIO))).cast("int")
    dealt = (
        entries.withColumn("shard", F.expr("cast(pmod(node, shards) as int)"))
        .repartition("token", "shard")
        .withColumn("band", band)
    )
    lists = Window.partitionBy("token", "shard")
    own = F.struct("node", "n", "pos")
    dealt = dealt.withColumns({"lo": F.min(own).over(lists), "hi": F.max("node").over(lists)})
    dealt = dealt.where("lo.node <> hi OR shards > 1")
    # A set that several batches have gives its entries repeatedly; one of each is enough.
    dealt = dealt.select("token", "shard", "node", "n", "pos", "band", "lo").distinct()
    in_band = Window.partitionBy("token", "shard", "band")
    leaders = [F.col("lo"), F.min(own).over(in_band), F.max(own).over(in_band)]
    for number in range(HASHED_LEADERS):
        hashed = F.min(F.struct(F.xxhash64("node", F.lit(number)).alias("hash"), "node", "n", "pos")).over(in_band)
        leaders.append(F.struct(hashed["node"].alias("node"), hashed["n"].alias("n"), hashed["pos"].alias("pos")))
    dealt = dealt.withColumns({f"leader{number}": leader for number, leader in enumerate(leaders)})
    every = F.array_distinct(F.array(*[f"leader{number}" for number in range(len(leaders))]))
    return store(dealt.select("token", "node", "n", "pos", "band", every.alias("leaders")))


# An overlap of 4/9 of both sizes is needed, and from the first common token on there are at
# most as many common ones as the shorter rest holds.
ROOM = (
    "5 * {a}.n >= 4 * {b}.n AND 5 * {b}.n >= 4 * {a}.n "
    "AND 9 * least({a}.n - {a}.pos, {b}.n - {b}.pos) >= 4 * ({a}.n + {b}.n)"
)


def _differ(bits: list[str]) -> str:
    """So many members at least are in one of two sets only."""
    return " + ".join(f"bit_count({c}_a ^ {c}_b)" for c in bits)


def _differ_at_least(bits: list[str]) -> str:
    """So many members at least are in one set only of any two sets of blocks a and b."""
    return " + ".join(f"bit_count((all_{c}_a & ~any_{c}_b) | (all_{c}_b & ~any_{c}_a))" for c in bits)


def _differ_from_block(bits: list[str]) -> str:
    """So many members at least are in one only of set a and any set of block b."""
    return " + ".join(f"bit_count(({c}_a & ~any_{c}_b) | (all_{c}_b & ~{c}_a))" for c in bits)


def _nearest(pairs: DataFrame, sketched: DataFrame) -> DataFrame:
    """Of pairs (a, b, n), n the sum of their sizes, those near enough by sketch: for each a the LEADERS nearest b,
    as (least, greatest), once."""
    bits = [c for c in sketched.columns if c != "node"]

    def side(name: str) -> DataFrame:
        return sketched.select(F.col("node").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in bits])

    apart = pairs.join(side("a"), "a").join(side("b"), "b").select(
        "a", "b", "n", F.expr(_differ(bits)).alias("apart")
    )
    rank = F.row_number().over(Window.partitionBy("a").orderBy("apart", "b"))
    near = apart.where("9 * apart <= n").withColumn("rank", rank)
    near = near.where(F.col("rank") <= LEADERS)
    return near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _leader_pairs(shared: DataFrame, sketched: DataFrame) -> DataFrame:
    """(a, b): each node with the LEADERS nearest leaders of its lists, where sizes and positions
    leave room enough."""
    possible = shared.select(
        F.struct("node", "n", "pos").alias("own"),
        F.explode("leaders").alias("other"),
    ).where("own.node <> other.node AND " + ROOM.format(a="own", b="other"))
    distinct = possible.groupBy(F.col("own.node").alias("a"), F.col("other.node").alias("b")).agg(
        F.first(F.col("own.n") + F.col("other.n")).alias("n")
    )
    return _nearest(distinct, sketched)


def _block_pairs(blocks: DataFrame, kept: list[str]) -> DataFrame:
    """Each pair of blocks of a token that have different labels and may have linked sets, once: the block with fewer
    sets is a, as its sets are the ones that meet the other block."""

    def side(name: str) -> DataFrame:
        return blocks.select("token", *[F.col(c).alias(f"{c}_{name}") for c in blocks.columns if c != "token"])

    apart = f"9 * ({_differ_at_least(kept)}) <= most_a + most_b" if kept else "true"
    return side("a").join(side("b"), "token").where(
        "label_a <> label_b AND (size_a < size_b OR size_a = size_b AND label_a < label_b) "
        "AND 5 * most_a >= 4 * least_b AND 5 * most_b >= 4 * least_a "
        "AND 9 * least(rest_a, rest_b) >= 4 * (least_a + least_b)"
        f" AND {apart}"
    )


def _cross_label_pairs(
    shared: DataFrame, labels: DataFrame, sketched: DataFrame, bound_blocks: bool = False
) -> DataFrame:
    """(a, b, label_a, label_b, n, apart): all pairs of sets in a common list that have different labels, room enough and
    sketches near enough, once each, a the lesser one. `apart` is by sketch, n the sum of the sizes."""
    bits = [c for c in sketched.columns if c != "node"]
    kept = bits if bound_blocks else []
    known = sketched.join(labels, "node", "left")
    labelled = shared.join(known, "node").select(
        "token", "node", "n", "pos", "band", *bits,
        F.coalesce("label", "node").alias("label"),
        F.expr(f"pos div {BLOCK}").alias("place"),
    )
    blocks = labelled.groupBy("token", "label", "band", "place").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.min("pos").alias("first"),
        F.max(F.col("n") - F.col("pos")).alias("rest"), F.count("*").alias("size"),
        *[F.bit_and(c).alias(f"all_{c}") for c in kept], *[F.bit_or(c).alias(f"any_{c}") for c in kept],
    )
    spans = blocks.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    live = spans.where("lo <> hi").select("token")
    blocks = store(blocks.join(live, "token", "left_semi"))

    pairs = _block_pairs(blocks, kept)
    keys = [f"{c}_{name}" for name in "ab" for c in ("label", "band", "place")]
    bounds = [f"{c}_b" for c in ("least", "most", "rest", *[f"{of}_{c}" for of in ("all", "any") for c in kept])]
    pairs = pairs.select("token", *keys, *bounds)

    def entries(name: str) -> DataFrame:
        return labelled.select(
            "token",
            *[F.col(c).alias(f"{c}_{name}") for c in ("label", "band", "place", "node", "n", "pos", *bits)],
        )

    apart = f"9 * ({_differ_from_block(kept)}) <= n_a + most_b" if kept else "true"
    met = pairs.join(entries("a"), ["token", "label_a", "band_a", "place_a"]).where(
        "5 * n_a >= 4 * least_b AND 5 * most_b >= 4 * n_a "
        "AND 9 * least(n_a - pos_a, rest_b) >= 4 * (n_a + least_b)"
        f" AND {apart}"
    ).drop(*bounds)
    met = met.join(entries("b"), ["token", "label_b", "band_b", "place_b"])
    met = met.where(
        "5 * n_a >= 4 * n_b AND 5 * n_b >= 4 * n_a "
        "AND 9 * least(n_a - pos_a, n_b - pos_b) >= 4 * (n_a + n_b)"
        f" AND 9 * ({_differ(bits)}) <= n_a + n_b"
    )
    lesser = F.col("node_a") < F.col("node_b")
    return met.select(
        F.least("node_a", "node_b").alias("a"),
        F.greatest("node_a", "node_b").alias("b"),
        F.when(lesser, F.col("label_a")).otherwise(F.col("label_b")).alias("label_a"),
        F.when(lesser, F.col("label_b")).otherwise(F.col("label_a")).alias("label_b"),
        F.expr("n_a + n_b").alias("n"),
        F.expr(_differ(bits)).alias("apart"),
    ).distinct()


def _linked(left: pd.Series, right: pd.Series) -> pd.Series:
    def linked(a: bytes, b: bytes) -> bool:
        common = overlap(unpack_set(a), unpack_set(b))
        return 100 * common >= 80 * (len(a) // 5 + len(b) // 5 - common)

    return pd.Series([linked(a, b) for a, b in zip(left, right, strict=True)], dtype=bool)


def _asked_sets(pairs: DataFrame, members: Members) -> DataFrame:
    """(node, members) of the sets of stored pairs, each once. Only these are asked for."""
    nodes = pairs.select("a").unionByName(pairs.select(F.col("b").alias("a"))).distinct()
    nodes = store(nodes.withColumnRenamed("a", "node"))
    asked = members(nodes).join(nodes, "node", "left_semi")
    return asked.groupBy("node").agg(F.first("members").alias("members"))


def _linked_pairs(pairs: DataFrame, members: Members) -> DataFrame:
    """Those of stored pairs (a, b) whose sets have 100 * intersection >= 80 * union. The sets are shuffled once, by
    node, for both sides, and not stored."""
    sets = _asked_sets(pairs, members)
    a = sets.select(F.col("node").alias("a"), F.col("members").alias("left"))
    b = sets.select(F.col("node").alias("b"), F.col("members").alias("right"))
    return pairs.join(a, "a").join(b, "b").where(F.pandas_udf(_linked, "boolean")("left", "right")).select("a", "b")


def filter_bit(node: Column) -> Column:
    return F.pmod(F.shiftright(node, 20), F.lit(FILTER_BITS))


def node_filter(nodes: DataFrame) -> bytes:
    """A bitmap of FILTER_BITS that has a bit for each node, or for other 64-bit hashes under this name. At most FILTER_BITS / 64 numbers
    come to the driver, however many nodes there are; when it is full, it lets all pass."""
    bit = filter_bit(F.col("node"))
    words = (
        nodes.select(bit.alias("bit"))
        .groupBy(F.expr("bit div 64").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits"))
    )
    table = words.toPandas()
    bitmap = np.zeros(FILTER_BITS // 64, np.int64)
    bitmap[table["word"].to_numpy(np.int64)] = table["bits"].to_numpy(np.int64)
    return bitmap.tobytes()


def may_contain(bitmap, node: int) -> bool:
    """`bitmap`: the filter as a numpy array of 64-bit words."""
    bit = (node >> 20) % FILTER_BITS
    return bool((int(bitmap[bit >> 6]) >> (bit & 63)) & 1)


def may_contain_each(bitmap: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """`may_contain` of many nodes."""
    bits = (nodes >> 20) % FILTER_BITS
    return ((bitmap[bits >> 6] >> (bits & 63)) & 1).astype(bool)
