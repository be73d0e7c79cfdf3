"""Prefix tries of conversations: which beginnings are shared, by how many, and what sharing them saves.

Equal conversations are one sequence. A prefix that at most `shard_sequences` sequences begin with is the
root of a shard, if no shorter one is; the prefixes above are shared between shards. Each shard becomes a double-array
trie: BASE and CHECK over dense turn ids, walked by all its sequences at once. What follows a prefix that
only one sequence has is that sequence's tail, kept out of the arrays as is usual for them. The upper
prefixes' figures are merged from their shards' over all tasks.

A prefix is known by its depth and two 64-bit numbers: the exclusive or of a hash per place and turn.
These, and not texts, are shuffled.
"""

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnmill.checkpoints import store
from turnmill.operators.scans import segmented_scan

# Conversations of a block share turns of its first one: at most one less than this.
BLOCK = 100
HEADS = 6
# Most sequences of a shard.
SHARD_SEQUENCES = 4096
# Cells tried at a time for a state's children.
CANDIDATES = 64

NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, end_conv long, is_root boolean, up_a long, up_b long"
)
PACKED = ("root_a", "root_b", "conv_id", "depth", "a", "b", "chars", "weight", "n_turns", "count", "rest", "up_a", "up_b")


class DoubleArray:
    """Transitions of a trie: the child of state s by code c is BASE[s] + c if CHECK of that is s."""

    def __init__(self, codes: int):
        self.base = np.zeros(2 * codes + 16, np.int64)
        self.check = np.full(2 * codes + 16, -1, np.int64)
        self.check[0] = 0
        self._free = 1

    def _grow(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def add(self, state: int, codes: np.ndarray) -> None:
        """Give a state its children, by ascending codes: the first base at which all their cells are free."""
        cell = max(self._first_free(), int(codes[0]))
        while True:
            self._grow(cell + CANDIDATES + int(codes[-1] - codes[0]))
            bases = np.flatnonzero(self.check[cell : cell + CANDIDATES] < 0) + (cell - int(codes[0]))
            fits = (self.check[bases[:, None] + codes] < 0).all(axis=1)
            if fits.any():
                break
            cell += CANDIDATES
        base = int(bases[np.argmax(fits)])
        self.base[state] = base
        self.check[base + codes] = state

    def _first_free(self) -> int:
        while self._free < len(self.check) and self.check[self._free] >= 0:
            self._free += 1
        return self._free

    def step(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The states that `codes` lead to; -1 where there is no such child."""
        child = self.base[states] + codes
        inside = child < len(self.check)
        child = np.where(inside, child, 0)
        return np.where(inside & (self.check[child] == states) & (child > 0), child, -1)


class Rows(NamedTuple):
    """Rows of whole shards, ordered by sequence and depth; `level` counts from the shard's root, 1 for it."""

    columns: dict[str, np.ndarray]
    level: np.ndarray
    code: np.ndarray


def _dense(*columns: np.ndarray) -> np.ndarray:
    """Numbers from 1 on, equal for equal rows."""
    pairs = np.empty(len(columns[0]), [(f"f{i}", np.int64) for i in range(len(columns))])
    for name, column in zip(pairs.dtype.names, columns, strict=True):
        pairs[name] = column
    return np.unique(pairs, return_inverse=True)[1].astype(np.int64).ravel() + 1


def _levels(columns: dict[str, np.ndarray]) -> Rows:
    starts = np.flatnonzero(np.append(True, np.diff(columns["conv_id"]) != 0))
    level = np.arange(len(columns["conv_id"])) - np.repeat(starts, np.diff(np.append(starts, len(columns["conv_id"])))) + 1
    # The roots of the shards are the children of one state above them.
    code = np.where(level == 1, _dense(columns["root_a"], columns["root_b"]), _dense(columns["a"], columns["b"]))
    return Rows(columns, level, code)


def trie_nodes(columns: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """NODE columns of the shards whose rows these are (PACKED, ordered by conv_id and depth)."""
    columns, level, code = _levels(columns)
    trie = DoubleArray(int(code.max()))
    state = np.zeros(len(level), np.int64)
    order = np.argsort(level, kind="stable")
    bounds = np.searchsorted(level[order], np.arange(1, int(level.max()) + 2))
    for first, last in zip(bounds[:-1], bounds[1:], strict=True):
        rows = order[first:last]
        # A sequence's row before is one level up.
        above = np.where(level[rows] == 1, 0, state[rows - 1])
        pairs = np.unique(np.stack([above, code[rows]]), axis=1)
        for children in np.split(np.arange(pairs.shape[1]), np.flatnonzero(np.diff(pairs[0])) + 1):
            trie.add(int(pairs[0, children[0]]), pairs[1, children])
        state[rows] = trie.step(above, code[rows])
    return _figures(columns, level, state, trie)


def _figures(columns: dict[str, np.ndarray], level: np.ndarray, state: np.ndarray, trie: DoubleArray) -> dict[str, np.ndarray]:
    size, most = len(trie.check), np.iinfo(np.int64).max
    n_convs, least = np.zeros(size, np.int64), np.full(size, most)
    np.add.at(n_convs, state, columns["weight"])
    np.minimum.at(least, state, columns["conv_id"])
    nodes, at = np.unique(state, return_index=True)
    parent = trie.check[nodes]
    n_children, n_leaves, saved = (np.zeros(size, np.int64) for _ in range(3))
    np.add.at(n_children, parent[level[at] > 1], 1)
    end = np.full(size, -1, np.int64)
    ending = np.flatnonzero(columns["depth"] == columns["n_turns"])
    end[state[ending]] = ending
    # Where one sequence is left and goes on, its tail follows: one child, one leaf, and copies save it whole.
    tail = (columns["count"] == 1) & (columns["depth"] < columns["n_turns"])
    n_children[state[tail]] = 1
    saved[state[tail]] = (columns["weight"] * columns["rest"] - columns["rest"])[tail]
    saved[nodes] += (n_convs[nodes] - 1) * columns["chars"][at]
    n_leaves[nodes] = (n_children[nodes] == 0) | (columns["count"][at] == 1)
    for depth in range(int(level[at].max()), 1, -1):
        own = nodes[level[at] == depth]
        np.add.at(n_leaves, trie.check[own], n_leaves[own])
        np.add.at(saved, trie.check[own], saved[own])
    return {
        "conv_id": least[nodes],
        "depth": columns["depth"][at],
        "parent_conv_id": least[parent],
        "n_convs": n_convs[nodes],
        "n_children": n_children[nodes],
        "n_leaves": n_leaves[nodes],
        "saved_tokens": saved[nodes],
        "end_conv": np.where(end[nodes] >= 0, columns["conv_id"][end[nodes]], most),
        "is_root": level[at] == 1,
        "up_a": columns["up_a"][at],
        "up_b": columns["up_b"][at],
    }


def _node_batch(found: dict[str, np.ndarray]) -> pa.RecordBatch:
    roots, none = found["is_root"], np.iinfo(np.int64).max
    masks = {
        "parent_conv_id": roots,
        "end_conv": found["end_conv"] == none,
        "up_a": ~roots,
        "up_b": ~roots,
    }
    return pa.RecordBatch.from_arrays(
        [pa.array(values, mask=masks.get(name)) for name, values in found.items()], list(found)
    )


def _scan_shards(shard_sequences: int):
    """Node rows of sorted PACKED rows; shards are gathered until their sequences make a full trie."""

    def scan(batches: Iterator[pa.RecordBatch]):
        held: list[dict[str, np.ndarray]] = []

        def packed() -> dict[str, np.ndarray]:
            return {name: np.concatenate([part[name] for part in held]) for name in PACKED}

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append({name: batch.column(name).to_numpy(zero_copy_only=False) for name in PACKED})
            last = held[-1]
            roots = (last["root_a"] != last["root_a"][-1]) | (last["root_b"] != last["root_b"][-1])
            if sum(len(part["conv_id"]) for part in held) >= shard_sequences and roots.any():
                # All but the last shard, which may go on in the next batch.
                cut = len(roots) - int(np.argmax(roots[::-1]))
                held[-1] = {name: values[:cut] for name, values in last.items()}
                yield _node_batch(trie_nodes(packed()))
                held = [{name: values[cut:] for name, values in last.items()}]
        if held:
            yield _node_batch(trie_nodes(packed()))

    return scan


def _scan_ends(batches: Iterator[pa.RecordBatch]):
    """(end_conv, ends_sha256) of sorted (rep, conv_id): one digest runs over all ids of a sequence."""
    rep = digest = None
    for batch in batches:
        reps = batch.column(0).to_numpy()
        ids = batch.column(1).to_numpy()
        starts = np.flatnonzero(np.append(True, np.diff(reps) != 0)) if len(reps) else []
        done = []
        for first, last in zip(starts, np.append(starts[1:], len(reps)) if len(starts) else [], strict=True):
            if digest is not None and reps[first] == rep:
                digest.update(b",")
            else:
                if digest is not None:
                    done.append((rep, digest.hexdigest()))
                rep, digest = int(reps[first]), hashlib.sha256()
            digest.update(",".join(map(str, ids[first:last].tolist())).encode())
        yield pa.RecordBatch.from_arrays(
            [pa.array([r for r, _ in done], pa.int64()), pa.array([d for _, d in done], pa.string())],
            ["end_conv", "ends_sha256"],
        )
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([rep], pa.int64()), pa.array([digest.hexdigest()])], ["end_conv", "ends_sha256"])


def _lane(number: int, place: str = "depth") -> Column:
    """One of the two numbers that a turn adds to the prefixes it is in, by its place."""
    return F.xxhash64(F.lit(number), F.col("a"), F.col("b"), F.col(place).cast("bigint"))


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, a, b, chars) of the turns of rebuilt conversations, depth from 1; and all conv_ids.

    A conversation c takes its first h turns from conversation c - c % BLOCK, as far as that has them, and
    goes on with its own turns after its first h; h is crc32 of the decimal id, modulo HEADS.
    """
    narrow = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    narrow = narrow.select(
        "conv_id",
        "turn",
        "role",
        F.xxhash64(F.lit(1), "role", "text").alias("a"),
        F.xxhash64(F.lit(2), "role", "text").alias("b"),
        F.length("text").cast("bigint").alias("chars"),
        F.monotonically_increasing_id().alias("row"),
    )
    placed = segmented_scan(
        narrow, ["conv_id"], ["turn", "role", "a", "b", "row"], {"place": ("sum", F.lit(1).cast("bigint"))}
    )
    placed = store(placed.drop("turn", "role", "row"))
    # Every conversation has a first turn, so that names them all.
    convs = placed.where("place = 0").select(
        "conv_id",
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).alias("heads"),
        (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("block"),
    )
    first = placed.where(F.col("place") < HEADS - 1)
    given = convs.join(first.withColumnRenamed("conv_id", "block"), "block").where("place < heads")
    taken = first.groupBy(F.col("conv_id").alias("block")).agg(F.count("*").alias("has"))
    starts = convs.join(taken, "block", "left").select(
        "conv_id", "heads", F.least("heads", F.coalesce("has", F.lit(0))).alias("given")
    )
    own = placed.join(starts, "conv_id").where("place >= heads")
    rebuilt = given.select("conv_id", (F.col("place") + 1).alias("depth"), "a", "b", "chars").unionByName(
        own.select("conv_id", (F.col("place") - F.col("heads") + F.col("given") + 1).alias("depth"), "a", "b", "chars")
    )
    return rebuilt, convs.select("conv_id")


def _sequences(rebuilt: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, n_turns, total, rep, weight) per conversation's sequence: one row per member, `rep` the least."""
    whole = rebuilt.groupBy("conv_id").agg(
        F.max("depth").alias("n_turns"),
        F.sum("chars").alias("total"),
        F.bit_xor(_lane(1)).alias("key_a"),
        F.bit_xor(_lane(2)).alias("key_b"),
    )
    zero = F.lit(0).cast("bigint")
    return convs.join(whole, "conv_id", "left").select(
        "conv_id", *[F.coalesce(name, zero).alias(name) for name in ("n_turns", "total", "key_a", "key_b")]
    )


def prefix_nodes(turns: DataFrame, shard_sequences: int = SHARD_SEQUENCES) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations of `turns` (conv_id, turn, role, text).

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): see
    `rebuilt_turns` for how conversations are rebuilt. Turns are ordered by number, null first, equal
    numbers by role and a hash of role and text; turns that repeat all stay. A null role or text is empty. A node is a sequence of (role, text), the root the
    empty one; its members are the conversations that start with it, those without any turn left
    included. conv_id is the least member and parent_conv_id that of the prefix one shorter (null for
    the root). n_leaves counts nodes without children in the node's subtree, itself included; saved_tokens adds up
    (n_convs - 1) * code points of the last turn's text over that subtree; ends_sha256 is the digest of the decimal ids,
    in order and comma-joined, of the members that end there. Turns without a conv_id belong to
    no conversation and are left out. Other columns are ignored. An empty table gives no rows.

    What is shuffled is some 50 bytes per turn. A conversation of any length and a prefix of any number
    of conversations are spread over tasks; a trie holds the shared beginnings of `shard_sequences` sequences at most,
    next to those it is packed with. Only the ids that end at one node meet in one task, as a
    stream into a digest.
    """
    if shard_sequences < 1:
        raise ValueError("shard_sequences must be at least 1")
    rebuilt, convs = rebuilt_turns(turns)
    rebuilt, convs = store(rebuilt), store(convs)
    members = store(_sequences(rebuilt, convs))
    key = ["n_turns", "key_a", "key_b"]
    groups = members.groupBy(*key).agg(
        F.min("conv_id").alias("rep"), F.count("*").alias("weight"), F.first("total").alias("total")
    )
    groups = store(groups)
    marked = store(_marked_paths(rebuilt, groups, shard_sequences))
    tails, nodes = _tail_nodes(marked), store(_trie_shards(marked, shard_sequences))
    upper = store(_upper_nodes(marked, tails.unionByName(nodes).where("is_root")))
    above = upper.select(F.col("conv_id").alias("above"), F.col("key_a").alias("up_a"), F.col("key_b").alias("up_b"))
    own = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "end_conv"]
    below = tails.unionByName(nodes)
    whole = below.where("up_a IS NULL").select(*own).unionByName(
        below.where("up_a IS NOT NULL")
        .unionByName(upper.select(*below.columns))
        .join(above, ["up_a", "up_b"], "left")
        .withColumn("parent_conv_id", F.col("above"))
        .select(*own)
    )
    ends = (
        members.join(groups, key)
        .select("rep", "conv_id")
        .repartition("rep")
        .sortWithinPartitions("rep", "conv_id")
        .mapInArrow(_scan_ends, "end_conv long, ends_sha256 string")
    )
    nothing = F.lit(hashlib.sha256().hexdigest())
    return whole.join(ends, "end_conv", "left").select(
        *own[:-1], F.coalesce("ends_sha256", nothing).alias("ends_sha256")
    )


def _marked_paths(rebuilt: DataFrame, groups: DataFrame, shard_sequences: int) -> DataFrame:
    """The prefixes of each sequence, the empty one too, with what tells where its shard and its tail begin.

    conv_id is the sequence's least member; `count` the sequences that have the prefix; root_depth, root_a and
    root_b the shard's root (null: the sequence ends above all shards); tail_depth the first prefix that no other
    sequence has; `rest` the code points after the prefix.
    """
    scanned = segmented_scan(
        rebuilt.join(groups.select(F.col("rep").alias("conv_id")), "conv_id"),
        ["conv_id"],
        ["depth"],
        {"before": ("sum", F.col("chars")), "up_a": ("bit_xor", _lane(1)), "up_b": ("bit_xor", _lane(2))},
    )
    sizes = groups.select(F.col("rep").alias("conv_id"), "weight", "n_turns", "total")
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    paths = scanned.withColumns(
        {"key_a": F.col("up_a").bitwiseXOR(_lane(1)), "key_b": F.col("up_b").bitwiseXOR(_lane(2))}
    ).join(sizes, "conv_id")
    roots = sizes.select(
        *[
            {"conv_id": F.col("conv_id"), "up_a": none, "up_b": none}.get(name, zero).alias(name)
            for name in scanned.columns
        ],
        zero.alias("key_a"),
        zero.alias("key_b"),
        "weight",
        "n_turns",
        "total",
    )
    paths = store(paths.unionByName(roots))
    counts = paths.groupBy("depth", "key_a", "key_b").agg(F.count("*").alias("count"))
    counted = store(paths.join(counts, ["depth", "key_a", "key_b"]))
    place = F.struct("depth", "key_a", "key_b")
    bounds = counted.groupBy("conv_id").agg(
        F.min(F.when(F.col("count") <= shard_sequences, place)).alias("root"),
        F.min(F.when(F.col("count") == 1, F.col("depth"))).alias("tail_depth"),
    )
    return counted.join(bounds, "conv_id").select(
        *[name for name in counted.columns if name not in ("total", "before")],
        (F.col("total") - F.col("before") - F.col("chars")).alias("rest"),
        F.col("root.depth").alias("root_depth"),
        F.col("root.key_a").alias("root_a"),
        F.col("root.key_b").alias("root_b"),
        "tail_depth",
    )


def _in_tail() -> Column:
    """Rows that no trie needs: below the first prefix of one sequence alone, or a shard of one sequence."""
    return F.coalesce(
        (F.col("depth") > F.col("tail_depth"))
        | ((F.col("depth") == F.col("tail_depth")) & (F.col("tail_depth") == F.col("root_depth"))),
        F.lit(False),
    )


def _tail_nodes(marked: DataFrame) -> DataFrame:
    last, root = F.col("depth") == F.col("n_turns"), F.col("depth") == F.col("root_depth")
    one = F.lit(1).cast("bigint")
    return marked.where(_in_tail()).select(
        "conv_id",
        F.col("depth").cast("bigint").alias("depth"),
        F.when(~root, F.col("conv_id")).alias("parent_conv_id"),
        F.col("weight").alias("n_convs"),
        F.when(last, one - 1).otherwise(one).alias("n_children"),
        one.alias("n_leaves"),
        ((F.col("weight") - 1) * (F.col("chars") + F.col("rest"))).alias("saved_tokens"),
        F.when(last, F.col("conv_id")).alias("end_conv"),
        root.alias("is_root"),
        F.when(root, F.col("up_a")).alias("up_a"),
        F.when(root, F.col("up_b")).alias("up_b"),
    )


def _trie_shards(marked: DataFrame, shard_sequences: int) -> DataFrame:
    rows = marked.where((F.col("depth") >= F.col("root_depth")) & ~_in_tail())
    return (
        rows.select(*[F.coalesce(F.col(name), F.lit(0)).alias(name) if name in ("up_a", "up_b") else name for name in PACKED])
        .repartition("root_a", "root_b")
        .sortWithinPartitions("root_a", "root_b", "conv_id", "depth")
        .mapInArrow(_scan_shards(shard_sequences), NODE)
        # The empty prefix has none above it, whatever its columns say.
        .withColumns({name: F.when(F.col("depth") > 0, F.col(name)).alias(name) for name in ("up_a", "up_b")})
    )


def _upper_nodes(marked: DataFrame, roots: DataFrame) -> DataFrame:
    """NODE columns, with key_a and key_b, of the prefixes above all shards, merged from what is below them."""
    above = marked.where("root_depth IS NULL OR depth < root_depth")
    key = ["depth", "key_a", "key_b"]
    own = above.groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"),
        F.sum("weight").alias("n_convs"),
        F.first("chars").alias("chars"),
        F.first("up_a").alias("up_a"),
        F.first("up_b").alias("up_b"),
        F.min(F.when(F.col("depth") == F.col("n_turns"), F.col("conv_id"))).alias("end_conv"),
    )
    own = store(own)
    # A shard's figures, and each upper node's own, count for all prefixes of the node's least member above it.
    shards = roots.select("conv_id", F.col("depth").alias("below"), "n_leaves", "saved_tokens")
    selves = own.select(
        "conv_id",
        (F.col("depth") + 1).alias("below"),
        F.lit(0).cast("bigint").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
    )
    merged = (
        above.select(*key, "conv_id")
        .join(shards.unionByName(selves), "conv_id")
        .where("depth < below")
        .groupBy(*key)
        .agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    )
    children = (
        roots.select("up_a", "up_b")
        .unionByName(own.select("up_a", "up_b"))
        .where("up_a IS NOT NULL")
        .groupBy(F.col("up_a").alias("key_a"), F.col("up_b").alias("key_b"))
        .agg(F.count("*").alias("n_children"))
    )
    return (
        own.join(merged, key)
        .join(children, ["key_a", "key_b"])
        .select(
            "conv_id",
            "depth",
            F.lit(None).cast("bigint").alias("parent_conv_id"),
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            "end_conv",
            F.lit(False).alias("is_root"),
            "up_a",
            "up_b",
            "key_a",
            "key_b",
        )
    )
