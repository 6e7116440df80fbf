"""Prefix trie of conversations: balanced parentheses per shard, subtree sums, shared spines merged.

Nodes.  A turn is known by a SHA-256 of its role and text from the first step on, so texts are read once and never
shuffled.  A prefix is known by running sums of hashes of (depth, turn); a node is all rows with the same sums, counted by a
map-side combined aggregate.  Running sums of very long conversations are worked out in slices (``running_totals``).

Chains.  Nodes with the same smallest member and the same number of members lie on one path without a branch, and are one
node of the shards' tries.  A path then has at most sqrt(2 * rows) nodes however long the conversations are.

Shards.  The paths to the leaves, one conversation each, are sorted and cut into ranges.  A shard writes its trie as
balanced parentheses.  ``findclose`` (the next smaller excess, by blocks and a tree of their minima) delimits each subtree;
the number of leaf pairs "()" between the parentheses is its leaves, and the difference of cumulative weights its savings.
A chain on the border of shards (the spine) is in several; its weight stands at one leaf only, so that adding up what
the shards found merges the spines.

Defined results: rows without a conversation id take no part; turns that tie (also null ones, which come first) go by the
SHA-256 of role and text; null role or text are empty; repeated rows are turns of their own; a conversation without turns
left is a member of the root and ends there; an empty table gives no rows, not even a root.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upkeep.llm.support import map_batches, shared_folder, stored
from upkeep.operators.ordered import running_totals
from upkeep.operators.slicing import DEFAULT_POLICY, SlicePolicy

WORDS = r"[^\x20\x09-\x0D]+"
#: Nodes of one shard's trie; parentheses in a block of excesses.
SHARD_NODES = 500_000
BLOCK = 64
MOST_SHARDS = 20_000


def known_turns(df: DataFrame, policy: SlicePolicy = DEFAULT_POLICY) -> DataFrame:
    """``conv_id``, ``pos`` (from 1), ``turn_hash``, ``words`` of every turn, numbered within its conversation."""
    role, text = (F.coalesce(df[c].cast("string"), F.lit("")) for c in ("role", "text"))
    turns = df.select(
        df["conv_id"].cast("long").alias("conv_id"),
        df["turn"].isNotNull().alias("stated"),
        df["turn"].alias("turn"),
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("turn_hash"),
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words"),
        F.lit(1).cast("long").alias("one"),
    ).where("conv_id IS NOT NULL")
    numbered = running_totals(turns, ["conv_id"], ["stated", "turn", "turn_hash"], {"pos": "one"}, policy=policy)
    return numbered.select("conv_id", "pos", "turn_hash", "words")


def with_shared_heads(turns: DataFrame, every: int = 20, longest: int = 4) -> DataFrame:
    """Each conversation c begins with the first h turns of conversation ``c - c % every``, h = crc32(c) % ``longest``.

    Returns ``conv_id``, ``depth``, ``turn_hash``, ``words``, and one row of depth 0 per conversation.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % longest
    base = F.col("conv_id") - F.col("conv_id") % every
    heads = (
        turns.where((F.col("pos") < longest) & (F.col("conv_id") % every == 0))
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.collect_list(F.struct("pos", "turn_hash", "words")).alias("head"))  # fewer than ``longest`` turns
    )
    every_one = turns.where("pos = 1").select("conv_id", h.alias("h"), base.alias("base")).join(heads, "base", "left")
    head = F.filter(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), lambda t: t["pos"] <= F.col("h"))
    every_one = every_one.select("conv_id", "h", head.alias("head"))
    own = (
        turns.join(every_one.select("conv_id", "h", F.size("head").cast("long").alias("taken")), "conv_id")
        .where("pos > h")
        .select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("depth"), "turn_hash", "words")
    )
    return with_roots(own.unionByName(every_one.select("conv_id", F.inline("head")).withColumnRenamed("pos", "depth")), every_one)


def with_roots(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """A row of depth 0 for every conversation."""
    root = conversations.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("string").alias("turn_hash"), F.lit(0).cast("long").alias("words"))
    return rows.unionByName(root)


def as_they_are(turns: DataFrame) -> DataFrame:
    """The same form without any rebuilding."""
    return with_roots(turns.withColumnRenamed("pos", "depth"), turns.where("pos = 1"))


def _prefix(sums: list[Column], number: int) -> Column:
    turned = [*sums[number:], *sums[:number]]
    return F.xxhash64(F.lit(number), *turned)


def with_prefixes(rows: DataFrame, policy: SlicePolicy = DEFAULT_POLICY) -> DataFrame:
    """Adds the prefix of a row (``k1``, ``k2``), that of the row before (``p1``, ``p2``; null at depth 0), and all words up to it."""
    # Four sums of 32-bit hashes: no sum of fewer than 2^31 turns leaves 64 bits.
    hashes = {f"t{i}": F.when(F.col("depth") > 0, F.shiftrightunsigned(F.xxhash64(F.lit(i), "depth", "turn_hash"), 32)).otherwise(F.lit(0).cast("long")) for i in range(4)}
    sums = {f"s{i}": f"t{i}" for i in range(4)} | {"words_to": "words"}
    summed = running_totals(rows.withColumns(hashes), ["conv_id"], ["depth"], sums, policy=policy)
    here = [F.col(f"s{i}") for i in range(4)]
    before = [F.col(f"s{i}") - F.col(f"t{i}") for i in range(4)]
    inner = F.col("depth") > 0
    return summed.select(
        "conv_id", "depth", "words", "words_to",
        _prefix(here, 0).alias("k1"), _prefix(here, 1).alias("k2"),
        F.when(inner, _prefix(before, 0)).alias("p1"), F.when(inner, _prefix(before, 1)).alias("p2"),
    )


def digests_of_ends(ends: DataFrame) -> DataFrame:
    """``k1``, ``k2``, ``ends_sha256`` from ``k1``, ``k2``, ``conv_id``.

    A digest of all members in order can't be split, so one task works on a node; it takes them as a sorted stream and
    holds one digest at a time.
    """
    import hashlib

    def work(batches):
        key, digest = None, None
        for batch in batches:
            out = []
            for k1, k2, conv in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                if (k1, k2) != key:
                    if key is not None:
                        out.append((*key, digest.hexdigest()))
                    key, digest = (k1, k2), hashlib.sha256(b"%d" % conv)
                else:
                    digest.update(b",%d" % conv)
            yield from _digest_rows(out)
        if key is not None:
            yield from _digest_rows([(*key, digest.hexdigest())])

    dealt = ends.select("k1", "k2", "conv_id").repartition("k1", "k2").sortWithinPartitions("k1", "k2", "conv_id")
    return map_batches(dealt, work, "k1 long, k2 long, ends_sha256 string")


def _digest_rows(rows):
    if rows:
        columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, ["k1", "k2", "ends_sha256"])


class Parentheses:
    """A balanced sequence with blocks of excesses and a tree of their minima."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.excess = np.cumsum(2 * bits.astype(np.int64) - 1)
        blocks = max(1, -(-len(bits) // BLOCK))
        wide = 1 << (blocks - 1).bit_length()
        padded = np.full(wide * BLOCK, np.iinfo(np.int64).max)
        padded[: len(bits)] = self.excess
        self.blocks = padded.reshape(wide, BLOCK)
        #: Level 0 has the minima of the blocks, each next level those of pairs.
        self.minima = [self.blocks.min(axis=1)]
        while len(self.minima[-1]) > 1:
            self.minima.append(self.minima[-1].reshape(-1, 2).min(axis=1))

    def find_close(self, opens: np.ndarray) -> np.ndarray:
        """The closing parenthesis of each opening one: the first place to its right with an excess one less than before it."""
        close = np.empty(len(opens), dtype=np.int64)
        for start in range(0, len(opens), 1 << 16):
            close[start : start + (1 << 16)] = self._find_close(opens[start : start + (1 << 16)])
        return close

    def _find_close(self, opens: np.ndarray) -> np.ndarray:
        target, block = self.excess[opens] - 1, opens // BLOCK
        low = (self.blocks[block] <= target[:, None]) & (np.arange(BLOCK)[None, :] > (opens % BLOCK)[:, None])
        inside = low.any(axis=1)
        close = block * BLOCK + low.argmax(axis=1)
        rest = np.nonzero(~inside)[0]
        node, goal, level = block[rest], target[rest], np.zeros(len(rest), dtype=np.int64)
        climbing = np.ones(len(rest), dtype=bool)
        for height, minima in enumerate(self.minima):  # up until a sibling to the right goes low enough
            at = np.nonzero(climbing)[0]
            left = at[node[at] % 2 == 0]
            left = left[node[left] + 1 < len(minima)]
            found = left[minima[node[left] + 1] <= goal[left]]
            node[found] += 1
            level[found], climbing[found] = height, False
            node[climbing] //= 2
        for height in range(len(self.minima) - 1, 0, -1):  # and down to the first block that does
            at = np.nonzero(level == height)[0]
            child = 2 * node[at]
            node[at] = child + (self.minima[height - 1][child] > goal[at])
            level[at] = height - 1
        close[rest] = node * BLOCK + (self.blocks[node] <= goal[:, None]).argmax(axis=1)
        return close

    def leaves(self) -> np.ndarray:
        """Number of pairs "()" that begin at or before each place."""
        pair = self.bits.copy()
        pair[:-1] &= ~self.bits[1:]
        return np.cumsum(pair)


def subtree_sums(paths) -> tuple[list, np.ndarray, np.ndarray]:
    """Nodes of the trie of sorted paths ``(nodes, weights)``, leaves below each and the sum of weights in its subtree.

    No path is the beginning of another.  The weight of a node may stand at any of its paths, zero at the others.
    """
    bits, nodes, at, weights, open_now = bytearray(), [], [], [], []
    for path, own in paths:
        common = 0
        while common < len(open_now) and common < len(path) and nodes[open_now[common]] == path[common]:
            common += 1
        for i in range(common):
            weights[open_now[i]] += own[i]
        bits += b"\0" * (len(open_now) - common)
        del open_now[common:]
        for node, weight in zip(path[common:], own[common:]):
            open_now.append(len(nodes))
            nodes.append(node)
            at.append(len(bits))
            weights.append(weight)
            bits += b"\1"
    bits += b"\0" * len(open_now)
    if not nodes:
        return [], np.empty(0, np.int64), np.empty(0, np.int64)
    tree = Parentheses(np.frombuffer(bytes(bits), dtype=np.uint8).astype(bool))
    opens = np.array(at, dtype=np.int64)
    closes = tree.find_close(opens)
    leaves = np.r_[0, tree.leaves()]
    along = np.zeros(len(bits) + 1, dtype=np.int64)
    along[opens + 1] = weights
    along = np.cumsum(along)
    return nodes, leaves[closes + 1] - leaves[opens], along[closes + 1] - along[opens]


def shard_sums(paths: DataFrame, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """``rep``, ``n``, ``leaves``, ``saved`` of every chain, from sorted ranges of ``path`` (structs rep, n) and ``weights``."""
    nodes = paths.agg(F.sum(F.size("path"))).first()[0] or 0
    shards = max(1, min(MOST_SHARDS, -(-nodes // shard_nodes)))
    ranged = paths.repartitionByRange(shards, "path").sortWithinPartitions("path")

    def work(batches):
        held, size = [], 0
        for batch in batches:
            for path, weights in zip(batch.column(0), batch.column(1)):
                held.append(([(s["rep"], s["n"]) for s in path.as_py()], weights.as_py()))
                size += len(held[-1][0])
                if size >= 2 * shard_nodes:  # a range that came out too large is cut
                    yield from _sum_rows(held)
                    held, size = [], 0
        yield from _sum_rows(held)

    found = map_batches(ranged.select("path", "weights"), work, "rep long, n long, leaves long, saved long")
    return found.groupBy("rep", "n").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("below"))


def _sum_rows(held):
    nodes, leaves, saved = subtree_sums(held)
    if nodes:
        columns = [pa.array(x, pa.int64()) for x in ([a for a, _ in nodes], [b for _, b in nodes], leaves, saved)]
        yield pa.RecordBatch.from_arrays(columns, ["rep", "n", "leaves", "saved"])


def chains_of(nodes: DataFrame) -> DataFrame:
    """One row per chain: ``rep``, ``n``, prefix of its top, words before it, its weight, and whether it ends in a leaf."""
    top = F.min_by(F.struct("k1", "k2", (F.col("words_to") - F.col("words")).alias("words_before")), "depth")
    return (
        nodes.groupBy("rep", "n")
        .agg(top.alias("top"), ((F.col("n") - 1) * F.sum("words")).alias("weight"), F.max_by("n_children", "depth").alias("children"))
        .select("rep", "n", "top.*", "weight", (F.col("children") == 0).alias("leaf"))
    )


def paths_of(rows: DataFrame, chains: DataFrame) -> DataFrame:
    """``path`` and ``weights`` of every leaf: the chains from the root on, along its smallest member."""
    leaves = chains.where("leaf").select(F.col("rep").alias("conv_id"))
    steps = rows.select("conv_id", "depth", "k1", "k2").join(leaves, "conv_id").join(chains.select("k1", "k2", "rep", "n", "weight"), ["k1", "k2"])
    owners = steps.groupBy("rep", "n").agg(F.min("conv_id").alias("owner"))
    weight = F.when(F.col("conv_id") == F.col("owner"), F.col("weight")).otherwise(F.lit(0).cast("long"))
    steps = steps.join(owners, ["rep", "n"]).select("conv_id", F.struct("depth", "rep", "n", weight.alias("weight")).alias("step"))
    whole = steps.groupBy("conv_id").agg(F.array_sort(F.collect_list("step")).alias("steps"))  # sqrt(2 * rows) at most
    path = F.transform("steps", lambda s: F.struct(s["rep"].alias("rep"), s["n"].alias("n")))
    return whole.select(path.alias("path"), F.transform("steps", lambda s: s["weight"]).alias("weights"))


def prefix_trie(rows: DataFrame, shard_nodes: int = SHARD_NODES, policy: SlicePolicy = DEFAULT_POLICY) -> DataFrame:
    """The nodes of the trie over ``conv_id``, ``depth``, ``turn_hash``, ``words`` (with rows of depth 0)."""
    folder = shared_folder(rows.sparkSession)
    rows = stored(with_prefixes(rows, policy), folder, "prefixes")
    nodes = rows.groupBy("k1", "k2", "p1", "p2", "depth").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("rep"), F.max("words").alias("words"), F.max("words_to").alias("words_to")
    )
    nodes = stored(nodes, folder, "counted")
    children = nodes.where("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"))
    above = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("rep").alias("parent_conv_id"))
    last = rows.groupBy("conv_id").agg(F.max_by(F.struct("k1", "k2"), "depth").alias("end")).select("conv_id", "end.*")
    nodes = (
        nodes.join(children, ["k1", "k2"], "left")
        .join(digests_of_ends(last), ["k1", "k2"], "left")
        .join(above, ["p1", "p2"], "left")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    )
    nodes = stored(nodes, folder, "nodes")
    chains = stored(chains_of(nodes), folder, "chains")
    paths = stored(paths_of(rows, chains), folder, "paths")
    sums = shard_sums(paths, shard_nodes).join(chains.select("rep", "n", "words_before"), ["rep", "n"])
    words_above = F.col("words_to") - F.col("words") - F.col("words_before")
    return nodes.join(sums, ["rep", "n"]).select(
        F.col("rep").alias("conv_id"),
        "depth",
        "parent_conv_id",
        F.col("n").alias("n_convs"),
        "n_children",
        "n_leaves",
        (F.col("below") - (F.col("n") - 1) * words_above).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
