"""Near-duplicate detection by b-bit MinHash.

1. One pass over the texts gives each document's set size, a fingerprint of the whole set, the keys of its bands (from the
   full minima) and the packed low ``BITS`` bits of its minima.  Equal sets form a class; only one row per class goes on.
2. Classes that share a band key are candidates.  Keys are counted first (map-side combined); rows of a key that many
   classes share are dealt into blocks of at most ``BLOCK`` and every pair of blocks is one group, so no task holds an
   unbounded bucket and no pair becomes a row.
3. In a group, all pairs are compared by bit counts of the packed signatures: chance agreement is taken off, and a pair goes
   on if its estimate may still belong to a link, and only in the first band that it shares.
4. The full sets of the documents left (found by a filter of fixed size, so that texts need no shuffle) are computed again
   and compared; a group emits a spanning forest of its links.
   Links that would close a circle are left out, which no component notices.
   Groups are bounded by the bytes of their sets: the pairs of a larger one are dealt by tiles of its rows (``SET_BYTES``).
5. Components of the links; every document finds its component by its fingerprint.

The estimate is cut ``SLACK`` below the threshold, or lower where a link at the threshold would fall below the cut with a
probability above ``MISS`` (binomial, by the number of minima; see ``least_estimate``), and the bands miss a link at the threshold
with a probability below one in a million.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a set holds the distinct shingles of five words; with fewer words the
whole sequence is the only one.  Defined results: null and empty texts have an empty set, are linked with nothing and
stay; equal sets are linked; null keys are never smallest; of rows that repeat a key, all with the smallest are marked as
kept (``keep_one`` keeps one row of each component).  ``df`` is read twice and must be steady, such as a stored table.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upkeep.llm.components import connected_components
from upkeep.llm.support import map_batches, parts, shared_folder, slices, stored, text_of, whole_groups

WORDS = 5
BITS = 4
SLACK = 0.17
MISS = 3e-7
BLOCK = 512
#: Size of the filter for rows whose full sets are wanted; fuller, it lets more rows through, and loses none.
FILTER_BITS = 1 << 24
PAIRS_AT_ONCE = 100_000
#: Bytes of the full sets that a group of pairs may need at once; a pair of longer sets is a group of its own.
SET_BYTES = 128 << 20
#: Bytes of the texts whose sets go back to Spark in one batch (one longer text is a batch of its own).
SENT_BYTES = 16 << 20
ROW = "__upkeep_row"

MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that each bit depends on all."""
    x = (x ^ (x >> np.uint64(32))) * MIX
    x = (x ^ (x >> np.uint64(29))) * MIX
    return x ^ (x >> np.uint64(32))


def shingle_set(content: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    import xxhash

    found = content.lower().split()  # of bytes: A-Z only, and exactly the six white-space characters
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    if not len(hashes):
        return hashes
    width = min(words, len(hashes))
    total = np.full(len(hashes) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        total = total * MIX + hashes[i : len(hashes) - width + 1 + i]
    return np.unique(mixed(total))


class Signer:
    """Minima of ``bands * rows`` hash functions; their band keys and packed low bits."""

    def __init__(self, bands: int, rows: int, seed: int = 1):
        draw = np.random.default_rng(seed)
        self.bands, self.rows, self.count = bands, rows, bands * rows
        self.a = (draw.integers(0, 1 << 32, self.count, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
        self.b = draw.integers(0, 1 << 32, self.count, dtype=np.uint64).astype(np.uint32)
        self.words = -(-self.count * BITS // 64)

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        least, short = np.full(self.count, 0xFFFFFFFF, dtype=np.uint32), (shingles >> np.uint64(32)).astype(np.uint32)
        for at in range(0, len(short), 1024):
            values = short[at : at + 1024, None] * self.a
            values += self.b
            np.minimum(least, values.min(axis=0), out=least)
        return least

    def band_keys(self, least: np.ndarray) -> np.ndarray:
        key = np.arange(1, self.bands + 1, dtype=np.uint64)
        for column in least.reshape(self.bands, self.rows).T.astype(np.uint64):
            key = mixed(key * MIX + column)
        return key.view(np.int64)

    def packed(self, least: np.ndarray) -> bytes:
        """The low bits (of the minima after mixing), 16 to a 64-bit word."""
        low = np.zeros(self.words * 64 // BITS, dtype=np.uint64)
        low[: self.count] = mixed(least.astype(np.uint64)) & np.uint64((1 << BITS) - 1)
        shifts = np.arange(0, 64, BITS, dtype=np.uint64)
        return np.bitwise_or.reduce(low.reshape(self.words, -1) << shifts, axis=1).tobytes()


def estimates(a: np.ndarray, b: np.ndarray, count: int) -> np.ndarray:
    """Similarity of signature rows (64-bit words): share of equal values, less what chance gives."""
    differ = a ^ b
    differ |= differ >> np.uint64(2)
    differ |= differ >> np.uint64(1)
    differ &= np.uint64(0x1111111111111111)
    share = 1 - np.bitwise_count(differ).sum(axis=1) / count
    chance = 0.5**BITS
    return (share - chance) / (1 - chance)


def least_estimate(percent: int, count: int) -> float:
    """The cut of the estimate: a link at the threshold falls below it with a probability of at most ``MISS``."""
    chance, below = 0.5**BITS, 0.0
    agree = percent / 100 + (1 - percent / 100) * chance
    for most in range(count + 1):  # minima that agree by value or by chance
        below += comb(count, most) * agree**most * (1 - agree) ** (count - most)
        if below > MISS:
            break
    return min(percent / 100 - SLACK, ((most - 0.5) / count - chance) / (1 - chance))


def features(df: DataFrame, key: str, text: str, bands: int, rows: int) -> DataFrame:
    """key, row, n, print (of the set; null if empty), keys of the bands, packed signature."""
    kind = df.schema[key].dataType.simpleString()
    source = df.select(F.col(key).alias("key"), F.col(ROW).alias("row"), text_of(df, text).cast("binary").alias("content"))

    def work(batches):
        import xxhash

        signer = Signer(bands, rows)
        for batch in batches:
            n, prints, keys, signatures = [], [], [], []
            for content in batch.column(2):
                shingles = shingle_set(content.as_py())
                n.append(len(shingles))
                if len(shingles):
                    least = signer.minima(shingles)
                    prints.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                    keys.append(signer.band_keys(least))
                    signatures.append(signer.packed(least))
                else:
                    prints.append(None)
                    keys.append(None)
                    signatures.append(None)
            columns = [*batch.columns[:2], pa.array(n, pa.int64()), pa.array(prints, pa.binary())]
            columns += [pa.array(keys, pa.list_(pa.int64())), pa.array(signatures, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "row", "n", "print", "bands", "signature"])

    return map_batches(source, work, f"key {kind}, row long, n long, print binary, bands array<long>, signature binary")


def pair_positions(group: np.ndarray, side: np.ndarray):
    """Positions of all pairs to compare, chunk by chunk, in rows sorted by (group, side).

    Side -1: all pairs within the group; else each row of side 0 with each of side 1.
    """
    n = len(group)
    new = np.r_[True, group[1:] != group[:-1]]
    ends = np.r_[np.flatnonzero(new)[1:], n][np.cumsum(new) - 1]
    turns = np.r_[True, new[1:] | (side[1:] != side[:-1])]
    next_turn = np.r_[np.flatnonzero(turns)[1:], n][np.cumsum(turns) - 1]
    first = np.where(side < 0, np.arange(n) + 1, np.where(side == 0, next_turn, ends))
    counts = ends - first
    for a, b in slices(counts.tolist(), PAIRS_AT_ONCE):
        part = counts[a:b]
        left = np.repeat(np.arange(a, b), part)
        right = np.arange(part.sum()) - np.repeat(np.cumsum(part) - part, part) + np.repeat(first[a:b], part)
        yield left, right


def members_of_groups(classes: DataFrame) -> DataFrame:
    """group, side, band, row, n, bands, signature: the classes that share a band key, dealt into groups of blocks."""
    exploded = classes.select("row", F.posexplode("bands").alias("band", "key"))
    shared = exploded.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    members = exploded.join(shared, "key").withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int"))
    own = F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")
    members = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    side = F.when(low == high, -1).when(F.col("own") == low, 0).otherwise(1)
    members = members.select(F.xxhash64("key", low, high).alias("group"), side.alias("side"), "band", "row")
    return members.join(classes.select("row", "n", "bands", "signature"), "row").select(
        "group", "side", "band", "row", "n", "bands", "signature"
    )


def tiles(group: np.ndarray, size: np.ndarray, most: int) -> np.ndarray:
    """Number of each row's tile within its group: consecutive rows of ``most`` bytes together at most, or a single row."""
    tile = np.zeros(len(group), dtype=np.int64)
    borders = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True])
    heavy = np.flatnonzero(np.add.reduceat(size, borders[:-1]) > most)
    for start, end in zip(borders[heavy], borders[heavy + 1]):
        for k, (a, b) in enumerate(slices(size[start:end].tolist(), most)):
            tile[start + a : start + b] = k
    return tile


def listed(group: np.ndarray, row: np.ndarray, n: np.ndarray, left: np.ndarray, right: np.ndarray, most: int) -> pa.RecordBatch:
    """group, row, partners of the pairs (positions, ``left`` before ``right``), in groups whose sets need ``most`` bytes at most."""
    used = np.zeros(len(row), dtype=bool)
    used[left] = used[right] = True
    tile = tiles(group, np.where(used, 8 * n, 0), most // 2)
    a, b = tile[left].astype(np.uint64), tile[right].astype(np.uint64)
    name = group[left].copy()
    apart = b > 0
    name[apart] = mixed(mixed(name[apart].view(np.uint64) * MIX + a[apart]) * MIX + b[apart]).view(np.int64)
    names, at = np.unique(name, return_inverse=True)
    lefts, rights = at * len(row) + left, at * len(row) + right
    members = np.unique(np.concatenate([lefts, rights]))
    places, counts = np.unique(lefts, return_counts=True)
    sizes = np.zeros(len(members), dtype=np.int64)
    sizes[np.searchsorted(members, places)] = counts
    partners = row[right[np.argsort(lefts, kind="stable")]]
    lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(partners))
    columns = [pa.array(names[members // len(row)]), pa.array(row[members % len(row)]), lists]
    return pa.RecordBatch.from_arrays(columns, ["group", "row", "partners"])


def candidates(members: DataFrame, count: int, percent: int) -> DataFrame:
    """group, row, partners: pairs whose estimate may belong to a link, listed at the first of the two rows."""
    least, most = least_estimate(percent, count), SET_BYTES

    def work(batches):
        for table in whole_groups(batches, 0):
            table = table.combine_chunks()
            group, side, band, row, n = (table.column(i).to_numpy() for i in range(5))
            bands = table.column(5).combine_chunks().flatten().to_numpy().reshape(len(row), -1)
            signature = np.frombuffer(b"".join(table.column(6).to_pylist()), dtype=np.uint64).reshape(len(row), -1)
            lefts, rights = [], []
            for left, right in pair_positions(group, side):
                a, b = n[left], n[right]
                good = 100 * np.minimum(a, b) >= percent * np.maximum(a, b)
                left, right = left[good], right[good]
                good = estimates(signature[left], signature[right], count) >= least
                left, right = left[good], right[good]
                same = bands[left] == bands[right]
                good = same.any(axis=1) & (same.argmax(axis=1) == band[left])
                lefts.append(left[good])
                rights.append(right[good])
            if sum(map(len, lefts)):
                yield listed(group, row, n, np.concatenate(lefts), np.concatenate(rights), most)

    dealt = members.repartition("group").sortWithinPartitions("group", "side", "row")
    return map_batches(dealt, work, "group long, row long, partners array<long>")


def place_of(row: str) -> Column:
    return F.pmod(F.xxhash64(row), F.lit(FILTER_BITS))


def row_filter(rows: DataFrame) -> np.ndarray:
    """Bits set at the places of the wanted rows, as 64-bit words: a bloom filter of fixed size with one hash."""
    words = rows.select(place_of("row").alias("place")).groupBy(F.expr("place div 64").alias("word"))
    found = words.agg(F.expr("bit_or(shiftleft(1L, cast(place % 64 as int)))").alias("bits")).collect()
    bits = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    bits[[r.word for r in found]] = [r.bits for r in found]
    return bits


def full_sets(df: DataFrame, rows: DataFrame, text: str) -> DataFrame:
    """row, shingles (sorted 64-bit hashes) of the wanted rows, and of a few more that the filter lets through."""
    shared = df.sparkSession.sparkContext.broadcast(row_filter(rows))
    source = df.select(F.col(ROW).alias("row"), place_of(ROW).alias("place"), text_of(df, text).cast("binary").alias("content"))

    def work(batches):
        bits = shared.value
        for batch in batches:
            place = batch.column(1).to_numpy()
            batch = batch.filter(pa.array((bits[place // 64] >> (place % 64)) & 1 == 1))
            for part in parts(batch, 2, SENT_BYTES):
                sets = [shingle_set(c.as_py()).tobytes() for c in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], ["row", "shingles"])

    return map_batches(source, work, "row long, shingles binary")


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    place = b.searchsorted(a)
    place[place == len(b)] = 0
    both = int((b[place] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def links(wanted: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b: a spanning forest of the confirmed links of each group."""

    def work(batches):
        for table in whole_groups(batches, 0):
            group, row = table.column(0).to_numpy(), table.column(1).to_numpy()
            partners, shingles = table.column(2), table.column(3)
            borders = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True])
            edges = []
            for start, end in zip(borders, borders[1:]):
                place = {int(r): i for i, r in enumerate(row[start:end])}
                full = [np.frombuffer(shingles[i].as_py(), dtype=np.uint64) for i in range(int(start), int(end))]
                above = list(range(len(full)))

                def root(i, above=above):
                    while above[i] != i:
                        above[i] = i = above[above[i]]
                    return i

                for i in range(len(full)):
                    for other in partners[int(start) + i].as_py():
                        j = place[other]
                        if (x := root(i)) != (y := root(j)) and linked(full[i], full[j], percent):
                            above[max(x, y)] = min(x, y)
                            edges.append((int(row[start + i]), other))
            if edges:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*edges)], ["a", "b"])

    dealt = wanted.join(sets, "row").select("group", "row", "partners", "shingles")
    return map_batches(dealt.repartition("group").sortWithinPartitions("group", "row"), work, "a long, b long")


def numbered(df: DataFrame) -> DataFrame:
    return df.withColumn(ROW, F.monotonically_increasing_id())


def components(df: DataFrame, key: str, text: str, percent: int, bands: int, rows: int) -> DataFrame:
    """key, row, n, component (its smallest key) and component_row (the row that stays), for numbered ``df``."""
    folder = shared_folder(df.sparkSession)
    described = stored(features(df, key, text, bands, rows), folder, "features")
    best = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "row"))
    sets = described.where(F.col("print").isNotNull()).groupBy("print")
    classes = stored(sets.agg(F.min("row").alias("class"), best.alias("best")), folder, "classes")
    first = described.join(classes.select(F.col("class").alias("row")), "row", "left_semi")
    first = stored(first.select("row", "n", "bands", "signature"), folder, "first")
    wanted = stored(candidates(members_of_groups(first), bands * rows, percent), folder, "candidates")
    needed = full_sets(df, wanted, text)
    found = connected_components(links(wanted, needed, percent))
    whole = classes.join(found.withColumnRenamed("node", "class"), "class", "left")
    whole = whole.withColumn("root", F.coalesce("root", "class"))
    best = whole.groupBy("root").agg(F.min("best").alias("best"))
    by_print = whole.select("print", "root").join(best, "root").select("print", "best")
    joined = described.select("key", "row", "n", "print").join(by_print, "print", "left")
    alone = F.col("best").isNull()
    return joined.select(
        "key",
        "row",
        "n",
        F.when(alone, F.col("key")).otherwise(F.col("best.key")).alias("component"),
        F.when(alone, F.col("row")).otherwise(F.col("best.row")).alias("component_row"),
    )


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 85, bands: int = 24, rows: int = 5
) -> DataFrame:
    """The key, n_shingles, component_id and kept, one row per input row."""
    found = components(numbered(df.select(key, text)), key, text, percent, bands, rows)
    return found.select(
        F.col("key").alias(key),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.col("key").eqNullSafe(F.col("component")).alias("kept"),
    )


def keep_one(
    df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80, bands: int = 30, rows: int = 4
) -> DataFrame:
    """One row of each component (smallest key, then first in the table), all columns unchanged."""
    df = numbered(df)
    found = components(df.select(key, text, ROW), key, text, percent, bands, rows)
    kept = found.where(F.col("row") == F.col("component_row")).select(F.col("row").alias(ROW))
    return df.join(kept, ROW, "left_semi").drop(ROW)
