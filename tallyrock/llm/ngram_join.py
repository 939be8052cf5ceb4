"""Near duplicates by an exact Jaccard join of word-shingle sets, with R-trees of count vectors.

Two documents link when the intersection of their shingle sets is at least
`PERCENT` percent of the union; a component is what links reach. The join keeps
classes of equal sets apart from links between different sets:

1. All shingles of all documents are counted in a table of fixed size. It only
   orders the shingles, rare ones first; any order gives the same links.
2. A class is one set. Linked sets share at least one of the first
   n - ceil(0.75 n) + 1 shingles of both, so classes that share one of these
   meet in its bucket. They even share one that is among the first n - ceil(6 n / 7) + 1
   of the smaller, so in a bucket a class meets larger ones only if it has the token that near the front.
3. A class is also a point: its shingles are hashed into groups, and the group
   counts are coordinates. The intersection of two sets is at most the sum of
   coordinate minima. In a bucket, first one class meets the others;
   pairs that pass the bound are verified on the sets, and links make
   components. Buckets that then still hold different components get an R-tree
   over the points by size, whose boxes bound the overlap of a whole subtree;
   a class that is not in the tree's answer cannot link. What passes is verified
   like before; in a bucket of more than HOT classes the tree first says which of them may
   link at all, and only these are verified, in place, the most similar first, without a
   look at pairs whose classes are connected already.

Buckets are split by size of the sets, since linked sets differ by a third at
most, and then into blocks of rows that meet pair by pair, so no bucket is one
task. No copies are joined with each other, and pairs within a component need not
be found. Texts of the classes to verify are read again, so only their sets are kept.

A text of less than five words has one shingle, all of it; one without words, or
NULL, has none and links with nothing. Ids may be NULL or repeat; a component is
the smallest id in it, NULL if there is none. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallyrock.llm.common import map_rows, may_be_among, read, unused, written
from tallyrock.llm.components import components
from tallyrock.llm.shingles import shingle_sets

PERCENT = 75
TABLE = 1 << 18  # counters of the frequency table
LEVELS = 7
PER_GROUP = 2  # shingles a group at least
MOST_GROUPS = 1 << 14
HOT = 64  # classes of a bucket whose pairs are listed
BLOCK = 4096  # classes of a bucket in one task
FINE_GROUPS = 1024
NODE = 16
ROWS = 128  # texts whose shingles a task holds at a time
BAND = 1.34  # ratio of the sizes in a band, over the 4/3 that linked sets may differ


def least_overlap(total):
    """The smallest intersection that links two sets of together `total` shingles."""
    return -(-PERCENT * total // (100 + PERCENT))


def digest(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def count_shingles(documents: DataFrame) -> DataFrame:
    """A written table: (id, version, n, class) of every document, and (place, count) of each task's frequency table."""
    names = ["id", "version", "n", "class", "place", "count"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(TABLE, np.int64)
        for part in parts:
            for start in range(0, part.num_rows, ROWS):
                ids, versions, texts = (c.to_pylist() for c in part.slice(start, ROWS).columns)
                sets = shingle_sets(texts)
                counts += np.bincount((np.concatenate(sets) % TABLE).astype(np.int64), minlength=TABLE)
                empty = [None] * len(ids)
                columns = [ids, versions, [len(s) for s in sets], [digest(s) for s in sets], empty, empty]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
        places = np.flatnonzero(counts)
        empty = [None] * len(places)
        columns = [empty, empty, empty, empty, places, counts[places]]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    rows = documents.select("id", F.xxhash64("text").alias("version"), "text")
    schema = "id long, version long, n long, class binary, place long, count long"
    return written(rows.mapInArrow(work, schema), "shingles")


def rarity(counted: DataFrame) -> np.ndarray:
    """The level of each place of the frequency table: 0 up to twice the mean, and so on by powers of two."""
    rows = counted.where("place IS NOT NULL").groupBy("place").agg(F.sum("count").alias("count")).toPandas()
    counts = np.zeros(TABLE)
    counts[rows["place"].to_numpy(np.int64)] = rows["count"].to_numpy()
    mean = max(1.0, counts.mean())
    return np.clip(np.floor(np.log2(np.maximum(counts, 1) / mean)), 0, LEVELS).astype(np.uint8)


def point(shingles: np.ndarray) -> bytes:
    """Counts by group; a power of two of groups, so that a longer point folds onto a shorter one."""
    groups = 8
    while groups < MOST_GROUPS and 2 * PER_GROUP * groups <= len(shingles):
        groups *= 2
    counts = np.bincount((shingles >> np.uint64(8)).astype(np.int64) % groups, minlength=groups)
    if counts.max() > 255:
        return counts.astype(np.uint16).tobytes() + b"\2"
    counts = counts.astype(np.uint8)
    return counts.tobytes() + b"\1" if counts.max() > 15 else (counts[::2] | counts[1::2] << 4).tobytes() + b"\0"


def unpack(raw: bytes) -> np.ndarray:
    """The last byte says how long a count is: half a byte, one or two."""
    if raw[-1]:
        return np.frombuffer(raw[:-1], np.uint8 if raw[-1] == 1 else np.uint16).astype(np.int32)
    pairs = np.frombuffer(raw[:-1], np.uint8)
    return np.stack([pairs & 15, pairs >> 4], axis=1).reshape(-1).astype(np.int32)


def fold(counts: np.ndarray, groups: int) -> np.ndarray:
    return counts.reshape(-1, groups).sum(axis=0)


def pack_order(values: np.ndarray) -> bytes:
    """Numbers in rising order as their steps, each of as many bytes as the largest needs, after that number."""
    steps = np.diff(values, prepend=np.uint64(0))
    width = max(1, -(-int(steps.max()).bit_length() // 8))
    return bytes([width]) + steps.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack_order(raw: bytes) -> np.ndarray:
    width = raw[0]
    wide = np.zeros(((len(raw) - 1) // width, 8), np.uint8)
    wide[:, :width] = np.frombuffer(raw, np.uint8, offset=1).reshape(-1, width)
    return np.cumsum(wide.view(np.uint64).reshape(-1), dtype=np.uint64)


def classes(documents: DataFrame, levels: np.ndarray) -> DataFrame:
    """A written table of the classes: cid, class, id (smallest), n, packed prefix and point."""

    def work(columns: list[list]) -> list[list]:
        found = []
        for doc_id, shingles in zip(columns[0], shingle_sets(columns[1])):
            n = len(shingles)
            if n:
                level = levels[(shingles % TABLE).astype(np.int64)].astype(np.uint64)
                order = np.sort((level << np.uint64(61)) | (shingles >> np.uint64(3)))
                # A token that stands for several shingles only makes classes meet that need not.
                prefix = pack_order(order[: n - -(-PERCENT * n // 100) + 1] >> np.uint64(16))
                found.append((doc_id, digest(shingles), n, prefix, point(shingles)))
        return [list(c) for c in zip(*found)] or [[]] * 5

    schema = "id long, class binary, n long, prefix binary, point binary"
    rows = map_rows(documents, work, schema, rows=ROWS)
    # Copies are combined in the map tasks first.
    groups = rows.groupBy("class").agg(
        F.min("id").alias("id"), *(F.first(c).alias(c) for c in ("n", "prefix", "point"))
    )
    return written(groups.withColumn("cid", F.monotonically_increasing_id()), "classes")


def with_prefixes(found: DataFrame) -> DataFrame:
    """(cid, n, prefix) of the classes, the prefix as numbers in their order."""

    def work(columns: list[list]) -> list[list]:
        return [*columns[:2], [unpack_order(raw).view(np.int64) for raw in columns[2]]]

    return map_rows(found.select("cid", "n", "prefix"), work, "cid long, n long, prefix array<long>")


def may_link(na: str, nb: str):
    """Whether sets of these sizes may link."""
    return F.least(na, nb) * (100 + PERCENT) >= (F.col(na) + F.col(nb)) * PERCENT


def buckets(found: DataFrame) -> DataFrame:
    """A written table of (token, cid, n, near, members, leader, leader_n) of the tokens that more than one class has.

    `near` is whether the token stands so near the front of the prefix that the class meets larger ones by it. The
    leader is such a class, and a class that neither is near nor has a near one of its size or less before it is left out.
    """
    tokens = found.select("cid", "n", F.posexplode("prefix").alias("place", "token"))
    near = F.expr(f"place <= n - (2 * {PERCENT} * n + {99 + PERCENT}) DIV {100 + PERCENT}")
    # These rows are most of what is shuffled: both in one column, before the token.
    tokens = tokens.select("cid", (2 * F.col("n") + near.cast("int")).alias("both"), "token").repartition("token")
    tokens = tokens.select("token", "cid", F.expr("both DIV 2").alias("n"), F.expr("both % 2 = 1").alias("near"))
    same = Window.partitionBy("token")
    near_cid, near_n = F.when(F.col("near"), F.col("cid")), F.when(F.col("near"), F.col("n"))
    over = {"members": F.count("*"), "leader": F.min(near_cid), "leader_n": F.min_by("n", near_cid), "least": F.min(near_n)}
    rows = tokens.withColumns({name: value.over(same) for name, value in over.items()})
    return written(rows.where("members > 1 AND (near OR n >= least)").drop("least"), "buckets")


def star_pairs(rows: DataFrame) -> DataFrame:
    """(a, b, na, nb): each bucket's leader with every other one that may link with it by size."""
    stars = rows.where((F.col("cid") != F.col("leader")) & may_link("leader_n", "n") & F.expr("near OR n >= leader_n"))
    return stars.select(F.col("leader").alias("a"), F.col("cid").alias("b"), F.col("leader_n").alias("na"), F.col("n").alias("nb")).distinct()


def with_points(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs (a, b) of (a, b, na, nb) that their points allow to link."""
    points = found.select("cid", "point")
    both = pairs.join(points.toDF("a", "pa"), "a").join(points.toDF("b", "pb"), "b")

    def work(columns: list[list]) -> list[list]:
        kept = [allowed(*row) for row in zip(*columns[2:])]
        return [[v for v, k in zip(c, kept) if k] for c in columns[:2]]

    return map_rows(both.select("a", "b", "na", "nb", "pa", "pb"), work, "a long, b long")


def allowed(na: int, nb: int, pa_: bytes, pb: bytes) -> bool:
    x, y = unpack(pa_), unpack(pb)
    groups = min(len(x), len(y))
    return int(np.minimum(fold(x, groups), fold(y, groups)).sum()) >= least_overlap(na + nb)


def pack_set(shingles: np.ndarray) -> bytes:
    """The upper 48 bits of each hash, in order: they decide whether shingles are equal."""
    return (shingles >> np.uint64(16)).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack_set(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return wide.view(np.uint64).reshape(-1)


def known_sets(wanted: DataFrame, found: DataFrame, documents: DataFrame) -> DataFrame:
    """A written table (cid, set) of some classes; their texts are read once more.

    Most texts that are not wanted are dropped before the shuffle. A task makes a class's set once, and
    only if several tasks have made one, since an id and its text repeat, do the sets move to drop them.
    """
    ids = wanted.distinct().join(found.select("cid", "class", F.col("id").alias("wanted")), "cid")
    ids = written(ids, "wanted")
    some = may_be_among(documents, "id", ids, "wanted")
    texts = some.join(ids, F.col("id").eqNullSafe(F.col("wanted")))

    made = set()

    def sets(columns: list[list]) -> list[list]:
        rows = []
        for cid, kind, s in zip(columns[0], columns[1], shingle_sets(columns[2])):
            if cid not in made and digest(s) == kind:
                made.add(cid)
                rows.append((cid, pack_set(s)))
        return [list(c) for c in zip(*rows)] or [[]] * 2

    known = map_rows(texts.select("cid", "class", "text"), sets, "cid long, set binary", rows=ROWS)
    known = written(known, "sets")
    repeated = known.groupBy("cid").agg(F.count("*").alias("copies")).where("copies > 1")
    return known if repeated.isEmpty() else written(known.dropDuplicates(["cid"]), "sets")


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    return len(np.intersect1d(x, y, assume_unique=True))


def verified(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets link, as a written table."""

    def links(columns: list[list]) -> list[list]:
        kept = []
        for a, b, x, y in zip(*columns):
            x, y = unpack_set(x), unpack_set(y)
            if overlap(x, y) >= least_overlap(len(x) + len(y)):
                kept.append((a, b))
        return [list(c) for c in zip(*kept)] or [[]] * 2

    both = pairs.join(known.toDF("a", "x"), "a").join(known.toDF("b", "y"), "b").select("a", "b", "x", "y")
    return written(map_rows(both, links, "a long, b long", rows=256), "verified")


def ends_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("cid"))


class RTree:
    """A packed R-tree of points in the order of their set sizes; a box keeps its largest counts and smallest size."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.order = np.argsort(sizes, kind="stable")
        self.levels = [(points[self.order], sizes[self.order])]
        while len(self.levels[-1][1]) > NODE:
            high, low = self.levels[-1]
            firsts = np.arange(0, len(low), NODE)
            self.levels.append((np.maximum.reduceat(high, firsts, axis=0), np.minimum.reduceat(low, firsts)))

    def search(self, counts: np.ndarray, size: int) -> np.ndarray:
        """Places of all points that may link with this one."""
        nodes = np.arange(len(self.levels[-1][1]))
        for depth, (high, low) in enumerate(reversed(self.levels)):
            if depth:
                nodes = (nodes[:, None] * NODE + np.arange(NODE)).reshape(-1)
                nodes = nodes[nodes < len(low)]
            overlap = np.minimum(high[nodes], counts).sum(axis=1)
            nodes = nodes[overlap >= least_overlap(size + low[nodes])]
            if not len(nodes):
                break
        return self.order[nodes]


def tree_pairs(rows: list[tuple]) -> list[tuple[int, int]]:
    """Pairs of a bucket's rows (cid, n, component, upper, point) that may link across components.

    Rows of the upper band meet those of the lower only.
    """
    cids, sizes, comps, upper, raw = zip(*rows)
    points = [unpack(p) for p in raw]
    groups = min(map(len, points))
    points = [p if len(p) == groups else fold(p, groups) for p in points]
    found = []
    if len(rows) <= NODE:
        for i, j in combinations(range(len(rows)), 2):
            need = least_overlap(sizes[i] + sizes[j])
            if comps[i] != comps[j] and not (upper[i] and upper[j]) and min(sizes[i], sizes[j]) >= need:
                if np.minimum(points[i], points[j]).sum() >= need:
                    found.append((min(cids[i], cids[j]), max(cids[i], cids[j])))
        return found
    lower, matrix = np.flatnonzero(np.array(upper) == 0), np.stack(points)
    tree = RTree(matrix[lower], np.array(sizes)[lower])
    for k in range(len(rows)):
        for j in lower[tree.search(matrix[k], sizes[k])].tolist():
            if comps[j] != comps[k] and (upper[k] or j > k):
                found.append((min(cids[j], cids[k]), max(cids[j], cids[k])))
    return found


def linked_in_place(rows: list[tuple]) -> list[tuple[int, int]]:
    """Links that connect the components of a bucket's rows (cid, n, component, upper, side, set).

    Of two blocks only pairs across them count; rows of the upper band meet those of the lower only.
    """
    cids, sizes, comps, upper, side = (np.array(c, np.int64) for c in list(zip(*rows))[:5])
    sets = [unpack_set(r[5]) for r in rows]
    groups = 8
    while groups < FINE_GROUPS and groups < sizes.max():
        groups *= 2
    matrix = np.stack([np.bincount((s >> np.uint64(8)).astype(np.int64) % groups, minlength=groups) for s in sets])
    matrix = matrix.astype(np.int32)
    lower = np.flatnonzero(upper == 0)
    if not len(lower):
        return []
    tree, two_blocks, found = RTree(matrix[lower], sizes[lower]), side.min() != side.max(), []
    root = np.unique(comps, return_inverse=True)[1]
    for k in range(len(rows)):
        near = lower[tree.search(matrix[k], int(sizes[k]))]
        near = near[(root[near] != root[k]) & ((upper[k] == 1) | (near > k)) & ~(two_blocks & (side[near] == side[k]))]
        closest = np.argsort(-np.minimum(matrix[near], matrix[k]).sum(axis=1), kind="stable")
        for j in near[closest].tolist():
            if root[j] != root[k] and overlap(sets[j], sets[k]) >= least_overlap(int(sizes[j] + sizes[k])):
                found.append((int(cids[k]), int(cids[j])))
                root[root == root[j]] = root[k]
    return found


def mixed_buckets(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """A written table of the buckets, without their leaders, that hold different components.

    Buckets are split by bands of sizes; a row stands in its own band, and as `upper` in the one
    below. (sign, members) names a bucket, and buckets with the same rows are one.
    """
    known = rows.where("members > 2 AND cid <> leader").join(parts.toDF("cid", "component"), "cid", "left")
    known = known.withColumn("component", F.coalesce("component", "cid"))
    # What is in one component needs no bands.
    token = Window.partitionBy("token")
    known = known.withColumns({"low": F.min("component").over(token), "high": F.max("component").over(token)})
    known = known.where("low <> high").drop("low", "high", "leader", "leader_n", "members")
    band = F.floor(F.log("n") / F.log(F.lit(BAND)))
    places = F.array(
        F.struct(band.alias("band"), F.lit(0).alias("upper")), F.struct((band - 1).alias("band"), F.lit(1).alias("upper"))
    )
    banded = known.withColumn("in", F.explode(places)).select("cid", "n", "near", "component", "token", "in.band", "in.upper")
    same = Window.partitionBy("token", "band")
    # As in `buckets`: the smaller of two that meet is near, and in the band itself.
    least = F.min(F.when(F.col("near") & (F.col("upper") == 0), F.col("n"))).over(same)
    banded = banded.withColumn("least", least).where("least IS NOT NULL AND (near OR n >= least)")
    mixed = banded.withColumns(
        {
            "low": F.min("component").over(same),
            "high": F.max("component").over(same),
            "uppers": F.sum("upper").over(same),
            "members": F.count("*").over(same),
            "sign": F.bit_xor(F.xxhash64("cid", "upper")).over(same),
        }
    ).where("low <> high AND uppers < members")
    return written(mixed.select("sign", "members", "cid", "n", "component", "upper").distinct(), "mixed")


def pairs_of_small(mixed: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs (a, b) across components that may link, from buckets of at most HOT rows."""
    points = found.select("cid", "point")
    rows = mixed.where(F.col("members") <= HOT).join(points, "cid")
    keys = ["sign", "members"]
    dealt = rows.select(*keys, "cid", "n", "component", "upper", "point").repartition(*keys)
    return runs(dealt.sortWithinPartitions(*keys, "cid", "upper"), len(keys), tree_pairs, "a long, b long").distinct()


def maybe_linked(rows: list[tuple]) -> list[tuple[int]]:
    """The cids of a bucket's rows (cid, n, component, upper, side, point) that may link with one of another component.

    Of two blocks only pairs across them count; rows of the upper band meet those of the lower only.
    """
    cids, sizes, comps, upper, side = (np.array(c, np.int64) for c in list(zip(*rows))[:5])
    points = [unpack(r[5]) for r in rows]
    groups = min(FINE_GROUPS, *map(len, points))
    matrix = np.stack([p if len(p) == groups else fold(p, groups) for p in points])
    lower = np.flatnonzero(upper == 0)
    if not len(lower):
        return []
    tree, two_blocks, found = RTree(matrix[lower], sizes[lower]), side.min() != side.max(), np.zeros(len(rows), bool)
    for k in range(len(rows)):
        near = lower[tree.search(matrix[k], int(sizes[k]))]
        near = near[(comps[near] != comps[k]) & ~(two_blocks & (side[near] == side[k]))]
        found[near] = True
        found[k] |= len(near) > 0
    return [(int(c),) for c in cids[found]]


def in_blocks(large: DataFrame, payload: DataFrame, name: str) -> DataFrame:
    """Rows of large buckets with a column of theirs, dealt so that every two blocks of a bucket meet in one run."""
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    rows = large.withColumns({"blocks": blocks, "own": F.pmod(F.xxhash64("cid"), blocks).cast("int")})
    split = rows.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    split = split.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
    keys = ["sign", "members", "i", "j"]
    dealt = split.join(payload, "cid").select(*keys, "cid", "n", "component", "upper", "own", name).repartition(*keys)
    return dealt.sortWithinPartitions(*keys, "cid", "upper")


def candidates_of_large(mixed: DataFrame, found: DataFrame) -> DataFrame:
    """A written table of the rows of buckets of more than HOT rows that may link across components, by their points."""
    large = mixed.where(F.col("members") > HOT)
    near = runs(in_blocks(large, found.select("cid", "point"), "point"), 4, maybe_linked, "cid long")
    return written(large.join(near, "cid", "left_semi"), "candidates")


def links_of_large(candidates: DataFrame, known: DataFrame) -> DataFrame:
    """Links (a, b) that connect the components of these rows, bucket by bucket and block by block."""
    return runs(in_blocks(candidates, known, "set"), 4, linked_in_place, "a long, b long").distinct()


def runs(frame: DataFrame, keys: int, work: Callable[[list[tuple]], list[tuple]], schema: str) -> DataFrame:
    """`work` on the rows of each run of equal keys, the first columns, of a frame sorted by them."""
    names = [part.split()[0] for part in schema.split(", ")]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, found = None, [], []
        for part in parts:
            for row in zip(*(c.to_pylist() for c in part.columns)):
                if row[:keys] != current:
                    if held:
                        found += work(held)
                    current, held = row[:keys], []
                held.append(row[keys:])
            yield batch(found)
            found = []
        yield batch(work(held) if held else [])

    def batch(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return frame.mapInArrow(batches, schema)


def near_duplicates(documents: DataFrame) -> DataFrame:
    """A row per row of `documents` (id, text): id, n_shingles, component_id, version and component.

    `version` is a hash of the text. `component` numbers the components, also where ids repeat or are
    NULL; it is NULL for sets without shingles.
    """
    documents = documents.select("id", "text")
    counted = count_shingles(documents)
    found = classes(documents, rarity(counted))
    rows = buckets(with_prefixes(found))

    pairs = written(with_points(star_pairs(rows), found), "pairs")
    links = verified(pairs, known_sets(ends_of(pairs), found, documents))

    mixed = mixed_buckets(rows, components(links))
    pairs = written(pairs_of_small(mixed, found), "pairs")
    large = candidates_of_large(mixed, found)
    known = known_sets(ends_of(pairs).unionAll(large.select("cid")), found, documents)
    more = verified(pairs, known).unionAll(written(links_of_large(large, known), "verified"))
    parts = components(links.unionAll(more))

    ids = found.select("cid", "class", "id").join(parts.toDF("cid", "component"), "cid", "left")
    ids = ids.withColumn("component", F.coalesce("component", "cid"))
    names = ids.groupBy("component").agg(F.min("id").alias("component_id"))
    by_class = ids.select("class", "component").join(names, "component")
    answers = counted.where("place IS NULL").select("id", "version", F.col("n").alias("n_shingles"), "class")
    joined = answers.join(by_class, "class", "left")
    named = F.when(F.col("n_shingles") == 0, F.col("id")).otherwise(F.col("component_id"))
    return joined.select("id", "n_shingles", named.alias("component_id"), "version", "component")


def one_of_each(documents: DataFrame) -> DataFrame:
    """The documents, with all their columns, of which each component keeps that with the smallest doc_id.

    A NULL id comes last, then the hash of the text decides. Texts without words all stay. Of rows
    with the same id and text one stays.
    """
    rows = written(near_duplicates(documents.select(F.col("doc_id").alias("id"), "text")), "components")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "version")
    firsts = rows.where("component IS NOT NULL").groupBy("component").agg(F.min(order).alias("first"))
    empty = rows.where("component IS NULL").select("id", "version").distinct()
    kept = firsts.select("first.id", "first.version").unionAll(empty)
    # Names that no column of the documents has.
    key, text, many = (unused(documents, n) for n in ("kept_id", "kept_version", "kept_copies"))
    copies = rows.groupBy("id", "version").agg(F.count("*").alias(many)).toDF(key, text, many)
    met = F.col("id").eqNullSafe(F.col(key)) & (F.col("version") == F.col(text))
    kept = written(kept.join(copies, met).select(key, text, many), "kept")
    same = F.col("doc_id").eqNullSafe(F.col(key)) & (F.xxhash64("text") == F.col(text))
    single, repeated = kept.where(F.col(many) == 1), kept.where(F.col(many) > 1)
    found = documents.join(single, same, "left_semi")
    if repeated.isEmpty():
        return found
    return found.unionAll(documents.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"]))


def op10_count_vector_rtree(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents", F.col("doc_id").alias("id"), "text")
    return near_duplicates(documents).select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


OP10_SQL = r"""
WITH RECURSIVE said AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda k: array_to_string(words[k:k + 4], ' ')) END) AS shingles
  FROM said),
sorted AS (SELECT doc_id, list_sort(shingles) AS shingles FROM sets),
classes AS (SELECT shingles, min(doc_id) AS class FROM sorted GROUP BY shingles),
members AS (SELECT doc_id, len(s.shingles) AS n, class FROM sorted s JOIN classes c ON s.shingles = c.shingles),
rows AS (SELECT class, len(shingles) AS n, unnest(shingles) AS shingle FROM classes),
met AS (
  SELECT a.class AS a, b.class AS b, a.n AS na, b.n AS nb, count(*) AS common FROM rows a JOIN rows b
    ON a.shingle = b.shingle AND a.class < b.class GROUP BY ALL),
links AS (SELECT a, b FROM met WHERE 100 * common >= 75 * (na + nb - common)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(class, other) AS (
  SELECT class, class FROM classes
  UNION SELECT r.class, e.b FROM reached r JOIN edges e ON r.other = e.a),
names AS (SELECT class, min(other) AS component FROM reached GROUP BY class)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, CASE WHEN n = 0 THEN doc_id ELSE component END AS component_id
FROM members JOIN names USING (class)
"""
