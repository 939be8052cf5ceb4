"""A table with one row per key, in hash buckets of the key, of which a merge rewrites only those it touches.

Every merge writes its buckets under a version of its own. Then it adds a note to the table's journal,
which names the version of every bucket and the batches that have been taken in. The note is what counts: a
merge that stopped before it left files that nobody reads and that the next one
replaces, so no batch is counted twice. Files of buckets that a merge does not touch stay as they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyrock.sources.files import Journal, names_in, remove

BUCKET, SLICE, VERSION = "bucket", "slice", "version"
ASIDE = "_aside-"
BUCKETS = 64
# Rows of a bucket that one task of a merge sorts and writes; a larger bucket is split by a hash of its keys.
SLICE_ROWS = 200_000


@dataclass(frozen=True)
class State:
    """What the last note says: the buckets' versions, and the batches that are in them."""

    note: int = 0
    version: int = 0
    buckets: int = 0
    versions: dict[int, int] = field(default_factory=dict)
    taken: frozenset[str] = frozenset()


class BucketedTable:
    """`buckets` holds for a new table; one that exists keeps its own number.

    Choose it so that an increment has rows for few of them. A bucket may outgrow a task: a merge splits
    it, by keys, into slices of some SLICE_ROWS rows.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], schema: str, buckets: int = BUCKETS):
        self.spark, self.path, self.keys, self.schema = spark, path.rstrip("/"), list(keys), schema
        self.journal, self.new_buckets = Journal(spark, f"{self.path}/_notes"), buckets

    def state(self) -> State:
        number, note = self.journal.last()
        if note is None:
            return State(note=number, buckets=self.new_buckets)
        versions = {int(b): v for b, v in note["versions"].items()}
        return State(number, note["version"], note["buckets"], versions, frozenset(note["taken"]))

    def bucket_of(self, state: State) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(state.buckets)).cast("int")

    def folder(self, state: State, bucket: int) -> str:
        return f"{self.path}/{VERSION}={state.versions[bucket]}/{BUCKET}={bucket}"

    def read(self, state: State | None = None, buckets: Iterable[int] | None = None, keep_bucket: bool = False) -> DataFrame:
        """The rows as of a state, of some buckets or all."""
        state = state or self.state()
        chosen = sorted(state.versions if buckets is None else set(buckets) & set(state.versions))
        schema = f"{self.schema}, {VERSION} BIGINT, {BUCKET} INT"
        if chosen:
            folders = [self.folder(state, b) for b in chosen]
            rows = self.spark.read.schema(schema).option("basePath", self.path).parquet(*folders)
        else:
            rows = self.spark.createDataFrame([], schema)
        return rows.drop(VERSION) if keep_bucket else rows.drop(VERSION, BUCKET)

    def merge(
        self,
        state: State,
        rows: DataFrame,
        taken: Iterable[str],
        prepare: Callable[[DataFrame], DataFrame],
        combine: Callable[[DataFrame, list[str]], DataFrame],
        check: Callable[[], None] = lambda: None,
        keep: bool = False,
    ) -> State:
        """Takes in rows, which are those of the batches named, and returns the new state.

        prepare makes of them rows of the table, few per key. combine makes one row per
        key again of these and the stored ones; the keys it is given start with the bucket and its slice, by which its
        input is dealt, so it adds no shuffle. The buckets to touch, and their sizes, are found from the keys
        and the stored files' footers alone. With keep, what prepare makes is written aside first and measured there:
        for a prepare that leaves few rows, so that the rows are read once and slices follow what
        is merged. check may raise before the note is added.
        """
        prepared, aside = prepare(rows).withColumn(BUCKET, self.bucket_of(state)), f"{self.path}/{ASIDE}{uuid.uuid4().hex}"
        sized = rows.select(self.bucket_of(state).alias(BUCKET))
        try:
            if keep:
                prepared.write.parquet(aside)
                prepared = sized = self.spark.read.schema(f"{self.schema}, {BUCKET} INT").parquet(aside)
            version, versions = self._write(state, prepared, self._sizes(sized), combine)
        finally:
            if keep:
                remove(self.spark, aside)
        check()
        everything = state.taken | set(taken)
        note = {"version": version, "buckets": state.buckets, "versions": versions, "taken": sorted(everything)}
        number = self.journal.add(state.note, note)
        after = State(number, version, state.buckets, versions, everything)
        self._clear(state, after)
        return after

    def _write(
        self, state: State, prepared: DataFrame, new: dict[int, int], combine: Callable[[DataFrame, list[str]], DataFrame]
    ) -> tuple[int, dict[int, int]]:
        """Writes the buckets that have new rows, under the next version; returns it and that of every bucket."""
        touched = sorted(new)
        version, versions = state.version, dict(state.versions)
        if touched:
            version = state.version + 1
            stored = self.read(state, touched, keep_bucket=True)
            held = self._sizes(stored.select(BUCKET))
            most = 1 + max(new[b] + held.get(b, 0) for b in touched) // SLICE_ROWS
            both = stored.unionByName(prepared)
            # Another seed than the bucket's, which the keys of a bucket have in common.
            both = both.withColumn(SLICE, F.pmod(F.xxhash64(F.lit(SLICE), *self.keys), F.lit(most)).cast("int"))
            # Twice as many tasks as slices: those that a hash puts into one task hold up the others less.
            dealt = both.repartition(2 * most * len(touched), BUCKET, SLICE)
            merged = combine(dealt, [BUCKET, SLICE, *self.keys]).drop(SLICE)
            # Whatever a stopped merge has left under this version is replaced.
            merged.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/{VERSION}={version}")
            versions |= {b: version for b in touched}
        return version, versions

    @staticmethod
    def _sizes(buckets: DataFrame) -> dict[int, int]:
        return {r[BUCKET]: r["count"] for r in buckets.groupBy(BUCKET).count().collect()}

    def _clear(self, *states: State) -> None:
        """Removes bucket folders that neither state names, for a reader may still be at the older one, and what
        merges that stopped have left aside; another merge that still runs has lost its turn by the note."""
        kept = {(v, b) for state in states for b, v in state.versions.items()}
        for name in names_in(self.spark, self.path):
            if name.startswith(ASIDE):
                remove(self.spark, f"{self.path}/{name}")
            if not name.startswith(f"{VERSION}="):
                continue
            version = int(name.removeprefix(f"{VERSION}="))
            folders = [n for n in names_in(self.spark, f"{self.path}/{name}") if n.startswith(f"{BUCKET}=")]
            old = [n for n in folders if (version, int(n.removeprefix(f"{BUCKET}="))) not in kept]
            if len(old) == len(folders):
                remove(self.spark, f"{self.path}/{name}")
                continue
            for folder in old:
                remove(self.spark, f"{self.path}/{name}/{folder}")
