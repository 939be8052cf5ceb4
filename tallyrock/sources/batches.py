"""Tables of batches, a folder each, and their compaction level by level.

A batch that a run wrote, a leaf, is named after the mark or number it starts from. Compaction
merges neighbouring folders of one level into one of the next, whose name says which range
of starts it covers. Its rows keep the name of their leaf. A reader takes the covering set: of
folders one of which covers the other, the wider one. A merge becomes visible by one
rename and what it covers is deleted after that, so wherever it stops, no row is lost or
counted twice.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyrock.schema import BATCH_COLUMN
from tallyrock.sources.files import bytes_in, create_once, exists, move, names_in, read_text, remove
from tallyrock.sources.tables import folder_names, read_folders, read_table

LEAF_COLUMN = "leaf_batch"
LEAVES = "_leaves"
MERGING = "_merging-"
FANOUT = 8
FILE_BYTES = 256 << 20
FROM_THE_START = -(1 << 63)
NAME = re.compile(r"(from|stream)-(start|-?\d+)(?:-to-(-?\d+)-level-(\d+))?")


@dataclass(frozen=True)
class Batch:
    name: str
    kind: str
    start: int
    end: int | None  # of a merged folder: the start of what follows it
    level: int

    def covers(self, other: Batch) -> bool:
        return (
            self.end is not None
            and self.kind == other.kind
            and self.level > other.level
            and self.start <= other.start < self.end
        )


def batch_of(name: str) -> Batch | None:
    """What the name of a folder says; None for names of another form, which are never merged."""
    found = NAME.fullmatch(name)
    if not found:
        return None
    kind, start, end, level = found.groups()
    first = FROM_THE_START if start == "start" else int(start)
    return Batch(name, kind, first, None if end is None else int(end), int(level or 0))


def covering(names: Iterable[str]) -> list[str]:
    """Those folders that together hold every row once."""
    names = sorted(names)
    known = [b for b in map(batch_of, names) if b is not None]
    merged = [b for b in known if b.end is not None]
    covered = {b.name for b in known if any(m.covers(b) for m in merged)}
    return [n for n in names if n not in covered]


def stored_batches(spark: SparkSession, path: str) -> list[str] | None:
    """Values of batch_id that have a folder; None for a table of another kind, or none."""
    names = folder_names(spark, path)
    if names is None or "_spark_metadata" in names:
        return None
    start = f"{BATCH_COLUMN}="
    return [n.removeprefix(start) for n in names if n.startswith(start)]


def read_batches(
    spark: SparkSession, path: str, fmt: str, schema: str, wanted: Callable[[str], bool] = lambda name: True
) -> DataFrame:
    """The rows of the covering set's folders that are wanted, each with the batch that first held it.

    schema ends with batch_id. Tables without merged folders are read as they are.
    """
    names = None if fmt == "delta" else stored_batches(spark, path)
    chosen = [n for n in covering(names or []) if wanted(n)]
    if not any(b is not None and b.end is not None for b in map(batch_of, names or [])):
        if names and len(chosen) < len(names):
            return read_folders(spark, path, BATCH_COLUMN, set(chosen).__contains__, fmt, schema)
        return read_table(spark, path, fmt, schema)
    leaf = F.coalesce(LEAF_COLUMN, BATCH_COLUMN)
    rows = read_folders(spark, path, BATCH_COLUMN, set(chosen).__contains__, fmt, f"{schema}, {LEAF_COLUMN} STRING")
    return rows.withColumn(BATCH_COLUMN, leaf).drop(LEAF_COLUMN)


def leaves_of(spark: SparkSession, path: str, name: str) -> list[str]:
    """The batches that a folder holds."""
    place = f"{path}/{BATCH_COLUMN}={name}/{LEAVES}"
    merged = (batch := batch_of(name)) is not None and batch.end is not None
    return json.loads(read_text(spark, place)) if merged else [name]


def read_leaves(spark: SparkSession, path: str, fmt: str, schema: str, leaves: Iterable[str]) -> DataFrame:
    """The rows of these batches, wherever they are now; only folders that hold one of them are opened."""
    leaves = set(leaves)
    starts = [b for b in map(batch_of, leaves) if b is not None]

    def wanted(name: str) -> bool:
        folder = batch_of(name)
        return name in leaves or (folder is not None and any(folder.covers(b) for b in starts))

    return read_batches(spark, path, fmt, schema, wanted).filter(F.col(BATCH_COLUMN).isin(sorted(leaves)))


def next_merge(names: Iterable[str], fanout: int) -> tuple[list[Batch], Batch] | None:
    """Neighbours of the lowest level that has enough of them, and the folder after them.

    The newest folder of a kind is never among them: a run that stopped may write it again.
    """
    kinds = defaultdict(list)
    for batch in map(batch_of, covering(names)):
        if batch is not None:
            kinds[batch.kind].append(batch)
    found = []
    for batches in kinds.values():
        batches.sort(key=lambda b: b.start)
        run: list[Batch] = []
        for batch, after in zip(batches, batches[1:]):
            run = run + [batch] if run and run[-1].level == batch.level else [batch]
            if len(run) == fanout:
                found.append((run, after))
                run = []
    return min(found, key=lambda f: f[0][0].level, default=None)


def sweep(spark: SparkSession, path: str) -> None:
    """Removes what a stopped compaction has left: unfinished merges and folders that a merged one covers."""
    for name in names_in(spark, path):
        if name.startswith(MERGING):
            remove(spark, f"{path}/{name}")
    names = stored_batches(spark, path) or []
    for name in set(names) - set(covering(names)):
        remove(spark, f"{path}/{BATCH_COLUMN}={name}")


def compact(
    spark: SparkSession,
    path: str,
    schema: str,
    fmt: str = "parquet",
    fanout: int = FANOUT,
    check: Callable[[], None] = lambda: None,
) -> int:
    """Merges until no level has `fanout` neighbours left; returns how often it merged.

    n batches leave a number of folders that grows with the logarithm of n, and every row is
    written once a level. schema is that of the rows, without batch_id. No shuffle: files
    become as large as FILE_BYTES. check may raise before a merge becomes visible. Not to run
    beside a run that writes the table, see `lease`.
    """
    if fmt == "delta":
        raise ValueError("a delta table is compacted by its own command")
    if fanout < 2:
        raise ValueError("a merge takes two folders or more")
    sweep(spark, path)
    merges = 0
    while (found := next_merge(stored_batches(spark, path) or [], fanout)) is not None:
        group, after = found
        first = "start" if group[0].start == FROM_THE_START else group[0].start
        name = f"{group[0].kind}-{first}-to-{after.start}-level-{group[0].level + 1}"
        folders = [f"{path}/{BATCH_COLUMN}={b.name}" for b in group]
        staged = f"{path}/{MERGING}{name}"
        size = sum(bytes_in(spark, folder) for folder in folders)
        rows = (
            spark.read.format(fmt)
            .schema(f"{schema}, {LEAF_COLUMN} STRING, {BATCH_COLUMN} STRING")
            .option("basePath", path)
            .load(folders)
            .withColumn(LEAF_COLUMN, F.coalesce(LEAF_COLUMN, BATCH_COLUMN))
            .drop(BATCH_COLUMN)
        )
        rows.coalesce(1 + size // FILE_BYTES).write.format(fmt).mode("overwrite").save(staged)
        create_once(spark, f"{staged}/{LEAVES}", json.dumps([x for b in group for x in leaves_of(spark, path, b.name)]))
        check()
        target = f"{path}/{BATCH_COLUMN}={name}"
        if exists(spark, target):
            raise RuntimeError(f"{target} is there already")
        move(spark, staged, target)
        for folder in folders:
            remove(spark, folder)
        merges += 1
    return merges
