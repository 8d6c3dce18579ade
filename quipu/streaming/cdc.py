"""Change-data apply: the latest image of each key wins, deletes included.

A change row has `op` (`I`, `U` or `D`), the key columns, `seq` (log position) and the
full image. The target's last two columns are the position and whether the key is deleted:
`_seq` and `_deleted`, with more `_` where the image has such columns. Deleted keys stay as
tombstones, so a replayed or late change with a lower position is ignored.

A stored state is a set of runs. A run holds the changes of one key range, one row per key. A
batch adds a run of level 0 to the ranges it touches; as soon as FANOUT runs of one level
meet in a range they are merged into one of the next level. A manifest names the live
runs. It is written last and takes effect as a whole, so what a batch reads and writes
follows its own ranges, and a batch that dies changes nothing.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.names import free, own, unless_taken
from ..operators.numbering import keep_best
from ..operators.ranges import key_ranges, placed
from ..sources.versions import drop_folder, numbered_folders

FANOUT = 4
RANGES = 64
KEPT_MANIFESTS = 2


def latest_changes(log: DataFrame, keys: list[str]) -> DataFrame:
    """The change with the highest position of each key."""
    return keep_best(log, keys, [F.desc("seq")])


def apply_changes(target: DataFrame | None, log: DataFrame, keys: list[str]) -> DataFrame:
    """Target state after a batch of changes: keys, image, `_seq`, `_deleted`.

    State and batch are stacked and the highest position per key stays: one exchange,
    whatever the mix of inserts, updates and deletes.
    """
    body = [c for c in log.columns if c not in (*keys, "op", "seq")]
    seq, deleted = (unless_taken(name, keys, body) for name in ("_seq", "_deleted"))
    incoming = latest_changes(log, keys).select(
        *map(own, keys), *map(own, body), F.col("seq").alias(seq), (F.col("op") == "D").alias(deleted)
    )
    if target is None:
        return incoming
    turn = free("turn", incoming)
    stacked = target.withColumn(turn, F.lit(0)).unionByName(incoming.withColumn(turn, F.lit(1)))
    # on equal positions the stored image stays, so a replay changes nothing
    return keep_best(stacked, keys, [own(seq).desc(), F.col(turn)]).drop(turn)


def live_rows(state: DataFrame) -> DataFrame:
    seq, deleted = state.columns[-2:]
    return state.filter(~own(deleted)).drop(seq, deleted)


# ---- stored state -------------------------------------------------------------------------


@dataclass(frozen=True)
class Run:
    """Changes of one key range; `folder` is below the state's root, `version` says how new it is."""

    range: int
    level: int
    version: int
    folder: str
    rows: int


@dataclass(frozen=True)
class Manifest:
    """Live runs after a batch."""

    version: int
    batch: int
    runs: tuple[Run, ...]


@dataclass(frozen=True)
class Work:
    """What a step read of the state and wrote."""

    read: tuple[Run, ...] = ()
    written: tuple[Run, ...] = ()


def last_manifest(spark: SparkSession, root: str) -> Manifest:
    """The newest whole manifest; its rows, at most some runs for each range, go to the driver."""
    versions = numbered_folders(spark, f"{root}/manifest", "version")
    if not versions:
        return Manifest(-1, -1, ())
    rows = spark.read.parquet(f"{root}/manifest/version={versions[-1]}").collect()
    runs = tuple(Run(r.range, r.level, r.version, r.folder, r["rows"]) for r in rows if r.folder is not None)
    return Manifest(versions[-1], rows[0].batch, runs)


def write_manifest(spark: SparkSession, root: str, manifest: Manifest) -> None:
    rows = [(r.range, r.level, r.version, r.folder, r.rows, manifest.batch) for r in manifest.runs] or [(None, None, None, None, None, manifest.batch)]
    kind = "range int, level int, version int, folder string, rows long, batch long"
    spark.createDataFrame(rows, kind).coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/version={manifest.version}")
    for old in numbered_folders(spark, f"{root}/manifest", "version")[:-KEPT_MANIFESTS]:
        drop_folder(spark, f"{root}/manifest/version={old}")


def read_runs(spark: SparkSession, root: str, runs: list[Run], keys: list[str]) -> DataFrame:
    """The highest position of each key in the given runs; of equal ones that of the older run."""
    rows = spark.read.parquet(*[f"{root}/{r.folder}" for r in runs])
    seq, age = rows.columns[-2], free("age", rows)
    found = rows.withColumn(age, F.regexp_extract(F.col("_metadata.file_path"), r"/runs/version=(\d+)/", 1).cast("long"))
    return keep_best(found, keys, [own(seq).desc(), F.col(age)]).drop(age)


def write_runs(state: DataFrame, root: str, version: int, level: int, keys: list[str]) -> list[Run]:
    """Write rows as runs of their ranges; what an earlier try left there is replaced."""
    spark = state.sparkSession
    starts = spark.read.parquet(f"{root}/ranges")
    name, folder = free("range", state), f"runs/version={version}/level={level}"
    by_range = placed(state, keys, starts, max(1, starts.select(F.size("starts")).first()[0]), name)
    # one file for a range, more where Spark splits a very large one
    by_range.hint("rebalance", own(name)).write.mode("overwrite").partitionBy(name).parquet(f"{root}/{folder}")
    schema = by_range.select(own(name)).schema
    counts = spark.read.schema(schema).parquet(f"{root}/{folder}").groupBy(own(name).alias("range")).agg(F.count("*").alias("rows")).collect()
    return [Run(r.range, level, version, f"{folder}/{name}={r.range}", r["rows"]) for r in counts]


def merge_due(spark: SparkSession, root: str, version: int, runs: list[Run], keys: list[str], fanout: int) -> tuple[list[Run], Work]:
    """Merge ranges where `fanout` runs of a level stand, level by level, all ranges of a level in one job."""
    read, written, level = [], [], 0
    while any(r.level >= level for r in runs):
        here: dict[int, list[Run]] = defaultdict(list)
        for r in runs:
            if r.level == level:
                here[r.range].append(r)
        due = [r for own_runs in here.values() if len(own_runs) >= fanout for r in own_runs]
        if due:
            made = write_runs(read_runs(spark, root, due, keys), root, version, level + 1, keys)
            runs = [r for r in runs if r not in set(due)] + made
            read += due
            written += made
        level += 1
    return runs, Work(tuple(read), tuple(written))


def apply_batch(spark: SparkSession, root: str, log: DataFrame, batch: int, keys: list[str], fanout: int = FANOUT, ranges: int = RANGES) -> Work:
    """Add a batch of changes to the stored state; a batch that is in already does nothing.

    Ranges are chosen from the keys of the first batch with changes. Reads only runs that are due for a
    merge, in ranges that the batch touches.
    """
    old = last_manifest(spark, root)
    if batch <= old.batch:
        return Work()
    changes = apply_changes(None, log, keys)
    if not old.runs:
        starts, _ = key_ranges(changes, keys, ranges=ranges)
        starts.write.mode("overwrite").parquet(f"{root}/ranges")
    version = old.version + 1
    added = write_runs(changes, root, version, 0, keys)
    runs, work = merge_due(spark, root, version, [*old.runs, *added], keys, fanout)
    write_manifest(spark, root, Manifest(version, batch, tuple(runs)))
    return Work(work.read, (*added, *work.written))


def changes_state(spark: SparkSession, root: str, keys: list[str]) -> DataFrame:
    """Current state: the live runs, highest position per key. Of equal positions the earlier batch stays."""
    manifest = last_manifest(spark, root)
    if not manifest.runs:
        raise ValueError(f"no changes below {root}")
    return read_runs(spark, root, list(manifest.runs), keys)


def compact_changes(spark: SparkSession, root: str, keys: list[str]) -> DataFrame:
    """Merge every range that has several runs into one, and drop the runs that no manifest names."""
    old = last_manifest(spark, root)
    by_range: dict[int, list[Run]] = defaultdict(list)
    for r in old.runs:
        by_range[r.range].append(r)
    due = [r for runs in by_range.values() if len(runs) > 1 for r in runs]
    if due:
        level = max(r.level for r in due) + 1
        made = write_runs(read_runs(spark, root, due, keys), root, old.version + 1, level, keys)
        kept = [r for r in old.runs if r not in set(due)]
        write_manifest(spark, root, Manifest(old.version + 1, old.batch, (*kept, *made)))
        for r in due:
            drop_folder(spark, f"{root}/{r.folder}")
    return changes_state(spark, root, keys)


def cdc_stream(
    spark: SparkSession,
    src: str,
    schema: str,
    to_changes,
    keys: list[str],
    root: str,
    max_files: int = 1000,
) -> DataFrame:
    """Apply arriving change files batch by batch; returns the state after the last one.

    The cost of a batch follows the batch and the runs of its ranges, not the state, and a
    batch that runs again after a failure replaces what it left or does nothing.
    """

    def step(rows: DataFrame, batch: int) -> None:
        apply_batch(spark, root, to_changes(rows), batch, keys)

    query = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files)
        .parquet(src)
        .writeStream.foreachBatch(step)
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return changes_state(spark, root, keys)
