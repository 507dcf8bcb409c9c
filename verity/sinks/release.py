"""Publication of a whole run through the catalog.

A run writes all its outputs into fresh folders beside the tables' paths
(``<path>.versions/<token>``), where no reader looks. When the last write has
succeeded, one small record of the catalog changes is renamed into place: that
rename is the run's commit. Then the changes are made: partitions and
unpartitioned tables are pointed to their new folders with ``ALTER TABLE ...
SET LOCATION``. A failure before the commit leaves every table as it was; one
after it is finished by the next run (``finish_pending``), since making a
change twice does no harm. Unchanged partitions keep their folders: nothing is
copied. The changes of a run are metadata alone, one per partition it wrote.

One writer at a time is assumed. Readers go through the catalog.
"""
from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verity.session import (
    list_folders, path_exists, qualified, remove_path, rename_path, versions_root,
)
from verity.sinks.catalog import add_partitions, drop_partitions, location, partitions, set_location
from verity.sinks.writers import Written, write_partitioned

RECORD = "table string, partition string, folder string, old string, known boolean"
AT_ONCE = 8  # catalog statements under way together


@dataclass(frozen=True)
class Change:
    """Point a partition (or, with none named, a whole table) to ``folder``;
    without a folder the partition goes. ``known``: the catalog has it
    already; ``old``: where its files are, if any."""
    table: str
    partition: dict[str, str]
    folder: str | None
    old: str | None = None
    known: bool = False


class Release:
    """The outputs of one run, written aside and published together."""

    def __init__(self, spark: SparkSession, control: str):
        self.spark, self.control = spark, control.rstrip("/")
        stamp = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
        self.token = f"{stamp}-{uuid.uuid4().hex[:8]}"
        self.folders: list[str] = []
        self.changes: list[Change] = []

    def folder(self, path: str) -> str:
        """Where this run writes the output that belongs to ``path``."""
        out = self.folder_of(path)
        self.folders.append(out)
        return out

    def folder_of(self, path: str) -> str:
        return f"{versions_root(path)}/{self.token}"

    def write_table(self, df: DataFrame, table: str, path: str) -> None:
        """An unpartitioned table in full."""
        folder = self.folder(path)
        df.write.parquet(folder)
        self.changes.append(Change(table, {}, folder))

    def write_partitions(self, df: DataFrame, table: str, path: str, keys: Sequence[str],
                         rebalance: Sequence[str] | None = None, max_records_per_file: int | None = 5_000_000) -> Written:
        """The partitions present in ``df``."""
        folder = self.folder(path)
        written = write_partitioned(df, folder, keys, rebalance, max_records_per_file, fresh=True)
        for part in written.partitions():
            place = "/".join(f"{c}={_folder_text(self.spark, v)}" for c, v in part.items())
            self.changes.append(Change(table, part, f"{folder}/{place}"))
        return written

    def drop(self, table: str, partition: dict[str, str]) -> None:
        """A partition that the run leaves without rows."""
        self.changes.append(Change(table, partition, None))

    def commit(self) -> None:
        """Publish everything written."""
        rows = []
        for table in dict.fromkeys(c.table for c in self.changes):
            mine = [c for c in self.changes if c.table == table]
            held = _held_folders(self.spark, table, mine)
            for c in mine:
                key = tuple(c.partition.values())
                if c.folder or key in held:
                    rows.append((table, json.dumps(c.partition), c.folder, held.get(key), key in held))
        draft = f"{self.control}/draft/{self.token}"
        self.spark.createDataFrame(rows, RECORD).coalesce(1).write.parquet(draft)
        rename_path(self.spark, draft, f"{self.control}/pending/{self.token}")
        finish_pending(self.spark, self.control)

    def abandon(self) -> None:
        """Remove what was written, unless the run is committed."""
        if not path_exists(self.spark, f"{self.control}/pending/{self.token}") \
                and not path_exists(self.spark, f"{self.control}/done/{self.token}"):
            for folder in [*self.folders, f"{self.control}/draft/{self.token}"]:
                remove_path(self.spark, folder)


def _folder_text(spark: SparkSession, value: str | None) -> str:
    """A partition value as Spark names its folder."""
    utils = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return utils.DEFAULT_PARTITION_NAME() if value is None else utils.escapePathName(value)


def _held_folders(spark: SparkSession, table: str, changes: list[Change]) -> dict[tuple, str | None]:
    """The changed partitions that the catalog has, each with the folder of its
    files (None if it holds none); a whole table under the empty key."""
    if not changes[0].partition:
        return {(): location(spark, table)}
    names = list(changes[0].partition)
    wanted = {tuple(c.partition.values()) for c in changes}
    held: dict[tuple, str | None] = {key: None for key in (tuple(p.values()) for p in partitions(spark, table))
                                     if key in wanted}
    if held:
        mark = "\x1f"
        # One row of each file tells where it is.
        folders = (spark.table(table).where(F.concat_ws(mark, *names).isin([mark.join(k) for k in held]))
                   .where(F.col("_metadata.row_index") == 0).groupBy(*names).agg(F.max(F.regexp_extract("_metadata.file_path", "^(.*)/[^/]*$", 1)).alias("f")))
        held.update({tuple(r[c] for c in names): r.f for r in folders.collect()})  # as many as changed partitions
    return held


def _record(spark: SparkSession, folder: str) -> list[Change]:
    return [Change(r.table, json.loads(r.partition), r.folder, r.old, r.known)
            for r in spark.read.schema(RECORD).parquet(folder).collect()]


def finish_pending(spark: SparkSession, control: str) -> list[str]:
    """Make the changes of every committed run that did not get to it, oldest
    first. Returns their tokens."""
    control = control.rstrip("/")
    tokens = sorted(list_folders(spark, f"{control}/pending"))
    for token in tokens:
        changes = _record(spark, f"{control}/pending/{token}")
        for table in dict.fromkeys(c.table for c in changes):
            mine = [c for c in changes if c.table == table]
            fresh = [c for c in mine if c.partition and c.folder and not c.known]
            add_partitions(spark, table, [c.partition for c in fresh], [c.folder for c in fresh])
            moved = [c for c in mine if c.folder and (c.known or not c.partition)]
            with ThreadPoolExecutor(max_workers=AT_ONCE) as pool:
                list(pool.map(lambda c: set_location(spark, c.table, c.folder, c.partition), moved))
            gone = [c for c in mine if c.folder is None]
            drop_partitions(spark, table, [c.partition for c in gone])
            # A folder at its usual place would come back with a repair.
            root = location(spark, table) if gone else ""
            for c in gone:
                if c.old and qualified(spark, c.old).startswith(qualified(spark, root) + "/"):
                    remove_path(spark, c.old)
            spark.catalog.refreshTable(table)
        rename_path(spark, f"{control}/pending/{token}", f"{control}/done/{token}")
    return tokens


def remove_superseded(spark: SparkSession, control: str, keep: int = 1) -> list[str]:
    """Delete the folders that finished runs replaced, but for those the
    newest ``keep`` runs replaced (a reader may still be at them), and forget
    these runs. Returns the deleted folders."""
    control = control.rstrip("/")
    gone = []
    tokens = sorted(list_folders(spark, f"{control}/done"))
    for token in tokens[:max(0, len(tokens) - keep)]:
        changes = _record(spark, f"{control}/done/{token}")
        for c in changes:
            if c.old and (c.folder is None or qualified(spark, c.old) != qualified(spark, c.folder)):
                remove_path(spark, c.old)
                gone.append(c.old)
        remove_path(spark, f"{control}/done/{token}")
    return gone
