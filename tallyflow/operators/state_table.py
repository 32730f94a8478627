"""A table of the latest state by key, in levels: batches append sorted runs, runs of a level are merged into the next, and a manifest says which runs are read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyflow.operators.changelog import latest
from tallyflow.sources.segments import Store


class StateTable:
    """Rows with a key, the partition of the orders they stand for, and columns that order a key's rows, all parameters.

    ``runs/`` holds a folder for each run, with a folder for each partition in it, sorted by key; the manifest lists the live
    folders of each run by level and is replaced in one step, so readers see a whole batch or merge, or none of it. A run has a row
    for each key; ``fanout`` runs of a level make one of the next, so a row is written once a level. Dropping partitions changes
    the manifest alone, restoring them adds a run; folders of other partitions are neither read nor written.

    Rows without key, partition or order are skipped, as states that cannot be restored; there are no deletes. Equal orders
    of a key: either row may stand.
    """

    def __init__(self, spark: SparkSession, path: str, key: str = "product", partition: str = "partition", order: tuple[str, ...] = ("last_offset",), fanout: int = 4):
        self.spark, self.path, self.key, self.partition, self.order, self.fanout = spark, path, key, partition, list(order), fanout
        self.store = Store(path)

    def manifest(self) -> dict:
        """levels: for each level its runs, oldest first, each with its live partitions; schema of the rows; last batch of each writer."""
        number = self.store.last()
        return self.store.commit(number) if number >= 0 else {"levels": [], "schema": None, "writers": {}}

    def _change(self, change) -> bool:
        """Replaces the manifest by what ``change`` makes of the present one; again if another write came first. False if it makes nothing."""
        while True:
            number = self.store.last()
            made = change(self.store.commit(number) if number >= 0 else {"levels": [], "schema": None, "writers": {}})
            if made is None:
                return False
            if self.store.put(number + 1, made):
                return True

    def _write(self, rows: DataFrame) -> dict:
        """A new run of the rows, one for each key; not live yet."""
        rows = rows.dropna(subset=[self.key, self.partition, *self.order])
        run = uuid.uuid4().hex
        dealt = latest(rows, self.key, self.order).repartitionByRange(self.partition, self.key).sortWithinPartitions(self.partition, self.key)
        dealt.withColumn("__p", F.col(self.partition)).write.partitionBy("__p").parquet(f"{self.path}/runs/{run}")
        from pyarrow import fs

        found = self.store.fs.get_file_info(fs.FileSelector(f"{self.store.root}/runs/{run}", allow_not_found=True))
        return {"run": run, "partitions": sorted(int(f.base_name.removeprefix("__p=")) for f in found if f.base_name.startswith("__p="))}

    def append(self, entries: DataFrame, writer: str | None = None, batch: int | None = None) -> bool:
        """Adds a batch's rows as a run of the first level, then merges levels that are full. A batch that ``writer`` has added is left out (False)."""
        if writer and batch is not None and self.manifest()["writers"].get(writer, -1) >= batch:
            return False
        run = self._write(entries)

        def change(m):
            if writer and batch is not None and m["writers"].get(writer, -1) >= batch:
                return None
            levels = [[*(m["levels"][0] if m["levels"] else []), run], *m["levels"][1:]]
            return {"levels": levels, "schema": m["schema"] or entries.schema.json(), "writers": m["writers"] | ({writer: batch} if writer and batch is not None else {})}

        added = self._change(change)
        self.compact()
        return added

    def _rows(self, manifest: dict, runs: list[dict], partitions=None) -> DataFrame:
        import json

        schema = T.StructType.fromJson(json.loads(manifest["schema"]))
        out = self.spark.createDataFrame([], schema)
        wanted = None if partitions is None else set(partitions)
        for run in runs:
            live = [p for p in run["partitions"] if wanted is None or p in wanted]
            if live:
                base = f"{self.path}/runs/{run['run']}"
                rows = self.spark.read.schema(T.StructType([*schema.fields, T.StructField("__p", T.IntegerType())])).option("basePath", base).parquet(*[f"{base}/__p={p}" for p in live])
                out = out.unionByName(rows.where(F.col("__p").isin(live)).drop("__p"))
        return out

    def read(self, partitions=None) -> DataFrame:
        """The latest row of each key, of the given partitions alone where some are given. Rows of a key are merged by order over all runs."""
        m = self.manifest()
        if m["schema"] is None:
            raise ValueError("nothing has been written")
        return latest(self._rows(m, [r for level in m["levels"] for r in level], partitions), self.key, self.order)

    def compact(self, everything: bool = False) -> int:
        """Merges the runs of each level that has ``fanout`` of them into one of the next (or all runs into one); returns how many merges were made."""
        n = 0
        while True:
            m = self.manifest()
            if everything:
                at, runs = len(m["levels"]) - 1, [r for level in m["levels"] for r in level]
                full = at if len(runs) > 1 else None
            else:
                full = next((i for i, level in enumerate(m["levels"]) if len(level) >= self.fanout), None)
                runs = m["levels"][full] if full is not None else []
            if full is None:
                return n
            merged = self._write(self._rows(m, runs))
            gone = {r["run"]: r["partitions"] for r in runs}

            def change(m, merged=merged, gone=gone, to=full if everything else full + 1):
                now = {r["run"]: r["partitions"] for level in m["levels"] for r in level}
                if any(now.get(r) != p for r, p in gone.items()):
                    return None  # partitions were dropped or runs merged meanwhile: what was merged is stale
                levels = [[r for r in level if r["run"] not in gone] for level in m["levels"]]
                levels += [[] for _ in range(to + 1 - len(levels))]
                levels[to] = [*levels[to], merged]
                return m | {"levels": levels}

            n += self._change(change)
            if everything:
                return n

    def drop(self, partitions) -> int:
        """Takes the partitions away; returns how many keys they had."""
        n = self.read(partitions).count()
        gone = set(partitions)
        self._change(lambda m: m | {"levels": [[r | {"partitions": [p for p in r["partitions"] if p not in gone]} for r in level] for level in m["levels"]]})
        return n

    def restore(self, partitions, entries: DataFrame) -> None:
        """Puts the entries of the partitions in the place of what is there, in one step."""
        run = self._write(entries.where(F.col(self.partition).isin(*partitions)))
        gone = set(partitions)

        def change(m):
            levels = [[r | {"partitions": [p for p in r["partitions"] if p not in gone]} for r in level] for level in m["levels"]] or [[]]
            return m | {"levels": [[*levels[0], run], *levels[1:]], "schema": m["schema"] or entries.schema.json()}

        self._change(change)

    def sweep(self) -> int:
        """Deletes the folders of runs and partitions that are not live, once no reader of an older manifest is left; returns how many."""
        from pyarrow import fs

        live = {r["run"]: set(r["partitions"]) for level in self.manifest()["levels"] for r in level}
        n = 0
        for run in self.store.fs.get_file_info(fs.FileSelector(f"{self.store.root}/runs", allow_not_found=True)):
            if run.base_name not in live:
                self.store.fs.delete_dir(run.path)
                n += 1
                continue
            for part in self.store.fs.get_file_info(fs.FileSelector(run.path)):
                if part.base_name.startswith("__p=") and int(part.base_name[4:]) not in live[run.base_name]:
                    self.store.fs.delete_dir(part.path)
                    n += 1
        return n
