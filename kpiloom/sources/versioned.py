"""Tables that are replaced in parts, with every state whole.

A table's rows lie in buckets, and each write is a generation: a folder of its own
that no reader looks at until the manifest names it. The manifest lists, for every
bucket, the generations that make it up, and is put in place by one rename. So a
reader sees the state before a write or after it, a job that dies in between
leaves the table as it was, and a rewrite touches only the buckets it has to.

One job writes a table at a time; a second one whose manifest comes too late
fails without having changed anything.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from kpiloom.session import small_tasks
from kpiloom.sources import files

BUCKET = "_bucket"


@dataclass
class Manifest:
    number: int = 0
    #: Generations by bucket.
    buckets: dict[int, list[str]] = field(default_factory=dict)
    schema: StructType = field(default_factory=StructType)
    #: What writers left beside the rows they wrote, by batch.
    batches: dict[str, dict[str, int]] = field(default_factory=dict)
    #: Generations taken in but not settled yet, by bucket, and their batches. No
    #: reader sees either.
    waiting: dict[int, list[str]] = field(default_factory=dict)
    waiting_batches: dict[str, dict[str, int]] = field(default_factory=dict)

    @property
    def generations(self) -> set[str]:
        return {g for held in (self.buckets, self.waiting) for of_bucket in held.values() for g in of_bucket}

    def has(self, batch: str) -> bool:
        return batch in self.batches or batch in self.waiting_batches


class VersionedTable:
    """A table under ``path``; ``bucket`` gives each row one of a bounded number
    of buckets."""

    def __init__(self, spark: SparkSession, path: str, bucket: Column):
        self.spark, self.path, self.bucket = spark, path.rstrip("/"), bucket

    # -- state -------------------------------------------------------------

    def _manifest_path(self, number: int) -> str:
        return f"{self.path}/_manifests/{number:012d}.json"

    def manifest(self) -> Manifest:
        numbers = [n for n in files.names(self.spark, f"{self.path}/_manifests") if n.endswith(".json")]
        if not numbers:
            return Manifest()
        held = json.loads(files.read_text(self.spark, f"{self.path}/_manifests/{numbers[-1]}"))
        return Manifest(
            int(numbers[-1].removesuffix(".json")),
            {int(b): g for b, g in held["buckets"].items()},
            StructType.fromJson(held["schema"]),
            held["batches"],
            {int(b): g for b, g in held.get("waiting", {}).items()},
            held.get("waiting_batches", {}),
        )

    def _commit(self, manifest: Manifest) -> None:
        state = {"buckets": manifest.buckets, "schema": manifest.schema.jsonValue(), "batches": manifest.batches}
        state |= {"waiting": manifest.waiting, "waiting_batches": manifest.waiting_batches}
        own = f"{self.path}/_manifests/{uuid.uuid4().hex}.tmp"
        files.write_text(self.spark, own, json.dumps(state))
        if not files.move(self.spark, own, self._manifest_path(manifest.number + 1)):
            files.remove(self.spark, own)
            raise RuntimeError(f"another job has written {self.path} meanwhile")

    def exists(self) -> bool:
        return self.manifest().number > 0

    # -- reading -----------------------------------------------------------

    def read(self, buckets: Iterable[int] | None = None) -> DataFrame:
        """The table, or some of its buckets, as the latest manifest has it."""
        return self._rows(self.manifest(), buckets).drop(BUCKET)

    def _rows(self, manifest: Manifest, buckets: Iterable[int] | None = None) -> DataFrame:
        wanted = set(manifest.buckets if buckets is None else buckets) & set(manifest.buckets)
        paths = [f"{self.path}/{g}/{BUCKET}={b}" for b in sorted(wanted) for g in manifest.buckets[b]]
        schema = StructType([*manifest.schema, StructField(BUCKET, IntegerType())])
        if not paths:
            return self.spark.createDataFrame([], schema)
        # Each generation's folder is the root that its bucket's name is found below.
        parts = None
        for generation in sorted({p.split("/")[-2] for p in paths}):
            own = [p for p in paths if p.split("/")[-2] == generation]
            part = self.spark.read.schema(schema).option("basePath", f"{self.path}/{generation}").parquet(*own)
            parts = part if parts is None else parts.unionByName(part)
        return parts

    # -- writing -----------------------------------------------------------

    def placed(self, rows: DataFrame) -> DataFrame:
        """Rows with their bucket."""
        return rows.withColumn(BUCKET, self.bucket.cast("int"))

    def _write(self, placed: DataFrame) -> tuple[str, list[int]]:
        """Rows with their bucket as a generation of their own, and its buckets."""
        generation = f"generation-{uuid.uuid4().hex}"
        placed.write.options(**files.PACKED).partitionBy(BUCKET).parquet(f"{self.path}/{generation}")
        names = files.names(self.spark, f"{self.path}/{generation}")
        return generation, [int(n.split("=")[1]) for n in names if n.startswith(f"{BUCKET}=")]

    def _stage(self, rows: DataFrame) -> tuple[str, DataFrame, list[int]]:
        """Rows written once as a generation of their own, read again, and their
        buckets."""
        generation, found = self._write(self.placed(rows))
        staged = Manifest(buckets={b: [generation] for b in found}, schema=rows.schema)
        return generation, self._rows(staged), found

    def append(self, rows: DataFrame, batch: str | None = None, note: Callable[[], dict[str, int]] | None = None) -> None:
        """Adds rows to what the buckets hold."""
        before = self.manifest()
        generation, staged, found = self._stage(rows)
        buckets = before.buckets | {b: [*before.buckets.get(b, []), generation] for b in found}
        self._finish(before, buckets, staged.drop(BUCKET).schema, batch, note)

    def merge(
        self,
        rows: DataFrame,
        settle: Callable[[DataFrame, DataFrame], DataFrame],
        batch: str | None = None,
        note: Callable[[], dict[str, int]] | None = None,
    ) -> None:
        """Replaces the buckets that ``rows`` fall into by what ``settle`` makes of
        their present rows and the new ones.

        ``rows`` is worked out once; ``note`` is asked afterwards for numbers to
        keep with the batch. A batch that has been written before is left out.
        """
        before = self.manifest()
        if batch is not None and batch in before.batches:
            return
        staged_at, staged, found = self._stage(rows)
        fresh = staged.drop(BUCKET)
        present = self._rows(replace(before, schema=_widened(before.schema, fresh.schema)), found).drop(BUCKET)
        settled = settle(present, fresh)
        # Rebalancing splits a bucket that has become too large for one file.
        generation, left = self._write(self.placed(settled).hint("rebalance", BUCKET))
        buckets = {b: g for b, g in before.buckets.items() if b not in found} | {b: [generation] for b in left}
        self._finish(before, buckets, settled.schema, batch, note)
        files.remove(self.spark, f"{self.path}/{staged_at}")

    def take(
        self,
        rows: DataFrame,
        one_per_key: Callable[[DataFrame], DataFrame],
        batch: str,
        note: Callable[[], dict[str, int]],
    ) -> None:
        """Takes in a batch for ``settle``, which has to come after the last one.

        The first batch of a table is settled at once. A later one only waits, as
        it came, and so however many batches there are, each row is written once
        while they come and once when they are settled.
        """
        before = self.manifest()
        if before.has(batch):
            return
        if not (before.buckets or before.waiting):
            generation, found = self._write(one_per_key(self.placed(rows)))
            self._finish(before, {b: [generation] for b in found}, rows.schema, batch, note)
            return
        generation, found = self._write(self.placed(rows))
        waiting = before.waiting | {b: [*before.waiting.get(b, []), generation] for b in found}
        notes = before.waiting_batches | {batch: note()}
        self._commit(replace(before, schema=_widened(before.schema, rows.schema), waiting=waiting, waiting_batches=notes))

    def settle(self, one_per_key: Callable[[DataFrame], DataFrame]) -> None:
        """Replaces the buckets that waiting rows fall into by one row per key of
        what they hold and what waits for them, all in one go."""
        before = self.manifest()
        if not before.waiting_batches:
            return
        held = {b: [*before.buckets.get(b, []), *g] for b, g in before.waiting.items()}
        buckets = before.buckets
        if held:
            rows = self._rows(replace(before, buckets=held))
            with small_tasks(self.spark, self._size(held)):
                generation, left = self._write(one_per_key(rows))
            buckets = {b: g for b, g in buckets.items() if b not in held} | {b: [generation] for b in left}
        batches = before.batches | before.waiting_batches
        self._commit(Manifest(before.number, buckets, before.schema, batches))
        for waited in {g for of_bucket in before.waiting.values() for g in of_bucket}:
            files.remove(self.spark, f"{self.path}/{waited}")

    def _size(self, buckets: dict[int, list[str]]) -> int:
        """Stored bytes of some generations' buckets."""
        return sum(files.size(self.spark, f"{self.path}/{g}/{BUCKET}={b}") for b, of in buckets.items() for g in of)

    def _finish(self, before: Manifest, buckets, schema: StructType, batch, note) -> None:
        batches = dict(before.batches)
        if batch is not None:
            batches[batch] = note() if note else {}
        self._commit(replace(before, buckets=buckets, schema=_widened(before.schema, schema), batches=batches))

    def tidy(self) -> None:
        """Removes the generations that no manifest needs: those of earlier states
        and of writes that did not get through. Not while others read or write."""
        now = self.manifest()
        for name in files.names(self.spark, self.path):
            if name.startswith("generation-") and name not in now.generations:
                files.remove(self.spark, f"{self.path}/{name}")
        for name in files.names(self.spark, f"{self.path}/_manifests"):
            if name != f"{now.number:012d}.json":
                files.remove(self.spark, f"{self.path}/_manifests/{name}")


def _widened(schema: StructType, other: StructType) -> StructType:
    """The fields of the first, and those that only the second has."""
    known = {f.name for f in schema}
    return StructType([*schema, *(f for f in other if f.name not in known)])
