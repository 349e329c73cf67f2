"""Keyed tables on files that changes replace bucket by bucket.

Rows lie in buckets by a hash of their key. A set of changes rewrites the buckets it
touches into a folder of its own; a manifest that names every bucket's folder is put in
place last, by a rename that fails where another writer was faster. Readers take the
newest manifest, so they see a table before a set of changes or after it, and read one
folder per bucket however many sets there were. The manifest also remembers the last
batch of every stream and the cursors that came with it, so a replayed batch changes
nothing. Folders that no kept manifest names are removed by ``vacuum`` alone.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from cdcflow.operators.apply import LOG_POSITION, apply_changes, live_documents

BUCKET = "_bucket"
N_BUCKETS = 64


class ConcurrentChange(RuntimeError):
    """Another writer put its manifest in place first; nothing was changed."""


@dataclass(frozen=True)
class Manifest:
    version: int
    keys: list[str]
    n_buckets: int
    schema: str
    # folder below ``data`` of every bucket that has rows
    folders: dict[str, str] = field(default_factory=dict)
    # last batch by stream
    commits: dict[str, int] = field(default_factory=dict)
    # log position by log, as text and number
    cursors: dict[str, list] = field(default_factory=dict)


class StoredTable:
    """A table at ``root``; every call looks at its newest manifest."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], n_buckets: int = N_BUCKETS):
        self.spark, self.root, self.keys = spark, root.rstrip("/"), list(keys)
        self.n_buckets = n_buckets

    # --- manifests ---------------------------------------------------------------

    def manifest(self, version: int | None = None) -> Manifest:
        """The newest manifest, or that of a version which is kept; an empty one before
        the first set of changes."""
        known = self._versions()
        if version is None:
            if not known:
                return Manifest(0, self.keys, self.n_buckets, "")
            version = known[-1]
        files, path = self._files(f"manifest/{version:012d}.json")
        stream = files.open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        found = Manifest(**json.loads(text))
        if found.keys != self.keys:
            raise ValueError(f"{self.root} has the keys {found.keys}")
        return found

    def _versions(self) -> list[int]:
        files, path = self._files("manifest")
        if not files.exists(path):
            return []
        names = [s.getPath().getName() for s in files.listStatus(path)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _files(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _publish(self, manifest: Manifest) -> None:
        """The switch: a whole file is renamed to the next version, if that is not taken."""
        files, draft = self._files(f"manifest/_{uuid.uuid4().hex}")
        _, final = self._files(f"manifest/{manifest.version:012d}.json")
        out = files.create(draft, False)
        out.write(bytearray(json.dumps(asdict(manifest)).encode()))
        out.close()
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(draft, final, options)
        except Exception as error:
            if not files.exists(final):
                raise
            raise ConcurrentChange(f"version {manifest.version} of {self.root} is there") from error

    # --- rows --------------------------------------------------------------------

    def read(self, deletes: str = "remove", version: int | None = None) -> DataFrame:
        """All rows; with ``deletes='tombstone'`` deleted keys too, with their status."""
        manifest = self.manifest(version)
        rows = self._rows(manifest, manifest.folders)
        return live_documents(rows) if deletes == "remove" and "status" in rows.columns else rows

    def _rows(self, manifest: Manifest, buckets) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(manifest.schema)) if manifest.schema else T.StructType()
        paths = [f"{self.root}/data/{manifest.folders[b]}/{BUCKET}={b}" for b in buckets if b in manifest.folders]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def bucket(self, n_buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(n_buckets)).cast("int")

    def _write(self, rows: DataFrame, manifest: Manifest, n_parts: int) -> str:
        folder = uuid.uuid4().hex
        dealt = rows.withColumn(BUCKET, self.bucket(manifest.n_buckets)).repartition(max(n_parts, 1), BUCKET)
        dealt.write.partitionBy(BUCKET).parquet(f"{self.root}/data/{folder}")
        return folder

    def replace(self, rows: DataFrame) -> None:
        """The table's rows from now on, as of no log position: any change is newer."""
        before = self.manifest()
        rows = rows if "status" in rows.columns else rows.withColumn("status", F.lit(None).cast("string"))
        if "_version" not in rows.columns:
            rows = rows.withColumn("_version", F.lit(None).cast("struct<log_timestamp:timestamp,log_id:bigint>"))
        self._switch(before, rows, range(before.n_buckets))

    def _switch(self, before: Manifest, rows: DataFrame, touched, commit=None, cursors=None, n_buckets=None) -> None:
        n_buckets = n_buckets or before.n_buckets
        after = replace(
            before,
            version=before.version + 1,
            n_buckets=n_buckets,
            schema=rows.schema.json(),
            folders=before.folders if n_buckets == before.n_buckets else {},
            commits=before.commits | ({commit[0]: commit[1]} if commit else {}),
            cursors=before.cursors | {k: list(v) for k, v in (cursors or {}).items()},
        )
        folder = self._write(rows, after, len(touched))
        files, path = self._files(f"data/{folder}")
        names = [s.getPath().getName() for s in files.listStatus(path)]
        written = {n.split("=")[1] for n in names if n.startswith(f"{BUCKET}=")}
        kept = {b: f for b, f in after.folders.items() if int(b) not in set(touched)}
        self._publish(replace(after, folders=kept | dict.fromkeys(sorted(written, key=int), folder)))

    def upsert(
        self,
        changes: DataFrame,
        commit: tuple[str, int] | None = None,
        cursors: dict[str, tuple[str, int]] | None = None,
        order: Sequence[str] = LOG_POSITION,
        merge: str = "replace",
    ) -> bool:
        """Fold changes (keys, values, ``status``, log position) into the table.

        Only the buckets of changed keys are read and written. ``commit`` names a stream
        and its batch: a batch that was stored before is left out, and False is returned.
        ``cursors`` are stored in the same step. Without changes nothing is written.
        """
        before = self.manifest()
        if commit and before.commits.get(commit[0], -1) >= commit[1]:
            return False
        held = changes.dropna(how="any", subset=self.keys).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # a bucket number each: bounded by the number of buckets
            touched = [r[0] for r in held.select(self.bucket(before.n_buckets)).distinct().collect()]
            if not touched and not cursors:
                return True
            old = self._rows(before, [str(b) for b in touched]) if before.schema else None
            if touched:
                rows = apply_changes(old, held, self.keys, order, merge=merge, derived=True)
            else:
                rows = old if old is not None else apply_changes(None, held, self.keys, order)
            self._switch(before, rows, touched, commit, cursors)
        finally:
            held.unpersist()
        return True

    # --- upkeep ------------------------------------------------------------------

    def rebucket(self, n_buckets: int) -> None:
        """Write the table anew in another number of buckets, which also joins the files of
        each; a bucket is read and written as a whole, so it should fit into a task."""
        before = self.manifest()
        self._switch(before, self._rows(before, before.folders), range(n_buckets), n_buckets=n_buckets)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove all but the newest ``keep`` manifests, and folders that none of those
        names; returns the folders. Run it while no writer is at work."""
        versions = self._versions()
        kept = versions[-keep:]
        named = {f for v in kept for f in self.manifest(v).folders.values()}
        for version in versions[:-keep]:
            files, path = self._files(f"manifest/{version:012d}.json")
            files.delete(path, False)
        files, path = self._files("data")
        found = [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []
        gone = sorted(set(found) - named)
        for folder in gone:
            files.delete(self._files(f"data/{folder}")[1], True)
        return gone
