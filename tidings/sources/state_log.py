"""A keyed state as a log-structured table: snapshot, deltas, and a manifest that names them.

::

    <path>/manifest/000000000007.json    {"snapshot": "snapshots/000000000006-…", "upto": 6}
    <path>/snapshots/000000000006-…/     the state of all batches up to 6
    <path>/deltas/batch=7/               the folded rows of one batch

A read takes the manifest with the highest number, its snapshot and the deltas behind ``upto``; its work
follows the size of the state and not the number of batches. A manifest is written beside its place and
renamed, so readers see the one before or the whole next one. Nothing that a manifest names is ever
changed: a batch that is replayed writes its own delta again, which no read takes once a snapshot
covers it. What a crash leaves behind, such as a snapshot without manifest, is removed by the next
compaction; what the manifest before names is kept for reads that have begun.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Batches after which the deltas are folded into a snapshot.
EVERY = 16


@dataclass(frozen=True)
class StateLog:
    """State of ``schema`` at ``path``.

    ``fold`` reduces rows to one for each key. It must give the same result for rows that were folded
    in parts, and keep what may still hide rows that come later, such as removals.
    """

    spark: SparkSession
    path: str
    schema: StructType
    fold: Callable[[DataFrame], DataFrame]
    every: int = EVERY

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _files(self):
        return self._at("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        files, at = self._files(), self._at(folder)
        if not files.exists(at):
            return []
        return sorted(status.getPath().getName() for status in files.listStatus(at))

    def _manifests(self) -> list[str]:
        return [name for name in self._names("manifest") if name.endswith(".json")]

    def manifest(self, name: str | None = None) -> dict:
        """What a read takes: the newest manifest, or the one of a name."""
        found = self._manifests()
        if not found:
            return {"snapshot": None, "upto": -1}
        stream = self._files().open(self._at(f"manifest/{name or found[-1]}"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, manifest: dict) -> None:
        found = self._manifests()
        number = int(found[-1].removesuffix(".json")) + 1 if found else 0
        files, beside = self._files(), self._at(f"manifest/.{uuid.uuid4().hex}")
        out = files.create(beside, False)
        try:
            out.write(bytearray(json.dumps(manifest).encode()))
        finally:
            out.close()
        if not files.rename(beside, self._at(f"manifest/{number:012d}.json")):
            raise RuntimeError(f"another writer published manifest {number} of {self.path}")

    def _deltas(self) -> dict[int, str]:
        """Folders of the batches; one that is being written has no ``_SUCCESS`` yet."""
        files = self._files()
        names = [name for name in self._names("deltas") if name.startswith("batch=")]
        return {
            int(name.removeprefix("batch=")): f"{self.path}/deltas/{name}"
            for name in names if files.exists(self._at(f"deltas/{name}/_SUCCESS"))
        }

    def _rows(self, manifest: dict, upto: int | None = None) -> DataFrame:
        paths = [
            path for batch, path in self._deltas().items()
            if batch > manifest["upto"] and (upto is None or batch <= upto)
        ]
        if manifest["snapshot"]:
            paths.append(f"{self.path}/{manifest['snapshot']}")
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self) -> DataFrame:
        """One row for each key."""
        return self.fold(self._rows(self.manifest()))

    def append(self, rows: DataFrame, batch: int) -> None:
        """Add a batch; the same batch again changes nothing."""
        folded = self.fold(rows).select(*self.schema.fieldNames())
        folded.write.mode("overwrite").parquet(f"{self.path}/deltas/batch={batch}")
        if batch - self.manifest()["upto"] >= self.every:
            self.compact(batch)

    def compact(self, upto: int) -> None:
        """Fold the batches up to ``upto`` into a new snapshot and forget what it replaces."""
        manifest = self.manifest()
        if upto <= manifest["upto"]:
            return
        snapshot = f"snapshots/{upto:012d}-{uuid.uuid4().hex}"
        self.fold(self._rows(manifest, upto)).write.mode("error").parquet(f"{self.path}/{snapshot}")
        self._publish({"snapshot": snapshot, "upto": upto})
        self.clean()

    def clean(self) -> None:
        """Remove what neither the newest manifest nor the one before it names."""
        files, names = self._files(), self._manifests()
        kept = [self.manifest(name) for name in names[-2:]]
        if len(kept) < 2:
            return
        used = {manifest["snapshot"] for manifest in kept}
        for name in self._names("snapshots"):
            if f"snapshots/{name}" not in used:
                files.delete(self._at(f"snapshots/{name}"), True)
        for batch in self._deltas():
            if batch <= kept[0]["upto"]:
                files.delete(self._at(f"deltas/batch={batch}"), True)
        for name in names[:-2]:
            files.delete(self._at(f"manifest/{name}"), False)
