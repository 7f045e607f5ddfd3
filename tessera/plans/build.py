"""Builds: content-addressed folders with a manifest of stages, adoption of equal stages
of sibling builds, and promotion of a verified one by a pointer."""

from __future__ import annotations

import hashlib
import json
import os
import tempfile
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.errors import StageError
from tessera.sources.package import write_json
from tessera.sources.store import StorePath, at, changed

PENDING, RUNNING, COMPLETED, FAILED = "pending", "running", "completed", "failed"


def fingerprint(*parts: object, length: int = 12) -> str:
    """Hex digits of the SHA-256 of the parts as canonical JSON."""
    text = json.dumps(parts, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    return hashlib.sha256(text.encode()).hexdigest()[:length]


def layered(layers: Sequence[tuple[str, object]]) -> dict[str, str]:
    """A fingerprint a layer, of the layer and all before it: a change of a late layer
    leaves the earlier ones' results usable."""
    return {name: fingerprint(*[v for _, v in layers[: i + 1]]) for i, (name, _) in enumerate(layers)}


def table_digest(df: DataFrame) -> dict[str, int]:
    """Rows and an order-free hash of a table."""
    # Maps can't be hashed as they are.
    h = F.xxhash64(*[F.to_json(c) if "map<" in kind else F.col(c) for c, kind in df.dtypes])
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(h), F.lit(0)).alias("h"), F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)).cast("string").alias("s")).first()
    return {"rows": row.n, "xor": row.h, "sum": row.s}


@dataclass
class Build:
    """A build's folder and manifest. Stages come in order; completing one resets all that
    follow, so that nothing stale can be promoted."""

    path: Path | StorePath
    stages: Sequence[str]
    fingerprints: Mapping[str, str] = field(default_factory=dict)

    @property
    def manifest_path(self) -> Path | StorePath:
        return self.path / "manifest.json"

    def manifest(self) -> dict:
        if not self.manifest_path.exists():
            return {"stages": {s: {"state": PENDING} for s in self.stages}, "fingerprints": dict(self.fingerprints)}
        return json.loads(self.manifest_path.read_text())

    def _save(self, manifest: dict) -> None:
        write_json(self.manifest_path, manifest)

    def state(self, stage: str) -> str:
        return self.manifest()["stages"].get(stage, {"state": PENDING})["state"]

    def _set(self, stage: str, state: str, **more: object) -> None:
        manifest = self.manifest()
        manifest["fingerprints"] = dict(self.fingerprints)
        manifest["stages"][stage] = {"state": state, "at": time.time(), **more}
        if state == COMPLETED:
            for later in self.stages[list(self.stages).index(stage) + 1 :]:
                manifest["stages"][later] = {"state": PENDING}
        self._save(manifest)

    def require(self, *stages: str) -> None:
        missing = [s for s in stages if self.state(s) != COMPLETED]
        if missing:
            raise StageError(f"stages {', '.join(missing)} are not completed")

    def table_path(self, name: str) -> str:
        return str(self.path / name)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(self._where(name))

    def _where(self, name: str) -> str:
        return self.manifest()["stages"].get(name, {}).get("path", self.table_path(name))

    def intact(self, spark: SparkSession, name: str) -> bool:
        """Whether a completed table stage still reads as it was written."""
        entry = self.manifest()["stages"].get(name, {})
        if entry.get("state") != COMPLETED or "digest" not in entry:
            return False
        return self._reads_as(spark, self._where(name), entry["digest"])

    def table(self, spark: SparkSession, name: str, make: Callable[[], DataFrame], after: Sequence[str] = ()) -> DataFrame:
        """The table of a stage: kept if intact, adopted from a sibling of equal
        fingerprint, or made and written."""
        if self.intact(spark, name):
            return self.read(spark, name)
        self.require(*after)
        if donor := self.donor(spark, name):
            self._set(name, COMPLETED, **donor)
            return self.read(spark, name)
        self._set(name, RUNNING)
        try:
            make().write.mode("overwrite").option("compression", "zstd").parquet(self.table_path(name))
            done = spark.read.parquet(self.table_path(name))
            self._set(name, COMPLETED, digest=table_digest(done), path=self.table_path(name))
            return done
        except BaseException as e:
            self._set(name, FAILED, error=str(e)[:500])
            raise

    def sharded(self, spark: SparkSession, name: str, make: Callable[[int], DataFrame], shards: int, after: Sequence[str] = ()) -> DataFrame:
        """Like table, in `shards` parts (make takes a part's number): a stage that stopped
        goes on with the parts that aren't written and intact yet."""
        if self.intact(spark, name):
            return self.read(spark, name)
        self.require(*after)
        if donor := self.donor(spark, name):
            self._set(name, COMPLETED, **donor)
            return self.read(spark, name)
        entry = self.manifest()["stages"].get(name, {})
        same = entry.get("shards") == shards and entry.get("fingerprint") == self.fingerprints.get(name)
        done: dict[str, dict] = dict(entry.get("done", {})) if same else {}
        more = {"shards": shards, "fingerprint": self.fingerprints.get(name)}
        try:
            for i in range(shards):
                path = f"{self.table_path(name)}/shard-{i:05}-of-{shards:05}"
                if str(i) in done and self._reads_as(spark, path, done[str(i)]):
                    continue
                self._set(name, RUNNING, done=done, **more)
                make(i).write.mode("overwrite").option("compression", "zstd").parquet(path)
                done[str(i)] = table_digest(spark.read.parquet(path))
            path = f"{self.table_path(name)}/shard-*-of-{shards:05}"
            whole = spark.read.parquet(path)
            self._set(name, COMPLETED, digest=table_digest(whole), path=path)
            return whole
        except BaseException as e:
            self._set(name, FAILED, error=str(e)[:500], done=done, **more)
            raise

    @staticmethod
    def _reads_as(spark: SparkSession, path: str, digest: dict) -> bool:
        try:
            return table_digest(spark.read.parquet(path)) == digest
        except Exception:  # any way of not reading is damage
            return False

    def step(self, name: str, run: Callable[[], Mapping], after: Sequence[str] = ()) -> dict:
        """A stage that leaves a report only."""
        self.require(*after)
        self._set(name, RUNNING)
        try:
            report = dict(run())
        except BaseException as e:
            self._set(name, FAILED, error=str(e)[:500])
            raise
        write_json(self.path / f"{name}.json", report)
        self._set(name, COMPLETED, report=report)
        return report

    def donor(self, spark: SparkSession, name: str) -> dict | None:
        """The manifest entry of the newest sibling whose fingerprint for the stage is
        equal and whose table is intact; it is read in place. A damaged one is an error."""
        own = self.fingerprints.get(name)
        if not own or not self.path.parent.exists():
            return None
        siblings = sorted((p for p in self.path.parent.glob("*/manifest.json") if p.parent != self.path), key=changed, reverse=True)
        for manifest in siblings:
            data = json.loads(manifest.read_text())
            entry = data["stages"].get(name, {})
            if data.get("fingerprints", {}).get(name) == own and entry.get("state") == COMPLETED and "digest" in entry:
                if not Build(manifest.parent, self.stages).intact(spark, name):
                    raise StageError(f"{manifest.parent.name} has a damaged {name}")
                return {"digest": entry["digest"], "path": entry.get("path", str(manifest.parent / name)), "adopted_from": manifest.parent.name}
        return None


def promote(build: Build, pointer: str | Path, verified: str = "verify") -> None:
    """Points at a build whose last check is completed; the pointer changes at once."""
    build.require(verified)
    target = at(pointer)
    target.parent.mkdir(parents=True, exist_ok=True)
    if isinstance(target, StorePath):
        target.write_text(str(build.path))
        return
    handle, name = tempfile.mkstemp(dir=target.parent)
    with os.fdopen(handle, "w") as f:
        f.write(str(build.path))
    os.replace(name, target)


def promoted(pointer: str | Path) -> str:
    """The build a pointer names; read once, and asserted again by check_pointer."""
    try:
        return at(pointer).read_text().strip()
    except FileNotFoundError as e:
        raise StageError(f"{pointer}: nothing is promoted") from e


def check_pointer(pointer: str | Path, seen: str) -> None:
    if promoted(pointer) != seen:
        raise StageError(f"{pointer} moved from {seen} during the run")
