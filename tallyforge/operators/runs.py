"""A whole run as a chain of stages, each written once with a receipt, and a manifest that is committed last.

A stage's folder is named after its version and those of all it reads, so a run that is started again takes every stage
that has a receipt as it is and goes on at the first that hasn't; a changed stage is made anew, with all behind it.
Receipts hold a line for each file, hashed by the tasks that read the files; nothing of a stage's rows goes through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.sources.files import manifest
from tallyforge.sources.scratch import exists

RECEIPT = "stage string, version string, file string, bytes long, sha256 string"


@dataclass(frozen=True)
class Stage:
    name: str
    needs: tuple[str, ...]
    make: Callable[..., DataFrame]
    version: str = "1"
    #: Artifacts are what the run is for; other stages only feed them.
    artifact: bool = True


@dataclass(frozen=True)
class Gate:
    """A condition over one row of figures; it is PENDING while `known` doesn't hold."""

    name: str
    passes: str
    known: str = "true"


class Run:
    def __init__(self, spark: SparkSession, folder: str, stages: list[Stage], gates: list[Gate] = (), figures: Callable[..., DataFrame] | None = None, needs: tuple[str, ...] = ()):
        self.spark, self.folder = spark, folder.rstrip("/")
        if figures is not None:
            stages = [*stages, Stage("gates", needs, lambda *frames: judged(figures(*frames), list(gates)), version=_key(*(f"{g.name}={g.passes}|{g.known}" for g in gates)))]
        self.stages = {s.name: s for s in stages}
        self.keys: dict[str, str] = {}
        for s in stages:
            if missing := [n for n in s.needs if n not in self.keys]:
                raise ValueError(f"{s.name} reads {missing}, which no earlier stage makes")
            self.keys[s.name] = _key(s.name, s.version, *(self.keys[n] for n in s.needs))
        self.made: list[str] = []

    def path(self, name: str) -> str:
        return f"{self.folder}/stages/{name}-{self.keys[name]}"

    def _receipt(self, name: str) -> str:
        return f"{self.folder}/receipts/{name}-{self.keys[name]}"

    def done(self, name: str) -> bool:
        return exists(self.spark, f"{self._receipt(name)}/_SUCCESS")

    def table(self, name: str) -> DataFrame:
        if not self.done(name):
            raise ValueError(f"{name} isn't made yet")
        return self.spark.read.parquet(self.path(name))

    def go(self, stop_before: str | None = None) -> DataFrame:
        """Makes what is missing, and returns the run's manifest."""
        for name, stage in self.stages.items():
            if name == stop_before:
                raise InterruptedError(name)
            if self.done(name):
                continue
            # what a stopped run left of this stage has no receipt and goes
            stage.make(*(self.table(n) for n in stage.needs)).write.mode("overwrite").parquet(self.path(name))
            files = manifest(self.spark, self.path(name)).where(F.endswith("path", F.lit(".parquet")))
            line = files.select(F.lit(name).alias("stage"), F.lit(self.keys[name]).alias("version"), F.substring_index("path", "/", -1).alias("file"), "bytes", "sha256")
            line.write.mode("overwrite").json(self._receipt(name))
            self.made.append(name)
        if not exists(self.spark, f"{self.folder}/manifest-{self.key()}/_SUCCESS"):
            self.summary().write.mode("overwrite").json(f"{self.folder}/manifest-{self.key()}")
        return self.manifest()

    def key(self) -> str:
        return _key(*(f"{n}:{k}" for n, k in self.keys.items()))

    def receipts(self) -> DataFrame:
        return self.spark.read.schema(RECEIPT).json([self._receipt(n) for n in self.stages])

    def summary(self) -> DataFrame:
        """stage, version, files, bytes and digest (of its files, in any order), and whether it is an artifact."""
        kinds = F.create_map(*(F.lit(x) for n, s in self.stages.items() for x in (n, s.artifact)))
        mark = F.xxhash64("file", "sha256").cast("decimal(38,0)")
        return self.receipts().groupBy("stage", "version").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.sum(mark).cast("string").alias("digest")).withColumn("artifact", F.element_at(kinds, F.col("stage")))

    def manifest(self) -> DataFrame:
        return self.spark.read.schema("stage string, version string, files long, bytes long, digest string, artifact boolean").json(f"{self.folder}/manifest-{self.key()}")

    def faults(self) -> DataFrame:
        """Files that differ from their receipts, by stage: missing, new or changed."""
        now = None
        for name in self.stages:
            files = manifest(self.spark, self.path(name)).where(F.endswith("path", F.lit(".parquet"))).select(F.lit(name).alias("stage"), F.substring_index("path", "/", -1).alias("file"), F.col("sha256").alias("now"))
            now = files if now is None else now.unionByName(files)
        both = self.receipts().select("stage", "file", "sha256").join(now, ["stage", "file"], "full")
        state = F.when(F.col("now").isNull(), "missing").when(F.col("sha256").isNull(), "new").when(F.col("now") != F.col("sha256"), "changed")
        return both.select("stage", "file", state.alias("state")).where("state IS NOT NULL")


def _key(*parts: str) -> str:
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()[:12]


def judged(figures: DataFrame, gates: list[Gate]) -> DataFrame:
    """gate and state for each gate over one row of figures."""
    state = lambda g: f"CASE WHEN NOT coalesce({g.known}, false) THEN 'PENDING' WHEN {g.passes} THEN 'PASS' ELSE 'FAIL' END"
    return figures.select(F.explode(F.array(*(F.struct(F.lit(g.name).alias("gate"), F.expr(state(g)).alias("state")) for g in gates))).alias("g")).select("g.*")
