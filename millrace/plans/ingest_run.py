"""Ingestion runs that succeed or fail as a whole.

A run reads new rows, drops those at or before their key's mark, keeps one copy of
each, and writes rows, rejects and the new marks to folders that nothing refers
to yet. One small record then commits all of it: file folders, counts of every
step, the version of the marks and the run's ordinal. Whoever reads the feed reads the
folders that records name. So a run that dies between any two steps has changed nothing, its
rerun starts from the same marks, and the rerun of a committed run only returns its record.

Records are numbered; a record appears by a rename that fails if its number is
taken, so of two runs at once one commits and the other raises ``RunConflict``.
Counts are observed while rows are written, without jobs of their own.

Defined results: rows whose time is null can't be judged by a mark and are stored as
rejects; rows with a null key have a mark like any other key; an empty batch commits no rows
and keeps the marks.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.operators.keys import dedup_first, untimed

STEPS = ("rows written", "rejects written", "marks written", "record written")
MARK = "mark"


class RunConflict(RuntimeError):
    """Another run has committed since this one began."""


def _fs(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _counted(watched: Observation) -> int:
    """What was observed; a frame that the optimizer knows to be empty is not run, and has no count but 0."""
    try:
        return int(watched.get["n"])
    except Py4JJavaError:
        return 0


@dataclass(frozen=True)
class Feed:
    """A landed feed below ``root``: rows by ``key`` with a time ``ts``; one copy is kept for each of ``same``, the first by ``order``."""

    root: str
    key: str
    ts: str
    same: Sequence[str]
    order: Sequence[Column]

    def records(self, spark: SparkSession) -> list[dict]:
        """All commits in order. There is one small file a run."""
        where, fs = _fs(spark, f"{self.root}/commits")
        if not fs.exists(where):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(where)]
        numbers = sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))
        out = []
        for n in numbers:
            path, _ = _fs(spark, f"{self.root}/commits/{n:09d}.json")
            stream = fs.open(path)
            try:
                out.append(json.loads(bytes(stream.readAllBytes()).decode()))
            finally:
                stream.close()
        return out

    def rows(self, spark: SparkSession, what: str = "rows") -> DataFrame | None:
        """All committed rows (or ``rejects``) with the ordinal of their run; None before the first commit."""
        frames = [
            spark.read.parquet(f"{self.root}/{r[what]}").withColumn("run_ordinal", F.lit(r["ordinal"])) for r in self.records(spark)
        ]
        out = frames[0] if frames else None
        for frame in frames[1:]:
            out = out.unionByName(frame, allowMissingColumns=True)
        return out

    def marks(self, spark: SparkSession) -> DataFrame | None:
        done = self.records(spark)
        return spark.read.parquet(f"{self.root}/{done[-1]['marks']}") if done else None

    def _commit(self, spark: SparkSession, record: dict) -> None:
        jvm = spark.sparkContext._jvm
        temporary, fs = _fs(spark, f"{self.root}/commits/.{uuid.uuid4().hex}")
        final, _ = _fs(spark, f"{self.root}/commits/{record['ordinal']:09d}.json")
        stream = fs.create(temporary, False)
        stream.write(bytearray(json.dumps(record, sort_keys=True).encode()))
        stream.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri())
        none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(temporary, final, none)
        except Exception as error:
            fs.delete(temporary, False)
            raise RunConflict(f"ordinal {record['ordinal']} of {self.root} is taken") from error

    def ingest(self, batch: DataFrame, run: str, after: Callable[[str], None] = lambda step: None) -> dict:
        """Run ``run`` over ``batch``; returns its record. ``after`` is called behind every step."""
        spark = batch.sparkSession
        done = self.records(spark)
        for record in done:
            if record["run"] == run:
                return record
        own = uuid.uuid4().hex
        record = {"run": run, "ordinal": len(done) + 1, **{k: f"{k}/{own}" for k in ("rows", "rejects", "marks")}}
        watched = {step: Observation(f"{step}-{own}") for step in ("read", "fresh", "landed", "rejected")}

        def seen(df: DataFrame, step: str) -> DataFrame:
            return df.observe(watched[step], F.count(F.lit(1)).alias("n"))

        marks = spark.read.parquet(f"{self.root}/{done[-1]['marks']}") if done else None
        timed = seen(batch, "read").filter(F.col(self.ts).isNotNull())
        if marks is not None:
            known = marks.withColumnsRenamed({self.key: "its_key"})
            joined = timed.join(known, F.col(self.key).eqNullSafe(F.col("its_key")), "left")
            timed = joined.filter(F.col(MARK).isNull() | (F.col(self.ts) > F.col(MARK))).drop("its_key", MARK)
        landed = seen(dedup_first(seen(timed, "fresh"), list(self.same), list(self.order)), "landed")
        landed.write.parquet(f"{self.root}/{record['rows']}")
        after(STEPS[0])
        seen(untimed(batch, self.ts), "rejected").write.parquet(f"{self.root}/{record['rejects']}")
        after(STEPS[1])
        newest = spark.read.schema(landed.schema).parquet(f"{self.root}/{record['rows']}").select(self.key, F.col(self.ts).alias(MARK))
        both = newest if marks is None else newest.unionByName(marks)
        both.groupBy(self.key).agg(F.max(MARK).alias(MARK)).write.parquet(f"{self.root}/{record['marks']}")
        after(STEPS[2])
        record["counts"] = {step: _counted(o) for step, o in watched.items()}
        self._commit(spark, record)
        after(STEPS[3])
        return record

    def report(self, spark: SparkSession) -> DataFrame:
        """One row per run and step: run, ordinal, step, n."""
        rows = [(r["run"], r["ordinal"], step, n) for r in self.records(spark) for step, n in r["counts"].items()]
        return spark.createDataFrame(rows, "run string, ordinal int, step string, n long")

    def sweep(self, spark: SparkSession) -> list[str]:
        """Delete folders that no record names (of dead runs; call it while none runs), and superseded marks."""
        done = self.records(spark)
        named = {r[k] for r in done for k in ("rows", "rejects")} | {r["marks"] for r in done[-1:]}
        gone = []
        for kind in ("rows", "rejects", "marks"):
            where, fs = _fs(spark, f"{self.root}/{kind}")
            for status in fs.listStatus(where) if fs.exists(where) else []:
                name = f"{kind}/{status.getPath().getName()}"
                if name not in named:
                    fs.delete(status.getPath(), True)
                    gone.append(name)
        return sorted(gone)
