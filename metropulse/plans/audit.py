"""Row counts of jobs: what was read and written, counted while the job itself runs.

Every scan and sink of a job is observed, so no counting job is added; the counts are appended to one audit table as a row per
dataset. A dataset that the job did not get to has no count.
"""

from __future__ import annotations

import threading
import uuid
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SCHEMA = "job string, run string, side string, dataset string, rows bigint"
#: Seconds to wait for the count of a dataset once the job has ended.
PATIENCE = 10.0


@dataclass
class Audit:
    job: str
    run: str = field(default_factory=lambda: uuid.uuid4().hex)
    seen: list[tuple[str, str, Observation]] = field(default_factory=list)

    def watch(self, df: DataFrame, side: str, dataset: str) -> DataFrame:
        observed = Observation()
        self.seen.append((side, dataset, observed))
        return df.observe(observed, F.count(F.lit(1)).alias("rows"))

    def rows(self) -> list[tuple[str, str, str, str, int | None]]:
        """(job, run, side, dataset, rows); of a dataset read more than once the most."""
        found: dict[tuple[str, str], int | None] = {}
        for side, dataset, observed in self.seen:
            count = _count(observed)
            before = found.get((side, dataset))
            found[side, dataset] = count if before is None else max(before, count or 0)
        return [(self.job, self.run, side, dataset, n) for (side, dataset), n in found.items()]

    def save(self, spark: SparkSession, path: str) -> None:
        """Append to the audit table. A run's rows are the partition of its name, so saving twice changes nothing."""
        rows = spark.createDataFrame(self.rows(), SCHEMA).drop("job", "run")
        rows.coalesce(1).write.mode("overwrite").json(f"{path.rstrip('/')}/job={self.job}/run={self.run}")


def _count(observed: Observation) -> int | None:
    """The observed rows, or None when nothing ran; reading an observation waits until something does."""
    got: list[int] = []
    reader = threading.Thread(target=lambda: got.append(observed.get["rows"]), daemon=True)
    reader.start()
    reader.join(PATIENCE)
    return got[0] if got else None


_current: ContextVar[Audit | None] = ContextVar("audit", default=None)


@contextmanager
def audited(spark: SparkSession, job: str, path: str | None):
    """Count what ``watched`` sees inside, and append it to the audit table at ``path``; nothing without one."""
    if not path:
        yield None
        return
    audit = Audit(job)
    token = _current.set(audit)
    try:
        yield audit
    finally:
        _current.reset(token)
    audit.save(spark, path)


def watched(df: DataFrame, side: str, dataset: str) -> DataFrame:
    audit = _current.get()
    return audit.watch(df, side, dataset) if audit else df


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).json(path)
