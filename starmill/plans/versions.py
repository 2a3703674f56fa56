"""Published versions of a star: one small file each, created exclusively.

A version names its folders; a full load has one, an append lists those of the version it builds on
and one more. Of several writers that build on one version only the first creates the next file; the
others get `PublishConflict` and nothing of the winner's is lost. A file that its writer did not finish
has no line yet and does not count. The file system must refuse to create a file that exists, as HDFS does.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

_LOG = "_published"
_SCHEMA = "version int, parts array<string>, published timestamp"


class PublishConflict(RuntimeError):
    """Another load published the version that this one wanted to be."""


@dataclass(frozen=True)
class Version:
    number: int
    parts: tuple[str, ...]


def history(spark: SparkSession, base: str) -> list[Version]:
    """The published versions under `base`, newest first."""
    try:
        log = spark.read.schema(_SCHEMA).json(f"{base}/{_LOG}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    rows = log.where("version IS NOT NULL AND parts IS NOT NULL").orderBy(F.desc("version")).collect()
    return [Version(row["version"], tuple(row["parts"])) for row in rows]


def current(spark: SparkSession, base: str) -> Version | None:
    return next(iter(history(spark, base)), None)


def _file(base: str, number: int) -> str:
    return f"{base}/{_LOG}/v{number:08d}.json"


def _claimed(spark: SparkSession, base: str) -> int:
    """The largest number that a writer has taken, finished or not."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{_LOG}")
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return 0
    names = [status.getPath().getName() for status in system.listStatus(path)]
    return max((int(n[1:9]) for n in names if n.startswith("v") and n.endswith(".json")), default=0)


def next_number(spark: SparkSession, base: str) -> int:
    """What a load that starts now may publish as."""
    return _claimed(spark, base) + 1


def publish(spark: SparkSession, base: str, number: int, parts: tuple[str, ...]) -> None:
    """Make `parts` version `number`, unless that number is taken."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_file(base, number))
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    line = json.dumps({"version": number, "parts": list(parts), "published": datetime.now(timezone.utc).isoformat()})
    try:
        out = system.create(path, False)
    except Py4JJavaError as error:
        if not system.exists(path):
            raise
        raise PublishConflict(f"version {number} of {base} is taken; read the star again and repeat the load") from error
    out.write(bytearray(f"{line}\n".encode()))
    out.close()


def forget(spark: SparkSession, base: str, keep: int) -> list[str]:
    """Remove all but the newest `keep` versions; the folders that no kept one names are deleted and returned."""
    versions = history(spark, base)
    kept, old = versions[: max(1, keep)], versions[max(1, keep) :]
    used = {part for version in kept for part in version.parts}
    dropped = sorted({part for version in old for part in version.parts} - used)
    hadoop = spark._jvm.org.apache.hadoop.fs
    for name in [*(_file(base, version.number) for version in old), *dropped]:
        path = hadoop.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return dropped
