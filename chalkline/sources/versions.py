"""Replacing a table while others read it.

Each write of a table goes to a folder of its own below the table's path. Only when it is complete
is a commit recorded, as one more file in the folder of commits: (version, folder). Readers take the folder of the
highest version. So a reader sees the former table until the new one is whole, a write that fails
leaves the former one in place, and a job may replace the table that it reads. Former folders stay, for
readers that began on them, until `expire_versions`.

There should be one writer of a table at a time; of two that commit the same version the one whose folder's
name is the greater counts, for every reader.
"""

import posixpath
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException

COMMITS = "commits"
_COMMIT = "version long, folder string"


def commits(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """The committed (version, folder) of a table, latest first; none where there is no such table."""
    try:
        rows = spark.read.schema(_COMMIT).json(posixpath.join(path, COMMITS)).collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(((row.version, row.folder) for row in rows), reverse=True)


def next_folder(spark: SparkSession, path: str) -> tuple[int, str]:
    """The number and the folder of a version still to be written; no folder is ever used twice."""
    known = commits(spark, path)
    version = known[0][0] + 1 if known else 1
    return version, f"v{version:06d}-{uuid.uuid4().hex}"


def commit(spark: SparkSession, path: str, version: int, folder: str) -> None:
    """Makes a written folder the current one. Spark's committer brings the record as a whole file or not at all."""
    record = spark.createDataFrame([(version, folder)], _COMMIT).coalesce(1)
    record.write.mode("append").json(posixpath.join(path, COMMITS))


def current_path(spark: SparkSession, path: str) -> str:
    """Where the current version lies: a table that was never committed is taken to lie at the path itself."""
    known = commits(spark, path)
    return posixpath.join(path, known[0][1]) if known else path


def replace(df: DataFrame, path: str, save) -> str:
    """Writes `df` as the next version of the table at `path` by `save(df, folder)`; returns the path of the folder."""
    spark = df.sparkSession
    version, folder = next_folder(spark, path)
    target = posixpath.join(path, folder)
    save(df, target)
    commit(spark, path, version, folder)
    return target


def expire_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Deletes the folders of all but the latest `keep` versions, and of writes before those that failed.

    Readers that began on them should have ended. Returns the names of the deleted folders.
    """
    if keep < 1:
        raise ValueError("the current version cannot expire")
    latest = commits(spark, path)[:keep]
    if not latest:
        return []
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    kept, oldest = {folder for _, folder in latest}, latest[-1][0]
    found = [status.getPath().getName() for status in files.listStatus(root)]
    old = [name for name in found if name[:1] == "v" and name[1:7].isdigit() and name not in kept and int(name[1:].split("-")[0]) <= oldest]
    for name in old:
        files.delete(jvm.org.apache.hadoop.fs.Path(root, name), True)
    return sorted(old)
