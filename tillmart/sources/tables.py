"""Tables of the warehouse: Parquet folders at ``<warehouse>/<layer>/<table>``.

A table that is replaced has a folder for each of its last two versions. A version counts once its
write has finished; until then, and after a write that failed, readers find the one before. A reader
that planned with that one can go on till the table is replaced a second time.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VERSION = re.compile(r"version-([0-9]{9})")


def table_path(warehouse: str, layer: str, table: str) -> str:
    return f"{warehouse.rstrip('/')}/{layer}/{table}"


def replace(df: DataFrame, path: str) -> None:
    """Write the table's next version, then drop those before the present one. One writer at a time."""
    spark = df.sparkSession
    before = _finished(spark, path)
    number = before[-1] + 1 if before else 1
    df.write.mode("overwrite").parquet(_version(path, number))
    for old in before[:-1]:
        delete(spark, _version(path, old))


def current(spark: SparkSession, path: str) -> str:
    """The folder of the table's present version; the path itself if it has none."""
    finished = _finished(spark, path)
    return _version(path, finished[-1]) if finished else path


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(current(spark, path))


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to that path has finished; a table without rows counts."""
    return bool(_finished(spark, path)) or exists(spark, f"{path}/_SUCCESS")


def publish(spark: SparkSession, path: str, name: str) -> None:
    """Let the external catalog table `name` have the table's present version.

    Readers by that name are switched at once; those that are reading go on with the version before.
    """
    location = current(spark, path).replace("'", "\\'")
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{location}'")


def scratch_path(spark: SparkSession, warehouse: str, name: str) -> str:
    """A path on storage every executor sees: the session's checkpoint folder if the
    cluster names one, else a folder beside the warehouse's own tables."""
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{warehouse.rstrip('/')}/_scratch"
    return f"{root.rstrip('/')}/{name}"


def session_path(spark: SparkSession, name: str) -> str:
    """A path of this session on storage every executor sees: below the checkpoint folder, else below
    the warehouse folder, one of which the cluster has to share."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/tillmart-{spark.sparkContext.applicationId}/{name}"


def exists(spark: SparkSession, path: str) -> bool:
    file_system, file = _hadoop(spark, path)
    return file_system.exists(file)


def touch(spark: SparkSession, path: str) -> None:
    """Make an empty file, unless it is there."""
    file_system, file = _hadoop(spark, path)
    file_system.createNewFile(file)


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder; nothing if there is none."""
    file_system, folder = _hadoop(spark, path)
    if not file_system.exists(folder):
        return []
    return [status.getPath().getName() for status in file_system.listStatus(folder)]


def delete(spark: SparkSession, path: str) -> None:
    file_system, folder = _hadoop(spark, path)
    file_system.delete(folder, True)


def _version(path: str, number: int) -> str:
    return f"{path}/version-{number:09d}"


def _finished(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions whose write has finished, in order."""
    found = [VERSION.fullmatch(name) for name in names(spark, path)]
    numbers = sorted(int(match[1]) for match in found if match)
    return [n for n in numbers if exists(spark, f"{_version(path, n)}/_SUCCESS")]


def _hadoop(spark: SparkSession, path: str) -> tuple:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return hadoop_path.getFileSystem(conf), hadoop_path
