"""Tables of the session catalog cut into parts by key, so that a merge rewrites only the parts it touches.

A published version is a catalog table partitioned by part number. Its partitions name the folders that hold them:
those a merge has rewritten lie in a new folder, all others are listed where they are. A folder is never written
twice; it goes when no kept version lists it any more.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import column

PART = "_part"
FOLDER_MARK = "__parts"


def part_of(keys: Sequence[str], parts: int, types: Mapping[str, str]) -> Column:
    """Part number of a row. Keys are cast to the table's types first, for the hash depends on them."""
    return F.pmod(F.xxhash64(*[column(k).cast(types[k]) for k in keys]), F.lit(parts)).cast("int")


def with_part(df: DataFrame, keys: Sequence[str], parts: int, types: Mapping[str, str]) -> DataFrame:
    return df.withColumn(PART, part_of(keys, parts, types))


def part_number(values: Mapping[str, object], parts: int, types: Mapping[str, str]) -> Column:
    """Part number of one key, a constant for the optimizer; ``values`` are in the order of the table's part keys."""
    return F.pmod(F.xxhash64(*[F.lit(v).cast(types[k]) for k, v in values.items()]), F.lit(parts)).cast("int")


def write_parts(df: DataFrame, keys: Sequence[str], folder: str, file_format: str) -> None:
    """Write rows that carry their part number, each part to a folder of its own, sorted by key within a file.

    Adaptive execution gathers small parts and splits large ones, so a part is few files and no task holds a part that
    is larger than the advisory partition size. Sorted files let a reader skip row groups by their key ranges.
    """
    order = [column(PART), *[column(k) for k in keys]]
    df.hint("rebalance", column(PART)).sortWithinPartitions(*order).write.mode("error").format(file_format).partitionBy(PART).save(folder)


def folders_of(df: DataFrame) -> dict[int, str]:
    """Part number to folder of all parts that have rows, from the file listing alone."""
    found = {}
    for file in df.inputFiles():
        folder = unquote(file.rpartition("/")[0])  # files are listed as addresses, locations are given as paths
        found[int(folder.rpartition(f"{PART}=")[2])] = folder
    return found


def parts_in(spark: SparkSession, folder: str) -> dict[int, str]:
    """Part number to folder of what ``write_parts`` wrote."""
    names = (path.rpartition(f"{PART}=") for path in list_folder(spark, folder))
    return {int(number): f"{folder}/{PART}={number}" for _, mark, number in names if mark}


def create_version(
    spark: SparkSession, quoted_name: str, columns: str, folders: Mapping[int, str], root: str, file_format: str
) -> None:
    """A catalog table whose partitions are the given folders."""
    spark.sql(
        f"CREATE TABLE {quoted_name} ({columns}, {PART} INT) USING {file_format} PARTITIONED BY ({PART}) "
        f"LOCATION '{_escaped(root)}'"
    )
    numbers = sorted(folders)
    for start in range(0, len(numbers), 500):
        listed = " ".join(
            f"PARTITION ({PART} = {n}) LOCATION '{_escaped(folders[n])}'" for n in numbers[start : start + 500])
        spark.sql(f"ALTER TABLE {quoted_name} ADD {listed}")


def list_folder(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the folders in a folder; none where it does not exist."""
    path, files = _file_system(spark, folder)
    if not files.exists(path):
        return []
    return [str(status.getPath().toString()) for status in files.listStatus(path) if status.isDirectory()]


def remove_unlisted(spark: SparkSession, root: str, kept: Sequence[str], before: str) -> None:
    """Remove part folders written before the stamp ``before`` that no kept version lists.

    That takes in what a crashed merge has written and not published.
    """
    names = {_tail(folder) for folder in kept}
    for stamp in list_folder(spark, root):
        if stamp.rpartition("/")[2] >= before:
            continue
        parts = list_folder(spark, stamp)
        gone = [part for part in parts if _tail(part) not in names]
        for folder in [stamp] if len(gone) == len(parts) else gone:
            path, files = _file_system(spark, folder)
            files.delete(path, True)


def _tail(folder: str) -> str:
    """Stamp and part of a folder, which name it whatever the form of its address."""
    return "/".join(folder.rstrip("/").split("/")[-2:])


def _file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")
