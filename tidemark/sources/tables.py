"""Managed tables of a catalog: read, append, replace, merge, and small facts kept as table properties.

A v2 catalog (three-part names whose first part is configured as ``spark.sql.catalog.<name>``) replaces and
merges in place. Tables of the session catalog cannot be replaced while they are read, so a replacement is
written as a new version ``<name>__v<time>`` and a view ``<name>`` is moved over to it in one statement, together
with its properties.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import column, same_key
from ..operators.merge import CDC_POSITION, IS_DELETED, merge_changes, merge_upsert, not_before, not_older
from .parts import FOLDER_MARK, PART, create_version, folders_of, part_number, parts_in, remove_unlisted, with_part, write_parts

VERSION_MARK = "__v"
BUCKETS = "tidemark.buckets"
# Number of parts, the columns that cut them, and the published version.
PARTS = "tidemark.parts"
PART_KEYS = "tidemark.part_keys"
VERSION = "tidemark.version"


def run_sql(spark: SparkSession, text: str) -> DataFrame:
    """Run one SQL statement; a trailing semicolon is allowed."""
    return spark.sql(text.strip().rstrip(";"))


def quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def quoted_part(name: str) -> str:
    """One name, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


@dataclass(frozen=True)
class TableStore:
    spark: SparkSession
    # File format of session-catalog tables.
    file_format: str = "parquet"
    # Replaced versions that stay for readers still on them.
    keep_versions: int = 1

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(name)

    def read(self, name: str) -> DataFrame:
        return self.spark.table(name)

    def read_if_exists(self, name: str) -> DataFrame | None:
        return self.read(name) if self.exists(name) else None

    def lookup(self, name: str, values: Mapping[str, object]) -> DataFrame:
        """Rows with these values, which are cast to the columns' types first. A NULL value finds NULLs.

        Where the table is cut into parts and ``values`` hold all of its part keys, only the one part they fall into is
        listed and read, and in it the row groups whose key range holds them.
        """
        kept = {} if self.in_v2_catalog(name) else self.properties(name)
        cut = kept[PART_KEYS].split(",") if PARTS in kept else []
        rows = self.spark.table(kept[VERSION]) if cut else self.read(name)
        types = dict(rows.dtypes)
        match = reduce(and_, [column(c).eqNullSafe(F.lit(v).cast(types[c])) for c, v in values.items()])
        if cut and set(cut) <= set(values):
            match = (column(PART) == part_number({k: values[k] for k in cut}, int(kept[PARTS]), types)) & match
        return rows.filter(match).drop(PART)

    def create_namespace(self, table_name: str) -> None:
        """Create the namespace the table lives in, if it is absent."""
        namespace = table_name.rpartition(".")[0]
        if namespace:
            self.spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {quoted(namespace)}")

    def in_v2_catalog(self, name: str) -> bool:
        parts = name.split(".")
        if len(parts) < 3 or parts[0] == "spark_catalog":
            return False
        return self.spark.conf.get(f"spark.sql.catalog.{parts[0]}", None) is not None

    def append(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
        """Append by column name; the first call creates the table."""
        self.create_namespace(name)
        if not self.in_v2_catalog(name):
            df.write.mode("append").format(self.file_format).partitionBy(*partition_by).saveAsTable(name)
        elif self.exists(name):
            df.writeTo(name).append()
        else:
            self._v2_writer(df, name, partition_by).create()

    def replace(
        self,
        df: DataFrame,
        name: str,
        properties: Mapping[str, str] | None = None,
        partition_by: Sequence[str] = (),
        bucket_by: Sequence[str] = (),
        buckets: int = 0,
        aligned: bool = False,
        parts: int = 0,
    ) -> None:
        """Publish ``df`` as the whole content of the table; readers see the old or the new content.

        With ``buckets`` a session-catalog table is bucketed by the columns ``bucket_by``. ``aligned`` says that ``df``
        is partitioned like that already, as it is after a merge with the bucketed table itself. With ``parts`` it is
        cut into parts by these columns, and merges rewrite the parts they touch (see ``rewrite_touched``).
        """
        self.create_namespace(name)
        properties = dict(properties or {})
        if parts and not self.in_v2_catalog(name):
            cut = {PARTS: str(parts), PART_KEYS: ",".join(bucket_by)}
            return self._publish_parts(df, name, {**properties, **cut}, {})
        if self.in_v2_catalog(name):
            writer = self._v2_writer(df, name, partition_by)
            for key, value in properties.items():
                writer = writer.tableProperty(key, value)
            writer.createOrReplace()
            return
        version = f"{name}{VERSION_MARK}{datetime.now(timezone.utc):%Y%m%d%H%M%S%f}"
        if buckets and not aligned:
            df = df.repartition(buckets, *[column(c) for c in bucket_by])
        writer = df.write.mode("error").format(self.file_format).partitionBy(*partition_by)
        if buckets:
            writer = writer.bucketBy(buckets, *bucket_by)
            properties[BUCKETS] = str(buckets)
        writer.saveAsTable(version)
        self._point_view(name, version, properties)
        self._drop_old_versions(name, version)

    def merge(
        self,
        source: DataFrame,
        name: str,
        keys: Sequence[str],
        changes: bool = False,
        properties: Mapping[str, str] | None = None,
        newer_by: Sequence[str] = (),
    ) -> None:
        """Merge by key: an upsert, or flagged changes when ``changes`` is set.

        A v2 catalog merges in one statement and takes the properties in others; a crash between them repeats the merge.
        """
        if self.in_v2_catalog(name):
            columns = self.read(name).columns
            if CDC_POSITION in source.columns and CDC_POSITION not in columns:
                kind = source.schema[CDC_POSITION].dataType.simpleString()
                self.spark.sql(f"ALTER TABLE {quoted(name)} ADD COLUMNS ({CDC_POSITION} {kind})")
            merge_into(source, name, keys, changes, newer_by, columns)
            for key, value in (properties or {}).items():
                self.set_property(name, key, value)
            return
        kept, buckets = self.properties(name), self.buckets(name)

        def merged(target: DataFrame) -> DataFrame:
            if changes:
                return merge_changes(target, source, keys, buckets)
            return merge_upsert(target, source, keys, buckets, newer_by)

        if self.parts(name):
            self.rewrite_touched(name, source, merged, properties)
            return
        self.replace(
            merged(self.read(name)), name, {**kept, **(properties or {})}, bucket_by=keys, buckets=buckets, aligned=True)

    def rewrite_touched(
        self,
        name: str,
        batch: DataFrame,
        build: Callable[[DataFrame], DataFrame],
        properties: Mapping[str, str] | None = None,
    ) -> None:
        """Rewrite the parts of a table that hold keys of ``batch``; the others are published as they lie.

        ``build`` gets the rows of those parts and gives the rows to put in their place. It must leave other keys alone.
        ``batch`` is evaluated twice, once for the parts it touches.
        """
        kept = self.properties(name)
        parts, keys = int(kept[PARTS]), kept[PART_KEYS].split(",")
        types = dict(self.read(name).dtypes)
        wanted = with_part(batch, keys, parts, types).select(PART).distinct()
        touched = [row[PART] for row in wanted.collect()]  # at most the number of parts
        stored = self.spark.table(kept[VERSION])
        inside = F.col(PART).isin(touched) if touched else F.lit(False)
        untouched = folders_of(stored.filter(~inside))
        rows = build(stored.filter(inside).drop(PART))
        self._publish_parts(rows, name, {**kept, **(properties or {})}, untouched)

    def _publish_parts(
        self, df: DataFrame, name: str, properties: dict[str, str], untouched: Mapping[int, str]
    ) -> None:
        """A new version of the rows of ``df``, in new folders, and the untouched parts, where they are."""
        stamp = f"{datetime.now(timezone.utc):%Y%m%d%H%M%S%f}"
        version, root = name + VERSION_MARK + stamp, self._part_root(name)
        keys, types = properties[PART_KEYS].split(","), dict(df.dtypes)
        columns = ", ".join(f"{quoted_part(f.name)} {f.dataType.simpleString()}" for f in df.schema.fields)
        write_parts(with_part(df, keys, int(properties[PARTS]), types), keys, f"{root}/{stamp}", self.file_format)
        folders = {**untouched, **parts_in(self.spark, f"{root}/{stamp}")}
        create_version(self.spark, quoted(version), columns, folders, f"{root}/{stamp}", self.file_format)
        shown = ", ".join(quoted_part(c) for c in df.columns)
        self._point_view(name, version, {**properties, VERSION: version}, shown)
        self._drop_old_versions(name, version)
        kept = [f for table in self._versions(name) for f in folders_of(self.spark.table(table)).values()]
        remove_unlisted(self.spark, root, kept, stamp)

    def _part_root(self, name: str) -> str:
        namespace, _, table = name.rpartition(".")
        home = self.spark.catalog.getDatabase(namespace or self.spark.catalog.currentDatabase()).locationUri
        return f"{home.rstrip('/')}/{table}{FOLDER_MARK}"

    def parts(self, name: str) -> int:
        """Number of parts the table is cut into, 0 when it is stored as a whole."""
        return 0 if self.in_v2_catalog(name) else int(self.properties(name).get(PARTS, 0))

    def buckets(self, name: str) -> int:
        """Number of buckets the table is stored in, 0 when it is not bucketed."""
        return int(self.properties(name).get(BUCKETS, 0))

    def properties(self, name: str) -> dict[str, str]:
        """Our own properties of a table or view."""
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {quoted(name)}").collect()
        return {r["key"]: r["value"] for r in rows if r["key"].startswith("tidemark.")}

    def set_property(self, name: str, key: str, value: str) -> None:
        kind = "VIEW" if self._is_view(name) else "TABLE"
        self.spark.sql(f"ALTER {kind} {quoted(name)} SET TBLPROPERTIES ({_literal(key)} = {_literal(value)})")

    def latest_partition(self, name: str, partition_column: str) -> str | None:
        """Highest value of the partition column from the catalog alone; None when there is none to ask."""
        if self.in_v2_catalog(name) or self._is_view(name):
            return None
        rows = self.spark.sql(f"SHOW PARTITIONS {quoted(name)}").selectExpr("max(partition) AS newest").first()
        return rows["newest"].partition(f"{partition_column}=")[2] if rows["newest"] else None

    def _v2_writer(self, df: DataFrame, name: str, partition_by: Sequence[str]):
        writer = df.writeTo(name)
        return writer.partitionedBy(*partition_by) if partition_by else writer

    def _is_view(self, name: str) -> bool:
        return not self.in_v2_catalog(name) and self.spark.catalog.getTable(name).tableType == "VIEW"

    def _point_view(self, name: str, version: str, properties: Mapping[str, str], columns: str = "*") -> None:
        pairs = ", ".join(f"{_literal(k)} = {_literal(v)}" for k, v in properties.items())
        clause = f"TBLPROPERTIES ({pairs}) " if pairs else ""
        self.spark.sql(f"CREATE OR REPLACE VIEW {quoted(name)} {clause}AS SELECT {columns} FROM {quoted(version)}")

    def _versions(self, name: str) -> list[str]:
        """The stored versions of a table, newest first."""
        namespace, _, table = name.rpartition(".")
        scope = f"IN {quoted(namespace)} " if namespace else ""
        found = self.spark.sql(f"SHOW TABLES {scope}LIKE '{table}{VERSION_MARK}*'").collect()
        names = sorted({r["tableName"].lower() for r in found}, reverse=True)
        return [f"{namespace}.{version}" if namespace else version for version in names]

    def _drop_old_versions(self, name: str, current: str) -> None:
        """Drop all versions but the current one and the newest ``keep_versions`` others."""
        published = current.rpartition(".")[2].lower()
        others = [version for version in self._versions(name) if version.rpartition(".")[2] != published]
        for old in others[self.keep_versions :]:
            self.spark.sql(f"DROP TABLE IF EXISTS {quoted(old)}")


def merge_into(
    source: DataFrame,
    name: str,
    keys: Sequence[str],
    changes: bool = False,
    newer_by: Sequence[str] = (),
    target_columns: Sequence[str] = (),
) -> None:
    """The same merges as a row-level operation of a v2 catalog that supports MERGE."""
    target = name.rpartition(".")[2]
    s = source.alias("s")
    values = {c: column(c, "s") for c in source.columns if c not in keys}
    writer = s.mergeInto(name, same_key(keys, target, "s"))
    if changes:
        deleted, newer = column(IS_DELETED, "s") == 1, not_before(source, target_columns, "s", target)
        position = {c: v for c, v in values.items() if c == CDC_POSITION}
        writer = writer.whenMatched(deleted & newer).update({IS_DELETED: F.lit(1), **position})
        writer = writer.whenMatched(~deleted & newer).update(values)
    else:
        newer = (not_older(newer_by, "s", target),) if newer_by else ()
        writer = writer.whenMatched(*newer).update(values)
    writer.whenNotMatched().insert({c: column(c, "s") for c in source.columns}).merge()


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
