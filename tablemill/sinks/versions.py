"""Targets that keep their old content until the new one is complete.

A target is a folder. Every write puts its rows into a folder of its own below ``data`` and
then commits by one small file below ``versions``, written aside and renamed to the
next number. The file lists the partitions of the version and where their rows lie. Readers
take the file of the highest number, so a write that fails, or a reader at work, leaves
the old rows as they were, and a version can share the partitions it did not change with the one before.

An upsert rewrites the partitions only that its source touches. The others are neither read
nor written, whatever the size of the target. One writer at a time: the second of two that start from the same
version finds its number taken and fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablemill.operators.dml import truncate_load, upsert
from tablemill.operators.filters import key_complete
from tablemill.operators.joins import distinct_keys
from tablemill.session import staged
from tablemill.sinks.files import observed_write
from tablemill.spec import col, intersect_columns, key_list

PART = "__part"
WHOLE = "all"


@dataclass(frozen=True)
class Version:
    """Content of a commit file: schema, partitioning expressions, partition -> folder."""

    number: int
    schema: dict
    by: tuple[str, ...] = ()
    parts: dict[str, str] = field(default_factory=dict)
    rows: int | None = None


class Folder:
    """Small files of a folder, through the file system the path belongs to."""

    def __init__(self, spark: SparkSession, root: str):
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._jvm = spark.sparkContext._jvm
        self.root = root.rstrip("/")
        self._fs = self._path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, *names: str):
        return self._path("/".join((self.root, *names)))

    def names(self, *folder: str) -> list[str]:
        path = self.at(*folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def read(self, *name: str) -> str:
        stream = self._fs.open(self.at(*name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def commit(self, text: str, *name: str) -> None:
        """Write a file aside and give it its name, which must be free."""
        aside = self.at(*name[:-1], f".{name[-1]}-{uuid.uuid4().hex}")
        stream = self._fs.create(aside, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        target = self.at(*name)
        if self._fs.exists(target) or not self._fs.rename(aside, target):
            self._fs.delete(aside, False)
            raise FileExistsError(f"another write committed {target} first")

    def delete(self, *name: str) -> None:
        self._fs.delete(self.at(*name), True)


class VersionedTable:
    """A target below ``root``. ``by`` are SQL expressions over its columns (``year(day)``) whose
    values make up a partition; they are fixed by the first version."""

    def __init__(self, spark: SparkSession, root: str, by: Sequence[str] = ()):
        self.spark, self.folder = spark, Folder(spark, root)
        self._by = tuple(by)

    # Versions

    def numbers(self) -> list[int]:
        names = [n for n in self.folder.names("versions") if n.endswith(".json") and not n.startswith(".")]
        return [int(n.removesuffix(".json")) for n in names]

    def version(self, number: int | None = None) -> Version | None:
        """A version, the latest by default; None before the first write."""
        known = self.numbers()
        if number is None:
            if not known:
                return None
            number = known[-1]
        found = json.loads(self.folder.read("versions", f"{number:012d}.json"))
        return Version(number, found["schema"], tuple(found["by"]), found["parts"], found["rows"])

    def read(self, number: int | None = None, parts: Sequence[str] | None = None) -> DataFrame:
        """Rows of a version, or of some of its partitions (none but those are opened)."""
        version = self.version(number)
        if version is None:
            raise FileNotFoundError(f"{self.folder.root} has no version")
        schema = T.StructType.fromJson(version.schema)
        wanted = version.parts if parts is None else {p: version.parts[p] for p in parts if p in version.parts}
        if not wanted:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.folder.root}/{path}" for path in sorted(wanted.values())])

    def _commit(self, before: Version | None, schema, by, parts: dict[str, str], rows: int | None) -> Version:
        number = (before.number if before else 0) + 1
        text = json.dumps({"schema": schema, "by": list(by), "parts": parts, "rows": rows})
        self.folder.commit(text, "versions", f"{number:012d}.json")
        return Version(number, schema, tuple(by), parts, rows)

    def expire(self, keep: int = 1) -> list[str]:
        """Forget all but the last versions, and delete the folders that none of those lists.
        Also removes what failed writes left behind, so no write may be under way."""
        numbers = self.numbers()
        for number in numbers[: max(0, len(numbers) - keep)]:
            self.folder.delete("versions", f"{number:012d}.json")
        used = {path for n in self.numbers() for path in self.version(n).parts.values()}
        gone = []
        for write in self.folder.names("data"):
            paths = [f"data/{write}/{p}" for p in self.folder.names("data", write) if p.startswith(f"{PART}=")]
            unused = [p for p in paths if p not in used]
            if len(unused) == len(paths):
                unused = [f"data/{write}"]
            for path in unused:
                self.folder.delete(path)
            gone += unused
        return gone

    # Writes

    def _part(self, by: Sequence[str]) -> Column:
        """Name of the partition of a row: a digest of the values, so safe in any path."""
        if not by:
            return F.lit(WHOLE)
        return F.md5(F.to_json(F.struct(*[F.expr(x).alias(f"p{i}") for i, x in enumerate(by)]), {"ignoreNullFields": "false"}))

    def _write(self, df: DataFrame, by: Sequence[str]) -> tuple[dict[str, str], int]:
        """Rows into a new folder: its partitions, and the number of rows."""
        name = uuid.uuid4().hex
        rows = df.withColumn(PART, self._part(by))
        # Rows of a partition meet in few files; AQE splits a partition that is too large.
        rows = rows.hint("rebalance", F.col(PART)) if by else rows
        count = observed_write(rows, lambda d: d.write.partitionBy(PART).parquet(f"{self.folder.root}/data/{name}"))
        found = [p for p in self.folder.names("data", name) if p.startswith(f"{PART}=")]
        return {p.removeprefix(f"{PART}="): f"data/{name}/{p}" for p in found}, count

    def replace(self, df: DataFrame) -> int:
        """Commit the frame as the whole content; returns its number of rows."""
        before = self.version()
        by = before.by if before and not self._by else self._by
        parts, rows = self._write(df, by)
        self._commit(before, df.schema.jsonValue(), by, parts, rows)
        return rows

    def truncate_load(self, src: DataFrame) -> int:
        """The source in the shape of the target as its whole content."""
        return self.replace(truncate_load(self.read(), src))

    def touched(self, src: DataFrame, keys: Sequence[str]) -> list[str]:
        """Partitions that rows of the source are or will be in.

        Where the partition follows from the key, the source tells them. Else rows of a
        key may stand in another partition, and the keys of the target are looked through.
        At most one value per partition reaches the driver.
        """
        version = self.version()
        by = version.by
        if not by:
            return [WHOLE]
        names = set()
        empty = self.spark.createDataFrame([], T.StructType.fromJson(version.schema))
        frames = [src.select(self._part(by).alias(PART))]
        if not self._inputs(empty, by) <= set(keys):
            # Source keys are distinct here, and only the key columns of the target are read.
            found = distinct_keys(src.where(key_complete(keys)), [(k, f"__key_{i}") for i, k in enumerate(keys)])
            old = self.read().select(*[col(k) for k in keys], self._part(by).alias(PART))
            match = F.lit(True)
            for i, k in enumerate(keys):
                match = match & (col(k) == col(f"__key_{i}"))
            frames.append(old.join(found, match, "left_semi").select(PART))
        for frame in frames:
            names |= {r[0] for r in frame.distinct().collect()}
        return sorted(names)

    def _inputs(self, empty: DataFrame, by: Sequence[str]) -> set[str]:
        """Columns that the partitioning expressions read."""
        used = set()
        for x in by:
            references = empty.select(F.expr(x))._jdf.queryExecution().analyzed().expressions().head().references().toSeq()
            used |= {references.apply(i).name() for i in range(references.size())}
        return used

    def rewrite(self, parts: Sequence[str], make: Callable[[DataFrame], DataFrame]) -> int:
        """Commit a version in which the named partitions are what ``make`` makes of their
        rows; the others stay where they are. Returns the rows written."""
        before = self.version()
        new = make(self.read(before.number, parts))
        schema = T.StructType.fromJson(before.schema)
        written, rows = self._write(new.select([col(f.name).cast(f.dataType).alias(f.name) for f in schema]), before.by)
        strange = set(written) - set(parts)
        if strange:
            raise ValueError("rows moved to partitions that were not to be rewritten")
        kept = {p: path for p, path in before.parts.items() if p not in set(parts)}
        self._commit(before, before.schema, before.by, {**kept, **written}, None)
        return rows

    def upsert(self, src: DataFrame, keys, order=(), filter: Column | None = None) -> dict[str, int]:
        """Upsert by key (see ``operators.dml.upsert``) that rewrites the touched partitions.

        The source is written once to the shared folder, as it is needed for the partitions
        and for the rows. ``filter`` restricts it (a merge). Returns how many partitions
        and rows were written.
        """
        keys = key_list(keys)
        if filter is not None:
            src = src.where(filter)
        names = [f["name"] for f in self.version().schema["fields"]]
        src = src.select([col(c) for c in dict.fromkeys([*intersect_columns(src.columns, names), *key_list(order)])])
        if not self._inputs(self.read(parts=[]), self.version().by) <= set(src.columns):
            raise ValueError("the source must hold the columns that decide the partition")
        src = staged(src, "source")
        parts = self.touched(src, keys)
        rows = self.rewrite(parts, lambda old: upsert(old, src, keys, order))
        return {"partitions": len(parts), "rows": rows}

    def migrate(self, rows: DataFrame, id_column: str = "ID") -> dict[str, int]:
        """Migrated rows (``operators.reconcile.history_migrate``) into the target: merged by
        id where the columns are those of the target, else they are the new content."""
        if rows.columns == [f["name"] for f in self.version().schema["fields"]]:
            return self.upsert(rows, id_column, [c for c in rows.columns if c != id_column])
        count = self.replace(rows)
        return {"partitions": len(self.version().parts), "rows": count}


def replicate_table(src: DataFrame, target_columns, path: str, keep: int = 2) -> int:
    """Replace a table by the columns it shares with the source; made when missing. The old
    rows stay readable until the new ones are complete; ``read_replica`` reads the latest."""
    columns = intersect_columns(src.columns, list(target_columns) or src.columns)
    table = VersionedTable(src.sparkSession, path)
    rows = table.replace(src.select([col(c) for c in columns]))
    table.expire(keep)
    return rows


def read_replica(spark: SparkSession, path: str) -> DataFrame:
    return VersionedTable(spark, path).read()
