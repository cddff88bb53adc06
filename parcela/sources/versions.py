"""Stored tables whose files are named by a version, so that rows can leave them for good.

A table is a folder with ``data`` and ``_versions``.  Files of ``data`` are never changed.  A version is a small table of
the files that belong to it, with the part (month, bucket) each one holds.  New files are written first, as a stage no
version knows; renaming the folder of the new version makes them count, all at once.  A run that ends before leaves the
table as it was.  :meth:`StoredTable.vacuum` removes files that the current version does not name.

Beside each stage stands its index of subjects: (hash of the key, file).  It finds the files that hold a person without
reading the others.  One writer at a time; a second one that commits the same version fails.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from functools import cached_property
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcela.sources.storage import Folder

PART = "_part"
FILE, SCHEMA, NOTE = "file", "schema", "note"
_ENTRY = "kind STRING, part STRING, name STRING, n LONG"
Entry = tuple[str, str, str, int]
BUCKETS = 16


class StoredTable:
    """``keys``: the columns by which subjects are looked up, each alone."""

    def __init__(self, spark: SparkSession, path: str, keys: Iterable[str] = ()):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), tuple(keys)
        self._read: dict[int, list[Entry]] = {}  # versions never change

    # -- versions ----------------------------------------------------------------------------------

    @property
    def version(self) -> int:
        """Number of the current version, 0 for a table that is not there."""
        names = Folder(self.spark, f"{self.path}/_versions").names()
        return max((int(n[1:]) for n in names if n.startswith("v")), default=0)

    def entries(self, version: int | None = None) -> list[Entry]:
        """(kind, part, name, rows) of a version; one entry per file, as many as Spark lists when it reads them."""
        version = self.version if version is None else version
        if not version:
            return []
        if version not in self._read:
            rows = self.spark.read.schema(_ENTRY).json(f"{self.path}/_versions/v{version:08d}")
            self._read = {version: [tuple(r) for r in rows.select("kind", "part", "name", "n").collect()]}
        return self._read[version]

    def files(self) -> dict[str, str]:
        """Part of each file."""
        return {name: part for kind, part, name, _ in self.entries() if kind == FILE}

    def notes(self) -> set[str]:
        return {name for kind, _, name, _ in self.entries() if kind == NOTE}

    def commit(self, based_on: int, remove: Iterable[str] = (), add: dict[str, tuple[str, int]] | None = None,
               schema: T.StructType | None = None, notes: Iterable[str] = (), forget: bool = False) -> int:
        """A new version: files taken out, files put in, notes added (``forget``: the old ones go)."""
        old, gone = self.entries(based_on), set(remove)
        rows = [e for e in old if not (e[0] == FILE and e[2] in gone) and not (forget and e[0] != FILE)]
        rows += [(FILE, part, name, n) for name, (part, n) in (add or {}).items()]
        if schema is not None and not any(e[0] == SCHEMA for e in rows):
            rows.append((SCHEMA, "", schema.json(), 0))
        rows += [(NOTE, "", n, 0) for n in notes]
        staged = f"{self.path}/_versions/_new-{uuid.uuid4().hex}"
        self.spark.createDataFrame(rows, _ENTRY).coalesce(1).write.json(staged)
        if not Folder(self.spark, staged).rename(f"{self.path}/_versions/v{based_on + 1:08d}"):
            raise RuntimeError(f"version {based_on + 1} of {self.path} is there already")
        self.__dict__.pop("schema", None)
        return based_on + 1

    def vacuum(self) -> int:
        """Remove what the current version does not name; the number of removed files."""
        current = set(self.files())
        plain = {_plain(f) for f in current}
        stale = [f for f in Folder(self.spark, f"{self.path}/data").files() if _plain(f) not in plain]
        for name in stale:
            Folder(self.spark, name).remove()
        for name in Folder(self.spark, f"{self.path}/_versions").names():
            if name.startswith("_new-") or name.startswith("v") and int(name[1:]) < self.version:
                Folder(self.spark, f"{self.path}/_versions/{name}").remove()
        used = {f.split("/data/", 1)[1].split("/", 1)[0] for f in current}
        for key in self.keys:  # hashes of erased persons go as well once their stage has no file left
            for name in Folder(self.spark, f"{self.path}/_subjects/{key}").names():
                if name[6:] not in used:
                    Folder(self.spark, f"{self.path}/_subjects/{key}/{name}").remove()
        return len(stale)

    # -- rows --------------------------------------------------------------------------------------

    @cached_property
    def schema(self) -> T.StructType | None:
        found = [name for kind, _, name, _ in self.entries() if kind == SCHEMA]
        return T._parse_datatype_json_string(found[0]) if found else None

    def read(self, files: Iterable[str] | None = None) -> DataFrame:
        """Rows of the current version, or of some of its files."""
        files = sorted(self.files() if files is None else files)
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*files)

    def count(self, files: Iterable[str] | None = None) -> int:
        """Rows of the current version or of some of its files, without reading them."""
        wanted = None if files is None else set(files)
        return sum(n for kind, _, name, n in self.entries() if kind == FILE and (wanted is None or name in wanted))

    def stage(self, rows: DataFrame, part: Column | None = None) -> dict[str, tuple[str, int]]:
        """Write rows as files that no version knows yet: part and rows of each.  Rows may bring their part along."""
        name = uuid.uuid4().hex
        folder = f"{self.path}/data/{name}"
        rows = rows if part is None else rows.withColumn(PART, part)
        # rows of a part come together, large parts are split: few files, and no part in one task
        rows.hint("rebalance", PART).write.partitionBy(PART).parquet(folder)
        written = self.spark.read.schema(rows.schema).option("recursiveFileLookup", True).parquet(folder)
        file = F.col("_metadata.file_path").alias("file")
        counts = written.groupBy(file).count().collect()  # one row per file
        for key in self.keys if counts else ():
            hashed = written.where(F.col(key).isNotNull()).select(F.xxhash64(key).alias("h"), file).distinct()
            hashed.withColumn("bucket", F.pmod("h", F.lit(BUCKETS))).hint("rebalance", "bucket").write.partitionBy("bucket").parquet(
                f"{self.path}/_subjects/{key}/stage={name}")
        return {r["file"]: (_part_of(r["file"]), r["count"]) for r in counts}

    def append(self, rows: DataFrame, part: Column, notes: Iterable[str] = ()) -> int:
        version = self.version
        return self.commit(version, add=self.stage(rows, part), schema=rows.schema, notes=notes)

    # -- subjects ----------------------------------------------------------------------------------

    def files_with(self, subjects: DataFrame, key: str) -> list[str]:
        """Files of the current version that may hold one of the subjects; only index buckets of their hashes are read."""
        root = Folder(self.spark, f"{self.path}/_subjects/{key}")
        current = {_plain(f): f for f in self.files()}
        used = {f.split("/data/", 1)[1].split("/", 1)[0] for f in current}
        stages = [n[6:] for n in root.names() if n[6:] in used]
        if not stages:
            return []
        asked = subjects.where(F.col(key).isNotNull()).select(F.xxhash64(key).alias("h")).distinct()
        asked = asked.withColumn("bucket", F.pmod("h", F.lit(BUCKETS)))
        index = self.spark.read.schema("h LONG, file STRING, bucket LONG").option("basePath", root.path)
        index = index.parquet(*[f"{root.path}/stage={s}" for s in stages])
        found = index.join(asked, ["bucket", "h"], "left_semi").select("file").distinct()
        return sorted(current[f] for f in (_plain(r["file"]) for r in found.collect()) if f in current)


def _plain(name: str) -> str:
    """A file name without the differences in how its scheme is written."""
    scheme, _, rest = unquote(name).partition(":")
    return f"{scheme}:/{rest.lstrip('/')}" if rest else name


def _part_of(name: str) -> str:
    """The part in a file's path; the null part is empty."""
    value = name.rsplit(f"/{PART}=", 1)[1].split("/", 1)[0]
    return "" if value == "__HIVE_DEFAULT_PARTITION__" else value


def month_of(date: str | Column) -> Column:
    """Label of a part: the month of a date, which sorts as the dates do."""
    return F.date_format(F.col(date) if isinstance(date, str) else date, "yyyy-MM")


def day_of(date: str | Column) -> Column:
    return F.date_format(F.col(date) if isinstance(date, str) else date, "yyyy-MM-dd")


COUNTS = "avant LONG, apres LONG, supprimes LONG, fichiers_retires INT, fichiers_recrits INT, fichiers_intacts INT"


def _purged(table: StoredTable, cutoff: str, kept_of_border) -> DataFrame:
    """Whole months (or days) before the cutoff leave unread, that of the cutoff is written anew, other files stay."""
    version, files = table.version, table.files()
    edge = cutoff[:max(map(len, files.values()), default=7)]
    old = [f for f, part in files.items() if part and part < edge]
    border = [f for f, part in files.items() if part == edge]
    rest = [f for f in files if f not in {*old, *border}]
    added = table.stage(kept_of_border(table.read(border)), F.lit(edge)) if border else {}
    before = table.count()
    table.commit(version, remove=[*old, *border], add=added)
    table.vacuum()
    after = table.count()
    return table.spark.createDataFrame([(before, after, before - after, len(old), len(border), len(rest))], COUNTS)


def purge_before(table: StoredTable, date: str, cutoff: str) -> DataFrame:
    """Take rows older than the cutoff out of a table whose parts are months or days; rows without a date stay."""
    return _purged(table, cutoff, lambda rows: rows.where((F.col(date) >= F.lit(cutoff).cast("timestamp")) | F.col(date).isNull()))


def purge_children(table: StoredTable, key: str, parents: DataFrame, cutoff: str) -> DataFrame:
    """The same for a child table whose parts are the months of its parents; in the month of the cutoff the
    children of parents that are left stay."""
    return _purged(table, cutoff, lambda rows: rows.join(parents.select(key).distinct(), key, "left_semi"))


def rewrite_subjects(
    table: StoredTable, subjects: DataFrame, key: str, change: Callable[[DataFrame], DataFrame]
) -> tuple[int, int, int]:
    """Write the files that hold one of the subjects anew, their rows changed: files written, files left, rows gone.

    Rows keep their part.  The old files are removed once the new version counts.
    """
    version, files = table.version, table.files()
    held = table.files_with(subjects, key)
    if not held:
        return 0, len(files), 0
    rows = table.read(held)
    part = F.regexp_extract(F.col("_metadata.file_path"), f"/{PART}=([^/]*)/", 1)
    added = table.stage(change(rows.withColumn(PART, F.nullif(part, F.lit("__HIVE_DEFAULT_PARTITION__")))))
    before = table.count()
    table.commit(version, remove=held, add=added)
    table.vacuum()
    return len(held), len(files) - len(held), before - table.count()
