"""Load ledger: a load's rows become part of a target in two recorded steps.

An append into a table of files is not atomic: a driver lost while the files
are being committed leaves some of them. So a load first writes its rows
below ``<target>/_loads/<load>/rows`` (readers skip names that begin with an
underscore), then records the list of these files, moves them into place and
marks the load done. What a lost driver leaves is told apart by that:

* rows without a record: nothing of the load is in the target; removed;
* a record that is not marked done: some files may be in place. The load is
  undone: every file it lists is removed, then its record;
* a load that is marked done but whose files are not all there is damaged. It
  is undone too, and its record names the sources to load it again from.

:func:`settle` does this before each load, so a load that is repeated finds a
target without any of its rows or with all of them. :func:`unfinished_files`
lets a reader leave out the files of a load that is still being moved. One
writer per target at a time, as in the flow this follows.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDER = "_loads"


class Files:
    """The few file operations needed, on whatever file system ``root`` names."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark._jvm
        self.new_path = self.jvm.org.apache.hadoop.fs.Path         # looked up once, not at every call
        self.root = root.rstrip("/")
        self.fs = self.path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.new_path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def names(self, name: str = "") -> set[str]:
        """Names in a folder; they come over as one text, however many there are."""
        if not self.exists(name):
            return set()
        return {p.rsplit("/", 1)[-1] for p in self._listed(self.fs.listStatus(self.path(name)))}

    def under(self, name: str, depth: int) -> list[str]:
        """Data files ``depth`` folders below a folder, relative to it."""
        found = self._listed(self.fs.globStatus(self.path(f"{name}/{'*/' * depth}part-*")))
        return sorted("/".join(p.split("/")[-1 - depth:]) for p in found)

    def _listed(self, statuses) -> list[str]:
        if statuses is None:
            return []
        paths = self.jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(statuses)
        listed = self.jvm.scala.runtime.ScalaRunTime.stringOf(paths)
        return [p for p in listed.removeprefix("Array(").removesuffix(")").split(", ") if p]

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def move(self, src: str, dst: str) -> None:
        if not self.fs.rename(self.path(src), self.path(dst)):
            raise OSError(f"{self.root}/{src} can't be moved to {dst}")

    def each(self, do, items) -> None:
        """Some calls at a time: they wait for the file system, not for this process."""
        with ThreadPool(8) as pool:
            pool.map(do, list(items))

    def make(self, name: str) -> None:
        self.fs.mkdirs(self.path(name))

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Written aside and renamed: a record is there as a whole or not at all."""
        aside = f"{FOLDER}/.{uuid.uuid4().hex}"
        out = self.fs.create(self.path(aside), True)
        out.write(bytearray(text.encode()))
        out.close()
        self.move(aside, name)


class Damaged(RuntimeError):
    """A finished load that lost files was undone; it has to be loaded again from its sources."""

    def __init__(self, load):
        super().__init__(f"load {load.id} of {', '.join(load.months)} had lost files and was undone; load its sources again")
        self.load = load


@dataclass
class Table:
    """Where a target's files are, and how a catalog table lays them out."""
    root: str
    name: str | None = None
    partition_by: list[str] = field(default_factory=list)
    bucket_by: list[str] = field(default_factory=list)
    sort_by: list[str] = field(default_factory=list)
    buckets: int = 0


def described(spark: SparkSession, target: str) -> Table:
    if "/" in target or ":" in target:
        return Table(target.rstrip("/"))
    rows = [(r[0], r[1]) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {target}").collect()]
    info = dict(rows)
    listed = lambda key: re.findall(r"`([^`]+)`", info.get(key) or "")
    names = [r[0] for r in rows]
    parts = []
    if "# Partition Information" in names:
        for name in names[names.index("# Partition Information") + 2:]:
            if not name or name.startswith("#"):
                break
            parts.append(name)
    return Table(info["Location"].rstrip("/"), target, parts, listed("Bucket Columns"), listed("Sort Columns"), int(info.get("Num Buckets") or 0))


@dataclass
class Load:
    """A recorded load: what it loaded from, its files and the rows it inserted."""
    id: str
    months: list[str]
    about: dict
    files: list[str]
    inserted: dict[str, int]

    def text(self) -> str:
        return json.dumps({"id": self.id, "months": self.months, "about": self.about, "files": self.files, "inserted": self.inserted})


def _id(months: list[str]) -> str:
    return f"{months[0]}_{months[-1]}_{uuid.uuid4().hex[:12]}" if months else f"__{uuid.uuid4().hex[:12]}"


def _staged(load_id: str) -> str:
    return f"{FOLDER}/{load_id}/rows"


def stage(spark: SparkSession, table: Table, rows: DataFrame, load_id: str, partition_by: list[str] | None,
          options: dict[str, str] | None = None) -> list[str]:
    """Step one: write the rows aside, laid out as the target is; their files, relative to the target."""
    path = f"{table.root}/{_staged(load_id)}"
    # nobody reads this folder before it is complete: tasks may commit straight into it
    w = rows.write.format("parquet").mode("overwrite").option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    w = w.options(**(options or {}))
    parts = partition_by or table.partition_by
    if parts:
        w = w.partitionBy(*parts)
    if table.buckets:
        w = w.bucketBy(table.buckets, *table.bucket_by)
        if table.sort_by:
            w = w.sortBy(*table.sort_by)
        aside = f"staged_{uuid.uuid4().hex[:12]}"
        w.option("path", path).saveAsTable(aside)
        spark.sql(f"DROP TABLE {aside}")        # its files stay: the location is named
    else:
        w.save(path)
    return Files(spark, table.root).under(_staged(load_id), len(parts or []))


def publish(spark: SparkSession, table: Table, load: Load) -> None:
    """Step two: record the files, move them into place, mark the load done."""
    files = Files(spark, table.root)
    if load.files:
        files.write(f"{FOLDER}/{load.id}.json", load.text())
        there = files.names()
        folders: dict[str, list[str]] = {}
        for f in load.files:
            folder, _, name = f.rpartition("/")
            folders.setdefault(folder, []).append(name)

        def place(folder: str) -> None:
            if folder and "/" not in folder and folder not in there:        # a new day: the folder moves as one
                files.move(f"{_staged(load.id)}/{folder}", folder)
                return
            if folder and "/" in folder:
                files.make(folder)
            for name in folders[folder]:
                files.move(f"{_staged(load.id)}/{folder}/{name}" if folder else f"{_staged(load.id)}/{name}", f"{folder}/{name}" if folder else name)

        files.each(place, folders)
        if table.name and table.partition_by:
            for lo in range(0, len(folders), 500):
                specs = " ".join(f"PARTITION ({_partition(x)})" for x in list(folders)[lo:lo + 500])
                spark.sql(f"ALTER TABLE {table.name} ADD IF NOT EXISTS {specs}")
        files.write(f"{FOLDER}/{load.id}.done", "")
    if table.name:
        spark.catalog.refreshTable(table.name)
    files.delete(f"{FOLDER}/{load.id}")


def _partition(folder: str) -> str:
    spec = []
    for part in folder.split("/"):
        k, v = part.split("=", 1)
        spec.append(f"{k}=" + ("null" if v == "__HIVE_DEFAULT_PARTITION__" else f"'{v}'"))
    return ", ".join(spec)


def append(spark: SparkSession, target: str, rows: DataFrame, partition_by: list[str] | None, months: list[str], about: dict,
           counted) -> dict[str, int]:
    """Both steps. ``counted()`` gives the rows inserted, once they are written."""
    table = described(spark, target)
    load_id = _id(months)
    files = stage(spark, table, rows, load_id, partition_by)
    inserted = counted()
    publish(spark, table, Load(load_id, months, about, files if any(inserted.values()) else [], inserted))
    return inserted


def loads(spark: SparkSession, target: str) -> list[tuple[Load, bool]]:
    """Recorded loads of a target and whether each is marked done."""
    files = Files(spark, described(spark, target).root)
    names = files.names(FOLDER)
    return [(Load(**json.loads(files.read(f"{FOLDER}/{n}"))), f"{n[:-5]}.done" in names) for n in sorted(names) if n.endswith(".json")]


def _undo(spark: SparkSession, files: Files, load: Load) -> None:
    files.each(files.delete, load.files)
    files.delete(f"{FOLDER}/{load.id}.done")
    files.delete(f"{FOLDER}/{load.id}")
    files.delete(f"{FOLDER}/{load.id}.json")        # last: until then the load can be found and undone again


def settle(spark: SparkSession, target: str, months: list[str]) -> list[Load]:
    """Undo what lost drivers left; the damaged loads (see above) among those that touch ``months``, in order.

    Loads that are not done are always undone. The files of finished loads are
    looked for only where their months overlap the given ones.
    """
    table = described(spark, target)
    files = Files(spark, table.root)
    names = files.names(FOLDER)
    damaged = []
    for n in sorted(names):
        if not n.endswith(".json"):
            continue
        done = f"{n[:-5]}.done" in names
        first, last = n.split("_")[:2]
        if done and months and first and not (first <= months[-1] and months[0] <= last):
            continue
        load = Load(**json.loads(files.read(f"{FOLDER}/{n}")))
        if not done:
            _undo(spark, files, load)
        elif set(load.months) & set(months) and not all(files.exists(f) for f in load.files):
            _undo(spark, files, load)
            damaged.append(load)
    for n in names:
        if not n.endswith((".json", ".done")):          # rows (or a record) that never came to be
            files.delete(f"{FOLDER}/{n}")
    if table.name:
        spark.catalog.refreshTable(table.name)
    return sorted(damaged, key=lambda x: x.months)


def unfinished_files(spark: SparkSession, target: str) -> list[str]:
    """Files of loads that are recorded but not marked done; a reader filters them by ``_metadata.file_name``."""
    return [f.rpartition("/")[2] for load, done in loads(spark, target) if not done for f in load.files]


def finished(spark: SparkSession, target: str, df: DataFrame) -> DataFrame:
    """The rows of ``df`` (a read of the target) that belong to finished loads or to none."""
    names = unfinished_files(spark, target)
    return df.where(~F.col("_metadata.file_name").isin(names)) if names else df


def is_empty(spark: SparkSession, target: str) -> bool:
    """Whether a target holds no file and no partition folder yet."""
    return not any(n[0] not in "_." for n in Files(spark, described(spark, target).root).names())
