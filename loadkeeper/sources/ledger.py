"""Logs with several writers on plain files: every change of a table is one numbered commit.

A writer puts its rows into a folder of its own and then publishes a small manifest under the next number, which only
one writer can take. Readers see the files that manifests name and nothing else, so an attempt that died leaves nothing
behind but unread files. A commit carries a run id; the same run committed again changes nothing, which
makes appends safe to repeat after a lost driver.

A commit appends rows, or sets columns of the rows with given keys, or both. Settings are written as small files of
their own, sorted by key, and put in while reading: a row shows, for each column, the latest setting made after the row was
written. Once they have grown against the table, ``compact`` writes the table anew.

Manifests are published by a rename that fails on an existing file. Local and Hadoop file systems have one; an object
store needs a connector that offers it.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from loadkeeper.sources.store import conform

VERSION = "_version"
#: The scheme of file systems whose rename replaces an existing file.
LOCAL = "file"


class Conflict(Exception):
    """Another writer took the version that a decision was based on."""


@dataclass(frozen=True)
class File:
    name: str
    folder: str
    bytes: int
    rows: int


@dataclass(frozen=True)
class Commit:
    """What one manifest says. ``covers`` is the version up to which a rewritten table holds everything."""

    version: int
    run: str
    added: tuple[File, ...] = ()
    settings: tuple[File, ...] = ()
    columns: tuple[str, ...] = ()
    base: tuple[File, ...] | None = None
    covers: int = -1
    first_id: int = 1
    next_id: int = 1
    notes: dict = field(default_factory=dict)

    @staticmethod
    def parse(text: str) -> Commit:
        raw = json.loads(text)
        for part in ("added", "settings", "base"):
            raw[part] = None if raw[part] is None else tuple(File(**f) for f in raw[part])
        return Commit(**raw | {"columns": tuple(raw["columns"])})


@dataclass(frozen=True)
class Change:
    """What a transaction wants: rows to append, and settings (key columns and new values) for rows that are there."""

    rows: DataFrame | None = None
    settings: DataFrame | None = None
    order: str | None = None


class Ledger:
    """A table as a series of commits under ``root``.

    ``key`` names the columns settings go by. ``identity`` names a column whose value a row gets from its
    place in the commit, counted on from the commits before; values given for it are not kept.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType, *, key: Sequence[str] = (), identity: str | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.schema = StructType([StructField(f.name, f.dataType) for f in schema.fields])
        self.key, self.identity = list(key), identity
        self.stored = StructType([f for f in self.schema.fields if f.name != identity])
        self._known: dict[int, Commit] = {}

    # ------------------------------------------------------------ manifests

    def _path(self, path: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop

    def commits(self) -> list[Commit]:
        """All commits that still matter, oldest first; only manifests not seen before are read."""
        fs, folder = self._path(f"{self.root}/commits")
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        numbers = sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())
        new = [n for n in numbers if n not in self._known]
        if new:
            texts = self.spark.read.option("wholetext", True).text([self._manifest(n) for n in new]).collect()
            self._known |= {c.version: c for c in map(Commit.parse, (r["value"] for r in texts))}
        # a writer takes a number only when it has seen the ones before, so a gap can only be a listing that is behind
        last = next((i for i, n in enumerate(numbers) if n != i), len(numbers))
        return [self._known[n] for n in numbers[:last]]

    def _manifest(self, version: int) -> str:
        return f"{self.root}/commits/{version:020d}.json"

    def version(self) -> int:
        """The newest version, -1 without any."""
        return len(self.commits()) - 1

    def _publish(self, commit: Commit) -> bool:
        """Writes a manifest under its number; False if another writer has it."""
        target = self._manifest(commit.version)
        fs, draft = self._path(f"{self.root}/drafts/{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(json.dumps(asdict(commit)).encode())
        out.close()
        _, goal = self._path(target)
        fs.mkdirs(goal.getParent())
        try:
            if fs.getUri().getScheme() == LOCAL:
                # a local rename replaces what is there; a second name for the same file does not
                os.link(draft.toUri().getPath(), goal.toUri().getPath())
            else:
                jvm = self.spark._jvm
                none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
                jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.spark._jsc.hadoopConfiguration()).rename(draft, goal, none)
            return True
        except FileExistsError:
            return False
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        finally:
            fs.delete(draft, False)

    # ------------------------------------------------------------ writing

    def _write(self, rows: DataFrame | None) -> tuple[File, ...]:
        """Rows to a new folder; the files as they are there, with sizes and row counts."""
        if rows is None:
            return ()
        folder = f"{self.root}/data/{uuid.uuid4().hex}"
        rows.write.mode("error").parquet(folder)
        written = self.spark.read.schema(rows.schema).parquet(folder)
        counts = {r["file"]: r["n"] for r in written.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("n")).collect()}
        fs, path = self._path(folder)
        sizes = {s.getPath().getName(): s.getLen() for s in fs.listStatus(path)}
        return tuple(File(name, folder.rsplit("/", 1)[1], sizes[name], counts[name]) for name in sorted(counts))

    def _last_setting(self, settings: DataFrame, order: str | None) -> DataFrame:
        """One row for each key, sorted by key: the last by ``order``; without an order rows of a key have to agree."""
        values = [c for c in settings.columns if c not in (*self.key, order)]
        rows = settings.groupBy(*self.key)
        if order is not None:
            last = rows.agg(F.max(F.struct(F.col(order).alias("at"), F.struct(*values).alias("to")))["to"].alias("_to"))
        else:
            clash = F.raise_error(F.lit("settings of one key differ; give their order"))
            to = F.struct(*values)
            last = rows.agg(F.when(F.min(to).eqNullSafe(F.max(to)), F.max(to)).otherwise(clash).alias("_to"))
        kept = last.filter(" AND ".join(f"{k} IS NOT NULL" for k in self.key)).select(*self.key, "_to.*")
        return kept.sortWithinPartitions(*self.key)

    def _commit(self, change: Change, run: str, expected: int | None, notes: dict) -> int:
        columns: tuple[str, ...] = ()
        settings = None
        if change.settings is not None:
            columns = tuple(c for c in change.settings.columns if c not in (*self.key, change.order))
            types = StructType([self.schema[c] for c in (*self.key, *columns)])
            settings = conform(self._last_setting(change.settings, change.order), types)
        parts = {
            "added": self._write(None if change.rows is None else conform(change.rows, self.stored)),
            "settings": self._write(settings), "columns": columns, "notes": notes,
        }
        return self._number(run, parts, expected)

    def _number(self, run: str, parts: dict, expected: int | None = None) -> int:
        """Publishes written files under the next number; others may have come first unless one is expected."""
        while True:
            known = self.commits()
            done = next((c.version for c in known if c.run == run), None)
            if done is not None:
                return done
            if expected is not None and len(known) - 1 != expected:
                raise Conflict(run)
            first = known[-1].next_id if known else 1
            after = first + sum(f.rows for f in parts.get("added", ()))
            if self._publish(Commit(len(known), run, first_id=first, next_id=after, **parts)):
                return len(known)
            if expected is not None:
                raise Conflict(run)

    def _done(self, run: str) -> int | None:
        return next((c.version for c in self.commits() if c.run == run), None)

    def append(self, rows: DataFrame, run: str, notes: dict | None = None) -> int:
        """Adds rows and returns the version; a run that is already in changes nothing."""
        done = self._done(run)
        return self._commit(Change(rows), run, None, notes or {}) if done is None else done

    def set_columns(self, settings: DataFrame, run: str, order: str | None = None, notes: dict | None = None) -> int:
        """Sets columns of the rows that have the given keys now; writes as much as is set, not the table."""
        done = self._done(run)
        return self._commit(Change(None, settings, order), run, None, notes or {}) if done is None else done

    def transact(self, decide: Callable[[DataFrame], Change], run: str, notes: dict | None = None, attempts: int = 100) -> int:
        """Commits what ``decide`` makes of the table as it is; if another writer was first, it decides again."""
        for _ in range(attempts):
            done = self._done(run)
            if done is not None:
                return done
            seen = self.version()
            try:
                return self._commit(decide(self.read(seen)), run, seen, notes or {})
            except Conflict:
                continue
        raise Conflict(f"{run}: other writers were first {attempts} times")

    def compact(self, share: float = 0.25, most: int = 100, fold: Callable[[DataFrame], DataFrame] | None = None) -> int | None:
        """Writes the table anew if settings reach this share of its bytes, or it consists of more commits than ``most``.

        Writers go on meanwhile: what they commit counts on top of the version that was rewritten. ``fold`` sums up rows
        of tables whose readers would sum them anyway.
        """
        upto = self.version()
        base, later = self._since_base(upto)
        held = sum(f.bytes for f in (base.base if base else ())) + sum(f.bytes for c in later for f in c.added)
        set_bytes = sum(f.bytes for c in later for f in c.settings)
        if not later or (set_bytes < share * held and len(later) <= most):
            return None
        rows = self.read(upto)
        return self._number(f"compact-{upto}", {"base": self._write(conform(fold(rows), self.schema) if fold else rows), "covers": upto})

    # ------------------------------------------------------------ reading

    def _since_base(self, version: int | None = None) -> tuple[Commit | None, list[Commit]]:
        known = [c for c in self.commits() if version is None or c.version <= version]
        base = max((c for c in known if c.base is not None), key=lambda c: c.covers, default=None)
        return base, [c for c in known if c.base is None and (base is None or c.version > base.covers)]

    def _files(self, files: Sequence[File], schema: StructType) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/data/{f.folder}/{f.name}" for f in files])

    def _placed(self, parts: Sequence[tuple[Sequence[File], int, int | None, Sequence[str]]], schema: StructType) -> DataFrame:
        """The rows of files with their commit's version, ``_id`` and the columns it sets, looked up by file."""
        rows, all_files = [], []
        for files, version, first, columns in parts:
            at = first
            for f in files:
                rows.append((f.name, version, at, list(columns)))
                all_files.append(f)
                at = None if at is None else at + f.rows
        if not rows:
            names = {VERSION: LongType(), "_id": LongType()}
            return self.spark.createDataFrame([], schema).withColumns({n: F.lit(None).cast(t) for n, t in names.items()} | {"_sets": F.array().cast("array<string>")})
        looked = self.spark.createDataFrame(rows, f"_file string, {VERSION} bigint, _first bigint, _sets array<string>")
        read = self._files(all_files, schema).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
        # the list of files is the driver's own and has a row for each; joined by file, all rows of a file would go to one task
        return read.join(F.broadcast(looked), "_file").withColumn("_id", F.col("_first") + F.col("_row")).drop("_file", "_row", "_first")

    def _settings(self, commits: Sequence[Commit]) -> DataFrame:
        """(key, _to_<column>): for every key and column the latest setting, with its version."""
        placed = self._placed([(c.settings, c.version, None, c.columns) for c in commits], self.schema)
        columns = sorted({x for c in commits for x in c.columns})
        latest = [F.max(F.when(F.array_contains("_sets", c), F.struct(VERSION, F.col(c).alias("to")))).alias(f"_to_{c}") for c in columns]
        return placed.groupBy(*self.key).agg(*latest)

    def read(self, version: int | None = None) -> DataFrame:
        """The table at a version, by default the newest."""
        base, later = self._since_base(version)
        setting = [c for c in later if c.settings]
        parts = [(c.added, c.version, c.first_id, ()) for c in later if c.added]
        plain = not setting and self.identity is None
        if plain:
            return self._files([f for files, *_ in parts for f in files] + list(base.base if base else ()), self.schema)
        out = self._placed(parts, self.stored).drop("_sets")
        if self.identity:
            out = out.withColumn(self.identity, F.col("_id").cast(self.schema[self.identity].dataType))
        out = out.select(*self.schema.names, VERSION)
        if base:
            old = self._files(base.base, self.schema)
            out = out.unionByName(old.select(*self.schema.names, F.lit(base.covers).cast("bigint").alias(VERSION)))
        if not setting:
            return out.select(*self.schema.names)
        found = self._settings(setting)
        changed = {c[len("_to_"):]: F.col(c) for c in found.columns if c.startswith("_to_")}

        def value(name: str) -> Column:
            if name not in changed:
                return F.col(name)
            to = changed[name]
            return F.when(to[VERSION] > F.col(VERSION), to["to"]).otherwise(F.col(name)).alias(name)

        return out.join(found, self.key, "left").select(*[value(n) for n in self.schema.names])

    def added(self, after: int, upto: int) -> DataFrame:
        """The rows appended by commits after one version and up to another, with the commit's version; reads their files only."""
        chosen = [c for c in self.commits() if after < c.version <= upto and c.added]
        return self._placed([(c.added, c.version, c.first_id, ()) for c in chosen], self.stored).drop("_sets", "_id")

    def settings(self, after: int, upto: int) -> DataFrame:
        """The settings committed after one version and up to another, with the commit's version."""
        chosen = [c for c in self.commits() if after < c.version <= upto and c.settings]
        return self._placed([(c.settings, c.version, None, c.columns) for c in chosen], self.schema).drop("_id")
