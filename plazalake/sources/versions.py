"""A table in versions: a commit writes only the partitions that it touches, then moves a pointer.

    <root>/data/_commit=<id>/<column>=<value>/part-...   files of one commit, never changed afterwards
    <root>/versions/<number>                             which commit holds each partition, as JSON

The newest file in ``versions`` is the pointer. It comes into being by a rename that fails if another
writer was first, so readers see the old version or the new one. A job that dies before the rename leaves
files that no version names, which ``vacuum`` deletes. Commits of a stream carry its name and epoch: a batch
that is run again after its commit changes nothing.

The listing of versions and the partitions of one version go through the driver: both are as
many as partitions and kept versions, not rows. The store must rename without overwriting (HDFS and
local disks do).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plazalake.operators.load import upsert

_COMMIT = "_commit"


class Conflict(RuntimeError):
    """Another writer made this version first; read again and retry."""


@dataclass(frozen=True)
class Version:
    number: int = -1
    schema: dict | None = None
    partitions: dict[str, str] = field(default_factory=dict)
    """Folder of a partition, by name (``column=value``): the commit that holds it."""
    epochs: dict[str, int] = field(default_factory=dict)
    """The last epoch of each stream that has written here."""


class VersionedTable:
    """A table at ``root``, partitioned by one column of few values, which is part of every key."""

    def __init__(self, spark: SparkSession, root: str, partition: str):
        self.spark, self.root, self.partition = spark, root.rstrip("/"), partition
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    # pointer

    def _path(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))

    def _files(self):
        return self._path().getFileSystem(self._conf)

    def _names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return [s.getPath().getName() for s in self._files().listStatus(path)] if self._files().exists(path) else []

    def numbers(self) -> list[int]:
        return sorted(int(n) for n in self._names("versions") if n.isdigit())

    def version(self, number: int | None = None) -> Version:
        """The version of that number, else the newest; before the first commit an empty one."""
        if number is None:
            numbers = self.numbers()
            if not numbers:
                return Version()
            number = numbers[-1]
        stream = self._files().open(self._path("versions", f"{number:012d}"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Version(**json.loads(text))

    def _switch(self, version: Version) -> None:
        """Make ``version`` the newest one, in one step."""
        draft, target = self._path("versions", f".{uuid.uuid4().hex}"), self._path("versions", f"{version.number:012d}")
        stream = self._files().create(draft)
        try:
            stream.write(bytearray(json.dumps(vars(version)).encode()))
        finally:
            stream.close()
        options = self._jvm.org.apache.hadoop.fs.Options
        kind = getattr(options, "Rename")
        none = self.spark.sparkContext._gateway.new_array(kind, 1)
        none[0] = kind.NONE
        try:
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self._conf).rename(draft, target, none)
        except Exception as error:
            self._files().delete(draft, False)
            if "FileAlreadyExists" in str(error):
                raise Conflict(f"version {version.number} of {self.root} was written by another") from error
            raise

    # reading

    def read(self, number: int | None = None) -> DataFrame:
        """The rows of a version. A filter on the partition column reads only its folders."""
        version = self.version(number)
        if version.schema is None:
            raise FileNotFoundError(f"no version at {self.root}")
        return self._read(version, sorted(version.partitions))

    def _read(self, version: Version, names: Sequence[str]) -> DataFrame:
        schema = StructType.fromJson(version.schema)
        if not names:
            return self.spark.createDataFrame([], schema)
        folders = [f"{self.root}/data/{version.partitions[n]}/{n}" for n in names]
        found = self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(*folders)
        return found.select(*schema.fieldNames())

    # writing

    def replace(self, rows: DataFrame, touched: Sequence[str] | None = None, stream: str | None = None, epoch: int | None = None, base: Version | None = None) -> Version:
        """A new version in which the partitions of ``rows`` hold these rows only; others stay as they are.
        Of ``touched`` (names as in a version) those without rows become empty. With ``stream`` and
        ``epoch`` the version is made once: if that epoch, or a later one, is in, the current one comes back."""
        base = base or self.version()
        if stream is not None and base.epochs.get(stream, -1) >= epoch:
            return base
        commit = f"{_COMMIT}={uuid.uuid4().hex}"
        rows.write.partitionBy(self.partition).parquet(f"{self.root}/data/{commit}")
        written = [n for n in self._names(f"data/{commit}") if n.startswith(f"{self.partition}=")]
        kept = {n: c for n, c in base.partitions.items() if n not in set(touched or ())}
        epochs = base.epochs | ({stream: epoch} if stream is not None else {})
        schema = base.schema or json.loads(rows.schema.json())
        made = Version(base.number + 1, schema, kept | {n: commit for n in written}, epochs)
        self._switch(made)
        return made

    def upsert(self, new: DataFrame, keys: Sequence[str], keep_if_null: Sequence[str] = (), newest: str | None = None, stream: str | None = None, epoch: int | None = None) -> Version:
        """A new version with rows of ``new`` inserted or written over (see ``load.upsert``; keys unique
        on each side). Only partitions that ``new`` touches are read and written. The first commit
        takes ``new`` as the table."""
        if self.partition not in keys:
            raise ValueError(f"{self.partition} must be one of the keys")
        base = self.version()
        if stream is not None and base.epochs.get(stream, -1) >= epoch:
            return base
        if base.schema is None:
            return self.replace(new, stream=stream, epoch=epoch, base=base)
        columns = StructType.fromJson(base.schema).fieldNames()
        values = [r[0] for r in new.select(self.partition).distinct().collect()]  # as many as partitions
        # the folder names of these values, as Spark writes them
        theirs = self._read(base, sorted(base.partitions)).filter(F.col(self.partition).isin([v for v in values if v is not None]) | (F.lit(None in values) & F.col(self.partition).isNull()))
        merged = _null_safe_upsert(theirs, new.select(*columns), list(keys), keep_if_null, newest)
        return self.replace(merged, stream=stream, epoch=epoch, base=base)

    def vacuum(self, keep: int = 10) -> list[str]:
        """Delete all but the last ``keep`` versions, and commits that none of them names, such as those of
        writers that died. Not while a writer is at work: its files are not named yet."""
        numbers = self.numbers()
        for number in numbers[:-keep]:
            self._files().delete(self._path("versions", f"{number:012d}"), False)
        named = {c for n in numbers[-keep:] for c in self.version(n).partitions.values()}
        gone = [c for c in self._names("data") if c.startswith(f"{_COMMIT}=") and c not in named]
        for commit in gone:
            self._files().delete(self._path("data", commit), True)
        return gone


def _null_safe_upsert(base: DataFrame, new: DataFrame, keys: list[str], keep_if_null: Sequence[str], newest: str | None) -> DataFrame:
    """``upsert`` in which null keys are equal to one another: flags beside the keys tell them from others."""
    flags = [f"_null_{k}" for k in keys]

    def flagged(df: DataFrame) -> DataFrame:
        kinds = dict(df.dtypes)
        blank = {k: F.coalesce(F.col(k), F.lit("" if kinds[k] == "string" else 0).cast(kinds[k])) for k in keys}
        return df.withColumns({f: F.col(k).isNull() for f, k in zip(flags, keys)}).withColumns(blank)

    merged = upsert(flagged(base), flagged(new), keys + flags, keep_if_null, newest)
    back = {k: F.when(~F.col(f), F.col(k)) for f, k in zip(flags, keys)}
    return merged.withColumns(back).select(*base.columns)
