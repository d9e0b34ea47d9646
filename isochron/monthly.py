"""Result tables that are upserted month by month, with a manifest of the folders that count.

Below the path of a table lie

* ``data/<write>/../month=<yyyy-MM>``: the files of each write, which are never changed;
* ``manifest/<number>.json``: for every month the folder that holds it, and its columns.

The manifest with the largest number is the table. A write stores its rows, merges them with those of the months they
touch, and puts up the next number; months that it does not touch keep their files. A manifest appears by one rename that
does not replace: of two writers that began with the same number, the second is refused and the table is as the first left
it. So is it after a writer that died. Reading a range opens its months only, and no footers are read for the columns.

The last ``KEEP`` manifests stay, so that readers of the one before are not disturbed; folders that only older ones list
are removed. Files of a writer that died are not listed anywhere and stay until :func:`remove_unlisted` is called.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from isochron.functions.timekeys import month_of

KEEP = 2
MONTH = "month"
NO_MONTH = "none"


class Part(NamedTuple):
    """A month's folder, relative to the table, and its columns as Spark's JSON schema."""

    folder: str
    columns: dict


class Manifest(NamedTuple):
    number: int
    parts: dict[str, Part]


class ConcurrentWrite(RuntimeError):
    """Another writer has changed the table since this one read it."""


class Files:
    """The few operations on whole files that Spark's readers and writers do not offer."""

    def __init__(self, spark: SparkSession, path: str):
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._gateway = spark._sc._gateway
        self._fs = self._path(path).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._hadoop.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return [status.getPath().getName() for status in self._fs.listStatus(self._path(path))]

    def write_new(self, path: str, text: str) -> None:
        """A whole file that appears at once; ``FileExistsError`` if there is one already."""
        folder, name = path.rsplit("/", 1)
        draft = f"{folder}/.{uuid.uuid4().hex}.{name}"  # readers pass over names that begin so
        stream = self._fs.create(self._path(draft), False)
        stream.write(text.encode("utf-8"))
        stream.close()
        context = self._hadoop.FileContext.getFileContext(self._path(path).makeQualified(self._fs.getUri(), self._fs.getWorkingDirectory()).toUri(), self._conf)
        keep = self._gateway.new_array(getattr(self._hadoop, "Options$Rename"), 0)
        try:
            context.rename(self._path(draft), self._path(path), keep)
        except Exception as refused:
            self.remove(draft)
            if self.exists(path):
                raise FileExistsError(path) from refused
            raise

    def move(self, path: str, to: str) -> None:
        if not self._fs.rename(self._path(path), self._path(to)):
            raise OSError(f"cannot move {path} to {to}")

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


def _numbers(files: Files, path: str) -> list[int]:
    names = (n.removesuffix(".json") for n in files.names(f"{path}/manifest"))
    return sorted(int(n) for n in names if n.isdigit())


def _load(spark: SparkSession, path: str, number: int) -> Manifest:
    text = spark.read.text(f"{path}/manifest/{number}.json", wholetext=True).first()["value"]
    return Manifest(number, {month: Part(*part) for month, part in json.loads(text).items()})


def manifest(spark: SparkSession, path: str) -> Manifest | None:
    """The manifest that counts, or ``None`` where there is no table."""
    path = path.rstrip("/")
    numbers = _numbers(Files(spark, path), path)
    return _load(spark, path, numbers[-1]) if numbers else None


def _columns(parts: Iterable[Part]) -> StructType:
    """The columns of all parts, in the order in which they first appear."""
    found = StructType()
    for part in parts:
        for field in StructType.fromJson(part.columns):
            if field.name not in found.names:
                found.add(field.name, field.dataType, True)
            elif found[field.name].dataType != field.dataType:
                raise TypeError(f"column {field.name} is {found[field.name].dataType} in one month and {field.dataType} in another")
    return found


def read(spark: SparkSession, path: str, start: str | None = None, stop: str | None = None) -> DataFrame | None:
    """The table, or ``None`` where there is none.

    With ``start`` and ``stop`` (``yyyy-MM..``) only the months between them are opened, both included; rows are not
    filtered further. A column that a month does not have is null there.
    """
    current = manifest(spark, path)
    return _read(spark, path.rstrip("/"), current, current.parts, start, stop) if current else None


def _read(
    spark: SparkSession, path: str, current: Manifest, months: Iterable[str], start: str | None = None, stop: str | None = None
) -> DataFrame:
    schema = _columns(part for _, part in sorted(current.parts.items()))
    wanted = [m for m in sorted(months) if m == NO_MONTH or (not start or m >= start[:7]) and (not stop or m <= stop[:7])]
    if not wanted:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{current.parts[m].folder}" for m in wanted])


def _store(df: DataFrame, folder: str, sort: Sequence[str]) -> None:
    """Write rows with their ``month``: whole files of a good size for each, one too large being split."""
    laid_out = df.hint("rebalance", F.col(MONTH)).sortWithinPartitions(MONTH, *sort)
    laid_out.write.partitionBy(MONTH).parquet(folder)


def upsert(
    df: DataFrame,
    path: str,
    merge: Callable[[DataFrame, DataFrame], DataFrame],
    by: str | None,
    sort: Sequence[str] = (),
) -> DataFrame:
    """Merge ``df`` into the table at ``path`` by ``merge(old, new)``, month by month of the time column ``by``.

    Without a time column, or where it is null, rows belong to one part of their own. ``df`` is computed once.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    if MONTH in df.columns:
        raise ValueError(f"a stored table has a {MONTH} of its own; rename that column")
    files = Files(spark, path)
    current = manifest(spark, path) or Manifest(0, {})
    _columns([*current.parts.values(), Part("", df.schema.jsonValue())])  # types that do not agree are an error now
    write = f"data/{uuid.uuid4().hex}"
    month: Column = F.when(F.col(by).isNotNull(), month_of(F.col(by))).otherwise(F.lit(NO_MONTH)) if by else F.lit(NO_MONTH)
    _store(df.withColumn(MONTH, month), f"{path}/{write}/new", sort)
    months = [n.removeprefix(f"{MONTH}=") for n in files.names(f"{path}/{write}/new") if n.startswith(f"{MONTH}=")]
    parts = dict(current.parts)
    parts.update({m: Part(f"{write}/new/{MONTH}={m}", df.schema.jsonValue()) for m in months})
    touched = [m for m in months if m in current.parts]
    if touched:
        new = spark.read.schema(df.schema).parquet(*[f"{path}/{parts[m].folder}" for m in touched])
        merged = merge(_read(spark, path, current, touched), new)
        # a month's rows stay in it, since the merge keeps the time column
        _store(merged.withColumn(MONTH, month), f"{path}/{write}/merged", sort)
        parts.update({m: Part(f"{write}/merged/{MONTH}={m}", merged.schema.jsonValue()) for m in touched})
    if not parts:  # an empty table has its columns, too
        parts[NO_MONTH] = Part(f"{write}/new", df.schema.jsonValue())
    following = Manifest(current.number + 1, parts)
    try:
        files.write_new(f"{path}/manifest/{following.number}.json", json.dumps(parts))
    except FileExistsError as taken:
        files.remove(f"{path}/{write}")
        raise ConcurrentWrite(f"another writer has changed {path}; nothing was written") from taken
    for m in touched:
        files.remove(f"{path}/{write}/new/{MONTH}={m}")
    _remove_old(spark, files, path)
    return _read(spark, path, following, following.parts)


def _remove_old(spark: SparkSession, files: Files, path: str) -> None:
    """Manifests but the last ``KEEP``, and the folders that only they list."""
    numbers = _numbers(files, path)
    old, kept = numbers[:-KEEP], numbers[-KEEP:]
    if not old:
        return
    listed = {part.folder for n in kept for part in _load(spark, path, n).parts.values()}
    for n in old:
        for part in _load(spark, path, n).parts.values():
            if part.folder not in listed:
                files.remove(f"{path}/{part.folder}")
        files.remove(f"{path}/manifest/{n}.json")


def remove_unlisted(spark: SparkSession, path: str) -> list[str]:
    """Remove what writers that died have left; call it while nobody writes. Gives the names of these writes."""
    path = path.rstrip("/")
    files = Files(spark, path)
    listed = {part.folder.split("/")[1] for n in _numbers(files, path) for part in _load(spark, path, n).parts.values()}
    found = [name for name in files.names(f"{path}/data") if name not in listed]
    for name in found:
        files.remove(f"{path}/data/{name}")
    return found
