"""Zipped readings files: ``hly<station>.zip`` or ``dly<station>.zip``, each holding one CSV.

Files are listed by name, at any number of locations, and chosen on names alone. Each chosen file is then opened by the
task that reads it. Python unzips, finds the header and cuts the text into lines; Spark splits and types them.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isochron.functions.timekeys import file_time
from isochron.functions.values import DECIMAL_MEASURES, WHOLE_MEASURES, blank_to_zero

# File types in order of preference.
FILE_TYPES = ("hly", "dly")

# Columns of the hourly and daily files where the layout is known beforehand.
HOURLY_COLUMNS = (
    "date", "irain", "rain", "itemp", "temp", "iwetb", "wetb", "dewpt", "vappr", "rhum", "msl",
    "iwdsp", "wdsp", "iwddir", "wddir", "ww", "w", "sun", "vis", "clht", "clamt",
)
DAILY_COLUMNS = ("date", "irain", "rain")
HOURLY_SKIP = 23
DAILY_SKIP = 9

# Measures of the standard layout in which a blank cell reads as 0.
BLANK_IS_ZERO = ("vappr", "rhum", "wddir")

CHUNK = 1 << 20
_CHUNK_SCHEMA = "path string, station int, file_type string, header string, first_line bigint, chunk string"
_CHUNK_TYPES = (pa.string(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.string())
_LINES_SCHEMA = "path string, station int, file_type string, header string, first_line bigint, lines array<string>"
_BLANKS = " \t\r\n\x0b\x0c"
_LEGEND = re.compile(r":\s+-")  # fixed value: a legend line says ``name: - meaning``
_FULL_LINE = re.compile(rf"^[{_BLANKS}]*[^{_BLANKS}]", re.M)


def _is_preamble(line: str) -> bool:
    return not line or line[0].isupper() or _LEGEND.search(line) is not None


def _unzip(known_header: dict[str, tuple[int, str]] | None, max_rows: int | None, chunk: int) -> Callable:
    """``mapInArrow`` function: header and text of each zip, cut at line ends into chunks of some ``chunk`` letters.

    Small files share a batch, which is handed on as soon as it holds ``chunk`` letters.
    """

    def chunks_of(packed: BinaryIO, name: str, file_type: str) -> Iterator[tuple[str, int, str]]:
        with zipfile.ZipFile(packed) as archive, archive.open(f"{name}.csv") as stream:
            text = io.TextIOWrapper(stream, encoding="utf-8")
            if known_header is not None:
                skip, header = known_header[file_type]
                for _ in range(skip + 1):  # the header row follows the skipped lines
                    text.readline()
            else:
                lines = (line.strip(_BLANKS) for line in iter(text.readline, ""))
                header = next((line for line in lines if not _is_preamble(line)), None)
                if header is None:
                    raise ValueError(f"{name}.zip has no header line")
            number, before, rest = 0, "", ""
            while block := text.read(chunk):
                whole, end, rest = (rest + block).rpartition("\n")
                if end:
                    number += len(_FULL_LINE.findall(before))  # only of chunks that another follows
                    before = ""
                    if max_rows is None or number < max_rows:
                        yield header, number, whole
                        before = whole
            if rest:
                number += len(_FULL_LINE.findall(before))
                if max_rows is None or number < max_rows:
                    yield header, number, rest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, letters = [], 0
        for files in batches:
            names = [files.schema.names.index(n) for n in ("path", "station", "file_type")]
            for i in range(files.num_rows):
                path, station, file_type = (files.column(n)[i].as_py() for n in names)
                packed = io.BytesIO(files["content"][i].as_py()) if "content" in files.schema.names else opened(path)
                with packed:
                    for part in chunks_of(packed, f"{file_type}{station}", file_type):
                        held.append((path, station, file_type, *part))
                        letters += len(part[2])
                        if letters >= chunk:
                            yield _batch(held)
                            held, letters = [], 0
        if held:
            yield _batch(held)

    return run


def _unzip_lines(known_header: dict[str, tuple[int, str]] | None, max_rows: int | None, chunk: int) -> Callable:
    """``mapInArrow`` function: as :func:`_unzip`, each chunk as the array of its lines that are not blank, trimmed."""
    unzip = _unzip(known_header, max_rows, chunk)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in unzip(batches):
            cut = pc.split_pattern(batch["chunk"], "\n")
            lines = pc.utf8_trim(cut.flatten(), characters=_BLANKS)
            kept = pc.not_equal(lines, "").to_numpy(zero_copy_only=False)
            starts = cut.offsets.to_numpy()
            before = np.concatenate([[0], np.cumsum(kept)])  # lines kept before each line of the batch
            if max_rows is not None:
                chunk_of = np.repeat(np.arange(len(cut)), np.diff(starts))
                line_no = batch["first_line"].to_numpy()[chunk_of] + before[:-1] - before[starts[:-1]][chunk_of]
                kept &= line_no < max_rows
                before = np.concatenate([[0], np.cumsum(kept)])
            lists = pa.ListArray.from_arrays(pa.array(before[starts], pa.int32()), lines.filter(pa.array(kept)))
            names = [c.split()[0] for c in _LINES_SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], names=names)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _CHUNK_TYPES, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _CHUNK_SCHEMA.split(", ")])


def opened(path: str) -> BinaryIO:
    """A file by its full path, on any file system that Arrow knows (local, HDFS, object stores), for random access."""
    system, name = pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return system.open_input_file(name)


def with_file_facts(files: DataFrame) -> DataFrame:
    """Add ``file_type`` and ``station``, read off the ``<type><station>.zip`` path; both null for other names."""
    name = F.regexp_extract("path", r"(?:^|/)([A-Za-z]+\d+)\.zip$", 1)
    station = F.regexp_extract(name, r"(\d+)$", 1).try_cast("int")
    kind = F.regexp_extract(name, r"^([A-Za-z]+)", 1)
    known = station.isNotNull() & kind.isin(*FILE_TYPES)
    return files.withColumns({"file_type": F.when(known, kind), "station": F.when(known, station)})


def preferred_files(files: DataFrame) -> DataFrame:
    """The one file of each station: at the first location that has any, of the type that comes first in ``FILE_TYPES``.

    The choice is made on names alone; file contents are read for the chosen ones only. Of two files of one station,
    type and location the one whose path sorts first is taken.
    """
    rank = F.array_position(F.array(*map(F.lit, FILE_TYPES)), F.col("file_type"))
    location = F.col("location") if "location" in files.columns else F.lit(0)
    order = [location.alias("location"), rank.alias("rank"), *(F.col(c) for c in ("path",) if c in files.columns)]
    others = [c for c in files.columns if c not in ("station", "path")]
    if "content" in files.columns:
        # With a number: adaptive execution sees how short the zips are, and not how long it takes to read them.
        files = files.repartition(file_tasks(files.sparkSession), "station")
    best = files.groupBy("station").agg(F.min(F.struct(*order, F.struct(*others).alias("file"))).alias("best"))
    names = {"station": F.col("station"), "path": F.col("best.path") if "path" in files.columns else None}
    return best.select(*(names.get(c, F.col(f"best.file.{c}")).alias(c) for c in files.columns))


def list_files(spark: SparkSession, folders: str | Sequence[str]) -> DataFrame:
    """Zipped readings files by name, not opened: ``path, file_type, station, location``.

    ``folders`` are folders or globs in order of preference; ``location`` numbers them from 0. One that does not exist
    has no files, as long as any of them exists. Files of other names are left out; see :func:`unknown_files`.
    """
    return _listed(spark, folders).filter(F.col("station").isNotNull())


def unknown_files(spark: SparkSession, folders: str | Sequence[str]) -> DataFrame:
    """Zips that are no readings files by their name: ``path, location, reason``."""
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    numbered = name.rlike(rf"^(?:{'|'.join(FILE_TYPES)})\d+\.zip$")
    reason = F.when(numbered, "station number is too large").otherwise("neither a type nor a station in the name")
    return _listed(spark, folders).filter(F.col("station").isNull()).select("path", "location", reason.alias("reason"))


def _listed(spark: SparkSession, folders: str | Sequence[str]) -> DataFrame:
    found, absent = [], None
    for location, folder in enumerate([folders] if isinstance(folders, str) else folders):
        try:
            files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(folder)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            absent = missing
            continue
        found.append(files.select("path", F.lit(location).alias("location")))
    if not found:
        raise absent or ValueError("no folder given")
    listed = with_file_facts(reduce(DataFrame.unionByName, found))
    return listed.select("path", "file_type", "station", "location")


def contents(files: DataFrame) -> DataFrame:
    """Listed files with their ``content``, for file systems that only Spark can read.

    The paths pass through the driver, which keeps the listing of every file that Spark reads anyway. Elsewhere give the
    listed files to :func:`file_lines` as they are: each task then opens its own.
    """
    spark = files.sparkSession
    paths = [row.path for row in files.select("path").collect()]
    if not paths:
        return spark.createDataFrame([], "path string, content binary, file_type string, station int")
    return with_file_facts(spark.read.format("binaryFile").load(paths).select("path", "content"))


def file_lines(
    files: DataFrame, fixed_layout: bool = False, max_rows: int | None = None, chunk: int = CHUNK
) -> DataFrame:
    """Data lines of zipped files, with their header; at most ``max_rows`` lines of each file if given.

    The header is the first line that is not preamble (empty, starting in upper case, or a
    ``name: - meaning`` legend line), however far down it stands; a file without one is an error. With
    ``fixed_layout`` the number of lines to skip and the columns are those of the standard files. Files without a
    ``content`` are opened by path, spread over tasks by it: as many as there are shuffle partitions, however short the
    list of paths is. Python unzips, looks for the header and cuts chunks into lines; Spark makes rows of them.

    ``measures`` has ``position``, ``measure`` (its name) and ``series`` of each column: made once a chunk, its lines
    share them.
    """
    known = None
    if fixed_layout:
        known = {"hly": (HOURLY_SKIP, ",".join(HOURLY_COLUMNS)), "dly": (DAILY_SKIP, ",".join(DAILY_COLUMNS))}
    if "content" in files.columns:
        given = files.select("path", "station", "file_type", "content")
    else:
        # With a number: else adaptive execution would see a short list of names and open every file in one task.
        given = files.select("path", "station", "file_type").repartition(file_tasks(files.sparkSession), "path")
    chunks = given.mapInArrow(_unzip_lines(known, max_rows, chunk), _LINES_SCHEMA)
    chunks = chunks.withColumn("measures", _columns(F.col("header"), F.col("station")))
    numbered = chunks.select("*", F.posexplode("lines").alias("nth", "line"))
    line_no = F.col("first_line") + F.col("nth")
    return numbered.select("path", "station", "file_type", "header", "measures", line_no.alias("line_no"), "line")


def file_tasks(spark: SparkSession) -> int:
    """Tasks that open files: never fewer than twice the cores."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)


def _columns(header: Column, station: Column) -> Column:
    """Columns of a header: an ``ind`` column is named ``ind_<the column after it>``, its series ``<name>_<station>``."""
    names = F.split(header, ",")
    named = F.transform(
        names,
        lambda name, i: F.when(name == "ind", F.concat(F.lit("ind_"), F.get(names, i + 1))).otherwise(name),
    )
    return F.transform(
        named,
        lambda name, i: F.struct(
            i.alias("position"), name.alias("measure"), F.concat_ws("_", name, station).alias("series")
        ),
    )


def line_cells(lines: DataFrame) -> DataFrame:
    """One row per cell: ``station, file_type, line_no, ts, position, measure, series,
    raw``.

    ``series`` is ``<measure>_<station>``; blank cells of the numeric measures read as 0. A cell that is not blank
    beyond the header's columns is an error.
    """
    cells, measures = F.col("cells"), F.col("measures")

    def surplus(text: Column) -> Column:
        return F.raise_error(F.concat(F.lit("more cells than the header has: "), text))

    extra = F.slice(cells, F.size(measures) + 1, F.size(cells))
    beyond = (F.size(cells) > F.size(measures)) & (F.trim(F.array_join(extra, "")) != "")
    # Split once, as a column of its own; a line then gives each column of its file one row that takes its cell.
    split = lines.select("station", "file_type", "line_no", "measures", F.split("line", ",", -1).alias("cells"))
    stamped = split.withColumn("ts", file_time(F.trim(F.get(cells, F.lit(0)))))
    named = F.inline(F.when(beyond, surplus(F.array_join(extra, ","))).otherwise(measures))
    rows = stamped.select("station", "file_type", "line_no", "ts", "cells", named)
    raw = F.get(cells, F.col("position"))
    unnamed = F.when(F.trim(raw) != "", surplus(raw).cast("boolean")).otherwise(F.lit(False))
    return rows.filter(F.coalesce(F.col("measure") != "date", unnamed)).select(
        "station",
        "file_type",
        "line_no",
        "ts",
        "position",
        "measure",
        "series",
        blank_to_zero(raw, F.col("measure")).alias("raw"),
    )


def measure_type(measure: str) -> str:
    """Spark type of a measure; indicators are whole numbers."""
    if measure in DECIMAL_MEASURES:
        return "double"
    return "int" if measure in WHOLE_MEASURES or measure.startswith("i") else "string"


def fixed_rows(lines: DataFrame, file_type: str) -> DataFrame:
    """Typed rows of the files of one type in the standard layout: ``station, date, <measures>``.

    Blank cells are 0 in a few measures and missing in the others.
    """
    columns = {"hly": HOURLY_COLUMNS, "dly": DAILY_COLUMNS}[file_type]
    cells = F.col("cells")

    def typed(i: int, name: str) -> Column:
        text = F.trim(F.get(cells, F.lit(i)))
        if name == "date":
            return file_time(text).alias(name)
        # A blank is null without a try: a failing cast to a decimal costs an exception, some 15 us for each cell.
        value = F.when(text != "", text.try_cast(measure_type(name)))
        if name in BLANK_IS_ZERO:
            value = F.when(text == "", F.lit(0).cast(measure_type(name))).otherwise(value)
        return value.alias(name)

    # A column of its own, so that a line is split once and not once for each use of a cell.
    own = lines.filter(F.col("file_type") == file_type).select("station", F.split("line", ",", -1).alias("cells"))
    return own.select("station", *[typed(i, name) for i, name in enumerate(columns)])
