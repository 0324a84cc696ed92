"""CSV and parquet scans with row and column limits."""

from __future__ import annotations

import csv
import math
import random
from bisect import bisect_right
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colweave.operators.narrow import TYPE_WIDTHS
from colweave.operators.order import row_prefix
from colweave.operators.project import pick_present
from colweave.schema import DEFAULT_ROLES, KEY, MISSING_TEXTS, Roles, col, one_missing, prefix_schema

# Sampled rows of an estimate, fast-mode rows, cell budget, safety factor.
ESTIMATE_ROWS = 200
FAST_ROWS = 1000
CELL_BUDGET = 10**7
ESTIMATE_SAFETY = 0.8
# Byte ranges of an estimate, and the bytes of each: 4 MB in all.
ESTIMATE_RANGES = 64
ESTIMATE_WIDTH = 1 << 16
# Files whose first line is read at the same time.
HEADER_READERS = 16


def all_rows(limit: int | str | None) -> bool:
    """A limit of -1, '' or None means the whole table."""
    return limit is None or limit == "" or int(limit) == -1


def _headers(spark: SparkSession, path: str, sep: str) -> dict[tuple[str, ...], list[str]]:
    """Header -> files that have it. One line of every file is read, many files at a time."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path").collect()
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first_line(name: str) -> tuple[str, ...]:
        file = jvm.org.apache.hadoop.fs.Path(name)
        stream, codec = file.getFileSystem(conf).open(file), codecs.getCodec(file)
        reader = jvm.java.io.BufferedReader(
            jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8")
        )
        line = reader.readLine()
        reader.close()
        return tuple(next(csv.reader([line.lstrip("\ufeff")], delimiter=sep))) if line else ()

    names = sorted(r.path for r in listed)
    with ThreadPoolExecutor(HEADER_READERS) as pool:
        heads = list(pool.map(first_line, names))
    found: dict[tuple[str, ...], list[str]] = {}
    for name, head in zip(names, heads, strict=True):
        if head:
            found.setdefault(head, []).append(name)
    return found


def _as_text(spark: SparkSession, path: str, sep: str, multi_line: bool) -> DataFrame:
    """All cells as text, columns by name whatever their place in each file. A record that does not fit its header fails."""
    reader = spark.read.option("header", True).option("sep", sep).option("escape", '"').option("multiLine", multi_line)
    parts = []
    for head, files in _headers(spark, path, sep).items():
        schema = T.StructType([T.StructField(name, T.StringType()) for name in head])
        parts.append(reader.schema(schema).option("mode", "FAILFAST").csv(files))
    if not parts:
        raise ValueError(f"no file with a header under {path}")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def _given(name: str) -> Column:
    """Null for a missing-value text."""
    return F.when(~col(name).isin(MISSING_TEXTS), col(name))


def scan_csv(
    spark: SparkSession, path: str, limit: int | str | None = None, columns: Sequence[str] | None = None,
    roles: Roles = DEFAULT_ROLES, sep: str = ",", multi_line: bool = False, bad: str = "fail",
) -> DataFrame:
    """CSV with header; types follow from the column names, so no inference pass runs.

    Columns go by the header of each file; a column that a file lacks is null
    there. ``multi_line`` allows line breaks in quotes, at the price that a file
    cannot be split; without it such a record fails. A cell that is neither a
    missing-value text nor of its column's type fails the job, or is missing with
    ``bad="null"`` (``bad_cells`` counts them). ``limit`` keeps the first rows by key, ``columns`` those that exist.
    """
    text = _as_text(spark, path, sep, multi_line)
    typed = []
    for field in prefix_schema(text.columns, roles).fields:
        given = _given(field.name)
        if not isinstance(field.dataType, T.StringType):
            kind = field.dataType.simpleString()
            value = F.trim(given).try_cast(kind)
            if bad == "fail":
                wrong = F.raise_error(F.concat(F.lit(f"not a {kind} in {field.name}: "), given)).cast(kind)
                value = F.when(given.isNotNull(), F.coalesce(value, wrong))
            given = value
        typed.append(given.alias(field.name))
    return limited(one_missing(text.select(*typed)), limit, columns)


def bad_cells(
    spark: SparkSession, path: str, roles: Roles = DEFAULT_ROLES, sep: str = ",", multi_line: bool = False
) -> DataFrame:
    """(column, bad): cells of each typed column that are neither missing nor of its type."""
    text = _as_text(spark, path, sep, multi_line)
    typed = [f for f in prefix_schema(text.columns, roles).fields if not isinstance(f.dataType, T.StringType)]
    counts = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.count_if(_given(f.name).isNotNull() & F.trim(col(f.name)).try_cast(f.dataType.simpleString()).isNull()).alias("bad"),
        )
        for f in typed
    ]
    return text.agg(F.array(*counts).alias("cells")).select(F.inline("cells"))


def limited(df: DataFrame, limit: int | str | None = None, columns: Sequence[str] | None = None, key: str = KEY) -> DataFrame:
    """Row- and column-limited view of any table."""
    if not all_rows(limit):
        df = row_prefix(df, int(limit), key)
    return df if columns is None else pick_present(df, columns)


def file_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under a path: a listing, no file content is read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    return listed.agg(F.sum("length")).first()[0] or 0


@dataclass(frozen=True)
class _Cell:
    """Line breaks and cell texts of some bytes that stand for ``stands_for`` bytes of the table."""

    stands_for: float
    read: int
    breaks: int
    line_bytes: int
    text_bytes: int


def _text_bytes(lines: Sequence[str], texts: Sequence[bool], sep: str) -> int:
    """Bytes of the cells of text columns."""
    rows = csv.reader(lines, delimiter=sep)
    return sum(len(cell.encode()) for cells in rows for cell, is_text in zip(cells, texts, strict=False) if is_text)


def _read_cell(spark: SparkSession, file: str, start: int, width: int, stands_for: float, texts: Sequence[bool], sep: str) -> _Cell:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    name = jvm.org.apache.hadoop.fs.Path(file)
    stream = name.getFileSystem(conf).open(name)
    stream.seek(start)
    raw = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, width))
    stream.close()
    # The first line is whole only at the start of a file, where it is the header; the last one has no end here.
    whole = raw[raw.find(b"\n") + 1 : raw.rfind(b"\n") + 1]
    held = _text_bytes(whole.decode("utf-8", "replace").splitlines(), texts, sep)
    unbroken = int(width == stands_for and bool(raw) and not raw.endswith(b"\n"))  # the last line of a file that is read whole
    return _Cell(stands_for, len(raw), raw.count(b"\n") + unbroken, len(whole), held)


def estimate(
    spark: SparkSession, path: str, ranges: int = ESTIMATE_RANGES, width: int = ESTIMATE_WIDTH, sep: str = ",", seed: int = 0
) -> DataFrame:
    """(rows, rows_error, row_size, total_size) of CSV files from byte ranges drawn over all of them.

    The bytes of all files in a row are cut into ``ranges`` equal strata, and ``width`` bytes are read at a random
    place of each (all bytes where that is less). Every byte is as likely to be read as any other, so line breaks
    per byte are those of the whole table wherever its long lines stand. ``rows_error`` is the standard error of ``rows``,
    from the differences of neighbouring strata; 0 if everything was read. Headers do not count as rows; a line
    break in quotes counts as one. Compressed files cannot be entered in the middle: their lines are counted by a scan.
    ``total_size`` is the size in memory: other types by their width, text by its share of the bytes of the lines read
    (if all files are compressed, of the first lines of one). An empty file or folder gives zeros.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).where("length > 0")
    found = sorted((r["path"], r["length"]) for r in listed.select("path", "length").collect())
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    packed = [f for f, _ in found if codecs.getCodec(jvm.org.apache.hadoop.fs.Path(f)) is not None]
    files = [(f, n) for f, n in found if f not in set(packed)]
    heads = _headers(spark, path, sep)
    head = max(heads, key=lambda h: len(heads[h])) if heads else ()
    types = [f.dataType.simpleString() for f in prefix_schema(list(head)).fields]
    fixed, texts = sum(TYPE_WIDTHS.get(t, 8) for t in types if t != "string"), [t == "string" for t in types]

    size = sum(n for _, n in files)
    ends = list(accumulate(n for _, n in files))
    rng, plan = random.Random(seed), []
    if size <= ranges * width:
        plan = [(f, 0, n, float(n)) for f, n in files]
    else:
        for i in range(ranges):
            low, high = i * size // ranges, (i + 1) * size // ranges
            at = low + rng.randrange(high - low)
            # A range that would leave its file goes on in the next one, and the last one in the first.
            left, stands_for = width, (high - low) / width
            while left:
                file = bisect_right(ends, at % size)
                inside = at % size - (ends[file] - files[file][1])
                take = min(left, files[file][1] - inside)
                plan.append((files[file][0], inside, take, stands_for * take))
                at, left = at + take, left - take
    with ThreadPoolExecutor(HEADER_READERS) as pool:
        cells = list(pool.map(lambda c: _read_cell(spark, *c, texts, sep), plan))
    parts = [c.stands_for * c.breaks / c.read for c in cells]
    error = 0.0 if size <= ranges * width else math.sqrt(sum((x - y) ** 2 for x, y in zip(parts, parts[1:], strict=False)) / 2)
    lines, read, held = sum(parts), sum(c.line_bytes for c in cells), sum(c.text_bytes for c in cells)
    if packed:
        seen = spark.read.text(packed).agg(F.count(F.lit(1)), F.sum(F.octet_length("value") + F.lit(1))).first()
        lines, size = lines + seen[0], size + (seen[1] or 0)
        if not read:
            first = [r["value"] for r in spark.read.text(packed[0]).limit(ESTIMATE_ROWS).collect()]
            read, held = sum(len(line.encode()) + 1 for line in first), _text_bytes(first[1:], texts, sep)
    rows = max(0, round(lines - len(found)))
    text = size * held / read if read else 0.0
    return spark.createDataFrame(
        [(rows, error, int(size / max(lines, 1)), int(rows * fixed + text))],
        "rows bigint, rows_error double, row_size bigint, total_size bigint",
    )


def bounded_rows(estimated_rows: float, width: int, fast: bool = False) -> int | None:
    """Row limit that keeps a table within the cell budget; None when all rows fit."""
    cap = FAST_ROWS if fast else int(round(CELL_BUDGET / width, -1))
    return None if estimated_rows * ESTIMATE_SAFETY < cap else cap


def scan_bounded(
    spark: SparkSession, path: str, most_rows: int | None = None, roles: Roles = DEFAULT_ROLES
) -> DataFrame:
    """CSV scan of the whole table, or of its first ``most_rows`` rows by key if the caller sets that.

    ``bounded_rows`` suggests a limit for a table's width; nothing is cut unless it is passed on.
    """
    return limited(scan_csv(spark, path, roles=roles), most_rows)
