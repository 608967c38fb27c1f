"""Scans of exported files. Every cell is read as text; casts come later and never fail."""

from __future__ import annotations

import csv
import re
import time
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from agoralake import schemas
from agoralake.functions.text import repair_mojibake, trim_spaces

# Quoting of the exported files, and line breaks besides the usual ones.
CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
_ODD_BREAKS = r"[\x{0B}\x{0C}\x{1C}-\x{1E}\x{85}\x{2028}\x{2029}]"
# Columns of a scan that are no cells of the file.
FILE_COLUMNS = ("file_path", "file_order", "file_header")
_BOM = r"^[ï»¿\x{FEFF}]+"


def hadoop_path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = hadoop_path(spark, path)
    found = fs.globStatus(jpath)
    return found is not None and len(found) > 0


def read_small_text(spark: SparkSession, path: str) -> str:
    """A small file of the driver's own bookkeeping."""
    fs, jpath = hadoop_path(spark, path)
    stream = fs.open(jpath)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_small_text(spark: SparkSession, path: str, text: str) -> None:
    fs, jpath = hadoop_path(spark, path)
    stream = fs.create(jpath, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def header_names(line: str) -> list[str]:
    """Column names of a header line: a byte-order mark is dropped, blank names and repeated ones get their number."""
    names: list[str] = []
    for i, cell in enumerate(next(csv.reader([line.lstrip("\ufeff")]), [])):
        name = cell.strip() or f"_c{i}"
        names.append(f"{name}{i}" if name in names else name)
    return names


def _headers(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by header; a file without any line has none. One row per file comes to the driver, as in any file listing."""
    lines = spark.read.text(paths).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("n"))
    first = lines.where(F.col("start") == 0).groupBy("file").agg(F.min_by("value", "n").alias("line"))
    found: dict[tuple[str, ...], list[str]] = {}
    for r in first.orderBy("file").collect():
        found.setdefault(tuple(header_names(r["line"])), []).append(unquote(r["file"]))
    return found


def read_csv(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] | None = None,
             multi_line: bool = True) -> DataFrame:
    """CSV with a header in every file; cells are bound to columns by the header of their own file.

    Files are read in groups of one header; a column that a file lacks is null. ``columns`` chooses columns by name (case
    is ignored where no name fits exactly), else all that occur are given. Adds ``file_path`` and ``file_order``; the latter
    rises along each file. Where all columns are given, ``file_header`` has the names the row's own file has. Where records may span lines a file is read by one task and parallelism comes from the number of
    files; ``multi_line=False`` lets Spark split large files.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.options(**CSV_OPTIONS).option("multiLine", str(multi_line).lower())
    out = None
    for names, group in _headers(spark, paths).items():
        df = reader.schema(schemas.text_schema(list(names))).csv(group)
        chosen = list(names)
        if columns is not None:
            low = {n.lower(): n for n in reversed(names)}
            chosen = [c if c in names else low.get(c.lower()) for c in columns]
        cells = [F.col(f"`{n}`").alias(c) if n else F.lit(None).cast("string").alias(c)
                 for n, c in zip(chosen, columns if columns is not None else names)]
        header = [F.array(*map(F.lit, names)).alias("file_header")] if columns is None else []
        df = df.select(*cells, F.col("_metadata.file_path").alias("file_path"),
                       F.monotonically_increasing_id().alias("file_order"), *header)
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        return spark.createDataFrame([], schemas.text_schema([*(columns or []), "file_path"])).withColumn(
            "file_order", F.lit(None).cast("bigint"))
    extra = [c for c in FILE_COLUMNS if c in out.columns]
    return out.select(*[f"`{c}`" for c in out.columns if c not in extra], *extra)


def with_row_numbers(df: DataFrame, name: str = "row_number") -> DataFrame:
    """Number the rows of each file from 1, whatever splits the file was read in.

    ``file_order`` counts inside a read partition (its upper bits). Rows per file and partition are counted, and each
    partition starts after the rows of those before it, so no task holds a file.
    """
    part = F.shiftright(F.col("file_order"), 33).alias("_part")
    counts = df.groupBy("file_path", part).agg(F.count(F.lit(1)).alias("_n"), F.min("file_order").alias("_first"))
    before = Window.partitionBy("file_path").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).select(
        F.col("file_path").alias("_path"), F.col("_part").alias("_at"), "_first", "_before")
    same = (F.col("file_path") == F.col("_path")) & (F.shiftright(F.col("file_order"), 33) == F.col("_at"))
    return df.join(starts, same).withColumn(name, F.col("file_order") - F.col("_first") + F.col("_before") + 1).drop(
        "_path", "_at", "_first", "_before")


def read_csv_if_present(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """As ``read_csv``, with no rows when the file is absent."""
    if exists(spark, path):
        return read_csv(spark, path, columns)
    return spark.createDataFrame([], schemas.text_schema([*columns, "file_path"])).withColumn(
        "file_order", F.lit(None).cast("bigint"))


def read_required(spark: SparkSession, paths: str | Sequence[str], required: Sequence[str]) -> DataFrame:
    """CSV that must have certain columns, with or without a byte-order mark."""
    df = read_csv(spark, paths)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    return df


def parse_nested_lines(lines: DataFrame, value: str = "value", columns: Sequence[str] = schemas.NESTED_CSV) -> DataFrame:
    """Lines whose first CSV cell is itself a CSV record: unwrap twice, drop headers and blank rows, repair encoding.

    Each parse is a generator, so it runs once per line however often its cells are used afterwards.
    """
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    others = [c for c in lines.columns if c != value]
    parts = F.transform(F.split(F.make_valid_utf8(F.col(value)), _ODD_BREAKS), trim_spaces)
    pieces = lines.select(*others, F.posexplode(F.filter(parts, lambda p: p != "")).alias("_piece", "_line"))
    outer = pieces.select(*others, "_piece", F.inline(F.array(F.from_csv("_line", "_a string, _b string", options))))
    inner = outer.withColumn("_inner", F.regexp_replace(F.coalesce("_a", F.lit("")), _BOM, ""))
    header = F.contains("_inner", F.lit("postTitle")) | F.contains("_inner", F.lit("facebookUrl"))
    inner = inner.where((F.col("_inner") != "") & ~header)
    record = F.from_csv("_inner", ", ".join(f"`{c}` string" for c in columns), options)
    rows = inner.select(*others, "_piece", F.inline(F.array(record)))
    cells = [F.coalesce(F.col(c), F.lit("")) for c in columns]
    return rows.where(F.concat(*cells) != "").select(
        *others, "_piece", *[repair_mojibake(cell).alias(c) for c, cell in zip(columns, cells)])


def read_nested_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths)).select(
        "value", F.col("_metadata.file_path").alias("file_path"), F.monotonically_increasing_id().alias("file_order"))
    return parse_nested_lines(lines).drop("_piece")


def read_bronze_jsonl(spark: SparkSession, path: str, source: str | None = None, date: str | None = None) -> DataFrame:
    """Stored bronze posts of a source and day, or of all; both filters prune folders."""
    if not exists(spark, path):
        return spark.createDataFrame([], schemas.BRONZE_POST).withColumn("ingest_date", F.lit(None).cast("string"))
    schema = schemas.T.StructType([*schemas.BRONZE_POST.fields, schemas.T.StructField("ingest_date", schemas.S)])
    df = spark.read.schema(schema).json(path)
    if source is not None:
        df = df.where(F.col("source") == source)
    return df if date is None else df.where(F.col("ingest_date") == date)


# --- inbox ------------------------------------------------------------------------------------------------------------

# Inbox layout <source>/<yyyy-mm-dd>/<name>.csv and the sources accepted there.
INBOX_PATTERN = r"/([^/]+)/(\d{4}-\d{2}-\d{2})/([^/]+\.[cC][sS][vV])$"
CSV_NAMES = "*.[cC][sS][vV]"
INBOX_SOURCES = ["twitter", "youtube", "tiktok", "facebook", "external"]


def parse_inbox_path(path: Column) -> Column:
    """Struct (source, day, name, is_videos), NULL when the path does not fit the layout or names no known source."""
    source = F.lower(F.regexp_extract(path, INBOX_PATTERN, 1))
    name = F.regexp_extract(path, INBOX_PATTERN, 3)
    parsed = F.struct(
        source.alias("source"), F.regexp_extract(path, INBOX_PATTERN, 2).alias("day"), name.alias("name"),
        F.endswith(F.lower(name), F.lit("_videos.csv")).alias("is_videos"))
    return F.when(source.isin(INBOX_SOURCES), parsed)


def list_inbox(spark: SparkSession, inbox: str) -> DataFrame:
    """(path, source, modified, length) of every CSV below the inbox; the source is the first folder. No content is read."""
    root = re.sub(r"^[a-z0-9+.-]+:/*", "/", inbox.rstrip("/")) + "/"
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", CSV_NAMES).load(inbox))
    rest = F.substring_index(F.col("path"), root, -1)
    return files.select("path", F.split_part(rest, F.lit("/"), F.lit(1)).alias("source"),
                        F.col("modificationTime").alias("modified"), "length")


def settled(files: DataFrame, as_of: Column, seconds: int) -> DataFrame:
    """Files that have not changed for a while. Writers that rename a finished file into place need no such wait."""
    return files.where(F.unix_micros("modified") <= F.unix_micros(as_of) - seconds * 1_000_000)


def wait_until_settled(spark: SparkSession, paths: Sequence[str], quiet: float, at_most: float = 3600.0) -> None:
    """Return once none of these files has changed its length or time for ``quiet`` seconds. Their content is not read.

    A file that still changes after ``at_most`` seconds raises TimeoutError, so that whoever waits comes back to it. Storage
    whose files appear whole needs no such wait. No files, or no wait, return at once.
    """
    if not paths or quiet <= 0:
        return

    def state() -> dict:
        listed = spark.read.format("binaryFile").load(list(paths)).select("path", "length", F.unix_micros("modificationTime").alias("at"))
        return {r["path"]: (r["length"], r["at"]) for r in listed.collect()}  # the files of one trigger

    until, before = time.monotonic() + at_most, state()
    while True:
        time.sleep(quiet)
        now = state()
        if now == before:
            return
        if time.monotonic() > until:
            changed = sorted(p for p, v in now.items() if before.get(p) != v)
            raise TimeoutError(f"files still change: {', '.join(changed[:5])}")
        before = now


FILE_SCHEMA = schemas.T.StructType(
    [schemas.T.StructField(c, schemas.S) for c in ("source_sha256", "file_path", "run_id")])


# Files up to this many bytes are hashed as one value; of larger ones no task holds more than a line.
WHOLE_FILE = 64 << 20


def _line_sums(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(_file, _lines): for each file the sums of its lines' digests, each taken with the line's number, in eight parts.

    The sums are the same in whatever splits a file is read. Lines end at a line feed only, so no byte is lost but a last one.
    """
    lines = spark.read.option("lineSep", "\n").text(list(paths)).select(
        F.col("_metadata.file_path").alias("file_path"), F.monotonically_increasing_id().alias("file_order"),
        F.unhex(F.sha2(F.col("value").cast("binary"), 256)).alias("_line"))
    digest = F.sha2(F.concat(F.encode(F.col("_number").cast("string"), "UTF-8"), F.lit(b":"), F.col("_line")), 256)
    numbered = with_row_numbers(lines, "_number").select("file_path", digest.alias("_digest"))
    part = lambda i: F.sum(F.conv(F.substring("_digest", 8 * i + 1, 8), 16, 10).cast("bigint")).cast("string")
    return numbered.groupBy(F.col("file_path").alias("_file")).agg(F.concat_ws(",", *[part(i) for i in range(8)]).alias("_lines"))


def fingerprints(spark: SparkSession, paths: str | Sequence[str], path: Column | None = None) -> DataFrame:
    """(file_path, source_sha256) of whole files; ``path`` gives their names another spelling.

    Up to WHOLE_FILE bytes it is the SHA-256 of the bytes. A larger file is read in splits, and its digest is made from its
    length and the digests of its numbered lines: equal bytes give equal digests there too.
    """
    read = spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths))
    name = (F.col("path") if path is None else path).alias("file_path")
    whole = read.where(F.col("length") <= WHOLE_FILE).select(name, F.sha2("content", 256).alias("source_sha256"))
    large = read.where(F.col("length") > WHOLE_FILE)
    found = [r["path"] for r in large.select("path").collect()]  # one row per large file, as in any file listing
    if not found:
        return whole
    listed = large.select(name, F.col("_metadata.file_path").alias("_file"), "length")
    digest = F.sha2(F.concat_ws(";", F.col("length").cast("string"), "_lines"), 256).alias("source_sha256")
    return whole.unionByName(listed.join(_line_sums(spark, found), "_file").select("file_path", digest))


# --- other tables ------------------------------------------------------------------------------------------------------

def landing_rows(df: DataFrame, run_id: str, source: str) -> DataFrame:
    """Whole rows kept as JSON with file name and row number; empty cells become null."""
    data = [c for c in df.columns if c not in FILE_COLUMNS]
    payload = F.to_json(F.struct(*[F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) for c in data]),
                        {"ignoreNullFields": "false"})
    return with_row_numbers(df).select(
        F.lit(run_id).alias("run_id"), F.lit(source).alias("source"),
        F.element_at(F.split("file_path", "/"), -1).alias("original_filename"), "row_number", payload.alias("payload"))


def polls(df: DataFrame) -> DataFrame:
    """Poll rows with a date; a value that is no number counts as 0."""
    from agoralake.functions.casting import first_ten_as_date, lenient_double
    return df.select(first_ten_as_date(F.col("fecha")).alias("fecha"), "encuestadora", "candidato",
                     lenient_double(F.col("intencion_voto"), 0.0).alias("intencion_voto"))


def window_momentum(df: DataFrame) -> DataFrame:
    """Media momentum per window: ``ventana`` and one numeric column per candidate."""
    from agoralake.functions.casting import lenient_double, lenient_int
    data = [c for c in df.columns if c not in ("ventana", *FILE_COLUMNS)]
    return df.select(lenient_int(F.col("ventana")).cast("int").alias("ventana"),
                     *[lenient_double(F.col(f"`{c}`")).alias(c) for c in data])


def since(table: DataFrame, checkpoint: Column, column: str = "datetime_utc") -> DataFrame:
    """Non-duplicate rows from a stored date on; the filter reaches the file scan."""
    return table.where((~F.col("is_duplicate")) & (F.col(column) >= checkpoint))


def high_water_mark(table: DataFrame, column: str = "datetime_utc") -> DataFrame:
    return table.agg(F.max(column).alias("ultima_fecha"))
