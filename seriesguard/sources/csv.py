"""Metric CSV files under ``<root>/<cloudbed>/metric/<category>/*.csv``.

Columns are matched by name in every file. Spark's CSV reader matches by position, so the first line of each file is
looked up in a pass of its own, and the rows are then parsed with the positions their own file's header states. That pass
aggregates only lines of each file's first input split; Spark has no way to stop reading a split early for every file at
once. Paths and headers stay in a table; the driver sees counts only.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesguard.frame import BROADCAST_BYTES, store
from seriesguard.functions.names import seconds_to_time

logger = logging.getLogger(__name__)

# The columns every metric file has, and the categories loaded by default.
COLUMNS = ("timestamp", "cmdb_id", "kpi_name", "value")
CATEGORIES = ("container", "istio", "jvm", "node", "service")

KEYS = ("cloudbed", "cmdb_id", "kpi_name")
SCHEMA = "cloudbed string, category string, cmdb_id string, kpi_name string, timestamp timestamp, value double"
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]
PLACE = r"([^/]+)/metric/([^/]+)/[^/]+\.csv$"


def file_path() -> Column:
    """Path of the file a row comes from, with escapes such as %20 undone."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def read_metrics(spark: SparkSession, root: str, cloudbed: str | None = None,
                 name_contains: str | None = None, date_pattern: str | None = None,
                 categories: Sequence[str] | None = CATEGORIES, strict: bool = False,
                 header: str | None = None) -> DataFrame:
    """All metric rows below ``root`` with their cloudbed and category; rows whose time is no number are left out.

    ``cloudbed`` picks one directory by exact name; ``name_contains`` and ``date_pattern`` are
    substrings of the directory name; ``categories`` None means any. Files lacking a needed
    column are left out with a warning, or raise when ``strict``. ``header`` states one header
    line all files share and saves the pass that looks for headers.
    """
    some = bool(cloudbed is not None or name_contains or date_pattern or categories is not None)
    rows = _rows(spark, root, _wanted(cloudbed, name_contains, date_pattern, categories), strict, header, some)
    return rows.where("timestamp is not null").select(*NAMES)


def count_bad_rows(spark: SparkSession, root: str, categories: Sequence[str] | None = None,
                   header: str | None = None) -> DataFrame:
    """Per cloudbed and category: all rows, rows left out as their time is no number, and rows whose value is none."""
    rows = _rows(spark, root, _wanted(categories=categories), False, header)
    return rows.groupBy("cloudbed", "category").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("timestamp").isNull()).alias("without_time"),
        F.count_if(F.col("timestamp").isNotNull() & F.col("value").isNull()).alias("without_value"))


def load_csv_file(spark: SparkSession, path: str) -> DataFrame:
    """One file (or several by glob), columns by name; empty if a needed column is missing."""
    return _rows(spark, path, F.lit(True), False).where("timestamp is not null") \
        .select("timestamp", "cmdb_id", "kpi_name", "value")


def load_metric_category(spark: SparkSession, cloudbed_dir: str, category: str) -> DataFrame:
    """All files of one category of a cloudbed directory."""
    rows = _rows(spark, f"{cloudbed_dir}/metric/{_literal(category)}", _wanted(categories=[category]), False)
    return rows.where("timestamp is not null").select(*NAMES)


def load_cloudbed(spark: SparkSession, root: str, name: str, date_pattern: str | None = None) -> DataFrame:
    """One cloudbed by exact name, the known categories only."""
    return read_metrics(spark, f"{root}/{_literal(name)}", cloudbed=name, date_pattern=date_pattern)


def load_all_cloudbeds(spark: SparkSession, root: str, date_pattern: str | None = None) -> DataFrame:
    """Every directory with ``cloudbed`` in its name, told apart by the ``cloudbed`` column."""
    return read_metrics(spark, root, name_contains="cloudbed", date_pattern=date_pattern)


def load_job_input(spark: SparkSession, root: str) -> DataFrame:
    """Any cloudbed and category; a file without the needed columns is an error."""
    return read_metrics(spark, root, categories=None, strict=True)


def require_columns(rows: DataFrame, columns: Sequence[str] = COLUMNS) -> DataFrame:
    missing = [c for c in columns if c not in rows.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return rows


def _names(line: str) -> list[str]:
    return [name.strip().strip('"') for name in line.lstrip("\ufeff").split(",")]


def _literal(name: str) -> str:
    """A directory name in which no character is taken for a pattern."""
    return "".join(f"\\{c}" if c in "\\*?[]{}^" else c for c in name)


def _wanted(cloudbed: str | None = None, name_contains: str | None = None, date_pattern: str | None = None,
            categories: Sequence[str] | None = None) -> Column:
    """Whether a file is wanted, by the column ``path``."""
    bed, category = F.regexp_extract("path", PLACE, 1), F.regexp_extract("path", PLACE, 2)
    wanted = bed != ""
    if cloudbed is not None:
        wanted = wanted & (bed == cloudbed)
    for part in (name_contains, date_pattern):
        if part:
            wanted = wanted & F.contains(bed, F.lit(part))
    return wanted if categories is None else wanted & category.isin(list(categories))


def _rows(spark: SparkSession, path: str, wanted: Column, strict: bool, header: str | None = None, some: bool = False) -> DataFrame:
    """Every row with the columns of SCHEMA; time and value are null where they are no numbers.

    What is derived from a path is derived once for each file, not for each line. Only where ``some`` files below the path
    are wanted, lines are filtered by it too, which spares reading the others.
    """
    try:
        lines = _lines(spark, path, wanted if some else None)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)
    places_of = [F.regexp_extract("path", PLACE, j).alias(name) for j, name in ((1, "cloudbed"), (2, "category"))]
    if header:
        names = _names(header)
        found, width = lines.withColumn("path", file_path()).where(wanted).select(
            "value", F.lit(header).alias("header"), *places_of), len(names)
        places = {c: F.lit(names.index(c)) for c in COLUMNS}
    else:
        headers, size, width = _headers(_first_lines(lines, wanted), strict)
        if not width:
            return spark.createDataFrame([], SCHEMA)
        headers = headers.select("file", "header", "names", *places_of)
        found = lines.select("value", F.col("_metadata.file_path").alias("file")).join(
            F.broadcast(headers) if size <= BROADCAST_BYTES else headers, "file")
        places = {c: F.array_position("names", c).cast("int") - 1 for c in COLUMNS}
    found = found.where("value <> header")
    cells = F.from_csv("value", ", ".join(f"c{j} string" for j in range(width)))
    parsed = found.withColumn("cells", F.array(*[cells[f"c{j}"] for j in range(width)]))
    cell = {c: F.get("cells", place) for c, place in places.items()}
    return parsed.select(
        "cloudbed", "category",
        cell["cmdb_id"].alias("cmdb_id"), cell["kpi_name"].alias("kpi_name"),
        seconds_to_time(cell["timestamp"].try_cast("double")).alias("timestamp"),
        cell["value"].try_cast("double").alias("value"))


def _lines(spark: SparkSession, path: str, wanted: Column | None) -> DataFrame:
    """Lines that are not blank."""
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(path).where(F.trim("value") != "")
    return lines if wanted is None else lines.withColumn("path", file_path()).where(wanted).drop("path")


def _first_lines(lines: DataFrame, wanted: Column) -> DataFrame:
    """(file, path, value): the first line of each wanted file, stored; ``file`` is the path as Spark gives it."""
    lines = lines.where("_metadata.file_block_start = 0").select(
        F.col("_metadata.file_path").alias("file"), "value", F.monotonically_increasing_id().alias("place"))
    first = lines.groupBy("file").agg(F.min_by("value", "place").alias("value"))
    return store(first.withColumn("path", F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B")))).where(wanted))


def _headers(lines: DataFrame, strict: bool) -> tuple[DataFrame, int, int]:
    """(file, path, header, names) of the files whose first line has all columns, the table's bytes, and the most columns of a file."""
    names = F.transform(F.split("value", ","), lambda n: F.btrim(n, F.lit(' "\ufeff')))
    is_header = F.array_size(F.array_intersect(names, F.array(*[F.lit(c) for c in COLUMNS]))) == len(COLUMNS)
    files = lines.select("file", "path", F.when(is_header, F.col("value")).alias("header"), F.when(is_header, names).alias("names"))
    lacking = F.col("header").isNull()
    seen = files.agg(
        F.count_if(lacking).alias("without"),
        F.coalesce(F.sum(2 * F.length("path") + 3 * F.length("header")), F.lit(0)).alias("bytes"),
        F.coalesce(F.max(F.size("names")), F.lit(0)).alias("width")).first()
    if seen["without"]:
        some = [r["path"] for r in files.where(lacking).orderBy("path").limit(5).collect()]
        message = f"{seen['without']} files lack one of the columns {', '.join(COLUMNS)}: {some}"
        if strict:
            raise ValueError(message)
        logger.warning(message)
    return files.where(~lacking), seen["bytes"], max(0, seen["width"])
