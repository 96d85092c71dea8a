"""Batch and stream readers for the landing files and tables."""

from __future__ import annotations

import json
import os

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StringType, StructField, StructType

from segmentflow.config import ensure_checkpoint_dir

# The columns of an add/remove feed file, in file order.
# Remove files have the same layout; only ``email`` is used.
FEED_SCHEMA = StructType(
    [
        StructField("Name", StringType(), True),
        StructField("email", StringType(), True),
        StructField("DOB", DateType(), True),
        StructField("occupation", StringType(), True),
        StructField("phone_number", StringType(), True),
    ]
)
CONTACT_COLUMNS = ["Name", "DOB", "occupation", "phone_number"]
FEED_DATE_FORMAT = "yyyy-MM-dd"
PLAIN_DATE = r"\A(1[6-9]|[2-9][0-9])[0-9]{2}-[0-9]{2}-[0-9]{2}\z"

# What text that casts to a type looks like; the cast itself takes long to
# say that text is no value.
_SPACE = r"[\x00-\x20\x7f]*"
MAY_BE = {
    "int": r"\A[^A-Za-z]*[0-9][^A-Za-z]*\z",
    "bigint": r"\A[^A-Za-z]*[0-9][^A-Za-z]*\z",
    "double": rf"(?i)\A{_SPACE}[-+]?([.0-9]|inf|nan)",
    "timestamp": rf"\A{_SPACE}[-+T0-9]",
    "boolean": rf"(?i)\A{_SPACE}[tfyn01][a-z]{{0,4}}{_SPACE}\z",
}

MOST_COLUMNS = 64  # of a file; lines with more can't be read by name
FEW_COLUMNS = 16  # looked for first in lines with quotes
LINE_END = "\ue000"  # a private-use character


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Full scan of a named table (``table_scan``)."""
    return spark.read.table(name)


def read_parquet_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV with a header.  With ``schema`` columns are typed by it (a bad
    date becomes NULL), and a file whose header differs from it is an error
    (``aligned`` reads any order); without, types are inferred (one extra
    pass)."""
    reader = spark.read.option("header", True).option("dateFormat", FEED_DATE_FORMAT)
    if schema is not None:
        return reader.option("enforceSchema", False).schema(schema).csv(path)
    return reader.option("inferSchema", True).csv(path)


def load_fixture(spark: SparkSession, path: str) -> DataFrame:
    """A test fixture: a ``.json`` array or a ``.csv`` (all columns as
    text).  Any other suffix raises ``ValueError``."""
    if path.endswith(".json"):
        return spark.read.option("multiLine", True).json(path)
    if path.endswith(".csv"):
        return spark.read.option("header", True).csv(path)
    raise ValueError(f"unsupported fixture type: {path}")


def with_file_metadata(df: DataFrame) -> DataFrame:
    """Lineage columns of a file read: path, ingestion time and file
    modification time (``file_metadata``)."""
    return (
        df.withColumn("source_file", F.col("_metadata.file_path"))
        .withColumn("ingestion_timestamp", F.current_timestamp())
        .withColumn("file_modification_time", F.col("_metadata.file_modification_time"))
    )


def stream_csv(
    spark: SparkSession,
    path: str,
    schema: StructType = FEED_SCHEMA,
    max_files: int = 1000,
    glob: str | None = "*.csv",
) -> DataFrame:
    """File stream of CSV drops with a declared schema and at most
    ``max_files`` new files per micro-batch (``csv_stream_declared``,
    ``rate_limit``).  ``path`` may hold wildcards such as
    ``<landing>/*/add``.  Columns bind by position, so a file whose header
    differs from the schema is an error; ``stream_lines`` reads any."""
    reader = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("dateFormat", FEED_DATE_FORMAT)
        .option("maxFilesPerTrigger", max_files)
    )
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.csv(path)


def with_lineage(lines: DataFrame) -> DataFrame:
    """Raw lines of a text read as ``raw`` with the lineage columns and the
    place in the file where their split begins."""
    named = lines.withColumnRenamed("value", "raw").withColumn("block_start", F.col("_metadata.file_block_start"))
    return with_file_metadata(named)


def stream_lines(spark: SparkSession, path: str, max_files: int = 1000, glob: str | None = "*.csv") -> DataFrame:
    """File stream of raw lines with lineage.  A file is read whole within
    one micro-batch, so each batch holds the headers of its rows."""
    reader = spark.readStream.option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return with_lineage(reader.text(path))


def read_lines(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Raw lines of a batch read with lineage."""
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    return with_lineage(reader.text(path))


def with_cells(lines: DataFrame, most_columns: int = MOST_COLUMNS) -> DataFrame:
    """Lines that aren't blank with their values: ``_cells``, and ``_n``,
    how many there are (-1 where an open quote hides the line's end, or
    beyond ``most_columns``).

    A line without a quote is cut at its commas.  The others go through the
    CSV parser, whose time a line grows with its columns, so it looks for
    ``FEW_COLUMNS`` first and for all where the line's end isn't among them."""
    few, odd = min(FEW_COLUMNS, most_columns), F.col("_odd")
    parse = lambda n: F.from_csv(F.concat("raw", F.lit("," + LINE_END)), ", ".join(f"c{i} STRING" for i in range(n + 1)))
    cells = lambda p, n: F.array(*[F.col(f"{p}.c{i}") for i in range(n + 1)])
    # The mark stands behind the last value unless an open quote took it in.
    end = lambda c: F.array_position(c, F.lit(LINE_END)).cast("int") - 1
    out = lines.filter(F.trim("raw") != "")
    out = out.withColumn("_odd", F.col("raw").contains('"') | F.col("raw").contains("\0") | F.col("raw").contains(LINE_END))
    out = out.withColumn("_p", F.when(odd, parse(few))).withColumn("_few", F.when(odd, cells("_p", few)))
    out = out.withColumn("_many", odd & (end(F.col("_few")) < 0))
    out = out.withColumn("_p", F.when(F.col("_many"), parse(most_columns))).withColumn("_all", F.when(F.col("_many"), cells("_p", most_columns)))
    out = out.withColumn("_parsed", F.coalesce("_all", "_few")).withColumn("_cut", F.when(~odd, F.split("raw", ",")))
    size = F.when(odd, end(F.col("_parsed"))).when(F.size("_cut") <= most_columns, F.size("_cut")).otherwise(-1)
    out = out.withColumn("_n", size)
    parsed = F.slice("_parsed", F.lit(1), F.greatest("_n", F.lit(0)))
    plain = F.transform("_cut", lambda c: F.when(c != "", c))
    out = out.withColumn("_cells", F.when(F.col("_n") >= 0, F.when(odd, parsed).otherwise(plain)))
    return out.drop("_odd", "_p", "_few", "_many", "_all", "_parsed", "_cut")


def file_headers(lines: DataFrame) -> DataFrame:
    """Per file its first line that isn't blank, ``_head``, and the
    ``_names`` in it: one aggregation, combined before the shuffle, so no
    file is one task's work.  Of a file only that line is cut into values."""
    at = F.struct("block_start", F.monotonically_increasing_id().alias("row"))
    rows = lines.filter(F.trim("raw") != "").select("source_file", at.alias("_at"), "raw")
    first = rows.groupBy("source_file").agg(F.min_by("raw", "_at").alias("raw"))
    label = F.transform("_cells", lambda c: F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), "^\ufeff", "")))
    return with_cells(first).select("source_file", F.col("raw").alias("_head"), label.alias("_names"))


def aligned(lines: DataFrame, schema: StructType, required: list[str] | None = None, headers: DataFrame | None = None) -> DataFrame:
    """CSV lines (``raw`` with lineage) as the declared columns, bound by
    the names in each file's first line and never by position.

    Adds ``raw``, ``reason`` and ``rejected``.  A line is rejected, its
    declared columns NULL, if its file's first line doesn't name all columns
    that are ``required`` (all, if not given), or if its values can't be
    told apart (open quote, more or fewer values than names).  A value that
    isn't of the declared type is NULL, as in a plain read, and gives a
    reason, but its row is kept.  Columns that aren't declared are left out;
    blank lines, the header and copies of it give no row.

    The headers, one row per file (``headers``, if ``file_headers`` of the
    lines is there already), are joined to the lines by ``join_listed``, so
    a file may hold most of the lines."""
    from segmentflow.operators.marts import join_listed

    ensure_checkpoint_dir(lines.sparkSession)
    names = [f.name for f in schema]
    required = names if required is None else required
    cells = with_cells(lines)
    fits = F.col("_names").isNotNull()
    if required:
        fits &= F.size(F.array_intersect("_names", F.array(*map(F.lit, required)))) == len(set(required))
    files = file_headers(lines) if headers is None else headers
    # Where each declared column stands in a file's lines, once for each file.
    at = [F.nullif(F.array_position("_names", n), F.lit(0)).cast("int").alias(f"_at{i}") for i, n in enumerate(names)]
    files = files.withColumn("_names", F.when(fits, F.col("_names"))).select("*", *at).checkpoint()
    rows = join_listed(cells.drop("block_start"), files, "source_file").filter("raw <> _head or _names is null")
    broken = (
        F.when(F.col("_names").isNull(), "no header with the declared columns")
        .when(F.col("_n") < 0, "unreadable line")
        .when(F.col("_n") > F.size("_names"), "too many values")
        .when(F.col("_n") < F.size("_names"), "too few values")
    )
    rows = rows.withColumn("_broken", broken)
    # One step each, so that no expression stands for its text in the others:
    # a generated method of all columns would be too long to be compiled.
    lineage = [c for c in lines.columns if c not in ("raw", "block_start")]
    text = [F.when(F.col("_broken").isNull(), F.try_element_at("_cells", F.col(f"_at{i}"))).alias(f"_t{i}") for i in range(len(names))]
    rows = rows.select(*lineage, "raw", "_broken", *text)
    rows = rows.select("*", *[typed_text(F.col(f"_t{i}"), f.dataType).alias(f"_v{i}") for i, f in enumerate(schema)])
    bad = [F.when(F.col(f"_t{i}").isNotNull() & F.col(f"_v{i}").isNull(), F.lit(f"bad {f.name}")) for i, f in enumerate(schema) if f.dataType != StringType()]
    reason = F.coalesce("_broken", F.concat_ws(", ", *bad))
    return rows.select(
        *[F.col(f"_v{i}").alias(n) for i, n in enumerate(names)], *lineage, "raw",
        F.when(reason != "", reason).alias("reason"), F.col("_broken").isNotNull().alias("rejected"),
    )


def typed_text(value: Column, kind: DataType) -> Column:
    """Text as a value of ``kind``; NULL where it isn't one."""
    if isinstance(kind, StringType):
        return value
    if isinstance(kind, DateType):
        # A cast reads the plain form as the parser does, in less time; text
        # without two hyphens is no date, which the parser takes long to say.
        slow = F.when(value.like("%-%-%"), F.try_to_timestamp(value, F.lit(FEED_DATE_FORMAT)).cast("date"))
        return F.when(value.rlike(PLAIN_DATE), value.try_cast("date")).otherwise(slow)
    may_be = MAY_BE.get(kind.simpleString())
    return value.try_cast(kind) if may_be is None else F.when(value.rlike(may_be), value.try_cast(kind))


def path_not_found(e: Exception) -> bool:
    """True when Spark says that the path does not exist."""
    return isinstance(e, AnalysisException) and e.getCondition() == "PATH_NOT_FOUND"


SCHEMA_LOG = "version BIGINT, schema STRING, until TIMESTAMP"
# Types tried for a new column, the narrowest first; else it is text.
INFERRED = ["int", "bigint", "double", "date", "timestamp", "boolean"]


def stored_schema(spark: SparkSession, schema_location: str) -> tuple[int, StructType, object]:
    """Newest version, its schema, and the time up to which files were
    looked at; a location that exists but can't be read is an error."""
    try:
        log = spark.read.schema(SCHEMA_LOG).json(schema_location)
        last = log.agg(F.max_by(F.struct("version", "schema", "until"), "version").alias("r")).first().r
    except AnalysisException as e:
        if not path_not_found(e):
            raise
        last = None
    if last is None:
        return 0, StructType([]), None
    return last.version, StructType.fromJson(json.loads(last.schema)), last.until


def grown_schema(spark: SparkSession, path: str, schema_location: str, glob: str | None = "*.csv") -> StructType:
    """The schema of a CSV feed without a declared one, kept in versions at
    ``schema_location`` (a shared folder).

    Each run looks at the files that are new since the version before: a
    column that one of them names first is added, with the narrowest type
    that all its values have.  Columns that are known keep their type and
    place, so a new file can add columns but never change any."""
    version, schema, until = stored_schema(spark, schema_location)
    lines = read_lines(spark, path, glob)
    if until is not None:
        lines = lines.filter(F.col("_metadata.file_modification_time") >= F.lit(until))
    ensure_checkpoint_dir(spark)
    files = file_headers(lines).checkpoint()
    headers = files.select(F.posexplode("_names").alias("at", "name")).groupBy("name").agg(F.min("at").alias("at"))
    latest = lines.agg(F.max("file_modification_time")).first()[0]
    names = [r.name for r in sorted(headers.collect(), key=lambda r: (r["at"], r["name"])) if r.name]  # MOST_COLUMNS a file
    new = [n for n in names if n not in schema.names]
    if new:
        texts = StructType([StructField(n, StringType()) for n in new])
        rows = aligned(lines.filter("raw is not null"), texts, required=[], headers=files)
        kinds = [StructType.fromDDL(f"x {t}")["x"].dataType for t in INFERRED]
        # One row for each value, so that the tests stand once in the plan.
        values = rows.select(F.posexplode(F.array(*[F.col(f"`{n}`") for n in new])).alias("at", "value")).filter("value is not null")
        missed = sum((F.when(typed_text(F.col("value"), k).isNull(), 1 << i).otherwise(0) for i, k in enumerate(kinds)), F.lit(0))
        found = {r["at"]: r.missed for r in values.groupBy("at").agg(F.bit_or(missed).alias("missed")).collect()}
        for at, n in enumerate(new):
            kind = next((k for i, k in enumerate(kinds) if at in found and not found[at] >> i & 1), StringType())
            schema = StructType([*schema.fields, StructField(n, kind)])
    if latest is not None:
        row = (version + 1, schema.json(), latest)
        spark.createDataFrame([row], SCHEMA_LOG).coalesce(1).write.mode("append").json(schema_location)
    return schema


def stream_csv_inferred(spark: SparkSession, path: str, schema_location: str, max_files: int = 1000) -> DataFrame:
    """Plain CSV file stream with the stored schema (``grown_schema``), for
    feeds whose files all have the same columns; ``feeds.land_inferred``
    reads any."""
    return stream_csv(spark, path, grown_schema(spark, path, schema_location), max_files)


def stream_json(spark: SparkSession, path: str, schema: StructType | str, max_files: int | None = None) -> DataFrame:
    """File stream of JSON records (``json_stream``)."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def stream_table(spark: SparkSession, name: str, max_files: int | None = None) -> DataFrame:
    """Incremental read of a table's new files (``table_stream``), at most
    ``max_files`` of them per micro-batch when given."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.table(name)


def stream_parquet(spark: SparkSession, path: str, schema: StructType | str, max_files: int | None = None) -> DataFrame:
    """Incremental read of a Parquet folder."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def add_feed(spark: SparkSession, landing: str, max_files: int = 1000) -> DataFrame:
    """Add stream of all segments: lines of ``<landing>/*/add/*.csv``."""
    return stream_lines(spark, os.path.join(landing, "*", "add"), max_files)


def remove_feed(spark: SparkSession, landing: str, max_files: int = 1000) -> DataFrame:
    """Remove stream of all segments: lines of ``<landing>/*/remove/*.csv``."""
    return stream_lines(spark, os.path.join(landing, "*", "remove"), max_files)
