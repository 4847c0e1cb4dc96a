"""CSV and table readers/writers. CSV columns are read as text under the names of
the header (whose line is read first) and cast by name; no inference pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from candlewick.functions.exprs import safe_double, safe_timestamp
from candlewick.functions.text import iso_utc
from candlewick.schema import CANDLE_COLUMNS, CANDLE_SCHEMA, CLEANED_SCHEMA, NA_SENTINELS, TAKER_COLUMNS, require_columns


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (parquet) by name."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def null_sentinels(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Turn pandas' default NA texts ('', 'NA', 'null', 'NaN', ...) into nulls."""
    cols = list(columns) if columns is not None else df.columns
    return df.withColumns(
        {c: F.when(~F.col(c).isin(*NA_SENTINELS), F.col(c)) for c in cols}
    )


#: Column of rows whose number of fields differs from the header's.
CORRUPT = "_corrupt_row"


def _raw_csv(spark: SparkSession, path: str, checked: bool) -> DataFrame:
    """All columns as text, named by the header (files whose headers differ
    from the first one's fail). ``checked`` adds ``CORRUPT``: the whole line
    where it has more or fewer fields than the header, else null. Fields are
    only counted where the parser prunes no column, so others read without."""
    header = spark.read.option("header", True).csv(path)
    require_columns(header, CANDLE_COLUMNS)
    names = [*header.columns, *([CORRUPT] if checked else [])]
    reader = spark.read.option("header", True).option("enforceSchema", False).schema(StructType([StructField(c, StringType()) for c in names]))
    if checked:
        reader = reader.option("columnPruning", False).option("columnNameOfCorruptRecord", CORRUPT)
    return reader.csv(path)


def _is_bad(df: DataFrame) -> Column:
    """The row is corrupt. It names a column of the file, too: Spark refuses to
    read a file for the corrupt rows' column alone."""
    line = F.col(CORRUPT)
    return line.isNotNull() & (F.length(F.coalesce(line, F.col(df.columns[0]))) >= 0)


def _field_count(line: str) -> Column:
    bare = F.regexp_replace(line, r'"(?:[^"\\]|\\.|"")*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def _text_csv(spark: SparkSession, path: str, bad_rows: str = "keep") -> DataFrame:
    """Base columns first, in their fixed order, then the others."""
    if bad_rows not in ("keep", "drop", "fail"):
        raise ValueError(f"bad_rows must be 'keep', 'drop' or 'fail', not {bad_rows!r}")
    df = _raw_csv(spark, path, checked=bad_rows != "keep")
    if bad_rows == "drop":
        df = df.where(~_is_bad(df))
    elif bad_rows == "fail":
        said = F.concat(F.lit(f"row of {path} with "), _field_count(CORRUPT).cast("string"), F.lit(" fields: "), F.col(CORRUPT))
        df = df.where(F.when(~_is_bad(df), F.lit(True)).otherwise(F.raise_error(said).cast("boolean")))
    return df.select(*CANDLE_COLUMNS, *[c for c in df.columns if c not in (*CANDLE_COLUMNS, CORRUPT)])


def _judged(spark: SparkSession, path: str) -> DataFrame:
    """``file, line, fields, kind`` per row; the last three are null for good ones."""
    df = _raw_csv(spark, path, checked=True)
    wanted = len(df.columns) - 1
    fields = F.when(_is_bad(df), _field_count(CORRUPT))
    kind = F.when(fields < wanted, "short").when(fields > wanted, "long").when(fields == wanted, "broken")
    return df.select(F.col("_metadata.file_path").alias("file"), F.col(CORRUPT).alias("line"), fields.alias("fields"), kind.alias("kind"))


def csv_rejects(spark: SparkSession, path: str) -> DataFrame:
    """``file, line, fields, kind`` of the rows whose number of fields is not
    the header's: "short" (a reader fills them up with nulls), "long" (it drops
    the last ones) or "broken" (unclosed quotes)."""
    return _judged(spark, path).where("kind is not null")


def csv_reject_counts(spark: SparkSession, path: str) -> DataFrame:
    """Per file: ``rows`` and how many are short, long or broken (one scan)."""
    kinds = [F.count_if(F.col("kind") == k).alias(k) for k in ("short", "long", "broken")]
    return _judged(spark, path).groupBy("file").agg(F.count(F.lit(1)).alias("rows"), *kinds)


def read_messy_csv(
    spark: SparkSession, path: str, *, pandas_na: bool = True, require_rows: bool = False, bad_rows: str = "keep"
) -> DataFrame:
    """All-text CSV with a header; columns are found by name, optional ones
    (taker volumes) and unknown ones are kept. ``pandas_na`` nulls pandas' NA
    sentinels.

    ``bad_rows``: rows with too few or too many fields are kept with what they
    have, dropped (``csv_rejects`` reports them), or end the query.
    ``require_rows`` raises ``ValueError`` on an empty file (costs one small job).
    A missing path raises Spark's ``PATH_NOT_FOUND`` error.
    """
    df = _text_csv(spark, path, bad_rows)
    if pandas_na:
        df = null_sentinels(df)
    if require_rows and df.isEmpty():
        raise ValueError(f"No rows found in {path}")
    return df


def _typed(df: DataFrame, schema, path: str, require_times: bool) -> DataFrame:
    """Text columns -> the types of ``schema``, by name. Times are read with or
    without an offset, with 'T' or a blank between date and time."""
    kinds = {f.name: f.dataType.typeName() for f in schema} | dict.fromkeys(TAKER_COLUMNS, "double")
    cols = []
    for c in df.columns:
        kind = kinds.get(c, "string")
        if kind == "double":
            cols.append(safe_double(c).alias(c))
        elif kind == "long":
            cols.append(F.coalesce(F.col(c).try_cast("bigint"), safe_double(c).cast("bigint")).alias(c))
        elif kind == "timestamp_ntz":
            cols.append(safe_timestamp(c).alias(c))
        else:
            cols.append(F.col(c))
    out = df.select(*cols)
    if require_times and out.where("open_time is not null").isEmpty() and not out.isEmpty():
        raise ValueError(f"no open_time of {path} could be read")
    return out


def read_candles_csv(spark: SparkSession, path: str, *, require_times: bool = True, bad_rows: str = "keep") -> DataFrame:
    """Typed candle CSV, columns by name; ``bad_rows`` as in ``read_messy_csv``. ``require_times`` raises ``ValueError``
    when rows exist and not one time can be read (stops at the first that can)."""
    return _typed(null_sentinels(_text_csv(spark, path, bad_rows)), CANDLE_SCHEMA, path, require_times)


def read_cleaned_csv(spark: SparkSession, path: str, *, infer: bool = False, require_times: bool = True) -> DataFrame:
    """Cleaned candle CSV. ``infer=True`` uses schema inference (one extra pass)."""
    if infer:
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    return _typed(null_sentinels(_text_csv(spark, path)), CLEANED_SCHEMA, path, require_times)


def utc_texts(df: DataFrame) -> DataFrame:
    """Times as text with their UTC offset: '2026-06-29 00:00:00+00:00'."""
    times = [c for c, kind in df.dtypes if kind == "timestamp_ntz"]
    return df.withColumns({c: F.translate(iso_utc(c), "T", " ") for c in times})


def _file_system(spark: SparkSession, *paths: str):
    """The Hadoop file system of the first path, and the paths in it."""
    places = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in paths]
    return places[0].getFileSystem(spark._jsc.hadoopConfiguration()), places


def _put_in_place(fs, new, dest, old) -> None:
    """Rename ``new`` to ``dest``; what was there is set aside first and comes
    back if the rename fails."""
    had = fs.exists(dest)
    if had and not fs.rename(dest, old):
        raise RuntimeError(f"cannot set {dest} aside")
    if not fs.rename(new, dest):
        if had:
            fs.rename(old, dest)
        raise RuntimeError(f"cannot rename the new part to {dest}")
    if had:
        fs.delete(old, True)


def _checked(df: DataFrame, path: str, expected: int, mode: str, write) -> None:
    """``write(df, path)``, counting the rows in the pass that writes them. The
    output takes its place only if there are ``expected`` rows; else it is
    removed, what was at ``path`` stays, and ``ValueError`` is raised."""
    if mode != "overwrite":
        raise ValueError("a row count can only be checked for a whole output (mode 'overwrite')")
    base = path.rstrip("/")
    fs, (new, dest, old) = _file_system(df.sparkSession, f"{base}.new", base, f"{base}.old")
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")), f"{base}.new")
    rows = seen.get.get("rows", 0)
    if rows != expected:
        fs.delete(new, True)
        raise ValueError(f"record count check failed: {rows} rows, expected {expected}; {path} is not written")
    _put_in_place(fs, new, dest, old)


def write_csv(
    df: DataFrame, path: str, columns: Sequence[str] | None = None, *, mode: str = "overwrite", expected: int | None = None
) -> None:
    """Directory of CSV part files with a header, in a fixed column order and
    times with their UTC offset. ``expected``: the number of rows that have to
    be written (see ``_checked``)."""

    def write(out: DataFrame, to: str) -> None:
        utc_texts(out).write.option("header", True).mode(mode).csv(to)

    out = df.select(*columns) if columns is not None else df
    write(out, path) if expected is None else _checked(out, path, expected, mode, write)


def write_single_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None, order_by: Sequence[str] = ()) -> str:
    """One CSV file at ``path`` (overwritten). Only for summary-sized results.

    ``repartition(1)`` keeps the work before it parallel; one task sorts the
    rows by ``order_by`` (an order from before is lost in the exchange) and
    writes the part into ``path + '.parts'``. The Hadoop file system renames it, so it
    works on any cluster file system; an old file is set aside first and comes
    back if the rename fails.
    """
    base = path.rstrip("/")
    one = df.repartition(1)
    write_csv(one.sortWithinPartitions(*order_by) if order_by else one, f"{base}.parts", columns)
    fs, (tmp_path, dest, old) = _file_system(df.sparkSession, f"{base}.parts", path, f"{base}.old")
    parts = [s.getPath() for s in fs.listStatus(tmp_path) if s.getPath().getName().startswith("part-")]
    if len(parts) != 1:
        raise RuntimeError(f"expected one CSV part in {base}.parts, found {len(parts)}")
    _put_in_place(fs, parts[0], dest, old)
    fs.delete(tmp_path, True)
    return path


def write_candles_parquet(
    df: DataFrame, path: str, *, mode: str = "overwrite", max_records_per_file: int = 5_000_000, expected: int | None = None
) -> None:
    """Candle table as Parquet partitioned by UTC ``open_date``.

    No repartition before the write: each task writes the dates it holds, so a
    hot date is spread over many tasks and files instead of landing in one.
    Readers then get partition pruning on date filters and column pruning.
    ``expected``: the number of rows that have to be written (see ``_checked``).
    """

    def write(out: DataFrame, to: str) -> None:
        rows = out.write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
        rows.partitionBy("open_date").parquet(to)

    out = df.withColumn("open_date", F.to_date("open_time"))
    write(out, path) if expected is None else _checked(out, path, expected, mode, write)


def read_candles_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Read a table written by ``write_candles_parquet`` (``open_date`` is a partition column)."""
    return spark.read.parquet(path)
