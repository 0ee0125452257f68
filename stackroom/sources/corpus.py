"""Corpus files: rows, inventory, row counts."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stackroom.functions.paths import RAW_SUFFIX, relative_path, scanned_file

INDEX_SUFFIX = "_id_idx.parquet"

#: A listing is narrow: so many tasks read it, however many files it names.
LISTING_TASKS = 32

_INVENTORY = "rel_path string, length bigint, modified timestamp"


def _parquet(spark: SparkSession) -> DataFrameReader:
    # recursiveFileLookup turns partition columns off: the rows come back with the
    # columns the files hold and no others.
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")


def listing(spark: SparkSession, path: str | list[str], names: str = "*.parquet") -> DataFrame | None:
    """``path, length, modificationTime`` of the files below a path (or several) whose names match
    the pattern (content unread), None when there is no such path."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    try:
        return reader.option("pathGlobFilter", names).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def path_exists(spark: SparkSession, path: str) -> bool:
    return listing(spark, path) is not None


def read_corpus(
    spark: SparkSession, *paths: str, merge_schema: bool = True, skip_damaged: bool = False
) -> DataFrame:
    """All rows of the parquet files below the given paths.

    With ``merge_schema`` every footer is read (by Spark, in parallel), so a
    column that only some files have is kept; without it one file decides.
    ``skip_damaged`` leaves out what cannot be read of a file; the caller counts rows.
    """
    reader = _parquet(spark).option("mergeSchema", str(merge_schema).lower())
    return reader.option("ignoreCorruptFiles", str(skip_damaged).lower()).parquet(*paths)


def file_inventory(spark: SparkSession, root: str, folder: str = "") -> DataFrame:
    """Relative path, byte length and modification time of every corpus file.

    Only listings are read, no content; empty files are listed too. ``folder``
    narrows the listing, the paths stay relative to ``root``.
    """
    where = f"{root.rstrip('/')}/{folder}" if folder else root
    files = listing(spark, where)
    if files is None:
        return spark.createDataFrame([], _INVENTORY)
    return files.select(
        relative_path(F.col("path"), root).alias("rel_path"),
        "length",
        F.col("modificationTime").alias("modified"),
    )


def _counted(rows: DataFrame, root: str, *extra: Column) -> DataFrame:
    # Group on the path as the scan gives it; make it relative once per file.
    per_file = rows.groupBy(F.col("_metadata.file_path").alias("uri")).agg(
        F.count(F.lit(1)).alias("n_rows"), *extra
    )
    return per_file.withColumn("rel_path", _of_uri(root)).drop("uri")


def _of_uri(root: str) -> Column:
    return relative_path(F.url_decode(F.replace("uri", F.lit("+"), F.lit("%2B"))), root)


def _below(root: str, folders: tuple[str, ...]) -> list[str]:
    return [f"{root.rstrip('/')}/{folder}" for folder in folders] or [root]


def _refuse_files_without_bytes(rows: DataFrame, root: str, paths: list[str]) -> None:
    """Scans and listings pass over files of length 0; only the scan's own list of files has them."""
    spark = rows.sparkSession
    named = spark.createDataFrame([(uri,) for uri in rows.inputFiles()], "uri string")
    with_bytes = listing(spark, paths).select(relative_path(F.col("path"), root).alias("rel_path"))
    found = named.select(_of_uri(root).alias("rel_path")).join(with_bytes, "rel_path", "left_anti")
    names = sorted(row["rel_path"] for row in found.collect())
    if names:
        raise ValueError(f"no parquet files, they hold no bytes: {', '.join(names)}")


def file_row_counts(
    spark: SparkSession, root: str, *folders: str, skip_damaged: bool = False
) -> DataFrame:
    """Rows per file (of the whole root or some folders of it) from the footers: the scan
    asks for no column.

    A file without rows has no line here. One whose footer cannot be read is an error, at once if
    it holds no bytes, else when the counts are. ``skip_damaged`` leaves it without a line as
    well; the caller tells the two apart.
    """
    files = _parquet(spark).option("ignoreCorruptFiles", str(skip_damaged).lower()).schema("id string")
    if not skip_damaged:
        files = files.option("ignoreMissingFiles", "false")
    paths = _below(root, folders)
    rows = files.parquet(*paths)
    if not skip_damaged:
        _refuse_files_without_bytes(rows, root, paths)
    return _counted(rows, root).select("rel_path", "n_rows")


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.MapType):
        return True
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_has_map(field.dataType) for field in kind.fields)
    return False


def decoded_row_counts(spark: SparkSession, root: str, *folders: str) -> DataFrame:
    """Rows per file after decoding every column, so damaged pages show.

    ``content_hash`` is what forces the decoding: use it downstream (or keep it),
    else Spark prunes the columns and counts from the footers. A damaged file has
    a short count or no line.
    """
    rows = (
        _parquet(spark)
        .option("ignoreCorruptFiles", "true")
        .option("mergeSchema", "true")
        .parquet(*_below(root, folders))
    )
    # Maps cannot be hashed; their JSON text can.
    columns = [
        F.to_json(F.struct(F.col(f"`{field.name}`"))) if _has_map(field.dataType) else F.col(f"`{field.name}`")
        for field in rows.schema.fields
    ]
    content = F.bit_xor(F.xxhash64(*columns)).alias("content_hash")
    return _counted(rows, root, content).select("rel_path", "n_rows", "content_hash")


def with_file_position(rows: DataFrame, root: str) -> DataFrame:
    """Add the relative file and the row's 0-based position in it to scanned rows."""
    return rows.withColumns(
        {
            "parquet_file": scanned_file(root),
            "file_row_number": F.col("_metadata.row_index"),
        }
    )


def datasets_in(inventory: DataFrame) -> DataFrame:
    """Dataset folders holding files, sorted; raw staging folders and indexes excluded."""
    name = F.substring_index("rel_path", "/", 1)
    return (
        inventory.where(F.col("rel_path").contains("/"))
        .select(name.alias("dataset"))
        .where(
            ~F.col("dataset").startswith(".")
            & ~F.col("dataset").endswith(RAW_SUFFIX)
            & ~F.col("dataset").endswith(INDEX_SUFFIX)
        )
        .distinct()
        .orderBy("dataset")
    )


def dataset_folders(spark: SparkSession, parquet_dir: str) -> list[str]:
    """Names of the dataset folders, sorted, whether they hold files or not.

    One listing of the file system, of one level.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(parquet_dir)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return []
    names = [entry.getPath().getName() for entry in files.listStatus(root) if entry.isDirectory()]
    return sorted(
        n for n in names if not n.startswith((".", "_")) and not n.endswith((RAW_SUFFIX, INDEX_SUFFIX))
    )


def unreadable_files(spark: SparkSession, root: str, names: list[str]) -> dict[str, str]:
    """Errors of the files whose footers cannot be read.

    All are opened in one job; only where that fails, both halves are tried in turn. So empty
    files, however many, cost one job, and each damaged one about as many as the listing has bits.
    """
    if not names:
        return {}
    try:
        files = _parquet(spark).option("ignoreCorruptFiles", "false").schema("id string")
        files.parquet(*[f"{root.rstrip('/')}/{name}" for name in names]).select().write.format("noop").mode("append").save()
        return {}
    except Exception as error:  # any reason makes it a failure row
        if len(names) == 1:
            return {names[0]: str(error)}
    half = len(names) // 2
    return unreadable_files(spark, root, names[:half]) | unreadable_files(spark, root, names[half:])


def distinct_strings(rows: DataFrame, column: str) -> DataFrame:
    """Distinct values of one string column, nulls dropped."""
    return rows.select(column).where(F.col(column).isNotNull()).distinct()
