"""CSV tables. Every column is text; fields may be very large and hold line breaks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metaferry.operators.config import config_rows
from metaferry.operators.inventory import clean_pairs, clean_single, migrated_assets
from metaferry.operators.tags import tag_rows

# Column layout of an asset mapping file.
MAPPING_COLUMNS = ("source_id", "source_uid", "target_id", "target_uid", "tags", "source_asset_type")

# How catalog files are quoted; fields of any size, with line breaks.
READ_OPTIONS = {"multiLine": "true", "quote": '"', "escape": '"', "maxCharsPerColumn": "-1", "mode": "PERMISSIVE"}


def read_headed(
    spark: SparkSession, path: str | list[str], columns: Sequence[str] | None = None, recursive: bool = False
) -> DataFrame:
    """CSV files with header. With ``columns`` the header is skipped and columns go by position.

    ``recursive`` takes all ``.csv`` files below a folder. As fields may hold line
    breaks, every file is one task, whatever its size.
    """
    reader = spark.read.options(**READ_OPTIONS).option("header", "true")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[cC][sS][vV]")
    if columns is not None:
        reader = reader.schema(", ".join(f"`{name}` string" for name in columns))
    return reader.csv(path)


# A row's number within its task has 33 bits.
_ROW_BITS = 33


def _plain(path: Column) -> Column:
    """A path with one slash behind its scheme; Spark writes one or three."""
    return F.regexp_replace(path, "^([A-Za-z0-9]+):/+", "$1:/")


def read_ordered(
    spark: SparkSession, path: str | list[str], columns: Sequence[str] | None = None, recursive: bool = False
) -> DataFrame:
    """As ``read_headed``, with an ``ordinal`` that follows the path of the file, then the rows in it.

    Only the names of the files are sorted, by the driver, which has listed them
    anyway. A file is never split, so the row number within its task grows with it.
    """
    return _in_file_order(read_headed(spark, path, columns, recursive))


def _in_file_order(rows: DataFrame) -> DataFrame:
    """Rows straight from a reader with an ``ordinal`` by path of the file and row in it."""
    spark, names = rows.sparkSession, rows.columns
    ranks = spark.createDataFrame(
        [(name, rank) for rank, name in enumerate(sorted(rows.inputFiles()))], "_path string, _rank bigint"
    ).withColumn("_path", _plain(F.col("_path")))
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    numbered = rows.select("*", _plain(F.col("_metadata.file_path")).alias("_path"), row.alias("_row"))
    ordinal = F.shiftleft("_rank", _ROW_BITS).bitwiseOR(F.col("_row")).alias("ordinal")
    return numbered.join(ranks, "_path").select(*names, ordinal)


def read_pairs(spark: SparkSession, path: str, names: Sequence[str] = ("source_env", "target_env")) -> DataFrame:
    return clean_pairs(read_headed(spark, path, names))


def read_single(spark: SparkSession, path: str, name: str = "uid") -> DataFrame:
    return clean_single(read_headed(spark, path, [name]))


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Migrated assets of a mapping file; files without the type column are read as well."""
    return migrated_assets(read_headed(spark, path, MAPPING_COLUMNS))


def read_checked(spark: SparkSession, path: str, required: Sequence[str]) -> DataFrame:
    """A CSV file that must have exactly the required header."""
    df = read_headed(spark, path)
    if list(df.columns) != list(required):
        raise ValueError(f"expected columns {list(required)}, found {df.columns}")
    return df


def read_tag_rows(spark: SparkSession, path: str) -> DataFrame:
    return tag_rows(read_headed(spark, path))


def read_config_rows(spark: SparkSession, path: str) -> DataFrame:
    """Configuration rows; a file without a header line is read from its first line on.

    Looks at the first line of the file while the plan is built.
    """
    bare = spark.read.options(**READ_OPTIONS).option("header", "false")
    first = bare.csv(path).head(1)
    if not first:
        raise ValueError(f"empty file: {path}")
    cells = [cell or "" for cell in first[0]]
    if "target_uid" in cells[0].lower() or (len(cells) > 1 and "config_json" in cells[1].lower()):
        return config_rows(read_headed(spark, path))
    names = ["target_uid", "config_json", "source_uid"][: len(cells)]
    return config_rows(bare.schema(", ".join(f"{n} string" for n in names)).csv(path))


def read_policy_list(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Policy list rows as wide as the header, in file order; other rows are dropped."""
    corrupt = "_corrupt"
    schema = ", ".join(f"`{c}` string" for c in [*columns, corrupt])
    reader = spark.read.options(**READ_OPTIONS).option("header", "true").option("columnNameOfCorruptRecord", corrupt)
    rows = _in_file_order(reader.schema(schema).csv(path))
    return rows.filter(rows[corrupt].isNull()).drop(corrupt)
