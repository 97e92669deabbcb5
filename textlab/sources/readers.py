"""File readers.

All fields are read as strings with an explicit schema (never inferred) and
typed afterwards with ``try_cast``.  Every reader adds ``_ord``: a struct of
(file path, split start, row id) whose natural ordering is the file order, so
order-sensitive steps (keep-last dedupe, ordered prediction files) survive
Spark's lack of row order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.labels import null_tokens
from .quoted import is_open, quoted_records, without_quoted

# Column layouts of the three input files.
CORPUS_COLUMNS = ["record_id", "article_id", "keyword", "country", "text", "raw_label"]
TEST_COLUMNS = ["sample_id", "article_id", "keyword", "country", "text"]
SPLIT_REQUIRED = ("par_id", "label")
SCORED_REQUIRED = ("y_true", "y_pred", "text")
# The parser's column for the raw text of records that have not as many fields as the schema.
RAW = "_raw"
# Types of the scored-detail columns that are no text.
SCORED_TYPES = {
    "record_id": "bigint", "article_id": "bigint", "binary_label": "int", "y_true": "int", "y_pred": "int",
    "score": "double", "prob_pos": "double", "mistake_strength": "double",
}


def _string_schema(names) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


def file_order() -> F.Column:
    """Sortable position of a row in its input files (S1-S3 `_ord`)."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def _tsv(spark: SparkSession, path, names, multi_line: bool) -> DataFrame:
    """Fields of headerless TSV records, their raw text where their number is not that of ``names``, and ``_ord``.

    DROPMALFORMED is not used: its result depends on the selected columns;
    column pruning is off, as it would hide a wrong number of fields.
    """
    if multi_line:
        return _fields(quoted_records(spark, path, "\t"), list(names), "\t").select(*names, F.col("_record").alias(RAW), "_ord")
    return (
        spark.read.schema(_string_schema(list(names) + [RAW]))
        .option("sep", "\t").option("header", False)
        .option("quote", '"').option("escape", '"')
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAW)
        .option("columnPruning", False)
        .csv(path)
        .withColumn("_ord", file_order())
        # always true; Spark refuses to read the raw text alone, as for a count
        .filter(F.coalesce(F.length(names[0]), F.lit(0)) >= 0)
    )


def _fields(records: DataFrame, names: list[str], sep: str) -> DataFrame:
    """The fields of assembled records beside them: quotes taken off, text after a closing quote as it is, bare empty fields null.

    The fields leave a generator: a filter on them is not pushed below it,
    where each mention of a field would take the record apart anew.
    """
    quoted = r'^"([^"]*+(?:""[^"]*+)*+)"'
    every = F.regexp_extract_all(F.concat(F.lit(sep), "_record"), F.lit(rf'{sep}("[^"]*+(?:""[^"]*+)*+"[^{sep}]*+|[^{sep}]*+)'), F.lit(1))
    records = records.withColumn("_f", F.when(F.contains("_record", F.lit('"')), every).otherwise(F.split("_record", sep, -1)))

    def value(i: int) -> F.Column:
        raw = F.get("_f", F.lit(i))
        inner = F.replace(F.regexp_extract(raw, quoted, 1), F.lit('""'), F.lit('"'))
        return F.when(raw.startswith('"') & raw.rlike(quoted), F.concat(inner, F.regexp_replace(raw, quoted, ""))).when(raw != "", raw)

    fields = F.struct(*(value(i).alias(n) for i, n in enumerate(names)))
    return records.select(*records.columns, F.inline(F.array(fields))).drop("_f")


def n_fields(names) -> F.Column:
    """Fields of a record: tabs outside quoted fields, plus one."""
    raw = without_quoted(F.col(RAW), "\t")
    return F.when(F.col(RAW).isNull(), F.lit(len(names))).otherwise(F.length(raw) - F.length(F.translate(raw, "\t", "")) + 1)


def closed(path, what: str) -> F.Column:
    """True; raises, naming the record, where a quoted field is not closed at the end of its line."""
    broken = F.col(RAW).isNotNull() & is_open(F.col(RAW), "\t")
    said = F.concat(F.lit(f"{what}: a quoted field runs over the end of a line (read with multi_line=True): "), F.substring(RAW, 1, 200))
    return F.when(broken, F.raise_error(said).cast("boolean")).otherwise(F.lit(True))


def with_na_tokens(df: DataFrame, columns) -> DataFrame:
    """Whole-field NA tokens -> null on the given columns."""
    return df.withColumns({c: null_tokens(c) for c in columns})


def read_corpus(spark: SparkSession, path, multi_line: bool = False) -> DataFrame:
    """Headerless 6-field corpus TSV; records with extra fields, empty ones too, are skipped.

    Short records are kept with nulls, as the reference's reader pads them; the
    validity filter (P1) removes them later.  A quoted field may hold line
    breaks only with ``multi_line``, which scans the files twice, in splits both
    times; without it one scan does and such a record is an error, never a loss.
    """
    raw = _tsv(spark, path, CORPUS_COLUMNS, multi_line).filter(n_fields(CORPUS_COLUMNS) <= len(CORPUS_COLUMNS))
    if not multi_line:
        raw = raw.filter(closed(path, "corpus"))
    return with_na_tokens(raw.drop(RAW), CORPUS_COLUMNS)


def read_test(spark: SparkSession, path, multi_line: bool = False) -> DataFrame:
    """Headerless 5-field test TSV; a record with extra fields is an error when it is read (S3)."""
    said = F.concat(F.lit(f"test: a record has more than {len(TEST_COLUMNS)} fields: "), F.substring(RAW, 1, 200))
    long = n_fields(TEST_COLUMNS) > len(TEST_COLUMNS)
    raw = _tsv(spark, path, TEST_COLUMNS, multi_line)
    raw = raw.filter(F.when(long, F.raise_error(said).cast("boolean")).otherwise(F.lit(True)))
    if not multi_line:
        raw = raw.filter(closed(path, "test"))
    return with_na_tokens(raw.drop(RAW), TEST_COLUMNS)


def require_columns_named(columns, required, what: str) -> None:
    missing = set(required).difference(columns)
    if missing:
        raise ValueError(f"{what}: no column {', '.join(sorted(missing))}")


def require_columns(df: DataFrame, required, what: str) -> DataFrame:
    """Schema-only check that the required columns exist (no job)."""
    require_columns_named(df.columns, required, what)
    return df


def read_split(spark: SparkSession, path: str) -> DataFrame:
    """Split CSV with header `par_id,label`."""
    header = spark.read.option("header", True).csv(path).columns  # reads the header line only
    missing = set(SPLIT_REQUIRED).difference(header)
    if missing:
        raise ValueError(f"{path}: no column {', '.join(sorted(missing))} among {', '.join(header)}")
    df = (
        spark.read.schema(_string_schema(header)).option("header", True)
        .option("quote", '"').option("escape", '"').csv(path)
        .withColumn("_ord", file_order())
    )
    return with_na_tokens(df, header)


def read_scored(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Scored-detail table written by ``write_scored``, with typed columns.

    Parquet is the format for large tables; CSV is read in splits with line
    breaks allowed inside quoted fields.  Every file has the header.
    """
    if fmt == "parquet":
        df = spark.read.parquet(path)
    else:
        header = spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path).columns  # the header line only
        require_columns_named(header, SCORED_REQUIRED, path)
        df = _fields(quoted_records(spark, path, ",").filter(~F.col("_head")), header, ",").select(*header)
        df = df.withColumns({c: F.col(c).cast(SCORED_TYPES[c]) for c in df.columns if c in SCORED_TYPES})
    return require_columns(df, SCORED_REQUIRED, path)
