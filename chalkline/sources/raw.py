"""Raw files with declared columns: CSV, JSON and workbooks.

Every column of a file is read, declared or not: rows are duplicates only if they agree in all.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chalkline import schemas
from chalkline.functions.text import number, quoted
from chalkline.sources.workbook import read_workbooks
from chalkline.vocabulary import NA_TOKENS


def without_na_tokens(df: DataFrame) -> DataFrame:
    """Text that stands for a missing value becomes NULL in every text column."""
    return df.withColumns({
        f.name: F.when(~quoted(f.name).isin(*NA_TOKENS), quoted(f.name))
        for f in df.schema if isinstance(f.dataType, T.StringType)
    })


def _declared_first(df: DataFrame, schema: T.StructType, missing_as_null: bool = False) -> DataFrame:
    """The declared columns by name, then all others as they are.

    Counts are numbers with their fraction kept, so that 40.9 of 40.5 pupils stays visible;
    a text that is no number is NULL. A declared column that the input lacks is an error.
    """
    absent = [name for name in schema.names if name not in df.columns]
    if absent and not missing_as_null:
        raise ValueError(f"columns not found by heading: {', '.join(absent)}")
    declared = []
    for f in schema:
        value = F.lit(None).cast("string") if f.name in absent else F.col(f.name)
        if not isinstance(f.dataType, T.StringType):
            value = number(value.cast("string"))
        declared.append(value.alias(f.name))
    return df.select(*declared, *[quoted(c) for c in df.columns if c not in schema.names])


def read_csv(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> DataFrame:
    """CSV with a header row; columns are found by heading and others kept as text.

    Missing-value texts are NULL. A heading that is missing, files of one path with different
    headings and rows with more or fewer fields than the heading are errors. Quoted line ends need
    `multiLine="true"`, which stops a file from being split.
    """
    settings = {"header": True, "escape": '"', "enforceSchema": False, "mode": "FAILFAST",
                "columnPruning": False} | options
    # Headings alone first: the files' own order becomes the schema that every file is held to.
    names = spark.read.options(**settings).csv(path).columns
    text = T.StructType([T.StructField(name, T.StringType()) for name in names])
    rows = spark.read.options(**settings).schema(text).csv(path)
    return _declared_first(without_na_tokens(rows), schema)


def read_json(
    spark: SparkSession, path: str, schema: T.StructType, lines: bool = False,
    others: T.StructType | None = None,
) -> DataFrame:
    """JSON records; numbers in text columns keep their spelling (`10` and `10.0` differ).

    A key that a record lacks is NULL, a record that is no JSON an error. Undeclared keys are kept;
    a pass over the input finds them unless `others` names them. A file that holds one array of
    records cannot be split: a task reads it whole. Large data should come as one record per line
    (`lines=True`) or as many files.
    """
    reader = spark.read.options(multiLine=not lines, mode="FAILFAST")
    if others is None:
        found = reader.option("primitivesAsString", True).json(path).schema
        others = T.StructType([f for f in found if f.name not in schema.names])
    whole = T.StructType([T.StructField(f.name, T.StringType()) for f in schema] + list(others))
    return _declared_first(reader.schema(whole).json(path), schema, missing_as_null=True)


def read_excel(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """First sheets of all workbooks under a path; columns are found by heading, others kept as text."""
    return _declared_first(without_na_tokens(read_workbooks(spark, path, schema.names)), schema)


def read_raw(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """The five raw datasets by name; the format follows the end of each path.

    `.json` is an array of records, `.jsonl` one record per line, `.xlsx` a workbook, `.parquet`
    a table with at least the raw columns, anything else CSV. A directory takes the ending it is named with.
    """
    frames = {}
    for name, path in paths.items():
        schema = schemas.RAW_SCHEMAS[name]
        ending = path.rstrip("/").rsplit(".", 1)[-1].lower()
        if ending in ("json", "jsonl"):
            frames[name] = read_json(spark, path, schema, lines=ending == "jsonl")
        elif ending == "xlsx":
            frames[name] = read_excel(spark, path, schema)
        elif ending == "parquet":
            frames[name] = _declared_first(spark.read.parquet(path), schema)
        else:
            frames[name] = read_csv(spark, path, schema)
    return frames
