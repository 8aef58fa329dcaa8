"""Readers and writers for the banking files."""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from .. import schema as S

EXTENSIONS = {"csv": "csv", "json": "jsonl"}


def scan_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header, matched to a schema by column name, in whatever order the file has them.

    Known columns get their type (a value that does not parse is null), unknown ones stay as text,
    and a column that the file lacks is absent, for the checks to notice.  A folder whose files
    disagree about the header is an error.
    """
    header = spark.read.option("header", True).csv(path).columns
    texts = T.StructType([T.StructField(c, T.StringType()) for c in header])
    raw = spark.read.schema(texts).option("header", True).option("enforceSchema", False).csv(path)
    types = {f.name: f.dataType for f in schema}
    return raw.select(*[F.col(f"`{c}`").try_cast(types[c.strip()]).alias(c)
                        if c.strip() in types else F.col(f"`{c}`") for c in header])


def scan_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON object per line; unknown keys are ignored, missing ones are null."""
    return spark.read.schema(schema).json(path)


def normalise_columns(df: DataFrame, expected: list) -> DataFrame:
    """Trim names, put the expected columns first and keep unknown extras at the end."""
    trimmed = df.toDF(*[c.strip() for c in df.columns])
    known = [c for c in expected if c in trimmed.columns]
    return trimmed.select(*known, *[c for c in trimmed.columns if c not in known])


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def state(spark: SparkSession, path: str) -> tuple:
    """Size and latest change of a folder's files: differs as soon as the input does."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    latest = max((f.getModificationTime() for f in system.listStatus(target)), default=0)
    return system.getContentSummary(target).getLength(), latest


def require(spark: SparkSession, paths: dict) -> dict:
    """All inputs must exist before any of them is used."""
    missing = sorted(name for name, path in paths.items() if not exists(spark, path))
    if missing:
        raise FileNotFoundError(f"required inputs are missing: {missing}")
    return paths


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    kind = S.FORMATS[name]
    path = f"{folder}/{name}.{EXTENSIONS[kind]}"
    require(spark, {name: path})
    reader = scan_csv if kind == "csv" else scan_jsonl
    return normalise_columns(reader(spark, path, S.TABLES[name]), S.TABLES[name].fieldNames())


def load_all(spark: SparkSession, folder: str) -> dict:
    """The six-table bundle; a missing file is an error."""
    require(spark, {n: f"{folder}/{n}.{EXTENSIONS[k]}" for n, k in S.FORMATS.items()})
    return {name: load_table(spark, folder, name) for name in S.TABLES}


def load_parquet(spark: SparkSession, folder: str, names: list) -> dict:
    """Published stage tables, lazily, once all are known to exist."""
    require(spark, {name: f"{folder}/{name}" for name in names})
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}


def _flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, for formats without nesting."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return df.select(*[F.to_json(c).alias(c) if isinstance(df.schema[c].dataType, nested)
                       else F.col(c) for c in df.columns])


def write_table(df: DataFrame, path: str, kind: str = "parquet",
                partition_by: list | None = None) -> str:
    """Publish a table as parquet, CSV or JSON lines; facts may be partitioned by their date key.

    With a partition column the rows are rebalanced by it first: adaptive execution splits a busy
    date over as many tasks as its size needs and merges quiet ones into few files.
    """
    out = _flat(df) if kind == "csv" else df
    if kind == "json":
        out = sorted_keys(out)
    if partition_by:
        out = out.hint("rebalance", *partition_by)
    micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"  # the text formats keep milliseconds by default
    writer = out.write.mode("overwrite")
    if kind in ("csv", "json"):
        writer = writer.option("timestampNTZFormat", micros).option("timestampFormat", micros)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if kind == "csv":
        writer.option("header", True).csv(path)
    elif kind == "json":
        writer.option("ignoreNullFields", False).json(path)
    else:
        writer.parquet(path)
    return path


def sorted_keys(df: DataFrame) -> DataFrame:
    """Columns in alphabetical order, which is the key order of the JSON lines."""
    return df.select(*sorted(df.columns))
