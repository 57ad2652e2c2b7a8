"""CSV scan and sink.

The inputs of the relevance problem are CSV files with a header row; every
field is read with an explicit schema (no inference pass over the data).
Files are written, and read unless told otherwise, as UTF-8; the published
input files are Latin-1 (``encoding="ISO-8859-1"``). A table whose quoted
text may hold line breaks needs ``multi_line=True``, which makes each file
one task; without it a file is split like any other.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

PAIRS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("product_uid", T.LongType()),
    T.StructField("product_title", T.StringType()),
    T.StructField("search_term", T.StringType()),
    T.StructField("relevance", T.DoubleType()),
])
TEST_PAIRS_SCHEMA = T.StructType(PAIRS_SCHEMA.fields[:4])
DESCRIPTIONS_SCHEMA = T.StructType([
    T.StructField("product_uid", T.LongType()),
    T.StructField("product_description", T.StringType()),
])
# keys may arrive as floats (rows with missing fields); clean_attributes casts
ATTRIBUTES_SCHEMA = T.StructType([
    T.StructField("product_uid", T.DoubleType()),
    T.StructField("name", T.StringType()),
    T.StructField("value", T.StringType()),
])
PREDICTIONS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("prediction", T.DoubleType()),
])

CSV_OPTIONS = {"header": "true", "encoding": "UTF-8", "escape": '"', "quote": '"'}


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             limit: int | None = None, order_by: str | None = None,
             encoding: str = "UTF-8", multi_line: bool = False) -> DataFrame:
    """Scan with a fixed schema. ``limit`` keeps the first rows (by
    ``order_by`` when given, which makes it deterministic)."""
    options = CSV_OPTIONS | {"encoding": encoding, "multiLine": str(multi_line).lower()}
    df = spark.read.options(**options).schema(schema).csv(path)
    if limit is not None:
        df = (df.orderBy(order_by) if order_by else df).limit(limit)
    return df


def read_csv_quarantine(spark: SparkSession, path: str, schema: T.StructType, encoding: str = "UTF-8",
                        multi_line: bool = False, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(good, bad) rows of a CSV scan under a fixed schema; every record is in one of the two.

    ``good`` has the columns of ``schema``. ``bad`` (file, raw, reason) holds each record that does not parse, as it stands in
    its file: of another number of fields than the schema ('fields'), or with a field that its type cannot hold ('type: '
    and the first such column). Nothing of a bad record gets into ``good`` as silent nulls. The scan is written once, so
    that both outputs come from the same parse."""
    corrupt = "_corrupt_record"
    options = CSV_OPTIONS | {"header": str(header).lower(), "encoding": encoding, "multiLine": str(multi_line).lower(),
                             "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    scan = (spark.read.options(**options).schema(T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])).csv(path)
            .withColumn("_file", F.col("_metadata.file_path")))
    rows = materialize(scan, "csv-scan")
    good = rows.where(F.col(corrupt).isNull()).select(*schema.names)
    # the same record as text fields tells which of the two reasons it is
    texts = ", ".join(f"`{f.name}` STRING" for f in schema.fields) + f", `{corrupt}` STRING"
    parsed = F.from_csv(F.col(corrupt), texts, {k: CSV_OPTIONS[k] for k in ("escape", "quote")} | {"columnNameOfCorruptRecord": corrupt})
    wrong = F.lit(None).cast("string")
    for f in reversed(schema.fields):
        if not isinstance(f.dataType, T.StringType):
            field = F.col("_parsed")[f.name]
            wrong = F.when(field.isNotNull() & field.try_cast(f.dataType).isNull(), F.lit(f"type: {f.name}")).otherwise(wrong)
    bad = (rows.where(F.col(corrupt).isNotNull()).withColumn("_parsed", parsed)
           .select(F.col("_file").alias("file"), F.col(corrupt).alias("raw"),
                   F.when(F.col("_parsed")[corrupt].isNotNull(), F.lit("fields")).otherwise(F.coalesce(wrong, F.lit("type"))).alias("reason")))
    return good, bad


def write_csv(df: DataFrame, path: str, single_file: bool = False,
              mode: str = "overwrite", encoding: str = "UTF-8") -> None:
    """Distributed CSV write (one file per task); ``single_file`` funnels
    the output through one task and is meant for small result sets only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).options(**CSV_OPTIONS | {"encoding": encoding}).csv(path)


def write_single_csv(df: DataFrame, path: str, order_by: str, encoding: str = "UTF-8") -> None:
    """One CSV file at ``path``, in the order of ``order_by``, with one header. The rows are sorted and formatted by all tasks
    into ordered parts beside it; only the finished bytes are then put together, by the file system's own concat, or where
    it has none by a streamed copy of one buffer at a time. The parts are deleted."""
    parts = f"{path}-parts-{uuid.uuid4().hex}"
    (df.repartitionByRange(F.asc_nulls_first(order_by)).sortWithinPartitions(F.asc_nulls_first(order_by))
     .write.options(**CSV_OPTIONS | {"header": "false", "encoding": encoding}).csv(parts))
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = where(path).getFileSystem(conf)
    files = sorted((s.getPath() for s in fs.listStatus(where(parts)) if s.getPath().getName().startswith("part-")), key=lambda p: p.getName())
    header = ",".join('"' + c.replace('"', '""') + '"' if set(c) & set(',"\n\r') else c for c in df.columns)
    out = fs.create(where(path), True)
    out.write(bytearray((header + "\n").encode(encoding)))
    out.close()
    try:
        if files:
            held = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(files))
            for i, f in enumerate(files):
                held[i] = f
            fs.concat(where(path), held)
    except Exception as e:  # noqa: BLE001 -- Spark's or py4j's form of a Java exception
        if "UnsupportedOperation" not in f"{type(e).__name__} {e}":
            raise
        out = fs.create(where(path), True)
        out.write(bytearray((header + "\n").encode(encoding)))
        for f in files:
            part = fs.open(f)
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, 1 << 16, False)
            part.close()
        out.close()
    fs.delete(where(parts), True)


def write_predictions(predictions: DataFrame, path: str, single_file: bool = False) -> None:
    """(id, prediction) as CSV in the folder ``path``: one file a task, or with ``single_file`` one file in the order of the
    ids. What the folder held before is replaced."""
    rows = predictions.select("id", "prediction")
    if single_file:
        folder = rows.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(rows.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
        write_single_csv(rows, f"{path.rstrip('/')}/part-00000.csv", "id")
    else:
        write_csv(rows, path)
