"""CSV scan and sink: encodings, quotes, embedded newlines, splits, empty -> NULL; the shared folder."""

import os
import tempfile

from pairscore.sources import csv_io


def test_csv_scan_latin1_quotes_newlines(spark):
    d = tempfile.mkdtemp(prefix="pairscore-csv-")
    path = os.path.join(d, "pairs.csv")
    text = ('id,product_uid,product_title,search_term,relevance\n'
            '1,100,"Caf\xe9 table, ""oak""","table",2.5\n'
            '2,101,"two\nlines","",3\n')
    with open(path, "wb") as fh:
        fh.write(text.encode("latin-1"))
    latin = {"encoding": "ISO-8859-1", "multi_line": True}
    rows = csv_io.read_csv(spark, path, csv_io.PAIRS_SCHEMA, **latin).orderBy("id").collect()
    assert rows[0].product_title == 'Café table, "oak"' and rows[0].relevance == 2.5
    assert rows[1].product_title == "two\nlines" and rows[1].search_term is None
    head = csv_io.read_csv(spark, path, csv_io.PAIRS_SCHEMA, limit=1, order_by="id", **latin).collect()
    assert [r.id for r in head] == [1]


def test_predictions_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="pairscore-csv-")
    df = spark.createDataFrame([(1, 2.25), (2, 1.5)], "id long, prediction double")
    out = os.path.join(d, "pred")
    csv_io.write_predictions(df.withColumn("extra", df.id), out, single_file=True)
    back = csv_io.read_csv(spark, out, csv_io.PREDICTIONS_SCHEMA).orderBy("id").collect()
    assert [tuple(r) for r in back] == [(1, 2.25), (2, 1.5)]
    assert len([f for f in os.listdir(out) if f.endswith(".csv")]) == 1


def test_materialize_uses_the_configured_checkpoint_dir():
    """A cluster names the shared folder in spark.checkpoint.dir; intermediate
    tables must go there (a scratch folder is made only when it is unset)."""
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shared = tempfile.mkdtemp(prefix="pairscore-shared-")
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')"
        ".config('spark.checkpoint.dir', %r).getOrCreate()\n"
        "from pairscore.session import ensure_checkpoint_dir, materialize\n"
        "print(ensure_checkpoint_dir(s))\n"
        "print(materialize(s.range(10), 't').inputFiles()[0])\n" % (repo, shared))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True,
                         timeout=300, cwd="/")
    assert out.returncode == 0, out.stderr[-2000:]
    lines = out.stdout.strip().splitlines()
    assert lines[0] == shared
    assert shared in lines[1]


def test_utf8_round_trip_keeps_every_character(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="pairscore-csv-"), "t")
    titles = ["Łódź 日本", 'a "q", b', "two\nlines", "é", None]
    df = spark.createDataFrame([(i, i, t, "x", 1.0) for i, t in enumerate(titles)], csv_io.PAIRS_SCHEMA)
    csv_io.write_csv(df, out)
    back = csv_io.read_csv(spark, out, csv_io.PAIRS_SCHEMA, multi_line=True).orderBy("id").collect()
    assert [r.product_title for r in back] == titles


def test_a_file_without_line_breaks_is_read_in_splits(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="pairscore-csv-"), "t")
    csv_io.write_csv(spark.range(40_000).selectExpr("id", "id / 4 as prediction").coalesce(1), out)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = csv_io.read_csv(spark, out, csv_io.PREDICTIONS_SCHEMA)
        assert df.selectExpr("spark_partition_id() as p").distinct().count() > 3
        assert df.count() == df.distinct().count() == 40_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def _run(code):
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    head = "import sys; sys.path.insert(0, %r)\nfrom pyspark.sql import SparkSession\n" % repo
    return subprocess.run([sys.executable, "-c", head + code], capture_output=True, text=True, timeout=300, cwd="/")


def test_stage_tables_can_be_removed():
    shared = tempfile.mkdtemp(prefix="pairscore-shared-")
    out = _run(
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')"
        f".config('spark.checkpoint.dir', {shared!r}).getOrCreate()\n"
        "from pairscore.session import materialize, remove_stages\n"
        "import os\n"
        "f = materialize(s.range(10), 't').inputFiles()[0]\n"
        "print(f); print(remove_stages(s), os.path.exists(f.replace('file://', '')))\n")
    assert out.returncode == 0, out.stderr[-2000:]
    first, second = out.stdout.strip().splitlines()[-2:]
    assert shared in first and second == "True False"


def _session(master, folder):
    from types import SimpleNamespace
    made = []
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: (made or [folder])[-1], setCheckpointDir=made.append)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))


def test_a_folder_set_on_the_context_is_used():
    from pairscore.session import ensure_checkpoint_dir
    assert ensure_checkpoint_dir(_session("spark://host:7077", "hdfs://x/y")) == "hdfs://x/y"
    local = _session("local[4]", None)
    assert ensure_checkpoint_dir(local) == ensure_checkpoint_dir(local)


def test_a_cluster_without_a_shared_folder_is_an_error():
    import pytest

    from pairscore.session import ensure_checkpoint_dir
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_session("spark://host:7077", None))
