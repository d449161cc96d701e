"""Sinks and scans of each file format, with awkward values."""

import subprocess
import sys

from results import rows

from millrace.operators import graph
from millrace.plans import file_queries
from millrace.session import discard, scratch, stored
from millrace.sources import readers, writers

ODD = ['say "hi"', "a\tb", "two\nlines", " padded ", "", None, "back\\slash", "c\r\nd", '"', "é, ü; 'x'"]


def test_lines(spark):
    path = scratch(spark)
    df = spark.createDataFrame([(t,) for t in ODD], "value string").repartition(3)
    writers.write_lines(df, path)
    want = sorted(line for t in ODD for line in (t or "").split("\n"))
    assert sorted(r.value for r in readers.text_lines(spark, path, line_sep="\n").collect()) == want
    assert sorted(r.value for r in readers.text_lines(spark, path).collect()) == sorted(w.removesuffix("\r") for w in want)


def test_tsv(spark):
    path = scratch(spark)
    df = spark.createDataFrame([(str(i), i % 2, t, "body") for i, t in enumerate(ODD)], readers.MAIL).repartition(3)
    writers.write_tsv(df, path)
    flat = lambda t: t.translate(str.maketrans("\t\n\r", "   ")) if t else None
    assert rows(readers.mail(spark, path)) == {(str(i), i % 2, flat(t), "body") for i, t in enumerate(ODD)}


def test_ngram_files_are_gzipped(spark, tmp_path, monkeypatch):
    """The n-gram files carry the suffix, and their scan gives the same rows."""
    texts = ["It was the best of times, it was", "it was the best of times", None, ""]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(file_queries, "scratch", lambda spark: f"{tmp_path}/out")
    found = file_queries.QUERIES["file_ngrams"][0](spark, str(tmp_path))
    want = {("it was the best of", 2, 2, 2), ("was the best of times", 2, 2, 2), ("the best of times it", 1, 1, 1), ("best of times it was", 1, 1, 1)}
    assert rows(found) == want and found.count() == len(want)
    files = [p.name for p in (tmp_path / "out").glob("part-*")]
    assert files and all(name.endswith(".csv.gz") for name in files)


def test_delimited(spark):
    path = scratch(spark)
    odd = [t for t in ODD if t is None or "\n" not in t]
    df = spark.createDataFrame([(i, t, i / 3) for i, t in enumerate(odd)], "n int, t string, v double").repartition(3)
    for sep in (",", ";"):
        writers.write_delimited(df, path, sep)
        assert rows(readers.delimited(spark, path, "n int, t string, v double", sep)) == rows(df)


def test_by_header(spark):
    path = scratch(spark)
    df = spark.createDataFrame([(1, "x", "2.5"), (2, 'y,"z"', "no"), (None, "", None)], "a int, b string, c string").repartition(3)
    writers.write_delimited(df, path)
    want = {(2.5, 1), (None, 2), (None, None)}
    assert rows(readers.by_header(spark, path, "c double, a int")) == want
    assert rows(readers.by_header(spark, path, "c double, a int", ["a", "b", "c"])) == want


def test_features_and_label(spark):
    df = spark.createDataFrame([(1, 2.0, "3"), (4, None, "5")], "a int, b double, c string")
    assert [(r.features, r.label) for r in readers.features_and_label(df).orderBy("label").collect()] == [([1.0, 2.0], 3.0), ([4.0, None], 5.0)]


def test_adjacency(spark):
    path = scratch(spark)
    edges = spark.createDataFrame([("a", "b'c", 2), ("a", 'd"e', 1), ("a", "back\\slash", 4), ("b'c", "a", 1), ("hub", "x{}:, '", 9)], "src string, dst string, weight int")
    writers.write_adjacency(graph.adjacency_list(edges, part=1), path)
    assert rows(readers.adjacency_edges(spark, path)) == rows(edges)


def test_discard(spark):
    df = stored(spark.range(10))
    assert df.count() == 10
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._stored_at)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert files.exists(path)
    discard(df)
    assert not files.exists(path)


def test_files_go_after_stop(tmp_path):
    code = f"""
from millrace.session import build_session, stored
spark = build_session("gone", "local[1]", **{{"spark.checkpoint.dir": "file://{tmp_path}/shared"}})
print(stored(spark.range(3)).count())
spark.stop()
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, cwd=sys.path[0].removesuffix("/tests"))
    assert done.stdout.split() == ["3"], done.stderr[-500:]
    assert not [p for p in (tmp_path / "shared").glob("stored-*/*")]
