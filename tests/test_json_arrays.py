"""JSON arrays and split documents read in several tasks: brackets and quotes in strings, any layout, bad files."""

import json
import os

import pytest
from pyspark.sql import types as T

from presslens.operators.sinks import write_json_arrays, write_split_json
from presslens.sources.files import read_json_auto, read_split_json
from presslens.sources.json_arrays import json_records, read_json_array

SCHEMA = T.StructType([T.StructField("i", T.LongType()), T.StructField("s", T.StringType()), T.StructField("x", T.ArrayType(T.StringType())),
                       T.StructField("o", T.StructType([T.StructField("k", T.StringType())]))])
ODD = ['plain', '}', '{"a": [1}]', 'quote " and \\" and \\\\', '\\', '"', '"}, {"', '[{', ']]', 'line\nbreak', 'é }€{', '', ',,', '}' * 50, '\\\\"}']


def _rows(n):
    return [(i, ODD[i % len(ODD)] + (str(i) if i % 2 else ""), [ODD[(i + k) % len(ODD)] for k in range(i % 4)], {"k": ODD[(3 * i) % len(ODD)]})
            for i in range(n)]


@pytest.fixture
def small_splits(spark):
    """Splits of about 2 kB, so that a file of some kB is read by several tasks."""
    names = {"spark.sql.files.maxPartitionBytes": "2k", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "8"}
    old = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("indent, separators", [(None, (",", ":")), (None, (", ", ": ")), (2, None)])
def test_array_in_several_tasks(spark, scratch, small_splits, indent, separators):
    rows = _rows(400)
    for k in range(2):
        with open(os.path.join(scratch, f"{k}.json"), "w") as f:
            json.dump([dict(zip("isxo", r)) for r in rows if r[0] % 2 == k], f, indent=indent, separators=separators, ensure_ascii=k == 0)
    assert json_records(spark, scratch).select("file").distinct().count() == 2
    pieces = spark.read.option("lineSep", "}").text(scratch)
    assert pieces.rdd.getNumPartitions() > 4
    got = sorted((r["i"], r["s"], r["x"], r["o"].asDict()) for r in read_json_array(spark, scratch, SCHEMA).collect())
    assert got == rows


def test_roundtrips_of_written_documents(spark, scratch, small_splits):
    rows = _rows(300)
    df = spark.createDataFrame(rows, SCHEMA)
    write_json_arrays(df, f"{scratch}/a", "i", 3)
    files = [os.path.join(d, n) for d, _, ns in os.walk(f"{scratch}/a") for n in ns if n.startswith("part-")]
    assert len(files) == 3 and sorted(r["i"] for f in files for r in json.load(open(f))) == list(range(300))
    got = sorted((r["i"], r["s"], r["x"], r["o"].asDict()) for r in read_json_auto(spark, f"{scratch}/a", SCHEMA).collect())
    assert got == rows
    write_split_json(df.select("i", "s"), f"{scratch}/s", "i", 2)
    files = [os.path.join(d, n) for d, _, ns in os.walk(f"{scratch}/s") for n in ns if n.startswith("part-")]
    docs = [json.load(open(f)) for f in files]
    assert [d["columns"] for d in docs] == [["i", "s"]] * 2 and sorted(map(tuple, docs[0]["data"] + docs[1]["data"])) == [r[:2] for r in rows]
    got = sorted((int(r["i"]), r["s"]) for r in read_split_json(spark, f"{scratch}/s", ["i", "s"]).collect())
    assert got == [r[:2] for r in rows]


def test_documents_grow_in_number_not_in_size(spark, scratch):
    """Every document has one writer: without a bound on its size that task would read its share of any table."""
    df = spark.createDataFrame([(i, "x" * 100) for i in range(2000)], "i long, s string")
    for name, write, read in [("a", write_json_arrays, lambda p: read_json_auto(spark, p, SCHEMA)),
                              ("s", write_split_json, lambda p: read_split_json(spark, p, ["i", "s"]))]:
        path = f"{scratch}/{name}"
        write(df, path, "i", 2, most=20_000)
        files = [os.path.join(d, n) for d, _, ns in os.walk(path) for n in ns if n.startswith("part-")]
        assert len(files) >= 10 and max(map(os.path.getsize, files)) < 40_000
        docs = [json.load(open(f)) for f in files]
        records = [r["i"] if name == "a" else r[0] for d in docs for r in (d if name == "a" else d["data"])]
        assert sorted(records) == list(range(2000))
        assert sorted((int(r["i"]), r["s"]) for r in read(path).collect()) == [(i, "x" * 100) for i in range(2000)]


def test_documents_of_no_rows_and_of_repeated_keys(spark, scratch):
    write_json_arrays(spark.createDataFrame([], SCHEMA), f"{scratch}/none", "i", 2)
    assert not [n for _, _, ns in os.walk(f"{scratch}/none") for n in ns if n.endswith(".txt")]
    rows = [(i % 3 if i % 4 else None, str(i)) for i in range(40)]
    write_json_arrays(spark.createDataFrame(rows, "i long, s string"), f"{scratch}/again", "i", 2, most=100)
    got = [(r["i"], r["s"]) for r in read_json_auto(spark, f"{scratch}/again", SCHEMA).collect()]
    assert sorted(got, key=str) == sorted(rows, key=str)


def test_split_documents_with_an_index_and_spaces(spark, scratch, small_splits):
    rows = _rows(200)
    with open(os.path.join(scratch, "d.json"), "w") as f:
        json.dump({"columns": ["i", "odd ], name"], "index": [r[0] for r in rows], "data": [[r[0], r[1]] for r in rows]}, f, indent=1)
    got = sorted((int(r["i"]), r["s"]) for r in read_split_json(spark, scratch, ["i", "s"]).collect())
    assert got == [r[:2] for r in rows]


def test_small_and_unfinished_arrays(spark, scratch):
    for name, text, n in [("empty", "[]", 0), ("blank", " [ \n ] \n", 0), ("one", '[{"i": 1}]', 1), ("inner", '[{"i":1,"o":{"k":"v"}},{"i":2,"x":["}"]}]\n', 2)]:
        path = os.path.join(scratch, f"{name}.json")
        with open(path, "w") as f:
            f.write(text)
        assert read_json_array(spark, path, SCHEMA).count() == n, name
    for name, text in [("cut", '[{"i": 1}, {"i": 2'), ("bad", '[{"i": nonsense}]')]:
        path = os.path.join(scratch, f"{name}.json")
        with open(path, "w") as f:
            f.write(text)
        with pytest.raises(Exception, match="unfinished record|FAILFAST|MALFORMED"):
            read_json_array(spark, path, SCHEMA).collect()
