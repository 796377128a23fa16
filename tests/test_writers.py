"""Writers: content reconciliation, unique ids, named split files, bucket tables; large caps; typed schema merge."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from ferry.functions.schema import merged_schema
from ferry.functions.scalar import flatten_paths
from ferry.operators import order as O
from ferry.operators.account import TransferMismatch, fingerprints, reconcile_contents
from ferry.operators.order import cap, selected, sort_docs
from ferry.sinks.buckets import BucketTable, stream_upsert_buckets
from ferry.sinks.ndjson import export_ndjson, read_split_files, split_files
from ferry.sinks.upsert import append_to, upsert_to


def files(path):
    return sorted(os.path.relpath(os.path.join(d, f), path) for d, _, names in os.walk(path) for f in names if not f.startswith((".", "_")))


# ------------------------------------------------------------------ reconciliation

def test_contents_that_differ_are_found(spark):
    rows = [(str(i), i, {"a": i, "b": None}) for i in range(500)] + [("7", 7, {"a": 7, "b": None})] + [(None, 1, {})]
    schema = "_id string, n int, m map<string,int>"
    source = spark.createDataFrame(rows, schema)
    assert reconcile_contents(source, source.repartition(7)).count() == 0
    swapped = [(i, 42 if i == "41" else 41 if i == "42" else n, m) for i, n, m in rows if i != "3"] + [("x", 1, None), ("8", 8, {"a": 8, "b": None}), ("9", 0, {})]
    got = {r["id"]: (r["what"], r["source_rows"], r["target_rows"]) for r in reconcile_contents(source, spark.createDataFrame(swapped, schema)).collect()}
    assert got == {"41": ("changed", 1, 1), "42": ("changed", 1, 1), "3": ("missing", 1, 0), "x": ("extra", 0, 1), "8": ("rows", 1, 2), "9": ("rows", 1, 2)}
    lost = reconcile_contents(source, source.where("_id is not null")).collect()
    assert [tuple(r) for r in lost] == [(None, "missing", 1, 0)]
    assert reconcile_contents(source.limit(0), source.limit(0)).count() == 0
    assert fingerprints(source, buckets=3).count() == 3


def test_writes_check_themselves(spark, tmpdir_path, monkeypatch):
    from ferry.sinks import upsert as U

    target = spark.createDataFrame([("a", 1), ("b", 2)], "_id string, v int")
    upsert_to(target, spark.createDataFrame([("b", 3), ("c", 4)], "_id string, v int"), os.path.join(tmpdir_path, "v1"))
    assert spark.read.parquet(os.path.join(tmpdir_path, "v1")).count() == 3
    monkeypatch.setattr(U, "files_of", lambda spark, path: set())  # a target that lost its files
    with pytest.raises(TransferMismatch):
        upsert_to(target, target, os.path.join(tmpdir_path, "v2"))


def test_append_never_repeats_an_id(spark, tmpdir_path):
    out = os.path.join(tmpdir_path, "t")
    rows = spark.createDataFrame([(1,), (1,), (2,)], "n int")
    append_to(rows, out, "t")
    both = append_to(rows, out, "t")
    assert both.count() == 6 and both.select("_id").distinct().count() == 6
    same = append_to(rows, out + "2", "t", content_id=True)
    assert same.select("_id").distinct().count() == 2


def test_append_export_counts_new_files_only(spark, tmpdir_path):
    out = os.path.join(tmpdir_path, "e")
    for n in (4, 2, 0, 3):
        export_ndjson(spark.range(n), out, mode="append", check=True)
    assert spark.read.text(out).count() == 9


# ------------------------------------------------------------------ named split files

def test_split_files_have_names_and_sizes(spark, tmpdir_path):
    out = os.path.join(tmpdir_path, "s")
    sizes = split_files(spark.range(7).repartition(3), out, 3, "id")
    assert sorted(tuple(r) for r in sizes.collect()) == [(1, 3), (2, 3), (3, 1)]
    assert files(out) == ["data-1.json", "data-2.json", "data-3.json"]
    assert [json.loads(x)["id"] for x in open(os.path.join(out, "data-2.json")).read().split()] == [3, 4, 5]
    split_files(spark.range(100, 104), out, 3, "id")  # the same base name: files written now replace theirs, others stay
    assert files(out) == ["data-1.json", "data-2.json", "data-3.json"]
    back = read_split_files(spark, out)
    got = sorted((r["chunk"], r["id"]) for r in back.select("chunk", F.variant_get("doc", "$.id", "int").alias("id")).collect())
    assert got == [(1, 100), (1, 101), (1, 102), (2, 103), (3, 6)]
    split_files(spark.range(2), out, 5, "id", base="orders", mode="errorifexists")
    assert "orders-1.json" in files(out) and not [f for f in os.listdir(out) if f.startswith("_staging")]
    with pytest.raises(FileExistsError):
        split_files(spark.range(2), out, 5, "id", base="orders", mode="errorifexists")
    assert split_files(spark.range(0), out + "0", 5, "id").count() == 0 and files(out + "0") == []
    with pytest.raises(ValueError):
        split_files(spark.range(2), out, 5, "id", base="a/b")


# ------------------------------------------------------------------ bucket tables

def test_a_batch_touches_only_its_buckets(spark, tmpdir_path):
    t = BucketTable(spark, os.path.join(tmpdir_path, "t"), "k", ["seq"], buckets=16, most_deltas=2)
    assert t.read() is None
    first = spark.range(400).select(F.col("id").alias("k"), F.lit(0).alias("seq"), F.lit("old").alias("v"))
    t.apply(first, 0)
    before = set(files(t.path))
    touched = t.apply(spark.createDataFrame([(5, 1, "new"), (5, 2, "newer"), (5, -1, "late"), (1000, 1, "add")], "k long, seq int, v string"), 1)
    assert len(touched) <= 2
    added = [f for f in set(files(t.path)) - before if f.startswith("data")]
    assert {int(f.split("__bucket=")[1].split("/")[0]) for f in added} == set(touched)
    assert before <= set(files(t.path))  # nothing is rewritten
    rows = {r["k"]: (r["seq"], r["v"]) for r in t.read().collect()}
    assert len(rows) == 401 and rows[5] == (2, "newer") and rows[1000] == (1, "add") and rows[6] == (0, "old")
    assert t.apply(first, 1) == [] and t.read().count() == 401  # a replayed batch
    t.apply(spark.createDataFrame([(5, 3, "newest")], "k long, seq int, v string"), 2)
    t.apply(spark.createDataFrame([(5, 0, "late")], "k long, seq int, v string"), 3)
    assert all(len(f) <= 3 for f in t.manifest()["buckets"].values())
    gone = t.retire()
    assert gone and {r["k"]: r["v"] for r in t.read().collect()}[5] == "newest" and t.read().count() == 401
    t.compact()
    t.retire()
    assert all(len(f) == 1 for f in t.manifest()["buckets"].values()) and t.read().count() == 401
    with pytest.raises(ValueError):
        BucketTable(spark, t.path, "k", ["seq"], buckets=8).read()


def test_bucket_table_equals_plain_last_write(spark, tmpdir_path):
    r, want = random.Random(3), {}
    t = BucketTable(spark, os.path.join(tmpdir_path, "t"), "k", ["a", "b"], buckets=4, most_deltas=1)
    for n in range(5):
        rows = [(r.choice([None, *range(12)]), r.randrange(9), n * 100 + i, r.random()) for i in range(30)]
        for k, a, b, v in rows:
            if k not in want or (a, b) > want[k][:2]:
                want[k] = (a, b, v)
        t.apply(spark.createDataFrame(rows, "k long, a int, b int, v double"))
    assert {x["k"]: (x["a"], x["b"], x["v"]) for x in t.read().collect()} == want


def test_stream_into_buckets_resumes(spark, tmpdir_path):
    src, ckpt = os.path.join(tmpdir_path, "src"), os.path.join(tmpdir_path, "ckpt")
    t = BucketTable(spark, os.path.join(tmpdir_path, "t"), "k", ["seq"], buckets=4)
    for n in range(3):
        spark.createDataFrame([(i, n, f"v{n}") for i in range(n, n + 3)], "k long, seq int, v string").write.mode("append").parquet(src)
        stream = spark.readStream.schema("k long, seq int, v string").option("maxFilesPerTrigger", 1).parquet(src)
        stream_upsert_buckets(stream, t, ckpt)
    assert {r["k"]: r["v"] for r in t.read().collect()} == {0: "v0", 1: "v1", 2: "v2", 3: "v2", 4: "v2"}


# ------------------------------------------------------------------ large caps

@pytest.mark.parametrize("spec", ["v", "v:desc", "s,v:desc", "t:desc", "d"])
def test_large_caps_select_first(spark, monkeypatch, spec):
    r = random.Random(6)
    rows = [(f"{i:05d}", r.choice([None, *range(50), 7, 7, 7]), r.choice(["a", "b", "zz", None]), f"2024-01-{r.randrange(1, 28):02d} 02:30:00",
             r.choice([None, float("nan"), -1.5, r.random()])) for i in range(4000)]
    df = spark.createDataFrame(rows, "_id string, v int, s string, t string, d double").withColumn("t", F.col("t").cast("timestamp_ntz")).repartition(5)
    monkeypatch.setattr(O, "TOPK_MAX", 10)
    want = [r["_id"] for r in sort_docs(df, spec).select("_id").collect()]
    for n in (11, 700, 3999, 5000):
        assert [r["_id"] for r in cap(df, n, spec).select("_id").collect()] == want[:n]
    if spec == "t:desc":
        assert 100 <= selected(df, 100, spec).count() < 1500  # not all rows are numbered


# ------------------------------------------------------------------ typed schema merge

def test_merged_schema(spark):
    docs = ['{"a": 1, "b": [1, 2.5], "c": null, "d": {"x": "s", "y": true}, "e": 1}', '{"a": 2.50, "b": [], "c": null, "d": {"x": 3}, "e": 1.5e300}',
            '{"a": 12345678901234567890, "b": [null, 3], "d": {"y": false}, "e": 2.25}', "{}"]
    df = spark.createDataFrame(list(enumerate(docs)), "id long, j string").select("id", F.parse_json("j").alias("doc"))
    got = {r["path"]: (r["type"], r["docs"], r["nulls"]) for r in merged_schema(flatten_paths(df, "id", "doc"), "id").collect()}
    assert got == {"a": ("DECIMAL(21,1)", 3, 0), "b[]": ("DECIMAL(20,1)", 2, 1), "c": ("VOID", 2, 2), "d.x": ("STRING", 2, 0),
                   "d.y": ("BOOLEAN", 2, 0), "e": ("DOUBLE", 3, 0)}


def test_flatten_any_depth_in_one_read(spark):
    deep = {"a": 1}
    for _ in range(40):
        deep = {"x": [deep, 7]}
    df = spark.createDataFrame([(1, json.dumps(deep)), (2, '{"k": {"l": {"m": [[[1]], {}]}}, "n": null}')], "id long, j string").select("id", F.parse_json("j").alias("doc"))
    flat = flatten_paths(df, "id", "doc")
    got = {(r["id"], r["path"]): r["v"] for r in flat.select("id", "path", F.to_json("value").alias("v")).collect()}
    want = {(2, "k.l.m[0][0][0]"): "1", (2, "n"): "null", (1, "x[0]." * 40 + "a"): "1"}
    want |= {(1, "x[0]." * i + "x[1]"): "7" for i in range(40)}
    assert got == want
