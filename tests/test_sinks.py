"""Sinks: byte-exact submission header (SNK4) and JSONL that keeps NULL
fields and non-ASCII text (SNK5)."""

import glob
import json
import os
import tempfile

from tabforge.sources import sinks


def _parts(path, ext):
    return sorted(glob.glob(os.path.join(path, f"part-*{ext}")))


def test_submission_csv_starts_with_bom(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="tabforge-sink-"), "sub")
    df = spark.createDataFrame([("a1", 1), ("a2", 0)], "ID string, label int").coalesce(1)
    sinks.write_submission_csv(df, out)
    data = open(_parts(out, ".csv")[0], "rb").read()
    assert data.startswith(b"\xef\xbb\xbfID,label\n")
    assert sorted(data.decode("utf-8-sig").splitlines()[1:]) == ["a1,1", "a2,0"]


def test_jsonl_keeps_nulls_and_utf8(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="tabforge-sink-"), "jsonl")
    df = spark.createDataFrame([("是", None)], "output string, input string").coalesce(1)
    sinks.write_jsonl(df, out)
    raw = open(_parts(out, ".json")[0], "rb").read().decode("utf-8")
    assert "是" in raw
    assert json.loads(raw.splitlines()[0]) == {"output": "是", "input": None}


def test_submission_from_parallel_writers_is_byte_equal(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="tabforge-sink-"), "sub")
    rows = [(f"id,{i}" if i % 7 == 0 else f"ü{i}", i % 2) for i in range(1000)]
    df = spark.createDataFrame(rows, "`the \"id\"` string, label int").repartition(6).sortWithinPartitions("label")
    for _ in range(2):  # the second write takes the first one's place
        sinks.write_submission_csv(df, out)
    parts = _parts(out, ".csv")
    assert [os.path.basename(p) for p in parts] == ["part-00000.csv"] and not glob.glob(os.path.join(out, "_*"))
    raw = open(parts[0], "rb").read().decode("utf-8-sig").splitlines()
    assert raw[0] == '"the ""id""",label'
    assert sorted(raw[1:]) == sorted(f'"{k}",{v}' if "," in k else f"{k},{v}" for k, v in rows)
