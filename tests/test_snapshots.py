"""Tables that change as a whole: replaced from themselves, merged by bucket, refused in conflict."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from filingscope.sinks import snapshots as sn

SCHEMA = "k int, v string, created_at int"


def rows(spark, root, **options):
    return sorted(map(tuple, sn.read(spark, root, **options).collect()))


def files(root):
    return {os.path.relpath(p, root) for p in glob.glob(f"{root}/**/*.parquet", recursive=True)}


def numbered(spark, n, text="a"):
    return spark.createDataFrame([(i, text, 1) for i in range(n)], SCHEMA)


def test_a_table_is_replaced_from_itself(spark, tmp_path):
    root = str(tmp_path / "t")
    sn.replace_table(numbered(spark, 20), root, ["k"], buckets=4)
    sn.replace_table(sn.read(spark, root).where("k < 5").withColumn("v", F.upper("v")), root, ["k"])
    assert rows(spark, root) == [(i, "A", 1) for i in range(5)]
    sn.replace_table(sn.read(spark, root).limit(0), root, ["k"])
    assert rows(spark, root) == []


def test_a_write_that_fails_midway_leaves_the_old_rows(spark, tmp_path):
    root = str(tmp_path / "t")
    sn.replace_table(numbered(spark, 20), root, ["k"], buckets=4)
    before = rows(spark, root)
    bad = sn.read(spark, root).withColumn("v", F.when(F.col("k") == 7, F.raise_error(F.lit("broken"))).otherwise("b"))
    with pytest.raises(Exception, match="broken"):
        sn.replace_table(bad, root, ["k"])
    with pytest.raises(Exception, match="broken"):
        sn.upsert_table(bad, root, ["k"])
    assert rows(spark, root) == before
    write = sn.Write(spark, root)  # all rows are written, but the commit never comes
    write.put(sn.TABLE, numbered(spark, 3, "z"), ["k"], replaced=range(4))
    assert rows(spark, root) == before
    (tmp_path / "t" / "commits" / "00000009.json").write_text('{"number": 9, "buck')  # died while committing
    assert rows(spark, root) == before
    sn.replace_table(numbered(spark, 2, "c"), root, ["k"])
    assert rows(spark, root) == [(0, "c", 1), (1, "c", 1)]


def test_upsert_writes_only_the_buckets_it_touches(spark, tmp_path):
    root = str(tmp_path / "t")
    updates = spark.createDataFrame([(3, "new", 2), (100, "added", 2)], SCHEMA)
    sn.upsert_table(numbered(spark, 40), root, ["k"], buckets=16)  # into no table
    before = files(root)
    hit = set(sn.touched(updates, ["k"], 16))
    assert 0 < len(hit) <= 2
    sn.upsert_table(updates, root, ["k"], created_at="created_at")
    assert before <= files(root)
    written = files(root) - before
    assert {int(p.split("bucket=")[1].split("/")[0]) for p in written} == hit
    assert rows(spark, root) == sorted([*((i, "a", 1) for i in range(40) if i != 3), (3, "new", 1), (100, "added", 2)])
    kept = sn.read(spark, root).select(F.input_file_name()).distinct().collect()
    assert {os.path.relpath(r[0].removeprefix("file://"), root) for r in kept} == written | {
        p for p in before if int(p.split("bucket=")[1].split("/")[0]) not in hit
    }


def test_upsert_opens_only_the_buckets_it_touches(spark, tmp_path):
    root = str(tmp_path / "t")
    sn.replace_table(numbered(spark, 40), root, ["k"], buckets=16)
    updates = spark.createDataFrame([(3, "new", 2)], SCHEMA)
    (hit,) = sn.touched(updates, ["k"], 16)
    for path in files(root):
        if f"bucket={hit}/" not in path:
            (tmp_path / "t" / path).write_bytes(b"cannot be read")
    sn.upsert_table(updates, root, ["k"])
    assert (3, "new", 2) in rows(spark, root, buckets=[hit])


def test_upsert_refuses_repeated_keys_and_deals_anew_by_another_key(spark, tmp_path):
    root = str(tmp_path / "t")
    sn.replace_table(numbered(spark, 5), root, buckets=4)  # dealt by all columns
    sn.upsert_table(spark.createDataFrame([(1, "b", 2)], SCHEMA), root, ["k"])
    assert rows(spark, root) == [(0, "a", 1), (1, "b", 2), (2, "a", 1), (3, "a", 1), (4, "a", 1)]
    assert sn.tables(spark, root) == {sn.TABLE: ["k"]}
    with pytest.raises(Exception, match="repeated key"):
        sn.upsert_table(spark.createDataFrame([(1, "c", 2), (1, "d", 2)], SCHEMA), root, ["k"])


def test_of_two_writers_the_second_is_refused(spark, tmp_path):
    root = str(tmp_path / "t")
    sn.replace_table(numbered(spark, 5), root, ["k"], buckets=4)
    one, two = sn.Write(spark, root), sn.Write(spark, root)
    one.put(sn.TABLE, numbered(spark, 1, "one"), ["k"], replaced=range(4))
    two.put(sn.TABLE, numbered(spark, 2, "two"), ["k"], replaced=range(4))
    one.commit()
    with pytest.raises(sn.WriteConflict):
        two.commit()
    assert rows(spark, root) == [(0, "one", 1)]


def test_appends_older_commits_compaction_and_expiry(spark, tmp_path):
    root = str(tmp_path / "t")
    for n in range(3):
        write = sn.Write(spark, root, buckets=4)
        write.put("log", spark.createDataFrame([(n, f"w{n}")], "k int, v string"), ["k"])
        write.commit(n=n)
    first = sn.latest(spark, root, before=2)
    assert [r.k for r in sn.read(spark, root, "log", at=first).collect()] == [0]
    before = rows(spark, root, table="log")
    assert before == [(0, "w0"), (1, "w1"), (2, "w2")]
    made = sn.compact(spark, root)
    assert made.note == {"n": 2} and len(made.writes) == 1
    assert rows(spark, root, table="log") == before
    gone = sn.expire(spark, root)
    assert len(gone) == 3 and sn.commits(spark, root) == [4]
    assert rows(spark, root, table="log") == before


def test_a_table_that_is_not_there(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        sn.read(spark, str(tmp_path / "none"))
    schema = spark.createDataFrame([], SCHEMA).schema
    assert sn.read(spark, str(tmp_path / "none"), schema=schema).collect() == []
