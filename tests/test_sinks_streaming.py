"""Writers and the incremental load on small frames in a scratch folder."""

import os
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

from clutchforge import schemas, sinks
from clutchforge.operators.dedupe import desc_nulls_last, whole_row
from clutchforge.sinks import warehouse
from clutchforge.streaming.incremental import incremental_load
from clutchforge.streaming.manifest import LoadManifest, load_pending
from clutchforge.streaming.merge import KeyedTable, merge_load


def test_date_partitioned_contract_write(spark):
    out = tempfile.mkdtemp(prefix="cf-sink-")
    df = spark.createDataFrame([("m1", "a", "b", None, "2026-05-04", None, 1, 2, False, None, None, "csapi")],
                               "match_id string, team_a_id string, team_b_id string, winner_id string, "
                               "played_at string, map_name string, score_a long, score_b long, is_overtime boolean, "
                               "team_a_ranking long, team_b_ranking long, source string")
    sinks.write_date_partitioned(df, out + "/m", "played_at", schemas.RAW_MATCHES)
    assert os.path.isdir(out + "/m/year=2026/month=05/day=04")
    with pytest.raises(ValueError):
        sinks.enforce_contract(df.withColumn("extra", F.lit(1)), schemas.RAW_MATCHES)


def test_batch_append_guard_and_replay(spark):
    out = tempfile.mkdtemp(prefix="cf-batch-") + "/b"
    df = spark.range(3)
    with pytest.raises(ValueError):
        sinks.append_batch(df, out, "../escape")
    assert sinks.append_batch(df.limit(0), out, "b1") is False
    assert sinks.append_batch(df, out, "b1") and sinks.append_batch(df, out, "b1")   # replay replaces
    assert sinks.append_batch(df, out, "b2")
    assert spark.read.parquet(out).count() == 6
    sinks.write_if_absent(spark.range(5), out + "_once")
    sinks.write_if_absent(spark.range(9), out + "_once")
    assert spark.read.parquet(out + "_once").count() == 5


def test_incremental_load_is_exactly_once(spark):
    base = tempfile.mkdtemp(prefix="cf-stream-")
    src, tgt, ckpt = base + "/src", base + "/tgt", base + "/ckpt"
    row = ("m1", "a", "b", None, "2026-05-04", None, 1, 2, False, None, None)
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.RAW_MATCHES.fields if f.name != "source")

    def land(source, mode):
        spark.createDataFrame([row], ddl).withColumn("source", F.lit(source)) \
            .write.mode(mode).partitionBy("source").parquet(src)

    land("csapi", "overwrite")
    assert incremental_load(spark, src, tgt, ckpt, schemas.RAW_MATCHES) == 1
    assert incremental_load(spark, src, tgt, ckpt, schemas.RAW_MATCHES) == 0      # nothing new
    land("faceit", "append")
    assert incremental_load(spark, src, tgt, ckpt, schemas.RAW_MATCHES) == 1
    assert spark.read.parquet(tgt).count() == 2


def test_a_replayed_batch_adds_nothing(spark):
    base = tempfile.mkdtemp(prefix="cf-replay-")
    src, tgt = base + "/src", base + "/tgt"
    schema = spark.range(0).schema
    spark.range(4).write.parquet(src)
    assert incremental_load(spark, src, tgt, base + "/c1", schema) == 4
    assert incremental_load(spark, src, tgt, base + "/c2", schema) == 0   # the log is lost: batch 0 comes again
    assert spark.read.parquet(tgt).count() == 4


# ------------------------------------------------------------------ merges
MATCHES = "id string, map string, played string, score long"


def _table(spark, path, buckets=8):
    from pyspark.sql import types as T

    def newest(m):
        return desc_nulls_last(F.col("played").try_cast("date")) + [whole_row(m)]
    return KeyedTable(spark, path, T._parse_datatype_string(MATCHES), ["id", "map"], newest, buckets)


def _rows(table):
    return sorted((tuple(r) for r in table.read().collect()), key=str)


def _best(*loads):
    """The newest row of each key; rows without a day are older than all, ties go to the larger row."""
    best = {}
    for r in (r for load in loads for r in load):
        order = (r[2] is not None, r[2] or "", tuple((x is not None, x or 0) if i == 3 else (x is not None, x or "") for i, x in enumerate(r)))
        key = r[:2]
        if key not in best or order > best[key][0]:
            best[key] = (order, r)
    return sorted((r for _, r in best.values()), key=str)


LOADS = ([("a", "m1", "2024-01-01", 1), ("a", "m1", "2024-01-03", 2), ("b", None, None, 3), ("c", "m1", "2024-01-01", 4)],
         [("a", "m1", "2024-01-02", 9), ("b", None, "2024-01-01", 5), ("d", "m2", None, None), ("c", "m1", "2024-01-01", 7)],
         [("c", "m1", "2024-01-01", 6), (None, "m1", "2024-02-01", 8), (None, "m1", "2024-02-02", 8), ("e", "m9", "2024-01-01", 1)])


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (0, 0, 1, 2, 1), (1, 2, 0, 1)])
def test_merges_keep_the_newest_row_whatever_comes_again(spark, order):
    t = _table(spark, tempfile.mkdtemp(prefix="cf-merge-"))
    assert _rows(t) == []
    for k in order:
        t.merge(spark.createDataFrame(LOADS[k], MATCHES))
        before = _rows(t)
        t.merge(spark.createDataFrame(LOADS[k], MATCHES))
        assert _rows(t) == before
    assert _rows(t) == _best(*LOADS)
    assert t.merge(spark.createDataFrame([], MATCHES)) == [] and _rows(t) == _best(*LOADS)


def _files(path):
    return {os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_a_merge_writes_only_the_buckets_it_touches(spark):
    t = _table(spark, tempfile.mkdtemp(prefix="cf-merge-"), buckets=16)
    t.merge(spark.createDataFrame([(f"k{i}", "m", "2024-01-01", i) for i in range(200)], MATCHES))
    before = _files(t.rows)
    touched = t.merge(spark.createDataFrame([("k7", "m", "2024-01-02", 0)], MATCHES))
    assert len(touched) == 1
    changed = before ^ _files(t.rows)
    assert changed and all(f"bucket={touched[0]}/" in f for f in changed)
    assert len(_rows(t)) == 200
    assert os.listdir(t.staging) == []


@pytest.mark.parametrize("lost", [False, True])
def test_a_merge_that_is_cut_off_is_finished_by_the_next(spark, lost):
    t = _table(spark, tempfile.mkdtemp(prefix="cf-merge-"))
    t.merge(spark.createDataFrame(LOADS[0], MATCHES))
    publish = t._publish

    def cut(result):
        if lost:  # the old buckets are gone, the new ones not there yet
            for r in spark.read.parquet(result).select("bucket").distinct().collect():
                shutil.rmtree(f"{t.rows}/bucket={r.bucket}", ignore_errors=True)
        raise RuntimeError("the driver dies")

    t._publish = cut
    with pytest.raises(RuntimeError):
        t.merge(spark.createDataFrame(LOADS[1], MATCHES))
    t._publish = publish
    assert _rows(t) == _best(*LOADS[:2])              # readers see the finished result
    t.merge(spark.createDataFrame(LOADS[2], MATCHES))  # the next merge puts it in place first
    assert _rows(t) == _best(*LOADS)


def test_streamed_loads_become_the_table(spark):
    base = tempfile.mkdtemp(prefix="cf-merge-")
    t = _table(spark, base + "/t")
    for load in LOADS:
        spark.createDataFrame(load, MATCHES).write.mode("append").parquet(base + "/landing")
        merge_load(spark, base + "/landing", t.schema, lambda b: b.where("score is null or score <> 7"), t, base + "/log", 1)
    merge_load(spark, base + "/landing", t.schema, lambda b: b, t, base + "/log")  # nothing new
    assert _rows(t) == _best(*[[r for r in load if r[3] != 7] for load in LOADS])


# ------------------------------------------------------------------ load manifest
def test_a_load_that_dies_before_its_commit_is_offered_again(spark):
    base = tempfile.mkdtemp(prefix="cf-manifest-")
    manifest = LoadManifest(spark, base + "/manifest")
    rows = lambda *keys: spark.createDataFrame([(k, i) for k in keys for i in range(3)], "object_key string, v long")
    load_pending(rows("a", "b"), base + "/t", manifest, "l1")
    assert {r.object_key for r in manifest.loaded().collect()} == {"a", "b"}
    commit = manifest.commit
    manifest.commit = lambda *_: (_ for _ in ()).throw(RuntimeError("dies"))
    with pytest.raises(RuntimeError):
        load_pending(rows("b", "c"), base + "/t", manifest, "l2")
    manifest.commit = commit
    assert {r.object_key for r in manifest.pending(rows("a", "b", "c")).collect()} == {"c"}
    load_pending(rows("b", "c", "d"), base + "/t", manifest, "l2")   # replaces what the dead load had written
    load_pending(rows("b", "c", "d"), base + "/t", manifest, "l2")   # and once more
    load_pending(rows("a", "d"), base + "/t", manifest, "l3")        # nothing is left to do
    got = spark.read.parquet(base + "/t")
    assert sorted((r.object_key, r.batch_id, r["count"]) for r in got.groupBy("object_key", "batch_id").count().collect()) == [
        ("a", "l1", 3), ("b", "l1", 3), ("c", "l2", 3), ("d", "l2", 3)]


# ------------------------------------------------------------------ catalog
def test_tables_are_replaced_under_their_readers(spark):
    top = tempfile.mkdtemp(prefix="cf-wh-")
    name = warehouse.publish_table(spark.range(3), "t_replace", top)
    reader = spark.table(name)
    first = warehouse.location(spark, "t_replace")
    warehouse.publish_table(spark.range(5), "t_replace", top)
    assert reader.count() == 3 and spark.table(name).count() == 5      # the old version is still there
    assert first != warehouse.location(spark, "t_replace")
    warehouse.publish_table(spark.range(2).withColumn("x", F.lit("a")), "t_replace", top)   # another schema
    assert spark.table(name).columns == ["id", "x"] and spark.table(name).count() == 2
    assert len(warehouse.expire(spark, "t_replace", top)) == 2 and spark.table(name).count() == 2
    assert warehouse.publish_view(spark.range(4), "t_view") == "staging_t_view" and spark.table("staging_t_view").count() == 4
    warehouse.publish_view(spark.range(6), "t_view")
    assert spark.table("staging_t_view").count() == 6


def test_metrics_and_snapshots(spark):
    base = tempfile.mkdtemp(prefix="cf-metrics-")
    sinks.write_metrics(spark.createDataFrame([("auc", 0.5), ("f1", None)], "name string, value double"), base + "/m")
    sinks.write_metrics(spark.createDataFrame([("auc", 0.75)], "name string, value double"), base + "/m")
    assert [tuple(r) for r in spark.read.json(base + "/m").select("name", "value").collect()] == [("auc", 0.75)]
    sinks.export_snapshot(spark.createDataFrame([(1, "x")], "TEAM_ID long, Name string"), base + "/s")
    assert sinks.read_snapshot(spark, base + "/s").columns == ["team_id", "name"]
