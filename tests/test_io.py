"""Sinks and landing: the dashboard JSON extract and the Parquet landing copy."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from claimlens import sinks
from claimlens.plans import dashboard, kpis
from claimlens.session import new_scratch_path, scratch_dir
from claimlens.sources.files import read_checked_csv, rejected_counts


def test_scratch_dir_comes_from_session(spark):
    root = scratch_dir(spark)
    assert root and spark.sparkContext.getCheckpointDir()


def test_write_dashboard(spark, wh):
    out = dashboard.write_dashboard(wh, new_scratch_path(spark, "dash"))
    path = out["data"].replace("file:", "")
    files = [f for f in os.listdir(path) if f.endswith(".json")]
    assert len(files) == 1
    with open(f"{path}/{files[0]}") as f:
        lines = f.read().splitlines()
    assert len(lines) == 1  # one object, nothing encoded twice
    data = json.loads(lines[0])
    assert data["header_cards"]["clean_claim_rate_pct"] > 0 and data["clean_claim_rate"]["total_claims"] > 0
    assert all(isinstance(data[k], int) for k in ("dq_orphaned_claims", "dq_duplicate_claim_ids", "dq_unmapped_diagnosis"))
    losses = [r["estimated_financial_loss"] for r in data["top_carc_denials"]]
    assert losses == sorted(losses, reverse=True) and len(losses) <= 10
    rates = [r["clean_claim_rate_pct"] for r in data["clean_claim_by_provider_worst10"]]
    assert rates == sorted(rates) and len(rates) <= 10
    totals = [r["total"] for r in data["ar_matrix_top_providers"]]
    assert totals == sorted(totals, reverse=True) and len(totals) <= 12
    # the data-sized matrix is written as JSON lines, in parallel
    matrix = spark.read.json(out["ar_aging_matrix"])
    assert matrix.count() == kpis.ar_aging_matrix(wh.fact).count()


def test_land_then_materialize(spark, wh):
    landed = wh.land()
    assert "FileScan parquet" in landed.segments._jdf.queryExecution().executedPlan().toString()
    stored = landed.materialize(tables=("fact", "dim_provider"))
    a = kpis.clean_claim_rate(stored.fact).first()
    b = kpis.clean_claim_rate(wh.fact).first()
    assert a == b
    assert stored.dim_provider.count() == wh.dim_provider.count()
    # the fact is stored partitioned by claim type
    assert stored.fact.filter(F.col("claim_type") == "Inpatient").count() > 0


def test_lookup_sink_and_parquet_lookup(spark, wh):  # K5, S4
    from claimlens.sinks import write_lookup
    from claimlens.sources.files import read_lookup
    path = write_lookup(wh.dim_carc_denials.select("carc_code", "description"),
                        new_scratch_path(spark, "carc"))
    files = [f for f in os.listdir(path.replace("file:", "")) if f.endswith(".parquet")]
    assert len(files) == 1
    back = read_lookup(spark, path, "parquet")
    assert sorted(back.collect()) == sorted(wh.dim_carc_denials.select("carc_code", "description").collect())


def test_materialize_view_and_table(spark, wh):  # K1, K7
    from claimlens.sinks import materialize
    v = materialize(wh.dim_provider, "claimlens_dim_provider_view", "view")
    t = materialize(wh.dim_provider, "claimlens_dim_provider_table", "table",
                    path=new_scratch_path(spark, "dim_provider"))
    assert spark.table("claimlens_dim_provider_view").count() == v.count()
    assert "FileScan parquet" in spark.table("claimlens_dim_provider_table")._jdf \
        .queryExecution().executedPlan().toString()
    assert t.count() == v.count()


def test_malformed_lines_are_accounted_for(spark, tmp_path):  # S1
    (tmp_path / "a.csv").write_text('x,y,z\n1,2,3\n4,5\n6,7,8,9\n,,\n"q,r",s,t\n')
    (tmp_path / "b.csv").write_text("x,y,z\n1,2,3\n")
    rows, rejected = read_checked_csv(spark, str(tmp_path))
    assert sorted(map(tuple, rows.collect()), key=str) == sorted(
        [("1", "2", "3"), (None, None, None), ("q,r", "s", "t"), ("1", "2", "3")], key=str)
    assert rows.count() == 4 and rejected.count() == 2
    assert sorted(r.line for r in rejected.collect()) == ["4,5", "6,7,8,9"]
    assert [(r.file.rsplit("/", 1)[1], r.n_rejected) for r in rejected_counts(rejected).collect()] == [("a.csv", 2)]
    assert read_checked_csv(spark, str(tmp_path), ["z"])[0].columns == ["z"]
    with pytest.raises(ValueError, match="nowhere"):
        read_checked_csv(spark, str(tmp_path), ["nowhere"])


def test_published_names_are_every_sessions(spark):  # K1, K2, K7, S7
    path, name = new_scratch_path(spark, "named"), "named_relation"
    sinks.publish(spark.range(5), name, path)
    other = spark.newSession()
    assert other.table(name).count() == 5
    with pytest.raises(Exception, match="wrong"):  # a rewrite that fails leaves the old rows
        sinks.publish(spark.range(9).withColumn("bad", F.raise_error(F.lit("wrong"))), name, path)
    assert other.table(name).columns == ["id"] and other.table(name).count() == 5
    sinks.publish(spark.range(7).withColumn("more", F.lit("x")), name, path)
    assert spark.newSession().table(name).columns == ["id", "more"] and other.table(name).count() == 7


def test_replaced_partition_leaves_the_others(spark):  # K4
    root = new_scratch_path(spark, "parts")
    rows = spark.range(100).withColumn("kind", F.when(F.col("id") % 2 == 0, "a").otherwise("b"))
    sinks.write_parquet(rows, root, partition_by="kind")

    def files(kind):
        return {(f, os.stat(f).st_mtime_ns) for f in glob.glob(f"{root.removeprefix('file:')}/kind={kind}/*.parquet")}

    before = files("a"), files("b")
    sinks.replace_partitions(rows.filter("kind = 'a'").withColumn("id", F.col("id") + 1000), root, "kind")
    assert files("b") == before[1] and not files("a") & before[0]
    got = spark.read.parquet(root)
    assert got.count() == 100 and got.filter("kind = 'a'").agg(F.min("id")).first()[0] == 1000


def test_bucketed_tables_join_without_exchange(spark):  # J1, A12
    root = new_scratch_path(spark, "buckets")
    a = sinks.write_bucketed(spark.range(500).withColumn("x", F.lit(1)), "bucketed_a", f"{root}/a", "id", 4)
    b = sinks.write_bucketed(spark.range(400).withColumn("y", F.lit(2)), "bucketed_b", f"{root}/b", "id", 4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined, counted = a.join(b, "id"), a.groupBy("id").count()
        for df in (joined, counted):
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 400 and counted.count() == 500
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
