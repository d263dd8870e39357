"""Plan-shape checks: the physical plans keep the properties the design
relies on at scale (see README, "Scale design")."""

import contextlib

import pytest

from claimlens import registry
from claimlens.plans import dashboard, kpis, quality, warehouse


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@contextlib.contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@pytest.fixture
def fresh(spark, sf_dir):
    """With a given as-of date: without one, its scalar subquery is one more pass over the segments."""
    return warehouse.from_test_tables(spark, sf_dir, as_of="1998-12-01")


def test_rollup_combines_before_its_one_exchange(spark, fresh):
    plan = physical(fresh.land().fact_base)
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 1, plan
    assert "partial_min" in plan[plan.index("Exchange"):]


def test_rollup_of_dealt_segments_needs_no_exchange(spark, fresh):
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = physical(fresh.fact_base)
    assert plan.count("Exchange") == 2, plan  # lines and orders, by claim id


def jobs_run(spark):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup("building"))


def test_building_models_starts_no_job(spark, sf_dir):
    spark.sparkContext.setJobGroup("building", "")
    try:
        wh = warehouse.from_test_tables(spark, sf_dir)  # reads the files' footers
        before = jobs_run(spark)
        for df in (wh.fact, wh.dim_patient, wh.dim_provider, wh.dim_diagnosis, wh.dim_carc_denials,
                   kpis.header_cards(wh.fact), kpis.ar_aging_matrix(wh.fact),
                   kpis.top_carc_denials(wh.fact, wh.dim_carc_denials)):
            assert df.columns
        assert jobs_run(spark) == before
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_unset_shared_folder_on_a_cluster_is_an_error(spark, monkeypatch):
    from types import SimpleNamespace

    from claimlens import session
    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None,
                         getConf=lambda: SimpleNamespace(get=lambda *a: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_dir(SimpleNamespace(sparkContext=sc))


def test_fact_needs_no_join_beyond_the_segments(spark, fresh):
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = physical(fresh.fact)
        without_code = physical(fresh.fact.drop("carc_code"))
    assert "BroadcastExchange" not in plan and "BroadcastHashJoin" not in plan
    assert without_code.count("SortMergeJoin") == 1  # the raw segment join only
    assert plan.count("SortMergeJoin") - 1 == plan.count("LeftSemi")  # and the pool's, within its subquery


def test_reason_draw_pruned_when_unused(fresh):
    assert "md5" not in optimized(kpis.clean_claim_rate(fresh.fact))
    assert "md5" in optimized(kpis.top_carc_denials(fresh.fact, fresh.dim_carc_denials))


def test_days_computed_once(fresh):
    assert optimized(fresh.fact).count("datediff(") == 1


def test_latest_snapshot_limits_before_shuffle(fresh):
    assert "WindowGroupLimit" in physical(fresh.dim_patient)


def test_topk_reports_use_take_ordered(fresh):
    by_provider = kpis.clean_claim_rate_by_provider(fresh.fact, sort=False)
    assert "TakeOrderedAndProject" in physical(kpis.worst_providers(by_provider))
    extremes = physical(kpis.provider_extremes(by_provider))
    assert extremes.count("TakeOrderedAndProject") == 2


def test_column_pruning_reaches_the_scan(fresh):
    plan = physical(kpis.clean_claim_rate(fresh.fact))
    scans = [line for line in plan.splitlines() if "lineitem.parquet" in line]
    assert scans and all("l_partkey" not in s and "l_tax" not in s for s in scans)


def test_partition_filter_is_pushed(spark, sf_dir):
    from pyspark.sql import functions as F
    df = registry.queries()["sink_partitioned_roundtrip"](spark, sf_dir)
    plan = physical(df.filter(F.col("claim_type") == "Inpatient"))
    assert "PartitionFilters: [isnotnull(claim_type" in plan and "Inpatient" in plan


def test_no_python_udfs(spark, sf_dir):
    for name, fn in registry.MODELS.items():
        plan = physical(fn(spark, sf_dir))
        assert "EvalPython" not in plan and "PythonUDF" not in plan, name


def test_kpis_never_join_the_fact_to_itself(spark, fresh):
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        for df in (kpis.header_cards(fresh.fact), kpis.claim_type_summary(fresh.fact),
                   kpis.clean_claim_rate(fresh.fact)):
            assert "SortMergeJoin" in physical(df)  # only the raw segment join
            assert physical(df).count("SortMergeJoin") == 1


def test_single_pass_kpis_scan_raw_once(spark, fresh):
    for df in (kpis.header_cards(fresh.fact), kpis.claim_type_summary(fresh.fact),
               kpis.top_carc_denials(fresh.fact, fresh.dim_carc_denials, sort=False),
               kpis.clean_claim_rate(fresh.fact)):
        assert physical(df).count("lineitem.parquet") == 1


def test_stored_fact_pushes_status_filter(spark, fresh):
    from pyspark.sql import functions as F
    stored = fresh.materialize(tables=("fact",))
    plan = physical(stored.fact.filter(F.col("adjudication_status") == "Denied"))
    assert "PushedFilters: [IsNotNull(adjudication_status), EqualTo(adjudication_status,Denied)]" in plan


def scanned(df) -> dict[str, int]:
    """How often the plan scans each stored relation, by the name of its folder."""
    found, todo = {}, [df._jdf.queryExecution().sparkPlan()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            name = node.relation().location().rootPaths().apply(0).getName()
            found[name] = found.get(name, 0) + 1
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_dashboard_scans_the_stored_fact_for_checks_only(fresh):
    stored = fresh.materialize()
    checks = scanned(quality.dq_counts(stored.fact, stored.dim_patient, stored.dim_diagnosis))
    whole = scanned(dashboard.dashboard_rows(stored))
    assert whole["fact"] == checks["fact"] and whole["claim_cells"] >= 5
    for section in ("header_cards", "clean_claim_rate", "top_carc_denials", "ar_aging_matrix", "ar_matrix_top_providers"):
        assert "fact" not in scanned(dashboard.sections(stored)[section])


def test_schema_tests_scan_each_relation_once(fresh):
    found = scanned(quality.schema_test_report(fresh.materialize()))
    assert {found[n] for n in ("fact", "dim_patient", "dim_provider", "dim_diagnosis")} == {1}, found


def test_code_rules_run_on_distinct_codes(fresh):
    for df in (fresh.land().dim_diagnosis, registry.units.circulatory_codes(fresh.land().dim_diagnosis)):
        plan = physical(df)
        assert "regexp_replace" in plan and "regexp_replace" not in plan[plan.index("Exchange"):]
