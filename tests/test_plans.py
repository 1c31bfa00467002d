"""Plan checks: pruning, pushdown, top-N as WindowGroupLimit, no Python."""

import os

from pyspark.sql import functions as F

from occurlens.operators import extras as X
from occurlens.operators import kpis as K
from occurlens.operators.clean import clean
from occurlens.plans import pipeline as PL
from occurlens.plans.queries import REGISTRY
from occurlens.schema import KPI_SCHEMAS
from occurlens.session import scratch_path
from occurlens.sources.fixture import raw_from_tables
from conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_year_filter_prunes_partitions(spark, raw_small):
    layout = PL.Layout(scratch_path(spark, "plan"))
    PL.ingest(raw_small, layout)
    df = PL.read_raw(spark, layout).filter(F.col("ANO") == 1998)
    text = plan(df)
    assert "PartitionFilters: [isnotnull(ANO" in text and "= 1998" in text


def test_filters_reach_the_scan_of_the_clean_write(spark, raw_small, monkeypatch):
    """The plan that the pipeline writes, observation included."""
    layout, seen = PL.Layout(scratch_path(spark, "plan")), []
    PL.ingest(raw_small, layout)
    real = PL.clean_step
    monkeypatch.setattr(PL, "clean_step", lambda df, **k: seen.append(real(df, **k)) or seen[-1])
    PL.run_clean(spark, layout)
    observed = seen[0].observe("n", F.count(F.lit(1)))
    assert "GreaterThanOrEqual(DATA_OCORRENCIA_BO,1900-01-01)" in plan(observed)


def test_scan_reads_only_needed_columns(spark):
    text = plan(REGISTRY["kpi_annual_summary"][0](spark, SF_SMALL))
    reads = [line for line in text.splitlines() if "ReadSchema" in line]
    assert reads and all("l_extendedprice" not in r and "p_name" not in r and "c_mktsegment" not in r for r in reads)


def test_top_n_is_window_group_limit(clean_small):
    assert "WindowGroupLimit" in optimized(K.kpi_by_brand(clean_small))


def test_no_python_in_any_plan(spark):
    for name in ("clean_full", "kpi_by_hour", "view_cards", "raw_derive_year_month", "topn_per_year"):
        text = plan(REGISTRY[name][0](spark, SF_SMALL))
        assert "Python" not in text and "ArrowEval" not in text, name


def test_one_pass_kpis_single_scan(clean_small):
    grouped = K.grouped_counts(clean_small)
    assert "Expand" in plan(grouped)


# Queries whose construction writes files first (pipeline, file sources).
EAGER = {"raw_ingest", "raw_projection", "raw_incremental", "schema_drift", "schema_drift_parquet", "load_report", "kpi_refresh_year",
         "discover_years", "kpi_integrity", "kpi_reconcile"}


def test_no_cross_join_or_python_in_registered_queries(spark):
    for name, (fn, _) in sorted(REGISTRY.items()):
        if name in EAGER:
            continue
        text = plan(fn(spark, SF_SMALL))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
            assert bad not in text, (name, bad)


def test_capital_filter_runs_before_the_derivation(spark, raw_small):
    """Neighbourhood counts filter on the municipality below the cleaning projection."""
    layout = PL.Layout(scratch_path(spark, "plan"))
    PL.ingest(raw_small, layout)
    text = optimized(K.kpi_by_bairro(clean(PL.read_raw(spark, layout))))
    lowest = [line for line in text.splitlines() if "Filter (" in line][-1]  # the one next to the scan
    assert "S.PAULO" in lowest and "translate" not in lowest


def test_top_n_per_year_has_a_group_limit(clean_small):
    assert "WindowGroupLimit" in optimized(X.topn_per_year(clean_small))


def test_single_split_scan_is_spread_over_the_cores(spark):
    from occurlens.sources.fixture import read_table, spread

    lineitem = read_table(spark, SF_SMALL, "lineitem")
    many = lineitem.repartition(spark.sparkContext.defaultParallelism)
    assert spread(many) is many
    if lineitem.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism:
        text = plan(spread(lineitem))
        assert "RoundRobinPartitioning" in text and "hashpartitioning" not in text


def test_clean_stage_is_small_enough_to_compile(spark, raw_small):
    """Over stored raw its generated methods stay below the JVM's 8,000 bytes; a larger stage (clean
    fused with the fixture's expressions) runs without whole-stage code, by the session's limit."""
    import re

    path = scratch_path(spark, "stored")
    raw_small.write.parquet(path)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        executed = clean(spark.read.schema(raw_small.schema).parquet(path))._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    code = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(executed)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000


def test_normalize_bairro_can_be_stored(spark):
    """Its columns differ in case only; the session it is called with stays as it is."""
    from occurlens.plans.queries import REGISTRY
    from occurlens.session import case_sensitive, scratch_path

    before = spark.conf.get("spark.sql.caseSensitive")
    df, path = REGISTRY["normalize_bairro"][0](spark, SF_SMALL), scratch_path(spark, "bairro")
    df.write.parquet(path)
    stored = case_sensitive(spark).read.parquet(path)
    assert stored.columns == ["BAIRRO", "bairro"] and sorted(map(str, stored.collect())) == sorted(map(str, df.collect()))
    assert spark.conf.get("spark.sql.caseSensitive") == before


def test_refresh_query_joins_the_tables_once(spark, monkeypatch):
    """Both runs of the refresh query read one stored raw table."""
    seen = []

    def run_pipeline(spark, layout, raw):
        seen.append(raw)

    monkeypatch.setattr(PL, "run_pipeline", run_pipeline)
    monkeypatch.setattr(PL, "ingest", lambda raw, layout: seen.append(raw))
    monkeypatch.setattr(PL, "refresh_years", lambda *a: None)
    monkeypatch.setattr("occurlens.sinks.tables.read_kpis", lambda *a: {t: spark.createDataFrame([], s) for t, s in KPI_SCHEMAS.items()})
    REGISTRY["kpi_refresh_year"][0](spark, SF_SMALL)
    assert len(seen) == 2 and all("Join" not in optimized(df) for df in seen)
    stored, fixture = seen[1], raw_from_tables(spark, SF_SMALL)
    assert stored.schema.names == fixture.schema.names
    assert stored.exceptAll(fixture).isEmpty() and fixture.exceptAll(stored).isEmpty()


def test_stored_raw_is_joined_slice_after_slice(spark, monkeypatch):
    """Every row once, whatever the slices; a slice's filter reaches both scans that have the number."""
    from occurlens.plans import queries as Q
    from occurlens.schema import RAW_SCHEMA

    raw = raw_from_tables(spark, SF_SMALL)
    assert Q._slices(raw) == 1
    size = sum(os.path.getsize(f"{SF_SMALL}/{t}.parquet") for t in ("lineitem", "orders", "customer", "nation", "part"))
    monkeypatch.setattr(Q, "SLICE_BYTES", -(-size // 3))
    assert Q._slices(raw) == 3
    writes, real = [], Q.SK.write_partitioned
    monkeypatch.setattr(Q.SK, "write_partitioned", lambda df, *a, **k: writes.append(df) or real(df, *a, **k))
    stored = Q._stored(raw)
    assert len(writes) == 3 and stored.dtypes == raw.dtypes
    assert stored.exceptAll(raw).isEmpty() and raw.exceptAll(stored).isEmpty()
    for df in writes:
        scans = [x for x in plan(df).splitlines() if "Filter" in x and "xxhash64" in x and "FileScan" not in x]
        assert len(scans) == 2 and "l_orderkey" in scans[0] + scans[1] and "o_orderkey" in scans[0] + scans[1]
    odd = spark.createDataFrame([tuple(n if c == "NUM_BO" else "x" for c in RAW_SCHEMA.names) for n in (None, None, "7", "7", "a")], RAW_SCHEMA)
    path = scratch_path(spark, "odd")
    odd.write.parquet(path)
    odd = spark.read.schema(RAW_SCHEMA).parquet(path)
    monkeypatch.setattr(Q, "SLICE_BYTES", 1)
    assert sorted(map(str, Q._stored(odd).collect())) == sorted(map(str, odd.collect())) and len(writes) == 3 + Q.MAX_SLICES


def test_joins_shuffle_no_texts_made_from_them(spark):
    """The dates' texts and the nation's name are made above the joins, not carried through their shuffles."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = plan(raw_from_tables(spark, SF_SMALL)).splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    first = next(i for i, x in enumerate(lines) if "SortMergeJoin" in x)
    own = [x for x in lines[first:] if "Project [" in x]
    assert own and not any("lpad" in x or "n_name" in x for x in own)
