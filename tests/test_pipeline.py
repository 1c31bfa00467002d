"""Pipeline: one commit for all eight tables, failures leave the published state, exact
year replacement, restart, rollback, dry run, health check, sinks."""

import time

import pytest
from pyspark.sql import functions as F

from occurlens import constants as C
from occurlens.operators import views as V
from occurlens.plans import pipeline as PL
from occurlens.schema import KPI_TABLES
from occurlens.session import held_settings, scratch_path
from occurlens.sinks import tables as SK
from occurlens.sinks import versions as VS


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def published(spark, layout):
    return {n: rows_of(df) for n, df in SK.read_kpis(spark, layout.root).items()}


@pytest.fixture(scope="module")
def few(raw_small):
    """Three years of the fixture and its rows without a year."""
    return raw_small.filter(F.col("ANO").isin("1996", "1997", "1998", "")).checkpoint(eager=True)


@pytest.fixture(scope="module")
def base(spark, few):
    out = PL.Layout(scratch_path(spark, "base"))
    assert PL.run_pipeline(spark, out, few).ok
    return VS.current(spark, out.root)


@pytest.fixture()
def layout(spark, base):
    """A layout of its own whose state is the full run's (folders are never written again)."""
    out = PL.Layout(scratch_path(spark, "pipe"))
    VS.commit(spark, out.root, base)
    return out


def full_of(spark, raw):
    out = PL.Layout(scratch_path(spark, "full"))
    assert PL.run_pipeline(spark, out, raw).ok
    return published(spark, out)


def test_refresh_equals_full_run_after_change(spark, few, layout):
    # Half of 1998 goes, and with it every capital row; 1997 disappears from raw.
    y1998 = F.col("ANO") == "1998"
    changed = few.filter(~(y1998 & (F.col("NUM_BO").cast("long") % 2 == 0))
                         & ~(y1998 & F.col("NOME_MUNICIPIO_CIRC").startswith("S.PAULO")) & (F.col("ANO") != "1997"))
    PL.ingest(changed, layout)
    before = published(spark, layout)
    report = PL.refresh_years(spark, layout, [1998, 3000])
    assert report.ok and report.published
    got = published(spark, layout)
    assert got == full_of(spark, changed) and got != before
    assert not any(r[0] == 1997 for r in got[C.KPI_ANNUAL])
    assert not any(r[0] == 1998 for r in got[C.KPI_BAIRRO])


def test_year_left_without_clean_rows_is_removed(spark, few, layout):
    changed = few.withColumn("FLAG_STATUS", F.when(F.col("ANO") == "1998", "TENTADO").otherwise(F.col("FLAG_STATUS")))
    PL.ingest(changed, layout)
    assert PL.refresh_years(spark, layout, [1998]).ok
    assert published(spark, layout) == full_of(spark, changed)
    assert PL.read_clean(spark, layout, [1998]).count() == 0


def test_failing_write_publishes_nothing(spark, few, layout, monkeypatch):
    before, real = published(spark, layout), SK.write_partitioned

    def broken(df, path, partition_by=None):
        if path.endswith(C.KPI_HOUR):
            raise OSError("disk " + "x" * 600)
        return real(df, path, partition_by)

    monkeypatch.setattr(SK, "write_partitioned", broken)
    report = PL.run_pipeline(spark, layout, few.filter(F.col("ANO") == "1996"))
    assert not report.ok and report.published is None
    (bad,) = SK.failed(report.loads)
    assert bad.tabela == C.KPI_HOUR and bad.status.endswith("x" * 600)
    PL.ingest(few.filter(F.col("ANO") == "1996"), layout)
    refreshed = PL.refresh_years(spark, layout, [1996])
    assert refreshed.failed_years and not refreshed.ok
    monkeypatch.undo()
    assert published(spark, layout) == before


def test_failing_read_is_raised_not_taken_for_missing(spark, layout):
    assert VS.current(spark, layout.root + "-nowhere") == VS.Manifest()
    fs, name = VS._file_system(spark, layout.root), VS._name(layout.root, VS.current(spark, layout.root).seq + 1)
    stream = fs.create(VS._path(spark, name), False)
    stream.write(bytearray(b"{half a manif"))
    stream.close()
    with pytest.raises(ValueError):
        VS.current(spark, layout.root)
    with pytest.raises(ValueError):
        PL.read_raw(spark, layout)


def test_of_two_runs_from_one_state_one_commits(spark, few, layout, monkeypatch):
    before = VS.current(spark, layout.root)
    other = before.with_(kpis="elsewhere")
    assert VS.commit(spark, layout.root, other) == before.seq + 1
    with pytest.raises(VS.CommitConflict):
        VS.commit(spark, layout.root, before.with_(clean_rows=7))
    assert VS.current(spark, layout.root) == other and VS.rollback(spark, layout.root) == before
    # a full run that loses its race publishes nothing
    real, won = PL._write_version, []

    def race(spark_, layout_, *args):
        out = real(spark_, layout_, *args)
        if not won:
            won.append(VS.commit(spark, layout.root, VS.current(spark, layout.root).with_(files="the other run")))
        return out

    monkeypatch.setattr(PL, "_write_version", race)
    with pytest.raises(VS.CommitConflict):
        PL.run_pipeline(spark, layout, few.filter(F.col("ANO") == "1996"))
    assert VS.current(spark, layout.root) == before.with_(files="the other run")


def test_refresh_runs_again_after_a_conflict(spark, few, layout, monkeypatch):
    """Raw changes in 1997 and 1998; while 1998 is refreshed, another run refreshes 1997."""
    gone = F.col("ANO").isin("1997", "1998") & (F.col("NUM_BO").cast("long") % 2 == 0)
    changed = few.filter(~gone)
    PL.ingest(changed, layout)
    real, inner = PL._write_version, []

    def race(spark_, layout_, *args):
        out = real(spark_, layout_, *args)
        if not inner:
            inner.append(True)
            assert PL.refresh_years(spark, layout, [1997]).ok
        return out

    monkeypatch.setattr(PL, "_write_version", race)
    assert PL.refresh_years(spark, layout, [1998]).ok
    monkeypatch.undo()
    assert published(spark, layout) == full_of(spark, changed)


def test_two_ingests_at_once_both_commit_and_the_later_stays(spark, few, layout, monkeypatch):
    real, first = PL._write_raw, []

    def race(*args):
        out = real(*args)
        if not first:
            first.append(True)
            PL.ingest(few.filter(F.col("ANO") == "1996"), layout)
        return out

    monkeypatch.setattr(PL, "_write_raw", race)
    n = PL.ingest(few.filter(F.col("ANO") == "1997"), layout)
    assert PL.years_stored(spark, layout) == [1997] and PL.read_raw(spark, layout).count() == n


def test_corrupted_files_block_publishing(spark, few, layout, monkeypatch):
    """A row lost after the write observed it, and a cut table with a row too few counts."""
    before, real = published(spark, layout), PL.write_kpis

    def lossy(kpis, folder):
        out = real(kpis, folder)
        path = f"{folder}/{C.KPI_BRAND}"
        rows = spark.read.schema(SK.KPI_SCHEMAS[C.KPI_BRAND]).parquet(path).checkpoint(eager=True)
        rows.limit(rows.count() - 1).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("ano").parquet(path)
        return out

    monkeypatch.setattr(PL, "write_kpis", lossy)
    report = PL.run_pipeline(spark, layout, few.filter(F.col("ANO") != "1997"))
    assert not report.ok and report.loads[-1].tabela == C.KPI_BRAND and "gravacao" in report.loads[-1].status
    assert published(spark, layout) == before


def test_files_follow_bytes_not_tasks(spark, few):
    """200 input splits and four years: a few files; a year of many bytes is split."""
    out = PL.Layout(scratch_path(spark, "files"))
    raw = few.repartition(200).checkpoint(eager=True)
    PL.ingest(raw, out)
    PL.run_clean(spark, out)
    state = VS.current(spark, out.root)
    for folders in (state.raw, state.clean):
        (folder,) = set(folders.values())
        assert len(spark.read.parquet(folder).inputFiles()) <= 2 * len(folders)
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    try:
        PL.ingest(raw, out)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    files = spark.read.parquet(VS.current(spark, out.root).raw[1997]).inputFiles()
    assert len([f for f in files if "ANO=1997" in f]) > 1
    assert PL.read_raw(spark, out).count() == few.count()


def _shuffle_files(spark) -> set[str]:
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (found.apply(i).getName() for i in range(found.size())) if n.startswith("shuffle_")}


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def test_shuffle_files_go_when_a_write_ends(spark, few):
    """Not when the driver collects its garbage; the session's settings are as before."""
    before = _shuffle_files(spark)
    PL.ingest(few.repartition(3), PL.Layout(scratch_path(spark, "freed")))
    until = time.time() + 30  # they are removed in the background
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before
    assert spark.conf.get(CLEANUP, None) is None


def test_rows_straight_from_files_are_not_shuffled(spark, few):
    """Raw from files and clean from raw: no shuffle file (kept here by the session's own setting). With
    more years than a task keeps writers for, every row is stored too."""
    path, out = scratch_path(spark, "source"), PL.Layout(scratch_path(spark, "direct"))
    years = few.unionByName(few.limit(100).withColumn("ANO", (F.monotonically_increasing_id() % 40 + 1950).cast("string")))
    years.coalesce(4).write.parquet(path)
    raw = spark.read.schema(few.schema).parquet(path)
    spark.conf.set(CLEANUP, "false")
    try:
        before = _shuffle_files(spark)
        n = SK.write_partitioned(raw, f"{out.root}/alone", "ANO", balanced=True)
        assert not _shuffle_files(spark) - before
        assert spark.conf.get(CLEANUP) == "false"
    finally:
        spark.conf.unset(CLEANUP)
    assert n == raw.count() and spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None) is None
    assert PL.ingest(raw, out) == n
    stored = PL.read_raw(spark, out).select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in raw.columns])
    blank = raw.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in raw.columns])
    assert stored.exceptAll(blank).isEmpty() and blank.exceptAll(stored).isEmpty()
    assert SK.scans_files_only(PL.clean_step(PL.read_raw(spark, out)))
    assert not SK.scans_files_only(raw.repartition(2)) and not SK.scans_files_only(few.checkpoint(eager=True))


def test_held_settings_may_overlap(spark):
    key, own = "spark.sql.maxConcurrentOutputFileWriters", "spark.sql.shuffle.partitions"
    had = spark.conf.get(own)
    a, b = held_settings(spark, {key: "3", own: "77"}), held_settings(spark, {key: "3"})
    a.__enter__()
    b.__enter__()
    a.__exit__(None, None, None)
    assert spark.conf.get(key) == "3" and spark.conf.get(own) == had
    b.__exit__(None, None, None)
    assert spark.conf.get(key, None) is None and spark.conf.get(own) == had


def test_null_key_rows_go_aside_and_are_counted(spark, few, layout):
    folder = VS.current(spark, layout.root).kpis
    aside = spark.read.parquet(f"{folder}/sem_chave/{C.KPI_ANNUAL}")
    assert aside.count() > 0 and aside.filter("ano is not null").count() == 0
    assert all(r[0] is not None for rows in published(spark, layout).values() for r in rows)
    loads = PL.run_pipeline(spark, layout, few, dry_run=True).loads
    assert any("sem chave" in r.status for r in loads) and not SK.failed(loads)


def test_dry_run_commits_nothing(spark, few, layout):
    before, log = published(spark, layout), VS.history(spark, layout.root)
    report = PL.run_pipeline(spark, layout, few.filter(F.col("ANO") == "1996"), dry_run=True)
    assert report.ok and report.published is None
    assert VS.history(spark, layout.root) == log and published(spark, layout) == before


def test_rollback_returns_to_the_state_before(spark, few, layout):
    before = published(spark, layout)
    assert PL.run_pipeline(spark, layout, few.filter(F.col("ANO") == "1996")).ok
    assert published(spark, layout) != before
    PL.rollback(spark, layout.root)
    assert published(spark, layout) == before
    with pytest.raises(ValueError):
        PL.rollback(spark, layout.root, 99)


def test_tampered_table_blocks_publishing(spark, few, layout, monkeypatch):
    before, real = published(spark, layout), PL.write_kpis

    def tampered(kpis, folder):
        kpis[C.KPI_MONTHLY] = kpis[C.KPI_MONTHLY].withColumn("total", F.col("total") + 1)
        return real(kpis, folder)

    monkeypatch.setattr(PL, "write_kpis", tampered)
    report = PL.run_pipeline(spark, layout, few.filter(F.col("ANO") != "1997"))
    assert not report.ok and report.loads[-1].tabela == f"{C.KPI_MONTHLY}_dentro_das_contagens"
    assert published(spark, layout) == before


def test_restart_from_kpis_and_missing_steps(spark, few, layout):
    first = published(spark, layout)
    assert PL.run_pipeline(spark, layout, from_step="kpis").ok
    assert published(spark, layout) == first
    empty = PL.Layout(scratch_path(spark, "empty"))
    with pytest.raises(FileNotFoundError, match="ingest"):
        PL.run_pipeline(spark, empty, from_step="clean")
    with pytest.raises(FileNotFoundError, match="clean"):
        PL.run_kpis(spark, empty)


def test_years_by_listing_ignore_blank(spark, layout):
    assert PL.years_stored(spark, layout) == [1996, 1997, 1998]


def test_rankings_use_uncut_counts(spark, layout):
    board = V.dashboard(SK.read_kpis(spark, layout.root), PL.read_counts(spark, layout))
    clean = PL.read_clean(spark, layout).filter(F.col("municipio").isNotNull())
    best = clean.groupBy("municipio").count().orderBy(F.desc("count"), "municipio").first()
    top = board["municipality_ranking"].orderBy("posicao").first()
    assert (top["municipio"], top["total"]) == (best["municipio"], best["count"])


def test_ordered_outputs(spark, layout):
    kpi = SK.read_kpi(spark, layout.root, C.KPI_MUNICIPALITY, ordered=True).collect()
    assert [(r.ano, -r.total, r.municipio) for r in kpi] == sorted((r.ano, -r.total, r.municipio) for r in kpi)
    annual = SK.read_kpi(spark, layout.root, C.KPI_ANNUAL, ordered=True)
    keys = [(r.tipo_crime, r.ano) for r in annual.collect()]
    assert keys == sorted(keys)
    years = [r.ano for r in V.years(annual).collect()]
    assert years == sorted(years, reverse=True)


def test_publish_rejects_duplicate_keys_and_out_of_range_changes(spark):
    schema = "ano int, tipo_crime string, total long, variacao_yoy_pct double"
    for rows, message in (([(2020, "Furto", 1, None), (2020, "Furto", 2, None)], "ERRO chaves"),
                          ([(2021, "Furto", 4, 12345.678)], "ERRO faixa")):
        folder = scratch_path(spark, "pub")
        spark.createDataFrame(rows, schema).write.partitionBy("ano").parquet(f"{folder}/{C.KPI_ANNUAL}")
        got = {r.tabela: r.status for r in SK.check_version(spark, folder)}
        assert got[C.KPI_ANNUAL].startswith(message) and got[C.KPI_HOUR] == "ERRO tabela ausente"
    assert set(got) == set(KPI_TABLES)


def test_sink_types(spark):
    schema = "ano int, tipo_crime string, total long, variacao_yoy_pct double"
    good = SK.to_sink_types(spark.createDataFrame([(2020, "Furto", 3_000_000_000, float("nan")), (2021, "Furto", 4, 9999.99)], schema))
    assert dict(good.dtypes)["variacao_yoy_pct"] == "decimal(6,2)"
    rows = good.orderBy("ano").collect()
    assert rows[0]["total"] == 3_000_000_000 and rows[0]["variacao_yoy_pct"] is None and float(rows[1]["variacao_yoy_pct"]) == 9999.99
    with pytest.raises(Exception, match="out of range"):
        SK.to_sink_types(spark.createDataFrame([(2021, "Furto", 4, 12345.6)], schema)).collect()
    with pytest.raises(ValueError, match="replace-by-year"):
        SK.write_jdbc(good, "jdbc:none", "t", years=[2020])
