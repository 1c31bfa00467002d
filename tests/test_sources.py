"""Multi-file source: header groups, missing columns, lock files, padding,
file-level year derivation, drift report."""

import os

from occurlens import constants as C
from occurlens.session import scratch_path
from occurlens.sources import files as SF


def write(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(",".join(header) + "\n")
        for r in rows:
            f.write(",".join(r) + "\n")


def local(p):
    return p.replace("file://", "").replace("file:", "")


def test_files_with_different_headers(spark):
    root = local(scratch_path(spark, "src"))
    full = C.REQUIRED_COLUMNS + ["EXTRA"]
    row = {c: "" for c in full}
    row.update(ANO_BO="2017", NUM_BO="1", NOME_MUNICIPIO_CIRC="S.PAULO   ", DATA_OCORRENCIA_BO="2017-03-04",
               HORA_OCORRENCIA="10:00:00", RUBRICA="Roubo", FLAG_STATUS="CONSUMADO", MES="3", ANO="2017")
    write(f"{root}/CelularesSubtraidos_2017.csv", full, [[row[c] for c in full]])
    # A newer file: no ANO / MES, columns in another order.
    newer = [c for c in reversed(C.REQUIRED_COLUMNS) if c not in ("ANO", "MES")]
    r2 = dict(row, DATA_OCORRENCIA_BO="2025-07-08", ANO_BO="2025")
    write(f"{root}/CelularesSubtraidos_2025.csv", newer, [[r2[c] for c in newer]])
    write(f"{root}/~$CelularesSubtraidos_2025.csv", newer, [[r2[c] for c in newer]])
    write(f"{root}/notes.csv", ["a"], [["b"]])

    df = SF.read_occurrence_files(spark, root)
    got = {r["ARQUIVO_ORIGEM"]: r for r in df.collect()}
    assert set(got) == {"CelularesSubtraidos_2017.csv", "CelularesSubtraidos_2025.csv"}
    assert df.columns == C.REQUIRED_COLUMNS + [C.LINEAGE_COLUMN]
    old, new = got["CelularesSubtraidos_2017.csv"], got["CelularesSubtraidos_2025.csv"]
    assert old["NOME_MUNICIPIO_CIRC"] == "S.PAULO   " and old["ANO"] == "2017" and old["MES"] == "3"
    assert new["ANO"] == "2025" and new["MES"] == "7" and new["ANO_BO"] == "2025"
    assert new["BAIRRO"] == "" and new["RUBRICA"] == "Roubo"
    drift = [tuple(r) for r in SF.schema_drift(spark, root).collect()]
    assert drift == [("CelularesSubtraidos_2025.csv", "MES,ANO")]


def test_year_derivation_only_when_whole_file_blank(spark):
    rows = [("2020-05-01", "", "", "a"), ("2020-06-01", "2020", "6", "a"),
            ("2021-07-02", "", "", "b"), ("bad", "", "", "b")]
    schema = "DATA_OCORRENCIA_BO string, ANO string, MES string, ARQUIVO_ORIGEM string"
    out = SF.derive_year_month(spark.createDataFrame(rows, schema))
    got = sorted((r["ARQUIVO_ORIGEM"], r["DATA_OCORRENCIA_BO"], r["ANO"], r["MES"]) for r in out.collect())
    assert got == [("a", "2020-05-01", "", ""), ("a", "2020-06-01", "2020", "6"),
                   ("b", "2021-07-02", "2021", "7"), ("b", "bad", "", "")]


def test_latin1_files_with_encoding_option(spark):
    root = local(scratch_path(spark, "latin1"))
    os.makedirs(root, exist_ok=True)
    header = C.REQUIRED_COLUMNS
    row = {c: "" for c in header}
    row.update(BAIRRO="Consolação", ANO="2019", DATA_OCORRENCIA_BO="2019-01-02")
    with open(f"{root}/CelularesSubtraidos_2019.csv", "w", encoding="latin-1") as f:
        f.write(",".join(header) + "\n" + ",".join(row[c] for c in header) + "\n")
    df = SF.read_occurrence_files(spark, root, options={"encoding": "ISO-8859-1"})
    assert df.first()["BAIRRO"] == "Consolação"


def test_raw_schema_check(spark):
    from occurlens.schema import check_raw_schema
    import pytest

    bad = spark.createDataFrame([(1, "x")], "ANO_BO int, NUM_BO string")
    with pytest.raises(ValueError, match="raw schema mismatch"):
        check_raw_schema(bad)


def test_many_small_files_with_odd_names_in_few_jobs(spark):
    root = local(scratch_path(spark, "many"))
    header = C.REQUIRED_COLUMNS
    for i in range(300):
        cols = header if i % 3 else [c for c in header if c != "CIDADE"]
        row = {c: "" for c in header} | {"ANO": "2020", "NUM_BO": str(i), "BAIRRO": '"a, b"'}
        write(f"{root}/CelularesSubtraidos_são paulo+{i} %41.csv", cols, [[row[c] for c in cols]])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("many", "many")
    got = SF.read_occurrence_files(spark, root, derive_year=False).collect()
    jobs = len(tracker.getJobIdsForGroup("many"))
    drift = SF.schema_drift(spark, root).collect()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(got) == 300 and jobs <= 12
    assert {r["ARQUIVO_ORIGEM"] for r in got} == {f"CelularesSubtraidos_são paulo+{i} %41.csv" for i in range(300)}
    assert {r["BAIRRO"] for r in got} == {"a, b"}
    assert len(drift) == 100 and {r["colunas_ausentes"] for r in drift} == {"CIDADE"}


def test_missing_folder_and_parquet_files(spark):
    import pytest

    with pytest.raises(FileNotFoundError):
        SF.read_occurrence_files(spark, scratch_path(spark, "nothing"))
    root = scratch_path(spark, "pq")
    for year, drop in ((2019, []), (2020, ["CIDADE"])):
        row = {c: "x" for c in C.REQUIRED_COLUMNS if c not in drop}
        spark.createDataFrame([row]).coalesce(1).write.parquet(f"{root}/y{year}")
    df = SF.read_occurrence_files(spark, [f"{root}/y2019", f"{root}/y2020"], "part-*", fmt="parquet", derive_year=False)
    assert sorted(r["CIDADE"] for r in df.collect()) == ["", "x"]


def blank_row(**values):
    return {c: "" for c in C.REQUIRED_COLUMNS} | values


def test_every_line_is_parsed_once_whatever_the_headers(spark):
    root = local(scratch_path(spark, "parse"))
    for i, drop in enumerate(([], ["CIDADE"], ["MES", "ANO"])):
        cols = [c for c in C.REQUIRED_COLUMNS if c not in drop]
        write(f"{root}/CelularesSubtraidos_{i}.csv", cols, [[blank_row(NUM_BO=str(i))[c] for c in cols]])
    df = SF.read_occurrence_files(spark, root, derive_year=False)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv(") == 1
    assert "from_csv(" not in SF.read_occurrence_files(spark, root)._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r["NUM_BO"] for r in df.collect()) == ["0", "1", "2"]


def test_line_breaks_inside_cells_stay_in_their_cell(spark):
    """Files with and without them, two headers, a file in cp1252, odd characters in names."""
    root = local(scratch_path(spark, "breaks"))
    cells = ['"Vila\nMariana"', '"a ""quoted"" part\r\nof Sé"', "plain"]
    short = [c for c in reversed(C.REQUIRED_COLUMNS) if c != "CIDADE"]
    options = {"escape": '"'}
    for name, cols, encoding in (("1 [a]", C.REQUIRED_COLUMNS, "utf-8"), ("2 {b}", short, "utf-8"), ("3 %41", C.REQUIRED_COLUMNS, "cp1252")):
        os.makedirs(root, exist_ok=True)
        with open(f"{root}/CelularesSubtraidos_{name}.csv", "w", encoding=encoding, newline="") as f:
            f.write(",".join(cols) + "\n")
            for i, cell in enumerate(cells):
                f.write(",".join(blank_row(NUM_BO=str(i), BAIRRO=cell, ANO="2020")[c] for c in cols) + "\n")
    write(f"{root}/CelularesSubtraidos_4.csv", C.REQUIRED_COLUMNS, [[blank_row(NUM_BO="9", BAIRRO='"one, line"', ANO="2020")[c] for c in C.REQUIRED_COLUMNS]])
    probe = {SF.unquote(r["file"]).split("_")[-1]: (r["encoding"], r["by_record"]) for r in SF.probe_files(spark, root, options=options).collect()}
    assert probe == {"1 [a].csv": ("UTF-8", True), "2 {b}.csv": ("UTF-8", True), "3 %41.csv": ("windows-1252", True), "4.csv": ("UTF-8", False)}
    for derive in (True, False):
        got = sorted((r["ARQUIVO_ORIGEM"][20:], r["NUM_BO"], r["BAIRRO"], r["ANO"]) for r in
                     SF.read_occurrence_files(spark, root, options=options, derive_year=derive).collect())
        want = [(f"{n}.csv", str(i), b, "2020") for n in ("1 [a]", "2 {b}", "3 %41")
                for i, b in enumerate(["Vila\nMariana", 'a "quoted" part\r\nof Sé', "plain"])]
        assert got == [*want, ("4.csv", "9", "one, line", "2020")]


def test_header_with_a_line_break_is_an_error(spark):
    import pytest

    root = local(scratch_path(spark, "header"))
    write(f"{root}/CelularesSubtraidos_1.csv", ["ANO_BO", '"NUM\nBO"'], [["2020", "1"]])
    with pytest.raises(ValueError, match="line break"):
        SF.read_occurrence_files(spark, root)


def test_encoding_is_found_per_file(spark):
    root = local(scratch_path(spark, "encodings"))
    os.makedirs(root, exist_ok=True)
    for name, encoding in (("2019", "cp1252"), ("2020", "utf-8"), ("2021", "utf-8-sig")):
        with open(f"{root}/CelularesSubtraidos_{name}.csv", "w", encoding=encoding) as f:
            f.write(",".join(C.REQUIRED_COLUMNS) + "\n")
            for i in range(50):  # one line in fifty tells the encoding
                f.write(",".join(blank_row(BAIRRO="Consolação – 5€" if i == 49 else "Centro", ANO=name)[c] for c in C.REQUIRED_COLUMNS) + "\n")
    got = SF.read_occurrence_files(spark, root).filter("BAIRRO <> 'Centro'").collect()
    assert sorted((r["ANO"], r["BAIRRO"]) for r in got) == [(y, "Consolação – 5€") for y in ("2019", "2020", "2021")]


def test_parquet_drift_lists_missing_and_retyped_columns(spark):
    root = scratch_path(spark, "drift")
    row = {c: "x" for c in C.REQUIRED_COLUMNS}
    for origin, df in (("a", spark.createDataFrame([row])), ("b [1] 100%", spark.createDataFrame([row]).drop("CIDADE", "MES")),
                       ("c", spark.createDataFrame([row | {"ANO": 2020, "LATITUDE": -23.5}]))):
        df.repartition(2).write.parquet(f"{root}/ARQUIVO_ORIGEM={origin}")
    got = sorted(tuple(r) for r in SF.schema_drift_columnar(spark, root, "part-*").collect())
    assert got == [("b [1] 100%", "CIDADE,MES", ""), ("c", "", "LATITUDE:double,ANO:bigint")]


def put(root, name, year, numbers, header=None):
    cols = header or C.REQUIRED_COLUMNS
    rows = [blank_row(NUM_BO=str(n), ANO=str(y), MES="1", DATA_OCORRENCIA_BO=f"{y or 2031}-01-02", RUBRICA="Roubo", FLAG_STATUS="CONSUMADO")
            for y in ([year] if not isinstance(year, list) else year) for n in numbers]
    write(f"{root}/CelularesSubtraidos_{name}.csv", cols, [[r[c] for c in cols] for r in rows])


def test_ingest_reads_and_writes_what_changed(spark, monkeypatch):
    """After a changed, a new and a vanished file: those files alone are read, their years alone
    are written, and raw equals a full ingest."""
    from occurlens.plans import pipeline as PL
    from occurlens.sinks import versions as VS

    root, out = local(scratch_path(spark, "landing")), PL.Layout(scratch_path(spark, "inc"))
    put(root, "a", 2018, range(5))
    put(root, "b", [2019, 2020], range(3))
    put(root, "c", 2020, range(10, 14))
    put(root, "d", 2021, range(2))
    put(root, "e", "", range(2), [c for c in C.REQUIRED_COLUMNS if c not in ("ANO", "MES")])  # year from its dates: 2031
    assert PL.ingest_files(spark, out, root) == [2018, 2019, 2020, 2021, 2031]
    first = VS.current(spark, out.root)
    assert PL.ingest_files(spark, out, root) == [] and VS.current(spark, out.root) == first

    def rows():
        return sorted(tuple(r) for r in PL.read_raw(spark, out).select("ARQUIVO_ORIGEM", "NUM_BO", "ANO", "DATA_OCORRENCIA_BO").collect())

    put(root, "b", [2020, 2022], range(4))   # loses 2019, gains 2022
    os.remove(f"{root}/CelularesSubtraidos_d.csv")
    put(root, "f", 2023, range(1))
    read, real = [], PL.read_occurrence_files
    monkeypatch.setattr(PL, "read_occurrence_files", lambda s, files, **k: read.extend(files) or real(s, files, **k))
    assert PL.ingest_files(spark, out, root) == [2019, 2020, 2021, 2022, 2023]
    assert sorted(f.rsplit("_", 1)[1] for f in read) == ["b.csv", "f.csv"]
    now = VS.current(spark, out.root)
    assert set(now.raw) == {2018, 2020, 2022, 2023, 2031} and all(now.raw[y] == first.raw[y] for y in (2018, 2031))
    got, full = rows(), PL.Layout(scratch_path(spark, "full"))
    PL.ingest(real(spark, root), full)
    out = full
    assert got == rows()


def _joins(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    shuffled = df._jdf.queryExecution().sparkPlan().toString()
    return plan.count("Join"), shuffled.count("SortMergeJoin") + shuffled.count("ShuffledHashJoin")


def test_rows_are_not_shuffled_by_file(spark):
    """Neither the lines nor the parsed rows come to one task per file, whatever the table sizes."""
    root = local(scratch_path(spark, "src"))
    write(f"{root}/CelularesSubtraidos_2017.csv", C.REQUIRED_COLUMNS, [["2017"] * len(C.REQUIRED_COLUMNS)])
    raw = spark.createDataFrame([("2020-05-01", "", "", "a"), ("2020-05-01", "", "", None)],
                                "DATA_OCORRENCIA_BO string, ANO string, MES string, ARQUIVO_ORIGEM string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (SF.derive_year_month(raw), SF.read_occurrence_files(spark, root, derive_year=False)):
            joins, shuffled = _joins(df)
            assert joins and not shuffled
        assert sorted((r["ARQUIVO_ORIGEM"] or "", r["ANO"]) for r in SF.derive_year_month(raw).collect()) == [("", ""), ("a", "2020")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
