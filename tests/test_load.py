"""Scan, full refresh, export and the whole job."""

from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from wide_rows import CONFIG, frame, full, row

from starmill import job
from starmill.operators import quality
from starmill.plans import load, queries, validate
from starmill.plans.build import build_grain, build_star, rolled_up
from starmill.plans.load import (
    append_star,
    drop_old_versions,
    export_csv,
    in_period_order,
    load_star,
    read_star,
    read_tables,
    register_tables,
)
from starmill.plans.star import TIME
from starmill.presets import CATEGORIES, REGIONS, STATE_INCIDENCE
from starmill.session import materialise, shared_dir
from starmill.sources.wide import profile, read_wide_csv, wide_schema, write_wide_csv

ROWS = [
    row(2019, 1, "North", "lethal", **full(2)),
    row(2020, 1, "North", "lethal", **full(3)),
    row(2020, 2, "South", "harm", **full(4)),
]


def star_of(spark, rows, config=CONFIG):
    return build_star(build_grain(frame(spark, rows, config), config), config)


def total(star):
    return star.fact_victimas.agg(F.sum("num_victimas")).first()[0]


@pytest.fixture(scope="module")
def star(spark):
    return star_of(spark, ROWS)


def test_latin1_scan_keeps_accents_and_blanks(spark, tmp_path):
    path = str(tmp_path / "wide")
    original = frame(spark, [row(2019, 7, "Nuevo León", "Violación simple", Enero=1, Diciembre=None)])
    write_wide_csv(original, path, CONFIG)
    assert "Año".encode("latin-1") in next(Path(path).glob("*.csv")).read_bytes()
    scanned = read_wide_csv(spark, path, CONFIG)
    assert scanned.schema == wide_schema(CONFIG)
    assert scanned.collect() == original.collect()
    assert tuple(profile(scanned).first()) == (1, 19)


def test_a_malformed_cell_fails_the_scan(spark, tmp_path):
    header = ",".join(wide_schema(CONFIG).fieldNames())
    path = tmp_path / "bad.csv"
    path.write_text(f"{header}\n2019,x,North,life,type,lethal,a{',1' * 12}\n", encoding="latin-1")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_wide_csv(spark, str(path), CONFIG).collect()


def test_a_short_row_fails_the_scan(spark, tmp_path):
    header = ",".join(wide_schema(CONFIG).fieldNames())
    path = tmp_path / "bad.csv"
    path.write_text(f"{header}\n2019,1,North\n", encoding="latin-1")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_wide_csv(spark, str(path), CONFIG).collect()


def test_columns_are_found_by_name(spark, tmp_path):
    names = [c for c in wide_schema(CONFIG).fieldNames() if c != "Modalidad"]
    values = dict(zip(names, ["2019", "1", "North", "life", "type", "lethal", *map(str, range(1, 13))], strict=True))
    values["Nota"] = "free text"
    shuffled = sorted(values)
    path = tmp_path / "s.csv"
    path.write_text(f"{','.join(shuffled)}\n{','.join(values[c] for c in shuffled)}\n", encoding="latin-1")
    scanned = read_wide_csv(spark, str(path), CONFIG)
    assert scanned.columns == shuffled
    assert rolled_up(scanned, CONFIG).agg(F.sum("num_victimas")).first()[0] == 78
    plan = rolled_up(scanned, CONFIG)._jdf.queryExecution().executedPlan().toString()
    assert "Nota" not in plan, "unused columns are not read"


def test_a_missing_column_is_named(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text("Año,Entidad\n2019,North\n", encoding="latin-1")
    with pytest.raises(ValueError, match="Clave_Ent"):
        read_wide_csv(spark, str(path), CONFIG)


def test_a_load_replaces_what_was_there(spark, star, tmp_path):
    base = str(tmp_path / "w")
    load_star(star, base)
    load_star(star_of(spark, ROWS[:1]), base)
    stored = read_star(spark, base)
    assert total(stored) == 24
    assert stored.dim_entidad.count() == 1


def test_a_refused_load_leaves_the_published_star(spark, star, tmp_path):
    base = str(tmp_path / "w")
    load_star(star, base)

    def refuse(_):
        raise quality.QualityError("no")

    with pytest.raises(quality.QualityError):
        load_star(star_of(spark, ROWS[:1]), base, refuse)
    assert total(read_star(spark, base)) == 108


def test_nothing_published_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_star(spark, str(tmp_path / "none"))


def test_append_adds_rows(spark, star, tmp_path):
    path = str(tmp_path / "a")
    append_star(star, path)
    append_star(star, path)
    doubled = read_tables(spark, path)
    assert total(doubled) == 216
    broken = {r.check for r in validate.unique_keys(doubled).where("status <> 'OK'").collect()}
    assert len(broken) == 5
    assert validate.unique_grain(doubled).first().violations == 36


def test_the_stored_fact_is_in_period_order(spark, star, tmp_path):
    path = str(tmp_path / "o")
    append_star(star, path)
    for file in read_tables(spark, path).fact_victimas.inputFiles():
        periods = [r.id_tiempo for r in spark.read.parquet(file).collect()]
        assert periods == sorted(periods)


def test_a_slice_is_pushed_to_the_stored_fact(spark, star, tmp_path):
    path = str(tmp_path / "p")
    append_star(star, path)
    sliced = read_tables(spark, path).sliced("2019-03", "2019-05").fact_victimas
    assert sliced.count() == 3
    assert "DataFilters: [isnotnull(id_tiempo" in sliced._jdf.queryExecution().executedPlan().toString()


def test_export_writes_one_file_in_order(spark, star, tmp_path):
    path = tmp_path / "x"
    export_csv(queries.yoy_change(star), str(path))
    (file,) = path.glob("part-*")
    lines = file.read_bytes().decode().split("\r\n")
    assert lines == [
        '"nombre_entidad","anio","total","anio_anterior","variacion_absoluta","pct_cambio"',
        "North,2020,36,24,12,50.0",
        "North,2019,24,,,",
        "",
    ]


def test_a_failed_export_leaves_the_earlier_one(spark, tmp_path):
    path = str(tmp_path / "kept")
    export_csv(spark.createDataFrame([("a,b", None)], "x string, y int"), path)
    with pytest.raises(Exception, match="broken"):
        export_csv(spark.range(1).select(F.raise_error(F.lit("broken")).alias("x")), path)
    assert next((tmp_path / "kept").glob("part-*")).read_bytes() == b'"x","y"\r\n"a,b",\r\n'


def test_a_swap_that_fails_halfway_is_undone(spark, tmp_path, monkeypatch):
    path, first = tmp_path / "kept", b'"x"\r\n1\r\n'
    one, two = (spark.createDataFrame([(i,)], "x int") for i in (1, 2))
    export_csv(one, str(path))
    moves, move = [], load._move

    def fails_second(*args):
        moves.append(args)
        if len(moves) == 2:
            raise OSError("planted")
        move(*args)

    monkeypatch.setattr(load, "_move", fails_second)
    with pytest.raises(OSError, match="planted"):
        export_csv(two, str(path))
    assert len(moves) == 3 and next(path.glob("part-*")).read_bytes() == first
    monkeypatch.setattr(load, "_move", move)

    path.rename(tmp_path / "kept.aside-x")  # as if the process had ended there
    with pytest.raises(Exception, match="broken"):
        export_csv(spark.range(1).select(F.raise_error(F.lit("broken")).alias("x")), str(path))
    assert next(path.glob("part-*")).read_bytes() == first
    export_csv(two, str(path))
    assert next(path.glob("part-*")).read_bytes() == b'"x"\r\n2\r\n'
    assert not list(tmp_path.glob("kept.aside*"))


def test_old_versions_are_dropped_on_request(spark, star, tmp_path):
    base = str(tmp_path / "v")
    for _ in range(3):
        load_star(star, base)
    assert len(drop_old_versions(spark, base, keep=1)) == 2
    assert total(read_star(spark, base)) == 108


def test_periods_are_dealt_to_all_partitions(spark):
    fact = spark.range(2400).selectExpr("cast(id % 24 + 1 as int) as id_tiempo", "id as id_hecho")
    for parts in (5, 24, 100):
        sizes = [r["n"] for r in in_period_order(fact, 24, parts).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == 2400 and len(sizes) == min(parts, 24) * max(1, parts // 24)


def test_views_answer_plain_sql(spark, star):
    star.create_views("t_")
    found = spark.sql(
        """SELECT nombre_entidad, anio, SUM(num_victimas) AS total,
                  RANK() OVER (PARTITION BY anio ORDER BY SUM(num_victimas) DESC) AS r
           FROM t_fact_victimas JOIN t_dim_tiempo USING (id_tiempo) JOIN t_dim_entidad USING (id_entidad)
           GROUP BY nombre_entidad, anio ORDER BY anio, r"""
    )
    assert [tuple(r) for r in found.collect()] == [("North", 2019, 24, 1), ("South", 2020, 48, 1), ("North", 2020, 36, 2)]


def test_registered_tables_answer_schema_qualified_sql(spark, star, tmp_path):
    base = str(tmp_path / "w")
    load_star(star_of(spark, ROWS[:1]), base)
    register_tables(spark, base, "monthly")
    load_star(star, base)
    register_tables(spark, base, "monthly")
    found = spark.sql(
        """SELECT subtipo_delito, PERCENTILE_CONT(0.90) WITHIN GROUP (ORDER BY num_victimas) AS p90,
                  SUM(num_victimas) FILTER (WHERE es_letal = TRUE) AS lethal
           FROM monthly.fact_victimas JOIN monthly.dim_delito USING (id_delito)
           GROUP BY subtipo_delito ORDER BY p90 DESC NULLS FIRST"""
    )
    assert [tuple(r) for r in found.collect()] == [("harm", 4.0, None), ("lethal", 3.0, 60)]


@pytest.fixture(scope="module")
def incidence_csv(spark, tmp_path_factory):
    """Every entity and category of the preset over two years, plus a leaf it does not list."""
    rows = []
    for year in (2020, 2022):
        for key, name in enumerate(REGIONS, 1):
            for number, leaf in enumerate([*CATEGORIES, "Robo"]):
                rows.append(row(year, key, name, leaf, "x", "bien", f"tipo {number}", **full(number + key)))
    path = str(tmp_path_factory.mktemp("source") / "wide")
    write_wide_csv(spark.createDataFrame(rows, wide_schema(STATE_INCIDENCE)), path, STATE_INCIDENCE)
    return path


def test_the_job_refreshes_and_answers(spark, incidence_csv, tmp_path):
    star = job.refresh(spark, incidence_csv, str(tmp_path / "w"), STATE_INCIDENCE)
    counts = {r.tabla: r.registros for r in queries.table_counts(star).collect()}
    assert counts == {"dim_tiempo": 24, "dim_entidad": 32, "dim_delito": 13, "fact_victimas": 24 * 32 * 13}
    assert total(star) == 24 * sum(n + k for n in range(13) for k in range(1, 33))
    for name, result in job.reports(star, job.HEADLINE_LEAF).items():
        export_csv(result, str(tmp_path / name))
        assert spark.read.csv(str(tmp_path / name), header=True, lineSep="\r\n").count() == result.count()
    assert [d.dataType.simpleString() for d in star.dim_entidad.schema] == ["int", "smallint", "string", "string"]


def test_the_report_holds_stages_checks_and_totals(spark, incidence_csv, tmp_path):
    star, report = job.refresh_reported(spark, incidence_csv, str(tmp_path / "w"), STATE_INCIDENCE)
    rows = {r.check: r for r in report.collect()}
    assert all(r.status == "OK" for r in rows.values())
    assert rows["rows: source read"].loaded == 2 * 32 * 14 and rows["rows: source listed"].loaded == 2 * 32 * 13
    assert rows["rows: grain groups"].loaded * 12 == rows["fact_victimas"].loaded == star.fact_victimas.count()
    assert rows["num_victimas"].expected == total(star)
    sliced = job.reports(star, job.HEADLINE_LEAF, first="2022-01")["yearly_by_category"]
    assert {r.anio for r in sliced.collect()} == {2022}


def test_the_job_refuses_a_source_that_loses_rows(spark, tmp_path):
    source = str(tmp_path / "s")
    write_wide_csv(frame(spark, [*ROWS, row(2019, None, "North", "lethal", Enero=5)]), source, CONFIG)
    with pytest.raises(quality.QualityError, match="num_victimas"):
        job.refresh(spark, source, str(tmp_path / "w"), CONFIG)
    with pytest.raises(FileNotFoundError):
        read_star(spark, str(tmp_path / "w"))


def test_written_intermediates_go_to_the_named_folder(spark):
    folder = shared_dir(spark)
    stored = materialise(spark.range(3), "t")
    assert all(folder.removeprefix("file:") in f for f in stored.inputFiles())


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _partition_filters(df):
    scan = next(line for line in _plan(df).split("\n") if "FileScan parquet" in line and "num_victimas" in line)
    return scan[scan.index("PartitionFilters: [") :].split("]")[0]


def test_filters_on_time_choose_the_folders_of_the_fact(spark, star, tmp_path):
    path = str(tmp_path / "y")
    append_star(star, path)
    stored = read_tables(spark, path)
    by_year = stored.joined(TIME).where("anio = 2020")
    by_label = stored.joined(TIME).where("periodo_label >= '2020-06'")
    assert "dynamicpruning" in _partition_filters(by_year) and "dynamicpruning" in _partition_filters(by_label)
    for kept, condition in ((by_year, "anio = 2020"), (by_label, "periodo_label >= '2020-06'")):
        plain = star.joined(TIME).where(condition)
        assert kept.columns == plain.columns
        assert kept.drop("fecha_carga").exceptAll(plain.drop("fecha_carga")).count() == 0
        assert kept.count() == plain.count() > 0
    assert "anio_hecho" in _partition_filters(stored.sliced("2019-03", "2019-05").fact_victimas)


def test_folders_of_an_appended_star_are_chosen_too(spark, star, tmp_path):
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    append_star(star, one)
    append_star(star_of(spark, [row(2021, 1, "North", "lethal", **full(5))]), two)
    both = read_tables(spark, one, two).joined(TIME).where("anio = 2020")
    scans = [line for line in _plan(both).split("\n") if "FileScan parquet" in line and "num_victimas" in line]
    assert len(scans) == 2 and all("anio_hecho" in line.split("PartitionFilters: [")[1].split("]")[0] for line in scans)


def test_facts_of_unknown_periods_and_no_facts_are_stored(spark, star, tmp_path):
    path, none = str(tmp_path / "u"), str(tmp_path / "n")
    lost = replace(star, dim_tiempo=star.dim_tiempo.where("anio = 2019"))
    append_star(lost, path)
    stored = read_tables(spark, path)
    assert stored.fact_victimas.count() == 36 and stored.joined(TIME).count() == 12
    append_star(star_of(spark, []), none)
    empty = read_tables(spark, none)
    assert empty.joined(TIME).count() == 0 and empty.sliced("2019-01", "2019-12").fact_victimas.count() == 0
