"""Years appended to a published star, versions that two writers want, and rows set apart."""

import pytest
from pyspark.sql import functions as F
from wide_rows import CONFIG, frame, full, row

from starmill import job
from starmill.operators import quality
from starmill.operators.keys import DuplicateKeyError
from starmill.plans import validate, versions
from starmill.plans.append import LoadedYearsError, append_years
from starmill.plans.build import build_grain, build_star
from starmill.plans.load import drop_old_versions, load_star, read_star, register_tables
from starmill.plans.star import DIMENSIONS
from starmill.sources.wide import FAULTS, TEXT, read_wide_csv, read_wide_csv_marked, wide_schema, write_rejects, write_wide_csv

EARLY = [
    row(2019, 1, "North", "lethal", **full(2)),
    row(2019, 3, "Bare", "harm", **full(1)),
    row(2020, 1, "North", "lethal", **full(3)),
]
LATE = [
    row(2021, 2, "South", "late", **full(5)),
    row(2021, 1, "North", "harm", **full(7)),
    row(2022, 3, "Bare", "lethal", "x", Enero=4),
    row(2022, 3, "Bare", "lethal", "y", Enero=None, Febrero=6),
]


def star_of(spark, rows):
    return build_star(build_grain(frame(spark, rows), CONFIG), CONFIG)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def base(spark, tmp_path):
    path = str(tmp_path / "w")
    load_star(star_of(spark, EARLY), path)
    return path


def without_time(star):
    return star.fact_victimas.drop("fecha_carga")


def by_nature(star):
    """The fact under its natural keys, with the ids that follow from the order of periods."""
    joined = star.joined(*DIMENSIONS)
    return joined.select("id_hecho", "id_tiempo", "anio", "mes", "clave_entidad", "region", "subtipo_delito", "num_victimas")


def test_an_append_keeps_stored_ids_and_goes_on_after_them(spark, base):
    before = read_star(spark, base)
    stored = {name: rows_of(t.drop("fecha_carga")) for name, t in before.tables().items()}
    whole = append_years(frame(spark, LATE), base, CONFIG)
    quality.fail_on_violation(validate.constraints(whole))
    for name, table in whole.tables().items():
        assert set(stored[name]) < set(rows_of(table.drop("fecha_carga")))
    entities = {r.clave_entidad: r.id_entidad for r in whole.dim_entidad.collect()}
    assert entities == {1: 1, 3: 2, 2: 3}
    assert {r.subtipo_delito: r.id_delito for r in whole.dim_delito.collect()} == {"lethal": 1, "harm": 2, "late": 3}
    assert [r.id_tiempo for r in whole.dim_tiempo.orderBy("anio", "mes").collect()] == list(range(1, 49))
    full_load = star_of(spark, EARLY + LATE)
    assert rows_of(by_nature(whole)) == rows_of(by_nature(full_load))
    assert rows_of(by_nature(read_star(spark, base))) == rows_of(by_nature(full_load))


def test_an_append_writes_only_the_new_rows(spark, base):
    known = versions.current(spark, base)
    append_years(frame(spark, LATE), base, CONFIG)
    now = versions.current(spark, base)
    assert now.number == known.number + 1 and now.parts[:1] == known.parts and len(now.parts) == 2
    assert spark.read.parquet(f"{now.parts[1]}/dim_tiempo").count() == 24
    assert spark.read.parquet(f"{now.parts[1]}/fact_victimas").count() == 36
    assert spark.read.parquet(f"{now.parts[1]}/dim_entidad").count() == 1


def test_a_slice_reads_the_folders_it_needs(spark, base):
    whole = append_years(frame(spark, LATE), base, CONFIG)
    assert whole.sliced("2020-06", "2021-02").fact_victimas.count() == 7 + 4


def test_years_that_are_stored_are_refused(spark, base):
    for year in (2018, 2020):
        with pytest.raises(LoadedYearsError, match=str(year)):
            append_years(frame(spark, [row(year, 1, "North", "lethal", Enero=1), *LATE]), base, CONFIG)
    assert versions.current(spark, base).number == 1


def test_another_name_for_a_stored_key_is_refused(spark, base):
    with pytest.raises(DuplicateKeyError, match="clave_entidad"):
        append_years(frame(spark, [row(2021, 1, "South", "lethal", Enero=1)]), base, CONFIG)
    with pytest.raises(DuplicateKeyError, match="subtipo_delito"):
        append_years(frame(spark, [row(2021, 1, "North", "lethal", "x", "other", Enero=1)]), base, CONFIG)


def test_nothing_to_append_publishes_nothing(spark, base):
    assert append_years(frame(spark, []), base, CONFIG).fact_victimas.count() == 36
    assert versions.current(spark, base).number == 1


def test_a_refused_append_leaves_the_star(spark, base):
    def refuse(built, new, whole):
        assert new.fact_victimas.count() == 36 and whole.fact_victimas.count() == 72
        raise quality.QualityError("no")

    with pytest.raises(quality.QualityError):
        append_years(frame(spark, LATE), base, CONFIG, refuse)
    assert read_star(spark, base).fact_victimas.count() == 36


def test_two_appends_at_once_lose_nothing(spark, base):
    """The second writer publishes while the first still checks; the first goes on top of it."""
    late, later = LATE[:2], LATE[2:]

    def overtaken(built, new, whole, done=[]):  # noqa: B006
        if not done:
            done.append(True)
            append_years(frame(spark, late), base, CONFIG)

    whole = append_years(frame(spark, later), base, CONFIG, overtaken)
    assert rows_of(by_nature(whole)) == rows_of(by_nature(star_of(spark, EARLY + LATE)))
    assert versions.current(spark, base).number == 3

    def always(built, new, whole):
        versions.publish(spark, base, versions.next_number(spark, base), versions.current(spark, base).parts)

    with pytest.raises(versions.PublishConflict):
        append_years(frame(spark, [row(2030, 1, "North", "lethal", Enero=1)]), base, CONFIG, always, attempts=2)


def test_two_refreshes_at_once_refuse_the_loser(spark, base):
    def overtaken(_):
        load_star(star_of(spark, LATE), base)

    with pytest.raises(versions.PublishConflict):
        load_star(star_of(spark, EARLY), base, overtaken)
    assert rows_of(by_nature(read_star(spark, base))) == rows_of(by_nature(star_of(spark, LATE)))


def test_a_version_that_its_writer_did_not_finish_does_not_count(spark, base, tmp_path):
    (tmp_path / "w" / "_published" / "v00000002.json").write_text("")
    assert versions.current(spark, base).number == 1 and versions.next_number(spark, base) == 3
    load_star(star_of(spark, LATE), base)
    assert versions.current(spark, base).number == 3


def test_dropping_versions_keeps_the_folders_in_use(spark, base):
    append_years(frame(spark, LATE[:2]), base, CONFIG)
    append_years(frame(spark, LATE[2:]), base, CONFIG)
    assert drop_old_versions(spark, base, keep=1) == []
    assert read_star(spark, base).fact_victimas.count() == 72
    load_star(star_of(spark, EARLY), base)
    assert len(drop_old_versions(spark, base, keep=1)) == 3
    assert read_star(spark, base).fact_victimas.count() == 36


def test_an_appended_star_answers_sql_text(spark, base):
    register_tables(spark, base, "grown")
    append_years(frame(spark, LATE), base, CONFIG)
    for _ in range(2):
        register_tables(spark, base, "grown")
        found = spark.sql("SELECT count(*) AS n FROM grown.fact_victimas JOIN grown.dim_tiempo USING (id_tiempo) WHERE anio > 2020")
        assert found.first().n == 36


@pytest.fixture
def spoilt_csv(spark, tmp_path):
    path = str(tmp_path / "csv")
    write_wide_csv(frame(spark, [*EARLY, row(2020, 2, "South", "harm", Enero=None, Mayo=9)]).coalesce(1), path, CONFIG)
    header = ",".join(wide_schema(CONFIG).fieldNames())
    bad = ["2020,two,South,life,type,harm,x" + ",1" * 12, "2020,2,South,life,type,harm,x,1.5,z" + ",1" * 10, "2020,2,South"]
    bad += ["2020,2,South,life,type,harm,x" + ",1" * 13]
    (tmp_path / "csv" / "part-bad.csv").write_text("\n".join([header, *bad, ""]), encoding="latin-1")
    return path


def test_bad_rows_are_named_and_the_rest_is_as_ever(spark, spoilt_csv, tmp_path):
    marked = read_wide_csv_marked(spark, spoilt_csv, CONFIG)
    good = marked.where(F.size(FAULTS) == 0).drop(FAULTS, TEXT)
    clean = read_wide_csv(spark, spoilt_csv + "/part-0*", CONFIG)
    assert good.schema == clean.schema and rows_of(good.fillna(-1)) == rows_of(clean.fillna(-1))
    assert write_rejects(marked, str(tmp_path / "r")) == 4
    found = sorted((r[FAULTS], r[TEXT]) for r in spark.read.parquet(str(tmp_path / "r")).collect())
    assert [f for f, _ in found] == [["Clave_Ent"], ["Enero", "Febrero"], ["malformed row"], ["malformed row"]]
    assert found[1][1].startswith("2020,2,South,life,type,harm,x,1.5,z,1") and found[2][1] == "2020,2,South"


def test_the_job_sets_bad_rows_apart_up_to_a_limit(spark, spoilt_csv, tmp_path):
    warehouse = str(tmp_path / "w")
    with pytest.raises(quality.QualityError, match="4 rows"):
        job.refresh(spark, spoilt_csv, warehouse, CONFIG, max_rejects=3)
    with pytest.raises(FileNotFoundError):
        read_star(spark, warehouse)
    star, report = job.refresh_reported(spark, spoilt_csv, warehouse, CONFIG, max_rejects=4)
    rows = {r.check: r for r in report.collect()}
    assert rows["rows: source rejected"].loaded == 4 and rows["rows: source read"].loaded == 8
    assert star.fact_victimas.agg(F.sum("num_victimas")).first()[0] == 12 * 6 + 9
    assert sum(1 for _ in (tmp_path / "w" / "_rejects").iterdir()) == 2


def test_the_job_appends_with_checks(spark, tmp_path):
    warehouse, first, second = (str(tmp_path / name) for name in ("w", "a", "b"))
    write_wide_csv(frame(spark, EARLY), first, CONFIG)
    write_wide_csv(frame(spark, LATE), second, CONFIG)
    job.refresh(spark, first, warehouse, CONFIG)
    star, report = job.append_reported(spark, second, warehouse, CONFIG)
    assert all(r.status == "OK" for r in report.collect())
    assert rows_of(by_nature(star)) == rows_of(by_nature(star_of(spark, EARLY + LATE)))


def test_the_job_refuses_an_entity_without_region(spark, tmp_path):
    write_wide_csv(frame(spark, [row(2019, 9, "Nowhere", "lethal", Enero=1)]), str(tmp_path / "s"), CONFIG)
    with pytest.raises(quality.QualityError, match="nombre_entidad in catalogue"):
        job.refresh(spark, str(tmp_path / "s"), str(tmp_path / "w"), CONFIG)
