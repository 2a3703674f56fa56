"""Source to star on hand-made rows."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from wide_rows import CONFIG, frame, full, row

from starmill.operators import quality
from starmill.operators.keys import DuplicateKeyError
from starmill.plans import queries, validate
from starmill.plans.build import build_entity, build_grain, build_star, rolled_up
from starmill.presets import MONTHS


def star_of(spark, rows, config=CONFIG):
    return build_star(build_grain(frame(spark, rows, config), config), config)


def cell(df, **where):
    for column, value in where.items():
        df = df.where(F.col(column) == value)
    return [r.num_victimas for r in df.collect()]


def test_details_are_summed_and_blanks_count_nothing(spark):
    rows = [
        row(2019, 1, "North", "lethal", "a", Enero=1, Febrero=2),
        row(2019, 1, "North", "lethal", "b", Enero=3),
    ]
    grain = rolled_up(frame(spark, rows), CONFIG)
    assert grain.count() == 12
    assert cell(grain, nombre_mes="Enero") == [4]
    assert cell(grain, nombre_mes="Febrero") == [2]
    assert cell(grain, nombre_mes="Marzo") == [0], "blank everywhere is a row with 0"


def test_null_keys_drop_out_and_the_total_check_reports_them(spark):
    rows = [row(2019, 1, "North", "lethal", Enero=1), row(2019, None, "North", "lethal", Enero=7)]
    star = star_of(spark, rows)
    assert star.fact_victimas.agg(F.sum("num_victimas")).first()[0] == 1
    report = validate.source_total(frame(spark, rows), star, CONFIG).first()
    assert (report.expected, report.loaded, report.status) == (8, 1, quality.MISMATCH)


def test_unlisted_leaves_are_filtered(spark):
    rows = [row(2019, 1, "North", "lethal", Enero=1), row(2019, 1, "North", "petty", Enero=9)]
    assert {r.subtipo_delito for r in rolled_up(frame(spark, rows), CONFIG).collect()} == {"lethal"}


def test_category_ids_follow_first_appearance(spark):
    rows = [
        row(2020, 1, "North", "late", good="a", Enero=1),
        row(2019, 2, "South", "harm", good="z", Enero=1),
        row(2019, 1, "North", "lethal", good="m", Enero=1),
    ]
    ids = {r.subtipo_delito: r.id_delito for r in star_of(spark, rows).dim_delito.collect()}
    assert ids == {"lethal": 1, "harm": 2, "late": 3}


def test_dimension_columns(spark):
    star = star_of(spark, [row(2020, 1, "North", "lethal", **full(1))])
    times = {r.mes: r for r in star.dim_tiempo.collect()}
    assert [times[m].trimestre for m in (1, 3, 4, 12)] == [1, 1, 2, 4]
    assert [times[m].semestre for m in (1, 6, 7, 12)] == [1, 1, 2, 2]
    assert times[3].periodo_label == "2020-03" and times[3].es_anio_pandemia
    assert [times[m].id_tiempo for m in range(1, 13)] == list(range(1, 13))
    leaf = star.dim_delito.first()
    assert (leaf.categoria, leaf.es_letal, leaf.descripcion) == ("intentional", True, "type - lethal")
    assert star.dim_entidad.first().region == "Norte"


def test_fact_ids_are_dense_in_grain_order(spark):
    rows = [row(y, k, n, "lethal", **full(y + k)) for y in (2021, 2019) for k, n in ((2, "South"), (1, "North"))]
    fact = star_of(spark, rows).fact_victimas.orderBy("id_hecho").collect()
    assert [r.id_hecho for r in fact] == list(range(1, 49))
    assert [r.num_victimas for r in fact[::12]] == [2020, 2021, 2022, 2023]
    assert all(r.fuente == "hand-made" and r.fecha_carga for r in fact)


def test_the_star_does_not_depend_on_row_order_or_partitions(spark):
    rows = [
        row(y, k, n, leaf, d, **full(y + k + len(d)))
        for y in (2018, 2019, 2020)
        for k, n in ((1, "North"), (2, "South"), (3, "Bare"))
        for leaf in ("harm", "lethal", "late")
        for d in ("a", "bb")
        if (y, leaf) != (2018, "lethal")
    ]
    # A third of all rows in one id group.
    rows += [row(2019, 2, "South", "harm", "c", Enero=1)] * (len(rows) // 2)
    one = build_star(build_grain(frame(spark, rows).coalesce(1), CONFIG), CONFIG)
    other = build_star(build_grain(frame(spark, rows[::-1]).repartition(7), CONFIG), CONFIG)
    for name, table in one.tables().items():
        columns = [c for c in table.columns if c != "fecha_carga"]
        assert sorted(table.select(columns).collect()) == sorted(other.tables()[name].select(columns).collect())
    ids = sorted(r.id_hecho for r in one.fact_victimas.collect())
    assert ids == list(range(1, 12 * 24 + 1))


def test_entity_without_region_is_reported(spark):
    rows = [row(2019, 3, "Nowhere", "lethal", Enero=1)]
    grain = build_grain(frame(spark, rows), CONFIG)
    assert build_entity(grain, CONFIG).first().region is None
    known = spark.createDataFrame(list(CONFIG.regions.items()), "name string, region string")
    assert quality.coverage(frame(spark, rows), CONFIG.entity_name, known, "region").first().violations == 1
    with pytest.raises(quality.QualityError, match="dim_entidad.region"):
        quality.fail_on_violation(validate.not_null(star_of(spark, rows)))


@pytest.mark.parametrize(
    "rows",
    [
        [row(2019, 1, "North", "lethal", Enero=1), row(2019, 1, "NORTH", "lethal", Enero=1)],
        [row(2019, 1, "North", "lethal", kind="a", Enero=1), row(2019, 1, "North", "lethal", kind="b", Enero=1)],
    ],
    ids=["key with two names", "leaf under two types"],
)
def test_ambiguous_lookup_keys_are_refused(spark, rows):
    with pytest.raises(DuplicateKeyError):
        star_of(spark, rows)


def test_a_region_listed_twice_is_refused(spark):
    regions = spark.createDataFrame([("North", "Norte"), ("North", "Sur")], "name string, region string")
    with pytest.raises(DuplicateKeyError, match="regions"):
        star_of(spark, [row(2019, 1, "North", "lethal", Enero=1)], replace(CONFIG, regions=regions))


def test_wider_types_take_larger_keys_and_sums(spark):
    config = replace(CONFIG, entity_key_type="bigint", measure_type="bigint")
    rows = [row(2019, 5_000_000_000, "North", "lethal", d, Enero=2_000_000_000) for d in ("a", "b")]
    star = star_of(spark, rows, config)
    assert star.dim_entidad.first().clave_entidad == 5_000_000_000
    assert star.fact_victimas.agg(F.max("num_victimas")).first()[0] == 4_000_000_000


def test_change_uses_the_previous_existing_year(spark):
    rows = [
        row(2017, 1, "North", "lethal", Enero=208),
        row(2019, 1, "North", "lethal", Enero=221),
        row(2020, 1, "North", "lethal", Enero=0),
        row(2021, 1, "North", "lethal", Enero=5),
        row(2017, 2, "South", "lethal", Enero=208),
        row(2018, 2, "South", "lethal", Enero=195),
    ]
    star = star_of(spark, rows)
    found = {(r.nombre_entidad, r.anio): r for r in queries.yoy_change(star).collect()}
    assert found["North", 2019].anio_anterior == 208
    assert float(found["North", 2019].pct_cambio) == 6.3, "6.25 rounds away from zero"
    assert float(found["South", 2018].pct_cambio) == -6.3
    assert found["North", 2021].variacion_absoluta == 5 and found["North", 2021].pct_cambio is None
    strict = {(r.nombre_entidad, r.anio): r for r in queries.yoy_change(star, consecutive=True).collect()}
    assert strict["North", 2019].anio_anterior is None
    assert strict["North", 2020].anio_anterior == 221
    order = [r.pct_cambio for r in queries.yoy_change(star).collect()]
    assert order[-1] is None and order[0] is not None


def test_ranks_share_ties_and_leave_a_gap(spark):
    rows = [row(2019, k, n, "lethal", Enero=v) for k, n, v in ((1, "North", 10), (2, "South", 10), (3, "Bare", 7))]
    ranked = queries.rank_by_period(star_of(spark, rows), "lethal").collect()
    assert [(r.nombre_entidad, r.ranking_anual) for r in ranked] == [("North", 1), ("South", 1), ("Bare", 3)]


def test_share_is_null_without_a_flagged_category(spark):
    rows = [
        row(2019, 1, "North", "lethal", Enero=1),
        row(2019, 1, "North", "harm", Enero=2),
        row(2019, 2, "South", "harm", Enero=5),
        row(2019, 3, "Bare", "lethal", Enero=0),
    ]
    found = {r.nombre_entidad: r for r in queries.lethal_share(star_of(spark, rows)).collect()}
    assert float(found["North"].pct_letal) == 33.3
    assert found["South"].delitos_letales is None and found["South"].pct_letal is None
    assert found["Bare"].total_delitos == 0 and found["Bare"].pct_letal is None


def test_slice_limits_the_fact_by_time_id(spark):
    rows = [row(y, 1, "North", "lethal", **full(1)) for y in (2018, 2019, 2020)]
    sliced = star_of(spark, rows).sliced("2018-11", "2019-02")
    assert sliced.fact_victimas.count() == 4
    assert {r.anio: r.total_victimas for r in queries.yearly_by_category(sliced).collect()} == {2018: 2, 2019: 2}


def test_measure_beyond_int_fails_instead_of_wrapping(spark):
    rows = [row(2019, 1, "North", "lethal", d, Enero=2_000_000_000) for d in ("a", "b")]
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        star_of(spark, rows).fact_victimas.collect()


def test_month_order_is_the_calendar(spark):
    grain = rolled_up(frame(spark, [row(2019, 1, "North", "lethal", **full(1))]), CONFIG)
    assert {r.nombre_mes: r.mes for r in grain.collect()} == {m: i for i, m in enumerate(MONTHS, 1)}
