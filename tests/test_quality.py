"""Each check finds a planted fault and passes without one."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from wide_rows import CONFIG, frame, full, row

from starmill.operators import quality
from starmill.operators.keys import Lookup
from starmill.plans import validate
from starmill.plans.build import build_grain, build_star
from starmill.plans.star import CATEGORY, ENTITY, FACT, TIME, without


@pytest.fixture(scope="module")
def star(spark):
    rows = [row(y, k, n, "lethal", **full(k)) for y in (2019, 2020) for k, n in ((1, "North"), (2, "South"))]
    built = build_star(build_grain(frame(spark, rows), CONFIG), CONFIG)
    return replace(built, fact_victimas=built.fact_victimas.cache())


def failed(report):
    return {r.check: r.violations for r in report.where("status <> 'OK'").collect()}


def changed(star, table, **columns):
    return replace(star, **{table: star.tables()[table].withColumns(columns)})


def test_a_sound_star_passes(star):
    report = quality.fail_on_violation(validate.constraints(star))
    assert report.count() == 42
    assert failed(validate.orphans(star)) == {}


def test_orphans_count_a_row_once(star):
    broken = without(without(star, ENTITY, "clave_entidad = 1"), TIME, "anio = 2020")
    assert failed(validate.orphans(broken)) == {"orphans": 36}
    assert failed(validate.orphans_by_key(broken)) == {"id_entidad": 24, "id_tiempo": 24}


def test_null_foreign_keys_are_orphans(star):
    broken = changed(star, FACT, id_delito=F.when(F.col("id_hecho") <= 40, F.col("id_delito")))
    assert failed(validate.orphans(broken)) == {"orphans": 8}
    assert failed(validate.orphans_by_key(broken)) == {"id_delito": 8}
    assert failed(validate.not_null(broken)) == {"fact_victimas.id_delito": 8}


def test_orphans_read_the_fact_once(star, spark, tmp_path):
    star.fact_victimas.write.parquet(f"{tmp_path}/fact")
    stored = replace(star, fact_victimas=spark.read.parquet(f"{tmp_path}/fact"))
    for report in (validate.orphans(stored), validate.orphans_by_key(stored)):
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert plan.count(f"{tmp_path}/fact") == 1 and "bit_or" in plan


def test_orphans_of_dimensions_beyond_a_bitmap(star, monkeypatch):
    """Keys of any type and number: sparse, negative, text, and too many to broadcast."""
    spark = star.fact_victimas.sparkSession
    keys = [-(1 << 40), -65, -64, -1, 0, 63, 64, 1 << 50]
    rows = [(k, str(k), k) for k in keys for _ in range(3)] + [(7, "7", 0)] * 5 + [(None, None, None), (0, "x", None)]
    fact = spark.createDataFrame(rows, "a long, b string, c long")
    numbers = spark.createDataFrame([(k, str(k)) for k in keys], "n long, t string")
    lookups = [Lookup(numbers, "n", {"a": "n"}), Lookup(numbers, "t", {"b": "t"}), Lookup(numbers, "n", {"c": "n"})]
    for words in (quality.BITMAP_WORDS, -1):
        monkeypatch.setattr(quality, "BITMAP_WORDS", words)
        assert failed(quality.orphans(fact, lookups)) == {"orphans": 7}
        assert failed(quality.orphans_by_key(fact, lookups)) == {"a": 6, "b": 7, "c": 2}
    assert failed(quality.orphans(fact.limit(0), lookups)) == {}


def test_repeated_keys(star):
    broken = changed(star, ENTITY, id_entidad=F.lit(1), clave_entidad=F.lit(5).cast("smallint"))
    assert failed(validate.unique_keys(broken)) == {"dim_entidad.id_entidad": 1, "dim_entidad.clave_entidad": 1}


def test_repeated_grain(star):
    broken = changed(star, FACT, id_tiempo=F.lit(1))
    assert failed(validate.unique_grain(broken)) == {"fact_victimas.grain": 46}
    twice = replace(star, fact_victimas=star.fact_victimas.unionByName(star.fact_victimas.where("id_hecho < 4")))
    assert failed(validate.unique_keys(twice)) == {"fact_victimas.id_hecho": 3}
    assert failed(validate.unique_grain(twice)) == {"fact_victimas.grain": 3}


def test_no_check_shuffles_the_fact_rows(star):
    plan = validate.constraints(star)._jdf.queryExecution().optimizedPlan().toString()
    assert "bitmap_construct_agg" in plan and "Aggregate [id_hecho" not in plan


def test_long_texts(star):
    broken = changed(star, CATEGORY, subtipo_delito=F.repeat(F.lit("ñ"), 81), categoria=F.repeat(F.lit("ñ"), 50))
    assert failed(validate.max_length(broken)) == {"dim_delito.subtipo_delito length": 1}


def test_counts(star):
    report = quality.count_reconcile(star.tables(), without(star, FACT, "id_hecho > 47").tables())
    assert [tuple(r) for r in report.where("status <> 'OK'").collect()] == [("fact_victimas", 48, 47, "MISMATCH")]


def test_an_empty_fact_does_not_reconcile(star, spark):
    wide = frame(spark, [row(2019, 1, "North", "lethal", Enero=3)])
    report = validate.source_total(wide, without(star, FACT, "true"), CONFIG).first()
    assert (report.expected, report.loaded, report.status) == (3, 0, "MISMATCH")


def test_a_violation_raises_with_its_name(star):
    with pytest.raises(quality.QualityError, match="id_entidad"):
        quality.fail_on_violation(validate.constraints(without(star, ENTITY, "clave_entidad = 1")))
