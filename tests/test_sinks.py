"""Sinks never lose what was there before."""

import pytest
from pyspark.sql import functions as F

from footfall.operators import training
from footfall.sources import tables
from footfall.sources.sessions import read_sessions, write_sessions
from footfall.sources.tables import read_table, replace_table
from footfall.sources.workspace import folder_exists, materialize, scope, shared_folder
from footfall.vocabulary import VISITOR
from tests.hand_made import session, sessions


def _days(spark, path):
    rows = read_sessions(spark, path).groupBy("table_suffix").count().collect()
    return {r.table_suffix: r["count"] for r in rows}


def test_writing_a_day_replaces_that_day_only(spark, tmp_path):
    path = str(tmp_path / "s")
    write_sessions(sessions(spark, [session("a", "20170101"), session("b", "20170101")]), path)
    write_sessions(sessions(spark, [session("a", "20170102")]), path)
    assert _days(spark, path) == {"20170101": 2, "20170102": 1}
    write_sessions(sessions(spark, [session("c", "20170101")]), path)
    assert _days(spark, path) == {"20170101": 1, "20170102": 1}


def test_number_of_occurrences_is_kept(spark, tmp_path):
    path = str(tmp_path / "s")
    rows = sessions(spark, [session()]).withColumn(
        "hits", F.transform("hits", lambda h: h.withField("occurrences", F.lit(4).cast("long")))
    )
    write_sessions(rows, path)
    assert read_sessions(spark, path).first().hits[0].occurrences == 4


def _failing(spark):
    return spark.range(4).select(F.when(F.col("id") == 3, F.raise_error(F.lit("no"))).otherwise(1).alias("id"))


def test_failed_write_leaves_the_table(spark, tmp_path):
    replace_table(spark.range(3), "kept_table", str(tmp_path / "t"))
    with pytest.raises(Exception, match="no"):
        replace_table(_failing(spark), "kept_table", str(tmp_path / "t"))
    assert read_table(spark, "kept_table").count() == 3
    spark.sql("DROP TABLE kept_table")


def test_table_replaced_by_a_query_over_itself(spark, tmp_path):
    replace_table(spark.range(3), "own_table", str(tmp_path / "t"))
    replace_table(read_table(spark, "own_table").where("id > 0"), "own_table", str(tmp_path / "t"))
    assert sorted(r.id for r in read_table(spark, "own_table").collect()) == [1, 2]
    replace_table(read_table(spark, "own_table").where("id > 1"), "own_table", str(tmp_path / "t"))
    assert [r.id for r in read_table(spark, "own_table").collect()] == [2]
    # The present version and the one before, for those who still read it.
    assert len(list((tmp_path / "t").iterdir())) == 2
    spark.sql("DROP TABLE own_table")


@pytest.mark.parametrize("columns", ["id", "id + 1 AS other"])
def test_running_readers_keep_their_version(spark, tmp_path, columns):
    reader = replace_table(spark.range(3), "read_on", str(tmp_path / "t"))
    replace_table(spark.range(9).selectExpr(columns), "read_on", str(tmp_path / "t"))
    assert reader.count() == 3
    assert read_table(spark, "read_on").count() == 9
    spark.sql("DROP TABLE read_on")


@pytest.mark.parametrize("columns", ["id", "id + 1 AS other"])
def test_tables_of_others_keep_their_files(spark, tmp_path, columns):
    spark.range(5).write.parquet(str(tmp_path / "theirs"))
    spark.catalog.createTable("of_others", path=str(tmp_path / "theirs"), source="parquet")
    for _ in range(3):
        replace_table(spark.range(2).selectExpr(columns), "of_others", str(tmp_path / "t"))
    assert read_table(spark, "of_others").count() == 2
    assert spark.read.parquet(str(tmp_path / "theirs")).count() == 5
    spark.sql("DROP TABLE of_others")


def test_managed_table_of_others_keeps_its_rows(spark, tmp_path):
    spark.range(5).write.saveAsTable("managed_one")
    replace_table(spark.range(2).selectExpr("id + 1 AS other"), "managed_one", str(tmp_path / "t"))
    assert read_table(spark, "managed_one").count() == 2
    aside = [t.name for t in spark.catalog.listTables() if t.name.startswith("managed_one__former")]
    assert [spark.table(t).count() for t in aside] == [5]
    for name in ("managed_one", *aside):
        spark.sql(f"DROP TABLE {name}")


def test_program_that_ended_while_the_name_passed(spark, tmp_path, monkeypatch):
    replace_table(spark.range(3), "passing", str(tmp_path / "t"))
    with monkeypatch.context() as broken:
        # Called at the start, and again once the former table is gone: there it ends.
        calls = iter([None])
        broken.setattr(tables, "_finish_switch", lambda *_: next(calls))
        with pytest.raises(StopIteration):
            replace_table(spark.range(4).selectExpr("id AS other"), "passing", str(tmp_path / "t"))
    assert read_table(spark, "passing").columns == ["other"]
    assert read_table(spark, "passing").count() == 4
    spark.sql("DROP TABLE passing")


@pytest.fixture(scope="module")
def two_models(spark):
    rows = spark.range(40).select(
        F.col("id").cast("string").alias(VISITOR), (F.col("id") % 2).cast("int").alias("labels"),
        (F.col("id") % 2 + F.col("id") % 7).alias("x"),
    )
    return training.fit(rows, l1_strengths=(0, 1), numbers=["x"], categories={})


def test_save_broken_between_its_writes_keeps_the_model(spark, two_models, tmp_path, monkeypatch):
    path = str(tmp_path / "m")
    training.save_model(two_models["logistic_reg", 0], path)
    with monkeypatch.context() as broken:
        broken.setattr(training, "_training_rows", lambda model: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            training.save_model(two_models["logistic_reg", 1], path)
    assert training.load_model(spark, path).l1 == 0
    training.save_model(two_models["logistic_reg", 1], path)
    assert training.load_model(spark, path).l1 == 1


def test_fit_goes_on_until_it_settles(spark):
    """One that needs far more than twenty iterations, and one that is cut off and says so."""
    rows = spark.range(300).select(
        F.expr("cast(id % 3 = 0 or id % 5 = 1 as int)").alias("labels"),
        *[F.expr(f"sin(id * {k}) + id % {k + 2}").alias(f"x{k}") for k in range(1, 31)],
    )
    numbers = [f"x{k}" for k in range(1, 31)]
    whole = training.fit(rows, l1_strengths=(0.01,), numbers=numbers, categories={})
    model = whole["logistic_reg", 0.01]
    assert model.converged
    assert len(model.losses) > 21
    options = training.FitOptions(max_iter=5)
    cut = training.fit(rows, l1_strengths=(0.01,), options=options, numbers=numbers, categories={})
    assert not cut["logistic_reg", 0.01].converged
    assert not training.training_info(cut["logistic_reg", 0.01]).first().converged


def test_column_without_any_value(spark):
    rows = spark.range(20).select(
        (F.col("id") % 2).cast("int").alias("labels"), F.col("id").alias("x"),
        F.lit(None).cast("double").alias("empty"),
    )
    model = training.fit(rows, numbers=["x", "empty"], categories={})["logistic_reg", 1]
    assert model.classifier.coefficients[1] == 0
    from footfall.operators.correlation import feature_correlation

    pair = feature_correlation(rows, ["x", "empty"], {}).first()
    assert pair.correlation is None


def test_scope_deletes_what_was_written_inside(spark):
    with scope(spark) as folder:
        kept = materialize(spark.range(5))
        assert kept.count() == 5
        assert folder.startswith(shared_folder(spark))
        assert folder_exists(spark, folder)
    assert not folder_exists(spark, folder)
