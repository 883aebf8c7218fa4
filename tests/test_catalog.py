"""Each catalogued query against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from skein.plans import catalog

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS FROM '{FOLDER}/{t}.parquet'")
    return con


def plain(rows):
    return sorted(tuple("" if v is None else f"{v:.6g}" if isinstance(v, float) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(set(catalog.ORACLES) - {"recall_at_k"}))  # the smallest tables hold no true pair to recall
def test_query(spark, db, name):
    df = catalog.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    want = db.sql(catalog.ORACLES[name])
    assert sorted(want.columns) == columns
    assert plain(df.select(columns).collect()) == plain(want.select(*[f'"{c}"' for c in columns]).fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_models(spark):
    from pyspark.sql import functions as F

    from skein.operators import scoring

    rows = spark.range(600).select(F.concat(F.lit("S1-"), (F.col("id") % 90).cast("string")).alias("s1_id"), F.concat(F.lit("S2-"), F.col("id").cast("string")).alias("cand_id"), F.rand(3).alias("f_str_a"), F.rand(4).alias("f_str_b"))
    rows = scoring.materialize(rows.withColumn("label", (F.col("f_str_a") > 0.6).cast("int")), spark)
    scores, models = scoring.train_oof(rows, 3, (1, 2), 40)
    assert len(models) == 6 and scores.count() == 600 and scores.where("p_final NOT BETWEEN 0 AND 1").count() == 0
    noise = rows.withColumn("label", (F.rand(5) > 0.5).cast("int"))
    assert all(m.getNumTrees < 40 for m in scoring.train_oof(scoring.materialize(noise, spark), 2, (1,), 40)[1])  # the loss on the held fold stops them
    held = scores.join(rows, ["s1_id", "cand_id"])
    assert held.where("(p_final > 0.5) = (label = 1)").count() > 570
    assert held.groupBy("s1_id").agg(F.count_distinct("fold").alias("n")).where("n > 1").count() == 0
    assert scoring.predict(rows, models).count() == 600
    s1 = rows.select("s1_id").distinct().withColumn("country", F.when(F.crc32("s1_id") % 2 == 0, "A").otherwise("B"))
    loco, failed = scoring.loco_of(rows, s1, 5)
    assert failed == {} and {r[0] for r in loco.select("holdout_country").distinct().collect()} == {"A", "B"} and loco.count() == 600
    one_class = rows.withColumn("label", F.lit(1))
    assert scoring.loco_of(one_class, s1.withColumn("country", F.lit("A")))[0] is None
    texts = rows.select("s1_id", "cand_id", F.lit("x").alias("a"), F.col("cand_id").alias("b")).where("label = 1")

    def model(parts):
        for a, b in parts:
            yield [float(x != y) for x, y in zip(a, b, strict=True)]

    both = scoring.with_cross_encoder(scores, texts, model)
    assert both.where("p_ce = 1 AND abs(p_final - (p_lgbm + 1) / 2) < 1e-9").count() == texts.count() and both.where("p_ce IS NULL AND p_final = p_lgbm").count() == 600 - texts.count()


def test_no_country_left_out_for_a_failure(spark, monkeypatch):
    """A fit that fails is an error that names its country, not a result without it; pairs without a country are learned from."""
    from pyspark.sql import functions as F

    from skein.operators import scoring

    rows = spark.range(60).select(F.concat(F.lit("S1-"), "id").alias("s1_id"), F.concat(F.lit("S2-"), "id").alias("cand_id"), (F.col("id") / 60).alias("f_str_a"), (F.col("id") % 2).cast("int").alias("label"))
    s1 = rows.select("s1_id", F.element_at(F.array(F.lit("A"), F.lit("B"), F.lit(None)), (F.substring("s1_id", 4, 9).cast("int") % 3 + 1)).alias("country"))
    real = scoring.boosting

    def boosting(*given):
        run = real(*given)

        def broken(batches):
            raise OSError("an executor was lost")
            yield from run(batches)

        return broken if fails else run

    monkeypatch.setattr(scoring, "boosting", boosting)
    fails = False
    scores, lacking = scoring.loco_of(rows, s1, 2)
    assert lacking == {} and {r.holdout_country: r["count"] for r in scores.groupBy("holdout_country").count().collect()} == {"A": 20, "B": 20}
    fails = True
    with pytest.raises(Exception, match="an executor was lost"):
        scoring.loco_of(rows, s1, 2)
    assert scoring.loco_of(rows, s1.where("country = 'A'"), 2) == (None, {"A": "leave-one-country-out needs two countries"})
    cells = scoring.Cells(rows.join(s1, "s1_id"), ["f_str_a"], "country", ["A", "B"])
    assert cells.rows.selectExpr("sum(_n)", "sum(_n - _n0)", "sum(_n - _n1)").first()[:] == (60, 40, 40)  # a country's model learns from pairs without one too


def test_fits_count_equal_pairs(spark, monkeypatch):
    """Copies of pairs make no more work for a fit, count each, and tasks that add up their sums give trees that part the values where the labels change."""
    from pyspark.sql import functions as F

    from skein.operators import scoring

    base = F.col("id") % 100
    rows = spark.range(3000).select((base / 10).alias("f_str_a"), (base % 7).cast("double").alias("f_str_b"), (base >= 37).cast("int").alias("label"), (F.col("id") % 2).alias("fold"))
    monkeypatch.setattr(scoring, "TASK_ROWS", 40)
    cells = scoring.Cells(rows, ["f_str_a", "f_str_b"], "fold", [0, 1])
    assert cells.rows.count() <= 100 and cells.tasks > 1 and cells.rows.agg(F.sum("_n")).first()[0] == 3000
    models = cells.fit([(0, 1), (1, 1)], 30, False)
    assert [m.getNumTrees for m in models] == [30, 30]
    for model in models:
        found = scoring._scored(model, scoring._assembled(rows, ["f_str_a", "f_str_b"]), "p")
        assert found.where("(p > 0.5) = (label = 1)").count() >= 2940  # ranges hold three values each


def test_incremental_linker(spark, tmp_path):
    """Entities and candidates that are split over batches are decided as if all pairs had come at once."""
    from skein.operators.decide import Params, decisions
    from skein.sources import views
    from skein.streaming.linker import current_decisions, start_linker

    pairs, s1 = views.scored_pairs(spark, FOLDER).drop("label"), views.s1_table(spark, FOLDER)
    params = Params(one_owner=True, alpha=0.7)
    for part in range(3):
        pairs.where(f"pmod(crc32(cand_id || s1_id), 3) = {part}").write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(pairs.schema).parquet(str(tmp_path / "in"))
        start_linker(stream, s1, params, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    want = decisions(pairs, s1, params)
    got = current_decisions(spark, str(tmp_path / "out"))
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0


def test_encoder_plugin(spark):
    from skein.operators import blocking

    rows = spark.createDataFrame([("S1-1", "S1", "X", "aab", ""), ("S2-1", "S2", "Y", "aabb", ""), ("S3-1", "S3", "X", "zz", "y"), ("S2-2", "S2", "X", None, None)], "entity_id string, source string, country string, name_core string, addr_norm string")

    def encode(batches):
        for texts in batches:
            yield [[float(t.count(c)) for c in "abyz"] for t in texts]

    assert [tuple(r)[:3] for r in blocking.block_texts(rows, encode).collect()] == [("S1-1", "S2-1", 1)]


def test_text_blocking_without_frequent_grams(spark):
    """The bound leaves frequent grams out, and finds the same neighbours as joining everything."""
    from skein.operators import blocking

    items = catalog.V.items(spark, FOLDER)
    few = {tuple(r)[:3] for r in blocking.block_tfidf(items, "name_core", 3, "r", "s", frequent=4).collect()}
    assert few == {tuple(r)[:3] for r in blocking.block_tfidf(items, "name_core", 3, "r", "s", frequent=10**9).collect()}


def test_feature_groups(spark):
    found = catalog.QUERIES["features_all"](spark, FOLDER)
    assert {c.split("_")[1] for c in found.columns if c.startswith("f_")} == {"str", "vec", "ctx"} and "f_str_name_tset" in found.columns
    assert found.count() == catalog._candidates(spark, FOLDER).count() and found.where("label NOT IN (0, 1)").count() == 0
