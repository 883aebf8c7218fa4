"""Scores: group folds, out-of-fold boosted trees, prediction, leave-one-country-out, synthetic scores."""

from __future__ import annotations

import functools
import json
import math
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.boosting import NODES, boosting
from ..sources.scratch import discard, materialize, shared_dir

NOT_FEATURES = {"s1_id", "cand_id", "label", "fold", "low_confidence", "country"}


def group_folds(pairs: DataFrame, n_folds: int) -> DataFrame:
    """(s1_id, n, fold): whole entities, dealt in turn by size, largest first."""
    sizes = pairs.groupBy("s1_id").agg(F.count(F.lit(1)).alias("n"))
    # sizes are few values: entities of equal size are numbered within hash cells, cells by running totals
    cell = F.pmod(F.xxhash64("s1_id"), F.lit(1024))
    rows = sizes.withColumn("cell", cell)
    cells = rows.groupBy("n", "cell").agg(F.count(F.lit(1)).alias("c"))
    before = F.coalesce(F.sum("c").over(Window.orderBy(F.desc("n"), "cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # over sizes x 1024 rows
    inside = F.row_number().over(Window.partitionBy("n", "cell").orderBy("s1_id")) - 1
    placed = rows.withColumn("i", inside).join(cells.select("n", "cell", before.alias("before")), ["n", "cell"])
    return placed.select("s1_id", "n", ((F.col("before") + F.col("i")) % n_folds).cast("int").alias("fold"))


def feature_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in NOT_FEATURES]


def _assembled(df: DataFrame, columns: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol="_features", handleInvalid="keep").transform(df.na.fill(0.0, columns))


#: Boosting: trees at most, rows and columns a tree sees, step.
TREES, SHARE, STEP, DEPTH = 500, 0.8, 0.1, 5
#: Share by which a tree must lower the loss on the held fold.
LEAST_GAIN = 0.02
#: Models that the driver stores and loads at the same time.
AT_ONCE = 8
#: Ranges of a feature that a tree tells apart, and bits that number them; steps of the quantiles they are cut at.
BINS, BITS, STEPS = 32, 5, 1000
#: Cells of a task of a fit, at least.
TASK_ROWS = 1 << 14
#: Nodes as pyspark.ml stores them.
STORED_NODES = "treeID int, nodeData struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,rawCount:bigint,gain:double,leftChild:int,rightChild:int,split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>>"


def _cuts(steps: list[float]) -> list[float]:
    """Where to cut values given by their quantiles: between all that differ, or where they are more than BINS, between BINS ranges of about as many rows each."""
    count: dict[float, int] = {}
    for v in steps:
        count[v] = count.get(v, 0) + 1
    values = sorted(count)
    out, rest, bins, own = [], len(steps), BINS, 0
    for v, after in zip(values, values[1:]):
        own += count[v]
        if len(values) <= BINS or (bins > 1 and own * bins >= rest):
            middle = v / 2 + after / 2
            out.append(middle if middle > v else after)
            rest, bins, own = rest - own, bins - 1, 0
    return out


class Cells:
    """Pairs counted by the ranges their features fall in, label and group (a fold or country): trees that cut at the ranges' ends learn from counts what they would from all pairs.

    The pairs are many and the cells fewer; pairs of equal features make one. Every pair counts."""

    def __init__(self, rows: DataFrame, columns: list[str], group: str, groups: list):
        self.spark, self.columns, self.groups = rows.sparkSession, columns, groups
        rows = rows.na.fill(0.0, columns).select(*[F.col(c).cast("double").alias(c) for c in columns], "label", group)
        self.ends = [[-math.inf, *(_cuts(steps) or [0.0]), math.inf] for steps in rows.approxQuantile(columns, [i / STEPS for i in range(STEPS + 1)], 0.5 / STEPS)]
        names = [f"_b{i}" for i in range(len(columns))]
        rows = Bucketizer(splitsArray=self.ends, inputCols=columns, outputCols=names).transform(rows)
        each = 60 // BITS
        keys = [functools.reduce(Column.bitwiseOR, [F.shiftleft(F.col(n).cast("long"), BITS * j) for j, n in enumerate(names[i : i + each])]).alias(f"_k{i // each}") for i in range(0, len(names), each)]
        by = [*[f"_k{i}" for i in range(len(keys))], "label"]
        counts = [F.count_if(F.col(group) == g).alias(f"_n{i}") for i, g in enumerate(groups)]
        self.rows = materialize(rows.select(*keys, "label", group).groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), *counts), self.spark)
        self.by, self.n_keys = by, len(keys)
        self.tasks = min(self.spark.sparkContext.defaultParallelism, 1 + self.rows.count() // TASK_ROWS)  # all have to run at once

    def fit(self, groups: list[tuple], rounds: int, early: bool) -> list[GBTClassificationModel]:
        """A model for each (group, seed), of the pairs of other groups; all are fitted at the same time, by tasks that keep the cells."""
        models = [(self.groups.index(g), seed) for g, seed in groups]
        run = boosting(self.n_keys, len(self.columns), BITS, models, len(self.groups), rounds, early, DEPTH, SHARE, STEP, LEAST_GAIN)
        own = self.rows.repartition(self.tasks, *self.by).sortWithinPartitions(*self.by)
        nodes: dict[int, list] = {i: [] for i in range(len(models))}
        for row in own.mapInArrow(run, NODES, barrier=True).collect():
            nodes[row.model].append(row)
        return _fitted([functools.partial(self.model, nodes[i], seed) for i, (_, seed) in enumerate(models)])

    def model(self, nodes: list, seed: int) -> GBTClassificationModel:
        """The trees as a model of pyspark.ml, through the format it is stored in. Left of a cut are the ranges up to a number, which are the values below the end of the last of them."""
        path, sc = f"{shared_dir(self.spark).rstrip('/')}/skein-{uuid.uuid4().hex}", self.spark.sparkContext
        split = lambda r: (r.feature, [math.nextafter(self.ends[r.feature][r.cut + 1], -math.inf)], -1) if r.feature >= 0 else (-1, [], -1)
        rows = [(r.tree, (r.id, r.prediction, 0.0, [r.weight, r.total, 0.0], int(r.weight), r.gain, r.left, r.right, split(r))) for r in nodes]
        self.spark.createDataFrame(rows, STORED_NODES).coalesce(1).write.parquet(f"{path}/data")
        about = lambda kind, uid, given, **more: json.dumps({"class": f"org.apache.spark.ml.{kind}", "timestamp": 0, "sparkVersion": self.spark.version, "uid": uid, "paramMap": given, "defaultParamMap": {}} | more)
        count, own, name = 1 + max(r.tree for r in nodes), {"featuresCol": "_features", "predictionCol": "_p", "impurity": "variance", "leafCol": ""}, uuid.uuid4().hex[:12]
        trees = [(i, about("regression.DecisionTreeRegressionModel", f"dtr_{name}_{i}", own), STEP if i else 1.0) for i in range(count)]
        self.spark.createDataFrame(trees, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
        given = own | {"labelCol": "label", "rawPredictionCol": "_raw", "probabilityCol": "_prob", "maxDepth": DEPTH, "stepSize": STEP, "subsamplingRate": SHARE, "featureSubsetStrategy": str(SHARE), "maxBins": BINS, "maxIter": count, "seed": seed}
        self.spark.createDataFrame([(about("classification.GBTClassificationModel", f"GBTClassifier_{name}", given, numFeatures=len(self.columns), numTrees=count),)], "value string").coalesce(1).write.text(f"{path}/metadata")
        out = GBTClassificationModel.load(path)
        folder = sc._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)
        return out


def _scored(model: GBTClassificationModel, rows: DataFrame, out: str) -> DataFrame:
    return model.transform(rows).withColumn(out, vector_to_array("_prob")[1]).drop("_p", "_raw", "_prob")


def _fitted(fits: list[Callable]) -> list:
    """The results of the fits, AT_ONCE at a time, in their order."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        return list(pool.map(lambda f: f(), fits))


def _mean(names: list[str]) -> Column:
    return sum((F.col(n) for n in names[1:]), F.col(names[0])) / len(names)


def train_oof(features: DataFrame, n_folds: int = 5, seeds: tuple[int, ...] = (42,), rounds: int = TREES) -> tuple[DataFrame, list[GBTClassificationModel]]:
    """(scores, models): out-of-fold probabilities, mean over seeds, of every pair.

    Trees are added up to rounds, until the loss on the fold that is left out no longer falls."""
    columns, spark = feature_columns(features), features.sparkSession
    rows = materialize(features.drop("fold").join(group_folds(features, n_folds).select("s1_id", "fold"), "s1_id"), spark)
    cells, parts = Cells(rows, columns, "fold", list(range(n_folds))), []
    models = cells.fit([(fold, seed) for fold in range(n_folds) for seed in seeds], rounds, True)
    discard(cells.rows)
    for fold in range(n_folds):
        held, names = _assembled(rows.where(F.col("fold") == fold), columns), []
        for i, seed in enumerate(seeds):
            names.append(f"_s{seed}")
            held = _scored(models[fold * len(seeds) + i], held, names[-1])
        parts.append(held.select("s1_id", "cand_id", F.col("fold").cast("short").alias("fold"), _mean(names).alias("p_lgbm"), F.lit(None).cast("double").alias("p_ce"), _mean(names).alias("p_final")))
    out = materialize(functools.reduce(DataFrame.unionByName, parts), spark)
    discard(rows)
    return out, models


def predict(features: DataFrame, models: list[GBTClassificationModel]) -> DataFrame:
    rows, names = _assembled(features, feature_columns(features)), []
    for i, model in enumerate(models):
        names.append(f"_m{i}")
        rows = _scored(model, rows, names[-1])
    return rows.select("s1_id", "cand_id", _mean(names).alias("p_lgbm"), F.lit(None).cast("double").alias("p_ce"), _mean(names).alias("p_final"))


def train_loco(features: DataFrame, s1: DataFrame, countries: list[str], rounds: int = 40) -> DataFrame:
    """Scores of each country by a model of all other pairs, those without a country too; needs two countries.

    There is no fold to watch, so the number of trees is fixed. A fit that fails is an error: the scores of some countries never pass for those of all."""
    if len(countries) < 2:
        raise ValueError("leave-one-country-out needs two countries")
    columns, spark, parts = feature_columns(features), features.sparkSession, []
    rows = materialize(features.drop("country").join(s1.select("s1_id", "country"), "s1_id", "left"), spark)
    cells = Cells(rows, columns, "country", countries)

    for country, model in zip(countries, cells.fit([(country, 42) for country in countries], rounds, False), strict=True):
        parts.append(_scored(model, _assembled(rows.where(F.col("country") == country), columns), "p").select("s1_id", "cand_id", F.col("p").alias("p_lgbm"), F.col("p").alias("p_final"), F.lit(country).alias("holdout_country")))
    out = materialize(functools.reduce(DataFrame.unionByName, parts), spark)
    discard(rows, cells.rows)
    return out


def loco_of(features: DataFrame, s1: DataFrame, rounds: int = 40) -> tuple[DataFrame | None, dict[str, str]]:
    """(scores, countries without scores) over all countries of s1 that features have (a few values).

    Below two countries there are no scores, and the second part says so of the only one; a fit that fails is an error."""
    known = sorted(r[0] for r in s1.join(features.select("s1_id").distinct(), "s1_id", "left_semi").select("country").distinct().where("country IS NOT NULL").collect())
    if len(known) < 2:
        return None, dict.fromkeys(known, "leave-one-country-out needs two countries")
    return train_loco(features, s1, known, rounds), {}


def with_cross_encoder(scores: DataFrame, texts: DataFrame, score: Callable[[Iterator[tuple[list[str], list[str]]]], Iterator[list[float]]], weight: float = 0.5, batch: int = 512) -> DataFrame:
    """scores with p_ce, by a model of the caller's over both texts of a pair, and p_final as the weighted mean with p_lgbm.

    texts is (s1_id, cand_id, a, b); score takes an iterator over pairs of lists of texts and yields as many lists of
    probabilities, once a task. Pairs without texts keep p_final."""

    @F.arrow_udf("double")
    def probability(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        parts = ((a.slice(i, batch).to_pylist(), b.slice(i, batch).to_pylist()) for a, b in batches for i in range(0, len(a), batch))
        for found in score(parts):
            yield pa.array(found, pa.float64())

    own = texts.select("s1_id", "cand_id", probability(F.coalesce("a", F.lit("")), F.coalesce("b", F.lit(""))).alias("p_ce"))
    both = F.lit(1 - weight) * F.col("p_lgbm") + F.lit(weight) * F.col("p_ce")
    return scores.drop("p_ce").join(own, ["s1_id", "cand_id"], "left").withColumn("p_final", F.coalesce(both, F.col("p_final")))


def synthetic_scores(pairs: DataFrame, a: str, b: str, n_folds: int = 5, seed: int = 42) -> DataFrame:
    """The mean of two features in 0 to 1, missing as 0, with a fold for each entity."""
    value = lambda c: F.coalesce(F.when(~F.isnan(c), F.col(c)), F.lit(0.0))
    fold = F.pmod(F.xxhash64("s1_id", F.lit(seed)), F.lit(n_folds)).cast("short")
    return pairs.select("s1_id", "cand_id", ((value(a) + value(b)) / 2).alias("p_final"), fold.alias("fold"))


def mock_scores(spark, n_s1: int, each: int = 5, seed: int = 42) -> DataFrame:
    rows = spark.range(n_s1 * each)
    side = F.when(F.col("id") % 2 == 0, "S2-").otherwise("S3-")
    return rows.select(F.concat(F.lit("S1-"), (F.col("id") / each).cast("long").cast("string")).alias("s1_id"), F.concat(side, F.col("id").cast("string")).alias("cand_id"), F.rand(seed).alias("p_final"))
