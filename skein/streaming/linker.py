"""Incremental linking: scored pairs arrive as a stream; what they touch is decided anew."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.decide import Params, decisions
from ..sources.tsv import exists


def _latest(rows: DataFrame, key: list[str]) -> DataFrame:
    """Of the batches that hold a key, the rows of the last one."""
    return rows.withColumn("_last", F.max("batch").over(Window.partitionBy(*key))).where("batch = _last").drop("_last")


def start_linker(scores: DataFrame, s1: DataFrame, params: Params, out: str, checkpoint: str, train_countries: list[str] | None = None):
    """Keep all pairs under out/pairs and decisions under out/decisions, a folder a batch, so that a batch that runs again replaces its own rows.

    A gate looks at all pairs of an entity, an owner at all pairs of a candidate, whatever batch they came in. So after
    a batch the candidates of its entities are decided anew, over all pairs of all entities that propose them; a pair
    that comes again counts with its last score. current_decisions() reads what holds."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.select("s1_id", "cand_id", "p_final").write.mode("overwrite").parquet(f"{out}/pairs/batch={number}")
        pairs = _latest(spark.read.parquet(f"{out}/pairs").where(F.col("batch") <= number), ["s1_id", "cand_id"]).drop("batch")
        touched = pairs.join(batch.select("s1_id").distinct(), "s1_id", "left_semi").select("cand_id").distinct()
        entities = pairs.join(touched, "cand_id", "left_semi").select("s1_id").distinct()
        around = pairs.join(entities, "s1_id", "left_semi")
        decided = decisions(around, s1, params, train_countries).join(touched, "cand_id", "left_semi")
        decided.write.mode("overwrite").parquet(f"{out}/decisions/batch={number}")

    return scores.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_decisions(spark: SparkSession, out: str) -> DataFrame:
    """(s1_id, cand_id, p_final, is_match): for each candidate what the last batch that touched it decided."""
    if not exists(spark, f"{out}/decisions"):
        return spark.createDataFrame([], "s1_id string, cand_id string, p_final double, is_match boolean")
    return _latest(spark.read.parquet(f"{out}/decisions"), ["cand_id"]).select("s1_id", "cand_id", "p_final", "is_match")
