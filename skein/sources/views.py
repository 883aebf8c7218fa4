"""Record-linkage views over general tables, for the catalogue of queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _entity(key: str) -> dict:
    source = F.concat(F.lit("S"), (F.col(key) % 3 + 1).cast("string"))
    return {"entity_id": F.concat(source, F.lit("-"), F.col(key).cast("string")), "source": source}


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as records: the first sentence is the name, all that follows the address."""
    docs = table(spark, sf_dir, "documents")
    ids = _entity("doc_id")
    name = F.regexp_extract("text", r"^[^.]*", 0)
    return docs.select(ids["entity_id"].alias("entity_id"), ids["source"].alias("source"), F.col("lang").alias("country"), name.alias("business_name"), F.expr("substring(text, char_length(regexp_extract(text, '^[^.]*', 0)) + 1)").alias("business_address"))


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s1_id, cand_id): each record of S2 and S3 with the first and the last record of S1 of the same name, so that copies give at most two pairs a record."""
    rows = records(spark, sf_dir).select("entity_id", "source", "business_name")
    ends = rows.where("source = 'S1'").groupBy("business_name").agg(F.min("entity_id").alias("a"), F.max("entity_id").alias("b"))
    owners = ends.select("business_name", F.explode(F.array_distinct(F.array("a", "b"))).alias("s1_id"))
    return owners.join(rows.where("source <> 'S1'").select(F.col("entity_id").alias("cand_id"), "business_name"), "business_name").select("s1_id", "cand_id")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as records with short names and addresses."""
    ids = _entity("p_partkey")
    number = (F.col("p_partkey") % 997 + 10000).cast("string")
    return table(spark, sf_dir, "part").select(
        ids["entity_id"].alias("entity_id"),
        ids["source"].alias("source"),
        F.concat(F.lit("C"), (F.col("p_size") % 5).cast("string")).alias("country"),
        F.concat_ws(" ", "p_name", "p_brand").alias("name_core"),
        F.concat_ws(" ", F.lower("p_type"), "p_brand", number).alias("addr_norm"),
        F.concat_ws(" ", F.col("p_size").cast("string"), number, (F.col("p_partkey") % 89 + 100).cast("string")).alias("digits"),
        number.alias("postal"),
    )


def item_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s1_id, cand_id): parts of the same name, brand and country."""
    rows = items(spark, sf_dir).select("entity_id", "source", "country", "name_core")
    s1 = rows.where("source = 'S1'").select(F.col("entity_id").alias("s1_id"), "country", "name_core")
    return s1.join(rows.where("source <> 'S1'").select(F.col("entity_id").alias("cand_id"), "country", "name_core"), ["country", "name_core"]).select("s1_id", "cand_id")


def item_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity_id, source, class): item_truth() without its pairs, whose number grows with the square of the copies; an S1 record matches the others of its class, the least entity_id of the same name, brand and country."""
    rows = items(spark, sf_dir).select("entity_id", "source", "country", "name_core")
    least = rows.where("country IS NOT NULL").groupBy("country", "name_core").agg(F.min("entity_id").alias("class"))
    return rows.join(least, ["country", "name_core"]).select("entity_id", "source", "class")


def scored_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s1_id, cand_id, p_final, label): order lines as scored pairs."""
    line = table(spark, sf_dir, "lineitem")
    cand = F.concat(F.when(F.col("l_linenumber") % 2 == 0, "S2-").otherwise("S3-"), (F.col("l_partkey") * 10 + F.col("l_linenumber")).cast("string"))
    return line.groupBy(F.concat(F.lit("S1-"), F.col("l_orderkey").cast("string")).alias("s1_id"), cand.alias("cand_id")).agg(F.max(F.col("l_quantity") / 50.0).alias("p_final"), F.max((F.col("l_returnflag") == "R").cast("int")).alias("label"))


def s1_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s1_id, country, s1_ord): orders as entities."""
    orders = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return orders.select(F.concat(F.lit("S1-"), F.col("o_orderkey").cast("string")).alias("s1_id"), F.concat(F.lit("C"), F.col("c_nationkey").cast("string")).alias("country"), F.col("o_orderkey").alias("s1_ord"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = _entity("vec_id")
    return table(spark, sf_dir, "embeddings").select(ids["entity_id"].alias("entity_id"), ids["source"].alias("source"), F.concat(F.lit("L"), F.col("label").cast("string")).alias("country"), F.col("embedding").cast("array<double>").alias("vector"))


def pair_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records behind scored_pairs(): orders as entities, order lines' parts as candidates (a row for each source and line number)."""
    columns = ["entity_id", "source", "country", "name_raw", "addr_raw"]
    own = s1_table(spark, sf_dir).join(table(spark, sf_dir, "orders"), F.col("s1_ord") == F.col("o_orderkey"))
    s1 = own.select(F.col("s1_id").alias("entity_id"), F.lit("S1").alias("source"), "country", F.col("o_orderpriority").alias("name_raw"), F.col("o_orderstatus").alias("addr_raw"))
    line = table(spark, sf_dir, "lineitem").select("l_partkey", "l_linenumber").distinct().join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    source = F.when(F.col("l_linenumber") % 2 == 0, "S2").otherwise("S3")
    cand = line.select(F.concat(source, F.lit("-"), (F.col("l_partkey") * 10 + F.col("l_linenumber")).cast("string")).alias("entity_id"), source.alias("source"), F.lit(None).cast("string").alias("country"), F.col("p_name").alias("name_raw"), F.col("p_type").alias("addr_raw"))
    return s1.select(columns).unionByName(cand.select(columns))
