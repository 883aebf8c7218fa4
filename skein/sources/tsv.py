"""TSV sources and sinks: every column text, no quoting, empty is not null."""

from __future__ import annotations

import functools
import json
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.ids import parse_id_list, source_of

SOURCE_COLUMNS = ["entity_id", "business_name", "business_address", "country"]
TRUTH_COLUMNS = ["source1_entity_id", "matched_entity_ids"]
CANDIDATE_COLUMNS = ["source1_entity_id", "candidate_entity_ids"]


def read_tsv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """All columns as text; with columns given, the header must be exactly those."""
    header = spark.read.text(path).first()
    found = header[0].split("\t") if header else []
    if columns is not None and found != columns:
        raise ValueError(f"{path}: expected columns {columns}, got {found}")
    schema = StructType([StructField(c, StringType()) for c in found])
    return spark.read.csv(path, sep="\t", quote="", header=True, schema=schema, enforceSchema=True).na.fill("")


def read_source(spark: SparkSession, folder: str, split: str, n: int) -> DataFrame:
    return read_tsv(spark, f"{folder}/{split}/{split}_source{n}.tsv", SOURCE_COLUMNS).withColumn("source", F.lit(f"S{n}"))


def read_all_sources(spark: SparkSession, folder: str, split: str) -> DataFrame:
    one, two, three = (read_source(spark, folder, split, n) for n in (1, 2, 3))
    return one.unionByName(two).unionByName(three)


def scan_all(spark: SparkSession, folder: str, splits: tuple[str, ...] = ("train", "test")) -> DataFrame:
    """All sources of the splits, with a column that names the split."""
    parts = [read_all_sources(spark, folder, split).withColumn("split", F.lit(split)) for split in splits]
    return functools.reduce(DataFrame.unionByName, parts)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in any store that Spark reads."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def load_records(spark: SparkSession, dataset: str, artifact: str, split: str, slice_only: bool = False) -> DataFrame:
    """Normalized records from their artifact if it is there, else the raw sources under contract names; a slice is always cut from the raw sources."""
    if not slice_only and exists(spark, artifact):
        return spark.read.parquet(artifact)
    rows = with_fallback_columns(read_all_sources(spark, dataset, split))
    return small_slice(rows) if slice_only else rows


def load_s1(spark: SparkSession, dataset: str, artifact: str, split: str) -> DataFrame:
    """(s1_id, country, s1_ord) of a split: countries from the records' artifact if it is there; the order is that of the raw table's rows."""
    raw = with_order(read_source(spark, dataset, split, 1)).select(F.col("entity_id").alias("s1_id"), "country", F.col("_at").alias("s1_ord"))
    if not exists(spark, artifact):
        return raw
    known = spark.read.parquet(artifact).where("source = 'S1'").select(F.col("entity_id").alias("s1_id"), "country")
    return known.join(raw.select("s1_id", "s1_ord"), "s1_id")


def with_order(rows: DataFrame) -> DataFrame:
    """rows with _at, which grows along the file: place of the block, then of the row (not dense)."""
    return rows.withColumn("_at", F.monotonically_increasing_id())


def read_truth(spark: SparkSession, folder: str, split: str = "train") -> DataFrame:
    return read_tsv(spark, f"{folder}/{split}/{split}_ground_truth.tsv", TRUTH_COLUMNS)


def load_truth(spark: SparkSession, folder: str, split: str = "train") -> DataFrame | None:
    """The truth of a split, or None where there is none."""
    return read_truth(spark, folder, split) if exists(spark, f"{folder}/{split}/{split}_ground_truth.tsv") else None


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """(s1_id, cand_id) of a file of matches."""
    return truth_pairs(read_tsv(spark, path, TRUTH_COLUMNS)).select("s1_id", "cand_id")


def read_id_lines(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Two text columns as they stand: a row without a tab has a null id and its text in the second; blank lines are left out.

    FileNotFoundError if the path isn't there, ValueError if the first line isn't the header. In a folder each part may begin with the header."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    lines = spark.read.text(path)
    head = lines.first()
    found = [] if head is None else [c.strip().lower() for c in head[0].split("\t")]
    if found != columns:
        hint = "empty" if head is None else "separated by commas, not tabs" if len(found) == 1 and "," in found[0] else f"headed by {found}, not {columns}"
        raise ValueError(f"{path} is {hint}")
    rows = lines.where((F.col("value") != head[0]) & (F.trim("value") != ""))
    tab = F.instr("value", "\t")
    return rows.select(F.when(tab > 0, F.substring_index("value", "\t", 1)).alias(columns[0]), F.when(tab > 0, F.expr("substring(value, instr(value, '\t') + 1)")).otherwise(F.col("value")).alias(columns[1]))


def truth_pairs(truth: DataFrame) -> DataFrame:
    """(s1_id, cand_id, cand_source), distinct; entities without matches give no rows."""
    pairs = truth.select(F.col("source1_entity_id").alias("s1_id"), F.explode(parse_id_list(F.col("matched_entity_ids"))).alias("cand_id"))
    return pairs.distinct().withColumn("cand_source", source_of(F.col("cand_id")))


def write_id_tsv(df: DataFrame, path: str, one_file: bool = False) -> None:
    """Text columns with a header, without quoting; tabs, line breaks and quotes are refused, null is empty.

    Every task writes a part with the header into the folder at path; one_file makes it one part, written by one task
    (what must be handed in as one file is small)."""
    columns = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns]
    out = df.select(columns)
    bad = out.where(" OR ".join(f"`{c}` RLIKE '[\\\\t\\\\n\\\\r\"]'" for c in df.columns)).limit(3).collect()
    if bad:
        raise ValueError(f"tabs, line breaks or quotes in {bad}")
    (out.repartition(1) if one_file else out).write.mode("overwrite").csv(path, sep="\t", header=True, quote="", emptyValue="", lineSep="\n")


def write_tsv(df: DataFrame, path: str) -> None:
    """Any columns as text with a header, without quoting: tabs, line breaks and backslashes are escaped by a backslash."""
    def escaped(c: str) -> Column:
        text = F.coalesce(F.col(c).cast("string"), F.lit(""))
        for plain, shown in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
            text = F.replace(text, F.lit(plain), F.lit(shown))
        return text.alias(c)

    df.select([escaped(c) for c in df.columns]).write.mode("overwrite").csv(path, sep="\t", header=True, quote="", emptyValue="", escape="", lineSep="\n")


def candidate_lists(s1: DataFrame, pairs: DataFrame, order: str | None = None) -> DataFrame:
    """(source1_entity_id, candidate_entity_ids): a comma list for every row of s1, empty lists included."""
    key = F.struct(F.col(order), F.col("cand_id")) if order else F.struct(F.lit(0), F.col("cand_id"))
    lists = pairs.groupBy("s1_id").agg(F.array_join(F.array_distinct(F.transform(F.array_sort(F.collect_list(key)), lambda x: x["cand_id"])), ",").alias("ids"))
    return s1.select(F.col("entity_id").alias("source1_entity_id")).join(lists, F.col("source1_entity_id") == F.col("s1_id"), "left").select("source1_entity_id", F.coalesce("ids", F.lit("")).alias("candidate_entity_ids"))


def with_fallback_columns(raw: DataFrame) -> DataFrame:
    """Contract names over raw columns; derived columns as plain copies or empty."""
    out = raw.withColumnsRenamed({"business_name": "name_raw", "business_address": "addr_raw"})
    return out.withColumns({"name_core": F.col("name_raw"), "addr_norm": F.col("addr_raw"), "digits": F.lit(""), "postal": F.lit("")})


def small_slice(records: DataFrame, n_s1: int = 500, n_cands: int = 2000) -> DataFrame:
    """For a quick run: the first n_s1 entities in all, and the first n_cands candidates of each country, by id."""
    s1 = records.where("source = 'S1'").orderBy("entity_id").limit(n_s1)
    place = F.row_number().over(Window.partitionBy("country").orderBy("entity_id"))
    others = records.where("source <> 'S1'").withColumn("_n", place).where(F.col("_n") <= n_cands).drop("_n")
    return s1.unionByName(others)


def to_json(value) -> str:
    """Plain JSON of collected results; NaN as null."""

    def plain(x):
        if isinstance(x, dict):
            return {str(k): plain(v) for k, v in x.items()}
        if isinstance(x, (list, tuple)):
            return [plain(v) for v in x]
        return None if isinstance(x, float) and math.isnan(x) else x

    return json.dumps(plain(value), indent=2, ensure_ascii=False, default=str)


def markdown_table(columns: list[str], rows: list) -> str:
    """Pipe table of a collected result: pipes escaped, nulls blank, 1,234 and 0.1234."""

    def cell(x) -> str:
        if x is None or isinstance(x, float) and math.isnan(x):
            return ""
        if isinstance(x, bool):
            return str(x)
        return f"{x:,}" if isinstance(x, int) else f"{x:.4f}" if isinstance(x, float) else str(x).replace("|", "\\|")

    lines = [columns, ["---"] * len(columns), *[[cell(x) for x in row] for row in rows]]
    return "\n".join("| " + " | ".join(line) + " |" for line in lines)
