"""Profiling queries over records and truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fuzzy import token_set_ratio, token_sort_ratio
from ..functions.ids import source_of, stripped
from ..functions.text import NOISE, POSTAL, tokens

N = F.count


def row_counts(records: DataFrame) -> DataFrame:
    return records.groupBy("source", "country").agg(N(F.lit(1)).alias("n"))


def row_counts_pivot(records: DataFrame) -> DataFrame:
    wide = records.groupBy("country").pivot("source", ["S1", "S2", "S3"]).agg(N(F.lit(1)))
    return wide.na.fill(0)


def id_checks(records: DataFrame) -> DataFrame:
    return records.groupBy("source").agg(N(F.lit(1)).alias("n"), (N(F.lit(1)) - F.count_distinct("entity_id")).alias("n_repeats"), F.count_if(source_of(F.col("entity_id")) != F.col("source")).alias("n_bad_prefix"))


def matches_per_s1(s1: DataFrame, truth: DataFrame) -> DataFrame:
    pairs = truth.distinct()
    per = pairs.groupBy("s1_id").agg(N(F.lit(1)).alias("n"), F.count_if(F.col("cand_id").startswith("S2-")).alias("n2"), F.count_if(F.col("cand_id").startswith("S3-")).alias("n3"))
    return s1.join(per, "s1_id", "left").na.fill(0, ["n", "n2", "n3"])


def match_stats(s1: DataFrame, truth: DataFrame) -> DataFrame:
    per = matches_per_s1(s1, truth)
    some = F.greatest(F.count_if(F.col("n") > 0), F.lit(1))
    return per.agg(N(F.lit(1)).alias("n_s1"), F.count_if(F.col("n") == 0).alias("n_singletons"), (F.count_if(F.col("n") == 0) / F.greatest(N(F.lit(1)), F.lit(1))).alias("singleton_rate"), (F.sum("n") / some).alias("mean_matches"), F.max("n").alias("max_matches"), F.count_if(F.expr("n2 > 0 AND n3 = 0")).alias("s2_only"), F.count_if(F.expr("n3 > 0 AND n2 = 0")).alias("s3_only"), F.count_if(F.expr("n2 > 0 AND n3 > 0")).alias("both"), F.count_if(F.expr("n2 >= 2")).alias("two_in_s2"), F.count_if(F.expr("n3 >= 2")).alias("two_in_s3"))


def match_dist(s1: DataFrame, truth: DataFrame) -> DataFrame:
    per = matches_per_s1(s1, truth)
    bucket = F.when(F.col("n") >= 4, "4+").otherwise(F.col("n").cast("string"))
    counts = per.groupBy(bucket.alias("bucket")).agg(N(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))  # over five rows


def match_by_country(s1: DataFrame, truth: DataFrame) -> DataFrame:
    return matches_per_s1(s1, truth).groupBy("country").agg(N(F.lit(1)).alias("n"), (F.avg((F.col("n") == 0).cast("int")) * 100).alias("pct_singleton"), F.avg("n").alias("mean_matches"), (F.avg((F.col("n") >= 4).cast("int")) * 100).alias("pct_4_plus"))


def truth_coverage(records: DataFrame, truth: DataFrame, s1: DataFrame) -> DataFrame:
    """Ids of the truth that the sources lack, and entities that the truth lacks."""
    ids = records.select(F.col("entity_id").alias("id"))
    gaps = {
        "truth_s1_unknown": truth.select(F.col("s1_id").alias("id")).distinct().join(ids, "id", "left_anti"),
        "truth_cand_unknown": truth.select(F.col("cand_id").alias("id")).distinct().join(ids, "id", "left_anti"),
        "s1_without_truth": s1.join(truth, "s1_id", "left_anti"),
    }
    out = None
    for name, rows in gaps.items():
        one = rows.agg(N(F.lit(1)).alias("n")).select(F.lit(name).alias("gap"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def one_owner_violations(truth: DataFrame, n: int | None = None, shown: int = 20) -> DataFrame:
    """(cand_id, n_owners, owners): candidates of two or more entities, most owners first if only n are wanted. owners lists the first `shown` by id, so that a candidate of very many stays small."""
    pairs = truth.select("s1_id", "cand_id").distinct()
    many = pairs.groupBy("cand_id").agg(N(F.lit(1)).alias("n_owners")).where("n_owners >= 2")
    if n:
        many = many.orderBy(F.desc("n_owners"), "cand_id").limit(n)
    first = pairs.withColumn("_k", F.row_number().over(Window.partitionBy("cand_id").orderBy("s1_id"))).where(F.col("_k") <= shown)
    owners = first.groupBy("cand_id").agg(F.array_join(F.array_sort(F.collect_list("s1_id")), ",").alias("owners"))
    return many.join(owners, "cand_id").select("cand_id", "n_owners", "owners")


def owner_examples(truth: DataFrame, records: DataFrame, n: int = 5, shown: int = 20) -> DataFrame:
    """The n candidates of most owners, a row for each of their first owners, with names and addresses of both (null where records lack one)."""
    worst = one_owner_violations(truth, n, shown)
    rows = F.broadcast(worst.select("cand_id", "n_owners", F.explode(F.split("owners", ",")).alias("s1_id")))  # n times shown rows
    for side in ("cand", "s1"):
        text = records.select(F.col("entity_id").alias(f"{side}_id"), F.col("business_name").alias(f"{side}_name"), F.col("business_address").alias(f"{side}_addr"))
        rows = rows.join(text.join(rows.select(f"{side}_id").distinct(), f"{side}_id", "left_semi"), f"{side}_id", "left")
    return rows.select("cand_id", "cand_name", "cand_addr", "n_owners", "s1_id", "s1_name", "s1_addr")


def unmatched_share(records: DataFrame, truth: DataFrame) -> DataFrame:
    matched = truth.select("cand_id").distinct().withColumn("m", F.lit(1))
    rows = records.where("source <> 'S1'").join(matched, F.col("entity_id") == F.col("cand_id"), "left")
    return rows.groupBy("source", "country").agg(N(F.lit(1)).alias("n"), F.count_if(F.col("m").isNull()).alias("n_unmatched"), (F.avg(F.col("m").isNull().cast("int")) * 100).alias("pct_unmatched"))


def pair_texts(records: DataFrame, pairs: DataFrame) -> DataFrame:
    text = records.select("entity_id", "country", F.col("business_name").alias("name"), F.col("business_address").alias("addr"))
    for side in ("s1", "cand"):
        own = text.select(F.col("entity_id").alias(f"{side}_id"), *[F.col(c).alias(f"{c}_{side}") for c in ("country", "name", "addr")])
        pairs = pairs.join(own, f"{side}_id")
    return pairs


def pair_flags(records: DataFrame, pairs: DataFrame) -> DataFrame:
    rows = pair_texts(records, pairs)
    low = lambda c: F.lower(stripped(F.col(c)))
    codes = lambda c: F.regexp_extract_all(F.col(c), F.lit(POSTAL), F.lit(0))
    rows = rows.withColumns({"codes_s1": codes("addr_s1"), "codes_cand": codes("addr_cand")})
    both = (F.size("codes_s1") > 0) & (F.size("codes_cand") > 0)
    return rows.select("s1_id", "cand_id", "country_s1", (low("name_s1") == low("name_cand")).alias("same_name"), (low("addr_s1") == low("addr_cand")).alias("same_addr"), (F.col("country_s1") == F.col("country_cand")).alias("same_country"), both.alias("both_postal"), (both & F.arrays_overlap("codes_s1", "codes_cand")).alias("shared_postal"))


def pair_summary(flags: DataFrame, by: str = "country_s1") -> DataFrame:
    pct = lambda c: (F.avg(F.col(c).cast("int")) * 100).alias(f"pct_{c}")
    share = F.try_divide(F.sum(F.col("shared_postal").cast("int")), F.sum(F.col("both_postal").cast("int")))
    return flags.groupBy(by).agg(N(F.lit(1)).alias("n"), pct("same_name"), pct("same_addr"), pct("same_country"), share.alias("postal_agreement"))


def pair_ratios(records: DataFrame, pairs: DataFrame) -> DataFrame:
    rows = pair_texts(records, pairs)
    return rows.select("s1_id", "cand_id", token_set_ratio("name_s1", "name_cand").alias("name_tset"), token_sort_ratio("name_s1", "name_cand").alias("name_tsort"))


def ratio_summary(records: DataFrame, pairs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Median token-set ratio of names, share of pairs below 50, and shares of empty addresses, over all pairs or by columns of pair_texts()."""
    blank = lambda c: stripped(F.col(c)) == ""
    rows = pair_texts(records, pairs).withColumns({"tset": token_set_ratio("name_s1", "name_cand"), "none_s1": blank("addr_s1"), "none_cand": blank("addr_cand")})
    pct = lambda c, name: (F.avg(c.cast("int")) * 100).alias(name)
    return rows.groupBy(*(by or [])).agg(N(F.lit(1)).alias("n"), F.median("tset").alias("median_tset"), pct(F.col("tset") < 50, "pct_tset_below_50"), pct(F.col("none_s1") | F.col("none_cand"), "pct_no_addr"), pct(F.col("none_s1"), "pct_no_addr_s1"), pct(F.col("none_cand"), "pct_no_addr_cand"))


def sampled_rows(rows: DataFrame, key: list[str], n: int, seed: int = 42, by: list[str] | None = None) -> DataFrame:
    """n rows by hash of the key, in all or of each group: the same rows whatever their order."""
    draw = [F.xxhash64(*key, F.lit(seed)), *key]
    if not by:
        return rows.orderBy(*draw).limit(n)
    return rows.withColumn("_k", F.row_number().over(Window.partitionBy(*by).orderBy(*draw))).where(F.col("_k") <= n).drop("_k")


def length_stats(records: DataFrame, column: str) -> DataFrame:
    """p5, p50, p95 by nearest rank, maximum, share of empty and of non-ASCII values.

    Rows are counted by length first, so that the quantiles are found in running sums over lengths, not rows."""
    rows = records.select("source", "country", (F.col(column) == "").cast("long").alias("empty"), F.col(column).rlike(r"[^\x00-\x7F]").cast("long").alias("other"), F.char_length(column).cast("long").alias("len"))
    counts = rows.groupBy("source", "country", "len").agg(N(F.lit(1)).alias("c"), F.sum("empty").alias("empty"), F.sum("other").alias("other"))
    group = Window.partitionBy("source", "country")
    placed = counts.withColumn("upto", F.sum("c").over(group.orderBy("len"))).withColumn("n", F.sum("c").over(group))

    def at(q: float) -> Column:
        place = F.floor((F.col("n") - 1) * q + 0.5)
        return F.max(F.when((F.col("upto") > place) & (F.col("upto") - F.col("c") <= place), F.col("len")))

    share = lambda c: F.sum(c) * 100.0 / F.sum("c")
    return placed.groupBy("source", "country").agg(F.sum("c").alias("n"), at(0.05).alias("p5"), at(0.5).alias("p50"), at(0.95).alias("p95"), F.max("len").alias("max_len"), share("empty").alias("pct_empty"), share("other").alias("pct_non_ascii"))


def noise_rates(records: DataFrame) -> DataFrame:
    rates = [(F.avg(F.col(c).rlike(p).cast("int")) * 100).alias(f"pct_{name}") for name, (c, p) in NOISE.items()]
    return records.groupBy("source", "country").agg(N(F.lit(1)).alias("n"), *rates)


def top_tokens(records: DataFrame, column: str, k: int) -> DataFrame:
    """The k tokens of a country that occur in most of its records; pure numbers are left out."""
    totals = records.groupBy("country").agg(N(F.lit(1)).alias("total"))
    words = records.select("country", F.explode(F.array_distinct(F.filter(tokens(F.col(column)), lambda t: ~t.rlike("^[0-9]+$")))).alias("token"))
    counts = words.groupBy("country", "token").agg(N(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.partitionBy("country").orderBy(F.desc("n"), "token"))
    return counts.withColumn("place", place).where(F.col("place") <= k).join(totals, "country").select("country", F.col("place").cast("long").alias("place"), "token", "n", (F.col("n") / F.col("total") * 100).alias("pct"))


def top_tokens_pivot(top: DataFrame, countries: list[str]) -> DataFrame:
    cell = F.concat(F.col("token"), F.lit(" ("), F.format_number("pct", 1), F.lit("%)"))
    return top.groupBy("place").pivot("country", countries).agg(F.first(cell))


def singleton_near_miss(records: DataFrame, singles: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """For n singletons, drawn by hash, the candidate of the same country whose name is most alike."""
    drawn = sampled_rows(singles, ["s1_id"], n, seed)
    own = drawn.join(records, F.col("s1_id") == F.col("entity_id")).select("s1_id", "country", F.col("business_name").alias("name"))
    other = records.where("source <> 'S1'").select(F.col("entity_id").alias("cand_id"), "country", F.col("business_name").alias("cand_name"))
    rows = F.broadcast(own).join(other, "country")  # n rows at most
    scored = rows.withColumn("ratio", token_sort_ratio("name", "cand_name"))
    best: Column = F.max_by(F.struct("cand_id", "cand_name"), F.struct("ratio", "cand_id"))
    return scored.groupBy("s1_id", "name").agg(best.alias("b"), F.max("ratio").alias("ratio")).select("s1_id", "name", F.col("b.cand_id").alias("cand_id"), F.col("b.cand_name").alias("cand_name"), "ratio")
