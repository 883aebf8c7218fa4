"""The profile of a dataset as one report: every profiling query, their small results collected and rendered."""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import contracts
from ..operators import profile as P
from ..sources.tsv import markdown_table, truth_pairs

#: What stands between these marks in an earlier report is kept.
BEGIN, END = "<!-- notes -->", "<!-- end of notes -->"
COLLECTED = 10_000


def profile(records: DataFrame, truth: DataFrame, frac: float = 0.2, seed: int = 42, k: int = 40, n: int = 15, n_new: int = 20) -> dict[str, DataFrame]:
    """Title to table, for records with a split (train, test) and the truth lists of train. Samples are of frac of the entities, by hash; examples are n."""
    train, test = records.where("split = 'train'"), records.where("split = 'test'")
    s1 = train.where("source = 'S1'").select(F.col("entity_id").alias("s1_id"), "country")
    pairs = truth_pairs(truth).select("s1_id", "cand_id")
    sample = contracts.sampled_ids(s1, "s1_id", frac, seed)
    drawn = pairs.join(sample, "s1_id", "left_semi")
    tokens = contracts.hash_sample(train, "entity_id", frac, seed)
    singles = sample.join(pairs, "s1_id", "left_anti")
    new = test.join(train.select("country").distinct(), "country", "left_anti")
    flags = P.pair_flags(train, drawn)
    texts = P.pair_texts(train, drawn)
    return {
        "Records": records.groupBy("split", "source", "country").agg(F.count(F.lit(1)).alias("n")).orderBy("split", "source", "country"),
        "Ids": P.id_checks(train).orderBy("source"),
        "Countries of test only": new.select("country").distinct().orderBy("country"),
        "Matches": P.match_stats(s1, pairs),
        "Matches an entity": P.match_dist(s1, pairs).orderBy("bucket"),
        "Matches by country": P.match_by_country(s1, pairs).orderBy("country"),
        "Coverage of the truth": P.truth_coverage(train, pairs, s1.select("s1_id")),
        "Candidates of several entities": P.owner_examples(pairs, train, 5),
        "Unmatched": P.unmatched_share(train, pairs).orderBy("source", "country"),
        "Pairs": P.pair_summary(flags).orderBy("country_s1"),
        "Names of pairs": P.ratio_summary(train, drawn),
        "Names of pairs by country": P.ratio_summary(train, drawn, ["country_s1"]).orderBy("country_s1"),
        "Length of names": P.length_stats(train, "business_name").orderBy("source", "country"),
        "Length of addresses": P.length_stats(train, "business_address").orderBy("source", "country"),
        "Noise": P.noise_rates(train).orderBy("source", "country"),
        "Tokens of names": P.top_tokens(tokens, "business_name", k).orderBy("country", "place"),
        "Tokens of addresses": P.top_tokens(tokens, "business_address", k).orderBy("country", "place"),
        "Examples of pairs": P.sampled_rows(texts, ["s1_id", "cand_id"], n, seed).orderBy("s1_id", "cand_id"),
        "Entities without match": P.singleton_near_miss(contracts.hash_sample(train.where("source <> 'S1'"), "entity_id", frac, seed).unionByName(train.where("source = 'S1'")), singles, n, seed).orderBy("s1_id"),
        "Records of new countries": P.sampled_rows(new, ["entity_id"], n_new, seed, ["country", "source"]).select("country", "source", "entity_id", "business_name", "business_address").orderBy("country", "source", "entity_id"),
    }


def kept_notes(text: str) -> str:
    found = re.search(re.escape(BEGIN) + "(.*?)" + re.escape(END), text, re.S)
    return found[1].strip("\n") if found else ""


def write_profile(tables: dict[str, DataFrame], path: str) -> None:
    """A Markdown report in the driver's file system. Notes that stand in an earlier one stay."""
    notes = ""
    if os.path.exists(path):
        with open(path, encoding="utf-8") as old:
            notes = kept_notes(old.read())
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    parts = ["# Profile", "", BEGIN, notes, END, ""]
    for title, df in tables.items():
        rows = df.limit(COLLECTED).collect()
        parts += [f"## {title}", "", markdown_table(df.columns, [list(r) for r in rows]) if rows else "none", ""]
    with open(path, "w", encoding="utf-8") as out:
        out.write("\n".join(parts))
