"""From scored pairs to matches: gate, pair threshold, relative cut, one owner; and the threshold search."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import source_of
from ..functions.metric import f05, precision, recall

MIN_P = 0.2
GRID = [round(0.30 + 0.025 * i, 3) for i in range(27)]
ALPHAS, OWNERS, DELTAS = [0.0, 0.5, 0.6, 0.7, 0.8, 0.9], [False, True], [-0.05, 0.0, 0.05]


@dataclass(frozen=True)
class Params:
    tau_gate: float = 0.5
    tau_pair: float = 0.5
    tau_s2: float | None = None
    tau_s3: float | None = None
    alpha: float = 0.0
    delta_unseen: float = 0.0
    one_owner: bool = False

    @classmethod
    def of(cls, config: dict) -> Params:
        """Unknown keys are ignored; null alpha and delta are 0."""
        own = {f.name: config[f.name] for f in fields(cls) if f.name in config}
        return cls(**{k: 0.0 if v is None and k in ("alpha", "delta_unseen") else v for k, v in own.items()})

    def least_threshold(self) -> float:
        given = [self.tau_pair if t is None else t for t in (self.tau_s2, self.tau_s3)]
        return min(given) + min(0.0, self.delta_unseen)


def _passing(scores: DataFrame, s1: DataFrame, params: Params, train_countries: list[str] | None, least: float | None) -> DataFrame:
    """scores with s1's columns and passes: whether gate, pair threshold and relative cut let a pair through."""
    kept = (scores if least is None else scores.where(F.col("p_final") >= least)).join(s1, "s1_id")
    offset = F.lit(0.0) if train_countries is None else F.when(F.col("country").isin(train_countries), 0.0).otherwise(params.delta_unseen)
    source = source_of(F.col("cand_id"))
    tau = F.when(source == "S2", params.tau_pair if params.tau_s2 is None else params.tau_s2).when(source == "S3", params.tau_pair if params.tau_s3 is None else params.tau_s3).otherwise(params.tau_pair)
    best = F.max("p_final").over(Window.partitionBy("s1_id"))
    passes = (best >= F.lit(params.tau_gate) + offset) & (F.col("p_final") >= tau + offset)
    return kept.withColumn("passes", passes & (F.col("p_final") >= params.alpha * best) if params.alpha > 0 else passes)


def _pruned_at(params: Params, min_p: float) -> float:
    """Scores below this can't be matched by any threshold."""
    return min(min_p, params.least_threshold())


def decide(scores: DataFrame, s1: DataFrame, params: Params, train_countries: list[str] | None = None, min_p: float = MIN_P) -> DataFrame:
    """The matches (s1_id, cand_id, p_final, is_match) among pairs of the entities of s1 (s1_id, country, s1_ord).

    Scores below min_p, or below the lowest threshold that any pair can meet, are pruned in the scan. One shuffle by
    entity for the gate; one by candidate, of pairs that pass, for the owner."""
    out = _passing(scores, s1, params, train_countries, _pruned_at(params, min_p)).where("passes")
    if params.one_owner:
        owner = F.row_number().over(Window.partitionBy("cand_id").orderBy(F.desc("p_final"), "s1_ord"))
        out = out.withColumn("_owner", owner).where("_owner = 1")
    return out.select("s1_id", "cand_id", "p_final", F.lit(True).alias("is_match"))


def _flagged(rows: DataFrame, params: Params) -> DataFrame:
    """rows of _passing() with is_match: a pair that passes and, under one_owner, comes first of those of its candidate."""
    if not params.one_owner:
        return rows.withColumnRenamed("passes", "is_match")
    first = F.row_number().over(Window.partitionBy("cand_id").orderBy(F.desc("passes"), F.desc("p_final"), "s1_ord")) == 1
    return rows.withColumn("is_match", F.col("passes") & first).drop("passes")


def decisions(scores: DataFrame, s1: DataFrame, params: Params, train_countries: list[str] | None = None, min_p: float = MIN_P) -> DataFrame:
    """Every pair that isn't pruned (s1_id, cand_id, p_final, is_match), matched or not."""
    rows = _passing(scores, s1, params, train_countries, _pruned_at(params, min_p))
    return _flagged(rows, params).select("s1_id", "cand_id", "p_final", "is_match")


def decision_stats(decided: DataFrame, scores: DataFrame, s1: DataFrame) -> DataFrame:
    """One row: pairs, matches, entities, entities with a match, and scored pairs of entities that s1 lacks."""
    per = decided.groupBy("s1_id").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_match").alias("m"))
    sums = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_pairs"), F.coalesce(F.sum("m"), F.lit(0)).alias("n_matches"), F.count_if(F.col("m") > 0).alias("n_s1_matched"))
    return sums.crossJoin(s1.agg(F.count(F.lit(1)).alias("n_s1"))).crossJoin(dropped_unknown(scores, s1))  # one row each


def entities_of(scores: DataFrame, s1: DataFrame, params: Params, train_countries: list[str] | None = None) -> DataFrame:
    """What per_entity() gives for scores that hold the truth as label (0 or 1), in one pass over them: nothing is pruned, and truth isn't joined."""
    pairs = _flagged(_passing(scores, s1.select("s1_id", "country", "s1_ord"), params, train_countries, None), params)
    hit = F.col("label") == 1
    sums = pairs.groupBy("s1_id").agg(F.count_if(F.col("is_match") & hit).alias("tp"), F.count_if("is_match").alias("n_pred"), F.count_if(hit).alias("n_true"))
    filled = s1.join(sums, "s1_id", "left").na.fill(0, ["tp", "n_pred", "n_true"])
    return filled.withColumn("f05", f05(F.col("tp"), F.col("n_pred"), F.col("n_true")))


def seen_countries(config: dict, train_s1: DataFrame) -> list[str]:
    """The countries that count as seen in training: those of the config, else those of the training entities (a few values)."""
    listed = config.get("train_countries")
    return sorted(listed) if listed else sorted(r[0] for r in train_s1.select("country").distinct().where("country IS NOT NULL").collect())


def dropped_unknown(scores: DataFrame, s1: DataFrame) -> DataFrame:
    """Number of scored pairs of entities that s1 lacks."""
    return scores.join(s1, "s1_id", "left_anti").agg(F.count(F.lit(1)).alias("n_dropped"))


def per_entity(matches: DataFrame, truth: DataFrame, s1: DataFrame) -> DataFrame:
    """(s1_id, country, tp, n_pred, n_true, f05) of every entity of s1; others' predictions are ignored."""
    hit = matches.select("s1_id", "cand_id").distinct().withColumn("p", F.lit(1))
    real = truth.select("s1_id", "cand_id").distinct().withColumn("t", F.lit(1))
    sums = hit.join(real, ["s1_id", "cand_id"], "full").groupBy("s1_id").agg(F.count(F.col("p") + F.col("t")).alias("tp"), F.count("p").alias("n_pred"), F.count("t").alias("n_true"))
    filled = s1.join(sums, "s1_id", "left").na.fill(0, ["tp", "n_pred", "n_true"])
    return filled.withColumn("f05", f05(F.col("tp"), F.col("n_pred"), F.col("n_true")))


def search_stage_a(scores: DataFrame, truth: DataFrame, s1: DataFrame, grid: list[float] = GRID) -> DataFrame:
    """(tau_gate, tau_pair, f05, n_pairs) of every pair of thresholds.

    Scores are put between grid values once; an entity has one row for each pair threshold it can meet, and gates are
    applied to sums over entities of equal best score: no row is repeated for all the grid's combinations."""
    steps = F.array(*[F.lit(g) for g in grid])
    level = lambda p: F.size(F.filter(steps, lambda g: g <= p))
    n = s1.count()
    real = truth.select("s1_id", "cand_id").distinct().withColumn("t", F.lit(1))
    n_true = real.groupBy("s1_id").agg(F.count(F.lit(1)).alias("n_true"))
    at = scores.join(s1.select("s1_id"), "s1_id", "left_semi").join(real, ["s1_id", "cand_id"], "left").withColumn("k", level(F.col("p_final")))
    per_level = at.where("k > 0").groupBy("s1_id", "k").agg(F.count(F.lit(1)).alias("c"), F.count("t").alias("h"))
    each = per_level.groupBy("s1_id").agg(F.max("k").alias("top"), F.collect_list(F.struct("k", "c", "h")).alias("levels")).join(n_true, "s1_id", "left").na.fill(0, ["n_true"])
    each = each.withColumn("j", F.explode(F.expr("sequence(1, top)")))
    above = F.filter("levels", lambda x: x["k"] >= F.col("j"))
    total = lambda name: F.aggregate(F.transform(above, lambda x: x[name]), F.lit(0).cast("long"), lambda s, v: s + v)
    each = each.withColumns({"tp": total("h"), "m": total("c")}).withColumn("f", f05(F.col("tp"), F.col("m"), F.col("n_true")))
    lone = F.when(F.col("n_true") == 0, 1.0).otherwise(0.0)
    sums = each.groupBy("top", "j").agg(F.sum(F.col("f") - lone).alias("gain"), F.sum("m").alias("m"))
    singles = s1.join(n_true, "s1_id", "left_anti").count()
    gates = F.explode(F.expr("sequence(1, top)")).alias("i")
    cells = sums.select("j", "gain", "m", gates).groupBy("i", "j").agg(F.sum("gain").alias("gain"), F.sum("m").alias("m"))
    all_cells = scores.sparkSession.createDataFrame([(i + 1, j + 1, a, b) for i, a in enumerate(grid) for j, b in enumerate(grid)], "i int, j int, tau_gate double, tau_pair double")
    return all_cells.join(cells, ["i", "j"], "left").select("tau_gate", "tau_pair", ((F.coalesce("gain", F.lit(0.0)) + float(singles)) / float(n)).alias("f05"), F.coalesce("m", F.lit(0)).cast("long").alias("n_pairs"))


def stage_b_grid(best: Params) -> list[tuple]:
    configs = [(a, o, round(best.tau_pair + d2, 3), round(best.tau_pair + d3, 3)) for a in ALPHAS for o in OWNERS for d2 in DELTAS for d3 in DELTAS]
    return [(i, *c) for i, c in enumerate(configs)]


def _settings(best: Params) -> list[tuple]:
    """Alphas and source thresholds of stage B, in the order of stage_b_grid() without the owner."""
    return [(a, round(best.tau_pair + d2, 3), round(best.tau_pair + d3, 3)) for a in ALPHAS for d2 in DELTAS for d3 in DELTAS]


def search_stage_b(scores: DataFrame, truth: DataFrame, s1: DataFrame, best: Params) -> DataFrame:
    """(config_id, alpha, one_owner, tau_s2, tau_s3, f05, n_pairs) around the best of stage A.

    A pair carries a bit for each of the 54 settings that let it through. Its candidate's owner under a setting is the
    first pair with that bit, so one window with a running OR gives the owned bits of all settings at once: pairs are
    shuffled once by entity and once by candidate, and never repeated by setting."""
    spark = scores.sparkSession
    grid = spark.createDataFrame(stage_b_grid(best), "config_id int, alpha double, one_owner boolean, tau_s2 double, tau_s3 double")
    settings, per_alpha = _settings(best), len(DELTAS) ** 2 * 2
    real = truth.select("s1_id", "cand_id").distinct().withColumn("t", F.lit(1))
    kept = scores.where(F.col("p_final") >= best.tau_pair + min(DELTAS) - 1e-9).join(s1, "s1_id").join(real, ["s1_id", "cand_id"], "left")
    kept = kept.withColumn("_max", F.max("p_final").over(Window.partitionBy("s1_id"))).where(F.col("_max") >= best.tau_gate)
    second = F.col("cand_id").startswith("S2-")
    bits = F.lit(0).cast("long")
    for i, (alpha, tau_s2, tau_s3) in enumerate(settings):
        passes = (F.col("p_final") >= F.when(second, tau_s2).otherwise(tau_s3)) & (F.col("p_final") >= alpha * F.col("_max"))
        bits = bits.bitwiseOR(F.when(passes, F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
    before = Window.partitionBy("cand_id").orderBy(F.desc("p_final"), "s1_ord").rowsBetween(Window.unboundedPreceding, -1)
    marked = kept.withColumn("bits", bits).where("bits <> 0")
    owned = F.col("bits").bitwiseAND(F.bitwise_not(F.coalesce(F.bit_or("bits").over(before), F.lit(0).cast("long"))))
    pairs = marked.select("s1_id", "bits", owned.alias("owned"), F.col("t").isNotNull().alias("hit"))
    n_true = real.groupBy("s1_id").agg(F.count(F.lit(1)).alias("n_true"))
    each = pairs.groupBy("s1_id").agg(F.collect_list(F.struct("bits", "owned", "hit")).alias("p")).join(n_true, "s1_id", "left").na.fill(0, ["n_true"])

    def counts(config: Column) -> Column:
        """config_id = (alpha * 2 + owner) * 9 + deltas; a setting's number is alpha * 9 + deltas."""
        half = per_alpha // 2
        place = F.floor(config / per_alpha) * half + config % half
        own = (F.floor(config / half) % 2) == 1
        with_bit = F.filter("p", lambda x: F.getbit(F.when(own, x["owned"]).otherwise(x["bits"]), place.cast("int")) == 1)
        return F.struct(config.cast("int").alias("config_id"), F.size(with_bit).alias("m"), F.size(F.filter(with_bit, lambda x: x["hit"])).alias("tp"))

    cells = each.select("n_true", F.explode(F.transform(F.sequence(F.lit(0), F.lit(2 * len(settings) - 1)), counts)).alias("c")).where("c.m > 0")
    lone = F.when(F.col("n_true") == 0, 1.0).otherwise(0.0)
    sums = cells.groupBy("c.config_id").agg(F.sum(f05(F.col("c.tp"), F.col("c.m"), F.col("n_true")) - lone).alias("gain"), F.sum("c.m").alias("n_pairs"))
    n, singles = s1.count(), s1.join(n_true, "s1_id", "left_anti").count()
    return grid.join(sums, "config_id", "left").select("config_id", "alpha", "one_owner", "tau_s2", "tau_s3", ((F.coalesce("gain", F.lit(0.0)) + float(singles)) / float(n)).alias("f05"), F.coalesce("n_pairs", F.lit(0)).cast("long").alias("n_pairs"))


@dataclass(frozen=True)
class Found:
    """The best parameters, and every setting that was tried (at most 837 rows), best first."""

    params: Params
    f05: float
    tried: list[dict]


def search(scores: DataFrame, truth: DataFrame, s1: DataFrame, min_p: float = MIN_P) -> Found:
    """Stage A, then stage B around its best. Of equal scores the setting that comes first stays: stage A before B, in the order of the grids."""
    tried = []
    for row in search_stage_a(scores, truth, s1).orderBy("tau_gate", "tau_pair").collect():
        tried.append({"stage": "A", "params": Params(tau_gate=row.tau_gate, tau_pair=row.tau_pair), "f05": row.f05, "n_pairs": row.n_pairs})
    best = max(tried, key=lambda t: t["f05"])["params"]  # the first of equals
    check_prunable(Params(tau_gate=best.tau_gate, tau_pair=best.tau_pair + min(DELTAS)), min_p)
    for row in search_stage_b(scores, truth, s1, best).orderBy("config_id").collect():
        params = Params(best.tau_gate, best.tau_pair, row.tau_s2, row.tau_s3, row.alpha, 0.0, row.one_owner)
        tried.append({"stage": "B", "params": params, "f05": row.f05, "n_pairs": row.n_pairs})
    tried.sort(key=lambda t: -t["f05"])
    return Found(tried[0]["params"], tried[0]["f05"], tried)


def evaluate(scores: DataFrame, truth: DataFrame, s1: DataFrame, params: Params, train_countries: list[str] | None = None, min_p: float = MIN_P) -> DataFrame:
    """One row for one setting: f05, precision, recall (means over entities where they are defined), n_pairs, n_s1."""
    check_prunable(params, min_p)
    each = per_entity(decide(scores, s1, params, train_countries, min_p), truth, s1)
    return each.agg(F.avg("f05").alias("f05"), F.avg(precision(F.col("tp"), F.col("n_pred"))).alias("precision"), F.avg(recall(F.col("tp"), F.col("n_true"))).alias("recall"), F.sum("n_pred").alias("n_pairs"), F.count_if(F.col("n_pred") > 0).alias("n_s1"))


def check_prunable(params: Params, min_p: float = MIN_P) -> None:
    """Pruned pairs must be out of reach of every threshold that the parameters can set."""
    reach = min(params.least_threshold(), params.tau_gate + min(0.0, params.delta_unseen))
    if reach + 1e-12 < min_p:
        raise ValueError(f"scores below {min_p} were dropped, but pairs from {reach} on could match: prune lower")


def config_updates(best: Params, min_p: float = MIN_P) -> dict:
    """The keys of the `decide` block to write back; a source threshold that says no more than the common one is null."""
    own = lambda tau: tau if tau is not None and abs(tau - best.tau_pair) >= 1e-9 else None
    return {"tau_gate": best.tau_gate, "tau_pair": best.tau_pair, "tau_s2": own(best.tau_s2), "tau_s3": own(best.tau_s3), "alpha": best.alpha, "one_owner": best.one_owner, "min_p": min_p}


def _as_yaml(value) -> str:
    return json.dumps(value, ensure_ascii=False)


def update_config_text(text: str, updates: dict, train_countries: list[str]) -> str:
    """Set keys of the top-level `decide:` block, and the top-level `train_countries`; keys that the text lacks are added at the end of the block or of the text, every other line stays as it is."""
    lines = text.split("\n")
    top = [i for i, line in enumerate(lines) if line[:1].strip() and not line.startswith("#")] + [len(lines)]
    at = next((i for i in top[:-1] if lines[i].split("#")[0].rstrip() == "decide:"), None)
    if at is None:
        raise ValueError("the config has no block `decide:` at its top level")
    block = [i for i in range(at + 1, next(i for i in top if i > at)) if lines[i].strip()]
    keyed = {lines[i].split(":")[0].strip(): i for i in block if not lines[i].lstrip().startswith("#")}
    indent = next((line[: len(line) - len(line.lstrip())] for line in (lines[i] for i in block)), "  ")
    added = []
    for name, value in updates.items():
        if name in keyed:
            line = lines[keyed[name]]
            said = line[: line.index(" #")] if " #" in line else line
            lines[keyed[name]] = f"{line[: len(line) - len(line.lstrip())]}{name}: {_as_yaml(value)}{line[len(said.rstrip()) :].rstrip()}"
        else:
            added.append(f"{indent}{name}: {_as_yaml(value)}")
    countries = f"train_countries: {_as_yaml(list(train_countries))}"
    own = next((i for i in top[:-1] if lines[i].startswith("train_countries:")), None)
    if own is not None:
        lines[own] = countries
    elif lines[-1] == "":
        lines[-1:] = [countries, ""]
    else:
        lines.append(countries)
    end = (block[-1] if block else at) + 1
    return "\n".join(lines[:end] + added + lines[end:])
