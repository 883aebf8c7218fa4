"""Command lines: python -m skein.cli COMMAND ..."""

from __future__ import annotations

import argparse
import difflib
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import config as C
from .operators import contracts, reports, scoring
from .operators import decide as D
from .plans import eda
from .plans.pipeline import Run
from .sources import tsv
from .sources.store import log_experiment


def _spark() -> SparkSession:
    return SparkSession.builder.appName("skein").getOrCreate()


def _sample(run: Run, wanted: bool):
    own = run.config["sample"]
    return contracts.sampled_ids(run.s1(), "s1_id", own["frac"], own["seed"]) if wanted else None


def _inputs(run: Run, args):
    """Scores that can matter, and the entities, of all or of the sample."""
    params, sample = D.Params.of(run.config["decide"]), _sample(run, args.sample)
    min_p = min(run.config["decide"]["min_p"], params.least_threshold())
    scores = contracts.load_artifact(run.spark, run.paths["artifacts_dir"], "scores", run.split, ["s1_id", "cand_id", "p_final"], f"p_final >= {min_p}D", args.scores, sample)
    s1 = run.s1() if sample is None else run.s1().join(sample, "s1_id", "left_semi")
    return params, min_p, scores, s1


def run(args) -> int:
    own = Run(_spark(), C.load(args.config), args.split, slice_only=args.slice)
    stages = {"0": own.normalize, "1": own.block, "2": own.build, "3": own.score, "4": own.decide, "all": own.all}
    found = stages[args.stage]()
    if args.stage == "1" and not found["gate"]:
        print("the recall gate is not met: propose more candidates")
    return 0


def decide(args) -> int:
    own = Run(_spark(), C.load(args.config), args.split)
    params, min_p, scores, s1 = _inputs(own, args)
    seen = D.seen_countries(own.config, own.s1("train"))
    out = D.decisions(scores, s1, params, seen, min_p)
    path = contracts.artifact_path(own.paths["artifacts_dir"], "decisions", args.split)
    out.write.mode("overwrite").parquet(path)
    print(params, D.decision_stats(own.spark.read.parquet(path), scores, s1).first().asDict())
    return 0


def search(args) -> int:
    own = Run(_spark(), C.load(args.config), "train")
    _, min_p, scores, s1 = _inputs(own, args)
    truth = own.truth().join(s1.select("s1_id"), "s1_id", "left_semi")
    found = D.search(scores, truth, s1, min_p)
    plain = D.evaluate(scores, truth, s1, D.Params(), min_p=min_p).first()
    best = D.evaluate(scores, truth, s1, found.params, min_p=min_p).first()
    for row in found.tried[:10]:
        print(row)
    print(f"best {found.params}: {best.asDict()}; both thresholds at a half: {plain.asDict()}")
    if args.write_config and args.config:
        with open(args.config, encoding="utf-8") as text:
            old = text.read()
        new = D.update_config_text(old, D.config_updates(found.params, min_p), D.seen_countries(own.config, own.s1("train")))
        print("".join(difflib.unified_diff(old.splitlines(True), new.splitlines(True), args.config, args.config)) or "nothing to change")
        if args.yes:
            with open(args.config, "w", encoding="utf-8") as out:
                out.write(new)
    return 0


def score(args) -> int:
    spark = _spark()
    s1 = tsv.read_tsv(spark, args.s1, tsv.SOURCE_COLUMNS).select(F.col("entity_id").alias("s1_id"), "country").dropDuplicates(["s1_id"])
    pred, truth = (tsv.read_predictions(spark, p) for p in (args.pred, args.truth))
    each = D.per_entity(pred, truth, s1)
    print(each.agg(F.count(F.lit(1)).alias("n"), F.avg("f05").alias("f05")).first().asDict())
    if args.breakdown:
        rows = reports.score_breakdown(each, truth).orderBy("group", "value").collect()
        print(tsv.markdown_table(["group", "value", "count", "f05", "precision", "recall"], [list(r) for r in rows]))
    return 0


def report(args) -> int:
    own = Run(_spark(), C.load(args.config), args.split)
    sample, records = _sample(own, args.sample), own._load("records_norm")
    records = records if sample is None else contracts.sample_frame(records, "records_norm", sample, "s1_id")
    truth = own.truth()
    if args.what == "blocking":
        stats = reports.blocking_stats(own._load("candidates"), records, truth)
        reports.write_blocking_report(stats, f"{own.paths['reports_dir']}/{args.split}")
        print(reports.blocking_markdown(stats))
        return 0
    found = reports.errors(own._load("decisions").where("is_match"), truth, args.n, own._load("scores"), records)
    tsv.write_tsv(found, f"{own.paths['reports_dir']}/{args.split}/errors")
    return 0


def profile(args) -> int:
    own = C.load(args.config)
    spark, folder = _spark(), own["paths"]["dataset_dir"]
    tables = eda.profile(tsv.scan_all(spark, folder), tsv.read_truth(spark, folder), args.frac, args.seed, args.k)
    eda.write_profile(tables, f"{own['paths']['reports_dir']}/profile.md")
    return 0


def check(args) -> int:
    found = contracts.sweep(_spark(), C.load(args.config)["paths"]["artifacts_dir"], args.split)
    for name, state, what in found:
        print(f"{state:8}{name:14}{what}")
    return int(any(state == "bad" for _, state, _ in found))


def sources(args) -> int:
    spark, folder = _spark(), C.load(args.config)["paths"]["dataset_dir"]
    for split in args.splits:
        for r in tsv.read_all_sources(spark, folder, split).groupBy("source").count().orderBy("source").collect():
            print(split, r["source"], r["count"])
    return 0


def validate(args) -> int:
    spark = _spark()
    s1 = tsv.read_source(spark, args.dataset, "test", 1).select(F.col("entity_id").alias("s1_id"))
    known = tsv.read_source(spark, args.dataset, "test", 2).unionByName(tsv.read_source(spark, args.dataset, "test", 3)).select("entity_id") if args.check_ids else None
    found = [r for r in reports.validate_files(spark, args.matching, s1, args.candidates, known).collect() if r.n]
    for r in found:
        print(f"{r.level}: {r.file}: {r.rule} {r.n:,} {r.examples}")
    return int(any(r.level == "error" for r in found))


def synthetic(args) -> int:
    own = Run(_spark(), C.load(args.config), "train")
    rows = contracts.load_artifact(own.spark, own.paths["artifacts_dir"], "features_str", "train", sample=_sample(own, args.sample))
    out = scoring.synthetic_scores(rows, "f_str_name_tset", "f_str_addr_tset").withColumn("p_lgbm", F.col("p_final"))
    out.write.mode("overwrite").parquet(f"{own.paths['artifacts_dir']}/scores_synthetic.parquet")
    return 0


def note(args) -> int:
    log_experiment(args.path, args.desc, args.oof, args.loco, args.lb)
    return 0


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="skein", description="Record linkage on Spark")
    commands = top.add_subparsers(required=True)

    def command(f, *options: tuple) -> None:
        sub = commands.add_parser(f.__name__, help=f.__doc__)
        for names, kind in options:
            sub.add_argument(*([names] if isinstance(names, str) else names), **kind)
        sub.set_defaults(call=f)

    conf = ("--config", {"default": None})
    split = ("--split", {"choices": ["train", "test"], "default": "train"})
    sample = ("--sample", {"action": "store_true"})
    stored = ("--scores", {"default": None})
    command(run, conf, split, ("--stage", {"choices": ["all", "0", "1", "2", "3", "4"], "default": "all"}), ("--slice", {"action": "store_true"}))
    command(decide, conf, split, sample, stored)
    command(search, conf, sample, stored, ("--write-config", {"action": "store_true"}), ("--yes", {"action": "store_true"}))
    command(score, ("--pred", {"required": True}), ("--truth", {"required": True}), ("--s1", {"required": True}), ("--breakdown", {"action": "store_true"}))
    command(report, ("what", {"choices": ["blocking", "errors"]}), conf, split, sample, ("--n", {"type": int, "default": 50}))
    command(profile, conf, ("--frac", {"type": float, "default": 0.2}), ("--seed", {"type": int, "default": 42}), ("--k", {"type": int, "default": 40}))
    command(check, conf, split)
    command(sources, conf, ("--splits", {"nargs": "+", "default": ["train", "test"]}))
    command(validate, (["-m", "--matching"], {"required": True}), (["-c", "--candidates"], {"default": None}), (["-t", "--dataset"], {"required": True}), ("--check-ids", {"action": "store_true"}))
    command(synthetic, conf, sample)
    command(note, ("--path", {"default": "reports/experiments.csv"}), ("--desc", {"required": True}), *((f"--{n}", {"type": float, "default": None}) for n in ("oof", "loco", "lb")))
    return top


def main(words: list[str] | None = None) -> int:
    args = parser().parse_args(words)
    return args.call(args)


if __name__ == "__main__":
    sys.exit(main())
