"""Stages from raw records to decisions; each is one lazy plan, written at its end and checked against its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import load
from ..operators import blocking, contracts, features, normalize, reports, scoring
from ..operators.decide import Params, decision_stats, decisions, seen_countries
from ..sources import tsv
from ..sources.store import stored_models

BLOCKERS = ("b1", "b2", "b3", "b4")


def candidates_of(records: DataFrame, cap: int = 40, sizes: dict | None = None, enabled: tuple[str, ...] = BLOCKERS, encode: Callable | None = None, vectors: DataFrame | None = None) -> DataFrame:
    """Union of the enabled blockers over normalized records. b5 needs vectors (entity_id, source, country, vector) or an encoder of texts. A blocker that fails fails the run."""
    k = {"b1": 20, "b2": 15, "b3": 20, "b4": 10, "b5": 25} | (sizes or {})
    made = {
        "b1": lambda: blocking.block_tfidf(records, "name_core", k["b1"], "rank_b1", "sim_b1"),
        "b2": lambda: blocking.block_tfidf(records, "addr_norm", k["b2"], "rank_b2", "sim_b2"),
        "b3": lambda: blocking.block_rare_tokens(records, "name_core", k["b3"]),
        "b4": lambda: blocking.block_numeric(records, k["b4"]),
        "b5": lambda: blocking.block_dense(vectors, k["b5"]) if vectors is not None else blocking.block_texts(records, encode, k["b5"]),
    }
    wanted = [*enabled, *(["b5"] if "b5" not in enabled and (encode or vectors is not None) else [])]
    return blocking.union_blockers({name: made[name]() for name in wanted}, cap)


class Run:
    """The stages of one split; each reads what the stages before it wrote."""

    def __init__(self, spark: SparkSession, config: dict | None = None, split: str = "train", encode: Callable | None = None, slice_only: bool = False) -> None:
        self.spark, self.config, self.split, self.encode, self.slice_only = spark, config or load(), split, encode, slice_only
        self.paths = self.config["paths"]

    def _path(self, name: str, split: str | None = None) -> str:
        return contracts.artifact_path(self.paths["artifacts_dir"], name, split or self.split)

    def _save(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self._path(name))
        out = self.spark.read.parquet(self._path(name))
        contracts.check_artifact(out, name, self.split)
        return out

    def _load(self, name: str) -> DataFrame:
        return contracts.load_artifact(self.spark, self.paths["artifacts_dir"], name, self.split)

    def truth(self) -> DataFrame | None:
        found = tsv.load_truth(self.spark, self.paths["dataset_dir"], self.split)
        return None if found is None else tsv.truth_pairs(found)

    def s1(self, split: str | None = None) -> DataFrame:
        return tsv.load_s1(self.spark, self.paths["dataset_dir"], self._path("records_norm", split), split or self.split)

    def normalize(self) -> DataFrame:
        raw = tsv.read_all_sources(self.spark, self.paths["dataset_dir"], self.split)
        return self._save(normalize.normalize(tsv.small_slice(raw) if self.slice_only else raw), "records_norm")

    def block(self) -> dict:
        """Candidates, their lists and, where there is truth, the report; tells whether the recall gate is met."""
        own, records = self.config["blocking"], self._load("records_norm")
        found = self._save(candidates_of(records, own["cap"], {k: v for k, v in own.items() if k.startswith("b")}, encode=self.encode), "candidates")
        s1 = records.where("source = 'S1'").select("entity_id")
        tsv.write_id_tsv(tsv.candidate_lists(s1, found.withColumn("_order", -F.col("blend_rank")), "_order"), f"{self.paths['output_dir']}/candidate_pairs_{self.split}")
        truth, ks = self.truth(), tuple(sorted({1, 5, 10, 20, own["gate_k"]}))
        stats = reports.blocking_stats(found, records, truth, ks)
        reports.write_blocking_report(stats, f"{self.paths['reports_dir']}/{self.split}")
        return stats | {"gate": truth is None or reports.recall_gate(stats, own["gate_k"], own["gate_recall"])}

    def build(self, strings: DataFrame | None = None) -> DataFrame:
        truth = self.truth() if self.split == "train" else None
        return self._save(features.build_features(self._load("candidates"), self._load("records_norm"), truth, strings=strings), "features")

    def score(self) -> DataFrame:
        """Train: out-of-fold scores, stored models, and scores by country left out; test: the mean of the stored models."""
        built, own, models = self._load("features"), self.config["models"], f"{self.paths['artifacts_dir']}/models"
        if self.split != "train":
            return self._save(scoring.predict(built, [GBTClassificationModel.load(p) for p in stored_models(self.spark, models)]), "scores")
        scores, fitted = scoring.train_oof(built, own["n_folds"], tuple(own["seeds"]))
        for i, model in enumerate(fitted):
            model.write().overwrite().save(f"{models}/fold{i // len(own['seeds'])}_seed{own['seeds'][i % len(own['seeds'])]}")
        loco, self.failed = scoring.loco_of(built, self.s1())
        if loco is not None:
            self._save(loco, "scores_loco")
        return self._save(scores, "scores")

    def decide(self) -> DataFrame:
        """Every pair with its flag; matches as lists; the lists are validated. stats holds counts, findings the problems."""
        scores, s1, params = self._load("scores"), self.s1(), Params.of(self.config["decide"])
        out = self._save(decisions(scores, s1, params, seen_countries(self.config, self.s1("train")), self.config["decide"]["min_p"]), "decisions")
        self.stats = decision_stats(out, scores, s1).first().asDict()
        ids, folder = s1.select(F.col("s1_id").alias("entity_id")), self.paths["output_dir"]
        lists = tsv.candidate_lists(ids, out.where("is_match")).withColumnRenamed("candidate_entity_ids", "matched_entity_ids")
        tsv.write_id_tsv(lists, f"{folder}/matching_results_{self.split}")
        self.findings = [r.asDict() for r in reports.validate_files(self.spark, f"{folder}/matching_results_{self.split}", s1.select("s1_id"), f"{folder}/candidate_pairs_{self.split}").where("n > 0").collect()]
        return out

    def all(self) -> DataFrame:
        self.normalize()
        self.block()
        self.build()
        self.score()
        return self.decide()
