"""Stages, command lines and the profile on a small dataset of files."""

import random

import pytest

from skein import cli, config
from skein.operators import contracts
from skein.plans import eda
from skein.plans.pipeline import Run
from skein.sources import tsv

NAMES = ["Harbour Bakery", "Nordic Tools", "Blue Lamp Books", "Granite Quarry", "Maple Garage", "Silver Spoon Diner", "Old Mill Press", "Tidal Energy", "Copper Kettle", "Velvet Theatre", "Falcon Couriers", "Willow Clinic"]


@pytest.fixture(scope="module")
def home(tmp_path_factory):
    home = tmp_path_factory.mktemp("home")
    rng = random.Random(5)
    for split, offset in (("train", 0), ("test", 100)):
        (home / "data" / split).mkdir(parents=True)
        rows, truth = {1: [], 2: [], 3: []}, []
        for i in range(48):
            name, town = f"{NAMES[i % 12]} {'abcd'[i // 12] * 3}", 10_000 + i
            country = ["SE", "PE"][i % 2]
            rows[1].append((f"S1-{offset + i}", name, f"{i} Long Street {town}", country))
            own = []
            for n in (2, 3):
                if rng.random() < 0.8:
                    own.append(f"S{n}-{offset + i}")
                    rows[n].append((own[-1], f"{name} {rng.choice(['Ltd', 'Inc', ''])}".strip(), f"{i} Long St {town}", country))
                rows[n].append((f"S{n}-{offset + i + 50}", f"Other {rng.choice(NAMES)} {i}", f"{i} Far Road 2{town % 10000:04d}", country))
            truth.append((f"S1-{offset + i}", ",".join(own)))
        for n, lines in rows.items():
            (home / "data" / split / f"{split}_source{n}.tsv").write_text("\n".join("\t".join(r) for r in [tsv.SOURCE_COLUMNS, *lines]) + "\n")
        if split == "train":
            (home / "data" / split / "train_ground_truth.tsv").write_text("\n".join("\t".join(r) for r in [tsv.TRUTH_COLUMNS, *truth]) + "\n")
    (home / "config.yaml").write_text(f"paths:\n  dataset_dir: {home}/data\n  artifacts_dir: {home}/artifacts\n  output_dir: {home}/output\n  reports_dir: {home}/reports\nmodels:\n  n_folds: 2\ndecide:\n  tau_pair: 0.4\n  one_owner: true\n")
    return home


def test_stages(spark, home, capsys):
    own = config.load(str(home / "config.yaml"))
    run = Run(spark, own, "train")
    run.normalize()
    stats = run.block()
    assert stats["gate"] and next(r for r in stats["recall"] if r["level"] == "all")["recall_40"] == 1.0
    built = run.build()
    assert built.where("label = 1").count() == tsv.truth_pairs(tsv.read_truth(spark, f"{home}/data")).count()
    run.score()
    decided = run.decide()
    assert run.failed == {} and decided.where("is_match").count() == run.stats["n_matches"] > 40 and decided.count() >= run.stats["n_matches"]
    assert [f["rule"] for f in run.findings if f["level"] == "error"] == []
    test = Run(spark, own, "test").all()
    assert test.where("is_match").count() > 40
    assert {s for _, s, _ in contracts.sweep(spark, f"{home}/artifacts", "test")} <= {"ok", "missing"}
    conf = ["--config", str(home / "config.yaml")]
    assert cli.main(["decide", *conf, "--split", "test"]) == 0
    assert cli.main(["check", *conf]) == 0 and "features_str" in capsys.readouterr().out
    assert cli.main(["search", *conf, "--write-config", "--yes"]) == 0
    assert config.load(str(home / "config.yaml"))["train_countries"] == ["PE", "SE"]
    assert cli.main(["report", "blocking", *conf]) == 0 and cli.main(["report", "errors", *conf]) == 0
    assert list((home / "reports" / "train" / "errors").glob("part-*"))
    (home / "m.tsv").write_text("source1_entity_id\tmatched_entity_ids\n" + "".join(f"S1-{100 + i}\tS2-{100 + i}\n" for i in range(48)))
    assert cli.main(["validate", "-m", str(home / "m.tsv"), "-t", str(home / "data")]) == 0
    assert cli.main(["validate", "-m", str(home / "m.tsv"), "-c", str(home / "none.tsv"), "-t", str(home / "data"), "--check-ids"]) == 1
    truth = str(home / "data" / "train" / "train_ground_truth.tsv")
    assert cli.main(["score", "--pred", truth, "--truth", truth, "--s1", str(home / "data" / "train" / "train_source1.tsv"), "--breakdown"]) == 0
    assert "'f05': 1.0" in capsys.readouterr().out
    assert cli.main(["sources", *conf]) == 0
    assert cli.main(["note", "--path", str(home / "log.csv"), "--desc", "first", "--oof", "0.5"]) == 0 and "first" in (home / "log.csv").read_text()


def test_profile(spark, home):
    folder, path = f"{home}/data", str(home / "reports" / "profile.md")
    tables = eda.profile(tsv.scan_all(spark, folder), tsv.read_truth(spark, folder), 0.5, 1, 5, 4)
    eda.write_profile(tables, path)
    text = open(path).read()
    assert all(f"## {title}\n" in text for title in tables) and "| train | S1 | PE | 24 |" in text
    open(path, "w").write(text.replace(f"{eda.BEGIN}\n", f"{eda.BEGIN}\nkeep this\n"))
    eda.write_profile({"Ids": tables["Ids"]}, path)
    assert "keep this" in open(path).read()


def test_loading(spark, home):
    folder = f"{home}/data"
    assert tsv.load_records(spark, folder, f"{home}/nothing", "test").columns[:1] == ["entity_id"]
    assert tsv.load_records(spark, folder, f"{home}/nothing", "test", True).where("source = 'S1'").count() == 48
    assert tsv.load_truth(spark, folder, "test") is None and tsv.read_predictions(spark, f"{folder}/train/train_ground_truth.tsv").count() > 40
    raw = tsv.load_s1(spark, folder, f"{home}/nothing", "train").orderBy("s1_ord").collect()
    assert [r.s1_id for r in raw] == [f"S1-{i}" for i in range(48)]
    assert tsv.scan_all(spark, folder).select("split", "source").distinct().count() == 6
