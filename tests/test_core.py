"""Contracts, ids, IO and the metric."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skein.functions import text as T
from skein.functions.ids import format_id_list, parse_id_list
from skein.operators import contracts as C
from skein.operators import decide as D
from skein.operators import reports as R
from skein.sources import tsv


def pairs(spark, rows):
    return spark.createDataFrame(rows, "s1_id string, cand_id string")


def test_id_lists(spark):
    df = spark.createDataFrame([("S3-8,\t S2-4 ,,S3-8",), (" , ",), (None,)], "t string")
    got = [r[0] for r in df.select(parse_id_list(F.col("t"))).collect()]
    assert got == [["S3-8", "S2-4", "S3-8"], [], []]
    assert [r[0] for r in df.select(format_id_list(parse_id_list(F.col("t")))).collect()] == ["S3-8,S2-4", "", ""]


def test_tsv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(f"S1-{i}", f"S2-{i},S3-{i}" if i % 3 else None) for i in range(20)], "source1_entity_id string, matched_entity_ids string")
    tsv.write_id_tsv(df, str(tmp_path / "parts"))
    tsv.write_id_tsv(df, str(tmp_path / "one"), one_file=True)
    assert len(list((tmp_path / "parts").glob("part-*"))) > 1
    part = next((tmp_path / "one").glob("part-*"))
    lines = part.read_bytes().split(b"\n")
    assert lines[0] == b"source1_entity_id\tmatched_entity_ids" and b"S1-3\t" in lines and b"S1-4\tS2-4,S3-4" in lines and len(lines) == 22
    want = {(f"S1-{i}", f"S2-{i},S3-{i}" if i % 3 else "") for i in range(20)}
    for path in (str(part), str(tmp_path / "parts")):
        assert {tuple(r) for r in tsv.read_tsv(spark, path, tsv.TRUTH_COLUMNS).collect()} == want
        assert {tuple(r) for r in tsv.read_id_lines(spark, path, tsv.TRUTH_COLUMNS).collect()} == want
    assert tsv.truth_pairs(tsv.read_tsv(spark, str(part))).count() == 26
    for bad in ("a\tb", 'q"', "x\ny"):
        with pytest.raises(ValueError):
            tsv.write_id_tsv(spark.createDataFrame([(bad, "c")], "x string, y string"), str(tmp_path / "bad"))


def test_source_header_and_literals(spark, tmp_path):
    (tmp_path / "train").mkdir()
    (tmp_path / "train" / "train_source1.tsv").write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t"NULL\t\tX\n')
    row = tsv.read_source(spark, str(tmp_path), "train", 1).first()
    assert tuple(row) == ("S1-1", '"NULL', "", "X", "S1")
    (tmp_path / "train" / "train_source2.tsv").write_text("entity_id\tcountry\n")
    with pytest.raises(ValueError):
        tsv.read_source(spark, str(tmp_path), "train", 2)


def test_contracts(spark):
    cols = ["s1_id", "cand_id", "f_vec_z", "label"]
    assert C.column_problems(cols, "features", "train") == [] and C.column_problems(cols[:2], "features_str", "test") == []
    assert C.column_problems(cols, "features_str", "test") == ["has f_vec_z, label beyond its contract"]
    assert C.column_problems(["cand_id", "odd"], "decisions", "test") == ["lacks is_match, p_final, s1_id", "has odd beyond its contract"]
    assert C.column_problems([*C.CONTRACTS["candidates"].columns, "low_confidence"], "candidates", "test") == []
    df = pairs(spark, [("q", "r"), ("q", "r"), ("q", "r"), ("p", "r")]).withColumn("note", F.lit(1))
    with pytest.raises(ValueError, match="lacks is_match, p_final; has note beyond its contract; repeats 2 rows' keys, as q:r"):
        C.check_artifact(df, "decisions", "train")
    for name, split in (("scores_loco", "test"), ("other", "train"), ("scores", "dev")):
        with pytest.raises(ValueError):
            C.artifact_path("x", name, split)


def test_loading_artifacts(spark, tmp_path):
    folder = str(tmp_path)
    rows = spark.createDataFrame([(f"S1-{i % 6}", f"S2-{i}", i / 20, i / 20, i % 3) for i in range(18)], "s1_id string, cand_id string, p_lgbm double, p_final double, fold int")
    rows.write.parquet(C.artifact_path(folder, "scores", "train"))
    assert C.load_artifact(spark, folder, "scores", "train", ["s1_id", "cand_id"], "p_final >= 0.45D").count() == 9
    own = spark.createDataFrame([("S1-1",), ("S1-4",)], "s1_id string")
    assert {r.s1_id for r in C.load_artifact(spark, folder, "scores", "train", sample=own).collect()} == {"S1-1", "S1-4"}
    rows.drop("fold").write.parquet(folder + "/elsewhere")
    with pytest.raises(ValueError, match="lacks fold"):
        C.load_artifact(spark, folder, "scores", "train", path=folder + "/elsewhere")
    with pytest.raises(FileNotFoundError, match="made by blocking"):
        C.load_artifact(spark, folder, "candidates", "train")
    rows.drop("p_final").write.parquet(C.artifact_path(folder, "decisions", "train"))
    states = {name: state for name, state, _ in C.sweep(spark, folder, "train")}
    assert (states["scores"], states["decisions"], states["candidates"]) == ("ok", "bad", "missing")


def test_samples(spark):
    ids = spark.range(1000).select(F.concat(F.lit("S1-"), F.col("id").cast("string")).alias("s1_id"))
    drawn = [{r[0] for r in C.sampled_ids(df, "s1_id", 0.137).collect()} for df in (ids, ids.orderBy(F.desc("s1_id")).unionByName(ids.limit(9)))]
    assert len(drawn[0]) == 137 and drawn[0] == drawn[1]
    assert C.sampled_ids(ids, "s1_id", 1.0).count() == 1000 and C.sampled_ids(ids, "s1_id", 0.0).count() == 0
    assert 100 < C.hash_sample(ids, "s1_id", 0.2).count() < 300
    records = spark.createDataFrame([("S1-1", "S1"), ("S1-2", "S1"), ("S2-1", "S2"), ("S3-1", "S3")], "entity_id string, source string")
    kept = C.sample_frame(records, "records_norm", ids.where("s1_id = 'S1-2'"), "s1_id")
    assert sorted(r[0] for r in kept.collect()) == ["S1-2", "S2-1", "S3-1"]


def plain_f05(pred, true):
    if not true or not pred:
        return float(not true and not pred)
    hit = len(pred & true)
    p, r = hit / len(pred), hit / len(true)
    return 1.25 * p * r / (0.25 * p + r) if hit else 0.0


def test_metric_against_its_definition(spark):
    rng = random.Random(31)
    pool = [f"S{rng.choice('23')}-{i}" for i in range(12)]
    cases = {f"S1-{i}": (set(rng.sample(pool, rng.randrange(5))), set(rng.sample(pool, rng.randrange(4)))) for i in range(50)}
    s1 = spark.createDataFrame([(k, "AB"[i % 2]) for i, k in enumerate(cases)], "s1_id string, country string")
    pred = pairs(spark, [(k, c) for k, (p, _) in cases.items() for c in p] + [("S1-other", pool[0]), ("S1-0", pool[0])] + [("S1-0", c) for c in cases["S1-0"][0]])
    cases["S1-0"][0].add(pool[0])
    true = pairs(spark, [(k, c) for k, (_, t) in cases.items() for c in t])
    each = D.per_entity(pred, true, s1)
    assert {r.s1_id: r.f05 for r in each.collect()} == {k: pytest.approx(plain_f05(*v)) for k, v in cases.items()}
    whole = {(r["group"], r.value): r for r in R.score_breakdown(each, true).collect()}
    lone = [v for v in cases.values() if not v[1]]
    assert whole["is_singleton", "true"]["count"] == len(lone) == whole["mix", "none"]["count"] == whole["bucket", "0"]["count"]
    assert whole["is_singleton", "true"].recall is None and whole["country", "A"]["count"] == 25


RECORD = "entity_id string, source string, country string, name_raw string, addr_raw string"
RECORDS = [("S1-k", "S1", "FI", "Kiva Oy", "Katu 1"), ("S1-m", "S1", "FI", "Meri|Oy", "Katu 2"), ("S1-t", "S1", "EE", "Tamm", ""), ("S2-4", "S2", "FI", "Kiva", "Katu 1"), ("S2-5", "S2", "FI", "Meri", "x"), ("S3-4", "S3", "EE", "Kiva", "y"), ("S3-6", "S3", None, "Tamme", "z"), ("S3-8", "S3", "EE", "Tamm", "")]
TRUE = [("S1-k", "S2-4"), ("S1-k", "S3-4"), ("S1-t", "S3-6"), ("S1-t", "S3-8")]
PROPOSED = [("S1-k", "S2-5", 0.7), ("S1-k", "S2-4", 0.6), ("S1-t", "S3-8", 0.3), ("S1-t", "S2-5", 0.2), ("S1-t", "S3-6", 0.1), ("S1-none", "S2-4", 0.9), ("S1-t", "S3-6", 0.1)]


def test_blocking_report(spark, tmp_path):
    records = spark.createDataFrame(RECORDS, RECORD)
    found = spark.createDataFrame(PROPOSED, "s1_id string, cand_id string, blend_rank double")
    stats = R.blocking_stats(found, records, pairs(spark, TRUE), (1, 2, 3))
    v = stats["volume"]
    assert (v["n_s1"], v["n_pairs"], v["max"], v["median"], stats["n_pool"]) == (3, 5, 3, 2.0, 5) and v["reduction"] == pytest.approx(1 - 5 / 15) and v["pct_zero"] == pytest.approx(100 / 3)
    whole = next(r for r in stats["recall"] if r["level"] == "all")
    assert [whole[f"recall_{k}"] for k in (1, 2, 3)] == pytest.approx([0.25, 0.5, 0.75]) and whole["n_true"] == 4
    assert stats["coverage"]["pct_fully_covered"] == 50 and stats["true"] == {"n_pairs": 5, "n_hit": 3, "pct_candidates_true": 60.0, "n_missed": 1}
    assert [tuple(r) for r in stats["missed"].collect()] == [("S1-k", "S3-4", "FI", "S3")]
    assert R.recall_gate(stats, 3, 0.75) and not R.recall_gate(stats, 2, 0.75)
    R.write_blocking_report(stats, str(tmp_path))
    assert "missed 1" in (tmp_path / "blocking.md").read_text() and "pct_fully_covered" in (tmp_path / "blocking.json").read_text() and list((tmp_path / "blocking_missed").glob("part-*"))
    bare = R.blocking_stats(found, records)
    assert "recall" not in bare and "# Blocking" in R.blocking_markdown(bare)


def test_errors_with_text(spark):
    records = spark.createDataFrame(RECORDS, RECORD)
    matches = pairs(spark, [("S1-k", "S2-5"), ("S1-k", "S2-4"), ("S1-none", "S2-4")])
    scores = spark.createDataFrame(PROPOSED[:5], "s1_id string, cand_id string, p_final double")
    rows = {(r.s1_id, r.cand_id): r for r in R.errors(matches, pairs(spark, TRUE), 2, scores, records).collect()}
    assert {k: (r.error_type, r.in_candidates) for k, r in rows.items()} == {("S1-k", "S2-5"): ("FP", True), ("S1-t", "S3-8"): ("FN", True), ("S1-t", "S3-6"): ("FN", True)}
    one = rows["S1-k", "S2-5"]
    assert (one.s1_name, one.cand_name, one.cand_addr, one.country) == ("Kiva Oy", "Meri", "x", "FI")
    bare = R.errors(matches, pairs(spark, TRUE), 9).collect()
    assert len(bare) == 5 and all(r.in_candidates is None and r.p_final is None for r in bare)


def test_submission_files(spark, tmp_path):
    s1 = spark.createDataFrame([("S1-a",), ("S1-b",), ("S1-c",)], "s1_id string")
    good, bad = tmp_path / "m.tsv", tmp_path / "bad.tsv"
    good.write_text("source1_entity_id\tmatched_entity_ids\nS1-a\tS2-1\nS1-b\t\nno tab here\nS1-a\tS9-1,S1-b\n")
    (tmp_path / "c.tsv").write_text("source1_entity_id\tcandidate_entity_ids\nS1-a\tS3-1,S3-1\nS1-b\t\nS1-c\t\nS1-d\t\n")
    known = spark.createDataFrame([("S3-1",)], "entity_id string")
    got = {(r.file.split("/")[-1], r.rule): (r.level, r.n, r.examples) for r in R.validate_files(spark, str(good), s1, str(tmp_path / "c.tsv"), known).collect() if r.n}
    assert got == {
        ("m.tsv", "malformed_rows"): ("error", 1, "no tab here"), ("m.tsv", "duplicate_entities"): ("error", 1, "S1-a"), ("m.tsv", "missing_entities"): ("error", 1, "S1-c"),
        ("m.tsv", "self_matches"): ("error", 1, "S1-b"), ("m.tsv", "bad_prefixes"): ("error", 1, "S9-1"), ("m.tsv", "unknown_ids"): ("error", 1, "S2-1"), ("m.tsv", "match_not_candidate"): ("warning", 1, "S1-a"),
        ("c.tsv", "repeated_ids"): ("error", 1, "S1-a"), ("c.tsv", "unknown_entities"): ("error", 1, "S1-d"),
    }
    bad.write_text("source1_entity_id,matched_entity_ids\nS1-a,S2-1\n")
    commas = R.validate_files(spark, str(bad), s1).collect()
    assert {r.rule for r in commas} == {"header", "ids_not_checked"} and "commas" in next(r.examples for r in commas if r.rule == "header")
    assert [r.level for r in R.validate_files(spark, str(tmp_path / "none"), s1, str(tmp_path / "gone"), known).collect()] == ["error", "warning"]


def test_markdown_and_json():
    assert tsv.markdown_table(["k", "v"], [["p|q", 20_500], [None, 0.25], [True, float("nan")]]).splitlines()[2:] == ["| p\\|q | 20,500 |", "|  | 0.2500 |", "| True |  |"]
    assert tsv.to_json({"a": [float("nan"), 1]}).split() == '{ "a": [ null, 1 ] }'.split()


def test_escaped_tsv(spark, tmp_path):
    tsv.write_tsv(spark.createDataFrame([("a\tb\\", 'q"', None)], "x string, y string, z int"), str(tmp_path / "out"))
    lines = {line for part in (tmp_path / "out").glob("part-*") for line in part.read_text().split("\n")}
    assert lines == {"x\ty\tz", 'a\\tb\\\\\tq"\t', ""}


@settings(deadline=None)
@given(st.text(max_size=20))
def test_plain_letters(text):
    """Letters that the JVM maps become what Python makes of them, if no mark or other compatibility form is near."""
    accented, plain, _ = T._fold_tables()
    alone = "".join(c for c in text if c in accented or c.isascii())
    assert alone.translate(str.maketrans(accented, plain)) == T._plain(alone)


def test_folding_in_spark(spark):
    texts = ["Crème brûlée", "ﬁancé №", "हिन्दी", "é ö", "ẞß Ø", None, "", "Ünïcode – 한국", "ｆｕｌｌ"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.fold_accents(F.col("t")).alias("f")).collect()
    assert [r.f for r in got] == [T._plain(r.t) for r in got]
