"""Decision rules and the threshold search, against plain Python."""

import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

from skein.functions import fuzzy
from skein.operators import decide as D


def frames(spark, rows, countries):
    scores = spark.createDataFrame(rows, "s1_id string, cand_id string, p_final double")
    s1 = spark.createDataFrame([(k, c, i) for i, (k, c) in enumerate(countries)], "s1_id string, country string, s1_ord long")
    return scores, s1


def kept(spark, rows, params, countries=None, train=None):
    countries = countries or [(k, "X") for k in sorted({r[0] for r in rows})]
    scores, s1 = frames(spark, rows, countries)
    return {(r.s1_id, r.cand_id) for r in D.decide(scores, s1, params, train).collect()}


def plain(rows, params, countries, train):
    order, country = {k: i for i, (k, _) in enumerate(countries)}, dict(countries)
    off = {k: 0.0 if c in train else params.delta_unseen for k, c in countries}
    top = {}
    for k, _, p in rows:
        top[k] = max(top.get(k, 0), p)
    out = []
    for k, c, p in rows:
        tau = {"S2": params.tau_s2, "S3": params.tau_s3}[c[:2]]
        tau = params.tau_pair if tau is None else tau
        if k in country and top[k] >= params.tau_gate + off[k] and p >= tau + off[k] and p >= params.alpha * top[k]:
            out.append((k, c, p))
    if params.one_owner:
        best = {}
        for k, c, p in out:
            if c not in best or (-p, order[k]) < (-best[c][1], order[best[c][0]]):
                best[c] = (k, p)
        out = [(k, c, p) for k, c, p in out if best[c][0] == k]
    return {(k, c) for k, c, _ in out}


SHOPS = [("S1-oak", "PT"), ("S1-elm", "PT"), ("S1-fir", "KE")]
PAIRS = [("S1-oak", "S2-7", 0.91), ("S1-oak", "S3-7", 0.62), ("S1-elm", "S2-7", 0.91), ("S1-elm", "S2-8", 0.44), ("S1-fir", "S3-7", 0.66), ("S1-fir", "S3-9", 0.28), ("S1-gone", "S2-8", 0.99)]


@pytest.mark.parametrize(
    ("params", "want"),
    [
        (D.Params(tau_gate=0.7, tau_pair=0.4), {"oak S2-7", "oak S3-7", "elm S2-7", "elm S2-8"}),  # fir's best is under the gate
        (D.Params(tau_gate=0.3, tau_pair=0.65), {"oak S2-7", "elm S2-7", "fir S3-7"}),
        (D.Params(tau_gate=0.3, tau_pair=0.95, tau_s3=0.6), {"oak S3-7", "fir S3-7"}),  # a source of its own threshold
        (D.Params(tau_gate=0.3, tau_pair=0.4, alpha=0.7), {"oak S2-7", "elm S2-7", "fir S3-7"}),
        (D.Params(tau_gate=0.3, tau_pair=0.6, one_owner=True), {"oak S2-7", "fir S3-7"}),  # equal scores: the earlier entity
        (D.Params(tau_gate=0.7, tau_pair=0.6, one_owner=True), {"oak S2-7", "oak S3-7"}),  # an owner must pass itself
        (D.Params(tau_gate=0.3, tau_pair=0.64, delta_unseen=0.05), {"oak S2-7", "elm S2-7"}),  # KE is unseen
        (D.Params(tau_gate=0.3, tau_pair=0.64, delta_unseen=-0.4), {"oak S2-7", "elm S2-7", "fir S3-7", "fir S3-9"}),
    ],
)
def test_rules(spark, params, want):
    scores, s1 = frames(spark, PAIRS, SHOPS)
    flagged = {(r.s1_id, r.cand_id): r.is_match for r in D.decisions(scores, s1, params, ["PT"]).collect()}
    assert {f"{s[3:]} {c}" for (s, c), m in flagged.items() if m} == want
    assert {(r.s1_id, r.cand_id) for r in D.decide(scores, s1, params, ["PT"]).collect()} == {k for k, m in flagged.items() if m}
    least = min(0.2, params.least_threshold())
    assert set(flagged) == {(s, c) for s, c, p in PAIRS if p >= least and s != "S1-gone"}


def test_stats_and_empty_input(spark):
    scores, s1 = frames(spark, PAIRS, SHOPS)
    out = D.decisions(scores, s1, D.Params(tau_gate=0.7))
    assert D.decision_stats(out, scores, s1).first().asDict() == {"n_pairs": 6, "n_matches": 3, "n_s1_matched": 2, "n_s1": 3, "n_dropped": 1}
    none = D.decisions(scores.limit(0), s1, D.Params(one_owner=True))
    assert none.count() == 0 and D.decision_stats(none, scores.limit(0), s1).first().n_pairs == 0


def test_pruning_changes_nothing(spark):
    rng = random.Random(21)
    rows = [(f"S1-{i}", f"S{2 + j % 2}-{rng.randrange(40)}{j}", round(rng.random(), 3)) for i in range(80) for j in range(4)]
    params = D.Params(0.5, 0.45, None, 0.35, 0.6, 0.1, True)
    found = [kept_at(spark, rows, params, p) for p in (0.0, 0.1, 0.3, 0.35, 0.8)]
    assert found[0] and all(f == found[0] for f in found)


def kept_at(spark, rows, params, min_p):
    scores, s1 = frames(spark, rows, [(f"S1-{i}", "XY"[i % 2]) for i in range(80)])
    return {(r.s1_id, r.cand_id) for r in D.decide(scores, s1, params, ["X"], min_p).collect()}


@pytest.mark.parametrize("seed", range(3))
def test_against_plain_python(spark, seed):
    rng = random.Random(seed)
    countries = [(f"S1-{i}", rng.choice("XYZ")) for i in range(60)]
    rows = list({(f"S1-{rng.randrange(60)}", f"S{rng.choice('23')}-{rng.randrange(50)}"): None for _ in range(300)})
    rows = [(*r, round(rng.uniform(0.2, 1), 2)) for r in rows]
    params = D.Params(0.55, 0.4, rng.choice([None, 0.5]), None, rng.choice([0.0, 0.8]), rng.choice([-0.1, 0.1]), rng.random() < 0.7)
    assert kept(spark, rows, params, countries, ["X", "Y"]) == plain(rows, params, countries, ["X", "Y"])


def test_search_agrees_with_the_metric(spark):
    rng = random.Random(7)
    countries = [(f"S1-{i}", "X") for i in range(40)]
    rows = [(f"S1-{i}", f"S2-{i}{j}", round(rng.uniform(0.2, 1), 3)) for i in range(36) for j in range(3)]
    truth = [(s, c) for s, c, p in rows if rng.random() < p * 0.6] + [("S1-39", "S2-x")]
    scores, s1 = frames(spark, rows, countries)
    true = spark.createDataFrame(truth, "s1_id string, cand_id string")
    found = {(r.tau_gate, r.tau_pair): (r.f05, r.n_pairs) for r in D.search_stage_a(scores, true, s1).collect()}
    assert len(found) == 729
    for gate, pair in ((0.3, 0.3), (0.6, 0.45), (0.95, 0.5)):
        picked = D.decide(scores, s1, D.Params(tau_gate=gate, tau_pair=pair))
        each = D.per_entity(picked, true, s1).collect()
        assert found[gate, pair] == (pytest.approx(sum(r.f05 for r in each) / 40), picked.count())


def test_search_and_selection(spark):
    rng = random.Random(17)
    rows = [(f"S1-{i}", f"S{2 + j % 2}-{(i * 3 + j * 7) % 50}", round(rng.uniform(0.3, 1), 3)) for i in range(30) for j in range(3)]
    truth = [(s, c) for s, c, p in rows if rng.random() < p * 0.7]
    scores, s1 = frames(spark, rows, [(f"S1-{i}", "X") for i in range(33)])
    true = spark.createDataFrame(truth, "s1_id string, cand_id string")
    found = D.search(scores, true, s1)
    assert len(found.tried) == 837 and found.f05 == max(t["f05"] for t in found.tried)
    assert [t["f05"] for t in found.tried] == sorted((t["f05"] for t in found.tried), reverse=True)
    for t in [found.tried[0], *rng.sample([t for t in found.tried if t["stage"] == "B"], 6)]:
        one = D.evaluate(scores, true, s1, t["params"]).first()
        assert (t["f05"], t["n_pairs"]) == (pytest.approx(one.f05), one.n_pairs)
    marked = scores.join(true.withColumn("label", D.F.lit(1)), ["s1_id", "cand_id"], "left").na.fill(0, ["label"])
    own = {r.s1_id: (r.tp, r.n_pred, r.n_true) for r in D.entities_of(marked, s1, found.params).collect()}
    assert own == {r.s1_id: (r.tp, r.n_pred, r.n_true) for r in D.per_entity(D.decide(scores, s1, found.params), true, s1).collect()}


def test_prunable():
    D.check_prunable(D.Params(tau_gate=0.3, tau_pair=0.2))
    for params in (D.Params(tau_pair=0.1), D.Params(tau_gate=0.15), D.Params(tau_pair=0.25, delta_unseen=-0.1)):
        with pytest.raises(ValueError):
            D.check_prunable(params)


def test_params_and_countries(spark):
    assert D.Params.of({"tau_gate": 0.4, "alpha": None, "unknown": 3, "tau_s2": None}) == D.Params(tau_gate=0.4)
    s1 = spark.createDataFrame([("a", "NO"), ("b", "CL"), ("c", None)], "s1_id string, country string")
    assert D.seen_countries({"train_countries": []}, s1) == ["CL", "NO"] and D.seen_countries({"train_countries": ["Z", "A"]}, s1) == ["A", "Z"]


def test_config_text():
    updates = D.config_updates(D.Params(tau_gate=0.7, tau_pair=0.45, tau_s2=0.45 + 1e-12, tau_s3=0.4), 0.15)
    assert updates["tau_s2"] is None and updates["tau_s3"] == 0.4 and updates["min_p"] == 0.15
    text = "x:\n  tau_gate: 9\ndecide:  # rules\n    tau_gate: 0.1   # gate\n    # tau_pair: no\n\nlast: 1"
    out = D.update_config_text(text, updates, ["B"]).split("\n")
    assert out[:4] == ["x:", "  tau_gate: 9", "decide:  # rules", "    tau_gate: 0.7   # gate"] and out[4] == "    # tau_pair: no"
    assert "    tau_pair: 0.45" in out and "    min_p: 0.15" in out and out[-2:] == ["last: 1", 'train_countries: ["B"]']
    assert D.update_config_text("decide:\ntrain_countries: []\n", {"alpha": 0.5}, []) == "decide:\n  alpha: 0.5\ntrain_countries: []\n"
    with pytest.raises(ValueError):
        D.update_config_text("other: 1\n", updates, [])


@given(st.text("ab c", max_size=12), st.text("ab c", max_size=12))
def test_common_subsequence(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert fuzzy._common(a, b) == table[-1][-1]
    assert fuzzy.token_set(a, b) == fuzzy.token_set(b, a)


def test_ratios():
    assert fuzzy.token_set("Acme Corp", "corp acme ltd") == 100.0
    assert fuzzy.token_sort("b a", "a b") == 100.0
    assert fuzzy.token_set("", "x") == 0.0
