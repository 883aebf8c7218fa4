"""Many records of few texts: work and tables follow the distinct texts, not the pairs of records."""

import pytest
from pyspark.sql import functions as F

from skein.functions import vectors
from skein.operators import blocking, features


@pytest.fixture
def copies(spark):
    """600 records of six texts in two countries, the texts' words partly shared and repeated; one record has no text."""
    names = ["red bolt bolt", "red nut", "blue bolt", "ñandú 9 9", "x", "red  bolt"]
    rows = [(f"S{i % 3 + 1}-{i}", f"S{i % 3 + 1}", "A" if i % 4 else "B", names[i * i % 6], f"{names[i % 5]} {i % 7}") for i in range(600)]
    return spark.createDataFrame([*rows, ("S2-900", "S2", "A", None, ""), ("S3-900", "S3", None, "red nut", "x")], "entity_id string, source string, country string, name_core string, addr_norm string")


def grams(text):
    return [p[i : i + n] for w in (text or "").lower().split() for p in [f" {w} "] for n in (2, 3, 4) if len(p) >= n for i in range(max(len(p) - n + 1, 1))]


def cosines_of(rows, column):
    """(country, text, country, text) to the cosine, by definition."""
    import math
    from collections import Counter

    weights = {}
    for country in {r.country for r in rows} - {None}:
        own = [r for r in rows if r.country == country]
        df = Counter(g for r in own for g in set(grams(r[column])))
        for r in own:
            w = {g: c * (math.log((1 + len(own)) / (1 + df[g])) + 1) for g, c in Counter(grams(r[column])).items()}
            norm = math.sqrt(sum(v * v for v in w.values()))
            weights[r.entity_id] = {g: v / norm for g, v in w.items()}
    return lambda a, b: sum(v * weights.get(b, {}).get(g, 0) for g, v in weights.get(a, {}).items())


@pytest.mark.parametrize("column", ["addr_norm", "name_core"])
def test_tfidf_blocks_write_no_pairs(spark, copies, monkeypatch, column):
    """no table holds the pairs of records; neighbours are those of all pairs, also if blocks are small."""
    rows, written = copies.collect(), []

    def counted(df, session, f=blocking.materialize):
        written.append((out := f(df, session)).count())
        return out

    monkeypatch.setattr(blocking, "materialize", counted)
    monkeypatch.setattr(blocking, "DENSE_ROWS", 2, raising=False)
    got = {(r.s1_id, r.cand_id, r.n): r.sim for r in blocking.block_tfidf(copies, column, 4, "n", "sim").collect()}
    cosine, want = cosines_of(rows, column), {}
    for a in (r for r in rows if r.source == "S1"):
        near = sorted((-round(cosine(a.entity_id, b.entity_id), 6), b.entity_id) for b in rows if b.source != "S1" and b.country == a.country and a.country)
        want |= {(a.entity_id, i, n): -sim for n, (sim, i) in enumerate(near[:4], 1) if sim <= -1e-4}
    assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 2e-6 for p in want)
    assert max(written) <= 4 * len(rows)


def test_word_products_in_halves(monkeypatch):
    """Frequent n-grams as dense columns, and blocks halved for their size, change no product."""
    import numpy as np

    rng = np.random.default_rng(3)
    dense = [rng.random((r, 40)) * (rng.random((r, 40)) < 0.3) for r in (15, 12)]
    sparse = [vectors.Rows(np.concatenate([[0], np.cumsum((m > 0).sum(1))]), np.nonzero(m)[1], m[m > 0]) for m in dense]
    for frequent in (0, 3, 100):
        assert np.allclose(vectors.products(*sparse, 40, frequent), dense[0] @ dense[1].T)


def test_vector_features_of_copies(spark, copies, monkeypatch):
    """no step makes a row for each pair and n-gram; pairs over countries and without text count too."""
    monkeypatch.setattr(features, "PAIRS", 50, raising=False)
    pairs = copies.where("source = 'S1'").select(F.col("entity_id").alias("s1_id")).crossJoin(copies.where("source <> 'S1' AND pmod(hash(entity_id), 9) = 0 OR entity_id LIKE '%-900'").select(F.col("entity_id").alias("cand_id")))
    found = features.vector_features(pairs, copies)
    rows = copies.collect()
    name, addr = cosines_of(rows, "name_core"), cosines_of(rows, "addr_norm")
    got = found.collect()
    assert len(got) == pairs.count() > 1000
    assert all(abs(r.f_vec_name_tfidf - name(r.s1_id, r.cand_id)) < 1e-9 and abs(r.f_vec_addr_tfidf - addr(r.s1_id, r.cand_id)) < 1e-9 for r in got)
    assert "FlatMapCoGroupsInArrow" in found._jdf.queryExecution().executedPlan().toString()  # before: a join on n-grams


def test_candidates_true_blocks_once(spark, monkeypatch):
    """the candidates are made once for both of its counts."""
    from skein.plans import catalog

    calls, f = [], blocking.block_tfidf
    monkeypatch.setattr(catalog.B, "block_tfidf", lambda *a, **b: calls.append(1) or f(*a, **b))
    catalog.QUERIES["candidates_true"](spark, "/root/testdata/sf0.001").collect()
    assert len(calls) == 1


def test_shared_keys_shuffle_no_pairs(spark, monkeypatch):
    """F4, F5, F8, F9, F13 to F16: what is shuffled grows with the keys of records, not with the pairs that share them; the best are those of all pairs, also if blocks are small."""
    import math
    from collections import Counter

    rows = [(f"S{i % 3 + 1}-{i}", f"S{i % 3 + 1}", "AB"[i % 5 == 0] if i % 50 else "T", f"{100 + i % 7} {100 + i % 7} 5{i % 11:02d} {i % 4}", f"1{i % 9}") for i in range(300)]
    rows += [("S2-901", "S2", None, "100 101", "10"), ("S1-902", "S1", None, "100 101", "10"), ("S2-903", "S2", "A", None, None), ("S2-é", "S2", "A", "100 505", "11"), ("S2-1", "S2", "A", "101 501", "11")]
    frame = spark.createDataFrame(rows, "entity_id string, source string, country string, digits string, postal string")
    monkeypatch.setattr(blocking, "SHARED_KEYS", 16, raising=False)
    keys = lambda r: {f"d_{d}" for d in (r.digits or "").split() if len(d) >= 3} | ({f"p_{r.postal}"} if r.postal else set())
    tokens = lambda r: set((r.digits or "").split())
    records, sizes = frame.collect(), Counter(r.country for r in frame.collect())
    s1, cand = [r for r in records if r.source == "S1"], [r for r in records if r.source != "S1"]

    def best(scores, k):
        return {(a, b, n): round(s, 6) for a, own in scores.items() for n, (b, s) in enumerate(sorted(own.items(), key=lambda x: (-round(x[1], 6), x[0].encode()))[:k], 1)}

    df, tf = Counter((r.country, x) for r in cand for x in keys(r) if r.country), Counter(x for r in cand for x in keys(r))
    shared, idf = {}, {}
    for a in s1:
        tiny = sizes[a.country] < 20 and a.country
        for b in cand:
            n = sum((tf[x] if tiny else df[a.country, x]) <= 30 for x in keys(a) & keys(b)) if tiny or (a.country and a.country == b.country) else 0
            if n:
                own = shared.setdefault(a.entity_id, Counter())
                own[b.entity_id] += n
    got = blocking.block_numeric(frame, 4, 30, 20)
    assert {(r.s1_id, r.cand_id, r.rank_b4): r.shared for r in got.collect()} == best(shared, 4)
    all_df = Counter((r.country, x) for r in records for x in tokens(r))
    for a in s1:
        for b in cand:
            ws = [math.log(sizes[a.country] / all_df[a.country, x]) for x in tokens(a) & tokens(b) if all_df[a.country, x] <= 40] if a.country and a.country == b.country else []
            if ws:
                own = idf.setdefault(a.entity_id, Counter())
                own[b.entity_id] += sum(ws)
    rare = blocking.block_rare_tokens(frame, "digits", 5, 40)
    found, want = {(r.s1_id, r.cand_id, r.rank_b3): r.sim_b3 for r in rare.collect()}, best(idf, 5)
    assert found.keys() == want.keys() and all(abs(found[p] - want[p]) < 2e-6 for p in want)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan(got) + plan(rare) and "Exchange" not in plan(got) + plan(rare)
    assert plan(blocking.union_blockers({"b3": rare, "b4": got})).count("Exchange hashpartitioning") == 1


def test_token_ratios_compare_the_rest(monkeypatch):
    """words that both texts share are not compared letter by letter, nor are equal pairs of a batch twice; ratios are those of the definition."""
    import random

    import pandas as pd

    from skein.functions import fuzzy

    def common(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
        return row[-1]

    ratio = lambda a, b: 200.0 * common(a, b) / (len(a) + len(b)) if a or b else 100.0
    words = lambda t: fuzzy.processed(t).split()

    def by_definition(a, b):
        x, y = set(words(a)), set(words(b))
        if not x or not y:
            return 0.0
        both, only_x, only_y = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
        if both and (not only_x or not only_y):
            return 100.0
        p, q = f"{both} {only_x}".strip(), f"{both} {only_y}".strip()
        return max(ratio(p, q), *((ratio(both, p), ratio(both, q)) if both else (0.0,)))

    rng = random.Random(1)
    texts = [" ".join(rng.choice(["ab", "abc", "b_c", "Éa", "10123", "10987", "x", "-"]) for _ in range(rng.randrange(6))) for _ in range(60)] + [None, ""]
    a, b = pd.Series([x for x in texts for _ in texts]), pd.Series(texts * len(texts))
    assert list(fuzzy.token_set_ratio.func(a, b)) == [by_definition(x, y) for x, y in zip(a, b)]
    assert list(fuzzy.token_sort_ratio.func(a, b)) == [ratio(" ".join(sorted(words(x))), " ".join(sorted(words(y)))) for x, y in zip(a, b)]
    letters, real = [], fuzzy._common
    monkeypatch.setattr(fuzzy, "_common", lambda x, y: letters.append(len(x) + len(y)) or real(x, y))
    long = " ".join(f"word{i}" for i in range(200))
    fuzzy.token_set_ratio.func(pd.Series([f"{long} 10123"] * 50), pd.Series([f"{long} 10987"] * 50))
    assert sum(letters) <= 20


@pytest.fixture
def shuffled(spark):
    """A function that gives the number of shuffle files of the session."""
    return lambda: str(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ")).count("/shuffle_")


def test_written_tables_leave_no_shuffles(spark, shuffled):
    """shuffles of a table that is written are gone with it, and the caller's setting stays."""
    from skein.sources import scratch

    before = shuffled()
    table = scratch.materialize(spark.range(1000).groupBy(F.col("id") % 7).count().repartition("count"), spark)
    assert shuffled() == before and table.count() == 7
    assert spark.conf.get(scratch.CLEAN_UP, None) is None
    spark.conf.set(scratch.CLEAN_UP, "false")
    scratch.materialize(spark.range(5), spark)
    assert spark.conf.get(scratch.CLEAN_UP) == "false"
    spark.conf.unset(scratch.CLEAN_UP)


def test_feature_groups_are_written_one_by_one(spark, shuffled, monkeypatch):
    """while features are built, no group's shuffles stay beside the next one's; features and labels are those of the pairs."""
    from skein.plans import catalog
    from skein.sources import views

    d, left, f = "/root/testdata/sf0.001", [], features.materialize
    candidates = blocking.materialize(catalog._candidates(spark, d).withColumn("even", F.col("cand_id").endswith("0")).where("even").drop("even"), spark)
    before = shuffled()
    monkeypatch.setattr(features, "materialize", lambda df, s: (f(df, s), left.append(shuffled() - before))[0])
    out = features.build_features(candidates, views.items(spark, d), views.item_classes(spark, d), fuzzy=False)
    assert len(left) > 5 and max(left) <= 8
    rows = out.collect()
    truth = {tuple(r) for r in views.item_truth(spark, d).collect()}
    assert out.columns[-1] == "label" and len(rows) == candidates.count() and {(r.s1_id, r.cand_id) for r in rows if r.label} == truth & {(r.s1_id, r.cand_id) for r in rows}
    near = {(r.s1_id, r.cand_id): r for r in features.vector_features(candidates, views.items(spark, d)).collect()}
    assert all(abs(r.f_vec_name_tfidf - near[r.s1_id, r.cand_id].f_vec_name_tfidf) + abs(r.f_vec_addr_tfidf - near[r.s1_id, r.cand_id].f_vec_addr_tfidf) < 1e-9 for r in rows)


def test_labels_of_classes(spark):
    """labels from classes are those of all their pairs, which no plan makes; records without a class match none."""
    rows = [(f"S{i % 3 + 1}-{i}", f"S{i % 3 + 1}", None if i % 10 == 9 else "ABCD"[i * i % 4]) for i in range(120)]
    classes = spark.createDataFrame(rows, "entity_id string, source string, class string")
    a, b = classes.where("source = 'S1'").select(F.col("entity_id").alias("s1_id"), "class"), classes.where("source <> 'S1'").select(F.col("entity_id").alias("cand_id"), "class")
    given = a.select("s1_id").crossJoin(b.select("cand_id")).where("pmod(hash(s1_id, cand_id), 3) = 0")
    got, want = (sorted(features.with_labels(given, truth).select("s1_id", "cand_id", "label").collect()) for truth in (classes, a.join(b, "class").select("s1_id", "cand_id")))
    assert got == want and {r.label for r in got} == {0, 1}


def test_true_pairs_of_classes_are_not_made(spark):
    """recall of records of few classes are those of all their pairs, and no plan joins on the classes alone."""
    from skein.operators import reports

    rows = [(f"S{i % 3 + 1}-{i}", f"S{i % 3 + 1}", None if i % 10 == 9 else "ABCD"[i * i % 4]) for i in range(120)] + [("S1-900", "S1", "D"), ("S2-900", "S2", "E")]
    classes = spark.createDataFrame(rows, "entity_id string, source string, class string")
    s1 = classes.where("source = 'S1'").select(F.col("entity_id").alias("s1_id"), F.when(F.col("entity_id") < "S1-5", "X").otherwise("Y").alias("country"))
    a, b = classes.where("source = 'S1'").select(F.col("entity_id").alias("s1_id"), "class"), classes.where("source <> 'S1'").select(F.col("entity_id").alias("cand_id"), "class")
    truth = a.join(b, "class").select("s1_id", "cand_id")
    ranked = s1.select("s1_id").crossJoin(b.select("cand_id")).where("pmod(hash(s1_id, cand_id), 3) = 0").withColumn("rank", F.expr("row_number() OVER (PARTITION BY s1_id ORDER BY hash(cand_id))"))
    pairs, got = reports.truth_ranks(ranked, truth, s1), reports.class_ranks(ranked, classes, s1)
    order = lambda df: sorted(df.collect())
    assert order(reports.recall_at(got, [1, 5])) == order(reports.recall_at(pairs, [1, 5])) and reports.recall_at(got, [1, 5]).dtypes == reports.recall_at(pairs, [1, 5]).dtypes
    assert reports.coverage(got).collect() == reports.coverage(pairs).collect()
    assert reports.true_share(got, ranked, s1).collect() == reports.true_share(pairs, ranked, s1).collect()
    assert got.count() < truth.count()
