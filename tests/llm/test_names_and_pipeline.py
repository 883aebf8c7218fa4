"""Clashing column names, and the pipeline's stages on a small corpus."""

import random

import pytest

pytest.importorskip("public_tokenizers")
corpus_pipeline = pytest.importorskip("corpus_pipeline")

from skein.llm import mixing, pii, quality, simhash, spans  # noqa: E402

ODD = "row text2 base candidates spans new state all reach h1 h2 first size taken place pass shard key id root n fold hot run_ _both _key _n _k _h places x label".split()


def corpus(spark, extra=()):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("alpha beta gamma delta eps zeta eta theta".split()) + str(rng.randrange(30)) for _ in range(60)) for _ in range(30)]
    texts += [texts[0], f"mail a.b@c.de now {texts[1]}", None, ""]
    rows = [(i, t, "en", f"s{i % 3}", len(t or ""), *(["keep"] * len(extra))) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", `{c}` string" for c in extra))


def test_clashing_names(spark):
    df = corpus(spark, ODD)
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    for out in (pii.redacted(df), simhash.keep_one(df), mixing.mixed_documents(df), quality.accepted(df, labels)):
        assert out.columns == df.columns
        assert {tuple(r[c] for c in ODD) for r in out.collect()} <= {("keep",) * len(ODD)}
    assert spans.deduplicated(df).count() == df.count()
