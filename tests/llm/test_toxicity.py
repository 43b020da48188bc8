import numpy as np
from pyspark.sql import functions as F

from satlink.llm import toxicity


def corpus(spark, n=1200):
    rng = np.random.default_rng(4)
    words, bad = [f"word{i}" for i in range(400)], ["grublax", "vornip", "skelt"]
    docs, labels = [], []
    for i in range(n):
        w = list(rng.choice(words, rng.integers(5, 120)))
        toxic = i % 8 == 0
        for _ in range(rng.integers(1, 4) if toxic else 0):
            w.insert(int(rng.integers(0, len(w))), str(rng.choice(bad)) + str(rng.choice(["", "ung", "ed"])))
        docs.append((i, " ".join(map(str, w)), int(toxic)))
        if i % 3:
            labels.append((i, int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string, truth int"), spark.createDataFrame(labels + [(5000, None)], "doc_id long, toxic int")


def test_separates_held_out_texts(spark):
    docs, labels = corpus(spark)
    learn = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) != 2
    model = toxicity.fit(docs, labels, learn)
    got = toxicity.score(docs, model).where(~learn).select("truth", "predicted", "score").collect()
    assert np.mean([r.truth == r.predicted for r in got]) > 0.97 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)


def test_edges(spark, frame):
    docs, labels = corpus(spark)
    model = toxicity.fit(docs, labels, F.lit(True))
    got = toxicity.score(frame([(1, None), (2, ""), (2, ""), (None, "x" * 100_000), (3, "grublax " * 9)], ["score", "own"]), model).collect()
    assert len(got) == 5 and got[0].own == "own" and got[0].score == got[1].score and got[4].predicted == 1
    assert toxicity.score(frame([]), model).collect() == []
    none = toxicity.fit(docs, labels.limit(0), F.lit(True))
    assert {r.predicted for r in toxicity.score(docs.limit(5), none).collect()} == {0}


def test_risk_is_kept_from_going_negative():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.2
    x = (rng.random((4000, 30)) < 0.1).astype(np.float32)
    x[truth, 0] = 1
    w, b = toxicity.nnpu(x[truth][:300], x, 0.2)
    score = 1 / (1 + np.exp(-(x @ w + b)))
    assert score[truth].mean() > 0.6 and score[~truth & (x[:, 0] == 0)].mean() < 0.2
