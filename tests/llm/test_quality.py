import numpy as np

from quarry.llm import quality
from quarry.llm.common import crc_mod, table


def test_held_out_accuracy_and_calibration(spark, small_sf):
    sf = small_sf.replace("sf0.001", "sf0.1")
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = quality.fit(quality.training_sample(docs, labels.where(crc_mod("doc_id", 3) != 1)))
    held = docs.where(crc_mod("doc_id", 3) == 1).join(labels, "doc_id").select("doc_id", "text", "quality")
    rows = quality.score(held, model).collect()
    y, p = np.array([r.quality for r in rows]), np.array([r.score for r in rows])
    assert ((p >= 0.5) == y).mean() > 0.96
    assert abs(p.mean() - y.mean()) < 0.03 and ((p - y) ** 2).mean() < 0.04


def test_every_block_counts():
    model = quality.fit([("good words here " * 50, 1), ("bad%%% stuff$$$ " * 50, 0)] * 8)
    good, bad = quality._compressor(model.good), quality._compressor(model.bad)
    text = "good words here " * 100
    assert quality.difference(text, good, bad, 256) > 0
    assert quality.difference(text + "bad%%% stuff$$$ " * 400, good, bad, 256) < 0
    assert sum(map(len, quality.blocks("é" * 1000, 256))) == 2000


def test_defined_cases(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (5, 0), (4, None), (99, 1), (None, 1)], "doc_id long, quality int")
    model = quality.fit(quality.training_sample(odd_docs, labels))
    out = quality.score(odd_docs, model).collect()
    assert len(out) == odd_docs.count() and all(0 <= r.score <= 1 for r in out)
    empty = [r for r in out if r.doc_id in (2, 3)]
    assert empty[0].score == empty[1].score and empty[0].size_difference == 0
    assert quality.score(no_docs, model).count() == 0
    only = quality.fit(quality.training_sample(odd_docs, labels.where("quality = 1")))
    assert {r.predicted for r in quality.score(odd_docs, only).collect()} == {1}
    none = quality.fit(quality.training_sample(no_docs, labels))
    assert {r.score for r in quality.score(odd_docs, none).collect()} == {0.5}
