import itertools
import tracemalloc

import numpy as np

from quarry.llm import langid
from quarry.llm.common import crc_mod, table


def brute(emit, transition, start):
    """Marginals by summing over every label sequence."""
    steps, k = emit.shape
    total, out = 0.0, np.zeros((steps, k))
    for path in itertools.product(range(k), repeat=steps):
        w = np.exp(start[path[0]] + sum(emit[t, y] for t, y in enumerate(path))
                   + sum(transition[a, b] for a, b in zip(path, path[1:])))
        total += w
        for t, y in enumerate(path):
            out[t, y] += w
    return out / total


def test_marginals_match_enumeration():
    rng = np.random.default_rng(1)
    k, scores = 3, rng.normal(size=(7, 3)).astype(np.float32)
    model = langid.CrfModel(["a", "b", "c"], 4, {}, scores, rng.normal(size=(k, k)).astype(np.float32),
                            rng.normal(size=k).astype(np.float32))
    rows = [rng.integers(0, 7, n) for n in (5, 1, 0, 7, 4)]
    lettered = np.array([True, True, False, True, True, True, False])
    mass, worded, _ = langid.marginal_mass(rows, scores, lettered, model)
    for i, r in enumerate(rows):
        want = (brute(scores[r], model.transition, model.start) * lettered[r][:, None]).sum(axis=0) if len(r) else np.zeros(k)
        assert np.allclose(mass[i], want, atol=1e-5)
        assert worded[i] == lettered[r].sum()


def test_training_gradient_pairs_match_enumeration():
    rng = np.random.default_rng(2)
    emit, transition, start = rng.normal(size=(4, 1, 2)), rng.normal(size=(2, 2)), rng.normal(size=2)
    post, pairs = langid.forward_backward(emit, np.array([4]), transition, start)
    assert np.allclose(post[:, 0], brute(emit[:, 0], transition, start))
    assert np.isclose(pairs.sum(), 3)


def test_held_out_accuracy_and_code_switching(spark, small_sf):
    sf = small_sf.replace("sf0.001", "sf0.01")
    docs = table(spark, sf, "documents")
    model = langid.train(docs, crc_mod("doc_id", 4) != 2)
    held = langid.identify(docs.where(crc_mod("doc_id", 4) == 2).select("doc_id", "lang", "text"), model).collect()
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.98
    texts = {r.lang: r.text for r in docs.where("length(text) > 2000").collect()}
    a, b = sorted(texts)[:2]
    half = lambda t: " ".join(t.split()[:120])
    mixed = spark.createDataFrame([(1, half(texts[a]) + " " + half(texts[b]))], "doc_id long, text string")
    row = langid.identify(mixed, model).first()
    assert row.lang_pred in (a, b) and 0.4 < row.score < 0.75 and row.n_switches >= 1


def test_defined_cases(spark, odd_docs, no_docs):
    model = langid.train(odd_docs)
    out = langid.identify(odd_docs, model).collect()
    assert len(out) == odd_docs.count()
    by = {r.doc_id: r for r in out}
    for i in (2, 3, 4):
        assert by[i].lang_pred == "und" and by[i].score == 0
    assert by[5].lang_pred == "de" and by[6].lang_pred == "en" and 0 <= by[6].score <= 1
    assert by[1].n_tokens == 1 and by[1].row == "x"
    assert langid.identify(no_docs, model).count() == 0
    assert langid.train(no_docs) is None
    assert {r.lang_pred for r in langid.identify(odd_docs, None).collect()} == {"und"}


def test_same_model_and_result_on_a_rerun(spark, small_sf):
    docs = table(spark, small_sf, "documents")
    a, b = langid.train(docs), langid.train(docs.repartition(7))
    assert np.array_equal(a.emission, b.emission)


def test_fitting_holds_a_word_once():
    """Not an object for each of its places: 800,000 of them here."""
    sample = [(" ".join(f"wort{chr(97 + (i + k) % 26)}" for k in range(2000)), "de" if i % 2 else "en") for i in range(400)]
    tracemalloc.start()
    try:
        model = langid.fit(sample, bits=10, sequences=64, epochs=1)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sorted(model.lexicon) == [f"wort{chr(97 + k)}" for k in range(26)]
    assert peak < 25e6
