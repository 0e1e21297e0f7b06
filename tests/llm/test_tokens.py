import math
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from quarry.llm import bpe, pieces, tokencount
from quarry.llm.common import give_back, table

TEXTS = ["a  b \n c", "  x\t\ty  ", "ﬁ é  x　y 日本語テキスト 😀", "\n\n\n", "    ", "1234567 http://foo.com/b?x=1 (a);\r\n",
         "supercalifragilistic " * 3 + "x" * 400, ""]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary.load()


@pytest.fixture(scope="module")
def texts(spark, small_sf):
    return TEXTS + [r.text for r in table(spark, small_sf, "documents").limit(40).collect()]


def plain_count(text, scores, unknown):
    """Pieces of the best segmentation of the whole text, by plain dynamic programming."""
    s = " " + text
    s = s.replace(" ", pieces.SPACE)
    best = [(0.0, 0)] + [(-math.inf, 0)] * len(s)
    for i in range(len(s)):
        for j in range(i + 1, min(len(s), i + 16) + 1):
            if s[i:j] in scores:
                cand = (best[i][0] + scores[s[i:j]], best[i][1] - 1)
                best[j] = max(best[j], cand)
        if s[i] not in scores:
            best[i + 1] = max(best[i + 1], (best[i][0] + unknown, best[i][1] - len(s[i].encode())))
    return -best[-1][1]


def test_counts_match_plain_programming(vocabulary, texts):
    trie = tokencount.PrefixTrie(vocabulary)
    for t in texts[:25]:
        if t:
            got = sum(trie.insert(w) for w in vocabulary.pre_tokens(t))
            assert got == plain_count(t, trie.scores, trie.unknown), t[:60]


def test_counts_match_the_library_with_the_same_scores(vocabulary, texts):
    model = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    import sentencepiece
    proto = model.ModelProto()
    proto.ParseFromString(open(pieces.default_path(), "rb").read())
    proto.trainer_spec.model_type = 1
    scores = tokencount.zipf_scores(vocabulary)
    for p in proto.pieces:
        if p.type == 1:
            p.score = scores[p.piece]
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    trie = tokencount.PrefixTrie(vocabulary)
    for t in texts:
        assert sum(trie.insert(w) for w in vocabulary.pre_tokens(t)) == len(library.encode(t))


def test_a_full_trie_starts_anew_with_the_same_counts(spark, vocabulary, odd_docs, no_docs):
    out = tokencount.count_tokens(odd_docs, vocabulary).collect()
    trie = tokencount.PrefixTrie(vocabulary, most_nodes=5)
    for r, d in zip(out, odd_docs.collect()):
        want = 0
        for w in vocabulary.pre_tokens(d.text or ""):
            want += trie.insert(w)
            trie.reset()
        assert r.n_tokens == want
    by = {r.doc_id: r for r in out}
    assert by[2].n_tokens == by[3].n_tokens == 0
    assert tokencount.count_tokens(no_docs, vocabulary).count() == 0


def test_without_dropout_the_library_encoding(vocabulary, texts):
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_path())
    seg = bpe.Segmenter(vocabulary, 0.0, 17)
    for t in texts:
        assert seg.encode(t, 0).tolist() == library.encode(t)


def test_dropout_varies_and_decodes(vocabulary, texts):
    seg, again = bpe.Segmenter(vocabulary, 0.3, 17), bpe.Segmenter(vocabulary, 0.3, 17, most=3)
    varied = 0
    for t in texts + ["a▁b", "▁", "▁ ▁a ", " ▁\n▁", ""]:
        a, b = seg.encode(t, 0), seg.encode(t, 1)
        assert bpe.decode(a, vocabulary) == t == bpe.decode(b, vocabulary)
        assert np.array_equal(a, again.encode(t, 0))
        varied += not np.array_equal(a, b)
    assert varied > len(texts) / 2


def test_both_agendas_agree(vocabulary):
    rng = np.random.default_rng(3)
    for _ in range(500):
        s = "".join(rng.choice(list("thendrigso▁é"), rng.integers(1, 38)))
        path = sorted(rng.choice(40, rng.integers(0, 8), replace=False).tolist())
        short, long = bpe.Drops(iter(path)), bpe.Drops(iter(path))
        assert bpe.merge_part(s, vocabulary, short) == bpe._merge_long(s, vocabulary, long)
        assert short.at == long.at


def test_many_agendas_at_once_agree(vocabulary):
    rng = np.random.default_rng(4)
    agendas = bpe.Agendas(vocabulary)
    words = ["".join(rng.choice(list("thendrigsoac▁"), rng.integers(1, 30))) for _ in range(2000)]
    paths = [tuple(sorted(rng.choice(30, rng.integers(0, 6), replace=False).tolist())) for _ in words]
    ids, popped = agendas.run(words, paths)
    for w, path, x, n in zip(words, paths, ids, popped):
        drops = bpe.Drops(iter(path))
        assert np.frombuffer(x, np.int32).tolist() == [vocabulary.ids[p] for p in bpe.merge_part(w, vocabulary, drops)]
        assert n == drops.at


def test_every_occurrence_is_cut_by_itself(vocabulary):
    """One pre-token: each occurrence's cut is what its own draws give, remembered or not;
    the cuts grow with the corpus, and each candidate is dropped with the asked chance."""
    seg = bpe.Segmenter(vocabulary, 0.1, 17)
    word = "international"
    cuts, kept = set(), 0
    undropped = bpe.Segmenter(vocabulary, 0.0, 17).encode(word, 0).tobytes()
    seg.encode(word, 0)
    candidates = seg.left[seg.first[" " + word]]
    for document in range(40):
        text = " ".join([word] * 100)
        got = seg.encode(text, document)
        again = bpe.Segmenter(vocabulary, 0.1, 17, most=1).encode(text, document)
        assert np.array_equal(got, again) and bpe.decode(got, vocabulary) == text
    nodes = [i for i, (t, _) in enumerate(seg.paths) if t == " " + word]
    cuts = {seg.ids[i] for i in nodes}
    assert len(cuts) > 30  # four streams gave four
    counted = [seg.encode(word, d).tobytes() for d in range(20_000)]
    share = sum(c == undropped for c in counted) / len(counted)
    same = {seg.ids[i] for i in nodes if seg.ids[i] == undropped}
    assert same and share >= 0.9 ** candidates - 0.02
    exact = [int(x) for x in seg.let_through(np.arange(100_000, dtype=np.uint64) * np.uint64(7919), 0)]
    assert abs(np.mean([x >= candidates for x in exact]) - 0.9 ** candidates) < 0.01
    assert abs(np.mean([x == 0 for x in exact]) - 0.1) < 0.005


def test_what_is_met_again_stays_remembered(vocabulary):
    """A full memory is cleared of what was met once; words of every text stay, and so do
    their cuts."""
    plain, seg, asked = bpe.Segmenter(vocabulary, 0.1, 17), bpe.Segmenter(vocabulary, 0.1, 17, most=300), []
    make = seg._nodes
    seg._nodes = lambda new: (asked.extend(new), make(new))[1]
    rng = np.random.default_rng(8)
    for document in range(60):
        rare = ["".join(rng.choice(list("thendrigso"), 9)) for _ in range(40)]
        text = " ".join(w for r in rare for w in (r, "international", "house"))
        got = seg.encode(text, document)
        assert np.array_equal(got, plain.encode(text, document))
        assert len(seg.ids) == len(seg.paths) <= 700
    for word in (" international", " house"):
        assert asked.count((word, ())) == 1
    assert len(seg.first) < 400


def test_draws_step_by_step(vocabulary):
    """The remembered segmentations against one pass over each occurrence with its draws."""
    seg = bpe.Segmenter(vocabulary, 0.3, 5)
    text = "the international understanding of  these things, 1234567 http://foo.com " * 20
    got = seg.encode(text, 99)
    tokens = vocabulary.pre_tokens(text)
    document = bpe._mixed(np.array([99], dtype=np.uint64) + bpe._times([6]))
    keys = bpe._mixed(np.repeat(document, len(tokens)) + bpe._times(np.arange(len(tokens)) + 1))
    want = b"".join(seg._own(t, k) for t, k in zip(tokens, keys))
    assert got.tobytes() == want


def test_long_and_dropped_to_characters(vocabulary):
    seg = bpe.Segmenter(vocabulary, 1.0, 17)
    for t in ("understanding of things", "x" * 5000, ""):
        assert len(seg.encode(t, 1)) == (len(t) + 1 if t else 0)
        assert bpe.decode(seg.encode(t, 1), vocabulary) == t
    long = bpe.Segmenter(vocabulary, 0.1, 17)
    a, b = long.encode("thend" * 20_000, 1), long.encode("thend" * 20_000, 2)
    assert not np.array_equal(a, b) and bpe.decode(a, vocabulary) == "thend" * 20_000


def test_a_batch_is_cut_as_the_pattern_cuts(vocabulary, texts):
    seg = bpe.Segmenter(vocabulary, 0.1, 17)
    odd = texts + ["a▁b", "▁", "▁ ▁a ", " ▁\n▁", "", "_a1_ b", "é́x  ٣٤ \n\n ", "ª²½Ⅷ", "\u2028x\x00"]
    distinct, number, counts = seg.cut(odd)
    assert len(set(distinct)) == len(distinct)
    tokens = [distinct[i] for i in number]
    for t, n in zip(odd, counts):
        assert tokens[:n] == vocabulary.pre_tokens(t), t[:60]
        del tokens[:n]
    assert not tokens and seg.cut(["", ""])[2].tolist() == [0, 0]


def test_long_texts_are_few_at_a_time():
    texts = ["x" * n for n in (400, 400, 400, 2500, 1, 0)] + [None, "é" * 1000] + ["y"] * 30
    batch = pa.RecordBatch.from_pydict({"id": list(range(len(texts))), "t": texts})
    found = list(bpe.few_texts(batch, "t", 10, 1000))
    assert [len(p) for p in found] == [2, 1, 1, 3, 1, 10, 10, 10]
    assert [x for p in found for x in p["id"].to_pylist()] == batch["id"].to_pylist()


def test_texts_reach_python_a_few_megabytes_at_a_time(spark, vocabulary):
    docs = spark.range(3000).coalesce(1).selectExpr("id as doc_id", "repeat('some words ', 400) as text")
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    bpe.encode(docs, vocabulary)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.nbytes]})

    found = [r.n for r in docs.mapInArrow(sizes, "n long").collect()]
    assert len(found) > 2 and max(found) < 5_000_000
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "9m")
    bpe.encode(docs, vocabulary)
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "9m"  # the submitter's
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")


def test_what_is_remembered_takes_little_memory(vocabulary):
    """A remembered cut is a few numbers in shared columns: a worker holds 200,000 and more."""
    rng = np.random.default_rng(5)
    seg = bpe.Segmenter(vocabulary, 0.1, 17)
    texts = [" ".join("".join(rng.choice(list("thendrigso"), 9)) for _ in range(500)) for _ in range(20)]
    tracemalloc.start()
    try:
        for document, text in enumerate(texts):
            seg.encode(text, document)
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert len(seg.paths) > 12_000
    assert held / len(seg.paths) < 200


def test_ids_that_decode_to_something_else_are_told(vocabulary, texts):
    seg = bpe.Segmenter(vocabulary, 0.1, 17)
    ids, counts = seg.encode_flat(texts, list(range(len(texts))))
    assert all(seg.lossless(ids, counts, texts))
    at = int(counts[:3].sum()) + 1  # behind the dummy space
    ids = ids.copy()
    ids[at] = (ids[at] + 1) % len(vocabulary.raw)
    found = seg.lossless(ids, counts, texts)
    assert [i for i, x in enumerate(found) if not x] == [3]
    assert bpe.decode(ids[at - 1:at - 1 + counts[3]], vocabulary) != texts[3]


def test_encode_defined_cases(spark, vocabulary, odd_docs, no_docs):
    out = bpe.decode_column(bpe.encode(odd_docs, vocabulary), vocabulary)
    rows = out.collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert r.decoded == r.text
        assert (r.token_ids is None) == (r.text is None)
        assert r.n_tokens == (None if r.text is None else len(r.token_ids))
    twice = [r.token_ids for r in rows if r.doc_id == 1]
    assert twice[0] == twice[1]
    assert bpe.encode(no_docs, vocabulary).count() == 0


def test_what_is_freed_goes_back_to_the_system():
    def held():
        return int(open("/proc/self/statm").read().split()[1]) * 4096

    many = [bytearray(50_000) for _ in range(4000)]
    last = bytearray(50_000)  # behind them: what is free below it stays without a word
    many.clear()
    before = held()
    give_back()
    assert last and before - held() > 100_000_000
