"""Language identification with a linear-chain conditional random field.

Every word of a text gets a label by forward-backward over learned emission and
transition weights, so a text that switches language is labelled word by word;
the document's language is the label with the largest posterior mass.

Emission features of a word (folded to lower case, letters only): its character
n-grams of one to four with the borders marked, so that those at a border are its
prefixes and suffixes, and its entry in a lexicon of frequent training words.
Transitions are learned from training sequences spliced from spans of labelled
documents, which is where switches come from.

Defined cases: a null or empty text, or one without a letter, gets ``und`` and
score 0. Repeated rows each get their row. Without labelled rows every text is
``und``. Words without a letter (numbers, rules) carry no evidence. Ties between
languages go to the first in code-point order. Other columns of the input are
carried; one named like an output column is replaced by it.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import carried, give_back, unused, worker_cache
from quarry.session import bound_batches

UNKNOWN = "und"
_LETTERS = re.compile(r"[^\W\d_]+")
_START, _END = 2, 3  # border marks, no code points of letters
_MULT = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class CrfModel:
    """Weights; a few MB whatever the corpus (2**bits hashed rows plus the lexicon)."""

    labels: list[str]
    bits: int
    lexicon: dict[str, int]
    emission: np.ndarray      # (2**bits + len(lexicon) + 1, labels) float32
    transition: np.ndarray    # (labels, labels), from row to column
    start: np.ndarray
    key: str = field(default_factory=lambda: uuid.uuid4().hex)


def fold(token: str) -> str:
    """A token as the features see it: its letters in lower case."""
    return "".join(_LETTERS.findall(token)).lower()


def ngram_rows(words: list[str], bits: int, longest: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Hashed rows of all n-grams of the words, and the word each belongs to."""
    joined = "".join(f"\x02{w}\x03" for w in words)
    codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    rows, owners = [], []
    h = np.zeros(len(codes), dtype=np.uint64)
    for n in range(1, longest + 1):
        # h[i] covers the n characters from i on
        h = h[: len(codes) - n + 1] * _MULT + codes[n - 1:]
        ok = owner[: len(h)] == owner[n - 1:]
        if n == 1:
            ok &= codes > _END
        g = (h[ok] + np.uint64(n)) * _MULT
        rows.append((g >> np.uint64(64 - bits)).astype(np.int64))
        owners.append(owner[: len(h)][ok])
    return np.concatenate(rows), np.concatenate(owners)


def _feature_sums(model: CrfModel, words: list[str]) -> np.ndarray:
    """Emission scores (words, labels)."""
    rows, owner = ngram_rows(words, model.bits)
    k = len(model.labels)
    out = np.empty((len(words), k), dtype=np.float32)
    for j in range(k):
        out[:, j] = np.bincount(owner, weights=model.emission[rows, j], minlength=len(words))
    base = 1 << model.bits
    lex = np.fromiter((model.lexicon.get(w, len(model.lexicon)) for w in words), np.int64, len(words))
    return out + model.emission[base + lex]


class _WordScores(dict):
    """token -> row of ``scores``; rows are computed once per distinct token and
    forgotten together when ``most`` tokens are held, which bounds the memory."""

    def __init__(self, model: CrfModel, most: int = 300_000) -> None:
        super().__init__()
        self.model, self.most = model, most
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.new: list[str] = []
        self.scores = np.zeros((1 << 12, len(self.model.labels)), dtype=np.float32)
        self.lettered = np.zeros(1 << 12, dtype=bool)

    def __missing__(self, token: str) -> int:
        i = self[token] = len(self)
        self.new.append(token)
        return i

    def rows(self, tokens: list[str]) -> np.ndarray:
        ids = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        if self.new:
            while len(self.scores) < len(self):
                self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
                self.lettered = np.concatenate([self.lettered, np.zeros_like(self.lettered)])
            first = len(self) - len(self.new)
            for at in range(0, len(self.new), 50_000):
                folded = [fold(t) for t in self.new[at:at + 50_000]]
                at += first
                has = np.array([bool(w) for w in folded])
                self.lettered[at:at + len(folded)] = has
                self.scores[at:at + len(folded)] = _feature_sums(self.model, folded) * has[:, None]
            self.new = []
        return ids


def forward_backward(emit: np.ndarray, length: np.ndarray, transition: np.ndarray,
                     start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posterior marginals of padded sequences (t, n, labels), longest first.

    ``length`` descends, so the sequences still running at step t are the
    first ones. Scaled in probability space; returns the marginals and, for
    training, the posterior of each adjacent pair summed over positions.
    """
    steps, n, k = emit.shape
    e = np.exp(emit - emit.max(axis=2, keepdims=True))
    move = np.exp(transition - transition.max())
    alpha = np.zeros((steps, n, k))
    running = np.searchsorted(-length, -np.arange(steps), side="left")
    alpha[0] = e[0] * np.exp(start - start.max())
    alpha[0] /= alpha[0].sum(axis=1, keepdims=True)
    for t in range(1, steps):
        r = running[t]
        a = alpha[t - 1, :r] @ move
        a *= e[t, :r]
        a /= a.sum(axis=1, keepdims=True)
        alpha[t, :r] = a
    pairs = np.zeros((k, k))
    beta = np.ones((n, k))
    for t in range(steps - 1, 0, -1):
        r = running[t]
        down = e[t, :r] * beta[:r]
        x = alpha[t - 1, :r, :, None] * move * down[:, None, :]
        pairs += (x / x.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        alpha[t, :r] *= beta[:r]
        b = down @ move.T
        beta[:r] = b / b.sum(axis=1, keepdims=True)
    alpha[0] *= beta
    total = alpha.sum(axis=2, keepdims=True)
    return alpha / np.where(total > 0, total, 1), pairs


def marginal_mass(rows: list[np.ndarray], scores: np.ndarray, lettered: np.ndarray,
                  model: CrfModel) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior mass per label, words with letters and switches of each sequence
    of word rows. Words are laid out by position, longest sequence first, so that
    a step of either recursion is one small product over a contiguous slice; the
    messages are rescaled every eighth step, and at the end every position is."""
    k, n = len(model.labels), len(rows)
    order = np.argsort([-len(r) for r in rows], kind="stable")
    length = np.array([len(rows[i]) for i in order], dtype=np.int64)
    steps = int(length[0]) if n else 0
    running = np.searchsorted(-length, -np.arange(steps), side="left")
    at = np.concatenate([[0], np.cumsum(running)]).tolist()
    seq = np.repeat(np.arange(n), length)
    pos = np.arange(len(seq)) - np.repeat(np.cumsum(length) - length, length)
    flat = np.empty(len(seq), dtype=np.int64)
    flat[np.asarray(at)[pos] + seq] = np.concatenate([rows[i] for i in order]) if n else 0
    e = scores[flat]
    e = np.exp(e - e.max(axis=1, keepdims=True)).astype(np.float64) if len(flat) else e.astype(np.float64)
    move = np.exp(model.transition - model.transition.max()).astype(np.float64)
    back = np.ascontiguousarray(move.T)
    alpha = np.empty((len(flat), k))
    if steps:
        np.multiply(e[:at[1]], np.exp(model.start - model.start.max()), out=alpha[:at[1]])
    for t in range(1, steps):
        s, end = at[t], at[t + 1]
        a = alpha[s:end]
        np.matmul(alpha[at[t - 1]:at[t - 1] + end - s], move, out=a)
        a *= e[s:end]
        if not t & 7:
            a /= a.sum(axis=1, keepdims=True)
    beta = np.ones((n, k))
    for t in range(steps - 1, -1, -1):
        s, end = at[t], at[t + 1]
        b = beta[:end - s]
        alpha[s:end] *= b
        b[:] = (e[s:end] * b) @ back
        if not t & 7:
            b /= b.sum(axis=1, keepdims=True)
    where = np.asarray(at)[pos] + seq  # back to sequence by sequence
    alpha = alpha[where]
    alpha /= alpha.sum(axis=1, keepdims=True)
    counted = lettered[flat[where]]
    mass = np.stack([np.bincount(seq, weights=alpha[:, j] * counted, minlength=n)
                     for j in range(k)], axis=1)
    best = alpha.argmax(axis=1)
    turn = (best[1:] != best[:-1]) & (seq[1:] == seq[:-1])
    switches = np.bincount(seq[1:][turn], minlength=n)
    worded = np.bincount(seq, weights=counted, minlength=n)
    undo = np.empty(n, dtype=int)
    undo[order] = np.arange(n)
    return mass[undo], worded[undo], switches[undo]


def fit(sample: list[tuple[str, str]], *, bits: int = 18, lexicon_size: int = 5000,
        sequences: int = 1600, epochs: int = 3, batch: int = 64, rate: float = 0.05,
        l2: float = 1e-6, seed: int = 7) -> CrfModel | None:
    """Train on (text, label) rows by Adam on the conditional log-likelihood of
    sequences of one to four spans of 5 to 40 words spliced across documents."""
    rng = np.random.default_rng(seed)
    once: dict[str, str] = {}  # a word is one object, wherever it stands
    docs = [(label, [once.setdefault(w, w) for w in map(fold, text.split()) if w]) for text, label in sample]
    docs = [d for d in docs if d[1]]
    if not docs:
        return None
    labels = sorted({label for label, _ in docs})
    k, base = len(labels), 1 << bits
    seen = Counter(w for _, ws in docs for w in ws)
    ranked = sorted(seen, key=lambda w: (-seen[w], w))[:lexicon_size]
    lexicon = {w: i for i, w in enumerate(ranked)}
    types = {w: i for i, w in enumerate(sorted(seen))}
    names = list(types)
    rows, owner = ngram_rows(names, bits)
    rows = np.concatenate([rows, [base + lexicon[w] for w in names if w in lexicon]]).astype(np.int64)
    owner = np.concatenate([owner, [i for i, w in enumerate(names) if w in lexicon]]).astype(np.int64)
    used, rows = np.unique(rows, return_inverse=True)
    order = np.argsort(owner, kind="stable")
    rows, owner = rows[order], owner[order]
    begin = np.searchsorted(owner, np.arange(len(names)))
    # Per-label scores of all word types are recomputed for the types of a batch only.
    ends = np.append(begin[1:], len(rows))
    by_label = [[ws for label, ws in docs if label == x] for x in labels]
    word_ids = [[np.array([types[w] for w in ws]) for ws in group] for group in by_label]

    def sequence() -> tuple[np.ndarray, np.ndarray]:
        ids, gold = [], []
        for _ in range(rng.integers(1, 5)):
            j = int(rng.integers(k))
            ws = word_ids[j][rng.integers(len(word_ids[j]))]
            n = int(rng.integers(5, 41))
            s = int(rng.integers(max(1, len(ws) - n + 1)))
            ids.append(ws[s:s + n])
            gold.append(np.full(len(ids[-1]), j))
        return np.concatenate(ids), np.concatenate(gold)

    emission = np.zeros((len(used), k))
    theta = [emission, np.zeros((k, k)), np.zeros(k)]
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in theta]
    data = [sequence() for _ in range(sequences)]
    step = 0
    for _ in range(epochs):
        for chunk in np.array_split(rng.permutation(sequences), max(1, sequences // batch)):
            step += 1
            part = sorted((data[i] for i in chunk), key=lambda s: -len(s[0]))
            length = np.array([len(s[0]) for s in part])
            ids = np.concatenate([s[0] for s in part])
            gold = np.concatenate([s[1] for s in part])
            here, inverse = np.unique(ids, return_inverse=True)
            pick = np.concatenate([np.arange(begin[i], ends[i]) for i in here])
            group = np.repeat(np.arange(len(here)), ends[here] - begin[here])
            scores = np.stack([np.bincount(group, weights=emission[rows[pick], j], minlength=len(here))
                               for j in range(k)], axis=1)
            seq = np.repeat(np.arange(len(part)), length)
            pos = np.arange(len(ids)) - np.repeat(np.cumsum(length) - length, length)
            emit = np.zeros((length[0], len(part), k))
            emit[pos, seq] = scores[inverse]
            post, pairs = forward_backward(emit, length, theta[1], theta[2])
            diff = post[pos, seq]
            diff[np.arange(len(ids)), gold] -= 1
            by_type = np.stack([np.bincount(inverse, weights=diff[:, j], minlength=len(here))
                                for j in range(k)], axis=1)
            grad = np.zeros_like(emission)
            for j in range(k):
                grad[:, j] = np.bincount(rows[pick], weights=by_type[group, j], minlength=len(used))
            inner = pos[1:] > 0
            gold_pairs = np.zeros((k, k))
            np.add.at(gold_pairs, (gold[:-1][inner], gold[1:][inner]), 1)
            grads = [grad, pairs - gold_pairs, post[0].sum(axis=0) - np.bincount(gold[pos == 0], minlength=k)]
            for p, g, (m, v) in zip(theta, grads, moments):
                g = g / len(part) + l2 * p
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    weights = np.zeros((base + len(lexicon) + 1, k), dtype=np.float32)
    weights[used] = emission
    return CrfModel(labels, bits, lexicon, weights, theta[1].astype(np.float32), theta[2].astype(np.float32))


def training_sample(docs: DataFrame, text: str, label: str, key: str, *, per_label: int = 400,
                    chars: int = 4000) -> list[tuple[str, str]]:
    """A bounded labelled sample: about ``per_label`` rows of each language, picked
    by a hash of ``key``, and of each row a passage of up to ``chars`` characters at
    a hashed place. Only this sample reaches the driver."""
    rows = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        F.col(text).alias("t"), F.col(label).cast("string").alias("l"),
        F.xxhash64(F.col(key).cast("string"), F.lit(11)).alias("h"))
    counts = {r["l"]: r["n"] for r in rows.groupBy("l").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return []
    share = F.create_map(*[F.lit(x) for l, n in sorted(counts.items())
                           for x in (l, min(1.0, 1.5 * per_label / n + 20 / n))])
    room = F.greatest(F.length("t") - chars, F.lit(0))
    picked = (rows.where(F.pmod(F.col("h"), F.lit(1_000_000)) < share[F.col("l")] * 1_000_000)
              .select(F.col("t").substr(F.pmod(F.xxhash64("h"), room + 1).cast("int") + 1,
                                        F.lit(chars)).alias("t"), "l", "h")
              .limit(4 * per_label * len(counts)).collect())
    out: dict[str, list] = {}
    for r in sorted(picked, key=lambda r: (r["h"], r["t"])):
        kept = out.setdefault(r["l"], [])
        if len(kept) < per_label:
            kept.append((r["t"], r["l"]))
    return [x for l in sorted(out) for x in out[l]]


def few_rows(batches: Iterator[pa.RecordBatch], most: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of up to ``most`` rows: whole texts become Python's only a
    piece at a time, as a worker keeps the memory it once had."""
    for batch in batches:
        for at in range(0, len(batch), most):
            yield batch.slice(at, most)


def identify(docs: DataFrame, model: CrfModel | None, *, text: str = "text", keep: list[str] | None = None,
             prefix: str = "", batch_words: int = 400_000) -> DataFrame:
    """Label every whole text: the columns ``keep`` (default: all others but the
    text), lang_pred, score (share of the posterior mass), n_words, n_switches, these
    four with ``prefix`` before their names."""
    new = [prefix + c for c in ("lang_pred", "score", "n_words", "n_switches")]
    keep, body = carried(docs, keep, [text], new), unused(docs, "text_")
    rows = docs.select(*keep, F.col(text).cast("string").alias(body))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema.fields]
                       + [f"`{c}` {t}" for c, t in zip(new, ("string", "double", "long", "long"))])
    if model is None:
        return rows.select(*keep, F.lit(UNKNOWN).alias(new[0]), F.lit(0.0).alias(new[1]),
                           *[F.lit(0).cast("long").alias(c) for c in new[2:]])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    bound_batches(docs.sparkSession)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        cache = worker_cache(("langid", m.key), lambda: _WordScores(m))
        for batch in few_rows(batches):
            result = np.zeros((len(batch), 3))
            names = np.full(len(batch), UNKNOWN, dtype=object)
            texts = batch.column(len(keep)).to_pylist()
            at = 0
            while at < len(texts):  # so many words at a time, whatever the batch holds
                rows, held = [], 0
                while at + len(rows) < len(texts) and (not rows or held <= batch_words):
                    if len(cache) > cache.most and not rows:
                        cache.reset()
                    rows.append(cache.rows((texts[at + len(rows)] or "").split()))
                    held += len(rows[-1])
                end = at + len(rows)
                mass, worded, switches = marginal_mass(rows, cache.scores, cache.lettered, m)
                best = mass.argmax(axis=1)
                some = worded > 0
                for i in np.nonzero(some)[0]:
                    names[at + i] = m.labels[best[i]]
                share = mass.max(axis=1) / np.where(some, worded, 1)
                result[at:end] = np.stack([np.minimum(share, 1.0) * some, worded, switches * some], axis=1)
                at = end
            found = [pa.array(names, pa.string()), pa.array(result[:, 0]), *map(pa.array, result[:, 1:].astype(np.int64).T.copy())]
            yield pa.RecordBatch.from_arrays(batch.columns[:len(keep)] + found, names=[*batch.schema.names[:len(keep)], *new])
        give_back()

    return rows.mapInArrow(label, schema)


def train(docs: DataFrame, where: Column | None = None, *, text: str = "text", label: str = "lang",
          key: str = "doc_id", per_label: int = 400, **fit_options) -> CrfModel | None:
    """Fit on a bounded sample of the labelled rows selected by ``where``."""
    rows = docs if where is None else docs.where(where)
    return fit(training_sample(rows, text, label, key, per_label=per_label), **fit_options)
