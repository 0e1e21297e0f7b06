"""Text quality by compression: two zstandard dictionaries, one built from well and
one from badly rated text, and the difference of the sizes they compress a text to.

A text is compressed in blocks of a fixed number of bytes, each on its own, so the
dictionaries decide over its whole length (one long frame would soon refer to
itself only). ``(bad_size - good_size) / n_bytes`` is the normalised difference; a
logistic curve fitted on labelled rows that the dictionaries have not seen turns it
into the score, the probability of label 1.

Defined cases: a null or empty text has difference 0 and gets that point's score.
Repeated rows each get their row. Rows with a null label teach nothing. With only
one label (or none) among the rows to learn from, every score is the share of label
1 (0.5 without rows). Of the inputs only the text is read for a score; the others are
carried, and one named like an output column is replaced by it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard as zs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import carried, unused

LEVEL = 3


@dataclass
class CompressionModel:
    """Two dictionaries (bytes) and the calibration; some hundred KB."""

    good: bytes
    bad: bytes
    block: int
    slope: float
    offset: float


def blocks(text: str, size: int) -> list[bytes]:
    raw = text.encode("utf-8", "surrogatepass")
    return [raw[i:i + size] for i in range(0, len(raw), size)]


def _compressor(dictionary: bytes) -> zs.ZstdCompressor:
    loaded = zs.ZstdCompressionDict(dictionary)
    loaded.precompute_compress(level=LEVEL)
    return zs.ZstdCompressor(level=LEVEL, dict_data=loaded, write_checksum=False,
                             write_content_size=False, write_dict_id=False)


def difference(text: str, good: zs.ZstdCompressor, bad: zs.ZstdCompressor, size: int) -> float:
    """Compressed size with the bad minus with the good dictionary, per byte."""
    parts = blocks(text, size)
    if not parts:
        return 0.0
    more = sum(len(bad.compress(b)) - len(good.compress(b)) for b in parts)
    return more / ((len(parts) - 1) * size + len(parts[-1]))


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary, or the samples themselves where they are too few."""
    try:
        return zs.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zs.ZstdError:
        return b"".join(samples)[-size:]


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton's method, with a weak pull to zero."""
    scale = x.std() or 1.0
    z = np.stack([x / scale, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) + 1e-2 * w
        hess = (z * (p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(2)
        move = np.linalg.solve(hess, grad)
        w -= np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def fit(sample: list[tuple[str, int]], *, block: int = 256, dictionary_bytes: int = 262_144,
        blocks_per_text: int = 40, seed: int = 5) -> CompressionModel:
    """From (text, label) rows: dictionaries from one half, calibration on the other."""
    labels = {y for _, y in sample}
    if len(labels) < 2:
        share = min(max(float(np.mean([y for _, y in sample])), 0.01), 0.99) if sample else 0.5
        return CompressionModel(b"", b"", block, 0.0, math.log(share / (1 - share)))
    rng = np.random.default_rng(seed)
    sides, held = {}, []
    for y in (0, 1):
        texts = [t for t, label in sample if label == y]
        half = (len(texts) + 1) // 2
        held += [(t, y) for t in texts[half:]] or [(t, y) for t in texts]
        parts = []
        for t in texts[:half]:
            own = blocks(t, block)
            pick = rng.permutation(len(own))[:blocks_per_text]
            parts += [own[i] for i in sorted(pick)]
        sides[y] = _dictionary(parts or [b"\n"], dictionary_bytes)
    good, bad = _compressor(sides[1]), _compressor(sides[0])
    x = np.array([difference(t, good, bad, block) for t, _ in held])
    slope, offset = _logistic(x, np.array([y for _, y in held], dtype=float))
    return CompressionModel(sides[1], sides[0], block, slope, offset)


def training_sample(docs: DataFrame, labels: DataFrame, *, text: str = "text", label: str = "quality",
                    key: str = "doc_id", per_label: int = 3000, chars: int = 16_000) -> list[tuple[str, int]]:
    """A bounded labelled sample: about ``per_label`` rows of each label, picked by a
    hash of ``key`` before the texts are touched, and of each up to ``chars``
    characters from a hashed place. Only this sample reaches the driver."""
    rated = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).alias("k"), (F.col(label) > 0).cast("int").alias("y"),
        F.xxhash64(F.col(key).cast("string"), F.lit(23)).alias("h"))
    counts = {r["y"]: r["n"] for r in rated.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return []
    share = F.create_map(*[F.lit(x) for y, n in sorted(counts.items())
                           for x in (y, min(1.0, 1.2 * per_label / n + 20 / n))])
    picked = (rated.where(F.pmod(F.col("h"), F.lit(1_000_000)) < share[F.col("y")] * 1_000_000)
              .limit(4 * per_label))
    body = F.coalesce(F.col("t"), F.lit(""))
    room = F.greatest(F.length(body) - chars, F.lit(0))
    rows = (docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
            .join(F.broadcast(picked), "k")  # at most 4 * per_label rows of three numbers
            .select(body.substr(F.pmod(F.xxhash64("h"), room + 1).cast("int") + 1, F.lit(chars)).alias("t"),
                    "y", "h").limit(4 * per_label).collect())
    out: dict[int, list] = {}
    for r in sorted(rows, key=lambda r: (r["h"], r["t"])):
        kept = out.setdefault(r["y"], [])
        if len(kept) < per_label:
            kept.append((r["t"], r["y"]))
    return [x for y in sorted(out) for x in out[y]]


def score(docs: DataFrame, model: CompressionModel, *, text: str = "text",
          keep: list[str] | None = None) -> DataFrame:
    """Score every whole text: the columns ``keep`` (default: all others but the
    text), size_difference, score, predicted."""
    keep = carried(docs, keep, [text], ["size_difference", "score", "predicted"])
    body = unused(docs, "text_")
    rows = docs.select(*keep, F.col(text).cast("string").alias(body))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema.fields]
                       + ["size_difference double", "score double", "predicted int"])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        pair = (_compressor(m.good), _compressor(m.bad)) if m.good and m.bad else None
        for pdf in batches:
            x = np.array([difference(t or "", *pair, m.block) if pair else 0.0 for t in pdf[body]], dtype=float)
            p = 1 / (1 + np.exp(-np.clip(m.slope * x + m.offset, -35, 35)))
            yield pdf.drop(columns=body).assign(size_difference=x, score=p,
                                                    predicted=(p >= 0.5).astype(np.int32))

    return rows.mapInPandas(rate, schema)
