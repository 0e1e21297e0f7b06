"""Token counts under a unigram model, by dynamic programming shared along a trie.

The model takes its pieces from a vocabulary file; a piece's log-probability
follows Zipf's law over its rank there: ``-log(rank + 1) - log(H)``, H the harmonic
sum over the vocabulary. A text's count is the number of pieces of its most
probable segmentation (fewer pieces on ties); characters that are no piece fall
back to their UTF-8 bytes at a penalty of 10 below the rarest piece.

Pre-tokens are inserted in a trie. The best score of a prefix depends on the
prefix only, so it is computed when its node is made and shared by every
pre-token that passes through; the count at a terminal is kept for the pre-token.
Each worker keeps its trie between batches and starts anew at ``most_nodes``, which
bounds its memory and never changes a count.

Defined cases: null and empty texts have 0 tokens. Repeated rows each get their
row; other columns are carried, and one named like an output column is replaced by it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import carried, unused, worker_cache
from quarry.llm.pieces import SPACE, Vocabulary

UNKNOWN_PENALTY = 10.0


def zipf_scores(vocabulary: Vocabulary) -> dict[str, float]:
    """Log-probability of each piece from its rank."""
    h = math.log(sum(1 / (r + 1) for r in vocabulary.rank.values()))
    return {p: -math.log(r + 1) - h for p, r in vocabulary.rank.items()}


class PrefixTrie:
    """Nodes carry the best score of their prefix and its number of pieces."""

    def __init__(self, vocabulary: Vocabulary, most_nodes: int = 800_000) -> None:
        self.vocabulary = vocabulary
        self.scores = zipf_scores(vocabulary)
        # Endings of pieces: a walk back from a character stops as soon as no piece
        # ends in what it has passed.
        self.endings: dict[str, float | None] = {}
        for p in self.scores:
            for k in range(len(p)):
                self.endings.setdefault(p[k:])
        self.endings.update(self.scores)
        self.unknown = min(self.scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.most_nodes = most_nodes
        self.reset()

    def reset(self) -> None:
        self.child: dict[tuple[int, str], int] = {}
        self.best: list[float] = [0.0]
        self.pieces: list[int] = [0]
        self.terminal: dict[str, int] = {}

    def part(self, s: str) -> int:
        """Insert one part; its number of pieces."""
        child, best, pieces, endings, scores = self.child, self.best, self.pieces, self.endings, self.scores
        path, node = [0], 0
        for i, c in enumerate(s):
            nxt = child.get((node, c))
            if nxt is None:
                top, few = -math.inf, 0
                for j in range(i, -1, -1):
                    ending = s[j:i + 1]
                    if ending not in endings:
                        break
                    score = endings[ending]
                    if score is not None:
                        before = path[j]
                        total, n = best[before] + score, pieces[before] + 1
                        if total > top or total == top and n < few:
                            top, few = total, n
                if c not in scores:
                    total = best[node] + self.unknown
                    if total > top:
                        top, few = total, pieces[node] + len(c.encode("utf-8", "surrogatepass"))
                nxt = child[node, c] = len(best)
                best.append(top)
                pieces.append(few)
            node = nxt
            path.append(node)
        return pieces[node]

    def insert(self, token: str) -> int:
        """Insert a pre-token, part by part where no piece crosses; its count."""
        n = self.terminal.get(token)
        if n is None:
            parts = self.vocabulary.parts(token)
            n = sum(map(self.part, parts)) if parts else len(SPACE.encode())
            self.terminal[token] = n
        return n


def count_tokens(docs: DataFrame, vocabulary: Vocabulary, *, text: str = "text",
                 keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default: all others but the text), n_pretokens, n_tokens."""
    keep, body = carried(docs, keep, [text], ["n_pretokens", "n_tokens"]), unused(docs, "text_")
    rows = docs.select(*keep, F.col(text).cast("string").alias(body))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema.fields]
                       + ["n_pretokens long", "n_tokens long"])
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = shared.value
        trie = worker_cache(("trie", v.key), lambda: PrefixTrie(v))
        for pdf in batches:
            words, tokens = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
            for i, t in enumerate(pdf[body]):
                if not t:
                    continue
                pre = v.pre_tokens(t)
                new = set(pre).difference(trie.terminal)
                for token in sorted(new):
                    trie.insert(token)
                words[i], tokens[i] = len(pre), sum(map(trie.terminal.__getitem__, pre))
                if len(trie.best) > trie.most_nodes:
                    trie.reset()
            yield pdf.drop(columns=body).assign(n_pretokens=words, n_tokens=tokens)

    return rows.mapInPandas(count, schema)
