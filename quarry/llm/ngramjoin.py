"""N-gram Jaccard join by prefix trees.

A document is the set of its distinct word n-grams, each a 64-bit hash, and the
order of the hashes is the global order of n-grams. Equal sets are one node. The
join finds every pair of nodes with Jaccard similarity at or above the threshold:

1. *Families.* Two linked sets share one of their first ``n - ceil(t n) + 1`` n-grams
   in any one order. The order puts n-grams that ``hot`` or more sets share last
   (among the first ones looked at), so a passage that many documents quote makes no
   candidates, unless a document consists of such n-grams; only such *dense*
   documents also meet others at hot n-grams, in ranges of set size. Documents that
   meet are kept together if a histogram of their hashes, which bounds the overlap
   from above, allows the threshold. Families are the components of these
   candidates; they only need to be coarse enough, never exact.
2. *Trees.* Within a family the sets, ordered by how many members hold an n-gram, are
   stored in a compressed trie. Each set walks the trie once: the overlap with a
   shared prefix is counted once for all sets below it, and a subtree is left when
   overlap plus remaining length cannot reach what its set sizes require. What
   remains at a set's end is an exact comparison.
3. *Components* of the links.

Families, and the documents that meet at an n-gram, are dealt out in blocks of
bounded size, every pair of blocks being one group; groups return a spanning forest
of their links, never all pairs. Texts are read whole, twice, and dealt to the groups as
texts, whose shuffle compresses, where hashes of n-grams do not. What deals out n-grams
or their rows does so in parts, one after another, so that only one part's shuffle files
are on disk.

Defined cases: texts are lower-cased in A-Z only, words are separated by the six
ASCII white-space characters; with fewer than n words the whole sequence is the only
n-gram; without words (or with a null text) the set is empty and links with nothing.
A row has its text's component, whatever other texts stand under its id; the
component's number is the smallest id in it. A row with a null id has a null
component. Repeated rows each get their row. Other columns are ignored.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import Columns, components, discard, in_groups, materialise, union_all, worker_cache

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x2545F4914F6CDD1D, 0x9FB21C651E98DF25], dtype=np.uint64)
#: Hash bins of the overlap bound: one for about this many n-grams.
_PER_BIN = 8


class _WordHashes(dict):
    """word -> 64-bit hash; forgets all when it holds ``most`` words."""

    most = 200_000

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h



def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes (int64) of a text's word n-grams."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.int64)
    known = worker_cache("word hashes", _WordHashes)
    if len(known) > known.most:
        known.clear()
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    width = min(n, len(h))
    s = np.full(len(h) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        s = (s ^ (s >> np.uint64(29))) * _MIX[k % 8] + h[k:len(h) - width + 1 + k]
    s = (s ^ (s >> np.uint64(32))) * _MIX[0]
    s ^= s >> np.uint64(29)
    return np.unique(s.view(np.int64))


def least_overlap(size, percent: int):
    """Smallest overlap a set of ``size`` has with any set it links with."""
    return -(-percent * size // 100)


def bins_of(size) -> np.ndarray:
    """log2 of the number of bins for a set of ``size``."""
    return np.maximum(np.ceil(np.log2(np.maximum(size, 1) / _PER_BIN)), 3).astype(np.int64)


def histogram(s: np.ndarray) -> bytes:
    """Counts of hashes by their low bits; empty (no bound) if one passes 255."""
    bins = 1 << int(bins_of(len(s)))
    counts = np.bincount((s & (bins - 1)).astype(np.int64), minlength=bins)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else b""


def text_hash(text: str) -> Column:
    """Tells apart the texts of one id (a null text is an empty one)."""
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def set_rows(docs: DataFrame, text: str, key: str, n: int, percent: int) -> DataFrame:
    """(id, text_hash, size, same, first, bins): set size, 128 bits standing for the set,
    its first n-grams in the global order (a quarter more than the prefix) and histogram."""
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"),
                       text_hash(text).alias("text_hash"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for text_ in pdf["text"]:
                s = shingles(text_, n)
                prefix = len(s) - least_overlap(len(s), percent) + 1
                out.append((len(s), xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None,
                            s[:prefix + prefix // 4 + 8], histogram(s) if len(s) else b""))
            yield pd.DataFrame({"id": pdf["id"], "text_hash": pdf["text_hash"], "size": [x[0] for x in out], "same": [x[1] for x in out],
                                "first": [x[2] for x in out], "bins": [x[3] for x in out]})

    return rows.mapInPandas(read, "id long, text_hash long, size long, same string, first array<long>, bins binary")


class _Forest:
    """Union-find over small ints that says which links join two trees."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True


def _fold(bins: list[bytes], logs: np.ndarray, log: int) -> np.ndarray:
    """Histograms as rows of 2**log counts; larger ones folded, rows without a bound
    get counts that bound nothing."""
    out = np.empty((len(bins), 1 << log), dtype=np.uint16)
    for i, (b, own) in enumerate(zip(bins, logs)):
        if len(b) != 1 << own:
            out[i] = 60_000
        else:
            out[i] = np.frombuffer(b, np.uint8).reshape(1 << (own - log), 1 << log).sum(axis=0)
    return out


def overlap_bound(x: bytes, y: bytes) -> int:
    """Upper bound of the overlap of two sets by their histograms."""
    if len(x) < len(y):
        x, y = y, x
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    if len(a) > len(b):
        a = a.reshape(-1, len(b)).sum(axis=0)
    return int(np.minimum(a, b).sum())


def possible_links(cols: Columns, at: int, end: int, percent: int) -> tuple[list, list]:
    """A spanning forest of the pairs that size and histogram leave possible among
    documents meeting at one n-gram (rows by size); where it is hot, of the pairs with
    a dense document, and in a pair of blocks of the pairs across."""
    n = end - at
    size, ids, bins = cols["size"][at:end], cols["node"][at:end], cols["bins"][at:end]
    dense, block = cols["dense"][at:end], cols["block"][at:end]
    hot, across = bool(cols["hot"][at]), cols["lo"][at] != cols["hi"][at]
    forest, a, b = _Forest(n), [], []
    if n <= 12:
        for i in range(n - 1):
            for j in range(i + 1, n):
                if 100 * size[i] < percent * size[j]:
                    break
                if hot and not (dense[i] or dense[j]) or across and block[i] == block[j]:
                    continue
                if forest.root(i) == forest.root(j):
                    continue
                bound = overlap_bound(bins[i], bins[j]) if bins[i] and bins[j] else size[i]
                if 100 * bound >= percent * (size[i] + size[j] - bound):
                    forest.join(i, j)
                    a.append(ids[i])
                    b.append(ids[j])
        return a, b
    logs = bins_of(size)
    folded: dict[int, tuple[int, np.ndarray]] = {}
    label = np.arange(n)  # grows stale only towards more comparisons
    for i in range(n - 1):
        top = int(np.searchsorted(size, size[i] * 100 // percent, side="right"))
        j = np.arange(i + 1, top)
        if hot and not dense[i]:
            j = j[dense[i + 1:top]]
        if across:
            j = j[block[j] != block[i]]
        j = j[label[j] != label[i]]
        if not len(j):
            continue
        log = int(logs[i])
        if log not in folded or j[-1] - folded[log][0] >= len(folded[log][1]):
            last = max(top, int(np.searchsorted(logs, log, side="right")))
            folded = {log: (i, _fold(bins[i:last], logs[i:last], log))}
        low, m = folded[log]
        bound = np.empty(len(j), dtype=np.int64)
        step = max(1, 4_000_000 >> log)
        for k in range(0, len(j), step):
            bound[k:k + step] = np.minimum(m[i - low], m[j[k:k + step] - low]).sum(axis=1, dtype=np.int64)
        ok = 100 * bound >= percent * (size[i] + size[j] - bound)
        for other in j[ok]:
            if forest.join(i, int(other)):
                a.append(ids[i])
                b.append(ids[other])
        if ok.any():
            label[j[ok]] = label[i]
    return a, b


@contextlib.contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Spark settings for the jobs that run inside."""
    before = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


#: Runtime Bloom filters (of bounded size, spark.sql.optimizer.runtime.bloomFilter.maxNumBits)
#: also before joins of small scans: rows without a partner are left out before the shuffle.
RUNTIME_FILTERS = {f"spark.sql.optimizer.runtime.bloomFilter.{k}": v for k, v in (
    ("enabled", "true"), ("applicationSideScanSizeThreshold", "0"), ("creationSideThreshold", "1g"))}
#: Rows handed to Python at once: whole texts, of which a worker holds several forms.
SMALL_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


def shared_grams(nodes: DataFrame, sets: DataFrame, hot: int, part: int, parts: int) -> DataFrame:
    """(node, g) for the first n-grams of ``nodes`` that ``sets`` hold twice or more, of one
    part of all n-grams."""
    own = F.pmod("gram", F.lit(parts)) == part
    grams = nodes.select("node", F.posexplode("first").alias("pos", "gram")).where(own)
    shared = (sets.select(F.explode("first").alias("gram")).where(own).groupBy("gram")
              .agg(F.count("*").alias("df")).where("df >= 2"))
    return grams.join(shared, "gram").select("node", F.struct("pos", "gram", (F.col("df") >= hot).alias("hot")).alias("g"))


def families(nodes: DataFrame, sets: DataFrame, percent: int, hot: int, block: int, parts: int = 4) -> DataFrame:
    """(node, component) of the candidate families, from rows (node, size, first, bins)
    and the rows whose n-grams are counted (the nodes or others beside them: their
    number only moves n-grams in the order). ``parts``: of the n-grams, dealt out in turn."""
    dealt_out = [materialise(shared_grams(nodes, sets, hot, part, parts), "met") for part in range(parts)]
    met = union_all(dealt_out)
    # Each document's shared first n-grams, at most as many as its ``first``.
    mine = met.groupBy("node").agg(F.array_sort(F.collect_list("g")).alias("g"))
    size = F.col("size")
    prefix = size - F.ceil(size * percent / 100) + 1
    number_hot = F.size(F.filter("g", lambda g: g["hot"]))
    dense = F.col("n_first") - number_hot < F.least(prefix, size)
    rows = mine.join(nodes.select("node", "size"), "node").withColumn(
        "n_first", F.least(size, prefix + F.floor(prefix / 4) + 8)).select("node", "size", "g", prefix.alias("prefix"), dense.alias("dense"))
    # Place among the n-grams that are not hot: all places before, less the hot ones.
    usual = F.filter("g", lambda g: ~g["hot"] & (
        g["pos"] - F.size(F.filter("g", lambda h: h["hot"] & (h["pos"] < g["pos"]))) < F.col("prefix")))
    plain = F.filter("g", lambda g: g["pos"] < F.col("prefix"))
    plain_hot = F.filter("g", lambda g: g["hot"] & (g["pos"] < F.col("prefix")))
    chosen = (F.when(F.col("dense") | (number_hot == 0), plain).otherwise(F.concat(usual, plain_hot)))
    spread = rows.select("node", "size", "dense", F.explode(chosen).alias("g")).select(
        "node", "size", "dense", F.col("g.gram").alias("gram"), F.col("g.hot").alias("hot"))
    # At hot n-grams only groups with a dense document matter, and only within a
    # range of sizes: each document enters its own range and the next.
    band = F.floor(F.log(F.col("size")) / F.log(F.lit(100 / percent)) + 1e-9).cast("int")
    spread = spread.select("*", F.explode(F.when(F.col("hot"), F.array(band, band + 1)).otherwise(
        F.array(F.lit(-1)))).alias("band"))
    spread = materialise(spread, "meetings")
    discard(nodes.sparkSession, *dealt_out)
    # Near copies meet at many n-grams: of the groups of the same documents (two
    # 64-bit sums of their hashes) one is enough, a usual one where there is one, as
    # it compares all pairs and a hot one only those with a dense document.
    groups = (spread.groupBy("gram", "band").agg(
        F.count("*").alias("n"), F.max("dense").alias("any"), F.max("hot").alias("h"),
        F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
        .where("n >= 2 and (any or not h)")
        .groupBy("x", "y", "n").agg(F.min(F.struct("h", "gram", "band")).alias("g"))
        .select("g.gram", "g.band", F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    dealt = (spread.drop("size").join(groups, ["gram", "band"])
             .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
             .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("lo", F.least("block", "o")).withColumn("hi", F.greatest("block", "o"))
             .drop("o", "blocks")
             .join(nodes.select("node", "size", "bins"), "node"))
    edges = in_groups(dealt, ["gram", "band", "lo", "hi"], ["size", "node"], "a long, b long",
                      lambda cols, at, end: possible_links(cols, at, end, percent))
    # Written before their components: two steps of Python in one task are two workers a
    # core, and each keeps the memory of all that it ran.
    edges = materialise(edges, "candidates")
    discard(nodes.sparkSession, spread)
    found = materialise(components(edges), "families")
    discard(nodes.sparkSession, edges)
    return found


class PrefixTree:
    """A compressed trie of ordered sets, as arrays; nodes in the order of a walk."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        """``sets``: sorted arrays of ranks, distinct."""
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u4").tobytes())
        self.order = np.array(order)
        begin, end, up, owner, final = [], [], [], [], []  # per node
        path: list[int] = []  # nodes from the root to the last set's end
        previous = np.zeros(0, dtype=np.int64)
        for i in order:
            s = sets[i]
            m = min(len(s), len(previous))
            differs = np.nonzero(s[:m] != previous[:m])[0]
            common = int(differs[0]) if len(differs) else m
            while path and begin[path[-1]] >= common:
                path.pop()
            if path and end[path[-1]] > common:  # split a node where the sets part
                x = path.pop()
                top = len(begin)
                begin.append(begin[x]); end.append(common); up.append(up[x]); owner.append(owner[x]); final.append(-1)
                begin[x], up[x] = common, top
                path.append(top)
            node = len(begin)
            begin.append(common); end.append(len(s)); up.append(path[-1] if path else -1); owner.append(i); final.append(i)
            if common == len(s) and path:  # ends where a node ends: cannot be, sets are distinct and sorted
                raise ValueError("sets are not distinct")
            path.append(node)
            previous = s
        self.begin, self.end, self.up = np.array(begin), np.array(end), np.array(up)
        self.final = np.array(final)
        self.last = np.array([sets[o][e - 1] for o, e in zip(owner, end)])
        length = self.end - self.begin
        self.offset = np.concatenate([[0], np.cumsum(length)])
        self.ranks = np.concatenate([sets[o][b:e] for o, b, e in zip(owner, begin, end)])
        n = len(begin)
        children: list[list[int]] = [[] for _ in range(n + 1)]
        for x in range(n):
            children[self.up[x]].append(x)  # the last list holds the root's
        self.child_at = np.concatenate([[0], np.cumsum([len(c) for c in children])])
        self.child = np.array([x for c in children for x in c], dtype=np.int64)
        # Sizes and places of the sets below a node; children come after... or were
        # split off before their node's number was given, so walk by depth.
        place = np.empty(len(sets), dtype=np.int64)
        place[self.order] = np.arange(len(order))
        self.place = place
        self.least = np.where(self.final >= 0, self.end, np.iinfo(np.int64).max)
        self.most = np.where(self.final >= 0, self.end, 0)
        self.furthest = np.where(self.final >= 0, place[self.final], -1)
        for x in np.argsort(-self.end, kind="stable"):
            p = self.up[x]
            if p >= 0:
                self.least[p] = min(self.least[p], self.least[x])
                self.most[p] = max(self.most[p], self.most[x])
                self.furthest[p] = max(self.furthest[p], self.furthest[x])

    def links(self, s: np.ndarray, own: int, mark: np.ndarray, percent: int) -> np.ndarray:
        """Sets later in the tree's order than place ``own`` that link with ``s``.
        ``mark``: scratch of zeros, one entry a rank."""
        size = len(s)
        mark[s] = 1
        low, high = -(-percent * size // 100), size * 100 // percent
        found = []
        front = self.child[self.child_at[-2]:self.child_at[-1]]
        overlap = np.zeros(len(front), dtype=np.int64)
        while len(front):
            stay = (self.furthest[front] > own) & (self.most[front] >= low) & (self.least[front] <= high)
            front, overlap = front[stay], overlap[stay]
            if not len(front):
                break
            a, b = self.offset[front], self.offset[front + 1]
            count = b - a
            ends = np.cumsum(count)
            at = np.arange(ends[-1]) + np.repeat(a - (ends - count), count)
            overlap = overlap + np.add.reduceat(mark[self.ranks[at]], ends - count)
            depth = self.end[front]
            used = np.searchsorted(s, self.last[front], side="right")
            fits = np.maximum(self.least[front], low)
            need = -(-percent * (size + fits) // (100 + percent))
            stay = overlap + np.minimum(size - used, self.most[front] - depth) >= need
            front, overlap = front[stay], overlap[stay]
            done = self.final[front]
            ended = done >= 0
            if ended.any():
                union = size + self.end[front] - overlap
                hit = ended & (100 * overlap >= percent * union)
                found.append(done[hit])
            counts = self.child_at[front + 1] - self.child_at[front]
            if not counts.sum():
                break
            ends = np.cumsum(counts)
            at = np.arange(ends[-1]) + np.repeat(self.child_at[front] - (ends - counts), counts)
            overlap = np.repeat(overlap, counts)
            front = self.child[at]
        mark[s] = 0
        out = np.concatenate(found) if found else np.zeros(0, dtype=np.int64)
        return out[self.place[out] > own]


def tree_join(ids: np.ndarray, sets: list[np.ndarray], percent: int,
              block: np.ndarray | None = None) -> tuple[list, list]:
    """A spanning forest of the links among distinct sets (sorted hashes); with
    ``block`` of the links between different blocks."""
    flat = np.concatenate(sets)
    _, inverse, held = np.unique(flat, return_inverse=True, return_counts=True)
    rank = np.empty(len(held), dtype=np.int64)
    rank[np.argsort(-held, kind="stable")] = np.arange(len(held))
    ranks = rank[inverse]
    cuts = np.cumsum([len(s) for s in sets])[:-1]
    ordered = [np.sort(r) for r in np.split(ranks, cuts)]
    tree, forest, a, b = PrefixTree(ordered), _Forest(len(sets)), [], []
    mark = np.zeros(len(held), dtype=np.int64)
    for i in tree.order:
        for j in tree.links(ordered[i], int(tree.place[i]), mark, percent):
            if (block is None or block[i] != block[j]) and forest.join(int(i), int(j)):
                a.append(ids[i])
                b.append(ids[j])
    return a, b


def family_links(cols: Columns, at: int, end: int, n: int, percent: int) -> tuple[list, list]:
    """A spanning forest of the links in a group of texts, one a node."""
    if end - at < 2:
        return [], []
    sets = [shingles(text, n) for text in cols["text"][at:end]]
    across = cols["lo"][at] != cols["hi"][at]
    return tree_join(cols["node"][at:end], sets, percent, cols["block"][at:end] if across else None)


def _further_nodes(classes: DataFrame, ids: DataFrame, attempts: int = 20) -> DataFrame:
    """(same, node) of the sets whose smallest id is already another set's node: ids with
    several texts. Their nodes are hashes, drawn anew until none is an id or another's."""
    taken = classes.groupBy("node").agg(F.count("*").alias("n"), F.min("same").alias("own")).where("n > 1")
    more = materialise(classes.join(taken, "node").where("same <> own").select("same"), "further")
    if more.isEmpty():
        return more.withColumn("node", F.lit(0).cast("long"))
    for attempt in range(attempts):
        named = more.withColumn("node", F.xxhash64("same", F.lit(attempt)))
        if (named.groupBy("node").count().where("count > 1").isEmpty()
                and named.join(ids, named["node"] == ids["id"], "left_semi").isEmpty()):
            return named
    raise RuntimeError("no free numbers for the further texts of ids")


def linked_components(docs: DataFrame, *, text: str = "text", key: str = "doc_id", n: int = 4, percent: int = 85,
                      hot: int = 64, block: int = 2048, cell: int = 3_000_000, stands: bool = False,
                      parts: int = 4) -> DataFrame:
    """One row per document: id, n_shingles, component_id. Sets link where ``100 *
    intersection >= percent * union``. ``cell``: n-grams of a family in one group. ``parts``:
    in which wide rows, and n-grams, are dealt out one after another. With ``stands`` also
    text_hash and stands: whether the row has the id and text that stand for its component
    (its smallest id); a row without words stands for itself."""
    with settings(docs.sparkSession, SMALL_BATCHES):
        sets = materialise(set_rows(docs, text, key, n, percent), "sets")
    rows = materialise(sets.select("id", "text_hash", "size", "same"), "rows")
    some = rows.where("size > 0 and id is not null")
    # A row for each id and set, and the smallest id (with one of its texts) for each set.
    classes = materialise(some.groupBy("same").agg(F.min(F.struct("id", "text_hash")).alias("least"))
                          .select("same", F.col("least.id").alias("node"), F.col("least.text_hash").alias("node_hash")),
                          "classes")
    further = _further_nodes(classes, some.select("id"))
    several = not further.isEmpty()
    if several:
        named = classes.withColumnRenamed("node", "least").join(further, "same", "left")
        classes = materialise(named.select("same", "least", F.coalesce("node", "least").alias("node"), "node_hash"), "classes")
    else:
        classes = classes.withColumn("least", F.col("node"))
    # One of the rows of each node, part by part, as the rows are wide.
    own = classes.withColumnRenamed("least", "id")
    wide = [materialise(sets.where("size > 0").where(F.pmod(F.xxhash64("id"), F.lit(parts)) == part).drop("text_hash")
                        .join(own, ["id", "same"]).dropDuplicates(["id", "same"]).drop("id"), "nodes") for part in range(parts)]
    nodes = union_all(wide)
    discard(docs.sparkSession, sets)
    about = nodes.select("node", "size", "same", "node_hash")
    family = families(nodes, nodes, percent, hot, block, parts)
    members = family.join(about, "node")
    weights = members.groupBy("component").agg(F.ceil(F.sum("size") / cell).cast("int").alias("blocks"))
    members = members.join(weights, "component").withColumn(
        "block", F.pmod(F.xxhash64("node", F.lit(5)), F.col("blocks")).cast("int"))
    members = materialise(members.select("node", "same", "node_hash", "component", "block", "blocks"), "members")
    # The first n-grams and histograms have done their work.
    discard(docs.sparkSession, family, *wide)
    texts = docs.select(F.col(key).cast("long").alias("node"), F.col(text).cast("string").alias("text"))
    # Of the texts and repeated rows under a node's id, one that has its set.
    dealt = (texts.join(members.where("blocks >= 1"), "node").where(text_hash("text") == F.col("node_hash"))
             .select("node", "component", "block", "blocks", "text").dropDuplicates(["node"]))
    if several:  # these meet their texts by the set, as their node is no id
        others = members.join(further.select("same"), "same", "left_semi")
        ids = classes.join(further.select("same"), "same", "left_semi").select(F.col("least").alias("node")).distinct()

        def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                yield pdf.assign(same=[xxhash.xxh3_128_hexdigest(shingles(t, n).tobytes()) for t in pdf["text"]])

        dealt = dealt.unionByName(
            texts.join(ids, "node", "left_semi").select("text").mapInPandas(hashed, "text string, same string")
            .join(others.where("blocks >= 1"), "same").select("node", "component", "block", "blocks", "text")
            .dropDuplicates(["node"]))
    # The texts are dealt out, not their n-grams.
    cells = (dealt
             .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("node", "component", "block", F.least("block", "o").alias("lo"),
                     F.greatest("block", "o").alias("hi"), "text"))
    links = in_groups(cells, ["component", "lo", "hi"], ["node"], "a long, b long",
                      lambda cols, at, end: family_links(cols, at, end, n, percent))
    with settings(docs.sparkSession, RUNTIME_FILTERS | SMALL_BATCHES):
        links = materialise(links, "links")
    discard(docs.sparkSession, members)
    comp = components(links)
    discard(docs.sparkSession, links)
    if several:  # numbered by the smallest id, with the set that holds it
        comp = materialise(comp, "components")
        head = comp.join(classes, "node").groupBy("component").agg(F.min(F.struct("least", "node")).alias("head"))
        comp = comp.join(head, "component").select("node", F.col("head.least").alias("component_id"),
                                                   F.col("head.node").alias("root"))
    else:
        comp = comp.select("node", F.col("component").alias("component_id"), F.col("component").alias("root"))
    rows = rows.join(classes, "same", "left").join(comp, "node", "left")
    out = ["id", F.col("size").alias("n_shingles"), F.coalesce("component_id", "least", "id").alias("component_id")]
    if stands:
        first = (F.col("id") == F.col("least")) & (F.col("text_hash") == F.col("node_hash")) & (
            F.coalesce("root", "node") == F.col("node"))
        out += ["text_hash", F.when(F.col("id").isNotNull(), F.coalesce(first, F.lit(True))).alias("stands")]
    return rows.select(*out)
