"""Near-duplicate embeddings by NN-descent.

A neighbour graph starts from the leaves of random-projection trees and is refined
by neighbours-of-neighbours joins: every vector's neighbours, forward and reverse,
are compared with each other, and what beats the worst of a list enters it. A list
whose every entry is at or above the threshold is saturated and grows to twice its
length. When few entries change, the edges at or above the threshold are kept; their
components are then compared exactly, block by block, so every link inside a
component counts. A stated sample of vectors compared with all others audits the
recall, as a mean over vectors, so that those of one large cluster do not hide the
others, and apart over those with few links; below the target the search goes on
with twice the trees, and fails when that does not reach it.

Equal vectors are one node with a multiplicity, so copies are never paired. Reverse
lists, leaves and components are dealt out in blocks of bounded length; no group is
ever gathered whole. Work between the rounds is written to the shared folder.

Cosine is computed in double precision. Defined cases: vectors that are null, empty,
zero, or hold a null or non-finite component link with nothing (n_links 0, their own
component); vectors of different lengths link with nothing of another length. Every row
gives a row: repeated rows count each other as links, rows that share an id but not a
vector have each their own links, and a null id is no smallest id (the component of null
ids alone is null). An empty table gives an empty result. Other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Columns, components, in_groups, materialise

_EDGE = "src long, dst long, sim double"


def _matrix(vectors: np.ndarray) -> np.ndarray:
    """Unit rows in double precision."""
    x = np.stack(vectors).astype(np.float64)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def nodes_of(rows: DataFrame, key: str, vector: str, attempts: int = 20) -> tuple[DataFrame, DataFrame]:
    """(nodes, members): the distinct usable vectors (node, same, copies, low, dim, vec),
    ``low`` their smallest id, and (id, same) of every row, ``same`` null for unusable
    vectors. A node is named by its content, never by an id, which may have several."""
    v = F.col("vec")
    usable = v.isNotNull() & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False)) \
        & F.exists(v, lambda x: x != 0)
    # 256 bits of the vector's exact values stand for it.
    same = F.when(F.coalesce(usable, F.lit(False)), F.sha2(F.to_json(F.struct("vec")), 256))
    all_rows = rows.select(F.col(key).alias("id"), F.col(vector).alias("vec")).withColumn("same", same)
    classes = (all_rows.where(F.col("same").isNotNull()).groupBy("same")
               .agg(F.count("*").alias("copies"), F.min("id").alias("low"), F.first("vec").alias("vec")))
    for attempt in range(attempts):
        nodes = materialise(classes.select(F.xxhash64("same", F.lit(attempt)).alias("node"), "same", "copies", "low",
                                           F.size("vec").alias("dim"), "vec"), "nodes")
        if nodes.groupBy("node").count().where("count > 1").isEmpty():
            return nodes, all_rows.select("id", "same")
    raise RuntimeError("no distinct numbers for the distinct vectors")


def leaf_edges(nodes: DataFrame, n: int, k: int, trees: range, leaf: int, seed: int) -> DataFrame:
    """Best ``k`` neighbours of each node within its leaf of every tree. A tree's leaf
    is the signs on enough random planes for about ``leaf`` nodes; a leaf that holds
    more is dealt out in chunks of about ``2 * leaf``."""
    planes = max(0, math.ceil(math.log2(max(1, n / leaf))))

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for dim, part in pdf.groupby("dim"):
                x = _matrix(part["vec"].to_numpy())
                for t in trees:
                    rng = np.random.default_rng([seed, t, int(dim)])
                    signs = (x @ rng.standard_normal((int(dim), planes)) > 0).astype(np.int64)
                    out.append(pd.DataFrame({"node": part["node"].to_numpy(), "tree": t, "dim": dim,
                                             "leaf": signs @ (1 << np.arange(planes, dtype=np.int64))}))
            if out:
                yield pd.concat(out)

    coded = nodes.select("node", "dim", "vec").mapInPandas(code, "node long, tree int, dim int, leaf long")
    coded = materialise(coded, "leaves")
    sizes = coded.groupBy("tree", "dim", "leaf").agg(F.ceil(F.count("*") / (2 * leaf)).alias("chunks"))
    dealt = (coded.join(sizes, ["tree", "dim", "leaf"])
             .withColumn("chunk", F.pmod(F.xxhash64("node", "tree"), F.col("chunks")))
             .join(nodes.select("node", "vec"), "node"))

    def nearest(cols: Columns, at: int, end: int) -> tuple:
        ids, x = cols["node"][at:end], _matrix(cols["vec"][at:end])
        sims = x @ x.T
        np.fill_diagonal(sims, -2)
        take = min(k, len(ids) - 1)
        if take < 1:
            return [], [], []
        best = np.argpartition(-sims, take - 1, axis=1)[:, :take]
        return np.repeat(ids, take), ids[best.ravel()], np.take_along_axis(sims, best, axis=1).ravel()

    return in_groups(dealt, ["tree", "dim", "leaf", "chunk"], ["node"], _EDGE, nearest)


def best_lists(edges: DataFrame, lists: DataFrame | None, k: int, threshold: float) -> DataFrame:
    """The best entries of each node: src, dst, sim, fresh, k. ``lists`` says how long
    a list may be (null: ``k``); one that is full of links doubles its length."""
    own = edges.groupBy("src", "dst").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    longest = F.lit(k) if lists is None else F.coalesce(F.col("k"), F.lit(k))
    if lists is not None:
        own = own.join(lists, "src", "left")
    ranked = own.select("src", "dst", "sim", "fresh", longest.alias("k")).withColumn(
        "at", F.expr("row_number() over (partition by src order by sim desc, dst)"))
    return ranked.where("at <= k").withColumn(
        "full", F.expr(f"count_if(sim >= {threshold}) over (partition by src) >= k")).select(
        "src", "dst", "sim", "fresh", F.when(F.col("full"), F.col("k") * 2).otherwise(F.col("k")).alias("k"))


def refine(graph: DataFrame, nodes: DataFrame, threshold: float, block: int) -> DataFrame:
    """One neighbours-of-neighbours join: proposals (src, dst, sim) that beat the
    worst entry of src's list. Only around nodes with a fresh entry, and only pairs
    with one; lists longer than ``block`` are dealt out in blocks of it."""
    both = graph.select(F.col("src").alias("v"), F.col("dst").alias("p"), "fresh").union(
        graph.select(F.col("dst").alias("v"), F.col("src").alias("p"), "fresh"))
    both = both.groupBy("v", "p").agg(F.max("fresh").alias("fresh"))
    degree = both.groupBy("v").agg(F.ceil(F.count("*") / block).alias("blocks"), F.max("fresh").alias("any"))
    worst = graph.groupBy("src").agg(
        F.when(F.count("*") >= F.max("k"), F.min("sim")).otherwise(F.lit(-1.0)).alias("worst"))
    near = (both.join(degree.where("any"), "v")
            .select("p", "v", "fresh", F.pmod(F.xxhash64("p", "v"), F.col("blocks")).alias("block"))
            .join(worst, F.col("p") == F.col("src")).drop("src")
            .join(nodes.select(F.col("node").alias("p"), "vec"), "p"))

    def meet(cols: Columns, at: int, end: int) -> tuple:
        ids, x = cols["p"][at:end], _matrix(cols["vec"][at:end])
        sims = x @ x.T
        fresh = cols["fresh"][at:end].astype(bool)
        better = (sims > cols["worst"][at:end, None]) & (fresh[:, None] | fresh[None, :])
        np.fill_diagonal(better, False)
        i, j = np.nonzero(better)
        return ids[i], ids[j], sims[i, j]

    return in_groups(near, ["v", "block"], ["p"], _EDGE, meet)


def neighbour_graph(nodes: DataFrame, n: int, *, k: int, threshold: float, trees: range, leaf: int,
                    rounds: int, settled: float, block: int, seed: int, start: DataFrame | None = None) -> DataFrame:
    """The refined graph (src, dst, sim, fresh, k)."""
    fresh = leaf_edges(nodes, n, k, trees, leaf, seed).withColumn("fresh", F.lit(True))
    if start is not None:
        fresh = fresh.union(start.select("src", "dst", "sim", F.lit(False)))
    lists = None if start is None else start.groupBy("src").agg(F.max("k").alias("k"))
    graph = materialise(best_lists(fresh, lists, k, threshold), "graph")
    for _ in range(rounds):
        entries, changed = graph.agg(F.count("*"), F.count_if("fresh")).first()
        if changed <= settled * entries:
            break
        found = refine(graph, nodes, threshold, block).withColumn("fresh", F.lit(True))
        known = graph.select("src", "dst", "sim", F.lit(False).alias("fresh"))
        lists = graph.groupBy("src").agg(F.max("k").alias("k"))
        graph = materialise(best_lists(found.union(known), lists, k, threshold), "graph")
    return graph


def block_links(nodes: DataFrame, comp: DataFrame, threshold: float, block: int) -> DataFrame:
    """Exact links within components: (node, links, partners): the vectors (copies
    counted) and nodes linked with each node. A component of m nodes is dealt out in
    blocks, and each pair of blocks is one group, so groups stay bounded."""
    sizes = comp.groupBy("component").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    placed = comp.join(sizes, "component").withColumn("b", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    cells = placed.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "node", "component", "b", F.least("b", "o").alias("lo"), F.greatest("b", "o").alias("hi"))
    rows = cells.join(nodes, "node")

    def count(cols: Columns, at: int, end: int) -> tuple:
        x, own = _matrix(cols["vec"][at:end]), cols["b"][at:end]  # links join equal lengths only
        linked = x @ x.T >= threshold
        np.fill_diagonal(linked, False)
        if cols["lo"][at] != cols["hi"][at]:  # pairs within one block are another group's
            linked &= own[:, None] != own[None, :]
        return cols["node"][at:end], linked @ cols["copies"][at:end], linked.sum(axis=1)

    counted = in_groups(rows, ["component", "lo", "hi"], ["node"], "node long, links long, partners long", count)
    return counted.groupBy("node").agg(F.sum("links").alias("links"), F.sum("partners").alias("partners"))


def audit(nodes: DataFrame, links: DataFrame, threshold: float, queries: int, n: int, few: int) -> float:
    """Recall: of the links that each of up to ``queries`` hashed nodes has among all
    nodes, the share that ``links`` (node, partners) counts; the mean over the nodes with
    a link, or over those with at most ``few`` if that is less. The queries, a bounded
    number of vectors, meet every row block by block."""
    share = min(1.0, queries / max(1, n))
    picked = nodes.where(F.pmod(F.xxhash64("node", F.lit(99)), F.lit(1_000_000)) < share * 1_000_000).limit(2 * queries)
    asked = picked.select("node", "dim", "vec").toPandas()
    if asked.empty:
        return 1.0
    sides = {int(d): (g["node"].to_numpy(), _matrix(g["vec"].to_numpy())) for d, g in asked.groupby("dim")}
    shared = nodes.sparkSession.sparkContext.broadcast(sides)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for dim, part in pdf.groupby("dim"):
                if int(dim) in shared.value:
                    ids, q = shared.value[int(dim)]
                    hits = ((q @ _matrix(part["vec"].to_numpy()).T >= threshold)
                            & (ids[:, None] != part["node"].to_numpy()[None, :])).sum(axis=1)
                    yield pd.DataFrame({"node": ids, "truth": hits})[hits > 0]

    truth = nodes.select("node", "dim", "vec").mapInPandas(search, "node long, truth long").groupBy("node").agg(
        F.sum("truth").alias("truth"))
    share = F.coalesce("partners", F.lit(0)) / F.col("truth")
    row = truth.join(links, "node", "left").agg(F.avg(share), F.avg(F.when(F.col("truth") <= few, share))).first()
    return min((x for x in row if x is not None), default=1.0)


def near_duplicates(rows: DataFrame, *, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.9,
                    k: int = 6, trees: int = 8, leaf: int = 128, rounds: int = 6, settled: float = 0.01,
                    block: int = 64, cell: int = 512, audit_queries: int = 512, least_recall: float = 0.97,
                    most_searches: int = 4, seed: int = 31) -> DataFrame:
    """One row per row: ``key``, n_links, component_id, kept, audit_recall. Raises when the
    audited recall is below ``least_recall`` after ``most_searches``, each with twice the
    trees of the one before."""
    nodes, members = nodes_of(rows, key, vector)
    n = nodes.count()
    graph, recall = None, 0.0
    for search in range(most_searches):
        graph = neighbour_graph(nodes, n, k=k, threshold=threshold, leaf=leaf, rounds=rounds, settled=settled,
                                trees=range(((1 << search) - 1) * trees, ((2 << search) - 1) * trees), block=block, seed=seed, start=graph)
        edges = graph.where(F.col("sim") >= threshold).select(F.col("src").alias("a"), F.col("dst").alias("b"))
        comp = materialise(components(edges), "components")
        links = materialise(block_links(nodes, comp, threshold, cell), "links")
        recall = audit(nodes, links, threshold, audit_queries, n, k)
        if recall >= least_recall:
            break
    else:
        raise RuntimeError(f"audited recall {recall:.4f} is below {least_recall} after {most_searches} searches")
    named = nodes.select("node", "same", "copies", "low").join(comp, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("low").alias("component_id"))
    # Written, so that a vector that a third of all rows hold is split in the join below.
    by_same = materialise(named.join(links, "node", "left").join(least, "component").select(
        "same", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "classes")
    out = members.join(by_same, "same", "left")
    component = F.when(F.col("same").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"),
                      F.lit(float(recall)).alias("audit_recall"))
