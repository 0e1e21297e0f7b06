"""Helpers shared by the corpus operators: reading, intermediate tables, components."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir

#: A word: a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Paths of the tables written in the open ``scratch`` scopes, innermost last.
_SCOPES: list[list[str]] = []


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: cuts the
    lineage with files every executor can read, and recomputes nothing later. The files
    stay until they are discarded (``discard``, ``scratch``, ``drop_intermediates``), since
    results read them when they are used."""
    spark = df.sparkSession
    path = f"{_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    for scope in _SCOPES[-1:]:
        scope.append(path)
    release(spark)
    return out


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner find the shuffle files of the steps behind the last written
    table: it deletes those whose plans the driver's collector has seen gone, which on its
    own it does every half hour only."""
    spark.sparkContext._jvm.System.gc()


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def discard(spark: SparkSession, *tables: DataFrame | str) -> None:
    """Delete written tables that nothing reads any more."""
    for t in tables:
        if path := t if isinstance(t, str) else t.__dict__.get("written_to"):
            _delete(spark, path)
    release(spark)


@contextlib.contextmanager
def scratch() -> Iterator[list[str]]:
    """The paths of all tables that ``materialise`` writes inside."""
    _SCOPES.append([])
    try:
        yield _SCOPES[-1]
    finally:
        inner = _SCOPES.pop()
        for scope in _SCOPES[-1:]:
            scope.extend(inner)


def _folder(spark: SparkSession) -> str:
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/quarry-llm/{spark.sparkContext.applicationId}"


def drop_intermediates(spark: SparkSession) -> None:
    """Delete the tables that operators of this application have written in between.
    Call it when their results have been written or are not needed any more."""
    _delete(spark, _folder(spark))


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once a row: a lambda variable is bound
    to it, where a plain reference inside a lambda is computed for every element."""
    return F.get(F.transform(F.array(value), body), 0)


def crc_mod(col: str, m: int) -> Column:
    """crc32 of the id written as text, modulo ``m`` (null ids: null)."""
    return F.pmod(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(m))


_WORKER: dict[object, object] = {}


def worker_cache(key: object, make: Callable[[], object]) -> object:
    """The cache ``key`` of this Python worker, made when it is not there. A worker
    serves the tasks of many operators; it keeps the cache of the last one only."""
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = make()
    return _WORKER[key]


def give_back() -> None:
    """Return to the system what this Python worker has freed: it lives on through the
    stages behind, and else keeps what its largest task had."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def carried(docs: DataFrame, keep: list[str] | None, without: list[str], new: list[str]) -> list[str]:
    """The input columns an operator hands on: ``keep``, or all but ``without``. A
    column named like one of the operator's ``new`` ones is replaced by it."""
    keep = [c for c in docs.columns if c not in without] if keep is None else keep
    return [c for c in keep if c not in new]


def unused(docs: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


Columns = dict[str, np.ndarray]


def in_groups(rows: DataFrame, keys: list[str], order: list[str], schema: str,
              work: Callable[[Columns, int, int], tuple[Sequence, ...]]) -> DataFrame:
    """``work`` on each group of ``keys`` (all columns and the group's range of rows),
    many small groups a batch: rows are dealt by the keys and sorted, and a group that
    runs over a batch's end is carried over. ``work`` returns the columns of ``schema``."""
    names = [c.split()[0] for c in schema.split(", ")]

    def frame(parts: list[tuple[Sequence, ...]]) -> pd.DataFrame:
        return pd.DataFrame({c: np.concatenate([np.asarray(p[k]) for p in parts]) for k, c in enumerate(names)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Columns | None = None
        for pdf in batches:
            cols = {c: pdf[c].to_numpy() for c in pdf.columns}
            if held is not None:
                cols = {c: np.concatenate([held[c], x]) for c, x in cols.items()}
            n = len(cols[keys[0]])
            if not n:
                continue
            new = np.zeros(n - 1, dtype=bool)
            for k in keys:
                new |= cols[k][1:] != cols[k][:-1]
            cuts = [0, *(np.nonzero(new)[0] + 1).tolist()]
            out = [r for at, end in zip(cuts, cuts[1:]) if len((r := work(cols, at, end))[0])]
            held = {c: x[cuts[-1]:] for c, x in cols.items()}
            if out:
                yield frame(out)
        if held is not None and len((r := work(held, 0, len(held[keys[0]])))[0]):
            yield frame([r])

    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(run, schema)


def spanning(edges: DataFrame, each: int = 100_000) -> DataFrame:
    """Edges (u, v), u > v, that connect what ``edges`` does: of every ``each`` edges of a
    partition a spanning forest, its nodes tied to the smallest one. A group whose every
    pair is an edge shrinks to about its nodes before it is moved."""
    def forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []

        def trees() -> pd.DataFrame:
            up: dict[int, int] = {}
            for a, b in np.concatenate(held).tolist():
                for x in (a, b):
                    up.setdefault(x, x)
                while up[a] != a:
                    up[a] = a = up[up[a]]
                while up[b] != b:
                    up[b] = b = up[up[b]]
                if a != b:
                    up[max(a, b)] = min(a, b)
            out = []
            for x in up:
                root = x
                while up[root] != root:
                    root = up[root]
                if root != x:
                    out.append((x, root))
            return pd.DataFrame(out, columns=["u", "v"], dtype="int64")

        for pdf in batches:
            held.append(pdf[["u", "v"]].to_numpy())
            if sum(map(len, held)) >= each:
                yield trees()
                held.clear()
        if held:
            yield trees()

    return edges.mapInPandas(forest, "u long, v long")


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected edge list by alternating large-star
    and small-star rounds: (node, component), component = the smallest node.
    Nodes without an edge to another node do not appear.

    Each round is two aggregations (combined map-side) and two joins on the
    node, so a hub is split like any skewed join key; nothing is collected but
    one checksum row per round. A round is written and read by the next, so its plan
    runs once and what it left on the driver goes before the next begins; the last one's
    table stays, as the result reads it. Raises when it has not settled in
    ``max_rounds`` (it halves path lengths, so 60 is far beyond any input).
    """
    e = edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).where("u <> v")
    e = materialise(spanning(e).distinct(), "round")
    before = None
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(low, "u")
        done, e = e, materialise(linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
                                 .union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "round")
        discard(edges.sparkSession, done)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = now
    raise RuntimeError("connected components did not settle")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
