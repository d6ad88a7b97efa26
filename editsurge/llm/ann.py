"""Approximate nearest neighbours: an HNSW graph for each shard, results merged.

Every row is indexed.  Rows are dealt evenly into shards of about ``SHARD_ROWS``;
a task builds one shard's graph over its distinct vectors and returns it as flat
arrays, written to the shared folder.  Every query meets every shard: queries are cut
into chunks, shards are put into slots, and a task gets one chunk and one slot from two
exchanges (a cogroup, so neither side passes the driver, however small it seems to the
planner).  Finds are scored exactly in double precision on the original vectors; the best
of a slot leave the task and the best of all slots are kept.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components take no part, neither as query nor as candidate; vectors of different
length do not meet; equal vectors share one graph node, so any number of copies
cannot crowd a graph, and the smallest ids are taken from it; a repeated vec_id is
another candidate, and each of its rows a query of its own; ties go to the smaller
vec_id; null vec_ids are candidates after all others and never queries; fewer
candidates than wanted give all; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from editsurge.llm import hnsw
from editsurge.llm.common import cut, mix64, ship

SHARD_ROWS = 4096
#: About the bytes of query vectors, and of shards, that a search task holds.
CHUNK_BYTES = 8 << 20
SLOT_BYTES = 24 << 20
#: Slots wanted for each core; beyond it shards share a slot, as far as the bytes allow.
SLOTS_A_CORE = 4
SEARCH_WIDTH = 128
INDEX = "shard long, dim int, n int, vectors binary, links binary, entry int, top int, starts binary, ids binary, uids binary"
NO_ID = (1 << 63) - 1  # stands for a null vec_id


def usable(vectors: DataFrame) -> DataFrame:
    """(uid, vec_id, dim, embedding) of the rows that take part; uid tells rows apart."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    given = vectors.select("embedding").schema[0].dataType
    kind = "float" if isinstance(getattr(given, "elementType", None), FloatType) else "double"  # floats stay as short
    rows = vectors.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID)).alias("vec_id"),
                          F.col("embedding").cast(f"array<{kind}>").alias("embedding"))
    return cut(rows.filter(F.col("embedding").isNotNull() & (F.size("embedding") > 0)).filter(~bad & some)
                   .select(F.monotonically_increasing_id().alias("uid"), "vec_id", F.size("embedding").alias("dim"), "embedding"))


def _unit(x: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(axis=1, keepdims=True)
    return (scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))).astype(np.float32)


def _build(rows: pd.DataFrame) -> pd.DataFrame:
    """One shard's index row: distinct vectors, their rows' ids in ascending order, the graph."""
    ids = rows["vec_id"].to_numpy()
    order = np.lexsort((rows["uid"].to_numpy(), ids))
    x = np.stack(rows["embedding"].to_numpy()[order])
    ids, uids = ids[order], rows["uid"].to_numpy()[order].astype(np.int64)
    distinct, where = np.unique(x, axis=0, return_inverse=True)
    where = where.ravel()
    by_node = np.argsort(where, kind="stable")
    starts = np.searchsorted(where[by_node], np.arange(len(distinct) + 1))
    # insert in an order that does not follow the sort
    first = uids[by_node][starts[:-1]].astype(np.uint64)
    shuffle = np.argsort(mix64(first), kind="stable")
    rank = np.argsort(shuffle)
    distinct, heights = distinct[shuffle], (mix64(first[shuffle] + np.uint64(1)) >> np.uint64(11)) / 2.0 ** 53
    by_node = np.argsort(rank[where], kind="stable")
    starts = np.searchsorted(rank[where][by_node], np.arange(len(distinct) + 1))
    graph = hnsw.build(_unit(distinct.astype(np.float64)), heights)
    return pd.DataFrame([{
        "shard": rows["shard"].iat[0], "dim": distinct.shape[1], "n": len(distinct), "vectors": distinct.tobytes(),
        "links": b"".join(a.tobytes() for a in graph.links), "entry": graph.entry, "top": graph.top,
        "starts": starts.astype(np.int64).tobytes(), "ids": ids[by_node].tobytes(), "uids": uids[by_node].tobytes()}])


def build_index(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, list[tuple[int, int]]]:
    """The index table (a row for each shard), and the shards as (dim, shard)."""
    ship(rows.sparkSession)
    sizes = {r["dim"]: r["n"] for r in rows.groupBy("dim").agg(F.count("*").alias("n")).collect()}  # a row for each length
    shards = F.lit(None).cast("long")
    listed, base = [], 0
    for dim, n in sorted(sizes.items()):
        k = -(-n // shard_rows)
        shards = F.when(F.col("dim") == dim, base + F.pmod(F.xxhash64("uid"), F.lit(k))).otherwise(shards)
        listed += [(dim, base + i) for i in range(k)]
        base += k
    dealt = rows.select("uid", "vec_id", "embedding", shards.cast("int").alias("shard"))
    dealt = dealt.repartitionById(max(1, base), F.col("shard"))  # a shard takes seconds of work, whatever its bytes
    return cut(dealt.groupBy("shard").applyInPandas(_build, INDEX)), listed


def _load(row) -> tuple[hnsw.Graph, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n, dim = row["n"], row["dim"]
    vectors = np.frombuffer(row["vectors"], np.float32 if len(row["vectors"]) == 4 * n * dim else np.float64).reshape(n, dim).astype(np.float64)
    flat, links, at = np.frombuffer(row["links"], np.int32), [], 0
    for k in range(hnsw.LEVELS):
        width = hnsw.LINKS * (2 if k == 0 else 1)
        links.append(flat[at: at + n * width].reshape(n, width))
        at += n * width
    return (hnsw.Graph(_unit(vectors), links, row["entry"], row["top"]), vectors,
            *(np.frombuffer(row[c], np.int64) for c in ("starts", "ids", "uids")))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of rows of ``a`` with ``b``, in double precision."""
    return (a * b).sum(axis=-1) / (np.sqrt((a * a).sum(axis=-1)) * np.sqrt((b * b).sum(axis=-1)))


def _slots(shards: list[tuple[int, int]], cores: int) -> dict[int, tuple[int, int, int]]:
    """By dim: its first shard, the shards of a slot, the number of slots."""
    out = {}
    wanted = -(-len(shards) // (SLOTS_A_CORE * cores))
    for dim in {d for d, _ in shards}:
        own = [s for d, s in shards if d == dim]  # consecutive numbers
        share = max(1, min(wanted, SLOT_BYTES // (SHARD_ROWS * (8 * dim + 200))))
        out[dim] = own[0], share, -(-len(own) // share)
    return out


def search(rows: DataFrame, index: DataFrame, shards: list[tuple[int, int]], queries: DataFrame, k: int = 5,
           width: int = SEARCH_WIDTH) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` best finds for each query row."""
    spark = rows.sparkSession
    ship(spark)
    sizes = {r["dim"]: r["n"] for r in queries.groupBy("dim").agg(F.count("*").alias("n")).collect()}  # a row for each length
    slots = {d: x for d, x in _slots(shards, spark.sparkContext.defaultParallelism).items() if d in sizes}
    if not slots:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    asking = holding = F.lit(None).cast("array<int>")  # the groups of a query, and of a shard: one for each slot and chunk
    groups = 0
    for dim, (first, share, n) in slots.items():
        here, chunks = F.col("dim") == dim, -(-sizes[dim] * 8 * dim // CHUNK_BYTES)
        chunk = F.pmod(F.xxhash64("uid"), F.lit(chunks)).cast("int")
        slot = F.floor((F.col("shard") - first) / share).cast("int")
        asking = F.when(here, F.sequence(groups + chunk * n, groups + chunk * n + n - 1)).otherwise(asking)
        holding = F.when(here, F.sequence(groups + slot, groups + slot + n * (chunks - 1), F.lit(n))).otherwise(holding)
        groups += n * chunks
    sent = queries.select(F.explode(asking).alias("group"), "uid", "vec_id", "embedding")
    held = index.select(F.explode(holding).alias("group"), *index.columns)

    def run(asked: pa.Table, shards: pa.Table) -> pa.Table:
        best: dict[int, list] = {}
        uid, ids = (asked.column(c).to_pylist() for c in ("uid", "vec_id"))
        if uid and shards.num_rows:
            x = np.stack(asked.column("embedding").to_numpy()).astype(np.float64)
            unit = _unit(x)
            for at in range(shards.num_rows):
                graph, vectors, starts, names, uids = _load(shards.slice(at, 1).to_pylist()[0])
                for i, own in enumerate(uid):
                    nodes = np.array(graph.search(unit[i], width), dtype=np.int64)
                    scores = cosine(vectors[nodes], x[i])
                    if len(nodes) > k + 1:  # k others at least are as near as the nearest k + 1 nodes
                        near = ~(scores < np.partition(scores, -k - 1)[-k - 1])
                        nodes, scores = nodes[near], scores[near]
                    found = best.get(i, [])
                    for node, s in zip(nodes.tolist(), scores.tolist()):
                        for j in range(starts[node], min(starts[node + 1], starts[node] + k + 1)):
                            if uids[j] != own:
                                found.append((-s, int(names[j]), int(uids[j])))
                    best[i] = sorted(found)[:k]
        out = [(uid[i], ids[i], name, u, -away) for i, found in best.items() for away, name, u in found]
        return pa.table([pa.array([x[c] for x in out], t) for c, t in enumerate([pa.int64()] * 4 + [pa.float64()])],
                        names=["query_uid", "query_id", "vec_id", "uid", "score"])

    both = [df.repartitionById(groups, F.col("group")).groupBy("group") for df in (sent, held)]
    finds = both[0].cogroup(both[1]).applyInArrow(run, "query_uid long, query_id long, vec_id long, uid long, score double")
    best = Window.partitionBy("query_uid").orderBy(F.desc("score"), "vec_id", "uid")
    return (finds.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
                 .select("query_id", "rank", F.when(F.col("vec_id") != NO_ID, F.col("vec_id")).alias("vec_id"), "score"))


def nearest(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """The ``k`` nearest rows of each row whose vec_id is divisible by ``every``."""
    rows = usable(vectors)
    index, shards = build_index(rows)
    return search(rows, index, shards, rows.filter(F.col("vec_id") % every == 0), k)
