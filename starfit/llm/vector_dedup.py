"""Embedding near-duplicates over robust-pruned flat graphs.

Vectors are compared within their label by cosine. Equal unit vectors are one point with a
number of copies, so groups of exact copies are never expanded. The points of each label are
dealt to cluster shards: centres come from a bounded sample, and each point joins its nearest
centre's shard as a member and the next nearest ones' (``OVERLAP``) as a guest. Every shard
builds a flat graph: a point keeps the near neighbours that no kept neighbour is closer to by the
factor ``ALPHA`` (robust pruning), and so many of ``DRAWN`` points drawn from the shard, so that
edges also lead out of a group of near copies; its ``BACK`` nearest ones keep
it in return, so that it can be reached. The adjacency lists a point got in
its shards are united. Each shard then searches the united graph among its points, from the asking
point itself, the medoid and a few points spread over the shard, greedily with a list of ``BEAM`` best points; where the
list's matches fill it, the search goes on through matches until their neighbours hold no more.
Matches are verified in double precision, and a match counts in the shard it is a member of, once.
A member that is not asked about in its match's home cluster counts the match there in return, and
two members that ask in one shard count a pair that either of them finds.

Clusters of more than ``ROOM`` members are split into blocks, and every point of the cluster is
searched in each block; the points to search come in chunks, each to a shard of its own. So a very
large group of near copies is compared block by block, and no shard outgrows ``3 * ROOM``.

``audit`` compares the links of a sample of points with all vectors of their label.

Defined cases: null labels, null, empty and zero vectors and vectors with null, NaN or infinite
components link with nothing; vectors of different lengths are never equal in label and length,
so they do not link; rows that repeat an id count as copies; a null id is returned as it is and
never names a component; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfit.llm.components import connected_components
from starfit.llm.tables import scanned, staged

THRESHOLD = 0.98
#: Points a cluster is meant to have, and the most of one block.
CLUSTER, ROOM = 500, 2_000
#: Shards a point joins.
OVERLAP = 3
DEGREE, NEAR, ALPHA, BACK = 24, 64, 1.2, 4
#: Points of the shard drawn as far candidates, and the most of them kept.
DRAWN, FAR = 64, 8
BEAM, ENTRIES, STRIDE = 32, 8, 4
#: Queries from which on a match is expanded for all of them at once.
TOGETHER = 4
#: Products with centres that are held at once.
PRODUCTS = 4_000_000
#: Points audited in one pass.
AUDITED = 5_000
#: Sampled points for the centres, and the most centres (16 MB of 64 floats): beyond it clusters grow.
MAX_SAMPLE, MAX_CENTRES = 100_000, 65_536


def unit_rows(lists: pa.ListArray) -> list[np.ndarray | None]:
    """Unit vectors in double precision; None for those that link with nothing."""
    out: list[np.ndarray | None] = []
    for row in lists.to_pylist():
        if not row or any(x is None for x in row):
            out.append(None)
            continue
        x = np.array(row, np.float64)
        big = np.abs(x).max()
        if not np.isfinite(big) or big == 0:
            out.append(None)
            continue
        x = x / big  # so that squares neither overflow nor vanish
        out.append(x / np.sqrt((x * x).sum()))
    return out


def _points(vectors: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """vec_id, group (label and length, null if unlinked), unit (bytes of the unit vector), point."""

    def normalise(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        units, labels = unit_rows(batch.column(1)), batch.column(2).to_pylist()
        groups = [f"{len(u)}/{k}" if u is not None and k is not None else None for u, k in zip(units, labels)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(groups, pa.string()),
                pa.array([u.tobytes() if g else None for u, g in zip(units, groups)], pa.binary()),
            ],
            names=["vec_id", "group", "unit"],
        )

    rows = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(vector_column).cast("array<double>").alias("v"),
        F.col(label_column).cast("string").alias("label"),
    )
    point = F.when(F.col("unit").isNotNull(), F.xxhash64("group", "unit"))
    return scanned(rows, normalise, "vec_id long, group string, unit binary").withColumn("point", point)


def matrix(column: pa.Array) -> np.ndarray:
    """Unit vectors of equal length from their bytes."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)


def centres(x: np.ndarray, count: int, rounds: int = 6) -> np.ndarray:
    """Spherical k-means from evenly spaced rows of ``x``."""
    found = x[np.linspace(0, len(x) - 1, count).astype(int)].copy()
    for _ in range(rounds):
        own = np.concatenate([(part @ found.T).argmax(1) for part in np.array_split(x, max(1, len(x) // 4096))])
        for k in range(count):
            mine = x[own == k]
            if len(mine):
                mean = mine.sum(0)
                found[k] = mean / max(np.sqrt((mean * mean).sum()), 1e-12)
    return found


def nearest(x: np.ndarray, c: np.ndarray, count: int) -> np.ndarray:
    """The places of each row's ``count`` nearest centres, the nearest first."""
    count = min(count, len(c))
    out = [np.zeros((0, count), np.int64)]
    for part in np.array_split(x, -(-len(x) * len(c) // PRODUCTS) or 1):
        near = part @ c.T
        best = np.argpartition(-near, count - 1, axis=1)[:, :count]
        order = np.lexsort((best, -np.take_along_axis(near, best, 1)), axis=1)
        out.append(np.take_along_axis(best, order, 1))
    return np.concatenate(out)


def _prune(x: np.ndarray, near: np.ndarray, candidates: np.ndarray, most: int) -> list[int]:
    """At most ``most`` candidates, the nearest first, without those a kept one is ``ALPHA`` closer to."""
    candidates = candidates[np.argsort(-near[candidates], kind="stable")]
    kept: list[int] = []
    # Squared distance of unit vectors is 2 - 2 cos.
    distance = np.maximum(1 - near[candidates], 0)
    between = 1 - x[candidates] @ x[candidates].T
    alive = np.ones(len(candidates), bool)
    while alive.any() and len(kept) < most:
        k = int(alive.argmax())
        kept.append(int(candidates[k]))
        alive &= ALPHA**2 * between[k] > distance
        alive[k] = False
    return kept


def robust_prune(x: np.ndarray) -> list[np.ndarray]:
    """Neighbours of every row: pruned from its nearest rows and, apart, from rows drawn anywhere.

    In a group of more than ``NEAR`` near copies the nearest rows all lie in the group; the drawn
    ones lead out of it, and between parts of it.
    """
    out, far = [], []
    width = min(NEAR, len(x) - 1)
    draw = np.random.default_rng(len(x))  # a retried task draws the same
    for a in range(0, len(x), 512):
        near = x[a : a + 512] @ x.T
        near[np.arange(len(near)), np.arange(a, a + len(near))] = -2
        if width < len(x) - 1:
            best = np.argpartition(-near, width, axis=1)[:, :width]
            drawn = draw.integers(0, len(x), (len(near), DRAWN))
        else:
            best = np.argsort(-near, axis=1)[:, :width]
            drawn = np.zeros((len(near), 0), np.int64)
        for k, (row, candidates, others) in enumerate(zip(near, best, drawn), a):
            out.append(np.array(_prune(x, row, candidates, DEGREE), np.int64))
            others = np.setdiff1d(others, candidates)
            far.append(np.array(_prune(x, row, others[others != k], FAR), np.int64))
    back: list[list[int]] = [[] for _ in out]
    for k, kept in enumerate(out):
        for near in kept[:BACK]:
            back[near].append(k)
    return [np.unique(np.concatenate([kept, more, other])).astype(np.int64) for kept, more, other in zip(out, back, far)]


def range_search(x: np.ndarray, graph: list[np.ndarray], asking: np.ndarray, entries: np.ndarray, least: float):
    """For every asking row, the rows of ``x`` with a dot product of ``least`` or more that a search meets.

    A search starts from the asking row itself and from ``entries``. Queries advance together: each
    expands its matches, and of its other points not yet expanded the ``STRIDE`` best as far as
    they are among its ``BEAM`` best. A match of many queries is expanded for all of them at once,
    as a block: a group of near copies takes a few rounds, not one for every few copies.
    """
    width = max((len(g) for g in graph), default=0)
    table = np.full((len(x), max(1, width)), -1, np.int64)
    for k, g in enumerate(graph):
        table[k, : len(g)] = g
    queries, n = x[asking], len(asking)
    # By point in memory, so that a block's expansion reads stretches; by query in use.
    by_point, opened = np.full((len(x), n), -2.0), np.zeros((len(x), n), bool)
    score, open_ = by_point.T, opened.T
    score[:, entries] = queries @ x[entries].T
    open_[:, entries] = True
    score[np.arange(n), asking] = np.einsum("ij,ij->i", queries, queries)
    open_[np.arange(n), asking] = True
    busy = np.arange(n)
    while len(busy):
        matched = open_[busy] & (score[busy] >= least)
        for k in np.flatnonzero(matched.sum(0) >= TOGETHER):
            asks, step = busy[matched[:, k]], graph[k]
            opened[k, asks] = False
            known = by_point[step][:, asks]
            new = known == -2.0
            if new.any():
                cells = np.ix_(step, asks)
                by_point[cells] = np.where(new, x[step] @ queries[asks].T, known)
                opened[cells] |= new
        busy = busy[open_[busy].any(1)]
        if len(busy) == 0:
            break
        own = np.where(open_[busy], score[busy], -3.0)
        stride = min(STRIDE, len(x))
        best = np.argpartition(-own, stride - 1, axis=1)[:, :stride]
        top = np.take_along_axis(own, best, 1)
        if len(x) > BEAM:
            bar = -np.partition(-score[busy], BEAM - 1, axis=1)[:, BEAM - 1]
        else:
            bar = np.full(len(busy), -2.0)
        row, col = np.nonzero((top > -3) & ((top >= bar[:, None]) | (top >= least)))
        ask, best = busy[row], best[row, col]
        open_[ask, best] = False
        busy = np.unique(ask)
        step = table[best]
        q, k = np.nonzero((step >= 0) & (score[ask[:, None], np.maximum(step, 0)] == -2.0))
        q, at = ask[q], step[q, k]
        score[q, at] = np.einsum("ij,ij->i", queries[q], x[at])
        open_[q, at] = True
    return [np.flatnonzero(row >= least) for row in score]


def medoid_and_spread(x: np.ndarray) -> np.ndarray:
    """The row nearest to the mean, and rows far from those chosen before."""
    chosen = [int((x @ x.sum(0)).argmax())]
    nearest = x @ x[chosen[0]]
    while len(chosen) < min(ENTRIES, len(x)):
        k = int(nearest.argmin())
        if nearest[k] > 1 - 1e-9:
            break
        chosen.append(k)
        nearest = np.maximum(nearest, x @ x[k])
    return np.array(chosen)


def _deal(points: DataFrame, n_points: int) -> DataFrame:
    """Points with their clusters: group, cluster, home (member or guest), clusters (the home first)."""
    share = min(1.0, MAX_SAMPLE / max(n_points, 1))
    size = max(CLUSTER, -(-n_points // MAX_CENTRES))
    sample = points.where(F.pmod(F.xxhash64("point"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))

    def centre(key, table):
        x = matrix(table.sort_by("point")["unit"])
        found = centres(x, max(1, round(len(x) / share / size)))
        return pa.table({"group": [key[0].as_py()] * len(found), "centre": [c.tobytes() for c in found]})

    found = sample.select("group", "point", "unit").groupBy("group").applyInArrow(centre, "group string, centre binary")
    by_group = {  # at most MAX_CENTRES centres and one more a group
        r["group"]: np.frombuffer(b"".join(r["all"]), np.float64).reshape(len(r["all"]), -1)
        for r in found.groupBy("group").agg(F.collect_list("centre").alias("all")).collect()
    }
    known = points.sparkSession.sparkContext.broadcast(by_group)

    def assign(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        groups = np.array(batch.column(1).to_pylist())
        picked: list[tuple[int, int, bool]] = []
        for g in np.unique(groups):
            at = np.flatnonzero(groups == g)
            # A group too small to be sampled is one cluster.
            c = known.value.get(g)
            x = matrix(batch.column(2).take(pa.array(at)))
            near = nearest(x, c, OVERLAP) if c is not None else np.zeros((len(at), 1), int)
            picked += [
                (int(p), int(k), rank == 0, row.tolist()) for p, row in zip(at, near) for rank, k in enumerate(row)
            ]
        rows, cluster, home, clusters = zip(*picked) if picked else ((),) * 4
        table = batch.take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [
                *table.columns,
                pa.array(cluster, pa.int64()),
                pa.array(home, pa.bool_()),
                pa.array(clusters, pa.list_(pa.int64())),
            ],
            names=[*batch.schema.names, "cluster", "home", "clusters"],
        )

    return scanned(
        points.select("point", "group", "unit", "copies"),
        assign,
        "point long, group string, unit binary, copies long, cluster long, home boolean, clusters array<long>",
    )


def near_duplicates(
    vectors: DataFrame,
    least: float = THRESHOLD,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector."""
    rows = staged(_points(vectors, id_column, vector_column, label_column), "unit-vectors")
    # Equal vectors are one point, named by a hash of group and components.
    points = staged(
        rows.where("point is not null")
        .groupBy("point")
        .agg(
            F.first("group").alias("group"),
            F.first("unit").alias("unit"),
            F.count("*").alias("copies"),
            F.min("vec_id").alias("least_id"),
        ),
        "points",
    )
    dealt = staged(_deal(points, points.count()), "dealt")
    sizes = dealt.groupBy("group", "cluster").agg(
        F.greatest(F.ceil(F.count_if("home") / F.lit(ROOM)), F.lit(1)).cast("long").alias("blocks"),
        F.ceil(F.count("*") / F.lit(2 * ROOM)).cast("long").alias("chunks"),
    )
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    placed = (
        dealt.join(sizes, ["group", "cluster"])
        .withColumn("block", every("blocks"))
        .withColumn("member", F.col("home") & (F.pmod(F.xxhash64("point"), F.col("blocks")) == F.col("block")))
        .withColumn("own", F.pmod(F.xxhash64("point", "block"), F.col("chunks")))
        .withColumn("chunk", every("chunks"))
        # Members are in all chunks of their block; each point asks in one.
        .where(F.col("member") | (F.col("own") == F.col("chunk")))
        .withColumn("asks", F.col("own") == F.col("chunk"))
        .withColumn("shard", F.xxhash64("group", "cluster", "block", "chunk"))
    )
    shards = staged(placed.select("shard", "point", "unit", "copies", "member", "asks", "clusters"), "shards")

    def build(table):
        table = table.sort_by("point")
        x, names = matrix(table["unit"]), table["point"].to_numpy()
        graph = robust_prune(x) if len(x) > 1 else [np.zeros(0, np.int64)]
        return pa.table({"point": names, "near": pa.array([names[g] for g in graph], pa.list_(pa.int64()))})

    lists = shards.groupBy("shard").applyInArrow(build, "point long, near array<long>")
    united = staged(
        lists.groupBy("point").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "graph"
    )

    def search(table):
        table = table.sort_by("point")
        x, names, member = matrix(table["unit"]), table["point"].to_numpy(), table["member"].to_numpy()
        copies, asks = table["copies"].to_numpy(), table["asks"].to_numpy()
        asking, clusters = np.flatnonzero(asks), table["clusters"].to_pylist()
        home = np.array([c[0] for c in clusters])
        joins = np.array([c + c[:1] * (OVERLAP - len(c)) for c in clusters])
        both = member & asks
        found = np.zeros((len(x), len(x)), bool)  # a shard has some 3 * ROOM points
        graph = []
        for near in table["near"].to_pylist():
            near = np.array(near or [], np.int64)
            at = np.minimum(np.searchsorted(names, near), len(names) - 1)
            graph.append(at[names[at] == near])
        entries = medoid_and_spread(x)
        links, root = np.zeros(len(x), np.int64), np.arange(len(x))

        def find(k: int) -> int:
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        for a in range(0, len(asking), 256):
            ask = asking[a : a + 256]
            for k, met in zip(ask, range_search(x, graph, ask, entries, least)):
                met = met[met != k]
                met = met[(x[met] * x[k]).sum(1) >= least]  # in double precision, one by one
                met_members = met[member[met]]
                found[k, met_members] = True
                # Those that do not ask where ``k`` is a member would never count it.
                links[met_members[(joins[met_members] != home[k]).all(1)]] += copies[k]
                for m in met:
                    root[find(m)] = find(k)
        for k in asking:
            links[k] += copies[found[k] | (both & both[k] & found[:, k])].sum()
        top = np.array([find(k) for k in range(len(x))])
        return pa.table({"point": names, "links": links, "root": names[top]})

    found = staged(
        shards.join(united, "point", "left").groupBy("shard").applyInArrow(search, "point long, links long, root long"),
        "matches",
    )
    counted = found.groupBy("point").agg(F.sum("links").alias("links"))
    component = connected_components(found.select(F.col("point").alias("a"), F.col("root").alias("b")))
    named = staged(
        points.join(counted, "point", "left")
        .join(component.withColumnRenamed("id", "point"), "point", "left")
        .select("point", "copies", "least_id", "links", F.coalesce("component", "point").alias("class")),
        "named",
    )
    least_ids = named.groupBy("class").agg(F.min("least_id").alias("component_id"))
    classes = named.join(least_ids, "class").select(
        "point", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    linked = rows.select("vec_id", "point").join(classes, "point", "left")
    component_id = F.coalesce("component_id", "vec_id")
    return linked.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component_id.alias("component_id"),
        F.coalesce(component_id == F.col("vec_id"), F.lit(True)).alias("kept"),
    )


def audit(
    vectors: DataFrame,
    result: DataFrame,
    divisor: int = 100,
    least: float = THRESHOLD,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """One row (links, found, recall): links of the points whose id ``divisor`` divides, against all vectors.

    Asking points are handed out in blocks of some ``AUDITED``, each a pass over all vectors.
    """
    rows = staged(_points(vectors, id_column, vector_column, label_column).where("point is not null"), "audit-points")
    asking = rows.where(F.col("vec_id") % divisor == 0)
    passes = -(-asking.count() // AUDITED) or 1
    true = None
    for k in range(passes):
        part = _true_links(rows, asking.where(F.pmod(F.xxhash64("vec_id"), F.lit(passes)) == k), least)
        true = part if true is None else true.unionByName(part)
    joined = true.join(result.select(F.col("vec_id"), "n_links"), "vec_id")
    return joined.agg(F.sum("links").alias("links"), F.sum(F.least("links", "n_links")).alias("found")).withColumn(
        "recall", F.when(F.col("links") > 0, F.col("found") / F.col("links")).otherwise(F.lit(1.0))
    )


def _true_links(rows: DataFrame, asking: DataFrame, least: float) -> DataFrame:
    """vec_id and links of the asking points, by holding them against all others of their group."""
    asked = [(r["vec_id"], r["group"], bytes(r["unit"])) for r in asking.collect()]
    known = rows.sparkSession.sparkContext.broadcast(asked)

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        groups, names = np.array(batch.column(1).to_pylist()), batch.column(0).to_numpy()
        out_id, out_n = [], []
        for g in np.unique(groups):
            mine = [(i, u) for i, k, u in known.value if k == g]
            if mine:
                at = np.flatnonzero(groups == g)
                x = matrix(batch.column(2).take(pa.array(at)))
                close = matrix(pa.array([u for _, u in mine])) @ x.T >= least
                ids = np.array([i for i, _ in mine])
                out_id += ids.tolist()
                out_n += (close & (names[at][None, :] != ids[:, None])).sum(1).tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array(out_id, pa.int64()), pa.array(out_n, pa.int64())], names=["vec_id", "n"]
        )

    counted = scanned(rows, count, "vec_id long, n long").groupBy("vec_id").agg(F.sum("n").alias("links"))
    return staged(counted, "true-links")
