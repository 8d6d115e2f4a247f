"""The k most similar vectors of every vector.

Vectors are spread over shards around centroids fitted on a bounded sample. Each
shard builds a robust-pruned directed graph over its members and answers, by beam
search, its own members and the vectors whose next-nearest centroids it holds. Both
sides of a task are bounded: a cell of many members is split into shards, and where many vectors ask a shard, further tasks
build the same graph and answer a part of them each. Every task is a partition of its own. The
search runs on a projection; what it finds is ranked again on the full vectors,
and the answers of the shards of one vector are merged. The more cells there are, the
more near vectors lie in cells that do not ask each other; so the vectors linked by what the
shards found form groups of bounded size, and all of a group are held against each other. Files of one vector are one
point: the first of them is searched, and all get the smallest ids of their own
class and then those of the classes found.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatescope import workspace
from estatescope.llm import graph

#: Sample the centroids are fitted on (rows); every vector is indexed whatever it is.
SAMPLE_ROWS = 20_000
#: Most members of a shard, and how many times as many vectors a task answers (both by hash, so about).
SHARD_ROWS, ASKERS = 8_000, 3
#: Centroids whose shards are searched for each vector.
PROBES = 2
#: Dimensions of the projection searched, degree and beam of the graph, relaxation of its pruning.
PROJECTION, DEGREE, BEAM, ALPHA = 128, 24, 48, 1.2
#: Linked is what is no further than the nearest of all but this share of the vectors.
UNLINKED = 0.02
#: Steps a group reaches, most of a group held against each other, and vectors of groups per task.
STEPS, GROUP_ROWS, BIN_ROWS = 3, 2_048, 4_096
#: Parts in which the ids of one class are brought together.
CLASS_PARTS = 1024


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows x dims array of a list column without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten()).astype(np.float32).reshape(-1, dims)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, also where squares would overflow."""
    top = np.abs(rows).max(axis=1, keepdims=True, initial=0)
    rows = rows.astype(np.float64) / np.where(top > 0, top, 1)
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length > 0, length, 1)


def usable(df: DataFrame, key: str, vector: str, dims: int) -> DataFrame:
    """(file_id, v, digest) of the rows with exactly ``dims`` finite numbers, not all zero; digest: 16 bytes that equal
    vectors share."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = np.asarray(batch.column("v").flatten().fill_null(np.nan)).reshape(-1, dims)
            good = np.isfinite(flat).all(axis=1) & (flat != 0).any(axis=1)
            digests = [hashlib.blake2b(row.tobytes(), digest_size=16).digest() for row in flat[good] + np.float32(0)]
            rows = batch.filter(pa.array(good))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(digests, pa.binary())], ["file_id", "v", "digest"])

    sized = df.select(F.col(key).cast("long").alias("file_id"), F.col(vector).cast("array<float>").alias("v"))
    sized = sized.where(F.col("file_id").isNotNull() & (F.size("v") == dims))
    return sized.mapInArrow(check, "file_id long, v array<float>, digest binary")


def _single(rows: DataFrame) -> DataFrame:
    """Rows with one vector, the least, of every id."""
    several = workspace.materialize(rows.groupBy("file_id").agg(F.count("*").alias("n")).where("n > 1").select("file_id"), "several")
    if several.isEmpty():
        return rows
    least = rows.join(several, "file_id", "left_semi").groupBy("file_id").agg(F.min(F.struct("v", "digest")).alias("r")).select("file_id", "r.*")
    return rows.join(several, "file_id", "left_anti").unionByName(workspace.materialize(least, "least"))


def _copies(rows: DataFrame, k: int) -> tuple[DataFrame, DataFrame, int]:
    """Members (file_id, rep) and first ids (rep, ids) of the classes of two or more files of one vector; number of files."""
    own = workspace.materialize(rows.select("file_id", "digest"), "digests")
    classes = own.groupBy("digest").agg(F.min("file_id").alias("rep"), F.count("*").alias("n")).where("n > 1").select("digest", "rep")
    members = workspace.materialize(own.join(classes, "digest").select("file_id", "rep"), "copies")
    least = lambda ids: F.slice(F.array_sort(ids), 1, k + 1)
    parts = members.groupBy("rep", F.pmod(F.xxhash64("file_id"), F.lit(CLASS_PARTS)).alias("part")).agg(least(F.collect_list("file_id")).alias("ids"))
    return members, workspace.materialize(parts.groupBy("rep").agg(least(F.flatten(F.collect_list("ids"))).alias("ids")), "firsts"), own.count()


def _spread(best: DataFrame, members: DataFrame, firsts: DataFrame, k: int) -> DataFrame:
    """(file_id, best) of every file from the best classes of its class."""
    each = best.select("file_id", F.explode("best").alias("b")).select("file_id", "b.d", F.col("b.other").alias("rep"))
    listed = each.join(firsts, "rep", "left").select("file_id", "d", F.explode(F.coalesce("ids", F.array("rep"))).alias("other"))
    merged = listed.groupBy("file_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("d", "other"))), 1, k).alias("best"))
    alone = merged.join(members.select("file_id"), "file_id", "left_anti")
    # a copy: the first of its own class, then what its class found
    shared = firsts.join(merged.withColumnRenamed("file_id", "rep"), "rep", "left")
    own = F.transform(F.filter("ids", lambda x: x != F.col("file_id")), lambda x: F.struct(F.lit(-1.0).alias("d"), x.alias("other")))
    both = F.when(F.col("best").isNull(), own).otherwise(F.concat(own, "best"))
    copies = members.join(shared, "rep").select("file_id", F.slice(F.array_sort(both), 1, k).alias("best"))
    return alone.select("file_id", "best").unionByName(copies)


def fit_centroids(sample: np.ndarray, rows: int, shard_rows: int) -> np.ndarray:
    """Centroids by repeated bisection of the largest cell until each holds its share of a shard."""
    rng = np.random.default_rng(11)
    most = max(8, math.floor(0.75 * shard_rows * len(sample) / max(rows, 1)))
    cells, out = [np.arange(len(sample))], []
    while cells:
        cell = cells.pop()
        own = sample[cell]
        if len(cell) <= most:
            out.append(own.mean(axis=0))
            continue
        a, b = own[rng.integers(len(own))], None
        b = own[np.argmin(own @ a)]
        for _ in range(8):
            left = own @ a >= own @ b
            if left.all() or not left.any():
                break
            a, b = own[left].mean(axis=0), own[~left].mean(axis=0)
            a, b = a / max(np.linalg.norm(a), 1e-12), b / max(np.linalg.norm(b), 1e-12)
        left = own @ a >= own @ b
        if left.all() or not left.any():  # equal vectors: no centroid can part them
            out.append(own.mean(axis=0))
            continue
        cells += [cell[left], cell[~left]]
    centroids = np.array(out, np.float64).reshape(-1, sample.shape[1])
    length = np.linalg.norm(centroids, axis=1, keepdims=True)
    return (centroids / np.where(length > 0, length, 1)).astype(np.float32)


def _nearest_cells(batch: pa.RecordBatch, centroids: np.ndarray, probes: int, dims: int) -> np.ndarray:
    score = unit(matrix(batch.column("v"), dims)).astype(np.float32) @ centroids.T
    return np.argsort(-score, axis=1, kind="stable")[:, : min(probes, score.shape[1])]


def _sizes(centroids: np.ndarray, probes: int, dims: int):
    """Arrow map: how many vectors are at home in a cell, and how many ask it, counted per batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = _nearest_cells(batch, centroids, probes, dims)
            home, asked = (np.bincount(c.ravel(), minlength=len(centroids)) for c in (cells[:, 0], cells))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(home)), pa.int32()), pa.array(home, pa.int64()), pa.array(asked, pa.int64())], ["cell", "home", "asked"])

    return run


def _route(centroids: np.ndarray, splits: np.ndarray, slices: np.ndarray, probes: int, dims: int):
    """Arrow map: one row per vector and task that holds or answers it. A cell has a task for every one of its
    ``splits`` shards and every one of its ``slices`` of the vectors that ask."""
    first = np.concatenate([[0], np.cumsum(splits * slices)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column("file_id"))
            cells = _nearest_cells(batch, centroids, probes, dims)
            own = (ids * 2654435761 % 2**32) % splits[cells[:, 0]]
            part = ids * 40503 % 2**31 // 7
            who, task, member, asks = [], [], [], []
            for k in range(cells.shape[1]):
                cell = cells[:, k]
                n = splits[cell] * slices[cell]
                at = np.repeat(np.arange(len(ids)), n)
                number = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
                shard, piece = number // slices[cell][at], number % slices[cell][at]
                holds = (shard == own[at]) if k == 0 else np.zeros(len(at), bool)
                answered = piece == part[at] % slices[cell][at]
                keep = holds | answered
                who.append(at[keep])
                task.append((first[cell][at] + number)[keep])
                member.append(holds[keep])
                asks.append(answered[keep])
            who, task, member, asks = (np.concatenate(x) for x in (who, task, member, asks))
            yield pa.RecordBatch.from_arrays(
                [pa.array(task, pa.int32()), pa.array(ids[who]), pa.array(member), pa.array(asks), batch.column("v").take(pa.array(who))],
                ["task", "file_id", "member", "asks", "v"],
            )

    return run


def _by_task(search):
    """Arrow map over partitions that hold whole tasks: ``search`` of every task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        task = np.asarray(table.column("task"))
        for t in np.unique(task):
            yield from search(table if (task == t).all() else table.filter(pa.array(task == t))).to_batches(max_chunksize=10_000)

    return run


def _search(k: int, dims: int):
    """Graph over the members of a task, k best others of every vector that asks."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("file_id")
        ids, full = np.asarray(table.column("file_id")), unit(matrix(table.column("v"), dims))
        member, asks = (table.column(c).combine_chunks().to_numpy(zero_copy_only=False).astype(bool) for c in ("member", "asks"))
        home, asking = np.flatnonzero(member), np.flatnonzero(asks)
        empty = {"file_id": pa.array([], pa.int64()), "other": pa.array([], pa.int64()), "similarity": pa.array([], pa.float64())}
        if not len(home) or not len(asking):
            return pa.table(empty)
        low = full
        if dims > PROJECTION:
            fit = full[home[:: max(1, len(home) // 2000)]]
            axes = np.linalg.eigh(fit.T @ fit)[1][:, ::-1][:, :PROJECTION]
            low = unit(full @ axes)
        low = np.ascontiguousarray(low.astype(np.float32))
        exact = full.astype(np.float32)
        points = low[home]
        edges, medoid = graph.build(points, DEGREE, BEAM, ALPHA)
        pivots = np.unique(np.concatenate([[medoid], np.arange(0, len(home), max(1, len(home) // 64))]))
        place = np.full(len(ids), -1, np.int64)
        place[home] = np.arange(len(home))
        out = []
        for start in range(0, len(asking), 1000):
            q = asking[start : start + 1000]
            entry = pivots[(low[q] @ points[pivots].T).argmax(axis=1)]
            entry = np.where(place[q] >= 0, place[q], entry)[:, None]
            found, _ = graph.beam_search(points, edges, low[q], entry, BEAM)
            there = found < len(home)
            other = home[np.minimum(found, len(home) - 1)]
            there &= other != q[:, None]
            similarity = np.where(there, np.einsum("ijk,ik->ij", exact[other], exact[q]), -9.0)
            best = np.argsort(-similarity, axis=1)[:, : k + 5]
            other, there = np.take_along_axis(other, best, 1), np.take_along_axis(there, best, 1)
            similarity = np.where(there, np.einsum("ijk,ik->ij", full[other], full[q]), -9.0)
            order = np.lexsort((ids[other], -similarity), axis=1)[:, :k]
            other, there = np.take_along_axis(other, order, 1), np.take_along_axis(there, order, 1)
            similarity = np.take_along_axis(similarity, order, 1)
            who = np.broadcast_to(q[:, None], other.shape)[there]
            out.append((ids[who], ids[other[there]], similarity[there]))
        a, b, s = (np.concatenate(x) for x in zip(*out))
        return pa.table({"file_id": a, "other": b, "similarity": s})

    return run


def _homes(centroids: np.ndarray, dims: int):
    """Arrow map: the cell of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = _nearest_cells(batch, centroids, 1, dims)
            yield pa.RecordBatch.from_arrays([batch.column("file_id"), pa.array(cells[:, 0], pa.int32())], ["file_id", "cell"])

    return run


def _groups(found: DataFrame, homes: DataFrame) -> DataFrame:
    """(file_id, name) of vectors that are linked by what the shards found: all within a few steps of one vector, which
    has the least number around, share its number. Groups of one cell, whose shards all asked each other, are left out."""
    best = found.groupBy("file_id").agg(F.max("similarity").alias("s"))
    least = (best.approxQuantile("s", [UNLINKED], 0.002) or [1.0])[0]
    near = found.where(F.col("similarity") >= least).select("file_id", "other")
    links = workspace.materialize(near.unionByName(near.select(F.col("other").alias("file_id"), F.col("file_id").alias("other"))).distinct(), "links")
    names = links.select("file_id").distinct().select("file_id", F.xxhash64("file_id").alias("name"))
    for _ in range(STEPS):
        told = links.join(names.withColumnRenamed("file_id", "other"), "other").select("file_id", "name")
        names = workspace.materialize(names.unionByName(told).groupBy("file_id").agg(F.min("name").alias("name")), "names")
    spread = names.join(homes, "file_id").groupBy("name").agg(F.count("*").alias("n"), F.min("cell").alias("low"), F.max("cell").alias("high")).where("low <> high")
    parts = F.pmod(F.xxhash64("name", "file_id"), F.ceil(F.col("n") / GROUP_ROWS))
    return names.join(spread, "name").select("file_id", F.xxhash64("name", parts).alias("name"))


def _within(k: int, dims: int):
    """The k best others of every vector in its own group, by full-precision products of all pairs."""

    def run(table: pa.Table) -> pa.Table:
        name, ids = np.asarray(table.column("name")), np.asarray(table.column("file_id"))
        order = np.lexsort((ids, name))
        name, ids, raw = name[order], ids[order], matrix(table.column("v"), dims)
        edges = np.append(np.flatnonzero(np.append(True, name[1:] != name[:-1])), len(ids))
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for start, end in zip(edges[:-1], edges[1:]):
            if end - start < 2:
                continue
            full, own = unit(raw[order[start:end]]), ids[start:end]
            for at in range(0, len(own), 512):
                similarity = full[at : at + 512] @ full.T
                row = np.arange(len(similarity))
                similarity[row, at + row] = -9.0
                # what is left out is further than the k best by more than rounding
                few = min(k + 5, len(own))
                other = np.argpartition(-similarity, few - 1, axis=1)[:, :few]
                similarity = np.einsum("ijk,ik->ij", full[other], full[at : at + 512])
                similarity[other == (at + row)[:, None]] = -9.0
                best = np.lexsort((own[other], -similarity), axis=1)[:, : min(k, len(own) - 1)]
                other, similarity = np.take_along_axis(other, best, 1), np.take_along_axis(similarity, best, 1)
                out.append((np.repeat(own[at : at + 512], other.shape[1]), own[other].ravel(), similarity.ravel()))
        a, b, s = (np.concatenate(x) for x in zip(*out))
        return pa.table({"file_id": a, "other": b, "similarity": s})

    return run


def _across(rows: DataFrame, found: DataFrame, centroids: np.ndarray, total: int, k: int, dims: int) -> DataFrame:
    """What the shards found, and the best of the groups it links: near vectors whose cells differ, however many cells there are."""
    bins = max(1, math.ceil(total / BIN_ROWS))
    grouped = rows.select("file_id", "v").join(_groups(found, rows.select("file_id", "v").mapInArrow(_homes(centroids, dims), "file_id long, cell int")), "file_id").withColumn("bin", F.pmod("name", F.lit(bins)))
    within = grouped.select("bin", "name", "file_id", "v").groupBy("bin").applyInArrow(_within(k, dims), "file_id long, other long, similarity double")
    return found.unionByName(within)


def nearest(
    df: DataFrame, k: int = 5, key: str = "file_id", vector: str = "embedding", dims: int = 384,
    sample_rows: int = SAMPLE_ROWS, shard_rows: int = SHARD_ROWS, probes: int = PROBES,
) -> DataFrame:
    """(file_id, other, similarity, place) of the k most similar other vectors of every usable vector.

    Equal similarities rank the smaller id first. Null, wrongly sized, non-finite and
    all-zero vectors neither ask nor answer; further columns are ignored. With no or one
    usable vector the result is empty. Beyond 0.75 x ``shard_rows`` x ``sample_rows`` / 8
    vectors, ``sample_rows`` must grow with the collection.
    """
    # numbers hardly compress
    rows = _single(workspace.materialize(usable(df, key, vector, dims), "vectors", "lz4"))
    members, firsts, total = _copies(rows, k)
    copied = not members.isEmpty()
    if copied:
        rows = rows.join(members.where("file_id <> rep").select("file_id"), "file_id", "left_anti")
    step = max(1, math.ceil(total / sample_rows))
    sample = rows.where(F.pmod(F.xxhash64("file_id"), F.lit(step)) == 0).orderBy("file_id").limit(2 * sample_rows).select("v").toArrow()
    points = unit(matrix(sample.column("v"), dims)).astype(np.float32)
    if not len(points):
        points = np.eye(1, dims, dtype=np.float32)
    centroids = fit_centroids(points, total, shard_rows)
    # one row per centroid
    home, asked = np.zeros((2, len(centroids)), np.int64)
    sizes = rows.select("v").mapInArrow(_sizes(centroids, probes, dims), "cell int, home long, asked long")
    for r in sizes.groupBy("cell").agg(F.sum("home").alias("home"), F.sum("asked").alias("asked")).collect():
        home[r["cell"]], asked[r["cell"]] = r["home"], r["asked"]
    splits = np.maximum(1, -(-home // shard_rows))
    slices = np.maximum(1, -(-asked // (ASKERS * shard_rows)))
    routed = rows.select("file_id", "v").mapInArrow(_route(centroids, splits, slices, probes, dims), "task int, file_id long, member boolean, asks boolean, v array<float>")
    # the number of a task is the number of its partition, so no two share one
    found = routed.repartitionById(int((splits * slices).sum()), F.col("task")).mapInArrow(_by_task(_search(k, dims)), "file_id long, other long, similarity double")
    if len(centroids) > 1:
        # the vectors sent to the shards are the largest of all intermediate data
        found = workspace.materialize(found, "found", free=True)
        found = _across(rows, found, centroids, total, k, dims)
    # at most k answers of each of the few shards asked and of the group; of a neighbour found twice the best counts
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("similarity")).alias("d"), "other")))
    once = F.filter("all", lambda x, i: ~F.exists(F.slice("all", 1, i), lambda y: y["other"] == x["other"]))
    best = found.groupBy("file_id").agg(ranked.alias("all")).select("file_id", F.slice(once, 1, k).alias("best"))
    if copied:
        best = _spread(best, members, firsts, k)
    listed = best.select("file_id", F.posexplode("best").alias("at", "b"))
    return listed.select("file_id", F.col("b.other").alias("other"), (-F.col("b.d")).alias("similarity"), (F.col("at") + 1).alias("place"))


def similar_pairs(df: DataFrame, k: int = 5, **options) -> DataFrame:
    """(id_a, id_b), smaller first, where one is among the k most similar of the other."""
    near = nearest(df, k, **options)
    return near.select(F.least("file_id", "other").alias("id_a"), F.greatest("file_id", "other").alias("id_b")).distinct()
