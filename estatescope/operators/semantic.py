"""Files close to each other by embedding: exact search of a stated query set, and clustering of the whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatescope import workspace
from estatescope.operators.components import components

#: Queries that go through the rows together (25 MB), and those multiplied at once.
QUERY_ROWS, STEP_ROWS = 16_384, 512
#: Vectors per cell aimed at when all are held against all, and about the most rows of one side of a task.
CELL_ROWS, PART_ROWS = 16_384, 16_384
#: Rows sent to tasks at once; rows of a task held at once against its other side, and pairs computed exactly at once.
SENT_ROWS, LEFT_ROWS, PAIR_ROWS = 2_000, 128, 4_096
#: Pairs of a task after which only the nearest of each row are kept.
HELD_PAIRS = 1_000_000


def files_with_embeddings(files: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Files joined to their vectors."""
    return files.join(embeddings.select(F.col("file_id").alias("id"), "embedding"), "id")


def usable_vectors(embeddings: DataFrame, dims: int = 384) -> DataFrame:
    """(file_id, embedding) with exactly ``dims`` finite numbers, not all zero; one row per file."""
    good = embeddings.where(
        (F.size("embedding") == dims)
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists("embedding", lambda x: x != 0)
    )
    return good.groupBy("file_id").agg(F.min("embedding").alias("embedding"))


def _sides(files: DataFrame, embeddings: DataFrame, every: int, dims: int) -> tuple[DataFrame, DataFrame]:
    """Queries and searched rows (id, kind, embedding), each written once."""
    joined = files.select("id", F.lower("file_type").alias("kind"), "canonical_id").join(usable_vectors(embeddings, dims).withColumnRenamed("file_id", "id"), "id")
    joined = workspace.materialize(joined.where(F.col("canonical_id").isNull() | (F.col("id") % every == 0)), "vectors")
    return joined.where(F.col("id") % every == 0).select("id", "kind", "embedding"), joined.where("canonical_id is null").select("id", "kind", "embedding")


def _matches(ids: np.ndarray, x: np.ndarray, by_kind: dict[str, np.ndarray], dims: int, take, rest):
    """Arrow map over the rows: ``take`` gets the distances of the rows of one type and the queries they may meet, of
    their own type (all, where a row's is unknown), a few queries at a time; ``rest`` ends a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        for batch in batches:
            y, other = _unit(batch.column("embedding"), dims), np.asarray(batch.column("id"))
            kinds = batch.column("kind").to_pylist()
            at: dict[str | None, list[int]] = {}
            for i, k in enumerate(kinds):
                at.setdefault(k, []).append(i)
            for kind, rows in at.items():
                queries = np.arange(len(ids)) if kind is None else by_kind.get(kind, np.zeros(0, np.int64))
                for start in range(0, len(queries), STEP_ROWS):
                    q = queries[start : start + STEP_ROWS]
                    distance = np.sqrt(np.maximum(2.0 - 2.0 * (x[q] @ y[rows].T), 0.0))
                    yield from take(state, q, other[rows], distance)
        yield from rest(state)

    return run


def _found(i: np.ndarray, j: np.ndarray, s: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(j, pa.int64()), pa.array(s, pa.float64())], ["id", "other", "similarity"])


def _search(queries: DataFrame, rows: DataFrame, dims: int, make) -> DataFrame:
    """(id, other, similarity) by passing blocks of at most about QUERY_ROWS queries, one after the other, over the rows.

    A block reaches the driver and goes to every task; the rows are read where they lie and never shuffled.
    """
    blocks = max(1, -(-queries.count() // QUERY_ROWS))
    out = None
    for block in range(blocks):
        part = queries if blocks == 1 else queries.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block)
        table = part.toArrow()
        ids = np.asarray(table.column("id"), np.int64)
        x = _unit(table.column("embedding").combine_chunks(), dims) if len(ids) else np.zeros((0, dims))
        kinds: dict[str, list[int]] = {}
        for i, k in enumerate(table.column("kind").to_pylist()):
            kinds.setdefault(k or "", []).append(i)
        by_kind = {k: np.array(v, np.int64) for k, v in kinds.items()}
        found = rows.mapInArrow(_matches(ids, x, by_kind, dims, *make(ids)), "id long, other long, similarity double")
        out = found if out is None else out.unionByName(found)
    return out


def knn_topk(files: DataFrame, embeddings: DataFrame, k: int = 20, every: int = 50, dims: int = 384) -> DataFrame:
    """(id, other, rank, similarity): the k nearest canonical files of the query files, by exact L2 distance.

    Queries are the files whose id is divisible by ``every``; candidates have the query's
    file type or none. The file itself counts. Equal distances rank the smaller id first.
    """
    queries, rows = _sides(files, embeddings, every, dims)

    def make(ids: np.ndarray):
        def take(state, q, other, distance):
            if not state:
                state["d"], state["o"] = np.full((len(ids), k), np.inf), np.full((len(ids), k), np.iinfo(np.int64).max)
            d = np.concatenate([state["d"][q], np.round(distance, 9)], axis=1)
            o = np.concatenate([state["o"][q], np.broadcast_to(other, distance.shape)], axis=1)
            order = np.lexsort((o, d), axis=1)[:, :k]
            state["d"][q], state["o"][q] = np.take_along_axis(d, order, 1), np.take_along_axis(o, order, 1)
            return ()

        def rest(state):
            if state:
                i, place = np.nonzero(np.isfinite(state["d"]))
                yield _found(ids[i], state["o"][i, place], state["d"][i, place])

        return take, rest

    # k answers of every partition of the rows
    found = _search(queries, rows, dims, make)
    nearest = found.groupBy("id").agg(F.slice(F.array_sort(F.collect_list(F.struct(F.col("similarity").alias("d"), "other"))), 1, k).alias("n"))
    listed = nearest.select("id", F.posexplode("n").alias("p", "n"))
    cosine = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), 1 - F.col("n.d") * F.col("n.d") / 2))
    return listed.select("id", F.col("n.other").alias("other"), (F.col("p") + 1).cast("int").alias("rank"), F.round(cosine, 6).alias("similarity"))


def semantic_edges(files: DataFrame, embeddings: DataFrame, threshold: float = 0.9, every: int = 50, dims: int = 384) -> DataFrame:
    """(id, other, similarity) of query files and other canonical files of their type at the threshold or above."""
    queries, rows = _sides(files, embeddings, every, dims)

    def make(ids: np.ndarray):
        def take(state, q, other, distance):
            similarity = np.clip(1.0 - distance * distance / 2, -1.0, 1.0)
            i, j = np.nonzero((similarity >= threshold) & (ids[q][:, None] != other[None, :]))
            if len(i):
                yield _found(ids[q][i], other[j], similarity[i, j])

        return take, lambda state: ()

    return _search(queries, rows, dims, make).withColumn("similarity", F.round("similarity", 6))


def _unit(column: pa.Array, dims: int) -> np.ndarray:
    return _unit_rows(np.asarray(column.flatten()).reshape(-1, dims))


def _unit_rows(rows: np.ndarray) -> np.ndarray:
    x = rows.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True, initial=0)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, kind, digest): 16 bytes that equal vectors share."""
    for batch in batches:
        column = batch.column("embedding")
        rows = np.asarray(column.flatten()).reshape(len(column), -1) + 0.0
        digests = [hashlib.blake2b(row.tobytes(), digest_size=16).digest() for row in rows]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("kind"), pa.array(digests, pa.binary())], ["id", "kind", "digest"])


class _Cells:
    """Cells around pivots; a vector is sent to its own and to every other cell that may hold something within reach.

    Whatever lies nearest to pivot c is beyond the plane halfway to c, and within the
    largest angle of c's own vectors: what is further from either than the reach has no
    partner there. The pivots only decide the work, never the result.
    """

    def __init__(self, pivots: np.ndarray, threshold: float):
        self.pivots, self.threshold, self.angle = pivots, threshold, np.full(len(pivots), np.pi)
        # a smaller gap only lets more guests in
        self.gap = np.sqrt(np.maximum(2.0 - 2.0 * pivots @ pivots.T, 1e-12))

    def home(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        score = np.clip(x @ self.pivots.T, -1.0, 1.0)
        return score, score.argmax(axis=1)

    def places(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) of every place a row is sent to."""
        score, home = self.home(x)
        beyond = (score.max(axis=1, keepdims=True) - score) / self.gap[home] <= np.sqrt(2.0 - 2.0 * self.threshold) + 1e-6
        beyond &= np.arccos(score) <= self.angle[None, :] + np.arccos(self.threshold) + 1e-6
        beyond[np.arange(len(x)), home] = True
        return np.nonzero(beyond)


class _Units:
    """What is held against what: rows parted by type, then by cell, then by hash into parts of bounded size.

    Each frequent type is a bucket of its own, the other types share one, and the rows
    of unknown type are the last. A bucket meets itself and the last one.
    """

    def __init__(self, frequent: list[str], cells: list[_Cells]):
        self.codes, self.cells = {k: i for i, k in enumerate(frequent)}, cells
        self.base = np.concatenate([[0], np.cumsum([len(c.pivots) for c in cells])])
        self.splits = np.ones(self.base[-1], np.int64)

    def buckets(self, kinds: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        """(bucket, its rows) of a column of types."""
        last = len(self.cells) - 1
        of = np.array([last if k is None else self.codes.get(k, last - 1) for k in kinds.to_pylist()], np.int64)
        for b in np.unique(of):
            yield int(b), np.flatnonzero(of == b)

    def met(self, bucket: int) -> Iterator[int]:
        last = len(self.cells) - 1
        return iter(range(last + 1)) if bucket == last else iter((bucket, last))


def _measure(units: _Units, dims: int):
    """Arrow map: (cell, n, angle), rows at home in each cell and the widest angle of them, per batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _unit(batch.column("embedding"), dims)
            n, angle = np.zeros(units.base[-1], np.int64), np.zeros(units.base[-1])
            for b, rows in units.buckets(batch.column("kind")):
                score, home = units.cells[b].home(x[rows])
                np.add.at(n, units.base[b] + home, 1)
                np.maximum.at(angle, units.base[b] + home, np.arccos(score.max(axis=1, initial=-1.0)))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(n)), pa.int32()), pa.array(n), pa.array(angle)], ["cell", "n", "angle"])

    return run


def _send(units: _Units, dims: int):
    """Arrow map: rows to the tasks that compare them, one for every two units that meet."""
    first = np.concatenate([[0], np.cumsum(units.splits)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, ids = _unit(batch.column("embedding"), dims), np.asarray(batch.column("id"))
            who, own, other = [], [], []
            for b, rows in units.buckets(batch.column("kind")):
                home = units.base[b] + units.cells[b].home(x[rows])[1]
                unit = first[home] + (ids[rows] * 2654435761 % 2**32) % units.splits[home]
                for t in units.met(b):
                    row, cell = units.cells[t].places(x[rows])
                    cell = cell + units.base[t]
                    s = units.splits[cell]
                    at = np.repeat(np.arange(len(row)), s)
                    who.append(rows[row[at]])
                    own.append(unit[row[at]])
                    other.append(first[cell[at]] + np.arange(len(at)) - np.repeat(np.cumsum(s) - s, s))
            if not who:
                continue
            who, own, other = (np.concatenate(c) for c in (who, own, other))
            task = np.minimum(own, other) * first[-1] + np.maximum(own, other)
            side = np.where(own == other, 2, (own > other).astype(int))
            # a row goes to many tasks: a few of them at a time
            for start in range(0, len(who), SENT_ROWS):
                part = slice(start, start + SENT_ROWS)
                take = pa.array(who[part])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(task[part], pa.int64()), pa.array(side[part], pa.int32()), *(batch.column(c).take(take) for c in ("id", "kind", "embedding"))],
                    ["task", "side", "id", "kind", "embedding"],
                )

    return run


def _nearest_of(a: np.ndarray, b: np.ndarray, s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k nearest ``b`` of every ``a``, of equal distances the smaller id first."""
    order = np.lexsort((b, np.round(np.sqrt(np.maximum(2.0 - 2.0 * s, 0.0)), 9), a))
    a, b, s = a[order], b[order], s[order]
    start = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.zeros(0, np.int64)
    few = np.arange(len(a)) - np.repeat(start, np.diff(np.append(start, len(a)))) < k
    return a[few], b[few], s[few]


def _compare(threshold: float, dims: int, k: int | None):
    """Arrow group map: pairs of one task at the threshold; without ``k`` each once, and only as many as link what they
    link; with ``k`` from either side that may see the other, and only the k nearest of each."""
    forest = k is None

    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(np.asarray(table.column("id")), kind="stable")
        ids, side = np.asarray(table.column("id"))[order], np.asarray(table.column("side"))[order]
        kinds = table.column("kind").take(pa.array(order)).to_pylist()
        codes = {k: n for n, k in enumerate(dict.fromkeys(kinds))}
        kind, unknown = np.array([codes[k] for k in kinds], np.int64), np.array([k is None for k in kinds], bool)
        raw = table.column("embedding").combine_chunks()
        raw = np.asarray(raw.flatten()).reshape(-1, dims)
        # exact values are made for the pairs alone, a few thousand at a time
        y = np.empty((len(ids), dims), np.float32)
        for start in range(0, len(ids), 4096):
            y[start : start + 4096] = _unit_rows(raw[order[start : start + 4096]])
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        far = y[right].T if len(right) < len(y) else y.T
        label = np.arange(len(ids))
        bare = np.where(unknown, codes.get("", -1), kind)
        out, held, kept_pairs = [], 0, 0
        for start in range(0, len(left), LEFT_ROWS):
            a = left[start : start + LEFT_ROWS]
            near = y[a] @ far >= threshold - 1e-4
            near &= (kind[a][:, None] == kind[right][None, :]) | unknown[a][:, None] | unknown[right][None, :]
            near &= (side[a][:, None] != 2) | (a[:, None] < right[None, :])
            if forest:
                near &= label[a][:, None] != label[right][None, :]
            i, j = np.nonzero(near)
            for at in range(0, len(i), PAIR_ROWS):
                p, q = a[i[at : at + PAIR_ROWS]], right[j[at : at + PAIR_ROWS]]
                if forest:
                    apart = label[p] != label[q]
                    p, q = p[apart], q[apart]
                distance = np.sqrt(np.maximum(2.0 - 2.0 * np.einsum("ij,ij->i", _unit_rows(raw[order[p]]), _unit_rows(raw[order[q]])), 0.0))
                similarity = np.clip(1.0 - distance * distance / 2, -1.0, 1.0)
                fine = similarity >= threshold
                p, q, similarity = p[fine], q[fine], similarity[fine]
                if forest and len(p):
                    keep = []
                    for row in np.split(np.arange(len(p)), np.flatnonzero(p[1:] != p[:-1]) + 1):
                        met, where = np.unique(label[q[row]], return_index=True)
                        new = met != label[p[row[0]]]
                        if new.any():
                            keep.append(row[where[new]])
                            label[np.isin(label, met)] = label[p[row[0]]]
                    kept = np.concatenate(keep) if keep else np.zeros(0, np.int64)
                    p, q, similarity = p[kept], q[kept], similarity[kept]
                if not forest:
                    # whose type is unknown sees what has none, and all see it
                    to, fro = unknown[q] | (bare[p] == bare[q]), unknown[p] | (bare[p] == bare[q])
                    p, q, similarity = (np.concatenate([p[to], q[fro]]), np.concatenate([q[to], p[fro]]), np.concatenate([similarity[to], similarity[fro]]))
                out.append((ids[p], ids[q], similarity))
                held += len(p)
                if not forest and held > HELD_PAIRS + kept_pairs:
                    out = [_nearest_of(*(np.concatenate(c) for c in zip(*out)), k)]
                    held = kept_pairs = len(out[0][0])
        a, b, s = (np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)
        if not forest:
            a, b, s = _nearest_of(a, b, s, k)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "similarity": pa.array(s, pa.float64())})

    return run


def _canonical(files: DataFrame, embeddings: DataFrame, dims: int) -> DataFrame:
    """(id, kind, embedding) of every canonical file with a usable vector, once."""
    kinds = files.where("canonical_id is null and id is not null").groupBy("id").agg(F.min(F.lower("file_type")).alias("kind"))
    return kinds.join(usable_vectors(embeddings, dims).withColumnRenamed("file_id", "id"), "id").select("id", "kind", "embedding")


def _all_pairs(rows: DataFrame, threshold: float, dims: int, k: int | None, cell_rows: int, part_rows: int) -> DataFrame:
    """(a, b, similarity) of all rows at the threshold or above, as :func:`_compare` has them; ``rows`` is a written table."""
    total = rows.count()
    # types that fill a quarter of a part: at most four for every part_rows rows
    frequent = sorted(r["kind"] for r in rows.where("kind is not null").groupBy("kind").count().where(F.col("count") >= max(1, part_rows // 4)).collect())
    # one vector for every cell_rows rows
    picked = rows.orderBy(F.xxhash64("id"), "id").limit(max(1, -(-total // cell_rows))).select("kind", "embedding").toArrow()
    pivots: list[np.ndarray] = [np.eye(1, dims)] * (len(frequent) + 2)
    units = _Units(frequent, [_Cells(p, threshold) for p in pivots])
    if picked.num_rows:
        x = _unit(picked.column("embedding").combine_chunks(), dims)
        for b, own in units.buckets(picked.column("kind")):
            pivots[b] = x[own]
        units = _Units(frequent, [_Cells(p, threshold) for p in pivots])
    # one row per cell
    measured = rows.mapInArrow(_measure(units, dims), "cell int, n long, angle double").groupBy("cell").agg(F.sum("n").alias("n"), F.max("angle").alias("angle")).collect()
    for r in measured:
        bucket = int(np.searchsorted(units.base, r["cell"], side="right")) - 1
        units.cells[bucket].angle[r["cell"] - units.base[bucket]], units.splits[r["cell"]] = r["angle"], max(1, -(-r["n"] // part_rows))
    sent = rows.mapInArrow(_send(units, dims), "task long, side int, id long, kind string, embedding array<" + rows.schema["embedding"].dataType.elementType.simpleString() + ">")
    return sent.groupBy("task").applyInArrow(_compare(threshold, dims, k), "a long, b long, similarity double")


def nearest_edges(files: DataFrame, embeddings: DataFrame, threshold: float = 0.9, k: int = 20, dims: int = 384) -> DataFrame:
    """(id, other, similarity) of every canonical file and those of its k nearest (itself counted) at the threshold."""
    rows = workspace.materialize(_canonical(files, embeddings, dims), "vectors")
    # the k nearest of every task a row was in, without itself
    seen = _all_pairs(rows, threshold, dims, k, CELL_ROWS, PART_ROWS)
    own = rows.select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(1.0).alias("similarity"))
    distance = F.round(F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.col("similarity"))), 9)
    ranked = seen.unionByName(own).groupBy("a").agg(F.slice(F.array_sort(F.collect_list(F.struct(distance.alias("d"), "b", "similarity"))), 1, k).alias("n"))
    listed = ranked.select(F.col("a").alias("id"), F.explode("n").alias("n")).select("id", F.col("n.b").alias("other"), F.round("n.similarity", 6).alias("similarity"))
    return listed.where("id <> other")


def connected_clusters(
    files: DataFrame, embeddings: DataFrame, threshold: float = 0.9, dims: int = 384, cell_rows: int = CELL_ROWS, part_rows: int = PART_ROWS
) -> DataFrame:
    """(id, is_canonical, canonical_id) of all canonical files that are linked at the threshold, directly or through others.

    Every canonical file with a usable vector is held against every other of its type,
    or of unknown type. Files of one type and vector are one row until the end.
    """
    from estatescope.operators.dedup import preference

    every = workspace.materialize(_canonical(files, embeddings, dims), "vectors")
    digests = workspace.materialize(every.mapInArrow(_digest, "id long, kind string, digest binary"), "digests")
    least = digests.groupBy("kind", "digest").agg(F.min("id").alias("rep"))
    classes = digests.join(least.withColumnRenamed("kind", "k").withColumnRenamed("digest", "d"), F.col("kind").eqNullSafe(F.col("k")) & (F.col("digest") == F.col("d")))
    classes = workspace.materialize(classes.select("id", "rep"), "classes")
    rows = workspace.materialize(every.join(classes.where("id = rep").select("id"), "id", "left_semi"), "vectors")
    workspace.discard(every)
    # written once: which pairs link a task's rows depends on the order they arrive in
    pairs = workspace.materialize(_all_pairs(rows, threshold, dims, None, cell_rows, part_rows).select("a", "b"), "pairs")
    # a copy hangs on the first of its class, so no round of the components sees a class as a hub
    linked = components(pairs)
    big = classes.groupBy("rep").agg(F.count("*").alias("n"))
    named = big.join(linked.withColumnRenamed("id", "rep"), "rep", "left").where("n > 1 or group_id is not null")
    groups = classes.join(named.select("rep", F.coalesce("group_id", "rep").alias("group_id")), "rep").select("id", "group_id")
    ranked = files.where("canonical_id is null").groupBy("id").agg(F.max(preference()).alias("r")).join(groups, "id")
    heads = ranked.groupBy("group_id").agg((-F.max("r")["i"]).alias("head"))
    out = groups.join(heads, "group_id")
    return out.select("id", (F.col("id") == F.col("head")).alias("is_canonical"), F.when(F.col("id") != F.col("head"), F.col("head")).alias("canonical_id"))


def greedy_clusters(edges: DataFrame, files: DataFrame, most_edges: int = 5_000_000) -> DataFrame:
    """(id, is_canonical, canonical_id) by the order-dependent clustering: seeds in id order take their
    neighbours, a later seed may take a file over, clusters of one are none.

    Each seed depends on all before it, so this is sequential by definition and runs
    on the driver, for at most ``most_edges`` edges; beyond that use connected groups.
    """
    from estatescope.operators.dedup import preference

    spark = edges.sparkSession
    table = edges.select("id", "other").distinct().limit(most_edges + 1).toArrow()
    if table.num_rows > most_edges:
        raise ValueError(f"more than {most_edges} edges")
    # numbers in arrays: rows as objects would be ten times as large
    seeds, others = (np.asarray(table.column(c), np.int64) for c in ("id", "other"))
    order = np.lexsort((others, seeds))
    seeds, others = seeds[order], others[order]
    touched = np.union1d(seeds, others)
    ids = spark.createDataFrame(pa.table({"id": pa.array(touched)})) if len(touched) else spark.createDataFrame([], "id long")
    ranks = files.join(ids, "id", "left_semi").select("id", preference().alias("r")).select("id", "r.*").toArrow().to_pandas()
    ranks = ranks.sort_values(["q", "s", "y", "d", "i"], kind="stable")
    # place in order of preference; -1 is no file
    place = np.full(len(touched), -1, np.int64)
    place[np.searchsorted(touched, ranks["id"].to_numpy(np.int64))] = np.arange(len(ranks))
    seed_at, first = np.unique(seeds, return_index=True)
    last = np.append(first[1:], len(seeds))
    seed_at, others = np.searchsorted(touched, seed_at), np.searchsorted(touched, others)
    clustered, head = np.zeros(len(touched), bool), np.full(len(touched), -1, np.int64)
    for seed, start, end in zip(seed_at.tolist(), first.tolist(), last.tolist()):
        if clustered[seed]:
            continue
        group = np.unique(np.append(others[start:end], seed))
        group = group[place[group] >= 0]
        if len(group) < 2:
            continue
        head[group] = group[place[group].argmax()]
        clustered[group] = True
    got = np.flatnonzero(head >= 0)
    own = touched[head[got]] == touched[got]
    out = pa.table({"id": pa.array(touched[got]), "is_canonical": pa.array(own), "canonical_id": pa.array(touched[head[got]], mask=own)})
    return spark.createDataFrame(out) if len(got) else spark.createDataFrame([], "id long, is_canonical boolean, canonical_id long")
