"""Embedding near-dedup on a robust-pruned flat graph.

1. Equal vectors become one vertex with a weight. Unusable vectors (null, zero, null or non-finite components) take no
   part. Vectors of different lengths never link.
2. Centroids are fitted on a bounded sample (``SAMPLE`` vectors at most); every vector goes to its ``overlap`` nearest
   clusters. Where the table needs more clusters than ``CENTROIDS``, each of these cells is cut in the same way by
   centroids of its own, fitted in a task on a sample of the cell, so clusters keep their size as the table grows. A
   cluster over ``SHARD`` vectors is cut into blocks by hash, and each block and each pair of blocks is a shard of its
   own, so no task gets more than two blocks whatever one cluster holds.
3. In each shard a flat graph is built: vertices come in batches, search the graph so far from the shard's medoid,
   and keep neighbours by robust pruning, in both directions.
4. The shards' adjacency lists are united by vertex.
5. Every vertex searches the united graph within each of its shards from the medoid and itself; within the range every
   vertex found is expanded until nothing new is in range. Pairs in range are verified by their cosine in double
   precision, counted in the least cluster that both are in, and joined into components in the shard; pairs never
   leave it. Nothing else finds pairs.
6. Recall is audited: a sample (by hash, growing with the root of the table) is compared with all vectors; recall is the
   mean over vectors of the part of their links found, apart for vectors with few and with many links, and the least of
   these counts. Below ``target`` the beam widens and the clusters overlap twice as much, until at last there is one
   cluster, whose pairs of blocks hold every pair there is, and the beam is as wide as a shard. If even that is under
   the target, the query fails.

Every row of the input has a row in the result, also unusable ones and repeated ids; an empty table gives an empty
result.
"""

from __future__ import annotations

import logging
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookflow.llm.common import components, materialize, roots

COSINE = 0.9
SHARD = 2000
SAMPLE = 65536
CENTROIDS = 4096
OVERLAP = 3
DEGREE = 24
BEAM = 16
ALPHA = 1.2
#: Vectors audited: at least so many, and so many times the root of all; more until so many of them have links.
AUDIT = 256
AUDIT_ROOT = 4
LINKED = 16
#: Audited vectors compared in one pass.
_AUDITED = 4096
TARGET = 0.99
_BATCH = 256


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # first by the largest part, so that no square over- or underflows
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fit_centroids(x: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """Spherical k-means from evenly spread seeds; deterministic."""
    centre = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = np.concatenate([(b @ centre.T).argmax(axis=1) for b in np.array_split(x, max(1, len(x) // 4096))])
        total = np.zeros_like(centre)
        np.add.at(total, near, x)
        size = np.sqrt((total * total).sum(axis=1, keepdims=True))
        centre = np.where(size > 1e-12, total / np.maximum(size, 1e-12), centre)
    return centre


class Graph:
    """Out-neighbours of 0..n-1 in a table of ``width`` columns, -1 where there is none."""

    def __init__(self, x: np.ndarray, width: int):
        self.x = x.astype(np.float32)
        self.out = np.full((len(x), width), -1, np.int64)
        self.medoid = int((self.x @ self.x.mean(axis=0)).argmax())

    def search(self, queries: np.ndarray, starts: np.ndarray, beam: int, expand: int = 4):
        """Beam search: the ``beam`` best vertices seen by each query and their similarities, best first."""
        q, n = len(queries), len(self.x)
        seen = np.zeros((q, n + 1), bool)
        seen[:, n] = True
        rows = np.arange(q)[:, None]
        seen[rows, starts] = True
        ids = np.full((q, beam), n)
        sims = np.full((q, beam), -np.inf, np.float32)
        done = np.ones((q, beam), bool)
        w = min(beam, starts.shape[1])
        ids[:, :w] = starts[:, :w]
        sims[:, :w] = np.einsum("qd,qwd->qw", queries, self.x[starts[:, :w]])
        done[:, :w] = False
        while True:
            value = np.where(done, -np.inf, sims)
            pick = np.argsort(-value, axis=1)[:, :expand]
            live = np.flatnonzero(np.isfinite(value[np.arange(q), pick[:, 0]]))
            if not len(live):
                return np.where(np.isfinite(sims), ids, -1), sims
            r, pick = live[:, None], pick[live]
            use = np.isfinite(value[r, pick])
            done[r, pick] = True
            nb = self.out[np.where(use, ids[r, pick], 0)]
            nb = np.where((nb >= 0) & use[:, :, None], nb, n).reshape(len(live), -1)
            nb.sort(axis=1)
            nb[:, 1:][nb[:, 1:] == nb[:, :-1]] = n
            nb[seen[r, nb]] = n
            seen[r, nb] = True
            new = np.where(nb < n, np.einsum("qd,qwd->qw", queries[live], self.x[np.minimum(nb, n - 1)]), -np.inf)
            every = np.concatenate((sims[live], new), axis=1)
            best = np.argsort(-every, axis=1, kind="stable")[:, :beam]
            sims[live] = np.take_along_axis(every, best, axis=1)
            ids[live] = np.take_along_axis(np.concatenate((ids[live], nb), axis=1), best, axis=1)
            done[live] = np.take_along_axis(np.concatenate((done[live], np.zeros_like(nb, bool)), axis=1), best, axis=1)

    def prune(self, vertices: np.ndarray, candidates: np.ndarray) -> None:
        """Robust pruning: the nearest candidate stays and ends all that are ``ALPHA`` times nearer to it than to the
        vertex; then the next, up to the graph's degree. Candidates: a row each, -1 for none."""
        v = vertices[:, None]
        candidates = np.sort(candidates, axis=1)
        alive = (candidates >= 0) & (candidates != v)
        alive[:, 1:] &= candidates[:, 1:] != candidates[:, :-1]
        safe = np.where(alive, candidates, 0)
        points = self.x[safe]
        own = 2 - 2 * np.einsum("qd,qcd->qc", self.x[vertices], points)
        out = np.full((len(vertices), self.out.shape[1]), -1)
        rows = np.arange(len(vertices))
        for j in range(out.shape[1]):
            near = np.where(alive, own, np.inf)
            pick = near.argmin(axis=1)
            has = np.isfinite(near[rows, pick])
            if not has.any():
                break
            out[has, j] = safe[rows, pick][has]
            apart = 2 - 2 * np.einsum("qd,qcd->qc", points[rows, pick], points)
            alive &= ~((ALPHA * ALPHA * apart <= own) & has[:, None])
            alive[rows, pick] = False
        self.out[vertices] = out

    def insert(self, vertices: np.ndarray, beam: int) -> None:
        found, _ = self.search(self.x[vertices], np.full((len(vertices), 1), self.medoid), beam)
        near = self.x[vertices] @ self.x[vertices].T  # vertices of one batch don't see each other in the graph
        np.fill_diagonal(near, -np.inf)
        w = min(len(vertices), 16)
        mates = vertices[np.argsort(-near, axis=1)[:, :w]]
        self.prune(vertices, np.concatenate((found, mates), axis=1))
        a, b = np.repeat(vertices, self.out.shape[1]), self.out[vertices].ravel()
        a, b = a[b >= 0], b[b >= 0]  # back links b -> a
        order = np.argsort(b, kind="stable")
        a, b = a[order], b[order]
        to, first, number = np.unique(b, return_index=True, return_counts=True)
        for lo in range(0, int(number.max(initial=0)), 2 * self.out.shape[1]):  # all of them, so many at a time
            some = np.flatnonzero(number > lo)
            size = np.minimum(number[some] - lo, 2 * self.out.shape[1])
            more = np.full((len(some), int(size.max())), -1)
            index = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            more[np.repeat(np.arange(len(some)), size), index] = a[np.repeat(first[some] + lo, size) + index]
            self.prune(to[some], np.concatenate((self.out[to[some]], more), axis=1))


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BEAM) -> Graph:
    graph = Graph(x, min(degree, max(1, len(x) - 1)))
    order = np.random.default_rng(len(x)).permutation(len(x))
    order = np.concatenate(([graph.medoid], order[order != graph.medoid]))
    done, size = 1, 16
    while done < len(x):
        graph.insert(order[done:done + size], beam)
        done, size = done + size, min(_BATCH, size * 2)
    return graph


def range_links(graph: Graph, x: np.ndarray, cosine: float, beam: int) -> np.ndarray:
    """A matrix of the pairs found in range by every vertex's search, verified in double precision."""
    n = len(x)
    found = np.zeros((n, n), bool)
    slack = np.float32(1e-4)
    for lo in range(0, n, _BATCH):
        own = np.arange(lo, min(n, lo + _BATCH))
        queries = graph.x[own]
        ids, sims = graph.search(queries, np.stack((np.full(len(own), graph.medoid), own), axis=1) if len(own) else own, beam)
        inside = np.zeros((len(own), n), bool)
        seen = np.zeros((len(own), n), bool)
        r, c = np.nonzero(ids >= 0)
        seen[r, ids[r, c]] = True
        r, c = np.nonzero((ids >= 0) & (sims >= cosine - slack))
        inside[r, ids[r, c]] = True
        rows, cols = np.nonzero(inside)
        while len(rows):
            next_rows, next_cols = [], []
            step = max(1, (1 << 20) // graph.out.shape[1])
            for i in range(0, len(rows), step):
                nb = graph.out[cols[i:i + step]]
                q = np.repeat(rows[i:i + step], nb.shape[1])
                nb = nb.ravel()
                keep = nb >= 0
                q, nb = q[keep], nb[keep]
                fresh = ~seen[q, nb]
                flat = np.unique(q[fresh] * n + nb[fresh])
                q, nb = flat // n, flat % n
                seen[q, nb] = True
                near = np.einsum("pd,pd->p", queries[q], graph.x[nb]) >= cosine - slack
                inside[q[near], nb[near]] = True
                next_rows.append(q[near])
                next_cols.append(nb[near])
            rows, cols = np.concatenate(next_rows), np.concatenate(next_cols)
        for i in range(0, len(own), 64):
            r, c = np.nonzero(inside[i:i + 64])
            ok = np.einsum("pd,pd->p", x[own[i:i + 64][r]], x[c]) >= cosine if len(r) < 64 * 512 else (x[own[i:i + 64]] @ x.T >= cosine)[r, c]
            found[own[i:i + 64][r[ok]], c[ok]] = True
    found |= found.T
    np.fill_diagonal(found, False)
    return found


def _assign(centres: dict[int, np.ndarray], overlap: int):
    def rows(batches):
        import pyarrow as pa

        for batch in batches:
            vectors = batch.column(1)
            size = vectors.value_lengths().to_numpy(zero_copy_only=False)
            out = [None] * batch.num_rows
            flat, first = vectors.flatten().to_numpy(zero_copy_only=False), np.cumsum(size) - size
            for d in np.unique(size).tolist():
                at = np.flatnonzero(size == d)
                x = _unit(flat[first[at][:, None] + np.arange(d)])
                centre = centres.get(d)
                near = np.argsort(-(x @ centre.T), axis=1, kind="stable")[:, :overlap] if centre is not None else np.zeros((len(at), 1), int)
                for i, c in zip(at.tolist(), np.sort(near, axis=1).tolist()):
                    out[i] = [d * (CENTROIDS + 1) + x for x in c]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int64()))], names=[*batch.schema.names, "clusters"])
    return rows


def _matrix(vectors) -> np.ndarray:
    return _unit(np.stack(vectors.to_numpy()).astype(np.float64))


def _build(degree: int, beam: int):
    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("k", ignore_index=True)
        graph = build_graph(_matrix(pdf["vector"]), degree, beam)
        k = pdf["k"].to_numpy()
        return pd.DataFrame({"k": k, "near": [k[o[o >= 0]].tolist() for o in graph.out]})
    return group


def _search(cosine: float, beam: int):
    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("k", ignore_index=True)
        k, weight = pdf["k"].to_numpy(), pdf["weight"].to_numpy()
        x = _matrix(pdf["vector"])
        near = [np.searchsorted(k, o[np.isin(o, k, assume_unique=False)]) for o in (np.asarray(o, np.int64) for o in pdf["near"])]
        graph = Graph(x, max(1, max(map(len, near))))
        for i, o in enumerate(near):
            graph.out[i, :len(o)] = o
        found = range_links(graph, x, cosine, beam)
        # a pair counts in the least cluster it has in common, and in its blocks' shard only
        here, pair = int(pdf["cluster"][0]), pdf["lo"][0] != pdf["hi"][0]
        block = pdf["block"].to_numpy()
        width = max(map(len, pdf["clusters"]))
        lists = np.array([[*c, *[-1 - i] * (width - len(c))] for i, c in enumerate(pdf["clusters"])])
        links = np.zeros(len(k), np.int64)
        for i in range(len(k)):
            c = np.flatnonzero(found[i])
            if pair:
                c = c[block[c] != block[i]]
                found[i] = False
                found[i, c] = True
            earlier = lists[i][(lists[i] >= 0) & (lists[i] < here)]
            if len(earlier):
                c = c[~np.isin(lists[c], earlier).any(axis=1)]
            links[i] = weight[c].sum()
        root = np.arange(len(k))
        for i in range(0, len(k), 256):
            a, b = np.nonzero(found[i:i + 256])
            root = roots(len(k), np.concatenate((np.arange(len(k)), a + i)), np.concatenate((root, b)))
        return pd.DataFrame({"k": k, "links": links, "root": k[root]})
    return group


def _share(cell: str, size: int):
    """Rows of a cell dealt to ``size`` (a column) parts by hash."""
    return F.pmod(F.xxhash64("k", cell), size)


def _fit_cell(shard: int):
    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("k", ignore_index=True)
        want = max(1, min(CENTROIDS, math.ceil(int(pdf["many"][0]) / shard)))
        out = []
        for d, part in pdf.groupby(pdf["vector"].map(len)):
            x = _matrix(part["vector"])
            out += [(int(pdf["cell"][0]), int(pdf["many"][0]), int(d), i, c.tolist()) for i, c in enumerate(fit_centroids(x, min(want, len(x))))]
        return pd.DataFrame(out, columns=["cell", "many", "d", "i", "centre"])
    return group


def _assign_cell(overlap: int):
    def group(rows: pd.DataFrame, centres: pd.DataFrame) -> pd.DataFrame:
        out = []
        for d, part in rows.groupby(rows["vector"].map(len)):
            own = centres[centres["d"] == d].sort_values("i")
            if len(own):
                near = np.argsort(-(_matrix(part["vector"]) @ np.stack(own["centre"].to_numpy()).T), axis=1, kind="stable")[:, :overlap]
            else:
                near = np.zeros((len(part), 1), int)  # the sample had no vector of this length
            out.append(pd.DataFrame({"k": part["k"].to_numpy(), "cell": part["cell"].to_numpy(), "part": [[int(d) * (CENTROIDS + 1) + x for x in o] for o in near.tolist()]}))
        return pd.concat(out) if out else pd.DataFrame({"k": [], "cell": [], "part": []})
    return group


def _cut_cells(assigned: DataFrame, overlap: int, shard: int) -> DataFrame:
    """``assigned`` with clusters that are parts of its cells. A cell's vectors are dealt over tasks, each with the cell's
    centroids; only a sample of them (``SAMPLE`` at most, about) meets to fit those."""
    held = materialize(assigned.withColumn("cell", F.explode("clusters")).select("k", "vector", "cell"), "embedding_cells")
    many = held.groupBy("cell").agg(F.count("*").alias("many"))
    sized = held.join(F.broadcast(many), "cell")  # a row a cell: at most CENTROIDS for each length of vectors
    some = sized.filter(_share("cell", F.greatest(F.lit(shard // 32 + 1), F.ceil(F.col("many") / SAMPLE))) == 0)
    centres = materialize(some.groupBy("cell").applyInPandas(_fit_cell(shard), "cell long, many long, d long, i long, centre array<double>"), "embedding_centres")
    parts = F.ceil(F.col("many") / (8 * shard))
    dealt = sized.withColumn("part", F.pmod(F.xxhash64("k", F.lit(1)), parts))
    spread = centres.withColumn("part", F.explode(F.sequence(F.lit(0).cast('long'), parts - 1)))
    cut = dealt.groupBy("cell", "part").cogroup(spread.groupBy("cell", "part")).applyInPandas(_assign_cell(overlap), "k long, cell long, part array<long>")
    ids = cut.select("k", F.explode("part").alias("part"), "cell").select("k", F.xxhash64("cell", "part").bitwiseAND(F.lit((1 << 63) - 1)).alias("cluster"))
    return assigned.drop("clusters").join(ids.groupBy("k").agg(F.sort_array(F.collect_set("cluster")).alias("clusters")), "k")


def _true_links(sample: np.ndarray, cosine: float):
    """How many vectors of each batch link with each of the sample's (with itself, if that is in the batch)."""
    def rows(batches):
        import pyarrow as pa

        total = np.zeros(len(sample), np.int64)
        for batch in batches:
            size = batch.column(0).value_lengths().to_numpy(zero_copy_only=False)
            at = np.flatnonzero(size == sample.shape[1])
            flat, first = batch.column(0).flatten().to_numpy(zero_copy_only=False), np.cumsum(size) - size
            weight = batch.column(1).to_numpy()
            for part in np.array_split(at, max(1, len(at) // 2048)):
                x = _unit(flat[first[part][:, None] + np.arange(sample.shape[1])])
                total += ((x @ sample.T >= cosine) * weight[part][:, None]).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sample))), pa.array(total)], names=["i", "n"])
    return rows


def audit_recall(vertices: DataFrame, links: DataFrame, cosine: float = COSINE, sample: int = AUDIT) -> float:
    """The part of its links found, as a mean over vectors with links: of vectors with like numbers of links the least
    mean. ``sample`` vertices by hash or more are held against all, until ``LINKED`` have links or there are no more."""
    ordered = vertices.join(links, "k", "left").select("k", "vector", "weight", F.coalesce("links", F.lit(0)).alias("links"))
    parts, last, done = [], None, 0
    while done < sample or sum(len(p) for p in parts) < LINKED:
        rest = ordered if last is None else ordered.filter(F.col("k") > last)
        some = rest.orderBy("k").limit(min(_AUDITED, sample - done if done < sample else 3 * done)).toPandas()
        if some.empty:
            break
        last, done = int(some["k"].iloc[-1]), done + len(some)
        for _, part in some.groupby(some["vector"].map(len)):
            x = _matrix(part["vector"])
            true = vertices.select("vector", "weight").mapInArrow(_true_links(x, cosine), "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).toPandas()
            true = true.set_index("i")["n"].reindex(range(len(part))).to_numpy() - part["weight"].to_numpy()
            linked = true > 0
            parts.append(pd.DataFrame({"many": np.log2(true[linked]) // 4, "part": np.minimum(part["links"].to_numpy()[linked] / true[linked], 1)}))
    every = pd.concat(parts) if parts else pd.DataFrame({"many": [], "part": []})
    return float(every.groupby("many")["part"].mean().min()) if len(every) else 1.0


def _clusters(n: int, overlap: int, shard: int) -> int:
    """Clusters wanted: one if vectors would be in all of them anyway."""
    clusters = max(1, math.ceil(n * overlap / shard))
    return clusters if overlap < clusters else 1


def _links(vertices: DataFrame, n: int, cosine: float, overlap: int, beam: int, shard: int, centroids: int) -> DataFrame:
    """(k, links, root) per vertex and shard."""
    wanted = _clusters(n, overlap, shard)
    clusters = min(wanted, centroids)
    sample = vertices.select("k", "vector").orderBy("k").limit(min(SAMPLE, 32 * clusters)).select("vector").toPandas()["vector"] if clusters > 1 else []
    centres = {}
    for d in {len(v) for v in sample}:
        x = _unit(np.array([v for v in sample if len(v) == d], np.float64))
        centres[d] = fit_centroids(x, max(1, min(clusters, len(x))))
    assigned = vertices.mapInArrow(_assign(centres, overlap), "k long, vector array<double>, weight long, clusters array<long>")
    if wanted > clusters:
        assigned = _cut_cells(assigned, overlap, shard)
    rows = materialize(assigned.withColumn("cluster", F.explode("clusters")), "embedding_clusters")
    blocks = rows.groupBy("cluster").agg(F.ceil(F.count("*") / shard).cast("int").alias("blocks"))
    rows = rows.join(F.broadcast(blocks), "cluster").withColumn("block", F.pmod(F.xxhash64("k", "cluster"), "blocks").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))
    key = ["cluster", "lo", "hi"]
    near = rows.select(*key, "k", "vector").groupBy(*key).applyInPandas(_build(DEGREE, beam), "k long, near array<long>")
    united = materialize(near.groupBy("k").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "embedding_graph")
    return materialize(rows.join(united, "k").groupBy(*key).applyInPandas(_search(cosine, beam), "k long, links long, root long"), "embedding_links")


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE, overlap: int = OVERLAP, beam: int = BEAM,
                    shard: int = SHARD, target: float = TARGET, centroids: int = CENTROIDS) -> DataFrame:
    """A row per row of ``embeddings`` (vec_id, embedding, any others): vec_id, n_links, component_id, kept."""
    x = F.col("embedding").cast("array<double>")
    usable = F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0), F.lit(False))
    rows = materialize(embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(usable, x).alias("vector"))
                       .withColumn("k", F.when(F.col("vector").isNotNull(), F.xxhash64("vector"))), "embeddings")
    vertices = materialize(rows.filter("k is not null").groupBy("k", "vector").agg(F.count("*").alias("weight"), F.min("vec_id").alias("least")), "embedding_vertices")
    n = vertices.count()
    while True:
        found = _links(vertices.select("k", "vector", "weight"), n, cosine, overlap, beam, shard, centroids)
        links = found.groupBy("k").agg(F.sum("links").alias("links"))
        recall = audit_recall(vertices.select("k", "vector", "weight"), links, cosine, max(AUDIT, math.ceil(AUDIT_ROOT * math.sqrt(n))))
        logging.getLogger(__name__).info("recall %.4f with overlap %d and beam %d", recall, overlap, beam)
        if recall >= target:
            break
        if _clusters(n, overlap, shard) == 1 and beam >= 2 * shard:
            raise RuntimeError(f"recall {recall:.4f} is under {target} with all vectors in one cluster and in the beam")
        overlap, beam = overlap * 2, min(beam * 4, 2 * shard)
    root = components(found.filter("k <> root").selectExpr("k a", "root b"), "embedding_components")
    rooted = vertices.select("k", "weight", "least").join(root, vertices.k == root.id, "left").select("k", "weight", "least", F.coalesce("root", F.xxhash64("k")).alias("root"))
    component = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    per = rooted.join(component, "root").join(links, "k", "left").select("k", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    out = rows.select("vec_id", "k").join(per, "k", "left")
    own = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"),
                      F.coalesce(F.col("vec_id") == own, F.lit(False)).alias("kept"))
