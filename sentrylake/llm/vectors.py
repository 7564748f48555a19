"""Near-duplicate vectors by range search in robust-pruned flat graphs, one per overlapping cluster shard."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentrylake.llm.common import components, cut

DEGREE, BEAM, ALPHA, STEP = 16, 24, 1.2, 8
PAIRS = 65_536  # exact cosines that are computed side by side


def _pruned(x: np.ndarray, own: np.ndarray, candidates: np.ndarray, degree: int) -> np.ndarray:
    """Robust pruning for many nodes: of the candidates (-1: none), nearest first, keep one and drop those
    that are nearer to it, by the factor ALPHA, than to the node. Rows of ``degree`` neighbours, -1 filled."""
    sims = np.einsum("qd,qcd->qc", x[own], x[candidates])
    sims[(candidates < 0) | (candidates == own[:, None])] = -np.inf
    order = np.argsort(-sims, axis=1, kind="stable")
    candidates, sims = np.take_along_axis(candidates, order, 1), np.take_along_axis(sims, order, 1)
    repeated = np.zeros(candidates.shape, bool)
    by_id = np.argsort(candidates, axis=1, kind="stable")
    ids = np.take_along_axis(candidates, by_id, 1)
    np.put_along_axis(repeated, by_id[:, 1:], ids[:, 1:] == ids[:, :-1], 1)
    alive = np.isfinite(sims) & ~repeated
    vectors, rows = x[candidates], np.arange(len(own))
    out = np.full((len(own), degree), -1)
    for r in range(degree):
        first = alive.argmax(axis=1)
        some = alive[rows, first]
        if not some.any():
            break
        out[some, r] = candidates[rows[some], first[some]]
        to_first = np.einsum("qd,qcd->qc", vectors[rows, first], vectors)
        # Squared distances of unit vectors are 2 - 2 cos.
        alive &= ALPHA**2 * (1 - to_first) > (1 - sims)
        alive[rows, first] = False
    return out


def search(x: np.ndarray, graph: np.ndarray, queries: np.ndarray, entries: np.ndarray, least: float, beam: int = BEAM):
    """Greedy search for many queries side by side: the ``beam`` nearest nodes seen, and all seen at ``least`` or more.

    A search goes on while a node in range, or one of its beam, is not expanded. Nodes in range wait in a list of
    their own, several of them expanded in a step, so a range of any size is walked to its end.
    """
    q, n = len(queries), len(graph)
    seen, hits, todo = (np.zeros((q, n), bool) for _ in range(3))
    ids, sims, done = np.full((q, beam), -1), np.full((q, beam), -np.inf, np.float32), np.zeros((q, beam), bool)
    active, fresh = np.arange(q), entries
    while len(active):
        k = fresh.shape[1]
        ok = fresh >= 0
        new = np.where(ok, fresh, 0)
        ok &= ~seen[active[:, None], new]
        # The same node twice in one step counts once.
        order = np.argsort(np.where(ok, new, n + np.arange(k)), axis=1)
        sorted_new = np.take_along_axis(np.where(ok, new, -1), order, 1)
        twice = np.zeros(ok.shape, bool)
        np.put_along_axis(twice, order[:, 1:], sorted_new[:, 1:] == sorted_new[:, :-1], 1)
        ok &= ~twice
        r, c = np.nonzero(ok)
        s = np.full(ok.shape, -np.inf, np.float32)
        s[r, c] = np.einsum("pd,pd->p", queries[active[r]], x[new[r, c]])
        seen[active[r], new[r, c]] = True
        near = s[r, c] >= least
        hits[active[r[near]], new[r[near], c[near]]] = True
        todo[active[r[near]], new[r[near], c[near]]] = True
        s[r[near], c[near]] = -np.inf
        all_ids, all_sims = np.concatenate([ids[active], np.where(ok, new, -1)], 1), np.concatenate([sims[active], s], 1)
        all_done = np.concatenate([done[active], np.zeros((len(active), k), bool)], 1)
        top = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
        ids[active], sims[active] = np.take_along_axis(all_ids, top, 1), np.take_along_axis(all_sims, top, 1)
        done[active] = np.take_along_axis(all_done, top, 1)
        waiting = todo[active].any(axis=1)
        open_ = np.where(done[active], -np.inf, sims[active])
        pick = open_.argmax(axis=1)
        beamed = ~waiting & (open_[np.arange(len(active)), pick] > -np.inf)
        steps = np.full((len(active), STEP), -1)
        if waiting.any():
            w = np.flatnonzero(waiting)
            mine = todo[active[w]]
            r, c = np.nonzero(mine & (mine.cumsum(axis=1, dtype=np.int32) <= STEP))
            place = np.arange(len(r)) - np.searchsorted(r, r)
            steps[w[r], place] = c
            todo[active[w[r]], c] = False
        steps[beamed, 0] = ids[active[beamed], pick[beamed]]
        done[active[beamed], pick[beamed]] = True
        going = waiting | beamed
        active, steps = active[going], steps[going]
        steps = steps[:, : max(1, int((steps >= 0).sum(axis=1).max(initial=1)))]
        fresh = np.where((steps >= 0)[:, :, None], graph[steps], -1).reshape(len(active), steps.shape[1] * graph.shape[1])
    return ids, hits


def _reachable(x: np.ndarray, graph: np.ndarray, back: int = DEGREE, room: int = 16) -> np.ndarray:
    """Pruning can leave nodes without an edge from those near them, in dense clusters above all: all of a cluster
    keep its centre, and the centre keeps few. So each node is added to the lists of its ``back`` nearest
    neighbours; where the ``room`` there is used up, to the list of the node added last, and so on."""
    n = len(graph)
    sims = np.where(graph >= 0, np.einsum("nd,nkd->nk", x, x[graph]), -np.inf)
    order = np.argsort(-sims, axis=1, kind="stable")[:, :back]
    extra, used, last = np.full((n, room), -1), np.zeros(n, np.int64), {}
    for j in range(order.shape[1]):
        near = graph[np.arange(n), order[:, j]]
        missing = (near >= 0) & ~(graph[np.maximum(near, 0)] == np.arange(n)[:, None]).any(axis=1)
        for c in np.flatnonzero(missing).tolist():
            top = int(near[c])
            u = last[top] if used[top] == room else top
            while used[u] == room and u in last:
                u = last[u]
            if u == c or used[u] == room:
                continue
            extra[u, used[u]] = c
            used[u] += 1
            if used[u] == room:
                last[u] = last[top] = c
    return np.concatenate([graph, extra[:, : int(used.max(initial=0))]], 1)


def build(x: np.ndarray, degree: int = DEGREE) -> tuple[np.ndarray, int]:
    """A flat graph over unit vectors and its medoid. Nodes come in batches that double; each
    looks for candidates in the graph so far, is pruned, and is offered to its neighbours, which are pruned again."""
    n = len(x)
    centre = x.mean(axis=0)
    medoid = int((x @ centre).argmax())
    order = np.random.default_rng(7).permutation(n)
    order = np.concatenate([[medoid], order[order != medoid]])
    graph = np.full((n, degree), -1)
    at = min(n, 32)
    first = order[:at]
    if at > 1:
        graph[first] = _pruned(x, first, np.broadcast_to(first, (at, at)).copy(), degree)
    while at < n:
        batch = order[at : at + min(at, 512)]
        found, _ = search(x, graph, x[batch], np.full((len(batch), 1), medoid), 2.0)
        # Nodes of one batch may be each other's neighbours; the nearest few are offered too.
        inner = x[batch] @ x[batch].T
        np.fill_diagonal(inner, -np.inf)
        few = min(8, len(batch) - 1)
        if few > 0:
            found = np.concatenate([found, batch[np.argpartition(-inner, few - 1, axis=1)[:, :few]]], 1)
        graph[batch] = _pruned(x, batch, found, degree)
        source = np.repeat(batch, degree)
        target = graph[batch].ravel()
        source, target = source[target >= 0], target[target >= 0]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        nodes, start, size = np.unique(target, return_index=True, return_counts=True)
        for a in range(0, len(nodes), 1024):
            part, widest = slice(a, a + 1024), int(size[a : a + 1024].max())
            col = np.arange(widest)
            place = np.minimum(start[part, None] + col, len(source) - 1)
            offered = np.where(col < size[part, None], source[place], -1)
            both = np.concatenate([graph[nodes[part]], offered], 1)
            held = np.sort(both, axis=1)[:, ::-1][:, :degree]
            full = (both >= 0).sum(axis=1) > degree
            graph[nodes[part][~full]] = held[~full]
            if full.any():
                graph[nodes[part][full]] = _pruned(x, nodes[part][full], both[full], degree)
        at += len(batch)
    return _reachable(x, graph), medoid


def exact_cosines(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Cosines of rows ``i`` of ``a`` with rows ``j`` of ``b`` in double precision, the same in either order."""
    out = np.empty(len(i))
    norms = [np.sqrt((m * m).sum(axis=1)) for m in (a, b)]
    for at in range(0, len(i), PAIRS):
        x, y = i[at : at + PAIRS], j[at : at + PAIRS]
        out[at : at + PAIRS] = (a[x] * b[y]).sum(axis=1) / (norms[0][x] * norms[1][y])
    return out


def _lowest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of each of ``n`` places the smallest that links lead to."""
    low = np.arange(n)
    while True:
        before = low.copy()
        least = np.minimum(low[a], low[b])
        # The places that two linked ones point at are linked as well.
        for x in (a, b, before[a], before[b]):
            np.minimum.at(low, x, least)
        low = low[low]
        if (low == before).all():
            return low


def _links_of_shard(least: float, beam: int, dtype):
    """For one shard, or two parts of one: per vector the number of vectors it links with, and what it is linked to.

    A pair that meets in several shards counts in the one with the smallest number.
    """

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        label, shard, _, parts, part, block = key
        rows = rows.drop_duplicates("node").sort_values("node", ignore_index=True)
        raw, copies, ids = np.array(rows["vector"].tolist(), np.float64), rows["copies"].to_numpy(), rows["node"].to_numpy()
        # Graphs are built and searched in single precision; the cosines that count are double.
        x = (raw / np.sqrt((raw * raw).sum(axis=1))[:, None]).astype(np.float32)
        wide = max(map(len, rows["shards"]))
        lists = np.array([[*v, *[-1] * (wide - len(v))] for v in rows["shards"]], np.int32)
        n, counts, low = len(rows), np.zeros(len(rows), np.int64), np.arange(len(rows))

        def add(i, j):
            """Count the links of these pairs, each given once."""
            for k in range(wide):
                lower = (lists[i, k] >= 0) & (lists[i, k] < shard)
                both = lower & (lists[j] == lists[i, k][:, None]).any(axis=1) if lower.any() else lower
                i, j = i[~both], j[~both]
            counts[:] += (np.bincount(i, copies[j], n) + np.bincount(j, copies[i], n)).astype(np.int64)
            low[:] = _lowest(n, np.concatenate([i, np.arange(n)]), np.concatenate([j, low]))

        if parts == 1:
            graph, medoid = build(x)
            hits = np.zeros((n, n), bool)
            for at in range(0, n, 512):
                own = np.arange(at, min(at + 512, n))
                # The graph is searched a little below the threshold; the exact cosine decides.
                hits[own] = search(x, graph, x[own], np.stack([np.full(len(own), medoid), own], 1), least - 1e-5, beam)[1]
            # A link that one of the two has found is in the lists of both.
            i, j = np.nonzero(np.triu(hits | hits.T, 1))
            good = exact_cosines(raw, raw, i, j) >= least
            add(i[good], j[good])
        else:
            # Wide shards: every pair of parts is compared whole.
            role = rows["role"].to_numpy()
            first = np.flatnonzero(role == 0)
            second = first if part == block else np.flatnonzero(role == 1)
            for at in range(0, len(first), 512):
                mine = first[at : at + 512]
                sims = x[mine] @ x[second].T
                i, j = np.nonzero(sims >= least - 1e-5)
                close, i, j = sims[i, j] < least + 1e-5, mine[i], second[j]
                if part == block:
                    close, i, j = (v[i < j] for v in (close, i, j))
                good = ~close
                good[close] = exact_cosines(raw, raw, i[close], j[close]) >= least
                add(i[good], j[good])
        moved = np.flatnonzero(low != np.arange(n))
        out = {"label": np.full(n + len(moved), label, dtype), "node": np.concatenate([ids, ids[moved]])}
        out |= {"n": np.concatenate([counts, np.zeros(len(moved), np.int64)]), "root": np.concatenate([ids, ids[low[moved]]])}
        return pd.DataFrame(out)

    return run


def joined(m: np.ndarray, reach: float) -> np.ndarray:
    """For each unit vector the number of its group; those with a cosine of ``reach`` or more are in one group."""
    group = np.full(len(m), -1)
    for first in range(len(m)):
        if group[first] >= 0:
            continue
        new, group[first] = np.array([first]), first
        while len(new):
            near = np.zeros(len(m), bool)
            for at in range(0, len(new), 512):
                near |= (m[new[at : at + 512]] @ m.T >= reach).any(axis=0)
            new = np.flatnonzero(near & (group < 0))
            group[new] = first
    return group


def near_vectors(
    rows: DataFrame,
    least: float = 0.93,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    shard_rows: int = 1024,
    max_centroids: int = 4096,
    overlap: int = 3,
    audit_rows: int = 512,
    beam: int = BEAM,
) -> DataFrame:
    """One row per row: ``vec_id, n_links, component_id, kept``; links are pairs of one label with cosine >= ``least``.

    Vectors of a label are dealt to clusters around sampled vectors, at most ``max_centroids`` in all. Centres that
    one vector could link with both are one cluster, so a dense group is never dealt apart. Each vector goes to
    the ``overlap`` nearest clusters, and links with all it meets in any of them, from either side. A cluster up
    to twice ``shard_rows`` builds one graph and searches it for all of its vectors; a larger one is cut into
    parts, and every pair of parts is compared whole. Cosines are checked in double precision. Then
    ``audit_rows`` vectors and all centres are compared with all rows by brute force; labels where any link of
    theirs is missing are done again with overlap and beam doubled, twice at most, and after that without
    clusters, by comparing every pair.

    Equal vectors are one node that counts as often as it occurs. Vectors that are null, zero, hold null or
    non-finite components, or have a null label link with nothing. Rows that share an id are treated alike:
    each counts as a vector. A null id is null in the result, with no links. An empty table gives an empty one.
    """
    spark = rows.sparkSession
    value = F.col(vector)
    fine = F.coalesce(
        F.col(label).isNotNull()
        & F.col(vec_id).isNotNull()
        & (F.size(value) > 0)
        & F.forall(value, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
        & F.exists(value, lambda v: v != 0),
        F.lit(False),
    )
    every = rows.select(F.col(vec_id).cast("long").alias("id"), F.col(label).alias("label"), value.cast("array<double>").alias("vector"), fine.alias("fine"))
    named = every.where("fine").groupBy("label", "vector").agg(F.min("id").alias("node"), F.count("*").alias("copies"))
    nodes = cut(named.where("node IS NOT NULL"), "nodes")
    sizes = nodes.groupBy("label").agg(F.count("*").alias("n"))
    total = nodes.count()
    share = min(1.0 / shard_rows, max_centroids / 2 / max(total, 1))
    # A label has one centroid at least; which vectors are taken depends on their ids' hashes alone.
    first = nodes.groupBy("label").agg(F.min_by("node", F.xxhash64("node", F.lit(1))).alias("node"))
    picked = nodes.where(F.pmod(F.xxhash64("node", F.lit(1)), F.lit(1 << 30)) < int(share * (1 << 30))).select("label", "node")
    picked = picked.unionByName(first).distinct().join(nodes.select("label", "node", "vector"), ["label", "node"])
    centroids = picked.orderBy(F.xxhash64("node", F.lit(1)), "node").limit(max_centroids).collect()
    by_label: dict = {}
    for i, r in enumerate(centroids):
        by_label.setdefault(r["label"], []).append((i, r["vector"]))
    centres = {}
    for key, own in by_label.items():
        wide = max(len(v) for _, v in own)
        own = [(i, v) for i, v in own if len(v) == wide]
        m = np.array([v for _, v in own], np.float32)
        m /= np.linalg.norm(m, axis=1, keepdims=True)
        # Vectors that link with a third one are at most twice the angle apart.
        group = joined(m, 2 * least * least - 1)
        order = np.argsort(group, kind="stable")
        starts = np.flatnonzero(np.diff(group[order], prepend=-1))
        centres[key] = (np.array([own[i][0] for i in group[order][starts]]), m[order], starts)
    shared = spark.sparkContext.broadcast(centres)  # at most max_centroids vectors
    none = (np.array([0]), None, None)

    def deal(overlap: int, whole: bool):
        def run(batches):
            for batch in batches:
                shards = []
                for key, v in zip(batch["label"].to_pylist(), batch["vector"].to_pylist(), strict=True):
                    names, m, starts = shared.value.get(key, none)
                    if whole or m is None or len(names) <= overlap or m.shape[1] != len(v):
                        shards.append([int(names[0])])
                        continue
                    s = np.maximum.reduceat(m @ np.array(v, np.float32), starts)
                    shards.append(names[np.argsort(-s, kind="stable")[:overlap]].tolist())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shards, pa.list_(pa.int32()))], names=[*batch.schema.names, "shards"])

        return run

    def found(nodes: DataFrame, overlap: int, beam: int, whole: bool) -> DataFrame:
        kinds = T.StructType([*nodes.schema.fields, T.StructField("shards", T.ArrayType(T.IntegerType()))])
        width = F.size("vector")  # vectors of different lengths are never compared
        dealt = nodes.mapInArrow(deal(overlap, whole), kinds).select("*", F.explode("shards").alias("shard")).withColumn("width", width)
        dealt = cut(dealt, "dealt")
        sizes = dealt.groupBy("label", "shard", "width").agg(F.count("*").alias("n"))
        # Two parts at least if every pair is to be compared.
        parts = F.greatest(F.ceil(F.col("n") / (2 * shard_rows)), F.lit(2 if whole else 1)).cast("int")
        dealt = dealt.join(sizes.select("label", "shard", "width", parts.alias("parts")), ["label", "shard", "width"])
        # A part meets each part once, and itself.
        dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        role = (F.col("own") > F.col("other")).cast("int").alias("role")
        part, block = F.least("own", "other").alias("part"), F.greatest("own", "other").alias("block")
        grouped = dealt.select("label", "shard", "width", "parts", part, block, role, "node", "copies", "vector", "shards").groupBy("label", "shard", "width", "parts", "part", "block")
        kinds = T.StructType([nodes.schema["label"], *(T.StructField(c, T.LongType()) for c in ("node", "n", "root"))])
        return cut(grouped.applyInPandas(_links_of_shard(least, beam, object), kinds), "links")

    def brute(batches):
        by_kind: dict = {}
        for i, (_, key, v) in enumerate(audit.value):
            by_kind.setdefault((key, len(v)), []).append(i)
        asked = {k: (np.array(i), np.array([audit.value[x][0] for x in i]), np.array([audit.value[x][2] for x in i])) for k, i in by_kind.items()}
        counts = np.zeros(len(audit.value), np.int64)
        for batch in batches:
            by: dict = {}
            for key, v, c, node in zip(*(batch[n].to_pylist() for n in ("label", "vector", "copies", "node")), strict=True):
                if (key, len(v)) in asked:
                    by.setdefault((key, len(v)), []).append((v, c, node))
            for k, own in by.items():
                place, names, q = asked[k]
                for at in range(0, len(own), 1024):
                    m, c, node = (np.array([r[f] for r in own[at : at + 1024]]) for f in range(3))
                    cos = (q / np.linalg.norm(q, axis=1, keepdims=True)) @ (m / np.linalg.norm(m, axis=1, keepdims=True)).T
                    i, j = np.nonzero((cos >= least - 1e-9) & (names[:, None] != node))
                    good = exact_cosines(q, m, i, j) >= least
                    counts[place] += np.bincount(i[good], c[j[good]], len(place)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(counts)), pa.int32()), pa.array(counts)], names=["place", "n"])

    sample = nodes.orderBy(F.xxhash64("node", F.lit(2)), "node").limit(audit_rows).select("node", "label", "vector").collect()
    sample = list({(r["node"], r["label"]): r for r in (*centroids, *sample)}.values())
    audit = spark.sparkContext.broadcast([(r["node"], r["label"], np.array(r["vector"], np.float64)) for r in sample])
    asked = spark.createDataFrame([(r["node"],) for r in sample], "node long").distinct()
    checked = nodes.mapInArrow(brute, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()
    truth = {(sample[r["place"]]["label"], sample[r["place"]]["node"]): r["n"] for r in checked}
    left, settled = nodes, []
    for attempt in range(4):
        links = found(left, overlap, beam, attempt == 3)
        seen = links.join(F.broadcast(asked), "node").groupBy("label", "node").agg(F.sum("n").alias("n")).collect()
        short = list({r["label"] for r in seen if truth.get((r["label"], r["node"]), r["n"]) != r["n"]})
        if attempt == 3 or not short:
            settled.append(links)
            break
        settled.append(links.where(~F.col("label").isin(short)))
        left = nodes.where(F.col("label").isin(short))
        overlap, beam = 2 * overlap, 2 * beam
    links = reduce(DataFrame.unionByName, settled).drop("label")

    counts = links.groupBy("node").agg(F.sum("n").alias("n"))
    groups = cut(components(links.where("root <> node"), "node", "root"), "groups")
    fine_rows = every.join(nodes.select("label", "vector", "node", "copies"), ["label", "vector"], "left")
    out = fine_rows.join(counts, "node", "left").join(groups, "node", "left")
    linked = F.col("fine") & F.col("node").isNotNull()
    return out.select(
        F.col("id").alias("vec_id"),
        F.when(linked, F.coalesce("n", F.lit(0)) + F.col("copies") - 1).otherwise(0).cast("long").alias("n_links"),
        F.when(linked, F.coalesce("component", "node")).otherwise(F.col("id")).cast("long").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
