"""Exact top-k inner products by searching a cover tree of queries and one of data together.

Vectors of integers are dealt by a cover in levels: to the nearest of a few centres, a
farthest-first cover of a drawn sample; then, in each group of more than ``BLOCK`` rows, to
the nearest centre of a cover of the group's own sample, ``LEVELS`` times at most, so
that groups get narrower as the table grows.  A group that is still larger, for instance
of one vector that very many rows share, is dealt to blocks by the id.  Each
block becomes a tree: a node covers its points within a radius, its children within
about half of it.  For nodes with centres p, q and radii r, s no two points' product
exceeds <p, q> + r |q| + s |p| + r s.

1. Each block of queries is searched against its ``SEEDS`` data blocks of highest bound.
   That gives every query a kth score.
2. From there a query block descends: to the groups whose bound reaches the worst kth score
   of its queries, to their blocks that do, and in these both trees are searched together.  All
   pairs of nodes of two trees are bounded in one matrix and the walk masks it level by level;
   the leaves left are scored in one matrix product.
3. The ranks over what was found are counted per query.

What the bounds save depends on the data: clustered vectors are pruned well, vectors
spread evenly over a sphere of many dimensions not at all, and then every product is
computed, block by block.  The cover's centres are broadcast, at most ``GROUPS`` times
``CENTRES`` of them.

Vectors that are null or hold null or non-finite components, and rows without an id,
take no part.  Missing components of shorter vectors are zeros.  Rows that repeat an id
count once, with their least vector.  Ties go to the smaller id.  An empty table gives no rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.llm.storage import written

SAMPLE = 1024
CENTRES = 32
#: Times that groups are divided after the first cover, groups that are, and rows drawn of each.
LEVELS, GROUPS, GROUP_SAMPLE = 2, CENTRES**2, 256
BLOCK = 2048
QUERY_BLOCK = 256
LEAF, QUERY_LEAF = 48, 12
#: Points, in multiples of k, that a query is scored against before other leaves are bounded.
FIRST_POINTS = 4
CHILDREN = 12
SEEDS = 2
NOTHING = np.iinfo(np.int64).min


def quantised(embedding: Column, scale: int) -> Column:
    """floor(scale * x) of every component; null unless all are finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    wide = F.transform(embedding, lambda x: x.cast("double"))
    whole = F.transform(wide, lambda x: F.floor(F.lit(float(scale)) * x).cast("long"))
    return F.when(F.forall(wide, finite), whole)


# ---------------------------------------------------------------- trees


def matrix_of(lists: list, width: int | None = None) -> np.ndarray:
    width = max([1, *map(len, lists)]) if width is None else width
    out = np.zeros((len(lists), width), dtype=np.int64)
    for row, x in zip(out, lists, strict=True):
        row[: len(x)] = x
    return out


def distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - centre) ** 2).sum(axis=1))


def farthest_first(points: np.ndarray, most: int, enough: float) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Centres, each the point farthest from those before, until all lie within ``enough``; each point's centre and distance."""
    chosen, near, at = [0], distances(points, points[0]), np.zeros(len(points), dtype=np.int64)
    while len(chosen) < most and near.max() > enough:
        new = int(near.argmax())
        far = distances(points, points[new])
        closer = far < near
        at[closer], near = len(chosen), np.minimum(near, far)
        chosen.append(new)
    return chosen, at, near


class Tree:
    """Points reordered so that a node's lie together; per node first and last point, centre, radius, children."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf: int = LEAF):
        exact = points.astype(np.float64)
        order, nodes = np.arange(len(ids)), []
        todo = [(0, len(ids), -1)]
        while todo:
            a, b, parent = todo.pop()
            own = exact[order[a:b]]
            centre = own[int(distances(own, own.mean(axis=0)).argmin())]
            radius = float(distances(own, centre).max()) if b > a else 0.0
            k = len(nodes)
            nodes.append([a, b, centre, radius, []])
            if parent >= 0:
                nodes[parent][4].append(k)
            small = b - a <= leaf
            if radius == 0 or b - a < 3 or small and radius <= nodes[0][3] / 2:
                continue
            chosen, at, near = farthest_first(own, CHILDREN, radius / 2)
            if small and near.max() > radius / 2:
                continue  # a wide leaf that falls into no clusters
            by = np.argsort(at, kind="stable")
            order[a:b] = order[a:b][by]
            cuts = a + np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(chosen)))])
            todo += [(int(x), int(y), k) for x, y in zip(cuts[:-1], cuts[1:], strict=True) if y > x]
        self.ids, self.points = ids[order], points[order]
        self.first = np.array([n[0] for n in nodes])
        self.last = np.array([n[1] for n in nodes])
        self.centres = np.stack([n[2] for n in nodes])
        self.radii = np.array([n[3] for n in nodes])
        self.norms = np.sqrt((self.centres**2).sum(axis=1))
        self.parts = np.array([len(n[4]) for n in nodes])
        self.children = np.array([c for n in nodes for c in n[4]], dtype=np.int64)
        self.children_at = np.cumsum(self.parts) - self.parts

    def below(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The children of all the nodes, and for each the place of its parent among them."""
        parts = self.parts[nodes]
        up = np.repeat(np.arange(len(nodes)), parts)
        nth = np.arange(len(up)) - np.repeat(np.cumsum(parts) - parts, parts)
        return self.children[self.children_at[nodes][up] + nth], up

    def widened(self, width: int) -> None:
        if (more := width - self.points.shape[1]) > 0:
            self.points = np.pad(self.points, ((0, 0), (0, more)))
            self.centres = np.pad(self.centres, ((0, 0), (0, more)))


def bound(product, r, norm_r, s, norm_s):
    """The highest product of points within r and s of two centres, with room for rounding."""
    slack = r * norm_s + s * norm_r + r * s
    return product + slack + 1e-6 * (1 + slack + norm_r * norm_s)


class Search:
    """The best k of each query so far, over pairs of nodes of two trees."""

    def __init__(self, queries: Tree, k: int, floor: np.ndarray):
        self.queries, self.k = queries, k
        self.scores = np.full((len(queries.ids), k), NOTHING, dtype=np.int64)
        self.ids = np.full((len(queries.ids), k), np.iinfo(np.int64).max)
        self.floor = floor.copy()  # a kth score that each query has already
        self.scored = 0  # products taken

    def against(self, data: Tree) -> None:
        q = self.queries
        width = max(q.points.shape[1], data.points.shape[1])
        q.widened(width)
        data.widened(width)
        most = float(np.abs(q.points).max(initial=0)) * float(np.abs(data.points).max(initial=0)) * width
        kind = np.float64 if most < 2**53 else np.int64
        own, other = q.points.astype(kind), data.points.astype(kind)
        limits = bound(q.centres @ data.centres.T, q.radii[:, None], q.norms[:, None], data.radii, data.norms)
        a, b = self._open_leaves(data, limits)
        if not len(a):
            return
        leaves_a, at_a = np.unique(a, return_inverse=True)
        leaves_b, at_b = np.unique(b, return_inverse=True)
        asked = np.zeros((len(leaves_a), len(leaves_b)), dtype=bool)
        asked[at_a, at_b] = True
        rows, leaf_a = spans(q.first[leaves_a], q.last[leaves_a])
        asked = asked[leaf_a]
        # each query by itself is a node of radius 0
        points = q.points[rows].astype(np.float64)
        product = points @ data.centres[leaves_b].T
        norms = np.sqrt((points**2).sum(axis=1))[:, None]
        limits = bound(product, 0.0, norms, data.radii[leaves_b], data.norms[leaves_b])
        # its nearest leaves first: their scores narrow what is left
        near = np.argsort(np.where(asked, -product, np.inf), axis=1)
        sizes = (data.last - data.first)[leaves_b][near]
        first = np.zeros_like(asked)
        np.put_along_axis(first, near, np.cumsum(sizes, axis=1) - sizes < FIRST_POINTS * self.k, axis=1)
        first &= asked
        self._score(data, own, other, rows, leaves_b, first)
        self._score(data, own, other, rows, leaves_b, asked & ~first & (limits >= self.floor[rows][:, None]))

    def _worst(self) -> np.ndarray:
        """The least kth score of the queries in each node."""
        q = self.queries
        return np.array([self.floor[x:y].min() for x, y in zip(q.first, q.last, strict=True)])

    def _open_leaves(self, data: Tree, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of leaves whose bounds, and those of the nodes above, reach the kth scores."""
        q, worst = self.queries, self._worst()
        a = b = np.zeros(1, dtype=np.int64)
        found_a, found_b = [], []
        while len(a):
            keep = limits[a, b] >= worst[a]
            a, b = a[keep], b[keep]
            leaf = (q.parts[a] == 0) & (data.parts[b] == 0)
            found_a.append(a[leaf])
            found_b.append(b[leaf])
            a, b = a[~leaf], b[~leaf]
            first = (q.parts[a] > 0) & ((data.parts[b] == 0) | (q.radii[a] >= data.radii[b]))
            down_a, up_a = q.below(a[first])
            down_b, up_b = data.below(b[~first])
            a, b = np.concatenate([down_a, a[~first][up_b]]), np.concatenate([b[first][up_a], down_b])
        return np.concatenate(found_a), np.concatenate(found_b)

    def _score(self, data: Tree, own: np.ndarray, other: np.ndarray, rows: np.ndarray, leaves: np.ndarray, asked: np.ndarray) -> None:
        """Takes the products of queries with the points of the leaves ``asked`` for into the best of each query."""
        live, some = asked.any(axis=1), asked.any(axis=0)
        if not live.any():
            return
        q = self.queries
        rows, leaves, asked = rows[live], leaves[some], asked[live][:, some]
        columns, leaf_b = spans(data.first[leaves], data.last[leaves])
        ids = data.ids[columns]
        scores = (own[rows] @ other[columns].T).astype(np.int64)
        wanted = asked[:, leaf_b]
        self.scored += int(wanted.sum())
        scores[~wanted | (q.ids[rows][:, None] == ids)] = NOTHING
        all_scores = np.concatenate([self.scores[rows], scores], axis=1)
        kth = np.partition(all_scores, -self.k, axis=1)[:, -self.k]
        least = np.maximum(kth, self.floor[rows])
        i, j = np.nonzero((all_scores >= least[:, None]) & (all_scores > NOTHING))
        from_new = j >= self.k
        found = np.where(from_new, ids[np.where(from_new, j - self.k, 0)], self.ids[rows[i], np.where(from_new, 0, j)])
        value = all_scores[i, j]
        order = np.lexsort((found, -value, i))
        i, found, value = i[order], found[order], value[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i, side="left")
        top = rank < self.k
        at = rows[i[top]]
        self.scores[rows], self.ids[rows] = NOTHING, np.iinfo(np.int64).max
        self.scores[at, rank[top]], self.ids[at, rank[top]] = value[top], found[top]
        self.floor[rows] = np.maximum(self.floor[rows], self.scores[rows, -1])


def spans(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places from each first to its last, and which of the spans each is of."""
    sizes = last - first
    which = np.repeat(np.arange(len(first)), sizes)
    return np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[which], which


# ---------------------------------------------------------------- in Spark


def vectors(df: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """(id, v), one row an id."""
    whole = df.select(F.col(vec_id).cast("long").alias("id"), quantised(F.col(embedding), scale).alias("v"))
    return whole.filter("id IS NOT NULL AND v IS NOT NULL").groupBy("id").agg(F.min("v").alias("v"))


def centres_of(rows: DataFrame) -> np.ndarray:
    """A cover of a drawn sample; its first ones cover it too, less tightly."""
    total = rows.count()
    drawn = rows.filter(F.pmod(F.xxhash64("id"), F.lit(max(1, -(-total // SAMPLE)))) == 0).select("id", "v").toPandas()
    if drawn.empty:
        return np.zeros((1, 1))
    points = matrix_of(list(drawn.sort_values("id")["v"])).astype(np.float64)
    return points[farthest_first(points, CENTRES, 0.0)[0]]


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    own = np.pad(centres, ((0, 0), (0, points.shape[1] - centres.shape[1])))
    return ((own**2).sum(axis=1) - 2 * points @ own.T).argmin(axis=1)


def divided(rows: DataFrame, covers: dict[int, np.ndarray], out: str) -> DataFrame:
    """(id, v, at): group ``at`` becomes ``at`` * CENTRES + the nearest centre of its cover, or 0 where it has none."""
    shared = rows.sparkSession.sparkContext.broadcast(covers)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, at = batch.column("v").to_pylist(), batch.column("at").to_numpy()
            width = max([1, *map(len, lists), *(c.shape[1] for c in shared.value.values())])
            points, new = matrix_of(lists, width).astype(np.float64), at * CENTRES
            for group in np.unique(at).tolist():
                if group in shared.value:
                    own = at == group
                    new[own] += nearest(points[own], shared.value[group])
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(new)], names=["id", "v", "at"])

    found = written(rows.mapInArrow(deal, "id long, v array<long>, at long"), out)
    shared.destroy()
    return found


def group_covers(dealt: DataFrame, large: dict[int, int]) -> dict[int, np.ndarray]:
    """Covers of samples of the large groups (their rows by group)."""
    parts = 1 << 20
    share = F.create_map(*(F.lit(x) for at, n in large.items() for x in (at, min(parts, parts * GROUP_SAMPLE // n + 1))))
    drawn = dealt.filter(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(parts)) < share[F.col("at")])

    def cover(table: pa.Table) -> pa.Table:
        points = matrix_of(table.sort_by("id").column("v").to_pylist()).astype(np.float64)
        centres = points[farthest_first(points, CENTRES, 0.0)[0]]
        return pa.table({"at": table.column("at").slice(0, 1), "cover": pa.array([pickle.dumps(centres)], pa.binary())})

    found = drawn.groupBy("at").applyInArrow(cover, "at long, cover binary").collect()
    return {r["at"]: pickle.loads(r["cover"]) for r in found}


def trees(rows: DataFrame, centres: np.ndarray, block: int, leaf: int) -> DataFrame:
    """(block, at, centre, radius, tree): every row in the tree of one block of group ``at``."""
    dealt = divided(rows.select("id", "v", F.lit(0).cast("long").alias("at")), {0: centres}, "dealt")
    for level in range(LEVELS + 1):
        # at most CENTRES ** (level + 1) rows
        sizes = {r["at"]: r["rows"] for r in dealt.groupBy("at").agg(F.count(F.lit(1)).alias("rows")).collect()}
        large = {at: n for at, n in sizes.items() if n > block}
        if not large or level == LEVELS or len(large) > GROUPS:
            break
        dealt = divided(dealt, group_covers(dealt, large), "dealt")
    keyed = dealt.withColumn("block", F.col("at") * (1 << 32))
    if large:
        parts = F.create_map(*(F.lit(x) for at, n in large.items() for x in (at, -(-n // block))))[F.col("at")]
        keyed = keyed.withColumn("block", F.col("block") + F.pmod(F.xxhash64("id"), F.coalesce(parts, F.lit(1))))

    def grow(table: pa.Table) -> pa.Table:
        tree = Tree(table.column("id").to_numpy(), matrix_of(table.column("v").to_pylist()), leaf)
        return pa.table({
            "block": table.column("block").slice(0, 1), "at": table.column("at").slice(0, 1), "centre": pa.array([tree.centres[0]], pa.list_(pa.float64())),
            "radius": pa.array([tree.radii[0]]), "tree": pa.array([pickle.dumps(tree)], pa.binary()),
        })

    return keyed.groupBy("block").applyInArrow(grow, "block long, at long, centre array<double>, radius double, tree binary")


def _norm(v: str) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))


def _inner(a: str, b: str) -> Column:
    zero = F.lit(0.0)
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.coalesce(x, zero) * F.coalesce(y, zero)), zero, lambda s, x: s + x)


def group_nodes(data: DataFrame) -> DataFrame:
    """(at, centre, radius): a node above the blocks of each group, around the centre of one of them."""
    balls = data.select("at", "block", "centre", "radius")
    centre = balls.groupBy("at").agg(F.min(F.struct("block", "centre"))["centre"].alias("middle"))
    zero = F.lit(0.0)
    gaps = F.zip_with("centre", "middle", lambda x, y: F.pow(F.coalesce(x, zero) - F.coalesce(y, zero), F.lit(2.0)))
    reach = F.sqrt(F.aggregate(gaps, zero, lambda s, x: s + x)) + F.col("radius")
    return balls.join(centre, "at").groupBy("at").agg(F.first("middle").alias("centre"), F.max(reach).alias("radius"))


def block_pairs(queries: DataFrame, groups: DataFrame, data: DataFrame, nearest_: int | None = None) -> DataFrame:
    """(q, b, most): pairs of query block and data block that may hold one of the best, with the bound of their products.

    ``queries`` has block, centre, radius and ``worst``, the score that a bound must reach.  With
    ``nearest_`` only that many groups of highest bound are descended to.
    """
    held = groups.collect()  # at most CENTRES ** (LEVELS + 1) rows
    width = max([1, *(len(r["centre"]) for r in held)])
    centres = np.array([r["centre"] + [0.0] * (width - len(r["centre"])) for r in held]).reshape(len(held), width)
    radii, ats = np.array([r["radius"] for r in held]), np.array([r["at"] for r in held], dtype=np.int64)
    shared = queries.sparkSession.sparkContext.broadcast((centres, radii, np.sqrt((centres**2).sum(axis=1)), ats))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, radii, norms, ats = shared.value
        for batch in batches:
            for q, p, r, worst in zip(*(batch.column(c).to_pylist() for c in ("block", "centre", "radius", "worst")), strict=True):
                own = np.zeros(max(width, len(p)))
                own[: len(p)] = p
                limits = bound(centres @ own[:width], r, np.sqrt((own**2).sum()), radii, norms)
                keep = np.flatnonzero(limits >= worst)
                if nearest_ is not None:
                    keep = keep[np.argsort(-limits[keep], kind="stable")[:nearest_]]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keep), q)), pa.array(ats[keep])], names=["q", "at"])

    asked = queries.select("block", "centre", "radius", "worst")
    visited = asked.mapInArrow(visit, "q long, at long")
    left = asked.select(F.col("block").alias("q"), F.col("centre").alias("p"), F.col("radius").alias("r"), _norm("centre").alias("n"), "worst")
    right = data.select("at", F.col("block").alias("b"), F.col("centre").alias("p2"), F.col("radius").alias("r2"), _norm("centre").alias("n2"))
    most = bound(_inner("p", "p2"), F.col("r"), F.col("n"), F.col("r2"), F.col("n2"))
    return visited.join(right, "at").join(left, "q").select("q", "b", most.alias("most"), "worst").filter("most >= worst").drop("worst")


def searched(pairs: DataFrame, queries: DataFrame, data: DataFrame, known: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score): the best k of each query in each pair of blocks, none below what is known.

    ``known`` has a row a query block: q, ids, floors (kth scores).
    """
    rows = (
        pairs.select("q", "b")
        .join(queries.select(F.col("block").alias("q"), F.col("tree").alias("q_tree")), "q")
        .join(known, "q", "left")
        .join(data.select(F.col("block").alias("b"), F.col("tree").alias("b_tree")), "b")
        .select("q_tree", "b_tree", "ids", "floors")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k_row in range(batch.num_rows):
                q, b, ids, floors = (batch.column(c)[k_row].as_py() for c in ("q_tree", "b_tree", "ids", "floors"))
                own = pickle.loads(q)
                at = dict(zip(ids or (), floors or (), strict=True))
                search = Search(own, k, np.array([at.get(i, NOTHING) for i in own.ids.tolist()], dtype=np.int64))
                search.against(pickle.loads(b))
                got = search.scores > NOTHING
                row = np.nonzero(got)[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own.ids[row]), pa.array(search.ids[got]), pa.array(search.scores[got])], names=["query_id", "vec_id", "score"])

    return rows.mapInArrow(work, "query_id long, vec_id long, score long")


def ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The k highest inner products of each of ``queries`` (id, v) with the other rows of ``rows`` (id, v)."""
    rows, queries = written(rows, "vectors"), written(queries, "queries")
    centres = centres_of(rows)
    data = written(trees(rows, centres, BLOCK, LEAF), "data-trees")
    few = max(1, min(len(centres), -(-queries.count() // QUERY_BLOCK)))
    asked = written(trees(queries, centres[:few], QUERY_BLOCK, QUERY_LEAF), "query-trees")
    groups = written(group_nodes(data), "groups")
    pairs = block_pairs(asked.withColumn("worst", F.lit(float("-inf"))), groups, data, SEEDS)

    best = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("most"), "b"))
    seeds = written(pairs.withColumn("rank", best).filter(F.col("rank") <= SEEDS).select("q", "b"), "seeds")
    nothing = asked.select(F.col("block").alias("q")).filter("false").selectExpr("q", "array(0L) AS ids", "array(0L) AS floors")
    first = written(searched(seeds, asked, data, nothing, k), "first")

    kth = ranked(first, k).filter(F.col("rank") == k).select(F.col("query_id").alias("id"), "score")
    blocks = members(asked)
    floors = blocks.join(kth, "id", "left").select("q", "id", F.coalesce("score", F.lit(NOTHING)).alias("floor"))
    known = written(
        floors.groupBy("q").agg(F.collect_list(F.struct("id", "floor")).alias("all_"), F.min("floor").alias("worst"))
        .select("q", F.col("all_.id").alias("ids"), F.col("all_.floor").alias("floors"), "worst"),
        "known",
    )
    open_ = asked.join(known.select(F.col("q").alias("block"), F.col("worst").cast("double").alias("worst")), "block")
    left = block_pairs(open_, groups, data).select("q", "b").join(seeds, ["q", "b"], "left_anti")
    rest = searched(left, asked, data, known.drop("worst"), k)
    return ranked(first.unionAll(rest), k)


def members(asked: DataFrame) -> DataFrame:
    """(q, id): the ids in each tree."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, tree in zip(batch.column("block").to_pylist(), batch.column("tree").to_pylist(), strict=True):
                ids = pickle.loads(tree).ids
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), block)), pa.array(ids)], names=["q", "id"])

    return asked.select("block", "tree").mapInArrow(work, "q long, id long")
