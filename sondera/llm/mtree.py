"""Exact top-k inner-product search by best-first search of M-trees.

Inner products are no metric, so every vector x gets one more coordinate
sqrt(M - |x|**2), where M is the largest squared norm, and a query q gets 0. Then
d(q, x)**2 = |q|**2 + M - 2 <q, x>: nearest neighbours are highest scores.

Rows go to the cell of their nearest pivot; pivots are drawn rows, one for about
SHARD_ROWS rows and PIVOTS at most, and a cell of more rows, such as copies of one vector,
is dealt by hash into shards of about SHARD_ROWS. So the cells are the top level of one
tree: each has its pivot and a covering radius, and each shard is bulk loaded into an
M-tree whose pages are rows of a table. A page holds its entries' vectors, covering radii
(0 in leaves) and distances to the page's own routing object. A search keeps a queue of
pages by the least distance possible in them, and skips an entry without computing its
distance if |d(q, parent) - d(entry, parent)| - radius exceeds the k-th best.

A query is first searched in its nearest cell, and then, with the k-th best distance found
there, in every shard whose cell can hold anything nearer. Bounds have a slack above
rounding errors; scores are computed in integers. Queries meet shards by shuffle, in
blocks of about BLOCK_QUERIES, so neither the driver nor a task holds all of them.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

SHARD_ROWS = 16_384
LEAF_ENTRIES = 1024
FAN_OUT = 16
#: Pivots that workers hold; with 64 components 2 MB.
PIVOTS = 4_096
#: Queries of a block; with 64 components 4 MB.
BLOCK_QUERIES = 8_192
SCALE = 64
PAGES_SCHEMA = "dims int, cell int, salt int, page int, leaf boolean, ids binary, vectors binary, radii binary, to_parent binary, children binary"
FOUND_SCHEMA = "query_row long, query_id long, vec_id long, score long"


def quantised(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and floor(scale * x) of each component; rows with a null id, a null vector or a null or non-finite component go."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    wide = F.transform("embedding", lambda x: x.cast("double")).alias("wide")
    rows = embeddings.select("vec_id", wide).filter(F.col("vec_id").isNotNull() & F.col("wide").isNotNull() & F.forall("wide", fine))
    return rows.select("vec_id", F.transform("wide", lambda x: F.floor(F.lit(float(scale)) * x).cast("long")).alias("v"))


def _extra(vectors: np.ndarray, most: int) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, most - (vectors.astype(np.float64) ** 2).sum(1)))


def _distances(points: np.ndarray, extra: np.ndarray, one: np.ndarray, one_extra: float) -> np.ndarray:
    return np.sqrt(((points - one) ** 2).sum(1) + (extra - one_extra) ** 2)


def build(vectors: np.ndarray, ids: np.ndarray, most: int, leaf_entries: int = LEAF_ENTRIES, fan_out: int = FAN_OUT) -> list[tuple]:
    """Pages (page, leaf, ids, vectors, radii, distances to the page's routing object, child pages); page 0 is the root.

    Clusters around drawn routing objects become subtrees; points that no routing object
    divides, such as copies, are cut in order.
    """
    points, extra = vectors.astype(np.float64), _extra(vectors, most)
    draw = np.random.default_rng(len(vectors))
    pages: list[tuple] = []
    todo: list[tuple[int, np.ndarray, int]] = [(0, np.arange(len(vectors)), 0)] if len(vectors) else []
    numbers = 1
    while todo:
        page, rows, routing = todo.pop()
        to_parent = lambda xs, r=routing: _distances(points[xs], extra[xs], points[r], extra[r])
        if len(rows) <= leaf_entries:
            pages.append((page, True, ids[rows], vectors[rows], np.zeros(len(rows)), to_parent(rows), np.zeros(0, np.int64)))
            continue
        pivots = draw.choice(rows, min(fan_out, -(-len(rows) // leaf_entries) + 1), replace=False)
        near = np.stack([_distances(points[rows], extra[rows], points[p], extra[p]) for p in pivots], 1)
        owner = near.argmin(1)
        if np.bincount(owner).max() == len(rows):
            owner = np.arange(len(rows)) * len(pivots) // len(rows)
        kept = [k for k in range(len(pivots)) if (owner == k).any()]
        children = np.arange(numbers, numbers + len(kept))
        numbers += len(kept)
        pages.append((page, False, ids[pivots[kept]], vectors[pivots[kept]], np.array([near[owner == k, k].max() for k in kept]), to_parent(pivots[kept]), children))
        todo.extend((int(c), rows[owner == k], int(pivots[k])) for c, k in zip(children, kept, strict=True))
    return pages


class Tree:
    """A loaded shard. ``root_distance`` of page 0 is unknown, so its entries are all computed."""

    def __init__(self, pages: dict[int, tuple], most: int):
        self.pages, self.most = pages, most
        self.computed = 0  # distances so far

    def search(self, query: np.ndarray, own_id: int, k: int, reach: float = math.inf) -> tuple[np.ndarray, np.ndarray]:
        """The k highest scores and their ids, ties to smaller ids, without ``own_id``; those farther than ``reach`` may lack."""
        exact = query.dtype != object
        norm = float((query * query).sum())
        top = norm + self.most
        slack = 1e-6 * (1.0 + math.sqrt(top))
        best_scores, best_ids = query[:0], np.zeros(0, np.int64)
        queue = [(0.0, 0, math.nan)]
        while queue:
            least, page, parent = heapq.heappop(queue)
            if least > reach + slack:
                break
            leaf, ids, vectors, radii, to_parent, children = self.pages[page]
            if parent == parent and reach < math.inf:
                keep = np.abs(parent - to_parent) - radii <= reach + slack
                if not keep.all():
                    ids, vectors, radii = ids[keep], vectors[keep], radii[keep]
                    children = children if leaf else children[keep]
            scores = vectors @ query
            self.computed += len(ids)
            if not leaf:
                far = np.sqrt(np.maximum(0.0, top - 2.0 * scores.astype(np.float64)))
                for d, r, c in zip(far.tolist(), radii.tolist(), children.tolist(), strict=True):
                    if d - r <= reach + slack:
                        heapq.heappush(queue, (max(0.0, d - r), c, d))
                continue
            take = ids != own_id
            if len(best_ids) >= k:
                take &= scores >= best_scores[-1]
            if take.any():
                best_scores, best_ids = np.concatenate([best_scores, scores[take]]), np.concatenate([best_ids, ids[take]])
                order = np.lexsort((best_ids, -best_scores))[:k] if exact else np.array(sorted(range(len(best_ids)), key=lambda i: (-best_scores[i], best_ids[i]))[:k])
                best_scores, best_ids = best_scores[order], best_ids[order]
                if len(best_ids) >= k:
                    reach = min(reach, math.sqrt(max(0.0, top - 2.0 * float(best_scores[-1]))))
        return best_scores, best_ids


def _matrix(column: pd.Series, dims: int) -> np.ndarray:
    return np.array([np.asarray(x, np.int64) for x in column], np.int64).reshape(len(column), dims)


class Cells:
    """Pivots of vectors of one length, by number; after counting also the radius and the number of shards of each cell."""

    def __init__(self, pivots: np.ndarray, most: int):
        self.pivots, self.most = pivots.astype(np.float64), most
        self.extra = _extra(pivots, most)
        self.radii = np.zeros(len(pivots))
        self.shards = np.zeros(len(pivots), np.int64)

    def distances(self, vectors: np.ndarray, extra: np.ndarray) -> np.ndarray:
        """Of each vector to each pivot. Where vectors are so long that rounding shows, slack() covers it."""
        v = vectors.astype(np.float64)
        square = ((v * v).sum(1) + extra**2)[:, None] + ((self.pivots**2).sum(1) + self.extra**2)[None] - 2.0 * (v @ self.pivots.T + np.outer(extra, self.extra))
        return np.sqrt(np.maximum(0.0, square))

    def slack(self) -> float:
        """More than the error of distances(): the square's rounding error is some 1e-15 of 4 M, and a root of it is added."""
        return 1e-6 * (1.0 + math.sqrt(float(self.most))) + math.sqrt(1e-12 * (4.0 * float(self.most) + 1.0))


def pivots(vectors: DataFrame, rows: int, most: int, shard_rows: int = SHARD_ROWS) -> dict[int, Cells]:
    """Cells of each vector length, around rows drawn by a hash of their numbers."""
    wanted = max(1, min(PIVOTS, -(-rows // shard_rows)))
    drawn = vectors.orderBy(F.xxhash64("row"), "row").limit(wanted).select("v")
    one_each = vectors.groupBy("dims").agg(F.first("v").alias("v")).select("v").limit(PIVOTS)
    found: dict[int, list] = {}
    for r in drawn.unionByName(one_each).collect():  # 2 * PIVOTS rows at most
        found.setdefault(len(r.v), []).append(r.v)
    return {d: Cells(np.unique(np.array(v, np.int64).reshape(len(v), d), axis=0), most) for d, v in found.items()}


def assigned(vectors: DataFrame, cells: dict[int, Cells]) -> DataFrame:
    """The rows with their cell and their distance to its pivot. A length without pivots is in cell 0, of no bound."""
    shared = vectors.sparkSession.sparkContext.broadcast(cells)

    def run(batches):
        for batch in batches:
            by_dims: dict[int, list[int]] = {}
            values = batch.column(batch.schema.get_field_index("v")).to_pylist()
            for n, v in enumerate(values):
                by_dims.setdefault(len(v), []).append(n)
            cell, far = np.zeros(len(values), np.int32), np.full(len(values), np.inf)
            for d, at in by_dims.items():
                if (own := shared.value.get(d)) is not None:
                    m = np.array([values[n] for n in at], np.int64).reshape(len(at), d)
                    all_far = own.distances(m, _extra(m, own.most))
                    cell[at] = all_far.argmin(1)
                    far[at] = all_far.min(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(far)], names=[*batch.schema.names, "cell", "far"])

    fields = ", ".join(f"{n} {t}" for n, t in vectors.dtypes)
    return vectors.mapInArrow(run, f"{fields}, cell int, far double")


KEYS = ["dims", "cell", "salt"]


def index(placed: DataFrame, most: int) -> DataFrame:
    """The pages of all shards' trees; every row of ``placed`` (vec_id, v and KEYS) is in one leaf."""

    def run(key, part: pd.DataFrame) -> pd.DataFrame:
        pages = build(_matrix(part["v"], int(key[0])), part["vec_id"].to_numpy(np.int64), most)
        made = [(*map(int, key), p, leaf, *(x.tobytes() for x in rest)) for p, leaf, *rest in pages]
        return pd.DataFrame(made, columns=[f.split()[0] for f in PAGES_SCHEMA.split(", ")])

    return placed.select("vec_id", "v", *KEYS).groupBy(*KEYS).applyInPandas(run, PAGES_SCHEMA)


def search(pages: DataFrame, asked: DataFrame, k: int, most: int, blocks: int) -> DataFrame:
    """The k best of each shard for each query sent to it. asked: query_row, vec_id, v, reach and KEYS."""
    exact = most < 1 << 53
    kind = np.float64 if exact else object

    def run(key, part: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        dims, loaded, out = int(key[0]), {}, []
        if len(part) and len(queries):
            for row in part.itertuples(index=False):
                ids = np.frombuffer(row.ids, np.int64)
                vectors = np.frombuffer(row.vectors, np.int64).reshape(len(ids), dims).astype(kind)
                loaded[row.page] = (row.leaf, ids, vectors, np.frombuffer(row.radii), np.frombuffer(row.to_parent), np.frombuffer(row.children, np.int64))
            tree = Tree(loaded, most)
            for q in queries.itertuples(index=False):
                scores, ids = tree.search(np.asarray(q.v, np.int64).astype(kind), q.vec_id, k, q.reach)
                scores = scores.astype(np.int64) if exact else [min(max(int(x), -(1 << 63)), (1 << 63) - 1) for x in scores]
                out.append(pd.DataFrame({"query_row": q.query_row, "query_id": q.vec_id, "vec_id": ids, "score": scores}))
        return pd.concat(out) if out else pd.DataFrame({c.split()[0]: pd.Series(dtype="int64") for c in FOUND_SCHEMA.split(", ")})

    copies = pages.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("query_row"), F.lit(blocks)).cast("int"))
    return copies.groupBy(*KEYS, "block").cogroup(dealt.groupBy(*KEYS, "block")).applyInPandas(run, FOUND_SCHEMA)


def other_shards(asked: DataFrame, cells: dict[int, Cells]) -> DataFrame:
    """The queries (query_row, vec_id, v, dims, home cell and salt, reach), one row for each further shard that can hold anything within reach."""
    shared = asked.sparkSession.sparkContext.broadcast(cells)
    names = ["query_row", "vec_id", "v", "reach", "dims"]

    def run(batches):
        for batch in batches:
            rows, cell_of, salt_of = [], [], []
            columns = {n: batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("v", "reach", "cell", "salt")}
            for n, (v, reach, home, salt) in enumerate(zip(*columns.values(), strict=True)):
                own = shared.value[len(v)]
                q = np.array([v], np.int64)
                # The query's own extra coordinate is 0.
                far = own.distances(q, np.zeros(1))[0]
                for c in np.flatnonzero((own.shards > 0) & (far - own.radii <= reach + own.slack())).tolist():
                    others = [x for x in range(int(own.shards[c])) if (c, x) != (home, salt)]
                    rows += [n] * len(others)
                    cell_of += [c] * len(others)
                    salt_of += others
                if len(rows) > 20_000:
                    yield emit(batch, rows, cell_of, salt_of)
                    rows, cell_of, salt_of = [], [], []
            yield emit(batch, rows, cell_of, salt_of)

    def emit(batch, rows, cell_of, salt_of):
        taken = batch.take(pa.array(rows, pa.int64()))
        return pa.RecordBatch.from_arrays([*[taken.column(taken.schema.get_field_index(n)) for n in names], pa.array(cell_of, pa.int32()), pa.array(salt_of, pa.int32())], names=[*names, "cell", "salt"])

    return asked.select(*names, "cell", "salt").mapInArrow(run, "query_row long, vec_id long, v array<long>, reach double, dims int, cell int, salt int")


def top_k(embeddings: DataFrame, is_query, k: int = 20, scale: int = SCALE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for each row where ``is_query`` holds.

    Candidates are all rows of the query's vector length but those of its own vec_id;
    with fewer than k, all are returned. Equal scores rank by vec_id; repeated rows are
    candidates each. Rows without a usable vector or id take no part. Extra columns are
    ignored; without rows or queries the result is empty.
    """
    from sondera.llm.common import staged

    vectors = staged(quantised(embeddings, scale).select("vec_id", "v", F.size("v").alias("dims"), F.monotonically_increasing_id().alias("row")), "vectors")
    # Squares are summed as decimals, in which 10**38 is out of reach of any usable input.
    square = F.aggregate("v", F.lit(0).cast("decimal(38,0)"), lambda a, x: (a + x.cast("decimal(19,0)") * x.cast("decimal(19,0)")).cast("decimal(38,0)"))
    rows, most = vectors.agg(F.count(F.lit(1)), F.max(square)).first()
    most = int(most or 0)
    cells = pivots(vectors, rows, most, shard_rows)
    placed = staged(assigned(vectors, cells), "placed")
    for r in placed.groupBy("dims", "cell").agg(F.max("far").alias("far"), F.count(F.lit(1)).alias("n")).collect():  # a row a cell
        own = cells.setdefault(r.dims, Cells(np.zeros((1, r.dims), np.int64), most))
        own.radii[r.cell], own.shards[r.cell] = r.far, -(-r.n // shard_rows)
    sizes = vectors.sparkSession.createDataFrame([(d, c, int(n)) for d, x in cells.items() for c, n in enumerate(x.shards)], "dims int, cell int, shards int")
    placed = placed.join(F.broadcast(sizes), ["dims", "cell"]).withColumn("salt", F.pmod(F.xxhash64("row"), F.col("shards")).cast("int"))
    pages = staged(index(placed, most), "mtree")
    asked = staged(placed.filter(is_query).select(F.col("row").alias("query_row"), "vec_id", "v", *KEYS), "queries")
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    home = staged(search(pages, asked.withColumn("reach", F.lit(float("inf"))), k, most, blocks), "home")
    # The distance of the k-th best at home bounds what other shards need to look at.
    worst = home.groupBy("query_row").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= k)
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    reach = F.sqrt(F.greatest(F.lit(0.0), norm + float(most) - 2.0 * F.col("least").cast("double")))
    bounded = asked.join(worst, "query_row", "left").withColumn("reach", F.when(F.col("n") >= k, reach).otherwise(F.lit(float("inf"))))
    found = home.unionByName(search(pages, other_shards(bounded, cells), k, most, blocks))
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast(T.IntegerType()).alias("rank"), "vec_id", "score")
