"""Embedding near-dedup: exact threshold links by cover trees walked in pairs.

Unit vectors are dealt to blocks by the nearest of a few pivots, so that close
vectors share a block. Each block is a cover tree: nested levels whose radii
halve, every node knowing the exact radius that covers its vectors. Pairs of
blocks, and in them pairs of nodes, are dropped when their centres are further
apart than both radii and the threshold allow, and linked as a whole when they
are so near that every pair of their vectors is within it. What remains is
compared vector by vector in double precision.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_or_shuffled, smallest_hashes
from tidemark.llm.graph import components
from tidemark.session import materialised

#: Vectors in a block, roughly, and the most pivots taken.
BLOCK_ROWS = 8192
MOST_PIVOTS = 256
#: Slack of every bound, far above the rounding of a distance, below what matters.
SLACK = 1e-6
#: Slack of the single-precision products that only drop pairs.
COARSE_SLACK = np.float32(1e-4)
#: Children pairs of two nodes from which their distances are a matrix product.
WIDE = 1024
#: Rows held against the centres of a cover at a time.
STRIP = 512
#: Node pairs whose distance is computed at a time.
CHUNK = 1 << 16


class CoverTree:
    """Vectors of one block in tree order; every node is a range of them.

    A node's first vector is its centre. Children of a node at level l are
    centres further than 2 / 2**l apart that cover the node's vectors within that
    radius; the node's centre is the first of them, so levels are nested. ``radius``
    is the exact distance to the furthest vector of the range.
    """

    def __init__(self, unit: np.ndarray) -> None:
        n = len(unit)
        self.order = np.empty(n, dtype=np.int64)
        self.lo: list[int] = []
        self.hi: list[int] = []
        self.radius: list[float] = []
        self.children: list[list[int]] = []
        filled = 0
        stack: list[tuple[np.ndarray, float, int]] = [(np.arange(n), 2.0, -1)] if n else []
        # depth first, so that a node's range is filled before its next sibling's
        while stack:
            rows, reach, parent = stack.pop()
            node = len(self.lo)
            far = _distances(unit[rows], unit[rows[0]]) if len(rows) > 1 else np.zeros(1)
            self.lo.append(filled)
            self.hi.append(filled + len(rows))
            self.radius.append(float(far.max()))
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(node)
            if len(rows) == 1 or reach < 1e-7:
                self.order[filled : filled + len(rows)] = rows
                filled += len(rows)
                continue
            while reach / 2 >= far.max():  # a level that would not part anything
                reach /= 2
                if reach < 1e-7:
                    break
            groups = _net(unit, rows, reach / 2)
            stack += [(g, reach / 2, node) for g in reversed(groups)]
        self.unit = unit[self.order]
        self.lo_, self.hi_ = np.array(self.lo, dtype=np.int64), np.array(self.hi, dtype=np.int64)
        self.radius_ = np.array(self.radius)


def _distances(rows: np.ndarray, centre: np.ndarray) -> np.ndarray:
    d = rows - centre
    return np.sqrt(np.einsum("ij,ij->i", d, d))


def _net(unit: np.ndarray, rows: np.ndarray, reach: float) -> list[np.ndarray]:
    """Greedy cover of ``rows``: groups around centres, each led by its centre.

    A row within ``reach`` of a centre joins it, any other becomes one. Rows come in
    strips, held against all centres by one matrix product. Which centre a row
    joins is of no matter: a node's radius is measured from what it got.
    """
    kind = np.float32 if reach > 0.01 else np.float64
    points, near = unit[rows].astype(kind), 1 - reach * reach / 2
    centres = np.empty_like(points)
    found: list[int] = []
    label = np.empty(len(rows), dtype=np.int64)
    for start in range(0, len(rows), STRIP):
        strip = points[start : start + STRIP]
        free = np.ones(len(strip), dtype=bool)
        if found:
            products = strip @ centres[: len(found)].T
            best = products.argmax(axis=1)
            free = products[np.arange(len(strip)), best] < near
            label[start : start + len(strip)] = best
        at = np.flatnonzero(free)
        among = strip[at] @ strip[at].T >= near
        alone = np.ones(len(at), dtype=bool)
        for i in range(len(at)):
            if alone[i]:
                takes = among[i] & alone
                takes[i] = True
                label[start + at[takes]] = len(found)
                centres[len(found)] = strip[at[i]]
                found.append(start + int(at[i]))
                alone &= ~takes
    lead = np.ones(len(rows), dtype=np.int8)
    lead[found] = 0
    order = np.lexsort((lead, label))
    cuts = np.flatnonzero(np.diff(label[order])) + 1
    return [rows[g] for g in np.split(order, cuts)]


def _pack(members: list[tuple[int, int]], tree: CoverTree) -> bytes:
    """A block as bytes: ids and weights in tree order, vectors, nodes."""
    ids = np.array([m[0] for m in members], dtype=np.int64)[tree.order]
    weights = np.array([m[1] for m in members], dtype=np.int64)[tree.order]
    starts = np.cumsum([0, *map(len, tree.children)])
    kids = np.array([c for cs in tree.children for c in cs], dtype=np.int64)
    return pickle.dumps(
        (ids, weights, tree.unit, tree.lo_, tree.hi_, tree.radius_, starts, kids), protocol=5
    )


class Block:
    """A packed block, ready to be walked."""

    def __init__(self, data: bytes) -> None:
        (self.ids, self.weights, self.unit, self.lo, self.hi, self.radius, self.starts,
         self.kids) = pickle.loads(data)
        self.total = np.concatenate([[0], np.cumsum(self.weights)])

    def mass(self, nodes: np.ndarray) -> np.ndarray:
        return self.total[self.hi[nodes]] - self.total[self.lo[nodes]]

    def size(self, nodes: np.ndarray) -> np.ndarray:
        return self.hi[nodes] - self.lo[nodes]


def _opened(block: Block, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The children of ``nodes``, and which of ``nodes`` each belongs to."""
    counts = block.starts[nodes + 1] - block.starts[nodes]
    owner = np.repeat(np.arange(len(nodes)), counts)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    return block.kids[block.starts[nodes][owner] + offset], owner


class Walk:
    """Links between two blocks, or inside one, found by descending both trees."""

    def __init__(self, a: Block, b: Block, cosine: float) -> None:
        self.a, self.b, self.same, self.cosine = a, b, a is b, cosine
        self.reach = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
        # partners and links run over a's vectors, then b's
        self.base = 0 if self.same else len(a.ids)
        size = self.base + len(b.ids)
        self.gain = np.zeros(size + 1, dtype=np.int64)  # differences of partner counts
        self.links: list[tuple[np.ndarray, np.ndarray]] = []

    def run(self) -> None:
        pending = [(np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64))]
        while pending:
            na, nb = pending.pop()
            if len(na) > CHUNK:
                half = len(na) // 2
                pending += [(na[half:], nb[half:]), (na[:half], nb[:half])]
                continue
            pending += self._step(na, nb)

    def _step(self, na: np.ndarray, nb: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        a, b = self.a, self.b
        if self.same:
            itself = na == nb
            inner = self._inside(na[itself])
            na, nb = na[~itself], nb[~itself]
        else:
            inner = []
        gap = self._gaps(na, nb)
        both = a.radius[na] + b.radius[nb]
        near = gap - both <= self.reach + SLACK
        na, nb, gap, both = na[near], nb[near], gap[near], both[near]
        ones = (a.size(na) == 1) & (b.size(nb) == 1)
        self._exact(a.lo[na[ones]], b.lo[nb[ones]])
        na, nb, gap, both = na[~ones], nb[~ones], gap[~ones], both[~ones]
        whole = gap + both <= self.reach - SLACK
        self._linked(na[whole], nb[whole])
        na, nb = na[~whole], nb[~whole]
        leaves = (a.starts[na + 1] == a.starts[na]) & (b.starts[nb + 1] == b.starts[nb])
        for x, y in zip(na[leaves], nb[leaves], strict=True):
            i, j = np.meshgrid(np.arange(a.lo[x], a.hi[x]), np.arange(b.lo[y], b.hi[y]))
            self._exact(i.ravel(), j.ravel())
        na, nb = na[~leaves], nb[~leaves]
        kids_a, kids_b = a.starts[na + 1] - a.starts[na], b.starts[nb + 1] - b.starts[nb]
        wide = kids_a * kids_b >= WIDE
        out = inner
        for x, y in zip(na[wide], nb[wide], strict=True):
            out += self._crossed(self._frontier(a, x), self._frontier(b, y))
        na, nb, kids_a, kids_b = na[~wide], nb[~wide], kids_a[~wide], kids_b[~wide]
        open_a = (kids_a > 0) & ((kids_b == 0) | (a.radius[na] >= b.radius[nb]))
        if open_a.any():
            kids, owner = _opened(a, na[open_a])
            out.append((kids, nb[open_a][owner]))
        if (~open_a).any():
            kids, owner = _opened(b, nb[~open_a])
            out.append((na[~open_a][owner], kids))
        return out

    def _inside(self, nodes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Pairs inside each of ``nodes``: linked as a whole, or pairs of children."""
        a, out = self.a, []
        for x in nodes:
            if a.size(x) == 1:
                continue
            lo, hi = a.lo[x], a.hi[x]
            kids = a.kids[a.starts[x] : a.starts[x + 1]]
            if 2 * a.radius[x] <= self.reach - SLACK:
                rows = np.arange(lo, hi)
                self.gain[lo] += a.total[hi] - a.total[lo]
                self.gain[hi] -= a.total[hi] - a.total[lo]
                np.subtract.at(self.gain, rows, a.weights[lo:hi])  # not its own weight
                np.add.at(self.gain, rows + 1, a.weights[lo:hi])
                self.links.append((rows, np.full(len(rows), lo)))
            elif len(kids) == 0:
                i, j = np.triu_indices(hi - lo, 1)
                self._exact(lo + i, lo + j)
            else:
                kids = self._frontier(a, x)
                out += [(kids, kids), *self._crossed(kids, kids)]
        return out

    def _frontier(self, block: Block, node: int) -> np.ndarray:
        """The nodes under ``node`` that are no wider than the threshold, or have no children.

        Bounds of wider nodes hardly drop anything, so these are opened first.
        """
        done, nodes = [], np.array([node])
        while len(nodes):
            counts = block.starts[nodes + 1] - block.starts[nodes]
            narrow = (counts == 0) | ((block.radius[nodes] <= self.reach / 2) & (nodes != node))
            done.append(nodes[narrow])
            nodes, _ = _opened(block, nodes[~narrow])
        return np.concatenate(done)

    def _crossed(
        self, kids_a: np.ndarray, kids_b: np.ndarray
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """The pairs of children within the bounds; of one node's own, each pair once.

        Wide nodes have many children, so their distances come from one matrix
        product per strip. It is in single precision, with a slack above its
        rounding: it only drops pairs, and what it leaves is looked at again.
        """
        a, b, out = self.a, self.b, []
        left, right = (
            x.unit[x.lo[k]].astype(np.float32) for x, k in ((a, kids_a), (b, kids_b))
        )
        radius_a, radius_b = a.radius[kids_a], b.radius[kids_b]
        wide_a, wide_b = np.flatnonzero(radius_a), np.flatnonzero(radius_b)

        def least(x: np.ndarray | float, y: np.ndarray | float) -> np.ndarray:
            """Least product of two centres whose nodes, of these radii, may hold a link."""
            return np.float32(1 - COARSE_SLACK) - ((self.reach + x + y) ** 2 / 2).astype(np.float32)

        single = least(np.zeros(1), 0.0)[0]
        strip = max(1, (1 << 21) // len(kids_b))
        for start in range(0, len(kids_a), strip):
            end = min(len(kids_a), start + strip)
            since = start if kids_a is kids_b else 0
            products = left[start:end] @ right[since:].T
            hit = products >= single
            rows = wide_a[(wide_a >= start) & (wide_a < end)] - start
            hit[rows] = products[rows] >= least(radius_a[start + rows, None], radius_b[None, since:])
            cols = wide_b[wide_b >= since] - since
            hit[:, cols] = products[:, cols] >= least(
                radius_a[start:end, None], radius_b[None, since + cols]
            )
            i, j = np.divmod(np.flatnonzero(hit), hit.shape[1])
            if kids_a is kids_b:
                i, j = i[j > i], j[j > i]
            out.append((kids_a[start + i], kids_b[since + j]))
        return out

    def _gaps(self, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
        d = self.a.unit[self.a.lo[na]] - self.b.unit[self.b.lo[nb]]
        return np.sqrt(np.einsum("ij,ij->i", d, d))

    def _exact(self, i: np.ndarray, j: np.ndarray) -> None:
        """Compare vector by vector."""
        for start in range(0, len(i), CHUNK):
            x, y = i[start : start + CHUNK], j[start : start + CHUNK]
            cosines = np.einsum("ij,ij->i", self.a.unit[x], self.b.unit[y])
            hit = cosines >= self.cosine
            x, y = x[hit], y[hit]
            np.add.at(self.gain, x, self.b.weights[y])
            np.subtract.at(self.gain, x + 1, self.b.weights[y])
            np.add.at(self.gain, self.base + y, self.a.weights[x])
            np.subtract.at(self.gain, self.base + y + 1, self.a.weights[x])
            self.links.append((x, self.base + y))

    def _linked(self, na: np.ndarray, nb: np.ndarray) -> None:
        """Every vector of one node with every vector of the other."""
        a, b = self.a, self.b
        np.add.at(self.gain, a.lo[na], b.mass(nb))
        np.subtract.at(self.gain, a.hi[na], b.mass(nb))
        np.add.at(self.gain, self.base + b.lo[nb], a.mass(na))
        np.subtract.at(self.gain, self.base + b.hi[nb], a.mass(na))
        for x, y in zip(na, nb, strict=True):
            rows = np.arange(a.lo[x], a.hi[x])
            self.links.append((rows, np.full(len(rows), self.base + b.lo[y])))
            rows = np.arange(b.lo[y], b.hi[y])
            self.links.append((self.base + rows, np.full(len(rows), a.lo[x])))

    def result(self) -> pd.DataFrame:
        """(id, partners, root) of the vectors with links; roots join what these links join."""
        size = len(self.gain) - 1
        partners = np.cumsum(self.gain[:-1])
        label = np.arange(size)
        if self.links:
            x = np.concatenate([p[0] for p in self.links])
            y = np.concatenate([p[1] for p in self.links])
            while True:
                least = label.copy()
                np.minimum.at(least, x, label[y])
                np.minimum.at(least, y, label[x])
                least = least[least]
                if (least == label).all():
                    break
                label = least
        ids = self.a.ids if self.same else np.concatenate([self.a.ids, self.b.ids])
        has = partners > 0
        return pd.DataFrame({"id": ids[has], "partners": partners[has], "root": ids[label[has]]})


def _grow(members: pd.DataFrame) -> pd.DataFrame:
    unit = np.vstack([np.asarray(v, dtype=np.float64) for v in members["embedding"]])
    # largest component first: squares of neither huge nor tiny numbers overflow
    unit /= np.abs(unit).max(axis=1, keepdims=True)
    unit /= np.sqrt(np.einsum("ij,ij->i", unit, unit))[:, None]
    packed = _pack(list(zip(members["class_id"], members["copies"], strict=True)), CoverTree(unit))
    return pd.DataFrame({"block": [members["block"].iloc[0]], "tree": [packed]})


def _walker(cosine: float):
    def walk(pair: pd.DataFrame) -> pd.DataFrame:
        left, right = int(pair["left"].iloc[0]), int(pair["right"].iloc[0])
        blocks = {int(b): Block(t) for b, t in zip(pair["block"], pair["tree"], strict=True)}
        found = Walk(blocks[left], blocks[right], cosine)
        found.run()
        return found.result()

    return walk


def _usable() -> Column:
    """Vectors that can have a cosine."""
    finite = F.forall(
        "embedding",
        lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)),
    )
    return F.coalesce(
        finite & F.exists("embedding", lambda x: x != 0), F.lit(False)
    )


def _blocks(classes: DataFrame, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their block, and (block, dims, pivot, least, most) of each block.

    Pivots are the vectors with the smallest hashes, at most MOST_PIVOTS, one per
    ``block_rows`` vectors. A cell with more vectors is dealt to several blocks.
    """
    n = classes.count()
    wanted = max(1, min(MOST_PIVOTS, n // block_rows))
    chosen = [
        (r["dims"], np.array(r["embedding"], dtype=np.float64))
        for r in smallest_hashes(classes.select("h1", "h2", "dims", "embedding"), "h1", wanted)
        .collect()
    ]
    pivots = [(d, v / np.linalg.norm(v / np.abs(v).max()) / np.abs(v).max()) for d, v in chosen]

    @F.pandas_udf("cell int, far double")
    def nearest(vectors: pd.Series) -> pd.DataFrame:
        cells = np.full(len(vectors), -1, dtype=np.int32)
        far = np.full(len(vectors), 2.0)
        dims = np.array([len(v) for v in vectors])
        for d in np.unique(dims):
            at = np.flatnonzero(dims == d)
            mine = [(i, p) for i, (size, p) in enumerate(pivots) if size == d]
            if not mine:
                continue
            unit = np.vstack([np.asarray(vectors.iloc[i], dtype=np.float64) for i in at])
            unit /= np.abs(unit).max(axis=1, keepdims=True)
            unit /= np.sqrt(np.einsum("ij,ij->i", unit, unit))[:, None]
            gaps = np.sqrt(
                np.maximum(0, 2 - 2 * (unit @ np.vstack([p for _, p in mine]).T))
            )
            best = gaps.argmin(axis=1)
            cells[at] = np.array([i for i, _ in mine], dtype=np.int32)[best]
            far[at] = gaps[np.arange(len(at)), best]
        return pd.DataFrame({"cell": cells, "far": far})

    placed = materialised(
        classes.withColumn("p", nearest("embedding")).select(
            "class_id", "copies", "dims", "embedding", "p.cell", "p.far"
        )
    )
    cells = placed.groupBy("dims", "cell").agg(F.count(F.lit(1)).alias("rows"))
    cells = cells.withColumn("parts", F.ceil(F.col("rows") / block_rows).cast("long"))
    dealt = placed.join(F.broadcast(cells.drop("rows")), ["dims", "cell"]).withColumn(
        "block",
        F.xxhash64("dims", "cell", F.pmod(F.xxhash64("class_id", F.lit("part")), "parts")),
    )
    blocks = dealt.groupBy("block", "dims", "cell").agg(
        F.min("far").alias("least"), F.max("far").alias("most")
    )
    gaps = classes.sparkSession.createDataFrame(
        [
            (i, j, float(np.linalg.norm(p - q)))
            for i, (d, p) in enumerate(pivots)
            for j, (e, q) in enumerate(pivots)
            if d == e
        ],
        "cell int, other int, gap double",
    )
    return dealt, _block_pairs(materialised(blocks), gaps)


def _block_pairs(blocks: DataFrame, gaps: DataFrame) -> DataFrame:
    """(left, right) of the pairs of blocks that can hold a link; see ``reach`` there.

    One row per block and pivot meets the blocks of that pivot: an equi-join of
    summaries. ``slack`` is how far apart any two of their vectors are at least.
    """
    a = blocks.select(
        F.col("block").alias("left"), "dims", "cell", F.col("least").alias("l1"),
        F.col("most").alias("m1"),
    )
    b = blocks.select(
        F.col("block").alias("right"), F.col("dims").alias("dims2"), F.col("cell").alias("other"),
        F.col("least").alias("l2"), F.col("most").alias("m2"),
    )
    unplaced = gaps.sparkSession.createDataFrame([(-1, -1, 0.0)], gaps.schema)
    apart = F.greatest(
        F.lit(0.0),
        F.col("gap") - F.col("m1") - F.col("m2"),
        F.col("l1") - F.col("gap") - F.col("m2"),
        F.col("l2") - F.col("gap") - F.col("m1"),
    )
    return (
        a.join(F.broadcast(gaps.unionByName(unplaced)), "cell")
        .join(b, "other")
        .where("dims = dims2 and left <= right")
        .select("left", "right", F.when(F.col("cell") >= 0, apart).otherwise(0.0).alias("apart"))
    )


def near_duplicates(
    vectors: DataFrame, cosine: float = 0.9, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Links at cosine >= ``cosine``: vec_id, n_links, component_id, kept, one row per row.

    n_links counts the other rows linked directly, component_id is the smallest
    vec_id that links reach, the own one included, and kept says it is the own one.

    Equal vectors are one class with a number of copies, so a vector that a third
    of all rows share is one row of the join. Links inside a dense group are
    counted by node ranges and joined by one edge per vector and block pair; they
    are not listed. A task holds two blocks of about ``block_rows`` vectors.

    A vector that is NULL, empty, zero, or holds NULL or non-finite components
    links with nothing: n_links 0, its own component. Vectors of different length
    never link. Rows that share a vec_id are separate rows. A NULL vec_id is no
    smallest id, unless its whole component has none: then component_id is NULL
    and kept true. An empty table gives no rows.
    """
    rows = vectors.select(
        "vec_id", F.when(_usable(), F.col("embedding")).alias("embedding")
    )
    # -0.0 and 0.0 are one value of a vector, but two of a hash
    same = F.transform("embedding", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x.cast("double")))
    rows = materialised(
        rows.withColumn("embedding", same)
        .withColumn("h1", F.xxhash64("embedding"))
        .withColumn("h2", F.xxhash64(F.lit(1), "embedding"))
    )
    usable = rows.where("embedding is not null")
    classes = materialised(
        usable.groupBy("h1", "h2")
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.min("vec_id").alias("least_id"),
            F.first("embedding").alias("embedding"),
        )
        .withColumn("class_id", F.monotonically_increasing_id())  # stored, so fixed
        .withColumn("dims", F.size("embedding"))
    )
    if classes.isEmpty():
        return rows.select(
            "vec_id", F.lit(0).cast("long").alias("n_links"),
            F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"),
        )
    dealt, pairs = _blocks(classes, block_rows)
    reach = float(np.sqrt(max(0.0, 2 - 2 * cosine))) + SLACK
    pairs = materialised(pairs.where(F.col("apart") <= reach).select("left", "right").distinct())
    trees = materialised(
        dealt.select("block", "class_id", "copies", "embedding")
        .groupBy("block")
        .applyInPandas(_grow, "block long, tree binary")
    )
    sides = pairs.select("left", "right", F.explode(F.array_distinct(F.array("left", "right"))).alias("block"))
    found = materialised(
        sides.join(trees, "block")
        .groupBy("left", "right")
        .applyInPandas(_walker(cosine), "id long, partners long, root long")
    )
    counts = found.groupBy(F.col("id").alias("class_id")).agg(F.sum("partners").alias("partners"))
    roots = components(found, "id", "root")
    grouped = materialised(
        classes.select("class_id", "h1", "h2", "copies", "least_id")
        .join(counts, "class_id", "left")
        .join(roots, F.col("class_id") == F.col("node"), "left")
        .select(
            "h1",
            "h2",
            (F.col("copies") - 1 + F.coalesce("partners", F.lit(0))).alias("n_links"),
            F.coalesce("root", "class_id").alias("root"),
            "least_id",
        )
    )
    least = grouped.groupBy("root").agg(F.min("least_id").alias("component_id"))
    per_class = materialised(grouped.join(least, "root").drop("root", "least_id"))
    per_class = small_or_shuffled(per_class, 40)
    usable_row = F.col("embedding").isNotNull()
    component = F.when(usable_row, F.col("component_id")).otherwise(F.col("vec_id"))
    return rows.join(per_class, ["h1", "h2"], "left").select(
        "vec_id",
        F.when(usable_row, F.col("n_links")).otherwise(0).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
