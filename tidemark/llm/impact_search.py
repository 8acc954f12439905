"""Exact top-k inner products by an impact-ordered, score-at-a-time index.

Vectors of whole numbers are indexed in blocks. In a block every dimension holds
postings cut into segments of equal quantised impact. A query takes segments in
descending order of the score they can add, keeps an upper bound per row, and
stops once rows whose bound reaches the k-th best known score are few enough to
be scored exactly. Rows left out are proved out; nothing is approximate.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows in a block of the index, and queries in a block of queries.
INDEX_ROWS = 8192
QUERY_ROWS = 512
#: Quantised impact levels per dimension.
LEVELS = 16
#: Groups of segments between two looks at the bounds.
LOOKS = 8


class ImpactIndex:
    """Postings of one block: per dimension and level, the rows of that level.

    A value is worth most to a positive query weight where it is high and to a
    negative one where it is low, so a dimension's levels are walked from either
    end. ``low`` and ``high`` are exact least and greatest values of each level.
    """

    def __init__(self, ids: np.ndarray, values: np.ndarray, copies: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")  # ties in score go to the smaller id
        self.ids, self.values, self.copies = ids[order], values[order], copies[order]
        n, dims = self.values.shape
        least, most = self.values.min(axis=0), self.values.max(axis=0)
        step = np.maximum((most - least + 1) / LEVELS, 1e-9)
        level = np.minimum(((self.values - least) / step).astype(np.int64), LEVELS - 1)
        self.low = np.zeros((dims, LEVELS), dtype=np.int64)
        self.high = np.zeros((dims, LEVELS), dtype=np.int64)
        self.postings = np.empty((dims, n), dtype=np.int64)
        self.starts = np.zeros((dims, LEVELS + 1), dtype=np.int64)
        for d in range(dims):
            rows = np.argsort(level[:, d], kind="stable")
            starts = np.searchsorted(level[rows, d], np.arange(LEVELS + 1))
            self.postings[d], self.starts[d] = rows, starts
            for v in np.flatnonzero(np.diff(starts)):
                held = self.values[rows[starts[v] : starts[v + 1]], d]
                self.low[d, v], self.high[d, v] = held.min(), held.max()

    def _segments(self, query: np.ndarray) -> tuple[np.ndarray, ...]:
        """Dimension, level, impact and slack of all segments, best impact first.

        Impact is what a segment adds at most above the worst value of its
        dimension; slack is by how much a row of it may stay below that.
        """
        filled = np.diff(self.starts, axis=1) > 0
        weight = query[:, None]
        top = np.where(weight >= 0, weight * self.high, weight * self.low)
        low = np.where(weight >= 0, weight * self.low, weight * self.high)
        worst = np.where(filled, low, np.iinfo(np.int64).max).min(axis=1)
        impact = top - worst[:, None]
        dim, level = np.nonzero(filled & (weight != 0))
        order = np.argsort(-impact[dim, level], kind="stable")
        dim, level = dim[order], level[order]
        return dim, level, impact[dim, level], worst

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, ...]:
        """Ids, scores and copies of the ``k`` best rows other than ``own``; ties to smaller ids."""
        n = len(self.ids)
        dim, level, impact, worst = self._segments(query)
        base = int(worst[query != 0].sum())
        total_dims = int(np.count_nonzero(query))
        bound = np.zeros(n)  # most a row can have gained in the dimensions seen
        unseen = np.full(n, total_dims, dtype=np.float64)
        others = self.ids != own
        candidates = np.flatnonzero(others)
        best = -np.inf
        few = max(4 * k, n // 16)
        for part in np.array_split(np.arange(len(dim)), LOOKS):
            if len(candidates) <= few or len(part) == 0:
                break
            rows = [
                self.postings[d, self.starts[d, v] : self.starts[d, v + 1]]
                for d, v in zip(dim[part], level[part], strict=True)
            ]
            gains = np.repeat(impact[part].astype(np.float64), [len(r) for r in rows])
            touched = np.concatenate(rows)
            bound += np.bincount(touched, gains, minlength=n)
            unseen -= np.bincount(touched, minlength=n)
            frontier = float(impact[part[-1]])  # no segment still to come adds more
            upper = base + bound + unseen * frontier
            # exact scores of the rows that look best give a score that k rows reach
            probe = candidates
            if len(probe) > 4 * k:
                probe = probe[np.argpartition(-upper[probe], 4 * k)[: 4 * k]]
            scores = self.values[probe] @ query
            if len(scores) >= k:
                best = max(best, float(np.partition(scores, -k)[-k]))
            candidates = candidates[upper[candidates] >= best]
        scores = self.values[candidates] @ query
        order = np.lexsort((self.ids[candidates], -scores))[:k]
        return self.ids[candidates][order], scores[order], self.copies[candidates][order]


def _matrix(column: pd.Series, dims: int) -> np.ndarray:
    """Rows of whole numbers, shorter ones filled up with zeros."""
    out = np.zeros((len(column), dims), dtype=np.int64)
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def _search_block(k: int):
    def search(pair: pd.DataFrame) -> pd.DataFrame:
        dims = max(map(len, pair["vector"]), default=0)
        asked, held = pair[pair["query"]], pair[~pair["query"]]
        out: list[tuple[int, int, int, int]] = []
        if len(asked) and len(held):
            index = ImpactIndex(
                held["vec_id"].to_numpy(), _matrix(held["vector"], dims), held["copies"].to_numpy()
            )
            queries = zip(
                asked["vec_id"], _matrix(asked["vector"], dims), asked["copies"], strict=True
            )
            for own, q, times in queries:
                out += [
                    (int(own), int(i), int(s), min(k, int(c) * int(times)))
                    for i, s, c in zip(*index.search(q, own, k), strict=True)
                ]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score", "copies"]).astype("int64")

    return search


def whole_numbers(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, vector, copies): each component as floor(scale * x), of the rows that take part.

    Left out are NULL ids and vectors that are NULL or hold NULL or non-finite
    components. Rows equal in both are one row with their number as ``copies``; rows
    that share an id alone stay rows of their own. A component beyond 2**55 saturates.
    """
    numbers = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    finite = F.forall(
        "embedding",
        lambda x: F.coalesce(
            ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)
        ),
    )
    return (
        vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
        .where(finite)
        .groupBy(F.col("vec_id").cast("long").alias("vec_id"), numbers.alias("vector"))
        .agg(F.count(F.lit(1)).alias("copies"))
    )


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 5, index_rows: int = INDEX_ROWS
) -> DataFrame:
    """The ``k`` highest integer inner products of each query with all other vectors.

    ``vectors`` and ``queries`` are (vec_id, vector of whole numbers), with the number
    of equal rows as ``copies`` if there is such a column, as :func:`whole_numbers`
    gives; a query never finds its own id. Returns query_id, rank from 1, vec_id,
    score; ties go to the smaller vec_id. Fewer than ``k`` others give all of them,
    an empty table none. Missing components count as 0. A row that is there several
    times, or under several vectors, is found as often; queries of one id share its
    ``k`` places. Scores are 64-bit: products of components near 2**31 may wrap.

    Rows are dealt to blocks by a hash of id and vector, so equal vectors, hot ids and
    hot labels spread evenly. Every block of queries meets every block of the index in a task
    of its own, which holds these two blocks and nothing else; what leaves it is k
    rows per query, of which a top-k window keeps k.
    """
    vectors, queries = (
        df if "copies" in df.columns else df.withColumn("copies", F.lit(1).cast("long"))
        for df in (vectors, queries)
    )
    n = vectors.count()
    blocks = max(1, -(-n // index_rows))
    query_blocks = max(1, -(-queries.count() // QUERY_ROWS))

    def dealt(df: DataFrame, into: int, salt: str):
        return F.pmod(F.xxhash64("vec_id", "vector", F.lit(salt)), F.lit(into)).cast("int")

    held = vectors.select(
        "vec_id", "vector", "copies", F.lit(False).alias("query"),
        dealt(vectors, blocks, "index").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("query_block"),
    )
    asked = queries.select(
        "vec_id", "vector", "copies", F.lit(True).alias("query"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        dealt(queries, query_blocks, "query").alias("query_block"),
    )
    found = (
        held.unionByName(asked)
        .groupBy("query_block", "block")
        .applyInPandas(_search_block(k), "query_id long, vec_id long, score long, copies long")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    )
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
