"""Exact top-k by inner product: dual-tree search over cover trees.

1. *Cells.*  Centres, each the farthest from those before, are chosen on a sample of at most ``SAMPLE``
   vectors; every vector goes to its nearest centre.  They are the top level of the trees; which
   vectors the sample holds changes how much is pruned, never the result.  A cell too large for one
   task is dealt into blocks by hash.
2. *Trees.*  In each block a cover tree is built once and stored with the vectors.  A node covers
   its vectors within a radius of its centre; its children's radii are at most half of its own, and their
   centres lie farther apart than that.  Where more than a few balls of half the radius would be needed,
   as with random vectors of many dimensions, the node is a leaf.  Queries get trees of their own.
3. *First scores.*  Each block of queries is searched in a block of its own cell: that gives every
   query a kth score to beat.
4. *All others.*  No pair of vectors below nodes with centres p, q and radii r, s can score more than
   <p, q> + |p| s + |q| r + r s.  Pairs of blocks, then of nodes, whose bound does not reach the
   worst kth score of the queries are pruned; surviving leaf pairs are scored as matrix products.

Products are exact: in floating point while every sum stays below 2^45, else from limbs of 22
bits put together as whole numbers.

Defined results for odd input: null vectors and vectors with a component that is null, not finite or
not finite times ``scale`` take no part; vectors of other lengths count as padded with zeros; rows with a
null id are candidates under a null id and never queries; repeated rows are each other's
candidates; ties go to the smaller id (null last); a score beyond 64 bits is ranked by its exact
value and returned as null; a very long vector must fit in a task with its block; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, read_table, settled

TOP, SCALE, EVERY = 20, 64, 20
LEAF = 256
#: Vectors in a block, about.
BLOCK_ROWS = 8192
#: Centres are chosen among so many vectors; there are at most so many centres.
SAMPLE, CENTRES = 20_000, 1024
NULL_ID = np.iinfo(np.int64).max
#: Vectors with larger components have blocks of their own.
NARROW = 1 << 16
#: Rows and columns scored at once.
TILE = (512, 4096)


def quantise(raw: list, scale: int) -> np.ndarray | None:
    """floor(scale * x) of every component as double; None if the vector takes no part."""
    if raw is None or any(x is None for x in raw):
        return None
    with np.errstate(over="ignore", invalid="ignore"):
        v = np.floor(np.asarray(raw, np.float64) * scale)
    return v if np.isfinite(v).all() else None


def stacked(vectors: list[np.ndarray]) -> np.ndarray:
    table = np.zeros((len(vectors), max(map(len, vectors), default=0)))
    for i, v in enumerate(vectors):
        table[i, : len(v)] = v
    return table


def lengths(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        return np.sqrt((x**2).sum(-1))


def farthest_first(x: np.ndarray, most: int) -> np.ndarray:
    """Rows of at most ``most`` centres, each the farthest from those before."""
    if not len(x):
        return np.zeros(0, np.int64)
    chosen, near = [0], lengths(x - x[0])
    while len(chosen) < most and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, lengths(x - x[chosen[-1]]))
    return np.array(chosen)


# --- trees --------------------------------------------------------------------------------


class Tree:
    """Node i covers rows ``start[i]:end[i]`` of ``x`` within ``radius[i]`` of row ``start[i]``;
    its children are nodes ``kids[first[i] : first[i + 1]]``."""

    def __init__(self, x, start, end, radius, first, kids):
        self.x, self.start, self.end, self.radius, self.first, self.kids = x, start, end, radius, first, kids
        self.norm = lengths(x[start]) if len(x) else np.zeros(0)

    def children(self, i: int) -> list[int]:
        return self.kids[self.first[i] : self.first[i + 1]].tolist()


def cover_tree(x: np.ndarray, *, leaf: int = LEAF) -> tuple[np.ndarray, Tree]:
    """The order in which a cover tree holds the rows of ``x``, and the tree over them so ordered."""
    order, start, end, radius, children = np.arange(len(x)), [], [], [], []
    todo = [(0, len(x), None)] if len(x) else []
    while todo:
        a, b, parent = todo.pop()
        node = len(start)
        if parent is not None:
            children[parent].append(node)
        rows = order[a:b]
        near = lengths(x[rows] - x[rows[0]])
        far = float(near.max())
        start.append(a)
        end.append(b)
        radius.append(far if far == far else np.inf)
        children.append([])
        if b - a <= leaf or not 0 < far < np.inf:
            continue
        # Members farther than half the radius from every centre become centres until all are covered.
        owner, centres, most = np.zeros(b - a, np.int64), [0], 4 * (b - a) // leaf + 2
        while near.max() > far / 2 and len(centres) < most:
            j = int(near.argmax())
            d = lengths(x[rows] - x[rows[j]])
            closer = d < near
            owner[closer], near[closer] = len(centres), d[closer]
            centres.append(j)
        if near.max() > far / 2:
            continue
        # Each child's centre comes first in its range.
        first = np.ones(b - a, np.int64)
        first[centres] = 0
        inside = np.lexsort((first, owner))
        order[a:b] = rows[inside]
        cuts = np.r_[0, np.cumsum(np.bincount(owner, minlength=len(centres)))] + a
        todo += [(int(s), int(e), node) for s, e in zip(cuts[:-1], cuts[1:], strict=True) if e > s]
    ptr = np.r_[0, np.cumsum([len(c) for c in children])].astype(np.int64)
    kids = np.array([k for c in children for k in c], np.int64)
    return order, Tree(x[order], np.array(start, np.int64), np.array(end, np.int64), np.array(radius, float), ptr, kids)


# --- exact products -------------------------------------------------------------------------


def most(q: np.ndarray, x: np.ndarray) -> float:
    """No sum of products is larger."""
    with np.errstate(over="ignore"):
        return float(np.float64(np.abs(q).max(initial=0)) * np.float64(np.abs(x).max(initial=0)) * max(1, q.shape[1]))


def limbs(x: np.ndarray) -> list[np.ndarray]:
    """Whole numbers as sums of 22-bit parts, lowest first, with the number's sign."""
    size = np.abs(x).max(initial=0)
    whole = x.astype(np.int64) if size < 2.0**62 else np.array([[int(v) for v in row] for row in x], object)
    sign, rest, out = np.sign(x), abs(whole), []
    for k in range(max(1, -(-int(size).bit_length() // 22))):
        out.append(((rest >> (22 * k)) & ((1 << 22) - 1)).astype(np.float64) * sign)
    return out


def exact_products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products as Python integers, whatever their size."""
    a, b = limbs(q), limbs(x)
    total = np.zeros((len(q), len(x)), object)
    for s in range(len(a) + len(b) - 1):
        part = np.zeros((len(q), len(x)), np.int64)
        for i in range(max(0, s - len(b) + 1), min(s + 1, len(a))):
            for c in range(0, q.shape[1], 256):
                part += (a[i][:, c : c + 256] @ b[s - i][:, c : c + 256].T).astype(np.int64)
        total += part.astype(object) << (22 * s)
    return total


# --- the search -----------------------------------------------------------------------------


def dual_search(q: Tree, x: Tree, q_key: np.ndarray, x_key: np.ndarray, x_id: np.ndarray, k: int, beat: np.ndarray | None = None):
    """For each query the k best rows of ``x`` (score, then smaller id) that reach its score ``beat``, if
    given: rows (-1: none) and scores.

    ``q_key``/``x_key`` name rows: a row is no candidate of itself.  A score and the place of its row in
    id order are kept as one integer, so that the best of a leaf pair are found for all queries at once.
    """
    n, m = len(q.x), len(x.x)
    shift = int(m).bit_length()
    bound_of_sums = most(q.x, x.x)
    wide = not bound_of_sums < 2.0**45
    kind = object if wide else np.int64
    none = -(1 << 5000) if wide else np.iinfo(np.int64).min
    by_id = np.argsort(x_id, kind="stable")
    place = np.empty(m, np.int64)
    place[by_id] = np.arange(m - 1, -1, -1)
    best = np.full((n, k), none, kind)
    worst = np.full(n, none, kind)
    if beat is not None:
        worst[:] = beat.astype(kind) * (1 << shift) - 1
    # Single precision is exact while every sum stays below 2^24.
    narrow = np.float32 if bound_of_sums < 2.0**24 else np.float64
    qf, xf = (q.x, x.x) if wide else (q.x.astype(narrow), x.x.astype(narrow))

    def bound(a: int, b: int) -> float:
        r, s = q.radius[a], x.radius[b]
        with np.errstate(over="ignore", invalid="ignore"):
            v = float(q.x[q.start[a]] @ x.x[x.start[b]] + q.norm[a] * s + x.norm[b] * r + r * s)
            v += 1e-9 * float((q.norm[a] + r) * (x.norm[b] + s)) + 1e-6
        return v if v == v else np.inf

    def tile(a: slice, b: slice) -> None:
        s = exact_products(qf[a], xf[b]) if wide else (qf[a] @ xf[b].T).astype(np.int64)
        s = s * (1 << shift) + place[b]
        s[q_key[a][:, None] == x_key[b][None, :]] = none
        rows = np.flatnonzero((s > worst[a][:, None]).any(1))
        if len(rows):
            at = a.start + rows
            both = np.concatenate([best[at], s[rows]], 1)
            best[at] = np.sort(both, 1)[:, -k:] if wide else np.partition(both, -k, 1)[:, -k:]
            worst[at] = np.maximum(worst[at], best[at].min(1))

    def leaves(a: int, b: int) -> None:
        for i in range(q.start[a], q.end[a], TILE[0]):
            for j in range(x.start[b], x.end[b], TILE[1]):
                tile(slice(i, min(i + TILE[0], q.end[a])), slice(j, min(j + TILE[1], x.end[b])))

    queue, tie = ([(-bound(0, 0), 0, 0, 0)] if n and m else []), 0
    while queue:
        negative, _, a, b = heapq.heappop(queue)
        least = worst[q.start[a] : q.end[a]].min()
        # An equal score may still win by its id.
        if least != none and -negative < (int(least) >> shift):
            continue
        kids_a, kids_b = q.children(a), x.children(b)
        if not kids_a and not kids_b:
            leaves(a, b)
            continue
        split_a = kids_a and (not kids_b or q.radius[a] >= x.radius[b])
        for c, d in ((c, b) for c in kids_a) if split_a else ((a, d) for d in kids_b):
            tie += 1
            heapq.heappush(queue, (-bound(c, d), tie, c, d))
    best = np.sort(best, 1)[:, ::-1]
    low = -1 if beat is None else beat.astype(kind)[:, None] * (1 << shift)
    empty = (best == none) | (best < low if beat is not None else False)
    found = by_id[::-1][(best & ((1 << shift) - 1)).astype(np.int64) % max(m, 1)] if m else np.zeros(best.shape, np.int64)
    return np.where(empty, -1, found), np.where(empty, 0, best >> shift)


# --- blocks ---------------------------------------------------------------------------------

ASSIGNED = "row bigint, vec_id bigint, cell bigint, vector binary"
BLOCKS = (
    "block bigint, cell bigint, sub bigint, width int, top double, centre array<double>, norm double, radius double, rows binary, ids binary,"
    " kind string, vectors binary, nodes binary, kids binary"
)


def assign(rows: DataFrame, centres: np.ndarray, scale: int) -> DataFrame:
    """``row, vec_id, embedding`` as quantised vectors with their cell; -1 for large components."""
    own = (centres**2).sum(1)

    def run(batches):
        for batch in batches:
            names, ids, vectors = [], [], []
            for name, vec_id, raw in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                if (v := quantise(raw, scale)) is not None:
                    names.append(name)
                    ids.append(NULL_ID if vec_id is None else vec_id)
                    vectors.append(v)
            cell = np.zeros(len(vectors), np.int64)
            if vectors:
                x = stacked(vectors)
                large = np.abs(x).max(1, initial=0) > NARROW
                if len(centres):
                    w = min(x.shape[1], centres.shape[1])
                    cell = (own - 2 * np.where(large[:, None], 0, x[:, :w]) @ centres[:, :w].T).argmin(1)
                cell[large] = -1
            blobs = [v.astype(np.float64).tobytes() if c < 0 else v.astype(np.int32).tobytes() for v, c in zip(vectors, cell, strict=True)]
            cells = [pa.array(names, pa.int64()), pa.array(ids, pa.int64()), pa.array(cell), pa.array(blobs, pa.binary())]
            yield pa.RecordBatch.from_arrays(cells, ["row", "vec_id", "cell", "vector"])

    return rows.mapInArrow(run, ASSIGNED)


def _pack(key: tuple, rows: list) -> tuple:
    cell, sub = key
    kind = np.float64 if cell < 0 else np.int32
    x = stacked([np.frombuffer(v, kind).astype(np.float64) for _, _, v in rows])
    order, tree = cover_tree(x)
    names, ids = (np.array([r[i] for r in rows], np.int64)[order] for i in range(2))
    top = float(np.abs(x).max(initial=0))
    small = np.float64 if cell < 0 else np.int16 if top < 2**15 else np.int32
    nodes = np.stack([tree.start, tree.end, tree.first[:-1], tree.first[1:], tree.radius.view(np.int64)])
    return (
        cell * (1 << 32) + sub, cell, sub, x.shape[1], top, tree.x[0].tolist(), float(tree.norm[0]), float(tree.radius[0]), names.tobytes(),
        ids.tobytes(), np.dtype(small).str, tree.x.astype(small).tobytes(), nodes.tobytes(), tree.kids.tobytes(),
    )


def _pack_blocks(batches):
    """Over partitions ordered by (cell, sub): one row a block with its tree."""
    schema = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.list_(pa.float64()), pa.float64(), pa.float64()]
    schema += [pa.binary(), pa.binary(), pa.string(), pa.binary(), pa.binary(), pa.binary()]
    names = [c.split()[0] for c in BLOCKS.split(", ")]

    def done(key, rows):
        return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(_pack(key, rows), schema, strict=True)], names)

    key, rows = None, []
    for batch in batches:
        for cell, sub, *row in zip(*[batch.column(c).to_pylist() for c in ("cell", "sub", "row", "vec_id", "vector")], strict=True):
            if key != (cell, sub):
                if rows:
                    yield done(key, rows)
                key, rows = (cell, sub), []
            rows.append(row)
    if rows:
        yield done(key, rows)


def blocks(assigned: DataFrame, label: str) -> DataFrame:
    """Trees over the rows of ``assigned``, about ``BLOCK_ROWS`` in each."""
    counts = assigned.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("subs"))
    counts = cut(counts.coalesce(1), f"{label}-cells")
    total = counts.agg(F.sum("subs")).first()[0] or 1
    dealt = assigned.join(counts, "cell").withColumn("sub", F.pmod(F.xxhash64("row"), F.col("subs"))).select("cell", "sub", "row", "vec_id", "vector")
    dealt = dealt.repartition(int(total), "cell", "sub").sortWithinPartitions("cell", "sub")
    return cut(dealt.mapInArrow(_pack_blocks, BLOCKS), label)


def _side(row: dict, side: str, width: int) -> tuple[Tree, np.ndarray, np.ndarray]:
    names, ids = (np.frombuffer(row[f"{side}_{c}"], np.int64) for c in ("rows", "ids"))
    x = np.zeros((len(ids), width))
    x[:, : row[f"{side}_width"]] = np.frombuffer(row[f"{side}_vectors"], row[f"{side}_kind"]).reshape(len(ids), -1)
    start, end, low, high, radius = np.frombuffer(row[f"{side}_nodes"], np.int64).reshape(5, -1)
    kids = np.frombuffer(row[f"{side}_kids"], np.int64)
    return Tree(x, start, end, radius.view(np.float64), np.r_[low, high[-1:]], kids), names, ids


FOUND = "q_block bigint, query_id bigint, q_row bigint, place int, vec_id bigint, score bigint, key binary"


def order_key(s: int) -> bytes:
    """Bytes that sort as whole numbers do."""
    size = abs(s).to_bytes((abs(s).bit_length() + 7) // 8, "big")
    if s >= 0:
        return b"\x01" + len(size).to_bytes(4, "big") + size
    return b"\x00" + (0xFFFFFFFF - len(size)).to_bytes(4, "big") + bytes(255 - c for c in size)


def search_blocks(k: int, keyed: bool):
    """Best rows of each pair of blocks; ``q_beat``, if not null: by query the score to reach."""

    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                width = max(row["q_width"], row["x_width"])
                q, q_row, q_id = _side(row, "q", width)
                x, x_row, x_id = _side(row, "x", width)
                beat = np.frombuffer(row["q_beat"], np.int64) if row["q_beat"] is not None else None
                best, score = dual_search(q, x, q_row, x_row, x_id, k, beat)
                i, c = np.nonzero(best >= 0)
                ids, found = x_id[best[i, c]], score[i, c]
                plain = [int(s) if -(1 << 63) <= s < 1 << 63 else None for s in found.tolist()]
                keys = [order_key(int(s)) if keyed else None for s in found.tolist()]
                columns = [
                    pa.array(np.full(len(i), row["q_block"])), pa.array(q_id[i]), pa.array(q_row[i]), pa.array(i.astype(np.int32)),
                    pa.array(ids, mask=ids == NULL_ID), pa.array(plain, pa.int64()), pa.array(keys, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in FOUND.split(", ")])

    return run


def pair_bound() -> Column:
    """No vectors of two blocks score more; NaN, which is above every number, where that overflows."""
    products = F.zip_with("q_centre", "x_centre", lambda a, b: F.coalesce(a, F.lit(0.0)) * F.coalesce(b, F.lit(0.0)))
    dot = F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)
    q, r, x, s = (F.col(c) for c in ("q_norm", "q_radius", "x_norm", "x_radius"))
    return dot + q * s + x * r + r * s + 1e-9 * (q + r) * (x + s) + 1e-6


def _beat(found: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``q_block, q_beat, q_least``: by query (in the block's order) its kth score after the first search,
    and the least of them; no row for blocks where a query has fewer than k or a score beyond 64 bits."""
    per = found.groupBy("q_block", "place").agg(F.count("score").alias("n"), F.min("score").alias("kth")).filter(F.col("n") >= k)
    whole = per.groupBy("q_block").agg(F.sort_array(F.collect_list(F.struct("place", "kth"))).alias("scores"), F.min("kth").alias("q_least"))
    sizes = queries.select(F.col("block").alias("q_block"), (F.octet_length("ids") / 8).cast("int").alias("size"))
    whole = whole.join(sizes, "q_block").filter(F.size("scores") == F.col("size"))

    def packed(batches):
        for batch in batches:
            blobs = [np.array([s["kth"] for s in scores], np.int64).tobytes() for scores in batch.column("scores").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("q_block"), pa.array(blobs, pa.binary()), batch.column("q_least")], ["q_block", "q_beat", "q_least"])

    return cut(whole.select("q_block", "scores", "q_least").mapInArrow(packed, "q_block bigint, q_beat binary, q_least bigint"), "beat")


@settled("neighbours")
def top_k(vectors: DataFrame, *, every: int = EVERY, k: int = TOP, scale: int = SCALE, report: dict | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: queries are rows whose id is divisible by ``every``.

    ``report``, if given, gets the numbers of pairs of blocks there are and that were searched.
    """
    spark = vectors.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slim = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = cut(slim.select(F.monotonically_increasing_id().alias("row"), "vec_id", "embedding"), "vectors")
    n = rows.count()
    sample = rows.sample(min(1.0, SAMPLE / max(n, 1)), 17).select("embedding").limit(SAMPLE).collect()
    known = [v for r in sample if (v := quantise(r["embedding"], scale)) is not None and np.abs(v).max(initial=0) <= NARROW]
    x = stacked(known)
    centres = x[farthest_first(x, min(CENTRES, -(-n // BLOCK_ROWS)))]
    assigned = cut(assign(rows, centres, scale), "assigned")
    data = blocks(assigned, "trees")
    queries = blocks(assigned.filter((F.col("vec_id") != NULL_ID) & (F.pmod("vec_id", F.lit(every)) == 0)), "query-trees")

    side = lambda df, p: df.select(*[F.col(c).alias(f"{p}_{c}") for c in df.columns])
    q, d = side(queries, "q"), side(data, "x")
    brief = lambda df, p: df.select(*[f"{p}_{c}" for c in ("block", "cell", "sub", "centre", "norm", "radius")])
    top = data.agg(F.max("top").alias("top"), F.max("width").alias("width"), F.count(F.lit(1)).alias("n")).first()
    keyed = top["n"] > 0 and not float(top["top"]) * float(top["top"]) * top["width"] < 2.0**62
    tasks = max(parts, top["n"])

    def searched(pairs: DataFrame, label: str) -> DataFrame:
        """Blocks of queries travel to the blocks of data, which are dealt once."""
        asked = pairs.join(q, "q_block").repartition(tasks, "x_block")
        met = asked.join(d.repartition(tasks, "x_block"), "x_block")
        return cut(met.mapInArrow(search_blocks(k, keyed), FOUND), label)

    own = brief(q, "q").join(brief(d, "x").filter("x_sub = 0"), F.col("q_cell") == F.col("x_cell"))
    first = searched(own.select("q_block", "x_block", F.lit(None).cast("binary").alias("q_beat")), "first")
    beat = _beat(first, queries, k)
    others = brief(q, "q").join(beat, "q_block", "left").join(
        brief(d, "x"), ((F.col("q_cell") != F.col("x_cell")) | (F.col("x_sub") != 0)) & (F.col("q_least").isNull() | (pair_bound() >= F.col("q_least")))
    )
    others = cut(others.select("q_block", "x_block"), "pairs")
    if report is not None:
        report |= {"pairs": queries.count() * top["n"], "searched": queries.count() + others.count()}
    rest = searched(others.join(beat.select("q_block", "q_beat"), "q_block", "left"), "others")
    by = F.desc("key") if keyed else F.desc("score")
    rank = Window.partitionBy("query_id", "q_row").orderBy(by, F.col("vec_id").asc_nulls_last())
    found = first.unionByName(rest).withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")


def op9_dual_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best partners of every twentieth vector."""
    return top_k(read_table(spark, sf_dir, "embeddings"))
