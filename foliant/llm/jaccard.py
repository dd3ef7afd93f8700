"""N-gram Jaccard join by T-occurrence search, and its groups of documents.

Two documents link when the Jaccard similarity of their shingle sets reaches a
threshold.  The join runs in four steps and misses no link:

1. *Blocks.*  All shingles are put in one order, rare ones first: a pass over the whole corpus
   counts them in hashed slots, a few megabytes however large the corpus is.  Any order gives the same
   links; this one keeps blocks small.  A set of n shingles can lack n - ceil(t n) of a linked set's, so
   the first n - ceil(t n) + 1 shingles of linked sets meet in at least one.  These are the fingerprints
   of a set.  All sets that share one form a block around the smallest id in it, its pivot.
   Fingerprints travel as packed arrays.  Before whole sets travel, parity bitmaps of them do: two
   bitmaps differ in at most as many places as the sets, so members of a block that differ from
   all others in too many places link with none of them and leave it.
2. *T-occurrence search.*  Inside a block (in chunks of bounded size) an inverted index
   over the whole sets is searched by DivideSkip: the shorter lists of a query are merged
   with a heap, the longer ones are probed by binary search for the candidates found, and
   documents that reach the required overlap are kept.  Documents already known to be in
   one group need not be compared again.
3. Where a block has several chunks, members that did not link to the pivot are searched
   in all other chunks as well.
4. *Groups* are the connected components of the links, by alternating large-star and
   small-star rounds over tables in the shared folder.

Equal sets count as one: copies within a task are not even sent, copies across tasks meet
by digest.  A fingerprint common enough within one task is sent as its smallest id
alone, and its members are attached afterwards in a salted join, so no large group of
copies is gathered in one task.

Defined results for odd input: a null or blank text has an empty set and links with
nothing; of a very long text a fixed share of its shingles are fingerprints, and its set must fit in a
task; ties in the order go by hash; rows with a null id are returned with a null group and link with nothing; rows
with the same id count as one document; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, read_table, settled

#: Counters of the order of shingles, and the slices that they are summed in.
SLOTS, SLICES = 1 << 22, 64
#: Fingerprints of one bucket of the meeting step, about.
BUCKET = 2_000_000
#: A fingerprint held by this many sets of one flush is sent as one entry.
HOT = 64
#: Entries gathered before they are packed and sent.
FLUSH = 400_000
CHUNK = 256
#: Whole sets sent at once, about.
SENT_BYTES = 1 << 23
#: Blocks of fewer members are thinned out by bitmaps.
THIN = 4096
#: Ids of at most this many candidates are broadcast to fetch their texts (8 bytes each);
#: more are joined by a shuffle.
BROADCAST_IDS = 1_000_000

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xFF51AFD7ED558CCD], np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct ``width``-word shingles; A-Z count as a-z."""
    from xxhash import xxh3_64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(w) - width + 1)
    span = min(width, len(w))
    acc = np.full(n, span, np.uint64)
    for k in range(span):
        acc = mix64(acc * _ODD[k % 5] + w[k : k + n])
    return np.unique(acc)


# --- blocks -----------------------------------------------------------------------------


def _count(width: int):
    """Map side of the order: how often each slot of hashes occurs in this partition's sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen, held, waiting = np.zeros(SLOTS, np.int64), set(), [], 0

        def add() -> None:
            nonlocal counts
            if held:
                counts += np.bincount((np.concatenate(held) & np.uint64(SLOTS - 1)).astype(np.int64), minlength=SLOTS)

        for batch in batches:
            for text in batch.column(0):
                s = shingle_set(text.as_py(), width)
                digest = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                if digest not in seen:
                    seen.add(digest)
                    held.append(s)
                    waiting += len(s)
                if waiting >= SLOTS:
                    add()
                    held, waiting = [], 0
        add()
        kind = np.uint8 if counts.max() < 256 else np.int64
        parts = [x.astype(kind).tobytes() for x in counts.reshape(SLICES, -1)]
        yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array(parts, pa.binary())], ["slice", "counts"])

    return run


def _sum_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per slice the total, and the counts on a log scale of eight steps an octave, a byte each."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for at, part in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            kind = np.uint8 if len(part) == SLOTS // SLICES else np.int64
            sums[at] = sums.get(at, 0) + np.frombuffer(part, kind).astype(np.int64)
    levels = [np.minimum(255, np.floor(8 * np.log2(1.0 + x))).astype(np.uint8).tobytes() for x in sums.values()]
    totals = [int(x.sum()) for x in sums.values()]
    columns = [pa.array(list(sums), pa.int32()), pa.array(levels, pa.binary()), pa.array(totals, pa.int64())]
    yield pa.RecordBatch.from_arrays(columns, ["slice", "levels", "total"])


def shingle_order(slim: DataFrame, width: int) -> tuple[np.ndarray, int]:
    """How common each slot of shingle hashes is in the whole corpus (``SLOTS`` bytes, whatever
    the corpus), and the number of shingles in all its sets."""
    counts = slim.select("text").mapInArrow(_count(width), "slice int, counts binary")
    rows = counts.repartition(SLICES, "slice").mapInArrow(_sum_slices, "slice int, levels binary, total bigint").collect()
    levels = np.zeros((SLICES, SLOTS // SLICES), np.uint8)
    for r in rows:
        levels[r["slice"]] = np.frombuffer(r["levels"], np.uint8)
    return levels.ravel(), sum(r["total"] for r in rows)


def prefix(shingles: np.ndarray, levels: np.ndarray, percent: int) -> np.ndarray:
    """The rarest shingles of a set, one more than linked sets can lack: linked sets share one."""
    n = len(shingles)
    most = n - -(-percent * n // 100) + 1
    if not n or most >= n:
        return shingles
    rank = (levels[shingles & np.uint64(SLOTS - 1)].astype(np.uint64) << np.uint64(56)) | (shingles >> np.uint64(8))
    return shingles[np.argpartition(rank, most - 1)[:most]]


def parity(shingles: np.ndarray) -> bytes:
    """Bitmap of at least two bits a shingle; each shingle flips one bit.  The exclusive or of two
    bitmaps has no more bits than the sets' difference has shingles; halves fold onto each other."""
    bits = 1 << max(6, int(2 * len(shingles) - 1).bit_length())
    counts = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(counts.astype(np.uint8), bitorder="little").tobytes()


def may_link(sizes: np.ndarray, maps: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of some sets may link with another one of them, by size and parity bitmap."""
    keep = np.zeros(len(sizes), bool)
    words = np.array([len(m) for m in maps])
    for level in np.unique(words):
        low = np.flatnonzero(words == level)
        own = np.stack([maps[i] for i in low])
        high = np.flatnonzero(words == 2 * level)
        folded = [own] + ([np.stack([maps[i][:level] ^ maps[i][level:] for i in high])] if len(high) else [])
        others = np.r_[low, high] if len(high) else low
        table = np.concatenate(folded)
        for a, i in enumerate(low):
            n, m = sizes[i], sizes[others]
            apart = np.bitwise_count(table ^ own[a]).sum(1)
            near = (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (apart <= (n + m) * (100 - percent) // (100 + percent))
            near[a] = False
            if near.any():
                keep[i] = True
                keep[others[near]] = True
    return keep


SENT = "bucket int, kind int, prints binary, ids binary"


def _send(buckets: int, percent: int, width: int, levels):
    """Map side.  Rows of kind 0: fingerprints with ids; 1: fingerprints to publish; 2: members
    of those, sent aside; 3: first row of a set in this task; 4: rows (id, size, first)."""

    def pack(out: list, bucket: int, kind: int, prints: np.ndarray, ids: np.ndarray) -> None:
        out.append((bucket, kind, prints.tobytes(), np.diff(ids, prepend=np.int64(0)).tobytes()))

    def flush(prints: list, owners: list, rows: list, firsts: list) -> pa.RecordBatch:
        out: list = []
        if prints:
            p = np.concatenate(prints)
            o = np.repeat(np.array([x for x, _ in owners], np.int64), [n for _, n in owners])
            order = np.lexsort((o, p))
            p, o = p[order], o[order]
            starts = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
            sizes = np.diff(np.r_[starts, len(p)])
            common = sizes >= HOT
            for s, n in zip(starts[common], sizes[common], strict=True):
                pack(out, buckets + int(p[s] % np.uint64(buckets)), 2, p[s : s + 1], o[s : s + n])
            keep = ~np.repeat(common, sizes)
            keep[starts] = True
            public = p[starts[common]]
            p, o = p[keep], o[keep]
            b = (p % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(b, kind="stable")
            p, o, b = p[order], o[order], b[order]
            cuts = np.flatnonzero(np.r_[True, b[1:] != b[:-1]])
            for s, e in zip(cuts, np.r_[cuts[1:], len(b)], strict=True):
                inside = np.argsort(o[s:e], kind="stable")
                short = (p[s:e][inside] >> np.uint64(32)).astype(np.uint32)
                pack(out, int(b[s]), 0, short, o[s:e][inside])
            pb = (public % np.uint64(buckets)).astype(np.int64)
            for x in np.unique(pb):
                out.append((int(x), 1, (public[pb == x] >> np.uint64(32)).astype(np.uint32).tobytes(), public[pb == x].tobytes()))
        for digest, doc, size, bits in firsts:
            out.append((int.from_bytes(digest[:4], "little") % buckets, 3, digest, np.array([doc, size], np.int64).tobytes() + bits))
        if rows:
            table = np.array(rows, np.int64)
            out.append((buckets + int(mix64(table[:1, 0].astype(np.uint64))[0] % np.uint64(buckets)), 4, b"", table.tobytes()))
        columns = list(zip(*out, strict=True)) or [[], [], [], []]
        types = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["bucket", "kind", "prints", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: dict[bytes, int] = {}
        prints, owners, rows, firsts, held = [], [], [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                s = shingle_set(text.as_py(), width)
                if doc is None:
                    rows.append((0, len(s), 0, 1))
                    continue
                if not len(s):
                    rows.append((doc, 0, doc, 2))
                    continue
                digest = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                if digest not in first:
                    first[digest] = doc
                    firsts.append((digest, doc, len(s), parity(s)))
                    p = mix64(prefix(s, levels.value, percent))
                    prints.append(p)
                    owners.append((doc, len(p)))
                    held += len(p)
                rows.append((doc, len(s), first[digest], 0))
            if held >= FLUSH or len(rows) >= 50_000:
                yield flush(prints, owners, rows, firsts)
                prints, owners, rows, firsts, held = [], [], [], [], 0
        yield flush(prints, owners, rows, firsts)

    return run


#: what: "pair" (a: member, b: pivot), "public" (a: fingerprint, b: pivot), "member" (a:
#: fingerprint, b: member), "first" (a: id, b: smallest id of an equal set), "row" (a: id, b:
#: first of its set in the task, n: size, state: 0 plain, 1 no id, 2 empty).  ``bits``: of "first".
MET = "what string, a bigint, b bigint, n bigint, state int, bits binary"


def _meet(table: pa.Table) -> pa.Table:
    """Reduce side: everything of one bucket."""
    kinds = np.array(table.column("kind").to_pylist())
    prints, ids = table.column("prints").to_pylist(), table.column("ids").to_pylist()
    out: dict[str, list] = {"what": [], "a": [], "b": [], "n": [], "state": []}

    def emit(what, a, b, n=None, state=None) -> None:
        out["what"].append(np.full(len(a), what, object))
        zero = np.zeros(len(a), np.int64)
        for name, x in (("a", a), ("b", b), ("n", zero if n is None else n), ("state", zero if state is None else state)):
            out[name].append(np.asarray(x, np.int64))

    plain = np.flatnonzero(kinds == 0)
    if len(plain):
        p = np.concatenate([np.frombuffer(prints[i], np.uint32) for i in plain])
        o = np.concatenate([np.cumsum(np.frombuffer(ids[i], np.int64)) for i in plain])
        order = np.lexsort((o, p))
        p, o = p[order], o[order]
        starts = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
        pivot = np.repeat(o[starts], np.diff(np.r_[starts, len(p)]))
        unequal = o != pivot
        pairs = np.unique(np.stack([o[unequal], pivot[unequal]], 1), axis=0)
        emit("pair", pairs[:, 0], pairs[:, 1])
        published = np.flatnonzero(kinds == 1)
        if len(published):
            full = np.unique(np.concatenate([np.frombuffer(ids[i], np.uint64) for i in published]))
            emit("public", full.view(np.int64), o[np.searchsorted(p, (full >> np.uint64(32)).astype(np.uint32))])
    for i in np.flatnonzero(kinds == 2):
        members = np.cumsum(np.frombuffer(ids[i], np.int64))
        emit("member", np.full(len(members), np.frombuffer(prints[i], np.uint64).view(np.int64)[0]), members)
    smallest: dict[bytes, int] = {}
    same = [(prints[i], *np.frombuffer(ids[i][:16], np.int64).tolist(), ids[i][16:]) for i in np.flatnonzero(kinds == 3)]
    for digest, doc, _, _ in same:
        smallest[digest] = min(doc, smallest.get(digest, doc))
    bits: list = [None] * sum(len(x) for x in out["a"]) + [x for *_, x in same]
    emit("first", [x[1] for x in same], [smallest[x[0]] for x in same], [x[2] for x in same])
    for i in np.flatnonzero(kinds == 4):
        t = np.frombuffer(ids[i], np.int64).reshape(-1, 4)
        emit("row", t[:, 0], t[:, 2], t[:, 1], t[:, 3])
    types = {"what": pa.string(), "a": pa.int64(), "b": pa.int64(), "n": pa.int64(), "state": pa.int32()}
    columns = {k: pa.array(np.concatenate(v) if v else [], types[k]) for k, v in out.items()}
    bits += [None] * (len(columns["a"]) - len(bits))
    return pa.table(columns | {"bits": pa.array(bits, pa.binary())})


# --- T-occurrence search ----------------------------------------------------------------


class Index:
    """Inverted lists over a few sets: for every shingle the members that hold it, ascending."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        order = np.argsort(every, kind="stable")
        self.owner = owner[order]
        self.keys, self.starts, self.counts = np.unique(every[order], return_index=True, return_counts=True)
        # (list, member) pairs as one ascending array, for binary probes of many lists at once.
        self.probe = np.repeat(np.arange(len(self.keys)), self.counts) * len(sets) + self.owner

    def search(self, query: np.ndarray, percent: int) -> np.ndarray:
        """Members whose overlap with ``query`` reaches the one that the threshold asks for."""
        n = len(query)
        if not n or not len(self.keys):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.keys, query), len(self.keys) - 1)
        lists = at[self.keys[at] == query]
        least = -(-percent * n // 100)
        if len(lists) < least:
            return np.zeros(0, np.int64)
        lists = lists[np.argsort(-self.counts[lists], kind="stable")]
        # DivideSkip: L long lists are only probed; a result occurs at least T - L times in the rest.
        most = float(self.counts[lists[0]])
        skipped = min(least - 1, int(least / (0.0085 * np.log2(most + 1) + 1)))
        long, short = lists[:skipped], lists[skipped:]
        found, counts = [], []
        runs = [self.owner[self.starts[i] : self.starts[i] + self.counts[i]].tolist() for i in short]
        for member, group in itertools.groupby(heapq.merge(*runs)):
            k = sum(1 for _ in group)
            if k >= least - skipped:
                found.append(member)
                counts.append(k)
        members, overlap = np.array(found, np.int64), np.array(counts, np.int64)
        if len(members) and len(long):
            key = long[None, :] * len(self.sizes) + members[:, None]
            pos = np.minimum(np.searchsorted(self.probe, key), len(self.probe) - 1)
            overlap = overlap + (self.probe[pos] == key).sum(1)
        if not len(members):
            return members
        return members[100 * overlap >= percent * (n + self.sizes[members] - overlap)]


def link(ids: list[int], sets: list[np.ndarray], percent: int, asking: list[int] | None = None) -> tuple[list[tuple[int, int]], list[int]]:
    """Links that connect the groups among ``sets``, and the group (a position) of each.

    ``asking``: only links with one of these positions are wanted.  A position is a query
    only while some member is not yet in its group.
    """
    root = list(range(len(ids)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    left = len(ids)
    seen: dict[int, int] = {}
    for i, doc in enumerate(ids):
        if doc in seen:
            root[find(i)] = find(seen[doc])
            left -= 1
        seen[doc] = i
    index, links = Index(sets), []
    for q in range(len(ids)) if asking is None else asking:
        if left == 1:
            break
        for m in index.search(sets[q], percent).tolist():
            a, b = find(q), find(m)
            if a != b:
                root[max(a, b)] = min(a, b)
                links.append((ids[q], ids[m]))
                left -= 1
    return links, [find(i) for i in range(len(ids))]


BLOCK = "pivot bigint, chunk bigint, member bigint, asks boolean, shingles binary"
FOUND = "pivot bigint, chunk bigint, a bigint, b bigint, alone boolean"


def _search_blocks(percent: int, report: bool):
    """Over partitions ordered by (pivot, chunk): links (alone = false) and, if ``report``,
    members not in the group of the block's smallest one, which every chunk holds (alone = true)."""

    def solve(key, rows) -> list[tuple]:
        pivot, chunk = key
        rows.sort(key=lambda r: r[0])
        ids = [r[0] for r in rows]
        sets = [np.frombuffer(r[2], np.uint64) for r in rows]
        links, groups = link(ids, sets, percent, None if report else [i for i, r in enumerate(rows) if r[1]])
        out = [(pivot, chunk, a, b, False) for a, b in links]
        if report:
            out += [(pivot, chunk, ids[i], ids[i], True) for i, g in enumerate(groups) if g != groups[0]]
        return out

    def run(batches):
        key, rows, out = None, [], []
        names = ["pivot", "chunk", "a", "b", "alone"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]

        def done():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("pivot", "chunk", "member", "asks", "shingles")]
            for pivot, chunk, *row in zip(*columns, strict=True):
                if key != (pivot, chunk):
                    if rows:
                        out += solve(key, rows)
                    key, rows = (pivot, chunk), []
                rows.append(row)
            if len(out) > 50_000:
                yield done()
                out = []
        if rows:
            out += solve(key, rows)
        if out:
            yield done()

    return run


# --- connected components ---------------------------------------------------------------


def components(links: DataFrame, *, limit: int = 60) -> DataFrame:
    """``node, component`` for links ``a, b``: alternating large-star and small-star rounds."""
    edges = cut(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    mark = lambda e: e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    before = mark(edges)
    for k in range(limit):
        if not before["n"]:
            break
        # Large star: larger neighbours move to the least of the neighbourhood.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        # Small star: smaller neighbours and the node itself move to the least one.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), f"links-{k}")
        after = mark(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {limit} rounds")
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))


# --- the join ---------------------------------------------------------------------------


@settled("groups")
def group(docs: DataFrame, *, width: int = 4, percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs`` (``doc_id, text``)."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    levels, total = shingle_order(slim, width)
    buckets = max(64, 4 * parts, total * (100 - percent) // (100 * BUCKET))
    order = spark.sparkContext.broadcast(levels)
    met = cut(slim.mapInArrow(_send(buckets, percent, width, order), SENT).groupBy("bucket").applyInArrow(_meet, MET), "met")
    of = lambda what: met.filter(F.col("what") == what)

    # An id with several sets stands for itself, so that all of its sets are searched.
    first = cut(of("first").groupBy(F.col("a").alias("id")).agg(F.min("b").alias("least"), F.max("b").alias("most")).select(
        "id", F.when(F.col("least") == F.col("most"), F.col("least")).otherwise(F.col("id")).alias("rep")), "reps")
    bits = of("first").select(F.col("a").alias("id"), "n", "bits").distinct()
    public = of("public").select("a", F.col("b").alias("pivot")).groupBy("a").agg(F.min("pivot").alias("pivot"))
    aside = of("member").join(public, "a").select(F.col("b").alias("member"), "pivot")
    pairs = of("pair").select(F.col("a").alias("member"), F.col("b").alias("pivot")).unionByName(aside).distinct()
    rep = lambda name: first.select(F.col("id").alias(name), F.col("rep").alias(f"{name}_rep"))
    pairs = pairs.join(rep("member"), "member").join(rep("pivot"), "pivot")
    pairs = pairs.select(F.col("member_rep").alias("member"), F.col("pivot_rep").alias("pivot"))
    pairs = cut(thin(pairs.filter("member <> pivot").distinct(), bits, percent=percent), "pairs")

    links = search(slim, pairs, width=width, percent=percent)
    rows = of("row").select("a", "b", "n", "state")
    plain = rows.filter("state = 0")
    # Rows with one id are one document: what any of them reaches, all of them reach.
    several = plain.groupBy("a").agg(F.min("b").alias("least"), F.max("b").alias("most")).filter("least <> most")
    same_id = plain.join(several, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    same_set = of("first").select("a", "b")
    # A task's first row of a set need not have the smallest id among its copies there.
    smaller = plain.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    named = components(links.unionByName(same_set).unionByName(same_id).unionByName(smaller)).withColumnRenamed("node", "b")
    known = plain.join(named, "b", "left").select(
        F.col("a").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "b").alias("component_id")
    )
    own = F.when(F.col("state") == 2, F.col("a"))
    rest = rows.filter("state <> 0").select(own.alias("doc_id"), F.col("n").alias("n_shingles"), own.alias("component_id"))
    return known.unionByName(rest)


def thin(pairs: DataFrame, maps: DataFrame, *, percent: int) -> DataFrame:
    """Blocks (``pivot, member``) without the members that cannot link inside them.
    ``maps``: id, size and parity bitmap of each set."""
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = pairs.groupBy("pivot").agg(F.count(F.lit(1)).alias("members"))
    sized = cut(pairs.join(counts, "pivot"), "sized")
    own = sized.select("pivot", F.col("pivot").alias("member"), "members").distinct()
    every = sized.select("pivot", "member", "members").unionByName(own)
    # A large block is not gathered: it stays whole, and is searched in chunks.
    large = every.filter(F.col("members") >= THIN).select("pivot", "member")
    small = every.filter(F.col("members") < THIN).select("pivot", "member")
    full = small.join(maps.withColumnRenamed("id", "member"), "member").select("pivot", "member", "n", "bits")

    def solve(pivot: int, rows: list) -> list[tuple[int, int]]:
        bitmaps = [np.frombuffer(r[2], np.uint64) for r in rows]
        keep = may_link(np.array([r[1] for r in rows], np.int64), bitmaps, percent)
        return [(pivot, r[0]) for r, k in zip(rows, keep, strict=True) if k]

    def run(batches):
        key, rows, out = None, [], []

        def done():
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["pivot", "member"])

        for batch in batches:
            for pivot, *row in zip(*[batch.column(c).to_pylist() for c in ("pivot", "member", "n", "bits")], strict=True):
                if key != pivot:
                    if rows:
                        out += solve(key, rows)
                    key, rows = pivot, []
                rows.append(row)
            if len(out) > 50_000:
                yield done()
                out = []
        if rows:
            out += solve(key, rows)
        if out:
            yield done()

    dealt = full.repartition(parts, "pivot").sortWithinPartitions("pivot")
    return dealt.mapInArrow(run, "pivot bigint, member bigint").unionByName(large).distinct()


def search(slim: DataFrame, pairs: DataFrame, *, width: int, percent: int) -> DataFrame:
    """Links ``a, b`` that connect the groups inside all blocks (``pairs``: pivot, member)."""
    spark = slim.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = pairs.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("chunks"), F.min("member").alias("centre"))
    placed = pairs.join(sizes, "pivot").select("pivot", "chunks", F.pmod(F.xxhash64("member"), F.col("chunks")).alias("chunk"), "member")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1))
    centres = sizes.select("pivot", "chunks", every.alias("chunk"), F.col("centre").alias("member"))
    placed = cut(placed.unionByName(centres).distinct(), "blocks")

    def spread(batches):
        types = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]

        def done(out: list) -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [[]] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["pivot", "chunk", "member", "asks", "shingles"])

        for batch in batches:
            out, held = [], 0
            for doc, text, places in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                blob = shingle_set(text.as_py(), width).tobytes()
                for p in places:
                    out.append((p["pivot"], p["chunk"], doc, p["asks"], blob))
                    held += len(blob)
                    if held > SENT_BYTES:
                        yield done(out)
                        out, held = [], 0
            yield done(out)

    def searched(rows: DataFrame, report: bool) -> DataFrame:
        # One row a document with all the places its set goes to.
        places = cut(rows.groupBy("member").agg(F.collect_list(F.struct("pivot", "chunk", "asks")).alias("places")), "places")
        if rows.count() <= BROADCAST_IDS:
            places = F.broadcast(places)
        sent = slim.join(places, slim["doc_id"] == places["member"]).select("doc_id", "text", "places").mapInArrow(spread, BLOCK)
        dealt = sent.repartition(parts, "pivot", "chunk").sortWithinPartitions("pivot", "chunk")
        return dealt.mapInArrow(_search_blocks(percent, report), FOUND)

    found = cut(searched(placed.withColumn("asks", F.lit(True)), True), "found")
    links = found.filter(~F.col("alone")).select("a", "b")
    # Members that are not with their centre, in blocks of several chunks: all chunks are asked.
    several = placed.filter("chunks > 1")
    alone = found.filter("alone").select("pivot", F.col("a").alias("member")).join(several.select("pivot").distinct(), "pivot", "left_semi")
    alone = cut(alone.distinct(), "alone")
    if alone.isEmpty():
        return links
    ask_sizes = alone.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("asks_chunks"))
    asking = alone.join(ask_sizes, "pivot").withColumn("part", F.pmod(F.xxhash64("member"), F.col("asks_chunks")))
    code = (F.col("part") * F.col("chunks") + F.col("chunk")).alias("chunk")
    askers = asking.join(several.select("pivot", "chunk", "chunks").distinct(), "pivot").select("pivot", code, "member", F.lit(True).alias("asks"))
    asked = several.join(asking.select("pivot", "part").distinct(), "pivot").select("pivot", code, "member", F.lit(False).alias("asks"))
    both = cut(askers.unionByName(asked).groupBy("pivot", "chunk", "member").agg(F.max("asks").alias("asks")), "across")
    more = cut(searched(both, False), "found-across")
    return links.unionByName(more.select("a", "b"))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of the shingle set and group of every document: four words, similarity 0.85."""
    return group(read_table(spark, sf_dir, "documents"), width=4, percent=85)
