"""Best-fit packing by patterns: non-negative least squares over the length histogram.

All documents are cut into pieces of at most ``capacity`` tokens.  Only the histogram of
piece lengths (at most ``capacity`` numbers, whatever the corpus) reaches the driver.
There, patterns of up to three documents whose coarse lengths fill a sequence are
enumerated, their repeat counts are fitted to the histogram by non-negative least
squares and rounded, and what is left is packed best-fit, longest first, into the
space that patterns leave and into new sequences.  Last, sequences with gaps are taken apart and packed
best-fit once more while there are more sequences than their tokens need.  The plan says for every length which
ranks go to which sequences; pieces get their rank from salted counts, so no length,
however common, is ordered in one task.

Defined results for odd input: a null text counts as empty, and an empty text is the
end token alone; a null id is kept; repeated rows are packed each; equal lengths are interchangeable and
go by salt and id; a very long text is cut into pieces, and must fit in a task to be tokenised; added tokens
written out in a text are tokens; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import bisect
import json
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, read_table

CAPACITY = 2048
END_ID = 0
#: Lengths are grouped into this many classes for the enumeration of patterns.
CLASSES = 64

_encoders: dict[str, object] = {}


def _byte_of() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones for themselves,
    the others, in order, are U+0100 and up."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def encoder(path: str):
    """The byte-level BPE of the ``tokenizers`` file at ``path``, once per Python worker.

    Vocabulary, order of merges and added tokens come from that file; ``tiktoken`` applies them, about four
    times as fast and without keeping offsets.  Tests compare the ids with those of ``tokenizers``.
    """
    if path not in _encoders:
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as lines:
            stored = json.load(lines)
        letters, model = _byte_of(), stored["model"]
        special = {t["content"]: t["id"] for t in stored["added_tokens"]}
        ranks = {bytes(letters[c] for c in token): rank for token, rank in model["vocab"].items() if token not in special}
        _encoders[path] = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return _encoders[path]


def token_ids(enc, text: str) -> list[int]:
    """Ids of ``text``; added tokens inside it are tokens, as the vocabulary's own reader takes them."""
    return enc.encode(text, allowed_special="all")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(docs: DataFrame, *, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """Token pieces of every whole text; of a longer document the first piece is the short one."""
    vocabulary = vocabulary or default_vocabulary()

    def encode(batches):
        enc = encoder(vocabulary)
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = token_ids(enc, text.as_py() or "")
                ids.append(END_ID)
                raw = np.asarray(ids, "<u4")
                at, n, k = 0, len(ids), 0
                while at < n:
                    end = at + ((n - 1) % capacity + 1 if k == 0 else capacity)
                    for column, x in zip(out, (doc_id, k, at, end - at, zlib.crc32(raw[at:end].tobytes())), strict=True):
                        column.append(x)
                    at, k = end, k + 1
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(encode, PIECES)


# --- the plan, on the driver ------------------------------------------------------------


def nnls(a: np.ndarray, b: np.ndarray, *, limit: int = 600) -> np.ndarray:
    """Non-negative least squares by the active-set method (Lawson and Hanson)."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(limit):
        slope = np.where(active, -np.inf, a.T @ (b - a @ x))
        j = int(slope.argmax())
        if slope[j] <= tolerance:
            break
        active[j] = True
        while True:
            on = np.flatnonzero(active)
            z = np.linalg.lstsq(a[:, on], b, rcond=None)[0]
            if (z > 0).all():
                x[:] = 0
                x[on] = z
                break
            low = on[z <= 0]
            step = float(np.min(x[low] / np.maximum(x[low] - z[z <= 0], 1e-300)))
            x[on] += step * (z - x[on])
            active[low[int(np.argmin(x[low]))]] = False
            active[on[x[on] <= 1e-12]] = False
            x[~active] = 0
    return x


def patterns(classes: int) -> list[tuple[int, ...]]:
    """Multisets of up to three classes that fill a sequence up to two classes."""
    out = []
    for a in range(classes, 0, -1):
        for b in range(min(a, classes - a), -1, -1):
            for c in range(min(b, classes - a - b), -1, -1):
                if classes - 2 <= a + b + c <= classes:
                    out.append(tuple(x for x in (a, b, c) if x))
    return out


def plan_packing(histogram: dict[int, int], *, capacity: int = CAPACITY) -> list[tuple[list[tuple[int, int]], int]]:
    """Kinds of sequence ``([(length, copies), ...], how many)`` that use up the histogram."""
    left = dict(histogram)
    kinds: list[tuple[list[tuple[int, int]], int]] = []
    if left.get(capacity):
        kinds.append(([(capacity, 1)], left.pop(capacity)))
    classes = min(CLASSES, capacity)
    width = -(-capacity // classes)
    of_class: dict[int, list[int]] = defaultdict(list)
    for length in sorted(left):
        of_class[-(-length // width)].append(length)
    stock = sorted(left)
    spare = np.zeros(classes + 1)
    for length, n in left.items():
        spare[-(-length // width)] += n
    if left:
        shapes = patterns(classes)
        matrix = np.zeros((classes + 1, len(shapes)))
        for j, shape in enumerate(shapes):
            for c in shape:
                matrix[c, j] += 1
        # Short documents fill gaps anyway: missing them costs less.
        weight = np.where(np.arange(classes + 1) <= classes // 16, 0.1, 1.0)
        counts = nnls(matrix * weight[:, None], spare * weight)
        for j in np.argsort(-counts, kind="stable"):
            n = round(counts[j])
            if n < 1:
                break
            while n > 0 and (picked := _realise(shapes[j], of_class, left, stock, capacity)):
                sure = min(n, *(left[x] // k for x, k in picked.items()))
                for x, k in picked.items():
                    left[x] -= sure * k
                    if not left[x]:
                        of_class[-(-x // width)].remove(x)
                        stock.pop(bisect.bisect_left(stock, x))
                kinds.append((list(picked.items()), sure))
                n -= sure
    return _repacked(_best_fit(kinds, left, capacity), capacity)


def _repacked(kinds, capacity: int):
    """Take sequences apart and pack them best-fit while there are more than their tokens need.

    First those with gaps; then with them full ones, those of the shortest documents first, in ever larger
    number, as short documents fill gaps.  The fewest sequences count; patterns that fit stay."""
    count = lambda ks: sum(n for _, n in ks)
    gap = lambda content: capacity - sum(x * k for x, k in content)
    waste = sum(n * gap(content) for content, n in kinds)
    bound = count(kinds) - waste // capacity
    # Gaps first, then by the shortest document.
    order = sorted(kinds, key=lambda kind: (not gap(kind[0]), min(x for x, _ in kind[0])))
    open_ = sum(1 for content, _ in order if gap(content))
    best, budget, total = kinds, waste, capacity * count(kinds)
    while waste and count(best) > bound and budget < 2 * total:
        left: dict[int, int] = defaultdict(int)
        whole, taken = [], 0
        for i, (content, n) in enumerate(order):
            # Of the full sequences of one kind, no more than the budget asks for.
            part = n if i < open_ else min(n, max(0, -(-(budget - taken) // capacity)))
            if i >= open_:
                taken += part * capacity
            for x, k in content:
                if part:
                    left[x] += k * part
            if part < n:
                whole.append((content, n - part))
        best = min(best, _best_fit(whole, left, capacity), key=count)
        budget *= 4
    return best


def _realise(shape, of_class, left, stock, capacity) -> dict[int, int] | None:
    """Lengths for a pattern: the longest left of each class, but for the last document
    the longest that still fits, of whatever class.  None if a class is used up."""
    taken: dict[int, int] = defaultdict(int)
    room = capacity
    for c in shape[:-1]:
        length = next((x for x in reversed(of_class[c]) if x <= room and left[x] > taken[x]), None)
        if length is None:
            return None
        taken[length] += 1
        room -= length
    for at in range(bisect.bisect_right(stock, room) - 1, -1, -1):
        if left[stock[at]] > taken[stock[at]]:
            taken[stock[at]] += 1
            return dict(taken)
    return None


def _best_fit(kinds, left: dict[int, int], capacity: int):
    """Pack what is left, longest first, each into the tightest sequence that takes it."""
    room: dict[int, list] = defaultdict(list)
    for content, n in kinds:
        room[capacity - sum(x * k for x, k in content)].append((content, n))
    gaps = sorted(room)
    done = []

    def put(gap: int, content, n: int) -> None:
        if gap <= 0:
            done.append((content, n))
            return
        if not room[gap]:
            at = bisect.bisect_left(gaps, gap)
            if at == len(gaps) or gaps[at] != gap:
                gaps.insert(at, gap)
        room[gap].append((content, n))

    for length in sorted(left, reverse=True):
        todo = left[length]
        while todo:
            at = bisect.bisect_left(gaps, length)
            if at == len(gaps):
                fit = capacity // length
                if todo >= fit:
                    put(capacity - fit * length, [(length, fit)], todo // fit)
                    todo %= fit
                if todo:
                    put(capacity - todo * length, [(length, todo)], 1)
                break
            gap = gaps[at]
            content, n = room[gap].pop()
            if not room[gap]:
                gaps.pop(at)
            fit = min(gap // length, todo)
            used = min(n, todo // fit)
            if used < n:
                put(gap, content, n - used)
            put(gap - fit * length, [*content, (length, fit)], used)
            todo -= used * fit
    return done + [x for gap in gaps for x in room[gap]]


def rank_table(kinds) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length, from which rank on pieces go to which sequences:
    arrays ``first rank, copies per sequence, first sequence, first offset``."""
    rows: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    used: dict[int, int] = defaultdict(int)
    sequence = 0
    for content, n in kinds:
        at = 0
        for length, k in content:
            rows[length].append((used[length], k, sequence, at))
            used[length] += n * k
            at += length * k
        sequence += n
    return {length: tuple(np.array(c, np.int64) for c in zip(*x, strict=True)) for length, x in rows.items()}


# --- placing the pieces -----------------------------------------------------------------


def pack(parts: DataFrame, *, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows of ``pieces`` (written before, read twice)."""
    spark = parts.sparkSession
    histogram = {int(r["length"]): int(r["n"]) for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = spark.sparkContext.broadcast(rank_table(plan_packing(histogram, capacity=capacity)))

    salts = max(64, max(histogram.values(), default=0) // 50_000)
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    counts = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    columns = list(parts.columns)
    ranked = salted.join(offsets, ["length", "salt"]).select(
        *columns, (F.col("ahead") + F.row_number().over(within) - 1).alias("rank")
    )

    def place(batches):
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for x in np.unique(length):
                here = length == x
                first, copies, base, start = table.value[int(x)]
                i = np.searchsorted(first, rank[here], "right") - 1
                step = rank[here] - first[i]
                sequence[here] = base[i] + step // copies[i]
                offset[here] = start[i] + step % copies[i] * x
            kept = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], [*columns, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema)
    return ranked.mapInArrow(place, f"{schema}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, *, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    return pack(cut(pieces(docs, capacity=capacity, vocabulary=vocabulary), "pieces"), capacity=capacity)


def op3_pack_nnls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document, each with its sequence and place."""
    return pack_documents(read_table(spark, sf_dir, "documents"))
