"""Packing, mixing, chat, joins, search, pages and the pipeline against brute force, and odd input."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliant.llm import blocks, chat, covertree, jaccard, mixing, packing

SF = "/root/testdata/sf0.001"


def docs(spark, rows, extra="lang string, source string"):
    return spark.createDataFrame(rows, f"doc_id bigint, text string, {extra}")


# --- packing ---------------------------------------------------------------------------------


def test_pieces_equal_the_tokenizers_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    reader = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [None, "", " ", "x" * 3000, "it's  DON'T\n\n we'LL", "日本語 テキスト é", "a<|endoftext|>b", " <|endoftext|> x<|endoftext|><|endoftext|>", "<|endoftext", "word " * 5000, "\ud7ff\x00\x1f\u3000\u00ad  \r\n"]
    texts += [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").limit(40).collect()]
    rows = [(i, t, None, "s") for i, t in enumerate(texts)] + [(None, "x", None, None), (1, "", None, None)]
    got = packing.pack_documents(docs(spark, rows)).collect()
    want = Counter()
    for doc, t, *_ in rows:
        ids = reader.encode(t or "", add_special_tokens=False).ids + [0]
        at, k = 0, 0
        while at < len(ids):
            end = at + ((len(ids) - 1) % 2048 + 1 if k == 0 else 2048)
            want[(doc, k, at, end - at, zlib.crc32(np.array(ids[at:end], "<u4").tobytes()))] += 1
            at, k = end, k + 1
    assert Counter(tuple(r)[:5] for r in got) == want
    valid_packing([(r["sequence_id"], r["offset"], r["length"]) for r in got], 2048)
    assert packing.pack_documents(docs(spark, []).limit(0)).count() == 0


def valid_packing(places, capacity):
    by = defaultdict(list)
    for s, o, n in places:
        by[s].append((o, n))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("seed", range(4))
def test_plan_is_close_to_the_bound(seed):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(2048, rng.lognormal(6, 1, 20_000).astype(int) + 1)
    histogram = dict(Counter(lengths.tolist()))
    kinds = packing.plan_packing(histogram)
    used = Counter()
    for content, n in kinds:
        assert sum(x * k for x, k in content) <= 2048
        for x, k in content:
            used[x] += n * k
    assert used == histogram
    table = packing.rank_table(kinds)
    places = []
    for x, n in histogram.items():
        first, copies, base, start = table[x]
        rank = np.arange(n)
        i = np.searchsorted(first, rank, "right") - 1
        places += zip(base[i] + (rank - first[i]) // copies[i], start[i] + (rank - first[i]) % copies[i] * x, [x] * n, strict=True)
    assert valid_packing(places, 2048) <= -(-int(lengths.sum()) // 2048) + 1


def fewest(items, capacity):
    """Exact number of sequences, by trying all."""
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for room in set(rooms):
            if room >= items[i]:
                j = rooms.index(room)
                go(i + 1, [*rooms[:j], room - items[i], *rooms[j + 1 :]])
        go(i + 1, [*rooms, capacity - items[i]])

    go(0, [])
    return best[0]


def test_plans_of_few_documents_are_the_best_there_are():
    for seed in range(120):
        rnd = random.Random(seed)
        capacity = rnd.choice([10, 20, 64])
        items = [rnd.randint(1, capacity) for _ in range(rnd.randint(1, 10))]
        kinds = packing.plan_packing(dict(Counter(items)), capacity=capacity)
        assert sum(n for _, n in kinds) == fewest(items, capacity)


def test_nnls():
    rng = np.random.default_rng(1)
    a = rng.random((12, 30))
    b = rng.random(12)
    x = packing.nnls(a, b)
    slope = a.T @ (b - a @ x)
    assert (x >= 0).all() and slope.max() < 1e-6 and abs(slope[x > 0]).max(initial=0) < 1e-6


# --- mixing ------------------------------------------------------------------------------------


def test_mix(spark):
    rnd = random.Random(2)
    rows = [(i, " ".join("w" for _ in range(rnd.choice([0, 1, 3, 7, 20, 50]))), "en", rnd.choice(["a", "b", "c", "d", None]), "q") for i in range(600)]
    rows += [(5, None, None, None, None), (None, "x y", None, "a", "q"), (7, "x y", None, "a", "q"), (7, "x y", None, "a", "q")]
    df = docs(spark, rows, "lang string, source string, size string")
    got = mixing.choose(df, keep=["doc_id"]).collect()
    assert sorted(map(str, got)) == sorted(map(str, mixing.choose(df.repartition(7), keep=["doc_id"]).collect()))
    sizes = Counter()
    for _, t, _, s, _ in rows:
        sizes[s] += len((t or "").split())
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate([*sorted(x for x in sizes if x), None])}
    target, left, active = {}, 1.5 * sum(sizes.values()), set(sizes)
    while over := [s for s in active if left * weight[s] / sum(weight[x] for x in active) > 2 * sizes[s]]:
        share = left / sum(weight[x] for x in active)
        del share
        for s in over:
            target[s] = 2 * sizes[s]
        left -= sum(2 * sizes[s] for s in over)
        active -= set(over)
    target |= {s: left * weight[s] / sum(weight[x] for x in active) for s in active}
    taken = defaultdict(int)
    for r in got:
        key = next(s for s in sizes if sizes[s] == r["source_size"] and abs(target[s] - r["target"]) < 1e-6)
        taken[key] += r["copies"] * r["size"]
        assert r["copies"] in (0, 1, 2)
    assert all(abs(taken[s] - target[s]) <= 1 for s in sizes)
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns and mixed.count() == sum(r["copies"] for r in got)
    assert mixing.choose(df.limit(0), keep=["doc_id"]).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_knapsack(seed):
    rng = np.random.default_rng(seed)
    lengths, counts, budget = np.unique(rng.integers(1, 60, 6)), None, int(rng.integers(0, 250))
    counts = rng.integers(0, 5, len(lengths))
    sums = {0}
    for n, c in zip(lengths.tolist(), counts.tolist(), strict=True):
        sums = {s + n * k for s in sums for k in range(c + 1)}
    used = mixing.knapsack(lengths, counts, budget)
    assert (used <= counts).all() and (used * lengths).sum() == max(s for s in sums if s <= budget)


# --- chat ----------------------------------------------------------------------------------------


def test_chat_round_trip():
    rnd = random.Random(3)
    bits = ["<", "|", ">", "\\", "[INST]", "</s>", "<|end|>", "\n", "a", "<|user|>", "/INST]", "[", "s>", "<s", "<<SYS>>"]
    for _ in range(4000):
        turns = [(rnd.choice(["user", "assistant", "system", "a|>b", "<|end|>", "\\"]), "".join(rnd.choices(bits, k=rnd.randint(0, 9)))) for _ in range(rnd.randint(0, 7))]
        found = chat.format_conversation(turns, len, budget=rnd.randint(5, 120), history=rnd.randint(0, 60))
        back, learnt = chat.read_back(found)
        assert back == turns and learnt == [t for r, t in turns if r == "assistant"]
        assert not any(c in chat.escape(t) for _, t in turns for c in chat.CONTROL)


def test_windows_keep_the_budget_and_repeat_little():
    for seed in range(300):
        rnd = random.Random(seed)
        tokens = [rnd.randint(1, 40) for _ in range(rnd.randint(1, 15))]
        system = rnd.randint(0, 1)
        at = system
        for back, new, end in chat.windows_of(tokens, system, budget=100, history=30):
            assert new == at and sum(tokens[back:new]) <= 30
            assert sum(tokens[:system]) + sum(tokens[back:end]) <= 100 or (back == new and end == new + 1)
            at = end
        assert at == len(tokens)


def test_chat_digests(spark):
    import hashlib

    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "</s>é"), (1, 1, "assistant", "</s>é"), (2, None, None, None), (None, 0, "assistant", "x" * 50_000), (3, 0, "system", "s")]
    rows += [(4, i, ["user", "assistant"][i % 2], "word " * 700) for i in range(8)]
    df = spark.createDataFrame([(*r, 9) for r in rows], "conv_id bigint, turn bigint, role string, text string, mask int")
    got = {r["conv_id"]: r for r in chat.digest_windows(chat.format_windows(df)).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted(((-1 if r[1] is None else r[1]), r[2] or "", r[3] or "") for r in rows if r[0] == conv)
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["turns_sha256"]) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert got[4]["n_windows"] > 1
    assert chat.digest_windows(chat.format_windows(df.limit(0))).count() == 0


# --- Jaccard join ------------------------------------------------------------------------------------


def groups_by_force(rows, width, percent):
    sets, parent = defaultdict(list), {}
    for doc, text in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        sets[doc].append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} - {()})
        parent[doc] = doc

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    flat = [(d, s) for d, v in sets.items() for s in v if s]
    for i, (d, s) in enumerate(flat):
        for e, t in flat[i + 1 :]:
            if 100 * len(s & t) >= percent * len(s | t):
                a, b = find(d), find(e)
                parent[max(a, b)] = min(a, b)
    return {d: find(d) for d in parent}


@pytest.mark.parametrize(("width", "percent", "hot", "chunk"), [(4, 85, 64, 256), (5, 80, 3, 8)])
def test_groups(spark, monkeypatch, width, percent, hot, chunk):
    monkeypatch.setattr(jaccard, "HOT", hot)
    monkeypatch.setattr(jaccard, "CHUNK", chunk)
    rnd, rows = random.Random(width), []
    for _ in range(40):
        n = rnd.choice([3, 5, 8, 10, 12, 15, 20, 40, 100, 300])
        base = [f"w{rnd.randint(0, 10**6)}" for _ in range(n)]
        for _ in range(rnd.choice([2, 3, 5, 12])):
            v = list(base)
            for _ in range(rnd.randint(0, max(1, n // 22))):
                i, kind = rnd.randrange(len(v)), rnd.random()
                v[i : i + 1] = [] if kind < 0.3 and len(v) > 1 else [v[i], f"y{rnd.random()}"] if kind < 0.6 else [f"x{rnd.random()}"]
            rows.append((len(rows), " ".join(v)))
    base = [f"w{rnd.randint(0, 10**6)}" for _ in range(150)]
    for _ in range(60):
        v = list(base)
        for _ in range(rnd.randint(0, 6)):
            v[rnd.randrange(150)] = f"x{rnd.random()}"
        rows.append((len(rows), " ".join(v)))
    n = len(rows)
    rows += [(n, ""), (n + 1, None), (n + 2, "one two"), (n + 3, "One\tTWO\n"), (n + 4, " ".join(base)), (n + 4, rows[0][1]), (n + 5, "é É x"), (n + 6, "q " * 30_000)]
    df = docs(spark, [(d, t, "en", 3) for d, t in rows] + [(None, "one two", "en", 3)], "lang string, component_id int").repartition(5)
    got = jaccard.group(df, width=width, percent=percent).collect()
    assert len(got) == len(rows) + 1
    want = groups_by_force(rows, width, percent)
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None} == want
    assert [r["component_id"] for r in got if r["doc_id"] is None] == [None]
    assert jaccard.group(df.limit(0), width=width, percent=percent).count() == 0


def test_search_equals_counting():
    rng = np.random.default_rng(4)
    for _ in range(60):
        pool = rng.integers(0, 2**63, 60).astype(np.uint64)
        sets = [np.unique(rng.choice(pool, rng.integers(1, 58))) for _ in range(12)]
        index = jaccard.Index(sets)
        for q in sets:
            want = [i for i, s in enumerate(sets) if 100 * len(np.intersect1d(q, s)) >= 80 * len(np.union1d(q, s))]
            assert sorted(index.search(q, 80).tolist()) == want


def test_bitmaps_never_part_linked_sets():
    rng = np.random.default_rng(5)
    for _ in range(40):
        base = np.unique(rng.integers(0, 2**63, 400).astype(np.uint64))
        other = np.unique(np.r_[base[rng.random(len(base)) > 0.07], rng.integers(0, 2**63, 12).astype(np.uint64)])
        linked = 100 * len(np.intersect1d(base, other)) >= 85 * len(np.union1d(base, other))
        maps = [np.frombuffer(jaccard.parity(s), np.uint64) for s in (base, other)]
        keep = jaccard.may_link(np.array([len(base), len(other)]), maps, 85)
        assert not linked or keep.all()


@pytest.mark.parametrize("percent", [80, 85])
def test_prefixes_of_linked_sets_meet(percent):
    rng = np.random.default_rng(8)
    levels = rng.integers(0, 9, jaccard.SLOTS).astype(np.uint8)
    for n in (1, 2, 3, 5, 9, 40, 300, 20_000, 500_000):
        base = np.unique(rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
        prints = jaccard.prefix(base, levels, percent)
        assert len(prints) <= len(base) * (100 - percent) / 100 + 1
        for same in (1.0, percent / 100 + 0.001):
            # Sets that are replaced in part, or shorter, at the threshold.
            keep = base[: math.ceil(len(base) * (2 * same / (1 + same)))]
            fresh = rng.integers(0, 2**63, len(base) - len(keep)).astype(np.uint64) * np.uint64(2)
            for other in (np.unique(np.r_[rng.permutation(base)[: len(keep)], fresh]), np.sort(rng.permutation(base)[: math.ceil(len(base) * same)])):
                assert 100 * len(np.intersect1d(base, other)) >= percent * len(np.union1d(base, other))
                assert len(np.intersect1d(prints, jaccard.prefix(other, levels, percent)))


def test_order_counts_the_whole_corpus(spark):
    texts = ["common words in all of them and"] * 3 + [f"common words in all of them and w{i}" for i in range(50)] + [None, ""]
    df = docs(spark, [(i, t, None, None) for i, t in enumerate(texts)]).repartition(3)
    levels, total = jaccard.shingle_order(df, 4)
    shared = jaccard.shingle_set(texts[0], 4)
    assert (levels[shared & np.uint64(jaccard.SLOTS - 1)] >= np.floor(8 * np.log2(51))).all() and total >= 50 * 5
    assert jaccard.shingle_order(df.limit(0), 4)[1] == 0


def test_group_takes_long_texts(spark):
    words = [f"w{i}" for i in range(100_000)]
    changed = [f"x{i}" if i % 100 == 0 else w for i, w in enumerate(words)]
    df = docs(spark, [(1, " ".join(words), None, None), (2, " ".join(changed), None, None), (3, " ".join(words[:50_000]), None, None)])
    got = {r["doc_id"]: r["component_id"] for r in jaccard.group(df, width=5, percent=80).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


# --- top-k -----------------------------------------------------------------------------------------


def nearest(queries, rows, k):
    """Best rows by whole numbers; a row is no candidate of itself."""
    out = []
    for a, q in queries:
        found = sorted((-sum(x * y for x, y in zip(q, v, strict=True)), float("inf") if i is None else i) for b, (i, v) in enumerate(rows) if b != a)
        out.append([(-s, None if i == float("inf") else i) for s, i in found[:k]])
    return out


@pytest.mark.parametrize("block", [8192, 60])
def test_top_k(spark, monkeypatch, block):
    monkeypatch.setattr(covertree, "BLOCK_ROWS", block)
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=5).tolist(), 0) for i in range(300)] + [(i, [0.1, 0.2, 0.3, 0.4, 0.5], 0) for i in range(300, 340)]
    rows += [(i, (rng.normal(size=5) + 40 * (i % 3)).tolist(), 0) for i in range(500, 640)]
    rows += [(400, None, 0), (401, [1.0, None, 0.0, 0.0, 0.0], 0), (402, [float("nan")] * 5, 0), (20, [0.5] * 5, 0), (None, [9.0] * 5, 0), (403, [1.0, 1.0], 0)]
    for large in ([], [(700, [1e9, -1e9, 5.0, 0.0, 1.0], 0), (720, [1e300, 0.0, -1e290, 0.0, 0.0], 0), (721, [1e9] * 5, 0), (722, [1e308] * 5, 0)]):
        df = spark.createDataFrame(rows + large, "vec_id bigint, embedding array<double>, score int")
        valid = [(i, [math.floor(64 * x) for x in v] + [0] * (5 - len(v))) for i, v, _ in rows + large if v and all(x is not None and math.isfinite(64 * x) for x in v)]
        queries = [(b, v) for b, (i, v) in enumerate(valid) if i is not None and i % 20 == 0]
        want = Counter()
        for (b, _), found in zip(queries, nearest(queries, valid, 20), strict=True):
            want.update((valid[b][0], k + 1, j, s if -(2**63) <= s < 2**63 else None) for k, (s, j) in enumerate(found))
        report = {}
        assert Counter(tuple(r) for r in covertree.top_k(df.repartition(3), report=report).collect()) == want
        assert report["searched"] <= report["pairs"]
        if block == 60 and not large:
            assert report["searched"] < report["pairs"]
    assert covertree.top_k(df.limit(0)).count() == 0
    assert covertree.top_k(df.filter("vec_id = 400")).count() == 0


@pytest.mark.parametrize("leaf", [256, 8])
def test_trees_and_dual_search(leaf):
    rng = np.random.default_rng(7)
    tables = [np.floor(rng.normal(size=(n, 3)) * 3) for n in (0, 1, 2, 5, 30, 900)]
    tables += [np.floor(rng.normal(size=(200, 3)) * 1e9), np.floor(rng.normal(size=(60, 3)) * 10.0 ** rng.integers(0, 300, (60, 1)))]
    tables += [np.floor(rng.normal(size=(5, 4)) * 9).repeat(80, 0), np.floor(rng.normal(size=(400, 6)) * 2 + rng.integers(0, 9, (400, 1)) * 60)]
    for x in tables:
        ids = rng.permutation(len(x))
        (oq, tq), (ox, tx) = covertree.cover_tree(x[:9], leaf=leaf), covertree.cover_tree(x, leaf=leaf)
        for i in range(len(tx.start)):
            away = covertree.lengths(tx.x[tx.start[i] : tx.end[i]] - tx.x[tx.start[i]])
            assert not np.isfinite(tx.radius[i]) or away.max() <= tx.radius[i]
            assert all(tx.radius[c] <= tx.radius[i] / 2 for c in tx.children(i))
        best, score = covertree.dual_search(tq, tx, oq, ox, ids[ox], 20)
        rows = [(int(i), [int(v) for v in r]) for i, r in zip(ids, x, strict=True)]
        want = nearest([(int(o), rows[o][1]) for o in oq], rows, 20)
        assert [[(int(s), ids[ox][b]) for b, s in zip(r, t, strict=True) if b >= 0] for r, t in zip(best, score, strict=True)] == want
        if len(x) > 30 and score.dtype != object:
            beat = np.array([w[-1][0] for w in want])
            again = covertree.dual_search(tq, tx, oq, ox, ids[ox], 20, beat)
            assert (again[0] == best).all() and (again[1] == score).all()


# --- pages -------------------------------------------------------------------------------------------


def test_held_out_accuracy():
    from foliant.llm.train_blocks import accuracy

    assert accuracy(blocks.load_weights(), range(2_000_000, 2_000_150)) > 0.98


def test_main_text(spark):
    html = (
        "<html><head><title>t</title><script>var t='</p><p>no</p>'</script></head><body><nav><ul><li><a href=/a>home</a><li><a href=/b>news</a></ul></nav>"
        "<article><h1>The title of it all</h1><p>One &amp; two\n  three, four five.<p><b>Six seven eight nine.</b> Ten eleven twelve.</article>"
        "<footer>&copy; all rights reserved</footer></body></html>"
    )
    rows = [(1, "u", html, "x"), (1, "u", html, "x"), (None, None, None, "x"), (3, "u", "", "x"), (4, "u", "<p <b> < 3 &#x41;" + "<i>" * 500, "x")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = blocks.extract(df).collect()
    text = "The title of it all One & two three, four five. Six seven eight nine. Ten eleven twelve."
    assert [(r["text"], r["n_chars"]) for r in got if r["page_id"] == 1] == [(text, len(text))] * 2
    assert [r["text"] for r in got if r["page_id"] in (None, 3)] == ["", ""]
    assert blocks.extract(df.limit(0)).count() == 0


def article(html):
    return " ".join(x.text for x in blocks.leaves(html) if x.at and x.at.within("article"))


def test_labels_equal_the_article_of_the_pages(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {(r["page_id"], r["url"]): r["text"] for r in blocks.extract(rows).collect()}
    want = {(r["page_id"], r["url"]): article(r["html"]) for r in rows.collect()}
    assert got == want and len(got) > 200


@pytest.mark.parametrize(
    "html",
    [
        '<a "' * 250_000, '<a ">' * 200_000 + '"', ('<a "x>" "<b \'>') * 70_000 + '"', "<a>" * 100_000 + "</b>" * 100_000,
        "<b><p>" + "<a>" * 100_000 + "</b>" * 100_000, "<" * 1_000_000, "<a " + 'class=" ' * 120_000 + ">", "<div>" * 100_000 + "x", "<!--" * 200_000,
    ],
)
def test_broken_pages_are_read_in_one_pass(html):
    import time

    began = time.perf_counter()
    blocks.main_text([html], blocks.load_weights())
    assert time.perf_counter() - began < 4


def test_leaves():
    read = lambda h: [(x.text, x.linked) for x in blocks.leaves(h)]
    assert read("<p>a <math><mi>x</mi><mo>=</mo></math><svg><text>y</text></svg> <object>z</object>") == [("a x=y z", 0)]
    assert read("<p>a<a href='>'>b</a>c</p><ul><li>d<li>e</ul><script>f<p></script>g") == [("abc", 1), ("d", 0), ("e", 0), ("g", 0)]
    assert read("<head><title>t</title><p>a<b>b</p>c</b>") == [("ab", 0), ("c", 0)]
    assert read('<a "x>y') == [("y", 1)] and read("a < b <c") == [("a < b <c", 0)] and read(None) == []
    assert [x.at.within("article") for x in blocks.leaves("<article><div><p>a</div></article><p>b")] == [True, False]


def test_long_pages_are_labelled_piece_by_piece():
    html = "<nav>" + "<a href=x>menu</a><br>" * 30 + "</nav><article>" + "<p>One two three, four five six seven. Eight nine ten.</p>" * 200 + "</article>"
    page, weights = blocks.leaves(html), blocks.load_weights()
    whole = blocks.label([page], weights)[0]
    assert np.allclose(blocks.label_long(page, weights, cells=37), whole, atol=1e-4)


# --- pipeline ------------------------------------------------------------------------------------------


def test_pipeline(spark):
    import corpus_pipeline as cp
    from foliant.llm.common import cut

    base = spark.read.parquet(f"{SF}/documents.parquet").withColumn("kept", F.lit(1))
    base = cut(base.unionByName(base.limit(5)).unionByName(spark.createDataFrame([(None, None, None, None, None, 2)], base.schema)), "t")
    table, counts = base, []
    for _, stage in cp.STAGES[:-1]:
        table = cut(stage(spark, table, SF), "s")
        assert table.columns == base.columns
        counts.append(table.count())
    assert 0.5 * base.count() < counts[1] <= counts[0] <= base.count() and counts[2] == counts[1]
    packed = cut(cp.STAGES[-1][1](spark, table, SF), "p")
    assert packed.groupBy("doc_id", "piece").count().count() == packed.select("doc_id", "piece").distinct().count()
    valid_packing([(r["sequence_id"], r["offset"], r["length"]) for r in packed.collect()], 2048)
