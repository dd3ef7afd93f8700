"""Secrets, personal data, quality and URL filters against brute force, and odd input."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliant.llm import pii, quality, secrets, urls
from foliant.llm.common import fresh_dir

WORD = r"[^\x20\x09-\x0D]+"
SECRETS = {
    "assign": r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}
PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        c = int(c) * (1 + i % 2)
        total += c - 9 * (c > 9)
    return total % 10 == 0


def base_secrets(text):
    out = []
    for rank, (kind, pattern) in enumerate(SECRETS.items()):
        for m in re.finditer(pattern, text or "", re.ASCII):
            short = {"assign": len(m[2] if kind == "assign" else "") < 6, "access": len(m[0]) < 20, "hex": len(m[0]) < 24}[kind]
            if not short:
                out.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x for *_, x in sorted(out))


def base_pii(text):
    out = []
    for kind, pattern in PII.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub(r"\D", "", m[0])
            bad = {
                "email": False,
                "ip": kind == "ip" and any(int(p) > 255 for p in m[0].split(".")),
                "card": not (13 <= len(digits) <= 19 and luhn(digits)),
                "phone": not 9 <= len(digits) <= 15,
            }[kind]
            if not bad:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def soup(alphabet, n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(n)]


ODD = [None, "", " ", "é" * 3, "x" * 200_000, "a@" * 3000, "1" * 30_000, "ab.c@d-e.fg " * 500]


def frame(spark, texts):
    rows = [(None if i == 3 else i // 2 if i < 8 else i, t, "en", "s", 1, "blob") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, spans int, blob string")


def test_secrets(spark):
    texts = ODD + soup(["token", "=", ":", '"', " ", "AKIA", "A1B2C3D4E5F6G7H8", "deadbeef", "0", "API_KEY", "s3cr", "ſ", "\n", "abcdef"], 800, 1)
    df = frame(spark, texts + texts[:5])
    got = secrets.scan(df, path_col="doc_id").collect()
    assert len(got) == len(texts) + 5
    want = {hashlib.sha256((t or "").encode()).hexdigest(): base_secrets(t) for t in texts}
    for r in got:
        base = ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in r["spans"] if s["rank"] < 3)
        assert base == want[r["blob"]]
    assert secrets.scan(df.limit(0), path_col="doc_id").count() == 0


def test_long_runs_of_tokens_do_not_stop_a_scan(spark):
    import time

    texts = ["eyJ" * 10_000, "eyJabcdefghijk." * 6_000, "token:" * 6_000 + "abcdefg", "AKIA" * 10_000, "-----BEGIN " * 6_000, "x" + "eyJabcdefghijkl.eyJabcdefghijkl.abcdefghijkl"]
    began = time.perf_counter()
    got = secrets.scan(spark.createDataFrame(list(enumerate(texts)), "path int, text string")).collect()
    assert time.perf_counter() - began < 20
    assert {r["path"]: len(r["spans"]) for r in got if r["path"] in (0, 5)} == {0: 0, 5: 0}


def test_very_many_matches_cost_in_proportion(spark):
    import time

    texts = ["a1 b2 " * 50_000 + "0123456789abcdef" * 2, "password=abcdefgh " * 20_000]
    began = time.perf_counter()
    got = {r["path"]: r["spans"] for r in secrets.scan(spark.createDataFrame(list(enumerate(texts)), "path int, text string")).collect()}
    assert time.perf_counter() - began < 40
    assert [(s["start"], s["end"]) for s in got[0]] == [(300_000, 300_032)]
    assert [(s["start"], s["end"]) for s in got[1]] == [(18 * i, 18 * i + 17) for i in range(20_000)]


def test_ledger_scans_only_what_is_new(spark):
    path = fresh_dir(spark, "test-ledger")
    one = spark.createDataFrame([("a", 'token = "abcdef123"'), ("b", "x")], "path string, text string")
    two = spark.createDataFrame([("a", "x"), ("c", 'token = "abcdef123"'), ("d", "secret: 1234567")], "path string, text string")
    secrets.scan(one, ledger_path=path).collect()
    got = {r["path"]: len(r["spans"]) for r in secrets.scan(two, ledger_path=path).collect()}
    assert got == {"a": 0, "c": 1, "d": 1}
    assert spark.read.parquet(path).count() == 3
    newer = [secrets.Rule("assign", "xyz=[0-9]+", 0, 1, version=2), *secrets.RULES[1:]]
    got = {r["path"]: len(r["spans"]) for r in secrets.scan(two, ledger_path=path, rules=newer).collect()}
    assert got == {"a": 0, "c": 0, "d": 0}
    assert spark.read.parquet(path).count() == 6


def test_personal_data(spark):
    texts = ODD + soup(list("ab@.-+ ()0123456789%_ñ") + ["4111 1111 1111 1111", "10.0.0.255", "x@y.z"], 1500, 2)
    got = pii.find(frame(spark, texts).drop("spans")).collect()
    assert len(got) == len(texts)
    want = defaultdict(set)
    for t in texts:
        want[t].add(base_pii(t))
    for r in got:
        base = ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in r["spans"] if s["rank"] < 4)
        assert {base} == want[r["text"]]


def test_context_discovers_what_no_rule_matches(spark):
    rows = [(i, f"words before employee number: user{i}@mail.example.org and after") for i in range(12)]
    rows += [(50, "words before employee number: 77-123456-X and after"), (51, "of 9876543 by"), (52, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: [(s["kind"], r["text"][s["start"] : s["end"]]) for s in r["spans"]] for r in pii.find(df).collect()}
    assert got[50] == [("context", "77-123456-X")] and got[51] == [] and got[52] == []
    out = {r["doc_id"]: r["text"] for r in pii.redact(df).collect()}
    assert out[0] == "words before employee number: [EMAIL] and after" and out[50] == "words before employee number: [CONTEXT] and after" and out[52] is None


def spans_by_id(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r["doc_id"]: [(s["kind"], r["text"][s["start"] : s["end"]]) for s in r["spans"]] for r in pii.find(df).collect()}


def test_contexts_come_from_whole_seeds_and_find_grouped_identifiers(spark):
    texts = [f"please ring (+1 (017) 555-77{i:02d}), soon" for i in range(12)]
    texts += [f"the host at 10.1.2.{i % 10} went" for i in range(10)]
    n = len(texts)
    texts += ["please ring 017 55 77 X9 soon", "please ring AB 12 34 56 C soon", "the host at 1022 went", "the box of 1022 33 went", "é " * 1500 + "please ring (77 12), soon"]
    texts += ["please ring a@b.co 77 13 soon"]
    got = spans_by_id(spark, texts)
    assert got[n] == [("context", "017 55 77 X9")]
    assert got[n + 1] == [("context", "AB 12 34 56 C")]
    assert got[n + 2] == [("context", "1022")]
    assert got[n + 3] == []
    assert got[n + 4] == [("context", "77 12")]
    assert got[n + 5] == [("email", "a@b.co")]


def test_discovered_identifiers_induce_patterns(spark):
    texts = [f"our staff number: user{i}@mail.example.org today" for i in range(60)]
    texts += [f"our staff number: 77-12345{i}-X today" for i in range(6)]
    texts += [f"he signed as 77-12345{i}-X yesterday" for i in range(6)]
    n = len(texts)
    texts += ["he signed as 88-654321-Y yesterday", "a box of 88 65 today"]
    got = spans_by_id(spark, texts)
    assert [got[i] for i in range(n - 6, n)] == [[("context", f"77-12345{i}-X")] for i in range(6)]
    assert got[n] == [("context", "88-654321-Y")] and got[n + 1] == []


def test_redact_keeps_clashing_columns(spark):
    rows = [(1, "a@b.co x 10.1.2.3", 7, "s", 17), (1, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, spans int, _row string, n_chars bigint")
    got = {tuple(r) for r in pii.redact(df).collect()}
    assert got == {(1, None, None, None, None), (1, "[EMAIL] x [IP]", 7, "s", 14)}
    assert pii.redact(df.limit(0)).count() == 0


def counted(text):
    words = re.findall(WORD, text or "")
    lines = [x for x in (text or "").split("\n") if re.search(WORD, x)]
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i : i + 8])].append(i)
    covered = {i + k for v in windows.values() if len(v) > 1 for i in v for k in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_statistics(spark):
    rnd = random.Random(4)
    texts = [None, "", "\n\n", "a " * 9, "a " * 8, "a b c d e f g h " * 4, "x\x0by\x0cz\x1fq\u00a0r", "w" * 100_000]
    texts += [" ".join(rnd.choice("abc") + rnd.choice(["", "#", "\n", "|"]) for _ in range(rnd.randint(0, 60))) for _ in range(300)]
    df = frame(spark, texts).withColumn("doc_id", F.monotonically_increasing_id())
    got = quality.statistics(df, keep=("doc_id", "text")).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for r in got:
        assert tuple(r[n] for n in names) == counted(r["text"]), r["text"][:80]


def test_mcd_finds_outliers_and_equals_numpy(spark):
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(400)]
    rows = []
    for i in range(300):
        text = " ".join(rng.choice(words, rng.integers(60, 300)))
        if i % 10 == 0:
            text = " ".join(w + "###" for w in text.split())
        rows.append((i, text, ["en", "de", None][i % 3], "s", "k"))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, kept string")
    stats = quality.statistics(df)
    got = {r["doc_id"]: r for r in quality.judge(stats).collect()}
    assert all(got[i]["kept"] != (i % 10 == 0) for i in range(300))
    # The same concentration steps in numpy, for one group.
    vec = stats.filter("lang = 'en'").select("doc_id", *[c.alias(f"x{k}") for k, c in enumerate(quality._vector())]).orderBy("doc_id").collect()
    x = np.array([list(r)[1:] for r in vec])
    n, floor = len(x), np.array(quality.FLOOR_SD)
    quantile = lambda p: np.array([np.sort(x[:, k])[int(np.ceil(p * n)) - 1] for k in range(quality.DIM)])
    scale = quality.consistency(quality.COVERAGE)

    def distances(mean, cov):
        return np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)

    def moments(near, scale):
        mean = x[near].mean(0)
        return mean, ((x[near].T @ x[near]) / near.sum() - np.outer(mean, mean)) * scale + np.diag(floor**2)

    middle, ends = quantile(0.5), []
    spread = np.maximum((quantile(0.75) - quantile(0.25)) / 1.349, floor)
    for mean, cov in ((middle, np.diag(floor**2)), (middle, np.diag(spread**2)), moments(np.ones(n, bool), 1.0)):
        for _ in range(quality.STEPS):
            bins = np.clip(np.floor(np.log2(distances(mean, cov) + 1e-9) * 8), -40, 400)
            before = {b: (bins < b).sum() for b in np.unique(bins)}
            mean, cov = moments(np.array([before[b] < quality.COVERAGE * n for b in bins]), scale)
        ends.append((round(0.5 * np.log(np.linalg.det(cov)), 9), len(ends), mean, cov))
    _, _, mean, cov = min(ends, key=lambda e: e[:2])
    assert np.allclose([got[r["doc_id"]]["distance"] for r in vec], distances(mean, cov), rtol=1e-6)
    # No random start ends in a determinant that is much less.
    least = np.inf
    for _ in range(200):
        near = np.zeros(n, bool)
        near[rng.choice(n, quality.DIM + 1, replace=False)] = True
        for _ in range(20):
            m, c = moments(near, scale)
            near = np.zeros(n, bool)
            near[np.argsort(distances(m, c))[: int(np.ceil(quality.COVERAGE * n))]] = True
        least = min(least, np.linalg.det(moments(near, scale)[1]))
    assert np.linalg.det(cov) <= 1.1 * least


def test_chi_square():
    assert quality.chi2_quantile(0.05, 6) == pytest.approx(12.5916, abs=1e-3) and quality.chi2_quantile(0.4, 6) == pytest.approx(6.2108, abs=1e-3)
    assert quality.consistency(1 - 1e-12) == pytest.approx(1, abs=1e-6)


def test_mcd_of_repeated_rows_and_very_long_texts(spark):
    rows = [(i, "the same words as in all the other rows of this group are here to be read again now so that all is equal", "en", "s") for i in range(60)]
    rows += [(100, " ".join(f"word{i}" for i in range(60_000)), "en", "s"), (101, "x# " * 10_000, "en", "s")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    got = {r["doc_id"]: r for r in quality.judge(quality.statistics(df)).collect()}
    assert all(got[i]["kept"] and got[i]["distance"] < 1 for i in range(60)) and got[101]["base_failed"] and len(got) == 62
    assert {r["doc_id"] for r in quality.accepted(df.withColumn("n_words", F.lit(1))).collect()} == {i for i, r in got.items() if r["kept"]}


def test_words_repeated_in_short_runs_are_outliers(spark):
    rnd = random.Random(7)
    words = ["".join(rnd.choices("abcdefgh", k=rnd.randint(2, 8))) for _ in range(400)]
    rows = []
    for i in range(200):
        text = rnd.choices(words, k=rnd.randint(60, 200))
        rows.append((i, " ".join(w for w in text for _ in range(rnd.randint(5, 8) if i < 8 else 1)), "en", "s"))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    stats = quality.statistics(df)
    got = {r["doc_id"]: r for r in quality.judge(stats).collect()}
    assert all((r["base_failed"], r["kept"]) == (False, i >= 8) for i, r in got.items())
    for i, text, *_ in rows:
        w = text.split()
        assert got[i]["n_same_before"] == sum(a == b for a, b in zip(w, w[1:], strict=False))


def test_quality_odd_input(spark):
    df = spark.createDataFrame([(1, None, None, None, 5), (1, None, None, None, 5), (None, "a " * 30, None, "s", 6)], "doc_id bigint, text string, lang string, source string, x0 int")
    got = sorted(map(str, (tuple(r) for r in quality.accepted(df).collect())))
    assert len(got) <= 1
    assert quality.judge(quality.statistics(df)).count() == 3
    assert quality.judge(quality.statistics(df.limit(0))).count() == 0


@pytest.mark.parametrize(
    ("url", "host", "path", "rule", "verdict"),
    [
        ("http://A.Example.ORG/es/x?q#f", "a.example.org", "/es/x", "example.org/es/", "block"),
        ("https://x.org", "x.org", "", None, "allow"),
        ("https://org/en/1", "org", "/en/1", "org/", "allow"),
        ("ftp://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
        ("http://notcom/de/", "notcom", "/de/", None, "allow"),
        ("http://a.com/de/x", "a.com", "/de/x", "com/de/", "block"),
        ("nohost", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("http://a://b/c?d://e", "a:", "//b/c", None, "allow"),
    ],
)
def test_urls(spark, url, host, path, rule, verdict):
    df = spark.createDataFrame([(1, url, None, 3)], "page_id bigint, url string, html string, rule int")
    (r,) = urls.judge(df).collect()
    assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict)


def test_page_rank_equals_brute_force(spark):
    rnd = random.Random(6)
    hosts = [f"h{i}.{rnd.choice(['org', 'com', 'net'])}" for i in range(30)]
    rows = []
    for i in range(150):
        h = rnd.choice(hosts)
        links = " ".join(f'<a href="http://{rnd.choice(hosts).upper()}/x">' for _ in range(rnd.randint(0, 3)))
        rows.append((i, f"http://{h}/{rnd.choice(['de', 'fr', 'en'])}/", links if rnd.random() < 0.9 else None))
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r["page_id"]: r for r in urls.judge(df).collect()}
    edges = {(r[1].split("/")[2], t.lower()) for r in rows for t in re.findall(r"http://([^/]+)/x", r[2] or "")}
    edges = {(a, b) for a, b in edges if a != b}
    score = {}
    for kind, pairs in (("trust", edges), ("distrust", {(b, a) for a, b in edges})):
        seeds = defaultdict(float)
        for i, r in enumerate(rows):
            if got[i]["rule"] and (got[i]["verdict"] == "allow") == (kind == "trust"):
                seeds[r[1].split("/")[2]] += 1
        total = sum(seeds.values())
        seeds = {k: v / total for k, v in seeds.items()}
        rank = dict(seeds)
        out = defaultdict(int)
        for a, _ in pairs:
            out[a] += 1
        for _ in range(300):
            new = defaultdict(float)
            for a, b in pairs:
                if a in rank:
                    new[b] += urls.DAMPING * rank[a] / out[a]
            over = 1 - sum(new.values())
            for k, v in seeds.items():
                new[k] += over * v
            rank = new
        score[kind] = rank
    for i, r in enumerate(rows):
        h = r[1].split("/")[2]
        for kind in score:
            assert got[i][kind] == pytest.approx(score[kind].get(h, 0.0), abs=5e-4) or got[i][kind] is None and h not in score[kind]
        if not got[i]["rule"] and abs(score["trust"].get(h, 0) - score["distrust"].get(h, 0)) > 1e-3:
            t, d = score["trust"].get(h, 0), score["distrust"].get(h, 0)
            assert got[i]["verdict"] == ("block" if d > 0.5 * (t + d) else "allow")
    assert urls.judge(df.limit(0)).count() == 0


def test_masking_and_redaction_equal_plain_python(spark):
    def plain(text, spans):
        at, out = 0, []
        for start, end, kind in spans:
            if start >= at:
                out += [text[at:start], f"[{kind.upper()}]"]
            at = max(at, end)
        return "".join(out) + text[at:]

    texts = ["Write to a.b@x.org now 😀. " * 500, "x 10.1.2.3 +1 (017) 555-7713 y 4111 1111 1111 1111 é " * 50, "+4111111111111111 4111 1111 1111 1111@a.bc", "", None, "é" * 3000 + "a@b.cd"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    marked = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t")).select("doc_id", "t", pii.base_spans(F.col("t")).alias("b"))
    for r in marked.select("t", "b", pii._seeds(F.col("t"), F.col("b")).alias("z")).collect():
        want = list(r["t"])
        for s in r["b"]:
            want[s["start"] : s["end"]] = pii.MASK * (s["end"] - s["start"])
        assert r["z"]["masked"] == "".join(want)
        assert all(x["instance"] == r["t"][x["start"] : x["end"]] for x in r["z"]["seeds"])
    spans = {r["doc_id"]: sorted((s["start"], s["end"], s["kind"]) for s in r["spans"]) for r in pii.find(docs).collect()}
    for r in pii.redact(docs).collect():
        text = texts[r["doc_id"]]
        assert r["text"] == (plain(text, spans[r["doc_id"]]) if spans[r["doc_id"]] else text)
