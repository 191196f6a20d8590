"""Exact groups and linked sets, against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from flowloom.llm import exact_dedup
from flowloom.llm.exact_dedup import dedup_stage, exact_groups
from flowloom.llm.jaccard_join import Bands, allocate, components, jaccard_join, near_dedup_stage
from tests.llm.conftest import frame

LAST = 1 << 62


def test_exact(docs, rows, ws):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    groups = defaultdict(list)
    for (i, _), t in zip(rows, norm, strict=True):
        groups[t].append(LAST if i is None else i)
    got = exact_groups(docs, ws).collect()
    want = Counter((i, None if min(groups[t]) == LAST else min(groups[t]), len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for (i, _), t in zip(rows, norm, strict=True))
    assert Counter((r.doc_id, r.keep_id, r.group_size, bytes(r.digest).hex()) for r in got) == want
    assert sum(r.kept for r in got) == len(groups) and all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_runs_and_fan_in_change_nothing(docs, ws, spark):
    a = exact_groups(docs, ws).select("doc_id", "keep_id", "group_size").collect()
    from flowloom.llm._common import Workspace

    b = exact_groups(docs, Workspace(spark, "test"), runs=5, fan_in=2).select("doc_id", "keep_id", "group_size").collect()
    assert Counter(map(tuple, a)) == Counter(map(tuple, b))


def test_exact_stage(spark, docs, empty, rows):
    kept = dedup_stage(spark, docs, "")
    assert kept.columns == docs.columns
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows})
    assert dedup_stage(spark, empty, "").collect() == []


def test_native_plan(spark, docs):
    """No Python in the plan of the main path."""
    plan = exact_dedup.digests(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_rounds_merge_sorted_runs(docs):
    """A round is one exchange by run and range, one sort, and an aggregation in that order."""
    rows = exact_dedup.digests(docs, 4).selectExpr("*", "ascii(digest) % 3 AS range", "1L AS size")
    key = ["digest", "length", "check"]
    first = exact_dedup.of_run(rows, key)
    plan = exact_dedup.merged(exact_dedup.merged(first, key, 2), key, 2)._jdf.queryExecution().executedPlan().toString()
    exchanges = re.findall(r"Exchange (\w+)\(([^)]*)", plan)
    assert len(exchanges) == 3 and [x.count("digest") for _, x in exchanges] == [0, 0, 1]


def brute_components(rows, num=85, den=100):
    lower = {c: c + 32 for c in range(65, 91)}
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        sets.append(frozenset(tuple(w[k : k + 4]) for k in range(len(w) - 3)) if len(w) >= 4 else frozenset([tuple(w)] if w else []))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), LAST), i)
    return Counter((i, len(s), (least.get(find(k)) if s else i)) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True)))


def near_rows(seed=3):
    """Groups of texts that differ by about the bound, on both sides of it, of many sizes."""
    rng = random.Random(seed)
    out = []
    for size in (2, 5, 8, 10, 14, 25, 60, 150, 400):
        base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        for _ in range(6):
            words = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, max(1, size // 50), max(1, size // 25)])):
                k = rng.randrange(len(words) + 1)
                if rng.random() < 0.5 and k < len(words):
                    words[k] = f"v{rng.randrange(10**6)}"
                else:
                    words.insert(k, f"v{rng.randrange(10**6)}")
            cut = rng.choice([0, 0, 0, size // 12, size // 8])
            out.append((len(out) * 7 % 97, " ".join(words[cut:])))
    return out


def test_jaccard(spark, docs, rows, ws):
    more = near_rows()
    table = docs.select("doc_id", "text").unionByName(frame(spark, [(i + 1000, t) for i, t in more]).select("doc_id", "text"))
    got = jaccard_join(table, ws).collect()
    assert Counter(map(tuple, got)) == brute_components(rows + [(i + 1000, t) for i, t in more])


def test_jaccard_groups_around_a_missing_middle(spark, ws):
    """Copies of a text with edits of their own: many share most signatures, few link, some only by way of others."""
    rng = random.Random(8)
    rows = []
    for size, copies in ((60, 40), (147, 60), (300, 30)):
        base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        styles = [[(rng.randrange(size), f"s{rng.randrange(10**6)}") for _ in range(3)] for _ in range(3)]
        for _ in range(copies):
            words = list(base)
            for k, w in rng.choice([[], *styles]):
                words[k] = w
            for _ in range(rng.choice([1, 1, 2, 3, 4, 6])):
                words[rng.randrange(size)] = f"v{rng.randrange(40)}" if rng.random() < 0.5 else f"u{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(words)))
    rng.shuffle(rows)
    got = Counter(map(tuple, jaccard_join(frame(spark, rows), ws).collect()))
    want = brute_components(rows)
    assert got == want and 20 < len({c for _, _, c in want}) < 120


def test_jaccard_over_many_chunks(spark, docs, rows, ws):
    got = jaccard_join(docs, ws, chunk_bytes=4000, bucket_bytes=6000).collect()
    assert Counter(map(tuple, got)) == brute_components(rows)


def test_jaccard_empty(empty, ws):
    assert jaccard_join(empty, ws).collect() == []


def test_jaccard_stage(spark, ws):
    table = frame(spark, [(i, t) for i, t in near_rows(5)] + [(None, "a b c d e"), (None, None)])
    kept = near_dedup_stage(spark, table, "")
    assert kept.columns == table.columns
    want = {c for i, _, c in brute_components([(i, t) for i, t in near_rows(5)])}
    assert Counter(r.doc_id for r in kept.collect() if r.doc_id is not None) == Counter({i: 1 for i in want})


def test_jaccard_stage_drops_rows(spark):
    """Not doc_ids: they may be missing or repeated."""
    base = " ".join(f"w{k}" for k in range(60))
    rows = [(1, base), (5, base + " more"), (5, "wholly different"), (None, base + " less"), (None, "none of these"), (7, None), (7, None), (3, "x y z"), (3, "x y z"), (8, base.upper())]
    kept = near_dedup_stage(spark, frame(spark, rows), "")
    assert sorted((str(r.doc_id), r.text or "") for r in kept.collect()) == sorted([("1", base), ("5", "wholly different"), ("None", "none of these"), ("7", ""), ("7", ""), ("3", "x y z")])


def test_bands_hold_linked_sizes():
    b = Bands(85, 100, 5000)
    for n in range(1, 3000, 7):
        k = b.of(np.array([n]))[0]
        low = -(-85 * n // 100)
        assert b.of(np.array([max(1, low)]))[0] >= k - 1
        d = int(b.difference(2 * n))
        assert d <= b.most[k] and (d == 0 or b.m[k] >= d + 1)


def test_allocation_adds_up_and_is_cheapest():
    rng = random.Random(1)
    for _ in range(200):
        m = rng.randint(1, 6)
        equal = np.array([float(rng.choice([0, 0, 1, 5, 9])) for _ in range(m)])
        near = np.array([e + rng.choice([0, 1, 4, np.inf]) for e in equal])
        need = rng.randint(1, m)
        t = allocate(need, equal, near)
        assert (t + 1).sum() >= need and not np.isinf(np.where(t == 1, near, 0)).any()


@pytest.mark.parametrize("kind", ["path", "star", "random"])
def test_components(spark, ws, kind):
    rng = random.Random(4)
    n = 40
    edges = [(k, k + 1) for k in range(n)] if kind == "path" else [(0, k) for k in range(1, n)] if kind == "star" else [(rng.randrange(n), rng.randrange(n)) for _ in range(30)]
    names = list(range(n + 1))
    rng.shuffle(names)
    pairs = [(names[a], names[b]) for a, b in edges]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        ra, rb = find(a), find(b)
        root[max(ra, rb)] = min(ra, rb)
    got = {r.node: r.label for r in components(spark.createDataFrame(pairs, "a long, b long"), ws, "c").collect()}
    assert got == {x: find(x) for p in pairs if p[0] != p[1] for x in p}
