"""Substring dedup and the Jaccard join against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from tokenloom.llm import jaccard, substring

SCHEMA = "doc_id bigint, text string, extra string"


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def brute_spans(rows, window):
    first = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = words(t)
        keep = [True] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k:k + window])] < i:
                keep[k:k + window] = [False] * window
        kept = " ".join(x for x, y in zip(w, keep) if y)
        out.append((i, len(w), len(w) - sum(keep), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def brute_components(rows, percent):
    sets = {}
    for i, t in rows:
        w = words((t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(w[k:k + 4]) for k in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    lists, common = defaultdict(list), Counter()
    for i, s in sets.items():
        for g in s:
            for j in lists[g]:
                common[i, j] += 1
            lists[g].append(i)
    for (i, j), c in common.items():
        if 100 * c >= percent * (len(sets[i]) + len(sets[j]) - c):
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return {(i, len(sets[i]), find(i)) for i in sets}


def corpus(seed):
    """Copies, edited copies, a passage in many documents, short and odd texts."""
    r = random.Random(seed)
    word = lambda: r.choice("abcdefgh") + r.choice("xyz") + str(r.randrange(40))
    prose = lambda n: [word() for _ in range(n)]
    passage, base, rows = prose(70), prose(120), []
    for _ in range(40):
        rows.append(prose(r.randrange(0, 150)))
    for _ in range(40):
        at = r.randrange(0, 60)
        rows.append(prose(at) + passage + prose(r.randrange(0, 200)))
    for _ in range(60):
        copy = list(base)
        for _ in range(r.randrange(0, 4)):
            copy[r.randrange(len(copy))] = word()
        rows.append(copy)
    small = prose(16)
    for _ in range(40):
        copy = list(small)
        if r.random() < 0.7:
            copy.insert(r.randrange(len(copy)), word())
        rows.append(copy[:r.randrange(3, 18)])
    rows += [base, base, ["A", "b"], ["a", "B"], [], ["z"] * 300]
    r.shuffle(rows)
    return [(i, r.choice([" ", "\n", "  "]).join(w)) for i, w in enumerate(rows)] + [(len(rows), None), (len(rows) + 1, "")]


@pytest.mark.parametrize("seed", [1, 2])
def test_substring_dedup_is_exact(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA).repartition(5)
    got = sorted(map(tuple, substring.removal_report(df, 20).collect()), key=str)
    assert got == brute_spans(rows, 20)


def test_substring_dedup_edges(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(1, text), (1, text), (2, "Intro.\n" + text + "\n end"), (None, text), (3, None), (4, "")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    out = {(r.doc_id, r.text, r.extra) for r in substring.dedup(df).collect()}
    assert out == {(1, text, "x"), (2, "Intro.\nend", "x"), (None, text, "x"), (3, None, "x"), (4, "", "x")}
    assert substring.dedup(df.limit(0)).collect() == []


@pytest.mark.parametrize("seed,light", [(1, 16), (2, 3)])
def test_jaccard_components_are_exact(spark, monkeypatch, seed, light):
    monkeypatch.setattr(jaccard, "LIGHT", light)   # low: heavy lists, cells and leftover pairs
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA).repartition(5)
    got = {tuple(r) for r in jaccard.near_components(df).collect()}
    assert got == brute_components(rows, 85)


def test_jaccard_edges(spark):
    rows = [(5, "a b c d e"), (5, "a b c d e"), (7, "A b c d e"), (9, None), (10, ""), (None, "a b c d e"), (None, "q"), (11, "x y")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_components(df).collect()), key=str)
    assert got == sorted([(5, 2, 5), (5, 2, 5), (7, 2, 5), (9, 0, 9), (10, 0, 10), (None, 2, 5), (None, 1, None), (11, 1, 11)], key=str)
    kept = sorted(str(r.doc_id) for r in jaccard.one_of_each(df).collect())
    assert kept == sorted(map(str, [5, 9, 10, None, None, 11]))
    assert jaccard.near_components(df.limit(0)).collect() == []


def test_subset_sizes_cover_every_link():
    for n in range(1, 25):
        for m in range(1, 25):
            for common in range(0, min(n, m) + 1):
                if 100 * common >= 85 * (n + m - common) and not n == m == common:
                    assert jaccard.overlap(n, m) <= common
                    assert jaccard.overlap(n, m) in jaccard.subset_sizes(n, 25)
    assert jaccard.choose_boundary({}) >= 0
