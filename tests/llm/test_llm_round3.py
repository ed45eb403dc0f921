"""Merkle manifest, packing and runs against plain versions."""

import hashlib
import random
import re
import zlib
from itertools import groupby

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenloom.llm import merkle, packing, runs
from tokenloom.llm.words import Words, strings

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, rank string, row string, ids string, block string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, len(t or ""), "c", "c", "c", "c") for i, t, lang, s in rows], SCHEMA)


# ---- op11 ------------------------------------------------------------------

def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(i, s, lang, n, t):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, s, lang, n, t)])


def plain_tree(nodes):
    """Root, and each node's proof: levels of (siblings before, siblings after)."""
    paths, owners = [[] for _ in nodes], [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        up, own = [], []
        for lo in range(0, len(nodes), 3):
            run = nodes[lo:lo + 3]
            for k in range(len(run)):
                for o in owners[lo + k]:
                    paths[o].append((run[:k], run[k + 1:]))
            up.append(H(*run))
            own.append([o for k in range(len(run)) for o in owners[lo + k]])
        nodes, owners = up, own
    return nodes[0], paths


def plain_audit(rows):
    leaves = [(i, t, lang, s, plain_leaf(i, s, lang, len(t or ""), t)) for i, t, lang, s in rows]
    key = lambda r: (r[3] is not None, (r[3] or "").encode())
    ordered = sorted(leaves, key=lambda r: (*key(r), r[0] is not None, r[0] or 0, r[4]))
    groups = [list(g) for _, g in groupby(ordered, key=key)]
    trees = [plain_tree([r[4] for r in g]) for g in groups]
    root, top = plain_tree([t[0] for t in trees])
    out = []
    for k, g in enumerate(groups):
        for (i, t, lang, s, own), path in zip(g, trees[k][1]):
            whole = path + top[k]
            even = i is not None and zlib.crc32(str(i).encode()) % 2 == 0
            h = plain_leaf(i, s, lang, len(t or ""), t.replace("\n", "")) if even and t is not None else own
            for before, after in whole:
                h = H(*before, h, *after)
            out.append((i, own, trees[k][0], root, H(*[x for b, a in whole for x in b + a]), h, h == root))
    return out


def documents(n, sources, seed=0):
    r = random.Random(seed)
    rows = [(i, r.choice([None, "", "a\nb", "é漢\n" * r.randint(0, 5), f"t{i}"]), r.choice([None, "en"]),
             r.choice([None, "", *[f"s{k}é" for k in range(sources)]]) if i % 3 else "hot") for i in range(n)]
    return rows


@pytest.mark.parametrize("n, sources, levels", [(1, 1, 8), (400, 7, 2), (300, 60, 1)])
def test_audit_matches_plain_trees(spark, n, sources, levels):
    rows = documents(n, sources) + ([(5, "x", "en", "hot")] * 3 + [(None, "n\nn", None, None)] if n > 2 else [])
    got = sorted(map(tuple, merkle.audit(frame(spark, rows).repartition(3), levels).collect()), key=str)
    assert got == sorted(plain_audit(rows), key=str)
    if n > 2:
        assert any(r[6] for r in got) and not all(r[6] for r in got)


def test_manifest_records_and_empty_table(spark):
    rows = documents(50, 4)
    manifest = merkle.build(merkle.document_rows(frame(spark, rows)))
    store = {r.digest: r.children for r in manifest.records.collect()}
    assert all(H(*c) == d and 1 <= len(c) <= 3 for d, c in store.items())
    reached, level = set(), [manifest.root]
    while level:
        reached |= {d for d in level if d not in store}
        level = [c for d in level for c in store.get(d, [])]
    assert reached == {r[1] for r in plain_audit(rows)}
    asked = manifest.leaves.where("rank < 2").select("tree", "rank", F.struct("rank").alias("row"))
    asked = asked.union(spark.createDataFrame([(0, 10 ** 9, (1,)), (99, 0, (1,))], asked.schema))
    assert merkle.prove(manifest, asked).count() == manifest.leaves.where("rank < 2").count()
    empty = frame(spark, rows).limit(0)
    assert merkle.audit(empty).collect() == []


# ---- op12 ------------------------------------------------------------------

ODD = [None, "", " \n\t", "Hello, World!  it's 42 <|endoftext|>x <|startoftext|> don't", "Straße ΣΑΣ İx é a ́b c d\x1ce",
       "漢字かな " * 50, "x" * 5000, "w1 " * 9000, "̀ q﻿ 'S 'LL 'Ve", "a\x0bb\x0cc\rd"]


def library(text):
    import public_tokenizers
    from tokenizers import Tokenizer
    if not hasattr(library, "t"):
        library.t = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    return library.t.encode(text or "", add_special_tokens=False).ids + [1]


def texts(n, seed=1):
    r = random.Random(seed)
    words = ["the", "Of", "naïve", "x1y2", "don't", "漢字", "supercalifragilistic", "#!", "🙂🙂"]
    return [" ".join(r.choices(words, k=r.choice([1, 5, 40, 300, 900]))) for _ in range(n)]


@pytest.mark.parametrize("block, fan", [(8192, 16), (8, 2)])
def test_packing(spark, block, fan):
    rows = [(i % 97 if i % 5 else None, t, "en", "s") for i, t in enumerate(ODD + texts(400))]
    df = frame(spark, rows).repartition(4)
    packed = packing.pack_documents(df, with_ids=True, block=block, fan=fan).collect()
    want = sorted((i if i is not None else -1, k, a, ids[a:a + 4096]) for i, t, _, _ in rows for ids in [library(t)]
                  for k, a in enumerate(range(0, len(ids), 4096)))
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.piece, r.start, r.ids) for r in packed) == want
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.length == len(r.ids) for r in packed)
    bins = {}
    for r in packed:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    _, _, fills = packing.best_fit(sorted((len(w[3]) for w in want), reverse=True), 4096)
    least = -(-sum(len(w[3]) for w in want) // 4096)
    assert least <= len(bins) <= len(fills) + (2 if block > 100 else 0.12 * len(fills) + 2)


def test_best_fit_is_best_fit():
    r = random.Random(3)
    for _ in range(200):
        sizes = sorted((r.randint(1, 50) for _ in range(r.randint(0, 60))), reverse=True)
        bins, offsets, fills = packing.best_fit(sizes, 50)
        plain = []
        for s, b, at in zip(sizes, bins, offsets):
            fits = [f for f in plain if f + s <= 50]
            if fits:
                assert plain[b] == max(fits) == at
                plain[b] += s
            else:
                assert b == len(plain) and at == 0
                plain.append(s)
        assert plain == fills


def test_sequences_and_empty_table(spark):
    df = frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts(30))])
    packed = packing.pack_documents(df, with_ids=True, capacity=256)
    whole = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    assert all(whole[r.sequence_id][r.offset:r.offset + r.length] == r.ids for r in packed.collect())
    assert packing.pack_documents(df.limit(0)).collect() == []


def test_words_around_plain_ones():
    import public_tokenizers
    encoder = packing.WordEncoder(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read())
    r = random.Random(8)
    parts = ["'s", "'", "n't", "<", ">", "<|endoftext|>", "é", "É", "ÀÖØ", "×", "÷", "ß", "a", "THE", "the", "9", "%", "!!", "(", "_", "ª", "µ", "İ", "Σ", "'LL", "~", "@", "-", "|"]
    for _ in range(300):
        text = " ".join("".join(r.choices(parts, k=r.randint(1, 5))) for _ in range(20))
        assert [x.tolist() for x in encoder.texts(strings([text]))] == [library(text)[:-1]], text
    plain = sum(encoder.plain(x) is not None for x in ["the", "Thé,", "(the)", '"ÀÖØ"!!', "dogs'", "'s", "don't", "x9", "<b>", "×", "İx"])
    assert plain == 5


def test_long_text_in_stretches(monkeypatch):
    import public_tokenizers
    monkeypatch.setattr(packing, "STRETCH", 1000)
    text = " ".join(texts(20)) + "z" * 5000 + "\n\n tail"
    encoder = packing.WordEncoder(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read())
    monkeypatch.setattr(packing, "WORDS", 3)
    assert [x.tolist() for x in encoder.texts(strings([text]))] == [library(text)[:-1]]


# ---- op13 ------------------------------------------------------------------

def plain_runs(w, exponent=4, shortest=6):
    found = {}
    for q in range(1, len(w) // exponent + 1):
        k = 0
        while k + q < len(w):
            end = k
            while end + q < len(w) and w[end] == w[end + q]:
                end += 1
            length = end - k + q
            if end > k and length >= max(shortest, exponent * q) and (k, length) not in found:
                found[k, length] = q
            k = max(end, k + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def periodic(r, n, letters):
    out = []
    while len(out) < n:
        kind = r.random()
        if kind < 0.5:
            unit = [r.choice(letters) for _ in range(r.randint(1, 6))]
            out += unit * r.randint(1, 9) + unit[:r.randint(0, len(unit))]
        elif kind < 0.7 and out:
            lo = r.randrange(len(out))
            out += out[lo:lo + r.randint(1, 30)] * r.randint(1, 5)
        else:
            out += [r.choice(letters) for _ in range(r.randint(1, 10))]
    return out[:n]


def test_runs_match_plain_search():
    r = random.Random(11)
    lists = [periodic(r, r.randint(0, 150), "ab"[:r.randint(1, 2)] if k % 3 else "abcdefgh") for k in range(500)]
    lists += [["a"] * 3000, (["a"] * 40 + ["b"]) * 30, (["x", "y"] * 700) + ["x"]]
    column = strings([" ".join(w) for w in lists])
    batch = Words(column)
    for w, got in zip(lists, runs.find_runs(batch.hashes(), batch.rows)):
        assert got == plain_runs(w), w


def plain_report(i, text):
    w = words(text)
    h = zlib.crc32(str(i).encode()) if i is not None else 1
    if h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[k] if k < a else w[a + (k - a) % p] for k in range(len(w))]
    found = sorted(plain_runs(w), key=lambda x: (x[0], x[2]))
    drop = {k for s, n, q in found for k in range(s + q, s + n)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    best = max(found, key=lambda x: (x[1] / x[2], -x[0], -x[2])) if found else None
    tail = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (i, len(found), *tail, sha("".join("%d,%d,%d\n" % x for x in found)), sha(" ".join(x for k, x in enumerate(w) if k not in drop)))


def test_report_and_collapse(spark):
    r = random.Random(5)
    rows = [(i, t, "en", "s") for i, t in enumerate([None, "", " \n", "é漢 " * 20, "one two"] * 3 + [" ".join(periodic(r, r.randint(1, 200), "abcd")) for _ in range(200)])]
    rows += [(None, "z " * 9, "en", "s"), (9000, "a b " * 12, "en", "s"), (9000, "a b " * 12, "en", "s")]
    df = frame(spark, rows).repartition(4)
    assert sorted(map(tuple, runs.report(df, plant=True).collect()), key=str) == sorted((plain_report(i, t) for i, t, _, _ in rows), key=str)
    out = runs.collapse(df)
    assert out.columns == df.columns
    by = {r.doc_id: r for r in out.where("doc_id < 5").collect()}
    assert by[0].text is None and by[4].text == "one two" and by[3].text == "é漢" and by[3].row == "c"
    assert {tuple(r.runs[0]) for r in runs.find(df).where("row.doc_id = 9000").collect()} == {(0, 24, 2)}
    assert runs.report(df.limit(0)).collect() == [] and runs.collapse(df.limit(0)).collect() == []
