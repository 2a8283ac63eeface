"""Near duplicates, repeated passages and decontamination against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cityzones.llm import decontaminate, graph, hashing, minhash, suffixes


def words(rng, n):
    return [rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi pi rho".split())
            + str(rng.randrange(40)) for _ in range(n)]


def corpus(seed=1):
    """Families of near copies around the threshold, exact copies, short and odd texts."""
    rng, texts = random.Random(seed), []
    for _ in range(14):
        base = words(rng, rng.randrange(20, 120))
        for _ in range(rng.randrange(1, 9)):
            w = list(base)
            for _ in range(rng.randrange(0, 5)):
                w[rng.randrange(len(w))] = "edited" + str(rng.randrange(99))
            texts.append(" ".join(w))
        texts.append("\n\t".join(base).upper())
    texts += [None, "", "  \n", "one", "ONE", "a b c d", "a b c d", "a b c d e", "a b c d e", "é É"]
    return [(i * 3 - 20, t) for i, t in enumerate(texts)]


def brute_near(rows):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    low = {i: k for i, (k, _) in enumerate(rows)}
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                group[find(i)] = find(j)
    least = {}
    for i in range(len(rows)):
        least[find(i)] = min(least.get(find(i), low[i]), low[i])
    return sorted((k, len(sets[i]), least[find(i)], k == least[find(i)]) for i, (k, _) in enumerate(rows))


def test_near_duplicates_equal_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("digest", F.lit("clash"))
    got = sorted(tuple(r) for r in minhash.near_duplicates(df).collect())
    assert got == brute_near(rows)


def test_near_duplicates_repeats_nulls_and_empty(spark):
    t = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(5, t), (5, t), (None, t), (None, "other words"), (3, None)], "doc_id long, text string")
    got = sorted(minhash.near_duplicates(df).collect(), key=str)
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in got), key=str) == sorted(
        [(5, 5, True), (5, 5, True), (None, 5, False), (None, None, True), (3, 3, True)], key=str)
    assert sorted((r.doc_id is None, r.text) for r in minhash.without_near_duplicates(df).collect() if r.text) == [
        (False, t), (True, "other words"), (True, t)][:2] + [(True, t)]
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_estimate_is_near_the_true_similarity(spark):
    rng = np.random.default_rng(0)
    pairs = []
    for j in (0.2, 0.5, 0.75, 0.9):
        both = rng.integers(0, 2**63, int(2000 * j), dtype=np.uint64)
        rest = rng.integers(0, 2**63, 2000 - len(both), dtype=np.uint64)
        a, b = np.concatenate([both, rest[::2]]), np.concatenate([both, rest[1::2]])
        packed, _ = minhash.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        pairs.append((float(j), packed[0].tolist(), packed[1].tolist()))
    df = spark.createDataFrame(pairs, "j double, a array<long>, b array<long>")
    for r in df.select("j", minhash.estimate(F.col("a"), F.col("b")).alias("e")).collect():
        assert abs(r.j - r.e) < 0.2


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201), (201, 200)]
    got = dict(graph.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect())
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}
    assert graph.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_shingles_of_a_batch_do_not_depend_on_the_batch():
    texts = [b"a b c d e f", b"", b" x ", b"A B C D E F", b"a b c d e g " * 40]
    whole, first = hashing.shingles(texts)
    for i, t in enumerate(texts):
        alone, _ = hashing.shingles([t])
        assert np.array_equal(alone, whole[first[i]:first[i + 1]])
    assert np.array_equal(whole[:2], whole[first[3]:first[4]]) and first[2] == first[1]


def brute_repeats(rows, depth):
    rows = [(2**63 - 1 if k is None else k, (t or "").encode()) for k, t in rows]
    least = {}
    for k, b in rows:
        for i in range(len(b) - depth + 1):
            least[b[i:i + depth]] = min(least.get(b[i:i + depth], k), k)
    out = []
    for k, b in rows:
        gone = bytearray(len(b))
        for i in range(len(b) - depth + 1):
            if least[b[i:i + depth]] < k:
                gone[i:i + depth] = b"\1" * depth
        spans = [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(gone))]
        out.append((k, len(b), spans, bytes(c for c, g in zip(b, gone) if not g)))
    return sorted(out)


@pytest.mark.parametrize("depth,block_bytes", [(50, 4_000_000), (50, 3_000), (20, 2_000), (9, 700)])
def test_removed_passages_equal_brute_force(spark, depth, block_bytes):
    rng = random.Random(depth + block_bytes)
    shared = [" ".join(words(rng, 12)) for _ in range(6)] + ["a" * 130, "ab" * 60, "é🙂" * 30]
    rows = []
    for i in range(60):
        parts = [rng.choice([rng.choice(shared), " ".join(words(rng, rng.randrange(1, 12)))]) for _ in range(rng.randrange(5))]
        rows.append((rng.randrange(40) if i % 7 else None, rng.choice(["", " "]).join(parts) if i % 11 else None))
    rows.append(rows[3])
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("block", F.lit("clash"))
    got = sorted((2**63 - 1 if r.doc_id is None else r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept))
                 for r in suffixes.remove_repeats(df, depth, block_bytes=block_bytes).collect())
    assert got == brute_repeats(rows, depth)


def test_removed_passages_of_an_empty_table(spark):
    assert suffixes.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert [tuple(r) for r in suffixes.remove_repeats(spark.createDataFrame([(1, None)], "doc_id long, text string")).collect()] \
        == [(1, 0, [], b"")]


@pytest.mark.parametrize("depth,block_bytes", [(50, 4_000_000), (50, 2_500), (11, 900)])
def test_texts_that_repeat_themselves_equal_brute_force(spark, depth, block_bytes):
    rng = random.Random(depth * block_bytes)
    sentences = [" ".join(words(rng, 9)) for _ in range(3)]
    rows = [(rng.randrange(30) if i % 9 else None,
             "".join(rng.choice([*sentences, "=" * rng.randrange(90), "ab" * rng.randrange(50), "x"])
                     for _ in range(rng.randrange(9)))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((2**63 - 1 if r.doc_id is None else r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept))
                 for r in suffixes.remove_repeats(df, depth, block_bytes=block_bytes).collect())
    assert got == brute_repeats(rows, depth)


def test_texts_are_hashed_in_two_passes_only(monkeypatch):
    import pandas as pd
    a, b, c, d = ("".join(chr(97 + (i * i + k) % 26 + i // 50 % 7) for i in range(200)) for k in range(4))
    blocks = [pd.DataFrame({"block": k, "doc_id": ids, "text": texts}) for k, ids, texts in
              [(0, [1, 5], [a + "-" + b + "-" + b, "=" * 300 + c]), (1, [3, 2], ["+" + b + d + "=" * 70 + d, c])]]

    def by(column, frames):
        return dict(list(pd.concat(frames).groupby(column)))

    shared = by("block", [suffixes._shared_digits(g) for g in
                          by("bucket", [suffixes._first_digits(50, 64)(f) for f in blocks]).values()])
    runs = by("bucket", [suffixes._runs_left(50, 64)(f, shared[k]) for k, f in enumerate(blocks)])
    answers = by("block", [suffixes._smaller_elsewhere(50)(g) for g in runs.values()])

    def hashed(*_):
        raise AssertionError("hashed again")

    monkeypatch.setattr(suffixes, "prefix_sums", hashed)
    out = pd.concat([suffixes._cut(50)(f, answers[k]) for k, f in enumerate(blocks)])
    got = sorted((k, n, [tuple(s.values()) for s in spans], kept) for k, n, spans, kept in out.itertuples(index=False))
    rows = [row for f in blocks for row in f[["doc_id", "text"]].itertuples(index=False, name=None)]
    assert got == brute_repeats(rows, 50)
    assert any(spans for _, _, spans, _ in got)


def test_tiles_give_the_same_runs(monkeypatch):
    import pandas as pd
    rng = random.Random(9)
    frame = pd.DataFrame({"doc_id": range(30), "text": [" ".join(words(rng, rng.randrange(60))) for _ in range(30)]})

    def windows():
        b = suffixes.Block(frame, 50)
        return [(int(k), s + i) for k, s, n in zip(b.key, b.start.tolist(), b.count.tolist()) for i in range(n)]

    whole = windows()
    monkeypatch.setattr(suffixes, "TILE", 777)
    assert windows() == whole


def edit_distance_inside(fragment, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(fragment, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def edited(rng, text, n):
    t = list(text)
    for _ in range(n):
        p, kind = rng.randrange(len(t)), rng.randrange(3)
        if kind == 0:
            t[p] = rng.choice("qxz")
        elif kind == 1:
            t.insert(p, rng.choice("qxz"))
        else:
            del t[p]
    return "".join(t)


def normal(text):
    return re.sub(r"[\W_]+", " ", text.lower()).strip()


def test_leaks_equal_brute_force_alignment():
    rng = random.Random(5)
    items = [" ".join(words(rng, n)) for n in (5, 8, 14, 14, 30, 60)] + ["too short", "", "É é. " * 20]
    index = decontaminate.Index.build(list(range(len(items))), items)
    docs = []
    for n in range(120):
        i = rng.randrange(len(items) - 3)
        leak = edited(rng, items[i], rng.randrange(0, 9))
        parts = [" ".join(words(rng, 25)), leak.upper() if n % 3 else leak.replace(" ", " -- "), " ".join(words(rng, 25))]
        docs.append("\n".join(parts) if n % 5 else parts[0])
    docs += [None, "", items[-1], items[0] * 3]
    got = {(r[0], r[1]) for r in decontaminate.search(index, list(range(len(docs))), docs)}
    want = set()
    for d, text in enumerate(docs):
        plain = normal(text or "")
        for b, m, k, i in zip(index.begin, index.length, index.budget, index.item):
            fragment = "".join(map(chr, index.codes[b:b + m]))
            if edit_distance_inside(fragment, plain) <= k:
                want.add((d, int(i)))
    assert got == want and len(want) > 60


def test_leak_spans_are_code_points_of_the_text():
    item = " ".join(words(random.Random(2), 30))
    text = "Ünïcode 🙂 before, " + item.upper() + "! After."
    index = decontaminate.Index.build([9], [item])
    (row,) = decontaminate.search(index, [4], [text])
    assert row[:2] == (4, 9) and text[row[2]:row[3]] == item.upper() and row[4] == 0 and row[5] == row[6]


def test_leak_queries_in_blocks(spark, monkeypatch):
    rng = random.Random(8)
    items = [(i, " ".join(words(rng, 20))) for i in range(8)] + [(50, None), (None, "x")]
    docs = [(i, " ".join(words(rng, 30)) + " " + t) for i, t in items[:5]] + [(77, None), (None, items[2][1]), (78, "")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    b = spark.createDataFrame(items, "item_id long, text string")
    one = sorted(map(tuple, decontaminate.find_leaks(d, b).collect()), key=str)
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 300)
    assert len(list(decontaminate.blocks(b))) > 2
    assert sorted(map(tuple, decontaminate.find_leaks(d, b).collect()), key=str) == one
    assert sorted(str(r[0]) + "/" + str(r[1]) for r in one) == ["0/0", "1/1", "2/2", "3/3", "4/4", "None/2"]
    assert sorted(r.doc_id for r in decontaminate.remove_leaks(d, b).collect()) == [77, 78]
    assert decontaminate.find_leaks(d, b.limit(0)).count() == 0 and decontaminate.remove_leaks(d.limit(0), b).count() == 0
