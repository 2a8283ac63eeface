"""Operators 11 to 13 against brute force, held-out labels, and awkward rows."""

import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from cityzones.llm import chat, decontaminate, html_blocks, importance, runs

SF = "/root/testdata/sf0.001"
WIDE = "id long, text string, copies int, _copy int, _nth int, _hash string, _row int, score int, rank int, weight int"


def wide(spark, rows):
    """A table of (id, text) with columns named like the operators' own."""
    return spark.createDataFrame([(k, t, 1, 2, 3, "x", 4, 5, 6, 7) for k, t in rows], WIDE)


LONG = "alpha beta gamma delta " * 230_000  # over 5 MB
AWKWARD = [(1, None), (2, ""), (None, "a b a b a b a b a b"), (3, " \t\n"), (4, "x" * 300_000), (5, LONG)] + [
    (6, "one two one two one two one two nine")] * 400


# 11: pages

@pytest.fixture(scope="module")
def pages():
    con = duckdb.connect()
    return [h for h, in con.execute(f"SELECT html FROM read_parquet('{SF[:-5]}0.01/pages.parquet') ORDER BY page_id").fetchall()]


def labelled(pages, layouts):
    out = []
    for i, page in enumerate(pages):
        marked = html_blocks.mark_articles(page)
        main = [t for t, b in html_blocks.leaf_blocks(marked) if b.label]
        out += [marked] + [html_blocks.dressed(main[:20], f"{i}:{k}") for k in range(layouts)]
    return out


@pytest.fixture(scope="module")
def model(pages):
    return html_blocks.train(labelled(pages[:80], 4))


def test_held_out_pages_in_known_and_drawn_layouts(pages, model):
    def agreement(held):
        good = n = 0
        for page in held:
            blocks = html_blocks.leaf_blocks(page)
            got = model.decode(html_blocks.block_features(blocks))
            good += sum(g == bool(b.label) for g, (_, b) in zip(got, blocks))
            n += len(blocks)
        return good / n

    assert agreement(labelled(pages[100:], 0)) > 0.999
    assert agreement(labelled(pages[100:180], 2)) > 0.97


def test_viterbi_finds_the_best_of_all_paths(model):
    draw = random.Random(3)
    names = sorted(model.weight)
    for _ in range(30):
        chain = [draw.sample(names, 3) for _ in range(draw.randint(1, 7))]

        def value(path):
            return model.first[path[0]] + sum(model.step[a][b] for a, b in zip(path, path[1:])) + sum(
                model.weight[n] for s, f in zip(path, chain) if s for n in f)

        paths = [[bool(m >> i & 1) for i in range(len(chain))] for m in range(2 ** len(chain))]
        assert value(model.decode(chain)) == pytest.approx(max(map(value, paths)))


def test_leaf_blocks_of_broken_markup():
    page = ("<!DOCTYPE html><title>no</title><style>p{}</style><script>var t='</p><p>no';</script>"
            "<div>a<b>b</div><p>one &amp; <i>two</i>\n three<br>four<p>five &lt;x&gt; &eacute;<!-- no <p>no</p> -->"
            "<ul><li>six<li><a href='a>b'>seven</a></ul></p></section>eight < 9 <p")
    assert [t for t, _ in html_blocks.leaf_blocks(page)] == [
        "ab", "one & two three four", "five <x> é", "six", "seven", "eight < 9"]
    assert html_blocks.leaf_blocks("") == [] and html_blocks.leaf_blocks("plain &amp; text")[0][0] == "plain & text"
    deep = "<div>" * 20_000 + "x" + "</div>" * 20_000
    assert [t for t, _ in html_blocks.leaf_blocks(deep)] == ["x"]


def test_extract_awkward_pages(spark, model):
    article = "<nav><ul><li><a href=x>menu</a></ul></nav><article><h1>A head</h1><p>Some words here.</p></article>"
    long = "<article>" + "<p>Many words are in here now.</p>" * 150_000 + "</article>"
    df = wide(spark, [(1, None), (2, ""), (3, article), (3, article), (None, article), (5, long)])
    out = html_blocks.extract(df, model, "text", "text").select("id", "text", "rank").collect()
    want = "A head\nSome words here."
    got = [(r.id, r.text) for r in out]
    assert got[:5] == [(1, ""), (2, ""), (3, want), (3, want), (None, want)] and got[5][1].count("\n") == 149_999
    assert html_blocks.extract(df.limit(0), html_blocks.train([]), "text").count() == 0
    assert html_blocks.main_text(article, html_blocks.train([])) == ""  # nothing learned: nothing is main text


# 12: importance resampling

def brute_resample(docs, target, percent=5):
    def features(text):
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
        return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]

    rows = [(k, *features(t)) for k, t in docs]
    s = np.bincount([b for _, _, f in rows for b in f], minlength=10000).tolist()
    t = np.bincount([b for x in target for b in features(x)[1]], minlength=10000).tolist()
    S, T = sum(s), sum(t)
    out = []
    for k, n, f in rows:
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in f)
        h = int(hashlib.sha256(f"42:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        out.append((k, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    drawn = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is not None, r[0]))
    drawn = drawn[:percent * len(drawn) // 100]
    return out, drawn


@pytest.mark.parametrize("chunk", [1, 2_000_000])
def test_resampling_equals_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(importance, "CHUNK_BYTES", chunk)
    draw = random.Random(5)
    vocabulary = ["Ab", "b2", "été", "日本", "İx", "q" * 40] + [f"w{i}" for i in range(40)]
    docs = [(k, draw.choice(["", " ", "-"]).join(draw.choice([" ", "  ", "\n", "_", "'"]) + draw.choice(vocabulary)
                                               for _ in range(draw.randint(0, 60)))) for k in range(150)]
    docs += [(200, None), (201, ""), (None, docs[7][1]), *[docs[3]] * 20]
    target = [t for _, t in docs[:10]] + [None, "", "entirely new words"]
    out = importance.resample(wide(spark, docs), spark.createDataFrame([(t,) for t in target], "text string"),
                              id_col="id", percent=30).collect()
    rows, drawn = brute_resample(docs, target, 30)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r)[:5] for r in out), key=key) == sorted(rows, key=key)
    assert [tuple(r)[:5] for r in sorted((r for r in out if r["rank"]), key=lambda r: r["rank"])] == drawn
    assert sorted(r["rank"] for r in out if r["rank"]) == list(range(1, len(drawn) + 1))


def test_composed_crc_of_any_length():
    draw = random.Random(1)
    for n in (1, 7, 8, 255, 256, 70_000):
        a, b = draw.randbytes(9), draw.randbytes(n)
        got = importance.appended(np.array([zlib.crc32(a)], np.uint32), np.array([zlib.crc32(b)], np.uint32), np.array([n]))
        assert int(got[0]) == zlib.crc32(a + b)


def test_resampling_awkward_rows(spark):
    target = spark.createDataFrame([], "text string")
    out = importance.resample(wide(spark, AWKWARD), target, id_col="id").collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == len(AWKWARD) and by[1].n_features == by[2].weight == by[3].n_features == 0
    assert by[4].n_features == 1 and by[5].n_words == 920_000
    assert importance.resample(wide(spark, []), target, id_col="id").collect() == []


# 13: runs

def brute_runs(words):
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                if not any(p < q and s <= i and s + m >= j + q for s, m, p in out):
                    out.append((i, j + q - i, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def awkward_words(draw):
    kind, letters = draw.randrange(4), "abc"[:draw.randint(1, 3)]
    if kind == 0:
        return [draw.choice(letters) for _ in range(draw.randint(0, 70))]
    if kind == 1:  # runs in runs
        inner = ["a", "b"] * draw.randint(1, 6) + [draw.choice("abc")]
        return inner * draw.randint(1, 6) + [draw.choice(letters) for _ in range(5)]
    if kind == 2:
        a, b = ["a"], ["a", "b"]
        for _ in range(draw.randint(2, 7)):
            a, b = b, b + a
        return b
    return [w for _ in range(draw.randint(1, 5)) for w in [draw.choice(letters)] * draw.randint(1, 12)]


def test_runs_equal_brute_force(spark):
    draw = random.Random(11)
    texts = [awkward_words(draw) for _ in range(500)]
    df = spark.createDataFrame([(i, " \n".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in runs.periodic_runs(df).collect():
        words, want = texts[r.doc_id], brute_runs(texts[r.doc_id])
        assert [tuple(x) for x in r.runs] == want, words
        gone = {i for s, n, q in want for i in range(s + q, s + n)}
        assert bytes(r.kept).decode() == " ".join(w for i, w in enumerate(words) if i not in gone)


def test_lyndon_lengths_equal_their_definition():
    draw = random.Random(2)
    for _ in range(300):
        s = [draw.randrange(3) for _ in range(draw.randint(1, 25))]
        want = [max(n for n in range(1, len(s) - i + 1) if all(s[i:i + n] < s[i + k:i + n] for k in range(1, n)))
                for i in range(len(s))]
        assert runs.lyndon_lengths(s) == want


def test_runs_of_awkward_rows(spark):
    out = runs.periodic_runs(wide(spark, AWKWARD), id_col="id").collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == len(AWKWARD) and by[1].n_words == by[2].n_words == by[3].n_words == 0 and by[4].runs == []
    assert [tuple(x) for x in by[None].runs] == [(0, 10, 2)] and bytes(by[None].kept) == b"a b"
    assert [tuple(x) for x in by[5].runs] == [(0, 920_000, 4)] and bytes(by[6].kept) == b"one two nine"
    assert runs.periodic_runs(wide(spark, []), id_col="id").collect() == []


# 1 and 2: items below the bound, lists with holes

def test_short_items_are_found_as_whole_words(spark):
    items = [(1, "Yes"), (2, "the cat sat"), (3, "what is seven and six"), (4, "yes!"), (5, ""), (6, None), (7, "???")]
    docs = [(1, "yes, it is"), (2, "eyes yesterday"), (3, "So THE  cat, sat."), (4, "breathe cat satin"),
            (5, "the cat"), (6, "sat the cat"), (7, "sat"), (8, None), (None, "what is seven and six"), (10, "yes")]
    found = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                                     spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 1), (1, 4), (3, 2), (None, 3), (10, 1), (10, 4)}
    by = {(r.doc_id, r.item_id): r for r in found}
    assert (by[3, 2].start, by[3, 2].end, by[3, 2].edits) == (3, 16, 0)
    kept = decontaminate.remove_leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                                      spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == [2, 4, 5, 6, 7, 8]


@pytest.mark.parametrize("hole", [0, 1, 2, None])
@pytest.mark.parametrize("field", ["role", "content"])
def test_a_list_may_lack_fields_anywhere(spark, hole, field):
    import json
    turns = [{"role": r, "content": t} for r, t in (("user", "a"), ("assistant", "b"), ("user", "c"))]
    for i, t in enumerate(turns):
        if hole in (i, None):
            del t[field]
    df = spark.createDataFrame([(1, json.dumps({"messages": turns, "extra": 1}))], "id int, record string")
    got = sorted((r.turn, r.role, r.text, r.layout) for r in chat.canonical_turns(df, "id", "record").collect())
    assert got == [(i, t.get("role"), t.get("content"), "messages") for i, t in enumerate(turns)]


def test_an_empty_list_is_a_conversation_without_turns(spark):
    df = spark.createDataFrame([(1, '{"messages": []}'), (2, '{"conversations": []}'), (3, "[]")], "id int, record string")
    got = sorted(tuple(r) for r in chat.canonical_turns(df, "id", "record").select("id", "turn", "layout").collect())
    assert got == [(1, None, "messages"), (2, None, "conversations"), (3, None, None)]
