"""Near-duplicate documents and lines against brute force, and their edge rows."""

from __future__ import annotations

import os
import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tallyloom.llm import common, lines, minhash
from tallyloom.llm.common import components
from tallyloom.sources.staging import shared_folder

DOCS = "doc_id bigint, text string, signature string, content int, id int"


def smallest(nodes, links):
    top = {n: n for n in nodes}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def word_sets(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def changed(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    out = []
    for group in range(6):
        base = [f"g{group}x{rng.randrange(400)}" for _ in range(rng.randrange(60, 150))]
        out += [changed(rng, base, rng.randrange(0, 9)) for _ in range(25)]
    out += ["", None, "  \n\t", "one two", "ONE  two", "one two three", "a b c d e", "long " * 40_000, "x " * 39_999 + "X"]
    rng.shuffle(out)
    return out


def test_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert found == smallest(nodes, edges)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("percent", [85, 80])
def test_near_duplicates_equal_brute_force(spark, texts, percent):
    sets = [word_sets(t) for t in texts]
    links = [
        (i, j) for i in range(len(sets)) for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    want = smallest(range(len(texts)), links)
    docs = spark.createDataFrame([(i, t, "s", 1, 2) for i, t in enumerate(texts)], DOCS)
    got = {r.doc_id: r for r in minhash.near_duplicates(docs, percent=percent).collect()}
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(got[i].n_shingles == len(s) and got[i].kept == (want[i] == i) for i, s in enumerate(sets))


def test_few_edges_are_not_shuffled_for_joins(spark, monkeypatch):
    edges = [(k, k + 1) for k in range(0, 60, 1) if k % 7] + [(100, k) for k in range(101, 130)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    plans = []

    def noted(table, label):
        plans.append(table._jdf.queryExecution().executedPlan().toString())
        return written(table, label)

    written = common.written
    monkeypatch.setattr(common, "written", noted)
    few = sorted(map(tuple, components(df).collect()))
    assert all("SortMergeJoin" not in p and "BroadcastHashJoin" in p for p in plans[1:])
    monkeypatch.setattr(common, "FEW_EDGES", -1)
    assert sorted(map(tuple, components(df).collect())) == few


def test_search_leaves_only_what_its_result_reads(spark):
    folder = shared_folder(spark)
    labels = lambda: Counter(f.rsplit("-", 1)[0] for f in (os.listdir(folder) if os.path.exists(folder) else []))
    text = "\n".join(f"line number {k} of a text that several pages hold, word by word" for k in range(4))
    docs = spark.createDataFrame([(k, text + f"\nown line of page {k}") for k in range(6)] + [(9, "another text")], "doc_id bigint, text string")
    before = labels()
    found = minhash.near_duplicates(docs, percent=50)
    assert found.filter("NOT kept").count() == 5
    assert set(labels() - before) == {"signatures", "members", "edges"}
    before = labels()
    assert lines.without_repeated_lines(docs).count() == 7
    assert set(labels() - before) == {"held-lines", "copy-groups"}


def test_near_duplicates_odd_rows(spark):
    rows = [(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (3, "u v w x y z"), (7, "u v w x y z"), (9, None), (None, None)]
    out = minhash.near_duplicates(spark.createDataFrame([(*r, None, None, None) for r in rows], DOCS)).collect()
    assert len(out) == len(rows)
    assert {(r.doc_id, r.component_id, r.kept) for r in out} == {(None, None, True), (7, 3, False), (3, 3, True), (9, 9, True)}
    assert minhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_bayes_floor_keeps_true_pairs():
    rows, bands = minhash.plan_bands(0.85, 1e-6)
    assert (1 - 0.85**rows) ** bands <= 1e-6 and rows * bands <= 128
    floor = minhash.least_matches(rows * bands, 24, 0.85, 1e-6)
    assert list(floor.values()) == sorted(floor.values()) and floor[rows * bands] < 0.85 * rows * bands


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (x != y))
    return row[-1]


@settings(max_examples=400, deadline=None)
@given(st.binary(max_size=12), st.binary(max_size=12), st.integers(0, 4))
def test_banded_distance(a, b, edits):
    a, b = bytes(x % 3 for x in a), bytes(x % 3 for x in b)
    want = plain_distance(a, b)
    assert lines.distance_within(a, b, edits) == (want if want <= edits else None)
    assert bin((lines.sketch(a) ^ lines.sketch(b)) & (2**64 - 1)).count("1") <= 4 * want
    if want <= edits:  # the segments find every such pair
        short, long = sorted((a, b), key=len)
        cut = lines.segments(len(short), edits)
        assert any(short[cut[i][0] : sum(cut[i])] == long[at : at + size] for i, at, size in lines.probes(len(long), len(short), edits))


@pytest.mark.parametrize("edits", [1, 2])
def test_lines_equal_brute_force(spark, edits):
    rng = random.Random(edits)
    base = ["".join(rng.choices("abcdé ", k=rng.randrange(5, 60))) for _ in range(30)]

    def slip(line):
        for _ in range(rng.randrange(0, 4)):
            at = rng.randrange(len(line) + 1)
            line = rng.choice([line[:at] + "z" + line[at:], line[:at] + line[at + 1 :], line[:at] + "y" + line[at + 1 :]])
        return line

    docs = [(i, "\n".join(slip(rng.choice(base)) for _ in range(rng.randrange(0, 8)))) for i in range(60)] + [(60, None), (61, ""), (62, " \n\t\n")]
    held = defaultdict(list)
    for i, t in docs:
        for k, line in enumerate(t.split("\n") if t is not None else ()):
            if line.strip(" \t\n\v\f\r"):
                held[line.encode()].append((i, k))
    names, least = sorted(held), 16 * edits
    links = [
        (min(held[a]), min(held[b])) for x, a in enumerate(names) for b in names[:x]
        if min(len(a), len(b)) >= least and plain_distance(a, b) <= edits
    ]
    top = smallest([min(v) for v in held.values()], links)
    n_links = defaultdict(int)
    for a, b in links:
        n_links[a] += 1
        n_links[b] += 1
    out = lines.near_duplicate_lines(spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id bigint, text string, h1 string, line int"), edits).collect()
    assert len(out) == sum(t.count("\n") + 1 for _, t in docs if t is not None)
    by_place = {(r.doc_id, r.line_no): r for r in out}
    for places in held.values():
        for p in places:
            r = by_place[p]
            assert (r.class_doc, r.class_line) == top[min(places)] and r.n_links == n_links[min(places)] and r.first == (top[min(places)] == p)
    assert by_place[(62, 0)].class_doc is None and by_place[(62, 0)].first


def test_lines_of_odd_tables(spark):
    kind = "doc_id bigint, text string"
    assert lines.near_duplicate_lines(spark.createDataFrame([], kind)).count() == 0
    rows = [(None, "same line of some length\nx"), (None, "same line of some length?\nx"), (1, "same line of some length"), (1, "same line of some length")]
    out = lines.near_duplicate_lines(spark.createDataFrame(rows, kind)).filter("line_no = 0").collect()
    assert sorted(r.n_links for r in out) == [1, 1, 1, 1] and len({(r.class_doc, r.class_line) for r in out}) == 1


def test_repeated_lines_go_and_copies_stay_whole(spark):
    banner = "subscribe to our newsletter for daily updates"
    own = lambda i, n: "\n".join(f"document {i} sentence {k} says {i * 7919 + k * 104729} things and more of it" for k in range(n))
    docs = [(i, f"{banner}{'.' * (i % 2)}\n{own(i, 12)}") for i in range(5)] + [(10 + i, own(99, 6)) for i in range(4)] + [(20, "a\nb\na\nb\nc"), (21, None), (None, f"{banner}\nz")]
    df = spark.createDataFrame([(i, t, len(t or "")) for i, t in docs], "doc_id bigint, text string, n_chars bigint")
    out = {r.doc_id: r for r in lines.without_repeated_lines(df).collect()}
    assert len(out) == len(docs) and out[0].text == docs[0][1]
    assert all(out[i].text == own(i, 12) and out[i].n_chars == len(own(i, 12)) for i in range(1, 5))
    assert all(out[10 + i].text == own(99, 6) for i in range(4))
    assert out[20].text == "a\nb\nc" and out[21].text is None and out[None].text.startswith(banner)
    assert lines.without_repeated_lines(df.filter(F.lit(False))).count() == 0


def test_rows_of_one_id_keep_their_lines(spark):
    own = lambda i, n: "\n".join(f"record {i} part {k} holds {i * 6151 + k * 92821} of its own words" for k in range(n))
    docs = [(1, own(1, 6)), (1, own(1, 6)), (2, f"a\nb\n{own(2, 5)}"), (2, f"{own(3, 2)}\nb\nc\nb\n{own(4, 4)}"), (3, "x\ny\nx\nz"), (3, "x\ny\nx\nz")]
    out = lines.without_repeated_lines(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    want = docs[:3] + [(2, f"{own(3, 2)}\nb\nc\n{own(4, 4)}")] + 2 * [(3, "x\ny\nz")]
    assert sorted(map(tuple, out)) == sorted(want)


@pytest.mark.parametrize("part", [25, 50])
def test_shared_passages_go_from_pages_and_copies(spark, part):
    own = lambda i, n: "\n".join(f"page {i} part {k} tells {i * 6151 + k * 92821} on its own" for k in range(n))
    passage = own(99, part // 5)
    docs = [(i, f"{passage}\n{own(i, 20 - part // 5)}") for i in range(5)]
    docs += [(5, docs[4][1]), (6, f"{docs[4][1]}\n{own(6, 1)}")]  # copies of a page lose it with the page
    out = dict(map(tuple, lines.without_repeated_lines(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()))
    assert out[0] == docs[0][1] and all(out[i] == own(i, 20 - part // 5) for i in range(1, 5))
    assert out[5] == out[4] and out[6] == f"{out[4]}\n{own(6, 1)}"


def test_long_lines_go_from_the_second_holder_on(spark):
    own = lambda i, n: "\n".join(f"sheet {i} part {k} says {i * 6151 + k * 92821} by itself" for k in range(n))
    long, short = (" ".join(f"{x}{k * 7919}" for k in range(n)) for x, n in (("v", 50), ("w", 49)))
    docs = [(i, f"{own(i, 20)}\n{long}{'.' * i}\n{short}\n{own(9 + i, 20)}") for i in range(2)]
    out = dict(map(tuple, lines.without_repeated_lines(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()))
    assert out == {0: docs[0][1], 1: f"{own(1, 20)}\n{short}\n{own(10, 20)}"}
