"""Personal data: the rules against the plain expressions, the field on spellings that they miss."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import time

import numpy as np
import pytest

from tallyloom.llm import pii, queries

SCHEMA = "doc_id bigint, text string, kind string, start int, base string"

# The rules as they are stated, tried at every position.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(d) <= 19 and sum(int(x) if k % 2 == 0 else sum(map(int, str(2 * int(x)))) for k, x in enumerate(reversed(d))) % 10 == 0):
                continue
            if kind == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def card(rng):
    body = "4" + "".join(rng.choice("0123456789") for _ in range(14))
    return next(body + c for c in "0123456789" if pii.luhn(body + c))


def made(kind, rng):
    if kind == "email":
        return f"{rng.choice(['ana', 'bo.li', 'é.q', 'x_y'])}{rng.randrange(99)}@mail{rng.randrange(9)}.example.{rng.choice(['com', 'org'])}"
    if kind == "ip":
        return ".".join(str(rng.randrange(256)) for _ in range(4))
    return card(rng) if kind == "card" else f"+1 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}"


def sentence(rng, middle):
    words = "the of onan thtion. Edin une, lele ñaí".split()
    return " ".join([*rng.choices(words, k=rng.randrange(1, 8)), middle, *rng.choices(words, k=rng.randrange(1, 8))])


def corpus(n=400, seed=2):
    rng = random.Random(seed)
    rows = [(i, sentence(rng, made(pii.KINDS[i % 4], rng)), "k", 1, None) for i in range(n)]
    rows += [(n + i, sentence(rng, "".join(rng.choice("123456789") for _ in range(rng.choice([8, 9, 16])))), None, None, None) for i in range(n // 3)]
    return rows


def test_rules_equal_the_plain_expressions():
    rng = random.Random(9)
    alphabet = ["1", "22", "255", "256", ".", ".", "@", "a", "b-c", "+", "+1", " ", "-", "(", ")", "é", "_", "%", "4111 1111 1111 1111", "x@y.z", "\n", "٣"]
    for _ in range(6000):
        text = "".join(rng.choices(alphabet, k=rng.randrange(1, 25)))
        assert pii.base_spans(text) == brute(text), text
    for text in map("".join, itertools.product("1.@a+ ", repeat=6)):
        assert pii.base_spans(text) == brute(text), text


@pytest.mark.parametrize("text", ["1" * 300_000, "a" * 300_000, "1." * 150_000, "a@" * 150_000, "+1((" * 75_000, "1 " * 150_000, "a.b@c" * 60_000, "at (at) " * 40_000, "12345678 / " * 30_000])
def test_very_long_texts_take_linear_time(text):
    began = time.process_time()
    base = pii.base_spans(text)
    pii.added_spans(text, base, np.zeros((4, pii.N_FEATURES)))
    assert time.process_time() - began < 20


def test_probabilities_equal_those_of_all_segmentations():
    text = "by 136 555-7479 or 40.1.2.3 ok"
    window = pii.Window(text, 0, len(text))
    rng = np.random.default_rng(1)
    weights = rng.standard_normal((4, pii.N_FEATURES)) / 4
    scores = window.scores(weights)
    labelled = [(i, j, k, row) for row, (i, j, _) in enumerate(window.segments) for k in range(4)]

    def ways(at):
        yield ()
        for x in labelled:
            if x[0] >= at:
                yield from ((x, *rest) for rest in ways(x[1]))

    every = list(ways(0))
    mass = np.array([np.exp(sum(scores[r, k] for *_, k, r in way)) for way in every])
    total, p = window.expected(scores)
    assert total == pytest.approx(np.log(mass.sum()))
    for i, j, k, row in labelled:
        assert p[row, k] == pytest.approx(mass[[any(x[2:] == (k, row) for x in way) for way in every]].sum() / mass.sum())
    best = every[int(mass.argmax())]
    assert window.best(weights, 0.0) == [(pii.KINDS[k], window.ends[i], window.ends[j]) for i, j, k, _ in best]


def test_held_out_spellings_are_added_and_other_numbers_are_not(spark):
    weights = pii.learn(spark.createDataFrame(corpus(), SCHEMA).select("doc_id", "text"))
    rng = random.Random(77)
    hit = wrong = 0
    for turn in range(300):
        kind = pii.KINDS[turn % 4]
        for spelled, right in pii.respelled(kind, made(kind, rng).replace("é", "e"), turn):
            text = sentence(rng, spelled)
            base = pii.base_spans(text)
            got = base + pii.added_spans(text, base, weights)
            at = text.index(spelled)
            if right:
                hit += any(k == kind and a <= at + 2 and b >= at + len(spelled) - 2 for k, a, b in got)
            else:
                wrong += bool(set(got) - set(base))
    clean = sum(bool(pii.added_spans(t, pii.base_spans(t), weights)) for t in (sentence(rng, "".join(rng.choice("123456789") for _ in range(16))) for _ in range(200)) if not pii.base_spans(t))
    assert hit >= 270 and wrong <= 15 and clean <= 4, (hit, wrong, clean)


def test_query_equals_brute_force(spark, tmp_path):
    rows = corpus(120) + [(900, None, None, None, None), (None, "a@b.co", None, None, None), (901, "", "", 0, ""), (900, "x " * 50_000 + "1.2.3.4", "", 0, "")] + corpus(4)[:3]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_semi_markov_pii(spark, str(tmp_path)).collect()
    want = []
    for key, text, *_ in rows:
        base = brute(text or "")
        told = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        want.append((key, *[sum(s[0] == k for s in base) for k in pii.KINDS], hashlib.sha256(told.encode()).hexdigest()))
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(want, key=str)
    by = {r.doc_id: r.spans for r in got}
    assert by[0].startswith("email:") and by[901] == ""
    for r in got:
        spans = [s.split(":") for s in r.spans.split(",") if s]
        assert spans == sorted(spans, key=lambda s: (pii.KINDS.index(s[0]), int(s[1])))


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op13_semi_markov_pii(spark, str(tmp_path)).count() == 0
