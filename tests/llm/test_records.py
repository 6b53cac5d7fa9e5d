"""Tool calls, the quality classifier, and the pipeline."""

from __future__ import annotations

import json
import random

import corpus_pipeline
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tallyloom.llm import lines, minhash, mixing, quality, tools
from tallyloom.llm.common import with_text_ids, word_count, written

SF = "/root/testdata/sf0.001"
SCHEMAS = {"add": {
    "type": "object", "required": ["x"], "additionalProperties": False,
    "properties": {"x": {"type": ["number", "string"], "minimum": 0, "maximum": 9}, "tags": {"type": "array", "items": {"enum": ["p", "q"]}}, "n": {"type": "integer"}},
}}


@pytest.mark.parametrize(("raw", "error"), [
    ('{"x": 1}', None), ('{"x": "$c1"}', None), ('{"x": 10}', "$.x: range"), ('{"x": true}', "$.x: type"), ("{}", "$.x: required"),
    ('{"x": 1, "y": 2}', "$.y: unknown"), ('{"x": 1, "tags": ["p", "r"]}', "$.tags[1]: enum"), ('{"x": 1, "n": 2.0}', None), ('{"x": 1, "n": 2.5}', "$.n: type"),
    (None, "$: no JSON"), ("[1]", "$: no object"), ('{"x": NaN}', "$: no JSON"), ("{" * 5000, "$: no JSON"), ('{"x": "\\ud800"}', "$: no JSON"),
])
def test_arguments_are_validated(raw, error):
    assert tools.check_arguments("add", raw, SCHEMAS)[1] == error


@settings(max_examples=100, deadline=None)
@given(st.recursive(st.none() | st.booleans() | st.integers() | st.text(st.characters(codec="utf-8")), lambda x: st.lists(x) | st.dictionaries(st.text(st.characters(codec="utf-8")), x), max_leaves=12))
def test_canonical_json_is_a_fixpoint(value):
    text = tools.canonical(value)
    assert tools.canonical(json.loads(text)) == text and json.loads(text) == value


def test_calls_meet_results_in_order(spark):
    ref = lambda *ids: json.dumps({"x": "$" + ids[0]} if len(ids) == 1 else {"x": [f"${i}" for i in ids]})
    calls = [
        (1, 1, "a", "add", '{"x": 1.0}'), (1, 2, "b", "add", ref("a")), (1, 3, "c", "add", ref("b")), (1, 4, "a", "add", '{"x": 2}'),
        (1, 5, "p", "add", ref("q")), (1, 6, "q", "add", ref("p")), (1, 7, "r", "add", ref("p")), (1, 8, "s", "add", ref("gone")),
        (2, 1, "a", "none", '{"x": 1}'), (2, 2, None, "add", '{"x": 3}'), (None, 3, "z", "add", '{"x": 3}'), (2, 4, "m", "add", None), (2, 5, "t", "add", '{"x":"é/ "}'),
    ]
    results = [(1, 2, "a", "one"), (1, 3, "a", "again"), (1, 4, "c", None), (1, 9, "p", "late"), (2, 2, "b", "elsewhere"), (2, 3, None, "x"), (None, 4, "z", "y")]
    out = tools.link(
        spark.createDataFrame([(*c, 0) for c in calls], "conv_id bigint, turn int, call_id string, name string, arguments string, level int"),
        spark.createDataFrame([(*r, 0) for r in results], "conv_id bigint, turn int, call_id string, content string, known int"), SCHEMAS,
    ).collect()
    assert len(out) == len(calls) + len(results)
    got = {(r.kind, r.conv_id, r.turn): r for r in out}
    state = lambda kind, conv, turn: (got[kind, conv, turn].status, got[kind, conv, turn].level)
    assert [state("call", 1, t) for t in range(1, 9)] == [
        ("linked", 0), ("open", 1), ("linked", 2), ("duplicate", 0), ("cyclic", None), ("cyclic", None), ("cyclic", None), ("dangling", 0),
    ]
    assert [state("call", 2, t)[0] for t in (1, 2, 4, 5)] == ["invalid", "open", "invalid", "open"] and state("call", None, 3)[0] == "open"
    assert [state("result", 1, t) for t in (2, 3, 4, 9)] == [("linked", 0), ("linked", 0), ("linked", 2), ("linked", None)]
    assert {state("result", c, t)[0] for c, t in ((2, 2), (2, 3), (None, 4))} == {"orphan"}
    assert got["call", 1, 1].payload == '{"arguments":{"x":1},"id":"a","name":"add"}' and got["call", 2, 5].payload == '{"arguments":{"x":"é/ "},"id":"t","name":"add"}'
    empty = spark.createDataFrame([], "conv_id bigint, turn int, call_id string, name string, arguments string, content string")
    assert tools.link(empty, empty, SCHEMAS).count() == 0


@pytest.mark.parametrize("name, raw, want", [
    ("search", '{"query":"a","limit":1' + "0" * 400 + "}", "$.limit: range"),
    ("search", '{"query":"a","limit":' + "9" * 5000 + "}", "$: no JSON"),
    ("search", '{"query":"a","query":"b"}', "$: repeated key"),
    ("search", '{"query":"a","limit":2.0}', None),
    ("one", '{"n":true}', "$.n: enum"), ("one", '{"n":1.0}', None), ("one", '{"n":[1,{"a":2}]}', None),
])
def test_odd_arguments(name, raw, want):
    schemas = {
        "search": {"type": "object", "properties": {"query": {"type": "string"}, "limit": {"type": "integer", "maximum": 60}}},
        "one": {"type": "object", "properties": {"n": {"enum": [1, [1, {"a": 2}]]}}},
    }
    assert tools.check_arguments(name, raw, schemas)[1] == want


def test_levels_are_longest_ways(spark):
    """Long chains, chains that meet, circles, and calls that need a circle."""
    rng = random.Random(8)
    needs = {f"c{i}": [f"c{i - 1}"] for i in range(1, 120)}
    needs |= {f"m{i}": sorted({f"c{rng.randrange(120)}", *(f"m{rng.randrange(i)}" for _ in range(i and 2))}) for i in range(25)}
    needs |= {f"t{i}": [f"m{24 - i}"] for i in range(5)} | {"x0": ["x2"], "x1": ["x0"], "x2": ["x1"], "y0": ["x1"], "z0": ["y0", "c3"], "z1": ["z1"]}
    calls = sorted({"c0", *needs})
    level = {"c0": 0}
    for _ in calls:
        level |= {k: 1 + max(level[n] for n in v) for k, v in needs.items() if all(n in level for n in v)}
    got = tools._levels(
        spark.createDataFrame([(1, c) for c in calls], "conv_id bigint, call_id string"),
        spark.createDataFrame([(1, c, n) for c, v in needs.items() for n in v], "conv_id bigint, call_id string, need string"),
    ).collect()
    assert {r.call_id: r.level for r in got} == level and len(got) == len(level) and max(level.values()) >= 119


def test_quality_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    out = written(quality.classify(docs, labels), "verdicts")
    assert out.count() == docs.count()
    judged = out.filter("held_out").join(labels, "doc_id").agg(
        F.count("*").alias("n"), F.avg((F.col("kept") == (F.col("quality") == 1)).cast("int")).alias("right"),
        F.avg(((F.col("content_score") >= 0.5) == (F.col("quality") == 1)).cast("int")).alias("content"),
        F.avg(((F.col("meta_score") >= 0.5) == (F.col("quality") == 1)).cast("int")).alias("meta"),
    ).first()
    assert judged.n > 50 and judged.right >= 0.97 and judged.content >= 0.95 and judged.meta >= 0.9


def test_quality_of_odd_tables(spark):
    docs = spark.createDataFrame(
        [(1, None, None, None, 0.0), (2, "", "en", "s", 0.0), (2, "", "en", "s", 0.0), (None, "x y", "en", "s", 0.0), (3, "w " * 60_000, "en", "s", 0.0)],
        "doc_id bigint, text string, lang string, source string, content double",
    )
    labels = spark.createDataFrame([(1, None), (2, 1), (None, 0), (3, 0), (3, 1)], "doc_id bigint, quality int")
    out = quality.classify(docs, labels).collect()
    assert len(out) == 5 and all(r.kept and r.quality_score == 0.5 for r in out)
    both = quality.classify(docs, spark.createDataFrame([(1, 0), (2, 1)], "doc_id bigint, quality int")).collect()
    assert len(both) == 5 and all(0 <= r.quality_score <= 1 for r in both)
    assert quality.classify(docs.filter(F.lit(False)), labels).count() == 0


def test_pipeline_stages(spark):
    """Each stage does to its own input what its operator decides; nothing is lost on the way."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = docs.first()
    docs = written(docs.unionByName(spark.createDataFrame([
        (10**6, first.text, "en", "srcx", 1), (10**6 + 1, None, None, None, None), (None, "some words here to keep", "en", "src1", 3),
    ], docs.schema)), "raw")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(written(stage(spark, seen[-1], SF), "stage"))
    raw, good, cut, unique, mix, coded = seen
    assert all(d.columns == docs.columns for d in seen[:-1])
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    keyed = with_text_ids(raw, for_nulls=True)
    verdicts = quality.classify(keyed.select(F.col("key").alias("doc_id"), "doc.text", "doc.lang", "doc.source", "doc.n_chars"), labels)
    assert good.count() == raw.count() - verdicts.filter("NOT kept").select("doc_id").distinct().count() > 0
    assert good.join(labels, "doc_id").filter("quality = 0").count() <= 0.3 * labels.filter("quality = 0").count()  # a dozen labels
    assert sorted(map(str, cut.collect())) == sorted(map(str, lines.without_repeated_lines(good).collect()))
    verdict = {r.doc_id: r for r in minhash.near_duplicates(cut, percent=80).collect()}
    assert sorted(str(r.doc_id) for r in unique.collect()) == sorted({str(i) for i, r in verdict.items() if r.kept})
    assert {r.doc_id for r in unique.collect()} & {first.doc_id, 10**6} == {first.doc_id}
    plan = mixing.mix(unique.withColumn("n", word_count(F.col("text"))).withColumn("h", F.xxhash64("text")), "source", "n", ["doc_id", "h"])
    assert mix.select(F.sum(word_count(F.col("text")))).first()[0] == plan.agg(F.sum("taken")).first()[0]
    assert sorted((str(r.doc_id), r.text) for r in coded.collect()) == sorted((str(r.doc_id), r.text) for r in mix.collect())
    assert coded.filter("n_tokens <> size(tokens)").count() == 0
    assert corpus_pipeline.run(spark, SF).count() > 0


CLASHING = "doc_id bigint, text string, lang string, source string, n_chars bigint, doc string, key bigint, id int, content int, gone int, size int, hash int, turn int, row int, first int, __id int, __size int"


def clashing(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t), "d", 1, 2, 3, 4, 5, 6, 7, 8, 9, 0, 1) for i, t, s in rows], CLASHING)


def test_stages_on_clashing_names_and_texts_of_one_id(spark, tmp_path):
    """Own columns meet none of the stages' names; two texts of an id, repeated rows and rows without an id each get their due."""
    say = lambda n: " ".join(f"w{n * 1009 + k * 7919}" for k in range(60))
    rows = [(1, say(1), "a"), (2, say(1), "b"), (2, say(2), "b"), (3, say(3), "a"), (3, say(3), "a"), (None, say(4), None), (None, say(5), "a"), (4, None, "a"), (5, "", "a")]
    docs = clashing(spark, rows)
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    run = dict(corpus_pipeline.STAGES)
    told = lambda df: sorted(((r.doc_id, r.text, r.source) for r in df.collect()), key=str)
    for name in ("quality", "lines", "near_duplicates", "mix"):
        out = run[name](spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.select("doc", "key", "turn", "__size").distinct().collect() == [("d", 1, 7, 1)]
    assert told(run["quality"](spark, docs, str(tmp_path))) == sorted(rows, key=str)
    assert told(run["near_duplicates"](spark, docs, str(tmp_path))) == sorted([rows[0], rows[2], rows[3], *rows[5:]], key=str)
    mixed = run["mix"](spark, docs, str(tmp_path)).collect()
    assert {r.text for r in mixed} & {say(1), say(2)} and not {r.doc_id for r in mixed} & {4, 5}
    assert run["tokens"](spark, docs, str(tmp_path)).count() == len(rows)


def test_a_bad_text_takes_no_good_one_along(spark, monkeypatch):
    bad = lambda docs, labels: docs.select("doc_id", (~F.coalesce(F.col("text"), F.lit("")).contains("bad")).alias("kept"))
    monkeypatch.setattr(quality, "classify", bad)
    rows = [(1, "good one", "a"), (1, "bad one", "a"), (1, "bad one", "a"), (None, "bad two", "a"), (None, "good two", "a"), (2, "bad", None), (3, None, None)]
    out = corpus_pipeline.classify_quality(spark, clashing(spark, rows), SF).collect()
    assert sorted(((r.doc_id, r.text) for r in out), key=str) == sorted([(1, "good one"), (None, "good two"), (3, None)], key=str)


@pytest.mark.parametrize("stage", range(5))
def test_stages_of_empty_tables(spark, stage):
    name, run = corpus_pipeline.STAGES[stage]
    out = run(spark, clashing(spark, []), SF)
    assert out.count() == 0 and (name == "tokens" or out.columns == clashing(spark, []).columns)
