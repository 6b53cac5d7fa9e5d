"""Tool calls of conversations linked with their results.

Calls and results meet in a hash join on (conversation, identifier). A call whose
arguments name the result of another call ("$<identifier>" as a value) comes after that
call; levels are found round by round, each round taking the calls whose needs are all
met. Arguments are validated against the tool's schema and written as canonical JSON:
sorted keys, no spaces, numbers in shortest form, characters as they are.

One row per call and per result, so that no conversation has to fit one task; sorted by
(conv_id, level, turn, kind, call_id) the rows are a topological order.

Rows: arguments that are null, no JSON, or no object are invalid and kept as text in
``payload``; an unknown tool has no schema and is invalid. Of calls with one identifier
the first by (turn, arguments) is the call and the others are ``duplicate``. A result
whose identifier no call has is ``orphan``; all results of a call are linked with it. A
call in a cycle, or after one, has no level and is ``cyclic``. A reference to a call
that isn't there is no need, and marks the call ``dangling``. Null identifiers match
nothing. Empty tables give no rows. Columns not named here are not read.
"""

from __future__ import annotations

import json
import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tallyloom.llm.common import written

CHECKED = StructType([
    StructField("payload", StringType()), StructField("error", StringType()), StructField("needs", ArrayType(StringType())),
])
TYPES = {
    "string": lambda v: isinstance(v, str), "boolean": lambda v: isinstance(v, bool), "null": lambda v: v is None,
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool) or isinstance(v, float) and v.is_integer(),
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "array": lambda v: isinstance(v, list), "object": lambda v: isinstance(v, dict),
}


def violation(value, schema: dict, at: str = "$") -> str | None:
    """The first way in which a value breaks its schema, in order of the keys; None if it keeps it.

    Knows type (one or several), enum, minimum, maximum, minLength, maxLength, items,
    properties, required and additionalProperties.
    """
    kinds = schema.get("type")
    if kinds and not any(TYPES[k](value) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return f"{at}: type"
    if "enum" in schema and canonical(value) not in map(canonical, schema["enum"]):  # true is not 1
        return f"{at}: enum"
    if TYPES["number"](value) and not schema.get("minimum", -math.inf) <= value <= schema.get("maximum", math.inf):
        return f"{at}: range"
    if isinstance(value, str) and not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", math.inf):
        return f"{at}: length"
    if isinstance(value, list) and "items" in schema:
        return next((e for i, v in enumerate(value) if (e := violation(v, schema["items"], f"{at}[{i}]"))), None)
    if isinstance(value, dict):
        known = schema.get("properties", {})
        if missing := sorted(set(schema.get("required", ())) - set(value)):
            return f"{at}.{missing[0]}: required"
        for key in sorted(value):
            if key in known:
                if error := violation(value[key], known[key], f"{at}.{key}"):
                    return error
            elif schema.get("additionalProperties", True) is False:
                return f"{at}.{key}: unknown"
    return None


def canonical(value) -> str:
    def plain(v):
        if isinstance(v, float) and v.is_integer() and abs(v) < 2**53:
            return int(v)
        if isinstance(v, dict):
            return {k: plain(x) for k, x in v.items()}
        return [plain(x) for x in v] if isinstance(v, list) else v

    return json.dumps(plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def _references(value) -> list[str]:
    if isinstance(value, str):
        return [value[1:]] if value.startswith("$") and len(value) > 1 else []
    inner = value.values() if isinstance(value, dict) else value if isinstance(value, list) else ()
    return [r for v in inner for r in _references(v)]


def _no_constant(name: str):
    raise ValueError(name)


class RepeatedKey(ValueError):
    """An object that names a key twice: readers don't agree on what it means."""


def _object(pairs: list[tuple]) -> dict:
    made = dict(pairs)
    if len(made) < len(pairs):
        raise RepeatedKey
    return made


def check_arguments(name: str | None, raw: str | None, schemas: dict) -> tuple[str | None, str | None, list[str]]:
    """(canonical arguments or the raw text, error, identifiers that the arguments name)."""
    try:
        value = json.loads(raw or "", parse_constant=_no_constant, object_pairs_hook=_object)
    except RepeatedKey:
        return raw, "$: repeated key", []
    except (ValueError, RecursionError):
        return raw, "$: no JSON", []
    if not isinstance(value, dict):
        return raw, "$: no object", []
    try:
        text = canonical(value)
        text.encode()  # lone surrogates can't be written
    except (ValueError, RecursionError):
        return raw, "$: no JSON", []
    error = violation(value, schemas[name]) if name in schemas else "$: unknown tool"
    return text, error, sorted(set(_references(value)))


def _levels(calls: DataFrame, needs: DataFrame) -> DataFrame:
    """conv_id, call_id, level: the longest way down to a call without needs; none for calls that need a cycle.

    Calls with one need form chains. Pointers along them double, so a chain of any length takes
    a number of rounds that grows with its logarithm; the calls with several needs, joined by
    whole chains, are then taken in topological order, a round per layer of them.
    """
    keys = ["conv_id", "call_id"]
    several = written(needs.groupBy(*keys).agg(F.count("*").alias("of")), "needs-of")
    chain = needs.join(several.filter("of = 1").select(*keys), keys, "left_semi")
    chain = written(chain.select(*keys, F.col("need").alias("at"), F.lit(1).cast("bigint").alias("steps")), "chain")
    for _ in range(chain.count().bit_length() + 1):
        on = chain.select("conv_id", F.col("call_id").alias("at"), F.col("at").alias("further"), F.col("steps").alias("more"))
        if chain.join(on, ["conv_id", "at"], "left_semi").isEmpty():
            break
        chain = written(chain.join(on, ["conv_id", "at"], "left").select(
            *keys, F.coalesce("further", "at").alias("at"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
        ), "chain")
    inner = chain.select("conv_id", F.col("call_id").alias("at"))
    ends = written(chain.join(inner, ["conv_id", "at"], "left_anti"), "chain-ends")  # what is left out goes round in a circle
    over = ends.select("conv_id", F.col("call_id").alias("need"), "at", "steps")
    waiting = written(needs.join(several.filter("of > 1"), keys).join(over, ["conv_id", "need"], "left").select(
        *keys, "of", F.coalesce("at", "need").alias("at"), F.coalesce("steps", F.lit(0)).alias("steps"),
    ), "waiting")
    known = written(calls.join(needs.select(*keys), keys, "left_anti").withColumn("level", F.lit(0).cast("bigint")), "levels")
    while True:
        there = known.select("conv_id", F.col("call_id").alias("at"), "level")
        ready = waiting.join(there, ["conv_id", "at"]).groupBy(*keys, "of").agg(F.count("*").alias("n"), F.max(F.col("level") + F.col("steps") + 1).alias("level"))
        fresh = written(ready.filter("n = of").select(*keys, "level"), "level")
        if fresh.isEmpty():
            break
        known = written(known.unionAll(fresh), "levels")
        waiting = written(waiting.join(fresh.select(*keys), keys, "left_anti"), "waiting")
    below = known.select("conv_id", F.col("call_id").alias("at"), "level")
    chained = ends.join(below, ["conv_id", "at"]).select(*keys, (F.col("level") + F.col("steps")).alias("level"))
    return written(known.unionAll(chained).select(*keys, F.col("level").cast("int").alias("level")), "levels")


def link(calls: DataFrame, results: DataFrame, schemas: dict) -> DataFrame:
    """conv_id, turn, call_id, kind (call or result), level, status, error, payload.

    calls: conv_id, turn, call_id, name, arguments (JSON text). results: conv_id, turn, call_id, content.
    A linked result has the level of its call.
    """

    @F.pandas_udf(CHECKED)
    def checked(name: pd.Series, raw: pd.Series) -> pd.DataFrame:
        rows = [check_arguments(n, r, schemas) for n, r in zip(name, raw)]
        return pd.DataFrame(rows, columns=["payload", "error", "needs"])

    first = W.partitionBy("conv_id", "call_id").orderBy("turn", "arguments", "name")
    own = calls.select("conv_id", "turn", "call_id", "name", "arguments").withColumn(
        "copy", F.when(F.col("call_id").isNull() | F.col("conv_id").isNull(), 1).otherwise(F.row_number().over(first)),
    )
    own = own.withColumn("c", checked("name", "arguments")).select(
        "conv_id", "turn", "call_id", "name", "copy", "c.payload", "c.error", "c.needs",
    )
    own = written(own, "calls")
    real = own.filter("copy = 1 AND conv_id IS NOT NULL AND call_id IS NOT NULL")
    named = real.select("conv_id", "call_id", F.explode("needs").alias("need"))
    there = real.select("conv_id", F.col("call_id").alias("need"))
    needs = written(named.join(there, ["conv_id", "need"], "left_semi"), "needs")
    dangling = named.join(there, ["conv_id", "need"], "left_anti").select("conv_id", "call_id").distinct().withColumn("dangling", F.lit(True))

    keys = ["conv_id", "call_id"]
    levels = _levels(real.select(*keys), needs)
    placed = own.join(levels, keys, "left").join(dangling, keys, "left")
    answered = results.select("conv_id", "call_id").distinct().withColumn("answered", F.lit(True))
    status = (
        F.when(F.col("copy") > 1, "duplicate").when(F.col("error").isNotNull(), "invalid")
        .when(F.col("level").isNull() & F.col("call_id").isNotNull() & F.col("conv_id").isNotNull(), "cyclic")
        .when(F.col("dangling"), "dangling").when(F.col("answered"), "linked").otherwise("open")
    )
    out_calls = placed.join(answered, keys, "left").select(
        "conv_id", "turn", "call_id", F.lit("call").alias("kind"), "level", status.alias("status"), "error",
        F.when(F.col("error").isNull(), F.concat(
            F.lit('{"arguments":'), "payload", F.lit(',"id":'), _json("call_id"), F.lit(',"name":'), _json("name"), F.lit("}"),
        )).otherwise(F.col("payload")).alias("payload"),
    )
    owners = real.select(*keys).join(levels, keys, "left").withColumn("known", F.lit(True))
    out_results = results.select("conv_id", "turn", "call_id", "content").join(owners, keys, "left").select(
        "conv_id", "turn", "call_id", F.lit("result").alias("kind"), "level",
        F.when(F.col("known"), "linked").otherwise("orphan").alias("status"), F.lit(None).cast("string").alias("error"),
        F.concat(F.lit('{"content":'), _json("content"), F.lit(',"id":'), _json("call_id"), F.lit("}")).alias("payload"),
    )
    return out_calls.unionAll(out_results)


@F.pandas_udf(StringType())
def _json_text(value: pd.Series) -> pd.Series:
    return pd.Series([json.dumps(v, ensure_ascii=False) for v in value], dtype=object)


def _json(column: str):
    return _json_text(F.col(column).cast("string"))
