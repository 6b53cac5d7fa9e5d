"""Quality classifier by co-training: a view of the text and a view of the page's metadata.

Each document gets two feature vectors: ``content`` (word shapes, hashed words, how
words repeat) and ``meta`` (source, language, sizes, line and character statistics).
One logistic model per view is fitted; over rounds each model labels the unlabelled
documents that it is sure of, and the other view learns from them. A held-out part
of the labels calibrates both and weighs them against each other; every document is
then scored by the combination.

Fitting reads at most ``most_labelled`` labelled and ``most_pseudo`` pseudo-labelled
rows per class and round, chosen by a hash of the id; scoring covers every document.

Rows: a null text counts as empty. A null source or language is a value of its own.
Labels that are null are left out, and so are documents labelled both ways equally
often. Without labels of both classes nothing can be learned: all scores are 0.5 and
every document is kept. Repeated rows get equal scores.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import give_back, tidy, written

SHAPES, WORDS, LANGS, SOURCES = 128, 256, 16, 64
_CLASS = bytes(
    97 if 97 <= b <= 122 or b >= 128 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b for b in range(256)
)
_RUN = re.compile(rb"(aa+|AA+|00+)")
FEATURES = "doc_id bigint, content binary, meta binary"


def content_features(raw: bytes) -> np.ndarray:
    """Shape and word frequencies of a text, and how its words repeat."""
    words = raw.split()
    n = max(1, len(words))
    out = np.zeros(SHAPES + WORDS + 6, np.float32)
    shapes = Counter(_RUN.sub(lambda m: m[0][:1], raw.translate(_CLASS)).split())
    for shape, c in shapes.items():
        out[xxhash.xxh32_intdigest(shape) % SHAPES] += c
    seen = Counter(words)
    for word, c in seen.items():
        out[SHAPES + xxhash.xxh32_intdigest(word) % WORDS] += c
    out[: SHAPES + WORDS] = np.sqrt(out[: SHAPES + WORDS] / n)
    out[SHAPES + WORDS :] = (
        len(seen) / n, max(seen.values(), default=0) / n, sum(a == b for a, b in zip(words, words[1:])) / n,
        math.sqrt(len(seen)) / math.sqrt(n), len(shapes) / n, n < 5,
    )
    return out


def meta_features(raw: bytes, lang: str | None, source: str | None) -> np.ndarray:
    """Where a page comes from, how long it is, and what its lines and characters look like."""
    out = np.zeros(LANGS + SOURCES + 14, np.float32)
    out[xxhash.xxh32_intdigest(repr(lang)) % LANGS] = 1
    out[LANGS + xxhash.xxh32_intdigest(repr(source)) % SOURCES] = 1
    lines = raw.split(b"\n")
    kinds = np.bincount(np.frombuffer(raw.translate(_CLASS), np.uint8), minlength=128) if raw else np.zeros(128)
    size, words = max(1, len(raw)), len(raw.split())
    letters, capitals, digits = kinds[97], kinds[65], kinds[48]
    spaces = kinds[[9, 10, 11, 12, 13, 32]].sum()
    ends = kinds[[44, 46]].sum()
    marks = size - letters - capitals - digits - spaces - ends
    out[LANGS + SOURCES :] = (
        math.log1p(len(raw)), math.log1p(words), math.log1p(len(lines)), math.log1p(words / len(lines)),
        size / max(1, words) / 10, len(set(lines)) / len(lines), capitals / size * 5, digits / size * 5, spaces / size * 5,
        ends / max(1, words) * 5, marks / size * 5, math.sqrt(marks / size), math.sqrt(capitals / size), kinds[124] / max(1, words) * 5,
    )
    return out


def _featurize(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        raws = [r or b"" for r in part.raw]
        yield pd.DataFrame({
            "doc_id": part.doc_id,
            "content": [content_features(r).astype(np.float16).tobytes() for r in raws],
            "meta": [meta_features(r, a, b).astype(np.float16).tobytes() for r, a, b in zip(raws, part.lang, part.source)],
        })


def features(docs: DataFrame) -> DataFrame:
    """doc_id and both views of every document, written once."""
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("raw"), "lang", "source")
    # ids travel as text: a null would turn the whole column into floats
    keyed = narrow.withColumn("doc_id", F.col("doc_id").cast("string"))
    made = keyed.mapInPandas(tidy(_featurize), FEATURES.replace("doc_id bigint", "doc_id string"))
    return written(made.withColumn("doc_id", F.col("doc_id").cast("bigint")), "features")


@dataclass
class Logistic:
    """Weights over raw features; the constant is last."""

    weights: np.ndarray

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 12) -> Logistic:
    """Ridge logistic regression by Newton steps on standardised features."""
    mean = x.mean(axis=0, dtype=np.float64)
    chunks = [slice(at, at + 1024) for at in range(0, len(x), 1024)]  # the driver holds the rows once more, no further copies
    scale = np.sqrt(sum(((x[c] - mean) ** 2).sum(axis=0) for c in chunks) / len(x))
    keep = scale > 1e-6
    z = np.ones((len(x), int(keep.sum()) + 1))
    for c in chunks:
        z[c, :-1] = (x[c][:, keep] - mean[keep]) / scale[keep]
    w, penalty = np.zeros(z.shape[1]), np.full(z.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (p - y) + penalty * w
        curve = np.diag(penalty)
        for c in chunks:
            curve += (z[c] * (p[c] * (1 - p[c]) + 1e-6)[:, None]).T @ z[c]
        move = np.linalg.solve(curve, slope)
        w -= move
        if np.abs(move).max() < 1e-6:
            break
    out = np.zeros(x.shape[1] + 1)
    out[:-1][keep] = w[:-1] / scale[keep]
    out[-1] = w[-1] - (w[:-1] * mean[keep] / scale[keep]).sum()
    return Logistic(out)


def _matrix(column) -> np.ndarray:
    return np.stack([np.frombuffer(b, np.float16) for b in column]).astype(np.float32)


def _scores(views: dict[str, Logistic]):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for at in range(0, len(part), 2048):
                p = part.iloc[at : at + 2048]
                yield pd.DataFrame({"doc_id": p.doc_id, **{v: m.logit(_matrix(p[v])) for v, m in views.items()}})

    return run


def scored(table: DataFrame, views: dict[str, Logistic]) -> DataFrame:
    """doc_id and the logit of each view."""
    keyed = table.withColumn("doc_id", F.col("doc_id").cast("string"))
    out = keyed.mapInPandas(tidy(_scores(views)), "doc_id string, content double, meta double")
    return out.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def _first(df: DataFrame, rows: int) -> DataFrame:
    """At most so many rows of a narrow frame, the first by a hash of the id, as a small frame."""
    first = df.filter("doc_id IS NOT NULL").orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id").limit(rows).collect()
    return F.broadcast(df.sparkSession.createDataFrame([tuple(r) for r in first], df.schema))


def classify(
    docs: DataFrame, labels: DataFrame, label: str = "quality", rounds: int = 2, sure: float = 0.98,
    most_labelled: int = 12_000, most_pseudo: int = 2_000, hold_out: int = 5, threshold: float = 0.5,
) -> DataFrame:
    """doc_id, content_score, meta_score, quality_score in [0, 1], held_out (label kept out of the fit) and kept.

    Every ``hold_out``-th labelled document by hash is kept out of the fits; these rows calibrate the two views.
    """
    truth = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
    truth = truth.agg(F.avg(F.col(label).cast("double")).alias("y")).filter("y <> 0.5").select("doc_id", (F.col("y") > 0.5).cast("int").alias("y"))
    truth = truth.withColumn("out", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(hold_out)) == 0)
    table = features(docs)
    # features are only joined with small frames, so that they are never shuffled
    known = table.select("doc_id").distinct().join(truth, "doc_id")
    views = ("content", "meta")
    rows = [_first(known.filter(F.col("y") == y), most_labelled // 2) for y in (0, 1)]
    seen = table.join(F.broadcast(rows[0].unionAll(rows[1])), "doc_id").dropDuplicates(["doc_id"]).select("y", "out", *views).toPandas()
    learn, check = seen[~seen.out], seen[seen.out]
    if set(learn.y) != {0, 1}:
        half = F.lit(0.5)
        return table.select(
            "doc_id", half.alias("content_score"), half.alias("meta_score"), half.alias("quality_score"),
            F.lit(False).alias("held_out"), F.lit(True).alias("kept"),
        )
    x = {v: _matrix(learn[v]) for v in views}
    y = {v: learn.y.to_numpy() for v in views}
    models = {v: fit(x[v], y[v]) for v in views}
    edge = math.log(sure / (1 - sure))
    for _ in range(rounds):
        logits = written(scored(table, models).join(truth.select("doc_id"), "doc_id", "left_anti"), "logits")
        for teacher, pupil in (("content", "meta"), ("meta", "content")):
            for value, sign in ((0, -1), (1, 1)):
                sure_ones = logits.filter(F.col(teacher) * sign > edge).select("doc_id").distinct()
                more = table.join(_first(sure_ones, most_pseudo), "doc_id").dropDuplicates(["doc_id"]).select(pupil).toPandas()
                x[pupil] = np.vstack([x[pupil], _matrix(more[pupil])]) if len(more) else x[pupil]
                y[pupil] = np.concatenate([y[pupil], np.full(len(more), value)])
        models = {v: fit(x[v], y[v]) for v in views}
        x = {v: x[v][: len(learn)] for v in views}  # the next round teaches anew
        y = {v: y[v][: len(learn)] for v in views}
    judge = check if set(check.y) == {0, 1} else learn
    marks = {v: models[v].logit(_matrix(judge[v])) for v in views}
    single = {v: fit(marks[v][:, None], judge.y.to_numpy()) for v in views}
    both = fit(np.column_stack([marks[v] for v in views]), judge.y.to_numpy())
    del x, y, seen, learn, check, judge, marks
    give_back()
    sigmoid = lambda c: 1 / (1 + F.exp(-c))
    line = lambda w, *cs: sum((F.col(c) * float(a) for c, a in zip(cs, w)), F.lit(float(w[-1])))
    out = scored(table, models).join(truth.filter("out").select("doc_id", F.lit(True).alias("told")), "doc_id", "left")
    return out.select(
        "doc_id", sigmoid(line(single["content"].weights, "content")).alias("content_score"),
        sigmoid(line(single["meta"].weights, "meta")).alias("meta_score"),
        sigmoid(line(both.weights, *views)).alias("quality_score"), F.coalesce("told", F.lit(False)).alias("held_out"),
    ).withColumn("kept", F.col("quality_score") >= threshold)
