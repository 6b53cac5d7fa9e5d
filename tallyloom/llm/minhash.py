"""MinHash near-duplicates with sequential Bayesian verification.

Documents with equal shingle sets form a class; one representative per class gets a
signature. Representatives that share a band of their signatures are candidates. A
candidate pair is compared batch by batch: as soon as the posterior probability that
its similarity reaches the threshold falls below the chosen miss probability, it is
dropped; what survives all batches is verified on the full shingle sets.

A bucket's members are first compared with its centre, and linked ones are one
component. In buckets that still hold several components, pairs across components are
found by their rare shingles, so that no link is missed and no group is paired out;
they pass the same verification.

Rows: a null or empty text, or one without words, has no shingles and no links. A
text with fewer words than the shingle width is one shingle. Rows with one id are one
document with several texts. A row without id keeps a null component and is kept.
Equal similarities need no order: components don't depend on it. An empty table gives
no rows. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyloom.llm.common import components, discard, shingles_of, small, tidy, written

SIGNATURE = "doc_id bigint, content bigint, n_shingles bigint, digest binary, signature binary"


def plan_bands(similarity: float, miss: float, most: int = 128) -> tuple[int, int]:
    """(rows per band, bands): the widest band that at most so many hashes can carry at the miss probability."""
    for rows in range(12, 0, -1):
        bands = math.ceil(math.log(miss) / math.log1p(-(similarity**rows)))
        if rows * bands <= most:
            return rows, bands
    return 1, most


def least_matches(hashes: int, batch: int, similarity: float, miss: float) -> dict[int, int]:
    """After n compared hashes, the fewest matches whose posterior still allows the similarity.

    With a uniform prior the similarity after m of n matches is Beta(m + 1, n - m + 1), and it
    exceeds t with the probability that a binomial of n + 1 draws at t gives at most m.
    """
    out = {}
    steps = list(range(batch, hashes, batch)) + [hashes]
    for n in steps:
        below, m = 0.0, 0
        while m <= n:
            below += math.comb(n + 1, m) * similarity**m * (1 - similarity) ** (n + 1 - m)
            if below >= miss / len(steps):
                break
            m += 1
        out[n] = m
    return out


def _seeds(hashes: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20_240_229)
    both = draw.integers(1, 2**63, size=(2, hashes), dtype=np.uint64)
    return both[0], both[1] * np.uint64(2) + np.uint64(1)


def _sign(width: int, hashes: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        xor, odd = _seeds(hashes)
        for part in parts:
            sets = [shingles_of(raw, width) for raw in part.column("raw").to_pylist()]
            rows = np.zeros((len(sets), hashes), np.uint32)
            at = 0
            while at < len(sets):  # as many sets at once as fit the processor's cache
                end, total = at, 0
                while end < len(sets) and (end == at or total + len(sets[end]) <= 16_384):
                    total += len(sets[end])
                    end += 1
                full = [i for i in range(at, end) if len(sets[i])]
                if full:
                    x = np.concatenate([sets[i] for i in full])
                    starts = np.cumsum([0] + [len(sets[i]) for i in full[:-1]])
                    for h in range(hashes):
                        rows[full, h] = np.minimum.reduceat((x ^ xor[h]) * odd[h], starts) >> np.uint64(32)
                at = end
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), part.column("content"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array([r.tobytes() if len(s) else None for r, s in zip(rows, sets)], pa.binary()),
                ],
                names=["doc_id", "content", "n_shingles", "digest", "signature"],
            )

    return run


def _prune(hashes: int, batch: int, similarity: float, miss: float):
    floor = least_matches(hashes, batch, similarity, miss)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if not part.num_rows:
                continue
            left, right = (
                np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint32).reshape(-1, hashes) for c in ("sa", "sb")
            )
            alive, matches, done = np.arange(part.num_rows), np.zeros(part.num_rows, int), 0
            for n, least in floor.items():
                matches[alive] += (left[alive, done:n] == right[alive, done:n]).sum(axis=1)
                alive, done = alive[matches[alive] >= least], n
            yield part.select(["a", "ca", "b", "cb"]).take(pa.array(alive))

    return run


def _verify(width: int, percent: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = lru_cache(maxsize=64)(lambda raw: shingles_of(raw, width))
        for part in parts:
            good = []
            for i, (x, y) in enumerate(zip(part.column("xa").to_pylist(), part.column("xb").to_pylist())):
                x, y = sets(x), sets(y)
                if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    if 100 * both >= percent * (len(x) + len(y) - both):
                        good.append(i)
            yield part.select(["a", "b"]).take(pa.array(good, pa.int64()))

    return run


def _explode(width: int):
    """One row per shingle of each text."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at in range(0, part.num_rows, 256):
                rows = part.slice(at, 256)
                sets = [shingles_of(raw, width) for raw in rows.column("raw").to_pylist()]
                sizes = [len(s) for s in sets]
                own = pa.array(np.repeat(np.arange(len(sets)), sizes))
                columns = [rows.column(c).take(own) for c in ("id", "content", "component")]
                every = np.concatenate(sets) if sets else np.empty(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(np.repeat(np.array(sizes, np.int32), sizes)), pa.array(every.view(np.int64))],
                    names=["id", "content", "component", "n", "shingle"],
                )

    return run


class NearDuplicates:
    """Candidate search and verification over one table of documents."""

    def __init__(self, docs: DataFrame, width: int, percent: int, miss: float, batch: int):
        self.width, self.percent, self.miss, self.batch = width, percent, miss, batch
        self.similarity = percent / 100
        self.rows, self.bands = plan_bands(self.similarity, miss)
        self.hashes = self.rows * self.bands
        self.texts = docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("content"), F.col("text").cast("binary").alias("raw"),
        )
        self.signed = written(self.texts.mapInArrow(tidy(_sign(width, self.hashes)), SIGNATURE), "signatures")
        named = self.signed.filter("doc_id IS NOT NULL AND n_shingles > 0")
        classes = named.groupBy("digest").agg(F.min(F.struct("doc_id", "content")).alias("first"))
        self.member = written(
            named.select("doc_id", "content", "digest").join(classes, "digest").select("doc_id", "content", F.col("first.doc_id").alias("rep")).distinct(), "members",
        )
        first = classes.select(F.col("first.doc_id").alias("doc_id"), F.col("first.content").alias("content"))
        reps = named.join(first, ["doc_id", "content"], "left_semi").dropDuplicates(["doc_id", "content"])
        self.reps = written(reps.select("doc_id", "content", "n_shingles", "signature"), "representatives")
        size = 4 * self.rows
        keys = F.posexplode(F.array(*[F.substring("signature", 1 + k * size, size) for k in range(self.bands)])).alias("k", "part")
        banded = self.reps.select("doc_id", "content", "n_shingles", keys)
        banded = banded.select(F.xxhash64("k", "part").alias("bucket"), F.col("doc_id").alias("id"), "content", "n_shingles")
        shared = banded.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
        self.banded = written(banded.join(shared, "bucket"), "buckets")
        self.scratch = [self.reps, self.banded]  # read by the search alone

    def pairs_with_centre(self) -> DataFrame:
        """Each document with the centre of one of its buckets: the one it shares most buckets with.

        A bucket's centre is the member that meets most documents over all its buckets: in a
        group of copies with different changes, the one that the others were made from.
        """
        met = self.banded.groupBy("id", "content").agg(F.sum("n").alias("met"))
        centre = self.banded.join(met, ["id", "content"]).groupBy("bucket").agg(F.max(F.struct("met", "id", "content", "n_shingles")).alias("c"))
        star = self.banded.join(centre, "bucket").select("id", "content", "n_shingles", F.struct("c.id", "c.content", "c.n_shingles").alias("c"))
        star = star.filter("id <> c.id OR content <> c.content").filter(
            100 * F.least("c.n_shingles", "n_shingles") >= self.percent * F.greatest("c.n_shingles", "n_shingles")
        )
        shared = star.groupBy("id", "content", "c").agg(F.count("*").alias("n"))
        best = shared.groupBy("id", "content").agg(F.max(F.struct("n", "c")).alias("best")).select("id", "content", "best.c")
        return best.select(F.col("c.id").alias("a"), F.col("c.content").alias("ca"), F.col("id").alias("b"), F.col("content").alias("cb"))

    def pairs_across(self, component: DataFrame) -> DataFrame:
        """Pairs in different components that can still reach the threshold, among documents whose bucket holds several.

        A bucket of many different documents must not be paired out. Of two sets that reach the
        threshold, each has a shingle among its first |A| - ceil(t * |A|) + 1 in any common order
        that the other's first ones hold as well. In order of rarity these first shingles are
        mostly a document's own: those that only one document has come first and meet nothing.
        """
        named = self.banded.join(component, self.banded.id == component.node, "left").select(
            "bucket", "id", "content", F.coalesce("component", "id").alias("component"),
        )
        split = named.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y").select("bucket")
        open_ = small(written(named.join(split, "bucket", "left_semi").groupBy("id", "content").agg(F.min("component").alias("component")), "open"))
        texts = self.texts.join(open_, (F.col("doc_id") == F.col("id")) & (self.texts.content == open_.content)).select("id", open_.content, "component", "raw")
        texts = texts.dropDuplicates(["id", "content"])
        sets = written(texts.mapInArrow(tidy(_explode(self.width)), "id bigint, content bigint, component bigint, n int, shingle bigint"), "open-sets")
        common = sets.groupBy("shingle").agg(F.count("*").alias("df")).filter("df > 1")
        mine = W.partitionBy("id", "content")
        ranked = sets.join(common, "shingle").withColumn("place", F.row_number().over(mine.orderBy("df", "shingle"))).withColumn("common", F.count("*").over(mine))
        least = F.ceil(F.col("n") * self.percent / 100)
        own = F.col("n") - F.col("common")  # shingles that only this document has
        ranked = ranked.withColumn("at", F.col("place") + own).filter(F.col("at") <= F.col("n") - least + 1)
        first = written(ranked.select("id", "content", "component", "n", "at", "shingle"), "first-shingles")
        discard(sets)
        self.scratch += [open_, first]
        x, y = first.alias("x"), first.alias("y")
        # from the first shingle that both hold on, no more than the rest of either can be common
        pairs = x.join(y, F.expr(
            f"x.shingle = y.shingle AND x.component < y.component AND 100 * least(x.n, y.n) >= {self.percent} * greatest(x.n, y.n)"
            f" AND {100 + self.percent} * (1 + least(x.n - x.at, y.n - y.at)) >= {self.percent} * (x.n + y.n)"
        ))
        return pairs.select(
            F.col("x.id").alias("a"), F.col("x.content").alias("ca"), F.col("y.id").alias("b"), F.col("y.content").alias("cb"),
        ).distinct()

    @staticmethod
    def _ends(pairs: DataFrame) -> DataFrame:
        """The documents that pairs name; few of them filter signatures and texts before these are shuffled."""
        ends = pairs.select(F.col("a").alias("doc_id"), F.col("ca").alias("content")).unionAll(pairs.select("b", "cb"))
        return small(written(ends.distinct(), "ends"))

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that reach the threshold: pruned batch by batch, survivors verified on full sets."""
        pairs = written(pairs, "pairs")
        ends = self._ends(pairs)
        reps = self.reps.join(ends, ["doc_id", "content"], "left_semi")
        sign = lambda side: reps.select(
            F.col("doc_id").alias(side), F.col("content").alias(f"c{side}"), F.col("signature").alias(f"s{side}"),
        )
        signed = pairs.join(sign("a"), ["a", "ca"]).join(sign("b"), ["b", "cb"]).select("a", "ca", "b", "cb", "sa", "sb")
        alive = written(
            signed.mapInArrow(tidy(_prune(self.hashes, self.batch, self.similarity, self.miss)), "a bigint, ca bigint, b bigint, cb bigint"), "candidates",
        )
        alive_ends = self._ends(alive)
        texts = self.texts.join(alive_ends, ["doc_id", "content"], "left_semi").dropDuplicates(["doc_id", "content"])
        text = lambda side: texts.select(F.col("doc_id").alias(side), F.col("content").alias(f"c{side}"), F.col("raw").alias(f"x{side}"))
        both = alive.join(text("b"), ["b", "cb"]).join(text("a"), ["a", "ca"]).select("a", "b", "xa", "xb")
        found = written(both.mapInArrow(tidy(_verify(self.width, self.percent)), "a bigint, b bigint"), "links")
        for table in (pairs, ends, alive, alive_ends):
            discard(table)
        return found

    def close(self) -> None:
        """Delete what only the search reads; signatures and members stay for the result."""
        for table in self.scratch:
            discard(table)


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 85, miss: float = 1e-6, batch: int = 24) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document; linked at 100 * |A and B| >= percent * |A or B|."""
    search = NearDuplicates(docs, width, percent, miss, batch)
    several = search.member.groupBy("doc_id").agg(F.min("rep").alias("x"), F.max("rep").alias("y")).filter("x < y")
    same = search.member.join(several.select("doc_id"), "doc_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    direct = search.links(search.pairs_with_centre())
    sure = direct.unionAll(same)
    first = components(sure)
    early = written(first, "early")
    discard(first)
    more = search.links(search.pairs_across(early))
    search.scratch += [direct, early, more]
    found = components(sure.unionAll(more))
    search.close()
    rows = search.signed.select("doc_id", "content", "n_shingles").join(search.member, ["doc_id", "content"], "left")
    rows = rows.withColumn("rep", F.coalesce("rep", "doc_id")).join(found, F.col("rep") == found.node, "left")
    rows = rows.select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    return rows.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
