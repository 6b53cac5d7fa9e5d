"""Embedding near-duplicates by NN-descent over vectors of one label.

Equal vectors of a label are one node. Hyperplane codes give every node a first
neighbour list, from as many tables as a pair at the threshold needs to share a code in
one of them; then each round lets the neighbours of a node meet (its list and the
nodes that list it), and every node keeps the best it has seen. A list that is full of
links is too short: it doubles. Connected nodes are at last compared in blocks, in
double precision, which counts every link among them. Large components are cut into
blocks by their angle to the component's mean: what two angles prove linked, or not
linked, is counted without a comparison. An audit compares nodes of every kind of list
with all others; below the wanted recall the search goes on with fresh tables and longer
lists, and a search that stays below the least recall is an error.

Rows: a vector that is null, empty, zero, or holds null or non-finite components, a
null label and a null id link with nothing; n_links is 0 and the component the row's
own id. Vectors of different length are never compared. Of an id with several vectors
the smallest (label, vector) stands for the id in all its rows. Equal similarities are
ordered by id. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyloom.llm.common import components, discard, small, tidy, written
from tallyloom.llm.topk import usable

#: Members that meet at once; a larger meeting is held in parts.
MEETING = 64
#: Nodes of a block when connected nodes are compared.
BLOCK = 512
#: Angles are held as whole numbers of this part of a radian, so that sums of them are exact.
ANGLE_UNIT = 1e-9
#: More than the rounding of an angle between double vectors (an arc cosine near 1 loses half the digits).
ANGLE_SLACK = 1000
EDGE = "u bigint, w bigint, sim double"


def runs(parts: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The groups of frames sorted by keys, whole across frame borders."""
    held: list[pd.DataFrame] = []
    for part in parts:
        if not len(part):
            continue
        values = part[keys].to_numpy()
        cuts = [0, *(np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1), len(part)]
        if held and (values[0] != held[-1][keys].to_numpy()[-1]).any():
            yield pd.concat(held)
            held = []
        for a, b in zip(cuts, cuts[1:]):
            piece = part.iloc[a:b]
            if b < len(part):
                yield pd.concat([*held, piece]) if held else piece
                held = []
            else:
                held.append(piece)
    if held:
        yield pd.concat(held)


def _unit_rows(part: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(part), np.float32).reshape(len(part), -1)


def _grouped(df: DataFrame, keys: list[str], run, schema: str) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(lambda parts: run(runs(parts, keys)), schema)


def _best_pairs(sims: np.ndarray, names: np.ndarray, floor: np.ndarray, most: int, out: list) -> None:
    """Each member's best partners of the meeting, better than its floor, nearest first."""
    np.fill_diagonal(sims, -2)
    most = min(most, len(names) - 1)
    near = np.argpartition(-sims, most - 1, axis=1)[:, :most]
    score = np.take_along_axis(sims, near, axis=1)
    rows, cols = np.nonzero(score > floor[:, None])
    out.append((names[rows], names[near[rows, cols]], score[rows, cols].astype(np.float64)))


def _edges(out: list) -> pd.DataFrame:
    u, w, sim = (np.concatenate(x) for x in zip(*out))
    other = u != w
    return pd.DataFrame({"u": u[other], "w": w[other], "sim": sim[other]})


def _first_lists(k: int):
    def run(groups: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list = []
        for g in groups:
            for at in range(0, len(g), MEETING):
                part = g.iloc[at : at + MEETING]
                if len(part) > 1:
                    x = _unit_rows(part.unit)
                    _best_pairs(x @ x.T, part.node.to_numpy(), np.full(len(part), -1.5), k, out)
            if sum(len(o[0]) for o in out) > 100_000:
                yield _edges(out)
                out = []
        if out:
            yield _edges(out)

    return run


def _meet(most: int):
    def run(groups: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list = []
        for g in groups:
            g = g.drop_duplicates("node")
            if len(g) > 1:
                x = _unit_rows(g.unit)
                _best_pairs(x @ x.T, g.node.to_numpy(), g["floor"].to_numpy(), most, out)
            if sum(len(o[0]) for o in out) > 100_000:
                yield _edges(out)
                out = []
        if out:
            yield _edges(out)

    return run


def tables_for(bits: int, threshold: float, miss: float) -> int:
    """Tables after which a pair at the threshold shares no code with at most the given probability."""
    same = (1 - np.arccos(threshold) / np.pi) ** bits
    return max(1, int(np.ceil(np.log(miss) / np.log1p(-same)))) if same < 1 else 1


def _codes(threshold: float, miss: float, attempt: int):
    """Hyperplane codes of each node, one per table; longer for labels with more nodes.

    Each attempt has tables of its own. ``near`` holds the bits behind the code, so that
    nodes of a crowded code are met in its order, like by like.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for (bits, dims), same in part.groupby(["bits", "dims"]):
                x = _unit_rows(same.unit)
                behind = 62 - int(bits)
                for t in range(tables_for(int(bits), threshold, miss)):
                    planes = np.random.default_rng([7, attempt, t]).standard_normal((int(dims), 62)).astype(np.float32)
                    code = (x @ planes > 0).astype(np.int64) @ (np.int64(1) << np.arange(61, -1, -1, dtype=np.int64))
                    yield pd.DataFrame({
                        "label": same.label, "dims": same.dims, "t": t, "code": code >> behind, "near": code & ((1 << behind) - 1),
                        "node": same.node, "unit": same.unit,
                    })

    return run


def _ranges(limit: int):
    """For each block of a component, by angle: copies in blocks that are linked as a whole, blocks to compare.

    Two vectors at angles a and b from one direction are linked if a + b is within the limit,
    and not linked if a - b is beyond it.
    """

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("block")
        block, least, most = (part[c].to_numpy() for c in ("block", "least", "most"))
        sure = np.searchsorted(most, limit - ANGLE_SLACK - most, side="right")
        last = np.searchsorted(least, limit + ANGLE_SLACK + most, side="right")
        before = np.concatenate([[0], np.cumsum(part.copies.to_numpy())])
        at = np.arange(len(part))
        return pd.DataFrame({
            "component": part.component, "block": block, "sure": before[sure], "own": at < sure, "first": part["first"].iloc[0],
            "others": [block[max(i, lo) : hi] for i, lo, hi in zip(at, sure, last)],
        })

    return run


def _within(threshold: float):
    """Links inside one pair of blocks: per node the links it has there, and a spanning forest of them."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        left, right = part[part.side == 0], part[part.side == 1]
        same = part.left.iloc[0] == part.right.iloc[0]
        right = left if same else right
        whole = lambda **columns: pd.DataFrame({c: pd.array(v, "Int64") for c, v in columns.items()})  # noqa: E731  ids don't fit floats
        if not len(left) or not len(right):
            return whole(node=[], links=[], hi=[], lo=[])
        x, y = (_double_units(p.vec) for p in (left, right))
        near = x @ y.T >= threshold
        if same:
            np.fill_diagonal(near, False)
        out = [whole(node=left.node, links=near @ right.copies.to_numpy())]
        if not same:
            out.append(whole(node=right.node, links=near.T @ left.copies.to_numpy()))
        hi, lo = _forest(near, left.node.to_numpy(), right.node.to_numpy())
        return pd.concat([*out, whole(hi=hi, lo=lo)])

    return run


def _double_units(vectors: pd.Series) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _forest(near: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[list, list]:
    """Enough of the links to keep what they connect connected."""
    names, place = np.unique(np.concatenate([left, right]), return_inverse=True)
    group = np.arange(len(names))
    mine, theirs = place[: len(left)], place[len(left) :]
    hi, lo = [], []
    for i, row in enumerate(near):
        cols = np.flatnonzero(row)
        met, first = np.unique(group[theirs[cols]], return_index=True)
        own = group[mine[i]]
        other = met != own
        if other.any():
            hi += [int(left[i])] * int(other.sum())
            lo += right[cols[first[other]]].tolist()
            group[np.isin(group, met)] = own
    return hi, lo


class Graph:
    """Neighbour lists of the nodes of a table, refined round by round."""

    def __init__(self, vectors: DataFrame, threshold: float, k: int, miss: float):
        self.threshold, self.miss = threshold, miss
        fit = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("raw")) & F.exists("raw", lambda x: x != 0)
        base = vectors.filter(fit).select("vec_id", "label", F.transform("raw", lambda x: x.cast("double")).alias("vec"))
        one = base.groupBy("vec_id").agg(F.min(F.struct("label", "vec")).alias("v")).select("vec_id", "v.label", "v.vec")
        rows = written(one.withColumn("h1", F.xxhash64("label", "vec")).withColumn("h2", F.xxhash64(F.lit(1), "vec", "label")), "vectors")
        classes = rows.groupBy("h1", "h2").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
        self.member = written(rows.join(classes, ["h1", "h2"]).select("vec_id", "node", "copies", "label", "vec"), "members")
        size = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))
        first = self.member.filter("vec_id = node").select("node", "label", "copies", "vec", F.size("vec").alias("dims"))
        counts = first.groupBy("label").agg(F.count("*").alias("n"))
        bits = counts.select("label", F.greatest(F.lit(1), F.least(F.lit(60), F.ceil(F.log2(F.col("n") / 24)))).cast("int").alias("bits"))
        nodes = first.withColumn("size", size).join(bits, "label")
        self.nodes = written(nodes.mapInPandas(tidy(_units), "node bigint, label string, copies bigint, vec array<double>, dims int, bits int, unit binary"), "nodes")
        self.lists = self._keep(self._met_by_code(0, k), None, k)

    def _met_by_code(self, attempt: int, k: int) -> DataFrame:
        coded = self.nodes.select("node", "label", "dims", "bits", "unit").mapInPandas(
            tidy(_codes(self.threshold, self.miss, attempt)),
            "label string, dims int, t int, code bigint, near bigint, node bigint, unit binary",
        )
        # nodes alike in all bits are dealt by hash, anew in each table
        group = F.xxhash64("label", "dims", "t", "code").alias("g")
        start = coded.select(group, "near", F.xxhash64("node", "t").alias("deal"), "node", "unit")
        start = start.repartition("g").sortWithinPartitions("g", "near", "deal")
        return start.mapInPandas(lambda parts: _first_lists(k)(runs(parts, ["g"])), EDGE)

    def widen(self, attempt: int, k: int) -> None:
        """Add what fresh tables find to the lists, now of length k."""
        after = self._keep(self._met_by_code(attempt, k), self.lists, k)
        discard(self.lists)
        self.lists = after

    def _keep(self, found: DataFrame, lists: DataFrame | None, k: int) -> DataFrame:
        """The best k partners of each node, and further ones as long as the list is full of links."""
        both = found if lists is None else found.unionAll(lists)
        best = both.groupBy("u", "w").agg(F.max("sim").alias("sim"))
        order = W.partitionBy("u").orderBy(F.desc("sim"), "w")
        ranked = best.withColumn("rank", F.row_number().over(order))
        return written(ranked.filter((F.col("rank") <= k) | ((F.col("sim") >= self.threshold - 1e-6) & (F.col("rank") <= 2 * k))).select("u", "w", "sim"), "lists")

    def round(self, k: int) -> int:
        """Let neighbours of neighbours meet; the number of list places that changed."""
        floors = self.lists.groupBy("u").agg(F.count("*").alias("n"), F.min("sim").alias("least"))
        # a list that is not full, or full of links, takes any partner
        floors = floors.select("u", F.when((F.col("n") < k) | (F.col("least") >= self.threshold - 1e-6), F.lit(-1.5)).otherwise(F.col("least")).alias("floor"))
        known = self.nodes.select("node", "unit").join(floors, F.col("node") == F.col("u"), "left").select("node", "unit", F.coalesce("floor", F.lit(-1.5)).alias("floor"))
        ends = self.lists.select(F.col("u").alias("centre"), F.col("w").alias("node")).unionAll(self.lists.select(F.col("w"), F.col("u")))
        ends = ends.unionAll(self.nodes.select("node", "node")).distinct()
        sizes = ends.groupBy("centre").agg(F.count("*").alias("n"))
        # a node that very many others list holds its meeting in parts
        parts = ends.join(sizes, "centre").withColumn("part", F.pmod(F.xxhash64("node", "centre"), F.ceil(F.col("n") / MEETING)))
        met = parts.select("centre", "part", "node").join(known, "node")
        found = _grouped(met, ["centre", "part"], _meet(max(3, k // 3)), EDGE)
        after = self._keep(found, self.lists, k)
        new = after.join(self.lists, ["u", "w"], "left_anti").count()
        discard(self.lists)
        self.lists = after
        return new

    def links(self, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
        """(node, n_links) and link pairs (a, b): exact inside whatever the lists connect."""
        near = self.lists.filter(F.col("sim") >= self.threshold - 1e-6).select(F.col("u").alias("a"), F.col("w").alias("b"))
        group = components(near)
        held = written(self.nodes.select("node", "copies", "vec").join(group, "node"), "connected")
        sizes = written(held.groupBy("component").agg(F.count("*").alias("n")), "sizes")
        large = small(written(sizes.filter(F.col("n") > block).select("component"), "large-components"))
        alone = held.join(large, "component", "left_anti").select(
            "component", F.lit(0).cast("bigint").alias("left"), F.lit(0).cast("bigint").alias("right"), F.lit(0).alias("side"), "node", "copies", "vec",
        )
        dealt, ranges = self._by_angle(held.join(large, "component"), block)
        todo = ranges.select("component", F.col("block").alias("left"), F.explode("others").alias("right"))
        columns = ["component", "left", "right", "side", "node", "copies", "vec"]
        lefts = dealt.withColumnRenamed("block", "left").join(todo, ["component", "left"]).withColumn("side", F.lit(0))
        rights = dealt.withColumnRenamed("block", "right").join(todo.filter("left < right"), ["component", "right"]).withColumn("side", F.lit(1))
        pairs = alone.unionAll(lefts.select(*columns)).unionAll(rights.select(*columns))
        # a fixed number of tasks: small rows make much work here, and would be merged by their bytes
        tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        found = written(
            pairs.repartition(tasks, "component", "left", "right").groupBy("component", "left", "right")
            .applyInPandas(_within(self.threshold), "node bigint, links bigint, hi bigint, lo bigint"), "found",
        )
        proven = written(dealt.join(ranges.filter("sure > 0"), ["component", "block"]).select(
            "node", (F.col("sure") - F.when(F.col("own"), F.col("copies")).otherwise(0)).alias("links"), F.col("first").alias("lo"),
        ), "proven")
        counts = found.filter("node IS NOT NULL").select("node", "links").unionAll(proven.select("node", "links"))
        edges = found.filter("hi IS NOT NULL").select(F.col("hi").alias("a"), F.col("lo").alias("b"))
        # what any whole block is linked with holds the first block, so one node of that connects them
        edges = edges.unionAll(proven.filter("node <> lo").select("node", "lo"))
        return counts.groupBy("node").agg(F.sum("links").alias("n_links")), edges

    def _by_angle(self, held: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
        """Nodes in blocks by (component, angle to its mean), and what ``_ranges`` says of each block."""
        size = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))
        sums = held.select("component", F.posexplode(F.transform("vec", lambda x: x / size)).alias("at", "x"))
        means = sums.groupBy("component", "at").agg(F.sum("x").alias("x")).groupBy("component").agg(
            F.transform(F.sort_array(F.collect_list(F.struct("at", "x"))), lambda p: p.x).alias("mean")
        )
        mean = small(written(means, "means"), most_rows=10_000)
        dot = F.aggregate(F.zip_with("vec", "mean", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
        length = F.sqrt(F.aggregate("mean", F.lit(0.0), lambda s, x: s + x * x))
        cosine = F.least(F.lit(1.0), F.greatest(F.lit(-1.0), dot / (size * length)))
        angle = F.coalesce(F.floor(F.acos(F.nanvl(cosine, F.lit(-1.0))) / ANGLE_UNIT), F.lit(0)).cast("bigint")
        angled = held.join(mean, "component").select("component", angle.alias("angle"), "node", "copies", "vec")
        ordered = angled.repartitionByRange("component", "angle", "node").sortWithinPartitions("component", "angle", "node")
        number = F.floor(F.monotonically_increasing_id() / block).cast("bigint")
        dealt = written(ordered.withColumn("block", number), "by-angle")
        blocks = dealt.groupBy("component", "block").agg(
            F.min("angle").alias("least"), F.max("angle").alias("most"), F.sum("copies").alias("copies"), F.min("node").alias("first"),
        )
        limit = int(np.floor(np.arccos(self.threshold) / ANGLE_UNIT))
        ranges = blocks.groupBy("component").applyInPandas(
            _ranges(limit), "component bigint, block bigint, sure bigint, own boolean, first bigint, others array<bigint>",
        )
        return dealt, written(ranges, "ranges")

    def recall(self, counts: DataFrame, probes: int = 256) -> float:
        """Estimated mean, over nodes with links, of the share of a node's links that were found.

        Nodes without a found link, with few and with many are probed apart, ``probes`` of each
        chosen by hash, and weighed by how many there are: a hot group cannot outweigh small ones.
        """
        kind = F.when(F.col("n_links").isNull() | (F.col("n_links") == 0), 0).when(F.col("n_links") < 8, 1).otherwise(2)
        nodes = written(self.nodes.select("node", "label", "dims", "vec").join(counts, "node", "left").select(
            "node", "label", "dims", "vec", kind.alias("kind"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        ), "audited")
        weight = {r["kind"]: r["n"] for r in nodes.groupBy("kind").agg(F.count("*").alias("n")).collect()}
        if not weight:
            return 1.0
        some = pd.concat([nodes.filter(F.col("kind") == k).orderBy(F.xxhash64("node", F.lit(9))).limit(probes).toPandas() for k in weight])
        threshold = self.threshold
        asked = {key: (g.node.to_numpy(), _double_units(g.vec)) for key, g in some.groupby(["label", "dims"])}

        def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for part in parts:
                for key, g in part.groupby(["label", "dims"]):
                    if key in asked:
                        names, x = asked[key]
                        near = (x @ _double_units(g.vec).T >= threshold) & (names[:, None] != g.node.to_numpy()[None, :])
                        yield pd.DataFrame({"node": names, "links": near @ g.copies.to_numpy()})

        truth = self.nodes.select("node", "label", "dims", "copies", "vec").mapInPandas(tidy(count), "node bigint, links bigint")
        true = {r["node"]: r["links"] for r in truth.groupBy("node").agg(F.sum("links").alias("links")).collect()}
        some["links"] = [true.get(int(n), 0) for n in some.node]
        discard(nodes)
        due = got = 0.0
        for k, n in weight.items():
            probed = some[some.kind == k]
            linked = probed[probed.links > 0]
            due += n * len(linked) / len(probed)
            got += n * float((linked.n_links / linked.links).sum()) / len(probed)
        return got / due if due else 1.0


def _units(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        for _, same in part.groupby("dims"):
            units = [u.tobytes() for u in _double_units(same.vec).astype(np.float32)]
            yield same[["node", "label", "copies", "vec", "dims", "bits"]].assign(unit=units)


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.98, k: int = 10, miss: float = 0.002, rounds: int = 3, recall: float = 0.99,
    least_recall: float = 0.9, attempts: int = 4,
) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of (vec_id, label, embedding).

    Rounds end when fewer than a hundredth of the list places change, or after ``rounds``
    of them. While the audit reads less than ``recall``, further attempts add fresh tables and
    lists of twice the length; after the last one, less than ``least_recall`` raises an error.
    """
    table = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").alias("raw"))
    graph = Graph(table, threshold, k, miss)
    places = max(1, graph.nodes.count() * k)
    for attempt in range(attempts):
        if attempt:
            graph.widen(attempt, k * 2**attempt)
        for _ in range(rounds):
            if graph.round(k * 2**attempt) < places / 100:
                break
        counts, links = graph.links()
        reached = graph.recall(counts)
        if reached >= recall:
            break
    if reached < least_recall:
        raise RuntimeError(f"audited recall {reached:.3f} is below {least_recall} after {attempts} attempts")
    found = components(links)
    own = graph.member.select("vec_id", "node", "copies").join(counts, "node", "left").join(found, "node", "left")
    own = own.select("vec_id", (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    out = table.select("vec_id").join(own, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
