"""Near-duplicate lines by a segment-partition edit join.

Every distinct line is cut into threshold + 1 segments; two lines within the edit
distance share a segment, at a place that their lengths bound. Segments are indexed
by (line length, segment number, hash of the segment); a line probes, for each length
it can match, the substrings that the segment could have become. Lines that meet and
whose sketches of byte pairs allow the distance are verified with a banded bit-parallel
edit distance over bytes.

Two different lines are linked when their distance is at most ``edits`` and the
shorter one has at least ``least_per_edit`` bytes per allowed edit; a shorter line is
linked with nothing. Equal lines are one line. Classes are the connected lines.

Rows: a null text has no lines; an empty text is one empty line. Lines that are empty
or white space belong to no class (null class, kept). Documents without id or with
one id keep their lines apart by what the lines hold; equal lines of equal place count
as one first occurrence. An empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import components, discard, small, tidy, written
from tallyloom.llm.minhash import near_duplicates

_SPACE = b" \t\n\v\f\r"


def distance_within(a: bytes, b: bytes, edits: int) -> int | None:
    """The edit distance of a and b if it is at most edits, else None.

    Row d of the automaton holds, as bits, the prefixes of a that match the part of b
    read so far with at most d edits. Only the band of 2 * edits + 1 prefixes around the
    diagonal is kept, so a row is a small integer that slides along with b.
    """
    if abs(len(a) - len(b)) > edits:
        return None
    at, most = 0, min(len(a), len(b))
    step = 1 << (most.bit_length() or 1)
    while step:  # common prefix, by halving steps
        if at + step <= most and a[at : at + step] == b[at : at + step]:
            at += step
        else:
            step >>= 1
    a, b = a[at:], b[at:]
    places: dict[int, int] = {}
    for k, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << k
    mask = (1 << (2 * edits + 1)) - 1
    rows = [((1 << (d + 1)) - 1) << edits & mask for d in range(edits + 1)]
    for j, c in enumerate(b):
        same = places.get(c, 0)
        same = (same >> (j - edits) if j >= edits else same << (edits - j)) & mask
        above = rows[0]
        new = rows[0] = above & same
        for d in range(1, edits + 1):
            old = rows[d]
            new = rows[d] = ((old & same) | above | (above >> 1) | (new << 1)) & mask
            above = old
        if not new:
            return None
    end = 1 << (edits + len(a) - len(b))
    return next((d for d, row in enumerate(rows) if row & end), None)


def segments(length: int, edits: int) -> list[tuple[int, int]]:
    """(start, size) of edits + 1 segments that cover a line; sizes differ by one at most, longer ones last."""
    parts = edits + 1
    short, longer = length // parts, length % parts
    out, at = [], 0
    for i in range(parts):
        size = short + (i >= parts - longer)
        out.append((at, size))
        at += size
    return out


def probes(length: int, other: int, edits: int) -> list[tuple[int, int, int]]:
    """(segment, start, size) of the substrings of a line that a segment of a line of length ``other`` can have become.

    Looked at from the left, segment i can be shifted by at most i edits; looked at from
    the right, by what the segments behind it leave. Both bounds hold together.
    """
    gap, out = length - other, []
    for i, (at, size) in enumerate(segments(other, edits)):
        low = max(0, at - i, at + gap - (edits - i))
        high = min(length - size, at + i, at + gap + (edits - i))
        out += [(i, start, size) for start in range(low, high + 1)]
    return out


def _line_hashes(line: bytes) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(line)
    return (h & (2**64 - 1)) - 2**63, (h >> 64) - 2**63


def _lines(parts: Iterator[pa.RecordBatch], long_words: int = 0) -> Iterator[pa.RecordBatch]:
    """One row per line: its place, both halves of its hash and its length; blank lines have null hashes.

    With long_words, also whether it has so many words.
    """
    for part in parts:
        owner, number, one, two, size, long = [], [], [], [], [], []
        for i, raw in enumerate(part.column("raw").to_pylist()):
            if raw is None:
                continue
            for k, line in enumerate(raw.split(b"\n")):
                blank = not line.strip(_SPACE)
                h = (None, None) if blank else _line_hashes(line)
                owner.append(i), number.append(k), one.append(h[0]), two.append(h[1]), size.append(len(line))
                if long_words:
                    long.append(len(line.split()) >= long_words)
        more = [pa.array(long, pa.bool_())] if long_words else []
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id").take(pa.array(owner, pa.int64())), pa.array(number, pa.int32()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(size, pa.int32()), *more],
            names=["doc_id", "line_no", "h1", "h2", "size"] + ["long"] * len(more),
        )


def _keys(edits: int, least: int):
    """Index and probe keys of the lines of a batch, each line once a batch."""
    places: dict[int, list] = {}

    def of(length: int) -> list:
        if length not in places:
            mine = [(True, length, i, at, size) for i, (at, size) in enumerate(segments(length, edits))]
            for other in range(max(least, length - edits), length + 1):
                mine += [(False, other, *p) for p in probes(length, other, edits)]
            places[length] = [(own, other.to_bytes(5, "little") + bytes([i]), at, at + size) for own, other, i, at, size in mine]
        return places[length]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            key, own, one, two = [], [], [], []
            seen = set()
            for raw in part.column("raw").to_pylist():
                for line in (raw or b"").split(b"\n"):
                    if len(line) < least or not line.strip(_SPACE):
                        continue
                    h = _line_hashes(line)
                    if h in seen:
                        continue
                    seen.add(h)
                    for indexed, head, start, end in of(len(line)):
                        key.append(xxhash.xxh3_64_intdigest(head + line[start:end]) - 2**63)
                        own.append(indexed), one.append(h[0]), two.append(h[1])
                if len(key) > 200_000:
                    yield _key_batch(key, own, one, two)
                    key, own, one, two = [], [], [], []
            yield _key_batch(key, own, one, two)

    return run


def _key_batch(key, own, one, two) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(key, pa.int64()), pa.array(own, pa.bool_()), pa.array(one, pa.int64()), pa.array(two, pa.int64())], names=["key", "own", "h1", "h2"],
    )


def sketch(line: bytes) -> int:
    """64 bits: which byte pairs, by a hash, occur an odd number of times. One edit flips four bits at most."""
    b = np.frombuffer(line, np.uint8).astype(np.uint32)
    places = (b[:-1] * np.uint32(2_654_435_761) + b[1:] * np.uint32(40_503)) * np.uint32(0x9E3779B1) >> np.uint32(26)
    odd = np.packbits(np.bincount(places, minlength=64).astype(np.uint8) & 1, bitorder="little")
    return int(odd.view(np.int64)[0])


def _wanted_lines(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The wanted lines of each document: (h1, h2, line, sketch), once a document."""
    for part in parts:
        one, two, lines = [], [], []
        for raw, numbers in zip(part.column("raw").to_pylist(), part.column("numbers").to_pylist()):
            held = raw.split(b"\n")
            for k in set(numbers):
                if k < len(held):
                    h = _line_hashes(held[k])
                    one.append(h[0]), two.append(h[1]), lines.append(held[k])
        yield pa.RecordBatch.from_arrays(
            [pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(lines, pa.binary()), pa.array([sketch(x) for x in lines], pa.int64())],
            names=["h1", "h2", "line", "sketch"],
        )


def _close(edits: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            near = [
                i for i, (x, y) in enumerate(zip(part.column("xa").to_pylist(), part.column("xb").to_pylist()))
                if distance_within(x, y, edits) is not None
            ]
            yield part.select(["a1", "a2", "b1", "b2"]).take(pa.array(near, pa.int64()))

    return run


def near_duplicate_lines(docs: DataFrame, edits: int = 1, least_per_edit: int = 16) -> DataFrame:
    """One row per line: doc_id, line_no, size in bytes, n_links, class_doc, class_line, class_docs, first.

    n_links counts the different lines linked with this one; (class_doc, class_line) is
    the first place of its class in order of (doc_id, line_no); class_docs counts the
    documents that hold a line of the class; first is true at that place only.
    """
    return _classed(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("raw")), edits, least_per_edit)


def _classed(narrow: DataFrame, edits: int = 1, least_per_edit: int = 16, long_words: int = 0) -> DataFrame:
    """near_duplicate_lines of (doc_id, raw), whose doc_id can be of any type that has an order; with long_words, also long."""
    least = edits * least_per_edit
    kind = narrow.schema["doc_id"].dataType.simpleString()
    fields = f"doc_id {kind}, line_no int, h1 bigint, h2 bigint, size int" + ", long boolean" * bool(long_words)
    lines = written(narrow.mapInArrow(tidy(lambda parts: _lines(parts, long_words)), fields), "lines")
    links = _links(narrow, lines, edits, least)

    place = F.struct("doc_id", "line_no", "h1", "h2")
    distinct = lines.filter("h1 IS NOT NULL").groupBy("h1", "h2").agg(F.min(place).alias("at"))
    ends = links.select("a1", "a2", "b1", "b2").unionAll(links.select("b1", "b2", "a1", "a2"))
    n_links = ends.groupBy(F.col("a1").alias("h1"), F.col("a2").alias("h2")).agg(F.count("*").alias("n_links"))
    linked = written(distinct.join(n_links, ["h1", "h2"]), "linked-lines")
    name = lambda s: linked.select(F.col("h1").alias(f"{s}1"), F.col("h2").alias(f"{s}2"), F.col("at").alias(s))
    found = components(links.join(name("a"), ["a1", "a2"]).join(name("b"), ["b1", "b2"]).select("a", "b"))
    discard(links)
    classes = linked.join(found, linked["at"] == found.node).select("h1", "h2", "n_links", F.col("component").alias("class"))
    all_classes = distinct.join(classes, ["h1", "h2"], "left").select(
        "h1", "h2", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("class", "at").alias("class"),
    )
    named = lines.join(all_classes, ["h1", "h2"], "left")
    holders = named.filter("class IS NOT NULL").groupBy("class", "doc_id").agg(F.lit(1).alias("one")).groupBy("class").agg(F.count("*").alias("class_docs"))
    many = holders.filter("class_docs > 1")
    return named.join(many, "class", "left").select(
        "doc_id", "line_no", "size", F.coalesce("n_links", F.lit(0).cast("bigint")).cast("bigint").alias("n_links"),
        F.col("class.doc_id").alias("class_doc"), F.col("class.line_no").alias("class_line"),
        F.when(F.col("class").isNotNull(), F.coalesce("class_docs", F.lit(1).cast("bigint"))).alias("class_docs"),
        F.coalesce(F.col("class").eqNullSafe(place) | F.col("class").isNull(), F.lit(True)).alias("first"),
        *["long"] * bool(long_words),
    )


def _links(narrow: DataFrame, lines: DataFrame, edits: int, least: int) -> DataFrame:
    """Linked pairs of different lines as their hashes (a1, a2), (b1, b2), each pair once."""
    keys = narrow.mapInArrow(tidy(_keys(edits, least)), "key bigint, own boolean, h1 bigint, h2 bigint")
    met = keys.groupBy("key").agg(
        F.min(F.struct("h1", "h2")).alias("low"), F.max(F.struct("h1", "h2")).alias("high"), F.bool_or("own").alias("own"), F.bool_and("own").alias("only"),
    ).filter("low <> high AND own AND NOT only").select("key")
    near = segments_met = written(keys.join(met, "key").distinct(), "segments")
    wanted = near.select("h1", "h2").distinct()
    first = lines.filter("h1 IS NOT NULL").join(wanted, ["h1", "h2"]).groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "line_no")).alias("at"))
    numbers = first.groupBy(F.col("at.doc_id").alias("doc_id")).agg(F.collect_set("at.line_no").alias("numbers"))
    held = narrow.filter("raw IS NOT NULL").join(numbers.withColumnRenamed("doc_id", "id"), F.expr("doc_id <=> id")).select("raw", "numbers")
    texts = held.mapInArrow(tidy(_wanted_lines), "h1 bigint, h2 bigint, line binary, sketch bigint")
    texts = written(texts.join(wanted, ["h1", "h2"], "left_semi").dropDuplicates(["h1", "h2"]), "line-texts")
    near = near.join(texts.select("h1", "h2", "sketch"), ["h1", "h2"])
    x, y = near.filter("own").alias("x"), near.filter("NOT own").alias("y")
    # many lines can share a segment: those whose byte pairs differ by more than the edits explain don't meet
    pairs = x.join(y, F.expr(f"x.key = y.key AND (x.h1 <> y.h1 OR x.h2 <> y.h2) AND bit_count(x.sketch ^ y.sketch) <= {4 * edits}"))
    one, two = F.struct("x.h1", "x.h2"), F.struct("y.h1", "y.h2")
    pairs = pairs.select(F.least(one, two).alias("p"), F.greatest(one, two).alias("q")).distinct().select(
        F.col("p.h1").alias("a1"), F.col("p.h2").alias("a2"), F.col("q.h1").alias("b1"), F.col("q.h2").alias("b2"),
    )
    text = lambda s: texts.select(F.col("h1").alias(f"{s}1"), F.col("h2").alias(f"{s}2"), F.col("line").alias(f"x{s}"))
    both = pairs.join(text("a"), ["a1", "a2"]).join(text("b"), ["b1", "b2"])
    links = written(both.mapInArrow(tidy(_close(edits)), "a1 bigint, a2 bigint, b1 bigint, b2 bigint"), "line-links")
    discard(segments_met)
    discard(texts)
    return links


def _copy_groups(held: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """(id, group) of the documents that near-duplicate search at percent puts under another id.

    Only documents that share at least half of their bytes with others are looked at.
    """
    shares = held.groupBy("id", "content").agg(F.sum("size").alias("all"), F.sum(F.when(F.col("class_docs") > 1, F.col("size"))).alias("shared"))
    likely = small(written(shares.filter("2 * shared >= all").select(F.col("id").alias("__id"), F.col("content").alias("__content")), "likely-copies"))
    same = (F.col("doc_id") == F.col("__id")) & (F.xxhash64("text") == F.col("__content"))
    found = near_duplicates(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(likely, same, "left_semi"), percent=percent)
    copies = written(found.filter("NOT kept").select(F.col("doc_id").alias("id"), F.col("component_id").alias("group")).distinct(), "copy-groups")
    discard(found)  # what the search wrote
    discard(likely)
    return copies


def without_repeated_lines(docs: DataFrame, least_docs: int = 3, copy_percent: int = 80, long_words: int = 50, **settings) -> DataFrame:
    """docs without lines that repeat: inside a document, and across documents after the first one.

    A line goes when its class occurred earlier in the document, or when least_docs
    documents hold the class and this is not the first of them; two documents are enough
    for a class with a line of long_words words or more. Documents that the
    near-duplicate search links at copy_percent, directly or in a chain, count as one
    document here and keep or lose a class alike: they are left to the document stage.
    The first holder is looked for among the documents that this stage will keep, then among all.
    A document is an id with a text: equal rows count once and come out equal. Texts of
    one id lose their own inner repeats each, and count as one document among others.
    Rows with a null id are left as they are. ``n_chars`` is counted anew where it exists.
    """
    key = F.struct(F.col("doc_id").cast("bigint").alias("id"), F.xxhash64("text").alias("content"))
    narrow = docs.filter("doc_id IS NOT NULL").select(key.alias("doc_id"), F.col("text").cast("binary").alias("raw"))
    lines = _classed(narrow, **settings, long_words=long_words).filter("class_docs IS NOT NULL")
    # one row per document and class; a set, as equal rows name equal places
    held = lines.groupBy("doc_id", "class_doc", "class_line", "class_docs").agg(F.array_sort(F.collect_set(F.struct("line_no", "size"))).alias("places"), F.bool_or("long").alias("long"))
    held = written(held.select(
        "doc_id.*", F.struct("class_doc", "class_line").alias("class"), "class_docs", F.col("places")[0]["size"].alias("size"), F.col("places.line_no").alias("numbers"), "long",
    ), "held-lines")
    discard(lines)  # what the search for classes wrote
    copies = _copy_groups(held, docs, copy_percent)
    common = held.filter("class_docs > 1").join(small(copies), "id", "left").withColumn("group", F.coalesce("group", "id"))
    by_group = common.groupBy("class", "group").agg(F.min(F.struct(F.col("id") != F.col("group"), "id", "content", "group")).alias("at"), F.bool_or("long").alias("long"))
    shared = by_group.groupBy("class").agg(F.count("*").alias("groups"), F.min("at").alias("at"), F.bool_or("long").alias("long"))
    shared = shared.filter(f"groups >= IF(long, 2, {max(2, least_docs)})")
    later = common.join(shared.select("class", F.col("at.group").alias("keeper")), "class").filter("group <> keeper").select("id", "content", "numbers")
    inner = held.filter("size(numbers) > 1").select("id", "content", F.slice("numbers", 2, F.size("numbers")).alias("numbers"))
    gone = later.unionAll(inner).groupBy("id", "content").agg(F.flatten(F.collect_list("numbers")).alias("gone"))
    # the document stays in one column, so that none of its names meets one of these
    whole = docs.select(F.struct("*").alias("doc"), F.col("doc_id").cast("bigint").alias("own_id"), F.xxhash64("text").alias("own_content"))
    kept_lines = F.filter(F.split("doc.text", "\n", -1), lambda line, i: ~F.array_contains("gone", i))
    text = F.when(F.col("gone").isNotNull(), F.array_join(kept_lines, "\n")).otherwise(F.col("doc.text"))
    out = whole.join(gone, (F.col("own_id") == F.col("id")) & (F.col("own_content") == F.col("content")), "left").withColumn("new_text", text)
    return out.select(*[
        F.col("new_text").alias(c) if c == "text"
        else F.length("new_text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"doc.`{c}`").alias(c)
        for c in docs.columns
    ])
