"""Personal data in texts: fixed rules, and a semi-Markov random field for what they miss.

The rules find e-mail addresses, IP addresses, card numbers and phone numbers in their usual
forms (``base_spans``). The field then looks at windows around other digits and at-signs. It
scores whole candidate segments, not single characters: how many digits in which groups, the
separators, the checksum, the neighbours. Dynamic programming over the atoms of a window
(words and single other characters) picks the best set of segments that do not overlap,
boundaries and kinds together; a segment has at most ``MOST_ATOMS`` atoms, a window any number.

The field learns from what the rules find, also respelled (a phone number without its plus, an
address with "at" and "dot"), against other numbers and against spoiled copies (a wrong check
digit, an octet of 900). It is fitted on the driver on a bounded sample: about ``sample_docs``
documents chosen by a hash of the id, of whose windows at most ``sample_windows`` per kind and
as many without any. A kind with fewer than ``LEAST_SEEN`` examples is never added. Everything
else runs over all documents, whole texts, in one pass without a shuffle.

Rows: a null or empty text has no spans, very long texts are scanned in linear time, each
repeated row and each null id gets its own result, an empty table gives no rows. Other columns
are not touched. Positions count code points, ends are exclusive. Spans of two rules may
overlap each other; what the field adds overlaps nothing.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import tidy
from tallyloom.sources.staging import written

KINDS = ("email", "ip", "card", "phone")
MOST_ATOMS = 24
LEAST_SEEN = 20
_CONTEXT = 20  # code points on either side of what a window is about

SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
SPANS = "array<struct<kind:string,start:int,end:int>>"

Span = tuple[str, int, int]


# --- rules -------------------------------------------------------------------
# Start positions inside a run of digits need no try of their own: what follows the run is the same.

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[Span]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            yield "email", start, free
        at = text.find("@", max(free, at + 1))


def luhn(digits: str) -> bool:
    own = sum(map(int, digits[-1::-2]))
    return (own + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _octets(parts: list[str]) -> bool:
    return all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in parts)


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """What the rules find, by kind, then start."""
    found = list(_emails(text))
    found += [("ip", *m.span()) for m in _IP.finditer(text) if _octets(m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return found


# --- windows -----------------------------------------------------------------

_NUMBER = re.compile(r"[0-9](?:[ ().\-/\[\] ‐-―]{0,3}[0-9]){6,}+")
_AT = re.compile(r"@|[\[({] ?(?:at|AT) ?[\])}]")
_SAID_AT = re.compile(r" (?:at|AT) (?=[\w-]{1,63} (?:dot|DOT) )")
_ATOM = re.compile(r"\w+|\W")
_MARK = re.compile(r"@|\bat\b|\bAT\b")
_GOES_ON = re.compile(r"\.\w| ?[\[({]? ?(?:dot|DOT)\b")
_DOT_MARK = re.compile(r"\b(?:dot|DOT)\b")


def windows(text: str, base: list[Span]) -> list[tuple[int, int]]:
    """(start, end) of the regions the field looks at: around numbers and at-signs, without the rules' spans."""
    cues = [m.span() for m in _NUMBER.finditer(text)] + [m.span() for m in _AT.finditer(text)]
    if " dot " in text or " DOT " in text:
        cues += [m.span() for m in _SAID_AT.finditer(text)]
    if not cues:
        return []
    wide = sorted((max(0, a - (_CONTEXT if text[a].isdigit() else 64)), min(len(text), b + (_CONTEXT if text[a].isdigit() else 96))) for a, b in cues)
    taken = sorted((a, b) for _, a, b in base)
    out: list[tuple[int, int]] = []
    for a, b in wide:
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    free, k = [], 0
    for a, b in out:
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        i = k
        while i < len(taken) and taken[i][0] < b:
            free.append((a, taken[i][0]))
            a = max(a, taken[i][1])
            i += 1
        free.append((a, b))
    return [(a, b) for a, b in free if b - a >= 6 and (_NUMBER.search(text, a, b) or _AT.search(text, a, b) or _SAID_AT.search(text, a, b))]


# --- features ----------------------------------------------------------------

_COUNTS = (7, 8, 9, 10, 11, 12, 13, 16, 17, 20)
#: Group lengths that usual ways to write numbers have.
_GROUPS = ((1, 3, 3, 4), (3, 3, 4), (3, 4), (4, 4, 4, 4), (4, 6, 5), (10,), (11,), (13,), (15,), (16,))


def _features(seg: str, left: str, right: str) -> list[int]:
    """Indices of the features that hold for a segment, the character before it and the few behind it."""
    groups = re.findall("[0-9]+", seg)
    n = sum(map(len, groups))
    has = [True] + [lo <= n < hi for lo, hi in zip((0, *_COUNTS), (*_COUNTS, math.inf))]
    has += [len(groups) == k for k in range(5)] + [len(groups) > 4]
    has += [tuple(map(len, groups)) == g for g in _GROUPS]
    has += [seg[0] == "+", seg[0] == "(", "(" in seg, "-" in seg, " " in seg, "." in seg, "/" in seg, "[" in seg]
    has += [any(c == " " or "‐" <= c <= "―" for c in seg)]
    whole = "".join(groups)
    mail = bool(_MARK.search(seg))
    has += [13 <= n <= 19 and luhn(whole), not (13 <= n <= 19 and luhn(whole)), len(groups) == 4 and _octets(groups), len(groups) == 4 and not _octets(groups)]
    has += [mail, mail and "@" in seg, mail and len(_MARK.findall(seg)) > 1, mail and bool(_DOT_MARK.search(seg) or "." in seg)]
    has += [mail and bool(re.search(r"(?:\.|\b(?:dot|DOT)\b[ \])}]*)[A-Za-z]{2,}$", seg)), mail and seg[:1].isalnum()]
    has += [left.isalnum(), right[:1].isalnum(), left != "" and left in ".-@_/+", right != "" and right[0] in "-@_/%", left.isdigit() or right[:1].isdigit()]
    has += [bool(_GOES_ON.match(right))]
    return [i for i, h in enumerate(has) if h]


N_FEATURES = 1 + 11 + 6 + len(_GROUPS) + 9 + 4 + 4 + 2 + 6


class Window:
    """Atoms of a window and its candidate segments (first atom, atom behind the last, features)."""

    def __init__(self, text: str, start: int, end: int):
        self.text, self.start = text, start
        self.ends = [start] + [m.end() for m in _ATOM.finditer(text, start, end)]
        atoms = [text[a:b] for a, b in zip(self.ends, self.ends[1:])]
        digits = [sum("0" <= c <= "9" for c in x) for x in atoms]
        word = [x[0].isalnum() or x[0] == "_" for x in atoms]
        mark = [x in ("@", "at", "AT") for x in atoms]
        letter = [any(c.isalpha() for c in x) for x in atoms]
        self.segments: list[tuple[int, int, list[int]]] = []
        for i in range(len(atoms)):
            if not (word[i] or atoms[i] in "+("):
                continue
            n = groups = marks = dots = letters = 0
            for j in range(i, min(len(atoms), i + MOST_ATOMS)):
                n, groups, marks, letters = n + digits[j], groups + (digits[j] > 0), marks + mark[j], letters + letter[j]
                dots += marks > 0 and atoms[j] in (".", "dot", "DOT")
                if atoms[j] in "\n\r\t|,;" or marks > 1 or (letters and atoms[j] == " " and not self._joins(atoms, j)):
                    break  # a segment stays in its line, and a blank between words joins only "at" and "dot"
                if not marks and (n > 19 or groups > 6):
                    break
                if word[j] and (dots or (n >= 7 and not letters and not marks)):
                    a, b = self.ends[i], self.ends[j + 1]
                    self.segments.append((i, j + 1, _features(text[a:b], text[max(0, a - 1) : a], text[b : b + 6])))

    @staticmethod
    def _joins(atoms: list[str], j: int) -> bool:
        near = [x.lower() for x in atoms[max(0, j - 2) : j] + atoms[j + 1 : j + 3]]
        return any(x in ("at", "dot", "@") for x in near)

    def scores(self, weights: np.ndarray) -> np.ndarray:
        return np.array([weights[:, f].sum(axis=1) for *_, f in self.segments]).reshape(-1, len(KINDS))

    def best(self, weights: np.ndarray, margin: float) -> list[Span]:
        """The best segmentation: at each atom, leave it out or end a segment there."""
        if not self.segments:
            return []
        scores = self.scores(weights) - margin
        kind, score = scores.argmax(axis=1), scores.max(axis=1)
        ending: dict[int, list[int]] = {}
        for row, (_, j, _) in enumerate(self.segments):
            if score[row] > 0:
                ending.setdefault(j, []).append(row)
        total, back = [0.0], [-1]
        for j in range(1, len(self.ends)):
            total.append(total[-1])
            back.append(-1)
            for row in ending.get(j, ()):
                if (value := total[self.segments[row][0]] + score[row]) > total[j]:
                    total[j], back[j] = value, row
        out, j = [], len(back) - 1
        while j > 0:
            if back[j] < 0:
                j -= 1
                continue
            i = self.segments[back[j]][0]
            out.append((KINDS[kind[back[j]]], self.ends[i], self.ends[j]))
            j = i
        return out[::-1]

    def expected(self, scores: np.ndarray) -> tuple[float, np.ndarray]:
        """log of the sum over all segmentations, and each segment's probability by kind."""
        n, whole = len(self.ends), np.logaddexp.reduce(scores, axis=1) if len(scores) else []
        ahead, behind = [0.0] + [-math.inf] * (n - 1), [-math.inf] * (n - 1) + [0.0]
        by_end = sorted(range(len(self.segments)), key=lambda r: self.segments[r][1])
        k = 0
        for j in range(1, n):
            terms = [ahead[j - 1]]
            while k < len(by_end) and self.segments[by_end[k]][1] == j:
                terms.append(ahead[self.segments[by_end[k]][0]] + whole[by_end[k]])
                k += 1
            ahead[j] = _log_sum(terms)
        by_start = sorted(range(len(self.segments)), key=lambda r: -self.segments[r][0])
        k = 0
        for i in range(n - 2, -1, -1):
            terms = [behind[i + 1]]
            while k < len(by_start) and self.segments[by_start[k]][0] == i:
                terms.append(behind[self.segments[by_start[k]][1]] + whole[by_start[k]])
                k += 1
            behind[i] = _log_sum(terms)
        outer = np.array([ahead[i] + behind[j] for i, j, _ in self.segments])
        return ahead[-1], np.exp(scores + outer[:, None] - ahead[-1]) if len(scores) else scores


def _log_sum(terms: list[float]) -> float:
    top = max(terms)
    return top + math.log(sum(math.exp(t - top) for t in terms)) if len(terms) > 1 else top


# --- fitting -----------------------------------------------------------------

def respelled(kind: str, span: str, turn: int) -> list[tuple[str, bool]]:
    """Other spellings of a span (True), and spoiled copies that are none (False)."""
    d = _digits(span)
    if kind == "email":
        user, _, host = span.partition("@")
        at, dot = ((" (at) ", "."), ("[at]", " dot "), (" at ", " dot "))[turn % 3]
        return [(user + at + host.replace(".", dot), True), (f"{user}@{host.partition('.')[0]}", False)]
    if kind == "ip":
        parts = span.split(".")
        return [(("[.]", " . ")[turn % 2].join(parts), True), (".".join([parts[0], str(int(parts[1][-3:]) + 700), *parts[2:]]), False)]
    if kind == "card":
        fours = [d[i : i + 4] for i in range(0, len(d), 4)]
        return [((" ", ".", " ", "-")[turn % 4].join(fours), True), (d[:-1] + str((int(d[-1]) + 1 + turn % 8) % 10), False)]
    home = d[-10:] if len(d) >= 10 else d
    spelled = (f"({home[:3]}) {home[3:6]}-{home[6:]}", f"{home[:3]}-{home[3:6]}-{home[6:]}", "+" + ".".join([d[: len(d) - len(home)] or "1", home[:3], home[3:6], home[6:]]))
    return [(spelled[turn % 3], True), (f"{home[:3]}-{home[3:7]}", False)]


def _examples(sample: list) -> list[tuple[Window, tuple[int, int, int] | None]]:
    """Windows with the segment and kind that is right in them, if any."""
    out = []
    for r in sample:
        text, turn = r["left"] + r["span"] + r["right"], zlib.crc32(r["span"].encode())
        if r["kind"] == "":
            out.append((Window(text, 0, len(text)), None))
            continue
        for span, right in [(r["span"], True), *respelled(r["kind"], r["span"], turn)]:
            window = Window(r["left"] + span + r["right"], 0, len(r["left"] + span + r["right"]))
            a, b = len(r["left"]), len(r["left"]) + len(span)
            rows = [k for k, (i, j, _) in enumerate(window.segments) if (window.ends[i], window.ends[j]) == (a, b)]
            if rows and right:
                out.append((window, (rows[0], KINDS.index(r["kind"]), 1)))
            elif not right:
                out.append((window, None))
    return out


def fit(sample: list, rounds: int = 60, rate: float = 0.3, shrink: float = 0.002) -> np.ndarray | None:
    """Weights by kind and feature: gradient ascent on the probability of the right segmentations."""
    seen = [sum(r["kind"] == kind for r in sample) for kind in KINDS]
    examples = [(w, gold) for w, gold in _examples(sample) if w.segments]
    if max(seen, default=0) < LEAST_SEEN:
        return None
    held = []
    for window, gold in examples:
        hot = np.zeros((len(window.segments), N_FEATURES))
        for row, (*_, f) in enumerate(window.segments):
            hot[row, f] = 1
        held.append((window, hot, gold))
    weights, squares = np.zeros((len(KINDS), N_FEATURES)), np.full((len(KINDS), N_FEATURES), 1e-8)
    for _ in range(rounds):
        gradient = -shrink * len(held) * weights
        for window, hot, gold in held:
            _, p = window.expected(hot @ weights.T)
            gradient -= p.T @ hot
            if gold:
                gradient[gold[1]] += hot[gold[0]]
        gradient /= len(held)
        squares += gradient * gradient
        weights += rate * gradient / np.sqrt(squares)
    weights[[k for k, n in enumerate(seen) if n < LEAST_SEEN], 0] = -1e6
    return weights


def _sampled(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, left, span, right) of every rule's span alone in its window, and of windows without any."""
    for rows in parts:
        out: list[tuple[str, str, str, str]] = []
        for value in rows.column("text"):
            text = value.as_py()
            if text:
                base = base_spans(text)
                edges = sorted((a, b) for _, a, b in base)
                for kind, a, b in base:
                    if sum(x < b and a < y for x, y in edges) == 1:
                        low = max([a - _CONTEXT, 0, *(y for _, y in edges if y <= a)])
                        high = min([b + _CONTEXT, len(text), *(x for x, _ in edges if x >= b)])
                        out.append((kind, text[low:a], text[a:b], text[b:high]))
                out += [("", "", text[a:b], "") for a, b in windows(text, base) if b - a <= 400]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)] or [pa.array([], pa.string())] * 4, names=["kind", "left", "span", "right"])


def learn(docs: DataFrame, sample_docs: int = 20_000, sample_windows: int = 250) -> np.ndarray | None:
    """The field's weights, from a bounded sample of documents; None if the rules find too little there."""
    total = docs.count()
    mark = F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(2**31))
    some = docs.filter(mark < F.lit(2**31 * sample_docs // max(total, sample_docs))).select("text")
    found = written(some.mapInArrow(tidy(_sampled), "kind string, left string, span string, right string"), "pii-sample")
    first = [found.filter(F.col("kind") == kind).orderBy(F.xxhash64("span", "left", "right"), "span", "left", "right").limit(sample_windows) for kind in (*KINDS, "")]
    return fit(reduce(DataFrame.unionAll, first).collect())


# --- application -------------------------------------------------------------

def added_spans(text: str, base: list[Span], weights: np.ndarray | None, margin: float = 1.0) -> list[Span]:
    """What the field finds beside the rules' spans, by kind, then start."""
    found = [] if weights is None else [s for a, b in windows(text, base) for s in Window(text, a, b).best(weights, margin)]
    return sorted(found, key=lambda s: (KINDS.index(s[0]), s[1]))


def _find(weights: np.ndarray | None, margin: float):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def spans(found: list[list[Span]]) -> pa.Array:
            return pa.array([[dict(zip(("kind", "start", "end"), s)) for s in row] for row in found], pa.list_(SPAN))

        for rows in parts:
            base, added = [], []
            for value in rows.column("text"):
                text = value.as_py() or ""
                base.append(base_spans(text))
                added.append(added_spans(text, base[-1], weights, margin))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), spans(base), spans(added)], names=["doc_id", "base", "added"])

    return run


def find(docs: DataFrame, margin: float = 1.0, sample_docs: int = 20_000, sample_windows: int = 250) -> DataFrame:
    """doc_id, base and added: arrays of (kind, start, end) in the order of ``KINDS``, then start.

    ``margin`` is what a segment's score must exceed.
    """
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    weights = learn(narrow, sample_docs, sample_windows)
    return narrow.mapInArrow(tidy(_find(weights, margin)), f"doc_id bigint, base {SPANS}, added {SPANS}")
