"""Secret scans through a trigram inverted index.

From each rule's pattern a Boolean query over trigrams is derived: what a text must contain for the pattern to match
anywhere. A block of texts is indexed once: for each trigram that some query asks for, the sorted numbers of the texts
that hold it. A rule's candidates come from intersecting and uniting these postings, and only candidates are verified by
the pattern itself, over their whole text. A rule without a mandatory trigram scans every text.

Blocks are parts of a partition, so the index needs no shuffle, a trigram that all texts share costs a block no more
than its texts, and a lost task builds its blocks again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _constants as sre
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunledger.llm.common import private

#: UTF-8 bytes of the texts that are indexed together (a longer text is a block of its own).
BLOCK_BYTES = 4_000_000
#: Strings a part of a pattern may stand for before it counts as "anything".
MOST_STRINGS = 32
MOST_CHARS = 10


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, and the least length of a group of the match (0: all of it)."""

    kind: str
    pattern: str
    any_case: bool = False
    group: int = 0
    least: int = 0

    def compiled(self) -> re.Pattern[str]:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))


# --- Fixed values: the three base kinds, in their order ---
BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        any_case=True,
        group=2,
        least=12,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    # A maximal run of 16 or more is the same as a maximal run that is dropped when shorter.
    Rule("hex", r"[0-9a-f]{16,}", least=16),
)
# --- Fixed values: shapes of published token formats ---
MORE = (
    Rule("private_key", r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[rs]k_live_[0-9A-Za-z]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"[A-Za-z][A-Za-z0-9+.-]{1,20}://[^\s/:@]+:[^\s/@]+@"),
)
# --- end of fixed values ---
RULES = BASE + MORE


# --- Boolean trigram queries ---

#: ("all",) is no condition; ("gram", bytes); ("and" | "or", parts).
Query = tuple
ALL: Query = ("all",)


def _flat(kind: str, parts: Sequence[Query]) -> list[Query]:
    return list(dict.fromkeys(p for part in parts for p in (part[1] if part[0] == kind else (part,))))


def both(parts: Sequence[Query]) -> Query:
    """All parts hold. A choice one of whose ways is held anyway adds nothing."""
    kept = [p for p in _flat("and", parts) if p != ALL]
    kept = [p for p in kept if p[0] != "or" or not any(way in kept for way in p[1])]
    return ALL if not kept else kept[0] if len(kept) == 1 else ("and", tuple(kept))


def either(parts: Sequence[Query]) -> Query:
    """One part holds. A way that asks for more than another adds nothing."""
    kept = _flat("or", parts)
    if ALL in kept or not kept:
        return ALL
    asked = {p: frozenset(_flat("and", [p])) for p in kept}
    kept = [p for p in kept if not any(asked[q] < asked[p] for q in kept)]
    return kept[0] if len(kept) == 1 else ("or", tuple(kept))


def folded(text: str) -> bytes:
    """What the index sees of a text: its bytes with A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower()


def grams(text: str) -> Query:
    data = folded(text)
    return both([("gram", data[i : i + 3]) for i in range(len(data) - 2)])


def one_of(texts: Sequence[str]) -> Query:
    return either([grams(t) for t in sorted(texts)])


@dataclass(frozen=True)
class Shape:
    """What is known of a pattern's matches: all of them if finite and few, how they begin and end, what they hold."""

    exact: frozenset[str] | None
    first: frozenset[str]
    last: frozenset[str]
    query: Query = ALL


EMPTY = Shape(frozenset([""]), frozenset([""]), frozenset([""]))
ANYTHING = Shape(None, frozenset([""]), frozenset([""]))


def strings(texts: Sequence[str]) -> Shape:
    kept = frozenset(texts)
    if len(kept) > MOST_STRINGS:
        return ANYTHING
    return Shape(kept, kept, kept)


def open_ended(shape: Shape) -> Shape:
    """The same without the claim to know every match."""
    if shape.exact is None:
        return shape
    return Shape(None, shape.exact, shape.exact, both([shape.query, one_of(shape.exact)]))


def then(a: Shape, b: Shape) -> Shape:
    if a.exact is not None and b.exact is not None:
        joined = {x + y for x, y in product(a.exact, b.exact)}
        if len(joined) <= MOST_STRINGS and max(map(len, joined)) <= MOST_CHARS:
            return Shape(frozenset(joined), frozenset(joined), frozenset(joined))
    seam = {x[-2:] + y[:2] for x, y in product(a.last, b.first)}
    first = {x + y for x, y in product(a.exact, b.first)} if a.exact is not None else set(a.first)
    last = {x + y for x, y in product(a.last, b.exact)} if b.exact is not None else set(b.last)
    parts = [open_ended(a).query, open_ended(b).query, one_of(seam), one_of(first), one_of(last)]
    return Shape(None, _short({f[:3] for f in first}), _short({x[-3:] for x in last}), both(parts))


def _short(texts: set[str]) -> frozenset[str]:
    return frozenset(texts) if len(texts) <= MOST_STRINGS else frozenset([""])


def or_else(a: Shape, b: Shape) -> Shape:
    if a.exact is not None and b.exact is not None and len(a.exact | b.exact) <= MOST_STRINGS:
        return strings(a.exact | b.exact)
    a, b = open_ended(a), open_ended(b)
    return Shape(None, _short(set(a.first | b.first)), _short(set(a.last | b.last)), either([a.query, b.query]))


def shape_of(parsed: Sequence, any_case: bool) -> Shape:
    return reduce(then, (_item(op, arg, any_case) for op, arg in parsed), EMPTY)


def _item(op, arg, any_case: bool) -> Shape:
    if op is sre.LITERAL:
        return strings([chr(arg)])
    if op is sre.IN:
        chars: set[str] = set()
        for kind, value in arg:
            if kind is sre.LITERAL:
                chars.add(chr(value))
            elif kind is sre.RANGE and value[1] - value[0] < MOST_STRINGS:
                chars.update(map(chr, range(value[0], value[1] + 1)))
            else:
                return ANYTHING
        return strings(chars)
    if op is sre.SUBPATTERN:
        return shape_of(arg[-1], any_case)
    if op is sre.BRANCH:
        return reduce(or_else, (shape_of(branch, any_case) for branch in arg[1]))
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
        least, most, body = arg
        shape = shape_of(body, any_case)
        if least == 0:
            return or_else(shape, EMPTY) if most == 1 else ANYTHING
        copies = reduce(then, [shape] * min(least, 3))
        return copies if least == most <= 3 else then(open_ended(copies), ANYTHING)
    if op in (sre.AT, sre.ASSERT, sre.ASSERT_NOT):
        return EMPTY
    return ANYTHING


def trigram_query(rule: Rule) -> Query:
    """Mandatory for any match of the rule, as the folded text has it; ALL if nothing is."""
    shape = open_ended(shape_of(_parser.parse(rule.pattern), rule.any_case))
    return both([shape.query, one_of(shape.first), one_of(shape.last)])


def grams_of(query: Query) -> set[bytes]:
    if query[0] == "gram":
        return {query[1]}
    return set().union(*map(grams_of, query[1])) if query[0] in ("and", "or") else set()


# --- index of a block ---


def postings(texts: Sequence[bytes], wanted: Sequence[bytes]) -> dict[bytes, np.ndarray]:
    """For each wanted trigram, the sorted numbers of the (folded) texts that hold it."""
    number = np.zeros(1 << 24, np.uint16)
    for i, gram in enumerate(wanted):
        number[gram[0] << 16 | gram[1] << 8 | gram[2]] = i + 1
    starts = np.cumsum([0] + [len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    pairs = []
    for low in range(0, max(len(data) - 2, 0), BLOCK_BYTES):
        part = data[low : low + BLOCK_BYTES + 2].astype(np.int32)
        found = number[part[:-2] << 16 | part[1:-1] << 8 | part[2:]]
        at = np.flatnonzero(found)
        text = np.searchsorted(starts, at + low, side="right") - 1
        inside = at + low + 3 <= starts[text + 1]  # not across the border of two texts
        pairs.append(np.unique(found[at][inside].astype(np.int64) << 32 | text[inside]))
    pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
    edges = np.searchsorted(pairs, np.arange(len(wanted) + 2) << 32)
    return {gram: pairs[edges[i + 1] : edges[i + 2]] & 0xFFFFFFFF for i, gram in enumerate(wanted)}


def candidates(query: Query, index: dict[bytes, np.ndarray], n: int) -> np.ndarray:
    """Numbers of the texts that meet a query."""
    if query == ALL:
        return np.arange(n)
    if query[0] == "gram":
        return index[query[1]]
    parts = [candidates(part, index, n) for part in query[1]]
    if query[0] == "or":
        return reduce(np.union1d, parts)
    return reduce(lambda a, b: np.intersect1d(a, b, assume_unique=True), sorted(parts, key=len))


def matches(rule: Rule, pattern: re.Pattern[str], text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches; those too short are dropped afterwards and hide nothing behind them."""
    found = pattern.finditer(text)
    return [m.span() for m in found if m.end(rule.group) - m.start(rule.group) >= rule.least]


def _blocks(texts: list[str]) -> Iterator[tuple[int, list[str], list[bytes]]]:
    at, group, data, size = 0, [], [], 0
    for i, text in enumerate(texts):
        group.append(text)
        data.append(folded(text))
        size += len(data[-1])
        if size >= BLOCK_BYTES:
            yield at, group, data
            at, group, data, size = i + 1, [], [], 0
    if group:
        yield at, group, data


SPANS = "spans array<struct<kind: string, start: bigint, end: bigint>>"


def secret_spans(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``doc_id, spans``, one row per document: spans in code points, end exclusive, by start, then kind as listed.

    A null text is an empty one and has no spans. Ids may be null or repeat. Other columns are not looked at.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = [(place, rule, rule.compiled(), trigram_query(rule)) for place, rule in enumerate(rules)]
        wanted = sorted(set().union(*(grams_of(query) for *_, query in plan)))
        kinds = pa.array([rule.kind for rule in rules], pa.string())
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
            for at, group, data in _blocks(texts):
                index = postings(data, wanted)
                for place, rule, pattern, query in plan:
                    for i in candidates(query, index, len(group)).tolist():
                        found[at + i] += [(start, place, end) for start, end in matches(rule, pattern, group[i])]
            flat = [span for spans in found for span in sorted(spans)]
            offsets = np.cumsum([0] + [len(spans) for spans in found])
            start, place, end = zip(*flat) if flat else ((), (), ())
            kind = kinds.take(pa.array(place, pa.int64()))
            fields = [kind, pa.array(start, pa.int64()), pa.array(end, pa.int64())]
            spans = pa.StructArray.from_arrays(fields, names=["kind", "start", "end"])
            column = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)
            yield pa.RecordBatch.from_arrays([batch.column(0), column], names=["doc_id", "spans"])

    source = private(docs, ["doc_id", "text"]).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return source.mapInArrow(rows, f"doc_id bigint, {SPANS}")


def printed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
