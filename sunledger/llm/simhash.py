"""SimHash fingerprints and near-duplicate groups by the generalised pigeonhole principle.

Two fingerprints that differ in at most ``t`` bits, cut into ``m`` parts with thresholds that add up to ``t - m + 1``
(-1: the part is not probed), differ in some part by at most its threshold. The parts group bits that go together in
the data, and each fingerprint gets thresholds of its own, by dynamic programming over the candidates it has to expect
in each part at each threshold. The estimates come from counts of all fingerprints: a table of at most 256 values for
each run of at most eight bits within a part.

Probes meet the index in a join on (part, value); candidates are verified by their bit distance. A value that very many
fingerprints share would give a square of pairs there. Fingerprints that touch such a value take the exact way round it:
each is written under itself and its one-bit neighbours, and two that differ by at most two bits share one such
key. A key has at most 65 distinct owners, so that path is linear, whatever the group's size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunledger.llm.common import files_for, own_names, private, release, run_dir, stored
from sunledger.llm.components import components
from sunledger.llm.exact_dedup import one_per_key

BITS = 64
SEED = 42
#: Bits of one table of counts.
RUN = 8
#: What a probe costs, counted in candidates to verify.
PROBE_COST = 2.0
#: From this many fingerprints on, a value of a part goes the way that is linear in the group: 65 rows for each of them.
CROWD = 128
#: Rows that probing hands on at once.
LOOKUPS = 1 << 20


# --- fingerprints ---


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned fingerprint of one text: bit set in over half the shingles' hashes; without words it is zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        shingle = len(words)
    digest = xxhash.xxh64_intdigest
    if shingle == 1:
        hashes = [digest(w, SEED) for w in words]
    else:
        hashes = [digest(b" ".join(words[i : i + shingle]), SEED) for i in range(len(words) - shingle + 1)]
    # Bytes of a chunk of hashes unpack to bits; chunks keep a very long text's memory flat.
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 65536):
        part = np.array(hashes[i : i + 65536], dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, digest: bool = False) -> DataFrame:
    """``doc_id, fp`` (the unsigned fingerprint's bits as a long), one row per document, from its whole text; on demand
    with ``digest``, that of the text's bytes."""
    rows_of = private(docs, ["doc_id", "text"]).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    names, schema = ["doc_id", "fp"], "doc_id bigint, fp bigint"
    if digest:
        names, schema = [*names, "digest"], f"{schema}, digest string"
        rows_of = rows_of.withColumn("digest", text_digest())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64)), *batch.columns[2:]], names=names)

    return rows_of.mapInArrow(rows, schema)


def text_digest() -> Column:
    """A null text is an empty one."""
    return F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)


# --- the plan: parts, thresholds, costs ---


def bit_rows(values: np.ndarray) -> np.ndarray:
    """Longs to an array of 64 bits each, lowest first."""
    return np.unpackbits(values.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        if batch.num_rows:
            yield batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)


def bit_pair_counts(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and in how many both of two bits are set: 64 x 64 numbers, whatever the input."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, both = 0, np.zeros((BITS, BITS))
        for values in _arrays(batches):
            for i in range(0, len(values), 16384):
                bits = bit_rows(values[i : i + 16384]).astype(np.float32)
                both += bits.T @ bits
            n += len(values)
        if n:
            cells = np.append(both.ravel(), n).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], names=["cell", "n"])

    counts = distinct.select("fp").mapInArrow(partial, "cell bigint, n bigint")
    found = {row.cell: row.n for row in counts.groupBy("cell").agg(F.sum("n").alias("n")).collect()}
    cells = np.array([found.get(i, 0) for i in range(BITS * BITS + 1)], dtype=np.float64)
    return int(cells[-1]), cells[:-1].reshape(BITS, BITS)


def correlated_parts(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Bits that go together go into one part: each part starts from the strongest bond left and takes the bit with the
    strongest bonds to it until it is full."""
    share = np.diag(both) / max(n, 1)
    deviation = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    bond = np.abs((both / max(n, 1) - np.outer(share, share)) / np.outer(deviation, deviation))
    np.fill_diagonal(bond, 0)
    left, out = list(range(BITS)), []
    for part in range(parts):
        room = BITS // parts + (part < BITS % parts)
        pool = np.array(left)
        start = int(pool[np.argmax(bond[np.ix_(pool, pool)].max(axis=1))])
        chosen = [start]
        while len(chosen) < room:
            pool = np.array([b for b in left if b not in chosen])
            chosen.append(int(pool[np.argmax(bond[np.ix_(pool, chosen)].sum(axis=1))]))
        left = [b for b in left if b not in chosen]
        out.append(sorted(chosen))
    return out


def part_values(values: np.ndarray, bits: list[int]) -> np.ndarray:
    """The bits of a part, put together as a number."""
    out = np.zeros(len(values), np.uint64)
    for place, bit in enumerate(bits):
        out |= ((values.view(np.uint64) >> np.uint64(bit)) & np.uint64(1)) << np.uint64(place)
    return out.view(np.int64)


def runs_of(bits: list[int]) -> list[list[int]]:
    return [bits[i : i + RUN] for i in range(0, len(bits), RUN)]


@dataclass(frozen=True)
class Plan:
    """Parts, and per part and run of bits the number of fingerprints at distance 0..t from each value of the run."""

    distance: int
    n: int
    parts: list[list[int]]
    near: list[list[np.ndarray]]


def run_counts(distinct: DataFrame, runs: list[list[int]]) -> list[np.ndarray]:
    """For each run of bits, how many fingerprints have each of its values (at most 256)."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(1 << len(bits), np.int64) for bits in runs]
        for values in _arrays(batches):
            for total, bits in zip(totals, runs):
                total += np.bincount(part_values(values, bits), minlength=len(total))
        run = np.repeat(np.arange(len(runs)), [len(t) for t in totals])
        value = np.concatenate([np.arange(len(t)) for t in totals])
        n = np.concatenate(totals)
        yield pa.RecordBatch.from_arrays([pa.array(run), pa.array(value), pa.array(n)], names=["run", "value", "n"])

    rows = distinct.select("fp").mapInArrow(partial, "run bigint, value bigint, n bigint")
    out = [np.zeros(1 << len(bits)) for bits in runs]
    for row in rows.groupBy("run", "value").agg(F.sum("n").alias("n")).collect():
        out[row.run][row.value] = row.n
    return out


def near_counts(counts: np.ndarray, distance: int) -> np.ndarray:
    """Row v: how many fingerprints have a value at distance exactly 0, 1, .. from v."""
    width = int(np.log2(len(counts)))
    codes = np.arange(len(counts))
    out = np.zeros((len(counts), distance + 1))
    for e in range(min(distance, width) + 1):
        for flips in combinations(range(width), e):
            out[:, e] += counts[codes ^ sum(1 << b for b in flips)]
    return out


def ball(width: int, radius: int) -> list[int]:
    """All masks of up to ``radius`` of ``width`` bits."""
    return [sum(1 << b for b in flips) for e in range(radius + 1) for flips in combinations(range(width), e)]


def costs(plan: Plan, values: np.ndarray) -> list[np.ndarray]:
    """Per part, the expected cost of each threshold from -1 on: probes, and candidates as if runs were independent."""
    out = []
    for bits, tables in zip(plan.parts, plan.near):
        share = np.zeros((len(values), plan.distance + 1))
        share[:, 0] = 1
        for run, table in zip(runs_of(bits), tables):
            exact = table[part_values(values, run)] / max(plan.n, 1)
            joined = np.zeros_like(share)
            for a in range(plan.distance + 1):
                for b in range(plan.distance + 1 - a):
                    joined[:, a + b] += share[:, a] * exact[:, b]
            share = joined
        probes = np.array([len(ball(len(bits), e)) for e in range(plan.distance + 1)], dtype=float)
        cost = np.cumsum(share, axis=1) * plan.n + PROBE_COST * probes
        out.append(np.hstack([np.zeros((len(values), 1)), cost]))
    return out


def allocate(plan: Plan, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Thresholds (one column per part, -1: not probed) that add up to t - m + 1 at least cost, and that cost.

    Dynamic programming over parts; the state is the sum spent so far, counted from -1 per part.
    """
    cost, m, t = costs(plan, values), len(plan.parts), plan.distance
    best = np.full((len(values), t + 2), np.inf)
    best[:, 0] = 0
    choice = []
    for part in range(m):
        nxt = np.full_like(best, np.inf)
        picked = np.zeros(best.shape, np.int8)
        for spent in range(t + 2):
            for take in range(t + 2 - spent):
                total = best[:, spent] + cost[part][:, take]
                better = total < nxt[:, spent + take]
                nxt[better, spent + take] = total[better]
                picked[better, spent + take] = take
        best = nxt
        choice.append(picked)
    state = np.full(len(values), t + 1)
    rows = np.arange(len(values))
    taken = np.zeros((len(values), m), np.int8)
    for part in reversed(range(m)):
        taken[:, part] = choice[part][rows, state]
        state = state - taken[:, part]
    return taken - 1, best[:, t + 1]


def make_plan(distinct: DataFrame, distance: int) -> Plan:
    """The number of parts (1 to t + 1) with the least expected cost over all fingerprints, and its tables."""
    n, both = bit_pair_counts(distinct)
    layouts = [correlated_parts(n, both, m) for m in range(1, distance + 2)]
    runs = [run for parts in layouts for bits in parts for run in runs_of(bits)]
    tables = iter([near_counts(c, distance) for c in run_counts(distinct, runs)])
    plans = [Plan(distance, n, parts, [[next(tables) for _ in runs_of(bits)] for bits in parts]) for parts in layouts]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(plans))
        for values in _arrays(batches):
            for i in range(0, len(values), 16384):
                total += [allocate(plan, values[i : i + 16384])[1].sum() for plan in plans]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(plans))), pa.array(total)], names=["plan", "cost"])

    rows = distinct.select("fp").mapInArrow(partial, "plan bigint, cost double")
    total = {row.plan: row.cost for row in rows.groupBy("plan").agg(F.sum("cost").alias("cost")).collect()}
    return plans[min(range(len(plans)), key=lambda i: total.get(i, 0.0))]


# --- links ---

KEYED = "part int, value bigint, fp bigint"


def index(distinct: DataFrame, plan: Plan) -> DataFrame:
    """``part, value, fp``: every fingerprint under each of its parts' values."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for values in _arrays(batches):
            for part, bits in enumerate(plan.parts):
                yield _keyed(np.full(len(values), part), part_values(values, bits), values)

    return distinct.select("fp").mapInArrow(rows, KEYED)


def probes(distinct: DataFrame, plan: Plan) -> DataFrame:
    """``part, value, fp``: the values each fingerprint looks up, within its own thresholds."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for values in _arrays(batches):
            for i in range(0, len(values), 16384):
                some = values[i : i + 16384]
                yield from lookups(plan, some, allocate(plan, some)[0])

    return distinct.select("fp").mapInArrow(rows, KEYED)


def lookups(plan: Plan, values: np.ndarray, thresholds: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Probes of some fingerprints, at most :data:`LOOKUPS` at once: a part's ball may have hundreds of values."""
    for part, bits in enumerate(plan.parts):
        for radius in range(plan.distance + 1):
            asking = values[thresholds[:, part] == radius]
            masks = np.array(ball(len(bits), radius), np.uint64).view(np.int64)
            step = max(1, LOOKUPS // len(masks))
            for i in range(0, len(asking), step):
                some = asking[i : i + step]
                looked = (part_values(some, bits)[:, None] ^ masks[None, :]).ravel()
                yield _keyed(np.full(len(looked), part), looked, np.repeat(some, len(masks)))


def _keyed(part: np.ndarray, value: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array(part.astype(np.int32)), pa.array(value), pa.array(fp)]
    return pa.RecordBatch.from_arrays(arrays, names=["part", "value", "fp"])


def ball_links(some: DataFrame, distance: int = 2) -> DataFrame:
    """Links among ``some`` fingerprints, as stars: all owners of a key are within one bit of it, hence within two of
    each other. At distance one only the key itself is linked to its owners; at zero there are no links."""
    if distance > 2:
        raise ValueError("one-bit neighbours meet at two bits at most")
    flips = F.expr(f"transform(sequence(0, {BITS - 1}), i -> fp ^ shiftleft(1L, i))")
    keys = some.select("fp", F.explode(F.concat(F.array("fp"), flips)).alias("key"))
    owners = keys.groupBy("key").agg(F.collect_list("fp").alias("fps")).filter("size(fps) > 1")
    centre = F.array_min("fps") if distance == 2 else F.when(F.array_contains("fps", F.col("key")), F.col("key"))
    stars = owners.select(centre.alias("v"), F.explode("fps").alias("u")).filter("u <> v")
    return stars.select("u", "v").distinct() if distance else stars.limit(0).select("u", "v")


def links(distinct: DataFrame, plan: Plan, path: str, crowd: int = CROWD) -> DataFrame:
    """``u, v``: pairs that connect all distinct fingerprints (column ``fp``) at the plan's distance or nearer."""
    held = stored(index(distinct, plan), f"{path}/index")
    asked = stored(probes(distinct, plan), f"{path}/probes")
    key = ["part", "value"]
    sizes = held.groupBy(*key).agg(F.count("*").alias("n"))
    crowds = sizes.filter(F.col("n") >= crowd).select(*key)
    crowded = stored(crowds, f"{path}/crowded", len(plan.parts) * plan.n // max(crowd, 1))
    owners, askers = held.withColumnRenamed("fp", "v"), asked.withColumnRenamed("fp", "u")
    pairs = askers.join(crowded, key, "left_anti").join(owners.join(crowded, key, "left_anti"), key)
    close = pairs.filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= plan.distance)
    close = close.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    touched = held.union(asked).join(crowded, key, "left_semi").select("fp").distinct()
    return close.union(ball_links(touched, plan.distance))


def rooted_rows(docs: DataFrame, shingle: int, distance: int, crowd: int, path: str, digest: bool = False) -> tuple[DataFrame, DataFrame]:
    """``doc_id, fp`` of every document, and ``fp, least, root`` of every fingerprint: its smallest id, and the
    fingerprint that names its group."""
    rows = stored(fingerprints(docs, shingle, digest), f"{path}/rows")
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), f"{path}/distinct", rows.count())
    plan = make_plan(distinct, distance)
    roots = components(links(distinct, plan, path, crowd), f"{path}/components", plan.n)
    rooted = distinct.join(roots.withColumnRenamed("u", "fp"), "fp", "left")
    return rows, stored(rooted.select("fp", "least", F.coalesce("root", "fp").alias("root")), f"{path}/rooted", plan.n)


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2, crowd: int = CROWD) -> DataFrame:
    """One row per document: ``doc_id, fp, component_id`` (the smallest id reachable over links; itself included).

    Null texts and texts without words have fingerprint zero and link like any other. Equal fingerprints are one node
    of the search, so copies cost it nothing. A null id is never a component's name unless all its ids are null.
    An empty table gives an empty result.
    """
    path = run_dir(docs.sparkSession, "simhash")
    rows, rooted = rooted_rows(docs, shingle, distance, crowd, path)
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.select("fp", "root").join(names, "root").select("fp", "component_id")
    # Whoever writes the result gets no tiny files either; the number of rows stands in the stored table's footers.
    return rows.join(named, "fp").select("doc_id", "fp", "component_id").coalesce(files_for(rows.count()))


def keep_one(docs: DataFrame, shingle: int = 3, distance: int = 2, crowd: int = CROWD) -> DataFrame:
    """One document of each group, with all its columns, whatever these are called: the one with the smallest id, a null id
    only when there is no other, and of equal ids the one with the smallest digest of its text. Of repeated rows one stays.
    Null texts and texts without words are one group, as their fingerprint is zero. An empty table stays empty."""
    path = run_dir(docs.sparkSession, "simhash")
    printed, rooted = rooted_rows(docs, shingle, distance, crowd, path, digest=True)
    # The smallest of each fingerprint is taken map-side, then that of each group.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest")).alias("first")
    of_print = printed.groupBy("fp").agg(first)
    kept = of_print.join(rooted.select("fp", "root"), "fp").groupBy("root").agg(F.min("first").alias("first"))
    own_id, own_digest, digest_of = own_names(docs, "id", "digest", "digest_of")
    kept = kept.select(F.col("first.doc_id").alias(own_id), F.col("first.digest").alias(own_digest))
    kept = stored(kept, f"{path}/kept")
    rows = docs.withColumn(digest_of, text_digest())
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col(own_id)) & (F.col(digest_of) == F.col(own_digest))
    rows = rows.join(kept, same, "left_semi")
    return one_per_key(rows, ["doc_id", digest_of]).drop(digest_of)
