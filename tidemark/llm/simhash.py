"""SimHash near-duplicates through the general pigeonhole principle.

Fingerprints that differ in at most ``d`` bits must, for thresholds t_1..t_m with sum d - m + 1, differ in at most t_i
bits on some part i of the bits. Correlated bits go into one part; a dynamic programme picks the number of parts and
their thresholds (-1 skips a part) with the lowest estimated cost. Each fingerprint is filed under its key on a part
and probes all keys within t_i; those that meet are compared on all 64 bits.

Input cases: null and word-free texts have fingerprint zero and link like any other; fewer words than a shingle make
one shingle; repeated ids or rows stay as they are, each with its component; a component with no id but null has a
null id; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import tables
from tidemark.llm.components import components

#: Fingerprints whose distances are looked at to plan the search. The plan alone depends on them, no result does.
PLAN_SAMPLE = 4096
#: Rows and columns of one block of comparisons.
BLOCK = 1024


def fingerprint(text: bytes | None, width: int) -> int:
    """Bit-wise majority of the XXH64 (seed 42) of all shingles of ``width`` words."""
    found = (text or b"").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    n = max(1, len(found) - width + 1)
    length = np.fromiter(map(len, found), np.int64, len(found))
    end = np.cumsum(length + 1) - 1
    start = (end - length)[:n].tolist()
    last = end[min(width, len(found)) - 1 :][:n].tolist()
    digest = xxhash.xxh64_intdigest
    total = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 15):
        part = [digest(joined[a:b], 42) for a, b in zip(start[at : at + (1 << 15)], last[at : at + (1 << 15)])]
        bits = np.unpackbits(np.array(part, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(0, dtype=np.int64)
    bits = (2 * total > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """``doc_id``, ``mark`` (a hash of the text) and ``code`` (the fingerprint as a signed long) of every row."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        codes = [fingerprint(x, width) for x in batch.column("text").to_pylist()]
        signed = pa.array(np.array(codes, dtype=np.uint64).view(np.int64))
        columns = [batch.column("doc_id"), batch.column("mark"), signed]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "mark", "code"])

    rows = tables.text_rows(docs).withColumn("mark", F.xxhash64("text"))
    return tables.map_slices(rows, make, "doc_id long, mark long, code long")


@dataclass(frozen=True)
class Plan:
    """Bits of each part and the distance that its keys may have."""

    parts: tuple[tuple[int, ...], ...]
    limits: tuple[int, ...]


def _keys(codes: np.ndarray, bits: tuple[int, ...]) -> np.ndarray:
    out = np.zeros(len(codes), np.uint64)
    for i, bit in enumerate(bits):
        out |= (codes >> np.uint64(bit) & np.uint64(1)) << np.uint64(i)
    return out


def group_bits(related: np.ndarray, m: int) -> list[tuple[int, ...]]:
    """``m`` parts of nearly equal width; each grows by the bit most correlated with those it has."""
    left, parts = set(range(64)), []
    for i in range(m):
        width = 64 // m + (i < 64 % m)
        part = [max(left, key=lambda b: (related[b].sum(), -b))]
        left.remove(part[0])
        while len(part) < width:
            part.append(max(left, key=lambda b: (related[b, part].sum(), -b)))
            left.remove(part[-1])
        parts.append(tuple(sorted(part)))
    return parts


def allocate(cost: list[dict[int, float]], total: int) -> tuple[float, tuple[int, ...]]:
    """Thresholds, one per part, that sum to ``total`` at the least cost (dynamic programme over the parts)."""
    best: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
    for options in cost:
        fresh: dict[int, tuple[float, tuple[int, ...]]] = {}
        for spent, (price, picked) in best.items():
            for limit, more in options.items():
                new = (price + more, (*picked, limit))
                if spent + limit not in fresh or new < fresh[spent + limit]:
                    fresh[spent + limit] = new
        best = fresh
    return best[total]


def make_plan(sample: np.ndarray, n: int, distance: int) -> Plan:
    """Cheapest parts and thresholds for ``n`` fingerprints of which ``sample`` is a part."""
    if not len(sample):
        return Plan((tuple(range(64)),), (distance,))
    bits = np.unpackbits(sample.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(float)
    spread = bits.std(0)
    centred = (bits - bits.mean(0)) / np.where(spread > 0, spread, 1)
    related = np.abs(centred.T @ centred / max(len(sample), 1))
    choices = []
    for m in range(min(2, distance + 1), distance + 2):
        parts, cost = group_bits(related, m), []
        for part in parts:
            key, seen = _keys(sample, part), np.zeros(distance + 1)
            for i in range(0, len(key), BLOCK):
                apart = np.bitwise_count(key[i : i + BLOCK, None] ^ key[None, :])
                seen += np.bincount(apart.ravel(), minlength=65)[: distance + 1]
            seen[0] -= len(key)
            pairs = max(len(key) * (len(key) - 1), 1)
            options = {-1: 0.0}
            for limit in range(distance + 1):
                ball = sum(comb(len(part), i) for i in range(limit + 1))
                share = max(seen[: limit + 1].sum() / pairs, ball / 2.0 ** len(part))
                # A row that is filed or probes costs about as much as 2000 comparisons.
                options[limit] = n * (2000.0 * (1 + (ball if limit else 0)) + n * share)
            cost.append(options)
        price, limits = allocate(cost, distance - m + 1)
        choices.append((price, m, Plan(tuple(parts), limits)))
    return min(choices, key=lambda x: x[:2])[2]


def _rows(codes: np.ndarray, plan: Plan) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(part, kind, keys, codes): kind 0 is filed under its own key, kind 1 probes another one."""
    for i, (part, limit) in enumerate(zip(plan.parts, plan.limits)):
        if limit < 0:
            continue
        key = _keys(codes, part)
        yield i, 0, key, codes
        for size in range(1, limit + 1):
            for flips in combinations(range(len(part)), size):
                yield i, 1, key ^ np.uint64(sum(1 << f for f in flips)), codes


def _pairs(a: np.ndarray, b: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the pairs of a and b within the distance, block by block."""
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i in range(0, len(a), BLOCK):
        for j in range(0, len(b), BLOCK):
            x, y = np.nonzero(np.bitwise_count(a[i : i + BLOCK, None] ^ b[None, j : j + BLOCK]) <= distance)
            left.append(x + i)
            right.append(y + j)
    return np.concatenate(left), np.concatenate(right)


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest index in the component of each of ``n`` items."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        fresh = root.copy()
        np.minimum.at(fresh, a, low)
        np.minimum.at(fresh, b, low)
        fresh = fresh[fresh]
        if (fresh == root).all():
            return root
        root = fresh


def group_links(filed: np.ndarray, probing: np.ndarray, rest: tuple[int, ...], distance: int) -> np.ndarray:
    """Links (two columns) that join all fingerprints of one key that belong together; as many as members at most.

    A large group is parted again: on the ``rest`` of the bits a near pair agrees on one of distance + 1 ranges.
    """
    codes, at = np.unique(np.concatenate([filed, probing]), return_inverse=True)
    own, other = np.unique(at[: len(filed)]), np.unique(at)
    if len(own) * len(other) <= BLOCK * BLOCK or not rest:
        x, y = _pairs(codes[own], codes[other], distance)
        a, b = own[x], other[y]
    else:
        found = []
        for i in range(distance + 1):
            key = _keys(codes, rest[i :: distance + 1])
            # Keys outermost, so that every sub-group is a run; its filed members are marked.
            order = np.argsort(key, kind="stable")
            cut = np.flatnonzero(np.diff(key[order])) + 1
            mark = np.zeros(len(codes), bool)
            mark[own] = True
            for members in np.split(order, cut):
                mine = members[mark[members]]
                if len(members) > 1 and len(mine):
                    x, y = _pairs(codes[mine], codes[members], distance)
                    a, b = mine[x], members[y]
                    root = _roots(np.searchsorted(members, a), np.searchsorted(members, b), len(members))
                    found.append(np.stack([members, members[root]], axis=1))
        both = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
        a, b = both[:, 0], both[:, 1]
    root = _roots(a, b, len(codes))
    apart = root != np.arange(len(codes))
    return np.stack([codes[apart], codes[root[apart]]], axis=1)


def _small_links(codes: np.ndarray, group: np.ndarray, filed: np.ndarray, distance: int) -> np.ndarray:
    """Links inside many small runs at once: each row against the one ``gap`` rows on."""
    found, gap = [], 1
    while gap < len(codes):
        same = np.flatnonzero(group[gap:] == group[:-gap])
        if not len(same):
            break
        near = same[np.bitwise_count(codes[same] ^ codes[same + gap]) <= distance]
        near = near[filed[near] | filed[near + gap]]
        found.append(np.stack([codes[near], codes[near + gap]], axis=1))
        gap += 1
    return np.concatenate(found) if found else np.zeros((0, 2), np.uint64)


def links(distinct: DataFrame, plan: Plan, distance: int) -> DataFrame:
    """Links ``a``, ``b`` that join all ``distinct`` fingerprints within the distance, directly or through others."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column("code").to_numpy(zero_copy_only=False).view(np.uint64)
            for part, kind, key, own in _rows(codes, plan):
                n = len(own)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, part, np.int32)),
                        pa.array(key.view(np.int64)),
                        pa.array(np.full(n, kind, np.int32)),
                        pa.array(own.view(np.int64)),
                    ],
                    names=["part", "key", "kind", "code"],
                )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried: np.ndarray | None = None
        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(4)])
            if carried is not None:
                rows = np.concatenate([carried, rows], axis=1)
            if not rows.shape[1]:
                continue
            new = np.concatenate(([True], (rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1])))
            cut = np.flatnonzero(new)[-1]  # the last group may go on in the next batch
            carried = rows[:, cut:]
            if cut:
                yield _batch(rows[:, :cut])
        if carried is not None and carried.shape[1]:
            yield _batch(carried)

    def _batch(rows: np.ndarray) -> pa.RecordBatch:
        new = np.concatenate(([True], (rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1])))
        group, start = np.cumsum(new) - 1, np.flatnonzero(new)
        size = np.diff(np.append(start, rows.shape[1]))
        codes = np.ascontiguousarray(rows[3]).view(np.uint64)
        small = size[group] <= 64
        found = [_small_links(codes[small], group[small], rows[2][small] == 0, distance)]
        for i in np.flatnonzero(size > 64):
            run = slice(start[i], start[i] + size[i])
            filed = rows[2, run] == 0
            rest = tuple(b for b in range(64) if b not in plan.parts[rows[0, start[i]]])
            found.append(group_links(codes[run][filed], codes[run][~filed], rest, distance))
        made = np.unique(np.concatenate(found), axis=0).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(made[:, 0]), pa.array(made[:, 1])], names=["a", "b"])

    filed = distinct.select("code").mapInArrow(spread, "part int, key long, kind int, code long")
    return (
        filed.repartition("part", "key")
        .sortWithinPartitions("part", "key", "kind", "code")
        .mapInArrow(meet, "a long, b long")
    )


def grouped(docs: DataFrame, width: int, distance: int) -> DataFrame:
    """``doc_id``, ``mark``, ``code`` and ``root`` (a fingerprint that names the component) of every row, and the
    component's smallest id as ``component_id``."""
    with tables.Staging(docs.sparkSession, "simhash") as staging:
        coded = staging.put(fingerprints(docs, width), "codes", keep=True)
        distinct = staging.put(coded.groupBy("code").agg(F.min("doc_id").alias("smallest")), "distinct", keep=True)
        n = distinct.count()
        share = min(1.0, 2 * PLAN_SAMPLE / max(n, 1))
        sample = distinct.select("code").sample(share, seed=7).limit(PLAN_SAMPLE).collect()
        plan = make_plan(np.array([r["code"] for r in sample], dtype=np.int64).view(np.uint64), n, distance)
        found = components(links(distinct, plan, distance), staging)
        found = staging.put(found, "components", keep=True)
    of = distinct.join(found, distinct["code"] == found["node"], "left").select(
        "code", "smallest", F.coalesce("root", "code").alias("root")
    )
    smallest = of.groupBy("root").agg(F.min("smallest").alias("component_id"))
    return coded.join(of.join(smallest, "root").select("code", "root", "component_id"), "code")


def near_duplicates(docs: DataFrame, width: int = 3, distance: int = 3) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row of ``docs``."""
    digits = F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint")
    return grouped(docs, width, distance).select("doc_id", digits, "component_id")


def op4_simhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(tables.table(spark, sf_dir, "documents"), width=3, distance=3)



def stage(spark, docs: DataFrame, sf_dir: str, width: int = 3, distance: int = 3) -> DataFrame:
    """Pipeline stage: one row of each component stays, that with the smallest id (no id: the last); of rows with one
    id the one whose text has the smallest hash, of rows that are equal in both the first by their other columns."""
    tables.ship(spark)
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
    last = F.lit((1 << 63) - 1)
    leaders = grouped(docs, width, distance).groupBy("root").agg(
        F.min(F.struct(F.coalesce("doc_id", last).alias("id"), "mark")).alias("leader")
    )
    keyed = docs.withColumns({"_id": F.coalesce("doc_id", last), "_mark": F.xxhash64("text")})
    kept = keyed.join(leaders.select("leader.*").toDF("_id", "_mark"), ["_id", "_mark"], "left_semi")
    order = Window.partitionBy("_id", "_mark").orderBy("lang", "source", "n_chars")
    return kept.withColumn("_turn", F.row_number().over(order)).filter("_turn = 1").drop("_id", "_mark", "_turn")
