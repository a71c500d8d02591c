"""Periodic runs of words: Lyndon roots under both orders, extended into maximal repetitions.

The first phase of grouping suffix sorting puts the positions of a text in groups
by their first word and takes the groups from the greatest down. A position of the
group at hand leaves the list of open positions; the open one to its left is thereby
continued by one more copy of the group's word sequence, and moves to a group just
above its own. When a position leaves, the next open one to its right is where its
longest Lyndon word ends. So the phase gives the Lyndon array directly, without
sorting suffixes; it is run with the words in either order.

Every run has a root that is the longest Lyndon word of a position under one of the
orders. Each such word is extended to both sides as far as the text keeps its length
as a period: the longest common extensions of all positions are searched at once by
prefix hashes, and every run found is compared word by word before it counts.

In a run of at least four periods every three consecutive words occur three times at
least. Stretches of a text where that fails hold no run and are left out beforehand;
this leaves out no run and decides about none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapforge.llm.common import appended, texts_of, words_of

#: A run has so many words and so many periods at least.
LEAST_WORDS, LEAST_PERIODS = 6, 4
RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
_RUN = pa.struct([pa.field(name, pa.int64()) for name in ("start", "length", "period")])
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD[0]
    return x ^ (x >> np.uint64(29))


def _stretches(codes: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of stretches, inside parts, in which each three words occur three times at least in their part."""
    if len(codes) < LEAST_WORDS:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    c = codes.astype(np.uint64)
    key = _mix(c[:-2] * _ODD[1] ^ _mix(c[1:-1] * _ODD[2] ^ _mix(c[2:] * _ODD[3] ^ part[2:].astype(np.uint64))))
    good = part[:-2] == part[2:]
    ranked = np.sort(key[good])
    often = np.unique(ranked[2:][ranked[2:] == ranked[:-2]]) if len(ranked) > 2 else ranked[:0]
    if len(often) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    good &= often[np.minimum(np.searchsorted(often, key), len(often) - 1)] == key
    edge = np.flatnonzero(np.diff(np.concatenate([[False], good, [False]]).astype(np.int8)))
    begin, end = edge[::2], edge[1::2] + 2
    long = end - begin >= LEAST_WORDS
    return begin[long], end[long]


def _laid_out(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the stretches one after another, and the stretch of each."""
    size = end - begin
    first = np.cumsum(size) - size
    part = np.repeat(np.arange(len(size)), size)
    return np.arange(size.sum()) - first[part] + begin[part], part


def lyndon(codes: list[int]) -> list[int]:
    """Length of the longest Lyndon word of each position; negative codes, also at both ends, stop every word and get 0."""
    n = len(codes)
    left, right, size = list(range(-1, n - 1)), list(range(1, n + 1)), [0] * n
    first: dict[int, list[int]] = {}
    for i, c in enumerate(codes):
        if c >= 0:
            first.setdefault(c, []).append(i)
    members = [first[c] for c in sorted(first)]
    group = [-1] * n
    for g, positions in enumerate(members):
        for i in positions:
            group[i] = g
    below, above = list(range(-1, len(members) - 1)), list(range(1, len(members) + 1))
    above.append(-1)  # a place above the topmost group
    g = len(members) - 1
    below.append(g)
    members.append([])
    while g >= 0:
        copies: dict[int, int] = {}
        for i in sorted(members[g]):
            if group[i] != g:
                continue
            a, b = left[i], right[i]
            size[i] = b - i
            right[a], left[b] = b, a
            if codes[a] >= 0:
                copies[a] = copies.get(a, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for i, k in copies.items():
            moved.setdefault((group[i], k), []).append(i)
        for h, k in sorted(moved, reverse=True):
            x = len(members)
            members.append(moved[h, k])
            for i in moved[h, k]:
                group[i] = x
            over = above[h]
            below.append(h)
            above.append(over)
            above[h], below[over] = x, x
        members[g] = []
        g = below[g]
    return size


class _Extension:
    """Longest common extensions of positions a period apart, by prefix hashes modulo 2**64."""

    def __init__(self, codes: np.ndarray) -> None:
        self.n = len(codes)
        self.power = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(self.n, _ODD[2], dtype=np.uint64))])
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(codes.astype(np.int64).view(np.uint64) * _ODD[1]) * self.power[:-1])])

    def _same(self, i: np.ndarray, p: np.ndarray, size: np.ndarray) -> np.ndarray:
        j = i + p
        return (self.sums[i + size] - self.sums[i]) * self.power[p] == self.sums[j + size] - self.sums[j]

    def reach(self, i: np.ndarray, p: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
        """Words that agree from i and i + p on, and those before them; never fewer than there are."""
        after, before = np.zeros_like(i), np.zeros_like(i)
        for k in reversed(range(max(1, longest).bit_length())):
            step = after + (1 << k)
            at = np.flatnonzero(i + p + step <= self.n)
            at = at[self._same(i[at], p[at], step[at])]
            after[at] = step[at]
            step = before + (1 << k)
            at = np.flatnonzero(i - step >= 0)
            at = at[self._same(i[at] - step[at], p[at], step[at])]
            before[at] = step[at]
        return after, before


def _exact(codes: np.ndarray, i: int, p: int) -> tuple[int, int]:
    """Begin and end of the stretch around i with period p, by comparing words."""
    differ = np.flatnonzero(codes[:-p] != codes[p:])
    k = int(np.searchsorted(differ, i))
    return (int(differ[k - 1]) + 1 if k else 0), (int(differ[k]) if k < len(differ) else len(codes) - p) + p


def _enough(begin: np.ndarray, end: np.ndarray, p: np.ndarray) -> np.ndarray:
    return end - begin >= np.maximum(LEAST_WORDS, LEAST_PERIODS * p)


def find_runs(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and period of all runs in texts of ``codes`` (not negative) bounded by ``ends``, by begin, then period."""
    at, part = np.arange(len(codes)), np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    while True:
        begin, end = _stretches(codes[at], part)
        place, part = _laid_out(begin, end)
        whole = len(place) == len(at)
        at = at[place]
        if whole or len(at) == 0:
            break
    none = np.zeros(0, np.int64)
    if len(at) == 0:
        return none, none, none
    # a stop of its own before each stretch and one at the end
    slot = np.arange(len(at)) + part + 1
    laid = -1 - np.arange(len(at) + part[-1] + 2)
    origin = np.full(len(laid), -1)
    laid[slot], origin[slot] = np.unique(codes[at], return_inverse=True)[1], at
    longest = int(np.bincount(part).max())
    search, top, found = _Extension(laid), int(laid.max()), []
    for order in (laid, np.where(laid >= 0, top - laid, -1)):
        p = np.asarray(lyndon(order.tolist()), dtype=np.int64)
        i = np.flatnonzero((p > 0) & (p * LEAST_PERIODS <= longest))
        p = p[i]
        after, before = search.reach(i, p, longest)
        b, e = i - before, i + p + after
        ok = _enough(b, e, p)
        found.append(np.stack([b, e, p, i])[:, ok])
    b, e, p, i = np.concatenate(found, axis=1)
    _, once, same = np.unique(np.stack([b, p]), axis=1, return_index=True, return_inverse=True)
    same = same.ravel()
    for k, c in enumerate(once.tolist()):
        if not np.array_equal(laid[b[c] : e[c] - p[c]], laid[b[c] + p[c] : e[c]]):  # two hashes met, so these may be several runs
            for c in np.flatnonzero(same == k).tolist():
                b[c], e[c] = _exact(laid, int(i[c]), int(p[c]))
    ok = _enough(b, e, p)
    runs = np.unique(np.stack([origin[b[ok]], p[ok], e[ok] - b[ok]]), axis=1)
    return runs[0], runs[0] + runs[2], runs[1]


def _work(batch: pa.RecordBatch) -> list[pa.Array]:
    ends, codes, words = words_of(texts_of(batch), lower=False)
    begin, end, period = find_runs(codes, ends)
    text = np.searchsorted(ends, begin, side="right") - 1
    change = np.zeros(len(codes) + 1, np.int64)
    np.add.at(change, begin + period, 1)
    np.add.at(change, end, -1)
    keep = np.cumsum(change[:-1]) == 0
    kept = np.concatenate([[0], np.cumsum(keep)])[ends].astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(kept), words.take(pa.array(codes[keep])))
    structs = pa.StructArray.from_arrays([pa.array(begin - ends[text]), pa.array(end - begin), pa.array(period)], fields=list(_RUN))
    bounds = np.searchsorted(text, np.arange(batch.num_rows + 1)).astype(np.int32)
    return [pa.ListArray.from_arrays(pa.array(bounds), structs), pc.binary_join(lists, " ")]


def find(docs: DataFrame) -> DataFrame:
    """``docs`` (with a column ``text``) and, for each row, ``runs`` (start in words from 0, length, period; by start, then period)
    and ``collapsed``, the words that no run holds beyond its first period, joined by one space.

    A null text counts as the empty one: no runs, an empty collapsed text. Repeated rows are handled each. A text is handled
    whole in one task, in time and memory that follow its words. Columns named ``runs`` or ``collapsed`` are replaced.
    """
    return appended(docs, [T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())], _work)


def planted(doc_id: Column, text: Column, docs: DataFrame) -> DataFrame:
    """doc_id and text; of about every tenth id (crc32, a null id as the empty text) the words from some place on repeat with a period."""
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    words = F.when(F.expr("h % 10 = 0"), F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    cut = docs.select(doc_id.alias("doc_id"), text.alias("text"), h.alias("h")).withColumn("words", words).withColumn("n", F.coalesce(F.size("words"), F.lit(-1)))
    cut = cut.withColumn("a", F.expr("if(n > 0, int(pmod(h div 10, n)), 0)")).withColumn("p", F.expr("int(1 + (n - a) div (3 + (h div 10) % 8))"))
    tail = F.expr("slice(flatten(array_repeat(slice(words, a + 1, p), int((n - a + p - 1) div p))), 1, n - a)")
    return cut.select("doc_id", F.when(F.col("n") > 0, F.array_join(F.concat(F.expr("slice(words, 1, a)"), tail), " ")).otherwise(F.col("text")).alias("text"))


def query(docs: DataFrame) -> DataFrame:
    found = find(planted(F.col("doc_id"), F.col("text"), docs))
    best = F.expr("aggregate(runs, cast(null as struct<start: bigint, length: bigint, period: bigint>), (m, r) -> if(m is null or r.length * m.period > m.length * r.period, r, m))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
