"""Best-fit packing of token sequences, improved by swap-based local search.

Documents are tokenised, closed by an end id and, where longer than a sequence,
cut into full pieces and a rest. Pieces are dealt into shards of bounded size.
A shard is packed best-fit, longest first; then the emptiest bin hands pieces to
other underfull bins - by moves, one-for-one and two-for-one exchanges, each of
which raises the sum of squared fills - until it is empty or nothing helps. What
then lies in underfull bins of all shards is dealt out and packed anew, until one
shard has held all of it or it hardly shrinks.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapforge.llm.common import give_back, ready, text_slices, texts_of, words_of, written

CAPACITY = 4_096
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
SHARD = 4_096
UNDERFULL = 0.97
#: Underfull bins are dealt out anew until they hold more than this share of the pieces dealt.
STUCK = 0.9
MEMO = 500_000
_SLICE = 2_000_000

#: How the tokenizer cuts a lower-cased text.
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Chunks of these characters are neither changed by normalisation nor cut by unusual blanks.
_PLAIN = "^[!-~¡-įı-˿]+$"


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of runs, given where each begins and its size."""
    upto = np.cumsum(sizes)
    return np.repeat(starts - upto + sizes, sizes) + np.arange(upto[-1] if len(upto) else 0)


class Encoder:
    """Ids of texts by way of their distinct parts: chunks between blanks, cut as the tokenizer cuts them.

    Ids of parts are kept from batch to batch, of at most about ``MEMO`` parts. An encoder lives as long as its task.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.empty(0, dtype=np.uint32)
        self.size = np.empty(0, dtype=np.int64)

    def _places(self, parts: list[str]) -> np.ndarray:
        """Number of each part among the known ones; learns the missing ones."""
        if len(self.known) > MEMO:
            self._forget()
        known = self.known
        fresh = [p for p in parts if p not in known]
        if fresh:
            got = [e.ids for e in self.tokenizer.encode_batch_fast(fresh, add_special_tokens=False)]
            known.update(zip(fresh, range(len(self.size), len(self.size) + len(fresh)), strict=True))
            self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(got), dtype=np.uint32)])
            self.size = np.concatenate([self.size, np.fromiter(map(len, got), dtype=np.int64, count=len(got))])
        return np.fromiter(map(known.__getitem__, parts), dtype=np.int64, count=len(parts))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the bounds of each text in them."""
        ends, idx, chunks = words_of(texts, lower=False)
        plain = pc.and_(pc.match_substring_regex(chunks, _PLAIN), pc.invert(pc.match_substring(chunks, "<|")))
        cut = pc.replace_substring_regex(pc.utf8_lower(chunks), _CUT, r"\0 ")
        part_ends, part_idx, parts = words_of(pc.if_else(plain, cut, chunks), lower=False)
        place = self._places(parts.to_pylist())[part_idx]
        size = self.size[place]
        flat = self.ids[_spread((np.cumsum(self.size) - self.size)[place], size)]
        upto = np.concatenate([[0], np.cumsum(size)])
        start = upto[part_ends]
        lens = np.diff(start)[idx]
        return flat[_spread(start[:-1][idx], lens)], np.concatenate([[0], np.cumsum(lens)])[ends]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids): the pieces of every document.

    Null and empty texts are the end id alone. Only documents longer than
    ``capacity`` are cut. Repeated rows yield repeated pieces.
    """
    ready(docs.sparkSession)
    at = path or tokenizer_path()
    kind = dict(docs.dtypes)["doc_id"]
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(at)
        for batch in batches:
            for part in text_slices(batch, chars=_SLICE):
                ids, bounds = coder.encode(texts_of(part))
                rows: list[tuple[int, int, int, int, int]] = []
                cut: list[np.ndarray] = []
                for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                    own = np.append(ids[a:b], np.uint32(end_id)).astype("<u4")
                    for n, s in enumerate(range(0, len(own), capacity)):
                        piece = own[s : s + capacity]
                        rows.append((k, n, s, len(piece), zlib.crc32(piece.tobytes())))
                        if with_ids:
                            cut.append(piece.astype(np.int32))
                cols = np.array(rows, dtype=np.int64).reshape(-1, 5)
                out = [part.column("doc_id").take(pa.array(cols[:, 0])), pa.array(cols[:, 1].astype(np.int32)), *(pa.array(cols[:, c]) for c in (2, 3, 4))]
                yield pa.RecordBatch.from_arrays([*out, *([pa.array(cut, pa.list_(pa.int32()))] if with_ids else [])], names=names)
        del coder
        give_back()

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each piece: longest first, into the fullest bin that still has room."""
    bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, made = 0, 0
    out = np.empty(len(lengths), dtype=np.int64)
    for k in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[k])
        fits = rooms >> need
        if fits:
            room = need + (fits & -fits).bit_length() - 1
            b = bins[room].pop()
            if not bins[room]:
                rooms &= ~(1 << room)
        else:
            room, b, made = capacity, made, made + 1
        out[k] = b
        if room > need:
            bins[room - need].append(b)
            rooms |= 1 << (room - need)
    return out


def _amounts(own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct sums of one or two pieces, ascending, with the places of these pieces (the second is -1 for one alone).

    Two pieces of each length stand for all of it. A bin's lengths are distinct
    numbers of a bounded sum, so there are few whatever the number of pieces.
    """
    order = np.argsort(own, kind="stable")
    held = own[order]
    third = np.concatenate([[False, False], held[2:] == held[:-2]])[: len(held)]
    some = order[~third]
    i, j = np.triu_indices(len(some), 1)
    sums = np.concatenate([own[some], own[some[i]] + own[some[j]]])
    x, at = np.unique(sums, return_index=True)  # the first of equal sums: one piece rather than two
    return x, np.concatenate([some, some[i]])[at], np.concatenate([np.full(len(some), -1), some[j]])[at]


def _largest(x: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each bound the place in ascending ``x`` of its largest value within the bound, and the value (0: none)."""
    k = np.searchsorted(x, most, side="right") - 1
    return k, np.where(k >= 0, x[np.maximum(k, 0)], 0)


def _step(own: np.ndarray, sizes: np.ndarray, room: np.ndarray, bins: np.ndarray, free: np.ndarray) -> tuple[int, list[int], list[int], int] | None:
    """The exchange that shifts most from a donor: amount, places of pieces given and taken, receiving bin.

    ``own``: lengths in the donor; ``sizes``, ``room``, ``bins``: of pieces in other underfull bins; ``free``: room of each bin.
    Given are one piece or two, taken none, one, or (for one) two neighbours in order of length.
    """
    x, one, two = _amounts(own)
    given = lambda k: [int(one[k])] + [int(two[k])] * int(two[k] >= 0)
    best: tuple[int, list[int], list[int], int] | None = None
    k, amount = _largest(x, free)
    if len(amount) and amount.max() > 0:
        top = amount.max()
        to = np.flatnonzero(amount == top)
        to = int(to[free[to].argmin()])
        best = (int(top), given(k[to]), [], to)
    k, amount = _largest(x, sizes + room)
    amount = amount - sizes
    if len(amount) and amount.max() > (best[0] if best else 0):
        at = int(amount.argmax())
        best = (int(amount[at]), given(k[at]), [at], int(bins[at]))
    order = np.lexsort((sizes, bins))
    a, b = order[:-1], order[1:]
    same = bins[a] == bins[b]
    a, b = a[same], b[same]
    single = two < 0
    k, amount = _largest(x[single], sizes[a] + sizes[b] + room[a])
    amount = amount - sizes[a] - sizes[b]
    if len(amount) and amount.max() > (best[0] if best else 0):
        at = int(amount.argmax())
        best = (int(amount[at]), [int(one[single][k[at]])], [int(a[at]), int(b[at])], int(bins[a[at]]))
    return best


def local_search(lengths: np.ndarray, bins: np.ndarray, capacity: int) -> np.ndarray:
    """Empty underfull bins, the emptiest first, by exchanges that raise the sum of squared fills."""
    bins = bins.copy()
    stuck: set[int] = set()
    least = -(-int(lengths.sum()) // capacity)
    while True:
        fill = np.bincount(bins, weights=lengths).astype(np.int64)
        if np.count_nonzero(fill) <= least:
            return bins
        under = np.flatnonzero((fill > 0) & (fill < capacity))
        donors = [b for b in under[np.argsort(fill[under], kind="stable")].tolist() if b not in stuck]
        if not donors or len(under) < 2:
            return bins
        donor, before = donors[0], bins.copy()
        while True:
            free = np.where((fill > 0) & (fill < capacity), capacity - fill, 0)
            free[donor] = 0
            own = np.flatnonzero(bins == donor)
            if not len(own):
                stuck.clear()
                break
            others = np.flatnonzero(free[bins] > 0)
            found = _step(lengths[own], lengths[others], free[bins[others]], bins[others], free)
            # a receiver must be at least as full as the donor, or squares would fall
            if not found or fill[found[3]] + found[0] <= fill[donor] - found[0]:
                bins = before
                stuck.add(donor)
                break
            shift, give, got, to = found
            bins[own[give]] = to
            bins[others[got]] = donor
            fill[to] += shift
            fill[donor] -= shift


def pack(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece."""
    if not len(lengths):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    bins = local_search(lengths, best_fit(lengths, capacity), capacity)
    order = np.lexsort((np.arange(len(bins)), bins))
    upto = np.cumsum(lengths[order]) - lengths[order]
    first = np.concatenate([[True], np.diff(bins[order]) > 0])
    base = np.maximum.accumulate(np.where(first, upto, 0))
    offset = np.empty(len(bins), dtype=np.int64)
    offset[order] = upto - base
    return bins, offset


def _deal(rows: DataFrame, count: int, capacity: int, level: int) -> DataFrame:
    """Pack shards side by side; adds sequence_id, offset and ``again``: whether the bin is underfull."""
    shards = max(1, -(-count // SHARD))
    kept = [c for c in rows.columns if c not in ("shard", "sequence_id", "offset", "again")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*kept).schema) + ", sequence_id long, offset long, again boolean"

    def work(key: tuple[int], got: pd.DataFrame) -> pd.DataFrame:
        got = got.sort_values("uid", kind="stable")
        lengths = got["length"].to_numpy(dtype=np.int64)
        bins, offset = pack(lengths, capacity)
        fill = np.bincount(bins, weights=lengths)
        base = (level * (1 << 31) + int(key[0])) * (1 << 24)
        return got[kept].assign(sequence_id=base + bins, offset=offset, again=fill[bins] < UNDERFULL * capacity)

    shard = F.pmod(F.xxhash64("uid", F.lit(level)), F.lit(shards)).alias("shard")
    return rows.select(*kept, shard).groupBy("shard").applyInPandas(work, schema)


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces. ``cut`` is a table as read; its column ``length`` is 1 to ``capacity``.

    Every row is placed once, repeated rows too; offsets in a sequence are gapless from 0.
    """
    numbered = cut.withColumn("uid", F.monotonically_increasing_id())
    names = [*cut.columns, "sequence_id", "offset"]
    full = numbered.filter(F.col("length") == capacity).withColumn("sequence_id", -1 - F.col("uid")).withColumn("offset", F.lit(0).cast("long"))
    placed, rest, level = full.select(*names), numbered.filter(F.col("length") < capacity), 1
    count = rest.count()
    while True:
        dealt = written(_deal(rest, count, capacity, level), "packed")
        more = dealt.filter("again").count()
        # one shard has seen all that is left; dealing out anew ends where it hardly fills bins any more
        if not more or count <= SHARD or (level > 1 and more > STUCK * count):
            return placed.unionByName(dealt.select(*names))
        placed = placed.unionByName(dealt.filter("not again").select(*names))
        rest, count, level = dealt.filter("again"), more, level + 1


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id, ids: the sequences themselves, of pieces with ids; a group is one sequence."""
    runs = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("runs"))
    return runs.select("sequence_id", F.flatten(F.transform("runs", lambda r: r["ids"])).alias("ids"))


def query(docs: DataFrame) -> DataFrame:
    return place(written(pieces(docs), "pieces"))


def stage(docs: DataFrame) -> DataFrame:
    return query(docs)
