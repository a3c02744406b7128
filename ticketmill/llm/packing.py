"""Best-fit packing: token sequences of one length limit from documents of any length.

Documents are encoded in Arrow batches and cut into pieces. Only how many pieces there are of each
length (at most `capacity` numbers) reaches the driver, where bin completion finds which lengths go
together and how often. Every piece is numbered among those of its length without a global sort, and
its number gives its sequence and place. So the plan is as large as the limit, whatever the corpus.
"""

from __future__ import annotations

import base64
import random
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ticketmill.llm.arrays import SPACE, expanded, owners, range_hashes, slices, text_bytes
from ticketmill.llm.storage import kept

CAPACITY = 1024
END = 2
#: Pieces that are numbered in one group, on average at most.
NUMBERED = 20_000
#: Slots of a plan that are sent to every task; each is six numbers. A larger plan is joined by shuffle.
BROADCAST_ROWS = 200_000
#: Fillings that one search for the best completion looks at.
FILLINGS = 600
#: Steps of the search that may undo choices, once few enough bins are left for it to matter.
BRANCHES = 300
BRANCH_BINS = 40
#: Groups of bins that are completed anew until the bound is met, the largest group, and steps for one.
GROUPS = 6_000
GROUP_BINS = 24
GROUP_STEPS = 60

# ---------------------------------------------------------------- tokens


@cache
def rank_encoding(ranks: str) -> tiktoken.Encoding:
    """The vocabulary of a rank file, once for each worker."""
    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
    )


@cache
def encoders(vocabulary: str, ranks: str) -> tuple[Tokenizer, tiktoken.Encoding, np.ndarray]:
    """(tokenizer, the same vocabulary as ranks, bytes of each id), once for each worker."""
    fast = rank_encoding(ranks)
    sizes = [len(fast.decode_single_token_bytes(i)) for i in range(fast.n_vocab)]
    return Tokenizer.from_file(vocabulary), fast, np.array(sizes, np.int64)


#: UTF-8 beginnings of characters beyond ASCII that the pattern may count as white space.
WIDE_SPACES = {0xC285, 0xC2A0, 0xE19A, 0xE280, 0xE281, 0xE380}


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places where texts can be cut without a change of their ids: before white space that follows
    something else, since the pattern takes white space together with what comes after it."""
    space = SPACE[data]
    cut = np.zeros(len(data), bool)
    cut[1:] = space[1:] & ~space[:-1]
    wide = np.flatnonzero(cut)
    wide = wide[data[wide - 1] >= 128]
    if len(wide):
        codes = data.astype(np.uint16)
        two = (codes[wide - 2] << 8) | codes[wide - 1]
        three = (codes[np.maximum(wide - 3, 0)] << 8) | codes[wide - 2]
        cut[wide[np.isin(two, list(WIDE_SPACES)) | np.isin(three, list(WIDE_SPACES))]] = False
    cut[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(cut)


def wide_end(chunk: bytes) -> bool:
    if chunk[0] < 128 and chunk[-1] < 128:
        return chunk.isspace()
    text = chunk.decode()
    return text[0].isspace() and chunk[0] >= 128 or text[-1].isspace() or text.isspace()


def encoded(column: pa.Array, vocabulary: str, ranks: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts one after the other, where each text's begin and the last end).

    Each distinct chunk of the batch is encoded once. The ids are those of the tokenizer for the whole
    text; chunks with one of its special strings go through it, all others through the rank table.
    """
    exact, fast, sizes = encoders(vocabulary, ranks)
    specials = [t.content.encode() for t in exact.get_added_tokens_decoder().values()]
    data, offsets = text_bytes(column)
    starts = chunk_starts(data, offsets)
    ends = np.append(starts[1:], len(data))
    hashes = range_hashes(data, starts, ends)
    _, one, which = np.unique(hashes, return_index=True, return_inverse=True)
    raw = data.tobytes()
    chunks = [raw[s:e] for s, e in zip(starts[one].tolist(), ends[one].tolist())]
    # A chunk that begins without white space gets a line feed, which is a token of its own there.
    # Chunks of white space only, or with some beyond ASCII at an end, are encoded on their own.
    bare = ~SPACE[data[starts[one]]]
    special = [s for s in specials if s in raw]
    alone = np.array([wide_end(c) or any(s in c for s in special) for c in chunks], bool)
    joined = [(b"\n" + c if b else c) for c, b, a in zip(chunks, bare, alone) if not a]
    ids = fast.encode_to_numpy(b"".join(joined).decode(), disallowed_special=()).astype(np.uint32)
    reach = np.concatenate([[0], np.cumsum(sizes[ids])])
    bounds = np.concatenate([[0], np.cumsum([len(c) for c in joined])]).astype(np.int64)
    edges = np.searchsorted(reach, bounds)
    begin = np.zeros(len(chunks), np.int64)
    count = np.zeros(len(chunks), np.int64)
    begin[~alone] = edges[:-1] + bare[~alone]
    count[~alone] = np.diff(edges) - bare[~alone]
    lonely = [exact.encode(chunks[i].decode(), add_special_tokens=False).ids
              for i in np.flatnonzero(alone)]
    lengths = np.array([len(x) for x in lonely], np.int64)
    begin[alone] = len(ids) + np.cumsum(lengths) - lengths
    count[alone] = lengths
    ids = np.concatenate([ids, np.array([y for x in lonely for y in x], np.uint32)])
    of_text = owners(offsets[:-1], starts)
    flat = ids[expanded(begin[which], count[which])]
    total = np.bincount(of_text, weights=count[which], minlength=len(column)).astype(np.int64)
    return flat, np.concatenate([[0], np.cumsum(total)])


PIECE = "piece: int, start: bigint, length: bigint, ids_crc32: bigint"


def pieces(column: pa.Array, capacity: int, vocabulary: str, ranks: str, ids: bool) -> pa.Array:
    """The pieces of each text, with END as its last id; all but the first have `capacity` ids."""
    flat, edges = encoded(column, vocabulary, ranks)
    texts = len(column)
    stream = np.insert(flat, edges[1:], END).astype("<u4")
    edges = edges + np.arange(texts + 1)
    n = np.diff(edges)
    count = -(-n // capacity)
    owner = np.repeat(np.arange(texts), count)
    piece = expanded(np.zeros(texts, np.int64), count)
    end = n[owner] - (count[owner] - 1 - piece) * capacity
    start = np.maximum(end - capacity, 0)
    low, high = edges[owner] + start, edges[owner] + end
    view = memoryview(stream).cast("B")
    crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(low.tolist(), high.tolist())]
    fields = [
        pa.array(piece, pa.int32()),
        pa.array(start, pa.int64()),
        pa.array(end - start, pa.int64()),
        pa.array(np.array(crc, np.int64), pa.int64()),
    ]
    names = ["piece", "start", "length", "ids_crc32"]
    if ids:
        inner = np.append(low, len(stream)).astype(np.int32)
        fields.append(pa.ListArray.from_arrays(pa.array(inner), pa.array(stream.view(np.int32))))
        names.append("ids")
    rows = pa.StructArray.from_arrays(fields, names)
    offsets = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), rows)


# ---------------------------------------------------------------- plan


def completions(
    counts: dict[int, int], room: int, limit: int, perfect: int = 4, long_first: bool = False
) -> list[tuple[int, ...]]:
    """Undominated fillings of `room` from the lengths at hand, the fullest first; of equally full ones,
    those of short lengths, or with `long_first` of long ones.

    A filling is dominated if one of its lengths, or the free room, can take a longer length at hand
    instead: the longer one is harder to place later. The search takes lengths in falling order and adds
    while something fits. It ends after `limit` steps, or with `perfect` fillings that leave nothing free.
    """
    lengths = sorted((x for x, n in counts.items() if n and x <= room), reverse=True)
    rising = lengths[::-1]
    found: set[tuple[int, tuple[int, ...]]] = set()
    steps = full = 0

    def extend(i: int, left: int, chosen: tuple[int, ...]) -> bool:
        nonlocal steps, full
        steps += 1
        i = max(i, len(lengths) - bisect_right(rising, left))
        if i == len(lengths):  # nothing else fits
            found.add((left, chosen))
            full += not left
        for j in range(i, len(lengths)):
            x = lengths[j]
            for k in range(min(counts[x], left // x), 0, -1):
                if extend(j + 1, left - k * x, chosen + (x,) * k):
                    return True
        return steps > limit or full >= perfect

    extend(0, room, ())

    def dominated(rest: int, filling: tuple[int, ...]) -> bool:
        used = Counter(filling)
        for x in used:
            for y in lengths:
                if y <= x:
                    break
                if y <= x + rest and counts[y] > used[y]:
                    return True
        return False

    ranked = sorted(found, key=lambda x: (x[0], [-y for y in x[1]] if long_first else x[1]))
    return [f for rest, f in ranked if not dominated(rest, f)] or [ranked[0][1]]


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Bins by best-fit decreasing: each length, from the longest, into the fullest bin with room.
    Equal bins are handled together, so the work follows the number of lengths."""
    open_bins: dict[tuple[int, ...], int] = {}
    by_room: dict[int, list[tuple[int, ...]]] = {}

    def add(bin_: tuple[int, ...], n: int) -> None:
        if bin_ not in open_bins:
            by_room.setdefault(capacity - sum(bin_), []).append(bin_)
            open_bins[bin_] = 0
        open_bins[bin_] += n

    for x in sorted((x for x, n in counts.items() if n), reverse=True):
        n = counts[x]
        while n:
            room = next((r for r in range(x, capacity + 1) if by_room.get(r)), None)
            if room is None:
                full, rest = divmod(n, capacity // x)
                if full:
                    add((x,) * (capacity // x), full)
                if rest:
                    add((x,) * rest, 1)
                break
            bin_ = by_room[room][-1]
            m, each = open_bins[bin_], min(room // x, n)
            many = min(m, n // each)
            if many == m:
                by_room[room].remove(bin_)
                del open_bins[bin_]
            else:
                open_bins[bin_] -= many
            add(bin_ + (x,) * each, many)
            n -= many * each
    return list(open_bins.items())


def waste_bound(counts: dict[int, int], capacity: int) -> int:
    """No packing has fewer bins: all lengths by volume, and those over half need one each."""
    volume = sum(x * n for x, n in counts.items())
    halves = sum(n for x, n in counts.items() if 2 * x > capacity)
    return max(-(-volume // capacity), halves)


def least_bins(counts: dict[int, int], capacity: int) -> int:
    """The largest of the waste bounds without the lengths below k, for every k up to half the capacity.
    Lengths over capacity - k then share a bin with nothing, the others over half only with what is left."""
    best = waste_bound(counts, capacity)
    lengths = [x for x, n in counts.items() if n]
    for k in sorted(x for x in lengths if 2 * x <= capacity):
        alone = sum(counts[x] for x in lengths if x > capacity - k)
        rest = {x: counts[x] for x in lengths if k <= x <= capacity - k}
        best = max(best, alone + waste_bound(rest, capacity))
    return best


def n_bins(plan: list[tuple[tuple[int, ...], int]]) -> int:
    return sum(n for _, n in plan)


def bin_completion(
    counts: dict[int, int], capacity: int = CAPACITY
) -> list[tuple[tuple[int, ...], int]]:
    """[(lengths of a bin, how many such bins)] with as few bins as the search finds.

    Bins are completed around the longest length left, by the undominated filling that wastes least,
    as many alike as the counts allow. Best-fit decreasing gives the incumbents: of all lengths at the
    start, of the rest at every branch. A branch is left once its bins and the waste bound of its rest
    reach the incumbent. While many bins are left, the first choice is followed; for the last BRANCH_BINS, all
    choices are searched, the best first, for up to BRANCHES steps. A plan above the bound is then completed anew
    in small groups of its bins (`regrouped`). The bound met, the plan is optimal; otherwise the best known.
    """
    left = {x: n for x, n in counts.items() if n}
    return regrouped(first_plan(left, capacity), least_bins(left, capacity), capacity)


def first_plan(left: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """The better of best-fit decreasing and bin completion that branches over its last bins."""
    done: list[tuple[tuple[int, ...], int]] = []
    incumbent = best_fit(left, capacity)
    bound = waste_bound(left, capacity)
    while left and n_bins(incumbent) > bound:
        if waste_bound(left, capacity) <= BRANCH_BINS:
            rest = branch(left, capacity, n_bins(incumbent) - n_bins(done))
            if rest is not None:
                incumbent = done + rest
            return incumbent
        bin_ = fullest(left, capacity)
        many = min(left[x] // k for x, k in Counter(bin_).items())
        done.append((bin_, many))
        left = without(left, bin_, many)
    return done if not left and n_bins(done) < n_bins(incumbent) else incumbent


def fullest(left: dict[int, int], capacity: int) -> tuple[int, ...]:
    x = max(left)
    rest = without(left, (x,), 1)
    return (x, *completions(rest, capacity - x, FILLINGS)[0])


def without(counts: dict[int, int], bin_: tuple[int, ...], many: int) -> dict[int, int]:
    left = dict(counts)
    for x, k in Counter(bin_).items():
        left[x] -= k * many
        if not left[x]:
            del left[x]
    return left


def branch(
    counts: dict[int, int], capacity: int, limit: int
) -> list[tuple[tuple[int, ...], int]] | None:
    """A packing of fewer than `limit` bins, the best that BRANCHES steps find; None if none."""
    best: list[tuple[int, ...]] | None = None
    steps = 0
    bound = waste_bound(counts, capacity)

    def search(left: dict[int, int], used: list[tuple[int, ...]]) -> bool:
        nonlocal best, steps, limit
        steps += 1
        if not left:
            best, limit = list(used), len(used)
            return limit <= bound
        if len(used) + waste_bound(left, capacity) >= limit:
            return False
        greedy = best_fit(left, capacity)
        if len(used) + n_bins(greedy) < limit:
            best = used + [bin_ for bin_, n in greedy for _ in range(n)]
            limit = len(best)
            if limit <= bound:
                return True
        x = max(left)
        rest = without(left, (x,), 1)
        for filling in completions(rest, capacity - x, FILLINGS // 4):
            if search(without(rest, filling, 1), used + [(x, *filling)]) or steps > BRANCHES:
                return True
        return False

    search(counts, [])
    return None if best is None else list(Counter(best).items())


def regrouped(
    plan: list[tuple[tuple[int, ...], int]], bound: int, capacity: int
) -> list[tuple[tuple[int, ...], int]]:
    """The plan with groups of its bins completed anew, until it has `bound` bins or after GROUPS groups.

    Half of a group are bins with much free room, half any bins. It is replaced if bin completion needs fewer
    bins for it, or as many with the free room more in one place; so room gathers until a bin is saved. What
    is found for a group is done for as many like it as there are. The choice is drawn with a fixed seed.
    """
    draw = random.Random(capacity)
    bins = Counter(dict(plan))
    total = n_bins(plan)
    tried = 0

    def room(bin_: tuple[int, ...]) -> int:
        return capacity - sum(bin_)

    while total > bound and tried < GROUPS:
        kinds = [b for b in sorted(bins) if len(b) > 1 or room(b)]
        if len(kinds) < 2:
            break
        loose = sorted(kinds, key=lambda b: -(draw.random() ** (1 / (room(b) + 0.5))))
        draw.shuffle(kinds)
        at = 0
        while at < max(len(loose) // 4, 1) and total > bound and tried < GROUPS:
            half = draw.randint(1, GROUP_BINS // 2)
            group = {b for b in (*loose[at : at + half], *kinds[at : at + half]) if bins[b]}
            at += half
            tried += 1
            if len(group) < 2:
                continue
            pieces_ = dict(Counter(x for b in group for x in b))
            new = completed(pieces_, capacity, len(group), draw.random() < 0.5)
            if new is None:
                continue
            gathered = sum(room(b) ** 2 for b in new) >= sum(room(b) ** 2 for b in group)
            if len(new) == len(group) and (not gathered or set(new) == group):
                continue
            many = min(bins[b] for b in group)
            for b in group:
                bins[b] -= many
                if not bins[b]:
                    del bins[b]
            for b in new:
                bins[b] += many
            total -= many * (len(group) - len(new))
    return sorted(bins.items(), reverse=True)


def completed(
    counts: dict[int, int], capacity: int, limit: int, long_first: bool
) -> list[tuple[int, ...]] | None:
    """At most `limit` bins for these lengths by bin completion, the first that GROUP_STEPS steps find."""
    steps = 0

    def search(left: dict[int, int], used: list[tuple[int, ...]]) -> list[tuple[int, ...]] | None:
        nonlocal steps
        steps += 1
        if not left:
            return used
        if len(used) + waste_bound(left, capacity) > limit:
            return None
        x = max(left)
        rest = without(left, (x,), 1)
        for filling in completions(rest, capacity - x, FILLINGS // 2, 1, long_first):
            found = search(without(rest, filling, 1), [*used, (x, *filling)])
            if found is not None or steps > GROUP_STEPS:
                return found
        return None

    return search(counts, [])


def slots(plan: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, sequences, offset): by their ranks from the first
    on, pieces of that length go round the sequences, each round one place further in them."""
    taken: Counter = Counter()
    rows, base = [], 0
    for bin_, many in plan:
        offset = 0
        for x, k in sorted(Counter(bin_).items(), reverse=True):
            rows.append((x, taken[x], taken[x] + k * many, base, many, offset))
            taken[x] += k * many
            offset += k * x
        base += many
    return rows


def pack(
    docs: DataFrame,
    vocabulary: str,
    ranks: str,
    capacity: int = CAPACITY,
    text: str = "text",
    id: str = "doc_id",
    ids: bool = False,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset[, ids]): one row for each piece.

    vocabulary and ranks are files of the same tokens. Null and empty texts are one piece with the end
    id alone. Repeated rows, also with null ids, are packed one by one; further columns are ignored. An
    empty table packs into nothing. Sequence numbers run from 0 without gaps, for the same rows they
    are the same in each run up to rows that agree in id and text.
    """

    @F.arrow_udf(f"array<struct<{PIECE}{', ids: array<int>' if ids else ''}>>")
    def cut(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            parts = [pieces(part, capacity, vocabulary, ranks, ids) for part in slices(column)]
            yield pa.concat_arrays(parts) if parts else pieces(column, capacity, vocabulary, ranks, ids)

    rows = docs.select(F.col(id).alias("doc"), F.inline(cut(F.col(text))))
    rows = kept(rows, "pieces")
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = slots(bin_completion(counts, capacity))
    buckets = max(64, -(-sum(counts.values()) // NUMBERED))

    # A hot length is spread over buckets; each numbers its own rows from where the last one ends.
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc", "piece", "ids_crc32"), F.lit(buckets)))
    order = F.expr("row_number() OVER (PARTITION BY length, bucket ORDER BY doc, piece, ids_crc32)")
    sizes = rows.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = sizes.select(
        "length", "bucket",
        F.expr("sum(n) OVER (PARTITION BY length ORDER BY bucket) - n").alias("before"),
    )
    ranked = rows.withColumn("row", order).join(before, ["length", "bucket"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("row") - 1)
    table = docs.sparkSession.createDataFrame(
        plan, "slot_length bigint, low bigint, high bigint, base bigint, many bigint, offset bigint"
    )
    placed = ranked.join(
        F.broadcast(table) if len(plan) <= BROADCAST_ROWS else table,
        (F.col("length") == F.col("slot_length"))
        & (F.col("rank") >= F.col("low"))
        & (F.col("rank") < F.col("high")),
    )
    nth = F.col("rank") - F.col("low")
    out = [
        F.col("doc").alias(id),
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("base") + nth % F.col("many")).alias("sequence_id"),
        (F.col("offset") + F.floor(nth / F.col("many")) * F.col("length")).alias("offset"),
    ]
    return placed.select(*out, *(["ids"] if ids else []))
