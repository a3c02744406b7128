"""Substring dedup: passages that documents share, word by word or nearly so.

Seeds are runs of four words, and of twelve, those with the smallest hash in each stretch of text. A seed brings a
few bits of each word around it. Every seed is compared with all its occurrences in earlier documents, but linked only
with its first and its last few, and with each one whose words around are alike further than those of any document
before that one: a passage of n documents gives some n matches of each seed, times a constant. Matches around which
too little can be alike go before they are sent on. The matches of two documents are chained in order with gap costs through a
Fenwick tree; chains, of one match too, are aligned word by word, cut where they are not alike enough, and grown at both ends; what is alike enough is a shared
span. Spans of one document that touch form a passage, whichever documents they are shared with.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import cache, reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.llm.arrays import (
    LOWER,
    SPACE,
    expanded,
    mixed,
    owners,
    range_hashes,
    runs,
    slices,
    text_bytes,
)
from ticketmill.llm.storage import free_shuffles, kept, kept_at, remove

SEED_WORDS = 4
#: A seed is taken from every run of so many seed places; so an exact run of WINDOW + 3 words has one.
WINDOW = 4
#: Longer seeds, taken from every run of so many places, lead to the right one of many documents that have
#: frequent short runs.
LONG_WORDS, LONG_WINDOW = 12, 12
#: Last occurrences in earlier documents that an occurrence is linked with, besides the first of all and those that
#: furthest() finds.
PREVIOUS = 3
#: Rounds in which seeds are linked, by their hash, so that the disk holds the seeds of one round only.
SEED_ROUNDS = 2
#: Words on each side of a seed of which it carries bits, the bits, and the edits that growth may make there.
AROUND, AROUND_BITS, AROUND_EDITS = 8, 3, 2
#: Marks long seeds, in the second number of bits around a seed.
LONG = 1 << 62
#: Earlier places that a seed is compared with in the first step, four times as many in the next; pairs at a time.
FIRST_STEP, PAIRS = 16, 1 << 17
#: Earlier places of a row from which on those that may be linked with it are looked up; the places of a step from which on
#: that is by one word more; those found from which on it is tried by one more; and what tables for it hold at a time.
LOOKED_UP, LOOKED_UP_BY, MANY, HELD = 80, (0, 0, 4096, 65536), 128, 1 << 23
#: What a comparison costs in steps of making a table for that, or in eighths of looking a row up.
WORTH = 3
#: Rounds in which chains are aligned, by a hash of their texts.
ALIGN_ROUNDS = 2
SIMILARITY = 0.8
MIN_WORDS = 50
#: Words of a span, once aligned and grown, that can be part of a passage: shorter ones meet by chance.
SPAN_WORDS = 12
#: Words that may be repeated over and over, and the rounds in which they are told apart.
PERIOD, ROUNDS = 16, 32
#: Cost of a word between matches, on either side; a match gains its own words.
GAP_COST = 0.1
#: A match at the same distance that begins fewer words after the last one always follows it in the chain.
NEXT_WORDS = int(SEED_WORDS + SEED_WORDS / (2 * GAP_COST))
#: Words around a chain that alignment may grow into. A passage may have edits in most of its seeds.
PAD = 64
#: Words that an edit costs a growing chain, and the loss at which it stops growing.
EDIT_COST, GROWTH_DROP = 3.0, 12.0
#: Spans at most so far apart belong to one passage.
JOIN_WORDS = 2
#: Null ids stand here, after all others, each text of its own.
NULL_ID = 1 << 62


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end, text) of each lower-cased word."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    starts, ends = runs(data, offsets, ~SPACE)
    return range_hashes(data, starts, ends), starts, ends, owners(offsets[:-1], starts)


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick() over values[i : i + width] for each i; short at the end."""
    done, out = 1, values.copy()
    while done < width:
        step = min(done, width - done)
        out[:-step] = pick(out[:-step], out[step:])
        done += step
    return out


def rounds(total: np.ndarray, whole: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """How often a run of words has just come round, modulo ROUNDS, for the runs that start at `whole`.

    Where a few words are repeated over and over, all runs would be one seed with one first place. Told
    apart by their rounds, they chain as other text does."""
    valid = np.zeros(len(total), bool)
    valid[whole] = True
    back = np.zeros(len(total), np.int64)
    some_bits = total.astype(np.uint32)
    for period in range(min(PERIOD, len(total) - 1), 0, -1):
        same = some_bits[period:] == some_bits[:-period]
        if not same.any():
            continue
        same = np.flatnonzero(same)  # few, in most texts
        same = same[total[same + period] == total[same]]
        same = same[valid[same + period] & valid[same] & (owner[same + period] == owner[same])]
        back[same + period] = period
    some = np.flatnonzero(back)
    if not len(some):
        return np.zeros(len(whole), np.uint64)
    count = np.zeros(len(total), np.int64)
    count[some] = 1
    before = np.arange(len(total)) - back
    while len(some) and count[before[some]].any():
        further = count[before[some]]
        count[some] += further
        before[some] = before[before[some]]
    count[some] %= ROUNDS
    return count[whole].astype(np.uint64)


def seeds(words: np.ndarray, owner: np.ndarray, n: int, width: int = SEED_WORDS,
          window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hash, number of the first word in all texts) of the seeds of n texts."""
    count = np.bincount(owner, minlength=n)
    begin = np.cumsum(count) - count
    # Texts are set apart by places that can't be chosen, so that none depends on its neighbours.
    place = np.arange(len(words)) + owner * window
    size = len(words) + (n + 1) * window
    none = np.uint64(2**64 - 1)
    # Words times powers of a number, the first word the highest; from the totals of shorter runs where that is exact.
    base, step = 0x9E3779B97F4A7C15, 4 if width % 4 == 0 else 1
    n_runs = max(0, len(words) - width + 1)
    quarter = np.zeros(max(0, len(words) - step + 1), np.uint64)
    for i in range(step):
        quarter = quarter * np.uint64(base) + words[i : i + len(quarter)]
    total = quarter[:n_runs]
    for i in range(step, width, step):
        total = total * np.uint64(pow(base, step, 1 << 64)) + quarter[i : i + n_runs]
    whole = np.flatnonzero(
        np.arange(len(total)) + width <= (begin + count)[owner[: len(total)]]
    )
    hashes = np.full(size, none)
    hashes[place[whole]] = mixed(total[whole] + rounds(total, whole, owner))
    lowest = _sliding(hashes, window, np.minimum)
    # Chosen: the lowest of some window that it lies in, so the highest of their lowest values.
    padded = np.concatenate([np.zeros(window - 1, np.uint64), lowest])
    chosen = _sliding(padded, window, np.maximum)[:size] == hashes
    taken = whole[chosen[place[whole]]]
    return hashes[place[taken]], taken


def around(words: np.ndarray, owner: np.ndarray, first: np.ndarray, width: int | np.ndarray = SEED_WORDS,
           skip: int = 0) -> np.ndarray:
    """AROUND_BITS, after the highest `skip`, of each of the AROUND words before and after the seeds at `first`, the
    nearest lowest; those before in the upper half. Where the text ends, 0."""
    code = (words << np.uint64(skip) >> np.uint64(64 - AROUND_BITS)).astype(np.int64)
    # AROUND zeros stand before each text and after the last one.
    lead = (owner + 1) * AROUND
    after = np.zeros(len(words) + AROUND + int(lead.max(initial=0)), np.int64)
    after[np.arange(len(words)) + lead] = code
    before, done = after.copy(), 1
    while done < AROUND:
        step = min(done, AROUND - done)
        after[:-step] |= after[step:] << AROUND_BITS * step
        before[step:] |= before[:-step] << AROUND_BITS * step
        done += step
    place = first + lead[first]
    return before[place - 1] << AROUND_BITS * AROUND | after[place + width]


#: Of each number with a group of AROUND_BITS for each of AROUND / 2 words: a bit for each group that is 0.
_EQUAL = sum(
    ((np.arange(1 << AROUND_BITS * AROUND // 2) >> AROUND_BITS * k) % (1 << AROUND_BITS) == 0).astype(np.int16) << k
    for k in range(AROUND // 2)
)
#: Of each mask of equal words, and each place: where the run of equal words from that place ends.
_RUN = np.zeros((1 << AROUND, AROUND + 1), np.int16)
_RUN[:, AROUND] = AROUND
for _place in reversed(range(AROUND)):
    _RUN[:, _place] = np.where(np.arange(1 << AROUND) >> _place & 1, _RUN[:, _place + 1], _place)


def reach(a: np.ndarray, b: np.ndarray, *further: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Words of `a`, from 0 to AROUND, that grown() may add at the cost of EDIT_COST, by the bits of the words on
    one side of two seeds each, and by `further` bits of the same words. Equal words have equal bits, so within AROUND
    words it is never too few. Words beyond them count as equal."""
    group, half = AROUND_BITS * AROUND, AROUND_BITS * AROUND // 2
    bits = [(x.astype(np.int32), y.astype(np.int32)) for x, y in ((a, b), *further)]
    run = _RUN.ravel()

    def mask(shift: int) -> np.ndarray:
        """A bit for each i for which word i of a may be word i - shift of b."""
        differ = 0
        for x, y in bits:
            other = y << AROUND_BITS * shift if shift > 0 else y >> AROUND_BITS * -shift
            differ = differ | (x ^ other)
        differ &= (1 << group) - 1
        equal = _EQUAL.take(differ & ((1 << half) - 1)) | _EQUAL.take(differ >> half) << AROUND // 2
        return (equal | ((1 << AROUND) - (1 << AROUND + min(shift, 0)))) * (AROUND + 1)

    masks = {d: mask(d) for d in range(-AROUND_EDITS, AROUND_EDITS + 1)}
    furthest = {0: run.take(masks[0])}
    best = furthest[0].copy()
    for edits in range(1, AROUND_EDITS + 1):
        reached = {}
        for d in range(-edits, edits + 1):
            # A word of a without one in b, one for another, a word of b without one in a.
            steps = [furthest[e] + int(e <= d) for e in (d - 1, d, d + 1) if e in furthest]
            start = np.minimum(reduce(np.maximum, steps), AROUND)
            reached[d] = end = run.take(masks[d] + start)
            best = np.maximum(best, end * ((end > start) & (end >= edits * EDIT_COST)))
        furthest = reached
    return best


def reaches(*bits: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """reach() before and after two seeds each, by one or more numbers that around() gives of both."""
    side = AROUND_BITS * AROUND
    low = (1 << side) - 1
    sides = []
    for shift in (side, 0):
        first, *further = [(a >> shift & low, b >> shift & low) for a, b in bits]
        sides.append(reach(*first, *further))
    return tuple(sides)


def may_span(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether a match of two seeds with these words around them may by itself grow to SPAN_WORDS."""
    return sum(reaches((a, b))) >= SPAN_WORDS - SEED_WORDS


SEEDS = "array<struct<hash: bigint, at: bigint, around: bigint, further: bigint>>"


def seeds_of(text: Column, key: Column, turn: int) -> Column:
    """Seeds of a text in one of SEED_ROUNDS, as _seed_rows() has them."""

    @F.arrow_udf(SEEDS)
    def find(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, keys in columns:
            parts = []
            for n, of, *rows in _seed_rows(texts, keys, turn):
                rows = pa.StructArray.from_arrays(list(map(pa.array, rows)), ["hash", "at", "around", "further"])
                edges = np.searchsorted(of, np.arange(n + 1)).astype(np.int32)
                parts.append(pa.ListArray.from_arrays(pa.array(edges), rows))
            yield pa.concat_arrays(parts)

    return find(text, key)


def _seed_rows(texts: pa.Array, keys: pa.Array, turn: int) -> Iterator[tuple]:
    """(texts, text of each seed, hash, at, around, further) of some texts at a time, seeds in order; `at` is the text's
    key in the upper half and the word's number in the lower. `further` has more bits of the words `around`, and LONG for
    long seeds."""
    at = 0
    for part in slices(texts) if len(texts) else [texts]:
        n = len(part)
        own = keys.slice(at, n).to_numpy().astype(np.int64)
        at += n
        words, _, _, owner = word_hashes(part)
        short, long = seeds(words, owner, n), seeds(words, owner, n, LONG_WORDS, LONG_WINDOW)
        hashes, first = map(np.concatenate, zip(short, long))
        mine = np.flatnonzero(hashes % np.uint64(SEED_ROUNDS) == turn)
        order = mine[np.argsort(first[mine], kind="stable")]
        hashes, first, is_long = hashes[order], first[order], order >= len(short[1])
        width = np.where(is_long, LONG_WORDS, SEED_WORDS)
        near, far = (around(words, owner, first, width, skip) for skip in (0, AROUND_BITS))
        far[is_long] |= LONG
        begin = np.searchsorted(owner, np.arange(n))
        of = owner[first]
        yield n, of, hashes.view(np.int64), (own[of] << 32) | (first - begin[of]), near, far


#: Rows that are shuffled together: numbers of 32 bits, column by column, of the rows that fall to one bucket.
PACKED = "bucket int, rows binary"
#: Buckets for each shuffle partition. A task works on one bucket after the other.
BUCKETS = 2
#: Rows that a task packs, or hands on, at a time.
PACK_ROWS, HAND_ROWS = 1 << 18, 1 << 15


def buckets(spark: SparkSession) -> int:
    return BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions"))


def _halves(*columns: np.ndarray) -> list[np.ndarray]:
    """The lower and the upper 32 bits of each column."""
    return [half.astype(np.uint32) for c in columns for half in (c & 0xFFFFFFFF, c >> 32)]


def _whole(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return (low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32)).view(np.int64)


def _packed(bucket: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch:
    """PACKED rows, one for each bucket; rows keep their order in it."""
    order = np.argsort(bucket.astype(np.min_scalar_type(int(bucket.max(initial=0)))), kind="stable")
    bucket, rows = bucket[order], np.stack([c[order] for c in columns])
    starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)])
    parts = [rows[:, a:b].tobytes() for a, b in zip(starts, [*starts[1:], len(bucket)])]
    return pa.record_batch([pa.array(bucket[starts], pa.int32()), pa.array(parts, pa.binary())], ["bucket", "rows"])


def _unpacked(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    """The columns of one bucket after the other, of PACKED rows in the order of buckets."""
    parts: list[np.ndarray] = []
    at = None
    for batch in batches:
        for bucket, rows in zip(batch.column("bucket").to_pylist(), batch.column("rows")):
            if bucket != at and parts:
                yield np.concatenate(parts, axis=1)
                parts = []
            at = bucket
            parts.append(np.frombuffer(rows.as_buffer(), np.uint32).reshape(width, -1))
    if parts:
        yield np.concatenate(parts, axis=1)


def _handed(columns: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    n = len(next(iter(columns.values())))
    for at in range(0, n, HAND_ROWS):
        yield pa.record_batch([pa.array(c[at : at + HAND_ROWS]) for c in columns.values()], list(columns))


def packed_seeds(batches: Iterator[pa.RecordBatch], turn: int, n: int) -> Iterator[pa.RecordBatch]:
    """The seeds of (doc, key, text), in n buckets by their hash."""

    def pack(rows: list[list[np.ndarray]]) -> pa.RecordBatch:
        hashes, docs, at, near, far = (np.concatenate(c) for c in zip(*rows))
        bucket = (hashes.view(np.uint64) // np.uint64(SEED_ROUNDS) % np.uint64(n)).astype(np.int32)
        # 48 bits of each number around a seed, and LONG above the word's number.
        (near_low, near_high, far_low, far_high) = _halves(near, far & ~LONG)
        rest = [at | (far >= LONG).astype(np.int64) << 31]
        return _packed(bucket, [*_halves(hashes, docs, *rest), near_low, far_low, near_high | far_high << 16])

    rows: list[list[np.ndarray]] = []
    for batch in batches:
        docs, done = batch.column("doc").to_numpy(), 0
        for count, of, hashes, at, near, far in _seed_rows(batch.column("text"), batch.column("key"), turn):
            rows.append([hashes, docs[done : done + count][of], at, near, far])
            done += count
            if sum(len(r[0]) for r in rows) >= PACK_ROWS:
                yield pack(rows)
                rows = []
    if rows:
        yield pack(rows)


def packed_links(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """What linked() makes of packed_seeds(), in n buckets by the document. Seeds of one document only have no links."""

    def ordered() -> Iterator[pa.RecordBatch]:
        for rows in _unpacked(batches, 9):
            hashes = _whole(rows[0], rows[1])
            order = np.argsort(hashes)
            same = hashes[order[1:]] == hashes[order[:-1]]
            rows = rows[:, order[np.append(same, False) | np.append(False, same)]]
            hashes, docs, at = (_whole(*rows[k : k + 2]) for k in (0, 2, 4))
            order = np.lexsort((at & ~(1 << 31), docs, hashes))
            hashes, docs, at = hashes[order], docs[order], at[order]
            edges = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)])
            count = np.diff(np.append(edges, len(hashes)))
            several = np.repeat(docs[edges] != docs[edges + count - 1], count)
            near_low, far_low, high = rows[6:, order[several]]
            hashes, docs, at = hashes[several], docs[several], at[several]
            near, far = _whole(near_low, high & 0xFFFF), _whole(far_low, high >> 16)
            far |= (at >> 31 & 1) * LONG
            yield from _handed({"hash": hashes, "doc": docs, "at": at & ~(1 << 31), "around": near, "further": far})

    def pack(links: list[list[np.ndarray]]) -> pa.RecordBatch:
        links = [np.concatenate(c) for c in zip(*links)]
        order = np.lexsort((links[2], links[0]))
        links = [c[order] for c in links]
        bucket = (mixed(links[0].view(np.uint64)) % np.uint64(n)).astype(np.int32)
        return _packed(bucket, _halves(*links))

    links: list[list[np.ndarray]] = []
    for batch in linked(ordered()):
        links.append([c.to_numpy() for c in batch.columns])
        if sum(len(c[0]) for c in links) >= PACK_ROWS:
            yield pack(links)
            links = []
    if links:
        yield pack(links)


def packed_chains(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """The chains of packed_links()."""
    for rows in _unpacked(batches, 8):
        doc, at, ref, ref_at = (_whole(*rows[k : k + 2]) for k in (0, 2, 4, 6))
        order = np.lexsort((ref_at & 0xFFFFFFFF, at & 0xFFFFFFFF, ref_at >> 32, ref, at >> 32, doc))
        columns = dict(zip(("doc", "at", "ref", "ref_at"), (c[order] for c in (doc, at, ref, ref_at))))
        yield from _chained(_handed(columns), min_words)


def able(near: np.ndarray, far: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which matches of seeds i and j may by themselves grow to SPAN_WORDS, as long seeds have."""
    good = (far[i] >= LONG) | ((near[i] == near[j]) & (far[i] == far[j]))
    some = np.flatnonzero(~good)
    some = some[may_span(near[i[some]], near[j[some]])]
    grown = reaches((near[i[some]], near[j[some]]), (far[i[some]], far[j[some]]))
    good[some] = sum(grown) >= SPAN_WORDS - SEED_WORDS
    return good


def _scripts(level: int) -> list[frozenset[tuple[int, int]]]:
    """Sets of (word, its shift from the other side's), one of which two sides share wholly where reach() adds `level` words
    or more: the words that AROUND_EDITS edits or fewer leave of so many that pay for them."""
    found = set()

    def edit(kept: frozenset, at: int, shift: int, left: int, end: int) -> None:
        rest = [(i, shift) for i in range(at, end)]
        if not left:  # words beyond AROUND count as equal
            found.add(kept.union((i, d) for i, d in rest if i - d < AROUND))
            return
        for n in range(len(rest) + 1):
            for step in (-1, 0, 1):
                edit(kept.union(rest[:n]), at + n + (step >= 0), shift + step, left - 1, end)

    for edits in range(AROUND_EDITS + 1):
        edit(frozenset(), 0, 0, edits, max(level, int(edits * EDIT_COST)))
    return sorted((k for k in found if not any(o < k for o in found)), key=sorted)


@cache
def shared(level: int, words: int) -> list[tuple[tuple[int, int], ...]]:
    """Few sets of up to so many (word, shift), one of which at least is a part of each of _scripts()."""
    parts = [set(combinations(sorted(k), min(words, len(k)))) for k in _scripts(level)]
    out = []
    while parts:
        count = Counter(c for p in parts for c in p)
        out.append(max(sorted(count), key=lambda c: (len(c), count[c])))
        parts = [p for p in parts if out[-1] not in p]
    return out


class Near:
    """Places by the bits of words around them, to find those that may reach far enough from a row."""

    def __init__(self, near: np.ndarray, far: np.ndarray, places: np.ndarray):
        self.near, self.far, self.places = near, far, places
        self.at = np.arange(len(places))
        self.words: dict[tuple[int, int], np.ndarray] = {}
        self.tables: dict[tuple[int, tuple[int, ...]], np.ndarray] = {}

    def word(self, of: np.ndarray, side: int, word: int) -> np.ndarray:
        """The bits of a word. Side 0 is after the seed, 1 before."""
        shift, mask = (side * AROUND + word) * AROUND_BITS, (1 << AROUND_BITS) - 1
        both = (self.near[of] >> shift & mask) << AROUND_BITS | (self.far[of] >> shift & mask)
        return both.astype(np.uint8)

    def codes(self, words: list[np.ndarray]) -> np.ndarray:
        """The bits of some words as the upper part of a number."""
        code = words[0].astype(np.int64)
        for word in words[1:]:
            code = code << 2 * AROUND_BITS | word
        return code * (len(self.places) + 1)

    def table(self, side: int, words: tuple[int, ...]) -> np.ndarray:
        """The places by some words: codes() and the number of the place, in order."""
        if (side, words) not in self.tables:
            if len(self.tables) * len(self.places) > HELD:
                self.tables.clear()
            for word in words:
                if (side, word) not in self.words:
                    self.words[side, word] = self.word(self.places, side, word)
            self.tables[side, words] = np.sort(self.codes([self.words[side, word] for word in words]) + self.at)
        return self.tables[side, words]

    def found(self, row: np.ndarray, start: np.ndarray, stop: np.ndarray, levels: tuple[int, int], words: int,
              most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of the row, number of the place), once, in order, of the places[start:stop] that share some words with
        each row, and the rows that have up to `most`; the others are left out. Together they are all places with so many
        words as `levels` after the seed, or before it; none are looked up beyond AROUND."""
        n = len(self.places) + 1
        pairs, total, few = [np.zeros(0, np.int64)], np.zeros(len(row), np.int64), np.arange(len(row))
        for side, level in enumerate(levels):
            keys = shared(level, words) if level <= AROUND else []
            mine = {i: self.word(row, side, i) for i in {i for key in keys for i, _ in key}}
            for key in keys:
                table = self.table(side, tuple(i - shift for i, shift in key))
                code = self.codes([mine[i][few] for i, _ in key])
                first, end = (np.searchsorted(table, code + edge[few]) for edge in (start, stop))
                total[few] += end - first
                good = total[few] <= most
                few, first, count = few[good], first[good], (end - first)[good]
                pairs.append(np.repeat(few * n, count) + table[expanded(first, count)] % n)
        pairs = np.sort(np.concatenate(pairs))
        number, place = np.divmod(pairs[np.append(True, pairs[1:] != pairs[:-1])[: len(pairs)]], n)
        good = total[number] <= most
        return number[good], place[good], few


def furthest(near: np.ndarray, far: np.ndarray, row: np.ndarray, places: np.ndarray, start: np.ndarray,
             stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (of, to) of each row with those of its earlier places[start:stop], all of which it is compared with,
    that may span and reach further, before or after the seed, than each place before them.

    What a place left out has in common with the row within AROUND words of the seed, one before it has too.
    Where a place is alike on all words around, no later one reaches further, and the row is done. Of many places, a
    row is compared with those that share as many words with it, but for edits, as it asks for beyond those of places before:
    on the side where it asks for more, or else on one side or the other. Others can't be linked. Where too many would be
    found that way, all are compared."""
    best = np.full((len(row), AROUND + 1), -1, np.int8)  # words after, of places with so many words before or more
    of, to = [row[:0]], [row[:0]]
    index = Near(near, far, places)
    # Words after that a place with so many words before needs, to span by itself.
    spans = np.maximum(SPAN_WORDS - SEED_WORDS - np.arange(AROUND + 1), 0)
    spans = np.where(far[row, None] >= LONG, 0, spans).astype(np.int8)

    def compare(k: np.ndarray, j: np.ndarray) -> None:
        """Of the rows numbered k, in order, with the places j, in order."""
        i = row[k]
        before, after = reaches((near[i], near[j]), (far[i], far[j]))
        good = (before + after >= SPAN_WORDS - SEED_WORDS) | (far[i] >= LONG)
        good = np.flatnonzero(good & (after > best[k, before]))
        # The first place of each reach, then, in order, those that no place before reaches as far as.
        cell = (k[good].astype(np.int64) * (AROUND + 1) + before[good]) * (AROUND + 1) + after[good]
        good = np.sort(good[np.unique(cell, return_index=True)[1]])
        turn = np.arange(len(good)) - np.searchsorted(k[good], k[good])
        for t in range(int(turn.max(initial=-1)) + 1):
            at = good[turn == t]
            at = at[after[at] > best[k[at], before[at]]]
            level = np.arange(AROUND + 1) <= before[at, None]
            best[k[at]] = np.where(level, np.maximum(best[k[at]], after[at, None]), best[k[at]])
            of.append(i[at])
            to.append(j[at])

    def asked(k: np.ndarray, one: bool) -> np.ndarray:
        """Words after, and the same times `base` before, one of which a place must reach, for the rows numbered k: on one
        side only, or on either. 0 words on one side if a place could do with none."""
        needs = np.maximum(best[k] + 1, spans[k]).astype(int)  # words after, by those before
        if one:
            after, before = needs[:, AROUND], (needs > AROUND).sum(axis=1)
            return np.where(after >= before, after + (after > 0) * (base - 1) * base, base - 1 + before * base)
        # Either so many before, or what a place with one word less needs after.
        before = np.minimum(np.arange(1, AROUND + 1), needs[:, :AROUND]).argmax(axis=1)
        return needs[np.arange(len(k)), before] + (before + 1) * base

    def look_up(active: np.ndarray, one: bool) -> np.ndarray:
        """Compares rows with their places in this step that share words; the rows left for which that gains nothing."""
        kind, left = asked(active, one), [active[:0]]
        for chosen in np.unique(kind).tolist():
            some, levels = active[kind == chosen], (chosen % base, chosen // base)
            words, most = sum(step >= least for least in LOOKED_UP_BY), AROUND - AROUND_EDITS
            while len(some):
                begin = start[some] + lower
                count = np.minimum(step, stop[some] - begin)
                keys = sum(len(shared(level, words)) for level in levels if 0 < level <= AROUND)
                if not min(levels) or words > most or keys * (len(places) + 8 * len(some)) > WORTH * count.sum():
                    left.append(some)
                    break
                limit, again = MANY if words < most else MANY * 16, [some[:0]]
                for at in range(0, len(some), PAIRS * 32 // limit + 1):
                    part, low, n = (x[at : at + PAIRS * 32 // limit + 1] for x in (some, begin, count))
                    number, place, few = index.found(row[part], low, low + n, levels, words, limit)
                    for first in range(0, len(number), PAIRS):
                        pairs = slice(first, first + PAIRS)
                        compare(part[number[pairs]], places[place[pairs]])
                    many = np.ones(len(part), bool)
                    many[few] = False
                    left.append(part[many & (n <= limit)])
                    again.append(part[many & (n > limit)])
                some, words = np.concatenate(again), words + 1
        return np.sort(np.concatenate(left))

    base = AROUND + 2  # AROUND + 1 words are never reached
    active, lower, step = np.flatnonzero(start < stop), 0, FIRST_STEP
    while len(active):
        rest = active
        for one in (True, False) if lower >= LOOKED_UP else ():
            rest = look_up(rest, one) if len(rest) else rest
        count = np.minimum(stop[rest] - start[rest] - lower, step)
        # A row with a number of places, or many rows: never more pairs at a time than both allow.
        edges = np.flatnonzero(np.diff(np.cumsum(count) // PAIRS)) + 1
        for part, n in zip(np.split(rest, edges), np.split(count, edges)):
            for skipped in range(0, int(n.max(initial=0)), PAIRS):
                now = np.clip(n - skipped, 0, PAIRS)
                begin = start[part] + lower + skipped
                compare(np.repeat(part, now), places[expanded(begin, now)])
        lower, step = lower + step, min(4 * step, max(PAIRS, FIRST_STEP))
        active = active[(best[active, AROUND] < AROUND) & (start[active] + lower < stop[active])]
    return np.concatenate(of), np.concatenate(to)


def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each occurrence of a seed with the first of all and the PREVIOUS last ones in earlier documents, but for
    matches that can't grow to SPAN_WORDS within the words `around` both, if rows have them; then also with those that
    furthest() finds among all in earlier documents, or with the first one that has the same words around.

    A match that can't grow lies where words differ. Inside a longer passage the matches on both sides of it are
    there, and what is between them is aligned word by word, so it isn't needed.

    Rows are in the order of (hash, doc, at). Of earlier batches, what is kept is, of the hash at hand, the first
    occurrence with each words around, and the last ones before and in the document at hand."""
    carried = np.zeros((0, 5), np.int64)
    for batch in batches:
        if not len(batch):
            continue
        names = batch.schema.names
        known = "around" in names
        rows = np.stack([batch.column(c).to_numpy() if c in names else np.zeros(len(batch), np.int64)
                         for c in ("hash", "doc", "at", "around", "further")], axis=1)
        rows = np.concatenate([carried, rows])
        hashes, docs, at, near, far = np.ascontiguousarray(rows.T)
        index = np.arange(len(rows))
        new = np.ones(len(rows), bool)
        new[1:] = hashes[1:] != hashes[:-1]
        first = np.maximum.accumulate(np.where(new, index, 0))
        new[1:] |= docs[1:] != docs[:-1]
        own = np.maximum.accumulate(np.where(new, index, 0))
        here = index[len(carried) :]
        to = [(here, first[here])] + [(here, own[here] - k) for k in range(1, PREVIOUS + 1)]
        # The first is named once: other links go to places after it.
        good = [(i[own[i] > j], j[own[i] > j]) if not k else (i[j > first[i]], j[j > first[i]])
                for k, (i, j) in enumerate(to)]
        i, j = (np.concatenate(c) for c in zip(*good))
        last = len(rows) - 1
        stay = {first[last], *range(max(first[last], own[last] - PREVIOUS), own[last]),
                *range(max(own[last], last - PREVIOUS + 1), last + 1), own[last]}
        if known:
            if len(i):
                grows = able(near, far, i, j)
                i, j = i[grows], j[grows]
            more = here[own[here] - first[here] > PREVIOUS + 1]  # others have all links by now
            named = np.zeros(len(rows), bool)
            named[first[more]] = named[first[last]] = True
            some = np.flatnonzero(named[first])
            order = some[np.lexsort((far[some], near[some], first[some]))]
            differ = np.ones(len(order), bool)
            differ[1:] = (np.diff(first[order]) != 0) | (np.diff(near[order]) != 0) | (np.diff(far[order]) != 0)
            lead = index.copy()
            lead[order] = order[np.maximum.accumulate(np.where(differ, np.arange(len(order)), 0))]
            places = some[lead[some] == some]
            copies = more[lead[more] < own[more]]
            rest = more[lead[more] >= own[more]]
            of, ref = furthest(near, far, rest, places, *np.searchsorted(places, [first[rest], own[rest]]))
            links = np.unique(np.concatenate([i, of, copies]) * len(rows) + np.concatenate([j, ref, lead[copies]]))
            i, j = links // len(rows), links % len(rows)
            stay.update(places[places >= first[last]].tolist())
        if len(i):
            yield pa.record_batch([pa.array(c) for c in (docs[i], at[i], docs[j], at[j])],
                                  ["doc", "at", "ref", "ref_at"])
        carried = rows[sorted(stay)]


def chains(x: list[int], y: list[int]) -> list[list[int]]:
    """Numbers of the matches of each chain; x[i] and y[i] rise along a chain. x ascends.

    A match adds its words to the best chain before it, less the words between on both sides times
    GAP_COST. The cost is a difference of sums x + y, so that the best predecessor is a prefix maximum
    over y. Chains are taken by falling score, each match once. Which parts of one are alike is left to
    alignment, whatever the gaps.
    """
    if len(x) == 1:
        return [[0]]
    score, before = [float(SEED_WORDS)] * len(x), [-1] * len(x)
    shift = x[0] - y[0]
    if all(u - v == shift for u, v in zip(x, y)):
        # Where all matches keep their distance, the nearest one before adds the most.
        for i in range(1, len(x)):
            value = score[i - 1] + GAP_COST * (x[i - 1] + y[i - 1])
            gain = value - GAP_COST * (x[i] + y[i]) + GAP_COST * 2 * SEED_WORDS
            if gain > 0:
                score[i], before[i] = SEED_WORDS + gain, i - 1
    else:
        order = sorted(set(y))
        place = {v: i for i, v in enumerate(order, 1)}
        # A Fenwick tree: the highest value put at places up to a given one, and who put it.
        size = len(order) + 1
        best, who = [-1e18] * size, [-1] * size
        waiting = 0
        for i, (u, v) in enumerate(zip(x, y)):
            while x[waiting] < u:  # equal x can't follow each other
                value = score[waiting] + GAP_COST * (x[waiting] + y[waiting])
                at = place[y[waiting]]
                while at < size:
                    if best[at] < value:
                        best[at], who[at] = value, waiting
                    at += at & -at
                waiting += 1
            value, j, at = -1e18, -1, place[v] - 1
            while at > 0:
                if best[at] > value:
                    value, j = best[at], who[at]
                at -= at & -at
            gain = value - GAP_COST * (u + v) + GAP_COST * 2 * SEED_WORDS
            if j >= 0 and gain > 0:
                score[i], before[i] = SEED_WORDS + gain, j
    used = [False] * len(x)
    found = []
    for i in sorted(range(len(x)), key=score.__getitem__, reverse=True):  # of equal scores, the first
        if used[i]:
            continue
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = before[i]
        chain.reverse()
        found.append(chain)
    return found


CHAIN = ("doc bigint, key int, low int, high int, ref bigint, ref_key int, ref_low int, ref_high int, "
         "xs array<int>, ys array<int>")


def _chained(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """Chains of matches sorted by document; of the batches, the rows of one document are kept."""
    names = ["doc", "at", "ref", "ref_at"]
    schema = pa.schema(
        [("doc", pa.int64()), ("key", pa.int32()), ("low", pa.int32()), ("high", pa.int32()),
         ("ref", pa.int64()), ("ref_key", pa.int32()), ("ref_low", pa.int32()), ("ref_high", pa.int32()),
         ("xs", pa.list_(pa.int32())), ("ys", pa.list_(pa.int32()))]
    )

    def document(parts: list[list[np.ndarray]]) -> list[tuple]:
        doc, at, ref, ref_at = (np.concatenate(c) for c in zip(*parts))
        # Short and long seeds of one place are one match.
        new = np.ones(len(doc), bool)
        new[1:] = (at[1:] != at[:-1]) | (ref[1:] != ref[:-1]) | (ref_at[1:] != ref_at[:-1])
        at, ref, ref_at = at[new], ref[new], ref_at[new]
        other = ref_at >> 32
        edges = np.flatnonzero((ref[1:] != ref[:-1]) | (other[1:] != other[:-1])) + 1
        of, key, low = int(doc[0]), int(at[0] >> 32), (1 << 32) - 1
        places, ref_places = at & low, ref_at & low
        # Where the next match always adds more than the words between cost, all are one chain.
        step, shift = np.diff(places, prepend=places[0]), places - ref_places
        starts = np.append(0, edges)
        step[starts] = 0
        together = (np.maximum.reduceat(step, starts) < NEXT_WORDS) & (
            np.minimum.reduceat(shift, starts) == np.maximum.reduceat(shift, starts)
        )
        out = []
        for start, end, whole in zip(starts.tolist(), [*edges.tolist(), len(at)], together.tolist()):
            x, y = places[start:end], ref_places[start:end]
            for chain in [slice(None)] if whole else chains(x.tolist(), y.tolist()):
                xs, ys = x[chain], y[chain]
                first, last, ref_first, ref_last = int(xs[0]), int(xs[-1]), int(ys[0]), int(ys[-1])
                out.append((of, key, max(0, first - PAD), last + SEED_WORDS + PAD,
                            int(ref[start]), int(other[start]), max(0, ref_first - PAD),
                            ref_last + SEED_WORDS + PAD, xs, ys))
        # Chains that even with their neighbours and all growth are too short can't be in a passage.
        out.sort(key=lambda c: (c[2], c[3]))
        good, group, reach = [], [], -1
        for chain in [*out, None]:
            if chain is None or chain[2] > reach + JOIN_WORDS:
                if group and reach - group[0][2] >= min_words:
                    good += group
                group = []
            if chain is not None:
                reach = max(reach, chain[3]) if group else chain[3]
                group.append(chain)
        return good

    def batch_of(done: list[tuple]) -> pa.RecordBatch:
        *plain, xs, ys = zip(*done)
        edges = pa.array(np.cumsum([0, *map(len, xs)]), pa.int32())
        lists = (pa.ListArray.from_arrays(edges, pa.array(np.concatenate(c), pa.int32())) for c in (xs, ys))
        plain = [pa.array(c, f.type) for c, f in zip(plain, schema)]
        return pa.record_batch([*plain, *lists], names=schema.names)

    rows: list[list[np.ndarray]] = []
    done: list[tuple] = []
    for batch in batches:
        columns = [batch.column(c).to_numpy() for c in names]
        if not len(batch):
            continue
        key = columns[1] >> 32
        edges = np.flatnonzero((columns[0][1:] != columns[0][:-1]) | (key[1:] != key[:-1])) + 1
        for start, end in zip([0, *edges.tolist()], [*edges.tolist(), len(batch)]):
            if rows and (rows[-1][0][-1] != columns[0][start] or rows[-1][1][-1] >> 32 != key[start]):
                done += document(rows)
                rows = []
            rows.append([c[start:end] for c in columns])
        if done:
            yield batch_of(done)
            done = []
    if rows:
        done += document(rows)
    if done:
        yield batch_of(done)


def distance(a: np.ndarray, b: np.ndarray) -> int:
    """Word edits between two short stretches."""
    if len(a) == len(b) and len(a) <= 2:
        return int((a != b).sum())
    row = np.arange(len(b) + 1)
    for i, word in enumerate(a):
        step = np.minimum(row[1:] + 1, row[:-1] + (b != word))
        row = np.concatenate([[i + 1], step])
        row = np.minimum.accumulate(row - np.arange(len(row))) + np.arange(len(row))
    return int(row[-1])


def grown(a: list[int], b: list[int], cost: float) -> tuple[int, int, int]:
    """(words of a, words of b, edits) next to a chain that belong to it: up to the last equal words for
    which words less edits * cost is highest.

    For each number of edits, the furthest place on each diagonal is found from those of one edit less. Where the
    first words of both have none in common, growth ends: each edit then adds a word at most, and costs more. Equal
    stretches grow whole.
    """
    best, end = 0.0, (0, 0, 0)
    edits, furthest = 0, {0: 0}
    n, m, drop = len(a), len(b), max(GROWTH_DROP, 2 * cost)
    if cost > 1:
        few = int((drop - 1) / (cost - 1)) + 2
        if set(a[:few]).isdisjoint(b[:few]):
            return end
        whole = min(n, m)
        if a[:whole] == b[:whole]:
            return whole, whole, 0
    while furthest:
        reached = {}
        loss = edits * cost
        for shift, i in furthest.items():
            start, stop = i, m + shift if m + shift < n else n
            while i < stop and a[i] == b[i - shift]:
                i += 1
            if i > start:
                gain = (i if shift < 0 else i - shift) - loss
                if gain >= best:
                    best, end = gain, (i, i - shift, edits)
            reached[shift] = i
        edits += 1
        furthest = {}
        least = best - drop + edits * cost
        for shift, i in reached.items():
            if (i if shift < 0 else i - shift) < least:
                continue
            for to, at in ((shift, i + 1), (shift + 1, i + 1), (shift - 1, i)):
                if at <= n and at - to <= m and furthest.get(to, -1) < at:
                    furthest[to] = at
    return end


def gap_edits(a: np.ndarray, b: np.ndarray, xs: np.ndarray, ys: np.ndarray, limit: float) -> np.ndarray:
    """Word edits between each two matches that follow each other; where they must be over `limit`, the
    words of the longer side.

    As long as matches keep their distance from each other in both, words are compared one by one; where
    it changes, what lies between is aligned by edits."""
    edits = np.zeros(len(xs) - 1, np.int64)
    if not len(edits):
        return edits
    turns = np.flatnonzero(np.diff(xs - ys)) + 1
    starts, ends = np.append(0, turns), np.append(turns, len(xs)) - 1
    for first, last in zip(starts.tolist(), ends.tolist()):
        x, y, n = int(xs[first]), int(ys[first]), int(xs[last] - xs[first]) + SEED_WORDS
        if last > first:
            other = np.concatenate([[0], np.cumsum(a[x : x + n] != b[y : y + n])])
            places = xs[first : last + 1] - x
            edits[first:last] = other[places[1:]] - other[np.minimum(places[:-1] + SEED_WORDS, places[1:])]
        if last + 1 < len(xs):
            u, v = int(xs[last + 1]), int(ys[last + 1])
            if u < x + n or v < y + n:  # the next match begins inside this one: so many words moved
                edits[last] = abs((u - x) - (v - y))
            elif abs((u - x) - (v - y)) > limit:
                edits[last] = max(u - x - n, v - y - n)
            else:
                edits[last] = distance(a[x + n : u], b[y + n : v])
    return edits


def aligned(a: np.ndarray, b: np.ndarray, xs: np.ndarray, ys: np.ndarray, similarity: float):
    """(first, end in a, first, end in b, edits) of the alignments of a chain: of the whole chain if it is
    alike, else of the parts that are, cut at the gaps with most edits.

    xs and ys are the places of the matches in a and b."""
    # The least bit more, as 0.2 * 50 may come out below 10.
    share = 1 - similarity + 1e-12
    gaps = gap_edits(a, b, xs, ys, share * max(len(a), len(b)))
    total = np.concatenate([[0], np.cumsum(gaps)])

    def whole(first: int, last: int):
        edits = int(total[last] - total[first])
        low_a, low_b = int(xs[first]), int(ys[first])
        high_a, high_b = int(xs[last]) + SEED_WORDS, int(ys[last]) + SEED_WORDS
        if edits > share * (max(high_a - low_a, high_b - low_b) + 4 * PAD):
            return None
        before = a[max(0, low_a - PAD) : low_a][::-1].tolist(), b[max(0, low_b - PAD) : low_b][::-1].tolist()
        after = a[high_a : high_a + PAD].tolist(), b[high_b : high_b + PAD].tolist()
        # What grows at the higher cost is alike enough by itself.
        for cost in (EDIT_COST, max(EDIT_COST, 1 / share)):
            back_a, back_b, back = grown(*before, cost)
            on_a, on_b, on = grown(*after, cost)
            first_a, end_a, first_b, end_b = low_a - back_a, high_a + on_a, low_b - back_b, high_b + on_b
            if edits + back + on <= share * max(end_a - first_a, end_b - first_b):
                return first_a, end_a, first_b, end_b, edits + back + on
        return None

    found, parts = [], [(0, len(xs) - 1)]
    while parts:
        first, last = parts.pop()
        span = whole(first, last)
        if span is not None:
            found.append(span)
        elif last > first:
            # Of equal gaps the one in the middle, so that parts are cut few times.
            worst = np.flatnonzero(gaps[first:last] == gaps[first:last].max())
            cut = first + int(worst[np.abs(2 * worst - (last - first - 1)).argmin()])
            parts += [(cut + 1, last), (first, cut)]
    return found


def grown_all(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...], step: int, cost: float) -> np.ndarray:
    """What grown() gives for each pair of rows; a row of (values, first, count) is the values from `first` on, in the
    direction of `step`.

    Most rows grow over equal words only, and end there: with the text, or where the next words of both have none
    in common that edits could bring together, for the reason that grown() has for its own start."""
    drop = max(GROWTH_DROP, 2 * cost)
    few = int((drop - 1) / (cost - 1)) + 2
    (words, first, n), (others, ref_first, m) = a, b
    whole = np.minimum(n, m)
    equal = np.zeros(len(n), np.int64)
    active = np.flatnonzero(whole)
    while len(active):
        at = equal[active] * step
        same = words[first[active] + at] == others[ref_first[active] + at]
        active = active[same]
        equal[active] += 1
        active = active[equal[active] < whole[active]]
    out = np.stack([equal, equal, np.zeros_like(equal)], axis=1)
    rest = np.flatnonzero(equal < whole)
    meets = np.zeros(len(rest), bool)
    at, room, ref_room = equal[rest], (n - equal)[rest], (m - equal)[rest]
    next_words, next_others = (
        [v.take(f[rest] + (at + k) * step, mode="clip") for k in range(few)]
        for v, f in ((words, first), (others, ref_first))
    )
    for i in range(few):
        for j in range(few):
            # It takes as many edits to come to both as to the later one, and the words up to the earlier one must pay.
            if min(i, j) >= max(i, j) * cost - drop:
                meets |= (next_words[i] == next_others[j]) & (room > i) & (ref_room > j)
    for k in rest[meets].tolist():
        x, y = (
            v[f : f + c] if step > 0 else v[f - c + 1 : f + 1][::-1]
            for v, f, c in ((words, first[k], n[k]), (others, ref_first[k], m[k]))
        )
        out[k] = grown(x.tolist(), y.tolist(), cost)
    return out


def aligned_all(a: pa.ListArray, b: pa.ListArray, xs: pa.ListArray, ys: pa.ListArray, low: np.ndarray,
                ref_low: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(rows of what aligned() gives, where those of each chain begin; one more ends the last), places counted from the
    texts' beginnings. Chains whose matches keep their distance and that are alike as a whole are done at once."""
    share = 1 - similarity + 1e-12
    parts = ((c.offsets.to_numpy().astype(np.int64), c.values.to_numpy()) for c in (a, b, xs, ys))
    (a_at, words), (b_at, others), (x_at, x), (y_at, y) = parts
    low, ref_low = low.astype(np.int64), ref_low.astype(np.int64)
    size, ref_size, count = np.diff(a_at), np.diff(b_at), np.diff(x_at)
    x, y = x[x_at[0] : x_at[-1]].astype(np.int64), y[y_at[0] : y_at[-1]].astype(np.int64)
    x_at, y_at = x_at - x_at[0], y_at - y_at[0]
    n = len(low)
    if not n:
        return np.zeros((0, 5), np.int64), np.zeros(1, np.int64)
    chain = np.repeat(np.arange(n), count)
    x, y = x - low[chain], y - ref_low[chain]
    low_a, low_b, high_a, high_b = x[x_at[:-1]], y[y_at[:-1]], x[x_at[1:] - 1] + SEED_WORDS, y[y_at[1:] - 1] + SEED_WORDS
    shift = x - y
    simple = np.minimum.reduceat(shift, x_at[:-1]) == np.maximum.reduceat(shift, x_at[:-1])
    simple &= (high_a <= size) & (high_b <= ref_size)
    # Unlike words between the matches of a chain.
    length = np.where(simple & (count > 1), high_a - low_a, 0)
    differ = words[expanded(a_at[:-1] + low_a, length)] != others[expanded(b_at[:-1] + low_b, length)]
    unlike = np.concatenate([[0], np.cumsum(differ)])
    begin = np.cumsum(length) - length
    gap = np.flatnonzero((chain[1:] == chain[:-1]) & simple[chain[1:]])
    of = chain[gap]
    here, there = (x[k] - low_a[of] + begin[of] for k in (gap, gap + 1))
    each = unlike[there] - unlike[np.minimum(here + SEED_WORDS, there)]
    edits = np.bincount(of, each, minlength=n).astype(np.int64)
    simple &= edits <= share * (np.maximum(high_a - low_a, high_b - low_b) + 4 * PAD)

    k = np.flatnonzero(simple)
    low_a, low_b, high_a, high_b = (c[k] for c in (low_a, low_b, high_a, high_b))
    back = grown_all((words, a_at[k] + low_a - 1, np.minimum(low_a, PAD)),
                     (others, b_at[k] + low_b - 1, np.minimum(low_b, PAD)), -1, EDIT_COST)
    on = grown_all((words, a_at[k] + high_a, np.minimum(size[k] - high_a, PAD)),
                   (others, b_at[k] + high_b, np.minimum(ref_size[k] - high_b, PAD)), 1, EDIT_COST)
    spans = np.stack([low_a - back[:, 0], high_a + on[:, 0], low_b - back[:, 1], high_b + on[:, 1],
                      edits[k] + back[:, 2] + on[:, 2]], axis=1)
    good = spans[:, 4] <= share * np.maximum(spans[:, 1] - spans[:, 0], spans[:, 3] - spans[:, 2])
    done = np.zeros(n, bool)
    done[k[good]] = True
    others_of = {
        c: aligned(words[a_at[c] : a_at[c + 1]], others[b_at[c] : b_at[c + 1]],
                   x[x_at[c] : x_at[c + 1]], y[y_at[c] : y_at[c + 1]], similarity)
        for c in np.flatnonzero(~done).tolist()
    }
    found = np.ones(n, np.int64)
    found[~done] = [len(got) for got in others_of.values()]
    edges = np.concatenate([[0], np.cumsum(found)])
    out = np.zeros((edges[-1], 5), np.int64)
    out[edges[:-1][done]] = spans[good]
    for c, got in others_of.items():
        out[edges[c] : edges[c + 1]] = np.array(got, np.int64).reshape(-1, 5)
    out[:, :2] += np.repeat(low, found)[:, None]
    out[:, 2:4] += np.repeat(ref_low, found)[:, None]
    return out, edges


SPAN = "array<struct<first: int, last: int, ref_first: int, ref_last: int, edits: int>>"


def _align(similarity: float):
    @F.arrow_udf(SPAN)
    def align(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        fields = ["first", "last", "ref_first", "ref_last", "edits"]
        for a, b, xs, ys, low, ref_low in columns:
            found, edges = aligned_all(a, b, xs, ys, low.to_numpy(), ref_low.to_numpy(), similarity)
            rows = pa.StructArray.from_arrays([pa.array(c, pa.int32()) for c in found.T], fields)
            yield pa.ListArray.from_arrays(pa.array(edges, pa.int32()), rows)

    return align


def _words_of(text: Column) -> Column:
    """32 bits of the hash of each word."""

    @F.arrow_udf("array<int>")
    def hashed(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            parts = []
            for part in slices(column) if len(column) else [column]:
                words, _, _, owner = word_hashes(part)
                edges = np.searchsorted(owner, np.arange(len(part) + 1)).astype(np.int32)
                short = (words >> np.uint64(32)).astype(np.uint32).view(np.int32)
                parts.append(pa.ListArray.from_arrays(pa.array(edges), pa.array(short)))
            yield pa.concat_arrays(parts)

    return hashed(text)


def name_of(text: str, id: str) -> tuple[Column, Column]:
    """(doc, key) of a text: its id, or for a null id 62 bits of its hash above all ids, and 31 bits of another
    hash. So rows with equal ids but other texts are told apart, and equal rows are one text."""
    doc = F.coalesce(F.col(id).cast("long"), F.lit(NULL_ID) + F.shiftrightunsigned(F.xxhash64(text), 2))
    return doc, F.shiftrightunsigned(F.xxhash64(F.lit("key"), F.col(text)), 33).cast("int")


def keyed(docs: DataFrame, text: str, id: str) -> DataFrame:
    """(doc, key, text) of all texts, null ones left out."""
    doc, key = name_of(text, id)
    rows = docs.filter(F.col(text).isNotNull())
    return rows.select(doc.alias("doc"), key.alias("key"), F.col(text).alias("text"))


def shared_names(docs: DataFrame, text: str, id: str) -> DataFrame:
    """(doc, key) that two different texts of one id have, which 31 bits leave possible if an id has very many."""
    doc, key = name_of(text, id)
    whole = F.xxhash64(F.col(text), F.lit("whole"))
    names = docs.filter(F.col(text).isNotNull()).groupBy(doc.alias("_doc"), key.alias("_key"))
    return names.agg(F.min(whole).alias("lo"), F.max(whole).alias("hi")).filter("lo < hi").drop("lo", "hi")


def shared_spans(docs: DataFrame, text: str = "text", id: str = "doc_id",
                 similarity: float = SIMILARITY, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, key, first, last, ref, ref_key, ref_first, ref_last, edits): spans of SPAN_WORDS or more
    words that a text has from an earlier one, the last word not included; see passages()."""
    texts = keyed(docs, text, id)
    # One shuffle of the seeds, many of them in a row. One task has all places of a seed, and holds one bucket of seeds.
    links: list[tuple[DataFrame, str]] = []
    n = buckets(docs.sparkSession)
    for turn in range(SEED_ROUNDS):
        rows = texts.mapInArrow(lambda b, turn=turn: packed_seeds(b, turn, n), PACKED)
        places = rows.repartition("bucket").sortWithinPartitions("bucket")
        links.append(kept_at(places.mapInArrow(lambda b: packed_links(b, n), PACKED), "links"))
        del rows, places
        free_shuffles(docs.sparkSession)
    matches = reduce(DataFrame.unionAll, (table for table, _ in links))
    ordered = matches.repartition("bucket").sortWithinPartitions("bucket")
    found = kept(ordered.mapInArrow(lambda b: packed_chains(b, min_words), CHAIN), "chains")
    for _, folder in links:
        remove(docs.sparkSession, folder)  # the chains are written
    del matches, ordered, links
    free_shuffles(docs.sparkSession)

    # The words of each text that a chain touches, once; a text that very many refer to is on the side
    # of the join that has a row for each text, so the other side can be split.
    here, there = ["doc", "key"], ["ref", "ref_key"]
    touched = found.select(here).union(found.select(there)).distinct()
    words = kept(
        texts.join(kept(touched, "touched"), here)
        .dropDuplicates(here)
        .select(*here, _words_of(F.col("text")).alias("words")),
        "words",
    )
    free_shuffles(docs.sparkSession)
    others = words.select(*(F.col(a).alias(b) for a, b in zip(here, there)), F.col("words").alias("others"))

    def part(words: str, low: str, high: str) -> Column:
        return F.slice(words, F.col(low) + 1, F.col(high) - F.col(low))

    # Chains take their words along. A round of them does so at a time, so the disk holds a round's words only.
    turns: list[DataFrame] = []
    for turn in range(ALIGN_ROUNDS):
        mine = F.pmod(F.xxhash64(*here), F.lit(ALIGN_ROUNDS)) == turn
        pairs = found.filter(mine).join(words.filter(mine), here).withColumn("words", part("words", "low", "high"))
        pairs = pairs.join(others, there).withColumn("others", part("others", "ref_low", "ref_high"))
        span = _align(similarity)(*map(F.col, ("words", "others", "xs", "ys", "low", "ref_low")))
        spans = (
            pairs.select("doc", "key", "ref", "ref_key", F.explode(span).alias("span"))
            .filter(f"span.last - span.first >= {SPAN_WORDS}")
            .select("doc", "key", "ref", "ref_key", "span.*")
            .distinct()
        )
        turns.append(kept(spans, "spans"))
        del pairs, spans
        free_shuffles(docs.sparkSession)
    return reduce(DataFrame.unionAll, turns)


SPANS = "array<struct<first: int, last: int, ref: bigint>>"


def _held(ref: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Which spans of a text lie in one of an earlier document; in the order of documents."""
    step = max(1, PAIRS // max(1, len(ref)))
    parts = [slice(at, at + step) for at in range(0, len(ref), step)]
    return np.concatenate([np.zeros(0, bool), *(
        ((first <= first[p, None]) & (last >= last[p, None]) & (ref < ref[p, None])).any(axis=1) for p in parts
    )])


def first_hand(spans: Column) -> Column:
    """The spans of each text, ordered, less those that lie in a span of an earlier document."""

    @F.arrow_udf(SPANS)
    def reduced(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            count, fields = np.diff(column.offsets.to_numpy()), column.flatten().flatten()
            first, last, ref = (c.to_numpy().astype(np.int64) for c in fields)
            owner = np.repeat(np.arange(len(column)), count)
            order = np.lexsort((last, first, ref, owner))
            rows = np.stack([owner, ref, first, last])[:, order]
            new = np.append(True, (rows[:, 1:] != rows[:, :-1]).any(axis=0))[: len(order)]
            rows = rows[:, new]
            edges = np.searchsorted(rows[0], np.arange(len(column) + 1)).tolist()
            held = np.concatenate([np.zeros(0, bool), *(_held(*rows[1:, a:b]) for a, b in zip(edges, edges[1:]))])
            owner, ref, first, last = rows[:, ~held]
            order = np.lexsort((ref, last, first, owner))
            kinds = zip((first, last, ref), (pa.int32(), pa.int32(), pa.int64()))
            spans = pa.StructArray.from_arrays([pa.array(c[order], k) for c, k in kinds], ["first", "last", "ref"])
            edges = np.searchsorted(owner, np.arange(len(column) + 1))
            yield pa.ListArray.from_arrays(pa.array(edges, pa.int32()), spans)

    return reduced(spans)


def merged(spans: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, key, passages): the passages of each text with any, array<struct<first, last, refs>>.

    A text has no more spans than seeds, so one row can hold them."""
    rows = spans.groupBy("doc", "key").agg(F.collect_list(F.struct("first", "last", "ref")).alias("spans"))
    rows = rows.select("doc", "key", first_hand(F.col("spans")).alias("spans"))
    start = F.expr("cast(array() as array<struct<first: int, last: int, refs: array<bigint>>>)")

    def add(done: Column, span: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        longer = F.struct(
            last["first"].alias("first"), F.greatest(last["last"], span["last"]).alias("last"),
            F.array_union(last["refs"], F.array(span["ref"])).alias("refs"),
        )
        fresh = F.struct(span["first"].alias("first"), span["last"].alias("last"),
                         F.array(span["ref"]).alias("refs"))
        joins = (F.size(done) > 0) & (span["first"] <= last["last"] + JOIN_WORDS)
        rest = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(joins, F.concat(rest, F.array(longer))).otherwise(F.concat(done, F.array(fresh)))

    passages = F.filter(F.aggregate("spans", start, add), lambda p: p["last"] - p["first"] >= min_words)
    return rows.select("doc", "key", passages.alias("passages")).filter(F.size("passages") > 0)


def passages(docs: DataFrame, text: str = "text", id: str = "doc_id", **limits) -> DataFrame:
    """(id, first_word, last_word, n_words, source_ids): each passage of at least min_words words that a
    document has from earlier ones, by their ids; the first document that has it is not listed. Nor are
    sources of which each span lies in one of an earlier source.

    A passage is made of spans that are similar to some earlier document's by `similarity` or more, as
    one less the word edits over the longer side, each of SPAN_WORDS words or more. Words are lower-cased (A-Z) and split at white space;
    last_word is included. Ids are whole numbers; null ids come last and null texts take no part. Rows
    with equal ids are one document in which nothing is repeated; equal rows give one row. Ties go to the
    smallest id, then to an order of the texts. Further columns are ignored; no repeats, no rows.
    """
    found = merged(shared_spans(docs, text, id, **limits), limits.get("min_words", MIN_WORDS))
    real = F.transform(F.array_sort("p.refs"), lambda r: F.when(r < NULL_ID, r))
    return found.select("doc", F.explode("passages").alias("p")).select(
        F.when(F.col("doc") < NULL_ID, F.col("doc")).alias(id),
        F.col("p.first").alias("first_word"),
        (F.col("p.last") - 1).alias("last_word"),
        (F.col("p.last") - F.col("p.first")).alias("n_words"),
        real.alias("source_ids"),
    )


def without_passages(docs: DataFrame, text: str = "text", id: str = "doc_id", **limits) -> DataFrame:
    """docs without the passages that earlier documents have; the first keeps its own. A text that is
    nothing else than such passages is dropped, all other rows stay, changed only where they repeat."""
    found = merged(shared_spans(docs, text, id, **limits), limits.get("min_words", MIN_WORDS))
    found = kept(found, "passages").select(
        F.col("doc").alias("_doc"), F.col("key").alias("_key"),
        F.transform("passages", lambda p: F.struct(p["first"].alias("first"), p["last"].alias("last"))).alias("_cut"),
    )
    # Spans of a name that stands for two texts may be those of the other one: neither is cut.
    found = found.join(shared_names(docs, text, id), ["_doc", "_key"], "left_anti")

    @F.arrow_udf("string")
    def rest(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, cuts in columns:
            out, at = [], 0
            for part in slices(texts) if len(texts) else []:
                data, offsets = text_bytes(part)
                raw = data.tobytes()
                spans = cuts.slice(at, len(part)).to_pylist()
                at += len(part)
                _, starts, ends, owner = word_hashes(part)
                begin = np.searchsorted(owner, np.arange(len(part)))
                for k, (value, own) in enumerate(zip(part.to_pylist(), spans)):
                    if not own:
                        out.append(value)
                        continue
                    pieces, done = [], int(offsets[k])
                    for span in own:
                        pieces.append(raw[done : int(starts[begin[k] + span["first"]])])
                        done = int(ends[begin[k] + span["last"] - 1])
                    out.append(b"".join([*pieces, raw[done : int(offsets[k + 1])]]).decode())
            yield pa.array(out, pa.string())

    doc, key = name_of(text, id)
    rows = docs.withColumns({"_key": key, "_doc": doc}).join(found, ["_doc", "_key"], "left")
    rows = rows.withColumn(text, F.when(F.col("_cut").isNotNull(), rest(F.col(text), F.col("_cut"))).otherwise(F.col(text)))
    empty = F.col("_cut").isNotNull() & (F.btrim(F.col(text), F.lit(" \t\n\x0b\x0c\r")) == "")
    return rows.filter(~empty).select(docs.columns)
