"""Benchmark decontamination with an FM-index for each shard of training text.

A shard is the part of an Arrow batch that is worked on at a time. Its words become numbers of the
phrases' vocabulary. Stretches in which no phrase can lie are left out of the index: words that no
phrase has, and neighbours that no phrase has side by side. Phrases of all benchmark items are searched
backwards together through a wavelet matrix; sampled suffix positions give the places; the words of all
occurrences are merged into removal spans.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.arrays import (
    LOWER,
    expanded,
    owners,
    range_hashes,
    runs,
    slices,
    sums,
    text_bytes,
)
from ticketmill.llm.storage import kept

WINDOW = 10
#: Bytes of benchmark text whose phrases go to every task at a time; more are searched in turns.
BLOCK_BYTES = 8 << 20
#: Every so many text positions, the index knows where a suffix begins.
SAMPLE = 8

#: 0-9, a-z and all bytes of characters beyond ASCII.
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True


def hashed_words(column: pa.Array) -> tuple[np.ndarray, ...]:
    """(hash, start, end, text) of each word of the lower-cased texts."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    starts, ends = runs(data, offsets, WORD)
    return range_hashes(data, starts, ends), starts, ends, owners(offsets[:-1], starts)


def pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a.astype(np.int64) << 32) | b.astype(np.int64)


def contained(sorted_values: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which are contained, their places)."""
    at = np.searchsorted(sorted_values, values)
    at[at == len(sorted_values)] = 0
    return (sorted_values[at] == values if len(sorted_values) else np.zeros(len(values), bool)), at


@dataclass
class Phrases:
    """Distinct windows of some items, padded with 0 in front; words are numbered from 1."""

    vocabulary: np.ndarray  # sorted hashes
    words: np.ndarray  # (phrases, WINDOW) numbers
    lengths: np.ndarray
    pairs: np.ndarray  # sorted keys of words that stand side by side
    singles: np.ndarray  # words that are a phrase alone
    item: np.ndarray  # items of phrase p: item[item_at[p] : item_at[p + 1]]
    item_at: np.ndarray
    names: list[str | None]

    @classmethod
    def of(cls, names: list[str | None], texts: list[str | None], window: int = WINDOW) -> Phrases:
        hashes, _, _, owner = hashed_words(pa.array(texts, pa.large_string()))
        vocabulary, numbers = np.unique(hashes, return_inverse=True)
        numbers = numbers.astype(np.int64) + 1
        own = sorted(set(names), key=lambda n: (n is None, n))
        place = {n: i for i, n in enumerate(own)}
        found: dict[tuple[int, ...], set[int]] = {}
        edges = np.searchsorted(owner, np.arange(len(texts) + 1))
        for k, name in enumerate(names):
            words = numbers[edges[k] : edges[k + 1]].tolist()
            for i in range(max(1, len(words) - window + 1) if words else 0):
                found.setdefault(tuple(words[i : i + window]), set()).add(place[name])
        table = np.zeros((len(found), window), np.int64)
        lengths = np.zeros(len(found), np.int64)
        for p, words in enumerate(found):
            lengths[p] = len(words)
            table[p, window - len(words) :] = words
        left, right = table[:, :-1].ravel(), table[:, 1:].ravel()
        counts = [len(x) for x in found.values()]
        return cls(
            vocabulary,
            table,
            lengths,
            np.unique(pair_keys(left, right)[left > 0]),
            np.unique(table[lengths == 1, -1]),
            np.array([i for x in found.values() for i in sorted(x)], np.int64),
            np.concatenate([[0], np.cumsum(counts)]).astype(np.int64),
            own,
        )


class WaveletMatrix:
    """Ranks of symbols in a sequence, by one bit vector with counts for each bit of a symbol."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.depth = max(1, int(largest).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        for level in range(self.depth - 1, -1, -1):
            bits = (symbols >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bits)]))
            self.zeros.append(int(len(bits) - bits.sum()))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its end."""
        start = np.zeros_like(end)
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            bit = ((symbol >> (self.depth - 1 - level)) & 1).astype(bool)
            start = np.where(bit, zeros + ones[start], start - ones[start])
            end = np.where(bit, zeros + ones[end], end - ones[end])
        return end - start

    def access(self, at: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(at)
        for ones, zeros in zip(self.ones, self.zeros):
            bit = ones[at + 1] - ones[at]
            symbol = 2 * symbol + bit
            at = np.where(bit.astype(bool), zeros + ones[at], at - ones[at])
        return symbol


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order, by doubling. Each 0 ends a stretch: it is smaller than every
    other symbol and than every later 0, so no comparison goes beyond it."""
    ends = np.flatnonzero(text == 0)
    rank = text + len(ends)
    rank[ends] = np.arange(len(ends))
    _, rank = np.unique(rank, return_inverse=True)
    width = 1
    while True:
        order = np.argsort(rank, kind="stable")
        if rank.max() == len(text) - 1:
            return order
        later = np.concatenate([rank[width:] + 1, np.zeros(min(width, len(text)), np.int64)])
        _, rank = np.unique(rank * (len(text) + 1) + later, return_inverse=True)
        width *= 2


class FMIndex:
    """Backward search and places of phrases. The text ends with 0 and has a 0 between stretches."""

    def __init__(self, text: np.ndarray, sample: int = SAMPLE):
        self.text_length = len(text)
        suffixes = suffix_array(text)
        before = text[suffixes - 1]
        largest = int(text.max())
        self.below = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=largest + 2))])
        self.largest = largest
        self.bwt = WaveletMatrix(before, largest)
        # Positions after a 0 are sampled as well: from them there is no way back.
        self.sampled = (suffixes % sample == 0) | (before == 0)
        self.sample_rank = np.cumsum(self.sampled) - 1
        self.samples = suffixes[self.sampled]

    def back(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        return self.below[symbol] + self.bwt.rank(symbol, row)

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
        """(phrase, first row, end row) of those that occur; phrases are right-aligned."""
        which = np.flatnonzero((phrases <= self.largest).all(axis=1))
        low = np.zeros(len(which), np.int64)
        high = np.full(len(which), self.text_length, np.int64)
        for step in range(1, phrases.shape[1] + 1):
            go = lengths[which] >= step
            symbol = phrases[which, -step]
            low = np.where(go, self.back(symbol, low), low)
            high = np.where(go, self.back(symbol, high), high)
            left = low < high
            which, low, high = which[left], low[left], high[left]
        return which, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        place = np.zeros(len(rows), np.int64)
        open_, rows, steps = np.arange(len(rows)), rows.copy(), 0
        while len(open_):
            hit = self.sampled[rows]
            place[open_[hit]] = self.samples[self.sample_rank[rows[hit]]] + steps
            open_, rows = open_[~hit], rows[~hit]
            rows = self.back(self.bwt.access(rows), rows)
            steps += 1
        return place


def occurrences(words: np.ndarray, owner: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, ...]:
    """(phrase, first word) of every occurrence in the texts whose word hashes are given."""
    none = np.zeros(0, np.int64)
    if not len(phrases.words) or not len(words):
        return none, none
    known, at = contained(phrases.vocabulary, words)
    number = np.where(known, at + 1, 0)
    near = np.flatnonzero(known[:-1] & known[1:] & (owner[:-1] == owner[1:]))
    near = near[contained(phrases.pairs, pair_keys(number[near], number[near + 1]))[0]]
    joined = np.zeros(len(words) + 1, bool)  # word i stands beside i - 1 in a phrase as well
    joined[near + 1] = True
    single = np.flatnonzero(contained(phrases.singles, number)[0])
    use = np.zeros(len(words), bool)
    use[near] = use[near + 1] = use[single] = True
    places = np.flatnonzero(use)
    if not len(places):
        return none, none
    gap = np.flatnonzero(~joined[places][1:]) + 1
    text = np.append(np.insert(number[places], gap, 0), 0)
    back = np.append(np.insert(places, gap, -1), -1)
    index = FMIndex(text)
    which, low, high = index.search(phrases.words, phrases.lengths)
    start = index.locate(expanded(low, high - low))
    return np.repeat(which, high - low), back[start]


def hit_words(n: int, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, start, 1)
    np.add.at(depth, start + length, -1)
    return np.cumsum(depth[:-1]) > 0


FOUND = (
    "struct<n_words: bigint, n_hit: bigint, spans: array<struct<first: bigint, last: bigint>>, "
    "items: array<string>, clean: string>"
)


def ragged(owner: np.ndarray, values: pa.Array, n: int) -> pa.Array:
    edges = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(edges), values)


def searched(column: pa.Array, earlier: pa.Array | None, phrases: Phrases) -> pa.Array:
    """FOUND of each text, with the spans and items of an earlier turn added."""
    n = len(column)
    words, starts, ends, owner = hashed_words(column)
    phrase, first = occurrences(words, owner, phrases)
    hit = hit_words(len(words), first, phrases.lengths[phrase])
    begin = np.searchsorted(owner, np.arange(n))
    own = np.repeat(owner[first], np.diff(phrases.item_at)[phrase])
    item = phrases.item[
        expanded(phrases.item_at[phrase], np.diff(phrases.item_at)[phrase])
    ]
    pairs = np.unique(own * len(phrases.names) + item) if len(own) else np.zeros(0, np.int64)
    names = max(1, len(phrases.names))
    edges = np.searchsorted(pairs // names, np.arange(n + 1)).tolist()
    numbers = (pairs % names).tolist()
    items = [[phrases.names[i] for i in numbers[a:b]] for a, b in zip(edges, edges[1:])]
    if earlier is not None:
        for k, old in enumerate(earlier.to_pylist()):
            for span in old["spans"]:
                hit[begin[k] + span["first"] : begin[k] + span["last"]] = True
            items[k] = items[k] + [i for i in old["items"] if i not in items[k]]
    edge = np.ones(len(words) + 1, bool)
    edge[1:-1] = owner[1:] != owner[:-1]
    padded = np.append(hit, False)
    opens = np.flatnonzero(hit & (~np.insert(hit[:-1], 0, False) | edge[:-1])) if len(hit) else begin[:0]
    closes = np.flatnonzero(padded[:-1] & (~padded[1:] | edge[1:])) + 1 if len(hit) else begin[:0]
    spans_of = owner[opens] if len(hit) else begin[:0]
    spans = pa.StructArray.from_arrays(
        [pa.array(opens - begin[spans_of], pa.int64()), pa.array(closes - begin[spans_of], pa.int64())],
        ["first", "last"],
    )
    clean: list[str | None] = [None] * n
    data, offsets = text_bytes(column)
    raw = data.tobytes()
    cut_at = {}
    for k, a, b in zip(spans_of.tolist(), opens.tolist(), closes.tolist()):
        cut_at.setdefault(k, []).append((int(starts[a]), int(ends[b - 1])))
    for k, cuts in cut_at.items():
        at, parts = int(offsets[k]), []
        for a, b in cuts:
            parts.append(raw[at:a])
            at = b
        clean[k] = b"".join([*parts, raw[at : offsets[k + 1]]]).decode()
    return pa.StructArray.from_arrays(
        [
            pa.array(np.bincount(owner, minlength=n), pa.int64()),
            pa.array(sums(hit, owner, n), pa.int64()),
            ragged(spans_of, spans, n),
            pa.array(items, pa.list_(pa.string())),
            pa.array(clean, pa.string()),
        ],
        ["n_words", "n_hit", "spans", "items", "clean"],
    )


def benchmark_blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[tuple[list, list]]:
    """(ids as strings, texts) of the items, about BLOCK_BYTES of text at a time."""
    items = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-size // BLOCK_BYTES))
    for block in range(blocks):
        mine = F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block
        rows = items.filter("text is not null").filter(mine).collect()
        yield [r["item"] for r in rows], [r["text"] for r in rows]


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """docs with n_words, n_hit, spans, items and clean_text; columns of these names are replaced.

    A word is hit if it lies in any occurrence of `window` consecutive words of an item, or of all words
    of an item that has fewer. spans: merged runs of hit words, by word numbers, the last not included.
    items: ids as strings of the items with occurrences, each once. clean_text: the text without the
    characters from the first to the last word of each span; the text itself where nothing is hit.

    Null and empty texts have no words, and so have items that are null or empty. Repeated rows get the
    same result, null ids are ids like others, an empty benchmark hits nothing, and empty tables stay
    empty. Benchmarks beyond BLOCK_BYTES are searched in several turns, with the same result.
    """
    rows, turns = docs, 0
    for names, texts in benchmark_blocks(benchmark, item, item_text):
        phrases = docs.sparkSession.sparkContext.broadcast(Phrases.of(names, texts, window))
        if turns:  # one block of phrases is with the tasks at a time
            rows = kept(rows, "decontaminated")
            found = _next_turn(phrases)(F.col(text), F.col("_found"))
        else:
            found = _first_turn(phrases)(F.col(text))
        rows, turns = rows.withColumn("_found", found), turns + 1
    return rows.withColumns(
        {
            "n_words": F.col("_found.n_words"),
            "n_hit": F.col("_found.n_hit"),
            "spans": F.col("_found.spans"),
            "items": F.col("_found.items"),
            "clean_text": F.coalesce(F.col("_found.clean"), F.col(text)),
        }
    ).drop("_found")


def _first_turn(phrases):
    @F.arrow_udf(FOUND)
    def first_turn(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            parts = [searched(part, None, phrases.value) for part in slices(column)]
            yield pa.concat_arrays(parts) if parts else searched(column, None, phrases.value)

    return first_turn


def _next_turn(phrases):
    @F.arrow_udf(FOUND)
    def next_turn(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for column, earlier in columns:
            yield searched(column, earlier, phrases.value)

    return next_turn
