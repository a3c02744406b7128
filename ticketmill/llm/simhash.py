"""Near-duplicates by SimHash: fingerprints that differ in a few bits at most are linked.

Index. The top nodes are masked bit patterns: the 64 bits are cut into max_bits + 2 blocks, and two
fingerprints within max_bits agree on two whole blocks at least, so they meet below one pattern of
two blocks. Below a pattern, fingerprints are sorted by Gray rank, which puts similar ones side by
side. Inner nodes stand for 8 neighbours each, and hold the bits that all below them share. A search
adds up the differences to the shared bits on its way down: over max_bits, a whole group is left out;
if the differences and all open bits together are within max_bits, a whole group is linked at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.arrays import LOWER, SPACE, expanded, owners, runs, slices, text_bytes
from ticketmill.llm.graph import components
from ticketmill.llm.storage import kept

SEED = 42
BITS = 64
FANOUT = 8
#: Fingerprints below one pattern that one task compares; more are dealt out in pairs of chunks.
GROUP = 16_384
#: Pairs of a fingerprint and a node that are looked at at a time.
FRONTIER = 1 << 20


def shingle_hashes(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every shingle, the text that it is from), in order of the texts."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    starts, ends = runs(data, offsets, ~SPACE)
    lengths = ends - starts
    places = np.cumsum(lengths + 1) - (lengths + 1)
    spaced = np.full(int((lengths + 1).sum()), 32, np.uint8)
    spaced[expanded(places, lengths)] = data[expanded(starts, lengths)]
    text = owners(offsets[:-1], starts)
    last_word = np.searchsorted(text, text, "right") - 1
    at = np.arange(len(starts))
    first = np.searchsorted(text, text, "left")
    real = (at + width - 1 <= last_word) | (at == first)
    to = np.minimum(at + width - 1, last_word)[real]
    raw, digest = spaced.tobytes(), xxhash.xxh64_intdigest
    hashes = [
        digest(raw[s:e], SEED)
        for s, e in zip(places[real].tolist(), (places[to] + lengths[to]).tolist())
    ]
    return np.array(hashes, np.uint64), text[real]


def fingerprints(column: pa.Array, width: int) -> np.ndarray:
    """A bit is 1 if it is set in over half of the text's shingle hashes; no words: 0."""
    hashes, text = shingle_hashes(column, width)
    ones = np.zeros((len(column), BITS), np.int64)
    total = np.bincount(text, minlength=len(column))
    for at in range(0, len(hashes), 1 << 16):
        part, own = hashes[at : at + (1 << 16)], text[at : at + (1 << 16)]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        begins = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        ones[own[begins]] += np.add.reduceat(bits, begins, axis=0, dtype=np.int64)
    majority = 2 * ones > total[:, None]
    return np.packbits(majority, axis=1, bitorder="little").view(np.int64).ravel()


def fingerprint(text: Column, width: int) -> Column:
    """The fingerprint as a signed long."""

    @F.arrow_udf("long")
    def simhash(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            parts = [fingerprints(part, width) for part in slices(column)]
            yield pa.array(np.concatenate([np.zeros(0, np.int64), *parts]), pa.int64())

    return simhash(text)


def gray_rank(value: Column) -> Column:
    """The place of a 64-bit pattern in the Gray code's order."""
    for step in (1, 2, 4, 8, 16, 32):
        value = value.bitwiseXOR(F.shiftrightunsigned(value, step))
    return value


def pattern_masks(max_bits: int) -> list[int]:
    """Signed masks of every two of max_bits + 2 blocks, whose sizes differ by one bit at most."""
    edges = np.linspace(0, BITS, max_bits + 3).astype(int).tolist()
    blocks = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:])]
    return [int(np.uint64(a | b).astype(np.int64)) for a, b in combinations(blocks, 2)]


def below_patterns(prints: DataFrame, max_bits: int) -> DataFrame:
    """(mask, pattern, i, j, fp, rank): every fingerprint below each of its patterns.

    A pattern with over GROUP fingerprints is dealt out in chunks; each chunk then meets each other
    one in a group (i, j) of its own, so no task gets more than two chunks of it."""
    masks = F.array(*(F.lit(m).cast("long") for m in pattern_masks(max_bits)))
    rows = prints.select("fp", F.posexplode(masks).alias("mask", "bits")).select(
        "mask", F.col("fp").bitwiseAND(F.col("bits")).alias("pattern"), "fp"
    )
    large = rows.groupBy("mask", "pattern").agg(F.count("*").alias("n")).filter(F.col("n") > GROUP)
    chunks = F.coalesce(F.ceil(F.col("n") / GROUP), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("fp"), "chunks").cast("int")
    return (
        rows.join(kept(large, "large-patterns"), ["mask", "pattern"], "left")
        .withColumn("chunks", chunks)
        .withColumn("own", own)
        .select("mask", "pattern", "own", "fp",
                F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
        .select("mask", "pattern", F.least("own", "other").alias("i"),
                F.greatest("own", "other").alias("j"), "fp", gray_rank(F.col("fp")).alias("rank"))
    )


def _levels(prints: np.ndarray, group: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """From the leaves up: (first leaf, leaves, shared bits, which bits are shared) of each node; a
    node never crosses from group to group. The last level has one node a group."""
    n = len(prints)
    first, shared, mask = np.arange(n), prints, np.full(n, ~np.uint64(0))
    size, own, levels = np.ones(n, np.int64), group, []
    while True:
        begins = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        levels.append((first, size, shared, mask))
        if len(begins) == len(own):
            return levels
        rank = np.arange(len(own)) - np.repeat(begins, np.diff(np.append(begins, len(own))))
        heads = np.flatnonzero(rank % FANOUT == 0)
        ones = np.bitwise_and.reduceat(shared & mask, heads)
        zeros = np.bitwise_and.reduceat(~shared & mask, heads)
        levels[-1] += (heads,)
        first, size, own = first[heads], np.add.reduceat(size, heads), own[heads]
        shared, mask = ones, ones | zeros


def links(prints: np.ndarray, group: np.ndarray, max_bits: int) -> np.ndarray:
    """For each of the sorted fingerprints, one that stands for all it is linked to within its
    group, directly or by others: as few links as keep everything connected."""
    levels = _levels(prints, group)
    label = np.arange(len(prints))
    roots = np.cumsum(np.append(False, group[1:] != group[:-1]))
    step = max(1, FRONTIER // 64)
    for at in range(0, len(prints), step):
        query = np.arange(at, min(at + step, len(prints)))
        stack = [(len(levels) - 1, query, roots[query])]
        while stack:
            depth, query, node = stack.pop()
            if len(query) > FRONTIER:
                half = len(query) // 2
                stack += [(depth, query[:half], node[:half]), (depth, query[half:], node[half:])]
                continue
            first, size, shared, mask = levels[depth][:4]
            apart = np.bitwise_count((prints[query] ^ shared[node]) & mask[node]).astype(int)
            left = (apart <= max_bits) & (first[node] < query)
            query, node, apart = query[left], node[left], apart[left]
            whole = apart + BITS - np.bitwise_count(mask[node]) <= max_bits
            merge(label, query[whole], first[node[whole]])
            query, node = query[~whole], node[~whole]
            if len(query):
                heads = levels[depth - 1][4]
                begin, end = heads[node], np.append(heads[1:], len(levels[depth - 1][0]))[node]
                stack.append((depth - 1, np.repeat(query, end - begin), expanded(begin, end - begin)))
    return label


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of a and b; label[x] is the lowest member known of x's set."""
    while len(a):
        la, lb = label[a], label[b]
        apart = la != lb
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def _search(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Links of sorted rows; the last group of a batch waits for its rest."""

    def found(table: pa.Table) -> pa.RecordBatch:
        keys = [table[c].to_numpy() for c in ("mask", "pattern", "i", "j")]
        fp = table["fp"].to_numpy()
        new = np.append(False, np.logical_or.reduce([k[1:] != k[:-1] for k in keys]))
        label = links(fp.view(np.uint64), np.cumsum(new), max_bits)
        linked = np.flatnonzero(label != np.arange(len(label)))
        return pa.record_batch([pa.array(fp[linked]), pa.array(fp[label[linked]])], ["u", "v"])

    waiting = None
    for batch in batches:
        if not len(batch):
            continue
        table = pa.Table.from_batches([batch])
        if waiting is not None:
            table = pa.concat_tables([waiting, table])
        same = np.ones(len(table), bool)
        for c in ("mask", "pattern", "i", "j"):
            values = table[c].to_numpy()
            same &= values == values[-1]
        end = len(table) - int(same.sum())
        if end:
            yield found(table.slice(0, end))
        waiting = table.slice(end)
    if waiting is not None:
        yield found(waiting)


def near_duplicates(
    docs: DataFrame,
    width: int = 4,
    max_bits: int = 4,
    text: str = "text",
    id: str = "doc_id",
    keep_text: bool = True,
) -> DataFrame:
    """docs (without the text unless keep_text) with fingerprint (16 hex digits), component_id and keep; columns of these names go.

    component_id is the smallest id that can be reached by links of at most max_bits, the row's own
    included; null if no row of the component has an id. keep is true for one row of each component
    and null otherwise: the one with that id. Of rows that agree in id and fingerprint, any one is
    kept. Null texts and texts without words have fingerprint zero and are linked as such; null ids
    come after all others; repeated rows are in one component. An empty table gives an empty table.

    Fingerprints are written to the shared folder once, with all columns but the text, or with the id
    alone if the text is kept: texts are then fingerprinted again at the end rather than stored again.
    """
    docs = docs.drop("fingerprint", "component_id", "keep")
    docs = docs.withColumn("_fp", fingerprint(F.col(text), width))
    stored = kept(docs.select(id, "_fp") if keep_text else docs.drop(text), "fingerprints")
    counted = stored.groupBy(F.col("_fp").alias("fp"), F.col(id).alias("doc")).agg(F.count("*").alias("n"))
    first = F.struct(F.col("doc").isNull().alias("none"), "doc", "fp", "n")
    prints = kept(counted.groupBy("fp").agg(F.min(first).alias("first")), "prints")

    groups = below_patterns(prints.select("fp"), max_bits)
    groups = groups.repartition("mask", "pattern", "i", "j").sortWithinPartitions(
        "mask", "pattern", "i", "j", "rank"
    )
    found = groups.mapInArrow(lambda batches: _search(batches, max_bits), "u long, v long")
    linked = kept(components(kept(found, "links")), "linked")
    named = prints.join(linked.withColumnRenamed("u", "fp"), "fp", "left").withColumn(
        "m", F.coalesce("m", "fp")
    )
    firsts = named.groupBy("m").agg(F.min("first").alias("_first"))
    table = kept(named.join(firsts, "m").select(F.col("fp").alias("_fp"), "_first"), "components")

    is_first = (F.col("_fp") == F.col("_first.fp")) & F.col(id).eqNullSafe(F.col("_first.doc"))
    rows = (docs if keep_text else stored).join(table, "_fp").withColumns(
        {
            "fingerprint": F.lpad(F.lower(F.hex("_fp")), 16, "0"),
            "component_id": F.col("_first.doc"),
            "keep": F.when(is_first, F.col("_first.n") == 1),
        }
    )
    return rows


def one_of_each(docs: DataFrame, **kwargs) -> DataFrame:
    """The rows of docs that near_duplicates() keeps, with the columns of docs. Of rows that agree in id and
    fingerprint, the one whose values are least, by a hash and then as JSON: the same in each run."""
    rows = near_duplicates(docs, **kwargs)
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    least = F.min_by(whole, F.struct(F.xxhash64(whole), F.to_json(whole))).alias("_row")
    repeated = rows.filter("keep = false").groupBy("_fp").agg(least)
    return rows.filter("keep").select(docs.columns).union(repeated.select("_row.*"))
