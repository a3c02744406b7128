"""Join of texts whose sets of word n-grams overlap by a Jaccard similarity, by token-combination prefixes.

A token is the 64-bit hash of a shingle. Equal sets are one set from here on. All tokens have one order:
first a quarter of them, chosen by hash, the rarest first; then the others by hash. Only the first of these
need a count, so a quarter of the tokens is shuffled, once. Of n tokens, n - ceil(similarity * n) at most may
be missing in a partner. A set indexes a prefix of its tokens: single ones of the rare class 1, pairs of
class 2, triples of class 3 (the most frequent). The prefix is extended until p1 + max(0, p2 - 1) +
max(0, p3 - 2) is over what may be missing, p being its tokens of each class. Of two similar sets, take
the one whose prefix ends first: some class has one, two or three tokens of it that the other has too,
and has in its own prefix. So both index the same token or combination, and no link is lost. A token that
stands in one set only fills a prefix, but needs no entry.

Entries carry a size band, so only sets of like sizes meet, and how many tokens may still be shared from
here on; candidates that can't reach the overlap are left out. Candidates are verified on whole sets, in
two steps. Each set goes to the group of the one it shares most entries with, and so do near copies of one
text; a group's sets meet in one task, or in chunks, and only links that connect something leave it. Then, within
an entry, sets of different groups are paired and verified one by one; entries that one group has alone are passed over.
Tables and shuffle files go as soon as what is made of them is written, so the disk holds a few steps only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.arrays import expanded, mixed, slices
from ticketmill.llm.graph import components
from ticketmill.llm.simhash import shingle_hashes
from ticketmill.llm.storage import free_shuffles, kept, kept_at, remove

#: Tokens below this hash come first in the order, by their counts: a quarter.
COUNTED = 1 << 62
#: Sets that hold a token, from which on it is of class 2 and of class 3.
CLASS_FROM = (256, 4096)
#: Sizes of sets up to which tokens are of class 2 and of class 3: combinations of long prefixes are too many.
CLASS_SIZES = (300, 60)
#: Rows of an entry, or candidates of a set, that one task compares; more are dealt out in chunks.
GROUP = 8_192
#: Tokens of the sets that one task compares with each other; a larger group is dealt out in chunks.
GROUP_TOKENS = 1 << 21
#: Bits of a filter that is sent to all tasks.
FILTER_BITS = 1 << 26
#: Text bytes that are hashed at a time.
SLICE = 1 << 20
#: Bits of one bitmap of Spark's bitmap functions.
BITMAP = 32_768

SET = "struct<key: binary, n: bigint, head: array<bigint>>"


def missing(n, similarity: int):
    """How many of n tokens a partner may lack."""
    return n - -(-similarity * n // 100)


def token_sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct tokens in order of their texts and ascending, where those of each text begin and the end)."""
    hashes, text = shingle_hashes(column, width)
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    counts = np.bincount(text[new], minlength=len(column))
    return hashes[new], np.concatenate([[0], np.cumsum(counts)])


def token_set(text: Column, width: int, similarity: int) -> Column:
    """(key, n, head): a 128-bit name of the set, its size, and the tokens that its prefix can hold."""

    def heads(column: pa.Array) -> pa.Array:
        tokens, at = token_sets(column, width)
        n = np.diff(at)
        raw = tokens.tobytes()
        keys = [blake2b(raw[8 * a : 8 * b], digest_size=16).digest() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        below = np.concatenate([[0], np.cumsum(tokens < COUNTED)])
        size = np.maximum(below[at[1:]] - below[at[:-1]], np.minimum(n, missing(n, similarity) + 4))
        values = tokens[expanded(at[:-1], size)].view(np.int64)
        offsets = pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32())
        return pa.StructArray.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(n, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(values))],
            ["key", "n", "head"],
        )

    @F.arrow_udf(SET)
    def sets(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            parts = [heads(part) for part in slices(column, SLICE)]
            yield pa.concat_arrays(parts) if parts else heads(column)

    return sets(text)


def whole_set(text: Column, width: int) -> Column:
    """(key, tokens) of every text."""

    def whole(column: pa.Array) -> pa.Array:
        tokens, at = token_sets(column, width)
        raw = tokens.tobytes()
        keys = [blake2b(raw[8 * a : 8 * b], digest_size=16).digest() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(tokens.view(np.int64)))
        return pa.StructArray.from_arrays([pa.array(keys, pa.binary()), lists], ["key", "tokens"])

    @F.arrow_udf("struct<key: binary, tokens: array<bigint>>")
    def sets(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            parts = [whole(part) for part in slices(column, SLICE)]
            yield pa.concat_arrays(parts) if parts else whole(column)

    return sets(text)


def possible(values: DataFrame, column: str) -> Column:
    """A test, of few false hits, whether a 64-bit column holds one of the values. What it sends to all tasks
    has FILTER_BITS bits, whatever the number of values: with very many, it passes all."""
    place = F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))
    spread = values.select(place.alias("place"))
    rows = (
        spread.groupBy((F.col("place") / BITMAP).cast("int").alias("k"))
        .agg(F.bitmap_construct_agg((F.col("place") % BITMAP)).alias("bits"))
        .collect()
    )
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in rows:
        bits[r["k"] * BITMAP // 8 : (r["k"] + 1) * BITMAP // 8] = np.frombuffer(r["bits"], np.uint8)
    sent = values.sparkSession.sparkContext.broadcast(bits)

    @F.arrow_udf("boolean")
    def there(places: pa.Array) -> pa.Array:
        p = places.to_numpy(zero_copy_only=False)
        return pa.array((sent.value[p >> 3] >> (p & 7).astype(np.uint8) & 1).astype(bool))

    return there(place)


def band(n: int, similarity: int) -> int:
    """Sizes of similar sets differ by one band at most; the base is a little wider, for rounding's sake."""
    return int(math.log(n) / -math.log((similarity - 1) / 100))


def entries(s: int, n: int, q: int, tokens: np.ndarray, counts: np.ndarray, idx: np.ndarray, similarity: int):
    """(entry, how many tokens can be shared from it on) of one set, for each of its two size bands.

    tokens, counts, idx: the tokens of its head that other heads hold, in how many sets, and their places in
    the head; q: how many of the head's tokens are counted ones, which come first in the order."""
    counted = idx < q
    order = np.lexsort((tokens, np.where(counted, counts, idx), ~counted))
    tokens, counts, idx, counted = tokens[order], counts[order], idx[order], counted[order]
    m = int(counted.sum())
    place = np.where(counted, q - m + np.arange(len(tokens)), idx)
    values = tokens.view(np.uint64)
    for frame in (band(n, similarity), band(n, similarity) + 1):
        largest = (100 / (similarity - 1)) ** (frame + 1)
        cls = np.ones(len(tokens), int)
        for k, (least, sizes) in enumerate(zip(CLASS_FROM, CLASS_SIZES)):
            if largest <= sizes:
                cls[counts >= least] = k + 2
        slack = 3 if largest <= max(CLASS_SIZES) else 0
        two, three = (np.cumsum(cls == k) - (cls == k) for k in (2, 3))
        before = place - two - three + np.maximum(two - 1, 0) + np.maximum(three - 2, 0)
        inside = before <= missing(n, similarity)
        for k in (1, 2, 3):
            own = np.flatnonzero(inside & (cls == k))
            if len(own) < k:
                continue
            picks = own[:, None] if k == 1 else np.array(list(combinations(own.tolist(), k)))
            entry = np.full(len(picks), np.uint64(frame * 4 + k))
            # A combination is one whichever way its tokens are ordered here: all sets order them alike.
            for column in picks.T:
                entry = mixed(entry * np.uint64(0x9E3779B97F4A7C15) + values[column])
            yield entry.view(np.int64), n - place[picks[:, 0]] + slack


def _index(batches: Iterator[pa.RecordBatch], similarity: int) -> Iterator[pa.RecordBatch]:
    names = ["entry", "s", "n", "reach"]
    for batch in batches:
        found = []
        for s, n, q, shared in zip(*(batch[c] for c in ("s", "n", "q", "shared"))):
            shared = shared.values
            fields = [np.array(shared.field(c), np.int64) for c in ("token", "w", "idx")]
            s, n = s.as_py(), n.as_py()
            for entry, reach in entries(s, n, q.as_py(), *fields, similarity):
                found.append((entry, np.full(len(entry), s), np.full(len(entry), n), reach))
            if sum(len(f[0]) for f in found[-2:]) and sum(len(f[0]) for f in found) > 1 << 18:
                yield pa.record_batch([pa.array(np.concatenate(x), pa.int64()) for x in zip(*found)], names)
                found = []
        if found:
            yield pa.record_batch([pa.array(np.concatenate(x), pa.int64()) for x in zip(*found)], names)


def needed(a: Column, b: Column, similarity: int) -> Column:
    """The least overlap of similar sets of these sizes."""
    return F.ceil(similarity * (a + b) / F.lit(100 + similarity))


def _across(batches: Iterator[pa.RecordBatch], similarity: int) -> Iterator[pa.RecordBatch]:
    """Candidates within an entry, sets with one label left out; rows come sorted by entry, chunks and s."""

    def pairs(table: pa.Table) -> Iterator[pa.RecordBatch]:
        entry, i, j, s, n, reach, label = (table[c].to_numpy() for c in ("entry", "i", "j", "s", "n", "reach", "label"))
        own = table["own"].to_numpy()
        new = np.append(True, (entry[1:] != entry[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]))
        at = np.append(np.flatnonzero(new), len(s))
        several = np.minimum.reduceat(label, at[:-1]) < np.maximum.reduceat(label, at[:-1])
        found, held = [], 0
        for a, b in zip(at[:-1][several].tolist(), at[1:][several].tolist()):
            for x in range(a + 1, b):
                y = np.arange(a, x)
                ok = label[y] != label[x]
                # Chunks meet those of their own kind in one group only.
                ok &= (i[a] == j[a]) | (own[y] != own[x])
                need = -(-similarity * (n[y] + n[x]) // (100 + similarity))
                y = y[ok & (np.minimum(reach[y], reach[x]) >= need)]
                if len(y):
                    found.append((np.full(len(y), s[x]), s[y]))
                    held += len(y)
                if held > 1 << 20:
                    yield distinct(found)
                    found, held = [], 0
        if found:
            yield distinct(found)

    def distinct(found: list) -> pa.RecordBatch:
        a, b = (np.concatenate(x) for x in zip(*found))
        both = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)]), axis=1)
        return pa.record_batch([pa.array(both[0]), pa.array(both[1])], ["a", "b"])

    waiting = None
    for batch in batches:
        if not len(batch):
            continue
        table = pa.Table.from_batches([batch])
        if waiting is not None:
            table = pa.concat_tables([waiting, table])
        same = np.ones(len(table), bool)
        for c in ("entry", "i", "j"):
            values = table[c].to_numpy()
            same &= values == values[-1]
        end = len(table) - int(same.sum())
        if end:
            yield from pairs(table.slice(0, end).combine_chunks())
        waiting = table.slice(end)
    if waiting is not None:
        yield from pairs(waiting.combine_chunks())


def linked_in_group(sizes: np.ndarray, own: np.ndarray, tokens: np.ndarray, similarity: int) -> list[tuple[int, int]]:
    """Links (x, y) that connect all similar sets of a group of sets (tokens, one after the other); sets of one chunk
    (own) meet in a group of that chunk only, unless all are of one. Each set is held as what it lacks of the
    first one, in bits, and what it has beside; so an overlap is a count of bits and a few shared extras."""
    n, at = len(sizes), np.concatenate([[0], np.cumsum(sizes)])
    first = tokens[: at[1]]
    place = np.searchsorted(first, tokens)
    place[place == len(first)] = 0
    known = first[place] == tokens
    owner = np.repeat(np.arange(n), sizes)
    has = np.zeros((n, (len(first) + 63) // 64 * 8), np.uint8)
    held = np.zeros((1, has.shape[1] * 8), bool)
    for x in range(n):
        inside = place[at[x] : at[x + 1]][known[at[x] : at[x + 1]]]
        held[:] = False
        held[0, inside] = True
        has[x] = np.packbits(held, axis=1)[0]
    has = has.view(np.uint64)
    extra, whose = tokens[~known], owner[~known]
    order = np.argsort(extra, kind="stable")
    extra, whose = extra[order], whose[order]
    new = np.flatnonzero(np.append(True, extra[1:] != extra[:-1])) if len(extra) else np.zeros(0, int)
    length = np.diff(np.append(new, len(extra)))
    shared = length > 1
    holders = [whose[b : b + c] for b, c in zip(new[shared].tolist(), length[shared].tolist())]
    of_set: dict[int, list[np.ndarray]] = {}
    for members in holders:
        for x in members.tolist():
            of_set.setdefault(x, []).append(members)
    label, found, one_chunk = np.arange(n), [], bool((own == own[0]).all())
    for x in range(1, n):
        both = np.bitwise_count(has[:x] & has[x]).sum(axis=1, dtype=np.int64)
        if x in of_set:
            both += np.bincount(np.concatenate(of_set[x]), minlength=n)[:x]
        ok = (100 * both >= similarity * (sizes[:x] + sizes[x] - both)) & (label[:x] != label[x])
        if not one_chunk:
            ok &= own[:x] != own[x]
        like = np.flatnonzero(ok)
        _, one = np.unique(label[like], return_index=True)
        for y in like[one].tolist():
            found.append((x, y))
            low, high = sorted((label[x], label[y]))
            label[label == high] = low
    return found


def _grouped(batches: Iterator[pa.RecordBatch], similarity: int) -> Iterator[pa.RecordBatch]:
    """Links within each (root, i, j); rows come in that order, so one group is held at a time."""

    def links(rows: list[tuple]) -> pa.RecordBatch:
        s = np.array([r[0] for r in rows], np.int64)
        sizes, own = np.array([len(r[2]) for r in rows]), np.array([r[1] for r in rows])
        found = linked_in_group(sizes, own, np.concatenate([r[2] for r in rows]), similarity)
        x, y = np.array(found, int).reshape(-1, 2).T
        return pa.record_batch([pa.array(s[x]), pa.array(s[y])], ["u", "v"])

    key, rows = None, []
    for batch in batches:
        lists = batch["tokens"]
        at, values = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)
        keys = zip(*(batch[c].to_pylist() for c in ("root", "i", "j")))
        for k, (own_key, s, own) in enumerate(zip(keys, batch["s"].to_pylist(), batch["own"].to_pylist())):
            if own_key != key:
                if len(rows) > 1:
                    yield links(rows)
                key, rows = own_key, []
            rows.append((s, own, values[at[k] : at[k + 1]].copy()))
    if len(rows) > 1:
        yield links(rows)


def dealt_out(rows: DataFrame) -> DataFrame:
    """rows (s, chunks, ...) with `own`, the chunk of each, and i and j, the two chunks that meet: in as many places as
    there are chunks. Where there is one chunk, a row stays one."""
    alone = rows.filter("chunks = 1").select("*", *(F.lit(0).alias(c) for c in ("own", "i", "j")))
    many = (
        rows.filter("chunks > 1")
        .withColumn("own", F.pmod(F.xxhash64("s"), "chunks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
        .drop("other")
    )
    return alone.unionByName(many).drop("chunks")


def linked_in_groups(sets: DataFrame, similarity: int) -> DataFrame:
    """(u, v) that connect all similar sets (s, root, chunks, tokens) of one root, each chunk of which meets each other
    one in a group (i, j)."""
    keys = ["root", "i", "j"]
    dealt = dealt_out(sets.filter("root IS NOT NULL")).select(*keys, "own", "s", "tokens")
    dealt = dealt.repartition(*keys).sortWithinPartitions(*keys, "s")
    return dealt.mapInArrow(lambda x: _grouped(x, similarity), "u bigint, v bigint")


def _similar(batches: Iterator[pa.RecordBatch], similarity: int) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) that are similar. Of each (a, part), the row without b comes first and has a's tokens."""
    mine = None
    for batch in batches:
        a, b = batch["a"].to_pylist(), batch["b"].to_pylist()
        lists = batch["tokens"]
        at, values = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)
        found = []
        for k, (x, y) in enumerate(zip(a, b)):
            own = values[at[k] : at[k + 1]]
            if y is None:
                mine = own.copy()
                continue
            small, large = sorted((mine, own), key=len)
            where = np.searchsorted(large, small)
            where[where == len(large)] = 0
            both = int((large[where] == small).sum())
            if 100 * both >= similarity * (len(mine) + len(own) - both):
                found.append((x, y))
        if found:
            yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*found)], ["u", "v"])


def similar(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Those of pairs (a, b) whose whole sets (s, tokens) are similar, as (u, v). A set with very many
    candidates is compared in parts, each with its own copy of that set."""
    many = pairs.groupBy("a").agg(F.count("*").alias("c")).filter(F.col("c") > GROUP)
    part = F.pmod(F.xxhash64("b"), F.coalesce(F.ceil(F.col("c") / GROUP), F.lit(1)))
    dealt = kept(pairs.join(many, "a", "left").select("a", "b", part.alias("part")), "candidates")
    left = dealt.select("a", "part").distinct().join(sets.withColumnRenamed("s", "a"), "a")
    left = left.select("a", "part", F.lit(None).cast("bigint").alias("b"), "tokens")
    right = dealt.join(sets.withColumnRenamed("s", "b"), "b").select("a", "part", "b", "tokens")
    rows = left.union(right).repartition("a", "part").sortWithinPartitions("a", "part", F.asc_nulls_first("b"))
    return rows.mapInArrow(lambda x: _similar(x, similarity), "u bigint, v bigint")


def indexed(sets: DataFrame, similarity: int) -> DataFrame:
    """(entry, s, n, reach) of all sets (s, n, head)."""
    # A set of this size or less has no partner but itself, which it meets under its key.
    heads = sets.filter(F.floor(F.col("n") * 100 / similarity) > F.col("n")).withColumn(
        "q", F.size(F.filter("head", lambda x: (x >= 0) & (x < COUNTED)))
    )
    counts = kept(
        heads.select(F.explode("head").alias("token")).groupBy("token").agg(F.count("*").alias("w")).filter("w > 1"),
        "token-counts",
    )
    free_shuffles(sets.sparkSession)
    tokens = heads.select("s", "n", "q", F.posexplode("head").alias("idx", "token"))
    shared = tokens.filter(possible(counts.select("token"), "token")).join(counts, "token")
    by_set = shared.groupBy("s", "n", "q").agg(F.collect_list(F.struct("token", "w", "idx")).alias("shared"))
    schema = "entry bigint, s bigint, n bigint, reach bigint"
    return kept(by_set.mapInArrow(lambda x: _index(x, similarity), schema), "entries")


def linked_sets(sets: DataFrame, index: DataFrame, docs: DataFrame, width: int, similarity: int, text: str,
                id: str) -> DataFrame:
    """(s, m) of every set that has a link: m is the lowest set of its component.

    sets: key, s, n and one, the hash of an id under which docs have the set; index: their entries; docs: the texts."""
    spark = docs.sparkSession
    centre = F.min(F.struct("s", "n", "reach")).alias("c")
    centres = index.groupBy("entry").agg(F.count("*").alias("rows"), centre).filter("rows > 1")
    met = kept(index.join(centres, "entry"), "met-entries")
    free_shuffles(spark)
    close = F.least("reach", "c.reach") >= needed(F.col("n"), F.col("c.n"), similarity)
    shares = met.filter((F.col("s") != F.col("c.s")) & close).groupBy(F.col("s").alias("b"), F.col("c.s").alias("a"))
    best = F.max_by("a", F.struct("times", -F.col("a"))).alias("a")
    first = kept(shares.agg(F.count("*").alias("times")).groupBy("b").agg(best).select("a", "b"), "first-candidates")
    roots = components(first.select(F.col("a").alias("u"), F.col("b").alias("v")))
    roots = kept(roots.select(F.col("u").alias("s"), F.col("m").alias("root")), "roots")

    # A root of more than GROUP_TOKENS tokens is dealt out in chunks.
    named = sets.join(met.select("s").distinct(), "s").join(roots, "s", "left")
    total = named.filter("root IS NOT NULL").groupBy("root").agg(F.sum("n").alias("t")).filter(F.col("t") > GROUP_TOKENS)
    chunks = F.coalesce(F.ceil(F.col("t") / GROUP_TOKENS), F.lit(1)).cast("int").alias("chunks")
    named = kept(named.join(total, "root", "left").select("key", "s", "one", "root", chunks), "candidate-sets")
    some = docs.select(F.xxhash64(id).alias("one"), F.col(text).alias("text"))
    some = some.filter(possible(named.select("one"), "one")).select(whole_set(F.col("text"), width).alias("x"))
    # Of equal sets one, before it meets its name: both by the key, so sets are shuffled once.
    some = some.select("x.key", "x.tokens").groupBy("key").agg(F.first("tokens").alias("tokens"))
    whole = kept(some.join(named.drop("one"), "key").drop("key"), "candidate-tokens")
    free_shuffles(spark)

    links = kept(linked_in_groups(whole, similarity), "group-links")
    free_shuffles(spark)
    # Sets of one root are done with.
    labelled = met.drop("c").join(roots, "s", "left").select(
        "entry", "s", "n", "reach", F.coalesce("root", "s").alias("label"),
        F.ceil(F.col("rows") / GROUP).cast("int").alias("chunks"),
    )
    keys = ["entry", "i", "j"]
    dealt = dealt_out(labelled).repartition(*keys).sortWithinPartitions(*keys, "s")
    across = dealt.mapInArrow(lambda x: _across(x, similarity), "a bigint, b bigint").distinct()
    across = kept(across, "other-candidates")
    free_shuffles(spark)
    links = kept(links.union(similar(across, whole.select("s", "tokens"), similarity)), "links")
    free_shuffles(spark)
    return components(links).withColumnRenamed("u", "s")


def jaccard_join(
    docs: DataFrame,
    width: int = 5,
    similarity: int = 80,
    text: str = "text",
    id: str = "doc_id",
) -> DataFrame:
    """docs without the text, with n_shingles (the size of the set) and component_id, the smallest id that can
    be reached by links of at least similarity percent, the row's own included; columns of these names go.

    A set has the distinct shingles of width words, A-Z in lower case; fewer words make one shingle. Null texts
    and texts without words have an empty set, which is linked with nothing, not even an equal one. Equal sets
    are linked, so repeated rows are too. Null ids come after all others; component_id is null where no row of
    a component has an id. Very long texts are sets like others. An empty table gives an empty table.

    What takes part in the join goes to the shared folder: a quarter of the tokens of all sets, and the
    whole sets of those that have candidates.
    """
    rest = [c for c in docs.columns if c not in (text, "n_shingles", "component_id")]
    rows = docs.select(F.struct(*rest).alias("row"), token_set(F.col(text), width, similarity).alias("set"))
    rows = rows.select("row", F.col(f"row.`{id}`").alias("id"), "set.key", F.col("set.n").alias("n"), "set.head")
    rows, all_heads = kept_at(rows, "token-sets")
    sets = rows.filter("n > 0").groupBy("key").agg(
        F.first("n").alias("n"), F.first("head").alias("head"), F.min("id").alias("id"),
        F.min(F.xxhash64("id")).alias("one"),
    )
    sets, heads = kept_at(sets.withColumn("s", F.monotonically_increasing_id()), "sets")
    rows = kept(rows.drop("head"), "rows")
    remove(docs.sparkSession, all_heads)
    free_shuffles(docs.sparkSession)
    index = indexed(sets, similarity)
    sets = kept(sets.drop("head"), "set-names")
    remove(docs.sparkSession, heads)  # the entries are written
    free_shuffles(docs.sparkSession)
    linked = linked_sets(sets, index, docs, width, similarity, text, id)
    named = kept(sets.select("key", "id", "s").join(linked, "s", "left").withColumn("m", F.coalesce("m", "s")), "set-labels")
    first = named.groupBy("m").agg(F.min("id").alias("component_id"))
    table = kept(named.join(first, "m").select("key", "component_id"), "set-components")
    joined = rows.join(table, "key", "left")
    return joined.select(
        "row.*",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )
