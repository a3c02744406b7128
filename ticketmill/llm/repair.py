"""Repair of conversations at the least cost, by a Viterbi search in chunks that run side by side.

A repaired conversation has the role initials (s?(ua)+)?. What is repaired so far is one of four states:
nothing, after s, after u, after a. Costs are computed backward, from the last row to the first: for each row, the
least cost of all that follows, from each state. A conversation is cut into chunks. Each one starts at once,
from a made-up vector of costs at its end; then it gets the vector that the next chunk has found at its own
begin, and if that is another one (not only by a constant), reruns until its vectors differ from those it had
before by a constant only: from there on all of its own are as they were. Passes go on until no vector changes.
Costs of a chunk are then right up to a constant, which is all that tracing needs: forward, at each row, the
edit with the least initial that is on a cheapest way. Chunks are traced from all four states, and the states
are then strung together, chunk by chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketmill.llm.storage import kept

#: Rows of a conversation that are searched as one chunk at most, a power of two.
CHUNK_BITS = 16

RENAME, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
STATES = 4
#: The state after each initial, for each state (nothing, after s, after u, after a) that it may follow.
AFTER = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ROLES = {"u": "user", "a": "assistant"}
#: Least cost from each state to the end, once all rows are done: nothing and after a are ends.
END = (0, 2 * INSERT, INSERT, 0)
FAULTS = ("", "blank", "duplicate", "truncated")
INITIALS = "sua"
Vector = tuple[int, ...]

#: What counts as no text.
SPACES = " \t\n\x0b\x0c\r"


def code(initial: Column, fault: Column) -> Column:
    """One letter from A to P: what the search has to know of a row."""
    place = F.position(initial, F.lit(INITIALS)) - 1
    known = F.when((F.length(initial) == 1) & (place >= 0), place).otherwise(len(INITIALS))
    return F.char(F.lit(65) + known * len(FAULTS) + fault)


def meaning(letter: str) -> tuple[str, str]:
    """(initial, or x for any other; fault)."""
    initial, fault = divmod(ord(letter) - 65, len(FAULTS))
    return (INITIALS + "x")[initial], FAULTS[fault]


def moves(letter: str, state: int) -> list[tuple[str, str, int, int]]:
    """(edit, initial of the role, next state, cost) of all that may become of a row, by edit."""
    initial, fault = meaning(letter)
    found = [("D", "-", state, DELETE)]
    if fault not in ("blank", "duplicate"):
        more = TRUNCATED if fault == "truncated" else 0
        if initial in AFTER[state]:
            found.append(("K", initial, AFTER[state][initial], more))
        found += [("R", r, AFTER[state][r], RENAME + more) for r in ROLES if r in AFTER[state]]
    return found


def inserts(state: int) -> list[tuple[str, int]]:
    return [(r, AFTER[state][r]) for r in ROLES if r in AFTER[state]]


@cache
def step(letter: str, after: Vector) -> tuple[int, Vector]:
    """Costs before a row from those after it, as their least one and what the others are above it."""
    cost = [min(c + after[to] for _, _, to, c in moves(letter, s)) for s in range(STATES)]
    for _ in range(2):  # two inserted rows at most: three would come back to where one leads
        cost = [min([cost[s], *(INSERT + cost[to] for _, to in inserts(s))]) for s in range(STATES)]
    least = min(cost)
    return least, tuple(c - least for c in cost)


@cache
def cheapest(letter: str, after: Vector, state: int) -> tuple[str, str, int, int]:
    """(edits, initials of their roles, next state, cost) at a row: the least edits of the cheapest ones."""
    least, before = step(letter, after)
    edits, roles, spent = "", "", 0
    while True:
        left = {e: (r, to, c) for e, r, to, c in moves(letter, state) if c + after[to] == least + before[state]}
        entered = [(r, to) for r, to in inserts(state) if INSERT + before[to] == before[state]]
        if "D" in left or not entered:
            edit = min(left)
            role, to, cost = left[edit]
            return edits + edit, roles + role, to, spent + cost
        edits, roles, spent = edits + "I", roles + entered[0][0], spent + INSERT
        state = entered[0][1]


def backward(letters: str, end: Vector) -> list[Vector]:
    """The vector after each row, and before the first one as the last of the list."""
    found = [end]
    for letter in reversed(letters):
        found.append(step(letter, found[-1])[1])
    return found


def begin(letters: str, end: Vector) -> Vector:
    for letter in reversed(letters):
        end = step(letter, end)[1]
    return end


def fixed_up(letters: str, old: Vector, old_begin: Vector, new: Vector) -> Vector:
    """The vector before the first row, from another one at the end. As soon as it is the old one but for a
    constant, it stays so."""
    for letter in reversed(letters):
        if old == new:
            return old_begin
        old, new = step(letter, old)[1], step(letter, new)[1]
    return new


def trace(letters: str, end: Vector, state: int) -> tuple[list[tuple[str, str]], int, int]:
    """(edits and roles of each row, the state in the end, the cost)."""
    found, cost = [], 0
    vectors = backward(letters, end)
    for k, letter in enumerate(letters):
        edits, roles, state, spent = cheapest(letter, vectors[len(letters) - 1 - k], state)
        found.append((edits, roles))
        cost += spent
    return found, state, cost


def closing(state: int) -> tuple[str, str]:
    """What is inserted after the last row."""
    return {0: ("", ""), 1: ("II", "ua"), 2: ("I", "a"), 3: ("", "")}[state]


def ordered(turns: DataFrame, conv: str, turn: str, role: str, text: str, copy: str | None) -> DataFrame:
    """(conv, turn, role, text, pos): rows numbered in order of their conversation and turn, nulls first. Rows of one
    turn come by role, then by a hash of the text, a repeated row right after the one it repeats. Sorted by
    ranges, so that many tasks may share a conversation, and even rows that are all alike."""
    rows = turns.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
        (F.lit(0) if copy is None else F.col(copy)).alias("copy"),
    ).withColumn("row", F.monotonically_increasing_id())
    keys = ["conv", F.asc_nulls_first("turn"), "role", F.xxhash64("text"), "row"]
    if copy is not None:  # copies of one row stand side by side before the sort
        keys[-1] = F.col("row") - F.col("copy")
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys, "copy")
    return kept(rows.drop("row", "copy").withColumn("pos", F.monotonically_increasing_id()), "turns")


def with_faults(rows: DataFrame) -> DataFrame:
    """rows with fault, the place in FAULTS of the first fault of each, and its letter for the search."""
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    blank = bare == ""
    named = rows.withColumn("mark", F.sha2("text", 256))
    keys = [F.col("conv").alias("c"), F.col("role").alias("r"), F.col("mark").alias("m")]
    first = named.groupBy(*keys).agg(F.min("pos").alias("first"))
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("mark") == F.col("m"))
    fault = (
        F.when(blank, 1)
        .when(F.col("pos") > F.col("first"), 2)
        .when(~F.substring(bare, -1, 1).rlike(r"[.!?]"), 3)
        .otherwise(0)
    )
    joined = named.join(first, same, "left").withColumn("fault", fault).select(*rows.columns, "fault")
    return joined.withColumn("letter", code(F.substring("role", 1, 1), F.col("fault")))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(at, end, begin) of chunks: started from end, or fixed up where they have an old one."""
    for batch in batches:
        rows = batch.to_pylist()
        out = []
        for r in rows:
            end = tuple(r["end"])
            if r["old_end"] is None:
                out.append(begin(r["letters"], end))
            else:
                out.append(fixed_up(r["letters"], tuple(r["old_end"]), tuple(r["old_begin"]), end))
        ints = pa.list_(pa.int32())
        yield pa.record_batch(
            [batch["at"], pa.array([r["end"] for r in rows], ints), pa.array([list(x) for x in out], ints)],
            ["at", "end", "begin"],
        )


def converged(chunks: DataFrame) -> DataFrame:
    """(conv, at, end, begin): the vectors at the end and the begin of each chunk, their least cost taken as 0."""

    def run(rows: DataFrame) -> DataFrame:
        rows = rows.join(chunks.select("at", "letters"), "at").select("at", "letters", "end", "old_end", "old_begin")
        return rows.mapInArrow(_vectors, "at bigint, end array<int>, begin array<int>")

    by_conv = Window.partitionBy("conv").orderBy("at")
    none, end = F.lit(None).cast("array<int>"), F.array(*map(F.lit, END))
    last = F.lead("at").over(by_conv).isNull()
    guess = F.when(last, end).otherwise(F.array(*[F.lit(0)] * STATES))
    places = kept(chunks.select("conv", "at", guess.alias("end")), "chunk-places")
    started = run(places.withColumns({"old_end": none, "old_begin": none}))
    state = kept(started.join(places.select("conv", "at"), "at"), "chunk-vectors")
    while True:
        following = F.coalesce(F.lead("begin").over(by_conv), end)
        known = state.select("conv", "at", "end", "begin", following.alias("real"))
        wrong = kept(known.filter("end <> real"), "chunk-changes")
        if wrong.isEmpty():
            return state
        again = run(wrong.select("at", F.col("real").alias("end"), F.col("end").alias("old_end"),
                                 F.col("begin").alias("old_begin")))
        again = again.join(wrong.select("conv", "at"), "at")
        right = state.join(wrong.select("at"), "at", "left_anti")
        state = kept(right.unionByName(again), "chunk-vectors")


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each chunk, the state that each state leads to."""
    for batch in batches:
        rows = [(x["letters"], tuple(x["end"])) for x in batch.to_pylist()]
        exits = [[trace(letters, end, s)[1] for s in range(STATES)] for letters, end in rows]
        yield pa.record_batch([batch["at"], pa.array(exits, pa.list_(pa.int32()))], ["at", "exits"])


def _entered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state in which each chunk is entered; rows in order, those of a conversation in one task."""
    state = 0
    for batch in batches:
        found = []
        for first, exits in zip(batch["first"].to_pylist(), batch["exits"].to_pylist()):
            state = 0 if first else state
            found.append(state)
            state = exits[state]
        yield pa.record_batch([batch["at"], pa.array(found, pa.int32())], ["at", "state"])


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pos, edits, roles) of every row of each chunk; the last row has what is inserted after it too."""
    for batch in batches:
        for r in batch.to_pylist():
            found, state, _ = trace(r["letters"], tuple(r["end"]), r["state"])
            if r["last"]:
                more = closing(state)
                found[-1] = (found[-1][0] + more[0], found[-1][1] + more[1])
            edits, roles = zip(*found)
            yield pa.record_batch([pa.array(r["places"], pa.int64()), pa.array(edits), pa.array(roles)], ["pos", "edits", "roles"])


def repaired(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    copy: str | None = None,
) -> DataFrame:
    """The edits that repair each conversation, as rows in order of conv, pos, k: (conv, pos, k, turn, edit, role, text,
    fault, cost, letter). edit is K (kept), R (another role), D (deleted) or I (inserted, with an empty text); role
    and text are those after the edit, of deleted rows as they were. fault is '' or the first of blank, duplicate and
    truncated, null for inserted rows. Of the cheapest repairs, the one whose edits are least in ASCII is taken.

    A null role or text is one blank. A null conv is a conversation like others, null turns come first, rows of
    one turn by role and then a hash of the text. Repeated rows are duplicates. Other columns are left out. copy
    numbers the copies of a row, which stand side by side in turns. An empty table gives an empty table.
    """
    rows = kept(with_faults(ordered(turns, conv, turn, role, text, copy)), "faulty-turns")
    held = F.array_sort(F.collect_list(F.struct("pos", "letter")))
    chunks = rows.groupBy("conv", F.shiftright("pos", CHUNK_BITS).alias("chunk")).agg(held.alias("rows"))
    chunks = kept(
        chunks.select(
            "conv",
            F.col("rows")[0]["pos"].alias("at"),
            F.array_join("rows.letter", "").alias("letters"),
            F.col("rows.pos").alias("places"),
        ),
        "chunks",
    )
    vectors = converged(chunks)
    exits = vectors.join(chunks.select("at", "letters"), "at").select("at", "letters", "end")
    exits = exits.mapInArrow(_exits, "at bigint, exits array<int>")
    by_conv = Window.partitionBy("conv").orderBy("at")
    strung = (
        vectors.join(exits, "at")
        .withColumn("first", F.lag("at").over(by_conv).isNull())
        .repartition("conv")
        .sortWithinPartitions("conv", "at")
        .select("at", "first", "exits")
        .mapInArrow(_entered, "at bigint, state int")
    )
    last = vectors.select("at", "end", F.lead("at").over(by_conv).isNull().alias("last"))
    ready = last.join(strung, "at").join(chunks.select("at", "letters", "places"), "at")
    edits = ready.select("letters", "places", "end", "state", "last").mapInArrow(
        _edits, "pos bigint, edits string, roles string"
    )
    each = F.transform(
        F.sequence(F.lit(1), F.length("edits")),
        lambda i: F.struct(F.substr("edits", i, F.lit(1)).alias("edit"), F.substr("roles", i, F.lit(1)).alias("to")),
    )
    split = rows.join(edits, "pos").select(
        "conv", "pos", "turn", "role", "text", "fault", "letter", F.posexplode(each).alias("k", "e")
    )
    edit, given = F.col("e.edit"), F.col("e.to")
    inserted = edit == "I"
    named = F.when(given == "u", ROLES["u"]).when(given == "a", ROLES["a"])
    more = F.when(~inserted & (edit != "D") & (F.col("fault") == 3), TRUNCATED).otherwise(0)
    price = F.when(edit == "D", DELETE).when(inserted, INSERT).when(edit == "R", RENAME).otherwise(0) + more
    names = F.get(F.array(*map(F.lit, FAULTS)), F.col("fault"))
    return split.select(
        "conv",
        "pos",
        "k",
        F.when(~inserted, F.col("turn")).alias("turn"),
        edit.alias("edit"),
        F.when(edit.isin("I", "R"), named).otherwise(F.col("role")).alias("role"),
        F.when(inserted, "").otherwise(F.col("text")).alias("text"),
        F.when(~inserted, names).alias("fault"),
        price.cast("long").alias("cost"),
        F.when(~inserted, F.col("letter")).alias("letter"),
    )


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation: its edits in a row, illegal neighbours, and a hash of what it says."""
    legal = {"su", "ua", "au"}
    audit: list[str] = []
    hashed, said, illegal, before = sha256(), False, 0, ""
    lead = None

    def closed() -> pa.RecordBatch:
        values = [[lead], ["".join(audit)], [hashed.hexdigest()], [illegal]]
        return pa.record_batch([pa.array(v) for v in values[:-1]] + [pa.array(values[-1], pa.int64())],
                               ["lead", "audit", "repaired_sha256", "illegal"])

    for batch in batches:
        columns = (batch[c].to_pylist() for c in ("lead", "pos", "k", "edit", "role", "text", "letter"))
        for own, _, _, edit, role, text, letter in zip(*columns):
            if own != lead:
                if lead is not None:
                    yield closed()
                audit, hashed, said, illegal, before, lead = [], sha256(), False, 0, "", own
            audit.append(edit)
            if letter is not None:
                initial = meaning(letter)[0]
                illegal += bool(before) and before + initial not in legal
                before = initial
            if edit != "D":
                hashed.update((("\n" if said else "") + f"{role}:{text}").encode())
                said = True
    if lead is not None:
        yield closed()


def summary(edits: DataFrame) -> DataFrame:
    """Of each conversation (conv): gaps in its turns, rows of each fault, neighbours whose role initials are not
    su, ua or au, the cost, the edits as one text, and the SHA-256 of the repaired role:text lines. The digest
    and the text of a conversation are made in one task, which holds a batch of its rows and one letter a row."""
    first = edits.groupBy(F.col("conv").alias("c")).agg(F.min("pos").alias("lead"))
    rows = edits.join(first, F.col("conv").eqNullSafe(F.col("c")))
    rows = rows.select("lead", "pos", "k", "edit", "role", "text", "letter")
    rows = rows.repartition("lead").sortWithinPartitions("lead", "pos", "k")
    digests = rows.mapInArrow(_digest, "lead bigint, audit string, repaired_sha256 string, illegal bigint")
    per_turn = edits.groupBy("conv", "turn").agg(
        *(F.count_if(F.col("fault") == f).alias(f) for f in FAULTS[1:]),
        F.sum("cost").alias("cost"),
        F.min("pos").alias("lead"),
    )
    counted = per_turn.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
        *(F.sum(f).alias(f) for f in FAULTS[1:]),
        F.sum("cost").alias("cost"),
        F.min("lead").alias("lead"),
    )
    return counted.join(digests, "lead").drop("lead")


def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copy): turns spoilt in five ways, by a checksum of conversation and turn. Null
    texts, roles and, for the checksum, ids are one blank."""
    blank = F.lit(" ")
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank)
    )
    way, text = F.crc32(key) % 20, F.coalesce("text", blank)
    return (
        turns.withColumn("_way", way)
        .filter("_way <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("_way") == 4, "user").otherwise(F.coalesce("role", blank)).alias("role"),
            F.when(F.col("_way") == 1, "")
            .when(F.col("_way") == 2, F.regexp_replace(text, "[.!?]", ""))
            .otherwise(text)
            .alias("text"),
            F.explode(F.when(F.col("_way") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        )
    )
