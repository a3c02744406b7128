"""Conversation repair against a search over all edits."""

import hashlib
import random
from collections import defaultdict

import pytest

from tests.conftest import SF
from tests.llm import plain
from ticketmill.llm import queries, repair

COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def digested(rows):
    *counts, said = plain.repair(rows)
    return (*counts, hashlib.sha256(said.encode()).hexdigest())


def by_conversation(rows):
    out = defaultdict(list)
    for r in rows:
        out[r[0]].append(r)
    return out


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    left = by_conversation(plain.damaged(rows))
    found = queries.QUERIES["op12_conversation_repair"](spark, SF).collect()
    assert {r["conv_id"] for r in found} == {r[0] for r in rows} and len(found) == len({r[0] for r in rows})
    for r in found:
        assert tuple(r[c] for c in COLUMNS) == digested(left[r["conv_id"]]), r["conv_id"]


def made_up(seed, n, length):
    rng, rows = random.Random(seed), []
    for conv in range(n):
        for turn in range(rng.randint(1, length)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            text = rng.choice(["Yes.", "No!", "Why?", "so it goes", "and then ", " \t", "", None, f"turn {turn}.", "é?\n"])
            rows.append((None if conv == 3 else conv, None if conv % 7 == 5 else turn * rng.randint(1, 2), role, text))
    return rows


@pytest.mark.parametrize("bits", [16, 1])
def test_repair_of_odd_conversations_in_chunks(spark, monkeypatch, bits):
    """Chunks of two rows need passes; rows of one turn are told apart by the order that the operator gives."""
    monkeypatch.setattr(repair, "CHUNK_BITS", bits)
    rows = made_up(5, 40, 25)
    turns = spark.createDataFrame([(*r, "x", 1) for r in rows], "c bigint, turn bigint, role string, text string, edit string, k int")
    edits = repair.repaired(turns, conv="c")
    lines = edits.orderBy("pos", "k").collect()
    own = by_conversation([(r["conv"], r["turn"], r["role"], r["text"], r) for r in lines])
    digests = {r["conv"]: tuple(r[c] for c in COLUMNS) for r in repair.summary(edits).collect()}
    assert digests.keys() == own.keys() == {r[0] for r in rows}
    source = repair.ordered(turns, "c", "turn", "role", "text", None).orderBy("pos").collect()
    for conv, given in by_conversation([(r["conv"], r["turn"], r["role"], r["text"]) for r in source]).items():
        assert [r[1] for r in given] == sorted((r[1] for r in given), key=lambda t: (t is not None, t or 0))
        assert digests[conv] == digested(given), conv
        said = [f"{r[2]}:{r[3]}" for r in own[conv] if r[4]["edit"] != "D"]
        assert "\n".join(said) == plain.repair(given)[-1]
        assert sum(r[4]["cost"] for r in own[conv]) == plain.repair(given)[5]


def test_empty_table_and_a_conversation_of_one_row(spark):
    turns = spark.createDataFrame([(1, 0, "user", "Hi.")], "conv_id bigint, turn int, role string, text string")
    assert repair.repaired(turns.filter("false")).count() == 0
    assert repair.summary(repair.repaired(turns.filter("false"))).count() == 0
    assert [r["edit"] for r in repair.repaired(turns).orderBy("pos", "k").collect()] == ["K", "I"]


def test_vectors_of_chunks_converge():
    rng = random.Random(2)
    letters = "".join(rng.choice("ABCDEFGHIJKLMNOP") for _ in range(500))
    real = repair.begin(letters, repair.END)
    for start in ((0, 0, 0, 0), (5, 0, 1, 9)):
        old = repair.begin(letters, start)
        assert repair.fixed_up(letters, start, old, repair.END) == real
    steps = sum(a != b for a, b in zip(repair.backward(letters, (0, 0, 0, 0)), repair.backward(letters, repair.END)))
    assert steps < 50
