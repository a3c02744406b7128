r"""Chat formatting on token level.

A turn reads [INST]role[/INST]text</s>. The three marks are ids of their own beyond the vocabulary;
role and text are encoded apart from them, so no text can become a mark. In a text, a control string
gets a backslash after its first character, and one more where it had some (`</s>` as `<\/s>`, `<\/s>`
as `<\\/s>`), which can be undone, so that the text of the tokens can be parsed as well.

A conversation is its turns' rows in order. There is a row for each turn and none that holds a whole
conversation, as a conversation may have any number of turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.arrays import expanded, slices
from ticketmill.llm.packing import rank_encoding

OPEN, HEAD, CLOSE = "[INST]", "[/INST]", "</s>"
#: Ids of the marks, after the vocabulary and its own reserved id.
MARKS = {50257: OPEN, 50258: HEAD, 50259: CLOSE}
OPEN_ID, HEAD_ID, CLOSE_ID = MARKS

#: A control string with any number of backslashes in it; <s> is kept free for a begin mark.
CONTROL = r"(<\\*)(/?s>)|(\[\\*)(/?INST\])"
ESCAPED = r"(<\\*)\\(/?s>)|(\[\\*)\\(/?INST\])"


def escape(text: str) -> str:
    return re.sub(CONTROL, lambda m: f"{m[1] or m[3]}\\{m[2] or m[4]}", text)


def unescape(text: str) -> str:
    return re.sub(ESCAPED, lambda m: (m[1] or m[3]) + (m[2] or m[4]), text)


def assembled(roles: list[str], texts: list[str], trained: np.ndarray, ranks: str) -> pa.Array:
    """struct<ids, loss> of each turn; loss is true for the ids of the text of trained turns."""
    encoder = rank_encoding(ranks)
    n = len(roles)
    segments: list[list[int]] = []
    for role, text in zip(roles, texts):
        segments += [encoder.encode_ordinary(escape(role)), encoder.encode_ordinary(escape(text))]
    size = np.array([len(s) for s in segments], np.int64).reshape(n, 2)
    total = size.sum(axis=1) + 3
    edges = np.concatenate([[0], np.cumsum(total)])
    ids = np.zeros(int(edges[-1]), np.int32)
    begin, end = edges[:-1], edges[1:]
    ids[begin], ids[begin + 1 + size[:, 0]], ids[end - 1] = OPEN_ID, HEAD_ID, CLOSE_ID
    starts = np.stack([begin + 1, begin + 2 + size[:, 0]], axis=1)
    flat = [i for s in segments for i in s]
    ids[expanded(starts.ravel(), size.ravel())] = flat
    change = np.zeros(len(ids) + 1, np.int32)
    change[starts[trained, 1]] += 1
    change[(end - 1)[trained]] -= 1
    loss = np.cumsum(change[:-1]) > 0
    offsets = pa.array(edges.astype(np.int32))
    return pa.StructArray.from_arrays(
        [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (ids, loss)], ["ids", "loss"]
    )


def format_turns(
    turns: DataFrame,
    ranks: str,
    role: str = "role",
    text: str = "text",
    trained_role: str = "assistant",
) -> DataFrame:
    """turns with ids (array<int>) and loss (array<boolean>); columns of these names are replaced.

    Null roles and texts are formatted as empty ones. Rows are independent: nothing is sorted or
    dropped, repeated turns stay, further columns stay, an empty table stays empty.
    """

    @F.arrow_udf("struct<ids: array<int>, loss: array<boolean>>")
    def assemble(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for roles, texts in columns:
            parts, at = [], 0
            for part in slices(texts) if len(texts) else [texts]:
                own = pc.fill_null(roles.slice(at, len(part)), "")
                at += len(part)
                trained = np.array([r == trained_role for r in own.to_pylist()], bool)
                filled = pc.fill_null(part, "").to_pylist()
                parts.append(assembled(own.to_pylist(), filled, trained, ranks))
            yield pa.concat_arrays(parts)

    made = assemble(F.col(role).cast("string"), F.col(text).cast("string"))
    rows = turns.withColumn("_made", made)
    return rows.withColumns({"ids": F.col("_made.ids"), "loss": F.col("_made.loss")}).drop("_made")


DIGEST = ["conversation", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
READ = "struct<role: string, text: string, loss_text: string, formatted_chars: bigint>"


def read_turns(formatted: DataFrame, ranks: str) -> DataFrame:
    """formatted with read: role, text and loss_text as they were before escaping, and the length of
    the turn as formatted text. Reads the columns ids and loss alone."""

    @F.arrow_udf(READ)
    def read(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        decoder = rank_encoding(ranks)
        for ids, loss in columns:
            rows = []
            for turn, mask in zip(ids, loss):
                turn, mask = turn.values.to_numpy(), mask.values.to_numpy(zero_copy_only=False)
                head = int(np.flatnonzero(turn == HEAD_ID)[0])
                if turn[0] != OPEN_ID or turn[-1] != CLOSE_ID or (turn >= OPEN_ID).sum() != 3:
                    raise ValueError("not a formatted turn")
                role = decoder.decode(turn[1:head].tolist())
                text = decoder.decode(turn[head + 1 : -1].tolist())
                rows.append(
                    {
                        "role": unescape(role),
                        "text": unescape(text),
                        "loss_text": unescape(decoder.decode(turn[mask].tolist())),
                        "formatted_chars": sum(map(len, (OPEN, role, HEAD, text, CLOSE))),
                    }
                )
            yield pa.array(rows, pa.struct(
                [("role", pa.string()), ("text", pa.string()), ("loss_text", pa.string()),
                 ("formatted_chars", pa.int64())]))

    return formatted.withColumn("read", read("ids", "loss"))


def digests(formatted: DataFrame, ranks: str, conversation: str = "conv_id", turn: str = "turn") -> DataFrame:
    """(conversation, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back from
    the tokens: one row for each conversation; rows with a null conversation are one as well.

    Turns of equal number, null first, go by role and text. The digests run over the sorted turns, of
    which a task holds one at a time: of a conversation of any length, only the hash state is kept.
    """
    rows = read_turns(formatted, ranks).select(
        F.col(conversation).alias("conversation"), F.col(turn).alias("turn"), "read.*"
    )
    kind = rows.schema["conversation"].dataType.simpleString()
    rows = rows.repartition("conversation").sortWithinPartitions("conversation", "turn", "role", "text")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        now, state, key_type = None, None, pa.null()

        def close() -> None:
            if state is not None:
                n, turns, chars, loss, formatted_chars = state
                done.append((now, n, turns.hexdigest(), chars, loss.hexdigest(), formatted_chars))

        def flushed() -> Iterator[pa.RecordBatch]:
            if done:
                kinds = [key_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*done), kinds)], DIGEST)
                done.clear()

        for batch in batches:
            key_type = batch.schema.field("conversation").type
            columns = [batch.column(c).to_pylist() for c in
                       ("conversation", "role", "text", "loss_text", "formatted_chars")]
            for key, role, text, trained, chars in zip(*columns):
                if state is None or key != now:
                    close()
                    now, state = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(trained)
                state[3].update(trained.encode())
                state[4] += chars
            yield from flushed()
        close()
        yield from flushed()

    schema = (f"conversation {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
              "loss_sha256 string, formatted_chars bigint")
    return rows.mapInArrow(hashed, schema).withColumnRenamed("conversation", conversation)

