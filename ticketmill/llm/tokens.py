"""Token counts: whole texts counted in Arrow batches, only lengths come back.

A batch is cut into parts of about equal bytes. In a part, texts are split where no token can reach
across, so a long text is never encoded at once, and a word that many texts share is encoded once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.arrays import owners, range_hashes, slices, sums, text_bytes

BLANK = 32
#: What the model writes for a blank.
MARK = "▁".encode()


@cache
def piece_model(path: str):
    """The model, once for each worker, after a check that its pieces allow the split."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    mark = MARK.decode()
    inner = (p for p in map(model.id_to_piece, range(model.get_piece_size())) if mark in p[1:])
    if any(p.strip(mark) for p in inner) or model.encode(" a", out_type=str) != [mark, f"{mark}a"]:
        raise ValueError(f"{path}: pieces reach across blanks, texts can't be split there")
    return model


def piece_counts(column: pa.Array, model) -> np.ndarray:
    """The number of pieces of each text, as the model gives it for the whole text.

    No piece has a blank after another character, so a text can be cut before each run of blanks.
    The model puts one blank before what it encodes; of a later part, it stands for the first blank.
    """
    data, offsets = text_bytes(column)
    blank = np.zeros(len(data) + 1, bool)
    blank[:-1] = data == BLANK
    cut = blank.copy()
    cut[1:] &= ~blank[:-1]
    if len(data) > 3:  # the mark itself may stand in a text, where it is a blank as well
        marks = (data[:-2] == MARK[0]) & (data[1:-1] == MARK[1]) & (data[2:] == MARK[2])
        cut[np.flatnonzero(marks) + 3] = False
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    cut[first] = True
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], len(data))
    later = np.ones(len(starts), bool)
    later[np.searchsorted(starts, first)] = False
    starts = starts + later
    _, one, which = np.unique(
        range_hashes(data, starts, ends), return_index=True, return_inverse=True
    )
    raw = data.tobytes()
    parts = [raw[s:e].decode() for s, e in zip(starts[one].tolist(), ends[one].tolist())]
    counts = np.array([len(ids) for ids in model.encode(parts, num_threads=1)], np.int64)
    counts = np.maximum(counts, 1)  # of a last blank, nothing is left to encode
    return sums(counts[which], owners(offsets[:-1], starts - later), len(column))


def count_tokens(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """docs with n_bytes (UTF-8) and n_tokens, both long; columns of these names are replaced.

    Null and empty texts have 0 of both. Rows are independent: repeated rows, null ids and further
    columns stay as they are, and an empty table stays empty. model_path is read on the executors.
    """

    @F.arrow_udf("long")
    def tokens(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = piece_model(model_path)
        for column in columns:
            parts = [piece_counts(part, model) for part in slices(column)]
            yield pa.array(np.concatenate([np.zeros(0, np.int64), *parts]), pa.int64())

    n_bytes = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    return docs.withColumns({"n_bytes": n_bytes, "n_tokens": tokens(F.col(text))})
