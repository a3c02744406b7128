import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import plain
from ticketmill.llm import arrays, simhash, toxicity


@settings(deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n", max_size=12)), max_size=8))
def test_runs_and_hashes_follow_the_words_of_each_text(texts):
    data, offsets = arrays.text_bytes(pa.array(texts, pa.string()))
    starts, ends = arrays.runs(data, offsets, ~arrays.SPACE)
    raw = data.tobytes()
    found = [raw[s:e].decode() for s, e in zip(starts, ends)]
    assert found == [w for t in texts for w in plain.words(t)]
    owner = arrays.owners(offsets[:-1], starts)
    assert [int((owner == k).sum()) for k in range(len(texts))] == [len(plain.words(t)) for t in texts]
    hashes = arrays.range_hashes(data, starts, ends).tolist()
    assert len(set(zip(found, hashes))) == len(set(found)) == len(set(hashes))


def test_slices_keep_order_and_never_split_a_row():
    column = pa.array(["a" * 10, None, "b" * 3, "c" * 50, "", "d"])
    for limit in (1, 5, 13, 1000):
        parts = list(arrays.slices(column, limit))
        assert pa.concat_arrays(parts).equals(column)
    assert list(arrays.slices(pa.array([], pa.string()))) == []


def test_hashes_of_ranges_longer_than_a_block():
    data = np.frombuffer(b"xy" * arrays.BLOCK_BYTES, np.uint8)
    starts, ends = np.array([0, 0]), np.array([len(data), 0])
    long, empty = arrays.range_hashes(data, starts, ends)
    assert long == arrays.range_hashes(data.copy(), starts[:1], ends[:1])[0] != empty


def test_strings_of_one_pattern_and_its_complement_have_other_hashes():
    word = np.array([97 + (i.bit_count() & 1) for i in range(4096)], np.uint8)
    both = np.concatenate([word, 195 - word])
    for n in (1024, 2048, 4096):
        starts = np.array([0, 4096])
        one, other = arrays.range_hashes(both, starts, starts + n)
        assert one != other


@pytest.mark.parametrize("work", ["fingerprints", "probabilities"])
def test_intermediates_of_texts_stay_small(work):
    column = pa.array([f"word{k} and others here " * 250 for k in range(1_000)])  # 5.6 MB
    chain = toxicity.Chain(np.arange(512, dtype=np.uint64), [np.zeros(513 + k) for k in range(3)])
    tracemalloc.start()
    try:
        for part in arrays.slices(column):
            if work == "fingerprints":
                simhash.fingerprints(part, 4)
            else:
                chain.probabilities(chain.present(part))
            assert tracemalloc.get_traced_memory()[1] < 48 << 20
    finally:
        tracemalloc.stop()
