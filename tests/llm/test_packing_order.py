"""Emission order, cuts and padding of the packing; ids by chunk at ASCII marks and white space."""

import random
import time

import numpy as np
from hypothesis import given, settings, strategies as st

from stratagrid.llm import packing, tokens


def ids(n):
    return np.arange(n, dtype="<u4").tobytes()


def run(lengths, capacity, most, gap):
    windows = packing.OpenWindows(capacity, most)
    closed = list(packing.place(((i, 0, ids(n), n) for i, n in enumerate(lengths)), windows, gap))
    return closed, windows


def test_the_fullest_goes_out_when_none_fits():
    closed, windows = run([60, 90, 70, 50], 100, 3, 10)
    # 50 fits none of 60, 90, 70: the window with 90 lacks no more than 10 and goes out as it is
    assert [[p[0] for p in w] for w in closed] == [[1]]
    assert sorted(room for room, _ in windows.rooms) == [30, 40, 50]
    # with a lesser gap the document is cut to fill it
    closed, windows = run([60, 90, 70, 45], 100, 3, 5)
    assert [[(p[0], p[1], p[2]) for p in w] for w in closed] == [[(1, 0, 90), (3, 0, 10)]]
    assert [(p[0], p[1], p[2], p[5]) for w in windows.pieces.values() for p in w if p[0] == 3] == [(3, 10, 35, 60)]


def test_few_documents_are_cut_and_little_is_padded():
    rng = random.Random(1)
    lengths = [min(4000, int(rng.lognormvariate(5.5, 1))) + 1 for _ in range(20_000)]
    closed, windows = run(lengths, packing.CAPACITY, packing.OPEN_WINDOWS, packing.CUT_GAP)
    pieces = [p for w in closed for p in w] + [p for w in windows.pieces.values() for p in w]
    assert sum(p[2] for p in pieces) == sum(lengths)
    long = sum(-(-n // packing.CAPACITY) - 1 for n in lengths)
    assert len(pieces) <= len(lengths) + long + len(closed)  # at most one cut for each window that goes out
    padding = sum(packing.CAPACITY - sum(p[2] for p in w) for w in closed)
    assert padding <= packing.CUT_GAP * len(closed)


def test_ten_million_ids_in_seconds():
    start = time.process_time()
    closed, windows = run([10_000_000], packing.CAPACITY, 64, 32)
    assert sum(p[2] for w in closed for p in w) + sum(p[2] for w in windows.pieces.values() for p in w) == 10_000_000
    assert time.process_time() - start < 5


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab'st12.,-  \n\t\r\x0b\x1c\x00é日")), max_size=60))
def test_ids_equal_the_library(text):
    own = tokens.encoder(tokens.vocabulary_path(None), 64)
    assert np.frombuffer(own.encode(text), "<u4").tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids


def test_long_chunks_are_not_kept():
    own = tokens.encoder(tokens.vocabulary_path(None), 32)
    own.encode(" ".join("x" * n for n in range(1, 200)))
    kept = [*own._spaced, *own._plain, *own._marks]
    assert kept and max(map(len, kept)) <= tokens.LONGEST + 1
