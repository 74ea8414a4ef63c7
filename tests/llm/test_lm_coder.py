import numpy as np
import pyarrow as pa
import pytest

from loomdoc.llm import attention, lm
from loomdoc.llm.textkernel import SPACE, Words, text_chunks

TEXTS = ["The cat sat on the mat", None, "", " \t\n ", "línea één ß 東京 🙂 é a b \x00 \x1f <|endoftext|>", "x" * 3000 + " y", "cat  cat\ncat mat", "� ﻿ ' 's don't 12345"]


@pytest.fixture(scope="module")
def coder():
    return lm.Coder(lm.ranks())


def coded(coder, texts):
    ((_, _, data, offs),) = text_chunks(pa.array(texts, pa.string()))
    w = Words(data, offs, SPACE)
    return coder.tokens(w, *lm._uniques(w))


def test_words_of_a_chunk_are_coded_in_one_call(coder, monkeypatch):
    """As word by word, each with the space before it, with an end after each text."""
    import re

    fold = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    want = [[*(i for x in re.findall(r"[^\x20\x09-\x0D]+", fold(t)) for i in coder.own.encode_ordinary(" " + x)), coder.end] for t in TEXTS]
    calls, encode = [], type(coder.own).encode_ordinary
    monkeypatch.setattr(type(coder.own), "encode_ordinary", lambda self, text: calls.append(1) or encode(self, text))
    ids, bounds = coded(coder, TEXTS)
    assert len(calls) == 1
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == want
    ids, bounds = coded(coder, [None, "", "  "])
    assert ids.tolist() == [coder.end] * 3 and bounds.tolist() == [0, 1, 2, 3]


def test_sums_by_unit_do_not_lose_small_rows_behind_large_ones():
    r = np.random.default_rng(3)
    units = r.integers(0, 9, (50, 8))
    units[units == 4] = 5  # a unit without rows
    rows = r.standard_normal((50, 8, 6)).astype(np.float32)
    rows[units == 0] *= 1e7
    want = np.zeros((10, 6))
    np.add.at(want, units.ravel(), rows.reshape(-1, 6).astype(np.float64))
    got = attention._summed(units, rows, 10)
    assert got.dtype == np.float32 and not got[[4, 9]].any()
    assert np.allclose(got, want, rtol=1e-4, atol=1e-4)
