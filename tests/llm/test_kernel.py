import numpy as np
import pyarrow as pa
from conftest import *  # noqa: F403
from hypothesis import given, settings
from hypothesis import strategies as st

from loomdoc.llm import textkernel as K

TEXT = st.text(alphabet="aAbB zZ\t\n\x0b\x1fé€𝄞.,-0", max_size=40)


@given(st.lists(st.one_of(TEXT, st.none()), max_size=8))
@settings(max_examples=150, deadline=None)
def test_words_as_by_regular_expression(texts):
    seen = []
    for a, b, data, offs in K.text_chunks(pa.array(texts, pa.string())):
        w = K.Words(data, offs, K.SPACE)
        for d in range(b - a):
            own = [w.text(i, i + 1).decode() for i in range(w.bounds[d], w.bounds[d + 1])]
            assert own == words(texts[a + d])  # noqa: F405
            seen += list(zip(own, w.hash[w.bounds[d] : w.bounds[d + 1]].tolist(), strict=True))
        for k in (1, 2, 3):
            h, bounds = K.shingle_hashes(w, k)
            for d in range(b - a):
                assert len(set(h[bounds[d] : bounds[d + 1]].tolist())) == len(shingles(texts[a + d], k))  # noqa: F405
    assert len({x for x, _ in seen}) == len({h for _, h in seen}) == len(set(seen))


def test_hash_does_not_depend_on_place():
    long = "y" * 10_000
    a, b = (K.Words(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]), K.SPACE) for t in (f"p q {long}", f"{long} q p"))
    assert a.hash[2] == b.hash[0] and a.hash[0] == b.hash[2] and len(set(a.hash.tolist())) == 3


def test_slices_and_chunks():
    texts = pa.array([None, "a b", "c" * (K.CHUNK_BYTES + 1), "", "d e f"])[1:]
    counts = [n for a, b, d, o in K.text_chunks(texts) for n in K.Words(d, o, K.SPACE).counts.tolist()]
    assert counts == [2, 1, 0, 3]
