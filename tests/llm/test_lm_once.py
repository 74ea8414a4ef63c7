import shutil
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from loomdoc.llm import attention, lm
from loomdoc.llm.textkernel import SPACE, Words, text_chunks

TEXTS = ["the cat sat on the mat", None, "", "línea één 東京 🙂 the", "x" * 900 + " cat", "cat  antidisestablishmentarianism\n東京", "unseenword 12345"]


class Shared:
    value = lm.ranks()


def batches(texts, held_out):
    n = len(texts)
    return [lm._rows(f"{lm._TEXT}, text string", pa.array(range(n)), pa.array(held_out), pa.array(range(n)), pa.array(range(n)), pa.array([0] * n, pa.int32()), pa.array(texts, pa.string()))]


def split(rows):
    """The ids by document, the rows of counts."""
    found = [r for b in rows for r in b.to_pylist()]
    return {r["doc_id"]: np.frombuffer(r["ids"], np.uint16).tolist() for r in found if r["kind"] == lm.DOCUMENT}, [r for r in found if r["kind"] != lm.DOCUMENT]


def test_texts_are_read_once(spark, tmp_path, monkeypatch):
    """Training and scoring need the ids only: once these are written, the texts may go."""
    rows = [(i, f"the quick brown fox {i} jumps over the lazy dog " * (1 + i % 4) if i % 9 else None) for i in range(60)]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path)
    want = {r["doc_id"]: tuple(r) for r in lm.score(spark.read.parquet(path)).collect()}
    calls, write = [], lm.written

    def once(df, name):
        out = write(df, name)
        if not calls:
            shutil.rmtree(path)
        calls.append(name)
        return out

    monkeypatch.setattr(lm, "written", once)
    got = {r["doc_id"]: tuple(r) for r in lm.score(spark.read.parquet(path)).collect()}
    assert len(got) == 60 and got.keys() == want.keys()
    assert all(got[i][:5] == want[i][:5] and np.allclose(got[i][5:], want[i][5:], rtol=1e-6) for i in want)


def test_ids_of_all_and_counts_of_training_documents():
    held = [False, False, True, False, False, False, True]
    ids, counts = split(lm._code(iter(batches(TEXTS, held)), Shared))
    own = lm.Coder(Shared.value)
    assert ids == {i: [*(x for w in (t or "").split() for x in own.own.encode_ordinary(" " + w)), own.end] for i, t in enumerate(TEXTS)}
    merged = [r for b in lm._merge(b.select(["kind", "bucket", "ids", "times"]) for b in lm._code(iter(batches(TEXTS, held)), Shared) if b.column("kind")[0].as_py() != lm.DOCUMENT) for r in b.to_pylist()]
    words = Counter(w for t, h in zip(TEXTS, held, strict=True) if not h for w in (t or "").split())
    assert sorted(r["n"] for r in merged if r["kind"] == lm.WORD) == sorted([*words.values(), held.count(False)])
    assert {r["n"] for r in merged if r["kind"] == lm.WORD and r["key"] == lm.END_WORD} == {held.count(False)}
    pairs = Counter(p for i, h in enumerate(held) if not h for p in zip([own.end, *ids[i][:-1]], ids[i], strict=True))
    assert {(r["key"] >> 20, r["key"] & (1 << 20) - 1): r["n"] for r in merged if r["kind"] == lm.PAIR} == pairs
    assert len({(r["kind"], r["bucket"]) for r in counts}) == len(counts)


def test_words_are_told_apart_in_ids():
    """Equal words, and no others, have equal keys, which are those that were counted."""
    rows = list(lm._code(iter(batches(TEXTS, [False] * len(TEXTS))), Shared))
    leads = lm.leads_of(Shared.value)
    scorer = lm.Scorer(None, np.zeros(len(leads), np.int64), np.zeros(1, np.int64), np.zeros(len(leads)), leads)
    ((_, _, ids, bounds),) = scorer.chunks(rows[0].column("ids"))
    keys, n = scorer.words(ids, bounds)
    words = [w for t in TEXTS for w in (t or "").split()]
    assert n.tolist() == [len((t or "").split()) for t in TEXTS]
    assert len(dict(zip(words, keys.tolist(), strict=True))) == len(set(keys.tolist())) == len(set(zip(words, keys.tolist(), strict=True)))
    counted = {r["key"] & (1 << 64) - 1 for b in lm._merge(b.select(["kind", "bucket", "ids", "times"]) for b in rows[1:]) for r in b.to_pylist() if r["kind"] == lm.WORD}
    assert counted == {*keys.tolist(), lm.END_WORD}
    keys, n = scorer.words(np.full(3, scorer.end, np.uint16), np.arange(4))
    assert not len(keys) and n.tolist() == [0, 0, 0]


@pytest.mark.parametrize("slots", [1, 4, 1 << 12])
def test_kept_words_are_coded_as_before(slots, monkeypatch):
    """Also where words share slots, or are too long to be kept."""
    monkeypatch.setattr(lm, "SLOTS", slots)
    coder, r = lm.Coder(Shared.value), np.random.default_rng(1)
    for _ in range(20):
        texts = [" ".join(r.choice([w for t in TEXTS for w in (t or "").split()], 8)) for _ in range(3)]
        ((_, _, data, offs),) = text_chunks(pa.array(texts))
        w = Words(data, offs, SPACE)
        ids, bounds = coder.tokens(w, *lm._uniques(w))
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [[*(x for w in t.split() for x in coder.own.encode_ordinary(" " + w)), coder.end] for t in texts]


def test_bytes_that_are_no_text_keep_words_apart():
    coder, body = lm.Coder(Shared.value), [b"a\xffb the", b"a\xfeb caf\xc3\xa9", b"a\xffb \xe2\x82"]
    text = pa.Array.from_buffers(pa.string(), 3, pa.array(body, pa.binary()).buffers())
    ((_, _, data, offs),) = text_chunks(text)
    w = Words(data, offs, SPACE)
    ids, bounds = coder.tokens(w, *lm._uniques(w))
    assert [b"".join(coder.own.decode_single_token_bytes(i) for i in ids[a : b - 1]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [b" " + x for x in body]
    assert coder.leads[ids].sum() == 6
    valid = coder.own.encode_ordinary(" the") + coder.own.encode_ordinary(" café")
    assert [i for i in ids[: bounds[2]] if i in valid] == valid


def test_sums_of_blocks_and_of_keys():
    r = np.random.default_rng(2)
    for n in (0, 1, 255, 256, 700):
        a, b = r.standard_normal((n, 3)), r.standard_normal((n, 5))
        assert np.allclose(attention._tall(a, b), a.T @ b)
    units, rows = r.integers(0, 5, 40), r.standard_normal((40, 3)).astype(np.float32)  # an odd number of columns
    want = np.zeros((6, 3))
    np.add.at(want, units, rows)
    assert np.allclose(attention._summed(units, rows, 6), want, atol=1e-5)
    keys = r.integers(0, 50, 300).astype(np.uint64)
    unique, where, inverse = lm._unique(keys)
    assert unique.tolist() == sorted(set(keys.tolist())) and (keys[where] == unique).all() and (unique[inverse] == keys).all()
    assert [len(x) for x in lm._unique(keys[:0])] == [0, 0, 0]
    sums = lm._Sums()
    for part in (keys[:100], keys[100:], keys[:0]):
        sums.add(*np.unique(part, return_counts=True))
    got = sums.merged()
    assert (got[0] == unique).all() and (got[1] == np.unique(keys, return_counts=True)[1]).all()
