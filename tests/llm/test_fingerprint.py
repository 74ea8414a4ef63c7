import hashlib

import numpy as np
from conftest import *  # noqa: F403

from loomdoc.llm import fingerprint as P


def expected(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    for i, (id_, text) in enumerate(ordered):
        text, after = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        new = text[: len(text) - half] + after[:half]
        yield id_, len(text), hashlib.sha256(new.encode()).hexdigest(), text, new, after


def share(a, b):
    x, y = shingles(a, 5), shingles(b, 5)  # noqa: F405
    return 1.0 if not x and not y else len(x & y) / max(1, len(x | y))


def test_neighbours_and_likeness(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = {r["doc_id"]: r for r in P.with_next(docs, range_bytes=20_000).collect()}
    errors, by_text = [], {}
    for id_, n, sha, text, new, after in expected(rows):
        r = got[id_]
        assert (r["n_chars"], r["edited_sha256"]) == (n, sha)
        errors += [r["near_edited"] - share(text, new), r["near_next"] - share(text, after)]
        assert by_text.setdefault(text, r["fingerprint"]) == r["fingerprint"]
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.04 and np.abs(errors).max() < 0.15
    whole = {r["doc_id"]: r for r in P.with_next(docs).collect()}
    assert whole == got


def test_edge_cases(edge, clashing, empty):
    want = sorted((x[:3] for x in expected([(r[0], r[1]) for r in EDGE])), key=str)  # noqa: F405
    for table in (edge, clashing):
        for size in (1 << 23, 10_000):
            got = P.with_next(table, range_bytes=size).collect()
            assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=str) == want
    assert P.with_next(empty).count() == 0
    marks = {r["doc_id"]: r["fingerprint"] for r in P.fingerprints(edge).where("doc_id IS NOT NULL").collect()}
    assert marks[4] == marks[5] == marks[6] == "" and marks[1] == marks[3] != marks[2] and len(marks[7]) == P.BINS
    assert P.likeness(b"", b"") == 1.0 and P.likeness(b"", bytes.fromhex(marks[1])) == 0.0


def test_one_document_is_its_own_neighbour(edge):
    r = P.with_next(edge.where("doc_id = 1")).first()
    text = BASE  # noqa: F405
    half = len(text) // 2
    assert r["edited_sha256"] == hashlib.sha256((text[: len(text) - half] + text[:half]).encode()).hexdigest()
    assert r["near_next"] == 1.0


def test_densified_bins_estimate_small_sets():
    """Mean error of the estimate over small random sets, many of whose bins are empty."""
    r = np.random.default_rng(3)
    errors = []
    for _ in range(200):
        n, both = int(r.integers(8, 40)), 0
        both = int(r.integers(0, n))
        new = lambda m: [f"t{x}" for x in r.integers(0, 10**9, m)]  # noqa: B023, E731
        common, a, b = new(both + 4), new(n - both), new(n - both)
        x, y = " ".join(common + a), " ".join(common + b)
        import pyarrow as pa

        p, q = P._packed(pa.array([x, y]))
        errors.append(P.likeness(p, q) - share(x, y))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.09
