"""Sketches, and the comparison with edited and next texts."""
import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa

from tests.llm.helpers import DOCS, corpus
from threadscope.llm import fingerprint as P


def paragraph_sets(texts):
    digests, at = P.paragraphs(pa.array(texts))
    return [set(digests[a:b].tolist()) for a, b in zip(at[:-1], at[1:], strict=True)]


def test_differences_are_exact():
    rng = random.Random(4)
    texts = [" ".join(f"x{rng.randrange(50)}" for _ in range(rng.choice([0, 1, 30, 400, 5000]))) for _ in range(60)]
    texts += ["a\n" * 50, "a\n" * 60]  # a repeated line counts each time
    other = texts[1:] + texts[:1]
    a, b = P.paragraphs(pa.array(texts)), P.paragraphs(pa.array(other))
    found = [set() for _ in texts]
    for t, d, s in zip(*P.differences(a, b), strict=True):
        found[t].add((int(d), int(s)))
    for x, y, f in zip(paragraph_sets(texts), paragraph_sets(other), found, strict=True):
        assert f == {(d, 1) for d in x - y} | {(d, -1) for d in y - x}
    assert (P.likeness(a, a) == 1).all()


def test_compare(spark):
    rows = corpus(40)
    df = spark.createDataFrame([(*r, 1) for r in rows], DOCS + ", fingerprint int")
    got = P.compare_with_edits(df).collect()
    order = sorted(((r[0] is None, r[0] or 0, r[1] or "") for r in rows), key=lambda x: (x[0], x[1], x[2].encode()))
    want = Counter()
    for i, (none, id_, t) in enumerate(order):
        n = order[(i + 1) % len(order)][2]
        e = P.edited(t, n)
        sets = paragraph_sets([t, e, n])
        near = [1.0 if not (sets[0] or s) else 2 * len(sets[0] & s) / (len(sets[0]) + len(s)) for s in sets[1:]]
        want[None if none else id_, len(t), hashlib.sha256(e.encode()).hexdigest(), round(near[0], 9), round(near[1], 9)] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got) == want
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, r.fingerprint)
    for r in rows:
        assert P.fingerprints(pa.array([r[1]]))[0] in {x.fingerprint for x in got if x.doc_id == r[0]}


def test_small_tables(spark):
    one = spark.createDataFrame([(1, "abcd", "en", "s", 4)], DOCS)
    r = P.compare_with_edits(one).collect()
    assert len(r) == 1 and r[0].near_next == 1.0 and r[0].edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    assert P.compare_with_edits(one.limit(0)).count() == 0
    assert np.array_equal(P.paragraphs(pa.array(["", None]))[1], [0, 0, 0])


def test_tables_held_at_a_time_are_bounded(monkeypatch):
    """Pairs that do not peel held up to 1 << 22 cells of 20 bytes, three times over."""
    import numpy as np

    from threadscope.llm import fingerprint as fp
    held, make = [], fp.Sketches.__init__
    monkeypatch.setattr(fp.Sketches, "__init__", lambda self, d, at, cells: held.append((len(at) - 1) * cells) or make(self, d, at, cells))
    rng = np.random.default_rng(3)
    n, m = 300, 900
    a, b = (rng.integers(1, 1 << 63, n * m, dtype=np.uint64) for _ in range(2))
    at = np.arange(0, n * m + 1, m)
    text, _, sign = fp.differences((a, at), (b, at))
    assert max(held) <= fp.ROOM
    assert (np.bincount(text[sign > 0], minlength=n) == m).all() and (np.bincount(text[sign < 0], minlength=n) == m).all()
