"""Source divergence against a plain restatement."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidebook.llm import divergence


def plain(rows, least=3, top=200):
    docs = [(r.lang or "", r.source or "", re.findall(rb"[A-Za-z\x80-\xff]+", (r.text or "").encode())) for r in rows]
    docs = [(lang, source, [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in ws]) for lang, source, ws in docs]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for _, _, ws in own for t in set(ws))
        kept = [t for t, n in df.items() if n >= least]
        counts = defaultdict(Counter)
        for _, source, ws in own:
            counts[source].update(w for w in ws if df[w] >= least)
        whole = sum(counts.values(), Counter())

        def shares(c):
            total = sum(c.values()) + len(kept)
            return {t: 1 + 10**9 * (c[t] + 1) // total for t in kept}

        q = shares(whole)
        p = {s: shares(c) for s, c in counts.items()}
        for s in p:
            pairs = sorted((-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode()) for o in p if o != s)
            out |= {(lang, s, "pair", o.decode(), -v, i + 1) for i, (v, o) in enumerate(pairs)}
            over = sorted((-((p[s][t] - q[t]) ** 2 // q[t]), t) for t in kept if counts[s][t] and p[s][t] > q[t])
            out |= {(lang, s, "term", t.decode(), -v, i + 1) for i, (v, t) in enumerate(over[:top])}
    return out


def rows_of(df):
    got = [(r.lang, r.source, r.part, r.item, r.value, r.rank) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("sizes", [{}, {"tile": 3, "bucket": 30}])
def test_equals_plain_counts(docs, sizes):
    assert rows_of(divergence.audit(docs, **sizes)) == plain(docs.collect())


def test_odd_rows(odd_docs, no_docs):
    assert rows_of(divergence.audit(odd_docs, least_docs=1)) == plain(odd_docs.collect(), least=1)
    assert rows_of(divergence.audit(odd_docs)) == plain(odd_docs.collect())
    assert divergence.audit(no_docs).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abé", min_size=1, max_size=20) | st.sampled_from(["a" * 8, "a" * 9, "a" * 16, "b" * 64, "b" * 65, "b" * 90, "b" * 90 + "a"]), max_size=60),
       st.sampled_from([2, 8192]))
def test_pointer_sort(terms, small):
    before, divergence.SMALL = divergence.SMALL, small
    try:
        data = np.frombuffer(" ".join(terms).encode(), np.uint8)
        sizes = np.array([len(t.encode()) for t in terms], np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]).astype(np.int64)[: len(terms)]
        order, run = divergence.pointer_sort(data, starts, starts + sizes)
    finally:
        divergence.SMALL = before
    got = [terms[i].encode() for i in order]
    assert got == sorted(t.encode() for t in terms)
    assert run.tolist() == [sorted(set(got)).index(t) for t in got]
