"""SimHash components against a plain restatement."""

import re

import numpy as np
import pytest
import xxhash

from tidebook.llm import simhash


def fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    runs = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(bits):
    """The least place that each place reaches."""
    root = list(range(len(bits)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    v = np.array(bits, np.uint64)
    for i in range(len(v)):
        for j in np.flatnonzero(np.bitwise_count(v[i] ^ v[i + 1 :]) <= 2):
            a, b = sorted((find(i), find(i + 1 + int(j))))
            root[b] = a
    return [find(i) for i in range(len(v))]


@pytest.mark.parametrize("cell", [simhash.CELL, 3])
def test_components_equal_brute_force(docs, cell):
    rows = sorted(docs.select("doc_id", "text").collect())
    bits = [fingerprint(r.text) for r in rows]
    want = {r.doc_id: (f"{b:016x}", rows[c].doc_id) for r, b, c in zip(rows, bits, classes(bits))}
    got = simhash.near_duplicates(docs, ["doc_id"], cell=cell).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == want


def test_crowds_are_keyed_again_without_loss(spark):
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 1 << 63, dtype=np.uint64)
    crowd = {int(centre)}
    for _ in range(600):
        flips = rng.choice(12, 3, replace=False)
        crowd.add(int(centre) ^ sum(1 << int(5 * f) for f in flips))
    crowd |= {int(x) for x in rng.integers(0, 1 << 63, 300, dtype=np.uint64)}
    bits = sorted(crowd)
    df = spark.createDataFrame([(np.uint64(b).astype(np.int64).item(),) for b in bits], "bits long")
    label = np.arange(len(bits))
    place = {np.uint64(b).astype(np.int64).item(): i for i, b in enumerate(bits)}
    for cell in (4096, 20):
        found = simhash.links(df, cell).collect()
        label = simhash.unite(np.arange(len(bits)), np.array([place[r.a] for r in found]), np.array([place[r.b] for r in found]))
        assert label.tolist() == classes(bits)


def test_references_fix_their_bits():
    for path in ((), (0,), (5,), (3, 2)):
        masks, group = simhash.level(path)
        assert len(masks) == 64 >> len(path) and (np.bincount(group) == len(masks) // 4).all()
        free = int(np.bitwise_or.reduce(masks))
        assert bin(free).count("1") == 64 >> len(path)
        bits = np.random.default_rng(2).integers(0, 1 << 63, 2000, dtype=np.uint64) & masks[0]
        table = simhash.distances(np.unique(bits), masks)
        assert len(np.unique(table[:, 1:] - table[:, :1], axis=0)) == len(np.unique(bits))


def test_odd_rows(odd_docs, no_docs):
    got = {(r.doc_id, r.n_chars): r for r in simhash.near_duplicates(odd_docs).collect()}
    texts = {(r.doc_id, r.n_chars): r.text for r in odd_docs.collect()}
    assert len(got) == len(texts) and all(got[k].fingerprint == f"{fingerprint(t):016x}" for k, t in texts.items())
    assert {got[k].component_id for k in got if k[0] in (2, 3, 4)} == {2}
    assert {got[k].component_id for k in got if k[0] in (6, 7, None)} == {6}
    assert simhash.near_duplicates(odd_docs).count() == odd_docs.count()
    assert simhash.near_duplicates(no_docs).count() == 0


def test_shingles_of_long_texts_are_counted_in_slices(monkeypatch):
    data = np.frombuffer(b"a b c d e f g h i j a b c", np.uint8)
    whole = simhash.majority(*simhash.shingle_hashes(data, np.array([0, len(data)])))
    monkeypatch.setattr(simhash, "HASHES", 4)
    assert simhash.majority(*simhash.shingle_hashes(data, np.array([0, len(data)]))) == whole == fingerprint("A b C d e f g h i j a b c")
