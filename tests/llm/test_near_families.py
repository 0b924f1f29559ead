"""Families of near copies: no component lost, and links that grow with the members, not with their pairs."""

import random

import numpy as np
import pandas as pd
import pytest

from caredeck.llm import hyperminhash as hm

from .test_documents import brute_components


def family(n, changes, seed=1):
    draw = random.Random(seed)
    base = [f"w{draw.randrange(5000)}" for _ in range(200)]
    texts = {}
    for i in range(n):
        words = list(base)
        for at in draw.sample(range(200), draw.choice(changes)):
            words[at] = f"x{draw.randrange(10**9)}"
        texts[i] = " ".join(words)
    return texts


def tile(texts):
    """All documents as one bucket of one band, each a component of its own."""
    cache, rolling = hm.WordHashes(), hm.RollingHash()
    sets = [hm.shingle_hashes(hm._words(t.encode()), cache, rolling) for t in texts.values()]
    rows = {
        "node": list(texts), "component": list(texts), "n_shingles": [len(s) for s in sets],
        "bands": [hm.registers(s).view(np.int64) for s in sets],
        "shingles": [s.view(np.int64) for s in sets],
    }
    return hm._tile(pd.DataFrame(rows).assign(band=0, key=1, tile=0, i=0, j=0))


@pytest.mark.parametrize("changes", [[4], [0, 1, 2, 3, 5, 7]])
def test_links_grow_with_the_members(changes):
    counts = [len(tile(family(n, changes))) for n in (200, 400, 800)]
    assert all(count < n for count, n in zip(counts, (200, 400, 800), strict=True))


def test_a_tile_joins_what_belongs_together():
    texts = family(150, [0, 2, 4, 6, 9])
    _, root = brute_components(texts)
    got = {i: i for i in texts}
    links = tile(texts)
    for _ in texts:
        for a, b in zip(links["a"], links["b"], strict=True):
            got[a] = got[b] = min(got[a], got[b])
    assert got == root


def test_families_against_brute_force(spark, monkeypatch):
    """The family's smallest document is far from the others, and a bucket is cut into several tiles."""
    monkeypatch.setattr(hm, "TILE_SHINGLES", 8_000)
    texts = family(1, [12], seed=2) | {i + 1: t for i, t in family(160, [1, 3, 4, 5, 8], seed=2).items()}
    sets, root = brute_components(texts)
    rows = hm.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows} == {
        i: (len(sets[i]), root[i], root[i] == i) for i in texts
    }
