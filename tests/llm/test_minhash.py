"""Near-duplicates by MinHash: against all pairs on small tables."""

import math
import random

import numpy as np
import pytest

from tallyhouse.llm import minhash
from tallyhouse.llm.ngram_join import Grams
from tests.llm import cases
from tests.llm.cases import documents, edited, odd_rows, prose, with_clashes
from tests.llm.test_pairs import near_copies
from tests.llm.test_text import thue_morse


def variants():
    """Copies of copies: chains whose ends are not linked, and a template with many fillings."""
    rows, text = [], prose(700, 300).split()
    for i in range(30):
        rows.append((1000 + i, " ".join(text)))
        r = random.Random(i)
        for _ in range(4):
            text[r.randrange(300)] = f"new{i}"
    frame = prose(701, 150)
    rows += [(2000 + i, f"{frame} {prose(9000 + i, 20)}") for i in range(40)]
    return rows + [(3000 + i, f"{frame} {prose(9000 + i // 2, 25)} end{i}") for i in range(40)]


@pytest.mark.parametrize("long_list, block, stars", [(64, 512, 2), (2, 4, 1), (3, 3, 2)])
def test_components_are_those_of_all_pairs(spark, monkeypatch, long_list, block, stars):
    monkeypatch.setattr(minhash, "LONG_LIST", long_list)
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "STARS", stars)
    monkeypatch.setattr(minhash, "PAIRS_A_PART", 5)
    rows = near_copies() + variants()
    expected = cases.components(rows, 5, 85)
    found = minhash.near_duplicates(documents(spark, rows)).collect()
    assert {r.doc_id: r.component_id for r in found} == expected
    assert {r.doc_id: r.n_shingles for r in found} == {i: len(cases.grams(t, 5)) for i, t in rows}
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_odd_rows(spark):
    rows = odd_rows()
    docs = with_clashes(documents(spark, rows))
    found = minhash.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    expected = cases.components(rows, 5, 85)
    assert all(r.component_id == expected[r.doc_id] for r in found if r.doc_id is not None)
    assert [(r.component_id, r.kept) for r in found if r.doc_id is None] == [(None, True)] * 2
    kept = minhash.without_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 3, 4, 5, 6, 8, 9, 10, 11, 12, 13, 14]
    assert minhash.near_duplicates(docs.limit(0)).count() == 0
    x, y = (t.decode() for t in thue_morse(1024))
    two = minhash.near_duplicates(documents(spark, [(1, x), (2, y), (5, x), (5, prose(1, 60)), (7, prose(1, 60))])).collect()
    assert sorted((r.doc_id, r.component_id) for r in two) == [(1, 1), (2, 2), (5, 1), (5, 1), (7, 1)]


def test_collisions_follow_the_similarity_and_few_links_can_be_lost():
    signature = minhash.Signature()
    lost = sum(math.comb(64, k) * 0.85**k * 0.15 ** (64 - k) for k in range(signature.matches))
    assert lost < 3e-10
    r = np.random.default_rng(5)
    grams = r.integers(0, 2**63, 4000).astype(np.uint64)
    one, two = np.sort(grams[:3000]), np.sort(grams[1000:])  # similarity 0.5
    both = signature.values(np.concatenate([one, two]), np.array([0, 3000, 6000]))
    assert 20 <= (both[0] == both[1]).sum() <= 44
    shares = [
        (lambda v: (v[0] == v[1]).mean())(signature.values(g, np.array([0, 85, 185])))
        for g in (np.concatenate([x[:85], x]) for x in (r.integers(0, 2**63, 100).astype(np.uint64) for _ in range(300)))
    ]
    assert np.mean(shares) == pytest.approx(0.85, abs=0.01) and min(shares) > 34 / 64


def test_classes_without_enough_shared_pairs_are_not_posted(spark):
    line = prose(60, 30)
    rows = [(i, f"{line} {prose(100 + i, 300)}") for i in range(30)] + [(100, prose(5, 90)), (101, edited(prose(5, 90), 1, 0.01))]
    signature, grams = minhash.Signature(), Grams(5, 85)
    signed = minhash.signatures(documents(spark, rows), grams, signature)
    posted = {r.doc_id for r in minhash.prefix_lists(signed, grams, signature).collect()}
    assert posted == {100, 101}
