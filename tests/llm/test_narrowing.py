"""What keeps the join of sets within the disk: candidates by signature, nothing left behind."""

from __future__ import annotations

import os
import random

import numpy as np
import pytest
from llm_rows import documents, workers  # noqa: F401

from lakeloom.llm import jaccard
from lakeloom.llm.hashing import WordHashes
from lakeloom.sources.staging import shared_folder


def texts(rng, sizes, edits):
    for size in sizes:
        base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        for _ in range(6):
            words = list(base)
            for _ in range(rng.randint(0, edits * size // 100 + 1)):
                words[rng.randrange(size)] = f"v{rng.randrange(10**6)}"
            yield " ".join(words[: rng.randint(size - size // 8, size)])


@pytest.mark.parametrize("similar", [jaccard.Similar(), jaccard.Similar(5, 80), jaccard.Similar(2, 30)])
def test_signatures_lose_no_similar_pair(similar):
    rng, hashes = random.Random(3), WordHashes()
    made = [jaccard.gram_set(hashes, t, similar.words) for t in texts(rng, (1, 4, 7, 16, 33, 64, 65, 127, 300, 900), 3)]
    sizes, signatures = [len(m) for m in made], [jaccard.signature(m) for m in made]
    linked = np.zeros(len(made), bool)
    for a in range(len(made)):
        for b in range(a):
            if similar.linked(len(np.intersect1d(made[a], made[b])), sizes[a], sizes[b]):
                linked[[a, b]] = True
                pair = jaccard.hopeful([sizes[a], sizes[b]], [signatures[a], signatures[b]], similar)
                assert pair.all()
    found = jaccard.hopeful(sizes, signatures, similar)
    assert linked.sum() > 20 and not (linked & ~found).any()


def test_signatures_tell_unlike_sets_apart():
    hashes, rng = WordHashes(), random.Random(4)
    made = [jaccard.gram_set(hashes, " ".join(f"w{rng.randrange(9)}" for _ in range(200)), 4) for _ in range(50)]
    assert not jaccard.hopeful([len(m) for m in made], [jaccard.signature(m) for m in made], jaccard.Similar()).any()


def test_a_full_map_gathers_only_what_may_be_similar(spark, documents, monkeypatch):
    monkeypatch.setattr(jaccard, "MAP_BITS", 10)
    gathered = []
    whole = jaccard._gathered
    monkeypatch.setattr(
        jaccard, "_gathered", lambda docs, ids, *rest: gathered.append(ids.count()) or whole(docs, ids, *rest)
    )
    rng = random.Random(5)
    # Few words, so that unlike texts share n-grams by chance; the last two are similar.
    made = [" ".join(f"w{rng.randrange(12)}" for _ in range(rng.randint(80, 120))) for _ in range(200)]
    made.append(made[7] + " and more")
    folder = f"{shared_folder(spark)}/lakeloom"
    os.makedirs(folder, exist_ok=True)
    before = set(os.listdir(folder))
    found = {r.doc_id: r.component_id for r in jaccard.similar_documents(documents(*enumerate(made))).collect()}
    assert found == {n: 7 if n == 200 else n for n in range(201)}
    assert gathered and gathered[0] <= 4
    # The keys, the places and the sets are gone, what the result reads is there.
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before}
    assert not left & {"jaccard-keys", "jaccard-stars", "jaccard-signatures", "jaccard-gathered", "links", "parents"}
