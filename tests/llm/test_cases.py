"""Cases of single operators that a whole table seldom holds."""

from __future__ import annotations

import numpy as np
import pytest
from llm_rows import documents, workers  # noqa: F401

from lakeloom.llm import language, licenses, multi_index, neighbours

MIT = next(text for text, label in licenses.SENTENCES.items() if label == "mit")
BSD = next(text for text, label in licenses.SENTENCES.items() if label == "bsd")


def vectors(spark, *rows):
    return spark.createDataFrame(list(rows), "vec_id long, embedding array<double>, label int")


def test_a_repeated_id_over_two_classes_keeps_its_rows(spark):
    a, b, c = [1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0], [0.0, 0.0, 1.0, 0.0]
    frame = vectors(spark, (1, a, 1), (2, b, 1), (5, a, 1), (5, b, 1), (9, c, 1), (5, c, 2))
    found = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in multi_index.near_duplicates(frame).collect())
    # Rows of id 5 are one node, linked to both 1 and 2.
    assert found == [(1, 1, 1, True), (2, 1, 1, False), *[(5, 2, 1, False)] * 3, (9, 0, 9, True)]


def test_an_id_that_begins_two_classes(spark):
    a, b = [1.0, 0.0], [0.0, 1.0]
    frame = vectors(spark, (1, a, 1), (1, b, 1), (7, a, 1), (8, b, 1), (9, [1.0, 0.01], 1))
    found = sorted((r.vec_id, r.n_links, r.component_id) for r in multi_index.near_duplicates(frame).collect())
    assert found == [(1, 3, 1), (1, 3, 1), (7, 2, 1), (8, 1, 1), (9, 2, 1)]


def test_a_recall_of_one_misses_nothing(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((60, 8))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    aside = rng.standard_normal((60, 8))
    aside -= (aside * base).sum(1, keepdims=True) * base
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    # Partners a hair inside the threshold, in any direction.
    near = 0.98001 * base + np.sqrt(1 - 0.98001**2) * aside
    found = np.concatenate([base, near])
    frame = vectors(spark, *[(n, v.tolist(), 1) for n, v in enumerate(found)])
    index = multi_index.Index(recall=1.0, cell=3, fewest=8)
    links = {r.vec_id: r.n_links for r in multi_index.near_duplicates(frame, index).collect()}
    expected = ((found @ found.T) / np.outer(np.linalg.norm(found, axis=1), np.linalg.norm(found, axis=1)) >= 0.98).sum(1) - 1
    assert links == dict(enumerate(expected.tolist())) and min(links.values()) >= 1


def test_texts_that_nothing_is_near_score_the_usual_share(spark, documents):
    rows = [(n, "good clean words of a kind " * 5) for n in range(30)] + [(n, "BUY !!! 99 $$$ " * 9) for n in range(30, 40)]
    rows += [(100, None), (101, ""), (102, " \n")]
    labels = [(n, int(n < 30), 0) for n in range(40)]
    learned = [q for n, q, _ in labels if not language_held_out(n)]
    usual = sum(learned) / len(learned)
    for order in (1, -1):
        docs = documents(*rows[::order])
        frame = spark.createDataFrame(labels[::order], "doc_id long, quality int, toxic int")
        scored = neighbours.score_quality(docs, neighbours.fit_quality(docs, frame)).collect()
        found = {r.record.doc_id: r.score for r in scored}
        assert found[100] == found[101] == pytest.approx(usual)
        assert found[0] > 0.9 and found[35] < 0.1
        # Equal texts have equal neighbours, however many of these are tied.
        assert len({round(found[n], 9) for n in range(30)}) == 1


def language_held_out(key):
    import zlib

    return zlib.crc32(str(key).encode()) % 5 == 0


def test_votes_of_tied_neighbours_are_shared():
    labels = np.array([1] * 10 + [0] * 30)
    counts, shapes = np.ones((40, 16), np.uint32), np.zeros((40, 8))
    model = neighbours.Neighbours(counts, shapes, labels, np.ones(16), neighbours.NeighbourFit(bits=4))
    assert model.score(counts[:2], shapes[:2]).tolist() == pytest.approx([0.25, 0.25])


def test_every_language_is_learned(documents, spark):
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "theta"]
    rows = [(n, " ".join(words[n % 7 :] + [f"w{n % 90}"])) for n in range(900)]
    docs = spark.createDataFrame([(n, t, f"l{n % 90:02d}") for n, t in rows], "doc_id long, text string, lang string")
    fitted = language.fit_languages(docs, language.LanguageFit(sample=30, centroids=1))
    assert sorted(fitted.names) == [f"l{n:02d}" for n in range(90)]


def labelled(documents, *texts):
    found = {r.doc_id: (r.labels, r.score) for r in licenses.scan(documents(*enumerate(texts))).collect()}
    return [found[n] for n in range(len(texts))]


def test_sentences_are_verified(documents):
    words = BSD.split()
    drifting = " ".join(f"{a} {b} filler{n}" for n, (a, b) in enumerate(zip(words[::2], words[1::2])))
    middle = len(words) // 2
    broken = " ".join([*words[:middle], "one", "two", "three", "four", *words[middle:]])
    shorter = " ".join(words[:4] + words[6:])
    backwards = " ".join(" ".join(words[n : n + 4]) for n in range(len(words) - 4, -1, -4))
    far = " ".join([*words[:middle], *["far"] * 30, *words[middle:]])
    found = labelled(documents, drifting, broken, shorter, backwards, far, "x " * 500 + BSD + " y" * 500, " ".join(words[:5]), MIT + " " + BSD)
    assert [labels for labels, _ in found] == ["", "bsd", "bsd", "", "", "bsd", "", "bsd,mit"]
    assert all(0.7 <= score <= 1 for labels, score in found if labels)


def test_spans_of_sentences(documents):
    rows = [(1, f"zero one {BSD} and {MIT}"), (2, f"{BSD} {BSD}")]
    found = sorted((r.doc_id, r.label, r.start, r.stop) for r in licenses.spans(documents(*rows)).where("not verbatim").collect())
    n, m = len(BSD.split()), len(MIT.split())
    assert found == [(1, "bsd", 2, 2 + n), (1, "mit", 3 + n, 3 + n + m), (2, "bsd", 0, n), (2, "bsd", n, 2 * n)]
