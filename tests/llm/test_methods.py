"""Each method against the definition, brute force or held-out data."""

from __future__ import annotations

import os
import random
import re
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_rows import documents, workers  # noqa: F401
from tokenizers import Tokenizer

from check import compare
from lakeloom.llm import bpe, graphs, jaccard, language, licenses, multi_index, neighbours, packing, pieces, queries, repetition, shards, token_index
from lakeloom.llm.hashing import WordHashes
from lakeloom.sources.staging import fresh_path

SMALL = "/root/testdata/sf0.001"
data = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test data")

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
texts = st.lists(
    st.sampled_from(["a", " ", "\n", "the", "ing", "'s", "é", "ß", "漢字", "😀", "\xa0", "1", "!", "..", "\t", "\x1c", "\0", "İ", "Σ", "́", "<|endoftext|>"]) | st.text(max_size=3),
    max_size=14,
).map("".join).filter(lambda t: t.isascii() or not any("\ud800" <= c <= "\udfff" for c in t))


@lru_cache
def own_encoding() -> tiktoken.Encoding:
    ranks = bpe.read_ranks(RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=150, deadline=None)
@given(texts)
def test_transducer_equals_the_library(text):
    library = own_encoding()
    ids = np.frombuffer(bpe.transducer_encoder(RANKS, public_tokenizers.PATTERN)(text), "<u4")
    assert ids.tolist() == library.encode_ordinary(text)
    decoder = bpe.stream_decoder(RANKS)
    assert "".join(decoder.feed(ids[i : i + 2]) for i in range(0, len(ids), 2)) == text
    decoder.close()


def test_decoder_refuses_what_is_no_text():
    decoder = bpe.StreamDecoder([b"\xc3", b"\xa9", b"a"])
    assert decoder.feed(np.array([2, 0])) == "a"
    assert decoder.feed(np.array([1])) == "é"
    decoder.feed(np.array([0]))
    with pytest.raises(UnicodeDecodeError):
        decoder.close()
    with pytest.raises(UnicodeDecodeError):
        decoder.feed(np.array([1]))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_piece_encoder_equals_the_library(name):
    path = public_tokenizers.path(name)
    library, ours = Tokenizer.from_file(path), pieces.library_encoder(path, "I")
    library.encode_special_tokens = True

    @settings(max_examples=150, deadline=None)
    @given(texts)
    def same(text):
        assert np.frombuffer(ours(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids

    same()


specials = st.lists(texts | st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext", " "]), max_size=6).map("".join)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_added_tokens_equal_the_unmodified_library(name):
    path = public_tokenizers.path(name)
    library, ours = Tokenizer.from_file(path), pieces.library_encoder(path, "I", added=True)

    @settings(max_examples=200, deadline=None)
    @given(specials)
    def same(text):
        assert np.frombuffer(ours(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids

    same()


def test_queries_match_added_tokens_in_the_text(spark, tmp_path):
    texts_of = {1: "one <|endoftext|> two<|startoftext|><|endoftext|>", 2: " \n<|endoftext|>three ", 3: None}
    spark.createDataFrame(list(texts_of.items()), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    expected, start = {}, 0
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        library = Tokenizer.from_file(public_tokenizers.path(name))
        for key, text in texts_of.items():
            expected[name, key] = [*library.encode(text or "", add_special_tokens=False).ids, 2]
    found = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op3_token_index(spark, str(tmp_path)).collect()}
    for key in texts_of:
        ids = expected["word_bpe_49k.json", key]
        assert found[key] == (start, len(ids), crc(ids))
        start += len(ids)
    packed = queries.op7_best_fit_packing(spark, str(tmp_path)).collect()
    own = {key: expected["byte_bpe_50k.json", key] for key in texts_of}
    assert {r.doc_id: (r.length, r.ids_crc32) for r in packed} == {key: (len(ids), crc(ids)) for key, ids in own.items()}
    assert 50256 in own[1] and 49406 in expected["word_bpe_49k.json", 1]


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_perfect_hash_is_minimal(n):
    keys = np.array([random.Random(n * 10**6 + i).getrandbits(63) - 2**62 for i in range(n)], np.int64)
    assert sorted(token_index.PerfectHash.build(keys).slots(keys).tolist()) == list(range(n))


@data
def test_tokens_are_read_back_by_key(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    path, word = fresh_path(spark, "test-blocks"), public_tokenizers.path("word_bpe_49k.json")
    token_index.write_tokens(docs, path, word, end_id=2)
    library, start = Tokenizer.from_file(word), 0
    rows = {r.doc_id: r.text for r in docs.collect()}
    found = {r.doc_id: (r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in token_index.read_tokens(spark, path).collect()}
    for key in sorted(rows):
        ids = [*library.encode(rows[key], add_special_tokens=False).ids, 2]
        assert found[key] == (start, ids)
        start += len(ids)
    some = token_index.lookup(spark, path, [5, 17, 10**9])
    assert {k: v.tolist() for k, v in some.items()} == {k: found[k][1] for k in (5, 17)}


def test_shards_are_a_permutation_with_even_counts(spark, documents):
    docs = documents(*[(n % 7, "same text") for n in range(1000)])
    dealt = shards.shuffle_into_shards(docs, shards=7, bucket_bytes=2000).collect()
    slots = {s: sorted(r.slot for r in dealt if r.shard == s) for s in range(7)}
    assert all(slots[s] == list(range(len(slots[s]))) for s in slots)
    assert {len(s) for s in slots.values()} <= {142, 143}
    assert Counter(r.record.doc_id for r in dealt) == Counter(n % 7 for n in range(1000))
    again = shards.shuffle_into_shards(docs, shards=7, bucket_bytes=2000).collect()
    place = lambda rows: sorted((r.shard, r.slot, r.record.doc_id) for r in rows)
    assert place(again) == place(dealt)
    other = shards.shuffle_into_shards(docs, shards=7, seed=1, bucket_bytes=2000).collect()
    assert place(other) != place(dealt)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_packing_holds_its_laws(sizes):
    numbers, offsets = packing.pack(sizes, 20)
    held = {}
    for size, number, offset in zip(sizes, numbers, offsets):
        held.setdefault(number, []).append((offset, size))
    for entries in held.values():
        at = 0
        for offset, size in sorted(entries):
            assert offset == at
            at += size
        assert at <= 20
    assert sorted(held) == list(range(len(held)))
    first = packing.Bins(sizes, 20)
    first.best_fit()
    assert len(held) <= first.used()


def test_local_search_empties_a_bin():
    # Best fit leaves 12+5, 8+6+5, 7: exchanges make 12+8, 7+6+5 and so on.
    bins = packing.Bins([6, 6, 5, 5, 5, 3], 15)
    bins.items, bins.fill = [{0, 1}, {2, 3}, {4}, {5}], [12, 10, 5, 3]
    bins.search()
    assert bins.used() == bins.least() == 2


def test_pieces_of_long_documents(documents):
    docs = documents((1, "word " * 3000), (2, "short"), (3, None))
    rows = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json")).orderBy("doc_id", "piece").collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = [*library.encode("word " * 3000, add_special_tokens=False).ids, 2]
    own = [r for r in rows if r.doc_id == 1]
    assert [i for r in own for i in np.frombuffer(r.ids, "<u4").tolist()] == ids
    assert [r.length for r in own[1:]] == [1024] * (len(own) - 1) and own[0].length == (len(ids) % 1024 or 1024)
    assert [r.start for r in own] == [sum(o.length for o in own[:n]) for n in range(len(own))]
    assert [r.length for r in rows if r.doc_id == 3] == [1]


def test_license_places_equal_brute_force(documents):
    rng = random.Random(4)
    words = ["mit", "license", "MIT", "License", "cc", "by", "apache", "gnu", "general", "public", "x", "é"]
    rows = [(n, "".join(rng.choice(words) + rng.choice([" ", "-", "\n", ".", ", "]) for _ in range(rng.randint(0, 40)))) for n in range(150)]
    rows.append((900, "Permission is hereby granted, free of charge, to any person obtaining a COPY of this software and "
                      "the associated documentation files, to deal in the software without restriction"))
    rows.append((901, "Redistribution and use in any way"))
    found = {r.doc_id: r for r in licenses.scan(documents(*rows)).collect()}
    for n, text in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        places = sorted(
            (at, label) for phrase, label in licenses.PHRASES.items() for at in range(len(own))
            if own[at : at + len(phrase.split())] == phrase.split()
        )
        r = found[n]
        assert (r.n_words, r.n_base) == (len(own), len(places))
        assert (r.first_word, r.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({label for _, label in places}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
    assert (found[900].labels, found[900].base_labels) == ("mit", "") and 0.7 <= found[900].score <= 1
    assert (found[901].labels, found[901].score) == ("", 0.0)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=40), st.integers(1, 4))
def test_repeats_equal_brute_force(words, shortest):
    covered, longest = set(), 0
    for i in range(len(words)):
        for j in range(len(words)):
            k = 0
            while i != j and max(i, j) + k < len(words) and words[i + k] == words[j + k]:
                k += 1
            if k >= shortest:
                covered.update(range(i, i + k))
                longest = max(longest, k)
    assert repetition.repeats(np.array(words, np.uint64), shortest) == (len(covered), longest)


def test_document_rules():
    rules = repetition.DocumentRules(repetition.RepetitionLimits())
    text = "a b c d a b c\n\n a | ü#\nx\nx\n"
    assert rules(text)[:5] == (12, 13, 2, 1, 6)
    line = " ".join(f"w{n}" for n in range(60))
    assert rules(line)[-1] and not rules(f"{line}\n{line}")[-1]
    assert rules(f"{line} {' '.join(f'v{n}' for n in range(60))} w0 w1 w2 w3 w4 w5 w6 w7 w8")[6:] == (18, 9, True)


def family(rng, size, count, edits):
    base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
    for _ in range(count):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"v{rng.randrange(10**6)}"
        yield " ".join(words)


@pytest.mark.parametrize("similar", [jaccard.Similar(), jaccard.Similar(5, 80)])
@pytest.mark.parametrize("sets", [256, 5])
def test_jaccard_components_equal_brute_force(documents, monkeypatch, similar, sets):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", sets)
    rng = random.Random(6)
    made = [t for size in (3, 5, 9, 20, 60, 150) for t in family(rng, size, 14, max(1, size // 25))] + ["a b", "A b", "a b c d", ""]
    rng.shuffle(made)
    rows = list(enumerate(made))
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_documents(documents(*rows), similar).collect()}
    grams, root = {}, {n: n for n, _ in rows}
    for n, text in rows:
        w = text.lower().split()
        grams[n] = {tuple(w[i : i + similar.words]) for i in range(len(w) - similar.words + 1)} or ({tuple(w)} if w else set())

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in grams:
        for b in grams:
            shared = len(grams[a] & grams[b])
            if a < b and shared and 100 * shared >= similar.percent * len(grams[a] | grams[b]) and top(a) != top(b):
                low, high = sorted((top(a), top(b)))
                root[high] = low
    assert found == {n: (len(grams[n]), top(n)) for n in grams}


def test_a_full_map_keeps_the_most_common():
    levels = np.random.default_rng(1).choice(16, 1 << 12, p=[0.1] + [0.06] * 15).astype(np.uint8)
    common = jaccard.Commonness(jaccard.Commonness.packed(levels), np.bincount(levels, minlength=16))
    found = common.of(np.arange(1 << 12, dtype=np.uint64) << np.uint64(52))
    least = int(found[found > 0].min())
    assert not common.complete and np.array_equal(found, np.where(levels >= least, levels, 0))
    assert 0.4 < (found > 0).mean() <= 0.5


def test_gathered_documents_are_joined_by_a_shuffle(spark, documents, monkeypatch):
    hinted = []
    monkeypatch.setattr(jaccard.F, "broadcast", lambda df: hinted.append(df.columns) or df)
    rng = random.Random(6)
    rows = list(enumerate(family(rng, 60, 12, 2)))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert len({r.component_id for r in jaccard.similar_documents(documents(*rows)).collect()}) < len(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert not any("places" in columns for columns in hinted)


@pytest.mark.parametrize("complete", [True, False])
def test_every_similar_pair_shares_a_key(complete):
    rng, hashes, similar = random.Random(8), WordHashes(), jaccard.Similar()
    for size in (6, 7, 12, 31, 33, 64, 65, 130):
        made = [jaccard.gram_set(hashes, t, 4) for t in family(rng, size + 3, 30, max(1, size // 40))]
        made += [np.sort(m[: max(1, int(len(m) * 0.86))]) for m in made]
        # The map says for some n-grams how common they are; where it is complete, for all that are shared.
        grams, counts = np.unique(np.concatenate(made), return_counts=True)
        levels = np.zeros(1 << 16, np.uint8)
        np.maximum.at(levels, grams[counts > 1] >> np.uint64(48), np.log2(counts[counts > 1]).astype(np.uint8))
        known = levels if complete else np.where(np.arange(1 << 16) % 3 == 0, levels, 0).astype(np.uint8)
        common = jaccard.Commonness(jaccard.Commonness.packed(known), np.bincount(known, minlength=16))
        assert np.array_equal(common.of(grams), known[grams >> np.uint64(48)])
        common.complete = complete
        keys = [set(common.keys(common.ordered(m), similar).tolist()) for m in made]
        for a in range(len(made)):
            for b in range(a):
                both = len(np.intersect1d(made[a], made[b]))
                if 100 * both >= 85 * (len(made[a]) + len(made[b]) - both) and not np.array_equal(made[a], made[b]):
                    assert keys[a] & keys[b]


def test_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    chain = [(n, n + 1) for n in range(100, 160)]
    star = [(1, n) for n in range(2, 30)]
    loose = [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)] + [(7, 7), (None, 3), (100, 101)]
    links = chain + star + loose
    root: dict[int, int] = {}

    def top(n):
        while root.setdefault(n, n) != n:
            n = root[n]
        return n

    for a, b in links:
        if a is not None and a != b and top(a) != top(b):
            low, high = sorted((top(a), top(b)))
            root[high] = low
    found = graphs.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == {n: top(n) for n in root}


@pytest.mark.parametrize("cells", [(8192, 2048), (20, 9)])
def test_near_vectors_equal_brute_force(spark, monkeypatch, cells):
    monkeypatch.setattr(multi_index, "VISITORS", cells[0])
    monkeypatch.setattr(multi_index, "RESIDENTS", cells[1])
    rng = np.random.default_rng(2)
    base = rng.standard_normal((40, 16))
    vectors = np.concatenate([base + 0.07 * rng.standard_normal(base.shape) for _ in range(8)] + [base[:5]] * 3)
    rows = [(n, v.tolist(), n % 3 if n < 320 else 0) for n, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    index = multi_index.Index(cell=10, fewest=6)
    found = {r.vec_id: r.n_links for r in multi_index.near_duplicates(frame, index).collect()}
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    labels = np.array([r[2] for r in rows])
    linked = (units @ units.T >= index.threshold) & (labels[:, None] == labels[None])
    expected = linked.sum(1) - 1
    assert sum(found.values()) >= 0.99 * expected.sum() > 0
    assert all(found[n] <= expected[n] for n in found)


@data
def test_sql_counterparts(spark):
    for name in ("op1_multi_index", "op10_ngram_jaccard"):
        assert compare(spark, SMALL, [name])[name].startswith("ok")


@data
def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    named = language.identify(docs, language.fit_languages(docs)).where(language.held_out("record.doc_id")).collect()
    assert sum(r.record.lang == r.lang_pred for r in named) >= 0.97 * len(named) > 100
    assert not any(r.rejected for r in named)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    truth = {r.doc_id: r.quality for r in labels.collect()}
    scored = neighbours.score_quality(docs, neighbours.fit_quality(docs, labels)).where(language.held_out("record.doc_id"))
    known = [(truth[r.record.doc_id], r.score >= 0.3) for r in scored.collect() if r.record.doc_id in truth]
    assert sum(bool(q) == p for q, p in known) >= 0.95 * len(known) > 50


@data
def test_texts_of_no_learned_language_are_rejected(spark):
    docs, rng = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), random.Random(11)
    polish = "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw".split()
    finnish = "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan".split()
    russian = "все люди рождаются свободными и равными в своем достоинстве и правах".split()
    makers = [
        *(lambda of=of: rng.choice(of) for of in (polish, finnish, russian)),
        lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))),
        lambda: "".join(chr(rng.randint(0x4E00, 0x5FFF)) for _ in range(8)),
    ]
    foreign = [" ".join(make() for _ in range(words)) for make in makers for words in (12, 60, 1500)]
    foreign.append(" ".join(f"{rng.getrandbits(64):016x}" for _ in range(200)))
    fitted = language.fit_languages(docs)
    assert all(fitted.predict(foreign)[2])
    # Short and repetitive texts of the learned languages stay.
    own = [r.text for r in docs.where(language.held_out()).collect()]
    starts = [t[:40] for t in own if len(t) > 40]
    assert sum(fitted.predict(own)[2]) == 0
    assert sum(fitted.predict(starts)[2]) <= 0.02 * len(starts)


@data
def test_pipeline_stage_by_stage(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    total = docs.count()
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, SMALL)
    left = {r.doc_id: r.text for r in docs.collect()}
    assert 0.5 * total < len(left) < total
    rows = corpus_pipeline.run(spark, SMALL).collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert {r.doc_id for r in rows} == set(left)
    assert sum(r.length for r in rows) == sum(len(library.encode(t, add_special_tokens=False).ids) + 1 for t in left.values())
    fill = Counter()
    for r in rows:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 1024 and len(fill) <= 1.02 * (sum(fill.values()) / 1024) + 1
