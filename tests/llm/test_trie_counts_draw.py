"""Prefix tries, token counts and importance resampling against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_rows import ODD, documents, odd, workers  # noqa: F401

from lakeloom.llm import counting, crcs, importance, prefix_trie, queries

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)

# What conversations may hold besides, under names that the operator uses itself.
EXTRA = "node string, parent string, depth string, total string, nth string, copy string, stretch string, id string"
TURNS = f"conv_id long, turn long, role string, text string, {EXTRA}"


def conversations_of(spark, rows):
    return spark.createDataFrame([(*row, *"abcdefgh") for row in rows], TURNS)


def ordered(rows):
    """Conversation to its turns, as the operator orders them."""
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            found[conv].append((turn is not None, turn or 0, tie, role, text))
    return {conv: [turn[3:] for turn in sorted(turns)] for conv, turns in found.items()}


def rebuilt(turns):
    out = {}
    for conv, own in turns.items():
        head = zlib.crc32(str(conv).encode()) % 9
        rest = int(math.fmod(conv, 5))
        out[conv] = turns.get(conv - rest, [])[:head] + own[head:]
    return out


def trie_of(conversations):
    """Rows of the trie, by walking it node by node."""
    nodes = [{"parent": None, "depth": 0, "bytes": 0, "members": [], "ends": [], "below": {}}]
    for conv, turns in sorted(conversations.items()):
        at = 0
        nodes[0]["members"].append(conv)
        for turn in turns:
            if turn not in nodes[at]["below"]:
                nodes[at]["below"][turn] = len(nodes)
                nodes.append({"parent": at, "depth": nodes[at]["depth"] + 1, "bytes": len(turn[1].encode()), "members": [], "ends": [], "below": {}})
            at = nodes[at]["below"][turn]
            nodes[at]["members"].append(conv)
        nodes[at]["ends"].append(conv)
    for node in reversed(nodes):
        node["leaves"] = node.get("leaves", 0) + (not node["below"])
        node["saved"] = node.get("saved", 0) + (len(node["members"]) - 1) * node["bytes"]
        if node["parent"] is not None:
            above = nodes[node["parent"]]
            above["leaves"] = above.get("leaves", 0) + node["leaves"]
            above["saved"] = above.get("saved", 0) + node["saved"]
    if not conversations:
        return []
    return sorted(
        (
            min(n["members"]), n["depth"], -1 if n["parent"] is None else min(nodes[n["parent"]]["members"]), len(n["members"]),
            len(n["below"]), n["leaves"], n["saved"], hashlib.sha256(",".join(map(str, n["ends"])).encode()).hexdigest(),
        )
        for n in nodes
    )


def found_rows(df):
    return sorted((*r[:2], -1 if r[2] is None else r[2], *r[3:8]) for r in df.collect())


ODD_TURNS = [
    (0, 0, "user", "hello"), (0, 1, "assistant", "there"), (0, None, "system", "be kind"),
    (1, 0, "user", "hello"), (1, 1, None, None), (1, 2, "", ""),
    (2, 5, "user", "é" * 4), (2, 5, "user", "é" * 4), (2, 5, "assistant", "x"), (2, None, None, "a"), (2, None, None, "a"),
    (3, 0, "user:", "a"), (4, 0, "user", ":a"), (None, 0, "user", "no id"), (None, None, None, None),
    (-1, 0, "user", "hello"), (-5, 0, "user", "below"), (-5, 1, "user", "zero"), (-6, 3, "user", "later"),
    (7, -1, "user", "minus"), (7, 0, "user", "hello"), (9, 1, "user", "long " * 50_000), (9223372036854775806, 1, "a", "b"),
]


def test_trie_of_odd_turns(spark, tmp_path):
    frame = conversations_of(spark, ODD_TURNS)
    frame.write.parquet(str(tmp_path / "conversations.parquet"))
    assert found_rows(queries.op11_prefix_trie(spark, str(tmp_path))) == trie_of(rebuilt(ordered(ODD_TURNS)))
    assert found_rows(prefix_trie.prefix_trie(prefix_trie.whole(prefix_trie.ordered_turns(frame)))) == trie_of(ordered(ODD_TURNS))


def test_trie_of_no_turns(spark, tmp_path):
    conversations_of(spark, []).write.parquet(str(tmp_path / "conversations.parquet"))
    assert queries.op11_prefix_trie(spark, str(tmp_path)).collect() == []


def test_trie_of_branching_and_long_conversations(spark, tmp_path, monkeypatch):
    # Small blocks, so that conversations of some dozen turns lie in several of them and ids in several chunks.
    monkeypatch.setattr(prefix_trie, "BLOCK", 16)
    monkeypatch.setattr(prefix_trie, "IDS_BITS", 4)
    monkeypatch.setattr(prefix_trie, "BAND", 3)
    draw = random.Random(3)
    rows = []
    for conv in range(150):
        for turn in range(draw.choice([1, 2, 5, 9, 33, 70])):
            # Turns agree for a while and then mostly differ.
            text = f"t{turn}" if draw.random() < 0.97 else f"{conv}-{turn}"
            rows.append((conv, turn, "user", text))
    rows += [(conv, turn, "user", f"t{turn}") for conv in range(200, 300) for turn in range(4)]
    draw.shuffle(rows)
    conversations_of(spark, rows).write.parquet(str(tmp_path / "conversations.parquet"))
    assert found_rows(queries.op11_prefix_trie(spark, str(tmp_path))) == trie_of(rebuilt(ordered(rows)))


def test_trie_of_one_very_long_conversation(spark):
    rows = [(1, turn, "user", str(turn)) for turn in range(2600)] + [(2, turn, "user", str(turn)) for turn in range(1500)]
    rows += [(3, turn, "user", str(turn % 1100)) for turn in range(1300)]
    frame = conversations_of(spark, rows)
    assert found_rows(prefix_trie.prefix_trie(prefix_trie.whole(prefix_trie.ordered_turns(frame)))) == trie_of(ordered(rows))


pieces = st.lists(
    st.sampled_from(["a", " ", "  ", "\n", "\r", "\t", "the", "ing", "▁", "<s>", "</s>", "<unk>", "<0x0A>", "é", "漢字", "😀", "\xa0", "1", "!", "\0", " ", ";\r", "�"])
    | st.text(max_size=3),
    max_size=14,
).map("".join).filter(lambda t: not any("\ud800" <= c <= "\udfff" for c in t))


@settings(max_examples=400, deadline=None)
@given(pieces)
def test_parts_have_the_tokens_of_the_text(text):
    parts = [part for some in counting.parts_of(text) for part in some] if text else []
    assert "".join(parts) == (" " + text.replace("▁", " ") if text else "")
    assert sum(counting.tokens_of(parts, MODEL)) == len(LIBRARY.encode(text))


def test_long_texts_are_cut_at_spaces(monkeypatch):
    monkeypatch.setattr(counting, "SLICE_CHARS", 7)
    for text in ("a bc  def\n ghi" * 9, " " * 40, "x" * 40, "x \n" * 20, "▁▁a▁" * 9):
        parts = [part for some in counting.parts_of(text) for part in some]
        assert "".join(parts) == " " + text.replace("▁", " ")
        assert sum(counting.tokens_of(parts, MODEL)) == len(LIBRARY.encode(text))


def test_a_model_that_changes_texts_is_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as proto

    loaded = proto.ModelProto()
    with open(MODEL, "rb") as file:
        loaded.ParseFromString(file.read())
    loaded.normalizer_spec.remove_extra_whitespaces = True
    path = str(tmp_path / "other.model")
    with open(path, "wb") as file:
        file.write(loaded.SerializeToString())
    with pytest.raises(ValueError, match="changes texts"):
        counting.require_separable(path)


def some_documents(seed, count=60):
    draw = random.Random(seed)
    words = ["the", "The", "fox", "über", "漢字", "a1", "don't", "x-y", "\n", "  ", "<s>", "▁", "🙂", "limit"]
    texts = [" ".join(draw.choices(words, k=draw.choice([0, 1, 19, 20, 21, 90, 700]))) for _ in range(count)]
    return [*ODD, *((100 + nth, text) for nth, text in enumerate(texts)), (100, "other text of a known id"), (8, "word " * 5000)]


def test_token_counts_query(spark, documents, tmp_path, monkeypatch):
    rows = some_documents(1)
    # Several blocks.
    monkeypatch.setattr(counting, "BLOCK_CHARS", 20_000)
    documents(*rows).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    expected = Counter()
    for key, text in rows:
        tokens = len(LIBRARY.encode(text or ""))
        expected[key, len((text or "").encode()), tokens, tokens > 4096] += 1
    found = queries.op12_token_counts(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert Counter(tuple(r) for r in found.collect()) == expected
    assert True in {row[3] for row in expected}
    assert counting.count_tokens(documents().limit(0), MODEL).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=70), st.binary(max_size=3000))
def test_crc_of_what_lies_between(first, second):
    def part(data):
        return np.array([zlib.crc32(data)], np.uint32)

    assert crcs.between(part(first), part(first + second), np.array([len(second)]))[0] == zlib.crc32(second)
    assert crcs.pushed(part(first), 0x20)[0] == zlib.crc32(first + b" ")


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def runs_of(text, least, most):
    words = words_of(text)
    return [" ".join(words[i : i + n]) for n in range(least, most + 1) for i in range(len(words) - n + 1)]


@pytest.mark.parametrize("least, most, flush", [(1, 1, 5), (1, 3, 4), (2, 4, 1 << 19), (3, 3, 1)])
def test_stream_gives_every_run(monkeypatch, least, most, flush):
    monkeypatch.setattr(importance, "SLICE_BYTES", 11)
    monkeypatch.setattr(importance, "FLUSH_WORDS", flush)
    got = []
    stream = importance.Stream(least, most, lambda texts, found: got.extend(zip(texts.tolist(), found.tolist(), strict=True)))
    texts = ["The quick-brown fox", "", None, "x", "über 漢字 1st WORD " * 9, "a" * 50 + " b", "..."]
    counts = [stream.read(nth, text) for nth, text in enumerate(texts)]
    stream.flush()
    assert counts == [len(words_of(text)) for text in texts]
    assert Counter(got) == Counter((nth, zlib.crc32(run.encode())) for nth, text in enumerate(texts) for run in runs_of(text, least, most))


def drawn_of(rows, target, how):
    buckets = lambda text: [zlib.crc32(run.encode()) % how.buckets for run in runs_of(text, how.least, how.most)]
    s, t = (Counter(b for text in texts for b in buckets(text)) for texts in ([r[1] for r in rows], target))
    n, m = sum(s.values()), sum(t.values())
    out = []
    for key, text in rows:
        own = buckets(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (n + how.buckets) / ((s[b] + 1) * (m + how.buckets)))) for b in own)
        h = int(hashlib.sha256(f"{how.seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([key, len(own), weight, score, None, len(words_of(text))])
    enough = sorted((r for r in out if r[5] >= how.least_words), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1], r[2]))
    for nth, row in enumerate(enough[: how.share * len(enough) // 100]):
        row[4] = nth + 1
    return Counter(tuple(r[:5]) for r in out)


def test_importance_query(spark, documents, tmp_path):
    rows = some_documents(2, 150)
    target = ["the fox limit limit", None, "", "a1 a1 über"]
    documents(*rows).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(n, t) for n, t in enumerate(target)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    found = queries.op13_importance_resampling(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    expected = drawn_of(rows, target, importance.Resampling())
    assert Counter(tuple(r) for r in found.collect()) == expected
    assert sum(row[4] is not None for row in expected) > 5


def test_resample_of_longer_runs(spark, documents):
    rows, target = some_documents(4, 40), ["the fox limit limit", "word word word"]
    how = importance.Resampling(least=1, most=2, buckets=97, share=50, least_words=1, seed="x")
    docs = documents(*rows)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    expected = drawn_of(rows, target, how)
    found = importance.importance(docs, goal, how).drop("n_words")
    assert Counter(tuple(r) for r in found.collect()) == expected
    drawn = {row[0] for row in expected if row[4] is not None}
    kept = importance.resample(docs, goal, how)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(row for row in rows if row[0] in drawn)


def test_importance_of_empty_tables(spark, documents, odd):
    nothing = spark.createDataFrame([], "text string")
    assert importance.importance(documents(), nothing).collect() == []
    assert len(importance.importance(odd, nothing).collect()) == len(ODD)
