import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from surveyflow.llm import bpe, packing, queries

RANKS, TOKENIZER = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aabtheing ions'sé漢😀\n\t\x1c\x85 .,#0 ", max_size=60))
def test_bpe_equals_tiktoken(reference, text):
    words = bpe.vocabulary(RANKS, P.PATTERN)
    ids = words.encode(text).tolist()
    assert ids == reference.encode_ordinary(text)
    assert words.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["a" * 20_000, "ab" * 9000, " " * 9000, "the" * 5000, "\n \n" * 3000])
def test_bpe_of_long_runs(reference, text):
    assert bpe.vocabulary(RANKS, P.PATTERN).encode(text).tolist() == reference.encode_ordinary(text)


def test_bpe_without_greedy_path(reference):
    words = bpe.vocabulary(RANKS, P.PATTERN)
    whole, words.automaton = words.automaton, _Backtracking(words.automaton)
    try:
        for text in ["ionsiontion", "aaaaaaab", "internationalisation", "thththeth"]:
            assert words.encode_piece(text.encode()) == reference.encode_ordinary(text)
    finally:
        words.automaton = whole


class _Backtracking:
    """An automaton whose greedy matches, "t" and "he", would have been joined and so do not fit."""

    def __init__(self, automaton):
        self.iter = automaton.iter

    def iter_long(self, text):
        ranks = bpe.vocabulary(RANKS, P.PATTERN).ranks
        return [(0, ranks[b"t"]), (2, ranks[b"he"])]


def test_vocabulary_needs_all_bytes():
    with pytest.raises(ValueError, match="single byte"):
        bpe.Vocabulary({b"a": 0}, P.PATTERN)


def test_bpe_operator(spark, odd, nothing, odd_rows, reference):
    encoded = bpe.encode(odd, RANKS, P.PATTERN)
    rows = bpe.decode(encoded, RANKS, P.PATTERN).collect()
    want = sorted((str(i), reference.encode_ordinary(t or ""), (t or "").encode()) for i, t in odd_rows)
    assert sorted((str(r.doc_id), r.ids, bytes(r.decoded)) for r in rows) == want
    assert bpe.decode(bpe.encode(nothing, RANKS, P.PATTERN), RANKS, P.PATTERN).count() == 0
    absent = spark.createDataFrame([(1, None), (2, [0])], "doc_id long, ids array<int>")
    assert [r.decoded for r in bpe.decode(absent, RANKS, P.PATTERN).orderBy("doc_id").collect()] == [None, bytearray(b"!")]


def test_bpe_query(spark, sf, corpus, reference):
    for r in queries.op4_byte_bpe(spark, sf).collect():
        text = corpus[r.doc_id].text
        ids = reference.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "the", " ", "  ", "é", "\n", ".", "'s", "12", "<|endoftext|>", "漢", "###", ", "]), max_size=25).map("".join))
def test_remembered_pieces_equal_whole_texts(text):
    coder = packing.tokens(TOKENIZER)
    assert np.frombuffer(coder.packed(text), "<u4").tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids


def test_other_tokenizers_take_whole_texts():
    coder = packing.tokens(P.path("word_bpe_49k.json"))
    assert not coder.known
    assert np.frombuffer(coder.packed("Hello there"), "<u4").tolist() == coder.tokenizer.encode("Hello there", add_special_tokens=False).ids


def check_packing(rows, texts, capacity=2048):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    ids = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for i, t in texts.items()}
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes())
    assert set(pieces) == set(ids)
    for i, own in pieces.items():
        own.sort(key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert [r.start for r in own] == np.r_[0, np.cumsum([r.length for r in own])][:-1].tolist()
        assert sum(r.length for r in own) == len(ids[i])
        assert all(r.length == capacity for r in own[1:])
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == np.r_[0, np.cumsum([r.length for r in own])][:-1].tolist()
        assert sum(r.length for r in own) <= capacity
    return len(sequences), -(-sum(map(len, ids.values())) // capacity)


def test_packing_query(spark, sf, corpus):
    used, bound = check_packing(queries.op8_packing(spark, sf).collect(), {i: r.text for i, r in corpus.items()})
    assert used <= bound + 1


def test_packing_of_odd_rows(odd, nothing, odd_rows):
    from pyspark.sql import functions as F

    cut = packing.pieces(odd, TOKENIZER).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    rows = packing.pack(cut, group=4).collect()
    once = [r for r in rows if r.doc_id != 4]
    assert sum(r.doc_id == 4 for r in rows) == 2
    assert {r.doc_id for r in once} == {i for i, _ in odd_rows if i != 4}
    for own in _by_sequence(rows).values():
        assert sum(r.length for r in own) <= 2048
        assert sorted(r.offset for r in own) == np.r_[0, np.cumsum([r.length for r in sorted(own, key=lambda r: r.offset)])][:-1].tolist()
    assert packing.pack(packing.pieces(nothing, TOKENIZER).drop("ids")).count() == 0


def _by_sequence(rows):
    found = {}
    for r in rows:
        found.setdefault(r.sequence_id, []).append(r)
    return found


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_respects_every_limit(rule):
    lengths = np.random.default_rng(0).integers(1, 100, 500)
    limits = (100, 3, 4000)
    where, offset, used = packing.best_fit(lengths, limits, rule=rule)
    assert set(where) == set(range(used))
    for s in range(used):
        own = lengths[where == s]
        alone = len(own) == 1
        assert own.sum() <= 100 and len(own) <= 3 and (alone or (own**2).sum() <= 4000)
        assert sorted(offset[where == s]) == np.r_[0, np.cumsum(lengths[where == s][np.argsort(offset[where == s])])][:-1].tolist()


def test_best_fit_takes_the_closest_gap():
    where, _, used = packing.best_fit(np.array([60, 70, 30, 40]), (100, 10, 10**9))
    assert used == 2 and where[0] == where[3] and where[1] == where[2]


def test_recent_memo_keeps_what_is_asked_for():
    made = []
    memo = packing.Recent(lambda key: made.append(key) or key.upper(), 8, 5)
    for n in range(40):
        assert memo["ab"] == "AB" and memo[f"k{n}"] == f"K{n}"
        assert len(memo) + len(memo.older) <= 8
    assert made.count("ab") == 1 and len(made) == 41
    assert memo["too long"] == "TOO LONG" and "too long" not in memo


@pytest.mark.parametrize("space", [" ", "\t", "\n", "\u00a0", "\u2003", "\u3000", "\x1c", "\x1f", "\x85", "\u2028", "\u200b", "\ufeff"])
def test_white_space_of_all_kinds(space):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    plain, own = Tokenizer.from_file(path), packing.Tokens(path, 1000)
    for text in (f"a {space}b", f"a{space} b", f"a {space}", f"{space} a", f" {space}", f"a{space}{space} b{space}\n c", f"x {space}{space}y z."):
        want = plain.encode(text, add_special_tokens=False).ids
        for _ in range(2):
            assert np.frombuffer(own.packed(text), "<u4").tolist() == want
