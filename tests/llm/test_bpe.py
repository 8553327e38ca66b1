"""The transducer against tiktoken, and exact round trips."""

import base64
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from reelrank.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def codec():
    with open(PATH, "rb") as file:
        return bpe.Codec(bpe.load_ranks(file.read()), PATTERN)


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


EDGES = ["", " ", "  ", " a", "a ", "a  b", "\n \n", "x\n y", "don't we'll I'D", "=" * 300, "a" * 500, "é" * 99, "日本語" * 40,
         "🎉🚀 é́", "<|endoftext|>", "1234567 89", " a b", "tab\tsep\r\nline", "ññ ñ, ñ."]


@pytest.mark.parametrize("text", EDGES)
def test_edges(codec, reference, text):
    ids = codec.encode(text).tolist()
    assert ids == reference.encode_ordinary(text)
    assert codec.decode(ids) == text


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=60))
def test_any_text(codec, reference, text):
    ids = codec.encode(text).tolist()
    assert ids == reference.encode_ordinary(text)
    assert codec.decode(ids) == text


def test_token_soup(codec, reference):
    rng = random.Random(2)
    tokens = [t.decode("utf-8", "ignore") for t in codec.transducer.ranks]
    for _ in range(500):
        text = "".join(rng.choice(tokens) for _ in range(10))
        assert codec.encode(text).tolist() == reference.encode_ordinary(text)


def test_a_token_is_taken_apart_once_with_the_smallest_memos(codec):
    small = bpe.Transducer(codec.transducer.ranks, states=2, entries=2)
    merge, asked = small.merge, Counter()
    small.merge = lambda data, until=1: asked.update([(data, until)]) or merge(data, until)
    for word in (" transducers", " determinised", " hypotheses") * 2:
        assert tuple(small.walk(word.encode())) == tuple(codec.transducer.walk(word.encode()))
    assert asked and max(asked.values()) == 1


def test_full_tables(reference):
    with open(PATH, "rb") as file:
        ranks = bpe.load_ranks(file.read())
    rng = random.Random(4)
    words = ["thorough", "thought", "through", "though", "anderwhedor", "ciónmente", "üngöstlich", "日本語", "x" * 50]
    for states, entries in ((2, 3), (20, 20), (200, 5)):
        small = bpe.Codec(ranks, PATTERN, states, entries)
        for _ in range(60):
            text = " ".join(rng.choice(words) + rng.choice(["", ",", "s", "ing"]) for _ in range(12))
            assert small.encode(text).tolist() == reference.encode_ordinary(text)
        assert len(small.transducer._states) <= states
        assert len(small._inner) + len(small._inner.old) <= 2 * entries + 1


def test_automaton_is_begun_anew_when_most_steps_fall_outside(reference):
    with open(PATH, "rb") as file:
        small = bpe.Codec(bpe.load_ranks(file.read()), PATTERN, 3, 2)
    for k in range(200):
        text = f"w{k}ordy thing{k} mañana{k}"
        assert small.encode(text).tolist() == reference.encode_ordinary(text)
    assert small.transducer._unkept <= 50 * 3 + 60


def test_utf8_stream_holds_back_unfinished_characters():
    data = "aé日🎉z".encode()
    for size in range(1, 5):
        stream, out = bpe.Utf8Stream(), []
        for at in range(0, len(data), size):
            out.append(stream.feed(data[at:at + size]))
            assert len(stream.held) <= 3
        assert "".join(out) + stream.feed(b"", last=True) == "aé日🎉z"
    stream = bpe.Utf8Stream()
    assert stream.feed("é".encode()[:1]) == "" and stream.feed(b"", last=True) == "�"


def test_frames(spark, reference):
    rows = [(1, "Hello  wörld"), (2, None), (2, ""), (None, "x" * 5000), (1, "Hello  wörld")]
    docs = spark.createDataFrame([(*r, "extra") for r in rows], "doc_id long, text string, ids string")
    got = bpe.round_trip(docs, PATH, PATTERN, with_ids=True).collect()
    assert len(got) == len(rows)
    for r, (_, text) in zip(sorted(got, key=str), sorted(rows, key=lambda r: str(r))):
        assert r["n_tokens"] == len(r["ids"])
    by_text = {hashlib.sha256((t or "").encode()).hexdigest(): reference.encode_ordinary(t or "") for _, t in rows}
    for r in got:
        assert list(r["ids"]) == by_text[r["decoded_sha256"]]
        assert r["ids_sha256"] == hashlib.sha256(np.array(r["ids"], "<u4").tobytes()).hexdigest()
    encoded = bpe.encode(docs, PATH, PATTERN)
    back = [r["text"] for r in bpe.decode(encoded, PATH, PATTERN).collect()]
    assert sorted(back) == sorted(t or "" for _, t in rows)
    assert bpe.round_trip(docs.limit(0), PATH, PATTERN).count() == 0


def test_states_and_answers_do_not_grow_with_the_words_met(codec):
    rng = random.Random(6)
    small = bpe.Transducer(codec.transducer.ranks, entries=500)
    sizes = []
    for _ in range(4):
        for _ in range(2000):
            word = "".join(rng.choice(["er", "ing", "th", "on", "en", "tion"]) for _ in range(8))
            assert len(b"".join(small.token[i] for i in small.walk(word.encode()))) == len(word)
        sizes.append(len(small._states))
    assert sizes[-1] < 1.1 * sizes[0]
    assert sum(map(len, small._fits.values())) <= 2 * 500


def test_letters_of_python_are_letters_of_the_pattern(codec):
    letters = "".join(c for c in map(chr, range(0x110000)) if c.isalpha())
    assert codec.pattern.findall(" " + letters) == [" " + letters]


@pytest.mark.parametrize("text", ["a\n b", "a \nb", "\x1c a", "a\x1f b c", "\u00a0 a", "a b ", " 's a", "x 's 't 'llo", "a\nb c\x85d e"])
def test_spaces_beside_other_white_space(codec, reference, text):
    for _ in range(2):
        assert codec.encode(text).tolist() == reference.encode_ordinary(text)
