"""Re-Pair shard files against the tokenizers library and exact round trips."""

import glob
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from reelrank.llm import repair_shards as rs
from reelrank.llm.common import table
from reelrank.llm.queries import QUERIES
from reelrank.session import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def plain_rows(library, rows):
    """(doc_id, start, n_tokens, crc) in ascending doc_id order, null last."""
    out, start = [], 0
    coded = [(d, library(t)) for d, t in rows]
    for d, ids in sorted(coded, key=lambda r: (r[0] is None, r[0] or 0)):
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def shard_of(docs, least=2):
    return rs.Shard(rs.pack(3, 1, list(range(len(docs))), [np.array(d, np.int64) for d in docs], least))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 4), max_size=60), max_size=8), st.integers(2, 5))
def test_round_trip_and_random_access(docs, least):
    shard = shard_of(docs, least)
    assert [d.tolist() for d in shard.documents()][:len(docs)] == docs
    rng = random.Random(1)
    for k, doc in enumerate(docs):
        assert shard.document(k).tolist() == doc
        a = rng.randint(0, len(doc))
        b = rng.randint(a, len(doc))
        assert shard.tokens(k, a, b).tolist() == doc[a:b]


def test_rules_are_pairs_with_their_lengths_and_save_space():
    rng = random.Random(5)
    phrase = [[rng.randrange(300) for _ in range(30)] for _ in range(20)]
    docs = [[i for _ in range(40) for i in rng.choice(phrase)] + [2] for _ in range(30)]
    shard = shard_of(docs, 4)
    grammar = shard.grammar
    for k, length in enumerate(grammar.lengths):
        assert len(grammar.expand(np.array([grammar.base + k]))) == length
    assert grammar.lengths.max() >= 16
    assert shard.n_symbols < 0.2 * sum(map(len, docs))
    # every rule is used, by a symbol or by a later rule
    used = np.concatenate([np.concatenate([shard.symbols(d) for d in range(len(docs))]), grammar.rules.ravel()])
    assert set(range(grammar.base, grammar.base + len(grammar.rules))) <= set(used.tolist())


def test_one_id_repeated():
    shard = shard_of([[7] * 1000, [], [7]], 2)
    assert shard.document(0).tolist() == [7] * 1000 and shard.document(1).tolist() == []
    assert shard.tokens(0, 333, 340).tolist() == [7] * 7


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=" abst1'.,!é漢ªĠ\n\t.\u00a0\u2003", max_size=80))
def test_pieces_give_the_ids_of_the_whole(text):
    encoder = test_pieces_give_the_ids_of_the_whole.encoder
    whole = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert encoder.batch([text])[0].tolist() == whole
    assert encoder.batch([text + "x <|endoftext|>y"])[0].tolist() == encoder.tokenizer.encode(
        text + "x <|endoftext|>y", add_special_tokens=False).ids
    held, rs.PIECE = rs.PIECE, 7
    try:
        assert "".join(rs.pieces_of(text)) == text
        assert not text or encoder.whole(text).tolist() == whole
    finally:
        rs.PIECE = held


with open(PATH, "rb") as _file:
    test_pieces_give_the_ids_of_the_whole.encoder = rs.Encoder(_file.read())


def test_memo_begins_anew(monkeypatch, library, sentence):
    monkeypatch.setattr(rs, "MEMO_BYTES", 2000)
    encoder = rs.Encoder(open(PATH, "rb").read())
    for k in range(6):
        texts = [sentence(k, 40), None, "", "x"]
        assert [i.tolist() + [2] for i in encoder.batch(texts)] == [library(t) for t in texts]


@pytest.mark.parametrize("hot", [False, True])
def test_rows_of_every_kind(frame, library, sentence, monkeypatch, hot):
    rows = ([(i, sentence(i, 5 + i)) for i in range(40, 0, -1)] + [(None, "null id"), (None, None), (-5, ""), (7, "again")]
            + [(9, "copy of nine")] * 30 + [(2**62, sentence(1, 4000)), (2**62 + 1, " " * 300 + "\n" * 50)])
    docs = frame([(d, t, "a", 1) for d, t in rows], "doc_id long, text string, ids string, none int")
    if hot:
        monkeypatch.setattr(rs, "HOT_ROWS", 5)
    got = rs.round_trip(docs, PATH, shard_tokens=500).collect()
    fields = [(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got]
    want = plain_rows(library, rows)
    assert sorted(fields, key=str) == sorted([(d, n, c) for d, _, n, c in want], key=str)
    # places: gapless, and in order of doc_id
    got.sort(key=lambda r: r["start"])
    assert [r["start"] for r in got] == np.cumsum([0] + [r["n_tokens"] for r in got])[:-1].tolist()
    assert [r["doc_id"] for r in got] == [d for d, *_ in want]
    assert len({(r["shard_part"], r["shard"]) for r in got}) > 5


def test_files_hold_whole_shards(spark, frame, library, sentence):
    rows = [(i, sentence(i, 60)) for i in range(50)]
    folder = rs.write_shards(frame(rows), PATH, scratch_path(spark, "shard-test"), shard_tokens=700)
    files = sorted(glob.glob(folder.removeprefix("file:") + "/part-*"))
    shards = [rs.Shard(open(f, "rb").read()) for f in files]
    assert {d: s.document(k).tolist() for s in shards for k, d in enumerate(s.doc_ids)} == {i: library(t) for i, t in rows}
    assert all(len(s.doc_ids) > 0 for s in shards)


def test_empty_table(frame):
    assert rs.round_trip(frame([]), PATH).count() == 0


def test_query_against_the_library(spark, sf_small, library):
    rows = [tuple(r) for r in table(spark, sf_small, "documents").select("doc_id", "text").collect()]
    got = QUERIES["op12_repair_shards"](spark, sf_small).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == sorted(plain_rows(library, rows))


def test_a_first_word_is_not_taken_for_a_word_behind_a_tab(library):
    encoder = rs.Encoder(open(PATH, "rb").read())
    for text in ("1 \t1", "x", "1 a \t1 b", "a \tx"):
        assert encoder.batch([text])[0].tolist() + [2] == library(text)


def test_new_words_with_line_ends_and_punctuation_do_not_go_through_the_whole_library(library):
    encoder = rs.Encoder(open(PATH, "rb").read())
    seen = []
    inner = encoder.words.library
    encoder.words.library = lambda piece: seen.append(piece) or inner(piece)
    text = "Abcé" + "".join(f" w{'abcdefgh'[k % 8] * (k + 1)}.\nN{'xyzé'[k % 4] * (k + 1)}," for k in range(40))
    assert encoder.batch([text])[0].tolist() + [2] == library(text)
    assert sorted(seen) == ["\n", ",", "."]


def test_the_older_half_of_the_memo_is_asked_before_the_library(monkeypatch, library):
    monkeypatch.setattr(rs, "MEMO_BYTES", 1000)
    encoder = rs.Encoder(open(PATH, "rb").read())
    texts = ["one two three four five six", "one seven eight 9, one.\nTwo", "two one 9, nine"]
    for text in texts * 2:
        assert encoder.batch([text])[0].tolist() + [2] == library(text)
    assert len(encoder.words.old) > 0


@pytest.mark.parametrize("text", ["a \nb", "a\n b", "a\n\nb c", "a\n", "a b\nc\n\n", "\na b", "a\r\nb c", "a b\n's c", "a\tb c\nd\te",
                                  "a b\n\u00a0c", "x\ny z", "x \n y", "a b\n,,c d\n..", "a  b"])
def test_line_ends(library, text):
    encoder = rs.Encoder(open(PATH, "rb").read())
    for _ in range(2):
        assert [i.tolist() + [2] for i in encoder.batch([text, None, "plain words", text])] == [
            library(t) for t in (text, "", "plain words", text)]


def test_rare_pairs_leave_the_grammar_as_it_is(monkeypatch):
    rng = np.random.default_rng(3)
    docs = [rng.zipf(1.2, 400).clip(max=50_000) for _ in range(40)]
    whole = rs.pack(0, 0, list(range(40)), docs, 4)
    monkeypatch.setattr(rs, "_BUCKETS", 1 << 10)
    assert rs.pack(0, 0, list(range(40)), docs, 4) == whole


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=" abst1'.,!é×漢ЗªĠ_\n\t\r\x1c\x0b. \u0085 　́😀", max_size=80))
def test_cuts_are_where_pre_tokens_begin(text):
    pre = test_pieces_give_the_ids_of_the_whole.encoder.tokenizer.pre_tokenizer
    begins = {len(text[:a].encode()) for _, (a, _) in pre.pre_tokenize_str(text)}
    cuts = np.flatnonzero(rs._cuts(np.frombuffer(text.encode(), np.uint8)))
    assert set(cuts.tolist()) <= begins


def test_cuts_in_blocks(monkeypatch):
    text = np.frombuffer("Où est,\n\u3000la\u3000 3e «rue» d'or\r\n\n — 漢字, ici?\nOui.".encode() * 9, np.uint8)
    whole = rs._cuts(text)
    for block in (5, 7, 64):
        monkeypatch.setattr(rs, "_BLOCK", block)
        assert (rs._cuts(text) == whole).all()


def test_a_word_is_kept_once_whatever_stands_behind_it(library):
    encoder = rs.Encoder(open(PATH, "rb").read())
    text = "one two, one. two! (one) one\nTwo,\none two"
    assert encoder.batch([text])[0].tolist() + [2] == library(text)
    assert {p for p in encoder.words if p.strip(" ").isalpha()} == {"one", " two", " one", "Two"}


def test_long_pieces_are_not_kept(library):
    encoder = rs.Encoder(open(PATH, "rb").read())
    text = "x" * 6000 + " " + "é7" * 5000 + " end"
    for _ in range(2):
        assert encoder.batch([text])[0].tolist() + [2] == library(text)
    assert max(map(len, encoder.words)) <= rs.LONGEST


def test_slices_of_columns_and_texts_beyond_one_group(monkeypatch, library, sentence):
    monkeypatch.setattr(rs, "CHARS", 200)
    encoder = rs.Encoder(open(PATH, "rb").read())
    texts = ["skipped", None, "", sentence(1, 90), "a <|endoftext|> b", sentence(2, 9), "é,", "", sentence(3, 30), "last"]
    for kind in (pa.string(), pa.large_string()):
        found = encoder.column(pa.array(texts, kind).slice(1, 8), 2)
        assert [i.tolist() for i in found] == [library(t) for t in texts[1:9]]


@pytest.mark.parametrize("width", [1, 5, 8, 13, 16, 17, 31, 32])
def test_numbers_of_any_width(width):
    values = np.random.default_rng(width).integers(0, 1 << width, 1000)
    data = memoryview(rs._packed(values, width))
    for a, b in ((0, 1000), (0, 1), (3, 3), (7, 990), (999, 1000)):
        assert rs._unpacked(data, width, a, b).tolist() == values[a:b].tolist()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=200))
def test_rules_expanded_once_give_the_same_ids(ids):
    grammar, symbols, _ = rs.compress(np.array(ids, np.int64), np.array([len(ids)]), 2, 1000)
    assert grammar.expand_many(symbols).tolist() == grammar.expand(symbols).tolist() == ids


def test_checksums_come_without_the_ids(spark, frame, library, sentence):
    rows = [(i, sentence(i, 40)) for i in range(30)] + [(None, "x")]
    folder = rs.write_shards(frame(rows), PATH, scratch_path(spark, "shard-test"), shard_tokens=300)
    want = {(d, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, i in ((d, library(t)) for d, t in rows)}
    plain = rs.read_shards(spark, folder).collect()
    short = rs.read_shards(spark, folder, with_ids=False)
    assert "ids" not in short.columns
    assert {(r["doc_id"], r["n_tokens"], zlib.crc32(bytes(r["ids"]))) for r in plain} == want
    assert {(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in short.collect()} == want
