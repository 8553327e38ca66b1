"""Token ids in shard files compressed by Re-Pair grammars.

Texts are tokenised once, dealt in ascending doc_id order into shards of about
``shard_tokens`` ids, and each shard is written as one file of its own format.
Within a shard, adjacent pairs of ids that are frequent are replaced by a
nonterminal, then pairs of those, and so on until a round gains next to nothing (Re-Pair).
No pair crosses a document's end, so a document stays a stretch of symbols. The
file holds the rules, the length each rule expands to, and for each document
its doc_id, its number of ids and its place among the symbols: any document, or any
stretch of its ids, is decoded without the rest.

Replacing one pair at a time would need as many passes as there are rules. A
round here replaces all pairs that are frequent when it begins; where two
occurrences overlap, the more frequent pair wins.

File: magic, header (:data:`HEADER`), rules (left, right), expansion lengths, first
symbol of each round's rules, doc_ids, number of ids and of symbols of each
document, symbols. All numbers little-endian; symbols take as many bits as the largest needs.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import attrgetter
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reelrank.llm.common import kept, materialise, partitions
from reelrank.session import scratch_path

END_ID = 2
SHARD_TOKENS = 1 << 20
#: A pair is replaced where it occurs at least so often: a rule costs three numbers.
MIN_PAIRS = 8
#: A shard is done when a round would replace fewer than one of so many symbols.
WORTH = 50
#: Bytes of a text that the tokenizer gets at a time, cut at a space between
#: other characters, where no token crosses.
PIECE = 1 << 16
#: Rows and characters that are encoded together, and bytes of a worker's memo: of its two halves the older goes when the other is full.
ROWS, CHARS, MEMO_BYTES = 1024, 4 << 20, 160 << 20
#: Characters of a piece beyond which its ids are not remembered.
LONGEST = 4096
#: Rows equal in doc_id and text beyond which they may lie in several ranges.
HOT_ROWS = 10_000

_MAGIC = b"RPR1"
#: Buckets of pairs, and the odd number that deals them out.
_BUCKETS, _ODD = 1 << 18, np.int64(0x1E3779B97F4A7C15)
HEADER = np.dtype([("part", "<u4"), ("shard", "<u4"), ("docs", "<u4"), ("rules", "<u4"), ("rounds", "<u4"),
                   ("base", "<u4"), ("symbols", "<u8"), ("tokens", "<u8"), ("width", "<u4"), ("flags", "<u4")])


# --- grammar ------------------------------------------------------------------

@dataclass
class Grammar:
    """Rules of a shard: symbol ``base + k`` stands for the pair ``rules[k]``."""

    base: int
    rules: np.ndarray      # (rules, 2)
    lengths: np.ndarray    # ids that each rule expands to
    rounds: np.ndarray     # number of the first rule of each round

    def sizes(self, symbols: np.ndarray) -> np.ndarray:
        """Ids that each symbol expands to."""
        out = np.ones(len(symbols), np.int64)
        long = symbols >= self.base
        out[long] = self.lengths[symbols[long] - self.base]
        return out

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids of a stretch of symbols; a round's rules hold symbols of earlier rounds only."""
        for first in self.rounds[::-1]:
            long = symbols >= self.base + first
            if not long.any():
                continue
            wide = np.repeat(symbols, 1 + long)
            at = np.flatnonzero(long) + np.arange(long.sum())
            wide[at], wide[at + 1] = self.rules[symbols[long] - self.base].T
            symbols = wide
        return symbols

    def expand_many(self, symbols: np.ndarray) -> np.ndarray:
        """As :meth:`expand`, but each rule is expanded once and its ids are
        copied, unless there are fewer symbols than ids to keep for that."""
        if max(self.base, self.lengths.sum()) > len(symbols):
            return self.expand(symbols)
        ids = np.concatenate([np.arange(self.base), self.expand(np.arange(self.base, self.base + len(self.rules)))])
        sizes = np.concatenate([np.ones(self.base, np.int64), self.lengths])
        wide = sizes[symbols]
        shift = (np.cumsum(sizes) - sizes)[symbols] - (np.cumsum(wide) - wide)
        return ids[np.repeat(shift, wide) + np.arange(wide.sum())]


def _pairs(seq: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The pairs that begin at ``at``, each as one number."""
    if len(at) < len(seq) >> 3:
        return seq[at].astype(np.int64) << 32 | seq[at + 1]
    pair = seq[:-1].astype(np.int64)
    pair <<= 32
    pair |= seq[1:]
    return pair[at]


def _frequent(seq: np.ndarray, at: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the pairs that begin at ``at``: places and pair numbers of those that
    occur at least ``least`` times, and the counts by number."""
    pair = _pairs(seq, at)
    if len(at) > _BUCKETS >> 4:  # first go those that are rare even with others in their bucket
        bucket = (pair * _ODD >> 40) & _BUCKETS - 1
        keep = np.flatnonzero((np.bincount(bucket, minlength=_BUCKETS) >= least)[bucket])
        at, pair = at[keep], pair[keep]  # by places: masks without order cost a processor more
    number = pa.array(pair).dictionary_encode().indices.to_numpy()  # in order of appearance
    seen = np.bincount(number, minlength=1)
    keep = np.flatnonzero((seen >= least)[number])
    return at[keep], number[keep], seen


def _chosen(at: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Occurrences to replace: of overlapping ones the one of least ``order``;
    in a stretch of equal ones every second, from the left."""
    touch = np.diff(at) == 1
    win = np.ones(len(at), bool)
    win[1:] &= ~touch | (order[1:] <= order[:-1])
    win[:-1] &= ~touch | (order[:-1] <= order[1:])
    # equal winners side by side: those behind the first of their stretch
    behind = np.flatnonzero(touch & win[:-1] & win[1:]) + 1
    number = np.arange(len(behind))
    start = np.maximum.accumulate(np.where(np.diff(behind, prepend=-1) == 1, 0, number))
    win[behind[(number - start) % 2 == 0]] = False
    return win


def compress(ids: np.ndarray, ends: np.ndarray, least: int = MIN_PAIRS,
             worth: int = WORTH) -> tuple[Grammar, np.ndarray, np.ndarray]:
    """ids and the place after each document's last id -> grammar, symbols, and
    the place after each document's last symbol.

    Counts of pairs without a new nonterminal only fall, so after the first
    round a round counts the pairs that hold one of the round before.
    """
    base = int(ids.max()) + 1 if len(ids) else 0
    seq = ids.astype(np.int32 if base + len(ids) < 1 << 31 else np.int64)
    last = np.zeros(len(seq), bool)
    last[ends[ends > 0] - 1] = True
    rules, lengths, rounds, total = [np.zeros((0, 2), np.int64)], [np.zeros(0, np.int64)], [], 0
    size = np.ones(base, np.int64)  # ids that each symbol expands to
    often = np.bincount(seq, minlength=1) >= least
    at = np.flatnonzero(~last[:-1] & often[seq[:-1]] & often[seq[1:]])
    while len(at):
        at, number, seen = _frequent(seq, at, least)
        # most frequent first; pairs are numbered in order of appearance
        rank = np.empty(len(seen), np.int32)
        rank[np.argsort(-seen, kind="stable")] = np.arange(len(seen))
        take = _chosen(at, rank[number])
        used = np.bincount(number[np.flatnonzero(take)], minlength=len(seen))
        take &= (used >= least)[number]  # not a pair that lost too many places to others
        if take.sum() * worth < len(seq):
            break
        take = np.flatnonzero(take)
        at, number = at[take], number[take]
        new = np.flatnonzero(used >= least)
        first = np.zeros(len(seen), np.int64)
        first[number] = at  # any place of the pair
        pairs = np.stack([seq[first[new]], seq[first[new] + 1]], axis=1)
        rounds.append(total)
        rules.append(pairs)
        lengths.append(size[pairs].sum(axis=1))
        size = np.concatenate([size, lengths[-1]])
        symbol = np.zeros(len(seen), seq.dtype)
        symbol[new] = base + total + np.arange(len(new))
        seq[at] = symbol[number]
        last[at] = last[at + 1]
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        keep = np.flatnonzero(keep)
        seq, last = seq[keep], last[keep]
        at -= np.arange(len(at))  # one symbol fewer for each replaced pair before
        total += len(new)
        beside = np.zeros(len(seq), bool)
        beside[at] = True
        beside[:-1] |= beside[1:]  # a mask of the places at and before a new symbol
        at = np.flatnonzero(beside[:-1] & ~last[:-1])
    out = np.zeros(len(ends), np.int64)
    out[np.diff(ends, prepend=0) > 0] = np.flatnonzero(last) + 1
    grammar = Grammar(base, np.concatenate(rules), np.concatenate(lengths), np.array(rounds, np.int64))
    return grammar, seq, np.maximum.accumulate(out) if len(out) else out


# --- file format --------------------------------------------------------------

def _packed(values: np.ndarray, width: int) -> bytes:
    """``width`` bits of each number, lowest first."""
    if width in (8, 16, 32):
        return values.astype(f"<u{width // 8}").tobytes()
    out = []
    for at in range(0, len(values), 1 << 18):  # a multiple of eight numbers
        few = values[at:at + (1 << 18)].astype("<u4").view(np.uint8).reshape(-1, 4)
        out.append(np.packbits(np.unpackbits(few, axis=1, bitorder="little")[:, :width], bitorder="little").tobytes())
    return b"".join(out)


def _unpacked(data: memoryview, width: int, first: int, last: int) -> np.ndarray:
    """Numbers ``first`` to ``last`` - 1 of :func:`_packed`; no other byte is read."""
    if first >= last:
        return np.zeros(0, np.int64)
    at = first * width // 8
    data = np.frombuffer(data[at:-(-last * width // 8)], np.uint8)
    if width in (8, 16, 32):
        return data.view(f"<u{width // 8}").astype(np.int64)
    # each number from the eight bytes that begin with its first one
    eight = np.ndarray(len(data), "<u8", np.append(data, np.zeros(7, np.uint8)), strides=(1,))
    bit = np.arange(last - first) * width + (first * width - 8 * at)
    return (eight[bit >> 3] >> (bit & 7).astype(np.uint64)).astype(np.int64) & (1 << width) - 1


def pack(part: int, shard: int, doc_ids: list[int | None], docs: list[np.ndarray], least: int = MIN_PAIRS) -> bytes:
    """One shard file: documents (ids with their end id) in order."""
    n_ids = np.array([len(d) for d in docs], np.int64)
    ids = np.concatenate(docs) if docs else np.zeros(0, np.int64)
    grammar, symbols, ends = compress(ids, np.cumsum(n_ids), least)
    top = grammar.base + len(grammar.rules)
    width = max(top - 1, 1).bit_length()
    header = np.zeros(1, HEADER)
    header[0] = (part, shard, len(docs), len(grammar.rules), len(grammar.rounds), grammar.base,
                 len(symbols), len(ids), width, 0)
    none = np.array([d is None for d in doc_ids], np.uint8)
    return b"".join([
        _MAGIC, header.tobytes(), grammar.rules.astype("<u4").tobytes(), grammar.lengths.astype("<u8").tobytes(),
        grammar.rounds.astype("<u4").tobytes(), none.tobytes(),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), n_ids.astype("<u8").tobytes(),
        np.diff(ends, prepend=0).astype("<u8").tobytes(), _packed(symbols, width)])


class Shard:
    """A shard file opened for random access."""

    def __init__(self, data: bytes):
        view, at = memoryview(data), len(_MAGIC) + HEADER.itemsize
        if bytes(view[:len(_MAGIC)]) != _MAGIC:
            raise ValueError("not a shard file")
        self.header = h = np.frombuffer(view[len(_MAGIC):at], HEADER)[0]
        n_docs, n_rules = int(h["docs"]), int(h["rules"])

        def read(kind: str, n: int) -> np.ndarray:
            nonlocal at
            begin, at = at, at + n * np.dtype(kind).itemsize
            return np.frombuffer(view[begin:at], kind).astype(np.int64)

        rules = read("<u4", 2 * n_rules).reshape(-1, 2)
        self.grammar = Grammar(int(h["base"]), rules, read("<u8", n_rules), read("<u4", int(h["rounds"])))
        none = read("u1", n_docs)
        self.doc_ids = [None if gone else d for d, gone in zip(read("<i8", n_docs).tolist(), none)]
        self.n_ids = read("<u8", n_docs)
        self.ends = np.cumsum(read("<u8", n_docs))
        self.n_symbols, self._width, self._bits = int(h["symbols"]), int(h["width"]), view[at:]

    def symbols(self, doc: int) -> np.ndarray:
        return _unpacked(self._bits, self._width, int(self.ends[doc - 1]) if doc else 0, int(self.ends[doc]))

    def documents(self) -> list[np.ndarray]:
        """All documents' ids, expanded at once."""
        symbols = _unpacked(self._bits, self._width, 0, self.n_symbols)
        return np.split(self.grammar.expand_many(symbols), np.cumsum(self.n_ids)[:-1])

    def document(self, doc: int) -> np.ndarray:
        """All ids of document number ``doc``, its end id included."""
        return self.grammar.expand(self.symbols(doc))

    def tokens(self, doc: int, begin: int, end: int) -> np.ndarray:
        """Ids ``begin`` to ``end`` - 1 of a document: only the symbols that cover them are expanded."""
        symbols = self.symbols(doc)
        ends = np.cumsum(self.grammar.sizes(symbols))
        a = int(np.searchsorted(ends, begin, "right"))
        b = int(np.searchsorted(ends, end, "left")) + 1
        skipped = int(ends[a - 1]) if a else 0
        return self.grammar.expand(symbols[a:b])[begin - skipped:max(end, begin) - skipped]


# --- Spark --------------------------------------------------------------------

def pieces_of(text: str) -> list[str]:
    """A long text in pieces of about :data:`PIECE` characters, each but the
    first beginning with a single space between two other characters: byte-level
    pre-tokens begin there, so the pieces' ids are the text's ids."""
    out, begin = [], 0
    while len(text) - begin > PIECE:
        cut = begin + PIECE
        while (cut := text.find(" ", cut)) > 0:
            if cut + 1 < len(text) and not text[cut - 1].isspace() and not text[cut + 1].isspace():
                break
            cut += 1
        if cut < 0:
            break
        out.append(text[begin:cut])
        begin = cut
    out.append(text[begin:])
    return out


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies:
    printable ones for themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(other)}


_BYTE_LETTERS = _byte_letters()
_PACK = [struct.Struct(f"<{n}I").pack for n in range(32)]
_SPELT = np.array([ord(_BYTE_LETTERS[b]) for b in range(256)], "<u2")


def _kinds() -> bytes:
    """Bits of each byte of UTF-8, see :func:`_cuts`."""
    kinds = bytearray(256)
    for b in range(256):
        letter = b < 128 and chr(b).isalpha()
        kinds[b] = (_LETTER * letter | _BARE * (b < 128 and not letter) | _WHITE * (b == 32 or 9 <= b <= 13)
                    | _SOLID * (33 <= b <= 126 or b >= 0xC3 and not 0xE1 <= b <= 0xE3)
                    | _SHORT * (b == 0xC2) | _WIDE * (0xE1 <= b <= 0xE3)
                    | _LETTERS * (b in (0xC3, 0xD0, 0xD1)) | _TAIL * (0x80 <= b <= 0xBF))
    return bytes(kinds)


#: A letter; another character of one byte; white space; begins a character that is no white space;
#: begins one of two or three bytes that may be white space; begins a letter
#: (unless the byte behind it is 0x97 or 0xB7, signs of Latin-1); a byte behind the first.
_LETTER, _BARE, _WHITE, _SOLID, _SHORT, _WIDE, _LETTERS, _TAIL = (1 << k for k in range(8))
_KINDS, _BLOCK = _kinds(), 1 << 18


def _cuts(text: np.ndarray) -> np.ndarray:
    """Marks bytes of UTF-8 before which a byte-level pre-token begins whatever
    is around: what is no letter behind a letter, white space behind another character, and
    another character behind a line end that is white space by itself.

    White space and letters beyond ASCII count only where the first byte tells; the others give fewer cuts.
    """
    if len(text) > _BLOCK:  # a block fits the processor's cache; four bytes before a place decide about it
        return np.concatenate([_cuts(text[:_BLOCK]), *(
            _cuts(text[at - 4:at - 4 + _BLOCK])[4:] for at in range(_BLOCK, len(text), _BLOCK - 4))])
    kinds = np.frombuffer(text.tobytes().translate(_KINDS), np.uint8)
    one, two = np.zeros_like(kinds), np.zeros_like(kinds)  # the kinds of the bytes before
    one[1:], two[2:] = kinds[:-1], kinds[:-2]
    tail = (kinds & _TAIL) > 0
    letter = (kinds & _LETTER > 0) | tail & (one & _LETTERS > 0) & (text != 0x97) & (text != 0xB7)
    solid = tail & (one & _SHORT == 0) & (two & _WIDE == 0) | ~tail & (kinds & _SOLID > 0) & (text < 128)
    cuts = np.zeros(len(text), bool)
    cuts[1:] = letter[:-1] & (kinds[1:] & _BARE > 0) | solid[:-1] & (kinds[1:] & _WHITE > 0)
    cuts[2:] |= solid[:-2] & (text[1:-1] == 10) & (kinds[2:] & _SOLID > 0)
    return cuts


class _Words(dict):
    """Packed ids of the pieces met; each begins and ends where pre-tokens do.
    Letters with punctuation behind them are two pre-tokens."""

    def __init__(self, letters: Callable[[list[str]], list[bytes]], library: Callable[[str], np.ndarray],
                 old: dict[str, bytes]) -> None:
        super().__init__()
        self.letters, self.library, self.old, self.held = letters, library, old, 0

    def look_up(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece; letters not met before are spelt all at once."""
        found = [*map(self.get, pieces)]
        new = [k for k, ids in enumerate(found) if ids is None]
        words = [p for k in new if (p := pieces[k]) not in self.old and _is_word(p)]
        coded = dict(zip(words, self.letters(words)))
        for k in new:
            found[k] = coded.get(pieces[k])
            if found[k] is None:
                found[k] = self[pieces[k]]
        self._keep({p: ids for p, ids in coded.items() if len(p) <= LONGEST})
        return found

    def _keep(self, coded: dict[str, bytes]) -> None:
        self.update(coded)
        self.held += 130 * len(coded) + sum(map(len, coded)) + sum(map(len, coded.values()))

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            word = piece.rstrip(punctuation)
            if not _is_word(word):
                ids = self.library(piece).tobytes()
            elif len(word) == len(piece):
                ids = self.letters([piece])[0]
            else:
                ids = self[word] + self[piece[len(word):]]
        if len(piece) <= LONGEST:
            self._keep({piece: ids})
        return ids


def _is_word(piece: str) -> bool:
    """Letters, with a space before them or none: one pre-token."""
    return (piece[1:] if piece[:1] == " " else piece).isalpha()


class Encoder:
    """The tokenizers library behind a memo of words.

    Texts are cut where byte-level pre-tokens begin whatever is around (:func:`_cuts`),
    mostly before a word's space and its punctuation. The pieces are looked up, each once
    for all texts at hand; those not met before go to the library: letters
    to its BPE model, others as they are. Texts that hold a
    special token and vocabularies of another kind go to the library as they are.
    """

    def __init__(self, data: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_buffer(data)
        said = json.loads(data)
        pre = said.get("pre_tokenizer") or {}
        self.by_words = (pre.get("type"), pre.get("use_regex", True), pre.get("add_prefix_space"), said["model"]["type"],
                         said.get("normalizer")) == ("ByteLevel", True, False, "BPE", None)
        self.special = [t["content"] for t in said.get("added_tokens", ())]
        self._merge = self.tokenizer.model.tokenize
        self.words = _Words(self._letters, self._library, {})

    def _library(self, text: str) -> np.ndarray:
        return np.concatenate([np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(
            pieces_of(text), add_special_tokens=False)])

    def _letters(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces of letters, with a space before them or none: each is one pre-token,
        which goes to the library's BPE model by itself, spelt as the vocabulary does, a character for each byte."""
        joined = np.frombuffer("\n".join(pieces).encode(), np.uint8)
        out, merge, number = [], self._merge, attrgetter("id")
        for spelt in _SPELT[joined].tobytes().decode("utf-16-le").split(_BYTE_LETTERS[10]) if pieces else ():
            ids = [*map(number, merge(spelt))]
            out.append((_PACK[len(ids)] if len(ids) < len(_PACK) else struct.Struct(f"<{len(ids)}I").pack)(*ids))
        return out

    def whole(self, text: str) -> np.ndarray:
        """Ids of a text, long ones in several calls."""
        return np.concatenate([self._library(p) for p in pieces_of(text)])

    def batch(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text; none for null and empty ones."""
        return self.column(pa.array(texts, pa.large_string()))

    def column(self, texts: pa.Array, end: int | None = None) -> list[np.ndarray]:
        """Ids of each text, and ``end`` behind them. Texts of about :data:`CHARS` bytes go together."""
        texts = texts.cast(pa.large_string()).fill_null("")
        last = np.array([] if end is None else [end], "<u4")
        plain = pa.repeat(self.by_words, len(texts))
        for token in self.special:
            plain = pc.and_not(plain, pc.match_substring(texts, token))
        few = iter(self._words_of(texts if pc.all(plain, min_count=0).as_py() else texts.filter(plain), last.tobytes()))
        return [next(few) if words else np.concatenate([self.whole(texts[k].as_py()), last])
                for k, words in enumerate(plain.to_pylist())]

    def _words_of(self, texts: pa.Array, end: bytes) -> Iterator[np.ndarray]:
        """Ids of each text by its pieces, and ``end``."""
        if not len(texts):
            return
        _, places, data = texts.buffers()
        places = np.frombuffer(places, np.int64)[texts.offset:][:len(texts) + 1]
        group = (places[:-1] - places[0]) // CHARS
        for first, behind in itertools.pairwise([0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]):
            at = places[first:behind + 1]
            yield from self._together(np.frombuffer(data or b"", np.uint8)[at[0]:at[-1]], at - at[0], end)

    def _together(self, text: np.ndarray, places: np.ndarray, end: bytes) -> list[np.ndarray]:
        """Ids of texts that lie one behind the other in ``text``, from and to ``places``."""
        if self.words.held > MEMO_BYTES // 2:
            self.words.old = {}
            self.words = _Words(self._letters, self._library, self.words)
        cuts = _cuts(text)
        cuts[places[:-1][np.diff(places) > 0]] = True
        begins = np.append(np.flatnonzero(cuts), len(text))
        coded = pa.LargeStringArray.from_buffers(
            len(begins) - 1, pa.py_buffer(begins), pa.py_buffer(text)).dictionary_encode()
        met = self.words.look_up(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        ends = np.searchsorted(begins, places[1:])  # pieces of this text and all before
        at = np.insert(coded.indices.to_numpy(), ends, len(met))
        found = pa.array([*met, end], pa.large_binary()).take(pa.array(at))
        _, after, ids = found.buffers()
        after = np.frombuffer(after, np.int64)[ends + np.arange(1, len(ends) + 1)] // 4
        return np.split(np.frombuffer(ids or b"", "<u4", after[-1]), after[:-1])


def _encoder(data: bytes) -> Encoder:
    """One encoder per Python worker and vocabulary, see :func:`kept`."""
    return kept(("repair", hashlib.sha256(data).digest()), lambda: Encoder(data))


def _ordered(docs: DataFrame) -> DataFrame:
    """doc_id, text: in ascending order of doc_id (null last), rows of one
    doc_id by a hash of their text, range-partitioned and sorted.

    More than :data:`HOT_ROWS` rows equal in both would be one range, so they
    are numbered to be split. Their copy is written first: numbers must be the same if a
    task runs again.
    """
    key = ["none", "id", "h"]
    rows = docs.select(
        F.col("doc_id").isNull().alias("none"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
        F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text")).withColumn("copy", F.lit(0).cast("long"))
    # doc_ids alone first: no text is read for them
    ids = materialise(rows.groupBy("none", "id").count().filter(F.col("count") > HOT_ROWS).select("none", "id"), "hot-ids")
    if not ids.isEmpty():
        hot = materialise(rows.join(ids, ["none", "id"], "left_semi").groupBy(key).count().filter(
            F.col("count") > HOT_ROWS).select(key), "hot-rows")
        copies = materialise(rows.join(hot, key, "left_semi").drop("copy"), "hot-copies")
        rows = rows.join(hot, key, "left_anti").unionByName(
            copies.withColumn("copy", F.monotonically_increasing_id()))
    order = [*key, "copy"]
    ranged = rows.repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
    return ranged.select(F.when(~F.col("none"), F.col("id")).alias("doc_id"), "text")


def write_shards(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID,
                 shard_tokens: int = SHARD_TOKENS, least: int = MIN_PAIRS) -> str:
    """Write the ids of all texts as shard files below ``folder``, in ascending
    doc_id order (null last; rows of one doc_id by a hash of their text). Null
    and empty texts have the end id only.

    A document is never cut: one longer than ``shard_tokens`` is a shard of its
    own. Files are numbered by part and shard; Spark's commit protocol keeps one
    file of each shard however often a task ran. Empty tables give no file.
    """
    with open(tokenizer, "rb") as file:  # a vocabulary file of a few megabytes
        vocabulary = docs.sparkSession.sparkContext.broadcast(file.read())

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary.value)
        part, number, held, found, names = TaskContext.get().partitionId(), 0, 0, [], []
        for batch in batches:
            for first in range(0, len(batch), ROWS):
                some = batch.slice(first, ROWS)
                for doc_id, ids in zip(some.column(0).to_pylist(), encoder.column(some.column(1), end_id)):
                    found.append(ids)
                    names.append(doc_id)
                    held += len(ids)
                    if held >= shard_tokens:
                        yield pa.record_batch({"file": [pack(part, number, names, found, least)]})
                        number, held, found, names = number + 1, 0, [], []
        if found:
            yield pa.record_batch({"file": [pack(part, number, names, found, least)]})

    files = _ordered(docs).mapInArrow(shards, "file binary")
    # The text writer puts out a string's bytes as they are and a line end, which
    # the format ignores: one raw file for each row, on any file system of Spark.
    files.select(F.col("file").cast("string")).write.option("maxRecordsPerFile", 1).text(folder)
    return folder


def read_shards(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """Every document of the shard files: part, shard, doc (number in its
    shard), doc_id, before (ids of the shard's earlier documents), n_tokens, ids
    (binary; ids_crc32, their checksum, without ``with_ids``), n_symbols."""
    name, kind = ("ids", "binary") if with_ids else ("ids_crc32", "long")
    schema = f"part int, shard int, doc int, doc_id long, before long, n_tokens long, {name} {kind}, n_symbols long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                shard = Shard(data.as_buffer())
                n, docs = len(shard.doc_ids), shard.documents()
                yield pa.record_batch({
                    "part": pa.repeat(pa.scalar(int(shard.header["part"]), pa.int32()), n),
                    "shard": pa.repeat(pa.scalar(int(shard.header["shard"]), pa.int32()), n),
                    "doc": np.arange(n, dtype=np.int32), "doc_id": pa.array(shard.doc_ids, pa.int64()),
                    "before": np.cumsum(shard.n_ids) - shard.n_ids, "n_tokens": shard.n_ids,
                    name: pa.array([d.astype("<u4").tobytes() for d in docs], pa.binary()) if with_ids
                    else pa.array(map(crc32, docs), pa.int64()),
                    "n_symbols": np.diff(shard.ends, prepend=0)})

    files = spark.read.format("binaryFile").load(folder).filter("length > 0").select("content")
    return files.mapInArrow(read, schema)


def token_table(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32,
    shard_part, shard, n_symbols, read from the files.

    Only one number for each shard decides where it starts, one for each part
    where the part does; ids are not moved.
    """
    docs = materialise(read_shards(spark, folder, with_ids=False), "read-tokens")
    shards = docs.groupBy("part", "shard").agg(F.sum("n_tokens").alias("n"))
    parts = shards.groupBy("part").agg(F.sum("n").alias("n"))
    # one row for each part: a running total in one task by design
    offset = parts.select("part", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("part_start"))
    within = shards.select("part", "shard", F.coalesce(F.sum("n").over(Window.partitionBy("part").orderBy(
        "shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("shard_start"))
    starts = within.join(offset, "part").select("part", "shard", (F.col("part_start") + F.col("shard_start")).alias("first"))
    return docs.join(starts, ["part", "shard"]).select(
        "doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32",
        F.col("part").alias("shard_part"), "shard", "n_symbols")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS,
               least: int = MIN_PAIRS) -> DataFrame:
    """Write ``docs`` as shards below the shared folder and read them back: one
    row for each row of ``docs`` (see :func:`token_table`). Other columns are not read."""
    folder = write_shards(docs, tokenizer, scratch_path(docs.sparkSession, "token-shards"), end_id, shard_tokens, least)
    return token_table(docs.sparkSession, folder)


def crc32(ids: np.ndarray) -> int:
    """Checksum of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
