"""Byte-level BPE as a lazily determinised finite-state transducer.

The merge list is compiled into one relation: token u may follow token t when
merging the bytes of both alone gives back exactly (t, u). A sequence of tokens
is the BPE result if and only if all its neighbours are in that relation, so
encoding is a walk of a transducer over bytes that may be reading several tokens
at a time, begun at different places. It is determinised as it is met: a state
is the set of trie nodes of the tokens that may be being read, which are the
suffixes of the longest, so there are no more states than nodes, however many
words are read. States and arrows are made when first met and kept in a table of
bounded size; beyond it steps are made without keeping them. The BPE result
of what is before a place is unique, so of the tokens that may end there exactly
one follows the token before it; these, read from the end, are the result.

Decoding streams: token bytes pass through a UTF-8 state machine that holds
back at most three bytes of an unfinished character.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.llm.common import kept

#: States of an automaton that are kept, and entries of half a memo: together at most about
#: 0.3 GB in a Python worker. :data:`SMALL` takes about 0.05 GB with the vocabulary.
STATES, ENTRIES = 500_000, 300_000
SMALL = (50_000, 40_000)
#: Characters of the keys of half a memo.
KEY_LIMIT = 8 << 20


def load_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks from the lines (base64 token, rank) of a vocabulary file."""
    return {base64.b64decode(t): int(r) for t, r in map(bytes.split, data.splitlines()) if t}


class _Memo(dict):
    """Results of a function of the key. When full, the entries become the older
    half, from which those asked for again come back, and the half before goes."""

    def __init__(self, make, entries: int):
        super().__init__()
        self.make, self.entries, self.old, self.held = make, entries, {}, 0

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self.held += len(key)
        if len(self) >= self.entries or self.held > KEY_LIMIT:
            self.old, self.held = dict(self), 0
            self.clear()
        self[key] = value
        return value


class _Before(dict):
    """Whether a token may follow each of the tokens asked for."""

    __slots__ = ("ask", "token")

    def __init__(self, ask: Callable[[int, int], bool], token: int):
        self.ask, self.token = ask, token

    def __missing__(self, before: int) -> bool:
        answer = self[before] = self.ask(before, self.token)
        return answer


class Transducer:
    """Encodes one pre-token (bytes) at a time."""

    def __init__(self, ranks: dict[bytes, int], states: int = STATES, entries: int = ENTRIES):
        self.ranks, self.states = ranks, states
        self.token = {i: t for t, i in ranks.items()}
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"not a byte-level vocabulary: {len(missing)} bytes have no token")
        self.child: dict[int, int] = {}
        self.at: list[int] = [-1]  # the token that a trie node spells, or -1
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                nxt = self.child.get(node << 8 | byte)
                if nxt is None:
                    nxt = self.child[node << 8 | byte] = len(self.at)
                    self.at.append(-1)
                node = nxt
            self.at[node] = rank
        # Of each token once asked for, at most the vocabulary: the two tokens whose
        # merge makes it (None for a byte), and whether its bytes merge to it.
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._whole: dict[int, bool] = {}
        self._fits: dict[int, _Before] = {}
        self._asked, self.entries = 0, entries
        self._begin()

    def merge(self, data: bytes, until: int = 1) -> list[int]:
        """Merges of lowest rank first, until none is left or ``until`` parts are."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > until:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def _split(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; None for a byte."""
        data = self.token[token]
        halves = self._halves[token] = tuple(self.merge(data, 2)) if len(data) > 1 else None
        return halves

    def _is_whole(self, token: int) -> bool:
        """Whether the bytes of ``token`` merge to it alone."""
        whole = self._whole[token] = len(self.merge(self.token[token])) == 1
        return whole

    def _may_follow(self, left: int, right: int) -> bool:
        """:meth:`_follows`, whose answers are kept; when they are full, all go."""
        self._asked += 1
        if self._asked > 2 * self.entries:
            self._asked = 1
            for known in self._fits.values():
                known.clear()
        return self._follows(left, right)

    def _follows(self, left: int, right: int) -> bool:
        """Whether no merge ever crosses the border of two tokens.

        Undoes the merges along the border, latest first. A crossing merge
        happens if it ranks before the merge that took away its left part, or
        not after the one that took away its right part (leftmost goes first).
        """
        left_ends = right_ends = 1 << 60
        token, ranks, halves = self.token, self.ranks, self._halves
        while True:
            crossing = ranks.get(token[left] + token[right])
            if crossing is not None and crossing < left_ends and crossing <= right_ends:
                return False
            l_parts = halves[left] if left in halves else self._split(left)
            r_parts = halves[right] if right in halves else self._split(right)
            if r_parts is None:
                if l_parts is None:
                    return True
                left_ends, left = left, l_parts[1]
            elif l_parts is not None and left > right:
                left_ends, left = left, l_parts[1]
            else:
                right_ends, right = right, r_parts[0]

    def _step(self, live: tuple[int, ...], byte: int) -> tuple[int, ...]:
        """The live nodes after ``byte``, the longest first."""
        child = self.child
        longer = [child[node << 8 | byte] for node in live if node << 8 | byte in child]
        return (*longer, child[byte])

    def _state(self, live: tuple[int, ...]) -> tuple:
        """A state: its arrows so far; the tokens that may end here but for the
        shortest, with their sizes and what they follow; the shortest; and the
        live nodes. The nodes are the suffixes of the first one, which thereby
        names the state."""
        ends, at, whole = [], self.at, self._whole
        for node in live:
            token = at[node]
            if token >= 0 and (whole[token] if token in whole else self._is_whole(token)):
                known = self._fits.get(token)
                if known is None:
                    known = self._fits[token] = _Before(self._may_follow, token)
                ends.append((token, len(self.token[token]), known))
        return {}, tuple(ends[:-1]), ends[-1][0] if ends else -1, live

    def _begin(self) -> None:
        """An automaton that knows its start state only."""
        self._unkept = 0
        self._states = [self._state(())]
        self._number: dict[int, int] = {}

    def _arrow(self, arrows: dict[int, tuple], live: tuple[int, ...], byte: int) -> tuple:
        """The state after ``byte``; a full automaton does not keep a new one."""
        live = self._step(live, byte)
        number = self._number.get(live[0])
        if number is None:
            after = self._state(live)
            if len(self._states) >= self.states:
                self._unkept += 1
                return after
            number = self._number[live[0]] = len(self._states)
            self._states.append(after)
        after = arrows[byte] = self._states[number]
        return after

    def walk(self, data: bytes) -> list[int]:
        """Tokens of one pre-token. Of the tokens that may end at a byte exactly
        one follows the last token of what is before it: the shortest if none
        of the others does. A full automaton is begun anew when most steps fall outside."""
        if self._unkept > 50 * self.states:
            self._begin()
        arrows, _, _, live = self._states[0]
        last = [-1]
        for at, byte in enumerate(data, 1):
            try:
                arrows, longer, token, live = arrows[byte]
            except KeyError:
                arrows, longer, token, live = self._arrow(arrows, live, byte)
            for closed, size, follows in longer:
                if size == at or follows[last[at - size]]:
                    token = closed
                    break
            last.append(token)
        ids, at, spelt = [], len(data), self.token
        while at:
            token = last[at]
            ids.append(token)
            at -= len(spelt[token])
        ids.reverse()
        return ids

    def piece(self, text: str) -> bytes:
        """Ids of one pre-token, packed; one that is itself a token is never cut."""
        data = text.encode("utf-8", "surrogatepass")
        whole = self.ranks.get(data)
        ids = (whole,) if whole is not None else self.walk(data)
        return struct.pack(f"<{len(ids)}I", *ids)


class Utf8Stream:
    """Incremental UTF-8 machine: its state is the unfinished last character."""

    def __init__(self) -> None:
        self.held = b""

    @staticmethod
    def _unfinished(data: bytes) -> int:
        """Bytes at the end that begin a character which is not complete yet."""
        for back in range(1, min(3, len(data)) + 1):
            b = data[-back]
            if b & 0xC0 == 0x80:
                continue
            need = 4 if b >= 0xF0 else 3 if b >= 0xE0 else 2 if b >= 0xC0 else 1
            return back if need > back else 0
        return 0

    def feed(self, data: bytes, last: bool = False) -> str:
        data = self.held + data
        cut = len(data) if last else len(data) - self._unfinished(data)
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")


class Codec:
    """Whole texts to ids and back."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, states: int = STATES, entries: int = ENTRIES):
        self.transducer = Transducer(ranks, states, entries)
        self.pattern = regex.compile(pattern)
        self._pieces = _Memo(self.transducer.piece, entries)
        self._inner = _Memo(self._word, entries)

    def _ids(self, text: str) -> bytes:
        pieces = self.pattern.findall(text)
        if len(pieces) == 1:
            return self._pieces[pieces[0]]
        return b"".join(map(self._pieces.__getitem__, pieces))

    def _word(self, word: str) -> bytes | None:
        """Ids of a word with the space before it, packed; None where white space is beside that."""
        if not word or word[0].isspace() or word[-1].isspace():
            return None
        word = " " + word
        return self._pieces[word] if word[1:].isalpha() else self._ids(word)

    def encode(self, text: str | None) -> np.ndarray:
        """A pre-token holds a space at its start only, so a text whose spaces
        all stand beside no other white space is cut before each of them, and
        ids of words met before are looked up."""
        first, *words = (text or "").split(" ")
        words = [*map(self._inner.__getitem__, words)]
        loose = first[-1:].isspace() or None in words
        return np.frombuffer(self._ids(text) if loose else self._ids(first) + b"".join(words), "<u4")

    def decode_bytes(self, ids: Iterable[int], chunk: int = 4096) -> Iterator[bytes]:
        token = self.transducer.token
        ids = list(ids)
        for at in range(0, len(ids), chunk):
            yield b"".join([token[i] for i in ids[at:at + chunk]])

    def decode(self, ids: Iterable[int]) -> str:
        stream = Utf8Stream()
        return "".join([stream.feed(b) for b in self.decode_bytes(ids)] + [stream.feed(b"", last=True)])


def _codec(data: bytes, pattern: str, *sizes: int) -> Codec:
    """One codec per Python worker and vocabulary, see :func:`kept`."""
    return kept(("bpe", hashlib.sha256(data).digest(), pattern, sizes), lambda: Codec(load_ranks(data), pattern, *sizes))


def _vocabulary(df: DataFrame, path: str):
    """The vocabulary file (under one megabyte), sent to each executor once."""
    with open(path, "rb") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """docs (doc_id, text) -> doc_id, ids array<int>. Null and empty texts give
    an empty array; rows are returned as often as given, whatever their ids."""
    vocabulary = _vocabulary(docs, path)

    @F.pandas_udf("array<int>")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = _codec(vocabulary.value, pattern)
        for texts in batches:
            yield pd.Series([codec.encode(t).astype(np.int32) for t in texts], dtype=object)

    return docs.select("doc_id", udf("text").alias("ids"))


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids -> doc_id, text (null ids: empty)."""
    vocabulary = _vocabulary(encoded, path)

    @F.pandas_udf("string")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = _codec(vocabulary.value, pattern)
        for rows in batches:
            yield pd.Series([codec.decode(() if r is None else r.tolist()) for r in rows], dtype=object)

    return encoded.select("doc_id", udf("ids").alias("text"))


def round_trip(docs: DataFrame, path: str, pattern: str, with_ids: bool = False,
               states: int = STATES, entries: int = ENTRIES) -> DataFrame:
    """Encode each text, decode the ids again, and return digests of both:
    doc_id, n_tokens, ids_sha256 (little-endian unsigned 32-bit), decoded_sha256
    (bytes); with ``with_ids`` also the ids. Null texts count as empty.
    ``states`` and ``entries`` bound what a worker keeps, not the result."""
    vocabulary = _vocabulary(docs, path)
    kind = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    @F.pandas_udf(kind)
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = _codec(vocabulary.value, pattern, states, entries)
        for texts in batches:
            rows = []
            for text in texts:
                ids = codec.encode(text)
                decoded, stream = hashlib.sha256(), Utf8Stream()
                for data in codec.decode_bytes(ids.tolist()):
                    decoded.update(stream.feed(data).encode())
                decoded.update(stream.feed(b"", last=True).encode())
                row = [len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), decoded.hexdigest()]
                rows.append(row + [ids.astype(np.int32)] * with_ids)
            columns = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids
            yield pd.DataFrame(rows, columns=columns)

    return docs.select("doc_id", udf("text").alias("_r")).select("doc_id", "_r.*")
