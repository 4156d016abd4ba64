"""Byte-level BPE: exact encoding in linear time, decoding, ids as array columns.

A word is a string of bytes, held as Latin-1 text so that one Aho-Corasick automaton
over the vocabulary finds, in one pass, the longest token beginning at each byte. The
encoder goes left to right with these longest tokens. A token may follow its neighbour
only if merging the two alone would give the same two tokens; otherwise the next
shorter token at this place is tried, and when none is left, the place is marked as a
dead end and the token before it is shortened. Each place becomes a dead end at most
once, so the work is linear. Whether two tokens may stand side by side is remembered.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from wavelens.llm.common import arrow_map, int_lists, slices

#: Entries of each kind that a worker remembers at most: pieces of text, token pairs.
REMEMBERED = 3 << 18

#: Unicode White_Space (fixed values), as the word patterns understand it.
BLANK = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_BLANK_RUN = re.compile(f"[{BLANK}]{{2,}}")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file (base64 token, id per line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class Memo(dict):
    """A dict that fills itself by ``make``; what was not used lately is forgotten."""

    def __init__(self, make, limit: int = REMEMBERED):
        super().__init__()
        self.make, self.half, self.older = make, limit // 2, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.half:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class Vocabulary:
    """Tokens by id, their longest proper prefixes, and the merge that makes each."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values()) + 1
        self.ids = {token.decode("latin-1"): i for token, i in ranks.items()}
        self.token = [b""] * size
        for token, i in ranks.items():
            self.token[i] = token
        self.length = [len(t) for t in self.token]
        self.shorter = [-1] * size
        for token, i in self.ids.items():
            for end in range(len(token) - 1, 0, -1):
                if (found := self.ids.get(token[:end])) is not None:
                    self.shorter[i] = found
                    break
        self.automaton = ahocorasick.Automaton()
        for token, i in self.ids.items():
            self.automaton.add_word(token, (len(token), i))
        self.automaton.make_automaton()
        self.merged: dict[tuple[int, int], int] = {}
        self.parts = [(i, i) for i in range(size)]
        self.may_follow = Memo(lambda pair: self._neighbours(pair >> 20, pair & 0xFFFFF))
        for i in sorted(ranks.values()):
            self._learn_merge(i)

    def _learn_merge(self, i: int) -> None:
        """Find the last merge of token ``i``: two older tokens that stay side by side."""
        text = self.token[i].decode("latin-1")
        left = self.shorter[i]
        while left >= 0:
            right = self.ids.get(text[self.length[left]:])
            if right is not None and left < i and right < i and self._neighbours(left, right):
                self.parts[i] = (left, right)
                self.merged[left, right] = i
                return
            left = self.shorter[left]

    def _neighbours(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens ends with these two tokens.

        Undo the merges on either side of the border from the latest to the earliest.
        If two parts that meet there form a token older than the merge undone next, that
        merge across the border would have come first.
        """
        bound = len(self.token)
        while True:
            across = self.merged.get((left, right), bound)
            if across < bound:
                return False
            if left > right:
                bound, left = left, self.parts[left][1]
                if left != bound:
                    continue
                bound, first = right + 1, self.parts[right][0]
                if first == right:
                    return True
                right = first
            else:
                bound, first = right + 1, self.parts[right][0]
                if first != right:
                    right = first
                    continue
                bound, last = left, self.parts[left][1]
                if last == left:
                    return True
                left = last

    def encode_word(self, word: bytes) -> list[int]:
        text = word.decode("latin-1")
        if (whole := self.ids.get(text)) is not None:
            return [whole]
        follow = self.may_follow
        # Longest tokens one after another: often they are the answer already.
        out = [i for _, (_, i) in self.automaton.iter_long(text)]
        for k in range(1, len(out)):
            if not follow[out[k - 1] << 20 | out[k]]:
                return self._backtrack(text, out[:k], out[k])
        return out

    def _backtrack(self, text: str, out: list[int], token: int) -> list[int]:
        """Go on from the tokens ``out``, which ``token`` may not follow."""
        n, follow, length, shorter = len(text), self.may_follow, self.length, self.shorter
        longest = self.automaton.iter_long
        dead: set[int] = set()
        at = sum([length[i] for i in out])
        while at < n:
            end = at + length[token]
            if end not in dead and (not out or follow[out[-1] << 20 | token]):
                out.append(token)
                at = end
                if at < n:
                    token = next(longest(text, at))[1][1]
                continue
            token = shorter[token]
            while token < 0:
                dead.add(at)
                last = out.pop()
                at -= length[last]
                token = shorter[last]
        return out


class Encoder:
    """Texts to ids, with what was seen before remembered up to a bound.

    Words of the pattern never reach over a single blank that stands between two other
    characters, so the text is cut there, and the pieces between are looked up whole.
    """

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary = vocabulary
        self.words = regex.compile(pattern).findall
        self.piece = Memo(self._piece)

    def _piece(self, piece: str) -> bytes:
        if not (piece[1:] if piece[0] == " " else piece).isalpha():
            words = self.words(piece)
            if len(words) > 1:
                return b"".join(map(self._get, words))
        return array("i", self.vocabulary.encode_word(piece.encode())).tobytes()

    def _get(self, piece: str) -> bytes:
        """Pieces of unusual length are not remembered."""
        return self.piece[piece] if len(piece) <= 64 else self._piece(piece)

    def _span(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        pieces = [" " + x for x in rest]
        if first:
            pieces.insert(0, first)
        if max(map(len, pieces)) > 64:
            return b"".join(map(self._get, pieces))
        return b"".join(map(self.piece.__getitem__, pieces))

    def encode(self, text: str) -> np.ndarray:
        """Ids of the whole text, int32."""
        out, at = [], 0
        for run in _BLANK_RUN.finditer(text):
            # All but the last blank of a run are one word; the last goes to what follows.
            begin, end = run.span()
            if begin > at:
                out.append(self._span(text[at:begin]))
            cut = end if end == len(text) else end - 1
            out.append(self._get(text[begin:cut]))
            at = cut
        if at < len(text):
            out.append(self._span(text[at:]))
        return np.frombuffer(b"".join(out), np.int32)


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """The worker's encoder for a rank file, built once per Python worker."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(Vocabulary(read_ranks(path)), pattern)
    return _ENCODERS[path, pattern]


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the ids of ``text`` as an array of int; a null or empty text has none.

    ``path`` is the rank file, present on every executor. Rows keep their order and
    multiplicity; a column already called ``ids`` (in any case) is replaced.
    """
    kept = df.select([c for c in df.columns if c.lower() != ids.lower()])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_one = encoder(path, pattern).encode
        for batch in batches:
            for part in slices(batch, text):
                texts = part.column(part.schema.get_field_index(text)).to_pylist()
                found = int_lists([encode_one(x or "") for x in texts])
                yield pa.RecordBatch.from_arrays([*part.columns, found], [*part.schema.names, ids])

    return arrow_map(kept, run, _schema(kept, f"{ids} array<int>"))


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the bytes that an array of ids stands for; null or no ids give no bytes.

    An id outside the vocabulary raises ``ValueError``.
    """
    kept = df.select([c for c in df.columns if c.lower() != out.lower()])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = decoder(path)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            offsets = np.asarray(column.offsets)
            flat = np.asarray(column.values)
            empty = np.asarray(column.is_null())
            found = [
                b"" if none else tokens.decode(flat[a:b])
                for a, b, none in zip(offsets[:-1], offsets[1:], empty, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.binary())], [*batch.schema.names, out]
            )

    return arrow_map(kept, run, _schema(kept, f"{out} binary"))


class Decoder:
    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = np.full(max(ranks.values()) + 1, None, dtype=object)
        for token, i in ranks.items():
            self.tokens[i] = token

    def decode(self, ids: np.ndarray) -> bytes:
        if not len(ids):
            return b""
        if ids.min() < 0 or ids.max() >= len(self.tokens):
            raise ValueError("id outside the vocabulary")
        return b"".join(self.tokens[ids].tolist())


_DECODERS: dict[str, Decoder] = {}


def decoder(path: str) -> Decoder:
    if path not in _DECODERS:
        _DECODERS[path] = Decoder(read_ranks(path))
    return _DECODERS[path]


def _schema(df: DataFrame, more: str):
    from pyspark.sql import types as T

    fields = [T.StructField(f.name, f.dataType, True) for f in df.schema]
    return T.StructType([*fields, *T.StructType.fromDDL(more).fields])
