"""Exact batch encoding with a public BPE tokenizer file, by unique pieces.

No BPE merge crosses a piece border, so a text's ids are the concatenation of
its pieces' ids, and a piece needs the tokenizers library only the first time
a worker meets it.  Pieces are found and told apart with numpy over a few MB
of text at a time; only pieces not met before reach the library.

* word-end vocabularies (lower case, white space dropped): runs without white
  space of the normalised text;
* byte-level vocabularies: runs that start at every space that a character
  other than white space follows.  The pre-tokenizer's pattern always has a
  border there, and reads the run the same way alone as in the text.

A run of plain letters, digits and signs is cut further into the pattern's
own words; any other run (apostrophes, line ends, other scripts) is a piece.

Texts that hold a special token's string, or (byte-level) white space outside
ASCII, are encoded by the library as a whole.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np

# The two pre-tokenizers' patterns over ASCII and Latin-1
# letters, in the classes that Python's re knows.
#   word ends: 's|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+
#   bytes:     's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
_L = "A-Za-zÀ-ÖØ-öø-ÿ"
_WORD_ENDS = re.compile(rf"[{_L}]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^\s{_L}0-9]+")
_BYTES = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{_L}]+| ?[0-9]+| ?[^\s{_L}0-9]+|\s+(?!\S)|\s+")
#: Characters for which Python's lower(), \s and the classes above agree with
#: the library, and which NFC leaves alone.
_PLAIN = re.compile(rf"[\t-\r -~{_L[6:]}]*\Z")
_WIDE_SPACE = re.compile("[\x85\xa0  -     　]")

SLICE_BYTES = 1_500_000

_SPACE, _LETTER, _DIGIT, _SIGN, _ODD = range(5)


def _kinds() -> np.ndarray:
    """Kind of each byte of UTF-8.  Letters from À to ÿ are C3 and one byte more;
    a run with × or ÷ among them, or with any other lead byte, is odd."""
    k = np.full(256, _ODD, dtype=np.int8)
    k[33:127] = _SIGN
    k[[*range(9, 14), 32]] = _SPACE
    k[[*range(48, 58)]] = _DIGIT
    k[[*range(65, 91), *range(97, 123), 0xC3, *range(0x80, 0xC0)]] = _LETTER
    k[[39, 0x97, 0xB7]] = _ODD
    return k


_KIND = _kinds()


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE writes a printable Latin-1 byte as itself and the others
    as 256, 257, ... in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class BatchEncoder:
    """``ids(texts)`` gives all ids and the count of each text; ``counts`` only
    the counts.  The cache holds ``max_pieces`` pieces and starts anew when full.
    ``known`` is an optional table piece -> count that is asked before it."""

    def __init__(self, path: str, max_pieces: int = 300_000, known: dict | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.word_ends = bool(self.lib.model.end_of_word_suffix)
        self.pattern = _WORD_ENDS if self.word_ends else _BYTES
        self.model = self.lib.model
        self.specials = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.path, self._raw = path, None
        self.letters = _byte_letters()
        self.known = known or {}
        self.pieces: dict[bytes, bytes] = {}
        self.max_pieces = max_pieces
        rng = np.random.default_rng(20240607)
        self.t1 = rng.integers(1, 1 << 63, 256, dtype=np.uint64)
        self.t2 = rng.integers(1, 1 << 63, 256, dtype=np.uint64)
        self.power = np.ones(1, dtype=np.uint64)

    @property
    def raw(self):
        """The same merges for text that is normalised already; special strings are
        plain text there.  Loaded when a text first needs it."""
        if self._raw is None:
            from tokenizers import Tokenizer, normalizers

            self._raw = Tokenizer.from_file(self.path)
            self._raw.encode_special_tokens = True
            if self.word_ends:
                self._raw.normalizer = normalizers.Sequence([])
        return self._raw

    # -- one piece ---------------------------------------------------------

    def _word(self, w: str) -> bytes:
        s = w.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(s)]).tobytes()

    def _odd(self, p: bytes) -> bytes:
        """Ids of a run that only the pattern itself can divide."""
        s = p.decode()
        if not _PLAIN.match(s):
            return array("I", self.raw.encode(s, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self._word, self.pattern.findall(s)))

    def _each(self, keys: list[bytes], odd: np.ndarray) -> list:
        """What each piece has: from the known table, else from this worker's cache, else from the library."""
        got = list(map(self.known.get, keys)) if self.known else [None] * len(keys)
        if self.known:
            left = [i for i, g in enumerate(got) if g is None]
            for i, g in zip(left, map(self.pieces.get, [keys[i] for i in left])):
                got[i] = g
        else:
            got = list(map(self.pieces.get, keys))
        left = [i for i, g in enumerate(got) if g is None]
        if not left:
            return got
        if len(self.pieces) + len(left) > self.max_pieces:
            self.pieces.clear()
        pieces, tokenize, letters, odds = self.pieces, self.model.tokenize, self.letters, odd[left].tolist()
        for i, o in zip(left, odds):
            p = keys[i]
            if o:
                g = self._odd(p)
            else:  # ASCII letters, digits and signs stand for themselves in byte-level BPE
                s = p.decode() if p.isascii() and p[0] != 32 else p.decode("latin-1").translate(letters)
                g = array("I", [t.id for t in tokenize(s)]).tobytes()
            pieces[p] = got[i] = g
        return got

    def encode_pieces(self, keys: list[bytes]) -> list:
        """Ids (four bytes each) of pieces that ``tally`` has found."""
        return self._each(keys, np.ones(len(keys), dtype=bool))

    # -- a few MB of text --------------------------------------------------

    def _prepare(self, text: str) -> bytes | None:
        """The text that pieces are cut from; None: the library takes the whole text."""
        if any(s in text for s in self.specials):
            return None
        if self.word_ends:
            return (text.lower() if _PLAIN.match(text) else self.lib.normalizer.normalize_str(text)).encode()
        return None if not text.isascii() and _WIDE_SPACE.search(text) else text.encode()

    def _coarse(self, a: np.ndarray, begins: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of every run that no merge and no pattern reaches across.
        Texts begin at ``begins`` and are followed by a line end that belongs to none."""
        if self.word_ends:
            edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
            return edge[0::2], edge[1::2]
        at = np.zeros(len(a) + 1, dtype=bool)
        at[: len(a) - 1] = (a[:-1] == 32) & ~space[1:]
        at[begins] = True
        last = np.append(begins[1:] - 1, len(a) - 1)  # each text's end
        start = np.flatnonzero(at[:-1])
        end = np.append(start[1:], len(a))
        end = np.minimum(end, last[np.searchsorted(begins, start, side="right") - 1])
        return start[start < end], end[start < end]

    def _cuts(self, a: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin and end of every piece, and whether it is not just one word of the pattern.  A run of plain letters, digits and signs is
        cut where these change, as the pattern does; a run with an apostrophe, inner
        white space or other characters stays whole."""
        kind = _KIND[a]
        start, end = self._coarse(a, begins, kind == _SPACE)
        if not len(start):
            return start, end, start > end
        odd = kind == _ODD
        if not self.word_ends:
            inner = kind == _SPACE
            inner[start[a[start] == 32]] = False
            odd |= inner
        seen = np.concatenate(([0], np.cumsum(odd)))
        plain = seen[end] == seen[start]
        edge = np.zeros(len(a) + 1, dtype=bool)
        edge[1:-1] = (kind[1:] != kind[:-1]) & (kind[:-1] != _SPACE)
        if self.word_ends:
            edge[1:-1] |= (kind[1:] == _DIGIT) & (kind[:-1] == _DIGIT)
        depth = np.zeros(len(a) + 1, dtype=np.int8)
        depth[start[~plain]] += 1
        depth[end[~plain]] -= 1
        edge &= np.cumsum(depth, dtype=np.int8) == 0
        edge[start] = True
        edge[end] = True
        at = np.flatnonzero(edge)
        inside = np.zeros(len(a) + 1, dtype=np.int8)
        inside[start] += 1
        inside[end] -= 1
        keep = np.cumsum(inside, dtype=np.int8)[at[:-1]] > 0
        return at[:-1][keep], at[1:][keep], seen[at[1:]][keep] > seen[at[:-1]][keep]

    def _unique(self, a: np.ndarray, start: np.ndarray, end: np.ndarray):
        """Index of a first occurrence of each different piece, and each piece's
        place among them.  Two 64-bit polynomial hashes tell pieces apart."""
        n = len(a)
        if len(self.power) <= n:
            self.power = np.full(n + 1, 0x9E3779B97F4A7C15, dtype=np.uint64)
            self.power[0] = 1
            np.cumprod(self.power, out=self.power)
        both = []
        for table in (self.t1, self.t2):
            s = table[a]
            s *= self.power[:n]
            np.cumsum(s, out=s)
            total = s[end - 1] - np.where(start > 0, s[np.maximum(start, 1) - 1], np.uint64(0))
            both.append(total * self.power[n - start])
        _, first, place = np.unique(both[0], return_index=True, return_inverse=True)
        if not (np.array_equal(both[1], both[1][first][place]) and np.array_equal((end - start), (end - start)[first][place])):
            _, first, place = np.unique(np.stack(both + [(end - start).astype(np.uint64)], axis=1), axis=0, return_index=True, return_inverse=True)
        return first, place.ravel()

    def _slice(self, texts: list[bytes]):
        """(different pieces, whether odd, each piece's place among them, first piece of each text)."""
        buf = b"\n".join(texts) + b"\n"
        a = np.frombuffer(buf, dtype=np.uint8)
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        begins = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
        start, end, odd = self._cuts(a, begins)
        border = np.searchsorted(start, np.append(begins, len(a)))
        if not len(start):
            return [], start, start, border
        first, place = self._unique(a, start, end)
        return [buf[s:e] for s, e in zip(start[first].tolist(), end[first].tolist())], odd[first], place, border

    def _ids_of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        keys, odd, place, border = self._slice(texts)
        if not keys:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        got = self._each(keys, odd)
        n = np.fromiter(map(len, got), dtype=np.int64, count=len(got)) // 4
        flat = np.frombuffer(b"".join(got), dtype="<u4")
        begin = np.cumsum(n) - n
        m = n[place]
        total = np.concatenate(([0], np.cumsum(m)))
        ids = flat[np.repeat(begin[place] - total[:-1], m) + np.arange(total[-1])]
        return ids, np.diff(total[border])

    def _counts_of(self, texts: list[bytes]) -> np.ndarray:
        keys, odd, place, border = self._slice(texts)
        if not keys:
            return np.zeros(len(texts), np.int64)
        n = np.fromiter((g if type(g) is int else len(g) // 4 for g in self._each(keys, odd)), dtype=np.int64, count=len(keys))
        return np.diff(np.concatenate(([0], np.cumsum(n[place])))[border])

    def _parts(self, b: bytes) -> Iterator[bytes]:
        """A very long text in parts that end where pieces do."""
        at = 0
        border = re.compile(rb"[\t-\r ]" if self.word_ends else rb" (?=[^\t-\r ])")
        while len(b) - at > SLICE_BYTES and (m := border.search(b, at + SLICE_BYTES)):
            yield b[at : m.start()]
            at = m.start()
        yield b[at:]

    def _slices(self, texts: list[str | None]):
        """(index of each text, bytes of each) a few MB at a time; bytes None: whole texts for the library."""
        index: list[int] = []
        held: list[bytes] = []
        size = 0
        for i, t in enumerate(texts):
            if not t:
                continue
            b = self._prepare(t)
            if b is None:
                yield [i], None
                continue
            for p in self._parts(b) if len(b) > SLICE_BYTES else (b,):
                if size and size + len(p) > SLICE_BYTES:
                    yield index, held
                    index, held, size = [], [], 0
                index.append(i)
                held.append(p)
                size += len(p)
        if held:
            yield index, held

    def ids(self, texts: list[str | None]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
        """(text indexes, ids, count of ids of each), in runs; a long text may come
        in several parts, always in order.  Empty and null texts don't come."""
        for index, held in self._slices(texts):
            if held is None:
                one = np.array(self.lib.encode(texts[index[0]], add_special_tokens=False).ids, dtype=np.uint32)
                yield index, one, np.array([len(one)])
            else:
                yield index, *self._ids_of(held)

    def counts(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros(len(texts), dtype=np.int64)
        for index, held in self._slices(texts):
            if held is None:
                out[index[0]] += len(self.lib.encode(texts[index[0]], add_special_tokens=False).ids)
            else:
                np.add.at(out, index, self._counts_of(held))
        return out

    def lists(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        for index, ids, n in self.ids(texts):
            for i, part in zip(index, np.split(ids, np.cumsum(n)[:-1])):
                out[i].append(part)
        return [x[0] if len(x) == 1 else np.concatenate(x) if x else np.zeros(0, np.uint32) for x in out]

    def tally(self, texts: list[str | None]) -> Iterator[tuple[list[bytes], np.ndarray]]:
        """(different pieces, times each occurs), a few MB of text at a time."""
        for _, held in self._slices(texts):
            if held is not None:
                keys, _, place, _ = self._slice(held)
                if keys:
                    yield keys, np.bincount(place)


_HELD: dict[tuple, BatchEncoder] = {}


def encoder(path: str, known: dict | None = None, known_name: str = "", **options) -> BatchEncoder:
    """This worker process's encoder for ``path`` and the table ``known_name``, kept between tasks."""
    key = (path, known_name, *sorted(options.items()))
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = BatchEncoder(path, known=known, **options)
    return _HELD[key]
