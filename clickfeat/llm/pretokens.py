"""Pre-tokens of many texts at once.

The pattern of byte-level BPE vocabularies (``PATTERN``) cuts a text into runs of letters, of numbers and of
other characters, each with a space before it if there is one, into white space, and into some English
endings behind an apostrophe.  Its cuts depend on the classes of neighbouring characters only, so numpy
finds them for a whole batch of texts; Arrow then lists the different pieces, and only these are looked at one
by one.  Other patterns go through ``regex``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex

#: Fixed value: the pattern that is cut by classes of characters.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Fixed value: the pattern of vocabularies with word ends, for lower-case text; white space between its pieces is dropped.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Characters that are cut at once, and after which a long text is cut where no piece reaches over.
BLOCK = 1 << 20
SAFE = regex.compile(r"(?<=\S) (?=\S)")

_SPACE, _LETTER, _NUMBER, _OTHER = 0, 1, 2, 3


def _classes() -> np.ndarray:
    out = np.full(0x110000, _OTHER, np.uint8)
    text = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for pattern, kind in ((r"\s+", _SPACE), (r"\p{L}+", _LETTER), (r"\p{N}+", _NUMBER)):
        for m in regex.finditer(pattern, text):
            a, b = (x if x < 0xD800 else x + 0x800 for x in (m.start(), m.end() - 1))
            out[a:b + 1] = kind
    return out


_CLASSES: list[np.ndarray] = []


def _kinds(code: np.ndarray) -> np.ndarray:
    if not _CLASSES:
        _CLASSES.append(_classes())
    return _CLASSES[0][code]


def _endings(code: np.ndarray, kind: np.ndarray, text: np.ndarray, run: np.ndarray, start: np.ndarray) -> None:
    """Endings: an apostrophe that is a run and a piece's start, and what follows.  ``start`` is changed."""
    n = len(code)
    at = np.flatnonzero((code == 0x27) & run & start)
    at = at[at + 1 < n]
    at = at[run[at + 1] & ~text[at + 1] & (kind[at + 1] == _LETTER)]
    if len(at):
        a = code[at + 1]
        b = np.where((at + 2 < n) & ~text[np.minimum(at + 2, n)], code[np.minimum(at + 2, n - 1)], 0)
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        start[at[one | two] + 1] = False
        for some, size in ((at[one], 2), (at[two], 3)):
            end = some + size
            end = end[end < n]
            start[end[kind[end] != _SPACE]] = True


def _starts(code: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where pieces start.  ``first``: the places at which texts start."""
    n = len(code)
    kind = _kinds(code)
    text = np.zeros(n + 1, bool)                      # a text starts here
    text[first] = True
    text[n] = True
    run = text[:-1].copy()                            # a run of one class starts here
    run[1:] |= kind[1:] != kind[:-1]
    space = kind == _SPACE
    start = run.copy()
    # white space before something: its last character stands alone or, if a space, begins the next piece
    last = np.flatnonzero(space[:-1] & ~space[1:] & ~text[1:-1])
    start[last] = True
    start[last[code[last] == 0x20] + 1] = False
    _endings(code, kind, text, run, start)
    return start


def _strings(data: bytes, code: np.ndarray, at: np.ndarray) -> pa.StringArray:
    """The pieces that start at ``at`` of the text with these characters."""
    width = 1 + (code > 0x7F).astype(np.int8) + (code > 0x7FF) + (code > 0xFFFF)
    places = np.cumsum(width, dtype=np.int32) - width
    offsets = np.append(places[at], len(data)).astype(np.int32)
    return pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(data))


def cut_words(texts: list[str]) -> tuple[pa.StringArray, np.ndarray]:
    """The pieces of ``WORD_PATTERN`` in the lower-case texts, and how many each text has.  A word (between ASCII white space) with
    a character beyond Latin-1, a control character or the start of a special token's string is one piece, only A-Z lower."""
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    whole = "".join([t + " " for t in texts])
    if not whole:
        return pa.array([], pa.string()), np.zeros(len(texts), np.int64)
    code = np.frombuffer(whole.encode("utf-32-le"), "<u4").copy()
    space = (code == 0x20) | (code >= 0x09) & (code <= 0x0D)
    code[(code >= 0x41) & (code <= 0x5A)] += 32
    word = ~space
    word[1:] &= space[:-1]
    number = np.cumsum(word) - 1
    odd = ~((code >= 0x21) & (code <= 0x7E) | (code >= 0xA1) & (code <= 0xFF)) & ~space
    odd[:-1] |= (code[:-1] == ord("<")) & (code[1:] == ord("|"))
    whole_word = np.zeros(int(number[-1]) + 1, bool)
    whole_word[number[odd]] = True
    plain = ~space
    plain[plain] = ~whole_word[number[plain]]
    code[plain & (code >= 0xC0) & (code <= 0xDE) & (code != 0xD7)] += 32
    kind = _kinds(code)
    kind[space] = _SPACE
    run = word.copy()
    run[1:] |= plain[1:] & plain[:-1] & (kind[1:] != kind[:-1])
    start = run | plain & (kind == _NUMBER)
    text = np.zeros(len(code) + 1, bool)
    text[1:-1] = space[:-1]
    mark = run & plain
    mark[1:] |= space[1:]
    held = start & plain
    _endings(np.where(plain, code, 0), kind, text, mark, held)
    start = np.where(plain, held, word)
    at = np.flatnonzero(start)
    kept = code[~space]
    data = kept.tobytes().decode("utf-32-le").encode()
    counts = np.diff(np.searchsorted(at, np.append(0, np.cumsum(sizes))))
    return _strings(data, kept, (np.cumsum(~space) - 1)[at]), counts


def cut(texts: list[str], pattern: str) -> tuple[pa.StringArray, np.ndarray]:
    """All pieces of the texts in order, and how many each text has."""
    if pattern != PATTERN:
        found = regex.compile(pattern).findall
        listed = [found(t) for t in texts]
        return pa.array([p for x in listed for p in x], pa.string()), np.array([len(x) for x in listed], np.int64)
    sizes = np.array([len(t) for t in texts], np.int64)
    whole = "".join(texts)
    if not whole:
        return pa.array([], pa.string()), np.zeros(len(texts), np.int64)
    code = np.frombuffer(whole.encode("utf-32-le"), "<u4")
    ends = np.cumsum(sizes)
    first = (ends - sizes)[sizes > 0]
    at = np.flatnonzero(_starts(code, first))
    pieces = _strings(whole.encode(), code, at)
    return pieces, np.diff(np.searchsorted(at, np.append(0, ends)))


def _blocks(texts: list[str]) -> Iterator[list[tuple[int, str]]]:
    """(place of the text, part of it) in blocks of bounded size; parts of a long text end in front of a safe space."""
    block, size = [], 0
    for i, t in enumerate(texts):
        while len(t) > BLOCK:
            m = SAFE.search(t, BLOCK // 2)
            if not m:
                break
            part, t = t[:m.start()], t[m.start():]
            yield [(i, part)]
        block.append((i, t))
        size += len(t)
        if size > BLOCK:
            yield block
            block, size = [], 0
    if block:
        yield block


class Pieces:
    """Ids of texts from the ids of their different pieces.  ``cut`` lists the pieces of texts, ``learn`` gives the ids
    of new pieces; a bounded number of pieces is remembered."""

    def __init__(self, cut: Callable[[list[str]], tuple[pa.StringArray, np.ndarray]], learn: Callable[[list[str]], list[np.ndarray]], kind: np.dtype, cache: int):
        self.cut, self.learn, self.kind, self.cache = cut, learn, kind, cache
        self.known: dict[str, bytes] = {}

    def _ids(self, pieces: list[str]) -> list[bytes]:
        known = self.known
        got = [known.get(p) for p in pieces]
        new = [i for i, x in enumerate(got) if x is None]
        if new:
            if len(known) + len(new) > self.cache:
                known.clear()
            for i, ids in zip(new, self.learn([pieces[i] for i in new]), strict=True):
                got[i] = np.asarray(ids, self.kind).tobytes()
                if len(pieces[i]) <= 64:
                    known[pieces[i]] = got[i]
        return got

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text."""
        parts: list[list[np.ndarray]] = [[] for _ in texts]
        for block in _blocks(texts):
            pieces, counts = self.cut([t for _, t in block])
            listed = pieces.dictionary_encode()
            ids = self._ids(listed.dictionary.to_pylist())
            flat = np.frombuffer(b"".join(ids), self.kind)
            size = np.array([len(x) for x in ids], np.int64) // self.kind.itemsize
            start = np.cumsum(size) - size
            index = listed.indices.to_numpy()
            n = size[index]
            ends = np.cumsum(n)
            total = int(ends[-1]) if len(ends) else 0
            out = flat[np.repeat(start[index] - (ends - n), n) + np.arange(total)] if total else flat[:0]
            edges = np.append(0, ends)[np.append(0, np.cumsum(counts))]
            for (i, _), a, b in zip(block, edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                parts[i].append(out[a:b])
        empty = np.empty(0, self.kind)
        return [p[0] if len(p) == 1 else np.concatenate(p) if p else empty for p in parts]
