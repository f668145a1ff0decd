"""Token ids of whole texts at corpus speed, with exactly the ids of the ``tokenizers`` library.

A text is cut at *safe boundaries*: between a character that is no white space and white space after
it, and between a letter and ASCII punctuation after it. None of the pre-tokenizers makes a piece across
such a place, and none looks back over it, so the ids of a text are the ids of its chunks, one after
another. Corpora repeat words, so each distinct chunk is given to the library once, in batches of bounded
bytes, and its ids are kept in a bounded cache that later tasks of the same worker find filled. Chunks
are told apart by 64-bit hashes of their bytes. Texts that hold an added token's string or ``<|``, or a place
where other white space meets ASCII white space, are encoded whole.

Whether this holds for a tokenizer is read from its file (:func:`kind_of`): its normalizer, pre-tokenizer,
model and added tokens. With any other file every text goes to the library as it is.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

from tidemark.llm.common import Words, byte_groups, range_hashes

# ---- fixed values: white space of the tokenizers' patterns (Unicode White_Space) ---------------------
ASCII_SPACE = "\t-\r "
OTHER_SPACE = "\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# -----------------------------------------------------------------------------------------------------
MIXED_SPACE = re.compile(f"[{OTHER_SPACE}][{ASCII_SPACE}]")
CUT = re.compile(f"(?<=[^{ASCII_SPACE}{OTHER_SPACE}])(?=[{ASCII_SPACE}])")
#: one piece for the pre-tokenizers, which they would not change: Latin letters, at most a blank before
CASED = re.compile("( ?)[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
LOWER = re.compile("[a-z\xdf-\xf6\xf8-\xff]+")

_PUNCTUATION = np.zeros(256, dtype=bool)
_PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_LATIN = np.zeros(256, dtype=bool)  # second bytes of the letters U+00C0 to U+00FF
_LATIN[[x for x in range(0x80, 0xC0) if x not in (0x97, 0xB7)]] = True

GROUP_CHARS = 1 << 20  # characters of text worked on at a time: about 100 bytes of arrays each
BATCH_CHARS = 1 << 20  # characters handed to the library at a time
CACHE_CHUNKS = 2_000_000  # distinct chunks kept; a full cache starts anew


# ---- fixed values: steps of the tokenizers for which the boundaries above are safe -------------------
BYTE_STEPS = (None, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True})
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_STEPS = (
    {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": WORD_PATTERN}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]})
# -----------------------------------------------------------------------------------------------------


def kind_of(path: str) -> tuple[str | None, list[str]]:
    """What a tokenizer file's steps are, and the strings of its added tokens: ``"bytes"`` (byte-level pieces,
    white space kept), ``"words"`` (words in lower case, white space dropped), or None for all others."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    added = file.get("added_tokens") or []
    strings = [t["content"] for t in added]
    plain = file["model"].get("type") == "BPE" and not file["model"].get("dropout") and not any(
        t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
    steps = (file.get("normalizer"), file.get("pre_tokenizer"))
    suffix = file["model"].get("end_of_word_suffix")
    if plain and steps == BYTE_STEPS and not suffix and not file["model"].get("continuing_subword_prefix"):
        return "bytes", strings
    if plain and steps == WORD_STEPS and suffix and not file["model"].get("continuing_subword_prefix"):
        return "words", strings
    return None, strings


class ChunkEncoder:
    """Encodes texts with one tokenizer file, without added special tokens.

    ``drops_space``: the tokenizer removes white space and lower-cases, so that its chunks are the
    words alone in lower case. It is read from the file; a value that contradicts the file is an error.
    """

    def __init__(self, path: str, drops_space: bool | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        kind, self.added = kind_of(path)
        if drops_space is not None and drops_space != (kind == "words"):
            raise ValueError(f"drops_space={drops_space} does not fit {path}: its steps are {kind or 'others'}")
        drops_space, self.whole = kind == "words", kind is None
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.drops_space = drops_space
        self.simple = LOWER if drops_space else CASED
        # the byte-level alphabet: printable Latin-1 characters stand for themselves, the others for
        # characters from U+0100 on, in order
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        rest = [b for b in range(256) if b not in shown]
        self.alphabet = {b: 256 + i for i, b in enumerate(rest)}
        self._empty()

    def _empty(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)  # sorted
        self.at = np.zeros(0, dtype=np.int64)  # place of a chunk's ids in the store
        self.size = np.zeros(0, dtype=np.int64)
        self.store = np.zeros(1 << 16, dtype=np.uint32)
        self.used = 0

    def _library(self, texts: list[str]) -> list[list[int]]:
        out: list[list[int]] = []
        for a, b in byte_groups(texts, BATCH_CHARS):
            out += [e.ids for e in self.tokenizer.encode_batch_fast(texts[a:b], add_special_tokens=False)]
        return out

    def _encode_chunks(self, texts: list[str]) -> list[list[int]]:
        """Plain Latin words go to the library's model at once, the others through all its steps."""
        out: list = [None] * len(texts)
        model, simple, other = self.tokenizer.model.tokenize, self.simple.fullmatch, []
        for i, t in enumerate(texts):
            if simple(t):
                piece = t.encode().decode("latin-1").translate(self.alphabet)
                out[i] = [x.id for x in model(piece)]
            else:
                other.append(i)
        for i, ids in zip(other, self._library([texts[i] for i in other]), strict=True):
            out[i] = ids
        return out

    def _chunks(self, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Byte ranges of the chunks, and the number of chunks before each text."""
        b = w.bytes
        cut = np.zeros(len(b) + 1, dtype=bool)  # a chunk ends and another begins before this byte
        cut[1:-1] = _PUNCTUATION[b[1:]] & _LETTER[b[:-1]]
        cut[2:-1] |= _PUNCTUATION[b[2:]] & _LATIN[b[1:-1]] & (b[:-2] == 0xC3)
        begin, stop = cut.copy(), cut
        begin[w.start] = True
        stop[w.end] = True
        start, end = np.flatnonzero(begin), np.flatnonzero(stop)
        first = np.searchsorted(start, w.bounds)
        if self.drops_space:
            return start, end, first
        # white space goes with the word after it; at the end of a text it is one more chunk
        head, tail = w.bounds[:-1], w.bounds[1:] - 1
        n = np.diff(first)
        last = np.where(n > 0, end[np.maximum(first[1:] - 1, 0)] if len(end) else 0, head)
        more = last < tail
        start = np.concatenate(([0], end))[:len(end)].copy()
        has = n > 0
        start[first[:-1][has]] = head[has]
        at = first[1:][more]
        return (np.insert(start, at, last[more]), np.insert(end, at, tail[more]),
                np.concatenate(([0], np.cumsum(n + more))))

    def _cached(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        w = Words(texts, lower=self.drops_space)
        start, end, first = self._chunks(w)
        h = range_hashes(w.bytes, start, end)
        keys, where, which = np.unique(h, return_index=True, return_inverse=True)
        if len(self.keys) > CACHE_CHUNKS:
            self._empty()
        pos = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), dtype=bool)
        inside = pos < len(self.keys)
        known[inside] = self.keys[pos[inside]] == keys[inside]
        if not known.all():
            new = where[~known]
            ids = self._encode_chunks([w.data[a:b].decode("utf-8", "surrogatepass")
                                       for a, b in zip(start[new].tolist(), end[new].tolist(), strict=True)])
            size = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
            flat = np.fromiter((i for x in ids for i in x), dtype=np.uint32, count=int(size.sum()))
            if self.used + len(flat) > len(self.store):
                grown = np.zeros(2 * (self.used + len(flat)), dtype=np.uint32)
                grown[:self.used] = self.store[:self.used]
                self.store = grown
            self.store[self.used:self.used + len(flat)] = flat
            at = self.used + np.concatenate(([0], np.cumsum(size)))[:-1]
            self.used += len(flat)
            put = pos[~known]
            self.keys = np.insert(self.keys, put, keys[~known])
            self.at = np.insert(self.at, put, at)
            self.size = np.insert(self.size, put, size)
            pos = np.searchsorted(self.keys, keys)
        size = self.size[pos][which]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        take = np.arange(total) + np.repeat(self.at[pos][which] - (ends - size), size)
        return self.store[take], np.concatenate(([0], ends))[first]

    def _direct(self, text: str) -> np.ndarray:
        parts = self._library(list(slices(text)))
        return np.array([i for x in parts for i in x], dtype=np.uint32)

    def _plain(self, text: str | None) -> bool:
        """Whether the chunks of this text may be cut and cached as above."""
        if text is None:
            return True
        return "<|" not in text and not any(x in text for x in self.added) and (self.drops_space or text.isascii() or MIXED_SPACE.search(text) is None)

    def encode(self, texts: list[str | None]):
        """Yield ``(a, b, ids, offsets)`` for runs ``texts[a:b]`` of bounded size: the ids of text ``i``
        are ``ids[offsets[i - a]:offsets[i - a + 1]]``. A text longer than ``GROUP_CHARS`` is cut at safe
        boundaries and comes as a run of its own (with a file that has none, as a whole)."""
        for a, b in byte_groups(texts, GROUP_CHARS):
            group = texts[a:b]
            if self.whole:
                pieces = self._library([t or "" for t in group])
                yield (a, b, np.fromiter((i for x in pieces for i in x), dtype=np.uint32),
                       np.concatenate(([0], np.cumsum([len(x) for x in pieces]))).astype(np.int64))
                continue
            odd = [i for i, t in enumerate(group) if not self._plain(t)]
            if odd:
                group = [t if self._plain(t) else None for t in group]
            if len(group) == 1 and group[0] is not None and len(group[0]) > GROUP_CHARS:
                parts = [self._cached([s])[0] for s in slices(group[0])]
                ids = np.concatenate(parts)
                yield a, b, ids, np.array([0, len(ids)])
                continue
            ids, offsets = self._cached(group)
            if odd:
                pieces = [ids[offsets[i]:offsets[i + 1]] for i in range(b - a)]
                for i in odd:
                    pieces[i] = self._direct(texts[a + i])
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in pieces])))
                ids = np.concatenate(pieces)
            yield a, b, ids, offsets


def slices(text: str, size: int = GROUP_CHARS):
    """Cut a long text at the first safe boundary after every ``size`` characters."""
    a = 0
    while len(text) - a > size:
        m = CUT.search(text, a + size)
        b = m.start() if m else len(text)
        yield text[a:b]
        a = b
    if a < len(text):
        yield text[a:]


_ENCODERS: dict[tuple, ChunkEncoder] = {}


def encoder(path: str, drops_space: bool | None = None) -> ChunkEncoder:
    """The worker process's encoder for a file: later tasks of the same worker find its cache filled."""
    key = (path, drops_space)
    if key not in _ENCODERS:
        _ENCODERS[key] = ChunkEncoder(*key)
    return _ENCODERS[key]
