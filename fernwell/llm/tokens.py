"""Token ids of whole texts, by words.

A byte-pair tokenizer of this library cuts a text before it merges, and one place where it always
cuts is before a white-space character that a visible one follows. The text is cut there, each
distinct piece of a slice of the texts is encoded once, all of them in one call, and the ids are put
together again in numpy. The ids equal those of `tokenizers` on the whole text (tests/llm compares
them). A text that holds a mark of the file's added tokens, such as an end-of-text mark, is encoded
by the library as a whole.

Pieces are encoded by a byte-pair encoder that takes merges by rank, fed with the vocabulary and
merges of the tokenizer file. That gives what the file's own merge list gives if each token of the
vocabulary, encoded alone, gives itself; tokens for which that does not hold would be listed by
`odd_tokens`. Pieces that its rules do not cover (rare scripts under a normalizer) go through
`tokenizers` itself.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa

from .shared import column_bytes, ranges

#: Pattern by which byte-level tokenizers of this kind cut a text; a fixed value of the format.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_WORD_PARTS = re.compile(r"\n|'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9\n]+")
#: Ids of pieces, all in one array, and how many each has.
Encoded = tuple[np.ndarray, np.ndarray]


@lru_cache(maxsize=1)
def _byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in byte-level vocabularies: visible Latin-1 characters for
    themselves, the others for letters from U+0100 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in shown}
    hidden = [b for b in range(256) if b not in set(shown)]
    return out | {chr(256 + i): b for i, b in enumerate(hidden)}


def _raw(token: str) -> bytes:
    letters = _byte_letters()
    return bytes(letters[c] for c in token)


@lru_cache(maxsize=2)
def library(path: str):  # noqa: ANN201
    """The tokenizer of the file, as the library has it."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def marks(path: str) -> tuple[bytes, ...]:
    """What the added tokens of the file look like in a text."""
    return tuple(sorted(t.content.encode() for t in library(path).get_added_tokens_decoder().values()))


def _white(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def _visible(data: np.ndarray) -> np.ndarray:
    """Neither white space nor a control byte nor the start of a rare space."""
    return (data > 32) & (data != 127) & (data != 0xC2) & ((data < 0xE1) | (data > 0xE3))


def _piece_numbers(off: np.ndarray, places: np.ndarray) -> np.ndarray:
    return np.searchsorted(off, places, "right") - 1


def _woven(first: Encoded, first_at: np.ndarray, other: dict[int, np.ndarray], n: int) -> Encoded:
    """Ids of n pieces: those at first_at, in order, and single ones."""
    ids, size = first
    if not other:
        return ids, size
    sizes = np.zeros(n, np.int64)
    sizes[first_at] = size
    for i, x in other.items():
        sizes[i] = len(x)
    begin = np.cumsum(sizes) - sizes
    out = np.empty(int(sizes.sum()), np.uint16)
    out[ranges(begin[first_at], size)] = ids
    for i, x in other.items():
        out[begin[i] : begin[i] + len(x)] = x
    return out, sizes


@lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[np.ndarray, np.ndarray], Encoded]:
    """Ids of pieces, given as offsets and bytes, for a tokenizer file."""
    import tiktoken

    own = library(path)
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    suffix = model.get("end_of_word_suffix") or ""
    vocab: dict[str, int] = model["vocab"]
    if max(vocab.values()) >= 1 << 16:
        raise ValueError("ids must fit 16 bits")

    def text_of(off: np.ndarray, data: np.ndarray, i: int) -> str:
        return data[off[i] : off[i + 1]].tobytes().decode("utf-8", "replace")

    if not suffix:
        specials = {t.content for t in own.get_added_tokens_decoder().values()}
        ranks = {_raw(t): i for t, i in vocab.items() if t not in specials}
        bytes_of = np.zeros(1 << 16, np.int64)
        bytes_of[list(ranks.values())] = [len(t) for t in ranks]
        enc = tiktoken.Encoding("bytes", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

        def by_bytes(off: np.ndarray, data: np.ndarray) -> Encoded:
            """Pieces that begin with white space and a visible character are cut from what stands
            before them, whatever it is: they are encoded as one text, and told apart by the bytes of
            their tokens."""
            n = len(off) - 1
            led = _white(data[off[:-1]]) & (np.diff(off) > 1)
            led[led] = _visible(data[off[:-1][led] + 1])
            at, rest = np.flatnonzero(led), np.flatnonzero(~led)
            lens = np.diff(off)[at]
            whole = data if not len(rest) else data[ranges(off[:-1][at], lens)]
            ids = np.array(enc.encode_ordinary(whole.tobytes().decode("utf-8", "replace")), np.uint16)
            ends = np.searchsorted(np.cumsum(bytes_of[ids]), np.cumsum(lens)) + 1
            sizes = np.diff(ends, prepend=0)
            return _woven((ids, sizes), at, {int(i): np.array(enc.encode_ordinary(text_of(off, data, i)), np.uint16) for i in rest}, n)

        return by_bytes

    # Word ends: the suffix is one more byte after the word, which its last byte takes up first.
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    end, ranks, ids_of = b"\x01", {}, {}
    letters = _byte_letters()
    for letter, b in letters.items():
        ranks[bytes([b]) + end] = b
        ids_of[b] = vocab[letter + suffix]
        ranks[bytes([b])] = 1_000_000 + b
        ids_of[1_000_000 + b] = vocab[letter]
    for i, (left, right) in enumerate(merges):
        token = left + right
        whole = _raw(token[: -len(suffix)]) + end if token.endswith(suffix) else _raw(token)
        ranks.setdefault(whole, 1000 + i)
        ids_of[1000 + i] = vocab[token]
    enc = tiktoken.Encoding("words", pat_str=r"[^\x01]+\x01", mergeable_ranks=ranks, special_tokens={})
    id_of = np.zeros(1_000_256, np.uint16)
    id_of[list(ids_of)] = list(ids_of.values())

    def by_words(off: np.ndarray, data: np.ndarray) -> Encoded:
        """Pieces of visible ASCII and of Latin letters with accents, white space around them left
        out, are encoded as one text, told apart by line feeds, which are in none of them."""
        n = len(off) - 1
        white = _white(data)
        after = np.append(data[1:], np.uint8(0))
        before = np.concatenate((np.zeros(1, np.uint8), data[:-1]))
        accent = (data == 0xC3) & (after >= 0x80) & (after <= 0xBF) & (after != 0x97) & (after != 0xB7)
        known = white | ((data >= 0x21) & (data <= 0x7E)) | accent | ((before == 0xC3) & (data >= 0x80) & (data <= 0xBF) & (data != 0x97) & (data != 0xB7))
        plain = np.ones(n, bool)
        plain[_piece_numbers(off, np.flatnonzero(~known))] = False
        rest = np.flatnonzero(~plain)
        keep = ~white
        if len(rest):
            keep[ranges(off[:-1][rest], np.diff(off)[rest])] = False
        kept = np.concatenate(([0], np.cumsum(keep)))
        at = np.flatnonzero(plain)
        lens = (kept[off[1:]] - kept[off[:-1]])[at]
        joined = np.full(int(lens.sum()) + len(at), 10, np.uint8)
        joined[ranges(np.cumsum(lens + 1) - lens - 1, lens)] = data[keep]
        first: Encoded = (np.zeros(0, np.uint16), np.zeros(0, np.int64))
        if len(at):
            parts = _WORD_PARTS.findall(joined.tobytes().decode().lower())
            got = np.array(enc.encode_ordinary("\x01".join(parts) + "\x01"), np.int64)
            feed = got == 10  # a line feed as a word
            ends = np.flatnonzero(feed)
            first = (id_of[got[~feed]], np.diff(ends, prepend=-1) - 1)
        return _woven(first, at, {int(i): np.array(own.encode(text_of(off, data, i), add_special_tokens=False).ids, np.uint16) for i in rest}, n)

    return by_words


def encode_texts(path: str, texts: pa.Array, slice_bytes: int = 8 << 20):  # noqa: ANN201
    """Yields (first row, token offsets of the rows, uint16 ids) for slices of a string column."""
    off, data = column_bytes(texts)
    n, at = len(off) - 1, 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + slice_bytes, "right")) - 1)
        yield at, *_encode_slice(path, off[at : to + 1] - off[at], data[off[at] : off[to]])
        at = to


def _encode_slice(path: str, off: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(data):
        return np.zeros(len(off), np.int64), np.zeros(0, np.uint16)
    ws = _white(data)
    here = np.ones(len(data) + 1, bool)
    here[:-2] = ws[:-1] & _visible(data[1:])
    here[-2] = False
    edge = off[1:-1] - 1
    here[edge[edge >= 0]] = False  # the next byte is another document's
    here[off[:-1][np.diff(off) > 0]] = True
    bounds = np.flatnonzero(here)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)])
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    flat, size = encoder(path)(*column_bytes(coded.dictionary))
    begin = np.cumsum(size) - size
    lens = size[codes]
    ids = flat[ranges(begin[codes], lens)]
    before = np.concatenate(([0], np.cumsum(lens)))
    return _with_marks(path, off, data, before[np.searchsorted(bounds, off)], ids)


def _with_marks(path: str, off: np.ndarray, data: np.ndarray, at: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token offsets and ids, texts that hold marks being encoded anew."""
    raw, found = data.tobytes(), set()
    for mark in marks(path):
        k = raw.find(mark)
        while k >= 0:
            found.add(int(np.searchsorted(off, k, "right")) - 1)
            k = raw.find(mark, k + 1)
    if not found:
        return at, ids
    rows = [ids[i:j] for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    for k in found:
        text = raw[off[k] : off[k + 1]].decode("utf-8", "replace")
        rows[k] = np.array(library(path).encode(text, add_special_tokens=False).ids, np.uint16)
    return np.concatenate(([0], np.cumsum([len(r) for r in rows]))), np.concatenate(rows)


def odd_tokens(path: str) -> list[str]:
    """Tokens made by merges that do not encode to themselves (see the module's text)."""
    own = library(path)
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    suffix = model.get("end_of_word_suffix") or ""
    bpe = own.model
    out = []
    for m in model["merges"]:
        token = "".join(m.split(" ") if isinstance(m, str) else m)
        # a token without the suffix cannot stand alone where a suffix is put on every word
        if suffix and not token.endswith(suffix):
            continue
        got = [t.value for t in bpe.tokenize(token[: -len(suffix)] if suffix else token)]
        if got != [token]:
            out.append(token)
    return out
