"""Distinct-chunk tables: encode each distinct chunk once, join ids by position.

A text is cut at U+0020.  Where no piece of a vocabulary can cross such a cut,
the ids of a text are the ids of its chunks one after the other, so a table
``chunk -> ids`` filled once per distinct chunk gives the ids of every text
by a gather.  The table lives in the Python worker, is filled from the
library's own encoder, and is emptied when it reaches a fixed number of
entries or characters, so memory stays bounded for any input.  Texts in which a cut
would not be exact are encoded whole by the library.
"""

from __future__ import annotations

import json
import os
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

MAX_ENTRIES = 400_000      # entries of a table before it is emptied
MAX_CHARS = 16_000_000     # characters of its keys, likewise
SLICE_BYTES = 8_000_000    # text handled at a time


def slices(texts: pa.Array, limit: int = SLICE_BYTES):
    """Cut an array of texts into runs of about ``limit`` bytes (one text at
    least), as ``(first, count)``."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    first, total = 0, 0
    for i, n in enumerate(sizes):
        if i > first and total + n > limit:
            yield first, i - first
            first, total = i, 0
        total += int(n)
    if len(texts) > first:
        yield first, len(texts) - first


class Store:
    """Id lists of distinct keys, held in one flat array."""

    def __init__(self):
        self.clear()

    def clear(self):
        self.index: dict[str, int] = {}
        self.chars = 0
        self.flat = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.start = np.zeros(1 << 14, np.int64)
        self.length = np.zeros(1 << 14, np.int64)
        self.n = 0

    def add(self, flat: np.ndarray, lens: np.ndarray) -> int:
        """Append id lists; returns the number of the first."""
        first = self.n
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.n + len(lens) > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.length = np.concatenate([self.length, np.zeros_like(self.length)])
        self.flat[self.used:self.used + len(flat)] = flat
        self.start[first:first + len(lens)] = self.used + np.cumsum(lens) - lens
        self.length[first:first + len(lens)] = lens
        self.used += len(flat)
        self.n += len(lens)
        return first

    def full(self) -> bool:
        return len(self.index) > MAX_ENTRIES or self.chars > MAX_CHARS

    def gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The id lists numbered ``at`` one after the other, and their lengths."""
        lens = self.length[at]
        ends = np.cumsum(lens)
        total = int(ends[-1]) if len(ends) else 0
        where = np.repeat(self.start[at] - (ends - lens), lens)
        where += np.arange(total)
        return self.flat[where], lens


class ChunkEncoder:
    """Base: cut at single spaces, look chunks up, fill the table.

    Subclasses give ``encode_keys(keys) -> (flat ids, lengths)``."""

    #: chunks at the start of a text differ from those after a space
    first_differs = False

    def __init__(self):
        self.store = Store()

    def encode_keys(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raise NotImplementedError

    def encode_first(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raise NotImplementedError

    def whole(self, texts: pa.Array) -> np.ndarray | None:
        """Which texts must be encoded as a whole (None: none)."""
        return None

    def encode_text(self, text: str) -> np.ndarray:
        raise NotImplementedError

    def lookup(self, keys: list[str], encode, tag: str = "") -> np.ndarray:
        """Numbers of the keys in the store, encoding those that are new.  The
        keys hold no space, so a tag with one keeps kinds of keys apart."""
        names = [tag + k for k in keys] if tag else keys
        at = np.fromiter(map(self.store.index.get, names, repeat(-1)), np.int64, len(names))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            first = self.store.add(*encode([keys[i] for i in missing]))
            at[missing] = np.arange(first, first + len(missing))
            self.store.index.update((names[i], int(at[i])) for i in missing)
            self.store.chars += sum(len(names[i]) for i in missing)
        return at

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of each."""
        if self.store.full():
            self.store.clear()
        if len(texts) == 0:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        whole = self.whole(texts)
        if whole is not None and whole.any():
            return self._mixed(texts, whole)
        parts = pc.split_pattern(texts, " ")
        offsets = parts.offsets.to_numpy().astype(np.int64)
        coded = parts.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        offsets = offsets - offsets[0]
        at = self.lookup(coded.dictionary.to_pylist(), self.encode_keys)[coded.indices.to_numpy()]
        if self.first_differs:
            heads = coded.dictionary.take(coded.indices.take(pa.array(offsets[:-1])))
            at[offsets[:-1]] = self.lookup(heads.to_pylist(), self.encode_first, " ")
        flat, lens = self.store.gather(at)
        ends = np.concatenate([[0], np.cumsum(lens)])[offsets]
        return flat, np.diff(ends)

    def _mixed(self, texts: pa.Array, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Some texts as a whole, the others by chunks, in their order."""
        flat, lens = self.encode(texts.filter(pa.array(~whole)))
        cuts = np.concatenate([[0], np.cumsum(lens)])
        out, k = [], 0
        for text, alone in zip(texts.to_pylist(), whole, strict=True):
            if alone:
                out.append(self.encode_text(text))
            else:
                out.append(flat[cuts[k]:cuts[k + 1]])
                k += 1
        return np.concatenate(out), np.array([len(x) for x in out], np.int64)


#: letters for which lower-casing and normal forms are one to one
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PUNCT = "!-&(-/:-@\\[-`{-~"          # ASCII punctuation without the apostrophe

#: fixed value: how byte-level BPE vocabularies of this kind cut texts
BYTE_LEVEL_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of the byte-level alphabet: printable Latin-1 stands
    for itself, the other bytes follow from U+0100 in their order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class LibraryEncoder(ChunkEncoder):
    """Chunk table over a ``tokenizers`` file.

    Missing chunks that are plain are joined and encoded in one call by a
    faster BPE over the file's own vocabulary and merge order; all others, and
    whole texts, go to the library."""

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_file(path)
        self.special = [t["content"] for t in json.loads(self.lib.to_str())["added_tokens"]]
        self.fast = self.fast_bpe()

    def fast_bpe(self):
        raise NotImplementedError

    def encode_text(self, text: str) -> np.ndarray:
        return np.array(self.lib.encode(text, add_special_tokens=False).ids, np.uint32)

    def alone(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in self.lib.encode_batch_fast(keys, add_special_tokens=False)]
        lens = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter((i for ids in got for i in ids), np.uint32, int(lens.sum())), lens

    def plain(self, key: str) -> bool:
        raise NotImplementedError

    def together(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raise NotImplementedError

    def encode_keys(self, keys):
        plain = [self.plain(k) and not any(s in k for s in self.special) for k in keys]
        if all(plain):
            return self.together(keys)
        odd, odd_lens = self.alone([k for k, p in zip(keys, plain, strict=True) if not p])
        flat, lens = self.together([k for k, p in zip(keys, plain, strict=True) if p])
        plain = np.array(plain, bool)
        every = np.zeros(len(keys), np.int64)
        every[plain], every[~plain] = lens, odd_lens
        out, at = np.zeros(int(every.sum()), np.uint32), np.repeat(plain, every)
        out[at], out[~at] = flat, odd
        return out, every


class WordEndEncoder(LibraryEncoder):
    """BPE with word ends that drops white space: no ids between chunks.

    For the fast BPE a NUL stands behind each pre-token as its end mark; one
    byte with the mark merges before all else, as the file's alphabet has it."""

    _fits = re.compile(f"[{_LETTERS}{_PUNCT}]+").fullmatch
    _words = re.compile(f"[{_LETTERS}]+|[{_PUNCT}]+")

    def fast_bpe(self):
        import tiktoken
        bytes_of, ranks, self.id_of = byte_alphabet(), {}, np.zeros(self.lib.get_vocab_size() + 256, np.uint32)
        special = set(self.special)
        for piece, i in sorted(self.lib.get_vocab().items(), key=lambda x: x[1]):
            if piece not in special:
                end = piece.endswith("</w>") and len(piece) > 4
                raw = bytes(bytes_of[c] for c in (piece[:-4] if end else piece)) + b"\0" * end
                rank = raw[0] if len(raw) == 1 else raw[0] + 256 if len(raw) == 2 and end else i
                ranks[raw] = rank
                self.id_of[rank] = i
        return tiktoken.Encoding("word-ends", pat_str=r"[^\x00\n]+\x00|\n", mergeable_ranks=ranks, special_tokens={})

    def plain(self, key):
        return self._fits(key) is not None

    def together(self, keys):
        text = self._words.sub("\\g<0>\0", "\n".join(keys).lower()) + "\n" * bool(keys)
        ids = np.array(self.fast.encode_ordinary(text), np.int64)
        cuts = np.flatnonzero(ids == 10)
        return self.id_of[np.delete(ids, cuts)], np.diff(cuts, prepend=-1) - 1


class ByteLevelEncoder(LibraryEncoder):
    """Byte-level BPE: a space belongs to the chunk after it.  A cut before a
    space is exact unless the space stands between white space (or white space
    and the end); such texts are encoded whole."""

    first_differs = True
    _unsafe = "[^\\x21-\\x7E\\p{L}\\p{N}] ([^\\x21-\\x7E\\p{L}\\p{N}]|$)"
    _fits = re.compile(f"[0-9'{_LETTERS}{_PUNCT}]+").fullmatch

    def fast_bpe(self):
        import tiktoken
        bytes_of = byte_alphabet()
        ranks = {bytes(bytes_of[c] for c in p): i for p, i in self.lib.get_vocab().items() if p not in self.special}
        self.line = ranks[b"\n"]
        return tiktoken.Encoding("byte-level", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def whole(self, texts):
        return pc.match_substring_regex(texts, self._unsafe).to_numpy(zero_copy_only=False).astype(bool)

    def plain(self, key):
        return self._fits(key, key[:1] == " ") is not None

    def encode_keys(self, keys):
        return super().encode_keys([" " + k for k in keys])

    def encode_first(self, keys):
        return super().encode_keys(keys)

    def together(self, keys):
        ids = np.array(self.fast.encode_ordinary("\n".join(keys) + "\n" * bool(keys)), np.int64)
        cuts = np.flatnonzero(ids == self.line)
        return np.delete(ids, cuts).astype(np.uint32), np.diff(cuts, prepend=-1) - 1


class SentencePieceEncoder:
    """Chunk table over a SentencePiece model with a dummy prefix, identity
    normalizer and no piece with a marker behind another character.

    Every marked word (marker run and what follows) is segmented once; text
    and literal markers are the same to the library, so both count as spaces."""

    def __init__(self, path: str):
        import sentencepiece
        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        self.store = Store()
        self.marker = [self.lib.piece_to_id("▁")]      # a lone marker, at the end of a text
        crossing = [p for p in map(self.lib.id_to_piece, range(self.lib.get_piece_size()))
                    if "▁" in p.lstrip("▁")]
        if crossing:
            raise ValueError("pieces cross whitespace markers; the chunk table would not be exact")
        self.pieces = Store()                          # id -> bytes
        size = self.lib.get_piece_size()
        raw = [bytes([int(p[1:-1], 16)]) if self.lib.is_byte(i) else p.replace("▁", " ").encode()
               for i, p in zip(range(size), map(self.lib.id_to_piece, range(size)), strict=True)]
        self.pieces.add(np.frombuffer(b"".join(raw), np.uint8), np.array([len(x) for x in raw]))

    _runs = re.compile(" +[^ ]+| +").findall

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of each."""
        if self.store.full():
            self.store.clear()
        plain = pc.replace_substring(texts, "▁", " ")
        runs = pc.match_substring_regex(plain, "^ |  | $").to_numpy(zero_copy_only=False).astype(bool)
        parts = pc.split_pattern(plain, " ")
        if runs.any():                     # keep runs of spaces with the word behind them
            parts = pa.array([[c[1:] for c in self._runs(" " + t)] if r else t.split(" ")
                              for t, r in zip(plain.to_pylist(), runs, strict=True)], pa.list_(pa.string()))
        offsets = parts.offsets.to_numpy().astype(np.int64)
        coded = parts.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        offsets = offsets - offsets[0]
        keys = coded.dictionary.to_pylist()
        index = self.store.index
        at = np.fromiter(map(index.get, keys, repeat(-1)), np.int64, len(keys))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            new = [keys[i] for i in missing]
            ids = [x if k else self.marker for k, x in zip(new, self.lib.encode(new, num_threads=1), strict=True)]
            lens = np.fromiter(map(len, ids), np.int64, len(ids))
            first = self.store.add(np.fromiter((i for x in ids for i in x), np.uint32, int(lens.sum())), lens)
            at[missing] = np.arange(first, first + len(new))
            index.update(zip(new, range(first, first + len(new))))
            self.store.chars += sum(map(len, new))
        flat, lens = self.store.gather(at[coded.indices.to_numpy()])
        counts = np.diff(np.concatenate([[0], np.cumsum(lens)])[offsets])
        if (empty := pc.equal(pc.binary_length(plain), 0).to_numpy(zero_copy_only=False)).any():
            flat = flat[np.repeat(~empty, counts)]     # an empty text has no marker
            counts = np.where(empty, 0, counts)
        return flat, counts

    def decode(self, flat: np.ndarray, counts: np.ndarray) -> pa.Array:
        """Texts of id lists: the bytes of their pieces, without the dummy prefix."""
        out, lens = self.pieces.gather(flat.astype(np.int64))
        ends = np.concatenate([[0], np.cumsum(lens)])[np.concatenate([[0], np.cumsum(counts)])]
        texts = pa.LargeStringArray.from_buffers(len(counts), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(out.astype(np.uint8)))
        return pc.utf8_slice_codeunits(texts, 1)


_ENCODERS: dict = {}


def encoder(kind: type, path: str):
    """One encoder, and so one table, per worker process and file."""
    if (kind, path) not in _ENCODERS:
        _ENCODERS[kind, path] = kind(path)
    return _ENCODERS[kind, path]
