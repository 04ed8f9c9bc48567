"""Tokenising whole texts with the ``tokenizers`` library, word parts cached.

Both public vocabularies used here split a text into pre-tokens by a pattern
that never lets a pre-token run from a non-space character into a following
space or newline. So a text may be cut before each space or newline that
follows a non-space character, and the ids of the parts, concatenated, are the
ids of the text. Likewise a run of letters may be cut off before ASCII
punctuation or a digit. Parts repeat, so each is encoded once per worker and
kept, as id bytes, in a cache of bounded size.
"""

from __future__ import annotations

import json
import re
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Parts and letter runs kept per worker; further ones are encoded each time.
CACHE_PARTS, CACHE_RUNS = 350_000, 250_000

_GENERAL = re.compile(r"[ \n]*[^ \n]+|[ \n]+$")
_RUN = re.compile(r"( ?)([A-Za-zÀ-ÖØ-öø-ÿ]+)(?=[!-@\[-`{-~]|$)")


def _byte_letters() -> dict[int, str]:
    """Byte -> letter of byte-level vocabularies: printable Latin-1 stands for
    itself, the others follow from U+0100 on (the published rule)."""
    keep = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = iter(range(256))
    return {b: chr(b) if b in keep else chr(256 + next(other)) for b in range(256)}


class PartTokenizer:
    """ids of whole texts, equal to ``Tokenizer.encode(text,
    add_special_tokens=False)`` with special strings read as ordinary text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._full = Tokenizer.from_file(path)
        self._full.encode_special_tokens = True
        self._bare = Tokenizer(self._full.model)   # one letter run = one pre-token
        self._lower = json.loads(self._full.to_str())["normalizer"] is not None
        self._letters = _byte_letters()
        self._parts: dict[str, bytes] = {}
        self._runs: dict[str, bytes] = {"": b""}
        self._tails: dict[str, bytes] = {"": b""}

    # -- encoding of unseen strings

    @staticmethod
    def _ids(tok, strings: list[str]) -> list[bytes]:
        return [struct.pack(f"<{len(ids)}I", *ids)
                for e in tok.encode_batch_fast(strings, add_special_tokens=False)
                for ids in (e.ids,)]

    def _form(self, run: str) -> str:
        """A letter run in the letters of a byte-level vocabulary."""
        if run.isascii():                          # letters, at most one space before
            return run.replace(" ", self._letters[0x20])
        return run.encode().decode("latin-1").translate(self._letters)

    def _encode(self, pieces: list[str]) -> list[bytes]:
        """ids of pieces, each cut into a letter run and the rest if possible."""
        cut = list(map(_RUN.match, pieces))
        heads = ([m[2].lower() if m else "" for m in cut] if self._lower else   # as the vocabulary does
                 [m[0] if m else "" for m in cut])
        tails = [p[m.end():] if m else p for p, m in zip(pieces, cut)]
        runs = self._known(self._runs, heads, self._bare, self._form)
        rest = self._known(self._tails, tails, self._full, str)
        return [a + b for a, b in zip(runs, rest)]

    def _known(self, cache: dict[str, bytes], keys: list[str], tok, form) -> list[bytes]:
        """ids of each key; unseen ones are encoded, once, and kept while there
        is room."""
        got = list(map(cache.get, keys))
        new = list(dict.fromkeys([k for k, g in zip(keys, got) if g is None]))
        if new:
            more = dict(zip(new, self._ids(tok, [form(k) for k in new])))
            got = [more[k] if g is None else g for k, g in zip(keys, got)]
            if len(cache) + len(more) <= CACHE_RUNS:
                cache.update(more)
        return got

    # -- texts

    @staticmethod
    def _piece(part: str) -> str:
        """The piece of text a part of a split at spaces stands for."""
        if part[:1] == "\0":
            return part[1:]                         # first of its text: no space before
        return part if part[:1] == "\n" else " " + part

    def _general(self, text: str) -> bytes:
        """A text with runs of white space: pieces are joined until none but
        the last ends in white space."""
        pieces: list[str] = []
        for piece in _GENERAL.findall(text):
            if pieces and pieces[-1][-1].isspace():
                pieces[-1] += piece
            else:
                pieces.append(piece)
        return b"".join(self._encode(pieces))

    def _look_up(self, parts: list[str]) -> list[bytes]:
        got = list(map(self._parts.get, parts))
        gaps = [i for i, g in enumerate(got) if g is None]
        if gaps:
            new = [parts[i] for i in gaps]
            ids = self._encode([self._piece(p) for p in new])
            for i, g in zip(gaps, ids):
                got[i] = g
            room = CACHE_PARTS - len(self._parts)
            self._parts.update(zip(new[:room], ids[:room]) if room > 0 else ())
        return got

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets): NULL counts as ''."""
        texts = texts.fill_null("")
        marked = pc.binary_join_element_wise("\0", pc.replace_substring(texts, "\n", " \n"), "")
        cut = pc.split_pattern(marked, " ")
        ends = cut.offsets.to_numpy()[1:].astype(np.int64)
        coded = cut.flatten().dictionary_encode()
        parts = coded.dictionary.to_numpy(zero_copy_only=False).tolist()    # beats to_pylist
        index = coded.indices.to_numpy().astype(np.int64)
        # a piece that ends in white space must not be cut off, unless it is the last
        loose = np.fromiter((not p or p[-1].isspace() for p in parts), bool, len(parts))
        bad = loose[index]
        bad[ends - 1] = False
        odd = np.unique(np.searchsorted(ends, np.flatnonzero(bad), side="right"))
        odd = np.union1d(odd, np.flatnonzero(pc.match_substring(texts, "\0").to_numpy(False)))
        got = self._look_up(parts)
        table = np.frombuffer(b"".join(got), "<u4")
        size = np.fromiter(map(len, got), np.int64, len(got)) >> 2
        first = np.cumsum(size) - size
        lens = size[index]
        total = np.concatenate([[0], np.cumsum(lens)])
        at = np.repeat(first[index] - total[:-1], lens) + np.arange(total[-1])
        ids, off = table[at], total[np.concatenate([[0], ends])]
        if len(odd):
            each = np.split(ids, off[1:-1])
            for d in odd.tolist():
                each[d] = np.frombuffer(self._general(texts[d].as_py()), "<u4")
            ids = np.concatenate(each)
            off = np.concatenate([[0], np.cumsum([len(e) for e in each])])
        return ids, off


_LOADED: dict[str, PartTokenizer] = {}


def tokenizer(path: str) -> PartTokenizer:
    """The worker's tokenizer for a vocabulary file (loaded once per worker)."""
    if path not in _LOADED:
        _LOADED.clear()
        _LOADED[path] = PartTokenizer(path)
    return _LOADED[path]
