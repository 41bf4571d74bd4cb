"""Token ids of whole texts, through the `tokenizers` library.

Encoding a text unit by unit gives the same ids as encoding it whole, if
the units end where the tokenizer's own pre-tokenizer always ends a piece.
``TextEncoder`` cuts the texts of a chunk at such places, numbers the distinct
units with Arrow's dictionary encoding, gets the ids of units it has not seen
from the library, and puts the texts' ids together with array operations.

* ``style="byte"`` (byte-level BPE, a word keeps the space before it): a
  single space or line break between two non-space characters is a border;
  the space goes to the next unit, the line break is a unit of its own.
* ``style="word"`` (white space dropped): every space or line break is a
  border.

A unit of Latin letters is one piece of both pre-tokenizers, and goes to the
library's model directly; all others go through the whole tokenizer.  Texts with
the string of a special token are encoded whole, by the library's own rules.
"""

from __future__ import annotations

import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .workers import kept, release

# Distinct units kept per Python worker.
CACHE_UNITS = 1_000_000
# Texts are encoded in chunks of about so many bytes.
CHUNK_BYTES = 2_000_000

# Python's white space holds every white-space character of the tokenizers'
# patterns, so a non-space character here is one there too.
_BORDER = re.compile(r"(?<=\S)([ \n])(?=\S)")
# Units of composed Latin letters with one lower-case letter each.
_LETTERS = "\\A[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+\\z"
_SPACE, _LINE, _STOP, _COMMA = b" \n.,"
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
# Stands for the space before a word where pieces are joined by spaces.
_MARK = "\x02"


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE's letter for each byte: itself if it is printable in
    Latin-1, else the next one from 256 on.  The space stays, ``_MARK`` gets its letter."""
    out, free = {}, 256
    for b in range(256):
        if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b:
            out[b] = chr(b)
        else:
            out[b] = chr(free)
            free += 1
    out[ord(_MARK)] = out.pop(_SPACE)
    return out


def _runs(ids: list[int], border: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids without border ids, and the sizes of the runs between these."""
    got = np.array(ids, "<u4")
    at = np.flatnonzero(got == border)
    return np.delete(got, at), np.diff(at, prepend=-1, append=len(got)) - 1


def _filled(sizes: np.ndarray, at: np.ndarray, flat: np.ndarray, pool: np.ndarray,
            starts: np.ndarray) -> None:
    """Put runs of ``flat`` (of the given sizes) into ``pool`` from ``starts[at]`` on."""
    before = np.cumsum(sizes) - sizes
    pool[np.repeat(starts[at] - before, sizes) + np.arange(len(flat))] = flat


class TextEncoder:
    """``encode(texts)`` -> for each, its ids as little-endian uint32 bytes (null: none)."""

    def __init__(self, path: str, style: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        if style not in ("byte", "word"):
            raise ValueError(f"unknown style {style!r}")
        self.byte = style == "byte"
        self.special = [t.content.encode() for t in
                        self.tokenizer.get_added_tokens_decoder().values()]
        # the model alone, for pieces that are parted by spaces
        self.pieces = Tokenizer(self.tokenizer.model)
        self.pieces.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.letters = _byte_letters()
        # between units that are encoded in one call; its single id marks the borders
        self.border = "\n" if self.byte else " \x01 "
        self.border_id, = self.tokenizer.encode(self.border, add_special_tokens=False).ids
        self.line = self._ids("\n")
        self.stops = {ord(c): self._ids(c) for c in ".,"}
        self._forget()

    def _forget(self) -> None:
        # units begin with the byte before them: a space, a line break, or 0 at
        # the beginning of a text (a space always, where white space is dropped),
        # or are a full stop or comma; size -1: not a unit by itself
        self.units = pa.array([], pa.large_binary())
        self.sizes, self.pool = np.zeros(0, np.int64), np.zeros(0, "<u4")

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes] = []
        chunk: list[bytes] = []
        size = 0
        for t in texts:
            chunk.append((t or "").encode())
            size += len(chunk[-1])
            if size >= CHUNK_BYTES:
                out.extend(self._chunk(chunk))
                chunk, size = [], 0
        return out + self._chunk(chunk)

    def _chunk(self, raws: list[bytes]) -> list[bytes]:
        if not raws:
            return []
        joined = b"\0" + b"\0".join(raws)
        data = np.frombuffer(joined, np.uint8)
        begins = np.cumsum([0, *(len(r) + 1 for r in raws[:-1])])
        border = (data == _SPACE) | (data == _LINE)
        border[begins] = True
        # a full stop or comma after a letter and before a border is a piece of its own
        stops = np.flatnonzero((data == _STOP) | (data == _COMMA))
        stops = stops[_ASCII_LETTER[data[stops - 1]] & np.append(border, True)[stops + 1]]
        if not self.byte:
            data = np.where(border, np.uint8(_SPACE), data)
        border[stops] = True
        starts = np.flatnonzero(border)
        offsets = np.append(starts, len(data)).astype(np.int64)
        units = pa.Array.from_buffers(pa.large_binary(), len(starts),
                                      [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        numbered = units.dictionary_encode()
        which = self._numbers(numbered.dictionary)[np.asarray(numbered.indices)]
        # all units' ids, and with them those of the texts, by array operations
        sizes = np.maximum(self.sizes, 0)
        n = sizes[which]
        ends = np.cumsum(n)
        flat = self.pool[np.repeat((np.cumsum(sizes) - sizes)[which] - (ends - n), n)
                         + np.arange(int(ends[-1]))].tobytes()
        first = np.searchsorted(starts, begins)
        cuts = (4 * np.append((ends - n)[first], ends[-1])).tolist()
        out = [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        # runs of white space, or white space at an end
        odd = np.searchsorted(first, np.flatnonzero(self.sizes[which] < 0), side="right") - 1
        for i in np.unique(odd).tolist():
            out[i] = self._by_borders(raws[i].decode())
        for token in self.special:
            if token in joined:
                for i, raw in enumerate(raws):
                    if token in raw:
                        out[i] = self._ids(raw.decode()).tobytes()
        return out

    def _numbers(self, units: pa.Array) -> np.ndarray:
        """Numbers of distinct units in the table, which learns those it lacks."""
        if len(self.units) > CACHE_UNITS:
            self._forget()
        at = pc.index_in(units, value_set=self.units)
        fresh = units.filter(at.is_null())
        out = np.asarray(at.fill_null(-1)).astype(np.int64)
        if len(fresh):
            sizes, pool = self._learn(fresh.to_pylist())
            out[out < 0] = len(self.units) + np.arange(len(fresh))
            self.units = pa.concat_arrays([self.units, fresh])
            self.sizes, self.pool = np.append(self.sizes, sizes), np.append(self.pool, pool)
        return out

    def _learn(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and ids of new units."""
        words = [u[1:].decode() for u in units]
        kinds = np.frombuffer(b"".join(u[:1] for u in units), np.uint8)
        letters = np.asarray(pc.match_substring_regex(pa.array(words, pa.large_string()), _LETTERS)
                             .to_numpy(zero_copy_only=False))
        spaced = (kinds == _SPACE) & self.byte
        alone = np.zeros(len(units), bool)
        rest = []
        for i in np.flatnonzero(~letters).tolist():
            word = words[i]
            if units[i][0] in self.stops:
                continue
            if self.byte and (not word or word[0].isspace() or word[-1].isspace()):
                alone[i] = True
            elif word:
                rest.append(i)
        runs = [self._letters_ids(words, spaced, np.flatnonzero(letters))]
        for prefix, own in ((" ", [i for i in rest if spaced[i]]),
                            ("", [i for i in rest if not spaced[i]])):
            runs.append((np.array(own, np.int64), *self._other_ids(prefix, [words[i] for i in own])))
        sizes = np.zeros(len(units), np.int64)
        for at, _, n in runs:
            sizes[at] = n
        fixed = [(np.flatnonzero(kinds == k), ids) for k, ids in self.stops.items()]
        if self.byte:  # the line break before a unit
            fixed.append((np.flatnonzero((kinds == _LINE) & ~alone), self.line))
        for at, ids in fixed:
            sizes[at] += len(ids)
        starts = np.cumsum(sizes) - sizes
        pool = np.zeros(int(sizes.sum()), "<u4")
        for at, ids in fixed:
            for k, x in enumerate(ids):
                pool[starts[at] + k] = x
            starts[at] += len(ids)
        for at, flat, n in runs:
            _filled(n, at, flat, pool, starts)
        return np.where(alone, -1, sizes), pool

    def _letters_ids(self, words: list[str], spaced: np.ndarray, at: np.ndarray
                     ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Units that are one piece of letters, by the model in one call."""
        if not len(at):
            return at, self.pool[:0], np.zeros(0, np.int64)
        text = f" {self.border.strip(' ')} ".join(
            [_MARK + words[i] if spaced[i] else words[i] for i in at.tolist()])
        text = (text if self.byte else text.lower()).encode().decode("latin-1")
        got = self.pieces.encode_batch_fast([text.translate(self.letters)], add_special_tokens=False)
        return at, *_runs(got[0].ids, self.border_id)

    def _other_ids(self, prefix: str, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Units that are not of letters alone, by the whole tokenizer."""
        if not words:
            return self.pool[:0], np.zeros(0, np.int64)
        got = self.tokenizer.encode_batch_fast(
            [prefix + (self.border + prefix).join(words)], add_special_tokens=False)
        flat, sizes = _runs(got[0].ids, self.border_id)
        if len(sizes) != len(words):  # a unit holds a border itself
            parts = [self._ids(prefix + w) for w in words]
            flat, sizes = np.concatenate(parts), np.array([len(x) for x in parts])
        return flat, sizes

    def _by_borders(self, text: str) -> bytes:
        if not text:
            return b""
        def one(unit: str) -> bytes:
            return self._ids(unit).tobytes()

        parts = _BORDER.split(text)
        out = [one(parts[0])]
        for border, unit in zip(parts[1::2], parts[2::2], strict=True):
            out.append(one(" " + unit) if border == " " else self.line.tobytes() + one(unit))
        return b"".join(out)


def crc32(ids: bytes) -> int:
    """Unsigned crc32 of ids that are little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids) & 0xFFFFFFFF


def encoder(path: str, style: str) -> TextEncoder:
    """The worker's encoder for a tokenizer file (kept for its next tasks); what
    other operators left in the worker goes first."""
    def make() -> TextEncoder:
        release()
        return TextEncoder(path, style)

    return kept(("encoder", path, style), make)
