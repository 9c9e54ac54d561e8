"""Token ids of whole texts with the tokenizers library, through a bounded table of pieces.

Texts are cut where no pre-token goes across, so equal pieces are encoded once per worker:
before the last blank ahead of a word, and between letters and ASCII marks.  Pieces of plain
letters go to the library's BPE model directly, all others through its whole pipeline.
"""

from __future__ import annotations

import gc
import os
import re
from array import array
from collections.abc import Callable, Sequence
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEEN_PIECES = 700_000  # some 150 bytes each
SEEN_LETTERS = 16_000_000  # of all kept pieces: texts without blanks make long ones
CACHE_PIECES = 350_000  # of the newer table; as many older entries are kept beside it
TEXT_BYTES = 4 << 20  # of texts encoded at once: the more, the fewer pieces are looked up twice
_CONTROL = re.compile("[\x1c-\x1f]")
_SPLIT = re.compile(r"[^\S\x1c-\x1f]+")
_MARKS = ".,;:!?&%$#*|)"  # a run of these after letters is a pre-token of its own


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE writes each byte as a printable character: itself, or one from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


_LETTERS = _byte_letters()


class Table(dict):
    """A dict that makes what it lacks, with a bounded past: when full, its entries become the older ones."""

    def __init__(self, make: Callable[[str], bytes | None]) -> None:
        self.make, self.older = make, {}

    def __missing__(self, key: str) -> bytes | None:
        if len(self) >= CACHE_PIECES:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(key)
        if ids is None:
            ids = self.make(key)
        self[key] = ids
        return ids


class Seen:
    """Pieces met before, each with its place among the ids kept end to end; bounded by ``SEEN_PIECES`` and ``SEEN_LETTERS``.

    When full, the newer half stays; what one call needs is kept until the next in any case.
    """

    def __init__(self) -> None:
        self.pieces: dict[str, int] = {}
        self.letters = 0  # of all pieces
        self.bounds, self.ids = np.zeros(1, np.int64), np.zeros(0, "<u2")

    def look_up(self, wanted: list[str], make: Callable[[list[str]], list[bytes]]) -> np.ndarray:
        """The place of each of the (different) pieces among the kept ones; new ones are made."""
        at = np.fromiter(map(self.pieces.get, wanted, repeat(-1)), np.int64, len(wanted))
        new, keep = np.flatnonzero(at < 0), len(self.pieces)
        if len(new) and (keep + len(new) > SEEN_PIECES or self.letters > SEEN_LETTERS):
            # what this call needs is made again if it is among the older half
            drop = min(keep, max(-(-keep // 2), keep + len(new) - SEEN_PIECES))
            new, at = np.flatnonzero(at < drop), at - drop
            self.pieces = {p: i for i, p in enumerate(islice(self.pieces, drop, None))}
            self.letters = sum(map(len, self.pieces))
            self.ids, self.bounds = self.ids[self.bounds[drop] :], self.bounds[drop:] - self.bounds[drop]
        if len(new):
            fresh = [wanted[i] for i in new.tolist()]
            made = make(fresh)
            at[new] = len(self.pieces) + np.arange(len(new))
            self.letters += sum(map(len, fresh))
            self.pieces.update(zip(fresh, range(len(self.pieces), len(self.pieces) + len(fresh))))
            sizes = np.fromiter(map(len, made), np.int64, len(made)) // 2
            self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(made), "<u2")])
            self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(sizes)])
        return at

    def joined(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces at these places end to end, and where each starts (one more at the end)."""
        # as strings of bytes, which Arrow gathers whole
        held = [None, pa.py_buffer(2 * self.bounds), pa.py_buffer(self.ids)]
        found = pa.Array.from_buffers(pa.large_binary(), len(self.pieces), held).take(pa.array(at))
        starts = np.frombuffer(found.buffers()[1], np.int64, len(at) + 1) // 2
        return np.frombuffer(found.buffers()[2], "<u2", int(starts[-1])), starts


_LEAD, _TRAIL = 0xFE, 0xFF  # stand for both bytes of a letter from U+00C0 to U+00FF; no UTF-8 text has them


def _pairs() -> np.ndarray:
    """For each two neighbouring bytes: 1 if a text can be cut between them, 2 if before the first."""
    byte = np.arange(256)
    ascii_letter = (byte < 128) & np.array([chr(b).isalpha() for b in byte])
    mark = (byte > 32) & (byte < 127) & ~np.array([chr(b).isalnum() for b in byte])
    blank = ((byte >= 9) & (byte <= 13)) | (byte == 32)
    ends = ascii_letter | mark | (byte == _TRAIL)
    # first bytes of what is never a blank; the others may be one, or may not be the same for all patterns
    solid = ((byte > 32) & (byte < 127)) | ((byte >= 0xC3) & (byte <= 0xE0)) | ((byte >= 0xE4) & (byte <= 0xF4)) | (byte == _LEAD)
    word = blank[:, None] & solid
    between = word & (byte != 32)[:, None]
    between |= ends[:, None] & blank
    between |= (ascii_letter | (byte == _TRAIL))[:, None] & mark
    between |= (mark & (byte != ord("'")))[:, None] & (ascii_letter | (byte == _LEAD))
    return (between + 2 * word).astype(np.uint8).ravel()


_PAIRS = _pairs()


def cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where UTF-8 texts, end to end, can be cut: each side alone gives the pre-tokens of the whole.

    ``starts`` of the texts (one more at the end) are among the cuts.  A run of blanks before a
    word is one pre-token but for its last blank, which belongs to the word if it is a space and
    else stands alone.  Letters and marks share none, but for an apostrophe and what follows it.
    """
    here = np.zeros(len(data) + 1, bool)
    if len(data) > 1:
        first = np.flatnonzero(data[:-1] == 0xC3)
        if len(first):
            first = first[(data[first + 1] != 0x97) & (data[first + 1] != 0xB7)]  # two signs, no letters
            data = data.copy()
            data[first], data[first + 1] = _LEAD, _TRAIL
        pair = data[:-1].astype(np.uint16)
        pair <<= 8
        pair |= data[1:]
        kind = _PAIRS[pair]
        kind[starts[(starts > 0) & (starts < len(data))] - 1] = 0  # neighbours in one text only
        here[:-2] = kind > 1
        kind &= 1
        here[1:-1] |= kind.view(bool)
    here[starts] = True
    return np.flatnonzero(here)


class PieceEncoder:
    """Ids of whole texts as the library gives them without added special tokens.

    ``spaces`` says whether blanks belong to tokens (byte-level files) or are dropped.
    """

    def __init__(self, path: str, spaces: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        if self.library.get_vocab_size() > 1 << 16:
            raise ValueError(f"{path} has {self.library.get_vocab_size()} ids; 16 bits hold 65536")
        self.model = self.library.model
        self.spaces = spaces
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.forget()

    def _whole(self, texts: Sequence[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(list(texts), add_special_tokens=False)
        return [np.array(e.ids, "<u2").tobytes() for e in found]

    def _model(self, letters: str, lead: str = "") -> bytes | None:
        """Ids of ``lead`` and letters up to U+00FF (one pre-token, no change in normal form); None for other letters."""
        if not letters.isascii():
            if max(letters) > "ÿ":
                return None
            letters = letters.encode().decode("latin-1").translate(_LETTERS)
        return array("H", [t.id for t in self.model.tokenize(_LETTERS[32] + letters if lead else letters)]).tobytes()

    def _plain(self, piece: str) -> bytes | None:
        """Ids of letters and closing marks; None for any other piece."""
        body = piece.rstrip(_MARKS)
        if not body.isalpha():
            return None
        letters = body.lower()
        ids = self._model(letters) if letters == piece else self.kept[letters] if letters.isascii() or max(letters) <= "ÿ" else None
        if ids is None or len(body) == len(piece):
            return ids
        return ids + self.tails[piece[len(body) :]]

    def _learn(self, piece: str) -> bytes:
        ids = self._plain(piece)
        return self._whole([piece])[0] if ids is None else ids

    def _pieces(self, text: str) -> list[str]:
        """Words of a text, where blanks are dropped."""
        return [p for p in _SPLIT.split(text) if p] if _CONTROL.search(text) else text.split()

    def encode(self, texts: Sequence[str] | pa.Array) -> list[np.ndarray]:
        """Ids (unsigned, 16 bits) of each text; none may be null."""
        collecting = gc.isenabled()
        gc.disable()  # millions of small objects and no cycles
        try:
            if not self.spaces:
                get = self.kept.__getitem__
                return [np.frombuffer(b"".join(map(get, self._pieces(t))), "<u2") for t in texts]
            return self._encode_cut(texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string()))
        finally:
            if collecting:
                gc.enable()

    def _fresh(self, pieces: list[str]) -> list[bytes]:
        """Ids of new pieces; what only the whole library can tell is asked of it at once."""
        tokenize, space, out, asked = self.model.tokenize, _LETTERS[32], [], []
        for p in pieces:
            letters = p[1:] if p[0] == " " else p
            ids = None
            if letters.isalpha():
                if letters.isascii():
                    ids = array("H", [t.id for t in tokenize(space + letters if p[0] == " " else p)]).tobytes()
                else:
                    ids = self._model(letters, p[0] == " ")
            if ids is None:
                asked.append(len(out))
            out.append(ids)
        for i, ids in zip(asked, self._whole([pieces[i] for i in asked])):
            out[i] = ids
        return out

    def _encode_cut(self, texts: pa.Array) -> list[np.ndarray]:
        """Look up each different piece of all texts once and gather the ids, in Arrow."""
        if not len(texts):
            return []
        starts = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        held = texts.buffers()[2]
        data = np.frombuffer(held, np.uint8)[starts[0] : starts[-1]] if held and starts[-1] > starts[0] else np.zeros(0, np.uint8)
        starts = starts - starts[0]
        at = cuts(data, starts)
        coded = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(data)).dictionary_encode()
        place = self.seen.look_up(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), self._fresh)
        ids, ends = self.seen.joined(place[coded.indices.to_numpy()])
        bounds = ends[np.searchsorted(at, starts)].tolist()
        out = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        whole = data.tobytes()
        for own in self.added:  # no piece of its text may be cut off such a token
            if own.encode() in whole:
                for i in np.flatnonzero(pc.match_substring(texts, own).to_numpy(zero_copy_only=False)).tolist():
                    out[i] = np.frombuffer(self._whole([texts[i].as_py()])[0], "<u2")
        return out

    def forget(self) -> None:
        """Free the tables when a task ends; workers outlive their tasks."""
        self.kept = self.bare = Table(self._learn)
        self.seen = Seen()
        self.tails = Table(lambda marks: self._whole([marks])[0])


_ENCODERS: dict[tuple[str, bool], PieceEncoder] = {}


def encoder(path: str, spaces: bool) -> PieceEncoder:
    """One encoder per worker process and file."""
    if (path, spaces) not in _ENCODERS:
        _ENCODERS[path, spaces] = PieceEncoder(path, spaces)
    return _ENCODERS[path, spaces]
