"""Exact token ids of whole texts with the ``tokenizers`` library and a bounded cache of text pieces.

Encoding a text in one library call repeats the same words over and over. Both vocabularies used here
tokenize a text piecewise: no token crosses the border between a visible character and a blank. So a
text is cut at single blanks, each distinct piece is encoded by the library once per worker, and the
ids of a text are the joined ids of its pieces. Texts for which a cut might matter (runs of blanks,
unusual white space, special-token strings) go to the library whole, cut only at safe blanks. A
tokenizer of any other make-up is always given the whole text.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from collections.abc import Iterable

import numpy as np

# Pieces of letters and ASCII signs for which Python's character classes are those of the tokenizer.
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(rf"[ \n]?[!-~{_LETTER}]+")
_LETTERS = re.compile(rf"[{_LETTER}]+")
_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
_BYTE_LEVEL_SPLIT = re.compile(rf"{_CONTRACTIONS}| ?[{_LETTER}]+| ?[0-9]+| ?[^\s0-9{_LETTER}]+|\s")
_WORD_SPLIT = re.compile(rf"{_CONTRACTIONS}|[{_LETTER}]+|[0-9]|[^0-9{_LETTER}]+")
# Invisible characters that some Unicode tables count as blanks: texts with them are not cut into pieces.
_DOUBTFUL = ("\u180e", "\u200b", "\ufeff")
_SAFE_CUT = re.compile(r"(?<=[!-~])(?= [!-~])")

SEGMENT_CHARS = 1 << 18


def _byte_chars() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars, extra = {}, 256
    for b in range(256):
        if b in keep:
            chars[b] = chr(b)
        else:
            chars[b] = chr(extra)
            extra += 1
    return [chars[b] for b in range(256)]


class _Pieces(dict):
    """piece -> ids as bytes; a missing piece is taken from the older generation or encoded."""

    def __init__(self, encode, older: dict):
        super().__init__()
        self.encode, self.older = encode, older

    def __missing__(self, piece):
        ids = self.older.get(piece)
        if ids is None:
            ids = self.encode(piece)
        self[piece] = ids
        return ids


class Encoder:
    """Ids of whole texts, as little-endian bytes of ``dtype`` (two bytes an id where they fit).

    ``cache_pieces`` bounds each of the two cache generations; it changes speed, never ids.
    """

    def __init__(self, tokenizer_json: str, cache_pieces: int = 200_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(tokenizer_json)
        self.library.no_truncation()
        self.library.no_padding()
        self.dtype = np.dtype("<u2" if id_width(tokenizer_json) == 2 else "<u4")
        self.cache_pieces = cache_pieces
        self.kind = _kind(json.loads(tokenizer_json))
        special = [t["content"] for t in json.loads(tokenizer_json).get("added_tokens") or []]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.chars = chars = _byte_chars()
        self.mapping = {c: "".join(chars[b] for b in chr(c).encode()) for c in range(256)}
        self.code = {2: "H", 4: "I"}[self.dtype.itemsize]
        self.marks: dict[str, bytes] = {}
        make = {"byte_level": self._byte_level_piece, "words": self._word_piece}.get(self.kind)
        self.pieces = _Pieces(make, {}) if make else None

    def encode(self, text: str | None) -> bytes:
        text = text or ""
        if len(text) <= SEGMENT_CHARS or not self.kind:
            return self._segment(text)
        return b"".join(map(self._segment, _segments(text)))

    def count(self, text: str | None) -> int:
        return len(self.encode(text)) // self.dtype.itemsize

    def _segment(self, text: str) -> bytes:
        if not self.kind or (self.special and self.special.search(text)):
            return self._whole(text)
        # A text may start with a blank only where a longer text was cut before a space.
        led = self.kind == "byte_level" and text[:1] == " "
        body = text[1:] if led else text
        words = body.split()
        blanks = len(body) - sum(map(len, words))
        if not body.isascii() and any(c in body for c in _DOUBTFUL):
            return self._whole(text)
        if self.kind == "byte_level":
            # Every blank a single inner space or line feed, else the cut might matter.
            if (led and not body) or body and (blanks != len(words) - 1 or blanks != body.count(" ") + body.count("\n")):
                return self._whole(text)
            pieces = words if "\n" not in body else body.replace("\n", " \n").split(" ")
            if not led:
                pieces = pieces or [""]
                pieces[0] = "\r" + pieces[0]
        else:
            if blanks != body.count(" ") + body.count("\n") + body.count("\t") + body.count("\r"):
                return self._whole(text)
            pieces = words
        ids = b"".join(map(self.pieces.__getitem__, pieces))
        if len(self.pieces) > self.cache_pieces:
            self.pieces = _Pieces(self.pieces.encode, dict(self.pieces))
        return ids

    def _bytes(self, ids: Iterable[int]) -> bytes:
        return np.fromiter(ids, self.dtype).tobytes()

    def _whole(self, text: str) -> bytes:
        """By the library alone; long texts in parts cut where no token can cross."""
        parts = _segments(text, 1 << 14) if self.kind and len(text) > 1 << 14 else [text]
        return b"".join(self._bytes(self.library.encode(p, add_special_tokens=False).ids) for p in parts)

    def _pretoken(self, pretoken: str) -> bytes:
        """Ids of one pre-token, by the library's model."""
        mapped = pretoken.replace(" ", self.mapping[32]) if pretoken.isascii() and pretoken.isprintable() else pretoken.translate(self.mapping)
        ids = array(self.code, [t.id for t in self.library.model.tokenize(mapped)])
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def _mark(self, pretoken: str) -> bytes:
        """The same through a small cache, for the signs and digits around words."""
        ids = self.marks.get(pretoken)
        if ids is None:
            if len(self.marks) > 50_000:
                self.marks.clear()
            ids = self.marks[pretoken] = self._pretoken(pretoken)
        return ids

    def _byte_level_piece(self, piece: str) -> bytes:
        """``\\r`` marks the start of a text; a piece not after a line feed follows a space."""
        if piece.isalpha() and (piece.isascii() or _LETTERS.fullmatch(piece)):
            return self._pretoken(" " + piece)
        text = piece[1:] if piece[:1] == "\r" else piece if piece[:1] == "\n" else " " + piece
        if _PLAIN.fullmatch(text):
            parts = _BYTE_LEVEL_SPLIT.findall(text)
            # A word led by a space is a piece of its own; it is cached as such.
            return b"".join([self.pieces[p[1:]] if p[0] == " " and p[1:].isalpha() and len(parts) > 1 else self._mark(p) for p in parts])
        return self._bytes(self.library.encode(text, add_special_tokens=False).ids) if text else b""

    def _word_piece(self, piece: str) -> bytes:
        if piece.isalpha() and (piece.isascii() or _LETTERS.fullmatch(piece)):
            return self._pretoken(piece.lower())
        if _PLAIN.fullmatch(piece):
            parts = _WORD_SPLIT.findall(piece.lower())
            return b"".join([self.pieces[p] if len(p) > 2 and p != piece and p.isalpha() else self._mark(p) for p in parts])
        return self._bytes(self.library.encode(piece, add_special_tokens=False).ids)


def _segments(text: str, chars: int = SEGMENT_CHARS) -> list[str]:
    """The text in parts of about ``chars``, cut only between a visible ASCII sign and ' x'."""
    parts, start = [], 0
    while len(text) - start > chars:
        cut = _SAFE_CUT.search(text, start + chars)
        if cut is None:
            break
        parts.append(text[start:cut.start()])
        start = cut.start()
    return [*parts, text[start:]]


def _kind(spec: dict) -> str | None:
    """How texts may be cut: ``byte_level``, ``words`` or not at all (None)."""
    if spec["model"].get("dropout") or spec["model"]["type"] != "BPE":
        return None
    if any(t.get("normalized") or t.get("lstrip") or t.get("rstrip") or " " in t["content"]
           for t in spec.get("added_tokens") or []):
        return None
    pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer") or {}
    if not norm and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
        return "byte_level"
    steps = [s.get("type") for s in norm.get("normalizers") or []]
    parts = pre.get("pretokenizers") or []
    if (steps == ["NFC", "Replace", "Lowercase"] and [p.get("type") for p in parts] == ["Split", "ByteLevel"]
            and parts[0].get("invert") and parts[0].get("behavior") == "Removed"
            and parts[0]["pattern"].get("Regex") == _CONTRACTIONS + r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
            and not parts[1].get("use_regex") and not parts[1].get("add_prefix_space")):
        return "words"
    return None


def id_width(tokenizer_json: str) -> int:
    """Bytes that hold every id of the vocabulary: 2 or 4."""
    spec = json.loads(tokenizer_json)
    vocab = spec["model"].get("vocab") or {}
    ids = [*(vocab.values() if isinstance(vocab, dict) else range(len(vocab))),
           *(t["id"] for t in spec.get("added_tokens") or [])]
    return 2 if max(ids, default=0) < 1 << 16 else 4


_ENCODERS: dict[tuple[int, int], Encoder] = {}


def encoder(tokenizer_json: str, cache_pieces: int = 200_000) -> Encoder:
    """The worker's encoder for a tokenizer: built once, its cache kept from task to task."""
    key = (hash(tokenizer_json), cache_pieces)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(tokenizer_json, cache_pieces)
    return _ENCODERS[key]


def read_tokenizer(path: str) -> str:
    """A tokenizer file's text, read by the driver and shipped to the tasks (a few MB at most)."""
    with open(path, encoding="utf-8") as f:
        return f.read()
