"""Token ids of texts, the same as the tokenizers library gives for the whole text.

A tokenizer that parts texts before it looks up pieces gives the same ids for a text and for
its parts one by one, so the ids of a part are asked for once and then remembered.  Whether
that holds for a tokenizer file is read from the file; where it does not, and for texts with
any blank or control character besides space and line feed, the whole text goes to the
library.  So do texts that hold an added token where those get their own ids, which is what
the library does unless told otherwise.  Texts in Latin letters are parted just as the tokenizer does; in others, where the
libraries may know different letters, only blanks part words.

Texts of byte-level tokenizers are parted all at once, in UTF-8: numpy finds the places and
Arrow the different pieces, so Python sees each piece once a portion.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterable
from itertools import chain, count, repeat

import numpy as np
import pyarrow as pa
import regex

# Words held by one Python worker, about 200 MB; beyond it the memory starts anew.
MAX_WORDS = 1_200_000
# Texts are looked up in portions of about so many characters.
PORTION = 1 << 20

# Blanks other than space and line feed, control characters, and characters that only some
# engines call blank.
_UNUSUAL = re.compile("[^\\S \n]|[\x00-\x09\x0b-\x1f\x7f-\x9f\u180e\u200b-\u200d\u2060\ufeff]")
# Beyond these letters, which also keep their number when lower-cased and composed.
_NOT_LATIN = re.compile("[^\x00-\u012f\u0131-\u024f]")
# Texts of byte-level tokenizers are, as fewer pieces are looked up in a larger portion.
BYTE_PORTION = 1 << 22
# Stands between words that are encoded together; no such word holds it.
_MARK = "\x01"
_TOGETHER = 4096

# Byte-level tokenizers part a text by
# 's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
# Kinds of bytes there.  Letters are those of _PLAIN; the bytes of all other characters
# beyond ASCII have no kind.
_NO_KIND, _BLANK, _LETTER, _DIGIT, _OTHER = range(5)
_KINDS = bytes(
    _BLANK if chr(b) in " \n" else _LETTER if chr(b).isalpha() else _DIGIT if chr(b).isdigit() else _OTHER
    for b in range(0x80)
) + bytes([_LETTER] * 0x40 + [_NO_KIND] * 3 + [_LETTER] * 7 + [_NO_KIND] * 0x36)
# Pieces, in UTF-8, that such a tokenizer certainly does not part any further.
_PLAIN = re.compile(rb" ?(?:[!-&(-~]++|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|[\xc4-\xc9][\x80-\xbf])+")
# The characters by which such a tokenizer names bytes.
_NAMED = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
_NAMES = np.arange(256, dtype="<u2")
_NAMES[_NAMED] = np.arange(256, 256 + len(_NAMED))
_LINE = chr(_NAMES[ord("\n")])


def _byte_level_cuts(raw: bytes) -> np.ndarray:
    """Before which bytes of a text in UTF-8 every byte-level tokenizer parts it.

    Not all such places: a run of blanks goes with the word after it, unless it is one line
    feed; nothing is parted after an apostrophe, which may begin a short form, nor at
    characters of no kind.  So a piece has the same ids whatever stands around it.
    """
    cut = np.zeros(len(raw) + 1, bool)
    if not raw:
        return cut
    here, kind = np.frombuffer(raw, np.uint8), np.frombuffer(raw.translate(_KINDS), np.uint8)
    if not raw.isascii():
        kind = kind.copy()
        leads = np.flatnonzero((here == 0xC2) | (here >= 0xCA))
        for n, least in ((1, 0xC2), (2, 0xE0), (3, 0xF0)):
            kind[leads[here[leads] >= least] + n] = _NO_KIND
        # The signs for times and divided by lie among the letters.
        signs = np.flatnonzero(here == 0xC3)
        signs = signs[(here[signs + 1] | 0x20) == 0xB7]
        kind[signs] = kind[signs + 1] = _NO_KIND
    blank, known = kind == _BLANK, kind != _NO_KIND
    apart = known[1:] & (known & (here != ord("'")))[:-1]
    cut[1:-1] = (kind[1:] != kind[:-1]) & ~blank[:-1] & (blank[1:] | apart)
    cut[2:-1] |= (here == ord("\n"))[1:-1] & ~blank[:-2] & ~blank[2:]
    return cut


def _class(category: str) -> str:
    """The characters of a category that Latin texts have, lower-cased or not."""
    latin = {c for x in map(chr, range(0x250)) for c in x + x.lower() if not _UNUSUAL.match(c)}
    return "".join(sorted(c for c in latin if unicodedata.category(c)[0] == category))


def _latin_parts(pattern: str):
    """``findall`` of a pattern, for Latin texts whose only blanks are space and line feed.

    There its classes are lists of characters, which the standard library looks up faster.
    """
    listed = {r"\p{L}": _class("L"), r"\p{N}": _class("N"), r"\s": " \n"}

    def spelt(found: re.Match) -> str:
        out = found[0]
        if out == r"\S":
            return r"[^ \n]"
        for name, characters in listed.items():
            out = out.replace(name, characters)
        return out if out[0] == "[" and found[0][0] == "[" else f"[{out}]"

    plain = re.sub(r"\[[^\]]*\]|\\p\{[LN]\}|\\[sS]", spelt, pattern)
    return (regex if re.search(r"\\[pP]", plain) else re).compile(plain).findall


class _Known:
    """Words and their ids, the ids of all words in one array."""

    def __init__(self, id_type: np.dtype) -> None:
        self.places: dict[str | bytes, int] = {}
        self._starts = np.zeros(1, np.int64)
        self._ids = np.zeros(0, id_type)

    def __len__(self) -> int:
        return len(self.places)

    def add(self, words: list[str] | list[bytes], encoded: list[bytes]) -> None:
        if len(words) != len(encoded):
            raise ValueError(f"{len(words)} words gave the ids of {len(encoded)}")
        ids = np.frombuffer(b"".join(encoded), self._ids.dtype)
        sizes = np.array([len(e) for e in encoded], np.int64) // self._ids.itemsize
        self.places.update(zip(words, count(len(self))))
        self._starts = np.concatenate((self._starts, self._starts[-1] + np.cumsum(sizes)))
        self._ids = np.concatenate((self._ids, ids))

    def places_of(self, words: list[str] | list[bytes]) -> np.ndarray:
        """The places of words, -1 for those not known."""
        return np.fromiter(map(self.places.get, words, repeat(-1)), np.int64, len(words))

    def ids_of(self, places: np.ndarray, sizes_of_texts: list[int]) -> list[bytes]:
        """The ids of texts, given as the places of their words and how many each has."""
        last = np.cumsum([0] + sizes_of_texts)
        starts = self._starts[places]
        sizes = self._starts[places + 1] - starts
        ends = np.concatenate(([0], np.cumsum(sizes)))
        ids = self._ids[np.arange(ends[-1]) + np.repeat(starts - ends[:-1], sizes)]
        breaks = ends[last].tolist()
        return [ids[a:b].tobytes() for a, b in zip(breaks, breaks[1:])]


class WordTokenizer:
    """Encodes texts with one tokenizer file, remembering words."""

    def __init__(self, path: str, special_tokens: bool = False) -> None:
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        # Without, the strings of special tokens in a text are ordinary text.
        self._tokenizer.encode_special_tokens = not special_tokens
        config = json.loads(self._tokenizer.to_str())
        added = [t["content"] for t in config.get("added_tokens") or []] if special_tokens else []
        # As such a token may be looked for after the text is normalised, in any case.
        self._added = re.compile("|".join(map(re.escape, added)), re.IGNORECASE) if added else None
        self._line = self._tokenizer.token_to_id(_LINE)
        self._byte_level = self._line is not None and _is_byte_level(config)
        self._split, pattern, self._lower = _splitter(config)
        self._parts = _latin_parts(pattern) if pattern else None
        self.id_type = np.dtype("<u2" if self._tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self._known, self._known_parts = _Known(self.id_type), _Known(self.id_type)
        # A line feed keeps the mark apart from the word before it.
        self._mark = self._tokenizer.encode("a\n" + _MARK, add_special_tokens=False).ids[1:]
        if self._byte_level:
            # For pieces that need not be parted any further, which is most of the library's work.
            self._pieces = Tokenizer(self._tokenizer.model)
        suffix = config["model"].get("end_of_word_suffix")
        self._ends = np.zeros(1 << 8 * self.id_type.itemsize if self.id_type.itemsize == 2 else 0, bool)
        if self._parts and suffix:
            self._ends = np.array([
                (self._tokenizer.id_to_token(i) or "").endswith(suffix)
                for i in range(self._tokenizer.get_vocab_size())
            ])

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """The ids of each text, as the bytes of an array of :attr:`id_type`."""
        out: list[bytes] = []
        portion: list[str] = []
        size = 0
        for text in texts:
            portion.append(text)
            size += len(text)
            if size >= (BYTE_PORTION if self._byte_level else PORTION):
                out += self._portion(portion)
                portion, size = [], 0
        return out + self._portion(portion)

    def _has_added(self, text: str) -> bool:
        if not self._added:
            return False
        return bool(self._added.search(text) or (
            not text.isascii() and self._added.search(unicodedata.normalize("NFC", text))
        ))

    def _whole(self, texts: list[str]) -> list[bytes]:
        encoded = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.id_type).tobytes() for e in encoded]

    def _words(self, words: list[str]) -> list[bytes]:
        """The ids of each word, many words to a call."""
        joined = [
            "".join(f" {w}\n{_MARK}" for w in words[i:i + _TOGETHER]) for i in range(0, len(words), _TOGETHER)
        ]
        out: list[bytes] = []
        width, drop = self.id_type.itemsize, len(self._mark) - 1
        for encoded in self._tokenizer.encode_batch_fast(joined, add_special_tokens=False):
            ids = np.array(encoded.ids, self.id_type)
            ends = np.flatnonzero(ids == self._mark[-1])
            starts = np.concatenate(([0], ends[:-1] + 1))
            raw = ids.tobytes()
            out += [
                raw[a:b] for a, b in zip((starts * width).tolist(), ((ends - drop) * width).tolist())
            ]
        return out

    def _encoded_parts(self, parts: list[str]) -> list[bytes]:
        """The ids of each part, many parts to a call."""
        joined = [" ".join(parts[i:i + _TOGETHER]) for i in range(0, len(parts), _TOGETHER)]
        out: list[bytes] = []
        width = self.id_type.itemsize
        for encoded in self._tokenizer.encode_batch_fast(joined, add_special_tokens=False):
            ids = np.array(encoded.ids, self.id_type)
            ends = np.flatnonzero(self._ends[ids]) + 1
            starts = np.concatenate(([0], ends[:-1]))
            raw = ids.tobytes()
            out += [raw[a:b] for a, b in zip((starts * width).tolist(), (ends * width).tolist())]
        return out

    def _encoded_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece of a byte-level tokenizer's texts, many to a call."""
        out: list[bytes] = [b""] * len(pieces)
        plain = [i for i, p in enumerate(pieces) if _PLAIN.fullmatch(p)]
        rest = list(set(range(len(pieces))).difference(plain))
        for i, ids in zip(rest, self._whole([pieces[i].decode() for i in rest])):
            out[i] = ids
        joined = np.frombuffer(b"\n".join([pieces[i] for i in plain]), np.uint8)
        named = _NAMES[joined].tobytes().decode("utf-16-le").split(_LINE)
        # Ready-parted, and a line feed, which no plain piece has, after each.
        parted = [
            list(chain.from_iterable(zip(named[i:i + _TOGETHER], repeat(_LINE))))
            for i in range(0, len(plain), _TOGETHER)
        ]
        at, width = iter(plain), self.id_type.itemsize
        for e in self._pieces.encode_batch_fast(parted, is_pretokenized=True, add_special_tokens=False):
            ids = np.array(e.ids, self.id_type)
            ends = np.flatnonzero(ids == self._line)
            starts = np.concatenate(([0], ends[:-1] + 1))
            raw = ids.tobytes()
            for a, b, i in zip((starts * width).tolist(), (ends * width).tolist(), at):
                out[i] = raw[a:b]
        return out

    def _cut_at_once(self, texts: list[str]) -> list[bytes]:
        """The ids of a byte-level tokenizer's texts."""
        if len(self._known) > MAX_WORDS:
            self._known = _Known(self.id_type)
        known = self._known
        encoded = [t.encode() for t in texts]
        raw = b"".join(encoded)
        starts = np.cumsum([0] + [len(e) for e in encoded])
        cut = _byte_level_cuts(raw)
        cut[starts] = True
        places = np.flatnonzero(cut)
        found = pa.Array.from_buffers(
            pa.large_binary(), len(places) - 1, [None, pa.py_buffer(places), pa.py_buffer(raw)]
        ).dictionary_encode()
        _, ends, held = found.dictionary.buffers()
        ends = np.frombuffer(ends, np.int64, len(found.dictionary) + 1).tolist() if held else [0]
        held = held.to_pybytes() if held else b""
        pieces = [held[a:b] for a, b in zip(ends, ends[1:])]
        placed = known.places_of(pieces)
        missing = np.flatnonzero(placed < 0)
        if len(missing):
            new = [pieces[i] for i in missing.tolist()]
            placed[missing] = np.arange(len(known), len(known) + len(new))
            known.add(new, self._encoded_pieces(new))
        counts = np.diff(np.searchsorted(places, starts))
        return known.ids_of(placed[found.indices.to_numpy()], counts.tolist())

    def _portion(self, texts: list[str]) -> list[bytes]:
        if self._split is None and not self._byte_level:
            return self._whole(texts)
        out: list[bytes | None] = [None] * len(texts)
        whole = [i for i, t in enumerate(texts) if _unusual(t) or self._has_added(t)]
        for i, ids in zip(whole, self._whole([texts[i] for i in whole])):
            out[i] = ids
        if self._byte_level:
            rest = [i for i, ids in enumerate(out) if ids is None]
            for i, ids in zip(rest, self._cut_at_once([texts[i] for i in rest])):
                out[i] = ids
            return out
        latin = {i for i, t in enumerate(texts) if out[i] is None and (t.isascii() or not _NOT_LATIN.search(t))}
        if self._parts:
            parts = {i: self._parts(texts[i].lower() if self._lower else texts[i]) for i in latin}
            self._known_parts = self._look_up(parts, self._known_parts, self._encoded_parts, out)
        words = {i: self._split(t) for i, t in enumerate(texts) if out[i] is None}
        self._known = self._look_up(words, self._known, self._words, out)
        return out

    def _look_up(self, listed: dict[int, list[str]], known: _Known, together, out: list) -> _Known:
        """The ids of texts, given as lists of words, into ``out``; returns what is known then."""
        if len(known) > MAX_WORDS:
            known = _Known(self.id_type)
        words = list(chain.from_iterable(listed.values()))
        places = known.places_of(words)
        missing = np.flatnonzero(places < 0)
        unknown = [words[i] for i in missing.tolist()]
        new = list(set(unknown))
        if new:
            known.add(new, together(new))
            places[missing] = known.places_of(unknown)
        for i, ids in zip(listed, known.ids_of(places, [len(x) for x in listed.values()])):
            out[i] = ids
        return known


def _unusual(text: str) -> bool:
    # Whatever the pattern finds is not printable, which is quicker to tell.
    return not text.replace("\n", "").isprintable() and bool(_UNUSUAL.search(text))


def _steps(config: dict) -> list[dict]:
    """How a tokenizer parts texts, nothing if its tokens may depend on more than the part."""
    if config["model"].get("type") != "BPE" or config.get("post_processor"):
        return []
    steps = config.get("pre_tokenizer") or {}
    return steps.get("pretokenizers", [steps])


def _is_byte_level(config: dict) -> bool:
    """Whether this tokenizer does no more than parting texts by the byte-level pattern."""
    steps = _steps(config)
    return len(steps) == 1 and steps[0].get("type") == "ByteLevel" and bool(steps[0].get("use_regex")) and not (
        steps[0].get("add_prefix_space") or config.get("normalizer")
    )


def _splitter(config: dict) -> tuple:
    """How this tokenizer's texts fall into words that do not touch each other's tokens.

    A function for any text, a pattern for Latin ones, and whether they are lower-cased first.
    """
    steps = _steps(config)
    if not steps:
        return None, None, False
    first = steps[0]
    drops_blanks = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert")
    known = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
    normalizer = config.get("normalizer") or {"normalizers": []}
    normalizers = normalizer.get("normalizers", [normalizer])
    if drops_blanks and all(n in known for n in normalizers):
        ends = config["model"].get("end_of_word_suffix")
        pattern = first["pattern"].get("Regex") if ends and len(steps) == 2 else None
        return str.split, pattern, known[2] in normalizers
    return None, None, False


_tokenizers: dict[tuple[str, bool], WordTokenizer] = {}


def tokenizer(path: str, special_tokens: bool = False) -> WordTokenizer:
    """One per file and Python worker, so that words stay known between tasks."""
    key = path, special_tokens
    if key not in _tokenizers:
        # A task has one core, so threads of the library's own only cost time.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _tokenizers[key] = WordTokenizer(path, special_tokens)
    return _tokenizers[key]
