"""Public tokenizers inside tasks, with remembered words.

Three tokenizers are used, and none joins anything across the start of a new word, so the ids of a text are those of
its words one after the other. Texts of ordinary letters, digits and marks are cut into words here, by the same
pattern as the tokenizer's own. Texts are handled some megabytes at a time: Arrow splits them at spaces and numbers
the distinct parts, each distinct part is tokenized once, and numpy lays out the ids. Words are remembered between
batches. Any other text goes to the tokenizer as it is, or in its space-separated parts.

A long text is handled a stretch at a time; a stretch ends before a space between two letters, where all three
tokenizers begin anew.
"""

from __future__ import annotations

import importlib.util
import itertools
import os
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

FOLDER = "/opt/tokenizers"
WORD_BPE, BYTE_BPE, PIECE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"
REMEMBERED = 400_000  # words that a Python worker remembers per tokenizer, at most
STRETCH = 1 << 20  # characters, about
BATCH = 8 << 20  # characters whose parts are numbered together, about

# The byte alphabet of byte-level tokenizers (printable bytes stand for themselves, others follow 255)
# and their contractions.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SHIFTED = [b for b in range(256) if b not in _SHOWN]
BYTE_CHARS = [chr(b) if b in _SHOWN else chr(256 + _SHIFTED.index(b)) for b in range(256)]
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"

# Ordinary characters: none changes under NFC, and lower-casing one gives one.
_BLANK, _LETTER = " \\t\\n\\r", "A-Za-zÀ-ÖØ-öø-įı-ſ"
ORDINARY = re.compile(f"[{_BLANK}!-~{_LETTER}¡£¥§©«®°±·»¿×÷‐-‧]*")
WORD = re.compile(f"{CONTRACTIONS}|[{_LETTER}]+|[0-9]|[^{_BLANK}{_LETTER}0-9]+")
SPACED = re.compile(f"{CONTRACTIONS}| ?[{_LETTER}]+| ?[0-9]+| ?[^{_BLANK}{_LETTER}0-9]+|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+")
CUT = re.compile("(?<=[A-Za-z])(?= [A-Za-z])")


def tokenizer_path(name: str = WORD_BPE, folder: str = FOLDER) -> str:
    """The place of a public tokenizer, which the folder's own module knows."""
    spec = importlib.util.spec_from_file_location("public_tokenizers", os.path.join(folder, "__init__.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module.path(name)


def stretches(text: str, size: int = STRETCH) -> Iterator[str]:
    at = 0
    while len(text) - at > 2 * size and (cut := CUT.search(text, at + size)):
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:] if at else text


class Remembered(dict):
    """Values found once per key."""

    def __init__(self, find: Callable):
        super().__init__()
        self.find = find

    def __missing__(self, key):
        value = self[key] = self.find(key)
        return value

    def trim(self) -> Remembered:
        """The older half stays where there are too many: frequent words come early."""
        if len(self) > REMEMBERED:
            kept = list(itertools.islice(self.items(), REMEMBERED // 2))
            self.clear()
            self.update(kept)
        return self


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def shown(word: str) -> str:
    return word if word.isascii() and " " not in word and word.isprintable() else "".join([BYTE_CHARS[b] for b in word.encode()])


class Ids:
    """Ids of texts. Subclasses know the parts of an ordinary text and how to tokenize any other."""

    prefix = ""  # what stands in front of a text
    bytes: list[bytes]  # of each id
    exact = True  # whether all words so far were given back byte by byte

    def checked(self, word: str, ids: list[int]) -> bytes:
        if b"".join([self.bytes[i] for i in ids]) != word.encode():
            self.exact = False
        return packed(ids)

    def ordinary(self, stretch: str) -> bool:
        """Whether the ids are those of the space-separated parts."""
        raise NotImplementedError

    def of_parts(self, parts: list[str]) -> list[bytes]:
        raise NotImplementedError

    def whole(self, stretch: str) -> bytes:
        raise NotImplementedError

    def lay_out(self, items: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all items one after the other, and how many each has."""
        plain = [self.ordinary(s) for s in items]
        split = pc.split_pattern(pa.array([self.spread(s) if p else "" for s, p in zip(items, plain)], pa.large_string()), " ")
        coded = split.flatten().dictionary_encode()
        offsets, part = split.offsets.to_numpy(), coded.indices.to_numpy()
        values = self.of_parts(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        if not all(plain):
            part = part.copy()
            for i, (s, p) in enumerate(zip(items, plain)):
                if not p:  # its only part is the item itself
                    part[offsets[i]] = len(values)
                    values.append(self.whole(s))
        size = np.array([len(v) // 4 for v in values], np.int64)
        first = np.cumsum(size) - size
        pool = np.frombuffer(b"".join(values), "<u4")
        n = size[part]
        ends = np.cumsum(n)
        out = pool[np.repeat(first[part] - (ends - n), n) + np.arange(ends[-1] if len(n) else 0)]
        total = np.r_[0, ends][offsets]
        return out, np.diff(total)

    def spread(self, stretch: str) -> str:
        """What is split at spaces."""
        return stretch[len(self.prefix):]

    def encode(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of some texts one after the other, and how many each has; then of the next texts. A null text is
        empty."""
        held, n, items, owner, size = [], [], [], [], 0
        for t in texts:
            n.append(0)
            for s in stretches(self.prefix + (t or "")):
                items.append(s)
                owner.append(len(n) - 1)
                size += len(s)
                if size >= BATCH:
                    self._flush(held, n, items, owner)
                    size = 0
            if held:
                self._flush(held, n, items, owner)
                yield np.concatenate(held), np.array(n)
                held, n, size = [], [], 0
        if n:
            self._flush(held, n, items, owner)
            yield np.concatenate(held), np.array(n)

    def _flush(self, held: list, n: list, items: list, owner: list) -> None:
        if items:
            ids, counts = self.lay_out(items)
            held.append(ids)
            for i, c in zip(owner, counts.tolist()):
                n[i] += c
            items.clear()
            owner.clear()


class WordIds(Ids):
    """The lower-casing word tokenizer, which drops white space. Its special tokens in a text are taken as such."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        model = self.tokenizer.model
        self.words = Remembered(lambda w: packed([t.id for t in model.tokenize(shown(w))]))
        self.mixed = Remembered(lambda p: b"".join(map(self.words.__getitem__, WORD.findall(p))))

    def ordinary(self, stretch):
        return "<|" not in stretch and ORDINARY.fullmatch(stretch) is not None

    def spread(self, stretch):
        return stretch.lower()

    def of_parts(self, parts):
        words, mixed = self.words.trim().__getitem__, self.mixed.trim().__getitem__
        return [words(p) if p.isalpha() else mixed(p) for p in parts]

    def whole(self, stretch):
        parts = stretch.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        found = self.tokenizer.encode_batch_fast(list(filter(None, parts)), add_special_tokens=False)
        return b"".join([packed(e.ids) for e in found])


class ByteIds(Ids):
    """The byte-level tokenizer on a space and the text; strings of special tokens are ordinary text."""

    prefix = " "

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        model, byte = self.tokenizer.model, {c: b for b, c in enumerate(BYTE_CHARS)}
        self.words = Remembered(lambda w: self.checked(w, [t.id for t in model.tokenize(shown(w))]))
        self.mixed = Remembered(lambda p: b"".join(map(self.words.__getitem__, SPACED.findall(p))))
        entries = sorted((i, t) for t, i in self.tokenizer.get_vocab().items())
        self.bytes = [b""] * (entries[-1][0] + 1)
        for i, t in entries:
            self.bytes[i] = bytes([byte[c] for c in t]) if all(c in byte for c in t) else t.encode()

    def ordinary(self, stretch):
        return "  " not in stretch and ORDINARY.fullmatch(stretch) is not None

    def of_parts(self, parts):
        words, mixed = self.words.trim().__getitem__, self.mixed.trim().__getitem__
        return [words(" " + p) if p.isalpha() else mixed(" " + p) for p in parts]

    def whole(self, stretch):
        return packed(self.tokenizer.encode(stretch, add_special_tokens=False).ids)


class PieceIds(Ids):
    """The piece tokenizer, which adds a space in front itself."""

    prefix = " "

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.pieces = SentencePieceProcessor(model_file=path)
        self.blank, self.words = packed([self.pieces.piece_to_id("▁")]), Remembered(packed)
        self.bytes = []
        for i in range(self.pieces.get_piece_size()):
            p = self.pieces.id_to_piece(i)
            self.bytes.append(bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace("▁", " ").encode())

    def ordinary(self, stretch):
        return "  " not in stretch and ORDINARY.fullmatch(stretch) is not None

    def of_parts(self, parts):
        words = self.words.trim()
        new = [p for p in parts if p not in words]
        if new:
            words.update({p: self.checked(" " + p, ids) for p, ids in zip(new, self.pieces.encode(new, num_threads=1)) if p})
        words[""] = self.blank
        return [words[p] for p in parts]

    def whole(self, stretch):
        return packed(self.pieces.encode(stretch[1:], num_threads=1))


_known: dict = {}


def loaded(kind: type, path: str):
    """A tokenizer of this worker, read once."""
    if (kind, path) not in _known:
        _known[kind, path] = kind(path)
    return _known[kind, path]


def sizes(tokens: list[bytes]) -> np.ndarray:
    return np.array([len(t) for t in tokens], np.int64)
