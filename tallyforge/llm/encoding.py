"""Token ids of whole texts by a tokenizers file, with the library called once per distinct word of a worker.

White space is dropped by this vocabulary's pre-tokenizer and no token reaches over it, so a text's ids are those of its
space-separated parts in order.  Parts made of letters and closing punctuation, all below U+0100 and in composed form,
go to the library's BPE model directly, as the letters and the punctuation are its pre-tokens; any other part goes
through the library's whole pipeline.  A batch's texts as one stream are cut by Arrow, which asks for each distinct stem once.
"""

from __future__ import annotations

import os
import re
import struct
from functools import lru_cache
from operator import attrgetter
from string import ascii_letters

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Entries of each of a worker's two memos, which bounds its memory.
MEMO, MEMO_LETTERS = 1_000_000, 400_000
#: Parts whose ids are put together at a time.
PARTS = 1 << 20

_CLOSING = ".,;:!?%$&*#|"
_PLAIN = re.compile(rf"([a-zA-Zà-öø-ÿÀ-ÖØ-Þ]+)([{_CLOSING}]*)").fullmatch


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself if printable in Latin-1, else from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + rest.index(b)) for b in range(256)]


#: Packs of up to 31 ids, as almost all words have.
_PACKS = [struct.Struct(f"<{n}H").pack for n in range(32)]


def _packed(ids: list[int]) -> bytes:
    return _PACKS[len(ids)](*ids) if len(ids) < len(_PACKS) else struct.pack(f"<{len(ids)}H", *ids)


class _Memo(dict):
    """What `made` gives for a word, for at most `limit` words.

    Half of them are the newest; when these are full they become the older half, from which a word that is asked again
    comes back.  So frequent words stay, and words that come once go.
    """

    def __init__(self, limit: int):
        self.half, self.older = max(1, limit // 2), {}

    def __missing__(self, word: str) -> bytes:
        out = self.older.get(word)
        if out is None:
            out = self.made(word)
        if len(self) >= self.half:
            self.older = {}
            self.older = dict(self)
            self.clear()
        self[word] = out
        return out


_ID = attrgetter("id")


class _Letters(_Memo):
    """Lower-case letters or punctuation: their ids as little-endian 16-bit bytes."""

    def __init__(self, model):
        super().__init__(MEMO_LETTERS)
        self.tokenize, self.letter = model.tokenize, "".join(_byte_letters())

    def made(self, word: str) -> bytes:
        shown = word if word.isascii() else word.encode().decode("latin-1").translate(self.letter)
        return _packed([*map(_ID, self.tokenize(shown))])


class Encoder(_Memo):
    """Part of a text without spaces: its ids as little-endian 16-bit bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__(MEMO)
        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids of this vocabulary don't fit 16 bits")
        self.letters = _Letters(self.tokenizer.model)

    def made(self, part: str) -> bytes:
        if part.isascii():
            stem = part.rstrip(_CLOSING)
            if stem.isalpha():
                return self.letters[stem.lower()] + (self.letters[part[len(stem) :]] if len(stem) < len(part) else b"")
        elif m := _PLAIN(part):
            return self.letters[m[1].lower()] + (self.letters[m[2]] if m[2] else b"")
        return _packed(self.tokenizer.encode(part, add_special_tokens=False).ids)

    def ids(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))

    def stream(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null: empty), each with end_id behind it, and where each ends; a part is looked up once however often the texts hold it."""
        split = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        parts = split.flatten().dictionary_encode()
        blob, size = self._distinct(parts.dictionary, end_id)
        last = np.cumsum(split.value_lengths().to_numpy() + 1) - 1
        own = np.ones(len(parts) + len(texts), bool)
        own[last] = False
        which = np.full(len(own), len(size) - 1, np.int64)
        which[own] = parts.indices.to_numpy()
        return _gathered(blob, size, which), np.cumsum(size[which])[last]

    def _distinct(self, parts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct parts, one after the other, with end_id behind them, and how many each has.  Stems and closings of ASCII parts are looked up once each."""
        stem = pc.ascii_rtrim(parts, characters=_CLOSING)
        fits = pc.and_(pc.string_is_ascii(parts), pc.ascii_is_alpha(stem))
        stems = pc.ascii_lower(stem.filter(fits)).dictionary_encode()
        closings = pc.ascii_ltrim(parts.filter(fits), characters=ascii_letters).dictionary_encode()
        listed = lambda x: x.to_numpy(zero_copy_only=False).tolist()  # noqa: E731  faster than to_pylist
        ids = [self.letters[w] for w in listed(stems.dictionary)]
        first_closing = len(ids)
        ids += [self.letters[w] if w else b"" for w in listed(closings.dictionary)]
        first_other = len(ids)
        ids += [self[w] for w in listed(parts.filter(pc.invert(fits)))]
        ids += [_packed([end_id]), b""]
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 2
        fit = fits.to_numpy(zero_copy_only=False)
        pairs = np.full((len(fit) + 1, 2), len(ids) - 1, np.int64)
        pairs[:-1][fit, 0], pairs[:-1][fit, 1] = stems.indices.to_numpy(), first_closing + closings.indices.to_numpy()
        pairs[:-1][~fit, 0] = np.arange(first_other, len(ids) - 2)
        pairs[-1, 0] = len(ids) - 2
        return _gathered(np.frombuffer(b"".join(ids), "<u2"), size, pairs.ravel()), size[pairs].sum(axis=1)


def _gathered(blob: np.ndarray, size: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The ids of entries, one after the other; blob holds each entry's, size how many."""
    begin, out = np.cumsum(size) - size, [np.empty(0, "<u2")]
    for lo in range(0, len(which), PARTS):
        w = which[lo : lo + PARTS]
        n = size[w]
        to = np.cumsum(n)
        out.append(blob[np.repeat(begin[w] - to + n, n) + np.arange(to[-1])])
    return np.concatenate(out)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One for each worker process, kept between tasks."""
    return Encoder(path)
