"""Token ids of whole texts by a tokenizer file, with a cache of parts of texts.

A byte-level tokenizer never joins across the step from a non-blank character to a space
or line feed, nor from a letter to ASCII punctuation, so a text may be cut there and the
parts encoded one by one, with the same ids. Parts repeat, so each worker keeps the ids of
those it has met and asks the library for the others only. Frequent parts are met early;
once the cache is full, further ones are encoded each time they come. Texts that hold
an added token, such as the end mark, are encoded by the library as they are.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
CACHE_ENTRIES = 600_000
CACHE_LENGTH = 64
GROUP_BYTES = 4 << 20

#: A word of Latin letters up to a space, line feed, ASCII punctuation or the end; else
#: blanks and what follows, up to a space or line feed that a non-blank precedes. Other
#: blanks do not end a part, as libraries disagree on what is one.
PART = re.compile(
    r"[ \n]?[A-Za-zÀ-ÖØ-öø-ɏ]+(?=[ \n!-/:-@\[-`{-~]|\Z)"
    r"|\s*\S+(?:[^\S \n]\s*\S*)*"
    r"|\s+"
)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Encodes texts to the bytes of their ids, little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.added = "|".join(map(re.escape, added))
        self.parts: dict[str, bytes] = {}

    def _units(self, units: list[str]) -> list[bytes]:
        """Ids of texts, each known or else cut into parts that are encoded together."""
        parts = self.parts
        coded = list(map(parts.get, units))
        missing = [i for i, ids in enumerate(coded) if ids is None]
        cut = [PART.findall(units[i]) for i in missing]
        fresh = list(set().union(*cut).difference(parts))
        found = self.tokenizer.encode_batch_fast(fresh, add_special_tokens=False)
        parts.update(zip(fresh, (array("I", e.ids).tobytes() for e in found), strict=True))
        for i, of_unit in zip(missing, cut, strict=True):
            coded[i] = b"".join([parts[p] for p in of_unit])
        full = len(parts) > CACHE_ENTRIES
        for part in fresh:
            if full or len(part) > CACHE_LENGTH:
                del parts[part]
        return coded

    def encode(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        """Bytes of the ids of each text; null is empty.

        Cuts texts at single spaces and line feeds and encodes each distinct word once.
        The first word of a text stands as it is, others follow a space or begin with the
        line feed. A text with a word that is empty or ends blank is encoded apart, and one
        with an added token of the tokenizer as a whole.
        """
        if not len(texts):
            return []
        if isinstance(texts, list):
            texts = pa.array(texts, pa.large_string())
        column = texts.cast(pa.large_string()).fill_null("")
        split = pc.split_pattern(pc.replace_substring(column, "\n", " \n"), " ")
        coded = split.flatten().dictionary_encode()
        words, at = coded.dictionary.to_pylist(), coded.indices.to_numpy().copy()
        bounds = split.offsets.to_numpy()
        first = bounds[:-1]
        heads = [words[i] for i in at[first].tolist()]
        odd_words = np.array([not w or w[-1].isspace() for w in words])[at]
        odd_words[first] = [h[-1:].isspace() for h in heads]
        odd = np.logical_or.reduceat(odd_words, first)
        units = [w if w[:1] == "\n" else " " + w for w in words]
        empty = len(units)
        whole: dict[int, bytes] = {}
        if self.added:
            special = pc.match_substring_regex(column, self.added).to_numpy(zero_copy_only=False)
            for i in np.flatnonzero(special).tolist():
                ids = self.tokenizer.encode(column[i].as_py(), add_special_tokens=False).ids
                whole[i] = np.array(ids, "<u4").tobytes()
            odd |= special
        for i in np.flatnonzero(odd).tolist():
            heads[i] = "" if i in whole else column[i].as_py()
        units += ["", *heads]
        at[np.repeat(odd, np.diff(bounds))] = empty
        at[first] = empty + 1 + np.arange(len(texts))
        ids = pa.array(self._units(units), pa.large_binary()).take(pa.array(at))
        _, offsets, data = ids.buffers()
        ends = np.frombuffer(offsets, dtype="<i8")[bounds].tolist()
        view = memoryview(data) if data else b""
        out = [bytes(view[a:b]) for a, b in zip(ends, ends[1:])]  # noqa: B905
        for i, ids in whole.items():
            out[i] = ids
        return out


def small_batches(
    batches: Iterator[pa.RecordBatch], text: str = "text", size: int = GROUP_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of text, or of one longer text."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(text)).fill_null(0).to_numpy())
        bounds = [*np.flatnonzero(np.diff(ends // size, prepend=-1)).tolist(), len(batch)]
        for a, b in zip(bounds, bounds[1:]):  # noqa: B905
            yield batch.slice(a, b - a)


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """The encoder of this worker process."""
    return Encoder(path)
