"""Pre-tokens of a byte-level vocabulary, found for whole batches at a time.

The split is that of the pattern

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

worked out on arrays: runs of letters, numbers, blanks and other characters; the last blank of a
run goes to what follows if it is a space, else it stands alone; an apostrophe that begins a
pre-token takes a contraction from the letters after it. Libraries differ in their Unicode
version, so texts with characters whose class changed since Unicode 3.2 are reported and left to
the caller's library.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from stayline.llm.words import text_buffer

LETTER, NUMBER, BLANK, OTHER = range(4)
UNSURE = 4  # added to the class

# The White_Space property, and the contractions.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
WHITE += [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


@functools.cache
def class_table() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    old = unicodedata.ucd_3_2_0.category
    for cp in range(sys.maxunicode + 1):
        char = chr(cp)
        now = unicodedata.category(char)
        kind = kinds.get(now[0], OTHER)
        sure = now != "Cn" and (kind == OTHER or kinds.get(old(char)[0], OTHER) == kind)
        if kind != OTHER or not sure:
            table[cp] = kind if sure else kind + UNSURE
    table[WHITE] = BLANK
    return table


@dataclass
class Pretokens:
    """Pre-tokens of ``len(offsets) - 1`` documents, as places in a list of distinct ones."""

    codes: np.ndarray
    offsets: np.ndarray
    distinct: pa.Array
    unsure: np.ndarray  # documents with characters of uncertain class
    texts: pa.Array


def valid_text(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, str]:
    data, at = text_buffer(texts)
    try:
        return texts, data, at, data.tobytes().decode()
    except UnicodeDecodeError:  # bytes that are no text become U+FFFD
        raw = texts.cast(pa.large_binary()).fill_null(b"").to_pylist()
        texts = pa.array([t.decode(errors="replace") for t in raw], pa.large_string())
        data, at = text_buffer(texts)
        return texts, data, at, data.tobytes().decode()


def pretokens_of(texts: pa.Array) -> Pretokens:
    texts, data, at, decoded = valid_text(texts)
    chars = np.frombuffer(decoded.encode("utf-32-le"), np.uint32)
    lead = None if len(chars) == len(data) else np.flatnonzero((data & 0xC0) != 0x80)
    char_at = at if lead is None else np.searchsorted(lead, at)
    n = len(chars)
    kind = class_table()[chars]
    doubt = np.flatnonzero(kind >= UNSURE)
    unsure = np.unique(np.searchsorted(char_at, doubt, side="right") - 1)
    if len(doubt):
        kind = kind % UNSURE
    first = np.zeros(n + 1, bool)  # of documents
    first[char_at] = True
    start = first[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    # The last blank of a run that something follows.
    last = np.flatnonzero((kind[:-1] == BLANK) & (kind[1:] != BLANK) & ~first[1:n])
    start[last] = True
    start[last[chars[last] == 0x20] + 1] = False
    _contract(chars, first, start)
    begins = np.flatnonzero(start)
    if lead is not None:
        begins = lead[begins]
    column = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(),
        len(begins),
        [None, pa.py_buffer(np.append(begins, len(data)).astype(np.int64)), pa.py_buffer(data)],
    ).dictionary_encode()
    offsets = np.searchsorted(begins, at)
    return Pretokens(np.asarray(column.indices), offsets, column.dictionary, unsure, texts)


def _contract(chars: np.ndarray, first: np.ndarray, start: np.ndarray) -> None:
    n = len(chars)
    marks = np.flatnonzero((chars == ord("'")) & start)
    done = np.zeros(len(marks), bool)
    for suffix in CONTRACTIONS:
        end = marks + 1 + len(suffix)
        fits = ~done & (end <= n)
        for k, letter in enumerate(suffix, 1):
            here = np.minimum(marks + k, n - 1)
            fits &= (chars[here] == ord(letter)) & ~first[here]
        at = marks[fits]
        start[at + 1] = False
        after = at + 1 + len(suffix)
        start[after[after < n]] = True
        done |= fits
