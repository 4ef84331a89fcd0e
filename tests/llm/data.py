"""Small tables of awkward rows, and plain-Python versions of what the operators compute."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SF = "/root/testdata/sf0.001"
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    " score string, kept int, n_words int, row string, label int, hits int, component_id string"
)


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def texts() -> list[str | None]:
    prose = [f"w{i * i % 97} the and of {i % 7}" for i in range(60)]
    passage = " ".join(prose[:12])
    near = passage.split()
    near[30] = "other"
    return [
        None,
        "",
        " \n\t ",
        "one",
        "One",
        "a b c d",
        "a b c d",
        passage,
        passage,
        passage.upper(),
        " ".join(near),
        "start " + passage + " end",
        " ".join(prose),
        "\n".join(prose[:5] * 3),
        "ha " * 300,
        "ha " * 77,
        " ".join(f"x{i}" for i in range(20_000)),
        "don't 'tis we'll\n\n  \U0001f600 naïve 中文  x 12ab ###$$$",
        "Released under the MIT License.\nAll rights reserved. Text",
    ]


def awkward(spark):
    """Null, empty, blank, short, equal, near-equal and long texts; null and repeated ids."""
    rows = [(i, t) for i, t in enumerate(texts())]
    rows += [(None, "no id here at all"), (None, texts()[7]), (7, texts()[7]), (3, "another text")]
    extra = ("s", 1, 2, "r", 3, 4, "c")
    return spark.createDataFrame(
        [(i, t, None if i == 2 else "en", "src", 5, *extra) for i, t in rows], SCHEMA
    )


def no_rows(spark):
    return spark.createDataFrame([], SCHEMA)


def counts(text: str | None) -> tuple[int, int, int, int, int]:
    """Words, characters in words, symbols, repeated lines, words in repeated windows."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    hit = {
        j
        for k in range(len(words) - 7)
        if windows[tuple(words[k : k + 8])] > 1
        for j in range(k, k + 8)
    }
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit)


def shingles(text: str | None) -> frozenset:
    words = WORD.findall(lower(text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def linked(sets: list[frozenset], percent: int = 85) -> list[int]:
    """The first place of each set's component."""
    top = list(range(len(sets)))

    def find(x: int) -> int:
        while top[x] != x:
            x = top[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                x, y = sorted((find(i), find(j)))
                top[y] = x
    return [find(i) for i in range(len(sets))]


def without_repeats(rows: list[str | None], width: int = 35) -> list[tuple[int, int, str]]:
    """Words, removed words and what is left of each text."""
    words = [WORD.findall(t or "") for t in rows]
    seen = Counter(tuple(w[k : k + width]) for w in words for k in range(len(w) - width + 1))
    out = []
    for w in words:
        gone = {
            j
            for k in range(len(w) - width + 1)
            if seen[tuple(w[k : k + width])] > 1
            for j in range(k, k + width)
        }
        left = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((len(w), len(gone), left))
    return out


def contaminated(rows: list[str | None], items: list[tuple], width: int = 10) -> list[tuple]:
    """Words, hit words, items and digest of item ids of each text."""
    windows: dict[tuple, set] = {}
    for name, text in items:
        words = ALNUM_WORD.findall(lower(text or ""))
        n = min(width, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[k : k + n]), set()).add(name)
    sizes = {len(w) for w in windows}
    out = []
    for text in rows:
        words = ALNUM_WORD.findall(lower(text or ""))
        hit, names = set(), set()
        for n in sizes:
            for k in range(len(words) - n + 1):
                found = windows.get(tuple(words[k : k + n]))
                if found:
                    names |= found
                    hit |= set(range(k, k + n))
        listed = ",".join(sorted(str(x) for x in names if x is not None))
        out.append((len(words), len(hit), len(names), sha(listed)))
    return out
