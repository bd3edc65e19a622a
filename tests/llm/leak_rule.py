"""The leak rule of the decontamination, stated anew over word lists."""

import re
from collections import defaultdict

from sigloom.llm.decontaminate import UNITS

_RUN = re.compile("[0-9A-Za-zÀ-῿⁀-\U0010ffff]+")
_UPPER = set("ABCDEFGHIJKLMNOPQRSTUVWXYZ") | {chr(c) for c in range(0xC0, 0xDF) if c != 0xD7}
_SMALL = set("abcdefghijklmnopqrstuvwxyz") | {chr(c) for c in range(0xDF, 0x100)} | {chr(0xD7)}
_FOLD = {ord(c): ord(c) + 32 for c in _UPPER}


def template(text):
    """(value, type by sentence, plain, by capital, capital inside?) of every word."""
    parts = []
    for m in _RUN.finditer(text):
        gap = text[parts[-1][1] : m.start()] if parts else ""
        if parts and gap in list(".,:/") and m[0][0] in "0123456789" and parts[-1][3]:
            parts[-1][1] = m.end()
        else:
            parts.append([m.start(), m.end(), not parts or any(c in ".!?:\0" for c in gap), m[0][0] in "0123456789"])
    out = []
    for start, end, opens, digit in parts:
        word = text[start:end]
        value = word.translate(_FOLD)
        capital = word[0] in _UPPER and text[start + 1 : start + 2] in _SMALL and bool(text[start + 1 : start + 2])
        plain = "num" if digit else "unit" if value in UNITS else ""
        named = "num" if digit else "name"
        out.append((value, named if capital and not opens else plain, plain, named if capital else plain, capital))
    return out


def _windows(words, size, reading):
    """(place, key, slots) of every window; a key of few plain words holds the values."""
    for at in range(len(words) - size + 1):
        yield _window(words[at : at + size], at, reading)


def _window(own, at, reading, first=None):
    kinds = [w[1 + reading] for w in own]
    if first:
        kinds[0] = first
    key = tuple(k or w[0] for k, w in zip(kinds, own))
    if kinds.count("") < 3:
        key += tuple(w[0] for w in own)
    return at, key, tuple((k, w[0]) for k, w in zip(kinds, own) if k)


def item_windows(items):
    """Index of (reading, size, key) to (item, windows, place, slots)."""
    index = defaultdict(list)
    for item, text in items:
        words = template(text or "")
        size = min(8, len(words) if len(words) < 12 else len(words) // 2)
        if size < 5:
            continue
        of = len(words) - size + 1
        for reading in range(3):
            for at, key, slots in _windows(words, size, reading):
                index[reading, size, key].append((item, of, at, slots))
        if words[0][4] and not words[0][1]:
            _, key, slots = _window(words[:size], 0, 0, "name")
            index[0, size, key].append((item, of, 0, slots))
    return index


def leaked(text, index, run=13, share=0.5):
    """The items that a text leaks."""
    words = template(text or "")
    aligned = defaultdict(list)
    for size in {s for _, s, _ in index}:
        for reading in range(3):
            for there, key, values in _windows(words, size, reading):
                for item, of, at, slots in index.get((reading, size, key), ()):
                    aligned[item, of, size, there - at, reading].append((at, slots, values))
    found, covered = set(), defaultdict(set)
    for (item, of, size, _, _), held in aligned.items():
        pairs = {p for _, slots, values in held for p in zip(slots, values)}
        if len(pairs) != len({old for old, _ in pairs}):
            continue
        sure = {at for at, slots, values in held if slots == values or 2 * len(slots) <= size}
        need = max(min(run, of + size - 1) - size + 1, 1)
        if any(all(at + i in sure for i in range(need)) for at in sure):
            found.add(item)
        covered[item, of + size - 1] |= {at + i for at, _, _ in held for i in range(size)}
    return found | {item for (item, total), places in covered.items() if len(places) >= share * total}
