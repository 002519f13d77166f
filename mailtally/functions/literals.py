"""Literals that a text must hold for a pattern to match.

Matching thousands of patterns against a text is mostly finding out that they do not match.
A literal that is in every match of a pattern decides that without the pattern. The literals of
all patterns are searched at once, by one expression in the form of a trie.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from re import _constants as op
from re import _parser as syntax

#: Letters that a case-blind search takes for ASCII ones, and what it takes them for.
LOOKALIKES = ("\u017f\u0131\u0130\u212a", "siik")
SHORTEST, LONGEST = 2, 8
REPEATS = (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT)

#: Of some literals at least one is in every match.
Need = frozenset[str]


def folded_sql(text: str) -> str:
    """SQL of a text with ASCII letters, and what matches them, in lower case."""
    return f"lower(translate({text}, '{LOOKALIKES[0]}', '{LOOKALIKES[1]}'))"


def _plain(code: int) -> str | None:
    """A character as it stands in a folded text; null for letters with other forms of case,
    whose folding may differ from engine to engine."""
    c = chr(code)
    if c.isascii():
        return c.lower()
    return c if {c.lower(), c.upper(), c.title(), c.casefold()} == {c} else None


def needs(pattern: str) -> list[Need]:
    """What every match of a pattern holds, whatever the case; empty if nothing is known."""
    return [n for n in _needs(syntax.parse(pattern, re.IGNORECASE)) if min(map(len, n)) >= SHORTEST]


def _needs(tree: Iterable) -> Iterator[Need]:
    run = ""
    for kind, value in tree:
        c = _plain(value) if kind is op.LITERAL else None
        if c is not None:
            run += c
            continue
        if kind is op.AT:  # takes no room
            continue
        if run:
            yield frozenset({run})
            run = ""
        if kind is op.SUBPATTERN:
            yield from _needs(value[-1])
        elif kind is op.ATOMIC_GROUP:
            yield from _needs(value)
        elif kind in REPEATS and value[0] > 0:
            yield from _needs(value[2])
        elif kind is op.BRANCH:
            found = [max(_needs(branch), key=_least, default=None) for branch in value[1]]
            if None not in found:
                yield frozenset().union(*found)
    if run:
        yield frozenset({run})


def _least(need: Need) -> tuple[int, int]:
    """The length of the shortest literal, then how few they are."""
    return min(map(len, need)), -len(need)


def _windows(literal: str) -> list[str]:
    size = min(LONGEST, len(literal))
    return [literal[i : i + size] for i in range(len(literal) - size + 1)]


def keys_of(patterns: list[str], most: int) -> dict[str, list[int]]:
    """Short keys, none the beginning of another, and the places of the patterns of which each
    is a part. A text that holds no key of a pattern does not match it.

    Of each pattern the keys are cut where its literals are rarest among the patterns. Keys of
    more than ``most`` patterns say little; a pattern with such a key, or without literals, has
    no key at all.
    """
    found = [needs(p) for p in patterns]
    often = Counter(w for some in found for w in {w for n in some for x in n for w in _windows(x)})

    def rarest(literal: str) -> str:
        return min(_windows(literal), key=lambda w: (often[w], -len(w)))

    chosen: list[set[str]] = []
    for some in found:
        cut = [{rarest(x) for x in n} for n in some]
        chosen.append(min(cut, key=lambda ks: (sum(often[k] for k in ks), -min(map(len, ks))), default=set()))
    short: dict[str, str] = {}
    last = None
    for key in sorted(set().union(*chosen)):
        last = last if last is not None and key.startswith(last) else key
        short[key] = last
    sharers = Counter(k for ks in chosen for k in {short[k] for k in ks})
    out: dict[str, list[int]] = {}
    for place, ks in enumerate(chosen):
        own = {short[k] for k in ks}
        if own and max(sharers[k] for k in own) <= most:
            for k in own:
                out.setdefault(k, []).append(place)
    return out


def trie_pattern(keys: Iterable[str]) -> str:
    """A pattern that finds, at each place of a text, the key that begins there, as group 1."""
    root: dict = {}
    for key in keys:
        node = root
        for c in key:
            node = node.setdefault(c, {})

    def text(node: dict) -> str:
        branches = [_quoted(c) + text(below) for c, below in node.items()]
        return branches[0] if len(branches) == 1 else f"(?:{'|'.join(branches)})" if branches else ""

    return f"(?=({text(root)}))"


def _quoted(c: str) -> str:
    return c if not c.isascii() or c.isalnum() else f"\\x{ord(c):02x}"
