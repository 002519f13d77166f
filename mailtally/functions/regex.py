"""Rule patterns are written in Python syntax; Spark matches with Java's engine.

``java_pattern`` checks a pattern and rewrites the few places where the two
dialects differ, so that rule files can keep the Python syntax.
"""

from __future__ import annotations

import re

# UNIX_LINES, UNICODE_CHARACTER_CLASS (implies UNICODE_CASE), as Python's str patterns behave.
_BASE_FLAGS = "dU"


def java_pattern(pattern: str, ignore_case: bool = True) -> str:
    """Java form of a Python pattern, with Unicode classes and optional case folding."""
    flags = _BASE_FLAGS + ("i" if ignore_case else "")
    return f"(?{flags})" + rewrite(pattern)


def group_index(pattern: str) -> dict[str, int]:
    """Named groups of a Python pattern and their group numbers, in order."""
    names = re.compile(pattern).groupindex
    return dict(sorted(names.items(), key=lambda kv: kv[1]))


def has_groups(pattern: str) -> bool:
    return re.compile(pattern).groups > 0


def rewrite(pattern: str) -> str:
    """Rewrite named groups, class brackets, open repeats and end anchors for Java."""
    names = re.compile(pattern).groupindex
    if re.search(r"\(\?\(", pattern):
        raise ValueError(f"conditional groups are not supported: {pattern!r}")
    out: list[str] = []
    in_class = False
    i = 0
    while i < len(pattern):
        ch, rest = pattern[i], pattern[i:]
        step = 1
        if ch == "\\":
            piece, step = ("\\z" if rest[:2] == "\\Z" and not in_class else rest[:2]), 2
        elif in_class:
            if ch == "]":
                in_class = False
                piece = ch
            else:
                piece = "\\" + ch if ch in "[&" else ch
        elif ch == "[":
            in_class = True
            head = re.match(r"\[\^?\]?", rest).group(0)
            piece, step = head.replace("]", "\\]"), len(head)
        elif m := re.match(r"\(\?P<\w+>", rest):
            piece, step = "(", m.end()
        elif m := re.match(r"\(\?P=(\w+)\)", rest):
            piece, step = f"(?:\\{names[m.group(1)]})", m.end()
        elif m := re.match(r"\{,(\d+)\}", rest):
            piece, step = "{0,%s}" % m.group(1), m.end()
        else:
            piece = ch
        out.append(piece)
        i += step
    return "".join(out)
