"""A notation for the wordings of names, labels and links, made into patterns.

The patterns are read alike by Java, RE2 and Python, over lower-case text. Letters
and marks stand for themselves, besides:

====  =========================================
blank  a run of blanks
_      blanks, or nothing
~      blanks, dots, hyphens and underscores, or nothing
[x]    x, or nothing
{x|y}  x or y
N      a digit
W      a word of letters
+      further letters, one at least
!      the end of a word
…      anything
•      a bullet or a mark like one
^ $    the text's beginning and end
\\     the sign behind it for itself
====  =========================================
"""

from __future__ import annotations

END = "($|[^a-z0-9_])"
_SIGNS = {" ": r"\s+", "_": r"\s*", "~": r"[\s._-]*", "[": "(", "]": ")?", "{": "(", "}": ")", "|": "|", "N": "[0-9]", "W": "[a-z]+", "+": "[a-z0-9_]+", "!": END, "…": ".*", "•": "[·|:;.-]", "^": "^", "$": "$"}


def pattern(phrase: str) -> str:
    """One phrase as a pattern."""
    out, literal = [], False
    for c in phrase:
        if c == "\\" and not literal:
            literal = True
            continue
        out.append(_SIGNS[c] if c in _SIGNS and not literal else "\\" + c if c in r"\.*?()[]{}|+^$" else c)
        literal = False
    return "".join(out)


def anywhere(phrases: list[str]) -> str:
    """Any of the phrases, in any place."""
    return "|".join(map(pattern, phrases))


def worded(phrases: list[str]) -> str:
    """Any of the phrases, as words of their own."""
    return f"(^|[^a-z0-9_])({anywhere(phrases)}){END}"


def begun(phrases: list[str]) -> str:
    """Any of the phrases, from the beginning of a word."""
    return f"(^|[^a-z0-9_])({anywhere(phrases)})"


def whole(phrases: list[str]) -> str:
    """One of the phrases and nothing else."""
    return f"^({anywhere(phrases)})$"
