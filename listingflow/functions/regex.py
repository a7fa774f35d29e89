"""Regex fragments that behave the same in Java (Spark) and RE2 (DuckDB, our test oracle).

* Java ``\\w``/``\\s`` are ASCII-only and RE2 lacks look-around, so word, space and
  boundary tests are written as explicit classes.
* Digits are ASCII ``[0-9]``.
"""

# Whitespace as Python's str.isspace() sees it.
WS = r"[\t\n\x{0B}\f\r \p{Z}\x{85}\x{1C}-\x{1F}]"
# A word character as Python's Unicode \w sees it.
WORD = r"[\p{L}\p{N}_]"
NOT_WORD = r"[^\p{L}\p{N}_]"
# "\b" after a word character: end of text or a non-word character follows.
END_WORD = r"(?:$|" + NOT_WORD + r")"
# Python str.strip() on both ends.
STRIP = r"^" + WS + r"+|" + WS + r"+$"
NUM = r"([0-9]+(?:\.[0-9]+)?)"           # integer or decimal, '.' separator
NUM_ANY_SEP = r"([0-9]+(?:[.,][0-9]+)?)"


def _end(pattern: str, i: int) -> int:
    """The index after the class or group that opens at ``i``."""
    if pattern[i] == "[":
        i += 2 if pattern[i + 1] == "^" else 1
        while pattern[i] != "]":
            i += 2 if pattern[i] == "\\" else 1
        return i + 1
    i += 1
    while pattern[i] != ")":
        i = _end(pattern, i) if pattern[i] in "[(" else i + (2 if pattern[i] == "\\" else 1)
    return i + 1


def needed(pattern: str) -> list[tuple[str, ...]]:
    """What every text that ``pattern`` matches must hold: one string at least of each tuple.

    Only what is certain is named: plain characters outside of classes, options and captures, and
    ``(?:a|b)`` of plain words.  Nothing is certain under inline flags or a bare alternative."""
    out, run, i = [], "", 0

    def close():
        nonlocal run
        if run and (run,) not in out:
            out.append((run,))
        run = ""

    while i < len(pattern):
        c, at = pattern[i], i
        if c == "|" or pattern.startswith("(?", i) and not pattern.startswith("(?:", i):
            return []
        if c in "[(":
            i = _end(pattern, i)
        elif c == "\\":
            i += 2
            i = pattern.index("}", i) + 1 if pattern[i:i + 1] == "{" and pattern[i - 1] in "pPx" else i
        else:
            i += 1
        often = pattern[i:i + 1]
        plain = c not in "[(\\^$."
        words = tuple(pattern[at + 3:i - 1].split("|")) if pattern.startswith("(?:", at) else ()
        if plain and often not in ("*", "?", "{"):
            run += c
        else:
            close()
            if often not in ("*", "?", "{") and words and all(w and w.isalpha() for w in words):
                out.append(words)
        if often and often in "*?+{":
            close()
            i = pattern.index("}", i) + 1 if often == "{" else i + 1
            i += pattern[i:i + 1] in ("?", "+")
    close()
    return out
