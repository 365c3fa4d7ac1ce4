"""The rows of the fixture ``docs``."""

from __future__ import annotations


def prose(seed: int, n: int) -> str:
    """Repeatable words in lines of ten."""
    words = [f"w{(seed * 7919 + i * i * 31 + i) % 997}" for i in range(n)]
    return "\n".join(" ".join(words[i : i + 10]) for i in range(0, n, 10))


def edited(text: str, *places: int) -> str:
    words = text.split(" ")
    for p in places:
        words[p] = f"edit{p}"
    return " ".join(words)


ROWS = [
    (1, prose(1, 200)), (2, prose(1, 200)), (3, edited(prose(1, 200), 50)), (4, prose(2, 120)), (5, edited(prose(2, 120), 9, 60)),
    (6, None), (7, ""), (8, " \t\n"), (9, "one two"), (10, "One  two"), (11, "ÄÖ ▁ ß x"), (None, prose(1, 200)), (None, None),
    (12, prose(3, 400)), (12, prose(3, 400)), (13, prose(3, 400).replace(" ", "  ")), (14, "a" * 30000), (15, prose(4, 20000)),
    (16, "Same line here for all of them\n" + prose(5, 40)), (17, "Same line here, for all of them!\n" + prose(6, 40)),
]
