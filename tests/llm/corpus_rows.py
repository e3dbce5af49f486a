"""Helpers shared by the corpus tests. (Not in conftest.py: two folders have one, so its name is ambiguous.)"""


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, x if x is not None else 0) for x in r))
