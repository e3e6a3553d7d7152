"""Texts cut at single spaces into segments that tokenizers treat one by one, and what is remembered of them."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

from lakeload.llm.bpe import uneven

_SINGLE = re.compile(r"(?<=\S) (?=\S)")
#: Latin letters with a full stop or comma behind: two tokens' worth for any vocabulary that has no entry with both.
STOP = re.compile(r"(?<=[A-Za-zÀ-ÖØ-öø-ɏ])(?=[.,])")
_INSIDE = re.compile(rf"(?<=\S)(?=\n\S)|{STOP.pattern}")


def _even(text: str) -> bool:
    """Whether all spaces are single, and neither other white space nor an end of the text is beside one."""
    return not (text[:1] == " " or text[-1:] == " " or uneven(text))


def segments(text: str) -> list[str]:
    """The parts of a text between spaces that have no other white space, nor an end of the text, beside them."""
    return text.split(" ") if _even(text) else _SINGLE.split(text)


def parts(segment: str) -> list[str]:
    """A segment cut before single line ends and before a stop or comma that follows a letter."""
    if segment.isalnum():
        return [segment]
    word = segment[:-1]
    if segment[-1:] in (".", ",") and word.isascii() and word[word[:1] == " " :].isalpha():
        return [word, segment[-1]]
    return _INSIDE.split(segment)


def portions(texts: list[str], characters: int = 1 << 21) -> Iterator[list[str]]:
    """Texts in order, some at a time; a very long text comes alone."""
    some, held = [], 0
    for text in texts:
        if some and held + len(text) > characters:
            yield some
            some, held = [], 0
        some.append(text)
        held += len(text)
    if some:
        yield some


class Generations:
    """What is made of keys, all missing ones at once. When full it becomes the older half, as ``Remembered`` does.

    Keys longer than ``longest`` are made each time.
    """

    def __init__(self, make: Callable[[list[str]], list], most: int, longest: int):
        self.make, self.most, self.longest = make, most, longest
        self.young: dict = {}
        self.older: dict = {}
        self.passing: list = []

    def all(self, keys: Iterable[str]) -> dict:
        """A dict that has at least these distinct keys, until the next call."""
        for key in self.passing:
            self.young.pop(key, None)
        if len(self.young) >= self.most:
            self.older, self.young = self.young, {}
        new, young, older = set(keys).difference(self.young), self.young, self.older
        again = new.intersection(older)
        young.update(zip(again, map(older.__getitem__, again)))
        missing = list(new - again)
        if missing:
            young.update(zip(missing, self.make(missing)))
        self.passing = [key for key in missing if len(key) > self.longest]
        return young
