"""Personal data: exact patterns, and a character tagger for what is written otherwise.

The patterns give the base spans of four kinds: e-mail addresses, IPv4 addresses, payment cards and phone
numbers. A bidirectional LSTM with a CRF is trained in numpy from labelled spans: what the patterns found in a
bounded sample of the corpus, and the same kinds of things spelt another way (brackets for dots and at signs,
phone numbers without a plus sign, cards in odd groups) put into clean windows. It reads overlapping windows;
each character takes its tag from the window in which it is farthest from an edge, and spans are read from the
tags of the whole text. A tagged span is added if it stands apart, is valid for its kind, and overlaps no base
span of that kind; so the model can add spans and never removes one.

A span of these kinds holds a digit, an at sign or a bracketed ``at``. Windows are laid over everything within
``REACH`` characters of a digit, or of the run of address characters and bracketed signs around an at sign, in
whole texts; elsewhere no span is possible and every tag is O. What is tagged as an address in such a run is widened
to the run, however long that is.

Positions are code points, ends exclusive. Null and empty texts have no spans. Rows are searched one by one, so
equal rows get equal spans and no key matters.
"""

from __future__ import annotations

import bisect
import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm.common import per_batch
from lakeload.llm.tagger import Params, decode, encode
from lakeload.llm.tagger import train as train_tagger

KINDS = ("email", "ip", "card", "phone")
#: Characters in a window, from one window to the next, and around a character that a span must hold.
WINDOW, STEP, REACH = 64, 32, 24
#: Windows of the corpus to learn from, of each sort (with and without spans), and made-up ones.
SAMPLE, MADE = 600, 1800

# The base patterns.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_HINT = re.compile(r"[0-9]|([\[(]\s*(?:at|@)\s*[\])]|@)", re.IGNORECASE)
# As far as an address can go on from its at sign, forwards, and backwards in the text turned round.
_AFTER = re.compile(r"(?:[\w.%+@-]++|\s*+[\[(]\s*+(?:dot|at|[.@])\s*+[\])]\s*+)*+", re.IGNORECASE | re.ASCII)
_BEFORE = re.compile(r"(?:[\w.%+@-]++|\s*+[\])]\s*+(?:tod|ta|[.@])\s*+[\[(]\s*+)*+", re.IGNORECASE | re.ASCII)
_SPACE = re.compile(r"\s*")
_LOOSE = re.compile(r"[\s._%+-]*")
_DIGIT = re.compile(r"[0-9]")

Span = tuple[str, int, int]


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(map(int, digits[-1::-2]))) % 10 == 0


def _emails(text: str) -> list[Span]:
    """As the pattern finds them, in one pass: each match has one at sign, which no part of it may hold."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        if domain := _DOMAIN.match(text, at + 1):
            start = at
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                end = domain.end()
                found.append(("email", start, end))
        at = text.find("@", at + 1)
    return found


def _ips(text: str) -> list[Span]:
    """Four parts at a time from each chain of dotted numbers."""
    found = []
    for chain in _DOTTED.finditer(text):
        parts = chain[0].split(".")
        at = chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            size = sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) < 4 and int(p[-4:]) <= 255 for p in four):
                found.append(("ip", at, at + size))
            at += size + 1
    return found


def base_spans(text: str) -> list[Span]:
    """Spans of the base patterns, by kind and start."""
    found = _emails(text)
    if _DIGIT.search(text):
        found += _ips(text)
        for m in _CARD.finditer(text):
            digits = _digits(m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                found.append(("phone", *m.span()))
    return found


def hints(text: str) -> list[tuple[int, int, bool]]:
    """Places that a span must hold, in order: digits, and runs of an address around at signs (True)."""
    out, end, turned = [], 0, None
    for m in _HINT.finditer(text):
        a, b = m.span()
        if m[1] is None:
            out.append((a, b, False))
        elif a >= end:  # else the run of an earlier at sign holds it
            turned, a = turned or text[::-1], len(text) - a
            if m[0] != "@":  # white space around brackets belongs to the sign
                a, b = _SPACE.match(turned, a).end(), _SPACE.match(text, b).end()
            a, end = len(text) - _BEFORE.match(turned, a).end(), _AFTER.match(text, b).end()
            out.append((a, end, True))
    return sorted(out)


def windows(text: str) -> list[tuple[int, str]]:
    """(start, characters) of the windows over every place that can hold a span."""
    return _windows(text, hints(text))


def _windows(text: str, places: list[tuple[int, int, bool]]) -> list[tuple[int, str]]:
    out: list[tuple[int, str]] = []
    stretch: list[int] | None = None

    def cover(a: int, b: int) -> None:
        while True:
            out.append((a, text[a : a + WINDOW]))
            if a + WINDOW >= b:
                break
            a += STEP

    for first, end, _ in places:
        a, b = max(0, first - REACH), min(len(text), end + REACH)
        if stretch and a <= stretch[1]:
            stretch[1] = max(stretch[1], b)
            continue
        if stretch:
            cover(*stretch)
        stretch = [a, b]
    if stretch:
        cover(*stretch)
    return out


def tag_numbers(start: int, length: int, spans: list[Span]) -> np.ndarray:
    """Tags of a window: 0 outside, 1 + 2 * kind where a span begins, one more inside it."""
    tags = np.zeros(length, np.int64)
    for kind, a, b in spans:
        a, b, k = a - start, b - start, 1 + 2 * KINDS.index(kind)
        tags[max(a, 0) : max(min(b, length), 0)] = k + 1
        if 0 <= a < length:
            tags[a] = k
    return tags


def _plain(text: str) -> str:
    """With its brackets and spelt-out signs written as signs."""
    text = re.sub(r"\s*[\[(]\s*(?:dot|\.)\s*[\])]\s*", ".", text, flags=re.IGNORECASE)
    return re.sub(r"\s*[\[(]\s*(?:at|@)\s*[\])]\s*", "@", text, flags=re.IGNORECASE)


def valid(kind: str, text: str, before: str, after: str) -> bool:
    """If a tagged text can be of its kind and stands apart from its neighbours."""
    if before.isalnum() or after.isalnum():
        return False
    digits = _digits(text)
    if kind == "email":
        plain = _plain(text)
        return plain.count("@") == 1 and _emails(plain) == [("email", 0, len(plain))]
    if kind == "ip":
        plain = _plain(text)
        return _ips(plain) == [("ip", 0, len(plain))]
    if kind == "card":
        return bool(re.fullmatch(r"[0-9](?:[\x20._/-]{0,2}[0-9])+", text)) and 13 <= len(digits) <= 19 and luhn(digits)
    groups = re.findall(r"[0-9]+", text)
    shape = re.fullmatch(r"\(?[0-9][0-9\x20()./-]*[0-9]", text)
    return bool(shape) and 9 <= len(digits) <= 15 and len(groups) >= 3 and len(groups[-1]) >= 3 and not _ips(text)


@dataclass
class Finder:
    """Base and tagged spans of texts under a trained tagger."""

    params: Params
    chunk: int = 1024

    def __call__(self, texts: list[str | None]) -> list[tuple[list[Span], list[Span]]]:
        """Base spans and all spans of each text."""
        places = [hints(t) if t else [] for t in texts]
        laid = [_windows(t, p) if p else [] for t, p in zip(texts, places)]
        flat = [w for ws in laid for _, w in ws]
        tags = [
            decode(self.params, encode(flat[i : i + self.chunk], WINDOW))
            for i in range(0, len(flat), self.chunk)
        ]
        tags, at, out = np.concatenate(tags) if tags else None, 0, []
        for text, ws, held in zip(texts, laid, places):
            base = base_spans(text) if text else []
            runs = [(a, b) for a, b, address in held if address]
            found = _spans(text, ws, tags[at : at + len(ws)], runs) if ws else []
            at += len(ws)
            out.append((base, _together(base, found)))
        return out


def _address(text: str, a: int, b: int) -> Span | None:
    """The one address that a run is, but for what stands loosely at its ends."""
    left = _LOOSE.match(text, a, b).end()
    right = b - _LOOSE.match(text[left:b][::-1]).end()
    edge = text[left - 1 : left], text[right : right + 1]
    return ("email", left, right) if left < right and valid("email", text[left:right], *edge) else None


def _spans(text: str, ws: list[tuple[int, str]], tags: np.ndarray, runs: list[tuple[int, int]]) -> list[Span]:
    """Spans of a whole text from its windows' tags, each character's from where it is farthest from an edge.

    An address is widened to its run.
    """
    if not tags.any():
        return []
    depth, best = np.full(len(text), -1), np.zeros(len(text), np.int64)
    middle = np.minimum(np.arange(WINDOW), WINDOW - 1 - np.arange(WINDOW))
    for (start, chars), row in zip(ws, tags):
        end, own = start + len(chars), middle[: len(chars)].copy()
        if start == 0:
            own[0] = WINDOW
        if end == len(text):
            own[-1] = WINDOW
        deeper = np.flatnonzero(own > depth[start:end])  # windows without a span have their say too
        depth[start + deeper], best[start + deeper] = own[deeper], row[deeper]
    found, open_ = [], None
    for at in np.flatnonzero(best).tolist():
        tag = int(best[at])
        kind = (tag - 1) // 2
        if open_ and (kind != open_[0] or tag % 2 == 1 or at != open_[2]):
            found.append((KINDS[open_[0]], open_[1], open_[2]))
            open_ = None
        open_ = (kind, open_[1], at + 1) if open_ else (kind, at, at + 1)
    if open_:
        found.append((KINDS[open_[0]], open_[1], open_[2]))
    edge = lambda a, b: (text[a - 1] if a else "", text[b] if b < len(text) else "")
    out: dict[Span, None] = {}  # pieces of one address are widened to the same
    for s in found:
        i = max(0, bisect.bisect(runs, (s[1], len(text))) - 1)
        near = [r for r in runs[i : bisect.bisect_left(runs, (s[2], 0))] if s[1] < r[1]] if s[0] == "email" else []
        wide = [w for r in near if (w := _address(text, *r))]
        if wide:
            out |= dict.fromkeys(wide)
        elif valid(s[0], text[s[1] : s[2]], *edge(s[1], s[2])):
            out[s] = None
    return list(out)


def _together(base: list[Span], found: list[Span]) -> list[Span]:
    """Base spans and those found that overlap none of their kind, nor a base span that covers them."""
    extra = [
        s for s in found
        if not any(s[1] < b[2] and b[1] < s[2] and (s[0] == b[0] or b[1] <= s[1] and s[2] <= b[2]) for b in base)
    ]
    return sorted(base + extra, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span, or each run of overlapping spans, replaced by its first kind."""
    out, end = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= end:
            out += [text[end:a], f"[{kind.upper()}]"]
        end = max(end, b)
    return "".join([*out, text[end:]])


def _sampled(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Windows with the tags of their base spans; spans cut by an edge leave a window out."""
    rows = []
    for text in batch.column("text").to_pylist():
        spans = base_spans(text) if text else []
        for start, chars in windows(text) if text else []:
            inside = [s for s in spans if s[1] < start + len(chars) and start < s[2]]
            if all(start <= s[1] and s[2] <= start + len(chars) for s in inside):
                rows.append((chars, joined([(k, a - start, b - start) for k, a, b in inside])))
    columns = list(zip(*rows)) or [[], []]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["chars", "spans"])


def labelled(docs: DataFrame) -> list[tuple[str, list[Span]]]:
    """At most ``SAMPLE`` windows of the corpus with base spans and as many without, chosen by hash."""
    found = docs.select("text").mapInArrow(per_batch(lambda: _sampled), "chars string, spans string").distinct()
    out = []
    for holds in ("spans <> ''", "spans = ''"):
        chosen = found.filter(holds).orderBy(F.xxhash64(F.lit(5), "chars"), "chars").limit(SAMPLE).collect()
        for r in chosen:
            parts = [s.split(":") for s in r["spans"].split(",") if s]
            out.append((r["chars"], [(k, int(a), int(b)) for k, a, b in parts]))
    return out


def _card(rng: random.Random) -> str:
    body = "".join(rng.choice("0123456789") for _ in range(15))
    return next(body + d for d in "0123456789" if luhn(body + d))


def _made_up(rng: random.Random) -> tuple[str, str | None]:
    """Something with a digit or at sign, and its kind if it is personal."""
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    name = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 8)))
    parts = [str(rng.randint(0, 255)) for _ in range(4)]
    local, host = rng.choice([name(), f"{name()}.{name()}", name() + number(2), number(2)]), f"{name()}.{rng.choice(['com', 'org', 'net', 'example.com'])}"
    card, area = _card(rng), f"({number(3)})"
    made = {
        "email": [f"{local}@{host}", f"{local}[at]{host}", f"{local} (at) {host.replace('.', ' (dot) ')}", f"{local}[@]{host.replace('.', '[.]')}"],
        "ip": [".".join(parts), "[.]".join(parts), "(.)".join(parts)],
        "card": [card, " ".join(card[i : i + 4] for i in range(0, 16, 4)), "-".join(card[i : i + 4] for i in range(0, 16, 4)), ".".join(card[i : i + 4] for i in range(0, 16, 4)), "  ".join(card[i : i + 4] for i in range(0, 16, 4))],
        "phone": [f"+{rng.randint(1, 99)} {area} {number(3)}-{number(4)}", f"{area} {number(3)}-{number(4)}", f"{number(3)}-{number(3)}-{number(4)}", f"00{number(2)} {number(3)} {number(3)} {number(4)}", f"{number(3)}.{number(3)}.{number(4)}", f"+{number(2)} {number(3)} {number(6)}"],
        None: [number(rng.randint(1, 12)), number(4), f"{rng.randint(1, 9)}.{rng.randint(0, 9)}", f"{number(4)}-{number(2)}-{number(2)}", f"{number(2)}:{number(2)}", f'token = "{"".join(rng.choice("0123456789abcdef") for _ in range(40))}"', f"{name()} @ {name()}", f"{number(3)},{number(3)}", f"{rng.randint(1, 9)}.{rng.randint(0, 9)}.{rng.randint(0, 9)}", f"{number(2)}%", f"@{name()}"],
    }
    kind = rng.choice([*KINDS, None])
    return rng.choice(made[kind]), kind


def made_up(clean: list[str], count: int = MADE, seed: int = 9) -> list[tuple[str, list[Span]]]:
    """Windows of clean characters with made-up things put between words."""
    rng, out = random.Random(seed), []
    letters = [re.sub(r"[0-9@+]", "", c) for c in clean] or ["the and of to in is that for"]
    while len(out) < count:
        around, (thing, kind) = rng.choice(letters), _made_up(rng)
        cut = rng.randint(0, max(0, len(around) - 1))
        cut = around.rfind(" ", 0, cut) + 1
        left = around[:cut][-max(0, WINDOW - len(thing) - 1) :]
        right = rng.choice([" ", " ", ".", ", ", "\n"]) + around[cut:]
        if len(left) + len(thing) <= WINDOW:
            out.append(((left + thing + right)[:WINDOW], [(kind, len(left), len(left) + len(thing))] if kind else []))
    return out


def train(docs: DataFrame) -> Finder:
    """A finder trained on what the corpus and the made-up windows show."""
    seen = labelled(docs)
    examples = seen + made_up([c for c, s in seen if not s] + [c for c, s in seen if s])
    codes = encode([c for c, _ in examples], WINDOW)
    tags = np.stack([tag_numbers(0, WINDOW, s) for _, s in examples])
    return Finder(train_tagger(codes, tags, 1 + 2 * len(KINDS)))


def _found(finder: Finder, passed: tuple[str, ...], redact: bool):
    def make():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column("text").to_pylist()
            found = finder(texts)
            columns = {c: batch.column(c) for c in passed}
            if redact:
                texts = [redacted(t, s) if t is not None else None for t, (_, s) in zip(texts, found)]
                columns["text"] = pa.array(texts, pa.string())
                if "n_chars" in columns:
                    kind = columns["n_chars"].type
                    old = columns["n_chars"].to_pylist()
                    columns["n_chars"] = pa.array([o if t is None else len(t) for t, o in zip(texts, old)], kind)
            else:
                columns["base"] = pa.array([joined(b) for b, _ in found], pa.string())
                columns["spans"] = pa.array([joined(s) for _, s in found], pa.string())
            return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

        return each

    return per_batch(make)


def _kinds(df: DataFrame) -> list[str]:
    return [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema]


def find(docs: DataFrame, finder: Finder, keys: list[str]) -> DataFrame:
    """``keys``, base and spans: ``kind:start:end`` by kind and start, joined by commas."""
    rows = docs.select(*keys, "text")
    schema = ", ".join([*_kinds(docs.select(*keys)), "base string", "spans string"])
    return rows.mapInArrow(_found(finder, tuple(keys), False), schema)


def redact(docs: DataFrame, finder: Finder) -> DataFrame:
    """The rows of ``docs`` with spans replaced by their kind; ``n_chars``, if there, counts anew."""
    return docs.mapInArrow(_found(finder, tuple(docs.columns), True), ", ".join(_kinds(docs)))
