import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeload.llm import tagger
from lakeload.llm.pii import KINDS, WINDOW, _spans, base_spans, find, luhn, made_up, redact, redacted, tag_numbers, train, windows
from lakeload.llm.queries import QUERIES
from llm.helpers import awkward, empty

#: The base patterns as the contract states them.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15,
            }
            if good[kind]:
                out.append((kind, *m.span()))
    return out


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="0123456789.@+- ()ab%_\né", max_size=60))
def test_base_spans(text):
    assert base_spans(text) == plain(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="a b1@.\n", max_size=300))
def test_windows_hold_every_hint_with_its_surroundings(text):
    held = {i for a, w in windows(text) for i in range(a, a + len(w))}
    for m in re.finditer("[0-9@]", text):
        assert set(range(max(0, m.start() - 24), min(len(text), m.end() + 24))) <= held


LONG = [
    "firstname.middlename.lastname (at) example (dot) org",
    "wilhelmina.josephine.van.der.westhuizen-okonkwo [at] example.org",
    "a.b (at) mail.department-of-examples.a-rather-long-university-name (dot) example (dot) org",
    "".join(f"part{'abcdefgh'[i]}." for i in range(8)) + "end ( at ) " + " (dot) ".join(["host", "with", "many", "names", "in", "it", "org"]),
]


def test_windows_hold_whole_addresses():
    for address in LONG:
        text = "and so on " * 10 + address + " and so on" * 10
        held = {i for a, w in windows(text) for i in range(a, a + len(w))}
        assert set(range(100, 100 + len(address))) <= held


def test_long_runs_of_addresses_take_linear_time():
    for text in ["a[.]" * 75_000 + "@", "a(at)" * 60_000, "( at" * 75_000, "@ " * 100_000, "@(" + " " * 300_000]:
        windows(text)


def test_long_addresses_are_found_whole(finder):
    for address in LONG:
        assert len(address) > 50
        text = f"Please write to the office at {address}, or come by on any day of the week."
        ((_, found),) = finder([text])
        assert ("email", 30, 30 + len(address)) in found, (address, [text[a:b] for _, a, b in found])
        assert address[:9] not in redacted(text, found) and "org" not in redacted(text, found)


def test_windows_without_spans_vote_too():
    """The second window tags an address near its edge, which the first saw farther from an edge and did not tag."""
    text = "x" * 33 + " bob@ab.cd " + "x" * 52
    ws = [(0, text[:WINDOW]), (32, text[32:])]
    tags = np.stack([np.zeros(WINDOW, np.int64), tag_numbers(32, WINDOW, [("email", 34, 43)])])
    assert _spans(text, ws, tags, []) == []
    before = "y" * WINDOW  # what stands earlier in the text does not matter
    ws = [(0, before), *((WINDOW + a, w) for a, w in ws)]
    tags = np.vstack([tag_numbers(0, WINDOW, [("phone", 5, 20)]), tags])
    assert _spans(before + text, ws, tags, []) == []
    tags[1] = tag_numbers(0, WINDOW, [("email", 34, 43)])
    assert _spans(before + text, ws, tags, []) == [("email", WINDOW + 34, WINDOW + 43)]


def test_long_runs_take_linear_time():
    for text in ["1" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "+1" + " " * 300_000, "@" * 100_000]:
        base_spans(text)
        windows(text)


def test_slopes_of_the_tagger():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in tagger.new(5, size=3, hidden=4).items()}
    codes, tags = rng.integers(1, 100, (3, 7)), rng.integers(0, 5, (3, 7))
    _, g = tagger.slopes(p, codes, tags)
    for name in p:
        at = tuple(rng.integers(0, s) for s in p[name].shape) if name != "chars" else (codes[0, 2], 1)
        moved = []
        for step in (1e-4, -1e-4):
            q = {k: v.copy() for k, v in p.items()}
            q[name][at] += step
            moved.append(tagger.slopes(q, codes, tags)[0])
        assert g[name][at] == pytest.approx((moved[0] - moved[1]) / 2e-4, abs=2e-3)


@pytest.fixture(scope="module")
def finder(spark):
    return train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_tagger_finds_other_spellings(finder):
    examples = made_up(["the and of thing with that for under"], 400, seed=123)
    right = missed = extra = 0
    for (text, spans), (_, found) in zip(examples, finder([t for t, _ in examples])):
        right += len(set(spans) & set(found))
        missed += len(set(spans) - set(found))
        extra += len(set(found) - set(spans))
    assert right > 6 * missed and extra < 0.1 * right
    assert tag_numbers(10, WINDOW, [("ip", 8, 13)])[:4].tolist() == [4, 4, 4, 0]


def test_query(spark):
    rows = QUERIES["op8_pii"](spark, "/root/testdata/sf0.01").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    added = 0
    for r in rows:
        base = {f"{k}:{a}:{b}" for k, a, b in plain(texts[r.doc_id])}
        spans = set(r.spans.split(",")) - {""}
        assert base <= spans and [r[f"n_{k}"] for k in KINDS] == [sum(s.startswith(k) for s in spans) for k in KINDS]
        added += len(spans - base)
    assert added <= 5  # this data spells nothing otherwise


def test_awkward_rows(spark, finder):
    docs = awkward(spark, extra=True)
    assert find(docs, finder, ["doc_id", "score"]).count() == docs.count()
    masked = redact(docs, finder)
    assert masked.columns == docs.columns
    assert sorted(map(str, (r.text for r in masked.collect()))) == sorted(map(str, (r.text for r in docs.collect())))
    assert find(empty(spark), finder, ["doc_id"]).count() == 0 and redact(empty(spark), finder).count() == 0
    mail = spark.createDataFrame([(1, "é a.b@c.org or 10.0.0.1!", 5)], "doc_id long, text string, n_chars long")
    (row,) = redact(mail, finder).collect()
    assert row.text == "é [EMAIL] or [IP]!" and row.n_chars == len(row.text)
    assert redacted("abcdef", [("ip", 1, 3), ("card", 2, 5)]) == "a[IP]f"
    train(empty(spark))
