from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from lakeload.llm.rules import BIT, CURRENT, MEASURES, POLICIES, ablations, apply_policy, ledger, measure
from llm.helpers import awkward, empty


def plain(text):
    words = text.encode().split()
    windows = Counter(zip(words, words[1:], words[2:]))
    again = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return {
        "n_words": len(words), "word_chars": sum(len(w.decode()) for w in words),
        "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_lines": len(lines),
        "n_dup_lines": sum(x in lines[:i] for i, x in enumerate(lines)), "n_repeat_words": len(again),
    }


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab é#\n\t\x1c", max_size=80))
def test_measures(text):
    got = dict(zip(MEASURES, measure(text.encode())))
    assert {k: got[k] for k in plain(text)} == plain(text)


def test_policies_and_ablations(spark):
    entries = ledger(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), ["doc_id"]).cache()
    failed = [r.failed for r in entries.collect()]
    for policy in POLICIES:
        rows = apply_policy(entries, policy).collect()
        assert all(r.kept == (r.failed & policy.mask == 0) and r.policy == policy.version for r in rows)
        assert all(r.base_failed == bool(r.failed & (BIT["short"] | BIT["repeats"])) for r in rows)
    seen = {r.rule: r for r in ablations(entries, CURRENT).collect()}
    for rule, bit in BIT.items():
        masks = [f & CURRENT.mask for f in failed]
        assert seen[rule].failing == sum(bool(m & bit) for m in masks)
        assert seen[rule].failing_only == sum(m == bit for m in masks)
        assert seen[rule].kept_without == sum(m & ~bit == 0 for m in masks)
    entries.unpersist()


def test_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.01"
    verdict = apply_policy(ledger(spark.read.parquet(f"{sf}/documents.parquet"), ["doc_id"]))
    rows = verdict.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("not base_failed").collect()
    clean, junk = ([r.kept for r in rows if r.quality == q] for q in (1, 0))
    assert sum(clean) >= 0.98 * len(clean) and sum(junk) <= 0.5 * len(junk)


def test_awkward_rows(spark):
    docs = awkward(spark, extra=True)
    rows = apply_policy(ledger(docs, ["doc_id", "size"])).collect()
    assert len(rows) == docs.count() and all(r.base_failed for r in rows if not r.n_words)
    assert apply_policy(ledger(empty(spark), ["doc_id"])).count() == 0
    assert sum(r.failing for r in ablations(ledger(empty(spark), ["doc_id"])).collect()) == 0
