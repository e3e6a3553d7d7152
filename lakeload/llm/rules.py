"""Quality rules as a ledger: measure once, keep a bit per failed rule, apply policies later.

``ledger`` reads each whole text once and writes its measurements with one bitmask: bit i is set where rule
i fails. A policy is a version and the set of rules it enforces; applying one, or finding what each rule
costs, needs the ledger alone and no text.

Words lie between ASCII white space. Null and empty texts have no words and all measurements 0, and so fail
the rule on short texts. Rows are judged one by one, so equal rows get equal verdicts and no key matters.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.llm.common import per_batch, utf8

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper_words")

#: Rules in bit order: name and the condition under which a text fails. Whole numbers only, so that every
#: engine decides alike.
RULES = (
    ("short", "n_words < 50"),
    ("repeats", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("word_length", "n_words > 0 and (10 * word_chars < 35 * n_words or word_chars > 10 * n_words)"),
    ("dup_lines", "n_dup_lines >= 3 and 10 * n_dup_lines > 3 * n_lines"),
    ("upper", "10 * n_upper_words > 7 * n_words"),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}
BASE = BIT["short"] | BIT["repeats"]


@dataclass(frozen=True)
class Policy:
    """The rules that a version enforces."""

    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


POLICIES = (
    Policy(1, ("short", "repeats")),
    Policy(2, ("short", "repeats", "symbols", "dup_lines")),
    Policy(3, ("short", "repeats", "symbols", "word_length", "dup_lines", "upper")),
)
CURRENT = POLICIES[-1]

_SPACE = np.array([32, 9, 10, 11, 12, 13])
_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)


def _upper(word: bytes) -> bool:
    """Two ASCII capitals or more and no small ASCII letter."""
    return word.isupper() and sum(map(word.count, _CAPITALS)) > 1


_CAPITALS = [bytes([c]) for c in range(65, 91)]


def measure(text: bytes | None) -> tuple[int, ...]:
    """The measurements of one text in the order of ``MEASURES``."""
    if not text:
        return (0,) * len(MEASURES)
    words = text.split()
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    chars = len(text) - int(counts[128:192].sum()) - int(counts[_SPACE].sum())
    lines = [x for x in text.split(b"\n") if x.strip()]
    windows = list(zip(words, words[1:], words[2:]))
    covered = 0
    if len(seen := Counter(windows)) < len(windows):
        end = 0  # words before it are counted already
        for i, w in enumerate(windows):
            if seen[w] > 1:
                covered += i + 3 - max(i, end)
                end = i + 3
    small = text.lower() == text  # without capitals there is nothing to look for
    return (
        len(words), chars, int(counts[_SYMBOLS].sum()), len(lines), len(lines) - len(set(lines)), covered,
        0 if small else sum(map(_upper, filter(bytes.isupper, words))),
    )


def _measured():
    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = list(zip(*map(measure, utf8(batch.column("text")))))
        others = [i for i, n in enumerate(batch.schema.names) if n != "text"]
        return pa.RecordBatch.from_arrays(
            [batch.column(i) for i in others] + [pa.array(f, pa.int64()) for f in found],
            names=[batch.schema.names[i] for i in others] + list(MEASURES),
        )

    return each


def ledger(docs: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, the measurements and the mask of failed rules for each row with a ``text``."""
    source = docs.select(*keys, "text")
    kinds = {f.name: f.dataType.simpleString() for f in source.schema}
    schema = ", ".join([f"`{k}` {kinds[k]}" for k in keys] + [f"{m} long" for m in MEASURES])
    measured = source.mapInArrow(per_batch(_measured), schema)
    mask = sum((F.when(F.expr(fails), F.lit(BIT[name])).otherwise(F.lit(0)) for name, fails in RULES), F.lit(0))
    return measured.withColumn("failed", mask.cast("long"))


def fails(mask: int) -> Column:
    return F.col("failed").bitwiseAND(F.lit(mask)) != 0


def apply_policy(entries: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """The ledger with base_failed, the verdict and the version that gave it."""
    return entries.withColumns(
        {"base_failed": fails(BASE), "kept": ~fails(policy.mask | BASE), "policy": F.lit(policy.version)}
    )


def ablations(entries: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """For each rule of a policy: texts failing it, texts failing nothing else, and texts kept without it.

    One pass: ledger rows are first counted by mask, of which there are at most 2 ** rules.
    """
    masks = entries.groupBy(F.col("failed").bitwiseAND(F.lit(policy.mask)).alias("failed")).agg(
        F.count(F.lit(1)).alias("n")
    )
    bits = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit")) for r in policy.rules]))
    each = masks.select("failed", "n", bits.alias("r")).select("failed", "n", "r.*")
    fails_it = F.col("failed").bitwiseAND(F.col("bit")) != 0
    only = F.col("failed") == F.col("bit")
    return each.groupBy("rule").agg(
        F.sum(F.when(fails_it, F.col("n")).otherwise(0)).alias("failing"),
        F.sum(F.when(only, F.col("n")).otherwise(0)).alias("failing_only"),
        F.sum(F.when(only | (F.col("failed") == 0), F.col("n")).otherwise(0)).alias("kept_without"),
    )
