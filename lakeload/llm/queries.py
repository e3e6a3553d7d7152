"""Queries over the whole test tables, one per operator, and SQL where it can say the same."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.llm import (
    alignment, bpe, chat, codes, lm, mixing, neardup, packing, pii, rules, sharding, toxicity, vectors,
)
from lakeload.llm.common import WORD, per_batch, remainder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query()
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes from each document, with its source's size and target."""
    m = mixing.mix(table(spark, sf_dir, "documents"))
    return m.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


@query()
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 15 with counts at most one apart; equal texts get no special treatment under this law."""
    keys = sharding.document_keys(table(spark, sf_dir, "documents"))
    placed = sharding.assign(spark, keys, ["doc_id", "size", "text_crc32"], 16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _digests(encoder: bpe.Encoder, text: str | None) -> tuple[int, str, str]:
    ids = encoder.encode(text).tolist()
    written = encoder.written(ids).encode()
    return len(ids), hashlib.sha256(written).hexdigest(), hashlib.sha256(encoder.decode(ids)).hexdigest()


DIGESTS = {
    "n_tokens": ("long", pa.int64()), "ids_sha256": ("string", pa.string()), "decoded_sha256": ("string", pa.string()),
}
VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


@query()
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, and their bytes decoded again, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coder = bpe.Bpe(spark, VOCABULARY, public_tokenizers.PATTERN).prepare(docs)
    return coder.apply(docs, DIGESTS, _digests, ["doc_id"])


_OP4 = rf"""
with d as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '{WORD}') as ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) as ls
  from documents),
w as (
  select rid, i, case when l2 is null then false else count(*) over (partition by rid, word, l1, l2) > 1 end as again
  from (select rid, i, word, lead(word) over o as l1, lead(word, 2) over o as l2
        from (select rid, unnest(ws) as word, generate_subscripts(ws, 1) as i from d)
        window o as (partition by rid order by i))),
r as (
  select rid, count(*) filter (where again or coalesce(b1, false) or coalesce(b2, false)) as n
  from (select rid, again, lag(again) over o as b1, lag(again, 2) over o as b2 from w
        window o as (partition by rid order by i)) group by rid),
m as (
  select doc_id, len(ws) as n_words, length(array_to_string(ws, '')) as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols, len(ls) as n_lines,
    len(ls) - len(list_distinct(ls)) as n_dup_lines, coalesce(r.n, 0) as n_repeat_words,
    len(list_filter(ws, lambda x: regexp_matches(x, '[A-Z][^a-z]*[A-Z]') and not regexp_matches(x, '[a-z]'))) as n_upper_words
  from d left join r using (rid)),
f as (
  select *, {" + ".join(f"(case when {fails} then {rules.BIT[name]} else 0 end)" for name, fails in rules.RULES)} as failed
  from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed, failed = 0 as kept,
  cast(failed as bigint) as failed, {rules.CURRENT.version} as policy
from f"""


@query(_OP4)
def op4_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of all documents under the current policy."""
    entries = rules.apply_policy(rules.ledger(table(spark, sf_dir, "documents"), ["doc_id"]))
    return entries.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "failed", "policy",
    )


@query()
def op5_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of all documents."""
    return lm.score(table(spark, sf_dir, "documents"), bpe.load_ranks(VOCABULARY))


@query()
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    held_out = (remainder(F.col("doc_id"), 4) == 2).alias("held_out")
    return toxicity.score(docs, model).select("doc_id", held_out, "score", "predicted")


@query()
def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents on two-word shingles."""
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"), neardup.Near(words=2))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query()
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.train(docs), ["doc_id"])
    counts = [F.regexp_count("spans", F.lit(rf"(?:^|,){k}:")).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


@query()
def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all vectors at a cosine of 0.95 or more."""
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


_PROBE = "</s>[INST] ok [/INST]"


def _escaped(column: str) -> str:
    """Length of a column with its escapes."""
    return (
        f"length({column}) + length({column}) - length(replace({column}, '\\', '')) "
        f"+ len(regexp_extract_all({column}, '{chat._CONTROLS.pattern}'))"
    )


_OP10 = rf"""
with c as (
  select conv_id, turn, role, text from conversations
  union all values (-1, 0, 'user', '{_PROBE}'), (-1, 1, 'assistant', '{_PROBE}')),
t as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (
    partition by conv_id order by turn nulls first, role nulls first, text nulls first) as n
  from c)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by n)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by n) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum({len(chat.OPEN + chat.CLOSE) + 1} + {_escaped("role")} + length(role) - length(replace(role, chr(10), ''))
    + {_escaped("text")}) as bigint) as formatted_chars
from t group by conv_id"""


def _read_back():
    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for conv, formatted, loss in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss"))):
            turns, learned = chat.parse(formatted), [chat.unescape(formatted[s["start"]:s["end"]]) for s in loss]
            out.append((
                conv, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                sum(map(len, learned)), hashlib.sha256("".join(learned).encode()).hexdigest(), len(formatted),
            ))
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return each


@query(_OP10)
def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and a probe, streamed as events, folded, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", _PROBE), (-1, 1, "assistant", _PROBE)], rows.schema)
    formatted = chat.format_chats(chat.log_of_turns(rows.unionByName(probe)))
    return formatted.mapInArrow(
        per_batch(_read_back),
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


@query()
def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4,096 ids."""
    cut = packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(cut)


def _op12_round(books: str) -> str:
    """Parts with their nearest entry of ``books`` and its distance."""
    return f"""select p.rid, p.part, p.xs, min({{'d': p.norm - 2 * list_dot_product(p.xs, b.xs) + b.norm, 'e': b.entry}}) as best
  from p join {books} b using (part) group by p.rid, p.part, p.xs"""


def _op12_books(before: str, nearest: str) -> str:
    """Entries replaced by the floors of the means of their parts; unused ones stay."""
    return f"""select b.part, b.entry, coalesce(m.xs, b.xs) as xs, list_dot_product(coalesce(m.xs, b.xs), coalesce(m.xs, b.xs)) as norm
  from {before} b left join (
    select part, entry, list(cast((s - ((s % n) + n) % n) // n as double) order by i) as xs from (
      select part, entry, i, cast(sum(x) as bigint) as s, count(*) as n from (
        select part, best.e as entry, unnest(xs) as x, generate_subscripts(xs, 1) as i from {nearest})
      group by part, entry, i) group by part, entry) m using (part, entry)"""


_OP12 = f"""
with v as materialized (
  select row_number() over (order by vec_id, xs) as rid, vec_id, label, xs from (
    select vec_id, label, list_transform(embedding, lambda x: floor(1024 * cast(x as double))) as xs from embeddings
    where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)),
p as materialized (
  select rid, part, xs, list_dot_product(xs, xs) as norm from (
    select rid, part, list_slice(xs, part * (len(xs) // 4) + 1, (part + 1) * (len(xs) // 4)) as xs
    from v, range(4) t(part))),
b0 as materialized (select part, rid - 1 as entry, xs, norm from p where rid <= 256),
{"".join(f"n{r} as materialized ({_op12_round(f'b{r}')}), b{r + 1} as materialized ({_op12_books(f'b{r}', f'n{r}')}), " for r in range(4))}
n4 as materialized ({_op12_round("b4")}),
c as (select rid, string_agg(format('{{:02x}}', best.e), '' order by part) as code, cast(sum(best.d) as bigint) as error from n4 group by rid),
h as (select sha256(string_agg(cast(cast(x as bigint) as varchar), ',' order by part, entry, i)) as digest
  from (select part, entry, unnest(xs) as x, generate_subscripts(xs, 1) as i from b4))
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, digest as codebooks_sha256
from c join v using (rid), h"""


@query(_OP12)
def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors with their errors."""
    return codes.compress(table(spark, sf_dir, "embeddings"))


@query()
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two vocabularies aligned over all documents, links counted corpus-wide."""
    first, second = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align(table(spark, sf_dir, "documents"), first, second, public_tokenizers.PATTERN)
