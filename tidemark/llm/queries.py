"""Registered queries of this package, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    ann, bpe, chat, exact_dedup, fill_in_middle, jaccard_join, license_scan, line_dedup, mixing, periodic_runs,
    substring_dedup, token_files, toxicity,
)
from tidemark.llm.common import WORD
from tidemark.session import scratch_path
from tidemark.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op1_nearest")
def op1(spark, d):
    return ann.nearest(table(spark, d, "embeddings"), F.col("vec_id") % 50 == 0)


@register("op2_chat_format", """
with t as (select conv_id, row_number() over (partition by conv_id order by turn nulls first,
                  coalesce(role, ''), coalesce(text, '')) as k,
                  '<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '')
                  || '<|im_end|>' || chr(10) as piece
           from conversations where conv_id is not null),
p as (select conv_id, k, count(*) over (partition by conv_id) as n,
             string_agg(piece, '' order by k) over (partition by conv_id order by k
                 rows between unbounded preceding and current row) as chat from t),
whole as (select n as n_turns, chat, min(conv_id) as conv_id, count(*) as n_copies
          from p where k = n group by n, chat)
select conv_id, n_turns, n_copies, chat from whole w
where not exists (select 1 from p where p.k < p.n and p.k = w.n_turns and p.chat = w.chat)
""")
def op2(spark, d):
    return chat.format_chats(table(spark, d, "conversations"))


@register("op3_jaccard_join")
def op3(spark, d):
    return jaccard_join.jaccard_components(table(spark, d, "documents"))


@register("op4_toxicity")
def op4(spark, d):
    docs = table(spark, d, "documents")
    labels = table(spark, d, "labels").filter(~toxicity.held_out())
    scored = toxicity.score(docs.select("doc_id", "text"), toxicity.train(docs, labels))
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


@register("op5_bpe")
def op5(spark, d):
    return bpe.encode_decode_digests(table(spark, d, "documents"), vocabulary())


@register("op6_token_files")
def op6(spark, d):
    out = scratch_path(spark, "token_files")
    token_files.write_tokens(table(spark, d, "documents"), out, vocabulary())
    return token_files.read_tokens(spark, out).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@register("op7_exact_dedup", """
with t as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz') as norm from documents),
g as (select norm, max(doc_id) as keep_id, count(*) as group_size from t group by norm)
select t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id as kept, sha256(t.norm) as text_sha256
from t join g on t.norm = g.norm
""")
def op7(spark, d):
    out = exact_dedup.exact_dedup(table(spark, d, "documents"), digest_all=True)
    return out.select("doc_id", "keep_id", "group_size", "kept",
                      F.lower(F.hex("digest")).alias("text_sha256"))


@register("op8_substring_dedup")
def op8(spark, d):
    return substring_dedup.substring_dedup(table(spark, d, "documents"), line_words=1)


@register("op9_line_dedup")
def op9(spark, d):
    out = line_dedup.line_dedup(table(spark, d, "documents"), exact_words=1)
    return out.select("doc_id", "text", "n_removed")


@register("op10_mixing")
def op10(spark, d):
    documents, mix = mixing.mix_sources(table(spark, d, "documents"))
    return mixing.taken_words(documents, mix).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "source")


@register("op11_license_scan")
def op11(spark, d):
    return license_scan.license_scan(table(spark, d, "documents")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with one document in ten made periodic from a word on,
    as drawn from the CRC of its id: word i >= a becomes a + (i - a) % p."""
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    cut = (docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
           .withColumn("words", F.when(F.col("h") % 10 == 0, words))
           .withColumn("n", F.size("words"))
           .withColumn("g", F.floor(F.col("h") / 10))
           .withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
           .withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")))
    turns = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), turns)),
                   F.lit(1), F.col("n") - F.col("a"))
    planted = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return cut.select("doc_id", F.when(F.col("a").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


@register("op12_periodic_runs")
def op12(spark, d):
    return periodic_runs.periodic_runs(with_planted_runs(table(spark, d, "documents"))).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
        F.col("text_sha256").alias("collapsed_sha256"))


@register("op13_fill_in_middle", """
with t as (select doc_id, coalesce(text, '') as text, sha256('7:' || coalesce(cast(doc_id as varchar), '')) as h
           from documents),
u as (select doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') as units,
             ('0x' || substr(h, 1, 8))::bigint as h1, ('0x' || substr(h, 9, 8))::bigint as h2,
             ('0x' || substr(h, 17, 8))::bigint as h3, ('0x' || substr(h, 25, 8))::bigint as h4 from t),
c as (select *, cast(len(units) as bigint) as n,
             case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>')
                       or h3 % 100 >= 100 then 'plain' when h4 % 100 < 50 then 'spm' else 'psm' end as form from u),
k as (select *, least(h1 % (n + 1), h2 % (n + 1)) as lo, greatest(h1 % (n + 1), h2 % (n + 1)) as hi from c),
s as (select *, array_to_string(units[1:lo], '') as prefix, array_to_string(units[lo + 1:hi], '') as middle,
             array_to_string(units[hi + 1:], '') as suffix from k)
select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars,
       case when form <> 'plain' then length(middle) end as middle_chars,
       sha256(case form when 'plain' then text
                        when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(text) as restored_sha256
from s
""")
def op13(spark, d):
    return fill_in_middle.fill_in_middle(table(spark, d, "documents"))
