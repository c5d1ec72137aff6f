"""Thin queries over the operators, with production parameters, each over its whole table; and their SQL where SQL has it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, language_id, line_dedup, mixing, near_dedup, packing, pii, quality_model, quality_rules, warc
from .common import crc_fold, documents


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of base spans by kind, their digest, and all spans, for each document; null and empty texts have none."""
    found = pii.find(documents(spark, sf_dir))
    count = [F.expr(f"size(filter(base, x -> x.kind = {i}))").cast("long").alias(f"n_{kind}") for i, kind in enumerate(pii.KINDS)]
    return found.select("doc_id", *count, F.sha2(F.expr(pii.span_text("base")), 256).alias("base_sha256"), F.expr(pii.span_text("spans")).alias("spans"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of equal texts for each document; null texts are empty ones, repeated rows count one by one and one of them is kept."""
    out = exact_dedup.exact_duplicates(documents(spark, sf_dir))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document and how many went as later repeats; the rest by its digest. Null texts have no lines."""
    out = line_dedup.line_dedup(documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2("text", 256).alias("text_sha256"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of token ids and their places in sequences of 2,048; a document without text is its end id alone."""
    out = packing.packed(documents(spark, sf_dir), with_ids=False)
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded_length")


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of each document by two-word shingles; documents without a word are linked with nothing."""
    out = near_dedup.near_duplicates(documents(spark, sf_dir), p=near_dedup.Params(shingle_words=2))
    return out.select("doc_id", "n_shingles", "component_id", "kept")


def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of each document; learned from the labels of documents that are not held out. Empty texts are scored as well."""
    held_out = crc_fold("id", 5) == 0
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = quality_model.score(documents(spark, sf_dir), labels, held_out)
    return out.select("doc_id", F.coalesce(crc_fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cell, probability and draw of each document; null source, language or topic is a category of its own."""
    out = mixing.mix(documents(spark, sf_dir))
    return out.select("doc_id", "source", "lang", "topic", "n_tokens", "probability", "sampled")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the WARC archive made of all pages says of each; a null html is an empty payload."""
    out = warc.convert_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of each document; null and empty texts have no words and fail."""
    out = quality_rules.judge(documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "covered_fraction", "longest_repeat")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document; `und` without a letter. Learned from documents that are not held out and have a language."""
    out = language_id.predict(documents(spark, sf_dir), crc_fold("id", 4) == 2)
    return out.select("doc_id", F.coalesce(crc_fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_pii, op2_exact_dedup, op3_line_dedup, op4_packing, op5_near_dedup, op6_quality_model, op7_mixing, op8_warc, op9_quality_rules, op10_language_id)
    return {f.__name__: f for f in own}


OP2 = """
with t as (select doc_id, coalesce(text, '') as text from documents)
select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size, doc_id = max(doc_id) over g as kept, sha256(text) as text_sha256
from t window g as (partition by text)
"""

OP3 = r"""
with docs as (select doc_id, coalesce(text, '') as text from documents),
raw as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as pos from docs where text <> ''),
lines as (select doc_id, pos, trim(line) as line, row_number() over (partition by doc_id order by pos) as k,
                 len(list_filter(regexp_split_to_array(trim(line), '[\x20\t-\r]+'), lambda x: x <> '')) as n_words
          from raw where regexp_matches(trim(line), '[^\x20\t-\r]')),
spans as (select a.doc_id, a.pos as first, b.pos as last, '2' || a.line || chr(10) || b.line as key from lines a join lines b on b.doc_id = a.doc_id and b.k = a.k + 1
          union all select doc_id, pos, pos, '1' || line from lines where n_words >= 50),
marked as (select doc_id, first, last, min({'d': doc_id, 'f': first}) over (partition by key) as source from spans),
gone as (select distinct m.doc_id, unnest(range(m.first, m.last + 1)) as pos from marked m where {'d': doc_id, 'f': first} > source),
runs as (select g.doc_id, count(*) as n_removed, count(*) filter (where not exists (select 1 from gone h where h.doc_id = g.doc_id and h.pos = g.pos - 1)) as n_runs from gone g group by g.doc_id),
rest as (select r.doc_id, string_agg(r.line, chr(10) order by r.pos) as text from raw r where not exists (select 1 from gone g where g.doc_id = r.doc_id and g.pos = r.pos) group by r.doc_id)
select d.doc_id, case when d.text = '' then 0 else len(string_split(d.text, chr(10))) end::BIGINT as n_lines, coalesce(n_removed, 0)::BIGINT as n_removed,
       coalesce(n_runs, 0)::BIGINT as n_runs, sha256(coalesce(rest.text, '')) as text_sha256
from docs d left join runs using (doc_id) left join rest using (doc_id)
"""

OP8 = """
with p as (select page_id, coalesce(html, '') as html, octet_length(encode(coalesce(html, '')))::BIGINT as payload_bytes from pages),
g as (select *, max(page_id) over (partition by html) as best from p)
select page_id, payload_bytes, sha1(html) as payload_digest, case when payload_bytes >= 1000 and page_id <> best then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 1000 and page_id <> best then best end as refers_to
from g
"""


def _op7(p: mixing.Params = mixing.Params()) -> str:
    """The same steps as the operator's, unrolled."""
    quoted = lambda words: ", ".join(f"'{w}'" for w in words)
    known = sorted({w for _, words, _ in p.vocabulary for w in words.split()})
    counts = ", ".join(f"len(list_filter(hits, lambda w: w in ({quoted([*words.split(), *terms.split()])})))" for _, words, terms in p.vocabulary)
    margins = mixing.MARGINS
    parts = [
        "docs as (select doc_id, source, lang, coalesce(text, '') as text from documents)",
        rf"found as (select doc_id, source, lang, text, len(regexp_extract_all(text, '{mixing.WORD}'))::BIGINT as n_tokens, list_concat(list_filter(regexp_split_to_array(lower(text), '{mixing.APART}'), lambda w: w in ({quoted(known)})), regexp_extract_all(text, '{mixing.terms_pattern(p.vocabulary)}')) as hits from docs)",
        f"counted as (select doc_id, source, lang, n_tokens, case when doc_id is null then md5(text) end as print, [{counts}] as n from found)",
        f"rows as (select doc_id, source, lang, print, case when list_max(n) > 0 then [{quoted(name for name, _, _ in p.vocabulary)}][list_position(n, list_max(n))] else 'other' end as topic, n_tokens from counted)",
        f"cells as (select {', '.join(margins)}, sum(n_tokens)::BIGINT as tokens from rows group by all having sum(n_tokens) > 0)",
        "mass as (select *, " + ", ".join(f"power(sum(tokens) over (partition by {m})::DOUBLE, {p.flatten}) as mass_{m}, count(*) over (partition by {m}) as cells_{m}" for m in margins) + " from cells)",
        f"s0 as (select {', '.join(margins)}, tokens, tokens::DOUBLE / ({p.keep_share} * sum(tokens) over ()) as cap, tokens::DOUBLE / sum(tokens) over () as weight, " + ", ".join(f"mass_{m} / sum(mass_{m} / cells_{m}) over () as target_{m}" for m in margins) + " from mass)",
    ]
    step = 0
    for _ in range(p.sweeps):
        for m in margins:
            parts.append(f"s{step + 1} as materialized (select * replace (least(cap, weight * target_{m} / sum(weight) over (partition by {m})) as weight) from s{step})")
            step += 1
    for _ in range(2):
        open_ = "sum(case when weight < cap then weight else 0.0 end) over ()"
        parts.append(f"s{step + 1} as materialized (select * replace (least(cap, case when weight < cap and {open_} > 0 then weight * (1 + (1 - sum(weight) over ()) / {open_}) else weight end) as weight) from s{step})")
        step += 1
    parts.append(f"rates as (select {', '.join(margins)}, least(1.0, round(weight / cap, 9)) as probability from s{step})")
    on = " and ".join(f"r.{m} is not distinct from x.{m}" for m in margins)
    uniform = f"('0x' || substr(md5('{p.seed}:' || coalesce(doc_id::VARCHAR, 't' || print)), 1, 12))::BIGINT::DOUBLE / 281474976710656.0"
    return f"""with {", ".join(parts)}
select doc_id, r.source, r.lang, r.topic, n_tokens, coalesce(probability, 1.0) as probability, {uniform} < coalesce(probability, 1.0) as sampled from rows r left join rates x on {on}"""


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_dedup": OP2, "op3_line_dedup": OP3, "op7_mixing": _op7(), "op8_warc": OP8}
