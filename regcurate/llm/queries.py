"""Registered queries of the training-data operators, with production
parameters, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regcurate.llm import (classifier, cover_tree, decontaminate, fixity, jaccard, packing,
                           page_text, quality_rules, sharding, suffix_dedup, token_files, turns,
                           url_lists)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- 1 quality rules ----------------------------------------------------------

def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document; cutoffs certified on the
    labelled holdout of each language."""
    judged = quality_rules.judge(table(spark, sf_dir, "documents"),
                                 table(spark, sf_dir, "labels"), keep=["doc_id"])
    return judged.select("row.doc_id", "f.n_words", "f.word_chars", "f.n_symbols",
                         "f.n_dup_lines", "f.n_repeat_words", "base_failed", "kept")


def _op1_sql() -> str:
    rules = quality_rules.RULES
    n = len(rules[0].cutoffs)
    firsts = ", ".join("case " + " ".join(
        f"when ({r.feature}) {'>' if r.above else '<'} {c!r}::double then {j}"
        for j, c in enumerate(r.cutoffs, 1)) + f" else {n + 1} end" for r in rules)
    risk = f"{quality_rules.RISK!r}::double"
    return f"""
with t as (
  select doc_id, lang, coalesce(text, '') as text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
                lambda w: w <> '') as words,
    list_filter(string_split(coalesce(text, ''), chr(10)),
                lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines
  from documents),
w as (
  select *, case when len(words) < 3 then [] else list_transform(range(1, len(words) - 1),
      lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) end as grams from t),
hits as (
  select doc_id, count(distinct i + k) as n from (
    select doc_id, i, count(*) over (partition by doc_id, g) as c from (
      select doc_id, unnest(grams) as g, unnest(range(0, len(grams))) as i from w)),
    (values (0), (1), (2)) as s(k) where c > 1 group by doc_id),
f as (
  select w.doc_id, lang, len(words)::bigint as n_words,
    length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g'))::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    coalesce(hits.n, 0)::bigint as n_repeat_words
  from w left join hits using (doc_id)),
b as (select *, (n_words < 50 or 100 * n_repeat_words > 50 * n_words) as base_failed from f),
good as (select doc_id from labels group by doc_id having max(quality) = 1),
level as (select b.*, case when n_words = 0 then {n + 1} else least({firsts}) end as rejected_from
  from b),
held as (select doc_id, lang, min(rejected_from) as r from level
  where not base_failed and doc_id in (select doc_id from good) group by all),
steps(s) as (select unnest(range(1, {n + 1}))),
k as (select lang, s, count(*) as n, count(*) filter (r <= s) as k from held, steps group by all),
p as (
  select k.*, case when k < n * {risk} then list_sum(list_transform(range(0, k + 1),
      lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({risk})
               + (n - j) * ln(1 - {risk})))) else 1 end as p from k),
cut as (
  select lang, coalesce(min(s) filter (p > {quality_rules.DELTA!r}::double
    / (select count(distinct coalesce(lang, chr(0))) from held)), {n + 1}) - 1 as setting
  from p group by lang)
select b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  (not base_failed and rejected_from > coalesce(setting, 0)) as kept
from level b left join cut c on b.lang is not distinct from c.lang
"""


# --- 2 classifier -------------------------------------------------------------

def op2_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from labels not held out."""
    return classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# --- 3 sharding ---------------------------------------------------------------

def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 39 with row counts at most one apart."""
    placed = sharding.assign(table(spark, sf_dir, "documents"), shards=40, vnodes=32)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                         "slot", F.lit(None).cast("int").alias("grown_shard"))


# --- 4 fixity -----------------------------------------------------------------

_RECORD_BYTES = 512     # header bytes of a record in the stand-in archives


def _replicas(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Stand-in archives: pages in id order, 1,000 ids to an archive, each at the
    offset behind its predecessor; and a replica in which, picked by MD5, some
    records are gone, some have other bytes and some stand there twice with other
    bytes. Payloads are hashed where they are read; offsets are summed over ids
    and lengths alone."""
    html = F.coalesce("html", F.lit(""))
    other = F.concat(F.substring(html, 1, 40), F.lit("?"), F.expr(
        "substring(coalesce(html, ''), 42)"))
    d = F.conv(F.substring(F.md5(html.cast("binary")), 1, 6), 16, 10).cast("long") % 211
    read = table(spark, sf_dir, "pages").select(
        F.expr("concat('part-', page_id div 1000)").alias("archive"),
        F.col("page_id").alias("record_id"), (F.octet_length(html) + _RECORD_BYTES).alias("size"),
        d.alias("d"), fixity.digest_of(html).alias("payload_sha256"),
        F.when(d == 0, fixity.digest_of(other)).when(d == 2, fixity.digest_of(F.upper(html)))
        .alias("again"))
    before = Window.partitionBy("archive").orderBy("record_id") \
        .rowsBetween(Window.unboundedPreceding, -1)
    placed = read.withColumn("at", F.coalesce(F.sum("size").over(before), F.lit(0)))
    columns = ["archive", "at", "record_id", "payload_sha256"]
    damaged = placed.where("d <> 1").withColumn("payload_sha256", F.explode(
        F.when(F.col("d") == 0, F.array("again")).when(
            F.col("d") == 2, F.array("payload_sha256", "again"))
        .otherwise(F.array("payload_sha256"))))
    return placed.select(columns), damaged.select(columns)


def op4_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places where the second replica of the archives differs from the first."""
    found = fixity.audit(*_replicas(spark, sf_dir))
    return found.select("archive", "at", F.col("record_id").alias("page_id"), "status")


_OP4_SQL = f"""
with r as (
  select 'part-' || (page_id // 1000) as archive, page_id, coalesce(html, '') as h,
    coalesce(sum(strlen(coalesce(html, '')) + {_RECORD_BYTES}) over (partition by page_id // 1000
      order by page_id rows between unbounded preceding and 1 preceding), 0)::bigint as "at",
    list_sum(list_transform(range(1, 7), lambda i: (strpos('0123456789abcdef',
      substr(md5(coalesce(html, '')), i, 1)) - 1) * (16 ** (6 - i))::bigint))::bigint % 211 as d
  from pages)
select archive, "at", page_id, case when d = 1 then 'missing' else 'altered' end as status
from r where d in (1, 2) or (d = 0 and substring(h, 1, 40) || '?' || substring(h, 42) <> h)
"""


# --- 5 URL lists --------------------------------------------------------------

def _captures_sql() -> str:
    return "select page_id, url, date '2024-01-01' + cast((page_id * 37) % 366 as int) as fetched_on"


def _list_events() -> str:
    """Stand-in list entries from the hosts of the pages: three lists, each
    taking hosts up and off again, and one domain listed as a whole."""
    host = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1))"
    return f"""
with h as (select {host} as host, min(page_id) as p, count(*) as c from pages
           group by {host} having {host} <> '')
select 'ads' as list_name, host, date '2024-01-01' + cast((p * 13) % 300 as int) as dated,
       true as listed from h where p % 3 = 0
union all select 'ads', host, date '2024-01-01' + cast((p * 13) % 300 + 45 as int), false
  from h where p % 6 = 0
union all select 'ads', host, date '2024-01-01' + cast((p * 13) % 300 + 80 as int), true
  from h where p % 12 = 0
union all select 'malware', host, date '2023-12-01' + cast((p * 7) % 200 as int), true
  from h where p % 5 = 0
union all select 'malware', host, date '2023-12-01' + cast((p * 7) % 200 + 30 as int), p % 2 = 0
  from h where p % 5 = 0
union all select 'adult', regexp_extract(host, '([^.]+[.][^.]+)$', 1),
       date '2024-06-01' + cast(p % 60 as int), c > 1 from h where p % 7 = 0
"""


def op5_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page against the list entries active at its fetch date."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = spark.sql(_captures_sql() + " from {pages}", pages=pages)
    entries = spark.sql(_list_events().replace("from pages", "from {pages}"), pages=pages)
    return url_lists.judge_captures(captures, entries)


def _op5_sql() -> str:
    host = "nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '')"
    return f"""
with captures as (select page_id, fetched_on::date as fetched_on, {host} as host
                  from ({_captures_sql()} from pages)),
events as (select list_name, lower(host) as host, dated::date as dated, bool_or(listed) as listed
           from ({_list_events()}) group by all),
spans as (select list_name, host as domain, dated as valid_from, listed,
          lead(dated) over (partition by list_name, host order by dated) as valid_to from events),
hits as (
  select c.page_id, count(*) as n, min(list_name) as first_list
  from captures c join spans s on (c.host = s.domain or ends_with(c.host, '.' || s.domain))
   and listed and fetched_on >= valid_from and (valid_to is null or fetched_on < valid_to)
  group by c.page_id)
select c.page_id, c.host, c.fetched_on, coalesce(n, 0)::bigint as n_active, first_list,
       n is not null as blocked
from captures c left join hits using (page_id)
"""


# --- 6 token files ------------------------------------------------------------

def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as token files and read back, frame by frame. The
    vocabulary has fewer than 2**16 ids, so the files hold 16-bit ids."""
    return token_files.encode_and_read(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
        end_id=2, dtype="<u2")


# --- 7 suffix-array dedup -------------------------------------------------------

def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated 200-byte strings."""
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


# --- 8 packing ----------------------------------------------------------------

def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"),
                        public_tokenizers.path("byte_bpe_50k.json"), end_id=0, length=1024)


# --- 9 Jaccard join -----------------------------------------------------------

def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document at similarity 0.8."""
    return jaccard.linked(table(spark, sf_dir, "documents"))


# --- 10 decontamination -------------------------------------------------------

def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in a document within its error budget."""
    return decontaminate.matches(table(spark, sf_dir, "documents"),
                                 table(spark, sf_dir, "benchmark"))


# --- 11 hard negatives --------------------------------------------------------

def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First five negatives per anchor and positive; one row in seven has the
    next label, as mislabelled rows have."""
    finite = table(spark, sf_dir, "embeddings").where(
        "forall(embedding, x -> x is not null and not isnan(x) and abs(x) < float('infinity'))")
    rows = finite.select(
        "vec_id", F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)").alias("label"),
        F.expr("transform(embedding, x -> floor(256D * cast(x as double)))").alias("vector"))
    return cover_tree.hard_negatives(
        rows, anchors=F.col("vec_id") % 100 == 0, positives=5, negatives=5,
        low=80, high=100)


_OP11_SQL = """
with v as (
  select vec_id, (case when vec_id % 7 = 0 then (label + 1) % 10 else label end) as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as anchor_id, a.label as own, b.vec_id, b.label,
    list_inner_product(a.v, b.v)::bigint as score
  from v a, v b where a.vec_id % 100 = 0 and a.vec_id <> b.vec_id and len(a.v) = len(b.v)),
p as (
  select * from s where own = label
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
n as (
  select p.anchor_id, p.vec_id as positive_id, p.score as positive_score,
    s.vec_id as negative_id, s.score as negative_score
  from p join s on s.anchor_id = p.anchor_id and s.label <> s.own
   and 100 * s.score between 80 * p.score and 100 * p.score)
select anchor_id, positive_id, cast(row_number() over w as int) as rank, negative_id,
  positive_score, negative_score
from n window w as (partition by anchor_id, positive_id order by negative_score desc, negative_id)
qualify row_number() over w <= 5
"""


# --- 12 HTML extraction ---------------------------------------------------------

def op12_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = page_text.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"),
                        "n_lines", "n_shared", "n_deleted")


# --- 13 conversation repair -----------------------------------------------------

def _damaged_turns(conversations: DataFrame) -> DataFrame:
    """Stand-in damage by crc32 of ``conv_id:turn``: rows dropped, emptied, cut
    off, repeated, given another role."""
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        F.expr("crc32(cast(concat(coalesce(cast(conv_id as string), ' '), ':', "
               "coalesce(cast(turn as string), ' ')) as binary)) % 20").alias("d")).where("d <> 0")
    return rows.withColumns({
        "role": F.when(F.col("d") == 4, "user").otherwise(F.col("role")),
        "text": F.when(F.col("d") == 1, "").when(
            F.col("d") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")),
        "again": F.explode(F.expr("if(d = 3, array(1, 2), array(1))"))}) \
        .select("conv_id", "turn", "role", "text")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit and hash of every conversation's cheapest repair."""
    conversations = table(spark, sf_dir, "conversations")
    return turns.repair(_damaged_turns(conversations), conversations.select("conv_id"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline at the top of the repository."""
    import corpus_pipeline            # not part of the package: only this query needs it

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_classifier": op2_classifier,
    "op3_sharding": op3_sharding,
    "op4_fixity": op4_fixity,
    "op5_url_lists": op5_url_lists,
    "op6_token_files": op6_token_files,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_packing": op8_packing,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_decontamination": op10_decontamination,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_page_text": op12_page_text,
    "op13_conversation_repair": op13_conversation_repair,
    "pipeline": pipeline,
}

ORACLE = {
    "op1_quality_rules": _op1_sql(),
    "op4_fixity": _OP4_SQL,
    "op5_url_lists": _op5_sql(),
    "op11_hard_negatives": _OP11_SQL,
}
