"""Registered queries: each dealt operator over its whole table, in the form its contract asks for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.llm import (
    decontamination,
    divergence,
    exact_dedup,
    licenses,
    lm_scoring,
    near_dedup,
    ngram_join,
    packing,
    pii,
    secrets,
    spelling,
    token_ledger,
    toxicity,
)
from tillwatch.llm.text import table
from tillwatch.sources.scratch import scratch_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def by_start(spans: Column, kinds: tuple[str, ...]) -> Column:
    """Spans by start, then kind in the order given, then by name."""
    order = F.array(*[F.lit(k) for k in kinds])

    def key(s: Column) -> Column:
        place = F.array_position(order, s.kind)
        return F.struct(s.start.alias("a"), F.when(place == 0, 1000).otherwise(place).alias("b"), s.kind.alias("kind"), s.end.alias("end"))

    ordered = F.array_sort(F.transform(spans, key))
    return F.transform(ordered, lambda k: F.struct(k.kind.alias("kind"), k.a.alias("start"), k.end.alias("end")))


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")


@query
def op1_harmonic_packing(spark, sf):
    pieces = packing.pack(table(spark, sf, "documents"), vocabulary())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op2_secret_scan(spark, sf):
    spans = secrets.scan_secrets(table(spark, sf, "documents"))
    everything = by_start(F.concat("base", "found"), secrets.KINDS)
    return spans.select(
        "doc_id",
        *[count_kind(F.col("base"), k) for k in secrets.KINDS],
        F.sha2(span_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        span_text(everything).alias("spans"),
    )


@query
def op3_decontamination(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    marked = decontamination.contamination(docs, table(spark, sf, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s.end - s.start)
    items = F.array_join(F.array_sort("items"), ",")
    return marked.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(items.cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


ORACLE["op3_decontamination"] = r"""
with lowered as (
  select 'd' kind, doc_id id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') t from documents
  union all
  select 'b', item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') from benchmark
), worded as (
  select kind, id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from lowered
), items as (
  select id, w, least(10, len(w)) k from worded where kind = 'b' and len(w) > 0
), windows as (
  select distinct id, k, w[i : i + k - 1] phrase from (select id, w, k, unnest(range(1, len(w) - k + 2)) i from items)
), doc_windows as (
  select id, i, k, w[i : i + k - 1] phrase from (
    select id, w, k, unnest(range(1, len(w) - k + 2)) i
    from worded, (select distinct k from items) where kind = 'd' and len(w) >= k)
), hits as (
  select d.id, d.i, d.k, b.id item from doc_windows d join windows b on d.k = b.k and d.phrase = b.phrase
), hit_words as (
  select id, count(distinct p) n_hit from (select id, unnest(range(i, i + k)) p from (select distinct id, i, k from hits)) group by id
), hit_items as (
  select id, count(*) n_items, string_agg(item, ',' order by item) names from (select distinct id, item::varchar item from hits) group by id
)
select w.id doc_id, len(w.w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items,
  sha256(coalesce(names, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from worded w left join hit_words h on h.id = w.id left join hit_items i on i.id = w.id where w.kind = 'd'
"""

VERSION = "word_bpe_49k"


@query
def op4_token_rollup(spark, sf):
    """All documents are loaded, low-quality ones recounted without junk, toxic ones taken out, and the load replayed."""
    docs = table(spark, sf, "documents")
    labels = table(spark, sf, "labels")
    ledger = token_ledger.TokenLedger(spark, scratch_folder(spark, "ledger"))

    def changes(op: str, of: DataFrame) -> DataFrame:
        return token_ledger.count_tokens(of, vocabulary(), VERSION).withColumn("op", F.lit(op))

    cleaned = docs.withColumn("text", F.regexp_replace("text", "[%&$*#!]{3,}", ""))
    poor = labels.filter("quality = 0").select("doc_id")
    toxic = labels.filter("toxic = 1").select(
        F.lit("delete").alias("op"), "doc_id", *[F.lit(None).cast("string").alias(c) for c in ("source", "lang")],
        F.lit(VERSION).alias("tokenizer"), F.lit(None).cast("long").alias("n_tokens"),
    )
    ledger.commit("load", changes("insert", docs))
    # Counted before the join, so that counts are shuffled and not texts.
    ledger.commit("recount", changes("revise", cleaned).join(poor, "doc_id", "left_semi"))
    ledger.commit("takedown", toxic)
    ledger.commit("load", changes("insert", docs))
    return ledger.totals()


@query
def op5_license_scan(spark, sf):
    return licenses.find_licenses(table(spark, sf, "documents"))


@query
def op6_content_sort(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return exact_dedup.content_sort(docs, keep="max", texts=False)


ORACLE["op6_content_sort"] = """
select doc_id, max(doc_id) over same keep_id, count(*) over same group_size,
  doc_id = max(doc_id) over same kept, sha256(coalesce(text, '')) text_sha256
from documents window same as (partition by coalesce(text, ''))
"""


@query
def op7_toxicity_chain(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    chain = toxicity.fit_chain(docs, table(spark, sf, "labels"))
    return toxicity.score_chain(docs, chain).drop("text")


@query
def op8_hyperminhash(spark, sf):
    shape = near_dedup.HyperMinHash(percent=85)
    found = near_dedup.near_duplicates(table(spark, sf, "documents"), shape)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


ORACLE["op8_hyperminhash"] = r"""
with recursive worded as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w
  from documents
), shingles as (
  select distinct doc_id, hash(w[i : i + 4]) s, w[i : i + 4] p
  from (select doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) i from worded where len(w) > 0)
), sizes as (
  select doc_id, count(*) n from shingles group by doc_id
), common as (
  select a.doc_id x, b.doc_id y, count(*) c from shingles a join shingles b on a.s = b.s and a.p = b.p and a.doc_id < b.doc_id
  group by all
), links as (
  select x, y from common join sizes a on a.doc_id = x join sizes b on b.doc_id = y where 100 * c >= 85 * (a.n + b.n - c)
), both_ways as (
  select x, y from links union all select y, x from links
), reach(x, y) as (
  select x, y from both_ways union select r.x, b.y from reach r join both_ways b on b.x = r.y
), lowest as (
  select x, min(y) y from reach group by x
)
select w.doc_id, coalesce(n, 0)::bigint n_shingles, least(w.doc_id, coalesce(y, w.doc_id)) component_id,
  w.doc_id <= coalesce(y, w.doc_id) kept
from worded w left join sizes s on s.doc_id = w.doc_id left join lowest l on l.x = w.doc_id
"""


@query
def op9_pii_field(spark, sf):
    docs = table(spark, sf, "documents")
    spans = pii.find_pii(docs, pii.fit_field(docs))
    everything = by_start(F.concat("base", "found"), pii.KINDS)
    return spans.select(
        "doc_id",
        *[count_kind(F.col("base"), k) for k in pii.KINDS],
        F.sha2(span_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        span_text(everything).alias("spans"),
    )


@query
def op10_suffix_tree(spark, sf):
    docs = table(spark, sf, "documents")
    return lm_scoring.score_documents(docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 2)


@query
def op11_ngram_join(spark, sf):
    return ngram_join.ngram_links(table(spark, sf, "documents"))


ORACLE["op11_ngram_join"] = ORACLE["op8_hyperminhash"].replace(">= 85 *", ">= 80 *").replace(
    """ component_id,
  w.doc_id <= coalesce(y, w.doc_id) kept""",
    " component_id",
)


@query
def op12_spelling_variants(spark, sf):
    return spelling.spelling_forms(table(spark, sf, "documents").select("doc_id", "text"))


@query
def op13_source_divergence(spark, sf):
    return divergence.divergence(table(spark, sf, "documents"))


ORACLE["op13_source_divergence"] = r"""
with docs as (
  select coalesce(lang, '') lang, coalesce(source, '') source, row_number() over () id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') w
  from documents
), groups as (
  select distinct lang, source from docs
), counted as (
  select lang, source, id, term, count(*) n from (select lang, source, id, unnest(w) term from docs) group by all
), kept as (
  select lang, term, sum(n)::hugeint n from counted group by all having count(*) >= 10
), langs as (
  select lang, count(*) v, sum(n)::hugeint n from kept group by lang
), counts as (
  select c.lang, c.source, c.term, sum(c.n)::hugeint n from counted c join kept k on k.lang = c.lang and k.term = c.term group by all
), totals as (
  select lang, source, sum(n)::hugeint n from counts group by all
), dense as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) n, 1 + (1000000000::hugeint * (coalesce(c.n, 0) + 2)) // (coalesce(t.n, 0) + 2 * l.v) p,
    1 + (1000000000::hugeint * (k.n + 2)) // (l.n + 2 * l.v) q
  from groups g join kept k on k.lang = g.lang join langs l on l.lang = g.lang
    left join totals t on t.lang = g.lang and t.source = g.source
    left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term
), sums as (
  select a.lang, a.source, b.source item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) value
  from dense a join dense b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
), valued as (
  select a.lang, a.source, 'pair' part, b.source item, coalesce(s.value, 0)::bigint value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
    left join sums s on s.lang = a.lang and s.source = a.source and s.item = b.source
  union all
  select lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::bigint from dense where n > 0 and p > q
), ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, item)::int rank from valued
)
select * from ranked where part = 'pair' or rank <= 10
"""
