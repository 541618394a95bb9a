"""Registered queries of the training-data operators: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.llm import (
    ann,
    bpe,
    filter_audit,
    hard_negatives,
    html_text,
    lang_id,
    minhash,
    order_minhash,
    packing,
    passages,
    piece_bpe,
    sharding,
    url_trust,
)
from reviewlens.llm.common import small_batches

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@register("op7_bpe")
def q_bpe(spark: SparkSession, sf: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf, "documents").select("doc_id", "text")
    ids = docs.select("doc_id", bpe.encode("text").alias("ids"))
    both = ids.select("doc_id", "ids", bpe.decode("ids").alias("decoded"))
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


#: (verdict, host and path) of the registered url query.
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


@register("op1_url_trust")
def q_url_trust(spark: SparkSession, sf: str) -> DataFrame:
    return url_trust.judge_urls(table(spark, sf, "pages"), URL_RULES)


def _url_oracle(rounds: int = 60) -> str:
    """Rules by length, then trust and distrust by rounds of the same flow, written out."""
    upper, lower = url_trust.UPPER, url_trust.LOWER

    def host(url: str) -> str:
        return f"translate(coalesce(regexp_extract({url}, '(?s)^.*?://([^/?#]*)', 1), ''), '{upper}', '{lower}')"

    def decided(host: str, path: str, what: str) -> str:
        cases = []
        for verdict, rule in sorted(URL_RULES, key=lambda r: -len(r[1])):
            name, slash, rest = rule.partition("/")
            fits = f"({host} = '{name}' or ends_with({host}, '.{name}')) and starts_with({path}, '{slash}{rest}')"
            cases.append(f"when {fits} then '{rule if what == 'rule' else verdict}'")
        return "case " + " ".join(cases) + " end"

    link, other = url_trust.LINK.replace("'", "''"), url_trust.NOT_LINKS.replace("'", "''")
    steps = []
    for i in range(1, rounds + 1):
        steps.append(
            f"s{i} as materialized (select b.host, b.trust + {url_trust.DAMPING} * coalesce(t.t, 0) as trust, "
            f"b.distrust + {url_trust.DAMPING} * coalesce(t.d, 0) as distrust from s0 b left join ("
            "select e.dst as host, sum(case when way > 0 then trust * share end) as t, "
            f"sum(case when way < 0 then distrust * share end) as d from edges e join s{i - 1} s on e.src = s.host "
            "group by e.dst) t on b.host = t.host)"
        )
    return f"""
with p as (
  select page_id, html, {host('url')} as host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path from pages),
j as (select page_id, host, path, {decided('host', 'path', 'rule')} as rule, {decided('host', 'path', 'verdict')} as ruled from p),
found as (
  select host as src, unnest(regexp_extract_all(regexp_replace(html, '{other}', ' ', 'g'), '{link}', 1)) as url
  from p where host <> ''),
l as materialized (
  select src, dst, count(*) as n from (
    select src, {host("case when starts_with(url, '//') then 'x:' || url else url end")} as dst from found) t
  where dst <> '' and src <> dst group by all),
own as (
  select host, case when 2 * sum((ruled = 'allow')::int) > count(*) then 1
                    when 2 * sum((ruled = 'block')::int) > count(*) then -1 else 0 end as seed
  from (select host, coalesce(ruled, '') as ruled from j where host <> '') t group by host),
linked as (
  select distinct dst as host, case {decided('dst', "'/'", 'verdict')} when 'allow' then 1 when 'block' then -1 else 0 end as seed
  from l where dst not in (select host from own)),
s0 as materialized (
  select host, (seed > 0)::int::double as trust, (seed < 0)::int::double as distrust
  from (select * from own union all select * from linked) t),
edges as materialized (
  select l.src, l.dst, 1 as way, l.n / o.total as share from l join (select src, sum(n) as total from l group by src) o on l.src = o.src
  union all
  select l.dst, l.src, -1, l.n / o.total from l join (select src, sum(n) as total from l group by src) o on l.src = o.src),
{', '.join(steps)},
bad as (select host from s{rounds} where distrust >= {url_trust.MIN_DISTRUST} and distrust > trust)
select page_id, host, path, rule,
       coalesce(ruled, case when host in (select host from bad) then 'block' else 'allow' end) as verdict from j
"""


ORACLE["op1_url_trust"] = _url_oracle()


@register("op2_site_templates")
def q_html_text(spark: SparkSession, sf: str) -> DataFrame:
    small_batches(spark)
    return html_text.extract(table(spark, sf, "pages"))


@register("op3_byte_gru")
def q_lang_id(spark: SparkSession, sf: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf, "documents")
    found = lang_id.identify("text", lang_id.learn(docs)).alias("found")
    told = docs.select("doc_id", lang_id.held_out("doc_id").alias("held_out"), found)
    return told.select("doc_id", "held_out", "found.lang_pred", "found.score")


@register("op4_rotated_codes")
def q_ann(spark: SparkSession, sf: str) -> DataFrame:
    small_batches(spark)
    return ann.search(table(spark, sf, "embeddings"))


ORACLE["op4_rotated_codes"] = """
with v as (
  select vec_id, min(embedding::double[]) as e from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
  group by vec_id),
pairs as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e) as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e) where q.vec_id % 20 = 0),
ranked as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as "rank" from pairs)
select query_id, "rank", vec_id, score from ranked where "rank" <= 20
"""


@register("op5_differencing")
def q_sharding(spark: SparkSession, sf: str) -> DataFrame:
    small_batches(spark)
    rows = sharding.shard_documents(table(spark, sf, "documents"), shards=40)
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@register("op6_suffix_dedup")
def q_passages(spark: SparkSession, sf: str) -> DataFrame:
    small_batches(spark)
    cut = passages.remove(table(spark, sf, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@register("op8_order_minhash")
def q_order_minhash(spark: SparkSession, sf: str) -> DataFrame:
    prints = order_minhash.fingerprint_documents(table(spark, sf, "documents"), whole=True)
    return prints.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        order_minhash.fingerprint("tuples").alias("fingerprint"),
        order_minhash.fingerprint("edited_tuples").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


@register("op9_minmax")
def q_minhash(spark: SparkSession, sf: str) -> DataFrame:
    small_batches(spark)
    return minhash.near_duplicates(table(spark, sf, "documents"), size=3, percent=85).drop("hash")


ORACLE["op9_minmax"] = f"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{url_trust.UPPER}', '{url_trust.LOWER}'),
                                    '[^\\x20\\x09-\\x0D]+') as words from documents),
g as (
  select doc_id, list_distinct(
    case when len(words) >= 3 then list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])
         when len(words) > 0 then [array_to_string(words, ' ')] else [] end) as grams from w),
n as (select doc_id, cast(len(grams) as bigint) as n_shingles from g),
s as (select doc_id, unnest(grams) as gram from g),
common as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.gram = b.gram and a.doc_id < b.doc_id group by all),
links as (
  select a, b from common join n x on x.doc_id = a join n y on y.doc_id = b
  where 100 * c >= 85 * (x.n_shingles + y.n_shingles - c)),
ways as (select a, b from links union all select b, a from links),
reach as (select doc_id, doc_id as other from n union select reach.doc_id, ways.b from reach join ways on ways.a = reach.other),
lowest as (select doc_id, min(other) as component_id from reach group by doc_id)
select doc_id, n_shingles, component_id, doc_id = component_id as kept from n join lowest using (doc_id)
"""


@register("op10_packing")
def q_packing(spark: SparkSession, sf: str) -> DataFrame:
    small_batches(spark)
    return packing.piece_digest(packing.pack(table(spark, sf, "documents")))


@register("op11_piece_bpe")
def q_piece_bpe(spark: SparkSession, sf: str) -> DataFrame:
    small_batches(spark)
    both = table(spark, sf, "documents").select("doc_id", piece_bpe.round_trip("text").alias("t")).select("doc_id", "t.*")
    return both.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@register("op12_filter_audit")
def q_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    small_batches(spark)
    return filter_audit.audit_documents(table(spark, sf, "documents"), table(spark, sf, "labels"))


def _audit_oracle() -> str:
    """Each step of each order counted by itself; Shapley sums from the removals of all orders."""
    letters = filter_audit.FILTERS
    steps = []
    for order in permutations(letters):
        done = 0
        for i, letter in enumerate(order, 1):
            bit = 1 << letters.index(letter)
            steps.append(f"('{''.join(order)}', {i}, {done}, {bit})")
            done |= bit
    return f"""
with d as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
f as (select text, min(doc_id) as first from d group by text),
l as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
m as (
  select part, (len(words) < 50)::int + 2 * (100 * len(list_distinct(words)) < 65 * len(words))::int
         + 4 * (100 * len(regexp_replace(d.text, '[^A-Z]', '', 'g')) > 5 * len(d.text))::int
         + 8 * regexp_matches(d.text, '[#$%&*|]')::int + 16 * coalesce(d.doc_id > f.first, false)::int as mask,
         coalesce(l.good, 0) as good, coalesce(l.toxic, 0) as toxic
  from d join f on d.text = f.text left join l on d.doc_id = l.doc_id),
c as (select part, mask, count(*) as n, sum(good) as good, sum(toxic) as toxic from m group by part, mask),
steps(filter_order, step, done, bit) as (values {', '.join(steps)}),
e as (
  select part, filter_order, step, bit,
         sum(case when mask & (done | bit) = 0 then n else 0 end) as kept,
         sum(case when mask & done = 0 and mask & bit <> 0 then n else 0 end) as removed,
         sum(case when mask & done <> 0 and mask & bit <> 0 then n else 0 end) as redundant,
         sum(case when mask = bit then n else 0 end) as unique_fails,
         sum(case when mask & done = 0 and mask & bit <> 0 then good else 0 end) as good_lost,
         sum(case when mask & done = 0 and mask & bit <> 0 then toxic else 0 end) as toxic_lost
  from c cross join steps group by all)
select part, filter_order, cast(step as integer) as step,
       kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant, unique_fails::bigint as unique_fails,
       good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
       cast(sum(removed) over (partition by part, bit) as bigint) as shapley
from e
"""


ORACLE["op12_filter_audit"] = _audit_oracle()


@register("op13_hard_negatives")
def q_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    small_batches(spark)
    label = F.col("label").cast("decimal(20,0)")  # no overflow
    changed = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(table(spark, sf, "embeddings"), label=changed)


ORACLE["op13_hard_negatives"] = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: cast(floor(256 * x::double) as bigint)) as q
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (
  select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same,
         cast(list_sum(list_transform(list_zip(a.q, c.q), lambda t: t[1] * t[2])) as bigint) as score
  from v a join v c on a.vec_id <> c.vec_id and len(a.q) = len(c.q) where a.vec_id % 100 = 0),
p as (
  select anchor_id, vec_id as positive_id, score as positive_score from pairs where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
n as (
  select p.anchor_id, positive_id, positive_score, vec_id as negative_id, score as negative_score,
         cast(row_number() over (partition by p.anchor_id, positive_id order by score desc, vec_id) as integer) as "rank"
  from p join pairs x on x.anchor_id = p.anchor_id and not same
  where 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score)
select anchor_id, positive_id, "rank", negative_id, positive_score, negative_score from n where "rank" <= 10
"""
