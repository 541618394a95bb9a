"""Independent SQL for the registered queries, in DuckDB's dialect.

The driver runs these on the same Parquet tables (registered as views) and
compares row count, schema and values with the Spark result.  They are
written from the query definitions, not generated from the Spark plans.
"""

from __future__ import annotations

from reviewlens.functions.stopwords import ENGLISH_STOP_WORDS

REVIEWS = """
reviews as (
  select d.doc_id as review_id,
         case when d.doc_id % 29 = 0 then null
              else concat('r', cast(d.doc_id % 97 as varchar)) end as reviewer,
         case when l.quality = 1 then 6 + d.doc_id % 5
              when l.quality = 0 then 1 + d.doc_id % 5 end as rating,
         case when d.doc_id % 31 = 0 then null
              else split_part(d.text, chr(10), 1) end as review_summary,
         d.text as review_detail,
         case when d.doc_id % 23 = 0 then null
              when d.doc_id % 19 = 0 then concat('n/a,', cast(d.doc_id % 7 as varchar))
              when d.doc_id % 17 = 0 then cast(d.doc_id % 11 as varchar)
              else concat(cast(d.doc_id % 13 as varchar), ',', cast(d.doc_id % 7 as varchar))
         end as helpful_str
  from documents d left join labels l on d.doc_id = l.doc_id
)"""

REVIEWS_SCALE = """
reviews as (
  select l.l_orderkey * 10 + l.l_linenumber as review_id,
         concat('c', cast(o.o_custkey as varchar)) as reviewer,
         1 + l.l_orderkey % 10 as rating,
         concat(cast(l.l_orderkey % 13 as varchar), ',', cast(l.l_linenumber as varchar)) as helpful_str
  from lineitem l join orders o on l.l_orderkey = o.o_orderkey
)"""

_INT = r"'^\s*([+-]?\d+)(?:\.\d*)?\s*$'"


def _vote(i: int) -> str:
    part = f"string_split(helpful_str, ',')[{i}]"
    return (
        f"case when regexp_matches({part}, '^\\s*[+-]?\\.\\d+\\s*$') then 0 "
        f"else try_cast(regexp_extract({part}, {_INT}, 1) as integer) end"
    )


PARSED = f"""
parsed as (
  select review_id, reviewer, helpful_str,
         {_vote(1)} as helpful_votes,
         {_vote(2)} as non_helpful_votes
  from reviews
)"""

COMPLETE = """
complete as (
  select * from reviews
  where review_summary is not null and review_detail is not null and rating is not null
)"""

COMPLETE_PARSED = PARSED.replace("parsed as", "cparsed as").replace("from reviews", "from complete")

NET = """
net as (
  select reviewer,
         cast(sum(helpful_votes) as bigint) as total_helpful_votes,
         cast(sum(non_helpful_votes) as bigint) as total_non_helpful_votes,
         cast(sum(helpful_votes) as bigint) - cast(sum(non_helpful_votes) as bigint) as net_helpful_votes
  from cparsed group by reviewer
)"""

COUNTS = """
counts as (
  select reviewer, count(*) as review_count from cparsed group by reviewer
)"""

RATES = """
rates as (
  select n.reviewer, n.total_helpful_votes, n.total_non_helpful_votes, n.net_helpful_votes,
         c.review_count, n.net_helpful_votes / cast(c.review_count as double) as helpful_rate
  from net n join counts c on n.reviewer = c.reviewer
)"""

_VOTES = ",".join([REVIEWS, COMPLETE, COMPLETE_PARSED, NET, COUNTS, RATES])


def _with(*ctes: str) -> str:
    return "with " + ",".join(ctes) + "\n"


def _rank(table: str, by: str, desc: bool) -> str:
    order = "desc" if desc else "asc"
    return (
        "with " + _VOTES + f"\nselect * from {table} where net_helpful_votes is not null "
        f"order by {by} {order}, reviewer asc limit 20"
    )


ORACLE: dict[str, str] = {
    "reviews_view": _with(REVIEWS) + "select * from reviews",
    "csv_scan": _with(REVIEWS)
    + "select review_id, reviewer, cast(rating as double) as rating, review_summary, "
    "review_detail, helpful_str from reviews",
    "csv_scan_split": _with(REVIEWS)
    + "select review_id, reviewer, cast(rating as double) as rating, review_summary, "
    "review_detail, helpful_str from reviews",
    "require_summary": _with(REVIEWS)
    + "select * from reviews where review_summary is not null and rating is not null",
    "require_detail": _with(REVIEWS)
    + "select * from reviews where review_detail is not null and rating is not null",
    "require_both": _with(REVIEWS, COMPLETE) + "select * from complete",
    "label_sentiment": _with(REVIEWS)
    + "select review_id, reviewer, rating, case when rating > 5 then 1 else 0 end as sentiment "
    "from reviews where review_summary is not null and rating is not null",
    "drop_summary": _with(REVIEWS)
    + "select review_id, reviewer, rating, review_detail, helpful_str from reviews",
    "parse_votes": _with(REVIEWS, PARSED) + "select * from parsed",
    "vote_totals": "with " + _VOTES
    + "\nselect reviewer, total_helpful_votes, total_non_helpful_votes from net",
    "net_votes": "with " + _VOTES + "\nselect * from net",
    "review_counts": "with " + _VOTES + "\nselect * from counts",
    "helpful_rate_join": "with " + _VOTES + "\nselect * from rates",
    "helpful_rate_single_pass": "with " + _VOTES + "\nselect * from rates",
    "top_net": _rank("net", "net_helpful_votes", desc=True),
    "bottom_net": _rank("net", "net_helpful_votes", desc=False),
    "top_rate": _rank("rates", "helpful_rate", desc=True),
    "bottom_rate": _rank("rates", "helpful_rate", desc=False),
    "bottom_rate_literal": _rank("rates", "net_helpful_votes", desc=False),
}

_SCALE = ",".join(
    [
        REVIEWS_SCALE,
        PARSED.replace("parsed as", "cparsed as"),
        NET,
        COUNTS,
        RATES,
    ]
)
ORACLE["votes_scale"] = "with " + _SCALE + "\nselect * from rates"
ORACLE["votes_scale_top_rate"] = (
    "with " + _SCALE + "\nselect * from rates where net_helpful_votes is not null "
    "order by helpful_rate desc, reviewer asc limit 20"
)


# --- split and folds ---------------------------------------------------------


def _bucket(key: str, salt: str, n: int) -> str:
    return f"(('0x' || substr(md5(concat(cast({key} as varchar), ':{salt}')), 1, 8))::bigint % {n})"


SUMMARY_LABELLED = """
lab as (
  select *, case when rating > 5 then 1 else 0 end as sentiment from reviews
  where review_summary is not null and rating is not null
)"""

DETAIL_LABELLED = SUMMARY_LABELLED.replace("review_summary is not null", "review_detail is not null")

TRAIN = f"""
train as (select * from lab where {_bucket('review_id', '123', 100)} < 80)"""

ORACLE["hash_split"] = (
    _with(REVIEWS)
    + f"select review_id, case when {_bucket('review_id', '123', 100)} < 80 then 'train' else 'test' end as split "
    "from reviews"
)
ORACLE["hash_folds"] = (
    _with(REVIEWS, SUMMARY_LABELLED, TRAIN)
    + f"select review_id, sentiment, cast({_bucket('review_id', '123:fold', 10)} as integer) as fold from train"
)
ORACLE["split_class_counts"] = (
    _with(REVIEWS, SUMMARY_LABELLED)
    + f"select case when {_bucket('review_id', '123', 100)} < 80 then 'train' else 'test' end as split, "
    "sentiment, count(*) as n from lab group by all"
)
ORACLE["fold_class_counts"] = (
    _with(REVIEWS, SUMMARY_LABELLED, TRAIN)
    + f"select cast({_bucket('review_id', '123:fold', 10)} as integer) as fold, sentiment, count(*) as n "
    "from train group by all"
)

# --- tokens ------------------------------------------------------------------

_STOP = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH_STOP_WORDS) + "]"


def _tokens(text: str) -> str:
    """Lower case, split on every whitespace character, drop trailing empty tokens."""
    stripped = f"regexp_replace(lower({text}), '\\s+$', '')"
    return (
        f"case when {stripped} = '' and {text} <> '' then []::varchar[] "
        f"else string_split_regex({stripped}, '\\s') end"
    )


def _content(toks: str) -> str:
    return f"list_filter({toks}, lambda w: not list_contains({_STOP}, w))"


def _token_rows(where: str, text: str, content: bool) -> str:
    toks = _tokens(text)
    if content:
        toks = _content(toks)
    return (
        _with(REVIEWS)
        + f", t as (select review_id, {toks} as toks from reviews where {where})\n"
        + "select review_id, cast(generate_subscripts(toks, 1) - 1 as integer) as pos, unnest(toks) as token from t"
    )


_S_WHERE = "review_summary is not null and rating is not null"
_D_WHERE = "review_detail is not null and rating is not null"
ORACLE["tokens_summary"] = _token_rows(_S_WHERE, "review_summary", False)
ORACLE["content_tokens_summary"] = _token_rows(_S_WHERE, "review_summary", True)
ORACLE["tokens_detail"] = _token_rows(_D_WHERE, "review_detail", False)
ORACLE["content_tokens_detail"] = _token_rows(_D_WHERE, "review_detail", True)


def _vocab(labelled_cte: str, text: str) -> str:
    return (
        _with(REVIEWS, labelled_cte, TRAIN)
        + f", t as (select unnest({_content(_tokens(text))}) as token from train)\n"
        + "select token, count(*) as n from t group by token having count(*) >= 5"
    )


ORACLE["vocabulary_summary"] = _vocab(SUMMARY_LABELLED, "review_summary")
ORACLE["vocabulary_detail"] = _vocab(DETAIL_LABELLED, "review_detail")

# --- metrics on a fixed score -------------------------------------------------

SCORED = """
scored as (
  select review_id, case when rating > 5 then 1 else 0 end as y,
         (review_id * 37 % 1000) / 1000.0::double as s
  from reviews where rating is not null
),
cm as (
  select y as label, cast(case when s > 0.5 then 1 else 0 end as integer) as prediction, count(*) as n
  from scored group by all
)"""

ORACLE["eval_confusion"] = _with(REVIEWS, SCORED) + "select * from cm"
ORACLE["eval_accuracy"] = (
    _with(REVIEWS, SCORED)
    + "select sum(case when label = prediction then n else 0 end) / cast(sum(n) as double) as accuracy from cm"
)
ORACLE["eval_f1"] = (
    _with(REVIEWS, SCORED)
    + """, sup as (select label as l, sum(n) as sup from cm group by all),
prd as (select prediction as l, sum(n) as prd from cm group by all),
tp as (select label as l, n as tp from cm where label = prediction),
per as (
  select sup.l, sup.sup, coalesce(prd.prd, 0) as prd, coalesce(tp.tp, 0) as tp
  from sup left join prd on sup.l = prd.l left join tp on sup.l = tp.l
)
select sum(sup * case when tp = 0 then 0.0::double else 2.0::double * tp / (sup + prd) end) / sum(sup) as f1
from per"""
)
ORACLE["eval_auc"] = (
    _with(REVIEWS, SCORED)
    + """, by_score as (select s, sum(y) as pos, sum(1 - y) as neg from scored group by s),
cum as (
  select pos, neg,
         coalesce(sum(neg) over (order by s rows between unbounded preceding and 1 preceding), 0) as below
  from by_score
)
select cast(sum(pos * (2 * below + neg)) as double) / cast(2 * sum(pos) * sum(neg) as double) as auc from cum"""
)


# --- votes written as fractions ------------------------------------------------

ORACLE["parse_vote_fractions"] = (
    _with(
        "reviews as (select doc_id as review_id, concat(case when doc_id % 7 < 2 then '-.' when doc_id % 7 < 4 then '.' "
        "else '+' end, cast(doc_id % 7 as varchar), ', .', cast(doc_id % 5 as varchar)) as helpful_str from documents)",
        PARSED.replace("review_id, reviewer, helpful_str", "review_id, helpful_str"),
    )
    + "select * from parsed"
)

# --- rows without a key --------------------------------------------------------

_NULL_KEY = "case when review_id is null then {content} else cast(review_id as varchar) end"
# the columns that each step sees, null as chr(0), separated by chr(31)
_SPLIT_KEY = _NULL_KEY.format(
    content="md5(concat(coalesce(reviewer, chr(0)), chr(31), coalesce(helpful_str, chr(0)), chr(31), digest))"
)
_FOLD_KEY = _NULL_KEY.format(content="md5(concat(coalesce(helpful_str, chr(0)), chr(31), digest, chr(31), split))")
ORACLE["hash_split_null_keys"] = (
    _with(REVIEWS)
    + ", r as (select case when review_id % 5 <> 0 then review_id end as review_id, reviewer, helpful_str, "
    "md5(review_detail) as digest from reviews),\n"
    f"s as (select *, case when {_bucket(_SPLIT_KEY, '123', 100)} < 80 then 'train' else 'test' end as split from r)\n"
    f"select review_id, digest, split, cast({_bucket(_FOLD_KEY, '123:fold', 10)} as integer) as fold from s"
)

# --- what can be stated of the learned part -------------------------------------


def _content_of(text: str) -> str:
    return _content(_tokens(text))


def _embed_facts(columns: list[str]) -> str:
    """Rows, sides and dimensions; a vector is zero when no content token is in its column's training vocabulary."""
    present = " and ".join(f"{c} is not null" for c in [*columns, "rating"])
    vocab = ",\n".join(
        f"v{i} as (select token from (select unnest({_content_of(c)}) as token from side where split = 'train') "
        "group by token having count(*) >= 5)"
        for i, c in enumerate(columns)
    )
    hits = ",\n".join(
        f"h{i} as (select distinct review_id from (select review_id, unnest({_content_of(c)}) as token from side) t "
        f"where token in (select token from v{i}))"
        for i, c in enumerate(columns)
    )
    zero = " and ".join(f"review_id not in (select review_id from h{i})" for i in range(len(columns)))
    return (
        _with(REVIEWS)
        + ", lab as (select *, case when rating > 5 then 1 else 0 end as sentiment from reviews where "
        + present
        + f"),\nside as (select *, case when {_bucket('review_id', '123', 100)} < 80 then 'train' else 'test' end as split "
        + f"from lab),\n{vocab},\n{hits}\n"
        + f"select review_id, sentiment, split, cast({100 * len(columns)} as integer) as dims, {zero} as is_zero from side"
    )


ORACLE["embed_facts_summary"] = _embed_facts(["review_summary"])
ORACLE["embed_facts_detail"] = _embed_facts(["review_detail"])
ORACLE["embed_facts_both"] = _embed_facts(["review_summary", "review_detail"])



def _embed_hashed(columns: list[str], dim: int = 100, seed: int = 42) -> str:
    """Mean of hashed word vectors, in whole multiples of 2^-30, over the content tokens."""
    present = " and ".join(f"{c} is not null" for c in [*columns, "rating"])
    parts = ",\n".join(
        f"t{i} as (select review_id, split, {_content_of(c)} as toks from side),\n"
        f"w{i} as (select token from (select unnest(toks) as token from t{i} where split = 'train') "
        "group by token having count(*) >= 5),\n"
        f"u{i} as (select token, i, cast(floor((('0x' || substr(md5(concat(token, ':{seed}:', cast(i as varchar))), 1, 8))::bigint "
        f"- 2147483648)::double * (1073741824::double / ({dim}::double * 4294967296::double))) as bigint) as unit "
        f"from w{i}, unnest(range({dim})) r(i)),\n"
        f"m{i} as (select review_id, token, count(*) as m from (select review_id, unnest(toks) as token from t{i}) x group by all),\n"
        f"s{i} as (select review_id, i, sum(m * unit) as total from m{i} join u{i} using (token) group by all),\n"
        f"d{i} as (select side.review_id, side.sentiment, side.split, cast(r.i + {i * dim} as integer) as component, "
        f"coalesce(total::double / (len(toks)::double * 1073741824::double), 0::double) as value from side "
        f"join t{i} using (review_id) cross join unnest(range({dim})) r(i) left join s{i} on s{i}.review_id = side.review_id and s{i}.i = r.i)"
        for i, c in enumerate(columns)
    )
    return (
        _with(REVIEWS)
        + f", lab as (select *, case when rating > 5 then 1 else 0 end as sentiment from reviews where {present}),\n"
        + f"side as (select *, case when {_bucket('review_id', '123', 100)} < 80 then 'train' else 'test' end as split from lab),\n"
        + parts
        + "\n"
        + " union all ".join(f"select * from d{i}" for i in range(len(columns)))
    )


ORACLE["embed_hashed_both"] = _embed_hashed(["review_summary", "review_detail"])

_FOLDED = (
    _with(REVIEWS, SUMMARY_LABELLED, TRAIN)
    + f", f as (select sentiment, {_bucket('review_id', '123:fold', 10)} as fold from train),\n"
)
# L1 so strong that every weight is zero: all scores tie in every fold
ORACLE["tune_lr_closed"] = (
    "select 'summary' as feature_set, 'logistic_regression' as model, 'elasticNetParam=1.0, regParam=10.0' as params, "
    "'areaUnderROC' as metric, 0.5::double as avg, 0.0::double as std"
)
# trees without a split predict the majority of the other folds
ORACLE["tune_rf_closed"] = (
    _FOLDED
    + "folds as (select distinct fold from f),\n"
    "major as (select folds.fold, case when sum(sentiment) * 2 > count(*) then 1 else 0 end as guess "
    "from folds join f on f.fold <> folds.fold group by folds.fold),\n"
    "share as (select f.fold, avg(case when sentiment = guess then 1.0::double else 0.0::double end) as acc "
    "from f join major on f.fold = major.fold group by f.fold)\n"
    "select 'summary' as feature_set, 'random_forest' as model, 'maxDepth=0, numTrees=10' as params, "
    "'accuracy' as metric, round(avg(acc), 9) as avg, round(stddev_pop(acc), 9) as std from share"
)
ORACLE["compare_shape"] = (
    "select feature_set, model, metric, true as in_bounds from (values ('summary'), ('detail'), ('both')) s(feature_set) "
    "cross join (values ('logistic_regression'), ('linear_svc'), ('random_forest'), ('perceptron')) m(model) "
    "cross join (values ('areaUnderROC'), ('accuracy'), ('f1')) t(metric)"
)
