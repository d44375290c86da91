"""The registered queries of the training-data operators, over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm import ann, bestfit, bpe, collocations, hard_negatives, licenses, line_dedup, lm_score, packing, sharding, simhash, spotsigs, toxicity
from parcelflow.llm.common import table

WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER))


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.where("vec_id % 50 = 0"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op6_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.fingerprints(table(spark, sf_dir, "documents"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("matches")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(table(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_TOKENIZER)
                          ).withColumnRenamed("id", "doc_id")


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", moved), "vec_id % 100 = 0")


def op13_bestfit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_ann": op2_ann,
    "op3_simhash": op3_simhash,
    "op4_sharding": op4_sharding,
    "op5_toxicity": op5_toxicity,
    "op6_spotsigs": op6_spotsigs,
    "op7_licenses": op7_licenses,
    "op8_line_dedup": op8_line_dedup,
    "op9_bpe": op9_bpe,
    "op10_lm_score": op10_lm_score,
    "op11_collocations": op11_collocations,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_bestfit": op13_bestfit,
}
# Words, pairs and triples counted as text; a triple or pair that occurs once backs off to a shorter one.
LM_SQL = """
with docs as (
  select doc_id, row_number() over () as row_no,
         list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as words
  from documents),
tokens as (select doc_id, row_no, unnest(words) as w, generate_subscripts(words, 1) as i from docs),
places as (select *, lag(w) over o as b1, lag(w, 2) over o as b2 from tokens window o as (partition by row_no order by i)),
singles as (select w, count(*) as n from tokens group by w),
doubles as (select b1, w, count(*) as n from places where b1 is not null group by all having count(*) >= 2),
triples as (select b2, b1, w, count(*) as n from places where b2 is not null group by all having count(*) >= 2),
everything as (select count(*) as n from tokens),
scored as (
  select p.row_no, case when p.i > 2 then t.n is null when p.i = 2 then d.n is null else false end as backed_off,
         case when t.n is not null then ln(t.n / dc.n)
              when d.n is not null then ln(d.n / c.n) + case when p.i > 2 then ln(0.4) else 0 end
              else ln(s.n / e.n) + least(p.i - 1, 2) * ln(0.4) end as lg
  from places p cross join everything e join singles s on p.w = s.w
  left join triples t on p.b2 = t.b2 and p.b1 = t.b1 and p.w = t.w
  left join doubles d on p.b1 = d.b1 and p.w = d.w
  left join doubles dc on p.b2 = dc.b1 and p.b1 = dc.w
  left join singles c on p.b1 = c.w),
sums as (select row_no, count(*) as n, count(*) filter (backed_off) as b, sum(lg) as lg from scored group by row_no)
select doc_id, coalesce(n, 0)::bigint as n_words, coalesce(b, 0)::bigint as n_backoff,
       round(coalesce(lg, 0), 4)::double as log_score, round(coalesce(lg / n, 0), 6)::double as mean_log_score
from docs left join sums using (row_no)
"""

# All phrases of all pieces, counted as text; containment is tested on the texts themselves.
COLLOCATION_SQL = """
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as piece from documents),
split as (select lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda w: w <> '') as words from pieces),
places as (select lang, words, unnest(generate_series(1, len(words))) as i from split),
phrases as (select lang, words, i, unnest(generate_series(1, least(5, len(words) - i + 1))) as k from places),
f as (select lang, k, array_to_string(words[i:i + k - 1], ' ') as phrase, count(*) as n from phrases group by all),
totals as (select lang, sum(n) as n from f where k = 1 group by lang),
often as (select * from f where n >= 100),
cuts as (
  select c.lang, c.phrase, c.n as a, l.n as l, r.n as r, t.n as n, l.k as cut,
         (1000::hugeint * c.n * t.n) // (l.n::hugeint * r.n) as score
  from often c join often l on l.lang = c.lang and l.k < c.k and starts_with(c.phrase, l.phrase || ' ')
  join often r on r.lang = c.lang and r.k = c.k - l.k and r.phrase = substr(c.phrase, len(l.phrase) + 2)
  join totals t on t.lang = c.lang where c.k >= 2),
best as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
kept as (
  select * from best b where not exists (
    select 1 from often d where d.lang = b.lang and len(d.phrase) > len(b.phrase)
    and contains(' ' || d.phrase || ' ', ' ' || b.phrase || ' ') and 100 * d.n >= 100 * b.a)),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n,
       score::bigint as score
from ranked where rank <= 2000
"""

# Every anchor against every row, in whole numbers.
HARD_NEGATIVE_SQL = """
with ok as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings where label is not null and embedding is not null and len(embedding) > 0 and list_bool_and(
    list_transform(embedding, lambda x: coalesce(isfinite(x), false)))),
scores as (
  select a.vec_id as anchor_id, a.label as anchor_label, b.vec_id, b.label, list_dot_product(a.v, b.v)::bigint as score
  from ok a join ok b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scores where label = anchor_label
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, p.positive_id, row_number() over (partition by p.anchor_id, p.positive_id
         order by s.score desc, s.vec_id)::int as rank, s.vec_id as negative_id, p.positive_score, s.score as negative_score
from positives p join scores s on s.anchor_id = p.anchor_id and s.label <> s.anchor_label
where 30 * p.positive_score <= 100 * s.score and 100 * s.score <= 90 * p.positive_score
qualify rank <= 10
"""

ORACLE_SQL: dict[str, str] = {
    "op10_lm_score": LM_SQL, "op11_collocations": COLLOCATION_SQL, "op12_hard_negatives": HARD_NEGATIVE_SQL}
