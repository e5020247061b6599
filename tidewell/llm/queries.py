"""Queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, langid, ngram_join, pii, quality_fm, quality_rules, secrets, sentencepiece_viterbi, token_io, url_filter
from .common import fold, read


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = url_filter.fit(url_filter.seeds(spark))
    return url_filter.judge(spark, read(spark, sf_dir, "pages"), weights)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_viterbi.digest(spark, read(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def quality_machine(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality_fm.Machine:
    labels = read(spark, sf_dir, "labels").where(fold(F.col("doc_id"), 5) != 0).select("doc_id", F.col("quality").cast("int").alias("label"))
    return quality_fm.train(docs, labels)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    scored = quality_fm.score(spark, docs, quality_machine(spark, docs, sf_dir))
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(spark, read(spark, sf_dir, "documents"), k=3, num=9, den=10)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs.where(fold(F.col("doc_id"), 3) != 1))
    found = langid.identify(spark, docs, model)
    return found.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judge(docs, quality_rules.fit(docs, quality_rules.trusted(read(spark, sf_dir, "labels"))))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_pii(read(spark, sf_dir, "documents")))


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(spark, read(spark, sf_dir, "documents"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(spark, read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    manifest = token_io.write_tokens(spark, docs, token_io.token_folder(spark), tokenizer("word_bpe_49k.json"))
    return token_io.read_digests(manifest)


def queries() -> dict:
    return {f.__name__: f for f in (op1_url_filters, op2_sentencepiece, op3_quality_classifier, op4_ngram_jaccard_join, op5_language_id, op6_quality_rules, op7_pii, op8_secret_scans, op9_benchmark_decontamination, op10_token_output)}


def oracle_sql() -> dict[str, str]:
    return {"op4_ngram_jaccard_join": OP4, "op9_benchmark_decontamination": OP9}


OP4 = r"""
with recursive w as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents),
s as (select distinct doc_id, unnest(case when len(ws) = 0 then []::varchar[] when len(ws) < 3 then [array_to_string(ws, ' ')]
        else list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) end) as g from w),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
e as (select x, y from p join n nx on nx.doc_id = x join n ny on ny.doc_id = y where 100 * c >= 90 * (nx.n + ny.n - c)),
l as (select x, y from e union all select y, x from e),
r as (select doc_id as a, doc_id as b from w union select r.a, l.y from r join l on l.x = r.b)
select w.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, m.component_id
from w left join n using (doc_id) join (select a as doc_id, min(b) as component_id from r group by a) m using (doc_id)
"""

OP9 = r"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark),
i as (select item_id, least(len(ws), 10) as k, unnest(list_transform(range(1, greatest(len(ws) - 9, 1) + 1), lambda i: array_to_string(ws[i:i + 9], ' '))) as g from b where len(ws) > 0),
k as (select distinct k from i),
t as (select doc_id, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: {'p': i, 'g': array_to_string(ws[i:i + k - 1], ' ')})) as x from d, k where len(ws) >= k),
o as (select t.doc_id, t.k, t.x.p as p, i.item_id from t join i on i.k = t.k and i.g = t.x.g),
h as (select doc_id, count(distinct q) as n_hit from (select doc_id, unnest(range(p, p + k)) as q from o) group by doc_id),
q as (select g, o, t, coalesce(n, 0) as n, row_number() over (partition by g order by coalesce(n, 0), o) as r
    from (select g, unnest(string_split(g, ' ')) as t, generate_subscripts(string_split(g, ' '), 1) as o from (select distinct g from i)) left join (select t, count(*) as n from (select unnest(ws) as t from d) group by t) using (t)),
z as (select doc_id, unnest(ws) as t, generate_subscripts(ws, 1) as p from d),
l as (select x.doc_id, count(distinct a.g) as n_near from q a join q b using (g) join z x on x.t = a.t join z y on y.t = b.t and y.doc_id = x.doc_id and abs((x.p - a.o) - (y.p - b.o)) <= 5 where a.r = 1 and b.r = 2 and a.n > 0 group by 1),
m as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, cast(item_id as varchar) as item from o) group by doc_id)
select d.doc_id, cast(len(d.ws) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
    sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated, cast(coalesce(n_near, 0) as bigint) as n_near
from d left join h using (doc_id) left join m using (doc_id) left join l using (doc_id)
"""
