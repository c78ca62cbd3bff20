"""Registered queries of the subpackage and their SQL; each applies its operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.llm.decontaminate import contamination
from candela.llm.extract import main_texts
from candela.llm.language import languages
from candela.llm.minhash import compare_with_next
from candela.llm.ngram_join import similar_documents
from candela.llm.packing import pack
from candela.llm.pivots import cluster_vectors
from candela.llm.private import personal_data
from candela.llm.quality import quality
from candela.llm.spelling import spelling_variants
from candela.llm.substrings import remove_repeats
from candela.llm.toxicity import toxicity
from candela.llm.url_rules import judge

URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return main_texts(table(spark, folder, "pages"))


def op2_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return similar_documents(table(spark, folder, "documents"))


def op3_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return compare_with_next(table(spark, folder, "documents"))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), tokenizer_path())


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    return languages(table(spark, folder, "documents"))


def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judge(table(spark, folder, "pages"), URL_RULES)


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    digest = F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, (F.col("n_hit") > 0).alias("contaminated"))


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents")).drop("kept")


def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(table(spark, folder, "documents"))


def op12_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return cluster_vectors(table(spark, folder, "embeddings"))


def op13_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data(table(spark, folder, "documents"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_html_extraction, op2_ngram_join, op3_minhash, op4_toxicity, op5_quality, op6_packing, op7_language,
        op8_url_filter, op9_decontamination, op10_substring_dedup, op11_spelling, op12_clusters, op13_personal_data, pipeline,
    )
}

def _clusters_sql(k: int = 8, rounds: int = 10, components: int = 64) -> str:
    """k-means in plain SQL, one pair of tables a round; every distance is computed."""
    apart = "list_sum(list_transform(v.v, lambda x, i: (x - c.c[i]) * (x - c.c[i])))"
    nearest = f"select id, vec_id, v, arg_min(number, (d, number)) as number, min(d) as d from (select v.*, c.number, {apart} as d from v, {{}} c) group by all"
    sql = [
        f"""raw as (select row_number() over () as id, vec_id, embedding from embeddings
  where len(embedding) = {components} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)""",
        "v as materialized (select id, vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v from raw)",
        f"""c0 as materialized (select row_number() over (order by h, v) - 1 as number, v as c
  from (select sha256('3:' || vec_id) as h, v from v order by h, v limit {k}))""",
    ]
    for r in range(rounds + 1):
        sql.append(f"a{r} as materialized ({nearest.format(f'c{r}')})")
        if r < rounds:
            sql.append(f"""m{r} as (select number, i, sum(x) as s, count(*) as n
  from (select number, unnest(v) as x, unnest(range(1, {components + 1})) as i from a{r}) group by all)""")
            sql.append(f"""c{r + 1} as materialized (select number, coalesce(m.c, c{r}.c) as c from c{r} left join
  (select number, list(cast((s - ((s % n) + n) % n) // n as bigint) order by i) as c from m{r} group by number) m using (number))""")
    return (
        "with " + ",\n".join(sql) + f"""
select vec_id, cast(number as integer) as cluster, cast(d as bigint) as distance, cast(sum(d) over (partition by number) as bigint) as cluster_inertia,
  cast(sum(d) over () as bigint) as inertia, sha256(array_to_string(c, ',')) as centroid_sha256 from a{rounds} join c{rounds} using (number)"""
    )


_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLES: dict[str, str] = {
    "op2_ngram_join": rf"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x20\x09-\x0D]+') as w from documents),
shingles as (
  select distinct doc_id, array_to_string(w[i : i + 4], ' ') as s
  from (select doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) as i from words where len(w) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as n from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all),
links as (
  select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * shared.n >= 75 * (x.n + y.n - shared.n)),
both_ways as (select a, b from links union all select b, a from links),
reach(doc_id, c) as (
  select doc_id, doc_id from documents
  union
  select both_ways.b, reach.c from reach join both_ways on both_ways.a = reach.doc_id)
select d.doc_id, cast(coalesce(n, 0) as bigint) as n_shingles, r.c as component_id
from documents d left join sizes using (doc_id) join (select doc_id, min(c) as c from reach group by doc_id) r using (doc_id)""",
    "op9_decontamination": rf"""
with pattern as (select '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+' as p),
items as (select cast(item_id as varchar) as item, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), p) as w from benchmark, pattern),
tests as (
  select distinct item, k, array_to_string(w[i : i + k - 1], ' ') as g
  from (select item, w, least(10, len(w)) as k, unnest(range(1, len(w) - least(10, len(w)) + 2)) as i from items where len(w) > 0)),
sizes as (select distinct k from tests),
words as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), p) as w from documents, pattern),
hits as (
  select doc_id, i, d.k, item
  from (select doc_id, i, k, array_to_string(w[i : i + k - 1], ' ') as g
        from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i from words, sizes where len(w) >= k)) d
  join tests t on t.k = d.k and t.g = d.g),
covered as (select doc_id, count(distinct j) as n from (select doc_id, unnest(range(i, i + k)) as j from hits) group by doc_id),
found as (select doc_id, count(*) as n, string_agg(item, ',' order by item) as l from (select distinct doc_id, item from hits) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(covered.n, 0) as bigint) as n_hit,
  cast(coalesce(found.n, 0) as bigint) as n_items, sha256(coalesce(l, '')) as items_sha256, covered.n is not null as contaminated
from words left join covered using (doc_id) left join found using (doc_id)""",
    "op11_spelling": rf"""
with recursive table_of as (
  select list(list_reduce(range(8), lambda c, b: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i) order by i) as t
  from (select unnest(range(256)) as i)),
runs as (
  select doc_id, w, count(*) as n
  from (select doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')), {_AZ}) as w from documents) where len(w) >= 7 group by all),
bytes as (
  select w, n, list_transform(range(len(x) // 2), lambda i: cast('0x' || substr(x, 2 * i + 1, 2) as bigint)) as b
  from (select w, n, hex(encode(coalesce(cast(doc_id as varchar), 'null') || ':' || w)) as x from runs)),
sums as (
  select w, n, xor(4294967295, list_reduce(b, lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1]), 4294967295::bigint)) as h from bytes, table_of),
words as materialized (
  select w, cast(sum(n) as bigint) as n
  from (select n, case when h % 31 = 0 then w[1 : cast(h % len(w) as bigint)] || w[cast(h % len(w) as bigint) + 2 :] else w end as w from sums)
  where len(w) >= 7 group by w having sum(n) >= 2),
less as (select w, n, i, w[1 : i - 1] || '_' || w[i + 1 :] as slot, w[1 : i - 1] || w[i + 1 :] as short from (select w, n, unnest(range(1, len(w) + 1)) as i from words)),
pairs as (
  select a.w as a, b.w as b from less a join less b on a.slot = b.slot and a.w <> b.w
  union select less.w, words.w from less join words on less.short = words.w
  union select words.w, less.w from less join words on less.short = words.w),
near as (
  select p.a as w, count(*) as n_near, arg_min(x.w, (-x.n, x.w)) as best, max(x.n) as best_n
  from pairs p join words x on x.w = p.b group by p.a),
forms as materialized (
  select words.w, words.n, coalesce(n_near, 0) as n_near, case when best_n >= 10 * words.n then best end as form, case when best_n >= 10 * words.n then best_n end as form_n
  from words left join near on near.w = words.w),
chain(w, tip, step) as (
  select w, w, 0 from forms
  union all select chain.w, forms.form, step + 1 from chain join forms on forms.w = chain.tip where forms.form is not null)
select w as word, form, root, n, n_near, form_n from forms join (select w, arg_max(tip, step) as root from chain group by w) using (w)""",
    "op12_clusters": _clusters_sql(),
    "op10_substring_dedup": r"""
with words as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
windows as (
  select doc_id, i, array_to_string(w[i : i + 19], ' ') as g
  from (select doc_id, w, unnest(range(1, len(w) - 18)) as i from words where len(w) >= 20)),
later as (select doc_id, i from windows qualify row_number() over (partition by g order by doc_id, i) > 1),
gone as (select distinct doc_id, unnest(range(i, i + 20)) as j from later),
kept as (
  select u.doc_id, string_agg(u.x, ' ' order by u.j) as t
  from (select doc_id, unnest(w) as x, unnest(range(1, len(w) + 1)) as j from words) u
  left join gone on gone.doc_id = u.doc_id and gone.j = u.j where gone.j is null group by u.doc_id),
counts as (select doc_id, count(*) as n from gone group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n, 0) as bigint) as n_removed, sha256(coalesce(t, '')) as kept_sha256
from words left join counts using (doc_id) left join kept using (doc_id)""",
}
