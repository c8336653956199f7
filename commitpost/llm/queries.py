"""The registered queries of this subpackage, production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from workload.ship import ship

from . import bpe, decontaminate, language, lm, near_dup, phrases, pii, quality, rules, substring, topk, urls, whitening

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(run: Query) -> Query:
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return run(spark, sf_dir)

        QUERIES[run.__name__] = shipped
        if sql:
            ORACLE[run.__name__] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(modulus: int):
    """crc32 of the id as text, modulo ``modulus``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


OP2 = """
with doc_words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') w from documents),
item_words as (
    select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') w from benchmark),
windows as (
    select distinct item_id, least(len(w), 10) n, array_to_string(w[s : s + least(len(w), 10) - 1], ' ') t
    from (select *, unnest(range(1, len(w) - least(len(w), 10) + 2)) s from item_words where len(w) > 0)),
lengths as (select distinct n from windows),
places as (select doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') t
    from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) s from doc_words, lengths)),
hits as (select doc_id, item_id, p.n, s from places p join windows i on i.n = p.n and i.t = p.t),
words_hit as (select doc_id, count(distinct k) n_hit from (select doc_id, unnest(range(s, s + n)) k from hits) group by 1),
items_hit as (select doc_id, count(*) n_items, string_agg(i, ',' order by i) ids
    from (select distinct doc_id, item_id::varchar i from hits) group by 1)
select d.doc_id, len(w) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
    sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from doc_words d left join words_hit using (doc_id) left join items_hit using (doc_id)
"""


@query(OP2)
def op2_decontamination(spark, sf_dir):
    return decontaminate.digest(
        decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    )


@query()
def op3_bpe(spark, sf_dir):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query()
def op4_near_dup(spark, sf_dir):
    return near_dup.classes(table(spark, sf_dir, "documents"))


OP5 = """
with doc_words as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') w from documents),
windows as (
    select doc_id, s, sha256(array_to_string(w[s : s + 49], ' ')) h
    from (select doc_id, w, unnest(range(1, len(w) - 48)) s from doc_words where len(w) >= 50)),
lost as (select doc_id, s from (select doc_id, s, min(doc_id) over (partition by h) low from windows) where low < doc_id),
gone as (select doc_id, list(distinct k) ks from (select doc_id, unnest(range(s, s + 50)) k from lost) group by 1),
left_over as (
    select doc_id, w, coalesce(len(ks), 0) n_removed,
        case when ks is null then w else list_filter(w, lambda x, i: not list_contains(ks, i)) end kept
    from doc_words left join gone using (doc_id))
select doc_id, len(w) n_words, n_removed, sha256(array_to_string(kept, ' ')) kept_sha256 from left_over
"""


@query(OP5)
def op5_substring(spark, sf_dir):
    return substring.dedup(table(spark, sf_dir, "documents"))


@query()
def op6_language(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    found = language.identify(documents, remainder(4) != 2)
    return found.select("doc_id", (F.coalesce(remainder(4) == 2, F.lit(False))).alias("held_out"), "lang_pred", "score")


@query()
def op7_rules(spark, sf_dir):
    return rules.digest(rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


OP8 = """
with cut as (
    select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end rest from pages),
parts as (
    select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) path from cut),
rules(verdict, rule_host, rule_path) as (values
    ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
    ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fitting as (
    select page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) as rule,
        arg_max(verdict, length(rule_host || rule_path)) verdict
    from parts, rules
    where (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path) group by 1)
select page_id, host, path, rule, coalesce(verdict, 'allow') verdict from parts left join fitting using (page_id)
"""


@query(OP8)
def op8_urls(spark, sf_dir):
    return urls.judge(table(spark, sf_dir, "pages"), urls.given_rules(spark))


@query()
def op10_pii(spark, sf_dir):
    return pii.report(table(spark, sf_dir, "documents"))


@query()
def op9_lm(spark, sf_dir):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    scored = lm.score(table(spark, sf_dir, "documents"), remainder(5) != 1, path, public_tokenizers.PATTERN)
    return scored.withColumn("held_out", F.coalesce(remainder(5) == 1, F.lit(False)))


PREDICTED_FROM = 0.3


@query()
def op1_quality(spark, sf_dir):
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality.score(documents, labels, remainder(5) != 0)
    held_out = F.coalesce(remainder(5) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= PREDICTED_FROM).cast("int").alias("predicted"))


@query()
def op11_whitening(spark, sf_dir):
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


OP12 = """
with usable as (
    select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) w from embeddings
    where embedding is not null and vec_id is not null
        and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
scored as (
    select q.vec_id query_id, c.vec_id, list_inner_product(q.w, c.w)::bigint score
    from usable q join usable c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0)
select query_id, r::int as "rank", vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) r from scored) where r <= 5
"""


@query(OP12)
def op12_topk(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP13 = """
with pieces as (
    select coalesce(lang, 'und') lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) piece
    from documents),
words as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') w from pieces),
places as (select lang, w, unnest(range(1, len(w) + 1)) i from words where len(w) > 0),
grams as materialized (
    select lang, k, array_to_string(w[i : i + k - 1], ' ') phrase, count(*) f
    from (select *, unnest([1, 2, 3]) k from places) where i + k - 1 <= len(w) group by all),
totals as (select lang, sum(f)::bigint n from grams where k = 1 group by 1),
candidates as materialized (select lang, k, phrase, f a, string_split(phrase, ' ') w from grams where k > 1 and f >= 10),
halves as materialized (
    select lang, k, phrase, a, w, j, array_to_string(w[1 : j], ' ') p, array_to_string(w[j + 1 :], ' ') q
    from (select *, unnest(range(1, k)) j from candidates)),
cuts as (
    select h.*, x.f l, y.f r, (1000000::hugeint * a * a) // (x.f::hugeint * y.f) s
    from halves h join grams x on x.lang = h.lang and x.phrase = h.p join grams y on y.lang = h.lang and y.phrase = h.q),
chosen as (select * from (select *, row_number() over (partition by lang, phrase order by s, j) o from cuts) where o = 1),
longer as (
    select lang, part, max(a) longest from (
        select lang, a, unnest([array_to_string(w[1 : 2], ' '), array_to_string(w[2 : 3], ' ')]) part from candidates where k = 3) group by all),
kept as (
    select c.* from chosen c left join longer x on x.lang = c.lang and x.part = c.phrase
    where x.longest is null or 100 * x.longest < 50 * a),
ranked as (select *, row_number() over (partition by lang order by s desc, a desc, phrase) place from kept)
select lang, place as "rank", phrase, a, l, r, n, s::bigint score from ranked join totals using (lang) where place <= 2000
"""


@query(OP13)
def op13_phrases(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))
