"""One query for each operator over its whole table, with the SQL it must equal where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.llm.alignment import align
from skyfold.llm.backoff import backoff_scores
from skyfold.llm.common import Scratch, table
from skyfold.llm.decomposition import pack_by_length
from skyfold.llm.license_scan import scan_licenses
from skyfold.llm.minhash import QUERY_SHINGLE_WORDS, near_duplicates
from skyfold.llm.mixing import mixed_places
from skyfold.llm.nn_descent import nearest
from skyfold.llm.packing import pack
from skyfold.llm.quality_rules import judged, learn_rules, with_statistics
from skyfold.llm.resampling import resample
from skyfold.llm.suffix_dedup import repeated_bytes
from skyfold.llm.token_files import token_digest
from skyfold.llm.url_filters import BLOCKED_WORDS, filter_urls


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), Scratch(spark, "op1"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_places(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "op3")
    statistics = scratch.keep(with_statistics(table(spark, sf_dir, "documents")), "statistics")
    return judged(statistics, learn_rules(statistics, table(spark, sf_dir, "labels"), scratch))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes(table(spark, sf_dir, "documents"), Scratch(spark, "op5"))


def op6_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, Scratch(spark, "op6"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return token_digest(table(spark, sf_dir, "documents"), Scratch(spark, "op7"), vocabulary)


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), Scratch(spark, "op8"), QUERY_SHINGLE_WORDS)


def op9_backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = backoff_scores(table(spark, sf_dir, "documents"), Scratch(spark, "op9"))
    return scores.select("doc_id", "n_words", *[F.round(c, 4).alias(c) for c in ("log_score", "mean_log_score")])


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Scratch(spark, "op11"))


def op12_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    sequences = pack_by_length(table(spark, sf_dir, "documents"), Scratch(spark, "op12"), vocabulary)
    return sequences.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return align(table(spark, sf_dir, "documents"), Scratch(spark, "op13"), *paths)


_OP4_SQL = r"""
with parsed as (
    select page_id,
           translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz') as host,
           regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) as path
    from pages
), ruled as (
    select *, case
        when (host = 'example.org' or host like '%.example.org') and starts_with(path, '/es/') then 'example.org/es/'
        when (host = 'example.org' or host like '%.example.org') and starts_with(path, '/en/1') then 'example.org/en/1'
        when (host = 'com' or host like '%.com') and starts_with(path, '/fr/') then 'com/fr/'
        when (host = 'com' or host like '%.com') and starts_with(path, '/de/') then 'com/de/'
        when (host = 'org' or host like '%.org') and starts_with(path, '/') then 'org/'
    end as rule,
    list_sort(list_filter(regexp_split_to_array(host, '[^a-z0-9]+'), lambda x: x in ({words}))) as words
    from parsed
)
select page_id, host, path, rule,
       case when rule in ('org/', 'com/fr/') then 'allow' when rule is not null or len(words) > 0 then 'block'
            else 'allow' end as verdict,
       case when rule is null and len(words) > 0
            then list_sort(list_transform(words, lambda w: struct_pack(n := -len(w), w := w)))[1].w end as pattern
from ruled
""".format(words=", ".join(f"'{w}'" for w in BLOCKED_WORDS))

QUERIES = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_mix_sources,
        op3_quality_rules,
        op4_url_filters,
        op5_suffix_dedup,
        op6_nn_descent,
        op7_token_files,
        op8_minhash_dedup,
        op9_backoff_scores,
        op10_license_scan,
        op11_importance_resampling,
        op12_power_of_two_packing,
        op13_tokenizer_alignment,
    )
}
_OP5_SQL = """
with bytes as (
    select doc_id, encode(coalesce(text, '')) as b from documents
), windows as (
    select doc_id, i, b[i : i + 49] as w
    from (select doc_id, b, unnest(range(1, octet_length(b) - 48)) as i from bytes)
), firsts as (
    select w, min(doc_id) as least from windows group by w
), hits as (
    select doc_id, i from windows join firsts using (w) where doc_id > least
), covered as (
    select distinct doc_id, i + unnest(range(0, 50)) as p from hits
), runs as (
    select doc_id, min(p) as a, max(p) as z
    from (select doc_id, p, p - row_number() over (partition by doc_id order by p) as g from covered)
    group by doc_id, g
), gaps as (
    select doc_id, coalesce(lag(z) over (partition by doc_id order by a), 0) + 1 as a, a - 1 as z, a as at_ from runs
    union all
    select doc_id, max(z) + 1, null, null from runs group by doc_id
), kept as (
    select g.doc_id, string_agg(hex(b[g.a : coalesce(g.z, octet_length(b))]), '' order by g.a) as h
    from gaps g join bytes using (doc_id) group by g.doc_id
), sums as (
    select doc_id, sum(z - a + 1) as n_removed, count(*) as n_spans from runs group by doc_id
)
select doc_id, cast(octet_length(b) as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed,
       cast(coalesce(n_spans, 0) as bigint) as n_spans,
       sha256(case when h is null then b else unhex(h) end) as kept_sha256
from bytes left join sums using (doc_id) left join kept using (doc_id)
"""

_OP8_SQL = r"""
with recursive words as (
    select doc_id, list_filter(
        regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[\x20\x09-\x0D]+'), lambda w: w != '') as w
    from documents
), shingled as (
    select doc_id, list_distinct(case when len(w) < 2 then w
        else list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) end) as s
    from words
), sized as (
    select doc_id, len(s) as n, s from shingled
), exploded as (
    select doc_id, n, unnest(s) as shingle from sized
), pairs as (
    select a.doc_id as a, b.doc_id as b, a.n as n, b.n as m, count(*) as both_
    from exploded a join exploded b on a.shingle = b.shingle and a.doc_id < b.doc_id
         and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    group by all
), links as (
    select a, b from pairs where 100 * both_ >= 80 * (n + m - both_)
    union
    select b, a from pairs where 100 * both_ >= 80 * (n + m - both_)
), reach as (
    select doc_id as id, doc_id as seen from sized
    union
    select reach.id, links.b from reach join links on reach.seen = links.a
), least_seen as (
    select id, min(seen) as component_id from reach group by id
)
select doc_id, cast(n as bigint) as n_shingles, component_id, doc_id = component_id as kept
from sized join least_seen on id = doc_id
"""

_OP9_SQL = r"""
with split as (
    select doc_id, list_filter(
        regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[\x20\x09-\x0D]+'), lambda w: w != '') as w
    from documents
), words as (
    select doc_id, i, w[i] as w3, case when i > 1 then w[i - 1] end as w2, case when i > 2 then w[i - 2] end as w1
    from (select doc_id, w, unnest(range(1, len(w) + 1)) as i from split)
), size as (
    select count(*) as n from words
), c1 as (
    select w3, count(*) as c from words group by all
), c2 as (
    select w2, w3, count(*) as c from words where i > 1 group by all
), c3 as (
    select w1, w2, w3, count(*) as c from words where i > 2 group by all
), o1 as (
    select doc_id, w3, count(*) as o from words group by all
), o2 as (
    select doc_id, w2, w3, count(*) as o from words where i > 1 group by all
), o3 as (
    select doc_id, w1, w2, w3, count(*) as o from words where i > 2 group by all
), others as (
    select t.doc_id, t.i, len(s.w) as own, c1.c - o1.o as a3, p1.c - q1.o as a2, c2.c - o2.o as a23, p2.c - q2.o as a12,
           c3.c - o3.o as a123
    from words t
    join split s on t.doc_id = s.doc_id
    join c1 on c1.w3 = t.w3
    join o1 on o1.doc_id = t.doc_id and o1.w3 = t.w3
    left join c1 p1 on p1.w3 = t.w2
    left join o1 q1 on q1.doc_id = t.doc_id and q1.w3 = t.w2
    left join c2 on c2.w2 = t.w2 and c2.w3 = t.w3
    left join o2 on o2.doc_id = t.doc_id and o2.w2 = t.w2 and o2.w3 = t.w3
    left join c2 p2 on p2.w2 = t.w1 and p2.w3 = t.w2
    left join o2 q2 on q2.doc_id = t.doc_id and q2.w2 = t.w1 and q2.w3 = t.w2
    left join c3 on c3.w1 = t.w1 and c3.w2 = t.w2 and c3.w3 = t.w3
    left join o3 on o3.doc_id = t.doc_id and o3.w1 = t.w1 and o3.w2 = t.w2 and o3.w3 = t.w3
), scored as (
    select doc_id, i, ln(case
        when i > 2 and a123 > 0 then a123::double / a12
        when i > 1 and a23 > 0 then (case when i > 2 then 0.4 else 1.0 end)::double * a23 / a2
        else (case when i > 2 then 0.16 when i > 1 then 0.4 else 1.0 end)::double * greatest(a3, 0.5::double) / greatest(n - own, 1)
    end) as s
    from others, size
), sums as (
    select doc_id, sum(s) as s from scored group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words, round(coalesce(s, 0), 4) as log_score, round(s / nullif(len(w), 0), 4) as mean_log_score
from split left join sums using (doc_id)
"""

_OP11_SQL = r"""
with crc as (
    select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, x:
        case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as steps
), split as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from documents
), target as (
    select unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as word
    from benchmark
), words as (
    select doc_id, unnest(w) as word from split
), bytes as (
    select word, hex(encode(word)) as h from (select word from words union select word from target)
), hashed as (
    select word, xor(list_reduce(
        list_prepend(4294967295, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::bigint)),
        lambda c, b: xor(steps[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 10000 as bucket
    from bytes, crc
), corpus as (
    select bucket, count(*) as n from words join hashed using (word) group by bucket
), wanted as (
    select bucket, count(*) as n from target join hashed using (word) group by bucket
), sizes as (
    select (select count(*) from words) as s, (select count(*) from target) as t
), gains as (
    select bucket, cast(floor(1000 * ln(((coalesce(wanted.n, 0) + 1) * (s + 10000))::double / ((corpus.n + 1) * (t + 10000)))) as bigint) as gain
    from corpus left join wanted using (bucket), sizes
), weights as (
    select doc_id, sum(gain) as total from words join hashed using (word) join gains using (bucket) group by doc_id
), scored as (
    select split.doc_id, cast(len(w) as bigint) as n_features,
           cast(floor(coalesce(total, 0)::double / greatest(len(w), 1)) as bigint) as weight,
           ('0x' || left(sha256('2024:' || split.doc_id), 8))::bigint as h
    from split left join weights on split.doc_id = weights.doc_id
), noisy as (
    select doc_id, n_features, weight, cast(weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296))) as bigint) as score
    from scored
), ranked as (
    select doc_id, row_number() over (order by score desc, doc_id) as rank, 10 * count(*) over () // 100 as drawn
    from noisy where n_features >= 20
)
select noisy.doc_id, n_features, weight, score, rank
from noisy left join (select * from ranked where rank <= drawn) as r on noisy.doc_id = r.doc_id
"""

ORACLES = {
    "op4_url_filters": _OP4_SQL,
    "op5_suffix_dedup": _OP5_SQL,
    "op8_minhash_dedup": _OP8_SQL,
    "op9_backoff_scores": _OP9_SQL,
    "op11_importance_resampling": _OP11_SQL,
}
