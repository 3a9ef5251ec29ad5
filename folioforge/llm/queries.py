"""The registered queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.session import ship
from folioforge.llm import decontaminate, hard_negatives, mixing, packing, pii, quality_rules, resampling, secrets, simhash, suffix_dedup, token_counts, url_filter, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).drop("source")


def op2_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(_table(spark, sf_dir, "documents"))
    text = secrets.joined_spans(F.col("spans"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(text, 256).alias("base_sha256"), text.alias("spans"))


def op3_skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(_table(spark, sf_dir, "documents"))


def op4_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.resolve_revisits(warc.records_of_pages(_table(spark, sf_dir, "pages")))
    header = lambda e: F.concat_ws("=", e["key"], e["value"])
    headers = F.array_join(F.array_sort(F.transform(F.map_entries("headers"), header)), "\n")
    return found.select(
        F.col("record_id").alias("page_id"), "canonical", F.col("at").alias("revisit_time"), "response_id", "verdict", "digest", headers.alias("headers")
    )


def op5_simhash_covering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.withColumn("items", F.array_join(F.transform("items", lambda i: i.cast("string")), ","))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.fit(url_filter.labelled_urls(spark))
    return url_filter.filter_urls(_table(spark, sf_dir, "pages"), model).drop("score")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_substrings(_table(spark, sf_dir, "documents"))


def op10_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    rules = quality_rules.fit(docs, _table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, rules)


def op11_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op12_postings_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_voronoi_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = hard_negatives.shifted_label(F.col("vec_id"), F.col("label"))
    return hard_negatives.hard_negatives(_table(spark, sf_dir, "embeddings"), label=label)


QUERIES = {
    f.__name__: f
    for f in (
        op1_mix_sources, op2_secret_ledger, op3_skip_chain_pii, op4_warc_revisits, op5_simhash_covering, op6_decontaminate, op7_url_filter, op8_token_counts,
        op9_suffix_dedup, op10_decision_list, op11_vector_packing, op12_postings_resampling, op13_voronoi_negatives,
    )
}

_ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""

ORACLE_SQL: dict[str, str] = {
    "op2_secret_ledger": rf"""
        with rules(k, kind, p, g, least) as (values (0, 'assign', '{_ASSIGN}', 2, 6), (1, 'access', 'AKIA[A-Z0-9]+', 0, 20), (2, 'hex', '[0-9a-f]+', 0, 24)),
        texts as (select distinct coalesce(text, '') as text from documents),
        cut as (
            select text, 0 as k, string_split_regex(text, '{_ASSIGN}') as gaps, regexp_extract_all(text, '{_ASSIGN}', 0) as whole, regexp_extract_all(text, '{_ASSIGN}', 2) as part from texts
            union all select text, 1, string_split_regex(text, 'AKIA[A-Z0-9]+'), regexp_extract_all(text, 'AKIA[A-Z0-9]+'), regexp_extract_all(text, 'AKIA[A-Z0-9]+') from texts
            union all select text, 2, string_split_regex(text, '[0-9a-f]+'), regexp_extract_all(text, '[0-9a-f]+'), regexp_extract_all(text, '[0-9a-f]+') from texts
        ), each as (
            select text, k, n, length(gaps[n]) as gap, length(whole[n]) as size, length(part[n]) as part from cut, unnest(range(1, len(whole) + 1)) as u(n)
        ), placed as (
            select *, sum(gap + size) over (partition by text, k order by n) as e from each
        ), kept as (
            select text, k, kind, (e - size)::bigint as s, e::bigint as e from placed join rules using (k) where part >= least
        ), by_text as (
            select text, count_if(k = 0) as a, count_if(k = 1) as b, count_if(k = 2) as c, string_agg(kind || ':' || s || ':' || e, ',' order by s, k) as spans from kept group by text
        )
        select doc_id, coalesce(a, 0) as n_assign, coalesce(b, 0) as n_access, coalesce(c, 0) as n_hex, sha256(coalesce(spans, '')) as base_sha256, coalesce(spans, '') as spans
        from documents d left join by_text t on coalesce(d.text, '') = t.text
    """,
    "op9_suffix_dedup": """
        with docs as (select doc_id, encode(coalesce(text, '')) as b from documents),
        w as (select doc_id, p, hex(b)[2 * p + 1 : 2 * p + 200] as s from docs, unnest(range(0, octet_length(b) - 99)) as u(p)),
        r as (select doc_id, p, row_number() over (partition by s order by doc_id, p) as k from w),
        runs as (
            select doc_id, p, sum(new) over (partition by doc_id order by p) as g from (
                select doc_id, p, case when p - lag(p) over (partition by doc_id order by p) <= 100 then 0 else 1 end as new from r where k > 1)
        ), gone as (select doc_id, g, min(p) as s, max(p) + 100 as e from runs group by doc_id, g),
        keep as (
            select doc_id, coalesce(lag(e) over (partition by doc_id order by s), 0) as s, s as e from gone
            union all select doc_id, max(e), octet_length(any_value(b)) from gone join docs using (doc_id) group by doc_id
            union all select doc_id, 0, octet_length(b) from docs where doc_id not in (select doc_id from gone)
        ), kept as (select doc_id, string_agg(hex(b)[2 * s + 1 : 2 * e], '' order by s) as h from keep join docs using (doc_id) group by doc_id),
        sums as (select doc_id, sum(e - s) as n_removed, count(*) as n_spans from gone group by doc_id)
        select doc_id, octet_length(b)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans, sha256(unhex(h)) as kept_sha256
        from docs join kept using (doc_id) left join sums using (doc_id)
    """,
    "op4_warc_revisits": r"""
        with page as (
            select page_id, md5(coalesce(html, '')) as digest,
                regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)\??([^#]*)', 1) as h,
                regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)\??([^#]*)', 2) as p,
                '&' || regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)\??([^#]*)', 3) as q
            from pages
        ), clean as (
            select page_id, digest,
                regexp_replace(regexp_replace(lower(h), '^www\.', ''), ':(80|443)$', '') || regexp_replace(p, '/+$', '') as base,
                regexp_replace(regexp_replace(q, '&(utm_[a-z]+|ref|fbclid|gclid|sessionid)=[^&]*', '', 'g'), '^&', '') as query
            from page
        ), one as (
            select page_id, digest, base || case when query <> '' then '?' || query else '' end as canonical,
                page_id * 2 as stored_time, page_id * 2 + 1 + (page_id * 7919 % 1009) * 2 as back
            from clean
        ), met as (
            select r.page_id, r.canonical, r.back as revisit_time, r.digest as own, f.page_id as response_id, f.digest,
                row_number() over (partition by r.page_id order by f.stored_time desc, f.page_id desc) as k
            from one r left join one f on r.canonical = f.canonical and f.stored_time < r.back
        )
        select page_id, canonical, revisit_time, response_id,
            case when response_id is null then 'unresolved' when own = digest then 'resolved' else 'changed' end as verdict,
            case when own = digest then digest end as digest,
            case when own = digest then 'cache-control=max-age=600' || chr(10) || 'content-type=text/html' || chr(10) ||
                'date=' || revisit_time || chr(10) || 'etag=W/"' || own || '"' end as headers
        from met where k = 1
    """,
    "op12_postings_resampling": r"""
        with crc as (
            select list(c order by b) as table_ from (
                select b, list_reduce(range(8), lambda c, k: case when (c & 1) = 1 then xor(c >> 1, 3988292384) else c >> 1 end, b) as c from range(256) as r(b))
        ), texts as (
            select doc_id as id, text, true as ours from documents union all select null, text, false from benchmark
        ), numbered as (
            select row_number() over () as row, id, ours,
                regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
            from texts
        ), each as (
            select row, ours, unnest(words) as word from numbered
        ), hashed as (
            select word, xor(list_reduce(list_transform(range(octet_length(encode(word))), lambda i: ('0x' || hex(encode(word))[2 * i + 1 : 2 * i + 2])::bigint),
                lambda c, x: xor(c >> 8, table_[(xor(c, x) & 255) + 1]), 4294967295::bigint), 4294967295) % 10000 as bucket
            from (select distinct word from each), crc
        ), sums as (
            select bucket, count_if(ours) as s, count_if(not ours) as t from each join hashed using (word) group by bucket
        ), gain as (
            select bucket, floor(1000 * ln(((t + 1)::double * (sum(s) over () + 10000)::double) / ((s + 1)::double * (sum(t) over () + 10000)::double)))::bigint as gain from sums
        ), total as (
            select row, sum(gain)::bigint as g from each join hashed using (word) join gain using (bucket) where ours group by row
        ), scored as (
            select row, id, len(words)::bigint as n, case when len(words) = 0 then 0 else ((g - ((g % len(words)) + len(words)) % len(words)) // len(words)) end::bigint as weight,
                floor(-1000 * ln(-ln((('0x' || sha256('2024:' || id)[1 : 8])::bigint + 0.5) / 4294967296)))::bigint as noise
            from numbered left join total using (row) where ours
        ), placed as (
            select *, weight + noise as score, row_number() over (partition by n >= 20 order by weight + noise desc, id) as k, count_if(n >= 20) over () as able from scored
        )
        select id as doc_id, n as n_features, weight, score, case when n >= 20 and k <= 10 * able // 100 then k end as rank from placed
    """,
    "op13_voronoi_negatives": """
        with v as (
            select vec_id as id, (case when vec_id % 7 = 0 then (label + 1) % 10 else label end) as label, list_transform(embedding, lambda x: floor(256 * x::double)) as x
            from embeddings where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), met as (
            select a.id as a, b.id as b, a.label = b.label as same, list_inner_product(a.x, b.x)::bigint as score from v a join v b on a.id % 50 = 0 and a.id <> b.id
        ), pos as (
            select a, b, score, row_number() over (partition by a order by score desc, b) as k from met where same
        ), neg as (
            select p.a, p.b as positive_id, p.score as positive_score, n.b as negative_id, n.score as negative_score, row_number() over (partition by p.a, p.b order by n.score desc, n.b) as k
            from pos p join met n on p.a = n.a and not n.same and 50 * p.score <= 100 * n.score and 100 * n.score <= 95 * p.score where p.k <= 5
        )
        select a as anchor_id, positive_id, k::int as rank, negative_id, positive_score, negative_score from neg where k <= 3
    """,
}
