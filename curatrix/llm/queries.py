"""Queries of the numbered operators and of the pipeline, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table; one that is stored in fewer pieces than there are cores is dealt out to all of them."""
    docs, cores = _table(spark, sf_dir, "documents"), spark.sparkContext.defaultParallelism
    return docs if docs.rdd.getNumPartitions() >= cores else docs.repartition(cores)


def op1_pack_bfd(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from curatrix.llm.packing import pack_documents

    return pack_documents(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op2_quality_llr(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curatrix.llm.quality_rules import quality_rules

    judged = quality_rules(_documents(spark, sf_dir), _table(spark, sf_dir, "labels")).drop("text")
    return judged.withColumn("llr", F.round("llr", 6))


def op3_weak_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curatrix.llm.weak_label import classify

    return classify(_documents(spark, sf_dir)).drop("text")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curatrix.llm.line_dedup import dedup_lines

    kept = dedup_lines(_documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op5_chat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curatrix.llm.chat import format_turns, read_back, turns_as_log

    control = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(control)
    return read_back(format_turns(turns_as_log(rows)))


def op6_shard_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curatrix.llm.sharding import shard_documents

    return shard_documents(_documents(spark, sf_dir))


def op7_jaccard_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curatrix.llm.jaccard import jaccard_classes

    return jaccard_classes(_documents(spark, sf_dir))


def op8_piece_wfst(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from curatrix.llm.wfst import encode_documents

    docs = _documents(spark, sf_dir)
    coded = encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_ids"), F.crc32("ids").alias("ids_crc32"), "n_bytes", F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curatrix.llm.secrets import scan_secrets

    return scan_secrets(_documents(spark, sf_dir)).drop("text", "redacted")


def op10_pivot_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curatrix.llm.pivots import cosine_links

    return cosine_links(_table(spark, sf_dir, "embeddings"))


def op11_crc_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curatrix.llm.resampling import resample

    return resample(_documents(spark, sf_dir), _table(spark, sf_dir, "benchmark")).select("doc_id", "n_features", "weight", "score", "rank")


def op12_token_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curatrix.llm.url_rules import filter_urls

    return filter_urls(_table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def op13_one_bit_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curatrix.llm.hard_negatives import mine

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(_table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), "embedding"), "vec_id % 100 = 0")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return {k: v for k, v in globals().items() if (k.startswith("op") or k == "pipeline") and callable(v)}


_KEYS = r"""
l as (select doc_id, unnest(generate_series(1, len(string_split(coalesce(text, ''), chr(10))))) as i, string_split(coalesce(text, ''), chr(10)) as ls from documents),
k as (select doc_id, i, ls[i] as line, translate(regexp_replace(ls[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l)
"""

ORACLES = {
    "op7_jaccard_forest": r"""with recursive
w as (select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents),
s as (select distinct doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
  else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) end) as g from w),
n as (select doc_id, count(*) as n from s group by doc_id),
c as (select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
e as (select c.a, c.b from c join n x on c.a = x.doc_id join n y on c.b = y.doc_id where c.k >= 0.8 * (x.n + y.n - c.k)),
r as (select doc_id as a, doc_id as b from documents union select r.a, e.b from r join e on r.b = e.a)
select d.doc_id, min(r.b) as class_id, (select count(*) from e where e.a = d.doc_id) as n_links, d.doc_id = min(r.b) as kept
from documents d join r on r.a = d.doc_id group by d.doc_id""",
    "op10_pivot_neardup": r"""with recursive
v as (select vec_id, cast(embedding as double[]) as x from embeddings),
g as (select vec_id, x from v where x is not null and len(list_filter(x, lambda y: y is null or not isfinite(y))) = 0 and list_dot_product(x, x) > 0),
e as (select a.vec_id as a, b.vec_id as b from g a join g b on a.vec_id <> b.vec_id where list_cosine_similarity(a.x, b.x) >= 0.9),
r as (select vec_id as a, vec_id as b from embeddings union select r.a, e.b from r join e on r.b = e.a)
select d.vec_id, (select count(*) from e where e.a = d.vec_id) as n_links, min(r.b) as component_id, d.vec_id = min(r.b) as kept
from embeddings d join r on r.a = d.vec_id group by d.vec_id""",
    "op4_line_dedup": f"""with {_KEYS},
f as (select key, max(doc_id) as holder from k where length(key) >= 20 group by key having count(distinct doc_id) >= 3),
d as (select k.doc_id, k.i, k.line, f.key is not null and f.holder <> k.doc_id as gone from k left join f on k.key = f.key)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped, sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256 from d group by doc_id""",
    "op5_chat_events": r"""with c as (select conv_id, turn, role, coalesce(text, '') as text from conversations
union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e as (select *, length(regexp_replace(text, '([\\\[<])', '\\\1', 'g')) as n from c)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
sha256(coalesce(string_agg(text, '' order by turn) filter (role = 'assistant'), '')) as loss_sha256,
cast(sum(n + case role when 'user' then 15 when 'assistant' then 4 when 'system' then 13 else 0 end) as bigint) as formatted_chars from e group by conv_id""",
}

ORACLES |= {
    # 4-byte windows of the text, little-endian, by a multiplicative hash into 65,536 buckets
    "op2_quality_llr": r"""with
d as (select doc_id, coalesce(text, '') as t, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws, hex(encode(coalesce(text, ''))) as h from documents),
l as (select doc_id, unnest(string_split(t, chr(10))) as line from d),
dup as (select doc_id, count(*) - count(distinct line) as n from l where regexp_matches(line, '[^\x20\x09-\x0D]') group by 1),
w3 as (select doc_id, unnest(range(1, len(ws) - 1)) as i, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) as g from d where len(ws) > 2),
twice as (select doc_id, i from w3 qualify count(*) over (partition by doc_id, g) > 1),
rep as (select doc_id, count(distinct p) as n from (select doc_id, unnest([i, i + 1, i + 2]) as p from twice) group by 1),
b as (select doc_id, len(ws) as n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) as word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols, coalesce(dup.n, 0) as n_dup_lines, coalesce(rep.n, 0) as n_repeat_words
 from d left join dup using (doc_id) left join rep using (doc_id)),
v as (select doc_id, list_transform(regexp_extract_all(h, '..'), lambda x: cast('0x' || x as bigint)) as bs from d),
k as (select doc_id, cast((v::hugeint * 2654435761 % 4294967296) // 65536 as int) as k from (select doc_id, unnest(list_transform(range(1, len(bs) - 2), lambda i: bs[i] + 256 * bs[i + 1] + 65536 * bs[i + 2] + 16777216 * bs[i + 3])) as v from v)),
r as (select k, count(*) as raw, count(*) filter (doc_id in (select doc_id from labels where quality = 1)) as target from k group by 1),
s as (select sum(raw) as raw, sum(target) as target from r),
m as (select k, case when s.target > 0 then ln((r.target + 0.5) / (s.target + 32768.0)) - ln((r.raw + 0.5) / (s.raw + 32768.0)) else 0 end as gain from r, s),
a as (select doc_id, avg(gain) as llr from k join m using (k) group by 1),
f as (select b.*, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed, round(coalesce(llr, 0), 6) as llr from b left join a using (doc_id))
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols, cast(n_dup_lines as bigint) as n_dup_lines, cast(n_repeat_words as bigint) as n_repeat_words, base_failed, llr, not base_failed and llr >= -0.5 as kept from f""",
    # CRC-32 by a table of 256 that is built by its rule; gains and draws as stated
    "op11_crc_resample": r"""with
t as (select list(list_reduce(list_prepend(i, range(8)), lambda c, k: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end) order by i) as crcs from range(256) r(i)),
d as (select doc_id, list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as ws from documents),
m as (select unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as w from benchmark),
s as (select doc_id, w, count(*) as n from (select doc_id, unnest(ws) as w from d) group by all),
v as (select w, hex(encode(w)) as x from (select w from s union select w from m)),
b as (select w, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(x) // 2), lambda i: cast('0x' || substr(x, 2 * i + 1, 2) as bigint))), lambda c, y: xor(c // 256, crcs[xor(c % 256, y) + 1])), 4294967295) % 10000 as k from v, t),
cs as (select k, sum(n) as s from s join b using (w) group by 1), ct as (select k, count(*) as t from m join b using (w) group by 1),
g as (select k, cast(floor(1000 * ln(cast(coalesce(t, 0) + 1 as double) * ((select coalesce(sum(s), 0) from cs) + 10000) / (cast(s + 1 as double) * ((select coalesce(sum(t), 0) from ct) + 10000)))) as bigint) as gain from cs left join ct using (k)),
w as (select doc_id, sum(n * gain) as weight from s join b using (w) join g using (k) group by 1),
h as (select d.doc_id, len(ws) as n_features, coalesce(weight, 0) as weight, coalesce(weight, 0) + cast(floor(-1000 * ln(-ln((cast('0x' || sha256('2024:' || d.doc_id)[:8] as bigint) + 0.5::double) / 4294967296))) as bigint) as score from d left join w on w.doc_id = d.doc_id),
r as (select *, row_number() over (partition by n_features >= 20 order by score desc, doc_id) as p, count(*) filter (n_features >= 20) over () as enough from h)
select doc_id, cast(n_features as bigint) as n_features, cast(weight as bigint) as weight, cast(score as bigint) as score, case when n_features >= 20 and p <= 10 * enough // 100 then cast(p as bigint) end as rank from r""",
    "op12_token_rules": r"""with
u as (select page_id, translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) as path,
 translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://((?s:.*))$', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as rest from pages),
s(v, h, p) as (values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
f as (select page_id, arg_max(struct_pack(v := v, r := h || p), length(h || p)) as best from u join s on (host = h or suffix(host, '.' || h)) and starts_with(path, p) group by 1)
select u.page_id, host, path, best.r as rule, coalesce(best.v, case when regexp_matches(rest, '^([^/?#]*\.)?casino-history\.') then 'allow'
 when regexp_matches(rest, '^([^/?#]*\.)?((?s:casino-.*\.)|free-bets\.|cheap-pills\.|ads-track\.|adserver\.|ads\.|(?s:poker-.*\.)|(?s:track\..*/pixel([^a-z0-9_.%-]|$)))') then 'block'
 when regexp_matches(rest, '/popunder/|/banner-ads/|[^a-z0-9_.%-]affiliate_id=|-viagra-|/wp-login\.php$') then 'block' else 'allow' end) as verdict from u left join f using (page_id)""",
    "op13_one_bit_negatives": r"""with
c as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as double)) as v from embeddings
 where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, cast(list_dot_product(a.v, b.v) as bigint) as score from c a join c b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
p as (select * from s where same qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
n as (select p.anchor_id, p.vec_id as positive_id, s.vec_id as negative_id, p.score as positive_score, s.score as negative_score, row_number() over (partition by p.anchor_id, p.vec_id order by s.score desc, s.vec_id) as rank
 from p join s on p.anchor_id = s.anchor_id and not s.same and 80 * p.score <= 100 * s.score and 100 * s.score <= 100 * p.score)
select anchor_id, positive_id, cast(rank as int) as rank, negative_id, positive_score, negative_score from n where rank <= 5""",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
