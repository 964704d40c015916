"""One registered query per operator, over its whole table, and its SQL where there is some."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelayers.llm import bpe, chat, decontaminate, embeddings, language, lines, merkle, neardup, packing
from carelayers.llm import phrases, secrets, topk, warc
from carelayers.llm.tokens import default_tokenizer
from carelayers.sources.layers import shared_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _register(name: str, sql: str | None = None):
    def keep(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return keep


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_register("op1_language")
def op1_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = language.train(docs.where(~language.held_out()))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


OP2_SQL = """
with whole as (
    select vec_id, row_number() over () as u, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
    from embeddings
    where vec_id is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or not isfinite(cast(x as double)))) = 0
), scored as (
    select q.vec_id as query_id, q.u as u, c.vec_id as vec_id,
           cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
    from whole q join whole c on q.u <> c.u and len(q.v) = len(c.v)
    where q.vec_id % 50 = 0
)
select query_id, cast(row_number() over (partition by u order by score desc, vec_id) as integer) as rank,
       vec_id, score
from scored qualify rank <= 5
"""


@_register("op2_topk", OP2_SQL)
def op2_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(_table(spark, folder, "embeddings"))


OP3_SQL = """
with paid as (
    select page_id, coalesce(html, '') as payload, strlen(coalesce(html, '')) as payload_bytes,
           sha256(coalesce(html, '')) as payload_digest
    from pages
), groups as (
    select payload_digest, min(page_id) as first from paid where payload_bytes >= 100 group by payload_digest
)
select page_id, payload_bytes, payload_digest,
       case when page_id > first then 'revisit' else 'response' end as record_type,
       case when page_id > first then first end as refers_to
from paid left join groups using (payload_digest)
"""


@_register("op3_warc", OP3_SQL)
def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    index = warc.write_archives(_table(spark, folder, "pages"), warc.archive_folder(spark))
    return warc.read_archives(index)


@_register("op4_bpe")
def op4_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(_table(spark, folder, "documents"), default_tokenizer())


OP5_SQL = """
with places as (
    select doc_id, source, unnest(string_split(text, chr(10))) as line,
           generate_subscripts(string_split(text, chr(10)), 1) as pos
    from documents where text is not null
), shared as (
    select line, min(row(doc_id, pos)) as first from places where line <> ''
    group by line having count(distinct source) >= 10
), marked as (
    select places.*, shared.line is not null and doc_id is not null
           and row(doc_id, pos) <> shared.first as removed
    from places left join shared using (line)
), rebuilt as (
    select doc_id, coalesce(string_agg(line, chr(10) order by pos) filter (not removed), '') as text,
           count(*) filter (removed) as n_removed
    from marked group by doc_id
)
select documents.doc_id, rebuilt.text, coalesce(rebuilt.n_removed, 0) as n_removed
from documents left join rebuilt using (doc_id)
"""


@_register("op5_lines", OP5_SQL)
def op5_lines(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", "source")
    return lines.dedup_lines(docs).drop("source")


@_register("op6_neardup")
def op6_neardup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, folder, "documents"))


@_register("op7_embeddings")
def op7_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, folder, "embeddings"))


@_register("op8_packing")
def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"), default_tokenizer())


OP9_SQL = """
with ranked as (
    select conv_id, role, coalesce(replace(text, '<|', '<\\|'), '') as body,
           row_number() over (partition by conv_id order by turn nulls last, role nulls last,
                              coalesce(text, '')) as place
    from conversations
), segmented as (
    select *, cast(floor((place - 1) / 64) as bigint) as segment from ranked
), opened as (
    select conv_id, min(place) filter (role is distinct from 'system') as opened from segmented group by conv_id
), texts as (
    select distinct s.conv_id, g.segment, s.role as perspective
    from segmented s join segmented g on s.conv_id is not distinct from g.conv_id where s.role <> 'system'
), pieces as (
    select s.conv_id, s.segment, s.perspective, t.place, t.segment = s.segment as counted,
           coalesce(t.role = s.perspective, false) as own,
           '<|im_start|>' || case when t.role = 'system' then 'system'
               when t.role = s.perspective then 'assistant'
               else 'user name=' || regexp_replace(replace(coalesce(t.role, 'unknown'), '<|', '<\\|'),
                                                   '\\s+', ' ', 'g') end || chr(10) as head,
           t.body || '<|im_end|>' as body
    from texts s join segmented t on s.conv_id is not distinct from t.conv_id
    join opened o on o.conv_id is not distinct from t.conv_id
    where t.segment = s.segment or (t.segment < s.segment and t.place < o.opened)
), placed as (
    select *, length(head) + coalesce(sum(length(head) + length(body) + 1) over (
               partition by conv_id, segment, perspective order by place
               rows between unbounded preceding and 1 preceding), 0) as start
    from pieces
)
select conv_id, segment, perspective, count(*) filter (counted) as n_turns,
       string_agg(head || body || chr(10), '' order by place) as text,
       string_agg(start || ':' || (start + length(body)), ',' order by place) filter (own) as masks
from placed group by conv_id, segment, perspective
"""


@_register("op9_chat", OP9_SQL)
def op9_chat(spark: SparkSession, folder: str) -> DataFrame:
    sides = chat.perspectives(_table(spark, folder, "conversations"))
    spans = F.transform("masks", lambda m: F.concat_ws(":", m["start"], m["end"]))
    return sides.withColumn("masks", F.array_join(spans, ","))


@_register("op10_secrets")
def op10_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(_table(spark, folder, "documents").select("doc_id", "text")).drop("text")
    spans = F.col("spans")

    def of(*kinds: str) -> Column:
        return F.filter(spans, lambda s: s["kind"].isin(*kinds))

    counts = [F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in secrets.PATTERN_KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(secrets.written(of(*secrets.PATTERN_KINDS)), 256).alias("base_sha256"),
        secrets.written(spans).alias("spans"),
    )


OP12_SQL = """
with recursive texts as (
    select doc_id, lang, text, row_number() over () as row_id,
           case when doc_id is null then false else xor(4294967295, list_reduce(
               list_prepend(cast(4294967295 as ubigint), list_transform(
                   range(cast(length(cast(doc_id as varchar)) as bigint)),
                   lambda i: cast(ascii(cast(doc_id as varchar)[i + 1]) as ubigint))),
               lambda crc, byte: list_reduce(
                   list_prepend(xor(crc, byte), cast([0, 0, 0, 0, 0, 0, 0, 0] as ubigint[])),
                   lambda x, unused: case when x & 1 = 1 then xor(x >> 1, cast(3988292384 as ubigint)) else x >> 1 end)
           )) % 3 = 0 end as tampered,
           coalesce(strlen(cast(doc_id as varchar)) || ':' || cast(doc_id as varchar), '-')
           || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
           || coalesce(strlen(cast(n_chars as varchar)) || ':' || cast(n_chars as varchar), '-') as head
    from documents
), leaves as (
    select row_id, doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
           sha256(head || coalesce(strlen(text) || ':' || case when tampered then
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else text end, '-')) as shown
    from texts
), placed as (
    select *, row_number() over (partition by lang order by doc_id nulls last, leaf, shown) - 1 as place,
           count(*) over (partition by lang) as n
    from leaves
), nodes as (
    select lang, 0 as height, place, leaf as digest, n from placed
    union all
    select lang, height + 1, place // 8, sha256(string_agg(digest, '' order by place)),
           cast(ceil(n / 8.0) as bigint)
    from nodes where n > 1 group by lang, height, n, place // 8
), subroots as (
    select lang, digest, row_number() over (order by lang nulls first) - 1 as place, count(*) over () as n
    from nodes where n = 1
), tops as (
    select 0 as height, place, digest, n from subroots
    union all
    select height + 1, place // 8, sha256(string_agg(digest, '' order by place)), cast(ceil(n / 8.0) as bigint)
    from tops where n > 1 group by height, n, place // 8
), paths as (
    select p.row_id, s.height, coalesce(string_agg(s.digest, '' order by s.place) filter (s.place < o.place), '') as lefts,
           coalesce(string_agg(s.digest, '' order by s.place) filter (s.place > o.place), '') as rights
    from placed p join nodes o on p.lang is not distinct from o.lang and o.place = p.place // cast(8 ** o.height as bigint)
    join nodes s on s.lang is not distinct from o.lang and s.height = o.height and s.place // 8 = o.place // 8
    where o.n > 1 group by p.row_id, s.height
    union all
    select p.row_id, 100 + s.height, coalesce(string_agg(s.digest, '' order by s.place) filter (s.place < o.place), ''),
           coalesce(string_agg(s.digest, '' order by s.place) filter (s.place > o.place), '')
    from placed p join subroots r on p.lang is not distinct from r.lang
    join tops o on o.place = r.place // cast(8 ** o.height as bigint)
    join tops s on s.height = o.height and s.place // 8 = o.place // 8
    where o.n > 1 group by p.row_id, s.height
), steps as (
    select *, row_number() over (partition by row_id order by height) as step from paths
), folded as (
    select row_id, cast(0 as bigint) as step, shown as digest from placed
    union all
    select f.row_id, s.step, sha256(s.lefts || f.digest || s.rights)
    from folded f join steps s on s.row_id = f.row_id and s.step = f.step + 1
), ends as (
    select row_id, max_by(digest, step) as digest from folded group by row_id
), siblings as (
    select row_id, string_agg(lefts || rights, '' order by step) as digests from steps group by row_id
)
select p.doc_id, p.leaf, r.digest as subroot, t.digest as root, sha256(coalesce(b.digests, '')) as proof_sha256,
       e.digest as folded_root, e.digest = t.digest as verified
from placed p join subroots r on p.lang is not distinct from r.lang join ends e using (row_id)
left join siblings b using (row_id) cross join (select digest from tops where n = 1) t
"""


@_register("op12_merkle", OP12_SQL)
def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.verified_documents(_table(spark, folder, "documents"), shared_folder(spark, "merkle"))


OP13_SQL = """
with items as (
    select item_id, regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
    from benchmark where text is not null
), windows as (
    select item_id, 10 as n, array_to_string(list_slice(w, i, i + 9), ' ') as passage
    from (select item_id, w, unnest(range(1, len(w) - 8)) as i from items)
    union
    select item_id, len(w), array_to_string(w, ' ') from items where len(w) between 1 and 9
), texts as (
    select doc_id, row_number() over () as row_id, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
    from documents
), passages as (
    select row_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') as passage
    from (select row_id, w, n, unnest(range(1, len(w) - n + 2)) as i
          from texts cross join (select distinct n from windows))
), hits as (
    select row_id, passages.n, i, item_id from passages join windows using (n, passage)
), counted as (
    select row_id, count(distinct word) as n_hit
    from (select row_id, unnest(range(i, i + n)) as word from (select distinct row_id, n, i from hits))
    group by row_id
), named as (
    select row_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as item_ids
    from (select distinct row_id, cast(item_id as varchar) as item_id from hits where item_id is not null)
    group by row_id
)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(item_ids, '')) as items_sha256, n_hit is not null as contaminated
from texts left join counted using (row_id) left join named using (row_id)
"""


@_register("op13_decontaminate", OP13_SQL)
def op13_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs, benchmark = _table(spark, folder, "documents"), _table(spark, folder, "benchmark")
    found = decontaminate.find_passages(docs, benchmark, keep=["doc_id"])
    return found.select(
        "row.doc_id",
        "n_words",
        decontaminate.n_hit(F.col("spans")).alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


OP11_SQL = """
with pieces as (
    select coalesce(lang, 'und') as lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\\x0A-\\x0D]')) as piece
    from documents
), lists as (
    select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from pieces
), totals as (
    select lang, cast(sum(len(w)) as bigint) as n from lists group by lang
), phrases as (
    select lang, size, phrase, count(*) as f
    from (select lang, size, array_to_string(list_slice(w, i, i + size - 1), ' ') as phrase
          from (select lang, w, size, unnest(range(1, len(w) - size + 2)) as i
                from lists cross join (select unnest([1, 2, 3, 4, 5]) as size)))
    group by lang, size, phrase having count(*) >= 100
), cuts as (
    select lang, size, phrase, f as a, k, array_to_string(list_slice(w, 1, k), ' ') as head,
           array_to_string(list_slice(w, k + 1, size), ' ') as tail
    from (select *, string_split(phrase, ' ') as w, unnest(range(1, size)) as k from phrases where size > 1)
), scored as (
    select cuts.lang, cuts.phrase, cuts.size, a, k, h.f as l, t.f as r, n,
           cast((cast(1000 as hugeint) * a * n) // (cast(h.f as hugeint) * t.f) as bigint) as score
    from cuts join phrases h on h.lang = cuts.lang and h.phrase = head
    join phrases t on t.lang = cuts.lang and t.phrase = tail join totals on totals.lang = cuts.lang
), lowest as (
    select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1
), kept as (
    select * from lowest c where not exists (
        select 1 from phrases x where x.lang = c.lang and x.size > c.size and 100 * x.f >= 100 * c.a
        and contains(' ' || x.phrase || ' ', ' ' || c.phrase || ' '))
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from kept qualify rank <= 2000
"""


@_register("op11_collocations", OP11_SQL)
def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(_table(spark, folder, "documents"))
