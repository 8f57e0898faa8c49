"""Registered queries of the operators: thin digests over whole tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm import (
    ann_forest, decontam, katz, langid, license_scan, mixing, near_dedup, secret_scan, structure, token_lengths,
    toxicity, warc, whitening,
)
from ledgerloom.llm.common import numbered
from ledgerloom.session import new_stage_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_near_dedup", r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words
  from documents
), s as (
  select distinct doc_id, array_to_string(words[i:i + least(5, len(words)) - 1], ' ') as g
  from (select *, unnest(range(1, len(words) - least(5, len(words)) + 2)) as i from w where len(words) > 0)
), n as (select doc_id, count(*) as n from s group by doc_id),
pairs as (select x.doc_id as a, y.doc_id as b, count(*) as c from s x join s y on x.g = y.g and x.doc_id < y.doc_id group by all),
link as (select a, b from pairs join n p on p.doc_id = a join n q on q.doc_id = b where 100 * c >= 85 * (p.n + q.n - c)),
both_ways as (select a, b from link union all select b, a from link),
reach as (select doc_id as a, doc_id as b from documents union select reach.a, both_ways.b from reach join both_ways on reach.b = both_ways.a),
comp as (select a, min(b) as c from reach group by a)
select d.doc_id, coalesce(n.n, 0) as n_shingles, c as component_id, d.doc_id = c as kept
from documents d left join n using (doc_id) join comp on comp.a = d.doc_id
""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_dedup.near_groups(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


@query("op6_decontaminate", rf"""
with w as (
  select 'd' as side, doc_id as id, regexp_extract_all({ASCII_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from documents
  union all
  select 'b', item_id, regexp_extract_all({ASCII_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') from benchmark
), windows as (
  select distinct id as item_id, array_to_string(words[s:s + least(10, len(words)) - 1], ' ') as win, least(10, len(words)) as n
  from (select *, unnest(range(1, len(words) - least(10, len(words)) + 2)) as s from w where side = 'b' and len(words) > 0)
), sizes as (select distinct n from windows), places as (
  select id as doc_id, s, n, array_to_string(words[s:s + n - 1], ' ') as win
  from (select id, words, n, unnest(range(1, len(words) - n + 2)) as s from w, sizes where side = 'd' and len(words) >= n)
), met as (select doc_id, s, places.n, item_id from places join windows using (win)),
hit as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(s, s + n)) as p from met) group by doc_id),
items as (select doc_id, count(*) as n_items, string_agg(i, ',' order by i) as ids
          from (select distinct doc_id, cast(item_id as varchar) as i from met where item_id is not null) group by doc_id)
select w.id as doc_id, cast(len(words) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from w left join hit on hit.doc_id = w.id left join items on items.doc_id = w.id where side = 'd'
""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query("op2_license_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


@query("op8_secret_scan")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan.scan(table(spark, sf_dir, "documents"))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    rank = F.array(*map(F.lit, secret_scan.KINDS))
    every = F.array_sort(F.transform(F.concat("base", "more"), lambda s: F.struct(
        s["start"].alias("start"), F.coalesce(F.nullif(F.array_position(rank, s["kind"]), F.lit(0)), F.lit(9)).alias("rank"),
        s["end"].alias("end"), s["kind"].alias("kind"))))
    return out.select("doc_id", *[count(k) for k in secret_scan.KINDS], F.sha2(listed("base"), 256).alias("base_sha256"),
                      listed(every).alias("spans"))


@query("op5_mix", r"""
with base as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
         (cast(cast('0x' || substr(md5('mix|' || coalesce(cast(doc_id as varchar), '') || '|' || md5(coalesce(text, ''))), 1, 13) as bigint) as double)
          + 0.5) / 4503599627370496.0 as u
  from documents
), s as (
  select source, cast(sum(size) as bigint) as source_size, (row_number() over (order by source is null, source) - 1) % 3 as turn from base group by source
), w as (select *, case turn when 0 then 3 when 1 then 1 else 2 end as weight from s),
o as (
  select *, sum(source_size) over () as total, sum(weight) over () as weights,
         coalesce(sum(source_size) over prior, 0) as capped_before, coalesce(sum(weight) over prior, 0) as weight_before
  from w window prior as (order by source_size / weight, source is null, source rows between unbounded preceding and 1 preceding)
), l as (select *, cast(3 * total - 4 * capped_before as bigint) as rest_words, cast(weights - weight_before as bigint) as rest from o),
c as (select *, weight * rest_words >= 4 * source_size * rest as capped from l),
f as (select *, max(case when not capped then rest end) over () as fr from c),
g as (select *, max(case when not capped and rest = fr then rest_words end) over () as fl from f),
t as (select source, source_size, case when capped then cast(2 * source_size as double) else cast(weight * fl as double) / cast(2 * fr as double) end as target from g),
p as (select *, case when source_size = 0 then 0.0 else target / source_size end as ratio from t),
d as (
  select doc_id, base.source, size, source_size, target, floor(ratio) as whole, ratio - floor(ratio) as part, target - floor(ratio) * source_size as remain, u,
         cast(floor(16 * sqrt(size)) as bigint) as worth
  from base join p on base.source is not distinct from p.source
), h as (
  select source, worth, any_value(remain) - coalesce(sum(sum(size)) over (partition by source order by worth desc rows between unbounded preceding and 1 preceding), 0) as rest,
         sum(worth * sum(size)) over (partition by source order by worth rows between unbounded preceding and current row) as weighted
  from d where part > 0 and size > 0 group by source, worth
), r as (select source, max({'worth': worth, 'rest': rest, 'weighted': weighted}) as w from h where worth * rest <= weighted group by source),
ch as (
  select d.*, case when worth > r.w.worth then 1.0 else coalesce(cast(worth as double) * r.w.rest / r.w.weighted, 0.0) end as chance
  from d left join r on d.source is not distinct from r.source
), k as (
  select *, case when chance >= 1 then 0.0::double when chance > 0 then (u / (1 - u)) * (1 - chance) / chance else 'inf'::double end as rk from ch
), e as (
  select *, coalesce(sum(size) over (partition by source order by case when rk = 'inf'::double then 1.0 else rk / (1 + rk) end, u, doc_id, size
                                     rows between unbounded preceding and 1 preceding), 0) as reached from k
)
select doc_id, cast(size as bigint) as size, source_size, target,
       cast(case when size = 0 then 0 else size * least(whole + case when part > 0 and 2 * reached + size <= 2 * remain then 1 else 0 end, 2) end as bigint) as taken
from e
""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op9_token_lengths")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_lengths.suffix_sums(token_lengths.lengths(table(spark, sf_dir, "documents")))


@query("op10_warc", r"""
with p as (select page_id, octet_length(encode(coalesce(html, ''))) as n, sha1(coalesce(html, '')) as h from pages),
b as (
  select *, array_to_string([list_extract(
    ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111'],
    strpos('0123456789abcdef', substr(h, i, 1))) for i in range(1, 41)], '') as bits, min(page_id) over (partition by h) as head from p
)
select page_id, cast(n as bigint) as payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 +
         16 * cast(substr(bits, 5 * i + 1, 1) as int) + 8 * cast(substr(bits, 5 * i + 2, 1) as int) + 4 * cast(substr(bits, 5 * i + 3, 1) as int) +
         2 * cast(substr(bits, 5 * i + 4, 1) as int) + cast(substr(bits, 5 * i + 5, 1) as int), 1) for i in range(0, 32)], '') as payload_digest,
       case when page_id = head then 'response' else 'revisit' end as record_type, case when page_id = head then null else head end as refers_to
from b
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, folder = table(spark, sf_dir, "pages"), new_stage_path(spark, "warc")
    warc.write_warc(pages, folder)
    out = warc.read_warc(spark, folder, pages.schema["page_id"].dataType.simpleString(), payloads=False)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def checksum(name: str, parts: int):
    return F.pmod(F.crc32(F.col(name).cast("string")), F.lit(parts))


@query("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(checksum("doc_id", 4) == 2, F.lit(False))
    model = langid.train(docs.where(~held_out))
    return langid.predict(docs, model, {"doc_id": F.col("doc_id"), "held_out": held_out})


@query("op4_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(checksum("doc_id", 5) == 0, F.lit(False))
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels"), checksum("id", 5) != 0)
    return toxicity.score(docs, lexicon, {"doc_id": F.col("doc_id"), "held_out": held_out})


@query("op3_nearest")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_forest.neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op11_repair", r"""
with recursive keyed as (
  select *, coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as k from conversations
), coded as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         xor(list_reduce([4294967295::bigint] || list_transform(range(1, length(k) + 1), lambda i: ascii(substr(k, i, 1))::bigint),
           lambda c, b: list_reduce([xor(c, b)] || range(8), lambda x, _: case when x & 1 = 1 then xor(x >> 1, 3988292384::bigint) else x >> 1 end)),
           4294967295::bigint) % 20 as code
  from keyed
), damaged as (
  select conv_id, turn, case code when 4 then 'user' else role end as role,
         case code when 1 then '' when 2 then translate(text, '.!?', '') else text end as text
  from coded, range(2) copies(i) where code <> 0 and (i = 0 or code = 3)
), placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text)) as p,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as t
  from damaged
), faulty as (
  select *, case when t = '' then 'b' when p > min(p) over (partition by conv_id, role, text) then 'd' when right(t, 1) not in ('.', '!', '?') then 't' else '' end as fault,
         left(role, 1) || left(coalesce(lead(role) over (partition by conv_id order by p), ''), 1) as two,
         lead(p) over (partition by conv_id order by p) is not null as follows
  from placed
), stats as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'b') as blank,
         count(*) filter (fault = 'd') as duplicate, count(*) filter (fault = 't') as truncated,
         count(*) filter (follows and two not in ('su', 'ua', 'au')) as illegal, count(*) as n
  from faulty group by conv_id
), step(q, r, q2) as (values ('E', 's', 'S'), ('E', 'u', 'U'), ('S', 'u', 'U'), ('U', 'a', 'A'), ('A', 'u', 'U')),
-- up to two insertions, then the edit of a row or, at the end, nothing
put(q, q2, cost, audit, lines) as (
  select q, q, 0, '', []::varchar[] from (values ('E'), ('S'), ('U'), ('A')) s(q)
  union all select q, q2, 2, 'I', [case r when 'u' then 'user:' else 'assistant:' end] from step where r <> 's'
  union all select x.q, y.q2, 4, 'II', [case x.r when 'u' then 'user:' else 'assistant:' end, case y.r when 'u' then 'user:' else 'assistant:' end]
  from step x join step y on x.q2 = y.q where x.r <> 's' and y.r <> 's'
), best as (
  select conv_id, 0::bigint as p, 'E' as q, 0::bigint as cost, '' as audit, []::varchar[] as lines from stats
  union all
  select conv_id, p, q, w.cost, w.audit, w.lines from (
    select conv_id, p, q, min({'cost': cost, 'audit': audit, 'lines': lines}) as w from (
      select b.conv_id, f.p, case e.edit when 'D' then put.q2 else step.q2 end as q,
             b.cost + put.cost + case e.edit when 'D' then 3 when 'R' then 2 else 0 end + case when e.edit <> 'D' and f.fault = 't' then 1 else 0 end as cost,
             b.audit || put.audit || e.edit as audit,
             b.lines || put.lines || case e.edit when 'D' then [] when 'K' then [f.role || ':' || f.text]
               else [case step.r when 'u' then 'user:' else 'assistant:' end || f.text] end as lines
      from best b join faulty f on f.conv_id is not distinct from b.conv_id and f.p = b.p + 1 join put on put.q = b.q
      cross join (values ('K'), ('R'), ('D')) e(edit) left join step on step.q = put.q2 and e.edit <> 'D'
      where e.edit = 'D' or (f.fault not in ('b', 'd') and step.q is not null
            and ((e.edit = 'K' and left(f.role, 1) = step.r) or (e.edit = 'R' and step.r <> 's')))
    ) options group by conv_id, p, q
  ) picked
), goals as (
  select s.conv_id, min({'cost': b.cost + put.cost, 'audit': b.audit || put.audit, 'lines': b.lines || put.lines}) as w
  from stats s join best b on b.conv_id is not distinct from s.conv_id and b.p = s.n join put on put.q = b.q
  where put.q2 in ('E', 'A') group by s.conv_id
)
select c.conv_id, coalesce(s.gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
       coalesce(illegal, 0) as illegal, coalesce(g.w.cost, 0) as cost, coalesce(g.w.audit, '') as audit,
       sha256(coalesce(array_to_string(g.w.lines, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) c left join stats s on s.conv_id is not distinct from c.conv_id
left join goals g on g.conv_id is not distinct from c.conv_id
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, name = numbered(table(spark, sf_dir, "conversations"))
    repair = structure.Conversations(structure.damage(rows, name), name="name")
    every = rows.select(structure.conversation_key("conv_id").alias("key"), "conv_id").distinct()
    out = every.join(repair.summary().drop("conv_id"), "key", "left").join(repair.digests(), "key", "left")
    return out.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


@query("op12_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=4)


@query("op13_katz")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(checksum("doc_id", 7) == 2, F.lit(False))
    return katz.Katz(docs, ~held_out, order=2, keep={"doc_id": F.col("doc_id"), "held_out": held_out}).scores()
