"""The queries of this subpackage and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .labelled import held_out
    from .mil import classify, fit_classifier

    docs = _read(spark, sf_dir, "documents")
    scored = classify(docs, fit_classifier(docs, _read(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op2_sorted_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .embed_dedup import dedup_embeddings

    return dedup_embeddings(_read(spark, sf_dir, "embeddings"))


def op3_power_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents

    pieces = pack_documents(_read(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")


def op4_stream_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .store import shared_dir
    from .token_files import read_token_files, write_token_files

    folder = f"{shared_dir(spark)}/tokens"
    write_token_files(_read(spark, sf_dir, "documents"), folder, _vocabulary("word_bpe_49k.json"))
    return read_token_files(spark, folder)


def op5_multinomial_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix_sources

    return mix_sources(_read(spark, sf_dir, "documents")).per_doc.select("doc_id", "size", "source_size", "target", "taken")


CONTROL_TURN = "</s>[INST] ok [/INST]"


def op6_chat_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat import format_conversations, loss_text, read_turns

    rows = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TURN).alias("text"))
    made = read_turns(format_conversations(rows.unionByName(extra)).drop("segments"))
    loss = loss_text(F.col("formatted"), F.col("loss_spans"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return made.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), F.char_length("formatted").cast("long").alias("formatted_chars"), "valid")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import jaccard_components

    return jaccard_components(_read(spark, sf_dir, "documents"))


def op8_weighted_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import filter_urls

    return filter_urls(_read(spark, sf_dir, "pages"))


def op9_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .backoff_lm import backoff_scores

    scored = backoff_scores(_read(spark, sf_dir, "documents"))
    return scored.select("doc_id", "n_words", F.round("log_score", 4).alias("log_score"), F.round("mean_log_score", 6).alias("mean_log_score"))


def op10_boosted_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import apply_rules, fit_rules

    docs = _read(spark, sf_dir, "documents")
    return apply_rules(docs, fit_rules(docs, _read(spark, sf_dir, "labels")))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .filter_audit import audit_filters, failing_rows

    rows = failing_rows(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))
    told = audit_filters(rows, list("ABCDE"), ["good", "toxic"])
    return told.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", F.col("lost_good").alias("good_lost"), F.col("lost_toxic").alias("toxic_lost"), "shapley")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .merkle import fold, in_a_fifth, lowered, manifest, proof_text

    made = manifest(_read(spark, sf_dir, "documents"), in_a_fifth(F.col("doc_id")), lowered(F.col("text")))
    made = made.withColumn("folded_root", fold(F.coalesce("changed", "leaf"), F.col("above")))
    return made.select("doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("above")), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_chunk_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chunk_bpe import decode_documents, encode_documents

    path = _vocabulary("byte_bpe_50k.json")
    made = decode_documents(encode_documents(_read(spark, sf_dir, "documents"), path), path)
    return made.select("doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_attention_quality, op2_sorted_passes, op3_power_packing, op4_stream_files, op5_multinomial_mix, op6_chat_machine, op7_jaccard_join, op8_weighted_urls, op9_stupid_backoff, op10_boosted_rules, op11_filter_audit, op12_merkle_manifest, op13_chunk_bpe)}


def _op6_sql() -> str:
    from .chat import OTHER, TEMPLATE, controls

    def escaped(x: str) -> str:
        out = f"replace({x}, '\\', '\\b')"
        for c in controls():
            out = f"replace({out}, '{c}', '{c[0]}\\z{c[1:]}')"
        return out

    marks = " ".join(f"when '{r}' then {len(b) + len(a)}" for r, (b, a, _) in TEMPLATE.items())
    loss = ", ".join(f"'{r}'" for r, (_, _, counts) in TEMPLATE.items() if counts)
    # Roles that the template names are fixed and hold no control string.
    return f"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '{CONTROL_TURN}'), (-7, 1, 'assistant', '{CONTROL_TURN}')),
m as (select *, length({escaped("text")}) + case role {marks} else length({escaped("role")}) + {sum(map(len, OTHER))} end as chars from t),
c as (select conv_id, count(*) as n_turns,
  string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text) as said,
  coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role in ({loss})), '') as loss,
  cast(sum(chars) as bigint) as formatted_chars,
  string_agg(role, ',' order by turn nulls first, role, text) as roles from m group by conv_id)
select conv_id, n_turns, sha256(said) as turns_sha256, length(loss) as loss_chars, sha256(loss) as loss_sha256, formatted_chars,
  regexp_full_match(roles, '(system,)?user,assistant(,user,assistant)*') as valid from c"""


def _op8_sql() -> str:
    from .url_filter import RULES, SOFT, STRICT

    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    count = lambda terms: " + ".join(f"cast(regexp_matches(u, '(^|[^a-z0-9]){t}([^a-z0-9]|$)') as bigint)" for t in terms)
    ranked = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    fits = lambda r: f"(host = '{r[0]}' or ends_with(host, '.{r[0]}')) and starts_with(path, '{r[1]}')"
    rule = "case " + " ".join(f"when {fits(r)} then '{r[0]}{r[1]}'" for r in ranked) + " end"
    verdict = "case " + " ".join(f"when {fits(r)} then '{r[2]}'" for r in ranked) + " when n_strict > 0 or n_soft >= 2 then 'block' else 'allow' end"
    return f"""
with a as (select page_id, translate(coalesce(url, ''), '{upper}', '{lower}') as u,
  case when contains(url, '://') then substr(url, position('://' in url) + 3) else '' end as rest from pages),
b as (select page_id, u, translate(regexp_extract(rest, '^[^/?#]*'), '{upper}', '{lower}') as host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from a),
c as (select *, {count(STRICT)} as n_strict, {count(SOFT)} as n_soft from b)
select page_id, host, path, {rule} as rule, {verdict} as verdict, n_strict, n_soft from c"""


def _op9_sql() -> str:
    # Every n-gram of a corpus that is scored by itself occurs in it, so the longest one at each word decides.
    return r"""
with d as (select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
w as (select r, unnest(ws) as w, generate_subscripts(ws, 1) as i from d),
g as (select r, i, w, lag(w) over o as v, lag(w, 2) over o as u from w window o as (partition by r order by i)),
one as (select w, count(*) as c from g group by w),
two as (select v, w, count(*) as c from g where v is not null group by v, w),
three as (select u, v, w, count(*) as c from g where u is not null group by u, v, w),
n as (select cast(count(*) as double) as n from g),
s as (select g.r, case when g.u is not null then ln(three.c / cast(h2.c as double)) when g.v is not null then ln(two.c / cast(h1.c as double)) else ln(one.c / n.n) end as s
  from g join one on g.w = one.w left join two on g.v = two.v and g.w = two.w left join one h1 on g.v = h1.w
  left join three on g.u = three.u and g.v = three.v and g.w = three.w left join two h2 on g.u = h2.v and g.v = h2.w cross join n),
t as (select r, sum(s) as s from s group by r)
select doc_id, cast(len(ws) as bigint) as n_words, round(coalesce(s, 0), 4) as log_score, round(s / nullif(len(ws), 0), 6) as mean_log_score from d left join t using (r)"""


def _op11_sql() -> str:
    return r"""
with d as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x != '') as ws from documents),
g as (select distinct doc_id from labels where quality = 1), x as (select distinct doc_id from labels where toxic = 1),
f as (select part, len(ws) < 100 as a, 100 * len(list_distinct(ws)) < 80 * len(ws) as b, 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) as c,
  regexp_matches(text, '[#$%&*|]') as d, coalesce(doc_id > min(doc_id) over (partition by text), false) as e,
  cast(doc_id in (select doc_id from g) as int) as good, cast(doc_id in (select doc_id from x) as int) as toxic from d),
m as (select part, a::int + 2 * b::int + 4 * c::int + 8 * d::int + 16 * e::int as fails, count(*) as n, sum(coalesce(good, 0)) as good, sum(coalesce(toxic, 0)) as toxic from f group by all),
l as (select unnest(range(5)) as k),
p as (select [p1.k, p2.k, p3.k, p4.k, p5.k] as o from l p1, l p2, l p3, l p4, l p5 where len(list_distinct([p1.k, p2.k, p3.k, p4.k, p5.k])) = 5),
s as (select array_to_string(list_transform(o, lambda k: substr('ABCDE', k + 1, 1)), '') as filter_order, o, unnest(range(1, 6)) as step from p),
t as (select filter_order, step, o[step] as k, 1 << o[step] as own, coalesce(list_sum(list_transform(o[1:step - 1], lambda k: 1 << k)), 0)::int as before from s),
r as (select part, filter_order, step, k,
  sum(case when fails & (before | own) = 0 then n else 0 end) as kept,
  sum(case when fails & own != 0 and fails & before = 0 then n else 0 end) as removed,
  sum(case when fails & own != 0 and fails & before != 0 then n else 0 end) as redundant,
  sum(case when fails = own then n else 0 end) as unique_fails,
  sum(case when fails & own != 0 and fails & before = 0 then good else 0 end) as good_lost,
  sum(case when fails & own != 0 and fails & before = 0 then toxic else 0 end) as toxic_lost
  from m, t group by part, filter_order, step, k)
select part, filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant, unique_fails::bigint as unique_fails,
  good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost, (sum(removed) over (partition by part, k))::bigint as shapley from r"""


def _op12_sql() -> str:
    field = lambda c, t: f"coalesce(strlen(cast({c} as varchar)) || ':' || {t}, '-')"
    plain = " || ".join(field(c, f"cast({c} as varchar)") for c in ("doc_id", "source", "lang", "n_chars"))
    bits = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))"
    crc = f"xor(list_reduce(list_prepend(4294967295::ubigint, list_transform(string_split(cast(doc_id as varchar), ''), lambda y: ascii(y)::ubigint)), lambda c, b: {bits.replace(', 0', ', 0::ubigint')}), 4294967295::ubigint)"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
with recursive d as (select doc_id, source, sha256({plain} || {field("text", "text")}) as leaf,
  case when {crc} % 5 = 0 then sha256({plain} || {field("text", lower)}) end as changed from documents),
n as (select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as i from d),
tree as (
  select 0 as level, source, i, leaf as h, count(*) over (partition by source) as m from n
  union all
  select level + 1, source, i, h, count(*) over (partition by source) from (
    select level, source, i // 16 as i, sha256(string_agg(h, '' order by i)) as h from tree where m > 1 group by level, source, i // 16)),
subroots as (select source, h, row_number() over (order by source nulls first) - 1 as i from tree where m = 1),
upper as (
  select 0 as level, i, h, count(*) over () as m from subroots
  union all
  select level + 1, i, h, count(*) over () from (
    select level, i // 16 as i, sha256(string_agg(h, '' order by i)) as h from upper where m > 1 group by level, i // 16)),
runs as (select level, source, i // 16 as run, list(h order by i) as hs from tree where m > 1 group by level, source, i // 16),
upper_runs as (select level, i // 16 as run, list(h order by i) as hs from upper where m > 1 group by level, i // 16),
walk as (
  select 0 as level, doc_id, leaf, source, i as leaf_i, i, coalesce(changed, leaf) as h, '' as proof from n
  union all
  select w.level + 1, doc_id, leaf, w.source, leaf_i, i // 16, sha256(array_to_string(hs[1:i % 16], '') || h || array_to_string(hs[i % 16 + 2:], '')),
    proof || array_to_string(hs[1:i % 16], '') || array_to_string(hs[i % 16 + 2:], '')
  from walk w join runs r on r.level = w.level and r.source is not distinct from w.source and r.run = w.i // 16),
low as (select * from walk qualify row_number() over (partition by source, leaf_i order by level desc) = 1),
over_walk as (
  select 0 as level, doc_id, leaf, l.source, leaf_i, s.h as subroot, s.i, l.h, proof from low l join subroots s on s.source is not distinct from l.source
  union all
  select w.level + 1, doc_id, leaf, source, leaf_i, subroot, i // 16, sha256(array_to_string(hs[1:i % 16], '') || h || array_to_string(hs[i % 16 + 2:], '')),
    proof || array_to_string(hs[1:i % 16], '') || array_to_string(hs[i % 16 + 2:], '')
  from over_walk w join upper_runs r on r.level = w.level and r.run = w.i // 16),
ended as (select * from over_walk qualify row_number() over (partition by source, leaf_i order by level desc) = 1),
top as (select h as root from upper where m = 1)
select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, h as folded_root, h = root as verified from ended cross join top"""


def oracle_sql() -> dict[str, str]:
    return {"op11_filter_audit": _op11_sql(), "op12_merkle_manifest": _op12_sql(), "op6_chat_machine": _op6_sql(), "op8_weighted_urls": _op8_sql(), "op9_stupid_backoff": _op9_sql()}
