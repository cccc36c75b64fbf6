"""Registered queries of the text operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridsieve.llm import (
    alignment,
    boilerplate,
    chat,
    chunks,
    dac,
    decontam,
    licenses,
    merkle,
    pieces,
    resample,
    simhash,
    surrogates,
    urlfilter,
)

# Two rows of every run of op9_chat besides the table: the escapes have to survive in both roles.
_PROBE = r"\### Assistant: </turn> ok"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boilerplate.extract(table(spark, sf_dir, "pages"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.exact_duplicates(table(spark, sf_dir, "documents"))


def op7_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.anonymise(table(spark, sf_dir, "documents"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dac.document_ids(dac.kept_files(table(spark, sf_dir, "documents")))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(
        [(-7, 0, "user", _PROBE), (-7, 1, "assistant", _PROBE)],
        "conv_id long, turn long, role string, text string",
    )
    done = chat.format_conversations(turns.unionByName(probe))
    lines = F.transform("parsed", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    lossy = done.withColumn("loss", chat.masked_text(F.col("formatted"), F.col("loss_mask")))
    return lossy.select(
        "conv_id",
        F.size("parsed").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_code(F.col("code")).alias("fingerprint"), "component_id")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return urlfilter.judge(pages, urlfilter.rule_table(spark), urlfilter.named_hosts(pages))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_decontamination": op2_decontamination,
    "op3_quality": op3_quality,
    "op4_pieces": op4_pieces,
    "op5_main_text": op5_main_text,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_surrogates": op7_surrogates,
    "op8_token_files": op8_token_files,
    "op9_chat": op9_chat,
    "op10_simhash": op10_simhash,
    "op11_merkle": op11_merkle,
    "op12_alignment": op12_alignment,
    "op13_url_filter": op13_url_filter,
}

ORACLES: dict[str, str] = {
    "op6_exact_dedup": """
        select doc_id,
               max(doc_id) over same as keep_id,
               count(*) over same as group_size,
               doc_id = max(doc_id) over same as kept,
               sha256(coalesce(text, '')) as text_sha256
        from documents
        window same as (partition by coalesce(text, ''))
    """,
    "op9_chat": r"""
        with turns as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
            from conversations
            union all
            select -7, t, r, '\### Assistant: </turn> ok'
            from (values (0, 'user'), (1, 'assistant')) as probe(t, r)
        ), marked as (
            select *,
                   case when role in ('system', 'user', 'assistant', 'tool') then length(role)
                        else 1 + length(url_encode(role)) end as label_chars,
                   length(regexp_replace(text,
                       '(\\*)(### (?:System|User|Assistant|Tool|@[\w.*+%-]*): |</turn>)',
                       '\\\1\2', 'g')) as body_chars
            from turns
        )
        select conv_id,
               count(*) as n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
               coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
               sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
               sum(4 + label_chars + 2 + body_chars + 9)::bigint as formatted_chars
        from marked
        group by conv_id
    """,
    "op11_merkle": """
        with recursive rows as (
            select doc_id, source, text,
                   coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-')
                   || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-')
                   || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') as head,
                   xor(4294967295, list_reduce(
                       list_prepend(4294967295::bigint,
                           list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
                       lambda crc, byte: list_reduce(
                           list_prepend(xor(crc, byte), range(8)),
                           lambda x, i: xor(x >> 1, (x & 1) * 3988292384)))) as crc
            from documents
        ), leaves as (
            select doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
                   sha256(head || coalesce(strlen(text) || ':' || case when crc % 5 = 0
                       then translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                       else text end, '-')) as seen
            from rows
        ), placed as (
            select *, coalesce('=' || source, '') as tree,
                   row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as spot
            from leaves
        ), lower(level, tree, spot, node, n) as (
            select 0, tree, spot, leaf, count(*) over (partition by tree) from placed
            union all
            select any_value(level) + 1, tree, spot // 16, sha256(string_agg(node, '' order by spot)), (any_value(n) + 15) // 16
            from lower where n > 1 group by tree, spot // 16
        ), subroots as (
            select tree, node as subroot, level as height, row_number() over (order by encode(tree)) - 1 as rank
            from lower where n = 1
        ), upper(level, spot, node, n) as (
            select 0, rank, subroot, count(*) over () from subroots
            union all
            select any_value(level) + 1, spot // 16, sha256(string_agg(node, '' order by spot)), (any_value(n) + 15) // 16
            from upper where n > 1 group by spot // 16
        ), runs as (
            select tree, level, spot // 16 as run, list(node order by spot) as nodes from lower where n > 1 group by all
            union all
            select 'upper', level, spot // 16, list(node order by spot) from upper where n > 1 group by all
        ), steps as (
            -- one row for each document and level: its run and its place there
            select p.doc_id, p.leaf, p.spot as place, p.tree, r.level as step,
                   (p.spot // (16 ** r.level)::bigint) % 16 as k, r.nodes
            from placed p join runs r on r.tree = p.tree and r.run = p.spot // (16 ** (r.level + 1))::bigint
            union all
            select p.doc_id, p.leaf, p.spot, p.tree, s.height + r.level,
                   (s.rank // (16 ** r.level)::bigint) % 16, r.nodes
            from placed p join subroots s on s.tree = p.tree
            join runs r on r.tree = 'upper' and r.run = s.rank // (16 ** (r.level + 1))::bigint
        ), proofs as (
            select tree, place,
                   string_agg(array_to_string(nodes[:k] || nodes[k + 2:], ''), '' order by step) as proof
            from steps group by all
        ), folded(tree, place, step, node) as (
            select tree, spot, 0, seen from placed
            union all
            select f.tree, f.place, f.step + 1, sha256(array_to_string(s.nodes[:s.k] || [f.node] || s.nodes[s.k + 2:], ''))
            from folded f join steps s on s.tree = f.tree and s.place = f.place and s.step = f.step
        )
        select p.doc_id, p.source, p.leaf, s.subroot, u.node as root,
               sha256(coalesce(q.proof, '')) as proof_sha256, f.node as folded_root, f.node = u.node as verified
        from placed p
        join subroots s on s.tree = p.tree
        cross join (select node from upper where n = 1) u
        left join proofs q on q.tree = p.tree and q.place = p.spot
        join (select tree, place, arg_max(node, step) as node from folded group by all) f
          on f.tree = p.tree and f.place = p.spot
    """,
    "op13_url_filter": """
        with rests as (
            select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
            from pages
        ), parts as (
            select page_id,
                   translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                   regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) as path
            from rests
        ), ruled as (
            select *,
                   case when ('.' || host) like '%.example.net' and path like '/en/%' then 'example.net/en/'
                        when ('.' || host) like '%.example.com' and path like '/de/%' then 'example.com/de/'
                        when ('.' || host) like '%.org' and path like '/fr/%' then 'org/fr/'
                        when ('.' || host) like '%.net' and path like '/%' then 'net/' end as rule,
                   regexp_matches(host, '(^|[.\\-0-9])(adult|bets|casino|cheap|escort|gambling|pills|poker|porn|spam|viagra|xxx)([.\\-0-9]|$)') as named
            from parts
        )
        select page_id, host, path, rule,
               case when rule in ('net/', 'example.com/de/') then 'block' when rule is not null then 'allow'
                    when l.host_listed is not null then 'block' else 'allow' end as verdict,
               l.host_listed as listed
        from ruled r
        left join lateral (
            select max(host) as host_listed from (
                select distinct n.host from ruled n where n.named
            ) n where r.host = n.host
        ) l on true
    """,
}
