"""The registered ``opN_<name>`` queries: each applies its operator to the
whole of its table and derives the digest columns from what it returns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.llm.common import stored, table
from tickwise.llm.decontaminate import contamination, is_contaminated
from tickwise.llm.extract import extract
from tickwise.llm.lexical import search
from tickwise.llm.near import near_classes
from tickwise.llm.packing import pack
from tickwise.llm.periodic import find_runs
from tickwise.llm.pii import KINDS, all_spans, find_personal, joined
from tickwise.llm.quality import BASE, CURRENT, POLICIES, RULES, apply_policy, bits, ledger
from tickwise.llm.sharding import assign_shards
from tickwise.llm.stars import near_components
from tickwise.llm.toxicity import score, train
from tickwise.llm.url_filter import LISTED_LABELS, judge_by_list, key_universe
from tickwise.llm.warc import assemble, read_records, resolve, write_archives
from tickwise.session import scratch_path

TOKENIZER = "word_bpe_49k.json"


def q_op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def q_op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


def q_op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = assign_shards(table(spark, sf_dir, "documents"), n_shards=16)
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def q_op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = extract(table(spark, sf_dir, "pages"))
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_covered", "n_restored")


def q_op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = find_personal(table(spark, sf_dir, "documents")).withColumn("every", all_spans())
    count = lambda kind: F.size(F.filter("plain", lambda s: s["kind"] == kind)).cast("long")
    return rows.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(joined("plain").cast("binary"), 256).alias("base_sha256"),
        joined("every").alias("spans"),
    )


def q_op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    path = scratch_path(spark, "warc")
    write_archives(pages, path)
    # the query needs sizes and digests of payloads, not the payloads
    captures = stored(assemble(read_records(spark, path, with_payload=False)), "captures")
    rows = resolve(captures)
    return rows.select(
        F.col("metadata.capture_key").cast("long").alias("page_id"),
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        F.col("original").cast("long").alias("refers_to"),
    )


def q_op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    keys = key_universe(pages)
    first_label = F.element_at(F.split("key", r"\."), 1)
    rows = judge_by_list(pages, keys.withColumn("listed", first_label.isin(*LISTED_LABELS)))
    return rows.select("page_id", "host", "path", "rule", "verdict")


def q_op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))


def q_op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = apply_policy(ledger(table(spark, sf_dir, "documents")))
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (F.col("failures").bitwiseAND(F.lit(bits(BASE))) != 0).alias("base_failed"),
        "kept",
        "failures",
    )


def q_op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def q_op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_components(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_shingles", "component_id", F.expr("doc_id <=> component_id").alias("kept"))


def q_op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def looped(docs: DataFrame) -> DataFrame:
    """``doc_id, text``; a tenth of the documents, by the checksum of the id,
    repeats a stretch of words from some word on, as a stuck generator does."""
    words = r"regexp_extract_all(text, '([^\\x20\\x09-\\x0D]+)', 1)"
    return docs.selectExpr("doc_id", "cast(text as string) as text", "crc32(cast(cast(doc_id as string) as binary)) as h").selectExpr(
        "doc_id",
        f"""if(h % 10 = 0 and size({words}) > 0,
            transform(array({words}), w -> transform(array(h div 10 % size(w)), a ->
                transform(array(1 + (size(w) - a) div (3 + h div 10 % 8)), p ->
                    array_join(concat(
                        slice(w, 1, int(a)),
                        slice(flatten(array_repeat(slice(w, int(a) + 1, int(p)), int((size(w) - a + p - 1) div p))), 1, int(size(w) - a))
                    ), ' '))[0])[0])[0],
            text) as text""",
    )


def q_op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = find_runs(looped(table(spark, sf_dir, "documents")))
    top = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"], r["period"])))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return (
        rows.withColumn("top", top)
        .select(
            "doc_id",
            F.size("runs").cast("long").alias("n_runs"),
            F.col("top.start").alias("start"),
            (-F.col("top.l")).alias("length"),
            F.col("top.period").alias("period"),
            F.expr("-1000 * top.l div top.period").alias("exponent_milli"),
            F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
            F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        )
    )


QUERIES = {
    "op1_packing": q_op1_packing,
    "op2_decontamination": q_op2_decontamination,
    "op3_sharding": q_op3_sharding,
    "op4_html_extraction": q_op4_html_extraction,
    "op5_pii": q_op5_pii,
    "op6_warc": q_op6_warc,
    "op7_url_filters": q_op7_url_filters,
    "op8_toxicity": q_op8_toxicity,
    "op9_quality_rules": q_op9_quality_rules,
    "op10_jaccard_join": q_op10_jaccard_join,
    "op11_minhash_near_dedup": q_op11_minhash_near_dedup,
    "op12_lexical_search": q_op12_lexical_search,
    "op13_periodic_runs": q_op13_periodic_runs,
}

_LABELS = ", ".join(f"'{x}'" for x in LISTED_LABELS)

# Words of a text by the decontamination contract.
_WORDS = (
    "regexp_extract_all(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    " '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

ORACLES: dict[str, str] = {
    "op2_decontamination": f"""
with docs as (
    select row_number() over () as rid, doc_id, {_WORDS.format("text")} as w from documents
), items as (
    select item_id, w, least(13, len(w)) as n
    from (select item_id, {_WORDS.format("text")} as w from benchmark) where len(w) > 0
), item_windows as (
    select distinct item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') as win
    from (select item_id, w, n, unnest(range(1, len(w) - n + 2)) as i from items)
), lengths as (
    select distinct n from items
), doc_windows as (
    select rid, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') as win
    from (select rid, w, n, unnest(range(1, greatest(len(w) - n + 2, 1))) as i from docs, lengths)
), hits as (
    select rid, i, n, win from doc_windows where win in (select win from item_windows)
), words_hit as (
    select rid, count(distinct p) as n_hit from (select rid, unnest(range(i, i + n)) as p from hits) group by rid
), listed as (
    select rid, count(*) as n_items, string_agg(id, ',' order by id) as ids
    from (select distinct h.rid, w.item_id::varchar as id from hits h join item_windows w using (win)) group by rid
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
    coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256,
    coalesce(n_hit, 0) > 0 and 20 * n_hit >= len(w) as contaminated
from docs left join words_hit using (rid) left join listed using (rid)
""",
    "op6_warc": """
with digests as (
    select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages
), firsts as (
    select *, min(page_id) over (partition by payload_digest) as first_id from digests
)
select page_id, payload_bytes, payload_digest,
    case when payload_bytes >= 100 and first_id is not null and page_id is distinct from first_id
        then 'revisit' else 'response' end as record_type,
    case when payload_bytes >= 100 and page_id is distinct from first_id then first_id end as refers_to
from firsts
""",
    "op7_url_filters": f"""
with cut as (
    select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) end as rest from pages
), parts as (
    select page_id,
        coalesce(translate(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
        coalesce(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2), '') as path
    from cut
), ruled as (
    select *, case
        when (host = 'example.net' or ends_with(host, '.example.net')) and starts_with(path, '/en/') then 'example.net/en/'
        when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/de/') then 'example.com/de/'
        when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/fr/') then 'org/fr/'
        when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/') then 'net/'
    end as rule
    from parts
)
select page_id, host, path, rule,
    case when rule in ('net/', 'example.com/de/') then 'block'
        when rule is not null then 'allow'
        when list_has_any(string_split(host, '.'), [{_LABELS}]) then 'block'
        else 'allow' end as verdict
from ruled
""",
    "op9_quality_rules": f"""
with texts as (
    select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents
), split_ as (
    select rid, doc_id, t,
        list_filter(regexp_split_to_array(t, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') as w,
        string_split(t, chr(10)) as lines
    from texts
), grams as (
    select rid, i, w[i] as a, w[i + 1] as b, w[i + 2] as c
    from (select rid, w, unnest(range(1, greatest(len(w) - 1, 1))) as i from split_)
), again as (
    select rid, i from (select rid, i, count(*) over (partition by rid, a, b, c) as n from grams) where n > 1
), covered as (
    select rid, count(distinct p) as n from (select rid, unnest([i, i + 1, i + 2]) as p from again) group by rid
), measured as (
    select s.doc_id,
        len(w)::bigint as n_words,
        length(regexp_replace(t, '[ \\t\\n\\x0B\\f\\r]', '', 'g'))::bigint as word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
        length(regexp_replace(t, '[^!]', '', 'g'))::bigint as n_exclamations,
        len(lines)::bigint as n_lines,
        (len(full_) - len(list_distinct(full_)))::bigint as n_dup_lines,
        coalesce(v.n, 0)::bigint as n_repeat_words
    from (select *, list_filter(lines, lambda x: regexp_matches(x, '[^ \\t\\n\\x0B\\f\\r]')) as full_ from split_) s
    left join covered v on v.rid = s.rid
), judged as (
    select *, {" | ".join(f"(case when {r} then {1 << i} else 0 end)" for i, r in enumerate(RULES.values()))} as failures
    from measured
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    (failures & {bits(BASE)}) <> 0 as base_failed,
    (failures & {bits(POLICIES[CURRENT])}) = 0 as kept,
    failures
from judged
""",
    "op12_lexical_search": f"""
with held as (
    select row_number() over () as rid, doc_id, {_WORDS.format("text")} as w from documents
), corpus as (
    select count(*) filter (len(w) > 0)::bigint as docs, sum(len(w))::bigint as terms from held
), asked as (
    select row_number() over () as qid, item_id, {_WORDS.format("text")} as w from benchmark
), query as (
    select qid, t, count(*)::bigint as qtf from (select qid, unnest(w) as t from asked) group by all
), postings as (
    select rid, t, n, count(*)::bigint as tf from (select rid, len(w)::bigint as n, unnest(w) as t from held)
    where t in (select t from query) group by all
), weights as (
    select t, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w
    from postings, corpus group by t, docs
), scored as (
    select qid, rid, sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))))::bigint as score
    from query join postings using (t) join weights using (t), corpus group by all
), ranked as (
    select item_id, row_number() over (partition by qid order by score desc, doc_id, rid)::int as rank, doc_id, score
    from scored join held using (rid) join asked using (qid) where score > 0
)
select item_id, rank, doc_id, score from ranked where rank <= 10
""",
}
