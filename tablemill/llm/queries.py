"""The operators applied to the whole of their tables, and the SQL of their results."""

from __future__ import annotations

import textwrap
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemill.llm import (
    contamination,
    conversation_repair,
    fast_similarity,
    license_scan,
    line_templates,
    projection_forest,
    quality_rules,
    repeated_passages,
    sentencepiece_codec,
    token_counts,
    toxicity,
    warc,
    whitening,
)
from tablemill.queries.base import Tables
from tablemill.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = textwrap.dedent(sql).strip()
        return build

    return register


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file installed beside Python."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_sentencepiece")
def op1(t: Tables) -> DataFrame:
    return sentencepiece_codec.codec_digests(t.documents, vocabulary("piece_bpe_32k.model"))


@query("op2_token_counts")
def op2(t: Tables) -> DataFrame:
    import public_tokenizers

    ranks = vocabulary("byte_bpe_50k.tiktoken")
    return token_counts.section_token_counts(t.documents, ranks, public_tokenizers.PATTERN)


@query(
    "op3_substring_dedup",
    r"""
    with words as (
        select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') w
        from documents
    ),
    windows as (
        select doc_id, i, array_to_string(w[i:i + 12], ' ') g
        from (select doc_id, w, unnest(range(1, len(w) - 11)) i from words where len(w) >= 13)
    ),
    hits as (
        select doc_id, i from (
            select doc_id, i, min(doc_id) over (partition by g) as first_doc from windows
        ) where first_doc < doc_id
    ),
    gone as (select distinct doc_id, unnest(range(i, i + 13)) p from hits),
    per_doc as (select doc_id, list(p) ps, count(*) n from gone group by doc_id)
    select w.doc_id, len(w)::bigint as n_words, coalesce(n, 0)::bigint as n_removed,
        sha256(array_to_string(
            list_filter(w, lambda x, i: not list_contains(coalesce(ps, []), i)), ' ')) as kept_sha256
    from words w left join per_doc p on w.doc_id = p.doc_id
    """,
)
def op3(t: Tables) -> DataFrame:
    found = repeated_passages.repeated_passages(t.documents)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op4_embedding_near_dedup")
def op4(t: Tables) -> DataFrame:
    return projection_forest.vector_links(t.embeddings)


@query("op5_line_dedup")
def op5(t: Tables) -> DataFrame:
    kept = line_templates.drop_recurring_lines(t.documents.select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query(
    "op6_warc",
    """
    with rows as (
        select page_id, coalesce(html, '') h, octet_length(encode(coalesce(html, ''))) n from pages
    ),
    digests as (select page_id, n, sha256(h) d from rows),
    firsts as (select d, min(page_id) f from digests where n >= 100 group by d)
    select page_id, n::bigint as payload_bytes, digests.d as payload_digest,
        case when n >= 100 and page_id <> f then 'revisit' else 'response' end as record_type,
        case when n >= 100 and page_id <> f then f end as refers_to
    from digests left join firsts on digests.d = firsts.d
    """,
)
def op6(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "archives")
    warc.write_warc(t.pages, path)
    return warc.archive_index(warc.read_warc(t.spark, path))


@query("op7_toxicity")
def op7(t: Tables) -> DataFrame:
    model = toxicity.train_toxicity(t.documents, t.labels)
    scored = toxicity.score_toxicity(t.documents, model)
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted")


@query("op8_minhash_near_dedup")
def op8(t: Tables) -> DataFrame:
    return fast_similarity.near_duplicates(t.documents)


@query("op9_license_scan")
def op9(t: Tables) -> DataFrame:
    path = F.concat_ws("/", F.lit(""), "source", "lang", F.col("doc_id").cast("string"))
    return license_scan.scan_licenses(t.documents.withColumn("path", path))


@query(
    "op10_benchmark_decontamination",
    r"""
    with d as (
        select doc_id, list_filter(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') w
        from documents
    ),
    b as (
        select item_id, list_filter(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') w
        from benchmark
    ),
    grams as (
        select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') g
        from (select item_id, w, n, unnest(range(1, len(w) - n + 2)) i
              from (select item_id, w, least(len(w), 10) n from b where len(w) > 0))
    ),
    starts as (
        select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') g
        from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) i
              from d, (select distinct n from grams) where len(w) >= n)
    ),
    hits as (select doc_id, s.n, i, item_id from starts s join grams g on s.n = g.n and s.g = g.g),
    places as (
        select doc_id, count(*) n_hit from (select distinct doc_id, unnest(range(i, i + n)) p from hits)
        group by doc_id
    ),
    items as (
        select doc_id, count(*) n_items, string_agg(item, ',' order by item) ids
        from (select distinct doc_id, item_id::varchar item from hits) group by doc_id
    )
    select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
        coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256,
        coalesce(n_hit, 0) > 0 as contaminated
    from d left join places p on d.doc_id = p.doc_id left join items i on d.doc_id = i.doc_id
    """,
)
def op10(t: Tables) -> DataFrame:
    found = contamination.contamination(t.documents, t.benchmark)
    return found.select(
        "doc_id",
        "n_words",
        F.size("hit_words").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"),
    )


@query(
    "op11_quality_rules",
    r"""
    with texts as (select row_number() over () r, doc_id, lang, source, coalesce(text, '') t from documents),
    words as (
        select r, doc_id, lang, source, t,
            list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') w,
            list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) l
        from texts
    ),
    windows as (
        select r, i, w[i] a, w[i + 1] b, w[i + 2] c
        from (select r, w, unnest(range(1, len(w) - 1)) i from words where len(w) >= 3)
    ),
    again as (select r, i from (select r, i, count(*) over (partition by r, a, b, c) n from windows) where n > 1),
    under as (select r, count(*) n from (select distinct r, unnest([i, i + 1, i + 2]) p from again) group by r),
    counts as (
        select words.r, doc_id, lang, source, len(w)::bigint as n_words,
            length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
            (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
            (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
            coalesce(n, 0)::bigint as n_repeat_words, len(l)::bigint as n_lines
        from words left join under on words.r = under.r
    ),
    judged as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counts),
    shares as (
        select lang, source, share, v from (
            select lang, source, unnest([
                {'share': 'word_length', 'v': 1000 * word_chars // n_words},
                {'share': 'symbols', 'v': 1000 * n_symbols // n_words},
                {'share': 'repeated', 'v': 1000 * n_repeat_words // n_words},
                {'share': 'equal_lines', 'v': 1000 * n_dup_lines // n_lines}], recursive := true)
            from judged where not base_failed)
    ),
    sketch as (
        select lang, source, share, (v >> s) << s as b, count(*) n
        from (select *, greatest(length(bin(v)) - 6, 0) s from shares) group by all
    ),
    levels as (
        select 3 as level, lang, source, share, b, n from sketch
        union all select 2, lang, null, share, b, sum(n) from sketch group by lang, share, b
        union all select 1, null, null, share, b, sum(n) from sketch group by share, b
    ),
    running as (
        select *, sum(n) over (partition by level, lang, source, share order by b) as below,
            sum(n) over (partition by level, lang, source, share) as total
        from levels
    ),
    quarters as (
        select level, lang, source, share, max(total) total,
            min(case when below * 4 >= total then b end) q1, min(case when below * 4 >= total * 2 then b end) q2,
            min(case when below * 4 >= total * 3 then b end) q3
        from running group by all
    ),
    fences as (
        select level, lang, source, share, total, q2 - 6 * greatest(q3 - q1, least_spread) low, q2 + 6 * greatest(q3 - q1, least_spread) high
        from quarters join (values ('word_length', 50), ('symbols', 10), ('repeated', 50), ('equal_lines', 75)) f(name, least_spread)
            on share = name
    ),
    limits as (
        select f.lang, f.source, f.share,
            case when f.total >= 100 then f.low when m.total >= 100 then m.low else c.low end low,
            case when f.total >= 100 then f.high when m.total >= 100 then m.high else c.high end high
        from fences f
            join fences m on m.level = 2 and f.share = m.share and f.lang is not distinct from m.lang
            join fences c on c.level = 1 and f.share = c.share
        where f.level = 3
    ),
    out as (
        select distinct r from (
            select r, n_words, n_lines, share, low, high, case share when 'word_length' then 1000 * word_chars // n_words
                when 'symbols' then 1000 * n_symbols // n_words when 'repeated' then 1000 * n_repeat_words // n_words
                else 1000 * n_dup_lines // n_lines end v
            from judged j join limits l on j.lang is not distinct from l.lang and j.source is not distinct from l.source
            where not base_failed
        ) where v < low or v > high
    )
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        not base_failed and out.r is null as kept
    from judged left join out on judged.r = out.r
    """,
)
def op11(t: Tables) -> DataFrame:
    return quality_rules.judge_quality(t.documents)


@query("op12_embedding_whitening")
def op12(t: Tables) -> DataFrame:
    return whitening.whiten(t.embeddings)


@query(
    "op13_conversation_repair",
    r"""
    with recursive keyed as (
        select conv_id, turn, coalesce(role, ' ') role, coalesce(text, ' ') text,
            coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') k
        from conversations
    ),
    dealt as (
        select *, xor(4294967295, list_reduce(
            list_prepend(4294967295, flatten(list_transform(string_split(k, ''),
                lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
            lambda a, b: case when b >= 0 then xor(a, b) when a % 2 = 1 then xor(a >> 1, 3988292384) else a >> 1 end)) % 20 deal
        from keyed
    ),
    damaged as (
        select conv_id, turn, case when deal = 4 then 'user' else role end role,
            case deal when 1 then '' when 2 then translate(text, '.!?', '') else text end text
        from dealt, generate_series(1, case when deal = 3 then 2 else 1 end) where deal <> 0
    ),
    placed as (
        select *, row_number() over (partition by conv_id order by turn nulls first, role, text) i,
            lag(role) over (partition by conv_id order by turn nulls first, role, text) role_before
        from damaged
    ),
    faulty as (
        select conv_id, turn, role, text, i, left(role, 1) ini,
            not regexp_matches(text, '[^\x20\x09-\x0D]') blank,
            row_number() over (partition by conv_id, role, text order by i) > 1 again,
            not regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') cut,
            i > 1 and left(role_before, 1) || left(role, 1) not in ('su', 'ua', 'au') illegal
        from placed
    ),
    rows as (
        select *, blank or again as must, case when cut and not blank and not again then 5 else 0 end fee from faulty
    ),
    -- States: z at the start, s after the system, u and a after a role. Each holds the cheapest
    -- {cost, audit}; equal costs are decided by the audit.
    steps as (
        select conv_id, 1::bigint i, {'c': 0, 'w': ''} z, {'c': 100000000, 'w': 'Z'} s, {'c': 100000000, 'w': 'Z'} u, {'c': 100000000, 'w': 'Z'} a
        from (select distinct conv_id from rows)
        union all
        select p.conv_id, p.i + 1, {'c': z.c + 2, 'w': z.w || 'D'},
            case when must or ini <> 's' then {'c': s.c + 2, 'w': s.w || 'D'}
                else least({'c': s.c + 2, 'w': s.w || 'D'}, {'c': z.c + fee, 'w': z.w || 'K'}) end,
            case when must then {'c': u.c + 2, 'w': u.w || 'D'} else least({'c': u.c + 2, 'w': u.w || 'D'},
                least({'c': fz.c + fee + case when ini = 'u' then 0 else 1 end, 'w': fz.w || case when ini = 'u' then 'K' else 'R' end})) end,
            case when must then {'c': a.c + 2, 'w': a.w || 'D'} else least({'c': a.c + 2, 'w': a.w || 'D'},
                {'c': fu.c + fee + case when ini = 'a' then 0 else 1 end, 'w': fu.w || case when ini = 'a' then 'K' else 'R' end}) end
        from (
            select *, least(z, s, a, {'c': u.c + 5, 'w': u.w || 'I'}) fz,
                least(u, {'c': least(z, s, a).c + 5, 'w': least(z, s, a).w || 'I'}) fu
            from steps
        ) p join rows on p.conv_id is not distinct from rows.conv_id and p.i = rows.i
    ),
    ends as (
        select conv_id, least(z, a, {'c': u.c + 5, 'w': u.w || 'I'}, {'c': s.c + 10, 'w': s.w || 'II'}) best
        from steps qualify row_number() over (partition by conv_id order by i desc) = 1
    ),
    letters as (
        select conv_id, p, w[p] l, length(regexp_replace(w[:p], 'I', '', 'g')) i,
            length(regexp_replace(w[:p], 'D', '', 'g')) place, starts
        from (select conv_id, best.w w, unnest(range(1, length(best.w) + 1)) p,
            regexp_matches(best.w, '^D*K') starts from ends)
    ),
    first_kept as (
        select letters.conv_id, ini = 's' as system from letters join rows
            on letters.conv_id is not distinct from rows.conv_id and letters.i = rows.i
        where l = 'K' and place = 1
    ),
    said as (
        select letters.conv_id, p, case l when 'K' then role else case when (place - coalesce(system, false)::int) % 2 = 1
            then 'user' else 'assistant' end end || ':' || case l when 'I' then '' else text end as line
        from letters left join first_kept on letters.conv_id is not distinct from first_kept.conv_id
            left join rows on l <> 'I' and letters.conv_id is not distinct from rows.conv_id and letters.i = rows.i
        where l <> 'D'
    ),
    repaired as (select conv_id, string_agg(line, chr(10) order by p) whole from said group by conv_id),
    facts as (
        select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) gaps, count(*) filter (where blank) blank,
            count(*) filter (where again and not blank) duplicate, count(*) filter (where fee > 0) truncated,
            count(*) filter (where illegal) illegal
        from rows group by conv_id
    )
    select o.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
        coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(best.c, 0)::bigint as cost,
        coalesce(best.w, '') as audit, sha256(coalesce(whole, '')) as repaired_sha256
    from (select distinct conv_id from conversations) o
        left join facts f on o.conv_id is not distinct from f.conv_id
        left join ends e on o.conv_id is not distinct from e.conv_id
        left join repaired r on o.conv_id is not distinct from r.conv_id
    """,
)
def op13(t: Tables) -> DataFrame:
    damaged = conversation_repair.damage(t.conversations)
    repaired = conversation_repair.repair_conversations(damaged, copies_column="copies")
    return conversation_repair.conversation_digests(repaired)
