"""Queries of the corpus operators, with SQL where SQL gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkhunt.llm import chat_format, collocations, decontaminate, exact_dedup, html_templates, lsh_forest, merkle, mixing, pu_toxicity, suffix_repeats, token_counts, warc, wavelet
from sparkhunt.llm.common import table
from sparkhunt.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
TOKENIZER = "byte_bpe_50k.json"


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            # texts may be long: what goes to Python at once stays small
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
            return fn(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


@query(
    "op1_warc_bundles",
    """
    with p as (select page_id, coalesce(html, '') h, octet_length(encode(coalesce(html, ''))) n, sha256(coalesce(html, '')) d from pages),
    g as (select d, min(page_id) f from p where n >= 100 group by d)
    select page_id, n::bigint payload_bytes, p.d payload_digest, case when page_id > f then 'revisit' else 'response' end record_type,
      case when page_id > f then f end refers_to
    from p left join g on p.d = g.d
    """,
)
def op1(spark, folder):
    bundles = scratch_path(spark, "warc")
    warc.write_bundles(table(spark, folder, "pages"), bundles)
    return warc.read_bundles(spark, bundles).select(
        F.col("key").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("bigint").alias("refers_to")
    )


@query("op2_pu_toxicity")
def op2(spark, folder):
    docs = table(spark, folder, "documents")
    scored = pu_toxicity.score(docs.select("doc_id", "text"), pu_toxicity.fit(docs, table(spark, folder, "labels")))
    return scored.select("doc_id", pu_toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query(
    "op3_exact_dedup",
    """
    select doc_id, max(doc_id) over (partition by coalesce(text, '')) keep_id, count(*) over (partition by coalesce(text, '')) group_size,
      doc_id = max(doc_id) over (partition by coalesce(text, '')) kept, sha256(coalesce(text, '')) text_sha256
    from documents
    """,
)
def op3(spark, folder):
    index = exact_dedup.DigestIndex(spark, scratch_path(spark, "digest-index"))
    return index.ingest(table(spark, folder, "documents"))


@query(
    "op4_decontaminate",
    """
    with d as (select doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') w from documents),
    i as (select item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') w from benchmark),
    ds as (select doc_id, p, array_to_string(w[p:p + 4], ' ') s from (select doc_id, w, unnest(range(1, len(w) - 3)) p from d)),
    js as (select item_id, len(w) n, p, array_to_string(w[p:p + 4], ' ') s from (select item_id, w, unnest(range(1, len(w) - 3)) p from i)),
    wins as (  -- every window of the item's size that shares a shingle with it
      select distinct doc_id, item_id, st, n from (select doc_id, item_id, n, unnest(range(greatest(ds.p - n + 4, 0), ds.p)) st from ds join (select distinct item_id, n, s from js) using (s))
    ),
    a as (select wins.doc_id, item_id, st, ds.s, count(*) k from wins join ds on wins.doc_id = ds.doc_id and ds.p between st + 1 and st + n - 4 group by all),
    b as (select item_id, s, count(*) k from js group by all),
    x as (select a.doc_id, a.item_id, a.st, sum(least(a.k, b.k)) m from a join b on a.item_id = b.item_id and a.s = b.s group by all),
    na as (select doc_id, item_id, st, sum(k) n from a group by all), nb as (select item_id, sum(k) n from b group by all),
    r as (select x.doc_id, x.item_id, x.st, x.m / (na.n + nb.n - x.m) similarity from x join na using (doc_id, item_id, st) join nb on nb.item_id = x.item_id)
    select doc_id, item_id, arg_min(st, (-similarity, st))::int start_word, max(similarity) similarity from r where similarity >= 0.8 group by doc_id, item_id
    """,
)
def op4(spark, folder):
    found = decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), F.col("start_word").cast("int").alias("start_word"), "similarity")


@query("op5_token_counts")
def op5(spark, folder):
    docs = table(spark, folder, "documents")
    return token_counts.attribute_tokens(docs, token_counts.line_sizes(F.col("text")), public_tokenizers.path(TOKENIZER))


@query("op6_mixing")
def op6(spark, folder):
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "mix.size", "mix.source_size", "mix.target", (F.col("mix.size") * F.size("mix.draws")).alias("taken"))


@query(
    "op7_chat_format",
    r"""
    with t as (select conv_id, turn, role, coalesce(text, '') text from conversations
      union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok')
    select conv_id, count(*) n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) turns_sha256,
      coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint loss_chars,
      sha256(coalesce(string_agg(text, '' order by turn) filter (where role = 'assistant'), '')) loss_sha256,
      sum(length('### ' || role || ': ' || replace(replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>'), '<|', '\<|') || '</turn>' || chr(10)))::bigint formatted_chars
    from t group by conv_id
    """,
)
def op7(spark, folder):
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    formatted = scratch_path(spark, "chat")
    chat_format.format_turns(turns.unionByName(own)).write.parquet(formatted)
    return chat_format.conversation_digests(spark.read.parquet(formatted))


@query("op8_jaccard_forest")
def op8(spark, folder):
    return lsh_forest.jaccard_join(table(spark, folder, "documents"))


@query("op9_token_shards")
def op9(spark, folder):
    shards = scratch_path(spark, "tokens")
    wavelet.write_tokens(table(spark, folder, "documents"), shards, public_tokenizers.path(TOKENIZER))
    return wavelet.read_tokens(spark, shards)


@query("op10_html_templates")
def op10(spark, folder):
    return html_templates.extract_main_text(table(spark, folder, "pages"))


@query(
    "op11_merkle_manifest",
    """
    with recursive crc as (  -- CRC-32 of the decimal doc_id, a byte a step, bit by bit
      select doc_id, doc_id::varchar s, 1 i, 4294967295::bigint h from (select distinct doc_id from documents where doc_id is not null)
      union all
      select doc_id, s, i + 1, list_reduce([xor(h, ascii(s[i]))::bigint] || list_transform(range(8), lambda x: 0::bigint), lambda a, b: case when a % 2 = 1 then xor(a // 2, 3988292384) else a // 2 end)
      from crc where i <= length(s)
    ),
    forged as (select doc_id from crc where i = length(s) + 1 and xor(h, 4294967295) % 3 = 0),
    f as (
      select d.doc_id, lang, [d.doc_id::varchar, source, lang, n_chars::varchar, text] v,
        [d.doc_id::varchar, source, lang, n_chars::varchar, case when forged.doc_id is null then text else translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') end] w
      from documents d left join forged on d.doc_id = forged.doc_id
    ),
    leaves as (
      select doc_id, lang,
        sha256(array_to_string(list_transform(v, lambda x: coalesce(octet_length(encode(x)) || ':' || x, '-')), '')) leaf,
        sha256(array_to_string(list_transform(w, lambda x: coalesce(octet_length(encode(x)) || ':' || x, '-')), '')) start
      from f
    ),
    placed as (select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 spot from leaves),
    trees as (  -- per lang all digests of a level as one list
      select lang, 0 level, list(leaf order by spot) d from placed group by lang
      union all
      select lang, level + 1, list_transform(range(0, len(d), 8), lambda i: sha256(array_to_string(d[i + 1:i + 8], ''))) from trees where len(d) > 1
    ),
    subroots as (select lang, d[1] subroot, row_number() over (order by lang nulls first) - 1 number from trees where len(d) = 1),
    tops as (
      select 0 level, list(subroot order by number) d from subroots
      union all
      select level + 1, list_transform(range(0, len(d), 8), lambda i: sha256(array_to_string(d[i + 1:i + 8], ''))) from tops where len(d) > 1
    ),
    nodes as (
      select s.number, level, d, 0 part from trees t join subroots s on t.lang is not distinct from s.lang where len(d) > 1
      union all select s.number, 1000 + level, d, 1 from tops, subroots s where len(d) > 1
    ),
    stages as (select *, row_number() over (partition by number order by level) step from nodes),
    climb as (
      select p.doc_id, p.lang, p.leaf, s.number, p.spot, p.start held, '' proof, 1 step from placed p join subroots s on p.lang is not distinct from s.lang
      union all
      select doc_id, lang, leaf, c.number, pos // 8,
        sha256(array_to_string(d[pos // 8 * 8 + 1:pos], '') || held || array_to_string(d[pos + 2:pos // 8 * 8 + 8], '')),
        proof || array_to_string(d[pos // 8 * 8 + 1:pos], '') || array_to_string(d[pos + 2:pos // 8 * 8 + 8], ''), c.step + 1
      from (select c.*, s.d, case when s.level = 1000 then c.number else c.spot end pos from climb c join stages s on s.number = c.number and s.step = c.step) c
    ),
    ends as (select c.* from climb c join (select number, max(step) + 1 last from stages group by number) e on c.number = e.number and c.step = e.last
             union all select c.* from climb c where not exists (select 1 from stages s where s.number = c.number)),
    root as (select d[1] root from tops where len(d) = 1)
    select doc_id, leaf, subroot, root, sha256(proof) proof_sha256, held folded_root, held = root verified
    from ends join subroots using (number), root
    """,
)
def op11(spark, folder):
    forged = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return merkle.verify(table(spark, folder, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], {"text": lowered}, forged)


@query(
    "op12_collocations",
    r"""
    with p as (
      select coalesce(lang, 'und') lang, doc_id, row_number() over () piece,
        list_filter(regexp_split_to_array(s, '[ \t]+'), lambda x: x <> '') w
      from (select lang, doc_id, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) s from documents)
    ),
    sizes as (select lang, sum(len(w))::bigint n from p group by lang),
    f as (
      select lang, array_to_string(w[i:i + k - 1], ' ') phrase, k, count(*) f
      from (select lang, w, k, unnest(range(1, len(w) - k + 2)) i from p, (select unnest(range(1, 6)) k)) group by all having count(*) >= 100
    ),
    cand as (select lang, phrase, k, f a, string_split(phrase, ' ') w from f where k > 1),
    cuts as (select *, array_to_string(w[1:c], ' ') head, array_to_string(w[c + 1:], ' ') tail from (select *, unnest(range(1, k)) c from cand)),
    scored as (
      select cuts.lang, cuts.phrase, a, cuts.k, c, h.f l, t.f r, n, ((1000::hugeint * a * n) // (h.f::hugeint * t.f))::bigint score
      from cuts join f h on h.lang = cuts.lang and h.phrase = head join f t on t.lang = cuts.lang and t.phrase = tail join sizes on sizes.lang = cuts.lang
    ),
    lowest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, c) = 1),
    longer as (
      select lang, array_to_string(w[i:i + m - 1], ' ') phrase, max(a) longest
      from (select *, unnest(range(1, k - m + 2)) i from (select *, unnest(range(2, k)) m from cand)) group by all
    ),
    kept as (select lowest.* from lowest left join longer using (lang, phrase) where longest is null or longest < a)
    select lang, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) "rank", phrase, a, l, r, n, score
    from kept qualify "rank" <= 2000
    """,
)
def op12(spark, folder):
    return collocations.collocations(table(spark, folder, "documents"))


@query(
    "op13_suffix_repeats",
    """
    with d as (select doc_id, encode(coalesce(text, '')) b, octet_length(encode(coalesce(text, ''))) n from documents),
    later as (
      select doc_id, p from (select doc_id, p, b[p + 1:p + 100] s from (select *, unnest(range(0, n - 99)) p from d))
      qualify row_number() over (partition by s order by doc_id, p) > 1
    ),
    steps as (select *, case when p - lag(p) over (partition by doc_id order by p) <= 100 then 0 else 1 end new from later),
    runs as (select doc_id, min(p) a, max(p) + 100 z from (select *, sum(new) over (partition by doc_id order by p) run from steps) group by doc_id, run),
    spans as (select doc_id, count(*) n_spans, sum(z - a) n_removed from runs group by doc_id),
    parts as (
      select doc_id, z a, lead(a) over (partition by doc_id order by a) z from (select doc_id, a, z from runs union all select doc_id, -1, 0 from d)
    ),
    kept as (select doc_id, string_agg(hex(b[parts.a + 1:coalesce(parts.z, n)]), '' order by parts.a) h from parts join d using (doc_id) where parts.a < coalesce(parts.z, n) group by doc_id)
    select d.doc_id, n n_bytes, coalesce(n_removed, 0)::bigint n_removed, coalesce(n_spans, 0) n_spans, sha256(unhex(coalesce(h, ''))) kept_sha256
    from d left join spans using (doc_id) left join kept using (doc_id)
    """,
)
def op13(spark, folder):
    cleaned = suffix_repeats.remove_repeats(table(spark, folder, "documents"))
    removed = (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed")
    spans = F.coalesce(F.size("spans"), F.lit(0)).cast("bigint").alias("n_spans")
    return cleaned.select("doc_id", "n_bytes", removed, spans, F.sha2("kept", 256).alias("kept_sha256"))
