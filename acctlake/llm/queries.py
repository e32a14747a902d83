"""The operators with production parameters over their whole tables, and SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctlake.llm import (
    chat_format,
    conversation_trie,
    decontaminate,
    html_text,
    language,
    line_dedup,
    mixing,
    nearest,
    pii,
    simhash,
    toxicity,
    warc,
    whitening,
)
from acctlake.llm.common import stage, table


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.where(~language.held_out()))
    found = language.predict(docs, model)
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "shares", "fit")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.digest(pii.find(docs, pii.train(docs)))


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "text", F.size("lines_deleted").alias("n_deleted"), "lines_deleted")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).drop("component")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(table(spark, sf_dir, "pages"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(toxicity.labelled_texts(docs, table(spark, sf_dir, "labels")))
    return toxicity.predict(docs, model)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("ka", "kb")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    probes = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)], rows.schema)
    return chat_format.read_back(chat_format.format_chats(rows.unionByName(probes)))


def with_shared_beginnings(sequences: DataFrame) -> DataFrame:
    """Each conversation c begins with the first h turns of conversation c - c % 100; h is the CRC-32 of c in decimal, modulo 6."""
    sequences = stage(sequences, "own-turns")
    first = conversation_trie.first_turns(F.col("seq"), F.col("chars"), F.lit(5))
    bases = sequences.where("conv_id % 100 = 0").select(
        F.col("conv_id").alias("base"), first[0].alias("base_seq"), first[1].alias("base_chars")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int")
    met = sequences.withColumn("h", h).join(bases, F.col("conv_id") - F.col("conv_id") % 100 == F.col("base"), "left").select(
        "conv_id", "seq", "chars", "h", F.coalesce("base_seq", F.lit(b"")).alias("base_seq"),
        F.coalesce("base_chars", F.array().cast("array<int>")).alias("base_chars"),
    )
    start = conversation_trie.first_turns(F.col("base_seq"), F.col("base_chars"), F.col("h"))
    rest = conversation_trie.later_turns(F.col("seq"), F.col("chars"), F.col("h"))
    return met.select("conv_id", F.concat(start[0], rest[0]).alias("seq"), F.concat(start[1], rest[1]).alias("chars"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    sequences = conversation_trie.turn_sequences(table(spark, sf_dir, "conversations"))
    return conversation_trie.prefix_trie(with_shared_beginnings(sequences))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = whitening.whole_vectors(table(spark, sf_dir, "embeddings"))
    return whitening.whiten(whole, whitening.fit_whitening(whole))


QUERIES = {
    "op1_language": op1_language,
    "op2_pii": op2_pii,
    "op3_nearest": op3_nearest,
    "op4_line_dedup": op4_line_dedup,
    "op5_html_text": op5_html_text,
    "op6_simhash": op6_simhash,
    "op7_warc": op7_warc,
    "op8_toxicity": op8_toxicity,
    "op9_decontaminate": op9_decontaminate,
    "op10_mixing": op10_mixing,
    "op11_chat_format": op11_chat_format,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_whitening": op13_whitening,
}

ORACLES = {
    "op7_warc": """
        with p as (
            select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes,
                   sha256(encode(coalesce(html, ''))) as payload_digest from pages),
        f as (select *, min(page_id) over (partition by payload_digest) as first_id from p)
        select page_id, payload_bytes, payload_digest,
               case when payload_bytes >= 100 and page_id > first_id then 'revisit' else 'response' end as record_type,
               case when payload_bytes >= 100 and page_id > first_id then first_id end as refers_to
        from f
    """,
    "op10_mixing": r"""
        with sized as (
            select doc_id, source, md5(doc_id::varchar) as key,
                   coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size
            from documents),
        sources as (
            select source, sum(size)::bigint as source_size,
                   [5.0, 2.0, 1.0][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::double as weight
            from sized group by source),
        ranked as (
            select *, row_number() over (order by 2 * source_size / weight, source nulls last) as n from sources),
        -- the first n - 1 sources are full: the rate that the others would get
        rates as (
            select n, source_size, weight,
                   (1.5 * (select sum(size) from sized)::double
                    - coalesce(sum(2 * source_size) over (order by n rows between unbounded preceding and 1 preceding), 0)::double)
                   / sum(weight) over (order by n rows between current row and unbounded following) as rate
            from ranked),
        chosen as (
            select max(rate) filter (n = (select min(n) from rates where rate * weight < 2 * source_size)) as rate from rates),
        targets as (
            select source, source_size,
                   case when (select rate from chosen) is null or (select rate from chosen) * weight >= 2 * source_size
                        then (2 * source_size)::double else (select rate from chosen) * weight end as target
            from ranked),
        queue as (
            select d.doc_id, d.source, d.size, t.source_size, t.target,
                   sum(d.size) over w as words, row_number() over w as place
            from sized d join targets t on d.source is not distinct from t.source
            window w as (partition by d.source order by d.key, d.doc_id, d.size rows unbounded preceding)),
        entries as (
            select q.*, r.repeat, (words + source_size * r.repeat)::double / target as finish
            from queue q, (values (0), (1)) r(repeat) where size > 0),
        taken as (
            select source, place, size,
                   sum(size) over (order by finish, source is null, source, place, repeat rows unbounded preceding) as so_far
            from entries)
        select q.doc_id, q.source, q.size, q.source_size, q.target, coalesce(t.taken, 0)::bigint as taken
        from queue q left join (
            select source, place, sum(size) as taken from taken
            where so_far <= floor(1.5 * (select sum(size) from sized)) group by all) t
        on q.source is not distinct from t.source and q.place = t.place
    """,
    # The markers are 8, 8 and 7 characters long; an escaped control string is one character longer.
    "op11_chat_format": r"""
        with rows as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
            union all select -7, * from (values (0, 'user', '</s>[INST] ok [/INST]'), (1, 'assistant', '</s>[INST] ok [/INST]'))),
        measured as (
            select *, length(role) + length(text) + 23 + len(regexp_extract_all(
                       role || chr(0) || text,
                       '<\\*(?:s>|/s>|<SYS>>|</SYS>>|\|(?:turn|text|end|im_start|im_end|startoftext|endoftext)\|>)|\[\\*(?:/?INST\])')) as chars
            from rows)
        select conv_id, count(*) as n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
               coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
               sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), ''))
                   as loss_sha256,
               sum(chars)::bigint as formatted_chars
        from measured group by conv_id
    """,
    "op12_conversation_trie": r"""
        with own as (
            select conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} order by turn nulls first, coalesce(role, ''),
                                 md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) as turns
            from conversations where conv_id is not null group by conv_id),
        numbered as (
            -- CRC-32, bit by bit
            select *, (xor(4294967295, list_reduce(
                list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda ch: ord(ch)::bigint)),
                lambda crc, byte: list_reduce(
                    list_prepend(xor(crc, byte), list_transform(range(8), lambda i: 0::bigint)),
                    lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) % 6)::bigint as h
            from own),
        rebuilt as (
            select o.conv_id, list_concat(coalesce(b.turns[1:o.h], []), o.turns[o.h + 1:]) as turns
            from numbered o left join own b on b.conv_id = o.conv_id - o.conv_id % 100),
        prefixes as (
            select conv_id, turns[1:d] as node, d as depth, d = len(turns) as ends
            from (select conv_id, turns, unnest(range(len(turns) + 1)) as d from rebuilt)),
        nodes as (
            select node, depth, min(conv_id) as conv_id, count(*) as n_convs,
                   case when depth > 0 then (count(*) - 1) * length(node[depth].text) else 0 end as saved,
                   sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where ends), '')) as ends_sha256
            from prefixes group by node, depth),
        family as (
            select n.*, p.conv_id as parent_conv_id,
                   (select count(*) from nodes c where c.depth = n.depth + 1 and c.node[1:n.depth] = n.node) as n_children
            from nodes n left join nodes p on p.depth = n.depth - 1 and p.node = n.node[1:n.depth - 1]),
        up as (
            select node[1:a] as node, a as depth, sum(saved)::bigint as saved_tokens,
                   count(*) filter (where n_children = 0) as n_leaves
            from (select node, saved, n_children, unnest(range(depth + 1)) as a from family) group by all)
        select f.conv_id, f.depth, f.parent_conv_id, f.n_convs, f.n_children, u.n_leaves, u.saved_tokens, f.ends_sha256
        from family f join up u on u.node = f.node and u.depth = f.depth
    """,
}
