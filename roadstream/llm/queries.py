"""The training-data operators over the driver's tables, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstream.llm import bpe, periodic, repair
from roadstream.llm.common import table
from roadstream.llm.crf import label_words
from roadstream.llm.decontaminate import leaks
from roadstream.llm.neardup import near_duplicates
from roadstream.llm.packing import pack
from roadstream.llm.polytope import neighbours
from roadstream.llm.quality import quality
from roadstream.llm.secrets import digests, scan
from roadstream.llm.sharding import shards
from roadstream.llm.training_order import training_order
from roadstream.llm.warc import archived


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages as WARC records, written and read back."""
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return archived(table(spark, folder, "pages")).select(*names)


def op2_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Four-word shingles of every document, linked at similarity 0.8."""
    found = near_duplicates(table(spark, folder, "documents"), size=4, percent=80)
    return found.withColumnRenamed("id", "doc_id")


def op3_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document; a source is taken as both repository and owner."""
    return digests(scan(table(spark, folder, "documents"))).withColumnRenamed("id", "doc_id")


def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes, tokens and rows."""
    placed = shards(table(spark, folder, "documents"), 40).withColumnRenamed("id", "doc_id")
    names = ("doc_id", "size", "text_crc32")
    return placed.select(
        *names, F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "tokens"
    )


def op5_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest found of every twentieth vector, among all vectors."""
    return neighbours(table(spark, folder, "embeddings"))


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document; three quarters of the labelled ones teach it."""
    docs = table(spark, folder, "documents")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    held_out = F.coalesce(fold == 2, F.lit(False))
    labelled = label_words(docs, docs.where(~held_out & F.col("lang").isNotNull()))
    return labelled.select(
        F.col("id").alias("doc_id"),
        F.coalesce(F.crc32(F.col("id").cast("string").cast("binary")) % 4 == 2, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
        F.size("runs").alias("n_runs"),
    )


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return pack(table(spark, folder, "documents"), tokenizer).withColumnRenamed("id", "doc_id")


def op8_training_order(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as fixed-stride sequences in a keyed order, read back from the shards."""
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return training_order(table(spark, folder, "documents"), tokenizer).withColumnRenamed("id", "doc_id")


def op9_benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    """Every pair of a document and a benchmark item that stands in it."""
    found = leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Keep or reject every document by its perplexity; labelled clean texts are trusted."""
    trusted = table(spark, folder, "labels").where("quality = 1 and toxic = 0")
    judged = quality(table(spark, folder, "documents"), trusted)
    return judged.select(
        F.col("id").alias("doc_id"), "lang", "perplexity", "threshold", "kept"
    )


def _with_periodic_tails(docs: DataFrame) -> DataFrame:
    """Every tenth document by the CRC of its id gets a periodic tail, as the contract says."""
    name = F.col("doc_id").cast("string").cast("binary")
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    # Step by step, as each column is used several times in the next.
    marked = docs.select("doc_id", "text", F.crc32(name).alias("_h")).select(
        "doc_id", "text", F.floor(F.col("_h") / 10).alias("_g"), F.when(F.col("_h") % 10 == 0, words).alias("_words")
    )
    marked = marked.withColumn("_n", F.size("_words"))
    marked = marked.withColumn("_at", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")).cast("int"))
    marked = marked.withColumn("_rest", F.col("_n") - F.col("_at"))
    marked = marked.withColumn("_period", (1 + F.floor(F.col("_rest") / (3 + F.col("_g") % 8))).cast("int"))
    times = F.ceil(F.col("_rest") / F.col("_period")).cast("int")
    tail = F.flatten(F.array_repeat(F.slice("_words", F.col("_at") + 1, F.col("_period")), times))
    periodic_text = F.array_join(F.concat(F.slice("_words", F.lit(1), F.col("_at")), F.slice(tail, F.lit(1), F.col("_rest"))), " ")
    return marked.select("doc_id", F.when(F.col("_at").isNotNull(), periodic_text).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of the words of every document, of which every tenth has a periodic tail."""
    docs = _with_periodic_tails(table(spark, folder, "documents"))
    return periodic.digests(periodic.periodic_runs(docs)).withColumnRenamed("id", "doc_id")


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation after its damage: faults, cheapest edits and the repaired turns."""
    return repair.digests(table(spark, folder, "conversations"))


def op13_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as token ids of whole words and their ends, and decoded again."""
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    ids = bpe.encoded(table(spark, folder, "documents"), tokenizer)
    return bpe.digests(bpe.decoded(ids, tokenizer)).withColumnRenamed("id", "doc_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_warc": op1_warc,
        "op2_near_duplicates": op2_near_duplicates,
        "op3_secrets": op3_secrets,
        "op4_sharding": op4_sharding,
        "op5_neighbours": op5_neighbours,
        "op6_language": op6_language,
        "op7_packing": op7_packing,
        "op8_training_order": op8_training_order,
        "op9_benchmark_leaks": op9_benchmark_leaks,
        "op10_quality": op10_quality,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_conversation_repair": op12_conversation_repair,
        "op13_bpe": op13_bpe,
    }


def _repair_sql() -> str:
    """The contract of the conversation repair: damage, faults, and the cheapest edits row by
    row, keeping for each state after a row (nothing, system, user, assistant) its least
    cost, letters and lines."""

    def edit(state: str, cost: str, letter: str, line: str | None = None) -> str:
        lines = f"list_append({state}.t, {line})" if line else f"{state}.t"
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {lines}}}"

    def insert(states: str) -> str:
        user = ", ".join(edit(x, "3", "I", "'user:'") for x in ("s0", "s1", "s3"))
        closed = f"least(s2, {user}) as s2, least(s3, {edit('s2', '3', 'I', chr(39) + 'assistant:' + chr(39))}) as s3"
        for _ in range(3):
            states = f"(select * replace ({closed}) from {states})"
        return states

    def kept(state: str, initial: str) -> str:
        return f"case when live and left(role, 1) = '{initial}' then {edit(state, 'extra', 'K', 'role || chr(58) || text')} else no end"

    def relabelled(state: str, role: str) -> str:
        line = f"'{role}:' || text"
        return f"case when live then {edit(state, '3 + extra', 'R', line)} else no end"

    gone = {x: edit(x, "4", "D") for x in ("s0", "s1", "s2", "s3")}
    before = ("s0", "s1", "s3")
    users = [f(x, y) for x in before for f, y in ((kept, "u"), (relabelled, "user"))]
    step = (
        f"{gone['s0']} s0, least({gone['s1']}, {kept('s0', 's')}) s1, "
        f"least({gone['s2']}, {', '.join(users)}) s2, "
        f"least({gone['s3']}, {kept('s2', 'a')}, {relabelled('s2', 'assistant')}) s3"
    )
    none = "{'c': 1000000000, 'a': '', 't': []::varchar[]}"
    white = r"[\x20\x09-\x0D]"
    stepped = "list_reduce(list_prepend(i::ubigint, range(8)::ubigint[]), lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end)"
    crc = "list_reduce(list_prepend(4294967295::ubigint, list_transform(str_split(k, ''), lambda x: ascii(x)::ubigint)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::bigint + 1]))"
    return f"""
        with recursive tab as (select list({stepped} order by i) t from range(256) r(i)),
        base as (select conv_id, turn, coalesce(role, ' ') role, coalesce(text, ' ') text,
            coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') k from conversations),
        hit as (select base.*, xor({crc}, 4294967295::ubigint) % 20 h from base, tab),
        damaged as (select conv_id, turn, case h when 4 then 'user' else role end role,
            case h when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end text
          from (select *, unnest(case h when 3 then [0, 1] else [0] end) from hit where h <> 0)),
        o as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) n from damaged),
        f as (select *, row_number() over (partition by conv_id, role, text order by n) nth,
            lag(role) over (partition by conv_id order by n) last_role from o),
        m as (select *, case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'blank' when nth > 1 then 'duplicate'
            when not regexp_matches(text, '[.!?]{white}*$') then 'truncated' end fault from f),
        path as (
          select conv_id, 0 n, {none.replace('1000000000', '0')} s0, {none} s1, {none} s2, {none} s3 from (select distinct conv_id from m)
          union all
          select conv_id, n, s0, s1, s2, s3 from (select conv_id, n, {step} from {insert(f"""(
              select path.conv_id, m.n, s0, s1, s2, s3, m.role, m.text, {none} no, coalesce(m.fault, '') not in ('blank', 'duplicate') live,
                case m.fault when 'truncated' then 3 else 0 end extra
              from path join m on m.conv_id is not distinct from path.conv_id and m.n = path.n + 1)""")})),
        ends as (select conv_id, least(s0, s3) e from {insert("""(select path.* from path join (select conv_id, max(n) n from m group by conv_id) z
            on z.conv_id is not distinct from path.conv_id and z.n = path.n)""")}),
        counts as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) gaps,
            count(*) filter (fault = 'blank') blank, count(*) filter (fault = 'duplicate') duplicate,
            count(*) filter (fault = 'truncated') truncated,
            count(*) filter (n > 1 and left(last_role, 1) || left(role, 1) not in ('su', 'ua', 'au')) illegal from m group by conv_id)
        select d.conv_id, coalesce(gaps, 0)::bigint gaps, coalesce(blank, 0) blank, coalesce(duplicate, 0) duplicate,
          coalesce(truncated, 0) truncated, coalesce(illegal, 0) illegal, coalesce(e.c, 0)::bigint as cost,
          coalesce(e.a, '') audit, sha256(coalesce(array_to_string(e.t, chr(10)), '')) repaired_sha256
        from (select distinct conv_id from conversations) d
        left join counts on counts.conv_id is not distinct from d.conv_id
        left join ends on ends.conv_id is not distinct from d.conv_id"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_warc": """
            with p as (select page_id, coalesce(html, '') h from pages),
            f as (select *, case when octet_length(encode(h)) >= 100 then min(page_id) over (partition by h) end m from p)
            select page_id, octet_length(encode(h))::bigint payload_bytes, sha256(h) payload_digest,
              case when page_id > m then 'revisit' else 'response' end record_type,
              case when page_id > m then m end refers_to
            from f""",
        "op12_conversation_repair": _repair_sql(),
    }
