"""The registered queries opN_<name> and their SQL twins."""

from __future__ import annotations

import hashlib
import os
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from exonloom.scale import computed_once, materialize

from . import align, language, lattice, mixing, near, packing, pages, quality, runs, sharding, spans, tokens, vectors
from .common import WORD, count_words, query, table

TOKENIZER_FOLDER = os.environ.get("TOKENIZER_FOLDER", "")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public vocabulary file."""
    if TOKENIZER_FOLDER:
        return f"{TOKENIZER_FOLDER}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_token_lengths")
def token_lengths(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.suffix_totals(tokens.length_histogram(table(spark, folder, "documents"), tokenizer_path()))



def crc_of_ids(ids) -> int:
    return zlib.crc32(ids.tobytes())


def packed(docs: DataFrame, capacity: int = 2048) -> DataFrame:
    """Pieces of ``docs`` with the digest of their ids and their place in a sequence."""
    made = packing.pieces(docs, tokenizer_path(), capacity, describe=("ids_crc32", "long", crc_of_ids))
    return packing.pack(materialize(made.withColumn("row", F.monotonically_increasing_id()), "pieces"), capacity).drop("row")


@query("op2_island_packing")
def island_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed(table(spark, folder, "documents").select("doc_id", "text"))


@query("op3_weighted_minhash")
def weighted_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document: its class and whether it stays."""
    found = near.classes(table(spark, folder, "documents").select("doc_id", "text"))
    repeated = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return found.select("doc_id", "class_id", "kept", repeated.alias("copy")).select("doc_id", "class_id", (F.col("kept") & (F.col("copy") == 1)).alias("kept"))


@query("op4_subword_lattice")
def subword_lattice(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.score(table(spark, folder, "documents"), tokenizer_path("piece_bpe_32k.model"))


@query("op5_quality_trees")
def quality_trees(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    forest = quality.train(docs, table(spark, folder, "labels"))
    return quality.judge(docs, forest).drop("text")


@query("op6_bounded_ring")
def bounded_ring(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    lean = materialize(docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
                                   F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32")), "sizes")
    placed = sharding.assign(lean, key=("doc_id", "text_crc32"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


MIXED = rf"""
with sized as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size from documents),
known as (select source, sum(size)::bigint as source_size, (row_number() over (order by source asc nulls last) - 1) % 3 + 1.0::double as weight from sized group by source),
room as (select *, 3.0::double * source_size as most,
    (sum(source_size) over ())::double - 3.0::double * coalesce(sum(source_size) over (w rows between unbounded preceding and 1 preceding), 0)::double as rest,
    sum(weight) over () - coalesce(sum(weight) over (w rows between unbounded preceding and 1 preceding), 0.0) as free, row_number() over w as rn
  from known window w as (order by source_size / weight, source asc nulls last)),
level as (select arg_min(rest / free, rn) as share from room where rest / free * weight <= most),
goal as (select source, source_size, least(most, share * weight) as target,
    ('0x' || substr(md5('7:' || coalesce('s' || source, 'n')), 1, 8))::bigint / 4294967296.0::double as u from room, level),
nth as (select sized.*, row_number() over (partition by source order by size, doc_id) as n from sized),
rated as (select nth.*, source_size, target, u, case when source_size > 0 then target / source_size else 0.0 end as rate from nth join goal on nth.source is not distinct from goal.source)
select doc_id, size, source_size, target, ((floor(n * rate + u) - floor((n - 1) * rate + u))::bigint * size)::bigint as taken from rated
"""


@query("op7_line_blocks")
def line_blocks(spark: SparkSession, folder: str) -> DataFrame:
    found = pages.extract(table(spark, folder, "pages").select("page_id", "url", "html"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


@query("op8_source_mix", MIXED)
def source_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    lean = materialize(docs.select("doc_id", "source", count_words(F.col("text")).alias("size")), "sizes")
    return mixing.copies(lean).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query("op9_int8_tiles")
def int8_tiles(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_vectors(table(spark, folder, "embeddings"))


@query("op10_block_anchors")
def block_anchors(spark: SparkSession, folder: str) -> DataFrame:
    found = spans.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def with_periods(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, where every tenth document (by crc32 of its id) repeats a stretch of its
    words to its end. A null id changes nothing."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    rows = computed_once(docs.select("doc_id", "text", h.alias("h"), g.alias("g")), "w", F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})"), 1)))
    rows = rows.withColumn("n", F.size("w").cast("long")).withColumn("a", (F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    turns = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    words = F.concat(F.slice("w", F.lit(1), F.col("a")), F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), turns)))
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(F.slice(words, F.lit(1), F.col("n").cast("int")), " ")).otherwise(F.col("text")).alias("text"))


@query("op11_factor_runs")
def factor_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = runs.collapse(with_periods(table(spark, folder, "documents")))
    best, lines = runs.strongest(F.col("runs")), F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    shown = F.concat(F.array_join(lines, "\n"), F.when(F.size(lines) > 0, "\n").otherwise(""))
    own = found.select("doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(shown, 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"))
    return own.select("doc_id", "n_runs", "best.start", "best.length", "best.period", F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
                      "runs_sha256", "collapsed_sha256", "n_words")


@query("op12_output_codes")
def output_codes(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    model = language.train(docs.where(~held))
    return language.identify(docs.select("doc_id", "text", held.alias("held_out")), model).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


def hex_of(groups: str) -> str:
    """Digest of a document's groups; '' without tokens."""
    return hashlib.sha256(groups.encode()).hexdigest() if groups else ""


@query("op13_anchor_windows")
def anchor_windows(spark: SparkSession, folder: str) -> DataFrame:
    found = align.align(table(spark, folder, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"), describe=("groups_sha256", "string", hex_of))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
