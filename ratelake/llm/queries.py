"""The registered queries of the corpus operators: thin digests of what the operators return."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.llm import alignment, licenses, minhash, mixing, nearest, oracles, packing, pieces, quality, runs, sharding, suffix_dedup, surrogates, templates
from ratelake.llm.common import split_words
from ratelake.queries.registry import table

# Stands for a caller's secret: the queries and the pipeline must give the same in every run.
SURROGATE_KEY = "key-of-the-registered-queries"

QUERIES = {}
ORACLES = {}


def tokenizer_file(name: str) -> str:
    """Where a vocabulary file that a query is defined by lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def packing_tokenizer() -> str:
    return tokenizer_file("word_bpe_49k.json")


def query(sql: str | None = None):
    def add(build):
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return add


@query(oracles.QUALITY)
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and verdicts of every document."""
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    q = F.col("quality")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select("doc_id", *[q[n].alias(n) for n in names], F.array_join(q["broken"], ",").alias("broken"))


@query(oracles.MIXING)
def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mixture takes of every document."""
    # The text is read for its words only; it does not enter the shuffle.
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    chosen = mixing.choose(docs)
    return chosen.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.copies", "mix.taken")


@query()
def op4_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their place in the sequences."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), packing_tokenizer())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query()
def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with surrogates for its personal data."""
    made = surrogates.pseudonymize(table(spark, sf_dir, "documents").select("doc_id", "text"), SURROGATE_KEY)
    kinds = F.array_join(F.sort_array(F.transform("entities", lambda e: e["kind"])), ",")
    return made.select("doc_id", "text", F.size("entities").cast("long").alias("n_entities"), kinds.alias("kinds"))


@query()
def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of every document, and whether it stands for it."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query()
def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    texts = templates.extract(table(spark, sf_dir, "pages"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query()
def op2_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document under the law of equal rows."""
    placed = sharding.shard(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query()
def op6_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth one."""
    vectors = table(spark, sf_dir, "embeddings")
    return nearest.nearest(vectors, vectors.where("vec_id % 100 = 0"))


@query()
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and labels of every document."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


@query()
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the removal of repeated strings leaves of every document."""
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


@query()
def op11_piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document with begin and end, and the text they decode to."""
    model = tokenizer_file("piece_bpe_32k.model")
    encoded = pieces.encode_texts(table(spark, sf_dir, "documents"), model)
    return pieces.decode_ids(encoded, model).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


@query()
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of every document under two tokenizers."""
    docs = table(spark, sf_dir, "documents")
    return alignment.align_tokenizers(docs, tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


def with_periods(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)``; in a tenth of the documents, chosen by id, the words from some place on repeat."""
    # NULL ids are in no tenth. The words of the other documents are not looked at.
    docs = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
    docs = docs.select("doc_id", "text", F.floor(F.col("h") / 10).alias("g"), F.when(F.col("h") % 10 == 0, split_words(F.col("text"))).alias("w"))
    docs = docs.withColumn("n", F.size("w")).withColumn("a", F.expr("CASE WHEN n > 0 THEN CAST(g % n AS INT) END"))
    docs = docs.withColumn("p", F.expr("CAST(1 + (n - a) DIV (3 + g % 8) AS INT)"))
    again = F.expr("slice(flatten(array_repeat(slice(w, a + 1, p), CAST((n - a + p - 1) DIV p AS INT))), 1, n - a)")
    made = F.array_join(F.concat(F.expr("slice(w, 1, a)"), again), " ")
    return docs.select("doc_id", F.when(F.col("a").isNotNull(), made).otherwise(F.col("text")).alias("text"))


@query()
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeating words of every document, a tenth of them made to repeat."""
    found = runs.periodic_runs(with_periods(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"], r["period"], r["length"])))
    top = found.withColumn("top", longest)
    return top.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "top.start",
        "top.length",
        "top.period",
        F.expr("1000 * top.length DIV top.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )
