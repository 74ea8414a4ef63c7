"""Sentences, sections, size-bounded chunks and their scores."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import text as T
from . import bags

MAX_TOKENS, MAX_CHARS = 2048, 9000
BLEND, ALPHA, BETA, W_COHESION, W_NOVELTY = 0.7, 0.7, 0.3, 0.6, 0.4
MICRO = 1_000_000


def sections(blocks: DataFrame, prefer_headings: bool = True) -> DataFrame:
    """blocks with section_no: a new section at each heading, section 0 before the first."""
    if not prefer_headings:
        return blocks.withColumn("section_no", F.lit(0))
    in_doc = W.partitionBy("doc_id").orderBy("page_number", "block_idx").rowsBetween(W.unboundedPreceding, 0)
    b = blocks.withColumn("_h", T.is_section_heading(F.col("text")).cast("int"))
    first = F.min(F.struct("page_number", "block_idx", "_h")).over(W.partitionBy("doc_id"))["_h"]
    return b.withColumn("section_no", (F.sum("_h").over(in_doc) - first).cast("int")).drop("_h")


def sentences(sectioned: DataFrame, min_len: int = 3) -> DataFrame:
    """doc_id, lang, section_no, page_number, block_idx, sent_idx, k (number in the section), sentence."""
    s = sectioned.select("doc_id", "lang", "section_no", "page_number", "block_idx", F.posexplode(T.sentences(F.col("text"))).alias("sent_idx", "sentence"))
    k = F.row_number().over(W.partitionBy("doc_id", "section_no").orderBy("page_number", "block_idx", "sent_idx"))
    return s.where(F.length("sentence") >= min_len).withColumn("k", k)


def _starts(lengths: Column, max_tokens: int, max_chars: int) -> Column:
    """First sentences (from 1) of chunks: a chunk takes sentences while its characters stay within max_chars and a
    quarter of its joined length within max_tokens; a sentence over max_chars stands alone."""
    zero = F.struct(F.array().cast("array<int>").alias("starts"), F.lit(0).alias("n"), F.lit(0).cast("long").alias("chars"), F.lit(0).alias("i"))

    def step(s, length):
        giant = length > max_chars
        tokens = F.greatest(F.lit(1), F.floor((s["chars"] + s["n"] + length) / 4))
        new = giant | (s["n"] == 0) | (s["chars"] + length > max_chars) | (tokens > max_tokens)
        i = s["i"] + 1
        return F.struct(
            F.when(new, F.array_append(s["starts"], i)).otherwise(s["starts"]).alias("starts"),
            F.when(giant, 0).when(new, 1).otherwise(s["n"] + 1).alias("n"),
            F.when(giant, 0).when(new, length).otherwise(s["chars"] + length).cast("long").alias("chars"),
            i.alias("i"),
        )

    return F.aggregate(lengths, zero, step, lambda s: s["starts"])


def groups(sents: DataFrame, max_tokens: int = MAX_TOKENS, max_chars: int = MAX_CHARS) -> DataFrame:
    """One row per chunk: doc_id, section_no, order_in_section, chunk_seq (both from 0), x, its sentences in order (k first).  The
    fold sees only sentence lengths.  Rows stay where their document's are, so that later steps by document need no shuffle."""
    keys = ("doc_id", "section_no")
    rest = [c for c in sents.columns if c not in (*keys, "k")]
    plan = sents.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("k", *rest))).alias("x"))
    plan = plan.withColumn("starts", _starts(F.transform("x", lambda s: F.length(s["sentence"])), max_tokens, max_chars))
    before = F.sum(F.size("starts")).over(W.partitionBy("doc_id").orderBy("section_no").rowsBetween(W.unboundedPreceding, -1))
    plan = plan.withColumn("_before", F.coalesce(before, F.lit(0)).cast("int"))
    cut = F.transform("starts", lambda s, i: F.slice("x", s, F.coalesce(F.get("starts", i + 1), F.size("x") + 1) - s))
    plan = plan.select(*keys, "_before", F.posexplode(cut).alias("order_in_section", "x"))
    return plan.select(*keys, "order_in_section", (F.col("_before") + F.col("order_in_section")).alias("chunk_seq"), "x")


def packed(sents: DataFrame, max_tokens: int = MAX_TOKENS, max_chars: int = MAX_CHARS) -> DataFrame:
    """sents with order_in_section and chunk_seq (both from 0)."""
    s = groups(sents, max_tokens, max_chars).withColumn("x", F.explode("x"))
    return s.select(*[c if c in ("doc_id", "section_no") else F.col(f"x.{c}").alias(c) for c in sents.columns], "order_in_section", "chunk_seq")


def chunks(pack: DataFrame) -> DataFrame:
    """One row per chunk of packed sentences: text, lengths, ids and lexical scores."""
    keys = ["doc_id", "section_no", "order_in_section", "chunk_seq"]
    return described(pack.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("k", "sentence", "lang"))).alias("x")))


def described(grouped: DataFrame, *extra: str) -> DataFrame:
    """chunks() of groups(), with extra columns as they are."""
    keys = ["doc_id", "section_no", "order_in_section", "chunk_seq"]
    length = F.aggregate(F.transform("x", lambda s: F.length(s["sentence"])), F.lit(0).cast("long"), lambda a, n: a + n)
    c = grouped.select(*keys, *extra, F.get("x.lang", F.lit(0)).alias("lang"), F.size("x").cast("long").alias("n_sentences"), (length / F.size("x")).alias("_len"), F.array_join("x.sentence", " ").alias("text"))
    c = c.withColumn("_t", T.tokens(F.col("text"), F.col("lang")))
    return c.select(
        *keys,
        "lang",
        T.chunk_id(F.col("doc_id"), F.col("order_in_section"), F.col("text")).alias("chunk_id"),
        "text",
        "n_sentences",
        F.length("text").alias("char_len"),
        T.estimated_tokens(F.length("text")).alias("est_tokens"),
        F.col("_t").alias("tokens"),
        F.round(F.when(F.size("_t") > 0, 1.0).otherwise(0.0), 6).alias("lexical_density"),
        F.round(T.type_token_ratio(F.col("_t")), 6).alias("type_token_ratio"),
        F.round("_len", 2).alias("avg_sentence_len_chars"),
        *extra,
    )


def source_spans(pack: DataFrame) -> DataFrame:
    """doc_id, chunk_seq, source_spans: runs of one page with their distinct blocks in order."""
    in_chunk = W.partitionBy("doc_id", "chunk_seq").orderBy("section_no", "k")
    p = pack.withColumn("new", (F.coalesce(F.lag("page_number").over(in_chunk), F.lit(-1)) != F.col("page_number")).cast("int"))
    p = p.withColumn("run", F.sum("new").over(in_chunk.rowsBetween(W.unboundedPreceding, 0)))
    runs = p.groupBy("doc_id", "chunk_seq", "run", "page_number").agg(F.array_sort(F.collect_list(F.struct("section_no", "k", "block_idx"))).alias("x"))
    runs = runs.select("doc_id", "chunk_seq", F.struct("run", "page_number", F.array_distinct("x.block_idx").alias("block_indices")).alias("r"))
    spans = runs.groupBy("doc_id", "chunk_seq").agg(F.array_sort(F.collect_list("r")).alias("r"))
    return spans.select("doc_id", "chunk_seq", F.transform("r", lambda r: F.struct(r["page_number"].alias("page_number"), r["block_indices"].alias("block_indices"))).alias("source_spans"))


def cohesive(grouped: DataFrame) -> DataFrame:
    """groups() with intra_cohesion_lex: mean Jaccard similarity of the token sets of neighbouring sentences; 1 for a single sentence."""
    n = F.size("_sets") - 1
    near = F.zip_with(F.slice("_sets", 1, n), F.slice("_sets", 2, n), lambda a, b: T.jaccard(a, b))
    mean = F.when(n > 0, F.aggregate(near, F.lit(0.0), lambda a, x: a + x) / n).otherwise(1.0)
    sets = F.transform("x", lambda s: F.array_distinct(T.tokens(s["sentence"], s["lang"])))
    return grouped.withColumn("_sets", sets).withColumn("intra_cohesion_lex", F.round(mean, 6)).drop("_sets")


def intra_cohesion(pack: DataFrame) -> DataFrame:
    """doc_id, chunk_seq, intra_cohesion_lex of packed sentences."""
    x = F.sort_array(F.collect_list(F.struct("section_no", "k", "sentence", "lang"))).alias("x")
    return cohesive(pack.groupBy("doc_id", "chunk_seq").agg(x)).select("doc_id", "chunk_seq", "intra_cohesion_lex")


def vectors(found: DataFrame, keys: list[str], text: str = "text", size: int = 4096) -> DataFrame:
    """keys, bucket, w: unit vectors of hashed bags of words, one of every row, a row per non-zero place."""
    from pyspark.sql import types as S
    from pyspark.sql.pandas.types import to_arrow_schema

    bags.small_batches(found.sparkSession)
    rows = found.select(*keys, T.words(F.col(text)).alias("_words"))
    schema = S.StructType([*rows.schema.fields[:-1], S.StructField("bucket", S.IntegerType()), S.StructField("w", S.DoubleType())])
    arrow = to_arrow_schema(schema)
    return rows.mapInArrow(lambda b: bags.vectors(b, len(keys), size, arrow), schema)


def products(found: DataFrame, registry: np.ndarray, text: str = "text") -> DataFrame:
    """found with dots: products of a text's hashed vector and each of the registry's (a row of places each), made where the row is."""
    from pyspark.sql import types as S
    from pyspark.sql.pandas.types import to_arrow_schema

    bags.small_batches(found.sparkSession)
    rows = found.withColumn("_words", T.words(F.col(text)))
    schema = S.StructType([*rows.schema.fields[:-1], S.StructField("dots", S.ArrayType(S.DoubleType()))])
    arrow = to_arrow_schema(schema)
    return rows.mapInArrow(lambda b: bags.products(b, registry, arrow), schema)


def encoded(found: DataFrame, keys: list[str], load, text: str = "text", batch: int = 64) -> DataFrame:
    """keys, embedding: vectors of a model, any object with encode(list of texts).  load() makes it, once a task, where the
    task runs; without a model use vectors()."""
    from pyspark.sql import types as S
    from pyspark.sql.pandas.types import to_arrow_schema

    bags.small_batches(found.sparkSession)
    rows = found.select(*keys, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    schema = S.StructType([*rows.schema.fields[:-1], S.StructField("embedding", S.ArrayType(S.DoubleType()))])
    arrow = to_arrow_schema(schema)
    return rows.mapInArrow(lambda b: bags.encoded(b, load, batch, arrow), schema)


def dense(sparse: DataFrame, keys: list[str], size: int) -> DataFrame:
    """keys, embedding: vectors() as arrays of size numbers."""
    m = sparse.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("bucket", "w"))).alias("m"))
    return m.select(*keys, F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.coalesce(F.col("m")[i], F.lit(0.0))).alias("embedding"))


def likeness(found: DataFrame, *extra: str, size: int = 4096, registry: np.ndarray | None = None) -> DataFrame:
    """doc_id, chunk_seq, char_len, mean_len, doc_length (of the sum of the document's vectors), cohesion_vs_doc (cosine of a chunk's vector to the mean of its document's),
    redundancy_cos_max and redundancy_jaccard_max (the largest to another chunk of the document; 1 for two chunks without
    tokens, 0 for a single chunk), where a document's chunks come together: one shuffle by document, or none where groups()
    left them so.  extra columns go along; with registry (a vector of size places a row) also dots, a chunk's products with each."""
    from pyspark.sql import types as S
    from pyspark.sql.pandas.types import to_arrow_schema

    bags.small_batches(found.sparkSession)
    together = W.partitionBy("doc_id").orderBy("chunk_seq").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    rows = found.select("doc_id", "chunk_seq", "char_len", *extra, "text", "tokens").withColumn("_n", F.count("*").over(together))
    rows = rows.select("doc_id", "chunk_seq", "char_len", *extra, "_n", T.words(F.col("text")).alias("words"), "tokens")
    made = [S.StructField(c, S.DoubleType()) for c in ("mean_len", "doc_length", "cohesion_vs_doc", "redundancy_cos_max", "redundancy_jaccard_max")]
    dots = [S.StructField("dots", S.ArrayType(S.DoubleType()))] if registry is not None else []
    schema = S.StructType([*rows.schema.fields[:-2], *made, *dots])
    arrow = to_arrow_schema(schema)
    return rows.mapInArrow(lambda b: bags.likeness(b, size, arrow, registry), schema).drop("_n")


def cosine_redundancy(found: DataFrame) -> DataFrame:
    return likeness(found).select("doc_id", "chunk_seq", "redundancy_cos_max")


def jaccard_redundancy(found: DataFrame) -> DataFrame:
    return likeness(found).select("doc_id", "chunk_seq", "redundancy_jaccard_max")


def cohesion(found: DataFrame) -> DataFrame:
    return likeness(found).select("doc_id", "chunk_seq", "cohesion_vs_doc")


def scores(found: DataFrame, *extra: str, registry: np.ndarray | None = None) -> DataFrame:
    """The seven semantic scores of every chunk, rounded to six places; extra: more columns of likeness() or of found;
    dots with a registry."""
    carried = [c for c in extra if c in found.columns and c != "char_len"]
    mix = ALPHA * F.col("redundancy_cos_max") + BETA * F.col("redundancy_jaccard_max")
    scale = T.clamp(F.col("char_len") / F.greatest(F.lit(1.0), F.col("mean_len")), 0.5, 2.0)
    health = W_COHESION * F.col("cohesion_vs_doc") + W_NOVELTY * (1 - mix)
    named = {"cohesion_vs_doc": F.col("cohesion_vs_doc"), "redundancy_cos_max": F.col("redundancy_cos_max"), "redundancy_jaccard_max": F.col("redundancy_jaccard_max"), "redundancy_mix": mix, "redundancy_norm": mix * scale, "novelty": 1 - mix, "chunk_health": health}
    return likeness(found, *carried, registry=registry).select("doc_id", "chunk_seq", *[F.round(c, 6).alias(k) for k, c in named.items()], *extra, *["dots"] * (registry is not None))


def length_stats(found: DataFrame) -> DataFrame:
    q = lambda c, p: F.expr(f"percentile({c}, {p})")
    chars = [F.min("char_len").cast("double").alias("chars_min"), *[q("char_len", p / 100).alias(f"chars_p{p}") for p in (25, 50, 75, 95)], F.max("char_len").cast("double").alias("chars_max"), F.avg("char_len").alias("chars_mean")]
    toks = [F.min("est_tokens").cast("double").alias("tokens_min"), *[q("est_tokens", p / 100).alias(f"tokens_p{p}") for p in (50, 95)], F.max("est_tokens").cast("double").alias("tokens_max"), F.avg("est_tokens").alias("tokens_mean")]
    return found.agg(F.count("*").alias("count"), *chars, *toks)


SCORES = ("cohesion_vs_doc", "redundancy_cos_max", "redundancy_jaccard_max", "redundancy_mix", "redundancy_norm", "novelty", "chunk_health", "intra_cohesion_lex", "lexical_density", "type_token_ratio", "avg_sentence_len_chars")


def run_stats(sectioned: DataFrame, found: DataFrame) -> DataFrame:
    """Per document: n_sections, n_blocks, n_chunks, mean lengths and mean SCORES of its chunks (found has them), half up to
    six places, summed in whole millionths."""
    blocks = sectioned.groupBy("doc_id").agg(F.countDistinct("section_no").alias("n_sections"), F.count("*").alias("n_blocks"))
    mean = {"avg_chunk_chars": "char_len", "avg_chunk_tokens": "est_tokens"} | {f"avg_{k}": k for k in SCORES}
    n, micro = F.count("*"), lambda c: F.sum(F.round(F.coalesce(F.col(c).cast("double"), F.lit(0.0)) * MICRO).cast("long"))
    chunks = found.groupBy("doc_id").agg(n.alias("n_chunks"), *[(F.floor((2 * micro(c) + n) / (2 * n)) / MICRO).alias(k) for k, c in mean.items()])
    return blocks.join(chunks, "doc_id", "left").na.fill(0, ["n_chunks", *mean])


def _mean4(total: Column, n: Column, unit: int) -> Column:
    """total / (n * unit) half up to four places, in whole numbers, so that ties do not hang on binary fractions."""
    total, n = total.cast("long"), n.cast("long") * unit
    return F.floor((total * 20_000 + n) / (2 * n)) / 10_000


def quality(found: DataFrame, spans: DataFrame, scored: DataFrame, documents: DataFrame) -> DataFrame:
    """Per document: coverage, alignment with first blocks, score means, shares, and health with its status; four
    places each, summed in whole millionths (the places that scores have)."""
    keys = ["doc_id", "chunk_seq"]
    first = F.col("source_spans")[0]["block_indices"]
    aligned = (F.array_contains(first, 0) | (F.size(first) <= 2)).cast("int")
    c = found.join(spans, keys).join(scored, keys)
    means = ("cohesion_vs_doc", "chunk_health", "redundancy_norm", "novelty", "lexical_density", "type_token_ratio")
    micro = {k: F.sum(F.round(F.coalesce(k, F.lit(0.0)) * MICRO).cast("long")) for k in means}
    a = c.groupBy("doc_id").agg(
        F.count("*").alias("n_chunks"),
        F.sum("char_len").alias("_covered"),
        F.sum(aligned).alias("_aligned"),
        *[v.alias(f"_{k}") for k, v in micro.items()],
        F.sum((F.col("cohesion_vs_doc") >= 0.7).cast("int")).alias("_near"),
        F.sum((F.col("redundancy_norm") >= 0.6).cast("int")).alias("_again"),
    )
    a = a.join(documents.select("doc_id", F.length("text").alias("_chars")), "doc_id")
    n = F.col("n_chunks")
    health = round(W_COHESION * 10) * F.col("_chunk_health") + round(W_NOVELTY * 10) * F.col("_cohesion_vs_doc")
    status = F.when(health * 4 >= n * 30 * MICRO, "good").when(health * 2 >= n * 10 * MICRO, "moderate").otherwise("poor")
    coverage = F.when(F.col("_chars") > 0, F.least(F.lit(1.0), _mean4(F.col("_covered"), F.greatest(F.lit(1), F.col("_chars")), 1))).otherwise(0.0)
    return a.select(
        "doc_id",
        "n_chunks",
        _mean4(F.col("_aligned"), n, 1).alias("boundary_alignment"),
        *[_mean4(F.col(f"_{k}"), n, MICRO).alias(f"{k}_mean") for k in means],
        _mean4(F.col("_near"), n, 1).alias("semantic_coverage"),
        _mean4(F.col("_again"), n, 1).alias("redundancy_flag_rate"),
        F.lit(0.0).alias("redundancy_p95"),  # over a field that no stage writes
        coverage.alias("coverage_rate"),
        _mean4(health, n, 10 * MICRO).alias("global_health_score"),
        status.alias("status"),
    )
