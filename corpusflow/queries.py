"""Registered queries: each runs one operator over whole driver tables.

Text queries are the ``benchmark`` items, the corpus is ``documents``. Dense search runs on
``embeddings`` with every vector as a query, or with the mean vector of each label where the
output holds every (query, row) pair. Requests and telemetry come from ``events``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as T
from .functions import vector as V
from .functions.embed import DIM, embed, signature
from .operators import approximate as A
from .operators import cache as C
from .operators import chunking as K
from .operators import context as X
from .operators import fusion as U
from .operators import retrieval as R
from .operators import sparse as S
from .operators import usage as G
from .operators.inverted import TextIndex
from .plans.ranking import explode_list
from .plans.sizing import few_rows, materialise, rows_of, scratch_path, spread
from .sources import files, stores
from .sources.manifest import state_of
from .streaming import jobs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Parameters shared with the SQL checks.
CACHE_THRESHOLD = 0.3
COMPRESS_THRESHOLD = 0.2
FILTER_LABEL = 3
BUDGET = 50
LANGUAGE_FILES = {"en": ".md", "de": ".csv", "fr": ".json", "es": ".txt"}
QUERY_PROMPT = "search the corpus for: "
DIRECTORY = {"nation": ["n_nationkey", "n_name"], "customer": ["c_custkey", "c_name", "c_mktsegment"], "supplier": ["s_suppkey", "s_name"]}
PROMPT = ("Answer the question briefly, from the context alone.\n\n"
          "Context:\n{context}\n\nQuestion: {question}")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark, sf, name) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark, sf) -> DataFrame:
    return table(spark, sf, "documents")


def text_queries(spark, sf) -> DataFrame:
    return table(spark, sf, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def vectors(spark, sf) -> DataFrame:
    return table(spark, sf, "embeddings").withColumnRenamed("vec_id", "id")


def vector_queries(spark, sf) -> DataFrame:
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("query_id"), "embedding")


def label_means(spark, sf) -> DataFrame:
    """One query per label: the mean of its vectors, combined in each task first."""
    points = table(spark, sf, "embeddings").select(
        "label", array_to_vector(V.as_double("embedding")).alias("v"))
    means = points.groupBy("label").agg(Summarizer.mean(F.col("v")).alias("mean")).select(
        F.col("label").cast("bigint").alias("query_id"), vector_to_array("mean").alias("embedding"))
    return materialise(means)  # a few rows; the size check and the search then read these alone


_INDEXES: dict[tuple, TextIndex] = {}


def text_index(spark, sf, *batches: str) -> TextIndex:
    """Stored index of the documents, one batch for each condition.

    It is built at its first use in a session, and again when a file of the table has changed.
    """
    batches = batches or ("true",)
    key = (spark.sparkContext.applicationId, state_of(spark, f"{sf}/documents.parquet"), batches)
    if key not in _INDEXES:
        index = TextIndex(spark, scratch_path(spark, "text-index"))
        for n, condition in enumerate(batches):
            index.append(f"{n:04d}", documents(spark, sf).where(condition))
        _INDEXES[key] = index
    return _INDEXES[key]


# --- dense retrieval -------------------------------------------------------------------------

@query
def knn_topk(spark, sf):
    return R.nearest(vector_queries(spark, sf), vectors(spark, sf), 5, exclude_self=True)


@query
def knn_with_scores(spark, sf):
    return R.nearest_with_scores(vector_queries(spark, sf), vectors(spark, sf), 3, exclude_self=True)


@query
def knn_filtered(spark, sf):
    return R.nearest_filtered(vector_queries(spark, sf), vectors(spark, sf), 3,
                              F.col("label") == FILTER_LABEL, exclude_self=True)


@query
def cosine_rank(spark, sf):
    return R.full_ranking(label_means(spark, sf), vectors(spark, sf)).select(
        "query_id", "id", "rank", "score")


@query
def similarity_matrix(spark, sf):
    return R.similarity_matrix(label_means(spark, sf), vectors(spark, sf))


@query
def vector_profile(spark, sf):
    rows = vectors(spark, sf)
    norm = V.norm("embedding")
    unit = F.transform(V.as_double("embedding"), lambda x: x / F.col("norm"))
    parts = [F.round(F.get(V.as_double(V.head("embedding")), F.lit(i)), 6).alias(f"c{i}") for i in range(5)]
    return rows.withColumn("norm", norm).select(
        "id", V.dimension("embedding").alias("dim"), F.round("norm", 6).alias("norm"), *parts,
        V.all_close("embedding", unit).alias("is_unit"))


@query
def mmr_rerank(spark, sf):
    return R.nearest_diverse(vector_queries(spark, sf), vectors(spark, sf), 3, 5, 0.5, exclude_self=True)


def _rewrites(spark, sf):
    """Each sentence of a query as a rewrite of it."""
    return explode_list(text_queries(spark, sf), ["query_id"], T.sentences("query"), "variant",
                        "variant_no").withColumn("codes", signature("variant"))


def _coded_documents(spark, sf):
    return text_index(spark, sf).docs().select("id", "codes")


def _multi_query(spark, sf):
    return R.multi_query(_rewrites(spark, sf), _coded_documents(spark, sf), 2, vec="codes",
                         encoding="signature")


@query
def multi_query_union(spark, sf):
    return _multi_query(spark, sf)


def _ann(spark, sf):
    """Approximate top-5 over a stored index."""
    root = scratch_path(spark, "vector-index")
    stores.save(A.index_vectors(vectors(spark, sf)), root)
    return A.nearest_approximate(vector_queries(spark, sf), stores.load(spark, root), 5, exclude_self=True)


@query
def ann_topk(spark, sf):
    return _ann(spark, sf)


@query
def ann_recall(spark, sf):
    exact = R.nearest(vector_queries(spark, sf), vectors(spark, sf), 5, exclude_self=True)
    return A.recall(_ann(spark, sf), exact)


# --- sparse and fused retrieval --------------------------------------------------------------

@query
def bm25_topk(spark, sf):
    return text_index(spark, sf).search(text_queries(spark, sf), 4)


@query
def bm25_incremental(spark, sf):
    """The corpus arrives in two batches, each stored by itself and searched with the other."""
    return text_index(spark, sf, "lang = 'en'", "NOT lang <=> 'en'").search(text_queries(spark, sf), 4)


@query
def bm25_merged(spark, sf):
    """Three batches, merged into one from their stored postings."""
    index = text_index(spark, sf, "doc_id % 3 = 0", "doc_id % 3 = 1", "NOT doc_id % 3 <=> 0 AND NOT doc_id % 3 <=> 1")
    index.compact("merged")
    return index.search(text_queries(spark, sf), 4)


@query
def dense_text_topk(spark, sf):
    return U.search_codes(text_queries(spark, sf), text_index(spark, sf).docs().select("id", "codes"), 4)


@query
def rrf_fusion(spark, sf):
    """Three lists: BM25, dense, and BM25 over the documents labelled as good."""
    q, docs, index = text_queries(spark, sf), documents(spark, sf), text_index(spark, sf)
    good = table(spark, sf, "labels").where(F.col("quality") == 1).select("doc_id")
    rows = index.docs()
    lists = [index.search(q, 3), U.search_codes(q, rows.select("id", "codes"), 3),
             S.bm25(q, docs.join(good, "doc_id", "left_semi"), 3)]
    return U.fuse(lists, [0.5, 0.3, 0.2], rows, 3, id="id", small=few_rows(q, 9))


@query
def hybrid_search(spark, sf):
    return U.hybrid_search(text_queries(spark, sf), documents(spark, sf), 4, 0.5, index=text_index(spark, sf))


@query
def ensemble_search(spark, sf):
    return U.ensemble_search(text_queries(spark, sf), documents(spark, sf), 2, (0.4, 0.6), index=text_index(spark, sf))


@query
def parent_retrieve(spark, sf):
    return R.parent_search(text_queries(spark, sf), documents(spark, sf), 4).select(
        "query_id", "doc_id", "parent_no", "rank", "best_child_rank", "score", "parent")


def _ranked_texts(spark, sf, k, ranked=None):
    q = text_queries(spark, sf)
    ranked = text_index(spark, sf).search(q, k) if ranked is None else ranked
    return rows_of(ranked, documents(spark, sf),
                   [F.col("doc_id").alias("id"), "text", "lang", "source"], few_rows(q, k))


@query
def compress_context(spark, sf):
    return X.compress(_ranked_texts(spark, sf, 2), text_queries(spark, sf), COMPRESS_THRESHOLD)


@query
def advanced_retrieval(spark, sf):
    """Multi-query retrieval, then compression against the original query."""
    found = _ranked_texts(spark, sf, 40, _multi_query(spark, sf))
    return X.compress(found, text_queries(spark, sf), COMPRESS_THRESHOLD).drop("score")


# --- context, prompts, attribution -----------------------------------------------------------

@query
def context_plain(spark, sf):
    return X.assemble(_ranked_texts(spark, sf, 2), X.plain_line(), X.PLAIN_SEPARATOR)


@query
def context_sources(spark, sf):
    rows = _ranked_texts(spark, sf, 3)
    parts = F.array_sort(F.collect_list(F.struct(
        "rank", X.source_line().alias("by_source"), X.numbered_line().alias("numbered"),
        X.bracket_line().alias("bracketed"))))
    joined = rows.groupBy("query_id").agg(parts.alias("parts"))
    return joined.select(
        "query_id",
        F.array_join(F.col("parts.by_source"), X.SOURCE_SEPARATOR).alias("by_source"),
        F.array_join(F.col("parts.numbered"), X.PLAIN_SEPARATOR).alias("numbered"),
        F.array_join(F.col("parts.bracketed"), X.PLAIN_SEPARATOR).alias("bracketed"))


def _provenance(rows):
    """Give documents a file path and ordinal by language, then normalise."""
    ext = F.lit(".bin")
    for lang, name in LANGUAGE_FILES.items():
        ext = F.when(F.col("lang") == lang, F.lit(name)).otherwise(ext)
    return files.normalise(rows.withColumn("path", F.concat(F.lit("corpus/"), "source", ext))
                           .withColumn("ordinal", F.col("id")))


@query
def context_headers(spark, sf):
    return X.assemble(_provenance(_ranked_texts(spark, sf, 3)), X.header_line(), X.HEADER_SEPARATOR)


@query
def prompt_build(spark, sf):
    contexts = X.assemble(_ranked_texts(spark, sf, 2), X.plain_line(), X.LINE_SEPARATOR)
    return X.fill_prompt(contexts, text_queries(spark, sf), PROMPT)


@query
def source_attribution(spark, sf):
    rows = _provenance(_ranked_texts(spark, sf, 5))
    known = F.map_from_arrays(F.array(F.lit("file_name"), F.lit("file_type")), F.array("file_name", "file_type"))
    whole = F.map_concat(known, F.create_map(F.lit("location"), F.col("location")))
    # Rows that stand for a whole document carry no location key, so the default shows.
    metadata = F.when(F.col("location") == files.WHOLE, known).otherwise(whole)
    return X.attribution(rows.withColumn("metadata", metadata))


@query
def parse_answers(spark, sf):
    """Stored structured answers, one per assistant turn, decoded to one row per citation."""
    turns = table(spark, sf, "conversations").where(F.col("role") == "assistant")
    cited = F.array(
        F.struct(F.concat(F.lit("conv-"), F.col("conv_id").cast("string"), F.lit(".json")).alias("file_name"),
                 F.lit("JSON").alias("file_type"),
                 F.concat(F.lit("Record #"), (F.col("turn") + 1).cast("string")).alias("location")),
        F.struct(F.lit("manual.md").alias("file_name"), F.lit("Markdown").alias("file_type"),
                 F.lit(files.WHOLE).alias("location")))
    stored = turns.select("conv_id", "turn", F.to_json(F.struct(
        F.col("text").alias("answer"), cited.alias("sources"))).alias("response"))
    parsed = X.parse_answers(stored)
    return parsed.select("conv_id", "turn", F.col("parsed.answer").alias("answer"),
                         F.posexplode("parsed.sources").alias("source_no", "s")).select(
        "conv_id", "turn", "answer", "source_no", "s.file_name", "s.file_type", "s.location")


@query
def parse_graded_answers(spark, sf):
    """Stored graded answers, one per assistant turn; those that broke off on the way decode to nulls."""
    turns = table(spark, sf, "conversations").where(F.col("role") == "assistant")
    size = F.char_length("text")
    sent = F.to_json(F.struct(
        F.col("text").alias("answer"), F.when(size >= 200, "high").when(size >= 80, "medium").otherwise("low").alias("confidence"),
        F.transform(F.sequence(F.lit(0), F.col("turn") % 3), lambda i: F.concat(F.lit("part-"), i.cast("string"))).alias("sources_used"),
        F.when(F.col("turn") % 2 == 1, F.concat(F.lit("What follows turn "), F.col("turn").cast("string"), F.lit("?"))).alias("follow_up")))
    broke = F.col("conv_id") % 7 == 3
    stored = turns.select("conv_id", "turn", F.when(broke, F.substring(sent, F.lit(1), F.char_length(sent) - 1)).otherwise(sent).alias("response"))
    parsed = X.parse_answers(stored, schema=X.GRADED_ANSWER)
    return parsed.select("conv_id", "turn", "parsed.answer", "parsed.confidence", F.array_join("parsed.sources_used", ",").alias("sources_used"),
                         "parsed.follow_up")


# --- chunking --------------------------------------------------------------------------------

def _corpus(spark, sf):
    return spread(documents(spark, sf).select("doc_id", "lang", "text"), "doc_id")


@query
def recursive_chunk(spark, sf):
    docs = _corpus(spark, sf)
    return K.explode_chunks(docs, K.recursive(F.col("text"), 300, 30), drop=["text"])


@query
def code_chunk(spark, sf):
    """Texts laid out as classes and functions, cut by the separators of code."""
    laid = F.replace(F.replace(F.replace("text", F.lit(". "), F.lit(".\ndef ")), F.lit(", "), F.lit("\n\tdef ")), F.lit("? "), F.lit("\nclass "))
    docs = _corpus(spark, sf).withColumn("text", F.concat(F.lit("class "), "lang", F.lit(":\n"), laid))
    return K.explode_chunks(docs, K.recursive(F.col("text"), 200, 0, K.PYTHON), drop=["text"])


@query
def chunk_overlap(spark, sf):
    """Chunk counts and characters without and with overlap, per language."""
    docs = _corpus(spark, sf)
    lists = F.array(
        F.struct(F.lit(0).alias("overlap"), K.recursive(F.col("text"), 70, 0).alias("parts")),
        F.struct(F.lit(25).alias("overlap"), K.recursive(F.col("text"), 70, 25).alias("parts")))
    rows = explode_list(docs.select("lang", F.inline(lists)), ["lang", "overlap"], "parts", "chunk")
    return rows.groupBy("overlap", "lang").agg(
        F.count(F.lit(1)).alias("n_chunks"), F.sum(F.length("chunk")).alias("n_chars"))


@query
def semantic_chunk(spark, sf):
    docs = K.semantic_parts(_corpus(spark, sf)).drop("has_empty_sentence")
    return K.explode_chunks(docs, F.col("semantic"), drop=["text", "semantic"])


@query
def smart_chunk(spark, sf):
    docs = K.smart_parts(_corpus(spark, sf), max_size=1000, fallback_size=500, fallback_overlap=50)
    return K.explode_chunks(docs, F.col("smart"), drop=["text", "smart"])


@query
def parent_child_chunks(spark, sf):
    parents, children = K.parent_child(_corpus(spark, sf))
    return children


@query
def chunk_strategy_stats(spark, sf):
    return K.compare_strategies(_corpus(spark, sf))


@query
def header_chunk(spark, sf):
    pages = spread(table(spark, sf, "pages").select("page_id", "html"), "page_id")
    marked = pages.select("page_id", T.html_headed_text("html").alias("text"))
    return K.header_chunks(marked)


@query
def chunk_preview(spark, sf):
    return documents(spark, sf).select("doc_id", T.preview("text", 120).alias("preview"),
                                       F.length("text").alias("n_chars"))


# --- sources and stores ----------------------------------------------------------------------

@query
def src_text(spark, sf):
    """Text files below a folder tree, read back whole; characters per folder."""
    root = scratch_path(spark, "text")
    documents(spark, sf).select(F.col("text").alias("value"), F.col("source").alias("folder")) \
        .write.partitionBy("folder").text(root)
    docs = files.read_text(spark, root)
    folder = F.regexp_extract(X.metadata_value("metadata", "path", ""), r"folder=([^/]+)/", 1)
    return docs.groupBy(folder.alias("source"), "file_type", "location").agg(
        F.sum(F.length("text").cast("bigint")).alias("n_chars"))


@query
def row_to_document(spark, sf):
    """Rows of a CSV file as documents."""
    root = scratch_path(spark, "csv")
    table(spark, sf, "nation").write.option("header", True).csv(root)
    return files.read_csv(spark, root).select("text", "file_type", "location")


@query
def json_files(spark, sf):
    """Turns as files that hold one JSON array each, read block by block."""
    root = scratch_path(spark, "json")
    turns = table(spark, sf, "conversations").withColumn("part", F.floor(F.col("conv_id") / 200).cast("bigint"))
    arrays = turns.groupBy("part").agg(F.to_json(F.array_sort(F.collect_list(F.struct("conv_id", "turn", "role", "text")))).alias("value"))
    arrays.repartition("part").write.partitionBy("part").text(root)
    rows = files.read_json(spark, root, ".txt")
    part = F.regexp_extract(F.col("metadata")["path"], r"part=(\d+)/", 1).cast("bigint")
    field = lambda name: F.get_json_object("text", f"$.{name}")
    return rows.select(part.alias("part"), "file_type", "location", field("conv_id").cast("bigint").alias("conv_id"),
                       field("turn").cast("bigint").alias("turn"), field("role").alias("role"), field("text").alias("text"))


@query
def ingest_directory(spark, sf):
    """A folder of CSV files with different headers, split into chunks with their provenance."""
    root = scratch_path(spark, "directory")
    for name, columns in DIRECTORY.items():
        table(spark, sf, name).select(*columns).write.option("header", True).csv(f"{root}/{name}")
    chunks = files.load_chunks(spark, root)
    return chunks.select("file_type", F.regexp_extract(F.col("metadata")["path"], r"/(\w+)/[^/]+$", 1).alias("folder"), "chunk_no", "chunk")


@query
def json_records(spark, sf):
    """Turns as JSON arrays, a bounded run of turns each, then exploded to records."""
    turns = table(spark, sf, "conversations").withColumn("page", F.floor(F.col("turn") / 100).cast("bigint"))
    item = F.struct("turn", "role", "text")
    arrays = turns.groupBy("conv_id", "page").agg(
        F.to_json(F.array_sort(F.collect_list(item))).alias("value"))
    rows = files.json_records(arrays)
    return rows.select("conv_id", "page", F.col("record_no").cast("bigint").alias("record_no"),
                       F.get_json_object("record", "$.role").alias("role"),
                       F.get_json_object("record", "$.text").alias("text"))


@query
def normalize_metadata(spark, sf):
    return _provenance(documents(spark, sf).withColumnRenamed("doc_id", "id")).select(
        "id", "file_name", "file_type", "location", F.length("text").alias("text_chars"))


@query
def html_to_text(spark, sf):
    return spread(table(spark, sf, "pages"), "page_id").select(
        "page_id", "url", T.html_text("html").alias("text"))


@query
def page_location(spark, sf):
    pages = table(spark, sf, "pages").select(F.col("url").alias("file_name"), F.col("page_id").alias("page"),
                                             F.col("html").alias("text"))
    return files.pdf_pages(pages).select("file_name", "file_type", "location",
                                         F.length("text").alias("n_chars"))


def _vector_digest(rows):
    """Scalar figures that pin down every component of a vector."""
    v = V.as_double("embedding")
    weighted = F.aggregate(F.transform(v, lambda x, i: x * (i + 1)), F.lit(0.0), lambda a, x: a + x)
    parts = [F.round(F.get(v, F.lit(i)), 6).alias(f"c{i}") for i in range(5)]
    return rows.select(
        "id", F.size("embedding").alias("dim"),
        F.size(F.filter(v, lambda x: x != 0)).alias("n_nonzero"),
        F.round(V.norm("embedding"), 6).alias("norm"), F.round(weighted, 4).alias("weighted"), *parts)


@query
def embed_documents(spark, sf):
    return _vector_digest(stores.embed_table(documents(spark, sf)))


@query
def embed_query_prompt(spark, sf):
    """Queries are embedded behind a prompt that documents do not have."""
    rows = text_queries(spark, sf).select(F.col("query_id").alias("id"), embed("query", prompt=QUERY_PROMPT).alias("embedding"))
    return _vector_digest(rows)


@query
def embedding_cache_misses(spark, sf):
    """Vectors of labelled documents are cached; the whole corpus asks for its vectors."""
    docs = documents(spark, sf)
    labelled = docs.join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")
    cached = labelled.select(F.lit("corpus").alias("namespace"), T.text_key("text").alias("content_hash")).distinct()
    return stores.cache_misses(docs, cached, "corpus").select(
        "content_hash", F.length("text").alias("n_chars"))


@query
def embedding_cache_fill(spark, sf):
    """Empty cache, then labelled documents, then all; each text is embedded once."""
    docs = documents(spark, sf)
    root = scratch_path(spark, "embedding-cache")
    labelled = docs.join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")
    stores.fill_cache(spark, labelled, root, "corpus")
    vectors = stores.fill_cache(spark, docs, root, "corpus")
    return _vector_digest(vectors.withColumnRenamed("doc_id", "id"))


@query
def persist_reload_count(spark, sf):
    """Save a store twice (the second replaces the first), reopen it, count."""
    root = scratch_path(spark, "vectors")
    stores.save(vectors(spark, sf), root, partition_by=["label"])
    stores.save(vectors(spark, sf), root, partition_by=["label"])
    return stores.load(spark, root).groupBy("label").agg(F.count(F.lit(1)).alias("n_vectors"))


# --- answer cache ----------------------------------------------------------------------------

@query
def semantic_cache_lookup(spark, sf):
    """One cached answer per label, at its mean vector; every vector asks."""
    entries = label_means(spark, sf).withColumnRenamed("query_id", "id")
    found = C.lookup(vector_queries(spark, sf), entries, CACHE_THRESHOLD)
    answers = entries.select(F.col("id").alias("cache_id"), F.concat(
        F.lit("answer "), F.col("id").cast("string")).alias("cached_response"))
    return R.with_small_table(found, answers, ["cache_id"]).select(
        "query_id", "cache_id", "score", "cached_response")


def _cache_requests(spark, sf):
    return table(spark, sf, "embeddings").select(
        F.col("label").cast("bigint").alias("tenant"), F.col("vec_id").alias("id"), "embedding")


@query
def semantic_cache_replay(spark, sf):
    return C.replay(_cache_requests(spark, sf), CACHE_THRESHOLD)


# --- usage -----------------------------------------------------------------------------------

@query
def token_estimate(spark, sf):
    return documents(spark, sf).select("doc_id", T.word_count("text").alias("n_words"),
                                       G.token_estimate("text").alias("n_tokens"))


@query
def token_preflight(spark, sf):
    turns = table(spark, sf, "conversations")
    return G.preflight(turns, BUDGET).select("conv_id", "turn", "estimated_tokens", "allowed", "reason")


def _requests(spark, sf, events=None):
    """Requests with stored responses. Signups have no usage block, errors fail."""
    events = table(spark, sf, "events") if events is None else events
    k = F.get_json_object("props", "$.k").cast("bigint")
    decision = (F.when(F.col("event_type") == "purchase", F.lit(" Complex query.\n"))
                .when(F.col("event_type") == "signup", F.lit("COMPLEX"))
                .when(F.col("event_type") == "view", F.lit("Simple"))
                .otherwise(F.lit("not sure")))
    tier = G.route(decision)
    model = F.when(tier == "complex", F.lit(G.PRICES[1][1])).otherwise(F.lit(G.PRICES[0][1]))
    used = F.struct(k.alias("prompt_tokens"), (k * 3 + 1).alias("completion_tokens"))
    response = F.when(F.col("event_type") == "signup", F.lit("{}")).otherwise(
        F.to_json(F.struct(used.alias("token_usage"), model.alias("model_name"))))
    started = F.col("ts").cast("timestamp")
    stopped = F.timestamp_micros(F.unix_micros(started) + F.round(F.col("value") * 1000).cast("bigint"))
    cached = F.when(k < 30, F.lit("stored answer")).when(k < 40, F.lit(""))
    return events.select(
        F.col("event_id").alias("request_id"), "user_id", "event_type", started.alias("started"),
        stopped.alias("stopped"), F.when(F.col("event_type") == "error", F.lit("TimeoutError")).alias("failure"),
        decision.alias("decision"), tier.alias("tier"), response.alias("response"),
        cached.alias("cached_response"))


def _usage(spark, sf, events=None):
    rows = _requests(spark, sf, events)
    return rows.select(*rows.columns, *G.usage_columns())


def _telemetry(spark, sf, events=None):
    return G.telemetry(_usage(spark, sf, events), failed_model=G.PRICES[0][1])


@query
def usage_extract(spark, sf):
    return _usage(spark, sf).select("request_id", "prompt_tokens", "completion_tokens", "model_name")


@query
def usage_summary(spark, sf):
    return G.usage_summary(_usage(spark, sf).where(F.col("failure").isNull()))


@query
def cost_by_tier(spark, sf):
    return G.cost_by_tier(G.answered_misses(_usage(spark, sf)), G.price_table(spark))


@query
def route_parse(spark, sf):
    return _requests(spark, sf).select("request_id", "decision", "tier")


@query
def cache_route_stats(spark, sf):
    return G.cache_and_route_counts(_requests(spark, sf))


@query
def telemetry_rows(spark, sf):
    return G.number_requests(_telemetry(spark, sf)).select(
        "request_id", "request_no", "latency_ms", "prompt_tokens", "completion_tokens",
        "total_tokens", "model_name", "status")


@query
def telemetry_json(spark, sf):
    """Log lines written to a text sink and read back."""
    rows = _telemetry(spark, sf)
    # The event times are UTC wall-clock times, in whatever zone the session is.
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    failed = F.col("status") != "SUCCESS"
    base = {"timestamp": stamp, "logger_name": F.lit("requests"),
            "log_level": F.when(failed, F.lit("ERROR")).otherwise(F.lit("INFO")),
            "message": F.when(failed, F.lit("request failed")).otherwise(F.lit("request served")),
            "status": F.lit("UNSET")}
    payload = ["request_id", "latency_ms", "prompt_tokens", "completion_tokens", "total_tokens",
               "model_name", "status"]
    root = scratch_path(spark, "log")
    G.log_lines(rows, base, payload).write.text(root)
    return spark.read.text(root)


@query
def telemetry_summary(spark, sf):
    return G.health(_telemetry(spark, sf))


@query
def runs_by_tag(spark, sf):
    """Runs of one tag and one client tier."""
    runs = _requests(spark, sf).select(
        "request_id", F.array(F.lit("user_inbound"), F.col("event_type"), F.col("tier")).alias("tags"),
        F.create_map(F.lit("user_id"), F.col("user_id").cast("string"), F.lit("client_tier"),
                     F.when(F.col("user_id") % 3 == 0, F.lit("Premium_Tier")).otherwise(
                         F.lit("Free_Tier"))).alias("attrs"))
    found = G.with_attribute(G.with_tag(runs, "complex"), "client_tier", "Premium_Tier")
    return found.select("request_id", F.array_join("tags", ",").alias("tags"),
                        F.col("attrs")["user_id"].alias("user_id"))


# --- streaming -------------------------------------------------------------------------------

@query
def stream_ingest(spark, sf):
    root = scratch_path(spark, "ingest")
    jobs.ingest(jobs.file_stream(spark, sf, "documents.parquet"), root)
    return jobs.ingested_search(spark, root, text_queries(spark, sf), 4)


@query
def stream_telemetry(spark, sf):
    root = scratch_path(spark, "health")
    events = jobs.file_stream(spark, sf, "events.parquet")
    return jobs.running_health(_telemetry(spark, sf, events), root)


@query
def stream_cache(spark, sf):
    root = scratch_path(spark, "served")
    stream = jobs.file_stream(spark, sf, "embeddings.parquet").select(
        F.col("label").cast("bigint").alias("tenant"), F.col("vec_id").alias("id"), "embedding")
    return jobs.replay_cache(stream, root, CACHE_THRESHOLD)
