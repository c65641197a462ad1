"""K: chunks, retrieval and document tables."""

from pyspark.sql import functions as F

from riskweave.functions import text
from riskweave.operators import documents, retrieval
from riskweave.plans.registry import query
from riskweave.plans.tables import Tables
from riskweave.session import scratch


def docs(spark, d):
    return Tables(spark, d).base("documents")


@query("K1_char_chunks", """
SELECT doc_id, CAST(k AS INT) AS chunk_id, substr(text, CAST(k * 800 + 1 AS BIGINT), 1000) AS text,
       CAST(length(substr(text, CAST(k * 800 + 1 AS BIGINT), 1000)) AS INT) AS length, CAST(k * 800 AS INT) AS start_pos
FROM (SELECT doc_id, text, unnest(range(0, 1 + greatest(0, length(text) - 201) // 800)) AS k FROM documents WHERE length(text) > 0)""")
def k1(spark, d):
    return documents.chunk_by_chars(docs(spark, d), "doc_id", "text")


_WORDS = r"list_filter(string_split_regex(text, '\s+'), lambda w: length(w) > 0)"


@query("K2_word_chunks", rf"""
SELECT doc_id, CAST(k AS INT) AS chunk_id, array_to_string(w[CAST(k * 450 + 1 AS BIGINT):CAST(k * 450 + 500 AS BIGINT)], ' ') AS text
FROM (SELECT doc_id, w, unnest(range(0, (len(w) + 449) // 450)) AS k FROM (SELECT doc_id, {_WORDS} AS w FROM documents))""")
def k2(spark, d):
    return documents.chunk_by_words(docs(spark, d), "doc_id", "text")


@query("K3_chunk_metadata", """
SELECT concat('doc_', doc_id, '_chunk_', k) AS id, concat('chunk_id=', k, ';doc_id=', doc_id, ';lang=', lang, ';source=', source, ';start_pos=origin') AS metadata
FROM (SELECT doc_id, lang, source, unnest(range(0, 1 + greatest(0, length(text) - 201) // 800)) AS k FROM documents WHERE length(text) > 0)""")
def k3(spark, d):
    own = F.create_map(F.lit("source"), F.col("source"), F.lit("lang"), F.col("lang"), F.lit("start_pos"), F.lit("origin"))
    chunks = documents.chunk_index(docs(spark, d).withColumn("meta", own), "doc_id", "text", "meta")
    pairs = F.array_sort(F.map_entries("metadata"))
    return chunks.select("id", F.array_join(F.transform(pairs, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";").alias("metadata"))


_TOKENS = r"""list_filter(string_split_regex(translate(lower(text), '!"#$%&''()*+,-./:;<=>?@[\]^_`{|}~', ''), '\s+'), lambda w: length(w) > 0)"""


@query("K4_tokens", f"SELECT doc_id, len({_TOKENS}) AS n, array_to_string({_TOKENS}, ' ') AS tokens FROM documents")
def k4(spark, d):
    split = docs(spark, d).select("doc_id", text.tokens(F.col("text")).alias("w"))
    return split.select("doc_id", F.size("w").cast("bigint").alias("n"), F.array_join("w", " ").alias("tokens"))


_INDEX = f"""
WITH tok AS (SELECT doc_id, unnest({_TOKENS}) AS term FROM documents),
cnt AS (SELECT doc_id, term, count(*) AS n FROM tok GROUP BY ALL),
tf AS (SELECT doc_id, term, n / sum(n) OVER (PARTITION BY doc_id) AS tf FROM cnt),
idf AS (SELECT term, count(*) AS df, ln((SELECT count(*) FROM documents) / count(*)) AS idf FROM cnt GROUP BY term),
w AS (SELECT doc_id, term, tf * idf AS w FROM tf JOIN idf USING (term)),
unit AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM w WHERE w <> 0)"""
_SEARCH = _INDEX + f""",
qtok AS (SELECT item_id, unnest({_TOKENS}) AS term FROM benchmark),
qcnt AS (SELECT item_id, term, count(*) AS n FROM qtok GROUP BY ALL),
qtf AS (SELECT item_id, term, n / sum(n) OVER (PARTITION BY item_id) AS tf FROM qcnt),
qw AS (SELECT item_id, term, tf * idf AS w FROM qtf JOIN idf USING (term)),
qunit AS (SELECT item_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY item_id)) AS q FROM qw WHERE w <> 0),
pair AS (SELECT item_id, doc_id, sum(weight * q) AS score FROM unit JOIN qunit USING (term) GROUP BY ALL),
hit AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 10) DESC, doc_id) AS rank FROM pair WHERE score > 0 QUALIFY rank <= 5)"""


def _index(spark, d):
    """The index of a folder as it is now; every query call builds its own."""
    return retrieval.build_index(docs(spark, d), "doc_id", "text", scratch(spark, "index"))


@query("K5_tfidf_weights", _INDEX + " SELECT doc_id, term, round(weight, 8) AS weight FROM unit")
def k5(spark, d):
    return _index(spark, d)["postings"].select("doc_id", "term", F.round("weight", 8).alias("weight"))


@query("K6_corpus_stats", _INDEX + " SELECT (SELECT count(*) FROM documents) AS num_documents, count(*) AS vocab_size FROM idf")
def k6(spark, d):
    return retrieval.corpus_stats(docs(spark, d), "text")


def _hits(spark, d, k=5):
    return retrieval.tfidf_search(_index(spark, d), "doc_id", Tables(spark, d).base("benchmark"), "item_id", "text", k)


@query("K7_tfidf_search", _SEARCH + " SELECT item_id, doc_id, CAST(rank AS INT) AS rank, round(score, 6) AS score FROM hit")
def k7(spark, d):
    return _hits(spark, d).withColumn("score", F.round("score", 6))


def _found(spark, d, most=200_000):
    """The hits as stored. Up to ``most`` of them are sent to what they meet, so texts are not shuffled."""
    path, hits = scratch(spark, "hits"), _hits(spark, d)
    hits.write.parquet(path)
    found = spark.read.schema(hits.schema).parquet(path)
    return F.broadcast(found) if found.count() <= most else found


# Query vectors: the mean vector of every label.
_CENTROIDS = """
WITH long AS (SELECT label, unnest(embedding)::DOUBLE AS x, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings),
mean AS (SELECT label, i, avg(x) AS x FROM long GROUP BY ALL),
q AS (SELECT label AS query_id, list(x ORDER BY i) AS qv FROM mean GROUP BY label),
pair AS (SELECT query_id, label, vec_id, list_dot_product(qv, embedding::DOUBLE[]) / (sqrt(list_dot_product(qv, qv))
           * sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) + 1e-8) AS cosine,
         list_sum(list_transform(list_zip(qv, embedding::DOUBLE[]), lambda p: (p[1] - p[2]) ** 2)) AS l2 FROM q, embeddings)"""


def _vectors(spark, d):
    vectors = Tables(spark, d).base("embeddings")
    means = vectors.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("x"))
    queries = means.groupBy(F.col("label").alias("query_id")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("qv"))
    return vectors, queries


def _top(order, where="TRUE", k=5):
    return f"SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY {order}, vec_id) AS rank FROM pair WHERE {where} QUALIFY rank <= {k}"


@query("K8_cosine_search", _CENTROIDS + f"""
SELECT query_id, vec_id, round(cosine, 4) AS score, CAST(rank AS INT) AS rank FROM ({_top('cosine DESC')}) WHERE cosine >= 0.3""")
def k8(spark, d):
    vectors, queries = _vectors(spark, d)
    return retrieval.dense_search(vectors, "vec_id", "embedding", queries, "query_id", "qv", threshold=0.3).withColumn("score", F.round("score", 4))


@query("K8_cosine_neighbours", """
WITH p AS (SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) / (sqrt(list_dot_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[]))
             * sqrt(list_dot_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[])) + 1e-8) AS cosine FROM embeddings a, embeddings b)
SELECT query_id, vec_id, round(cosine, 4) AS score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(cosine, 10) DESC, vec_id) AS INT) AS rank FROM p QUALIFY rank <= 3""")
def k8_neighbours(spark, d):
    vectors = Tables(spark, d).base("embeddings")
    asked = vectors.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("qv"))
    return retrieval.dense_search(vectors, "vec_id", "embedding", asked, "query_id", "qv", k=3, block=200).withColumn("score", F.round("score", 4))


@query("K9_l2_search", _CENTROIDS + f"SELECT query_id, vec_id, round(l2, 4) AS score, CAST(rank AS INT) AS rank FROM ({_top('l2')})")
def k9(spark, d):
    vectors, queries = _vectors(spark, d)
    return retrieval.dense_search(vectors, "vec_id", "embedding", queries, "query_id", "qv", metric="l2").withColumn("score", F.round("score", 4))


@query("K10_filtered_search", _CENTROIDS + f"""
SELECT query_id, vec_id, round(cosine, 4) AS score, CAST(rank AS INT) AS rank FROM ({_top('cosine DESC', 'label = 3')})""")
def k10(spark, d):
    vectors, queries = _vectors(spark, d)
    kept = retrieval.where_metadata(vectors, {"label": 3})
    return retrieval.dense_search(kept, "vec_id", "embedding", queries, "query_id", "qv").withColumn("score", F.round("score", 4))


@query("K11_similarity_threshold", _CENTROIDS + f"""
SELECT query_id, vec_id, round(cosine, 4) AS similarity FROM ({_top('cosine DESC', k=20)}) WHERE cosine >= 0.35""")
def k11(spark, d):
    vectors, queries = _vectors(spark, d)
    found = retrieval.dense_search(vectors, "vec_id", "embedding", queries, "query_id", "qv", k=20)
    near = found.select("query_id", "vec_id", (1 - F.col("score")).alias("distance"))
    return retrieval.similarity_above(near, 0.35).select("query_id", "vec_id", F.round("similarity", 4).alias("similarity"))


@query("K12_context", _SEARCH + """,
sized AS (SELECT item_id, rank, text, coalesce(sum(length(text)) OVER (PARTITION BY item_id ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used
          FROM hit JOIN documents USING (doc_id)),
flag AS (SELECT *, (used + length(text) > 4000)::INT AS over FROM sized),
kept AS (SELECT *, coalesce(sum(over) OVER (PARTITION BY item_id ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS passed FROM flag)
SELECT item_id, coalesce(string_agg(CASE WHEN over = 0 THEN concat('[Document ', rank, ']', chr(10), text)
     WHEN 4000 - used > 100 THEN concat('[Document ', rank, ']', chr(10), substr(text, 1, CAST(4000 - used AS BIGINT)), '...') END, chr(10) || chr(10) ORDER BY rank), '') AS context
FROM kept WHERE passed = 0 GROUP BY item_id""")
def k12(spark, d):
    found = _found(spark, d).join(docs(spark, d).select("doc_id", "text"), "doc_id")
    return documents.assemble_context(found, "item_id", "rank", "text", 4000)


@query("K13_batch_query", _SEARCH + """
SELECT item_id, count(*) AS num_sources, round(max(score), 6) AS best_score, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY rank) AS sources FROM hit GROUP BY item_id""")
def k13(spark, d):
    found = _hits(spark, d)
    return found.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("num_sources"), F.round(F.max("score"), 6).alias("best_score"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "doc_id"))), lambda s: s["doc_id"].cast("string")), ",").alias("sources"))


@query("K14_rerank", _SEARCH + """,
size AS (SELECT item_id, count(*) AS size FROM hit GROUP BY item_id),
pick AS (SELECT item_id, unnest([5, 9, 1 + item_id % 3]) AS rank, unnest([1, 2, 3]) AS place FROM benchmark)
SELECT hit.item_id, doc_id, CAST(row_number() OVER (PARTITION BY hit.item_id ORDER BY place) AS INT) AS new_rank
FROM hit JOIN size USING (item_id) JOIN pick ON pick.item_id = hit.item_id AND pick.rank = hit.rank WHERE size > 3
UNION ALL SELECT item_id, doc_id, CAST(rank AS INT) FROM hit JOIN size USING (item_id) WHERE size <= 3""")
def k14(spark, d):
    rankings = Tables(spark, d).base("benchmark").select(
        "item_id", F.concat(F.lit("5, x,9, "), (F.col("item_id") % 3 + 1).cast("string"), F.lit(",4")).alias("ranking"))
    return documents.rerank(_found(spark, d), rankings, "item_id", "rank").select("item_id", "doc_id", "new_rank")


@query("K15_source_snippets", _SEARCH + """
SELECT item_id, doc_id, source, CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...' ELSE text END AS snippet,
       substr(text, 1, 200) || '...' AS excerpt, round(score, 6) AS relevance_score FROM hit JOIN documents USING (doc_id)""")
def k15(spark, d):
    found = _found(spark, d).join(docs(spark, d).select("doc_id", "source", "text"), "doc_id")
    return documents.evidence_rows(found, "source", "text", "score").select(
        "item_id", "doc_id", "source", documents.snippet(F.col("text")).alias("snippet"), "excerpt", F.round("relevance_score", 6).alias("relevance_score"))


@query("K16_corpus_upkeep", """
WITH c AS (SELECT concat('doc_', doc_id) AS id, text FROM documents
           UNION ALL SELECT concat('doc_', (SELECT count(*) FROM documents) + row_number() OVER (ORDER BY item_id) - 1), text FROM benchmark)
SELECT id, CASE WHEN id IN (SELECT concat('doc_', doc_id) FROM labels WHERE quality = 1 AND toxic = 0) THEN 'replaced' ELSE text END AS text
FROM c WHERE id NOT IN (SELECT concat('doc_', doc_id) FROM labels WHERE toxic = 1)""")
def k16(spark, d):
    t = Tables(spark, d)
    corpus = docs(spark, d).select(F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("id"), "text")
    grown = documents.append_documents(corpus, t.base("benchmark"), F.floor(F.col("item_id") / 1000), ["item_id"])
    named = t.base("labels").withColumn("id", F.concat(F.lit("doc_"), F.col("doc_id").cast("string")))
    kept = documents.delete_documents(grown, named.where("toxic = 1"))
    return documents.update_documents(kept, named.where("quality = 1 AND toxic = 0").select("id", F.lit("replaced").alias("text")))


@query("K16_corpus_size", """
SELECT count(*) AS num_documents, CAST(max(len(embedding)) AS INT) AS embedding_dim, round(sum(len(embedding)) * 8 / 1048576, 6) AS total_size_mb FROM embeddings""")
def k16_size(spark, d):
    return documents.corpus_size(Tables(spark, d).base("embeddings"), "embedding").withColumn("total_size_mb", F.round("total_size_mb", 6))


_RESPONSE = """concat('Brand: ', p_brand, chr(10), 'Type Code: T', p_size, chr(10), 'Type: ', p_type, ' Type:', chr(10), 'note', chr(10), 'Brand:  ', p_name, ' ')"""


def _responses(spark, d):
    return Tables(spark, d).base("part").select("p_partkey", F.concat(
        F.lit("Brand: "), "p_brand", F.lit("\nType Code: T"), F.col("p_size").cast("string"), F.lit("\nType: "), "p_type",
        F.lit(" Type:\nnote\nBrand:  "), "p_name", F.lit(" ")).alias("response"))


@query("K17_parsed_fields", """
SELECT p_partkey, trim(p_name) AS Brand, p_type AS Type, concat('T', p_size) AS TypeCode, CAST(NULL AS VARCHAR) AS Price FROM part""")
def k17(spark, d):
    parsed = documents.parse_fields(F.col("response"), ["Brand", "Type", "Type Code", "Price"])
    return _responses(spark, d).select("p_partkey", *[c.alias(n.replace(" ", "")) for n, c in parsed.items()])


@query("K18_extraction_check", f"""
WITH r AS (SELECT p_partkey, lower({_RESPONSE}) AS t FROM part),
m AS (SELECT p_partkey, list_filter(['brand', 'TYPE', 'widget', 'ring'], lambda f: NOT contains(t, lower(f))) AS missing FROM r)
SELECT p_partkey, (4 - len(missing)) / 4 AS completeness_score, (4 - len(missing)) / 4 >= 0.7 AS complete, array_to_string(missing, ',') AS missing_fields FROM m""")
def k18(spark, d):
    fields = F.array(*[F.lit(x) for x in ("brand", "TYPE", "widget", "ring")])
    checks = documents.extraction_check(F.col("response"), fields)
    checks["missing_fields"] = F.array_join(checks["missing_fields"], ",")
    return _responses(spark, d).select("p_partkey", *[c.alias(n) for n, c in checks.items()])


@query("K19_flattened_conversations", """
SELECT conv_id, string_agg(CASE role WHEN 'system' THEN 'System: ' WHEN 'user' THEN 'User: ' ELSE 'Assistant: ' END || text, chr(10) ORDER BY turn) AS prompt
FROM conversations WHERE role IN ('system', 'user', 'assistant') GROUP BY conv_id""")
def k19(spark, d):
    return documents.flatten_conversations(Tables(spark, d).base("conversations"))
