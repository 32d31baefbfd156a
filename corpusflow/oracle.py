"""SQL that states what each registered query must return, for DuckDB on the same tables.
"""

from __future__ import annotations

from .functions.embed import DIM
from .queries import BUDGET, CACHE_THRESHOLD, COMPRESS_THRESHOLD, DIRECTORY, FILTER_LABEL, QUERY_PROMPT

ORACLE: dict[str, str] = {}


def _tokens(text: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '')"


def _sentences(text: str) -> str:
    return (f"list_filter(string_split(regexp_replace({text}, '([.?!])\\s+', '\\1' || chr(1), 'g'), "
            "chr(1)), lambda s: s <> '')")


def _top(name: str, source: str, k: int, by: str = "query_id") -> str:
    return f"""{name} AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY score DESC, id)::INT AS rank
                 FROM {source}) WHERE rank <= {k})"""


def _bm25(name: str, k: int, docs: str = "documents") -> str:
    """CTEs that end in a table ``name`` of (query_id, id, score, rank)."""
    n = name
    return f"""
{n}_terms AS (SELECT doc_id AS id, {_tokens('text')} AS terms FROM {docs}),
{n}_tot AS (SELECT count(*)::DOUBLE AS n, sum(len(terms))::DOUBLE / count(*) AS avg_len FROM {n}_terms),
{n}_tf AS (SELECT id, n_terms, term, count(*) AS tf
           FROM (SELECT id, len(terms) AS n_terms, unnest(terms) AS term FROM {n}_terms) GROUP BY ALL),
{n}_df AS (SELECT term, count(*) AS df FROM {n}_tf GROUP BY term),
{n}_q AS (SELECT query_id, term, count(*) AS qtf
          FROM (SELECT item_id AS query_id, unnest({_tokens('text')}) AS term FROM benchmark) GROUP BY ALL),
{n}_s AS (
  SELECT query_id, id, round(sum(qtf * ln(1.0::DOUBLE + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE))
      * (tf * 2.5::DOUBLE) / (tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * n_terms / avg_len))), 6) AS score
  FROM {n}_q JOIN {n}_df USING (term) JOIN {n}_tf USING (term) CROSS JOIN {n}_tot
  GROUP BY query_id, id),
{_top(name, f'(SELECT * FROM {n}_s WHERE score > 0)', k)}"""


def _sparse(name: str, source: str, keys: str) -> str:
    """Unit hashed vectors in long form, from ``source`` rows (keys, txt)."""
    return f"""
{name}_h AS (SELECT {keys}, md5(t) AS h FROM (SELECT {keys}, unnest({_tokens('txt')}) AS t FROM {source})),
{name}_w AS (SELECT {keys}, ('0x' || substr(h, 1, 7))::INT % {DIM} AS b,
                    sum(CASE WHEN substr(h, 8, 1) < '8' THEN 1 ELSE -1 END)::DOUBLE AS w
             FROM {name}_h GROUP BY ALL),
{name}_n AS (SELECT {keys}, sqrt(sum(w * w)) AS len FROM {name}_w GROUP BY {keys}),
{name} AS (SELECT {', '.join('x.' + k.strip() for k in keys.split(','))}, b, w / len AS w
           FROM {name}_w x JOIN {name}_n y USING ({keys}) WHERE len > 0)"""


def _dense(name: str, k: int, queries: str = "(SELECT item_id AS query_id, text AS txt FROM benchmark)") -> str:
    return f"""
{_sparse(name + '_q', queries, 'query_id')},
{_sparse(name + '_d', '(SELECT doc_id AS id, text AS txt FROM documents)', 'id')},
{name}_s AS (SELECT query_id, id, round(sum(q.w * d.w), 6) AS score
             FROM {name}_q q JOIN {name}_d d USING (b) GROUP BY query_id, id),
{_top(name, name + '_s', k)}"""


def _fuse(lists: list[tuple[str, float]], k: int | None, first_rank: int = 0) -> str:
    parts = " UNION ALL ".join(
        f"SELECT query_id, id, {n} AS list_no, rank, {w}::DOUBLE / (rank - 1 + {first_rank} + 60) AS part FROM {t}"
        for n, (t, w) in enumerate(lists))
    keep = f"WHERE rank <= {k}" if k else ""
    return f"""
u AS ({parts}),
f AS (SELECT query_id, arg_min(id, list_no * 1000000 + rank) AS id, round(sum(part), 9) AS score
      FROM u JOIN documents d ON d.doc_id = u.id GROUP BY query_id, d.text)
SELECT * FROM (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id)::INT AS rank,
                      score FROM f) {keep}"""


# --- dense retrieval -------------------------------------------------------------------------

_PAIRS = """pairs AS (
  SELECT a.vec_id AS query_id, b.vec_id AS id, b.label,
         round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS score
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)"""
_CAND = "SELECT query_id, id, rank, score FROM top"

ORACLE["knn_topk"] = f"WITH {_PAIRS}, {_top('top', 'pairs', 5)} {_CAND}"
ORACLE["knn_filtered"] = (
    f"WITH {_PAIRS}, {_top('top', f'(SELECT * FROM pairs WHERE label = {FILTER_LABEL})', 3)} {_CAND}")

ORACLE["knn_with_scores"] = f"""
WITH d AS (
  SELECT a.vec_id AS query_id, b.vec_id AS id,
         -round(list_sum(list_transform(list_zip(a.embedding::DOUBLE[], b.embedding::DOUBLE[]),
                lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 6) AS score
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
{_top('top', 'd', 3)}
SELECT query_id, id, rank, abs(score) AS distance, round(1.0::DOUBLE / (1.0::DOUBLE + abs(score)), 6) AS similarity
FROM top"""

# Signed random projections: 6 tables of 8 planes, 32 codes of each looked into.
_ANN = f"""planes AS (
  SELECT p, (p - 1) // 8 AS t, (p - 1) % 8 AS bit,
         [(1 - 2 * (bit_count(p & d) & 1)) * (1 - 2 * ((((d + 1) * 40503) >> 7) & 1)) FOR d IN range(0, 64)]::DOUBLE[] AS signs
  FROM range(1, 49) r(p)),
sides AS (
  SELECT vec_id, t, bit, round(list_dot_product(embedding::DOUBLE[], signs), 6) AS z FROM embeddings, planes),
codes AS (SELECT vec_id, t, sum(CASE WHEN z >= 0 THEN 1 << bit ELSE 0 END)::INT AS code FROM sides GROUP BY ALL),
costs AS (
  SELECT vec_id, t, flips, round(coalesce(sum(z * z) FILTER (WHERE (flips >> bit) & 1 = 1), 0), 6) AS cost
  FROM sides, range(0, 256) f(flips) GROUP BY ALL),
looks AS (
  SELECT vec_id, t, xor(code, flips::INT) AS code FROM codes JOIN (
    SELECT *, row_number() OVER (PARTITION BY vec_id, t ORDER BY cost, flips) AS place FROM costs) USING (vec_id, t)
  WHERE place <= 32),
met AS (SELECT DISTINCT a.vec_id AS query_id, b.vec_id AS id FROM looks a JOIN codes b USING (t, code) WHERE a.vec_id <> b.vec_id),
{_PAIRS}, {_top('exact', 'pairs', 5)}, {_top('found', '(SELECT pairs.* FROM pairs JOIN met USING (query_id, id))', 5)}"""
ORACLE["ann_topk"] = f"WITH {_ANN} SELECT query_id, id, rank, score FROM found"
ORACLE["ann_recall"] = f"""WITH {_ANN}
SELECT query_id, count(*) AS n_exact, count(f.id) AS n_found, round(count(f.id) / count(*), 6) AS recall
FROM exact e LEFT JOIN found f USING (query_id, id) GROUP BY query_id"""

_MEANS = """comp AS (SELECT label, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings),
means AS (SELECT label::BIGINT AS query_id, list(m ORDER BY i) AS mean
          FROM (SELECT label, i, avg(x) AS m FROM comp GROUP BY label, i) GROUP BY label),
cos AS (SELECT query_id, vec_id AS id,
          round(list_dot_product(mean, embedding::DOUBLE[]) / (sqrt(list_dot_product(mean, mean))
            * sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]))), 6) AS score
        FROM means, embeddings)"""
ORACLE["cosine_rank"] = f"""WITH {_MEANS}
SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank, score FROM cos"""
ORACLE["similarity_matrix"] = f"WITH {_MEANS} SELECT query_id, id, score AS similarity FROM cos"
ORACLE["semantic_cache_lookup"] = f"""WITH {_MEANS},
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, query_id) AS r
                        FROM cos) WHERE r = 1 AND score >= {CACHE_THRESHOLD})
SELECT vec_id AS query_id, best.query_id AS cache_id, score, 'answer ' || best.query_id AS cached_response
FROM embeddings LEFT JOIN best ON best.id = vec_id"""

_COMPONENTS = ", ".join(f"round(embedding[{i + 1}]::DOUBLE, 6) AS c{i}" for i in range(5))
ORACLE["vector_profile"] = f"""
SELECT vec_id AS id, len(embedding)::INT AS dim, round(norm, 6) AS norm, {_COMPONENTS},
       list_bool_and(list_transform(embedding::DOUBLE[], lambda x:
         abs(x - x / norm) <= 1e-8::DOUBLE + 1e-5::DOUBLE * abs(x / norm))) AS is_unit
FROM (SELECT *, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS norm FROM embeddings)"""

ORACLE["mmr_rerank"] = f"""
WITH {_PAIRS}, {_top('pool', 'pairs', 5)},
sims AS (SELECT a.query_id, a.id AS id, b.id AS other,
                list_dot_product(x.embedding::DOUBLE[], y.embedding::DOUBLE[]) AS sim
         FROM pool a JOIN pool b ON a.query_id = b.query_id
         JOIN embeddings x ON x.vec_id = a.id JOIN embeddings y ON y.vec_id = b.id),
p1 AS (SELECT query_id, id, score FROM pool WHERE rank = 1),
c2 AS (SELECT pool.query_id, pool.id, pool.score, pool.rank,
              round(0.5::DOUBLE * pool.score - 0.5::DOUBLE * greatest(-1.0::DOUBLE, sim), 6) AS v
       FROM pool JOIN p1 USING (query_id)
       JOIN sims ON sims.query_id = pool.query_id AND sims.id = pool.id AND sims.other = p1.id
       WHERE pool.id <> p1.id),
p2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY v DESC, rank) AS r FROM c2) WHERE r = 1),
c3 AS (SELECT c2.query_id, c2.id, c2.score, c2.rank,
              round(0.5::DOUBLE * c2.score - 0.5::DOUBLE * greatest(-1.0::DOUBLE, s1.sim, s2.sim), 6) AS v
       FROM c2 JOIN p1 USING (query_id) JOIN p2 ON p2.query_id = c2.query_id
       JOIN sims s1 ON s1.query_id = c2.query_id AND s1.id = c2.id AND s1.other = p1.id
       JOIN sims s2 ON s2.query_id = c2.query_id AND s2.id = c2.id AND s2.other = p2.id
       WHERE c2.id <> p2.id),
p3 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY v DESC, rank) AS r FROM c3) WHERE r = 1)
SELECT query_id, id, 1 AS rank, score FROM p1
UNION ALL SELECT query_id, id, 2, score FROM p2
UNION ALL SELECT query_id, id, 3, score FROM p3"""

_REPLAY = f"""
WITH RECURSIVE seq AS (
  SELECT label::BIGINT AS tenant, vec_id AS id, embedding::DOUBLE[] AS v,
         row_number() OVER (PARTITION BY label ORDER BY vec_id) AS n FROM embeddings),
near AS (
  SELECT a.tenant, a.n, a.id, b.id AS other, round(list_cosine_similarity(a.v, b.v), 6) AS score
  FROM seq a JOIN seq b ON a.tenant = b.tenant AND b.n < a.n),
close AS (SELECT * FROM near WHERE score >= {CACHE_THRESHOLD}),
adj AS (SELECT seq.tenant, seq.n, seq.id, coalesce(list(other) FILTER (WHERE other IS NOT NULL), []) AS others
        FROM seq LEFT JOIN close ON close.tenant = seq.tenant AND close.n = seq.n GROUP BY ALL),
run AS (
  SELECT tenant, n, [id] AS misses FROM adj WHERE n = 1
  UNION ALL
  SELECT adj.tenant, adj.n, CASE WHEN list_has_any(misses, others) THEN misses ELSE list_append(misses, adj.id) END
  FROM run JOIN adj ON adj.tenant = run.tenant AND adj.n = run.n + 1),
missed AS (SELECT tenant, unnest(misses) AS other
           FROM (SELECT tenant, arg_max(misses, n) AS misses FROM run GROUP BY tenant)),
best AS (SELECT tenant, id, arg_min(other, (-score, other)) AS cache_id, max(score) AS score
         FROM close JOIN missed USING (tenant, other) GROUP BY tenant, id)
SELECT seq.tenant, seq.id, cache_id IS NOT NULL AS is_hit, cache_id, score
FROM seq LEFT JOIN best ON best.tenant = seq.tenant AND best.id = seq.id"""
ORACLE["semantic_cache_replay"] = _REPLAY
ORACLE["stream_cache"] = _REPLAY

# --- sparse and fused retrieval --------------------------------------------------------------

ORACLE["bm25_topk"] = f"WITH {_bm25('bm', 4)} SELECT query_id, id, rank, score FROM bm"
ORACLE["bm25_merged"] = ORACLE["bm25_topk"]
ORACLE["bm25_incremental"] = ORACLE["bm25_topk"]
ORACLE["stream_ingest"] = ORACLE["bm25_topk"]
ORACLE["dense_text_topk"] = f"WITH {_dense('de', 4)} SELECT query_id, id, rank, score FROM de"
ORACLE["hybrid_search"] = f"WITH {_bm25('bm', 4)}, {_dense('de', 4)}, {_fuse([('bm', 0.5), ('de', 0.5)], 4)}"
ORACLE["ensemble_search"] = (
    f"WITH {_bm25('bm', 2)}, {_dense('de', 2)}, {_fuse([('bm', 0.4), ('de', 0.6)], None, 1)}")
ORACLE["rrf_fusion"] = f"""
WITH good AS (SELECT * FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
{_bm25('bm', 3)}, {_dense('de', 3)}, {_bm25('gd', 3, 'good')},
{_fuse([('bm', 0.5), ('de', 0.3), ('gd', 0.2)], 3)}"""

_VARIANTS = f"""(SELECT item_id * 1048576 + (generate_subscripts(s, 1) - 1) AS query_id, unnest(s) AS txt
                FROM (SELECT item_id, {_sentences('text')} AS s FROM benchmark))"""
_MULTI = f"""{_dense('de', 2, _VARIANTS)},
mq AS (SELECT query_id // 1048576 AS query_id, id, max(score) AS score, count(*) AS n_variants
       FROM de GROUP BY query_id // 1048576, id)"""
ORACLE["multi_query_union"] = f"WITH {_MULTI} SELECT query_id, id, score, n_variants FROM mq"


def _compress(ranked: str, extra: str) -> str:
    group = f"GROUP BY query_id, id, text{extra}"
    return f"""
hits AS (SELECT query_id, id{extra}, text FROM {ranked} JOIN documents d ON d.doc_id = id),
sent AS (SELECT query_id, id, generate_subscripts(s, 1) AS n, unnest(s) AS txt
         FROM (SELECT query_id, id, {_sentences('text')} AS s FROM hits)),
{_sparse('sv', 'sent', 'query_id, id, n')},
{_sparse('qv', '(SELECT item_id AS query_id, text AS txt FROM benchmark)', 'query_id')},
sc AS (SELECT sv.query_id, sv.id, n, round(sum(sv.w * qv.w), 6) AS s
       FROM sv JOIN qv ON sv.query_id = qv.query_id AND sv.b = qv.b GROUP BY ALL)
SELECT query_id, id{extra}, string_agg(txt, ' ' ORDER BY n) AS compressed, length(text)::INT AS chars_before,
       length(string_agg(txt, ' ' ORDER BY n))::INT AS chars_after
FROM hits JOIN sent USING (query_id, id) JOIN sc USING (query_id, id, n)
WHERE s >= {COMPRESS_THRESHOLD} {group}"""


ORACLE["compress_context"] = f"WITH {_bm25('bm', 2)}, {_compress('bm', ', rank, score')}"
ORACLE["advanced_retrieval"] = f"WITH {_MULTI}, {_compress('mq', '')}"

# --- context, prompts, attribution -----------------------------------------------------------


def _texts(k: int) -> str:
    return f"""{_bm25('bm', k)},
r AS (SELECT query_id, rank, id, text, lang, source FROM bm JOIN documents d ON d.doc_id = bm.id)"""


ORACLE["context_plain"] = f"""WITH {_texts(2)}
SELECT query_id, string_agg(text, E'\\n\\n' ORDER BY rank) AS context, count(*) AS n_chunks FROM r GROUP BY query_id"""
ORACLE["context_sources"] = f"""WITH {_texts(3)}
SELECT query_id,
  string_agg('Source (' || coalesce(source, 'unknown') || '): ' || text, E'\\n---\\n' ORDER BY rank) AS by_source,
  string_agg('[' || rank || '] Source ' || coalesce(source, 'unknown') || E':\\n' || text, E'\\n\\n' ORDER BY rank) AS numbered,
  string_agg('[' || coalesce(source, 'unknown') || ']: ' || text, E'\\n\\n' ORDER BY rank) AS bracketed
FROM r GROUP BY query_id"""


def _provenance(source: str) -> str:
    return f"""
prov AS (SELECT *, source || CASE lang WHEN 'en' THEN '.md' WHEN 'de' THEN '.csv' WHEN 'fr' THEN '.json' ELSE '.txt' END AS file_name,
  CASE lang WHEN 'en' THEN 'Markdown' WHEN 'de' THEN 'CSV' WHEN 'fr' THEN 'JSON' ELSE 'Text' END AS file_type,
  CASE lang WHEN 'de' THEN 'Row ' || id WHEN 'fr' THEN 'Record #' || (id + 1) ELSE 'Full Document' END AS location
  FROM {source} WHERE lang IN ('en', 'de', 'fr', 'es'))"""


ORACLE["context_headers"] = f"""WITH {_texts(3)}, {_provenance('r')}
SELECT query_id, string_agg('[FILE: ' || file_name || ' | TYPE: ' || file_type || ' | LOCATION: ' || location || E']\\n' || text,
       E'\\n\\n---\\n\\n' ORDER BY rank) AS context, count(*) AS n_chunks FROM prov GROUP BY query_id"""
ORACLE["prompt_build"] = f"""WITH {_texts(2)},
c AS (SELECT query_id, string_agg(text, E'\\n' ORDER BY rank) AS context FROM r GROUP BY query_id)
SELECT query_id, E'Answer the question briefly, from the context alone.\\n\\nContext:\\n' || context || E'\\n\\nQuestion: ' || b.text AS prompt
FROM c JOIN benchmark b ON b.item_id = query_id"""
ORACLE["source_attribution"] = f"""WITH {_texts(5)}, {_provenance('r')},
k AS (SELECT query_id, file_name, file_type, CASE location WHEN 'Full Document' THEN 'N/A' ELSE location END AS location,
             min(rank) AS first_rank FROM prov GROUP BY ALL)
SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY first_rank, file_name, file_type, location)::INT AS source_no FROM k"""
ORACLE["normalize_metadata"] = f"""
WITH d AS (SELECT doc_id AS id, source, lang, text FROM documents), {_provenance('d')}
SELECT id, file_name, file_type, location, length(text)::INT AS text_chars FROM prov"""
ORACLE["parse_answers"] = """
SELECT conv_id, turn, text AS answer, 0 AS source_no, 'conv-' || conv_id || '.json' AS file_name, 'JSON' AS file_type,
       'Record #' || (turn + 1) AS location FROM conversations WHERE role = 'assistant'
UNION ALL
SELECT conv_id, turn, text, 1, 'manual.md', 'Markdown', 'Full Document' FROM conversations WHERE role = 'assistant'"""

ORACLE["parse_graded_answers"] = """
SELECT conv_id, turn, CASE WHEN ok THEN text END AS answer,
       CASE WHEN ok THEN CASE WHEN length(text) >= 200 THEN 'high' WHEN length(text) >= 80 THEN 'medium' ELSE 'low' END END AS confidence,
       CASE WHEN ok THEN array_to_string(list_transform(range(turn % 3 + 1), lambda i: 'part-' || i), ',') END AS sources_used,
       CASE WHEN ok AND turn % 2 = 1 THEN 'What follows turn ' || turn || '?' END AS follow_up
FROM (SELECT *, conv_id % 7 <> 3 AS ok FROM conversations WHERE role = 'assistant')"""

# --- chunking --------------------------------------------------------------------------------


_PLAIN = ("chr(10) || chr(10)", "chr(10)", "' '")


def _recursive(name: str, source: str, size: int, overlap: int, marks: tuple[str, ...] = _PLAIN) -> str:
    """CTEs that end in ``name`` (id, chunk_no, chunk), from ``source`` rows (id, txt).

    Stated by character offsets. Each separator in turn cuts the texts that are still too long;
    pieces that fit form runs between the ones that do not. Within a run every possible chunk
    start has one end and one next start, and the chunks are those reached from the first piece.
    """
    n, out, runs = name, [f"{name}_0 AS (SELECT id, 0 AS b, txt FROM {source})"], []
    for level, mark in enumerate(marks):
        here, after = f"{n}_{level}", f"{n}_{level + 1}"
        out.append(f"""
{here}p AS (SELECT id, b AS node, txt, string_split(txt, {mark}) AS parts FROM {here} WHERE contains(txt, {mark})),
{here}q AS (SELECT id, node, generate_subscripts(parts, 1) AS i, unnest(parts) AS part FROM {here}p),
{here}r AS (SELECT id, node, i, CASE WHEN i > 1 THEN {mark} ELSE '' END || part AS txt FROM {here}q),
{here}s AS (SELECT *, node + coalesce(sum(length(txt)) OVER (PARTITION BY id, node ORDER BY i
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b,
              sum(CASE WHEN length(txt) > {size} THEN 1 ELSE 0 END) OVER (PARTITION BY id, node ORDER BY i) AS run
       FROM {here}r WHERE txt <> ''),
{after} AS (SELECT id, b, txt FROM {here} WHERE NOT contains(txt, {mark})
            UNION ALL SELECT id, b, txt FROM {here}s WHERE length(txt) > {size})""")
        runs.append(f"SELECT id, {level} AS level, node, run, b, b + length(txt) AS e FROM {here}s WHERE length(txt) <= {size}")
    out.append(f"""
{n}_win AS (SELECT id, b + w AS b, b + least(w + {size}, length(txt)) AS e
            FROM (SELECT id, b, txt, unnest(range(0, greatest(length(txt) - {overlap}, 1), {size - overlap})) AS w
                  FROM {n}_{len(marks)} WHERE txt <> '')),
{n}_leaf AS (SELECT *, row_number() OVER (PARTITION BY id, level, node, run ORDER BY b) AS i,
                    lead(e) OVER (PARTITION BY id, level, node, run ORDER BY b) AS next_e FROM ({' UNION ALL '.join(runs)})),
{n}_end AS (SELECT x.id, x.level, x.node, x.run, x.i, x.b, y.e, y.next_e,
                   greatest(y.e - {overlap}, y.next_e - {size}) AS from_b, x.b + {size} AS lim
            FROM (SELECT *, b + {size} AS lim FROM {n}_leaf) x ASOF JOIN {n}_leaf y
              ON x.id = y.id AND x.level = y.level AND x.node = y.node AND x.run = y.run AND x.lim >= y.e),
{n}_next AS (SELECT x.*, y.i AS next_i FROM {n}_end x ASOF LEFT JOIN {n}_leaf y
              ON x.id = y.id AND x.level = y.level AND x.node = y.node AND x.run = y.run AND x.from_b <= y.b),
{n}_walk AS (
  SELECT id, level, node, run, b, e, CASE WHEN next_e IS NOT NULL THEN next_i END AS next_i FROM {n}_next WHERE i = 1
  UNION ALL
  SELECT t.id, t.level, t.node, t.run, t.b, t.e, CASE WHEN t.next_e IS NOT NULL THEN t.next_i END
  FROM {n}_walk w JOIN {n}_next t ON t.id = w.id AND t.level = w.level AND t.node = w.node AND t.run = w.run AND t.i = w.next_i),
{n}_cut AS (SELECT id, b, e FROM {n}_walk UNION ALL SELECT id, b, e FROM {n}_win),
{n}_txt AS (SELECT c.id, b, regexp_replace(substr(txt, (b + 1)::BIGINT, (e - b)::BIGINT), '^\\s+|\\s+$', '', 'g') AS chunk
            FROM {n}_cut c JOIN {source} USING (id)),
{n} AS (SELECT id, (row_number() OVER (PARTITION BY id ORDER BY b) - 1)::INT AS chunk_no, chunk
        FROM {n}_txt WHERE chunk <> '')""")
    return ",\n".join(out)


_DOCS = "docs AS (SELECT doc_id AS id, text AS txt FROM documents)"
ORACLE["recursive_chunk"] = f"""WITH RECURSIVE {_DOCS}, {_recursive('rc', 'docs', 300, 30)}
SELECT id AS doc_id, lang, chunk_no, chunk, length(chunk)::INT AS n_chars FROM rc JOIN documents ON doc_id = id"""
_CODE = """code AS (SELECT doc_id AS id, 'class ' || lang || ':' || chr(10) || replace(replace(replace(text, '. ', '.' || chr(10) || 'def '),
              ', ', chr(10) || chr(9) || 'def '), '? ', chr(10) || 'class ') AS txt FROM documents)"""
_PYTHON = ("chr(10) || 'class '", "chr(10) || 'def '", "chr(10) || chr(9) || 'def '", *_PLAIN)
ORACLE["code_chunk"] = f"""WITH RECURSIVE {_CODE}, {_recursive('cc', 'code', 200, 0, _PYTHON)}
SELECT id AS doc_id, lang, chunk_no, chunk, length(chunk)::INT AS n_chars FROM cc JOIN documents ON doc_id = id"""
ORACLE["chunk_overlap"] = f"""
WITH RECURSIVE {_DOCS}, {_recursive('a', 'docs', 70, 0)}, {_recursive('z', 'docs', 70, 25)},
both_ AS (SELECT 0 AS overlap, id, chunk FROM a UNION ALL SELECT 25, id, chunk FROM z)
SELECT overlap, lang, count(*) AS n_chunks, sum(length(chunk))::BIGINT AS n_chars
FROM both_ JOIN documents ON doc_id = id GROUP BY overlap, lang"""

_FAMILY = f"""{_DOCS}, {_recursive('pa', 'docs', 600, 50)},
parents AS (SELECT (id * 1048576 + chunk_no)::BIGINT AS id, id AS doc_id, chunk_no AS parent_no, chunk AS txt FROM pa),
{_recursive('ch', 'parents', 150, 15)},
children AS (SELECT p.doc_id, p.id AS parent_id, c.chunk_no AS child_no, c.chunk AS child, p.id * 1024 + c.chunk_no AS child_id
             FROM ch c JOIN parents p ON p.id = c.id)"""
ORACLE["parent_child_chunks"] = f"WITH RECURSIVE {_FAMILY} SELECT doc_id, (parent_id % 1048576)::INT AS parent_no, child_no, child FROM children"
ORACLE["parent_retrieve"] = f"""
WITH RECURSIVE {_FAMILY},
{_sparse('cq', '(SELECT item_id AS query_id, text AS txt FROM benchmark)', 'query_id')},
{_sparse('cd', '(SELECT child_id AS id, child AS txt FROM children)', 'id')},
cs AS (SELECT query_id, id, round(sum(q.w * d.w), 6) AS score FROM cq q JOIN cd d USING (b) GROUP BY query_id, id),
{_top('best', 'cs', 4)},
hit AS (SELECT query_id, id // 1024 AS parent_id, min(rank) AS best_child_rank, max(score) AS score FROM best GROUP BY ALL)
SELECT query_id, doc_id, (parent_id % 1048576)::INT AS parent_no, row_number() OVER (PARTITION BY query_id ORDER BY best_child_rank, parent_id)::INT AS rank,
       best_child_rank, score, txt AS parent
FROM hit JOIN parents p ON p.id = parent_id"""

_SEMANTIC = f"""
sent AS (SELECT doc_id, lang, generate_subscripts(s, 1) AS n, unnest(s) AS txt
         FROM (SELECT doc_id, lang, {_sentences('text')} AS s FROM documents)),
{_sparse('sv', 'sent', 'doc_id, n')},
dots AS (SELECT a.doc_id, b.n, sum(a.w * b.w) AS dot
         FROM sv a JOIN sv b ON a.doc_id = b.doc_id AND b.n = a.n + 1 AND a.b = b.b GROUP BY ALL),
gaps AS (SELECT sent.doc_id, sent.n, round(1.0::DOUBLE - coalesce(dot, 0), 6) AS gap
         FROM sent LEFT JOIN dots ON dots.doc_id = sent.doc_id AND dots.n = sent.n WHERE sent.n > 1),
sorted AS (SELECT doc_id, list(gap ORDER BY gap) AS g, (count(*) - 1) * 0.9::DOUBLE AS place FROM gaps GROUP BY doc_id),
lim AS (SELECT doc_id, g[floor(place)::INT + 1]
          + (coalesce(g[floor(place)::INT + 2], g[floor(place)::INT + 1]) - g[floor(place)::INT + 1]) * (place - floor(place)) AS lim
        FROM sorted),
cut AS (SELECT sent.doc_id, lang, sent.n, txt,
               sum(CASE WHEN gap > lim THEN 1 ELSE 0 END) OVER (PARTITION BY sent.doc_id ORDER BY sent.n) AS c
        FROM sent LEFT JOIN gaps ON gaps.doc_id = sent.doc_id AND gaps.n = sent.n
        LEFT JOIN lim ON lim.doc_id = sent.doc_id),
sem AS (SELECT doc_id, lang, c::INT AS chunk_no, string_agg(txt, ' ' ORDER BY n) AS chunk FROM cut GROUP BY doc_id, lang, c)"""
ORACLE["semantic_chunk"] = f"""
WITH {_SEMANTIC} SELECT doc_id, lang, chunk_no, chunk, length(chunk)::INT AS n_chars FROM sem"""
ORACLE["smart_chunk"] = f"""
WITH RECURSIVE {_SEMANTIC}, {_DOCS}, {_recursive('rc', 'docs', 500, 50)},
bad AS (SELECT doc_id FROM sem GROUP BY doc_id HAVING max(length(chunk)) > 1000
        UNION SELECT doc_id FROM sent WHERE len({_tokens('txt')}) = 0),
both_ AS (SELECT doc_id, false AS used_fallback, chunk_no, chunk FROM sem WHERE doc_id NOT IN (SELECT doc_id FROM bad)
          UNION ALL SELECT id, true, chunk_no, chunk FROM rc WHERE id IN (SELECT doc_id FROM bad))
SELECT b.doc_id, d.lang, used_fallback, chunk_no, chunk, length(chunk)::INT AS n_chars
FROM both_ b JOIN documents d ON d.doc_id = b.doc_id"""
ORACLE["chunk_strategy_stats"] = f"""
WITH RECURSIVE {_SEMANTIC}, {_DOCS}, {_recursive('rc', 'docs', 150, 20)},
rows_ AS (SELECT 'semantic' AS strategy, doc_id, chunk FROM sem UNION ALL SELECT 'recursive', id, chunk FROM rc)
SELECT strategy, lang, count(*) AS n_chunks, round(avg(length(chunk)), 6) AS avg_chars,
       min(length(chunk))::INT AS min_chars, max(length(chunk))::INT AS max_chars
FROM rows_ JOIN documents USING (doc_id) GROUP BY strategy, lang"""


# The character references that the pages hold; ``&amp;`` is last, so nothing is decoded twice.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": " ", "&copy;": "©",
            "&middot;": "·", "&amp;": "&"}


def _unescape(expr: str) -> str:
    for name, char in ENTITIES.items():
        char = char.replace("'", "''")
        expr = f"replace({expr}, '{name}', '{char}')"
    return expr


_HIDDEN = "regexp_replace(html, '(?is)<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>|<!--.*?-->', ' ', 'g')"
_BARE = f"regexp_replace({_HIDDEN}, '(?s)<[^>]*>', ' ', 'g')"
ORACLE["html_to_text"] = (
    f"SELECT page_id, url, trim(regexp_replace({_unescape(_BARE)}, '\\s+', ' ', 'g')) AS text FROM pages")


def _headed() -> str:
    out = f"regexp_replace({_HIDDEN}, '\\s+', ' ', 'g')"
    for level in (1, 2, 3):
        out = f"regexp_replace({out}, '(?i)<h{level}\\b[^>]*>', chr(10) || '{'#' * level} ', 'g')"
    out = (f"regexp_replace({out}, '(?i)</h[1-6]\\s*>|</?(p|br|li|div|tr|nav|article|footer)\\b[^>]*>', "
           "chr(10), 'g')")
    out = _unescape(f"regexp_replace({out}, '(?s)<[^>]*>', ' ', 'g')")
    out = f"regexp_replace({out}, '[ \\t]+', ' ', 'g')"
    return f"trim(regexp_replace({out}, ' ?\\n[ \\n]*', chr(10), 'g'))"


ORACLE["header_chunk"] = f"""
WITH lines AS (SELECT page_id, generate_subscripts(l, 1) AS n, unnest(l) AS line
               FROM (SELECT page_id, string_split({_headed()}, chr(10)) AS l FROM pages)),
lev AS (SELECT *, length(regexp_extract(line, '^\\s*(#{{1,3}})\\s+(.*?)\\s*$', 1)) AS lev,
               regexp_extract(line, '^\\s*(#{{1,3}})\\s+(.*?)\\s*$', 2) AS title FROM lines),
sec AS (SELECT *, sum(CASE WHEN lev > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY n) AS s,
        max(CASE WHEN lev = 1 THEN n END) OVER w AS n1, max(CASE WHEN lev IN (1, 2) THEN n END) OVER w AS n2,
        max(CASE WHEN lev > 0 THEN n END) OVER w AS n3
        FROM lev WINDOW w AS (PARTITION BY page_id ORDER BY n)),
body AS (SELECT page_id, s, max(n1) AS n1, max(n2) AS n2, max(n3) AS n3,
                trim(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE lev = 0)) AS chunk
         FROM sec GROUP BY page_id, s)
SELECT body.page_id, (row_number() OVER (PARTITION BY body.page_id ORDER BY s) - 1)::INT AS chunk_no,
       a.title AS h1, CASE WHEN b.lev = 2 THEN b.title END AS h2, CASE WHEN c.lev = 3 THEN c.title END AS h3, chunk
FROM body LEFT JOIN lev a ON a.page_id = body.page_id AND a.n = n1
LEFT JOIN lev b ON b.page_id = body.page_id AND b.n = n2
LEFT JOIN lev c ON c.page_id = body.page_id AND c.n = n3
WHERE coalesce(chunk, '') <> ''"""
ORACLE["chunk_preview"] = """
SELECT doc_id, substr(trim(replace(text, chr(10), ' ')), 1, 120) AS preview, length(text)::INT AS n_chars FROM documents"""

# --- sources and stores ----------------------------------------------------------------------

ORACLE["src_text"] = """
SELECT source, 'Text' AS file_type, 'Full Document' AS location, sum(length(text) + 1)::BIGINT AS n_chars
FROM documents GROUP BY source"""
ORACLE["row_to_document"] = """
SELECT 'n_nationkey: ' || n_nationkey || E'\\nn_name: ' || n_name || E'\\nn_regionkey: ' || n_regionkey AS text,
       'CSV' AS file_type, 'Row ' || (row_number() OVER (ORDER BY n_nationkey) - 1) AS location FROM nation"""
ORACLE["json_records"] = """
SELECT conv_id, turn // 100 AS page, row_number() OVER (PARTITION BY conv_id, turn // 100 ORDER BY turn) AS record_no,
       role, text FROM conversations"""
ORACLE["json_files"] = """
SELECT conv_id // 200 AS part, 'JSON' AS file_type,
       'Record #' || row_number() OVER (PARTITION BY conv_id // 200 ORDER BY conv_id, turn) AS location, conv_id, turn, role, text
FROM conversations"""
ORACLE["ingest_directory"] = " UNION ALL ".join(
    f"SELECT 'CSV' AS file_type, '{name}' AS folder, 0 AS chunk_no, "
    + " || E'\\n' || ".join(f"'{c}: ' || trim({c}::VARCHAR)" for c in columns) + f" AS chunk FROM {name}"
    for name, columns in DIRECTORY.items())
ORACLE["page_location"] = """
SELECT url AS file_name, 'PDF' AS file_type, 'Page ' || (page_id + 1) AS location, length(html)::INT AS n_chars FROM pages"""
ORACLE["persist_reload_count"] = "SELECT label, count(*) AS n_vectors FROM embeddings GROUP BY label"
_DIGEST_PARTS = ", ".join(f"round(coalesce(max(v) FILTER (WHERE b = {i}), 0), 6) AS c{i}" for i in range(5))
_DIGEST = f"""
WITH d AS (SELECT doc_id AS id, text AS txt FROM documents),
{_sparse('sv', 'd', 'id')},
f AS (SELECT id, b, w::FLOAT::DOUBLE AS v FROM sv)
SELECT d.id, {DIM} AS dim, (count(*) FILTER (WHERE v <> 0))::INT AS n_nonzero, round(coalesce(sqrt(sum(v * v)), 0), 6) AS norm,
       round(coalesce(sum(v * (b + 1)), 0), 4) AS weighted, {_DIGEST_PARTS}
FROM d LEFT JOIN f ON f.id = d.id GROUP BY d.id"""
ORACLE["embed_documents"] = _DIGEST
ORACLE["embed_query_prompt"] = _DIGEST.replace(
    "SELECT doc_id AS id, text AS txt FROM documents", f"SELECT item_id AS id, '{QUERY_PROMPT}' || text AS txt FROM benchmark")
ORACLE["embedding_cache_fill"] = _DIGEST
ORACLE["embedding_cache_misses"] = """
SELECT sha256(text) AS content_hash, length(text)::INT AS n_chars FROM (SELECT DISTINCT text FROM documents)
WHERE text NOT IN (SELECT text FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))"""

# --- usage -----------------------------------------------------------------------------------

_WORDS = "len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''))"
ORACLE["token_estimate"] = f"""
SELECT doc_id, {_WORDS}::INT AS n_words, floor({_WORDS} * 1.33::DOUBLE)::INT AS n_tokens FROM documents"""
ORACLE["token_preflight"] = f"""
SELECT conv_id, turn, e AS estimated_tokens, e <= {BUDGET} AS allowed,
  CASE WHEN e > {BUDGET} THEN 'Blocked: Query estimation (' || e || ' tokens) exceeds budget cap ({BUDGET}).' END AS reason
FROM (SELECT *, floor({_WORDS} * 1.33::DOUBLE)::INT AS e FROM conversations)"""

_REQ = """
k AS (SELECT *, (props->>'$.k')::BIGINT AS k FROM events),
req AS (SELECT *, CASE event_type WHEN 'purchase' THEN E' Complex query.\\n' WHEN 'signup' THEN 'COMPLEX'
                       WHEN 'view' THEN 'Simple' ELSE 'not sure' END AS decision,
        CASE WHEN event_type IN ('purchase', 'signup') THEN 'complex' ELSE 'simple' END AS tier,
        CASE WHEN event_type = 'signup' THEN 0 ELSE k END AS p, CASE WHEN event_type = 'signup' THEN 0 ELSE k * 3 + 1 END AS c,
        CASE event_type WHEN 'signup' THEN 'unknown-model' WHEN 'purchase' THEN 'llama-3.3-70b' ELSE 'llama-3.1-8b' END AS model
        FROM k)"""
_TEL = f"""{_REQ},
tel AS (SELECT event_id AS request_id, ts, value AS latency_ms,
        CASE WHEN event_type = 'error' THEN 0 ELSE p END AS prompt_tokens,
        CASE WHEN event_type = 'error' THEN 0 ELSE c END AS completion_tokens,
        CASE WHEN event_type = 'error' THEN 0 ELSE p + c END AS total_tokens,
        CASE WHEN event_type = 'error' THEN 'llama-3.1-8b' ELSE model END AS model_name,
        CASE WHEN event_type = 'error' THEN 'FAILED: TimeoutError' ELSE 'SUCCESS' END AS status FROM req)"""
ORACLE["usage_extract"] = f"""WITH {_REQ}
SELECT event_id AS request_id, p AS prompt_tokens, c AS completion_tokens, model AS model_name FROM req"""
ORACLE["usage_summary"] = f"""WITH {_REQ}
SELECT sum(p)::BIGINT AS total_input_tokens, sum(c)::BIGINT AS total_output_tokens, count(*) AS successful_requests,
       sum(p + c)::BIGINT AS cumulative_tokens_used, round(sum(p + c)::DOUBLE / greatest(count(*), 1), 2) AS avg_tokens_per_call
FROM req WHERE event_type <> 'error'"""
ORACLE["cost_by_tier"] = f"""WITH {_REQ},
s AS (SELECT tier, count(*) AS requests, sum(p)::BIGINT AS prompt_tokens, sum(c)::BIGINT AS completion_tokens
      FROM req WHERE event_type <> 'error' AND NOT coalesce(k < 30, false) GROUP BY tier),
pr AS (SELECT * FROM (VALUES ('simple', 'llama-3.1-8b', 0.05::DOUBLE, 0.08::DOUBLE),
                             ('complex', 'llama-3.3-70b', 0.59::DOUBLE, 0.79::DOUBLE)) t(tier, price_model, i, o))
SELECT tier, price_model, requests, prompt_tokens, completion_tokens, round(prompt_tokens / 1e6 * i, 6) AS input_cost,
       round(completion_tokens / 1e6 * o, 6) AS output_cost,
       round(prompt_tokens / 1e6 * i + completion_tokens / 1e6 * o, 6) AS total_cost FROM s JOIN pr USING (tier)"""
ORACLE["route_parse"] = f"WITH {_REQ} SELECT event_id AS request_id, decision, tier FROM req"
ORACLE["cache_route_stats"] = f"""WITH {_REQ}
SELECT count(*) FILTER (WHERE k < 30) AS cache_hits, count(*) FILTER (WHERE NOT k < 30) AS cache_misses,
       count(*) FILTER (WHERE NOT k < 30 AND tier = 'simple') AS routed_simple,
       count(*) FILTER (WHERE NOT k < 30 AND tier = 'complex') AS routed_complex FROM req"""
ORACLE["telemetry_rows"] = f"""WITH {_TEL}
SELECT request_id, row_number() OVER (ORDER BY ts, request_id) AS request_no, latency_ms, prompt_tokens, completion_tokens,
       total_tokens, model_name, status FROM tel"""
ORACLE["telemetry_json"] = f"""WITH {_TEL}
SELECT '{{"timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00","logger_name":"requests","log_level":"'
  || CASE WHEN status = 'SUCCESS' THEN 'INFO' ELSE 'ERROR' END || '","message":"'
  || CASE WHEN status = 'SUCCESS' THEN 'request served' ELSE 'request failed' END || '","request_id":' || request_id
  || ',"latency_ms":' || latency_ms || ',"prompt_tokens":' || prompt_tokens || ',"completion_tokens":' || completion_tokens
  || ',"total_tokens":' || total_tokens || ',"model_name":"' || model_name || '","status":"' || status || '"}}' AS value FROM tel"""
ORACLE["telemetry_summary"] = f"""WITH {_TEL}
SELECT count(*) AS total_requests_processed, count(*) FILTER (WHERE status <> 'SUCCESS') AS total_exceptions_raised,
  printf('%.2f%%', count(*) FILTER (WHERE status <> 'SUCCESS') / greatest(count(*), 1)::DOUBLE * 100) AS system_error_rate,
  round(sum(round(latency_ms * 1000)::BIGINT) / 1000.0::DOUBLE / greatest(count(*), 1), 2) AS average_response_latency_ms,
  sum(total_tokens)::BIGINT AS cumulative_tokens_consumed,
  round(sum(total_tokens)::DOUBLE / greatest(count(*), 1), 2) AS average_tokens_per_payload FROM tel"""
ORACLE["stream_telemetry"] = ORACLE["telemetry_summary"]
ORACLE["runs_by_tag"] = f"""WITH {_REQ}
SELECT event_id AS request_id, 'user_inbound,' || event_type || ',' || tier AS tags, user_id::VARCHAR AS user_id
FROM req WHERE tier = 'complex' AND user_id % 3 = 0"""
