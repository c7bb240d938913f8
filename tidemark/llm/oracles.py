"""DuckDB SQL for the queries that SQL can express, over the same tables."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Components of links(a, b) between ids(id): the smallest id that each reaches.
_COMPONENTS = """
    reach(id, other) AS (
        SELECT id, id FROM ids
        UNION
        SELECT r.id, l.b FROM reach r JOIN (SELECT a, b FROM links UNION ALL SELECT b, a FROM links) l ON r.other = l.a
    ),
    component AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
"""

NEAR_VECTORS = f"""
    WITH RECURSIVE v AS (
        SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
        WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
          AND len([x for x in embedding if x <> 0]) > 0
    ),
    ids AS (SELECT vec_id AS id FROM embeddings),
    links AS (
        SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id < y.vec_id AND len(x.e) = len(y.e)
        WHERE list_cosine_similarity(x.e, y.e) >= 0.95
    ),
    {_COMPONENTS},
    counts AS (SELECT id, count(*) AS n FROM (SELECT a AS id FROM links UNION ALL SELECT b FROM links) GROUP BY id)
    SELECT c.id AS vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, c.id = component_id AS kept
    FROM component c LEFT JOIN counts USING (id)
"""

MINHASH = f"""
    WITH RECURSIVE w AS (
        SELECT doc_id, [x for x in string_split_regex(
            translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\\x20\\x09-\\x0D]+') if x <> ''] AS words FROM documents
    ),
    s AS (
        SELECT doc_id, CASE WHEN len(words) = 0 THEN []::VARCHAR[] WHEN len(words) = 1 THEN words
            ELSE list_distinct([words[i] || ' ' || words[i + 1] for i in range(1, len(words))]) END AS shingles FROM w
    ),
    ids AS (SELECT doc_id AS id FROM s),
    one AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s),
    links AS (
        SELECT x.doc_id AS a, y.doc_id AS b FROM one x JOIN one y ON x.shingle = y.shingle AND x.doc_id < y.doc_id
            AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
        GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
    ),
    {_COMPONENTS}
    SELECT id AS doc_id, len(shingles)::BIGINT AS n_shingles, component_id, id = component_id AS kept
    FROM component JOIN s ON id = doc_id
"""

TOP_K = """
    WITH v AS (
        SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS e FROM embeddings
        WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
    ),
    scores AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_sum([q.e[i] * c.e[i] for i in range(1, len(q.e) + 1)])::BIGINT AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
    )
    SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
    FROM scores QUALIFY rank <= 5
"""

SUFFIX_DEDUP = """
    WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    starts AS (SELECT doc_id, unnest(range(0, len(h) // 2 - 49)) AS pos, h FROM d WHERE len(h) >= 100),
    windows AS (SELECT doc_id, pos, md5_number(substr(h, 2 * pos + 1, 100)) AS w FROM starts),
    first_in AS (SELECT w, min(doc_id) AS low FROM windows GROUP BY w HAVING min(doc_id) < max(doc_id)),
    hits AS (SELECT doc_id, pos FROM windows JOIN first_in USING (w) WHERE low < doc_id),
    spans AS (
        SELECT doc_id, min(pos) AS s, max(pos) + 50 AS e FROM (
            SELECT doc_id, pos, sum(fresh) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM (
                SELECT doc_id, pos, (pos > coalesce(lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + 50, -1))::INT AS fresh FROM hits))
        GROUP BY doc_id, run
    ),
    edges AS (
        SELECT doc_id, count(*) AS n, sum(e - s) AS gone, list(s ORDER BY s) AS ss, list(e ORDER BY s) AS es FROM spans GROUP BY doc_id
    )
    SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(n, 0)::BIGINT AS n_spans,
        sha256(unhex(CASE WHEN n IS NULL THEN h ELSE
            array_to_string([substr(h, 2 * (CASE WHEN i = 0 THEN 0 ELSE es[i] END) + 1, 2 * (
                (CASE WHEN i = n THEN len(h) // 2 ELSE ss[i + 1] END) - (CASE WHEN i = 0 THEN 0 ELSE es[i] END)
            )) for i in range(0, n + 1)], '') END)) AS kept_sha256
    FROM d LEFT JOIN edges USING (doc_id)
"""
