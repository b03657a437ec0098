"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(pattern: str) -> str:
    return f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{pattern}')"


_REACH = """reach AS (SELECT id, id AS other FROM ids UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a)"""

SQL: dict[str, str] = {
    "op4_near_vectors": f"""
WITH RECURSIVE ids AS (SELECT DISTINCT vec_id AS id FROM embeddings),
v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
      WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
          WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
{_REACH},
component AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN component c ON c.id = e.vec_id LEFT JOIN n ON n.a = e.vec_id""",
    "op8_ngram_join": f"""
WITH RECURSIVE w AS (SELECT doc_id, {_words('[^\\x20\\x09-\\x0D]+')} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS s
      FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
near AS (SELECT c.a, c.b FROM common c JOIN n x ON x.doc_id = c.a JOIN n y ON y.doc_id = c.b WHERE 100 * c.k >= 80 * (x.n + y.n - c.k)),
links AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
ids AS (SELECT doc_id AS id FROM documents),
{_REACH},
component AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM documents d JOIN component c ON c.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id""",
    "op10_decontaminate": f"""
WITH d AS (SELECT doc_id, {_words('[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')} AS w FROM documents),
b AS (SELECT item_id, {_words('[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')} AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s
        FROM (SELECT item_id, w, least(13, len(w)) AS k, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM win),
places AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k)),
found AS (SELECT a.doc_id, a.k, a.i, w.item_id FROM places a JOIN win w ON w.k = a.k AND w.s = a.s),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS list
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(x.n, 0)::BIGINT AS n_items,
       sha256(coalesce(x.list, '')) AS items_sha256, coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit h ON h.doc_id = d.doc_id LEFT JOIN items x ON x.doc_id = d.doc_id""",
    "op11_collocations": f"""
WITH piece AS (SELECT coalesce(lang, 'und') AS lang,
       unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM piece),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
f AS (SELECT lang, w[i:i + k - 1] AS w, count(*) AS f FROM (SELECT lang, w, i, unnest(range(1, least(5, len(w) - i + 1) + 1)) AS k FROM starts)
      GROUP BY 1, 2 HAVING count(*) >= 100),
c AS (SELECT lang, w, f FROM f WHERE len(w) > 1),
inner_part AS (SELECT lang, w[i:i + k - 1] AS w, max(f) AS longer
          FROM (SELECT lang, w, f, k, unnest(range(1, len(w) - k + 2)) AS i
                FROM (SELECT lang, w, f, unnest(range(2, len(w))) AS k FROM c WHERE len(w) > 2)) GROUP BY 1, 2),
alone AS (SELECT c.* FROM c LEFT JOIN inner_part p ON p.lang = c.lang AND p.w = c.w WHERE p.longer IS NULL OR 100 * p.longer < 100 * c.f),
cuts AS (SELECT lang, w, f AS a, unnest(range(1, len(w))) AS k FROM alone),
weighed AS (SELECT x.lang, x.w, x.a, n.n, x.k, y.f AS l, z.f AS r, ((1000::HUGEINT * x.a * n.n) // (y.f::HUGEINT * z.f))::BIGINT AS score
            FROM cuts x JOIN f y ON y.lang = x.lang AND y.w = x.w[1:x.k] JOIN f z ON z.lang = x.lang AND z.w = x.w[x.k + 1:len(x.w)]
            JOIN n ON n.lang = x.lang),
weakest AS (SELECT *, row_number() OVER (PARTITION BY lang, w ORDER BY score, k) AS o FROM weighed)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM (SELECT *, array_to_string(w, ' ') AS phrase FROM weakest WHERE o = 1) QUALIFY rank <= 2000""",
    "op12_spelling": f"""
WITH RECURSIVE run AS (SELECT coalesce(doc_id::VARCHAR, '') AS id,
       unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS w FROM documents),
counted AS (SELECT w, count(*) AS n, hex(id || ':' || w) AS x FROM run GROUP BY id, w),
-- crc32, a bit at a time
hashed AS (SELECT w, n, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(4 * length(x)),
           lambda k: (('0x' || substr(x, 2 * (k // 8) + 1, 2))::BIGINT >> (k % 8)) & 1)),
           lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)))) AS h FROM counted),
altered AS (SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS w, n FROM hashed),
v AS (SELECT w, sum(n)::BIGINT AS n FROM altered WHERE length(w) >= 5 GROUP BY w HAVING sum(n) >= 3),
part AS (SELECT w, i, substr(w, 1, i - 1) || substr(w, i + 1) AS d FROM (SELECT w, unnest(range(1, length(w) + 1)) AS i FROM v)),
less AS (SELECT DISTINCT p.w AS a, v.w AS b FROM part p JOIN v ON v.w = p.d),
near AS (SELECT a, b FROM less UNION ALL SELECT b, a FROM less
         UNION ALL SELECT x.w, y.w FROM part x JOIN part y ON x.i = y.i AND x.d = y.d AND x.w <> y.w),
best AS (SELECT a, count(*) AS n_near, max(v.n) AS top, arg_min(b, (-v.n, b)) AS b FROM near JOIN v ON v.w = b GROUP BY a),
form AS (SELECT v.w, v.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.top >= 2 * v.n THEN b.b END AS form,
                CASE WHEN b.top >= 2 * v.n THEN b.top END AS form_n FROM v LEFT JOIN best b ON b.a = v.w),
walk AS (SELECT w, w AS at FROM form UNION ALL SELECT walk.w, f.form FROM walk JOIN form f ON f.w = walk.at WHERE f.form IS NOT NULL)
SELECT f.w AS word, f.form, walk.at AS root, f.n, f.n_near::BIGINT AS n_near, f.form_n
FROM form f JOIN walk ON walk.w = f.w JOIN form e ON e.w = walk.at AND e.form IS NULL""",
    "op13_top_k": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s QUALIFY rank <= 5""",
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
