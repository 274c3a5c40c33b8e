"""DuckDB SQL that the queries must equal, where SQL can say what they do."""

# Words: runs of anything but space, tab, line feed, vertical tab, form feed and carriage return.
_WORD = r"[^\x20\x09-\x0D]+"

OP4 = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(words) - 33)) AS i FROM w WHERE len(words) >= 35),
win AS (SELECT p.doc_id, i, sha256(array_to_string(list_slice(words, i, i + 34), ' ')) AS h FROM p JOIN w USING (doc_id)),
rep AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS j FROM win JOIN rep USING (h), range(35) AS r(k)),
marks AS (SELECT doc_id, list(j) AS js FROM gone GROUP BY doc_id),
words AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS j FROM w),
kept AS (SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.j) AS t FROM words
         LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.j = words.j WHERE gone.j IS NULL GROUP BY words.doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(len(js), 0)::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN marks USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP5 = """
WITH l AS (SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
bad AS (SELECT trim(line, ' ') AS t FROM l WHERE length(trim(line, ' ')) >= 1 GROUP BY 1 HAVING count(DISTINCT source) >= 5),
m AS (SELECT l.doc_id, l.i, l.line, bad.t IS NOT NULL AS gone FROM l LEFT JOIN bad ON trim(l.line, ' ') = bad.t)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

OP6 = rf"""
WITH RECURSIVE
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 4), ' ') AS g
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
inter AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM inter JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
two AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS d, doc_id AS r FROM documents UNION SELECT two.b, reach.r FROM reach JOIN two ON reach.d = two.a)
SELECT d AS doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, min(r) AS component_id, d = min(r) AS kept
FROM reach LEFT JOIN n ON n.doc_id = d GROUP BY d
"""

OP9 = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

def _op12(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Each round as two tables: the nearest entry of every part, the moved entries.
    Squared distances are integers that a DOUBLE holds exactly."""
    def nearest(r: int) -> str:
        return f"""near{r} AS (SELECT vec_id, label, cut.p AS p, any_value(cut.c) AS c,
  min(ROW(list_inner_product(cut.c, cut.c) - 2 * list_inner_product(cut.c, b.c) + list_inner_product(b.c, b.c), b.e)) AS best
 FROM cut JOIN book{r} b ON cut.p = b.p GROUP BY vec_id, label, cut.p)"""

    tables = [f"""kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS (SELECT vec_id, label, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS c FROM kept, range({parts}) t(p)),
book0 AS (SELECT p, e, c FROM (SELECT p, c, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM cut) WHERE e < {entries})"""]
    for r in range(rounds):
        tables += [nearest(r), f"""mean{r} AS (SELECT p, e, list(m ORDER BY i) AS c FROM (
  SELECT p, best[2] AS e, i, floor(sum(c[i]) / count(*)) AS m FROM near{r}, unnest(range(1, len(c) + 1)) u(i) GROUP BY ALL) GROUP BY p, e)""",
                   f"""book{r + 1} AS (SELECT b.p, b.e, coalesce(m.c, b.c) AS c
 FROM book{r} b LEFT JOIN mean{r} m ON b.p = m.p AND b.e = m.e)"""]
    tables += [nearest(rounds), f"""coded AS (SELECT vec_id, label, sum(best[1])::BIGINT AS error,
  string_agg(lpad(lower(hex(best[2])), 2, '0'), '' ORDER BY p) AS code FROM near{rounds} GROUP BY vec_id, label)"""]
    return "WITH " + ",\n".join(tables) + f"""
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
 (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: x::BIGINT), ','), ',' ORDER BY p, e)) FROM book{rounds})
 AS codebooks_sha256 FROM coded"""


# crc32 of the id's digits: bit by bit, with the reversed polynomial.
OP13 = """
WITH t AS (SELECT conv_id, {'r': coalesce(role, ''), 't': coalesce(text, '')} AS said,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(said ORDER BY i) AS s FROM t GROUP BY conv_id),
h AS (SELECT conv_id, s, xor(list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
  lambda crc, b: list_reduce(range(8), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(crc, b)),
  4294967295), 4294967295) % 6 AS h FROM own),
made AS (SELECT h.conv_id, list_concat(list_slice(coalesce(b.s, []), 1, h), list_slice(h.s, h + 1, len(h.s))) AS s
  FROM h LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % 100),
member AS (SELECT conv_id, unnest(range(len(s) + 1)) AS d, len(s) AS n, s FROM made),
node AS (SELECT list_slice(s, 1, d) AS path, d, min(conv_id) AS conv_id, count(*) AS n_convs,
  sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE d = n), '')) AS ends_sha256 FROM member GROUP BY ALL),
child AS (SELECT list_slice(path, 1, d - 1) AS above, count(*) AS n FROM node WHERE d > 0 GROUP BY 1),
grown AS (SELECT node.*, coalesce(child.n, 0) AS n_children FROM node LEFT JOIN child ON child.above = node.path),
below AS (SELECT list_slice(path, 1, u.k) AS top, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END)::BIGINT AS n_leaves,
  sum((n_convs - 1) * coalesce(length(path[d].t), 0))::BIGINT AS saved_tokens FROM grown, unnest(range(d + 1)) u(k) GROUP BY 1)
SELECT g.conv_id, g.d AS depth, p.conv_id AS parent_conv_id, g.n_convs, g.n_children, n_leaves, saved_tokens, g.ends_sha256
FROM grown g JOIN below ON below.top = g.path LEFT JOIN node p ON g.d > 0 AND p.path = list_slice(g.path, 1, g.d - 1)
"""

ORACLE = {"op4_substring_dedup": OP4, "op5_line_dedup": OP5, "op6_minhash": OP6, "op9_exact_dedup": OP9,
          "op12_vector_codes": _op12(), "op13_prefix_trie": OP13}
