"""DuckDB SQL that says the same as some of the registered queries."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _leaf(*columns: str) -> str:
    fields = [f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns]
    return f"sha256({' || '.join(fields)})"


def _crc32(text: str) -> str:
    """CRC-32 of a text of ASCII characters, bit by bit."""
    bit = "lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END"
    byte = f"list_reduce([xor(a, b), 0::UBIGINT, 0, 0, 0, 0, 0, 0, 0], {bit})"
    codes = f"[ascii(x)::UBIGINT for x in string_split({text}, '')]"
    return f"xor(list_reduce(list_concat([4294967295::UBIGINT], {codes}), lambda a, b: {byte}), 4294967295::UBIGINT)"


def _tree(name: str, leaves: str) -> str:
    """A recursive table of the nodes (g, l, i, n, d) above the leaves (g, i, n, d)."""
    return f"""{name} AS (SELECT g, 0 AS l, i, n, d FROM {leaves}
UNION ALL SELECT g, l + 1, i // 2, (n + 1) // 2, sha256(string_agg(d, '' ORDER BY i)) FROM {name} WHERE n > 1 GROUP BY g, l, i // 2, (n + 1) // 2)"""


def _steps(leaves: str, tree: str) -> str:
    """Each leaf's siblings by level, with the side they stand on."""
    return f"""SELECT b.g, b.i, v.l, coalesce(CASE WHEN (b.i >> v.l) & 1 = 1 THEN 'L' ELSE 'R' END || s.d, '-') AS e
FROM {leaves} b JOIN (SELECT DISTINCT g, l FROM {tree} WHERE n > 1) v USING (g) LEFT JOIN {tree} s ON s.g = b.g AND s.l = v.l AND s.i = xor(b.i >> v.l, 1)"""


MANIFEST = f"""
WITH RECURSIVE
docs AS (SELECT *, coalesce('=' || lang, '') AS g, CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS told FROM documents),
rows AS (SELECT doc_id, g, {_leaf("doc_id", "source", "lang", "n_chars", "text")} AS d, {_leaf("doc_id", "source", "lang", "told", "text")} AS claimed FROM docs),
leaves AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, d) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM rows),
{_tree("low", "leaves")},
groups AS (SELECT '' AS g, g AS name, d, row_number() OVER (ORDER BY encode(g)) - 1 AS i, count(*) OVER () AS n FROM low WHERE n = 1),
{_tree("high", "groups")},
low_steps AS ({_steps("leaves", "low")}),
high_steps AS (SELECT s.*, name FROM ({_steps("groups", "high")}) s JOIN groups USING (i)),
steps AS (SELECT g, i, l, e FROM low_steps UNION ALL SELECT leaves.g, leaves.i, 1000 + h.l, h.e FROM leaves JOIN high_steps h ON h.name = leaves.g),
paths AS (SELECT g, i, string_agg(e[2:], '' ORDER BY l) AS proof, list(e ORDER BY l) AS es FROM steps GROUP BY 1, 2),
folded AS (SELECT doc_id, leaves.d AS leaf, groups.d AS subroot, high.d AS root, coalesce(proof, '') AS proof,
  list_reduce(list_concat([claimed], coalesce(es, [])), lambda a, e: sha256(CASE e[1] WHEN 'L' THEN e[2:] || a WHEN 'R' THEN a || e[2:] ELSE a END)) AS folded_root
  FROM leaves JOIN groups ON groups.name = leaves.g JOIN high ON high.n = 1 LEFT JOIN paths ON paths.g = leaves.g AND paths.i = leaves.i)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified FROM folded"""


def _codes(parts: int = 4, width: int = 16, entries: int = 256, rounds: int = 4) -> str:
    xs = [f"x{j}" for j in range(width)]
    cut = ", ".join(f"v[p * {width} + {j + 1}] AS x{j}" for j in range(width))
    apart = " + ".join(f"(a.{x} - b.{x}) * (a.{x} - b.{x})" for x in xs)
    out = [
        "kept AS (SELECT vec_id, label, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"pieces AS MATERIALIZED (SELECT r, vec_id, label, p, {cut} FROM (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS r FROM kept), (SELECT unnest(range({parts})) AS p))",
        f"book0 AS MATERIALIZED (SELECT p, r AS e, {', '.join(xs)} FROM pieces WHERE r < {entries})",
    ]
    for k in range(rounds + 1):
        # nearest entry, ties to the lower one: both in one number
        out.append(f"near{k} AS MATERIALIZED (SELECT a.r, a.p, min(({apart}) * {entries} + b.e) AS m FROM pieces a JOIN book{k} b USING (p) GROUP BY 1, 2)")
        if k < rounds:
            means = ", ".join(f"CAST(floor(sum({x})::DOUBLE / count(*)) AS BIGINT) AS {x}" for x in xs)
            moved = f"SELECT p, m % {entries} AS e, {means} FROM pieces JOIN near{k} USING (r, p) GROUP BY 1, 2"
            picked = ", ".join(f"coalesce(n.{x}, o.{x}) AS {x}" for x in xs)
            out.append(f"book{k + 1} AS MATERIALIZED (SELECT o.p, o.e, {picked} FROM book{k} o LEFT JOIN ({moved}) n ON n.p = o.p AND n.e = o.e)")
    said = " || ',' || ".join(xs)
    return f"""WITH {", ".join(out)},
each AS (SELECT r, string_agg(printf('%02x', CAST(m % {entries} AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(m // {entries}) AS BIGINT) AS error FROM near{rounds} GROUP BY 1),
named AS (SELECT vec_id, label, code, error FROM each JOIN (SELECT DISTINCT r, vec_id, label FROM pieces) USING (r)),
digest AS (SELECT sha256(string_agg({said}, ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM named, digest"""


CODES = _codes()

MINHASH = f"""
WITH RECURSIVE
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT r, unnest(CASE WHEN len(w) >= 4 THEN [array_to_string(w[i:i + 3], ' ') for i in range(1, len(w) - 2)] WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS h FROM d),
n AS (SELECT r, count(*) AS n FROM s GROUP BY 1),
met AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM s a JOIN s b ON a.h = b.h AND a.r < b.r GROUP BY 1, 2),
link AS MATERIALIZED (SELECT x, y FROM met JOIN n p ON p.r = x JOIN n q ON q.r = y WHERE 100 * c >= 80 * (p.n + q.n - c)),
edge AS MATERIALIZED (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT r AS x, r AS y FROM d UNION SELECT reach.x, edge.y FROM reach JOIN edge ON edge.x = reach.y),
root AS (SELECT reach.x AS r, min(d.doc_id) AS component_id FROM reach JOIN d ON d.r = reach.y GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM d JOIN root USING (r) LEFT JOIN n USING (r)"""
