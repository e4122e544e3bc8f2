"""Query on the manifest of a dataset."""
from opsloom.llm import merkle
from opsloom.llm.common import table
from opsloom.llm.queries import query

FIELDS = " || ".join("coalesce(strlen({0}) || ':' || {0}, '-')".format(f"CAST({c} AS VARCHAR)") for c in ("doc_id", "source", "lang", "n_chars"))
LOWER = f"translate(text, '{''.join(map(chr, range(65, 91)))}', '{''.join(map(chr, range(97, 123)))}')"
CRC = """xor(4294967295, list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384))))"""


def tree_sql(name: str, leaves: str) -> str:
    """Nodes and runs of trees over (tree, idx, n, digest)."""
    return f"""{name} AS (SELECT tree, 0 AS level, idx, n, digest FROM {leaves}
  UNION ALL SELECT tree, level + 1, idx // 16, (any_value(n) + 15) // 16, sha256(string_agg(digest, '' ORDER BY idx)) FROM {name}
    WHERE n > 1 GROUP BY tree, level, idx // 16),
{name}_runs AS (SELECT tree, level, idx // 16 AS run, any_value(n) AS n, list(digest ORDER BY idx) AS own FROM {name} GROUP BY ALL)"""


def walk_sql(name: str, start: str, runs: str) -> str:
    """Rows (r, tree, level, idx, node, proof) from the leaves up to where a run is alone at the top."""
    left = "array_to_string(own[1:idx % 16], '')"
    right = "array_to_string(own[idx % 16 + 2:], '')"
    return f"""{name} AS ({start}
  UNION ALL SELECT r, w.tree, w.level + 1, w.idx // 16, sha256({left} || node || {right}), proof || {left} || {right}
    FROM {name} w JOIN {runs} u ON w.tree IS NOT DISTINCT FROM u.tree AND w.level = u.level AND w.idx // 16 = u.run WHERE u.n > 1),
{name}_end AS (SELECT r, arg_max(node, level) AS node, arg_max(proof, level) AS proof, max(level) AS level FROM {name} GROUP BY r)"""


OP12_SQL = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, source AS tree, sha256({FIELDS} || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN {CRC} % 5 = 0 THEN sha256({FIELDS} || coalesce(strlen(text) || ':' || {LOWER}, '-')) END AS altered FROM documents),
leaves AS (SELECT r, doc_id, tree, leaf AS digest, altered, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY tree) AS n FROM d),
{tree_sql("nodes", "leaves")},
subroots AS (SELECT tree AS name, digest, digest AS subroot, 0 AS tree, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1),
{tree_sql("tops", "subroots")},
root AS (SELECT digest AS root FROM tops WHERE n = 1),
{walk_sql("low", "SELECT r, tree, 0 AS level, idx, coalesce(altered, digest) AS node, '' AS proof FROM leaves", "nodes_runs")},
{walk_sql("high", '''SELECT l.r, 0 AS tree, 0 AS level, s.idx, e.node, e.proof FROM leaves l JOIN low_end e ON l.r = e.r
    JOIN subroots s ON l.tree IS NOT DISTINCT FROM s.name''', "tops_runs")}
SELECT doc_id, l.digest AS leaf, subroot, root, sha256(proof) AS proof_sha256, node AS folded_root, node = root AS verified
FROM leaves l JOIN high_end e ON l.r = e.r JOIN subroots s ON l.tree IS NOT DISTINCT FROM s.name CROSS JOIN root
"""


@query("op12_merkle_manifest", OP12_SQL)
def manifest(spark, folder):
    return merkle.proofs(table(spark, folder, "documents"))
