"""DuckDB SQL of the Merkle manifest: one block of subqueries per level."""

from __future__ import annotations

ARITY = 8
LEVELS, TOP_LEVELS = 8, 4  # more than enough for the tables that the SQL runs on


def _encoded(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_encoded(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


#: CRC-32 of the decimal key: bits shifted out one by one, polynomial 0xEDB88320.
_CRC = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
  lambda a, b: list_reduce(list_prepend(xor(a, b), [CAST(0 AS BIGINT) for _ in range(8)]), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)))"""


def _tree(name: str, count: int) -> list[str]:
    """Subqueries ``name0 .. nameN`` (g, i, h, n) and, above ``name0``, each from the one below."""
    return [f"""{name}{k} AS (SELECT g, i // {ARITY} AS i, sha256(string_agg(h, '' ORDER BY i)) AS h, (min(n) + {ARITY - 1}) // {ARITY} AS n
  FROM {name}{k - 1} WHERE n > 1 GROUP BY g, i // {ARITY})""" for k in range(1, count + 1)]


def _runs(name: str, count: int) -> list[str]:
    return [f"""{name}{k}r AS (SELECT g, i // {ARITY} AS p, list(h ORDER BY i) AS hs FROM {name}{k} WHERE n > 1 GROUP BY g, i // {ARITY})""" for k in range(count)]


def _climb(source: str, name: str, count: int, start: str) -> list[str]:
    """Subqueries that carry (d, g, place, proof, acc) one level up each."""
    out, last = [], source
    for k in range(count):
        here = f"{start}{k}"
        out.append(f"""{here} AS (SELECT d, s.g, CASE WHEN r.hs IS NULL THEN place ELSE place // {ARITY} END AS place,
    proof || coalesce(array_to_string(hs[1:place % {ARITY}], '') || array_to_string(hs[place % {ARITY} + 2:], ''), '') AS proof,
    CASE WHEN r.hs IS NULL THEN acc ELSE sha256(array_to_string(hs[1:place % {ARITY}], '') || acc || array_to_string(hs[place % {ARITY} + 2:], '')) END AS acc
  FROM {last} s LEFT JOIN {name}{k}r r ON r.g = s.g AND r.p = s.place // {ARITY})""")
        last = here
    return out


def sql() -> str:
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [
        f"""d AS (SELECT doc_id, lang, {_leaf('text')} AS leaf, CASE WHEN {_CRC} % 3 = 0 THEN {_leaf(lower)} ELSE {_leaf('text')} END AS changed FROM documents)""",
        """p AS (SELECT *, row_number() OVER () AS d, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM d)""",
        "l0 AS (SELECT g, i, leaf AS h, n FROM p)", *_tree("l", LEVELS), *_runs("l", LEVELS),
        "sub AS (" + " UNION ALL ".join(f"SELECT g, h FROM l{k} WHERE n = 1" for k in range(LEVELS + 1)) + ")",
        "t0 AS (SELECT 0 AS g, g AS i, h, (SELECT count(*) FROM sub) AS n FROM sub)", *_tree("t", TOP_LEVELS), *_runs("t", TOP_LEVELS),
        "root AS (" + " UNION ALL ".join(f"SELECT h FROM t{k} WHERE n = 1" for k in range(TOP_LEVELS + 1)) + ")",
        "c AS (SELECT d, g, i AS place, '' AS proof, changed AS acc FROM p)", *_climb("c", "l", LEVELS, "up"),
        f"e AS (SELECT d, 0 AS g, g AS place, proof, acc FROM up{LEVELS - 1})", *_climb("e", "t", TOP_LEVELS, "top"),
    ]
    return "WITH " + ",\n".join(parts) + f"""
SELECT p.doc_id, p.leaf, sub.h AS subroot, root.h AS root, sha256(z.proof) AS proof_sha256, z.acc AS folded_root, z.acc = root.h AS verified
FROM p JOIN sub ON sub.g = p.g JOIN top{TOP_LEVELS - 1} z ON z.d = p.d, root"""
