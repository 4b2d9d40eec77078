"""DuckDB SQL of the operators whose results SQL can express: checksums, shards, ranks, trees."""

from millrace.llm.sharding import FIRST, LOW32, ROUNDS, SECOND, SEED, SHARDS, Permutation

#: CRC-32 by its table of 256 entries, which the polynomial generates.
CRC_TABLE = """crc AS (SELECT list_transform(range(256), lambda i: list_reduce(
    [i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: xor(c >> 1, (c & 1) * 3988292384))) AS t)"""


def crc32(text: str) -> str:
    """Unsigned CRC-32 of a string's UTF-8 bytes; the query needs ``CRC_TABLE`` and ``crc`` in FROM."""
    data = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT)"
    folded = f"list_reduce(list_prepend(4294967295, {data}), lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]))"
    return f"xor({folded}, 4294967295)::BIGINT"


def _sharding(shards: int = SHARDS, seed: int = SEED) -> str:
    """Numbers walk through the network until they are inside; its keys depend on the seed alone."""
    keys = Permutation(1, seed, ROUNDS).keys
    steps = ", ".join(f"{{'l': 0::HUGEINT, 'r': 0::HUGEINT, 'k': {k}::HUGEINT}}" for k in keys)
    first = f"((xor(a.r, b.k) * {FIRST}) & {LOW32})"
    second = f"((xor({first}, {first} >> 15) * {SECOND}) & {LOW32})"
    mixed = f"(xor({second}, {second} >> 13) & (pow(2, half)::HUGEINT - 1))"
    network = f"""list_reduce([{{'l': x >> half, 'r': x & (pow(2, half)::HUGEINT - 1), 'k': 0::HUGEINT}}, {steps}],
      lambda a, b: {{'l': a.r, 'r': xor(a.l, {mixed}), 'k': 0::HUGEINT}})"""
    return f"""WITH RECURSIVE {CRC_TABLE},
s AS (SELECT doc_id, (coalesce(strlen(text), 0) + 1)::BIGINT AS size, {crc32("coalesce(text, '')")} AS text_crc32
  FROM documents, crc),
r AS (SELECT *, (row_number() OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1)::HUGEINT AS number,
  count(*) OVER () AS n FROM s),
h AS (SELECT *, greatest(1, ceil(ceil(log2(n)) / 2))::INTEGER AS half FROM r),
walk AS (SELECT number, n, half, number AS x, 0 AS step FROM h
  UNION ALL SELECT number, n, half, (gone.l << half) + gone.r, step + 1
  FROM (SELECT *, {network} AS gone FROM walk WHERE step = 0 OR x >= n))
SELECT doc_id, size, text_crc32, 'rows' AS law, (x % {shards})::INTEGER AS shard, (x // {shards})::BIGINT AS slot,
  NULL::INTEGER AS grown_shard
FROM h JOIN walk USING (number) WHERE step > 0 AND x < walk.n"""


def _tree(name: str, levels: int) -> str:
    """Levels of all trees whose leaves ``(g, i, h, n)`` are in table ``name0``, as CTEs, and ``name`` with all."""
    steps = [
        f"{name}{k + 1} AS (SELECT g, i // 2 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h, (max(n) + 1) // 2 AS n"
        f" FROM {name}{k} WHERE n > 1 GROUP BY g, i // 2)"
        for k in range(levels)
    ]
    every = " UNION ALL ".join(f"SELECT {k} AS k, * FROM {name}{k}" for k in range(levels + 1))
    return ",\n".join([*steps, f"{name} AS ({every})"])


def _manifest() -> str:
    """Trees of up to 2**24 leaves a group and 2**12 groups, level by level."""
    def row(n_chars: str) -> str:
        values = ["doc_id", "source", "lang", n_chars, "text"]
        return " || ".join(f"coalesce(strlen(({v})::VARCHAR) || ':' || ({v})::VARCHAR, '-')" for v in values)

    def steps(tree: str, leaf: str, phase: int) -> str:
        return f"""SELECT r.uid, {phase} AS phase, a.k, CASE WHEN s.h IS NULL THEN 'N'
    WHEN a.i % 2 = 1 THEN 'L' || s.h ELSE 'R' || s.h END AS step
  FROM {leaf} JOIN {tree} a ON a.n > 1 AND a.i = spot >> a.k AND a.g = tree
  LEFT JOIN {tree} s ON s.k = a.k AND s.g = a.g AND s.i = xor(a.i, 1)"""

    return f"""WITH {CRC_TABLE},
d AS (SELECT doc_id, coalesce('v' || lang, 'n') AS g, sha256({row("n_chars")}) AS leaf,
    CASE WHEN {crc32("doc_id::VARCHAR")} % 7 = 0 THEN sha256({row("n_chars::HUGEINT + 1")}) END AS tampered
  FROM documents, crc),
r AS (SELECT *, g AS tree, row_number() OVER () AS uid, count(*) OVER (PARTITION BY g) AS n,
    row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS spot FROM d),
n0 AS (SELECT g, spot AS i, leaf AS h, n FROM r),
{_tree("n", 24)},
g AS (SELECT g AS name, '' AS tree, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS spot, count(*) OVER () AS n
  FROM n WHERE n = 1),
m0 AS (SELECT '' AS g, spot AS i, subroot AS h, n FROM g),
{_tree("m", 12)},
s AS ({steps("n", "r", 0)}
  UNION ALL {steps("m", "(SELECT r.uid, g.spot, g.tree FROM r JOIN g ON r.g = g.name) r", 1)}),
p AS (SELECT uid, sha256(string_agg(substr(step, 2), '' ORDER BY phase, k)) AS proof,
    list(step ORDER BY phase, k) AS steps FROM s GROUP BY uid),
f AS (SELECT doc_id, leaf, subroot, (SELECT h FROM m WHERE n = 1) AS root, coalesce(proof, sha256('')) AS proof_sha256,
    list_reduce(list_prepend(coalesce(tampered, leaf), coalesce(steps, [])), lambda v, s: sha256(
      CASE WHEN s[1] = 'L' THEN substr(s, 2) || v WHEN s[1] = 'R' THEN v || substr(s, 2) ELSE v END)) AS folded_root
  FROM r JOIN g ON r.g = g.name LEFT JOIN p ON r.uid = p.uid)
SELECT *, folded_root = root AS verified FROM f"""


HARD_NEGATIVES = """WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, row_number() OVER () AS uid,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS parts FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT a.vec_id AS anchor_id, a.uid, r.vec_id AS id, r.label = a.label AS same,
    list_dot_product(a.parts, r.parts)::BIGINT AS score
  FROM v a JOIN v r ON a.vec_id % 50 = 0 AND r.uid <> a.uid),
m AS (SELECT * FROM p WHERE same QUALIFY row_number() OVER (PARTITION BY uid ORDER BY score DESC, id NULLS LAST) <= 5),
w AS (SELECT m.anchor_id, m.id AS positive_id, m.score AS positive_score, n.id AS negative_id, n.score AS negative_score,
    row_number() OVER (PARTITION BY m.uid, m.id ORDER BY n.score DESC, n.id NULLS LAST)::INTEGER AS rank
  FROM m JOIN p n ON n.uid = m.uid AND NOT n.same
    AND 50 * m.score <= 100 * n.score AND 100 * n.score <= 95 * m.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM w WHERE rank <= 3"""

ORACLES = {"op11_manifest": _manifest(), "op12_hard_negatives": HARD_NEGATIVES, "op13_sharding": _sharding()}
