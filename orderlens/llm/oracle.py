"""DuckDB twins of the operators that SQL can express on whole tables.

The others have none: their results need a tokenizer, a trained model, code point offsets of regular
expression matches, or byte strings of every text position; tests/llm checks them by brute force.
"""

# Distinct sets of three-word shingles, exact overlaps of all pairs of sets that share one, and the
# smallest document that links reach.
JACCARD = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t-\r]+'), lambda w: w <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1),
    lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s FROM words),
distinct_sets AS (SELECT min(doc_id) AS id, s FROM sets WHERE len(s) > 0 GROUP BY s),
shingles AS (SELECT id, len(s) AS n, unnest(s) AS x FROM distinct_sets),
shared AS (
  SELECT a.id AS a, b.id AS b, count(*) AS c, any_value(a.n) + any_value(b.n) AS total
  FROM shingles a JOIN shingles b ON a.x = b.x AND a.id < b.id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared WHERE 100 * c >= 90 * (total - c)
  UNION ALL SELECT b, a FROM shared WHERE 100 * c >= 90 * (total - c)),
reached AS (SELECT id, id AS other FROM distinct_sets UNION SELECT r.id, l.b FROM reached r JOIN links l ON l.a = r.other),
merged AS (SELECT id, min(other) AS component FROM reached GROUP BY id)
SELECT t.doc_id, CAST(len(t.s) AS BIGINT) AS n_shingles, coalesce(m.component, t.doc_id) AS component_id
FROM sets t LEFT JOIN distinct_sets d ON d.s = t.s LEFT JOIN merged m ON m.id = d.id"""

# Every window of an item's length that shares a shingle with the item, compared by counted shingles.
DECONTAMINATION = r"""
WITH doc_words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM documents),
item_words AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM benchmark),
item_steps AS (SELECT item_id, w, least(len(w), 5) AS k FROM item_words WHERE len(w) > 0),
items AS (SELECT item_id, k, len(w) - k + 1 AS m, unnest(range(1, len(w) - k + 2)) AS i, w FROM item_steps),
item_shingles AS (SELECT item_id, k, m, array_to_string(w[i:i + k - 1], ' ') AS x FROM items),
steps AS (SELECT DISTINCT k FROM item_steps),
places AS (SELECT doc_id, k, len(w) - k + 1 AS n, unnest(range(1, len(w) - k + 2)) AS p, w FROM doc_words, steps),
doc_shingles AS (SELECT doc_id, k, n, p, array_to_string(w[p:p + k - 1], ' ') AS x FROM places),
hits AS (SELECT DISTINCT doc_id, d.k, n, p, item_id, m FROM doc_shingles d JOIN item_shingles i ON d.x = i.x AND d.k = i.k),
starts AS (
  SELECT DISTINCT doc_id, k, item_id, m, least(n, m) AS taken,
    unnest(range(greatest(1, least(p - m + 1, n - least(n, m) + 1)), least(p, n - least(n, m) + 1) + 1)) AS s FROM hits),
item_counts AS (SELECT item_id, x, count(*) AS c FROM item_shingles GROUP BY 1, 2),
own AS (
  SELECT t.doc_id, t.item_id, t.m, t.taken, t.s, d.x, count(*) AS c FROM starts t
  JOIN doc_shingles d ON d.doc_id = t.doc_id AND d.k = t.k AND d.p >= t.s AND d.p < t.s + t.taken
  WHERE d.x IN (SELECT x FROM item_counts) GROUP BY ALL),
both_counts AS (
  SELECT doc_id, o.item_id, any_value(m + taken) AS total, CAST(sum(least(o.c, i.c)) AS BIGINT) AS b
  FROM own o JOIN item_counts i ON i.item_id = o.item_id AND i.x = o.x GROUP BY doc_id, o.item_id, m, taken, s)
SELECT doc_id, item_id, round(max(b / (total - b)), 6) AS similarity FROM both_counts
WHERE 100 * b >= 80 * (total - b) GROUP BY doc_id, item_id"""


#: Rows of ``embeddings`` that take part, components as whole numbers at a scale.
VECTORS = r"""
vectors AS (
  SELECT DISTINCT vec_id, {label} list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL {where}
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"""

# All pairs of a query and another row, scored and ranked.
TOP_K = (
    "WITH "
    + VECTORS.format(label="", scale=64, where="")
    + r""",
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20"""
)

# All pairs of an anchor and another row, scored; positives ranked by label, negatives by window.
HARD_NEGATIVES = (
    "WITH "
    + VECTORS.format(label="CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,", scale=256, where="AND label IS NOT NULL")
    + r""",
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM vectors a JOIN vectors c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
ranked AS (
  SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
    other_id AS negative_id, positive_score, score AS negative_score
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score)
SELECT * FROM ranked WHERE rank <= 10"""
)


# Sequences as lists. A conversation is a leaf where it is the smallest member of a childless node, and a
# node's savings are counted at its smallest member, so subtree sums are sums over members.
# crc32 goes bit by bit: a value over 255 brings in a byte, 0 shifts.
PREFIX_TRIE = r"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i,
    {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS t FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(t ORDER BY i) AS turns FROM turns GROUP BY conv_id),
bits AS (
  SELECT conv_id, turns, list_reduce(flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
      lambda c: list_concat([CAST(256 + ascii(c) AS BIGINT)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda a, x: CASE WHEN x > 255 THEN xor(a, x - 256) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END,
    4294967295::BIGINT) AS crc FROM own),
families AS (SELECT *, xor(crc, 4294967295::BIGINT) % 4 AS h FROM bits),
rebuilt AS (
  SELECT f.conv_id, list_concat(coalesce(b.turns, [])[1:CAST(h AS INTEGER)], f.turns[CAST(h AS INTEGER) + 1:]) AS turns
  FROM families f LEFT JOIN own b ON b.conv_id = f.conv_id - f.conv_id % 20),
paths AS (SELECT conv_id, turns, len(turns) AS size, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt),
members AS (SELECT conv_id, size, depth, turns[1:depth] AS node, turns[1:depth - 1] AS above FROM paths),
nodes AS (
  SELECT node, any_value(above) AS above, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE size = depth), '')) AS ends_sha256,
    CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * len(regexp_extract_all(node[depth].text, '[^\x20\x09-\x0D]+')) END AS saved
  FROM members GROUP BY node, depth),
children AS (SELECT above, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1, 2),
counted AS (
  SELECT n.*, p.conv_id AS parent_conv_id, coalesce(c.n, 0) AS n_children FROM nodes n
  LEFT JOIN children c ON c.above = n.node AND c.depth = n.depth
  LEFT JOIN nodes p ON p.node = n.above AND p.depth = n.depth - 1),
carried AS (SELECT node, depth, conv_id, CASE WHEN n_children = 0 THEN 1 ELSE 0 END AS leaf, saved FROM counted),
sums AS (
  SELECT m.node, m.depth, sum(c.leaf) AS n_leaves, sum(c.saved) AS saved_tokens
  FROM members m JOIN (SELECT a.conv_id, a.depth AS below, b.leaf, b.saved FROM members a JOIN carried b ON b.node = a.node AND b.depth = a.depth AND b.conv_id = a.conv_id) c
    ON c.conv_id = m.conv_id AND c.below >= m.depth GROUP BY 1, 2)
SELECT conv_id, CAST(n.depth AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256 FROM counted n JOIN sums s ON s.node = n.node AND s.depth = n.depth"""


def statements() -> dict[str, str]:
    return {
        "op5_decontamination": DECONTAMINATION,
        "op10_jaccard": JACCARD,
        "op11_hard_negatives": HARD_NEGATIVES,
        "op12_prefix_trie": PREFIX_TRIE,
        "op13_top_k": TOP_K,
    }
