"""The SQL twins of the subpackage's queries, where SQL can express them."""

from riskframe.llm.licences import COPYRIGHT_LINE, LICENCES, SPELLINGS, listed_digests

OP3 = """
WITH rows AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM rows WINDOW g AS (PARTITION BY norm)
"""

# chr(92) is the backslash.
OP1 = """
WITH turns AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', chr(92) || '### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', chr(92) || '### Assistant: </turn> ok'),
filled AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM turns),
sized AS (
  SELECT *,
    length(replace(replace(replace(replace(role, chr(92), chr(92) || chr(92)),
      '##', '#' || chr(92) || '#'), '</turn>', '<' || chr(92) || '/turn>'), ':', chr(92) || ':'))
    + length(replace(replace(replace(text, chr(92), chr(92) || chr(92)),
      '##', '#' || chr(92) || '#'), '</turn>', '<' || chr(92) || '/turn>'))
    + length('### : </turn>' || chr(10)) AS chars,
    row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS turns
  FROM filled WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
summed AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY place) AS so_far FROM sized)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(so_far) FILTER (WHERE role = 'assistant' OR place = turns)::BIGINT AS formatted_chars
FROM summed GROUP BY conv_id
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical(text: str) -> str:
    """SQL for the canonical form of an expression."""
    spellings = ", ".join(f"{_quoted(a)}: {_quoted(b)}" for a, b in SPELLINGS.items())
    lines = f"""array_to_string(list_filter(string_split(translate({text},
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), chr(10)),
        lambda x: NOT regexp_matches(x, {_quoted(COPYRIGHT_LINE)})), chr(10))"""
    words = f"""list_filter(string_split(regexp_replace({lines}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' '),
        lambda w: w <> '')"""
    return f"array_to_string(list_transform({words}, lambda w: coalesce(MAP {{{spellings}}}[w], w)), ' ')"


OP5 = f"""
WITH own AS (
  SELECT sha256({_canonical("text")}) AS digest, min(name) AS name
  FROM (VALUES {", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in LICENCES.items())}) t(name, text)
  GROUP BY 1),
known AS (
  SELECT * FROM own UNION ALL
  SELECT * FROM (VALUES {", ".join(f"('{a}', '{b}')" for a, b in listed_digests())}) t(digest, name)
  WHERE digest NOT IN (SELECT digest FROM own)),
docs AS (
  SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT n, sha256({_canonical("line")}) AS digest
  FROM (SELECT n, unnest(string_split(text, chr(10))) AS line FROM docs)),
found AS (
  SELECT n, count(*) AS lines, string_agg(DISTINCT name, ',' ORDER BY name) AS names
  FROM lines JOIN known USING (digest) GROUP BY n),
whole AS (SELECT n, doc_id, sha256({_canonical("text")}) AS digest FROM docs)
SELECT doc_id, w.digest, k.name AS licence, coalesce(f.lines, 0)::BIGINT AS n_licence_lines,
       coalesce(f.names, '') AS line_licences
FROM whole w LEFT JOIN known k ON k.digest = w.digest LEFT JOIN found f ON f.n = w.n
"""

def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


# A step of the checksum takes in a byte or shifts by a bit (-1).
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
    string_split(doc_id::VARCHAR, ''), lambda c: list_prepend(ord(c)::BIGINT, [-1, -1, -1, -1, -1, -1, -1, -1])))),
    lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x)
                        ELSE xor(crc >> 1, CASE WHEN crc & 1 = 1 THEN 3988292384 ELSE 0 END) END))"""


def _tree(name: str, leaves: str) -> str:
    """The nodes of the trees of a table (tree, rank, size, digest) and what stands beside them."""
    return f"""
{name}(tree, level, rank, size, digest) AS (
  SELECT tree, 0, rank, size, digest FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, rank // 8, (size + 7) // 8, sha256(string_agg(digest, '' ORDER BY rank))
  FROM {name} WHERE size > 1 GROUP BY tree, level, rank // 8, size),
{name}_sides AS (
  SELECT tree, level, rank,
    coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name} WHERE size > 1 WINDOW w AS (PARTITION BY tree, level, rank // 8 ORDER BY rank))"""


OP11 = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce('v' || lang, 'n') AS tree, text,
    {" || ".join(map(_field, ("doc_id", "source", "lang", "n_chars")))} AS head,
    CASE WHEN {_CRC32} % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz') ELSE text END AS later FROM documents),
hashed AS (
  SELECT doc_id, tree, sha256(head || {_field("text")}) AS digest,
    sha256(head || {_field("later")}) AS later FROM docs),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS rank,
    count(*) OVER (PARTITION BY tree) AS size, row_number() OVER () AS n FROM hashed),
{_tree("low", "leaves")},
subroots AS (
  SELECT tree AS part, '' AS tree, digest, row_number() OVER (ORDER BY tree) - 1 AS rank,
    count(*) OVER () AS size FROM low WHERE size = 1),
{_tree("high", "subroots")},
up(n, tree, level, rank, proof, folded) AS (
  SELECT n, tree, 0, rank, '', later FROM leaves
  UNION ALL
  SELECT n, tree, level + 1, rank // 8, proof || l || r, sha256(l || folded || r)
  FROM up JOIN low_sides USING (tree, level, rank)),
top AS (SELECT n, max_by(proof, level) AS proof, max_by(folded, level) AS folded FROM up GROUP BY n),
further(n, tree, level, rank, proof, folded) AS (
  SELECT n, s.tree, 0, s.rank, proof, folded
  FROM top JOIN leaves x USING (n) JOIN subroots s ON s.part = x.tree
  UNION ALL
  SELECT n, tree, level + 1, rank // 8, proof || l || r, sha256(l || folded || r)
  FROM further JOIN high_sides USING (tree, level, rank)),
ends AS (SELECT n, max_by(proof, level) AS proof, max_by(folded, level) AS folded FROM further GROUP BY n)
SELECT doc_id, x.digest AS leaf, s.digest AS subroot, h.digest AS root, sha256(e.proof) AS proof_sha256,
       e.folded AS folded_root, e.folded = h.digest AS verified
FROM leaves x JOIN ends e USING (n) JOIN subroots s ON s.part = x.tree
JOIN (SELECT digest FROM high WHERE size = 1) h ON true
"""

ORACLES: dict[str, str] = {"op1_chat_examples": OP1, "op3_exact_dedup": OP3,
                           "op5_licence_scan": OP5, "op11_merkle_manifest": OP11}
