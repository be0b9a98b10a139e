"""DuckDB SQL of the dealt queries that SQL can express (whole tables, whole texts)."""

from __future__ import annotations

from panelmart.llm import quality as Q
from panelmart.llm.substring import MIN_WORDS

_SPACES = r"[\x20\x09-\x0D]"
_WORDS = f"list_filter(string_split_regex(t, '{_SPACES}+'), lambda x: x <> '')"


def substring_sql(width: int = MIN_WORDS) -> str:
    """Every window by its words; a document loses those that start in a smaller one."""
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents) x),
windows AS (SELECT r, doc_id, s, array_to_string(w[s:s + {width - 1}], ' ') AS k
            FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - {width - 2})) AS s FROM d WHERE len(w) >= {width} AND doc_id IS NOT NULL) y),
firsts AS (SELECT k, min(doc_id) AS lo FROM windows GROUP BY k),
gone AS (SELECT DISTINCT r, unnest(range(s, s + {width})) AS p FROM windows JOIN firsts USING (k) WHERE lo < doc_id),
words AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM words ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)"""


def quality_sql() -> str:
    """Base counts and both Jensen-Shannon distances from histogram rows; references by median shares."""
    forms = ", ".join(f"('{lang}', {i}, '{form.decode()}')" for lang, words in Q.COMMON_WORDS.items()
                      for form, i in Q._forms(words))
    count = lambda pattern: f"length(regexp_replace(t, '{pattern}', '', 'g'))"
    classes = [count("[^a-z]"), count("[^A-Z]"), count("[^0-9]"), count(r"[^\x20\x09-\x0D]"), count("[^#*$%&|<>]"), "0", count(r"[\x00-\x7F]")]
    classes[5] = f"length(t) - ({' + '.join(classes)})"
    limit = lambda base, slack: f"{base} + {slack} / sqrt(greatest(n_words, 1))"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, CASE WHEN lang IN ({", ".join(f"'{x}'" for x in Q.COMMON_WORDS)}) THEN lang ELSE '' END AS g,
                  coalesce(text, '') AS t FROM documents),
split AS (SELECT r, doc_id, g, t, {_WORDS} AS w,
                 list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
grams AS (SELECT r, s, array_to_string(w[s:s + 4], ' ') AS k FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS s FROM split WHERE len(w) >= 5) x),
twice AS (SELECT r, k FROM grams GROUP BY r, k HAVING count(*) > 1),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(s, s + 5)) AS p FROM grams SEMI JOIN twice USING (r, k)) x GROUP BY r),
base AS (SELECT split.r, doc_id, g, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, {classes[4]} AS n_symbols,
                len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, length(t) AS n_chars
         FROM split LEFT JOIN covered USING (r)),
forms AS (SELECT * FROM (VALUES {forms}) v(g, bin, form)),
hit AS (SELECT r, bin, count(*) AS c FROM (SELECT r, g, unnest(w) AS form FROM split) x JOIN forms USING (g, form) GROUP BY r, bin),
hist AS (SELECT r, g, 'c' AS part, unnest(range(0, {len(classes)})) AS bin, unnest([{", ".join(classes)}]) AS c FROM split
         UNION ALL
         SELECT r, g, 'w', z.bin, CASE WHEN z.bin < {Q.N_COMMON} THEN coalesce(hit.c, 0) ELSE n_words - coalesce(whole.c, 0) END
         FROM (SELECT r, g, n_words, unnest(range(0, {Q.N_COMMON + 1})) AS bin FROM base) z LEFT JOIN hit USING (r, bin)
         LEFT JOIN (SELECT r, sum(c) AS c FROM hit GROUP BY r) whole USING (r)),
own AS (SELECT hist.r, hist.g, part, bin, c / nullif(sum(c) OVER (PARTITION BY hist.r, part), 0) AS p FROM hist),
steps AS (SELECT own.g, part, bin, floor({Q.STEPS} * p + 0.5) AS v FROM own JOIN base USING (r)
          WHERE own.g <> '' AND n_words >= {Q.MIN_WORDS} AND n_chars >= {Q.MIN_CHARS} AND 100 * n_repeat_words <= 20 * n_words),
ranked AS (SELECT *, row_number() OVER (PARTITION BY g, part, bin ORDER BY v) AS k, count(*) OVER (PARTITION BY g, part, bin) AS n FROM steps),
ref AS (SELECT g, part, bin, v / nullif(sum(v) OVER (PARTITION BY g, part), 0) AS q FROM ranked WHERE k = (n + 1) // 2),
share AS (SELECT own.r, part, p, q FROM own JOIN ref USING (g, part, bin) WHERE q IS NOT NULL),
distance AS (SELECT r, part, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
                                             + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2, 0)) AS js
             FROM share WHERE p IS NOT NULL GROUP BY r, part),
judged AS (SELECT base.*, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
                  n_chars >= {Q.MIN_CHARS} AND coalesce(c.js, 0) > {limit(Q.CHAR_LIMIT, Q.CHAR_SLACK)} AS odd_chars,
                  n_words >= {Q.MIN_WORDS} AND coalesce(w.js, 0) > {limit(Q.WORD_LIMIT, Q.WORD_SLACK)} AS odd_words
           FROM base LEFT JOIN distance c ON c.r = base.r AND c.part = 'c' LEFT JOIN distance w ON w.r = base.r AND w.part = 'w')
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND NOT odd_chars AND NOT odd_words AS kept
FROM judged"""


def merkle_sql() -> str:
    """Trees and proofs by recursion over whole levels; checksums bit by bit."""
    text = lambda c: f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = lambda n: "sha256(" + " || ".join(text(n if c == "n_chars" else c) for c in ("doc_id", "source", "lang", "n_chars", "text")) + ")"

    def climb(name: str, first: str) -> str:
        """(g, i, lvl, h, n) of every node of every level; n: nodes of the level."""
        return f"""{name} AS (
    SELECT g, i, 0 AS lvl, h, n FROM {first}
    UNION ALL
    SELECT g, i, lvl, h, count(*) OVER (PARTITION BY g) AS n
    FROM (SELECT g, i // 2 AS i, any_value(lvl) + 1 AS lvl, sha256(string_agg(h, '' ORDER BY {name}.i)) AS h FROM {name} WHERE n > 1 GROUP BY g, i // 2) x)"""

    crc = """list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
        flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: list_transform(range(0, 8), lambda b: (ord(c) >> b) & 1)))),
        lambda c, bit: xor(c >> 1, 3988292384 * (xor(c, bit) & 1)))"""
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, lang, {leaf("n_chars")} AS leaf,
    CASE WHEN xor({crc}, 4294967295) % 7 = 0 THEN {leaf("(CAST(n_chars AS HUGEINT) + 1)")} ELSE {leaf("n_chars")} END AS given FROM documents),
leaves AS (SELECT *, coalesce('=' || lang, '') AS g, leaf AS h, count(*) OVER (PARTITION BY lang) AS n,
                  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
                  row_number() OVER () AS r FROM d),
{climb("nodes", "leaves")},
subroots AS (SELECT g, h AS subroot FROM nodes WHERE n = 1),
top AS (SELECT '' AS g, subroot AS h, count(*) OVER () AS n, row_number() OVER (ORDER BY encode(g)) - 1 AS i, g AS name FROM subroots),
{climb("high", "top")},
way AS (
    SELECT r, i, 0 AS lvl, g, '' AS proof, given AS folded, leaf AS checked, false AS up FROM leaves
    UNION ALL
    SELECT w.r, CASE WHEN me.n > 1 THEN w.i // 2 ELSE t.i END, CASE WHEN me.n > 1 THEN w.lvl + 1 ELSE 0 END, CASE WHEN me.n > 1 THEN w.g ELSE '' END,
           w.proof || CASE WHEN me.n > 1 THEN coalesce(sib.h, '') ELSE '' END,
           CASE WHEN me.n = 1 THEN w.folded WHEN w.i % 2 = 1 THEN sha256(sib.h || w.folded) ELSE sha256(w.folded || coalesce(sib.h, '')) END,
           w.checked, w.up OR me.n = 1
    FROM way w JOIN (SELECT *, false AS up FROM nodes UNION ALL SELECT *, true FROM high) me ON me.g = w.g AND me.i = w.i AND me.lvl = w.lvl AND me.up = w.up
    LEFT JOIN (SELECT *, false AS up FROM nodes UNION ALL SELECT *, true FROM high) sib
      ON sib.g = w.g AND sib.i = xor(w.i, 1) AND sib.lvl = w.lvl AND sib.up = w.up
    LEFT JOIN top t ON t.name = w.g AND NOT w.up
    WHERE me.n > 1 OR NOT w.up),
ended AS (SELECT w.* FROM way w JOIN high me ON w.up AND me.i = w.i AND me.lvl = w.lvl AND me.n = 1)
SELECT l.doc_id, l.leaf, s.subroot, root.h AS root, sha256(e.proof) AS proof_sha256, e.folded AS folded_root, e.folded = root.h AS verified
FROM leaves l JOIN ended e USING (r) JOIN subroots s ON s.g = l.g CROSS JOIN (SELECT h FROM high WHERE n = 1) root"""


def jaccard_sql() -> str:
    """Shared shingles counted pair by pair, components by recursion."""
    lower = "translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.replace("(t,", f"({lower},")} AS w FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents) x),
shingles AS (SELECT DISTINCT r, array_to_string(w[s:s + 4], ' ') AS k
             FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS s FROM d WHERE len(w) > 0) y),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
common AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM shingles a JOIN shingles b USING (k) WHERE a.r < b.r GROUP BY a.r, b.r),
linked AS (SELECT x, y FROM common JOIN sizes p ON p.r = x JOIN sizes q ON q.r = y WHERE 100 * c >= 80 * (p.n + q.n - c)),
ways AS (SELECT x, y FROM linked UNION ALL SELECT y, x FROM linked),
reach AS (SELECT r AS x, r AS y FROM d UNION SELECT reach.x, ways.y FROM reach JOIN ways ON ways.x = reach.y)
SELECT d.doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(e.doc_id) AS component_id
FROM d JOIN reach ON reach.x = d.r JOIN d e ON e.r = reach.y LEFT JOIN sizes ON sizes.r = d.r GROUP BY d.r, d.doc_id"""
