"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from llm.secret_scan import BASE, RULES

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP1 = f"""
WITH RECURSIVE words AS (
    SELECT doc_id, {WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, s FROM (
        SELECT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
        FROM words WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
    SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * c >= 85 * (x.n + y.n - c)
), reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least_id AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(b, d.doc_id)) AS component_id,
       least(d.doc_id, coalesce(b, d.doc_id)) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN least_id ON a = d.doc_id
"""


def _spans(kind: str) -> str:
    """Start and end of each long enough match: pieces between marks put around the matches."""
    pattern, least = RULES[kind]
    pattern = pattern.replace("(?ai:", "(?i:").replace("'", "''")
    part = rf"regexp_extract(m, '^(?:{pattern})$', 2)" if kind == "assign" else "m"
    return rf"""
    SELECT doc_id, '{kind}' AS kind, {list(RULES).index(kind)} AS place, s, s + length(m) AS e FROM (
        SELECT doc_id, i, split_part(p, chr(2), 1) AS m,
               sum(length(p) - CASE WHEN i = 1 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)::BIGINT AS s
        FROM (SELECT doc_id, unnest(list_zip(x, range(1, len(x) + 1)), recursive := true) FROM (
            SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '({pattern})', chr(1) || '\1' || chr(2), 'g'), chr(1)) AS x
            FROM documents)) AS pieces(doc_id, p, i))
    WHERE i > 1 AND length({part}) >= {least}"""


def _op2() -> str:
    spans = " UNION ALL ".join(map(_spans, RULES))
    base = ", ".join(f"'{k}'" for k in BASE)
    listed = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place)"
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE)
    return f"""
WITH spans AS ({spans})
SELECT doc_id, {counts}, sha256(coalesce({listed} FILTER (kind IN ({base})), '')) AS base_sha256,
       coalesce({listed}, '') AS spans
FROM documents LEFT JOIN spans USING (doc_id) GROUP BY doc_id
"""


OP4 = rf"""
WITH sized AS (
    SELECT doc_id, source, size,
           -ln((('0x' || substr(md5(doc_id || ':7:' || hash), 1, 13))::BIGINT + 0.5) / 4503599627370496.0)
           / CASE WHEN size > 0 THEN greatest(0.2, 1 - 2 * symbols / size) ELSE 0.2 END AS key
    FROM (SELECT doc_id, source, md5(coalesce(text, '')) AS hash, len({WORDS.format("coalesce(text, '')")}) AS size,
                 length(coalesce(text, '')) - length(translate(coalesce(text, ''), '#*$%&|<>', '')) AS symbols FROM documents)
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
    FROM sized GROUP BY source
), caps AS (SELECT *, 2.0 * source_size AS cap, 2.0 * source_size / weight AS ratio FROM sources
), levels AS (
    SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
    FROM caps WINDOW before AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
    SELECT source, source_size,
           coalesce(least(cap, weight * (SELECT level FROM levels WHERE ratio >= level ORDER BY ratio, source NULLS LAST LIMIT 1)), cap) AS target
    FROM levels
), placed AS (
    SELECT s.*, source_size, target,
           coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier,
           CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, size::BIGINT AS size, source_size, target,
       (epochs * size + least(size, greatest(floor(target) - epochs * source_size - earlier, 0)))::BIGINT AS taken
FROM placed
"""

OP7 = rf"""
WITH lines AS (
    SELECT doc_id, source, coalesce(text, '') AS text, {WORDS.format("coalesce(text, '')")} AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
    FROM documents
), windows AS (
    SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, w FROM lines WHERE len(w) >= 8
), again AS (
    SELECT doc_id, i FROM (
        SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(w[i:i + 7], ' ')) AS c FROM windows) WHERE c > 1
), covered AS (
    SELECT doc_id, count(DISTINCT i + k)::BIGINT AS n FROM again, range(8) r(k) GROUP BY doc_id
), counted AS (
    SELECT doc_id, source AS host, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
           (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
           (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
    FROM lines LEFT JOIN covered USING (doc_id)
), judged AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted
), ruled AS (
    SELECT *, base_failed OR 100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 30 * n_lines AS failed FROM judged
), hosts AS (SELECT host, count(*) AS n, count(*) FILTER (failed) AS x FROM ruled GROUP BY host
), moments AS (
    SELECT sum(x) / sum(n) AS p, sum(n) AS docs, count(*) AS hosts, sum(n * n) AS squares, sum(x * x / n) AS within FROM hosts
), spread AS (
    SELECT p, (within - docs * p * p - (hosts - 1) * p * (1 - p)) / nullif(greatest(docs - squares / docs, 0), 0) AS s FROM moments
), prior AS (
    SELECT coalesce(p, 0) AS p, least(greatest(CASE WHEN s > 0 THEN p * (1 - p) / s - 1 ELSE 1000 END, 2), 1000) AS weight FROM spread
), verdicts AS (SELECT host, 100 * (x + p * weight) / (n + weight) > 50 AS host_rejected FROM hosts, prior)
SELECT r.*, host_rejected, NOT failed AND NOT host_rejected AS kept
FROM ruled r JOIN verdicts v ON r.host IS NOT DISTINCT FROM v.host
"""


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The table of the reflected crc32, from its polynomial, and the crc32 of a text's UTF-8 bytes.
CRC_TABLE = """crc_table AS (
    SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""


def _crc(text: str) -> str:
    code = f"hex(encode({text}))"
    units = f"list_transform(range(1, length({code}), 2), lambda i: ('0x' || substr({code}, i, 2))::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295], {units}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


def _features(table: str) -> str:
    folded = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"
    return rf"regexp_extract_all({folded}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {table}"


OP11 = f"""
WITH {CRC_TABLE}, docs AS (SELECT doc_id, {_features("documents")}
), each AS (SELECT doc_id, unnest(w) AS f FROM docs
), wanted AS (SELECT unnest(w) AS f FROM (SELECT {_features("benchmark")})
), buckets AS (SELECT f, {_crc("f")} % 10000 AS b FROM (SELECT f FROM each UNION SELECT f FROM wanted), crc_table
), raw AS (SELECT b, count(*) AS n FROM each JOIN buckets USING (f) GROUP BY b
), target AS (SELECT b, count(*) AS n FROM wanted JOIN buckets USING (f) GROUP BY b
), sums AS (SELECT (SELECT count(*) FROM each) AS s, (SELECT count(*) FROM wanted) AS t
), gains AS (
    SELECT b, floor(1000 * ln((coalesce(target.n, 0) + 1)::DOUBLE * (s + 10000)::DOUBLE
                              / ((coalesce(raw.n, 0) + 1)::DOUBLE * (t + 10000)::DOUBLE)))::BIGINT AS gain
    FROM raw FULL JOIN target USING (b), sums
), weights AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM each JOIN buckets USING (f) JOIN gains USING (b) GROUP BY doc_id
), scored AS (
    SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5) / 4294967296.0::DOUBLE)))::BIGINT AS score
    FROM docs LEFT JOIN weights USING (doc_id)
), ranked AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, 10 * count(*) OVER () // 100 AS k FROM scored WHERE n_features >= 20)
SELECT s.*, CASE WHEN r <= k THEN r END AS rank FROM scored s LEFT JOIN ranked USING (doc_id)
"""


def _leaf(text: str) -> str:
    parts = [f"coalesce(strlen({c}::VARCHAR) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(parts)})"


def _tree(name: str, height: int) -> str:
    """Levels over the nodes ``<name>0`` (g, p, h, c: group, place, hash, nodes of the group), and their siblings."""
    out = []
    for k in range(height):
        run = "PARTITION BY g, p // 16 ORDER BY p ROWS BETWEEN"
        out.append(f"""{name}s{k} AS (
    SELECT g, p, c, coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS x,
           coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS y FROM {name}{k}
), {name}{k + 1} AS (
    SELECT g, p // 16 AS p, CASE WHEN c > 1 THEN sha256(string_agg(h, '' ORDER BY p)) ELSE min(h) END AS h, (c + 15) // 16 AS c
    FROM {name}{k} GROUP BY g, p // 16, c)""")
    return ", ".join(out)


def _siblings(name: str, height: int, group: str, place: str) -> tuple[str, str]:
    """Joins of a path's siblings by level, and their text."""
    joins, proof = "", "''"
    for k in range(height):
        joins += f" JOIN {name}s{k} ON {name}s{k}.g = {group} AND {name}s{k}.p = {place} // {16**k}"
        proof += f" || {name}s{k}.x || {name}s{k}.y"
    return joins, proof


def _op12(height: int = 5, source_height: int = 2) -> str:
    """Trees of up to 16 ** height documents a source and 16 ** source_height sources."""
    joins, proof = _siblings("a", height, "of.g", "of.p")
    more, over = _siblings("b", source_height, "0", "of.g")
    steps, last = [], "start"
    for name, levels in (("a", height), ("b", source_height)):
        for k in range(levels):
            at = "f.p" if name == "a" else "f.g"
            group = "f.g" if name == "a" else "0"
            step = f"f_{name}{k}"
            steps.append(f"""{step} AS (
    SELECT f.g, f.p, CASE WHEN s.c > 1 THEN sha256(s.x || f.h || s.y) ELSE f.h END AS h
    FROM {last} f JOIN {name}s{k} s ON s.g = {group} AND s.p = {at} // {16**k})""")
            last = step
    return f"""
WITH {CRC_TABLE}, leaves AS (
    SELECT doc_id, {_leaf("text")} AS leaf, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g,
           row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS p, count(*) OVER (PARTITION BY source) AS c,
           CASE WHEN {_crc("doc_id::VARCHAR")} % 5 = 0 THEN {_leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} END AS tampered
    FROM documents, crc_table
), a0 AS (SELECT g, p, leaf AS h, c FROM leaves
), {_tree("a", height)}, b0 AS (SELECT 0 AS g, g AS p, h, count(*) OVER () AS c FROM a{height}
), {_tree("b", source_height)}, start AS (SELECT g, p, coalesce(tampered, leaf) AS h FROM leaves
), {", ".join(steps)}
SELECT doc_id, leaf, sub.h AS subroot, top.h AS root, sha256({proof} || {over}) AS proof_sha256, {last}.h AS folded_root,
       {last}.h = top.h AS verified
FROM leaves of{joins}{more} JOIN a{height} sub ON sub.g = of.g JOIN {last} ON {last}.g = of.g AND {last}.p = of.p, b{source_height} top
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_near_dedup": OP1,
        "op2_secret_scan": _op2(),
        "op4_mixing": OP4,
        "op7_quality_rules": OP7,
        "op11_importance": OP11,
        "op12_merkle": _op12(),
    }
