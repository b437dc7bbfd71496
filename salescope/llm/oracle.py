"""DuckDB SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

#: levels that the Merkle SQL spells out: enough for 8 ** 7 leaves of a language
_LEVELS = 7

_OP11 = """
WITH p AS (
    SELECT page_id, sha1(coalesce(html, '')) AS hex, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS k FROM pages
), q AS (
    SELECT *, min(page_id) OVER (PARTITION BY k) AS first, row_number() OVER (PARTITION BY k ORDER BY page_id) AS nth FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + CAST(((CAST('0x' || substr(hex, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN nth = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN nth > 1 THEN first END AS refers_to
FROM q"""

_OP12 = """
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), u AS (
    SELECT doc_id, t, regexp_extract_all(t, '[^\\n]*\\n|[^\\n]+') AS units,
           CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
           CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d
), c AS (
    SELECT *, CAST(len(units) AS BIGINT) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u
), s AS (
    SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:], '') AS suffix FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM s"""


def _field(c: str) -> str:
    return f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"


def _crc32(text: str) -> str:
    """Unsigned crc32 of an ASCII text, bit by bit."""
    step = "lambda x, y: xor(x >> 1, 3988292384 * (x & 1))"
    chars = f"list_transform(string_split({text}, ''), lambda c: CAST(ord(c) AS BIGINT))"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {chars}), lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], {step})), 4294967295)"


def _tree(leaves: str, name: str) -> str:
    """CTEs of the levels over ``leaves`` (tree, i, digest): per level a node's
    index, its run's digests, and per leaf the siblings left and right of it."""
    out = [f"{name}0 AS (SELECT tree, i, digest, count(*) OVER (PARTITION BY tree) AS n FROM {leaves})"]
    for k in range(_LEVELS):
        # a tree of one node stays as it is: its digest and index pass through
        out.append(f"{name}{k + 1} AS (SELECT tree, i // 8 AS i, CASE WHEN n > 1 THEN sha256(string_agg(digest, '' ORDER BY i)) ELSE min(digest) END AS digest, "
                   f"(n + 7) // 8 AS n FROM {name}{k} GROUP BY tree, i // 8, n)")
        out.append(f"{name}s{k} AS (SELECT a.tree, a.i, "
                   f"coalesce((SELECT string_agg(b.digest, '' ORDER BY b.i) FROM {name}{k} b WHERE b.tree = a.tree AND b.i // 8 = a.i // 8 AND b.i < a.i), '') AS l, "
                   f"coalesce((SELECT string_agg(b.digest, '' ORDER BY b.i) FROM {name}{k} b WHERE b.tree = a.tree AND b.i // 8 = a.i // 8 AND b.i > a.i), '') AS r, "
                   f"a.n > 1 AS folds FROM {name}{k} a)")
    return ",\n".join(out)


def _op13() -> str:
    columns = ("doc_id", "source", "lang", "n_chars")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    leaf = " || ".join(_field(c) for c in (*columns, "text"))
    lower = " || ".join([*(_field(c) for c in columns), _field(f"translate(text, '{upper}', '{upper.lower()}')")])
    joins, proof, fold = [], [], "claimed"
    for tree, index, name in (("x.tree", "x.i", "a"), ("''", "t.i", "t")):
        for k in range(_LEVELS):
            s = f"{name}j{k}"
            joins.append(f"JOIN {name}s{k} {s} ON {s}.tree = {tree} AND {s}.i = {index} // {8 ** k}")
            proof.append(f"{s}.l || {s}.r")
    steps = []
    before = "claimed"
    for name in ("a", "t"):
        for k in range(_LEVELS):
            s, now = f"{name}j{k}", f"f_{name}{k}"
            steps.append(f"CASE WHEN {s}.folds THEN sha256({s}.l || {before} || {s}.r) ELSE {before} END AS {now}")
            before = now
    return f"""
WITH d AS (
    SELECT doc_id, coalesce('=' || lang, '') AS tree, sha256({leaf}) AS digest,
           CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN sha256({lower}) ELSE sha256({leaf}) END AS claimed FROM documents
), x AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS i FROM d
), {_tree("x", "a")},
roots AS (SELECT '' AS tree, tree AS name, digest, row_number() OVER (ORDER BY CAST(tree AS BLOB)) - 1 AS i FROM a{_LEVELS}),
{_tree("roots", "t")},
y AS (
    SELECT x.doc_id, x.digest AS leaf, t.digest AS subroot, (SELECT digest FROM t{_LEVELS}) AS root,
           sha256({" || ".join(proof)}) AS proof_sha256, x.claimed, {", ".join(steps)}
    FROM x JOIN roots t ON t.name = x.tree {" ".join(joins)}
)
SELECT doc_id, leaf, subroot, root, proof_sha256, {before} AS folded_root, {before} = root AS verified FROM y"""


_WORDS = r"'[^\x20\x09-\x0D]+'"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _grams(of: str, n: int) -> str:
    """(r, i, size, gram) of the table ``of`` (r, words): the runs of n words
    and where they start, ``size`` the words of the row; fewer words are one run."""
    run = ", ".join(f"lead(word, {j}) OVER o" for j in range(n))
    return (f"SELECT * FROM (SELECT r, i, size, concat_ws(' ', {run}) AS gram FROM (SELECT r, len(words) AS size, unnest(words) AS word, "
            f"unnest(range(len(words))) AS i FROM {of}) WINDOW o AS (PARTITION BY r ORDER BY i)) WHERE i <= greatest(size - {n}, 0)")


_OP3 = f"""
WITH RECURSIVE w AS (
    SELECT doc_id AS r, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), {_WORDS}) AS words FROM documents
), s AS (
    SELECT DISTINCT r, gram FROM ({_grams("w", 5)})
), z AS (
    SELECT w.r, coalesce(c.n, 0) AS n FROM w LEFT JOIN (SELECT r, count(*) AS n FROM s GROUP BY r) c ON c.r = w.r
), meet AS (
    SELECT a.r AS a, b.r AS b, count(*) AS n_both FROM s a JOIN s b ON a.gram = b.gram AND a.r <> b.r GROUP BY 1, 2
), link AS (
    SELECT a, b FROM meet JOIN z x ON x.r = a JOIN z y ON y.r = b WHERE 100 * n_both >= 80 * (x.n + y.n - n_both)
), reach AS (
    SELECT r AS a, r AS b FROM z UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b
)
SELECT z.r AS doc_id, z.n AS n_shingles, c.component_id
FROM z JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = z.r"""

#: every window at a place that an item gives is compared exactly
_OP4 = f"""
WITH i AS (
    SELECT row_number() OVER () AS r, item_id, regexp_extract_all(lower(coalesce(text, '')), {_WORDS}) AS words FROM benchmark
), ia AS (
    SELECT r AS k, i AS spot, greatest(size - 4, 1) AS size, gram FROM ({_grams("i", 5)})
), ic AS (
    SELECT k, gram, count(*) AS n FROM ia GROUP BY 1, 2
), d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower(text), {_WORDS}) AS words
    FROM (SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents)
), da AS (
    SELECT r, i AS pos, greatest(size - 4, 1) AS n, gram FROM ({_grams("d", 5)}) SEMI JOIN ic USING (gram)
), placed AS (
    SELECT r, k, n, size, unnest([pos - spot, pos, pos - size + 1]) AS lead FROM da JOIN ia USING (gram)
), place AS (
    SELECT DISTINCT r, k, size, greatest(lead, 0) AS start, least(lead + size, n) AS stop FROM placed
), common AS (
    SELECT r, k, size, start, stop, least(count(*), min(ic.n)) AS n
    FROM place JOIN da USING (r) JOIN ic USING (k, gram) WHERE pos >= start AND pos < stop GROUP BY r, k, size, start, stop, gram
), hit AS (
    SELECT r, k, CAST(sum(n) AS BIGINT) AS shared, stop - start + size - CAST(sum(n) AS BIGINT) AS total FROM common GROUP BY r, k, size, start, stop
)
SELECT d.doc_id, i.item_id, round(max(CAST(shared AS DOUBLE) / total), 6) AS similarity, count(*) AS n_windows
FROM hit JOIN d ON d.r = hit.r JOIN i ON i.r = hit.k WHERE 100 * shared >= 80 * total GROUP BY d.doc_id, i.item_id"""

#: doublings that the SQL of repeats spells out: enough for texts of 2 ** 15 words
_DOUBLINGS = 15


def _op7() -> str:
    """Repeats by prefix doubling: class b of a position is the first position
    of the text where the same 2 ** b words stand; the longest repeat is put
    together from the classes, the largest power first."""
    def covered(n: int) -> str:
        return (f"SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + {n})) AS j FROM ("
                f"SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS again FROM ({_grams('d', n)}) WHERE size >= {n}) WHERE again > 1) GROUP BY r")

    out = ["k0 AS MATERIALIZED (SELECT r, i, c FROM (SELECT r, i, min(i) OVER same AS c, count(*) OVER same AS m FROM "
           "(SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM d) WINDOW same AS (PARTITION BY r, word)) WHERE m > 1)"]
    for b in range(_DOUBLINGS - 1):
        out.append(f"k{b + 1} AS MATERIALIZED (SELECT r, i, c FROM (SELECT x.r, x.i, min(x.i) OVER same AS c, count(*) OVER same AS m FROM k{b} x "
                   f"JOIN k{b} y ON y.r = x.r AND y.i = x.i + {1 << b} WINDOW same AS (PARTITION BY x.r, x.c, y.c)) WHERE m > 1)")
    before = "k0_all"
    out.append("k0_all AS (SELECT r, i, 0 AS c, 0 AS length FROM k0)")
    for b in reversed(range(_DOUBLINGS)):
        out.append(f"h{b} AS MATERIALIZED (SELECT r, i, c, length + {1 << b} AS length FROM (SELECT x.r, x.i, x.length, min(x.i) OVER same AS c, count(*) OVER same AS m "
                   f"FROM {before} x JOIN k{b} y ON y.r = x.r AND y.i = x.i + x.length WINDOW same AS (PARTITION BY x.r, x.c, y.c)) WHERE m > 1)")
        out.append(f"g{b} AS MATERIALIZED (SELECT * FROM h{b} UNION ALL SELECT * FROM {before} WHERE r NOT IN (SELECT r FROM h{b}))")
        before = f"g{b}"
    chain = ",\n".join(out)
    return f"""
WITH d AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS words FROM documents
), lines AS (
    SELECT r, count(*) - count(DISTINCT line) AS n FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)
    WHERE regexp_matches(line, {_WORDS}) GROUP BY r
), three AS ({covered(3)}), eight AS ({covered(8)}),
{chain},
longest AS (SELECT r, max(length) AS n FROM {before} GROUP BY r),
f AS (
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(lines.n, 0) AS n_dup_lines,
           coalesce(three.n, 0) AS n_repeat_words, coalesce(eight.n, 0) AS covered_words, CAST(coalesce(longest.n, 0) AS BIGINT) AS longest_repeat
    FROM d LEFT JOIN lines USING (r) LEFT JOIN three USING (r) LEFT JOIN eight USING (r) LEFT JOIN longest USING (r)
), v AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f
)
SELECT *, NOT base_failed AND 100 * covered_words <= 40 * n_words AND longest_repeat <= 100 AS kept FROM v"""


SQL = {"op3_ngram_join": _OP3, "op4_decontamination": _OP4, "op7_quality_rules": _op7(),
       "op11_warc": _OP11, "op12_fill_in_middle": _OP12, "op13_merkle_manifest": _op13()}
