"""DuckDB SQL for the registered queries that SQL can express on whole tables."""

_SHINGLES = """
    list_distinct(CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) <= 5 THEN [array_to_string(w, ' ')]
        ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]
    END)
"""

_WORDS = r"""
    regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[0-9a-z\x{80}-\x{10FFFF}]+'
    )
"""



def _crc32(column: str) -> str:
    """The unsigned CRC-32 of a number's decimal digits: bytes are folded in, -1 stands for one shift."""
    steps = f"flatten(list_transform(string_split(CAST({column} AS VARCHAR), ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END"
    return f"xor(list_reduce(list_prepend(4294967295, {steps}::BIGINT[]), lambda a, x: {step}), 4294967295)"


def _field(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR), '-')"


_LEAF = " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars")))

# One level of the trees at a time; a group's nodes go on while there is more than one.
_TREE = """
    {name}(grp, lvl, pos, n, h) AS (
        SELECT grp, 0, pos, n, h FROM {leaves}
        UNION ALL
        SELECT grp, any_value(lvl) + 1, pos // 3, any_value((n + 2) // 3), sha256(string_agg(h, '' ORDER BY pos))
        FROM {name} WHERE n > 1 GROUP BY grp, pos // 3
    ),
    {name}_sides AS (
        SELECT a.grp, a.lvl, a.pos,
               string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos) AS l,
               string_agg(b.h, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos) AS r
        FROM {name} a JOIN {name} b ON a.grp = b.grp AND a.lvl = b.lvl AND a.pos // 3 = b.pos // 3
        WHERE a.n > 1 GROUP BY a.grp, a.lvl, a.pos
    )
"""

ORACLE = {
    "op4_decontamination": f"""
        WITH dw AS (SELECT doc_id, row_number() OVER () AS rid, {_WORDS} AS w FROM documents),
        d AS (SELECT doc_id, rid, unnest({_SHINGLES}) AS s FROM dw),
        iw AS (SELECT item_id, row_number() OVER () AS no, {_WORDS} AS w FROM benchmark),
        ia AS (SELECT item_id, no, {_SHINGLES} AS shingles FROM iw WHERE len(w) > 4),
        i AS (SELECT item_id, no, len(shingles) AS item_shingles, unnest(shingles) AS s FROM ia),
        hits AS (
            SELECT doc_id, item_id, item_shingles, count(*) AS shared_shingles
            FROM d JOIN i USING (s) GROUP BY doc_id, rid, item_id, no, item_shingles
        ),
        short AS (SELECT item_id, ' ' || array_to_string(w, ' ') || ' ' AS run FROM iw WHERE len(w) BETWEEN 1 AND 4),
        held AS (
            SELECT doc_id, item_id FROM dw JOIN short ON contains(' ' || array_to_string(w, ' ') || ' ', run)
        )
        SELECT doc_id, item_id, item_shingles, shared_shingles, shared_shingles / item_shingles AS containment
        FROM hits WHERE shared_shingles * 5 >= item_shingles * 4
        UNION ALL SELECT doc_id, item_id, 1, 1, 1.0 FROM held
    """,
    "op8_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
        FROM d JOIN g USING (t)
    """,
    "op5_line_dedup": r"""
        WITH d AS (
            SELECT doc_id, source, string_split(text, chr(10)) AS ls, row_number() OVER () AS rid FROM documents
        ),
        l AS (SELECT rid, source, unnest(ls) AS line FROM d),
        b AS (
            SELECT line FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
            GROUP BY line HAVING count(DISTINCT coalesce('s' || source, 'n')) >= 5
        ),
        u AS (SELECT rid, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
        k AS (
            SELECT rid, count(*) AS n_lines, count(b.line) AS n_removed,
                   string_agg(u.line, chr(10) ORDER BY pos) FILTER (WHERE b.line IS NULL) AS kept
            FROM u LEFT JOIN b ON u.line = b.line GROUP BY rid
        )
        SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
               sha256(coalesce(kept, '')) AS text_sha256
        FROM d LEFT JOIN k USING (rid)
    """,
    "op10_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
        d AS (SELECT page_id, strlen(t) AS payload_bytes, sha256(t) AS payload_digest FROM p),
        f AS (SELECT payload_digest, min(page_id) AS first_id FROM d GROUP BY payload_digest)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
        FROM d JOIN f USING (payload_digest)
    """,
    "op11_prefix_trie": f"""
        WITH t AS (
            SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i
            FROM conversations WHERE conv_id IS NOT NULL
        ),
        s AS (SELECT c, list({{'role': role, 'text': text}} ORDER BY i) AS turns FROM t GROUP BY c),
        h AS (SELECT c, turns, {_crc32("c")} % 9 AS h FROM s),
        v AS (
            SELECT h.c, list_concat(coalesce(list_slice(d.turns, 1, h.h), []), list_slice(h.turns, h.h + 1, len(h.turns))) AS turns
            FROM h LEFT JOIN s d ON d.c = h.c - h.c % 5
        ),
        m AS (SELECT c, len(turns) AS n, unnest(range(0, len(turns) + 1)) AS d, turns FROM v),
        p AS (SELECT c, n, d, list_slice(turns, 1, d) AS k, CASE WHEN d > 0 THEN strlen(turns[d].text) ELSE 0 END AS size FROM m),
        g AS (
            SELECT k, d, min(c) AS c, count(*) AS members, any_value(size) AS size,
                   sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE n = d), '')) AS ends,
                   count(*) FILTER (WHERE n > d) = 0 AS leaf
            FROM p GROUP BY k, d
        ),
        below AS (
            SELECT list_slice(k, 1, u) AS k, sum(leaf::INT) AS leaves, sum((members - 1) * size) AS saved, sum((u = d - 1)::INT) AS children
            FROM (SELECT *, unnest(range(0, d + 1)) AS u FROM g) GROUP BY list_slice(k, 1, u)
        )
        SELECT g.c AS conv_id, g.d AS depth, o.c AS parent_conv_id, g.members AS n_convs, CAST(children AS BIGINT) AS n_children,
               CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, g.ends AS ends_sha256
        FROM g JOIN below USING (k) LEFT JOIN g o ON g.d > 0 AND o.d = g.d - 1 AND o.k = list_slice(g.k, 1, g.d - 1)
    """,
    "op13_merkle": f"""
        WITH RECURSIVE f AS (
            SELECT doc_id, source, sha256({_LEAF} || {_field("text")}) AS leaf,
                   CASE WHEN {_crc32("doc_id")} % 2 = 0
                        THEN sha256({_LEAF} || {_field("replace(text, chr(10), '')")}) END AS changed
            FROM documents
        ),
        leaves AS (
            SELECT *, source AS grp0, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS grp,
                   row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                   count(*) OVER (PARTITION BY source) AS n, leaf AS h
            FROM f
        ),
        {_TREE.format(name="one", leaves="leaves")},
        subroots AS (SELECT grp, h AS subroot FROM one WHERE n = 1),
        sources AS (SELECT 0 AS grp, grp AS pos, count(*) OVER () AS n, subroot AS h FROM subroots),
        {_TREE.format(name="two", leaves="sources")},
        steps AS (
            SELECT q.rid, s.lvl AS step, coalesce(l, '') AS l, coalesce(r, '') AS r
            FROM (SELECT grp, pos, grp * 4294967296 + pos AS rid FROM leaves) q
            JOIN one_sides s ON s.grp = q.grp AND s.pos = q.pos // CAST(pow(3, s.lvl) AS BIGINT)
            UNION ALL
            SELECT q.rid, 1000 + s.lvl, coalesce(l, ''), coalesce(r, '')
            FROM (SELECT grp, pos, grp * 4294967296 + pos AS rid FROM leaves) q
            JOIN two_sides s ON s.pos = q.grp // CAST(pow(3, s.lvl) AS BIGINT)
        ),
        paths AS (
            SELECT rid, list([l, r] ORDER BY step) AS path, sha256(string_agg(l || r, '' ORDER BY step)) AS proof FROM steps GROUP BY rid
        ),
        folded AS (
            SELECT leaves.doc_id, leaves.leaf, leaves.grp, coalesce(proof, sha256('')) AS proof,
                   list_reduce(list_prepend([coalesce(changed, leaf)], coalesce(path, [])), lambda a, x: [sha256(x[1] || a[1] || x[2])])[1] AS node
            FROM leaves LEFT JOIN paths ON paths.rid = leaves.grp * 4294967296 + leaves.pos
        )
        SELECT doc_id, leaf, subroot, (SELECT h FROM two WHERE n = 1) AS root, proof AS proof_sha256, node AS folded_root,
               node = (SELECT h FROM two WHERE n = 1) AS verified
        FROM folded JOIN subroots USING (grp)
    """,
}
