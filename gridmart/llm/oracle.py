"""DuckDB twins of those queries that SQL can express."""

SQL: dict[str, str] = {}

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL["op4_jaccard"] = rf"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), grams AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) END AS g
    FROM split
), sets AS (
    SELECT doc_id, g, len(g) AS n, dense_rank() OVER (ORDER BY md5(array_to_string(list_sort(g), chr(10)))) AS node FROM grams
), nodes AS (
    SELECT node, any_value(g) AS g, any_value(n) AS n FROM sets WHERE n > 0 GROUP BY node
), has AS (
    SELECT node, n, unnest(g) AS s FROM nodes
), shared AS (
    SELECT a.node AS one, b.node AS other, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS common
    FROM has a JOIN has b ON a.s = b.s AND a.node <> b.node AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    GROUP BY 1, 2
), links AS (
    SELECT one, other FROM shared WHERE 100 * common >= 80 * (n + m - common)
), reached AS (
    SELECT node AS one, node AS other FROM nodes
    UNION
    SELECT r.one, l.other FROM reached r JOIN links l ON r.other = l.one
), lows AS (
    SELECT node, min(doc_id) AS low FROM sets WHERE n > 0 GROUP BY node
), found AS (
    SELECT one AS node, min(low) AS component FROM reached JOIN lows ON other = lows.node GROUP BY one
)
SELECT s.doc_id, s.n AS n_shingles, coalesce(f.component, s.doc_id) AS component_id
FROM sets s LEFT JOIN found f ON s.node = f.node AND s.n > 0
"""

_DIGIT = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((p >> {0}) & 31 AS INTEGER), 1)"
_EIGHT = " || ".join(_DIGIT.format(5 * i) for i in reversed(range(8)))

SQL["op8_warc"] = f"""
WITH hashed AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), digits AS (
    SELECT h, string_agg({_EIGHT}, '' ORDER BY i) AS payload_digest
    FROM (SELECT h, i, CAST('0x' || substr(h, 1 + 10 * i, 10) AS UBIGINT) AS p
        FROM (SELECT DISTINCT h FROM hashed), (SELECT unnest([0, 1, 2, 3]) AS i))
    GROUP BY h
), firsts AS (
    SELECT h, min(page_id) AS first FROM hashed GROUP BY h
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id > first THEN first END AS refers_to
FROM hashed JOIN digits USING (h) JOIN firsts USING (h)
"""

_FIELD = "coalesce(strlen({0}) || ':' || {0}, '-')"


def _leaf(text: str) -> str:
    values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return f"sha256({' || '.join(_FIELD.format(v) for v in values)})"


# The remainder of a CRC by 2 is its last bit: the polynomial's steps are XORs, written out bit by bit.
_CRC = """CAST(list_reduce(
    list_prepend(CAST(4294967295 AS UBIGINT), list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1),
        lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), i, 1)) AS UBIGINT))),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), CAST([1, 1, 1, 1, 1, 1, 1, 1] AS UBIGINT[])),
        lambda c, one: CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS UBIGINT)) ELSE c >> 1 END)) AS UBIGINT)"""

SQL["op11_manifest"] = f"""
WITH RECURSIVE hashed AS (
    SELECT doc_id, source, {_leaf('text')} AS leaf,
        CASE WHEN xor({_CRC}, CAST(4294967295 AS UBIGINT)) % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")}
            ELSE {_leaf('text')} END AS tampered
    FROM documents
), leaves AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, tampered) - 1 AS place FROM hashed
), trees AS (
    SELECT source, 0 AS level, place, leaf AS digest, count(*) OVER (PARTITION BY source) AS n FROM leaves
    UNION ALL
    SELECT source, level + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)), any_value((n + 2) // 3)
    FROM trees WHERE n > 1 GROUP BY source, level, place // 3
), subroots AS (
    SELECT source, level AS height, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place FROM trees WHERE n = 1
), upper AS (
    SELECT 0 AS level, place, digest, count(*) OVER () AS n FROM subroots
    UNION ALL
    SELECT level + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)), any_value((n + 2) // 3)
    FROM upper WHERE n > 1 GROUP BY level, place // 3
), top AS (
    SELECT level AS height, digest AS root FROM upper WHERE n = 1
), places AS (
    SELECT l.source, l.place AS leaf_at, s.place AS source_at, s.height, s.digest AS subroot, t.height AS upper_height, t.root
    FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source, top t
), steps AS (
    SELECT source, leaf_at, unnest(range(0, height)) AS step, leaf_at // CAST(3 ** unnest(range(0, height)) AS BIGINT) AS place,
        FALSE AS above FROM places
    UNION ALL
    SELECT source, leaf_at, height + unnest(range(0, upper_height)),
        source_at // CAST(3 ** unnest(range(0, upper_height)) AS BIGINT), TRUE FROM places
), nodes AS (
    SELECT source, level AS step, place, digest, FALSE AS above FROM trees
    UNION ALL
    SELECT s.source, s.height + u.level, u.place, u.digest, TRUE FROM upper u, subroots s
), beside AS (
    SELECT p.source, p.leaf_at, p.step,
        coalesce(string_agg(n.digest, '' ORDER BY n.place) FILTER (WHERE n.place < p.place), '') AS lefts,
        coalesce(string_agg(n.digest, '' ORDER BY n.place) FILTER (WHERE n.place > p.place), '') AS rights
    FROM steps p JOIN nodes n ON p.source IS NOT DISTINCT FROM n.source AND p.step = n.step AND p.above = n.above
        AND p.place // 3 = n.place // 3
    GROUP BY ALL
), paths AS (
    SELECT source, leaf_at, sha256(string_agg(lefts || rights, '' ORDER BY step)) AS proof,
        list(lefts ORDER BY step) AS l, list(rights ORDER BY step) AS r FROM beside GROUP BY ALL
), folded AS (
    SELECT l.source, l.place, 0 AS step, l.tampered AS digest FROM leaves l
    UNION ALL
    SELECT f.source, f.place, f.step + 1, sha256(p.l[f.step + 1] || f.digest || p.r[f.step + 1])
    FROM folded f JOIN paths p ON f.source IS NOT DISTINCT FROM p.source AND f.place = p.leaf_at WHERE f.step < len(p.l)
), ends AS (
    SELECT source, place, arg_max(digest, step) AS folded_root FROM folded GROUP BY ALL
)
SELECT l.doc_id, l.leaf, p.subroot, p.root, coalesce(q.proof, sha256('')) AS proof_sha256, e.folded_root,
    e.folded_root = p.root AS verified
FROM leaves l JOIN places p ON l.source IS NOT DISTINCT FROM p.source AND l.place = p.leaf_at
JOIN ends e ON l.source IS NOT DISTINCT FROM e.source AND l.place = e.place
LEFT JOIN paths q ON l.source IS NOT DISTINCT FROM q.source AND l.place = q.leaf_at
"""

SQL["op12_phrases"] = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
        regexp_extract_all(unnest(regexp_split_to_array({LOWER}, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
    FROM documents
), totals AS (
    SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang
), grams AS (
    SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: w[i : i + size - 1])) AS g
    FROM pieces, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE len(w) >= size
), frequent AS (
    SELECT lang, size, g, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 30
), cuts AS (
    SELECT c.lang, c.size, c.g, c.a, k, l.a AS l, r.a AS r,
        (2000000 * CAST(c.a AS HUGEINT)) // (CAST(l.a AS HUGEINT) + r.a) AS score
    FROM (SELECT *, unnest(range(1, size)) AS k FROM frequent WHERE size > 1) c
    JOIN frequent l ON l.lang = c.lang AND l.g = c.g[1 : k]
    JOIN frequent r ON r.lang = c.lang AND r.g = c.g[k + 1 : c.size]
), candidates AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), parts AS (
    SELECT lang, a, unnest(list_transform(range(1, size - length + 2), lambda i: g[i : i + length - 1])) AS g
    FROM candidates, (SELECT unnest([2, 3]) AS length) WHERE length < size
), longer AS (
    SELECT lang, g, max(a) AS most FROM parts GROUP BY ALL
), kept AS (
    SELECT c.*, array_to_string(c.g, ' ') AS phrase FROM candidates c LEFT JOIN longer o ON c.lang = o.lang AND c.g = o.g
    WHERE o.most IS NULL OR 100 * CAST(o.most AS HUGEINT) < 80 * CAST(c.a AS HUGEINT)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
    CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""

# Seats by ranking every quotient; words by listing what each block of a source gives.
SQL["op13_mixing"] = r"""
WITH RECURSIVE docs AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size, md5(text) AS same,
        md5(concat_ws('|', '0', CAST(doc_id AS VARCHAR))) AS place
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS words, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM docs GROUP BY source
), weighed AS (
    SELECT *, CAST([1, 2, 3][1 + i % 3] AS DOUBLE) AS weight, CAST(3 * words AS DOUBLE) AS most FROM sources
), levels AS (
    SELECT 0 AS round, CAST([] AS BIGINT[]) AS capped, (SELECT sum(words) / sum(weight) FROM weighed) AS level
    UNION ALL
    SELECT round + 1, found, (SELECT (sum(words) - coalesce(sum(most) FILTER (WHERE list_contains(found, i)), 0))
            / nullif(sum(weight) FILTER (WHERE NOT list_contains(found, i)), 0) FROM weighed)
    FROM (SELECT round, capped, level, (SELECT list(i ORDER BY i) FROM weighed WHERE weight * level >= most) AS found
        FROM levels WHERE level IS NOT NULL)
    WHERE found IS NOT NULL AND found <> capped
), last AS (
    SELECT arg_max(capped, round) AS capped, arg_max(level, round) AS level FROM levels
), aimed AS (
    SELECT w.*, CASE WHEN list_contains(capped, i) THEN most ELSE coalesce(weight * level, 0) END AS target
    FROM weighed w, last
), seats AS (
    SELECT i, target / (2 * unnest(range(0, (SELECT CAST(floor(sum(target) / 16 + 0.5) AS BIGINT) FROM aimed))) + 1) AS quotient
    FROM aimed WHERE words > 0
), won AS (
    SELECT i, count(*) AS quota FROM (SELECT * FROM seats
        QUALIFY row_number() OVER (ORDER BY quotient DESC, i) <= (SELECT floor(sum(target) / 16 + 0.5) FROM aimed))
    GROUP BY i
), shards AS (
    SELECT a.i, a.source, (a.words + 15) // 16 AS blocks, least(coalesce(quota, 0), 3 * ((a.words + 15) // 16)) AS quota,
        unnest(range(0, ((a.words + 15) // 16 + 65535) // 65536)) AS shard
    FROM aimed a LEFT JOIN won USING (i) WHERE words > 0
), held AS (
    SELECT *, least(65536, blocks - shard * 65536) AS held FROM shards
), shard_seats AS (
    SELECT i, shard, held, quota, held / (2 * unnest(range(0, CAST(quota AS BIGINT))) + 1) AS quotient FROM held
), dealt AS (
    SELECT i, shard, count(*) AS gives FROM (SELECT * FROM shard_seats
        QUALIFY row_number() OVER (PARTITION BY i ORDER BY quotient DESC, shard) <= quota) GROUP BY ALL
), blocks AS (
    SELECT h.i, h.source, h.shard * 65536 + j AS block,
        coalesce(gives, 0) // held + CASE WHEN (j - start + held) % held < coalesce(gives, 0) % held THEN 1 ELSE 0 END AS times
    FROM (SELECT *, CAST('0x' || substr(md5(concat_ws('|', '0', source, CAST(shard AS VARCHAR))), 1, 8) AS BIGINT) % held AS start,
        unnest(range(0, CAST(held AS BIGINT))) AS j FROM held) h LEFT JOIN dealt d ON h.i = d.i AND h.shard = d.shard
), placed AS (
    SELECT *, sum(size) OVER (PARTITION BY source ORDER BY place, doc_id NULLS FIRST, size, same NULLS FIRST
        ROWS UNBOUNDED PRECEDING) - size AS begin, row_number() OVER () AS row FROM docs
), pieces AS (
    SELECT row, source, begin, size, unnest(range(CAST(begin // 16 AS BIGINT), CAST((begin + size + 15) // 16 AS BIGINT))) AS block
    FROM placed WHERE size > 0
), taken AS (
    SELECT p.row, sum(times * (least(p.begin + p.size, 16 * (p.block + 1)) - greatest(p.begin, 16 * p.block))) AS taken
    FROM pieces p JOIN blocks b ON p.source IS NOT DISTINCT FROM b.source AND p.block = b.block GROUP BY p.row
)
SELECT p.doc_id, p.size, CAST(a.words AS BIGINT) AS source_size, a.target, CAST(coalesce(t.taken, 0) AS BIGINT) AS taken
FROM placed p JOIN aimed a ON p.source IS NOT DISTINCT FROM a.source LEFT JOIN taken t ON p.row = t.row
"""

SQL["op10_covertree"] = """
WITH RECURSIVE sound AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
      AND len(list_filter(embedding, lambda c: c <> 0)) > 0
), links AS (
    SELECT a.vec_id AS one, b.vec_id AS other
    FROM sound a JOIN sound b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
    WHERE list_dot_product(a.v, b.v)
        / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.98
), reached AS (
    SELECT vec_id AS one, vec_id AS other FROM sound
    UNION
    SELECT r.one, l.other FROM reached r JOIN links l ON r.other = l.one
), lowest AS (
    SELECT one, min(other) AS component_id FROM reached GROUP BY one
), counted AS (
    SELECT one, count(*) AS n_links FROM links GROUP BY one
)
SELECT e.vec_id, coalesce(c.n_links, 0) AS n_links,
       coalesce(l.component_id, e.vec_id) AS component_id,
       e.vec_id = coalesce(l.component_id, e.vec_id) AS kept
FROM embeddings e
LEFT JOIN lowest l ON l.one = e.vec_id
LEFT JOIN counted c ON c.one = e.vec_id
"""
