"""DuckDB statements for the registered queries of this package, where SQL can express them."""

from __future__ import annotations

import string

from wattlake.llm.licences import SPELLINGS
from wattlake.llm.license_scan import known_digests


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def ascii_lower(text: str) -> str:
    return f"translate({text}, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def op1_license_scan() -> str:
    canon = ascii_lower("coalesce(text, '')")
    steps = [
        (r"(?m)^[^a-z0-9\n]*(copyright|\(c\)|©)[^\n]*$", ""),
        (r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+", " "),
        (r"(?m)^ +| +$", ""),
        *[(rf"\b{old}\b", new) for old, new in SPELLINGS],
    ]
    for pattern, by in steps:
        canon = f"regexp_replace({canon}, {quoted(pattern)}, {quoted(by)}, 'g')"
    rows = ", ".join(f"({quoted(d)}, {quoted(x)})" for d, x in known_digests().items())
    return f"""
    WITH known(digest, license) AS (VALUES {rows}),
    canon AS (SELECT doc_id, {canon} AS lines FROM documents),
    hits AS (
        SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS notices, count(*) AS n
        FROM (SELECT doc_id, unnest(string_split(lines, chr(10))) AS line FROM canon)
        JOIN known ON digest = sha256(line)
        GROUP BY doc_id
    ),
    whole AS (
        SELECT doc_id, sha256(trim(regexp_replace(lines, '\\n+', ' ', 'g'), ' ')) AS canonical_sha256
        FROM canon
    )
    SELECT doc_id, canonical_sha256, license, coalesce(notices, '') AS notices,
           coalesce(n, 0) AS n_notices
    FROM whole LEFT JOIN known ON digest = canonical_sha256 LEFT JOIN hits USING (doc_id)
    """


def op2_interleaved_shards(shards: int = 8, seed: str = "mix-1") -> str:
    even = "(('0x' || substr(md5({0}), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"
    lot = even.format(f"'{seed}|' || doc_id")
    shift = even.format(f"'{seed}|' || stratum")
    return f"""
    WITH crc(entries) AS (
        SELECT list(list_reduce(range(8),
            lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b)
        FROM (SELECT range AS b FROM range(256))
    ),
    bytes AS (
        SELECT doc_id, source, strlen(coalesce(text, '')) + 1 AS size,
               regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS pairs
        FROM documents
    ),
    narrow AS (
        SELECT doc_id, source, size, xor(4294967295, list_reduce(
                   list_transform(pairs, lambda x: ('0x' || x)::BIGINT),
                   lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1]), 4294967295)) AS text_crc32
        FROM bytes, crc
    ),
    lots AS (
        SELECT *, CASE WHEN source IS NULL THEN '-' ELSE '=' || source END AS stratum FROM narrow
    ),
    drawn AS (
        SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY {lot}, doc_id) - 1 AS place_in,
               count(*) OVER (PARTITION BY stratum) AS n
        FROM lots
    ),
    placed AS (
        SELECT *, count(*) OVER () AS total,
               row_number() OVER (ORDER BY (place_in + {shift}) / n, stratum, doc_id) - 1 AS place
        FROM drawn
    )
    SELECT doc_id, size, text_crc32, 'rows' AS law, (place * {shards} // total)::INTEGER AS shard,
           place - (place * {shards} // total * total + {shards} - 1) // {shards} AS slot,
           NULL::INTEGER AS grown_shard, source
    FROM placed
    """


def op3_exact_dedup() -> str:
    plain = ascii_lower("coalesce(text, '')")
    return f"""
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
    FROM (
        SELECT doc_id, text_sha256, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size
        FROM (SELECT doc_id, sha256({plain}) AS text_sha256 FROM documents)
    )
    """


def op11_collocations(least: int = 30, top: int = 2000) -> str:
    return f"""
    WITH pieces AS (
        SELECT lang, unnest(regexp_split_to_array(plain, '[.,;:!?\\x0A-\\x0D]')) AS piece
        FROM (SELECT coalesce(lang, 'und') AS lang, {ascii_lower("coalesce(text, '')")} AS plain FROM documents)
    ),
    cut AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
    starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM cut),
    grams AS (
        SELECT lang, m, w[i:i + m - 1] AS words, count(*) AS f
        FROM starts, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE i + m - 1 <= len(w)
        GROUP BY ALL
    ),
    totals AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE m = 1 GROUP BY lang),
    candidates AS (SELECT * FROM grams WHERE m > 1 AND f >= {least}),
    inner_parts AS (
        SELECT lang, words[i:i + k - 1] AS words, f
        FROM (SELECT *, unnest(range(1, m + 1)) AS i FROM candidates),
             (SELECT unnest([2, 3]) AS k)
        WHERE k < m AND i + k - 1 <= m
    ),
    longest AS (SELECT lang, words, max(f) AS f FROM inner_parts GROUP BY ALL),
    apart AS (
        SELECT c.* FROM candidates c LEFT JOIN longest x USING (lang, words)
        WHERE x.f IS NULL OR 100::HUGEINT * x.f < 80::HUGEINT * c.f
    ),
    cuts AS (
        SELECT c.lang, c.words, c.f AS a, k, l.f AS l, r.f AS r,
               (2000000::HUGEINT * c.f // (l.f::HUGEINT + r.f))::BIGINT AS score
        FROM (SELECT *, unnest(range(1, m)) AS k FROM apart) c
        JOIN grams l ON l.lang = c.lang AND l.words = c.words[1:c.k]
        JOIN grams r ON r.lang = c.lang AND r.words = c.words[c.k + 1:c.m]
    ),
    worst AS (
        SELECT lang, array_to_string(words, ' ') AS phrase, a, l, r, score
        FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1
    )
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
           phrase, a, l, r, n, score
    FROM worst JOIN totals USING (lang) QUALIFY rank <= {top}
    """


def op12_centroids(k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: str = "1") -> str:
    steps = []
    for turn in range(rounds + 1):
        steps.append(f"""
    near{turn} AS (
        SELECT id, v, cluster, distance FROM (
            SELECT p.id, p.v, c.cluster, p.row,
                   list_sum(list_transform(range(1, {dims + 1}), lambda i: (p.v[i] - c.v[i]) ** 2))::BIGINT AS distance
            FROM points p, centroids{turn} c
        ) QUALIFY row_number() OVER (PARTITION BY row ORDER BY distance, cluster) = 1
    )""")
        if turn < rounds:
            steps.append(f"""
    sums{turn} AS (
        SELECT cluster, i, sum(x)::BIGINT AS total, count(*) AS n
        FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM near{turn}) GROUP BY ALL
    ),
    means{turn} AS (
        SELECT cluster, list((total - ((total % n) + n) % n) // n ORDER BY i) AS v FROM sums{turn} GROUP BY cluster
    ),
    centroids{turn + 1} AS (
        SELECT c.cluster, coalesce(m.v, c.v) AS v FROM centroids{turn} c LEFT JOIN means{turn} m USING (cluster)
    )""")
    return f"""
    WITH points AS (
        SELECT vec_id AS id, row_number() OVER () AS row,
               list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
        FROM embeddings
        WHERE len(embedding) = {dims}
          AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE)))
    ),
    centroids0 AS (
        SELECT (row_number() OVER (ORDER BY h, v) - 1)::INTEGER AS cluster, v
        FROM (SELECT v, sha256('{seed}:' || coalesce(id::VARCHAR, '')) AS h FROM points) QUALIFY cluster < {k}
    ),{",".join(steps)}
    SELECT id AS vec_id, cluster, distance,
           sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
           sum(distance) OVER ()::BIGINT AS inertia,
           sha256(array_to_string(c.v, ',')) AS centroid_sha256
    FROM near{rounds} JOIN centroids{rounds} c USING (cluster)
    """


def statements() -> dict[str, str]:
    made = [op1_license_scan, op2_interleaved_shards, op3_exact_dedup, op11_collocations, op12_centroids]
    return {make.__name__: make() for make in made}
