"""DuckDB statements for the queries here that SQL can express."""

from __future__ import annotations

from tastegrid.llm.decontamination import EQUAL, MASKS, WINDOW

_SPAN = max(mask[-1] for mask in MASKS) + 1


def _words(table: str, key: str) -> str:
    return f"""
    SELECT {key}, row, list_filter(
        regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') AS words
    FROM (SELECT {key}, text, row_number() OVER () AS row FROM {table})"""


def _seeds(source: str, columns: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT {columns}, i AS place, {number} AS mask, concat_ws(' ', {', '.join(f'words[i + {1 + k}]' for k in mask)}) AS seed
    FROM (SELECT *, unnest(range(0, len(words) - {_SPAN - 1})) AS i FROM {source})"""
        for number, mask in enumerate(MASKS)
    )


def overlaps_sql(documents: str = "documents") -> str:
    """Pairs that share a seed, compared word by word at the shift of the seed."""
    return f"""
WITH d AS ({_words(documents, 'doc_id')}), b AS ({_words('benchmark', 'item_id')}),
ds AS ({_seeds('d', 'row')}), bs AS ({_seeds('b', 'item_id')}),
shifts AS (SELECT DISTINCT ds.row, bs.item_id, ds.place - bs.place AS shift FROM ds JOIN bs USING (mask, seed)),
compared AS (
    SELECT d.row, d.doc_id, b.item_id, shift, len(b.words) AS n, j,
           (j + shift >= 0 AND coalesce(d.words[j + shift + 1] = b.words[j + 1], false))::INT AS same
    FROM shifts JOIN d USING (row) JOIN b USING (item_id), unnest(range(0, len(b.words))) AS p(j)),
windows AS (
    SELECT *, sum(same) OVER (PARTITION BY row, item_id, shift ORDER BY j ROWS {WINDOW - 1} PRECEDING) AS near,
           sum(same) OVER (PARTITION BY row, item_id, shift) AS total
    FROM compared),
aligned AS (
    SELECT row, doc_id, item_id, shift, n, max(near) AS best, max(total) AS total FROM windows
    WHERE j >= least({WINDOW}, n) - 1 GROUP BY ALL)
SELECT doc_id, item_id, max(n)::INT AS item_words, max(best)::INT AS window_words, max(total)::INT AS equal_words
FROM aligned WHERE best >= CASE WHEN n >= {WINDOW} THEN {EQUAL} ELSE n - n // 5 END
GROUP BY doc_id, item_id"""


# Every string of 100 bytes is looked up; equal ids, which the test tables do not
# have, would be taken as one document.
_REPEATS = """
WITH texts AS (SELECT doc_id, encode(coalesce(text, '')) AS raw FROM documents),
windows AS MATERIALIZED (
    SELECT doc_id, start, md5_number(raw[start + 1:start + 100]) AS content
    FROM (SELECT doc_id, raw, unnest(range(0, octet_length(raw) - 99)) AS start FROM texts)),
again AS (
    SELECT doc_id, start FROM windows SEMI JOIN (
        SELECT content FROM windows GROUP BY content HAVING count(*) > 1) USING (content)
    QUALIFY row_number() OVER (PARTITION BY content ORDER BY doc_id, start) > 1),
opened AS (
    SELECT *, start > coalesce(lag(start) OVER (PARTITION BY doc_id ORDER BY start) + 100, -1) AS opens FROM again),
numbered AS (SELECT *, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY start) AS run FROM opened),
runs AS (SELECT doc_id, min(start) AS first, max(start) + 100 AS last FROM numbered GROUP BY doc_id, run),
between_runs AS (
    SELECT doc_id, first, last, coalesce(lag(last) OVER (PARTITION BY doc_id ORDER BY first), 0) AS kept_from FROM runs),
cut AS (
    SELECT doc_id, sum(last - first)::BIGINT AS n_removed, count(*) AS n_spans, max(last) AS kept_from,
           string_agg(hex(raw[kept_from + 1:first]), '' ORDER BY first) AS kept
    FROM between_runs JOIN texts USING (doc_id) GROUP BY doc_id)
SELECT doc_id, octet_length(raw) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(from_hex(coalesce(kept, '') || hex(raw[coalesce(kept_from, 0) + 1:]))) AS kept_sha256
FROM texts LEFT JOIN cut USING (doc_id)"""

# Checksums bit by bit; ranks by source, and positions, by windows over everything.
_SHARDS = """
WITH codes AS (
    SELECT list(code ORDER BY byte) AS codes FROM (
        SELECT byte, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END,
                                 byte) AS code
        FROM range(256) AS b(byte))),
texts AS (
    SELECT row_number() OVER () AS row, doc_id, coalesce('=' || source, '') AS source, encode(coalesce(text, '')) AS raw
    FROM documents),
lines AS (
    SELECT row, list(byte ORDER BY spot) AS line
    FROM (SELECT row, spot, hex(raw[spot + 1:spot + 1]) AS digits
          FROM (SELECT row, raw, unnest(range(octet_length(raw))) AS spot FROM texts))
    JOIN (SELECT printf('%02X', byte) AS digits, byte FROM range(256) AS b(byte)) USING (digits) GROUP BY row),
sums AS (
    SELECT row, xor(list_reduce(line, lambda c, byte: xor(c >> 8, codes[(xor(c, byte) & 255) + 1]), 4294967295::BIGINT),
                    4294967295) AS crc
    FROM lines, codes),
ranked AS (
    SELECT doc_id, source, octet_length(raw) + 1 AS size, coalesce(crc, 0) AS crc, count(*) OVER (PARTITION BY source) AS n,
           row_number() OVER (PARTITION BY source ORDER BY md5('7:' || doc_id), doc_id, crc, size) AS rank
    FROM texts LEFT JOIN sums USING (row)),
placed AS (
    SELECT *, row_number() OVER (ORDER BY (2 * rank - 1) / (2 * n), source, rank) - 1 AS place, count(*) OVER () AS total
    FROM ranked),
cut AS (SELECT *, place * 8 // total AS shard FROM placed)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'rows' AS law, CAST(shard AS INT) AS shard,
       CAST(place - (shard * total + 7) // 8 AS BIGINT) AS slot, CAST(NULL AS INT) AS grown_shard
FROM cut"""

_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def phrases_sql(documents: str = "documents", least: int = 100, longest: int = 5, most: int = 2000) -> str:
    """Every phrase of every piece, counted as text; a phrase is dropped for any
    longer one, and each cut is scored in 128-bit whole numbers."""
    return f"""
WITH lowered AS (
    SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{_CAPITALS}', '{_SMALL}') AS text FROM {documents}),
pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM lowered),
split AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces),
phrases AS (
    SELECT lang, size, unnest(list_transform(range(1, len(words) - size + 2),
        lambda i: array_to_string(words[i:i + size - 1], ' '))) AS phrase
    FROM split, range(1, {longest + 1}) AS sizes(size) WHERE len(words) >= size),
counts AS (SELECT lang, size, phrase, count(*) AS times FROM phrases GROUP BY ALL),
totals AS (SELECT lang, sum(times) AS n FROM counts WHERE size = 1 GROUP BY lang),
frequent AS (SELECT lang, size, phrase, times, string_split(phrase, ' ') AS words FROM counts WHERE times >= {least}),
inside AS (
    SELECT DISTINCT lang, times, array_to_string(words[place:place + shorter - 1], ' ') AS phrase FROM (
        SELECT *, unnest(range(1, size - shorter + 2)) AS place FROM (
            SELECT *, unnest(range(2, size)) AS shorter FROM frequent))),
kept AS (
    SELECT * FROM frequent f WHERE size > 1 AND NOT EXISTS (
        SELECT 1 FROM inside i WHERE i.lang = f.lang AND i.phrase = f.phrase AND 100 * i.times >= 100 * f.times)),
cuts AS (
    SELECT k.lang, k.phrase, k.times AS a, cut, l.times AS l, r.times AS r, t.n,
        (1000::HUGEINT * k.times::HUGEINT * t.n::HUGEINT) // (l.times::HUGEINT * r.times::HUGEINT) AS score
    FROM (SELECT *, unnest(range(1, size)) AS cut FROM kept) k
    JOIN counts l ON l.lang = k.lang AND l.phrase = array_to_string(k.words[1:cut], ' ')
    JOIN counts r ON r.lang = k.lang AND r.phrase = array_to_string(k.words[cut + 1:], ' ')
    JOIN totals t ON t.lang = k.lang),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
    a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM weakest QUALIFY rank <= {most}"""


def negatives_sql(embeddings: str = "embeddings") -> str:
    """All scores of all anchors, ranked. Doubles hold the products exactly."""
    return f"""
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS steps
    FROM {embeddings}
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
kept AS (SELECT row_number() OVER () AS row, * FROM (SELECT DISTINCT * FROM rows)),
scores AS (
    SELECT a.row AS anchor, a.vec_id AS anchor_id, o.row, o.vec_id, a.label = o.label AS same,
        list_inner_product(a.steps, o.steps)::BIGINT AS score
    FROM kept a JOIN kept o ON a.row <> o.row WHERE a.vec_id % 50 = 0),
positives AS (
    SELECT * FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, row) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
    row_number() OVER (PARTITION BY p.anchor, p.row ORDER BY s.score DESC, s.vec_id, s.row)::INTEGER AS rank,
    s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor = p.anchor AND NOT s.same
    AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
QUALIFY rank <= 3"""


ORACLE = {
    "op3_suffix_dedup": _REPEATS,
    "op7_interleaved_shards": _SHARDS,
    "op10_spaced_seed_decontamination": overlaps_sql(),
    "op12_phrase_collocations": phrases_sql(),
    "op13_hard_negatives": negatives_sql(),
}
