"""SQL for DuckDB that states the result of each query, by other means where there are any."""

from __future__ import annotations

from workload.queries import CHUNK, MIN_ROWS, MIN_SUBCHUNK, NGRAMS, SHARD, SMALL_SHARD, SPLITS, WORDS

SOURCES = """src AS (
    SELECT 0 AS source_ord, 'documents' AS source, doc_id::VARCHAR AS row_key, text
    FROM documents WHERE text <> ''
    UNION ALL
    SELECT 1, 'benchmark', item_id::VARCHAR, text FROM benchmark WHERE text <> ''
    UNION ALL
    SELECT 2, 'conversations', conv_id::VARCHAR || ':' || turn::VARCHAR, text
    FROM conversations WHERE text <> '')"""

DOCUMENTS = """src AS (
    SELECT 0 AS source_ord, 'documents' AS source, doc_id::VARCHAR AS row_key, text
    FROM documents WHERE text <> '')"""

LINES = """src AS (
    SELECT 0 AS source_ord, doc_id::VARCHAR || ':' || (i - 1)::VARCHAR AS row_key, part AS text
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS part,
                 generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents))"""


def byte_ids(text: str) -> str:
    return (
        f"list_transform(regexp_extract_all(hex({text}), '..'), lambda h: ('0x' || h)::INT + 1)"
    )


def ids_md5(ids: str) -> str:
    return f"md5(array_to_string({ids}, ','))"


TOKENS = f"""tok AS (
    SELECT *, strlen(text)::BIGINT AS n, {byte_ids("text")} AS ids FROM src)"""

SHUFFLED = "md5('101:' || source_ord::VARCHAR || ':' || row_key), source_ord, row_key"
IN_SOURCE_ORDER = f"source_ord, {SHUFFLED}"


def placed(order: str) -> str:
    return f"""placed AS (
    SELECT *, row_number() OVER w - 1 AS pos, (sum(n) OVER w)::BIGINT - n AS start
    FROM tok WINDOW w AS (ORDER BY {order} ROWS UNBOUNDED PRECEDING))"""


def chunks(size: int, splits: int) -> str:
    """CTEs from `placed` to `packed(split_id, chunk_id, pos, n_real, ids)`."""
    per_split = "(CASE WHEN c < %d THEN c ELSE c // %d END)" % (splits, splits)
    split_id = "0::BIGINT" if splits == 1 else f"pos // {per_split}"
    return f"""
cnt AS (SELECT count(*) AS c FROM placed),
sp AS (SELECT placed.*, {split_id} AS split_id FROM placed, cnt),
base AS (SELECT split_id, min(start) AS s0, sum(n)::BIGINT AS total FROM sp GROUP BY 1),
lay AS (
    SELECT *, (sum(nc) OVER (ORDER BY split_id))::BIGINT - nc AS fc
    FROM (SELECT *, greatest(1, (total + {size - 1}) // {size}) AS nc FROM base)),
cut AS (
    SELECT split_id, fc, start - s0 AS spot, n, ids,
           unnest(range((start - s0) // {size}, (start - s0 + n - 1) // {size} + 1)) AS k
    FROM sp JOIN lay USING (split_id) WHERE n > 0),
parts AS (
    SELECT split_id, fc, k, spot,
           ids[greatest(k * {size} - spot, 0) + 1 : least((k + 1) * {size} - spot, n)] AS part
    FROM cut),
filled AS (
    SELECT split_id, k AS chunk_id, fc + k AS pos, flatten(list(part ORDER BY spot)) AS toks
    FROM parts GROUP BY split_id, k, fc
    UNION ALL
    SELECT split_id, 0, fc, []::INT[] FROM lay WHERE total = 0),
packed AS (
    SELECT split_id, chunk_id, pos, len(toks)::INT AS n_real,
           list_concat(toks, list_transform(range({size} - len(toks)), lambda z: 0)) AS ids
    FROM filled)"""


PACKED = f"SELECT split_id, chunk_id, pos, n_real, {ids_md5('ids')} AS ids_md5 FROM packed"

WORD_VOCABULARY = f"""
freq AS (
    SELECT w, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS w FROM documents)
    WHERE strlen(w) BETWEEN 2 AND 16 GROUP BY w ORDER BY n DESC, w LIMIT {WORDS}),
vocab AS (
    SELECT 0 AS token_id, hex('<|endoftext|>') AS h, 13 AS size
    UNION ALL
    SELECT (b + 1)::INT, upper(printf('%02x', b)), 1 FROM (SELECT unnest(range(256)) AS b)
    UNION ALL
    SELECT (256 + row_number() OVER (ORDER BY strlen(t) DESC, t))::INT, hex(t), strlen(t)::INT
    FROM (SELECT w AS t FROM freq UNION ALL SELECT ' ' || w FROM freq))"""

# No entry has a space but as its first byte, so each stretch from one space to the next is
# tokenized by itself, and each distinct stretch once.
WORD_TOKENS = """
seg AS (
    SELECT doc_id, unnest(s) AS s, generate_subscripts(s, 1) AS i
    FROM (SELECT doc_id, regexp_extract_all(text, ' [^ ]*|[^ ]+') AS s FROM documents)),
types AS (SELECT s, hex(s) AS h FROM (SELECT DISTINCT s FROM seg)),
sizes AS (SELECT DISTINCT size FROM vocab),
places AS (SELECT s, h, unnest(range(0, length(h) // 2)) AS spot FROM types),
longest AS (
    SELECT s, spot, max(v.size) AS size, arg_max(v.token_id, v.size) AS token_id
    FROM (SELECT s, spot, size, substr(h, 2 * spot + 1, 2 * size) AS piece
          FROM places, sizes WHERE spot + size <= length(h) // 2) p
    JOIN vocab v ON v.h = p.piece AND v.size = p.size GROUP BY s, spot),
walk AS (
    SELECT s, 0::BIGINT AS spot FROM types
    UNION ALL
    SELECT w.s, w.spot + l.size FROM walk w JOIN longest l ON l.s = w.s AND l.spot = w.spot
    WHERE w.spot + l.size < strlen(w.s)),
typed AS (
    SELECT s, list(token_id ORDER BY spot) AS ids FROM walk JOIN longest USING (s, spot) GROUP BY s),
toks AS (SELECT doc_id, flatten(list(ids ORDER BY i)) AS ids FROM seg JOIN typed USING (s) GROUP BY doc_id)"""

# Runs begin at characters, so the longest one at each character is looked up; which characters begin
# a token follows by doubling the hops: all places that a power of two of tokens leads to.
HOPS = 16
NGRAM_TOKENS = f"""
grams AS (
    SELECT t, 256 + row_number() OVER (ORDER BY t) AS token_id FROM (
        SELECT t, count(*) AS n FROM (
            SELECT unnest(list_transform(range(0, length(text) // k), lambda i: substr(text, i * k + 1, k))) AS t
            FROM documents, (SELECT unnest(range(2, 7)) AS k))
        GROUP BY t ORDER BY n DESC, t LIMIT {NGRAMS})),
places AS (SELECT doc_id, text, unnest(range(1, length(text) + 1)) AS i FROM documents),
pieces AS (
    SELECT doc_id, i, k, substr(text, i, k) AS t FROM places, (SELECT unnest(range(2, 7)) AS k)
    WHERE i + k - 1 <= length(text)),
longest AS (
    SELECT doc_id, i, max(k) AS size, arg_max(token_id, k) AS token_id FROM pieces JOIN grams USING (t)
    GROUP BY doc_id, i),
at_place AS (
    SELECT p.doc_id, i, i + coalesce(size, 1) AS next,
           CASE WHEN size IS NULL THEN {byte_ids("substr(text, i, 1)")} ELSE [token_id::INT] END AS ids
    FROM places p LEFT JOIN longest USING (doc_id, i)),
hop0 AS (SELECT doc_id, i, next FROM at_place),
""" + "".join(
    f"""hop{k + 1} AS (SELECT a.doc_id, a.i, b.next FROM hop{k} a JOIN hop{k} b ON b.doc_id = a.doc_id AND b.i = a.next),
"""
    for k in range(HOPS)
) + f"reach{HOPS + 1} AS (SELECT doc_id, 1::BIGINT AS i FROM documents WHERE text <> ''),\n" + ",\n".join(
    f"""reach{k} AS (SELECT * FROM reach{k + 1} UNION
        SELECT h.doc_id, h.next FROM hop{k} h JOIN reach{k + 1} r ON r.doc_id = h.doc_id AND r.i = h.i)"""
    for k in range(HOPS, -1, -1)
) + """,
gram_tokens AS (
    SELECT doc_id, flatten(list(ids ORDER BY i)) AS ids FROM reach0 JOIN at_place USING (doc_id, i) GROUP BY doc_id)"""

LINE_BYTES = """(57 + strlen(array_to_string({ids}, ','))
    + greatest(2 * {n} - 1, 0) + greatest(2 * {t} - 1, 0))::BIGINT"""

MEASURED = f"""
measured AS (SELECT row_key, pos, {LINE_BYTES.format(ids="ids", n="n", t="n")} AS len, ids FROM placed)"""
BY_TOKENS = "measured AS (SELECT row_key, pos, n AS len, 0 AS ids FROM placed)"

GROUPED = f"""
ranked AS (
    SELECT *, row_number() OVER w - 1 AS rn, (sum(len) OVER w)::BIGINT - len AS cum
    FROM measured WINDOW w AS (ORDER BY len DESC, pos ROWS UNBOUNDED PRECEDING)),
stats AS (
    SELECT count(*) AS c, sum(len)::BIGINT AS total,
           list_reduce(list(DISTINCT len), lambda a, b: gcd(a, b)) AS g FROM ranked),
budgets AS (
    SELECT d AS budget, d * c <= {MIN_ROWS} * total AS by_rows
    FROM (SELECT unnest(range(greatest(g, {MIN_ROWS}), total // 2 + 1)) AS d, c, total FROM stats)
    WHERE total % d = 0),
tried AS (
    SELECT budget FROM budgets WHERE NOT by_rows
    UNION ALL SELECT min(budget) FROM budgets WHERE by_rows HAVING count(*) > 0),
grouped AS (
    SELECT budget, row_key, rn, cum, len, ids, least(cum // budget, rn // {MIN_ROWS}) AS g
    FROM ranked, tried),
tail AS (
    SELECT budget, max(g) AS last FROM grouped GROUP BY budget),
short AS (
    SELECT budget, last, count(*) < {MIN_ROWS} AND last > 0 AS is_short
    FROM grouped JOIN tail USING (budget) WHERE g = last GROUP BY budget, last),
merged AS (
    SELECT budget, row_key, rn, cum, len, ids,
           least(g, CASE WHEN is_short THEN last - 1 ELSE last END)::BIGINT AS group_id
    FROM grouped JOIN short USING (budget)),
per_group AS (
    SELECT budget, group_id, count(*) AS n_rows, sum(len)::BIGINT AS total
    FROM merged GROUP BY ALL),
spread AS (
    SELECT budget, (max(total) - min(total))::BIGINT AS spread, count(*) AS n_groups, min(n_rows) AS smallest
    FROM per_group GROUP BY budget),
best AS (SELECT * FROM spread ORDER BY n_groups = 1, spread, budget LIMIT 1),
chosen AS (
    SELECT m.*, greatest(smallest, {MIN_SUBCHUNK}) AS target
    FROM merged m JOIN best USING (budget)),
subs AS (
    SELECT *, (row_number() OVER (PARTITION BY group_id ORDER BY rn) - 1) // target AS sub_id
    FROM chosen)"""

RANKED = f"{MEASURED}, {GROUPED}"
PLACES = """row_number() OVER (ORDER BY md5('102:' || group_id::VARCHAR || ':' || sub_id::VARCHAR),
                                  group_id, sub_id, md5('102:0:' || row_key), row_key) - 1 AS pos"""

DOCS_IN_ORDER = f"{DOCUMENTS}, {TOKENS}, {placed(IN_SOURCE_ORDER)}"
STORE_ROWS = f"SELECT pos AS doc_ord, n::INT AS n_tokens, {ids_md5('ids')} AS ids_md5 FROM placed"


def filled(limit: int) -> str:
    """CTEs from `sized(pos, b)` to `sharded(shard, pos, b)`: one shard after the other."""
    return f"""
        summed AS (SELECT *, (sum(b) OVER (ORDER BY pos ROWS UNBOUNDED PRECEDING))::BIGINT - b AS before FROM sized),
        follows AS MATERIALIZED (
            SELECT a.pos, n.pos AS next FROM (SELECT pos, before + {limit} AS until FROM summed) a
            ASOF LEFT JOIN summed n ON a.until < n.before),
        begun AS (
            SELECT 0::BIGINT AS shard, 0::BIGINT AS since
            UNION ALL
            SELECT shard + 1, next FROM begun JOIN follows ON pos = since WHERE next IS NOT NULL),
        sharded AS (SELECT shard, pos, b FROM summed ASOF JOIN begun ON since <= pos)"""


FILLED = """SELECT shard, min(pos) AS first, count(*) AS n_rows, sum(b)::BIGINT AS n_bytes
        FROM sharded GROUP BY shard"""
LINE_SIZES = f"sized AS (SELECT pos, {LINE_BYTES.format(ids='ids', n='n', t='n')} AS b FROM placed)"
CHUNK_SIZES = f"sized AS (SELECT pos, {LINE_BYTES.format(ids='ids', n=CHUNK, t='n_real')} AS b FROM packed)"

ITEMS = f"""
    convs AS (
        SELECT conv_id, coalesce(list(text ORDER BY turn) FILTER (role <> 'user'), []) AS parts
        FROM conversations GROUP BY conv_id),
    docs AS (
        SELECT *, row_number() OVER (ORDER BY md5('101:' || conv_id::VARCHAR), conv_id) - 1 AS pos FROM convs),
    items AS (
        SELECT pos, unnest(parts) AS text, generate_subscripts(parts, 1) - 1 AS item FROM docs),
    sized AS (
        SELECT pos, len(parts) AS n, greatest(list_sum(list_transform(parts, lambda p: greatest(2 * strlen(p), 1))), 1) AS b
        FROM docs),
    placed AS (
        SELECT *, ((sum(b) OVER (ORDER BY pos ROWS UNBOUNDED PRECEDING) - b) // {SHARD})::BIGINT AS shard FROM sized)"""

ORACLES: dict[str, str] = {
    "split_documents": "SELECT doc_id, lang, strlen(text)::INT AS n_bytes FROM documents WHERE lang = 'fr'",
    "split_folders": "SELECT doc_id, md5(text) AS text_md5 FROM documents WHERE lang = 'es'",
    "nonempty_documents": """
        SELECT doc_id, (i - 1)::INT AS line, md5(part) AS text_md5
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS part,
                     generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)
        WHERE part <> ''""",
    "keyed_field": f"""
        SELECT page_id, strlen(html)::INT AS n_tokens, {ids_md5(byte_ids("html"))} AS ids_md5
        FROM pages WHERE html IS NOT NULL""",
    "nonblank_rows": r"""
        SELECT count(*) AS n_rows
        FROM (SELECT unnest(string_split_regex(text, '\r\n|\n|\r')) AS line FROM documents)
        WHERE regexp_matches(line, '\S')""",
    "bounded_count": " UNION ALL ".join(
        f"SELECT '{t}' AS name, CASE WHEN count(*) > 500 THEN -1 ELSE count(*) END AS n_rows FROM {t}"
        for t in ("documents", "benchmark", "conversations", "pages")
    ),
    "parsed_json_lines": """
        SELECT CASE WHEN json_valid(v) THEN json_extract_string(v, '$.k')::BIGINT END AS k,
               CASE WHEN NOT json_valid(v) THEN v END AS bad, count(*) AS n_rows
        FROM (SELECT props AS v FROM events UNION ALL SELECT event_type FROM events) GROUP BY 1, 2""",
    "stage_reuse": """
        SELECT name, name = 'same' AS reusable, n * copies AS n_rows
        FROM (SELECT count(*) AS n FROM documents WHERE text <> ''),
             (VALUES ('same', 1), ('more rows', 2), ('other text', 1), ('other settings', 1)) v(name, copies)""",
    "union_sources": f"WITH {SOURCES} SELECT source, source_ord, row_key, md5(text) AS text_md5 FROM src",
    "byte_tokens": f"""
        SELECT doc_id, strlen(text)::INT AS n_tokens, {ids_md5(byte_ids("text"))} AS ids_md5,
               strlen(text)::INT AS n_type_zeros, strlen(text)::INT AS n_mask_ones FROM documents""",
    "streamed_tokens": f"""
        SELECT doc_id, strlen(text)::INT AS n_tokens, {ids_md5(byte_ids("text"))} AS ids_md5 FROM documents""",
    "token_totals": f"WITH {SOURCES} SELECT count(*) AS n_rows, sum(strlen(text))::BIGINT AS n_tokens FROM src",
    "vocabulary_table": f"WITH {WORD_VOCABULARY} SELECT token_id, h AS token_hex, size FROM vocab",
    "vocab_tokens": f"""WITH RECURSIVE {WORD_VOCABULARY}, {WORD_TOKENS}
        SELECT doc_id, len(ids)::INT AS n_tokens, {ids_md5("ids")} AS ids_md5 FROM toks""",
    "detokenize": "SELECT doc_id, md5(text) AS text_md5 FROM documents",
    "multipart_tokens": f"""
        SELECT doc_id, len(parts)::INT AS n_parts,
               md5(array_to_string(list_transform(parts,
                   lambda p: array_to_string({byte_ids("p")}, ',')), '|')) AS ids_md5
        FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)""",
    "shuffle_positions": f"""WITH {SOURCES}, {TOKENS}, {placed(SHUFFLED)}
        SELECT source, row_key, pos, start, n::INT AS n_tokens FROM placed""",
    "concat_positions": f"""WITH {SOURCES}, {TOKENS}, {placed(IN_SOURCE_ORDER)}
        SELECT source, row_key, pos, start, n::INT AS n_tokens FROM placed""",
    "keyless_positions": """
        SELECT row_key, row_number() OVER (ORDER BY md5('101:' || row_key), row_key) - 1 AS pos
        FROM (SELECT md5(text) || ':' || (row_number() OVER (PARTITION BY text) - 1)::VARCHAR AS row_key
              FROM documents)""",
    "rechunk_splits": f"WITH {DOCUMENTS}, {TOKENS}, {placed(SHUFFLED)}, {chunks(CHUNK, SPLITS)} {PACKED}",
    "rechunk_single": f"WITH {SOURCES}, {TOKENS}, {placed(IN_SOURCE_ORDER)}, {chunks(CHUNK, 1)} {PACKED}",
    "rechunk_tail": f"""WITH {DOCUMENTS}, {TOKENS}, {placed(IN_SOURCE_ORDER)}, {chunks(CHUNK, SPLITS)}
        SELECT split_id, nc AS n_chunks, total AS n_tokens, total AS n_mask_ones,
               nc * {CHUNK} AS n_mask, total AS n_types, (total - (nc - 1) * {CHUNK})::INT AS tail
        FROM lay""",
    "rechunk_empty_splits": f"""WITH {LINES}, {TOKENS},
        {placed("md5('101:' || row_key), row_key")}, {chunks(256, 5_000)} {PACKED}""",
    "shuffled_corpus_chunks": f"WITH {SOURCES}, {TOKENS}, {placed(SHUFFLED)}, {chunks(CHUNK, SPLITS)} {PACKED}",
    "detokenized_chunks": f"""WITH {DOCUMENTS}, {TOKENS}, {placed(SHUFFLED)}, {chunks(CHUNK, SPLITS)},
        spelled AS (
            SELECT split_id, pos, start - s0 AS spot, i, substr(text, i, 1) AS c
            FROM (SELECT sp.*, s0, unnest(range(1, length(text) + 1)) AS i FROM sp JOIN base USING (split_id))),
        located AS (
            SELECT split_id, i, c, pos,
                   (spot + sum(strlen(c)) OVER (PARTITION BY pos ORDER BY i ROWS UNBOUNDED PRECEDING) - strlen(c)) AS place
            FROM spelled),
        texts AS (
            SELECT split_id, (place // {CHUNK})::BIGINT AS chunk_id, string_agg(c, '' ORDER BY place) AS text
            FROM located GROUP BY ALL)
        SELECT split_id, chunk_id, md5(coalesce(text, '')) AS text_md5
        FROM packed LEFT JOIN texts USING (split_id, chunk_id)""",
    "packed_corpus": f"""WITH {SOURCES}, {TOKENS}, {placed(IN_SOURCE_ORDER)}, {chunks(CHUNK, SPLITS)}
        SELECT split, pos, n_real, {ids_md5("ids")} AS ids_md5
        FROM packed, (VALUES ('train'), ('test')) v(split) WHERE split = 'train' OR pos = 0""",
    "inverse_shuffle": f"""WITH {SOURCES}, {TOKENS}, {placed(IN_SOURCE_ORDER)}, {chunks(CHUNK, SPLITS)}
        SELECT split_id, chunk_id, n_real, {ids_md5("ids")} AS ids_md5,
               row_number() OVER (ORDER BY md5('101:' || split_id::VARCHAR || ':' || chunk_id::VARCHAR),
                                  split_id, chunk_id) - 1 AS pos
        FROM packed""",
    "length_stats": f"WITH {DOCS_IN_ORDER}, {RANKED} SELECT c AS n_rows, total, g AS gcd FROM stats",
    "length_histogram": f"WITH {DOCS_IN_ORDER}, {RANKED} SELECT len, count(*) AS n_rows FROM ranked GROUP BY len",
    "group_spread": f"WITH {DOCS_IN_ORDER}, {RANKED} SELECT budget, spread, n_groups, smallest FROM spread",
    "length_groups": f"WITH {DOCS_IN_ORDER}, {RANKED} SELECT row_key, len, rn, cum, group_id FROM chosen",
    "length_subchunks": f"""WITH {DOCS_IN_ORDER}, {RANKED}
        SELECT group_id, sub_id, count(*) AS n_rows, sum(len)::BIGINT AS total FROM subs GROUP BY ALL""",
    "dist_by_length": f"""WITH {DOCS_IN_ORDER}, {RANKED}
        SELECT row_key, group_id, sub_id, {ids_md5("ids")} AS ids_md5, {PLACES} FROM subs""",
    "dist_by_tokens": f"""WITH {DOCS_IN_ORDER}, {BY_TOKENS}, {GROUPED}
        SELECT row_key, len::INT AS n_tokens, group_id, sub_id, {PLACES} FROM subs""",
    "store_index": f"""WITH {DOCS_IN_ORDER}
        SELECT pos AS doc_ord, n::INT AS size, start * 2 AS pointer FROM placed""",
    "document_index": """
        SELECT conv_id, max(item)::BIGINT AS doc_end
        FROM (SELECT conv_id, row_number() OVER (ORDER BY conv_id, turn) AS item FROM conversations)
        GROUP BY conv_id""",
    "store_roundtrip": f"WITH {DOCS_IN_ORDER} {STORE_ROWS}",
    "store_item": f"WITH {DOCS_IN_ORDER} {STORE_ROWS} WHERE pos = 7",
    "store_slice": f"WITH {DOCS_IN_ORDER} {STORE_ROWS} WHERE pos >= 20 AND pos < 120",
    "store_source": f"WITH {DOCS_IN_ORDER} {STORE_ROWS} WHERE pos >= 20 AND pos < 120 AND n > 9",
    "store_subrange": f"""WITH {DOCS_IN_ORDER}
        SELECT pos AS doc_ord, len(ids[6:45])::INT AS n_tokens, {ids_md5("ids[6:45]")} AS ids_md5
        FROM placed WHERE pos = 11""",
    "store_manifest": f"""WITH {DOCS_IN_ORDER}
        SELECT start * 2 // {SHARD} AS shard, count(*) AS n_rows, sum(n * 2)::BIGINT AS n_bytes
        FROM placed GROUP BY 1""",
    "shard_manifest": f"""WITH {DOCS_IN_ORDER},
        sized AS (SELECT pos, {LINE_BYTES.format(ids="ids", n="n", t="n")} AS b FROM placed),
        summed AS (SELECT *, (sum(b) OVER (ORDER BY pos ROWS UNBOUNDED PRECEDING))::BIGINT - b AS before FROM sized)
        SELECT before // {SHARD} AS shard, count(*) AS n_rows, sum(b)::BIGINT AS n_bytes
        FROM summed GROUP BY 1""",
    "filled_shards": f"WITH RECURSIVE {DOCS_IN_ORDER}, {LINE_SIZES}, {filled(SHARD)} {FILLED}",
    "filled_small_shards": f"WITH RECURSIVE {DOCS_IN_ORDER}, {LINE_SIZES}, {filled(SMALL_SHARD)} {FILLED}",
    "filled_arrow_shards": f"""WITH RECURSIVE {DOCUMENTS}, {TOKENS}, {placed(SHUFFLED)}, {chunks(CHUNK, SPLITS)},
        {CHUNK_SIZES}, {filled(SHARD)} SELECT shard, count(*) AS n_rows FROM sharded GROUP BY shard""",
    "item_store": f"""WITH {ITEMS}
        SELECT pos AS doc_ord, item::BIGINT AS item, row_number() OVER (ORDER BY pos, item) - 1 AS item_ord,
               strlen(text)::INT AS n_tokens, {ids_md5(byte_ids("text"))} AS ids_md5 FROM items""",
    "item_documents": f"""WITH {ITEMS}
        SELECT pos AS doc_ord, len(parts)::INT AS n_items, md5(array_to_string(list_transform(parts,
            lambda p: array_to_string({byte_ids("p")}, ',')), '|')) AS ids_md5 FROM docs""",
    "item_index_files": f"""WITH {ITEMS}
        SELECT shard, row_number() OVER w::INT AS doc, (sum(n) OVER w)::BIGINT AS doc_end FROM placed
        WINDOW w AS (PARTITION BY shard ORDER BY pos ROWS UNBOUNDED PRECEDING)
        UNION ALL SELECT DISTINCT shard, 0, 0 FROM placed""",
    "train_test": f"""WITH {DOCS_IN_ORDER}
        SELECT 'train' AS split, row_key, pos, n::INT AS n_tokens FROM placed
        UNION ALL SELECT 'test', row_key, pos, n::INT FROM placed WHERE pos = 0""",
    "arrow_roundtrip": f"""WITH {DOCUMENTS}, {TOKENS}, {placed(SHUFFLED)}, {chunks(CHUNK, SPLITS)},
        written AS (SELECT 'train' AS split, * FROM packed
                 UNION ALL SELECT 'test', * FROM packed WHERE pos = 0)
        SELECT split, len(ids)::INT AS n_ids, n_real AS n_types, n_real, {ids_md5("ids")} AS ids_md5
        FROM written""",
    "json_roundtrip": f"""WITH {DOCS_IN_ORDER}
        SELECT n::INT AS n_tokens, n::INT AS n_mask, {ids_md5("ids")} AS ids_md5 FROM placed""",
    "own_tokenizer": f"""WITH {DOCUMENTS}, tok AS (
            SELECT *, list_transform(string_split(text, ' '), lambda w: length(w)) AS ids,
                   len(string_split(text, ' ')) AS n FROM src), {placed(IN_SOURCE_ORDER)}
        SELECT row_key, pos, start, n::INT AS n_tokens, {ids_md5("ids")} AS ids_md5 FROM placed""",
    "reused_pack": f"""WITH {DOCS_IN_ORDER}
        SELECT run, row_key, pos,
               CASE run WHEN 'other' THEN {ids_md5(byte_ids("text || '!'"))} ELSE {ids_md5("ids")} END AS ids_md5
        FROM placed, (SELECT unnest(['first', 'again', 'other']) AS run)""",
    "store_index_files": f"""WITH {DOCS_IN_ORDER},
        sharded AS (SELECT start * 2 // {SHARD} AS shard, start * 2 AS first, n, pos FROM placed),
        numbered AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY pos) AS k,
                            min(first) OVER (PARTITION BY shard) AS base FROM sharded)
        SELECT shard, k - 1 AS shard_doc, n::INT AS size, first - base AS pointer, k AS doc_end
        FROM numbered""",
    "dense_vocab_tokens": f"""WITH {NGRAM_TOKENS}
        SELECT doc_id, coalesce(len(ids), 0)::INT AS n_tokens, {ids_md5("coalesce(ids, [])")} AS ids_md5,
               md5(text) AS text_md5
        FROM documents LEFT JOIN gram_tokens USING (doc_id)""",
}
