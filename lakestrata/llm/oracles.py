"""SQL for the corpus queries that SQL can express; run by DuckDB over the same tables."""

from __future__ import annotations

from lakestrata.llm import chat, decontam

_ESCAPED = "replace(replace(replace({}, '&', '&a;'), '<', '&l;'), '[', '&b;')"

CHAT = f"""
    WITH r AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
    )
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
        CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
        CAST(sum(length({_ESCAPED.format('role')}) + length({_ESCAPED.format('text')}) + {len(chat.TURN + chat.BODY + chat.END)}) AS BIGINT) AS formatted_chars
    FROM r GROUP BY conv_id
"""

SUBSTRINGS = r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    p AS (SELECT doc_id, w, unnest(range(len(w))) AS pos FROM d),
    x AS (SELECT doc_id, pos, w[pos + 1] AS word, CASE WHEN pos + 20 <= len(w) THEN array_to_string(w[pos + 1:pos + 20], ' ') END AS win FROM p),
    r AS (SELECT doc_id, pos, word, win IS NOT NULL AND row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) > 1 AS again FROM x),
    c AS (SELECT doc_id, pos, word, bool_or(again) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM r),
    k AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept FROM c GROUP BY doc_id)
    SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM d LEFT JOIN k USING (doc_id)
"""

BYTES = """
    WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    p AS (SELECT doc_id, h, unnest(range(length(h) // 2)) AS pos FROM d),
    x AS (SELECT doc_id, pos, substr(h, 2 * pos + 1, 2) AS byte, CASE WHEN 2 * pos + 100 <= length(h) THEN substr(h, 2 * pos + 1, 100) END AS win FROM p),
    r AS (SELECT doc_id, pos, byte, win IS NOT NULL AND doc_id > min(doc_id) OVER (PARTITION BY win) AS again FROM x),
    c AS (SELECT doc_id, pos, byte, bool_or(again) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM r),
    s AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY pos), false) AS opens FROM c),
    k AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans,
                 string_agg(byte, '' ORDER BY pos) FILTER (NOT gone) AS kept FROM s GROUP BY doc_id)
    SELECT d.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
           sha256(unhex(coalesce(kept, ''))) AS kept_sha256
    FROM d LEFT JOIN k USING (doc_id)
"""

VECTORS = """
    WITH RECURSIVE v AS (
        SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
        WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ),
    l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
          WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
    r(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
    n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
    SELECT r.a AS vec_id, coalesce(max(n.n), 0)::BIGINT AS n_links, min(r.b) AS component_id, r.a = min(r.b) AS kept
    FROM r LEFT JOIN n ON r.a = n.a GROUP BY r.a
"""


def _seed(mask: str) -> str:
    return "concat_ws(' ', " + ", ".join(f"w[pos + {i + 1}]" for i, bit in enumerate(mask) if bit == "1") + ")"


_SEEDS = "[" + ", ".join(f"'{k} ' || {_seed(mask)}" for k, mask in enumerate(decontam.MASKS)) + "]"
_SPAN = len(decontam.MASKS[0])
_TOKENS = r"regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+')"

CONTAMINATION = f"""
    WITH d AS (SELECT doc_id, {_TOKENS} AS w FROM documents),
    b AS (SELECT DISTINCT item_id, list_filter({_TOKENS}, lambda x: x <> '') AS w FROM benchmark),
    dp AS (SELECT doc_id, w, unnest(range(len(w) - {_SPAN - 1})) AS pos FROM d WHERE len(w) >= {_SPAN}),
    bp AS (SELECT item_id, w, unnest(range(len(w) - {_SPAN - 1})) AS pos FROM b WHERE len(w) >= {_SPAN}),
    ds AS (SELECT doc_id, pos, unnest({_SEEDS}) AS seed FROM dp),
    bs AS (SELECT item_id, pos, unnest({_SEEDS}) AS seed FROM bp),
    hits AS (SELECT DISTINCT doc_id, item_id, ds.pos - bs.pos AS shift FROM ds JOIN bs USING (seed)),
    laid AS (SELECT doc_id, item_id, shift, d.w AS dw, b.w AS bw, greatest(0, -shift) AS low, least(len(b.w), len(d.w) - shift) AS high
             FROM hits JOIN d USING (doc_id) JOIN b USING (item_id)),
    flags AS (SELECT doc_id, item_id, shift, low, high, least(13, len(bw)) AS width, i, (bw[i + 1] = dw[i + shift + 1])::INTEGER AS same
              FROM (SELECT *, unnest(range(low, high)) AS i FROM laid)),
    runs AS (SELECT *, sum(same) OVER (PARTITION BY doc_id, item_id, shift ORDER BY i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS near FROM flags),
    found AS (SELECT doc_id, item_id, shift, sum(same)::BIGINT AS matched, count(*) AS aligned, (any_value(low) + shift)::BIGINT AS first_token,
                     (any_value(high) + shift - 1)::BIGINT AS last_token
              FROM runs GROUP BY doc_id, item_id, shift
              HAVING count(*) >= any_value(width) AND bool_or(near >= ceil(width * 11 / 13.0)))
    SELECT doc_id, item_id, matched, aligned, first_token, last_token FROM found
    QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY matched DESC, aligned DESC, first_token, last_token DESC) = 1
"""

TOP_K = """
    WITH v AS (
        SELECT DISTINCT vec_id, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS e FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    s AS (SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.e, b.e)::BIGINT AS score
          FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 50 = 0)
    SELECT * FROM (SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM s)
    WHERE rank <= 5
"""

# The checksum by its bits: eight steps of the reflected polynomial for every byte of the decimal number.
_CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda a, i: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END)))"""

TRIE = f"""
    WITH o AS (
        SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
    ),
    h AS (SELECT conv_id, turns, {_CRC32} % 9 AS h FROM o),
    r AS (SELECT h.conv_id, list_concat(coalesce(d.turns[1:h], []), h.turns[h + 1:]) AS turns FROM h LEFT JOIN o d ON d.conv_id = h.conv_id - h.conv_id % 5),
    m AS (SELECT conv_id, turns[1:depth] AS path, depth FROM (SELECT *, unnest(range(len(turns) + 1)) AS depth FROM r)),
    n AS (SELECT path, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs FROM m GROUP BY path),
    p AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
    v AS (SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN depth > 0 THEN (n_convs - 1) * strlen(path[depth].text) ELSE 0 END AS own FROM n LEFT JOIN p USING (path)),
    u AS (SELECT path[1:above] AS path, sum((n_children = 0)::INTEGER) AS n_leaves, sum(own) AS saved FROM (SELECT *, unnest(range(depth + 1)) AS above FROM v) GROUP BY 1),
    e AS (SELECT turns AS path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends FROM r GROUP BY turns)
    SELECT v.conv_id, v.depth, up.conv_id AS parent_conv_id, v.n_convs, v.n_children, u.n_leaves::BIGINT AS n_leaves, u.saved::BIGINT AS saved_tokens,
           coalesce(ends, sha256('')) AS ends_sha256
    FROM v JOIN u USING (path) LEFT JOIN e USING (path) LEFT JOIN v up ON up.path = v.path[1:v.depth - 1] AND v.depth > 0
"""

ORACLES = {
    "op1_decontamination": CONTAMINATION, "op2_substring_dedup": SUBSTRINGS, "op8_suffix_array_dedup": BYTES,
    "op9_near_vectors": VECTORS, "op10_chat": CHAT,
    "op12_metric_tree": TOP_K, "op13_prefix_trie": TRIE,
}
