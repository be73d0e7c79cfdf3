"""SQL for those registered queries of this package that SQL can express."""

from turnmill.llm.centroid_clustering import CLUSTERS, COMPONENTS, ROUNDS, SCALE, SEED
from turnmill.llm.prefix_trie import BLOCK, HEADS


def clustering_sql() -> str:
    """Each round as two common tables: the assignment, then the centroids it leads to."""
    steps = [
        f"""v AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id,
                   list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS x
            FROM embeddings
            WHERE len(embedding) = {COMPONENTS}
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {COMPONENTS})""",
        f"""c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id), x) - 1 AS k, x
            FROM v QUALIFY k < {CLUSTERS})""",
    ]
    for number in range(ROUNDS + 1):
        steps.append(
            f"""a{number} AS MATERIALIZED (
            SELECT r, vec_id, x, best % {CLUSTERS} AS k, best // {CLUSTERS} AS distance
            FROM (SELECT v.r, any_value(v.vec_id) AS vec_id, any_value(v.x) AS x,
                         min({CLUSTERS} * list_sum(list_transform(range(1, {COMPONENTS} + 1),
                             lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))::BIGINT + c.k) AS best
                  FROM v, c{number} c GROUP BY v.r))"""
        )
        steps.append(
            f"""c{number + 1} AS MATERIALIZED (
            SELECT c.k, coalesce(m.x, c.x) AS x FROM c{number} c LEFT JOIN (
                SELECT k, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS x
                FROM (SELECT k, i, sum(x[i]) AS s, count(*) AS n
                      FROM a{number}, (SELECT unnest(range(1, {COMPONENTS} + 1)) AS i) GROUP BY k, i)
                GROUP BY k) m USING (k))"""
        )
    steps.pop()  # the last assignment moves nothing
    return f"""WITH {", ".join(steps)}
        SELECT vec_id, k::INTEGER AS cluster, distance::BIGINT AS distance,
               sum(distance) OVER (PARTITION BY k)::BIGINT AS cluster_inertia,
               sum(distance) OVER ()::BIGINT AS inertia,
               sha256(array_to_string(c.x, ',')) AS centroid_sha256
        FROM a{ROUNDS} JOIN c{ROUNDS} c USING (k)"""


def _crc32(text: str) -> str:
    """The reversed polynomial, bit by bit, over the characters of an ASCII text."""
    byte = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)"
    bits = "list_reduce(range(8), lambda r, i: xor(r >> 1, 3988292384 * (r & 1)), xor(crc, one))"
    return f"xor(list_reduce({byte}, lambda crc, one: {bits}, 4294967295::BIGINT), 4294967295)"


def prefix_sql() -> str:
    """Each prefix as a digest of its turns; a node's subtree through its members' prefixes."""
    return f"""WITH t AS MATERIALIZED (
            SELECT conv_id, row_number() OVER (
                       PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place,
                   coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations WHERE conv_id IS NOT NULL),
        c AS MATERIALIZED (
            SELECT conv_id, conv_id - conv_id % {BLOCK} AS block,
                   {_crc32("conv_id::VARCHAR")} % {HEADS} AS h
            FROM (SELECT DISTINCT conv_id FROM t)),
        turns AS MATERIALIZED (
            SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, place) AS depth,
                   md5(md5(role) || md5(text)) AS turn, length(text) AS chars
            FROM (SELECT c.conv_id, 0 AS own, place, role, text
                  FROM c JOIN t ON t.conv_id = c.block AND place < h
                  UNION ALL
                  SELECT c.conv_id, 1, place, role, text
                  FROM c JOIN t ON t.conv_id = c.conv_id AND place >= h)),
        paths AS MATERIALIZED (
            SELECT conv_id, depth, chars,
                   md5(string_agg(turn, '') OVER (
                       PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING)) AS node
            FROM turns
            UNION ALL SELECT conv_id, 0, 0, '' FROM c),
        nodes AS MATERIALIZED (
            SELECT p.node, any_value(p.depth) AS depth, min(p.conv_id) AS conv_id,
                   count(*) AS n_convs, any_value(p.chars) AS chars,
                   sha256(coalesce(string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id)
                                   FILTER (p.depth = l.depth), '')) AS ends_sha256
            FROM paths p JOIN (SELECT conv_id, max(depth) AS depth FROM paths GROUP BY conv_id) l
                 USING (conv_id)
            GROUP BY p.node),
        above AS MATERIALIZED (
            SELECT n.node, p.node AS parent, q.conv_id AS parent_conv_id
            FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1
                 JOIN nodes q ON q.node = p.node),
        children AS (SELECT parent AS node, count(*) AS n_children FROM above GROUP BY parent),
        sums AS (
            SELECT p.node, count(*) FILTER (k.node IS NULL) AS n_leaves,
                   sum((n.n_convs - 1) * n.chars) AS saved_tokens
            FROM nodes n LEFT JOIN children k ON k.node = n.node
                 JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth
            GROUP BY p.node)
        SELECT conv_id, depth, parent_conv_id, n_convs,
               coalesce(n_children, 0) AS n_children, n_leaves,
               saved_tokens::BIGINT AS saved_tokens, ends_sha256
        FROM nodes JOIN sums USING (node) LEFT JOIN children USING (node) LEFT JOIN above USING (node)"""


# A to Z in lower case, and nothing else.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def jaccard_sql() -> str:
    """All pairs of documents with a common shingle, then the least doc_id reachable by links."""
    return f"""WITH RECURSIVE w AS MATERIALIZED (
            SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS words FROM documents),
        s AS MATERIALIZED (
            SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
            FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i
                  FROM w WHERE len(words) > 0)),
        n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        links AS MATERIALIZED (
            SELECT a.doc_id AS a, b.doc_id AS b
            FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
                 JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
            GROUP BY a.doc_id, b.doc_id, x.n, y.n
            HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
        reached AS (
            SELECT doc_id, doc_id AS other FROM documents
            UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
        FROM (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
             LEFT JOIN n USING (doc_id)"""


def chat_sql() -> str:
    """What the formatted text must read back as; its length from what is escaped: backslashes and control strings."""
    control = r"[<\[](\||/?s>|/?INST\])"

    def size(text: str) -> str:
        return (
            f"length({text}) + length({text}) - length(replace({text}, chr(92), '')) "
            f"+ len(regexp_extract_all({text}, '{control}'))"
        )

    return f"""WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
               sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
               sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn))
                   AS loss_sha256,
               sum(length('<|im_start|><|im_sep|><|im_end|>') + 1 + {size("role")} + {size("text")})::BIGINT
                   AS formatted_chars
        FROM t GROUP BY conv_id"""


def contamination_sql() -> str:
    """Every window of every item, looked up at every place of every document."""
    words = f"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""WITH d AS MATERIALIZED (SELECT doc_id, {words} AS words FROM documents),
        b AS MATERIALIZED (
            SELECT item_id::VARCHAR AS item_id, words, least(len(words), 13) AS size
            FROM (SELECT item_id, {words} AS words FROM benchmark) WHERE len(words) > 0),
        windows AS MATERIALIZED (
            SELECT DISTINCT item_id, size, array_to_string(words[i:i + size - 1], ' ') AS shown
            FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS i FROM b)),
        found AS MATERIALIZED (
            SELECT DISTINCT doc_id, i, size, item_id
            FROM (SELECT doc_id, size, i, array_to_string(words[i:i + size - 1], ' ') AS shown
                  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i
                        FROM d, (SELECT DISTINCT size FROM windows)))
                 JOIN windows USING (size, shown)),
        hit AS (
            SELECT doc_id, count(DISTINCT place) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM found) GROUP BY doc_id),
        items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS shown
            FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
        SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(shown, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
        FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""


def url_sql() -> str:
    """The longest rule by a list of cases, longest first; without one, whether the canonical URL is listed."""

    def fits(host: str, path: str) -> str:
        return f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"

    rules = (
        ("block", "example.org", "/en/1"),
        ("block", "example.org", "/es/"),
        ("allow", "com", "/fr/"),
        ("block", "com", "/de/"),
        ("allow", "org", "/"),
    )
    named = " ".join(f"WHEN {fits(host, path)} THEN '{host}{path}'" for _, host, path in rules)
    judged = " ".join(f"WHEN {fits(host, path)} THEN '{verdict}'" for verdict, host, path in rules)
    return rf"""WITH u AS (
            SELECT page_id, coalesce(url, '') AS url,
                   translate(regexp_extract(coalesce(url, ''), '(?s)\A.*?://([^/?#]*)', 1),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(url, ''), '(?s)\A.*?://[^/?#]*([^?#]*)', 1) AS path
            FROM pages),
        q AS (
            SELECT *, array_to_string(list_sort(list_filter(
                       string_split(regexp_extract(url, '(?s)\A[^?#]*\?([^#]*)', 1), '&'),
                       lambda p: p <> '' AND NOT regexp_matches(p, '\A(?:utm_[a-z]+|ref|fbclid|gclid)(?:=|\z)')
                   )), '&') AS query
            FROM u),
        k AS MATERIALIZED (
            SELECT *, regexp_replace(host, '\A(?:www|m)\.', '') || regexp_replace(path, '/+\z', '')
                      || CASE WHEN coalesce(query, '') <> '' THEN '?' || query ELSE '' END AS key
            FROM q),
        listed AS (
            SELECT DISTINCT key, true AS hit FROM k
            WHERE regexp_matches(host, '(?:spam|pills|casino|adult|porn|xxx|warez|betting)'))
        SELECT page_id, host, path, CASE {named} END AS rule,
               coalesce(CASE {judged} END, CASE WHEN hit THEN 'block' ELSE 'allow' END) AS verdict
        FROM k LEFT JOIN listed USING (key)"""


ORACLE_SQL: dict[str, str] = {
    "op1_jaccard_join": jaccard_sql(),
    "op2_chat_format": chat_sql(),
    "op5_decontamination": contamination_sql(),
    "op8_url_filter": url_sql(),
    "op11_centroid_clustering": clustering_sql(),
    "op13_prefix_trie": prefix_sql(),
}
