"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

from rollbook.llm import votes

COVER_TREE_TOP_K = """
WITH valid AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
    FROM valid q JOIN valid c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
),
ranked AS (
    SELECT query_id, vec_id, score,
        row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
    FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str, pattern: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), '{pattern}')"


BENCHMARK_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BENCHMARK_DECONTAMINATION = f"""
WITH docs AS (SELECT doc_id, {_words("text", BENCHMARK_WORD)} AS w FROM documents),
items AS (SELECT item_id, {_words("text", BENCHMARK_WORD)} AS w FROM benchmark),
starts AS (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS s FROM items WHERE len(w) > 0),
windows AS (
    SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[s:s + 12], ' ') AS words FROM starts
),
places AS (
    SELECT doc_id, n, w, unnest(generate_series(1, len(w) - n + 1)) AS s
    FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n
),
found AS (
    SELECT p.doc_id, p.s, p.n, v.item_id
    FROM places p JOIN windows v ON v.n = p.n AND v.words = array_to_string(p.w[p.s:p.s + p.n - 1], ' ')
),
hit AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS place FROM (SELECT DISTINCT doc_id, s, n FROM found))
    GROUP BY doc_id
),
listed AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM found WHERE item_id IS NOT NULL)
    GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
    coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

JACCARD_WORD = r"[^\x20\x09-\x0D]+"
JACCARD_COMPONENTS = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {_words("text", JACCARD_WORD)} AS w FROM documents),
places AS (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS s FROM docs WHERE len(w) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[s:s + 3], ' ') AS shingle FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
    GROUP BY ALL
),
links AS (
    SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
    WHERE 100 * common >= 85 * (x.n + y.n - common)
),
steps AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM docs
    UNION SELECT r.doc_id, s.b FROM reach r JOIN steps s ON r.other = s.a
)
SELECT doc_id, coalesce(max(n), 0)::BIGINT AS n_shingles, min(other) AS component_id
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""

CHAT_FORMATTING = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
marked AS (
    SELECT *, length(text) + len(regexp_extract_all(
            text, '<\\*(\|[a-z_]*\|>|/?s>|/?SYS>)|\[\\*/?INST\]')) AS escaped,
        row_number() OVER said AS n, lag(role) OVER said AS before, lead(role) OVER said AS after
    FROM turns WINDOW said AS (PARTITION BY conv_id ORDER BY turn, role, text)
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    sum(escaped
        + CASE WHEN role = before THEN length('<|then|>') ELSE length(role) + length('<||>') END
        + CASE WHEN role = after THEN 0 ELSE length('<|end|>') END)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""

CONVERSATION_TRIE = r"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (
            PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')
        ) AS k
    FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (
    SELECT conv_id, conv_id - conv_id % 20 AS base,
        -- CRC-32 of the decimal digits, bit by bit: the shift below works on a byte and on seven zeros after it
        xor(list_reduce(
            list_prepend(4294967295::BIGINT, flatten(list_transform(
                string_split(conv_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
            lambda crc, bits: xor(xor(crc, bits) >> 1, 3988292384::BIGINT * (xor(crc, bits) & 1))
        ), 4294967295::BIGINT) % 4 AS h
    FROM (SELECT DISTINCT conv_id FROM turns)
),
rebuilt AS (
    SELECT c.conv_id, 0 AS part, k, role, text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.k <= c.h
    UNION ALL
    SELECT c.conv_id, 1, k, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.k > c.h
),
said AS (
    SELECT conv_id, part, k, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS n_words,
        sha256(length(role) || ':' || role || text) AS turn
    FROM rebuilt
),
paths AS (
    SELECT conv_id, coalesce(list(turn ORDER BY part, k) FILTER (WHERE turn IS NOT NULL), []) AS path,
        coalesce(list(n_words ORDER BY part, k) FILTER (WHERE turn IS NOT NULL), []) AS words
    FROM convs LEFT JOIN said USING (conv_id) GROUP BY conv_id
),
members AS (
    SELECT conv_id, depth, path[1:depth] AS node, coalesce(words[depth], 0) AS n_words
    FROM (SELECT *, unnest(generate_series(0, len(path))) AS depth FROM paths)
),
nodes AS (
    SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(n_words) AS saved
    FROM members GROUP BY node, depth
),
children AS (SELECT node[1:depth - 1] AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
tops AS (
    SELECT n.node[1:top] AS node, sum(saved) AS saved, count(*) FILTER (WHERE leaf) AS leaves
    FROM (
        SELECT nodes.*, children.n IS NULL AS leaf, unnest(generate_series(0, depth)) AS top
        FROM nodes LEFT JOIN children USING (node)
    ) n GROUP BY ALL
),
ends AS (SELECT path AS node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM paths GROUP BY path)
SELECT n.conv_id::BIGINT AS conv_id, n.depth::BIGINT AS depth, p.conv_id::BIGINT AS parent_conv_id,
    n.n_convs::BIGINT AS n_convs, coalesce(c.n, 0)::BIGINT AS n_children, t.leaves::BIGINT AS n_leaves,
    t.saved::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes n JOIN tops t ON t.node = n.node
    LEFT JOIN nodes p ON n.depth > 0 AND p.node = n.node[1:n.depth - 1]
    LEFT JOIN children c ON c.node = n.node LEFT JOIN ends e ON e.node = n.node
"""


def _quality_votes() -> str:
    """Counts and votes, then one pair of tables a step of expectation and maximisation."""
    rules = votes.RULES
    start = votes.start(len(rules))

    def vote(rule: votes.Rule) -> str:
        up = rule.good > rule.bad
        m = f"({rule.measure})"
        return (
            f"CASE WHEN {m} {'<=' if up else '>='} {rule.bad}::DOUBLE THEN -1"
            f" WHEN {m} {'>=' if up else '<='} {rule.good}::DOUBLE THEN 1 ELSE 0 END"
        )

    k = range(len(rules))
    good = " * ".join(["share", *(f"CASE v{i} WHEN 1 THEN g{i} WHEN -1 THEN 1 - g{i} ELSE 1.0::DOUBLE END" for i in k)])
    bad = " * ".join(["(1 - share)", *(f"CASE v{i} WHEN -1 THEN b{i} WHEN 1 THEN 1 - b{i} ELSE 1.0::DOUBLE END" for i in k)])
    posterior = f"({good}) / (({good}) + ({bad}))"

    def rate(weight: str, right: int, i: int, prior: tuple[float, float]) -> str:
        seen = [f"coalesce(sum({weight}) FILTER (WHERE v{i} {test}), 0)" for test in (f"= {right}", "<> 0")]
        return f"({seen[0]} + {prior[0]}::DOUBLE) / ({seen[1]} + {sum(prior)}::DOUBLE)"

    steps = ["em0 AS (SELECT " + ", ".join([
        f"{start.good}::DOUBLE AS share",
        *(f"{start.on_good[i]}::DOUBLE AS g{i}, {start.on_bad[i]}::DOUBLE AS b{i}" for i in k)]) + ")"]
    for at in range(votes.STEPS):
        sums = [
            f"(coalesce(sum(n * p), 0) + {votes.IMAGINED[0]}::DOUBLE)"
            f" / (coalesce(sum(n), 0) + {sum(votes.IMAGINED)}::DOUBLE) AS share"
        ]
        for i in k:
            sums.append(f"greatest({votes.ON_GOOD}::DOUBLE, {rate('n * p', 1, i, votes.RIGHT_ON_GOOD)}) AS g{i}")
            sums.append(f"{rate('n * (1 - p)', -1, i, votes.RIGHT_ON_BAD)} AS r{i}")
        floors = [f"g{i}, greatest(1 - g{i} + {votes.MORE}::DOUBLE, r{i}) AS b{i}" for i in k]
        steps.append(
            f"em{at + 1} AS MATERIALIZED (SELECT share, {', '.join(floors)} FROM (SELECT {', '.join(sums)}"
            f" FROM (SELECT *, {posterior} AS p FROM patterns, em{at})))"
        )
    return f"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '{votes.WORD}') AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{votes.WORD}')) AS lines
    FROM documents
),
starts AS (SELECT r, w, unnest(generate_series(1, len(w) - 4)) AS s FROM docs WHERE len(w) >= 5),
windows AS (SELECT r, s, array_to_string(w[s:s + 4], ' ') AS said FROM starts),
again AS (SELECT r, s FROM (SELECT r, s, count(*) OVER (PARTITION BY r, said) AS n FROM windows) WHERE n > 1),
repeated AS (SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(generate_series(s, s + 4)) AS place FROM again) GROUP BY r),
counts AS (
    SELECT r, doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
        len(lines)::BIGINT AS n_lines, len(regexp_extract_all(text, '[A-Z]'))::BIGINT AS n_capitals,
        len(regexp_extract_all(text, '[A-Za-z]'))::BIGINT AS n_letters,
        len(regexp_extract_all(text, '[!?]'))::BIGINT AS n_marks, len(list_distinct(w))::BIGINT AS n_different
    FROM docs LEFT JOIN repeated USING (r)
),
voted AS (SELECT *, {', '.join(f'{vote(rule)} AS v{i}' for i, rule in enumerate(rules))} FROM counts),
patterns AS MATERIALIZED (SELECT {', '.join(f'v{i}' for i in k)}, count(*) AS n FROM voted GROUP BY ALL),
{', '.join(steps)},
judged AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, {posterior} AS quality
    FROM voted, em{votes.STEPS}
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND quality >= 0.5 AS kept
FROM judged
"""


STATEMENTS: dict[str, str] = {
    "op11_conversation_trie": CONVERSATION_TRIE,
    "op12_quality_votes": _quality_votes(),
    "op5_benchmark_decontamination": BENCHMARK_DECONTAMINATION,
    "op6_jaccard_components": JACCARD_COMPONENTS,
    "op10_chat_formatting": CHAT_FORMATTING,
    "op2_cover_tree_top_k": COVER_TREE_TOP_K,
}
