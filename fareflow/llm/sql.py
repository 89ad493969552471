"""DuckDB SQL that states the results of the queries independently."""

SQL: dict[str, str] = {}

SQL["op1_quality_rules"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents
),
w AS (
    SELECT rid, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS word,
           generate_subscripts(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), 1) AS i
    FROM d
),
windows AS (
    SELECT rid, i, word AS a, lead(word, 1) OVER v AS b, lead(word, 2) OVER v AS c
    FROM w WINDOW v AS (PARTITION BY rid ORDER BY i)
),
counted AS (
    SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM windows WHERE c IS NOT NULL
),
repeated AS (
    SELECT rid, count(DISTINCT i + o) AS n_repeat_words
    FROM counted, (VALUES (0), (1), (2)) t(o) WHERE n > 1 GROUP BY rid
),
l AS (
    SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid
),
stats AS (
    SELECT d.rid, doc_id, source,
        len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS n_words,
        length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_lines, 0) AS n_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM d LEFT JOIN repeated r ON d.rid = r.rid LEFT JOIN l ON d.rid = l.rid
),
rules AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        n_symbols > 0.1 * n_words AS bad_symbols, n_dup_lines > 0.3 * n_lines AS bad_lines,
        n_words > 0 AND (word_chars < 3 * n_words OR word_chars > 12 * n_words) AS bad_length
    FROM stats
),
failures AS (
    SELECT source, rule, count(*)::DOUBLE AS n, sum(failed::INT)::DOUBLE AS f
    FROM (
        SELECT source, unnest(['base', 'symbols', 'lines', 'length']) AS rule,
               unnest([base_failed, bad_symbols, bad_lines, bad_length]) AS failed
        FROM rules
    ) GROUP BY source, rule
),
moments AS (
    SELECT rule, sum(f) / sum(n) AS m, count(*) AS k,
        (sum(f * f / n) - sum(f) * sum(f) / sum(n)) / (count(*) - 1) - sum(f) / sum(n) * (1 - sum(f) / sum(n)) AS v,
        greatest((sum(n) - sum(n * n) / sum(n)) / (count(*) - 1), 1e-9) AS n0
    FROM failures GROUP BY rule
),
prior AS (
    SELECT rule, m, CASE WHEN k < 2 THEN 2.0 WHEN v <= 0 THEN 10000.0
        ELSE least(greatest(m * (1 - m) / (v / n0) - 1, 2.0), 10000.0) END AS strength
    FROM moments
),
posterior AS (
    SELECT source, rule, f + greatest(m * strength, 1e-6) AS a, n - f + greatest((1 - m) * strength, 1e-6) AS b
    FROM failures JOIN prior USING (rule)
),
verdict AS (
    SELECT source, rule, a / (a + b) - 1.645 * sqrt(a * b / (a + b + 1)) / (a + b)
        > CASE rule WHEN 'base' THEN 0.9 ELSE 0.3 END AS habit
    FROM posterior
),
hosts AS (
    SELECT source, bool_or(habit AND rule = 'base') AS h_base, bool_or(habit AND rule = 'symbols') AS h_symbols,
        bool_or(habit AND rule = 'lines') AS h_lines, bool_or(habit AND rule = 'length') AS h_length
    FROM verdict GROUP BY source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT (base_failed OR h_base OR (h_symbols AND bad_symbols) OR (h_lines AND bad_lines)
         OR (h_length AND bad_length)) AS kept
FROM rules JOIN hosts ON rules.source IS NOT DISTINCT FROM hosts.source
"""

# The targets in closed form: of the sources ordered by limit per weight, the first k are cut off,
# with the smallest k at which the others' parts are within their limits.
SQL["op6_mixing"] = r"""
WITH d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
        ('0x' || substr(md5('mix-1|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))), 1, 13))::BIGINT
            / 4503599627370496.0::DOUBLE AS chance
    FROM documents
),
s AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
    FROM d GROUP BY source
),
ordered AS (
    SELECT *, sum(source_size) OVER () AS total, row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS k,
        coalesce(sum(2 * source_size) OVER before, 0) AS held, sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS rest
    FROM s WINDOW before AS (
        ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
levels AS (SELECT *, (1.5::DOUBLE * total - held) / rest AS level FROM ordered),
chosen AS (SELECT arg_min(level, k) AS level FROM levels WHERE 2 * source_size >= weight * level),
t AS (
    SELECT source, source_size, least((2 * source_size)::DOUBLE, weight * level) AS target FROM s, chosen
),
r AS (
    SELECT doc_id, size, source_size, target, chance,
        CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
    (size * (floor(rate) + CASE WHEN chance < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r
"""

SQL["op8_top_k"] = """
WITH v AS (
    SELECT vec_id, min(embedding::DOUBLE[]) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    GROUP BY vec_id
),
i AS (SELECT vec_id, list_transform(e, lambda x: floor(64 * x)) AS e FROM v),
scores AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
    FROM i q JOIN i c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scores
) WHERE rank <= 20
"""

SQL["op10_line_dedup"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id, -9223372036854775808) AS id,
        string_split(coalesce(text, ''), chr(10)) AS lines
    FROM documents
),
l AS (
    SELECT rid, doc_id, id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d
),
k AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM l
),
common AS (
    SELECT key, max(id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT id) >= 3
),
judged AS (
    SELECT k.*, keeper IS NOT NULL AND keeper <> id AS gone FROM k LEFT JOIN common USING (key)
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY rid
"""

SQL["op11_lexical_search"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
    FROM documents
),
sizes AS (SELECT count(*) FILTER (len(words) > 0) AS n_docs, sum(len(words))::HUGEINT AS n_words FROM d),
i AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT item_id, min(text) AS text FROM benchmark GROUP BY item_id)
),
tf AS (
    SELECT rid, doc_id, len(words) AS n, term, count(*) AS tf
    FROM (SELECT rid, doc_id, words, unnest(words) AS term FROM d)
    WHERE term IN (SELECT term FROM i) GROUP BY rid, doc_id, words, term
),
w AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM tf, sizes GROUP BY term, n_docs
),
parts AS (
    SELECT rid, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_words))) AS part
    FROM tf JOIN w USING (term), sizes
),
scores AS (SELECT item_id, rid, doc_id, sum(part)::BIGINT AS score FROM parts JOIN i USING (term) GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
    FROM scores WHERE score > 0
) WHERE rank <= 10
"""

# What is read back is what was written: turns in order, a missing role or text empty. The formatted text
# has 24 characters a turn besides role and text, and one more for each that is escaped.
SQL["op7_chat"] = r"""
WITH c AS (
    SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, role, text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
),
e AS (
    SELECT *, coalesce(role, '') AS r, coalesce(text, '') AS t,
        '\\|<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>|<\|startoftext\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>' AS control
    FROM c
),
f AS (
    SELECT *, 24 + length(r) + length(t) + len(regexp_extract_all(r, control)) + len(regexp_extract_all(t, control))
        + length(r) - length(replace(r, chr(10), '')) AS formatted
    FROM e
),
g AS (
    SELECT conv_id, count(*) AS n_turns, sum(formatted)::BIGINT AS formatted_chars,
        string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS turns,
        coalesce(string_agg(t, '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)
            FILTER (role = 'assistant'), '') AS loss
    FROM f GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
    formatted_chars
FROM g
"""

SQL["op9_near_dedup"] = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
    FROM documents
),
u AS (SELECT doc_id, len(words) AS n, unnest(words) AS a, generate_subscripts(words, 1) AS i FROM w),
v AS (
    SELECT doc_id, n, i, a || ' ' || lead(a, 1) OVER o || ' ' || lead(a, 2) OVER o || ' ' || lead(a, 3) OVER o || ' ' || lead(a, 4) OVER o AS shingle
    FROM u WINDOW o AS (PARTITION BY doc_id ORDER BY i)
),
h AS (
    SELECT DISTINCT doc_id, shingle FROM v WHERE shingle IS NOT NULL
    UNION ALL SELECT doc_id, array_to_string(words, ' ') FROM w WHERE len(words) BETWEEN 1 AND 4
),
n AS (SELECT doc_id, count(shingle) AS n_shingles FROM w LEFT JOIN h USING (doc_id) GROUP BY 1),
k AS (SELECT doc_id, dense_rank() OVER (ORDER BY shingle) AS shingle, count(*) OVER (PARTITION BY shingle) AS held FROM h QUALIFY held > 1),
shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS held
    FROM k x JOIN k y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2
),
links AS (
    SELECT a, b FROM shared JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
    WHERE 100 * held >= 85 * (p.n_shingles + q.n_shingles - held)
),
reached(a, b) AS (
    SELECT doc_id, doc_id FROM n
    UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
)
SELECT n.doc_id, n_shingles, component_id, n.doc_id = component_id AS kept
FROM n JOIN (SELECT a, min(b) AS component_id FROM reached GROUP BY a) r ON n.doc_id = r.a
"""
