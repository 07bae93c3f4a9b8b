"""DuckDB SQL for the operators on windows, filters and conversations."""

OP11 = r"""
    WITH w AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
    ), g AS (
        SELECT doc_id, s AS start, array_to_string(words[s + 1 : s + 20], ' ') AS win
        FROM (SELECT doc_id, words, unnest(range(len(words) - 19)) AS s FROM w WHERE len(words) >= 20)
    ), f AS (
        SELECT doc_id, start FROM g QUALIFY row_number() OVER (PARTITION BY win ORDER BY doc_id, start) > 1
    ), c AS (
        SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(start, start + 20)) AS p FROM f)
    ), each AS (
        SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS p FROM w
    ), kept AS (
        SELECT e.doc_id, count(c.p) AS n_removed, string_agg(e.word, ' ' ORDER BY e.p) FILTER (c.p IS NULL) AS kept
        FROM each e LEFT JOIN c ON e.doc_id = c.doc_id AND e.p = c.p GROUP BY 1
    )
    SELECT w.doc_id, len(w.words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
           sha256(coalesce(kept, '')) AS kept_sha256
    FROM w LEFT JOIN kept USING (doc_id)
"""

OP12 = r"""
    WITH t AS (
        SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
               min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least
        FROM documents
    ), f AS (
        SELECT doc_id, part,
               CASE WHEN len(words) < 50 THEN 'A' ELSE '' END
               || CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END
               || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' ELSE '' END
               || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
               || CASE WHEN doc_id > least THEN 'E' ELSE '' END AS fails
        FROM t
    ), n AS (
        SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
        FROM f LEFT JOIN (
            SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY 1
        ) USING (doc_id) GROUP BY 1, 2
    ), x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c), o AS (
        SELECT a.c || b.c || c.c || d.c || e.c AS filter_order
        FROM x a, x b, x c, x d, x e
        WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5
    ), s AS (
        SELECT filter_order, step, filter_order[step] AS filter, filter_order[1 : step - 1] AS before
        FROM o, (SELECT unnest(range(1, 6))::INTEGER AS step)
    ), r AS (
        SELECT n.*, s.*, contains(fails, filter) AS failing,
               before <> '' AND regexp_matches(fails, '[' || before || '_]') AS gone
        FROM n, s
    ), d AS (
        SELECT part, filter_order, step, filter,
               coalesce(sum(n) FILTER (NOT gone AND NOT failing), 0)::BIGINT AS kept,
               coalesce(sum(n) FILTER (NOT gone AND failing), 0)::BIGINT AS removed,
               coalesce(sum(n) FILTER (gone AND failing), 0)::BIGINT AS redundant,
               coalesce(sum(n) FILTER (fails = filter), 0)::BIGINT AS unique_fails,
               coalesce(sum(good) FILTER (NOT gone AND failing), 0)::BIGINT AS good_lost,
               coalesce(sum(toxic) FILTER (NOT gone AND failing), 0)::BIGINT AS toxic_lost
        FROM r GROUP BY 1, 2, 3, 4
    )
    SELECT * EXCLUDE (filter), (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley FROM d
"""

OP13 = r"""
    WITH RECURSIVE raw AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '') AS chars
        FROM conversations
    ), bits AS (
        SELECT conv_id, turn, role, text, flatten(list_transform(chars, lambda c:
                   list_transform([0, 1, 2, 3, 4, 5, 6, 7], lambda i: ((ascii(c) >> i) & 1)::BIGINT))) AS bits
        FROM raw
    ), kinds AS (
        SELECT conv_id, turn, role, text, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, bits), lambda c, b:
                   xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1)))) % 20 AS kind
        FROM bits
    ), damaged AS (
        SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
               CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
        FROM (SELECT *, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) FROM kinds WHERE kind <> 0)
    ), placed AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM damaged
    ), faults AS (
        SELECT *, role[1] AS initial,
               CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
                    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '-' END AS fault,
               lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS before
        FROM placed
    ), counts AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
               count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
               count(*) FILTER (fault = 't') AS truncated,
               count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
        FROM faults GROUP BY 1
    ), ins(state, roles, top) AS (
        VALUES (0, '', 0), (0, 'u', 4), (0, 'ua', 3), (1, '', 1), (1, 'u', 4), (1, 'ua', 3),
               (3, '', 3), (3, 'u', 4), (4, '', 4), (4, 'a', 3)
    ), shift(top, symbol, next) AS (
        VALUES (0, 's', 1), (0, 'u', 4), (1, 'u', 4), (3, 'u', 4), (4, 'a', 3)
    ), added AS (
        SELECT state, top, 3 * len(roles) AS cost, repeat('I', len(roles)) AS audit,
               CASE roles WHEN '' THEN []::VARCHAR[] WHEN 'u' THEN ['user:'] WHEN 'a' THEN ['assistant:'] ELSE ['user:', 'assistant:'] END AS lines
        FROM ins
    ), act AS (
        SELECT state, a.cost + 4 AS cost, a.audit || 'D' AS audit, lines, 'D' AS letter, NULL AS symbol, top AS next FROM added a
        UNION ALL
        SELECT state, a.cost, a.audit || 'K', lines, 'K', symbol, next FROM added a JOIN shift USING (top)
        UNION ALL
        SELECT state, a.cost + 3, a.audit || 'R', lines, 'R', symbol, next FROM added a JOIN shift USING (top) WHERE symbol <> 's'
    ), parse AS (
        SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS state, 0 AS cost, '' AS audit, []::VARCHAR[] AS lines FROM faults
        UNION ALL
        SELECT p.conv_id, p.i + 1, act.next,
               (p.cost + act.cost + CASE WHEN f.fault = 't' AND letter <> 'D' THEN 3 ELSE 0 END)::INTEGER AS total,
               p.audit || act.audit AS way,
               p.lines || act.lines || CASE letter WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [f.role || ':' || f.text]
                   ELSE [CASE symbol WHEN 'u' THEN 'user:' ELSE 'assistant:' END || f.text] END
        FROM parse p
        JOIN faults f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1
        JOIN act ON act.state = p.state
            AND (letter = 'D' OR f.fault IN ('t', '-') AND (letter = 'R' OR symbol = f.initial))
        QUALIFY row_number() OVER (PARTITION BY p.conv_id, act.next ORDER BY total, way) = 1
    ), ends AS (
        SELECT p.conv_id, p.cost + a.cost AS cost, p.audit || a.audit AS audit, p.lines || a.lines AS lines
        FROM parse p
        JOIN (SELECT conv_id, count(*) AS n FROM faults GROUP BY 1) n ON n.conv_id IS NOT DISTINCT FROM p.conv_id AND n.n = p.i
        JOIN added a ON a.state = p.state AND a.top IN (0, 3)
        QUALIFY row_number() OVER (PARTITION BY p.conv_id ORDER BY p.cost + a.cost, p.audit || a.audit) = 1
    )
    SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
           coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
           coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
           sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) c
    LEFT JOIN counts k ON k.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""

SQL = {"op11_substring_dedup": OP11, "op12_filter_audit": OP12, "op13_structure_repair": OP13}
