"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

#: crc32 of the ASCII text ``{0}``: its bytes, each followed by eight steps of the shift register.
_CRC32 = (
    "xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split({0}, ''), "
    "lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda c, o: CASE WHEN o >= 0 THEN xor(c, o) "
    "WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), 4294967295)"
)

_OP8 = """
    WITH d AS (
      SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
      FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
    FROM d WINDOW w AS (PARTITION BY t)"""

_OP11 = r"""
    WITH c AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, i, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(i, r)),
    m AS (
      SELECT *, replace(replace(replace(replace(replace(replace(replace(text, '\', '\\'), '### System:', '#\## System:'),
               '### User:', '#\## User:'), '### Assistant:', '#\## Assistant:'), '### Role', '#\## Role'),
               '</role>', '<\/role>'), '</turn>', '<\/turn>') AS safe,
             CASE role WHEN 'system' THEN 12 WHEN 'user' THEN 10 WHEN 'assistant' THEN 15 ELSE 18 + length(role) END AS opens,
             row_number() OVER w AS pos,
             lag(CASE WHEN role IN ('system', 'user', 'assistant') THEN role END IGNORE NULLS) OVER w AS state
      FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
    s AS (
      SELECT *, NOT coalesce(CASE role WHEN 'system' THEN state IS NULL WHEN 'user' THEN coalesce(state, 'system') <> 'user'
                             WHEN 'assistant' THEN state = 'user' END, false) AS illegal FROM m)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
           sum(opens + length(safe) + 8)::BIGINT AS formatted_chars,
           count(*) FILTER (WHERE illegal) = 0 AND arg_max(role, pos) = 'assistant' AS valid,
           count(*) FILTER (WHERE illegal) AS n_illegal
    FROM s GROUP BY conv_id"""

_FRAMED = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_FRAMED.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_OP12 = f"""
    WITH RECURSIVE l AS (
      SELECT doc_id, source, {_leaf('text')} AS leaf, {_leaf('cut')} AS tampered
      FROM (SELECT *, CASE WHEN {_CRC32.format('doc_id::VARCHAR')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS cut
            FROM documents)),
    p AS (
      SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) AS tree,
             row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
             count(*) OVER (PARTITION BY source) AS n FROM l),
    low AS (
      SELECT tree, 0 AS level, place, n, leaf AS h FROM p
      UNION ALL
      SELECT tree, level + 1, place // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY place))
      FROM low WHERE n > 1 GROUP BY tree, level, place // 3, n),
    sub AS (SELECT tree, h AS subroot, level AS height FROM low WHERE n = 1),
    high AS (
      SELECT 0 AS level, tree - 1 AS place, (SELECT count(*) FROM sub) AS n, subroot AS h FROM sub
      UNION ALL
      SELECT level + 1, place // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY place))
      FROM high WHERE n > 1 GROUP BY level, place // 3, n),
    every AS (
      SELECT tree, level, place, n, h FROM low UNION ALL SELECT 0, level, place, n, h FROM high),
    side AS (
      SELECT a.tree, a.level, a.place,
             coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (WHERE b.place < a.place), '') AS l,
             coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (WHERE b.place > a.place), '') AS r
      FROM every a JOIN every b ON a.tree = b.tree AND a.level = b.level AND a.place // 3 = b.place // 3
      WHERE a.n > 1 GROUP BY ALL),
    way AS (
      SELECT row_number() OVER () AS k, doc_id, leaf, tree AS own, tree, 0 AS level, place, height, tampered AS h, '' AS proof
      FROM p JOIN sub USING (tree)
      UNION ALL
      SELECT k, doc_id, leaf, own, CASE WHEN up THEN 0 ELSE w.tree END, CASE WHEN up THEN 0 ELSE w.level + 1 END,
             CASE WHEN up THEN own - 1 ELSE w.place // 3 END, CASE WHEN up THEN (SELECT max(level) FROM high) ELSE height END,
             CASE WHEN up THEN w.h ELSE sha256(l || w.h || r) END, CASE WHEN up THEN proof ELSE proof || l || r END
      FROM (SELECT *, level = height AND tree > 0 AS up FROM way WHERE tree > 0 OR level < height) w
      LEFT JOIN side s ON s.tree = w.tree AND s.level = w.level AND s.place = w.place AND NOT up)
    SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, way.h AS folded_root, way.h = root AS verified
    FROM way JOIN sub ON sub.tree = own, (SELECT h AS root FROM high WHERE n = 1)
    WHERE way.tree = 0 AND way.level = way.height"""

#: Moves of the role machine (states: nothing yet, system, user, assistant) and of the edits on one row.
_OP13 = f"""
    WITH RECURSIVE kind AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             {_CRC32.format("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS k
      FROM conversations),
    d AS (
      SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
             CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
      FROM kind, unnest(range(CASE k WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) WHERE k <> 0),
    o AS (
      SELECT *, row_number() OVER w AS i, lag(role[1]) OVER w AS before
      FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
    p AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS copy FROM o),
    f AS (
      SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'b' WHEN copy > 1 THEN 'd'
                     WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 't' ELSE '' END AS fault
      FROM p),
    c AS (
      SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (WHERE fault = 'b') AS blank, count(*) FILTER (WHERE fault = 'd') AS duplicate,
             count(*) FILTER (WHERE fault = 't') AS truncated,
             count(*) FILTER (WHERE before IS NOT NULL AND before || role[1] NOT IN ('su', 'ua', 'au')) AS illegal,
             count(*) AS n
      FROM f GROUP BY conv_id),
    ins(a, b, cost, edits) AS (VALUES
      (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''),
      (0, 2, 2, 'I'), (1, 2, 2, 'I'), (2, 3, 2, 'I'), (3, 2, 2, 'I'),
      (0, 3, 4, 'II'), (1, 3, 4, 'II')),
    move(a, edit, initial, b, cost) AS (VALUES
      (0, 'D', NULL, 0, 3), (1, 'D', NULL, 1, 3), (2, 'D', NULL, 2, 3), (3, 'D', NULL, 3, 3),
      (0, 'R', NULL, 2, 2), (1, 'R', NULL, 2, 2), (2, 'R', NULL, 3, 2), (3, 'R', NULL, 2, 2),
      (0, 'K', 's', 1, 0), (0, 'K', 'u', 2, 0), (1, 'K', 'u', 2, 0), (2, 'K', 'a', 3, 0), (3, 'K', 'u', 2, 0)),
    run AS (
      SELECT conv_id, 0 AS i, 0 AS state, '0000000000' AS best FROM c
      UNION ALL
      SELECT r.conv_id, r.i + 1, m.b,
             min(printf('%010d', r.best[1:10]::BIGINT + ins.cost + m.cost + CASE WHEN m.edit <> 'D' AND f.fault = 't' THEN 1 ELSE 0 END)
                 || r.best[11:] || ins.edits || m.edit)
      FROM run r JOIN f ON f.conv_id IS NOT DISTINCT FROM r.conv_id AND f.i = r.i + 1
      JOIN ins ON ins.a = r.state
      JOIN move m ON m.a = ins.b AND (m.edit <> 'K' OR m.initial = f.role[1]) AND (m.edit = 'D' OR f.fault NOT IN ('b', 'd'))
      GROUP BY r.conv_id, r.i, m.b),
    found AS (
      SELECT c.conv_id, min(printf('%010d', best[1:10]::BIGINT + ins.cost) || best[11:] || ins.edits) AS best
      FROM run JOIN c ON c.conv_id IS NOT DISTINCT FROM run.conv_id AND run.i = c.n
      JOIN ins ON ins.a = run.state AND ins.b IN (0, 3) GROUP BY c.conv_id),
    edits AS (
      SELECT conv_id, best[1:10]::BIGINT AS cost, best[11:] AS audit, k, best[10 + k] AS edit
      FROM found, unnest(range(1, length(best) - 9)) t(k)),
    kept AS (
      SELECT *, count(*) FILTER (WHERE edit <> 'I') OVER w AS i, count(*) FILTER (WHERE edit <> 'D') OVER w AS j
      FROM edits WINDOW w AS (PARTITION BY conv_id ORDER BY k ROWS UNBOUNDED PRECEDING)),
    made AS (
      SELECT kept.conv_id, kept.k, CASE WHEN edit = 'K' THEN f.role
               WHEN (kept.j - CASE WHEN bool_or(edit = 'K' AND f.role[1] = 's') OVER (PARTITION BY kept.conv_id) THEN 1 ELSE 0 END) % 2 = 1
               THEN 'user' ELSE 'assistant' END AS role,
             CASE WHEN edit = 'I' THEN '' ELSE f.text END AS text, edit
      FROM kept LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM kept.conv_id AND f.i = kept.i AND kept.edit <> 'I'),
    lines AS (
      SELECT conv_id, string_agg(role || ':' || text, chr(10) ORDER BY k) AS whole FROM made WHERE edit <> 'D' GROUP BY conv_id),
    ids AS (SELECT DISTINCT conv_id FROM conversations)
    SELECT ids.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
           coalesce(best[1:10]::BIGINT, 0) AS cost, coalesce(best[11:], '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
    FROM ids LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM ids.conv_id
    LEFT JOIN found ON found.conv_id IS NOT DISTINCT FROM ids.conv_id
    LEFT JOIN lines ON lines.conv_id IS NOT DISTINCT FROM ids.conv_id"""

ORACLE_SQL = {
    "op8_grace_dedup": _OP8,
    "op11_chat_segments": _OP11,
    "op12_pointer_jumping_manifest": _OP12,
    "op13_branch_and_bound_repair": _OP13,
}
