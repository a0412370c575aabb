"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from mentionlake.llm import decontamination, lines, mixing, phrases, sharding, urls

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _bid(shard: int) -> str:
    digest = f"md5(k || ':{shard}')"
    return f"1.0 / -ln((('0x' || substr({digest}, 1, 13))::UBIGINT::DOUBLE + 0.5) / {1 << 52}::DOUBLE)"


# crc32 is no function of DuckDB; the table is made from the polynomial.
CRC_TABLE = """crc_step(b, i, c) AS (
        SELECT b, 0, b::UBIGINT FROM range(256) r(b)
        UNION ALL
        SELECT b, i + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END FROM crc_step WHERE i < 8
    ),
    crc_table AS (SELECT list(c ORDER BY b) AS t FROM crc_step WHERE i = 8)"""


def _crc(hex_text: str, size: str) -> str:
    """The CRC-32 of ``size`` bytes given as hexadecimal digits; needs the table ``crc_table``."""
    return f"""xor(list_reduce(list_prepend(4294967295::UBIGINT, [('0x' || substr({hex_text}, 2 * i - 1, 2))::UBIGINT FOR i IN range(1, ({size}) + 1)]),
                   lambda c, x: xor(t[(xor(c, x) & 255)::INT + 1], c >> 8)), 4294967295::UBIGINT)::BIGINT"""


def _repair() -> str:
    """Faults, then for each place from the last to the first the cheapest letters of each state, least first among equals."""
    edits = []
    for state, keep, becomes in ((0, "u", 2), (1, "u", 2), (2, "a", 3), (3, "u", 2)):
        edits.append(f"SELECT {state} AS q, 'D' AS x, {state} AS leads, 4 AS price, NULL AS initial")
        edits.append(f"SELECT {state}, 'R', {becomes}, 3, NULL")
        edits.append(f"SELECT {state}, 'K', {becomes}, 0, '{keep}'")
    edits.append("SELECT 0, 'K', 1, 0, 's'")
    return f"""
    WITH RECURSIVE {CRC_TABLE},
    shown AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
        FROM conversations
    ),
    drawn AS (SELECT *, {_crc("hex(encode(k))", "strlen(k)")} % 20 AS kind FROM shown, crc_table),
    damaged AS (
        SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
               CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
        FROM drawn, range(CASE WHEN kind = 3 THEN 2 ELSE 1 END) WHERE kind <> 0
    ),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS pos,
               regexp_extract(text, '([^ \\x09-\\x0D])[ \\x09-\\x0D]*$', 1) AS closing
        FROM damaged
    ),
    faults AS (
        SELECT conv_id, turn, role, text, pos, left(role, 1) AS initial, closing = '' AS blank,
               closing <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS duplicate,
               closing <> '' AND closing NOT IN ('.', '!', '?') AND NOT duplicate AS truncated,
               lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) AS pair
        FROM placed
    ),
    counted AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS rows_left,
               sum(blank::INT) AS blank, sum(duplicate::INT) AS duplicate, sum(truncated::INT) AS truncated,
               sum(CASE WHEN pair NOT IN ('su', 'ua', 'au') THEN 1 ELSE 0 END) AS illegal
        FROM faults GROUP BY conv_id
    ),
    edits AS ({" UNION ALL ".join(edits)}),
    states AS (
        SELECT conv_id, rows_left AS pos, unnest([{{'q': 0, 'cost': 0, 'audit': ''}}, {{'q': 1, 'cost': 6, 'audit': 'II'}},
            {{'q': 2, 'cost': 3, 'audit': 'I'}}, {{'q': 3, 'cost': 0, 'audit': ''}}], recursive := true)
        FROM counted
        UNION ALL
        (
            WITH before AS (
                SELECT s.conv_id, s.pos - 1 AS pos, e.q, min({{'cost': s.cost + e.price + CASE WHEN f.truncated AND e.x <> 'D' THEN 3 ELSE 0 END, 'audit': e.x || s.audit}}) AS m
                FROM states s
                JOIN faults f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.pos = s.pos
                JOIN edits e ON e.leads = s.q AND (e.x = 'D' OR NOT (f.blank OR f.duplicate)) AND (e.initial IS NULL OR e.initial = f.initial)
                GROUP BY s.conv_id, s.pos, e.q
            )
            SELECT conv_id, pos, q, m.cost, m.audit FROM (
                SELECT b.conv_id, b.pos, w.q, min({{'cost': b.m.cost + w.price, 'audit': w.x || b.m.audit}}) AS m
                FROM before b
                JOIN (VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 3, 'I'), (1, 2, 3, 'I'), (3, 2, 3, 'I'), (2, 3, 3, 'I'),
                    (0, 3, 6, 'II'), (1, 3, 6, 'II')) w(q, leads, price, x) ON w.leads = b.q
                GROUP BY b.conv_id, b.pos, w.q
            )
        )
    ),
    letters AS (
        SELECT s.conv_id, s.cost, s.audit, i, s.audit[i] AS x, strlen(replace(s.audit[1:i], 'I', '')) AS pos
        FROM states s, range(1, strlen(s.audit) + 1) r(i) WHERE s.pos = 0 AND s.q = 0
    ),
    output AS (
        SELECT l.conv_id, l.i, l.x, f.initial, f.role, CASE WHEN l.x = 'I' THEN '' ELSE f.text END AS text,
               row_number() OVER (PARTITION BY l.conv_id ORDER BY i) AS place, first_value(CASE WHEN l.x = 'K' THEN f.initial END) OVER (PARTITION BY l.conv_id ORDER BY i) AS opens
        FROM letters l LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.pos = l.pos WHERE l.x <> 'D'
    ),
    written AS (
        SELECT conv_id, string_agg(CASE WHEN x = 'K' THEN role
            WHEN (place + (CASE WHEN opens = 's' THEN 1 ELSE 0 END)) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY i) AS repaired
        FROM output GROUP BY conv_id
    )
    SELECT a.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank, coalesce(c.duplicate, 0)::BIGINT AS duplicate,
           coalesce(c.truncated, 0)::BIGINT AS truncated, coalesce(c.illegal, 0)::BIGINT AS illegal, coalesce(s.cost, 0)::BIGINT AS cost,
           coalesce(s.audit, '') AS audit, sha256(coalesce(w.repaired, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) a
    LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM a.conv_id
    LEFT JOIN states s ON s.conv_id IS NOT DISTINCT FROM a.conv_id AND s.pos = 0 AND s.q = 0
    LEFT JOIN written w ON w.conv_id IS NOT DISTINCT FROM a.conv_id"""


def _phrases() -> str:
    """All phrases are counted; nothing is pruned."""
    longest, least, top, scale = phrases.LONGEST, phrases.LEAST, phrases.TOP, phrases.SCALE
    windows = " UNION ALL ".join(
        f"SELECT lang, array_to_string(w[i:i + {k - 1}], ' ') AS phrase, {k} AS words FROM pieces, range(1, len(w) - {k - 2}) r(i)" for k in range(1, longest + 1))
    return f"""
    WITH split AS (
        SELECT coalesce(lang, '{phrases.UNKNOWN}') AS lang, unnest(regexp_split_to_array({LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
    ),
    pieces AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM split),
    totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
    counted AS (SELECT lang, phrase, words, count(*) AS f FROM ({windows}) GROUP BY ALL HAVING count(*) >= {least}),
    cut AS (
        SELECT c.lang, c.phrase, c.f AS a, k, array_to_string(string_split(c.phrase, ' ')[1:k], ' ') AS head,
               array_to_string(string_split(c.phrase, ' ')[k + 1:], ' ') AS rest
        FROM counted c, range(1, c.words) r(k) WHERE c.words > 1
    ),
    scored AS (
        SELECT cut.lang, cut.phrase, cut.a, min({{'score': ({scale}::HUGEINT * a * n // (h.f::HUGEINT * r.f))::BIGINT, 'k': k, 'l': h.f, 'r': r.f}}) AS best, n
        FROM cut JOIN totals USING (lang)
        JOIN counted h ON h.lang = cut.lang AND h.phrase = cut.head JOIN counted r ON r.lang = cut.lang AND r.phrase = cut.rest
        GROUP BY cut.lang, cut.phrase, cut.a, n
    ),
    kept AS (
        SELECT * FROM scored s WHERE NOT EXISTS (
            SELECT 1 FROM counted b WHERE b.lang = s.lang AND b.f = s.a AND strlen(b.phrase) > strlen(s.phrase)
              AND contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' '))
    ),
    placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY best.score DESC, a DESC, phrase) AS rank FROM kept)
    SELECT lang, rank, phrase, a, best.l AS l, best.r AS r, n, best.score AS score FROM placed WHERE rank <= {top}"""


def _sharding() -> str:
    n = sharding.SHARDS
    bids = ", ".join(_bid(i) for i in range(n + 1))
    # crc32 is no function of DuckDB; the table is made from the polynomial.
    return f"""
    WITH RECURSIVE crc_step(b, i, c) AS (
        SELECT b, 0, b::UBIGINT FROM range(256) r(b)
        UNION ALL
        SELECT b, i + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END FROM crc_step WHERE i < 8
    ),
    crc_table AS (SELECT list(c ORDER BY b) AS t FROM crc_step WHERE i = 8),
    keyed AS (
        SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS k, coalesce(text, '') AS body FROM documents
    ),
    bids AS (SELECT *, [{bids}] AS bid FROM keyed),
    placed AS (
        SELECT doc_id, k, strlen(body)::BIGINT + 1 AS size, hex(encode(body)) AS h,
               (list_position(bid[1:{n}], list_max(bid[1:{n}])) - 1)::INT AS shard,
               (list_position(bid, list_max(bid)) - 1)::INT AS grown_shard
        FROM bids
    ),
    summed AS (
        SELECT doc_id, k, size, shard, grown_shard,
               xor(list_reduce(list_prepend(4294967295::UBIGINT, [('0x' || substr(h, 2 * i - 1, 2))::UBIGINT FOR i IN range(1, size)]),
                   lambda c, x: xor(t[(xor(c, x) & 255)::INT + 1], c >> 8)), 4294967295::UBIGINT)::BIGINT AS text_crc32
        FROM placed, crc_table
    )
    SELECT doc_id, size, text_crc32, 'key' AS law, shard,
           row_number() OVER (PARTITION BY shard ORDER BY md5(k), doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard
    FROM summed"""


def _time(weight: int) -> str:
    at = "NULL"
    for t0, t1, w0, slope, before in mixing.segments(mixing.SCHEDULE[weight]):
        rest = f"greatest(share - {before!r}::DOUBLE, 0.0::DOUBLE)"
        root = f"(sqrt(greatest({w0 * w0!r}::DOUBLE + {rest} * {2 * slope!r}::DOUBLE, 0.0::DOUBLE)) + {w0!r}::DOUBLE)"
        here = f"(CASE WHEN {root} > 0 THEN least({rest} * 2.0::DOUBLE / {root} + {t0!r}::DOUBLE, {t1!r}::DOUBLE) ELSE {t0!r}::DOUBLE END)"
        at = here if at == "NULL" else f"(CASE WHEN share >= {before!r}::DOUBLE THEN {here} ELSE {at} END)"
    return at


def _mixing() -> str:
    weights, repeats = list(mixing.WEIGHTS), mixing.REPEATS
    when = " ".join(f"WHEN weight = {w} THEN {_time(w)}" for w in dict.fromkeys(weights))
    return f"""
    WITH sized AS (
        SELECT doc_id, coalesce('0' || source, '1') AS src, md5(coalesce(doc_id::VARCHAR, '')) AS digest,
               len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size
        FROM documents
    ),
    ranked AS (
        SELECT src, sum(size)::BIGINT AS source_size,
               ({weights})[((row_number() OVER (ORDER BY src) - 1) % {len(weights)} + 1)::INT]::BIGINT AS weight
        FROM sized GROUP BY src
    ),
    filling AS (
        SELECT *, source_size * {repeats} AS cap, sum(source_size) OVER () AS every,
               sum(weight) OVER () - coalesce(sum(weight) OVER lower, 0) AS remaining,
               coalesce(sum(source_size * {repeats}) OVER lower, 0) AS used
        FROM ranked
        WINDOW lower AS (ORDER BY (source_size * {repeats})::DOUBLE / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ),
    stopping AS (SELECT *, cap * remaining <= (every - used) * weight AS stops FROM filling),
    levels AS (
        SELECT *, sum(CASE WHEN stops THEN cap ELSE 0 END) OVER () AS stopped, sum(CASE WHEN stops THEN 0 ELSE weight END) OVER () AS sharing
        FROM stopping
    ),
    target AS (
        SELECT src, source_size, weight,
               CASE WHEN stops THEN cap::DOUBLE ELSE ((every - stopped) * weight)::DOUBLE / sharing::DOUBLE END AS target
        FROM levels
    ),
    placed AS (
        SELECT *, floor(target + 0.5)::BIGINT AS budget,
               coalesce(sum(size) OVER (PARTITION BY src ORDER BY digest, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
        FROM sized JOIN target USING (src)
    ),
    copies AS (
        SELECT *, {" + ".join(f"greatest(0, least(size, budget - start - source_size * {c}))" for c in range(repeats))} AS taken,
               {" + ".join(f"(CASE WHEN size > 0 AND budget - start - source_size * {c} > 0 THEN 1 ELSE 0 END)" for c in range(repeats))} AS copies,
               CASE WHEN budget > 0 THEN least(start::DOUBLE / budget::DOUBLE, 1.0::DOUBLE) ELSE 0.0::DOUBLE END AS share
        FROM placed
    )
    SELECT doc_id, size, source_size, target, taken::BIGINT AS taken, copies::INT AS copies,
           CASE WHEN copies > 0 THEN CASE {when} END END AS position
    FROM copies"""


def _decontamination() -> str:
    words = f"regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    m = decontamination.WINDOW
    return f"""
    WITH items AS (SELECT item_id::VARCHAR AS item, {words} AS w FROM benchmark WHERE item_id IS NOT NULL),
    windows AS (
        SELECT DISTINCT item, least({m}, len(w)) AS m, array_to_string(w[i:i + least({m}, len(w)) - 1], ' ') AS s
        FROM (SELECT item, w, unnest(range(1, len(w) - least({m}, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)
    ),
    docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
    places AS (
        SELECT r, i, m, array_to_string(w[i:i + m - 1], ' ') AS s
        FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM docs, (SELECT DISTINCT m FROM windows))
    ),
    found AS (SELECT r, i, m, item FROM places JOIN windows USING (m, s)),
    hits AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS p FROM found) GROUP BY r),
    named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
           sha256(coalesce(names, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM docs LEFT JOIN hits USING (r) LEFT JOIN named USING (r)"""


def _warc() -> str:
    # Five hex digits are four digits of base 32.
    groups = " || ".join(
        f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(h, {5 * g + 1}, 5))::INT >> {s}) & 31) + 1), 1)" for g in range(8) for s in (15, 10, 5, 0)
    )
    return f"""
    WITH hashed AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
    largest AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS first FROM hashed)
    SELECT page_id, payload_bytes, {groups} AS payload_digest,
           CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
    FROM largest"""


def _lines() -> str:
    def edits(n: str) -> str:
        return f"least({lines.DISTANCE}, {n} // {lines.CHARS_PER_EDIT})"

    return f"""
    WITH RECURSIVE docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
    placed AS MATERIALIZED (
        SELECT r, doc_id, unnest(range(len(parts))) AS place, unnest(parts) AS line FROM docs
    ),
    filled AS MATERIALIZED (SELECT * FROM placed WHERE trim(line, ' ') <> ''),
    texts AS MATERIALIZED (
        SELECT line, count(*) AS n, min({{'d': doc_id, 'p': place}}) AS head, length(line) AS chars FROM filled GROUP BY line
    ),
    edge AS MATERIALIZED (
        SELECT a.line AS a, b.line AS b FROM texts a JOIN texts b
        ON b.chars BETWEEN a.chars AND a.chars + {lines.DISTANCE} AND (a.chars < b.chars OR a.line < b.line)
        WHERE a.chars >= {lines.CHARS_PER_EDIT} AND b.chars - a.chars <= {edits("a.chars")} AND levenshtein(a.line, b.line) <= {edits("a.chars")}
    ),
    both_ways AS MATERIALIZED (SELECT a, b FROM edge UNION ALL SELECT b, a FROM edge),
    reach(a, b) AS (SELECT DISTINCT a, a FROM both_ways UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a),
    heads AS (SELECT a AS line, min(head) AS head FROM reach JOIN texts ON reach.b = texts.line GROUP BY a),
    degrees AS (SELECT a AS line, count(*) AS links FROM both_ways GROUP BY a),
    marked AS (
        SELECT r, place, coalesce(heads.head, texts.head) <> {{'d': filled.doc_id, 'p': place}} AS gone, coalesce(links, 0) AS links
        FROM filled JOIN texts USING (line) LEFT JOIN heads USING (line) LEFT JOIN degrees USING (line)
    ),
    summed AS (
        SELECT r, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
               coalesce(string_agg(place::VARCHAR, ',' ORDER BY place) FILTER (gone), '') AS removed, sum(links)::BIGINT AS n_links
        FROM marked GROUP BY r
    )
    SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(removed, '') AS removed, coalesce(n_links, 0) AS n_links
    FROM docs LEFT JOIN summed USING (r)"""


def _urls() -> str:
    rules = sorted(urls.RULES, key=lambda r: -len(r.name))
    fits = [f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN" for r in rules]
    name = " ".join(f"{f} '{r.name}'" for f, r in zip(fits, rules, strict=True))
    allow = " ".join(f"{f} {str(r.allow).lower()}" for f, r in zip(fits, rules, strict=True))
    levels = ""
    for i in range(urls.LEVELS):
        apart = " OR ".join(
            f"(abs({c} / n::DOUBLE - p{c} / pn::DOUBLE) > 0 AND abs({c} / n::DOUBLE - p{c} / pn::DOUBLE) > "
            f"sqrt(p{c} / pn::DOUBLE * (1 - p{c} / pn::DOUBLE) / n) * {urls.DEVIATIONS}::DOUBLE)" for c in ("allowed", "blocked", "ends"))
        levels += f"""
    wide{i} AS (
        SELECT *, CASE WHEN regexp_matches(segments[{i + 1}], '{urls.ID_LIKE}') THEN '*' ELSE segments[{i + 1}] END AS segment FROM state{i}
    ),
    branch{i} AS (
        SELECT host, template, segment, sum(n)::BIGINT AS n, sum(allowed)::BIGINT AS allowed, sum(blocked)::BIGINT AS blocked,
               sum(CASE WHEN len(segments) = {i + 1} THEN n ELSE 0 END)::BIGINT AS ends
        FROM wide{i} WHERE segment IS NOT NULL GROUP BY ALL
    ),
    usual{i} AS (
        SELECT * FROM (SELECT *, sum(n) OVER (PARTITION BY host, template) AS everything FROM branch{i})
        WHERE segment <> '*' AND n >= {urls.LEAST_URLS} AND n >= everything * {urls.LEAST_SHARE}::DOUBLE
    ),
    kept{i} AS (
        SELECT host, template, segment, true AS kept
        FROM (SELECT *, {", ".join(f"sum({c}) OVER (PARTITION BY host, template) AS p{c}" for c in ("n", "allowed", "blocked", "ends"))} FROM usual{i})
        WHERE {apart}
    ),
    state{i + 1} AS (
        SELECT host, path, n, allowed, blocked, segments,
               template || coalesce('/' || CASE WHEN kept THEN segment WHEN segment IS NOT NULL THEN '*' END, '') AS template
        FROM wide{i} LEFT JOIN kept{i} USING (host, template, segment)
    ),"""
    return f"""
    WITH parsed AS (
        SELECT page_id, {LOWER.replace("text", "regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1)")} AS host,
               coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
        FROM pages
    ),
    ruled AS MATERIALIZED (SELECT *, CASE {name} END AS rule, CASE {allow} END AS allow FROM parsed),
    state0 AS (
        SELECT host, path, count(*) AS n, count(*) FILTER (allow) AS allowed, count(*) FILTER (NOT allow) AS blocked,
               list_filter(string_split(path, '/'), lambda s: s <> '') AS segments, '' AS template
        FROM ruled GROUP BY host, path
    ),{levels}
    placed AS (
        SELECT host, path, n, allowed, blocked, template || CASE WHEN len(segments) > {urls.LEVELS} THEN '/**' ELSE '' END AS template FROM state{urls.LEVELS}
    ),
    prior AS (SELECT coalesce(sum(allowed)::DOUBLE / nullif(sum(allowed) + sum(blocked), 0)::DOUBLE, 1.0::DOUBLE) AS prior FROM placed),
    purity AS (
        SELECT host, template, (sum(allowed) + (sum(n) - sum(allowed) - sum(blocked) + {urls.PRIOR_PAGES}::DOUBLE) * any_value(prior)) / (sum(n) + {urls.PRIOR_PAGES}::DOUBLE) AS purity
        FROM placed, prior GROUP BY host, template
    )
    SELECT page_id, host, path, rule, CASE WHEN allow THEN 'allow' WHEN NOT allow THEN 'block' WHEN purity < {urls.REJECT_BELOW}::DOUBLE THEN 'block' ELSE 'allow' END AS verdict,
           template, purity
    FROM ruled JOIN placed USING (host, path) JOIN purity USING (host, template)"""


SQL = {
    "op3_warc_zstd": _warc(),
    "op4_rendezvous_sharding": _sharding(),
    "op5_wu_manber_decontamination": _decontamination(),
    "op7_line_edit_join": _lines(),
    "op8_path_templates": _urls(),
    "op10_curriculum_mixing": _mixing(),
    "op11_auction_repair": _repair(),
    "op12_phrase_growth": _phrases(),
}
