"""The queries of this package in DuckDB's SQL, where it can state them on whole tables."""

from __future__ import annotations

from tallyloom.llm import secret_scan

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_LOWER}')"


def _crc32(text: str) -> str:
    """Unsigned crc32 of a text's UTF-8 bytes: one table look-up per byte, in a macro-free form.

    The table ``crc`` (a list of 256 numbers) must be in scope as ``k.t``.
    """
    code = f"list_transform(range(0, octet_length(encode({text}))), lambda i: CAST(('0x' || substr(hex(encode({text})), 2 * i + 1, 2)) AS BIGINT))"
    step = "xor(acc >> 8, k.t[xor(acc & 255, b) + 1])"
    return f"xor(list_reduce({code}, lambda acc, b: {step}, CAST(4294967295 AS BIGINT)), 4294967295)"


#: Eight shifts of every byte.
_CRC_TABLE = (
    "crc AS (WITH RECURSIVE c(i, n, v) AS (SELECT i, 0, CAST(i AS BIGINT) FROM range(256) r(i) UNION ALL "
    "SELECT i, n + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM c WHERE n < 8) "
    "SELECT list(v ORDER BY i) AS t FROM c WHERE n = 8)"
)


def _secrets() -> str:
    """Matches and the texts between them alternate: a match starts after all that is before it."""
    parts = []
    for rules in (secret_scan.BASE, secret_scan.ADDED):
        for i, rule in enumerate(rules.rules):
            pattern = rule.pattern.replace("'", "''")
            own = f"length(regexp_extract(m[i], '{pattern}', {rule.group}))"
            parts.append(
                f"SELECT rid, {rules.first + i} AS rank, '{rule.kind}' AS kind, s, s + length(m[i]) AS e FROM (SELECT rid, m, i, "
                "list_sum(list_transform(b[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS s "
                f"FROM (SELECT rid, m, b, unnest(range(1, len(m) + 1)) AS i FROM (SELECT rid, regexp_extract_all(t, '{pattern}') AS m, "
                f"regexp_split_to_array(t, '{pattern}') AS b FROM d))) WHERE {own} >= {rule.least}"
            )
    base = len(secret_scan.BASE.rules)
    counts = ", ".join(f"count(s.kind) FILTER (WHERE s.kind = '{r.kind}') AS n_{r.kind}" for r in secret_scan.BASE.rules)
    span = "s.kind || ':' || CAST(s.s AS BIGINT) || ':' || CAST(s.e AS BIGINT)"
    return (
        "WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents), "
        f"s AS ({' UNION ALL '.join(parts)}) "
        f"SELECT any_value(d.doc_id) AS doc_id, {counts}, "
        f"sha256(coalesce(string_agg({span}, ',' ORDER BY s.s, s.rank) FILTER (WHERE s.rank < {base}), '')) AS base_sha256, "
        f"coalesce(string_agg({span}, ',' ORDER BY s.s, s.rank), '') AS spans "
        "FROM d LEFT JOIN s ON s.rid = d.rid GROUP BY d.rid"
    )


_NEAR = (
    "WITH RECURSIVE w AS (SELECT row_number() OVER () AS rid, doc_id, "
    f"regexp_extract_all({_lower('coalesce(text, ' + chr(39) * 2 + ')')}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents), "
    "h AS (SELECT DISTINCT rid, array_to_string(w[i:i + 3], ' ') AS h FROM "
    "(SELECT rid, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM w WHERE len(w) > 0)), "
    "n AS (SELECT rid, count(*) AS n FROM h GROUP BY rid), "
    "p AS (SELECT a.rid AS a, b.rid AS b, count(*) AS c FROM h a JOIN h b ON a.h = b.h AND a.rid <> b.rid GROUP BY 1, 2), "
    "l AS (SELECT p.a, p.b FROM p JOIN n x ON x.rid = p.a JOIN n y ON y.rid = p.b WHERE 100 * p.c >= 80 * (x.n + y.n - p.c)), "
    "r(rid, via) AS (SELECT rid, rid FROM w UNION SELECT r.rid, l.b FROM r JOIN l ON l.a = r.via), "
    "g AS (SELECT r.rid, min(w.doc_id) AS c, arg_min(w.rid, struct_pack(a := w.doc_id IS NULL, b := w.doc_id, c := w.rid)) AS head "
    "FROM r JOIN w ON w.rid = r.via GROUP BY r.rid) "
    "SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, g.c AS component_id, g.head = w.rid AS kept "
    "FROM w JOIN g ON g.rid = w.rid LEFT JOIN n ON n.rid = w.rid"
)

_REPEATS = (
    "WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents), "
    # long texts by pieces of 1,024 bytes and the 199 after them, so that no position is looked for from the start of a text
    "e AS (SELECT rid, c, substr(x, 2 * c + 1, 2446) AS y FROM (SELECT rid, x, unnest(range(0, length(x) // 2, 1024)) AS c FROM d)), "
    "a AS (SELECT rid, c + i AS p, md5(substr(y, 2 * i + 1, 400)) AS h "
    "FROM (SELECT rid, c, y, unnest(range(0, least(1024, length(y) // 2 - 199))) AS i FROM e)), "
    "m AS (SELECT h FROM a GROUP BY h HAVING count(*) > 1), "
    "c AS (SELECT a.rid, a.p FROM a JOIN m ON m.h = a.h), "
    "o AS (SELECT rid, p, coalesce(p - lag(p) OVER (PARTITION BY rid ORDER BY p) > 200, true) AS fresh FROM c), "
    "k AS (SELECT rid, p, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY rid ORDER BY p) AS run FROM o), "
    "s AS (SELECT rid, run, min(p) AS lo, max(p) + 200 AS hi FROM k GROUP BY rid, run), "
    "f AS (SELECT rid, count(*) AS n, sum(hi - lo) AS removed, list(lo ORDER BY lo) AS los, list(hi ORDER BY lo) AS his FROM s GROUP BY rid) "
    "SELECT d.doc_id, CAST(length(d.x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(f.removed, 0) AS BIGINT) AS n_removed, coalesce(f.n, 0) AS n_spans, "
    "sha256(unhex(CASE WHEN f.n IS NULL THEN d.x ELSE array_to_string(list_transform(range(1, f.n + 2), "
    "lambda i: substr(d.x, 2 * coalesce(f.his[i - 1], 0) + 1, 2 * (coalesce(f.los[i], length(d.x) // 2) - coalesce(f.his[i - 1], 0)))), '') END)) AS kept_sha256 "
    "FROM d LEFT JOIN f ON f.rid = d.rid"
)

_SPELLING = (
    f"WITH RECURSIVE {_CRC_TABLE}, "
    "u AS (SELECT id, r, count(*) AS n FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, "
    f"unnest(regexp_extract_all({_lower('coalesce(text, ' + chr(39) * 2 + ')')}, '[A-Za-z\\x{{C0}}-\\x{{FF}}]{{5,}}')) AS r FROM documents) GROUP BY 1, 2), "
    f"h AS (SELECT r, n, {_crc32('(id || chr(58) || r)')} AS h FROM u, crc k), "
    "x AS (SELECT CASE WHEN h % 97 = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS w, n FROM h), "
    "v AS (SELECT w, CAST(sum(n) AS BIGINT) AS n FROM x WHERE length(w) >= 5 GROUP BY w HAVING sum(n) >= 3), "
    "q AS (SELECT w, i, substr(w, 1, i) || substr(w, i + 2) AS s FROM (SELECT w, unnest(range(0, length(w))) AS i FROM v)), "
    "e AS (SELECT a.w AS a, b.w AS b FROM q a JOIN q b ON a.s = b.s AND a.i = b.i AND a.w <> b.w "
    "UNION SELECT q.w, v.w FROM q JOIN v ON v.w = q.s UNION SELECT v.w, q.w FROM q JOIN v ON v.w = q.s), "
    "f AS (SELECT e.a AS w, count(*) AS n_near, arg_min(e.b, struct_pack(a := -v.n, b := hex(encode(e.b)))) AS f, max(v.n) AS fn FROM e JOIN v ON v.w = e.b GROUP BY 1), "
    "g AS (SELECT v.w, v.n, coalesce(f.n_near, 0) AS n_near, CASE WHEN f.fn >= 2 * v.n THEN f.f END AS f, CASE WHEN f.fn >= 2 * v.n THEN f.fn END AS fn "
    "FROM v LEFT JOIN f ON f.w = v.w), "
    "t(w, z) AS (SELECT w, w FROM g UNION ALL SELECT t.w, g.f FROM t JOIN g ON g.w = t.z WHERE g.f IS NOT NULL) "
    "SELECT g.w AS word, g.f AS form, t.z AS root, g.n, g.n_near, g.fn AS form_n FROM g JOIN t ON t.w = g.w "
    "JOIN g y ON y.w = t.z WHERE y.f IS NULL"
)


def _field(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"coalesce(octet_length(encode({text})) || ':' || {text}, '-')"


def _manifest(levels: int = 6) -> str:
    """``levels`` of 16 nodes a run hold 16 ** levels leaves of a source, and as many sources."""
    own = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    parts = [
        _CRC_TABLE,
        f"d AS (SELECT row_number() OVER () AS rid, doc_id, source, sha256({own} || {_field('text')}) AS h, "
        f"CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 5 = 0 THEN sha256({own} || {_field(_lower('text'))}) END AS changed FROM documents, crc k)",
        "l0 AS (SELECT rid, doc_id, source, h, changed, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h, rid) - 1 AS p, "
        "count(*) OVER (PARTITION BY source) AS c FROM d)",
        "a0 AS (SELECT source AS g, p, c, h FROM l0)",
    ]

    def grow(name: str) -> None:
        for i in range(levels):
            parts.append(
                f"{name}{i + 1} AS (SELECT g, p // 16 AS p, (any_value(c) + 15) // 16 AS c, sha256(string_agg(h, '' ORDER BY p)) AS h, "
                f"list(h ORDER BY p) AS kids FROM {name}{i} WHERE c > 1 GROUP BY g, p // 16)"
            )

    grow("a")
    tops = " UNION ALL ".join(f"SELECT g, h FROM a{i} WHERE c = 1" for i in range(levels + 1))
    parts.append(f"top AS ({tops})")
    parts.append("b0 AS (SELECT 0 AS g, row_number() OVER (ORDER BY g IS NOT NULL, encode(g)) - 1 AS p, count(*) OVER () AS c, h, g AS s FROM top)")
    grow("b")
    roots = " UNION ALL ".join(f"SELECT h FROM b{i} WHERE c = 1" for i in range(levels + 1))
    parts.append(f"root AS ({roots})")
    # the siblings on the way up, a pair of texts a level (both empty where there is no run)
    joins, ways = ["FROM l0 JOIN top ON top.g IS NOT DISTINCT FROM l0.source JOIN b0 ON b0.s IS NOT DISTINCT FROM l0.source, root"], []
    for name, place, group in (("a", "l0.p", "l0.source"), ("b", "b0.p", "0")):
        for i in range(1, levels + 1):
            joins.append(f"LEFT JOIN {name}{i} ON {name}{i}.g IS NOT DISTINCT FROM {group} AND {name}{i}.p = {place} // {16**i}")
            at = f"CAST({place} // {16 ** (i - 1)} % 16 AS BIGINT)"
            ways.append(
                f"CASE WHEN {name}{i}.h IS NOT NULL THEN struct_pack(l := array_to_string({name}{i}.kids[1:{at}], ''), "
                f"r := array_to_string({name}{i}.kids[{at} + 2:], '')) END"
            )
    parts.append(
        f"way AS (SELECT l0.doc_id, l0.h AS leaf, top.h AS subroot, root.h AS root, coalesce(l0.changed, l0.h) AS own, "
        f"list_filter([{', '.join(ways)}], lambda x: x IS NOT NULL) AS way {' '.join([joins[0].replace(', root', ' CROSS JOIN root'), *joins[1:]])})"
    )
    folded = "own"
    for i in range(1, 2 * levels + 1):
        parts.append(
            f"f{i} AS (SELECT * REPLACE (CASE WHEN len(way) >= {i} THEN sha256(way[{i}].l || own || way[{i}].r) ELSE own END AS own) FROM {'way' if i == 1 else f'f{i - 1}'})"
        )
    return (
        f"WITH RECURSIVE {', '.join(parts)} SELECT doc_id, leaf, subroot, root, "
        "sha256(array_to_string(list_transform(way, lambda x: x.l || x.r), '')) AS proof_sha256, "
        f"{folded} AS folded_root, {folded} = root AS verified FROM f{2 * levels}"
    )


ORACLE_SQL: dict[str, str] = {
    "op3_secret_scan": _secrets(),
    "op9_minhash": _NEAR,
    "op10_repeats": _REPEATS,
    "op11_spelling": _SPELLING,
    "op13_manifest": _manifest(),
}
