"""Op 3 in DuckDB's SQL: the same steps written out, for tables that one machine holds.

The loop until convergence is unrolled: ROUNDS steps, of which those after the last
improvement have no rows to work on."""

from __future__ import annotations

from tessera.llm import quality as q

ROUNDS = 14
_D = range(4)
_PAIRS = [(i, j) for i in _D for j in range(i + 1)]
_SUMS = ["n", *[f"s{i}" for i in _D], *[f"q{i}{j}" for i, j in _PAIRS]]
_MODEL = [*[f"m{i}" for i in _D], *[f"l{i}{j}" for i, j in _PAIRS]]
_KEYS = "lang, source, start"
_FLOORS = [v for _, v in q.FEATURES.values()]
_MOMENTS = ", ".join(["CAST(count(*) AS DOUBLE) AS n", *[f"sum(f{i}) AS s{i}" for i in _D], *[f"sum(f{i} * f{j}) AS q{i}{j}" for i, j in _PAIRS]])
_ADDED = ", ".join(f"sum({c}) AS {c}" for c in _SUMS)
_SPACE = r"[\x20\x09-\x0D]+"


def _same(a: str, b: str, keys: str = _KEYS) -> str:
    return " AND ".join(f"{a}.{k} IS NOT DISTINCT FROM {b}.{k}" for k in keys.split(", "))


def _counts() -> str:
    return rf"""t0 AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
t1 AS MATERIALIZED (SELECT *, list_filter(regexp_split_to_array(t, '{_SPACE}'), lambda x: x <> '') AS w,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t0),
w3 AS MATERIALIZED (SELECT r, i, w[i : i + 2] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM t1 WHERE len(w) > 3)),
rp AS (SELECT w3.r, count(DISTINCT w3.i + k.k) AS n FROM w3 JOIN (SELECT r, g FROM w3 GROUP BY r, g HAVING count(*) > 1) x ON x.r = w3.r AND x.g = w3.g, (SELECT unnest([0, 1, 2]) AS k) k GROUP BY w3.r),
c0 AS MATERIALIZED (SELECT t1.r, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(rp.n, 0) AS n_repeat_words
  FROM t1 LEFT JOIN rp ON rp.r = t1.r),
c1 AS MATERIALIZED (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, ln(CAST(greatest(word_chars, 1) AS DOUBLE) / greatest(n_words, 1)) AS f0,
  sqrt(CAST(n_symbols AS DOUBLE) / greatest(word_chars, 1)) AS f1, sqrt(CAST(n_repeat_words AS DOUBLE) / greatest(n_words, 1)) AS f2, sqrt(CAST(n_dup_lines AS DOUBLE) / greatest(n_words, 1)) AS f3 FROM c0),
v AS MATERIALIZED (SELECT * FROM c1 WHERE NOT base_failed)"""


def _estimate(name: str, sums: str, keys: str, factor: float) -> list[str]:
    """Tables that end in `name`: sums with means, factor and logdet."""
    own = [f"{keys}", *_SUMS]
    out = [f"{name}_a AS (SELECT {', '.join(own)}, {', '.join(f's{i} / n AS m{i}' for i in _D)} FROM {sums})"]
    cov = ", ".join(f"{factor!r} * (q{i}{j} / n - m{i} * m{j}) + {_FLOORS[i] ** 2 if i == j else 0.0!r} AS c{i}{j}" for i, j in _PAIRS)
    out.append(f"{name}_b AS (SELECT *, {cov} FROM {name}_a)")
    at = f"{name}_b"
    for j in _D:
        done = lambda a, b: "".join(f" - l{a}{k} * l{b}{k}" for k in range(j))  # noqa: B023, E731
        out.append(f"{name}_d{j} AS (SELECT *, sqrt(greatest(c{j}{j}{done(j, j)}, 1e-9)) AS l{j}{j} FROM {at})")
        at = f"{name}_d{j}"
        if below := [f"(c{i}{j}{done(i, j)}) / l{j}{j} AS l{i}{j}" for i in range(j + 1, 4)]:
            out.append(f"{name}_e{j} AS (SELECT *, {', '.join(below)} FROM {at})")
            at = f"{name}_e{j}"
    logdet = " + ".join(f"2 * ln(l{i}{i})" for i in _D)
    out.append(f"{name} AS MATERIALIZED (SELECT {', '.join([*own, *_MODEL])}, {logdet} AS logdet FROM {at})")
    return out


def _distance(model: str, row: str, name: str, tables: str, keep: str) -> list[str]:
    """Tables that end in `name`: keep and d, the squared distance of each pair of tables."""
    out, at = [f"{name}_0 AS (SELECT {keep}, {', '.join(f'{model}.{c}' for c in _MODEL)} FROM {tables})"], f"{name}_0"
    for i in _D:
        rest = "".join(f" - l{i}{k} * y{k}" for k in range(i))
        out.append(f"{name}_{i + 1} AS (SELECT *, (f{i} - m{i}{rest}) / l{i}{i} AS y{i} FROM {at})")
        at = f"{name}_{i + 1}"
    out.append(f"{name} AS MATERIALIZED (SELECT * EXCLUDE ({', '.join([*_MODEL, *[f'y{i}' for i in _D]])}), {' + '.join(f'y{i} * y{i}' for i in _D)} AS d FROM {at})")
    return out


def _step(name: str, models: str) -> list[str]:
    """Tables that end in `name`: the half-sets of the models."""
    edge = lambda b: f"(pow(2.0, ({b}) / 4) - {q.LOW!r})"
    out = _distance("m", "v", f"{name}_f", f"v JOIN {models} m ON {_same('v', 'm', 'lang, source')}", "v.lang, v.source, m.start, f0, f1, f2, f3")
    out += [
        f"{name}_g AS MATERIALIZED (SELECT *, CAST(least(greatest(floor(4 * log2(d + {q.LOW!r})), {q.FIRST}), {q.LAST}) AS INTEGER) AS bin FROM {name}_f)",
        f"{name}_h AS (SELECT {_KEYS}, bin, {_MOMENTS} FROM {name}_g GROUP BY {_KEYS}, bin)",
        f"{name}_i AS MATERIALIZED (SELECT *, sum(n) OVER (PARTITION BY {_KEYS} ORDER BY bin) AS upto, ceil({q.SHARE!r} * sum(n) OVER (PARTITION BY {_KEYS})) AS half FROM {name}_h)",
        f"{name}_j AS (SELECT {_KEYS}, bin AS edge, half - upto + n AS need FROM {name}_i WHERE upto > half AND upto - n < half)",
        f"""{name}_k AS (SELECT g.*, need, CAST(least(greatest(floor({q.FINE} * (d - {edge('edge')}) / ({edge('edge + 1')} - {edge('edge')})), 0), {q.FINE}) AS INTEGER) AS fine
  FROM {name}_g g JOIN {name}_j j ON {_same('g', 'j')} AND bin = edge)""",
        f"{name}_l AS (SELECT {_KEYS}, need, fine, {_MOMENTS} FROM {name}_k GROUP BY {_KEYS}, need, fine)",
        f"{name}_m AS (SELECT *, sum(n) OVER (PARTITION BY {_KEYS} ORDER BY fine) AS upto FROM {name}_l)",
        f"{name}_n AS (SELECT *, least(1.0, greatest(0.0, (need - upto + n) / n)) AS weight FROM {name}_m)",
        f"""{name}_o AS (SELECT {_KEYS}, {', '.join(_SUMS)} FROM {name}_i WHERE upto <= half
  UNION ALL SELECT {_KEYS}, {', '.join(f'weight * {c}' for c in _SUMS)} FROM {name}_n)""",
        f"{name}_p AS (SELECT {_KEYS}, {_ADDED} FROM {name}_o GROUP BY {_KEYS})",
    ]
    return out + _estimate(name, f"{name}_p", _KEYS, q.CONSISTENCY)


def _starts() -> list[str]:
    cells = ", ".join(f"{{'k': {i}, 'bin': CAST(least(floor(f{i} * {16 if i == 0 else 64}), 63) AS INTEGER)}}" for i in _D)
    quart = lambda p: f"min(CASE WHEN upto >= {p} * total THEN (bin + 0.5) / (CASE WHEN k = 0 THEN 16 ELSE 64 END) END)"
    middle = ", ".join(f"max(CASE WHEN k = {i} THEN b END) AS s{i}" for i in _D)
    width = ", ".join(f"max(CASE WHEN k = {i} THEN pow((c - a) / 1.349, 2) END) AS v{i}" for i in _D)
    moments = ", ".join(f"s{i} * s{j}{f' + v{i}' if i == j else ''} AS q{i}{j}" for i, j in _PAIRS)
    draws = ", ".join(f"CAST(('0x' || substr(md5('{k}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)) AS BIGINT) / 4294967296.0" for k in range(q.RANDOM))
    return [
        f"whole AS MATERIALIZED (SELECT lang, source, {_MOMENTS} FROM v GROUP BY lang, source)",
        f"h0 AS (SELECT lang, source, c.k AS k, c.bin AS bin, count(*) AS n FROM (SELECT lang, source, unnest([{cells}]) AS c FROM v) GROUP BY ALL)",
        "h1 AS (SELECT *, sum(n) OVER (PARTITION BY lang, source, k ORDER BY bin) AS upto, sum(n) OVER (PARTITION BY lang, source, k) AS total FROM h0)",
        f"h2 AS (SELECT lang, source, k, {quart(0.25)} AS a, {quart(0.5)} AS b, {quart(0.75)} AS c FROM h1 GROUP BY lang, source, k)",
        f"h3 AS (SELECT lang, source, {middle}, {width} FROM h2 GROUP BY lang, source)",
        f"d0 AS (SELECT v.lang, v.source, f0, f1, f2, f3, whole.n AS size, [{draws}] AS x FROM v JOIN whole ON {_same('v', 'whole', 'lang, source')})",
        "d1 AS (SELECT lang, source, f0, f1, f2, f3, size, unnest(x) AS x, generate_subscripts(x, 1) + 1 AS start FROM d0)",
        f"""s_s AS (SELECT lang, source, 0 AS start, {', '.join(_SUMS)} FROM whole
  UNION ALL SELECT lang, source, 1, 1.0, {', '.join(f's{i}' for i in _D)}, {moments.replace(' AS q', ' AS q')} FROM h3
  UNION ALL SELECT lang, source, start, {_MOMENTS} FROM d1 WHERE x * size < {q.DRAWN} GROUP BY lang, source, start)""",
        *_estimate("s", "s_s", _KEYS, 1.0),
    ]


def oracle_sql() -> str:
    parts = [_counts(), *_starts()]
    at = "s"
    for k in range(q.TRIAL):
        parts += _step(f"a{k}", at)
        at = f"a{k}"
    own = ", ".join([*_SUMS, *_MODEL, "logdet"])
    parts.append(f"b0 AS MATERIALIZED (SELECT {_KEYS}, {own}, true AS improved FROM (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY logdet, start) AS k FROM {at}) WHERE k <= {q.BEST})")
    for r in range(ROUNDS):
        parts.append(f"i{r} AS (SELECT * FROM b{r} WHERE improved)")
        parts += _step(f"n{r}", f"i{r}")
        better = f"coalesce(y.logdet < x.logdet - {q.LEAST_GAIN!r}, false)"
        newer = ", ".join(f"CASE WHEN {better} THEN y.{c} ELSE x.{c} END AS {c}" for c in [*_SUMS, *_MODEL, "logdet"])
        parts.append(f"b{r + 1} AS MATERIALIZED (SELECT x.lang, x.source, x.start, {newer}, {better} AS improved FROM b{r} x LEFT JOIN n{r} y ON {_same('x', 'y')})")
    drawn = lambda own, wide: ", ".join(f"{own}.{c} + {q.PRIOR_ROWS} * {wide}.{c} / {wide}.n AS {c}" for c in _SUMS)
    parts += [
        f"half AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY logdet, start) AS k FROM b{ROUNDS}) WHERE k = 1)",
        f"every AS (SELECT {_ADDED} FROM half)",
        f"tongue AS (SELECT x.lang, {drawn('x', 'every')} FROM (SELECT lang, {_ADDED} FROM half GROUP BY lang) x, every)",
        f"fused AS (SELECT x.lang, x.source, {drawn('x', 'y')} FROM half x JOIN tongue y ON x.lang IS NOT DISTINCT FROM y.lang)",
        *_estimate("final", "fused", "lang, source", q.CONSISTENCY),
        *_distance("m", "v", "far", f"v JOIN final m ON {_same('v', 'm', 'lang, source')}", "v.r, f0, f1, f2, f3"),
    ]
    body = ",\n".join(parts)
    return f"""WITH {body}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(d <= {q.CUT!r}, true) AS kept
FROM c1 LEFT JOIN far ON far.r = c1.r"""
