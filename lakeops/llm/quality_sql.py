"""DuckDB SQL for the quality verdicts: the statistics with lists and unnested
windows, the concentration steps as a chain of common table expressions."""

from __future__ import annotations

from . import quality as q

_P = range(q.P)
_GROUP = "a.lang IS NOT DISTINCT FROM b.lang AND a.source IS NOT DISTINCT FROM b.source"

_STATISTICS = r"""
texts AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
parts AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
                 list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM texts),
windows AS (SELECT rid, i, concat_ws(' ', w[i], w[i + 1], w[i + 2]) AS three
            FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM parts)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, three) AS n FROM windows) WHERE n > 1),
covered AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM twice) GROUP BY rid),
base AS (SELECT rid, doc_id, lang, source, len(w)::BIGINT AS n_words,
                coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
                len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
                (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines,
                coalesce(covered.n, 0)::BIGINT AS n_repeat_words
         FROM parts LEFT JOIN covered USING (rid)),
stats AS (SELECT *, n_words < {min_words} OR 100 * n_repeat_words > {max_repeated} * n_words AS base_failed,
                 ln(greatest(word_chars, 1) / greatest(n_words, 1)) AS x0,
                 ln(1 + 100.0::DOUBLE * n_symbols / greatest(word_chars, 1)) AS x1,
                 ln(1 + 100.0::DOUBLE * n_dup_lines / greatest(n_lines, 1)) AS x2,
                 ln(1 + 100.0::DOUBLE * n_repeat_words / greatest(n_words, 1)) AS x3 FROM base),
good AS (SELECT * FROM stats WHERE NOT base_failed)"""


def _factor(source: str, consistency: float) -> str:
    """The Cholesky factor, one entry after the other."""
    for j in _P:
        for i in range(j, q.P):
            c = f"(c{i}{j} * {consistency!r}" + (f" + {q.FLOORS[i] ** 2!r}" if i == j else "")
            c += "".join(f" - l{i}{k} * l{j}{k}" for k in range(j)) + ")"
            source = f"SELECT *, {f'sqrt({c})' if i == j else f'{c} / l{j}{j}'} AS l{i}{j} FROM ({source})"
    return f"SELECT *, {' + '.join(f'ln(l{i}{i})' for i in _P)} AS logdet FROM ({source})"


def _moments(n: str = "n") -> str:
    means = ", ".join(f"s{i} / {n} AS m{i}" for i in _P)
    covs = ", ".join(f"s{i}{j} / {n} - (s{i} / {n}) * (s{j} / {n}) AS c{i}{j}" if i != j else
                     f"greatest(s{i}{j} / {n} - (s{i} / {n}) * (s{j} / {n}), 0) AS c{i}{j}"
                     for i in _P for j in range(i + 1))
    return f"{means}, {covs}"


_SUMS = ", ".join(["count(*) AS n", *(f"sum(x{i}) AS s{i}" for i in _P),
                   *(f"sum(x{i} * x{j}) AS s{i}{j}" for i in _P for j in range(i + 1))])


def _with_distance(rows: str, params: str) -> str:
    out = f"SELECT a.*, b.* EXCLUDE (lang, source) FROM {rows} a LEFT JOIN {params} b ON {_GROUP}"
    for i in _P:
        less = "".join(f" - l{i}{k} * z{k}" for k in range(i))
        out = f"SELECT *, (x{i} - m{i}{less}) / l{i}{i} AS z{i} FROM ({out})"
    return f"SELECT *, {' + '.join(f'z{i} * z{i}' for i in _P)} AS d2 FROM ({out})"


def statement() -> str:
    medians = ", ".join(f"(list_sort(list(floor(x{i} / {q.FLOORS[i] / 8!r})))[((count(*) + 1) // 2)::INT] + 0.5)"
                        f" * {q.FLOORS[i] / 8!r} AS m{i}" for i in _P)
    zeros = ", ".join(f"0.0::DOUBLE AS c{i}{j}" for i in _P for j in range(i + 1))
    ctes = [_STATISTICS.format(min_words=q.MIN_WORDS, max_repeated=q.MAX_REPEATED),
            f"""starts AS (SELECT lang, source, 0 AS start, {medians}, {zeros} FROM good GROUP BY lang, source
                UNION ALL SELECT lang, source, 1 AS start, {_moments()}
                FROM (SELECT lang, source, {_SUMS} FROM good GROUP BY lang, source))""",
            f"p0 AS MATERIALIZED ({_factor('SELECT * FROM starts', 1.0)})"]
    names = ["n", *(f"s{i}" for i in _P), *(f"s{i}{j}" for i in _P for j in range(i + 1))]
    for k in range(q.STEPS):
        upto = ", ".join(f"sum({c}) OVER (PARTITION BY lang, source, start ORDER BY bin) AS {c}" for c in names)
        cells = f"""SELECT lang, source, start, floor(ln(1 + d2) * {q.BIN}) AS bin, {_SUMS}
                    FROM ({_with_distance('good', f'p{k}')}) GROUP BY ALL"""
        ctes += [f"""r{k} AS (SELECT lang, source, start, bin, {upto},
                    sum(n) OVER (PARTITION BY lang, source, start) AS everything FROM ({cells}))""",
                 f"""t{k} AS (SELECT * FROM r{k} WHERE n >= {q.SHARE} * everything
                    QUALIFY row_number() OVER (PARTITION BY lang, source, start ORDER BY bin) = 1)""",
                 f"""p{k + 1} AS MATERIALIZED ({_factor(f'SELECT lang, source, start, {_moments()} FROM t{k}', q.FACTOR)})"""]
    ctes.append(f"""final AS (SELECT * FROM p{q.STEPS}
        QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY logdet, start) = 1)""")
    return f"""WITH {", ".join(ctes)}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(d2 <= {q.CUT!r}, FALSE) AS kept
FROM ({_with_distance('stats', 'final')})"""
