"""Personal data by candidates and boosted trees, as SQL expressions alone.

Four base kinds follow fixed rules. Beside them, generators of high recall propose spans
that may overlap; boosted trees score each by its format and context, and a threshold
for each generator selects what is added. The trees are fitted on the candidates of all
documents, with base matches and what follows a cue word (token, tel, account) as labels;
the driver gets one row with a count for all candidates that look alike, and features are
small numbers, so these are few. All rows are then scored inside the plan.

A text is scanned by a generator only if it holds a character that every match needs.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladewerk.llm.boosting import as_sql, fit_trees, predict

#: Fixed rules: kind, pattern (written so that Java neither recurses nor rescans), what a
#: text must hold, and what a match must satisfy (over t, its text, and d, its digits).
_LOCAL = "A-Za-z0-9._%+-"
BASE = (
    ("email", rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++", "@", "true"),
    ("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "[0-9]", r"t RLIKE '\\A(?:0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])(?:\\.(?!\\z)|\\z)){4}\\z'"),
    ("card", r"[0-9](?:[\x20-]?[0-9])++", "[0-9]", "length(d) BETWEEN 12 AND 19 AND luhn_check(d)"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "[0-9]", "length(d) BETWEEN 9 AND 15"),
)
#: Generators: what they propose is mostly not personal.
GENERATORS = (
    ("contact", r"(?:\G|(?<!\S))[^\s@]++@[^\s@]+", "@"),
    ("number", r"[+(]?[0-9](?:[\x20().-]{0,2}[0-9]){6,}+", "[0-9]"),
    ("token", r"(?<![A-Za-z0-9])(?=[A-Za-z]*[0-9])[A-Za-z0-9]{16,}+", "[0-9]"),
)
FEATURES = {
    "n": "least(length(t), 64)", "digits": "least(length(d), 32)", "groups": "least(size(split(t, '[^0-9]+')), 16)", "plus": "IF(startswith(t, '+'), 1, 0)",
    "dots": "least(length(t) - length(replace(t, '.', '')), 8)", "parens": "IF(contains(t, '('), 1, 0)", "dashes": "least(length(t) - length(replace(t, '-', '')), 8)",
    "luhn": "IF(length(d) BETWEEN 12 AND 19 AND luhn_check(d), 1, 0)", "quad": r"IF(t RLIKE '\\A[0-9]{1,3}(?:\\.[0-9]{1,3}){3}\\z', 1, 0)",
    "mail": r"IF(t RLIKE '[A-Za-z0-9]@[A-Za-z0-9-]+\\.[A-Za-z]', 1, 0)", "hex": r"IF(t RLIKE '(?i)\\A[0-9a-f]+\\z', 1, 0)",
    "quoted": r"IF(before RLIKE '[\"\'=:]\\s?\\z', 1, 0)", "glued": r"IF(before RLIKE '[A-Za-z0-9]\\z' OR after RLIKE '\\A[A-Za-z0-9]', 1, 0)",
    "cue": r"IF(before RLIKE '(?i)(?<![a-z])(?:tel|phone|call|fax|mobile|mail|contact|card|visa|iban|account|ssn|(?:api)?key|token|secret|password)[^A-Za-z0-9]{1,6}\\z', 1, 0)",
}
CONTEXT = 24
#: Matches that are put together at once.
BLOCK = 256
#: The share of a generator's selected candidates that must be true.
PRECISION = 0.98


def _quote(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _by_blocks(items: str, value: str, joined: str, out: str) -> str:
    """SQL: what `out` makes of each block b of BLOCK items, one after another, where o is
    what `joined` makes of the values v of the blocks before and the starts c till then.

    An array that grows by one item at a time is copied each time; so it grows within a
    block only, and a text of very many matches takes little more than its share."""
    blocks = f"transform(sequence(0, CAST((size(z) - 1) / {BLOCK} AS INT)), i -> slice(z, i * {BLOCK} + 1, {BLOCK}))"
    starts = f"aggregate(transform(w, b -> {value}), array(0L), (c, v) -> concat(c, array({joined})))"
    each = f"flatten(zip_with(w, slice({starts}, 1, size(w)), (b, o) -> {out}))"
    return f"get(transform(array({items}), z -> get(transform(array({blocks}), w -> {each}), 0)), 0)"


def _matches(pattern: str, needs: str, kind: str, number: int, keep: str) -> str:
    """SQL: the leftmost matches that do not overlap, as an array of (s, k, e, kind, t, d)
    with code points s (from 0) and e (exclusive). What lies between matches and the
    matches add up to the places."""
    q = _quote(pattern)
    size = "length(x.p) + coalesce(length(x.m), 0)"
    pairs = f"zip_with(regexp_extract_all(text, {q}, 0), split(text, {q}, -1), (m, p) -> named_struct('m', m, 'p', p))"
    spans = f"""aggregate(b, named_struct('at', o, 'out', CAST(array() AS ARRAY<STRUCT<s: BIGINT, e: BIGINT, t: STRING>>)),
        (a, x) -> named_struct('at', a.at + {size},
            'out', IF(x.m IS NULL, a.out, concat(a.out, array(named_struct('s', a.at + length(x.p), 'e', a.at + length(x.p) + length(x.m), 't', x.m))))),
        a -> a.out)"""
    steps = _by_blocks(pairs, f"aggregate(b, 0L, (a, x) -> a + {size})", "element_at(c, -1) + v", spans)
    full = f"transform({steps}, x -> named_struct('s', x.s, 'k', {number}, 'e', x.e, 'kind', '{kind}', 't', x.t, 'd', regexp_replace(x.t, '[^0-9]', '')))"
    kept = keep.replace("t ", "x.t ").replace("(d)", "(x.d)")
    test = f"filter({full}, x -> {kept})" if keep != "true" else full
    guard = f"contains(text, '{needs}')" if len(needs) == 1 else f"text RLIKE {_quote(needs)}"
    empty = "CAST(array() AS ARRAY<STRUCT<s: BIGINT, k: INT, e: BIGINT, kind: STRING, t: STRING, d: STRING>>)"
    return f"IF({guard}, {test}, {empty})"


def base_spans() -> Column:
    """Over text: all base spans by start, then kind as listed."""
    parts = [_matches(p, needs, kind, i, keep) for i, (kind, p, needs, keep) in enumerate(BASE)]
    return F.expr(f"sort_array(concat({', '.join(parts)}))")


def candidates() -> Column:
    """Over text: all that the generators propose, with the text around each."""
    parts = [_matches(p, needs, kind, len(BASE) + i, "true") for i, (kind, p, needs) in enumerate(GENERATORS)]
    around = f"substring(text, CAST(greatest(1, x.s - {CONTEXT - 1}) AS INT), CAST(least(x.s, {CONTEXT}) AS INT)) AS before, substring(text, CAST(x.e + 1 AS INT), 2) AS after"
    names = "'s', x.s, 'k', x.k, 'e', x.e, 'kind', x.kind, 't', x.t, 'd', x.d, 'before', " + around.replace(" AS before, ", ", 'after', ").replace(" AS after", "")
    return F.expr(f"transform(concat({', '.join(parts)}), x -> named_struct({names}))")


def _feature(name: str, row: str) -> str:
    return re.sub(r"(?<![\w'.])(t|d|before|after)(?![\w'.])", rf"{row}.\1", FEATURES[name])


def fit(docs: DataFrame) -> tuple[str, dict[str, float]]:
    """The trees as SQL over a candidate x, and each generator's threshold (over 1: none).

    A candidate counts as personal if a base span lies inside it or holds it, or if a cue
    word comes right before it. What only the cue word labels is learned twice, with that
    feature and without it, so that the format counts too."""
    own = docs.select(F.coalesce("text", F.lit("")).alias("text")).where("text RLIKE '[0-9@]'").select(base_spans().alias("base"), candidates().alias("proposed"))
    names = list(FEATURES)
    true = "exists(base, b -> b.s < x.e AND x.s < b.e AND (b.s >= x.s AND b.e <= x.e OR x.s >= b.s AND x.e <= b.e))"
    cued = f"{_feature('cue', 'x')} = 1 AND {_feature('glued', 'x')} = 0"
    flat = own.selectExpr("base", "explode(proposed) AS x").selectExpr("x.kind AS kind", f"IF({true}, 1, 0) AS based", f"IF({true} OR {cued}, 1, 0) AS y", *[f"CAST({_feature(f, 'x')} AS DOUBLE) AS {f}" for f in names])
    # Candidates that look alike are one row with a count, so the driver gets few.
    found = flat.groupBy("kind", "based", "y", *names).count().collect()
    found = [r.asDict() for r in sorted(found, key=lambda r: tuple(map(str, r)))]
    found += [{**r, "cue": 0.0} for r in found if r["y"] > r["based"]]
    x = np.array([[r[f] for f in names] for r in found]).reshape(-1, len(names))
    y = np.array([float(r["y"]) for r in found])
    n = np.array([r["count"] for r in found], np.int64)
    kinds = np.array([r["kind"] for r in found], object)
    # Every third candidate, in this order, sets the thresholds.
    ends = np.cumsum(n)
    apart = (ends + 2) // 3 - (ends - n + 2) // 3
    learn, check = n > apart, apart > 0
    model = fit_trees(x[learn], y[learn], (n - apart)[learn])
    score = predict(model, x)
    limits = {}
    for kind, _, _ in GENERATORS:
        own = check & (kinds == kind)
        own_score, own_y, own_n = score[own], y[own], apart[own]
        fine = [t / 100 for t in range(50, 100) if (own_score >= t / 100).any() and np.average(own_y[own_score >= t / 100], weights=own_n[own_score >= t / 100]) >= PRECISION]
        limits[kind] = max(0.9, fine[0]) if fine else 2.0
    columns = [f"CAST({_feature(f, 'x')} AS DOUBLE)" for f in names]
    return as_sql(model, columns), limits


def find_pii(docs: DataFrame) -> DataFrame:
    """docs with base (spans of the base kinds) and spans (these and the added ones), each
    an array of (s, k, e, kind, t, d): code points from s to e, kind number and name, the
    text and its digits, by start and kind.

    An added span does not overlap a base one. A null text has no spans. Columns named base
    or spans are replaced. Each row gets its result, repeated ones too; an empty table gives
    no rows.
    """
    score, limits = fit(docs)
    limit = "CASE x.kind " + " ".join(f"WHEN '{k}' THEN {v}D" for k, v in limits.items()) + " END"
    # The columns of docs, whatever their names, ride along in one.
    names = [c for c in docs.columns if c not in ("base", "spans")]
    found = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("own"), F.coalesce("text", F.lit("")).alias("text"))
    found = found.withColumn("base", base_spans()).withColumn("proposed", candidates())
    added = f"""transform(filter(proposed, x -> NOT exists(base, b -> b.s < x.e AND x.s < b.e) AND {score} >= {limit}),
        x -> named_struct('s', x.s, 'k', x.k, 'e', x.e, 'kind', x.kind, 't', x.t, 'd', x.d))"""
    found = found.withColumn("spans", F.expr(f"IF(size(proposed) = 0, base, sort_array(concat(base, {added})))"))
    return found.select("own.*", "base", "spans")


def span_text(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    return F.expr(f"array_join(transform({spans}, x -> concat_ws(':', x.kind, x.s, x.e)), ',')")


def redacted() -> Column:
    """Over text and spans: the text with each span, or run of spans that overlap, replaced
    by the kind of its first in brackets; null stays null."""
    pieces = """aggregate(b, named_struct('at', o, 'out', CAST(array() AS ARRAY<STRING>)),
        (a, x) -> IF(x.s >= a.at,
            named_struct('at', x.e, 'out', concat(a.out, array(substring(text, CAST(a.at + 1 AS INT), CAST(x.s - a.at AS INT)), concat('[', upper(x.kind), ']')))),
            named_struct('at', greatest(a.at, x.e), 'out', a.out)),
        a -> a.out)"""
    done = _by_blocks("spans", "array_max(transform(b, x -> x.e))", "greatest(element_at(c, -1), v)", pieces)
    rest = "array(substring(text, CAST(array_max(transform(spans, x -> x.e)) + 1 AS INT)))"
    return F.expr(f"IF(size(spans) = 0, text, array_join(concat({done}, {rest}), ''))")
