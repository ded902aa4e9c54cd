"""The registered queries again, as SQL over the given tables.

Lines are rows here (one per confirmation and position) where the Spark jobs use
arrays, and amounts are whole cents, so the two sides share no expressions.
"""

from __future__ import annotations

from ladewerk.functions import surface as S
from ladewerk.operators import generate as G
from ladewerk.plans import tables as B
from ladewerk.schema import CATEGORIES, INSTRUCTION, LINE_FIELDS, UNITS

_SPAN = 1 << 32


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _draw(h: str, k: int) -> str:
    return f"('0x' || substr({h}, {8 * k + 1}, 8))::BIGINT"


def _chance(d: str, permille) -> str:
    return f"({d} * 1000 < ({permille}) * {_SPAN})"


def _choose(options: list[str], k: str) -> str:
    if len(options) == 1:
        return options[0]
    arms = " ".join(f"WHEN {i} THEN {o}" for i, o in enumerate(options[:-1]))
    return f"CASE {k} {arms} ELSE {options[-1]} END"


def _choose_text(options: list[str], k: str) -> str:
    return _choose([_q(o) for o in options], k)


def _pick(d: str, density: str, clean: list[str], short: list[str]) -> str:
    return (
        f"CASE WHEN {_chance(d, density)} THEN {_choose(short, f'(({d} >> 4) % {len(short)})')} "
        f"ELSE {_choose(clean, f'(({d} >> 4) % {len(clean)})')} END"
    )


def _grouped(n: str) -> str:
    return f"format('{{:,}}', ({n})::BIGINT)"


def _money(cents: str) -> str:
    return f"({_grouped(f'{cents} // 100')} || '.' || lpad(({cents} % 100)::VARCHAR, 2, '0'))"


def _number(cents: str) -> str:
    return (
        f"CASE WHEN {cents} % 100 = 0 THEN ({cents} // 100)::VARCHAR "
        f"WHEN {cents} % 10 = 0 THEN ({cents} // 100) || '.' || (({cents} % 100) // 10) "
        f"ELSE ({cents} // 100) || '.' || lpad(({cents} % 100)::VARCHAR, 2, '0') END"
    )


def _line_json() -> str:
    text = lambda f: f"'\"{f}\": \"' || {f} || '\"'"
    plain = lambda f: f"'\"{f}\": ' || {f}"
    parts = []
    for f in LINE_FIELDS:
        if f in ("origin", "destination", "unit", "leg", "reference"):
            parts.append(text(f))
        elif f == "rate":
            parts.append(f"'\"rate\": ' || {_number('rate_cents')}")
        else:
            parts.append(plain(f))
    return "'{' || concat_ws(', ', " + ", ".join(parts) + ") || '}'"


LINE_JSON = _line_json()


def _list_json(order: str = "i", value: str = "lj") -> str:
    return f"'[' || coalesce(string_agg({value}, ', ' ORDER BY {order}), '') || ']'"


# --- wording ----------------------------------------------------------------
def _filled(form: str, parts: dict[str, str]) -> str:
    pieces = [x for text, name in S.form_parts(form) for x in (_q(text) if text else None, parts.get(name)) if x]
    return "(" + " || ".join(pieces) + ")" if pieces else "''"


def _phrase(d: list[str], density: str) -> str:
    """A line's wording; its columns are in scope."""
    month = "([" + ", ".join(_q(m) for m in S.MONTHS) + "])[pickup_month]"
    parts = {
        "origin": "origin", "destination": "destination", "pounds": "weight::VARCHAR",
        "grouped": _grouped("weight"), "month": month, "mon": f"left({month}, 3)",
        "m": "pickup_month", "day": "pickup_day", "year": "pickup_year",
        "rate": _money("rate_cents"), "charge": f"{_grouped('accessorial')} || '.00'",
        "kind": f"({_choose_text(S.CHARGE_KINDS, f'({d[7]} % {len(S.CHARGE_KINDS)})')})",
    }

    def worded(kind: str, k: int) -> str:
        plain, short = ([_filled(f, parts) for f in forms] for forms in S.WORDING[kind])
        return _pick(d[k], density, plain, short)

    units = " ".join(
        f"WHEN {_q(u)} THEN {_pick(d[1], density, [_q(u)], [_q(w) for w in short])}"
        for u, short in S.UNIT_SHORT.items()
    )
    both, one = "origin IS NOT NULL AND destination IS NOT NULL", "origin IS NOT NULL"
    return f"""concat_ws('; ',
      (CASE leg WHEN 'pickup' THEN {worded('pickup', 0)} ELSE {worded('delivery', 0)} END)
        || ' ' || quantity || ' ' || CASE unit {units} END,
      CASE WHEN {both} THEN {worded('lane', 2)} WHEN {one} THEN {worded('start', 2)}
           WHEN destination IS NOT NULL THEN {worded('end', 2)} END,
      CASE WHEN weight IS NOT NULL THEN {worded('weight', 3)} END,
      CASE WHEN pickup_month IS NULL THEN NULL WHEN pickup_day IS NULL THEN {worded('month', 4)}
           WHEN pickup_year IS NULL THEN {worded('month_day', 4)} ELSE {worded('full_date', 4)} END,
      {worded('rate', 5)}, CASE WHEN accessorial IS NOT NULL THEN {worded('charge', 6)} END)"""


def _density(style: str = "style") -> str:
    arms = " ".join(f"WHEN {_q(s)} THEN {p * 10}" for s, p in G.ABBREV_PERCENT.items())
    return f"CASE {style} {arms} END"


def _shaped(name: str, parts: dict[str, str]) -> str:
    text, stated = (_filled(f, parts) for f in S.SHAPES[name])
    return f"{text} || coalesce({stated}, '')"


def _message(r6: str, r7: str) -> str:
    """From one row per confirmation: style, reference, first phrase and `stops`."""
    parts = {
        "carrier": _choose_text(S.CARRIERS, f"({r6} % {len(S.CARRIERS)})"),
        "commodity": _choose_text(S.COMMODITIES, f"({r7} % {len(S.COMMODITIES)})"),
        "phrase": "first_phrase",
        "reference": "reference",
    }
    parts = {k: f"({v})" for k, v in parts.items()}
    parts["signed"] = f"(CASE WHEN {_chance(r6, 500)} THEN {_filled(S.SHAPES['signed'][0], parts)} ELSE '' END)"
    arms = " ".join(f"WHEN '{n}' THEN {_shaped(n, parts)}" for n in ("terse", "verbose", "abbrev"))
    return f"CASE style {arms} ELSE {_shaped('multileg', parts)} || chr(10) || stops END"


_STOP = _shaped("stop", {"n": "(i + 1)", "phrase": "phrase", "reference": "reference"})
_STOPS = f"string_agg({_STOP}, chr(10) ORDER BY i)"

# --- confirmations from orders ----------------------------------------------
_CODES = [c for c, _ in G.PLACES]

CONF = f"""
legs AS (
  SELECT *, unnest(range(0, CASE WHEN o_orderkey % {B.LONG_EVERY} = 0 THEN {B.LONG_LINES}
                            ELSE 1 + o_custkey % 4 END)) AS i
  FROM orders),
conf AS (
  SELECT o_orderkey AS id, i, o_orderstatus, o_orderdate,
    CASE WHEN (o_orderkey + i) % 7 <> 0 THEN {_choose_text(_CODES, '((o_custkey + i) % 10)')} END AS origin,
    CASE WHEN (o_orderkey + i) % 7 > 1 THEN {_choose_text(_CODES, '((o_custkey + i + 1) % 10)')} END AS destination,
    1 + (o_orderkey + 3 * i) % 40 AS quantity,
    {_choose_text(UNITS, '((o_custkey + i) % 4)')} AS unit,
    CASE WHEN (o_custkey + i) % 3 <> 0 THEN (5 + (o_orderkey + i) % 416) * 100 END AS weight,
    CASE WHEN i = 0 AND o_custkey % 4 >= 2 THEN day(o_orderdate) END AS pickup_day,
    CASE WHEN i = 0 AND o_custkey % 4 >= 1 THEN month(o_orderdate) END AS pickup_month,
    CASE WHEN i = 0 AND o_custkey % 4 = 3 THEN year(o_orderdate) END AS pickup_year,
    CASE WHEN i = 0 THEN 'pickup' ELSE 'delivery' END AS leg,
    CASE WHEN (o_orderkey + i) % 5 = 0
         THEN {_choose([str(c) for c in G.CHARGES], '((o_orderkey + i) % 8)')} END AS accessorial,
    floor(o_totalprice * 100 + 0.5)::BIGINT + i AS rate_cents,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'PO-' || (1000 + o_orderkey) END AS reference
  FROM legs),
conf_lines AS (SELECT *, {LINE_JSON} AS lj FROM conf),
gold AS (SELECT id, count(*) AS n_lines, {_list_json()} AS gold_json,
                any_value(reference) AS reference, any_value(o_orderstatus) AS o_orderstatus,
                any_value(o_orderdate) AS o_orderdate
         FROM conf_lines GROUP BY id)"""

_ROW_DIGEST = "sha256('text|' || c.id || '|row')"

CONF_TEXT = f"""{CONF},
conf_drawn AS (
  SELECT c.*, sha256('text|' || c.id || '|' || c.i) AS h, sha256('text|' || c.id || '|row') AS hr,
    CASE WHEN g.n_lines > 1 THEN 'multileg'
         ELSE {_choose_text(['terse', 'verbose', 'abbrev'], f"({_draw(_ROW_DIGEST, 0)} % 3)")} END AS style
  FROM conf_lines c JOIN gold g USING (id)),
conf_phrases AS (SELECT *, {_phrase([_draw('h', k) for k in range(8)], _density())} AS phrase FROM conf_drawn),
conf_texts AS (
  SELECT id, {_message(_draw('hr', 6), _draw('hr', 7))} AS text FROM (
    SELECT id, any_value(style) AS style, any_value(reference) AS reference, any_value(hr) AS hr,
           max(CASE WHEN i = 0 THEN phrase END) AS first_phrase, {_STOPS} AS stops
    FROM conf_phrases GROUP BY id))"""

# --- predictions --------------------------------------------------------------
_models = ", ".join(f"({_q(m)}, {p})" for m, p in B.RIGHT_PERCENT.items())

PRED = f"""{CONF},
models(model_name, right_percent) AS (VALUES {_models}),
drawn AS (SELECT g.id, m.model_name, g.n_lines, m.right_percent,
                 sha256('predict|' || g.id || '|' || m.model_name) AS h FROM gold g, models m),
kinds AS (
  SELECT id, model_name, n_lines,
    CASE WHEN {_draw('h', 0)} % 100 < right_percent THEN 'right'
         ELSE {_choose_text(B.PREDICTION_KINDS, f"({_draw('h', 1)} % {len(B.PREDICTION_KINDS)})")} END AS kind,
    ({_draw('h', 2)} % 3000) / 1000.0::DOUBLE AS seconds
  FROM drawn),
moved AS (
  SELECT k.model_name, k.kind, c.* EXCLUDE (i, lj),
    CASE k.kind WHEN 'reversed' THEN k.n_lines - 1 - c.i WHEN 'missing' THEN c.i - 1 ELSE c.i END AS i
  FROM kinds k JOIN conf_lines c ON c.id = k.id AND NOT (k.kind = 'missing' AND c.i = 0)
                                AND k.kind <> 'error'
  UNION ALL
  SELECT k.model_name, k.kind, c.* EXCLUDE (i, lj), k.n_lines AS i
  FROM kinds k JOIN conf_lines c ON c.id = k.id AND c.i = 0 AND k.kind = 'extra'),
changed AS (
  SELECT * REPLACE (
    CASE WHEN i = 0 AND kind = 'quantity' THEN quantity + 7 ELSE quantity END AS quantity,
    CASE WHEN i = 0 AND kind = 'reference' THEN 'PO-0' ELSE reference END AS reference,
    CASE WHEN i = 0 AND kind = 'date' THEN 1 + coalesce(pickup_month, 0) % 12 ELSE pickup_month END AS pickup_month,
    CASE WHEN i = 0 AND kind = 'weight' THEN coalesce(weight, 0) + 100 ELSE weight END AS weight,
    CASE WHEN i = 0 AND kind = 'unit' THEN CASE unit WHEN 'pallets' THEN 'skids' ELSE 'pallets' END
         WHEN i = 0 AND kind = 'broken' THEN NULL ELSE unit END AS unit,
    CASE WHEN i = 0 AND kind = 'leg' THEN CASE leg WHEN 'pickup' THEN 'delivery' ELSE 'pickup' END ELSE leg END AS leg,
    CASE WHEN i = 0 AND kind = 'rate' THEN rate_cents + 100 ELSE rate_cents END AS rate_cents,
    CASE WHEN i = 0 AND kind = 'origin' THEN 'Tulsa' ELSE origin END AS origin)
  FROM moved),
pred_lines AS (SELECT *, {LINE_JSON} AS lj FROM changed)"""

_DIFF = {
    "BAD_QUANTITY": "e.quantity IS DISTINCT FROM p.quantity",
    "BAD_REFERENCE": "e.reference IS DISTINCT FROM p.reference",
    "BAD_DATE": "e.pickup_day IS DISTINCT FROM p.pickup_day OR e.pickup_month IS DISTINCT FROM "
                "p.pickup_month OR e.pickup_year IS DISTINCT FROM p.pickup_year",
    "BAD_WEIGHT": "e.weight IS DISTINCT FROM p.weight",
    "BAD_UNIT": "e.unit IS DISTINCT FROM p.unit",
    "BAD_LEG": "e.leg IS DISTINCT FROM p.leg",
    "BAD_RATE": "e.rate_cents IS DISTINCT FROM p.rate_cents",
}
_SAME = " + ".join(
    f"(e.{c} IS NOT DISTINCT FROM p.{c})::INT"
    for c in ["rate_cents" if f == "rate" else f for f in LINE_FIELDS]
)


def _scored(exp: str, pred: str, keys: str, heads: str) -> str:
    """CTEs that compare two line relations keyed by `keys` (id among them); `heads`
    lists every key with usable, exp_n and pred_n derived from the lines."""
    join = " AND ".join(f"e.{k} = p.{k}" for k in keys.split(", "))
    return f"""
sides AS (
  SELECT {keys}, string_agg(CASE WHEN side = 0 THEN lj END, ';' ORDER BY i) AS e_list,
    string_agg(CASE WHEN side = 1 THEN lj END, ';' ORDER BY i) AS p_list,
    string_agg(CASE WHEN side = 0 THEN lj END, ';' ORDER BY lj) AS e_bag,
    string_agg(CASE WHEN side = 1 THEN lj END, ';' ORDER BY lj) AS p_bag,
    count(*) FILTER (side = 0) AS e_n, count(*) FILTER (side = 1) AS p_n
  FROM (SELECT {keys}, i, lj, 0 AS side FROM {exp} UNION ALL SELECT {keys}, i, lj, 1 FROM {pred})
  GROUP BY {keys}),
pairs AS (
  SELECT {', '.join('e.' + k for k in keys.split(', '))}, sum({_SAME}) AS same,
    {', '.join(f'bool_or({cond}) AS {name}' for name, cond in _DIFF.items())}
  FROM {exp} e JOIN {pred} p ON {join} AND e.i = p.i GROUP BY ALL),
judged AS (
  SELECT {', '.join('h.' + k for k in keys.split(', '))}, h.* EXCLUDE ({keys}),
    CASE WHEN NOT usable THEN 'ERROR' WHEN coalesce(e_list, '') = coalesce(p_list, '') THEN 'CORRECT'
         WHEN e_bag IS NOT DISTINCT FROM p_bag THEN 'UNORDERED'
         WHEN coalesce(p_n, 0) > coalesce(e_n, 0) THEN 'EXTRA_ITEMS'
         WHEN coalesce(p_n, 0) < coalesce(e_n, 0) THEN 'MISSING_ITEMS'
         {' '.join(f"WHEN {name} THEN '{name}'" for name in _DIFF)} ELSE 'OTHER' END AS category,
    CASE WHEN NOT usable THEN 0.0::DOUBLE
         WHEN greatest(coalesce(e_n, 0), coalesce(p_n, 0)) = 0 THEN 1.0::DOUBLE
         ELSE round_even(coalesce(same, 0)::DOUBLE / (12 * greatest(e_n, p_n)), 4) END AS field_accuracy
  FROM ({heads}) h LEFT JOIN sides USING ({keys}) LEFT JOIN pairs USING ({keys}))"""


SCORED = f"""{PRED},
exp_lines AS (SELECT m.model_name, c.* FROM conf_lines c, models m),
{_scored('exp_lines', 'pred_lines', 'id, model_name',
         "SELECT id, model_name, kind NOT IN ('error', 'broken') AS usable, "
         "CASE WHEN kind <> 'error' THEN seconds END AS duration FROM kinds")}"""

_ORDER = "[" + ", ".join(_q(c) for c in CATEGORIES) + "]"


def _gate(source: str) -> str:
    return f"""SELECT model_name, version,
  round(100 * avg(CASE WHEN category IS NOT NULL THEN (category = 'CORRECT')::INT END), 4) AS pct_correct,
  round(100 * avg(field_accuracy), 4) AS pct_fields, count(*) AS n,
  avg(duration)::DECIMAL(10,2) AS avg_seconds
FROM {source} GROUP BY model_name, version"""


EVENT_LOG = """
ks AS (SELECT *, json_extract_string(props, '$.k')::INT AS k FROM events),
log AS (SELECT event_type AS model_name, 'v' || (event_id % 3) AS version,
  CASE WHEN k % 10 < 6 THEN 'CORRECT' WHEN k % 10 = 6 THEN 'ERROR' WHEN k % 10 = 7 THEN 'BAD_RATE'
       WHEN k % 10 = 8 THEN 'NOT_A_CATEGORY' END AS category,
  CASE WHEN k % 10 <> 6 THEN value END AS duration, k / 100.0::DOUBLE AS field_accuracy FROM ks)"""


def _percent(where: str) -> str:
    return (
        f"(SELECT coalesce(100.0::DOUBLE * count(*) FILTER (category = 'CORRECT') / nullif(count(*), 0), 0) "
        f"FROM judged WHERE {where})"
    )


def _decision(pairs: list[tuple[str, str | None]]) -> str:
    out = []
    for cand, inc in pairs:
        c = _percent(f"model_name = {_q(cand)}")
        i = _percent(f"model_name = {_q(inc)}") if inc else "NULL::DOUBLE"
        out.append(f"SELECT {_q(cand)} AS candidate, {c} AS c, {i} AS i")
    return (
        "SELECT candidate, CASE WHEN i IS NULL THEN 'PROMOTED_BASELINE' WHEN c > i THEN 'PROMOTED' "
        "ELSE 'KEPT' END AS decision, round(c, 6) AS candidate_pct, round(i, 6) AS incumbent_pct "
        f"FROM ({' UNION ALL '.join(out)})"
    )


# --- reviews ------------------------------------------------------------------
_BROKEN = _choose_text(B.BROKEN_LABELS, f"((id // 11) % {len(B.BROKEN_LABELS)})")
_LAX_CANONICAL = '[{"quantity": 12, "unit": "skids", "leg": "pickup", "rate": 2.5}]'

REVIEWS = f"""{CONF_TEXT},
reviews AS (
  SELECT id, text,
    CASE WHEN id % 11 = 0 THEN {_BROKEN} WHEN id % 13 = 0 THEN {_q(B.LAX_LABEL)} ELSE gold_json END AS parsed,
    CASE WHEN id % 17 = 0 THEN '[]' WHEN id % 5 = 0 THEN gold_json END AS corrected,
    CASE WHEN o_orderstatus IN ('F', 'P') THEN o_orderdate END AS reviewed,
    o_orderstatus = 'P' AS exclude, o_orderdate AS created,
    CASE WHEN id % 17 = 0 THEN '[]' WHEN id % 5 = 0 THEN gold_json WHEN id % 11 = 0 THEN NULL
         WHEN id % 13 = 0 THEN {_q(_LAX_CANONICAL)} ELSE gold_json END AS chosen
  FROM gold JOIN conf_texts USING (id)),
trusted AS (SELECT * FROM reviews WHERE reviewed IS NOT NULL AND NOT exclude)"""

_PREVIEW = (
    "CASE WHEN length(replace({t}, chr(10), ' ')) > 70 "
    "THEN left(replace({t}, chr(10), ' '), 70) || '…' ELSE replace({t}, chr(10), ' ') END"
)

# --- label errors ---------------------------------------------------------------
_DROP_ORDER = ["weight", "accessorial", "reference", "pickup_year", "pickup_month", "pickup_day"]
_HAS_VALUE = " OR ".join(f"{f} IS NOT NULL" for f in _DROP_ORDER)
_DROPPED = "CASE " + " ".join(f"WHEN {f} IS NOT NULL THEN '{f}'" for f in _DROP_ORDER) + " END"


def _corrupted(kinds: str) -> str:
    """CTE bad_lines of conf_lines with the error of `kinds`(id, kind)."""
    drops = ", ".join(
        f"CASE WHEN kind = 'missing' AND i = first_i AND drop_f = '{f}' THEN NULL ELSE {f} END AS {f}"
        for f in _DROP_ORDER if f != "reference"
    )
    return f"""
shape AS (SELECT id, count(*) AS n, min(CASE WHEN {_HAS_VALUE} THEN i END) AS first_i FROM conf_lines GROUP BY id),
bad AS (
  SELECT * REPLACE ({drops},
    CASE WHEN kind = 'missing' AND i = first_i AND drop_f = 'reference' THEN NULL
         WHEN kind = 'hallucination' AND i = 0 THEN 'PO-HALLUCINATED-000000' ELSE reference END AS reference,
    CASE WHEN kind = 'mapping' AND i = 0 THEN quantity + 7 ELSE quantity END AS quantity,
    CASE WHEN kind = 'ordering' THEN n - 1 - i ELSE i END AS i)
  FROM (SELECT c.* EXCLUDE (lj), k.kind, s.n, s.first_i, {_DROPPED} AS drop_f
        FROM conf_lines c JOIN shape s USING (id) LEFT JOIN {kinds} k USING (id))),
bad_lines AS (SELECT *, {LINE_JSON} AS lj FROM bad)"""


FIRST_PLAN = f"""
fit AS (SELECT id, count(*) AS n, bool_or({_HAS_VALUE}) AS droppable FROM conf_lines GROUP BY id),
k1 AS (SELECT min(id) AS id FROM fit WHERE n >= 2),
k2 AS (SELECT min(id) AS id FROM fit WHERE droppable AND id NOT IN (SELECT id FROM k1)),
k3 AS (SELECT min(id) AS id FROM fit WHERE id NOT IN (SELECT id FROM k1 UNION ALL SELECT id FROM k2)),
k4 AS (SELECT min(id) AS id FROM fit WHERE id NOT IN (SELECT id FROM k1 UNION ALL SELECT id FROM k2 UNION ALL SELECT id FROM k3)),
plan AS (SELECT id, 'ordering' AS kind FROM k1 UNION ALL SELECT id, 'missing' FROM k2
         UNION ALL SELECT id, 'hallucination' FROM k3 UNION ALL SELECT id, 'mapping' FROM k4)"""


def fraction_plan(permille: int, seed: int) -> str:
    return f"""
fit AS (SELECT id, count(*) AS n, bool_or({_HAS_VALUE}) AS droppable,
               sha256('{seed}|' || id || '|corrupt') AS h FROM conf_lines GROUP BY id),
options AS (SELECT *, list_filter([CASE WHEN n >= 2 THEN 'ordering' END, CASE WHEN droppable THEN 'missing' END,
   'hallucination', 'mapping'], lambda x: x IS NOT NULL) AS kinds FROM fit),
plan AS (SELECT id, kinds[1 + {_draw('h', 1)} % len(kinds)] AS kind FROM options
         WHERE {_chance(_draw('h', 0), permille)})"""


def _error_class() -> str:
    cols = ["rate_cents" if f == "rate" else f for f in LINE_FIELDS]
    extra = " OR ".join(f"(p.{c} IS NOT NULL AND e.{c} IS NULL)" for c in cols)
    gone = " OR ".join(f"(p.{c} IS NULL AND e.{c} IS NOT NULL)" for c in cols)
    return f"""
bags AS (
  SELECT id, string_agg(CASE WHEN side = 0 THEN lj END, ';' ORDER BY i) AS e_list,
    string_agg(CASE WHEN side = 1 THEN lj END, ';' ORDER BY i) AS p_list,
    string_agg(CASE WHEN side = 0 THEN lj END, ';' ORDER BY lj) AS e_bag,
    string_agg(CASE WHEN side = 1 THEN lj END, ';' ORDER BY lj) AS p_bag
  FROM (SELECT id, i, lj, 0 AS side FROM conf_lines UNION ALL SELECT id, i, lj, 1 FROM bad_lines) GROUP BY id),
marks AS (SELECT e.id, bool_or({extra}) AS extra, bool_or({gone}) AS gone
          FROM conf_lines e JOIN bad_lines p ON e.id = p.id AND e.i = p.i GROUP BY e.id),
classes AS (
  SELECT id, CASE WHEN e_list = p_list THEN NULL WHEN e_bag = p_bag THEN 'wrong-order'
                  WHEN extra THEN 'hallucinated' WHEN gone THEN 'missing' ELSE 'wrong-mapping' END AS error_class
  FROM bags JOIN marks USING (id))"""


# --- generated examples ---------------------------------------------------------
def _knob(percents: dict[str, int], cap: int) -> str:
    arms = " ".join(f"WHEN {_q(s)} THEN {p * 10}" for s, p in percents.items())
    return f"least({cap * 10}, CASE style {arms} END + (complexity - 1) * {G.STEP_PERCENT * 10})"


def generated(seed: int) -> str:
    r = lambda k: _draw("h", k)
    a = lambda k: _draw("ha", k)
    b = lambda k: _draw("hb", k)
    place = lambda k: (
        f"CASE WHEN city THEN {_choose_text([c for _, c in G.PLACES], k)} "
        f"ELSE {_choose_text(_CODES, k)} END"
    )
    start = f"({a(4)} % 10)"
    end = f"(({a(4)} % 10 + 1 + {a(5)} % 9) % 10)"
    phrase_draws = [b(3), b(4), b(5), b(6), b(7), a(0), a(1), f"({a(2)} >> 8)"]
    return f"""
g0 AS (SELECT o_orderkey AS idx, sha256('{seed}|' || o_orderkey || '|row') AS h FROM orders),
g1 AS (SELECT *, {_choose_text(G.STYLES, f'({r(0)} % 4)')} AS style, (1 + {r(1)} % 4)::INT AS complexity,
  CASE WHEN {_chance(r(3), G.REFERENCE_PERMILLE)} THEN
    {_choose_text(G.REFERENCE_PREFIXES, f'({r(3)} % 6)')} || {_choose_text(G.REFERENCE_SEPARATORS, f'({r(4)} % 4)')}
    || (1000 + {r(5)} % 99000) END AS reference FROM g0),
g2 AS (SELECT *, {_knob(G.MISSING_PERCENT, G.MISSING_CAP)} AS missing,
  {_knob(G.PARTIAL_DATE_PERCENT, G.PARTIAL_DATE_CAP)} AS partial_date,
  CASE WHEN style = 'multileg' THEN 2 + {r(2)} % (1 + least(complexity, 2)) ELSE 1 END AS n_lines FROM g1),
g3 AS (SELECT *, unnest(range(0, n_lines)) AS i FROM g2),
g4 AS (SELECT *, sha256('{seed}|' || idx || '|' || i || '|a') AS ha, sha256('{seed}|' || idx || '|' || i || '|b') AS hb FROM g3),
g5 AS (SELECT *, CASE WHEN style = 'multileg' AND i = 0 THEN 'pickup' WHEN style = 'multileg' THEN 'delivery'
    WHEN {_chance(a(3), 500)} THEN 'pickup' ELSE 'delivery' END AS leg,
  style = 'verbose' OR (style = 'multileg' AND {_chance(a(7), G.CITY_PERMILLE)}) AS city,
  NOT {_chance(a(4), 'missing * 5 // 10')} AS has_lane FROM g4),
g6 AS (SELECT idx, i, style, complexity, reference, leg, h, ha, hb,
  CASE WHEN has_lane THEN {place(start)} END AS origin,
  CASE WHEN has_lane AND NOT {_chance(a(5), 'missing * 3 // 10')} THEN {place(end)} END AS destination,
  1 + {a(0)} % 40 AS quantity, {_choose_text(UNITS, f'({a(1)} % 4)')} AS unit,
  CASE WHEN NOT {_chance(a(6), 'missing')} THEN (5 + {a(6)} % 416) * 100 END AS weight,
  CASE WHEN leg = 'pickup' AND NOT {_chance(b(0), 'missing')} AND NOT {_chance(b(1), 'partial_date // 2')}
       THEN 1 + {b(1)} % 28 END AS pickup_day,
  CASE WHEN leg = 'pickup' AND NOT {_chance(b(0), 'missing')} THEN 1 + {b(0)} % 12 END AS pickup_month,
  CASE WHEN leg = 'pickup' AND NOT {_chance(b(0), 'missing')} AND NOT {_chance(b(1), 'partial_date')}
       THEN 2025 + {b(2)} % 2 END AS pickup_year,
  CASE WHEN {_chance(b(2), G.CHARGE_PERMILLE)} THEN {_choose([str(c) for c in G.CHARGES], f'({a(7)} % 8)')} END AS accessorial,
  (350 + {a(2)} % 4451) * 100 + {_choose([str(c) for c in G.RATE_CENTS], f'({a(3)} % 6)')} AS rate_cents FROM g5),
g7 AS (SELECT *, {LINE_JSON} AS lj, {_phrase(phrase_draws, _density())} AS phrase FROM g6),
g8 AS (SELECT idx, any_value(style) AS style, any_value(complexity) AS complexity, any_value(reference) AS reference,
  any_value(h) AS h, {_list_json()} AS parsed_json, count(*) AS n_lines,
  max(CASE WHEN i = 0 THEN phrase END) AS first_phrase, {_STOPS} AS stops FROM g7 GROUP BY idx),
examples AS (SELECT 'synth-{seed}-' || CASE WHEN idx < 100000 THEN lpad(idx::VARCHAR, 5, '0') ELSE idx::VARCHAR END AS id,
  {_message(r(6), r(7))} AS text, parsed_json, style, complexity, n_lines FROM g8)"""


# --- label pools from documents -------------------------------------------------
_ONE = "'[{\"quantity\": ' || (1 + doc_id % 40) || ', \"unit\": \"pallets\", \"leg\": \"pickup\", \"rate\": 100}]'"

POOL = f"""
docs AS (SELECT doc_id, 'doc-' || doc_id AS id, text, source, doc_id % 5 = 0 AS is_real, {_ONE} AS one FROM documents),
labelled AS (SELECT id, text, is_real, CASE WHEN doc_id % 3 = 0 THEN
  '[{{"quantity": 1, "unit": "skids", "leg": "pickup", "rate": 1}}, ' || substr(one, 2) ELSE one END AS parsed_json,
  CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 1 END AS n_lines FROM docs)"""


def _place(seed: int, tag: str) -> str:
    return f"('0x' || substr(md5('{seed}|{tag}|' || id || '|order'), 1, 15))::BIGINT"


def prepared(seed: int, ratio: float, percent: float) -> str:
    return f"""{POOL},
counts AS (SELECT count(*) FILTER (is_real) AS n_real, count(*) FILTER (NOT is_real) AS n_syn FROM labelled),
ranked_syn AS (SELECT *, row_number() OVER (ORDER BY {_place(seed, 'sample')}) AS rk FROM labelled WHERE NOT is_real),
used AS (SELECT id, text, parsed_json, n_lines, is_real FROM labelled WHERE is_real UNION ALL
  SELECT id, text, parsed_json, n_lines, is_real FROM ranked_syn, counts WHERE n_real = 0 OR rk <= round_even(n_real * {ratio}::DOUBLE, 0)),
shuffled AS (SELECT *, row_number() OVER (ORDER BY {_place(seed, '')}) AS rk, count(*) OVER () AS n FROM used),
split AS (SELECT *, rk <= greatest(1, round_even(n * {percent}::DOUBLE / 100.0::DOUBLE, 0)) AS held FROM shuffled)"""


def _prompt(text: str, hint: str | None = None) -> str:
    head = _q(INSTRUCTION)
    if hint:
        head += f" || coalesce(chr(10) || 'Hint: ' || {hint}, '')"
    return f"{head} || chr(10) || chr(10) || 'Confirmation:' || chr(10) || {text} || chr(10)"


def _with(ctes: str, body: str) -> str:
    return "WITH " + ctes.strip() + "\n" + body
