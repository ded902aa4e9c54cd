"""How a stored shipment line is written in a message.

All wordings stand in one table: for each kind of phrase its plain and its short forms,
with the parts they name in braces. One draw decides both the class (its high part
against the style's share of short forms) and the form (its remainder). The expression is
large, so it is written as SQL text: `x` is the line, `d` its eight draws and `density`
the permille of short forms.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ladewerk.functions.binding import built_once, let

# --- fixed values -----------------------------------------------------------
UNIT_SHORT = {
    "pallets": ["plt", "plts", "pal", "pals"],
    "skids": ["skd", "skds", "sk"],
    "cartons": ["ctn", "ctns", "cs", "cases"],
    "containers": ["cntr", "cntrs", "cont", "box"],
}
MONTHS = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]
# --- end of fixed values ----------------------------------------------------
CHARGE_KINDS = ["tail lift", "waiting time", "tolls", "storage", "escort"]
CARRIERS = [
    "Juniper Line", "Kestrel Haul", "Old Quay Trucking", "Larkfield Transit",
    "Pinewood Express", "Copper Gate Lines", "Tideway Movers", "Elm Road Carriage",
]
COMMODITIES = [
    "ceramic tiles", "garden furniture", "printer paper", "bicycle frames",
    "bottled water", "roof insulation", "copper cable", "school desks",
]
# kind of phrase: (plain forms, short forms)
WORDING = {
    "pickup": (["Collect", "Pickup of"], ["PU", "COLL", "pu"]),
    "delivery": (["Deliver", "Delivery of"], ["DLV", "del"]),
    "lane": (
        ["{origin} bound for {destination}", "loading {origin}, unloading {destination}"],
        ["{origin} >> {destination}", "O:{origin} D:{destination}", "{origin} => {destination}"],
    ),
    "start": (["loading {origin}", "origin {origin}"], ["O:{origin}", "ex {origin}"]),
    "end": (["unloading {destination}", "bound for {destination}"], ["D:{destination}", "=> {destination}"]),
    "weight": (["{grouped} pounds", "gross {grouped} lbs"], ["{pounds}#", "GW {grouped}lb"]),
    "month": (["{month}", "during {month}"], ["{mon}", "mid {mon}"]),
    "month_day": (["{month} {day}", "ready {month} {day}"], ["{mon} {day}", "{m}/{day}"]),
    "full_date": (
        ["{month} {day}, {year}", "ready {month} {day}, {year}"],
        ["{mon} {day} {year}", "{m}/{day}/{year}"],
    ),
    "rate": (["rate ${rate}", "freight ${rate}", "all-in ${rate}"], ["RT {rate}", "@{rate}"]),
    "charge": (["{kind} ${charge}"], ["{kind} {charge}", "+{charge} {kind}"]),
}
# style: (text, what is added where a reference is stated); a stop is a line of a multileg text.
SHAPES = {
    "terse": ("{phrase}", " / {reference}"),
    "verbose": (
        "We confirm with {carrier}: {phrase}. Goods are {commodity}.", " Your reference is {reference}."
    ),
    "abbrev": ("{signed}{phrase}", " ref={reference}"),
    "signed": ("[{carrier}] ", ""),
    "multileg": ("{carrier} run sheet", ", order {reference}"),
    "stop": ("{n}) {phrase}", " ({reference})"),
}


def form_parts(form: str) -> list[tuple[str, str]]:
    """A form as (literal text, name of the part after it), the last name empty."""
    cut_up = re.split(r"{(\w+)}", form)
    return list(zip(cut_up[::2], [*cut_up[1::2], ""], strict=True))


def _quoted(words: list[str]) -> list[str]:
    return [f"'{w}'" for w in words]


def _choose(options: list[str], k: str) -> str:
    if len(options) == 1:
        return options[0]
    arms = " ".join(f"WHEN {i} THEN {o}" for i, o in enumerate(options[:-1]))
    return f"CASE {k} {arms} ELSE {options[-1]} END"


def _by_draw(drawn: str, plain: list[str], short: list[str]) -> str:
    kth = lambda forms: _choose(forms, f"(shiftrightunsigned({drawn}, 4) % {len(forms)})")
    return (
        f"CASE WHEN {drawn} * 1000L < density * 4294967296L THEN {kth(short)} ELSE {kth(plain)} END"
    )


def _filled(form: str, parts: dict[str, str]) -> str:
    """Plain concatenation, no formatter."""
    values = [v for text, name in form_parts(form) for v in (f"'{text}'" if text else "", parts.get(name, "")) if v]
    return values[0] if len(values) == 1 else f"concat({', '.join(values)})"


def _worded(kind: str, drawn: str, parts: dict[str, str]) -> str:
    return _by_draw(drawn, *([_filled(f, parts) for f in forms] for forms in WORDING[kind]))


def _line_phrase() -> str:
    """One line without its reference; only what is stored is stated."""
    pounds = "CAST(floor(x.weight) AS string)"
    month = f"element_at(array({', '.join(_quoted(MONTHS))}), x.pickup_month)"
    parts = {
        "origin": "x.origin", "destination": "x.destination", "pounds": pounds,
        "grouped": "format_number(floor(x.weight), 0)", "month": month, "mon": f"left({month}, 3)",
        "m": "x.pickup_month", "day": "x.pickup_day", "year": "x.pickup_year",
        "rate": "format_number(x.rate, 2)", "charge": "format_number(x.accessorial, 2)",
        "kind": _choose(_quoted(CHARGE_KINDS), f"(d[7] % {len(CHARGE_KINDS)})"),
    }
    worded = lambda kind, k: _worded(kind, f"d[{k}]", parts)
    units = " ".join(
        f"WHEN '{unit}' THEN {_by_draw('d[1]', [f"'{unit}'"], _quoted(short))}"
        for unit, short in UNIT_SHORT.items()
    )
    leg = f"CASE WHEN x.leg = 'pickup' THEN {worded('pickup', 0)} ELSE {worded('delivery', 0)} END"
    # A null part makes its form null, and concat_ws leaves it out.
    lane = f"coalesce({worded('lane', 2)}, {worded('start', 2)}, {worded('end', 2)})"
    date = f"coalesce({worded('full_date', 4)}, {worded('month_day', 4)}, {worded('month', 4)})"
    return (
        f"concat_ws('; ', concat({leg}, ' ', x.quantity, ' ', CASE x.unit {units} ELSE x.unit END), "
        f"{lane}, {worded('weight', 3)}, {date}, {worded('rate', 5)}, {worded('charge', 6)})"
    )


@built_once
def message(
    lines: str, phrase_draws: str, row_draws: str, style: str, reference: str, density: str
) -> Column:
    """The whole confirmation. The first six arguments name columns or are SQL."""
    parts = {
        "carrier": _choose(_quoted(CARRIERS), f"({row_draws}[6] % {len(CARRIERS)})"),
        "commodity": _choose(_quoted(COMMODITIES), f"({row_draws}[7] % {len(COMMODITIES)})"),
        "phrase": "ps[0]",
        "reference": reference,
    }
    parts["signed"] = (
        f"CASE WHEN {row_draws}[6] * 1000L < 500 * 4294967296L "
        f"THEN {_filled(SHAPES['signed'][0], parts)} ELSE '' END"
    )

    def shaped(name: str, **more: str) -> str:
        text, stated = (_filled(f, parts | more) for f in SHAPES[name])
        return f"concat({text}, coalesce({stated}, ''))"

    stops = f"transform(ps, (y, i) -> {shaped('stop', n='(i + 1)', phrase='y')})"
    texts = {name: shaped(name) for name in ("terse", "verbose", "abbrev")}
    texts["multileg"] = f"concat_ws('\\n', {shaped('multileg')}, {stops})"
    arms = " ".join(f"WHEN '{name}' THEN {sql}" for name, sql in texts.items())
    phrases = let(
        density, "density", f"zip_with({lines}, {phrase_draws}, (x, d) -> {_line_phrase()})"
    )
    return F.expr(let(phrases, "ps", f"CASE {style} {arms} END"))
