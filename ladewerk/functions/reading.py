"""Reading the parts of a shipment line out of message text.

Two rule sets: `clean` knows the spelled-out forms only, `full` also the
abbreviations. All rules are regular expressions over one text segment. The
expression is large, so it is written as SQL text and parsed once.

A rule that could start at any place first looks at the character there: a word
boundary, a look behind or a list of words costs many times more.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ladewerk.functions.binding import built_once, let
from ladewerk.functions.surface import CHARGE_KINDS, MONTHS, UNIT_SHORT
from ladewerk.schema import DECIMAL, LINE, LINES

_AMOUNT = r"(\d[\d,]*(?:\.\d+)?)"
# --- fixed values -----------------------------------------------------------
# What charges and references are called in the given messages, beside the wording table.
OTHER_CHARGES = ["fuel surcharge", "surcharge", "FSC", "detention", "lumper", "layover"]
REFERENCE_WORDS = ["PO", "BOL", "REF", "SO", "PRO", "LOAD", "acct"]
# --- end of fixed values ----------------------------------------------------


def _one_of(words: list[str]) -> str:
    """Next comes the first letter of one of these words."""
    return f"(?=[{''.join(sorted({w[0] for w in words}))}])"


_KINDS = "|".join([*CHARGE_KINDS, *OTHER_CHARGES])
_KIND = _one_of([*CHARGE_KINDS, *OTHER_CHARGES])
_FULL_MONTHS = "|".join(MONTHS)
_ANY_MONTH = "|".join(f"{m[:3]}(?:{m[3:]})?" if m[3:] else m for m in MONTHS)
# Capitalised words that end a place name: they open the next phrase.
_NOT_A_PLACE = rf"(?!(?:WT|RT|ORIG|DEST|REF|(?i:{_ANY_MONTH}))\b)"
_WORD = rf"(?=[A-Z])\b{_NOT_A_PLACE}(?:St\.|[A-Z][A-Za-z]*)"
_PLACE = rf"({_WORD}(?: {_WORD})*)"
_SITE = "(?: (?:dock|yard|terminal|warehouse|plant|depot))?"
_LOADING = rf"(?=l)\bloading {_PLACE}, unloading {_PLACE}"
_TURNED = rf"(?=[it])\b(?:in)?to {_PLACE}{_SITE} from {_PLACE}"  # the destination comes first
# A number, or a short prefix and a number, behind the word.
REFERENCE = rf"{_one_of(REFERENCE_WORDS)}\b((?:{'|'.join(REFERENCE_WORDS)})[-# ]?(?:[A-Z]{{1,4}}-)?\d[\d-]*)"
_BILLED = "(?: (?:is )?(?:billed|charged))?(?: at)?"
_PER_TIME = r"(?![\d,.]*/ ?(?:hr|hour|day)\b)"  # such an amount is no rate


@dataclass(frozen=True)
class Rules:
    name: str
    units: dict[str, list[str]]
    delivery: str
    both_ends: list[str]
    start_only: str
    end_only: str
    weight: str
    month_name: str
    numeric_date: str | None
    rate: list[str]
    charge: list[str]


CLEAN = Rules(
    name="clean",
    units={u: [u, u[:-1]] for u in UNIT_SHORT},
    delivery=r"(?i)(?=d)\b(deliver|delivery|DLV)\b",
    both_ends=[rf"{_PLACE}{_SITE} (?:to|bound for) {_PLACE}", _LOADING],
    start_only=rf"(?=[flo])\b(?:from|out of|loading|origin) {_PLACE}",
    end_only=rf"(?=[tub])\b(?:to|unloading|bound for) {_PLACE}",
    weight=r"(\d[\d,]*) ?(?:lbs|pounds)\b",
    month_name=_FULL_MONTHS,
    numeric_date=None,
    rate=[rf"(?i)(?=[rl])\b(?:rate|linehaul) \$?{_AMOUNT}", rf"(?i)(?=a)\bat {_PER_TIME}\$?{_AMOUNT}", rf"\${_AMOUNT}"],
    charge=[rf"(?i){_KIND}\b(?:{_KINDS}){_BILLED} \${_AMOUNT}"],
)

FULL = Rules(
    name="full",
    units={u: [u, u[:-1], *short] for u, short in UNIT_SHORT.items()},
    delivery=r"(?i)(?=d)\b(deliver|delivery|dlv|del)\b",
    both_ends=[
        rf"(?=O)\bORIG {_PLACE} DEST {_PLACE}",
        rf"(?=O)\bO:{_PLACE} D:{_PLACE}",
        rf"{_PLACE}(?:{_SITE} to | ?-> ?| ?=> ?| ?>> ?| ?> ?|-|{_SITE} bound for ){_PLACE}",
        _LOADING,
    ],
    start_only=rf"(?=[floe@O])(?:(?:\b(?:from|out of|orig|origin|loading|ex)|@) |\bO:){_PLACE}",
    end_only=rf"(?=[tdub=D-])(?:(?:\b(?:to|dest|unloading|bound for)|->|=>) |\bD:){_PLACE}",
    weight=r"(\d[\d,]*) ?(?:lbs?\b|pounds\b|#)",
    month_name=f"(?i:{_ANY_MONTH})",
    numeric_date=r"(?=\d)(?<![\d/])(\d{1,2})/(\d{1,2})(?:/(\d{4}|\d{2}))?(?![\d/])",
    rate=[
        rf"(?i)(?=[rl])\b(?:rate|RT|linehaul) \$?{_AMOUNT}",
        rf"(?i)(?=a)\bat {_PER_TIME}\$?{_AMOUNT}",
        rf"@ ?\$?{_AMOUNT}(?! ?lb)",
        rf"(?=\$)(?<!\+)\${_AMOUNT}",
    ],
    charge=[rf"(?i){_KIND}\b(?:{_KINDS}){_BILLED} \$?{_AMOUNT}", rf"(?i)\+\$?{_AMOUNT} (?:{_KINDS})"],
)
RULE_SETS = {r.name: r for r in (CLEAN, FULL)}


def _found(s: str, pattern: str, group: int = 1) -> str:
    """The group's text, or null. Inside a lambda nullif would search twice."""
    return f"get(array_remove(array(regexp_extract({s}, r'{pattern}', {group})), ''), 0)"


def _first(s: str, patterns: list[str], group: int = 1) -> str:
    return f"coalesce({', '.join(_found(s, p, group) for p in patterns)})"


def _number(s: str) -> str:
    return f"try_cast(replace({s}, ',', '') AS {DECIMAL.simpleString()})"


def _struct(**values: str) -> str:
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in values.items()) + ")"


def _unit_pattern(rules: Rules) -> str:
    forms = sorted((f for fs in rules.units.values() for f in fs), key=len, reverse=True)
    return r"(?i)(?=\d)\b(\d[\d,]*) (" + "|".join(forms) + r")\b"


def _unit_of(word: str, rules: Rules) -> str:
    """The unit of a lower-cased word."""
    arms = " ".join(
        f"WHEN {word} IN ({', '.join(repr(f.lower()) for f in forms)}) THEN '{unit}'"
        for unit, forms in rules.units.items()
    )
    return f"CASE {arms} END"


def _named_date(rules: Rules) -> str:
    return (
        rf"(?i:{_one_of(MONTHS)})\b({rules.month_name})\b(?: (\d{{1,2}})(?:st|nd|rd|th)?\b(?![,.\d/]\d))?"
        r"(?:,? (\d{4})\b)?"
    )


def _passages(s: str, rules: Rules) -> str:
    """Where in the segment the parts are, beside its count: one search each, read in
    detail later from the short passage alone."""
    return _struct(
        delivered=f"rlike({s}, r'{rules.delivery}')",
        lane=_first(s, rules.both_ends, 0),
        slashed=_found(s, rules.numeric_date, 0) if rules.numeric_date else "CAST(NULL AS string)",
        named=_found(s, _named_date(rules), 0),
    )


def _stated_date(p: str, rules: Rules) -> str:
    """struct(day, month, year) of only the stated parts."""
    part = lambda k: f"CAST(get(split({p}.slashed, '/'), {k}) AS int)"
    numeric = _struct(
        day=part(1), month=part(0),
        year=f"CASE WHEN {part(2)} < 100 THEN 2000 + {part(2)} ELSE {part(2)} END",
    )
    months = ", ".join(f"'{m[:3].lower()}'" for m in MONTHS)
    worded = _struct(
        day=f"CAST({_found(f'{p}.named', _named_date(rules), 2)} AS int)",
        month=f"CAST(array_position(array({months}), lower(left({p}.named, 3))) AS int)",
        year=f"CAST({_found(f'{p}.named', _named_date(rules), 3)} AS int)",
    )
    return (
        f"CASE WHEN {p}.delivered THEN NULL WHEN {p}.slashed IS NOT NULL THEN {numeric} "
        f"WHEN {p}.named IS NOT NULL THEN {worded} END"
    )


def _ends(s: str, lane: str, rules: Rules) -> str:
    """struct(origin, destination) of the lane passage, or of a single stated end."""
    both = _struct(
        origin=_first(lane, rules.both_ends, 1), destination=_first(lane, rules.both_ends, 2)
    )
    end = f"CASE WHEN o IS NULL THEN {_found(s, rules.end_only)} ELSE {_found(s, _TURNED)} END"
    one = let(_found(s, rules.start_only), "o", _struct(origin="o", destination=end))
    return f"CASE WHEN {lane} IS NOT NULL THEN {both} ELSE {one} END"


def _line_of(s: str, count: str, p: str, reference: str, rules: Rules) -> str:
    values = {
        "origin": "q.ends.origin",
        "destination": "q.ends.destination",
        "quantity": _number(f"substring_index({count}, ' ', 1)"),
        "unit": _unit_of("q.unit", rules),
        "weight": _number(_found(s, rules.weight)),
        "pickup_day": "q.date.day",
        "pickup_month": "q.date.month",
        "pickup_year": "q.date.year",
        "leg": f"CASE WHEN {p}.delivered THEN 'delivery' ELSE 'pickup' END",
        "accessorial": _number(_first(s, rules.charge)),
        "rate": _number(_first(s, rules.rate)),
        "reference": reference,
    }
    line = _struct(
        **{f.name: f"try_cast({values[f.name]} AS {f.dataType.simpleString()})" for f in LINE.fields}
    )
    unit = f"lower(substring_index({count}, ' ', -1))"
    found = _struct(unit=unit, date=_stated_date(p, rules), ends=_ends(s, f"{p}.lane", rules))
    return let(found, "q", line)


_LEG_WORD = r"(?:pick ?up|p/?u|coll(?:ect)?|deliver(?:y)?|dlv|del)(?: (?:of|to))?:?"


def _one_each(line: str, rules: Rules) -> str:
    """A text line cut before every count after its first, if both the part before and the
    part after state a rate: a second count of one shipment does not. A leg word in front
    of the count goes with it."""
    count = _unit_pattern(rules)
    bare = count.removeprefix("(?i)")
    rated = r"(?:\b(?:rate|RT|linehaul|at) |@ ?|\$)\$?\d"
    part = rf"((?:(?!{bare}).)*?{rated}.*?)"
    following = rf"\s+(?=(?:(?:and|then|plus|&) )?(?:{_LEG_WORD} )?{bare}.*?{rated})"
    cut = f"split(regexp_replace({line}, r'{count}{part}{following}', '$1 $2$3\n'), r'\n')"
    return f"CASE WHEN rlike({line}, r'{count}.*{bare}') THEN {cut} ELSE array({line}) END"


def _shared_charges(text: str, rules: Rules) -> str:
    """struct(every, by_leg): a charge that is stated for all legs, and the ones stated
    behind the legs for one of them, as "<leg>" -> amount."""
    said = rf"(?:{_KINDS}){_BILLED} \$?{_AMOUNT}"
    every = _number(_found(text, rf"(?i)\b{said}[^\n]{{0,20}}\b(?:both|all|each|every) legs?\b"))
    one = rf"(?i)\b{said} on leg (\d{{1,3}})\b"
    amounts, legs = (f"regexp_extract_all({text}, r'{one}', {k})" for k in (1, 2))
    return _struct(every=every, legs=legs, amounts=amounts)


@built_once
def read_lines(text: str, rule_set: str) -> Column:
    """array<LINE>: one line for each count and unit, read from it (or, for the first, from
    the start of its text line) up to the next one or the line's end. The reference is
    stated once and goes on every line, and so does a charge for all legs; a charge "on leg
    2" goes on the second line."""
    rules = RULE_SETS[rule_set]
    parts = f"flatten(transform(split({text}, r'\n'), t -> {_one_each('t', rules)}))"
    counted = _struct(s="s", count=f"regexp_extract(s, r'{_unit_pattern(rules)}', 0)")
    segments = f"filter(transform({parts}, s -> {counted}), c -> c.count <> '')"
    line = let(_passages("c.s", rules), "p", _line_of("c.s", "c.count", "p", "ref", rules))
    lines = let(_found(text, REFERENCE), "ref", f"transform({segments}, c -> {line})")
    if rules is FULL:
        own = "get(c.amounts, CAST(array_position(c.legs, CAST(i + 1 AS string)) AS int) - 1)"
        fields = {f.name: f"x.{f.name}" for f in LINE.fields}
        fields["accessorial"] = f"coalesce(x.accessorial, {_number(own)}, c.every)"
        charged = f"transform(l, (x, i) -> {_struct(**fields)})"
        stated = r"(?i)\blegs?\b"
        shared = let(_shared_charges(text, rules), "c", charged)
        lines = let(lines, "l", f"CASE WHEN rlike({text}, r'{stated}') THEN {shared} ELSE l END")
    return F.expr(f"CAST({lines} AS {LINES.simpleString()})")
