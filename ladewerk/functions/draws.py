"""Seeded draws: pure functions of (seed, id, tag), so a row's values depend
neither on other rows nor on how the table is partitioned or retried."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ladewerk.functions.binding import once

DRAWS_PER_DIGEST = 8
_SPAN = 1 << 32


def digest(*parts: Column | str | int) -> Column:
    """64 hex digits identifying the parts (columns, or literal values)."""
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.sha2(F.concat_ws("|", *[c.cast("string") for c in cols]).cast("binary"), 256)


def draw(hex_digits: Column, slot: int) -> Column:
    """The slot-th 32-bit number of a digest, as a bigint in [0, 2**32)."""
    return F.conv(F.substring(hex_digits, 8 * slot + 1, 8), 16, 10).cast("bigint")


def draws(*parts: Column | str | int, blocks: int = 1) -> Column:
    """array<bigint> of eight draws per block."""
    hex_digits = [digest(*parts, *([chr(ord("a") + b)] if blocks > 1 else [])) for b in range(blocks)]
    return once(
        F.concat(*hex_digits),
        lambda h: F.array(*[draw(h, k) for k in range(DRAWS_PER_DIGEST * blocks)]),
    )


def chance(drawn: Column, permille: Column | int) -> Column:
    """True with probability permille/1000; integers only, so any engine agrees."""
    limit = permille if isinstance(permille, Column) else F.lit(permille)
    return drawn * F.lit(1000).cast("bigint") < limit.cast("bigint") * F.lit(_SPAN)


def below(drawn: Column, n: Column | int) -> Column:
    """A number in [0, n)."""
    return drawn % (n if isinstance(n, Column) else F.lit(n))


def choose(options: list, k: Column) -> Column:
    """options[k]; a CASE so that only the chosen option is computed."""
    cols = [o if isinstance(o, Column) else F.lit(o) for o in options]
    if len(cols) == 1:
        return cols[0]
    out = F.when(k == 0, cols[0])
    for i, c in enumerate(cols[1:-1], start=1):
        out = out.when(k == i, c)
    return out.otherwise(cols[-1])


def order_key(seed: int, *id_cols: Column) -> Column:
    """60-bit position of a row in the seeded order of its table."""
    text = F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in id_cols], F.lit("order"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")
