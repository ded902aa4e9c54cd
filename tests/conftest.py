from __future__ import annotations

import sys
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ladewerk.schema import LINE_FIELDS  # noqa: E402
from ladewerk.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(cores="8", memory="4g", app="tests")


def line(**values):
    """A typed line as a tuple in declaration order; four fields have defaults."""
    base = {"quantity": 12, "unit": "pallets", "leg": "pickup", "rate": Decimal("1847.5")}
    base.update(values)
    for f in ("rate", "weight", "accessorial"):
        if base.get(f) is not None:
            base[f] = Decimal(str(base[f]))
    return tuple(base.get(f) for f in LINE_FIELDS)


FULL = dict(
    weight=4200, origin="CHI", destination="LAX", pickup_month=3, pickup_day=14, reference="PO-1"
)
