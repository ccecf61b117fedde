"""Operating mode of a compressor and the risk attached to each mode."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The sensor readings of each mode, in order of precedence, and the mode of all others.
MODE_RULES = (
    ("production", {"comp": 1, "towers": 1, "lps": 0}),
    ("idle", {"comp": 0, "towers": 0}),
    ("pressure_event", {"comp": 1, "lps": 1}),
)
OTHER_MODE = "transition"
UNKNOWN_MODE = "unknown"
MODE_INPUTS = frozenset(sensor for _, readings in MODE_RULES for sensor in readings)

# Mode, its risk, its maintenance priority.
MODE_LOOKUP = (
    ("production", "medium", "observe"),
    ("idle", "low", "normal"),
    ("pressure_event", "high", "urgent"),
    ("transition", "medium", "observe"),
    ("unknown", "unknown", "investigate"),
)
DEFAULT_RISK = "unknown"
DEFAULT_PRIORITY = "investigate"

# Ordinal of each risk; any other risk counts 0.
RISK_ORDINALS = {"high": 3.0, "medium": 2.0, "low": 1.0}


def operating_mode(rules: Sequence[tuple[str, dict[str, int]]] = MODE_RULES, other: str = OTHER_MODE) -> Column:
    """Mode of the first rule whose readings all hold; a null reading holds for no rule.

    ``rules`` names the sensors, so tables with other sensor names bring their own.
    """
    chain = F
    for mode, readings in rules:
        chain = chain.when(reduce(and_, [F.col(s) == v for s, v in readings.items()]), mode)
    return chain.otherwise(other)


def mode_risk_ordinal(risk: Column | str = "mode_risk") -> Column:
    risk = F.col(risk) if isinstance(risk, str) else risk
    ordinals = F.create_map(*[F.lit(x) for pair in RISK_ORDINALS.items() for x in pair])
    return F.coalesce(F.try_element_at(ordinals, risk), F.lit(0.0))
