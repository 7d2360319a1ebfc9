"""The corpus queries by name, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from funnelwright.llm import (
    licences,
    linededup,
    mixing,
    neardup,
    packing,
    periods,
    pieces,
    pseudonyms,
    quality,
    sharding,
    toxicity,
    variants,
    winnow,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_winnowing": winnow.op1_winnowing,
    "op2_pseudonyms": pseudonyms.op2_pseudonyms,
    "op3_pieces": pieces.op3_pieces,
    "op4_sharding": sharding.op4_sharding,
    "op5_lines": linededup.op5_lines,
    "op6_near_duplicates": neardup.op6_near_duplicates,
    "op7_quality": quality.op7_quality,
    "op8_licences": licences.op8_licences,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_packing": packing.op10_packing,
    "op11_variants": variants.op11_variants,
    "op12_mixing": mixing.op12_mixing,
    "op13_periods": periods.op13_periods,
}

ORACLES: dict[str, str] = {
    "op4_sharding": sharding.OP4_SQL,
    "op8_licences": licences.OP8_SQL,
}

#: Why the others have no SQL; each is tested against a brute-force version, a round trip or held-out accuracy.
WITHOUT_SQL: dict[str, str] = {
    "op1_winnowing": "rolling hashes over code points",
    "op2_pseudonyms": "keyed permutations",
    "op3_pieces": "a best path over an automaton",
    "op5_lines": "a similarity join whose later matches follow from earlier ones",
    "op6_near_duplicates": "components of a graph of any depth",
    "op7_quality": "iterated robust estimates",
    "op9_toxicity": "a fitted chain of labels",
    "op10_packing": "a linear program",
    "op11_variants": "CRC-32, and chains of any length",
    "op12_mixing": "drawn numbers",
    "op13_periods": "CRC-32, and a search for periods",
    "pipeline": "stages of these",
}
