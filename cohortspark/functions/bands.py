"""Age bands."""

from __future__ import annotations

from collections.abc import Sequence

# The youngest age of every band; the last band has no upper end.
DEMOGRAPHIC_EDGES = (0, 2, 5, 10, 15, 20, 25, 30, 35, 40, 45, 50, 55, 60, 65, 70, 75, 80)
MATERNAL_EDGES = (0, 2, 5, 10, 15, 20, 25, 30, 35, 40, 45, 50, 55)


def _case(age: str, edges: Sequence[int], absent: str, negative: str, bands: list[str]) -> str:
    """SQL that picks an outcome by the band of ``age``.

    A band runs up to the next edge, so a fractional age belongs to the band of its whole
    years (1.5 is in ``0-1 yrs``).
    """
    steps = "".join(f" WHEN {age} < {edge} THEN {band}" for edge, band in zip(edges[1:], bands))
    return (
        f"CASE WHEN {age} IS NULL THEN {absent} WHEN {age} < {edges[0]} THEN {negative}"
        f"{steps} ELSE {bands[-1]} END"
    )


def age_band(age: str, edges: Sequence[int]) -> str:
    """SQL for the label of the band of an age column."""
    labels = [f"'{low}-{high - 1} yrs'" for low, high in zip(edges, edges[1:])]
    return _case(age, edges, "'MISSING'", "'NEGATIVE'", [*labels, f"'{edges[-1]}+ yrs'"])


def band_start(age: str, edges: Sequence[int]) -> str:
    """SQL for the youngest age of the band: as good a grouping key as the label, but a number.

    Null if null, -1 if negative; ``age_band`` of it is the label.
    """
    return _case(age, edges, "NULL", "-1", [str(edge) for edge in edges])
