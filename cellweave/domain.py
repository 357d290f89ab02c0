"""The model domain and the classes of surfaces."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Domain:
    """A regular grid of nx by ny cells; geometry follows from (i, j) and is never stored."""

    nx: int
    ny: int
    dx: float
    dy: float
    dz: float
    origin_x: float
    origin_y: float

    @classmethod
    def centred(cls, cx: float, cy: float, nx: int, ny: int, dx: float, dy: float, dz: float | None = None) -> Domain:
        """From the centre; a missing dz takes dx."""
        return cls(nx, ny, dx, dy, dx if dz is None else dz, cx - nx * dx / 2, cy - ny * dy / 2)


#: First class of each surface kind, and of the next.
VEGETATION, PAVEMENT, WATER, BUILDING, END = 100, 200, 300, 900, 1000
#: Classes set by corrections.
SEALED, BARE, DEFAULT_BUILDING, BRIDGE = 202, 101, 906, 907
#: Class of codes that the class map lacks and of polygons without a class; of street-map polygons added to typed land cover.
DEFAULT_TYPE, DEFAULT_STREET = 103, 901
