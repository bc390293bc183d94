"""Physical quantities: a number or a closed range with a unit, in SI."""

from __future__ import annotations

import math
from dataclasses import dataclass

#: Factor to SI by dimension and unit name.
UNITS: dict[str, dict[str, float]] = {
    "length": {"nanometer": 1e-9, "nm": 1e-9, "micrometer": 1e-6, "millimeter": 1e-3, "mm": 1e-3, "centimeter": 0.01, "cm": 0.01, "meter": 1, "m": 1, "kilometer": 1000, "km": 1000, "inch": 0.0254, "feet": 0.3048, "mile": 1609.344, "mi": 1609.344},
    "time": {"millisecond": 1e-3, "ms": 1e-3, "second": 1, "sec": 1, "s": 1, "minute": 60, "min": 60, "hour": 3600, "h": 3600},
    "speed": {"meter_per_second": 1, "mps": 1, "kilometer_per_hour": 1 / 3.6, "kmph": 1 / 3.6, "kph": 1 / 3.6, "mile_per_hour": 0.44704, "mph": 0.44704, "miph": 0.44704, "millimeter_per_hour": 1e-3 / 3600, "mmph": 1e-3 / 3600},
    "acceleration": {"meter_per_sec_sqr": 1, "mpsps": 1, "mpss": 1, "kilometer_per_hour_per_sec": 1 / 3.6, "kmphps": 1 / 3.6, "kphps": 1 / 3.6, "mile_per_hour_per_sec": 0.44704, "miphps": 0.44704},
    "jerk": {"meter_per_sec_cubed": 1, "mpspsps": 1, "mpsss": 1},
    "angle": {"degree": math.pi / 180, "deg": math.pi / 180, "radian": 1, "rad": 1},
    "angular_rate": {"degree_per_second": math.pi / 180, "degps": math.pi / 180, "radian_per_second": 1, "radps": 1},
}
DIMENSION = {u: d for d, us in UNITS.items() for u in us}


@dataclass(frozen=True)
class Quantity:
    lo: float
    hi: float
    dimension: str | None = None

    @property
    def single(self) -> bool:
        return self.lo == self.hi

    def bounds(self, tol: float = 0.0, scale: float = 1.0) -> tuple[float, float]:
        """A single value with its tolerance, a range without; scale: table units for one SI unit."""
        t = tol if self.single else 0.0
        return (self.lo - t) * scale, (self.hi + t) * scale

    def frames(self, fps: float) -> tuple[int, int]:
        """Frames of a duration: whole ones inside it, at least one."""
        lo = max(1, math.ceil(self.lo * fps - 1e-9))
        return lo, max(lo, math.floor(self.hi * fps + 1e-9))


def quantity(number: float, unit: str | None) -> Quantity:
    if unit is None:
        return Quantity(number, number)
    if unit not in DIMENSION:
        raise ValueError(f"unknown unit {unit}")
    d = DIMENSION[unit]
    x = number * UNITS[d][unit]
    return Quantity(x, x, d)


def range_of(a: Quantity, b: Quantity) -> Quantity:
    if a.dimension != b.dimension:
        raise ValueError("a range needs one dimension")
    if not a.lo < b.hi:
        raise ValueError("a range needs its lower end first")
    return Quantity(a.lo, b.hi, a.dimension)
