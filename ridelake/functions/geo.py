"""Lambert conformal conic grid as column expressions.

The projection's constants depend only on its parameters, so they are computed
once on the driver and enter the plan as literals; per row there are only
built-in trigonometric functions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ConicGrid:
    """Grid over a cone through two standard parallels."""

    # Earth radius and cell size in km, parallels and origin in degrees, origin in km.
    earth_radius_km: float = 6371.00877
    cell_km: float = 5.0
    parallel_1: float = 30.0
    parallel_2: float = 60.0
    origin_lon: float = 126.0
    origin_lat: float = 38.0
    origin_x_km: float = 210
    origin_y_km: float = 675

    @staticmethod
    def _half_colatitude_tan(degrees: float) -> float:
        return math.tan(math.pi / 4 + math.radians(degrees) / 2)

    @cached_property
    def cone(self) -> float:
        """Cone constant."""
        low, high = math.radians(self.parallel_1), math.radians(self.parallel_2)
        spread = self._half_colatitude_tan(self.parallel_2) / self._half_colatitude_tan(self.parallel_1)
        return math.log(math.cos(low) / math.cos(high)) / math.log(spread)

    @cached_property
    def scale(self) -> float:
        """Cells from the apex at the latitude where the half-colatitude tangent is one."""
        low = math.radians(self.parallel_1)
        power = self._half_colatitude_tan(self.parallel_1) ** self.cone
        return self.earth_radius_km / self.cell_km * power * math.cos(low) / self.cone

    @cached_property
    def apex_distance(self) -> float:
        """Cells from the apex to the origin."""
        return self.scale / self._half_colatitude_tan(self.origin_lat) ** self.cone

    def forward(self, lat: Column, lon: Column) -> tuple[Column, Column]:
        """Cell ``(x, y)`` of a position; rounding truncates toward zero."""
        radius = F.lit(self.scale) / F.pow(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2), F.lit(self.cone))
        turn = F.radians(lon) - F.lit(math.radians(self.origin_lon))
        turn = (
            F.when(turn > math.pi, turn - 2 * math.pi).when(turn < -math.pi, turn + 2 * math.pi).otherwise(turn)
        ) * F.lit(self.cone)
        x = radius * F.sin(turn) + F.lit(self.origin_x_km / self.cell_km)
        y = F.lit(self.apex_distance) - radius * F.cos(turn) + F.lit(self.origin_y_km / self.cell_km)
        return (x + F.lit(1.5)).cast("bigint"), (y + F.lit(1.5)).cast("bigint")

    def inverse(self, x: Column, y: Column) -> tuple[Column, Column]:
        """Latitude and longitude of a cell's corner."""
        east = x - F.lit(1) - F.lit(self.origin_x_km / self.cell_km)
        south = F.lit(self.apex_distance) - (y - F.lit(1)) + F.lit(self.origin_y_km / self.cell_km)
        radius = F.hypot(east, south) * F.lit(math.copysign(1.0, self.cone))
        lat = F.degrees(
            F.lit(2.0) * F.atan(F.pow(F.lit(self.scale) / radius, F.lit(1.0 / self.cone))) - F.lit(math.pi / 2)
        )
        # atan2 already gives 0 and +-pi/2 on the axes, except that 0 east stays 0 below the apex.
        turn = F.when(east == 0, F.lit(0.0)).otherwise(F.atan2(east, south))
        return lat, F.degrees(turn / F.lit(self.cone) + F.lit(math.radians(self.origin_lon)))
