"""Thresholds of an audit run, and closed vocabularies."""

from __future__ import annotations

import dataclasses
import tomllib
from dataclasses import dataclass
from pathlib import Path


@dataclass(frozen=True)
class Settings:
    """Defaults of a run; all distances in metres, angles in degrees."""

    search_radius: float = 40.0
    grid_step: float = 5.0
    nearest_radius: float = 10.0
    max_view_dist: float = 30.0
    near_view_dist: float = 15.0
    min_view_dist: float = 1.5
    min_visible: float = 3.0
    min_span: float = 12.0
    max_span: float = 120.0
    snap: float = 2.5
    max_views: int = 4
    min_new_wall: float = 2.0
    views_apart: float = 6.0
    outline_step: float = 0.5
    min_part_area: float = 15.0
    sight_stop: float = 0.05
    square_on_cos: float = 0.42
    camera_height: float = 2.5
    position_error: float = 2.0
    image_px: int = 640
    door_unique_radius: float = 50.0
    old_imagery_before: str = "2025-01"
    second_opinion: str = "verify"
    link_dist: float = 50.0
    max_links: int = 4
    link_sector: float = 60.0
    junction: float = 1.0
    min_stretch: float = 10.0
    camera_reach: float = 15.0
    back_lot_reach: float = 30.0
    picture_step: float = 50.0
    picture_reach: float = 10.0
    gap_step: float = 10.0
    gap_reach: float = 25.0
    blocker_margin: float = 80.0
    blocker_overlap: float = 0.2
    click_min_s: int = 2
    click_max_s: int = 240

    @classmethod
    def load(cls, path: str | Path) -> Settings:
        """From a TOML file (a byte-order mark is allowed); an unknown key is an error, lists become tuples."""
        values = tomllib.loads(Path(path).read_bytes().decode("utf-8-sig"))
        known = {f.name for f in dataclasses.fields(cls)}
        if unknown := sorted(set(values) - known):
            raise ValueError(f"unknown settings: {', '.join(unknown)}")
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in values.items()})


# Fixed values.
VISIBLE = ("clear", "partly hidden")
TRADE_USAGES = ("Commercial", "Mixed", "Office / Lodge / Theater / Restaurants")
COMPASS = ("N", "NE", "E", "SE", "S", "SW", "W", "NW")
MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")
REFERENCE = "this is the reference view"
