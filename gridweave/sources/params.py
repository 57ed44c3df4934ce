"""Parameters of a grid workflow, read once on the driver."""

from __future__ import annotations

from dataclasses import dataclass, fields
from pathlib import Path


@dataclass(frozen=True)
class Params:
    """Settings that operators take, with the defaults of such workflows (fixed values); other names are passed over, as nothing reads them."""

    grid_res_m: float = 10.0
    nir_land_threshold: float = 0.06
    optical_extinction_default_m: float = -26.0
    train_holdout_split: float = 0.30
    split_seed: int = 42
    max_cloud_pct: float = 5.0
    max_scenes: int = 12
    rmse_0_15m_max: float = 1.5
    rmse_15_25m_max: float = 2.5
    depth_bands_m: tuple[float, ...] = (0, 5, 10, 15, 20, 25, 30)
    rugosity_percentile: float = 92
    bpi_percentile: float = 92
    bpi_outer_m: float = 500
    min_area_px: int = 12
    edge_erode_px: int = 3
    min_dist_from_known_site_m: float = 500
    max_leads: int = 100
    simplify_deg: float = 0.00002
    isobath_densify_deg: float = 0.0002
    min_zoom: int = 8
    max_zoom: int = 15
    max_payload_mb: float = 300


def load(path: str) -> Params:
    """Parameters from a YAML file of sections; what the file lacks has its default."""
    import yaml

    known = {f.name for f in fields(Params)}
    found: dict = {}
    todo = [yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}]
    while todo:
        for key, value in todo.pop().items():
            if isinstance(value, dict):
                todo.append(value)
            elif key in known:
                found[key] = tuple(value) if isinstance(value, list) else value
    return Params(**found)
