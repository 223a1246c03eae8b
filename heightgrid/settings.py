"""Default parameters of the three jobs."""

from __future__ import annotations

from dataclasses import dataclass

# Height bin edges (m) and their labels; cover bin edges and labels.
HEIGHT_EDGES = (0, 5, 10, 15, 20, 25, 30, 35, 40, 45, 50)
HEIGHT_LABELS = (
    "0-5", "5-10", "10-15", "15-20", "20-25", "25-30",
    "30-35", "35-40", "40-45", "45-50", ">50",
)
COVER_EDGES = (0.0, 0.3, 0.5, 0.8, 1.0)
COVER_LABELS = ("low", "medium", "high", "full")
N_BANDS = 64
NODATA = -9999.0


@dataclass(frozen=True)
class Settings:
    seed: int = 420
    res_m: float = 10.0
    statistic: str = "P95"
    n_samples: int = 5000
    n_folds: int = 5
    min_n_per_tile: int = 20
    block_width: float = 10_000.0
    block_height: float = 10_000.0
    block_method: str = "random"
    height_edges: tuple = HEIGHT_EDGES
    height_labels: tuple = HEIGHT_LABELS
    min_area: float = 1000.0
    min_height: float = 0.0
    max_height: float = 50.0
    min_forest_cover: float = 0.25
    small_tile_std: float = 3.0
    z_threshold: float = 2.5
    predict_tile: float = 2500.0
    forest_pixel: float = 30.0
    n_trials: int = 30
    criterion: str = "RMSE"
    models: tuple = ("ElasticNet", "RandomForestRegressor", "XGBRegressor")
    exclude_water: bool = True
    label_offset: int = 0
    test: bool = False
